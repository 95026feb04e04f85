"""N-gram scores of whole texts by a weighted backoff automaton whose parts are counted and looked up with Spark.

The model. A state is a history h of up to order-1 tokens that occurs in the training texts, the root is the empty one.
For each token w that follows h in training there is an arc with weight log10((c(h,w) + m * p(w|h')) / (c(h) + m)), h' being
h without its first token and m the prior mass; for any other token there is one failure arc to h' with weight
log10(m / (c(h) + m)). At the root p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1)), one share being that of unknown tokens. The
probabilities of each state sum to one (unknown tokens taken together as one).

The work. Texts are put together in blocks of some megabytes. A block sends each of its distinct n-grams once, as 64-bit
hashes in packed runs, with its counts in the block's training texts, to the part of the hash range it falls in; parts add
the counts and send the totals back. A block thereby gets the piece of the automaton that its texts can reach, and one
traversal from left to right adds the weights. Nothing of the corpus passes the driver but two sums. Hashes spread n-grams
evenly, so frequent words make no part larger; the number of parts follows the number of tokens. Two of n different n-grams
have the same hash with a probability of about n * n / 2**65.
"""

from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import TEXT, slices
from holdfast.session import store

ORDER = 2
PRIOR_MASS = 4.0
#: Bytes of text that are scored together, and their tokens at most: the arrays of a block follow its tokens, and short
#: frequent words put many more of them into the same bytes.
BLOCK_BYTES = 16 << 20
BLOCK_TOKENS = 1 << 21
#: Bytes of n-grams that one task counts.
PART_BYTES = 16 << 20

#: Tokens of whole texts for which one table of arcs is made (a longer text has a table of its own).
WALK_TOKENS = 50_000

#: States without a history, and with only the begin mark as history. Others have the numbers after these.
ROOT, BEGUN = 0, 1

#: No words: words hold no white space.
END, BEGIN = b"\n", b" "


class Codes(dict):
    """Numbers words in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def lowered_words(text: bytes) -> list[bytes]:
    """Runs of bytes other than white space; only A-Z are lower-cased."""
    return text.lower().split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of an ordered pair of hashes."""
    x = left * np.uint64(0x9E3779B97F4A7C15) ^ right
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Columns doc_id, text, held_out to one row per block: its documents, and their tokens as numbers into its words."""

    def row(number: int, held: list) -> pa.RecordBatch:
        codes = Codes()
        keys, flags, lengths, tokens = [], [], [], []
        for key, flag, text in held:
            own = list(map(codes.__getitem__, lowered_words(text)))
            own.append(codes[END])
            keys.append(key)
            flags.append(flag)
            lengths.append(len(own))
            tokens.append(np.array(own, dtype=np.uint32))
        columns = {
            "block": [TaskContext.get().partitionId() << 32 | number], "keys": [keys], "held": [flags],
            "lengths": [lengths], "tokens": [np.concatenate(tokens).tobytes()], "words": [hashes(list(codes)).tobytes()],
            "n_tokens": [sum(lengths)], "n_train": [sum(n for n, flag in zip(lengths, flags) if not flag)],
        }
        types = [pa.int64(), pa.list_(key_type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(),
                 pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), types)], names=list(columns))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, count, number = [], 0, 0, 0
        for batch in batches:
            for part, texts in slices(batch):
                for item in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts):
                    held.append(item)
                    size += len(item[2])
                    # Its words and the end.
                    count += len(item[2].split()) + 1
                    if size >= block_bytes or count >= block_tokens:
                        yield row(number, held)
                        held, size, count, number = [], 0, 0, number + 1
        if held:
            yield row(number, held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    key_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = (f"block long, keys array<{kind}>, held array<boolean>, lengths array<long>, tokens binary, words binary, "
              "n_tokens long, n_train long")
    return docs.select("doc_id", F.col("text").alias(TEXT), "held_out").mapInArrow(mapped, schema)


class Block:
    """The n-grams of a block: for each order the hash at each token, and of the history it extends."""

    def __init__(self, row: dict, order: int):
        self.lengths = np.array(row["lengths"], dtype=np.int64)
        self.first = np.zeros(self.lengths.sum(), dtype=bool)
        self.first[np.cumsum(self.lengths) - self.lengths] = True
        self.train = np.repeat(~np.array(row["held"], dtype=bool), self.lengths)
        words = np.frombuffer(row["words"], dtype=np.uint64)
        grams = words[np.frombuffer(row["tokens"], dtype=np.uint32)]
        begin = hashes([BEGIN])[0]
        self.grams, valid = [grams], np.ones(len(grams), dtype=bool)
        self.valid = [valid]
        for size in range(2, order + 1):
            history = np.roll(self.grams[-1], 1)
            if size == 2:
                history[self.first] = begin
            else:
                # The begin mark is part of the longest history of a text's second token; longer ones start later.
                valid = np.roll(valid, 1) & ~self.first
            self.grams.append(mixed(history, grams))
            self.valid.append(valid)

    def distinct(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted n-grams of `size` tokens, their counts in training texts, and each token's place among them."""
        grams, places = np.unique(self.grams[size - 1], return_inverse=True)
        counts = np.bincount(places[self.train & self.valid[size - 1]], minlength=len(grams)).astype(np.uint32)
        return grams, counts, places


def part_of(grams: np.ndarray, parts: int) -> np.ndarray:
    """Number of the hash range, in the order of the hashes."""
    return (grams >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)


def gram_runs(stored: DataFrame, order: int, parts: int) -> DataFrame:
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                block = Block(row, order)
                for size in range(1, order + 1):
                    grams, counts, _ = block.distinct(size)
                    values, starts = np.unique(part_of(grams, parts), return_index=True)
                    cuts = [*starts, len(grams)]
                    spans = list(zip(cuts, cuts[1:]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(spans), size, np.int32)), pa.array(values.astype(np.int64)),
                        pa.array(np.full(len(spans), row["block"], np.int64)),
                        pa.array([grams[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
                    ], names=["size", "part", "block", "grams", "counts"])

    needed = stored.select("block", "held", "lengths", "tokens", "words")
    return needed.mapInArrow(mapped, "size int, part long, block long, grams binary, counts binary")


def add_counts(runs: pa.Table) -> pa.Table:
    """Totals over the blocks for each n-gram of a part, in the order each block sent them; `seen` is the number of
    n-grams with a count, in the part's first row."""
    grams = [np.frombuffer(v, dtype=np.uint64) for v in runs["grams"].to_pylist()]
    counts = np.concatenate([np.frombuffer(v, dtype=np.uint32) for v in runs["counts"].to_pylist()])
    values, places = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.zeros(len(values), dtype=np.int64)
    np.add.at(totals, places, counts)
    cuts = np.cumsum([len(g) for g in grams])[:-1]
    seen = np.zeros(len(grams), dtype=np.int64)
    seen[0] = np.count_nonzero(totals)
    return pa.table({
        "size": runs["size"], "part": runs["part"], "block": runs["block"],
        "totals": pa.array([t.tobytes() for t in np.split(totals[places], cuts)], pa.binary()), "seen": pa.array(seen),
    })


class Automaton:
    """The piece of the automaton that a block's texts can reach.

    Words and n-grams are numbered by their places among the block's distinct ones, which numbers the states too. found and
    places: by n-gram length, the training count and the place of each of the block's n-grams; base: the root's weight of
    each token; begins: the number of training texts. Failure arcs (`fails`, `shorter`) are arrays by state, the root's arcs
    (`root`, `read`) by word; `arcs` makes tables of the other ones for a run of texts, so that these stay small.
    """

    def __init__(self, block: Block, found: dict, places: dict, base: np.ndarray, begins: int, mass: float):
        self.block, self.found, self.places, self.base, self.begins, self.mass = block, found, places, base, begins, mass
        self.order, self.words, self.vocabulary = max(found), places[1], int(places[1].max()) + 1
        self.start = BEGUN if self.order > 1 and begins > 0 else ROOT
        sizes = range(1, self.order)
        self.first_state = dict(zip(sizes, accumulate((int(places[n].max()) + 1 for n in sizes), initial=BEGUN + 1)))
        states = 1 + max((self.first_state[n] + int(places[n].max()) for n in sizes), default=BEGUN)
        root, read = np.zeros(self.vocabulary), np.full(self.vocabulary, ROOT)
        fails, shorter = np.zeros(states), np.full(states, ROOT)
        fails[BEGUN] = np.log10(mass / (begins + mass))
        root[self.words] = base
        for size in sizes:
            at = np.flatnonzero(self.known(size, slice(None)))
            own = self.first_state[size] + places[size][at]
            fails[own] = np.log10(mass / (found[size][at] + mass))
            if size == 1:
                read[self.words[at]] = own
            else:
                # An n-gram of the training texts ends with a shorter one of them, which has a state.
                shorter[own] = self.first_state[size - 1] + places[size - 1][at]
        self.root, self.read = array("d", root.tobytes()), array("q", read.tobytes())
        self.fails, self.shorter = array("d", fails.tobytes()), array("q", shorter.tobytes())

    def known(self, size: int, run: slice) -> np.ndarray:
        return self.block.valid[size - 1][run] & (self.found[size][run] > 0)

    def arcs(self, start: int, stop: int) -> tuple[dict, array, array]:
        """Arcs of all states but the root for the tokens of whole texts: by state * vocabulary + word a number, by number
        the weight and the next state."""
        run, n = slice(start, stop), stop - start
        first, words = self.block.first[run], self.words[run]
        table, weights, states = {}, [], []
        # The longest state that the tokens up to here end with, of at most 0, 1, .. order - 1 tokens.
        longest, reached = [np.full(n, ROOT)], []
        for size in range(1, self.order):
            known = self.known(size, run)
            reached.append(np.where(known, self.first_state[size] + self.places[size][run], ROOT))
            longest.append(np.where(known, reached[-1], longest[-1]))
        weight = self.base[run]
        for size in range(2, self.order + 1):
            history, count = np.roll(reached[size - 2], 1), np.roll(self.found[size - 1][run], 1)
            if size == 2:
                history[first], count[first] = self.start, self.begins
            present = self.known(size, run) & (history != ROOT)
            # `weight` is that of the arc which reads the token after the shorter history.
            joint = np.log10((self.found[size][run] + self.mass * 10.0 ** weight) / (count + self.mass))
            weight = np.where(present, joint, weight)
            at = np.flatnonzero(present)
            table.update(zip((history[at] * self.vocabulary + words[at]).tolist(), (at + n * (size - 2)).tolist()))
            weights.append(weight)
            states.append(longest[min(size, self.order - 1)])
        return table, array("d", b"".join(w.tobytes() for w in weights)), array("q", b"".join(s.tobytes() for s in states))

    def score(self, arcs: tuple[dict, array, array], start: int, stop: int) -> float:
        """Log10 probability of the text of these tokens: one traversal from left to right that carries the state."""
        (table, weights, states), vocabulary = arcs, self.vocabulary
        root, read, fails, shorter = self.root, self.read, self.fails, self.shorter
        state, score = self.start, 0.0
        for word in self.words[start:stop].tolist():
            while state:
                arc = table.get(state * vocabulary + word)
                if arc is not None:
                    score += weights[arc]
                    state = states[arc]
                    break
                score += fails[state]
                state = shorter[state]
            else:
                score += root[word]
                state = read[word]
        return score

    def scores(self) -> np.ndarray:
        ends = np.cumsum(self.block.lengths)
        starts, out, done = ends - self.block.lengths, np.zeros(len(ends)), 0
        while done < len(ends):
            until = max(done + 1, int(np.searchsorted(ends, starts[done] + WALK_TOKENS, side="right")))
            arcs = self.arcs(int(starts[done]), int(ends[until - 1]))
            for text in range(done, until):
                out[text] = self.score(arcs, int(starts[text]), int(ends[text]))
            done = until
        return out


def language_model_scores(
    docs: DataFrame, order: int = ORDER, mass: float = PRIOR_MASS, block_bytes: int = BLOCK_BYTES,
    part_bytes: int = PART_BYTES, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Scores of all texts by the automaton learned from those with a false `held_out`; columns doc_id, text, held_out.

    n_tokens counts the words and the end, n_known those with a training count, train_tokens all tokens of the training
    texts; base_score is that of the root alone, score the model's. Null and empty texts are the end token. A null
    held_out counts as false. Repeated rows are scored and learned from each. An empty table gives no rows; with no
    training text all tokens are unknown. Other columns are not read.
    """
    docs = docs.withColumn("held_out", F.coalesce("held_out", F.lit(False)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    stored = store(blocks(docs, block_bytes, block_tokens), "lm-blocks")
    sums = stored.agg(F.sum("n_tokens").alias("n"), F.sum("n_train").alias("train")).first()
    tokens, total = sums["n"] or 0, sums["train"] or 0
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(spread, -(-tokens * 12 * order // part_bytes))
    counted = store(
        gram_runs(stored, order, parts).groupBy("size", "part").applyInArrow(
            add_counts, "size int, part long, block long, totals binary, seen long"), "lm-counts")
    vocabulary = counted.where("size = 1").agg(F.sum("seen")).first()[0] or 0

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        block = Block(row, order)
        runs = sorted(right.select(["size", "part", "totals"]).to_pylist(), key=lambda r: (r["size"], r["part"]))
        found, place = {}, {}
        for size in range(1, order + 1):
            grams, _, places = block.distinct(size)
            totals = np.frombuffer(b"".join(r["totals"] for r in runs if r["size"] == size), dtype=np.int64)
            found[size], place[size] = totals[places], places
            if size == 1:
                # As many texts begin as end.
                begins = int(totals[np.searchsorted(grams, hashes([END]))[0]])
        # What the walk doesn't read is given back before its tables are made.
        del row, runs, right, grams, totals, places
        block.grams = []
        base = np.log10((found[1] + 0.5) / (total + 0.5 * (vocabulary + 1)))
        starts = np.cumsum(block.lengths) - block.lengths
        return pa.table({
            "doc_id": left["keys"].combine_chunks().flatten(), "held_out": left["held"].combine_chunks().flatten(),
            "n_tokens": pa.array(block.lengths),
            "n_known": pa.array(np.add.reduceat((found[1] > 0).astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(starts), total, np.int64)),
            "base_score": pa.array(np.add.reduceat(base, starts)),
            "score": pa.array(Automaton(block, found, place, base, begins, mass).scores()),
        })

    schema = (f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
              "score double")
    return stored.select("block", "keys", "held", "lengths", "tokens", "words").groupBy("block").cogroup(
        counted.select("block", "size", "part", "totals").groupBy("block")).applyInArrow(scored, schema)
