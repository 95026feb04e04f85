"""Spelling variants: words of the corpus that one inserted, deleted or replaced letter makes into a far commoner word.

The vocabulary of a corpus is sharded by length. Each shard has blocked Bloom filters: a word sets bits of one block of
512 only, so a test touches one cache line. The filters are broadcast and every word's neighbourhood is generated beside
them: its deletions are tested against the filters of the next shorter words, its replacements against those of its own
length. Insertions are the deletions of the other word, and of two words that differ in a letter the one with the smaller
letter asks. The hash of a word is a sum over its letters, so that of an edit is made from prefix sums without writing the
edit. Only edits that the filters do not rule out are written and shuffled, to an exact join with the vocabulary.

What is broadcast is bounded: filters are cut into cells of 8 KB by hash, and where all cells exceed FILTER_BYTES they are
broadcast in rounds, each of which tests the edits that fall into its cells.
"""

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import TEXT, slices
from holdfast.session import store, wide_parallelism

#: Letters of a word; A-Z are lower-cased.
LETTERS = r"[A-Za-zÀ-ÿ]"
#: Words that a task holds with their counts before it hands them on.
MOST_HELD = 200_000
#: Filters: bits of a block, blocks of a cell, bits a word takes and sets, bytes broadcast at once.
BLOCK_BITS, CELL_BLOCKS, BITS_PER_WORD, PROBES, FILTER_BYTES = 512, 128, 24, 7, 32 << 20
CELL_WORDS = CELL_BLOCKS * BLOCK_BITS // BITS_PER_WORD
#: Lengths that have a shard each; longer words share one per power of two.
OWN_SHARDS = 64
#: Words that a task takes at a time, in letters times alphabet.
CHUNK_EDITS = 1 << 21
#: Words of one partition of the vocabulary.
PARTITION_WORDS = 100_000
#: An odd number and its inverse modulo 2**64: the weight of a letter grows by it from place to place.
STEP = 0x9E3779B97F4A7C15
BACK = pow(STEP, -1, 1 << 64)


def word_counts(
    docs: DataFrame, alter: Callable[[str, str], str] | None = None, least: int = 7, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """word and n, the number of its occurrences in all texts, for words of at least `least` letters.

    `alter(key, word)` may change a word, but not lengthen it; the key is that of its document as a string, rows without a
    key are not altered. Words are counted where they are read.
    """
    pattern = re.compile(f"{LETTERS}{{{least},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for part, texts in slices(batch):
                for name, data in zip(part.column(0).to_pylist(), texts):
                    own = pattern.findall(data.lower().decode("utf-8", "replace"))
                    if alter is None or name is None:
                        held.update(own)
                        continue
                    for word, n in Counter(own).items():
                        word = alter(name, word)
                        if len(word) >= least:
                            held[word] += n
                    if len(held) > MOST_HELD:
                        yield handed()
                if len(held) > MOST_HELD:
                    yield handed()
        yield handed()

    rows = docs.select(F.col(key).cast("string").alias("_key"), F.col(text).alias(TEXT))
    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(values: np.ndarray) -> np.ndarray:
    """A good 64-bit hash of each number."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        values = (values ^ values >> np.uint64(shift)) * np.uint64(factor)
    return values ^ values >> np.uint64(31)


def _letter_weights(codes: np.ndarray) -> np.ndarray:
    return _mixed(codes.astype(np.uint64) + np.uint64(1 << 32))


def _place_weights(n: int) -> np.ndarray:
    steps = np.full(n, STEP, np.uint64)
    steps[:1] = 1
    return steps.cumprod(dtype=np.uint64)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        out.setdefault(len(word), []).append(i)
    return out


def shard_of(length: int) -> int:
    return length if length <= OWN_SHARDS else OWN_SHARDS + length.bit_length()


class Layout:
    """Which cells belong to which shard of the vocabulary."""

    def __init__(self, shards: dict[int, int], cell_words: int = CELL_WORDS):
        self.first, self.cells, self.total = {}, {}, 0
        for shard, words in sorted(shards.items()):
            self.first[shard], self.cells[shard] = self.total, -(-words // cell_words)
            self.total += self.cells[shard]

    def cell(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        return self.first[shard] + ((hashes >> np.uint64(32)) * np.uint64(self.cells[shard]) >> np.uint64(32)).astype(np.int64)


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Block in the cell, and one after the other the bits in the block."""
    more = _mixed(hashes + np.uint64(STEP))
    places = _mixed(more)
    return (more % np.uint64(CELL_BLOCKS)).astype(np.int64), (
        places >> np.uint64(9 * i) & np.uint64(BLOCK_BITS - 1) for i in range(PROBES))


def _filled(hashes: np.ndarray) -> bytes:
    """A cell with the bits of some words."""
    cell = np.zeros(CELL_BLOCKS * BLOCK_BITS // 64, np.uint64)
    block, bits = _bits(hashes)
    for bit in bits:
        np.bitwise_or.at(cell, block * (BLOCK_BITS // 64) + (bit >> np.uint64(6)).astype(np.int64),
                         np.uint64(1) << (bit & np.uint64(63)))
    return cell.tobytes()


class Filters:
    """Cells first..last-1 of the vocabulary's filters."""

    def __init__(self, layout: Layout, first: int, data: bytes):
        self.layout, self.start = layout, first
        self.words = np.frombuffer(data, np.uint64)
        self.end = first + len(data) // (CELL_BLOCKS * BLOCK_BITS // 8)

    def possible(self, shard: int, hashes: np.ndarray) -> np.ndarray:
        """Places of the hashes that may be those of words of a shard."""
        if shard not in self.layout.cells:
            return np.zeros(0, np.int64)
        cell = self.layout.cell(shard, hashes)
        left = np.flatnonzero((cell >= self.start) & (cell < self.end))
        block, bits = _bits(hashes[left])
        base = ((cell[left] - self.start) * CELL_BLOCKS + block) * (BLOCK_BITS // 64)
        rest = np.arange(len(left))
        for bit in bits:
            bit = bit[rest]
            word = self.words[base[rest] + (bit >> np.uint64(6)).astype(np.int64)]
            rest = rest[(word >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
        return left[rest]


def word_hashes(words: list[str]) -> np.ndarray:
    out = np.zeros(len(words), np.uint64)
    for length, rows in _by_length(words).items():
        codes = _codes([words[i] for i in rows])
        sums = (_letter_weights(codes) * _place_weights(length)).sum(1, dtype=np.uint64)
        out[rows] = _mixed(sums)
    return out


def possible_edits(words: list[str], filters: Filters, alphabet: np.ndarray) -> Iterator[tuple[int, str]]:
    """(place of a word, edit) for the deletions, and replacements by a larger letter, that the filters let pass."""
    weights = _letter_weights(alphabet)
    for length, rows in _by_length(words).items():
        step = max(1, CHUNK_EDITS // (length * max(1, len(alphabet))))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            codes = _codes([words[i] for i in part])
            place = _place_weights(length)
            terms = _letter_weights(codes) * place
            upto = terms.cumsum(1, dtype=np.uint64)
            whole = upto[:, -1:]
            # Without a letter, those behind it move one place to the front. Equal neighbours give the same deletion.
            shorter = upto - terms + (whole - upto) * np.uint64(BACK)
            row, column = np.nonzero(np.diff(codes, axis=1, prepend=0) != 0)
            for i in filters.possible(shard_of(length - 1), _mixed(shorter[row, column])):
                word = words[part[row[i]]]
                yield part[row[i]], word[:column[i]] + word[column[i] + 1:]
            # Replacements letter by letter of long words, so that a chunk stays small.
            wide = max(1, CHUNK_EDITS // (len(part) * max(1, len(alphabet))))
            for low in range(0, length, wide):
                some = slice(low, low + wide)
                row, column, letter = np.nonzero(alphabet > codes[:, some, None])
                column += low
                changed = (whole - terms)[row, column] + weights[letter] * place[column]
                for i in filters.possible(shard_of(length), _mixed(changed)):
                    word = words[part[row[i]]]
                    yield part[row[i]], word[:column[i]] + chr(alphabet[letter[i]]) + word[column[i] + 1:]


def _shards(vocabulary: DataFrame) -> dict[int, int]:
    """Words of each shard; at most OWN_SHARDS and 32 rows reach the driver."""
    length = F.char_length("word")
    wide = F.length(F.bin(length.cast("long"))) + OWN_SHARDS
    return {r["shard"]: r["n"] for r in vocabulary.groupBy(
        F.when(length <= OWN_SHARDS, length).otherwise(wide).alias("shard")).agg(F.count("*").alias("n")).collect()}


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES, cell_words: int = CELL_WORDS) -> DataFrame:
    """Pairs (word, n, near, near_n), each in both directions, of words that one inserted, deleted or replaced letter tells
    apart. `vocabulary` is a stored table of distinct words and their n."""
    spark = vocabulary.sparkSession
    layout = Layout(_shards(vocabulary), cell_words)
    # At most 26 + 64 letters.
    alphabet = np.array(sorted(ord(r[0]) for r in vocabulary.select(
        F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).where("letter <> ''").distinct().collect()), np.int64)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            hashes = word_hashes(words)
            cells = np.zeros(len(words), np.int64)
            for length, rows in _by_length(words).items():
                cells[rows] = layout.cell(shard_of(length), hashes[rows])
            yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(hashes.view(np.int64))], names=["cell", "hash"])

    def built(group: pa.Table) -> pa.Table:
        bits = _filled(group.column("hash").to_numpy().view(np.uint64))
        return pa.table({"cell": group.column("cell").slice(0, 1), "bits": pa.array([bits], pa.binary())})

    cells = store(vocabulary.select("word").mapInArrow(placed, "cell long, hash long").groupBy("cell").applyInArrow(
        built, "cell long, bits binary"), "filter-cells")
    tasks = max(wide_parallelism(spark), -(-sum(layout.cells.values()) * cell_words // PARTITION_WORDS))
    spread = store(vocabulary.repartition(tasks, "word"), "spread-vocabulary") if layout.total else vocabulary
    size = CELL_BLOCKS * BLOCK_BITS // 8
    step = max(1, filter_bytes // size)
    pairs = None
    for first in range(0, max(1, layout.total), step):
        last = min(first + step, layout.total)
        data = bytearray((last - first) * size)
        # At most filter_bytes.
        for cell, bits in cells.where(F.col("cell").between(first, last - 1)).collect():
            data[(cell - first) * size:(cell - first + 1) * size] = bits
        shared = spark.sparkContext.broadcast((layout, first, bytes(data)))

        def probed(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filters = Filters(*shared.value)
            for batch in batches:
                words = batch.column(0).to_pylist()
                found = list(possible_edits(words, filters, alphabet))
                source = pa.array([i for i, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(source), batch.column(1).take(source), pa.array([e for _, e in found], pa.string())],
                    names=["word", "n", "near"])

        some = spread.select("word", "n").mapInArrow(probed, "word string, n long, near string")
        pairs = some if pairs is None else pairs.unionAll(some)
    exact = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # The vocabulary has each word once, and a word has no more edits than letters times alphabet: no key is hot.
    one_way = store(pairs.join(exact, "near").select("word", "n", "near", "near_n"), "near-words")
    return one_way.unionAll(one_way.select(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root, the end of the chain of forms, for the words that have a form. Each round doubles the steps; n grows
    along a chain by the ratio at least, so chains and rounds are few."""
    found = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = found.join(following, "root", "left")
        if joined.where("next is not null").isEmpty():
            return found
        found = store(joined.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_groups(counts: DataFrame, ratio: int = 10, filter_bytes: int = FILTER_BYTES, cell_words: int = CELL_WORDS) -> DataFrame:
    """word, form, root, n, n_near and form_n for each row (word, n) of distinct words.

    Near words differ by one inserted, deleted or replaced letter; n_near is their number. form is the near word of largest
    n (ties: the smallest in code-point order) if its n is `ratio` times the word's or more, else null, form_n its n. root is
    the last word of the chain of forms, the word itself if it has none. Null and empty words are left out; an empty
    table gives no rows. Other columns are not read.
    """
    if ratio < 2:
        raise ValueError("a form has to be commoner than its variant: ratio is 2 or more")
    vocabulary = store(counts.select("word", F.col("n").cast("long").alias("n")).where("word <> '' and n > 0"), "vocabulary")
    near = near_words(vocabulary, filter_bytes, cell_words)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    told = store(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"if(-best.minus >= {ratio} * n, best.near, null)").alias("form"),
        F.expr(f"if(-best.minus >= {ratio} * n, -best.minus, null)").alias("form_n")), "forms")
    ends = roots(told.where("form is not null"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, alter: Callable[[str, str], str] | None = None, least: int = 7, least_n: int = 2, ratio: int = 10,
    key: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES, cell_words: int = CELL_WORDS,
) -> DataFrame:
    """`spelling_groups` of the words of whole texts: maximal runs of LETTERS, A-Z lower-cased, with at least `least` letters
    and `least_n` occurrences. `alter` is that of `word_counts`.

    Null and empty texts have no words; texts of any length are read as a whole; repeated rows count each; rows with a null
    key count, unaltered; an empty table gives no rows. Columns other than key and text are not read, whatever their names.
    """
    counts = word_counts(docs, alter, least, key, text).where(F.col("n") >= least_n)
    return spelling_groups(counts, ratio, filter_bytes, cell_words)
