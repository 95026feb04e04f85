"""Packing of tokenized documents into fixed-length sequences by minimum bin slack.

All pieces of one length are alike, so the packing is planned on the histogram of lengths (at most `capacity` numbers,
whatever the data): for each bin a dynamic programme over the subset sums of the lengths still there, kept as bits of one
integer, finds the fullest feasible combination with the longest length in it; it is removed as often as the counts allow
and becomes one row of the plan. Every step uses up a length or leaves fewer of it than a bin took, so the plan is bounded
by the capacity as well. Spark numbers the pieces of each length and looks their places up in the plan.
"""

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from holdfast.llm.common import TEXT, slices
from holdfast.session import store

CAPACITY = 2048
END_ID = 0
#: Rows that are numbered together in one task.
RUN_ROWS = 50_000
#: Encoded words that a Python worker keeps.
CACHED_WORDS = 600_000

#: The tokenizer's word pattern for texts of the characters in _PLAIN, where letters, digits and white space mean the same
#: to all libraries; other texts go to the tokenizer whole. Each match is a word of the tokenizer, and a word by itself.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ſ]*")
_LETTER = r"A-Za-zÀ-ÖØ-öø-ſ"
_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")


def byte_alphabet() -> dict[int, str]:
    """The characters that byte-level vocabularies write for bytes: printable ones stand for themselves, the others for
    the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class WordCoder:
    """Ids of whole texts as little-endian bytes; words met before come from a bounded table."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = byte_alphabet()
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if not _PLAIN.fullmatch(text) or any(mark in text for mark in self.special):
            return self.whole([text])[0]
        words = _WORDS.findall(text)
        coded = list(map(self.known.get, words))
        if None in coded:
            new: dict[str, bytes] = {}
            for i, part in enumerate(coded):
                if part is None:
                    word = words[i]
                    coded[i] = new[word] if word in new else new.setdefault(word, self.word(word))
            if len(self.known) < CACHED_WORDS:
                self.known |= new
        return b"".join(coded)

    def word(self, word: str) -> bytes:
        """Ids of one match of the word pattern."""
        if word.isascii() and word[-1] > " ":  # printable behind one space at most
            mapped = self.alphabet[32] + word[1:] if word[0] == " " else word
        else:
            mapped = "".join(map(self.alphabet.__getitem__, word.encode()))
        return b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(mapped)])

    def whole(self, texts: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, dtype="<u4").tobytes() for c in coded]


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids). A document is its ids and END_ID; one longer
    than the capacity is cut into full pieces, of which the first takes what is left over."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                keys, numbers, starts, lengths, sums, parts = [], [], [], [], [], []
                for row, data in enumerate(texts):
                    coded = coder(path).encode(data.decode("utf-8", "replace")) + END_ID.to_bytes(4, "little")
                    total = len(coded) // 4
                    cuts = [0, *range(total % capacity or capacity, total + 1, capacity)]
                    for number, (start, end) in enumerate(zip(cuts, cuts[1:])):
                        own = coded[4 * start:4 * end]
                        keys.append(row)
                        numbers.append(number)
                        starts.append(start)
                        lengths.append(end - start)
                        sums.append(zlib.crc32(own))
                        if ids:
                            parts.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keys, pa.int64())), pa.array(numbers, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
                    + ([pa.array(parts, pa.list_(pa.int32()))] if ids else []),
                    names=["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if ids else []))

    kind = docs.select(key).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if ids else "")
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias(TEXT)).mapInArrow(mapped, schema)


@dataclass(frozen=True)
class Plan:
    """Places of the pieces of one length by their number: those from starts[i] on are in sequences first[i], first[i] + 1
    and so on, at offsets[i]."""

    starts: np.ndarray
    first: np.ndarray
    offsets: np.ndarray


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """Lengths and how often each is taken: the longest length and what fills the rest of the bin best."""
    lengths = sorted(counts, reverse=True)
    room = capacity - lengths[0]
    left = {**counts, lengths[0]: counts[lengths[0]] - 1}
    reached, mask, steps = 1, (1 << room + 1) - 1, []
    for length in lengths:
        copies, batch = min(left[length], room // length), 1
        while copies > 0 and not reached >> room & 1:
            take = min(batch, copies)  # 1, 2, 4, ... of this length at once
            steps.append((length, take, reached))
            reached |= reached << length * take & mask
            copies, batch = copies - take, 2 * batch
        if reached >> room & 1:
            break
    at, taken = reached.bit_length() - 1, {lengths[0]: 1}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            taken[length] = taken.get(length, 0) + take
    return sorted(taken.items(), reverse=True)


def minimum_slack(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, Plan], int]:
    """The plan for each length, and the number of sequences."""
    left = {length: count for length, count in histogram.items() if count > 0}
    used: dict[int, int] = dict.fromkeys(left, 0)
    places: dict[int, list[tuple[int, int, int]]] = {length: [] for length in left}
    sequence = 0
    while left:
        taken = fullest(left, capacity)
        times = min(left[length] // copies for length, copies in taken)
        offset = 0
        for length, copies in taken:
            for _ in range(copies):
                places[length].append((used[length], sequence, offset))
                used[length] += times
                offset += length
            left[length] -= copies * times
            if not left[length]:
                del left[length]
        sequence += times
    return {length: Plan(*np.array(rows, dtype=np.int64).T) for length, rows in places.items()}, sequence


def numbered(pieces: DataFrame) -> DataFrame:
    """Stored pieces with `number`, from 0 without gaps among those of one length.

    Rows are numbered inside runs of RUN_ROWS rows of a stored file, then moved on by the counts of the runs before; a
    length that a third of all rows have is thus in many tasks, and nothing but counts is ordered overall.
    """
    run = Window.partitionBy("length", "run").orderBy("at")
    rows = pieces.select(
        "*", F.concat_ws(":", "_metadata.file_name", F.expr(f"_metadata.row_index div {RUN_ROWS}")).alias("run"),
        F.col("_metadata.row_index").alias("at"))
    counts = rows.groupBy("length", "run").agg(F.count("*").alias("rows"))
    before = counts.select(
        "length", "run", (F.sum("rows").over(Window.partitionBy("length").orderBy("run")) - F.col("rows")).alias("before"))
    own = rows.withColumn("own", F.row_number().over(run) - 1)
    return own.join(before, ["length", "run"]).withColumn("number", F.col("own") + F.col("before")).drop(
        "run", "at", "own", "before")


def placed(rows: DataFrame, plan: dict[int, Plan]) -> DataFrame:
    """Numbered pieces with sequence_id and offset."""
    names = [c for c in rows.columns if c != "number"]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Workers that coded texts before give back the vocabulary and the table of words while the rows are sorted.
        coder.cache_clear()
        for batch in batches:
            lengths, numbers = (np.asarray(batch.column(batch.schema.get_field_index(c))) for c in ("length", "number"))
            sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            values, firsts = np.unique(lengths[order], return_index=True)
            for length, own in zip(values, np.split(order, firsts[1:])):
                part = plan[int(length)]
                at = np.searchsorted(part.starts, numbers[own], side="right") - 1
                sequences[own] = part.first[at] + numbers[own] - part.starts[at]
                offsets[own] = part.offsets[at]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names] + [pa.array(sequences), pa.array(offsets)],
                names=[*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    return rows.mapInArrow(mapped, f"{fields}, sequence_id long, offset long")


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, ids: bool = False, key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Each piece of each document with its sequence and its place there; with ids=True also its token ids.

    Null and empty texts are the one token END_ID. Repeated rows are packed each; null keys are kept. An empty table gives
    no pieces. Pieces are tokenized once and stored in the shared folder. The histogram that reaches the driver has one
    row per length, so at most `capacity` rows; the plan sent to the tasks is bounded by it.
    """
    stored = store(pieces(docs, path, capacity, ids, key, text), "pieces")
    histogram = {row["length"]: row["count"] for row in stored.groupBy("length").count().collect()}
    plan, _ = minimum_slack(histogram, capacity)
    return placed(numbered(stored), plan)
