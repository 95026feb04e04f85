"""SimHash fingerprints of word shingles, linked by Golay-code fuzzy hashing.

`fingerprint_groups` links all fingerprints of 64 bits that differ in three bits or fewer. The 64 bits are cut into three
segments. Three errors leave two segments with at most one error each (pigeonhole), so for each pair of segments a
fingerprint is filed under the codewords next to both segments and looked up under all pairs of codewords that are near
them: a fingerprint within the distance is found under one of these keys, and every find is verified on all bits.

`one_of_each` keeps one row of each group of linked rows.
"""

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm import golay
from holdfast.llm.common import map_texts
from holdfast.llm.components import components
from holdfast.session import store

SEED = 42
#: First bit and length of the segments of a fingerprint of 64 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
MOST_ERRORS = 3
#: Shingles whose bits are summed together, which the sum of a byte can hold.
_RUN = 255


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of the runs of `size` lower-cased words, or of all words if they are fewer; none for no words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        shingles = [joined]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = (ends - [len(w) for w in words]).tolist()
        shingles = [joined[a:b] for a, b in zip(starts, ends[size - 1:].tolist())]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype=np.uint64, count=len(shingles))


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """For each of 64 bits, the lowest first, the number of hashes that have it."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros(64, dtype=np.int64)
    for start in range(0, len(bits), _RUN):
        total += np.add.reduce(bits[start:start + _RUN], axis=0, dtype=np.uint8)
    return total


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of 64 bits, the lowest first, as unsigned numbers."""
    return np.packbits(bits, axis=-1, bitorder="little").view("<u8")[..., 0]


def fingerprint(text: bytes, size: int) -> int:
    hashes = shingle_hashes(text, size)
    return int(packed(2 * bit_sums(hashes) > len(hashes))) if len(hashes) else 0


def fingerprints(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the fingerprint `print` as a signed number."""

    def work(texts: list[bytes]) -> list[list]:
        return [np.array([fingerprint(t, size) for t in texts], dtype=np.uint64).view(np.int64)]

    return map_texts(docs.withColumnRenamed(key, "doc_id"), ["doc_id"], "print long", work, text)


def _segments(prints: np.ndarray) -> list[np.ndarray]:
    return [(prints >> np.uint64(first) & np.uint64((1 << length) - 1)).astype(np.uint32) for first, length in SEGMENTS]


def fuzzy_keys(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, print) under which fingerprints are filed, three each, and looked up, at most 108 each."""

    def file(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        near = [golay.nearest(s).astype(np.int64) for s in _segments(values)]
        for pair, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
            yield pair << 24 | near[a] << 12 | near[b], values

    def look_up(values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        near = [golay.nearby(s) for s in _segments(values)]
        for pair, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
            for i in range(6):
                for j in range(6):
                    own = (near[a][1] > i) & (near[b][1] > j)
                    yield pair << 24 | near[a][0][own, i].astype(np.int64) << 12 | near[b][0][own, j], values[own]

    def mapped(make):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = np.asarray(batch.column(0)).view(np.uint64)
                for keys, own in make(values):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.astype(np.int64)), pa.array(own.view(np.int64))], names=["key", "print"])
        return run

    return tuple(prints.select("print").mapInArrow(mapped(make), "key long, print long") for make in (file, look_up))


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """Pairs a < b of different fingerprints (column print, each once) with at most MOST_ERRORS differing bits."""
    filed, sought = fuzzy_keys(prints)
    filed = filed.select("key", F.col("print").alias("a"))
    sought = sought.select("key", F.col("print").alias("b"))
    close = F.expr(f"a < b and bit_count(a ^ b) <= {MOST_ERRORS}")
    # Spark takes both sides to have as many rows as there are fingerprints and would broadcast up to 108 times as many.
    return filed.join(sought.hint("merge"), (filed["key"] == sought["key"]) & close).select("a", "b").distinct()


def fingerprint_groups(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id, the smallest doc_id that links lead to.

    Rows with the same fingerprint are linked without any search: only different fingerprints are filed and looked up.
    Texts without words have fingerprint zero and are linked like any other. Texts of fewer words than a shingle are one
    shingle. Null keys count for no component's smallest key. Repeated rows come back as often; an empty table gives none.
    """
    rows = store(fingerprints(docs, size, key, text), "fingerprints")
    prints = store(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(fingerprint_links(prints))
    grouped = prints.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "least", F.coalesce("root", "print").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = grouped.join(least, "root").select("print", "component_id")
    return rows.join(classes, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, size: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs (all columns) that `fingerprint_groups` calls the first of their component.

    Of linked rows the one with the smallest key stays; null keys come last, and of rows that agree in their key the one with
    the smallest digest of key and text stays. Rows that agree in key and text are one. All texts without words are one
    component. An empty table gives no rows. Columns of any name come back as they are.
    """
    name = F.col(key).cast("string")
    told = F.coalesce(F.concat(F.length(name), F.lit(":"), name), F.lit("null"))
    digest = F.md5(F.concat(told, F.coalesce(F.concat(F.lit("="), F.col(text)), F.lit(""))).cast("binary"))
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), digest.alias("digest"))
    grouped = fingerprint_groups(docs.select(rank.alias("doc_id"), F.col(text).alias("text")), size)
    chosen = store(grouped.where("doc_id.digest = component_id.digest").groupBy("doc_id.digest").agg(
        F.count("*").alias("rows")), "first-of-each")
    # The texts are shuffled once, at every size alike.
    rows = docs.select(F.struct("*").alias("row"), digest.alias("digest"))
    kept = rows.join(chosen.where("rows = 1").hint("shuffle_hash"), "digest", "left_semi")
    if not chosen.where("rows > 1").isEmpty():
        again = rows.join(chosen.where("rows > 1"), "digest", "left_semi")
        kept = kept.unionAll(again.groupBy("digest").agg(F.first("row").alias("row")).select("digest", "row"))
    return kept.select("row.*")
