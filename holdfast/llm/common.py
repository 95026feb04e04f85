"""What the operators of this package share: table access, Arrow mapping, text bytes."""

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters `\x20\x09-\x0D`, which end a word.
SPACES = " \t\n\x0b\x0c\r"

#: Texts are taken from an Arrow batch in slices of about this many bytes, so one call's Python objects stay small.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Columns of the table documents.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def neutral(docs: DataFrame) -> DataFrame:
    """The rows with all columns but those of DOCUMENT renamed by place, so that none is called like a result."""
    return docs.toDF(*[c if c in DOCUMENT else f"_extra_{i}" for i, c in enumerate(docs.columns)])


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of docs, by their names, of rows made of neutral(docs)."""
    return rows.select(neutral(docs).columns).toDF(*docs.columns)


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


#: Name of the text column in Arrow batches, so that other columns may be called `text`.
TEXT = "_whole_text"


def slices(batch: pa.RecordBatch, name: str = TEXT) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in runs of rows whose texts sum to about SLICE_BYTES, each with its texts as bytes."""
    column = batch.column(batch.schema.get_field_index(name))
    lengths = column.cast(pa.binary())
    start, size = 0, 0
    for row, value in enumerate(lengths):
        size += len(value.as_buffer() or b"") if value.is_valid else 0
        if size >= SLICE_BYTES:
            part = batch.slice(start, row + 1 - start)
            yield part, bytes_of(column.slice(start, row + 1 - start))
            start, size = row + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start), bytes_of(column.slice(start))


_ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
          "binary": pa.binary()}


def arrow_array(values: list | pa.Array, kind: str) -> pa.Array:
    """Values of a Spark type; the type is given, since a run of nulls or empty lists does not show it."""
    if isinstance(values, pa.Array):
        return values
    return pa.array(values, pa.list_(_ARROW[kind[6:-1]]) if kind.startswith("array<") else _ARROW[kind])


def map_texts(
    df: DataFrame, keep: list[str], added: str, work: Callable[[list[bytes]], list[list]], text: str = "text",
) -> DataFrame:
    """Columns `keep` of each row, and those that `work` makes of the texts: a list of values for each added column."""
    fields = df.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [added])
    names, kinds = zip(*(part.split() for part in added.split(",")))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch):
                made = work(texts)
                columns = [part.column(i) for i in range(len(keep))] + [arrow_array(values, kind) for values, kind in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *names])

    return df.select(*keep, F.col(text).alias(TEXT)).mapInArrow(mapped, schema)
