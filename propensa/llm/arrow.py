"""Small helpers for Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts are turned into Python strings in slices of at most this many
#: characters (one text more at most), so that a batch is never held twice.
SLICE_CHARS = 4_000_000


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut a batch into runs of rows with their texts (null: empty)."""
    lengths = [n.as_py() or 0 for n in pa.compute.binary_length(batch.column(column))]
    start, size = 0, 0
    for i, n in enumerate(lengths):
        size += n
        if size >= SLICE_CHARS or i + 1 == len(lengths):
            part = batch.slice(start, i + 1 - start)
            yield part, [x or "" for x in part.column(column).to_pylist()]
            start, size = i + 1, 0


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def field_type(docs: DataFrame, column: str) -> str:
    return docs.schema[column].dataType.simpleString()


def aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rename all columns but ``used``, so that an operator's own columns
    cannot clash with them; and how to get the columns back, in order."""
    names = {c: c if c in used else f"own {i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select([docs[f"`{c}`"].alias(new) for c, new in names.items()])
    return renamed, lambda df: df.select([F.col(f"`{new}`").alias(c) for c, new in names.items()])
