"""Helpers shared by the operators: column names, word counts, Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, shuffles_removed  # noqa: F401

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Parts of a batch, so that what a function makes of it is small; an empty batch has none."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def release() -> None:
    """Give unused memory back to the system: Spark's Python workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    library = ctypes.CDLL(None)
    if hasattr(library, "malloc_trim"):
        library.malloc_trim(0)


def add_struct(df: DataFrame, source: str, into: str, kind: T.StructType, of: Callable[[str | None], tuple], state: Callable = None) -> DataFrame:
    """``df`` with a struct column computed row by row from one text column, batch by batch.

    ``of`` gets the text, or None, and returns the struct's fields as a tuple. With
    ``state``, ``of`` also gets what ``state()`` made once for each task. A batch
    holds no more than Spark's Arrow batch; a text is a whole text.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(into, kind)])
    fields = kind.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in kind.fields]
        held = state() if state else None
        for whole in batches:
            for batch in slices(whole):
                texts = batch.column(batch.schema.get_field_index(source))
                rows = [of(t.as_py(), held) if state else of(t.as_py()) for t in texts]
                columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), types)]
                made = pa.StructArray.from_arrays(columns, names=fields)
                yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, into])
        release()

    return df.mapInArrow(run, schema)
