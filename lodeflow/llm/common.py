"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lodeflow.session import prepare

#: Rows turned into Python objects at once; bounds a worker's memory for long texts.
SLICE_ROWS = 256


def map_rows(df: DataFrame, cols: list[str], schema: str, make: Callable[[], Callable]) -> DataFrame:
    """Run Python over ``cols`` of every row, Arrow batch by Arrow batch.

    ``make()`` is called once per task and returns a function that takes one list per input
    column and returns one list per output column of ``schema``.
    """
    prepare(df.sparkSession)
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = list(to_arrow_schema(kind))
        f = make()
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(i, SLICE_ROWS)
                out = f(*[part.column(k).to_pylist() for k in range(part.num_columns)])
                yield pa.RecordBatch.from_arrays([pa.array(v, type=x.type) for v, x in zip(out, fields, strict=True)], names=[x.name for x in fields])

    return df.select(*cols).mapInArrow(run, kind)


def settle(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, which outlives a lost executor."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df`` (case doesn't count)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` holds at most ``rows`` rows; reads no more than it must to tell."""
    return df.limit(rows + 1).count() <= rows


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int) -> DataFrame:
    """Join that broadcasts ``right`` only after counting it to be at most ``rows`` rows."""
    return left.join(F.broadcast(right) if small(right, rows) else right, on, how)


def session(df: DataFrame) -> SparkSession:
    return prepare(df.sparkSession)
