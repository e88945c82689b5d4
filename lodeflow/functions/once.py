"""Expressions that are evaluated once a row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """An expression over a value that is made once a row, however often the body reads it: a lambda holds it."""
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are made once a row: the optimizer doesn't copy them into the expressions that read them.

    Expressions with many patterns or branches are otherwise repeated for each use, until a generated method passes the
    64 KB that a JVM compiles. A generator over one struct stands between, and its lambda keeps the body out of generated code.
    """
    made = F.transform(F.array(F.lit(0)), lambda _: F.struct(*[c.alias(n) for n, c in columns.items()]))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    held = df.select("*", F.explode(made).alias("__once"))
    return held.select(*kept, *[F.col(f"__once.{n}").alias(n) for n in columns])
