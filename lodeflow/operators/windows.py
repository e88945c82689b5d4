"""Ordered computations: fills, running offsets, islands, tagged spans."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema


def _to_now(by: list[str], *order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)


def forward_fill(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """The last value that isn't null, up to and with the row."""
    return df.withColumn(out, F.last(value, True).over(_to_now(by, *order)))


def ffill_2d(cells: DataFrame, table: list[str], row: str, col: str, value: str, out: str) -> DataFrame:
    """Two-axis fill of a grid: along the row from the left first; what is still blank takes the filled cell above."""
    by_row = cells.withColumn("__f", F.last(value, True).over(_to_now([*table, row], col)))
    return by_row.withColumn(out, F.last("__f", True).over(_to_now([*table, col], row))).drop("__f")


def running_start(length: Column, by: list[str], order: list[str], gap: int = 1) -> Column:
    """Where each part begins if the parts are written one after the other with ``gap`` characters between them."""
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(length + gap).over(before), F.lit(0)).cast("long")


def islands(df: DataFrame, by: list[str], order: list[str], same: list[Column], out: str = "island") -> DataFrame:
    """Numbers runs of rows whose ``same`` expressions equal those of the row before."""
    step = Window.partitionBy(*by).orderBy(*order)
    change = F.lit(False)
    for c in same:
        change = change | ~c.eqNullSafe(F.lag(c).over(step))
    return df.withColumn("__c", F.when(change | (F.row_number().over(step) == 1), 1).otherwise(0)).withColumn(out, F.sum("__c").over(_to_now(by, *order))).drop("__c")


def bio_spans(tokens: DataFrame, by: list[str], order: str, tag: str, begin: str, outside: str) -> DataFrame:
    """Spans that begin at a ``begin`` tag and last until the next one or an ``outside`` tag: by, first, last, n."""
    seen = tokens.withColumn("__s", F.sum(F.when(F.col(tag) == begin, 1).otherwise(0)).over(_to_now(by, order)))
    stops = seen.withColumn("__o", F.sum(F.when(F.col(tag) == outside, 1).otherwise(0)).over(_to_now([*by, "__s"], order)))
    return stops.where("__s > 0 and __o = 0").groupBy(*by, "__s").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n")).drop("__s")


def precision_envelope(precision: Column, by: list[str], rank: str) -> Column:
    """Highest precision at this rank or any later one."""
    return F.max(precision).over(Window.partitionBy(*by).orderBy(F.desc(rank)).rowsBetween(Window.unboundedPreceding, 0))


def cumulative(value: Column, by: list[str], *order) -> Column:
    return F.sum(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def batch_ratio(df: DataFrame, ratio: str, size: int, rank: str, out: str = "target") -> DataFrame:
    """Target ratio of fixed-size batches in rank order: the first below 1, the last above 1, else 1."""
    batch = F.floor((F.col(rank) - 1) / size)
    whole = Window.partitionBy(batch).orderBy(rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first, last = F.first(ratio).over(whole), F.last(ratio).over(whole)
    return df.select("*", batch.cast("long").alias("batch"), F.when(last < 1, first).when(first > 1, last).otherwise(F.lit(1.0)).alias(out))


def ranged(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``df`` dealt out by ranges of (by, order), settled, with the number of the range as ``__range``.

    A group as large as the table is so spread over all tasks; ``running`` then works range by range.
    """
    return df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn("__range", F.spark_partition_id()).checkpoint()


def running(parts: DataFrame, by: list[str], order: list[Column], values: dict[str, Column]) -> DataFrame:
    """Running sums, in ``order`` within ``by``, of rows from ``ranged``: sums within each range, and those of the ranges before.

    The sums of ranges are a small table, one row for each group and range, so no task sees a whole group.
    """
    here = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    total = parts.groupBy(*by, "__range").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    carry = total.select(*by, "__range", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__c_{n}") for n in values])
    own = parts.select("*", *[F.sum(v).over(here).alias(n) for n, v in values.items()]).join(carry, [*by, "__range"])
    return own.select(*parts.columns, *[(F.col(n) + F.col(f"__c_{n}")).alias(n) for n in values])


def highest_ahead(parts: DataFrame, by: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """The highest ``value`` at a row or any later one; ``order`` is the opposite of the rows' own order."""
    here = Window.partitionBy(*by, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*by).orderBy(F.desc("__range")).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.groupBy(*by, "__range").agg(F.max(value).alias("__m")).select(*by, "__range", F.max("__m").over(after).alias("__c"))
    own = parts.withColumn(out, F.max(value).over(here)).join(carry, [*by, "__range"])
    return own.select(*parts.columns, F.greatest(out, "__c").alias(out))


#: Rows that a pass over sorted groups gathers before it works on them, so that many small groups share each call of numpy.
GATHERED = 8192


def sorted_groups(df: DataFrame, by: list[str], order: list, each, fields: list[tuple[str, str]]) -> DataFrame:
    """Python over each group's rows in order, without a call of its own for each group: ``by`` and the ``fields`` (name, type) that ``each`` gives.

    ``each(columns, a, b)`` gets the columns of many groups as arrays, and one group's rows as the range a to b; it returns one array for each field.
    """
    def every(columns: dict, cuts: list[int]):
        got = [each(columns, a, b) for a, b in zip(cuts, cuts[1:], strict=False)]
        return [len(x[0]) for x in got], [np.concatenate([x[i] for x in got]) for i in range(len(fields))]

    return sorted_batches(df, by, order, every, fields)


def sorted_batches(df: DataFrame, by: list[str], order: list, every, fields: list[tuple[str, str]]) -> DataFrame:
    """As ``sorted_groups``, but for work that takes many groups at once.

    ``every(columns, cuts)`` gets groups whose rows lie between neighbouring ``cuts``; it returns how many rows each of them gives, and one array for each field.
    A window numbers the rows of each group, and a pass over its sorted output cuts groups where the number is 1; a group must fit a task.
    """
    from pyspark.sql.types import StructField, StructType, _parse_datatype_string

    kinds = _parse_datatype_string(", ".join(f"{n} {t}" for n, t in fields))
    schema = StructType([*[StructField(c, df.schema[c].dataType) for c in by], *kinds.fields])
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    names = [n for n in df.columns if n not in by]

    def run(batches):
        arrow = to_arrow_schema(schema)
        held, rows, enough = [], 0, GATHERED

        def out(table: pa.Table, cuts: list[int]):
            if len(cuts) < 2:
                return
            n, got = every({c: table.column(c).to_numpy() for c in names}, cuts)
            at = pa.array(np.repeat(cuts[:-1], n), pa.int64())
            keys = [table.column(c).take(at).combine_chunks() for c in by]
            made = [pa.array(x, arrow.field(len(by) + i).type) for i, x in enumerate(got)]
            yield from pa.Table.from_arrays([*[k.cast(arrow.field(i).type) for i, k in enumerate(keys)], *made], schema=arrow).to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            starts = np.flatnonzero(table.column("__r").to_numpy() == 1).tolist()
            yield from out(table, starts)
            held = table.slice(starts[-1] if starts else 0).to_batches()
            rows = sum(b.num_rows for b in held)
            enough = max(GATHERED, 2 * rows)
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from out(table, [*np.flatnonzero(table.column("__r").to_numpy() == 1).tolist(), table.num_rows])

    return ranked.mapInArrow(run, schema)


def padded(*groups: tuple[np.ndarray, np.ndarray], cells: int = 1 << 15):
    """Runs of groups as padded tables. ``groups`` are (start, size) of the groups' rows, for one or more kinds of rows; each yield is (first group, end group,
    places of each kind), places being (group, place) row numbers with -1 where a group has fewer. A run's groups times the square of its largest one stay within ``cells``, or it is one group.
    """
    largest = np.maximum.reduce([size for _, size in groups]).astype(np.int64)
    at = 0
    while at < len(largest):
        most = np.maximum.accumulate(largest[at : at + cells])
        n = max(1, int(np.searchsorted(most**2 * np.arange(1, len(most) + 1), cells, side="right")))
        out = []
        for start, size in groups:
            place = np.arange(max(int(size[at : at + n].max()), 1))
            out.append(np.where(place[None, :] < size[at : at + n, None], start[at : at + n, None] + place[None, :], -1))
        yield at, at + n, out
        at += n
