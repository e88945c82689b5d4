"""Joins along an order: nearest as-of, spans that hold a position, neighbours within a distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def nearest_asof(left: DataFrame, right: DataFrame, by: list[str], at: str, value: list[str], tie: list[str] | None = None) -> DataFrame:
    """Each left row with the right row of the same ``by`` whose ``at`` is nearest; on an equal distance the later one.

    Both sides are laid in one order per key and the neighbours come from two running windows, one each way, so no pairs
    are made: one shuffle and two sorts, in time linear in the sides but for these. Left rows without a right row keep nulls. Of right rows
    with equal ``at``, the last by ``tie`` serves later left rows and the first serves earlier ones.
    Result: the left columns, then ``value`` of the chosen row as ``near_<name>`` and its ``at`` as ``near_<at>``.
    """
    tie = tie or value
    own = left.columns
    rest = F.struct(*[F.col(c) for c in [at, *value]])
    kind = right.select(rest.alias("r")).schema["r"].dataType
    ranks = [F.col(c).alias(f"__t{i}") for i, c in enumerate(tie)]
    a = left.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col(at).alias("__at"), F.lit(0).alias("__side"), F.struct(*own).alias("__l"), F.lit(None).cast(kind).alias("__r"), *[F.lit(None).cast(right.schema[c].dataType).alias(f"__t{i}") for i, c in enumerate(tie)])
    b = right.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], F.col(at).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast(a.schema["__l"].dataType).alias("__l"), rest.alias("__r"), *ranks)
    ties = [f"__t{i}" for i in range(len(tie))]
    key = Window.partitionBy(*[f"__k{i}" for i in range(len(by))])
    up, down = key.orderBy("__at", "__side", *ties), key.orderBy(F.desc("__at"), F.desc("__side"), *[F.desc(t) for t in ties])
    # a frame that ends at the row is kept up to date; one that begins there would be read anew for each row
    seen = a.unionByName(b).withColumn("__b", _last_so_far("__r", up)).withColumn("__a", _last_so_far("__r", down))
    back, ahead = _gap(F.col("__at"), F.col("__b")[at], kind[at].dataType), _gap(F.col("__a")[at], F.col("__at"), kind[at].dataType)
    pick = F.when(F.col("__a").isNull() | (back < ahead), F.col("__b")).otherwise(F.col("__a"))
    return seen.where("__side = 0").select("__l.*", pick.alias("__p")).select(*own, F.col("__p")[at].alias(f"near_{at}"), *[F.col("__p")[c].alias(f"near_{c}") for c in value])


def _last_so_far(value: str, order: WindowSpec) -> Column:
    return F.last(value, True).over(order.rowsBetween(Window.unboundedPreceding, 0))


def _gap(high: Column, low: Column, kind) -> Column:
    if kind.typeName().startswith("timestamp"):
        return F.timestamp_diff("MICROSECOND", low, high)
    return high - low


def span_index(starts: Column, position: Column) -> Column:
    """Number (from 0) of the span that holds a position, given the sorted starts of adjoining spans; -1 before the first."""
    return F.size(F.filter(starts, lambda s: s <= position)) - 1


def same_span(starts: Column, a: Column, b: Column) -> Column:
    """Whether two positions lie in one span."""
    return span_index(starts, a) == span_index(starts, b)


def span_lookup(points: DataFrame, spans: DataFrame, by: list[str], at: str, start: str, value: list[str]) -> DataFrame:
    """Each point with the last span of the same ``by`` that starts at or before it (null before the first).

    One order per key over both sides and a running window, as for long lists of spans the array form would scan each.
    """
    kind = spans.select(F.struct(start, *value).alias("s")).schema["s"].dataType
    a = points.select(*by, F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(*points.columns).alias("__p"), F.lit(None).cast(kind).alias("__s"))
    b = spans.select(*by, F.col(start).alias("__at"), F.lit(0).alias("__side"), F.lit(None).cast(a.schema["__p"].dataType).alias("__p"), F.struct(start, *value).alias("__s"))
    order = Window.partitionBy(*by).orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, 0)
    seen = a.unionByName(b).withColumn("__f", F.last("__s", True).over(order)).where("__side = 1")
    return seen.select("__p.*", *[F.col("__f")[c].alias(f"span_{c}") for c in [start, *value]])


def inside_spans(points: DataFrame, spans: DataFrame, by: list[str], at: str, start: str, end: str) -> DataFrame:
    """Points with ``inside``: whether the last span that starts at or before them ends after them."""
    found = span_lookup(points, spans, by, at, start, [end])
    return found.withColumn("inside", F.coalesce(F.col(f"span_{end}") > F.col(at), F.lit(False))).drop(f"span_{start}", f"span_{end}")


def neighbour_within(rows: DataFrame, by: list[str], start: str, end: str, value: str, gap: int = 5, first: int = 0, last: int = 10_000) -> DataFrame:
    """Rows with ``near``: the value of the nearer of two neighbours, if it is less than ``gap`` away, else null.

    The one before is that with the greatest end below the row's start, the one after that with the least start above
    its end; on equal distances the one after counts. Where there is none, its place is read as ``first`` or ``last``
    (a row near the front of a text is so near to nothing). Of several in one place the first by start and end counts.
    Rows with null places have no neighbours.
    """
    key = [F.col(c).alias(f"__k{i}") for i, c in enumerate(by)]
    place = F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(value).alias("v"))
    own = F.struct(*rows.columns)
    kinds = rows.select(own.alias("o"), place.alias("p")).schema
    none = {n: F.lit(None).cast(kinds[n].dataType) for n in ("o", "p")}
    w = Window.partitionBy(*[f"__k{i}" for i in range(len(by))])

    def points(at: str, o: Column, p: Column, side: int) -> DataFrame:
        return rows.select(*key, F.col(at).alias("__at"), F.lit(side).alias("__side"), o.alias("__o"), p.alias("__p"))

    ends = points(start, own, none["p"], 0).unionByName(points(end, none["o"], place, 1))
    back = ends.withColumn("__b", _last_so_far("__p", w.orderBy("__at", "__side", F.desc("__p.s"), F.desc("__p.e")))).where("__side = 0")
    asks = back.select(*[f"__k{i}" for i in range(len(by))], F.col(f"__o.{end}").alias("__at"), F.lit(0).alias("__side"), "__o", none["p"].alias("__p"), "__b")
    both = asks.unionByName(points(start, none["o"], place, 1).withColumn("__b", none["p"]))
    seen = both.withColumn("__a", _last_so_far("__p", w.orderBy(F.desc("__at"), "__side", F.desc("__p.e")))).where("__side = 0")
    before = F.col(f"__o.{start}") - F.coalesce("__b.e", F.lit(first))
    after = F.coalesce("__a.s", F.lit(last)) - F.col(f"__o.{end}")
    near = F.when((before < after) & (before < gap), F.col("__b.v")).when((before >= after) & (after < gap), F.col("__a.v"))
    return seen.select("__o.*", near.alias("near"))
