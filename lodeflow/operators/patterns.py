"""Many named patterns over texts at once: a table of patterns, a prefilter by literals, spans in list order."""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType


def pattern_table(lists: dict[str, DataFrame], line: str = "line", place: str = "place") -> DataFrame:
    """kind, place, pattern of list files (one pattern a line, ``place`` its number): ``lists`` in the order of precedence."""
    out = None
    for rank, (kind, df) in enumerate(lists.items()):
        part = df.select(F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), F.col(place).cast("int").alias("place"), F.col(line).alias("pattern"))
        out = part if out is None else out.unionByName(part)
    return out


def needed_literals(pattern: str) -> list[str]:
    """Texts of which one at least stands in everything that the pattern matches: the best that its sequence of parts tells; none if nothing can be told."""

    def best(options: list[list[str]]) -> list[str]:
        return max((o for o in options if o and all(o)), key=lambda o: (min(map(len, o)), -len(o)), default=[])

    def of(parts) -> list[str]:
        options, run = [], ""
        for op, arg in parts:
            if op is C.LITERAL:
                run += chr(arg)
                continue
            options.append([run])
            run = ""
            if op is C.SUBPATTERN and not arg[1] and not arg[2]:
                options.append(of(arg[3]))
            elif op is C.BRANCH:
                each = [of(x) for x in arg[1]]
                options.append([t for x in each for t in x] if all(each) else [])
            elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT) and arg[0] > 0:
                options.append(of(arg[2]))
        return best([*options, [run]])

    parsed = _parser.parse(pattern)
    return [] if parsed.state.flags & re.IGNORECASE else of(parsed)


class Scanner:
    """Compiled patterns in their order; a pattern runs over a text only if one of the literals that it needs is there."""

    def __init__(self, rows: list[tuple[str, int, str]], group: int):
        self.rows, self.group = [(kind, place, re.compile(p), needed_literals(p)) for kind, place, p in rows], group
        self.literals = sorted({x for *_, needed in self.rows for x in needed})

    def spans(self, text: str) -> list[tuple[str, int, int, int, bool]]:
        """(kind, place, start, end, kept), by start, then end, then order: ``kept`` are those that no earlier one of the order overlaps, taken in that order."""
        there = {x for x in self.literals if x in text}
        found, taken, out = [], [], []
        for order, (kind, place, pattern, needed) in enumerate(self.rows):
            if not needed or not there.isdisjoint(needed):
                for m in pattern.finditer(text):
                    g = self.group if pattern.groups >= self.group else 0
                    if m.start(g) >= 0:
                        found.append((order, m.start(g), m.end(g), kind, place))
        for order, a, b, kind, place in found:
            kept = not any(x < b and a < y for x, y in taken)
            if kept:
                taken.append((a, b))
            out.append((a, b, order, kind, place, kept))
        return [(kind, place, a, b, kept) for a, b, _, kind, place, kept in sorted(out)]


def scan(texts: DataFrame, patterns: DataFrame, by: list[str], text: str, group: int = 2) -> DataFrame:
    """``by``, kind, place, start, end, mention, kept: all matches of all patterns (rank, kind, place, pattern) in each text.

    A span is that of the pattern's group ``group`` (of the whole match where it has fewer). A table of patterns is a configuration: it is collected and compiled once a task.
    Null texts, and patterns that match nothing, give no rows; an empty table of patterns or texts gives none.
    """
    rows = [(r["kind"], r["place"], r["pattern"]) for r in patterns.where("pattern is not null and pattern <> ''").orderBy("rank", "place").collect()]
    kind = StructType([*[texts.schema[c] for c in by], StructField("kind", StringType()), StructField("place", IntegerType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("mention", StringType()), StructField("kept", BooleanType())])

    def run(batches):
        scanner, fields = Scanner(rows, group), to_arrow_schema(kind)
        for b in batches:
            got = [(i, *s, t[s[2] : s[3]]) for i, t in enumerate(b.column(b.num_columns - 1).to_pylist()) if t for s in scanner.spans(t)]
            i, kinds, places, starts, ends, kept, mentions = zip(*got, strict=True) if got else ((),) * 7
            at = pa.array(i, pa.int64())
            arrays = [b.column(k).take(at).cast(fields.field(k).type) for k in range(len(by))] + [pa.array(kinds, pa.string()), pa.array(places, pa.int32()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(mentions, pa.string()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, schema=fields)

    return texts.select(*by, text).mapInArrow(run, kind)
