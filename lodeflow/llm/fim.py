"""Fill-in-the-middle transformation: DuckDB inside mapInArrow, one SQL statement over each Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lodeflow.llm.common import session

#: Marks before prefix, suffix and middle. None holds another or begins as one ends, so the places of three of them in an output are certain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit: blanks and the word behind them, or the blanks at the end.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
#: Rows and bytes of text that DuckDB holds at once (one row at least).
SLICE_ROWS = 256
SLICE_BYTES = 8 << 20

_TRANSFORM = f"""
with hashed as (
  select id, coalesce(text, '') as text, sha256('{{seed}}:' || coalesce(cast(id as varchar), '')) as h from batch),
units as (
  select id, text, h, regexp_extract_all(text, '{UNIT}') as units from hashed),
drawn as (
  select id, text, units, len(units) as n,
         cast('0x' || substr(h, 1, 8) as ubigint) % (len(units) + 1) as one, cast('0x' || substr(h, 9, 8) as ubigint) % (len(units) + 1) as two,
         case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}')
                or cast('0x' || substr(h, 17, 8) as ubigint) % 100 >= {{moved}} then 'plain'
              when cast('0x' || substr(h, 25, 8) as ubigint) % 100 < {{suffix_first}} then 'spm' else 'psm' end as form
  from units),
cut as (
  select id, n, form, text,
         case when form <> 'plain' then array_to_string(list_slice(units, 1, least(one, two)), '') end as prefix,
         case when form <> 'plain' then array_to_string(list_slice(units, least(one, two) + 1, greatest(one, two)), '') end as middle,
         case when form <> 'plain' then array_to_string(list_slice(units, greatest(one, two) + 1, n), '') end as suffix
  from drawn)
select id, cast(n as bigint) as n, form, cast(length(prefix) as bigint) as prefix_chars, cast(length(middle) as bigint) as middle_chars,
       case form when 'plain' then text
                 when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle
                 else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end as output
from cut
"""

_RESTORE = f"""
with halves as (
  select id, n, form, prefix_chars, middle_chars, output,
         case when form <> 'plain' then string_split(output, '{MIDDLE}') end as m,
         case form when 'psm' then string_split(string_split(output, '{MIDDLE}')[1], '{SUFFIX}')
                   when 'spm' then string_split(string_split(output, '{MIDDLE}')[1], '{PREFIX}') end as p
  from batch)
select id, n, form, prefix_chars, middle_chars, output,
       case form when 'plain' then output
                 when 'psm' then substr(p[1], {len(PREFIX) + 1}) || m[2] || p[2]
                 else p[2] || m[2] || substr(p[1], {len(SUFFIX) + 1}) end as restored
from halves
"""


def _slices(batch: pa.RecordBatch, col: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch: SLICE_ROWS rows at most, and SLICE_BYTES of the column or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (held + size > SLICE_BYTES or i - start >= SLICE_ROWS):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def sql_batches(df: DataFrame, statement: str, schema: str, text: int) -> DataFrame:
    """Run a DuckDB statement over every Arrow batch of ``df``, known to it as ``batch``; column number ``text`` is the wide one.

    The statement must give one row for each row by itself, as batches are cut anywhere. A task has one
    connection with one thread, no disk and one slice of a batch, so a worker's memory is bounded by SLICE_BYTES or its longest text.
    """
    session(df)
    kind = _parse_datatype_string(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        fields = to_arrow_schema(kind)
        with duckdb.connect(config={"threads": 1, "temp_directory": ""}) as con:
            for whole in batches:
                for part in _slices(whole, text):
                    con.register("batch", pa.Table.from_batches([part]))
                    found = con.sql(statement).to_arrow_table().cast(fields)
                    con.unregister("batch")
                    yield from found.to_batches()

    return df.mapInArrow(run, kind)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, moved: int = 50, suffix_first: int = 80) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output``: each whole text as a training example with its middle at the end.

    A text is cut into ``n`` units; the first two numbers of sha256('seed:id') choose the two cuts, the third whether the text is
    transformed at all (``moved`` of 100), the fourth whether the suffix stands first (form ``spm``, ``suffix_first`` of 100)
    or the prefix (``psm``). Texts that are empty or hold a mark stay ``plain``, so an output can always be read back.
    The result depends on a row's id and text alone, so a task that is run again gives the same.
    Defined results: a null text counts as empty (``plain``, n = 0, lengths null); a null id is hashed as an empty one and stays
    null; repeated rows each give their row; an empty table gives none; texts of any length are read whole;
    other columns, whatever their names, are not read.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    statement = _TRANSFORM.replace("{seed}", str(int(seed))).replace("{moved}", str(int(moved))).replace("{suffix_first}", str(int(suffix_first)))
    out = sql_batches(rows, statement, "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string", 1)
    return out.withColumnRenamed("id", id_col)


def restore(examples: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The examples with ``restored``, the text read back from ``output`` and ``form`` alone. Nulls stay null; an empty table gives no rows."""
    rows = examples.select(F.col(id_col).alias("id"), "n", "form", "prefix_chars", "middle_chars", "output")
    out = sql_batches(rows, _RESTORE, "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, restored string", 5)
    return out.withColumnRenamed("id", id_col)


def digest(examples: DataFrame) -> DataFrame:
    """The query's columns: lengths and hashes of outputs and of the texts read back from them."""
    return restore(examples).select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
