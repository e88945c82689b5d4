"""Registered queries of this subpackage, and the DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodeflow.llm import ann, decontaminate, fim, knn, langid, linededup, packing, pii, quality, secrets, simhash, spelling, tokencount
from lodeflow.session import prepare, table


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", spans.alias("spans"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_pages(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), tokencount.vocabulary(tokenizer_file("piece_bpe_32k.model")))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.fill_in_middle(table(spark, sf_dir, "documents")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [op1_decontamination, op2_language_id, op3_simhash, op4_top_k, op5_quality, op6_secrets, op7_token_counts, op8_line_dedup, op9_packing, op10_pii, op11_spelling_variants, op12_nearest_neighbours, op13_fill_in_middle, language_id_pages, pipeline]

    def prepared(f):
        return lambda spark, sf_dir: f(prepare(spark), sf_dir)

    return {f.__name__: prepared(f) for f in named}


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_OP1 = f"""
with d as materialized (select doc_id, row_number() over () as r, text, {_SQL_WORDS} as w from documents),
b as (select item_id, {_SQL_WORDS} as w from benchmark where item_id is not null),
win as materialized (select distinct item_id, least(8, len(w)) as n, array_to_string(w[i : i + least(8, len(w)) - 1], ' ') as s
        from (select item_id, w, unnest(range(1, greatest(len(w) - 7, 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct n from win),
dw as materialized (select r, w, i, n from (select r, w, unnest(range(1, len(w) + 1)) as i from d where len(w) > 0), sizes where i + n - 1 <= len(w)),
hit as materialized (select dw.r, dw.i, dw.n, win.item_id from dw join win on win.n = dw.n and win.s = array_to_string(dw.w[dw.i : dw.i + dw.n - 1], ' ')),
spot as materialized (select distinct r, unnest(range(i, i + n)) as p from hit),
pos as (select r, count(*) as n_hit from spot group by r),
piece as (select r, i, body, sum(len(body)) over (partition by r order by i) as e from (select r, unnest(p) as body, unnest(range(len(p))) as i from
  (select r, string_split(regexp_replace(translate(text, chr(2), chr(3)), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', chr(2) || '\\0' || chr(2), 'g'), chr(2)) as p from d where r in (select r from spot)))),
word as (select r, (i + 1) // 2 as p, e - len(body) as s, e from piece where i % 2 = 1),
span as (select r, min(s) as s, max(e) as e from (select r, s, e, p - row_number() over (partition by r order by p) as g from spot join word using (r, p)) group by r, g),
spans as (select r, string_agg(s || ':' || e, ',' order by s) as spans from span group by r),
items as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, cast(item_id as varchar) as id from hit) group by r)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_items, 0) >= 2 as contaminated, coalesce(spans, '') as spans
from d left join pos using (r) left join items using (r) left join spans using (r)
"""

_OP4 = """
with v as materialized (select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
        from embeddings where vec_id is not null and embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as score
      from v q, v c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, cast(score as bigint) as score from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""


def _sql_spans(kind: str, pattern: str, valid: str, text: str = "t") -> str:
    """Spans of one kind: matches are put between marks, and offsets are sums of the lengths of what lies before."""
    alone, more, context = pii.SCORES[kind]
    return f"""select r, '{kind}' as kind, pos as s, pos + len(body) as e,
      {round(alone * 100)} + case when regexp_matches(lower(substr(t, cast(greatest(pos + 1 - {pii.CONTEXT}, 1) as bigint), cast(least(pos, {pii.CONTEXT}) as bigint)) || ' ' || substr(t, cast(pos + len(body) + 1 as bigint), {pii.CONTEXT})), '{context}') then {round(more * 100)} else 0 end as score from (
      select m.*, d.t from (
      select r, body, i, sum(len(body)) over (partition by r order by i) - len(body) as pos from (
        select r, unnest(p) as body, unnest(range(len(p))) as i from (
          select r, string_split(regexp_replace({text}, '{pattern}', chr(2) || '\\0' || chr(2), 'g'), chr(2)) as p from d))) m
      join d using (r) where i % 2 = 1 and ({valid}))"""


_DIGITS = "regexp_replace(body, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(len({_DIGITS})), lambda k: list_extract([0,1,2,3,4,5,6,7,8,9,0,2,4,6,8,1,3,5,7,9], cast(substr({_DIGITS}, len({_DIGITS}) - k, 1) as integer) + 10 * (k % 2) + 1))) % 10 = 0"
_TURNED = "regexp_replace(substr(replace(body, ' ', ''), 5) || substr(replace(body, ' ', ''), 1, 4), ' ', '', 'g')"
_MOD97 = f"len(replace(body, ' ', '')) <= 34 and list_reduce(list_prepend(0, list_transform(string_split({_TURNED}, ''), lambda c: case when c between '0' and '9' then ord(c) - 48 else ord(c) - 55 end)), lambda a, v: case when v < 10 then (a * 10 + v) % 97 else (a * 100 + v) % 97 end) = 1"

#: chr(2) marks matches; in a text it becomes chr(3), which no pattern knows either.
_OP10 = f"""
with d as materialized (select doc_id, row_number() over () as r, translate(coalesce(text, ''), chr(2), chr(3)) as t from documents),
spans as materialized (
  {_sql_spans("email", "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", "true")} union all
  {_sql_spans("ip", "[0-9]+(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)", "list_max(list_transform(string_split(body, '.'), lambda x: cast(x as hugeint))) <= 255")} union all
  {_sql_spans("card", "[0-9](?:[\\x20-]?[0-9])+", f"len({_DIGITS}) between 16 and 19 and {_LUHN}")} union all
  {_sql_spans("phone", "\\+[0-9][\\x20().0-9-]+[0-9]", f"len({_DIGITS}) between 8 and 15")} union all
  {_sql_spans("iban", "\\b[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]){11,30}\\b", _MOD97)}),
g as (select r, count(*) filter (where kind = 'email') as n_email, count(*) filter (where kind = 'ip') as n_ip,
       count(*) filter (where kind = 'card') as n_card, count(*) filter (where kind = 'phone') as n_phone,
       string_agg(kind || ':' || s || ':' || e, ',' order by list_position(['email','ip','card','phone','iban'], kind), s) filter (where kind <> 'iban') as base,
       string_agg(kind || ':' || s || ':' || e, ',' order by list_position(['email','ip','card','phone','iban'], kind), s) as spans,
       string_agg(score, ',' order by list_position(['email','ip','card','phone','iban'], kind), s) as scores
      from spans group by r)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(scores, '') as scores
from d left join g using (r)
"""


#: Near words meet here on what is left when one character is deleted; crc32 is computed from bits, for each distinct document and run.
_OP11 = r"""
with recursive crc as materialized (select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda a, k: case when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c from range(256) r(i))),
runs as materialized (select doc_id, run, count(*) as n from (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents) where len(run) >= 5 group by all),
hashed as (select run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h) + 1, 2), lambda i: (position(h[i] in '0123456789ABCDEF') - 1) * 16 + position(h[i + 1] in '0123456789ABCDEF') - 1)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) as h from (select run, n, hex(encode(concat(coalesce(cast(doc_id as varchar), ''), ':', run))) as h from runs), crc),
v as materialized (select row_number() over (order by word) as id, word, cast(sum(n) as bigint) as n from (select case when h % 97 = 0 then substr(run, 1, h % len(run)) || substr(run, h % len(run) + 2) else run end as word, n from hashed)
       where len(word) >= 5 group by word having sum(n) >= 3),
cut as materialized (select distinct id, word, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select id, word, unnest(range(1, len(word) + 1)) as i from v)),
pair as (select distinct a.id as x, b.id as y from cut a join cut b on a.i = b.i and a.rest = b.rest and a.id <> b.id),
short as (select distinct a.id as x, b.id as y from cut a join v b on a.rest = b.word),
near as materialized (select x, y from pair union all select x, y from short union all select y, x from short),
best as materialized (select x, count(*) as n_near, arg_max(y, struct_pack(n := b.n, id := -b.id)) as y, max(b.n) as m from near join v b on b.id = y group by x),
form as materialized (select v.id, b.y from v join best b on b.x = v.id where b.m >= 2 * v.n),
chain as (select id, y, 1 as d from form union all select c.id, f.y, d + 1 from chain c join form f on f.id = c.y),
root as (select id, arg_max(y, d) as y from chain group by id)
select v.word, f.word as form, coalesce(r.word, v.word) as root, v.n, cast(coalesce(b.n_near, 0) as bigint) as n_near, f.n as form_n
from v left join best b on b.x = v.id left join form on form.id = v.id left join v f on f.id = form.y left join root on root.id = v.id left join v r on r.id = root.y
"""

#: The pieces are found by lengths: a unit's end is the running sum of lengths, and a prefix is what lies before it.
_OP13 = r"""
with d as materialized (select doc_id, row_number() over () as r, coalesce(text, '') as t, sha256('42:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
u as materialized (select r, t, h, doc_id, list_transform(regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+'), lambda x: length(x)) as sizes from d),
c as (select *, len(sizes) as n, list_transform([1, 9, 17, 25], lambda i: list_reduce(list_prepend(0, list_transform(string_split(substr(h, i, 8), ''), lambda x: position(x in '0123456789abcdef') - 1)), lambda a, x: a * 16 + x)) as g from u),
f as (select *, g[1] % (n + 1) as one, g[2] % (n + 1) as two,
        case when t = '' or regexp_matches(t, '<[PSM]>') or g[3] % 100 >= 50 then 'plain' when g[4] % 100 < 80 then 'spm' else 'psm' end as form from c),
l as (select *, coalesce(list_sum(sizes[1 : least(one, two)]), 0) as p, coalesce(list_sum(sizes[1 : greatest(one, two)]), 0) as q from f),
o as (select *, substr(t, 1, cast(p as bigint)) as prefix, substr(t, cast(p + 1 as bigint), cast(q - p as bigint)) as middle, substr(t, cast(q + 1 as bigint)) as suffix from l)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(p as bigint) end as prefix_chars, case when form <> 'plain' then cast(q - p as bigint) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then concat('<P>', prefix, '<S>', suffix, '<M>', middle) else concat('<S>', suffix, '<P>', prefix, '<M>', middle) end) as output_sha256,
       sha256(t) as restored_sha256
from o
"""


def oracle_sql() -> dict[str, str]:
    """The others (trained, hashed or sequential) are tested against brute force in tests/llm."""
    return {"op1_decontamination": _OP1, "op4_top_k": _OP4, "op10_pii": _OP10, "op11_spelling_variants": _OP11, "op13_fill_in_middle": _OP13}
