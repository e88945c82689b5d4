"""Queries over joins along an order, fills, islands, keyed choices and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeflow.operators import asof, dictionary, keyed, windows
from lodeflow.registry import query
from lodeflow.session import table
from lodeflow.functions import text as T


@query("j1_nearest_asof", """
with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
e as (select event_id as eid, user_id, ts from events where event_type = 'error'),
b as (select p.event_id, p.user_id, p.ts, e.eid as beid, e.ts as bts from p asof left join e on p.user_id = e.user_id and p.ts > e.ts),
a as (select p.event_id, e.eid as aeid, e.ts as ats from p asof left join e on p.user_id = e.user_id and p.ts <= e.ts)
select b.event_id, b.user_id, case when aeid is null or epoch_us(b.ts) - epoch_us(bts) < epoch_us(ats) - epoch_us(b.ts) then beid else aeid end as near_event
from b join a using (event_id)
""")
def j1_nearest_asof(spark, d):
    e = table(spark, d, "events")
    p = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    near = e.where("event_type = 'error'").select(F.col("event_id").alias("eid"), "user_id", "ts")
    return asof.nearest_asof(p, near, ["user_id"], "ts", ["eid"]).select("event_id", "user_id", F.col("near_eid").alias("near_event"))


_LINES_SQL = """lines as materialized (select doc_id, i as sent_idx, text, coalesce(sum(length(text) + 1) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as start
  from (select doc_id, unnest(p) as text, unnest(range(len(p))) as i from (select doc_id, string_split(text, chr(10)) as p from documents)))"""


def _lines(spark, d) -> DataFrame:
    s = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("sent_idx", "text"))
    return s.withColumn("start", windows.running_start(F.length("text"), ["doc_id"], ["sent_idx"]))


@query("w4_running_offsets", f"with {_LINES_SQL} select doc_id, cast(sent_idx as integer) as sent_idx, cast(start as bigint) as start, cast(length(text) as integer) as len from lines")
def w4_running_offsets(spark, d):
    return _lines(spark, d).select("doc_id", "sent_idx", "start", F.length("text").alias("len"))


@query("j2_span_lookup", f"""with {_LINES_SQL}, q as (select doc_id, k, n_chars * k // 4 as pos from documents, (values (1), (2), (3)) t(k))
select q.doc_id, q.k, q.pos, cast(l.sent_idx as integer) as sent_idx from q asof join lines l on q.doc_id = l.doc_id and q.pos >= l.start""")
def j2_span_lookup(spark, d):
    q = table(spark, d, "documents").select("doc_id", "n_chars", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("k")).select("doc_id", "k", F.expr("n_chars * k div 4").alias("pos"))
    return asof.span_lookup(q, _lines(spark, d), ["doc_id"], "pos", "start", ["sent_idx"]).select("doc_id", "k", "pos", F.col("span_sent_idx").alias("sent_idx"))


@query("j2_same_sentence", f"""with {_LINES_SQL}, q as (select doc_id, n_chars // 4 as a, n_chars // 3 as b from documents)
select q.doc_id, x.sent_idx = y.sent_idx as same from q asof join lines x on q.doc_id = x.doc_id and q.a >= x.start asof join lines y on q.doc_id = y.doc_id and q.b >= y.start""")
def j2_same_sentence(spark, d):
    starts = _lines(spark, d).groupBy("doc_id").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    q = table(spark, d, "documents").select("doc_id", F.expr("n_chars div 4").alias("a"), F.expr("n_chars div 3").alias("b"))
    return q.join(starts, "doc_id").select("doc_id", asof.same_span(F.col("starts"), F.col("a"), F.col("b")).alias("same"))


@query("j3_inside_span", """
with s as (select user_id, floor(epoch(ts))::bigint as st, floor(epoch(ts))::bigint + 3600 as en from events where event_type = 'error'),
s1 as (select user_id, st, max(en) as en from s group by 1, 2),
p as (select event_id, user_id, floor(epoch(ts))::bigint as t from events where event_type = 'purchase')
select p.event_id, coalesce(s1.en > p.t, false) as inside from p asof left join s1 on p.user_id = s1.user_id and p.t >= s1.st
""")
def j3_inside_span(spark, d):
    e = table(spark, d, "events").withColumn("t", F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", "ts").cast("timestamp_ntz")))
    s = e.where("event_type = 'error'").groupBy("user_id", F.col("t").alias("st")).agg(F.max(F.col("t") + 3600).alias("en"))
    p = e.where("event_type = 'purchase'").select("event_id", "user_id", "t")
    return asof.inside_spans(p, s, ["user_id"], "t", "st", "en").select("event_id", "inside")


@query("j17_neighbour", """
with x as (select user_id, event_id, event_id as st, event_id + 3 as en, event_type from events),
b as (select x.user_id, x.event_id, x.st, x.en, y.en as be, y.event_type as bt from x asof left join x y on x.user_id = y.user_id and x.st > y.en),
c as (select b.*, y.st as a_s, y.event_type as a_t from b asof left join x y on b.user_id = y.user_id and b.en < y.st)
select user_id, event_id, case when st - coalesce(be, 0) < coalesce(a_s, 10000) - en and st - coalesce(be, 0) < 400 then bt when st - coalesce(be, 0) >= coalesce(a_s, 10000) - en and coalesce(a_s, 10000) - en < 400 then a_t end as near from c
""")
def j17_neighbour(spark, d):
    x = table(spark, d, "events").select("user_id", "event_id", F.col("event_id").alias("st"), (F.col("event_id") + 3).alias("en"), "event_type")
    return asof.neighbour_within(x, ["user_id"], "st", "en", "event_type", 400).select("user_id", "event_id", "near")


_GRID_SQL = "grid as materialized (select l_orderkey // 8 as tbl, cast(l_orderkey % 8 as integer) as r, l_linenumber as c, max(case when l_returnflag = 'R' then l_partkey end) as g, max(l_linestatus) as s, sum(l_quantity) as q from lineitem group by all)"


def grid(spark, d) -> DataFrame:
    x = table(spark, d, "lineitem")
    return x.groupBy(F.expr("l_orderkey div 8").alias("tbl"), (F.col("l_orderkey") % 8).cast("int").alias("r"), F.col("l_linenumber").alias("c")).agg(F.max(F.when(F.col("l_returnflag") == "R", F.col("l_partkey"))).alias("g"), F.max("l_linestatus").alias("s"), F.sum("l_quantity").alias("q"))


@query("w1_ffill_2d", f"""with {_GRID_SQL}, f as (select *, last_value(g ignore nulls) over (partition by tbl, r order by c rows between unbounded preceding and current row) as g1 from grid)
select tbl, r, c, last_value(g1 ignore nulls) over (partition by tbl, c order by r rows between unbounded preceding and current row) as gene from f""")
def w1_ffill_2d(spark, d):
    return windows.ffill_2d(grid(spark, d), ["tbl"], "r", "c", "g", "gene").select("tbl", "r", "c", "gene")


@query("w2_carry_over", "select user_id, event_id, last_value(case when event_type = 'click' then event_id end ignore nulls) over (partition by user_id order by ts, event_id rows between unbounded preceding and current row) as carried from events")
def w2_carry_over(spark, d):
    e = table(spark, d, "events").withColumn("v", F.when(F.col("event_type") == "click", F.col("event_id")))
    return windows.forward_fill(e, ["user_id"], ["ts", "event_id"], "v", "carried").select("user_id", "event_id", "carried")


@query("w5_neighbours", "select event_id, lag(event_type) over w as prev, lead(event_type) over w as next, case when lag(event_id) over w is null then '1st' when lead(event_id) over w is null then 'last' when event_id - lag(event_id) over w = 1 then 'NoGap' else 'Gap' end as gap from events window w as (partition by user_id order by event_id)")
def w5_neighbours(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    before = F.lag("event_id").over(w)
    gap = F.when(before.isNull(), "1st").when(F.lead("event_id").over(w).isNull(), "last").when(F.col("event_id") - before == 1, "NoGap").otherwise("Gap")
    return table(spark, d, "events").select("event_id", F.lag("event_type").over(w).alias("prev"), F.lead("event_type").over(w).alias("next"), gap.alias("gap"))


@query("w6_islands", """with c as (select user_id, event_id, ts, event_type, case when event_type is distinct from lag(event_type) over w or row_number() over w = 1 then 1 else 0 end as ch from events window w as (partition by user_id order by ts, event_id)),
i as (select *, sum(ch) over (partition by user_id order by ts, event_id rows unbounded preceding) as island from c)
select user_id, cast(island as bigint) as island, event_type, count(*) as n, min(event_id) as first_id from i group by all""")
def w6_islands(spark, d):
    e = windows.islands(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], [F.col("event_type")])
    return e.groupBy("user_id", "island", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("w7_bio_spans", """with s as (select user_id, event_id, event_type, sum(case when event_type = 'signup' then 1 else 0 end) over (partition by user_id order by event_id rows unbounded preceding) as g from events),
o as (select *, sum(case when event_type = 'error' then 1 else 0 end) over (partition by user_id, g order by event_id rows unbounded preceding) as x from s)
select user_id, min(event_id) as first, max(event_id) as last, count(*) as n from o where g > 0 and x = 0 group by user_id, g""")
def w7_bio_spans(spark, d):
    return windows.bio_spans(table(spark, d, "events"), ["user_id"], "event_id", "event_type", "signup", "error")


@query("w8_variant_spans", """with c as (select user_id, event_id, event_type, lag(event_type) over (partition by user_id order by event_id) as p from events),
i as (select *, sum(case when event_type <> 'view' and (p is null or p = 'view' or event_type = 'signup') then 1 else 0 end) over (partition by user_id order by event_id rows unbounded preceding) as g from c)
select user_id, cast(g as bigint) as g, min(event_id) as first, max(event_id) as last, count(*) as n from i where event_type <> 'view' group by all""")
def w8_variant_spans(spark, d):
    w = Window.partitionBy("user_id").orderBy("event_id")
    prev = F.lag("event_type").over(w)
    begins = (F.col("event_type") != "view") & (prev.isNull() | (prev == "view") | (F.col("event_type") == "signup"))
    i = table(spark, d, "events").withColumn("b", F.when(begins, 1).otherwise(0)).withColumn("g", windows.cumulative(F.col("b"), ["user_id"], "event_id"))
    return i.where("event_type <> 'view'").groupBy("user_id", "g").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"), F.count("*").alias("n"))


@query("w12_ratio_batches", """with r as (select p_partkey, p_size / 25.0 as ratio, row_number() over (order by p_size, p_partkey) as rk from part), b as (select *, (rk - 1) // 16 as batch from r)
select p_partkey, cast(batch as bigint) as batch, case when last_value(ratio) over w < 1 then first_value(ratio) over w when first_value(ratio) over w > 1 then last_value(ratio) over w else 1.0 end as target from b
window w as (partition by batch order by rk rows between unbounded preceding and unbounded following)""")
def w12_ratio_batches(spark, d):
    p = table(spark, d, "part").select("p_partkey", (F.col("p_size") / 25.0).alias("ratio"), F.row_number().over(Window.orderBy("p_size", "p_partkey")).alias("rk"))
    return windows.batch_ratio(p, "ratio", 16, "rk").select("p_partkey", "batch", "target")


@query("w13_ranks", "select event_id, row_number() over (partition by user_id order by case when event_type = 'error' then 1 else 0 end, value desc, event_id) as rank from events")
def w13_ranks(spark, d):
    w = Window.partitionBy("user_id").orderBy(F.when(F.col("event_type") == "error", 1).otherwise(0), F.desc_nulls_last("value"), "event_id")
    return table(spark, d, "events").select("event_id", F.row_number().over(w).alias("rank"))


@query("a1_majority", """with k as (select user_id, event_type, count(*) as n, min(event_id) as f, max_by(value, event_id) as shown from events group by 1, 2)
select user_id, arg_max(event_type, n * 1e9 - f) as event_type, max(n) as n, arg_max(shown, n * 1e9 - f) as shown from k group by 1""")
def a1_majority(spark, d):
    return keyed.majority(table(spark, d, "events").withColumnRenamed("value", "shown"), ["user_id"], "event_type", "event_id", "shown")


@query("a2_single_only", "select l_orderkey, min(l_partkey) as l_partkey from lineitem group by 1 having count(*) = 1")
def a2_single_only(spark, d):
    return keyed.only_one(table(spark, d, "lineitem"), ["l_orderkey"], "l_partkey")


@query("a6_last_write", "select user_id, event_type, max(event_id) as event_id, max_by(value, event_id) as value from events group by 1, 2")
def a6_last_write(spark, d):
    return keyed.last_write(table(spark, d, "events"), ["user_id", "event_type"], "event_id", ["value"])


@query("a7_merge_sources", """with s as (select p_name as name, p_partkey as id, 0 as p from part where p_size < 20 union all select p_name, p_partkey, 1 from part where p_size between 20 and 35 union all select p_name, p_partkey, 2 from part where p_size > 45)
select name, max(id) filter (where p = m) as id from (select *, max(p) over (partition by name) as m from s) group by name""")
def a7_merge_sources(spark, d):
    p = table(spark, d, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("id"), "p_size")
    return keyed.merge_last([p.where("p_size < 20"), p.where("p_size between 20 and 35"), p.where("p_size > 45")], ["name"], ["id"])


@query("a8_mentions_per_paper", "select user_id, count(distinct event_type) as kinds, count(distinct (event_type, cast(floor(value) as bigint))) as places from events group by 1")
def a8_mentions_per_paper(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.countDistinct("event_type").alias("kinds"), F.count_distinct(F.struct("event_type", F.floor("value").alias("v"))).alias("places"))


@query("a9_multimap", "select p_name, array_to_string(list_sort(list(distinct p_brand)), ',') as brands, count(distinct p_brand) as n from part group by 1")
def a9_multimap(spark, d):
    return table(spark, d, "part").groupBy("p_name").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ",").alias("brands"), F.countDistinct("p_brand").alias("n"))


@query("a10_name_tokens", "select distinct p_size, t as token from (select p_size, unnest(string_split(lower(p_name), ' ')) as t from part)")
def a10_name_tokens(spark, d):
    return table(spark, d, "part").select("p_size", F.explode(F.split(F.lower("p_name"), " ")).alias("token")).distinct()


@query("p5_fallback_chain", f"""with {_GRID_SQL}, f as (select tbl, r, c, last_value(g ignore nulls) over (partition by tbl, r order by c rows unbounded preceding) as cell from grid),
one as (select o_orderkey // 8 as tbl, min(o_custkey) as cap from orders where o_orderpriority like '1%' group by 1 having count(*) = 1),
k as (select tbl, g, count(*) as n, min(r * 100 + c) as fst from grid where g is not null group by 1, 2), maj as (select tbl, arg_max(g, n * 1e6 - fst) as body from k group by 1)
select f.tbl, f.r, f.c, coalesce(cell, cap, body, 0) as gene from f left join one using (tbl) left join maj using (tbl)""")
def p5_fallback_chain(spark, d):
    g = grid(spark, d)
    cells = windows.forward_fill(g, ["tbl", "r"], ["c"], "g", "cell")
    orders = table(spark, d, "orders").where("o_orderpriority like '1%'").select(F.expr("o_orderkey div 8").alias("tbl"), F.col("o_custkey").alias("cap"))
    major = keyed.majority(g.withColumn("o", F.col("r") * 100 + F.col("c")).withColumn("shown", F.col("g")), ["tbl"], "g", "o", "shown").select("tbl", F.col("g").alias("body"))
    j = cells.select("tbl", "r", "c", "cell").join(keyed.only_one(orders, ["tbl"], "cap"), "tbl", "left").join(major, "tbl", "left")
    return j.select("tbl", "r", "c", keyed.coalesce_chain(F.col("cell"), F.col("cap"), F.col("body"), default=0).alias("gene"))


@query("p3_allele_length", "select p_partkey from part where length(p_name) <= 12 and length(p_type) <= 20")
def p3_allele_length(spark, d):
    return table(spark, d, "part").where("length(p_name) <= 12 and length(p_type) <= 20").select("p_partkey")


@query("p4_body_limit", "select doc_id, length(substr(text, 1, 100000)) as n from documents")
def p4_body_limit(spark, d):
    return table(spark, d, "documents").select("doc_id", F.length(T.body_limit(F.col("text"), 100_000)).cast("bigint").alias("n"))


@query("p6_taxonomy_filter", "select c_custkey, c_name from customer where c_nationkey = 7")
def p6_taxonomy_filter(spark, d):
    return table(spark, d, "customer").where("c_nationkey = 7").select("c_custkey", "c_name")


@query("p7_needs_gene", "select l_orderkey, l_linenumber, p_name from lineitem join part on l_partkey = p_partkey where p_size = 10")
def p7_needs_gene(spark, d):
    return table(spark, d, "lineitem").join(table(spark, d, "part").where("p_size = 10"), F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", "p_name")


@query("p8_point_lookup", "select event_id, user_id from events where user_id = 17 and event_type = 'view' and value > 10")
def p8_point_lookup(spark, d):
    return table(spark, d, "events").where("user_id = 17 and event_type = 'view' and value > 10").select("event_id", "user_id")


@query("p21_first_known_token", """with s as (select distinct lower(p_name[1:1]) as c, lower(string_split(p_name, ' ')[1]) as sym from part),
t as (select c_custkey, i, lower(w[i]) as tok from (select c_custkey, w, unnest(range(1, len(w) + 1)) as i from (select c_custkey, string_split(c_mktsegment || ' ' || (select min(p_name) from part) || ' x', ' ') as w from customer)))
select c_custkey, arg_min(tok, i) as tok, min(i) as pos from t where tok in (select sym from s) group by 1""")
def p21_first_known_token(spark, d):
    part = table(spark, d, "part")
    sym = part.select(F.lower(F.split("p_name", " ")[0]).alias("tok")).distinct()
    low = part.agg(F.min("p_name").alias("m"))
    c = table(spark, d, "customer").crossJoin(F.broadcast(low))  # one row
    t = c.select("c_custkey", F.posexplode(F.split(F.concat_ws(" ", "c_mktsegment", "m", F.lit("x")), " ")).alias("i", "tok")).withColumn("tok", F.lower("tok"))
    return t.join(sym, "tok", "left_semi").groupBy("c_custkey").agg(F.min_by("tok", "i").alias("tok"), (F.min("i") + 1).cast("bigint").alias("pos"))


@query("j4_cell_lookup", f"with {_GRID_SQL}, v as (select tbl, r, c from grid where s = 'O') select v.tbl, v.r, v.c, grid.g as gene from v left join grid using (tbl, r, c)")
def j4_cell_lookup(spark, d):
    g = grid(spark, d)
    return g.where("s = 'O'").select("tbl", "r", "c").join(g.select("tbl", "r", "c", F.col("g").alias("gene")), ["tbl", "r", "c"], "left")


@query("j7_synonym_expansion", "select p_partkey, s_suppkey from part join supplier on upper(regexp_replace(p_brand, '[^A-Za-z0-9]', '', 'g')) = 'BRAND' || (s_suppkey % 50)")
def j7_synonym_expansion(spark, d):
    s = table(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("BRAND"), (F.col("s_suppkey") % 50).cast("string")).alias("k"))
    p = table(spark, d, "part").select("p_partkey", T.upper_key(F.col("p_brand")).alias("k"))
    return keyed.expanded(p, s, "k", "s_suppkey").select("p_partkey", "s_suppkey")


@query("j8_fan_out", "select o_orderkey, l_linenumber, k from (select o_orderkey, l_linenumber, unnest(range(cast(l_linenumber as bigint))) as k from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'F')")
def j8_fan_out(spark, d):
    j = table(spark, d, "orders").where("o_orderstatus = 'F'").join(table(spark, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.select("o_orderkey", "l_linenumber", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("l_linenumber").cast("bigint") - 1)).alias("k"))


@query("j9_index_lookup", "select o.o_orderkey, o.o_custkey, o.o_orderdate from orders o join (select distinct o_custkey, o_orderdate from orders where o_orderkey % 97 = 0) w using (o_custkey, o_orderdate)")
def j9_index_lookup(spark, d):
    o = table(spark, d, "orders")
    return o.join(o.where("o_orderkey % 97 = 0").select("o_custkey", "o_orderdate").distinct(), ["o_custkey", "o_orderdate"]).select("o_orderkey", "o_custkey", "o_orderdate")


@query("j16_relations", "select distinct a.user_id, a.event_type as subject, b.event_type as object from events a join events b on a.user_id = b.user_id and a.event_id + 40 = b.event_id")
def j16_relations(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", "event_type")
    b = e.select("user_id", (F.col("event_id") - 40).alias("event_id"), F.col("event_type").alias("object"))
    return e.join(b, ["user_id", "event_id"]).select("user_id", F.col("event_type").alias("subject"), "object").distinct()


@query("j18_inverted_index", "select event_type, count(*) as n, array_to_string(list_sort(list(distinct user_id))[1:5], ',') as users from events group by 1")
def j18_inverted_index(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set("user_id")), 1, 5), ",").alias("users"))


@query("t4_top_n", "select user_id, event_id, rank from (select user_id, event_id, cast(row_number() over (partition by user_id order by value desc nulls last, event_id) as integer) as rank from events) where rank <= 3")
def t4_top_n(spark, d):
    return keyed.top_n(table(spark, d, "events"), ["user_id"], [F.desc_nulls_last("value"), F.col("event_id")], 3).select("user_id", "event_id", "rank")


@query("t9_hash_quota")
def t9_hash_quota(spark, d):
    return keyed.hash_quota(table(spark, d, "events"), ["event_type"], ["event_id"], 20).select("event_type", "event_id")


@query("t10_upper_quartile", "select event_type, list_sort(list(value))[count(*) // 4 * 3 + 1] as q from events where value is not null group by 1")
def t10_upper_quartile(spark, d):
    w = Window.partitionBy("event_type").orderBy("value", "event_id")
    e = table(spark, d, "events").where("value is not null").select("event_type", "value", F.row_number().over(w).alias("r"), F.count("*").over(Window.partitionBy("event_type")).alias("n"))
    return e.where("r = n div 4 * 3 + 1").select("event_type", F.col("value").alias("q"))


@query("s23_balanced_resample", "select event_type, event_id, k as copy from (select event_type, event_id, r, n, unnest(range(0, case when r < 120 then (119 - r) // n + 1 else 0 end)) as k from (select event_type, event_id, row_number() over (partition by event_type order by event_id) - 1 as r, count(*) over (partition by event_type) as n from events))")
def s23_balanced_resample(spark, d):
    return keyed.replicate_to(table(spark, d, "events"), ["event_type"], "event_id", 120).select("event_type", "event_id", F.col("copy").cast("bigint").alias("copy"))


@query("u1_intersection", "select l_partkey, l_suppkey from lineitem where l_returnflag = 'R' intersect select l_partkey, l_suppkey from lineitem where l_returnflag = 'N'")
def u1_intersection(spark, d):
    x = table(spark, d, "lineitem")
    return x.where("l_returnflag = 'R'").select("l_partkey", "l_suppkey").intersect(x.where("l_returnflag = 'N'").select("l_partkey", "l_suppkey"))


@query("u2_concatenation", "select s_suppkey as key, s_name as name from supplier union all select c_custkey, c_name from customer")
def u2_concatenation(spark, d):
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")).unionByName(table(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")))


@query("u3_in_all", "select user_id from events where event_type in ('purchase', 'error', 'signup') group by 1 having count(distinct event_type) = 3")
def u3_in_all(spark, d):
    return keyed.in_all(table(spark, d, "events"), "user_id", "event_type", ["purchase", "error", "signup"])


@query("u4_subset_check", "select count(*) as missing from (select l_partkey from lineitem except select p_partkey from part)")
def u4_subset_check(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct().join(table(spark, d, "part"), "p_partkey", "left_anti").agg(F.count("*").alias("missing"))


@query("u7_stop_tokens", "select p_partkey, array_to_string(list_sort(list_filter(list_distinct(string_split(lower(p_name), ' ')), lambda t: t not in ('of', 'the', ''))), ' ') as toks from part")
def u7_stop_tokens(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(dictionary.bag(F.split(F.lower("p_name"), " "))), " ").alias("toks"))


_BAG_SQL = """q as (select distinct p_name as q, list_distinct(string_split(lower(p_type || ' ' || p_name), ' ')) as w from part), e as (select distinct p_brand as gene, unnest(string_split(lower(p_name), ' ')) as t from part),
s as (select q, gene, count(*) as shared from (select distinct q, unnest(w) as t from q) join e using (t) group by 1, 2)"""


@query("a3_token_bag", f"with {_BAG_SQL} select q, gene, shared from (select *, max(shared) over (partition by q) as m from s) where shared = m")
def a3_token_bag(spark, d):
    p = table(spark, d, "part")
    q = p.select(F.col("p_name").alias("q"), F.split(F.lower(F.concat_ws(" ", "p_type", "p_name")), " ").alias("w")).distinct()
    e = p.select(F.col("p_brand").alias("gene"), F.explode(F.split(F.lower("p_name"), " ")).alias("t"))
    flat = q.select("q", F.explode("w").alias("x")).groupBy("q").agg(F.collect_set("x").alias("w"))
    return dictionary.overlap_winners(flat, e, "q", "w", "gene", "t")


@query("a4_best_name", """with q as (select p_type as q, list_distinct(string_split(lower(p_type || ' ' || min(p_brand)), ' ')) as w from part group by 1), n as (select distinct p_size as gene, p_type as name, unnest(string_split(lower(p_type), ' ')) as t from part),
c as (select distinct p_type as q, p_size % 10 + 1 as gene from part), s as (select u.q, n.gene, n.name, count(*) as k from (select distinct q, unnest(w) as t from q) u join c on c.q = u.q join n on n.t = u.t and c.gene = n.gene group by 1, 2, 3)
select distinct q, gene from (select *, max(k) over (partition by q) as m from s) where k = m""")
def a4_best_name(spark, d):
    p = table(spark, d, "part")
    q = p.groupBy(F.col("p_type").alias("q")).agg(F.min("p_brand").alias("b")).select("q", F.split(F.lower(F.concat_ws(" ", "q", "b")), " ").alias("w"))
    n = p.select(F.col("p_size").alias("gene"), F.col("p_type").alias("name"), F.explode(F.split(F.lower("p_type"), " ")).alias("t")).distinct()
    cand = p.select(F.col("p_type").alias("q"), (F.col("p_size") % 10 + 1).alias("gene")).distinct()
    return dictionary.name_winners(q, n, cand, "q", "w", "gene", "name", "t")


@query("j5_longest_match", """with recursive keys as (select key, min(v) as value from (select lower(p_name) as key, p_partkey as v from part union all select unnest(string_split(lower(p_name), ' ')), p_partkey from part) group by 1),
sizes as (select distinct len(string_split(key, ' ')) as n from keys),
d as materialized (select p_partkey as id, regexp_extract_all(lower(p_type || ' ' || p_name || ' ' || p_brand || ' ' || p_name), '[a-z]+|[0-9]+') as t from part),
m as materialized (select id, i, arg_max(struct_pack(n := n, key := key, value := value), n) as x from (select id, t, unnest(range(1, len(t) + 1)) as i from d), sizes, keys where i + n - 1 <= len(t) and key = array_to_string(t[i : i + n - 1], ' ') group by 1, 2),
walk as (select id, cast(1 as bigint) as i from d union all select w.id, w.i + coalesce(m.x.n, 1) from walk w join d on d.id = w.id left join m on m.id = w.id and m.i = w.i where w.i < len(d.t))
select w.id, cast(w.i - 1 as integer) as first, cast(w.i + m.x.n - 2 as integer) as last, m.x.key as key, m.x.value as value from walk w join m on m.id = w.id and m.i = w.i""")
def j5_longest_match(spark, d):
    p = table(spark, d, "part")
    words = p.select(F.lower("p_name").alias("key"), "p_partkey").groupBy("key").agg(F.min("p_partkey").alias("value"))
    single = p.select(F.explode(F.split(F.lower("p_name"), " ")).alias("key"), "p_partkey").groupBy("key").agg(F.min("p_partkey").alias("value"))
    both = words.unionByName(single).groupBy("key").agg(F.min("value").alias("value"))
    docs = p.select(F.col("p_partkey").alias("id"), dictionary.word_tokens(F.concat_ws(" ", "p_type", "p_name", "p_brand", "p_name")).alias("toks"))
    return dictionary.longest_matches(docs, both, "id", "toks", "key", "value")


@query("j5_exact_path", "select p_partkey, lower(p_name) in (select lower(p_name) from part where p_size < 5) as known from part")
def j5_exact_path(spark, d):
    p = table(spark, d, "part")
    known = p.where("p_size < 5").select(F.lower("p_name").alias("k"), F.lit(True).alias("known")).distinct()
    return p.select("p_partkey", F.lower("p_name").alias("k")).join(known, "k", "left").select("p_partkey", F.coalesce("known", F.lit(False)).alias("known"))


@query("g17_name_cascade")
def g17_name_cascade(spark, d):
    """Blocks are twenty parts each, mentions are part names, types and brands; the dictionary is made of the same table."""
    p = table(spark, d, "part")
    mentions = p.select(F.expr("p_partkey div 20").alias("block"), (F.col("p_partkey") * 30).alias("start"), (F.col("p_partkey") * 30 + F.length("p_name")).alias("end"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).when(F.col("p_partkey") % 3 == 1, F.col("p_type")).otherwise(F.concat(F.lit("h"), F.col("p_brand"))).alias("mention"))
    gene = p.select(F.col("p_partkey").cast("int").alias("gene_id"), "p_name", "p_brand", "p_type")
    kinds = F.explode(F.array(F.struct(F.lit("symbol").alias("kind"), F.col("p_brand").alias("n")), F.struct(F.lit("synonym").alias("kind"), F.col("p_name").alias("n")), F.struct(F.lit("other").alias("kind"), F.concat_ws(" ", "p_type", "p_name").alias("n"))))
    flat = gene.select("gene_id", kinds.alias("k")).select("gene_id", "k.kind", F.col("k.n").alias("name"))
    words = flat.select("gene_id", "name", F.explode(F.split(T.name_words(F.col("name")), " +")).alias("token")).where("token <> ''").distinct()
    articles = p.select(F.expr("p_partkey div 20").alias("block"), F.explode(F.split(T.name_words(F.col("p_name")), " +")).alias("token")).distinct()
    return dictionary.resolve_names(mentions, flat.select("kind", T.name_key(F.col("name")).alias("name_key"), "gene_id").distinct(), words.select("gene_id", "token").distinct(), words, articles, listed=False)


@query("k1_replace_by_key", "select user_id, event_id, case when user_id % 10 = 3 then 'new' else 'old' end as state from events where (user_id % 10 <> 3 or event_type = 'view')")
def k1_replace_by_key(spark, d):
    from lodeflow.session import shared_path
    from lodeflow.sources import sinks

    e = table(spark, d, "events").withColumn("bucket", (F.col("user_id") % 10).cast("int"))
    path = shared_path(spark, "replace")
    sinks.replace_by_key(e.select("bucket", "user_id", "event_id", F.lit("old").alias("state")), path, "bucket")
    sinks.replace_by_key(e.where("bucket = 3 and event_type = 'view'").select("bucket", "user_id", "event_id", F.lit("new").alias("state")), path, "bucket")
    return spark.read.parquet(path).select("user_id", "event_id", "state")


@query("k4_fanout_path", "select doc_id, upper(substr(md5(cast(doc_id as varchar)), 1, 2)) || '/' || upper(substr(md5(cast(doc_id as varchar)), 3, 2)) || '/' || doc_id as path from documents")
def k4_fanout_path(spark, d):
    return table(spark, d, "documents").select("doc_id", T.fanout_path(F.col("doc_id").cast("string")).alias("path"))


@query("k5_lookup_report", """with h as (select distinct cast(user_id as varchar) as p, event_id, props from events where event_type = 'error')
select 'G1' || chr(9) || 'V1' || chr(9) || count(distinct p) as line from h union all select p || chr(9) || string_agg(props, ', ' order by event_id) from h group by p""")
def k5_lookup_report(spark, d):
    from lodeflow.sources import sinks

    hits = table(spark, d, "events").where("event_type = 'error'").select(F.col("user_id").cast("string").alias("paper_id"), F.lit(0).alias("file_idx"), F.col("event_id").alias("start"), F.col("props").alias("mention"))
    return sinks.report(hits, "G1", "V1")


@query("a19_histogram", "with m as (select min(value) as lo, max(value) as hi from events), b as (select case when value >= hi then 50 else cast(floor((value - lo) / (hi - lo) * 50) as bigint) + 1 end as bin from events, m where value is not null) select bin, count(*) as n from b group by 1")
def a19_histogram(spark, d):
    from lodeflow.sources import sinks

    return sinks.histogram(table(spark, d, "events").where("value is not null").select("value"), "value", 50).select("bin", "n")


@query("a20_gradient_norm", "select event_type, round(sqrt(sum(value * value)), 6) as norm from events group by 1")
def a20_gradient_norm(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.round(F.sqrt(F.sum(F.col("value") * F.col("value"))), 6).alias("norm"))
