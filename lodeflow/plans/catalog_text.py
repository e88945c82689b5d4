"""Queries over text functions and variant mentions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodeflow.functions import text as T
from lodeflow.functions import variants as V
from lodeflow.functions.once import once
from lodeflow.registry import query
from lodeflow.session import table


@query("f2_variant_tokens", "select p_partkey, 'c|.|' || p_partkey || '|A|>|G|A|rg|' || p_size || '|G|ln|fs' as tokens from part")
def f2_variant_tokens(spark, d):
    t = F.concat(F.lit("c."), F.col("p_partkey").cast("string"), F.lit("A>G Arg"), F.col("p_size").cast("string"), F.lit("Glnfs"))
    return table(spark, d, "part").select("p_partkey", F.array_join(T.variant_tokens(t), "|").alias("tokens"))


@query("f3_gene_tokens", "select p_partkey, array_to_string(regexp_extract_all(p_brand || '-' || p_name, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\\s]'), '|') as tokens from part")
def f3_gene_tokens(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(T.gene_tokens(F.concat_ws("-", "p_brand", "p_name")), "|").alias("tokens"))


@query("f4_token_offsets", """with t as (select p_partkey, s, string_split(s, ' ') as w from (select p_partkey, p_name || ' ' || p_type as s from part)),
u as (select p_partkey, i, w[i] as tok, sum(length(w[i]) + 1) over (partition by p_partkey order by i rows unbounded preceding) - length(w[i]) - 1 as pos from (select p_partkey, w, unnest(range(1, len(w) + 1)) as i from t))
select p_partkey, tok, cast(pos as bigint) as "at" from u""")
def f4_token_offsets(spark, d):
    s = F.concat_ws(" ", "p_name", "p_type")
    x = table(spark, d, "part").select("p_partkey", s.alias("s"), F.split(s, " ").alias("w")).withColumn("at", T.token_offsets(F.col("s"), F.col("w")))
    return x.select("p_partkey", F.explode(F.arrays_zip("w", "at")).alias("z")).select("p_partkey", F.col("z.w").alias("tok"), F.col("z.at").cast("bigint").alias("at"))


@query("f1_clean_text", "select doc_id, length(regexp_replace(translate(replace(replace(text, 'ß', 'ss'), 'æ', 'ae'), 'äöüéèêçñóíÉÈÊÄÖÜÇÑÓÍ', 'aoueeecnoiEEEAOUCNOI'), '\\s', '', 'g')) as n from documents where regexp_full_match(text, '[\\x00-\\x7fäöüßéèêçñóíÉÈÊÄÖÜÇÑÓÍ]*') and not regexp_matches(text, '&[a-z#]')")
def f1_clean_text(spark, d):
    x = table(spark, d, "documents").where(r"text rlike '^[\\x00-\\x7fäöüßéèêçñóíÉÈÊÄÖÜÇÑÓÍ]*$' and not text rlike '&[a-z#]'")
    return x.select("doc_id", F.length(F.regexp_replace(T.clean_text(F.col("text")), " ", "")).cast("bigint").alias("n"))


@query("f5_name_words", "select p_partkey, rtrim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(p_brand || '#' || p_type), '([0-9])([^0-9])', '\\1 \\2', 'g'), '([^0-9])([0-9])', '\\1 \\2', 'g'), '[^a-z0-9]', ' ', 'g'), ' +', ' ', 'g')) as words from part")
def f5_name_words(spark, d):
    return table(spark, d, "part").select("p_partkey", T.name_words(F.concat_ws("#", "p_brand", "p_type")).alias("words"))


@query("f6_without_h", "select s_suppkey, case when left(k, 1) = 'h' and length(k) > 1 then substr(k, 2) end as bare from (select s_suppkey, case when s_suppkey % 2 = 0 then 'h' else '' end || lower(s_name) as k from supplier)")
def f6_without_h(spark, d):
    k = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "h").otherwise(""), F.lower("s_name"))
    return table(spark, d, "supplier").select("s_suppkey", T.without_h(k).alias("bare"))


@query("f7_upper_key", "select c_custkey, upper(regexp_replace(c_name, '[^A-Za-z0-9]', '', 'g')) as key from customer")
def f7_upper_key(spark, d):
    return table(spark, d, "customer").select("c_custkey", T.upper_key(F.col("c_name")).alias("key"))


@query("f8_accession", "select p_partkey, string_split(cast(p_retailprice as varchar), '.')[1] as base, list_sum(list_transform(list_filter(string_split(p_size || ',' || p_partkey || ',', ','), lambda x: x <> ''), lambda x: cast(x as bigint))) as total from part")
def f8_accession(spark, d):
    n = T.int_list(F.concat(F.col("p_size").cast("string"), F.lit(","), F.col("p_partkey").cast("string"), F.lit(",")))
    return table(spark, d, "part").select("p_partkey", T.accession(F.col("p_retailprice").cast("string")).alias("base"), F.aggregate(n, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("f9_shapes", """select p_partkey, regexp_replace(regexp_replace(regexp_replace(t, '[A-Z]', 'A', 'g'), '[a-z]', 'a', 'g'), '[0-9]', '0', 'g') as s1,
regexp_replace(regexp_replace(t, '[A-Za-z]', 'a', 'g'), '[0-9]', '0', 'g') as s3, left(t, 3) as pre3, right(t, 3) as suf3 from (select p_partkey, replace(p_brand, '#', 'x') || p_partkey || 'Q' as t from part)""")
def f9_shapes(spark, d):
    t = F.concat(F.replace("p_brand", F.lit("#"), F.lit("x")), F.col("p_partkey").cast("string"), F.lit("Q"))
    return table(spark, d, "part").select("p_partkey", T.shape(t, 1).alias("s1"), T.shape(t, 3).alias("s3"), T.affixes(t)[2].alias("pre3"), T.affixes(t, front=False)[2].alias("suf3"))


@query("a18_capped_counts", "select p_partkey, case when len(regexp_extract_all(p_type, '[A-Z]')) >= 4 then '4+' else cast(len(regexp_extract_all(p_type, '[A-Z]')) as varchar) end as upper_n, case when len(regexp_extract_all(cast(p_partkey as varchar), '[0-9]')) >= 4 then '4+' else cast(len(regexp_extract_all(cast(p_partkey as varchar), '[0-9]')) as varchar) end as digit_n from part")
def a18_capped_counts(spark, d):
    return table(spark, d, "part").select("p_partkey", T.capped_count(F.col("p_type"), "[A-Z]").alias("upper_n"), T.capped_count(F.col("p_partkey").cast("string"), "[0-9]").alias("digit_n"))


@query("f22_sentences", "select doc_id, len(regexp_extract_all(text, '[.!?]\\s+[A-Z0-9]')) + 1 as n from documents where not regexp_matches(text, '(?i)\\b(fig|figs|e\\.g|i\\.e|et al|vs|no|ref|dr)\\.\\s') and not regexp_matches(text, '[.!?]\\s+[A-Z0-9][.!?]\\s')")
def f22_sentences(spark, d):
    x = table(spark, d, "documents").where(r"not text rlike '(?i)\\b(fig|figs|e\\.g|i\\.e|et al|vs|no|ref|dr)\\.\\s' and not text rlike '[.!?]\\s+[A-Z0-9][.!?]\\s'")
    return x.select("doc_id", F.size(T.sentences(F.col("text"))).cast("bigint").alias("n"))


@query("f23_chop", "select doc_id, greatest(n_chars - 1, 0) // 2000 + 1 as parts, n_chars as total from documents")
def f23_chop(spark, d):
    p = T.chop(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(p).cast("bigint").alias("parts"), F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("total"))


@query("f26_blocks", "select event_id, event_id // 5000 as block from events")
def f26_blocks(spark, d):
    return table(spark, d, "events").select("event_id", T.block_of(F.col("event_id")).alias("block"))


@query("f24_captions", "select p_partkey, 'Table ' || p_size || case when p_partkey % 2 = 0 then ': ' else '. ' end || p_name as line, cast(p_size as varchar) as label from part")
def f24_captions(spark, d):
    line = F.concat(F.lit("Table "), F.col("p_size").cast("string"), F.when(F.col("p_partkey") % 2 == 0, ": ").otherwise(". "), F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", line.alias("line"), T.caption_number(line).alias("label"))


@query("f25_signed", "select c_custkey, case when c_nationkey - 10 >= 0 then '+' else '' end || (c_nationkey - 10) as s from customer")
def f25_signed(spark, d):
    return table(spark, d, "customer").select("c_custkey", T.signed(F.col("c_nationkey") - 10).alias("s"))


@query("fj_json_arrays", "select event_id, cast(props->>'k' as bigint) as k, list_aggregate(list_reverse(list_transform([event_id, user_id], lambda x: x + 1)), 'first') as r, coalesce([event_id, user_id][3], -1) as e from events")
def fj_json_arrays(spark, d):
    a = F.array("event_id", "user_id")
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), T.reverse_plus_one(a)[0].alias("r"), T.element_or(a, 2, -1).cast("bigint").alias("e"))


_MENTION = "case l_partkey % 7 when 0 then 'c.' || l_partkey || 'A>G' when 1 then 'p.Arg' || l_partkey || 'Gln' when 2 then 'c.' || l_partkey || '_' || (l_partkey + 2) || 'del' when 3 then 'rs' || (l_partkey + 100) when 4 then 'c.' || l_partkey || 'insACG' when 5 then 'c.' || l_partkey || 'dupT' else 'none here' end"


def mention_column():
    k = F.col("l_partkey").cast("string")
    forms = [F.concat(F.lit("c."), k, F.lit("A>G")), F.concat(F.lit("p.Arg"), k, F.lit("Gln")), F.concat(F.lit("c."), k, F.lit("_"), (F.col("l_partkey") + 2).cast("string"), F.lit("del")), F.concat(F.lit("rs"), (F.col("l_partkey") + 100).cast("string")), F.concat(F.lit("c."), k, F.lit("insACG")), F.concat(F.lit("c."), k, F.lit("dupT")), F.lit("none here")]
    return F.element_at(F.array(*forms), (F.col("l_partkey") % 7 + 1).cast("int"))


@query("f15_mention_types", f"""select l_orderkey, l_linenumber, {_MENTION} as mention, case l_partkey % 7 when 0 then 'SUB' when 1 then 'SUB' when 2 then 'DEL' when 3 then 'RSID' when 4 then 'INS' when 5 then 'DUP' end as kind,
case when l_partkey % 7 in (0, 1, 2, 4, 5) then cast(l_partkey as varchar) end as start, case l_partkey % 7 when 0 then 'A' when 1 then 'R' when 5 then 'T' end as wild, case l_partkey % 7 when 0 then 'G' when 1 then 'Q' when 4 then 'ACG' end as mutant from lineitem""")
def f15_mention_types(spark, d):
    x = V.parsed(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", mention_column().alias("mention")), out="v")
    return x.select("l_orderkey", "l_linenumber", "mention", F.col("v.mut_type").alias("kind"), F.col("v.start").alias("start"), F.col("v.wild_type").alias("wild"), F.col("v.mutant").alias("mutant"))


@query("p1_valid_variants", "select l_orderkey, l_linenumber from lineitem where l_partkey % 7 <> 6")
def p1_valid_variants(spark, d):
    x = V.parsed(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", mention_column().alias("mention")), out="v")
    return x.where(V.valid_variant(F.col("v"))).select("l_orderkey", "l_linenumber")


@query("f13_mention_spans", f"select l_orderkey, l_linenumber, cast(case when l_partkey % 7 = 6 then 0 else 1 end as integer) as n, case when l_partkey % 7 <> 6 then 5 end as start from lineitem")
def f13_mention_spans(spark, d):
    x = once(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("with "), mention_column(), F.lit(" seen")).alias("text")), {"m": V.mention_spans(F.col("text"))})
    return x.select("l_orderkey", "l_linenumber", F.size("m").alias("n"), F.try_element_at("m", F.lit(1))["start"].alias("start"))


@query("f18_residues", "select p_partkey, case p_size % 4 when 0 then 'R' when 1 then 'X' when 2 then 'Zzz' else 'W' end as one from part")
def f18_residues(spark, d):
    r = F.element_at(F.array(F.lit("Arg"), F.lit("ter"), F.lit("Zzz"), F.lit("TRP")), F.col("p_size") % 4 + 1)
    return table(spark, d, "part").select("p_partkey", V.one_letter(r).alias("one"))


@query("f17_types_by_size", "select p_partkey, case when p_size % 9 = 0 then 'c,n' when p_partkey * 2000 > 2305000 then 'chr' when p_partkey * 2000 > 109224 then 'g,chr' when p_partkey * 2000 > 36408 then 'c,n,g,chr' else 'p,c,n,g,chr' end as types from part")
def f17_types_by_size(spark, d):
    return table(spark, d, "part").select("p_partkey", F.array_join(V.types_by_size(F.concat(F.when(F.col("p_size") % 9 == 0, "*").otherwise(""), (F.col("p_partkey") * 2000).cast("string"))), ",").alias("types"))


@query("u6_sequence_types", f"""select l_orderkey, l_linenumber, case l_partkey % 7 when 1 then 'p' when 3 then '' when 6 then null when 5 then 'c' else case when pos > 2305000 then 'chr' when pos > 109224 then 'g' else 'c,n' end end as types
from (select *, l_partkey * 2000 as pos from lineitem)""")
def u6_sequence_types(spark, d):
    """Mentions without an explicit coding prefix take the types that size and form allow."""
    k = (F.col("l_partkey") * 2000).cast("string")
    forms = [F.concat(k, F.lit("A>G")), F.concat(F.lit("Arg"), F.col("l_partkey").cast("string"), F.lit("Gln")), F.concat(k, F.lit("_"), (F.col("l_partkey") * 2000 + 2).cast("string"), F.lit("del")), F.lit("rs77"), F.concat(k, F.lit("insACG")), F.concat(F.lit("c."), k, F.lit("dupT")), F.lit("none here")]
    x = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.element_at(F.array(*forms), (F.col("l_partkey") % 7 + 1).cast("int")).alias("mention"))
    return V.parsed(x).select("l_orderkey", "l_linenumber", F.array_join("var.seq_types", ",").alias("types"))


@query("f19_lookup_forms", """select p_partkey, case p_partkey % 5 when 0 then 'SUB' when 1 then 'SUB' when 2 then 'INDEL' when 3 then 'RSID' end as kind, case p_partkey % 5 when 0 then 'p' when 1 then 'c' when 2 then 'c' end as seq,
case when p_partkey % 5 < 4 then cast(p_partkey as varchar) end as start from part""")
def f19_lookup_forms(spark, d):
    k = F.col("p_partkey").cast("string")
    q = F.element_at(F.array(F.concat(F.lit("M"), k, F.lit("T")), F.concat(F.lit("c."), k, F.lit("C>A")), F.concat(F.lit("c."), k, F.lit("delinsG")), F.concat(F.lit("rs"), k), F.lit("what?")), (F.col("p_partkey") % 5 + 1).cast("int"))
    v = V.parse_lookup(q)
    return table(spark, d, "part").select("p_partkey", v["mut_type"].alias("kind"), v["seq"].alias("seq"), v["start"].alias("start"))


@query("f20_positions", """select p_partkey, case p_partkey % 5 when 0 then p_partkey when 1 then -p_partkey when 2 then p_partkey when 3 then null else null end as pos, case p_partkey % 5 when 0 then 0 when 1 then 0 when 2 then 5 when 3 then -3 end as off,
case p_partkey % 5 when 0 then true when 1 then false when 2 then false when 3 then false end as utr3, case when p_partkey % 5 = 3 then p_partkey end as intron from part""")
def f20_positions(spark, d):
    k = F.col("p_partkey").cast("string")
    s = F.element_at(F.array(F.concat(F.lit("*"), k), F.concat(F.lit("-"), k), F.concat(k, F.lit("+5")), F.concat(F.lit("IVS"), k, F.lit("-3")), F.lit("?")), (F.col("p_partkey") % 5 + 1).cast("int"))
    p = V.parse_position(s)
    return table(spark, d, "part").select("p_partkey", p["pos"].alias("pos"), p["offset"].alias("off"), p["utr3"].alias("utr3"), p["intron"].alias("intron"))


@query("p2_look_alikes", "select p_partkey from part where p_size % 3 <> 0 and p_size % 3 <> 1")
def p2_look_alikes(spark, d):
    t = F.element_at(F.array(F.array(F.lit("Fig"), F.lit("3")), F.array(F.lit("chr"), F.lit("7")), F.array(F.lit("BRCA"), F.lit("1"))), F.col("p_size") % 3 + 1)
    return V.drop_look_alikes(table(spark, d, "part").select("p_partkey", t.alias("t")), "t").select("p_partkey")


@query("s3_dispatch", "select doc_id, case doc_id % 6 when 0 then 'markup' when 1 then 'docx' when 2 then 'csv' when 3 then 'txt' when 4 then 'zip' end as kind from documents")
def s3_dispatch(spark, d):
    from lodeflow.sources.documents import kind_of

    ext = F.element_at(F.array(*[F.lit(x) for x in ("NXML", "docx", "csv", "txt", "zip", "bin")]), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", kind_of(F.concat(F.col("doc_id").cast("string"), F.lit("."), ext)).alias("kind"))
