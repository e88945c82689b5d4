"""Dictionary matching and name resolution: longest match, token bags, and the staged cascade."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lodeflow.functions import text as T
from lodeflow.functions.once import once
from lodeflow.operators import asof
from lodeflow.session import settle, shuffled

#: Words that don't count as tokens of a name in the first and the second bag.
STOP_FIRST = ["", "of", "the"]
STOP_SECOND = ["", "of", "an", "the", "and", "gene", "pseudogene", "protein", "receptor"]


def word_tokens(text: Column) -> Column:
    """Lower-case tokens without those that hold a sign."""
    return F.filter(F.transform(T.gene_tokens(text), F.lower), lambda t: ~t.rlike(r"[^a-z0-9_]"))


#: Keys, and characters of keys, that are sent to every task as a tree at most (counted first).
TREE_KEYS = 200_000
TREE_CHARS = 8_000_000


def token_tree(keys: list[str]) -> dict:
    """Tree of keys by token; the entry under None is the number of the key that ends there."""
    root: dict = {}
    for i, key in enumerate(keys):
        node = root
        for token in key.split(" "):
            node = node.setdefault(token, {})
        node[None] = i
    return root


def walk(tree: dict, tokens: list[str], compat: bool = False) -> list[tuple[int, int, int]]:
    """(first, last, key number) of the matches of one token array: from each start the longest, and on behind it."""
    out, i, n = [], 0, len(tokens)
    while i < n:
        node, best = tree.get(tokens[i]), None
        j = i
        while node is not None:
            if None in node and not (compat and i == 0 and j == 0):
                best = (i, j, node[None])
            j += 1
            node = node.get(tokens[j]) if j < n else None
        if best:
            out.append(best)
        i = best[1] + 1 if best else i + 1
    return out


def longest_matches(docs: DataFrame, dictionary: DataFrame, id_col: str, tokens: str, key: str, value: str, compat: bool = False, tree_keys: int = TREE_KEYS) -> DataFrame:
    """Greedy left-to-right dictionary matches of token arrays: (id_col, first, last, key, value).

    A start's longest match counts, and the next start lies behind it. ``dictionary`` has one value for a key (of several the greatest counts), a key being tokens joined by a space.
    A dictionary of at most ``tree_keys`` keys goes to every task as a tree of tokens, and a document is read once, without a shuffle. A larger one stays a table: a
    start meets the lengths of the keys that begin with its token, and only runs of those lengths are joined with the keys. ``compat`` leaves out one-token matches at the first token.
    Null ids, arrays and tokens give no match; an empty dictionary or table gives no rows.
    """
    words = dictionary.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(value).alias("value"))
    kind = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("first", IntegerType()), StructField("last", IntegerType()), StructField(key, StringType()), StructField(value, dictionary.schema[value].dataType)])
    if words.limit(tree_keys + 1).agg((F.count("*") <= tree_keys) & (F.coalesce(F.sum(F.length("key")), F.lit(0)) <= TREE_CHARS)).first()[0]:
        held = words.collect()
        sent = docs.sparkSession.sparkContext.broadcast(([r["key"] for r in held], [r["value"] for r in held]))

        def run(batches):
            keys, values = sent.value
            tree, fields = token_tree(keys), to_arrow_schema(kind)
            for b in batches:
                rows = [(row, *m) for row, ts in enumerate(b.column(1).to_pylist()) if ts for m in walk(tree, ts, compat)]
                row, first, last, at = zip(*rows, strict=True) if rows else ((), (), (), ())
                ids = b.column(0).take(pa.array(row, pa.int64()))
                arrays = [ids.cast(fields.field(0).type), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array([keys[i] for i in at], pa.string()), pa.array([values[i] for i in at], fields.field(4).type)]
                yield pa.RecordBatch.from_arrays(arrays, schema=fields)

        return docs.select(id_col, tokens).mapInArrow(run, kind)
    first = F.split_part("key", F.lit(" "), F.lit(1))
    lengths = words.groupBy(first.alias("__t")).agg(F.collect_set(F.size(F.split("key", " "))).alias("__sizes"))
    starts = docs.where(F.size(tokens) > 0).select(F.col(id_col).alias("__id"), F.col(tokens).alias("__all"))
    spots = starts.select("__id", "__all", F.posexplode("__all").alias("first", "__t"))
    most = words.agg(F.max(F.size(F.split("key", " ")))).first()[0] or 0
    near = spots.select("__id", "first", "__t", F.slice("__all", F.col("first") + 1, F.lit(most)).alias("__run")).join(lengths, "__t")
    runs = near.select("__id", "first", "__run", F.explode("__sizes").alias("n")).where(F.size("__run") >= F.col("n"))
    hit = runs.select("__id", "first", (F.col("first") + F.col("n") - 1).alias("last"), F.array_join(F.slice("__run", F.lit(1), F.col("n")), " ").alias("key")).join(words, "key")
    if compat:
        hit = hit.where("not (first = 0 and last = 0)")
    longest = hit.groupBy("__id", "first").agg(F.max_by(F.struct("last", "key", "value"), "last").alias("m"))
    listed = longest.groupBy("__id").agg(F.array_sort(F.collect_list(F.struct("first", "m.last", "m.key", "m.value"))).alias("ms"))
    shape = listed.schema["ms"].dataType

    def step(acc, m):
        ok = m["first"] > acc["end"]
        return F.struct(F.when(ok, m["last"]).otherwise(acc["end"]).alias("end"), F.when(ok, F.concat(acc["out"], F.array(m))).otherwise(acc["out"]).alias("out"))

    kept = listed.select("__id", F.explode(F.aggregate("ms", F.struct(F.lit(-1).alias("end"), F.array().cast(shape).alias("out")), step, lambda a: a["out"])).alias("m"))
    return kept.select(F.col("__id").alias(id_col), "m.first", "m.last", F.col("m.key").alias(key), F.col("m.value").alias(value))


def prefix_paths(nodes: DataFrame) -> DataFrame:
    """(key, gene_id) of a tree given as rows (path, token, gene_id), path being dash-separated ordinals; one join a level, as deep as it goes."""
    level = nodes.where(~F.col("path").contains("-")).select("path", F.col("token").alias("key"), "gene_id").checkpoint()
    out = [level]
    rest = nodes.where(F.col("path").contains("-")).withColumn("parent", F.regexp_replace("path", r"-[^-]*$", ""))
    while True:
        level = rest.join(level.select(F.col("path").alias("parent"), F.col("key").alias("__k")), "parent").select("path", F.concat_ws(" ", "__k", "token").alias("key"), "gene_id").checkpoint()
        if not level.limit(1).count():
            break
        out.append(level)
    return reduce(DataFrame.unionByName, out).where("gene_id is not null").select(F.lower("key").alias("key"), "gene_id")


def bag(tokens: Column, second: bool = False) -> Column:
    """Distinct tokens that count; the second bag leaves out numbers, single letters and more stop words."""
    first = F.array_except(F.array_distinct(tokens), F.array(*[F.lit(w) for w in STOP_FIRST]))
    if not second:
        return first
    return F.filter(F.array_except(first, F.array(*[F.lit(w) for w in STOP_SECOND])), lambda t: ~t.rlike(r"^[0-9]+$|^[a-z]$"))


def overlap_winners(queries: DataFrame, entries: DataFrame, query: str, tokens: str, entry: str, token: str) -> DataFrame:
    """Entries that share the most distinct tokens with each query, ties kept: (query, entry, shared).

    ``queries`` has an array column, ``entries`` one row per (entry, token): an equi-join on tokens, counts, a rank.
    """
    q = queries.select(query, F.explode(F.array_distinct(F.col(tokens))).alias("__t"))
    shared = q.join(shuffled(entries.select(entry, F.col(token).alias("__t")).distinct()), "__t").groupBy(query, entry).agg(F.count("*").alias("shared"))
    top = shared.withColumn("__m", F.max("shared").over(Window.partitionBy(query)))
    return top.where("shared = __m").drop("__m")


def bag_candidates(queries: DataFrame, entries: DataFrame, query: str, tokens: str, entry: str, token: str) -> DataFrame:
    """Winners of the first bag if they are one to nine, else those of the second: (query, entry)."""
    one = overlap_winners(queries.withColumn(tokens, bag(F.col(tokens))), entries, query, tokens, entry, token)
    few = one.withColumn("__n", F.count("*").over(Window.partitionBy(query))).where("__n between 1 and 9").select(query, entry)
    two = overlap_winners(queries.withColumn(tokens, bag(F.col(tokens), True)), entries, query, tokens, entry, token).select(query, entry)
    return few.unionByName(two.join(shuffled(few.select(query).distinct()), query, "left_anti"))


def name_winners(queries: DataFrame, names: DataFrame, candidates: DataFrame, query: str, tokens: str, entry: str, name: str, token: str) -> DataFrame:
    """Among candidate entries, those with a single name that shares the most tokens: ``names`` has (entry, name, token)."""
    q = queries.select(query, F.explode(F.array_distinct(F.col(tokens))).alias("__t"))
    own = candidates.join(shuffled(names.select(entry, name, F.col(token).alias("__t")).distinct()), entry)
    shared = own.join(shuffled(q), [query, "__t"]).groupBy(query, entry, name).agg(F.count("*").alias("shared"))
    top = shared.withColumn("__m", F.max("shared").over(Window.partitionBy(query)))
    return top.where("shared = __m").select(query, entry).distinct()


def resolve_names(mentions: DataFrame, names: DataFrame, gene_tokens: DataFrame, name_tokens: DataFrame, articles: DataFrame, gap: int = 5, listed: bool = True) -> DataFrame:
    """The cascade that gives each mention of a block its gene: (block, start, end, mention, gene_id, step, options).

    ``mentions``: block, start, end, mention. ``names``: kind (symbol, synonym, other), name_key, gene_id.
    ``gene_tokens``: gene_id, token; ``name_tokens``: gene_id, name, token. ``articles``: block, token.
    Stages, each for what the ones before left: symbol, synonym, other name (each also without a leading h; a single
    hit resolves, several are kept in doubt), token bag, best single name. Of what is in doubt, the options that were
    found for other mentions of the block stay, if there are any; else those that share most tokens with the article. One resolves;
    several, and mentions without any option, take the gene of a neighbour nearer than ``gap`` characters;
    else several options stay (``options``, ``gene_id`` the smallest) and none gives null. Without ``listed`` the column of options is left out.

    What a name in doubt may be depends on its block and name alone, and how it does against an article on a gene's tokens alone: doubt is settled
    once a block and name, over sets of tokens in place of genes, so it doesn't grow with the mentions times the genes under their names.
    No join sends a table to the driver, however small it is thought to be: names and words repeat, so files are far smaller than their rows.
    """
    keyed = settle(once(mentions.select("block", "start", "end", "mention"), {"name_key": T.name_key(F.col("mention")), "words": F.split(T.name_words(F.col("mention")), " +")}))
    uniq = keyed.select("name_key", "words").where("name_key is not null").dropDuplicates(["name_key"])

    # steps 2 to 4 at once: of all entries under a name, or under it without a leading h, those of the first step that has any count
    by_step = names.where("kind = 'symbol'").groupBy("name_key").agg(F.max("gene_id").alias("gene_id")).withColumn("step", F.lit(2))
    for kind, step in (("synonym", 3), ("other", 4)):
        by_step = by_step.unionByName(names.where(F.col("kind") == kind).select("name_key", "gene_id", F.lit(step).alias("step")))
    tries = uniq.select("name_key", F.explode(F.array(F.struct(F.lit(0).alias("bare"), F.col("name_key").alias("__k")), F.struct(F.lit(1).alias("bare"), T.without_h(F.col("name_key")).alias("__k")))).alias("x")).select("name_key", "x.*")
    hits = tries.join(shuffled(by_step.withColumnRenamed("name_key", "__k")), "__k")
    first = hits.withColumn("__first", F.min(F.struct("step", "bare")).over(Window.partitionBy("name_key"))).where(F.struct("step", "bare") == F.col("__first"))
    exact = settle(first.select("name_key", "gene_id", "step").distinct().withColumn("__n", F.count("*").over(Window.partitionBy("name_key"))))
    # steps 5 and 6 for names without an entry
    left = settle(uniq.join(shuffled(exact.select("name_key").distinct()), "name_key", "left_anti"))
    bagged = settle(bag_candidates(left, gene_tokens, "name_key", "words", "gene_id", "token").withColumn("__n", F.count("*").over(Window.partitionBy("name_key"))))
    several = bagged.where("__n > 1").select("name_key", "gene_id")
    named = name_winners(left, name_tokens, several, "name_key", "words", "gene_id", "name", "token").withColumn("__one", F.count("*").over(Window.partitionBy("name_key")) == 1).where("__one").select("name_key", F.col("gene_id").alias("best"))
    closed = settle(
        exact.select("name_key", "gene_id", "step", (F.col("__n") == 1).alias("sure"))
        .unionByName(bagged.where("__n = 1").select("name_key", "gene_id", F.lit(5).alias("step"), F.lit(True).alias("sure")))
        .unionByName(several.join(shuffled(named), "name_key", "left").where("best is null or best = gene_id").select("name_key", "gene_id", F.lit(6).alias("step"), F.col("best").isNotNull().alias("sure")))
    )
    sure, unsure = closed.where("sure").select("name_key", "gene_id", "step"), closed.where("not sure").select("name_key", "gene_id", "step")

    place = ["block", "start", "end"]
    spots = keyed.select(*place, "mention", "name_key")
    found = spots.join(shuffled(sure), "name_key")
    asked = spots.join(shuffled(unsure.select("name_key").distinct()), "name_key", "left_semi").select("block", "name_key").distinct()
    in_block = found.select("block", "gene_id").distinct()
    seven = settle(in_block.join(shuffled(unsure.select("name_key", "gene_id")), "gene_id").join(shuffled(asked), ["block", "name_key"]).select("block", "name_key", "gene_id"))
    open7 = asked.join(shuffled(seven.select("block", "name_key").distinct()), ["block", "name_key"], "left_anti")
    stop = F.array(*[F.lit(w) for w in STOP_FIRST])
    heard = articles.select("token").distinct()  # no other token can count, and genes that differ only in those are alike
    sets = gene_tokens.join(shuffled(heard), "token", "left_semi").join(shuffled(unsure.select("gene_id").distinct()), "gene_id", "left_semi").groupBy("gene_id").agg(F.array_sort(F.array_except(F.collect_set("token"), stop)).alias("tokens"))
    alike = settle(unsure.select("name_key", "gene_id").join(shuffled(sets), "gene_id").groupBy("name_key", "tokens").agg(F.min("gene_id").alias("low"), F.count("*").alias("genes")))
    words = articles.groupBy("block").agg(F.array_except(F.collect_set("token"), stop).alias("words"))
    common = open7.join(shuffled(words), "block").join(shuffled(alike), "name_key").select("block", "name_key", "low", "genes", F.size(F.array_intersect("tokens", "words")).alias("n")).where("n > 0")
    level = common.groupBy("block", "name_key", "n").agg(F.min("low").alias("low"), F.sum("genes").alias("genes"), F.collect_set("low").alias("lows"))
    eight = level.groupBy("block", "name_key").agg(F.max_by(F.struct("low", "genes", "lows"), "n").alias("m")).select("block", "name_key", "m.*", F.lit(8).alias("step"))
    told = seven.groupBy("block", "name_key").agg(F.min("gene_id").alias("low"), F.count("*").alias("genes")).withColumns({"lows": F.lit(None).cast(eight.schema["lows"].dataType), "step": F.lit(7)})
    kept = settle(told.unionByName(eight))
    one = kept.where("genes = 1").select("block", "name_key", F.col("low").alias("gene_id"), "step")
    resolved = found.select("block", "name_key", "gene_id", "step").unionByName(one).groupBy("block", "name_key").agg(F.min("gene_id").alias("gene_id"), F.min("step").alias("step"))
    # a name that was resolved in one place of a block is so in all of it
    many = kept.where("genes > 1").select("block", "name_key", "low")
    base = spots.join(shuffled(many), ["block", "name_key"], "left").join(shuffled(resolved), ["block", "name_key"], "left").join(shuffled(unsure.select("name_key", F.lit(True).alias("doubtful")).distinct()), "name_key", "left")
    near = asof.neighbour_within(base, ["block"], "start", "end", "gene_id", gap)
    several, none = F.col("low").isNotNull(), F.col("low").isNull() & F.col("doubtful").isNull()
    gene = F.coalesce("gene_id", F.when(several | none, F.col("near")), F.col("low"))
    step = F.coalesce("step", F.when(several, 9).when(none & F.col("near").isNotNull(), 10))
    out = near.select(*place, "mention", "name_key", gene.alias("gene_id"), step.alias("step"))
    if not listed:
        return out.drop("name_key")
    lows = kept.where("genes > 1 and step = 8").select("block", "name_key", F.explode("lows").alias("low"))
    members = unsure.select("name_key", "gene_id").join(shuffled(sets), "gene_id").join(shuffled(alike.select("name_key", "tokens", "low")), ["name_key", "tokens"]).select("name_key", "low", "gene_id")
    every = seven.join(shuffled(many.select("block", "name_key")), ["block", "name_key"]).unionByName(lows.join(shuffled(members), ["name_key", "low"]).select("block", "name_key", "gene_id"))
    options = every.groupBy("block", "name_key").agg(F.array_sort(F.collect_set("gene_id")).alias("options"))
    return out.join(shuffled(options), ["block", "name_key"], "left").select(*place, "mention", "gene_id", "step", "options")
