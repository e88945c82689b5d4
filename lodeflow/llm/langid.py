"""Language identification by Bayesian fusion of text, markup, address and host evidence."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodeflow.llm.common import free_name, map_rows, session, settle, small

#: Labelled rows per language that the text model is fitted on (a documented bound of the sample).
FIT_ROWS = 400
#: Buckets of the hashed byte trigrams.
BUCKETS = 1 << 16
#: Text evidence is tempered: neighbouring trigrams overlap, so at most this many count as independent.
EFFECTIVE = 60.0
#: Rows of a table of counts that may be broadcast.
HOST_ROWS = 20_000
#: Strength (in pseudo-rows) of the domain prior in a host's prior, and of the global one in a domain's.
KAPPA = 10.0
#: A row is accepted if its best language has at least this posterior.
ACCEPT = 0.5

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def trigrams(text: str | None) -> np.ndarray:
    """Bucket of every byte trigram of the letters of a text, runs of other bytes read as one space."""
    if not text:
        return np.empty(0, dtype=np.uint32)
    body = b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())
    if not body:
        return np.empty(0, dtype=np.uint32)
    a = np.frombuffer(b" " + body + b" ", dtype=np.uint8).astype(np.uint32)
    return (a[:-2] * 40503 + a[1:-1] * 257 + a[2:] * 7919 + (a[:-2] ^ a[2:]) * 1021) & (BUCKETS - 1)


class TextModel:
    """Naive Bayes over hashed byte trigrams."""

    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp

    @classmethod
    def fit(cls, rows: list[tuple[str, str]]) -> TextModel:
        langs = sorted({lang for lang, _ in rows})
        counts = np.full((len(langs), BUCKETS), 0.5)
        for lang, text in rows:
            counts[langs.index(lang)] += np.bincount(trigrams(text), minlength=BUCKETS)
        return cls(langs, np.ascontiguousarray(np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)))

    def evidence(self, text: str | None) -> np.ndarray | None:
        """Tempered log likelihood of each language; None without letters."""
        grams = trigrams(text)
        if not len(grams):
            return None
        total = np.zeros(len(self.langs))
        for i in range(0, len(grams), 1 << 16):
            total += self.logp[grams[i : i + (1 << 16)]].sum(axis=0, dtype=np.float64)
        total *= min(1.0, EFFECTIVE / len(grams))
        return total - total.max()


def sample(df: DataFrame, text: str, declared: str, rows: int) -> list[tuple[str, str]]:
    """At most ``rows`` different whole texts of each declared language, the same ones at every run and in every layout of the files.

    Rows are taken by a hash of text and language; copies of a text count once.
    """
    base = df.where(F.col(declared).isNotNull() & (F.length(text) > 0))
    h = F.pmod(F.xxhash64(text, declared), F.lit(1 << 30))
    counts = base.groupBy(F.col(declared).alias("__lang")).agg(F.least(F.lit(1.0), F.lit(1.5 * rows) / F.approx_count_distinct(h)).alias("share"))
    some = base.select(F.col(declared).alias("__lang"), F.col(text).alias("t"), h.alias("h")).join(F.broadcast(counts) if small(counts, HOST_ROWS) else counts, "__lang").where(F.col("h") < F.ceil(F.col("share") * (1 << 30))).groupBy("__lang", "h").agg(F.min("t").alias("t"))
    got = some.withColumn("r", F.row_number().over(Window.partitionBy("__lang").orderBy("h", "t"))).where(F.col("r") <= rows).select("__lang", "t", "r").collect()
    return [(r[0], r[1]) for r in sorted(got, key=lambda r: (r[0], r[2]))]


def site(url: Column) -> tuple[Column, Column, Column]:
    """Host, registered domain (last two labels) and suffix of an address; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(host != "", host)
    return host, F.substring_index(host, ".", -2), F.substring_index(host, ".", -1)


def declared_markup(html: Column) -> Column:
    """Primary subtag of the language that the opening html tag declares, or null."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(found != "", found)


def visible(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags."""
    bare = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[a-zA-Z]+;|&#\d+;", " ")


def identify(df: DataFrame, keys: list[str], text: str, declared: str | None = None, host: str | None = None, domain: str | None = None, suffix: str | None = None, fit_on: DataFrame | None = None, fit_text: str = "text", fit_lang: str = "lang", fit_rows: int = FIT_ROWS) -> DataFrame:
    """Language of every row: ``keys, lang, posterior, text_lang, n_evidence, accepted``.

    log posterior = tempered text likelihood + log P(declared | language) + log P(suffix | language)
    + log prior(host), where P(value | language) is read as P(language | value) / P(language), so that a rare
    value is weak evidence for any language. The reliabilities of declared language and suffix, and the priors, are learnt by
    grouped aggregation over all rows and values from what the text alone says: counts by (declared, language),
    (suffix, language) and (host, language); a host's prior is smoothed towards its domain's, and that
    towards the global one (each with ``KAPPA`` pseudo-rows); all counts leave out the row itself.
    Every declared language with a text is fitted. The tables of counts are broadcast only if counted to be small,
    else joined by a shuffle of the scores alone.
    Defined results: a row without letters has no text evidence and is not accepted; null declared, host or
    suffix give no evidence; repeated rows give a row each; an empty table gives no rows; without any labelled
    row the language is null. Ties go to the alphabetically first language.
    """
    spark = session(df)
    model = TextModel.fit(sample(fit_on if fit_on is not None else df, fit_text, fit_lang, fit_rows))
    langs = model.langs
    kinds = dict(df.dtypes)
    parts = {"declared": declared, "host": host, "domain": domain, "suffix": suffix}
    picked = df.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.col(text).alias("t"), *[(F.col(c) if c else F.lit(None)).cast("string").alias(n) for n, c in parts.items()])
    key_cols = [f"k{i}" for i in range(len(keys))]
    schema = ", ".join(f"k{i} {kinds[k]}" for i, k in enumerate(keys)) + ", declared string, host string, domain string, suffix string, ev array<double>, best int"
    sent = spark.sparkContext.broadcast((langs, model.logp))

    def make():
        model = TextModel(*sent.value)

        def run(*cols):
            texts, rest = cols[len(keys)], [*cols[: len(keys)], *cols[len(keys) + 1 :]]
            ev = [model.evidence(t) if langs else None for t in texts]
            return [*rest, [None if e is None else e.tolist() for e in ev], [None if e is None else int(e.argmax()) for e in ev]]

        return run

    scored = settle(map_rows(picked, [*key_cols, "t", *parts], schema, make))
    n = max(1, len(langs))

    total = np.full(n, 1.0)
    for r in scored.where("best is not null").groupBy("best").count().collect():
        total[r["best"]] += r["count"]
    prior = total / total.sum()
    joined = _with_counts(scored, {c: bool(parts[c]) for c in parts}, n)
    consts = spark.sparkContext.broadcast((langs, prior))
    out_schema = ", ".join(f"k{i} {kinds[k]}" for i, k in enumerate(keys)) + ", lang string, posterior double, text_lang string, n_evidence int, accepted boolean"

    def fuse():
        langs, prior = consts.value

        def smoothed(counts, best, p):
            c = np.array(counts, dtype=float)
            if best is not None:
                c[best] = max(0.0, c[best] - 1)
            return (c + KAPPA * p) / (c.sum() + KAPPA)

        def one(ev, best, host_n, domain_n, declared_n, suffix_n):
            if not langs:
                return None, None, None, 0, False
            p, used = prior, 0
            for counts in (domain_n, host_n):
                if counts is not None:
                    p = smoothed(counts, best, p)
                    used += 1
            score = np.log(p)
            if ev is not None:
                score = score + np.array(ev)
                used += 1
            for counts in (declared_n, suffix_n):
                if counts is not None:
                    score = score + np.log(smoothed(counts, best, prior) / prior)
                    used += 1
            post = np.exp(score - score.max())
            post /= post.sum()
            k = int(post.argmax())
            return langs[k], float(post[k]), None if best is None else langs[best], used, ev is not None and float(post[k]) >= ACCEPT

        def run(*cols):
            k = len(keys)
            got = [one(*x) for x in zip(*cols[k:], strict=True)]
            return [*cols[:k], *(list(x) for x in zip(*got, strict=True))]

        return run

    out = map_rows(joined, [*key_cols, "ev", "best", "host_n", "domain_n", "declared_n", "suffix_n"], out_schema, fuse)
    return out.toDF(*keys, "lang", "posterior", "text_lang", "n_evidence", "accepted")


def _with_counts(scored: DataFrame, parts: dict[str, bool], n: int) -> DataFrame:
    """Adds the language counts of a row's host, domain, declared language and suffix, as arrays."""
    out = scored
    for name, there in parts.items():
        if there:
            counts = scored.where(F.col(name).isNotNull() & F.col("best").isNotNull()).groupBy(name).agg(F.array(*[F.sum(F.when(F.col("best") == k, 1).otherwise(0)).cast("double") for k in range(n)]).alias(f"{name}_n"))
            # counts are partly summed before their shuffle; the join moves scores, never texts
            out = out.join(F.broadcast(counts) if small(counts, HOST_ROWS) else counts, name, "left")
        else:
            out = out.withColumn(f"{name}_n", F.lit(None).cast("array<double>"))
    return out


def identify_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, posterior, text_lang, n_evidence, accepted`` of documents; their source takes the host's place."""
    return identify(docs, ["doc_id"], "text", declared="lang", host="source")


def identify_pages(pages: DataFrame) -> DataFrame:
    """The same for raw pages with all the evidence: visible text, html tag, address suffix, host and domain."""
    host, domain, suffix = site(F.col("url"))
    base = pages.select("page_id", visible(F.col("html")).alias("text"), declared_markup(F.col("html")).alias("declared"), host.alias("host"), domain.alias("domain"), suffix.alias("suffix"))
    return identify(base, ["page_id"], "text", "declared", "host", "domain", "suffix", fit_lang="declared")


def accepted_rows(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose language isn't accepted; columns unchanged.

    Rows are matched by a row number of the scan (``docs`` must be a repeatable plan such as a Parquet read),
    so null and repeated ids do no harm. Only rejected rows travel.
    """
    row = free_name(docs, "__row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = identify(numbered.select(row, "text", "lang", "source"), [row], "text", declared="lang", host="source")
    gone = settle(found.where(~F.col("accepted")).select(row))
    return numbered.join(F.broadcast(gone) if small(gone, 1_000_000) else gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
