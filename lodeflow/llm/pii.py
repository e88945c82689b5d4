"""Personal data found by column expressions only: patterns propose, checksums confirm, context words weigh."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds, in the order of reports, and the kind that the checksum method adds.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban")

#: Marks that stand in for characters of a match's inside, and around matches; never left in a text.
_IN, _AROUND = "\x01", "\x02"
#: What these become if a text holds them: characters that no pattern knows either.
_OTHERS = "\x03\x04"
#: Elements of a block in prefix sums.
_STEP = 128
#: Code points on both sides of a span that are searched for context words.
CONTEXT = 40

# Each pattern finds what the plain one in its comment finds, leftmost and without overlap, but takes one pass: a run
# is entered at its start only (or where the last match ended), never given back, and has no group to repeat.
# email: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+, after dots that no label follows became _IN
_LOCAL = r"A-Za-z0-9._%+\x01-"
_EMAIL = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]++"
# ip: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
_IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_IP_PARTS = r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9]?)(?:\.|$)){4}$"
# card: [0-9]([\x20-]?[0-9])+ of 16 digits at least, after separators between two digits became _IN
_CARD = r"(?<![0-9\x01])[0-9][0-9\x01]{15,}+"
# phone: \+[0-9][\x20().0-9-]+[0-9]
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"

#: Score of a span by its form alone, what context adds, and the words that count as context.
SCORES = {
    "email": (0.80, 0.15, r"mail|contact|kontakt|correo|courriel|@"),
    "ip": (0.50, 0.30, r"(^|[^a-z0-9_])ip([^a-z0-9_]|$)|address|adresse|host|server|login"),
    "card": (0.75, 0.20, r"card|visa|master|amex|karte|tarjeta|carte|credit|cvv|expir"),
    "phone": (0.60, 0.30, r"phone|tel([^a-z0-9_]|$)|call|mobile|fax|telefon|llama|appel"),
    "iban": (0.85, 0.10, r"iban|bank|konto|account|compte|cuenta|bic|swift"),
}


def _marked(text: Column, pattern: str) -> Column:
    """Pieces of a text: before, match, between, match, ..., after."""
    return F.split(F.regexp_replace(text, pattern, f"{_AROUND}$0{_AROUND}"), _AROUND)


def _ends(pieces: str) -> Column:
    """Matches among the pieces as structs of start, end and piece number, by two-level prefix sums.

    Sums of blocks of lengths come first, so a text with n matches takes about n * (n / 128 + 128) steps.
    """
    return F.expr(f"""
        transform(filter(sequence(1, greatest(size({pieces}) - 1, 1)), i -> i % 2 = 1 and i < size({pieces})), i -> named_struct(
            'piece', i,
            'start', aggregate(slice({pieces}_sums, 1, i div {_STEP}), 0, (a, x) -> a + x)
                   + aggregate(slice({pieces}_lens, (i div {_STEP}) * {_STEP} + 1, i % {_STEP}), 0, (a, x) -> a + x),
            'length', element_at({pieces}_lens, i + 1),
            'body', element_at({pieces}, i + 1)))""")


def _luhn(digits: Column) -> Column:
    """Luhn's check: every second digit from the right is doubled."""
    n = F.length(digits)

    def add(a, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
        return a + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def _mod97(body: Column) -> Column:
    """ISO 7064 mod 97-10 over an account number with its first four characters moved behind."""
    compact = F.replace(body, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.substring(compact, 1, 4))

    def step(a, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (a * 10 + c - 48) % 97).otherwise((a * 100 + c - 55) % 97)

    return (F.length(compact) <= 34) & (F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


_VALID = {
    "email": lambda b: F.lit(True),
    "ip": lambda b: b.rlike(_IP_PARTS),
    "card": lambda b: F.length(_digits(b)).between(16, 19) & _luhn(_digits(b)),
    "phone": lambda b: F.length(_digits(b)).between(8, 15),
    "iban": _mod97,
}


def _valid(kind: str):
    return lambda s: _VALID[kind](s["body"])


def _is(kind: str):
    return lambda s: s["kind"] == kind


def find(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, spans): personal data in every whole text, as structs of kind, start, end (code points) and score.

    A pattern proposes spans, a validator (parts of addresses, Luhn, digit counts, mod 97) drops wrong ones without
    another try, and the score rises if a context word stands near. Everything is built-in expressions on the
    scan's rows: no shuffle, no Python. A kind's work is done only on texts that hold its telling character.
    Offsets come from the lengths of what lies between matches. Defined results: null and empty texts have no spans;
    repeated rows give a row each; null ids stay; other columns are not read.
    """
    t = F.translate(F.coalesce(F.col("text"), F.lit("")), _IN + _AROUND, _OTHERS)
    base = docs.select(F.col(id_col).alias("id"), t.alias("t"))
    dotted = F.regexp_replace("t", r"\.(?![A-Za-z0-9-])", _IN)
    joined = F.regexp_replace("t", r"(?<=[0-9])[\x20-](?=[0-9])", _IN)
    found = {
        "email": (F.col("t").contains("@"), dotted, _EMAIL),
        "ip": (F.col("t").rlike(r"[0-9]\.[0-9]++\.[0-9]"), F.col("t"), _IP),
        "card": (F.col("t").rlike(r"[0-9][0-9\x20-]{14}"), joined, _CARD),
        "phone": (F.col("t").contains("+"), F.col("t"), _PHONE),
        "iban": (F.col("t").rlike(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[\x20A-Z0-9]{11}"), F.col("t"), _IBAN),
    }
    none = F.array(F.lit("").cast("string"))
    cut = base.select("id", "t", *[F.when(there, _marked(text, pattern)).otherwise(none).alias(k) for k, (there, text, pattern) in found.items()])
    lens = cut.select("*", *[F.transform(F.col(k), F.length).alias(f"{k}_lens") for k in KINDS])
    sums = lens.select("*", *[F.expr(f"transform(sequence(0, (size({k}) - 1) div {_STEP}), b -> aggregate(slice({k}_lens, b * {_STEP} + 1, {_STEP}), 0, (a, x) -> a + x))").alias(f"{k}_sums") for k in KINDS])
    placed = sums.select("id", "t", *[F.when(F.size(k) > 1, F.filter(_ends(k), _valid(k))).alias(k) for k in KINDS])
    return placed.select(F.col("id").alias(id_col), F.concat(*[F.coalesce(_scored(k), F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")) for k in KINDS]).alias("spans"))


def _scored(kind: str) -> Column:
    alone, more, context = SCORES[kind]

    def one(s):
        before = F.substring(F.col("t"), F.greatest(s["start"] + 1 - CONTEXT, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))
        after = F.substring(F.col("t"), s["start"] + s["length"] + 1, F.lit(CONTEXT))
        near = F.lower(F.concat_ws(" ", before, after)).rlike(context)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + s["length"]).alias("end"), F.when(near, F.lit(alone + more)).otherwise(F.lit(alone)).alias("score"))

    return F.transform(F.col(kind), one)


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores`` from the spans of documents.

    ``scores``: of each span in order, in hundredths, comma-joined.
    """

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), F.array_join(F.transform("spans", lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",").alias("scores"))
