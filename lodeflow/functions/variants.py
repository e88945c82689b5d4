"""Variant mentions: recognition by patterns, typing, and parsing of positions and of lookups."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeflow.functions.once import bound, once
from lodeflow.functions.text import prefix_sums

# Amino acids, three-letter and one-letter names; X and Ter mean stop.
AMINO = {
    "Ala": "A", "Arg": "R", "Asn": "N", "Asp": "D", "Cys": "C", "Gln": "Q", "Glu": "E", "Gly": "G", "His": "H", "Ile": "I", "Leu": "L",
    "Lys": "K", "Met": "M", "Phe": "F", "Pro": "P", "Ser": "S", "Thr": "T", "Trp": "W", "Tyr": "Y", "Val": "V", "Asx": "B", "Glx": "Z", "Ter": "X", "Stop": "X", "*": "X",
}
#: Largest positions that a protein, a coding and a genomic position of a mention may have.
MOST_CODING = 2_305_000
MOST_PROTEIN = 109_224

_AA3 = "|".join(k for k in AMINO if k != "*")
_PREFIX = r"(?:([cgmnpr])\s?\.\s?)?"
_POS = r"([*-]?[0-9]+(?:[+-][0-9]+)?|IVS\s?-?[0-9]+[+-][0-9]+)"
#: Own recogniser, tried in order: name and pattern, with groups sequence type, then fields.
PATTERNS = [
    ("RSID", r"\b(?:rs)([0-9]{2,})\b"),
    ("DELINS", _PREFIX + _POS + r"(?:_" + _POS + r")?\s?(?:delins|indel|del[ACGT]*ins)([ACGTU]+)"),
    ("FS", r"(?:p\s?\.\s?)?\(?((?:" + _AA3 + r"|[ARNDCQEGHILKMFPSTWYV]))([0-9]+)(?:" + _AA3 + r"|[A-Z])?fs(?:\*|X|Ter)?([0-9]*)\)?"),
    ("DEL", _PREFIX + _POS + r"(?:_" + _POS + r")?\s?del([ACGTU]*)"),
    ("INS", _PREFIX + _POS + r"(?:_" + _POS + r")?\s?ins([ACGTU]+)"),
    ("DUP", _PREFIX + _POS + r"(?:_" + _POS + r")?\s?dup([ACGTU]*)([0-9]*)"),
    ("SUB_DNA", _PREFIX + _POS + r"\s?([ACGTU])\s?(?:>|→|/)\s?([ACGTU])\b"),
    ("SUB_PROT", r"(?:(p)\s?\.\s?)?\(?(" + _AA3 + r"|[ARNDCQEGHILKMFPSTWYV])\s?-?([0-9]+)\s?-?(" + _AA3 + r"|\*|[ARNDCQEGHILKMFPSTWYVX])\)?(?![A-Za-z0-9])"),
]
_MENTION = r"\brs[0-9]{2,}\b|\b[cgmnpr]\s?\.\s?\(?[A-Za-z0-9*+>_-]+\)?|\b(?:" + _AA3 + r")[0-9]+(?:" + _AA3 + r"|fs\S*|\*)|\b[ARNDCQEGHILKMFPSTWYV][0-9]{2,}[ARNDCQEGHILKMFPSTWYVX]\b|\b[0-9]+(?:_[0-9]+)?(?:del|ins|dup)[ACGT]*"


def mention_spans(text: Column) -> Column:
    """Candidate mentions of a text with their offsets, as structs of start, end and body."""
    def spans(pieces: Column) -> Column:
        before = prefix_sums(F.transform(pieces, lambda p: F.length(p)))
        each = F.zip_with(pieces, before, lambda p, at: F.struct(at.alias("start"), (at + F.length(p)).alias("end"), p.alias("body")))
        return F.filter(each, lambda s, i: i % 2 == 1)

    return bound(F.split(F.regexp_replace(text, _MENTION, "\u0002$0\u0002"), "\u0002"), spans)


def one_letter(residue: Column) -> Column:
    """One-letter name of a residue; what isn't a residue stays."""
    names = F.create_map(*[x for k, v in AMINO.items() for x in (F.lit(k.upper()), F.lit(v))])
    return F.coalesce(F.try_element_at(names, F.upper(residue)), residue)


def three_letter(residue: Column) -> Column:
    first: dict[str, str] = {}
    for k, v in AMINO.items():
        first.setdefault(v, k)
    names = F.create_map(*[x for k, v in first.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(names, residue), residue)


def clean_residue(residue: Column) -> Column:
    """Letters and the stop sign only."""
    return F.regexp_replace(residue, r"[^A-Za-z*]", "")


def clean_position(position: Column) -> Column:
    return F.regexp_replace(position, r"[^0-9+*?IVS_-]", "")


def sequence_types(text: Column) -> Column:
    """Explicit prefix letters of a mention among c, g, m, n, p, r."""
    found = F.regexp_extract(F.lower(text), r"^\(?\s?(chr|[cgmnpr])\s?\.", 1)
    return F.when(found != "", F.array(found)).otherwise(F.array().cast("array<string>"))


def types_by_size(position: Column) -> Column:
    """Sequence types that a position of this size may belong to: none without a number, coding ones in introns and behind the stop; limits by the leading number."""
    kinds = lambda *k: F.array(*[F.lit(x) for x in k])

    def sized(v: Column) -> Column:
        first, n = v["first"], v["n"]
        return (
            F.when(first.startswith("*"), kinds("c", "n")).when(first == "", F.when(position.rlike(r"^(?i:IVS|INTRON)"), kinds("c", "n")).otherwise(F.array().cast("array<string>")))
            .when(n.isNull() & ~first.startswith("-"), kinds("chr")).when(n > MOST_CODING, kinds("chr")).when(n > MOST_PROTEIN, kinds("g", "chr"))
            .when(n > MOST_PROTEIN // 3, kinds("c", "n", "g", "chr")).otherwise(kinds("p", "c", "n", "g", "chr"))
        )

    first = F.regexp_extract(position, r"^([*+-]?[0-9]+)", 1)
    return bound(first, lambda f: bound(F.struct(f.alias("first"), F.regexp_replace(f, r"^\+", "").try_cast("bigint").alias("n")), sized))


#: Sequence types in the order of preference; the first set that is allowed as a whole is taken.
PREFERRED = [("c", "n"), ("c",), ("p",), ("n",), ("g",), ("chr",)]


def possible_types(kind: Column, wild_type: Column, mutant: Column, start: Column, end: Column, protein_form: Column) -> Column:
    """Types of a mention without an explicit one: those that its residues, its type and the sizes of both positions allow, by preference; a protein form settles it if allowed."""
    kinds = lambda *k: F.array(*[F.lit(x) for x in k])
    odd = lambda c: F.coalesce(c, F.lit("")).rlike("[^ACGT0-9]")
    first = F.when(odd(wild_type) | odd(mutant) | (kind == "FS"), kinds("p")).otherwise(kinds("p", "c", "n", "g", "chr"))
    size = lambda c: types_by_size(F.coalesce(c, F.lit("")))
    placed = bound(size(start), lambda s: F.when(start.eqNullSafe(end), s).otherwise(F.array_intersect(s, size(end))))
    allowed = F.array_intersect(first, placed)
    none = F.array().cast("array<string>")

    def pick(a: Column) -> Column:
        out = F.when(protein_form & F.array_contains(a, "p"), kinds("p"))
        for k in PREFERRED:
            out = out.when(reduce(Column.__and__, [F.array_contains(a, x) for x in k]), kinds(*k))
        return out.otherwise(none)

    return bound(allowed, pick)


def _struct(kind, seq, start, end, wild, mutant, rsid=None, frame=None, dup=None):
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("mut_type"), F.array_compact(F.array(F.when(seq != "", seq))).alias("seq_types"), F.when(wild != "", wild).alias("wild_type"), F.when(start != "", start).alias("start"),
        F.coalesce(F.when(end != "", end), F.when(start != "", start)).alias("end"), F.when(mutant != "", mutant).alias("mutant"), (none if frame is None else F.when(frame != "", frame)).alias("frameshift"), (none if rsid is None else rsid).alias("rsid"),
        (none if dup is None else F.when(dup != "", dup)).alias("dup"),
    )


def parse_mention(text: Column) -> Column:
    """A mention as a struct of type, sequence types, residues, positions and copies; null if no pattern fits. The first that fits counts.

    Only explicit sequence types are filled in (see ``typed``). The expression holds every pattern, so it should be evaluated once, behind ``parsed``.
    """
    none = F.lit("")

    def fields(name: str, g: Column) -> Column:
        if name == "RSID":
            return _struct("RSID", none, none, none, none, none, rsid=g[0])
        if name == "FS":
            return _struct("FS", F.lit("p"), g[1], none, one_letter(g[0]), none, frame=g[2])
        if name == "SUB_DNA":
            return _struct("SUB", g[0], g[1], none, g[2], g[3])
        if name == "SUB_PROT":
            return bound(F.struct(one_letter(g[1]).alias("w"), one_letter(g[3]).alias("m")), lambda r: _struct("SUB", F.lit("p"), g[2], none, r["w"], r["m"]))
        if name == "DEL":
            return _struct("DEL", g[0], g[1], g[2], g[3], none)
        if name == "DUP":
            return _struct("DUP", g[0], g[1], g[2], g[3], none, dup=g[4])
        return _struct("INDEL" if name == "DELINS" else "INS", g[0], g[1], g[2], none, g[3])

    out = None
    for name, pattern in PATTERNS:
        groups = re.compile(pattern).groups
        # the text around the first match goes and its groups stay, so one search reads them all; none of them can hold the mark
        marked = F.regexp_replace(text, rf"(?s)\A.*?(?:{pattern}).*\z", "\u0001".join(f"${i + 1}" for i in range(groups)))
        there = text.rlike(pattern)
        got = bound(F.split(marked, "\u0001"), lambda g: fields(name, g))  # noqa: B023
        out = F.when(there, got) if out is None else out.when(there, got)
    return out


def typed(v: Column) -> Column:
    """A parsed variant with sequence types: explicit ones stay, others follow from form and size; listed variations need none."""
    kinds = possible_types(v["mut_type"], v["wild_type"], v["mutant"], v["start"], v["end"], F.lit(False))
    return F.when(v.isNotNull(), v.withField("seq_types", F.when((v["mut_type"] == "RSID") | (F.size(v["seq_types"]) > 0), v["seq_types"]).otherwise(kinds)))


def parsed(df: DataFrame, mention: str = "mention", out: str = "var") -> DataFrame:
    """Adds the typed variant of a mention, or null; the patterns are tried once a row, whatever is read of it."""
    return once(once(df, {"__parsed": parse_mention(F.col(mention))}), {out: typed(F.col("__parsed"))}).drop("__parsed")


def valid_variant(v: Column) -> Column:
    """Whether a parsed variant is complete: both residues of a substitution, a sequence type and a start unless it is listed, a plain inserted sequence."""
    kind = v["mut_type"]
    sub = (kind != "SUB") | (v["wild_type"].isNotNull() & v["mutant"].isNotNull())
    placed = (kind == "RSID") | (v["start"].isNotNull() & (F.size(v["seq_types"]) > 0))
    inserted = ~kind.isin("INS", "INDEL") | F.coalesce(v["mutant"], F.lit("")).rlike("^[A-Z]*$")
    return v.isNotNull() & sub & placed & inserted


def type_of_tags(tags: Column) -> Column:
    """Mutation type from the tags of a mention's tokens (R, F, then words of the T field)."""
    words = F.upper(F.array_join(F.transform(F.filter(tags, lambda t: t["tag"] == "T"), lambda t: t["token"]), " "))
    there = lambda k: F.exists(tags, lambda t: t["tag"] == k)
    return F.when(there("R"), "RSID").when(there("F"), "FS").when(words.contains("DEL") & words.contains("INS"), "INDEL").when(words.contains("DEL"), "DEL").when(words.contains("INS"), "INS").when(words.contains("DUP"), "DUP").otherwise("SUB")


def is_protein_run(tags: Column) -> Column:
    """Tags W, P and M in a row: a protein mention."""
    return F.array_join(tags, "").contains("WPM")


def parse_lookup(query: Column) -> Column:
    """A user's variant as a struct of type, sequence type, start, end, ref and alt; null if it has no known form."""
    def g(pattern, i):
        return F.regexp_extract(query, pattern, i)

    def row(kind, seq, start, ref, alt, end=None):
        none = F.lit(None).cast("string")
        return F.struct(F.lit(kind).alias("mut_type"), seq.alias("seq"), start.alias("start"), (start if end is None else F.when(end != "", end).otherwise(start)).alias("end"), (none if ref is None else F.when(ref != "", ref)).alias("ref"), (none if alt is None else F.when(alt != "", alt)).alias("alt"))

    def seq(pattern, default):
        return F.when(g(pattern, 1) != "", g(pattern, 1)).otherwise(F.lit(default))

    place = r"((?:(?:IVS|ivs|Intron|intron)[0-9]+(?:[-+][0-9]+)?|[-*]?[0-9]+(?:[+-][0-9]+)?))"
    coding, span, tail = r"^(?:([cgmnr])\.)?", place + f"(?:_{place})?", r"(?:bp)?[\])]?;?$"
    residue = f"({_AA3}|[ARNDBCEQZGHILKMFPSTWYVX*])"
    forms = [
        (r"^rs([0-9]+)$", lambda p: row("RSID", F.lit(None).cast("string"), g(p, 1), None, None)),
        (rf"^(?:(p)\.)?{residue}([0-9]+){residue}$", lambda p: row("SUB", F.lit("p"), g(p, 3), one_letter(g(p, 2)), one_letter(g(p, 4)))),
        (coding + r"([ACGT])([0-9]+)([ACGT])$", lambda p: row("SUB", seq(p, "c"), g(p, 3), g(p, 2), g(p, 4))),
        (coding + span + r"([ACGT]+)[>/]([ACGT]+)$", lambda p: row("SUB", seq(p, "c"), g(p, 2), g(p, 4), g(p, 5), g(p, 3))),
        (rf"^(?:(p)\.)?([0-9]+){residue}[>/]{residue}[\])]?;?$", lambda p: row("SUB", F.lit("p"), g(p, 2), one_letter(g(p, 3)), one_letter(g(p, 4)))),
        (coding + span + r"del([ACGT0-9]*)" + tail, lambda p: row("DEL", seq(p, "c"), g(p, 2), g(p, 4), None, g(p, 3))),
        (coding + span + r"dup([ACGT0-9]*)" + tail, lambda p: row("DUP", seq(p, "c"), g(p, 2), g(p, 4), None, g(p, 3))),
        (coding + span + r"ins([ACGT]*)" + tail, lambda p: row("INS", seq(p, "c"), g(p, 2), None, g(p, 4), g(p, 3))),
        (coding + span + r"(?:del([ACGT0-9]*)ins|indel)([ACGT]*)$", lambda p: row("INDEL", seq(p, "c"), g(p, 2), g(p, 4), g(p, 5), g(p, 3))),
    ]
    out = None
    for pattern, make in forms:
        there = query.rlike(pattern)
        out = F.when(there, make(pattern)) if out is None else out.when(there, make(pattern))
    return out


def parse_position(text: Column) -> Column:
    """A position as a struct of pos, offset, utr3 and intron; null for unknown ones (``?``)."""
    plain = r"^(\*)?(-?[0-9]+)([+-][0-9]+)?$"
    intron = r"^(?i:IVS|intron)\s?-?([0-9]+)([+-][0-9]+)$"
    number = lambda p, i: F.coalesce(F.try_to_number(F.nullif(F.regexp_replace(F.regexp_extract(text, p, i), r"^\+", ""), F.lit("")), F.lit("S999999999999")).cast("bigint"), F.lit(0).cast("bigint"))
    none = F.lit(None).cast("bigint")
    digits = F.struct(text.try_cast("bigint").alias("pos"), F.lit(0).cast("bigint").alias("offset"), F.lit(False).alias("utr3"), none.alias("intron"))
    return F.when(text.rlike(r"\A[0-9]{1,12}\z"), digits).when(text.contains("?"), F.lit(None)).when(text.rlike(plain), F.struct(number(plain, 2).alias("pos"), number(plain, 3).alias("offset"), (F.regexp_extract(text, plain, 1) == "*").alias("utr3"), none.alias("intron"))).when(text.rlike(intron), F.struct(none.alias("pos"), number(intron, 2).alias("offset"), F.lit(False).alias("utr3"), number(intron, 1).alias("intron")))


def drop_look_alikes(df: DataFrame, tokens: str) -> DataFrame:
    """Mentions whose first two tokens read as a figure or a chromosome go."""
    head = F.lower(F.concat(F.col(tokens)[0], F.coalesce(F.try_element_at(F.col(tokens), F.lit(2)), F.lit(""))))
    return df.where(~head.rlike("^(fig|chr)[0-9]+$"))
