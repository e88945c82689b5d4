"""Text functions as column expressions: cleaning, tokenizing, keys, shapes, sentences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Greek letters and their spelled names, in alphabetical order of the script (capital and small).
GREEK = [
    ("Α", "Alpha"), ("Β", "Beta"), ("Γ", "Gamma"), ("Δ", "Delta"), ("Ε", "Epsilon"), ("Ζ", "Zeta"), ("Η", "Eta"), ("Θ", "Theta"),
    ("Ι", "Iota"), ("Κ", "Kappa"), ("Λ", "Lambda"), ("Μ", "Mu"), ("Ν", "Nu"), ("Ξ", "Xi"), ("Ο", "Omicron"), ("Π", "Pi"),
    ("Ρ", "Rho"), ("Σ", "Sigma"), ("Τ", "Tau"), ("Υ", "Upsilon"), ("Φ", "Phi"), ("Χ", "Chi"), ("Ψ", "Psi"), ("Ω", "Omega"),
    ("α", "alpha"), ("β", "beta"), ("γ", "gamma"), ("δ", "delta"), ("ε", "epsilon"), ("ζ", "zeta"), ("η", "eta"), ("θ", "theta"),
    ("ι", "iota"), ("κ", "kappa"), ("λ", "lambda"), ("μ", "mu"), ("ν", "nu"), ("ξ", "xi"), ("ο", "omicron"), ("π", "pi"),
    ("ρ", "rho"), ("σ", "sigma"), ("τ", "tau"), ("υ", "upsilon"), ("φ", "phi"), ("χ", "chi"), ("ψ", "psi"), ("ω", "omega"),
]
#: Letters with marks and the ASCII letters that they are written as, pair by pair.
_MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöøùúûüýÿ–—−‐‑’‘“”×·… "
_PLAIN = "AAAAAACEEEEIIIINOOOOOOUUUUYaaaaaaceeeeiiiinoooooouuuuyy-----''\"\"x.. "
_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def unescape(text: Column) -> Column:
    """The common character entities; the ampersand last."""
    for name, char in _ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def clean_text(text: Column) -> Column:
    """Plain ASCII line: entities, a space where plain and other characters meet, Greek letters by name, marks dropped, white space collapsed."""
    out = unescape(text)
    out = F.regexp_replace(out, r"(?<=[\x20-\x7E])(?=[^\x20-\x7E\s])|(?<=[^\x20-\x7E\s])(?=[\x20-\x7E])", " ")
    out = F.regexp_replace(out, r"[\r\n]+", " ")
    for letter, name in GREEK:
        out = F.replace(out, F.lit(letter), F.lit(name + " "))
    out = F.replace(F.replace(out, F.lit("ß"), F.lit("ss")), F.lit("æ"), F.lit("ae"))
    out = F.translate(out, _MARKED, _PLAIN)
    return F.regexp_replace(F.trim(F.regexp_replace(out, r"\s+", " ")), r"[^\x20-\x7E]", "")


def variant_tokens(text: Column) -> Column:
    """Tokens of variant mentions: breaks between letters and digits, upper and lower case, before ``fs``, around punctuation; at most 50 characters."""
    broken = F.regexp_replace(text, r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|(?<=[A-Z])(?=[a-z])|(?<=[a-z])(?=[A-Z])|(?<=[A-Za-z])(?=fs)|(?<=[^A-Za-z0-9\s])(?=\S)|(?<=\S)(?=[^A-Za-z0-9\s])", " ")
    return cut_long(F.filter(F.split(broken, r"\s+"), lambda t: t != ""))


_GENE_TOKEN = r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\s]"


def gene_tokens(text: Column) -> Column:
    """Runs of letters, runs of digits, single other characters; at most 50 characters each."""
    return cut_long(F.regexp_extract_all(text, F.lit(_GENE_TOKEN), F.lit(0)))


def gene_token_spans(text: Column, most: int = 50) -> Column:
    """The tokens of ``gene_tokens`` as structs of token and start: the lengths between marks around the matches, added up."""
    pieces = F.split(F.regexp_replace(F.translate(text, "\u0002", "\u0003"), _GENE_TOKEN, "\u0002$0\u0002"), "\u0002")
    spans = F.filter(F.zip_with(pieces, prefix_sums(F.transform(pieces, lambda p: F.length(p))), lambda p, at: F.struct(p.alias("token"), at.alias("start"))), lambda s, i: i % 2 == 1)
    cut = lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.length(s["token"]) - 1) / most).cast("int")), lambda i: F.struct(F.substring(s["token"], i * most + 1, F.lit(most)).alias("token"), (s["start"] + i * most).alias("start")))
    return F.flatten(F.transform(spans, cut))


def cut_long(tokens: Column, most: int = 50) -> Column:
    """Cuts tokens longer than ``most`` into parts of that length."""
    return F.flatten(F.transform(tokens, lambda t: F.transform(F.sequence(F.lit(0), F.greatest(F.floor((F.length(t) - 1) / most), F.lit(0)).cast("int")), lambda i: F.substring(t, i * most + 1, F.lit(most)))))


def prefix_sums(numbers: Column, step: int = 128) -> Column:
    """For each number of an array the sum of those before it. Sums of blocks come first, so n numbers take about n * (n / step + step) / 2 additions and no array is copied for each."""
    zero = F.lit(0)
    add = lambda a: F.aggregate(a, zero, lambda s, x: s + x)
    blocks = F.transform(F.sequence(zero, F.floor(F.size(numbers) / step).cast("int")), lambda b: add(F.slice(numbers, b * step + 1, F.lit(step))))

    def before(held: Column) -> Column:
        return F.transform(held["n"], lambda x, i: add(F.slice(held["b"], F.lit(1), F.floor(i / step).cast("int"))) + add(F.slice(held["n"], F.floor(i / step).cast("int") * step + 1, i % step)))

    return F.transform(F.array(F.struct(numbers.alias("n"), blocks.alias("b"))), before)[0]


def token_offsets(text: Column, tokens: Column) -> Column:
    """Start (from 0) of each token, found one after the other in the text. For short texts and any tokens; ``gene_token_spans`` has the offsets of whole bodies in one pass."""
    start = F.array().cast("array<int>")

    def step(acc, token):
        at = F.call_function("locate", token, text, acc["pos"])
        return F.struct((at + F.length(token)).alias("pos"), F.concat(acc["at"], F.array(at - 1)).alias("at"))

    return F.aggregate(tokens, F.struct(F.lit(1).alias("pos"), start.alias("at")), step, lambda acc: acc["at"])


def name_words(name: Column) -> Column:
    """Name as lower-case words: a space where digits meet other characters, other signs to spaces; trailing space and ``gene`` cut."""
    spaced = F.regexp_replace(name, r"(?<=[0-9])(?=[^0-9])|(?<=[^0-9])(?=[0-9])", " ")
    plain = F.regexp_replace(F.regexp_replace(F.lower(spaced), r"[^a-z0-9]", " "), r" +", " ")
    return F.when(F.length(name) > 0, F.regexp_replace(F.regexp_replace(plain, r" $", ""), r"gene$", ""))


def name_key(name: Column) -> Column:
    """The words of a name run together."""
    return F.replace(name_words(name), F.lit(" "), F.lit(""))


def without_h(key: Column) -> Column:
    """A key without its leading h, for a second try; null if it has none."""
    return F.when(key.startswith("h") & (F.length(key) > 1), F.substring(key, F.lit(2), F.length(key)))


def upper_key(name: Column) -> Column:
    """Letters and digits only, in upper case."""
    return F.upper(F.regexp_replace(name, r"[^A-Za-z0-9]", ""))


def accession(name: Column) -> Column:
    """An accession without its version."""
    return F.split_part(name, F.lit("."), F.lit(1))


def int_list(text: Column) -> Column:
    """A comma-separated list of numbers as an array; empty parts don't count."""
    return F.transform(F.filter(F.split(text, ","), lambda x: x != ""), lambda x: x.cast("bigint"))


def shape(token: Column, kind: int) -> Column:
    """Shapes: 1 keeps lengths (Aa0), 2 collapses runs, 3 letters alike, 4 letters alike with runs collapsed."""
    if kind in (1, 2):
        out = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[A-Z]", "A"), "[a-z]", "a"), "[0-9]", "0")
    else:
        out = F.regexp_replace(F.regexp_replace(token, "[A-Za-z]", "a"), "[0-9]", "0")
    return F.regexp_replace(out, r"(.)\1+", "$1") if kind in (2, 4) else out


def affixes(token: Column, n: int = 5, front: bool = True) -> Column:
    """First (or last) 1 to n characters; null where the token is shorter."""
    return F.array(*[F.when(F.length(token) >= k, F.substring(token, 1, k) if front else F.right(token, F.lit(k))) for k in range(1, n + 1)])


def capped_count(token: Column, pattern: str, cap: int = 4) -> Column:
    """How many matches of a pattern, written ``4+`` from the cap on."""
    n = F.regexp_count(token, F.lit(pattern))
    return F.when(n >= cap, F.lit(f"{cap}+")).otherwise(n.cast("string"))


def sentences(text: Column) -> Column:
    """Sentences of a line: cut after . ! ? before a capital or digit, but not after short forms such as ``fig.``."""
    held = F.regexp_replace(text, r"(?i)\b(fig|figs|e\.g|i\.e|et al|vs|no|ref|dr)\.\s+", "$1.\u0001")
    return F.transform(F.split(held, r"(?<=[.!?])\s+(?=[A-Z0-9])"), lambda s: F.replace(s, F.lit("\u0001"), F.lit(" ")))


def chop(text: Column, most: int = 2000) -> Column:
    """Parts of at most ``most`` characters."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.length(text) - 1, F.lit(0)) / most).cast("int")), lambda i: F.substring(text, i * most + 1, F.lit(most)))


def block_of(start: Column, size: int = 5000) -> Column:
    """Number of the fixed-size block that an offset lies in."""
    return F.floor(start / size)


def body_limit(body: Column, most: int = 100_000) -> Column:
    return F.substring(body, 1, most)


_CAPTION = r"^\s*(?:Supp(?:\.|lemental|lementary)?\s*)?(?:[Tt]able|TABLE)\s*S?(VIII|VII|VI|IV|IX|III|II|I|V|X|[0-9]+|[A-L])(?![A-Za-z])"


def caption_number(line: Column) -> Column:
    """Label of a table caption (arabic, roman or a letter), or null: ``Table IV. ...``, ``TABLE 2: ...``, ``Supplementary Table S1``."""
    found = F.regexp_extract(line, _CAPTION, 1)
    return F.when(found != "", found)


def is_caption(line: Column, flags: Column) -> Column:
    """A caption line counts if a colon follows the label, if it is set bold or italic, or if it is a single sentence."""
    styled = flags.bitwiseAND(F.lit(18)) != 0
    colon = line.rlike(_CAPTION + r"\s*:")
    return caption_number(line).isNotNull() & (colon | styled | (F.size(sentences(line)) == 1))


def remap_glyphs(text: Column, font: Column, maps: dict[str, tuple[str, str]]) -> Column:
    """Characters that certain fonts encode differently, by font name."""
    out = text
    for name, (have, want) in maps.items():
        out = F.when(font == name, F.translate(text, have, want)).otherwise(out)
    return out


def element_or(array: Column, i: Column | int, default) -> Column:
    """Element at a position from 0, or a default."""
    at = (i if isinstance(i, Column) else F.lit(i)) + 1
    return F.coalesce(F.try_element_at(array, at), F.lit(default))


def reverse_plus_one(array: Column) -> Column:
    return F.reverse(F.transform(array, lambda x: x + 1))


def signed(n: Column) -> Column:
    """A number with its sign, plus too."""
    return F.format_string("%+d", n)


def fanout_path(name: Column) -> Column:
    """Two-level folder from a hash of a name."""
    h = F.upper(F.md5(name))
    return F.concat_ws("/", F.substring(h, 1, 2), F.substring(h, 3, 2), name)


#: Kinds of tokens in the order that they are tried, each with the pattern of the token. Patterns match from
#: the front; "next" kinds look at the token behind, "fold" ones at the token in lower case.
TOKEN_TYPES = [
    ("-Type_cytochrome-", "^(ytochrome|cytochrome)$", ""),
    ("-Type_target-", "^.*target$", ""),
    ("-Type_ExperimentNoun-", "^.*(irradiation|hybrid|fusion|experiment|gst|est|gap|antigen)$", ""),
    ("-Type_Disease-", "^.*(disease|disorder|dystrophy|deficiency|syndrome|dysgenesis|cancer|injury|neoplasm|diabetes|diabete)$", ""),
    ("-Type_DomainMotif-", "^.*(motif|domain|omain|binding|site|region|sequence|frameshift|finger|box).*$", ""),
    ("-Type_DomainMotif-", "^-$", "^.*(motif|domain|omain|binding|site|region|sequence|frameshift|finger|box).*$"),
    ("-Type_DomainMotif-", "^[rmc]$", "^(DNA|RNA)$"),
    ("-Type_Family-", "^.*(famil|complex|cluster|proteins|genes|factors|transporter|proteinase|membrane|ligand|enzyme|channels|tors|ase|ases)$", ""),
    ("-Type_Marker-", "fold:^marker", ""),
    ("-Type_Cell-", "^(T|B|monocytic|cancer|tumor|myeloma|epithelial|crypt)$", "^cell$"),
    ("-Type_ChromosomeStrain-", "^[pq]$", "^[0-9]+$"),
    ("-Type_ChromosomeStrain-", "^[pq]$", "before:^[0-9]+$"),
    ("-Type_relation-", "^.*(related|regulated|associated|correlated|reactive).*$", ""),
    ("-Type_VariationTerms-", "fold:^.*(polymorphism|mutation|deletion|insertion|duplication|genotype|genotypes).*$", ""),
    ("-Type_suffix-", "^.*(oxidase|transferase|transferases|kinase|kinese|subunit|unit|receptor|adrenoceptor|transporter|regulator|transcription|antigen|protein|gene|factor|member|molecule|channel|deaminase|spectrin).*", ""),
    ("-Type_strain-", "^[-_(]$", "fold:^.*(alpha|beta|gamma|delta|theta|kappa|zeta|sigma|omega|i|ii|iii|iv|v|vi|[abcdefgyr])$"),
    ("-Type_strain-", "^(alpha|beta|gamma|delta|theta|kappa|zeta|sigma|omega|i|ii|iii|iv|v|vi|[abcdefgyr])$", ""),
]
#: Fixed value: what features without a value are.
NO_FEATURE = "__nil__"
#: What is put before and behind a line that is searched, and the part of speech that all tokens get.
PAD, PAD_BEHIND, PART_OF_SPEECH = "blablabla, ", ", blablabla, ", "NN"


def token_type(token: Column, before: Column, behind: Column) -> Column:
    """Kind of a token, from itself and its neighbours (null where there is none); the first of ``TOKEN_TYPES`` that fits."""
    def fits(pattern: str, at: Column) -> Column:
        way, _, body = pattern.rpartition(":")
        subject = before if way == "before" else at
        return F.coalesce((F.lower(subject) if way == "fold" else subject).rlike(body), F.lit(False))

    out = F.lit(NO_FEATURE)
    for name, own, other in reversed(TOKEN_TYPES):
        out = F.when(fits(own, token) & fits(other, behind) if other else fits(own, token), name).otherwise(out)
    return out


def token_types(tokens: Column) -> Column:
    """Kinds of all tokens of an array."""
    return F.transform(tokens, lambda t, i: token_type(t, F.when(i > 0, F.get(tokens, i - 1)), F.get(tokens, i + 1)))


def constant_features(tokens: Column) -> Column:
    """Features that no token has a value of: abbreviation state, and part of speech."""
    return F.transform(tokens, lambda t: F.struct(F.lit(NO_FEATURE).alias("abbreviation"), F.lit(PART_OF_SPEECH).alias("pos")))


def padded(line: Column) -> Column:
    """A line as it is searched: between paddings, so that matches at its ends have neighbours."""
    return F.concat(F.lit(PAD), line, F.lit(PAD_BEHIND))


def unpadded(span: Column, line_start: Column) -> Column:
    """A span (struct of start, end) found in a padded line, as one of the text whose line begins at ``line_start``."""
    shift = line_start - F.lit(len(PAD))
    return F.struct((span["start"] + shift).alias("start"), (span["end"] + shift).alias("end"))
