"""Secret scan with linking of credentials that are spread over several parts."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

from pyspark.sql import DataFrame

from lodeflow.llm.common import map_rows, session

#: Code points between two parts of one scope, at most.
SCOPE = 200

#: Base kinds, in the order of reports.
BASE = ("assign", "access", "hex")
#: Kinds that the linking adds.
LINKED = ("secret", "identifier", "endpoint")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
# weak parts: each alone is ordinary text
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/]*[0-9])(?=[a-z0-9+/]*[A-Z])(?=[A-Z0-9+/]*[a-z])[A-Za-z0-9+/]{24,}+={0,2}(?![A-Za-z0-9+/_-])", re.A)
_IDENTIFIER = re.compile(r"""(?:client_?id|access_?key_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}""", re.I | re.A)
_ENDPOINT = re.compile(r"""(?:https?|ssh|sftp|ftp|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+""", re.A)


class Parts:
    """Spans of one part that don't overlap, sorted; finds the ones near an interval by binary search."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = spans
        self.ends = [b for _, b in spans]

    def near(self, start: int, end: int, gap: int) -> bool:
        i = bisect_left(self.ends, start - gap)
        return i < len(self.spans) and self.spans[i][0] <= end + gap


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    assign = [m.span() for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8] if "=" in text or ":" in text else []
    return {"assign": assign, "access": [m.span() for m in _ACCESS.finditer(text)], "hex": [m.span() for m in _HEX.finditer(text)]}


def linked_spans(text: str, base: dict[str, list[tuple[int, int]]], scope: int = SCOPE) -> list[tuple[str, int, int]]:
    """Weak parts that are joined with complementary ones within the scope.

    A weak secret needs an identifier (an access id or a named one); a weak identifier needs a secret (a base one
    or a weak one) and an endpoint; an endpoint needs an identifier and a secret. Weak parts inside base spans are those.
    """
    named = [m.span() for m in _IDENTIFIER.finditer(text)] if "=" in text or ":" in text else []
    points = [m.span() for m in _ENDPOINT.finditer(text)] if "://" in text else []
    if not (base["access"] or named):
        return []
    taken = [Parts(base[k]) for k in BASE]

    def free(s):
        return not any(p.near(s[0] + 1, s[1] - 1, 0) for p in taken)

    weak = [s for s in (m.span() for m in _SECRET.finditer(text)) if free(s)]
    ids, named_p = Parts(base["access"]), Parts(named)
    strong, weak_p, points_p = (Parts(sorted(base["assign"] + base["hex"])), Parts(weak), Parts(points))
    strong = Parts(_flat(strong.spans))

    def has_id(s):
        return ids.near(*s, scope) or named_p.near(*s, scope)

    def has_secret(s):
        return strong.near(*s, scope) or weak_p.near(*s, scope)

    out = [("secret", *s) for s in weak if has_id(s)]
    out += [("identifier", *s) for s in named if free(s) and has_secret(s) and points_p.near(*s, scope)]
    out += [("endpoint", *s) for s in points if has_id(s) and has_secret(s)]
    return out


def _flat(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of sorted spans."""
    out: list[tuple[int, int]] = []
    for a, b in spans:
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def scan_text(text: str | None, scope: int = SCOPE) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """Base spans by kind, and all spans in order of start, then kind."""
    text = text or ""
    base = base_spans(text)
    spans = [(k, *s) for k in BASE for s in base[k]] + linked_spans(text, base, scope)
    rank = {k: i for i, k in enumerate((*BASE, *LINKED))}
    return base, sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def scan(docs: DataFrame, id_col: str = "doc_id", scope: int = SCOPE) -> DataFrame:
    """(id_col, spans): all spans of every whole text, with kind and code-point offsets (end exclusive).

    A scope is a neighbourhood within one document, so the interval join of identifiers, secrets and endpoints is
    a sorted search inside each text and nothing is shuffled. Defined results: null and empty texts have
    no spans; repeated rows give a row each; null ids stay; other columns are not read.
    """
    session(docs)

    def make():
        def run(ids, texts):
            return [ids, [[{"kind": k, "start": a, "end": b} for k, a, b in scan_text(t, scope)[1]] for t in texts]]

        return run

    return map_rows(docs, [id_col, "text"], f"`{id_col}` {dict(docs.dtypes)[id_col]}, spans array<struct<kind:string,start:int,end:int>>", make)


def _is(kind: str):
    return lambda s: s["kind"] == kind


def digest(found: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` from the spans of documents."""
    from pyspark.sql import functions as F

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    counts = [F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
