"""Papers from files: dispatch by name and signature, and readers for markup, office, sheet, text, csv and zip files."""

from __future__ import annotations

import csv
import io
import re
import signal
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodeflow.session import limit_batches

#: Schema of a parsed file: body text and tables with a caption and a grid of cell texts.
PARSED = "status string, body string, tables array<struct<label:string,caption:string,cells:array<array<string>>>>"
#: Characters of a body at most.
MOST_BODY = 100_000
#: Nested archives are opened to this depth.
ZIP_DEPTH = 4

#: First bytes of file formats.
_PDF, _ZIP, _OLE = "25504446", "504B0304", "D0CF11E0"


def files(spark: SparkSession, path: str, only: str | None = None) -> DataFrame:
    """paper_id (folder), file_idx (by name within the paper), filename, content of the files below a folder of papers."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if only:
        read = read.option("pathGlobFilter", only)
    parts = F.split("path", "/")
    raw = read.load(path).select(F.element_at(parts, -2).alias("paper_id"), F.element_at(parts, -1).alias("filename"), "content")
    return raw.withColumn("file_idx", F.row_number().over(Window.partitionBy("paper_id").orderBy("filename")) - 1)


def kind_of(filename: Column, content: Column | None = None) -> Column:
    """Reader for a file, by extension and, where content is given, by first bytes; null if there is none."""
    ext = F.lower(F.regexp_extract(filename, r"\.([A-Za-z0-9]+)$", 1))
    head = F.hex(F.substring(content, 1, 4)) if content is not None else None
    is_ = (lambda sig: head == sig) if head is not None else (lambda sig: F.lit(True))
    text = ~head.isin(_PDF, _ZIP, _OLE) if head is not None else F.lit(True)
    return (
        F.when(ext.isin("xml", "nxml", "html", "htm", "xhtml") & text, "markup").when((ext == "docx") & is_(_ZIP), "docx").when((ext == "doc") & is_(_OLE), "doc")
        .when((ext == "xlsx") & is_(_ZIP), "xlsx").when((ext == "xls") & is_(_OLE), "xls").when((ext == "csv") & text, "csv").when((ext == "txt") & text, "txt")
        .when((ext == "zip") & is_(_ZIP), "zip").when((ext == "pdf") & is_(_PDF), "pdf")
    )


def sentences(text: str) -> list[str]:
    held = re.sub(r"(?i)\b(figs?|e\.g|i\.e|et al|vs|no|ref|dr)\.\s+", lambda m: m[1] + ".\x01", text)
    return [s.replace("\x01", " ") for s in re.split(r"(?<=[.!?])\s+(?=[A-Z0-9])", held) if s.strip()]


def _line(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def _body(paragraphs: list[str]) -> str:
    return "\n".join(s for p in paragraphs for s in sentences(_line(p)))


class _Markup(HTMLParser):
    """Title, paragraphs outside tables, and tables with the caption of the nearest element that has a label."""

    VOID = {"br", "img", "hr", "meta", "link", "input", "area", "base", "col", "embed", "source", "wbr", "break", "xref", "graphic"} - {"xref"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.paragraphs, self.tables = "", [], []
        self.stack: list[dict] = []

    def handle_starttag(self, tag, attrs):
        tag = tag.split(":")[-1]
        if tag in ("br", "break"):
            self.handle_data(", ")
            return
        if tag in self.VOID:
            return
        if tag in ("td", "th", "tr", "p") and self.stack:
            self._close_open(tag)
        node = {"tag": tag, "text": [], "label": None, "caption": None, "rows": []}
        self.stack.append(node)
        if tag == "table":
            node["at"] = len(self.tables)
            self.tables.append({"label": None, "caption": "", "cells": []})

    def handle_startendtag(self, tag, attrs):
        if tag.split(":")[-1] in ("br", "break"):
            self.handle_data(", ")

    def _close_open(self, tag):
        """Cells, rows and paragraphs that were left open."""
        stop = {"td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",), "p": ("td", "th", "body", "div", "sec", "article", "section", "table")}[tag]
        same = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "p": ("p",)}[tag]
        for node in reversed(self.stack):
            if node["tag"] in stop:
                return
            if node["tag"] in same:
                self.handle_endtag(node["tag"])
                return

    def handle_endtag(self, tag):
        tag = tag.split(":")[-1]
        if tag not in [n["tag"] for n in self.stack]:
            return
        while True:
            node = self.stack.pop()
            self._done(node)
            if node["tag"] == tag:
                return

    def _done(self, node):
        text, tag = "".join(node["text"]), node["tag"]
        up = self.stack[-1] if self.stack else None
        inside = next((n for n in reversed(self.stack) if n["tag"] == "table"), None)
        if tag in ("script", "style"):
            return
        if tag in ("article-title", "title") and not self.title and inside is None:
            self.title = _line(text)
            return
        if tag == "label" and up is not None:
            up["label"] = _line(text)
            return
        if tag == "caption" and up is not None:
            up["caption"] = _line(text)
            return
        if tag in ("td", "th"):
            row = next((n for n in reversed(self.stack) if n["tag"] in ("tr", "table")), None)
            if row is not None:
                row["rows"].append(_line(text))
            return
        if tag == "tr":
            if inside is not None:
                self.tables[inside["at"]]["cells"].append(node["rows"])
            return
        if tag == "table":
            mine = self.tables[node["at"]]
            owner = next((n for n in [node, *reversed(self.stack)] if n["label"] is not None), None)
            mine["label"] = owner["label"] if owner else None
            mine["caption"] = next((n["caption"] for n in [node, *reversed(self.stack)] if n["caption"]), "") or ""
            return
        if tag == "p" and inside is None and not any(n["tag"] == "caption" for n in self.stack):
            self.paragraphs.append(text)
            return
        if up is not None:
            up["text"].append(text if tag not in ("div", "sec", "section", "body", "article", "html", "head") else "")

    def handle_data(self, data):
        if self.stack:
            self.stack[-1]["text"].append(data)


def read_markup(content: bytes) -> dict:
    """xml, nxml and html; a table whose surroundings have no label gets an empty caption."""
    p = _Markup()
    p.feed(content.decode("utf-8", "replace"))
    p.close()
    while p.stack:
        p.handle_endtag(p.stack[-1]["tag"])
    return {"body": _body([p.title, *p.paragraphs]), "tables": [t for t in p.tables if t["cells"]]}


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def read_docx(content: bytes) -> dict:
    """Paragraphs outside tables, and tables with one text per cell."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        root = ElementTree.fromstring(z.read("word/document.xml"))
    body = root.find(f"{_W}body")

    def text(e):
        return "".join(t.text or "" for t in e.iter(f"{_W}t"))

    paragraphs = [text(p) for p in body.findall(f"{_W}p")]
    tables = [{"label": None, "caption": "", "cells": [[_line(" ".join(text(p) for p in c.iter(f"{_W}p"))) for c in r.findall(f"{_W}tc")] for r in t.findall(f"{_W}tr")]} for t in body.findall(f"{_W}tbl")]
    return {"body": _body(paragraphs), "tables": tables}


def read_xlsx(content: bytes, numbers: bool = False) -> dict:
    """One table for each sheet, rows padded to the widest; cells that aren't text are blank unless ``numbers``."""
    tables = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared = [] if "xl/sharedStrings.xml" not in names else ["".join(t.text or "" for t in si.iter(f"{_S}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall(f"{_S}si")]
        for name in sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.findall(r"\d+", n)[-1])):
            rows: dict[int, dict[int, str]] = {}
            for c in ElementTree.fromstring(z.read(name)).iter(f"{_S}c"):
                ref = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r", ""))
                if not ref:
                    continue
                col = 0
                for ch in ref[1]:
                    col = col * 26 + ord(ch) - 64
                kind, v = c.get("t", "n"), c.find(f"{_S}v")
                if kind == "s":
                    value = shared[int(v.text)]
                elif kind == "inlineStr":
                    value = "".join(t.text or "" for t in c.iter(f"{_S}t"))
                elif kind == "str":
                    value = v.text or "" if v is not None else ""
                else:
                    value = (v.text or "") if numbers and v is not None else ""
                rows.setdefault(int(ref[2]) - 1, {})[col - 1] = _line(value)
            if rows:
                width = max(max(r, default=-1) for r in rows.values()) + 1
                tables.append({"label": None, "caption": "", "cells": [[rows.get(i, {}).get(j, "") for j in range(width)] for i in range(max(rows) + 1)]})
    return {"body": "", "tables": tables}


def read_csv(content: bytes) -> dict:
    rows = list(csv.reader(io.StringIO(content.decode("utf-8", "replace"))))
    width = max(map(len, rows), default=0)
    return {"body": "", "tables": [{"label": None, "caption": "", "cells": [r + [""] * (width - len(r)) for r in rows]}] if rows else []}


def read_txt(content: bytes) -> dict:
    return {"body": content.decode("utf-8", "replace"), "tables": []}


#: Readers by kind; a converter for old binary formats or pages can be added here.
READERS: dict[str, Callable[[bytes], dict]] = {"markup": read_markup, "docx": read_docx, "xlsx": read_xlsx, "csv": read_csv, "txt": read_txt}
_EXT = {"xml": "markup", "nxml": "markup", "html": "markup", "htm": "markup", "xhtml": "markup", "docx": "docx", "xlsx": "xlsx", "csv": "csv", "txt": "txt", "zip": "zip"}


#: Seconds that a reader may take for one file.
READ_SECONDS = 180


class OutOfTime(BaseException):
    """A reader took too long; not an Exception, so that no reader catches it by chance."""


@contextmanager
def time_limit(seconds: float) -> Iterator[None]:
    """Raises OutOfTime in the block after so many seconds, by a timer signal of this process; without effect outside the main thread, where there are no signals."""

    def stop(*_):
        raise OutOfTime

    try:
        before = signal.signal(signal.SIGALRM, stop)
    except ValueError:
        yield
        return
    signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        signal.setitimer(signal.ITIMER_REAL, 0)
        signal.signal(signal.SIGALRM, before)


def members(name: str, content: bytes, depth: int = ZIP_DEPTH) -> Iterator[tuple[str, bytes, str | None]]:
    """Files of an archive, nested ones too: their path in it, bytes, and what went wrong.

    An encrypted or damaged member, or an archive that can't be opened, is told and costs no other member.
    """
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
    except Exception as e:  # an archive that is none
        yield name, b"", f"failed: {type(e).__name__}"
        return
    with z:
        for m in sorted(set(z.namelist())):
            if m.endswith("/"):
                continue
            try:
                body = z.read(m)
            except Exception as e:  # encrypted, an unknown method, a wrong checksum
                yield f"{name}/{m}", b"", f"failed: {type(e).__name__}"
                continue
            if m.lower().endswith(".zip") and depth:
                yield from members(f"{name}/{m}", body, depth - 1)
            else:
                yield f"{name}/{m}", body, None


def parse(found: DataFrame, readers: dict[str, Callable[[bytes], dict]] | None = None, seconds: float = READ_SECONDS) -> DataFrame:
    """paper_id, file_idx, filename, status, body, tables of files; members of archives are files of their own.

    A file that no reader takes, that can't be read or that takes more than ``seconds`` (status ``timeout``) keeps its row with an empty body and
    its status; the numbers of files count them. Bodies are cut at ``MOST_BODY`` characters. A file without contents (null) has no kind.
    """
    limit_batches(found.sparkSession)
    readers = READERS | (readers or {})

    def one(kind, content):
        if kind not in readers:
            return {"status": "unsupported", "body": "", "tables": []}
        try:
            with time_limit(seconds):
                got = readers[kind](content)
            return {"status": "ok", "body": got["body"][:MOST_BODY], "tables": got["tables"]}
        except OutOfTime:
            return {"status": "timeout", "body": "", "tables": []}
        except Exception as e:  # a broken file must not lose the paper
            return {"status": f"failed: {type(e).__name__}", "body": "", "tables": []}

    def files(name, kind, content):
        """(name, row) of a file, or of each member of an archive."""
        if kind != "zip":
            yield name, one(kind, content)
            return
        for n, body, wrong in members(name, content):
            yield n, {"status": wrong, "body": "", "tables": []} if wrong else one(_EXT.get(n.rpartition(".")[2].lower()), body)

    def run(it):
        for g in it:
            out = []
            for paper, idx, name, kind, content in zip(g["paper_id"], g["file_idx"], g["filename"], g["kind"], g["content"], strict=True):
                out += [{"paper_id": paper, "file_idx": idx, "filename": n, **row} for n, row in files(name, kind, content or b"")]
            yield pd.DataFrame(out, columns=["paper_id", "file_idx", "filename", "status", "body", "tables"])

    base = found.select("paper_id", "file_idx", "filename", kind_of(F.col("filename"), F.col("content")).alias("kind"), "content")
    got = base.mapInPandas(run, f"paper_id string, file_idx int, filename string, {PARSED}")
    return got.withColumn("file_idx", F.row_number().over(Window.partitionBy("paper_id").orderBy("file_idx", "filename")) - 1)


def cells(parsed: DataFrame) -> DataFrame:
    """One row for each table cell: paper_id, file_idx, table_idx, row, col, text."""
    t = parsed.select("paper_id", "file_idx", F.posexplode("tables").alias("table_idx", "t"))
    r = t.select("paper_id", "file_idx", "table_idx", F.posexplode("t.cells").alias("row", "cs"))
    return r.select("paper_id", "file_idx", "table_idx", "row", F.posexplode("cs").alias("col", "text"))
