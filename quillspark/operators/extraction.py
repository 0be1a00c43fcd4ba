"""Bytes to text: one extractor for each content type, run in batches; others can be registered.

A row that can't be extracted has a null text and an error, it never fails its stage.
"""

from __future__ import annotations

import csv
import io
import json
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.functions.batched import batched
from quillspark.operators.html import extracted

_PARAGRAPH = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"

METADATA = (
    "struct<title:string,language:string,author:string,description:string,keywords:string,canonical_url:string,site_name:string,published_time:string,modified_time:string,section:string,"
    "article_tag:string,open_graph:map<string,string>,twitter_card:map<string,string>,schema_org:struct<type:string,headline:string,author:string,datePublished:string,dateModified:string,publisher:string>>"
)
_FIELDS = ["title", "language", "author", "description", "keywords", "canonical_url", "site_name", "published_time", "modified_time", "section", "article_tag", "open_graph", "twitter_card", "schema_org"]


def plain_text(content: bytes) -> str:
    """UTF-8; invalid bytes are left out."""
    return content.decode("utf-8", "ignore")


def json_text(content: bytes) -> str:
    """Indented JSON, or the text as it is if it isn't JSON."""
    text = plain_text(content)
    try:
        return json.dumps(json.loads(text), indent=2, ensure_ascii=False)
    except ValueError:
        return text


def aligned(rows: list[list[str]]) -> str:
    """Columns to the right, two spaces apart."""
    width = max(map(len, rows), default=0)
    full = [r + [""] * (width - len(r)) for r in rows]
    sizes = [max(len(r[i]) for r in full) for i in range(width)]
    return "\n".join("  ".join(c.rjust(n) for c, n in zip(r, sizes)) for r in full)


def csv_text(content: bytes) -> str:
    text = plain_text(content)
    try:
        rows = list(csv.reader(io.StringIO(text), strict=True))
        return aligned(rows) if rows else text
    except csv.Error:
        return text


def docx_text(content: bytes) -> str:
    """Paragraphs that aren't blank, then table rows with their cells between bars."""
    body = ElementTree.fromstring(zipfile.ZipFile(io.BytesIO(content)).read("word/document.xml")).find(f"{_PARAGRAPH}body")
    said = lambda node: "".join(t.text or "" for t in node.iter(f"{_PARAGRAPH}t"))
    paragraphs = [said(p) for p in body.findall(f"{_PARAGRAPH}p") if said(p).strip()]
    rows = [" | ".join("\n".join(said(p) for p in c.findall(f"{_PARAGRAPH}p")) for c in r.findall(f"{_PARAGRAPH}tc")) for r in body.iter(f"{_PARAGRAPH}tr")]
    return "\n\n".join([*paragraphs, *rows])


def _numbered(archive: zipfile.ZipFile, pattern: str) -> list[str]:
    found = [(int(m.group(1)), n) for n in archive.namelist() if (m := re.fullmatch(pattern, n))]
    return [n for _, n in sorted(found)]


def pptx_text(content: bytes) -> str:
    """Shapes line by line, slides with a rule between them."""
    archive = zipfile.ZipFile(io.BytesIO(content))
    slides = []
    for name in _numbered(archive, r"ppt/slides/slide(\d+)\.xml"):
        bodies = ElementTree.fromstring(archive.read(name)).iter("{http://schemas.openxmlformats.org/presentationml/2006/main}txBody")
        shapes = ["\n".join("".join(t.text or "" for t in p.iter(f"{_DRAWING}t")) for p in b.iter(f"{_DRAWING}p")) for b in bodies]
        if any(s.strip() for s in shapes):
            slides.append("\n".join(s for s in shapes if s.strip()))
    return "\n\n---\n\n".join(slides)


def xlsx_text(content: bytes) -> str:
    """Every sheet under its name."""
    archive = zipfile.ZipFile(io.BytesIO(content))
    shared = []
    if "xl/sharedStrings.xml" in archive.namelist():
        shared = ["".join(t.text or "" for t in s.iter(f"{_SHEET}t")) for s in ElementTree.fromstring(archive.read("xl/sharedStrings.xml"))]
    names = [s.get("name") for s in ElementTree.fromstring(archive.read("xl/workbook.xml")).iter(f"{_SHEET}sheet")]
    out = []
    for name, part in zip(names, _numbered(archive, r"xl/worksheets/sheet(\d+)\.xml")):
        rows = []
        for row in ElementTree.fromstring(archive.read(part)).iter(f"{_SHEET}row"):
            cells: list[str] = []
            for c in row.findall(f"{_SHEET}c"):
                letters = re.match(r"[A-Z]+", c.get("r", "")) or re.match("A", "A")
                at = 0
                for x in letters.group():
                    at = at * 26 + ord(x) - 64
                value = c.find(f"{_SHEET}v")
                said = "".join(t.text or "" for t in c.iter(f"{_SHEET}t")) if value is None else value.text or ""
                cells += [""] * (at - 1 - len(cells))
                cells.append(shared[int(said)] if c.get("t") == "s" else said)
            rows.append(cells)
        out.append(f"## Sheet: {name}\n{aligned(rows)}")
    return "\n\n".join(out)


def html_text(content: bytes) -> str:
    return extracted(plain_text(content))["text"]


EXTRACTORS: dict[str, Callable[[bytes], str | None]] = {
    "extract_html": html_text, "extract_docx": docx_text, "extract_doc": docx_text, "extract_pptx": pptx_text, "extract_ppt": pptx_text, "extract_xlsx": xlsx_text, "extract_xls": xlsx_text,
    "extract_text": plain_text, "extract_markdown": plain_text, "extract_fallback": plain_text, "extract_json": json_text, "extract_csv": csv_text, "skip_image": lambda content: None,
}


def register_extractor(method: str, extract: Callable[[bytes], str | None]) -> None:
    """Adds or replaces an extractor; formats that need libraries (pdf, image text) come in this way."""
    EXTRACTORS[method] = extract


def with_text(files: DataFrame, content: str = "content", method: str = "method") -> DataFrame:
    """``files`` with ``text`` and ``error``; content that is null has neither."""
    known = dict(EXTRACTORS)

    @F.pandas_udf("struct<text:string,error:string>")
    def extract(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for contents, methods in parts:
            out = []
            for data, name in zip(contents, methods):
                try:
                    out.append((known[name](bytes(data)) if data is not None else None, None))
                except KeyError:
                    out.append((None, f"no extractor {name}"))
                except Exception as e:  # noqa: BLE001 - files may be broken in any way
                    out.append((None, f"{type(e).__name__}: {e}"[:100]))
            yield pd.DataFrame(out, columns=["text", "error"])

    made = files.withColumn("_x", extract(F.col(content), F.col(method)))
    return made.withColumn("text", F.col("_x.text")).withColumn("error", F.col("_x.error")).drop("_x")


@batched(f"struct<text:string,metadata:{METADATA}>")
def page(html: pd.Series) -> pd.DataFrame:
    """Text and metadata of pages, as one struct."""
    rows = [extracted(h) for h in html]
    return pd.DataFrame({"text": [r["text"] for r in rows], "metadata": [{k: r["metadata"].get(k) for k in _FIELDS} for r in rows]})
