"""Files into documents and blocks: format detection, ids from content, Markdown, text, DOCX, and layout of PDF words.

Files are read as binary rows; each is parsed where it lies.  PDF text extraction is a plug-in (``words`` and ``tables``
tables), the layout on top of it is here.

Defined results: unknown formats are read as text; undecodable bytes are replaced; a broken DOCX gives no blocks.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections import Counter
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specweave.session import ship
from specweave.sources.markdown import BLOCK_SCHEMA, blocks_of_text, render_table

#: Format by file ending; by first bytes.
ENDINGS = {"pdf": "pdf", "docx": "docx", "txt": "txt", "md": "md", "markdown": "md"}
_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: PDF layout: words of a line differ by so many points at most; a heading is so much larger than the body;
#: lines of a paragraph are no further apart than so many text sizes.
LINE_TOLERANCE, HEADING_RATIO, PARAGRAPH_GAP = 2.0, 1.15, 1.6


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """document_id (hash of the bytes), file_name, format, content of every file under ``path``."""
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    by_name = F.try_element_at(F.create_map(*[F.lit(x) for kv in ENDINGS.items() for x in kv]), ending)
    magic = F.when(F.substring("content", 1, 4) == F.lit(b"%PDF"), "pdf").when(F.substring("content", 1, 4) == F.lit(b"PK\x03\x04"), "docx").otherwise("txt")
    return files.select(F.concat(F.lit("doc-"), F.substring(F.sha2("content", 256), 1, 16)).alias("document_id"), F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"), F.coalesce(by_name, magic).alias("format"), "content")


def _docx_text(node: ElementTree.Element) -> str:
    return re.sub(r"\s+", " ", "".join(t.text or "" for t in node.iter(f"{_W}t"))).strip()


def docx_blocks(content: bytes) -> list[tuple[str, str, int | None, dict | None]]:
    """(kind, text, heading level, table) of the body of a DOCX file, in order."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return []
    out: list[tuple[str, str, int | None, dict | None]] = []
    for node in body if body is not None else ():
        if node.tag == f"{_W}p" and (text := _docx_text(node)):
            mark = node.find(f"{_W}pPr/{_W}pStyle")
            style = (mark.get(f"{_W}val") or "").lower().replace(" ", "") if mark is not None else ""
            heading = re.fullmatch(r"heading(\d+)", style)
            if style == "title" or heading:
                out.append(("heading", text, int(heading.group(1)) if heading else 0, None))
            else:
                out.append(("list_item" if style.startswith("list") else "paragraph", text, None, None))
        elif node.tag == f"{_W}tbl":
            rows = [[_docx_text(c) for c in row.findall(f"{_W}tc")] for row in node.findall(f"{_W}tr")]
            if rows:
                out.append(("table", render_table(rows[0], rows[1:]), None, {"caption": None, "header": rows[0], "rows": rows[1:], "subject_hint": None}))
    return out


def unread(files: DataFrame) -> DataFrame:
    """document_id, file_name, why of the files that give no blocks: their words must be extracted elsewhere (``layout_blocks``)."""
    return files.filter("format = 'pdf'").select("document_id", "file_name", F.lit("no word extraction for PDF").alias("why"))


def docx_properties(content: bytes) -> tuple[str | None, str | None]:
    """Title and author of a DOCX file's core properties."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            root = ElementTree.fromstring(archive.read("docProps/core.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None, None
    said = {node.tag.rsplit("}", 1)[-1]: (node.text or "").strip() or None for node in root}
    return said.get("title"), said.get("creator")


def properties_of_files(files: DataFrame) -> DataFrame:
    """document_id, title, author that DOCX files state about themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            said = [docx_properties(c) for c in pdf["content"]]
            yield pd.DataFrame({"document_id": pdf["document_id"], "title": [t for t, _ in said], "author": [a for _, a in said]})

    return files.filter("format = 'docx'").select("document_id", "content").mapInPandas(run, "document_id string, title string, author string")


def blocks_of_files(files: DataFrame) -> DataFrame:
    """Blocks of text, Markdown and DOCX files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, kind, content in zip(pdf["document_id"], pdf["format"], pdf["content"]):
                found = docx_blocks(content) if kind == "docx" else blocks_of_text(content.decode("utf-8", "replace"))
                rows += [(doc, i, f"blk-{doc}-p0001-{i:04d}", 1, *block) for i, block in enumerate(found)]
            frame = pd.DataFrame(rows, columns=["document_id", "ord", "block_id", "page", "kind", "text", "heading_level", "tbl"])
            yield frame.assign(heading_level=frame["heading_level"].astype("Int32"))

    return files.filter("format <> 'pdf'").select("document_id", "format", "content").mapInPandas(run, BLOCK_SCHEMA)


def lines_of_page(words: pd.DataFrame, boxes: list[tuple[float, float, float, float]]) -> list[tuple[float, float, str]]:
    """(top, size, text) of the lines of one page; words inside table boxes are left out."""
    lines: list[list] = []
    for w in words.sort_values(["top", "x0"], kind="stable").itertuples():
        middle = ((w.x0 + w.x1) / 2, (w.top + w.bottom) / 2)
        if any(x0 <= middle[0] <= x1 and top <= middle[1] <= bottom for x0, top, x1, bottom in boxes):
            continue
        if lines and abs(lines[-1][0] - w.top) <= LINE_TOLERANCE:
            lines[-1][1].append(w)
        else:
            lines.append([w.top, [w]])
    return [(top, Counter(round(w.size, 1) for w in ws).most_common(1)[0][0], " ".join(w.text for w in sorted(ws, key=lambda w: w.x0))) for top, ws in lines]


def layout_blocks(words: DataFrame, tables: DataFrame) -> DataFrame:
    """Blocks from PDF words (document_id, page, text, x0, x1, top, bottom, size) and tables (document_id, page, x0, top,
    x1, bottom, rows).  A page is laid out by itself; heading sizes are ranked over the document."""
    body = words.groupBy("document_id", F.round("size", 1).alias("s")).agg(F.count(F.lit(1)).alias("n")).groupBy("document_id").agg(F.max_by("s", F.struct("n", -F.col("s"))).alias("body"), F.array_sort(F.collect_set("s")).alias("sizes"))
    w = words.groupBy("document_id", "page").agg(F.collect_list(F.struct("text", "x0", "x1", "top", "bottom", "size")).alias("words"))
    t = tables.groupBy("document_id", "page").agg(F.collect_list(F.struct("x0", "top", "x1", "bottom", "rows")).alias("tables"))
    pages = w.join(t, ["document_id", "page"], "full").join(body, "document_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for r in pdf.itertuples():
                tabs = list(r.tables) if r.tables is not None else []
                frame = pd.DataFrame(list(r.words) if r.words is not None else [], columns=["text", "x0", "x1", "top", "bottom", "size"])
                sizes = sorted((s for s in (r.sizes if r.sizes is not None else []) if s >= HEADING_RATIO * r.body), reverse=True)
                items: list[tuple] = [(b["top"], "table", render_table([*b["rows"][0]], [[*x] for x in b["rows"][1:]]), None, {"caption": None, "header": [*b["rows"][0]], "rows": [[*x] for x in b["rows"][1:]], "subject_hint": None}) for b in tabs if len(b["rows"])]
                run_end, run_size = None, None
                for top, size, text in lines_of_page(frame, [(b["x0"], b["top"], b["x1"], b["bottom"]) for b in tabs]):
                    if size in sizes:
                        items.append((top, "heading", text, sizes.index(size) + 1, None))
                        run_end = None
                    elif run_end is not None and size == run_size and top - run_end <= PARAGRAPH_GAP * size:
                        first = items.pop()
                        items.append((first[0], "paragraph", f"{first[2]}\n{text}", None, None))
                        run_end = top
                    else:
                        items.append((top, "paragraph", text, None, None))
                        run_end, run_size = top, size
                for i, (_, kind, text, level, tbl) in enumerate(sorted(items, key=lambda x: x[0])):
                    plain = re.sub(r"(\w)-\n(\w)", r"\1\2", text) if kind == "paragraph" else text
                    out.append((r.document_id, r.page * 100_000 + i, f"blk-{r.document_id}-p{r.page:04d}-{i:04d}", r.page, kind, plain.replace("\n", " ") if kind == "paragraph" else plain, level, tbl))
            frame = pd.DataFrame(out, columns=["document_id", "ord", "block_id", "page", "kind", "text", "heading_level", "tbl"])
            yield frame.assign(heading_level=frame["heading_level"].astype("Int32"))

    return pages.mapInPandas(run, BLOCK_SCHEMA)
