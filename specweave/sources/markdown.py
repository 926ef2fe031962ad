"""Markdown and plain text into typed blocks.

A text is one row, so each is parsed where it lies and nothing is shuffled.  ``blocks_of_text`` is a small grammar over
classified lines: blank, heading (any number of ``#``), table row (``|``), list item, other.

Defined results: null, empty and blank texts give no blocks; rows that hold only dashes are no table rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_TYPE = "struct<caption:string,header:array<string>,rows:array<array<string>>,subject_hint:string>"
BLOCK_SCHEMA = f"document_id string, ord int, block_id string, page int, kind string, text string, heading_level int, tbl {TABLE_TYPE}"

_ITEM = re.compile(r"^(?:[-*]|\d+\.)\s+")


def _line_kind(line: str) -> str:
    bare = line.strip()
    if not bare:
        return "blank"
    if bare[0] == "#":
        return "heading"
    if bare[0] == "|":
        return "row"
    return "item" if _ITEM.match(bare + " " if bare in "-*" else bare) else "text"


def render_table(header: list[str], rows: list[list[str]]) -> str:
    """A table as lines of cells between bars, the header first."""
    return "\n".join("| " + " | ".join(r) + " |" for r in [header, *rows])


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def blocks_of_text(text: str | None) -> list[tuple[str, str, int | None, dict | None]]:
    """(kind, text, heading level, table) of each block."""
    out: list[tuple[str, str, int | None, dict | None]] = []
    for kind, run in groupby((text or "").splitlines(), key=_line_kind):
        lines = [line.strip() for line in run]
        if kind == "heading":
            for line in lines:
                bare = line.lstrip("#")
                out.append(("heading", bare.strip(), len(line) - len(bare), None))
        elif kind == "row":
            rows = [r for r in map(_cells, lines) if not all(re.fullmatch("-{2,}", c) for c in r)]
            if rows:
                out.append(("table", render_table(rows[0], rows[1:]), None, {"caption": None, "header": rows[0], "rows": rows[1:], "subject_hint": None}))
        elif kind == "item":
            out += [("list_item", _ITEM.sub("", line, count=1).strip(), None, None) for line in lines]
        elif kind == "text":
            out.append(("paragraph", re.sub(r"[ \t]+", " ", " ".join(lines)).strip(), None, None))
    return out


def parse_texts(texts: DataFrame) -> DataFrame:
    """Blocks of (document_id, text); all on page 1, numbered from 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (doc, i, f"blk-{doc}-p0001-{i:04d}", 1, kind, text, level, table)
                for doc, whole in zip(pdf["document_id"], pdf["text"])
                for i, (kind, text, level, table) in enumerate(blocks_of_text(whole))
            ]
            frame = pd.DataFrame(rows, columns=["document_id", "ord", "block_id", "page", "kind", "text", "heading_level", "tbl"])
            frame["heading_level"] = frame["heading_level"].astype("Int32")
            yield frame

    return texts.select("document_id", "text").filter(F.col("text").isNotNull()).mapInPandas(run, BLOCK_SCHEMA)
