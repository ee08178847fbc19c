"""Text and tables of HTML fragments, by Arrow batches over a tolerant event parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header phrases of two-column tables.
LEFT_HEADER = "1. dit is verzekerd"
RIGHT_HEADER = "2. dit is niet verzekerd"
HEADER_PHRASES = ("dit is verzekerd", "dit is niet verzekerd")

_VOID = {"br", "hr", "img", "input", "link", "meta", "wbr"}
_CELL = T.StructType([T.StructField("tag", T.StringType()), T.StructField("text", T.StringType()), T.StructField("colspan", T.IntegerType()), T.StructField("rowspan", T.IntegerType())])
TABLE = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("headers", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("pairs", T.ArrayType(T.StructType([T.StructField("row_idx", T.IntegerType()), T.StructField("insured", T.StringType()), T.StructField("not_insured", T.StringType())]))),
        T.StructField("rows", T.ArrayType(T.StructType([T.StructField("row_idx", T.IntegerType()), T.StructField("cells", T.ArrayType(_CELL))]))),
    ]
)
_ARROW_CELL = pa.struct([("tag", pa.string()), ("text", pa.string()), ("colspan", pa.int32()), ("rowspan", pa.int32())])
_ARROW = pa.struct(
    [
        ("kind", pa.string()),
        ("headers", pa.list_(pa.list_(pa.string()))),
        ("pairs", pa.list_(pa.struct([("row_idx", pa.int32()), ("insured", pa.string()), ("not_insured", pa.string())]))),
        ("rows", pa.list_(pa.struct([("row_idx", pa.int32()), ("cells", pa.list_(_ARROW_CELL))]))),
    ]
)
# Markup that can be read in one way only; what isn't all of this kind is left to the event parser.
_TAGS = "table|thead|tbody|tfoot|tr|td|th|caption|p|div|span|ul|ol|li|b|i|strong|em|h[1-6]"
_ATTRIBUTE = r' ([a-z]+)="([^"<>&]*)"'
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_PLAIN = re.compile(rf"([^<&]+)|</({_TAGS})>|<({_TAGS})((?:{_ATTRIBUTE})*)>")


def squeeze(text: str) -> str:
    return " ".join(text.replace("\u00ad", "").split())


def _span(value: str | None) -> int:
    """A span that is no number counts as 1."""
    return int(value) if value and value.isdecimal() else 1


class _Events(HTMLParser):
    """Collects the pieces of text, and the cells of the first table's rows."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.rows: list[list[dict]] = []
        self.seen = 0  # tables opened
        self.depth = 0  # tables open
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.seen, self.depth = self.seen + 1, self.depth + 1
        elif self.depth == 1 and self.seen >= 1 and tag == "tr":
            self.close_cell()
            self.rows.append([])
        elif self.depth == 1 and tag in ("td", "th"):
            self.close_cell()
            if not self.rows:
                self.rows.append([])
            at = dict(attrs)
            self.cell = []
            self.rows[-1].append({"tag": tag, "text": "", "colspan": _span(at.get("colspan")), "rowspan": _span(at.get("rowspan"))})

    def handle_endtag(self, tag):
        if self.depth == 1 and tag in ("td", "th", "tr", "table"):
            self.close_cell()
        if tag == "table" and self.depth:
            self.depth -= 1
            if not self.depth:
                self.depth = -1 << 20  # only the first table counts

    def handle_data(self, data):
        self.pieces.append(data)
        if self.cell is not None:
            self.cell.append(data)

    def plain(self, html: str) -> bool:
        """Feeds all of a text of plain markup; of another text nothing."""
        found = list(_PLAIN.finditer(html))
        if sum(m.end() - m.start() for m in found) < len(html):
            return False
        for m in found:
            if m.group(1):
                self.handle_data(m.group(1))
            elif m.group(2):
                self.handle_endtag(m.group(2))
            else:
                self.handle_starttag(m.group(3), _ATTRIBUTES.findall(m.group(4)) if m.group(4) else ())
        return True

    def close_cell(self):
        if self.cell is not None:
            self.rows[-1][-1]["text"] = squeeze(" ".join(x.strip() for x in self.cell if x.strip()))
            self.cell = None


def _parsed(html: str | None) -> _Events:
    events = _Events()
    if not events.plain(html or ""):
        events.feed(html or "")
        events.close()
    events.close_cell()
    return events


def text_of(html: str | None) -> str:
    """Pieces of text by single spaces; null is empty."""
    return squeeze(" ".join(_parsed(html).pieces))


def table_of(html: str | None) -> dict | None:
    """Kind, headers and rows of the first table; null if it has no cells.

    Paired: both header phrases; the last row with a phrase gives the headers. Matrix: a span
    over 1 or three rows at least. Other: the rest. Headers of the latter two: rows with th.
    """
    rows = [r for r in _parsed(squeeze(html or "")).rows if r]
    if not rows:
        return None
    texts = [c["text"].lower() for r in rows for c in r]
    if (LEFT_HEADER in texts and RIGHT_HEADER in texts) or any(f"{LEFT_HEADER} {RIGHT_HEADER}" in t for t in texts):
        is_head = [any(p in c["text"].lower() for c in r for p in HEADER_PHRASES) for r in rows]
        heads = [[c["text"] for c in r] for r, head in zip(rows, is_head, strict=True) if head]
        body = [[c["text"] for c in r] + [""] for r, head in zip(rows, is_head, strict=True) if not head]
        return {"kind": "table_paired_chunk", "headers": heads[-1:], "pairs": [{"row_idx": i, "insured": r[0], "not_insured": r[1]} for i, r in enumerate(body)], "rows": []}
    wide = len(rows) >= 3 or any(c["colspan"] > 1 or c["rowspan"] > 1 for r in rows for c in r)
    heads = [[c["text"] for c in r] for r in rows if any(c["tag"] == "th" for c in r)]
    return {"kind": "table_matrix_chunk" if wide else "table_other_chunk", "headers": heads, "pairs": [], "rows": [{"row_idx": i, "cells": r} for i, r in enumerate(rows)]}


@F.pandas_udf(T.StringType())
def html_text(html: pd.Series) -> pd.Series:
    return html.map(text_of)


@F.arrow_udf(TABLE)
def html_table(html: pa.Array) -> pa.Array:
    return pa.array(map(table_of, html.to_pylist()), _ARROW)
