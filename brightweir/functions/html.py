"""HTML pages: visible text and metadata.

The JVM has no HTML parser, so pages go through one Arrow-batched function.
One pass over the tags of a page serves both the text and the metadata.
"""

from __future__ import annotations

import json
import re
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from brightweir import fixed_values as fixed
from brightweir.functions.text import squeeze

PAGE_SCHEMA = StructType(
    [
        StructField("text", StringType()),
        StructField("title", StringType()),
        StructField("description", StringType()),
        StructField("og_title", StringType()),
        StructField("og_description", StringType()),
        StructField("og_published_time", StringType()),
        StructField("time_tag", StringType()),
        StructField("json_ld", ArrayType(StringType())),
    ]
)

_VOID = frozenset(fixed.VOID_ELEMENTS)
_HIDDEN = frozenset(fixed.DROPPED_ELEMENTS + fixed.SILENT_ELEMENTS)
_NOISE = re.compile(fixed.NOISE_CLASS, re.IGNORECASE)
_SPACES = re.compile(r"\s+")


def _character(code: int) -> str:
    # Codes below 256 are read as Windows-1252 where it defines them.
    if code < 256:
        return bytes([code]).decode("windows-1252", errors="ignore") or chr(code)
    return chr(code) if code < 0x110000 else "\ufffd"


class _Open:
    """An element that is still open: its name, whether it hides text, its own text."""

    __slots__ = ("name", "hidden", "texts", "elements")

    def __init__(self, name: str, hidden: bool, keep_texts: bool):
        self.name = name
        self.hidden = hidden
        self.texts = [] if keep_texts else None
        self.elements = 0


class PageReader(HTMLParser):
    """Element stack without implied end tags.

    An end tag closes the nearest open element of its name and everything
    inside it; an end tag without one is ignored; void elements never stay open.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.stack: list[_Open] = []
        self.visible: list[str] = []
        self.meta: dict[str, str | None] = {}
        self.json_ld: list[str] = []
        self.first_time: _Open | None = None
        self.pending: list[str] = []

    def _flush(self) -> None:
        # Neighbouring pieces of character data form one text node.
        if not self.pending:
            return
        text = "".join(self.pending)
        self.pending = []
        for element in self.stack:
            if element.texts is not None:
                element.texts.append(text)
        if not (self.stack and self.stack[-1].hidden):
            self.visible.append(text)

    def handle_data(self, data: str) -> None:
        self.pending.append(data)

    def handle_entityref(self, name: str) -> None:
        # A name that stands for no character is literal text.
        self.pending.append(html5.get(name + ";", "&" + name))

    def handle_charref(self, name: str) -> None:
        self.pending.append(_character(int(name[1:], 16) if name[:1] in "xX" else int(name)))

    def handle_comment(self, data: str) -> None:
        self._flush()
        self._count_child()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def _count_child(self) -> None:
        if self.stack:
            self.stack[-1].elements += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._flush()
        self._count_child()
        values: dict[str, str] = {}
        for key, value in attrs:
            values[key] = value or ""
        if tag == "meta":
            self._read_meta(values)
        classes = values.get("class", "")
        noisy = bool(classes) and (
            any(_NOISE.search(part) for part in classes.split()) or bool(_NOISE.search(classes))
        )
        hidden = tag in _HIDDEN or noisy or bool(self.stack and self.stack[-1].hidden)
        if tag in _VOID:
            if tag == "time" and self.first_time is None:
                self.first_time = _Open(tag, hidden, True)
            return
        wanted = (
            (tag == "title" and "title" not in self.meta)
            or (tag == "time" and self.first_time is None)
            or (tag == "script" and values.get("type") == "application/ld+json")
        )
        element = _Open(tag, hidden, wanted)
        if wanted and tag == "title":
            self.meta["title"] = None
        if wanted and tag == "time":
            self.first_time = element
            if values.get("datetime"):
                self.meta["time_tag"] = values["datetime"].strip()
        self.stack.append(element)

    def handle_endtag(self, tag: str) -> None:
        self._flush()
        if not any(element.name == tag for element in self.stack):
            return
        while True:
            element = self.stack.pop()
            self._close(element)
            if element.name == tag:
                return

    def _close(self, element: _Open) -> None:
        if element.texts is None:
            return
        single = element.texts[0] if element.elements == 0 and len(element.texts) == 1 else None
        if element.name == "title":
            self.meta["title"] = single.strip() if single else None
        elif element.name == "script" and single:
            try:
                json.loads(single.strip())
            except ValueError:
                return
            self.json_ld.append(single.strip())

    def _read_meta(self, values: dict[str, str]) -> None:
        """An element fills one field, that of the first entry of ``META_FIELDS`` it is named by."""
        for attribute, name, field in fixed.META_FIELDS:
            given = (values.get(a, "").lower() for a in attribute)
            if name in given and values.get("content"):
                self.meta[field] = values["content"].strip()
                return

    def finish(self) -> None:
        self.close()
        self._flush()
        while self.stack:
            self._close(self.stack.pop())

    def text(self) -> str:
        parts = (part.strip() for part in self.visible)
        return _SPACES.sub(" ", " ".join(part for part in parts if part)).strip()

    def time_text(self) -> str | None:
        if "time_tag" in self.meta or self.first_time is None:
            return self.meta.get("time_tag")
        return "".join(part.strip() for part in self.first_time.texts)


def read_page(html: str | None, max_chars: int) -> dict:
    """Text and metadata of one page; unreadable pages fall back to stripped tags."""
    if not html:
        return {"text": "", "json_ld": []}
    reader = PageReader()
    try:
        reader.feed(html)
        reader.finish()
        text = reader.text()
    except Exception:
        text = _SPACES.sub(" ", re.sub(r"<[^>]+>", " ", html)).strip()
    page = {"text": text[:max_chars], "json_ld": reader.json_ld}
    for key in ("title", "description", "og_title", "og_description", "og_published_time"):
        page[key] = reader.meta.get(key)
    page["time_tag"] = reader.time_text()
    return page


def page_parts(html: Column, max_chars: int = fixed.MAX_PAGE_CHARS) -> Column:
    """Struct of visible text and metadata of a page."""

    @F.pandas_udf(PAGE_SCHEMA)
    def parts(pages: pd.Series) -> pd.DataFrame:
        rows = [read_page(page, max_chars) for page in pages]
        columns = {name: [row.get(name) for row in rows] for name in PAGE_SCHEMA.fieldNames()}
        # Plain objects, also where a batch has no value at all for a field.
        return pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in columns.items()})

    return parts(html)


def clean_html(html: Column, max_chars: int = fixed.MAX_PAGE_CHARS) -> Column:
    """Visible text of a page without noise, cut after parsing."""

    @F.pandas_udf(StringType())
    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([read_page(page, max_chars)["text"] for page in pages], dtype=object)

    return texts(html)


def strip_tags(html: Column, max_chars: int = fixed.MAX_PAGE_CHARS) -> Column:
    """Pattern-based cleaner for pages no parser accepts.  Stays in the JVM."""
    bare = squeeze(F.regexp_replace(F.coalesce(html, F.lit("")), r"<[^>]+>", " "))
    return F.substring(bare, 1, max_chars)


def json_ld_date(blocks: Column) -> Column:
    """``datePublished``, else ``uploadDate``, of the first top-level object that has one."""
    dates = F.transform(
        blocks,
        lambda b: F.coalesce(
            F.nullif(F.get_json_object(b, "$.datePublished"), F.lit("")),
            F.nullif(F.get_json_object(b, "$.uploadDate"), F.lit("")),
        ),
    )
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))
