"""Stored web pages to titles, headers, paragraphs, plain text and links.

HTML needs a parser, so this is the one place where Python code meets rows:
an Arrow-batched UDF that is given the HTML column alone.  The parser keeps
each page's text once, as a list of pieces; an element is a range of pieces.
Unclosed tags therefore cost nothing, however deep they nest.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser
from itertools import islice

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidencepanel.functions.text import net_location
from evidencepanel.operators.groups import need

# Element groups and elements without content.
HEADER_TAGS = frozenset(("h1", "h2", "h3"))
PARAGRAPH_TAGS = frozenset(("p", "li"))
DROPPED_TAGS = frozenset(("script", "style", "noscript"))
HIDDEN_TEXT_TAGS = frozenset(("template", "rt", "rp"))
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)

PAGE_TYPE = (
    T.StructType()
    .add("title", T.StringType())
    .add("headers", T.ArrayType(T.StringType()))
    .add("paragraphs", T.ArrayType(T.StringType()))
    .add("markdown_like", T.StringType())
    .add("plain_text", T.StringType())
    .add("word_count", T.IntegerType())
    .add("links", T.ArrayType(T.StringType()))
    .add("status", T.StringType())
    .add("error", T.StringType())
)
# A worker hands its pages on when their HTML comes to this many characters.
HELD_CHARS = 1 << 20
# The parser travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])



class PageReader(HTMLParser):
    """Collects text pieces and the ranges of the elements of interest."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.ranges: list[list[int]] = []  # header / paragraph: [start, end], end -1 while open
        self.headers: list[int] = []
        self.paragraphs: list[int] = []
        self.links: list[str] = []
        self.open: list[tuple[str, int]] = []
        self.counts: dict[str, int] = {}
        self.hidden = 0
        self.dropped = 0
        self.run: list[str] = []
        self.title_runs: list[str] | None = None
        self.in_title = False
        self.title_children = 0

    def flush(self) -> None:
        if not self.run:
            return
        text = "".join(self.run)
        self.run = []
        if self.in_title and self.title_runs is not None:
            self.title_runs.append(text)
        if self.dropped or self.hidden:
            return
        self.add(text)

    def add(self, text: str) -> None:
        # Collapsed once here, so elements that share a piece need not do it again.
        text = " ".join(text.split())
        if text:
            self.pieces.append(text)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.flush()
        if self.in_title:
            self.title_children += 1
        if tag == "a" and not self.dropped:
            href = dict(attrs).get("href")
            if href and href.strip():
                self.links.append(href.strip())
        mark = -1
        if not self.dropped and (tag in HEADER_TAGS or tag in PARAGRAPH_TAGS):
            mark = len(self.ranges)
            self.ranges.append([len(self.pieces), -1])
            (self.headers if tag in HEADER_TAGS else self.paragraphs).append(mark)
        if tag == "title" and self.title_runs is None and not self.dropped:
            self.title_runs, self.in_title = [], True
        if tag in VOID_TAGS:
            return
        self.open.append((tag, mark))
        self.counts[tag] = self.counts.get(tag, 0) + 1
        self.dropped += tag in DROPPED_TAGS
        self.hidden += tag in HIDDEN_TEXT_TAGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.flush()
        if not self.counts.get(tag):
            return
        while self.open:  # an end tag closes everything opened since its start tag
            name, mark = self.open.pop()
            self.counts[name] -= 1
            self.dropped -= name in DROPPED_TAGS
            self.hidden -= name in HIDDEN_TEXT_TAGS
            if mark >= 0:
                self.ranges[mark][1] = len(self.pieces)
            if name == "title":
                self.in_title = False
            if name == tag:
                return

    def handle_data(self, data: str) -> None:
        self.run.append(data)

    def handle_comment(self, data: str) -> None:
        self.flush()
        if self.in_title:
            self.title_children += 1

    def handle_decl(self, decl: str) -> None:
        self.flush()

    def handle_pi(self, data: str) -> None:
        self.flush()

    def unknown_decl(self, data: str) -> None:
        self.flush()
        if data.upper().startswith("CDATA[") and not (self.dropped or self.hidden):
            self.add(data[len("CDATA[") :])

    def text_of(self, mark: int) -> str:
        start, end = self.ranges[mark]
        return " ".join(self.pieces[start : end if end >= 0 else len(self.pieces)])

    def title(self) -> str:
        runs = self.title_runs or []
        return runs[0].strip() if len(runs) == 1 and not self.title_children else ""


@dataclass(frozen=True)
class PageLimits:
    """How much of a page is kept; nothing is cut unless a number is given."""

    headers: int | None = None
    headers_in_text: int | None = None
    paragraphs: int | None = None
    paragraph_chars: int = 1  # paragraphs with less text are left out
    error_chars: int | None = None


EVERYTHING = PageLimits()
# The limits of a short archive.
SHORT_ARCHIVE = PageLimits(headers=40, headers_in_text=20, paragraphs=300, paragraph_chars=8, error_chars=220)


def read_page(html: str | None, limits: PageLimits = EVERYTHING) -> tuple:
    """One page as a tuple in ``PAGE_TYPE`` order; a bad page keeps its row."""
    try:
        if html is None:
            raise ValueError("no html")
        reader = PageReader()
        reader.feed(html)
        reader.close()
        reader.flush()
        headers = list(islice((t for t in map(reader.text_of, reader.headers) if t), limits.headers))
        long = (t for t in map(reader.text_of, reader.paragraphs) if len(t) >= limits.paragraph_chars)
        paragraphs = list(islice(long, limits.paragraphs))
        title = reader.title()
        lines = [f"# {title}"] if title else []
        lines += [f"## {h}" for h in headers[: limits.headers_in_text]] + paragraphs
        plain = " ".join(reader.pieces)
        text = "\n\n".join(lines).strip()
        return title, headers, paragraphs, text, plain, len(plain.split()), reader.links, "ok", ""
    except Exception as exc:  # a page that cannot be read is a result, not a failure
        return "", [], [], "", "", 0, [], "error", str(exc)[: limits.error_chars]


def _page_udf(limits: PageLimits, members: Sequence[str]):
    """The parser as an Arrow UDF that returns the wanted members, lists as their sizes.

    Parsed pages leave a worker by the size of their HTML, not by Arrow batches, which hold
    thousands of pages: their texts are several times the HTML.
    """
    kind = T.StructType()
    for name in members:
        kind = kind.add(name, T.IntegerType()) if name in COUNTED else kind.add(PAGE_TYPE[name])

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for html in batches:
            out, held = [], 0
            for h in html:
                text = None if pd.isna(h) else h
                page = dict(zip(PAGE_TYPE.names, read_page(text, limits), strict=True))
                out.append([len(page[COUNTED[m]]) if m in COUNTED else page[m] for m in members])
                held += len(text or "")
                if held >= HELD_CHARS:
                    yield pd.DataFrame(out, columns=list(members))
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=list(members))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, kind)


COUNTED = {"headers_count": "headers", "links_count": "links"}


def page_archive(pages: DataFrame, html: str = "html", limits: PageLimits = EVERYTHING) -> DataFrame:
    """Adds the parsed parts of every page; rows are kept on failure."""
    need(pages, html)
    kept = [c for c in pages.columns if c != html]
    read = _page_udf(limits, PAGE_TYPE.names)
    return pages.select(*kept, read(F.col(html)).alias("_p")).select(*kept, "_p.*")


def page_summary(pages: DataFrame, url: str = "url", html: str = "html", limits: PageLimits = EVERYTHING) -> DataFrame:
    """Address, host with port, status, title and counts per page.

    Only these leave the parser, not the texts they are counted on.
    """
    need(pages, url, html)
    read = _page_udf(limits, ["status", "title", "word_count", "headers_count", "links_count", "error"])
    rows = pages.select(url, read(F.col(html)).alias("_p"))
    return rows.select(url, net_location(url).alias("host"), "_p.*")


def archive_document(archive: DataFrame, url: str = "url") -> DataFrame:
    """The archived form of a page: title, text, headers and links, as many as the archive has."""
    return archive.where("status = 'ok'").select(url, "title", "markdown_like", "headers", "links")
