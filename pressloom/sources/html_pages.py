"""Headlines of landed HTML pages.

Each page is parsed inside its task by a small helper over the standard HTML parser; Spark spreads the pages.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNREAD = frozenset(("script", "style", "template"))


class _Outline(HTMLParser):
    """Document order of headings, paragraphs and links, and the text runs between tags.

    An element ends at its own end tag or when an element around it ends, so an unclosed paragraph holds what follows.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.texts: list[str] = []
        self._run: list[str] = []
        self._open: list[tuple[str, dict | None]] = []
        self._depth: dict[str, int] = {}
        self._order = 0
        self.found: dict[str, list[dict]] = {"h": [], "p": [], "a": []}

    def _end_run(self) -> None:
        run = "".join(self._run).strip()
        self._run.clear()
        if run and not any(self._depth.get(t) for t in _UNREAD):
            self.texts.append(run)

    def _close_top(self) -> None:
        tag, node = self._open.pop()
        self._depth[tag] -= 1
        if node is not None:
            node["end"] = len(self.texts)

    def handle_starttag(self, tag, attrs):
        self._end_run()
        self._order += 1
        kind = "h" if tag in ("h1", "h2") else tag if tag in ("p", "a") else None
        node = None
        if kind:
            node = {"order": self._order, "start": len(self.texts), "end": None, "href": dict(attrs).get("href")}
            if kind == "h":
                around = next((n for t, n in reversed(self._open) if t == "a"), None)
                node["href"] = around["href"] if around else None
                node["linked"] = around is not None
            self.found[kind].append(node)
        if tag not in _VOID:
            self._open.append((tag, node))
            self._depth[tag] = self._depth.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._end_run()
            self._close_top()

    def handle_endtag(self, tag):
        self._end_run()
        if self._depth.get(tag):
            while self._open[-1][0] != tag:
                self._close_top()
            self._close_top()

    def handle_data(self, data):
        self._run.append(data)

    def handle_comment(self, data):
        self._end_run()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def text_of(self, node: dict | None) -> str:
        return "".join(self.texts[node["start"] : node["end"]]).strip() if node else ""

    def next_of(self, kind: str, node: dict | None) -> dict | None:
        if node is None:
            return None
        nodes = self.found[kind]
        i = bisect_right(nodes, node["order"], key=lambda n: n["order"])
        return nodes[i] if i < len(nodes) else None


def _headlines(base: str, html: str) -> Iterator[tuple[str, str, str, str]]:
    page = _Outline()
    page.feed(html)
    page.close()
    page._end_run()
    for heading in page.found["h"]:
        first = page.next_of("p", heading)
        second = page.next_of("p", first)
        link = heading if heading["linked"] else page.next_of("a", heading)
        href = link["href"] if link else None
        yield page.text_of(heading), page.text_of(first), _join(base, href), page.text_of(second)


def _join(base: str, href: str | None) -> str:
    try:
        return urljoin(base or "", href) if href else ""
    except ValueError:
        return ""


def extract_headlines(
    pages: DataFrame,
    base_url: Column | None = None,
    source: str = "c14",
    max_items: int | None = None,
    scraped_at: Column | None = None,
) -> DataFrame:
    """One row per h1/h2 of each page, in document order: heading, the next two paragraphs and the link.

    The second paragraph is kept as the `published` label.  `max_items` keeps the first headings of each page only;
    `scraped_at` is an expression over `page_id` and `url` for the moment of the fetch.
    """
    base = base_url if base_url is not None else F.col("url")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (page_id, pos, *headline)
                for page_id, base, html in zip(batch["page_id"], batch["base"], batch["html"])
                for pos, headline in enumerate(_headlines(base, html or ""))
            ]
            yield pd.DataFrame(rows, columns=["page_id", "pos", "title", "summary", "url", "published"])

    schema = "page_id long, pos int, title string, summary string, url string, published string"
    out = pages.select("page_id", base.alias("base"), "html").mapInPandas(run, schema)
    if max_items is not None:
        out = out.where(F.col("pos") < max_items)
    out = out.withColumns({"published_iso": F.lit(""), "source": F.lit(source)})
    return out if scraped_at is None else out.withColumn("scraped_at", scraped_at)
