"""HTML to line-structured text and to links, by Arrow batches over the standard parser."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements without content of interest, words that mark boilerplate wherever they stand in an
# id, class or role, marks of the main part, and elements that never have an end tag.
DROPPED = {"script", "style", "noscript", "svg", "header", "nav", "footer", "aside"}
MARKED = (
    "breadcrumb", "menu", "navbar", "navigation", "rodape", "footer", "sidebar", "social-share", "social-icons", "social-media", "rede-social", "redes-sociais", "share", "search", "acessibilidade",
)
MAIN_TAGS, MAIN_CLASSES, MAIN_IDS = {"main", "article"}, {"entry-content", "post-content", "page-content", "content-area"}, {"content", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
LEAST_MAIN, BODY = 80, 0


class _Reader(HTMLParser):
    """Text nodes with the stack of open elements; unclosed elements end with their parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, tuple[int, ...]]] = []
        self.lines: list[tuple[str, tuple[int, ...]]] = []
        self.mains, self.links, self.anchor = 0, [], None

    def handle_starttag(self, tag, attrs):
        given = {k: (v or "").lower() for k, v in attrs}
        if tag == "a" and "href" in given:
            self.anchor = [dict(attrs)["href"] or "", []]
            self.links.append(self.anchor)
        if tag in VOID:
            return
        marks = f"{given.get('id', '')} {given.get('class', '')} {given.get('role', '')}"
        gone = tag in DROPPED or any(m in marks for m in MARKED) or bool(self.open and self.open[-1][1])
        mains = self.open[-1][2] if self.open else ()
        if tag == "body" and not gone:
            mains = (*mains, BODY)
        if tag in MAIN_TAGS or given.get("role") == "main" or MAIN_CLASSES.intersection(given.get("class", "").split()) or given.get("id") in MAIN_IDS:
            self.mains += 1
            mains = (*mains, self.mains)
        self.open.append((tag, gone, mains))

    def handle_endtag(self, tag):
        if tag == "a":
            self.anchor = None
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        text = data.strip()
        if text and self.anchor is not None:
            self.anchor[1].append(text)
        if text and not (self.open and (self.open[-1][1] or self.open[-1][0] in ("script", "style"))):
            self.lines.append((text, self.open[-1][2] if self.open else ()))


def read_text(html: str | None) -> str:
    """Text nodes, one a line: those of the longest main part if that has substance, else of the body, else all."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    parts: dict[int, list[str]] = {}
    for text, mains in reader.lines:
        for n in mains:
            parts.setdefault(n, []).append(text)
    best = max(("\n".join(p) for n, p in parts.items() if n != BODY), key=len, default="")
    return best if len(best) >= LEAST_MAIN else "\n".join(parts.get(BODY) or [t for t, _ in reader.lines])


def read_links(html: str | None) -> list[dict[str, str]]:
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    return [{"href": h.strip(), "anchor": " ".join(t)} for h, t in reader.links]


def html_text(html: Column) -> Column:
    @F.pandas_udf("string")
    def text(s: pd.Series) -> pd.Series:
        return s.map(read_text)

    return text(html)


def html_links(html: Column) -> Column:
    @F.pandas_udf("array<struct<href: string, anchor: string>>")
    def links(s: pd.Series) -> pd.Series:
        return s.map(read_links)

    return links(html)


def hrefs(html: Column) -> Column:
    """The quoted targets of anchors, without Python; for pages whose markup is regular."""
    return F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"<a\s[^>]*href=\"([^\"]*)\""), F.lit(1))
