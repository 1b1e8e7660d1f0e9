"""Parsing of rendered articles and of web pages with the standard library's HTML parser, in Arrow batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

from inkweir.schemas import ARTICLES

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CITATION = re.compile(r"^\[(\d+)\]")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
_HEADINGS = {f"h{n}": n - 1 for n in range(2, 7)}


class _Node:
    """An element with its children, elements and strings, in order."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict) -> None:
        self.tag, self.attrs, self.children = tag, attrs, []

    def find_all(self, tag: str) -> Iterator[_Node]:
        stack = [self]
        while stack:
            node = stack.pop()
            if node.tag == tag:
                yield node
            stack.extend(c for c in reversed(node.children) if isinstance(c, _Node))

    def strings(self) -> Iterator[str]:
        stack: list = [self]
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            else:
                stack.extend(reversed(node.children))

    def text(self) -> str:
        return "".join(self.strings())


class _TreeBuilder(HTMLParser):
    """A forgiving tree: comments go, void elements don't nest, stray end tags close what they can."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("p", "li", "td", "tr") and any(n.tag == tag for n in self.open[1:]) and self.open[-1].tag == tag:
            self.open.pop()
        node = _Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.open[-1].children.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse_tree(markup: str) -> _Node:
    """The element tree of a page."""
    builder = _TreeBuilder()
    builder.feed(markup)
    builder.close()
    return builder.root


def _classes(node: _Node) -> str:
    return node.attrs.get("class") or ""


# ---------------------------------------------------------------- references

_URL_KEYS = ("archiveurl", "archive-url", "url")
_DATE_KEYS = ("archivedate", "archive-date", "accessdate", "access-date", "date")


def parse_params(template: dict) -> dict[str, str]:
    """Trimmed wikitext of the parameters that have one."""
    return {k: v["wt"].strip() for k, v in (template.get("params") or {}).items() if isinstance(v, dict) and isinstance(v.get("wt"), str)}


def reference_of(data: dict, parse_date) -> dict | None:  # noqa: ANN001
    """One reference from its data-mw: type, title, url, date; None where it has no template.

    The first URL parameter that is present decides, even if it is empty, and an empty one is left out;
    of the dates the first decides that is filled and parses.
    """
    parts = data.get("parts")
    if not parts or not isinstance(parts[0], dict):
        return None
    template = parts[0].get("template") or {}
    kind = ((template.get("target") or {}).get("wt") or "").strip().lower()
    if not kind:
        return None
    params = parse_params(template)
    url = next((params[k] for k in _URL_KEYS if k in params), None)
    day = next((d for k in _DATE_KEYS if params.get(k) and (d := parse_date(params[k]))), None)
    return {"type": kind, "title": params.get("title") or None, "url": url or None, "date": day}


def parse_references(root: _Node, parse_date) -> dict[int, dict]:  # noqa: ANN001
    """References by their place (from 1) among all items of all reference lists of a page. Items
    without a template are left out but take a number."""
    out, n = {}, 0
    for ol in root.find_all("ol"):
        if "mw-references" not in _classes(ol):
            continue
        for li in (c for c in ol.children if isinstance(c, _Node) and c.tag == "li"):
            n += 1
            holder = next((s for s in li.find_all("span") if _classes(s) == "mw-reference-text"), None)
            span = next((c for c in holder.children if isinstance(c, _Node) and c.tag == "span" and "data-mw" in c.attrs), None) if holder else None
            try:
                found = reference_of(json.loads(span.attrs["data-mw"]), parse_date) if span else None
            except (ValueError, AttributeError, TypeError):
                found = None
            if found:
                out[n] = found
    return out


# ---------------------------------------------------------------- articles


def parse_text(node: _Node, adjust_offsets: bool = False) -> tuple[str, list[dict]]:
    """Text of a paragraph without its citations, and those with their offsets.

    A text node that begins with ``[n]`` is a citation and gives no text; one that begins with ``{{`` is
    skipped. Offsets count the text before trimming unless ``adjust_offsets``.
    """
    kept, length, citations = [], 0, []
    for piece in node.strings():
        if piece.startswith("{{"):
            continue
        if m := _CITATION.match(piece):
            citations.append({"reference_id": int(m[1]), "offset": length})
            continue
        kept.append(piece)
        length += len(piece)
    text = "".join(kept)
    if adjust_offsets:
        lead = len(text) - len(text.lstrip())
        citations = [c | {"offset": max(0, c["offset"] - lead)} for c in citations]
    return text.strip(), citations


def sentence_offsets(text: str) -> list[list[int]]:
    """[start, end] of each sentence of a text."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        out.append([at, m.start()])
        at = m.end()
    if at < len(text):
        out.append([at, len(text)])
    return out


def parse_sections(root: _Node, adjust_offsets: bool = False) -> list[dict]:
    """Sections of the body's own children: headings in five slots, deeper ones cleared by a higher one.
    A section counts if it has a paragraph with text and no list; the last one may have a list."""
    body = next(root.find_all("body"), root)
    slots, sections = [""] * 5, []
    paragraphs: list[dict] = []
    shown, listed = list(slots), False

    def close(last: bool) -> None:
        if paragraphs and (last or not listed):
            sections.append({"id": len(sections), "headings": list(shown), "paragraphs": list(paragraphs)})

    for child in body.children:
        if not isinstance(child, _Node):
            continue
        if child.tag in _HEADINGS:
            close(False)
            level = _HEADINGS[child.tag]
            slots[level - 1 :] = [child.text().strip()] + [""] * (5 - level)
            shown, paragraphs, listed = list(slots), [], False
        elif child.tag == "ul":
            listed = True
        elif child.tag == "p":
            text, citations = parse_text(child, adjust_offsets)
            if text:
                paragraphs.append({"id": len(paragraphs), "text": text, "sentence_offsets": sentence_offsets(text), "citations": citations})
    close(True)
    return sections


def default_date(raw: str) -> str | None:
    """The date that a string denotes, as ISO text."""
    from datetime import date

    from inkweir.functions.dates import read_date

    prec, txt, first, *_ = read_date(raw)
    return txt if prec in ("Y", "M") else date.fromordinal(first + date(1970, 1, 1).toordinal()).isoformat() if first is not None else None


def parse_article(title: str, page_id: int, markup: str | None, adjust_offsets: bool = False) -> dict | None:
    """A rendered article: None without references or sections, or where the page can't be parsed."""
    if not markup:
        return None
    root = parse_tree(markup)
    references, sections = parse_references(root, default_date), parse_sections(root, adjust_offsets)
    return {"title": title, "page_id": page_id, "sections": sections, "references": {str(k): v for k, v in references.items()}} if references and sections else None


def parse_articles(pages: DataFrame, adjust_offsets: bool = False) -> DataFrame:
    """pages(title, page_id, html) to articles. A page that fails is left out and hurts no other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                try:
                    found = parse_article(row.title, row.page_id, row.html, adjust_offsets)
                except Exception:  # noqa: BLE001 - one bad page must not end the job
                    found = None
                if found:
                    rows.append(found)
            yield pd.DataFrame(rows, columns=["title", "page_id", "sections", "references"])

    return pages.select("title", "page_id", "html").mapInPandas(run, ARTICLES)


# ---------------------------------------------------------------- web pages

_SKIPPED = frozenset("script style noscript nav aside footer header form button template select".split())


def body_text(markup: str) -> dict:
    """Title, canonical link and paragraphs of a page: the text of ``p`` elements in its article, or in
    all of it without one, without navigation, asides, footers and scripts."""
    root = parse_tree(markup)
    title = next(root.find_all("title"), None)
    link = next((n.attrs.get("href") for n in root.find_all("link") if (n.attrs.get("rel") or "").lower() == "canonical"), None)
    top = next(root.find_all("article"), None) or next(root.find_all("main"), None) or next(root.find_all("body"), root)
    paragraphs: list[str] = []
    stack: list = [top]
    while stack:
        node = stack.pop()
        if node.tag in _SKIPPED:
            continue
        if node.tag == "p":
            if text := " ".join(node.text().split()):
                paragraphs.append(text)
            continue
        stack.extend(c for c in reversed(node.children) if isinstance(c, _Node))
    return {"title": " ".join(title.text().split()) if title else None, "canonicalLink": link, "text": "\n\n".join(paragraphs), "paragraphs": [s for p in paragraphs if (s := [x for x in _SENTENCE.split(p) if x])]}


def extract_bodies(pages: DataFrame) -> DataFrame:
    """pages(canonical_url, html) to documents (canonical_url, text, title, canonicalLink, paragraphs).
    Null pages, pages without paragraphs and pages that fail are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, markup in zip(batch["canonical_url"], batch["html"]):
                try:
                    found = body_text(markup) if markup else None
                except Exception:  # noqa: BLE001 - one bad page must not end the job
                    found = None
                if found and found["paragraphs"]:
                    rows.append((key, found["text"], found["title"], found["canonicalLink"], found["paragraphs"]))
            yield pd.DataFrame(rows, columns=["canonical_url", "text", "title", "canonicalLink", "paragraphs"])

    return pages.select("canonical_url", "html").mapInPandas(run, "canonical_url string, text string, title string, canonicalLink string, paragraphs array<array<string>>")
