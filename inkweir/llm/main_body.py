"""Main body of web pages and documents, by the distribution of text over line blocks.

Markup is stripped to lines (text between block-level tags, cells, items or double line breaks). A line
counts with the length of its text outside links times the probability that the line model of problem 3
gives it to be prose, so that menus, notices and sham text weigh next to nothing. These lengths are summed
over a sliding window of lines; the text surges where a sum reaches SURGE and dives where it falls below
DIVE, and what lies between is kept, but for lines that are surely furniture, filler or errors. A line
that the model doubts, or takes for something else without being sure, is kept inside such a stretch and
dropped outside; so is a line of prose that stands alone and too short for a surge.

A page has one body: of several stretches the heaviest is kept. A line that is nearly all link ends a
stretch, and a text between a label and such a line, as readers' comments stand, weighs nothing. In a
document, whose lines were taken from the page's text already, all stretches are body.
"""

from __future__ import annotations

import html as entities
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.llm import line_model as lm

#: Lines that a window sums; also the furniture lines that may interrupt one body.
WINDOW = 5
#: Characters of prose in a window from which the text surges, and below which it dives.
SURGE, DIVE = 24.0, 8.0
#: Share of a line's characters in links from which it is no text.
LINKED = 0.6

# Tags that end a line.
BLOCK_TAGS = (
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe "
    "legend li main menu nav ol option p pre search section select small summary table tbody td textarea tfoot th thead title tr ul"
)
_HIDDEN = re.compile(r"<!--|<!\[CDATA\[|<(script|style|noscript|template|title|h1|button|select|textarea)\b[^<>]*>", re.I)
_DROPPED = frozenset(["script", "style", "noscript", "template"])
_BLOCK = re.compile(r"<\s*/?\s*(?:" + "|".join(BLOCK_TAGS.split()) + r")\b[^<>]*>|<![^<>]*>|<\?[^<>]*>|<\s*br\s*/?\s*>(?:\s|&nbsp;)*<\s*br\s*/?\s*>", re.I)
_BREAK = re.compile(r"<\s*br\s*/?\s*>", re.I)
_LINK = re.compile(r"<\s*a\b[^>]*>(.*?)(?:<\s*/\s*a\s*>|$)", re.I | re.S)
_TAG = re.compile(r"<\s*/?\s*[a-zA-Z][^<>]*>")
_PLAIN = str.maketrans({"ß": "ss", "æ": "ae", "Æ": "AE", "ø": "o", "Ø": "O", "œ": "oe", "Œ": "OE", "«": "<<", "»": ">>", "“": '"', "”": '"', "„": '"', "’": "'", "‘": "'", "·": "*", "–": "-", "—": "-"})
_BLANKS = re.compile(r"[\s ]+")
_SENTENCE = re.compile(r"(?<=[.!?…])(?<!\b[A-Z]\.)[\"»”]? +(?=[\"«“]?[A-ZÀ-ÝÁ0-9¿¡])")


def visible(markup: str) -> str:
    """Markup without comments, scripts and styles, and with a break in place of headlines and controls.
    One pass: the end of each kind of element is looked for from where the last look ended, so that
    elements without an end cost no more than the others; such stay as they are, but a comment without an
    end hides the rest."""
    out, at, ends = [], 0, {}
    while m := _HIDDEN.search(markup, at):
        kind = (m[1] or m[0]).lower()
        start, end = ends.get(kind, (0, 0))
        if start < m.end():
            close = re.compile(r"</\s*" + kind + r"\s*>" if m[1] else "-->" if kind == "<!--" else r"\]\]>", re.I).search(markup, m.end())
            start, end = ends[kind] = close.span() if close else (len(markup) + 1, len(markup))
        unclosed = start > len(markup)
        if unclosed and kind != "<!--":
            out.append(markup[at : m.end()])
            at = m.end()
            continue
        out += [markup[at : m.start()], "" if kind in _DROPPED or kind == "<!--" else "<p>"]
        at = end
    return "".join(out) + markup[at:]


def page_lines(markup: str) -> list[tuple[str, int]]:
    """(text, characters in links) of each line of a page, without empty lines. Unclosed tags, comments
    and entities are tolerated; text of scripts, styles, the head and form controls is no line."""
    out = []
    for part in _BLOCK.split(visible(markup)):
        if not part or part.isspace():
            continue
        linked = sum(len(_TAG.sub("", x).strip()) for x in _LINK.findall(part)) if "<" in part else 0
        text = _BREAK.sub(" ", part) if "<" in part else part
        text = _TAG.sub("", text) if "<" in text else text
        text = _BLANKS.sub(" ", entities.unescape(text)).strip()
        if text:
            out.append((text, linked))
    return out


def block_sentences(block: str) -> list[str]:
    """Sentences of a block, for the line model, which knows plain ASCII: accents dropped."""
    if not block.isascii():
        block = "".join(c for c in unicodedata.normalize("NFKD", block.translate(_PLAIN)) if not unicodedata.combining(c))
    return _SENTENCE.split(block)


def replies(lines: list[tuple[str, int]]) -> list[bool]:
    """Which lines are readers' comments by how they stand: behind a label of one word, the reader's name,
    and before a line that is nothing but a link, the way to answer."""
    n = len(lines)
    label = [" " not in text and not linked for text, linked in lines]
    link = [linked >= 0.9 * len(text) for text, linked in lines]
    return [bool(i and label[i - 1] and i + 1 < n and link[i + 1] and not link[i]) for i in range(n)]


def stretches(weights: np.ndarray, window: int = WINDOW, surge: float = SURGE, dive: float = DIVE, breaks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """(first, end) of each stretch of lines between a surge and a dive: windows of ``window`` lines hold at
    least ``surge`` at one place, and ``dive`` everywhere up to the ends. A stretch begins and ends with a
    line that weighs at least ``dive``; no window reaches over a line of ``breaks``."""
    n = len(weights)
    if not n:
        return []
    cuts = [-1, *(np.nonzero(breaks)[0] if breaks is not None else []), n]
    out = []
    for low, high in zip(cuts[:-1], cuts[1:]):
        w = weights[low + 1 : high]
        if not len(w):
            continue
        total = np.concatenate([[0], np.cumsum(w)])
        # the sum of a line and the window - 1 lines before it, and of it and those behind it
        back = total[1:] - total[np.maximum(np.arange(len(w)) - window + 1, 0)]
        ahead = total[np.minimum(np.arange(len(w)) + window, len(w))] - total[:-1]
        # between two lines of text lies a dive only if a window there, clear of both, holds nothing
        heavy, start = np.nonzero(w >= dive)[0], None
        for k, i in enumerate(heavy):
            start = i if start is None else start
            later = heavy[k + 1] if k + 1 < len(heavy) else None
            if later is None or later - i > window or back[later - 1] < dive:
                if (np.maximum(back, ahead)[start : i + 1] >= surge).any():
                    out.append((low + 1 + int(start), low + 2 + int(i)))
                start = None
    return out


def keep_body(weights: np.ndarray, whole: bool, window: int = WINDOW, breaks: np.ndarray | None = None) -> np.ndarray:
    """Which lines lie in the body: of all stretches if ``whole``, else of the heaviest."""
    keep = np.zeros(len(weights), bool)
    found = stretches(weights, window, breaks=breaks)
    if found and not whole:
        found = [max(found, key=lambda s: (weights[s[0] : s[1]].sum(), -s[0]))]
    for start, end in found:
        keep[start:end] = True
    return keep


def _judge(blocks: list[list[str]], classify: lm.LineClassifier) -> tuple[np.ndarray, np.ndarray]:
    """Characters of prose to be expected in each block of sentences; whether it is surely something else:
    none of its sentences may be prose, and one of them is not in doubt."""
    flat = [s for b in blocks for s in b]
    classes, sure, prose = classify.judge(flat)
    owner = np.repeat(np.arange(len(blocks)), [len(b) for b in blocks])
    weight = np.bincount(owner, np.fromiter(map(len, flat), np.float64, len(flat)) * prose, len(blocks))
    some = np.bincount(owner[classes == lm.PROSE], minlength=len(blocks)) > 0
    other = np.bincount(owner[(classes != lm.PROSE) & (sure > lm.SURE)], minlength=len(blocks)) > 0
    return weight, ~some & (other | (np.bincount(owner, minlength=len(blocks)) == 0))


def page_bodies(pages: DataFrame, model: lm.LinearModel) -> DataFrame:
    """pages(html_id, html) to the main blocks (html_id, block_no, block). Null and empty pages, and
    pages without prose, give no rows; repeated rows are read each; pages of any length are read whole."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = lm.LineClassifier(model)
        for batch in batches:
            pages_of, starts = [], [0]
            for markup in batch["html"]:
                pages_of.append(page_lines(markup) if isinstance(markup, str) else [])
                starts.append(starts[-1] + len(pages_of[-1]))
            lines = [x for p in pages_of for x in p]
            weight, other = _judge([block_sentences(t) for t, _ in lines], classify)
            ids, numbers, blocks = [], [], []
            for k, page in enumerate(pages_of):
                at = slice(starts[k], starts[k + 1])
                linked = np.array([x >= LINKED * len(text) for text, x in page], dtype=bool)
                clear = np.array([1 - x / max(1, len(text)) for text, x in page])
                drop = other[at] | linked | np.array(replies(page), dtype=bool)
                kept = keep_body(np.where(drop, 0, weight[at] * clear), whole=False, breaks=linked) & ~drop
                for i in np.nonzero(kept)[0]:
                    ids.append(batch["html_id"].iloc[k])
                    numbers.append(i)
                    blocks.append(page[i][0])
            yield pd.DataFrame({"html_id": ids, "block_no": numbers, "block": blocks}).astype({"html_id": "int64", "block_no": "int32", "block": "object"})

    return pages.select("html_id", "html").where("html_id is not null").mapInPandas(run, "html_id bigint, block_no int, block string")


def document_bodies(documents: DataFrame, model: lm.LinearModel) -> DataFrame:
    """documents(doc_id, paragraphs) to the main blocks (doc_id, block_no, block); a block is a
    paragraph, its sentences joined by a blank. Edge cases as in ``page_bodies``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = lm.LineClassifier(model)
        for batch in batches:
            owners, numbers, paragraphs = [], [], []
            for k, paras in enumerate(batch["paragraphs"]):
                for i, para in enumerate(paras if paras is not None else ()):
                    if para is not None and len(para):
                        owners.append(k)
                        numbers.append(i)
                        paragraphs.append([s for s in para if s])
            weight, other = _judge(paragraphs, classify)
            owner, kept = np.array(owners, dtype=np.int64), np.zeros(len(owners), bool)
            for k in np.unique(owner):
                at = slice(*np.searchsorted(owner, [k, k + 1]))
                kept[at] = keep_body(np.where(other[at], 0, weight[at]), whole=True)
            kept &= ~other
            chosen = np.nonzero(kept)[0]
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[owner[chosen]], "block_no": np.array(numbers, dtype=np.int32)[chosen] if len(numbers) else np.zeros(0, np.int32), "block": [" ".join(paragraphs[i]) for i in chosen]}).astype({"doc_id": "int64", "block": "object"})

    return documents.select("doc_id", "paragraphs").where("doc_id is not null").mapInPandas(run, "doc_id bigint, block_no int, block string")


def main_bodies(pages: DataFrame, documents: DataFrame, sample_docs: int = lm.SAMPLE_DOCS) -> DataFrame:
    """The main blocks (rec_kind, rec_id, block_no, block) of pages and documents, with a line model
    trained on at most ``sample_docs`` documents."""
    model = lm.train_line_model(lm.sample_lines(documents, sample_docs))
    own = document_bodies(documents, model).select(F.lit("document").alias("rec_kind"), F.col("doc_id").alias("rec_id"), "block_no", "block")
    return own.unionByName(page_bodies(pages, model).select(F.lit("html").alias("rec_kind"), F.col("html_id").alias("rec_id"), "block_no", "block"))


def block_md5(block: Column) -> Column:
    """Hex MD5 of a block with white space runs as one blank, trimmed."""
    return F.md5(F.encode(F.trim(F.regexp_replace(block, r"[\s ]+", " ")), "UTF-8"))
