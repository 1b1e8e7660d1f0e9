"""Text functions, Column in and Column out, all built-in expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"([\p{L}\p{N}]+)"
_CUT = "\u0001"

def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, with repeats. Null gives null."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(1))


def whitespace_tokens(text: Column) -> Column:
    """Non-empty pieces between white space."""
    return F.filter(F.split(text, r"\s+"), lambda t: t != "")


def token_count(text: Column) -> Column:
    """Number of white-space tokens; 0 for null."""
    return F.when(text.isNull(), 0).otherwise(F.size(whitespace_tokens(text)))


def split_paragraphs(text: Column) -> Column:
    """Pieces between empty lines, without blank ones."""
    return F.filter(F.split(text, r"\n\n"), lambda p: F.trim(p) != "")


def split_sentences(text: Column) -> Column:
    """Sentences of a paragraph: cut after ``. ! ?`` and white space; trimmed, without empty ones."""
    marked = F.regexp_replace(text, r"([.!?])\s+", "$1" + _CUT)
    return F.filter(F.transform(F.split(marked, _CUT), lambda s: F.trim(s)), lambda s: s != "")


def sentence_spans(sentences: Column) -> Column:
    """Array of sentences to [{start, end}] offsets in their text joined by one blank, end exclusive."""
    start = F.aggregate(
        sentences,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, s: F.struct((acc["at"] + F.length(s) + 1).alias("at"), F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + F.length(s)).alias("end")))).alias("spans")),
    )
    return start["spans"]


def slice_spans(text: Column, spans: Column) -> Column:
    """The trimmed stretches of a text under 0-based spans."""
    return F.transform(spans, lambda o: F.trim(F.substring(text, o["start"] + 1, o["end"] - o["start"])))


def categories(wikitext: Column) -> Column:
    """Targets of category links, trimmed; case-sensitive, sort keys kept."""
    return F.transform(F.regexp_extract_all(wikitext, F.lit(r"\[\[Category:(.+?)\]\]"), F.lit(1)), lambda c: F.trim(c))


def flat_text(paragraphs: Column) -> Column:
    """All sentences of nested paragraphs, joined by blanks."""
    return F.array_join(F.flatten(paragraphs), " ")



def _accented() -> tuple[str, str]:
    """Latin letters with marks, and the plain letters under them, by their decomposition."""
    pairs = [(chr(c), unicodedata.normalize("NFKD", chr(c))) for r in (range(0xC0, 0x250), range(0x1E00, 0x1F00)) for c in r]
    kept = [(a, b[0]) for a, b in pairs if b != a and b[0].isascii() and b[0].isalpha() and all(unicodedata.combining(x) for x in b[1:])]
    return "".join(a for a, _ in kept), "".join(b for _, b in kept)


_ACCENTED, _PLAIN = _accented()
# Letters without a decomposition, ligatures and marks, spelt out.
SPELT_OUT = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ı": "i",
    "«": "<<", "»": ">>", "“": '"', "”": '"', "„": '"', "’": "'", "‘": "'", "–": "-", "—": "-", "…": "...", "·": "*",
}


def transliterate(text: Column) -> Column:
    """Latin letters without their marks; sharp s, ligatures, quotes and dashes spelt out. Other scripts
    stay."""
    short = {a: b for a, b in SPELT_OUT.items() if len(b) == 1}
    out = F.translate(text, _ACCENTED + "".join(short), _PLAIN + "".join(short.values()))
    for a, b in SPELT_OUT.items():
        if len(b) > 1:
            out = F.replace(out, F.lit(a), F.lit(b))
    return out


def topic(title: Column, headings: Column) -> Column:
    """Title and headings in one line."""
    return F.concat_ws(" ", title, F.nullif(F.array_join(headings, " "), F.lit("")))


def filled_headings(headings: Column) -> Column:
    """Headings that are not empty."""
    return F.filter(headings, lambda h: h != "")


def heading_html(headings: Column) -> Column:
    """``<hN>last</hN>`` for N non-empty headings; empty if there is none."""
    kept = filled_headings(headings)
    level = F.size(kept).cast("string")
    return F.when(F.size(kept) > 0, F.concat(F.lit("<h"), level, F.lit(">"), F.try_element_at(kept, F.lit(-1)), F.lit("</h"), level, F.lit(">"))).otherwise("")


def splice_citations(text: Column, citations: Column) -> Column:
    """Insert ``[id]`` at each {id, offset} into a text, from the end so that offsets stay true."""
    ordered = F.array_sort(citations, lambda a, b: F.when(a["offset"] > b["offset"], -1).when(a["offset"] < b["offset"], 1).when(a["id"] > b["id"], -1).when(a["id"] < b["id"], 1).otherwise(0))
    return F.aggregate(ordered, text, lambda acc, c: F.concat(F.substring(acc, F.lit(1), c["offset"]), F.lit("["), c["id"].cast("string"), F.lit("]"), F.substring(acc, c["offset"] + 1, F.length(acc))))


def decode_label(answer: Column) -> Column:
    """Yes 1, No 0, anything else -1."""
    return F.when(answer == "Yes", 1).when(answer == "No", 0).otherwise(-1)


def stable_id(*parts: Column) -> Column:
    """A reproducible id of natural keys."""
    return F.md5(F.concat_ws("|", *parts))


def first_date(params: Column, keys: list[str], formats: list[str]) -> Column:
    """The first of several parameters that is filled and parses under one of the formats, as timestamp."""
    tries = [F.try_to_timestamp(F.nullif(F.try_element_at(params, F.lit(k)), F.lit("")), F.lit(f)) for k in keys for f in formats]
    return F.coalesce(*tries)
