"""A linear model that tells running prose from site furniture, filler and error text, line by line.

Multinomial logistic regression with an L2 penalty on hashed word n-grams (n = 1..3), trained here on
weak labels: phrases of error pages and filler, placeholder patterns, lines that a site repeats, and
unique sentences of paragraphs with several. Words are classes as far as names and numbers go, so
that what one site repeats is known on another that shows it once. The training sample is bounded by
``sample_docs``, but how often its lines are repeated is counted over all documents; every line of the
corpus is classified, in Arrow batches, all n-grams of a batch at a time in numpy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkweir.llm.common import hashed_sample, line_key, word_hash
from inkweir.operators.timestamps import site_of

CLASSES = ["prose", "furniture", "filler", "error", "script", "placeholder"]
PROSE, FURNITURE, FILLER, ERROR, SCRIPT, PLACEHOLDER = range(6)
SLOTS = 1 << 16
#: Bound of the training sample, in documents.
SAMPLE_DOCS = 5000

#: Probability beyond which a prediction counts as sure.
SURE = 0.8
#: Lines whose n-grams are in memory at a time.
CHUNK = 4096

# Phrases (lower case, no accents) that betray a kind of text.
ERROR_PHRASES = [
    "could not be found on this server", "page not found", "access denied", "access to this page is forbidden", "service unavailable", "service temporarily unavailable", "internal server error",
    "the server did not answer", "unexpected error", "something went wrong", "too many requests", "account has been suspended", "domain is parked", "must log in to", "not available in your region",
    "connection to the database", "has expired or was removed", "can't find that page", "undefined index", "bad gateway", "gateway timeout", "nicht gefunden", "unerwarteter fehler", "est introuvable",
    "erreur inattendue", "no se encuentra en este servidor", "error inesperado", "nao foi encontrada", "erro inesperado", "niet gevonden", "onverwachte fout",
]
SCRIPT_PHRASES = [
    "enable javascript", "javascript is disabled", "javascript is required", "requires javascript", "turn scripts on", "scripting switched on", "activate scripts", "checking your browser",
    "javascript aktivieren", "activer javascript", "activez javascript", "habilite javascript", "active javascript", "ative o javascript", "schakel javascript in",
]
FILLER_PHRASES = [
    "lorem ipsum", "dummy text", "insert your text", "your text here", "text goes here", "headline goes here", "click to add", "click to edit", "placeholder text", "for layout purposes", "blah blah", "asdf", "test test", "xxxx",
    "text text text", "sample text",
]
FURNITURE_PHRASES = ["all rights reserved", "alle rechte vorbehalten", "tous droits reserves", "todos los derechos reservados", "todos os direitos reservados", "alle rechten voorbehouden"]
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea "
    "commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est "
    "laborum curabitur pretium tincidunt lacus gravida orci a odio vestibulum ante primis faucibus luctus ultrices posuere cubilia integer mauris nibh euismod praesent vitae pellentesque habitant morbi "
    "tristique senectus netus malesuada fames ac turpis egestas sapien ligula rhoncus donec quam sagittis porttitor ornare".split()
)
#: An unfilled placeholder: template braces of some kind, merge fields, values that a program forgot.
PLACEHOLDER_PATTERN = (
    r"\{\{[^{}]*\}\}|\{%[^%]*%\}|[#$]\{[^{}]*\}|\{\w[\w .]*\}|\{ \w[\w .]* \}|<%=?[^%]*%>|@@\w+@@|%%?[A-Z][A-Z0-9_]{2,}%%?|\$\w+\$|__[A-Z][A-Z0-9_]+__|\[\[\w+\]\]|<<?[A-Z][A-Z _]+>>?"
    r"|\[(?:[Ii]nsert|[Yy]our|[Aa]dd|[Ee]nter) [^\]]*\]|\[object Object\]|\bundefined undefined\b|\bNaN\b|\bTODO\b|\bTBD:"
)
_PLACEHOLDER = re.compile(PLACEHOLDER_PATTERN)
#: Words before a placeholder, or anywhere in its line, by which a text speaks about placeholders instead of having one.
_MENTION_BEFORE = re.compile(r"(?:[\"“«'`]|\b(?:write|writes|wrote|writing|type|types|typed|typing|enter|say|says|called|named|tag|tags|variable|field|token|string|code|word|words|label|syntax|reads?))\s*$", re.I)
_MENTION_LINE = re.compile(r"\b(?:manual|tutorial|documentation|template language|placeholders?|syntax|markup)\b", re.I)


def unfilled(line: str) -> bool:
    """Whether a line has a placeholder that stands for something, rather than one it speaks about."""
    return any(not _MENTION_BEFORE.search(line[: m.start()]) for m in _PLACEHOLDER.finditer(line)) and not _MENTION_LINE.search(_PLACEHOLDER.sub(" ", line))
_ENDS = re.compile(r"[.?!…][\"»”')\]>]*$|[.?!…]\"? ?>>$")
_NUMBER = re.compile(r"\d+")
_TOKEN = re.compile(r"[^\W\d_][\w'’-]*|\d+|[^\w\s]+|_+")
_PHRASES = [(ERROR, ERROR_PHRASES), (SCRIPT, SCRIPT_PHRASES), (FILLER, FILLER_PHRASES)]
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def line_tokens(line: str) -> list[str]:
    """Word classes of a line: lower case, numbers as 0, capitalised words but the first as # (not where
    nearly all words are capitalised), marks of its length and of how it ends at the end."""
    if _PLACEHOLDER.search(line):
        line = _PLACEHOLDER.sub(" ¤ ", line)
    words = _TOKEN.findall(line)
    letters = [w for w in words if w[0].isalpha()]
    upper = sum(w[0].isupper() for w in letters)
    shouted = len(letters) >= 4 and upper >= 0.8 * len(letters)
    out, name = ["<s>"], False
    for k, w in enumerate(words):
        c = w[0]
        if c.isalpha():
            if k and c.isupper() and not shouted:
                if not name:
                    out.append("#")
                name = True
                continue
            out.append(w.lower())
        elif c.isdigit():
            out.append("0")
        else:
            out.append(w)
        name = False
    n = len(letters)
    return [*out, "</s>", f"<{min(6, n // 4)}>", "<end>" if _ENDS.search(line.rstrip()) else "<open>"]


def ngram_slots(lines: list[list[str]], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hash slots of the 1-, 2- and 3-grams of many token lists, and where each list's begin."""
    flat = []
    for tokens in lines:
        for t in tokens:
            h = known.get(t)
            if h is None:
                h = known[t] = word_hash(t)
            flat.append(h)
    h = np.array(flat, dtype=np.uint64)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    owner = np.repeat(np.arange(len(lines)), lengths)
    two = h[:-1] * _B1 + h[1:]
    three = two[:-1] * _B2 + h[2:] if len(h) > 2 else h[:0]
    ok2, ok3 = owner[:-1] == owner[1:], owner[:-2] == owner[2:] if len(h) > 2 else np.zeros(0, bool)
    slots = np.concatenate([h, two[ok2], three[ok3]])
    owners = np.concatenate([owner, owner[:-1][ok2], owner[:-2][ok3] if len(h) > 2 else owner[:0]])
    order = np.argsort(owners, kind="stable")
    slots = ((slots ^ (slots >> np.uint64(31))) * _B1 >> np.uint64(48)).astype(np.int64)[order]
    starts = np.searchsorted(owners[order], np.arange(len(lines)))
    return slots, starts


@dataclass
class LinearModel:
    """Weights (slots, classes) and biases of a softmax over hashed features."""

    weights: np.ndarray
    bias: np.ndarray

    def probabilities(self, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros((0, len(self.bias)), np.float32)
        sizes = np.diff(np.append(starts, len(slots)))
        score = np.add.reduceat(self.weights[slots], starts, axis=0) / np.sqrt(np.maximum(sizes, 1))[:, None] + self.bias
        score = np.exp(score - score.max(axis=1, keepdims=True))
        return score / score.sum(axis=1, keepdims=True)


def train_linear(slots: np.ndarray, starts: np.ndarray, labels: np.ndarray, classes: int, epochs: int = 8, rate: float = 0.5, l2: float = 1e-5, seed: int = 7) -> LinearModel:
    """Softmax regression by AdaGrad over mini-batches, with an L2 penalty on the weights touched.
    Classes weigh by the inverse square root of their size. No rows give a model of zeros."""
    model = LinearModel(np.zeros((SLOTS, classes), np.float32), np.zeros(classes, np.float32))
    n = len(labels)
    if not n:
        return model
    squares, square_b = np.full((SLOTS, classes), 1e-6, np.float32), np.full(classes, 1e-6, np.float32)
    ends = np.append(starts[1:], len(slots))
    weight = 1 / np.sqrt(np.maximum(np.bincount(labels, minlength=classes), 1))
    weight = (weight / weight[labels].mean()).astype(np.float32)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 256):
            rows = order[at : at + 256]
            sizes = ends[rows] - starts[rows]
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            picked = slots[np.repeat(starts[rows] - begin, sizes) + np.arange(sizes.sum())]
            gradient = model.probabilities(picked, begin)
            gradient[np.arange(len(rows)), labels[rows]] -= 1
            gradient *= weight[labels[rows]][:, None]
            each = np.repeat(gradient / np.sqrt(np.maximum(sizes, 1))[:, None], sizes, axis=0)
            touched, inverse = np.unique(picked, return_inverse=True)
            total = np.stack([np.bincount(inverse, each[:, k], len(touched)) for k in range(classes)], axis=1).astype(np.float32) + l2 * len(rows) * model.weights[touched]
            squares[touched] += total**2
            model.weights[touched] -= rate * total / np.sqrt(squares[touched])
            bias = gradient.sum(axis=0)
            square_b += bias**2
            model.bias -= rate * bias / np.sqrt(square_b)
    return model


def weak_label(line: str, low: str, sentences_around: int, site_docs: int, corpus_docs: int) -> int | None:
    """The class that a line's phrases, form and repetition suggest; None where they say nothing."""
    words = low.split()
    names = sum(w[:1].isupper() for w in line.split()[1:])
    quoted = '"' in line or "«" in line or "<< " in line
    if _PLACEHOLDER.search(line):
        rest = _PLACEHOLDER.sub(" ", low).split()
        return PLACEHOLDER if len(rest) <= 6 else None
    if not quoted:
        for kind, phrases in _PHRASES:
            if any(p in low for p in phrases):
                return kind if names <= 2 else None
        if len(words) >= 4 and sum(w.strip(".,;") in LATIN for w in words) >= 0.6 * len(words):
            return FILLER
    if site_docs >= 3 or any(p in low for p in FURNITURE_PHRASES):
        return FURNITURE
    if not _ENDS.search(line.rstrip()) and len(words) <= 25:
        return FURNITURE
    if sentences_around >= 2 and corpus_docs <= 2 and len(words) >= 7 and _ENDS.search(line.rstrip()):
        return PROSE
    return None


def document_counts(told: DataFrame, asked: pd.DataFrame) -> dict[tuple[int, str], int]:
    """How many documents of told(doc_id, site, keys) have each line of asked(key, site), on that site
    or, where it is *, on any. Only lines asked for are shuffled, once a document."""
    spark = told.sparkSession
    places = F.broadcast(spark.createDataFrame(asked, "key bigint, site string"))
    lines = told.select("doc_id", "site", F.explode(F.array_distinct(F.flatten("keys"))).alias("key")).join(F.broadcast(places.select("key").distinct()), "key", "left_semi")
    each = lines.groupBy("key", "doc_id").agg(F.array_append(F.collect_set(F.coalesce("site", F.lit(""))), F.lit("*")).alias("sites"))
    counted = each.select("key", F.explode("sites").alias("site")).join(places, ["key", "site"], "left_semi").groupBy("key", "site").agg(F.count("*").alias("n")).toPandas()
    return dict(zip(zip(counted["key"], counted["site"]), counted["n"]))


def sample_lines(documents: DataFrame, sample_docs: int = SAMPLE_DOCS) -> pd.DataFrame:
    """Lines of about ``sample_docs`` documents, chosen by a hash of their id: (site, doc_id, title,
    para_no, sent, label), label the weak label or -1; attrs["docs"] has the (doc_id, site, title) of all of
    them, those without lines too. Repetition is counted over all documents."""
    keys = F.transform(F.filter("paragraphs", lambda p: p.isNotNull()), lambda p: F.transform(p, lambda x: F.xxhash64(line_key(x))))
    told = documents.where("doc_id is not null").select("doc_id", site_of(F.col("canonical_url")).alias("site"), "title", "paragraphs", keys.alias("keys"))
    picked = hashed_sample(told, "doc_id", sample_docs).toPandas()
    rows, line_keys = [], []
    for d, s, t, paras, keyed in zip(*(picked[c] for c in ("doc_id", "site", "title", "paragraphs", "keys"))):
        if paras is not None:
            for (p, para), ks in zip([(p, para) for p, para in enumerate(paras) if para is not None], keyed):
                found = [(x, k) for x, k in zip(para, ks) if x]
                rows += [(s, d, t, p, len(para), x) for x, _ in found]
                line_keys += [int(k) for _, k in found]
    places = [(k, r[0] or "") for r, k in zip(rows, line_keys)]
    asked = pd.DataFrame([*{*places, *((k, "*") for k in line_keys)}], columns=["key", "site"])
    n = document_counts(told, asked) if rows else {}
    lows = [" ".join(_NUMBER.sub("0", r[-1].lower()).split()) for r in rows]
    labels = [weak_label(r[-1], low, r[4], n[at], n[at[0], "*"]) for r, low, at in zip(rows, lows, places)]
    out = pd.DataFrame(rows, columns=["site", "doc_id", "title", "para_no", "around", "sent"])
    out["label"] = [-1 if x is None else x for x in labels]
    out.attrs["docs"] = picked[["doc_id", "site", "title"]].drop_duplicates("doc_id").reset_index(drop=True)
    return out


def train_line_model(lines: pd.DataFrame) -> LinearModel:
    """The line model from weakly labelled lines(sent, label): trained once, then again with confident
    predictions for what had no label and for doubtful prose labels."""
    known: dict[str, int] = {}
    labels = lines["label"].to_numpy(np.int64)
    slots, starts = ngram_slots([line_tokens(x) for x in lines["sent"]], known) if len(lines) else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def subset(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.append(starts[1:], len(slots))
        sizes = (ends - starts)[mask]
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if mask.any() else np.zeros(0, np.int64)
        return slots[np.repeat(starts[mask] - begin, sizes) + np.arange(sizes.sum())], begin

    marked = labels >= 0
    model = train_linear(*subset(marked), labels[marked], len(CLASSES), epochs=3)
    if marked.any():
        guess = model.probabilities(slots, starts)
        best, sure = guess.argmax(axis=1), guess.max(axis=1)
        relabel = (~marked | ((labels == PROSE) & (best == FURNITURE))) & (sure > SURE)
        labels = np.where(relabel, best, labels)
        marked = labels >= 0
        model = train_linear(*subset(marked), labels[marked], len(CLASSES), epochs=4)
    return model


class LineClassifier:
    """Classifies many lines at once in a task; equal lines of a batch once."""

    def __init__(self, model: LinearModel) -> None:
        self.model, self.known = model, {}

    def __call__(self, lines: list[str]) -> np.ndarray:
        return self.judge(lines)[0]

    def judge(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The class of each line, its probability, and that of prose."""
        if len(self.known) > 500_000:
            self.known.clear()
        place: dict[str, int] = {}
        index = np.array([place.setdefault(x, len(place)) for x in lines], dtype=np.int64)
        if not len(index):
            return index, np.zeros(0, np.float32), np.zeros(0, np.float32)
        different = list(place)
        told = [self.model.probabilities(*ngram_slots([line_tokens(x) for x in different[i : i + CHUNK]], self.known)) for i in range(0, len(different), CHUNK)]
        p = np.concatenate(told)
        return p.argmax(axis=1)[index], p.max(axis=1)[index], p[index, PROSE]
