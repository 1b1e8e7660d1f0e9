"""Languages of documents and of their sentences.

Sparse multinomial logistic regression on TF-IDF character n-grams (n = 1..4, hashed), trained with
follow-the-regularised-leader and an elastic-net penalty on sentences of labelled documents, and
calibrated by a temperature on documents held out before any training. The labels are partly wrong and
documents mix languages, so the model is trained again without the sentences that the first one
contradicts, and the held-out labels, which stay as they are, are taken to be wrong at a rate that is
estimated with the temperature.
A further class takes what has no language (sham Latin). Capitalised words inside a sentence are
masked, as names say little about the language around them.

The training sample is bounded by SAMPLE_DOCS and PER_LANGUAGE; every sentence of the corpus is
classified, all n-grams of a batch at once in numpy, of which the L1 penalty leaves few to look up.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.llm.common import hashed_sample, word_hash
from inkweir.llm.line_model import LATIN

LANGUAGES = ["en", "de", "fr", "es", "pt", "nl"]
NONE = len(LANGUAGES)
SLOTS_BITS = 17
ORDERS = (1, 2, 3, 4)
#: Bounds of the training sample: documents looked at, sentences of each language.
SAMPLE_DOCS, PER_LANGUAGE = 4000, 1500
#: Sentences whose n-grams are in memory at a time.
CHUNK = 2048
_WORD = re.compile(r"[^\W\d_]+")
_NON_LETTERS = re.compile(r"[\W\d_]+")
_MULTIPLIER = np.uint32(2654435761)

# Labels that name one of the languages (lower case, without region), then labels that name another, then such that name none.
LABELS = {
    "en": "en eng english", "de": "de deu ger german deutsch", "fr": "fr fra fre french français francais", "es": "es spa spanish español espanol castilian", "pt": "pt por portuguese português portugues",
    "nl": "nl nld dut dutch nederlands",
}
OTHER_NAMES = "italian polish russian swedish danish norwegian finnish czech turkish greek hungarian romanian ukrainian arabic hebrew hindi chinese japanese korean latin catalan basque irish welsh"
NO_LANGUAGE = "und unknown mis mul zxx none null nan n/a"


def label_code(label: Column) -> Column:
    """The two-letter code of a language label, the lowered label for other languages, null for none."""
    low = F.regexp_replace(F.lower(F.trim(label)), r"[-_].*$", "")
    named = F.lit(None).cast("string")
    for code, names in LABELS.items():
        named = F.when(low.isin(names.split()), code).otherwise(named)
    other = F.when(low.isin(NO_LANGUAGE.split()), None).when(low.rlike("^[a-z]{2,3}$") | low.isin(OTHER_NAMES.split()), low)
    return F.coalesce(named, other)


def plain_letters(sentence: str) -> bytes:
    """A sentence as the n-grams see it: plain lower-case letters, one blank between words, names masked."""
    if not sentence.isascii():
        sentence = "".join(c for c in unicodedata.normalize("NFKD", sentence.replace("ß", "ss")) if not unicodedata.combining(c))
    words = _WORD.findall(sentence)
    upper = sum(w[0].isupper() for w in words)
    if not (len(words) >= 4 and upper >= 0.8 * len(words)):
        words = [w if not k or not w[0].isupper() else "#" for k, w in enumerate(words)]
    return (" " + " ".join(words).lower() + " ").encode("ascii", "replace")


def ngram_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(slots, owners) of all n-grams of all texts, sorted by owner within each order."""
    if not texts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    flat = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    slots, owners, packed = [], [], np.zeros(len(flat), np.uint32)
    for n in ORDERS:
        size = len(flat) - n + 1
        if size <= 0:
            break
        packed = (packed[:size] << np.uint32(8)) | flat[n - 1 :] if n > 1 else flat
        same = owner[:size] == owner[n - 1 :]
        code = ((packed + np.uint32(n * 0x1F123BB5 & 0xFFFFFFFF)) * _MULTIPLIER) >> np.uint32(32 - SLOTS_BITS)
        slots.append(code[same].astype(np.int32))
        owners.append(owner[:size][same])
    return np.concatenate(slots), np.concatenate(owners)


@dataclass
class LanguageModel:
    """Weights of a softmax over TF-IDF n-grams, and the temperature that makes it honest."""

    weights: np.ndarray  # (slots, classes), sparse rows
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def scores(self, texts: list[bytes]) -> np.ndarray:
        n, k = len(texts), len(self.bias)
        if not n:
            return np.zeros((0, k))
        slots, owners = ngram_features(texts)
        idf = self.idf[slots]
        norm = np.sqrt(np.maximum(np.bincount(owners, idf * idf, n), 1e-9))
        active = np.nonzero(self.used[slots])[0]
        slots, owners, idf = slots[active], owners[active], idf[active]
        rows = self.weights[slots] * idf[:, None]
        out = np.stack([np.bincount(owners, rows[:, c], n) for c in range(k)], axis=1)
        return out / norm[:, None] + self.bias

    @property
    def used(self) -> np.ndarray:
        if not hasattr(self, "_used"):
            self._used = np.any(self.weights != 0, axis=1)
        return self._used

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        if len(texts) > CHUNK:
            return np.concatenate([self.probabilities(texts[i : i + CHUNK]) for i in range(0, len(texts), CHUNK)])
        s = self.scores(texts) / self.temperature
        s = np.exp(s - s.max(axis=1, keepdims=True)) if len(s) else s
        return s / s.sum(axis=1, keepdims=True) if len(s) else s


def train_ftrl(texts: list[bytes], labels: np.ndarray, classes: int, alpha: float = 0.6, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5, epochs: int = 2, batch: int = 64, seed: int = 11) -> LanguageModel:
    """FTRL-proximal over mini-batches with an elastic-net penalty: coordinates whose accumulated
    gradient stays within ``l1`` are exactly zero. No texts give a model of zeros."""
    size = 1 << SLOTS_BITS
    slots, owners = ngram_features(texts)
    order_by = np.argsort(owners, kind="stable")
    slots, owners = slots[order_by], owners[order_by].astype(np.int32)
    del order_by
    starts = np.searchsorted(owners, np.arange(len(texts) + 1))
    df = np.zeros(size, np.int64)
    for at in range(0, len(texts), CHUNK):
        part = slice(starts[at], starts[min(at + CHUNK, len(texts))])
        df += np.bincount(np.unique(owners[part].astype(np.int64) * size + slots[part]) % size, minlength=size)
    idf = np.where(df > 0, np.log((1 + len(texts)) / (1 + df)) + 1, 1).astype(np.float32)
    z, n = np.zeros((size, classes), np.float32), np.zeros((size, classes), np.float32)
    zb, nb, bias = np.zeros(classes), np.zeros(classes), np.zeros(classes)
    norms = np.sqrt(np.maximum(np.bincount(owners, idf[slots] ** 2, max(1, len(texts))), 1e-9))
    rng = np.random.default_rng(seed)

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= l1, 0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs if len(texts) else 0):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            picked = np.concatenate([slots[starts[r] : starts[r + 1]] for r in rows])
            own = np.repeat(np.arange(len(rows)), starts[rows + 1] - starts[rows])
            value = idf[picked] / norms[rows][own]
            touched, inverse = np.unique(picked, return_inverse=True)
            w = weights(z[touched], n[touched])
            score = np.stack([np.bincount(own, w[inverse, c] * value, len(rows)) for c in range(classes)], axis=1) + bias
            p = np.exp(score - score.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            g = np.stack([np.bincount(inverse, p[own, c] * value, len(touched)) for c in range(classes)], axis=1)
            sigma = (np.sqrt(n[touched] + g * g) - np.sqrt(n[touched])) / alpha
            z[touched] += g - sigma * w
            n[touched] += g * g
            gb = p.sum(axis=0)
            sigma = (np.sqrt(nb + gb * gb) - np.sqrt(nb)) / alpha
            zb += gb - sigma * bias
            nb += gb * gb
            bias = -zb / ((beta + np.sqrt(nb)) / alpha + l2)
    return LanguageModel(weights(z, n).astype(np.float32), bias, idf)


def calibrate(model: LanguageModel, texts: list[bytes], labels: np.ndarray) -> LanguageModel:
    """Set the temperature by the likelihood of held-out labels, each of which may be wrong at one rate,
    estimated too, and then name any class."""
    if len(texts):
        scores = model.scores(texts)

        def loss(at: tuple[float, float]) -> float:
            t, wrong = at
            s = scores / t
            p = np.exp(s - s.max(axis=1, keepdims=True))
            own = p[np.arange(len(labels)), labels] / p.sum(axis=1)
            return float(-np.mean(np.log((1 - wrong) * own + wrong / p.shape[1] + 1e-12)))

        model.temperature = min(((t, wrong) for t in np.geomspace(0.05, 5, 60) for wrong in (0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4)), key=loss)[0]
    return model


def _letters(s: str) -> int:
    return sum(map(len, _WORD.findall(s)))


@dataclass
class Sample:
    """Sentences with labels to train on, and those of documents held out."""

    texts: list[bytes]
    labels: np.ndarray
    held_texts: list[bytes]
    held_labels: np.ndarray


def sample_sentences(documents: DataFrame, sample_docs: int = SAMPLE_DOCS, per_language: int = PER_LANGUAGE, seed: int = 5) -> Sample:
    """Sentences of at most ``sample_docs`` documents, chosen by a hash of their id. Every fifth document,
    by another hash, is held out: its sentences keep its label, but such that stand in a document trained
    on too are left out. Of the others there are at most ``per_language`` different sentences of each
    language, labelled by most of the documents that have it (names masked), so that furniture is not
    labelled by the language around it. Sham Latin is NONE."""
    told = documents.select("doc_id", label_code(F.col("lang")).alias("code"), "paragraphs").where(F.col("code").isin(LANGUAGES))
    picked = hashed_sample(told, "doc_id", sample_docs).toPandas()
    votes: dict[bytes, Counter] = defaultdict(Counter)
    apart: dict[bytes, int] = {}
    for doc, code, paragraphs in zip(picked["doc_id"], picked["code"], picked["paragraphs"]):
        held = word_hash(f"held|{doc}") % 5 == 0
        for s in (s for p in paragraphs if p is not None for s in p if s) if paragraphs is not None else ():
            words = [w.lower() for w in _WORD.findall(s)]
            if sum(map(len, words)) >= 25:
                sham = sum(w in LATIN for w in words) >= 0.6 * len(words)
                label = NONE if sham else LANGUAGES.index(code)
                if held:
                    apart[plain_letters(s)] = label
                else:
                    votes[plain_letters(s)][label] += 1
    by: dict[int, list[bytes]] = {c: [] for c in range(NONE + 1)}
    for text in sorted(votes):
        (label, n), total = votes[text].most_common(1)[0], sum(votes[text].values())
        if 2 * n > total:
            by[label].append(text)
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for c, found in by.items():
        keep = sorted(rng.permutation(len(found)), key=lambda i: sum(votes[found[i]].values()) < 5)[:per_language]
        # frequent sentences first, and several times: short furniture has few n-grams
        chosen = [found[i] for i in keep for _ in range(min(6, sum(votes[found[i]].values()).bit_length()))]
        texts += chosen
        labels += [c] * len(chosen)
    unseen = sorted(t for t in apart if t not in votes)
    return Sample(texts, np.array(labels, dtype=np.int64), unseen, np.array([apart[t] for t in unseen], dtype=np.int64))


def train_language_model(sample: Sample, rounds: int = 2) -> LanguageModel:
    """Train; take over confident contradictions, drop doubtful ones and train again, ``rounds`` times;
    calibrate on the documents held out."""
    texts, labels = sample.texts, sample.labels
    model = train_ftrl(texts, labels, NONE + 1)
    if not len(texts):
        return model
    for k in range(rounds):
        p = model.probabilities(texts)
        best, sure = p.argmax(axis=1), p.max(axis=1)
        labels = np.where(sure > 0.8, best, labels)
        agreed = best == labels
        model = train_ftrl([t for t, m in zip(texts, agreed) if m], labels[agreed], NONE + 1, epochs=2 + k)
    return calibrate(model, sample.held_texts, sample.held_labels)


def sentence_languages(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """documents(doc_id, lang, paragraphs) to one row per sentence: (doc_id, label, para_no, sent_no,
    letters, lang_code, confidence). label is the language the document's label names, or null;
    lang_code is null for text without language, as for a sentence without letters, whose confidence is 0.

    Null ids, paragraphs and sentences give no rows; repeated rows are classified each; sentences of any
    length are read whole; an empty table gives none.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codes = np.array([*LANGUAGES, None], dtype=object)
        for batch in batches:
            owners, paras, numbers, sentences = [], [], [], []
            for k, paragraphs in enumerate(batch["paragraphs"]):
                for i, para in enumerate(paragraphs if paragraphs is not None else ()):
                    for j, s in enumerate(para if para is not None else ()):
                        if s is not None:
                            owners.append(k)
                            paras.append(i)
                            numbers.append(j)
                            sentences.append(s)
            letters = np.fromiter(map(_letters, sentences), np.int32, len(sentences))
            at: dict[str, int] = {}
            index = np.array([at.setdefault(s, len(at)) for s in sentences], dtype=np.int64)
            p = model.probabilities([plain_letters(s) for s in at])[index] if len(index) else np.zeros((0, NONE + 1))
            best = p.argmax(axis=1)
            sure = np.where(letters > 0, p[np.arange(len(p)), best], 0.0)
            best = np.where(letters > 0, best, NONE)
            own = np.array(owners, dtype=np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy()[own], "label": batch["label"].to_numpy()[own], "para_no": np.array(paras, dtype=np.int32), "sent_no": np.array(numbers, dtype=np.int32), "letters": letters, "lang_code": codes[best], "confidence": sure})

    told = documents.where("doc_id is not null").select("doc_id", label_code(F.col("lang")).alias("label"), "paragraphs")
    return told.mapInPandas(run, "doc_id bigint, label string, para_no int, sent_no int, letters int, lang_code string, confidence double")


def identify(documents: DataFrame) -> DataFrame:
    """``sentence_languages`` with a model trained on the documents' own labels."""
    return sentence_languages(documents, train_language_model(sample_sentences(documents)))


def document_languages(sentences: DataFrame) -> DataFrame:
    """Sentences to (doc_id, label, lang_code, confidence, n_languages): the language with most letters,
    weighed by confidence; the mean calibrated probability, over all letters of the document that are in
    any language, of being in that one, as far as sentences name it; and the number of languages with
    sentences of 40 letters. Documents without a sentence in any language are absent."""
    weight = F.sum(F.col("letters") * F.col("confidence"))
    by = sentences.where("lang_code is not null").groupBy("doc_id", "label", "lang_code").agg(weight.alias("w"), F.sum("letters").alias("letters"), F.count_if(F.col("letters") >= 40).alias("long"))
    top = F.max_by("lang_code", F.struct("w", "lang_code"))
    return by.groupBy("doc_id", "label").agg(top.alias("lang_code"), (F.max("w") / F.sum("letters")).alias("confidence"), F.count_if(F.col("long") > 0).alias("n_languages"))
