"""Template residue and error-page text.

Three regularised linear models, one above the others. The line model (``line_model``, hashed n-grams,
length and form) tells prose from furniture, filler, error text and script notices. The title model, of
hashed n-grams too, is trained on titles with a response status or an error phrase, and on titles that
documents of several hosts without any prose share, against titles of documents with prose. The document
model judges a document by what these two see in it, by placeholders in its title and lines and how the
words before them use them, and by lengths; it is trained on weak labels of documents from response
status, phrases and placeholder lines. Only its verdict counts: no pattern decides by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkweir.llm import line_model as lm
from inkweir.operators.timestamps import site_of

# Titles of error pages and empty shells (lower case).
ERROR_TITLES = [
    "error", "page not found", "not found", "access denied", "forbidden", "service unavailable", "server error", "internal server error", "bad gateway", "just a moment", "attention required",
    "untitled document", "untitled", "seite nicht gefunden", "page introuvable", "pagina no encontrada", "página no encontrada", "pagina nao encontrada", "página não encontrada", "pagina niet gevonden",
]
#: What the document model sees of a document.
FEATURES = [
    "title_unfilled", "line_unfilled", "placeholder_spoken_of", "has_prose", "log_prose", "junk_without_prose", "log_filler", "log_error", "log_script", "error_title_without_prose", "status_title_without_prose",
    "error_title_of_nothing", "filler_over_prose", "log_length", "nothing_at_all",
]
_STATUS = re.compile(r"^(?:error |http )?[45]\d\d(?:\b|$)", re.I)
_SUFFIX = re.compile(r"\s+[-|–—]\s+\S+\s*$")


def bare_title(title: str | None) -> str:
    """A title without the name of the site that follows a dash or a bar."""
    return _SUFFIX.sub("", title or "").strip()


def _title_label(title: str, prose: int, hosts: int) -> int:
    """1 for an error title, 0 for another, -1 where it isn't known. hosts: how many have documents of
    that title with error text or filler and no prose."""
    low = re.sub(r"[^\w ]+", "", re.sub(r"\d+", "", title.lower())).strip()
    if low in ERROR_TITLES or (_STATUS.match(title) and not any(w[:1].isupper() and w.lower() not in " ".join(ERROR_TITLES) for w in title.split()[1:])):
        return 1
    return 0 if prose else 1 if hosts >= 2 else -1


class DocumentJudge:
    """The three models with what is needed to judge documents in a task."""

    def __init__(self, lines: lm.LinearModel, titles: lm.LinearModel, weights: np.ndarray | None = None) -> None:
        self.lines, self.titles = lines, titles
        self.weights = np.zeros(len(FEATURES) + 1) if weights is None else weights

    def verdicts(self, features: np.ndarray) -> np.ndarray:
        """Which documents are residue."""
        return features @ self.weights[:-1] + self.weights[-1] > 0

    def title_error(self, titles: list[str]) -> np.ndarray:
        """Probability of each title to be one of an error page or an empty shell, 0 for no title."""
        if not titles:
            return np.zeros(0)
        bare = [bare_title(t) for t in titles]
        return np.where([bool(t) for t in bare], self.titles.probabilities(*lm.ngram_slots([lm.line_tokens(t) for t in bare], {}))[:, 1], 0.0)

    def features(self, titles: list[str], lines: list[str], owner: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, counts) of documents: FEATURES of each, and its lines by class."""
        n = len(titles)
        count = np.stack([np.bincount(owner[classes == c], minlength=n) for c in range(len(lm.CLASSES))], axis=1) if n else np.zeros((0, len(lm.CLASSES)), np.int64)
        unfilled, spoken, size = np.zeros(n), np.zeros(n), np.zeros(n)
        for x, k in zip(lines, owner):
            size[k] += len(x)
            if lm._PLACEHOLDER.search(x):
                (unfilled if lm.unfilled(x) else spoken)[k] = 1
        prose, filler, error, script = (count[:, c] for c in (lm.PROSE, lm.FILLER, lm.ERROR, lm.SCRIPT))
        wrong, bare = self.title_error(titles), prose == 0
        junk = filler + error + script
        status = np.array([bool(_STATUS.match(bare_title(t))) for t in titles], dtype=bool)
        title = np.array([lm.unfilled(t) for t in titles], dtype=float)
        out = [title, unfilled, spoken, ~bare, np.log1p(prose), bare & (junk > 0), np.log1p(filler), np.log1p(error), np.log1p(script), wrong * bare, status * bare, wrong * (bare & (junk == 0)), np.maximum(0, np.log((1 + filler) / (1 + prose))) * (filler > 0), np.log1p(size) / 10, size == 0]
        return np.stack([np.asarray(f, dtype=float) for f in out], axis=1) if n else np.zeros((0, len(FEATURES))), count


def _counts(classes: np.ndarray, owners: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    prose = np.bincount(owners[classes == lm.PROSE], minlength=n)
    junk = np.bincount(owners[(classes != lm.PROSE) & (classes != lm.FURNITURE)], minlength=n)
    return prose, junk


def title_hosts(documents: DataFrame, titles: set[str], model: lm.LinearModel) -> dict[str, int]:
    """How many hosts have documents, of all, with each of the bare titles over junk without any prose."""
    if not titles:
        return {}

    @F.pandas_udf("boolean")
    def asked(title: pd.Series) -> pd.Series:
        return pd.Series([bare_title(t) in titles for t in title], dtype=bool)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = lm.LineClassifier(model)
        for batch in batches:
            lines = [[x for para in (paras if paras is not None else ()) for x in (para if para is not None else ()) if x] for paras in batch["paragraphs"]]
            prose, junk = _counts(classify([x for ls in lines for x in ls]), np.repeat(np.arange(len(lines)), [len(ls) for ls in lines]), len(lines))
            found = (junk > 0) & (prose == 0)
            yield pd.DataFrame({"title": [bare_title(t) for t in batch["title"][found]], "site": batch["site"][found].to_numpy()}).drop_duplicates().astype("object")

    told = documents.where("doc_id is not null").select(site_of(F.col("canonical_url")).alias("site"), "title", "paragraphs").where(asked("title"))
    counted = told.mapInPandas(run, "title string, site string").distinct().groupBy("title").agg(F.count("*").alias("n")).toPandas()
    return dict(zip(counted["title"], counted["n"]))


def _examples() -> tuple[np.ndarray, np.ndarray]:
    """Plain cases of residue and of none, as the document model sees them, so that a corpus without one of
    them doesn't leave its weight open; as error titles are for the title model."""
    rows = []
    for k in (1, 3, 10, 30):  # lines of prose, filler, error text or furniture
        n, size = np.log1p(k), np.log1p(80 * k) / 10
        text = {"has_prose": 1, "log_prose": n, "log_length": size}
        rows += [(text, 0), (text | {"placeholder_spoken_of": 1}, 0), (text | {"title_unfilled": 1}, 1), (text | {"line_unfilled": 1}, 1), (text | {"log_error": np.log(2)}, 0), (text | {"log_filler": np.log(2)}, 0)]
        rows += [({"log_length": size}, 0), ({"log_length": size, "error_title_without_prose": 1, "error_title_of_nothing": 1}, 1), ({"log_length": size, "line_unfilled": 1}, 1)]
        rows += [({"junk_without_prose": 1, f"log_{kind}": n, "log_length": size} | ({"filler_over_prose": n} if kind == "filler" else {}), 1) for kind in ("filler", "error", "script")]
    for k in (4, 6, 10):  # one line taken for prose among so many of filler is a mistake of the line model
        rows.append(({"has_prose": 1, "log_prose": np.log(2), "log_filler": np.log1p(k), "filler_over_prose": np.log((1 + k) / 2), "log_length": np.log1p(60 * k) / 10}, 1))
    rows += [({"nothing_at_all": 1}, 0), ({"nothing_at_all": 1, "error_title_without_prose": 1, "error_title_of_nothing": 1}, 1), ({"nothing_at_all": 1, "error_title_without_prose": 1, "error_title_of_nothing": 1, "status_title_without_prose": 1}, 1), ({"nothing_at_all": 1, "title_unfilled": 1}, 1)]
    return np.array([[float(r.get(f, 0)) for f in FEATURES] for r, _ in rows]), np.array([y == 1 for _, y in rows])


def _fit(features: np.ndarray, truth: np.ndarray, l2: float = 1e-3, rounds: int = 40) -> np.ndarray:
    """Logistic regression with an L2 penalty by Newton's steps, both classes weighing the same; the bias
    last. Zeros where a class is missing."""
    x, out = np.hstack([features, np.ones((len(features), 1))]), np.zeros(len(FEATURES) + 1)
    if not len(truth) or truth.all() or not truth.any():
        return out
    weight = np.where(truth, 0.5 / truth.mean(), 0.5 / (1 - truth.mean())) / len(truth)
    penalty = np.diag([l2] * len(FEATURES) + [1e-6]) / 10
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        gradient = x.T @ (weight * (p - truth)) + penalty @ out
        out -= np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + penalty, gradient)
    return out


def _document_labels(sample: pd.DataFrame, owner: np.ndarray, titles: list[str], count: np.ndarray) -> np.ndarray:
    """1 for documents that weak signs call residue, 0 for others, -1 where the signs say nothing or
    contradict each other."""
    n, labels = len(titles), sample["label"].to_numpy(np.int64) if len(sample) else np.zeros(0, np.int64)
    some = lambda *kinds: np.bincount(owner[np.isin(labels, kinds)], minlength=n) > 0
    held = np.array([bool(lm._PLACEHOLDER.search(x)) for x in sample["sent"]], dtype=bool) if len(sample) else np.zeros(0, bool)
    spoken = np.array([h and not lm.unfilled(x) for h, x in zip(held, sample["sent"])], dtype=bool) if len(sample) else held
    in_title = np.array([lm.unfilled(t) for t in titles], dtype=bool)
    open_line = some(lm.PLACEHOLDER) & (np.bincount(owner[held & ~spoken], minlength=n) > 0)
    error_title = np.array([_title_label(bare_title(t), 0, 0) == 1 for t in titles], dtype=bool)
    prose = some(lm.PROSE) | (count[:, lm.PROSE] > 0)
    junk = some(lm.ERROR, lm.SCRIPT, lm.FILLER)
    out = np.full(n, -1)
    out[~prose & ~junk & ~error_title] = 0  # nothing, or furniture alone, under an ordinary title
    out[some(lm.PROSE) & ~(np.bincount(owner[held & ~spoken], minlength=n) > 0) & ~in_title] = 0
    out[in_title | open_line | (~prose & junk) | (~prose & error_title)] = 1
    return out


def _sampled(sample: pd.DataFrame) -> tuple[list[str], np.ndarray]:
    """Titles of the sampled documents, those without lines too, and the place of each line's document."""
    docs = sample.attrs["docs"]
    place = {d: k for k, d in enumerate(docs["doc_id"])}
    return [t if isinstance(t, str) else "" for t in docs["title"]], np.array([place[d] for d in sample["doc_id"]], dtype=np.int64)


def train_judge(sample: pd.DataFrame, documents: DataFrame) -> DocumentJudge:
    """The models from ``line_model.sample_lines`` of documents; the hosts that share a title of the
    sample are counted over all of them."""
    lines = lm.train_line_model(sample)
    if not len(sample.attrs["docs"]):
        return DocumentJudge(lines, lm.train_linear(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 2))
    classes = lm.LineClassifier(lines)(list(sample["sent"]))
    full, owners = _sampled(sample)
    prose, _ = _counts(classes, owners, len(full))
    seen = np.bincount(owners, minlength=len(full)) > 0
    titles = [bare_title(t) for t in full]
    hosts = title_hosts(documents, {t for t, p, s in zip(titles, prose, seen) if s and t and _title_label(t, p, 0) < 0}, lines)
    told = [(t, _title_label(t, p, hosts.get(t, 0))) for t, p, s in zip(titles, prose, seen) if s and t]
    told = [x for x in told if x[1] >= 0 and x[0] and not lm._PLACEHOLDER.search(x[0])]
    told += [(t, 1) for t in ERROR_TITLES] + [(f"{code} {t}", 1) for code in (403, 404, 500, 502, 503) for t in ERROR_TITLES[1:9]]
    slots, starts = lm.ngram_slots([lm.line_tokens(t) for t, _ in told], {})
    judge = DocumentJudge(lines, lm.train_linear(slots, starts, np.array([y for _, y in told]), 2))
    features, count = judge.features(full, list(sample["sent"]), owners, classes)
    labels = _document_labels(sample, owners, full, count)
    cases, truth = _examples()
    judge.weights = _fit(np.vstack([features[labels >= 0], cases]), np.concatenate([labels[labels >= 0] == 1, truth]))
    return judge


def judge_documents(documents: DataFrame, judge: DocumentJudge) -> DataFrame:
    """documents(doc_id, canonical_url, title, paragraphs) to one row per row: (doc_id, site, n_prose,
    n_furniture, n_filler, n_error, n_script, n_placeholder, placeholder, error_title, residue).

    Null titles and paragraphs count as empty; rows without an id are left out; an empty document under an ordinary title is no residue;
    repeated rows are judged each; documents of any length are judged whole.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        classify = lm.LineClassifier(judge.lines)
        for batch in batches:
            lines, owners = [], []
            for k, paragraphs in enumerate(batch["paragraphs"]):
                for para in paragraphs if paragraphs is not None else ():
                    for x in para if para is not None else ():
                        if x and not x.isspace():
                            lines.append(x)
                            owners.append(k)
            titles = [t if isinstance(t, str) else "" for t in batch["title"]]
            features, count = judge.features(titles, lines, np.array(owners, dtype=np.int64), classify(lines))
            of = lambda name: features[:, FEATURES.index(name)] > 0
            numbers = {f"n_{name}": count[:, c] for name, c in (("prose", lm.PROSE), ("furniture", lm.FURNITURE), ("filler", lm.FILLER), ("error", lm.ERROR), ("script", lm.SCRIPT), ("placeholder", lm.PLACEHOLDER))}
            yield pd.DataFrame({"doc_id": batch["doc_id"], "site": batch["site"], **numbers, "placeholder": of("title_unfilled") | of("line_unfilled"), "error_title": judge.title_error(titles) > 0.5, "residue": judge.verdicts(features)})

    told = documents.where("doc_id is not null").select("doc_id", site_of(F.col("canonical_url")).alias("site"), "title", "paragraphs")
    return told.mapInPandas(run, "doc_id bigint, site string, n_prose bigint, n_furniture bigint, n_filler bigint, n_error bigint, n_script bigint, n_placeholder bigint, placeholder boolean, error_title boolean, residue boolean")


def residue_documents(documents: DataFrame, sample_docs: int = lm.SAMPLE_DOCS) -> DataFrame:
    """``judge_documents`` of all documents with models trained on at most ``sample_docs`` of them."""
    return judge_documents(documents, train_judge(lm.sample_lines(documents, sample_docs), documents))


def validate_on_unseen_hosts(documents: DataFrame, sample_docs: int = lm.SAMPLE_DOCS) -> pd.DataFrame:
    """(judged, n_truth, n_found, n_right) on hosts that training didn't see, a fifth of the hosts of the
    sample by a hash of their name: lines by class, and documents as residue. Truth is the weak labels,
    so this tells how far the models carry over to other hosts, not how right the labels are."""
    sample = lm.sample_lines(documents, sample_docs)
    docs = sample.attrs["docs"]
    apart = lambda sites: np.array([lm.word_hash(s or "") % 5 == 0 for s in sites], dtype=bool)
    train, test = sample[~apart(sample["site"])].reset_index(drop=True), sample[apart(sample["site"])].reset_index(drop=True)
    train.attrs["docs"], test.attrs["docs"] = docs[~apart(docs["site"])].reset_index(drop=True), docs[apart(docs["site"])].reset_index(drop=True)
    known = {s for s in docs["site"] if not apart([s])[0]}
    judge = train_judge(train, documents.where(F.coalesce(site_of(F.col("canonical_url")), F.lit("")).isin([s or "" for s in known])) if known else documents.where("false"))
    found = lm.LineClassifier(judge.lines)(list(test["sent"]))
    told = (test["label"] >= 0).to_numpy(bool)
    truth = test["label"].to_numpy(np.int64)
    rows = [(name, int((truth[told] == c).sum()), int((found[told] == c).sum()), int(((found == c) & (truth == c))[told].sum())) for c, name in enumerate(lm.CLASSES)]
    titles, owners = _sampled(test)
    features, count = judge.features(titles, list(test["sent"]), owners, found)
    labels, verdicts = _document_labels(test, owners, titles, count), judge.verdicts(features)
    rows.append(("residue", int((labels == 1).sum()), int((verdicts & (labels >= 0)).sum()), int((verdicts & (labels == 1)).sum())))
    return pd.DataFrame(rows, columns=["judged", "n_truth", "n_found", "n_right"])
