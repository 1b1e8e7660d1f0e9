"""Languages of texts by profiles of character trigrams.

A profile holds the most frequent trigrams of each language in labelled texts with the logarithms of
their shares; a text has the language under which its trigrams are most likely. Profiles are small, of a
fixed size, and go to the tasks with the function; counting and scoring work on arrays of code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Trigrams that a profile keeps of each language.
KEPT = 400


def _codes(text: str) -> np.ndarray:
    """The trigrams of a lower-case text, each as a number of its three code points."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    return c[:-2] << 42 | c[1:-1] << 21 | c[2:] if len(c) > 2 else np.zeros(0, np.int64)


@dataclass
class Profiles:
    """Trigrams in order, their scores by language, and the score of a trigram that a language lacks."""

    languages: list[str]
    codes: np.ndarray
    scores: np.ndarray  # (trigrams, languages)
    lacking: np.ndarray

    def language(self, text: str | None) -> str | None:
        """The most likely language, the first in order in a draw; None for a text without a trigram that
        any profile has."""
        if not text or not len(self.codes):
            return None
        found = _codes(text)
        at = np.minimum(np.searchsorted(self.codes, found), len(self.codes) - 1)
        known = self.codes[at] == found
        return self.languages[int(self.scores[at[known]].sum(axis=0).argmax())] if known.any() else None


def train_profiles(labelled: DataFrame, kept: int = KEPT) -> Profiles:
    """Profiles from labelled(text, language), counted over all of it; nulls take no part. Only ``kept``
    trigrams a language reach the driver. Without a labelled text there are no profiles."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for language, texts in batch.groupby("language")["text"]:
                codes, n = np.unique(np.concatenate([_codes(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"language": language, "code": codes, "n": n})

    told = labelled.where("text is not null and language is not null").select("language", "text")
    counts = told.mapInPandas(count, "language string, code bigint, n bigint").groupBy("language", "code").agg(F.sum("n").alias("n"))
    total = counts.groupBy("language").agg(F.sum("n").alias("total"))
    # the limit of a rank is applied before the shuffle too
    ranked = counts.withColumn("r", F.row_number().over(Window.partitionBy("language").orderBy(F.desc("n"), "code"))).where(F.col("r") <= kept)
    top = ranked.groupBy("language").agg(F.collect_list(F.struct("code", "n")).alias("top"))
    rows = top.join(total, "language").orderBy("language").collect()
    languages = [r["language"] for r in rows]
    codes = np.unique(np.array([x["code"] for r in rows for x in r["top"]], dtype=np.int64))
    lacking = np.array([round(100 * float(np.log(0.5 / r["total"]))) for r in rows], dtype=np.int64)
    scores = np.tile(lacking, (len(codes), 1))
    for k, r in enumerate(rows):
        at = np.searchsorted(codes, [x["code"] for x in r["top"]])
        scores[at, k] = [round(100 * float(np.log(x["n"] / r["total"]))) for x in r["top"]]
    return Profiles(languages, codes, scores, lacking)


def language_of(text: Column, profiles: Profiles) -> Column:
    """The language of a text."""

    @F.pandas_udf(T.StringType())
    def one(texts: pd.Series) -> pd.Series:
        return pd.Series([profiles.language(t) for t in texts], dtype="object")

    return one(text)


def languages_of(texts: Column, profiles: Profiles) -> Column:
    """The languages of an array of texts, in its order. A null array has none."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def each(arrays: pd.Series) -> pd.Series:
        return pd.Series([[profiles.language(t) for t in a] if a is not None else None for a in arrays], dtype="object")

    return each(texts)
