"""Small shared pieces: sites, sentences of documents, normal forms of lines and words."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkweir.operators.timestamps import site_of
from inkweir.session import stored

BLANKS = r"[\s\u00a0]+"
_WORD = re.compile(r"[a-z0-9]+")


def squeeze(text: Column) -> Column:
    """White space runs (no-break spaces too) to one blank, trimmed."""
    return F.trim(F.regexp_replace(text, BLANKS, " "))


def line_key(text: Column) -> Column:
    """The form in which two lines are the same: lower case, digit runs as 0, one blank between words."""
    return squeeze(F.regexp_replace(F.lower(text), r"\d+", "0"))


def sentences(documents: DataFrame, *extra: Column) -> DataFrame:
    """documents(doc_id, canonical_url, paragraphs) to one row per element paragraphs[para_no][sent_no]:
    (doc_id, site, para_no, sent_no, sent, *extra). Null paragraphs and null sentences give no rows."""
    paragraphs = documents.select("doc_id", site_of(F.col("canonical_url")).alias("site"), *extra, F.posexplode("paragraphs").alias("para_no", "para"))
    names = [c for c in paragraphs.columns if c not in ("para",)]
    out = paragraphs.select(*names, F.posexplode("para").alias("sent_no", "sent")).where("sent is not null")
    return out


def plain_words(text: str | None) -> list[str]:
    """Runs of a-z and 0-9 after dropping accents and lower-casing. Null gives none."""
    if not text:
        return []
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return _WORD.findall(text.lower())


@F.pandas_udf(T.StringType())
def spaced_words(text: pd.Series) -> pd.Series:
    """``plain_words`` joined by blanks; null gives an empty string."""
    return pd.Series([" ".join(plain_words(t)) for t in text])


def word_hash(word: str) -> int:
    """64-bit hash of a word, the same in every process."""
    return xxhash.xxh64_intdigest(word)


#: Bytes, as JSON, that a training sample may take on the driver.
SAMPLE_BYTES = 128 << 20


def hashed_sample(df: DataFrame, key: str, bound: int, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """About ``bound`` rows of ``df``, all if it has no more, chosen by a hash of ``key``: for training on
    a bounded sample. Where their rows are long, fewer of them, so that they take about ``most_bytes``
    together; a row that exceeds these alone is not trained on. The choice is made where the rows are;
    only chosen rows are ever sent."""
    total = df.count()
    share = lambda name, part: F.pmod(F.xxhash64(F.lit(name), key), F.lit(1 << 30)) < int((1 << 30) * part)
    chosen = stored(df if total <= bound else df.where(share("sample", bound / total)))
    sized = chosen.withColumn("_bytes", F.octet_length(F.to_json(F.struct(*chosen.columns)))).where(F.col("_bytes") <= most_bytes)
    held = sized.agg(F.sum("_bytes")).first()[0] or 0
    kept = sized if held <= most_bytes else sized.where(share("bytes", most_bytes / held))
    return kept.drop("_bytes")
