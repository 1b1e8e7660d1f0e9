"""Evaluation texts inside a training corpus, by a positional inverted index.

The index keeps, for the terms that the evaluation texts need, where each term stands in each training
document; it is built in one reading of the corpus and stored. For every run of words asked for, the
rarest terms by document frequency over the whole corpus are looked up; their position lists are
shifted by the terms' offsets in the item, so that hits of one passage fall onto one diagonal, and
intersected there. What survives is compared word by word.

The evaluation texts are the query side. Their vocabulary, the keys of their runs and the ids of the few
candidate documents are sent to the tasks where their measured size is below SENT_BYTES; beyond that they
are joined by shuffles, in which the postings of frequent terms are spread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inkweir.llm.common import plain_words, spaced_words, word_hash
from inkweir.session import cut, stored

#: Bytes up to which a table of fixed-size rows, or a vocabulary, is sent to every task.
SENT_BYTES = 64 << 20
#: Rarest terms of a run whose position lists are intersected.
TERMS = 3
#: Postings of one term from which they are joined in parts, where keys are not sent, and the number of parts.
HOT_TERM, PARTS = 1_000_000, 64


def _signed(word: str) -> int:
    h = word_hash(word)
    return h - (1 << 64) if h >> 63 else h


@F.pandas_udf(T.ArrayType(T.LongType()))
def _term_ids(words: pd.Series) -> pd.Series:
    return pd.Series([[_signed(w) for w in x.split(" ") if w] for x in words])


def item_terms(items: DataFrame) -> DataFrame:
    """items(item_id, text) to (item_id, pos, term, word), one row per word; term is a hash of the word."""
    spaced = items.where("item_id is not null").select("item_id", spaced_words("text").alias("words")).where("words <> ''")
    both = spaced.select("item_id", F.arrays_zip(_term_ids("words").alias("term"), F.split("words", " ").alias("word")).alias("t"))
    return both.select("item_id", F.posexplode("t").alias("pos", "t")).select("item_id", "pos", "t.term", "t.word")


def _vocabulary(terms: DataFrame) -> dict[str, int] | None:
    """Words asked for with their hashes, where they are small enough to be sent."""
    words = terms.select("word", "term").distinct()
    size = words.agg(F.sum(F.octet_length("word") + 64)).first()[0] or 0  # 64: what Python needs for an entry
    return {r["word"]: r["term"] for r in words.collect()} if size <= SENT_BYTES else None


def build_index(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """The stored index (term, doc_id, pos, first) of the words asked for, over the whole texts of
    documents(doc_id, text); first marks a term's first place in its document."""
    wanted = _vocabulary(terms)

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {} if wanted is None else wanted
        for batch in batches:
            ids, places, firsts, lengths = [], [], [], []
            for text in batch["text"]:
                words = plain_words(text)
                if wanted is None:
                    for w in words:
                        if w not in known:
                            known[w] = _signed(w)
                at = [p for p, w in enumerate(words) if w in known]
                found = np.array([known[words[p]] for p in at], dtype=np.int64)
                first = np.zeros(len(found), bool)
                first[np.unique(found, return_index=True)[1]] = True
                ids.append(found)
                places.append(np.array(at, dtype=np.int32))
                firsts.append(first)
                lengths.append(len(at))
            if wanted is None and len(known) > 2_000_000:
                known = {}
            if lengths:
                yield pd.DataFrame({"term": np.concatenate(ids), "doc_id": np.repeat(batch["doc_id"].to_numpy(), lengths), "pos": np.concatenate(places), "first": np.concatenate(firsts)})

    built = documents.select("doc_id", "text").where("doc_id is not null and text is not null").mapInPandas(index, "term bigint, doc_id bigint, pos int, first boolean")
    return stored(built if wanted is not None else built.join(terms.select("term").distinct(), "term", "left_semi"))


def document_frequency(index: DataFrame) -> DataFrame:
    """(term, df) of an index; counts are combined before the shuffle."""
    return index.where("first").groupBy("term").agg(F.count("*").alias("df"))


def rarest_terms(terms: DataFrame, frequency: DataFrame, run: int, n: int = TERMS) -> DataFrame:
    """For every run of ``run`` words of an item whose words all occur in the corpus: (item_id, start,
    keys), keys the ``n`` rarest as (df, pos, term). Runs with an unknown word can't occur."""
    ahead = Window.partitionBy("item_id").orderBy("pos").rowsBetween(0, run - 1)
    known = terms.join(frequency, "term", "left")
    runs = known.select("item_id", F.col("pos").alias("start"), F.count("df").over(ahead).alias("known"), F.collect_list(F.struct("df", "pos", "term")).over(ahead).alias("words"))
    return runs.where(F.col("known") == run).select("item_id", "start", F.slice(F.array_sort("words"), 1, n).alias("keys"))


def _sent(rows: DataFrame, bytes_a_row: int) -> bool:
    """Whether all of a table, of rows of a fixed size as they stand in a hash table, may be sent to every task."""
    return rows.count() * bytes_a_row <= SENT_BYTES


def _hits(index: DataFrame, runs: DataFrame) -> DataFrame:
    """Index hits of the runs' keys: (doc_id, item_id, shift, at), shift = place in the document less
    place in the item."""
    keys = runs.select("item_id", F.explode("keys").alias("k")).select("item_id", F.col("k.pos").alias("at"), F.col("k.term").alias("term"), F.col("k.df").alias("df")).distinct()
    keys = cut(keys)
    if _sent(keys, 112):
        met = index.join(F.broadcast(keys), "term")
    else:
        # the postings of a frequent term are spread over parts, and its keys stand in each of them
        hot = keys.where(F.col("df") >= HOT_TERM).select("term", F.lit(True).alias("hot")).distinct()
        names = F.broadcast(hot) if _sent(hot, 80) else hot
        spread = index.join(names, "term", "left").withColumn("part", F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")).otherwise(0))
        met = spread.join(keys.withColumn("part", F.explode(F.sequence(F.lit(0), F.when(F.col("df") >= HOT_TERM, PARTS - 1).otherwise(0)))), ["term", "part"])
    return met.select("doc_id", "item_id", (F.col("pos") - F.col("at")).alias("shift"), "at")


def _meeting(hits: DataFrame, runs: DataFrame, place: str, run: int) -> DataFrame:
    """(doc_id, item_id, place, at) of the places, diagonals or bands, where all keys of some run of the
    item meet. Hits are counted first, in fixed-size rows; only of places with enough of them are the
    keys' own offsets collected and compared."""
    least = min(TERMS, run)
    enough = cut(hits.groupBy("doc_id", "item_id", place).agg(F.count("*").alias("n")).where(F.col("n") >= least).drop("n"))
    kept = hits.join(F.broadcast(enough) if _sent(enough, 112) else enough, ["doc_id", "item_id", place], "left_semi")
    found = kept.groupBy("doc_id", "item_id", place).agg(F.collect_set("at").alias("at"))
    needed = runs.groupBy("item_id").agg(F.collect_set("keys.pos").alias("needed"))
    met = found.where(F.size("at") >= least).join(needed, "item_id")
    return met.where(F.exists("needed", lambda keys: F.size(F.array_except(keys, F.col("at"))) == 0)).drop("needed")


def _longest_run(words: list[str], item: list[str], shift: int) -> int:
    best = now = 0
    for q, word in enumerate(item):
        p = q + shift
        now = now + 1 if 0 <= p < len(words) and words[p] == word else 0
        best = max(best, now)
    return best


@F.pandas_udf(T.IntegerType())
def _run_on_diagonals(text: pd.Series, item: pd.Series, shifts: pd.Series) -> pd.Series:
    out = []
    for t, i, s in zip(text, item, shifts):
        words, wanted = plain_words(t), plain_words(i)
        out.append(max(_longest_run(words, wanted, int(k)) for k in s))
    return pd.Series(out, dtype="int32")


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 12) -> DataFrame:
    """documents(doc_id, text) and items(item_id, text) to (doc_id, item_id, longest): the documents
    that hold at least ``run`` consecutive words of an item, with the longest run found.

    Null and wordless texts match nothing; items shorter than ``run`` words match nothing; a repeated
    doc_id or item_id gives one row; an empty side gives none. Whole texts are read, of any length.
    """
    terms = cut(item_terms(items))
    index = build_index(documents, terms)
    runs = cut(rarest_terms(terms, document_frequency(index), run))
    met = _meeting(_hits(index, runs), runs, "shift", run)
    pairs = cut(met.groupBy("doc_id", "item_id").agg(F.collect_set("shift").alias("shifts")))
    # the texts of the few candidates are picked where they lie
    ids = pairs.select("doc_id").distinct()
    texts = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(ids) if _sent(ids, 80) else ids, "doc_id", "left_semi")
    texts = texts.join(pairs, "doc_id").join(items.select("item_id", F.col("text").alias("item")), "item_id")
    checked = texts.select("doc_id", "item_id", _run_on_diagonals("text", "item", "shifts").alias("longest"))
    return checked.where(F.col("longest") >= run).groupBy("doc_id", "item_id").agg(F.max("longest").alias("longest"))


def near_items(documents: DataFrame, items: DataFrame, run: int = 12, slop: int = 3) -> DataFrame:
    """Proximity matches: (doc_id, item_id, n_terms), the documents in which the rarest terms of some
    run of an item all stand within ``slop`` words of where they should. Edge cases as in
    ``leaked_items``, which finds the exact phrases among these."""
    terms = cut(item_terms(items))
    index = build_index(documents, terms)
    runs = cut(rarest_terms(terms, document_frequency(index), run))
    band = 2 * slop + 1
    hits = _hits(index, runs)
    # a band and its half-shifted neighbour: hits within `slop` of each other share one of them
    banded = hits.withColumn("band", F.explode(F.array(F.floor(F.col("shift") / band) * 2, F.floor((F.col("shift") + slop) / band) * 2 + 1)))
    return _meeting(banded, runs, "band", run).groupBy("doc_id", "item_id").agg(F.max(F.size("at")).alias("n_terms"))
