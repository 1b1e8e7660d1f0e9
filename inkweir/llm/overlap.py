"""Same or near-same records across splits, by winnowing fingerprints.

Every distinct text is cut into windows of rolling hashes over its words; of each window the minimum
is kept, in the order of how rare a hash is in the corpus (any fixed order keeps winnowing's promise
that a common run of ``gram + window - 1`` words shares a fingerprint; the rare ones keep the join
small). As a similarity of word sets asks for no common run, the rolling hashes of single words give
minima too: of n distinct words the n - ceil(least n) + 1 rarest, of which two texts of that similarity
share one whatever their order. Fingerprints of evaluation texts are joined with those of training
texts, frequent ones in parts. A row carries the text's number of words and a 128-bit signature of them,
whose differing bits bound the similarity from above without an error, so that the join itself drops
nearly every pair that cannot qualify. The similarity of the rest is computed exactly. For those that are
linked the shared seeds are chained collinearly, and the chain is extended by alignment to the coverage
of both texts, which is reported per record and source.

Copies are collapsed before: a text with a third of all rows is one row in the join.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkweir.llm.common import spaced_words, word_hash
from inkweir.session import stored

GRAM, WINDOW = 3, 3
#: Size of the table of hash counts that orders the fingerprints: fixed, whatever the corpus.
COUNTERS = 1 << 18
#: A fingerprint this many times as frequent as the mean is joined in parts, at most so many.
HOT, MOST_PARTS = 50, 64
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _rolling(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all runs of ``gram`` words: a polynomial over the words' hashes, mod 2**64."""
    out = np.zeros(max(0, len(hashes) - gram + 1), dtype=np.uint64)
    for i in range(gram):
        out = out * _BASE + hashes[i : i + len(out)]
    return out ^ (out >> np.uint64(29))


def _hashes(words: list[str], known: dict[str, int]) -> np.ndarray:
    for w in words:
        if w not in known:
            known[w] = word_hash(w)
    return np.array([known[w] for w in words], dtype=np.uint64)


def gram_counts(reps: DataFrame, gram: int = GRAM) -> np.ndarray:
    """How often hashes fall into each of COUNTERS counters, over all of reps(words). The result has
    COUNTERS numbers whatever the input."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, known = np.zeros(COUNTERS, dtype=np.int64), {}
        for batch in batches:
            every = [_rolling(_hashes(w.split(" "), known), gram) for w in batch["words"]]
            singles = [np.array([known[x] for x in set(w.split(" "))], dtype=np.uint64) for w in batch["words"]]
            flat = np.concatenate([np.zeros(0, np.uint64), *every, *singles])
            total += np.bincount((flat % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
            if len(known) > 2_000_000:
                known.clear()
        at = np.nonzero(total)[0]
        yield pd.DataFrame({"slot": at, "n": total[at]})

    rows = reps.select("words").mapInPandas(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(COUNTERS, dtype=np.int64)
    counts[rows["slot"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return np.minimum(counts, 2**31 - 1).astype(np.int32)


def fingerprints(reps: DataFrame, counts: np.ndarray, least: float, train: bool, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """reps(rep, words) to fingerprints (seed, part, pos, rep, n, sig_a, sig_b); pos is -1 for single
    words. A frequent seed has several parts: a training text has it in one of them, by its number, an
    evaluation text in all."""
    hot = max(1000, int(HOT * counts.sum(dtype=np.int64) / COUNTERS))

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            seeds, places, lengths, ns, a, b = [], [], [], [], [], []
            for text in batch["words"]:
                words = text.split(" ")
                hashes = _hashes(words, known)
                single = np.unique(hashes)
                bits = 0
                for h in single:
                    bits |= 1 << (int(h) & 127)
                grams = _rolling(hashes, min(gram, len(words)))
                rarity = counts[(grams % np.uint64(COUNTERS)).astype(np.int64)].astype(np.int64)
                order = np.lexsort((grams, rarity))
                rank = np.empty(len(grams), np.int64)
                rank[order] = np.arange(len(grams))
                width = min(window, len(grams))
                views = np.lib.stride_tricks.sliding_window_view(rank, width)
                chosen = order[np.unique(views.min(axis=1))]
                chosen = chosen[np.unique(grams[chosen], return_index=True)[1]]
                common = counts[(single % np.uint64(COUNTERS)).astype(np.int64)]
                rare = single[np.lexsort((single, common))][: len(single) - math.ceil(least * len(single) - 1e-9) + 1]
                seeds.append(np.concatenate([grams[chosen], rare]))
                places.append(np.concatenate([chosen, np.full(len(rare), -1)]))
                lengths.append(len(seeds[-1]))
                ns.append(len(single))
                a.append((bits & (2**64 - 1)) - (2**64 if bits >> 63 & 1 else 0))
                b.append((bits >> 64) - (2**64 if bits >> 127 & 1 else 0))
            if len(known) > 2_000_000:
                known.clear()
            if lengths:
                flat = np.concatenate(seeds)
                parts = np.minimum(1 + counts[(flat % np.uint64(COUNTERS)).astype(np.int64)] // hot, MOST_PARTS)
                rep = lambda column: np.repeat(np.asarray(column), lengths)
                out = pd.DataFrame({"seed": flat.view(np.int64), "part": 0, "pos": np.concatenate(places).astype(np.int32), "rep": rep(batch["rep"]), "n": rep(ns).astype(np.int32), "sig_a": rep(np.array(a, dtype=np.int64)), "sig_b": rep(np.array(b, dtype=np.int64))})
                if train:
                    out["part"] = out["rep"] % parts
                elif (parts > 1).any():
                    out = out.loc[out.index.repeat(parts)]
                    out["part"] = out.groupby(level=0).cumcount()
                yield out

    return reps.select("rep", "words").mapInPandas(pick, "seed bigint, part int, pos int, rep bigint, n int, sig_a bigint, sig_b bigint")


def chain(places_a: list[int], places_b: list[int]) -> list[tuple[int, int]]:
    """The longest collinear chain of seeds: rising in both texts."""
    seeds = sorted({(p, q) for p, q in zip(places_a, places_b) if p >= 0 and q >= 0}, key=lambda s: (s[0], -s[1]))
    ends: list[int] = []  # ends[k]: least last place in b of a chain of k + 1 seeds
    last: list[int] = []
    before: list[int] = []
    for i, (_, q) in enumerate(seeds):
        k = bisect_left(ends, q)
        before.append(last[k - 1] if k else -1)
        if k == len(ends):
            ends.append(q)
            last.append(i)
        else:
            ends[k], last[k] = q, i
    out, at = [], last[-1] if last else -1
    while at >= 0:
        out.append(seeds[at])
        at = before[at]
    return out[::-1]


def _common(x: list[str], y: list[str]) -> int:
    """Length of the longest common subsequence, a column of the table in one integer's bits at a time."""
    at: dict[str, int] = {}
    for j, v in enumerate(y):
        at[v] = at.get(v, 0) | 1 << j
    every = (1 << len(y)) - 1
    column = every
    for u in x:
        met = column & at.get(u, 0)
        if met:
            column = ((column + met) | (column - met)) & every
    return len(y) - column.bit_count()


def aligned(a: list[str], b: list[str], seeds: list[tuple[int, int]]) -> int:
    """Words matched when the chain is extended by alignment: seeds stretched while words agree, and
    a common subsequence of what lies between two stretched seeds."""
    matched = at_a = at_b = 0
    for p, q in [*seeds, (len(a), len(b))]:
        if p < at_a or q < at_b:
            continue
        start_p, start_q = p, q
        while start_p > at_a and start_q > at_b and a[start_p - 1] == b[start_q - 1]:
            start_p, start_q = start_p - 1, start_q - 1
        matched += _common(a[at_a:start_p], b[at_b:start_q]) + p - start_p
        while p < len(a) and q < len(b) and a[p] == b[q]:
            p, q, matched = p + 1, q + 1, matched + 1
        at_a, at_b = p, q
    return matched


@F.pandas_udf(T.IntegerType())
def _alignment(a: pd.Series, b: pd.Series, places_a: pd.Series, places_b: pd.Series) -> pd.Series:
    return pd.Series([aligned(x.split(" "), y.split(" "), chain(list(p), list(q))) for x, y, p, q in zip(a, b, places_a, places_b)], dtype="int32")


def _bits_only_in(x: str, y: str) -> Column:
    one = lambda s: F.bit_count(F.col(f"{x}.{s}").bitwiseAND(F.bitwise_not(F.col(f"{y}.{s}"))))
    return one("sig_a") + one("sig_b")


def _keys(words: Column) -> list[Column]:
    """128 bits by which a text is found again."""
    return [F.xxhash64(words).alias("key_a"), F.xxhash64(F.lit("b"), words).alias("key_b")]


def cross_split_overlaps(records: DataFrame, least: float = 0.7, gram: int = GRAM, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """records(rec_id, split_name, text) to

    - classes(rec_id, split_name, rep, n_words): the class of each record with words, named by its
      smallest rec_id; members of a class have the same words in the same order;
    - links(rep_eval, rep_train, similarity, matched, n_seeds): pairs of classes, a training one and
      one of another split, whose distinct words have a Jaccard similarity of at least ``least``;
      matched is the number of aligned words. A class in both splits is linked with itself.

    A null id or split, and a null or wordless text, take no part. Ties at ``least`` are in; repeated rows
    fall into one class; an empty table gives two empty ones. Very long texts are compared whole.
    """
    told = records.select("rec_id", "split_name", "text").where("rec_id is not null and split_name is not null and text is not null")
    worded = told.select("rec_id", "split_name", spaced_words("text").alias("words")).where("words <> ''")
    train = F.col("split_name") == "train"
    reps = stored(worded.groupBy("words").agg(F.min("rec_id").alias("rep"), F.bool_or(train).alias("in_train"), F.bool_or(~train).alias("in_eval")))
    counts = gram_counts(reps, gram)
    kept = lambda x, y: F.col(f"{x}.n") - _bits_only_in(x, y)  # noqa: E731 - at most so many words of x are in y
    possible = F.least(kept("e", "t"), kept("t", "e")) >= F.lit(least - 1e-9) * (F.col("e.n") + F.col("t.n")) / F.lit(1 + least)
    of = lambda side: fingerprints(reps.where(f"in_{side}"), counts, least, side == "train", gram, window)
    met = of("eval").alias("e").join(of("train").alias("t"), (F.col("e.seed") == F.col("t.seed")) & (F.col("e.part") == F.col("t.part")) & (F.col("e.rep") != F.col("t.rep")) & possible)
    seeded = met.groupBy(F.col("e.rep").alias("rep_eval"), F.col("t.rep").alias("rep_train")).agg(F.collect_list(F.struct(F.col("e.pos").alias("p"), F.col("t.pos").alias("q"))).alias("seeds"))
    words = reps.select("rep", "words")
    both = seeded.join(words.toDF("rep_eval", "words_eval"), "rep_eval").join(words.toDF("rep_train", "words_train"), "rep_train")
    a, b = F.array_distinct(F.split("words_eval", " ")), F.array_distinct(F.split("words_train", " "))
    both = both.withColumn("shared", F.size(F.array_intersect(a, b))).withColumn("either", F.size(a) + F.size(b) - F.col("shared"))
    both = both.where(F.col("shared") >= F.lit(least - 1e-9) * F.col("either"))
    linked = both.select("rep_eval", "rep_train", (F.col("shared") / F.col("either")).alias("similarity"), _alignment("words_eval", "words_train", F.col("seeds.p"), F.col("seeds.q")).alias("matched"), F.size("seeds").alias("n_seeds"))
    same = reps.where("in_train and in_eval").select(F.col("rep").alias("rep_eval"), F.col("rep").alias("rep_train"), F.lit(1.0).alias("similarity"), F.size(F.split("words", " ")).alias("matched"), F.lit(0).alias("n_seeds"))
    named = reps.select(*_keys(F.col("words")), "rep", F.size(F.split("words", " ")).alias("n_words"))
    classes = worded.select("rec_id", "split_name", *_keys(F.col("words"))).distinct().join(named, ["key_a", "key_b"]).select("rec_id", "split_name", "rep", "n_words")
    return classes, linked.unionByName(same)


def overlapping_pairs(records: DataFrame, least: float = 0.7) -> DataFrame:
    """The pairs (rec_id_a < rec_id_b) of records behind the links of ``cross_split_overlaps``. A record
    that has rows with different texts may give a pair once for each."""
    classes, links = cross_split_overlaps(records, least)
    train = classes.where("split_name = 'train'").select(F.col("rep").alias("rep_train"), F.col("rec_id").alias("train_id"))
    held = classes.where("split_name <> 'train'").select(F.col("rep").alias("rep_eval"), F.col("rec_id").alias("eval_id"), "split_name")
    pairs = links.join(held, "rep_eval").join(train, "rep_train")
    return pairs.select(F.least("eval_id", "train_id").alias("rec_id_a"), F.greatest("eval_id", "train_id").alias("rec_id_b"), "eval_id", "train_id", "split_name", "similarity", "matched")


def record_coverage(records: DataFrame, least: float = 0.7) -> DataFrame:
    """Every held-out record with words: (rec_id, split_name, rep, n_words, n_classes, n_train, similarity,
    matched, coverage). n_classes and n_train count the training texts and training records it is linked
    with, copies included; similarity is the highest; matched is the most words aligned with one of
    them, and coverage its share of the record's words. Zeros where it is linked with none."""
    classes, links = cross_split_overlaps(records, least)
    copies = classes.where("split_name = 'train'").groupBy(F.col("rep").alias("rep_train")).agg(F.count_distinct("rec_id").alias("copies"))
    best = links.join(copies, "rep_train").groupBy(F.col("rep_eval").alias("rep")).agg(F.count("*").alias("n_classes"), F.sum("copies").alias("n_train"), F.max("similarity").alias("similarity"), F.max("matched").alias("matched"))
    held = classes.where("split_name <> 'train'").join(best, "rep", "left").na.fill(0, ["n_classes", "n_train", "similarity", "matched"])
    return held.select("rec_id", "split_name", "rep", "n_words", "n_classes", "n_train", "similarity", "matched", F.round(F.col("matched") / F.col("n_words"), 6).alias("coverage"))
