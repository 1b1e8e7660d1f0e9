"""Document frequencies, BM25, score buckets and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkweir.functions.text import words
from inkweir.operators.ordered import prefix_sums
from inkweir.session import cut


def document_frequency(corpus: DataFrame) -> DataFrame:
    """corpus(text) to (word, df): rows that hold a word, each row counting once. Pass one row per
    citation to count a document as often as it is cited. Null texts count for nothing."""
    return corpus.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))


def corpus_stats(corpus: DataFrame) -> DataFrame:
    """corpus(text) to one row (n_documents, avg_length): rows and their mean number of words."""
    return corpus.select(F.coalesce(F.size(words(F.col("text"))), F.lit(0)).alias("n")).agg(F.count("*").alias("n_documents"), (F.sum("n").cast("double") / F.count("*")).alias("avg_length"))


def term_frequency(corpus: DataFrame, *keys: str) -> DataFrame:
    """corpus(*keys, text) to (*keys, word, tf)."""
    return corpus.select(*keys, F.explode(words(F.col("text"))).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("tf"))


def bm25(pairs: DataFrame, documents: DataFrame, frequency: DataFrame, stats: DataFrame, k: float = 1.2, b: float = 0.75) -> DataFrame:
    """pairs(query_id, doc_id, query) and documents(doc_id, text) to (query_id, doc_id, score).

    The score sums over the distinct query words; idf is ``ln((N + df + 0.5) / (df + 0.5))``, which
    stays positive for words that are everywhere. Words that a document lacks add nothing, so only
    words of the query are counted, inside the row of the pair, and go on as counts. Only texts that a
    pair asks for are shuffled, once.
    Pairs without a common word score 0; null texts and queries likewise; unknown documents are left out.
    """
    none = F.array().cast("array<string>")
    told = pairs.select("query_id", "doc_id", F.array_distinct(F.coalesce(words(F.col("query")), none)).alias("asked"))
    texts = documents.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", F.coalesce(words(F.col("text")), none).alias("has"))
    joined = told.join(texts, "doc_id").withColumn("found", F.filter("has", lambda w: F.array_contains("asked", w)))
    counts = F.transform(F.array_distinct("found"), lambda w: F.struct(w.alias("word"), F.size(F.filter("found", lambda x: x == w)).alias("tf")))
    hits = joined.select("query_id", "doc_id", F.size("has").alias("dl"), F.explode_outer(counts).alias("h")).select("query_id", "doc_id", "dl", "h.*")
    known = hits.join(frequency, "word", "left").crossJoin(F.broadcast(stats.limit(1)))
    idf = F.log((F.col("n_documents") + F.coalesce("df", F.lit(0)) + 0.5) / (F.coalesce("df", F.lit(0)) + 0.5))
    weight = F.col("tf") * (k + 1) / (F.col("tf") + k * (1 - b + b * F.col("dl") / F.col("avg_length")))
    return known.groupBy("query_id", "doc_id").agg(F.coalesce(F.sum(idf * weight), F.lit(0.0)).alias("score"))


def score_cuts(scores: DataFrame, column: str = "score", steps: int = 10) -> DataFrame:
    """One row (low, high, cuts): least and greatest score and the exact interpolated quantiles between.

    Different scores are counted, their running counts taken in global order without an ordered task, and
    the two scores around each quantile's place picked out. Null scores don't count; without any the row
    is of nulls.
    """
    counted = scores.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("score")).agg(F.count("*").alias("n"))
    run = cut(prefix_sums(counted, ["score"], upto=F.col("n")))
    bounds = run.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.max("upto").alias("total"))
    places = F.array(*(F.struct(F.lit(i).alias("i"), ((F.col("total") - 1) * F.lit(i) / F.lit(steps)).alias("place")) for i in range(1, steps)))
    asked = F.broadcast(bounds.select("low", "high", F.explode(places).alias("p")).select("low", "high", "p.*"))
    held = lambda place: (place >= F.col("upto") - F.col("n")) & (place < F.col("upto"))
    near = run.join(asked, held(F.floor("place")) | held(F.ceil("place")))
    part = F.col("place") - F.floor("place")
    valued = near.groupBy("low", "high", "i").agg((F.max(F.when(held(F.floor("place")), F.col("score"))) * (1 - F.max(part)) + F.max(F.when(held(F.ceil("place")), F.col("score"))) * F.max(part)).alias("cut"))
    found = valued.groupBy("low", "high").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "cut"))), lambda x: x["cut"]).alias("cuts"))
    return bounds.select("low", "high").join(found.select("cuts"), F.lit(True), "left")


def bucket(scores: DataFrame, cuts: DataFrame, column: str = "score") -> DataFrame:
    """scores with their bucket: the number of cuts strictly below; a score at a cut belongs below it."""
    return scores.crossJoin(F.broadcast(cuts.select("cuts").limit(1))).withColumn("bucket", F.size(F.filter("cuts", lambda c: c < F.col(column)))).drop("cuts")


def stratified_sample(bucketed: DataFrame, n: int, *keys: str, seed: str = "sample") -> DataFrame:
    """At most ``n`` rows of each bucket, in the order of a hash of the keys."""
    order = F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in keys)))
    w = Window.partitionBy("bucket").orderBy("_h", *keys)
    return bucketed.withColumn("_h", order).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_h", "_r")


def random_sample(rows: DataFrame, n: int, *keys: str, seed: str = "sample") -> DataFrame:
    """``n`` rows in the order of a hash of the keys: a shuffle that can be repeated."""
    order = F.md5(F.concat_ws("|", F.lit(seed), *(F.col(k).cast("string") for k in keys)))
    return rows.withColumn("_h", order).orderBy("_h", *keys).limit(n).drop("_h")
