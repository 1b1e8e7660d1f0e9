"""Rules that released instances must meet, and statistics of splits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.functions.text import token_count, topic


def _filled(text: Column) -> Column:
    return F.coalesce(F.trim(text) != "", F.lit(False))


RULES = {
    "id": lambda: _filled(F.col("id")),
    "page_title": lambda: _filled(F.col("page_title")),
    "page_id": lambda: F.col("page_id").isNotNull(),
    "left_context": lambda: F.coalesce((F.size("left_context") > 0) & F.forall("left_context", _filled), F.lit(False)),
    "cloze": lambda: _filled(F.col("cloze")),
    "documents": lambda: F.coalesce((F.size("documents") > 0) & F.forall("documents", lambda d: _filled(d["canonical_url"])), F.lit(False)),
}


def rule_violations(released: DataFrame) -> DataFrame:
    """released(id, page_title, page_id, left_context, cloze, documents) to (rule, violations), one row
    per rule, 0 where all rows meet it. Nulls violate every rule; an empty table violates none."""
    counts = released.agg(*(F.count_if(~RULES[r]()).alias(r) for r in RULES))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.coalesce(F.col(r), F.lit(0)).alias("violations")) for r in RULES))).alias("x")).select("x.*")


def shared_keys(rows: DataFrame, split: str, keys: list[str]) -> DataFrame:
    """rows(split, *keys) to (key, split_a, split_b, n): for each key column and pair of splits, how many
    values both have. Nulls are shared by none. Pairs without a shared value are absent."""
    parts = []
    for k in keys:
        seen = rows.where(F.col(k).isNotNull()).select(F.lit(k).alias("key"), F.col(k).cast("string").alias("value"), F.col(split).alias("s")).distinct()
        parts.append(seen.groupBy("key", "value").agg(F.array_sort(F.collect_set("s")).alias("splits")).where(F.size("splits") > 1))
    both = reduce(DataFrame.unionByName, parts)
    pairs = F.flatten(F.transform("splits", lambda a: F.transform(F.filter("splits", lambda b: b > a), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))
    return both.select("key", F.explode(pairs).alias("p")).groupBy("key", F.col("p.split_a").alias("split_a"), F.col("p.split_b").alias("split_b")).agg(F.count("*").alias("n"))


def split_stats(instances: DataFrame) -> DataFrame:
    """instances(split_name, page_title, headings, documents, context, cloze) to one row per split and
    one for all (null): counts and means with population deviations of lengths in white-space tokens, and
    of the context in sentences too. The cloze is the cited sentence, the first of its array."""
    total = lambda texts: F.aggregate(F.coalesce(texts, F.array().cast("array<string>")), F.lit(0), lambda a, s: a + token_count(s))
    sized = instances.select(
        "split_name",
        F.coalesce(F.size("documents"), F.lit(0)).alias("n_documents"),
        token_count(topic(F.col("page_title"), F.col("headings"))).alias("topic"),
        total(F.col("context")).alias("context"),
        F.coalesce(F.size("context"), F.lit(0)).alias("context_sentences"),
        token_count(F.get("cloze", F.lit(0))).alias("cloze"),
    )
    lengths = [x for c in ("topic", "context", "context_sentences", "cloze") for x in (F.round(F.avg(c), 6).alias(f"{c}_mean"), F.round(F.stddev_pop(c), 6).alias(f"{c}_std"))]
    return sized.rollup("split_name").agg(F.count("*").alias("n_instances"), F.count_if(F.col("n_documents") == 1).alias("n_single"), F.count_if(F.col("n_documents") != 1).alias("n_multi"), *lengths)


def document_lengths(cited: DataFrame) -> DataFrame:
    """cited(split_name, paragraphs), one row per citation of a document, to one row per split and one for
    all (null): means and population deviations of the documents' white-space tokens and sentences."""
    sized = cited.select("split_name", F.aggregate(F.coalesce(F.flatten("paragraphs"), F.array().cast("array<string>")), F.lit(0), lambda a, s: a + token_count(s)).alias("tokens"), F.coalesce(F.size(F.flatten("paragraphs")), F.lit(0)).alias("sentences"))
    stats = [x for c in ("tokens", "sentences") for x in (F.round(F.avg(c), 6).alias(f"{c}_mean"), F.round(F.stddev_pop(c), 6).alias(f"{c}_std"))]
    return sized.rollup("split_name").agg(F.count("*").alias("n_cited"), *stats)


def document_use(citations: DataFrame) -> DataFrame:
    """citations(url, page_id) to one row: different documents, citations, documents used more than once
    and on more than one page. Null URLs are left out."""
    by = citations.where("url is not null").groupBy("url").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("pages"))
    return by.agg(F.count("*").alias("n_documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_citations"), F.count_if(F.col("n") > 1).alias("n_reused"), F.count_if(F.col("pages") > 1).alias("n_on_pages"))
