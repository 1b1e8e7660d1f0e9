"""Context / cloze / document instances from articles and the documents they cite."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkweir.functions.text import filled_headings, slice_spans, stable_id


def group_citations(citations: Column) -> Column:
    """[{reference_id, offset}] to [{offset, ids}], in the order in which offsets first occur; ids keep
    their order and repeats."""
    offsets = F.array_distinct(F.transform(citations, lambda c: c["offset"]))
    return F.transform(offsets, lambda o: F.struct(o.alias("offset"), F.transform(F.filter(citations, lambda c: c["offset"] == o), lambda c: c["reference_id"]).alias("ids")))


def cited_sentences(paragraphs: DataFrame, group_by: str = "offset") -> DataFrame:
    """paragraphs(*, text, spans, citations) to one row per cited sentence: (*, sentence_no, ids,
    sentences). Spans are closed at both ends: a citation at the end of one sentence that starts the
    next belongs to both. ``group_by='offset'`` keeps one row per offset, ``'sentence'`` one per sentence.
    The match runs inside the row; nothing is shuffled. Null spans or citations give no rows."""
    sentences = paragraphs.withColumn("sentences", slice_spans(F.col("text"), F.col("spans")))
    each = sentences.withColumn("_s", F.explode(F.transform("spans", lambda s, i: F.struct(i.alias("no"), s["start"].alias("start"), s["end"].alias("end")))))
    inside = F.filter("citations", lambda c: (c["offset"] >= F.col("_s.start")) & (c["offset"] <= F.col("_s.end")))
    each = each.withColumn("_in", inside).where(F.size("_in") > 0)
    if group_by == "sentence":
        each = each.withColumn("ids", F.transform("_in", lambda c: c["reference_id"]))
    else:
        each = each.withColumn("ids", F.explode(F.transform(group_citations(F.col("_in")), lambda g: g["ids"])))
    return each.withColumn("sentence_no", F.col("_s.no")).drop("_s", "_in", "text", "spans", "citations")


def instances(cited: DataFrame, references: DataFrame, documents: DataFrame) -> DataFrame:
    """cited(page_id, page_title, headings, sentence_no, ids, sentences), references(page_id,
    reference_id, canonical_url) and documents(canonical_url, paragraphs, ...) to instances (id,
    page_id, page_title, headings, documents, context, cloze).

    The first sentence of a paragraph has no context and gives no instance; documents without
    paragraphs count as missing; an instance without a document is left out. Documents keep the order
    of the citations.
    """
    useful = cited.where("sentence_no >= 1").withColumn("id", stable_id(F.col("page_id").cast("string"), F.array_join("headings", "/"), F.array_join("sentences", " "), F.col("sentence_no").cast("string"), F.array_join(F.col("ids").cast("array<string>"), ",")))
    asked = useful.select("id", "page_id", F.posexplode("ids").alias("pos", "reference_id")).join(references.select("page_id", "reference_id", "canonical_url"), ["page_id", "reference_id"])
    found = asked.join(documents.where(F.size("paragraphs") > 0).select("canonical_url", F.col("paragraphs")), "canonical_url")
    nested = found.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "canonical_url", "paragraphs"))).alias("_d"))
    docs = F.transform("_d", lambda d: F.struct(d["canonical_url"].alias("canonical_url"), d["paragraphs"].alias("paragraphs")))
    n = F.col("sentence_no")
    return useful.join(nested, "id").select("id", "page_id", "page_title", filled_headings(F.col("headings")).alias("headings"), docs.alias("documents"), F.slice("sentences", F.lit(1), n).alias("context"), F.slice("sentences", n + 1, F.size("sentences") - n).alias("cloze"))


def regroup(rows: DataFrame, order: str) -> DataFrame:
    """Instances of one page with the same context and cloze become one: the first one's fields, the
    union of their documents in first-seen order, one per canonical_url. Null URLs are one document."""
    key = ["page_id", F.array_join("context", " ").alias("_c"), F.array_join("cloze", " ").alias("_z")]
    keyed = rows.select("*", *key[1:])
    first = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("page_id", "_c", "_z").orderBy(order))).where("_r = 1").drop("_r", "documents")
    each = keyed.select("page_id", "_c", "_z", order, F.posexplode("documents").alias("_p", "_d"))
    once = each.groupBy("page_id", "_c", "_z", F.col("_d.canonical_url").alias("_u")).agg(F.min(F.struct(F.col(order).alias("o"), "_p", "_d")).alias("m"))
    merged = once.groupBy("page_id", "_c", "_z").agg(F.transform(F.array_sort(F.collect_list("m")), lambda m: m["_d"]).alias("documents"))
    same = lambda c: F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    joined = first.alias("a").join(merged.alias("b"), same("page_id") & same("_c") & same("_z"), "left")
    return joined.select("a.*", "b.documents").drop("_c", "_z")


def release(rows: DataFrame) -> DataFrame:
    """context becomes left_context, the first cloze sentence cloze, the others right_context."""
    rest = F.slice("cloze", F.lit(2), F.greatest(F.size("cloze") - 1, F.lit(0)))
    return rows.withColumns({"left_context": F.col("context"), "right_context": rest}).withColumn("cloze", F.get("cloze", F.lit(0))).drop("context")
