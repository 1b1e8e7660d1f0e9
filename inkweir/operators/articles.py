"""What is done with parsed articles: their references, citations, and their rendering with links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkweir.functions.text import heading_html


def article_references(articles: DataFrame) -> DataFrame:
    """articles(page_id, references map) to one row per reference: (page_id, reference_id, type, title,
    url, date). Articles without references give none."""
    each = articles.select("page_id", F.explode("references").alias("reference_id", "r"))
    return each.select("page_id", F.col("reference_id").cast("int").alias("reference_id"), "r.type", "r.title", "r.url", "r.date")


def article_paragraphs(articles: DataFrame) -> DataFrame:
    """articles(title, page_id, sections) to one row per paragraph: (title, page_id, section_id, headings,
    paragraph_id, text, sentence_offsets, citations)."""
    sections = articles.select("title", "page_id", F.explode("sections").alias("s"))
    return sections.select("title", "page_id", F.col("s.id").alias("section_id"), F.col("s.headings").alias("headings"), F.explode("s.paragraphs").alias("p")).select("title", "page_id", "section_id", "headings", F.col("p.id").alias("paragraph_id"), "p.text", "p.sentence_offsets", "p.citations")


def article_citations(articles: DataFrame) -> DataFrame:
    """(page_id, section_id, paragraph_id, reference_id, char_offset) of all citations."""
    told = article_paragraphs(articles).select("page_id", "section_id", "paragraph_id", F.explode("citations").alias("c"))
    return told.select("page_id", "section_id", "paragraph_id", "c.reference_id", F.col("c.offset").alias("char_offset"))


def resolvable(articles: DataFrame, known: DataFrame) -> DataFrame:
    """The articles with at least one reference whose URL is in known(url). Only ids are shuffled."""
    found = article_references(articles).join(known.select("url").distinct(), "url", "left_semi").select("page_id").distinct()
    return articles.join(found, "page_id", "left_semi")


def rendered(articles: DataFrame, known: DataFrame) -> DataFrame:
    """articles and known(url) to one row per article: (page_id, html, saved). html has headings and
    paragraphs with ``[n]`` spliced in again, as a link to ``n.json`` where the reference's URL is known;
    saved are the ids linked to, in order, each once."""
    references = article_references(articles).where("url is not null")
    linked = references.join(known.select("url").distinct(), "url", "left_semi").groupBy("page_id").agg(F.collect_set("reference_id").alias("links"))
    told = article_paragraphs(articles).join(linked, "page_id", "left").withColumn("links", F.coalesce("links", F.array().cast("array<int>")))
    # from the last offset to the first, so that offsets stay true; of equal ones the first comes last
    placed = F.reverse(F.array_sort(F.transform("citations", lambda c, i: F.struct(c["offset"].alias("offset"), (-i).alias("i"), c["reference_id"].alias("id")))))
    mark = lambda c: F.concat(F.lit("["), c["id"].cast("string"), F.lit("]"))
    link = lambda c: F.when(F.array_contains("links", c["id"]), F.concat(F.lit('<a href="'), c["id"].cast("string"), F.lit('.json">'), mark(c), F.lit("</a>"))).otherwise(mark(c))
    text = F.aggregate(placed, F.col("text"), lambda acc, c: F.concat(F.substring(acc, F.lit(1), c["offset"]), link(c), F.substring(acc, c["offset"] + 1, F.length(acc))))
    paragraphs = told.select("page_id", "section_id", "headings", "paragraph_id", F.concat(F.lit("<p>"), text, F.lit("</p>")).alias("html"), F.filter(F.transform("citations", lambda c: c["reference_id"]), lambda i: F.array_contains("links", i)).alias("used"))
    sections = paragraphs.groupBy("page_id", "section_id", "headings").agg(F.transform(F.array_sort(F.collect_list(F.struct("paragraph_id", "html"))), lambda p: p["html"]).alias("html"), F.array_distinct(F.flatten(F.collect_list("used"))).alias("used"))
    blocks = sections.select("page_id", "section_id", F.filter(F.concat(F.array(heading_html(F.col("headings"))), "html"), lambda h: h != "").alias("html"), "used")
    whole = blocks.groupBy("page_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("section_id", "html"))), lambda s: s["html"])).alias("html"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("used")))).alias("saved"))
    return whole.select("page_id", F.array_join("html", "\n").alias("html"), "saved")
