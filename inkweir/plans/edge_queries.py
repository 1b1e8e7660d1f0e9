"""Queries over files: readers, writers, parsers and streams, on files that are written from the tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkweir import schemas
from inkweir.operators import articles, crawl, ranking
from inkweir.plans import core_queries as core
from inkweir.plans.registry import Registry
from inkweir.session import scratch, stored, table
from inkweir.sources import files, markup, ranges
from inkweir.streaming import filters

registry = Registry()

# ---------------------------------------------------------------- JSON lines

_DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("paragraphs", T.ArrayType(T.ArrayType(T.StringType())))])


def _round_trip(codec: str | None):  # noqa: ANN202
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = scratch(spark)
        files.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "title", "paragraphs"), folder, codec, rows_per_file=10_000)
        back = files.read_jsonl(spark, folder, _DOC, "*.json*")
        return back.select("doc_id", "title", F.coalesce(F.size("paragraphs"), F.lit(0)).alias("n_paragraphs"), F.array_join(F.flatten("paragraphs"), " ").alias("body"))

    query.__doc__ = f"Documents written as JSON lines ({codec or 'plain'}) and read back."
    return query


for _name, _codec in (("jsonl_plain", None), ("jsonl_gzip", "gzip"), ("jsonl_bzip2", "bzip2")):
    registry.query(_name, sql="SELECT doc_id, title, CAST(coalesce(len(paragraphs), 0) AS INT) AS n_paragraphs, array_to_string(flatten(paragraphs), ' ') AS body FROM documents")(_round_trip(_codec))


@registry.query("labelled_rows", sql="SELECT CAST(inst_no AS VARCHAR) AS id, cloze[1] AS sentence, CASE split_name WHEN 'train' THEN 1 ELSE 0 END AS label FROM instances WHERE split_name IN ('train', 'valid')")
def labelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with a decided label, from a file where some have none."""
    label = F.when(F.col("split_name") == "train", 1).when(F.col("split_name") == "valid", 0).otherwise(-1)
    folder = scratch(spark)
    files.write_jsonl(table(spark, sf_dir, "instances").select(F.col("inst_no").cast("string").alias("id"), F.get("cloze", F.lit(0)).alias("sentence"), label.alias("label")), folder)
    return files.read_labelled(spark, folder).select("id", "sentence", "label")


@registry.query("views_last_row", sql="SELECT page_id, arg_max(coalesce(view_count, -1), view_month) AS views FROM page_views GROUP BY page_id")
def views_last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of each page from one file a month, of which the last counts; -1 stands for a null."""
    folder = scratch(spark)
    rows = table(spark, sf_dir, "page_views").select("page_title", "page_id", F.coalesce("view_count", F.lit(-1)).alias("views"), F.col("view_month").alias("m"))
    files.write_jsonl(rows, folder, partition_by=["m"])
    return files.read_views(spark, folder).select("page_id", "views")


@registry.query("category_pages", sql="SELECT DISTINCT page_id FROM instances WHERE list_contains(headings, 'Career') AND page_id IS NOT NULL")
def category_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a category, from a file of all pages' categories."""
    folder = scratch(spark)
    files.write_jsonl(table(spark, sf_dir, "instances").where("page_id is not null").select(F.col("page_title").alias("title"), "page_id", F.col("headings").alias("categories")), folder, "bzip2")
    return files.read_category_pages(spark, folder, "Career")


@registry.query("bucket_files", sql="SELECT split_name AS label, count(*) AS n FROM instances WHERE split_name IS NOT NULL GROUP BY split_name")
def bucket_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the folder of each bucket."""
    folder = scratch(spark)
    files.write_buckets(table(spark, sf_dir, "instances").where("split_name is not null").select("inst_no", F.col("split_name").alias("label")), folder)
    return spark.read.schema("inst_no bigint, label string").json(folder).groupBy("label").agg(F.count("*").alias("n"))


@registry.query("row_files", sql="SELECT source, time_zone, site_name FROM sites WHERE source IS NOT NULL")
def row_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sites written to a file each and read back."""
    folder = scratch(spark)
    rows = table(spark, sf_dir, "sites")
    files.write_rows_as_files(rows, folder, "source", rows.count())
    return spark.read.schema("source string, time_zone string, site_name string").option("multiLine", True).json(folder)


# ---------------------------------------------------------------- dumps, capture indexes, annotation tables, stores


def _xml(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@registry.query("dump_categories", sql="SELECT inst_no AS page_id, coalesce(array_to_string(list_transform(headings, lambda h: trim(h)), '|'), '') AS categories FROM instances WHERE trim(page_title) <> '' AND len(cloze) > 0")
def dump_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories of the pages of an XML dump of bz2 files."""
    from inkweir.functions import text as tx

    folder = scratch(spark)
    wikitext = F.concat(F.array_join(F.transform(F.coalesce("headings", F.array().cast("array<string>")), lambda h: F.concat(F.lit("[[Category:"), h, F.lit("]]"))), " "), F.lit(" "), F.get("cloze", F.lit(0)))
    page = F.concat(F.lit("<page><title>"), _xml(F.col("page_title")), F.lit("</title><id>"), F.col("inst_no").cast("string"), F.lit("</id><revision><id>1</id><text xml:space='preserve'>"), _xml(wikitext), F.lit("</text></revision></page>"))
    pages = table(spark, sf_dir, "instances").where("size(cloze) > 0").select(page.alias("value")).where("value is not null")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["<mediawiki>"]})
        yield from batches
        yield pd.DataFrame({"value": ["</mediawiki>"]})

    pages.mapInPandas(whole, "value string").write.option("compression", "bzip2").text(folder)
    return files.read_dump(spark, folder).select("page_id", F.array_join(tx.categories(F.col("wikitext")), "|").alias("categories"))


@registry.query("dump_index_pairs", sql="SELECT o AS start_at, lead(o) OVER (ORDER BY o) AS end_at FROM (SELECT DISTINCT CAST(floor(ref_no / 100) AS BIGINT) * 1000 + 597 AS o FROM refs)")
def dump_index_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of a dump, from its index of a hundred pages a member: where each begins and ends."""
    folder = scratch(spark)
    line = F.concat_ws(":", (F.floor(F.col("ref_no") / 100) * 1000 + 597).cast("string"), F.col("ref_no").cast("string"), F.coalesce("title", F.lit("")))
    table(spark, sf_dir, "refs").select(F.regexp_replace(line, r"[\r\n]", " ").alias("value")).write.option("compression", "bzip2").text(folder)
    return crawl.next_offsets(files.read_dump_index(spark, folder)).select(F.col("start").alias("start_at"), F.col("end").alias("end_at"))


@registry.query(
    "capture_locations",
    sql="""WITH w AS (SELECT DISTINCT canonical_url FROM refs WHERE canonical_url IS NOT NULL), x AS (SELECT canonical_url, strftime(fetched_at, '%Y%m%d%H%M%S') AS t, doc_id, n_chars FROM documents WHERE n_chars > 0 AND canonical_url IN (SELECT canonical_url FROM w)),
    r AS (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY t, doc_id) AS n FROM x) SELECT canonical_url, 'crawl-' || doc_id % 7 || '.warc.gz' AS filename, n_chars AS length, doc_id * 100000 AS byte_offset FROM r WHERE n = 1""",
)
def capture_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the first good capture of each cited URL lies, from a capture index."""
    folder = scratch(spark)
    entry = F.to_json(F.struct(F.when(F.col("n_chars") > 0, "200").otherwise("404").alias("status"), F.concat(F.lit("crawl-"), (F.col("doc_id") % 7).cast("string"), F.lit(".warc.gz")).alias("filename"), F.coalesce("n_chars", F.lit(0)).cast("string").alias("length"), (F.col("doc_id") * 100000).cast("string").alias("offset")))
    lines = table(spark, sf_dir, "documents").where("canonical_url is not null").select(F.concat_ws(" ", "canonical_url", F.date_format("fetched_at", "yyyyMMddHHmmss"), entry).alias("value"))
    lines.write.option("compression", "gzip").text(folder)
    keys = table(spark, sf_dir, "refs").where("canonical_url is not null").select("canonical_url")
    found = crawl.first_match(files.read_cdx(spark, folder, keys), keys, ["canonical_url"], ["timestamp", "offset"])
    return found.select("canonical_url", "filename", "length", F.col("offset").alias("byte_offset"))


@registry.query("annotation_table", sql="SELECT CAST(inst_no AS VARCHAR) AS id, page_id, cloze[1] AS sentence, CASE inst_no % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE -1 END AS label FROM instances")
def annotation_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated rows, from a CSV that embeds them as JSON."""
    folder = scratch(spark)
    row = F.to_json(F.struct(F.col("inst_no").cast("string").alias("id"), "page_id", F.get("cloze", F.lit(0)).alias("sentence")))
    answer = F.when(F.col("inst_no") % 3 == 0, "Yes").when(F.col("inst_no") % 3 == 1, "No").otherwise("Unclear")
    files.write_annotation_tasks(table(spark, sf_dir, "instances").select(row.alias("Input.json"), answer.alias("Answer.category.label")), folder)
    return files.read_annotations(spark, folder).select("id", "page_id", "sentence", "label")


@registry.query("store_lookup", sql="SELECT CAST(p.page_id AS VARCHAR) AS key, nullif(d.title, '') AS data FROM (SELECT DISTINCT page_id FROM refs WHERE page_id IS NOT NULL) p LEFT JOIN documents d ON d.doc_id = p.page_id")
def store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of a key store for many keys; unknown and failed ones are null."""
    folder = scratch(spark)
    files.write_store(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), F.col("title").alias("data")), folder)
    keys = table(spark, sf_dir, "refs").where("page_id is not null").select(F.col("page_id").cast("string").alias("key"))
    return files.read_store(spark, folder, keys)


@registry.query("word_frequency_table", sql=f"WITH {core._TOK}, {core._STATS}, f AS (SELECT word, count(DISTINCT doc_id) AS df FROM tok GROUP BY word) SELECT word, df, n_documents, round(avg_length, 6) AS avg_length FROM f, st")
def word_frequency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document frequencies and corpus statistics, written and read back."""
    folder = scratch(spark)
    bodies = core._bodies(spark, sf_dir)
    files.write_word_frequencies(ranking.document_frequency(bodies), ranking.corpus_stats(bodies), folder)
    frequency, stats = files.read_word_frequencies(spark, folder)
    return frequency.crossJoin(F.broadcast(stats.limit(1))).select("word", "df", "n_documents", F.round("avg_length", 6).alias("avg_length"))


# ---------------------------------------------------------------- articles

_TRIM = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
_ARTICLE_SQL = rf"""
a AS (SELECT inst_no, page_title, coalesce(headings, []) AS headings, array_to_string(context, ' ') AS lead, coalesce(cloze[1], '') AS c1, coalesce(array_to_string(cloze[2:], ' '), '') AS rest, documents FROM instances WHERE len(documents) > 0),
r0 AS (SELECT inst_no, unnest(documents) AS x, unnest(range(1, len(documents) + 1)) AS reference_id FROM a),
r AS (SELECT inst_no, CAST(reference_id AS INT) AS reference_id, 'cite web' AS type, nullif({_TRIM.format("x.title")}, '') AS title, nullif({_TRIM.format("x.url")}, '') AS url FROM r0),
b AS (SELECT inst_no, headings, {_TRIM.format("lead")} AS lead, {_TRIM.format("c1 || ' ' || rest")} AS body, length(c1) AS c_at, length(lead) AS lead_at, len(documents) AS nd FROM a)
"""


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered articles made of the instances: the context as lead with a citation of the first document,
    the cited sentence and what follows under their last heading, all documents cited behind the sentence,
    and a list of references with their template data."""
    none = F.array().cast("array<string>")
    attribute = lambda c: F.replace(_xml(c), F.lit("'"), F.lit("&#39;"))
    wt = lambda c: F.when(c.isNotNull(), F.struct(c.alias("wt")))
    data = lambda d: F.to_json(F.struct(F.array(F.struct(F.struct(F.struct(F.lit(" Cite Web ").alias("wt")).alias("target"), F.struct(wt(d["url"]).alias("url"), wt(d["title"]).alias("title"), wt(d["date_raw"]).alias("date")).alias("params")).alias("template"))).alias("parts")))
    item = lambda d: F.concat(F.lit("<li><span class=\"mw-reference-text\"><span data-mw='"), attribute(data(d)), F.lit("'></span></span></li>"))
    mark = lambda i: F.concat(F.lit("<sup>["), i.cast("string"), F.lit("]</sup>"))
    rows = table(spark, sf_dir, "instances").where("size(documents) > 0")
    level = F.least(F.size(F.coalesce("headings", none)) + 1, F.lit(6)).cast("string")
    heading = F.when(F.size(F.coalesce("headings", none)) > 0, F.concat(F.lit("<h"), level, F.lit(">"), _xml(F.try_element_at("headings", F.lit(-1))), F.lit("</h"), level, F.lit(">"))).otherwise("")
    rest = F.array_join(F.slice(F.coalesce("cloze", none), F.lit(2), F.greatest(F.size(F.coalesce("cloze", none)) - 1, F.lit(0))), " ")
    body = F.concat(
        F.lit("<html><body><p>"), _xml(F.array_join(F.coalesce("context", none), " ")), F.lit("<sup>[1]</sup></p><!-- cut -->"), heading, F.lit("<p>"), _xml(F.coalesce(F.get("cloze", F.lit(0)), F.lit(""))),
        F.array_join(F.transform("documents", lambda d, i: mark(i + 1)), ""), F.lit(" "), _xml(rest), F.lit("</p><ol class=\"mw-references\">"), F.array_join(F.transform("documents", item), ""), F.lit("</ol></body></html>"),
    )
    return rows.select(F.col("page_title").alias("title"), F.col("inst_no").alias("page_id"), body.alias("html"))


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, parsed, written as JSON lines and read back with numbered references."""
    folder = scratch(spark)
    files.write_jsonl(markup.parse_articles(_pages(spark, sf_dir)), folder, "bzip2")
    return files.read_articles(spark, folder)


@registry.query(
    "article_paragraphs",
    sql=f"WITH {_ARTICLE_SQL}, p AS (SELECT inst_no, 0 AS place, '' AS heading, lead AS text FROM b WHERE lead <> '' UNION ALL SELECT inst_no, CASE WHEN len(headings) > 0 THEN 1 ELSE 0 END, CASE WHEN len(headings) > 0 THEN {_TRIM.format('headings[-1]')} ELSE '' END, body FROM b WHERE body <> '') SELECT inst_no AS page_id, heading, text FROM p",
)
def article_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of parsed articles with the deepest heading above them."""
    told = articles.article_paragraphs(_articles(spark, sf_dir))
    return told.select("page_id", F.coalesce(F.try_element_at(F.filter("headings", lambda h: h != ""), F.lit(-1)), F.lit("")).alias("heading"), "text")


@registry.query("article_references", sql=f"WITH {_ARTICLE_SQL} SELECT inst_no AS page_id, reference_id, type, title, url FROM r")
def article_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of parsed articles."""
    return articles.article_references(_articles(spark, sf_dir)).drop("date")


@registry.query(
    "article_citations",
    sql=f"WITH {_ARTICLE_SQL} SELECT inst_no AS page_id, 1 AS reference_id, CAST(lead_at AS INT) AS char_offset FROM b WHERE lead <> '' UNION ALL SELECT inst_no, CAST(unnest(range(1, nd + 1)) AS INT), CAST(c_at AS INT) FROM b WHERE body <> ''",
)
def article_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of parsed articles with their offsets in the paragraph's text."""
    return articles.article_citations(_articles(spark, sf_dir)).select("page_id", "reference_id", "char_offset")


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs of references with a clean type: those taken as found."""
    return table(spark, sf_dir, "refs").where("url is not null").select(F.trim("url").alias("url"))


@registry.query("articles_resolvable", sql=f"WITH {_ARTICLE_SQL} SELECT DISTINCT inst_no AS page_id FROM r WHERE url IN (SELECT trim(url) FROM refs WHERE url IS NOT NULL)")
def articles_resolvable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles with at least one reference whose URL was found."""
    return articles.resolvable(_articles(spark, sf_dir), _known(spark, sf_dir)).select("page_id")


@registry.query(
    "articles_rendered",
    sql=f"""WITH {_ARTICLE_SQL}, k AS (SELECT DISTINCT trim(url) AS url FROM refs WHERE url IS NOT NULL), m AS (SELECT inst_no, reference_id, CASE WHEN url IN (SELECT url FROM k) THEN '<a href="' || reference_id || '.json">[' || reference_id || ']</a>' ELSE '[' || reference_id || ']' END AS mark, coalesce(url IN (SELECT url FROM k), false) AS linked FROM r),
    g AS (SELECT inst_no, list(mark ORDER BY reference_id) AS marks, max(CASE WHEN reference_id = 1 THEN mark END) AS one, coalesce(string_agg(CASE WHEN linked AND (reference_id = 1 OR body <> '') AND (reference_id > 1 OR lead <> '' OR body <> '') THEN reference_id::VARCHAR END, ',' ORDER BY reference_id), '') AS saved FROM m JOIN b USING (inst_no) GROUP BY inst_no)
    SELECT inst_no AS page_id, concat_ws(chr(10), CASE WHEN lead <> '' THEN '<p>' || lead[1:lead_at] || one || lead[lead_at + 1:] || '</p>' END, CASE WHEN len(headings) > 0 AND body <> '' THEN '<h1>' || {_TRIM.format('headings[-1]')} || '</h1>' END, CASE WHEN body <> '' THEN '<p>' || list_reduce(list_prepend(body, marks), lambda x, y: x[1:c_at] || y || x[c_at + 1:]) || '</p>' END) AS html, saved FROM b JOIN g USING (inst_no)""",
)
def articles_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as HTML again, citations linked where their reference was found."""
    return articles.rendered(_articles(spark, sf_dir), _known(spark, sf_dir)).withColumn("saved", F.array_join(F.col("saved").cast("array<string>"), ","))


# ---------------------------------------------------------------- captures


@registry.query("capture_pages", sql="SELECT CAST(html_id AS VARCHAR) AS canonical_url, md5(regexp_replace(html, '[\\r\\n]+$', '')) AS page_md5 FROM ref_html WHERE html IS NOT NULL")
def capture_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as capture files and read back by byte ranges."""
    folder = scratch(spark)
    pages = table(spark, sf_dir, "ref_html").select(F.col("html_id").cast("string").alias("canonical_url"), "html")
    locations = stored(ranges.write_captures(pages, folder))
    return ranges.read_captures(locations, folder + "/").select("canonical_url", F.md5(F.encode("html", "UTF-8")).alias("page_md5"))


@registry.query("capture_success", sql="SELECT count(*) AS n_total, count(html) AS n_found, round(100.0::DOUBLE * count(html) / count(*), 2) AS successful FROM (SELECT html FROM ref_html UNION ALL SELECT NULL FROM sites)")
def capture_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pages asked for were found; the sites' names stand for places where there is none."""
    folder = scratch(spark)
    pages = table(spark, sf_dir, "ref_html").select(F.col("html_id").cast("string").alias("canonical_url"), F.coalesce("html", F.lit("")).alias("html"))
    locations = stored(ranges.write_captures(pages, folder))
    nowhere = table(spark, sf_dir, "sites").select(F.col("source").alias("canonical_url"), F.lit("nowhere.warc.gz").alias("filename"), F.lit(10).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("offset"))
    return ranges.capture_stats(ranges.read_captures(locations.unionByName(nowhere), folder + "/")).drop("qps")


# ---------------------------------------------------------------- streams


@registry.query("stream_english_instances", sql=core.registry.oracles["english_instances"])
def stream_english_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances that keep an English document, from a stream of JSON lines."""
    cited = core._cited(spark, sf_dir).join(core._latest(spark, sf_dir), "k").join(table(spark, sf_dir, "documents").select("doc_id", "paragraphs"), "doc_id")
    nested = cited.groupBy(F.col("inst_no").cast("string").alias("id")).agg(F.collect_list(F.struct(F.col("k").alias("canonical_url"), "paragraphs")).alias("documents"))
    source, target = scratch(spark), scratch(spark)
    files.write_jsonl(nested, source)
    stream = filters.keep_english(filters.stream_jsonl(spark, source, schemas.INSTANCES), core._profiles(spark, sf_dir))
    filters.run_once(stream.select(F.col("id").cast("bigint").alias("inst_no"), F.size("documents").cast("bigint").alias("n_english")), target, scratch(spark))
    return spark.read.schema("inst_no bigint, n_english bigint").parquet(target)


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of captures (canonical_url, site, fetched_at), from JSON lines."""
    source = scratch(spark)
    rows = table(spark, sf_dir, "documents").where("canonical_url is not null and fetched_at is not null").select("canonical_url", core.site_of(F.col("canonical_url")).alias("site"), F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("fetched_at"))
    files.write_jsonl(rows, source)
    schema = T.StructType([T.StructField("canonical_url", T.StringType()), T.StructField("site", T.StringType()), T.StructField("fetched_at", T.TimestampType())])
    return filters.stream_jsonl(spark, source, schema, files_per_trigger=1_000_000)


@registry.query("stream_first_captures", sql="SELECT DISTINCT canonical_url FROM documents WHERE canonical_url IS NOT NULL AND fetched_at IS NOT NULL")
def stream_first_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each URL once, from a stream of captures."""
    target = scratch(spark)
    filters.run_once(filters.first_captures(_captures(spark, sf_dir)).select("canonical_url"), target, scratch(spark))
    return spark.read.schema("canonical_url string").parquet(target)


@registry.query(
    "stream_windows",
    sql=f"WITH d AS (SELECT {core._SITE_SQL} AS site, fetched_at FROM documents WHERE canonical_url IS NOT NULL AND fetched_at IS NOT NULL) SELECT strftime(date_trunc('hour', fetched_at), '%Y-%m-%d %H:%M:%S') AS window_start, site, count(*) AS n FROM d WHERE date_trunc('hour', fetched_at) + INTERVAL 1 HOUR <= (SELECT max(date_trunc('millisecond', fetched_at)) - INTERVAL 2 HOUR FROM d) GROUP BY 1, 2",
)
def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures of each site and hour, from a stream; the hours that the watermark has passed."""
    target = scratch(spark)
    counted = filters.captures_per_window(_captures(spark, sf_dir))
    filters.run_once(counted.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "site", "n"), target, scratch(spark))
    return spark.read.schema("window_start string, site string, n bigint").parquet(target)
