"""Queries on text, ranking, crawling, cloze generation, quality and splits, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkweir.functions import text as tx
from inkweir.functions import urls
from inkweir.functions.language import Profiles, language_of, train_profiles
from inkweir.operators import cloze, crawl, graph, quality, ranking, validation
from inkweir.operators.ordered import runs
from inkweir.operators.timestamps import site_of
from inkweir.plans.registry import Registry
from inkweir.session import cut, table

registry = Registry()

# ---------------------------------------------------------------- shared pieces

_TIDY = r"regexp_replace(regexp_replace(regexp_replace(lower({0}), '#.*$', ''), '\?utm_.*$', ''), '/+$', '')"
_SITE_SQL = "regexp_extract(canonical_url, '^([^,)/]+),([^,)/:]+)', 2) || '.' || regexp_extract(canonical_url, '^([^,)/]+),([^,)/:]+)', 1)"
_D = "d AS (SELECT doc_id, lang, coalesce(array_to_string(flatten(paragraphs), ' '), '') AS body FROM documents)"
_TOK = _D + r", tok AS (SELECT doc_id, unnest(regexp_extract_all(lower(body), '[\p{L}\p{N}]+')) AS word FROM d)"
_STATS = "st AS (SELECT count(*) AS n_documents, sum(len(regexp_extract_all(lower(body), '[\\p{L}\\p{N}]+')))::DOUBLE / count(*) AS avg_length FROM d)"
_LATEST = f"latest AS (SELECT {_TIDY.format('canonical_url')} AS k, arg_max(doc_id, (ingested_at, doc_id)) AS doc_id FROM documents WHERE canonical_url IS NOT NULL AND len(paragraphs) > 0 GROUP BY 1)"
_CITED = (
    f"c0 AS (SELECT inst_no, page_id, split_name, unnest(documents) AS x, unnest(range(len(documents))) AS doc_index FROM instances WHERE len(documents) > 0), "
    f"cited AS (SELECT inst_no, page_id, split_name, CAST(doc_index AS INT) AS doc_index, {_TIDY.format('coalesce(x.canonical_url, x.url)')} AS k FROM c0 WHERE coalesce(x.canonical_url, x.url) IS NOT NULL)"
)
_BM25 = (
    f"WITH {_TOK}, {_STATS}, {_LATEST}, {_CITED}, "
    r"df AS (SELECT word, count(DISTINCT doc_id) AS df FROM tok GROUP BY word), tf AS (SELECT doc_id, word, count(*) AS tf FROM tok GROUP BY 1, 2), dl AS (SELECT doc_id, count(*) AS dl FROM tok GROUP BY 1), "
    r"pairs AS (SELECT DISTINCT inst_no, doc_id FROM cited JOIN latest USING (k)), "
    r"q AS (SELECT DISTINCT p.inst_no, p.doc_id, w.word FROM pairs p JOIN (SELECT inst_no, unnest(regexp_extract_all(lower(cloze[1]), '[\p{L}\p{N}]+')) AS word FROM instances) w USING (inst_no)), "
    "s AS (SELECT inst_no, doc_id, sum(ln((n_documents + df.df + 0.5::DOUBLE) / (df.df + 0.5::DOUBLE)) * (tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / avg_length)))) AS score "
    "FROM q JOIN tf USING (doc_id, word) JOIN df USING (word) JOIN dl USING (doc_id), st GROUP BY 1, 2), "
    "scores AS (SELECT inst_no, doc_id, round(coalesce(score, 0), 6) AS score FROM pairs LEFT JOIN s USING (inst_no, doc_id))"
)


def _bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.coalesce(tx.flat_text(F.col("paragraphs")), F.lit("")).alias("text"))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per tidy key: the one ingested last."""
    docs = table(spark, sf_dir, "documents").where("canonical_url is not null and size(paragraphs) > 0")
    return docs.select(urls.tidy_key(F.col("canonical_url")).alias("k"), "doc_id", "ingested_at").groupBy("k").agg(F.max_by("doc_id", F.struct("ingested_at", "doc_id")).alias("doc_id"))


def _cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of documents by the tidy key of their canonical URL, or of their URL where there is none."""
    each = table(spark, sf_dir, "instances").select("inst_no", "page_id", "split_name", F.posexplode("documents").alias("doc_index", "x"))
    key = F.coalesce("x.canonical_url", "x.url")
    return each.where(key.isNotNull()).select("inst_no", "page_id", "split_name", "doc_index", urls.tidy_key(key).alias("k"))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    bodies = _bodies(spark, sf_dir)
    pairs = _cited(spark, sf_dir).join(_latest(spark, sf_dir), "k").select("inst_no", "doc_id").distinct()
    queries = table(spark, sf_dir, "instances").select("inst_no", F.get("cloze", F.lit(0)).alias("query"))
    told = pairs.join(queries, "inst_no").select(F.col("inst_no").alias("query_id"), "doc_id", "query")
    scored = ranking.bm25(told, bodies, ranking.document_frequency(bodies), ranking.corpus_stats(bodies))
    return scored.select(F.col("query_id").alias("inst_no"), "doc_id", F.round("score", 6).alias("score"))


# ---------------------------------------------------------------- text


@registry.query("token_count", sql=r"SELECT doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) END AS INT) AS n_tokens FROM documents")
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """White-space tokens of each text."""
    return table(spark, sf_dir, "documents").select("doc_id", tx.token_count(F.col("text")).alias("n_tokens"))


@registry.query(
    "paragraph_sentence_count",
    sql=r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10) || chr(10))) AS para FROM documents WHERE text IS NOT NULL),
    q AS (SELECT doc_id, len(list_filter(list_transform(string_split(regexp_replace(para, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda s: trim(s)), lambda s: s <> '')) AS n FROM p WHERE trim(para) <> '')
    SELECT doc_id, count(*) AS n_paragraphs, CAST(sum(n) AS BIGINT) AS n_sentences FROM q GROUP BY doc_id""",
)
def paragraph_sentence_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs and sentences of each text, by the regex segmenter."""
    each = table(spark, sf_dir, "documents").select("doc_id", F.explode(tx.split_paragraphs(F.col("text"))).alias("p"))
    return each.groupBy("doc_id").agg(F.count("*").alias("n_paragraphs"), F.sum(F.size(tx.split_sentences(F.col("p")))).alias("n_sentences"))


@registry.query("document_frequency", sql=f"WITH {_TOK} SELECT word, count(DISTINCT doc_id) AS df FROM tok GROUP BY word")
def document_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold each word, each document once."""
    return ranking.document_frequency(_bodies(spark, sf_dir))


@registry.query(
    "document_frequency_cited",
    sql=f"WITH {_TOK}, {_LATEST}, {_CITED}, w AS (SELECT DISTINCT doc_id, word FROM tok) SELECT word, count(*) AS df FROM cited JOIN latest USING (k) JOIN w USING (doc_id) GROUP BY word",
)
def document_frequency_cited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a document counting once for each citation."""
    n = _cited(spark, sf_dir).join(_latest(spark, sf_dir), "k").groupBy("doc_id").agg(F.count("*").alias("n"))
    bodies = _bodies(spark, sf_dir).join(n, "doc_id")
    return bodies.select("n", F.explode(F.array_distinct(tx.words(F.col("text")))).alias("word")).groupBy("word").agg(F.sum("n").alias("df"))


@registry.query("corpus_stats", sql=f"WITH {_D}, {_STATS} SELECT n_documents, round(avg_length, 6) AS avg_length FROM st")
def corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of documents and their mean length in words."""
    return ranking.corpus_stats(_bodies(spark, sf_dir)).withColumn("avg_length", F.round("avg_length", 6))


@registry.query("term_frequency", sql=f"WITH {_TOK} SELECT doc_id, word, count(*) AS tf FROM tok GROUP BY 1, 2")
def term_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of each word in each document."""
    return ranking.term_frequency(_bodies(spark, sf_dir), "doc_id")


_CODES = ["de", "en", "es", "fr", "nl", "pt"]
_LANGUAGE = (
    _D + r""", lo AS (SELECT doc_id, lower(lang) AS language, lower(body) AS t FROM d), dg AS (SELECT doc_id, language, g, count(*) AS c FROM (SELECT doc_id, language, unnest(list_transform(range(1, length(t) - 1), lambda i: t[i:i + 2])) AS g FROM lo WHERE length(t) > 2) GROUP BY 1, 2, 3),
    gc AS (SELECT language, g, CAST(sum(c) AS BIGINT) AS n FROM dg WHERE language IN ('de', 'en', 'es', 'fr', 'nl', 'pt') GROUP BY 1, 2), gt AS (SELECT language, sum(n) AS total FROM gc GROUP BY 1),
    top AS (SELECT language, g, n FROM (SELECT *, row_number() OVER (PARTITION BY language ORDER BY n DESC, g) AS r FROM gc) WHERE r <= 400), pg AS (SELECT DISTINCT g FROM top),
    prof AS (SELECT pg.g, gt.language, CAST(round(100 * ln(coalesce(n, 0.5)::DOUBLE / total)) AS BIGINT) AS s FROM pg CROSS JOIN gt LEFT JOIN top ON top.g = pg.g AND top.language = gt.language),
    ds AS (SELECT doc_id, prof.language, sum(c * s) AS s FROM dg JOIN prof USING (g) GROUP BY 1, 2), said AS (SELECT doc_id, language FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, language) AS r FROM ds) WHERE r = 1)"""
)


def _profiles(spark: SparkSession, sf_dir: str) -> Profiles:
    """Trigram profiles of the six languages, from the documents that are labelled by a plain code."""
    return train_profiles(_bodies(spark, sf_dir).select("text", F.lower("lang").alias("language")).where(F.col("language").isin(_CODES)))


@registry.query("english_documents", sql=f"WITH {_LANGUAGE} SELECT doc_id, language FROM documents LEFT JOIN said USING (doc_id)")
def english_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document by trigram profiles; null without text."""
    return _bodies(spark, sf_dir).select("doc_id", language_of(F.col("text"), _profiles(spark, sf_dir)).alias("language"))


@registry.query("english_instances", sql=f"WITH {_LANGUAGE}, {_LATEST}, {_CITED} SELECT inst_no, count(*) AS n_english FROM cited JOIN latest USING (k) JOIN said USING (doc_id) WHERE language = 'en' GROUP BY inst_no")
def english_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances that keep at least one English document, with how many they keep."""
    english = english_documents(spark, sf_dir).where("language = 'en'")
    return _cited(spark, sf_dir).join(_latest(spark, sf_dir), "k").join(english, "doc_id").groupBy("inst_no").agg(F.count("*").alias("n_english"))


@registry.query(
    "sentence_spans",
    sql="""WITH e AS (SELECT inst_no, unnest(cloze) AS s, unnest(range(len(cloze))) AS no FROM instances WHERE len(cloze) > 0)
    SELECT inst_no, CAST(no AS INT) AS sentence_no, CAST(coalesce(sum(length(s) + 1) OVER w, 0) AS INT) AS start_at, CAST(coalesce(sum(length(s) + 1) OVER w, 0) + length(s) AS INT) AS end_at FROM e
    WINDOW w AS (PARTITION BY inst_no ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets of the cited sentences in their joined text."""
    spans = table(spark, sf_dir, "instances").select("inst_no", F.posexplode(tx.sentence_spans(F.col("cloze"))).alias("sentence_no", "s"))
    return spans.select("inst_no", "sentence_no", F.col("s.start").alias("start_at"), F.col("s.end").alias("end_at"))


@registry.query(
    "categories_extract",
    sql=r"""WITH w AS (SELECT inst_no, array_to_string(list_transform(headings, lambda h: '[[Category: ' || h || '|x]] text [[category:no]]'), ' ') AS wikitext FROM instances)
    SELECT inst_no, trim(c) AS category FROM (SELECT inst_no, unnest(regexp_extract_all(wikitext, '\[\[Category:(.+?)\]\]', 1)) AS c FROM w)""",
)
def categories_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories in wikitext made of each instance's headings."""
    wikitext = F.array_join(F.transform("headings", lambda h: F.concat(F.lit("[[Category: "), h, F.lit("|x]] text [[category:no]]"))), " ")
    return table(spark, sf_dir, "instances").select("inst_no", F.explode(tx.categories(wikitext)).alias("category"))


@registry.query("headings_html", sql="""SELECT inst_no, CASE WHEN len(k) > 0 THEN '<h' || len(k) || '>' || k[len(k)] || '</h' || len(k) || '>' ELSE '' END AS heading, concat_ws(' ', page_title, nullif(array_to_string(headings, ' '), '')) AS topic
    FROM (SELECT inst_no, page_title, headings, coalesce(list_filter(headings, lambda h: h <> ''), []) AS k FROM instances)""")
def headings_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings as an HTML heading, and the topic line."""
    headings = F.coalesce("headings", F.array().cast("array<string>"))
    return table(spark, sf_dir, "instances").select("inst_no", tx.heading_html(headings).alias("heading"), tx.topic(F.col("page_title"), F.col("headings")).alias("topic"))


@registry.query("citation_reinsert", sql="""SELECT inst_no, cloze[1][1:10] || '[1]' || cloze[1][11:15] || '[2][3]' || cloze[1][16:] AS text FROM instances""")
def citation_reinsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations spliced into the first cited sentence at given offsets."""
    marks = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(o).alias("offset")) for i, o in ((3, 15), (1, 10), (2, 15))))
    first = F.get("cloze", F.lit(0))
    return table(spark, sf_dir, "instances").select("inst_no", tx.splice_citations(first, marks).alias("text"))


@registry.query("hit_rows", sql="""SELECT inst_no, array_to_string(context, ' ') AS context, replace(coalesce(cloze[1], ''), chr(13), chr(10)) AS sentence FROM instances""")
def hit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of an annotation task."""
    return table(spark, sf_dir, "instances").select("inst_no", F.array_join("context", " ").alias("context"), F.translate(F.coalesce(F.get("cloze", F.lit(0)), F.lit("")), "\r", "\n").alias("sentence"))


@registry.query("hit_documents", sql="""SELECT doc_id, array_to_string(list_transform(paragraphs, lambda p: '<p>' || array_to_string(p, ' ') || '</p>'), ' ') AS html FROM documents WHERE len(paragraphs) > 0""")
def hit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as paragraphs of an annotation task."""
    html = F.array_join(F.transform("paragraphs", lambda p: F.concat(F.lit("<p>"), F.array_join(p, " "), F.lit("</p>"))), " ")
    return table(spark, sf_dir, "documents").where(F.size("paragraphs") > 0).select("doc_id", html.alias("html"))


_SPELT = "strip_accents(title)"
for _a, _b in (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("ø", "o"), ("Ø", "O"), ("œ", "oe"), ("Œ", "OE"), ("«", "<<"), ("»", ">>"), ("·", "*"), ("“", '"'), ("”", '"'), ("„", '"'), ("’", "''"), ("‘", "''"), ("–", "-"), ("—", "-"), ("…", "...")):
    _SPELT = f"replace({_SPELT}, '{_a}', '{_b}')"


@registry.query("transliterated", sql=f"SELECT doc_id, {_SPELT} AS title FROM documents WHERE title IS NOT NULL")
def transliterated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles in plain letters."""
    return table(spark, sf_dir, "documents").where("title is not null").select("doc_id", tx.transliterate(F.col("title")).alias("title"))


@registry.query("label_decode", sql="SELECT ref_no, CASE WHEN a = 'Yes' THEN 1 WHEN a = 'No' THEN 0 ELSE -1 END AS label FROM (SELECT ref_no, CASE ref_no % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Unclear' END AS a FROM refs)")
def label_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotators' answers as labels."""
    answer = F.when(F.col("ref_no") % 4 == 0, "Yes").when(F.col("ref_no") % 4 == 1, "No").when(F.col("ref_no") % 4 == 2, "Unclear")
    return table(spark, sf_dir, "refs").select("ref_no", tx.decode_label(answer).alias("label"))


# ---------------------------------------------------------------- URLs and captures


@registry.query(
    "url_unwrap_scrapable",
    sql=r"""WITH u AS (SELECT ref_no, CASE WHEN starts_with(url, 'https://web.archive.org/web') THEN url[44:] ELSE url END AS url FROM refs)
    SELECT ref_no, url, coalesce(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^www\.', '') NOT IN ('', 'books.google.com', 'books.google.co.in', 'youtube.com')
    AND regexp_extract(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '(\.[^./]*)$', 1) NOT IN ('.pdf', '.jpeg', '.jpg', '.png', '.mp3', '.mp4', '.doc', '.docx', '.ppt', '.pptx', '.xls', '.xlsx'), false) AS scrapable FROM u""",
)
def url_unwrap_scrapable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References' URLs without archive wrappers, and whether they can be scraped."""
    bare = table(spark, sf_dir, "refs").select("ref_no", urls.unwrap_archive(F.col("url")).alias("url"))
    return bare.withColumn("scrapable", urls.is_scrapable(F.col("url")))


_KEY = r"""low AS (SELECT ref_no, regexp_replace(regexp_replace(lower(trim(url)), '^[a-z][a-z0-9+.-]*://', ''), '#.*$', '') AS bare FROM refs),
    parts AS (SELECT ref_no, regexp_replace(regexp_replace(regexp_replace(regexp_extract(bare, '^([^/?]*)', 1), '^[^@]*@', ''), ':(80|443)$', ''), '^www\d*\.', '') AS host,
      regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place, regexp_extract(bare, '\?(.*)$', 1) AS query FROM low),
    keyed AS (SELECT ref_no, CASE WHEN host <> '' THEN array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE place WHEN '' THEN '/' ELSE place END
      || CASE WHEN query <> '' THEN '?' || array_to_string(list_sort(string_split(query, '&')), '&') ELSE '' END END AS url_key FROM parts)"""


@registry.query("canonical_url", sql=f"WITH {_KEY} SELECT ref_no, url_key FROM keyed")
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical keys of references' URLs."""
    return table(spark, sf_dir, "refs").select("ref_no", urls.canonical_key(F.col("url")).alias("url_key"))


@registry.query("distinct_urls", sql=f"WITH {_KEY} SELECT DISTINCT url_key FROM keyed WHERE url_key IS NOT NULL")
def distinct_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The different URLs to crawl."""
    return canonical_url(spark, sf_dir).where("url_key is not null").select("url_key").distinct()


@registry.query(
    "locations_first_match",
    sql=f"""WITH w AS (SELECT DISTINCT {_TIDY.format('canonical_url')} AS k FROM refs WHERE canonical_url IS NOT NULL),
    x AS (SELECT doc_id, {_TIDY.format('canonical_url')} AS k, fetched_at, CASE WHEN n_chars > 0 THEN 200 ELSE 404 END AS status FROM documents),
    r AS (SELECT k, doc_id, row_number() OVER (PARTITION BY k ORDER BY fetched_at, doc_id) AS n FROM x WHERE status = 200 AND k IN (SELECT k FROM w)) SELECT k, doc_id FROM r WHERE n = 1""",
)
def locations_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first good capture of each cited URL."""
    index = table(spark, sf_dir, "documents").select("doc_id", urls.tidy_key(F.col("canonical_url")).alias("k"), "fetched_at", F.when(F.col("n_chars") > 0, 200).otherwise(404).alias("status"))
    keys = table(spark, sf_dir, "refs").where("canonical_url is not null").select(urls.tidy_key(F.col("canonical_url")).alias("k"))
    return crawl.first_match(index, keys, ["k"], ["fetched_at", "doc_id"]).select("k", "doc_id")


@registry.query("last_crawl_wins", sql="SELECT canonical_url, arg_max(doc_id, (ingested_at, doc_id)) AS doc_id FROM documents GROUP BY canonical_url")
def last_crawl_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The capture of each URL that came last."""
    return crawl.last_wins(table(spark, sf_dir, "documents").select("canonical_url", "doc_id", "ingested_at"), "canonical_url", ["ingested_at", "doc_id"]).drop("ingested_at")


@registry.query("chunk_ids", sql="SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY canonical_url, doc_id) - 1) / 50) AS BIGINT) AS chunk FROM documents")
def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of 50 captures in the order of their keys."""
    return crawl.chunk_ids(table(spark, sf_dir, "documents").select("doc_id", "canonical_url"), ["canonical_url", "doc_id"], 50).select("doc_id", "chunk")


@registry.query(
    "byte_ranges",
    sql="SELECT html_id, 'bytes=' || (e - n) || '-' || (e - 1) AS byte_range FROM (SELECT html_id, strlen(html) AS n, CAST(sum(strlen(html)) OVER (ORDER BY html_id) AS BIGINT) AS e FROM ref_html)",
)
def byte_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of each page, in bytes, in a file of all pages."""
    from inkweir.operators.ordered import prefix_sums

    sized = table(spark, sf_dir, "ref_html").select("html_id", F.octet_length("html").cast("bigint").alias("n"))
    return prefix_sums(sized, ["html_id"], upto=F.col("n")).select("html_id", urls.byte_range(F.col("upto") - F.col("n"), F.col("n")).alias("byte_range"))


@registry.query("dump_offset_pairs", sql="SELECT o AS start_at, lead(o) OVER (ORDER BY o) AS end_at FROM (SELECT DISTINCT n_chars AS o FROM documents WHERE n_chars IS NOT NULL)")
def dump_offset_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different offsets with the next one."""
    pairs = crawl.next_offsets(table(spark, sf_dir, "documents").select(F.col("n_chars").alias("start")))
    return pairs.select(F.col("start").alias("start_at"), F.col("end").alias("end_at"))


@registry.query("round_robin_shard", sql="SELECT doc_id % 10 AS shard, count(*) AS n FROM documents GROUP BY 1")
def round_robin_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in each of ten shards."""
    return table(spark, sf_dir, "documents").select(crawl.shard(F.col("doc_id"), 10).alias("shard")).groupBy("shard").agg(F.count("*").alias("n"))


@registry.query("html_title", sql=r"SELECT html_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM ref_html")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of pages."""
    return table(spark, sf_dir, "ref_html").select("html_id", F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1).alias("title"))


@registry.query(
    "reference_precedence",
    sql=r"""SELECT ref_no, nullif(coalesce(url, canonical_url), '') AS url, lower(trim(regexp_replace(ref_type, '\s+', ' ', 'g'))) AS ref_type,
    CAST(coalesce(CASE WHEN regexp_matches(trim(date_raw), '^\d{4}-\d{2}-\d{2}$') THEN try_strptime(trim(date_raw), '%Y-%m-%d') END, CASE WHEN regexp_matches(trim(date_raw), '^\d{1,2} [A-Z][a-z]+ \d{4}$') THEN try_strptime(trim(date_raw), '%d %B %Y') END) AS DATE) AS read_date FROM refs""",
)
def reference_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first URL present (empty counts as present), the type, and the first date format that parses."""
    raw = F.nullif(F.trim("date_raw"), F.lit(""))
    read = F.coalesce(F.try_to_timestamp(F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), raw), F.lit("yyyy-MM-dd")), F.try_to_timestamp(F.when(raw.rlike(r"^\d{1,2} [A-Z][a-z]+ \d{4}$"), raw), F.lit("d MMMM yyyy")))
    kind = F.lower(F.trim(F.regexp_replace("ref_type", r"\s+", " ")))
    return table(spark, sf_dir, "refs").select("ref_no", F.nullif(F.coalesce("url", "canonical_url"), F.lit("")).alias("url"), kind.alias("ref_type"), F.to_date(read).alias("read_date"))


@registry.query(
    "reference_funnel",
    sql=f"""WITH {_LATEST}, h AS (SELECT DISTINCT {_TIDY.format('canonical_url')} AS k FROM ref_html) SELECT count(*) AS n_references, count(url) AS n_with_url,
    count(CASE WHEN starts_with(lower(url), 'http') THEN 1 END) AS n_http, count(CASE WHEN {_TIDY.format('canonical_url')} IN (SELECT k FROM h) THEN 1 END) AS n_with_html, count(CASE WHEN {_TIDY.format('canonical_url')} IN (SELECT k FROM latest) THEN 1 END) AS n_with_text FROM refs""",
)
def reference_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many references have a URL, a page and a text."""
    refs = table(spark, sf_dir, "refs").select("url", urls.tidy_key(F.col("canonical_url")).alias("k"))
    pages = table(spark, sf_dir, "ref_html").select(urls.tidy_key(F.col("canonical_url")).alias("k"), F.lit(1).alias("page")).where("k is not null").distinct()
    texts = _latest(spark, sf_dir).select("k", F.lit(1).alias("has_text"))
    joined = refs.join(pages, "k", "left").join(texts, "k", "left")
    return joined.agg(F.count("*").alias("n_references"), F.count("url").alias("n_with_url"), F.count_if(F.lower("url").startswith("http")).alias("n_http"), F.count("page").alias("n_with_html"), F.count("has_text").alias("n_with_text"))


@registry.query("living_people_semi", sql="SELECT ref_no FROM refs WHERE page_id IN (SELECT page_id FROM instances WHERE list_contains(headings, 'Career'))")
def living_people_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of the pages in a set."""
    chosen = table(spark, sf_dir, "instances").where(F.array_contains("headings", "Career")).select("page_id").distinct()
    return table(spark, sf_dir, "refs").join(chosen, "page_id", "left_semi").select("ref_no")


@registry.query("page_views", sql="SELECT page_id, CAST(sum(view_count) AS BIGINT) AS views FROM (SELECT DISTINCT * FROM page_views) GROUP BY page_id")
def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of each page over all months, repeated rows once."""
    return table(spark, sf_dir, "page_views").distinct().groupBy("page_id").agg(F.sum("view_count").alias("views"))


# ---------------------------------------------------------------- ranking


@registry.query("bm25_scores", sql=_BM25 + " SELECT inst_no, doc_id, score FROM scores")
def bm25_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance of each cited document to the sentence that cites it."""
    return _scores(spark, sf_dir)


@registry.query("bm25_best", sql=_BM25 + " SELECT inst_no, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY inst_no ORDER BY score DESC, doc_id) AS r FROM scores) WHERE r = 1")
def bm25_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most relevant cited document of each instance."""
    best = F.max_by(F.struct("doc_id", "score"), F.struct("score", -F.col("doc_id")))
    return _scores(spark, sf_dir).groupBy("inst_no").agg(best.alias("b")).select("inst_no", "b.*")


@registry.query("bm25_label_corr", sql=_BM25 + " SELECT round(corr(score, CASE split_name WHEN 'train' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS r, count(*) AS n FROM scores JOIN instances USING (inst_no)")
def bm25_label_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of the score with a 0/1 label."""
    label = F.when(F.col("split_name") == "train", 1.0).otherwise(0.0)
    return _scores(spark, sf_dir).join(table(spark, sf_dir, "instances").select("inst_no", "split_name"), "inst_no").agg(F.round(F.corr("score", label), 6).alias("r"), F.count("*").alias("n"))


_CUTS = "cuts AS (SELECT min(score) AS low, max(score) AS high, quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS cuts FROM scores), bucketed AS (SELECT s.*, CAST(len(list_filter(cuts, lambda c: c < score)) AS INT) AS bucket FROM scores s, cuts)"


@registry.query("score_deciles", sql=_BM25 + f", {_CUTS} SELECT round(low, 6) AS low, round(high, 6) AS high, " + ", ".join(f"round(cuts[{i}], 5) AS p{i}0" for i in range(1, 10)) + " FROM cuts")
def score_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact deciles of the scores."""
    return ranking.score_cuts(_scores(spark, sf_dir)).select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), *(F.round(F.col("cuts")[i - 1], 5).alias(f"p{i}0") for i in range(1, 10)))


@registry.query("score_buckets", sql=_BM25 + f", {_CUTS} SELECT bucket, count(*) AS n FROM bucketed GROUP BY bucket")
def score_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs in each bucket between deciles."""
    scores = cut(_scores(spark, sf_dir))
    return ranking.bucket(scores, ranking.score_cuts(scores)).groupBy("bucket").agg(F.count("*").alias("n"))


@registry.query("stratified_sample", sql=_BM25 + f", {_CUTS} SELECT inst_no, doc_id, score, bucket FROM (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY md5('sample|' || inst_no || '|' || doc_id), inst_no, doc_id) AS r FROM bucketed) WHERE r <= 10")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten pairs of each bucket."""
    scores = cut(_scores(spark, sf_dir))
    return ranking.stratified_sample(ranking.bucket(scores, ranking.score_cuts(scores)), 10, "inst_no", "doc_id")


@registry.query(
    "bucket_bounds",
    sql=_BM25 + f", {_CUTS}, edges AS (SELECT list_concat([low], list_concat(cuts, [high])) AS e FROM cuts), i AS (SELECT unnest(range(10)) AS b) SELECT CAST(b AS INT) AS bucket, printf('%d_%.2f_%.2f', b, e[b + 1], e[b + 2]) AS label FROM i, edges",
)
def bucket_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the buckets with their bounds."""
    edges = ranking.score_cuts(_scores(spark, sf_dir)).select(F.concat(F.array("low"), "cuts", F.array("high")).alias("e"))
    each = edges.select("e", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("bucket"))
    return each.select("bucket", F.format_string("%d_%.2f_%.2f", "bucket", F.get("e", F.col("bucket")), F.get("e", F.col("bucket") + 1)).alias("label"))


@registry.query("random_sample", sql=f"WITH {_CITED} SELECT inst_no, doc_index FROM cited ORDER BY md5('sample|' || inst_no || '|' || doc_index), inst_no, doc_index LIMIT 100")
def random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred citations in a repeatable random order."""
    return ranking.random_sample(_cited(spark, sf_dir).select("inst_no", "doc_index"), 100, "inst_no", "doc_index")


# ---------------------------------------------------------------- cloze generation

_PARAS = """paras AS (SELECT inst_no, page_id, page_title, list_concat(coalesce(context, []), coalesce(cloze, [])) AS sentences, len(coalesce(context, [])) AS n_context FROM instances)"""


def _paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs as an article has them: joined sentences, their spans, one citation per document at the
    end of the first cited sentence and one where the next begins."""
    none = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "instances").select("inst_no", "page_id", "page_title", F.coalesce("headings", none).alias("headings"), F.concat(F.coalesce("context", none), F.coalesce("cloze", none)).alias("sentences"), F.size(F.coalesce("context", none)).alias("n_context"), F.col("documents.canonical_url").alias("keys"))
    rows = rows.withColumn("text", F.array_join("sentences", " ")).withColumn("spans", tx.sentence_spans(F.col("sentences")))
    at = F.get(F.col("spans"), F.col("n_context"))["end"]
    cites = F.transform("keys", lambda k, i: F.struct((i + 1).alias("reference_id"), at.alias("offset")))
    return rows.withColumn("citations", cites).drop("sentences", "keys")


@registry.query("offset_groups", sql="SELECT inst_no, CAST(len(array_to_string(list_concat(coalesce(context, []), [cloze[1]]), ' ')) AS INT) AS char_offset, array_to_string(range(1, len(documents) + 1), ',') AS ids FROM instances WHERE len(documents) > 0 AND len(cloze) > 0")
def offset_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations at one offset with their references in order."""
    grouped = _paragraphs(spark, sf_dir).select("inst_no", F.explode(cloze.group_citations(F.col("citations"))).alias("g"))
    return grouped.where("g.offset is not null").select("inst_no", F.col("g.offset").alias("char_offset"), F.array_join(F.col("g.ids").cast("array<string>"), ",").alias("ids"))


_SPANS = _PARAS + """, sp AS (SELECT inst_no, n_context, unnest(sentences) AS s, unnest(range(len(sentences))) AS no FROM paras WHERE len(sentences) > 0),
    spans AS (SELECT *, coalesce(sum(length(s) + 1) OVER w, 0) AS a, coalesce(sum(length(s) + 1) OVER w, 0) + length(s) AS b FROM sp WINDOW w AS (PARTITION BY inst_no ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    cites AS (SELECT s.inst_no, s.b AS o, len(i.documents) AS nd FROM spans s JOIN instances i USING (inst_no) WHERE s.no = s.n_context AND len(i.documents) > 0)"""


@registry.query("cited_sentences", sql=f"WITH {_SPANS} SELECT inst_no, CAST(no AS INT) AS sentence_no, CAST(nd AS INT) AS n_citations FROM spans JOIN cites USING (inst_no) WHERE a <= o AND o <= b")
def cited_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences that hold a citation, spans closed at both ends."""
    return cloze.cited_sentences(_paragraphs(spark, sf_dir)).select("inst_no", "sentence_no", F.size("ids").alias("n_citations"))


def _instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances generated from the paragraphs; their pages stand for one paragraph each."""
    cited = cloze.cited_sentences(_paragraphs(spark, sf_dir)).withColumn("page", F.col("page_id")).withColumn("page_id", F.col("inst_no"))
    refs = _cited(spark, sf_dir).select(F.col("inst_no").alias("page_id"), (F.col("doc_index") + 1).alias("reference_id"), F.col("k").alias("canonical_url"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "paragraphs").join(_latest(spark, sf_dir), "doc_id").select(F.col("k").alias("canonical_url"), "paragraphs")
    return cloze.instances(cited, refs, docs)


_GENERATED = f"WITH {_SPANS}, {_LATEST}, {_CITED}, hit AS (SELECT inst_no, no FROM spans JOIN cites USING (inst_no) WHERE a <= o AND o <= b AND no >= 1), nd AS (SELECT inst_no, count(*) AS n FROM cited JOIN latest USING (k) GROUP BY 1)"


@registry.query(
    "cloze_instances",
    sql=_GENERATED + " SELECT p.inst_no AS page_id, p.page_title, array_to_string(list_transform(p.sentences[1:h.no], lambda s: trim(s)), ' ') AS context, array_to_string(list_transform(p.sentences[h.no + 1:], lambda s: trim(s)), ' ') AS cloze, CAST(n AS INT) AS n_documents FROM hit h JOIN paras p USING (inst_no) JOIN nd USING (inst_no)",
)
def cloze_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated instances: context, cloze and the number of documents found. The flagship."""
    return _instances(spark, sf_dir).select("page_id", "page_title", F.array_join("context", " ").alias("context"), F.array_join("cloze", " ").alias("cloze"), F.size("documents").alias("n_documents"))


@registry.query(
    "cloze_regrouped",
    sql=f"""WITH k AS (SELECT inst_no, page_id, coalesce(array_to_string(context, ' '), '') AS c, coalesce(array_to_string(cloze, ' '), '') AS z, coalesce(documents, []) AS documents FROM instances),
    e AS (SELECT page_id, c, z, unnest(documents) AS x FROM k WHERE len(documents) > 0), n AS (SELECT page_id, c, z, count(*) AS n FROM (SELECT DISTINCT page_id, c, z, x.canonical_url FROM e) GROUP BY 1, 2, 3),
    f AS (SELECT page_id, c, z, min(inst_no) AS inst_no FROM k GROUP BY 1, 2, 3) SELECT f.inst_no, CAST(coalesce(n, 0) AS INT) AS n_documents FROM f LEFT JOIN n ON f.page_id IS NOT DISTINCT FROM n.page_id AND f.c = n.c AND f.z = n.z""",
)
def cloze_regrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances with the same page, context and cloze merged, their documents united."""
    none = F.array().cast("array<string>")
    rows = table(spark, sf_dir, "instances").select("inst_no", "page_id", F.coalesce("context", none).alias("context"), F.coalesce("cloze", none).alias("cloze"), "documents")
    return cloze.regroup(rows, "inst_no").select("inst_no", F.coalesce(F.when(F.size("documents") >= 0, F.size("documents")), F.lit(0)).alias("n_documents"))


@registry.query("cloze_released", sql="SELECT inst_no, array_to_string(context, ' ') AS left_context, cloze[1] AS cloze, array_to_string(cloze[2:], ' ') AS right_context FROM instances WHERE len(cloze) > 0")
def cloze_released(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances in the form of a release."""
    out = cloze.release(table(spark, sf_dir, "instances").where(F.size("cloze") > 0))
    return out.select("inst_no", F.array_join("left_context", " ").alias("left_context"), "cloze", F.array_join("right_context", " ").alias("right_context"))


# ---------------------------------------------------------------- quality

_FEATURES = _BM25 + r""", v AS (SELECT page_id, sum(view_count) AS views FROM (SELECT DISTINCT * FROM page_views) GROUP BY page_id),
    q1 AS (SELECT s.inst_no, s.doc_id, s.score, i.split_name, len(list_filter(regexp_split_to_array(d.body, '\s+'), lambda x: x <> '')) AS nd, len(list_filter(regexp_split_to_array(i.cloze[1], '\s+'), lambda x: x <> '')) AS ns, coalesce(v.views, 1) AS views
      FROM scores s JOIN instances i USING (inst_no) JOIN d USING (doc_id) LEFT JOIN v ON v.page_id = i.page_id),
    feats AS (SELECT inst_no, doc_id, split_name, score, CASE WHEN nd > 0 THEN ln(nd) END AS f_document, CASE WHEN ns > 0 THEN ln(ns) END AS f_sentence, ln(score + 1) AS f_relevance, CASE WHEN views > 0 THEN ln(views) END AS f_views FROM q1)"""
_WEIGHTS, _BIAS = {"f_document": -0.3, "f_sentence": 0.2, "f_relevance": 1.1, "f_views": 0.05}, -0.5
_SCORED = _FEATURES + ", scored AS (SELECT inst_no, doc_id, CASE split_name WHEN 'train' THEN 1 ELSE 0 END AS label, round(-0.5::DOUBLE + -0.3::DOUBLE * f_document + 0.2::DOUBLE * f_sentence + 1.1::DOUBLE * f_relevance + 0.05::DOUBLE * f_views, 4) AS score FROM feats WHERE f_document IS NOT NULL AND f_sentence IS NOT NULL AND f_views IS NOT NULL)"


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    inst = table(spark, sf_dir, "instances").select("inst_no", "page_id", "split_name", tx.token_count(F.get("cloze", F.lit(0))).alias("sentence_tokens"))
    views = page_views(spark, sf_dir)
    docs = _bodies(spark, sf_dir).select("doc_id", tx.token_count(F.col("text")).alias("document_tokens"))
    rows = _scores(spark, sf_dir).join(inst, "inst_no").join(docs, "doc_id").join(views, "page_id", "left")
    return quality.features(rows)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir)
    finite = rows.where(" and ".join(f"{f} > double('-infinity')" for f in quality.FEATURES))
    return finite.select("inst_no", "doc_id", F.when(F.col("split_name") == "train", 1).otherwise(0).alias("label"), F.round(quality.linear_score(_WEIGHTS, _BIAS), 4).alias("score"))


@registry.query("quality_features", sql=_FEATURES + " SELECT inst_no, doc_id, " + ", ".join(f"round({f}, 6) AS {f}" for f in quality.FEATURES) + " FROM feats")
def quality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four features of each instance and document; null for the logarithm of nothing."""
    return _features(spark, sf_dir).select("inst_no", "doc_id", *(F.round(F.when(F.col(f) > F.lit(float("-inf")), F.col(f)), 6).alias(f) for f in quality.FEATURES))


@registry.query("quality_scores", sql=_SCORED + " SELECT inst_no, doc_id, label, score FROM scored")
def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-odds under known weights."""
    return _scored(spark, sf_dir)


@registry.query("quality_trained")
def quality_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-odds of a model trained on the rows' labels."""
    rows = cut(_features(spark, sf_dir).withColumn("label", F.when(F.col("split_name") == "train", 1).otherwise(0)))
    return quality.decision(rows, quality.train(rows)).select("inst_no", "doc_id", "label", F.round("decision", 4).alias("decision"))


@registry.query(
    "quality_route",
    sql=_SCORED + " SELECT inst_no, coalesce(string_agg(CASE WHEN score >= 1.1 THEN doc_id::VARCHAR END, ',' ORDER BY doc_id), '') AS good, coalesce(string_agg(CASE WHEN score < 1.1 THEN doc_id::VARCHAR END, ',' ORDER BY doc_id), '') AS bad FROM scored GROUP BY inst_no",
)
def quality_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each instance at or above the threshold of 1.1, and below it."""
    routed = quality.route(_scored(spark, sf_dir).withColumnRenamed("doc_id", "doc_index"), 1.1, "inst_no")
    return routed.select("inst_no", *(F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("good", "bad")))


_CURVE = _SCORED + ", g AS (SELECT score, sum(label) AS pos, count(*) AS n FROM scored GROUP BY score), r AS (SELECT score, pos, sum(pos) OVER w AS tp, sum(n) OVER w AS seen, (SELECT sum(pos) FROM g) AS all_pos FROM g WINDOW w AS (ORDER BY score DESC))"


@registry.query("pr_curve", sql=_CURVE + " SELECT score AS threshold, round(tp / seen, 6) AS precision_at, round(tp / all_pos, 6) AS recall_at, round(2 * (tp / seen) * (tp / all_pos) / nullif(tp / seen + tp / all_pos, 0), 6) AS f1 FROM r")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision and recall at each score."""
    return quality.pr_curve(_scored(spark, sf_dir)).select("threshold", F.round("precision", 6).alias("precision_at"), F.round("recall", 6).alias("recall_at"), F.round("f1", 6).alias("f1"))


@registry.query("average_precision", sql=_CURVE + " SELECT round(sum(pos / all_pos * (tp / seen)), 6) AS average_precision FROM r")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area under the precision-recall curve."""
    return quality.average_precision(quality.pr_curve(_scored(spark, sf_dir))).select(F.round("average_precision", 6).alias("average_precision"))


@registry.query("worst_errors", sql=_SCORED + " SELECT inst_no, doc_id, label, score, CAST(r AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY CASE label WHEN 1 THEN score ELSE -score END, inst_no, doc_id) AS r FROM scored) WHERE r <= 10")
def worst_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten worst errors of each label."""
    return quality.worst_errors(_scored(spark, sf_dir), 10, "inst_no", "doc_id")


# ---------------------------------------------------------------- splits and validation


def _edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as nodes: an edge to the smallest record that shares the URL, and one for the page."""
    cited = _cited(spark, sf_dir).select("inst_no", "k").distinct()
    by_url = cited.join(cited.groupBy("k").agg(F.min("inst_no").alias("v")), "k").select(F.col("inst_no").alias("u"), "v")
    pages = table(spark, sf_dir, "instances").where("page_id is not null").select("inst_no", "page_id")
    by_page = pages.join(pages.groupBy("page_id").agg(F.min("inst_no").alias("v")), "page_id").select(F.col("inst_no").alias("u"), "v")
    alone = table(spark, sf_dir, "instances").select(F.col("inst_no").alias("u"), F.col("inst_no").alias("v"))
    return by_url.unionByName(by_page).unionByName(alone)


_COMPONENTS = (
    f"WITH RECURSIVE {_CITED}, ep AS (SELECT i.inst_no AS u, m.v FROM instances i JOIN (SELECT page_id, min(inst_no) AS v FROM instances GROUP BY 1) m ON m.page_id = i.page_id), eu AS (SELECT DISTINCT c.inst_no AS u, m.v FROM cited c JOIN (SELECT k, min(inst_no) AS v FROM cited GROUP BY 1) m USING (k)), "
    "e AS (SELECT u, v FROM ep UNION SELECT v, u FROM ep UNION SELECT u, v FROM eu UNION SELECT v, u FROM eu), reach AS (SELECT inst_no AS a, inst_no AS b FROM instances UNION SELECT r.a, e.v FROM reach r JOIN e ON e.u = r.b), "
    "comp AS (SELECT a AS inst_no, min(b) AS component FROM reach GROUP BY a)"
)


@registry.query("citation_components", sql=_COMPONENTS + " SELECT inst_no, component FROM comp")
def citation_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of each instance in the graph of pages and cited documents."""
    return graph.connected_components(_edges(spark, sf_dir)).select(F.col("node").alias("inst_no"), "component")


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    components = cut(citation_components(spark, sf_dir))
    sizes = components.groupBy("component").agg(F.count("*").alias("n"))
    packed = graph.fill_splits(sizes, [("valid", 100), ("test", 100)], "train", F.md5(F.concat_ws("|", F.lit("split"), F.col("component").cast("string"))))
    return components.join(packed, "component").select("inst_no", "component", "split")


_FINAL = (
    _COMPONENTS + ", z AS (SELECT component, count(*) AS n, md5('split|' || component) AS h FROM comp GROUP BY component), "
    "z1 AS (SELECT *, sum(n) OVER (ORDER BY h, component) - n AS before, row_number() OVER (ORDER BY h, component) AS r FROM z), s1 AS (SELECT component FROM z1 WHERE before < 100 OR r = 1), "
    "z2 AS (SELECT *, sum(n) OVER (ORDER BY h, component) - n AS before, row_number() OVER (ORDER BY h, component) AS r FROM z WHERE component NOT IN (SELECT component FROM s1)), s2 AS (SELECT component FROM z2 WHERE before < 100 OR r = 1), "
    "final AS (SELECT inst_no, component, CASE WHEN component IN (SELECT component FROM s1) THEN 'valid' WHEN component IN (SELECT component FROM s2) THEN 'test' ELSE 'train' END AS split FROM comp)"
)


@registry.query("final_splits", sql=_FINAL + " SELECT inst_no, component, split FROM final")
def final_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole components packed into validation, test and training."""
    return _final(spark, sf_dir)


@registry.query("split_disjointness", sql=_FINAL + ", kv AS (SELECT DISTINCT 'page_id' AS key, page_id::VARCHAR AS v, split FROM final JOIN instances USING (inst_no) WHERE page_id IS NOT NULL UNION SELECT DISTINCT 'url', k, split FROM final JOIN cited USING (inst_no)) SELECT a.key, a.split AS split_a, b.split AS split_b, count(*) AS n FROM kv a JOIN kv b ON a.key = b.key AND a.v = b.v AND a.split < b.split GROUP BY 1, 2, 3")
def split_disjointness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and URLs that two splits share: none."""
    rows = _final(spark, sf_dir).join(table(spark, sf_dir, "instances").select("inst_no", "page_id"), "inst_no").join(_cited(spark, sf_dir).select("inst_no", F.col("k").alias("url")), "inst_no", "left")
    return validation.shared_keys(rows, "split", ["page_id", "url"])


@registry.query("earlier_split_overlap", sql=f"WITH {_CITED}, kv AS (SELECT DISTINCT 'page_id' AS key, page_id::VARCHAR AS v, split_name AS split FROM instances WHERE page_id IS NOT NULL UNION SELECT DISTINCT 'url', k, split_name FROM cited) SELECT a.key, a.split AS split_a, b.split AS split_b, count(*) AS n FROM kv a JOIN kv b ON a.key = b.key AND a.v = b.v AND a.split < b.split GROUP BY 1, 2, 3")
def earlier_split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and URLs that the careless earlier splits share."""
    rows = table(spark, sf_dir, "instances").select("inst_no", "page_id", "split_name").join(_cited(spark, sf_dir).select("inst_no", F.col("k").alias("url")), "inst_no", "left")
    return validation.shared_keys(rows, "split_name", ["page_id", "url"])


@registry.query(
    "verify_rules",
    sql="""WITH f AS (SELECT count(CASE WHEN coalesce(trim(id) <> '', false) THEN NULL ELSE 1 END) AS id, count(CASE WHEN coalesce(trim(page_title) <> '', false) THEN NULL ELSE 1 END) AS page_title, count(CASE WHEN page_id IS NULL THEN 1 END) AS page_id,
    count(CASE WHEN coalesce(len(context) > 0 AND len(list_filter(context, lambda s: coalesce(trim(s) <> '', false))) = len(context), false) THEN NULL ELSE 1 END) AS left_context, count(CASE WHEN coalesce(trim(cloze[1]) <> '', false) THEN NULL ELSE 1 END) AS cloze,
    count(CASE WHEN coalesce(len(documents) > 0 AND len(list_filter(documents, lambda d: coalesce(trim(d.canonical_url) <> '', false))) = len(documents), false) THEN NULL ELSE 1 END) AS documents FROM instances)
    UNPIVOT f ON id, page_title, page_id, left_context, cloze, documents INTO NAME rule VALUE violations""".replace("WITH f AS (", "SELECT rule, violations FROM (UNPIVOT (").replace("FROM instances)\n    UNPIVOT f ON", "FROM instances) ON").replace("VALUE violations", "VALUE violations)"),
)
def verify_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule among the instances as released."""
    return validation.rule_violations(cloze.release(table(spark, sf_dir, "instances")))


_LEN = r"len(list_filter(regexp_split_to_array({0}, '\s+'), lambda x: x <> ''))"


@registry.query(
    "split_stats",
    sql=f"""WITH t AS (SELECT split_name, len(coalesce(documents, [])) AS nd, {_LEN.format("concat_ws(' ', page_title, nullif(array_to_string(headings, ' '), ''))")} AS topic, coalesce(list_sum(list_transform(context, lambda s: {_LEN.format('s')})), 0) AS context, len(coalesce(context, [])) AS context_sentences, coalesce({_LEN.format('cloze[1]')}, 0) AS cloze FROM instances)
    SELECT split_name, count(*) AS n_instances, count(CASE WHEN nd = 1 THEN 1 END) AS n_single, count(CASE WHEN nd <> 1 THEN 1 END) AS n_multi, """
    + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std" for c in ("topic", "context", "context_sentences", "cloze"))
    + " FROM t GROUP BY GROUPING SETS ((split_name), ())",
)
def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and lengths for each split and all together."""
    return validation.split_stats(table(spark, sf_dir, "instances"))


@registry.query(
    "document_lengths",
    sql=f"""WITH {_LATEST}, {_CITED}, t AS (SELECT split_name, coalesce(list_sum(list_transform(flatten(paragraphs), lambda s: {_LEN.format('s')})), 0) AS tokens, len(flatten(paragraphs)) AS sentences FROM cited JOIN latest USING (k) JOIN documents USING (doc_id))
    SELECT split_name, count(*) AS n_cited, """
    + ", ".join(f"round(avg({c}), 6) AS {c}_mean, round(stddev_pop({c}), 6) AS {c}_std" for c in ("tokens", "sentences"))
    + " FROM t GROUP BY GROUPING SETS ((split_name), ())",
)
def document_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of the cited documents for each split and all together, each as often as it is cited."""
    found = _cited(spark, sf_dir).join(_latest(spark, sf_dir), "k").join(table(spark, sf_dir, "documents").select("doc_id", "paragraphs"), "doc_id")
    return validation.document_lengths(found.select("split_name", "paragraphs"))


@registry.query(
    "effective_urls",
    sql=f"WITH {_LATEST}, c0 AS (SELECT inst_no, unnest(documents) AS x, unnest(range(len(documents))) AS doc_index FROM instances WHERE len(documents) > 0) SELECT inst_no, CAST(doc_index AS INT) AS doc_index, coalesce(nullif(canonical_link, ''), x.url) AS url FROM c0 JOIN latest ON k = {_TIDY.format('coalesce(x.canonical_url, x.url)')} JOIN documents d USING (doc_id)",
)
def effective_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URL under which an instance names each document found: its canonical link, else the cited URL."""
    cited = _cited(spark, sf_dir).join(_latest(spark, sf_dir), "k")
    links = table(spark, sf_dir, "documents").select("doc_id", "canonical_link")
    named = table(spark, sf_dir, "instances").select("inst_no", F.posexplode("documents").alias("doc_index", "x"))
    return cited.join(links, "doc_id").join(named, ["inst_no", "doc_index"]).select("inst_no", "doc_index", urls.effective_url(F.col("canonical_link"), F.col("x.url")).alias("url"))


@registry.query("hold_out", sql="SELECT ref_no, CASE WHEN row_number() OVER (ORDER BY md5('hold out|' || ref_no), ref_no) <= 100 THEN 'held' ELSE 'train' END AS part FROM refs")
def hold_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All references, a hundred of them held out in a repeatable random order."""
    train, held = quality.hold_out(table(spark, sf_dir, "refs").select("ref_no"), 100, "ref_no")
    return train.withColumn("part", F.lit("train")).unionByName(held.withColumn("part", F.lit("held")))


@registry.query("length_correlation", sql="SELECT round(corr(n_chars, len(paragraphs)), 6) AS r, count(*) AS n, count(*) >= 3 AS has_p FROM documents WHERE n_chars IS NOT NULL AND len(paragraphs) IS NOT NULL")
def length_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the length of a text goes with its number of paragraphs."""
    found = quality.correlation(table(spark, sf_dir, "documents").select("n_chars", F.when(F.col("paragraphs").isNotNull(), F.size("paragraphs")).alias("n")), "n_chars", "n")
    return found.select(F.round("r", 6).alias("r"), "n", F.col("p").between(0, 1).alias("has_p"))


@registry.query("bm25_top_k", sql=_BM25 + " SELECT inst_no, doc_id, score, CAST(r AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY inst_no ORDER BY score DESC, doc_id) AS r FROM scores) WHERE r <= 3")
def bm25_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three most relevant cited documents of each instance."""
    w = Window.partitionBy("inst_no").orderBy(F.desc("score"), "doc_id")
    return _scores(spark, sf_dir).withColumn("place", F.row_number().over(w)).where("place <= 3")


@registry.query("document_use", sql=f"WITH {_CITED}, u AS (SELECT k, count(*) AS n, count(DISTINCT page_id) AS p FROM cited GROUP BY k) SELECT count(*) AS n_documents, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_citations, count(CASE WHEN n > 1 THEN 1 END) AS n_reused, count(CASE WHEN p > 1 THEN 1 END) AS n_on_pages FROM u")
def document_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often cited documents are used."""
    return validation.document_use(_cited(spark, sf_dir).select(F.col("k").alias("url"), "page_id"))


@registry.query("site_documents", sql=r"SELECT regexp_extract(canonical_url, '^([^,)/]+),([^,)/:]+)', 2) || '.' || regexp_extract(canonical_url, '^([^,)/]+),([^,)/:]+)', 1) AS site, count(*) AS n FROM documents GROUP BY 1")
def site_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of each site, the site taken from the key."""
    return table(spark, sf_dir, "documents").groupBy(site_of(F.col("canonical_url")).alias("site")).agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- markup


@registry.query("html_body_paragraphs")
def html_body_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs and characters of the body text of each page that has some."""
    from inkweir.sources.markup import extract_bodies

    pages = table(spark, sf_dir, "ref_html").select(F.col("html_id").cast("string").alias("canonical_url"), "html")
    return extract_bodies(pages).select(F.col("canonical_url").cast("bigint").alias("html_id"), "title", F.size("paragraphs").alias("n_paragraphs"), F.length("text").alias("n_chars"))


@registry.query(
    "section_sessions",
    sql="""WITH e AS (SELECT inst_no, page_id, headings[1] AS h FROM instances WHERE page_id IS NOT NULL), f AS (SELECT *, CASE WHEN h IS DISTINCT FROM lag(h) OVER w THEN 1 ELSE 0 END AS starts FROM e WINDOW w AS (PARTITION BY page_id ORDER BY inst_no)),
    s AS (SELECT *, sum(starts) OVER (PARTITION BY page_id ORDER BY inst_no) AS section FROM f) SELECT page_id, CAST(section AS BIGINT) AS section, count(*) AS n, min(inst_no) AS first_no FROM s GROUP BY 1, 2""",
)
def section_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of instances under one heading, page by page in order of their number."""
    rows = table(spark, sf_dir, "instances").where("page_id is not null").select("inst_no", "page_id", F.get("headings", F.lit(0)).alias("h"))
    return runs(rows, "page_id", "inst_no", "h").select("page_id", F.col("run").alias("section"), "n", F.col("first").alias("first_no"))
