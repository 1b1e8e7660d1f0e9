"""The queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkweir.llm import grouped_splits, junk, language, leaks, main_body, overlap, packing, site_lines, truncation
from inkweir.operators.timestamps import site_of
from inkweir.plans.registry import Registry
from inkweir.session import cut, table

registry = Registry()

# ---------------------------------------------------------------- problem 2: lines repeated across a site

_P2_LINES = r"""
WITH d AS (
  SELECT doc_id, paragraphs, regexp_extract(canonical_url, '^([^,)/]+),([^,)/:]+)', 2) || '.' || regexp_extract(canonical_url, '^([^,)/]+),([^,)/:]+)', 1) AS site
  FROM documents),
p AS (SELECT doc_id, site, unnest(paragraphs) AS para, unnest(range(len(paragraphs))) AS para_no FROM d WHERE len(paragraphs) > 0),
s AS (SELECT doc_id, site, para_no, unnest(para) AS sent, unnest(range(len(para))) AS sent_no FROM p WHERE len(para) > 0),
l AS (SELECT doc_id, site, CAST(para_no AS INT) AS para_no, CAST(sent_no AS INT) AS sent_no,
        trim(regexp_replace(regexp_replace(lower(sent), '[0-9]+', '0', 'g'), '[\s\x{00A0}]+', ' ', 'g')) AS line FROM s WHERE sent IS NOT NULL),
n AS (SELECT site, count(DISTINCT doc_id) AS site_docs FROM d GROUP BY site),
r AS (SELECT site, line, count(DISTINCT doc_id) AS n_docs FROM l GROUP BY site, line),
k AS (SELECT r.site, r.line, r.n_docs, n.site_docs FROM r JOIN n USING (site) WHERE n_docs >= 5 AND n_docs >= 0.05 * site_docs)
"""


@registry.query("p2_found", sql=_P2_LINES + "SELECT DISTINCT doc_id, para_no, sent_no FROM l JOIN k USING (site, line)")
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the lines that a site repeats in at least 5 of its documents and 5 % of them."""
    return site_lines.repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "para_no", "sent_no")


@registry.query("p2_templates")
def p2_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The templates that cover enough documents of a site, those with wildcard slots too."""
    return site_lines.line_templates(table(spark, sf_dir, "documents"))[0]


@registry.query("p2_repeated", sql=_P2_LINES + "SELECT site, line AS template, n_docs, site_docs FROM k")
def p2_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated lines of each site with the number of documents they are in."""
    return site_lines.line_templates(table(spark, sf_dir, "documents"))[0].where("slots = 0").drop("slots")


@registry.query(
    "p2_clean",
    sql=_P2_LINES + """, gone AS (SELECT DISTINCT doc_id, para_no, sent_no FROM l JOIN k USING (site, line)),
    every AS (SELECT DISTINCT doc_id, CAST(para_no AS INT) AS para_no, CAST(sent_no AS INT) AS sent_no, sent FROM s), kept AS (SELECT every.* FROM every ANTI JOIN gone USING (doc_id, para_no, sent_no)),
    n AS (SELECT doc_id, count(*) AS n, md5(string_agg(coalesce(sent, ''), '|' ORDER BY para_no, sent_no)) AS h FROM kept GROUP BY doc_id)
    SELECT documents.doc_id, CAST(coalesce(n, 0) AS INT) AS n_sentences, coalesce(h, md5('')) AS body_md5 FROM documents LEFT JOIN n USING (doc_id)""".replace("n AS (SELECT doc_id, count", "m AS (SELECT doc_id, count").replace("LEFT JOIN n USING", "LEFT JOIN m USING"),
)
def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the repeated lines of their sites: the sentences left, and a hash of them."""
    documents = table(spark, sf_dir, "documents")
    clean = site_lines.without_lines(documents, site_lines.repeated_lines(documents)).select("doc_id", F.coalesce(F.flatten("paragraphs"), F.array().cast("array<string>")).alias("body"))
    return clean.select("doc_id", F.size("body").alias("n_sentences"), F.md5(F.encode(F.array_join("body", "|", ""), "UTF-8")).alias("body_md5"))


@registry.query("p2_clean_templates")
def p2_clean_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of their sites' templates, those with some slots too."""
    documents = table(spark, sf_dir, "documents")
    return site_lines.without_lines(documents, site_lines.templated_lines(documents)).withColumn("n_sentences", F.coalesce(F.size(F.flatten("paragraphs")), F.lit(0)))


# ---------------------------------------------------------------- problem 3: template residue and error pages


@registry.query("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that are template residue, filler, error text or a script notice in place of content."""
    return junk.residue_documents(table(spark, sf_dir, "documents")).where("residue").select("doc_id").distinct()


@registry.query("p3_clean")
def p3_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that remain, with the numbers of their lines by class."""
    return junk.residue_documents(table(spark, sf_dir, "documents")).where("not residue").drop("residue", "placeholder", "n_placeholder")


@registry.query("p3_judged", sql="""SELECT doc_id, count(*) AS n_rows, CAST(any_value(n) AS BIGINT) AS n_lines FROM (SELECT doc_id, len(list_filter(flatten(list_filter(coalesce(paragraphs, []), lambda p: p IS NOT NULL)), lambda s: trim(s) <> '')) AS n FROM documents) GROUP BY doc_id""")
def p3_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the rows it is judged in, and its lines, each of which has one class."""
    told = junk.residue_documents(table(spark, sf_dir, "documents"))
    n = F.col("n_prose") + F.col("n_furniture") + F.col("n_filler") + F.col("n_error") + F.col("n_script") + F.col("n_placeholder")
    return told.select("doc_id", n.alias("n")).groupBy("doc_id").agg(F.count("*").alias("n_rows"), F.max("n").alias("n_lines"))


@registry.query("p3_validation")
def p3_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the models do on hosts they weren't trained on: lines by class, and documents, against weak labels."""
    return spark.createDataFrame(junk.validate_on_unseen_hosts(table(spark, sf_dir, "documents")))


# ---------------------------------------------------------------- problem 4: near-same records across splits


def _cloze_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "instances").select(F.col("inst_no").alias("rec_id"), "split_name", F.get("cloze", F.lit(0)).alias("text"))


_P4_PAIRS = r"""
WITH w AS (SELECT inst_no, split_name, list_distinct(regexp_extract_all(lower(strip_accents(cloze[1])), '[a-z0-9]+')) AS words FROM instances WHERE split_name IS NOT NULL),
s AS (SELECT * FROM w WHERE len(words) > 0),
o AS (SELECT e.inst_no AS e, e.split_name, t.inst_no AS t, len(list_intersect(e.words, t.words)) AS both_have, len(e.words) + len(t.words) AS n FROM s e JOIN s t ON e.split_name <> 'train' AND t.split_name = 'train'
  AND least(len(e.words), len(t.words)) * 10 >= 7 * greatest(len(e.words), len(t.words))),
pairs AS (SELECT DISTINCT e, split_name, t FROM o WHERE 10 * both_have >= 7 * (n - both_have))
"""


@registry.query("p4_found", sql=_P4_PAIRS + "SELECT least(e, t) AS inst_no_a, greatest(e, t) AS inst_no_b FROM pairs")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a training and a held-out instance whose cited sentences share 7/10 of their words."""
    pairs = overlap.overlapping_pairs(_cloze_records(spark, sf_dir))
    return pairs.select(F.col("rec_id_a").alias("inst_no_a"), F.col("rec_id_b").alias("inst_no_b")).distinct()


def _cited_sites(instances: DataFrame) -> DataFrame:
    """Instances once for each site they cite, a null site where they cite none or an unreadable one."""
    sites = F.array_distinct(F.transform(F.coalesce("documents.canonical_url", F.array()), lambda u: site_of(u)))
    return instances.select("inst_no", "split_name", F.explode_outer(sites).alias("site")).distinct()


_SITE = "regexp_extract({0}, '^([^,)/]+),([^,)/:]+)', 2) || '.' || regexp_extract({0}, '^([^,)/]+),([^,)/:]+)', 1)"


@registry.query(
    "p4_by_split_and_site",
    sql=_P4_PAIRS + f""", c0 AS (SELECT inst_no, split_name, unnest(CASE WHEN len(documents) > 0 THEN list_transform(documents, lambda d: CASE WHEN regexp_matches(d.canonical_url, '^[^,)/]+,[^,)/:]+') THEN {_SITE.format('d.canonical_url')} END) ELSE [NULL] END) AS site FROM instances WHERE split_name <> 'train'),
    c AS (SELECT DISTINCT * FROM c0), k AS (SELECT e, count(*) AS n FROM pairs GROUP BY e)
    SELECT split_name, site, count(DISTINCT inst_no) AS n_instances, count(DISTINCT e) AS n_leaked, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_pairs FROM c LEFT JOIN k ON inst_no = e GROUP BY split_name, site""",
)
def p4_by_split_and_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each held-out split and cited site: its instances, those that return in train, and the pairs."""
    leaked = overlap.record_coverage(_cloze_records(spark, sf_dir)).where("n_train > 0").select(F.col("rec_id").alias("inst_no"), "n_train")
    told = _cited_sites(table(spark, sf_dir, "instances").where("split_name <> 'train'")).join(leaked, "inst_no", "left")
    return told.groupBy("split_name", "site").agg(F.count_distinct("inst_no").alias("n_instances"), F.count_distinct(F.when(F.col("n_train") > 0, F.col("inst_no"))).alias("n_leaked"), F.coalesce(F.sum("n_train"), F.lit(0)).alias("n_pairs"))


@registry.query("p4_coverage", sql=_P4_PAIRS + "SELECT s.inst_no, s.split_name, count(t) AS n_train FROM s LEFT JOIN pairs ON s.inst_no = e WHERE s.split_name <> 'train' GROUP BY s.inst_no, s.split_name")
def p4_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every held-out instance with the number of training instances it returns in."""
    return overlap.record_coverage(_cloze_records(spark, sf_dir)).select(F.col("rec_id").alias("inst_no"), "split_name", "n_train")


@registry.query("p4_coverage_by_site")
def p4_coverage_by_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each held-out split and cited site: how much of its instances is covered by training texts."""
    covered = overlap.record_coverage(_cloze_records(spark, sf_dir)).select(F.col("rec_id").alias("inst_no"), "n_words", "matched", "coverage")
    told = _cited_sites(table(spark, sf_dir, "instances").where("split_name <> 'train'")).join(covered, "inst_no")
    return told.groupBy("split_name", "site").agg(F.count("*").alias("n_instances"), F.sum("n_words").alias("n_words"), F.sum("matched").alias("n_matched"), F.round(F.avg("coverage"), 6).alias("mean_coverage"), F.max("coverage").alias("max_coverage"))


# ---------------------------------------------------------------- problem 5: splits that keep related records together


def _linked_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = F.transform("documents.canonical_url", lambda u: grouped_splits.same_url(u))
    return table(spark, sf_dir, "instances").select(F.col("inst_no").alias("rec_id"), F.col("page_id").alias("entity"), urls.alias("sources"))


_P5_GROUPS = r"""
WITH RECURSIVE u AS (SELECT inst_no, unnest(list_transform(documents, lambda d: regexp_replace(regexp_replace(regexp_replace(lower(d.canonical_url), '#.*$', '', 's'), '\?utm_.*$', '', 's'), '/+$', ''))) AS k FROM instances WHERE len(documents) > 0),
keyed AS (SELECT inst_no, 'u' || k AS k FROM u WHERE k IS NOT NULL UNION SELECT inst_no, 'p' || page_id FROM instances WHERE page_id IS NOT NULL),
star AS (SELECT k, min(inst_no) AS v FROM keyed GROUP BY k), e AS (SELECT inst_no AS a, v AS b FROM keyed JOIN star USING (k) UNION SELECT v, inst_no FROM keyed JOIN star USING (k)),
reach AS (SELECT inst_no AS a, inst_no AS b FROM instances UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
grouped AS (SELECT a AS inst_no, min(b) AS group_no FROM reach GROUP BY a)
"""


@registry.query("p5_found", sql=_P5_GROUPS + "SELECT inst_no, group_no FROM grouped")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instance with the smallest inst_no of its group."""
    return grouped_splits.record_groups(_linked_records(spark, sf_dir)).select(F.col("rec_id").alias("inst_no"), "group_no")


@registry.query("p5_splits")
def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every instance with its group and its new split."""
    groups = grouped_splits.record_groups(_linked_records(spark, sf_dir))
    labels = table(spark, sf_dir, "instances").select(F.col("inst_no").alias("rec_id"), F.col("split_name").alias("label"))
    return grouped_splits.split_groups(groups, labels).select(F.col("rec_id").alias("inst_no"), "group_no", F.col("split").alias("split_name"))


@registry.query("p5_whole_groups", sql=_P5_GROUPS + "SELECT group_no, count(*) AS n_instances, 1 AS n_splits FROM grouped GROUP BY group_no")
def p5_whole_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every group with its instances and the number of new splits that they are in: one."""
    return p5_splits(spark, sf_dir).groupBy("group_no").agg(F.count("*").alias("n_instances"), F.count_distinct("split_name").cast("int").alias("n_splits"))


@registry.query("p5_shares")
def p5_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and instances of each new split."""
    return p5_splits(spark, sf_dir).groupBy("split_name").agg(F.count("*").alias("n_instances"), F.count_distinct("group_no").alias("n_groups"))


# ---------------------------------------------------------------- problem 6: languages


@registry.query("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences of at least 40 letters in another language than their document's label names, or of
    documents whose label names none."""
    told = language.identify(table(spark, sf_dir, "documents"))
    differs = F.col("label").isNull() | (F.col("label") != F.col("lang_code"))
    return told.where((F.col("letters") >= 40) & F.col("lang_code").isNotNull() & differs).select("doc_id", "para_no", "sent_no", "lang_code").distinct()


@registry.query("p6_sentences")
def p6_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence with its language and a confidence."""
    return language.identify(table(spark, sf_dir, "documents"))


@registry.query(
    "p6_sentence_counts",
    sql="""WITH p AS (SELECT doc_id, unnest(paragraphs) AS p FROM documents WHERE len(paragraphs) > 0), s AS (SELECT doc_id, unnest(p) AS s FROM p WHERE len(p) > 0)
    SELECT doc_id, count(*) AS n_sentences, 0 AS n_strange FROM s WHERE s IS NOT NULL GROUP BY doc_id""",
)
def p6_sentence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document its sentences, every one of which is classified once, and how many have a
    confidence that is none or a language for text without letters."""
    strange = ~F.col("confidence").between(0, 1) | (F.col("lang_code").isNotNull() & (F.col("letters") == 0))
    return p6_sentences(spark, sf_dir).groupBy("doc_id").agg(F.count("*").alias("n_sentences"), F.count_if(strange).cast("int").alias("n_strange"))


@registry.query("p6_documents")
def p6_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the language most of it is in, and a confidence."""
    return language.document_languages(language.identify(table(spark, sf_dir, "documents")))


# ---------------------------------------------------------------- problem 7: main body of pages


@registry.query("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main-body blocks of every page and document, as MD5."""
    blocks = main_body.main_bodies(table(spark, sf_dir, "ref_html"), table(spark, sf_dir, "documents"))
    return blocks.select("rec_kind", "rec_id", main_body.block_md5(F.col("block")).alias("block_md5")).distinct()


# ---------------------------------------------------------------- problem 8: packing


@registry.query("p8_assignment")
def p8_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or of its pieces where it is too long: for each capacity by itself
    (way each), and where all capacities may be used together (way joint)."""
    return packing.assign_both(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"))


@registry.query("p8_joint")
def p8_joint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document where all capacities may be used together."""
    return packing.assign_jointly(table(spark, sf_dir, "documents"), table(spark, sf_dir, "containers"))


@registry.query("p8_fill")
def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers used of each kind, alone and jointly, the least possible number, and the share filled."""
    used = p8_assignment(spark, sf_dir).groupBy("way", "container_kind", "capacity").agg(F.count_distinct("container_no").alias("n_containers"), F.sum("n_tokens").alias("n_tokens"))
    return used.withColumn("least", F.ceil(F.col("n_tokens") / F.col("capacity"))).withColumn("filled", F.round(F.col("n_tokens") / (F.col("n_containers") * F.col("capacity")), 6))


@registry.query("p8_overfull", sql="SELECT way, count(DISTINCT doc_id) AS n_docs, 0 AS n_overfull, 0 AS n_broken FROM documents, (SELECT unnest(['each', 'joint']) AS way) GROUP BY way")
def p8_overfull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each way: the documents placed, containers above their capacity, and documents that are in
    pieces though they would fit the largest capacity of their way, or whose pieces leave gaps."""
    rows = cut(p8_assignment(spark, sf_dir))
    full = rows.groupBy("way", "capacity", "container_no").agg(F.sum("n_tokens").alias("held")).groupBy("way").agg(F.count_if(F.col("held") > F.col("capacity")).cast("int").alias("n_overfull"))
    kind = F.when(F.col("way") == "each", F.col("capacity"))
    top = rows.withColumn("kind", kind).groupBy("way", "kind").agg(F.max("capacity").alias("top"))
    docs = rows.withColumn("kind", kind).groupBy("way", "kind", "doc_id").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("n"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"))
    told = docs.alias("d").join(F.broadcast(top).alias("t"), (F.col("d.way") == F.col("t.way")) & F.col("d.kind").eqNullSafe(F.col("t.kind")))
    broken = told.groupBy("d.way").agg(F.count_distinct("d.doc_id").alias("n_docs"), F.count_if(((F.col("pieces") > 1) & (F.col("n") <= F.col("top"))) | (F.col("n") != F.col("end"))).cast("int").alias("n_broken"))
    return broken.join(full, "way").select("way", "n_docs", "n_overfull", "n_broken")


# ---------------------------------------------------------------- problem 9: evaluation texts in training text


_P9_LEAKS = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(strip_accents(text)), '[a-z0-9]+') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, regexp_extract_all(lower(strip_accents(text)), '[a-z0-9]+') AS w FROM eval_items WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g FROM iw WHERE len(w) >= 12),
dg AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g FROM dw WHERE len(w) >= 12),
leaks AS (SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g))
"""


@registry.query("p9_found", sql=_P9_LEAKS + "SELECT doc_id, item_id FROM leaks")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with at least 12 consecutive words of an evaluation item, and the item."""
    return leaks.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


@registry.query("p9_near")
def p9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the rarest terms of a run of an item near where they should stand."""
    return leaks.near_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


@registry.query("p9_items", sql=_P9_LEAKS + "SELECT task, split_name, count(DISTINCT i.item_id) AS n_items, count(DISTINCT l.item_id) AS n_leaked, count(DISTINCT doc_id) AS n_docs FROM eval_items i LEFT JOIN leaks l ON l.item_id = i.item_id GROUP BY task, split_name")
def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each task and split of the evaluation items: how many leaked, into how many documents."""
    items = table(spark, sf_dir, "eval_items")
    leaked = leaks.leaked_items(table(spark, sf_dir, "documents"), items)
    joined = items.select("item_id", "task", "split_name").join(leaked, "item_id", "left")
    return joined.groupBy("task", "split_name").agg(F.count_distinct("item_id").alias("n_items"), F.count_distinct(F.when(F.col("doc_id").isNotNull(), F.col("item_id"))).alias("n_leaked"), F.count_distinct("doc_id").alias("n_docs"))


# ---------------------------------------------------------------- problem 10: texts cut off


@registry.query("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut before its end."""
    return truncation.truncated(table(spark, sf_dir, "documents")).select("doc_id").distinct()


@registry.query("p10_reasons")
def p10_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many cut documents each sign shows, by the combination of signs: the final trigram, a mark of
    the cut, a length at which the site's texts pile up."""
    return truncation.truncated(table(spark, sf_dir, "documents")).groupBy("by_gram", "by_mark", "by_limit").agg(F.count("*").alias("n_docs"))


@registry.query("p10_sites", sql=r"SELECT CASE WHEN regexp_matches(canonical_url, '^[^,)/]+,[^,)/:]+') THEN " + _SITE.format("canonical_url") + " END AS site, count(DISTINCT doc_id) AS n_docs, 0 AS n_strange FROM documents GROUP BY 1")
def p10_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each site its documents as ``p10_rates`` counts them, and whether its reasons add up."""
    strange = (F.col("n_cut") != F.col("n_limit") + F.col("n_mark") + F.col("n_gram")) | (F.col("n_cut") > F.col("n_docs"))
    return p10_rates(spark, sf_dir).select("site", "n_docs", F.when(strange, 1).otherwise(0).alias("n_strange"))


@registry.query("p10_rates")
def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each site: its documents, and how many of them were cut in which way."""
    documents = table(spark, sf_dir, "documents")
    found = truncation.truncated(documents).select("doc_id", "reason").distinct()
    joined = documents.select("doc_id", site_of(F.col("canonical_url")).alias("site")).distinct().join(found, "doc_id", "left")
    return joined.groupBy("site").agg(F.count("*").alias("n_docs"), F.count("reason").alias("n_cut"), *(F.count_if(F.col("reason") == r).alias(f"n_{r}") for r in ("limit", "mark", "gram"))).withColumn("rate", F.round(F.col("n_cut") / F.col("n_docs"), 6))
