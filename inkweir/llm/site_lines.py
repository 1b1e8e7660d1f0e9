"""Lines repeated across the documents of one site.

Lines are parsed into templates through token trees of fixed depth: the path of a line is its site,
its number of tokens and its first tokens (tokens with digits are wildcards already there). The counts
of tree nodes are combined inside each partition and merged by the shuffle, so a tree never exists in
one place. Only leaves that could hold a repeated line (as many rows as the smallest number of
documents asked for) go on; in those every token that is rarer at its position becomes a wildcard
slot, which gives the templates. A line that is repeated often enough has no rare token, hence a
template without wildcards that is the line itself: its coverage is exact.

Leaves, lines and templates go by 64-bit hashes once counted (lines by 128 bits), so that joins with
places carry fixed-size rows; these are broadcast below SENT_BYTES, and beyond that joined by shuffles in
which the rows of a hot leaf or line are spread over parts.

Sizes: a leaf that goes on holds at least ``share`` of its site's documents, so a site of L lines a
document has at most L / share such leaves, and a leaf at most L / share frequent tokens a position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkweir.llm.common import line_key, sentences
from inkweir.operators.timestamps import site_of
from inkweir.session import cut, stored

WILDCARD = "<*>"
DEPTH = 3
#: Bytes up to which a table of fixed-size rows, as they stand in a hash table, is sent to every task.
SENT_BYTES = 64 << 20
#: Rows of one leaf or line from which they are joined in parts, and the number of parts.
HOT_ROWS, PARTS = 1_000_000, 64
#: Share of a template's tokens that may be slots where templates with slots are removed too.
MOST_SLOTS = 1 / 3


def _path(tokens: Column, depth: int) -> Column:
    masked = F.transform(F.slice(tokens, 1, depth), lambda t: F.when(t.contains("0"), F.lit(WILDCARD)).otherwise(t))
    return F.concat_ws(" ", F.size(tokens).cast("string"), F.array_join(masked, " "))


def _joined(many: DataFrame, few: DataFrame, key: str, bytes_a_row: int | None, spread: str) -> DataFrame:
    """many(key, ...) with few(key, rows, ...), one row a key. ``few`` is sent to the tasks if its rows are
    of a fixed size and small enough together; else keys with many rows are joined in parts, over which
    ``many`` is spread by a hash of ``spread``."""
    if bytes_a_row and few.count() * bytes_a_row <= SENT_BYTES:
        return many.join(F.broadcast(few), key)
    hot = few.where(F.col("rows") >= HOT_ROWS).select(key, F.lit(True).alias("_hot"))
    names = F.broadcast(hot) if hot.count() * 80 <= SENT_BYTES else hot
    parted = many.join(names, key, "left").withColumn("_part", F.when(F.col("_hot"), F.pmod(F.xxhash64(spread), F.lit(PARTS)).cast("int")).otherwise(0))
    copies = few.withColumn("_part", F.explode(F.sequence(F.lit(0), F.when(F.col("rows") >= HOT_ROWS, PARTS - 1).otherwise(0))))
    return parted.join(copies, [key, "_part"]).drop("_part", "_hot")


def line_templates(documents: DataFrame, least: int = 5, share: float = 0.05, depth: int = DEPTH) -> tuple[DataFrame, DataFrame]:
    """documents(doc_id, canonical_url, paragraphs) to

    - templates(site, template, slots, n_docs, site_docs): those that cover at least ``least``
      documents and ``share`` of the site's documents; slots is the number of wildcards;
    - lines(doc_id, para_no, sent_no, site, slots, n_tokens): the places of the lines they cover.

    Documents count by doc_id: repeated rows of one doc_id count once, but their places are repeated.
    Null sentences, paragraphs and unreadable URLs (no site) take no part; an empty line is a line; a
    token that looks like a wildcard is a token. Ties at the threshold are in. An empty table gives two
    empty ones.
    """
    lines = sentences(documents).where("site is not null").withColumn("line", line_key(F.col("sent")))
    lines = lines.select("doc_id", "site", "para_no", "sent_no", "line", F.xxhash64("site", _path(F.split("line", " "), depth)).alias("leaf"))
    docs = documents.select("doc_id", site_of(F.col("canonical_url")).alias("site")).where("site is not null")
    wanted = docs.groupBy("site").agg(F.count_distinct("doc_id").alias("site_docs")).withColumn("needed", F.greatest(F.lit(least), F.ceil(F.col("site_docs") * F.lit(share) - F.lit(1e-9))))
    leaves = cut(lines.groupBy("site", "leaf").agg(F.count("*").alias("rows")).join(wanted, "site").where("rows >= needed").select("leaf", "rows", "needed", "site_docs"))
    key = [F.xxhash64("site", "line").alias("line_id"), F.xxhash64("line", "site").alias("line_check")]
    hot = stored(_joined(lines, leaves.select("leaf", "rows"), "leaf", 96, "line").select("doc_id", "para_no", "sent_no", "site", "leaf", "line", *key))
    unique = stored(hot.groupBy("site", "leaf", "line", "line_id", "line_check").agg(F.count("*").alias("n")))
    tokens = _joined(unique.select("leaf", "n", F.posexplode(F.split("line", " ")).alias("pos", "token")), leaves.select("leaf", "rows", "needed"), "leaf", 112, "token")
    slots = tokens.groupBy("leaf", "rows", "needed", "pos", "token").agg(F.sum("n").alias("n")).where("n >= needed")
    frequent = slots.groupBy("leaf", "rows").agg(F.collect_list(F.concat_ws(" ", "pos", "token")).alias("frequent"))
    every = leaves.join(frequent, ["leaf", "rows"], "left").select("leaf", "rows", "needed", "site_docs", F.coalesce("frequent", F.array().cast("array<string>")).alias("frequent"))
    # set operations hash, so a very long line costs no more than its tokens
    marked = F.transform(F.split("line", " "), lambda t, i: F.concat_ws(" ", i, t))
    place = lambda m: F.substring_index(m, " ", 1).cast("int")
    kept = F.transform(F.array_intersect(marked, F.col("frequent")), lambda m: F.struct(place(m).alias("pos"), F.regexp_replace(m, r"^\d+ ", "").alias("token")))
    open_at = F.transform(F.array_except(marked, F.col("frequent")), place)
    parsed = _joined(unique, every, "leaf", None, "line").select("site", "line_id", "line_check", "n", "needed", "site_docs", kept.alias("kept"), open_at.alias("open_at"))
    text = F.array_join(F.transform(F.array_sort(F.concat("kept", F.transform("open_at", lambda i: F.struct(i.alias("pos"), F.lit(WILDCARD).alias("token"))))), lambda p: p["token"]), " ")
    parsed = stored(parsed.withColumn("template", text).select("line_id", "line_check", F.col("n").alias("rows"), "site", "needed", "site_docs", "template", F.size("open_at").alias("slots"), F.size(F.split("template", " ")).alias("n_tokens"), F.xxhash64("site", "template", "open_at").alias("template_id")))
    ids = parsed.select("line_id", F.col("line_check").alias("check"), "rows", "template_id", "slots", "n_tokens")
    covered = _joined(hot.select("doc_id", "para_no", "sent_no", "site", "line_id", "line_check"), ids, "line_id", 144, "doc_id").where("line_check = check")
    covered = stored(covered.select("doc_id", "para_no", "sent_no", "site", "template_id", "slots", "n_tokens"))
    counted = covered.select("template_id", "doc_id").distinct().groupBy("template_id").agg(F.count("*").alias("n_docs"), F.count("*").alias("rows"))
    named = parsed.select("template_id", "site", "template", "slots", "needed", "site_docs").distinct()
    templates = cut(counted.join(named, "template_id").where("n_docs >= needed"))
    found = _joined(covered, templates.select("template_id", "rows"), "template_id", 96, "doc_id")
    return templates.select("site", "template", "slots", "n_docs", "site_docs"), found.select("doc_id", "para_no", "sent_no", "site", "slots", "n_tokens")


def repeated_lines(documents: DataFrame, least: int = 5, share: float = 0.05) -> DataFrame:
    """The places (doc_id, para_no, sent_no, site) of the lines that are equal, in the form of
    ``line_key``, in enough documents of their site. Edge cases as in ``line_templates``."""
    _, lines = line_templates(documents, least, share)
    return lines.where("slots = 0").select("doc_id", "para_no", "sent_no", "site").distinct()


def templated_lines(documents: DataFrame, least: int = 5, share: float = 0.05, most_slots: float = MOST_SLOTS) -> DataFrame:
    """As ``repeated_lines``, with the lines too that only share a template of which at most a
    ``most_slots`` part of the tokens are slots."""
    _, lines = line_templates(documents, least, share)
    return lines.where(F.col("slots") <= F.lit(most_slots) * F.col("n_tokens")).select("doc_id", "para_no", "sent_no", "site").distinct()


def without_lines(documents: DataFrame, found: DataFrame) -> DataFrame:
    """documents(doc_id, paragraphs) without the places in found(doc_id, para_no, sent_no):
    (doc_id, paragraphs). Paragraphs left without a sentence go; a document may come out empty. Null
    paragraphs stay null."""
    gone = found.groupBy("doc_id").agg(F.collect_set(F.struct("para_no", "sent_no")).alias("gone"))
    kept = documents.select("doc_id", "paragraphs").join(gone, "doc_id", "left")

    def paragraph(p: Column, i: Column) -> Column:
        return F.filter(p, lambda s, j: ~F.coalesce(F.array_contains("gone", F.struct(i.alias("para_no"), j.alias("sent_no"))), F.lit(False)))

    return kept.select("doc_id", F.filter(F.transform("paragraphs", paragraph), lambda p: F.size(p) > 0).alias("paragraphs"))
