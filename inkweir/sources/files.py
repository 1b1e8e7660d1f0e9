"""Files at the edges of a pipeline: JSON lines, dumps, capture indexes, annotation tables, key stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkweir import schemas

# ---------------------------------------------------------------- JSON lines


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, name_pattern: str | None = None, partitions: int | None = None) -> DataFrame:
    """JSON lines with an explicit schema; the codec follows the extension (.gz, .bz2). Broken lines give
    rows of nulls. ``name_pattern`` is a glob on file names. A .gz file is one task: ``partitions``
    spreads what follows."""
    reader = spark.read.schema(schema)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    df = reader.json(path)
    return df.repartition(partitions) if partitions else df


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Articles with references keyed by number."""
    df = read_jsonl(spark, path, schemas.ARTICLES)
    return df.withColumn("references", F.transform_keys("references", lambda k, _: k.cast("int")))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Gold rows with a decided label, 1 or 0."""
    return read_jsonl(spark, path, schemas.GOLD).where("label in (0, 1)")


def write_jsonl(df: DataFrame, path: str, compression: str | None = None, rows_per_file: int | None = None, partition_by: list[str] | None = None) -> None:
    """JSON lines, ``compression`` gzip, bzip2 or none; ``rows_per_file`` cuts files to chunks."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.json(path)


def with_shard(df: DataFrame, pattern: str = r"-(\d+)\.") -> DataFrame:
    """Rows of a file source with the shard number in their file's name; null where there is none."""
    return df.withColumn("shard", F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).try_cast("int"))


# ---------------------------------------------------------------- dumps


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Pages of a MediaWiki XML dump, plain or multistream bz2: (title, page_id, wikitext), without pages
    that lack a title, an id or text. The XML source splits the file by itself, so no offset index is
    needed."""
    revision = T.StructType([T.StructField("text", T.StructType([T.StructField("_VALUE", T.StringType())]))])
    page = T.StructType([T.StructField("title", T.StringType()), T.StructField("id", T.LongType()), T.StructField("revision", revision)])
    pages = spark.read.format("xml").option("rowTag", "page").schema(page).load(path)
    told = pages.select("title", F.col("id").alias("page_id"), F.col("revision.text._VALUE").alias("wikitext"))
    return told.where("trim(title) <> '' and page_id is not null and trim(wikitext) <> ''")


def read_dump_index(spark: SparkSession, path: str) -> DataFrame:
    """Offsets of a dump's members, the number before the first colon of each line: (start)."""
    return spark.read.text(path).select(F.split("value", ":")[0].try_cast("bigint").alias("start")).where("start is not null").distinct()


# ---------------------------------------------------------------- capture index


def read_cdx(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """Lines ``key timestamp {json}`` of capture indexes: (canonical_url, timestamp, status, filename,
    length, offset, file). ``keys(canonical_url)`` keeps only those, before any JSON is parsed."""
    parts = F.split("value", " ", 3)
    lines = spark.read.text(path).select(parts[0].alias("canonical_url"), parts[1].alias("timestamp"), parts[2].alias("_json"), F.col("_metadata.file_name").alias("file"))
    if keys is not None:
        lines = lines.join(keys.select("canonical_url").distinct(), "canonical_url", "left_semi")
    read = lines.withColumn("_j", F.from_json("_json", schemas.CDX_JSON))
    return read.select("canonical_url", "timestamp", F.col("_j.status").try_cast("int").alias("status"), F.col("_j.filename").alias("filename"), F.col("_j.length").try_cast("bigint").alias("length"), F.col("_j.offset").try_cast("bigint").alias("offset"), "file")


# ---------------------------------------------------------------- annotation tables


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with the columns ``Input.json`` and ``Answer.category.label``, the first an embedded JSON
    row: the row with its label (Yes 1, No 0, else -1)."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    label = F.when(F.col("`Answer.category.label`") == "Yes", 1).when(F.col("`Answer.category.label`") == "No", 0).otherwise(-1)
    return rows.select(F.from_json("`Input.json`", schemas.SAMPLE).alias("x"), label.alias("label")).select("x.*", "label")


def write_annotation_tasks(rows: DataFrame, path: str) -> None:
    """rows(json, context, sentence, document) as CSV that ``read_annotations`` can take back."""
    rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True).csv(path)


# ---------------------------------------------------------------- word frequencies


def write_word_frequencies(frequency: DataFrame, stats: DataFrame, path: str) -> None:
    """frequency(word, df) sorted by word, and stats beside it, as two tables."""
    frequency.orderBy("word").write.mode("overwrite").parquet(f"{path}/words")
    stats.write.mode("overwrite").parquet(f"{path}/stats")


def read_word_frequencies(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """What ``write_word_frequencies`` wrote: (frequency, stats)."""
    return spark.read.parquet(f"{path}/words"), spark.read.parquet(f"{path}/stats")


def read_legacy_word_frequencies(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A text file whose first two lines are the number of documents and their mean length, the others
    JSON rows {word, df}: (frequency, stats)."""
    lines = _placed(spark.read.text(path)).where("trim(value) <> ''")
    words = lines.where("value like '{%'").select(F.from_json("value", schemas.WORD_FREQUENCY).alias("x")).select("x.*")
    # the two lines that are no JSON, in the order of the file
    numbers = lines.where("value not like '{%'").agg(F.array_sort(F.collect_list(F.struct("_file", "_block", "_line", F.trim("value").alias("v")))).alias("n"))
    return words, numbers.select(F.get("n", F.lit(0))["v"].try_cast("bigint").alias("n_documents"), F.get("n", F.lit(1))["v"].try_cast("double").alias("avg_length"))


# ---------------------------------------------------------------- key store


def write_store(rows: DataFrame, path: str, key: str = "key", data: str = "data") -> None:
    """rows(key, data) as a store for look-ups: sorted by key within hash partitions, so that statistics
    prune files; a null or empty value is a failed one. Task commits make it all or nothing."""
    kept = rows.select(F.col(key).alias("key"), F.col(data).alias("data")).withColumn("success", F.coalesce(F.col("data") != "", F.lit(False)))
    kept.repartition(F.col("key")).sortWithinPartitions("key").write.mode("overwrite").parquet(path)


def read_store(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """(key, data) of a store, all of it or for keys(key); unknown and failed keys give a null."""
    stored = spark.read.parquet(path)
    found = stored.groupBy("key").agg(F.max_by(F.when(F.col("success"), F.col("data")), F.col("success")).alias("data"))
    return found if keys is None else keys.select("key").distinct().join(found, "key", "left")


def _placed(df: DataFrame) -> DataFrame:
    """Rows of a file source with their place: file, block of the file, and line within the block."""
    return df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))


def last_row_wins(df: DataFrame, key: str) -> DataFrame:
    """One row per key of a multi-file source: that of the last file by path, then the last line of it. A
    maximum over structs, combined before the shuffle, however often a key returns."""
    rest = [c for c in df.columns if c != key]
    top = F.max_by(F.struct(*rest), F.struct("_file", "_block", "_line"))
    return _placed(df).groupBy(key).agg(top.alias("_t")).select(key, "_t.*").select(*df.columns)


def read_views(spark: SparkSession, path: str) -> DataFrame:
    """Views of pages in JSON lines; of several rows of a page the last one counts."""
    return last_row_wins(read_jsonl(spark, path, schemas.VIEWS), "page_id")


def read_category_pages(spark: SparkSession, path: str, category: str) -> DataFrame:
    """(page_id) of the pages that have a category, from JSON lines of all pages' categories."""
    return read_jsonl(spark, path, schemas.CATEGORIES).where(F.array_contains("categories", category)).select("page_id").distinct()


def read_config(spark: SparkSession, path: str) -> dict:
    """A JSON document of parameters."""
    import json

    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def fetch_file(url: str, path: str) -> bool:
    """Fetch a file unless it is there already; returns whether it was fetched. A broken transfer leaves
    nothing behind."""
    import os
    import shutil
    import urllib.request

    if os.path.exists(path):
        return False
    with urllib.request.urlopen(url, timeout=60) as source, open(path + ".part", "wb") as target:
        shutil.copyfileobj(source, target)
    os.replace(path + ".part", path)
    return True


def write_buckets(bucketed: DataFrame, path: str, label: str = "label") -> None:
    """One folder of JSON lines for each bucket, named by its label."""
    bucketed.write.mode("overwrite").partitionBy(label).json(path)


def write_rows_as_files(rows: DataFrame, folder: str, name: str, limit: int) -> int:
    """At most ``limit`` rows (the feature: a sample to look at), each as its own JSON file below a shared
    folder, named by a column and written where the row is; returns how many were written. A name with a
    slash or a null makes no file."""
    import json
    import os
    import re
    from collections.abc import Iterator

    import pandas as pd

    root = re.sub(r"^file:(//)?", "", folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(root, exist_ok=True)
        for batch in batches:
            n = 0
            for key, row in zip(batch["name"], batch["row"]):
                if key is not None and "/" not in key:
                    with open(os.path.join(root, f"{key}.json"), "w", encoding="utf-8") as out:
                        json.dump(json.loads(row), out, ensure_ascii=False, indent=2)
                    n += 1
            yield pd.DataFrame({"n": [n]})

    told = rows.limit(limit).select(F.col(name).cast("string").alias("name"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("row"))
    return told.mapInPandas(run, "n bigint").agg(F.sum("n")).first()[0] or 0
