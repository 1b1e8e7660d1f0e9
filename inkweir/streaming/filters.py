"""Streams of instances and captures: the same filters as in batch, with bounded state."""

from __future__ import annotations

import json
from collections.abc import Iterable
from itertools import islice
from typing import TextIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from inkweir import schemas
from inkweir.functions.language import Profiles, languages_of
from inkweir.functions.text import flat_text


def keep_english(instances: DataFrame, profiles: Profiles) -> DataFrame:
    """instances(documents[{paragraphs}]) without documents in other languages, and without instances that
    keep none; a document without text has no language. Stateless, so it runs on streams and tables alike."""
    told = languages_of(F.transform("documents", lambda d: flat_text(d["paragraphs"])), profiles)
    kept = F.filter(F.arrays_zip(F.col("documents").alias("d"), F.col("_languages").alias("l")), lambda x: F.coalesce(x["l"] == "en", F.lit(False)))
    filtered = instances.withColumn("_languages", told).withColumn("documents", F.transform(kept, lambda x: x["d"])).drop("_languages")
    return filtered.where(F.size("documents") > 0)


def stream_jsonl(spark: SparkSession, folder: str, schema: T.StructType, files_per_trigger: int = 100) -> DataFrame:
    """A stream of the JSON-lines files that arrive in a folder, so many a trigger: the throttle of a feed."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def filter_lines(spark: SparkSession, source: Iterable[str], sink: TextIO, profiles: Profiles, batch: int = 10_000, report: TextIO | None = None) -> tuple[int, int]:
    """``keep_english`` between a process's input and output: JSON lines of instances in, those kept out,
    in their order, with all their fields. Lines are taken ``batch`` at a time, which bounds what the
    driver holds; broken lines are dropped. Returns how many came and went."""
    came = went = 0
    lines = iter(source)
    while part := list(islice(lines, batch)):
        told = spark.createDataFrame(list(enumerate(part)), "place bigint, line string")
        read = told.withColumn("x", F.from_json("line", schemas.INSTANCES)).select("place", "line", "x.documents")
        none = F.array().cast(read.schema["documents"].dataType)
        # the documents of a line keep fields that the schema doesn't name: they are chosen by their place
        numbered = read.withColumn("documents", F.transform(F.coalesce("documents", none), lambda d, i: d.withField("offset", i)))
        kept = keep_english(numbered, profiles).select("line", "place", F.transform("documents", lambda d: d["offset"]).alias("at")).orderBy("place")
        for row in kept.toLocalIterator():
            data = json.loads(row["line"])
            data["documents"] = [data["documents"][i] for i in row["at"]]
            sink.write(json.dumps(data, ensure_ascii=False) + "\n")
            went += 1
        came += len(part)
        if report:
            print(f"{went} of {came} kept", file=report, flush=True)
    return came, went


def first_captures(captures: DataFrame, late: str = "1 day") -> DataFrame:
    """captures(canonical_url, fetched_at timestamp, ...) with the first arrival of each URL within the
    watermark; keys older than it leave the state."""
    return captures.withWatermark("fetched_at", late).dropDuplicatesWithinWatermark(["canonical_url"])


def captures_per_window(captures: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """captures(site, fetched_at timestamp) to counts per site and tumbling window of event time."""
    counted = captures.withWatermark("fetched_at", late).groupBy(F.window("fetched_at", window).alias("w"), "site").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "site", "n")


def run_once(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain a stream into Parquet and stop; run again, it continues where it stopped."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query
