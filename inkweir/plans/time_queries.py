"""Queries on timestamps (problem 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkweir.operators.timestamps import dated_records, normalise_timestamps
from inkweir.plans.registry import Registry
from inkweir.session import table

registry = Registry()


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_timestamps(dated_records(table(spark, sf_dir, "documents"), table(spark, sf_dir, "refs")), table(spark, sf_dir, "sites"))


@registry.query("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and reference whose date string denotes a date, with its normal form."""
    return _normalised(spark, sf_dir).select("rec_kind", "rec_id", "norm_date")


_PLAIN = r"^(\d{4}-\d{2}-\d{2}|\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z|[12]\d{3}(0[1-9]|1[0-2])([0-2]\d|3[01])\d{6}|\d{10}|\d{13})$"
_PLAIN_SQL = f"""
WITH r AS (SELECT 'document' AS rec_kind, doc_id AS rec_id, trim(date_raw) AS x FROM documents UNION ALL SELECT 'reference', ref_no, trim(date_raw) FROM refs), p AS (SELECT * FROM r WHERE regexp_matches(x, '{_PLAIN}')),
t AS (SELECT *, CASE WHEN length(x) = 10 AND x[5] = '-' THEN strftime(try_strptime(x, '%Y-%m-%d'), '%Y-%m-%d') WHEN length(x) = 20 THEN strftime(try_strptime(x, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%dT%H:%M:%SZ') WHEN length(x) = 14 THEN strftime(try_strptime(x, '%Y%m%d%H%M%S'), '%Y-%m-%dT%H:%M:%SZ')
  ELSE strftime(make_timestamp(CAST(x[1:10] AS BIGINT) * 1000000), '%Y-%m-%dT%H:%M:%SZ') END AS norm_date FROM p)
"""


@registry.query("p1_plain_notations", sql=_PLAIN_SQL + "SELECT rec_kind, rec_id, norm_date FROM t WHERE norm_date IS NOT NULL")
def p1_plain_notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the rows of ``p1_found`` those whose string alone says all: ISO days and UTC times, capture
    stamps and epoch numbers, for which SQL can tell the result too."""
    raw = dated_records(table(spark, sf_dir, "documents"), table(spark, sf_dir, "refs")).where(F.trim("raw").rlike(_PLAIN)).select("rec_kind", "rec_id")
    return p1_found(spark, sf_dir).join(raw, ["rec_kind", "rec_id"])


@registry.query("p1_status_counts")
def p1_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many strings were settled in which way, by kind of record."""
    return _normalised(spark, sf_dir).groupBy("rec_kind", "status").agg(F.count("*").alias("n"))
