"""Global running sums without a single ordered task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inkweir.session import cut


def prefix_sums(df: DataFrame, order: list[str], partitions: int | None = None, descending: bool = False, **sums: Column) -> DataFrame:
    """``df`` with one inclusive running sum for each of ``sums`` in the global order of ``order``,
    which must be total for a deterministic result.

    Rows are range-partitioned and materialised, each partition is summed by itself, and partitions
    start from the totals of those before them; only these totals, one row a partition, reach the
    driver. Null values count 0. An empty table gives none.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    valued = df.select("*", *(F.coalesce(v, F.lit(0)).alias(f"_v_{k}") for k, v in sums.items()))
    # materialised first, as the sample for the ranges would run the plan behind it a second time
    ranged = cut(cut(valued).repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id()))
    totals = sorted(ranged.groupBy("_part").agg(*(F.sum(f"_v_{k}").alias(k) for k in sums)).collect(), key=lambda r: r["_part"])
    rows, so_far = [], dict.fromkeys(sums, 0)
    for r in totals:
        rows.append((r["_part"], *(float(so_far[k]) for k in sums)))
        so_far = {k: so_far[k] + (r[k] or 0) for k in sums}
    starts = spark.createDataFrame(rows, T.StructType([T.StructField("_part", T.IntegerType()), *(T.StructField(f"_s_{k}", T.DoubleType()) for k in sums)]))
    w = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kinds = dict(ranged.dtypes)
    summed = ranged.select("*", *(F.sum(f"_v_{k}").over(w).alias(k) for k in sums)).join(F.broadcast(starts), "_part")
    whole = lambda k: kinds[f"_v_{k}"] in ("int", "bigint", "smallint", "tinyint")
    out = [(F.col(k) + (F.col(f"_s_{k}").cast("bigint") if whole(k) else F.col(f"_s_{k}"))).alias(k) for k in sums]
    return summed.select(*df.columns, *out)


def ordinals(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """``df`` with the 0-based place of each row in the global order."""
    return prefix_sums(df, order, **{name: F.lit(1).cast("bigint")}).withColumn(name, F.col(name) - 1)


def runs(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """df(key, order, value) to its runs (key, run, n, first): maximal stretches of rows of a key with the
    same value, in the order of ``order``, which must be unique; run counts from 1, or from 0 if the
    first value is null, n is the number of rows and first their least ``order``.

    Rows of one key are never gathered: each row learns of the one before it by its place in the global
    order, and a running sum numbers the runs, which are counted before they meet in their key's window.
    """
    placed = cut(ordinals(df.select(key, order, value), [key, order], "_o"))
    before = placed.select((F.col("_o") + 1).alias("_o"), F.col(key).alias("_key"), F.col(value).alias("_value"), F.lit(True).alias("_has"))
    told = placed.join(before, "_o", "left")
    inside = F.coalesce("_has", F.lit(False)) & F.col("_key").eqNullSafe(F.col(key))
    starts = F.when(F.when(inside, ~F.col(value).eqNullSafe(F.col("_value"))).otherwise(F.col(value).isNotNull()), 1).otherwise(0)
    marked = told.select(key, order, starts.cast("bigint").alias("_starts"), (~inside).alias("_opens"))
    summed = prefix_sums(marked, [key, order], _run=F.col("_starts") + F.col("_opens").cast("bigint"))
    counted = summed.groupBy(key, "_run").agg(F.count("*").alias("n"), F.min(order).alias("first"), F.max(F.when(F.col("_opens"), F.col("_starts"))).alias("_first"))
    w = Window.partitionBy(key).orderBy("_run")
    return counted.select(key, (F.row_number().over(w) - 1 + F.max("_first").over(w)).cast("bigint").alias("run"), "n", "first")
