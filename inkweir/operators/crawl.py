"""Finding captures of cited URLs and keeping the right one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkweir.operators.ordered import ordinals


def first_match(index: DataFrame, keys: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """index(by..., status, ...) semi-joined with keys, status 200 only, the first row of each key in
    ``order``. The window keeps one row per key before the shuffle's output (group limit)."""
    useful = index.where("status = 200").join(keys.select(by[-1]).distinct(), by[-1], "left_semi")
    return useful.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_r = 1").drop("_r")


def last_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that is last in ``order``: a maximum over structs, combined before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    top = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(key).agg(top.alias("_t")).select(key, "_t.*")


def chunk_ids(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """Rows with the number of the chunk of ``size`` rows that they fall into, in a global order."""
    return ordinals(rows, order, "_o").withColumn("chunk", F.floor(F.col("_o") / size)).drop("_o")


def next_offsets(offsets: DataFrame) -> DataFrame:
    """offsets(start) to its different values with the next one: (start, end), end null for the last."""
    placed = ordinals(offsets.where("start is not null").distinct(), ["start"], "_o")
    later = placed.select((F.col("_o") - 1).alias("_o"), F.col("start").alias("end"))
    return placed.join(later, "_o", "left").select("start", "end")


def shard(ordinal: Column, n: int) -> Column:
    """Round-robin shard of an ordinal."""
    return F.pmod(ordinal, F.lit(n))
