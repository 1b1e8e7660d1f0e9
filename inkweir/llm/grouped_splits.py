"""Splits that keep related records together.

Records sharing an entity or a source form groups: connected components of records, each linked to the
smallest one of its entity and of each of its sources; the records of a hot entity or source are joined with
it in parts. Whole groups are then
allocated by a min-cost flow: groups of one size and one label profile (how many of their records had each
split before) are a bundle, bundles flow into the splits at the cost of every record that leaves its
earlier split, a split's deviation from its quota costs more than any such move, and the flow is rounded to
whole groups. The members of a bundle take the splits in the order of a hash.

Sizes: the driver sees bundles, never groups. Different profiles of three counts and a sum up to s number
s^3 / 6, so N records have at most about (8 N)^(3/4) / 6 bundles, some five million for 10^9 records that
were made to have as many as they can; sizes of real groups repeat.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inkweir.operators.graph import connected_components
from inkweir.session import cut, stored

#: Hash buckets by which the members of a bundle are ranked; a task ranks one bucket.
RANK_BUCKETS = 1024
#: Records of one entity or source from which they are joined in parts at least, the parts, and the most keys split.
HOT_ROWS, PARTS, MOST_HOT = 100_000, 64, 200_000
#: Cost of a record above or below a split's quota; a record that leaves its earlier split costs 1.
DEVIATION = 10.0


def same_url(url: Column) -> Column:
    """The form in which two URLs are the same: lower case, without fragment, then without a query
    that starts with utm_, then without trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(url), r"#[\s\S]*$", ""), r"\?utm_[\s\S]*$", ""), r"/+$", "")


def _with_least(rows: DataFrame, key: str, value: str, n_rows: int) -> DataFrame:
    """rows with ``m``, the least ``value`` of their key. Keys with a large share of ``n_rows``, of which
    there can be at most MOST_HOT and whose names are therefore broadcast, are joined in parts."""
    least = rows.groupBy(key).agg(F.min(value).alias("m"), F.count("*").alias("n"))
    hot = F.col("n") >= max(HOT_ROWS, n_rows // MOST_HOT)
    names = F.broadcast(least.where(hot).select(key, F.lit(True).alias("is_hot")))
    part = F.when(F.col("is_hot"), F.pmod(F.xxhash64(value), F.lit(PARTS)).cast("int")).otherwise(0)
    spread = least.select(key, "m", F.explode(F.sequence(F.lit(0), F.when(hot, PARTS - 1).otherwise(0))).alias("part"))
    return rows.join(names, key, "left").withColumn("part", part).join(spread, [key, "part"]).drop("part", "is_hot")


def record_groups(records: DataFrame) -> DataFrame:
    """records(rec_id, entity, sources array<string>) to (rec_id, group_no): records that share a
    non-null entity or a non-null source, directly or through others, have one group, named by its
    smallest rec_id. Records without either, and with null or empty sources, stand alone; records
    without an id are left out; repeated rows give one row; an empty table gives none. Sources go by 128
    bits of hash."""
    short = lambda s: F.struct(F.xxhash64(s).alias("a"), F.xxhash64(F.lit("b"), s).alias("b"))
    sources = F.transform(F.filter(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>"))), lambda s: s.isNotNull()), short)
    told = stored(records.where("rec_id is not null").select("rec_id", F.col("entity"), sources.alias("sources")))
    n = told.count()
    by_entity = _with_least(told.where("entity is not null"), "entity", "rec_id", n).select("rec_id", F.col("m").alias("root"), "sources")
    rooted = stored(by_entity.unionByName(told.where("entity is null").select("rec_id", F.col("rec_id").alias("root"), "sources")))
    cited = stored(rooted.select("root", F.explode("sources").alias("source")).distinct())
    edges = _with_least(cited, "source", "root", cited.count()).where("root <> m").select(F.col("root").alias("u"), F.col("m").alias("v"))
    # one record may stand in several rows with different entities
    same = rooted.groupBy("rec_id").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select(F.col("high").alias("u"), F.col("low").alias("v"))
    roots = connected_components(edges.unionByName(same))
    once = rooted.groupBy("rec_id").agg(F.min("root").alias("root"))
    return once.join(roots.toDF("root", "group_no"), "root", "left").select("rec_id", F.coalesce("group_no", "root").alias("group_no"))


def allocate(bundles: list[tuple[int, tuple[int, ...], int]], shares: dict[str, float], deviation: float = DEVIATION) -> dict[tuple[int, tuple[int, ...]], dict[str, int]]:
    """bundles (size, records of each earlier split in the order of ``shares``, groups) to the number of
    groups of each that each split gets.

    Min-cost flow of records: each record of a group costs, in a split, the share of the group's records
    that were elsewhere, and ``deviation`` for each record by which a split is above or below its quota.
    Groups that exceed a split's whole quota cost as much as they exceed it by there. As only the splits
    are shared by bundles, shortest augmenting paths run over the splits alone, with a heap for each pair
    of splits, as long as a path costs less than the deviation it takes away. The flow is rounded down to
    whole groups; the rest, fewer groups a bundle than there are splits, go largest first to where the
    deviation grows least.
    """
    names = list(shares)
    total = sum(size * n for size, _, n in bundles)
    quota = {s: shares[s] * total for s in names}
    flow = {(b, s): 0.0 for b in range(len(bundles)) for s in names}
    load = dict.fromkeys(names, 0.0)

    def cost(b: int, s: str) -> float:
        size, profile, _ = bundles[b]
        return 1 - profile[names.index(s)] / size + 2 * deviation * max(0.0, size - quota[s]) / size

    heaps: dict[tuple[str, str], list] = {(s, t): [] for s in names for t in names if s != t}

    def put(b: int, s: str, amount: float) -> None:
        fresh = flow[b, s] <= 1e-9
        flow[b, s] += amount
        load[s] += amount
        if fresh:
            for t in names:
                if t != s:
                    heapq.heappush(heaps[s, t], (cost(b, t) - cost(b, s), b))

    for b, (size, _, n) in enumerate(bundles):
        put(b, min(names, key=lambda s: cost(b, s)), size * n)

    def cheapest(s: str, t: str) -> tuple[float, int] | None:
        heap = heaps[s, t]
        while heap and flow[heap[0][1], s] <= 1e-9:
            heapq.heappop(heap)
        return heap[0] if heap else None

    while True:
        over = [s for s in names if load[s] > quota[s] + 1e-6]
        under = [s for s in names if load[s] < quota[s] - 1e-6]
        if not over or not under:
            break
        far = {s: (0.0 if s in over else float("inf"), None) for s in names}
        for _ in names:  # Bellman-Ford over the splits
            for (s, t) in heaps:
                if far[s][0] < float("inf") and (arc := cheapest(s, t)) and far[s][0] + arc[0] < far[t][0] - 1e-9:
                    far[t] = (far[s][0] + arc[0], (s, arc[1]))
        goal = min(under, key=lambda t: far[t][0])
        if far[goal][0] >= 2 * deviation:
            break  # what is moved costs more than the deviation of both ends
        path, at = [], goal
        while far[at][1] is not None and len(path) <= len(names):
            path.append((far[at][1][0], at, far[at][1][1]))
            at = far[at][1][0]
        push = min([load[at] - quota[at], quota[goal] - load[goal], *(flow[b, s] for s, _, b in path)])
        for s, t, b in path:
            flow[b, s] -= push
            load[s] -= push
            put(b, t, push)
    whole = {}
    load = dict.fromkeys(names, 0)
    rest = []
    for b, (size, profile, n) in enumerate(bundles):
        whole[size, profile] = {s: int((flow[b, s] + 1e-6) // size) for s in names}
        for s in names:
            load[s] += whole[size, profile][s] * size
        rest += [(size, profile)] * (n - sum(whole[size, profile].values()))
    for size, profile in sorted(rest, key=lambda x: (-x[0], x[1])):
        grown = lambda s: deviation * (abs(load[s] + size - quota[s]) - abs(load[s] - quota[s]))  # noqa: B023, E731
        best = min(names, key=lambda s: grown(s) + size - profile[names.index(s)])
        whole[size, profile][best] += 1
        load[best] += size
    return whole


def split_groups(groups: DataFrame, labels: DataFrame, shares: dict[str, float] | None = None, seed: str = "split") -> DataFrame:
    """groups(rec_id, group_no) and labels(rec_id, label), the earlier split of each record, to
    (rec_id, group_no, split): whole groups, shares as close as they allow. Null labels, and such that name
    no split, are at home nowhere. Deterministic for a seed. An empty table gives no rows."""
    shares = shares or {"train": 0.8, "valid": 0.1, "test": 0.1}
    names = list(shares)
    groups = groups.select("rec_id", "group_no")
    once = labels.groupBy("rec_id").agg(F.min("label").alias("label"))
    told = groups.join(once, "rec_id", "left")
    counted = F.array(*(F.count_if(F.col("label") == s) for s in names))
    sized = told.groupBy("group_no").agg(F.count("*").alias("size"), counted.alias("profile"))
    h = F.xxhash64(F.lit(seed), "group_no")
    sized = cut(sized.select("group_no", "size", "profile", h.alias("h"), F.pmod(F.shiftright(h, 20), F.lit(RANK_BUCKETS)).alias("bucket")))
    filled = sized.groupBy("size", "profile", "bucket").agg(F.count("*").alias("n"))
    bundles = filled.groupBy("size", "profile").agg(F.sum("n").alias("n")).collect()
    plan = allocate(sorted((r["size"], tuple(r["profile"]), r["n"]) for r in bundles), shares)
    rows = [(size, list(profile), [sum(n[s] for s in names[: i + 1]) for i in range(len(names))]) for (size, profile), n in plan.items()]
    limits = groups.sparkSession.createDataFrame(rows, T.StructType([T.StructField("size", T.LongType()), T.StructField("profile", T.ArrayType(T.LongType())), T.StructField("limits", T.ArrayType(T.LongType()))]))
    before = filled.withColumn("before", F.sum("n").over(Window.partitionBy("size", "profile").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)))
    ranked = sized.withColumn("rank", F.row_number().over(Window.partitionBy("size", "profile", "bucket").orderBy("h", "group_no")))
    placed = ranked.join(before.drop("n"), ["size", "profile", "bucket"]).join(limits, ["size", "profile"])
    rank = F.coalesce("before", F.lit(0)) + F.col("rank")
    split = F.get(F.array(*map(F.lit, names)), F.size(F.filter("limits", lambda x: x < rank)))
    return groups.join(placed.select("group_no", split.alias("split")), "group_no").select("rec_id", "group_no", "split")
