"""Filling containers of fixed capacity with texts of varying length.

Lengths are tokens of a public tokenizer. Texts stay whole unless they exceed the largest capacity
allowed; then full containers are cut off and the rest is packed like any text. Packing is best-fit
decreasing over the histogram of lengths: all items of one length are placed together into containers
of one state, always those with the least room that still holds the item, so that the driver handles
lengths and container states, never texts. With several permitted capacities each new container is opened
at the capacity of least cost for what is then left: each capacity is filled in thought with the lengths
that remain, largest first, and downsized to what it holds, and the one with the fewest tokens paid for a
token stored is opened, as often as the lengths counted on for it last. In the end every container is
downsized to the smallest capacity that holds its contents.

Sizes: the histogram has at most one row per length up to the largest capacity. Texts take their places
by their rank among those of their length, counted through hash buckets, so that no task ranks a length
alone.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from inkweir.session import cut

RANK_BUCKETS = 1024
_ENCODERS: dict = {}

#: How the splitter of a rank file cuts text before its merges (fixed value of the vocabulary).
PRETOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    """Path of the vocabulary file used where none is given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _encoder(path: str):  # noqa: ANN202
    if path not in _ENCODERS:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        _ENCODERS[path] = tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def token_counts(documents: DataFrame, tokenizer: str) -> DataFrame:
    """documents(doc_id, text) to (doc_id, n_tokens). A null text counts 0; texts are counted whole."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(tokenizer).encode_ordinary
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_tokens": np.fromiter((len(encode(t)) if t else 0 for t in batch["text"]), np.int64, len(batch))})

    return documents.select("doc_id", "text").where("doc_id is not null").mapInPandas(count, "doc_id bigint, n_tokens bigint")


class Packing:
    """Containers in groups of equal content: groups[g] = (number, room left, {length: items in each})."""

    def __init__(self, histogram: dict[int, int], capacities: list[int]) -> None:
        self.capacities = sorted(capacities)
        self.groups: list[list] = []
        #: length -> [(first rank, items per container, group)], ranks in the order of packing
        self.places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        by_room: dict[int, list[int]] = defaultdict(list)  # room left -> groups
        sizes = sorted(s for s in histogram if s > 0)
        for at in range(len(sizes) - 1, -1, -1):
            size = sizes[at]
            left, rooms = histogram[size], sorted(r for r in by_room if r >= size and by_room[r])
            rank = 0
            for room in rooms:
                while left and by_room[room]:
                    g = by_room[room].pop()
                    number = self.groups[g][0]
                    each = min(room // size, left)
                    used = min(number, left // each)
                    if used < number:  # the rest of the group stays as it was
                        self._split(g, used, by_room)
                    self._fill(g, size, each, rank, by_room)
                    rank += used * each
                    left -= used * each
            while left:
                capacity, each, used = self._cheapest(sizes, at, left, histogram)
                self.groups.append([used, capacity, {}, capacity])
                self._fill(len(self.groups) - 1, size, each, rank, by_room)
                rank += used * each
                left -= used * each

    def _cheapest(self, sizes: list[int], at: int, left: int, histogram: dict[int, int]) -> tuple[int, int, int]:
        """(capacity, items of length sizes[at] in each, containers) to open next, ``left`` items of that
        length and all shorter ones being left."""
        best = None
        for capacity in (c for c in self.capacities if c >= sizes[at]):
            room, k, number, each = capacity, at, None, 0
            while k >= 0 and room:
                k = min(k, bisect_right(sizes, room) - 1)
                if k < 0:
                    break
                stock = left if k == at else histogram[sizes[k]]
                n = min(room // sizes[k], stock)
                if n:
                    room -= n * sizes[k]
                    number = stock // n if number is None else min(number, stock // n)
                    each = n if k == at else each
                k -= 1
            held = capacity - room
            paid = min(c for c in self.capacities if c >= held)
            if best is None or (paid / held, -capacity) < best[0]:
                best = ((paid / held, -capacity), (capacity, each, number if len(self.capacities) > 1 else left // each))
        return best[1]

    def _split(self, g: int, used: int, by_room: dict) -> None:
        number, room, content, capacity = self.groups[g]
        self.groups[g][0] = used
        self.groups.append([number - used, room, dict(content), capacity])
        new = len(self.groups) - 1
        for length in content:  # the split-off containers are the last of the group
            for k, (first, each, group) in enumerate(list(self.places[length])):
                if group == g:
                    self.places[length].append((first + used * each, each, new))
        by_room[room].append(new)

    def _fill(self, g: int, size: int, each: int, rank: int, by_room: dict) -> None:
        group = self.groups[g]
        group[1] -= each * size
        group[2][size] = group[2].get(size, 0) + each
        self.places[size].append((rank, each, g))
        by_room[group[1]].append(g)

    def capacity_of(self, g: int) -> int:
        """The smallest capacity that holds the group's contents."""
        used = sum(n * s for s, n in self.groups[g][2].items())
        return min(c for c in self.capacities if c >= used)

    @property
    def cost(self) -> int:
        return sum(self.groups[g][0] * self.capacity_of(g) for g in range(len(self.groups)))

    @property
    def containers(self) -> int:
        return sum(g[0] for g in self.groups)

    def segments(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, first rank, end rank, items per container, number of the first container, capacity)."""
        starts = np.concatenate([[0], np.cumsum([g[0] for g in self.groups])[:-1]]) if self.groups else []
        return [(size, first, first + each * self.groups[g][0], each, int(starts[g]), self.capacity_of(g)) for size, rows in self.places.items() for first, each, g in rows]


def pack_histogram(histogram: dict[int, int], capacities: list[int]) -> Packing:
    """The packing of items by length into containers of one or several capacities."""
    return Packing(histogram, capacities)


def _pieces(counts: DataFrame, capacity: int) -> DataFrame:
    """counts(doc_id, n_tokens) to (doc_id, piece_no, start_token, n): one piece unless a text exceeds the
    capacity; then full ones and the rest."""
    last = F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / capacity) - 1)
    each = counts.select("doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))).alias("piece_no"))
    start = F.col("piece_no") * capacity
    return each.select("doc_id", "piece_no", start.alias("start_token"), F.least(F.lit(capacity).cast("bigint"), F.col("n_tokens") - start).alias("n"))


def _ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """pieces with their rank among those of the same length, and the histogram of lengths."""
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(RANK_BUCKETS)))
    filled = cut(bucketed.groupBy("n", "bucket").agg(F.count("*").alias("m")))
    histogram = {r["n"]: r["m"] for r in filled.groupBy("n").agg(F.sum("m").alias("m")).collect()}
    before = filled.withColumn("before", F.coalesce(F.sum("m").over(Window.partitionBy("n").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("m")
    within = F.row_number().over(Window.partitionBy("n", "bucket").orderBy("doc_id", "piece_no")) - 1
    return bucketed.withColumn("within", within).join(before, ["n", "bucket"]).withColumn("rank", F.col("before") + F.col("within")).drop("bucket", "before", "within"), histogram


def assign(counts: DataFrame, capacities: list[int]) -> DataFrame:
    """counts(doc_id, n_tokens) to (doc_id, piece_no, start_token, n_tokens, container_no, capacity), one
    row per piece, container_no from 0. All permitted capacities are used jointly; with one, that alone.

    Texts without tokens go to the containers in turn, or to one if there are none; repeated doc_ids are
    packed once; no documents give no rows.
    """
    spark = counts.sparkSession
    ranked, histogram = _ranked(_pieces(counts.dropDuplicates(["doc_id"]), max(capacities)))
    packing = pack_histogram(histogram, capacities)
    rows = packing.segments()
    total = max(1, packing.containers)
    if histogram.get(0):
        # every container takes `each` of the texts without tokens, as far as they go
        each = -(-histogram[0] // total)
        ends = np.cumsum([g[0] for g in packing.groups]) if packing.groups else np.array([1])
        starts = np.concatenate([[0], ends[:-1]])
        caps = [packing.capacity_of(g) for g in range(len(packing.groups))] or [min(capacities)]
        rows += [(0, int(a) * each, int(b) * each, each, int(a), c) for a, b, c in zip(starts, ends, caps)]
    if not rows:
        rows = [(-1, 0, 0, 1, 0, capacities[0])]
    fields = ["n", "first", "end", "each", "container", "capacity"]
    places = spark.createDataFrame(pd.DataFrame(rows, columns=fields), T.StructType([T.StructField(f, T.LongType()) for f in fields]))
    # the driver made these rows, a few for each length, so that they may be sent
    segment = F.broadcast(places.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("first", "end", "each", "container", "capacity"))).alias("segments")))
    found = ranked.join(segment, "n").withColumn("at", F.get(F.filter("segments", lambda s: (s["first"] <= F.col("rank")) & (F.col("rank") < s["end"])), F.lit(0)))
    number = F.col("at.container") + F.floor((F.col("rank") - F.col("at.first")) / F.col("at.each"))
    return found.select("doc_id", "piece_no", "start_token", F.col("n").alias("n_tokens"), number.alias("container_no"), F.col("at.capacity").alias("capacity"))


def assign_each(documents: DataFrame, containers: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """An assignment of all documents for every row of containers(container_kind, capacity) by itself:
    (container_kind, capacity, container_no, doc_id, piece_no, start_token, n_tokens). Null and
    non-positive capacities are left out; containers is a table of a few kinds, read by the driver."""
    return _each(cut(token_counts(documents, tokenizer or default_tokenizer())), containers)


def _each(counts: DataFrame, containers: DataFrame) -> DataFrame:
    kinds = containers.where("capacity > 0").select("container_kind", F.col("capacity").cast("bigint").alias("capacity")).distinct().orderBy("capacity", "container_kind").collect()
    out = None
    for kind in kinds:
        rows = assign(counts, [kind["capacity"]]).select(F.lit(kind["container_kind"]).alias("container_kind"), "capacity", "container_no", "doc_id", "piece_no", "start_token", "n_tokens")
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = counts.where("false").select(F.lit(None).cast("string").alias("container_kind"), F.lit(0).cast("bigint").alias("capacity"), F.lit(0).cast("bigint").alias("container_no"), "doc_id", F.lit(0).cast("bigint").alias("piece_no"), F.lit(0).cast("bigint").alias("start_token"), "n_tokens")
    return out


def assign_jointly(documents: DataFrame, containers: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """One assignment of all documents to containers of all permitted capacities together; columns as in
    ``assign_each``."""
    return _jointly(cut(token_counts(documents, tokenizer or default_tokenizer())), containers)


def _jointly(counts: DataFrame, containers: DataFrame) -> DataFrame:
    kinds = containers.where("capacity > 0").groupBy(F.col("capacity").cast("bigint").alias("capacity")).agg(F.min("container_kind").alias("container_kind"))
    capacities = [r["capacity"] for r in kinds.collect()]
    if not capacities:
        return _each(counts, containers.where("false"))
    return assign(counts, capacities).join(F.broadcast(kinds), "capacity").select("container_kind", "capacity", "container_no", "doc_id", "piece_no", "start_token", "n_tokens")


def assign_both(documents: DataFrame, containers: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The assignments of ``assign_each`` (way each) and of ``assign_jointly`` (way joint), texts being
    measured once."""
    counts = cut(token_counts(documents, tokenizer or default_tokenizer()))
    return _each(counts, containers).withColumn("way", F.lit("each")).unionByName(_jointly(counts, containers).withColumn("way", F.lit("joint")))
