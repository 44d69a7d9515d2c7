"""Problem 2: fill containers of fixed capacity with items of varying length, leaving little unused.

Best-fit decreasing needs only how many items there are of each length, and lengths are bounded by
the capacity (longer items are cut into full containers and a rest).  So the histogram of lengths, at most one number per
length, goes to the driver, and best-fit decreasing runs on counts there: the tightest open
container is found by a segment tree over remaining capacities, and equal containers are filled
together.  The result is the exact best-fit-decreasing packing of the whole table, as intervals of ranks
within each length.  Items get their rank
by two-level counting and look their place up; their tokens, two bytes each and compressed where that is enough, move once to
their places and once per budget to their containers.

In a container, items are separated by the budget's ``eos_id`` and the rest is filled with its ``pad_id``; ``item_ids`` and
``pieces`` say which items stand in it, in order, and which piece of an item that was cut.

Defined results: null tokens within an item are dropped and padding (id 0) at its ends is stripped; null
and empty items take no place; ties between equal lengths go by a hash of the tokens, then by the id, so the containers do
not depend on how the rows are partitioned; repeated rows are items of their own; budgets with null or non-positive
capacity are left out; ids may be null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.ragged import int_list_array, take_ranges
from tessera.session import cut, spread

PADDING = 0
#: Items of one length ranked together in one task, about; more are ranked in several groups.
RANKED = 500_000


class OpenBins:
    """Segment tree over remaining capacities: how many open containers have each, tightest first."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.tree = [0] * (2 * self.size)
        self.groups: dict[int, list[tuple[int, int, int]]] = {}  # remaining -> (first container, number, items in each)

    def add(self, remaining: int, first: int, number: int, items: int) -> None:
        self.groups.setdefault(remaining, []).append((first, number, items))
        self._count(remaining, number)

    def _count(self, at: int, by: int) -> None:
        i = at + self.size
        while i:
            self.tree[i] += by
            i //= 2

    def tightest(self, need: int) -> int:
        """Smallest remaining capacity of at least ``need`` of an open container; -1 if there is none."""
        if need >= self.size:
            return -1
        i = need + self.size
        if self.tree[i]:
            return need
        while i > 1:  # up until a right neighbour holds something, then down to its first leaf
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return -1

    def take(self, remaining: int) -> tuple[int, int, int]:
        first, number, items = self.groups[remaining].pop()
        self._count(remaining, -number)
        return first, number, items


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing on counts: (length, first rank, items, first container, items of each, place in it).

    Rank i of an interval goes to container ``first + (i - rank) // each`` at ``place + (i - rank) % each``.
    """
    bins, plan, made = OpenBins(capacity), [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            r = bins.tightest(length + 1)
            if r < 0:
                each = 1 + (capacity - length) // (length + 1)
                whole = left // each
                for number, k in ((whole, each), (1, left % each)):
                    if number and k:
                        plan.append((length, rank, number * k, made, k, 0))
                        bins.add(capacity - k * length - (k - 1), made, number, k)
                        made, rank, left = made + number, rank + number * k, left - number * k
                continue
            first, number, items = bins.take(r)
            each = r // (length + 1)
            whole = min(number, left // each)
            if whole:
                plan.append((length, rank, whole * each, first, each, items))
                bins.add(r - each * (length + 1), first, whole, items + each)
                first, number, rank, left = first + whole, number - whole, rank + whole * each, left - whole * each
            if number and left and left < each:
                plan.append((length, rank, left, first, left, items))
                bins.add(r - left * (length + 1), first, 1, items + left)
                first, number, rank, left = first + 1, number - 1, rank + left, 0
            if number:
                bins.add(r, first, number, items)
    return plan


def _stripped(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, lengths) of list rows without null tokens and without padding at their ends."""
    flat = col.flatten()
    row = np.repeat(np.arange(len(col)), np.asarray(col.value_lengths().fill_null(0)))
    valid = np.asarray(flat.is_valid())
    v, row = np.asarray(flat.fill_null(0))[valid].astype(np.int64), row[valid]
    used = np.flatnonzero(v != PADDING)
    lo, hi = np.full(len(col), len(v), np.int64), np.zeros(len(col), np.int64)
    np.minimum.at(lo, row[used], used)
    np.maximum.at(hi, row[used], used + 1)
    lengths = np.maximum(hi - lo, 0)
    return v[take_ranges(lo[lengths > 0], lengths[lengths > 0])], lengths


def _squeezed(tokens: np.ndarray) -> bytes:
    """Tokens as compressed bytes: 2 and two bytes each, or 4 and four bytes each."""
    narrow = not len(tokens) or 0 <= int(tokens.min()) and int(tokens.max()) < 1 << 16
    return (b"2" if narrow else b"4") + pa.compress(tokens.astype("<u2" if narrow else "<i4").tobytes(), "zstd", asbytes=True)


def _unsqueezed(blob: bytes, n: int) -> np.ndarray:
    wide = blob[:1] == b"4"
    return np.frombuffer(pa.decompress(blob[1:], n * (4 if wide else 2), "zstd", asbytes=True), "<i4" if wide else "<u2").astype(np.int32)


def _items(items: DataFrame, tokens: str, item_id: str) -> DataFrame:
    """(rid, item, h, n, blob) of every item with tokens: a row number, its id, a hash of its tokens, their number, the tokens."""
    import xxhash

    kind = items.schema[item_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in (big.slice(i, 1000) for i in range(0, big.num_rows, 1000)):
                v, n = _stripped(b.column(1))
                stop = np.cumsum(n)
                rows = np.flatnonzero(n)
                parts = [v[stop[i] - n[i] : stop[i]] for i in rows.tolist()]
                h = np.array([xxhash.xxh64_intdigest(x.astype("<i4").tobytes()) for x in parts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(h), pa.array(n[rows].astype(np.int32)), pa.array(list(map(_squeezed, parts)), pa.binary())], names=["item", "h", "n", "blob"])

    got = spread(items.select(F.col(item_id).alias("item"), F.col(tokens).cast("array<int>"))).mapInArrow(run, f"item {kind}, h bigint, n int, blob binary")
    return cut(got.select(F.monotonically_increasing_id().alias("rid"), "*"))


def _ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """Adds ``rank``, from 0, within (budget_id, length); ``groups`` parts of one length are ranked on their own and follow each other."""
    pieces = pieces.withColumn("g", F.pmod("h", F.lit(groups)).cast("int"))
    counts = pieces.groupBy("budget_id", "length", "g").agg(F.count("*").alias("c"))
    before = counts.select("budget_id", "length", "g", (F.sum("c").over(W.partitionBy("budget_id", "length").orderBy("g")) - F.col("c")).alias("before"))
    inner = F.row_number().over(W.partitionBy("budget_id", "length", "g").orderBy("h", "item", "piece"))
    return pieces.withColumn("i", inner).join(before, ["budget_id", "length", "g"]).withColumn("rank", F.col("before") + F.col("i") - 1).drop("g", "i", "before")


class Places:
    """Containers and places of ranks within lengths, by a plan of ``best_fit``."""

    def __init__(self, plan: list[tuple[int, int, int, int, int, int]]):
        length, self.rank, _, self.first, self.each, self.at = (np.array(x, np.int64) for x in zip(*sorted(plan)))
        self.lengths, begin = np.unique(length, return_index=True)
        self.bounds = np.append(begin, len(length))

    def __call__(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        container, place = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        which = np.searchsorted(self.lengths, length)
        order = np.argsort(which, kind="stable")
        for k in np.split(order, np.flatnonzero(np.diff(which[order])) + 1) if len(order) else []:
            lo, hi = self.bounds[which[k[0]] : which[k[0]] + 2]
            i = lo + np.searchsorted(self.rank[lo:hi], rank[k], "right") - 1
            d = rank[k] - self.rank[i]
            container[k], place[k] = self.first[i] + d // self.each[i], self.at[i] + d % self.each[i]
        return container, place


def assign(items: DataFrame, budgets: list[tuple[int, int]]) -> DataFrame:
    """(rid, budget_id, piece, length, container, place) of every piece of every item (rid, item, h, n)."""
    spark = items.sparkSession
    caps = F.explode(F.array(*(F.struct(F.lit(b).alias("budget_id"), F.lit(c).alias("capacity")) for b, c in budgets))).alias("b")
    cutting = items.select("rid", "item", "h", "n", caps).select("rid", "item", "h", "n", "b.*")
    pieces = cutting.select("rid", "item", "h", "n", "budget_id", "capacity", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / F.col("capacity")).cast("int"))).alias("piece"))
    pieces = pieces.select("rid", "item", "h", "budget_id", "piece", F.least("capacity", F.col("n") - F.col("piece") * F.col("capacity")).cast("int").alias("length"))
    histogram = pieces.groupBy("budget_id", "length").agg(F.count("*").alias("c")).collect()  # at most one row per budget and length up to its capacity
    plans = {}
    for b, c in budgets:
        plan = best_fit({r["length"]: r["c"] for r in histogram if r["budget_id"] == b}, c)
        plans[b] = Places(plan) if plan else None
    shared = spark.sparkContext.broadcast(plans)  # a few intervals per length
    groups = max(1, -(-max((r["c"] for r in histogram), default=0) // RANKED))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            container, slot = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
            for b, places in shared.value.items():
                k = (p["budget_id"] == b).to_numpy()
                if places is not None and k.any():
                    container[k], slot[k] = places(p["length"].to_numpy()[k].astype(np.int64), p["rank"].to_numpy()[k].astype(np.int64))
            yield pd.DataFrame({"rid": p["rid"], "budget_id": p["budget_id"], "piece": p["piece"], "length": p["length"], "container": container, "place": slot})

    return _ranked(pieces, groups).select("rid", "budget_id", "piece", "length", "rank").mapInPandas(place, "rid bigint, budget_id int, piece int, length int, container bigint, place bigint")


def pack(items: DataFrame, budgets: DataFrame, tokens: str = "tokens", item_id: str = "pack_id") -> DataFrame:
    """(budget_id, container_id, tokens, item_ids, pieces, n_items, used, efficiency) of every container of every budget."""
    wanted = [(r["budget_id"], r["capacity"], r["eos_id"], r["pad_id"]) for r in budgets.where("budget_id is not null and capacity > 0").select("budget_id", "capacity", "eos_id", "pad_id").distinct().collect()]
    kind = items.schema[item_id].dataType.simpleString()
    schema = f"budget_id int, container_id bigint, tokens array<int>, item_ids array<{kind}>, pieces array<int>, n_items int, used int, efficiency double"
    if not wanted:
        return items.sparkSession.createDataFrame([], schema)
    rows = _items(items, tokens, item_id)
    placed = assign(rows.select("rid", "item", "h", "n"), [(b, c) for b, c, _, _ in wanted])
    mine = placed.groupBy("rid").agg(F.collect_list(F.struct("budget_id", "piece", "length", "container", "place")).alias("to"))
    known = {b: (c, e or 0, p or 0) for b, c, e, p in wanted}

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["budget_id", "container", "place", "piece", "length", "item", "blob"]
        for big in batches:
            for b in (big.slice(i, 500) for i in range(0, big.num_rows, 500)):
                to, owner, blobs = b.column(3).flatten(), np.repeat(np.arange(b.num_rows), np.asarray(b.column(3).value_lengths())), []
                n, raw, held = b.column(1).to_pylist(), b.column(2).to_pylist(), (None, None)
                budget, piece, length = (to.field(i).to_pylist() for i in range(3))
                for i, x, k, m in zip(owner.tolist(), budget, piece, length):
                    if m == n[i]:
                        blobs.append(raw[i])
                        continue
                    held = held if held[0] == i else (i, _unsqueezed(raw[i], n[i]))
                    at = k * known[x][0]
                    blobs.append(_squeezed(held[1][at : at + m]))
                yield pa.RecordBatch.from_arrays([to.field(0), to.field(3), to.field(4), to.field(1), to.field(2), b.column(0).take(pa.array(owner)), pa.array(blobs, pa.binary())], names=names)

    part = rows.join(mine, "rid").select("item", "n", "blob", "to").mapInArrow(pieces, f"budget_id int, container bigint, place bigint, piece int, length int, item {kind}, blob binary")
    full = part.groupBy("budget_id", "container").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "length", "item", "blob"))).alias("all"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["budget_id", "container_id", "tokens", "item_ids", "pieces", "n_items", "used", "efficiency"]
        for big in batches:
            for b in (big.slice(i, 500) for i in range(0, big.num_rows, 500)):
                every, count = b.column(2).flatten(), np.asarray(b.column(2).value_lengths()).astype(np.int64)
                piece, length, item, blob = (every.field(i) for i in range(1, 5))
                caps = [known[x] for x in b.column(0).to_pylist()]
                width, size = np.array([c for c, _, _ in caps], np.int64), np.asarray(length).astype(np.int64)
                out = np.repeat(np.array([p for _, _, p in caps], np.int32), width)
                owner, first = np.repeat(np.arange(len(count)), count), np.cumsum(count) - count
                before = np.cumsum(size + 1) - size - 1
                at = (np.cumsum(width) - width)[owner] + before - before[first][owner]
                inner = np.setdiff1d(np.arange(len(owner)), first)
                out[at[inner] - 1] = np.array([e for _, e, _ in caps], np.int32)[owner[inner]]
                for a, n, x in zip(at.tolist(), size.tolist(), blob.to_pylist()):
                    out[a : a + n] = _unsqueezed(x, n)
                used, offsets = np.add.reduceat(size, first) if len(first) else size, pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                lists = [int_list_array(out, width), pa.ListArray.from_arrays(offsets, item), pa.ListArray.from_arrays(offsets, piece)]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *lists, pa.array(count.astype(np.int32)), pa.array(used.astype(np.int32)), pa.array(used / width)], names=names)

    return full.mapInArrow(fill, schema)


def packing_report(items: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per budget: containers, the least number any packing needs, items, tokens, mean and least efficiency."""
    full = pack(items, budgets).join(F.broadcast(budgets.where("capacity > 0").groupBy("budget_id").agg(F.max("capacity").alias("capacity"))), "budget_id")
    return full.groupBy("budget_id").agg(
        F.count("*").alias("containers"), F.ceil((F.sum("used") + F.sum("n_items")) / (F.max("capacity") + 1)).alias("least_containers"), F.sum("n_items").alias("items"), F.sum("used").alias("tokens"),
        F.avg("efficiency").alias("mean_efficiency"), F.min("efficiency").alias("least_efficiency"),
    )
