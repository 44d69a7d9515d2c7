"""Problem 1: train, validation and test splits that keep related records together.

Records are related if they name the same commit or the same file, however written, or are linked so
through others.  Their components are found on the commits alone (a file ties all its commits to the
smallest of them).  Splits then come from a component swap search: every component starts in the split
its hash says, and annealing moves single components or exchanges two of them to reduce the deviation of
record numbers and of label numbers from the wanted proportions.  Components are dealt to shards of
bounded size that are annealed in parallel, several times from different seeds, and the best run of
each shard is kept.  Components too large for a shard, of which there can be only ``1 / GIANT`` at
most, are placed first; the shards aim at what these leave.

Defined results: null, empty and filler commits and paths link nothing; a short hash that starts no
commit, or several, links nothing; rows that name neither are groups of their own (no row in
``related_groups``, a split by hash of the id in ``group_split``); a group that names files only has
a null group_id; repeated rows give repeated results; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math
import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.components import components
from tessera.operators.joins import lookup
from tessera.session import cut

#: Strings that stand for a missing commit or path (fixed values).
FILLERS = ("", "unknown", "none", "null", "nil", "nan", "n/a", "na", "-", "?", "undefined", "(none)", "(null)", "/dev/null")
#: Where collectors check a repository out; removed from the front of paths (a fixed pattern).
CHECKOUT = r"^/checkout/[^/]+/"
PROPORTIONS = {"train": 0.8, "val": 0.1, "test": 0.1}
GIANT = 0.005
SHARD_GROUPS = 4_000
REPLICAS = 3
STEPS_PER_GROUP = 4
_BLANK = r"^[\s ​﻿]+|[\s ​﻿]+$"


def commit_name(c: Column) -> Column:
    """The hash a value names, in lower case and maybe short; null if it names none."""
    t = F.regexp_replace(F.lower(F.regexp_replace(c, _BLANK, "")), r"^commit[\s:]+", "")
    return F.when(t.rlike(r"^[0-9a-f]{6,40}$") & ~t.rlike(r"^0+$"), t)


def file_place(p: Column, checkout: str = CHECKOUT) -> Column:
    """Place of a file in its repository, however the path is written; null if it names none."""
    t = F.translate(F.regexp_replace(p, _BLANK, ""), "\\", "/")
    t = F.regexp_replace(F.regexp_replace(t, checkout, ""), r"^/+", "")
    parts = F.filter(F.split(t, "/"), lambda x: (x != "") & (x != "."))
    walked = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x != "..", F.concat(acc, F.array(x))).otherwise(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))),
    )
    plain = F.array_join(F.when(F.array_contains(parts, ".."), walked).otherwise(parts), "/")
    plain = F.regexp_replace(plain, r"^[ab]/(?=.)", "")
    return F.when(~F.lower(F.regexp_replace(p, _BLANK, "")).isin(*FILLERS) & (plain != ""), plain)


def _full_hashes(named: DataFrame, commits: DataFrame) -> DataFrame:
    """(c, full): the one commit of each distinct name; full hashes stand for themselves."""
    names = named.select("c").where("c is not null").distinct()
    short = names.where("length(c) < 40").withColumn("k", F.substring("c", 1, 6))
    full = commits.select(F.lower(F.trim("hash")).alias("h")).where("h is not null").distinct().withColumn("k", F.substring("h", 1, 6))
    found = short.join(full, "k").where(F.col("h").startswith(F.col("c"))).groupBy("c").agg(F.count("*").alias("n"), F.min("h").alias("full")).where("n = 1").select("c", "full")
    return names.where("length(c) = 40").select("c", F.col("c").alias("full")).unionAll(found)


def _links(examples: DataFrame, commits: DataFrame) -> DataFrame:
    """(example_id, label, c, f): each row with the full commit (20 bytes) and file it names."""
    raw = examples.withColumn("c", commit_name(F.col("commit_hash"))).withColumn("f", file_place(F.col("file_path"))).select("example_id", "label", "c", "f")
    whole = raw.where("c is null or length(c) = 40")
    short = raw.where("length(c) < 40")
    solved = short.join(_full_hashes(short, commits), "c", "left").select("example_id", "label", F.col("full").alias("c"), "f")
    return whole.unionAll(solved).withColumn("c", F.unhex("c"))


def _grouped(examples: DataFrame, commits: DataFrame) -> DataFrame:
    """(example_id, label, root): root is the smallest commit of the group, or a file or row that no commit shares."""
    links = cut(_links(examples, commits))
    files = links.where("f is not null and c is not null").groupBy("f").agg(F.min("c").alias("least"))
    total = links.count()
    edges = lookup(links.where("f is not null and c is not null").select("c", "f").distinct(), files, "f", total).select(F.col("c").alias("u"), F.col("least").alias("v"))
    roots = components(edges)
    named = links.where("c is not null").select("example_id", "label", F.col("c").alias("key"))
    fileless = lookup(links.where("c is null and f is not null"), files, "f", total, "left").select("example_id", "label", F.coalesce("least", F.concat(F.lit(b"file:"), F.encode("f", "utf-8"))).alias("key"))
    alone = links.where("c is null and f is null").select("example_id", "label", F.concat(F.lit(b"row:"), F.encode(F.col("example_id").cast("string"), "utf-8")).alias("key"))
    keyed = named.unionAll(fileless).unionAll(alone)
    return lookup(keyed, roots.withColumnRenamed("node", "key"), "key", total, "left").select("example_id", "label", F.coalesce("root", "key").alias("root"))


def anneal(groups: list[dict[str, int]], start: list[int], want: list[dict[str, float]], seed: int, steps: int) -> tuple[list[int], float]:
    """Component swap search over label counts; returns the best assignment met and its cost.

    The cost is the summed deviation of record numbers plus that of label numbers.  Labels and the
    total are treated alike: the total is a label named '' that every group carries.
    """
    rng = random.Random(seed)
    k, n = len(want), len(groups)
    rows = [{**g, "": sum(g.values())} for g in groups]
    have = [dict.fromkeys(w, 0.0) for w in want]
    at = list(start)
    for g, s in zip(rows, at):
        for label, c in g.items():
            have[s][label] = have[s].get(label, 0.0) + c
    cost = sum(abs(have[s].get(x, 0.0) - want[s].get(x, 0.0)) for s in range(k) for x in {*have[s], *want[s]})
    best, best_at, since = cost, list(at), []
    if n < 1 or k < 2:
        return best_at, best
    heat = max(1.0, cost / n)
    cool = (0.05 / heat) ** (1 / max(1, steps))

    def change(g: dict[str, int], a: int, b: int) -> float:
        d = 0.0
        for x, c in g.items():
            pa, pb = have[a].get(x, 0.0) - want[a].get(x, 0.0), have[b].get(x, 0.0) - want[b].get(x, 0.0)
            d += abs(pa - c) - abs(pa) + abs(pb + c) - abs(pb)
        return d

    def shift(g: dict[str, int], a: int, b: int) -> None:
        for x, c in g.items():
            have[a][x] = have[a].get(x, 0.0) - c
            have[b][x] = have[b].get(x, 0.0) + c

    for _ in range(steps):
        i = rng.randrange(n)
        a, b = at[i], rng.randrange(k)
        heat *= cool
        if a == b:
            continue
        j = rng.randrange(n) if rng.random() < 0.5 else -1
        if j >= 0 and (j == i or at[j] != b):
            j = -1
        d = change(rows[i], a, b)
        shift(rows[i], a, b)
        if j >= 0:  # an exchange: a component of the other split comes back
            d += change(rows[j], b, a)
            shift(rows[j], b, a)
        if d > 0 and rng.random() >= math.exp(-d / heat):
            shift(rows[i], b, a)
            if j >= 0:
                shift(rows[j], a, b)
            continue
        at[i] = b
        since.append((i, b))
        if j >= 0:
            at[j] = a
            since.append((j, a))
        cost += d
        if cost < best - 1e-9:
            for x, y in since:
                best_at[x] = y
            since.clear()
            best = cost
    return best_at, best


def _hashed(seed: int, key: bytes, shares: list[float]) -> int:
    """Split that the hash of a component says."""
    import xxhash

    u, total = xxhash.xxh64_intdigest(key, seed & 0xFFFFFFFF) / 2**64, 0.0
    for s, share in enumerate(shares):
        total += share
        if u < total:
            return s
    return len(shares) - 1


def _assignments(stats: DataFrame, proportions: dict[str, float], seed: int) -> tuple[DataFrame, DataFrame | None]:
    """(root, split) of the components dealt to shards and of the giants (at most ``1 / GIANT``, None if there are none), from the
    record numbers of each component by label (root, label, n)."""
    spark = stats.sparkSession
    names = list(proportions)
    total = sum(proportions.values())
    shares = [proportions[x] / total for x in names]
    sizes = stats.groupBy("root").agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("counts"))
    sizes = cut(sizes)
    by_label = {r["label"]: r["n"] for r in stats.groupBy("label").agg(F.sum("n").alias("n")).collect()}
    everything = sum(by_label.values())
    n_groups = sizes.count()
    limit = max(1.0, GIANT * everything)
    giants = sorted(sizes.where(F.col("size") > limit).collect(), key=lambda r: (-r["size"], bytes(r["root"])))  # at most 1 / GIANT rows
    left = [{x: share * c for x, c in {**by_label, "": everything}.items()} for share in shares]
    placed: list[tuple[bytearray, str]] = []
    for r in giants:  # largest first, to the split whose wanted numbers it overruns least
        g = {**r["counts"], "": r["size"]}
        over = [sum(max(0.0, c - left[s].get(x, 0.0)) for x, c in g.items()) for s in range(len(names))]
        first = _hashed(seed, bytes(r["root"]), shares)
        s = min(range(len(names)), key=lambda s: (over[s], s != first))
        for x, c in g.items():
            left[s][x] = left[s].get(x, 0.0) - c
        placed.append((r["root"], names[s]))
    rest = sizes.where(F.col("size") <= limit)
    shards = max(1, -(-(n_groups - len(giants)) // SHARD_GROUPS))
    wanted = [{x: max(0.0, v) for x, v in w.items()} for w in left]
    sums = {x: sum(w.get(x, 0.0) for w in wanted) or 1.0 for x in {*by_label, ""}}
    aim = [{x: v / sums[x] for x, v in w.items()} for w in wanted]  # share of each label's rest that each split takes

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        shard, replica = int(key[0]), int(key[1])
        pdf = pdf.sort_values("root")
        groups = [dict(c) for c in pdf["counts"]]
        mine: dict[str, float] = {}
        for g in groups:
            for x, c in g.items():
                mine[x] = mine.get(x, 0.0) + c
        mine[""] = sum(mine.values())
        want = [{x: aim[s].get(x, 0.0) * c for x, c in mine.items()} for s in range(len(names))]
        start = [_hashed(seed, bytes(r), shares) for r in pdf["root"]]
        at, cost = anneal(groups, start, want, seed * 1_000_003 + 97 * shard + replica, max(2_000, STEPS_PER_GROUP * len(groups)))
        return pd.DataFrame({"root": pdf["root"], "split": [names[s] for s in at], "cost": cost, "replica": replica})

    dealt = rest.select("root", "counts", F.pmod(F.xxhash64("root"), F.lit(shards)).cast("int").alias("shard"), F.explode(F.sequence(F.lit(1), F.lit(REPLICAS))).alias("replica"))
    found = dealt.groupBy("shard", "replica").applyInPandas(run, "root binary, split string, cost double, replica int")
    best = found.groupBy("root").agg(F.min_by("split", F.struct("cost", "replica")).alias("split"))
    return best, spark.createDataFrame(placed, "root binary, split string") if placed else None


def group_split(examples: DataFrame, commits: DataFrame, proportions: dict[str, float] | None = None, label: str = "chunk_type", seed: int = 7) -> DataFrame:
    """(example_id, group_id, split): related records share a split; group_id is the smallest full
    commit hash of the group, null where it names no commit."""
    rows = examples.select("example_id", "commit_hash", "file_path", F.coalesce(F.col(label).cast("string"), F.lit("∅")).alias("label"))
    keyed = cut(_grouped(rows, commits))
    stats = keyed.groupBy("root", "label").agg(F.count("*").alias("n"))
    split, giants = _assignments(stats, proportions or PROPORTIONS, seed)
    # a giant component is no key of a shuffle: all its rows get their split where they are
    placed = keyed.join(split, "root") if giants is None else keyed.join(F.broadcast(giants), "root").unionByName(keyed.join(F.broadcast(giants.select("root")), "root", "left_anti").join(split, "root"))
    return placed.select("example_id", F.when(F.length("root") == 20, F.lower(F.hex("root"))).alias("group_id"), "split", "label", "root")


def related_groups(examples: DataFrame, commits: DataFrame) -> DataFrame:
    """(example_id, group_id) of every row that names a commit or a file, from the split operator."""
    got = group_split(examples, commits)
    return got.where(~F.col("root").startswith(F.lit(b"row:"))).select("example_id", "group_id")


def split_rows(examples: DataFrame, commits: DataFrame) -> DataFrame:
    return group_split(examples, commits).select("example_id", "group_id", "split")


def split_report(examples: DataFrame, commits: DataFrame, proportions: dict[str, float] | None = None) -> DataFrame:
    """Per split: records, groups, share reached, share wanted, and the largest deviation of a label's share."""
    proportions = proportions or PROPORTIONS
    got = cut(group_split(examples, commits, proportions).select("split", "label", "root"))
    total = sum(proportions.values())
    want = F.create_map(*(x for k, v in proportions.items() for x in (F.lit(k), F.lit(v / total))))
    per = got.groupBy("split", "label").agg(F.count("*").alias("n"))
    labels = per.groupBy("label").agg(F.sum("n").alias("of"))
    worst = per.join(F.broadcast(labels), "label").groupBy("split").agg(F.max(F.abs(F.col("n") / F.col("of") - want[F.col("split")])).alias("label_deviation"), F.sum("n").alias("records"))
    groups = got.groupBy("split").agg(F.count_distinct("root").alias("groups"))
    everything = per.agg(F.sum("n").alias("everything"))
    return worst.join(groups, "split").crossJoin(F.broadcast(everything)).select("split", "records", "groups", (F.col("records") / F.col("everything")).alias("share"), want[F.col("split")].alias("wanted"), "label_deviation")
