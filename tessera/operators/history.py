"""Commit history: derived tables, joins along parents, neighbours, contributor and repository statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.paths import crate_of, is_core
from tessera.operators.stats import rate

ORDER = ("commit_timestamp", "hash")


def latest(df: DataFrame, keys: list[str], order: str = "scraped_at") -> DataFrame:
    """One row per key, the one written last; ties go by all other columns' hash."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(order, F.xxhash64(*others))).alias("r_")).select(*keys, "r_.*")


def branch_map(commits: DataFrame) -> DataFrame:
    """(hash, branches): every branch a commit was seen on, sorted."""
    return commits.select("hash", F.explode("branches").alias("branch")).groupBy("hash").agg(F.array_sort(F.collect_set("branch")).alias("branches"))


def tag_map(commits: DataFrame) -> DataFrame:
    return commits.select("hash", F.explode("tags").alias("tag")).groupBy("hash").agg(F.array_sort(F.collect_set("tag")).alias("tags"))


def with_refs(commits: DataFrame) -> DataFrame:
    """Commits with their branches and tags, empty lists where there are none."""
    none = F.array().cast("array<string>")
    base = commits.drop("branches", "tags").dropDuplicates(["hash"])
    return base.join(branch_map(commits), "hash", "left").join(tag_map(commits), "hash", "left").withColumns({"branches": F.coalesce("branches", none), "tags": F.coalesce("tags", none)})


def branch_info(commits: DataFrame) -> DataFrame:
    """(branch, tip, n_commits): the newest commit of each branch and how many it has."""
    rows = commits.select("hash", "commit_timestamp", F.explode("branches").alias("branch")).distinct()
    return rows.groupBy("branch").agg(F.max_by("hash", F.struct("commit_timestamp", "hash")).alias("tip"), F.count_distinct("hash").alias("n_commits"))


def first_branch(commits: DataFrame) -> DataFrame:
    """(hash, branch): the alphabetically first branch that has the commit."""
    return commits.select("hash", F.explode("branches").alias("branch")).groupBy("hash").agg(F.min("branch").alias("branch"))


def with_parent(commits: DataFrame) -> DataFrame:
    """Adds time_since_parent: seconds since the first parent, 0 where it is unknown."""
    p = commits.select(F.col("hash").alias("parent_"), F.col("commit_timestamp").alias("pt_"))
    c = commits.withColumn("parent_", F.get("parents", F.lit(0)))
    return c.join(p, "parent_", "left").withColumn("time_since_parent", F.coalesce(F.col("commit_timestamp") - F.col("pt_"), F.lit(0))).drop("pt_").withColumnRenamed("parent_", "first_parent")


def reachable(commits: DataFrame, tips: DataFrame, block: int = 1 << 20, max_rounds: int = 10_000) -> DataFrame:
    """(tip, hash) of every commit reachable from a few given tips (column hash).

    Commits are numbered in time order, if they have one, and divided into blocks of so many commits and parents.
    A round follows all paths within the blocks that were entered, one task per block and tip, and hands over
    what leaves them. A history in order takes about a round per block, however long its paths are; other orders
    take more rounds. Parents without a row are reached, a null among parents too, once per tip.
    """
    from tessera.operators.windows import with_offsets
    from tessera.session import cut, scratch

    read, tips = commits.sparkSession.read, cut(tips.select("hash").distinct())
    links = commits.where("hash is not null").select(F.col("hash").alias("child"), F.explode("parents").alias("parent")).distinct()
    time = F.col("commit_timestamp") if "commit_timestamp" in commits.columns else F.lit(None).cast("bigint")
    rows = commits.select("hash", time.alias("at"), F.greatest(F.size("parents"), F.lit(0)).alias("n"))
    ends = links.select("parent").unionAll(tips).select(F.col("parent").alias("hash"), F.lit(None).cast("bigint").alias("at"), F.lit(0).alias("n"))
    each = rows.unionAll(ends).groupBy("hash").agg(F.max("at").alias("at"), (F.sum("n") + 1).alias("n"))
    numbers = cut(with_offsets(each, ["at", "hash"], F.col("n"), "no").select("hash", "no"))
    block_of = lambda no: F.floor(F.col(no) / block).alias("block")

    edges_at, seen_at = scratch(commits.sparkSession, "edges"), scratch(commits.sparkSession, "seen")
    from_, to = numbers.toDF("child", "a"), numbers.toDF("parent_", "b")
    edges = links.join(from_, "child").join(to, F.col("parent").eqNullSafe(F.col("parent_"))).select("a", "b", block_of("a"))
    edges.repartition("block").write.partitionBy("block").parquet(edges_at)
    edges = read.schema("a bigint, b bigint, block bigint").parquet(edges_at)
    start = cut(tips.toDF("name").join(numbers, F.col("name").eqNullSafe(F.col("hash"))).select("name", F.col("no").alias("tip")))
    new = start.select(block_of("tip"), "tip", F.col("tip").alias("no"))
    new.limit(0).write.partitionBy("block").parquet(seen_at)
    seen = lambda: read.schema("tip bigint, no bigint, block bigint").parquet(seen_at)
    none = F.lit(None).cast("bigint")
    for _ in range(max_rounds):
        blocks = [r["block"] for r in new.select("block").distinct().collect()]
        if not blocks:
            break
        entered, here = F.broadcast(new.select("block", "tip").distinct()), F.col("block").isin(blocks)
        given = new.select("block", "tip", none.alias("a"), F.col("no").alias("b"))
        given = given.unionAll(seen().where(here).join(entered, ["block", "tip"]).select("block", "tip", F.col("no").alias("a"), none.alias("b")))
        given = given.unionAll(edges.where(here).join(entered, "block").select("block", "tip", "a", "b"))
        found = cut(given.groupBy("block", "tip").applyInArrow(_paths_within(block), "block bigint, tip bigint, no bigint, inside boolean"))
        found.where("inside").drop("inside").repartition("block", "tip").write.mode("append").partitionBy("block").parquet(seen_at)
        new = found.where("not inside").select("block", "tip", "no").distinct()
    else:
        raise RuntimeError(f"the history takes more than {max_rounds} rounds")
    return seen().join(numbers, "no").join(F.broadcast(start), "tip").select(F.col("name").alias("tip"), "hash")


def _paths_within(block: int):
    """Of one block and tip, rows (a, b): edges, entries (null, b) and what was seen before (a, null)."""

    def walk(key, rows):
        here, tip = (k.as_py() for k in key)
        low = here * block
        a, b = (pc.fill_null(rows[c], -1).to_numpy() for c in "ab")
        edge = (a >= 0) & (b >= 0)
        child, parent = a[edge] - low, b[edge]
        by = np.argsort(child, kind="stable")
        first, parent = np.searchsorted(child[by], np.arange(block + 1)).tolist(), parent[by].tolist()
        known = np.zeros(block, bool)
        known[a[b < 0] - low] = True
        known, inside, outside = bytearray(known.tobytes()), [], set()
        todo = [i for i in dict.fromkeys((b[a < 0] - low).tolist()) if not known[i]]
        for i in todo:
            known[i] = 1
        while todo:
            i = todo.pop()
            inside.append(i + low)
            for p in parent[first[i] : first[i + 1]]:
                if not 0 <= p - low < block:
                    outside.add(p)
                elif not known[p - low]:
                    known[p - low] = 1
                    todo.append(p - low)
        no = np.array([*inside, *outside], np.int64)
        return pa.table({"block": no // block, "tip": np.full(len(no), tip, np.int64), "no": no, "inside": np.arange(len(no)) < len(inside)})

    return walk


def numbered(commits: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Adds commit_number from 0 in time order, without a single-task window."""
    from tessera.operators.windows import with_offsets

    return with_offsets(commits, list(order), F.lit(1), "commit_number")


def author_stats(commits: DataFrame, diffs: DataFrame) -> DataFrame:
    """Per name and e-mail: commits, insertions, deletions, merges, times in order of commits, distinct files touched."""
    c = commits.select(F.coalesce("author_name", F.lit("")).alias("author_name"), F.coalesce("author_email", F.lit("")).alias("author_email"), "hash", "insertions", "deletions", "is_merge", "author_timestamp", "commit_timestamp")
    at = F.struct("commit_timestamp", "hash")
    main = c.groupBy("author_name", "author_email").agg(
        F.count("*").alias("commits"), F.coalesce(F.sum("insertions"), F.lit(0)).alias("insertions"), F.coalesce(F.sum("deletions"), F.lit(0)).alias("deletions"), F.count_if("is_merge").alias("merges"),
        F.min_by("author_timestamp", at).alias("first_commit"), F.max_by("author_timestamp", at).alias("last_commit"),
    )
    touched = diffs.where("change_type in ('A', 'M')").select(F.col("commit_hash").alias("hash"), "filename").join(c.select("hash", "author_name", "author_email"), "hash")
    files = touched.groupBy("author_name", "author_email").agg(F.count_distinct("filename").alias("n_files"))
    return main.join(files, ["author_name", "author_email"], "left").withColumn("n_files", F.coalesce("n_files", F.lit(0)))


def file_changes(diffs: DataFrame) -> DataFrame:
    """(filename, n): how often each file was added or modified."""
    return diffs.where("change_type in ('A', 'M') and filename is not null").groupBy("filename").agg(F.count("*").alias("n"))


def repository_stats(commits: DataFrame, diffs: DataFrame) -> DataFrame:
    """One row of totals, spans and rates; rates of an empty history are 0."""
    c = commits.agg(
        F.count("*").alias("n_commits"), F.count_distinct(F.coalesce("author_email", F.lit(""))).alias("n_authors"), F.count_if("is_merge").alias("merges"), F.coalesce(F.sum("insertions"), F.lit(0)).alias("insertions"),
        F.coalesce(F.sum("deletions"), F.lit(0)).alias("deletions"), F.min("commit_timestamp").alias("first"), F.max("commit_timestamp").alias("last"), F.avg("complexity_score").alias("avg_complexity"), F.count_if("is_high_risk").alias("high_risk"),
    )
    f = diffs.agg(F.count_distinct("filename").alias("n_files"))
    span = F.floor((F.col("last") - F.col("first")) / 86400)
    return c.crossJoin(f).select("*", F.coalesce(span, F.lit(0)).alias("span_days"), rate(F.col("merges"), F.col("n_commits")).alias("merge_rate"), rate(F.col("insertions") + F.col("deletions"), F.col("n_commits")).alias("avg_changes"), rate(F.col("n_commits"), span).alias("commits_per_day"))


def files_by_crate(diffs: DataFrame) -> DataFrame:
    """(commit_hash, files_by_crate): sorted files of each commit, by crate."""
    rows = diffs.where("change_type in ('A', 'M') and filename is not null").select("commit_hash", crate_of(F.col("filename")).alias("crate"), "filename").distinct()
    return rows.groupBy("commit_hash", "crate").agg(F.array_sort(F.collect_list("filename")).alias("files")).groupBy("commit_hash").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("crate", "files")))).alias("files_by_crate"))


def related_files(diffs: DataFrame, suffix: str = ".rs") -> DataFrame:
    """(commit_hash, filename, related): the other files of a kind in the same commit, sorted; no self join."""
    g = diffs.where("filename is not null").groupBy("commit_hash").agg(F.array_sort(F.collect_set(F.when(F.endswith("filename", F.lit(suffix)), F.col("filename")))).alias("of_kind"), F.collect_set("filename").alias("all_"))
    return g.select("commit_hash", F.explode("all_").alias("filename"), "of_kind").select("commit_hash", "filename", F.array_remove("of_kind", F.col("filename")).alias("related"))


def neighbours(commits: DataFrame, before: int = 2, after: int = 2, key: str | None = None) -> DataFrame:
    """Hashes of the commits before and after each, in time order, within a key or over all.

    Without a key, rows are numbered first and the band is an equi-join on the number.
    """
    if key is not None:
        w = W.partitionBy(key).orderBy(*ORDER)
        return commits.select("hash", key, "commit_timestamp", F.collect_list("hash").over(w.rowsBetween(-before, -1)).alias("previous"), F.collect_list("hash").over(w.rowsBetween(1, after)).alias("next"))
    n = numbered(commits.select("hash", "commit_timestamp"))
    offsets = [i for i in range(-before, after + 1) if i]
    other = n.select((F.col("commit_number")).alias("m"), F.col("hash").alias("other"))
    wide = n.withColumn("o", F.explode(F.array(*map(F.lit, offsets)))).withColumn("m", F.col("commit_number") + F.col("o"))
    g = wide.join(other, "m", "left").groupBy("hash", "commit_number").agg(F.array_sort(F.collect_list(F.when(F.col("other").isNotNull(), F.struct("o", "other")))).alias("l"))
    pick = lambda cond: F.transform(F.filter("l", cond), lambda x: x["other"])
    return g.select("hash", "commit_number", pick(lambda x: x["o"] < 0).alias("previous"), pick(lambda x: x["o"] > 0).alias("next"))


def hotspots(diffs: DataFrame, k: int = 20) -> DataFrame:
    """The k files changed most."""
    return file_changes(diffs).orderBy(F.desc("n"), "filename").limit(k)


def has_dependencies(files: DataFrame, edges: DataFrame) -> DataFrame:
    """Files with a flag whether they import anything."""
    return files.join(edges.select(F.col("src").alias("path"), F.lit(True).alias("h_")).distinct(), "path", "left").withColumn("has_dependencies", F.coalesce("h_", F.lit(False))).drop("h_")


def core_flag(path: str = "path"):
    return is_core(F.col(path))
