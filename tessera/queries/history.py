"""Queries over the commit history: scans, joins, aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import history as H
from tessera.operators import stats
from tessera.queries.registry import query, table

_LATEST = "(SELECT * FROM commits QUALIFY row_number() OVER (PARTITION BY hash ORDER BY scraped_at DESC) = 1)"


def _latest(s, d):
    # rows of one hash and time are equal in what is read here
    return H.latest(table(s, d, "commits"), ["hash"])


@query("src_s1_so5_unique_commits", f"SELECT hash, author_email, commit_timestamp, insertions FROM {_LATEST}")
def _(s, d):
    return _latest(s, d).select("hash", "author_email", "commit_timestamp", "insertions")


@query("src_s3_s4_j1_refs", """WITH b AS (SELECT hash, list_sort(list_distinct(flatten(list(branches)))) AS l FROM commits WHERE branches IS NOT NULL GROUP BY 1), t AS (SELECT hash, list_sort(list_distinct(flatten(list(tags)))) AS l FROM commits WHERE tags IS NOT NULL GROUP BY 1)
    SELECT h.hash, coalesce(array_to_string(b.l, ' '), '') AS branches, coalesce(array_to_string(t.l, ' '), '') AS tags FROM (SELECT DISTINCT hash FROM commits) h LEFT JOIN b USING (hash) LEFT JOIN t USING (hash)""")  # fmt: skip
def _(s, d):
    return H.with_refs(table(s, d, "commits")).select("hash", F.array_join("branches", " ").alias("branches"), F.array_join("tags", " ").alias("tags"))


@query("src_s6_s12_branches", """WITH r AS (SELECT DISTINCT hash, commit_timestamp, unnest(branches) AS branch FROM commits) SELECT branch, arg_max(hash, struct_pack(t := commit_timestamp, h := hash)) AS tip, count(DISTINCT hash) AS n_commits FROM r GROUP BY 1""")
def _(s, d):
    return H.branch_info(table(s, d, "commits"))


@query("src_s7_first_branch", "SELECT hash, min(branch) AS branch FROM (SELECT hash, unnest(branches) AS branch FROM commits) GROUP BY 1")
def _(s, d):
    return H.first_branch(table(s, d, "commits"))


@query("src_s10_reachable", f"""WITH RECURSIVE c AS (SELECT DISTINCT hash, unnest(parents) AS parent FROM commits), tip AS (SELECT hash FROM {_LATEST} ORDER BY commit_timestamp DESC, hash LIMIT 3),
    r AS (SELECT hash AS tip, hash FROM tip UNION SELECT r.tip, c.parent FROM r JOIN c ON c.hash = r.hash) SELECT tip, count(*) AS n FROM r GROUP BY 1""")  # fmt: skip
def _(s, d):
    c = _latest(s, d)
    tips = c.orderBy(F.desc("commit_timestamp"), "hash").limit(3).select("hash")
    return H.reachable(table(s, d, "commits"), tips).groupBy("tip").agg(F.count("*").alias("n"))


@query("src_s11_wf1_numbered", f"SELECT hash, row_number() OVER (ORDER BY commit_timestamp, hash) - 1 AS commit_number FROM {_LATEST}")
def _(s, d):
    return H.numbered(_latest(s, d).select("hash", "commit_timestamp")).select("hash", "commit_number")


@query("src_s14_large_diffs", """SELECT d.diff_id, d.scraped_at, (1767225600 - c.commit_timestamp) / 86400.0::DOUBLE AS age_days FROM file_diffs d JOIN """ + _LATEST + """ c ON c.hash = d.commit_hash WHERE length(d.patch) > 500""")
def _(s, d):
    big = table(s, d, "file_diffs").where(F.length("patch") > 500).select("diff_id", "scraped_at", F.col("commit_hash").alias("hash"))
    return big.join(_latest(s, d).select("hash", "commit_timestamp"), "hash").select("diff_id", "scraped_at", ((F.lit(1767225600) - F.col("commit_timestamp")) / F.lit(86400.0).cast("double")).alias("age_days"))


@query("join_j2_p9_parent_delta", f"""WITH c AS {_LATEST} SELECT c.hash, coalesce(c.commit_timestamp - p.commit_timestamp, 0) AS time_since_parent FROM c LEFT JOIN c p ON p.hash = c.parents[1]""")
def _(s, d):
    return H.with_parent(_latest(s, d)).select("hash", "time_since_parent")


@query("join_j3_chunk_time", f"SELECT chunk_id, coalesce(c.commit_timestamp, 0) AS ts FROM code_chunks k LEFT JOIN {_LATEST} c ON c.hash = k.commit_hash")
def _(s, d):
    c = _latest(s, d).select(F.col("hash").alias("commit_hash"), "commit_timestamp")
    return table(s, d, "code_chunks").join(c, "commit_hash", "left").select("chunk_id", F.coalesce("commit_timestamp", F.lit(0)).alias("ts"))


@query("join_j6_import_graph", """WITH g AS (SELECT DISTINCT filename FROM file_diffs WHERE filename IS NOT NULL AND regexp_matches(patch, '(^|\\n)[-+ ]\\s*(use|import|from) ')) SELECT chunk_id, file_path IN (SELECT filename FROM g) AS has_dependencies FROM code_chunks WHERE file_path IS NOT NULL""")
def _(s, d):
    # edges from a file to what its patches import, then a look-up of the files of chunks
    used = F.regexp_extract_all("patch", F.lit(r"(?:^|\n)[-+ ]\s*(?:use|import|from) +([^\s;]*)"), F.lit(1))
    edges = table(s, d, "file_diffs").where("filename is not null and patch is not null").select(F.col("filename").alias("src"), F.explode(used).alias("imported")).distinct()
    return H.has_dependencies(table(s, d, "code_chunks").where("file_path is not null").select("chunk_id", F.col("file_path").alias("path")), edges).select("chunk_id", "has_dependencies")


@query("join_j7_related_files", """WITH f AS (SELECT DISTINCT commit_hash, filename FROM file_diffs WHERE filename IS NOT NULL)
    SELECT a.commit_hash, a.filename, coalesce(string_agg(b.filename, ' ' ORDER BY b.filename), '') AS related FROM f a LEFT JOIN f b ON a.commit_hash = b.commit_hash AND a.filename <> b.filename AND b.filename LIKE '%.rs' GROUP BY ALL""")  # fmt: skip
def _(s, d):
    return H.related_files(table(s, d, "file_diffs")).select("commit_hash", "filename", F.array_join("related", " ").alias("related"))


@query("join_j8_so3_missing_files", "SELECT DISTINCT filename FROM file_diffs WHERE filename IS NOT NULL AND filename NOT IN (SELECT path FROM documents WHERE path IS NOT NULL)")
def _(s, d):
    files = table(s, d, "file_diffs").where("filename is not null").select("filename").distinct()
    return files.join(table(s, d, "documents").select(F.col("path").alias("filename")).distinct(), "filename", "left_anti")


@query("join_j9_j10_zip_constants", f"SELECT example_id, 'main' AS branch, list_sum(list_transform(list_zip(context, context_mask), lambda z: z[1] * z[2]))::BIGINT AS masked FROM examples WHERE len(context) = len(context_mask) AND len(context) > 0")
def _(s, d):
    e = table(s, d, "examples").where("size(context) = size(context_mask) and size(context) > 0").crossJoin(F.broadcast(s.createDataFrame([("main",)], "branch string")))
    z = F.arrays_zip("context", "context_mask")
    return e.select("example_id", "branch", F.aggregate(z, F.lit(0).cast("bigint"), lambda a, x: a + x["context"] * x["context_mask"]).alias("masked"))


@query("join_j11_function_files", """SELECT name, count(DISTINCT doc_id) AS n_files FROM (SELECT doc_id, unnest(regexp_extract_all(text, 'fn\\s+(\\w+)', 1)) AS name FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def _(s, d):
    each = table(s, d, "documents").where("text is not null").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"fn\s+(\w+)"), F.lit(1))).alias("name"))
    return each.groupBy("name").agg(F.count_distinct("doc_id").alias("n_files"))


@query("join_j12_wf2_neighbours", f"""WITH c AS {_LATEST} SELECT hash, coalesce(array_to_string(list(hash) OVER (ORDER BY commit_timestamp, hash ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), ' '), '') AS previous,
    coalesce(array_to_string(list(hash) OVER (ORDER BY commit_timestamp, hash ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), ' '), '') AS next FROM c""")  # fmt: skip
def _(s, d):
    n = H.neighbours(_latest(s, d).select("hash", "commit_timestamp"))
    return n.select("hash", F.array_join("previous", " ").alias("previous"), F.array_join("next", " ").alias("next"))


@query("join_j13_same_branch_previous", f"""WITH c AS (SELECT hash, commit_timestamp, branches[1] AS b FROM {_LATEST}), w AS (SELECT hash, b, list(struct_pack(b := b, h := hash)) OVER (ORDER BY commit_timestamp, hash ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS l FROM c)
    SELECT hash, coalesce(array_to_string(list_transform(list_filter(l, lambda x: x.b = w.b), lambda x: x.h), ' '), '') AS previous FROM w""")  # fmt: skip
def _(s, d):
    c = _latest(s, d).select("hash", "commit_timestamp", F.get("branches", F.lit(0)).alias("b"))
    n = H.neighbours(c, 2, 0).select("hash", "previous")
    mine = c.select("hash", "b")
    each = n.select("hash", F.posexplode_outer("previous").alias("pos", "p")).join(mine, "hash").join(mine.select(F.col("hash").alias("p"), F.col("b").alias("pb")), "p", "left")
    return each.groupBy("hash").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("pb") == F.col("b"), F.struct("pos", "p")))), lambda x: x["p"]), " ").alias("previous"))


@query("agg_a1_author_stats", f"""WITH c AS (SELECT *, coalesce(author_name, '') AS an, coalesce(author_email, '') AS ae FROM {_LATEST}), m AS (SELECT an, ae, count(*) AS commits, coalesce(sum(insertions), 0)::BIGINT AS insertions, coalesce(sum(deletions), 0)::BIGINT AS deletions, count(*) FILTER (is_merge) AS merges,
    arg_min(author_timestamp, struct_pack(t := commit_timestamp, h := hash)) AS first_commit, arg_max(author_timestamp, struct_pack(t := commit_timestamp, h := hash)) AS last_commit FROM c GROUP BY 1, 2),
    f AS (SELECT an, ae, count(DISTINCT filename) AS n FROM file_diffs d JOIN c ON c.hash = d.commit_hash WHERE change_type IN ('A', 'M') GROUP BY 1, 2)
    SELECT m.an AS author_name, m.ae AS author_email, commits, insertions, deletions, merges, first_commit, last_commit, coalesce(f.n, 0) AS n_files FROM m LEFT JOIN f USING (an, ae)""")  # fmt: skip
def _(s, d):
    return H.author_stats(_latest(s, d), table(s, d, "file_diffs"))


@query("agg_a2_t3_hotspots", "SELECT filename, count(*) AS n FROM file_diffs WHERE change_type IN ('A', 'M') AND filename IS NOT NULL GROUP BY 1 ORDER BY n DESC, filename LIMIT 20")
def _(s, d):
    return H.hotspots(table(s, d, "file_diffs"))


@query("agg_a3_a4_repository", f"""WITH c AS (SELECT count(*) AS n_commits, count(DISTINCT coalesce(author_email, '')) AS n_authors, count(*) FILTER (is_merge) AS merges, coalesce(sum(insertions), 0)::BIGINT AS insertions, coalesce(sum(deletions), 0)::BIGINT AS deletions,
    min(commit_timestamp) AS first, max(commit_timestamp) AS last, round(avg(complexity_score), 6) AS avg_complexity, count(*) FILTER (is_high_risk) AS high_risk FROM {_LATEST})
    SELECT *, (SELECT count(DISTINCT filename) FROM file_diffs) AS n_files, (last - first) // 86400 AS span_days, round(merges / n_commits::DOUBLE, 6) AS merge_rate, round((insertions + deletions) / n_commits::DOUBLE, 6) AS avg_changes, round(n_commits / ((last - first) // 86400)::DOUBLE, 6) AS commits_per_day FROM c""")  # fmt: skip
def _(s, d):
    r = H.repository_stats(_latest(s, d), table(s, d, "file_diffs"))
    return r.withColumns({c: F.round(c, 6) for c in ("avg_complexity", "merge_rate", "avg_changes", "commits_per_day")})


@query("agg_a5_files_by_crate", """WITH r AS (SELECT DISTINCT commit_hash, CASE WHEN split_part(filename, '/', 1) = 'crates' AND contains(filename, '/') THEN split_part(filename, '/', 2) ELSE 'root' END AS crate, filename FROM file_diffs WHERE change_type IN ('A', 'M') AND filename IS NOT NULL)
    SELECT commit_hash, count(DISTINCT crate) AS n_crates, count(*) AS n_files, min(crate || ':' || filename) AS first_file FROM r GROUP BY 1""")  # fmt: skip
def _(s, d):
    m = H.files_by_crate(table(s, d, "file_diffs"))
    return m.select(
        "commit_hash", F.size("files_by_crate").cast("bigint").alias("n_crates"),
        F.aggregate(F.map_values("files_by_crate"), F.lit(0).cast("bigint"), lambda a, x: a + F.size(x)).alias("n_files"),
        F.array_min(F.flatten(F.transform(F.map_entries("files_by_crate"), lambda e: F.transform(e["value"], lambda f: F.concat(e["key"], F.lit(":"), f))))).alias("first_file"),
    )


@query("agg_a6_chunk_types", "SELECT change_type, count(*) AS n, count(DISTINCT file_path) AS files, sum(length(new_code))::BIGINT // count(*) AS avg_size, max(length(new_code)) AS max_size, count(*) FILTER (len(related_files) > 0) AS with_context FROM code_chunks GROUP BY 1")
def _(s, d):
    n = F.length("new_code")
    return table(s, d, "code_chunks").groupBy("change_type").agg(
        F.count("*").alias("n"), F.count_distinct("file_path").alias("files"), F.floor(F.sum(n) / F.count("*")).cast("bigint").alias("avg_size"), F.max(n).cast("bigint").alias("max_size"), F.count_if(F.size("related_files") > 0).alias("with_context"),
    )


@query("agg_a9_a10_cube", """SELECT chunk_scale, split, count(*) AS n, grouping(chunk_scale, split)::BIGINT AS level FROM examples GROUP BY CUBE (chunk_scale, split)""")
def _(s, d):
    return table(s, d, "examples").cube("chunk_scale", "split").agg(F.count("*").alias("n"), F.grouping_id().cast("bigint").alias("level"))


@query("agg_a10_split_shares", "SELECT split, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS share FROM examples GROUP BY 1")
def _(s, d):
    e = table(s, d, "examples")
    g = e.groupBy("split").agg(F.count("*").alias("n"))
    return g.crossJoin(F.broadcast(g.agg(F.sum("n").alias("t")))).select("split", "n", F.round(F.col("n") / F.col("t"), 6).alias("share"))


@query("agg_a14_a17_totals", "SELECT count(*) AS n, sum(len(context))::BIGINT AS context_tokens, sum(len(target))::BIGINT AS target_tokens, sum(len(context))::BIGINT // count(*) AS avg_context, sum(list_sum(context_mask))::BIGINT AS real_tokens FROM examples")
def _(s, d):
    a, b = F.size("context"), F.size("target")
    pos = lambda c: F.sum(F.when(c >= 0, c))
    real = F.aggregate("context_mask", F.lit(0).cast("bigint"), lambda x, y: x + y)
    return table(s, d, "examples").agg(F.count("*").alias("n"), pos(a).alias("context_tokens"), pos(b).alias("target_tokens"), F.floor(pos(a) / F.count("*")).cast("bigint").alias("avg_context"), F.sum(real).alias("real_tokens"))


@query("agg_a15_token_stats", """WITH l AS (SELECT len(tokens) AS n FROM packed_sequences WHERE tokens IS NOT NULL), s AS (SELECT list_sort(list(n)) AS a FROM l)
    SELECT (SELECT count(*) FROM l) AS n_rows, (SELECT sum(n)::BIGINT FROM l) AS total, (SELECT min(n) FROM l) AS least, (SELECT max(n) FROM l) AS most, a[len(a) // 2 + 1] AS upper_median, a[least(floor(0.95 * len(a))::INT, len(a) - 1) + 1] AS p95 FROM s""")  # fmt: skip
def _(s, d):
    n = table(s, d, "packed_sequences").where("tokens is not null").select(F.size("tokens").cast("bigint").alias("n"))
    total = n.agg(F.count("*").alias("n_rows"), F.sum("n").alias("total"), F.min("n").alias("least"), F.max("n").alias("most"))
    return total.crossJoin(stats.picked(n, "n", {"upper_median": 0.5, "p95": 0.95}))


@query("agg_a16_packing_efficiency", "SELECT count(*) AS n, round(avg(efficiency), 6) AS mean, round(stddev_pop(efficiency), 6) AS std, min(efficiency) AS least, max(efficiency) AS most, sum(meta.total_tokens)::BIGINT AS tokens FROM packed_sequences")
def _(s, d):
    e = F.col("efficiency")
    return table(s, d, "packed_sequences").agg(F.count("*").alias("n"), F.round(F.avg(e), 6).alias("mean"), F.round(F.stddev_pop(e), 6).alias("std"), F.min(e).alias("least"), F.max(e).alias("most"), F.sum("meta.total_tokens").alias("tokens"))


@query("agg_a18_a19_scales", """WITH b AS (SELECT * FROM (VALUES ('MICRO', 100, 256), ('SMALL', 257, 512), ('MEDIUM', 513, 1024), ('LARGE', 1025, 2048), ('XLARGE', 2049, 4096), ('HUGE', 4097, 8192)) t(scale, lo, hi)), c AS (SELECT len(context) AS n, difficulty FROM examples WHERE context IS NOT NULL)
    SELECT scale, count(n) AS n_rows, round(avg(difficulty), 6) AS mean_difficulty FROM b LEFT JOIN c ON n BETWEEN lo AND hi GROUP BY 1""")  # fmt: skip
def _(s, d):
    from tessera.queries.columns import SCALES, scale_of

    dim = s.createDataFrame([(x,) for x, _, _ in SCALES], "scale string")
    c = table(s, d, "examples").where("context is not null").groupBy(scale_of(F.size("context")).alias("scale")).agg(F.count("*").alias("n"), F.avg("difficulty").alias("m"))
    return dim.join(c, "scale", "left").select("scale", F.coalesce("n", F.lit(0)).alias("n_rows"), F.round("m", 6).alias("mean_difficulty"))


@query("agg_a20_w8_commit_examples", """WITH g AS (SELECT commit_hash, count(*) AS num_chunks, flatten(list(coalesce(context, [])::INT[] ORDER BY example_id)) AS a FROM examples WHERE commit_hash IS NOT NULL GROUP BY 1)
    SELECT commit_hash, num_chunks, list_sum(a[:256])::BIGINT AS context_sum, list_sum(a[257:320])::BIGINT AS target_sum FROM g WHERE len(a[:256]) > 128 AND len(a[257:320]) > 32""")  # fmt: skip
def _(s, d):
    from tessera.operators.windows import grouped_examples

    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    g = grouped_examples(table(s, d, "examples"), "commit_hash", ["example_id"], "context", 256, 64)
    return g.select("commit_hash", "num_chunks", total("context").alias("context_sum"), total("target").alias("target_sum"))


@query("agg_a21_coverage", """WITH k AS (SELECT count(*) AS n_chunks, count(DISTINCT file_path) AS n_files FROM code_chunks), m AS (SELECT DISTINCT path FROM documents WHERE path IS NOT NULL AND path NOT IN (SELECT file_path FROM code_chunks WHERE file_path IS NOT NULL))
    SELECT n_chunks, n_files, round(1.0 - (SELECT count(*) FROM m) / (SELECT count(DISTINCT path) FROM documents)::DOUBLE, 6)::DOUBLE AS coverage, (SELECT string_agg(path, ' ' ORDER BY path) FROM (SELECT path FROM m ORDER BY path LIMIT 20)) AS missing FROM k""")  # fmt: skip
def _(s, d):
    chunks, docs = table(s, d, "code_chunks"), table(s, d, "documents").where("path is not null").select("path").distinct()
    missing = docs.join(chunks.select(F.col("file_path").alias("path")).distinct(), "path", "left_anti")
    head = missing.orderBy("path").limit(20).agg(F.array_join(F.array_sort(F.collect_list("path")), " ").alias("missing"))
    counts = chunks.agg(F.count("*").alias("n_chunks"), F.count_distinct("file_path").alias("n_files")).crossJoin(missing.agg(F.count("*").alias("m"))).crossJoin(docs.agg(F.count("*").alias("all_")))
    return counts.crossJoin(head).select("n_chunks", "n_files", F.round(1 - F.coalesce(F.try_divide(F.col("m"), F.col("all_")), F.lit(0.0)), 6).alias("coverage"), "missing")


@query("agg_a22_repo_structure", """WITH f AS (SELECT len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n, (length(text) - length(replace(text, 'use ', ''))) // 4 + (length(text) - length(replace(text, 'mod ', ''))) // 4 AS depth FROM documents WHERE lang = 'rust' AND text IS NOT NULL), s AS (SELECT list_sort(list(n)) AS a, round(avg(depth), 6) AS mean_depth, count(*) AS num_files, sum(n)::BIGINT AS total_tokens FROM f)
    SELECT a[len(a) // 2 + 1] AS median_tokens, a[floor(0.95 * len(a))::INT + 1] AS p95_tokens, mean_depth, greatest(num_files, 1) AS num_files, greatest(total_tokens, 10000) AS total_tokens FROM s""")  # fmt: skip
def _(s, d):
    from tessera.functions.tokens import occurrences

    t = F.col("text")
    f = table(s, d, "documents").where("lang = 'rust' and text is not null").select(F.size(F.filter(F.split(t, r"\s+"), lambda x: x != "")).cast("bigint").alias("n"), (occurrences(t, "use ") + occurrences(t, "mod ")).alias("depth"))
    a = f.agg(F.round(F.avg("depth"), 6).alias("mean_depth"), F.greatest(F.count("*"), F.lit(1)).alias("num_files"), F.greatest(F.sum("n"), F.lit(10000)).alias("total_tokens"))
    return a.crossJoin(stats.picked(f, "n", {"median_tokens": 0.5, "p95_tokens": 0.95}))


@query("agg_a28_hierarchy", f"""WITH c AS {_LATEST} SELECT coalesce(author_name, '') AS author, count(*) AS commits, count(*) FILTER (is_merge) AS merges, arg_max(hash, struct_pack(t := commit_timestamp, h := hash)) AS tip FROM c GROUP BY 1""")
def _(s, d):
    c = _latest(s, d)
    return c.groupBy(F.coalesce("author_name", F.lit("")).alias("author")).agg(F.count("*").alias("commits"), F.count_if("is_merge").alias("merges"), F.max_by("hash", F.struct("commit_timestamp", "hash")).alias("tip"))


@query("agg_a29_a33_pivot", """SELECT coalesce(lang, '') AS lang, count(*) FILTER (length(text) >= 1000) AS long, count(*) FILTER (length(text) < 1000) AS short FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def _(s, d):
    size = F.when(F.length("text") >= 1000, "long").otherwise("short")
    docs = table(s, d, "documents").where("text is not null").select(F.coalesce("lang", F.lit("")).alias("lang"), size.alias("size_"))
    p = docs.groupBy("lang").pivot("size_", ["long", "short"]).count()
    return p.na.fill(0)


@query("agg_a30_a31_uniqueness", "SELECT round(count(DISTINCT list_slice(tokens, 1, 50)::VARCHAR) / count(*)::DOUBLE, 6) AS uniqueness, sum(len(list_distinct(tokens)))::BIGINT AS distinct_tokens FROM packed_sequences WHERE tokens IS NOT NULL")
def _(s, d):
    p = table(s, d, "packed_sequences").where("tokens is not null")
    return p.agg(F.round(F.count_distinct(F.slice("tokens", 1, 50)) / F.count("*"), 6).alias("uniqueness"), F.sum(F.size(F.array_distinct(F.filter("tokens", lambda t: t.isNotNull())))).alias("distinct_tokens"))
