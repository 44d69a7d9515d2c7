"""Queries over readers, writers, streams, plans and pipelines; stages are handed over in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F


from tessera.functions import tokens as T
from tessera.functions.tokens import words
from tessera.operators import history, sampling
from tessera.plans import formulas, pipelines
from tessera.queries.registry import query, table
from tessera.queries.sequences import NEXT_FIT, metric_series, next_fit, signal_sql
from tessera.session import scratch
from tessera.sources import readers, sinks
from tessera.streaming import streams


def _commits(s, d):
    return history.latest(table(s, d, "commits"), ["hash"])


_LATEST = "(SELECT * FROM commits QUALIFY row_number() OVER (PARTITION BY hash ORDER BY scraped_at DESC) = 1)"


@query("src_s2_s20_k1_jsonl", f"SELECT hash, author_name, commit_timestamp, len(parents) AS n_parents, insertions FROM {_LATEST}")
def _(s, d):
    path = scratch(s, "commits")
    sinks.write_jsonl(_commits(s, d), path)
    return readers.read_commits(s, path).select("hash", "author_name", "commit_timestamp", F.size("parents").cast("bigint").alias("n_parents"), "insertions")


@query("src_s19_s9_nested", "SELECT commit_hash, filename, change_type, coalesce(additions, 0) AS additions FROM file_diffs WHERE filename IS NOT NULL")
def _(s, d):
    diff = F.struct("filename", "change_type", "old_file", "new_file", "additions", "deletions", "patch", "is_binary")
    nested = table(s, d, "file_diffs").where("filename is not null").groupBy("commit_hash").agg(F.collect_list(diff).alias("diffs"))
    path = scratch(s, "nested")
    nested.select(F.array(F.struct(F.struct(F.col("commit_hash").alias("hash")).alias("meta"), "diffs")).alias("commits")).write.json(path)
    return readers.diffs_of(readers.read_nested_commits(s, path, one_document=False)).select("commit_hash", "filename", "change_type", F.coalesce("additions", F.lit(0)).alias("additions"))


@query("src_s8_nul_record", "SELECT hash, scraped_at, coalesce(author_name, '') AS author, coalesce(subject, '') AS subject FROM commits")
def _(s, d):
    record = F.concat_ws("\x00", "hash", F.coalesce("author_name", F.lit("")), F.coalesce("subject", F.lit("")))
    parts = readers.parse_nul_record(record)
    return table(s, d, "commits").select(F.get(parts, F.lit(0)).alias("hash"), "scraped_at", F.get(parts, F.lit(1)).alias("author"), F.get(parts, F.lit(2)).alias("subject"))


@query("src_s13_log_blocks", f"SELECT hash, coalesce(nullif(trim(subject), ''), '-') AS subject FROM {_LATEST}")
def _(s, d):
    fill = lambda c: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("-"))
    block = F.concat_ws("\n", "hash", fill("author_name"), F.coalesce("commit_timestamp", F.lit(0)).cast("string"), fill("subject"), F.lit("---COMMIT_END---\n"))
    c = _commits(s, d)
    logs = c.groupBy(F.pmod(F.xxhash64("hash"), F.lit(c.count() // 1000 + 1)).alias("g")).agg(F.array_join(F.collect_list(block), "").alias("log"))  # logs of about a thousand commits
    return logs.select(F.inline(readers.parse_log_blocks(F.col("log")))).select("hash", "subject")


_LATIN = "NOT regexp_matches(text, '[^\\x{0}-\\x{ff}]')"


@query("src_s15_s16_s17_tree", f"""WITH f AS (SELECT doc_id, text, CASE WHEN {_LATIN} THEN length(text) ELSE strlen(text) END + CASE WHEN updated_at IS NULL THEN 1 ELSE 0 END AS bytes FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, bytes::BIGINT AS length, md5(f.text) AS digest FROM f JOIN documents d USING (doc_id) WHERE lower(d.lang) IN ('rust', 'python', 'text', 'markdown') AND d.source IS NOT NULL AND d.n_chars IS NOT NULL AND d.updated_at IS NOT NULL AND length(f.text) >= 100 AND bytes <= 20000""")  # fmt: skip
def _(s, d):
    # one file each: without a source below a vendored folder, without a count in a hidden one, undated ones binary; Latin-1 where that is enough
    docs = table(s, d, "documents").where("text is not null")
    folder = F.when(F.col("source").isNull(), "node_modules").when(F.col("n_chars").isNull(), ".cache").otherwise("src")
    body = F.when(~F.col("text").rlike(r"[^\x00-\xff]"), F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    files = docs.select(F.concat_ws("/", folder, F.concat(F.pmod(F.xxhash64("doc_id"), F.lit(64)).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), F.coalesce(F.lower(F.nullif("lang", F.lit(""))), F.lit("none")))).alias("path"), F.when(F.col("updated_at").isNull(), F.concat(F.lit(b"\x00"), body)).otherwise(body).alias("content"))
    path = scratch(s, "tree")
    sinks.write_tree(files, path)
    found = readers.read_tree(s, path, ("rust", "python", "text", "markdown"), max_bytes=20_000, least_chars=100)
    return found.select(F.regexp_extract("path", r"(\d+)\.\w+$", 1).cast("bigint").alias("doc_id"), "length", F.md5(F.col("text").cast("binary")).alias("digest"))


@query("src_s5_s9_git_diffs", f"""WITH c AS (SELECT hash, left(hash, 2) AS k, is_revert, row_number() OVER (PARTITION BY left(hash, 2) ORDER BY commit_timestamp, hash) AS n FROM {_LATEST})
    SELECT hash AS subject, CASE WHEN n = 1 THEN 'A' ELSE 'M' END AS change_type, 'src/' || k || '.txt' AS old_file, 'src/' || k || '.txt' AS filename, 1::BIGINT AS additions, CASE WHEN n = 1 THEN 0 ELSE 1 END::BIGINT AS deletions, false AS is_binary FROM c
    UNION ALL SELECT hash, 'A', 'bin/' || hash, 'bin/' || hash, 0, 0, true FROM c WHERE is_revert
    UNION ALL SELECT hash, 'R', 'bin/' || p, 'moved/' || p, 0, 0, true FROM (SELECT hash, lag(CASE WHEN is_revert THEN hash END IGNORE NULLS) OVER (ORDER BY commit_timestamp, hash) AS p, is_revert, lag(is_revert) OVER (ORDER BY commit_timestamp, hash) AS before FROM {_LATEST}) WHERE before AND NOT is_revert""")  # fmt: skip
def _(s, d):
    # a repository with one commit for each row: a line changed by every commit, a binary file added by reverts and moved by the next commit
    from tessera.sources.git import GitCommits, GitDiffs

    rows = _commits(s, d).select("hash", "is_revert", "commit_timestamp").orderBy("commit_timestamp", "hash").toLocalIterator()
    path = _repository((r["hash"], r["is_revert"]) for r in rows)
    for source in (GitCommits, GitDiffs):
        s.dataSource.register(source)
    commits = s.read.format("git_commits").option("repository", path).load().select(F.col("hash").alias("commit_hash"), "subject")
    return s.read.format("git_diffs").option("repository", path).load().join(commits, "commit_hash").select("subject", "change_type", "old_file", "filename", "additions", "deletions", "is_binary")


def _repository(rows) -> str:
    """A git repository on the driver, made from (subject, binary file or not); git sources read where the client and the repository are."""
    import subprocess
    import tempfile

    path = tempfile.mkdtemp(prefix="tessera-git-")
    subprocess.run(["git", "init", "-q", path], check=True)
    git = subprocess.Popen(["git", "-C", path, "fast-import", "--quiet"], stdin=subprocess.PIPE)
    last = None
    for i, (name, binary) in enumerate(rows):
        git.stdin.write(f"commit refs/heads/main\ncommitter A <a@x> {1_000_000_000 + i} +0000\ndata {len(name)}\n{name}\n".encode())
        for file, content in ((f"src/{name[:2]}.txt", name.encode() + b"\n"), *([(f"bin/{name}", b"\x00" + name.encode() * 9)] if binary else [])):
            git.stdin.write(f"M 100644 inline {file}\ndata {len(content)}\n".encode() + content + b"\n")
        if last and not binary:
            git.stdin.write(f"R bin/{last} moved/{last}\n".encode())
        last = name if binary else None
    git.stdin.close()
    if git.wait():
        raise RuntimeError("git could not import the commits")
    return path


@query("src_s25_config", "SELECT * FROM (VALUES ('batch', '4'), ('nested.depth', '3'), ('nested.name', 'deep'), ('rate', '0.5'), ('words', '[\"a\", \"b\"]')) t(setting, value)")
def _(s, d):
    import json

    path = scratch(s, "config")
    s.createDataFrame([("batch: 4\n# said\nnested:\n  name: deep\nwords:\n  - a\n  - b\n",)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    text = s.read.text(path, wholetext=True).first()["value"]
    found = readers.load_config(text, {"batch": 2, "rate": 0.5, "nested": {"depth": 3}})
    flat = {f"{k}.{x}" if x else k: y for k, v in found.items() for x, y in (v.items() if isinstance(v, dict) else [("", v)])}
    return s.createDataFrame([(k, v if isinstance(v, str) else json.dumps(v)) for k, v in flat.items()], "setting string, value string")


@query("src_s27_digest", "SELECT (SELECT count(*) FROM documents WHERE path IS NOT NULL) AS n, true AS refused")
def _(s, d):
    path = scratch(s, "lines")
    table(s, d, "documents").where("path is not null").select(F.regexp_replace("path", r"[\r\n]", " ").alias("value")).coalesce(1).write.text(path)
    digest = s.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select(F.sha2("content", 256)).first()[0]
    lines = readers.read_lines(s, path + "/*.txt", digest)
    try:
        readers.read_lines(s, path + "/*.txt", "0" * 64)
        refused = False
    except ValueError:
        refused = True
    return lines.agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


_UNIFIED = "regexp_replace(regexp_replace(text, '\\r\\n|[\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]', chr(10), 'g'), '\\n$', '')"


@query("src_s18_s27_w6_chunks", f"""WITH l AS (SELECT path, len(string_split({_UNIFIED}, chr(10))) AS t FROM documents WHERE path IS NOT NULL AND text <> '')
    SELECT path, 'main' AS branch, sum(greatest(0, ceil((t - 20) / 16.0))::BIGINT + 1)::BIGINT AS n FROM l GROUP BY 1""")  # fmt: skip
def _(s, d):
    docs = table(s, d, "documents").where("path is not null and text <> ''")
    return readers.line_chunks(docs.select("path", "text"), 20, 4, branch="main").groupBy("path", "branch").agg(F.count("*").alias("n"))


@query("src_s21_s24_k4_sequences", "SELECT len(tokens)::BIGINT AS n, list_sum(tokens)::BIGINT AS total FROM packed_sequences WHERE len(tokens) > 0")
def _(s, d):
    p = table(s, d, "packed_sequences").where("size(tokens) > 0")
    path = scratch(s, "sequences")
    p.select(F.when(F.col("pack_id") % 2 == 0, F.to_json("tokens")).otherwise(F.to_json(F.struct("tokens"))).alias("value")).write.text(path)
    return readers.read_sequences(s, path).select(F.size("tokens").cast("bigint").alias("n"), F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("src_s22_s23_j5_bundle", "SELECT ((pack_id - 1) % 100)::INTEGER AS pos, len(tokens)::BIGINT AS n, 'packs-' || ((pack_id - 1) // 100)::VARCHAR AS source FROM packed_sequences")
def _(s, d):
    # bundles of a hundred sequences each, missing ones included
    p = table(s, d, "packed_sequences").withColumn("b", F.floor((F.col("pack_id") - 1) / 100)).withColumn("pos", (F.col("pack_id") - 1) % 100)
    doc = p.groupBy("b").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "tokens"))), lambda x: x["tokens"]).alias("token_sequences"),
        F.map_from_entries(F.collect_list(F.struct(F.col("pos").cast("string"), F.struct(F.concat(F.lit("packs-"), F.col("b").cast("string")).alias("source"))))).alias("metadata"),
    )
    path = scratch(s, "bundle")
    doc.drop("b").write.json(path)
    return readers.read_bundle(s, path, one_document=False).select("pos", F.when(F.col("tokens").isNotNull(), F.size("tokens")).cast("bigint").alias("n"), F.col("metadata.source").alias("source"))


@query("src_s26_k12_metrics", "SELECT event_id AS step, value AS train_loss FROM events WHERE value IS NOT NULL")
def _(s, d):
    path = scratch(s, "metrics")
    e = table(s, d, "events").where("value is not null").select(F.col("event_id").alias("step"), F.col("value").alias("train_loss"))
    sinks.append_metrics(e.where("step % 2 = 0"), path)
    sinks.append_metrics(e.where("step % 2 = 1"), path)
    return readers.read_metrics(s, path).select("step", "train_loss")


@query("snk_k2_k13_document", "SELECT count(*) AS n, sum(len(tokens))::BIGINT AS tokens FROM packed_sequences")
def _(s, d):
    path = scratch(s, "report")
    p = table(s, d, "packed_sequences").agg(F.count("*").alias("n"), F.sum(F.when(F.col("tokens").isNotNull(), F.size("tokens"))).alias("tokens"))
    sinks.write_document(p, path)
    return s.read.schema("n bigint, tokens bigint").option("multiLine", True).json(path)


@query("snk_k3_jsonl_size", "SELECT count(example_id) AS n, round(sum(strlen('{\"example_id\":' || example_id || ',\"target\":' || to_json(target)::VARCHAR || '}') + 1) / 1048576.0::DOUBLE, 9) AS mb FROM examples WHERE target IS NOT NULL")
def _(s, d):
    path = scratch(s, "lines")
    mb = sinks.write_jsonl(table(s, d, "examples").where("target is not null").select("example_id", "target"), path)
    return readers.read_jsonl(s, path, "example_id bigint, target array<int>").agg(F.count("example_id").alias("n"), F.lit(round(mb, 9)).alias("mb"))


@query("snk_k4_bundle", "SELECT coalesce(meta.type, 'none') AS source, count(*) AS n, sum(len(tokens))::BIGINT AS tokens FROM packed_sequences WHERE tokens IS NOT NULL GROUP BY 1")
def _(s, d):
    path = scratch(s, "bundle")
    p = table(s, d, "packed_sequences").where("tokens is not null").select(F.coalesce("meta.type", F.lit("none")).alias("source"), "tokens")
    sinks.write_bundle(p, path)
    return s.read.parquet(path).groupBy("source").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("tokens"))


@query("snk_k5_concatenated", """WITH e AS (SELECT example_id, unnest(list_append(target, 2)) AS t, generate_subscripts(list_append(target, 2), 1) AS i FROM examples WHERE len(target) > 0), g AS (SELECT t, row_number() OVER (ORDER BY example_id, i) - 1 AS o FROM e)
    SELECT o // 2048 AS window_no, count(*)::INTEGER AS n_real, sum(t)::BIGINT AS total FROM g GROUP BY 1 HAVING count(*) >= 512""")  # fmt: skip
def _(s, d):
    from tessera.operators import windows

    lines, path = scratch(s, "tokens"), scratch(s, "concatenated")
    sinks.write_jsonl(table(s, d, "examples").where("size(target) > 0").select("example_id", F.concat("target", F.array(F.lit(2))).alias("t")), lines)
    e = readers.read_jsonl(s, lines, "example_id bigint, t array<int>")
    sinks.write_jsonl(windows.stream_windows(e, "t", ["example_id"], 2048, 0, keep_from=512), path)
    back = readers.read_jsonl(s, path, "window_no bigint, n_real int, window array<int>")
    return back.select("window_no", "n_real", F.aggregate("window", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("snk_k10_packed_batch", NEXT_FIT + " SELECT sum(packs + (open > 0)::INTEGER)::BIGINT AS n_packs, sum(used + open)::BIGINT AS real_tokens, round(sum(used + open) / (2048.0::DOUBLE * sum(packs + (open > 0)::INTEGER)), 6) AS efficiency FROM last")
def _(s, d):
    # the packs themselves and one row of statistics made from what was written
    packed, stats = scratch(s, "packed"), scratch(s, "statistics")
    sinks.write_jsonl(next_fit(s, d), packed)
    p = readers.read_jsonl(s, packed, "shard bigint, pack_no bigint, tokens array<int>, mask array<int>")
    used = F.aggregate("mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    sinks.write_report(p.agg(F.count("*").alias("n_packs"), F.sum(used).alias("real_tokens"), F.round(F.sum(used) / (F.lit(2048.0) * F.count("*")), 6).alias("efficiency")), stats)
    return s.read.schema("n_packs bigint, real_tokens bigint, efficiency double").json(stats)


@query("snk_k11_manifest", "SELECT split, count(*) AS n, count(*) FILTER (context IS NULL) AS n_empty FROM examples GROUP BY 1")
def _(s, d):
    path = scratch(s, "manifest")
    sinks.write_report(table(s, d, "examples").groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("context").isNull()).alias("n_empty")), path)
    return s.read.schema("split string, n bigint, n_empty bigint").json(path)


@query("snk_k7_dense", "SELECT example_id, list_sum(target)::BIGINT AS total, len(target)::INTEGER AS n FROM examples WHERE len(target) > 0")
def _(s, d):
    path = scratch(s, "dense")
    table(s, d, "examples").where("size(target) > 0").select("example_id", "target").write.parquet(path)
    return s.read.parquet(path).select("example_id", F.aggregate("target", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.size("target").alias("n"))


@query("snk_k6_splits", "SELECT split, count(*) AS n FROM examples GROUP BY 1")
def _(s, d):
    path = scratch(s, "splits")
    sinks.write_splits(table(s, d, "examples").select("example_id", "split"), path)
    return s.read.parquet(path).groupBy("split").agg(F.count("*").alias("n"))


@query("snk_k9_vocabulary", "SELECT token, freq FROM (SELECT token, count(*) AS freq FROM (SELECT unnest(regexp_extract_all(lower(subject), '[\\p{L}\\p{N}_]+')) AS token FROM commits) GROUP BY 1)")
def _(s, d):
    from tessera.operators import vocabulary

    path = scratch(s, "vocabulary")
    c = table(s, d, "commits").where("subject is not null")
    sinks.write_vocabulary(vocabulary.vocabulary(vocabulary.frequencies(c, "hash", words(F.col("subject"))), 1_000_000), path)
    return s.read.parquet(path).select("token", "freq")


@query("str_windows_batch", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS \"end\", event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def _(s, d):
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = streams.event_windows(e)
    return w.withColumns({"start": F.col("start").cast("timestamp_ntz"), "end": F.col("end").cast("timestamp_ntz"), "total": F.round("total", 4)})


@query("str_windows_stream", "SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(s, d):
    batch = table(s, d, "events")
    source = scratch(s, "stream-in")
    batch.withColumn("ts", F.col("ts").cast("timestamp")).repartition(4).write.parquet(source)
    path, state = scratch(s, "stream-out"), scratch(s, "stream-state")
    live = s.readStream.schema(s.read.parquet(source).schema).option("maxFilesPerTrigger", 2).parquet(source)

    def keep(df, _):
        df.write.mode("overwrite").parquet(path)

    q = streams.event_windows(live).writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.parquet(path).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("str_sessions", """WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL '30 minutes', true) AS fresh FROM events), n AS (SELECT *, sum(fresh::INT) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS start, count(*) AS n FROM n GROUP BY user_id, k""")  # fmt: skip
def _(s, d):
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return streams.sessions(e).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("str_token_windows", "SELECT k, (total - 512) // 384 + 1 AS n_windows, (total - 512) // 384 AS last FROM (SELECT (pack_id - 1) // 100 AS k, sum(len(tokens))::BIGINT AS total FROM packed_sequences WHERE len(tokens) > 0 GROUP BY 1) WHERE total >= 512")
def _(s, d):
    # a stream of token lists for every hundred packs, of which one window may go on into the next list
    p = table(s, d, "packed_sequences").where("size(tokens) > 0").select(F.floor((F.col("pack_id") - 1) / 100).alias("k"), F.col("pack_id").alias("pos"), "tokens")
    source, path, state = scratch(s, "tokens-in"), scratch(s, "tokens-out"), scratch(s, "tokens-state")
    p.write.parquet(source)
    live = s.readStream.schema(s.read.parquet(source).schema).parquet(source)
    q = streams.token_windows(live, "k", "tokens", 512, 128).writeStream.format("parquet").option("path", path).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return s.read.parquet(path).groupBy("k").agg(F.count("*").alias("n_windows"), F.max("window_no").alias("last"))


@query("str_follow_metrics", signal_sql("event_id, converged, reduce_lr, overfitting"))
def _(s, d):
    # the series arrives in three parts, one after another
    e = metric_series(s, d)
    source, path, state = scratch(s, "metrics-in"), scratch(s, "metrics-out"), scratch(s, "metrics-state")
    cuts = e.approxQuantile("t", [1 / 3, 2 / 3], 0.01) if not e.isEmpty() else [0, 0]
    for part in (F.col("t") < cuts[0], F.col("t").between(cuts[0], cuts[1]), F.col("t") > cuts[1]):
        e.where(part).coalesce(1).write.mode("append").parquet(source)
    live = s.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(source)
    streams.follow_metrics(live, path, state, ["user_id"], ["t", "event_id"], "train", "val").awaitTermination()
    return s.read.parquet(path).select("event_id", "converged", "reduce_lr", "overfitting")


@query("snk_stage_once", "SELECT count(*) AS n FROM examples")
def _(s, d):
    path = scratch(s, "stage")
    sinks.write_if_missing(table(s, d, "examples").select("example_id"), path)
    sinks.write_if_missing(table(s, d, "examples").limit(0).select("example_id"), path)
    return s.read.parquet(path).agg(F.count("*").alias("n"))


@query("pln_p51_lengths", "SELECT e::INTEGER AS epoch, round_even(256 + 1792 * (e / 9.0::DOUBLE), 0)::INTEGER AS max_length FROM range(10) t(e)")
def _(s, d):
    e = s.range(10).select(F.col("id").cast("int").alias("epoch"))
    return e.withColumn("max_length", formulas.curriculum_length(F.col("epoch"), 10, 256, 2048))


@query("pln_p52_stages", "SELECT * FROM (VALUES (1, 2, 8192), (3, 5, 16384), (6, 9, 32768), (10, 13, 65536), (14, 20, 131072)) t(first_epoch, last_epoch, context)")
def _(s, d):
    return formulas.stage_table(s, 20, 131072)


@query("pln_p53_projection", "SELECT e::INTEGER AS epoch, round(4.0 - (4.0 - 2.0) * (1 - pow(0.9, e)), 6)::DOUBLE AS value FROM range(1, 21) t(e)")
def _(s, d):
    return formulas.decay_projection(s, 20, 4.0, 2.0, 0.9).select("epoch", F.round("value", 6).alias("value"))


@query("pln_p56_human_time", "SELECT i, CASE WHEN i < 60 THEN format('{:.0f}s', i::DOUBLE) WHEN i < 3600 THEN format('{:.1f}m', i / 60.0::DOUBLE) ELSE format('{:.1f}h', i / 3600.0::DOUBLE) END AS text FROM range(30, 9000, 60) t(i)")
def _(s, d):
    return s.range(30, 9000, 60).select(F.col("id").alias("i"), formulas.human_time(F.col("id")).alias("text"))


@query("pln_pipeline_history")
def _(s, d):
    return pipelines.history_sequences(table(s, d, "commits"), 256, 64, 20_000).select("window_no", "n_real", F.size("window").alias("n"))


@query("pln_pipeline_chunks")
def _(s, d):
    return pipelines.chunk_examples(table(s, d, "code_chunks"), 512, 64, 20_000).groupBy("split").agg(F.count("*").alias("n"), F.sum("num_chunks").alias("chunks"))


@query("pln_pipeline_files")
def _(s, d):
    return pipelines.file_corpus(table(s, d, "documents"), 256).groupBy("split", "priority").agg(F.count("*").alias("n"))


@query("srt_t8_first_words", "SELECT doc_id, array_to_string(regexp_extract_all(lower(replace(text, chr(304), 'i' || chr(775))), '[\\p{L}\\p{N}_]+')[:10], ' ') AS head FROM documents WHERE text IS NOT NULL")
def _(s, d):
    docs = table(s, d, "documents").where("text is not null")
    return docs.select("doc_id", F.array_join(F.slice(words(F.col("text")), 1, 10), " ").alias("head"))


@query("srt_t5_entropy_order", """WITH t AS (SELECT pack_id, unnest(tokens) AS t, len(tokens) AS n FROM packed_sequences WHERE len(tokens) >= 2), c AS (SELECT pack_id, t, n, count(*) AS c FROM t GROUP BY 1, 2, 3), e AS (SELECT pack_id, -sum(c / n::DOUBLE * log2(c / n::DOUBLE)) AS h FROM c GROUP BY 1),
    k AS (SELECT p.pack_id, CASE WHEN len(p.tokens) < 2 THEN 0.0::DOUBLE ELSE round(greatest(least(1.0::DOUBLE, h / 8), 0), 5) END AS h FROM packed_sequences p LEFT JOIN e USING (pack_id) WHERE p.tokens IS NOT NULL)
    SELECT pack_id, h AS entropy, row_number() OVER (ORDER BY 1.0::DOUBLE - h, pack_id NULLS FIRST) - 1 AS place FROM k""")  # fmt: skip
def _(s, d):
    p = table(s, d, "packed_sequences").where("tokens is not null").select("pack_id", F.round(T.entropy8(F.col("tokens")), 5).alias("entropy"))
    return sampling.ranked(p.withColumn("low", F.lit(1.0) - F.col("entropy")), ["low", "pack_id"]).select("pack_id", "entropy", F.col("rank_").alias("place"))


@query("srt_t2_complexity_order", "SELECT hash, scraped_at, row_number() OVER (ORDER BY coalesce(complexity_score, 0), hash NULLS FIRST, scraped_at NULLS FIRST) - 1 AS place FROM commits")
def _(s, d):
    c = table(s, d, "commits").select("hash", "scraped_at", F.coalesce("complexity_score", F.lit(0.0)).alias("complexity"))
    return sampling.ranked(c, ["complexity", "hash", "scraped_at"]).select("hash", "scraped_at", F.col("rank_").alias("place"))


@query("srt_t11_f9_limits", "SELECT pack_id FROM packed_sequences WHERE len(tokens) >= 512 ORDER BY pack_id LIMIT 25")
def _(s, d):
    return table(s, d, "packed_sequences").where("size(tokens) >= 512").select("pack_id").orderBy("pack_id").limit(25)


@query("agg_a32_merge_totals", "SELECT 'packs' AS source, count(*) AS n, sum(len(tokens))::BIGINT AS tokens FROM packed_sequences UNION ALL SELECT 'examples', count(*), sum(len(context))::BIGINT FROM examples")
def _(s, d):
    a = table(s, d, "packed_sequences").select(F.lit("packs").alias("source"), F.col("tokens").alias("t"))
    b = table(s, d, "examples").select(F.lit("examples").alias("source"), F.col("context").alias("t"))
    return a.unionByName(b).groupBy("source").agg(F.count("*").alias("n"), F.sum(F.when(F.col("t").isNotNull(), F.size("t"))).alias("tokens"))


@query("join_j14_representative", "SELECT commit_hash, arg_max(chunk_id, struct_pack(a := coalesce(additions, 0), c := chunk_id)) AS best FROM code_chunks GROUP BY 1")
def _(s, d):
    return table(s, d, "code_chunks").groupBy("commit_hash").agg(F.max_by("chunk_id", F.struct(F.coalesce("additions", F.lit(0)), "chunk_id")).alias("best"))


@query("pln_p50_steps", "SELECT pack_id, ceil(len(tokens) / 48.0)::BIGINT * 3 AS steps FROM packed_sequences WHERE tokens IS NOT NULL")
def _(s, d):
    return table(s, d, "packed_sequences").where("tokens is not null").select("pack_id", formulas.steps(F.size("tokens"), 48, F.lit(3)).alias("steps"))


@query("pln_p54_tiers", """WITH t AS (SELECT tier, (context::BIGINT * (2 * 32 * 2560 * 2) + context * (32 * 2560 * 2 * 0.25::DOUBLE)) / 1073741824.0::DOUBLE AS gb FROM (VALUES (1, 4096), (2, 8192), (3, 16384), (4, 32768), (5, 57344)) t(tier, context)), b AS (SELECT DISTINCT capacity, capacity / 1000.0::DOUBLE AS budget FROM pack_budgets)
    SELECT capacity, (SELECT max(tier) FROM t WHERE gb <= budget) AS tier FROM b""")  # fmt: skip
def _(s, d):
    t = s.createDataFrame([(1, 4096), (2, 8192), (3, 16384), (4, 32768), (5, 57344)], "tier int, context int").withColumn("gb", formulas.attention_gb(F.col("context")))
    b = table(s, d, "pack_budgets").select("capacity", (F.col("capacity") / 1000.0).alias("budget")).distinct()
    return formulas.highest_fitting(t, "tier", "gb", b, "budget").select("capacity", "tier")


@query("pln_p55_hours", """SELECT split, round(greatest(1, floor(n / greatest(1, floor(2048 / mean)))) * 0.12 / 3600.0::DOUBLE, 9)::DOUBLE AS hours FROM (SELECT split, count(*) AS n, avg(len(context)) AS mean FROM examples WHERE len(context) > 0 GROUP BY 1)""")
def _(s, d):
    e = table(s, d, "examples").where("size(context) > 0").groupBy("split").agg(F.count("*").alias("n"), F.avg(F.size("context")).alias("mean"))
    return e.select("split", F.round(formulas.hours(F.col("n"), F.col("mean"), F.lit(2048), F.lit(0.12)), 9).alias("hours"))


@query("lin_n9_attention", """WITH e AS (SELECT vec_id // 64 AS seq, vec_id % 64 AS i, embedding::DOUBLE[] AS v FROM embeddings), s AS (SELECT a.seq, a.i, b.v, list_dot_product(a.v, b.v) * 0.125 AS s FROM e a JOIN e b ON a.seq = b.seq AND b.i <= a.i), w AS (SELECT seq, i, v, exp(s - max(s) OVER (PARTITION BY seq, i)) AS w FROM s),
    c AS (SELECT seq, i, w, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM w), o AS (SELECT seq, i, p, sum(w * x) / sum(w) AS x FROM c GROUP BY 1, 2, 3) SELECT seq, i, round(sqrt(sum(x * x)), 4) AS norm FROM o GROUP BY 1, 2""")  # fmt: skip
def _(s, d):
    from tessera.operators import linalg

    # sequences of 64 vectors
    e = table(s, d, "embeddings").select(F.floor(F.col("vec_id") / 64).alias("seq"), (F.col("vec_id") % 64).alias("i"), F.col("embedding").alias("vector"))
    return linalg.attention(e, e, e, 0.125).select("seq", "i", F.round(linalg.norm(F.col("vector")), 4).alias("norm"))
