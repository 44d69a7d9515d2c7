"""Queries over token sequences: windows, vocabulary, dedup, weighting, splits, signals, packing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import code as C
from tessera.functions import tokens as T
from tessera.operators import dedup, linalg, packs, sampling, serialise, signals, vocabulary, windows
from tessera.queries.registry import query, table


def _sum(c):
    return F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)


_H = "('0x' || substr(md5({}), 1, 8))::BIGINT"


@query("win_w2_by_lang", """WITH d AS (SELECT lang, regexp_extract_all(lower(replace(text, chr(304), 'i' || chr(775))), '[\\p{L}\\p{N}_]+') AS w FROM documents WHERE length(text) >= 100), c AS (SELECT lang, len(w) AS n, unnest(range(0, greatest(1, (len(w) - 128) // 32 + 1))) AS i FROM d WHERE len(w) >= 64)
    SELECT lang, count(*) AS windows, sum(least(128, n - i * 32))::BIGINT AS tokens FROM c GROUP BY 1""")  # fmt: skip
def _(s, d):
    docs = table(s, d, "documents").where(F.length("text") >= 100).select("lang", T.words(F.col("text")).alias("w")).where("size(w) >= 64")
    return windows.counted_windows(docs, "w", 128, 32).groupBy("lang").agg(F.count("*").alias("windows"), F.sum("n_real").alias("tokens"))


@query("win_w1_multi_scale", """WITH p AS (SELECT pack_id, tokens, len(tokens) AS n FROM packed_sequences WHERE len(tokens) > 0), s AS (SELECT * FROM (VALUES (256, 64), (512, 128)) t(w, st)), c AS (SELECT pack_id, tokens, n, w, unnest(range(0, n, st)) AS i FROM p, s)
    SELECT pack_id, w AS window_size, i::INTEGER AS window_start, list_sum(tokens[i + 1:i + w])::BIGINT AS total FROM c WHERE least(w, n - i) >= w // 2""")  # fmt: skip
def _(s, d):
    p = table(s, d, "packed_sequences").where("size(tokens) > 0").select("pack_id", "tokens")
    return windows.multi_scale_windows(p, "tokens", [256, 512]).select("pack_id", "window_size", "window_start", _sum("window").alias("total"))


_STREAM = """WITH e AS (SELECT example_id, unnest(target) AS t, generate_subscripts(target, 1) AS i FROM examples WHERE len(target) > 0), g AS (SELECT t, row_number() OVER (ORDER BY example_id, i) - 1 AS o FROM e), z AS (SELECT count(*) AS total FROM g)"""


@query("win_w3_w4_stream", _STREAM + """, k AS (SELECT unnest(range(0, (SELECT CASE WHEN total >= 512 THEN (total - 512) // 384 + 1 ELSE 0 END + 1 FROM z))) AS w)
    SELECT w AS window_no, count(*)::INTEGER AS n_real, sum(t)::BIGINT AS total FROM k JOIN g ON o >= w * 384 AND o < w * 384 + 512 GROUP BY 1""")  # fmt: skip
def _(s, d):
    w = windows.stream_windows(table(s, d, "examples"), "target", ["example_id"], 512, 128, pad=0)
    return w.select("window_no", "n_real", _sum("window").alias("total"))


@query("win_w5_concat_cut", """WITH e AS (SELECT example_id, unnest(list_append(target, 2)) AS t, generate_subscripts(list_append(target, 2), 1) AS i FROM examples WHERE len(target) > 0), g AS (SELECT t, row_number() OVER (ORDER BY example_id, i) - 1 AS o FROM e)
    SELECT o // 2048 AS window_no, count(*)::INTEGER AS n_real, sum(t)::BIGINT AS total FROM g GROUP BY 1 HAVING count(*) >= 512""")  # fmt: skip
def _(s, d):
    e = table(s, d, "examples").where("size(target) > 0").select("example_id", F.concat("target", F.array(F.lit(2))).alias("t"))
    return windows.stream_windows(e, "t", ["example_id"], 2048, 0, keep_from=512).select("window_no", "n_real", _sum("window").alias("total"))


@query("win_w6_lines", """WITH l AS (SELECT doc_id, len(string_split(regexp_replace(regexp_replace(text, '\\r\\n|[\\r\\x0b\\x0c\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]', chr(10), 'g'), '\\n$', ''), chr(10))) AS t FROM documents WHERE text <> ''),
    w AS (SELECT doc_id, t, unnest(range(0, greatest(0, ceil((t - 20) / 16.0))::BIGINT + 1)) AS i FROM l) SELECT doc_id, (i * 16 + 1)::INTEGER AS start_line, least(t, i * 16 + 20)::INTEGER AS end_line FROM w""")  # fmt: skip
def _(s, d):
    docs = table(s, d, "documents").where("text <> ''")
    w = docs.select("doc_id", F.explode(windows.line_windows(C.split_lines(F.col("text")), 20, 4)).alias("w"))
    return w.select("doc_id", F.col("w.start_line").cast("int").alias("start_line"), F.col("w.end_line").cast("int").alias("end_line"))


@query("win_w7_context_target", _STREAM + """, k AS (SELECT unnest(range(0, (SELECT (total + 127) // 128 FROM z))) AS w), c AS (SELECT w, count(*) FILTER (o < w * 128 + 256) AS nc, count(*) FILTER (o >= w * 128 + 256) AS nt, sum(t) FILTER (o < w * 128 + 256)::BIGINT AS cs, sum(t) FILTER (o >= w * 128 + 256)::BIGINT AS ts FROM k JOIN g ON o >= w * 128 AND o < w * 128 + 320 GROUP BY 1)
    SELECT w AS window_no, cs AS context_sum, ts AS target_sum FROM c WHERE nc > 128 AND nt > 32 AND w <= (SELECT CASE WHEN total >= 320 THEN (total - 320) // 128 + 1 ELSE 0 END FROM z)""")  # fmt: skip
def _(s, d):
    w = windows.context_targets(table(s, d, "examples"), "target", ["example_id"], 256, 64, 128)
    return w.select("window_no", _sum("context").alias("context_sum"), _sum("target").alias("target_sum"))


@query("win_w9_sliding", """WITH p AS (SELECT pack_id, tokens AS t, len(tokens) AS n FROM packed_sequences WHERE len(tokens) > 64), c AS (SELECT pack_id, t, n, unnest(range(0, n - 64, 51)) AS i FROM p), e AS (SELECT *, least(i + 256, n) AS e FROM c)
    SELECT pack_id, i::INTEGER AS start_idx, list_sum(t[i + 1:i + 256])::BIGINT AS context_sum, list_sum(t[e + 1:e + 64])::BIGINT AS target_sum FROM e WHERE len(t[e + 1:e + 64]) >= 10""")  # fmt: skip
def _(s, d):
    p = table(s, d, "packed_sequences").select("pack_id", F.col("tokens").alias("t"))
    return windows.sliding_examples(p, "t", 256, 64).select("pack_id", "start_idx", _sum("context").alias("context_sum"), _sum("target").alias("target_sum"))


@query("win_w10_pad_mask", "SELECT example_id, list_sum(list_concat(target, [0 for x in range(0, 64)])[:64])::BIGINT AS total, least(len(target), 64)::BIGINT AS real FROM examples WHERE target IS NOT NULL")
def _(s, d):
    return table(s, d, "examples").where("target is not null").select("example_id", _sum(T.fit(F.col("target"), 64)).alias("total"), _sum(T.fit_mask(F.col("target"), 64)).alias("real"))


#: Next fit of every thousand lists into packs of 2048: packs closed, tokens in them, tokens in the open one.
NEXT_FIT = """WITH RECURSIVE p AS (SELECT (pack_id - 1) // 1000 AS shard, least(len(tokens), 2048) AS n, row_number() OVER (PARTITION BY (pack_id - 1) // 1000 ORDER BY pack_id) AS r FROM packed_sequences WHERE len(tokens) > 0),
    s AS (SELECT DISTINCT shard, 0::BIGINT AS r, 0::BIGINT AS packs, 0::BIGINT AS used, 0::BIGINT AS open FROM p UNION ALL
    SELECT shard, r, packs + c::INTEGER + (n >= 2048)::INTEGER, used + CASE WHEN c THEN open ELSE 0 END + CASE WHEN n >= 2048 THEN n ELSE 0 END, CASE WHEN n >= 2048 THEN 0 WHEN c OR open = 0 THEN n ELSE open + 1 + n END
    FROM (SELECT s.shard, p.r, packs, used, open, n, open > 0 AND (n >= 2048 OR open + n + 1 > 2048) AS c FROM s JOIN p ON p.shard = s.shard AND p.r = s.r + 1)), last AS (SELECT shard, arg_max(packs, r) AS packs, arg_max(used, r) AS used, arg_max(open, r) AS open FROM s GROUP BY 1)"""


def next_fit(s, d):
    return packs.next_fit(table(s, d, "packed_sequences"), "tokens", ["pack_id"], F.floor((F.col("pack_id") - 1) / 1000), 2048)


@query("win_w11_next_fit", NEXT_FIT + " SELECT shard, packs + (open > 0)::INTEGER AS n_packs, used + open AS real_tokens FROM last")
def _(s, d):
    return next_fit(s, d).groupBy("shard").agg(F.count("*").alias("n_packs"), F.sum(_sum("mask")).alias("real_tokens"))


@query("win_w12_entropy_pack")
def _(s, d):
    # a budget for every ten lists
    p = table(s, d, "packed_sequences").where("size(tokens) > 0").select(F.floor((F.col("pack_id") - 1) / 10).alias("bin"), "pack_id", "tokens", T.entropy8(F.col("tokens")).alias("h"), F.array(F.floor(F.size("tokens") / 2).cast("int")).alias("points"))
    return packs.by_entropy(p, ["bin"], "pack_id", "tokens", "h", "points", 1024).select("bin", F.size("tokens").alias("n_tokens"), F.size("files").alias("n_files"), "quality_score", "efficiency")


@query("win_w13_max_length", "SELECT least(ceil(max(len(tokens)) / 64.0)::BIGINT * 64, 8192) AS max_length FROM packed_sequences")
def _(s, d):
    return table(s, d, "packed_sequences").agg(F.least((F.ceil(F.max(F.size("tokens")) / 64) * 64), F.lit(8192)).cast("bigint").alias("max_length"))


@query("win_w14_incremental", """WITH c AS (SELECT example_id - 1 AS pos, (example_id - 1) // 10 AS idx, commit_hash FROM examples), f AS (SELECT min(pos) AS p FROM c WHERE idx > 60) SELECT pos, idx FROM c, f WHERE coalesce(p, 610) <= (SELECT max(pos) FROM c) AND pos >= greatest(0, coalesce(p, 610) - 8)""")
def _(s, d):
    e = table(s, d, "examples").select((F.col("example_id") - 1).alias("pos"), F.floor((F.col("example_id") - 1) / 10).alias("idx"), "commit_hash")
    return signals.incremental_slice(e, "pos", "idx", "commit_hash", 60, None, 609, 8).select("pos", "idx")


@query("win_w15_cross_file", """WITH f AS (SELECT commit_hash, filename, list_transform(list_filter(string_split(patch, chr(10)), lambda x: regexp_matches(x, '^[+]\\s*use\\s+')), lambda x: trim(substr(x, 2)))[:5] AS imports FROM file_diffs WHERE filename LIKE '%.rs' AND patch IS NOT NULL)
    SELECT a.commit_hash, a.filename, count(DISTINCT i.imp)::BIGINT AS n_imports FROM (SELECT DISTINCT commit_hash, filename FROM f) a LEFT JOIN (SELECT commit_hash, filename, unnest(imports) AS imp FROM f) i ON a.commit_hash = i.commit_hash AND a.filename <> i.filename GROUP BY 1, 2""")  # fmt: skip
def _(s, d):
    added = F.filter(C.lines_of(F.col("patch")), lambda x: x.rlike(r"^[+]\s*use\s+"))
    f = table(s, d, "file_diffs").where(F.endswith("filename", F.lit(".rs")) & F.col("patch").isNotNull()).select("commit_hash", "filename", F.slice(F.transform(added, lambda x: F.trim(F.substring(x, F.lit(2), F.length(x)))), 1, 5).alias("imports"))
    # all imports of a commit once, with their files; a file's own are left out by filter instead of a self join
    each = f.groupBy("commit_hash").agg(F.collect_set("filename").alias("files"), F.flatten(F.collect_list(F.transform("imports", lambda x: F.struct(F.col("filename").alias("file"), x.alias("imp"))))).alias("all_"))
    return each.select("commit_hash", F.explode("files").alias("filename"), "all_").select("commit_hash", "filename", F.size(F.array_distinct(F.transform(F.filter("all_", lambda x: x["file"] != F.col("filename")), lambda x: x["imp"]))).cast("bigint").alias("n_imports"))


_CODE_TOKENS = "regexp_extract_all(new_code, '[a-zA-Z_][a-zA-Z0-9_]*|[0-9]+|[+\\-*/%=<>!&|^~?:|;,.(\\[\\]{}]')"


def _code(text: str) -> str:
    return _CODE_TOKENS.replace("new_code", text)


_TEXT = "flatten(list_transform(list_filter(regexp_split_to_array({}, '\\s+'), lambda x: x <> ''), lambda w: CASE WHEN right(w, 1) IN ('.', ',') THEN [left(w, length(w) - 1), right(w, 1)] ELSE [w] END))"
_FOUR = " || ".join(f"coalesce({x}, [])" for x in (_code("old_code"), _code("new_code"), _TEXT.format("commit_meta.message"), _code("context_lines")))


@query("agg_a7_a8_vocabulary", f"""WITH a AS (SELECT chunk_id, {_FOUR} AS l FROM code_chunks), t AS (SELECT chunk_id, unnest(l) AS token, generate_subscripts(l, 1) - 1 AS pos FROM a), c AS (SELECT token, count(*) AS freq, min(struct_pack(k := chunk_id, p := pos)) AS f FROM t GROUP BY 1)
    SELECT token, (row_number() OVER (ORDER BY freq DESC, f) - 1 + 5085)::INTEGER AS id, freq FROM c QUALIFY row_number() OVER (ORDER BY freq DESC, f) <= 915""")  # fmt: skip
def _(s, d):
    none = F.array().cast("array<string>")
    four = F.concat(*(F.coalesce(x, none) for x in (T.code_tokens(F.col("old_code")), T.code_tokens(F.col("new_code")), T.text_tokens(F.col("commit_meta.message")), T.code_tokens(F.col("context_lines")))))
    return vocabulary.vocabulary(vocabulary.frequencies(table(s, d, "code_chunks"), "chunk_id", four), 6000)


@query("join_j4_encode", f"""WITH t AS (SELECT chunk_id, unnest({_CODE_TOKENS}) AS token, generate_subscripts({_CODE_TOKENS}, 1) - 1 AS pos FROM code_chunks WHERE new_code IS NOT NULL), c AS (SELECT token, count(*) AS freq, min(struct_pack(k := chunk_id, p := pos)) AS f FROM t GROUP BY 1),
    v AS (SELECT token, row_number() OVER (ORDER BY freq DESC, f) - 1 + 5085 AS id FROM c QUALIFY row_number() OVER (ORDER BY freq DESC, f) <= 915)
    SELECT k.chunk_id, count(t.token) AS n, coalesce(sum(CASE WHEN t.token IS NOT NULL THEN coalesce(id, 1) END), 0)::BIGINT AS total FROM (SELECT chunk_id FROM code_chunks WHERE new_code IS NOT NULL) k LEFT JOIN t USING (chunk_id) LEFT JOIN v USING (token) GROUP BY 1""")  # fmt: skip
def _(s, d):
    chunks = table(s, d, "code_chunks").where("new_code is not null")
    tokens = T.code_tokens(F.col("new_code"))
    vocab = vocabulary.vocabulary(vocabulary.frequencies(chunks, "chunk_id", tokens), 6000)
    return vocabulary.encode(chunks, "chunk_id", tokens, vocab).select("chunk_id", F.size("ids").cast("bigint").alias("n"), _sum("ids").alias("total"))


@query("txt_g15_chunk_sequence", f"""WITH l AS (SELECT chunk_id, ['<COMMIT_START>', '<FILE:' || coalesce(file_path, 'unknown') || '>', '<CHANGE:' || coalesce(change_type, 'unknown') || '>', '<AUTHOR:' || coalesce(commit_meta.author, 'unknown') || '>'] || CASE WHEN commit_meta.timestamp_unix IS NOT NULL THEN ['<TIMESTAMP:' || strftime(make_timestamp(commit_meta.timestamp_unix * 1000000), '%Y-%m') || '>'] ELSE [] END
    || CASE WHEN coalesce(module_path, '') <> '' THEN ['<MODULE:' || module_path || '>'] ELSE [] END || ['<CODE_START>'] || ({_TEXT.format("coalesce(commit_meta.message, '')")})[:64] || ['<CODE_END>'] || CASE WHEN coalesce(old_code, '') <> '' THEN ['<OLD_CODE_START>'] || ({_code("old_code")})[:512] || ['<OLD_CODE_END>'] ELSE [] END
    || ['<NEW_CODE_START>'] || ({_code("coalesce(new_code, '')")})[:2048] || ['<NEW_CODE_END>', '<COMMIT_END>'] AS l FROM code_chunks) SELECT chunk_id, len(l)::INTEGER AS n_tokens, md5(array_to_string(l, ' ')) AS digest FROM l""")  # fmt: skip
def _(s, d):
    return table(s, d, "code_chunks").select("chunk_id", F.size(serialise.chunk_tokens()).alias("n_tokens"), F.md5(F.array_join(serialise.chunk_tokens(), " ").cast("binary")).alias("digest"))


@query("agg_a11_prefix_dedup", """SELECT pack_id FROM packed_sequences WHERE tokens IS NOT NULL QUALIFY row_number() OVER (PARTITION BY list_slice(tokens, 1, 256) ORDER BY pack_id) = 1""")
def _(s, d):
    p = table(s, d, "packed_sequences").where("tokens is not null").select("pack_id", "tokens")
    return dedup.dedup_prefix(p, "tokens", ["pack_id"]).select("pack_id")


_SIG = """WITH w AS (SELECT doc_id, regexp_extract_all(lower(replace(text, chr(304), 'i' || chr(775))), '[\\p{L}\\p{N}_]+') AS w FROM documents WHERE text IS NOT NULL), g AS (SELECT doc_id, unnest(range(1, greatest(len(w) - 3, 1))) AS i, w FROM w WHERE len(w) >= 5), n AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g, i FROM g),
    c AS (SELECT doc_id, g, count(*) AS c, min(i) AS f FROM n GROUP BY 1, 2), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, f) <= 100), m AS (SELECT doc_id, md5(string_agg(g, '' ORDER BY encode(g))) AS signature FROM t GROUP BY 1), s AS (SELECT d.doc_id, coalesce(signature, md5('')) AS signature FROM documents d LEFT JOIN m USING (doc_id) WHERE text IS NOT NULL)"""  # fmt: skip


@query("agg_a12_ngram_signature", _SIG + " SELECT doc_id, signature FROM s")
def _(s, d):
    return dedup.ngram_signatures(table(s, d, "documents").where("text is not null"), "doc_id", "text")


@query("agg_a13_keep_best", _SIG + " SELECT doc_id FROM s JOIN documents USING (doc_id) QUALIFY row_number() OVER (PARTITION BY signature ORDER BY coalesce(n_chars, 0) DESC, doc_id) = 1")
def _(s, d):
    docs = table(s, d, "documents").where("text is not null").select("doc_id", "text", "n_chars")
    return dedup.keep_best(docs, "doc_id", dedup.ngram_signatures(docs, "doc_id", "text"), "n_chars").select("doc_id")


@query("smp_x1_replicate", """WITH e AS (SELECT example_id, CASE example_type WHEN 'commit_based' THEN 3.0 ELSE 0.3 END * CASE WHEN difficulty < 0.6 THEN 1.5 ELSE 1 END AS w FROM examples) SELECT example_id, greatest(1, floor(w))::BIGINT AS copies FROM e""")
def _(s, d):
    e = table(s, d, "examples").select("example_id", F.when(F.col("example_type") == "commit_based", "high").otherwise("low").alias("priority"), (F.col("difficulty") * 100).alias("age"))
    r = sampling.replicate(e, sampling.priority_weight(F.col("priority")) * sampling.age_weight(F.col("age")), ["example_id"])
    return r.groupBy("example_id").agg(F.count("*").alias("copies"))


@query("smp_x2_x3_seq_ids", """WITH e AS (SELECT example_id, unnest(range(1, CASE example_type WHEN 'commit_based' THEN 4 ELSE 2 END)) AS c FROM examples) SELECT example_id, c::INTEGER AS copy_no, row_number() OVER (ORDER BY example_id, c) - 1 AS seq_id FROM e""")
def _(s, d):
    e = table(s, d, "examples").select("example_id", F.when(F.col("example_type") == "commit_based", 3.0).otherwise(1.0).alias("w"))
    return sampling.replicate(e, F.col("w"), ["example_id"]).select("example_id", "copy_no", "seq_id")


@query("smp_x4_upsample_to_1100", f"""WITH b AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents), n AS (SELECT count(*) AS n FROM b), p AS (SELECT {_H.format("'42:' || i::VARCHAR")} % (SELECT n FROM n) AS r FROM range((SELECT n FROM n), 1100) t(i))
    SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM b UNION ALL SELECT doc_id FROM p JOIN b USING (r)) GROUP BY 1""")  # fmt: skip
def _(s, d):
    return sampling.upsample(table(s, d, "documents").select("doc_id"), ["doc_id"], 1100).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("smp_x4_upsample_tenth", f"""WITH b AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS r FROM documents), n AS (SELECT count(*) AS n FROM b), p AS (SELECT {_H.format("'42:' || i::VARCHAR")} % (SELECT n FROM n) AS r FROM range((SELECT n FROM n), (SELECT n + n // 10 FROM n)) t(i))
    SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM b UNION ALL SELECT doc_id FROM p JOIN b USING (r)) GROUP BY 1""")  # fmt: skip
def _(s, d):
    docs = table(s, d, "documents").select("doc_id")
    n = docs.count()
    return sampling.upsample(docs, ["doc_id"], n + n // 10).groupBy("doc_id").agg(F.count("*").alias("n"))


@query("smp_x5_weighted_sample", f"""WITH w AS (SELECT example_id, round((1 + (example_id + 1) / (max(example_id) OVER () + 1)::DOUBLE * 2) * 1000000)::BIGINT AS w FROM examples), c AS (SELECT example_id, w, sum(w) OVER (ORDER BY example_id) - w AS lo FROM w), d AS (SELECT i AS draw, ({_H.format("'42:' || i::VARCHAR")} * 2097152 + {_H.format("'43:' || i::VARCHAR")} % 2097152) % (SELECT sum(w)::BIGINT FROM w) AS x FROM range(1000) t(i))
    SELECT draw, example_id FROM d JOIN c ON x >= lo AND x < lo + w""")  # fmt: skip
def _(s, d):
    e = signals.recency(table(s, d, "examples").select("example_id"), "example_id")
    return sampling.weighted_sample(e, ["example_id"], 1 + F.col("recency") * 2, 1000).select("draw", "example_id")


@query("smp_x6_t7_shuffle_split", f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_H.format("'42:' || doc_id::VARCHAR")}, doc_id) - 1 AS k, count(*) OVER () AS n FROM documents) SELECT doc_id, CASE WHEN k < floor(n * 0.85) THEN 'train' WHEN k < floor(n * 0.95) THEN 'val' ELSE 'test' END AS split FROM r""")
def _(s, d):
    r = sampling.shuffled(table(s, d, "documents").select("doc_id"), ["doc_id"])
    return sampling.split_by_rank(r, (("train", 0.85), ("val", 0.10), ("test", 0.05))).select("doc_id", "split")


@query("smp_x6_leak_free", f"""SELECT chunk_id, CASE WHEN {_H.format("'42:' || coalesce(commit_hash, '')")} % 10000 / 10000.0::DOUBLE < 0.85 THEN 'train' WHEN {_H.format("'42:' || coalesce(commit_hash, '')")} % 10000 / 10000.0::DOUBLE < 0.95 THEN 'val' ELSE 'test' END AS split FROM code_chunks""")
def _(s, d):
    return sampling.leak_free_split(table(s, d, "code_chunks"), ["commit_hash"], (("train", 0.85), ("val", 0.10), ("test", 0.05))).select("chunk_id", "split")


@query("smp_x7_temporal", """WITH r AS (SELECT hash, scraped_at, row_number() OVER (ORDER BY commit_timestamp, hash, scraped_at) - 1 AS k, count(*) OVER () AS n FROM commits WHERE commit_timestamp IS NOT NULL)
    SELECT hash, scraped_at, CASE WHEN k < floor(n * 0.7) THEN 'train' WHEN k < floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split FROM r""")  # fmt: skip
def _(s, d):
    c = table(s, d, "commits").where("commit_timestamp is not null").select("hash", "scraped_at", "commit_timestamp")
    return sampling.temporal_split(c, ["commit_timestamp", "hash", "scraped_at"]).select("hash", "scraped_at", "split")


@query("smp_x8_x9_tail", "SELECT example_id, CASE WHEN row_number() OVER (ORDER BY example_id) - 1 >= count(*) OVER () - least(greatest(1, floor(count(*) OVER () * 0.07)), count(*) OVER () - 1) THEN 'val' ELSE 'train' END AS split FROM examples")
def _(s, d):
    return sampling.tail_split(table(s, d, "examples").select("example_id"), ["example_id"], 0.07).select("example_id", "split")


@query("smp_x10_objective", f"""SELECT example_id, CASE WHEN h < 3000 THEN 'fim' WHEN h < 5000 THEN 'span' ELSE 'lm' END AS objective FROM (SELECT example_id, {_H.format("'7:' || example_id::VARCHAR")} % 10000 AS h FROM examples)""")
def _(s, d):
    return table(s, d, "examples").select("example_id", sampling.objective(7, ["example_id"], 0.3, 0.2).alias("objective"))


@query("smp_x11_g9_g10_contrastive", """SELECT doc_id, 'positive' AS pair_type, md5(regexp_replace(replace(replace(text, '{', ' {'), '}', ' }'), '\\n[\\s\\x0b]*\\n', chr(10), 'g')) AS digest FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT doc_id, 'negative', md5(replace(replace(replace(text, 'return true', 'return SWAP_MARKER'), 'return false', 'return true'), 'return SWAP_MARKER', 'return false')) FROM documents WHERE text IS NOT NULL""")  # fmt: skip
def _(s, d):
    e = table(s, d, "documents").where("text is not null").select("doc_id", F.explode(serialise.contrastive("text", "doc_id")).alias("p"))
    return e.select("doc_id", F.col("p.pair_type").alias("pair_type"), F.md5(F.col("p.text").cast("binary")).alias("digest"))


@query("srt_t2_t6_order", f"""WITH r AS (SELECT example_id, len(context) AS n, row_number() OVER (ORDER BY len(context), example_id) - 1 AS k FROM examples WHERE context IS NOT NULL) SELECT example_id, k // 32 AS bucket, {_H.format("'42:' || example_id::VARCHAR")} AS mix FROM r""")
def _(s, d):
    r = sampling.length_buckets(table(s, d, "examples").where("context is not null").select("example_id", F.size("context").alias("n")), F.col("n"), ["example_id"], 8)
    return r.select("example_id", F.col("bucket_").alias("bucket"), F.col("mix_").alias("mix"))


@query("srt_t1_t9_t10_top", "SELECT branch, count(*) AS n FROM (SELECT unnest(branches) AS branch FROM commits) GROUP BY 1 ORDER BY n DESC, branch LIMIT 10")
def _(s, d):
    b = table(s, d, "commits").select(F.explode("branches").alias("branch")).groupBy("branch").agg(F.count("*").alias("n"))
    return b.orderBy(F.desc("n"), "branch").limit(10)


@query("srt_t4_so1_trim_merged", """WITH u AS (SELECT pack_id AS id, 'packs' AS source, len(tokens) AS n FROM packed_sequences UNION ALL SELECT example_id, 'examples', len(target) FROM examples)
    SELECT id, source, n FROM u ORDER BY CASE source WHEN 'packs' THEN 0 ELSE 9 END, id LIMIT 600""")  # fmt: skip
def _(s, d):
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c)).cast("bigint")
    a = table(s, d, "packed_sequences").select(F.col("pack_id").alias("id"), F.lit("packs").alias("source"), size("tokens").alias("n"))
    b = table(s, d, "examples").select(F.col("example_id").alias("id"), F.lit("examples").alias("source"), size("target").alias("n"))
    return sampling.trim_by_priority(a.unionByName(b), F.when(F.col("source") == "packs", 0).otherwise(9), ["id"], 600)


@query("set_so2_so4_so6", """SELECT (SELECT count(*) FROM (SELECT filename FROM file_diffs INTERSECT SELECT file_path FROM code_chunks)) AS both_, (SELECT count(*) FROM (SELECT filename FROM file_diffs EXCEPT SELECT file_path FROM code_chunks)) AS only_, (SELECT count(*) FROM (SELECT filename FROM file_diffs UNION ALL SELECT file_path FROM code_chunks)) AS all_""")
def _(s, d):
    a, b = table(s, d, "file_diffs").select("filename"), table(s, d, "code_chunks").select(F.col("file_path").alias("filename"))
    both, only, all_ = (x.agg(F.count("*").alias(n)) for x, n in ((a.intersect(b), "both_"), (a.subtract(b), "only_"), (a.unionAll(b), "all_")))
    return both.crossJoin(only).crossJoin(all_)


@query("set_so7_staged", """WITH e AS (SELECT example_id, CASE WHEN difficulty < 0.3 THEN 'easy' WHEN difficulty < 0.6 THEN 'medium' ELSE 'hard' END AS d FROM examples WHERE difficulty IS NOT NULL), f AS (SELECT example_id FROM e WHERE d = 'easy' ORDER BY example_id LIMIT (SELECT count(*) // 5 FROM e WHERE d = 'easy'))
    SELECT example_id, 'foundation' AS stage FROM e WHERE d = 'easy' UNION ALL SELECT example_id, 'intermediate' FROM e WHERE d IN ('easy', 'medium') UNION ALL SELECT example_id, 'advanced' FROM e WHERE d IN ('hard', 'medium') UNION ALL SELECT example_id, 'advanced' FROM f""")  # fmt: skip
def _(s, d):
    q = F.col("difficulty")
    e = table(s, d, "examples").where("difficulty is not null").select("example_id", F.when(q < 0.3, "easy").when(q < 0.6, "medium").otherwise("hard").alias("level"))
    return sampling.staged_curriculum(e, "level", ["example_id"]).select("example_id", "stage")


_EV = "SELECT user_id, event_id, ts, value AS train, value * (1 + (event_id % 7) / 10.0::DOUBLE) AS val FROM events WHERE value IS NOT NULL"


def _series(s, d):
    return table(s, d, "events").where("value is not null").select("user_id", "event_id", "ts", F.col("value").alias("train"), (F.col("value") * (1 + (F.col("event_id") % 7) / F.lit(10.0))).alias("val"))


def signal_sql(columns: str) -> str:
    return f"""WITH e AS ({_EV}), w AS (SELECT *, row_number() OVER s AS n, lag(train, 4) OVER s AS t4, lag(val, 2) OVER s AS v2, lag(val, 4) OVER s AS v4, avg(train) OVER f AS a_t, avg(val) OVER f AS av, stddev_pop(val) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS sd FROM e
    WINDOW s AS (PARTITION BY user_id ORDER BY ts, event_id), f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
    , s AS (SELECT event_id, CASE WHEN n < 5 THEN false ELSE (t4 - train) / greatest(1e-6, t4) < 0.01 END AS converged, CASE WHEN n < 5 THEN false ELSE (t4 - train) / greatest(1e-6, t4) < 0.01 END AND abs(1 + (event_id % 5 - 2) / 16.0::DOUBLE - 1) < 0.1 AS advance_phase, CASE WHEN n < 3 THEN false ELSE (val - v2) / greatest(1e-6, v2) > 0.05 OR (n >= 10 AND sd < 0.001) END AS reduce_lr,
    CASE WHEN n < 5 THEN false ELSE a_t < 0.5 * av AND (val - v4) / greatest(1e-6, v4) > 0.02 END AS overfitting FROM w) SELECT {columns} FROM s"""


def metric_series(s, d):
    """The series with its times as numbers, for sources that hold no times without zone."""
    return _series(s, d).withColumn("t", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


@query("sig_wf3_wf4_wf5_wf7", signal_sql("event_id, converged, advance_phase, reduce_lr, overfitting"))
def _(s, d):
    e = _series(s, d).withColumn("grad", 1 + (F.col("event_id") % 5 - 2) / F.lit(16.0))
    return signals.training_signals(e, ["user_id"], ["ts", "event_id"], "train", "val", "grad").select("event_id", "converged", "advance_phase", "reduce_lr", "overfitting")


@query("sig_wf6_wf8_wf9", f"""WITH e AS ({_EV}) SELECT event_id, coalesce(avg(train) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) > 50, false) AS extend_context,
    coalesce(train > 3 * avg(train) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING), false) AS spike, round(sqrt(var_pop(train) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)), 4) AS deviation FROM e""")  # fmt: skip
def _(s, d):
    e = signals.extend_context(_series(s, d), ["user_id"], ["ts", "event_id"], "train", 50)
    e = signals.spikes(e, ["user_id"], ["ts", "event_id"], "train")
    return signals.rolling_variance(e, ["user_id"], ["ts", "event_id"], "train").select("event_id", "extend_context", "spike", F.round(F.sqrt("variance"), 4).alias("deviation"))


@query("sig_wf10_wf11_wf13", """WITH RECURSIVE e AS (SELECT user_id, value AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events WHERE value IS NOT NULL),
    r AS (SELECT DISTINCT user_id, -1::BIGINT AS i, 'inf'::DOUBLE AS best, 0 AS wait, -1::BIGINT AS stop, NULL::DOUBLE AS ema, 2048 AS seq, 8 AS rank FROM e UNION ALL
    SELECT r.user_id, e.i, CASE WHEN stop < 0 AND x < best - 0.01 THEN x ELSE best END, CASE WHEN stop >= 0 THEN wait WHEN x < best - 0.01 THEN 0 ELSE wait + 1 END, CASE WHEN stop >= 0 THEN stop WHEN NOT x < best - 0.01 AND wait + 1 >= 5 THEN e.i ELSE -1 END,
    CASE WHEN e.i = 0 THEN x ELSE 0.9::DOUBLE * ema + (1 - 0.9::DOUBLE) * x END, CASE WHEN x > 90 THEN least(8192, (floor(seq * 1.25)::INTEGER + 511) // 512 * 512) ELSE seq END, CASE WHEN x > 90 THEN least(64, floor(rank * 1.2)::INTEGER) ELSE rank END FROM r JOIN e ON e.user_id = r.user_id AND e.i = r.i + 1)
    SELECT user_id, arg_max(best, i) AS best, arg_max(stop, i)::INTEGER AS stopped_at, round(arg_max(ema, i), 6) AS ema, arg_max(seq, i)::INTEGER AS seq, arg_max(rank, i)::INTEGER AS rank FROM r GROUP BY 1""")  # fmt: skip
def _(s, d):
    v = signals.series(_series(s, d), ["user_id"], ["ts", "event_id"], "train")
    flags = F.transform("values", lambda x: F.struct((x > 90).alias("extend"), (x < 5).alias("reduce")))
    v = v.select("user_id", signals.early_stop(F.col("values"), 0.01, 5).alias("e"), F.round(signals.ema(F.col("values"), 0.9), 6).alias("ema"), signals.controls(flags, 2048, 1e-4, 4, 8, 8192).alias("c"))
    return v.select("user_id", F.col("e.best").alias("best"), F.col("e.stopped_at").alias("stopped_at"), "ema", F.col("c.seq").alias("seq"), F.col("c.rank").alias("rank"))


@query("sig_wf12_recency", "SELECT example_id, round((example_id + 1) / (max(example_id) OVER () + 1)::DOUBLE, 6) AS recency FROM examples")
def _(s, d):
    return signals.recency(table(s, d, "examples").select("example_id"), "example_id").select("example_id", F.round("recency", 6).alias("recency"))


@query("agg_a23_curriculum_weights", """WITH w AS (SELECT commit_hash, 1 + 2 * (example_id + 1) / (max(example_id) OVER () + 1)::DOUBLE + CASE WHEN file_path <> '' THEN 0.5 ELSE 0 END AS w FROM examples) SELECT round(avg(w), 6) AS mean, round(max(w), 6) AS most, round(stddev_pop(w), 6) AS std, count(*) AS n FROM w""")
def _(s, d):
    e = signals.recency(table(s, d, "examples").select("example_id", "file_path"), "example_id").select((1 + 2 * F.col("recency") + F.when(F.col("file_path") != "", 0.5).otherwise(0.0)).alias("w"))
    return e.agg(F.round(F.avg("w"), 6).alias("mean"), F.round(F.max("w"), 6).alias("most"), F.round(F.stddev_pop("w"), 6).alias("std"), F.count("*").alias("n"))


@query("agg_a23_top_commits", """WITH w AS (SELECT commit_hash, 1 + 2 * (example_id + 1) / (max(example_id) OVER () + 1)::DOUBLE AS w FROM examples) SELECT commit_hash, round(sum(w), 6) AS weight FROM w WHERE commit_hash IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def _(s, d):
    e = signals.recency(table(s, d, "examples").select("example_id", "commit_hash"), "example_id").where("commit_hash is not null")
    return e.groupBy("commit_hash").agg(F.round(F.sum(1 + 2 * F.col("recency")), 6).alias("weight")).orderBy(F.desc("weight"), "commit_hash").limit(3)


@query("agg_a24_hardware", """SELECT metric, round(min(v), 6) AS least, round(max(v), 6) AS most, round(avg(v), 6) AS mean FROM (SELECT unnest(['value', 'hour']) AS metric, unnest([value, hour(ts)::DOUBLE]) AS v FROM events) GROUP BY 1""")
def _(s, d):
    e = table(s, d, "events").select("event_id", "value", F.hour("ts").cast("double").alias("hour")).unpivot("event_id", ["value", "hour"], "metric", "v")
    return e.groupBy("metric").agg(F.round(F.min("v"), 6).alias("least"), F.round(F.max("v"), 6).alias("most"), F.round(F.avg("v"), 6).alias("mean"))


@query("agg_a25_experiments", "SELECT user_id, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts, min(value) AS best, arg_max(value, struct_pack(t := ts, e := event_id)) AS final FROM events GROUP BY 1")
def _(s, d):
    return table(s, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.min("value").alias("best"), F.max_by("value", F.struct("ts", "event_id")).alias("final"))


@query("agg_a26_perplexity", "SELECT example_type, round(sum(difficulty * len(target)) / sum(len(target)), 6) AS loss, round(exp(sum(difficulty * len(target)) / sum(len(target))), 6) AS perplexity FROM examples WHERE len(target) > 0 AND difficulty IS NOT NULL GROUP BY 1")
def _(s, d):
    e = table(s, d, "examples").where("size(target) > 0 and difficulty is not null").withColumn("n", F.size("target"))
    return signals.mean_and_perplexity(e, "difficulty", "n", ["example_type"]).select("example_type", F.round("loss", 6).alias("loss"), F.round("perplexity", 6).alias("perplexity"))


@query("agg_a27_norms", "SELECT user_id, round(sqrt(sum(value * value)), 4) AS l2, round(avg(value), 6) AS mean, max(value) AS most FROM events GROUP BY 1")
def _(s, d):
    v = F.col("value")
    return table(s, d, "events").groupBy("user_id").agg(F.round(F.sqrt(F.sum(v * v)), 4).alias("l2"), F.round(F.avg(v), 6).alias("mean"), F.max(v).alias("most"))


@query("txt_g1_g4_rewrites", """SELECT doc_id, md5(regexp_replace(text, 'let ([0-9A-Za-z_]+) =', 'let \\1: _ =', 'g')) AS typed, md5(CASE WHEN contains(text, 'fn ') AND NOT contains(left(text, 200), 'Result<') THEN left(text, instr(text, 'fn ') - 1) || '// Error-aware version' || chr(10) || substr(text, instr(text, 'fn ')) ELSE text END) AS commented FROM documents WHERE lang = 'rust' AND text IS NOT NULL""")
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").where("lang = 'rust' and text is not null").select("doc_id", F.md5(serialise.typed_lets(t).cast("binary")).alias("typed"), F.md5(serialise.error_comment(t).cast("binary")).alias("commented"))


def _renames(pairs) -> str:
    out = "text"
    for old, new in pairs:
        out = _renamed(out, old, new)
    return out


def _renamed(text: str, old: str, new: str) -> str:
    """Whole words of any script replaced, twice because neighbours share what parts them."""
    edge = "[^\\p{L}\\p{N}\\p{Mn}_]"
    for _ in range(2):
        text = f"regexp_replace({text}, '(^|{edge})({old})($|{edge})', '\\1{new}\\3', 'g')"
    return text


@query("txt_g1_g7_renames", f"SELECT doc_id, md5({_renames(serialise.RENAMES_LONG)}) AS long, md5({_renames(serialise.RENAMES_SHORT)}) AS short, md5({_renamed('text', 'x|i|j|temp', '\\2_var')}) AS suffixed FROM documents WHERE text IS NOT NULL")
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").where("text is not null").select("doc_id", F.md5(serialise.renamed(t).cast("binary")).alias("long"), F.md5(serialise.renamed(t, serialise.RENAMES_SHORT).cast("binary")).alias("short"), F.md5(serialise.suffixed(t).cast("binary")).alias("suffixed"))


@query("txt_g2_syntax_renames")
def _(s, d):
    docs = table(s, d, "documents").where("lang = 'python' and text is not null")
    return docs.select("doc_id", F.md5(serialise.renamed_ast(F.col("text")).cast("binary")).alias("by_tree"))


@query("txt_g5_g6_headers", """WITH i AS (SELECT doc_id, text, list_sort(regexp_extract_all(text, 'use\\s+([\\w:]+)', 1)) AS u FROM documents WHERE text IS NOT NULL) SELECT doc_id, md5(CASE WHEN len(u) > 0 THEN '// Dependencies: ' || array_to_string(u[:5], ', ') || chr(10) || text ELSE text END) AS deps, md5(CASE WHEN doc_id % 120 < 30 THEN '// Recently modified' WHEN doc_id % 120 < 90 THEN '// Modified this quarter' ELSE '// Stable code' END || chr(10) || text) AS head FROM i""")
def _(s, d):
    t = F.col("text")
    docs = table(s, d, "documents").where("text is not null")
    return docs.select("doc_id", F.md5(serialise.dependency_header(t, F.regexp_extract_all(t, F.lit(r"use\s+([\w:]+)"), F.lit(1))).cast("binary")).alias("deps"), F.md5(serialise.age_header(t, F.col("doc_id") % 120).cast("binary")).alias("head"))


@query("txt_g8_masking", f"""WITH t AS (SELECT chunk_id, unnest({_CODE_TOKENS}) AS token, generate_subscripts({_CODE_TOKENS}, 1) - 1 AS pos FROM code_chunks WHERE new_code IS NOT NULL) SELECT chunk_id, count(*) AS n, count(*) FILTER ({_H.format("'3:' || chunk_id || ':' || pos::VARCHAR")} % 10000 < 1000) AS n_masked FROM t GROUP BY 1""")
def _(s, d):
    m = serialise.masked(T.code_tokens(F.col("new_code")), 0.10, 3, "chunk_id")
    c = table(s, d, "code_chunks").where("new_code is not null").select("chunk_id", m.alias("m")).where("size(m) > 0")
    return c.select("chunk_id", F.size("m").cast("bigint").alias("n"), F.size(F.filter("m", lambda x: x == "[MASK]")).cast("bigint").alias("n_masked"))


_ENDS = "[\\r\\x{85}\\x{2028}\\x{2029}]"


@query("txt_g11_g12_comments_format", f"""SELECT doc_id, md5(array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: CASE WHEN regexp_matches(x, '//|#') AND {_H.format("'5:' || doc_id::VARCHAR || ':' || (i - 1)::VARCHAR")} % 10000 < 5000 THEN regexp_replace(x, '(//|#)[^\\r\\x{{85}}\\x{{2028}}\\x{{2029}}]*({_ENDS}?)$', '\\2') ELSE x END), chr(10))) AS plain,
    md5(CASE WHEN {_H.format("'6:' || doc_id::VARCHAR")} % 10000 < 5000 THEN regexp_replace(text, '\\n[ \\t\\n\\x0b\\f\\r]*\\n', chr(10), 'g') ELSE replace(replace(text, '}} else {{', '}}' || chr(10) || 'else {{'), '; ', ';' || chr(10)) END) AS formatted FROM documents WHERE text IS NOT NULL""")  # fmt: skip
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").where("text is not null").select("doc_id", F.md5(serialise.without_comments(t, 5, "doc_id").cast("binary")).alias("plain"), F.md5(serialise.reformatted(t, 6, "doc_id").cast("binary")).alias("formatted"))


@query("txt_g16_commit_block", """SELECT hash, scraped_at, concat_ws(chr(10), '<COMMIT> ' || coalesce(abbrev_hash, ''), '<AUTHOR> ' || coalesce(author_name, ''), '<TIMESTAMP> ' || coalesce(commit_timestamp::VARCHAR, ''), CASE WHEN len(branches) > 0 THEN '<BRANCH> ' || array_to_string(branches, ' ') END,
    '<COMPLEXITY> ' || format('{:.2f}', round_even(coalesce(complexity_score, 0), 2)), CASE WHEN is_merge THEN '<MERGE> parents:' || coalesce(len(parents), 0) || ' files:' || coalesce(files_changed, 0) END, '<SUBJECT> ' || coalesce(subject, ''), CASE WHEN coalesce(body, '') <> '' THEN '<BODY> ' || left(body, 200) END,
    CASE WHEN coalesce(insertions, 0) > 0 OR coalesce(deletions, 0) > 0 THEN '  +' || coalesce(insertions, 0) || ' -' || coalesce(deletions, 0) END, CASE WHEN len(related_issues) > 0 THEN '<RELATED> issues: ' || array_to_string(related_issues, ' ') END, '</COMMIT>') AS block FROM commits""")  # fmt: skip
def _(s, d):
    return table(s, d, "commits").select("hash", "scraped_at", serialise.commit_block().alias("block"))


@query("txt_g17_flat", "SELECT hash, scraped_at, concat_ws(' ', '<COMMIT>', abbrev_hash, '<AUTHOR>', author_name, '<MSG>', subject, '</COMMIT>') AS flat FROM commits")
def _(s, d):
    return table(s, d, "commits").select("hash", "scraped_at", serialise.commit_flat().alias("flat"))


@query("txt_g18_g19_snapshot", "SELECT doc_id, md5(concat_ws(chr(10), '<FILE> ' || coalesce(path, 'unknown'), '<LANG> ' || coalesce(lang, 'unknown'), text, '</FILE>')) AS block, md5(coalesce(path, '') || chr(10) || left(coalesce(text, ''), 2048)) AS embedding_text FROM documents")
def _(s, d):
    from tessera.operators.embedding import snapshot_text

    return table(s, d, "documents").select("doc_id", F.md5(serialise.snapshot_block().cast("binary")).alias("block"), F.md5(snapshot_text().cast("binary")).alias("embedding_text"))


@query("txt_g20_k8_points")
def _(s, d):
    from tessera.operators import embedding as E

    c = table(s, d, "commits").dropDuplicates(["hash"])
    v = E.hashed_vectors(c.select("hash", E.commit_text().alias("t")), "hash", "t")
    return E.points(v, c.select("hash", E.commit_payload().alias("payload")), "hash").select("id", F.size("vector").alias("n"), F.round(linalg.norm(F.col("vector")), 4).alias("norm"), F.col("payload.type").alias("type"))


@query("lin_n1_n3_elementwise", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE + x * 2.0)), 4) AS total, 64::INTEGER AS n FROM embeddings")
def _(s, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    z = linalg.add(e, linalg.mul(e, linalg.filled(2.0, 1)))
    return table(s, d, "embeddings").select("vec_id", F.round(linalg.total(z), 4).alias("total"), F.size(linalg.add(z, linalg.filled(0.0, F.size("embedding")))).alias("n"))


@query("lin_n4_safe_division", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: CASE WHEN label = 0 THEN 0 ELSE x::DOUBLE / label END)), 5) AS total FROM embeddings")
def _(s, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    return table(s, d, "embeddings").select("vec_id", F.round(linalg.total(linalg.div(e, F.array(F.col("label").cast("double")), True)), 5).alias("total"))


_COO = "WITH m AS (SELECT vec_id AS i, generate_subscripts(embedding, 1) - 1 AS j, unnest(embedding) AS v FROM embeddings)"


@query("lin_n2_n5_matmul", _COO + " SELECT a.j AS i, b.j AS j, round(sum(a.v::DOUBLE * b.v), 4) AS value FROM m a JOIN m b ON a.i = b.i GROUP BY 1, 2")
def _(s, d):
    m = linalg.to_coo(table(s, d, "embeddings"), "vec_id", "embedding")
    p = linalg.matmul(linalg.transpose(m), m)
    return p.select(F.col("i").cast("bigint").alias("i"), F.col("j").cast("bigint").alias("j"), F.round("value", 4).alias("value"))


@query("lin_n6_n7_reduce", _COO + " SELECT j, round(sum(v::DOUBLE), 4) AS total, round(avg(v::DOUBLE), 6) AS mean FROM m GROUP BY 1")
def _(s, d):
    m = linalg.to_coo(table(s, d, "embeddings"), "vec_id", "embedding")
    t, a = linalg.reduce_axis(m, 0), linalg.reduce_axis(m, 0, "mean").withColumnRenamed("value", "mean")
    return t.join(a, "j").select(F.col("j").cast("bigint").alias("j"), F.round("value", 4).alias("total"), F.round("mean", 6).alias("mean"))


@query("lin_n10_quantise", """WITH g AS (SELECT vec_id, generate_subscripts(embedding, 1) AS k, unnest(embedding)::DOUBLE AS x FROM embeddings), s AS (SELECT *, greatest(max(abs(x)) OVER (PARTITION BY vec_id, (k - 1) // 32) / 127, 1e-8) AS sc FROM g)
    SELECT vec_id, round(sum(sc), 6) AS scales, sum(greatest(-127, least(127, round_even(x / sc, 0))))::BIGINT AS codes FROM s GROUP BY 1""")  # fmt: skip
def _(s, d):
    q = table(s, d, "embeddings").select("vec_id", linalg.quantise(F.col("embedding"), 32).alias("q"))
    return q.select("vec_id", F.round(F.aggregate("q", F.lit(0.0), lambda a, g: a + g["scale"] * 32), 6).alias("scales"), F.aggregate("q", F.lit(0).cast("bigint"), lambda a, g: a + F.aggregate(g["codes"], F.lit(0).cast("bigint"), lambda b, c: b + c)).alias("codes"))


@query("lin_n11_nearest", """WITH q AS (SELECT * FROM embeddings WHERE vec_id % 20 = 0), s AS (SELECT q.vec_id AS query, e.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]) AS c FROM q, embeddings e WHERE q.vec_id <> e.vec_id) SELECT query, arg_max(vec_id, struct_pack(c := round(c, 9), k := -vec_id)) AS neighbour, round(max(c), 4) AS best, count(*) AS compared FROM s GROUP BY 1""")
def _(s, d):
    e = table(s, d, "embeddings")
    near = linalg.nearest(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 1)
    n = e.agg(F.count("*").alias("n"))
    return near.crossJoin(n).select("query", F.col("vec_id").alias("neighbour"), F.round("similarity", 4).alias("best"), (F.col("n") - 1).alias("compared"))


_C = "(SELECT * FROM commits QUALIFY row_number() OVER (PARTITION BY hash ORDER BY scraped_at DESC) = 1)"


@query("txt_g17_styles", f"""WITH c AS (SELECT *, coalesce(branches[1], '') AS branch FROM {_C}), f AS (SELECT commit_hash AS hash, list_sort(list(DISTINCT filename) FILTER (change_type = 'A')) AS a, list_sort(list(DISTINCT filename) FILTER (change_type = 'M')) AS m, list_sort(list(DISTINCT filename) FILTER (change_type = 'D')) AS x FROM file_diffs WHERE filename IS NOT NULL GROUP BY 1),
    w AS (SELECT hash, branch, lag(hash, 1) OVER o AS h1, lag(branch, 1) OVER o AS b1, lag(hash, 2) OVER o AS h2, lag(branch, 2) OVER o AS b2 FROM c WINDOW o AS (ORDER BY commit_timestamp, hash)), p AS (SELECT hash, concat_ws('|', CASE WHEN b2 = branch THEN left(h2, 8) END, CASE WHEN b1 = branch THEN left(h1, 8) END) AS chain FROM w)
    SELECT c.hash, concat_ws(' ', '<COMMIT>', CASE WHEN is_merge THEN '<MERGE>' END, left(c.hash, 8), '<AUTHOR>', coalesce(author_name, ''), '<MESSAGE>', coalesce(subject, ''), '<INSERTIONS> ' || coalesce(insertions, 0) || ' <DELETIONS> ' || coalesce(deletions, 0)) AS flat,
    concat_ws(' ', '<COMMIT>', left(c.hash, 8), '<AUTHOR>', replace(coalesce(author_name, ''), ' ', '_'), coalesce(author_email, ''), '<BRANCH>', replace(branch, '/', '_'), '<MESSAGE>', left(coalesce(subject, ''), 100), CASE WHEN len(a) > 0 THEN '<FILE_ADD> ' || len(a) END, CASE WHEN len(m) > 0 THEN '<FILE_MOD> ' || len(m) END, CASE WHEN len(x) > 0 THEN '<FILE_DEL> ' || len(x) END,
    '<INSERTIONS> ' || coalesce(insertions, 0) || ' <DELETIONS> ' || coalesce(deletions, 0), CASE WHEN len(m) > 0 THEN 'FILES ' || array_to_string(m[:5], ';') END, CASE WHEN len(parents) > 0 THEN '<PARENT> ' || left(parents[1], 8) END) AS semantic,
    concat_ws(' ', CASE WHEN chain <> '' THEN '<PRED> ' || chain END, '<COMMIT>', left(c.hash, 8), '<BRANCH>', branch, CASE WHEN is_merge THEN '<MERGE> ' || array_to_string(list_transform(parents, lambda q: left(q, 8)), '|') END, '<AUTHOR>', coalesce(author_name, ''), '<MESSAGE>', left(coalesce(subject, ''), 80),
    CASE WHEN coalesce(len(a), 0) + coalesce(len(m), 0) + coalesce(len(x), 0) > 0 THEN 'FILES ' || array_to_string(list_transform(list_concat(coalesce(a, []), coalesce(m, []), coalesce(x, []))[:10], lambda q: string_split(q, '/')[-1]), '|') END) AS hierarchical
    FROM c LEFT JOIN f USING (hash) LEFT JOIN p USING (hash)""")  # fmt: skip
def _(s, d):
    from tessera.operators import history

    c = history.latest(table(s, d, "commits"), ["hash"])
    return serialise.commit_styles(c, table(s, d, "file_diffs")).select("hash", "flat", "semantic", "hierarchical")


@query("txt_g17_diff_aware", f"""WITH f AS (SELECT hash, list_sort(list(DISTINCT struct_pack(f := filename, a := coalesce(additions, 0), d := coalesce(deletions, 0))))[:10] AS l FROM (SELECT commit_hash AS hash, filename, additions, deletions FROM file_diffs WHERE filename IS NOT NULL) GROUP BY 1)
    SELECT c.hash, concat_ws(' ', '<COMMIT>', left(c.hash, 8), '<AUTHOR>', coalesce(author_name, ''), CASE WHEN len(l) > 0 THEN array_to_string(list_transform(l, lambda x: CASE WHEN x.f LIKE '%.rs' THEN '<RS_FILE>' WHEN x.f LIKE '%.toml' THEN '<TOML_FILE>' WHEN x.f LIKE '%.proto' THEN '<PROTO_FILE>' ELSE '<FILE>' END || ' ' || string_split(x.f, '/')[-1] || ' <INSERTIONS> ' || x.a || ' <DELETIONS> ' || x.d), ' ') END,
    '<MESSAGE>', coalesce(subject, '')) AS diff_aware FROM {_C} c LEFT JOIN f USING (hash)""")  # fmt: skip
def _(s, d):
    from tessera.operators import history

    return serialise.commit_styles(history.latest(table(s, d, "commits"), ["hash"]), table(s, d, "file_diffs")).select("hash", "diff_aware")


@query("lin_n8_gradients", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * 2.0)), 4) AS of_mul, round(list_sum(list_transform(embedding, lambda x: -x::DOUBLE / 4.0)), 5) AS of_div, round(1.0 / 64, 6)::DOUBLE AS of_mean FROM embeddings")
def _(s, d):
    e = F.transform("embedding", lambda x: x.cast("double"))
    two, one = linalg.filled(2.0, 1), linalg.filled(1.0, F.size("embedding"))
    ga, _ = linalg.grad_mul(e, e, two)
    _, gb = linalg.grad_div(one, e, linalg.filled(2.0, F.size("embedding")))
    return table(s, d, "embeddings").select("vec_id", F.round(linalg.total(ga), 4).alias("of_mul"), F.round(linalg.total(gb), 5).alias("of_div"), F.round(F.get(linalg.grad_mean(F.lit(1.0), F.size("embedding")), F.lit(0)), 6).alias("of_mean"))
