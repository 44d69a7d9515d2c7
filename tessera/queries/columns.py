"""Scalar derivations and predicates over commits, diffs, chunks and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import code as C
from tessera.functions import messages as M
from tessera.functions import paths as P
from tessera.functions import tokens as T
from tessera.functions.hashing import gate
from tessera.queries.registry import query, table

_MSG = "coalesce(subject, '') || chr(10) || coalesce(body, '')"


def _commits(s: SparkSession, d: str) -> DataFrame:
    m = F.concat(F.coalesce("subject", F.lit("")), F.lit("\n"), F.coalesce("body", F.lit("")))
    return table(s, d, "commits").withColumn("m", m)


def _len(name: str) -> str:
    return f"(length({name}) - length(replace({name}, {{}}, ''))) // length({{}})"


@query("col_p1_subject_body", f"""SELECT hash, scraped_at, regexp_replace(split_part({_MSG}, chr(10), 1), '^\\s+|\\s+$', '', 'g') AS subject_line,
    regexp_replace(substr({_MSG}, instr({_MSG}, chr(10)) + 1), '^\\s+|\\s+$', '', 'g') AS body_text FROM commits""")  # fmt: skip
def _(s, d):
    return _commits(s, d).select("hash", "scraped_at", M.subject_of(F.col("m")).alias("subject_line"), M.body_of(F.col("m")).alias("body_text"))


@query("col_p2_commit_class", f"""SELECT contains(lower({_MSG}), 'squash') AS is_squash, starts_with({_MSG}, 'fixup!') AS is_fixup, starts_with({_MSG}, 'Revert') AS is_revert_commit, count(*) AS n FROM commits GROUP BY ALL""")
def _(s, d):
    m = F.col("m")
    return _commits(s, d).groupBy(M.is_squash(m).alias("is_squash"), M.is_fixup(m).alias("is_fixup"), M.is_revert(m).alias("is_revert_commit")).agg(F.count("*").alias("n"))


@query("col_p3_issue_refs", f"""SELECT hash, scraped_at, array_to_string(list_transform(regexp_extract_all({_MSG}, '#(\\d+)', 1), lambda x: '#' || x), ' ') AS issues FROM commits""")
def _(s, d):
    return _commits(s, d).select("hash", "scraped_at", F.array_join(M.issue_refs(F.col("m")), " ").alias("issues"))


@query("col_p4_commit_refs", f"""SELECT hash, scraped_at, array_to_string(regexp_extract_all({_MSG}, '(?i)\\b([0-9a-f]{{7,40}})\\b', 1), ' ') AS refs FROM commits""")
def _(s, d):
    return _commits(s, d).select("hash", "scraped_at", F.array_join(M.commit_refs(F.col("m")), " ").alias("refs"))


@query("col_p5_p6_path_groups", """SELECT CASE WHEN split_part(filename, '/', 1) = 'crates' AND contains(filename, '/') THEN split_part(filename, '/', 2) ELSE 'root' END AS crate,
    CASE WHEN contains(filename, '/') THEN split_part(filename, '/', 1) ELSE 'root' END AS directory, count(*) AS n FROM file_diffs WHERE filename IS NOT NULL GROUP BY ALL""")  # fmt: skip
def _(s, d):
    f = F.col("filename")
    return table(s, d, "file_diffs").where("filename is not null").groupBy(P.crate_of(f).alias("crate"), P.top_directory(f).alias("directory")).agg(F.count("*").alias("n"))


@query("col_p7_primary_directory", """WITH g AS (SELECT commit_hash, min(filename) FILTER (change_type = 'M') AS m, min(filename) FILTER (change_type = 'A') AS a, min(filename) FILTER (change_type = 'D') AS del FROM file_diffs GROUP BY 1)
    SELECT commit_hash, split_part(coalesce(nullif(m, ''), nullif(a, ''), nullif(del, '')), '/', 1) AS primary_directory FROM g""")  # fmt: skip
def _(s, d):
    def files(kind: str):
        return F.array_sort(F.collect_list(F.when(F.col("change_type") == kind, F.col("filename"))))

    g = table(s, d, "file_diffs").groupBy("commit_hash").agg(files("M").alias("m"), files("A").alias("a"), files("D").alias("del"))
    return g.select("commit_hash", P.primary_directory(F.col("m"), F.col("a"), F.col("del")).alias("primary_directory"))


@query("col_p8_work_time", """SELECT hour(to_timestamp(commit_timestamp) AT TIME ZONE 'UTC') AS work_hour, isodow(to_timestamp(commit_timestamp) AT TIME ZONE 'UTC') - 1 AS weekday, count(*) AS n FROM commits WHERE commit_timestamp IS NOT NULL GROUP BY ALL""")
def _(s, d):
    t = F.to_utc_timestamp(F.timestamp_seconds("commit_timestamp"), F.current_timezone())
    c = table(s, d, "commits").where("commit_timestamp is not null")
    return c.groupBy(F.hour(t).cast("bigint").alias("work_hour"), F.weekday(t).cast("bigint").alias("weekday")).agg(F.count("*").alias("n"))


@query("col_p10_p11_complexity", """SELECT hash, scraped_at, round(least(CASE WHEN is_merge THEN 1.5 ELSE 1.0 END * (least(coalesce(insertions, 0) + coalesce(deletions, 0), 500) / 500.0::DOUBLE * 0.6::DOUBLE + least(coalesce(files_changed, 0), 50) / 50.0::DOUBLE * 0.4::DOUBLE), 1.0), 6)::DOUBLE AS complexity,
    coalesce(insertions, 0) + coalesce(deletions, 0) > 500 OR coalesce(files_changed, 0) > 20 AS high_risk FROM commits""")  # fmt: skip
def _(s, d):
    lines, files = F.coalesce("insertions", F.lit(0)) + F.coalesce("deletions", F.lit(0)), F.coalesce("files_changed", F.lit(0))
    return table(s, d, "commits").select("hash", "scraped_at", F.round(M.complexity(lines, files, F.coalesce("is_merge", F.lit(False))), 6).alias("complexity"), M.high_risk(lines, files).alias("high_risk"))


@query("col_p12_change_kind", """WITH f AS (SELECT contains(patch, 'new file mode') AS n, contains(patch, 'deleted file mode') AS x, coalesce(old_file, '') <> coalesce(new_file, '') AND old_file IS NOT NULL AND new_file IS NOT NULL AS r FROM file_diffs WHERE patch IS NOT NULL)
    SELECT CASE WHEN n THEN 'add' WHEN x THEN 'delete' WHEN r THEN 'rename' ELSE 'modify' END AS kind, CASE WHEN r THEN 'rename' WHEN n THEN 'add' WHEN x THEN 'delete' ELSE 'modify' END AS kind_rename_first, count(*) AS n FROM f GROUP BY ALL""")  # fmt: skip
def _(s, d):
    f = table(s, d, "file_diffs").where("patch is not null")
    new, gone = F.contains("patch", F.lit("new file mode")), F.contains("patch", F.lit("deleted file mode"))
    moved = (F.coalesce("old_file", F.lit("")) != F.coalesce("new_file", F.lit(""))) & F.col("old_file").isNotNull() & F.col("new_file").isNotNull()
    return f.groupBy(M.change_kind(new, gone, moved).alias("kind"), M.change_kind(new, gone, moved, True).alias("kind_rename_first")).agg(F.count("*").alias("n"))


@query("col_p13_diff_counts", """WITH f AS (SELECT diff_id, scraped_at, (length(patch) - length(replace(patch, chr(10) || '+', ''))) // 2 AS a, (length(patch) - length(replace(patch, chr(10) || '-', ''))) // 2 AS r,
    (length(patch) - length(replace(patch, chr(10) || '@@', ''))) // 3 AS h FROM file_diffs WHERE patch IS NOT NULL)
    SELECT diff_id, scraped_at, a AS added, r AS removed, h AS hunks, round((a + r) / (a + r + 1.0::DOUBLE), 6) AS file_complexity FROM f""")  # fmt: skip
def _(s, d):
    a, r, h = C.diff_counts(F.col("patch"))
    f = table(s, d, "file_diffs").where("patch is not null").select("diff_id", "scraped_at", a.alias("added"), r.alias("removed"), h.alias("hunks"))
    return f.withColumn("file_complexity", F.round(C.saturating(F.col("added") + F.col("removed")), 6))


@query("col_p14_stat_line", """SELECT hash, scraped_at, coalesce(files_changed, 0) AS files, coalesce(insertions, 0) AS ins, coalesce(deletions, 0) AS del FROM commits""")
def _(s, d):
    # the stat line is written as the version-control tool writes it and parsed again
    def part(n, word, tail=""):
        return F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {word}"), F.when(n == 1, "").otherwise("s"), F.lit(tail)))

    files, ins, dele = (F.coalesce(c, F.lit(0)) for c in ("files_changed", "insertions", "deletions"))
    stat = F.concat(F.lit(" "), F.concat_ws(", ", F.concat(part(files, "file"), F.lit(" changed")), part(ins, "insertion", "(+)"), part(dele, "deletion", "(-)")))
    a, b, c = M.stat_numbers(F.col("stat"))
    return table(s, d, "commits").withColumn("stat", stat).select("hash", "scraped_at", a.alias("files"), b.alias("ins"), c.alias("del"))


_LINES = "string_split({}, chr(10))"


@query("col_p15_patch_lines", f"""WITH f AS (SELECT chunk_id, {_LINES.format('patch')} AS l FROM code_chunks WHERE patch IS NOT NULL)
    SELECT chunk_id, len(list_filter(l, lambda x: starts_with(x, '+') AND NOT starts_with(x, '+++ '))) AS n_added, len(list_filter(l, lambda x: starts_with(x, '-') AND NOT starts_with(x, '--- '))) AS n_removed,
    md5(array_to_string(list_transform(list_filter(l, lambda x: starts_with(x, '+') AND NOT starts_with(x, '+++ ')), lambda x: substr(x, 2)), chr(10))) AS added_md5 FROM f""")  # fmt: skip
def _(s, d):
    p = F.col("patch")
    a, r = C.added_lines(p), C.removed_lines(p)
    return table(s, d, "code_chunks").where("patch is not null").select("chunk_id", F.size(a).cast("bigint").alias("n_added"), F.size(r).cast("bigint").alias("n_removed"), F.md5(F.array_join(a, "\n").cast("binary")).alias("added_md5"))


@query("col_p15_patch_lines_below_hunk", f"""WITH f AS (SELECT chunk_id, {_LINES.format('patch')} AS l FROM code_chunks WHERE patch IS NOT NULL), g AS (SELECT chunk_id, l, list_position(list_transform(l, lambda x: starts_with(x, '@@')), true) AS p FROM f)
    SELECT chunk_id, CASE WHEN coalesce(p, 0) = 0 THEN 0 ELSE len(list_filter(l[p + 1:], lambda x: starts_with(x, '+'))) END AS n_added FROM g""")  # fmt: skip
def _(s, d):
    return table(s, d, "code_chunks").where("patch is not null").select("chunk_id", F.size(C.after_hunk(F.col("patch"), "+")).cast("bigint").alias("n_added"))


@query("col_p16_p17_truncation_suffix", """SELECT chunk_id, length(left(old_code, 4000)) AS old_n, length(left(new_code, 4000)) AS new_n, length(left(patch, 10000)) AS patch_n, regexp_extract(file_path, '[^/.][^/]*\\.([^./]+)$', 1) AS suffix FROM code_chunks""")
def _(s, d):
    cut = lambda c, n: F.length(F.substring(c, 1, n)).cast("bigint")
    return table(s, d, "code_chunks").select("chunk_id", cut("old_code", 4000).alias("old_n"), cut("new_code", 4000).alias("new_n"), cut("patch", 10000).alias("patch_n"), P.suffix(F.col("file_path")).alias("suffix"))


def _first(pattern: str, group: int = 1) -> str:
    return f"coalesce(regexp_extract(list_filter(string_split(new_code, chr(10)), lambda x: regexp_matches(x, '{pattern}'))[1], '{pattern}', {group}), '')"


@query("col_p18_names", f"SELECT chunk_id, {_first(C.FUNCTION_NAME)} AS fn_name, {_first(C.STRUCT_NAME)} AS struct_name, {_first(C.TRAIT_NAME)} AS trait_name FROM code_chunks WHERE new_code IS NOT NULL")
def _(s, d):
    n = F.col("new_code")
    return table(s, d, "code_chunks").where("new_code is not null").select("chunk_id", C.first_name(n, C.FUNCTION_NAME).alias("fn_name"), C.first_name(n, C.STRUCT_NAME).alias("struct_name"), C.first_name(n, C.TRAIT_NAME).alias("trait_name"))


@query("col_p19_use_lines", """SELECT chunk_id, array_to_string(list_transform(list_filter(string_split(new_code, chr(10)), lambda x: regexp_matches(x, '^\\s*use\\s+')), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), '|') AS uses FROM code_chunks WHERE new_code IS NOT NULL""")
def _(s, d):
    return table(s, d, "code_chunks").where("new_code is not null").select("chunk_id", F.array_join(C.use_lines(F.col("new_code")), "|").alias("uses"))


@query("col_p20_module_path", """WITH a AS (SELECT chunk_id, string_split(file_path, '/') AS p FROM code_chunks WHERE file_path IS NOT NULL), b AS (SELECT chunk_id, CASE WHEN list_contains(p, 'src') THEN p[list_position(p, 'src') + 1:] ELSE p END AS q FROM a)
    SELECT chunk_id, CASE WHEN len(q) = 0 THEN '' WHEN q[-1] IN ('lib.rs', 'mod.rs') THEN array_to_string(q[:len(q) - 1], '::') ELSE regexp_replace(array_to_string(q, '::'), '\\.rs$', '') END AS module FROM b""")  # fmt: skip
def _(s, d):
    return table(s, d, "code_chunks").where("file_path is not null").select("chunk_id", P.module_path(F.col("file_path")).alias("module"))


@query("col_p21_change_type", f"""WITH a AS (SELECT chunk_id, coalesce(new_code, '') AS code, string_split(coalesce(patch, ''), chr(10)) AS l FROM code_chunks),
    b AS (SELECT chunk_id, code, list_transform(list_filter(l, lambda x: starts_with(x, '+') AND NOT starts_with(x, '+++ ')), lambda x: substr(x, 2)) AS ad, len(list_filter(l, lambda x: starts_with(x, '-') AND NOT starts_with(x, '--- '))) AS nr, regexp_matches(code, '{C.TEST_CODE}') AS t FROM a),
    c AS (SELECT *, list_filter(list_transform(ad, lambda x: CASE WHEN regexp_matches(x, '{C.FUNCTION_NAME}') THEN 'new_function' WHEN regexp_matches(x, '{C.STRUCT_NAME}') THEN 'new_struct' WHEN t THEN 'new_test' END), lambda x: x IS NOT NULL)[1] AS k FROM b)
    SELECT chunk_id, CASE WHEN k IS NOT NULL THEN k WHEN t THEN 'modified_function' WHEN len(ad) > 0 AND nr > 0 THEN CASE WHEN abs(len(ad) - nr) < 5 THEN 'refactoring' ELSE 'modified_logic' END
    WHEN regexp_matches(lower(code), '{"|".join(C.FIX_WORDS)}') THEN 'bug_fix' WHEN regexp_matches(lower(code), '{"|".join(C.SPEED_WORDS)}') THEN 'optimization' ELSE 'unknown' END AS change_type FROM c""")  # fmt: skip
def _(s, d):
    n, p = F.coalesce("new_code", F.lit("")), F.coalesce("patch", F.lit(""))
    # the line arrays are columns of their own, so that each is made once a row
    lines = table(s, d, "code_chunks").select("chunk_id", n.alias("code"), C.added_lines(p).alias("added"), C.removed_lines(p).alias("removed"), n.rlike(C.TEST_CODE).alias("test"))
    return lines.select("chunk_id", C.change_type(F.col("code"), F.col("added"), F.col("removed"), F.col("test")).alias("change_type"))


@query("col_p22_config_change", """SELECT CASE WHEN file_type IN ('yaml', 'yml', 'toml', 'json') THEN 'configuration' ELSE change_type END AS kind, count(*) AS n FROM code_chunks GROUP BY ALL""")
def _(s, d):
    return table(s, d, "code_chunks").groupBy(C.config_change(F.col("file_type"), F.col("change_type")).alias("kind")).agg(F.count("*").alias("n"))


@query("col_p23_p24_functions_uses", """SELECT doc_id, len(regexp_extract_all(text, 'fn\\s+(\\w+)', 1)) AS n_functions, array_to_string(regexp_extract_all(text, 'use\\s+([\\w:]+)', 1), ' ') AS uses FROM documents WHERE text IS NOT NULL""")
def _(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"fn\s+(\w+)"), F.lit(1))).cast("bigint").alias("n_functions"), F.array_join(F.regexp_extract_all("text", F.lit(r"use\s+([\w:]+)"), F.lit(1)), " ").alias("uses"))


@query("col_p25_python_ast")
def _(s, d):
    docs = table(s, d, "documents").where("lang = 'python'").select("doc_id", C.python_ast(F.col("text")).alias("a"))
    return docs.select("doc_id", F.size("a.functions").alias("n_functions"), F.size("a.classes").alias("n_classes"), F.array_join("a.imports", " ").alias("imports"))


@query("col_p26_import_prefixes", """SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: contains(x, 'use ') AND contains(x, '::')), lambda x: split_part(trim(substr(x, instr(x, 'use ') + 4)), '::', 1)), ' ') AS prefixes FROM documents WHERE text IS NOT NULL""")
def _(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.array_join(C.import_prefixes(F.col("text")), " ").alias("prefixes"))


@query("col_p27_file_flags", """SELECT contains(lower(path), 'test') OR contains(lower(path), 'spec') AS is_test, contains(lower(path), 'test') AS is_test_short, regexp_extract(path, '[^/.][^/]*\\.([^./]+)$', 1) IN ('md', 'txt') AS is_doc,
    CASE WHEN contains(path, '/') THEN split_part(path, '/', 1) ELSE 'root' END IN ('src', 'crates') OR contains(lower(path), 'core') AS is_core, count(*) AS n FROM documents WHERE path IS NOT NULL GROUP BY ALL""")  # fmt: skip
def _(s, d):
    p = F.col("path")
    return table(s, d, "documents").where("path is not null").groupBy(P.marked(p, P.TEST_MARKS).alias("is_test"), P.marked(p, P.TEST_MARKS_SHORT).alias("is_test_short"), P.is_doc(p).alias("is_doc"), P.is_core(p).alias("is_core")).agg(F.count("*").alias("n"))


def _occ(words, cast="") -> str:
    return " + ".join(f"{w} * ((length(text) - length(replace(text, '{k}', ''))) // {len(k)})" for k, w in words)


@query("col_p28_p29_keyword_scores", f"""SELECT doc_id, least(len(string_split(text, chr(10))) + {_occ(C.SCAN_WEIGHTS)}, 2000) AS scan_score, least(len(string_split(text, chr(10))) + {_occ(C.OUTLINE_WEIGHTS)}, 1000) AS outline_score FROM documents WHERE text IS NOT NULL""")
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").where("text is not null").select("doc_id", C.weighted_score(t, C.SCAN_WEIGHTS, 2000).alias("scan_score"), C.weighted_score(t, C.OUTLINE_WEIGHTS, 1000).alias("outline_score"))


@query("col_p30_p31_complexity", f"""WITH a AS (SELECT doc_id, text, len(regexp_extract_all(text, '{C.OPERATOR}')) AS o, len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-zA-Z_][a-zA-Z0-9_]*'))) AS n FROM documents WHERE text IS NOT NULL)
    SELECT doc_id, least(1 + {_occ([(w, 1) for w in C.DECISIONS])}, 100) AS cyclomatic, least(floor((o + n) * log2(greatest(o, 1) + greatest(n, 1)))::BIGINT, 1000) AS halstead FROM a""")  # fmt: skip
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").where("text is not null").select("doc_id", C.cyclomatic(t).alias("cyclomatic"), C.halstead(t).alias("halstead"))


@query("col_p32_nesting", """WITH a AS (SELECT doc_id, regexp_replace(text, '[^\\[\\](){}]', '', 'g') AS b FROM documents WHERE text IS NOT NULL), c AS (SELECT doc_id, unnest(range(1, length(b) + 1)) AS i, b FROM a),
    e AS (SELECT doc_id, sum(CASE WHEN b[i] IN ('(', '[', '{') THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM c)
    SELECT a.doc_id, greatest(coalesce(max(depth), 0), 0)::INTEGER AS nesting FROM a LEFT JOIN e USING (doc_id) GROUP BY 1""")  # fmt: skip
def _(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", C.nesting(F.col("text")).alias("nesting"))


@query("col_p33_p34_composite_difficulty", f"""WITH a AS (SELECT doc_id, text, len(regexp_extract_all(text, '{C.OPERATOR}')) AS o, len(list_filter(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+'), lambda w: regexp_full_match(w, '[a-zA-Z_][a-zA-Z0-9_]*'))) AS n, regexp_replace(text, '[^\\[\\](){{}}]', '', 'g') AS b FROM documents WHERE text IS NOT NULL),
    c AS (SELECT doc_id, unnest(range(1, length(b) + 1)) AS i, b FROM a), e AS (SELECT doc_id, sum(CASE WHEN b[i] IN ('(', '[', '{{') THEN 1 ELSE -1 END) OVER (PARTITION BY doc_id ORDER BY i) AS depth FROM c), d AS (SELECT doc_id, greatest(max(depth), 0) AS depth FROM e GROUP BY 1),
    s AS (SELECT doc_id, floor(least(1 + {_occ([(w, 1) for w in C.DECISIONS])}, 100) * 3.0::DOUBLE + least(floor((o + n) * log2(greatest(o, 1) + greatest(n, 1)))::BIGINT, 1000) * 0.5::DOUBLE + coalesce(depth, 0) * 5.0::DOUBLE + len(string_split(text, chr(10))) * 0.1::DOUBLE)::BIGINT AS score FROM a LEFT JOIN d USING (doc_id))
    SELECT doc_id, score, CASE WHEN score < 50 THEN 'easy' WHEN score < 200 THEN 'medium' ELSE 'hard' END AS difficulty FROM s""")  # fmt: skip
def _(s, d):
    docs = table(s, d, "documents").where("text is not null").select("doc_id", C.composite(F.col("text")).alias("score"))
    return docs.withColumn("difficulty", F.when(F.col("score") < 50, "easy").when(F.col("score") < 200, "medium").otherwise("hard"))


@query("col_p35_p37_difficulty", """SELECT example_id, CASE WHEN difficulty < 0.3 THEN 'easy' WHEN difficulty < 0.5 THEN 'medium' WHEN difficulty < 0.7 THEN 'hard' ELSE 'expert' END AS bucket, round(least(0.95::DOUBLE, len(context) / 10000.0::DOUBLE), 6) AS length_difficulty FROM examples WHERE context IS NOT NULL""")
def _(s, d):
    q = F.col("difficulty")
    bucket = F.when(q < 0.3, "easy").when(q < 0.5, "medium").when(q < 0.7, "hard").otherwise("expert")
    return table(s, d, "examples").where("context is not null").select("example_id", bucket.alias("bucket"), F.round(F.least(F.lit(0.95), F.size("context") / F.lit(10000.0)), 6).alias("length_difficulty"))


@query("col_p36_line_count_curriculum", """SELECT CASE WHEN l < 1000 THEN 'easy' WHEN l < 2000 THEN 'medium' WHEN l < 5000 THEN 'hard' ELSE 'expert' END AS stage, count(*) AS n, sum(l)::BIGINT AS lines FROM (SELECT len(string_split(text, chr(10))) AS l FROM documents WHERE text IS NOT NULL) GROUP BY 1""")
def _(s, d):
    docs = table(s, d, "documents").where("text is not null").select(F.size(C.lines_of(F.col("text"))).alias("l"))
    stage = F.when(F.col("l") < 1000, "easy").when(F.col("l") < 2000, "medium").when(F.col("l") < 5000, "hard").otherwise("expert")
    return docs.groupBy(stage.alias("stage")).agg(F.count("*").alias("n"), F.sum("l").alias("lines"))


#: Names and inclusive bounds of sequence scales (fixed values).
SCALES = (("MICRO", 100, 256), ("SMALL", 257, 512), ("MEDIUM", 513, 1024), ("LARGE", 1025, 2048), ("XLARGE", 2049, 4096), ("HUGE", 4097, 8192))


def scale_of(n):
    out = None
    for name, lo, hi in SCALES:
        cond = n.between(lo, hi)
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise("FULL")


@query("col_p38_scale", "SELECT CASE " + " ".join(f"WHEN n BETWEEN {lo} AND {hi} THEN '{name}'" for name, lo, hi in SCALES) + " ELSE 'FULL' END AS scale, count(*) AS n_rows FROM (SELECT len(context) AS n FROM examples WHERE context IS NOT NULL) GROUP BY 1")
def _(s, d):
    return table(s, d, "examples").where("context is not null").groupBy(scale_of(F.size("context")).alias("scale")).agg(F.count("*").alias("n_rows"))


@query("col_p39_p40_densities", """SELECT example_id, round(len(context) / greatest(len(list_filter(context, lambda x: x = 5)), 1)::DOUBLE, 6) AS per_line FROM examples WHERE context IS NOT NULL""")
def _(s, d):
    return table(s, d, "examples").where("context is not null").select("example_id", F.round(T.tokens_per_line(F.col("context")), 6).alias("per_line"))


@query("col_p40_p42_density_hash", """SELECT doc_id, round((length(text) - length(replace(text, ':', ''))) / greatest(length(text), 1)::DOUBLE * 1000, 6) AS type_density,
    (length(text) - length(replace(text, 'Result<', ''))) // 7 + (length(text) - length(replace(text, 'Option<', ''))) // 7 + (length(text) - length(replace(text, '?', ''))) AS error_patterns, left(md5(text), 16) AS short_hash, md5(text) AS full_hash FROM documents WHERE text IS NOT NULL""")  # fmt: skip
def _(s, d):
    t = F.col("text")
    return table(s, d, "documents").where("text is not null").select("doc_id", F.round(C.type_density(t), 6).alias("type_density"), C.error_marks(t).alias("error_patterns"), F.substring(F.md5(t.cast("binary")), 1, 16).alias("short_hash"), F.md5(t.cast("binary")).alias("full_hash"))


@query("col_p41_priority", """SELECT CASE WHEN contains(lower(path), 'core') OR split_part(path, '/', 1) IN ('src', 'crates') THEN 'high' WHEN contains(lower(path), 'test') OR contains(lower(path), 'spec') THEN 'low' ELSE 'medium' END AS priority, count(*) AS n FROM documents WHERE path IS NOT NULL GROUP BY 1""")
def _(s, d):
    p = F.col("path")
    pr = F.when(P.is_core(p), "high").when(P.marked(p, P.TEST_MARKS), "low").otherwise("medium")
    return table(s, d, "documents").where("path is not null").groupBy(pr.alias("priority")).agg(F.count("*").alias("n"))


@query("col_p43_entropy", """WITH t AS (SELECT pack_id, unnest(tokens) AS t, len(tokens) AS n FROM packed_sequences WHERE len(tokens) >= 2), c AS (SELECT pack_id, t, n, count(*) AS c FROM t GROUP BY 1, 2, 3), e AS (SELECT pack_id, -sum(c / n::DOUBLE * log2(c / n::DOUBLE)) AS h FROM c GROUP BY 1)
    SELECT p.pack_id, CASE WHEN len(p.tokens) < 2 THEN 0.0::DOUBLE ELSE round(greatest(least(1.0::DOUBLE, h / 8), 0), 5) END AS entropy FROM packed_sequences p LEFT JOIN e USING (pack_id) WHERE p.tokens IS NOT NULL""")  # fmt: skip
def _(s, d):
    return table(s, d, "packed_sequences").where("tokens is not null").select("pack_id", F.round(T.entropy8(F.col("tokens")), 5).alias("entropy"))


@query("col_p44_breakpoints", """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM l),
    s AS (SELECT doc_id, line, sum(len(list_filter(string_split(line, ' '), lambda x: x <> ''))) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS upto, sum(len(list_filter(string_split(line, ' '), lambda x: x <> ''))) OVER (PARTITION BY doc_id)::BIGINT AS total FROM p)
    SELECT doc_id, count(DISTINCT upto) AS n_points, min(upto) AS first_point FROM s WHERE total - upto > 100 AND regexp_matches(line, 'fn |def |class |impl |struct ') GROUP BY 1""")  # fmt: skip
def _(s, d):
    from tessera.operators.windows import breakpoints

    return breakpoints(table(s, d, "documents"), "doc_id", "text", r"fn |def |class |impl |struct ", 100).groupBy("doc_id").agg(F.count_distinct("point").alias("n_points"), F.min("point").alias("first_point"))


@query("col_p45_p46_age_month", """SELECT hash, scraped_at, CASE WHEN a < 30 THEN 'recent' WHEN a < 90 THEN 'quarter' ELSE 'stable' END AS age, strftime(to_timestamp(commit_timestamp) AT TIME ZONE 'UTC', '%Y-%m') AS month FROM (SELECT *, (1767225600 - commit_timestamp) / 86400.0 AS a FROM commits WHERE commit_timestamp IS NOT NULL)""")
def _(s, d):
    age = (F.lit(1767225600) - F.col("commit_timestamp")) / 86400.0
    t = F.to_utc_timestamp(F.timestamp_seconds("commit_timestamp"), F.current_timezone())
    return table(s, d, "commits").where("commit_timestamp is not null").select("hash", "scraped_at", F.when(age < 30, "recent").when(age < 90, "quarter").otherwise("stable").alias("age"), F.date_format(t, "yyyy-MM").alias("month"))


@query("col_p47_clamp", "SELECT example_id, list_sum(list_transform(context, lambda x: greatest(0, least(x, 999))))::BIGINT AS total FROM examples WHERE len(context) > 0")
def _(s, d):
    return table(s, d, "examples").where("size(context) > 0").select("example_id", F.aggregate(T.clamp(F.col("context"), 1000), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("col_p48_id_coalesce", """SELECT coalesce(nullif(e.commit_hash, ''), nullif(e.chunk_id, ''), e.example_id::VARCHAR) AS id, e.example_id FROM examples e""")
def _(s, d):
    return table(s, d, "examples").select(F.coalesce(F.nullif("commit_hash", F.lit("")), F.nullif("chunk_id", F.lit("")), F.col("example_id").cast("string")).alias("id"), "example_id")


@query("col_p49_payload", """SELECT hash AS id, 'commit' AS type, author_name AS author, commit_timestamp AS ts, subject, round(complexity_score, 6) AS complexity, files_changed FROM commits""")
def _(s, d):
    from tessera.operators.embedding import commit_payload

    return table(s, d, "commits").select(F.col("hash").alias("id"), commit_payload().alias("p")).select("id", F.col("p.type").alias("type"), F.col("p.author").alias("author"), F.col("p.timestamp").alias("ts"), F.col("p.subject").alias("subject"), F.round("p.complexity", 6).alias("complexity"), F.col("p.files_changed").alias("files_changed"))


@query("col_p57_trim_text", "SELECT doc_id, left(replace(regexp_replace(text, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g'), chr(10), ' '), 120) AS head FROM documents WHERE text IS NOT NULL")
def _(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.substring(F.translate(M.strip(F.col("text")), "\n", " "), 1, 120).alias("head"))


@query("col_p58_label_mask", """SELECT example_id, list_sum(list_transform(list_zip(context, context_mask), lambda z: CASE WHEN z[2] = 0 THEN -100 ELSE z[1] END))::BIGINT AS total FROM examples WHERE len(context) = len(context_mask) AND len(context) > 0""")
def _(s, d):
    e = table(s, d, "examples").where("size(context) = size(context_mask) and size(context) > 0")
    return e.select("example_id", F.aggregate(T.mask_labels(F.col("context"), F.col("context_mask")), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("col_p59_span_labels", """WITH a AS (SELECT example_id, context AS c, len(context) AS n, greatest(floor(len(context) * 0.5)::INT, 1) AS k FROM examples WHERE len(context) > 0), b AS (SELECT *, floor((n - k) / 2)::INT AS lo FROM a)
    SELECT example_id, (list_sum(c[lo + 1:lo + k]) - 100 * (n - k))::BIGINT AS total FROM b""")  # fmt: skip
def _(s, d):
    return table(s, d, "examples").where("size(context) > 0").select("example_id", F.aggregate(T.span_labels(F.col("context"), 0.5), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"))


@query("col_p60_fill_in_middle", """WITH a AS (SELECT example_id, target AS t, len(target) AS n, len(target) // 4 AS q, len(target) * 3 // 4 AS s FROM examples WHERE target IS NOT NULL)
    SELECT example_id, CASE WHEN n < 8 THEN array_to_string(t, ' ') ELSE array_to_string(list_concat([90001], t[:q], [90003], t[s + 1:], [90002], t[q + 1:s]), ' ') END AS fim FROM a""")  # fmt: skip
def _(s, d):
    return table(s, d, "examples").where("target is not null").select("example_id", F.array_join(T.fill_in_middle(F.col("target"), 90001, 90002, 90003), " ").alias("fim"))


@query("col_p61_next_token", "SELECT example_id, list_sum(target[:len(target) - 1])::BIGINT AS inputs, list_sum(target[2:])::BIGINT AS labels FROM examples WHERE len(target) > 1")
def _(s, d):
    total = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    t = table(s, d, "examples").where("size(target) > 1")
    return t.select("example_id", total(F.slice("target", 1, F.size("target") - 1)).alias("inputs"), total(F.slice("target", 2, F.size("target"))).alias("labels"))


@query("flt_f1_f2_files", """SELECT doc_id, length(text) AS n FROM documents WHERE length(text) >= 100 AND regexp_extract(path, '[^/.][^/]*\\.([^./]+)$', 1) IN ('rs', 'py', 'ts', 'md') AND NOT regexp_matches(path, '(^|/)(node_modules|target|\\.git)(/|$)') AND octet_length(encode(text)) <= 100000""")
def _(s, d):
    p = F.col("path")
    docs = table(s, d, "documents").where((F.length("text") >= 100) & P.suffix(p).isin("rs", "py", "ts", "md") & ~p.rlike(r"(^|/)(node_modules|target|\.git)(/|$)") & (F.octet_length("text") <= 100000))
    return docs.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query("flt_f3_f6_lengths", """SELECT example_id FROM examples WHERE len(context) >= 128 AND len(target) >= 10 AND len(context) > 128 AND len(target) > 16""")
def _(s, d):
    # windows of 256 and 32: context and target more than half full
    return table(s, d, "examples").where("size(context) >= 128 and size(target) >= 10 and size(context) > 256 / 2 and size(target) > 32 / 2").select("example_id")


@query("flt_f7_binary", "SELECT coalesce(is_binary, false) AS is_binary, count(*) AS n FROM file_diffs WHERE NOT coalesce(is_binary, false) GROUP BY 1")
def _(s, d):
    return table(s, d, "file_diffs").where(~F.coalesce("is_binary", F.lit(False))).groupBy(F.coalesce("is_binary", F.lit(False)).alias("is_binary")).agg(F.count("*").alias("n"))


@query("flt_f8_quality_fallback", "SELECT pack_id, quality_score FROM packed_sequences WHERE quality_score >= 0.8 OR NOT EXISTS (SELECT 1 FROM packed_sequences WHERE quality_score >= 0.8)")
def _(s, d):
    from tessera.operators.stats import quality_or_all

    return quality_or_all(table(s, d, "packed_sequences"), "quality_score", 0.8).select("pack_id", "quality_score")


@query("flt_f8_quality_fallback_all", "SELECT pack_id, quality_score FROM packed_sequences")
def _(s, d):
    from tessera.operators.stats import quality_or_all

    return quality_or_all(table(s, d, "packed_sequences"), "quality_score", 2.0).select("pack_id", "quality_score")


@query("flt_f10_large_files", "SELECT doc_id, len(string_split(text, chr(10))) AS lines FROM documents WHERE len(string_split(text, chr(10))) > 100")
def _(s, d):
    return table(s, d, "documents").select("doc_id", F.size(C.lines_of(F.col("text"))).cast("bigint").alias("lines")).where("lines > 100")


@query("flt_f11_ignore_globs", "SELECT doc_id FROM documents WHERE path IS NOT NULL AND NOT regexp_matches(path, '^.*/docs/.*$') AND NOT regexp_matches(path, '^[^/]*/[^/]*/Cargo\\.toml$') AND NOT regexp_matches(path, '^.*\\.json$')")
def _(s, d):
    return table(s, d, "documents").where("path is not null").where(~P.ignored(F.col("path"), ["**/docs/**", "*/*/Cargo.toml", "**.json"])).select("doc_id")


@query("flt_f12_non_empty", "SELECT hash, scraped_at, array_to_string(list_filter([coalesce(subject, ''), coalesce(body, ''), coalesce(author_name, '')], lambda x: x <> ''), '|') AS parts FROM commits")
def _(s, d):
    parts = F.filter(F.array(*(F.coalesce(c, F.lit("")) for c in ("subject", "body", "author_name"))), lambda x: x != "")
    return table(s, d, "commits").select("hash", "scraped_at", F.array_join(parts, "|").alias("parts"))


@query("flt_f13_output_checks", "SELECT doc_id, text <> '' AS has_text, starts_with(text, '# ') AS starts_right, length(text) > 10 AND length(text) < 500 AS sensible FROM documents WHERE text IS NOT NULL")
def _(s, d):
    n = F.length("text")
    return table(s, d, "documents").where("text is not null").select("doc_id", (F.col("text") != "").alias("has_text"), F.startswith("text", F.lit("# ")).alias("starts_right"), ((n > 10) & (n < 500)).alias("sensible"))


_H = "('0x' || substr(md5('42:' || coalesce({}::VARCHAR, '')), 1, 8))::BIGINT"


@query("flt_f14_hash_gate", f"SELECT doc_id FROM documents WHERE {_H.format('doc_id')} % 10000 < 7000")
def _(s, d):
    return table(s, d, "documents").where(gate(0.7, 42, "doc_id")).select("doc_id")


@query("txt_g13_code_tokens", "SELECT chunk_id, array_to_string(regexp_extract_all(new_code, '[a-zA-Z_][a-zA-Z0-9_]*|[0-9]+|[+\\-*/%=<>!&|^~?:|;,.(\\[\\]{}]'), ' ') AS toks FROM code_chunks WHERE new_code IS NOT NULL")
def _(s, d):
    return table(s, d, "code_chunks").where("new_code is not null").select("chunk_id", F.array_join(T.code_tokens(F.col("new_code")), " ").alias("toks"))


@query("txt_g14_text_tokens", """SELECT hash, scraped_at, array_to_string(flatten(list_transform(list_filter(regexp_split_to_array(subject, '\\s+'), lambda x: x <> ''), lambda w: CASE WHEN right(w, 1) IN ('.', ',') THEN [left(w, length(w) - 1), right(w, 1)] ELSE [w] END)), '_') AS toks FROM commits WHERE subject IS NOT NULL""")
def _(s, d):
    return table(s, d, "commits").where("subject is not null").select("hash", "scraped_at", F.array_join(T.text_tokens(F.col("subject")), "_").alias("toks"))
