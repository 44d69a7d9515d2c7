"""Operators against plain restatements on small inputs, and their defined results on odd ones."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import code as C
from tessera.functions import messages as M
from tessera.functions import paths as P
from tessera.functions import tokens as T
from tessera.functions.edit import edit_distance, within
from tessera.operators import dedup, history, joins, linalg, packs, sampling, signals, stats, vocabulary, windows
from tessera.operators.components import components
from tessera.plans import formulas
from tessera.sources import readers, sinks


def one(spark, column, **values):
    cols = [F.lit(v).alias(k) if not isinstance(v, list) else F.array(*map(F.lit, v)).alias(k) for k, v in values.items()]
    return spark.range(1).select(*cols).select(column.alias("r")).first()["r"]


# ---- text and code ----


def test_code_tokens(spark):
    assert one(spark, T.code_tokens(F.col("t")), t="fn a_1(x)") == ["fn", "a_1", "(", "x"]


def test_text_tokens(spark):
    assert one(spark, T.text_tokens(F.col("t")), t="Add RPC, done. .") == ["Add", "RPC", ",", "done", ".", "", "."]


def test_commit_complexity(spark):
    f = lambda merge: one(spark, M.complexity(F.lit(150), F.lit(1), F.lit(merge)))
    assert math.isclose(f(False), 0.188) and math.isclose(f(True), 0.282)


def test_function_name(spark):
    assert one(spark, C.first_name(F.col("t"), C.FUNCTION_NAME), t="// note\npub async fn propose_dispute(a: u8)") == "propose_dispute"
    assert one(spark, F.size(C.use_lines(F.col("t"))), t="use crate::types::*;\nuse serde::Serialize;") == 2


@pytest.mark.parametrize(
    "code,added,removed,want",
    [
        ("x", ["fn test_a() {"], [], "new_function"), ("fn test_a", ["let x = 1;"], [], "new_test"), ("x", ["struct A {"], [], "new_struct"), ("fn test_a", [], ["y"], "modified_function"), ("x", ["a"], ["b"], "refactoring"),
        ("x", ["a"] * 9, ["b"], "modified_logic"), ("a bug here", ["a"], [], "bug_fix"), ("a lazy one", [], ["a"], "optimization"), ("x", [], [], "unknown"),
    ],
)
def test_change_type(spark, code, added, removed, want):
    arr = lambda v: F.array(*map(F.lit, v)).cast("array<string>")
    assert one(spark, C.change_type(F.col("c"), arr(added), arr(removed)), c=code) == want


def test_nesting_and_scores(spark):
    assert one(spark, C.nesting(F.col("t")), t="))((a[b]{c}))") == 1
    assert one(spark, C.nesting(F.col("t")), t="") == 0
    assert one(spark, C.cyclomatic(F.col("t")), t="if a elif b else c") == 5


def test_fill_in_middle(spark):
    assert one(spark, T.fill_in_middle(F.col("t"), -1, -2, -3), t=list(range(8))) == [-1, 0, 1, -3, 6, 7, -2, 2, 3, 4, 5]
    assert one(spark, T.fill_in_middle(F.col("t"), -1, -2, -3), t=[1, 2, 3]) == [1, 2, 3]


def test_entropy(spark):
    rng = random.Random(3)
    t = [rng.randrange(9) for _ in range(200)]
    h = -sum(c / 200 * math.log2(c / 200) for c in Counter(t).values())
    assert math.isclose(one(spark, T.entropy8(F.col("t")), t=t), h / 8)
    assert one(spark, T.entropy8(F.col("t")), t=[4]) == 0.0


def test_paths(spark):
    assert one(spark, P.module_path(F.col("p")), p="crates/a/src/store/mod.rs") == "store"
    assert one(spark, P.crate_of(F.col("p")), p="crates/a/x.rs") == "a" and one(spark, P.crate_of(F.col("p")), p="x.rs") == "root"
    assert one(spark, P.suffix(F.col("p")), p=".gitignore") == ""


def test_split_lines(spark):
    for text in ("", "a", "a\n", "a\n\n", "a\r\nb\x0bc d\n"):
        assert one(spark, C.split_lines(F.col("t")), t=text) == text.splitlines()


def test_edit_distance():
    rng = random.Random(1)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(0, 12))] for _ in range(2))
        assert edit_distance(a, b) == plain(a, b)
    assert within([1, 2, 3], [1, 3], 1) and not within([1], [2, 3, 4], 1)


# ---- graphs ----


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 60)] + [(None, 3), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent}
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# ---- windows ----


def restated_stream(rows, length, overlap, pad):
    buf, out = [], []
    for t in rows:
        buf += t
        while len(buf) >= length:
            out.append(buf[:length])
            buf = buf[length - overlap :]
    if buf:
        out.append(buf + [pad] * (length - len(buf)))
    return out


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    monkeypatch.setattr(joins, "HOT_KEYS", 20)
    rng = random.Random(3)
    edges = [(0, i) for i in range(1, 90)] + [(i, 500) for i in range(40, 60)] + [(rng.randrange(600, 700), rng.randrange(600, 700)) for _ in range(60)] + [(None, 3), (7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_of_hot_keys(spark, monkeypatch, how):
    rows = spark.createDataFrame([(k, i) for i, k in enumerate([1] * 50 + [2] * 30 + [3, 4, None, 5])], "k bigint, i bigint")
    table = spark.createDataFrame([(1, "a"), (3, "c"), (5, "e"), (9, "x")], "k bigint, v string")
    want = Counter(tuple(r) for r in joins.lookup(rows, table, "k", 84, how).collect())
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    assert Counter(tuple(r) for r in joins.lookup(rows, table, "k", 84, how).collect()) == want and len(want) == (84 if how == "left" else 52)


def test_reachable_gives_up_aloud(spark):
    chain = spark.createDataFrame([(str(i), [str(i + 1)]) for i in range(300)], "hash string, parents array<string>")
    tips = chain.where("hash = '0'").select("hash")
    assert history.reachable(chain, tips).count() == 301
    with pytest.raises(RuntimeError):
        history.reachable(chain, tips, 1, 2)


def test_reachable_crosses_long_paths_in_few_rounds(spark):
    chain = spark.range(5000).select(F.col("id").cast("string").alias("hash"), F.array((F.col("id") + 1).cast("string")).alias("parents"))
    assert history.reachable(chain, chain.where("hash in ('0', '4000')").select("hash"), max_rounds=3).groupBy("tip").count().orderBy("tip").collect() == [("0", 5001), ("4000", 1001)]


@pytest.mark.parametrize("ordered", [True, False])
def test_reachable_over_blocks(spark, ordered):
    rng = random.Random(5)
    rows = [(str(i), [str(rng.randrange(i + 1, min(i + 6, 130))) for _ in range(rng.choice((0, 1, 1, 1, 2, 3)))], 1000 - i if ordered else rng.choice((None, 1, 2))) for i in range(120)]
    # seen twice with other parents, a null among parents on several paths, a cycle, no parents, no hash
    rows += [("0", ["3", "40"], 7), ("3", [None, "5"], 990), ("40", ["41", None], 960), ("41", ["40"], 959), ("119", None, 1), (None, ["7"], 3)]
    parents = {}
    for h, p, _ in rows:
        parents.setdefault(h, set()).update(p or [])
    parents[None] = set()
    want = Counter()
    for tip in ("0", "60", "unknown", None):
        seen, todo = {tip}, [tip]
        while todo:
            new = parents.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        want.update((tip, h) for h in seen)
    commits = spark.createDataFrame(rows, "hash string, parents array<string>, commit_timestamp bigint")
    tips = spark.createDataFrame([("0",), ("60",), ("unknown",), (None,), ("0",)], "hash string")
    for block in (100, 1 << 20):
        assert Counter(tuple(r) for r in history.reachable(commits, tips, block).collect()) == want
    assert history.reachable(commits, tips.limit(0)).count() == 0
    assert history.reachable(commits.limit(0), tips).count() == 4


@pytest.mark.parametrize("length,overlap", [(4, 1), (7, 3), (5, 0), (100, 10)])
def test_stream_windows(spark, length, overlap):
    rng = random.Random(length)
    rows = [[rng.randrange(1, 99) for _ in range(rng.randrange(0, 9))] for _ in range(25)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(99, None)], "i int, t array<int>").repartition(3)
    got = [r["window"] for r in windows.stream_windows(df, "t", ["i"], length, overlap, pad=0).orderBy("window_no").collect()]
    assert got == restated_stream(rows, length, overlap, 0)


def test_stream_rejects_full_overlap(spark):
    with pytest.raises(ValueError):
        windows.stream_windows(spark.createDataFrame([(1, [1])], "i int, t array<int>"), "t", ["i"], 4, 4)


def test_line_windows(spark):
    got = one(spark, windows.line_windows(F.array_repeat(F.lit("x"), 500), 200, 40))
    assert [(r["start_line"], r["end_line"]) for r in got] == [(1, 200), (161, 360), (321, 500)]
    assert one(spark, windows.line_windows(F.array().cast("array<string>"), 200, 40)) == []


def test_grouped_examples(spark):
    df = spark.createDataFrame([("c1", 0, list(range(100, 200))), ("c1", 1, list(range(200, 300))), ("c2", 0, list(range(300, 400))), (None, 0, [1])], "h string, pos int, t array<int>")
    (r,) = windows.grouped_examples(df, "h", ["pos"], "t", 100, 50).collect()
    assert (r["h"], r["num_chunks"], r["context"], r["target"]) == ("c1", 2, list(range(100, 200)), list(range(200, 250)))


def test_next_fit(spark):
    df = spark.createDataFrame([(i, [i + 1] * n) for i, n in enumerate((3, 3, 5, 9))] + [(9, []), (10, None)], "i int, t array<int>")
    got = [r["tokens"] for r in packs.next_fit(df, "t", ["i"], F.lit(0), 8, pad=0, eos=7).orderBy("pack_no").collect()]
    assert got == [[1, 1, 1, 7, 2, 2, 2, 0], [3] * 5 + [0] * 3, [4] * 8]


def test_windows_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i, list(range(i, i + 7))) for i in range(40)], "i int, t array<int>")
    a, b = (windows.stream_windows(df.repartition(n), "t", ["i"], 16, 4, pad=0).orderBy("window_no").collect() for n in (1, 7))
    assert a == b


# ---- vocabulary, dedup, statistics ----


def test_vocabulary_order_and_encode(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["a", "c"]), (3, [])], "k int, t array<string>")
    v = vocabulary.vocabulary(vocabulary.frequencies(df, "k", F.col("t")), vocabulary.FIRST_LEARNED + 2)
    assert vocabulary.FIRST_LEARNED == 5085
    assert [(r["token"], r["id"]) for r in v.orderBy("id").collect()] == [("b", 5085), ("a", 5086)]
    assert {r["k"]: r["ids"] for r in vocabulary.encode(df, "k", F.col("t"), v).collect()} == {1: [5085, 5086, 5085], 2: [5086, 1], 3: []}


def test_upper_median(spark):
    assert one(spark, stats.median_of(F.col("v")), v=[4, 1, 3, 2]) == 3
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 4, 4, None)], "n int")
    assert stats.picked(df, "n", {"m": 0.5, "p": 0.95}).first().asDict() == {"m": 4, "p": 4}


def test_keep_first(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None)], "i int, k string")
    assert sorted(r["i"] for r in dedup.keep_first(df, F.col("k"), ["i"]).collect()) == [1, 2]


def test_short_texts_share_a_signature(spark):
    df = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "i int, t string")
    assert len({r["signature"] for r in dedup.ngram_signatures(df, "i", "t").collect()}) == 1


# ---- sampling ----


def test_splits(spark):
    r = sampling.shuffled(spark.range(101), ["id"])
    got = Counter(x["split"] for x in sampling.split_by_rank(r, (("train", 0.85), ("val", 0.1), ("test", 0.05))).collect())
    assert got == {"train": 85, "val": 10, "test": 6}
    got = Counter(x["split"] for x in sampling.temporal_split(spark.range(11), ["id"]).collect())
    assert got == {"train": 7, "val": 1, "test": 3}


def test_replicate(spark):
    df = spark.createDataFrame([(1, 5.85), (2, 0.3)], "i int, w double")
    got = sampling.replicate(df, F.col("w"), ["i"]).collect()
    assert Counter(r["i"] for r in got) == {1: 5, 2: 1} and sorted(r["seq_id"] for r in got) == list(range(6))


def test_upsample_and_weights(spark):
    assert sampling.upsample(spark.range(10), ["id"], 25).count() == 25
    assert sampling.upsample(spark.range(0), ["id"], 25).count() == 0
    df = spark.createDataFrame([(1, 9.0), (2, 1.0), (3, 0.0)], "i int, w double")
    got = Counter(r["i"] for r in sampling.weighted_sample(df, ["i"], F.col("w"), 4000).collect())
    assert sum(got.values()) == 4000 and 3 not in got and 0.86 < got[1] / 4000 < 0.94


def test_leak_free(spark):
    df = spark.createDataFrame([(i, f"k{i % 9}") for i in range(200)], "i int, k string")
    got = sampling.leak_free_split(df, ["k"], (("train", 0.8), ("test", 0.2))).groupBy("k").agg(F.count_distinct("split").alias("n"))
    assert all(r["n"] == 1 for r in got.collect())


# ---- signals ----


def test_early_stop_and_ema(spark):
    r = one(spark, signals.early_stop(F.col("v"), 0.1, 2), v=[1.0, 0.95, 0.8, 0.79, 0.78, 0.1])
    assert (r["best"], r["stopped_at"]) == (0.8, 4)
    assert math.isclose(one(spark, signals.ema(F.col("v"), 0.5), v=[1.0, 3.0, 5.0]), 3.5)


def test_incremental(spark):
    df = spark.createDataFrame([(i, i, f"h{i}") for i in range(10)], "p bigint, c bigint, h string")
    assert [r["p"] for r in signals.incremental_slice(df, "p", "c", "h", 6, "h6", 6, 3).orderBy("p").collect()] == [4, 5, 6, 7, 8, 9]
    assert signals.incremental_slice(df, "p", "c", "h", 9, "h9", 9, 3).count() == 0


# ---- linear algebra ----


def test_linalg(spark):
    assert one(spark, linalg.div(F.col("a"), F.col("b"), True), a=[1.0, 4.0], b=[0.0, 2.0]) == [0.0, 2.0]
    with pytest.raises(Exception, match="division by zero"):
        one(spark, linalg.div(F.col("a"), F.col("b")), a=[1.0], b=[0.0])
    assert one(spark, linalg.add(F.col("a"), F.col("b")), a=[1.0, 2.0], b=[1.0, 2.0, 3.0]) == []
    q = one(spark, linalg.quantise(F.col("a"), 2), a=[1.0, -0.5, 0.0])
    assert [r["codes"] for r in q] == [[127, -64], [0]]
    back = one(spark, linalg.dequantise(linalg.quantise(F.col("a"), 2)), a=[1.0, -0.5, 0.25])
    assert all(abs(x - y) < 0.01 for x, y in zip(back, [1.0, -0.5, 0.25]))
    m = spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "i int, j int, value double")
    assert {(r["i"], r["j"]): r["value"] for r in linalg.matmul(m, m).collect()} == {(0, 0): 7.0, (0, 1): 10.0, (1, 0): 15.0, (1, 1): 22.0}


# ---- sources and plans ----


def test_readers(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"token_sequences": [[1, 2], [3]]}\n\n{"tokens": [4]}\n[5, 6]\nnot json\n')
    assert sorted(r["tokens"] for r in readers.read_sequences(spark, str(tmp_path / "s.jsonl")).collect()) == [[1, 2], [3], [4], [5, 6]]
    (tmp_path / "b.json").write_text('{"token_sequences": [[1], [2]],\n "metadata": {"0": {"source": "x"}}}')
    assert [(r["pos"], r["metadata"] and r["metadata"]["source"]) for r in readers.read_bundle(spark, str(tmp_path / "b.json")).orderBy("pos").collect()] == [(0, "x"), (1, None)]
    blocks = one(spark, readers.parse_log_blocks(F.col("t")), t="h1\na\n1\nsub\nbody\n---COMMIT_END---\nh2\na\n---COMMIT_END---")
    assert [(b["hash"], b["subject"], b["body"]) for b in blocks] == [("h1", "sub", "body")]


def test_tree(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a.rs").write_text("fn a() {}\n")
    (tmp_path / "src/b.rs").write_bytes(b"caf\xe9\n")
    (tmp_path / "src/c.rs").write_bytes(b"x\x00y")
    (tmp_path / "target").mkdir()
    (tmp_path / "target/d.rs").write_text("fn d() {}")
    got = {r["path"]: r["text"] for r in readers.read_tree(spark, str(tmp_path), ("rs",)).collect()}
    assert got == {"src/a.rs": "fn a() {}\n", "src/b.rs": "café\n"}


def test_git(spark, tmp_path):
    import subprocess

    from tessera.sources.git import GitCommits, GitDiffs

    env = {"GIT_AUTHOR_NAME": "A", "GIT_AUTHOR_EMAIL": "a@x", "GIT_COMMITTER_NAME": "A", "GIT_COMMITTER_EMAIL": "a@x", "PATH": "/usr/bin:/bin", "HOME": str(tmp_path)}
    run = lambda *a: subprocess.run(["git", *a], cwd=tmp_path, env=env, check=True, capture_output=True)
    run("init", "-q")
    for i in range(3):
        (tmp_path / f"f{i}.txt").write_text("x\n" * (i + 1))
        run("add", ".")
        run("commit", "-qm", f"subject {i}\n\nbody")
    spark.dataSource.register(GitCommits)
    spark.dataSource.register(GitDiffs)
    c = spark.read.format("git_commits").option("repository", str(tmp_path)).option("slices", "2").load()
    assert sorted(r["subject"] for r in c.collect()) == ["subject 0", "subject 1", "subject 2"]
    d = spark.read.format("git_diffs").option("repository", str(tmp_path)).load()
    assert {(r["filename"], r["change_type"], r["additions"]) for r in d.collect()} == {("f0.txt", "A", 1), ("f1.txt", "A", 2), ("f2.txt", "A", 3)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, t string")
    assert sinks.write_jsonl(df, str(tmp_path / "o")) > 0
    sinks.write_if_missing(df, str(tmp_path / "p"))
    sinks.write_if_missing(df.limit(0), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_tree_and_documents_as_written(spark, tmp_path):
    df = spark.createDataFrame([("a/b/x.py", bytearray("é1".encode("latin-1"))), ("a/y.py", bytearray("漢字".encode())), ("node_modules/z.py", bytearray(b"no")), (".h/z.py", bytearray(b"no")), ("bin.py", bytearray(b"\0no")), ("z.rs", bytearray(b"no"))], "path string, content binary")
    sinks.write_tree(df, str(tmp_path / "t"))
    assert {(r["path"], r["text"]) for r in readers.read_tree(spark, str(tmp_path / "t"), ("py",)).collect()} == {("a/b/x.py", "é1"), ("a/y.py", "漢字")}
    with pytest.raises(ValueError):
        sinks.write_document(spark.range(sinks.SMALL_ROWS + 1), str(tmp_path / "d"))


def test_encode_with_a_large_vocabulary(spark):
    df = spark.createDataFrame([(1, ["a", "b", "z"]), (1, ["b"]), (2, []), (3, None)], "k int, t array<string>")
    vocab = spark.createDataFrame([("a", 7), ("b", 8)], "token string, id int")
    for most in (10, 1):
        got = sorted((r["k"], r["ids"]) for r in vocabulary.encode(df, "k", F.col("t"), vocab, 1, most).collect())
        assert got == [(1, [7, 8, 1]), (1, [8]), (2, []), (3, [])]


def test_config():
    got = readers.load_config("a: 1\nb:\n  c: true\n  d: [1, x]\ne:\n  - p\n  - 2\n", {"b": {"z": 3}})
    assert got == {"a": 1, "b": {"c": True, "d": [1, "x"], "z": 3}, "e": ["p", 2]}


def test_stages():
    assert formulas.context_stages(20, 131072)[-1] == (14, 20, 131072)


def test_history_on_empty(spark, sf):
    c, f = (spark.read.parquet(f"{sf}/{n}.parquet").limit(0) for n in ("commits", "file_diffs"))
    assert history.repository_stats(c, f).first()["merge_rate"] == 0.0
    assert history.author_stats(c, f).count() == 0 and history.neighbours(c.select("hash", "commit_timestamp")).count() == 0


def test_orders_and_upsampling_of_any_size(spark, tmp_path):
    import __spark_entry__ as entry

    spark.createDataFrame([(i,) for i in range(1200)], "doc_id bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, [5, 5]), (2, [1, 2, 3, 4]), (3, None), (4, [1, 2]), (5, [])], "pack_id bigint, tokens array<int>").write.parquet(f"{tmp_path}/packed_sequences.parquet")
    spark.createDataFrame([("a", 1, 0.5), ("b", 1, None), ("c", 1, 0.1)], "hash string, scraped_at int, complexity_score double").write.parquet(f"{tmp_path}/commits.parquet")
    q = entry.queries()
    rows = lambda name: q[name](spark, str(tmp_path)).collect()
    assert sum(r["n"] for r in rows("smp_x4_upsample_tenth")) == 1320
    assert [r["pack_id"] for r in sorted(rows("srt_t5_entropy_order"), key=lambda r: r["place"])] == [2, 4, 1, 5]
    assert [r["hash"] for r in sorted(rows("srt_t2_complexity_order"), key=lambda r: r["place"])] == ["b", "c", "a"]
