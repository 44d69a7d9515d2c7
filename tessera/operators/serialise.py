"""Commits, chunks and snapshots as marked-up text, and text augmentation."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import gate
from tessera.functions.tokens import code_tokens, text_tokens

# Renaming maps, applied in this order.
RENAMES_LONG = (("x", "value"), ("y", "result"), ("i", "index"), ("j", "counter"), ("k", "position"), ("n", "count"), ("m", "size"), ("len", "length"), ("tmp", "temp"), ("buf", "buffer"), ("ptr", "pointer"), ("idx", "id"))
RENAMES_SHORT = (("x", "value"), ("i", "index"), ("j", "count"), ("k", "pos"), ("n", "num"), ("m", "size"), ("data", "input"), ("result", "output"), ("buf", "buffer"), ("temp", "temporary"), ("arr", "array"))
MASK_RATES = {"easy": 0.05, "medium": 0.10, "hard": 0.15}


def commit_block(body_chars: int = 200) -> Column:
    """A commit as lines of markers; optional lines are left out where there is nothing to say."""
    none = F.lit(None).cast("string")

    def some(cond: Column, text: Column) -> Column:
        return F.when(cond, text).otherwise(none)

    ins, dele = F.coalesce("insertions", F.lit(0)), F.coalesce("deletions", F.lit(0))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("<COMMIT> "), F.coalesce("abbrev_hash", F.lit(""))),
        F.concat(F.lit("<AUTHOR> "), F.coalesce("author_name", F.lit(""))),
        F.concat(F.lit("<TIMESTAMP> "), F.coalesce(F.col("commit_timestamp").cast("string"), F.lit(""))),
        some(F.size("branches") > 0, F.concat(F.lit("<BRANCH> "), F.array_join("branches", " "))),
        F.concat(F.lit("<COMPLEXITY> "), F.format_string("%.2f", F.bround(F.coalesce("complexity_score", F.lit(0.0)), 2))),
        some(F.coalesce("is_merge", F.lit(False)), F.concat(F.lit("<MERGE> parents:"), F.greatest(F.size("parents"), F.lit(0)).cast("string"), F.lit(" files:"), F.coalesce("files_changed", F.lit(0)).cast("string"))),
        F.concat(F.lit("<SUBJECT> "), F.coalesce("subject", F.lit(""))),
        some(F.coalesce("body", F.lit("")) != "", F.concat(F.lit("<BODY> "), F.substring("body", 1, body_chars))),
        some((ins > 0) | (dele > 0), F.concat(F.lit("  +"), ins.cast("string"), F.lit(" -"), dele.cast("string"))),
        some(F.size("related_issues") > 0, F.concat(F.lit("<RELATED> issues: "), F.array_join("related_issues", " "))),
        F.lit("</COMMIT>"),
    )


def commit_flat() -> Column:
    return F.concat_ws(" ", F.lit("<COMMIT>"), "abbrev_hash", F.lit("<AUTHOR>"), "author_name", F.lit("<MSG>"), "subject", F.lit("</COMMIT>"))


def snapshot_block() -> Column:
    return F.concat_ws("\n", F.concat(F.lit("<FILE> "), F.coalesce("path", F.lit("unknown"))), F.concat(F.lit("<LANG> "), F.coalesce("lang", F.lit("unknown"))), "text", F.lit("</FILE>"))


def chunk_tokens() -> Column:
    """Structural token list of a chunk: markers, limited message, old and new code."""
    meta = F.col("commit_meta")
    old = F.coalesce("old_code", F.lit(""))
    none = F.array().cast("array<string>")
    month = F.date_format(F.to_utc_timestamp(F.timestamp_seconds(meta["timestamp_unix"]), F.current_timezone()), "yyyy-MM")
    return F.concat(
        F.array(F.lit("<COMMIT_START>"), F.concat(F.lit("<FILE:"), F.coalesce("file_path", F.lit("unknown")), F.lit(">")), F.concat(F.lit("<CHANGE:"), F.coalesce("change_type", F.lit("unknown")), F.lit(">")), F.concat(F.lit("<AUTHOR:"), F.coalesce(meta["author"], F.lit("unknown")), F.lit(">"))),
        F.when(meta["timestamp_unix"].isNotNull(), F.array(F.concat(F.lit("<TIMESTAMP:"), month, F.lit(">")))).otherwise(none),
        F.when(F.coalesce("module_path", F.lit("")) != "", F.array(F.concat(F.lit("<MODULE:"), F.col("module_path"), F.lit(">")))).otherwise(none),
        F.array(F.lit("<CODE_START>")), F.slice(text_tokens(F.coalesce(meta["message"], F.lit(""))), 1, 64), F.array(F.lit("<CODE_END>")),
        F.when(old != "", F.concat(F.array(F.lit("<OLD_CODE_START>")), F.slice(code_tokens(old), 1, 512), F.array(F.lit("<OLD_CODE_END>")))).otherwise(none),
        F.array(F.lit("<NEW_CODE_START>")), F.slice(code_tokens(F.coalesce("new_code", F.lit(""))), 1, 2048), F.array(F.lit("<NEW_CODE_END>"), F.lit("<COMMIT_END>")),
    )


def renamed(text: Column, renames: tuple[tuple[str, str], ...] = RENAMES_LONG) -> Column:
    """Whole-word renames, one after another."""
    for old, new in renames:
        text = F.regexp_replace(text, rf"\b{old}\b", new)
    return text


def suffixed(text: Column) -> Column:
    return F.regexp_replace(text, r"\b(x|i|j|temp)\b", "$1_var")


def renamed_ast(text: Column) -> Column:
    """Python code with x, i, j and temp renamed in its syntax tree; unparsable code unchanged."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ast

        def one(t: str | None) -> str | None:
            try:
                tree = ast.parse(t or "")
                for node in ast.walk(tree):
                    if isinstance(node, ast.Name) and node.id in ("x", "i", "j", "temp"):
                        node.id += "_var"
                return ast.unparse(tree)
            except (SyntaxError, ValueError, RecursionError, MemoryError):
                return t

        for s in batches:
            yield s.map(one)

    return run(text)


def error_comment(text: Column) -> Column:
    """A comment before the first 'fn ' unless the first 200 characters name Result."""
    at = F.instr(text, "fn ")
    put = F.concat(F.substring(text, F.lit(1), at - 1), F.lit("// Error-aware version\n"), F.substring(text, at, F.length(text)))
    return F.when((at > 0) & ~F.contains(F.substring(text, 1, 200), F.lit("Result<")), put).otherwise(text)


def typed_lets(text: Column) -> Column:
    return F.regexp_replace(text, r"let (\w+) =", "let $1: _ =")


def dependency_header(text: Column, imports: Column) -> Column:
    listed = F.concat(F.lit("// Dependencies: "), F.array_join(F.slice(F.array_sort(imports), 1, 5), ", "), F.lit("\n"), text)
    return F.when(F.size(imports) > 0, listed).otherwise(text)


def age_header(text: Column, age_days: Column) -> Column:
    return F.concat(F.when(age_days < 30, "// Recently modified\n").when(age_days < 90, "// Modified this quarter\n").otherwise("// Stable code\n"), text)


def masked(tokens: Column, rate: Column | float, seed: int, *key: str) -> Column:
    """Tokens replaced by [MASK] at a rate, chosen by hash of key and position."""
    rate = F.lit(rate) if isinstance(rate, float) else rate
    from tessera.functions.hashing import h32

    return F.transform(tokens, lambda t, i: F.when((h32(seed, *key, i) % 10000 < rate * 10000) & ~t.isin("[CLS]", "[SEP]", "[PAD]"), "[MASK]").otherwise(t))


def spaced(text: Column) -> Column:
    """Positive variant: spaces before braces, no blank lines."""
    t = F.replace(F.replace(text, F.lit("{"), F.lit(" {")), F.lit("}"), F.lit(" }"))
    return F.regexp_replace(t, r"\n\s*\n", "\n")


def flipped(text: Column) -> Column:
    """Negative variant: returned booleans are exchanged."""
    t = F.replace(text, F.lit("return true"), F.lit("return SWAP_MARKER"))
    return F.replace(F.replace(t, F.lit("return false"), F.lit("return true")), F.lit("return SWAP_MARKER"), F.lit("return false"))


def contrastive(text: str, key: str, seed: int = 42) -> Column:
    """Array of (pair_type, text): a positive and a negative variant."""
    return F.array(F.struct(F.lit("positive").alias("pair_type"), spaced(F.col(text)).alias("text")), F.struct(F.lit("negative").alias("pair_type"), flipped(F.col(text)).alias("text")))


def without_comments(text: Column, seed: int, *key: str) -> Column:
    """Comments after '//' or '#' dropped from about half of the lines that have one."""
    from tessera.functions.hashing import h32

    return F.array_join(F.transform(F.split(text, "\n"), lambda x, i: F.when(x.rlike("//|#") & (h32(seed, *key, i) % 10000 < 5000), F.regexp_replace(x, r"(//|#).*$", "")).otherwise(x)), "\n")


def reformatted(text: Column, seed: int, *key: str) -> Column:
    """Compact or verbose form, by hash."""
    verbose = F.replace(F.replace(text, F.lit("} else {"), F.lit("}\nelse {")), F.lit("; "), F.lit(";\n"))
    return F.when(gate(0.5, seed, *key), F.regexp_replace(text, r"\n\s*\n", "\n")).otherwise(verbose)


# Marks of files by suffix in texts that stress changes.
FILE_MARKS = ((".rs", "<RS_FILE>"), (".toml", "<TOML_FILE>"), (".proto", "<PROTO_FILE>"))


def commit_styles(commits: DataFrame, diffs: DataFrame) -> DataFrame:
    """(hash, flat, semantic, hierarchical, diff_aware): four one-line texts of every commit.

    Files are taken from the diffs in order of their names; predecessors are those of the two commits before that
    share the first branch.
    """
    from tessera.operators.history import neighbours

    none = F.lit(None).cast("string")
    empty = F.array().cast("array<string>")

    def kind(k: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("change_type") == k, F.col("filename"))))

    stat = F.struct("filename", F.coalesce("additions", F.lit(0)).alias("a"), F.coalesce("deletions", F.lit(0)).alias("d"))
    files = diffs.where("filename is not null").groupBy(F.col("commit_hash").alias("hash")).agg(kind("A").alias("added"), kind("M").alias("modified"), kind("D").alias("deleted"), F.slice(F.array_sort(F.collect_set(stat)), 1, 10).alias("stats"))
    branch = F.coalesce(F.get("branches", F.lit(0)), F.lit(""))
    c = commits.withColumn("branch", branch)
    before = neighbours(c.select("hash", "commit_timestamp"), 2, 0).select("hash", F.posexplode("previous").alias("pos", "p"))
    mine = c.select("hash", "branch")
    same = before.join(mine, "hash").join(mine.select(F.col("hash").alias("p"), F.col("branch").alias("pb")), "p").where("pb = branch")
    chains = same.groupBy("hash").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.substring("p", 1, 8).alias("s")))), lambda x: x["s"]), "|").alias("chain"))
    c = c.join(files, "hash", "left").join(chains, "hash", "left").withColumns({k: F.coalesce(k, empty) for k in ("added", "modified", "deleted")})
    short, author, subject = F.substring("hash", 1, 8), F.coalesce("author_name", F.lit("")), F.coalesce("subject", F.lit(""))
    ins, dele = F.coalesce("insertions", F.lit(0)).cast("string"), F.coalesce("deletions", F.lit(0)).cast("string")
    merge = F.coalesce("is_merge", F.lit(False))
    sums = F.concat(F.lit("<INSERTIONS> "), ins, F.lit(" <DELETIONS> "), dele)

    def counted(mark: str, col: str) -> Column:
        return F.when(F.size(col) > 0, F.concat(F.lit(mark + " "), F.size(col).cast("string"))).otherwise(none)

    def base(p: Column) -> Column:
        return F.element_at(F.split(p, "/"), -1)

    def mark(p: Column) -> Column:
        out = F.when(F.endswith(p, F.lit(FILE_MARKS[0][0])), FILE_MARKS[0][1])
        for suffix, name in FILE_MARKS[1:]:
            out = out.when(F.endswith(p, F.lit(suffix)), name)
        return out.otherwise("<FILE>")

    every = F.concat("added", "modified", "deleted")
    flat = F.concat_ws(" ", F.lit("<COMMIT>"), F.when(merge, F.lit("<MERGE>")), short, F.lit("<AUTHOR>"), author, F.lit("<MESSAGE>"), subject, sums)
    semantic = F.concat_ws(
        " ", F.lit("<COMMIT>"), short, F.lit("<AUTHOR>"), F.replace(author, F.lit(" "), F.lit("_")), F.coalesce("author_email", F.lit("")), F.lit("<BRANCH>"), F.replace(F.col("branch"), F.lit("/"), F.lit("_")), F.lit("<MESSAGE>"), F.substring(subject, 1, 100),
        counted("<FILE_ADD>", "added"), counted("<FILE_MOD>", "modified"), counted("<FILE_DEL>", "deleted"), sums,
        F.when(F.size("modified") > 0, F.concat(F.lit("FILES "), F.array_join(F.slice("modified", 1, 5), ";"))), F.when(F.size("parents") > 0, F.concat(F.lit("<PARENT> "), F.substring(F.get("parents", F.lit(0)), 1, 8))),
    )
    hierarchical = F.concat_ws(
        " ", F.when(F.col("chain").isNotNull(), F.concat(F.lit("<PRED> "), F.col("chain"))), F.lit("<COMMIT>"), short, F.lit("<BRANCH>"), F.col("branch"), F.when(merge, F.concat(F.lit("<MERGE> "), F.array_join(F.transform("parents", lambda p: F.substring(p, 1, 8)), "|"))),
        F.lit("<AUTHOR>"), author, F.lit("<MESSAGE>"), F.substring(subject, 1, 80), F.when(F.size(every) > 0, F.concat(F.lit("FILES "), F.array_join(F.transform(F.slice(every, 1, 10), base), "|"))),
    )
    changed = F.transform(F.coalesce("stats", F.slice(F.array(F.struct(F.lit("").alias("filename"), F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("d"))), 1, 0)), lambda x: F.concat_ws(" ", mark(x["filename"]), base(x["filename"]), F.lit("<INSERTIONS>"), x["a"].cast("string"), F.lit("<DELETIONS>"), x["d"].cast("string")))
    diff_aware = F.concat_ws(" ", F.lit("<COMMIT>"), short, F.lit("<AUTHOR>"), author, changed, F.lit("<MESSAGE>"), subject)
    return c.select("hash", flat.alias("flat"), semantic.alias("semantic"), hierarchical.alias("hierarchical"), diff_aware.alias("diff_aware"))
