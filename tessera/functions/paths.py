"""File paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks test, documentation and core files.
TEST_MARKS, TEST_MARKS_SHORT = ("test", "spec"), ("test",)
DOC_SUFFIXES = ("md", "txt")
CORE_FOLDERS = ("src", "crates")


def crate_of(path: Column) -> Column:
    parts = F.split(path, "/")
    return F.when((F.get(parts, F.lit(0)) == "crates") & (F.size(parts) > 1), F.get(parts, F.lit(1))).otherwise("root")


def top_directory(path: Column) -> Column:
    return F.when(F.contains(path, F.lit("/")), F.split_part(path, F.lit("/"), F.lit(1))).otherwise("root")


def primary_directory(*lists: Column) -> Column:
    """First part of the first non-empty path in several lists of paths; null if there is none."""
    first = F.get(F.filter(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]), lambda p: p != ""), F.lit(0))
    return F.split_part(first, F.lit("/"), F.lit(1))


def suffix(path: Column) -> Column:
    """Last suffix without its dot; a leading dot makes none."""
    return F.regexp_extract(path, r"[^/.][^/]*\.([^./]+)$", 1)


def marked(path: Column, marks: tuple[str, ...]) -> Column:
    low = F.lower(path)
    out = F.contains(low, F.lit(marks[0]))
    for m in marks[1:]:
        out = out | F.contains(low, F.lit(m))
    return out


def is_doc(path: Column) -> Column:
    return suffix(path).isin(*DOC_SUFFIXES)


def is_core(path: Column) -> Column:
    return top_directory(path).isin(*CORE_FOLDERS) | F.contains(F.lower(path), F.lit("core"))


def module_path(path: Column) -> Column:
    """Parts below the first source folder (all parts without one) joined by '::'; lib.rs and mod.rs name their folder."""
    parts = F.split(path, "/")
    at = F.array_position(parts, "src").cast("int")
    below = F.when(at > 0, F.slice(parts, at + 1, F.size(parts))).otherwise(parts)
    last = F.element_at(below, -1)
    stem = F.slice(below, 1, F.greatest(F.size(below) - 1, F.lit(0)))
    named = F.when(last.isin("lib.rs", "mod.rs"), stem).when(F.endswith(last, F.lit(".rs")), F.concat(stem, F.array(F.regexp_replace(last, r"\.rs$", "")))).otherwise(below)
    return F.array_join(F.when(F.size(below) > 0, named).otherwise(below), "::")


def glob_regex(pattern: str) -> str:
    """Regular expression of a glob; '**' crosses folders, '*' and '?' do not."""
    out, i = "", 0
    while i < len(pattern):
        if pattern.startswith("**", i):
            out, i = out + ".*", i + 2
            continue
        c = pattern[i]
        out += "[^/]*" if c == "*" else "[^/]" if c == "?" else ("\\" + c if c in ".+()[]{}^$|\\" else c)
        i += 1
    return f"^{out}$"


def ignored(path: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | path.rlike(glob_regex(p))
    return out
