"""Features of source code."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.tokens import WORD, occurrences

# Patterns, keyword lists and weights of the measures, which must equal those in use elsewhere.
FUNCTION_NAME = r"^\s*(?:pub\s+)?(?:async\s+)?fn\s+([a-z_][a-z0-9_]*)\s*[(<]"
STRUCT_NAME = r"^\s*(?:pub\s+)?struct\s+([A-Z][a-zA-Z0-9_]*)\s*[{(<]"
TRAIT_NAME = r"^\s*(?:pub\s+)?trait\s+([A-Z][a-zA-Z0-9_]*)"
TEST_CODE = r"^\s*#\[(?:tokio::)?test\]|fn\s+test_"
USE_LINE = r"^\s*use\s+"
FIX_WORDS = ("fix", "bug", "error", "panic", "unwrap", "expect")
SPEED_WORDS = ("cache", "lazy", "inline", "optimize", "perf", "batch")
DECISIONS = ("if ", "elif ", "else ", "for ", "while ", "match ", "case ", "&& ", "|| ", "? ")
SCAN_WEIGHTS = (("fn ", 5), ("impl ", 10), ("trait ", 15), ("unsafe ", 20))
OUTLINE_WEIGHTS = (("def ", 1), ("fn ", 1), ("class ", 1), ("struct ", 1), ("impl ", 1))
ERROR_MARKS = ("Result<", "Option<", "?")
CONFIG_SUFFIXES = ("yaml", "yml", "toml", "json")
OPERATOR = r"[+\-*/=<>!&|^~%]|->|=>|\.\."
IDENTIFIER = r"^[a-zA-Z_][a-zA-Z0-9_]*$"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def split_lines(text: Column) -> Column:
    """Lines without a last empty one, by every line separator."""
    unified = F.regexp_replace(text, "\\r\\n|[\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]", "\n")
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(unified, "\n\\z", ""), "\n"))


def diff_counts(diff: Column) -> tuple[Column, Column, Column]:
    """(added, removed, hunks): line breaks followed by '+', '-' or '@@'; the first line never counts."""
    return occurrences(diff, "\n+"), occurrences(diff, "\n-"), occurrences(diff, "\n@@")


def saturating(n: Column) -> Column:
    return n / (n + F.lit(1.0))


def added_lines(patch: Column) -> Column:
    """Added lines without their sign; only file headers are left out."""
    keep = F.filter(lines_of(patch), lambda x: F.startswith(x, F.lit("+")) & ~F.startswith(x, F.lit("+++ ")))
    return F.transform(keep, lambda x: F.substring(x, F.lit(2), F.length(x)))


def removed_lines(patch: Column) -> Column:
    keep = F.filter(lines_of(patch), lambda x: F.startswith(x, F.lit("-")) & ~F.startswith(x, F.lit("--- ")))
    return F.transform(keep, lambda x: F.substring(x, F.lit(2), F.length(x)))


def after_hunk(patch: Column, sign: str) -> Column:
    """Lines with a sign below the first hunk header only."""
    all_ = lines_of(patch)
    at = F.array_position(F.transform(all_, lambda x: F.startswith(x, F.lit("@@"))), True).cast("int")
    below = F.when(at > 0, F.slice(all_, at + 1, F.size(all_))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.filter(below, lambda x: F.startswith(x, F.lit(sign))), lambda x: F.substring(x, F.lit(2), F.length(x)))


def first_name(code: Column, pattern: str) -> Column:
    """First group of the first line that matches; empty if none does."""
    hit = F.get(F.filter(lines_of(code), lambda x: x.rlike(pattern)), F.lit(0))
    return F.coalesce(F.regexp_extract(hit, pattern, 1), F.lit(""))


def use_lines(code: Column) -> Column:
    return F.transform(F.filter(lines_of(code), lambda x: x.rlike(USE_LINE)), lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))


def import_prefixes(code: Column) -> Column:
    """First path part of lines that hold 'use ' and '::'."""
    hits = F.filter(lines_of(code), lambda x: F.contains(x, F.lit("use ")) & F.contains(x, F.lit("::")))
    return F.transform(hits, lambda x: F.split_part(F.trim(F.regexp_replace(x, r"^.*?use ", "")), F.lit("::"), F.lit(1)))


def change_type(code: Column, added: Column, removed: Column, test: Column | None = None) -> Column:
    """Kind of a change: the first added line that is a function or struct head, or any added line of test code, decides;
    then balanced or unbalanced edits, then words of fixes and of optimisations.  ``test``: whether the code is test code,
    given as a column so that it is not matched anew for every line."""
    test = code.rlike(TEST_CODE) if test is None else test
    kinds = F.transform(added, lambda x: F.when(x.rlike(FUNCTION_NAME), "new_function").when(x.rlike(STRUCT_NAME), "new_struct").when(test, "new_test"))
    low = F.lower(code)

    def has(words: tuple[str, ...]) -> Column:
        return low.rlike("|".join(words))

    both = (F.size(added) > 0) & (F.size(removed) > 0)
    rest = (
        F.when(test, "modified_function")
        .when(both & (F.abs(F.size(added) - F.size(removed)) < 5), "refactoring")
        .when(both, "modified_logic")
        .when(has(FIX_WORDS), "bug_fix")
        .when(has(SPEED_WORDS), "optimization")
        .otherwise("unknown")
    )
    return F.coalesce(F.get(F.filter(kinds, lambda k: k.isNotNull()), F.lit(0)), rest)


def config_change(file_type: Column, otherwise: Column) -> Column:
    return F.when(file_type.isin(*CONFIG_SUFFIXES), "configuration").otherwise(otherwise)


def weighted_score(text: Column, weights: tuple[tuple[str, int], ...], cap: int) -> Column:
    """Lines and weighted keywords, at most ``cap``."""
    score = F.size(lines_of(text)).cast("bigint")
    for word, weight in weights:
        score = score + occurrences(text, word) * weight
    return F.least(score, F.lit(cap).cast("bigint"))


def cyclomatic(text: Column) -> Column:
    n = F.lit(1).cast("bigint")
    for w in DECISIONS:
        n = n + occurrences(text, w)
    return F.least(n, F.lit(100).cast("bigint"))


def halstead(text: Column) -> Column:
    """Volume over operators and identifiers, an integer of at most 1000."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    ops, names = F.regexp_count(text, F.lit(OPERATOR)), F.size(F.filter(words, lambda w: w.rlike(IDENTIFIER)))
    bits = F.log2((F.greatest(ops, F.lit(1)) + F.greatest(names, F.lit(1))).cast("double"))
    return F.least(F.floor((ops + names) * bits), F.lit(1000).cast("bigint"))


def nesting(text: Column) -> Column:
    """Deepest bracket nesting; closing brackets may take it below zero before it rises."""
    marks = F.split(F.regexp_replace(text, r"[^\[\](){}]", ""), "")
    return F.aggregate(
        marks,
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("m")),
        lambda a, c: F.when(c.isin("(", "[", "{"), F.struct((a["d"] + 1).alias("d"), F.greatest(a["m"], a["d"] + 1).alias("m"))).when(c.isin(")", "]", "}"), F.struct((a["d"] - 1).alias("d"), a["m"].alias("m"))).otherwise(a),
        lambda a: a["m"],
    )


def composite(text: Column) -> Column:
    """3 cyclomatic + 0.5 Halstead + 5 nesting + 0.1 lines, as an integer."""
    return F.floor(cyclomatic(text) * 3.0 + halstead(text) * 0.5 + nesting(text) * 5.0 + F.size(lines_of(text)) * 0.1)


def type_density(text: Column) -> Column:
    """Colons per thousand characters."""
    return occurrences(text, ":") / F.greatest(F.length(text), F.lit(1)) * 1000


def error_marks(text: Column) -> Column:
    n = F.lit(0).cast("bigint")
    for w in ERROR_MARKS:
        n = n + occurrences(text, w)
    return n


def python_ast(text: Column) -> Column:
    """Functions, classes and imports of Python code by its syntax tree; empty where it does not parse."""

    @F.pandas_udf("struct<functions:array<string>,classes:array<string>,imports:array<string>>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            out = []
            for t in s:
                f, c, i = [], [], []
                try:
                    for node in ast.walk(ast.parse(t or "")):
                        if isinstance(node, ast.FunctionDef):
                            f.append(node.name)
                        elif isinstance(node, ast.ClassDef):
                            c.append(node.name)
                        elif isinstance(node, ast.Import) and node.names:
                            i.append(node.names[0].name)
                except (SyntaxError, ValueError, RecursionError, MemoryError):
                    f, c, i = [], [], []
                out.append((f, c, i))
            yield pd.DataFrame(out, columns=["functions", "classes", "imports"])

    return parse(text)
