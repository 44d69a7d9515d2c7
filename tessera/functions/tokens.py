"""Regular-expression tokenizers and token arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Identifiers, integers and single operator characters; quotes, '@', '#' and ')' are no tokens.
CODE_TOKEN = r"[a-zA-Z_][a-zA-Z0-9_]*|[0-9]+|[+\-*/%=<>!&|^~?:|;,.(\[\]{}]"
WORD = r"[\p{L}\p{N}_]+"


def code_tokens(code: Column) -> Column:
    return F.regexp_extract_all(code, F.lit(CODE_TOKEN), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def text_tokens(text: Column) -> Column:
    """Words by white space, with a final '.' or ',' as a token of its own."""
    parts = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    return F.flatten(
        F.transform(
            parts,
            lambda w: F.when(F.endswith(w, F.lit(".")) | F.endswith(w, F.lit(",")), F.array(F.substring(w, F.lit(1), F.length(w) - 1), F.right(w, F.lit(1)))).otherwise(F.array(w)),
        )
    )


def occurrences(text: Column, what: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))) / F.lit(len(what))).cast("bigint")


def clamp(tokens: Column, size: int) -> Column:
    """Ids limited to [0, size - 1]."""
    return F.transform(tokens, lambda t: F.greatest(F.lit(0), F.least(t, F.lit(size - 1))))


def tokens_per_line(tokens: Column, line_end: int = 5) -> Column:
    return F.size(tokens) / F.greatest(F.size(F.filter(tokens, lambda t: t == line_end)), F.lit(1))


def fit(tokens: Column, width: int, pad: int = 0) -> Column:
    """Padded or cut to a width."""
    return F.slice(F.concat(tokens, F.array_repeat(F.lit(pad), width)), 1, width)


def fit_mask(tokens: Column, width: int) -> Column:
    """1 for each real token and 0 for each padded one."""
    n = F.least(F.size(tokens), F.lit(width))
    return F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.lit(width) - n))


def mask_labels(labels: Column, mask: Column) -> Column:
    return F.zip_with(labels, mask, lambda x, m: F.when(m == 0, F.lit(-100)).otherwise(x))


def span_labels(labels: Column, fraction: float) -> Column:
    """Only a centred share of the labels is kept; the rest is -100."""
    n = F.size(labels)
    keep = F.greatest(F.floor(n * F.lit(fraction)).cast("int"), F.lit(1))
    lo = F.floor((n - keep) / 2).cast("int")
    return F.transform(labels, lambda x, i: F.when((i >= lo) & (i < lo + keep), x).otherwise(F.lit(-100)))


def fill_in_middle(tokens: Column, prefix: int, middle: int, suffix: int) -> Column:
    """prefix (first quarter), suffix (last quarter), middle, each after its marker; short arrays unchanged; same length."""
    n = F.size(tokens)
    q = F.floor(n / 4).cast("int")
    s = F.floor(n * 3 / 4).cast("int")
    out = F.concat(
        F.array(F.lit(prefix)), F.slice(tokens, 1, F.greatest(q, F.lit(1))), F.array(F.lit(suffix)), F.slice(tokens, s + 1, F.greatest(n - s, F.lit(1))), F.array(F.lit(middle)), F.slice(tokens, q + 1, F.greatest(s - q, F.lit(1)))
    )
    return F.when(n < 8, tokens).otherwise(F.slice(out, 1, n + 3))


def entropy8(tokens: Column) -> Column:
    """Shannon entropy of an array in bits over 8, at most 1; 0 below two tokens."""
    n = F.size(tokens)
    ordered = F.array_sort(tokens)
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))

    def term(run: Column) -> Column:
        return F.when(run > 0, run * F.log2(F.greatest(run, F.lit(1)))).otherwise(F.lit(0.0))

    folded = F.aggregate(
        ordered.cast("array<int>"),
        start,
        lambda a, x: F.when(a["last"].eqNullSafe(x), F.struct(x.alias("last"), (a["run"] + 1).alias("run"), a["sum"].alias("sum"))).otherwise(F.struct(x.alias("last"), F.lit(1).alias("run"), (a["sum"] + term(a["run"])).alias("sum"))),
        lambda a: a["sum"] + term(a["run"]),
    )
    # H = log2(n) - sum(c log2 c) / n
    return F.when(n < 2, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.log2(n) - folded / n) / 8))
