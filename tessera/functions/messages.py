"""Commit messages and commit figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def subject_of(message: Column) -> Column:
    return strip(F.split_part(message, F.lit("\n"), F.lit(1)))


def body_of(message: Column) -> Column:
    """What follows the first line break; empty if there is none."""
    return strip(F.when(F.contains(message, F.lit("\n")), F.substring(message, F.instr(message, "\n") + F.lit(1), F.length(message))).otherwise(F.lit("")))


def is_squash(message: Column) -> Column:
    return F.contains(F.lower(message), F.lit("squash"))


def is_fixup(message: Column) -> Column:
    return F.startswith(message, F.lit("fixup!"))


def is_revert(message: Column) -> Column:
    return F.startswith(message, F.lit("Revert"))


def issue_refs(message: Column) -> Column:
    """#12-style references, with the sign."""
    return F.transform(F.regexp_extract_all(message, F.lit(r"#(\d+)"), F.lit(1)), lambda x: F.concat(F.lit("#"), x))


def commit_refs(message: Column) -> Column:
    return F.regexp_extract_all(message, F.lit(r"(?i)\b([0-9a-f]{7,40})\b"), F.lit(1))


def complexity(lines: Column, files: Column, merge: Column) -> Column:
    """Weighted size of a commit in [0, 1]; merges count half as much again."""
    size = F.least(lines / F.lit(500.0), F.lit(1.0)) * 0.6 + F.least(files / F.lit(50.0), F.lit(1.0)) * 0.4
    return F.least(size * F.when(merge, 1.5).otherwise(1.0), F.lit(1.0))


def high_risk(lines: Column, files: Column) -> Column:
    return (lines > 500) | (files > 20)


def change_kind(new: Column, deleted: Column, renamed: Column, rename_first: bool = False) -> Column:
    """add, delete, rename or modify; which wins if several hold depends on the caller."""
    order = [(renamed, "rename"), (new, "add"), (deleted, "delete")] if rename_first else [(new, "add"), (deleted, "delete"), (renamed, "rename")]
    out = F.when(order[0][0], order[0][1])
    for cond, name in order[1:]:
        out = out.when(cond, name)
    return out.otherwise("modify")


def stat_numbers(stat: Column) -> tuple[Column, Column, Column]:
    """(files, insertions, deletions) of a line like ' 3 files changed, 10 insertions(+), 2 deletions(-)'."""

    def number(pattern: str) -> Column:
        return F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(stat, pattern, 1), F.lit("")), F.lit("999999999")).cast("bigint"), F.lit(0).cast("bigint"))

    return number(r"(\d+) files? changed"), number(r"(\d+) insertions?\(\+\)"), number(r"(\d+) deletions?\(-\)")
