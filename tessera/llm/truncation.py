"""Problem 6: values that lost their end when they were sent or stored.

One pass recomputes the length of every value in characters, UTF-8 bytes and UTF-16 units, as stored
and after newline conversion, entity escaping and JSON escaping.  Grouped by origin, field and
encoding, hidden storage limits show as a pile of different values at one length with almost none above it, or, where a
limit was raised later, with few values around it and endings in the middle of lines, and not mostly of values proven whole; a value is counted at the largest pile it
is in, so a field can have several limits, each in the encoding it counts in.  Values are then judged by their
endings.  What a chunk's patch adds and removes is its new and old code, so an ending is lost where one of them is a strict
beginning of the other, where it stops in a replacement character, or where a last hunk holds fewer lines than its header
says.  Since headers are also plainly wrong at times, the last sign counts only at a limit, or for origins where it is more than
twice as frequent as for the reference: the origins whose rate of sure cuts is lowest.  Rates carry one cut more than
was seen, so a stray cut takes no large origin out of the reference, and a small one without a cut yet is not in it.

Values proven cut or whole that way show how often either kind ends at a line end, in closing or other punctuation, in a word, in
an open string, or in the beginning of a word: one that is met nowhere else as a word, while longer words begin with it.  All
other values are judged by these odds: at a limit against the height of its pile, elsewhere against the
share of proven cuts of the origin, so an origin without any is believed.

Defined results: null and empty values have lost nothing; a value at a limit that its counterpart
proves whole is whole; ties between encodings go to the first in ``ENCODINGS``; a null origin is a group
of its own; repeated chunk_ids are judged row by row and reported once; empty tables give empty results; where no
origin is clean, the least cut ones are the reference, whose own short hunks are not trusted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.session import cut, spread

FIELDS = ("old_code", "new_code", "patch")
ENCODINGS = ("chars", "utf8", "utf16", "entities", "entities_utf8", "json", "json_utf8", "json_ascii", "crlf", "crlf_utf8")
#: A limit needs this many values at one length, so many times the average number at lengths just below, and at most this share above.
PILE, PEAK, ABOVE = 5, 8.0, 0.1
LEAST_LIMIT = 64
#: A pile with more above it must be so many times ``PILE`` high, and this share of it must end within a line.
TWICE, WITHIN = 2, 0.5
#: Letters of a last word from which on it may be the beginning of another.
BEGINNING = 3
#: Origins with up to this many times the lowest cut rate are the reference; others lose more only beyond it, in cuts and in short last hunks.
TIMES = 2
#: A cut by bytes may drop the rest of a character (up to 3 bytes) or replace its bytes (3 bytes each).
SLACK_BELOW, SLACK_ABOVE = 3, 6

_HUNK = re.compile(r"^@@ -\d+(?:,(\d+))? \+\d+(?:,(\d+))? @@")
_QUOTES = re.compile(r"\\.|'\"'")
_LAST = re.compile(r"\w{1,64}\Z")
_ESCAPED = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")


def lengths(v: str) -> list[int]:
    """Length of a value under each of ``ENCODINGS``."""
    n = len(v)
    utf8 = n if v.isascii() else len(v.encode("utf-8", "surrogatepass"))
    utf16 = n if utf8 == n else len(v.encode("utf-16-le", "surrogatepass")) // 2
    quotes, amp = v.count('"'), v.count("&") * 4 + (v.count("<") + v.count(">")) * 3
    entities = amp + 5 * quotes + 5 * v.count("'")
    lines, crlf = v.count("\n"), v.count("\r\n")
    escaped = quotes + v.count("\\") + lines + v.count("\r") + v.count("\t") + 5 * len(_ESCAPED.findall(v))
    beyond = 0
    if utf8 != n:  # \uXXXX for each UTF-16 unit that is not ASCII
        beyond = 5 * sum(1 for c in v if ord(c) > 127) + 6 * (utf16 - n)
    return [n, utf8, utf16, n + entities, utf8 + entities, n + escaped, utf8 + escaped, n + escaped + beyond, n + lines - crlf, utf8 + lines - crlf]


def patch_sides(patch: str) -> tuple[str, str, int, int]:
    """(removed text, added text, lines missing from the last hunk, lines by which other hunks are wrong)."""
    old: list[str] = []
    new: list[str] = []
    hunks: list[list[int]] = []
    inside = False
    for line in patch.replace("\r\n", "\n").split("\n"):
        if line.startswith("@@"):
            inside = True
            m = _HUNK.match(line)
            hunks.append([int(m[1] or 1), int(m[2] or 1)] if m else [-1, -1])
            seen = [0, 0]
            hunks[-1] += seen
            continue
        if not inside and line.startswith(("+++", "---")):
            continue
        sign = line[:1]
        if sign == "+":
            new.append(line[1:])
        elif sign == "-":
            old.append(line[1:])
        if hunks and sign != "\\":
            h = hunks[-1]
            h[2] += sign != "+"
            h[3] += sign != "-"
    known = [h for h in hunks if h[0] >= 0]
    last = hunks[-1] if hunks and hunks[-1][0] >= 0 else None
    missing = 0
    if last is not None and last[2] <= last[0] and last[3] <= last[1]:
        missing = (last[0] - last[2]) + (last[1] - last[3])
    wrong = sum(abs(h[0] - h[2]) + abs(h[1] - h[3]) for h in known if h is not last)
    return "\n".join(old), "\n".join(new), missing, wrong


def _beginning(a: str, b: str) -> bool:
    """Whether ``a``, a replacement character at its end aside, is a strict beginning of ``b``."""
    a = a.rstrip("�")
    return len(a.rstrip("\n")) < len(b.rstrip("\n")) and b.startswith(a)


def judge(old: str | None, new: str | None, patch: str | None) -> list[tuple[str, list[int], bool, bool, bool, str, int, str | None]]:
    """For each value: (field, lengths, surely cut, surely whole, last hunk short, how it ends, a hash of it, its last word)."""
    removed, added, missing, wrong = patch_sides(patch) if patch else ("", "", 0, 0)
    has_hunk = bool(patch) and "@@" in patch
    out = []
    cut_patch = False
    for field, v, side in (("old_code", old, removed), ("new_code", new, added)):
        if not v:
            continue
        plain = v.replace("\r\n", "\n")
        broken = v.endswith("�")
        short = has_hunk and _beginning(plain, side)
        if has_hunk and _beginning(side, plain):
            cut_patch = True
        whole = has_hunk and plain.rstrip("\n") == side.rstrip("\n")
        out.append((field, lengths(v), short or broken, whole and not broken, False, *_end(v)))
    if patch:
        broken = patch.endswith("�")
        both = all(not v or v.replace("\r\n", "\n").rstrip("\n") == s.rstrip("\n") for v, s in ((old, removed), (new, added)))
        bare = not _HUNK.match(patch[max(0, patch.rfind("@@ -")) :]) if has_hunk else True
        out.append(("patch", lengths(patch), cut_patch or broken, both and not bare and not missing and not broken and has_hunk, bool(missing) and not wrong, *_end(patch)))
    return out


def _end(v: str) -> tuple[str, int, str | None]:
    last = _LAST.search(v, max(0, len(v) - 65))
    return ending(v), xxhash.xxh64_intdigest(v.encode("utf-8", "surrogatepass")) - (1 << 63), last[0] if last else None


def ending(v: str) -> str:
    """How a value ends: at a line end, in an open string, in a replacement character, in a word, or in closing or other punctuation."""
    if v.endswith("\n"):
        return "line end"
    c = v[-1]
    if _QUOTES.sub("", v[v.rfind("\n") + 1 :]).count('"') % 2:
        return "open string"
    return "broken character" if c == "�" else "word" if c.isalnum() or c == "_" else "closing" if c in ")]}>;.\"'`:?!" else "punctuation"


_FACTS = "chunk_id string, origin string, field string, lengths array<int>, cut boolean, whole boolean, short boolean, ending string, h bigint, last string"


def facts(chunks: DataFrame) -> DataFrame:
    """One row per value with text: what ``judge`` says of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in (big.slice(i, 500) for i in range(0, big.num_rows, 500)):
                rows = [(c, o, *x) for c, o, old, new, patch in zip(*(b.column(i).to_pylist() for i in range(5))) for x in judge(old, new, patch)]
                cols = list(zip(*rows)) if rows else [()] * 10
                types = (pa.string(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.bool_(), pa.bool_(), pa.bool_(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(cols, types)], names=["chunk_id", "origin", "field", "lengths", "cut", "whole", "short", "ending", "h", "last"])

    return spread(chunks.select("chunk_id", "origin", *FIELDS)).mapInArrow(run, _FACTS)


def storage_limits(found: DataFrame) -> DataFrame:
    """(origin, field, limits): the hidden limits of each origin and field that has some, the highest pile first, each with
    encoding, place of the encoding, limit, pile and odds (values in the pile to those expected at a length like it)."""
    names = F.array(*(F.lit(x) for x in ENCODINGS))
    different = found.select("origin", "field", "h", "lengths", (~F.col("ending").isin("line end", "closing")).alias("within"), "whole").distinct()
    each = different.select("origin", "field", "within", "whole", F.posexplode("lengths").alias("place", "length")).where(F.col("length") >= LEAST_LIMIT)
    counts = each.groupBy("origin", "field", "place", "length").agg(F.count("*").alias("n"), F.count_if("within").alias("within"), F.count_if("whole").alias("whole"))
    w = W.partitionBy("origin", "field", "place").orderBy("length")
    near = lambda lo, hi: F.coalesce(F.sum("n").over(w.rangeBetween(lo, hi)), F.lit(0))
    seen = counts.select("*", F.coalesce(F.sum("n").over(w.rowsBetween(1, W.unboundedFollowing)), F.lit(0)).alias("above"), near(-200, -SLACK_BELOW - 1).alias("before"), near(SLACK_ABOVE + 1, 200).alias("after"))
    usual = F.greatest(F.col("before") / (200.0 - SLACK_BELOW), F.col("after") / (200.0 - SLACK_ABOVE)) + 0.2
    raised = (F.col("n") >= TWICE * PILE) & (F.col("within") >= WITHIN * F.col("n"))
    piles = seen.withColumn("odds", F.col("n") / usual).where((F.col("n") >= PILE) & (F.col("odds") >= PEAK) & (F.col("whole") <= 0.5 * F.col("n")) & ((F.col("above") <= ABOVE * F.col("n")) | raised))
    piles = cut(piles.select("origin", "field", "place", F.col("length").alias("limit"), F.col("n").alias("pile"), "odds"))
    # each value counts for the highest pile it is in
    own = _beside(different, piles).where(F.get("lengths", F.col("place")) == F.col("limit")).groupBy("origin", "field", "h").agg(F.max_by(F.struct("place", "limit"), F.struct("pile", -F.col("place"))).alias("p"))
    held = own.groupBy("origin", "field", "p").agg(F.count("*").alias("own")).where(F.col("own") >= PILE).select("origin", "field", "p.place", "p.limit", "own")
    kept = _beside(piles, held.select("origin", "field", F.col("place").alias("p_"), F.col("limit").alias("l_"), "own")).where("place = p_ and limit = l_ and own >= 0.5 * pile")
    one = F.struct("pile", (-F.col("place")).alias("last"), "place", "limit", (F.col("odds") * F.col("own") / F.col("pile")).alias("odds"), F.get(names, F.col("place")).alias("encoding"))
    return kept.groupBy("origin", "field").agg(F.sort_array(F.collect_list(one), asc=False).alias("limits"))


def _beside(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on origin and field, null origins alike; each origin and field has few rows in ``b``."""
    b = b.withColumnsRenamed({"origin": "o_", "field": "f_"})
    return a.join(b, a["origin"].eqNullSafe(b["o_"]) & (a["field"] == b["f_"]), how).drop("o_", "f_")


def _known_words(chunks: DataFrame, found: DataFrame) -> DataFrame:
    """(last, begins): last words that stand nowhere else, and whether other words begin with them."""
    tails = found.where(F.length("last") >= BEGINNING).select("last").distinct()
    text = chunks.select(F.explode(F.array(*FIELDS)).alias("v")).where("v is not null")
    parts = F.split("v", r"[^\p{L}\p{N}_]+")
    words = cut(text.select(F.explode(F.array_distinct(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))).alias("w")).where(F.length("w").between(BEGINNING, 64)).distinct())
    new = cut(tails.join(words, F.col("last") == F.col("w"), "left_anti"))
    longer = words.where(F.length("w") > BEGINNING).select(F.explode(F.transform(F.sequence(F.lit(BEGINNING), F.length("w") - 1), lambda n: F.left("w", n))).alias("b"))
    begins = new.join(longer, F.col("last") == F.col("b"), "left_semi").select("last", F.lit(True).alias("begins"))
    return new.join(begins, "last", "left").select("last", F.coalesce("begins", F.lit(False)).alias("begins"))


def verdicts(chunks: DataFrame) -> DataFrame:
    """(chunk_id, origin, field, truncated, at_limit, ending, encoding, limit) of every value with text."""
    found = cut(facts(chunks))
    joined = _beside(found, storage_limits(found), "left").join(_known_words(chunks, found).withColumnRenamed("last", "l_"), F.col("last") == F.col("l_"), "left").drop("l_")
    over = lambda x: F.get("lengths", x["place"]) - x["limit"]
    met = F.get(F.filter("limits", lambda x: F.when(x["encoding"].endswith("utf8"), over(x).between(-SLACK_BELOW, SLACK_ABOVE)).otherwise(over(x) == 0)), F.lit(0))
    kind = F.when((F.col("ending") == "word") & F.col("begins"), "beginning of a word").when((F.col("ending") == "word") & ~F.col("begins"), "new word").otherwise(F.col("ending"))
    rows = cut(joined.withColumn("met", met).withColumn("ending", kind).withColumn("at_limit", F.col("met").isNotNull()).select("chunk_id", "origin", "field", "cut", "whole", "short", "ending", "at_limit", "met", F.get("limits", F.lit(0)).alias("first")))
    # how often a last hunk is short where nothing else is wrong, by origin; the origins with the lowest cut rate show how often headers are wrong
    plain = F.col("short") & ~F.col("cut") & ~F.col("at_limit")
    by = rows.groupBy("origin").agg(F.count_if(F.col("field") == "patch").alias("patches"), F.count_if(plain).alias("short_n"), F.count_if(F.col("cut") & ~F.col("at_limit")).alias("cuts"), F.count_if(~F.col("at_limit")).alias("judged"))
    by = cut(by.where("patches > 0").withColumn("rate", (F.col("cuts") + 1) / (F.col("judged") + 1)))
    lowest = by.agg(F.min("rate").alias("lowest"))
    wrong = by.crossJoin(F.broadcast(lowest)).where(F.col("rate") <= TIMES * F.col("lowest")).agg((F.sum("short_n") / F.sum("patches")).alias("usual"), F.first("lowest").alias("lowest"))
    more = (F.col("cuts") > TIMES * F.col("lowest") * F.col("judged")) & (F.col("short_n") > TIMES * F.col("usual") * F.col("patches"))
    trusted = by.crossJoin(F.broadcast(wrong)).where(more).select(F.col("origin").alias("o"), F.lit(True).alias("trust"))
    rows = rows.join(trusted, F.col("origin").eqNullSafe(F.col("o")), "left")
    # how values proven cut and whole end, and how many there are of either
    proven = rows.where("(cut or whole) and ending <> 'broken character'")
    ends = proven.groupBy("field", "ending").agg(F.count_if("cut").alias("c"), F.count_if(~F.col("cut")).alias("w"))
    sums = ends.groupBy("field").agg((F.sum("c") + 4).alias("cs"), (F.sum("w") + 4).alias("ws"))
    odds = ends.join(sums, "field").select(F.col("field").alias("f_"), F.col("ending").alias("e_"), ((F.col("c") + 0.5) / F.col("cs") / ((F.col("w") + 0.5) / F.col("ws"))).alias("likelier"))  # a few rows per field
    share = proven.groupBy(F.col("origin").alias("o_")).agg((F.count_if(F.col("cut") & ~F.col("at_limit")) / (F.count_if(~F.col("cut")) + 1)).alias("before"))
    rows = rows.join(F.broadcast(odds), (F.col("field") == F.col("f_")) & (F.col("ending") == F.col("e_")), "left").join(share, F.col("origin").eqNullSafe(F.col("o_")), "left")
    likelier = F.coalesce("likelier", F.lit(1.0))
    lost_at = F.col("at_limit") & (F.col("met.odds") * likelier >= 1)
    lost_by_end = ~F.col("at_limit") & ~F.col("short") & F.coalesce(F.col("before") * likelier > 1, F.lit(False))
    lost = F.col("cut") | (~F.col("whole") & (lost_at | lost_by_end)) | (F.col("short") & F.coalesce("trust", F.lit(False))) | (F.col("short") & F.col("at_limit"))
    return rows.select("chunk_id", "origin", "field", lost.alias("truncated"), "at_limit", "ending", F.coalesce("met.encoding", "first.encoding").alias("encoding"), F.coalesce("met.limit", "first.limit").alias("limit"))


def truncated_values(chunks: DataFrame) -> DataFrame:
    """(chunk_id, field) of every value whose end was lost."""
    return verdicts(chunks).where("truncated and chunk_id is not null").select("chunk_id", "field").distinct()


def truncation_report(chunks: DataFrame) -> DataFrame:
    """Per origin and field: values, truncated ones and their share, those at a storage limit, the largest limit, and how many there are."""
    return (
        verdicts(chunks)
        .groupBy("origin", "field")
        .agg(
            F.count("*").alias("n_values"),
            F.count_if("truncated").alias("n_truncated"),
            F.count_if(F.col("truncated") & F.col("at_limit")).alias("n_at_limit"),
            F.max_by("encoding", F.struct(F.col("at_limit"), "limit")).alias("encoding"),
            F.max_by("limit", F.struct(F.col("at_limit"), "limit")).alias("storage_limit"),
            F.count_distinct(F.when(F.col("at_limit"), F.struct("encoding", "limit"))).cast("int").alias("n_limits"),
        )
        .withColumn("share", F.col("n_truncated") / F.col("n_values"))
    )
