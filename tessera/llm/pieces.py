"""Problem 5: cut oversized values into pieces under a limit, at natural boundaries, with an overlap.

A value is read as a tree: a patch consists of file sections, these of hunks, hunks of blocks (runs of lines of one kind
and what blank lines or headings part), blocks of lines, lines of words; a token list of paragraphs and lines.  Packing works
bottom-up: neighbouring subtrees are merged as long as they fit, and only a node that is too large itself is
descended into; a word or line of more than the limit is cut hard.  Every piece but the first also repeats the
``overlap`` characters or tokens before it, from ``context_overlap_start``; with them it stays within the limit.

Pieces tile the value: ``start`` to ``end`` of consecutive pieces join without gap, so the value can be put together again.

Defined results: null and empty values and values within the limit give no piece; padding (token 0) at the end
of a context is left out first and null tokens are read as 0; row ids may be null; repeated rows are cut each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ragged import list_parts
from tessera.session import spread

PATCH_LIMIT, PATCH_OVERLAP = 4_000, 200
CONTEXT_LIMIT, CONTEXT_OVERLAP = 512, 64
LINE_END = 5

_SECTION = re.compile(r"^(?:diff --git |Index: )", re.M)
_SECTION_BARE = re.compile(r"^--- [^\n]*\n\+\+\+ ", re.M)
_HUNK = re.compile(r"^@@", re.M)
_WORD = re.compile(r"\s+|(?<=[,;(){}\[\]])")


def _blocks(text: str, lo: int, hi: int) -> list[int]:
    """Starts of blocks: where the kind of line changes, after a blank line, and at headings."""
    cuts, at, before = [], lo, None
    while at < hi:
        end = text.find("\n", at, hi)
        nxt = hi if end < 0 else end + 1
        first = text[at : at + 1]
        body = text[at + (first in "+- ") : nxt].strip()
        kind = first if first in "+-@\\" else " "
        if before is not None and (kind != before[0] or (before[1] and body) or body.startswith("# ")):
            cuts.append(at)
        before = (kind, not body)
        at = nxt
    return cuts


def _lines(text: str, lo: int, hi: int) -> list[int]:
    cuts, at = [], text.find("\n", lo, hi)
    while 0 <= at < hi - 1:
        cuts.append(at + 1)
        at = text.find("\n", at + 1, hi)
    return cuts


def _cuts(text: str, lo: int, hi: int, level: int) -> list[int]:
    """Starts of the children of a node that begins at ``lo``, without its own."""
    if level == 0:
        got = [m.start() for m in _SECTION.finditer(text, lo, hi)] or [m.start() for m in _SECTION_BARE.finditer(text, lo, hi)]
    elif level == 1:
        got = [m.start() for m in _HUNK.finditer(text, lo, hi)]
    elif level == 2:
        got = _blocks(text, lo, hi)
    elif level == 3:
        got = _lines(text, lo, hi)
    else:
        got = [m.end() for m in _WORD.finditer(text, lo, hi)]
    return [c for c in got if lo < c < hi]


def pack_spans(cuts_of, lo: int, hi: int, limit: int, level: int, levels: int) -> list[tuple[int, int]]:
    """Spans of at most ``limit`` that tile a node; ``cuts_of(lo, hi, level)`` gives where its children start."""
    if hi - lo <= limit:
        return [(lo, hi)]
    while level < levels:
        cuts = cuts_of(lo, hi, level)
        level += 1
        if len(cuts):
            break
    else:
        return [(a, min(a + limit, hi)) for a in range(lo, hi, limit)]
    out: list[tuple[int, int]] = []
    for a, b in zip([lo, *cuts], [*cuts, hi]):
        for x, y in [(a, b)] if b - a <= limit else pack_spans(cuts_of, a, b, limit, level, levels):
            if out and y - out[-1][0] <= limit:
                out[-1] = (out[-1][0], y)
            else:
                out.append((x, y))
    return out


def _checked(limit: int, overlap: int) -> int:
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be smaller than the limit")
    return limit - overlap


def split_text(text: str, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, overlap start) of the pieces of a patch or other text."""
    room = _checked(limit, overlap)
    spans = pack_spans(lambda lo, hi, level: _cuts(text, lo, hi, level), 0, len(text), room, 0, 5)
    return [(a, b, max(0, a - overlap)) for a, b in spans]


def split_tokens(tokens: np.ndarray, limit: int, overlap: int, line_end: int = LINE_END) -> list[tuple[int, int, int]]:
    """(start, end, overlap start) of the pieces of a token list: blank lines, then line ends, then anywhere."""
    room = _checked(limit, overlap)
    ends = np.flatnonzero(tokens == line_end) + 1
    blank = ends[1:][np.diff(ends) == 1] if len(ends) > 1 else ends[:0]

    def cuts(lo: int, hi: int, level: int) -> list[int]:
        at = blank if level == 0 else ends
        return at[np.searchsorted(at, lo, "right") : np.searchsorted(at, hi)].tolist()

    return [(a, b, max(0, a - overlap)) for a, b in pack_spans(cuts, 0, len(tokens), room, 0, 2)]


_PLACES = "piece_no int, n_pieces int, start int, end int, context_overlap_start int"


def patch_pieces(chunks: DataFrame, limit: int = PATCH_LIMIT, overlap: int = PATCH_OVERLAP) -> DataFrame:
    """Pieces of every patch of more than ``limit`` characters."""
    _checked(limit, overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in (big.slice(i, 200) for i in range(0, big.num_rows, 200)):
                rows = []
                for row, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    got = split_text(text, limit, overlap)
                    rows += [(row, i, len(got), s, e, o, text[o:e]) for i, (s, e, o) in enumerate(got)]
                cols = list(zip(*rows)) if rows else [()] * 7
                types = (pa.string(), *[pa.int32()] * 5, pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=["row_id", "piece_no", "n_pieces", "start", "end", "context_overlap_start", "text"])

    return spread(chunks.select(F.col("chunk_id").cast("string").alias("row_id"), "patch")).where(F.length("patch") > limit).mapInArrow(run, f"row_id string, {_PLACES}, text string")


def context_pieces(examples: DataFrame, limit: int = CONTEXT_LIMIT, overlap: int = CONTEXT_OVERLAP, line_end: int = LINE_END) -> DataFrame:
    """Pieces of every context of more than ``limit`` tokens."""
    _checked(limit, overlap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in (big.slice(i, 500) for i in range(0, big.num_rows, 500)):
                values, lengths = list_parts(b.column(1))
                at = np.cumsum(lengths) - lengths
                rows, parts = [], []
                for row, a, n in zip(b.column(0).to_pylist(), at.tolist(), lengths.tolist()):
                    v = values[a : a + n]
                    used = np.flatnonzero(v)
                    v = v[: used[-1] + 1] if len(used) else v[:0]
                    if len(v) <= limit:
                        continue
                    got = split_tokens(v, limit, overlap, line_end)
                    rows += [(row, i, len(got), s, e, o) for i, (s, e, o) in enumerate(got)]
                    parts += [v[o:e] for _, e, o in got]
                cols = list(zip(*rows)) if rows else [()] * 6
                types = (pa.string(), *[pa.int32()] * 5)
                offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)))
                yield pa.RecordBatch.from_arrays([*(pa.array(x, t) for x, t in zip(cols, types)), tokens], names=["row_id", "piece_no", "n_pieces", "start", "end", "context_overlap_start", "tokens"])

    return spread(examples.select(F.col("example_id").cast("string").alias("row_id"), "context")).where(F.size("context") > limit).mapInArrow(run, f"row_id string, {_PLACES}, tokens array<int>")


def oversized_pieces(chunks: DataFrame, examples: DataFrame) -> DataFrame:
    """Pieces of both tables: field says which, text or tokens hold the piece."""
    a = patch_pieces(chunks).select(F.lit("patch").alias("field"), "*", F.lit(None).cast("array<int>").alias("tokens"))
    b = context_pieces(examples).select(F.lit("context").alias("field"), *[c for c in a.columns if c not in ("field", "text", "tokens")], F.lit(None).cast("string").alias("text"), "tokens")
    return a.unionByName(b)
