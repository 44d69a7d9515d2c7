"""Problem 8: encode a whole corpus with a public byte-level BPE vocabulary.

Pre-tokenisation works on arrays of codepoint classes instead of a regular expression.  The
splitting pattern of the byte-level vocabularies is a regular language whose transition functions
become constant maps after one symbol of lookbehind (and one of lookahead for white space), so the
associative scan over transition functions collapses into a single composition step: the table
``_START[previous, current, next]`` says whether a token starts at a position.  The only
exception, the English contractions, starts at an apostrophe that starts a token and is settled on
those few positions.  Slices of up to seven bytes are made distinct in bulk by a number that holds their
bytes and length, longer ones by their bytes themselves, so no two different slices are ever taken for one.
Only slices the worker does not hold go through pair merging; ids are then gathered for all slices at
once and handed to Arrow as offsets and values.  What a worker holds is bounded by ``CACHE_BYTES``.

Defined results: null and empty texts give an empty list; strings that look like special tokens are
ordinary text; texts of any length are encoded whole (cut internally only where the pattern always
starts a token); extra columns of the input are not touched.
"""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import spread

#: Folder of the public vocabularies; a parameter of every function here.
TOKENIZER_DIR = os.environ.get("TESSERA_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.tiktoken"

_LETTER, _NUMBER, _OTHER, _APOS, _SPACE, _WHITE, _END = range(7)
#: Codepoints per vectorised block; bounds the working memory of a worker.
BLOCK = 1 << 20
#: Bytes of slices and ids that a worker keeps, about; beyond it, it starts anew with the next block.  Results do not depend on it.
CACHE_BYTES = 64 << 20
_LONG = 96
#: Slices of up to so many bytes fit into one number with their length.
_SHORT = 7


def _starts(prev: int, cur: int, nxt: int) -> bool:
    """Whether a token starts at ``cur``, given the classes of its neighbours (contractions aside)."""
    if prev == _END:
        return True
    white = (_SPACE, _WHITE)
    word = {_LETTER: 0, _NUMBER: 1, _OTHER: 2, _APOS: 2}
    if cur in white:
        # a run of white space ends one before a following non-white character
        return prev not in white or (nxt not in white and nxt != _END)
    if prev == _SPACE:
        return False  # the blank belongs to this token and has started it
    if prev == _WHITE:
        return True
    return word[prev] != word[cur]


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(class of every codepoint, start flag by 49*prev + 7*cur + next), both built from rules."""
    import regex

    cls = np.full(0x110000, _OTHER, np.uint8)
    cps = [*range(0xD800), *range(0xE000, 0x110000)]
    text = "".join(map(chr, cps))
    where = np.array(cps)
    for pattern, value in ((r"\p{L}", _LETTER), (r"\p{N}", _NUMBER), (r"\s", _WHITE)):
        hits = np.array([m.start() for m in regex.finditer(pattern, text)])
        cls[where[hits]] = value
    cls[0x20], cls[0x27] = _SPACE, _APOS
    start = np.zeros(343, bool)
    for p in range(7):
        for c in range(6):
            for n in range(7):
                start[49 * p + 7 * c + n] = _starts(p, c, n)
    return cls, start


@lru_cache(4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: one base64 piece and its id per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Byte-pair merging of one slice: always the adjacent pair of lowest rank, leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) > _LONG:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pair = [ranks.get(parts[i] + parts[i + 1], 1 << 30) for i in range(len(parts) - 1)]
    while pair:
        low = min(pair)
        if low == 1 << 30:
            break
        i = pair.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = ranks.get(parts[i] + parts[i + 1], 1 << 30)
        if i:
            pair[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 30)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merging in O(n log n) with a heap over a linked list, for very long slices."""
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        j = nxt[i]
        if parts[i] is None or j >= n or parts[i] + parts[j] != both:
            continue
        parts[i], parts[j] = both, None
        nxt[i] = k = nxt[j]
        if k < n:
            prv[k] = i
            if (r := ranks.get(both + parts[k])) is not None:
                heapq.heappush(heap, (r, i, both + parts[k]))
        if (h := prv[i]) >= 0 and (r := ranks.get(parts[h] + both)) is not None:
            heapq.heappush(heap, (r, h, parts[h] + both))
    return [ranks[p] for p in parts if p is not None]


class Encoder:
    """Encoder of one worker; keeps the ids of every distinct slice it has merged."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        self.ranks = load_ranks(path)
        self.cls, self.start = _tables()
        self.limit = cache_bytes
        self._clear()

    def _clear(self) -> None:
        self.known: dict[int | bytes, int] = {}  # by the bytes of a slice, as a number if it is short
        self.first: list[int] = []  # of each known slice: place in pool, and number of ids
        self.count: list[int] = []
        self.pool: list[int] = []
        self.held = 0
        self._np: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def boundaries(self, cps: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Positions in ``cps`` where tokens start; ``ends``: the exclusive end of each text, ascending."""
        n = len(cps)
        sym = np.empty(n + 2, np.int16)
        sym[0] = sym[-1] = _END
        sym[1:-1] = self.cls[cps]
        nxt, prv = sym[2:].copy(), sym[:-2].copy()
        inner = ends[(ends > 0) & (ends < n)]
        prv[inner] = _END
        nxt[inner - 1] = _END
        flag = self.start[49 * prv + 7 * sym[1:-1] + nxt]
        quote = np.flatnonzero((cps == 0x27) & flag)
        if len(quote):
            stop = ends[np.searchsorted(ends, quote, "right")]
            padded = np.concatenate([cps, np.zeros(3, cps.dtype)])
            a, b = padded[quote + 1], padded[quote + 2]
            one = (quote + 1 < stop) & np.isin(a, [ord(c) for c in "stmd"])
            two = (quote + 2 < stop) & (((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
            for at, length in ((quote[one], 2), (quote[two & ~one], 3)):
                flag[at + 1] = False
                after = at + length
                after = after[after < n]
                letter = sym[1:-1][after] == _LETTER
                flag[after[letter]] = True
        return np.flatnonzero(flag)

    def _slot(self, key: int | bytes, piece: bytes) -> int:
        """Index into first/count of a slice, merging it if it is not held."""
        at = self.known.get(key)
        if at is None:
            ids = merge_piece(piece, self.ranks)
            at = self.known[key] = len(self.first)
            self.first.append(len(self.pool))
            self.count.append(len(ids))
            self.pool.extend(ids)
            self.held += 200 + len(piece) + 36 * len(ids)
            self._np = None
        return at

    def _slots(self, raw: bytes, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Index into first/count of every slice."""
        if self.held > self.limit:
            self._clear()
        size = stops - starts
        out = np.empty(len(starts), np.int64)
        short = size <= _SHORT
        at, n = starts[short], size[short].astype(np.uint64)
        words = np.ndarray((len(raw),), "<u8", raw + bytes(8), strides=(1,))[at]
        bits = np.uint64(8) * n
        key = (words & ((np.uint64(1) << bits) - np.uint64(1))) | (n << np.uint64(56))
        codes, distinct = pd.factorize(key)
        slots = np.array([self._slot(k, (k & (1 << 56) - 1).to_bytes(8, "little")[: k >> 56]) for k in distinct.tolist()], np.int64)
        out[short] = slots[codes]
        out[~short] = [self._slot(piece, piece) for piece in (raw[a:b] for a, b in zip(starts[~short].tolist(), stops[~short].tolist()))]
        return out

    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self._np is None:
            self._np = (np.array(self.first, np.int64), np.array(self.count, np.int64), np.array(self.pool, np.int32))
        return self._np

    def encode_block(self, raw: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, byte offset of each slice's start repeated per id, number of ids of each text) of
        concatenated texts; ``ends``: the byte end of each."""
        if not raw:
            return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
        data = np.frombuffer(raw, np.uint8)
        cps = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        if len(cps) == len(data):
            lead = None
            starts = self.boundaries(cps, np.unique(ends[ends > 0]))
        else:
            lead = np.flatnonzero((data & 0xC0) != 0x80)
            starts = lead[self.boundaries(cps, np.unique(np.searchsorted(lead, ends[ends > 0])))]
        stops = np.append(starts[1:], len(data))
        slot = self._slots(raw, starts, stops)
        first, count, pool = self._arrays()
        n = count[slot]
        total = np.cumsum(n)
        place = np.arange(total[-1]) - np.repeat(total - n, n) + np.repeat(first[slot], n)
        upto = np.concatenate([[0], total])[np.searchsorted(starts, ends)]
        return pool[place], np.repeat(starts, n), np.diff(upto, prepend=0)

    def encode_batch(self, texts: pa.Array, counts_only: bool = False) -> pa.Array:
        """List array of ids of each text, or their numbers; in blocks of bounded size."""
        texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
        raw_offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        size = np.diff(raw_offsets)
        if texts.null_count:
            size = np.where(np.asarray(texts.is_valid()), size, 0)
        body = memoryview(texts.buffers()[2]) if len(texts) and texts.buffers()[2] is not None else memoryview(b"")
        ids: list[np.ndarray] = []
        counts = np.zeros(len(texts), np.int64)
        i = 0
        while i < len(texts):
            j = i + max(1, int(np.searchsorted(np.cumsum(size[i:]), BLOCK, "right")))
            if j == i + 1 and size[i] > BLOCK:
                for piece in _safe_cuts(bytes(body[raw_offsets[i] : raw_offsets[i] + size[i]])):
                    got, _, n = self.encode_block(piece, np.array([len(piece)]))
                    ids.append(got)
                    counts[i] += n[0]
            else:
                parts = [body[raw_offsets[k] : raw_offsets[k] + size[k]] for k in range(i, j) if size[k]]
                got, _, n = self.encode_block(b"".join(parts), np.cumsum(size[i:j]))
                ids.append(got)
                counts[i:j] = n
            i = j
        if counts_only:
            return pa.array(counts.astype(np.int32))
        values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        if offsets[-1] < 2**31:
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, pa.int32()))
        return pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _safe_cuts(raw: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """Pieces of one long text, cut only where a blank follows a letter or digit: a token always starts there."""
    at = 0
    while len(raw) - at > size:
        cut = at + size
        while cut < len(raw) and not (raw[cut : cut + 1] == b" " and raw[cut - 1 : cut].isalnum()):
            cut += 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


@lru_cache(4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path(directory: str | None = None, name: str = VOCABULARY) -> str:
    return os.path.join(directory or TOKENIZER_DIR, name)


def encode_corpus(docs: DataFrame, id_col: str, text_col: str, path: str | None = None) -> DataFrame:
    """(id, ids array<int>) of each row; narrow, no shuffle besides spreading a single-file input."""
    path = path or vocabulary_path()
    schema = docs.select(F.col(id_col)).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            for at in range(0, max(1, b.num_rows), 2000):
                part = b.slice(at, 2000)
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([part.column(0), enc.encode_batch(part.column(1))], names=[id_col, "ids"])

    return spread(docs.select(id_col, text_col)).mapInArrow(run, schema)


def token_counts(docs: DataFrame, id_cols: list[str], text_col: str, path: str | None = None) -> DataFrame:
    """``id_cols`` and n_tokens (int, 0 for null and empty texts) by the same encoder."""
    path = path or vocabulary_path()
    schema = docs.select(*id_cols).schema.add("n_tokens", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(id_cols))), enc.encode_batch(b.column(len(id_cols)), True)], names=[*id_cols, "n_tokens"])

    return spread(docs.select(*id_cols, text_col)).mapInArrow(run, schema)


def decode(ids: list[int], path: str | None = None) -> str:
    """Text of a list of ids (the inverse of encoding)."""
    back = _pieces(path or vocabulary_path())
    return b"".join(back[i] for i in ids).decode("utf-8")


@lru_cache(2)
def _pieces(path: str) -> dict[int, bytes]:
    return {v: k for k, v in load_ranks(path).items()}
