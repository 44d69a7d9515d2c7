"""Problem 4: evaluation records that also stand, exactly or almost, in the training split.

Two records are a pair if at most a tenth as many tokens as the longer one has must be edited.  Such
a pair leaves at most ``floor(n / 9)`` edits on an evaluation record of n tokens, so of its disjoint
passages of six tokens, any ``floor(n / 9) + 1`` contain one that is intact in the training record.
The rarest of its passages by a document-frequency sketch of bounded size are put into Aho-Corasick
automata.  The automata are sharded by an anchor, the rarest token of a passage; a training text is
cut at its own anchors and each cut is scanned by the one automaton that could match it, so all
training texts are scanned once, whatever the number of shards; cuts that hold a token no evaluation record has go nowhere.
Shards of anchors that many training cuts have are divided: the cuts among several automata by record, of which each
holds the passages.  Matches whose place and lengths
allow the pair are verified by exact edit distance.  Nothing is lost: rarity only chooses passages.

Exact copies are collapsed to one record of a class before the scan and expanded again at the end; ``overlap_classes`` and
``class_members`` give the same result without expanding, and the report needs no expanding either.

Defined results: token 0 and null items are padding, wherever they stand; a record without tokens
contains nothing and is in no pair; rows with null example_id or split, or another split, are no
evaluation or training rows; repeated example_ids count once; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.edit import within
from tessera.functions.ragged import binary_array, concat_lists, list_parts, take_ranges
from tessera.session import cut, spread

WIDTH = 6
SHORT = 12  # below this, passages are of four tokens, and below nine the whole record
SKETCH = 1 << 17  # counters of the document-frequency sketch, and of token frequencies
SHARD_PASSAGES = 60_000  # passages of one automaton
#: Rows up to which a list of ids (repeated records, candidates) is broadcast; beyond it, the join is shuffled.
BROADCAST_ROWS = 500_000

_PIECES = "shard int, side tinyint, block binary"
_BASE = 40
#: Largest token that has letters, in usual and wide form; larger ones of training texts match nothing.
_TOP = {False: _BASE**3 - 1, True: 0xFFFFFFFF}


def _records(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, tokens, lengths) of a batch of (example_id, context, target)."""
    values, lengths = concat_lists([list_parts(b.column(1)), list_parts(b.column(2))], drop=0)
    return np.asarray(b.column(0)), values, lengths


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
        x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _gram_hash(v: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    h = np.zeros(len(starts), np.uint64)
    for d in range(width):
        h = _mix(h + v[starts + d].astype(np.uint64) + np.uint64(d + 1))
    return h


def _passages(lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(record, start within it) of the disjoint passages of each record."""
    m = lengths // width
    row = np.repeat(np.arange(len(lengths)), m)
    return row, (take_ranges(np.zeros(len(m), np.int64), m)) * width


def _statistics(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Of the evaluation side: passage sketch, token counts by bucket, largest token, passages to search."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, tokens, top, wanted = np.zeros(SKETCH, np.int64), np.zeros(SKETCH, np.int64), 0, 0
        for b in batches:
            _, v, lengths = _records(b)
            if not len(v):
                continue
            at = np.cumsum(lengths) - lengths
            row, start = _passages(lengths, WIDTH)
            h = _gram_hash(v, at[row] + start, WIDTH)
            sketch += np.bincount((h % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
            tokens += np.bincount(v % SKETCH, minlength=SKETCH)
            top = max(top, int(v.max()))
            wanted += int((lengths // 9 + 1).sum())
        for kind, counts in ((0, sketch), (1, tokens)):
            k = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int8)), pa.array(k), pa.array(counts[k])], names=["kind", "k", "c"])
        yield pa.RecordBatch.from_arrays([pa.array(np.array([2, 3], np.int8)), pa.array(np.zeros(2, np.int64)), pa.array(np.array([top, wanted]))], names=["kind", "k", "c"])

    got = (
        rows.mapInArrow(run, "kind tinyint, k bigint, c bigint")
        .groupBy("kind", "k")
        .agg(F.when(F.col("kind") == 2, F.max("c")).otherwise(F.sum("c")).alias("c"))
        .toPandas()
    )
    sketch, tokens = np.zeros(SKETCH, np.int64), np.zeros(SKETCH, np.int64)
    for kind, to in ((0, sketch), (1, tokens)):
        part = got[got.kind == kind]
        to[part.k.to_numpy()] = part.c.to_numpy()
    one = {int(k): int(c) for k, c in zip(got.kind, got.c) if k >= 2}
    return sketch, tokens, one.get(2, 0), one.get(3, 0)


def _order(tokens: np.ndarray) -> np.ndarray:
    """Sort key of each token bucket: rare first, ties in mixed order; 28 bits."""
    scale = np.minimum(np.log2(tokens + 1).astype(np.int64), 40)
    return (scale << 20) | (_mix(np.arange(SKETCH)) & np.uint64(0xFFFFF)).astype(np.int64)


def _seen(order: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether buckets hold a token of the evaluation side, by their sort keys."""
    return order[key] >= 1 << 20


def _splits(load: np.ndarray, shards: int) -> np.ndarray:
    """Among how many shards the cuts of each token bucket as anchor are divided, so that none has much more than its share."""
    return np.clip(-(-load * shards // max(1, int(load.sum()))), 1, shards).astype(np.int64)


def _anchor_load(rows: DataFrame, order, least: int) -> np.ndarray:
    """Tokens of the cuts of the training side by the bucket of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(SKETCH, np.int64)
        for big in batches:
            for b in (big.slice(i, 2000) for i in range(0, big.num_rows, 2000)):
                _, v, lengths = _records(b)
                if len(v):
                    _, _, size, anchor = _anchored(v, lengths, order.value, least)
                    load += np.bincount(anchor % SKETCH, size, SKETCH).astype(np.int64)
        k = np.flatnonzero(load)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(load[k])], names=["k", "c"])

    got = rows.mapInArrow(run, "k bigint, c bigint").groupBy("k").agg(F.sum("c").alias("c")).toPandas()  # at most SKETCH rows
    load = np.zeros(SKETCH, np.int64)
    load[got.k.to_numpy(np.int64)] = got.c.to_numpy(np.int64)
    return load


def _pack(ids: np.ndarray, lengths: np.ndarray, v: np.ndarray, row: np.ndarray, start: np.ndarray, size: np.ndarray, shard: np.ndarray, side: int, wide: bool) -> pa.RecordBatch:
    """One output row for each shard of a batch, with the pieces of all its records in one block:
    numbers of records, pieces and tokens; ids, lengths and pieces of records; starts of pieces; tokens, a 0 after each piece."""
    order = np.lexsort((start, row, shard))
    row, start, size, shard = row[order], start[order], size[order], shard[order]
    at = np.cumsum(lengths) - lengths
    upto = np.concatenate([[0], np.cumsum(size + 1)])
    tokens = np.zeros(int(upto[-1]), np.int64)
    tokens[take_ranges(upto[:-1], size)] = v[take_ranges(at[row] + start, size)]
    tokens = np.minimum(tokens, _TOP[wide]).astype("<u4" if wide else "<u2")
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    blocks = []
    for lo, hi in zip(cuts, np.append(cuts[1:], len(shard))):
        r = row[lo:hi]
        first = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        pieces = np.diff(np.append(first, hi - lo))
        t = tokens[upto[lo] : upto[hi]]
        head = np.array([len(first), hi - lo, len(t)], "<i4")
        blocks.append(b"".join(x.tobytes() for x in (head, ids[r[first]].astype("<i8"), lengths[r[first]].astype("<i4"), pieces.astype("<i4"), start[lo:hi].astype("<i4"), t)))
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts].astype(np.int32)), pa.array(np.full(len(cuts), side, np.int8)), pa.array(blocks, pa.binary())], names=["shard", "side", "block"])


def _unpack(block: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lengths, pieces, starts, tokens) of a block."""
    g, p, t = np.frombuffer(block, "<i4", 3).tolist()
    out, at = [], 12
    for dtype, n in (("<i8", g), ("<i4", g), ("<i4", g), ("<i4", p), ("<u4" if wide else "<u2", t)):
        a = np.frombuffer(block, dtype, n, at)
        at += a.nbytes
        out.append(a.astype(np.int64))
    return tuple(out)


def _short_pieces(lengths: np.ndarray, evaluation: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(record, start, size) for records too short for passages of the usual width."""
    rows, starts, sizes = [], [], []
    for i in np.flatnonzero((lengths > 0) & (lengths < SHORT + 2)).tolist():
        n = int(lengths[i])
        if n < 9:
            rows.append(i), starts.append(0), sizes.append(n)
        if (9 <= n < SHORT) if evaluation else n >= 8:
            for s in range(0, n - 3, 4 if evaluation else 1):
                rows.append(i), starts.append(s), sizes.append(4)
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(sizes, np.int64)


def _gram_shards(v: np.ndarray, first: np.ndarray, size: np.ndarray, shards: int) -> np.ndarray:
    """Shard of short pieces, by all their tokens."""
    out = np.zeros(len(first), np.int64)
    for s in np.unique(size).tolist():
        k = size == s
        out[k] = (_gram_hash(v, first[k], s) % np.uint64(shards)).astype(np.int64)
    return out


def _evaluation_pieces(rows: DataFrame, sketch, order, splits, shards: int, wide: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rank = sketch.value, order.value
        for b in batches:
            ids, v, lengths = _records(b)
            if not len(v):
                continue
            at = np.cumsum(lengths) - lengths
            row, start = _passages(np.where(lengths >= SHORT, lengths, 0), WIDTH)
            h = _gram_hash(v, at[row] + start, WIDTH)
            seen = df[(h % np.uint64(SKETCH)).astype(np.int64)]
            by = np.lexsort((start, seen, row))
            place = np.empty(len(by), np.int64)
            count = np.bincount(row, minlength=len(lengths))
            place[by] = np.arange(len(by)) - np.repeat(np.cumsum(count) - count, count)
            keep = place <= lengths[row] // 9
            row, start = row[keep], start[keep]
            first = at[row] + start
            best = np.min([(rank[v[first + d] % SKETCH] << 3) | d for d in range(WIDTH)], axis=0) if len(first) else np.zeros(0, np.int64)
            anchor = v[first + (best & 7)]
            copies, shard = _copied(anchor, splits.value, shards)
            row, start = row[copies], start[copies]
            r2, s2, z2 = _short_pieces(lengths, True)
            yield _pack(
                ids, lengths, v, np.concatenate([row, r2]), np.concatenate([start, s2]), np.concatenate([np.full(len(row), WIDTH), z2]),
                np.concatenate([shard, _gram_shards(v, at[r2] + s2, z2, shards)]), 0, wide,
            )

    return rows.mapInArrow(run, _PIECES)


def _copied(anchor: np.ndarray, splits: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, shard) of evaluation pieces: one for each shard that their anchor is divided among."""
    n = splits[anchor % SKETCH]
    piece = np.repeat(np.arange(len(anchor)), n)
    return piece, ((_mix(anchor) % np.uint64(shards)).astype(np.int64)[piece] + take_ranges(np.zeros(len(n), np.int64), n)) % shards


def _dealt(anchor: np.ndarray, ids: np.ndarray, splits: np.ndarray, shards: int) -> np.ndarray:
    """Shard of training pieces: one of those that their anchor is divided among, by record."""
    j = (_mix(ids.astype(np.int64)) % splits[anchor % SKETCH].astype(np.uint64)).astype(np.int64)
    return ((_mix(anchor) % np.uint64(shards)).astype(np.int64) + j) % shards


def _anchored(v: np.ndarray, lengths: np.ndarray, rank: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(record, start, size, anchor) of the cuts, at their anchors, of the records of ``least`` tokens or more;
    cuts around a token that no evaluation record has are left out."""
    at = np.cumsum(lengths) - lengths
    windows = np.where(lengths >= least, lengths - WIDTH + 1, 0)
    row = np.repeat(np.arange(len(lengths)), windows)
    first = take_ranges(at, windows)
    key = rank[v % SKETCH] << 3
    best = key[first]
    for d in range(1, WIDTH):
        np.minimum(best, key[first + d] | d, out=best)
    anchor = first + (best & 7)
    new = np.ones(len(row), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    run_at = np.flatnonzero(new)
    count = np.diff(np.append(run_at, len(row)))
    known = _seen(rank, v[anchor[run_at]] % SKETCH)
    run_at, count = run_at[known], count[known]
    return row[run_at], first[run_at] - at[row[run_at]], count + WIDTH - 1, v[anchor[run_at]]


def _training_pieces(rows: DataFrame, order, splits, shards: int, wide: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = order.value
        for big in batches:
            for b in (big.slice(i, 2000) for i in range(0, big.num_rows, 2000)):
                ids, v, lengths = _records(b)
                if not len(v):
                    continue
                at = np.cumsum(lengths) - lengths
                row, start, size, anchor = _anchored(v, lengths, rank, 10)
                shard = _dealt(anchor, ids[row], splits.value, shards)
                r2, s2, z2 = _short_pieces(lengths, False)
                yield _pack(
                    ids, lengths, v, np.concatenate([row, r2]), np.concatenate([start, s2]),
                    np.concatenate([size, z2]), np.concatenate([shard, _gram_shards(v, at[r2] + s2, z2, shards)]), 1, wide,
                )

    return rows.mapInArrow(run, _PIECES)


def _letters(tokens: np.ndarray, wide: bool) -> str:
    """Tokens as text: each is a fixed number of digits to base 40, every place with an alphabet of
    its own, so that a node has at most 40 children and no match can start inside a token; 0 is 0."""
    places = 6 if wide else 3
    out = np.empty((len(tokens), places), np.uint8)
    rest = tokens
    for k in range(places - 1, -1, -1):
        rest, digit = np.divmod(rest, _BASE)
        out[:, k] = digit + 1 + _BASE * k
    out[tokens == 0] = 0
    return out.tobytes().decode("latin-1")


class _Shard:
    """Automaton over the evaluation passages of one shard, and where each passage stands."""

    def __init__(self, wide: bool):
        self.wide, self.places = wide, 6 if wide else 3
        self.where: dict[str, list[tuple[int, int, int]]] = {}
        self.automaton = None

    def add(self, block: bytes) -> None:
        ids, n, pieces, starts, tokens = _unpack(block, self.wide)
        words = _letters(tokens, self.wide).split("\0" * self.places)
        for word, i, s, m in zip(words, np.repeat(ids, pieces).tolist(), starts.tolist(), np.repeat(n, pieces).tolist()):
            self.where.setdefault(word, []).append((i, s, m))

    def build(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        post: list[tuple[int, int, int]] = []
        self.first, self.count, self.size = [], [], []
        for k, (word, places) in enumerate(self.where.items()):
            self.automaton.add_word(word, k)
            self.first.append(len(post)), self.count.append(len(places)), self.size.append(len(word) // self.places)
            post += places
        self.first, self.count, self.size = (np.array(x, np.int64) for x in (self.first, self.count, self.size))
        self.post = np.array(post, np.int64).reshape(-1, 3)
        self.where = {}
        if len(self.first):
            self.automaton.make_automaton()

    def scan(self, block: bytes) -> Iterator[np.ndarray]:
        """(evaluation id, training id, place and size in the evaluation record) of matches that allow a pair."""
        if self.automaton is None:
            self.build()
        if not len(self.first):
            return
        ids, n, pieces, starts, tokens = _unpack(block, self.wide)
        hits = list(self.automaton.iter(_letters(tokens, self.wide)))
        if not hits:
            return
        end, word = np.array(hits, np.int64).T
        end = end // self.places
        stop = np.flatnonzero(tokens == 0)
        begin = np.concatenate([[0], stop[:-1] + 1])
        piece = np.searchsorted(stop, end)
        place = starts[piece] + end - self.size[word] + 1 - begin[piece]
        record = np.repeat(np.arange(len(ids)), pieces)[piece]
        upto = np.concatenate([[0], np.cumsum(self.count[word])])
        lo = 0
        while lo < len(word):  # matches of bounded number at a time
            hi = max(lo + 1, int(np.searchsorted(upto, upto[lo] + 500_000, "right")) - 1)
            w, p, r = word[lo:hi], place[lo:hi], record[lo:hi]
            lo = hi
            x = self.post[take_ranges(self.first[w], self.count[w])]
            p, r, size = np.repeat(p, self.count[w]), np.repeat(r, self.count[w]), np.repeat(self.size[w], self.count[w])
            m = n[r]
            shift = np.abs(x[:, 1] - p) + np.abs((m - p) - (x[:, 2] - x[:, 1]))
            ok = shift <= np.maximum(m, x[:, 2]) // 10
            yield np.stack([x[ok, 0], ids[r[ok]], x[ok, 1], size[ok]], 1)


def _matches(pieces: DataFrame, wide: bool) -> DataFrame:
    """(x, e, place, size): passages of evaluation records x found in training records e."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard = None, None
        for b in batches:
            for s, side, block in zip(*(b.column(i).to_pylist() for i in range(3))):
                if s != now:
                    now, shard = s, _Shard(wide)
                if side == 0:
                    shard.add(block)
                    continue
                for m in shard.scan(block):
                    if len(m):
                        m = np.unique(m, axis=0)
                        yield pa.RecordBatch.from_arrays([pa.array(m[:, 0]), pa.array(m[:, 1]), pa.array(m[:, 2].astype(np.int32)), pa.array(m[:, 3].astype(np.int32))], names=["x", "e", "place", "size"])

    return pieces.mapInArrow(run, "x bigint, e bigint, place int, size int")


def _verify(pairs: DataFrame) -> DataFrame:
    """(x, e, copy columns of both) -> those within a tenth of the longer record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for i, (p, q) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
                keep.append(p == q or within(np.frombuffer(p, "<i4").tolist(), np.frombuffer(q, "<i4").tolist(), max(len(p), len(q)) // 4 // 10))
            k = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(k), b.column(1).filter(k)], names=["x", "e"])

    return pairs.mapInArrow(run, "x bigint, e bigint")


def _compact(rows: DataFrame) -> DataFrame:
    """(id, seq): the tokens of each record without padding, four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, v, lengths = _records(b)
            yield pa.RecordBatch.from_arrays([pa.array(ids), binary_array(v.astype("<i4").tobytes(), 4 * lengths)], names=["id", "seq"])

    return rows.mapInArrow(run, "id bigint, seq binary")


class Overlap:
    """The stages of the search over one table of examples."""

    def __init__(self, examples: DataFrame):
        self.spark = examples.sparkSession
        base = spread(examples.select("example_id", "context", "target", F.lower(F.trim("split")).alias("split")).where("example_id is not null and split in ('train', 'val', 'test')"))
        self.base = base
        seq = F.filter(F.concat(F.coalesce("context", F.array().cast("array<int>")), F.coalesce("target", F.array().cast("array<int>"))), lambda t: t.isNotNull() & (t != 0))
        keys = base.select("example_id", (F.col("split") == "train").alias("train"), F.xxhash64(seq).alias("k1"), F.hash(F.reverse(seq), F.size(seq)).alias("k2"))
        classes = keys.groupBy("train", "k1", "k2").agg(F.min("example_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
        #: (example_id, rep) of records that repeat an earlier one of their side
        self.copies = cut(keys.join(classes.drop("n"), ["train", "k1", "k2"]).select("example_id", "rep", "train").distinct())
        again = self.copies.where("example_id <> rep").select("example_id")
        n = again.count()
        self.many = n > BROADCAST_ROWS
        self.rows = base if n == 0 else base.join(again if self.many else F.broadcast(again), "example_id", "left_anti")
        self.evaluation = self.rows.where("split <> 'train'").select("example_id", "context", "target")
        self.training = self.rows.where("split = 'train'").select("example_id", "context", "target")

    def matches(self) -> DataFrame:
        sketch, tokens, top, wanted = _statistics(self.evaluation)
        sc = self.spark.sparkContext
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        shards = max(parts, -(-wanted // SHARD_PASSAGES))
        wide = top > _TOP[False]
        sk, order = sc.broadcast(sketch), sc.broadcast(_order(tokens))
        splits = sc.broadcast(_splits(_anchor_load(self.training, order, 10), shards))
        pieces = _evaluation_pieces(self.evaluation, sk, order, splits, shards, wide).unionAll(_training_pieces(self.training, order, splits, shards, wide))
        # whole shards to partitions in turn: an automaton must meet all pieces of its shard
        n = max(parts, -(-shards // 4))
        return _matches(pieces.repartitionById(n, F.col("shard") % F.lit(n)).sortWithinPartitions("shard", "side"), wide)

    def pairs(self, matches: DataFrame) -> DataFrame:
        """(x, e) of verified pairs between first records of classes of copies."""
        found = cut(matches.select("x", "e").distinct())
        ev, tr = self.evaluation, self.training
        if found.count() <= BROADCAST_ROWS:  # then only records with a candidate are moved
            ev = ev.join(F.broadcast(found.select(F.col("x").alias("example_id")).distinct()), "example_id", "left_semi")
            tr = tr.join(F.broadcast(found.select(F.col("e").alias("example_id")).distinct()), "example_id", "left_semi")
        ev = _compact(ev).select(F.col("id").alias("x"), F.col("seq").alias("p"))
        tr = _compact(tr).select(F.col("id").alias("e"), F.col("seq").alias("q"))
        return _verify(found.join(ev, "x").join(tr, "e").select("x", "e", "p", "q"))

    def expand(self, pairs: DataFrame) -> DataFrame:
        for side, train in (("x", False), ("e", True)):
            c = self.copies.where(F.col("train") == train).select(F.col("rep").alias(side), F.col("example_id").alias("m"))
            pairs = pairs.join(c, side, "left").withColumn(side, F.coalesce("m", side)).drop("m")
        return pairs


def cross_split_pairs(examples: DataFrame) -> DataFrame:
    """(example_a, example_b): every pair of a train row and a val or test row, smaller id first."""
    o = Overlap(examples)
    p = o.expand(o.pairs(o.matches()))
    return p.select(F.least("x", "e").alias("example_a"), F.greatest("x", "e").alias("example_b")).distinct()


def _narrow(n: np.ndarray) -> np.ndarray:
    """Tokens of a run that counts as covered, for evaluation records of n tokens."""
    return np.where(n < SHORT, np.minimum(n, 4), WIDTH)


def _narrow_sketch(rows: DataFrame) -> np.ndarray:
    """Whether a hash bucket holds a run of an evaluation record below ``SHORT``, by size of the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((WIDTH, SKETCH), bool)
        for b in batches:
            _, v, lengths = _records(b)
            at = np.cumsum(lengths) - lengths
            for s in range(1, 5):
                n = np.where((lengths > 0) & (lengths < SHORT) & (_narrow(lengths) == s), lengths - s + 1, 0)
                seen[s, (_gram_hash(v, take_ranges(at, n), s) % np.uint64(SKETCH)).astype(np.int64)] = True
        size, k = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(k)], names=["size", "k"])

    got = rows.mapInArrow(run, "size bigint, k bigint").distinct().toPandas()
    seen = np.zeros((WIDTH, SKETCH), bool)
    seen[got["size"].to_numpy(np.int64), got["k"].to_numpy(np.int64)] = True
    return seen


def _window_pieces(rows: DataFrame, order, narrow, splits, shards: int, wide: bool, side: int) -> DataFrame:
    """All windows of the records of one side: cuts at anchors, and the runs that short evaluation records need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = order.value, narrow.value
        for big in batches:
            for b in (big.slice(i, 2000) for i in range(0, big.num_rows, 2000)):
                ids, v, lengths = _records(b)
                if not len(v):
                    continue
                at = np.cumsum(lengths) - lengths
                row, start, size, anchor = _anchored(v, lengths, rank, WIDTH if side else SHORT)
                if side:
                    parts = [(row, start, size, _dealt(anchor, ids[row], splits.value, shards))]
                else:
                    copies, shard = _copied(anchor, splits.value, shards)
                    parts = [(row[copies], start[copies], size[copies], shard)]
                for s in range(1, 5):
                    if not seen[s].any():
                        continue
                    own = lengths >= s if side else (lengths > 0) & (lengths < SHORT) & (_narrow(lengths) == s)
                    n = np.where(own, lengths - s + 1, 0)
                    row, first = np.repeat(np.arange(len(lengths)), n), take_ranges(at, n)
                    h = _gram_hash(v, first, s)
                    k = seen[s, (h % np.uint64(SKETCH)).astype(np.int64)]
                    row, first, h = row[k], first[k], h[k]
                    parts.append((row, first - at[row], np.full(len(row), s), (h % np.uint64(shards)).astype(np.int64)))
                yield _pack(ids, lengths, v, *(np.concatenate([p[i] for p in parts]) for i in range(4)), side, wide)

    return rows.mapInArrow(run, _PIECES)


def _windows(block: bytes, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, id, place, size) of each window of a block."""
    ids, _, pieces, starts, tokens = _unpack(block, wide)
    stop = np.flatnonzero(tokens == 0)
    begin = np.concatenate([[0], stop[:-1] + 1])
    size, owner = stop - begin, np.repeat(ids, pieces)
    out = []
    for s in (1, 2, 3, 4, WIDTH):
        k = np.flatnonzero(size >= WIDTH if s == WIDTH else size == s)
        n = size[k] - s + 1
        first = take_ranges(begin[k], n)
        k = np.repeat(k, n)
        out.append((_mix(_gram_hash(tokens, first, s) + np.uint64(s)), owner[k], starts[k] + first - begin[k], np.full(len(k), s)))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(4))


def _merged(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, start, end) of the intervals of each group, touching ones as one."""
    order = np.lexsort((a, group))
    group, a, b = group[order], a[order], b[order]
    number = np.cumsum(np.append(False, group[1:] != group[:-1])[: len(group)]).astype(np.int64) << 32
    reach = np.maximum.accumulate(number + b)
    new = np.ones(len(group), bool)
    new[1:] = number[1:] + a[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(group))[: len(at)] - 1
    return group[at], a[at], reach[last] - number[last]


def _covered(pieces: DataFrame, wide: bool) -> DataFrame:
    """(x, a, b): intervals of evaluation records whose windows stand in a training text, by shard."""

    def intervals(own: list[tuple], found: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, x, place, size = own
        if found.any():
            x, a, b = _merged(x[found], place[found], place[found] + size[found])
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))], names=["x", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blocks, own = None, [], None
        for batch in batches:
            for s, side, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if s != now:
                    if own is not None:
                        yield from intervals(own, hit[which])
                    now, blocks, own = s, [], None
                if side == 0:
                    blocks.append(block)
                    continue
                if not blocks and own is None:
                    continue
                if own is None:
                    own = tuple(np.concatenate(x) for x in zip(*(_windows(x, wide) for x in blocks)))
                    blocks = []
                    keys, which = np.unique(own[0], return_inverse=True)
                    hit = np.zeros(len(keys), bool)
                h = _windows(block, wide)[0]
                if len(keys):
                    k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    hit[k[keys[k] == h]] = True
        if own is not None:
            yield from intervals(own, hit[which])

    return pieces.mapInArrow(run, "x bigint, a int, b int")


def coverage(examples: DataFrame) -> DataFrame:
    """Per evaluation record: its tokens that stand in training texts in runs of six or more, wherever they
    stand there, as merged intervals: number, covered tokens, longest.  Below twelve tokens runs of four count,
    and below four the whole record; records without such a run have no row.  Windows are compared by 64-bit hashes."""
    o = Overlap(examples)
    _, tokens, top, wanted = _statistics(o.evaluation)
    sc = o.spark.sparkContext
    parts = int(o.spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(parts, -(-wanted // SHARD_PASSAGES))
    wide = top >= _TOP[False]  # larger training tokens are stored as the top one, which must be no evaluation token
    order, narrow = sc.broadcast(_order(tokens)), sc.broadcast(_narrow_sketch(o.evaluation))
    splits = sc.broadcast(_splits(_anchor_load(o.training, order, WIDTH), shards))
    pieces = _window_pieces(o.evaluation, order, narrow, splits, shards, wide, 0).unionAll(_window_pieces(o.training, order, narrow, splits, shards, wide, 1))
    n = max(parts, -(-shards // 4))
    spans = _covered(pieces.repartitionById(n, F.col("shard") % F.lit(n)).sortWithinPartitions("shard", "side"), wide)
    lists = spans.groupBy("x").agg(F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row = np.repeat(np.arange(batch.num_rows), batch.column(1).value_lengths().to_numpy())
            row, a, b = _merged(row, *(batch.column(i).flatten().to_numpy().astype(np.int64) for i in (1, 2)))
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            size = (b - a).astype(np.int32)
            counts = [np.diff(np.append(first, len(row))).astype(np.int32), np.add.reduceat(size, first).astype(np.int32), np.maximum.reduceat(size, first)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, counts)], names=["x", "intervals", "covered_tokens", "longest"])

    out = lists.select("x", "a", "b").mapInArrow(run, "x bigint, intervals int, covered_tokens int, longest int")
    members = o.copies.where("not train").select(F.col("rep").alias("x"), "example_id")
    return out.join(members, "x", "left").select(F.coalesce("example_id", "x").alias("example_id"), "intervals", "covered_tokens", "longest")


def _sized(o: Overlap, pairs: DataFrame) -> DataFrame:
    """(x, e, n_x, n_e): pairs between first records of classes, and how many records each class has."""
    for side, train in (("x", False), ("e", True)):
        n = o.copies.where(F.col("train") == train).groupBy("rep").agg(F.count("*").alias("n")).select(F.col("rep").alias(side), F.col("n").alias(f"n_{side}"))
        pairs = pairs.join(n, side, "left").withColumn(f"n_{side}", F.coalesce(f"n_{side}", F.lit(1)))
    return pairs


def overlap_classes(examples: DataFrame) -> DataFrame:
    """(evaluation_class, train_class, evaluation_records, train_records): every link between classes of equal records, a class
    being named by its smallest example_id.  With ``class_members`` this says all that the expanded pairs say."""
    o = Overlap(examples)
    p = _sized(o, o.pairs(o.matches()).distinct())
    return p.select(F.col("x").alias("evaluation_class"), F.col("e").alias("train_class"), F.col("n_x").alias("evaluation_records"), F.col("n_e").alias("train_records"))


def class_members(examples: DataFrame) -> DataFrame:
    """(example_id, class_id) of every record: its own id unless it repeats another of its side."""
    o = Overlap(examples)
    return o.base.select("example_id").distinct().join(o.copies.select("example_id", "rep").distinct(), "example_id", "left").select("example_id", F.coalesce("rep", "example_id").alias("class_id"))


def overlap_report(examples: DataFrame) -> DataFrame:
    """Per split and source: evaluation records, those with a train partner, their share, and pairs."""
    o = Overlap(examples)
    p = _sized(o, o.pairs(o.matches()).distinct()).groupBy("x").agg(F.sum("n_e").alias("partners"))
    members = o.copies.where("not train").select(F.col("rep").alias("x"), "example_id")
    p = p.join(members, "x", "left").select(F.coalesce("example_id", "x").alias("x"), "partners")
    rows = examples.where("example_id is not null").select("example_id", F.lower(F.trim("split")).alias("split"), "source").where("split in ('val', 'test')")
    return (
        rows.join(p.withColumnRenamed("x", "example_id"), "example_id", "left")
        .groupBy("split", "source")
        .agg(F.count("*").alias("records"), F.count("partners").alias("overlapping"), F.coalesce(F.sum("partners"), F.lit(0)).alias("pairs"))
        .withColumn("share", F.col("overlapping") / F.col("records"))
    )
