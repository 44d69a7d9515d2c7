"""Problem 10: keyword-stuffed, link-list and tag-list pages.

Every line of a text (long lines by sentence or run of words) is described by small numbers that any script and language has:
how it begins and ends, how many words, addresses, separators, digits, capitals, signs of code and hashtags it holds, how many of
its words are short or function words, how many repeat within the line, and how many of its word pairs repeat on the
page.  They are counted for whole batches at once on arrays of codepoint classes.  A hidden Markov model, whose states emit these
numbers independently, labels the lines by Viterbi as prose, structure (code, tables, logs, lists of data), link list, tag
list, menu or stuffed sentences; a page is flagged if more than ``SHARE`` of its words stand in the last four.

Emissions and transitions are counted on a bounded sample of generated pages (``SAMPLE``), smoothed: prose and verse
in known and invented languages and in scripts without blanks, code, data, change logs, references, and spam of
each kind.  No page of the tables is in it.

Defined results: null, empty and blank texts and pages under ``LEAST_WORDS`` words are not flagged; an address counts
as one word, two characters of a script without blanks as one; rows with null doc_id are left out; texts of any length
are labelled whole; repeated rows give one result.
"""

from __future__ import annotations

import random
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import spread

SHARE = 0.5
LEAST_WORDS = 8
SAMPLE = 2_500
#: Characters above which a line is taken sentence by sentence, and words of a piece without sentence ends.
LONG, PIECE = 160, 24
#: Characters described together, about, and characters of a page from which on its parts are described one by one (word pairs then repeat within parts).
BLOCK, PART = 1 << 20, 1 << 22

STATES = ("prose", "structure", "link list", "tag list", "menu", "stuffed")
BAD = (2, 3, 4, 5)

# Function words of several languages, and words that begin lines of code (fixed values).
_FUNCTION = (
    "the a an is are was were be been of to and or but in it its on at by with from that this these those when after before can could will would should may must has have had do does did not no if then than while each every we you they he she "
    "i our your their there here which who what why how because so once until only also as into about der die das und ist nicht ein eine zu mit dem den von auf im es sich la le les et est pas un une des du dans que qui pour sur el los las y se del "
    "al como por con si il lo gli che non di da и в не на что это как по но он она w z i na do nie się jest że o a to jak ale od za po van het een en dat niet op te og er det til ve bir bu"
).split()
_STARTERS = "def class fn pub let const var import from use return if for while else elif impl struct export function async with try raise assert match type interface enum package public private static void int select insert update create echo mkdir sudo git docker npm pip curl then fi done end begin".split()
_PARTICLES = "的是在了不和有我这个也就都很会说到要の は を に が と も で す"

_OTHER, _NEWLINE, _SPACE, _LOWER, _UPPER, _UNCASED, _WHOLE, _DIGIT, _STOP, _COMMA, _CODE, _BAR, _HASH, _DASH, _APOS = range(15)
_WORDLY = (_LOWER, _UPPER, _UNCASED)


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class, lower case, mixed number) of every codepoint."""
    cls, low = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32)
    kinds = {"Ll": _LOWER, "Lm": _LOWER, "Mn": _LOWER, "Mc": _LOWER, "Lu": _UPPER, "Lt": _UPPER, "Lo": _UNCASED, "Nd": _DIGIT, "No": _DIGIT, "Nl": _DIGIT, "Zs": _SPACE, "Cc": _SPACE, "Zl": _NEWLINE, "Zp": _NEWLINE}
    for cp in range(0x110000):
        c = chr(cp)
        k = kinds.get(unicodedata.category(c))
        if k is not None:
            cls[cp] = k
            if k == _UPPER and len(c.lower()) == 1:
                low[cp] = ord(c.lower())
    for lo, hi in ((0x3040, 0x30FF), (0x3400, 0x9FFF), (0x20000, 0x323AF)):
        cls[lo : hi + 1][cls[lo : hi + 1] == _UNCASED] = _WHOLE
    for chars, k in (("\n\x0b\x0c\x1c\x1d\x1e\x85", _NEWLINE), (".?!。！？…।؟", _STOP), (",;:，、；：،", _COMMA), ("{}()[]=<>$&@\\`\"_^~+*%", _CODE), ("|·•★/◆►", _BAR), ("#", _HASH), ("-–—", _DASH), ("'’", _APOS)):
        for c in chars:
            cls[ord(c)] = k
    mixed = (np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return cls, low, mixed ^ (mixed >> np.uint64(29))


_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, np.uint64(b)))]) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def _hashes(low: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A number for each stretch of lower-case text; equal words give equal numbers, and only counts are made of them."""
    size = 1 << 21
    while size < len(low) + 1:
        size *= 2
    power, inverse = _powers(size)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(low) + 1, np.uint64)
        np.cumsum(_tables()[2][low] * power[: len(low)], out=prefix[1:])
        h = (prefix[stops] - prefix[starts]) * inverse[starts]
    return h ^ (h >> np.uint64(31))


@lru_cache(1)
def _listed() -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers of the function words and of the words that begin code."""
    out = []
    for words in (_FUNCTION, _STARTERS):
        text = np.frombuffer(" ".join(words).encode("utf-32-le"), np.uint32)
        stops = np.cumsum([len(w) + 1 for w in words]) - 1
        out.append(np.unique(_hashes(text, stops - [len(w) for w in words], stops)))
    return out[0], out[1]


def _among(sorted_: np.ndarray, x: np.ndarray) -> np.ndarray:
    return sorted_[np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)] == x


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, stops) of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flag.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Whether each of n places lies in one of the stretches."""
    return np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(stops, minlength=n + 1))[:n] > 0


def _next(places: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """First of the ascending ``places`` at or after each of ``at``, or n."""
    return np.append(places, n)[np.searchsorted(places, at)]


def _level(x: np.ndarray, *bounds: float) -> np.ndarray:
    """How many of the bounds a number reaches."""
    return np.searchsorted(np.array(bounds), x, "right")


#: Numbers of values of the features, in the order of ``describe``.
SIZES = (12, 8, 8, 12, 16, 6, 7, 6, 10, 6, 5, 5, 5, 5, 8, 8)


def describe(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, words, page, line) of the pieces that are not blank of all texts; line counts within all texts."""
    cls_of, low_of, _ = _tables()
    cp = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(cp)
    if not n:
        return np.zeros((0, len(SIZES)), np.int64), np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
    page_end = np.cumsum([len(t) + 1 for t in texts])
    k, low = cls_of[cp], low_of[cp]
    pad = np.concatenate([k, [_NEWLINE, _NEWLINE]]).astype(np.uint8)
    after = pad[1 : n + 1]
    pad[:n][(cp == 13) & (np.append(cp[1:], 0) != 10)] = _NEWLINE
    k = pad[:n]

    # lines, then pieces of long ones
    new = np.ones(n, bool)
    new[1:] = k[:-1] == _NEWLINE
    new[page_end[:-1]] = True
    line_at = np.flatnonzero(new)
    line_no = np.cumsum(new) - 1
    size = np.diff(np.append(line_at, n))
    long = size[line_no] >= LONG
    space = (k == _SPACE) | (k == _NEWLINE)
    if long.any():
        stop = (k == _STOP) & long
        west = np.flatnonzero(stop & (after == _SPACE)) + 2
        east = np.flatnonzero(stop & (cp > 0x2FFF)) + 1
        for at in (west, east):
            at = at[at < n]
            new[at[line_no[at] == line_no[at - 1]]] = True

    # addresses, and what stands in mark-up
    delimiter = np.flatnonzero(space | np.isin(cp, [ord(c) for c in "\"'<>)]`|"]))
    q = np.concatenate([cp, [0, 0, 0]])
    colon = np.flatnonzero((cp == 58) & (q[1 : n + 1] == 47) & (q[2 : n + 2] == 47))
    letter = (k == _LOWER) | (k == _UPPER)
    no_letter = np.flatnonzero(~letter)
    url_at = np.append(-1, no_letter)[np.searchsorted(no_letter, colon)] + 1
    www = np.flatnonzero((cp == 119) & (q[1 : n + 1] == 119) & (q[2 : n + 2] == 119) & (q[3 : n + 3] == 46))
    www = www[~np.isin(np.append(10, cp)[www], [47, 46, 119])]
    url_at = np.unique(np.concatenate([url_at, www]))
    url_end = _next(delimiter, url_at, n)
    tag_at = np.flatnonzero((cp == 60) & (np.isin(after, [_LOWER, _UPPER]) | (q[1 : n + 1] == 47) | (q[1 : n + 1] == 33)))
    close, opened = np.flatnonzero(cp == 62), np.flatnonzero(cp == 60)
    tag_end = _next(close, tag_at, n)
    ok = (tag_end < n) & (_next(opened, tag_at + 1, n) > tag_end)
    ok[ok] = line_no[tag_at[ok]] == line_no[tag_end[ok]]
    tag_at, tag_end = tag_at[ok], tag_end[ok] + 1
    anchor = tag_at[(low_of[q[tag_at + 1]] == 97) & (pad[np.minimum(tag_at + 2, n)] == _SPACE)]
    hidden = _covered(n, np.concatenate([url_at, tag_at]), np.concatenate([np.maximum(url_end, url_at), tag_end]))

    # words
    wordly = np.isin(k, _WORDLY)
    wordly |= (k == _APOS) & np.append(False, wordly[:-1]) & np.isin(after, _WORDLY)
    wordly &= ~hidden
    wordly[new] = wordly[new] & True
    ws, we = _runs(wordly)
    inner = ws[0:0]
    if long.any():  # long pieces without an end: a new one every few words
        piece = np.cumsum(new) - 1
        length = np.diff(np.append(np.flatnonzero(new), n))[piece]
        deep = ws[length[ws] >= 2.5 * LONG]
        if len(deep):
            of = piece[deep]
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            nth = np.arange(len(deep)) - np.repeat(first, np.diff(np.append(first, len(of))))
            inner = deep[(nth % PIECE == 0) & (nth > 0)]
            new[inner] = True
    piece = np.cumsum(new) - 1
    m = int(piece[-1]) + 1
    count = lambda places: np.bincount(piece[places], minlength=m)
    visible = ~space
    filled = np.bincount(piece[visible & ~hidden], minlength=m)
    total = np.bincount(piece[visible], minlength=m)
    h = _hashes(low, ws, we)
    wp = piece[ws]
    length = we - ws
    whole = np.bincount(piece[(k == _WHOLE) & ~hidden], minlength=m)
    east = whole / 2
    n_words = np.bincount(wp, minlength=m) + east
    urls = count(url_at)
    function, starters = _listed()
    n_function = np.bincount(wp[_among(function, h)], minlength=m)
    particles = np.bincount(piece[np.isin(cp, [ord(c) for c in _PARTICLES if c != " "])], minlength=m)
    n_function = n_function + particles / 2
    n_short = np.bincount(wp[length <= 3], minlength=m)
    n_capital = np.bincount(wp[k[ws] == _UPPER], minlength=m)
    # repeats: of words within a piece, of word pairs on a page; a character of a script without blanks is a word here
    single = np.flatnonzero((k == _WHOLE) & ~hidden)
    if len(single):
        ts = np.concatenate([ws, single])
        order = np.argsort(ts, kind="stable")
        ts, te = ts[order], np.concatenate([we, single + 1])[order]
        th, tp = _hashes(low, ts, te), piece[ts]
    else:
        th, tp = h, wp
    order = np.lexsort((th, tp))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(tp[order]) != 0) | (th[order][1:] != th[order][:-1])
    distinct, tokens = np.bincount(tp[order[fresh]], minlength=m), np.bincount(tp, minlength=m)
    page = np.searchsorted(page_end, np.flatnonzero(new), "right")
    both = np.flatnonzero(tp[1:] == tp[:-1])
    of = page[tp[both]]
    with np.errstate(over="ignore"):
        pairs = (th[both] * np.uint64(0xBF58476D1CE4E5B9) + th[np.minimum(both + 1, max(len(th) - 1, 0))]) * np.uint64(0x94D049BB133111EB) + of.astype(np.uint64) * np.uint64(_BASE)
    _, code, often = np.unique(pairs, return_inverse=True, return_counts=True)
    # a pair counts as repeated if it stands four times or more, in two pieces of five, and makes up a hundredth of the page's pairs:
    # a phrase that is pushed everywhere, not the wording that some sentences share
    enough = np.maximum(np.maximum(4, 0.4 * np.bincount(page[tokens > 1], minlength=len(texts))), np.bincount(of, minlength=len(texts)) / 100)
    repeated = np.bincount(tp[both[often[code] >= enough[of]]], minlength=m)
    n_pairs = np.bincount(tp[both], minlength=m)

    # signs
    sign = lambda *kinds: np.bincount(piece[np.isin(k, kinds) & ~hidden], minlength=m)
    upto = np.append(np.flatnonzero(new)[1:], n)
    shown = np.flatnonzero(visible)
    first = shown[np.minimum(np.searchsorted(shown, np.flatnonzero(new)), len(shown) - 1)] if len(shown) else np.zeros(m, np.int64)
    last = shown[np.maximum(np.searchsorted(shown, upto) - 1, 0)] if len(shown) else np.zeros(m, np.int64)
    start = np.flatnonzero(new)
    before, behind = k[np.maximum(first - 1, 0)], pad[first + 1]
    indent = np.minimum(first - start, 40)
    c, k1 = cp[first], k[first]
    lead = np.select(
        [(k1 == _HASH) & (behind == _HASH) | (k1 == _HASH) & (behind == _SPACE), k1 == _HASH, np.isin(c, [45, 42, 0x2022, 0xB7, 0x25AA]) & (behind == _SPACE), c == 43, (c == 45), c == 124, (c == 47) & (q[first + 1] == 47) | (c == 47) & (q[first + 1] == 42), c == 62, (k1 == _DIGIT), np.isin(c, [34, 39, 91, 123, 125, 40, 41, 64]), indent >= 4],
        range(1, 12), 0,
    )
    word_after = _next(ws, first, n)
    first_word = np.searchsorted(ws, first)
    own = (first_word < len(ws)) & (word_after < upto)
    fw = np.minimum(first_word, max(len(ws) - 1, 0))
    begins_code = own & (_among(starters, h[fw]) if len(h) else False)
    stop_of_first = np.where(own, we[fw] if len(we) else 0, first)
    keyed = own & (q[stop_of_first] == 58) & (pad[np.minimum(stop_of_first + 1, n)] != _DIGIT)
    equal = np.bincount(piece[(cp == 61) & (np.append(_SPACE, k[:-1]) == _SPACE) & (after == _SPACE)], minlength=m) > 0
    end = np.select([np.isin(k[last], [_LOWER, _UPPER, _UNCASED, _WHOLE]), k[last] == _STOP, k[last] == _COMMA, np.isin(cp[last], [123, 40, 91, 92]), np.isin(cp[last], [125, 41, 93, 59, 62]), k[last] == _DIGIT, np.isin(cp[last], [34, 39, 96])], range(7), 7)
    commas, bars, dashes = sign(_COMMA), sign(_BAR), np.bincount(piece[(k == _DASH) & (np.append(_SPACE, k[:-1]) == _SPACE) & (after == _SPACE)], minlength=m)
    parts = commas + bars + dashes + 1
    mean = n_words / parts
    code_signs, digits = sign(_CODE), sign(_DIGIT)
    hashes = np.bincount(piece[(k == _HASH) & np.isin(np.append(_NEWLINE, k[:-1]), [_SPACE, _NEWLINE]) & np.isin(after, [_LOWER, _UPPER, _UNCASED, _WHOLE])], minlength=m)
    words = n_words + urls
    safe = np.maximum(n_words, 1)
    tags = count(tag_at)
    features = np.stack([
        lead, end, _level(words, 1, 2, 3, 5, 8, 13, 25), np.minimum(urls, 3) * 3 * (urls > 0) + np.where(urls > 0, _level(n_words, 1, 5), 0), _level(n_function, 0.5, 1.5, 3) * 4 + _level(n_words, 4, 8, 14), _level(n_short / safe, 0.01, 0.15, 0.3, 0.45) + (n_words >= 3),
        np.where(parts >= 3, _level(mean, 1.01, 2.01, 3.4, 6) + 2, parts - 1), np.where(tokens < 6, 0, 1 + _level(1 - distinct / np.maximum(tokens, 1), 0.12, 0.3, 0.5, 0.7)), np.where(n_pairs < 2, 0, 1 + _level(repeated / np.maximum(n_pairs, 1), 0.001, 0.2, 0.45, 0.7)),
        _level(code_signs / np.maximum(filled, 1), 0.001, 0.02, 0.06, 0.14, 0.3), _level(digits / np.maximum(filled, 1), 0.001, 0.08, 0.2, 0.45), _level(hashes, 1, 2, 4, 7), _level(n_capital / safe, 0.01, 0.3, 0.6, 0.95), np.minimum(tags, 2) + 2 * (count(anchor) > 0),
        (whole > 0) * 4 + (np.bincount(piece[(k == _COMMA) & (cp > 127)], minlength=m) > 0) * 2 + (np.isin(k[last], [_STOP]) & (cp[last] > 127)) + np.where((whole == 0) & (commas > 0), 1, 0) * 1, begins_code * 1 + keyed * 2 + equal * 4,
    ], 1).astype(np.int64)
    features = np.minimum(features, np.array(SIZES) - 1)
    keep = total > 0
    return features[keep], words[keep], page[keep], line_no[start][keep]


# ---- generated pages ------------------------------------------------------------------------------


def _w(r: random.Random, lo: int = 1, hi: int = 3) -> str:
    return "".join(r.choice("bcdfghklmnprstvwz") + r.choice("aeiou") + r.choice(["", "", "n", "r", "l", "st", "ck"]) for _ in range(r.randint(lo, hi)))


class _Language:
    """Words of one page: a known or invented language, or a script without blanks."""

    def __init__(self, r: random.Random):
        self.r, self.east = r, r.random() < 0.12
        if self.east:
            self.chars = [chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(300)]
            return
        k = r.random()
        whole = _FUNCTION[:88]
        self.small = whole if k < 0.6 else _FUNCTION[88:] if k < 0.75 else [_w(r, 1, 1)[: r.randint(1, 4)] for _ in range(30)]
        self.large = [_w(r, 2, 3) + r.choice(["", "", "s", "ed", "ing", "en", "ć", "ä"]) for _ in range(400)]
        if r.random() < 0.08:
            shift = {ord(a): ord(b) for a, b in zip("abcdefghijklmnopqrstuvwxyz", r.choice(["абцдефгхийклмнопкрстувжхыз", "αβψδεφγηιξκλμνοπκρστυβωχυζ"]))}
            self.small, self.large = [x.translate(shift) for x in self.small], [x.translate(shift) for x in self.large]
        self.rate = r.uniform(0.3, 0.55)

    def words(self, n: int) -> list[str]:
        return [self.r.choice(self.small) if self.r.random() < self.rate else self.r.choice(self.large) for _ in range(n)]

    def sentence(self) -> str:
        r = self.r
        if self.east:
            marks = [c for c in _PARTICLES if c != " "]
            return "，".join("".join(r.choice(marks) if r.random() < 0.25 else r.choice(self.chars) for _ in range(r.randint(4, 12))) for _ in range(r.randint(1, 4))) + r.choice("。。。！？")
        w = self.words(r.randint(5, 18))
        for i in range(2, len(w) - 2):
            if r.random() < 0.08:
                w[i] += ","
        if r.random() < 0.06:
            w[r.randrange(len(w))] = f"https://{_w(r)}.example/{_w(r)}"
        if r.random() < 0.1:
            w[r.randrange(len(w))] = f"`{_w(r)}_{_w(r)}`"
        return " ".join(w).capitalize() + r.choice("......?!:")

    def paragraph(self) -> list[str]:
        """Prose as one line, as sentences, wrapped, or as verse."""
        r = self.r
        said = [self.sentence() for _ in range(r.randint(1, 6))]
        form = r.randrange(5)
        if form == 0:
            return [("" if self.east else " ").join(said)]
        if form == 1:
            return said
        if self.east:
            text, width = "".join(said), r.randint(8, 40)
            return [text[i : i + width] for i in range(0, len(text), width)]
        words = " ".join(said).split(" ")
        if form == 2:
            out, width = [""], r.randint(50, 90)
            for x in words:
                if len(out[-1]) + len(x) > width:
                    out.append("")
                out[-1] += (" " if out[-1] else "") + x
            return out
        if form == 3:  # verse
            out = []
            while words:
                k = r.randint(4, 9)
                out.append(" ".join(words[:k]).rstrip(".") + r.choice(["", "", ",", ";"]))
                words = words[k:]
            return [x[:1].upper() + x[1:] if r.random() < 0.8 else x for x in out]
        mark = r.choice(["- ", "* ", "> ", "// ", "# ", "1. ", "/// ", " * ", "-- "])
        return [mark + x for x in said]


def generated_page(r: random.Random) -> list[tuple[str, int]]:
    """Lines with the state they stand for."""
    w = lambda: _w(r)
    lang = _Language(r)
    n9, n999 = (lambda: r.randint(0, 9)), (lambda: r.randint(1, 999))
    url = lambda: f"https://{r.choice(['www.', 'docs.', 'get-', '', 'shop.', 'blog.'])}{w()}.{r.choice(['example', 'test', 'com', 'net', 'info'])}/{r.choice(['', w(), 'a/' + str(n999()), '?id=' + str(r.randint(1, 99999)), w() + '-' + w() + '.html'])}"
    pool = [w() for _ in range(r.choice([2, 4, 8, 60]))]
    if lang.east:
        pool = ["".join(r.choice(lang.chars) for _ in range(r.randint(1, 3))) for _ in pool]
    join = "" if lang.east and r.random() < 0.6 else " "
    phrase = lambda: join.join(r.choice(pool) for _ in range(r.randint(1, 3)))
    case = r.choice([str, str.capitalize, str.title, str.upper])
    sentence, ident = lang.sentence, (lambda: r.choice([f"{w()}_{w()}", f"{w()}{w().capitalize()}", w()]))

    def prose(n: int) -> list[tuple[str, int]]:
        if r.random() < 0.25 and not lang.east:  # a few sentences again and again, with other words in some places each time
            kept = [sentence().split(" ") for _ in range(r.randint(1, 4))]
            open_ = [r.sample(range(len(k)), min(len(k), r.randint(1, 3))) for k in kept]
            said = [" ".join(r.choice([w(), w(), str(n999())]) if i in open_[j] else x for i, x in enumerate(kept[j])) for j in (r.randrange(len(kept)) for _ in range(r.randint(4, 14)))]
            return [(x, 0) for x in (said if r.random() < 0.5 else [" ".join(said[i : i + 2]) for i in range(0, len(said), 2)])]
        return [(x, 0) for _ in range(-(-n // 3)) for x in lang.paragraph()]

    def structure(n: int) -> list[tuple[str, int]]:
        kind = r.randrange(19)
        code = [
            lambda: f"    let {ident()} = self.{ident()}({n999()})?;", lambda: f"def {ident()}({ident()}, {ident()}={n9()}):", lambda: r.choice(["}", "});", "    }", "end", "fi", "),", "else:", "{"]), lambda: f"    if not {ident()}:", lambda: f"    return {ident()}.{ident()}({ident()})", lambda: f"import {w()}.{ident()}", lambda: f"use crate::{w()}::{ident()};",
            lambda: f"const {ident()} = require(\"{w()}-{w()}\");", lambda: f"for (int i = 0; i < {n999()}; i++) {{", lambda: f"    {ident()}.{ident()}({ident()}, \"{w()} {w()}\")", lambda: f"echo \"{w()} {w()}\" >> {w()}.log", lambda: f"SELECT {ident()}, {ident()} FROM {ident()} WHERE {ident()} = {n9()};", lambda: f"pub struct {w().capitalize()} {{", lambda: f"    # {sentence()}", lambda: f"  // {sentence()}", lambda: f"export {w().upper()}_{w().upper()}={w()}", lambda: f"{ident()} {ident()}", lambda: f"sudo {w()} install {w()}-{w()}",
        ]
        data = [
            lambda: f"  {ident()}: {n999()}", lambda: f"{ident()}: {w()}", lambda: f'  "{ident()}": ["{w()}", "{w()}"],', lambda: f'  "{ident()}": "{w()} {w()}",', lambda: f"- {ident()}: {w()}", lambda: f"  - {w()}", lambda: f"{ident()} = \"{w()} {w()} {w()}\"", lambda: f"[{w()}]", lambda: f"  {ident()}: \"{sentence()}\"",
        ]
        forms = [
            lambda: r.choice(code)(), lambda: r.choice(code)(), lambda: r.choice(code)(), lambda: r.choice(data)(), lambda: f'    "{w()}",', lambda: f'{w()}-{w()} = "{n9()}.{n9()}"', lambda: f"{w()}-{w()}=={n9()}.{n9()}.{n9()}", lambda: f'    "{w()}": "^{n9()}.{n9()}.{n9()}",', lambda: f"| {n999()} | {r.random():.3f} | {sentence()} |",
            lambda: f"| {w()} {w()} | {n999()} | {w()} |", lambda: f"2024-05-{r.randint(10, 28)} {r.choice(['ERROR', 'INFO', 'WARN'])} {ident()}: {w()} {w()} {n999()}", lambda: f"- [{w()} {w()}]({url()}){r.choice([': ', ' - ', ' – '])}{sentence()}", lambda: f"- {r.choice(['Fix', 'Add', 'Remove', 'Update'])} {sentence()} ([#{n999()}]({url()}))", lambda: f"* {sentence()} ({'-'.join([w(), str(n999())])})",
            lambda: f"[{n999()}] {w().capitalize()}, {w()[0].upper()}. {sentence()} {url()}", lambda: f"{r.choice(['- ', '* ', ''])}{w().capitalize()} {w().capitalize()} <{w()}@{w()}.example>", lambda: f"{n999()},{w()},{r.random():.2f},{w()} {w()}", lambda: f"{r.choice(['- ', ''])}{n999()} {r.choice(['g', 'ml', 'cups', 'kg', 'tsp'])} {w()} {w()}", lambda: f"{w()}_{w()} ({r.choice(['string', 'int', 'bool'])}): {sentence()}",
        ]
        if r.random() < 0.25:  # many lines of one kind, as imports, settings, calls or tests
            one = r.choice(code[:13] + data[:6])
            forms.append(one)
            kind, n = len(forms) - 1, n * r.choice([1, 2, 4])
        sign = r.choice([None, None, None, "+ -"])
        return [((r.choice(sign) if sign else "") + forms[kind](), 1) for _ in range(n)]

    def links(n: int) -> list[tuple[str, int]]:
        kind = r.randrange(9)
        label = r.choice([lambda: case(phrase()), lambda: case(phrase()), lambda: f"{w()}-{w()} {phrase()}", lambda: f"{w()} {w()} {phrase()}"])
        forms = [
            lambda: url(), lambda: f"{r.choice('-*')} [{label()}]({url()})", lambda: f"* [{label()}]({url()})", lambda: f"# {url()}  {ident()}", lambda: f'<li><a href="{url()}">{label()}</a></li>', lambda: r.choice([case(phrase()), f"{url()} {phrase()} {url()}"]), lambda: f"{label()}{r.choice([': ', ' - ', ' '])}{url()}", lambda: f'<a href="{url()}">{phrase()}</a> <a href="{url()}">{phrase()}</a>',
            lambda: f"{n9()}. {url()}",
        ]
        mark = r.choice(["", "", "", "> ", "// ", "+"])
        return [(mark + forms[kind](), 2) for _ in range(n)]

    def tags(n: int) -> list[tuple[str, int]]:
        kind = r.randrange(8)
        sep = r.choice([", ", "; ", " | ", " · ", " ★ ", " / ", " - ", "、" if lang.east else ", ", ","])
        many = lambda k: sep.join(phrase() for _ in range(k))
        mark, bar = r.choice(["", "", "", "", "// ", "# ", "/// ", "* ", "<!-- ", "- ", "+"]), r.choice([" | ", " | ", " · ", " - "])
        forms = [
            lambda: many(r.randint(4, 12)), lambda: " ".join(f"#{w().capitalize()}{w().capitalize()}" for _ in range(r.randint(4, 12))), lambda: " ".join(r.choice(pool) for _ in range(r.randint(8, 40))), lambda: f"{r.choice(['tags', 'keywords', 'topics', 'Tags', 'related'])}: {many(r.randint(5, 12))}", lambda: f"{case(r.choice([phrase(), w()]))} {r.choice(['v', ''])}{n9()}.{n9()}{bar}{phrase()}{bar}{r.choice([w(), phrase()])}{bar}{r.choice(['SKU-', 'No. ', '#', 'Art. '])}{n999()}{bar}{r.choice([f'${n999()}', f'-{n9()}5%', 'sale', 'new', 'in stock', f'{n9()},99 €'])}",
            lambda: many(r.randint(20, 80)), lambda: f"{r.choice(['keywords', 'description', 'content'])} = \"{many(r.randint(8, 20))}\"", lambda: f"{case(phrase())} - {r.choice(['$', '€', ''])}{n999()}.{n9()}9 - {phrase()}, {phrase()}, {phrase()}",
        ]
        return [(mark + forms[kind](), 3) for _ in range(n)]

    def menu(n: int) -> list[tuple[str, int]]:
        mark = r.choice(["", "", "", "- ", "* ", "> "])
        most = r.choice([1, 2, 2, 3])
        return [(mark + case(" ".join(phrase() for _ in range(r.randint(1, most)))), 4) for _ in range(n)]

    def stuffed(n: int) -> list[tuple[str, int]]:
        """Sentences around a few phrases repeated over and over."""
        few = [join.join(r.choice(pool) for _ in range(2)) for _ in range(r.randint(1, 3))]
        out = []
        for _ in range(n):
            words: list[str] = []
            for _ in range(r.randint(2, 6)):
                words += [r.choice(few)] + ([r.choice([c for c in _PARTICLES if c != " "])] if lang.east else lang.words(r.randint(1, 3)))
            out.append((join.join(words)[:1].upper() + join.join(words)[1:] + r.choice("..!!?。" if lang.east else "...!!?"), 5))
        if r.random() < 0.4:
            return [(" ".join(x for x, _ in out[i : i + 4]), 5) for i in range(0, len(out), 4)]
        return out

    page: list[tuple[str, int]] = []
    if r.random() < 0.55:
        for _ in range(r.randint(1, 5)):
            page += r.choice([prose, prose, structure, structure])(r.randint(1, 14))
            if r.random() < 0.25:
                page.append((f"{'#' * r.randint(1, 3)} {case(w() + ' ' + w())}", 0))
            if r.random() < 0.1:
                page += links(r.randint(1, 3))
            if r.random() < 0.05:
                page += tags(1)
    else:
        if r.random() < 0.4:
            page += prose(1)[:2]
        for _ in range(r.choice([1, 1, 1, 2])):
            page += r.choice([links, links, tags, tags, menu, stuffed])(r.randint(3, 30))
        if r.random() < 0.3:
            page += prose(1)[:2]
    return [(x, s) for x, s in page if x.strip()]


# ---- the model ------------------------------------------------------------------------------------


class Model:
    """Hidden Markov model with counted log-probabilities; a state emits each feature independently."""

    def __init__(self, start: np.ndarray, moves: np.ndarray, emits: list[np.ndarray]):
        self.start, self.moves, self.emits = start, moves, emits

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), len(STATES)))
        for i, table in enumerate(self.emits):
            out += table[features[:, i]]
        return out

    def decode(self, scores: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Viterbi states of the pieces of each page, given the number of pieces of each; all pages step by step together."""
        states = np.zeros(len(scores), np.int8)
        ends = np.cumsum(sizes)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        if not len(order):
            return states
        n, at = sizes[order], (ends - sizes)[order]
        best = self.start + scores[at]
        alive = np.searchsorted(-n, -np.arange(int(n[0])), "left")  # pages longer than each step
        back: list[np.ndarray] = []
        for t in range(1, int(n[0])):
            k = int(alive[t])
            reach = best[:k, :, None] + self.moves
            came = reach.argmax(1)
            best[:k] = np.take_along_axis(reach, came[:, None], 1)[:, 0] + scores[at[:k] + t]
            back.append(came.astype(np.int8))
        y = best.argmax(1)
        for t in range(int(n[0]) - 1, -1, -1):
            k = int(alive[t])
            states[at[:k] + t] = y[:k]
            if t:
                y[:k] = back[t - 1][np.arange(k), y[:k]]
        return states


@lru_cache(2)
def trained(sample: int = SAMPLE, seed: int = 5) -> Model:
    r = random.Random(seed)
    pages = [p for p in (generated_page(r) for _ in range(sample)) if p]
    features, _, page, line = describe(["\n".join(x for x, _ in p) for p in pages])
    first = np.cumsum([len(p) for p in pages]) - [len(p) for p in pages]
    state = np.array([s for p in pages for _, s in p])[line] if len(pages) else np.zeros(0, int)
    assert (np.searchsorted(first, line, "right") - 1 == page).all()
    m = len(STATES)
    start, moves = np.ones(m), np.ones((m, m))
    new = np.append(True, page[1:] != page[:-1])
    np.add.at(start, state[new], 1)
    np.add.at(moves, (state[:-1][~new[1:]], state[1:][~new[1:]]), 1)
    emits = []
    for i, size in enumerate(SIZES):
        table = np.full((size, m), 0.5)
        np.add.at(table, (features[:, i], state), 1)
        emits.append(np.log(table / table.sum(0)))
    return Model(np.log(start / start.sum()), np.log(moves / moves.sum(1, keepdims=True)), emits)


# ---- application ----------------------------------------------------------------------------------


def all_shares(texts: list[str | None], model: Model) -> Iterator[tuple[int, dict[str, int]]]:
    """(words, words by state) of each text; every page with words is decoded."""
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto] or "") <= BLOCK):
            size += len(texts[upto] or "")
            upto += 1
        block = [t or "" for t in texts[at:upto]]
        parts = [block] if size <= PART else [[x] for x in _parts(block[0])]
        scores, words, page = [], [], []
        for part in parts:
            features, w, p, _ = describe(part)
            scores.append(model.scores(features))
            words.append(w)
            page.append(p if len(block) == len(part) else np.zeros(len(w), np.int64))
        words, page = np.concatenate(words), np.concatenate(page)
        states = model.decode(np.concatenate(scores), np.bincount(page, minlength=len(block)))
        by = np.zeros((len(block), len(STATES)))
        np.add.at(by, (page, states), words)
        for row in by:
            rounded = [int(x) for x in np.ceil(row)]
            yield sum(rounded), {s: n for s, n in zip(STATES, rounded) if n}
        at = upto


def _parts(text: str) -> Iterator[str]:
    """A very long text in parts of ``PART`` characters or less, cut at line ends where there are any."""
    at = 0
    while len(text) - at > PART:
        end = text.rfind("\n", at, at + PART) + 1
        end = end if end > at else at + PART
        yield text[at:end]
        at = end
    yield text[at:]


def shares(text: str | None, model: Model) -> tuple[int, dict[str, int]]:
    """(words, words by state) of a text."""
    return next(all_shares([text], model))


def flagged(total: int, by: dict[str, int]) -> bool:
    return total >= LEAST_WORDS and sum(by.get(STATES[s], 0) for s in BAD) > SHARE * total


_COLUMNS = ("link_words", "tag_words", "menu_words", "stuffed_words")


def _label(docs: DataFrame, sample: int, all_rows: bool) -> DataFrame:
    given = trained(sample)
    model = docs.sparkSession.sparkContext.broadcast((given.start, given.moves, given.emits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hmm = Model(*model.value)
        for b in (big.slice(i, 500) for big in batches for i in range(0, big.num_rows, 500)):
            rows = []
            for i, (total, by) in zip(b.column(0).to_pylist(), all_shares(b.column(1).to_pylist(), hmm)):
                bad = flagged(total, by)
                if all_rows or bad:
                    rows.append((i, total, *(by.get(STATES[s], 0) for s in BAD), bad))
            cols = list(zip(*rows)) if rows else [()] * 7
            types = (pa.int64(), *[pa.int32()] * 5, pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types)], names=["doc_id", "words", *_COLUMNS, "flagged"])

    return spread(docs.where("doc_id is not null").select("doc_id", "text")).mapInArrow(run, "doc_id bigint, words int, " + ", ".join(f"{c} int" for c in _COLUMNS) + ", flagged boolean")


def stuffed_pages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id) of the flagged pages."""
    return _label(docs, sample, False).select("doc_id").distinct()


def labelled_pages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Every page with its words by label and whether it is flagged."""
    return _label(docs, sample, True).distinct()


def spam_report(docs: DataFrame) -> DataFrame:
    """Per source: pages, flagged pages and their share."""
    flags = labelled_pages(docs).groupBy("doc_id").agg(F.max("flagged").alias("flagged"))
    return docs.select("doc_id", "source").distinct().join(flags, "doc_id").groupBy("source").agg(F.count("*").alias("pages"), F.count_if("flagged").alias("flagged")).withColumn("share", F.col("flagged") / F.col("pages"))
