"""Edit distance over arbitrary symbol sequences."""

from __future__ import annotations

from collections.abc import Sequence


def edit_distance(a: Sequence, b: Sequence) -> int:
    """Insertions, removals and replacements between two sequences; bit-parallel over the longer one."""
    if len(a) > len(b):
        a, b = b, a
    lo, hi = 0, len(a)
    while lo < hi and a[lo] == b[lo]:
        lo += 1
    cut = 0
    while cut < hi - lo and a[-1 - cut] == b[-1 - cut]:
        cut += 1
    a, b = a[lo : len(a) - cut], b[lo : len(b) - cut]
    n = len(a)
    if not n:
        return len(b)
    peq: dict = {}
    for i, x in enumerate(a):
        peq[x] = peq.get(x, 0) | 1 << i
    mask, top = (1 << n) - 1, 1 << (n - 1)
    pv, mv, score = mask, 0, n
    for y in b:
        eq = peq.get(y, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 | 1
        mh <<= 1
        pv = (mh | ~(xv | ph)) & mask
        mv = ph & xv & mask
    return score


def within(a: Sequence, b: Sequence, limit: int) -> bool:
    """Whether at most ``limit`` edits turn ``a`` into ``b``."""
    return abs(len(a) - len(b)) <= limit and edit_distance(a, b) <= limit
