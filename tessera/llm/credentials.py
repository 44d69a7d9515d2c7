"""Problem 3: find credentials in code and configuration and mask them without touching anything else.

Lines that hold a literal which might be a credential (a credential word, a known prefix, a URL with
user info, a long mixed token, or a comment with a mixed token) are cut into lexical tokens: quoted literals, phrases, words,
URL parts, query parameters and key blocks.  A linear-chain conditional random field with shape and context features labels each
token; the Viterbi spans say exactly which characters are masked, and nothing is added to or taken from them.  Lines that continue
a literal (a trailing backslash or plus, a split ``concat!``) are labelled as one sequence, so the second half is masked too
and only the first line is reported; every other credential there is reported on its own line.  The lines after the BEGIN line of a
private key, up to its END line or the first line that cannot be one of its body, are tokens of the same sequence,
indented, quoted or on one line as well.

The field is trained at first use on a bounded sample (``SAMPLE`` lines) of generated, labelled lines: assignments,
calls, headers, URLs, comments, command lines and key blocks around credentials of many shapes, and the look-alikes
that are none (placeholders, references, names, hashes, ids, public keys).  No line of the tables is in it.

Defined results: null and empty texts hold nothing; line numbers count the pieces between "\\n"; rows with
a null id are not reported; repeated rows are reported once; texts of any length are read whole.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import spread

SAMPLE = 24_000
EPOCHS = 2

# Words that make a line worth labelling, prefixes of issued keys, and words features may name (fixed values).
_GATE = re.compile(
    r"(?i)pass(?:w|phrase|code|\b|[_-])|_pass\b|pwd|\bpw\b|secret|credential|api[_-]?key|(?:access|signing|cert|private|encryption|account|shared|ssh|master|license|storage)[_ -]?key|key_?pem|"
    r"(?:auth|private|access|refresh|bearer|session|bot|deploy|api|id|npm|_)_?token\b|[_-]token\b[\"']?\s*(?:=|:)|\btoken[\"']?\s*[=:>]\s*[\"']?[A-Za-z0-9]|\bauth\b|authorization|\bbearer\b|\bbasic\s|\blogin\b|"
    r"://[^\s/@:\"']*:[^\s/@\"']+@|begin [a-z ]*private|\bcreds?\b|\bidentified by\b|/bot\d|\s-u\s+[^\s:]+:\S|\s-[paw] '?(?=[^\s'\"]*\d)(?=[^\s'\"]*[a-z])[^\s'\"$/:]{6,}|[?&](?:api)?key="
)
_PREFIX = re.compile(
    r"(?:^|[^A-Za-z0-9])((?:AKIA|ASIA)[A-Z0-9]{6,}|gh[pousr]_\w{6,}|github_pat_\w{8,}|sk[-_]\w[\w-]{8,}|xox[a-z]-[\w-]{8,}|glpat-[\w-]{8,}|AIza[\w-]{10,}|eyJ[\w-]{8,}|SG\.[\w-]{8,}|hf_\w{8,}|npm_\w{8,}|pypi-[\w-]{8,}|dop_v1_\w{8,}|shp[a-z]{2}_\w{8,}|whsec_\w{8,}|"
    r"\w{2,6}_(?:live|test|prod)_\w{6,}|[a-z]{2,4}\d{1,2}\.[A-Za-z0-9][\w-]{7,})"
)
_MIXED = re.compile(r"[A-Za-z0-9+/]{18,}")
_COMMENT = re.compile(r"(?:#|//|--|/\*|<!--)[ \t][^\n]*")
_COMMENT_TOKEN = re.compile(r"(?<![\w.-])(?=[^\s\d]*\d)(?=[^\sA-Za-z]*[A-Za-z])[^\s()\[\]{}<>/.,:;\"'`]{8,}")
_WORDS = (
    "password passwd passphrase pass pwd pw secret token key api access private signing client auth authorization basic bearer login user username "
    "cert pem aws db hook webhook credential credentials cred old tmp remove fixme rotate field name header type kind id size length hash digest etag checksum integrity build request "
    "merkle root genesis tree commit sha version url uri dsn remote endpoint host image registry pad unk eos sep bos mask public env environ getenv var vault param path file expected format prompt label "
    "encode decode hint policy reset change new confirm count limit expires ttl algorithm issuer session ssh machine docker prompt message label error default temporary hardcoded credentials license storage bot"
).split()
_KNOWN = frozenset(_WORDS)
_CREDENTIAL = frozenset("password passwd passphrase pass pwd pw secret token key auth".split())

_PEM = r"-----BEGIN [A-Z0-9 ]+-----(?:(?:\\[nr]|[A-Za-z0-9+/=])*(?:-----END [A-Z0-9 ]+-----(?:\\[nr])*)?)"
_TOKEN = re.compile(rf"(?P<pem>{_PEM})" r"|(?P<q>[\"'`])|(?P<url>[A-Za-z][\w+.-]*://[^\s\"'`<>]*)|(?P<word>[^\s\"'`=,;()\[\]{}<>|\\]+(?:={1,2}(?=[\s\"'`]|$))?)|(?P<p>\\$|[=,;()\[\]{}<>|\\])")
_STRING = {q: re.compile(rf"{q}((?:[^{q}\\]|\\.)*){q}") for q in "\"'`"}
_URL = re.compile(r"([A-Za-z][\w+.-]*://)([^\s/@:]*):([^\s/@]*|\$\{[^}]*\})@")
_PLACEHOLDER = re.compile(r"^(?:\$\{.*|\$\(.*|\$[A-Za-z_]\w*|\{\{.*|%[({].*|<.*>?|\*+|[xX.]{4,}|\.{3}|#\{.*|__\w+__|(?i:your[-_ ].*|change[-_]?me|replace[-_]?me|todo|example|none|null|true|false|redacted|dummy|placeholder|xxx+|string|str|password|secret|token))$")
_SPLIT = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_OWNER = re.compile(r"(?i)pass|pwd|\bpw\b|secret|login|key\b|auth_?token|private_?token")
#: Plain identifiers and types; a feature.
_NAME = re.compile(r"^[&*]?(?:(?:[A-Z][a-z]+){1,5}|[a-z]+\d*(?:[_.:]+[a-z]+\d*)*)$")
_UUID = re.compile(r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$")
_HEX = re.compile(r"^[0-9a-fA-F]+$")


_QUERY = re.compile(r"([?&;])([\w.~%-]+)(=)([^&;\s]*)")
_TAIL = re.compile(r"(?<=/)(?=[\w.:+-]*\d)(?=[\w.:+-]*[A-Za-z])[\w:+-]{12,}(?=/?$|/\w{1,16}$)")
_HOOKS = re.compile(r"(?i)hook|/bot\d|/services/")
_PARAMETER = re.compile(r"(.+)(&)([A-Za-z_][\w-]*)")
_PHRASE = re.compile(r"[A-Za-z]+(?:[ -][A-Za-z]+){2,}")
# Words of messages rather than of passphrases (fixed values).
_SAID = frozenset("the a an is are be must should was your you this that for of to in and or not no please enter invalid missing required expired wrong incorrect use with when if at least has have can".split())


class Token:
    __slots__ = ("text", "at", "kind", "extra")

    def __init__(self, text: str, at: int, kind: str, extra: tuple[str, ...] = ()):
        self.text, self.at, self.kind, self.extra = text, at, kind, extra


def _link(text: str, base: int) -> list[Token]:
    """Parts of an address without user info: its front, a long mixed end of its path, and query parameters."""
    q = next((i for i, c in enumerate(text) if c in "?#"), len(text))
    tail = _TAIL.search(text, 0, q)
    front = tail.start() if tail else q
    out = [Token(text[:front], base, "link")]
    if tail:
        out.append(Token(tail[0], base + front, "tail", ("hook" if _HOOKS.search(text, 0, tail.end()) else "nohook",)))
        if tail.end() < q:
            out.append(Token(text[tail.end() : q], base + tail.end(), "link"))
    for m in _QUERY.finditer(text, q):
        out += [Token(m[2], base + m.start(2), "word"), Token("=", base + m.start(3), "p")]
        if m[4]:
            out.append(Token(m[4], base + m.start(4), "word"))
    return out


def tokens_of(s: str, base: int = 0, inside: bool = False) -> list[Token]:
    """Lexical tokens of a line with their places; quoted text without inner structure is one literal."""
    out: list[Token] = []
    at, n = 0, len(s)
    while at < n:
        m = _TOKEN.search(s, at)
        if not m:
            break
        kind = m.lastgroup
        start, at = m.start(), m.end()
        if kind == "q":
            q = _STRING[m[0]].match(s, start) if not inside else None
            if q is None:
                continue
            inner = q[1]
            at = q.end()
            if inner:
                structured = "://" in inner or ("=" in inner.rstrip("=") and " " not in inner) or (":" in inner and " " in inner) or m[0] == "`" or " " in inner.strip()
                if inner.startswith("-----BEGIN") or not structured:
                    out.append(Token(inner, base + start + 1, "lit"))
                elif _PHRASE.fullmatch(inner) and out and out[-1].text in ("=", ":") and (own := next((t for t in reversed(out) if t.kind != "p"), None)) is not None and _OWNER.search(own.text):
                    said = sum(w.lower() in _SAID for w in re.split("[ -]", inner))
                    out.append(Token(inner, base + start + 1, "phrase", (f"said:{min(said, 2)}", f"words:{min(inner.count(' ') + inner.count('-') + 1, 7)}", "upper" if inner[0].isupper() else "lower")))
                else:
                    out += tokens_of(inner, base + start + 1, True)
            continue
        text = m[0]
        if kind == "url":
            u = _URL.match(text)
            if u:
                out.append(Token(u[1], base + start, "scheme"))
                out.append(Token(u[2], base + start + u.start(2), "urluser"))
                out.append(Token(u[3], base + start + u.start(3), "urlpw"))
                out.append(Token(text[u.end() :], base + start + u.end(), "host"))
            else:
                out += _link(text, base + start)
            continue
        if kind == "word":
            while len(text) > 1 and text[-1] in ":.!?" and not (text[-1] == "!" and any(c.isdigit() for c in text)):
                text = text[:-1]
            end = start + len(text)
            if s[at : at + 1] == "=" and (m := _PARAMETER.fullmatch(text)):
                out += [Token(m[1], base + start, "word"), Token("&", base + start + m.start(2), "p"), Token(m[3], base + start + m.start(3), "word")]
            else:
                out.append(Token(text, base + start, "word"))
            if end < at:
                out.append(Token(s[end:at], base + end, "p"))
            continue
        out.append(Token(text, base + start, kind if kind == "pem" else "p"))
    return out


@lru_cache(50_000)
def _parts(text: str) -> tuple[str, ...]:
    """Known words of an identifier, last first; others as '?'."""
    got: list[str] = []
    for w in [w.lower() for w in _SPLIT.findall(text)][-4:]:
        tail = next((x for x in ("password", "passwd", "pass", "secret", "token", "key", "pwd") if w.endswith(x) and len(w) > len(x)), None) if w not in _KNOWN else None
        got += [w] if tail is None else [w[: -len(tail)], tail]
    return tuple(w if w in _KNOWN else "?" for w in reversed(got))


def _entropy(text: str) -> float:
    n = len(text)
    counts: dict[str, int] = {}
    for c in text:
        counts[c] = counts.get(c, 0) + 1
    return -sum(c / n * math.log2(c / n) for c in counts.values())


@lru_cache(50_000)
def _shape(text: str, kind: str) -> tuple[str, ...]:
    """Features of a token by itself."""
    if kind == "pem":
        return ("pem:" + ("private" if "PRIVATE KEY" in text[:60] else "public"),)
    if kind == "p":
        return ("p:" + text[:2],)
    f = ["kind:" + kind]
    if "-----BEGIN" in text:
        f.append("pem:" + ("private" if "PRIVATE KEY" in text[:70] else "public"))
        return tuple(f)
    n = len(text)
    lower, upper, digit = (sum(map(g, text)) for g in (str.islower, str.isupper, str.isdigit))
    special = n - lower - upper - digit
    mix = "".join(c for c, k in zip("aA0*", (lower, upper, digit, special)) if k)
    size = "0" if n < 4 else "4" if n < 6 else "6" if n < 8 else "8" if n < 12 else "12" if n < 18 else "18" if n < 28 else "28" if n < 44 else "44"
    f += ["mix:" + mix, "size:" + size, f"mix,size:{mix},{size}"]
    if _PLACEHOLDER.match(text):
        f.append("placeholder")
    if _PREFIX.match(text):
        f.append("issued")
    if _UUID.match(text):
        f.append("uuid")
    if n >= 16 and _HEX.match(text):
        f.append("hex")
    if n >= 10:
        f.append(f"bits:{int(_entropy(text))}")
    if text.startswith(("sha512-", "sha256-", "sha1-", "sha384-", "SHA256:")):
        f.append("integrity")
    if text.startswith("AAAA") and n > 40:
        f.append("publickey")
    if "/" in text and all(p.replace("-", "").replace(".", "").replace("_", "").isalpha() for p in text.split("/") if p):
        f.append("path")
    words = [w for w in re.split(r"[^A-Za-z]+", text) if w]
    if words and not digit and all(w.islower() or w.isupper() or w.istitle() for w in words) and not set(text) - set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ_-.:"):
        f.append("wordy")
    if "(" in text or "::" in text or (text.count(".") and text.replace(".", "").replace("_", "").isalpha()):
        f.append("code")
    if n < 26:
        f += ["w:" + w for w in _parts(text) if w != "?"][:3]
    return tuple(f)


def features(seq: list[Token], line: str) -> list[list[str]]:
    """Features of every token of a sequence: its shape, the words that own it, its neighbours, and the line's kind."""
    lead = line.lstrip("+- \t")[:2]
    comment = "comment" if lead[:1] == "#" or lead in ("//", "/*", "--", "* ", "; ") else ""
    out = []
    owners: list[tuple[str, ...]] = []
    sep = "^"
    for i, t in enumerate(seq):
        if t.kind in _BODY_KINDS:
            out.append([*t.extra, f"{t.kind},{seq[i - 1].kind}", "bias"])
            continue
        shape = _shape(t.text, t.kind) + tuple(f"{t.kind},{x}" for x in t.extra)
        f = [*shape]
        if t.kind != "p":
            strong = [x for x in shape if x.startswith(("mix", "placeholder", "issued", "uuid", "hex", "integrity", "wordy", "path", "kind", "pem", "publickey", "code", "tail,", "phrase,"))]
            f.append("sep:" + sep)
            for back in (1, 2, 3):
                own = owners[-back] if len(owners) >= back else ("^",)
                f += [f"o{back}:{w}" for w in own]
                f.append(f"o{back}last:{own[0] if own else '-'}")
                if back == 1 and own:
                    pair = ",".join(own[:2])
                    f.append("o1pair:" + pair)
                    f += [f"o1last,{x}:{own[0]}" for x in strong]
                    f.append(f"o1last,sep:{own[0]},{sep}")
                    if own[0] == "?" and not _CREDENTIAL.isdisjoint(own):  # a credential word before an unknown ending
                        f += ["o1has"] + [f"o1has,{x}" for x in strong]
                if back == 2 and own:
                    f += [f"o2last,{x}:{own[0]}" for x in strong if x.startswith(("mix:", "issued", "placeholder", "wordy"))]
            if comment:
                f.append(comment)
                f += ["comment," + x for x in strong]
            n1 = seq[i + 1].text[:6] if i + 1 < len(seq) else "$"
            f.append("n1:" + (n1 if not n1[:1].isalnum() or n1 in _KNOWN else "?"))
            if t.kind in ("word", "lit") and _NAME.match(t.text):
                owned = any(_OWNER.search(x.text) for x in seq[max(0, i - 4) : i])
                f += ["name,owned"] if owned else ["name,unowned", f"name,unowned,sep:{sep}"]
            owners.append(_parts(t.text))
            sep = " "
        else:
            sep = t.text[-1:]
        f.append("bias")
        out.append(f)
    return out


class Field:
    """Linear-chain conditional random field over two labels (other, credential)."""

    def __init__(self, weights: dict[str, float] | None = None, moves: list[float] | None = None):
        self.w = weights or {}
        self.moves = moves or [0.0, 0.0, 0.0, 0.0]

    def scores(self, feats: list[list[str]]) -> list[float]:
        get = self.w.get
        return [sum([get(x, 0.0) for x in f]) for f in feats]

    def viterbi(self, s: list[float]) -> list[int]:
        """Best labels, given the score of the credential label at each token (the other's is 0)."""
        m00, m01, m10, m11 = self.moves
        a, b, back = 0.0, s[0], []
        for x in s[1:]:
            ab, bb = a + m00, b + m10
            ac, bc = a + m01, b + m11
            back.append((0 if ab >= bb else 1, 0 if ac >= bc else 1))
            a, b = max(ab, bb), max(ac, bc) + x
        y = 0 if a >= b else 1
        out = [y]
        for p in reversed(back):
            y = p[y]
            out.append(y)
        return out[::-1]

    def train(self, data: list[tuple[list[list[str]], list[int]]], epochs: int, seed: int, rate: float = 0.4, ridge: float = 1e-5) -> None:
        """Gradient ascent on the log-likelihood with per-weight step sizes; the result is the mean of the weights at several points of the last round."""
        rng = random.Random(seed)
        w, m = self.w, self.moves
        square: dict[str, float] = {}
        msq = [1e-6] * 4
        total: dict[str, float] = {}
        total_m, points = [0.0] * 4, 0
        every = max(1, len(data) // 16)
        for epoch in range(epochs):
            rng.shuffle(data)
            for at, (feats, gold) in enumerate(data, 1):
                if epoch == epochs - 1 and at % every == 0:
                    for x, v in w.items():
                        total[x] = total.get(x, 0.0) + v
                    total_m, points = [a + b for a, b in zip(total_m, m)], points + 1
                s = self.scores(feats)
                n = len(s)
                e = [math.exp(x) for x in m]
                # forward and backward messages, each scaled to sum to one
                fwd = []
                a0, a1 = 1.0, math.exp(min(30.0, s[0]))
                z = a0 + a1
                fwd.append((a0 / z, a1 / z))
                for x in s[1:]:
                    p0, p1 = fwd[-1]
                    a0, a1 = p0 * e[0] + p1 * e[2], (p0 * e[1] + p1 * e[3]) * math.exp(min(30.0, x))
                    z = a0 + a1
                    fwd.append((a0 / z, a1 / z))
                b0 = b1 = 1.0
                grad = [0.0] * 4
                for i in range(n - 1, -1, -1):
                    p0, p1 = fwd[i][0] * b0, fwd[i][1] * b1
                    q = p1 / (p0 + p1)
                    g = gold[i] - q
                    if abs(g) > 1e-3:
                        for x in feats[i]:
                            sq = square.get(x, 0.0) + g * g
                            square[x] = sq
                            w[x] = w.get(x, 0.0) * (1 - ridge) + rate * g / math.sqrt(sq)
                    if i:
                        r = math.exp(min(30.0, s[i]))
                        f0, f1 = fwd[i - 1]
                        c = [f0 * e[0] * b0, f0 * e[1] * r * b1, f1 * e[2] * b0, f1 * e[3] * r * b1]
                        z = sum(c)
                        for k in range(4):
                            grad[k] -= c[k] / z
                        grad[2 * gold[i - 1] + gold[i]] += 1
                        n0, n1 = e[0] * b0 + e[1] * r * b1, e[2] * b0 + e[3] * r * b1
                        z = n0 + n1
                        b0, b1 = n0 / z, n1 / z
                for k in range(4):
                    if grad[k]:
                        msq[k] += grad[k] * grad[k]
                        m[k] += 0.1 * grad[k] / math.sqrt(msq[k])
        if points:
            self.w, self.moves = {x: v / points for x, v in total.items()}, [a / points for a in total_m]


# ---- generated training lines -------------------------------------------------------------------


_SYLLABLES = [a + b + c for a in "bcdfghklmnprstvw" for b in "aeiou" for c in ("", "", "n", "r", "l", "s")]


def _word(r: random.Random) -> str:
    return "".join(r.choices(_SYLLABLES, k=r.randint(2, 3)))


def _chars(r: random.Random, alphabet: str, lo: int, hi: int) -> str:
    return "".join(r.choices(alphabet, k=r.randint(lo, hi)))


_AL, _UP, _DI = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _issued(r: random.Random) -> str:
    """A key as services issue them."""
    every = _AL + _UP + _DI
    return [
        lambda: r.choice(["AKIA", "ASIA"]) + _chars(r, _UP + _DI, 12, 16), lambda: r.choice(["ghp_", "gho_", "ghs_", "hf_", "npm_", "glpat-", "sk-", "xoxb-", "whsec_", "shpat_", "github_pat_", "SG.", "AIza"]) + _chars(r, every, 10, 36),
        lambda: _chars(r, _AL, 2, 5) + r.choice(["_live_", "_test_", "_prod_"]) + _chars(r, every, 10, 30), lambda: _chars(r, _AL, 2, 4) + _chars(r, _DI, 1, 2) + "." + _chars(r, every, 10, 40), lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 32, 40, 48, 64]))), lambda: _chars(r, every + "+/", 36, 44),
        lambda: _chars(r, _UP + _DI, 16, 24), lambda: _chars(r, _DI + "abcdef", 8, 10) + ":" + _chars(r, every + "-_", 32, 38), lambda: _chars(r, every, 16, 48), lambda: _chars(r, every + "-_", 20, 43), lambda: _chars(r, _DI, 8, 10) + ":AA" + _chars(r, every + "-_", 33, 33),
    ][r.randrange(11)]()


def _typed(r: random.Random) -> str:
    """A password as people make them."""
    w, leet = _word(r), {"a": "4", "e": "3", "o": "0", "i": "1", "s": "5"}
    return r.choice([
        w.capitalize() + _chars(r, _DI, 1, 4) + r.choice(["", "!", "?", "$", "#", "!!", "@"]), "".join(leet.get(c, c) if r.random() < 0.6 else c for c in w) + _chars(r, _DI, 1, 4) + r.choice(["", "!", "#"]), w + r.choice(["", "-", "_", "."]) + _word(r) + r.choice(["", "-", "_", "."]) + _chars(r, _DI, 2, 4),
        w + r.choice("-_@#") + _word(r).upper() + _chars(r, _DI, 0, 3), _word(r).capitalize() + _word(r).capitalize() + _chars(r, _DI, 1, 3), _chars(r, _AL + _UP + _DI + "*&!%+$#", 8, 14), _chars(r, _AL + _UP + _DI, 9, 20), _chars(r, _AL + _UP + _DI + "!#%-_", 12, 24),
        _word(r).capitalize() + _chars(r, _DI, 2, 4) + _word(r) + r.choice("!?$#&"), f"{_word(r)}&{_chars(r, _DI, 1, 3)}{_chars(r, _AL + _UP, 2, 6)}",
    ])


def _secret(r: random.Random) -> str:
    return _issued(r) if r.random() < 0.6 else _typed(r)


def _harmless(r: random.Random, key: str) -> str:
    """A literal under a credential's key that is none."""
    up = key.upper()
    return r.choice([f"${{{up}}}", f"<{key}>", f"<your-{key}>", f"your-{key}", f"YOUR_{up}", "*" * r.randint(4, 16), "x" * r.randint(4, 20), f"{{{{ vault.{key} }}}}", f"{{{{ {key} }}}}", f"{{{{ .Values.{key} }}}}", f"$(cat /run/secrets/{key})", f"${up}", f"${{{up}:-}}", "changeme", "REPLACE_ME", f"%({key})s", "", "...", f"vault:secret/data/{_word(r)}#{key}", f"!Ref {up}", f"{{{key}}}", "null", "none"])


def _kept(r: random.Random) -> str:
    """A plain value that says nothing secret."""
    return r.choice(["x-api-key", "bearer", "<PAD>", "login_form", f"prod/{_word(r)}", _word(r), f"{_word(r)} {_word(r)} of {_word(r)}", f"{_word(r)}_{_word(r)}", "Authorization", f"{_word(r)}/{_word(r)}", f"{_word(r)}-{_word(r)}"])


def _hash(r: random.Random) -> str:
    return r.choice([_chars(r, "0123456789abcdef", n, n) for n in (32, 40, 64)] + ["-".join(_chars(r, "0123456789abcdef", n, n) for n in (8, 4, 4, 4, 12))])


def _style(r: random.Random, key: str) -> str:
    parts = key.split("_")
    return r.choice([key, key, key, key.upper(), parts[0] + "".join(p.capitalize() for p in parts[1:]), key.replace("_", "-")])


_KEYS = "password passwd db_pass db_password pw pwd login api_key apikey secret_key client_secret signing_secret webhook_secret auth_token access_token private_token access_key signing_key secret_access_key passphrase account_key bot_token encryption_key smtp_password refresh_token deploy_token session_secret license_key storage_key".split()
_NAMES = "password_field secret_name token_type token_kind api_key_header pad_token eos_token unk_token key_name password_label token_count key_path secret_path login_url auth_type key_type token_name password_hint secret_kind auth_header mask_token sep_token password_policy token_url key_file secret_ref auth_mode".split()
_IDS = "digest etag build_id request_id merkle_root checksum commit tree sha256 content_hash trace_id object_id revision image_id fingerprint".split()
# Common words of programs, for names (fixed values).
_TERMS = "user account order item cache file config client server request response session query table index node graph list map queue worker task job event log message page image model field value name count size limit path host port time status state level group role rule plan step batch block buffer stream frame".split()


def _name(r: random.Random, tail: str | None = None) -> str:
    """An identifier in one of the usual styles."""
    parts = [r.choice(_TERMS) if r.random() < 0.6 else _word(r) for _ in range(r.randint(1, 2))] + ([tail] if tail else [])
    style = r.randrange(4)
    return "_".join(parts) if style < 2 else parts[0] + "".join(p.capitalize() for p in parts[1:]) if style == 2 else "".join(p.capitalize() for p in parts)


def generated_line(r: random.Random) -> tuple[str, list[str]]:
    """(line, the literals in it that are credentials)."""
    k = r.random()
    if k >= 0.54:
        return _special_line(r)
    good: list[str] = []
    if k < 0.40:
        key = r.choice(_KEYS) if r.random() < 0.8 else _word(r) + "_" + r.choice(["pwd", "password", "secret", "token", "pass", "api_key"])
        human = "pass" in key or "pw" in key or key == "login"
        value = _typed(r) if human and r.random() < 0.7 else _secret(r)
        key += r.choice(["_base", "_v2", "_prod", "_old", "2"]) if r.random() < 0.08 else ""
        good = [value]
        if k >= 0.26:
            value, good = _harmless(r, key), []
    elif k < 0.45:
        key, value = r.choice(_NAMES), _kept(r)
    elif k < 0.49:
        key, value = r.choice(_IDS), _hash(r)
    else:
        key, value = _name(r, r.choice([None, "token", "author", "tokenizer", "key", "passes", "passenger"])), r.choice([_kept(r), f"{_word(r)} {_word(r)} for {_word(r)}", _word(r), _name(r)])
    key = _style(r, key)
    q = r.choice("\"\"'")
    up = key.upper().replace("-", "_")
    line = r.choice([
        f"{key} = {q}{value}{q}", f'const {up}: &str = "{value}";', f"  {key}: {value}", f"  {key}: {q}{value}{q},", f"export {up}={value}", f"{up}={value}", f'os.environ["{up}"] = "{value}"', f'client = Client({key}="{value}")', f'.{key}("{value}")', f'let {key} = "{value}".to_string();',
        f'  "{key}": "{value}",', f"{up}='{value}'", f"Set `{key}={value}` and restart the server.", f"const {key} = {q}{value}{q};", f"<{key}>{value}</{key}>", f'<add key="{key}" value="{value}" />', f"private static final String {up} = \"{value}\";", f"--{key.replace('_', '-')} {q}{value}{q}", f'${key.replace("-", "_")} = "{value}";',
        f"#define {up} \"{value}\"", f"ARG {up}={value}", f"jdbc.{key}={value}", f"{key} := \"{value}\"",
    ])
    if good and r.random() < 0.08:
        half = len(value) // 2
        line = r.choice([f'{key} = "{value[:half]}" \\ "{value[half:]}"', f'{key} = "{value[:half]}" + "{value[half:]}"', f'let {key} = concat!("{value[:half]}", "{value[half:]}");'])
        good = [value[:half], value[half:]]
    return line, [g for g in good if g]


def _pem(r: random.Random) -> tuple[str, str]:
    """(kind, body) of a private key."""
    return r.choice(["RSA PRIVATE KEY", "PRIVATE KEY", "EC PRIVATE KEY", "OPENSSH PRIVATE KEY", "DSA PRIVATE KEY", "ENCRYPTED PRIVATE KEY"]), "\\n".join(_chars(r, _AL + _UP + _DI + "+/", 40, 64) for _ in range(r.randint(1, 3)))


def _said_line(r: random.Random) -> str:
    """A remark about credentials that holds none."""
    n = lambda: _name(r)
    return r.choice([
        f"rotate the {r.choice(['password', 'token', 'key'])} before the release", f"the token of the {_word(r)} is read from the vault", f"see {n()} for how the password is checked", f"pass the {n()} to {n()}()", f"never log the secret of a {_word(r)}", f"reads {r.choice(['API_KEY', 'DB_PASSWORD', 'AUTH_TOKEN'])} from the environment",
        f"basic {_word(r)} of the {n()}", f"login is handled by {n()}", f"{n()} v{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)} needs auth", f"issue {r.randint(10, 9999)}: key of {n()} is lost", f"fixed in {_chars(r, '0123456789abcdef', 7, 40)}", f"author key {_word(r)}{r.randint(1, 99)}",
    ])


def _remark(r: random.Random) -> str:
    """What a comment says before a credential."""
    kind = r.choice(["", "", "the", "new", "previous", "current", "default", "admin", "root", "test", "temporary", "hardcoded", "dev", "db"])
    what = r.choice(["password", "password", "pw", "key", "key", "token", "secret", "api key", "login", "creds", "credentials", "auth token", "access key"])
    return r.choice([f"{kind} {what}{r.choice([' is', ' was', ':', ' =', '', ' set to', ' is now'])}", r.choice(["use", "try", "expects", "run with", "works with"]) + f" {what}", r.choice(["FIXME", "XXX", "HACK", "TODO", "FIXME:", "HACK:"]), "default login admin /"]).strip()


def _code_line(r: random.Random) -> str:
    """A line of a program whose names speak of credentials, or not, without any value."""
    t = r.choice(["token", "key", "secret", "password", "auth", "tokenizer", "author", "passes", "credentials", "login"])
    n, c = (lambda tail=None: _name(r, tail)), (lambda: _name(r).capitalize())
    i = r.randint(1, 9999)
    kind = r.choice(["u8", "u32", "u64", "i32", "f32", "f64", "usize", "bool", "&str", "&u64", "&f32", "&i32", "String", "&String", "Vec<u8>", "&[u8]", f"&{c()}", c(), f"Option<{c()}>", f"&mut {c()}", f"Result<{c()}>"])
    return r.choice([
        f"pub fn {n(t)}(&self, {n()}: {c()}) -> Result<{c()}, Error> {{", f"async fn {n(t)}({n()}: Option<&str>) -> {c()} {{", f"{r.choice(['fn', 'async fn', 'pub fn', 'pub async fn'])} {n()}({n(t)}: {kind}) -> {r.choice([kind, c()])} {{", f"fn {n(t)}(mut {n(t)}: {kind}, {n(t)}: {kind}) {{", f"function {n()}({n(t)}: {r.choice(['string', 'number', c()])}): {c()} {{", f"def {n()}({n(t)}: {r.choice(['str', 'int', c()])}) -> {c()}:", f"let {n(t)} = self.{n()}.{n(t)}({i})?;", f"let mut {n(t)}: Vec<{c()}> = Vec::with_capacity({i});", f"{n(t)}.push({n()}.clone());", f"    pub {n(t)}: Option<{c()}>,", f"impl {c()} for {c()} {{",
        f"use crate::{n()}::{{{c()}, {c()}}};", f"def {n(t)}(self, {n()}, limit={i}):", f"from {n()}.{n(t)} import {c()}", f"self.{n(t)} = {n(t)}", f"return {{\"{n(t)}\": {n()}, \"{n()}\": {i}}}", f"{n(t)}[i] = {n()}.{n()}", f"if {n(t)} is None:", f"for {n(t)} in {n()}.{n()}:", f"assert {n(t)}({i}) == {n()}",
        f"raise ValueError(\"{n()} {t} of {n()}\")", f"logger.info(\"{t} of %s\", {n()})", f"const {n(t)} = async ({n()}) => {{", f"export function {n(t)}({n()}: {c()}): {c()} {{", f"const {{ {n(t)}, {n()} }} = this.props;", f"if (!{n(t)}) return null;", f"func ({n()[:1]} *{c()}) {n(t)}({n()} string) error {{", f"if {n(t)} != nil {{",
        f"public String get{c()}() {{ return {n(t)}; }}", f"private final {c()} {n(t)};", f"\"{n(t)}\": {i},", f"\"{n(t)}\": [\"{n()}\", \"{n()}\"],", f"  {n(t)}: {i}", f"  {n(t)}: true", f"{n(t)}:", f"- {n(t)}", f"SELECT {n(t)}, {n()} FROM {n()} WHERE {n(t)} = ?", f"ALTER TABLE {n()} ADD COLUMN {n(t)} text;", f"{n()} --{n(t).replace('_', '-')} \"${n(t).upper()}\"",
        f"echo \"${{{n(t).upper()}}}\" | base64 -d", f"{n(t)} = {n()}({n()}, {i})", f"{n(t)} = {n()}", f"{n(t)} = config[\"{n(t)}\"]", f"{n(t)} == expected_{n(t)}", f"@{n(t)}.{n()}", f"{n(t)}({n()}, {n()})", f"{n(t)}, {n()} = {n()}.split(\":\")", f"@@ -{i},{r.randint(1, 99)} +{i},{r.randint(1, 99)} @@ fn {n(t)}({n()}: {c()}) {{", f"match {n(t)} {{", f"let {n(t)} = {c()}::new(\"{n()}\");",
        f"password: String,", f"password: &str,", f"password: string;", f"char *password;", f"secret: Option<String>", f"String password = request.getParameter(\"password\");", f"password = getpass.getpass()", f"password = input(\"{t}: \")", f"password = os.environ[\"PASSWORD\"]", f"let token = std::env::var(\"{n().upper()}_TOKEN\")?;", "const apiKey = process.env.API_KEY;",
        f"secret = get_secret(\"{_word(r)}/{_word(r)}\")", f"{n(t)} = {{ version = \"{r.randint(0, 20)}.{r.randint(0, 20)}\", features = [\"{n()}\"] }}", f"We {_word(r)} the {t} twice because the {n()} may come later.", f"{c()}Token{c()}, {c()}Key", f"assert_eq!({n(t)}({i}), {n()});",
    ])


def _special_line(r: random.Random) -> tuple[str, list[str]]:
    w = lambda: _word(r)
    every = _AL + _UP + _DI
    b64 = _chars(r, every, 18, 32) + r.choice(["", "=", "=="])
    s, pw = _secret(r), _typed(r)
    jwt = f"eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9.eyJ{_chars(r, every, 20, 40)}.{_chars(r, every + '-_', 30, 44)}"
    kind, body = _pem(r)
    pem = f"-----BEGIN {kind}-----\\n{body}\\n-----END {kind}-----\\n"
    public = r.choice(["PUBLIC KEY", "CERTIFICATE", "RSA PUBLIC KEY", "CERTIFICATE REQUEST"])
    pub = f"-----BEGIN {public}-----"
    inner = _chars(r, every + ("" if r.random() < 0.3 else "-_.!"), 8, 18) if r.random() < 0.7 else _word(r) + _chars(r, _DI, 2, 4)
    scheme = r.choice(["postgres", "postgresql", "mysql", "redis", "amqp", "https", "mongodb", "ftp", "mongodb+srv"])
    host = lambda: f"{w()}.{r.choice(['example', 'internal', 'test', 'local', 'io'])}"
    mark = r.choice(["#", "//", "--", "/*", ";"])
    hook = _chars(r, every, 20, 32)
    known = r.choice([r.choice(["AKIA", "ASIA"]) + _chars(r, _UP + _DI, 16, 16), r.choice(["ghp_", "gho_", "glpat-", "xoxb-", "sk_live_", "AIza"]) + _chars(r, every, 24, 36)])
    phrase = " ".join(w() if r.random() < 0.5 else r.choice(["correct", "horse", "battery", "purple", "river", "monkey", "silver", "garden", "winter", "coffee", "happy", "dragon"]) for _ in range(r.randint(3, 6)))
    env = r.choice(["DB_PASSWORD", "PASSWORD", "MYSQL_ROOT_PASSWORD", "PGPASSWORD", "REDIS_PASS", "SMTP_PASSWORD", f"{w().upper()}_PASSWORD"])
    weak = r.choice(["letmein", "welcome", "qwerty", "iloveyou", "sunshine", "dragon", "monkey", "football", w(), w() + w()])
    yes = [
        (f'{r.choice(["url", "dsn", "remote", "endpoint"])} = "{scheme}://{w()}:{inner}@{host()}:{r.randint(1000, 9999)}/{w()}"', [inner]),
        (f"{r.choice(['url', 'dsn', 'DATABASE_URL', 'endpoint', 'git clone'])}{r.choice([': ', '=', ' '])}{scheme}://{w()}:{inner}@{host()}/{w()}", [inner]),
        (f"{r.choice(['Authorization', 'Proxy-Authorization'])}: Basic {b64}", [b64]), (f'    "Authorization": "Bearer {jwt}",', [jwt]), (f'headers = {{"Authorization": "{r.choice(["Token", "Bearer", "token"])} {s}"}}', [s]), (f'-H "{r.choice(["X-Api-Key", "X-Auth-Token", "PRIVATE-TOKEN"])}: {s}"', [s]),
        (f'curl -H "Authorization: Bearer {jwt}" https://{host()}/v1/{w()}', [jwt]), (f'curl -u {w()}:{pw} https://{host()}/{w()}', None), (f'  "auths": {{ "{host()}": {{ "auth": "{b64}" }} }}', [b64]), (f"//{host()}/:_authToken={s}", [s]),
        (f"docker run -e {w().upper()}_USER={w()} -e {env}={pw} {w()}", [pw]), (f"{w()} login --user{r.choice(['name', ''])} {w()} --password {pw}", [pw]), (f"{w()} login -u {w()} -p {pw}", [pw]), (f"  password {pw}", [pw]), (f"machine {host()} login {w()} password {pw}", [pw]), (f"sshpass -p {pw} ssh {w()}@{host()}", [pw]), (f"mysql -u {w()} --password={pw} {w()}", [pw]), (f"requirepass {pw}", [pw]), (f"{w()} -h {host()} -U {w()} {r.choice(['-P', '-p', '-a', '-w'])} {(qq := r.choice(['', chr(39)]))}{pw}{qq} {r.choice(['', w()])}", [pw]), (f"{w()}-cli {r.choice(['-a', '-p', '--pass', '--auth'])} {pw} {w()}", [pw]),
        (f"aws_secret_access_key{r.choice(['=', ' = '])}{(k40 := _chars(r, every + '+/', 40, 40))}", [k40]), (f"{mark} {_remark(r)} {s if r.random() < 0.6 else pw}{r.choice(['', '', '', ',', '.', ' ' + w(), ', ' + w() + ' ' + w()])}", None), (f"{mark} {_remark(r)} {s if r.random() < 0.6 else pw}", None), (f"{mark} {w()} {w()}{r.choice([':', '', ','])} {known}", [known]), (f"{w()} {known} {w()}", [known]), (f'{w()}("{known}", {w()})', [known]),
        (f"{mark} {w()} {w()} {(strong := _chars(r, every + '#!$%', 10, 20) + _chars(r, _DI, 1, 2) + _chars(r, _AL + _UP, 1, 2))} {r.choice(['', w()])}", [strong]), (f'{r.choice(["signing_key", "cert_key", "key_pem", "private_key"])} = "{pem}"', [pem]), (f'  "private_key": "{pem}",', [pem]), (f"export {r.choice(['SIGNING_KEY', 'PRIVATE_KEY', 'DEPLOY_KEY'])}={pem}", [pem]), (f"-----BEGIN {kind}-----", [f"-----BEGIN {kind}-----"]),
        (f"https://hooks.{w()}.{r.choice(['com', 'example'])}/services/{_chars(r, _UP + _DI, 5, 10)}/{_chars(r, _UP + _DI, 5, 10)}/{hook}", [hook]), (f'{r.choice(["url", "webhook", "hook"])} = "https://{host()}/{r.choice(["webhooks", "api/webhooks", "hooks"])}/{r.randint(10**8, 10**11)}/{hook}"', [hook]), (f"POST https://api.{w()}.org/bot{(bot := _chars(r, _DI, 8, 10) + ':AA' + _chars(r, every + '-_', 33, 33))}/sendMessage", None),
        (f"https://{host()}/v1/{w()}?{r.choice(['api_key', 'apikey', 'key', 'token', 'access_token', 'auth'])}={s}&{w()}={r.randint(1, 99)}", None), (f"?{r.choice(['api_key', 'access_token', 'token', 'secret'])}={(q := _chars(r, every, 10, 32))}&{w()}={r.randint(1, 99)}", [q]), (f'{r.choice(["password", "passphrase", "PASSWORD", "wallet_passphrase", "DB_PASSWORD"])}{r.choice([" = ", ": ", "="])}"{phrase}"', [phrase]),
        (f"{r.choice(['', 'export ', 'ENV ', '      - '])}{env}={weak}", [weak]), (f"<{(tag := r.choice(['password', 'secret', 'apiKey', 'token', 'passwd']))}>{pw}</{tag}>", [pw]), (f'INSERT INTO users ({w()}, password) VALUES (\'{w()}\', \'{pw}\');', [pw]), (f"CREATE USER {w()} IDENTIFIED BY '{pw}';", [pw]), (f"ALTER ROLE {w()} WITH PASSWORD '{pw}';", [pw]), (f'net.connect("{w()}", "{w()}", password="{pw}")', [pw]), (f'auth = ("{w()}", "{pw}")', [pw]), (f'send("{(iss := _chars(r, _AL, 2, 4) + _chars(r, _DI, 1, 2) + "." + _chars(r, every, 10, 40))}")', [iss]),
    ]
    no = [
        f"{scheme}://${{USER}}:${{PASS}}@{host()}:6379", f"{scheme}://{{user}}:{{password}}@{host()}", f"{scheme}://localhost/{w()}", f"{scheme}://{host()}:6379/{w()}", f"{scheme}://user:$PASSWORD@{host()}/{w()}", pub, f'cert = "{pub}\\n{body}\\n-----END {public}-----\\n"', f'checksum = "{_chars(r, "0123456789abcdef", 64, 64)}"',
        f"integrity: sha512-{_chars(r, every + '+/', 86, 86)}==", f'"integrity": "sha384-{_chars(r, every + "+/", 64, 64)}"', f"ssh-ed25519 AAAAC3NzaC1lZDI1NTE5AAAA{_chars(r, every + '+/', 44, 44)} {w()}@{w()}", f"ssh-rsa AAAAB3NzaC1yc2E{_chars(r, every + '+/', 80, 120)} {w()}@{w()}", f"SHA256:{_chars(r, every + '+/', 43, 43)}", f"{r.choice(['public_key', 'ssh_key', 'authorized_key'])} = {r.choice(['ssh-rsa', 'ssh-ed25519'])} AAAA{_chars(r, every + '+/', 60, 120)} {w()}", f'{r.choice(["public_key", "pubkey", "key"])}{r.choice([" = ", ": "])}"{r.choice(["ssh-rsa", "ssh-ed25519"])} AAAA{_chars(r, every + "+/", 60, 120)} {w()}@{w()}"', f"{w()} -p {r.randint(1, 65000)}:{r.randint(1, 65000)} {w()}", f"mkdir -p {w()}/{w()}", f"{w()} -a {w()} -w {r.randint(1, 99)}", f"ls -a {w()}_{w()}{r.randint(1, 9)}", f"tree {_chars(r, '0123456789abcdef', 40, 40)}", f"commit {_chars(r, '0123456789abcdef', 40, 40)}",
        f"{mark} {w()} {w()} {_chars(r, '0123456789abcdef', 40, 40)}", f'<img src="data:image/png;base64,{_chars(r, every + "+/", 60, 120)}">', f"{_chars(r, every + '+/', 24, 76)}{r.choice(['', '='])}", f"index {_chars(r, '0123456789abcdef', 7, 8)}..{_chars(r, '0123456789abcdef', 7, 8)} 100644", f"Authorization: Basic ${{{w().upper()}}}", "Authorization: Bearer <token>", f'-H "Authorization: Bearer ${w().upper()}_TOKEN"', f"docker run -e {env}=${w().upper()} app",
        f"{w()} login --user {w()} --password $PASSWORD", f"{w()} login -u $USER --password-stdin", f"  machine {host()}", f"  login {w()}", f"login: {w()}@{host()}", f"user = {w()}, login with {w()}", f"https://{host()}/{w()}/commit/{_chars(r, '0123456789abcdef', 40, 40)}", f"https://{host()}/{w()}/{w()}-{r.randint(1, 20)}.{r.randint(0, 9)}.{r.randint(0, 9)}-{_chars(r, 'abcdef' + _DI, 8, 12)}.tar.gz", f"https://{host()}/{w()}?{r.choice(['page', 'token_type', 'key_id', 'sort'])}={w()}&{w()}={r.randint(1, 99)}",
        f"https://{host()}/v1?api_key={{api_key}}&{w()}=1", f"https://{host()}/?token=${{TOKEN}}", f'{r.choice(["password", "passphrase", "password_error", "PASSWORD_MESSAGE"])}{r.choice([" = ", ": "])}"{r.choice(["the password must be at least", "please enter your password to", "invalid password for the", "this password is too short for", "your password has expired and must be", "password is required for the", "no password given for"])} {w()}"', f"<password>{{password}}</password>", f"<{(t2 := r.choice(['token', 'key', 'secret', 'author']))}>{w()}</{t2}>",
        f"{env}={r.choice(['$1', '${1}', '', '$(pass show ' + w() + ')', '${{ secrets.' + w().upper() + ' }}', '<password>', 'changeme'])}", f"sk-{w()}-{w()}", f"{mark} {_said_line(r)}", f"{_said_line(r)}", f"image: {host()}/{w()}/{w()}:{r.randint(1, 9)}.{r.randint(0, 20)}.{r.randint(0, 20)}", f"image: {w()}@sha256:{_chars(r, '0123456789abcdef', 64, 64)}", f"- uses: {w()}/{w()}@{_chars(r, '0123456789abcdef', 40, 40)}", f"{_chars(r, '0123456789abcdef', 40, 64)}  {w()}.tar.gz",
        f"secretKeyRef: {{ name: {w()}, key: {w()} }}", f"secretName: {w()}-tls", f"key: {w()}_{w()}", f"keys = [\"{w()}\", \"{w()}\"]", f"{mark} {w()} {w()} {w()}{r.randint(1, 9)} {w()} in v{r.randint(1, 9)}.{r.randint(0, 9)}", f"{mark} {w()}_{w()}_{r.randint(10, 999)} {w()} {w()}", f"{mark} see https://{host()}/{w()}/{r.randint(1, 9999)}", f"{mark} {'-'.join(_chars(r, '0123456789abcdef', n, n) for n in (8, 4, 4, 4, 12))} {w()}",
    ]
    k = r.random()
    if k < 0.42:
        line, good = r.choice(yes)
        if good is None:
            good = [x for x in (jwt, s, pw, bot) if x in line]
            good = ["bot" + g if g == bot else f"{g}" for g in good]
            if f":{pw}" in line:
                good = [next(t for t in re.split(r"\s", line) if t.endswith(f":{pw}"))]
        return line, good
    if k < 0.48:  # an object on one line
        names = [_name(r, r.choice([None, None, "token", "author", "key"])) for _ in range(r.randint(5, 25))]
        return "{" + ",".join(f'"{n}":{r.randint(1, 9999)}' if r.random() < 0.9 else f'"{n}": "{w()} {w()}"' for n in names) + "}", []
    return (r.choice(no) if k < 0.76 else r.choice(["", "", "    "]) + _code_line(r)), []


def generated_key(r: random.Random) -> tuple[str, set[int]]:
    """(text, places of its encoded lines and headers) of a private key over several lines, whole or cut, and what follows it."""
    kind, _ = _pem(r)
    width = r.choice([64, 64, 64, 70, 76])
    alphabet = _AL + _UP + _DI + "+/"
    lines = [_chars(r, alphabet, width, width) for _ in range(r.randint(0, 5))]
    whole = r.random() < 0.6
    if whole or r.random() < 0.5:
        lines.append(_chars(r, alphabet, 2, width - 1) + r.choice(["", "=", "=="]))
    if r.random() < 0.1:
        lines = [_chars(r, alphabet, 200, 900)]
    head = [] if r.random() < 0.85 else ["Proc-Type: 4,ENCRYPTED", f"DEK-Info: AES-128-CBC,{_chars(r, _DI + 'ABCDEF', 32, 32)}", ""]
    indent, q, tail = r.choice([("", "", ""), ("", "", ""), ("    ", "", ""), ("  ", '"', '\\n"'), ("  ", '"', '\\n" +'), ("  ", "'", "',")])
    text, places = f"{indent}{q}-----BEGIN {kind}-----{tail}\n", set()
    for x in [*head, *lines]:
        if x:
            places.add(len(text) + len(indent) + len(q))
        text += f"{indent}{q}{x}{tail}\n" if x else "\n"
    if whole:
        text += f"{indent}{q}-----END {kind}-----{tail}\n"
    n = lambda: _name(r)
    after = ["return", "break", "}", "end", "pass", "else", f"{n()}: {n()}", f"port: {r.randint(1, 9999)}", f"host: {_word(r)}.example", f"{n()} = {n()}", f"def {n()}():", "", f"{n()}()", f"return {n()}", _word(r), _word(r).capitalize(), n(), f"Name: {_word(r)}", f"export {n().upper()}={_word(r)}", f"# {_word(r)} {_word(r)}", f"{n()}: {r.choice(['true', 'null', '3'])}"]
    text += "".join(r.choice(["", indent]) + r.choice(after) + "\n" for _ in range(r.randint(0, 4)))
    return text, places


@lru_cache(4)
def trained(sample: int = SAMPLE, seed: int = 11) -> Field:
    """The field, trained on generated lines."""
    r = random.Random(seed)
    data = []
    for _ in range(sample):
        if r.random() < 0.06:
            text, good = generated_key(r)
            seq, first = _sequence(text, 0, 0, False)[:2]
            data.append((features(seq, first), [int(t.text.startswith("-----BEGIN ") if t.kind not in _BODY_KINDS else t.at in good) for t in seq]))
            continue
        line, good = generated_line(r)
        line = r.choice(["", "", "    ", "  "]) + line
        seq = tokens_of(line)
        if not seq:
            continue
        spans = []
        for g in good:
            at = line.find(g)
            spans.append((at, at + len(g)))
        gold = [int(t.kind != "p" and any(a <= t.at and t.at + len(t.text) <= b for a, b in spans)) for t in seq]
        data.append((features(seq, line), gold))
    f = Field()
    f.train(data, EPOCHS, seed)
    f.w = {k: v for k, v in f.w.items() if abs(v) > 1e-4}
    return f


# ---- application ----------------------------------------------------------------------------------


def _mixed(m: str) -> bool:
    return any(c.isdigit() for c in m) and any(c.isalpha() for c in m) and not m.isalpha()


_HINTS = "pass pwd pw secret cred key token auth bearer basic login :// private akia asia ghp_ gho_ ghs_ ghu_ ghr_ github_pat_ sk- sk_ xox glpat- aiza eyj sg. hf_ npm_ pypi- dop_v1_ shp whsec_ _live_ _test_ _prod_ identified /bot".split() + [" -u ", "\t-u ", " -p ", " -a ", " -w "]
#: The only form of ``_PREFIX`` without a hint, less what stands before it.
_DOTTED = re.compile(r"\d\.[A-Za-z0-9][\w-]{7}")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@lru_cache(1)
def _hints():
    """Automaton over short strings without one of which no line passes ``_GATE``, nor ``_PREFIX`` but for ``_DOTTED``."""
    import ahocorasick

    a = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for k in _HINTS:
        a.add_word(k)
    a.make_automaton()
    return a


def candidate_lines(text: str) -> list[int]:
    """Places (start of line) of the lines to label, in order."""
    low = text.lower()
    if len(low) != len(text):
        low = text.translate(_LOWER)
    starts, upto = set(), -1
    for end, _ in _hints().iter(low):
        if end <= upto:
            continue
        start = text.rfind("\n", 0, end) + 1
        stop = text.find("\n", end)
        upto = len(text) if stop < 0 else stop
        line = text[start:upto]
        if _GATE.search(line) or _PREFIX.search(line):
            starts.add(start)
    upto = -1
    for m in _DOTTED.finditer(text):
        if m.start() > upto:
            start = text.rfind("\n", 0, m.start()) + 1
            upto = text.find("\n", m.end())
            upto = len(text) if upto < 0 else upto
            if _PREFIX.search(text[start:upto]):
                starts.add(start)
    upto = -1
    for m in _MIXED.finditer(text):
        if m.start() > upto and _mixed(m[0]):
            starts.add(text.rfind("\n", 0, m.start()) + 1)
            upto = text.find("\n", m.end())
            if upto < 0:
                break
    for m in _COMMENT.finditer(text):
        if _COMMENT_TOKEN.search(text, m.start() + 2, m.end()):
            starts.add(text.rfind("\n", 0, m.start()) + 1)
    return sorted(starts)


_FIVE = re.compile(r"-----BEGIN ")  # five dashes are those of a key, six are a removed key
_CONTINUES = re.compile(r"(?:\\|\+|concat!\([^)]*,)\s*$")
#: What may stand between two parts of one literal; a lone sign of a patch after a line end is dropped before.
_JOINT = re.compile(r"[\s\"'`+,\\]*")
_HUNK = re.compile(r"@@ -\d+(?:,(\d+))? \+\d+(?:,(\d+))? @@")


def _headers(text: str) -> set[int]:
    """Starts of the file header lines of a patch: '--- ' directly followed by '+++ ' outside of a hunk."""
    out: set[int] = set()
    old = new = at = 0
    while at < len(text):
        end = text.find("\n", at)
        end = len(text) if end < 0 else end
        sign = text[at : at + 1]
        if sign == "@" and (m := _HUNK.match(text, at)):
            old, new = int(m[1] or 1), int(m[2] or 1)
        elif old > 0 or new > 0:
            if sign in ("+", "-", " ", "\n", "\r"):
                old, new = old - (sign != "+"), new - (sign != "-")
            elif sign != "\\":
                old = new = 0
        elif text.startswith("--- ", at) and text.startswith("+++ ", end + 1):
            out |= {at, end + 1}
        at = end + 1
    return out


def find(text: str, field: Field, patch: bool) -> list[tuple[int, int, int]]:
    """(line number, start, end) of every masked stretch; line number 0 marks the rest of a credential begun earlier."""
    found: list[tuple[int, int, int]] = []
    done = -1
    line_no, counted = 1, 0
    headers: set[int] | None = None

    def joined(a: int, b: int) -> bool:
        """Whether what starts at ``b`` goes on with the literal that ends at ``a``."""
        between = text[a:b]
        if patch and "\n" in between:
            signs = [text[i : i + 1] for i in (text.rfind("\n", 0, a) + 1, text.rfind("\n", 0, b) + 1)]
            if any(x in ("+", "-") for x in signs) and signs[0] != signs[1]:
                return False
            between = re.sub(r"\n[-+ ]", "\n", between)
        return _JOINT.fullmatch(between) is not None

    for start in candidate_lines(text):
        if start <= done:
            continue
        line_no += text.count("\n", counted, start)
        counted = start
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        skip = 1 if patch and text[start : start + 1] in ("+", "-", " ") and not _FIVE.match(text, start) else 0
        line = text[start + skip : end].rstrip("\r")
        if skip and text.startswith(("--- ", "+++ "), start):
            headers = _headers(text) if headers is None else headers
            if start in headers:
                continue
        seq, first_line, more, body = _sequence(text, start, skip, patch)
        if not seq:
            continue
        labels = field.viterbi(field.scores(features(seq, first_line)))
        for t, y in zip(seq, labels):
            if not y or t.kind == "p":
                continue
            at, upto = t.at, t.at + len(t.text)
            if t.kind in _BODY_KINDS:
                found.append((0, at, upto))
                done = max(done, upto)
                continue
            line_no += text.count("\n", counted, at)
            counted = at
            before = found[-1] if found and found[-1][2] > start else None
            later = before is not None and (before[0] == 0 or "\n" in text[before[2] : at])
            found.append((0 if later and joined(before[2], at) else line_no, at, upto))
        done = max(done, more - 1 if more > end and not body else done)
    return found


_BODY_KINDS = ("body", "head", "after")
#: A line that may be one of a key's body, bare or as part of a string: indentation and quotes, the encoded text, and what may end such a line.
_BODY = re.compile(r"[ \t]*[\"'`]?([A-Za-z0-9+/]*={0,2})(?:\\[nr])*[\"'`]?[ \t]*[,+\\;.)]*[ \t]*")
_HEAD = re.compile(r"[ \t]*[\"'`]?([A-Za-z-]+: [^\n\"'`\\]*)(?:\\[nr])*[\"'`]?[ \t]*[,+\\;.)]*[ \t]*")
_REST = re.compile(r"(?:\\[nr])*[\"'`]*[ \t]*[,+\\;.)]*\s*")
_END = re.compile(r"[ \t]*[\"'`]?-----END ")


def _sequence(text: str, start: int, skip: int, patch: bool) -> tuple[list[Token], str, int, bool]:
    """(tokens, first line, end of the last line, whether key lines were added) of the sequence that begins in the line at ``start``."""
    end = text.find("\n", start)
    end = len(text) if end < 0 else end
    line = first = text[start + skip : end].rstrip("\r")
    seq, more = tokens_of(line, start + skip), end

    def opens() -> bool:
        t = next((t for t in reversed(seq) if t.kind != "p" and t.text not in ("+", ".")), None)
        return t is not None and "-----BEGIN" in t.text and "PRIVATE KEY" in t.text and "-----END" not in t.text and _REST.fullmatch(text, t.at + len(t.text), more) is not None

    while not opens() and _CONTINUES.search(line) and more < len(text):
        nxt = text.find("\n", more + 1)
        nxt = len(text) if nxt < 0 else nxt
        s = more + 1
        s += 1 if patch and text[s : s + 1] in ("+", "-", " ") else 0
        line = text[s:nxt].rstrip("\r")
        seq += tokens_of(line, s)
        more = nxt
    if not opens():
        return seq, first, more, False
    return seq + _key_lines(text, more + 1, patch), first, more, True


def _key_lines(text: str, lo: int, patch: bool) -> list[Token]:
    """Tokens of the lines after a BEGIN line: encoded lines, headers, and the first line of another kind."""
    got: list[tuple[str, int, str]] = []  # kind, place, text
    closed = blank = False
    while lo < len(text):
        end = text.find("\n", lo)
        end = len(text) if end < 0 else end
        a = lo + (1 if patch and text[lo : lo + 1] in ("+", "-", " ") else 0)
        stop = a + len(text[a:end].rstrip("\r"))
        lo = end + 1
        if _END.match(text, a, stop):
            closed = True
            break
        if not text[a:stop].strip(" \t\"'`\\nr,+;"):
            blank = blank or bool(got)
            continue
        if (m := _BODY.fullmatch(text, a, stop)) and m[1]:
            got.append(("body", m.start(1), m[1]))
        elif (m := _HEAD.fullmatch(text, a, stop)) and not blank:
            got.append(("head", m.start(1), m[1]))
        else:
            got.append(("after", a, text[a:stop]))
            break
    bodies = [x for kind, _, x in got if kind == "body"]
    width = len(bodies[0]) if bodies else 0
    out: list[Token] = []
    short = False  # whether an encoded line of less than the usual width has been met, after which none follows
    seen = 0
    for kind, at, x in got:
        f = [kind, f"{kind},closed" if closed else f"{kind},open"]
        if kind == "body":
            seen += 1
            n = len(x)
            mixed = any(c.isdigit() for c in x) + any(c.islower() for c in x) + any(c.isupper() for c in x) + any(c in "+/" for c in x)
            size = "full" if n == width and n >= 24 else "long" if n > 44 else "16" if n >= 16 else "short"
            shape = f"{size},{mixed}" + (",padded" if x.endswith("=") else "")
            word = "word" if x.isalpha() and (x.islower() or x.istitle() or x.isupper()) else "camel" if x.isalpha() else "-"
            state = "first" if seen == 1 else "later" if short else "next"
            f += [f"body:{shape}", f"body:{shape},{state}", f"body:{word},{'closed' if closed else 'open'}", f"body:{state}", f"body:{state},{'closed' if closed else 'open'},{size},{word}"]
            short = short or n < width
        elif kind == "head":
            known = x.startswith(("Proc-Type:", "DEK-Info:", "Comment:", "Version:", "Key-"))
            f += [f"head:{'known' if known else 'other'},{'first' if not seen else 'later'}", f"head:{'upper' if x[0].isupper() else 'lower'},{'first' if not seen else 'later'}"]
        out.append(Token(x, at, kind, tuple(f)))
    return out


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every masked character replaced by an asterisk; its length, lines and all else stay.
    Of a key block only the body is masked, so that its frame still parses."""
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        out.append(text[at:a])
        value = text[a:b]
        if "-----BEGIN" in value:
            value = re.sub(r"(-----(?:BEGIN|END) [A-Z0-9 ]+-----)|(\\[nr])|([^\\])", lambda m: m[1] or m[2] or "*", value)
        else:
            value = "*" * len(value)
        out.append(value)
        at = b
    out.append(text[at:])
    return "".join(out)


def _source(diffs: DataFrame, chunks: DataFrame) -> DataFrame:
    a = diffs.select(F.lit("patch").alias("field"), F.col("diff_id").cast("string").alias("row_id"), F.col("patch").alias("text"))
    b = chunks.select(F.lit("new_code").alias("field"), F.col("chunk_id").cast("string").alias("row_id"), F.col("new_code").alias("text"))
    return spread(a.unionAll(b)).where("text is not null and row_id is not null")


def credential_lines(diffs: DataFrame, chunks: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(field, row_id, line_no): each line on which a credential begins."""
    model = diffs.sparkSession.sparkContext.broadcast((lambda f: (f.w, f.moves))(trained(sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*model.value)
        for b in batches:
            rows = []
            for kind, row, text in zip(*(b.column(i).to_pylist() for i in range(3))):
                rows += [(kind, row, n) for n in {n for n, _, _ in find(text, field, kind == "patch") if n}]
            cols = list(zip(*rows)) if rows else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], names=["field", "row_id", "line_no"])

    return _source(diffs, chunks).mapInArrow(run, "field string, row_id string, line_no bigint").distinct()


def redacted(diffs: DataFrame, chunks: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(field, row_id, text, n_masked): every text with its credentials masked."""
    model = diffs.sparkSession.sparkContext.broadcast((lambda f: (f.w, f.moves))(trained(sample)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = Field(*model.value)
        for big in batches:
            for b in (big.slice(i, 500) for i in range(0, big.num_rows, 500)):
                texts, n = [], []
                for kind, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                    spans = find(text, field, kind == "patch")
                    texts.append(mask(text, spans) if spans else text)
                    n.append(sum(b - a for _, a, b in spans))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(n, pa.int64())], names=["field", "row_id", "text", "n_masked"])

    return _source(diffs, chunks).mapInArrow(run, "field string, row_id string, text string, n_masked bigint")
