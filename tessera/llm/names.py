"""Problem 7: spellings of one person among names and e-mail addresses typed by people.

Every row makes claims about a name: its address (``first.last@``, ``last_first@``, a hosting handle,
initial and last name) and its display name (any order, accents, case, titles, tags, middle initials,
nicknames).  Names written in addresses are attested.  A display name that no address attests
is looked up among the attested ones by a trie join: attested names are sharded into tries by
one exact part, or by an intact piece of each part where both are misspelt, and the rest is matched by a Levenshtein automaton
walking the trie, in both token orders; only a single nearest name is accepted, so two close but attested names are never
merged.  Nicknames are learned from rows whose address and display name agree on the other part; a list of more may be given.
Letters of every script count; names in Chinese characters or Hangul, written with blanks or without, are taken as a whole.

Rows with the same resolved name are one person.  A shared mailbox or host address attests no name, and a
family name alone links nothing.

Defined results: null, empty and unusable names and addresses make no claim, and a row without any claim
is in no pair; rows with null author_id are left out; repeated rows count once; ties between nearest names link nothing.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.edit import edit_distance
from tessera.session import cut, spread

#: Largest edit distance of a typed part from the attested one; two exchanged neighbours count as one edit.
MOST_EDITS = 1
#: The automaton allows one edit more in parts of this length or longer, in which an exchange is two edits.
LONG = 4
#: Local parts of mailboxes that are nobody's own (fixed values), and names from which on a mailbox counts as shared.
ROLES = "noreply no-reply build builds ci dev developer root admin administrator team info support bot git github gitlab jenkins mail contact hello office test postmaster webmaster nobody user me".split()
SHARED_NAMES = 4
#: Names in one trie; a bucket with more is divided into several.
TRIE_NAMES = 50_000
#: Looked-up names that one copy of a trie serves.
ASKED_NAMES = 200_000
#: Shortest parts of names of which both may be misspelt.
BOTH_LONG = 5
#: Other parts (mostly family names) with which a nickname must have been seen before it is believed.
NICKNAME_ROWS = 3
#: Rows of one person paired in one task, about, on one side.
PAIRED_ROWS = 2_000

_LETTERS = str.maketrans({"ø": "o", "Ø": "o", "ł": "l", "Ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "Æ": "ae", "œ": "oe", "ð": "d", "þ": "th", "ı": "i"})
_TAG = re.compile(r"\s*[\(\[{][^\)\]}]*[\)\]}]\s*|\s+via\s+\S+\s*$")
_TITLE = re.compile(r"^(?:dr|prof|mr|mrs|ms|sir)\.?\s+|,?\s+(?:jr|sr|phd|ph\.d|md|ii|iii)\.?$", re.I)


_BREAK = re.compile(r"[^\w'’]|[\d_]")
_APOSTROPHE = str.maketrans("’ʼ", "''")


def fold(text: str) -> str:
    """Lower case; letters of alphabets with accents without them, those of other scripts composed."""
    out = []
    for c in unicodedata.normalize("NFC", text.translate(_LETTERS).translate(_APOSTROPHE)):
        if c < "\x80":
            out.append(c)
            continue
        d = unicodedata.normalize("NFKD", c)
        out.append("".join(x for x in d if not unicodedata.combining(x)) if ord(d[0]) < 0x530 else "" if unicodedata.combining(c) and ord(c) < 0x370 else unicodedata.normalize("NFKC", c))
    return "".join(out).lower()


def _whole(text: str) -> bool:
    """Whether a text is written in characters that each stand for a syllable or word."""
    return bool(text) and all(0x3400 <= ord(c) <= 0x9FFF or 0xAC00 <= ord(c) <= 0xD7A3 or 0x3040 <= ord(c) <= 0x30FF or 0x20000 <= ord(c) <= 0x323AF for c in text)


def _letters(text: str) -> list[str]:
    return [p for p in (x.strip("'") for x in _BREAK.sub(" ", text).split()) if p]


def display_parts(name: str | None) -> list[str]:
    """First and last part of a display name; one part if it has only one; none if there is nothing."""
    if not name:
        return []
    t = _TITLE.sub("", _TAG.sub(" ", unicodedata.normalize("NFKC", name)).strip())
    if t.count(",") == 1:
        last, first = t.split(",")
        t = f"{first} {last}"
    parts = _letters(fold(t))
    if len(run := "".join(parts)) > 1 and _whole(run):
        return [run[1:], run[0]]
    if len(parts) > 2:
        parts = [p for p in parts if len(p) > 1] or parts
    return parts if len(parts) <= 1 else [parts[0], parts[-1]]


def address_parts(email: str | None) -> tuple[str, list[str]]:
    """(kind, parts): 'full' with two name parts, 'handle' with one run of letters, or 'none'."""
    if not email:
        return "none", []
    e = re.sub(r"\s+at\s+", "@", fold(email).strip(" <>\t\r\n"))
    if e.count("@") != 1:
        return "none", []
    local, domain = e.split("@")
    if "." not in domain or domain.endswith(("(none)", ".local", "localhost", "localdomain")) or domain.startswith("localhost"):
        return "none", []
    m = re.fullmatch(r"(?:\d+\+)?([\w-]+)", local)
    if "noreply" in domain:
        handle = "".join(_letters(m[1])) if m else ""
        return ("handle", [handle]) if handle else ("none", [])
    local = local.split("+")[0]
    parts = ["".join(_letters(p)) for p in re.split(r"[._]", local)]
    parts = [p for p in parts if p]
    if len(parts) >= 2 and len(parts[0]) > 1 and len(parts[-1]) > 1:
        return "full", [parts[0], parts[-1]]
    return ("handle", ["".join(parts)]) if parts else ("none", [])


# ---- Levenshtein automaton over a trie ------------------------------------------------------------


class Trie:
    """Words in a trie; ``near`` walks it with the row of a Levenshtein automaton as state."""

    def __init__(self, words: list[str]):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in w:
                node = node.setdefault(c, {})
            node[""] = w

    def near(self, word: str, bound: int) -> list[tuple[str, int]]:
        """(entry, distance) of all entries within ``bound`` edits."""
        out: list[tuple[str, int]] = []
        n = len(word)
        stack = [(self.root, tuple(range(n + 1)))]
        while stack:
            node, row = stack.pop()
            for c, child in node.items():
                if not c:
                    if row[n] <= bound:
                        out.append((child, row[n]))
                    continue
                new, least = [row[0] + 1], row[0] + 1
                for j in range(n):
                    v = row[j] + (word[j] != c)
                    if (x := row[j + 1] + 1) < v:
                        v = x
                    if (x := new[j] + 1) < v:
                        v = x
                    new.append(v)
                    if v < least:
                        least = v
                if least <= bound:
                    stack.append((child, tuple(new)))
        return out


def swapped(a: str, b: str) -> bool:
    """Whether exchanging two neighbours makes the words equal."""
    d = [i for i in range(min(len(a), len(b))) if a[i] != b[i]]
    return len(a) == len(b) and len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]


def _bound(word: str) -> int:
    return MOST_EDITS + (len(word) >= LONG)


def _parsed(authors: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = [display_parts(x) for x in b["author_name"]]
            e = [address_parts(x) for x in b["author_email"]]
            box = [fold(x).strip() if isinstance(x, str) and k[0] == "handle" else None for x, k in zip(b["author_email"], e)]
            role = [bool(m) and m.split("@")[0].split("+")[0] in ROLES for m in box]
            yield pd.DataFrame({"author_id": b["author_id"], "shown": d, "kind": [x[0] for x in e], "parts": [x[1] for x in e], "box": box, "role": role})

    rows = authors.where("author_id is not null").select("author_id", "author_name", "author_email").distinct()
    return spread(rows).mapInPandas(run, "author_id bigint, shown array<string>, kind string, parts array<string>, box string, role boolean")


def _key(a, b):
    return F.concat_ws(" ", F.array_sort(F.array(a, b)))


def _attested(rows: DataFrame) -> DataFrame:
    """(name, a, b): names written in addresses, as a key and in the order met."""
    full = rows.where("kind = 'full'").select(F.get("parts", F.lit(0)).alias("a"), F.get("parts", F.lit(1)).alias("b"))
    return full.select(_key("a", "b").alias("name"), "a", "b").distinct()


def _nicknames(rows: DataFrame, given: DataFrame | None) -> DataFrame:
    """(nick, stands_for): learned where display name and address agree on the other part, or give one only, and those given."""
    full = rows.where("kind = 'full' and size(shown) between 1 and 2")
    ends = F.explode(F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")), F.struct(F.lit(0).alias("i"), F.lit(1).alias("j")), F.struct(F.lit(1).alias("i"), F.lit(0).alias("j")), F.struct(F.lit(1).alias("i"), F.lit(1).alias("j")))).alias("e")
    each = full.select("shown", "parts", ends).select(F.get("shown", F.col("e.i")).alias("nick"), F.get("shown", 1 - F.col("e.i")).alias("rest"), F.get("parts", F.col("e.j")).alias("stands_for"), F.get("parts", 1 - F.col("e.j")).alias("other"))
    near = F.col("rest").isNull() | (F.levenshtein("rest", "other") <= F.when(F.length("other") >= LONG, 1).otherwise(0))
    agreed = each.where(near & F.expr("length(nick) > 1 and levenshtein(nick, stands_for) > 1")).select("nick", "stands_for", "other").distinct()
    learned = agreed.groupBy("nick", "stands_for").agg(F.count("*").alias("n")).where(F.col("n") >= NICKNAME_ROWS).select("nick", "stands_for")
    if given is None:
        return learned
    fold_ = F.udf(lambda x: fold(x).strip() if x else None, "string")
    return learned.unionAll(given.select(fold_("nick"), fold_("stands_for")).where("nick is not null and stands_for is not null").toDF("nick", "stands_for")).distinct()


def _aliases(names: DataFrame) -> DataFrame:
    """(alias, name): ways a name is run together, kept where they mean one name only."""
    every = []
    for a, b in (("a", "b"), ("b", "a")):
        first, last = F.col(a), F.col(b)
        every += [F.concat(first, last), F.concat(F.substring(first, 1, 1), last), F.concat(last, F.substring(first, 1, 1)), last]
    long = names.select("name", F.explode(F.array_distinct(F.array(*every))).alias("alias"))
    return long.groupBy("alias").agg(F.min("name").alias("name"), F.max("name").alias("other")).where("name = other").select("alias", "name")


def pieces(part: str, stored: bool) -> list[str]:
    """Pieces of a part: if it is one edit, or one exchange of neighbours, away from a stored one, they share a piece."""
    if stored:
        k = len(part) // 2
        return ["<" + part[:k], ">" + part[k:], "=" + part[: k - 1] + "_" + part[k + 1 :]]
    out = {f"={part[: len(part) // 2 - 1]}_{part[len(part) // 2 + 1 :]}"}
    for n in (len(part) - 1, len(part), len(part) + 1):
        out |= {"<" + part[: n // 2], ">" + part[-(n - n // 2) :]}
    return sorted(out)


def _bucketed(rows: DataFrame, stored: bool) -> DataFrame:
    """(key, rest, value) of names (x, y, value): an exact part with the other one, and a piece of each part with both."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x, y, value in zip(b["x"], b["y"], b["value"]):
                for p, q in dict.fromkeys(((x, y), (y, x))):
                    out.append((p, q, value))
                    if len(p) >= BOTH_LONG - (not stored) and len(q) >= BOTH_LONG - (not stored) and not (stored and (p, q) != (x, y)):
                        out += [(f"{i} {j}", f"{p} {q}", value) for i in pieces(p, stored) for j in pieces(q, stored)]
            yield pd.DataFrame(out, columns=["key", "rest", "value"])

    return rows.mapInPandas(run, "key string, rest string, value string")


def misspelt(got: str, asked: str) -> int:
    """Edits between two parts, an exchange of neighbours as one; more than ``MOST_EDITS`` if they are further apart."""
    if got == asked:
        return 0
    if swapped(got, asked):
        return 1
    return edit_distance(got, asked) if abs(len(got) - len(asked)) <= MOST_EDITS else MOST_EDITS + 1


def _trie_join(wanted: DataFrame, names: DataFrame) -> DataFrame:
    """(word, name): the single nearest attested name of each wanted pair (word, x, y), each part at most ``MOST_EDITS`` away.

    Both tables are bucketed by an exact part or by intact pieces; what else a bucket's names have goes into tries of at most
    ``TRIE_NAMES`` entries each, and every wanted word meets all tries of its bucket.  Tries of buckets that many words ask
    are built several times, each for a part of the words.
    """
    held = _bucketed(names.select(F.col("a").alias("x"), F.col("b").alias("y"), F.col("name").alias("value")), True)
    asked = cut(_bucketed(wanted.select("x", "y", F.col("word").alias("value")), False))
    want = asked.groupBy("key").agg(F.ceil(F.count("*") / ASKED_NAMES).cast("int").alias("copies"))
    held = cut(held.join(want, "key"))
    size = held.groupBy("key").agg(F.ceil(F.count("*") / TRIE_NAMES).cast("int").alias("tries"), F.max("copies").alias("copies"))
    held = held.drop("copies").join(size, "key").select("key", F.pmod(F.xxhash64("rest"), "tries").cast("int").alias("t"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), F.lit(0).alias("side"), "rest", "value")
    asked = asked.join(size, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("tries") - 1)).alias("t"), F.pmod(F.xxhash64("value"), "copies").cast("int").alias("copy"), F.lit(1).alias("side"), "rest", "value")
    parts = int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = held.unionAll(asked).repartition(parts, "key", "t", "copy").sortWithinPartitions("key", "t", "copy", "side")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, entries, trie = None, {}, None
        for b in batches:
            out = []
            for key, t, copy, side, rest, value in zip(*(b[c] for c in ("key", "t", "copy", "side", "rest", "value"))):
                if (key, t, copy) != now:
                    now, entries, trie = (key, t, copy), {}, None
                if side == 0:
                    entries.setdefault(rest, []).append(value)
                    continue
                if trie is None:
                    trie = Trie(list(entries))
                parts = rest.split(" ")
                for got, _ in trie.near(rest, sum(map(_bound, parts))):
                    d = [misspelt(g, p) for g, p in zip(got.split(" "), parts)]
                    if len(got.split(" ")) == len(parts) and max(d) <= MOST_EDITS:
                        out += [(value, n, sum(d)) for n in entries[got]]
            yield pd.DataFrame(out, columns=["word", "name", "d"])

    found = both.mapInPandas(run, "word string, name string, d int").distinct()
    best = found.groupBy("word").agg(F.min_by("name", F.struct("d", "name")).alias("name"), F.max_by("name", F.struct(-F.col("d"), "name")).alias("other"))
    return best.where("name = other").select("word", "name")


def resolved(authors: DataFrame, nicknames: DataFrame | None = None) -> DataFrame:
    """(author_id, name): the name each row resolves to; rows without a usable claim are left out.
    ``nicknames``: more of them (nick, stands_for) beside those learned."""
    rows = cut(_parsed(authors))
    names = cut(_attested(rows))
    known = names.select("name").distinct()
    nick = _nicknames(rows, nicknames)
    aliases = cut(_aliases(names))
    # what the display name may mean: itself and its nicknames written out
    two = rows.where("size(shown) = 2").select("author_id", F.get("shown", F.lit(0)).alias("x"), F.get("shown", F.lit(1)).alias("y"))
    variants = two.unionAll(two.join(nick, F.col("x") == F.col("nick")).select("author_id", F.col("stands_for").alias("x"), "y")).unionAll(
        two.join(nick, F.col("y") == F.col("nick")).select("author_id", "x", F.col("stands_for").alias("y"))
    )
    variants = cut(variants.distinct().withColumn("word", _key("x", "y")))
    plain = two.select("author_id", _key("x", "y").alias("plain"))
    shown = variants.join(known.withColumnRenamed("name", "word"), "word").groupBy("author_id").agg(F.min("word").alias("shown_name"), F.max("word").alias("o")).where("shown_name = o").drop("o")
    # what the address says
    mail = rows.where("kind = 'full'").select("author_id", _key(F.get("parts", F.lit(0)), F.get("parts", F.lit(1))).alias("mail_name"))
    run_together = rows.where("kind = 'handle'").select("author_id", F.get("parts", F.lit(0)).alias("alias"))
    by_alias = run_together.join(aliases, "alias").select("author_id", F.col("name").alias("alias_name"))
    single = rows.where("size(shown) = 1").select("author_id", F.get("shown", F.lit(0)).alias("alias")).where("length(alias) >= 6").join(aliases, "alias").select("author_id", F.col("name").alias("single_name"))
    # initial or nothing for the first name: the one attested name with that last name and initial
    initial = two.where("length(x) = 1 or length(y) = 1").select("author_id", F.concat(F.when(F.length("x") == 1, F.col("x")).otherwise(F.col("y")), F.when(F.length("x") == 1, F.col("y")).otherwise(F.col("x"))).alias("alias"))
    by_initial = initial.join(aliases, "alias").select("author_id", F.col("name").alias("initial_name"))
    # all claims of a row come together once
    claims = {"mail_name": mail, "shown_name": shown, "alias_name": by_alias, "single_name": single, "initial_name": by_initial, "plain": plain}
    long = rows.select("author_id", F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("claim"))
    for kind, side in claims.items():
        long = long.unionAll(side.select("author_id", F.lit(kind), F.col(kind)))
    all_ = long.groupBy("author_id").agg(*(F.min(F.when(F.col("kind") == k, F.col("claim"))).alias(k) for k in claims))
    # a handle's owner must not contradict a full display name
    agree = F.col("plain").isNull() | F.exists(F.split("plain", " "), lambda p: F.exists(F.split("alias_name", " "), lambda q: F.levenshtein(p, q) <= F.when(F.length(q) >= 6, 2).otherwise(0)))
    sure = F.coalesce(F.when(F.col("shown_name").isNotNull() & (F.col("shown_name") != F.col("mail_name")), F.col("shown_name")), "mail_name", "shown_name", F.when(agree, F.col("alias_name")), "initial_name", F.when(F.col("plain").isNull(), F.col("single_name")))
    all_ = cut(all_.withColumn("sure", sure).select("author_id", "sure", "plain"))
    # a name typed at a mailbox that is nobody's own is taken as it is
    boxes = rows.where("box is not null").groupBy("box").agg(F.count_distinct(F.array_join("shown", " ")).alias("n"), F.max("role").alias("r")).where((F.col("n") >= SHARED_NAMES) | F.col("r")).select("box")
    shared = rows.join(boxes, "box", "left_semi").select("author_id")
    open_ = all_.where("sure is null and plain is not null").select("author_id").join(shared, "author_id", "left_anti")
    wanted = variants.join(open_, "author_id", "left_semi").where("length(x) > 1 and length(y) > 1")
    near = _trie_join(wanted.select("word", "x", "y").distinct(), names)
    fuzzy = wanted.join(near, "word").groupBy("author_id").agg(F.min("name").alias("fuzzy"), F.max("name").alias("o")).where("fuzzy = o").select("author_id", "fuzzy")
    usable = F.when(~F.col("plain").rlike(r"(^| )[a-zа-яα-ω]( |$)"), F.col("plain"))
    return all_.join(fuzzy, "author_id", "left").select("author_id", F.coalesce("sure", "fuzzy", usable).alias("name")).where("name is not null")


def members(authors: DataFrame, nicknames: DataFrame | None = None) -> DataFrame:
    """(author_id, person_id, name, n_spellings): the person of every row, named by the smallest id; a row without a claim is one of its own."""
    known = cut(resolved(authors, nicknames).distinct())
    persons = known.groupBy("name").agg(F.min("author_id").alias("person_id"), F.count("*").alias("n_spellings"))
    rows = authors.where("author_id is not null").select("author_id").distinct().join(known, "author_id", "left")
    return rows.join(persons, "name", "left").select("author_id", F.coalesce("person_id", "author_id").alias("person_id"), "name", F.coalesce("n_spellings", F.lit(1)).alias("n_spellings"))


def same_person_pairs(authors: DataFrame, nicknames: DataFrame | None = None) -> DataFrame:
    """(author_a, author_b): all pairs of rows of one person, smaller id first; persons with many rows are divided."""
    r = cut(resolved(authors, nicknames).distinct())
    many = r.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name", F.ceil(F.col("n") / PAIRED_ROWS).cast("int").alias("parts"))
    r = r.join(many, "name")
    a = r.select(F.col("author_id").alias("author_a"), "name", F.pmod(F.xxhash64("author_id"), "parts").cast("int").alias("part"))
    b = r.select(F.col("author_id").alias("author_b"), "name", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, ["name", "part"]).where("author_a < author_b").select("author_a", "author_b").distinct()


def person_report(authors: DataFrame) -> DataFrame:
    """(name, n_spellings): persons with more than one row."""
    return resolved(authors).distinct().groupBy("name").agg(F.count("*").alias("n_spellings")).where("n_spellings > 1")
