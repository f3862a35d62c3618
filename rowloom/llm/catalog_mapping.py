"""Mapping freely typed values to the entries of a reference list.

Method: a trie of the list's words and one of its names, searched with a Levenshtein automaton. The automaton is the
usual one with a state per (letters consumed, errors made), transpositions counting as one error; its states are bit
sets, so walking one edge of the trie is a few operations on integers, and edges are left out below which no terminal
can be near by its length or letters. Alias paths lead from other spellings to the same terminals: words without their
inner vowels, names written as one word from any of their words on or backwards, the part of a name in brackets. A
typed prefix is accepted at the inner node where it ends. The distance allowed grows with the length of what was typed.

A value is brought to plain lower-case form and cut into words; fixed filler and difficulty words are set aside
unless a name of the list holds them. Every run of up to one word more than the longest name is looked up, in any order
of a name's words. `candidate_values` reports all entries within the distance; of them, the non-overlapping ones that
explain most words at least cost are what the value names, so it may name several. Values are brought to their words in
the task that reads them, each different one is looked up once, and the result is joined to the records.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .common import visible
from .plainform import LOOKALIKES, plain

# Words of an answer that belong to no name.
FILLERS = frozenset(
    "roll rolls please probably maybe perhaps needs need skill skills check tongue go for here i d id say think either or and the a an use try".split()
)
DIFFICULTIES = frozenset("success succes regular normal std standard hard hrd h difficult extreme extrem xtreme ext".split())
MEMORY = 100_000
_TYPED = re.compile(r"[^\W_]+")
#: Names never reach over these.
_MARKS, _ALTERNATIVES = re.compile(r"[|;/\n]"), re.compile(r"[|;/\n]|\bor\b")
_LOWER = {ord(c): LOOKALIKES[c.upper()].lower() for c in map(chr, range(0x370, 0x590)) if c not in LOOKALIKES and c.upper() in LOOKALIKES}


def allowed(length: int) -> int:
    """Errors allowed in a typed word or name of so many letters."""
    return 0 if length < 3 else 1 if length < 5 else 2 if length < 9 else 3


def skeleton(word: str) -> str:
    return word[:1] + re.sub("[aeiou]", "", word[1:])


def _letters(path: str) -> int:
    """The letters of a path as bits; letters that share a bit only weaken a bound."""
    out = 0
    for c in path:
        out |= 1 << (ord(c) & 63)
    return out


class Node:
    __slots__ = ("below", "down", "ends", "least", "letters", "most", "needed")

    def __init__(self):
        self.down: dict[str, Node] = {}
        self.ends: list[tuple] = []
        self.below: set = set()
        self.least, self.most = 1 << 30, 0
        self.letters, self.needed = 0, -1


class Trie:
    """Terminals are (target, base cost); `below` holds the word targets reachable from a node on plain paths, `least` and
    `most` how far its terminals are, `letters` and `needed` which letters any and all of the paths through it hold."""

    def __init__(self):
        self.root = Node()

    def add(self, path: str, target, base: float = 0.0, prefixes: bool = False) -> None:
        node, held = self.root, _letters(path)
        for left, c in zip(range(len(path), 0, -1), path):
            node.least, node.most = min(node.least, left), max(node.most, left)
            node = node.down.setdefault(c, Node())
            node.letters |= held
            node.needed &= held
            if prefixes:
                node.below.add((target, len(path)))
        node.least = 0
        node.ends.append((target, base))

    def search(self, typed: str, most: int) -> dict:
        """{target: cost} of every terminal within `most` errors of what was typed, and of words it is a prefix of."""
        n, found = len(typed), {}
        mask: dict[str, int] = {}
        for i, c in enumerate(typed):
            mask[c] = mask.get(c, 0) | 1 << i
        held = _letters(typed)
        start = [(1 << (e + 1)) - 1 for e in range(most + 1)]  # e letters skipped
        done, full = 1 << n, (1 << (n + 1)) - 1

        def keep(target, cost):
            if cost < found.get(target, 99):
                found[target] = cost

        stack = [(self.root, start, None, "", 0)]
        while stack:
            node, states, before, last, depth = stack.pop()
            for c, child in node.down.items():
                # A letter that only one side has is an error each.
                if (held & ~child.letters).bit_count() > most or (child.needed & ~held).bit_count() > most and (depth > n or not child.below):
                    continue
                m = mask.get(c, 0)
                new = [((states[0] & m) << 1) & full]
                for e in range(1, most + 1):
                    s = (states[e] & m) << 1 | states[e - 1] | states[e - 1] << 1 | new[e - 1] << 1
                    if before is not None:
                        s |= (before[e - 1] & m & (mask.get(last, 0) >> 1)) << 2
                    new.append(s & full)
                alive = new[most]
                for s in new:
                    alive |= s
                if not alive:
                    continue
                errors = next((e for e, s in enumerate(new) if s & done), None)
                if errors is not None:
                    for target, base in child.ends:
                        if not base or not errors or n > 4:
                            keep(target, errors + base)
                    if n >= 3 and errors <= (n >= 5):
                        for target, length in child.below:
                            if depth + 1 < length:
                                keep(target, errors + 0.4 + 0.05 * (length - n))
                # Letters that are left on the path and in what was typed cannot differ by more than the errors that are left.
                spare = most - next(e for e, s in enumerate(new) if s)
                behind = n + 1 - (alive & -alive).bit_length()
                if child.least > behind + spare and (depth > n or not child.below):
                    continue
                if child.most < n + 1 - alive.bit_length() - spare:
                    continue
                stack.append((child, new, states, c, depth + 1))
        return found


def orders(ws: tuple[str, ...]) -> set[tuple[str, ...]]:
    """The orders in which a name may be written as one word: from any of its words on, and backwards."""
    return {ws[i:] + ws[:i] for i in range(len(ws))} | {ws[::-1]}


class Mapper:
    """Catalogue entries by their words; `entries` are (kind, name). Fillers that a name holds are no fillers."""

    def __init__(self, entries: list[tuple[str, str]]):
        self.words, self.whole, self.names = Trie(), Trie(), {}
        self.exact: dict[str, dict[tuple, float]] = {}
        for kind, name in entries:
            ws = tuple(_TYPED.findall(plain(name).lower().translate(_LOWER).replace("'", " ")))
            if not ws:
                continue
            self.names[ws] = (kind, name)
            if tail := tuple(_TYPED.findall(" ".join(re.findall(r"\((.*?)\)", plain(name).lower())))):
                self.names.setdefault(tail, (kind, name))
        words = {w for ws in self.names for w in ws}
        self.holding: dict[str, list[tuple]] = {w: [] for w in words}
        for ws in self.names:
            for w in set(ws):
                self.holding[w].append(ws)
            if len(ws) > 1:
                for order in orders(ws):
                    for path, base in (("".join(order), 0.0 if order == ws else 0.3), ("".join(map(skeleton, order)), 0.8)):
                        self.whole.add(path, ws, base)
                        self.exact.setdefault(path, {}).setdefault(ws, base)
                        self.exact[path][ws] = min(base, self.exact[path][ws])
        for w in sorted(words):
            self.words.add(w, w, prefixes=True)
            if skeleton(w) != w:
                self.words.add(skeleton(w), w, 0.5)
        self.aside = (FILLERS | DIFFICULTIES) - words
        self.alternatives = _ALTERNATIVES if "or" in self.aside else _MARKS
        self.longest = max((len(ws) for ws in self.names), default=0)
        self.near = lru_cache(MEMORY)(lambda typed: self.words.search(typed, allowed(len(typed))))
        self.best = lru_cache(MEMORY)(self._best)
        self.of_words = lru_cache(MEMORY)(self._of_words)

    def _by_words(self, run: tuple[str, ...]) -> dict[tuple, float]:
        """Names of as many words as the run, each near one of it, with their cost; the best assignment of each name."""
        near = [self.near(w) for w in run]
        rarest = min(near, key=len)
        found = {}
        for name in {ws for target in rarest for ws in self.holding[target] if len(ws) == len(run)}:
            costs = {0: 0.0}  # by the set of the name's words that the words of the run so far stand for
            for known in near:
                then: dict[int, float] = {}
                for used, cost in costs.items():
                    for i, w in enumerate(name):
                        if not used >> i & 1 and w in known:
                            at = used | 1 << i
                            then[at] = min(then.get(at, 99), cost + known[w])
                costs = then
            if costs:
                least = min(costs.values())
                own = sum(known[w] for known, w in zip(near, name)) if all(w in known for known, w in zip(near, name)) else 99
                found[name] = min(own, least + 0.1)
        return found

    def _spelled(self, run: tuple[str, ...], most: int) -> dict[tuple, float]:
        """Names that the run is when it is written as one word, within `most` errors; names of one word within one."""
        typed = "".join(run)
        whole = self.whole.search(typed, most) if most else self.exact.get(typed, {})
        found = {name: c + 0.2 for name, c in whole.items()}
        if len(run) > 1 and most < 2:
            for w, c in self.words.search(typed, most).items():
                if (w,) in self.names and c < 2:
                    found[w,] = min(found.get((w,), 99), c + 0.6)
        return found

    def _fits(self, run: tuple[str, ...], cost: float) -> bool:
        letters = sum(map(len, run))
        return cost < allowed(letters) + 1 and cost <= 0.45 * letters

    def every(self, run: tuple[str, ...]) -> dict[tuple, float]:
        """All names within the distance allowed for a run of words, with their cost."""
        found = self._by_words(run) if len(run) <= self.longest else {}
        if len(run) <= max(2, self.longest):
            most = allowed(sum(map(len, run)))
            for errors in {min(most, 1), most}:
                for name, c in self._spelled(run, errors).items():
                    found[name] = min(found.get(name, 99), c)
        return {name: c for name, c in found.items() if self._fits(run, c)}

    def _best(self, run: tuple[str, ...]) -> tuple[float, tuple] | None:
        """(cost, name) of the nearest name; of equally near ones the first. Errors are allowed one by one until the
        names found are nearer than any with more errors."""
        if run in self.names:
            return 0.0, run
        best = min(((c, name) for name, c in self._by_words(run).items()), default=(99, ())) if len(run) <= self.longest else (99, ())
        if len(run) <= max(2, self.longest):
            most = allowed(sum(map(len, run)))
            for errors in range(most + 1):
                if best[0] < errors + 0.2:
                    break
                best = min(best, min(((c, name) for name, c in self._spelled(run, errors).items()), default=best))
        return best if best[1] and self._fits(run, best[0]) else None

    def parts(self, value: str) -> list[tuple[str, ...]]:
        """The words of each alternative of a value, without those that are set aside."""
        typed = plain(value).lower().translate(_LOWER).replace("'", " ")
        return [ws for part in self.alternatives.split(typed) if (ws := tuple(w for w in _TYPED.findall(part) if w not in self.aside))]

    def _runs(self, ws: tuple[str, ...]):
        for i in range(len(ws)):
            for k in range(1, min(self.longest + 1, len(ws) - i) + 1):
                yield i, i + k

    def _of_words(self, ws: tuple[str, ...]) -> tuple[tuple, ...]:
        """The names that explain most words at least cost: spans are taken in the order of cost - 1.5 * words. Longer runs
        are looked up first, and a span that no shorter one can precede is taken before those that it meets are looked up."""
        taken: set[int] = set()
        out, spans = [], []
        rank = lambda s: (s[2] - 1.5 * (s[1] - s[0]), s[2], s[0], s[3])
        for k in range(min(self.longest + 1, len(ws)), 0, -1):
            spans += [(lo, lo + k, *near) for lo in range(len(ws) - k + 1) if taken.isdisjoint(range(lo, lo + k)) and (near := self.best(ws[lo : lo + k]))]
            for span in sorted(spans, key=rank):
                if k > 1 and rank(span)[0] >= -1.5 * (k - 1):
                    break
                if taken.isdisjoint(range(*span[:2])):
                    taken.update(range(*span[:2]))
                    out.append((rank(span), span[3]))
            spans = [s for s in spans if taken.isdisjoint(range(*s[:2]))]
        return tuple(name for _, name in sorted(out))

    def map(self, parts: list[tuple[str, ...]]) -> list[tuple[str, str]]:
        """The entries that a value of these parts names."""
        return list(dict.fromkeys(self.names[name] for ws in parts for name in self.of_words(ws)))

    def candidates(self, parts: list[tuple[str, ...]]) -> dict[tuple[str, str], float]:
        """Every entry that some run of words of the value is within the allowed distance of, with its least cost."""
        found: dict[tuple[str, str], float] = {}
        for ws in parts:
            for lo in range(len(ws)):
                for hi in range(lo + 1, min(lo + self.longest + 1, len(ws)) + 1):
                    for name, c in self.every(ws[lo:hi]).items():
                        entry = self.names[name]
                        found[entry] = min(found.get(entry, 99), c)
        return found


def catalog_entries(skills: DataFrame, attributes: DataFrame) -> list[tuple[str, str]]:
    """(kind, name) of the two catalogues, which are lists of fixed length; attributes win over skills of their name."""
    named = [("attribute", r[0]) for r in attributes.select("attribute_name").distinct().collect()]
    named += [("skill", r[0]) for r in skills.select("skill_name").distinct().collect()]
    return sorted(e for e in named if e[1])


def _keyed(records: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    """(id, value): the words of each value that count, parted by a blank, and its alternatives by a bar."""

    def run(batches):
        mapper = Mapper(entries)
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "value": ["|".join(map(" ".join, mapper.parts(v))) for v in b["raw_response"]]})

    typed = records.where(F.col("id").isNotNull() & visible(F.col("raw_response"))).select("id", "raw_response")
    return typed.mapInPandas(run, "id string, value string")


def _looked_up(keyed: DataFrame, entries: list[tuple[str, str]], every: bool) -> DataFrame:
    """(value, label_kind, label_name, cost): each different value looked up once: the entries that it names, or all
    candidates; nothing for a value with none."""

    def run(batches):
        mapper = Mapper(entries)
        for b in batches:
            out = []
            for v in b["value"]:
                parts = [tuple(p.split(" ")) for p in v.split("|") if p]
                out += [(v, *e, c) for e, c in (mapper.candidates(parts) if every else dict.fromkeys(mapper.map(parts), None)).items()]
            yield pd.DataFrame(out, columns=["value", "label_kind", "label_name", "cost"]).astype({"cost": "float64"})

    # Looking up takes far longer than the size of the values lets adaptive execution expect. Neighbours share words.
    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.select("value").distinct().repartitionByRange(parts, "value").mapInPandas(run, "value string, label_kind string, label_name string, cost double")


def mapped_values(records: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    """(id, label_kind, label_name): one row per entry that a record's raw_response names.

    records: id, raw_response; rows without an id or with a null or blank value give nothing, a value that names no entry
    gives ('unmatched', ''). Repeated rows and repeated names of one record give one row.
    """
    scratch = Scratch(ship(records.sparkSession))
    keyed = scratch.keep(_keyed(records, entries))
    known = scratch.keep(_looked_up(keyed, entries, False).drop("cost"))
    kind, name = (F.coalesce(c, F.lit(none)).alias(c) for c, none in (("label_kind", "unmatched"), ("label_name", "")))
    return keyed.join(known, "value", "left").select("id", kind, name).distinct()


def candidate_values(records: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    """(value, label_kind, label_name, cost, n_records): for every different value, in the words of it that count, all
    entries within the distance allowed for its length, with the least cost, and the number of ids that typed it."""
    scratch = Scratch(ship(records.sparkSession))
    keyed = scratch.keep(_keyed(records, entries).distinct())
    counts = keyed.groupBy("value").agg(F.count("*").alias("n_records"))
    return _looked_up(keyed, entries, True).withColumn("cost", F.round("cost", 2)).join(counts, "value")


def unmatched_values(records: DataFrame, entries: list[tuple[str, str]]) -> DataFrame:
    """(value, n_records): the values that name no entry, in the words of them that count, with the number of ids that
    typed them; an empty value stands for texts without such a word."""
    scratch = Scratch(ship(records.sparkSession))
    keyed = scratch.keep(_keyed(records, entries).distinct())
    known = scratch.keep(_looked_up(keyed, entries, False).select("value").distinct())
    return keyed.join(known, "value", "left_anti").groupBy("value").agg(F.count("*").alias("n_records"))


def uncoded(annotations: DataFrame) -> DataFrame:
    return annotations.where("checks IS NULL AND roll_required")
