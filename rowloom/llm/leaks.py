"""Evaluation passages inside training text.

Method: winnowing. A text is a sequence of words (plain lower-case form; each Chinese character is a word). Of the
hashes of its k-grams the smallest of every `window` successive ones is kept as a fingerprint, so two texts that share
k + window - 1 successive words share a fingerprint. Documents and evaluation items are joined on fingerprints, and one
that they share makes a candidate. Candidates are extended: equal runs of words are chained in order, over gaps of up to
`gap` words of the document, into the passage that covers most of the item. Words that are equal in order inside a
short gap on both sides count as covered, words that were exchanged do not: texts made by one pattern would count as
each other's passages. An item is leaked if the passage covers at least `share` of its words.

Each document is read and winnowed once, whatever the number of items. Items and their fingerprints are tables. Both
joins choose by the measured size of the side of the items and of the candidates, which are written first: below Spark's
broadcast threshold documents and their fingerprints are not shuffled, above it they meet by key.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .plainform import words

#: A passage that is held with its wording changed a little covers less than it holds, so half of an item is asked for as 0.47.
K, WINDOW, GAP, SHARE = 4, 3, 40, 0.47
SEED_RUN, FILL = 3, 12
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def grams(hashes: np.ndarray, owner: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(digest, owner) of every k successive words of one text, of texts that stand behind each other."""
    n = len(hashes) - k + 1
    if n <= 0:
        return hashes[:0], owner[:0]
    whole = owner[:n] == owner[k - 1 :]
    g = np.full(n, k, np.uint64)
    for i in range(k):
        g = (g ^ (g >> np.uint64(29))) * _STEP + hashes[i : i + n]
    g *= _MIX
    return (g ^ (g >> np.uint64(32)))[whole], owner[:n][whole]


def winnow(digests: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(digest, owner) of the smallest of every window; of all grams of a text that has fewer than a window."""
    if not len(digests):
        return digests, owner
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    few = np.diff(np.r_[starts, len(owner)]) < window
    n = len(digests) - window + 1
    low = digests[: max(n, 0)].copy()
    for i in range(1, window):
        np.minimum(low, digests[i : i + n], out=low) if n > 0 else None
    whole = owner[: max(n, 0)] == owner[window - 1 :] if n > 0 else np.array([], bool)
    out = np.r_[low[whole], np.minimum.reduceat(digests, starts)[few]]
    of = np.r_[owner[: max(n, 0)][whole], owner[starts][few]]
    fresh = np.r_[True, (out[1:] != out[:-1]) | (of[1:] != of[:-1])]
    return out[fresh], of[fresh]


def fingerprints(texts: DataFrame, key: str, k: int, window: int, lengths: tuple[int, ...], whole: bool) -> DataFrame:
    """(key, digest): the fingerprints of every text. Lengths are those of short items, which must stand whole: such an
    item (`whole`) has one digest, of all its words, and a document those of all its runs of these lengths."""

    def run(batches):
        known = _Hashes()
        for b in batches:
            lists = [words(t) for t in b["text"]]
            sizes = np.array([len(ws) for ws in lists], "int64")
            flat = np.array([known[w] for ws in lists for w in ws], np.uint64)
            owner = np.repeat(np.arange(len(lists)), sizes)
            short = np.isin(sizes, lengths)[owner] if whole else np.zeros(len(owner), bool)
            parts = [winnow(*grams(flat[~short], owner[~short], k), window)]
            parts += [grams(flat, owner, n) for n in lengths if not whole] + [grams(flat[at], owner[at], n) for n in lengths if whole for at in [np.isin(owner, np.flatnonzero(sizes == n))]]
            digest, of = (np.concatenate(x) for x in zip(*parts))
            yield pd.DataFrame({key: b[key].to_numpy()[of], "digest": digest.view(np.int64)})

    return texts.select(key, "text").mapInPandas(run, f"{key} long, digest long")


def equal_runs(doc: list[str], item_grams: dict[tuple, list[int]], item: list[str]) -> list[tuple[int, int, int]]:
    """Maximal equal runs of SEED_RUN words or more as (place in document, place in item, length), in order."""
    out, inside = [], set()
    for j in range(len(doc) - SEED_RUN + 1):
        for i in item_grams.get(tuple(doc[j : j + SEED_RUN]), ()):
            if (i, j) in inside:
                inside.discard((i, j))
                inside.add((i + 1, j + 1))
                continue
            n = SEED_RUN
            while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]:
                n += 1
            out.append((j, i, n))
            inside.add((i + 1, j + 1))
    return out


def common_in_order(a: list[str], b: list[str]) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for q, y in enumerate(b, 1):
            last, row[q] = row[q], last + 1 if x == y else max(row[q], row[q - 1])
    return row[-1]


def covered(doc: list[str], item: list[str], item_grams: dict[tuple, list[int]], gap: int) -> tuple[int, int, int]:
    """(words, begin, end): how many words of the item its best passage covers, and where it stands in the document."""
    runs = equal_runs(doc, item_grams, item)
    best = [(n, j) for j, _, n in runs]
    reach = len(item) + gap
    for a, (j, i, n) in enumerate(runs):
        for b in range(a - 1, -1, -1):
            pj, pi, pn = runs[b]
            if j - pj > reach + pn:
                break
            if pi >= i or pj >= j:
                continue
            so_far, begin = best[b]
            over = max(pj + pn - j, pi + pn - i)
            if over > 0:
                best[a] = max(best[a], (so_far + n - over, begin)) if over < n else best[a]
            elif j - pj - pn <= gap:
                between = doc[pj + pn : j], item[pi + pn : i]
                extra = common_in_order(*between) if len(between[0]) <= FILL and len(between[1]) <= FILL else 0
                best[a] = max(best[a], (so_far + n + extra, begin))
    if not runs:
        return 0, 0, 0
    top = max(range(len(runs)), key=lambda a: (best[a][0], -a))
    return best[top][0], best[top][1], runs[top][0] + runs[top][2]


def at_most(item: list[str], grams_of: list[tuple], doc_grams: set[tuple], has: set[str]) -> int:
    """No passage covers more words of an item: those in its seeds that the document holds, and between these, over gaps
    that may be filled, those that stand anywhere in the document."""
    held = [False] * len(item)
    for i, g in enumerate(grams_of):
        if g in doc_grams:
            held[i : i + SEED_RUN] = [True] * SEED_RUN
    total = filled = gap = 0
    for word, h in zip(item, held):
        if h:
            total += 1 + (filled if total and gap <= FILL else 0)
            filled = gap = 0
        else:
            gap += 1
            filled += word in has
    return total


def passages(documents: DataFrame, items: DataFrame, share: float = SHARE, k: int = K, window: int = WINDOW, gap: int = GAP) -> DataFrame:
    """(doc_id, item_id, share, begin_word, end_word): for each document and item that share a fingerprint, the share of
    the item's words that its best passage in the document covers, if that is at least `share`, and where the passage
    stands (words, the end excluded).

    documents: doc_id, text; items: item_id, text. Null ids, null texts and texts without a word are in no row. Items
    of fewer than k + window - 1 words must stand whole and have the share 1. An item id with several texts counts with
    each, the best passage first; repeats of a row give one row.
    """
    spark = ship(documents.sparkSession)
    scratch = Scratch(spark)
    counted = items.where("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    rows = scratch.keep(counted.withColumn("tid", F.xxhash64("item_id", "text")))
    docs = documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    shortest = k + window - 1

    def lengths(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(words(t)) for t in b["text"]]})

    found = rows.select("text").mapInPandas(lengths, "n int").where(f"n > 0 AND n < {shortest}").distinct().collect()
    short = tuple(sorted(r.n for r in found))
    item_prints = scratch.keep(fingerprints(rows.select(F.col("tid"), "text"), "tid", k, window, short, True).distinct())
    hits = fingerprints(docs, "doc_id", k, window, short, False).join(item_prints, "digest").select("doc_id", "tid").distinct()
    candidates = scratch.keep(hits)
    met = docs.join(candidates, "doc_id").join(rows.select("tid", "item_id", F.col("text").alias("item")), "tid")

    def run(batches):
        @lru_cache(maxsize=4096)
        def known(text: str) -> tuple[list[str], list[tuple], dict]:
            ws = words(text)
            own = seeds_of(ws)
            seeds: dict[tuple, list[int]] = defaultdict(list)
            for i, g in enumerate(own):
                seeds[g].append(i)
            return ws, own, seeds

        def seeds_of(ws: list[str]) -> list[tuple]:
            return list(zip(*(ws[i:] for i in range(SEED_RUN))))

        last, ws, has, doc_grams = None, [], set(), None
        for b in batches:
            out = []
            for d, t, i, x in zip(b["doc_id"], b["text"], b["item_id"], b["item"]):
                if t != last:
                    last, ws = t, words(t)
                    has, doc_grams = set(ws), None
                item, own, seeds = known(x)
                # No passage covers more of an item than the words of it that stand anywhere in the document.
                if sum(map(has.__contains__, item)) < share * len(item):
                    continue
                if len(item) < shortest:
                    at = next((p for p in range(len(ws) - len(item) + 1) if ws[p : p + len(item)] == item), None)
                    n, begin, end = (len(item), at, at + len(item)) if at is not None else (0, 0, 0)
                else:
                    if doc_grams is None:
                        doc_grams = set(seeds_of(ws))
                    if at_most(item, own, doc_grams, has) < share * len(item):
                        continue
                    n, begin, end = covered(ws, item, seeds, gap)
                if n >= share * len(item):
                    out.append((d, i, n / len(item), begin, end))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "share", "begin_word", "end_word"])

    every = met.select("doc_id", "text", "item_id", "item").mapInPandas(run, "doc_id long, item_id long, share double, begin_word int, end_word int")
    best = F.max(F.struct("share", (-F.col("begin_word")).alias("b"), (-F.col("end_word")).alias("e"))).alias("m")
    return every.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.share", (-F.col("m.b")).alias("begin_word"), (-F.col("m.e")).alias("end_word"))


def leaked_items(documents: DataFrame, items: DataFrame, share: float = SHARE, k: int = K, window: int = WINDOW, gap: int = GAP) -> DataFrame:
    """(doc_id, item_id): documents with the items they hold at least `share` of in one passage, see `passages`."""
    return passages(documents, items, share, k, window, gap).select("doc_id", "item_id")


def leak_report(items: DataFrame, found: DataFrame) -> DataFrame:
    """(item_id, split, source, n_documents) of every item, with 0 for one that no document holds."""
    hits = found.groupBy("item_id").agg(F.count("*").alias("n"))
    once = items.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min("split").alias("split"), F.min("source").alias("source"))
    return once.join(hits, "item_id", "left").select("item_id", "split", "source", F.coalesce("n", F.lit(0)).alias("n_documents"))
