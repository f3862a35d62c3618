"""Near-duplicate records with small edits.

Method: an inverted join over signature coordinates. The signature of a record has `coordinates` values; each
is a hash of `width` minima of hash functions over the record's distinct words, so two records agree in one
coordinate with probability J^width (J: their Jaccard similarity). Each minimum takes part in two coordinates, with
others each time: half as many are computed, and coordinates stay nearly independent. Every record is posted under
each (coordinate, value); a self-join of the postings counts the collisions of two records, and pairs with at
least `match` of them are held against the exact similarity.

* Records with the same set of words are one class and are posted once per task.
* Words that more than `frequent` of all records hold (counted over all of them) take no part in the signature:
  they make unrelated records collide and hardly tell copies apart. They count in the exact check. A record in
  which they are many is (also) posted with all of its words, see `variants`.
* Prefix and skip merging: of two records that agree in `match` of K coordinates, at least one agreement is among the
  first K - match + 1. Only these lists are merged. The other match - 1 coordinates are never posted: each
  posting carries sixteen bits of them beside the 48 of its own value, and they are compared only for pairs that met
  in the prefix. A value that one class alone has is skipped, and a pair whose prefix count and rest stay below
  `match` ends there. Values held by more than `HOT` classes are paired in blocks, see `postings`.
* Pairs that cannot reach the similarity end in the task in which they meet, by a bound of `postings` that loses no
  other pair. The lists are merged in `ROUNDS`, so that the postings of one round alone are on disk at a time.

Expected recall is 1 - P(Binomial(K, J'^width) < match), J' being the similarity of the words that count: above
0.99 for J' = 0.66 (to which ignored words can lower a J of 0.7) and above 0.9999 for J' = 0.8. The README has
measured figures.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .common import expand_pairs, frequent_words, hash_word, jaccard, row_texts, side_of, variants, word_table
from .postings import meetings, pairs_within, posted_table, rounds_of, word_bits

COORDINATES, WIDTH, MATCH = 50, 5, 2
HOT, REST, ROUNDS = 4_000, 16, 5
FREQUENT = 0.3
SIMILARITY = 0.7
EXPAND_LIMIT = 1000
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


class Signer:
    """Signature coordinates of sets of words; the same on every machine for the same parameters."""

    def __init__(self, coordinates: int, width: int, ignored: np.ndarray, seed: int = 20):
        rng = np.random.default_rng(seed)
        n = -(-coordinates * width // 2)
        self.k, self.r, self.ignored = coordinates, width, set(ignored.tolist())
        self.of = np.concatenate([rng.permutation(n), rng.permutation(n)])[: coordinates * width].reshape(coordinates, width)
        self.mul = rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1)
        self.add = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        self.mix = rng.integers(1, 1 << 63, width, dtype=np.uint64) | np.uint64(1)
        self.at = rng.integers(1, 1 << 63, coordinates, dtype=np.uint64)

    def sign(self, sets: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(owners, keys, low, high): the places of the sets, the coordinate values of each and the bits of its words, twice for
        a set with two variants. No set is empty."""
        known: dict[str, int] = {}
        hashes: list[int] = []
        owners, kinds, starts, flat = [], [], [], []
        for owner, ws in enumerate(sets):
            at = []
            for w in ws:
                if w not in known:
                    known[w] = len(hashes)
                    hashes.append(hash_word(w))
                at.append(known[w])
            for kind, some in variants(at, [hashes[i] for i in at], self.ignored):
                owners.append(owner)
                kinds.append(kind)
                starts.append(len(flat))
                flat += some
        x = np.array(hashes, "int64").view(np.uint64)
        table = ((x[:, None] * self.mul[None, :] + self.add[None, :]) >> np.uint64(32)).astype(np.uint32)
        flat_at, begin = np.array(flat, "int64"), np.array(starts + [len(flat)])
        out = np.empty((len(owners), self.k), np.uint64)
        for lo in range(0, len(owners), 256):
            hi = min(lo + 256, len(owners))
            low = np.minimum.reduceat(table[flat_at[begin[lo] : begin[hi]]], begin[lo:hi] - begin[lo], axis=0)
            mixed = (low[:, self.of].astype(np.uint64) * self.mix).sum(axis=2, dtype=np.uint64) * _STEP
            salt = self.at + np.array(kinds[lo:hi], np.uint64)[:, None] * _STEP
            keys = (mixed + salt) * _MIX
            out[lo:hi] = keys ^ keys >> np.uint64(32)
        low, high = (np.bitwise_or.reduceat(bits[flat_at], begin[:-1]) if len(owners) else np.empty(0, np.uint64) for bits in word_bits(x))
        return np.array(owners, "int64"), out, low, high


def signatures(table: DataFrame, coordinates: int, width: int, match: int, frequent: float) -> DataFrame:
    """`posted_table` of each class of a word table, once per task of it and variant: the values of the first K - match + 1
    coordinates, each over `REST` bits of the others."""
    ignored = frequent_words(table, frequent)
    prefix, bits = coordinates - match + 1, _bits(match)
    shifts = np.arange(match - 1, dtype=np.uint64) * np.uint64(bits)
    parts = np.array_split(np.arange(prefix), min(ROUNDS, prefix))

    def run(batches):
        signer = Signer(coordinates, width, ignored)
        for b in batches:
            sets = [ws.split(" ") for ws in b.column("words").to_pylist()]
            owners, keys, low, high = signer.sign(sets)
            rest = ((keys[:, prefix:] >> np.uint64(64 - bits)) << shifts).sum(axis=1, dtype=np.uint64)
            packed = (keys[:, :prefix] & ~np.uint64((1 << REST) - 1)) | rest[:, None]
            load = np.array([len(ws) for ws in sets], "int64")[owners] << 32
            each = [(np.arange(len(owners) + 1) * len(part), packed[:, part].ravel()) for part in parts]
            yield b.column("cid").to_numpy(zero_copy_only=False)[owners], load, low, high, each

    return posted_table(table.where("words IS NOT NULL").select("cid", "words"), len(parts), run)


def _bits(match: int) -> int:
    """Bits of each coordinate beyond the prefix that a posting carries."""
    return REST // max(1, match - 1)


def class_pairs(table: DataFrame, signed: DataFrame, match: int, similarity: float, scratch: Scratch, hot: int = HOT) -> DataFrame:
    """(ca, cb, similarity): classes at or above the similarity, the smaller first."""
    bits = _bits(match)
    low = (1 << bits) - 1

    def fold(ka, kb, la, lb):
        return sum(((ka >> s & low) == (kb >> s & low) for s in range(0, bits * (match - 1), bits)), np.zeros(len(ka)))

    def folded(ka, kb, la, lb):
        at = lambda c, s: F.shiftright(c, s).bitwiseAND(low)
        return sum(((at(ka, s) == at(kb, s)).cast("int") for s in range(0, bits * (match - 1), bits)), F.lit(0))

    signed = scratch.keep(signed)
    met = meetings(rounds_of(signed), REST, similarity, pairs_within, fold, hot, scratch, lambda ka, kb: F.col("ca") < F.col("cb"), folded)
    scratch.drop(signed)
    ends = F.least("ca", "cb").alias("ca"), F.greatest("ca", "cb").alias("cb")
    met = met.select(*ends, "v").groupBy("ca", "cb").agg(F.count("*").alias("n"), F.max("v").alias("rest"))
    pairs = scratch.keep(met.where(F.col("n") + F.col("rest") >= match).select("ca", "cb"), free=True)
    ends = pairs.select(F.col("ca").alias("cid")).union(pairs.select("cb")).distinct()
    texts = table.where("words IS NOT NULL").select("cid", "words").join(ends, "cid", "left_semi").dropDuplicates(["cid"])
    a = texts.select(F.col("cid").alias("ca"), F.col("words").alias("wa"))
    b = texts.select(F.col("cid").alias("cb"), F.col("words").alias("wb"))
    return (
        pairs.join(a, "ca").join(b, "cb")
        .withColumn("similarity", jaccard(F.col("wa"), F.col("wb")))
        .where(F.col("similarity") >= similarity)
        .select("ca", "cb", "similarity")
    )


def near_duplicates(
    rows: DataFrame,
    similarity: float = SIMILARITY,
    coordinates: int = COORDINATES,
    width: int = WIDTH,
    match: int = MATCH,
    frequent: float = FREQUENT,
    expand_limit: int = EXPAND_LIMIT,
    hot: int = HOT,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (id_a, id_b), members (id, cid) and class pairs (ca, cb, similarity) of similar rows.

    rows: id, similarity_text, input_json and, if there, split; other columns are ignored. The text of a row is
    similarity_text, or where that is null or blank the strings of input_json. Rows without an id or without any word
    are in no pair. A repeated row counts once. More than `expand_limit` rows with one and the same text are paired as
    a star, see `expand_pairs`; rows with equal words in different texts are all paired. match: 1 to 5.
    """
    if not 1 <= match <= min(5, coordinates):
        raise ValueError("match is 1 to 5, and at most the number of coordinates")
    spark = ship(rows.sparkSession)
    scratch = Scratch(spark)
    side = side_of(F.col("split")) if "split" in rows.columns else F.lit("")
    table = word_table(row_texts(rows.withColumn("side", side), "side"), scratch)
    signed = signatures(table, coordinates, width, match, frequent)
    members = table.where("id IS NOT NULL").select("cid", "tid", "side", "id").distinct()
    linked = scratch.keep(class_pairs(table, signed, match, similarity, scratch, hot), free=True)
    return expand_pairs(linked, members, expand_limit, scratch), members.select("id", "cid").distinct(), linked


def linked_members(members: DataFrame, linked: DataFrame) -> DataFrame:
    """(id, class_id, n_links) of every row with a word, whatever the size of its class.

    Rows of one class_id, the smallest id among them, have equal words. n_links is the number of other rows that a row is
    similar to: those of its class and of the classes paired with it. members and linked are what `near_duplicates` returns.
    """
    classes = members.groupBy("cid").agg(F.count("*").alias("n"), F.min("id").alias("class_id"))
    both = linked.select(F.col("ca").alias("at"), F.col("cb").alias("cid")).union(linked.select("cb", "ca"))
    more = both.join(classes.select("cid", "n"), "cid").groupBy(F.col("at").alias("cid")).agg(F.sum("n").alias("more"))
    known = classes.join(more, "cid", "left").select("cid", "class_id", (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    return members.join(known, "cid").select("id", "class_id", "n_links")
