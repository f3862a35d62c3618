"""The same or nearly the same records in different splits.

Method: content-defined chunks. A record is normalised to its distinct words in plain lower-case form, brought
into an order that depends on the words alone, so that reordering a text changes nothing. A rolling hash runs over
that sequence; its window is a word, so where it meets the cut condition a chunk ends whatever stands before, and an edit
changes the chunks it touches and no others. Each chunk's digest is joined across splits, and the lengths of the
shared chunks are summed into overlap fractions: of two records (`split_overlaps`) and of a record with all of the
other side (`record_overlaps`). Records are cut in `passes` different orders, as an edit that breaks a chunk in one
order leaves others whole. Pairs whose fraction reaches `overlap` are held against the exact similarity of the words.

* Chunks of under `least_length` words, which grows with the record from one to four, are not posted: shorter ones are shared by
  unrelated records.
* Words that more than `frequent` of all records hold take no part in chunks, unless they are many in a record (see
  `variants`); they count in the exact check.
* A chunk that is not shared meets nothing in the join; records of one split never meet. Chunks that more than `HOT`
  records share are paired in blocks, see `postings`.
* Pairs that cannot reach the similarity end in the task in which they meet, by a bound of `postings` that loses no
  other pair. The orders are joined in `ROUNDS`, so that the chunks of one round alone are shuffled at a time.

`overlap` is two shared chunks or more for most lengths. Two records of similarity 0.7 have a fraction of about 0.05, and one
below `overlap` in about one of 200 cases at the worst length, 34 words. The README has measured figures.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .common import expand_pairs, frequent_words, hash_word, jaccard, row_texts, side_of, variants, word_table
from .postings import CARRIED, meetings, pairs_across, posted_table, rounds_of, word_bits

PASSES, CUT, OVERLAP, ROUNDS = 20, 2, 0.0075, 5
FREQUENT, SIMILARITY, EXPAND_LIMIT, HOT = 0.3, 0.7, 1000, 4_000
#: Low bits of a digest: the chunk's number of words, below 256 but for a chance of 2 ** -255, and above them the side.
LENGTH_BITS, SIDE_BIT, SHIFT = 8, 8, 9
_MIX, _STEP = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


def least_length(n: int) -> int:
    """Words of a posted chunk, at least, of a record of n."""
    return 1 if n < 12 else 2 if n < 20 else 3 if n < 34 else 4


class Chunker:
    """Chunk digests of sets of words."""

    def __init__(self, passes: int, cut: int, ignored: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.turns = rng.integers(1, 1 << 63, passes, dtype=np.uint64) | np.uint64(1)
        self.salts = rng.integers(1, 1 << 63, passes, dtype=np.uint64)
        self.cut, self.ignored = np.uint64(cut), set(ignored.tolist())
        self.known: dict[str, int] = {}

    def hashes(self, ws: list[str]) -> list[int]:
        out = []
        for w in ws:
            h = self.known.get(w)
            if h is None:
                if len(self.known) > 1_000_000:
                    self.known.clear()
                h = self.known[w] = hash_word(w)
            out.append(h)
        return out

    def chunks(self, sets: list[list[str]]) -> tuple[tuple, tuple]:
        """(owner, words, low, high) of every variant of a record, the last two being the bits of its words, and (variant,
        pass, digest) of every posted chunk. Records of one length are cut together."""
        by_length: dict[tuple[int, int], tuple[list, list]] = {}
        for owner, ws in enumerate(sets):
            hashes = self.hashes(ws)
            for kind, some in variants(hashes, hashes, self.ignored):
                owners, rows = by_length.setdefault((len(some), kind), ([], []))
                owners.append(owner)
                rows.append(some)
        found, cut, n_found = [(np.empty(0, "int64"),) * 4], [(np.empty(0, "int64"),) * 3], 0
        for (n, kind), (owners, rows) in by_length.items():
            step = max(1, 200_000 // (n * len(self.turns)))
            for lo in range(0, len(rows), step):
                some = np.array(rows[lo : lo + step], "int64").view(np.uint64)
                bits = (np.bitwise_or.reduce(x, axis=1).view("int64") for x in word_bits(some))
                found.append((np.array(owners[lo : lo + step], "int64"), np.full(len(some), n, "int64"), *bits))
                at, turn, digests = self.cut_rows(some, kind)
                cut.append((at + n_found, turn, digests))
                n_found += len(some)
        return tuple(np.concatenate(x) for x in zip(*found)), tuple(np.concatenate(x) for x in zip(*cut))

    def cut_rows(self, hashes: np.ndarray, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, pass, digest) of the chunks of records of one length. A word's hash, turned for the pass, orders it, and is
        the rolling hash behind it: its upper part says whether a chunk ends there."""
        rows, n = hashes.shape
        passes = len(self.turns)
        turned = hashes[:, None, :] * self.turns[None, :, None]
        turned ^= turned >> np.uint64(32)
        turned *= _MIX
        turned.sort(axis=2)
        ends = (turned >> np.uint64(9)) % self.cut == 0
        ends[:, :, -1] = True
        at = np.flatnonzero(ends)
        rolled = np.cumsum((turned ^ (turned >> np.uint64(29))).ravel() * _STEP, dtype=np.uint64)
        sums = np.diff(rolled[at], prepend=np.uint64(0))
        length = np.diff(at, prepend=-1)
        where = at // n
        digests = (sums + self.salts[where % passes] + np.uint64(kind)) * _MIX
        digests ^= digests >> np.uint64(32)
        digests = (digests << np.uint64(SHIFT)) | np.minimum(length, (1 << LENGTH_BITS) - 1).astype(np.uint64)
        some = length >= least_length(n)
        return where[some] // passes, where[some] % passes, digests[some].view(np.int64)


def chunked(table: DataFrame, passes: int, cut: int, ignored: np.ndarray) -> DataFrame:
    """`posted_table` of the chunks of each class and side of a word table: `key` has the side in `SIDE_BIT` (1: train),
    `load` the class's number of words over that of its variant."""
    rounds = min(ROUNDS, passes)

    def run(batches):
        chunker = Chunker(passes, cut, ignored)
        for b in batches:
            sets = [ws.split(" ") for ws in b.column("words").to_pylist()]
            (owner, n, low, high), (at, turn, digest) = chunker.chunks(sets)
            train = np.array([x == "t" for x in b.column("side").to_pylist()], "int64")
            words = np.array([len(ws) for ws in sets], "int64")
            keys = digest | train[owner[at]] << SIDE_BIT
            turn = turn * rounds // passes
            each = []
            for i in range(rounds):
                own = np.flatnonzero(turn == i)
                own = own[np.argsort(at[own], kind="stable")]
                each.append((np.r_[0, np.cumsum(np.bincount(at[own], minlength=len(owner)))], keys[own]))
            yield b.column("cid").to_numpy(zero_copy_only=False)[owner], words[owner] << 32 | n, low, high, each

    return posted_table(table.where("words IS NOT NULL").select("cid", "side", "words"), rounds, run)


def _sided_words(rows: DataFrame, scratch: Scratch) -> DataFrame:
    sided = rows.select("id", "similarity_text", "input_json", side_of(F.col("split")).alias("side")).where("side <> ''")
    return word_table(row_texts(sided, "side"), scratch, apart=True)


def split_overlaps(
    rows: DataFrame,
    similarity: float = SIMILARITY,
    overlap: float = OVERLAP,
    passes: int = PASSES,
    cut: int = CUT,
    frequent: float = FREQUENT,
    expand_limit: int = EXPAND_LIMIT,
    hot: int = HOT,
) -> DataFrame:
    """(id_a, id_b): similar rows of which one is in train and the other in val or test; the smaller id first.

    rows: id, split, similarity_text, input_json; other columns are ignored. Rows with another or no split, without
    an id or without any word are in no pair. A repeated row counts once; copies are one class until the end. Beyond
    `expand_limit` rows with one text, see `expand_pairs`.
    """
    spark = ship(rows.sparkSession)
    scratch = Scratch(spark)
    table = _sided_words(rows, scratch)
    signed = scratch.keep(chunked(table, passes, cut, frequent_words(table, frequent)))

    def fold(ka, kb, la, lb):
        """A chunk's share of the smaller record."""
        return (ka & ((1 << LENGTH_BITS) - 1)) / (passes * np.minimum(la & 0xFFFFFFFF, lb & 0xFFFFFFFF))

    def folded(ka, kb, la, lb):
        ma, mb = la.bitwiseAND(0xFFFFFFFF), lb.bitwiseAND(0xFFFFFFFF)
        return ka.bitwiseAND((1 << LENGTH_BITS) - 1) / (passes * F.least(ma, mb))

    train = lambda k: F.shiftright(k, SIDE_BIT).bitwiseAND(1) == 1
    met = meetings(rounds_of(signed), SHIFT, similarity, pairs_across(SIDE_BIT), fold, hot, scratch, lambda ka, kb: train(ka) & ~train(kb), folded)
    scratch.drop(signed)
    pairs = scratch.keep(met.where("ca <> cb").groupBy("ca", "cb").agg(F.sum("v").alias("share")).where(F.col("share") >= overlap).select("ca", "cb"), free=True)
    word_rows = table.where("words IS NOT NULL").select("cid", "words")
    ends = pairs.select(F.col("ca").alias("cid")).union(pairs.select("cb")).distinct()
    known = word_rows.join(ends, "cid", "left_semi").dropDuplicates(["cid"])
    wa, wb = known.select(F.col("cid").alias("ca"), F.col("words").alias("wa")), known.select(F.col("cid").alias("cb"), F.col("words").alias("wb"))
    alike = pairs.join(wa, "ca").join(wb, "cb").where(jaccard(F.col("wa"), F.col("wb")) >= similarity).select("ca", "cb")
    members = table.where("id IS NOT NULL").select("cid", "tid", "side", "id").distinct()
    return expand_pairs(scratch.keep(alike, free=True), members, expand_limit, scratch, across=True)


def record_overlaps(rows: DataFrame, passes: int = PASSES, cut: int = CUT, frequent: float = FREQUENT) -> DataFrame:
    """(id, side, overlap) of every train row (side `t`) and val or test row (`h`) with a word: the share of its chunks,
    by length, that stand in some row of the other side. 1 for a row whose words are those of one there.

    rows: as `split_overlaps`; a row without a posted chunk has 0.
    """
    spark = ship(rows.sparkSession)
    scratch = Scratch(spark)
    table = _sided_words(rows, scratch)
    train, bits = F.shiftright("key", SIDE_BIT).bitwiseAND(1), F.col("key").bitwiseAND((1 << LENGTH_BITS) - 1)
    signed = chunked(table, passes, cut, frequent_words(table, frequent))
    keys = signed.select(F.explode(F.concat(*signed.columns[1 + len(CARRIED) :])).alias("key"), "cid")
    posted = keys.select(F.shiftright("key", SHIFT).alias("digest"), train.alias("side"), bits.alias("words"), "cid")
    # A digest's sides come from an aggregate that is one row per task and digest before it is shuffled.
    both = posted.groupBy("digest").agg(F.min("side").alias("lo"), F.max("side").alias("hi")).where("lo <> hi").select("digest", F.lit(1).alias("shared"))
    sums = posted.distinct().join(both, "digest", "left").groupBy("cid", "side").agg((F.sum(F.col("words") * F.coalesce("shared", F.lit(0))) / F.sum("words")).alias("overlap"))
    share = sums.select("cid", F.when(F.col("side") == 1, "t").otherwise("h").alias("side"), "overlap")
    members = table.where("id IS NOT NULL").select("cid", "side", "id").distinct()
    return members.join(share, ["cid", "side"], "left").groupBy("id", "side").agg(F.max(F.coalesce("overlap", F.lit(0.0))).alias("overlap"))


def overlap_report(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(split, source, n_rows, n_overlapping): per split and source, its rows and those that stand in another split."""
    ids = found.select(F.col("id_a").alias("id")).union(found.select("id_b")).distinct().withColumn("hit", F.lit(1))
    once = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("split").alias("split"), F.min("source").alias("source"))
    return once.join(ids, "id", "left").groupBy("split", "source").agg(F.count("*").alias("n_rows"), F.count("hit").alias("n_overlapping"))
