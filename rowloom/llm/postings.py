"""Inverted join: records are posted under keys, and records that share a key meet.

Postings are shuffled by key once and come sorted, so that those of a key are a run. One pass over the runs
emits the pairs of each; a key that one record alone has is skipped. A run of more than `hot` postings is not paired
there: its postings are handed on, cut into blocks and paired block by block in tasks of their own.

Unlike records that meet are dropped in the task in which they meet, and are never written: their number grows with the
square of the input. A posting carries its record's number of words and 128 bits, of which each word sets one. Every bit
that one of two records has and the other has not is a word of one alone, so these bits bound the similarity from above;
no pair that reaches it is lost. Postings are shuffled in rounds, each freed before the next.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch

#: Pairs of a chunk of output.
CHUNK = 1 << 18
#: What a posting carries beside key and cid, all long. `load`: the record's words over 32 bits of the caller's; `low` and `high`: see `word_bits`.
CARRIED = ["load", "low", "high"]
SCHEMA = "ca long, cb long, v double, key long, load long, low long, high long"
TYPES = [pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4]
_STEP = np.uint64(0x9E3779B97F4A7C15)


def word_bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bit of each word in `low` and in `high`, one of the two being 0; those of a record are joined by or."""
    place = (hashes * _STEP) >> np.uint64(57)
    bit, upper = np.uint64(1) << (place & np.uint64(63)), place >= 64
    return np.where(upper, np.uint64(0), bit), np.where(upper, bit, np.uint64(0))


def posted_table(table: DataFrame, rounds: int, lists: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]) -> DataFrame:
    """(cid, load, low, high, k0, k1, ...): a row per record, with its keys of each round. lists: (cid, load, low, high,
    [(offsets, keys) of each round]) of batches of `table`."""

    def run(batches):
        for *columns, keys in lists(batches):
            arrays = [pa.array(x.view("int64"), pa.int64()) for x in columns]
            arrays += [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(x.view("int64"), pa.int64())) for at, x in keys]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["cid", *CARRIED, *(f"k{i}" for i in range(rounds))]
    return table.mapInArrow(run, ", ".join(f"{x} long" for x in names[:4]) + "".join(f", {x} array<long>" for x in names[4:]))


def rounds_of(signed: DataFrame) -> list[DataFrame]:
    """The postings of each round of a `posted_table`."""
    return [signed.select(F.explode(k).alias("key"), "cid", *CARRIED) for k in signed.columns[4:]]


def _near(similarity: float, a: tuple, b: tuple) -> np.ndarray:
    """Whether records may reach the Jaccard similarity. a, b: (load, low, high)."""
    na, nb = a[0] >> 32, b[0] >> 32
    bits = sum(np.bitwise_count((x ^ y).view("uint64")).astype("int64") for x, y in zip(a[1:], b[1:]))
    return (1 + similarity) * np.maximum(bits, np.abs(na - nb)) <= (1 - similarity) * (na + nb) + 1e-6


def _near_columns(similarity: float) -> Column:
    """The same of columns load_a, load_b, and so on."""
    na, nb = F.shiftright("load_a", 32), F.shiftright("load_b", 32)
    bits = sum((F.bit_count(F.col(f"{x}_a").bitwiseXOR(F.col(f"{x}_b"))) for x in CARRIED[1:]), F.lit(0))
    return (1 + similarity) * F.greatest(bits.cast("long"), F.abs(na - nb)) <= (1 - similarity) * (na + nb) + 1e-6


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], "int64")
    return starts, np.diff(np.r_[starts, len(keys)])


def _chunks(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(run, nth) of every pair, where run r has counts[r] pairs, in chunks of about `CHUNK`."""
    ends = np.cumsum(counts)
    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CHUNK, "right")))
        some = counts[lo:hi]
        run = np.repeat(np.arange(lo, hi), some)
        yield run, np.arange(len(run)) - np.repeat(np.cumsum(some) - some, some)
        lo = hi


def pairs_within(packed: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (earlier, later) of every two postings of a run."""
    for run, nth in _chunks(sizes * (sizes - 1) // 2):
        later = ((1 + np.sqrt(1 + 8 * nth.astype("float64"))) / 2).astype("int64")
        later -= later * (later - 1) // 2 > nth
        yield starts[run] + nth - later * (later - 1) // 2, starts[run] + later


def pairs_across(bit: int) -> Callable:
    """Places (a, b) of every two postings of a run of which a has the bit of the packed key and b has not."""

    def across(packed: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        before = np.r_[0, np.cumsum(((packed >> bit) & 1) == 0)]
        first = before[starts + sizes] - before[starts]
        rest = sizes - first
        for run, nth in _chunks(first * rest):
            yield starts[run] + first[run] + nth // first[run], starts[run] + nth % first[run]

    return across


def _merge(batches, shift: int, hot: int, similarity: float, pair: Callable, fold: Callable):
    """Record batches of pairs and of the postings of hot runs, from sorted batches of (key, cid, load, low, high)."""

    def out(ca, cb, v, rest=(None,) * 4):
        columns = [pa.nulls(len(ca), t) if x is None else pa.array(x, t) for x, t in zip((ca, cb, v, *rest), TYPES)]
        return pa.RecordBatch.from_arrays(columns, names=["ca", "cb", "v", "key", *CARRIED])

    def handed_on(key, cid, *carried):
        return out(cid, None, None, (key, *carried))

    def close(own, key, cid, *carried):
        """Pairs of whole runs; those of hot ones as postings."""
        starts, sizes = _runs(own)
        large = sizes > hot
        for s, n in zip(starts[large], sizes[large]):
            yield handed_on(*(x[s : s + n] for x in (key, cid, *carried)))
        some = (sizes > 1) & ~large
        for a, b in pair(key, starts[some], sizes[some]):
            keep = _near(similarity, tuple(x[a] for x in carried), tuple(x[b] for x in carried))
            a, b = a[keep], b[keep]
            if len(a):
                yield out(cid[a], cid[b], fold(key[a], key[b], carried[0][a], carried[0][b]))

    kept, open_hot = None, None
    for batch in batches:
        postings = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(2 + len(CARRIED))]
        if kept is not None:
            postings = [np.concatenate(x) for x in zip(kept, postings)]
        key, cid = postings[:2]
        if not len(key):
            continue
        fresh = np.r_[True, (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])]
        postings = [x[fresh] for x in postings]
        own = postings[0] >> shift
        if open_hot is not None:
            n = int(np.searchsorted(own != open_hot, True))
            if n:
                yield handed_on(*(x[:n] for x in postings))
                postings, own = [x[n:] for x in postings], own[n:]
            if not len(own):
                kept = None
                continue
            open_hot = None
        last = int(_runs(own)[0][-1])
        yield from close(own[:last], *(x[:last] for x in postings))
        kept = [x[last:] for x in postings]
        if len(own) - last > hot:
            open_hot = own[-1]
            yield handed_on(*kept)
            kept = None
    if kept is not None and len(kept[0]):
        yield from close(kept[0] >> shift, *kept)


def meetings(
    rounds: list[DataFrame],
    shift: int,
    similarity: float,
    pair: Callable,
    fold: Callable,
    hot: int,
    scratch: Scratch,
    both: Callable[[Column, Column], Column],
    folded: Callable[..., Column],
) -> DataFrame:
    """(ca, cb, v) of every two postings that meet under a key, but for some of records below the Jaccard similarity.

    rounds: postings (key, cid, load, low, high): the bits of `key` from `shift` on are what records meet under; a repeated
    (key, cid) counts once. Postings of different rounds do not meet. pair: `pairs_within` or `pairs_across`. fold(ka, kb,
    la, lb): the value of meetings. both and folded state the same of Columns, for the postings of hot keys: whether two
    postings are a pair, and the fold.
    """

    def run(batches):
        return _merge(batches, shift, hot, similarity, pair, fold)

    own = F.shiftright("key", shift) if shift else F.col("key")
    met, large = [], []
    for i, posted in enumerate(rounds):
        ordered = posted.repartition(own).sortWithinPartitions("key", "cid").select("key", "cid", *CARRIED)
        found = scratch.keep(ordered.mapInArrow(run, SCHEMA), free=True)
        met.append(found.where("cb IS NOT NULL").select("ca", "cb", "v"))
        large.append(found.where("cb IS NULL").select(F.lit(i).alias("round"), own.alias("own"), "key", F.col("ca").alias("cid"), *CARRIED))
    met, large = reduce(DataFrame.union, met), reduce(DataFrame.union, large).distinct()
    if large.isEmpty():
        return met
    at = ["round", "own"]
    blocks = large.groupBy(*at).agg(F.ceil(F.count("*") / hot).cast("int").alias("of"))
    in_block = large.join(blocks, at).withColumn("i", F.pmod(F.xxhash64("cid"), "of").cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("of") - 1))
    a = in_block.select(*at, "i", each.alias("j"), F.col("key").alias("ka"), F.col("cid").alias("ca"), *(F.col(x).alias(f"{x}_a") for x in CARRIED))
    b = in_block.select(*at, F.col("i").alias("j"), each.alias("i"), F.col("key").alias("kb"), F.col("cid").alias("cb"), *(F.col(x).alias(f"{x}_b") for x in CARRIED))
    v = folded(F.col("ka"), F.col("kb"), F.col("load_a"), F.col("load_b"))
    apart = a.join(b, [*at, "i", "j"]).where(both(F.col("ka"), F.col("kb")) & _near_columns(similarity)).where("ca <> cb")
    return met.unionByName(apart.select("ca", "cb", v.cast("double").alias("v")))
