"""Records that are equal but for formatting: one record kept each, with the number of copies.

Method: recursive radix partitioning on canonical bytes, then counting in tries.

1. The canonical bytes of an input hold scene, action and the other fields in a fixed order, with layout, key
   order, look-alike characters, letter case, punctuation and white space removed from scene and action.
2. Each task counts its own records in a trie, so a text that a third of all records share leaves a task once.
3. Buckets are the first bytes of the canonical form. A bucket of more than `capacity` entries is split by
   twice as many bytes, again and again until each fits or all of its entries are one text.
4. Every bucket is counted in a trie whose terminal nodes hold the number of records, the smallest and the
   largest id. A set of copies is a terminal with two different ids.
"""

from __future__ import annotations

import json
import re
from functools import reduce

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship
from .plainform import plain

SPOKEN = ("scene", "player_action", "observed_event")
CAPACITY, FIRST_BYTES = 50_000, 8
#: Texts that a task's trie holds before its counters are written out and counting starts anew.
TASK_TEXTS = 200_000
HOT, SALTS = 0.01, 32
_ASIDE = re.compile(r"[\W_]+")


def canonical(text: str | None) -> bytes | None:
    """Canonical bytes of an input; None for null. Text that is no JSON object stands for itself in plain form."""
    if text is None:
        return None
    try:
        o = json.loads(text)
    except (ValueError, RecursionError):
        o = None
    if not isinstance(o, dict):
        return b"\x02" + plain(text).encode("utf-8", "surrogatepass")
    said = [f"{_ASIDE.sub('', plain(o[k]).lower())}\x00{k}" if isinstance(o.get(k), str) else f"\x01{json.dumps(o[k], sort_keys=True)}\x00{k}" for k in SPOKEN if k in o]
    rest = {k: v for k, v in o.items() if k not in SPOKEN}
    return "\x00".join([*said, json.dumps(rest, sort_keys=True)]).encode("utf-8", "surrogatepass")


class CountTrie:
    """A burst trie over bytes: a node keeps up to `burst` suffixes whole before it splits by the next byte.

    A terminal counter is [records, smallest id, largest id].
    """

    def __init__(self, burst: int = 64):
        self.burst = burst
        self.root: dict = {}

    def add(self, key: bytes, n: int, low: str, high: str) -> bool:
        """True if the key is new."""
        node, at = self.root, 0
        while "down" in node:
            down, head = node["down"], key[at : at + 1]
            node, at = down.setdefault(head, {}), at + len(head)
        rest = key[at:]
        if (c := node.get(rest)) is not None:
            c[0] += n
            if low < c[1]:
                c[1] = low
            if high > c[2]:
                c[2] = high
            return False
        node[rest] = [n, low, high]
        if len(node) > self.burst:
            down: dict = {}
            for suffix, c in node.items():
                down.setdefault(suffix[:1], {})[suffix[1:]] = c
            node.clear()
            node["down"] = down
        return True

    def items(self):
        todo = [(b"", self.root)]
        while todo:
            head, node = todo.pop()
            if "down" in node:
                # the empty key ends a text: its node never splits further, having the empty suffix alone
                todo += [(head + k, child) for k, child in node["down"].items()]
            else:
                yield from ((head + suffix, c) for suffix, c in node.items())


def _local(rows: DataFrame) -> DataFrame:
    """Rows as (id, digest) and, behind the last of a task, its trie's terminals as (canon, digest, n, low, high)."""

    def terminals(trie):
        found = list(trie.items())
        for lo in range(0, len(found), 10_000):
            some = found[lo : lo + 10_000]
            counts = pd.DataFrame([c for _, c in some], columns=["n", "low", "high"])
            keys = [k for k, _ in some]
            yield counts.assign(id=None, digest=[xxhash.xxh3_128_digest(k) for k in keys], canon=keys)[order]

    def run(batches):
        trie, texts = CountTrie(), 0
        for b in batches:
            ids, digests = [], []
            for i, t in zip(b["id"], b["input_json"]):
                if (c := canonical(t)) is not None:
                    texts += trie.add(c, 1, i, i)
                    ids.append(i)
                    digests.append(xxhash.xxh3_128_digest(c))
            yield pd.DataFrame({"id": ids, "digest": digests, "canon": None, "n": 0, "low": None, "high": None})
            if texts > TASK_TEXTS:
                yield from terminals(trie)
                trie, texts = CountTrie(), 0
        yield from terminals(trie)

    order = ["id", "digest", "canon", "n", "low", "high"]
    picked = rows.where("id IS NOT NULL").select("id", "input_json")
    return picked.mapInPandas(run, "id string, digest binary, canon binary, n long, low string, high string")


def radix_buckets(entries: DataFrame, capacity: int, scratch: Scratch) -> DataFrame:
    """The entries with their bucket: a hash of the leading bytes that their bucket was split by."""
    parts, todo, depth = [], entries, FIRST_BYTES
    while True:
        head = F.substring("canon", 1, depth)
        sizes = todo.groupBy(head.alias("head")).agg(F.count("*").alias("entries"), F.max(F.length("canon")).alias("longest"))
        large = scratch.keep(sizes.where((F.col("entries") > capacity) & (F.col("longest") > depth)).select("head"))
        todo = todo.withColumn("head", head)
        if large.isEmpty():
            parts.append(todo)
            break
        parts.append(todo.join(large, "head", "left_anti").select(*todo.columns))
        todo, depth = todo.join(large, "head", "left_semi").select(*entries.columns), depth * 2
    buckets = [p.select(*entries.columns, F.xxhash64(F.lit(k), "head").alias("bucket")) for k, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, buckets)


def text_sets(entries: DataFrame) -> DataFrame:
    """(digest, n, low, high) of every text: its terminal counter in the trie of its bucket. Buckets come one behind the
    other, so a task holds one trie at a time."""

    def terminals(trie: CountTrie) -> pd.DataFrame:
        return pd.DataFrame([(xxhash.xxh3_128_digest(k), *c) for k, c in trie.items()], columns=["digest", "n", "low", "high"])

    def run(batches):
        trie, at = CountTrie(), None
        for b in batches:
            for bucket, canon, n, low, high in zip(b["bucket"], b["canon"], b["n"], b["low"], b["high"]):
                if bucket != at:
                    if at is not None:
                        yield terminals(trie)
                    trie, at = CountTrie(), bucket
                trie.add(canon, n, low, high)
        if at is not None:
            yield terminals(trie)

    picked = entries.select("bucket", "canon", "n", "low", "high").repartition("bucket").sortWithinPartitions("bucket")
    return picked.mapInPandas(run, "digest binary, n long, low string, high string")


def _counted(rows: DataFrame, capacity: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(digest, id) of every record, and the sets of `text_sets`."""
    local = scratch.keep(_local(rows))
    entries = local.where("canon IS NOT NULL").select("digest", "canon", "n", "low", "high")
    return local.where("id IS NOT NULL").select("digest", "id"), text_sets(radix_buckets(entries, capacity, scratch))


def format_duplicates(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(keep_id, copy_id): for each set of equal records its smallest id and each other id.

    rows: id, input_json. Rows without an id or input take no part; inputs that are no JSON object are equal when
    their plain forms are. A row delivered again under its own id is no copy.
    """
    spark = ship(rows.sparkSession)
    scratch = Scratch(spark)
    members, sets = _counted(rows, capacity, scratch)
    sets = scratch.keep(sets.where("low <> high"))
    # A set that holds over HOT of all rows is met in SALTS partitions instead of one; there are at most 1 / HOT.
    total = members.count()
    hot = sets.where(F.col("n") > HOT * total).select("digest")
    salted = members.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left").select(
        "digest", "id", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(SALTS))).otherwise(F.lit(0)).alias("salt")
    )
    spread = sets.select("digest", F.col("low").alias("keep_id"), F.explode(F.when(F.col("n") > HOT * total, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt"))
    return salted.join(spread.withColumn("salt", F.col("salt").cast("long")), ["digest", "salt"]).where("id <> keep_id").select("keep_id", F.col("id").alias("copy_id")).distinct()


def collapsed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(keep_id, copies): one row per set of equal records, single ones too: its smallest id and its number of ids.

    The numbers are the terminal counters, less the records that were delivered again under their own id.
    """
    spark = ship(rows.sparkSession)
    members, sets = _counted(rows, capacity, Scratch(spark))
    again = members.groupBy("digest", "id").agg((F.count("*") - 1).alias("more")).where("more > 0")
    surplus = again.groupBy("digest").agg(F.sum("more").alias("more"))
    return sets.join(surplus, "digest", "left").select(F.col("low").alias("keep_id"), (F.col("n") - F.coalesce("more", F.lit(0))).alias("copies"))
