"""Filling containers of fixed capacity with documents.

Method: bin completion. The largest document left opens a container; the fillings of the rest of it are enumerated,
fullest first, without those that another filling dominates (an item or a pair of it could be exchanged for a larger
item that is left and still fits). The search goes depth first; a branch ends when the waste made so far exceeds
what a packing with fewer containers than the incumbent can afford. The first incumbent is best-fit decreasing, and
the search ends at the waste bound or after `NODES` containers tried beyond those of a packing. Of the fillings of a
container at most `TRIES` are enumerated and the `BRANCHES` of least waste are branched on. The problem is NP-hard: these
three limits cut the search, never a document; the README says how often each of them ends it.

Documents are dealt by a hash of their id to shards of about `per_shard`, which are packed independently: no shard
can be large, whatever source or kind prevails, and a shard leaves at most one container partly empty beyond its
bound. A text longer than the capacity is cut into full containers and a rest; no other text is cut.
"""

from __future__ import annotations

import base64
from bisect import bisect_right, insort
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that this vocabulary's texts are cut by before the merges.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
PER_SHARD, NODES, TRIES, BRANCHES = 8_000, 4_000, 60, 3


@lru_cache(maxsize=2)
def _encoding(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens): the whole text's number of tokens; 0 for a null or empty text. The vocabulary file (under
    2 MB) is read by the driver and sent to the tasks."""
    with open(tokenizer, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoding = _encoding(ranks.value)
        for b in batches:
            counts = [len(encoding.encode_ordinary(t.encode("utf-8", "replace").decode())) if t else 0 for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": counts})

    return documents.where("doc_id IS NOT NULL").select("doc_id", "text").mapInPandas(run, "doc_id long, tokens long")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: containers as lists of sizes."""
    free: list[tuple[int, int]] = []
    out: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        at = bisect_right(free, (s, -1))
        room, k = free.pop(at) if at < len(free) else (capacity, len(out))
        if k == len(out):
            out.append([])
        out[k].append(s)
        insort(free, (room - s, k))
    return out


class Left:
    """The multiset of sizes that are left, in ascending order of the different ones."""

    def __init__(self, sizes: list[int]):
        self.count: dict[int, int] = {}
        for s in sizes:
            self.count[s] = self.count.get(s, 0) + 1
        self.sizes = sorted(self.count)

    def take(self, s: int) -> None:
        if self.count[s] == 1:
            del self.count[s]
            self.sizes.pop(bisect_right(self.sizes, s) - 1)
        else:
            self.count[s] -= 1

    def give(self, s: int) -> None:
        if s in self.count:
            self.count[s] += 1
        else:
            self.count[s] = 1
            insort(self.sizes, s)

    def fillings(self, room: int, tries: int) -> list[tuple[int, tuple[int, ...]]]:
        """(waste, sizes) of undominated fillings of the room, least waste first; the first is found in any case."""
        found: dict[tuple[int, ...], int] = {}

        def grow(chosen: tuple[int, ...], room: int, below: int) -> bool:
            nonlocal tries
            at, full = bisect_right(self.sizes, min(room, below)) - 1, True
            while at >= 0:
                s, full = self.sizes[at], False
                most = min(self.count[s], room // s)
                for k in {most: 1, max(1, most - 1): 1}:
                    if tries <= 0 and found:
                        return False
                    tries -= 1
                    if grow((*chosen, *(s,) * k), room - k * s, s - 1):
                        return True
                at -= 1
            if full:
                found[chosen] = room
            return full and room == 0

        grow((), room, room)
        kept = [(w, c) for c, w in found.items() if not self._dominated(c, w)]
        return sorted(kept or [(w, c) for c, w in found.items()], key=lambda x: (x[0], len(x[1])))

    def _dominated(self, chosen: tuple[int, ...], waste: int) -> bool:
        parts = {0, *chosen, *(a + b for i, a in enumerate(chosen) for b in chosen[i + 1 :])}
        for p in parts:
            at = bisect_right(self.sizes, p + waste) - 1
            if at >= 0 and self.sizes[at] > p and chosen.count(self.sizes[at]) < self.count[self.sizes[at]]:
                return True
        return False


def bin_completion(sizes: list[int], capacity: int, nodes: int = NODES, tries: int = TRIES, ended: list | None = None) -> list[list[int]]:
    """Containers as lists of sizes; every size is 1 to capacity.

    ended: takes how the search ended: `bound` at the least number that the total allows, `searched` with every kept
    filling tried, `nodes` at their limit.
    """
    best = best_fit(sizes, capacity)
    total = sum(sizes)
    bound = -(-total // capacity)
    ended = [] if ended is None else ended
    if len(best) <= bound:
        ended.append("bound")
        return best
    left, waste, frames = Left(sizes), 0, []

    def open_container() -> None:
        first = left.sizes[-1]
        left.take(first)
        frames.append([first, left.fillings(capacity - first, tries)[:BRANCHES][::-1], None])

    open_container()
    nodes += len(best)
    while frames and nodes > 0:
        frame = frames[-1]
        if frame[2]:
            waste -= frame[2][0]
            for s in frame[2][1]:
                left.give(s)
            frame[2] = None
        if not frame[1]:
            left.give(frame[0])
            frames.pop()
            continue
        option = frame[1].pop()
        # A packing with one container less than the incumbent has no more waste than this.
        if waste + option[0] > (len(best) - 1) * capacity - total:
            continue
        waste += option[0]
        for s in option[1]:
            left.take(s)
        frame[2], nodes = option, nodes - 1
        if left.sizes:
            open_container()
        else:
            best = [[f[0], *f[2][1]] for f in frames]
            if len(best) <= bound:
                break
    ended.append("bound" if len(best) <= bound else "nodes" if frames else "searched")
    return best


def pack_shard(docs: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """(doc_id, piece, tokens, container) of one shard. Texts without tokens go into its first container."""
    docs = docs.sort_values(["tokens", "doc_id"], ascending=[False, True])
    out, open_ones, used = [], {}, 0
    for d, n in zip(docs["doc_id"].tolist(), docs["tokens"].tolist()):
        for piece in range(n // capacity if n > capacity else 0):
            out.append((d, piece, capacity, used))
            used += 1
        rest = n % capacity if n > capacity else n
        if rest:
            open_ones.setdefault(rest, []).append((d, n // capacity if n > capacity else 0))
        elif not n:
            out.append((d, 0, 0, 0))
    for sizes in bin_completion([s for s, ds in open_ones.items() for _ in ds], capacity):
        for s in sizes:
            d, piece = open_ones[s].pop()
            out.append((d, piece, s, used))
        used += 1
    return pd.DataFrame(out, columns=["doc_id", "piece", "tokens", "container"])


def packed(documents: DataFrame, sizes: DataFrame, tokenizer: str = TOKENIZER, per_shard: int = PER_SHARD) -> DataFrame:
    """(container, doc_id, piece, tokens, container_no): where each document, or piece of one, goes for each size.

    documents: doc_id, text, a row per document; null ids are left out, null and empty texts have no tokens and go
    into the first container of their shard. sizes: container, capacity_tokens; rows with a null or a capacity
    below one are ignored. No documents or sizes give no rows. Container numbers are unique per size.
    """
    spark = ship(documents.sparkSession)
    counted = Scratch(spark).keep(token_counts(documents, tokenizer))
    shards = max(1, round(counted.count() / per_shard))
    wanted = sorted({(r.container, r.capacity_tokens) for r in sizes.select("container", "capacity_tokens").collect() if r.container is not None and (r.capacity_tokens or 0) > 0})

    def run(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        container, capacity, shard = key
        made = pack_shard(docs, int(capacity))
        made["container_no"] = made["container"].astype("int64") * shards + int(shard)
        return made.assign(container=container)[["container", "doc_id", "piece", "tokens", "container_no"]]

    each = F.explode(F.array(*(F.struct(F.lit(c).alias("container"), F.lit(int(n)).cast("long").alias("capacity")) for c, n in wanted))) if wanted else None
    schema = "container string, doc_id long, piece int, tokens long, container_no long"
    if each is None:
        return spark.createDataFrame([], schema)
    dealt = counted.select("doc_id", "tokens", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"), each.alias("size"))
    return dealt.select("doc_id", "tokens", "shard", "size.container", "size.capacity").groupBy("container", "capacity", "shard").applyInPandas(run, schema)


def fill_report(packing: DataFrame, sizes: DataFrame) -> DataFrame:
    """(container, n_containers, tokens, unused_share) per size."""
    used = packing.groupBy("container", "container_no").agg(F.sum("tokens").alias("t"))
    per = used.groupBy("container").agg(F.count("*").alias("n_containers"), F.sum("t").alias("tokens"))
    once = sizes.groupBy("container").agg(F.max("capacity_tokens").alias("capacity"))
    room = F.col("n_containers") * F.col("capacity")
    return per.join(once, "container").select("container", "n_containers", "tokens", F.round(1 - F.col("tokens") / room, 4).alias("unused_share"))
