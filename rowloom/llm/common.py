"""What several operators of the subpackage share: row texts, word hashes and expansion of classes into pairs."""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .plainform import words

#: A visible character: neither white space nor invisible.
VISIBLE = r"[^\s\p{Z}\p{C}]"
TRAIN, EVAL = "train", ("val", "test")


def visible(col: Column) -> Column:
    """True where a text holds a visible character; false for null and blank texts."""
    return F.coalesce(col.rlike(VISIBLE), F.lit(False))


def row_texts(rows: DataFrame, *more: str) -> DataFrame:
    """(id, text, spare, *more): the text of a row, or where it is null or blank the JSON that replaces it, as `spare`.

    Rows without an id are left out, as no result could name them.
    """
    has = visible(F.col("similarity_text"))
    return rows.where(F.col("id").isNotNull()).select(
        "id", F.when(has, F.col("similarity_text")).alias("text"), F.when(~has, F.col("input_json")).alias("spare"), *more
    )


def load_object(text: str | None) -> dict:
    """A JSON object, or an empty one for null, broken or other JSON."""
    try:
        out = json.loads(text) if text else {}
    except (ValueError, RecursionError):
        return {}
    return out if isinstance(out, dict) else {}


def spare_text(text: str | None) -> str:
    """The top-level strings of an input, joined by a space."""
    return " ".join(v for v in load_object(text).values() if isinstance(v, str))


def word_sets(batch: pd.DataFrame) -> list[list[str]]:
    """The distinct words of each row of `row_texts`, in code-point order."""
    return [sorted(set(words(t if t is not None else spare_text(s)))) for t, s in zip(batch["text"], batch["spare"])]


def hash_word(word: str) -> int:
    """A signed 64-bit hash."""
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) - (1 << 63)


def class_of(sorted_words: list[str]) -> int:
    """The class id of a set of words: rows of one class have the same words."""
    return hash_word("\x00".join(sorted_words))


def side_of(split: Column) -> Column:
    """`t` for train, `h` for val and test, an empty string for others."""
    return F.when(split == TRAIN, "t").when(split.isin(*EVAL), "h").otherwise("")


def word_table(texts: DataFrame, scratch: Scratch, apart: bool = False) -> DataFrame:
    """(id, side, cid, tid, words, h, n), from one pass over `row_texts` with side.

    Rows of texts have id, side, class, a hash of the text as it is and, for the first row of its class (`apart`: and
    side) in a task, the words parted by blanks; texts without a word have no row. Rows of counts have a word's hash and its number
    of texts in some task, or no hash and the number of texts; the counter of a task is written out as it grows.
    """

    def run(batches):
        from collections import Counter

        def table(rows: list[tuple]) -> pd.DataFrame:
            made = pd.DataFrame(rows, columns=columns, dtype="object")
            return made.astype({"cid": "Int64", "tid": "Int64", "h": "Int64", "n": "Int64"})

        def counts() -> pd.DataFrame:
            none = (None,) * (len(columns) - 2)
            return table([(*none, hash_word(w), n) for w, n in total.items()] + [(*none, None, texts_read)])

        columns, seen, total, texts_read = ["id", "side", "cid", "tid", "words", "h", "n"], set(), Counter(), 0
        for b in batches:
            sets = word_sets(b)
            texts_read += len(sets)
            out = []
            for ws, i, side, t, s in zip(sets, b["id"], b["side"], b["text"], b["spare"]):
                if ws:
                    total.update(ws)
                    c = class_of(ws)
                    key = (c, side) if apart else c
                    fresh = key not in seen
                    seen.add(key)
                    out.append((i, side, c, hash_word(t if t is not None else spare_text(s)), " ".join(ws) if fresh else None, None, None))
            yield table(out)
            if len(total) > 300_000:
                yield counts()
                total.clear()
                texts_read = 0
        yield counts()

    return scratch.keep(texts.mapInPandas(run, "id string, side string, cid long, tid long, words string, h long, n long"))


def frequent_words(table: DataFrame, share: float) -> np.ndarray:
    """Hashes of the words that more than `share` of the texts of a word table hold, counted over all of them.

    A text with w words can make at most w / share words frequent on average, so the result stays at the mean
    number of words over `share`, whatever the number of texts.
    """
    counts = table.where("n IS NOT NULL").select("h", "n")
    total = counts.where("h IS NULL").agg(F.sum("n")).first()[0] or 0
    sums = counts.where("h IS NOT NULL").groupBy("h").agg(F.sum("n").alias("n"))
    rows = sums.where(F.col("n") > share * total).select("h").collect()
    return np.array(sorted(r.h for r in rows), dtype="int64")


def variants(items: list, hashes: list[int], ignored: set[int]) -> list[tuple[int, list]]:
    """(variant, items): the items without ignored words, variant 0, where these are half of all or more; all items,
    variant 1, where they are under three quarters.

    Of two sets with a Jaccard similarity of 0.7 or more, the shares of words that are not ignored differ by less
    than a quarter, so the two always have a variant in common, even if one text and its near copies fill a
    third of all rows and thereby make each of its words frequent.
    """
    rest = [x for x, h in zip(items, hashes) if h not in ignored]
    out = [(0, rest)] if rest and 2 * len(rest) >= len(items) else []
    return out + ([(1, items)] if 4 * len(rest) < 3 * len(items) else [])


def _met(pairs: DataFrame, xs: DataFrame, ys: DataFrame, within: str) -> DataFrame:
    """(x, y, twice): a row of xs and one of ys, in one class and meeting `within`, or in ca and cb of paired classes; whether
    one of them is `twice`."""
    a = xs.select(F.col("cid").alias("ca"), F.col("id").alias("x"), F.col("twice").alias("xt"))
    b = ys.select(F.col("cid").alias("cb"), F.col("id").alias("y"), F.col("twice").alias("yt"))
    out = "x", "y", (F.col("xt") | F.col("yt")).alias("twice")
    same = a.join(b.withColumnRenamed("cb", "ca"), "ca").where(within).select(*out)
    return same.unionByName(pairs.select("ca", "cb").join(a, "ca").join(b, "cb").select(*out))


def expand_pairs(pairs: DataFrame, members: DataFrame, limit: int, scratch: Scratch, across: bool = False) -> DataFrame:
    """(id_a, id_b) of every two rows in one class or in two paired classes; `across`: of a train and a held-out row.

    pairs(ca, cb): paired classes, each once, or `across` the class of the train row first; members(cid, tid, side, id):
    distinct, `tid` the row's text, side `t` for train, `h` for held out or another. Only identical texts are not
    expanded into all their pairs: where more than `limit` rows of one side have the same text, each is paired with
    their smallest id, which stands for them in pairs with other rows. Towards the other of train and held out each of
    them is also paired with the smallest id of every text that meets theirs, so the pairs across the two name every row
    and are the same whether `across` or taken from all pairs.
    """
    key = ["cid", "tid", "side"]
    # Two rows that each have one place among the members meet once: their pairs are distinct without being shuffled.
    places = members.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id", F.lit(True).alias("twice"))
    places = scratch.keep(places, free=True)
    repeated = not places.isEmpty()
    members = members.join(places, "id", "left").withColumn("twice", F.coalesce("twice", F.lit(False))) if repeated else members.withColumn("twice", F.lit(False))
    groups = members.groupBy(*key).agg(F.count("*").alias("n"), F.min("id").alias("rep"), F.min_by("twice", "id").alias("twice"))
    large = scratch.keep(groups.where(F.col("n") > limit).select(*key, "rep", F.col("twice").alias("rep_twice")), free=True)
    some = not large.isEmpty()
    standing = members.join(large, key, "left").where("rep IS NULL OR rep = id").drop("rep", "rep_twice") if some else members
    train, held = F.col("side") == "t", F.col("side") == "h"
    found = _met(pairs, standing.where(train), standing.where(held), "true") if across else _met(pairs, standing, standing, "x < y")
    if some:
        rest = members.join(large, key).where("id <> rep")
        first = groups.select("cid", "side", F.col("rep").alias("id"), "twice")
        both = pairs if across else pairs.select("ca", "cb").union(pairs.select("cb", "ca"))
        found = found.unionByName(_met(both, rest.where(train), first.where(held), "true")).unionByName(_met(both, first.where(train), rest.where(held), "true"))
        if not across:
            found = found.unionByName(rest.select(F.col("rep").alias("x"), F.col("id").alias("y"), (F.col("twice") | F.col("rep_twice")).alias("twice")))
    ends = F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")
    found = found.where("x <> y")
    return found.where("NOT twice").select(*ends).unionByName(found.where("twice").select(*ends).distinct()) if repeated else found.select(*ends)


def jaccard(a: Column, b: Column) -> Column:
    """Words in both over words in either, of two strings of distinct words parted by spaces."""
    x, y = F.split(a, " "), F.split(b, " ")
    both = F.size(F.array_intersect(x, y))
    return both / (F.size(x) + F.size(y) - both)
