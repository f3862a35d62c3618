"""Recall of problems 2 and 5 on texts that were edited at random to just a given similarity.

`python -m tests.llm.test_recall FOLDER` measures it on the rows of a scale directory.
"""

import random
import sys

import pytest

from rowloom.llm import near_duplicates as nd
from rowloom.llm import split_overlap as so

ROW = "id string, split string, similarity_text string, input_json string"


def edited(words, similarity, rng):
    """Some of the words and as few new ones as keep the similarity; shuffled."""
    n = len(set(words))
    kept = rng.randrange(-(-round(n * similarity * 1000) // 1000), n + 1)
    fresh = int(kept / similarity - n)
    while fresh > 0 and kept / (n + fresh) < similarity:
        fresh -= 1
    out = rng.sample(sorted(set(words)), kept) + [f"new{rng.randrange(10**9)}" for _ in range(max(fresh, 0))]
    rng.shuffle(out)
    return out


def recalled(spark, texts, similarity, seed=0):
    """(share found by p2, share found by p5) of the pairs of every text and its edited copy."""
    rng = random.Random(seed)
    rows = [(f"a{k}", "train", " ".join(ws), None) for k, ws in enumerate(texts)]
    copies = {k: edited(ws, similarity, rng) for k, ws in enumerate(texts)}
    alike = {k for k, ws in enumerate(texts) if len(set(ws) & set(copies[k])) / len(set(ws) | set(copies[k])) >= 0.7}
    rows += [(f"b{k}", "val", " ".join(ws), None) for k, ws in copies.items()]
    df = spark.createDataFrame(rows, ROW)
    out = []
    for found in (nd.near_duplicates(df)[0], so.split_overlaps(df)):
        pairs = {(r.id_a, r.id_b) for r in found.collect()}
        out.append(sum((f"a{k}", f"b{k}") in pairs for k in alike) / max(1, len(alike)))
    return (*out, len(alike))


@pytest.mark.parametrize("similarity", [0.71, 0.8])
def test_recall(spark, similarity):
    rng = random.Random(6)
    texts = [[f"w{min(int(rng.paretovariate(0.6)), 4000)}" for _ in range(rng.randrange(8, 120))] for _ in range(500)]
    two, five, n = recalled(spark, texts, similarity)
    assert n > 450 and two >= 0.985 and five >= 0.985


def test_long_and_short_texts(spark):
    rng = random.Random(7)
    texts = [[f"v{rng.randrange(10**6)}" for _ in range(n)] for n in (1, 2, 3, 5, 8, 12, 20, 33, 34, 60, 300, 2000) for _ in range(4)]
    two, five, n = recalled(spark, texts, 0.9)
    assert (two, five, n) == (1.0, 1.0, len(texts))


if __name__ == "__main__":
    from pyspark.sql import functions as F

    from rowloom.llm.plainform import words
    from rowloom.session import local_session

    session = local_session(8, 8)
    table = session.read.parquet(f"{sys.argv[1]}/prepared_rows.parquet").where("length(similarity_text) > 20")
    given = [words(r[0]) for r in table.select("similarity_text").distinct().orderBy(F.xxhash64("similarity_text")).limit(1500).collect()]
    for bar in (0.7, 0.71, 0.74, 0.77, 0.8):
        print(bar, recalled(session, given, bar), flush=True)
