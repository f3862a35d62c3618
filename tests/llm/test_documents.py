"""Leaks, packing and subjects."""

import random

import numpy as np
import pandas as pd
import pytest

from rowloom.llm import leaks as lk
from rowloom.llm import packing as pk
from rowloom.llm import subjects as sj

from .conftest import pairs

VOCABULARY = [f"w{i}" for i in range(500)]


def passage(seed, n):
    rng = random.Random(seed)
    return [rng.choice(VOCABULARY) for _ in range(n)]


def prints(*texts):
    """The fingerprints of each text."""
    known = lk._Hashes()
    flat = np.array([known[w] for ws in texts for w in ws], np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(ws) for ws in texts])
    digest, of = lk.winnow(*lk.grams(flat, owner, lk.K), lk.WINDOW)
    return [set(digest[of == i].tolist()) for i in range(len(texts))]


def test_winnowing_keeps_every_long_shared_span():
    a, b = passage(1, 200), passage(2, 200)
    for at in range(0, 150, 10):
        shared = passage(3, lk.K + lk.WINDOW - 1)
        x, _, y = prints(a[:at] + shared + a[at:], shared[:3], b[:50] + shared + b[50:])
        assert x & y


def test_winnowing_keeps_the_smallest_gram_of_every_window():
    texts = [passage(k, n) for k, n in enumerate((0, 3, 4, 5, 6, 40, 7))]
    known = lk._Hashes()
    for ws, got in zip(texts, prints(*texts)):
        hashes = np.array([known[w] for w in ws], np.uint64)
        g = lk.grams(hashes, np.zeros(len(ws), int), lk.K)[0].tolist()
        want = {min(g[i : i + lk.WINDOW]) for i in range(len(g) - lk.WINDOW + 1)} if len(g) >= lk.WINDOW else {min(g)} if g else set()
        assert got == want


def test_no_passage_covers_more_than_the_bound():
    rng = random.Random(5)
    for _ in range(400):
        item = [f"w{rng.randrange(12)}" for _ in range(rng.randrange(6, 30))]
        doc = [f"w{rng.randrange(14)}" for _ in range(rng.randrange(3, 60))]
        at = rng.randrange(len(doc))
        doc[at:at] = item[rng.randrange(3) : rng.randrange(3, 30)]
        own = list(zip(item, item[1:], item[2:]))
        seeds = {}
        for i, g in enumerate(own):
            seeds.setdefault(g, []).append(i)
        n = lk.covered(doc, item, seeds, lk.GAP)[0]
        assert n <= lk.at_most(item, own, set(zip(doc, doc[1:], doc[2:])), set(doc)) <= len(item)


def test_leaked_items(spark):
    item, around = passage(10, 60), [passage(k, 80) for k in range(20, 26)]
    changed = [w if i % 9 else "other" for i, w in enumerate(item)]
    docs = {
        1: around[0] + item + around[1],
        2: around[2] + changed,
        3: item[:18] + around[3][:15] + item[18:40],
        4: around[4] + item[:20],  # a third
        5: around[5],
        6: "a b".split(),
    }
    rows = [(d, " ".join(ws)) for d, ws in docs.items()] + [(7, " ".join(item).upper().replace(" ", " ")), (8, None), (9, ""), (None, " ".join(item)), (1, " ".join(docs[1]))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "a b"), (None, "a b"), (5, " ".join(item))], "item_id long, text string")
    found = pairs(lk.leaked_items(documents, items), "doc_id", "item_id")
    assert found == {(d, i) for d in (1, 2, 3, 7) for i in (1, 5)} | {(6, 4)}
    held = {(r.doc_id, r.item_id): (round(r.share, 2), r.begin_word, r.end_word) for r in lk.passages(documents, items).collect()}
    assert set(held) == found and held[1, 1] == (1.0, 80, 140) and held[6, 4] == (1.0, 0, 2)
    few = {(r.doc_id, r.item_id): r.share for r in lk.passages(documents, items, share=0.3).collect()}
    assert set(few) == found | {(4, 1), (4, 5)} and abs(few[4, 1] - 1 / 3) < 0.01
    assert lk.leaked_items(documents, items.limit(0)).count() == 0
    assert lk.leaked_items(documents.limit(0), items).count() == 0
    sourced = items.selectExpr("item_id", "text", "'test' AS split", "'s' AS source")
    assert {(r.item_id, r.n_documents) for r in lk.leak_report(sourced, lk.leaked_items(documents, items)).collect()} == {(1, 4), (2, 0), (3, 0), (4, 1), (5, 4)}


def test_reworded_halves_of_items(spark):
    """Three fifths of an item with one word in twelve exchanged; a third of an item never."""
    rng = random.Random(4)
    items = {k: passage(1000 + k, rng.randrange(40, 90)) for k in range(60)}
    docs = []
    for k, ws in items.items():
        n = len(ws) * 3 // 5
        at = rng.randrange(len(ws) - n + 1)
        part = [w if rng.random() > 1 / 12 else "exchanged" for w in ws[at : at + n]]
        docs.append((k, " ".join(passage(2000 + k, 60) + part + passage(3000 + k, 60))))
        docs.append((100 + k, " ".join(passage(4000 + k, 60) + ws[: len(ws) // 3] + passage(5000 + k, 60))))
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    listed = spark.createDataFrame([(k, " ".join(ws)) for k, ws in items.items()], "item_id long, text string")
    found = pairs(lk.leaked_items(documents, listed), "doc_id", "item_id")
    assert found <= {(k, k) for k in items} and len(found) >= 0.9 * len(items)


@pytest.mark.parametrize("seed", range(25))
def test_bin_completion_is_a_packing_and_no_worse_than_best_fit(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 100, 256])
    sizes = [rng.randint(1, capacity) for _ in range(rng.randrange(0, 120))]
    made = pk.bin_completion(sizes, capacity)
    assert sorted(s for c in made for s in c) == sorted(sizes)
    assert all(0 < sum(c) <= capacity for c in made)
    assert len(made) <= len(pk.best_fit(sizes, capacity))


def least_containers(sizes, capacity):
    best = [len(sizes)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for r in {r for r in rooms if r >= sizes[i]}:
            k = rooms.index(r)
            place(i + 1, [*rooms[:k], r - sizes[i], *rooms[k + 1 :]])
        place(i + 1, [*rooms, capacity - sizes[i]])

    place(0, [])
    return best[0]


def test_bin_completion_finds_the_least_number_on_small_cases():
    for seed in range(60):
        rng = random.Random(seed)
        sizes = sorted((rng.randint(3, 20) for _ in range(9)), reverse=True)
        assert len(pk.bin_completion(sizes, 30)) == least_containers(sizes, 30)


def test_many_small_items_do_not_recurse_deeply():
    made = pk.bin_completion([1] * 9000 + [4096], 4096)
    assert len(made) == 4


def test_pack_shard():
    docs = pd.DataFrame({"doc_id": [1, 2, 3, 4, 5], "tokens": [25, 10, 0, 4, 6]})
    out = pk.pack_shard(docs, 10)
    assert out.groupby("doc_id")["tokens"].sum().to_dict() == {1: 25, 2: 10, 3: 0, 4: 4, 5: 6}
    assert out.groupby("container")["tokens"].sum().max() == 10 and out["container"].nunique() == 5
    assert sorted(out[out.doc_id == 1].piece) == [0, 1, 2]


def test_packed(spark):
    rows = [(k, "some words here " * (k % 40)) for k in range(200)] + [(900, None), (901, "<|endoftext|>"), (None, "x"), (902, "\ud800".encode("utf-16", "surrogatepass").decode("utf-16", "replace"))]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = spark.createDataFrame([("small", 16), ("large", 64), ("large", 64), ("none", 0), (None, 5)], "container string, capacity_tokens long")
    out = pk.packed(documents, sizes, per_shard=60).toPandas()
    assert set(out["container"]) == {"small", "large"} and not out.duplicated(["container", "doc_id", "piece"]).any()
    tokens = out.groupby(["container", "doc_id"])["tokens"].sum().unstack(0)
    assert (tokens["small"] == tokens["large"]).all() and len(tokens) == 203 and tokens["small"][900] == 0
    full = out.groupby(["container", "container_no"])["tokens"].sum()
    assert full["small"].max() <= 16 and full["large"].max() <= 64
    assert out[(out["container"] == "large") & (out["piece"] > 0)].doc_id.map(lambda d: tokens["large"][d] > 64).all()
    report = {r.container: r for r in pk.fill_report(pk.packed(documents, sizes, per_shard=60), sizes).collect()}
    assert report["small"].unused_share < 0.12
    assert pk.packed(documents.limit(0), sizes).count() == 0
    assert pk.packed(documents, sizes.limit(0)).count() == 0


SUBJECTS = {
    "sea": "ship mast keel anchor harbour".split(),
    "law": "court judge verdict appeal clause".split(),
    "farm": "barley plough cattle harvest orchard".split(),
    "song": "lute choir melody chorus tempo".split(),
    "war": "trench siege cavalry garrison volley".split(),
    "food": "oven dough broth garlic recipe".split(),
    "code": "compiler database server loop patch".split(),
}


def sentence(rng, subject):
    filler = "people often talk about many things when they meet at noon somewhere".split()
    ws = rng.sample(filler, 4) + (rng.sample(SUBJECTS[subject], 3) if subject else rng.sample(filler, 3))
    rng.shuffle(ws)
    return " ".join(ws).capitalize() + "."


def test_document_subjects(spark):
    rng = random.Random(8)
    names, docs, truth = sorted(SUBJECTS), [], {}
    for d in range(400):
        chosen = rng.sample(names, rng.choice([1, 1, 1, 2]))
        truth[d] = set(chosen)
        sents = [sentence(rng, rng.choice(chosen)) for _ in range(8)] + [sentence(rng, s) for s in chosen] + [sentence(rng, None) for _ in range(3)]
        rng.shuffle(sents)
        docs.append((d, " ".join(sents)))
    docs += [(900, None), (901, ""), (902, "..."), (None, "Court judge.")]
    documents = spark.createDataFrame(docs, "doc_id long, text string")
    subjects = spark.createDataFrame([(s, f"about {s}") for s in names] + [(None, "x")], "subject string, description string")
    said = [(d, s) for d in range(0, 400, 6) for s in sorted(truth[d])] + [(1, None), (None, "sea"), (2, "unknown"), (6, sorted(truth[6])[0])]
    labels = spark.createDataFrame(said, "doc_id long, subject string")
    found = pairs(sj.document_subjects(documents, subjects, labels), "doc_id", "subject")
    want = {(d, s) for d, ss in truth.items() for s in ss}
    assert len(found & want) >= 0.97 * len(want) and len(found - want) <= 0.03 * len(want)
    assert sj.document_subjects(documents.limit(0), subjects, labels).count() == 0
    assert sj.document_subjects(documents, subjects.limit(0), labels).count() == 0
    assert sj.document_subjects(documents, subjects, labels.limit(0)).count() >= 0
