"""Groups from pairs, related sets and their splits."""

import random
from collections import defaultdict

from rowloom.llm import groups as gr
from rowloom.llm import related_splits as rs
from rowloom.session import Scratch

from .conftest import pairs


def components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    out = defaultdict(set)
    for x in list(up):
        out[find(x)].add(x)
    return list(out.values())


def some_edges(seed):
    rng = random.Random(seed)
    chain = [(f"c{k:02}", f"c{k + 1:02}") for k in range(40)]
    star = [("hub", f"s{k}") for k in range(50)]
    rest = [(f"r{rng.randrange(80)}", f"r{rng.randrange(80)}") for _ in range(60)]
    out = [e[:: rng.choice((1, -1))] for e in chain + star + rest]
    rng.shuffle(out)
    return out + out[:9]


def test_connected_sets_against_union_find(spark):
    for seed in range(3):
        edges = some_edges(seed)
        df = spark.createDataFrame([*edges, ("c00", None), (None, None), ("solo", "solo")], "a string, b string")
        want = {(x, min(g)) for g in components(edges) for x in g if len(g) > 1}
        assert pairs(gr.connected_sets(df), "id", "group_id") == want


def test_no_edges(spark, rows):
    assert gr.connected_sets(spark.createDataFrame([], "a string, b string")).count() == 0
    matches = spark.createDataFrame([], "id_a string, id_b string, similarity double")
    assert gr.row_groups(rows(), matches).count() == 0
    assert rs.related_sets(rows()).count() == 0


def test_row_groups(spark, rows):
    given = rows({"id": "b", "links": ["a", "zz", None, "b", "a"]}, {"id": "a"}, {"id": "c", "links": None}, {"id": "d", "links": ["zz"]}, {"id": "e"}, {"id": None, "links": ["e"]}, {"id": "b", "links": ["a"]})
    matches = spark.createDataFrame([("c", "b", None), ("b", "c", 0.1), ("e", None, 1.0), ("d", "zz", 1.0), ("e", "e", 1.0)], "id_a string, id_b string, similarity double")
    assert pairs(gr.row_groups(given, matches), "id", "group_id") == {("a", "a"), ("b", "a"), ("c", "a")}


def related_rows(seed):
    rng = random.Random(seed)
    out = []
    for k in range(90):
        key = rng.choice([None, " ", f"k{rng.randrange(12)}", f"{rng.randrange(90):02}"])
        members = rng.choice([None, [], [f"{rng.randrange(120):02}", None], ["xx"]])
        out.append({"id": f"{k:02}", "group_key": key, "group_members": members, "split": rng.choice(["train", "val", None]), "scope": rng.choice(["general", "general", "game_specific"])})
    return out + out[:6]


def want_sets(given):
    ids = {r["id"] for r in given}
    edges = [(r["id"], r["group_key"]) for r in given if (r["group_key"] or "").strip()]
    edges += [(r["id"], m) for r in given for m in r["group_members"] or [] if m in ids]
    edges += [(i, i) for i in ids]
    return [g & ids for g in components(edges)]


def test_related_sets_against_union_find(rows):
    for seed, limit in ((0, 10**6), (1, 10**6), (2, 20)):
        given = related_rows(seed)
        want = {(x, min(g)) for g in want_sets(given) for x in g}
        assert pairs(rs.related_sets(rows(*given).repartition(5), task_edges=limit), "id", "set_id") == want


def test_a_last_task_that_writes_out_its_forest_is_not_whole(spark):
    """Chains of 90 edges over 120 vertices: a limit of 100 is met by the vertices and not by the edges."""
    edges = [(f"{k:02}{i + 1}", f"{k:02}{i}") for k in range(30) for i in range(3)]
    random.Random(0).shuffle(edges)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    kept = spark.conf.get(batch)
    spark.conf.set(batch, "10")
    try:
        for limit, one in ((100, False), (120, True)):
            df = spark.createDataFrame(edges, "a string, b string").coalesce(1)
            forest, whole = rs.merged_forests(df, Scratch(spark), task_edges=limit)
            found = {(r.a, r.b) for r in forest.collect()}
            assert whole == one and sorted(map(sorted, components(found))) == [[f"{k:02}{i}" for i in range(4)] for k in range(30)]
            assert not whole or found == {(a, a[:2] + "0") for a, _ in edges}
    finally:
        spark.conf.set(batch, kept)


def test_related_sets_at_every_limit(spark, rows):
    """Limits on both sides of the numbers of edges and of vertices, batches far below them, one task and many."""
    given = related_rows(5)
    want = {(x, min(g)) for g in want_sets(given) for x in g}
    batch, kept = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(batch, "10")
    try:
        for limit, parts in ((2, 8), (30, 8), (70, 1), (95, 8), (110, 1), (130, 8), (1000, 8)):
            assert pairs(rs.related_sets(rows(*given).repartition(parts), task_edges=limit), "id", "set_id") == want
    finally:
        spark.conf.set(batch, kept)


def test_lists_of_members_are_told_apart_by_their_content(rows):
    given = [{"id": i, "group_members": m} for i, m in (("a", ["b", "c"]), ("d", ["b", "c"]), ("e", ["b,c"]), ("b", None), ("c", ["c", "c"]), ("f", ["f"]))]
    assert pairs(rs.related_sets(rows(*given)), "id", "set_id") == {("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("e", "e"), ("f", "f")}


def test_torn_sets(rows):
    given = related_rows(3)
    split = {r["id"]: r["split"] for r in given}
    want = {(min(g), x) for g in want_sets(given) if len({split[x] for x in g} - {None}) > 1 for x in g}
    df = rows(*given)
    assert want and pairs(rs.torn_sets(df, rs.related_sets(df)), "set_id", "id") == want


def test_assigned_splits(spark, rows):
    given = related_rows(4)
    plan = spark.createDataFrame([("train", 0.8), ("val", 0.1), ("test", 0.1), (None, 0.5)], "split string, proportion double")
    out = rs.assigned_splits(rows(*given), plan).collect()
    assert len(out) == 90 and {r.id for r in out} == {r["id"] for r in given}
    by_set = defaultdict(set)
    for r in out:
        by_set[r.set_id].add(r.split)
    assert all(len(s) == 1 for s in by_set.values())
    special = {r["id"] for r in given if r["scope"] == "game_specific"}
    assert all(r.split == "test" for r in out if r.id in special)


def test_deal_is_near_the_plan():
    sizes = [(1, False, 100_000), (7, False, 30), (60, False, 4), (3, True, 50)]
    dealt = rs.deal(sizes, {"train": 0.8, "val": 0.1, "test": 0.1}, sum(s * n for s, _, n in sizes))
    total = defaultdict(int)
    for (size, fixed), runs in dealt.items():
        assert sum(n for _, n in runs) == next(n for s, f, n in sizes if (s, f) == (size, fixed))
        for split, n in runs:
            total[split] += size * n
    rows = sum(total.values())
    assert all(abs(total[s] - p * rows) <= 1 for s, p in (("train", 0.8), ("val", 0.1), ("test", 0.1)))
