"""Near duplicates, overlaps of splits, same-looking texts and duplicates hidden by formatting."""

import random

import pytest

from rowloom.llm import format_duplicates as fd
from rowloom.llm import near_duplicates as nd
from rowloom.llm import same_looking as sl
from rowloom.llm import split_overlap as so
from rowloom.llm.plainform import words
from rowloom.session import Scratch

from .conftest import as_input, pairs

VOCABULARY = [f"w{i}" for i in range(3000)]


def text(seed, n=50):
    return " ".join(random.Random(seed).sample(VOCABULARY, n))


def edited(base, changes, seed):
    rng = random.Random(seed)
    ws = base.split()
    for i in rng.sample(range(len(ws)), changes):
        ws[i] = f"new{rng.randrange(10**6)}"
    rng.shuffle(ws)
    return " ".join(ws)


def brute(texts, similarity=0.7):
    sets = {i: set(words(t)) for i, t in texts.items() if t}
    out = set()
    for a in sets:
        for b in sets:
            if a < b and (sets[a] | sets[b]) and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= similarity:
                out.add((a, b))
    return out


def corpus():
    texts = {}
    for k in range(60):
        base = text(k)
        texts[f"a{k:03}"] = base
        texts[f"b{k:03}"] = edited(base, k % 10, k)
        texts[f"c{k:03}"] = edited(base, 12 + k % 9, -k)
    for k in range(8):
        texts[f"z{k}"] = "a copy of one text that many rows share, word by word"
    texts["y0"], texts["y1"] = "short", "Short!"
    return texts


def test_near_duplicates_against_brute_force(rows):
    texts = corpus()
    given = [{"id": i, "similarity_text": t} for i, t in texts.items()]
    given += given[:5]
    given += [{"id": None, "similarity_text": texts["a000"]}, {"id": "n0"}, {"id": "n1", "similarity_text": "  "}, {"id": "n2", "similarity_text": "?!"}]
    given += [{"id": "f0", "similarity_text": " ​", "input_json": as_input("short", "")}]
    found = pairs(nd.near_duplicates(rows(*given))[0], "id_a", "id_b")
    want = brute(texts | {"f0": "short"})
    assert found <= want and len(found) >= 0.99 * len(want)


def test_large_classes_are_stars(rows):
    same = [{"id": f"r{k}", "similarity_text": "one two three four five six seven eight nine ten"} for k in range(6)]
    other = {"id": "x", "similarity_text": "one two three four five six seven eight nine eleven ten"}
    found, members, linked = nd.near_duplicates(rows(*same, other), expand_limit=3)
    assert pairs(found, "id_a", "id_b") == {("r0", f"r{k}") for k in range(1, 6)} | {("r0", "x")}
    assert members.count() == 7 and linked.count() == 1


def test_large_classes_of_different_texts_are_expanded(rows):
    ws = "one two three four five six seven eight nine ten".split()
    texts = {f"r{k}": " ".join(ws[k:] + ws[:k]) for k in range(5)} | {f"s{k}": " ".join(ws) for k in range(4)}
    texts |= {"x0": " ".join([*ws, "more"]), "x1": " ".join(["more", *ws])}
    given = [{"id": i, "similarity_text": t, "split": ("train", "val", None)[k % 3]} for k, (i, t) in enumerate(texts.items())]
    split = {r["id"]: r["split"] for r in given}
    across = lambda found: {p for p in found if {split[i] for i in p} == {"train", "val"}}
    want = brute(texts)
    for limit in (4, 3, 1):
        found = pairs(nd.near_duplicates(rows(*given), expand_limit=limit)[0], "id_a", "id_b")
        one = {i for i in texts if texts[i] == " ".join(ws)}
        assert found <= want and all(p in found or one & set(p) for p in want)
        assert limit == 1 or found == want
        assert pairs(so.split_overlaps(rows(*given), expand_limit=limit), "id_a", "id_b") == across(found)


def test_near_copies_of_one_text_that_fill_the_table(rows):
    base = text(1)
    texts = {f"h{k:02}": edited(base, k % 6, k) for k in range(40)} | {f"o{k:02}": text(100 + k) for k in range(60)}
    given = [{"id": i, "similarity_text": t, "split": "train" if int(i[1:]) % 2 else "val"} for i, t in texts.items()]
    want = brute(texts)
    assert len(want) > 500
    found = pairs(nd.near_duplicates(rows(*given))[0], "id_a", "id_b")
    assert found <= want and len(found) >= 0.99 * len(want)
    across = {(a, b) for a, b in want if (int(a[1:]) + int(b[1:])) % 2}
    found = pairs(so.split_overlaps(rows(*given)), "id_a", "id_b")
    assert found <= across and len(found) >= 0.98 * len(across)


def test_hot_values_are_paired_in_blocks(rows):
    base = text(2)
    texts = {f"h{k:02}": edited(base, k % 5, k) for k in range(30)} | {f"o{k}": text(50 + k) for k in range(70)}
    given = [{"id": i, "similarity_text": t, "split": "train" if int(i[1:]) % 2 else "test"} for i, t in texts.items()]
    want = brute(texts)
    for hot in (1, 2, 7):
        found = pairs(nd.near_duplicates(rows(*given), hot=hot)[0], "id_a", "id_b")
        assert found == pairs(nd.near_duplicates(rows(*given))[0], "id_a", "id_b") and found <= want and len(found) >= 0.99 * len(want)
        across = pairs(so.split_overlaps(rows(*given), hot=hot), "id_a", "id_b")
        assert across == {(a, b) for a, b in want if (int(a[1:]) + int(b[1:])) % 2}


def test_more_coordinates_asked_for(rows):
    texts = corpus()
    given = [{"id": i, "similarity_text": t} for i, t in texts.items()]
    close = {p for p in brute(texts, 0.85)}
    for match in (1, 3, 5):
        found = pairs(nd.near_duplicates(rows(*given), match=match, width=3)[0], "id_a", "id_b")
        assert close <= found <= brute(texts)


def test_linked_members(rows):
    texts = corpus()
    given = [{"id": i, "similarity_text": t} for i, t in texts.items()]
    given += given[:3] + [{"id": "none", "similarity_text": "?"}]
    found, members, linked = nd.near_duplicates(rows(*given))
    links = {i: 0 for i in texts}
    for p in pairs(found, "id_a", "id_b"):
        for i in p:
            links[i] += 1
    small = nd.near_duplicates(rows(*given), expand_limit=2)
    for m in (nd.linked_members(members, linked), nd.linked_members(*small[1:])):
        out = {r.id: r for r in m.collect()}
        assert {i: r.n_links for i, r in out.items()} == links
        assert all(out[f"z{k}"].class_id == "z0" for k in range(8)) and out["y1"].class_id == "y0"


def test_record_overlaps(rows):
    base = text(3, 60)
    given = [
        {"id": "t0", "split": "train", "similarity_text": base},
        {"id": "t1", "split": "train", "similarity_text": "short words"},
        {"id": "v0", "split": "val", "similarity_text": base.upper()},
        {"id": "v1", "split": "test", "similarity_text": edited(base, 6, 1)},
        {"id": "v2", "split": "val", "similarity_text": text(9)},
        {"id": "n", "split": None, "similarity_text": base},
        {"id": "e", "split": "val", "similarity_text": " "},
    ]
    out = {r.id: (r.side, r.overlap) for r in so.record_overlaps(rows(*given, given[2])).collect()}
    assert set(out) == {"t0", "t1", "v0", "v1", "v2"}
    assert out["t0"] == ("t", 1.0) and out["v0"] == ("h", 1.0) and out["v2"][1] == out["t1"][1] == 0 and 0.1 < out["v1"][1] < 0.9


def meeting(n):
    """Unlike texts of few words, whose signatures and chunks meet by chance, and two that are alike."""
    few = [f"w{k}" for k in range(60)]
    texts = {f"m{k:03}": " ".join(random.Random(k).sample(few, 25)) for k in range(n)}
    return texts | {"z0": text(1), "z1": edited(text(1), 3, 1)}


@pytest.fixture
def kept(monkeypatch):
    """Rows of pairs of classes in each scratch table that is written."""
    out, keep = [], Scratch.keep

    def counted(self, df, **more):
        got = keep(self, df, **more)
        out.append(got.where("cb IS NOT NULL").count() if "cb" in got.columns else 0)
        return got

    monkeypatch.setattr(Scratch, "keep", counted)
    return out


def test_unlike_texts_that_meet_are_not_kept(rows, kept):
    texts = meeting(300)
    found = pairs(nd.near_duplicates(rows(*({"id": i, "similarity_text": t} for i, t in texts.items())))[0], "id_a", "id_b")
    assert found == brute(texts) and ("z0", "z1") in found
    assert 0 < max(kept) <= 50 * len(found)
    for hot in (1, 7):
        assert pairs(nd.near_duplicates(rows(*({"id": i, "similarity_text": t} for i, t in texts.items())), hot=hot)[0], "id_a", "id_b") == found


def test_unlike_texts_of_two_splits_that_share_chunks_are_not_kept(rows, kept):
    texts = meeting(300)
    given = [{"id": i, "similarity_text": t, "split": "train" if int(i[1:]) % 2 else "test"} for i, t in texts.items()]
    found = pairs(so.split_overlaps(rows(*given)), "id_a", "id_b")
    assert found == {(a, b) for a, b in brute(texts) if (int(a[1:]) + int(b[1:])) % 2} and ("z0", "z1") in found
    assert 0 < max(kept) <= 50 * len(found)


def test_pairs_are_not_shuffled_to_be_distinct(rows):
    """Neither with rows of one text each nor, with repeated ids, twice in the result."""
    texts = corpus()
    given = [{"id": i, "similarity_text": t, "split": "train" if k % 2 else "val"} for k, (i, t) in enumerate(texts.items())]
    last = lambda df: df._jdf.queryExecution().optimizedPlan().nodeName()
    assert last(nd.near_duplicates(rows(*given, *given))[0]) == last(so.split_overlaps(rows(*given, *given))) == "Union"
    again = [{"id": r["id"], "similarity_text": r["similarity_text"] + " more", "split": ("val", "train")[k % 2]} for k, r in enumerate(given[:90])]
    for limit in (1, 3, 1000):
        found = pairs(nd.near_duplicates(rows(*given, *again), expand_limit=limit)[0], "id_a", "id_b")
        across = pairs(so.split_overlaps(rows(*given, *again), expand_limit=limit), "id_a", "id_b")
        assert across <= found and ("y0", "y1") in found
        assert len(across) > 60


def test_empty(rows):
    assert nd.near_duplicates(rows())[0].count() == 0
    assert so.split_overlaps(rows()).count() == 0
    assert sl.same_looking_pairs(rows()).count() == 0
    assert fd.format_duplicates(rows()).count() == 0
    assert sl.plain_texts(rows()).count() == 0


def test_split_overlaps_against_brute_force(rows):
    texts = corpus()
    sides = ["train", "val", "test", None, "other"]
    split = {i: sides[random.Random(i).randrange(5)] for i in texts}
    given = [{"id": i, "similarity_text": t, "split": split[i]} for i, t in texts.items()]
    given += given[:7] + [{"id": None, "split": "train", "similarity_text": "short"}, {"id": "n", "split": "val"}]
    held = {"val", "test"}
    want = {(a, b) for a, b in brute(texts) if {"train"} == {split[a], split[b]} - held and {split[a], split[b]} & held}
    found = pairs(so.split_overlaps(rows(*given)), "id_a", "id_b")
    assert found <= want and len(found) >= 0.98 * len(want)
    report = so.overlap_report(rows(*given), so.split_overlaps(rows(*given))).collect()
    assert sum(r.n_overlapping for r in report) == len({i for p in found for i in p})


def test_overlaps_of_large_classes_keep_every_row(rows):
    one = "one two three four five six seven"
    given = [{"id": f"t{k}", "split": "train", "similarity_text": one} for k in range(5)] + [{"id": f"v{k}", "split": "val", "similarity_text": one} for k in range(3)]
    found = pairs(so.split_overlaps(rows(*given), expand_limit=2), "id_a", "id_b")
    assert {i for p in found for i in p} == {r["id"] for r in given} and len(found) == 7


def test_same_looking(rows):
    given = [
        {"id": "a", "similarity_text": "Cold  stone", "input_json": as_input("x y", "go", runtime_state={"a": 1, "b": 2})},
        {"id": "b", "similarity_text": "Ｃold stone", "input_json": as_input("x y", "go", runtime_state={"b": 2, "a": 1})},
        {"id": "c", "similarity_text": "Cold  stone", "input_json": as_input("x y", "go", field="observed_event")},
        {"id": "d", "similarity_text": "cold stone", "input_json": as_input("x y", "go", runtime_state={"a": 1, "b": 3})},
        {"id": "e", "similarity_text": " ", "input_json": "no json"},
        {"id": "f", "similarity_text": "", "input_json": None},
        {"id": None, "similarity_text": "Cold stone"},
        {"id": "g", "input_json": as_input(5, ["x"])},
    ]
    found = pairs(sl.same_looking_pairs(rows(*given, given[0])), "field", "id_a", "id_b")
    assert found == {("similarity_text", "a", "b"), ("similarity_text", "b", "c"), ("input", "a", "b")}
    assert {(r.id, r.plain_text, r.changed) for r in sl.plain_texts(rows(*given)).collect() if r.id in ("a", "b", "f")} >= {("a", "Cold stone", True), ("f", "", False)}


def test_same_looking_forms_on_many_rows(rows):
    """Exact copies beyond the limit: their smallest id stands for them, and no row and no two forms lose their link."""
    given = [{"id": f"a{k}", "similarity_text": "cold stone"} for k in range(5)] + [{"id": f"b{k}", "similarity_text": "cold  stone"} for k in range(4)] + [{"id": "c", "similarity_text": "cold\tstone"}]
    every = {(f"a{i}", f"b{k}") for i in range(5) for k in range(4)} | {(f"a{i}", "c") for i in range(5)} | {(f"b{i}", "c") for i in range(4)}
    assert {(a, b) for _, a, b in pairs(sl.same_looking_pairs(rows(*given)), "field", "id_a", "id_b")} == every
    found = {(a, b) for _, a, b in pairs(sl.same_looking_pairs(rows(*given), expand_limit=3), "field", "id_a", "id_b")}
    stars = {("a0", f"b{k}") for k in range(4)} | {(f"a{k}", "b0") for k in range(5)} | {(f"a{k}", "c") for k in range(5)} | {(f"b{k}", "c") for k in range(4)}
    assert found == stars and {i for p in found for i in p} == {r["id"] for r in given}


def test_format_duplicates(rows):
    given = [
        {"id": "b", "input_json": as_input("The Door, is shut!", "go", runtime_state={"a": [1], "b": None})},
        {"id": "a", "input_json": '{ "runtime_state": {"b": null, "a": [1]}, "player_action":"G-O", "scene" : "the door is  SHUT"}'},
        {"id": "c", "input_json": as_input("Ｔhe door is shut", "go", runtime_state={"a": [1], "b": 0})},
        {"id": "d", "input_json": as_input("the door is shut", "go", field="observed_event")},
        {"id": "e", "input_json": "broken  {"},
        {"id": "f", "input_json": "broken {"},
        {"id": "g"},
        {"id": None, "input_json": "broken {"},
        {"id": "h", "input_json": ""},
    ]
    assert pairs(fd.format_duplicates(rows(*given, *given)), "keep_id", "copy_id") == {("a", "b"), ("e", "f")}
    assert pairs(fd.collapsed(rows(*given)), "keep_id", "copies") == {("a", 2), ("c", 1), ("d", 1), ("e", 2), ("h", 1)}
    assert pairs(fd.collapsed(rows(*given, given[0], *given[3:5])), "keep_id", "copies") == {("a", 2), ("c", 1), ("d", 1), ("e", 2), ("h", 1)}


def test_radix_splits_until_buckets_fit(rows):
    prefix = "the same beginning of a very long text " * 20
    given = [{"id": f"{k:03}", "input_json": as_input(prefix + str(k // 3), "go")} for k in range(120)]
    given += [{"id": f"z{k}", "input_json": as_input("hot", "go")} for k in range(60)]
    want = {(f"{k - k % 3:03}", f"{k:03}") for k in range(120) if k % 3} | {("z0", f"z{k}") for k in range(1, 60)}
    assert pairs(fd.format_duplicates(rows(*given), capacity=10), "keep_id", "copy_id") == want


def test_trie_against_dict():
    rng = random.Random(1)
    trie, want = fd.CountTrie(burst=4), {}
    for _ in range(3000):
        key = bytes(rng.choice(b"ab\x00") for _ in range(rng.randrange(8)))
        i = f"{rng.randrange(99):02}"
        assert trie.add(key, 1, i, i) == (key not in want)
        n, lo, hi = want.get(key, (0, i, i))
        want[key] = (n + 1, min(lo, i), max(hi, i))
    assert {k: tuple(c) for k, c in trie.items()} == want
