import random

import pytest

from rowloom.llm import catalog_mapping as cm

from .conftest import pairs

ENTRIES = [("attribute", "Might"), ("attribute", "Wits"), ("skill", "Rope Work"), ("skill", "Speech (Old Ostrel)"), ("skill", "Speech (Ostrel)"), ("skill", "Beast Lore"), ("skill", "Eavesdropping")]


@pytest.fixture(scope="module")
def mapper():
    return cm.Mapper(ENTRIES)


@pytest.mark.parametrize(
    "typed, names",
    [
        ("rope work", ["Rope Work"]),
        ("=> Rop Wrok @ hard", ["Rope Work"]),
        ("RopeWork?", ["Rope Work"]),
        ("rp work", ["Rope Work"]),
        ("work, rope / std", ["Rope Work"]),
        ("eavesd.", ["Eavesdropping"]),
        ("W​іtѕ", ["Wits"]),
        ("either might or maybe beast lroe", ["Might", "Beast Lore"]),
        ("old ostrel speech", ["Speech (Old Ostrel)"]),
        ("the Ostrel tongue", ["Speech (Ostrel)"]),
        ("dragon lore", []),
        ("???", []),
        ("might might", ["Might"]),
    ],
)
def test_typed(mapper, typed, names):
    assert sorted(n for _, n in mapper.map(mapper.parts(typed))) == sorted(names)


def test_words_of_names_are_no_fillers():
    entries = [("skill", n) for n in ("Art and Craft", "Use Rope", "Check Pulse", "Hard Bargain", "Fight or Flight")]
    mapper = cm.Mapper(entries)
    for _, name in entries:
        for typed in (name, name.lower() + " please", name[:-1]):
            assert mapper.map(mapper.parts(typed)) == [("skill", name)]


def test_long_names_in_any_order():
    names = ["one two three four five six seven eight nine", "ten eleven twelve"]
    mapper = cm.Mapper([("skill", n) for n in names])
    ws = names[0].split()
    for seed in range(5):
        random.Random(seed).shuffle(ws)
        assert mapper.map(mapper.parts(" ".join(ws))) == [("skill", names[0])]
    assert mapper.map(mapper.parts("twelve eleven ten")) == mapper.map(mapper.parts("eleventwelveten")) == [("skill", names[1])]


def test_the_best_names_are_among_all_candidates(mapper):
    """Looking up longer runs first and errors one by one gives what all runs with all errors give."""
    rng = random.Random(8)
    pieces = ["rope", "work", "beast", "lore", "old", "ostrel", "speech", "might", "wits", "eavesdropping", "dragon", "wall"]
    for _ in range(300):
        ws = [list(rng.choice(pieces)) for _ in range(rng.randrange(1, 6))]
        for w in ws:
            for _ in range(rng.choice((0, 0, 1, 2))):
                w[rng.randrange(len(w))] = rng.choice("abcdersw")
        typed = tuple("".join(w) for w in ws)
        spans = [(lo, hi, c, n) for lo in range(len(typed)) for hi in range(lo + 1, min(lo + mapper.longest + 1, len(typed)) + 1) for n, c in mapper.every(typed[lo:hi]).items()]
        taken, want = set(), []
        for lo, hi, _, name in sorted(spans, key=lambda s: (s[2] - 1.5 * (s[1] - s[0]), s[2], s[0], s[3])):
            if taken.isdisjoint(range(lo, hi)):
                taken.update(range(lo, hi))
                want.append(mapper.names[name])
        assert sorted(mapper.map([typed])) == sorted(set(want))


def test_reports_of_values(spark):
    given = [("a", "Might!"), ("a", "Might!"), ("b", "might"), ("c", "dragon"), ("d", "Dragon?"), ("e", "?"), ("f", None), (None, "dragon"), ("g", "old ostrel speech")]
    df = spark.createDataFrame(given, "id string, raw_response string")
    assert pairs(cm.unmatched_values(df, ENTRIES), "value", "n_records") == {("dragon", 2), ("", 1)}
    found = {(r.value, r.label_name): (r.cost, r.n_records) for r in cm.candidate_values(df, ENTRIES).collect()}
    assert found["might", "Might"] == (0.0, 2) and {n for v, n in found if v == "old ostrel speech"} == {"Speech (Old Ostrel)", "Speech (Ostrel)"}
    assert cm.candidate_values(df.limit(0), ENTRIES).count() == 0 and cm.unmatched_values(df, []).count() == 4


def distance(a, b):
    """Optimal string alignment."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_automaton_against_distance():
    rng = random.Random(3)
    names = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    trie = cm.Trie()
    for n in names:
        trie.add(n, n)
    for _ in range(150):
        typed = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 9)))
        for most in range(4):
            assert trie.search(typed, most) == {n: e for n in names if (e := distance(typed, n)) <= most}


def test_mapped_values(spark):
    df = spark.createDataFrame(
        [("a", "Might"), ("a", "Might"), ("b", "nothing known"), ("c", None), ("d", " ​ "), (None, "Might"), ("e", "wits | might"), ("f", "might " * 500)],
        "id string, raw_response string",
    )
    assert pairs(cm.mapped_values(df, ENTRIES), "id", "label_kind", "label_name") == {
        ("a", "attribute", "Might"), ("b", "unmatched", ""), ("e", "attribute", "Wits"), ("e", "attribute", "Might"), ("f", "attribute", "Might"),
    }
    assert cm.mapped_values(df.limit(0), ENTRIES).count() == 0
    assert pairs(cm.mapped_values(df.where("id = 'a'"), []), "id", "label_kind") == {("a", "unmatched")}
