"""Annotation files to splits, evaluation and predictions, on files written here."""

import hashlib
import io
import json
import re
import subprocess

import pytest
from pyspark.sql import functions as F

from rowloom.operators.labels import Catalog
from rowloom.operators.predict import FixedReply, predictions
from rowloom.plans import config as cf
from rowloom.plans import evaluate as ev
from rowloom.plans import file_queries, queries  # noqa: F401
from rowloom.plans import prepare as pr
from rowloom.session import Scratch
from rowloom.sources import annotations as an
from rowloom.sources import catalogs, prepared, runs

CATALOG = {
    "source": {"skill_catalog": {"blob_sha": "a"}, "attribute_catalog": {"blob_sha": "b"}},
    "kinds": ["skill", "attribute"],
    "difficulties": ["success", "hard", "extreme"],
    "attributes": ["Might", "Wits"],
    "skills": [{"name": "Climbing", "category": "c", "subcategory": "", "initial": "20"}, {"name": "Trance", "category": "c", "subcategory": "", "initial": " "}],
}


def check(name="Climbing", kind="skill", difficulty="hard", **more):
    return {"kind": kind, "name": name, "difficulty": difficulty, "roll_system": "unidirectional"} | more


def record(i, text, checks=None, **more):
    note = {"raw_response": "typed", "roll_required": True, "check_mode": "single", "checks": [check()] if checks is None else checks}
    return {"id": i, "scene": {"en": f"scene {text}", "zh": "场景"}, "player_action": {"en": f"act {text}", "zh": "行动"}, "annotation": note} | more


def paired(made):
    made["annotation"]["check_mode"] = "pair"
    return made


def source():
    return {
        "schema_version": "1.0",
        "scenario_scope": "general",
        "skill_catalog": {"blob_sha": "a"},
        "attribute_catalog": {"blob_sha": "x"},
        "examples": [
            record("e1", "alpha one two three"),
            record("e2", "beta", related_example_id="e1"),
            record("e3", "gamma", checks=[check("Might", "attribute", "extreme")], runtime_state={"k": [1]}),
            record("e4", "delta", scenario_scope="game_specific"),
            paired(record("pair", "epsilon", checks=[check(), check("Wits", "attribute")])) | {"x": {"related_example_id": "gone"}},
            record("special", "zeta", checks=[check("Trance")]),
        ],
        "alternative_examples": [
            record("alt", "eta") | {"annotation": {"raw_response": "r", "roll_required": True, "choice": "one_of", "alternatives": [{"checks": [check()]}, {"checks": [check("Wits", "attribute")]}]}}
        ],
        "pending_examples": [{"id": "p1", "scene": {}}],
        "skipped_examples": [{"id": "s1", "skip_reason_raw": "out of scope"}],
        "conditional_examples": [{"id": "c1"}],
    }


@pytest.fixture
def config(tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(source()), encoding="utf-8")
    catalogs.write_catalog(CATALOG, str(tmp_path / "catalog.json"))
    return cf.merged({"data": {"sources": [str(tmp_path / "a.json")], "catalog": str(tmp_path / "catalog.json"), "prepared_dir": str(tmp_path / "out"), "near_duplicate_threshold": 0.95}})


def test_prepare_writes_splits_and_report(spark, config):
    document = pr.prepare(spark, config)
    assert document["errors"] == []
    assert {k: document["counts"][k] for k in ("trainable", "eval_only", "pending", "skipped", "unsupported")} == {"trainable": 4, "eval_only": 1, "pending": 1, "skipped": 1, "unsupported": 3}
    assert any("gone" in w for w in document["warnings"]) and any("another catalogue" in w for w in document["warnings"])
    out = config["data"]["prepared_dir"]
    hashes = prepared.split_hashes(spark, out)
    assert runs.read_document(f"{out}/{prepared.PROVENANCE}", runs.PROVENANCE)["split_sha256"] == hashes
    rows = {}
    for split in prepared.SPLITS:
        got, problems, digest = prepared.read_split(spark, out, split, catalogs.labels_of(CATALOG))
        assert problems.count() == 0 and digest == hashes[split]
        rows |= {r.id: (split, r.group_key, json.loads(r.row_json)) for r in got.collect()}
    assert set(rows) == {"e1", "e2", "e3", "e4", "alt"}
    assert rows["e4"][0] == "test" and rows["alt"][0] == "val" and rows["e1"][:2] == rows["e2"][:2]
    assert rows["e1"][2]["target"]["checks"] == [{"kind": "skill", "name": "Climbing", "difficulty": "hard"}]
    assert rows["e3"][2]["input"] == {"scene": "scene gamma", "player_action": "act gamma", "runtime_state": {"k": [1]}}
    assert rows["alt"][2]["target"] is None and len(rows["alt"][2]["reference"]["options"]) == 2
    assert rows["e2"][2]["links"] == ["e1"] and rows["e2"][2]["group_members"] == ["e1", "e2"]
    assert pr.summary(document).startswith("counts: ")


def test_report_is_written_entry_by_entry(spark, config, monkeypatch):
    monkeypatch.setattr(pr, "report", None)
    path, counts = pr.prepare_files(spark, config)
    document = json.loads(path.read_text(encoding="utf-8"))
    assert path.read_text(encoding="utf-8") == json.dumps(document, ensure_ascii=False, indent=2) + "\n"
    assert counts == document["counts"] and document["unsupported"] and document["warnings"] and not document["errors"]
    assert pr.report_sizes(str(path)) == (counts, {k: len(v) for k, v in document.items() if k != "counts"})


def test_errors_keep_the_last_clean_splits(spark, config, tmp_path):
    pr.prepare(spark, config)
    before = prepared.split_hashes(spark, config["data"]["prepared_dir"])
    data = source()
    data["examples"] += [record("e1", "again"), record("e9", "alpha one two three"), record("bad", "b", checks=[check("Flying")])]
    data["odd_examples"] = []
    (tmp_path / "a.json").write_text(json.dumps(data), encoding="utf-8")
    config["data"]["sources"].append(str(tmp_path / "missing.json"))
    document = pr.prepare(spark, config)
    told = " | ".join(e["message"] for e in document["errors"])
    assert all(x in told for x in ("duplicate id", "same input as e1", "unknown skill", "unknown section", "not found"))
    assert prepared.split_hashes(spark, config["data"]["prepared_dir"]) == before


def test_moved_rows_are_told(spark, config):
    pr.prepare(spark, config)
    config["data"]["val_fraction"] = 1.0
    document = pr.prepare(spark, config)
    config["data"]["val_fraction"] = 0.0
    again = pr.prepare(spark, config)
    assert any("moved from" in w for w in document["warnings"] + again["warnings"])


def test_prepare_never_overwrites_an_input(spark, config, tmp_path):
    config["data"]["sources"] = [str(tmp_path / "out" / "report.json")]
    with pytest.raises(ValueError, match="overwrite"):
        pr.build(spark, config)


@pytest.mark.parametrize(
    "content, message",
    [
        (b"\xff", "not valid JSON"), (b"[1]", "must hold a JSON object"), (b'{"a": 1, "a": 2}', "repeated key"), (b'{"schema_version": "2"}', "schema_version"),
        (b'{"schema_version": "1.0"}', "no records"), (b'{"schema_version": "1.0", "examples": {}}', "must be a list"),
        (b'{"schema_version": "1.0", "examples": [{"id": " "}]}', "no id"), (b'{"schema_version": "1.0", "skill_catalog": 3}', "must be an object"),
        (b'{"schema_version": "1.0", "examples": [{"id": "a", "related_example_id": 4}]}', "link must be"),
    ],
)
def test_file_problems(content, message):
    found = [v["message"] for kind, v in an.read_file("f", 0, content, "en") if kind == "problem"]
    assert any(message in m for m in found)


@pytest.mark.parametrize(
    "change, bucket, reason",
    [
        ({"annotation": None}, "errors", "no raw_response"),
        ({"annotation": {"raw_response": " "}}, "errors", "no raw_response"),
        ({"annotation": 3}, "errors", "annotation must be"),
        ({"note": {"roll_required": "yes"}}, "errors", "roll_required must be"),
        ({"note": {"roll_optional": True}}, "unsupported", "optional roll"),
        ({"note": {"optional_roll": {}}}, "errors", "optional_roll"),
        ({"note": {"check_mode": "triple"}}, "errors", "check_mode"),
        ({"note": {"check_mode": "pair"}}, "errors", "differ"),
        ({"note": {"roll_required": False}}, "errors", "without a roll"),
        ({"note": {"checks": {}}}, "errors", "must be a list"),
        ({"note": {"checks": [3]}}, "errors", "entry must be"),
        ({"note": {"checks": [check(roll_system=None)]}}, "errors", "no roll_system"),
        ({"note": {"checks": [check(roll_system="dual")]}}, "unsupported", "roll_system"),
        ({"note": {"checks": [check(kind="x")]}}, "errors", "unknown kind"),
        ({"note": {"checks": [check(difficulty="x")]}}, "errors", "unknown difficulty"),
        ({"note": {"checks": [check(), check("Flying")], "check_mode": "pair"}}, "errors", "unknown skill"),
        ({"note": {"checks": [check(), check("Trance")], "check_mode": "pair"}}, "unsupported", "pair"),
        ({"note": {"checks": [{"skill_selector": "any"}]}}, "errors", "no roll_system"),
        ({"input_mode": "other"}, "unsupported", "input_mode"),
        ({"input_mode": 3}, "errors", "input_mode must"),
        ({"observed_event": {"en": "x"}}, "errors", "does not go"),
        ({"scene": {"zh": "x"}}, "errors", "missing scene.en"),
        ({"character_state": {}}, "unsupported", "carries"),
        ({"runtime_state": [1]}, "errors", "runtime_state"),
        ({"scenario_scope": "elsewhere"}, "errors", "unknown scope"),
        ({}, "trainable", ""),
    ],
)
def test_record_outcomes(spark, change, bucket, reason):
    made = record("r", "text") | {k: v for k, v in change.items() if k != "note"}
    if "note" in change:
        made["annotation"] = made["annotation"] | change["note"]
    row = an.typed_record(made, "examples", "general", "en") | {"source": "f", "source_no": 0, "section_no": 0, "pos": 0}
    df = spark.createDataFrame([tuple(row[c] for c in an._COLUMNS)], an.RECORD)
    got = an.classified_records(df, catalogs.labels_of(CATALOG)).first()
    assert got.bucket == bucket and reason in got.reason


def test_evaluate_leaves_out_relatives(spark):
    check_ = [{"kind": "skill", "name": "Climbing", "difficulty": "hard"}]
    row = lambda i, split, group, links=(), text="x", scene=None: (i, split, group, list(links), [i, group], text, json.dumps({"scene": scene or i, "player_action": "a"}), (True, [check_]))
    schema = (
        "id string, split string, group_key string, links array<string>, group_members array<string>, text string, input_json string, "
        "reference struct<roll_required: boolean, options: array<array<struct<kind: string, name: string, difficulty: string>>>>"
    )
    rows = spark.createDataFrame(
        [row("t1", "train", "g1", text="one two three"), row("v1", "val", "g1"), row("v2", "val", "g2", links=["old"]), row("v3", "val", "g3", scene="t1"), row("v4", "val", "g4"), row("v5", "val", "g5", text="one two three")],
        schema,
    )
    train, old = spark.createDataFrame([("t1",)], "id string"), spark.createDataFrame([("t1",), ("old",)], "id string")
    texts = spark.createDataFrame([("one two three",)], "text string")
    records, metrics = ev.evaluate(rows, "val", FixedReply, catalogs.labels_of(CATALOG), train, old, texts, 0.9)
    assert [r.id for r in records.collect()] == ["v4"]
    assert metrics["held_out"] and metrics["excluded_trained_rows"] == 1 and metrics["excluded_related_rows"] == 3
    assert metrics["fields"]["format_valid"] == {"correct": 1, "total": 1, "rate": 1.0} and metrics["fields"]["exact"]["correct"] == 0
    _, everything = ev.evaluate(rows, "val", FixedReply, catalogs.labels_of(CATALOG), train, include_trained=True)
    assert everything["scored"] == 5 and not everything["held_out"]
    _, nothing = ev.evaluate(rows, "test", FixedReply, catalogs.labels_of(CATALOG), train)
    assert nothing["scored"] == 0 and nothing["note"] == ev.NOTES["empty"]


@pytest.mark.parametrize(
    "given",
    [{"x": 1}, {"data": 3}, {"data": {"sources": []}}, {"data": {"val_fraction": 2}}, {"data": {"val_fraction": True}}, {"data": {"language": " "}}, {"data": {"extra_groups": [["a"]]}}, {"inference": {"batch_size": 0}}, {"seed": None}, {"data": {"val_fraction": float("nan")}}],
)
def test_config_refusals(given):
    with pytest.raises(ValueError):
        cf.merged(given)


def test_config_defaults():
    assert cf.merged({}) == cf.DEFAULTS
    assert cf.merged({"data": {"near_duplicate_threshold": None, "val_fraction": 1}})["data"]["val_fraction"] == 1.0


def test_catalogs(spark, tmp_path):
    assert catalogs.labels_of(CATALOG) == Catalog(("Climbing",), ("Trance",), ("Might", "Wits"))
    for change in ({"kinds": []}, {"skills": [{"name": "a", "initial": "1"}] * 2}, {"extra": 1}, {"source": {}}, {"attributes": [" "]}):
        with pytest.raises(ValueError):
            catalogs.parse_catalog(json.dumps(CATALOG | change).encode())
    bank = '[{"name": "A b", "category": "c", "subcategory": "", "initial": "5"},\n {"name": "B", "category": "", "subcategory": "s", "initial": ""}]'
    (tmp_path / "skills.txt").write_text(bank)
    (tmp_path / "checks.py").write_text('KINDS = ("skill", "attribute")\nDIFFICULTIES = ("success",)\nATTRIBUTES = ["Might"]\n')
    made = catalogs.sync_catalog(str(tmp_path), "skills.txt", "checks.py", "r")
    assert [s["name"] for s in made["skills"]] == ["A b", "B"] and made["source"]["skill_catalog"]["blob_sha"] == catalogs.blob_sha(bank.encode())
    texts = spark.createDataFrame([("x", bank), ("y", bank + '{ "name" : 3}')], "path string, text string")
    assert {(r.path, r.name, r.complete) for r in catalogs.skills_in(texts).collect()} == {("x", "A b", True), ("x", "B", True), ("y", "A b", False), ("y", "B", False)}
    with pytest.raises(ValueError):
        catalogs.parse_skills(bank + '{ "name" : 3}')
    with pytest.raises(ValueError):
        catalogs.named_constant('KINDS = ("skill")', "KINDS")


def test_documents(tmp_path):
    path = str(tmp_path / "m.json")
    runs.write_document(path, {"a": float("nan"), "b": [1.0, float("inf")]})
    assert json.loads((tmp_path / "m.json").read_text()) == {"a": None, "b": [1.0, None], "not_finite": ["a", "b[1]"]}
    with pytest.raises(ValueError, match="adapter is missing"):
        runs.read_document(path, runs.MANIFEST)
    (tmp_path / "q.json").write_text('[{"scene": "s"}]')
    assert runs.read_queries(str(tmp_path / "q.json")) == ([{"scene": "s"}], True)
    files, one = runs.tree_digest(str(tmp_path))
    assert set(files) == {"m.json", "q.json"} and len(one) == 64


def test_queries_are_streamed(spark, tmp_path, monkeypatch):
    path = tmp_path / "q.json"
    given = [{"scene": "s" * n, "n": n, "x": [{"y": '"],[{'}]} for n in range(60)] + [12, None, "é灯", 1.5]
    for part in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(runs, "PART", part)
        for indent in (None, 2):
            path.write_text(" \n" + json.dumps(given, ensure_ascii=False, indent=indent) + " \n", encoding="utf-8")
            assert runs.read_queries(str(path)) == (given, True)
        for text, want in (("[]", ([], True)), (' {"a": 1} ', ([{"a": 1}], False))):
            path.write_text(text)
            assert runs.read_queries(str(path)) == want
        for text in ("", " ", "3", "[1, 2", "[1 2]", "[1,]", "[,1]", "[1]]", "[1] x", '[{"a": 1, "a": 2}]', "[NaN]", "[1e999]", '["\\ud800"]', "[" * 201 + "]" * 201, '[{"a"', '["x]'):
            path.write_text(text)
            with pytest.raises(runs.Refused):
                runs.read_queries(str(path))
    path.write_text(json.dumps(given))
    found, listed = runs.stored_queries(spark, str(path), Scratch(spark), batch=10)
    assert listed and [json.loads(r.query) for r in found.orderBy("nth").collect()] == given
    held = next(runs.query_stream(str(path))[0])  # the first is there before the rest is decoded
    assert held == given[0]


def test_queries_file_does_not_collect_its_rows(spark, tmp_path, monkeypatch):
    rows = [(f"i{n:02}", json.dumps({"scene": f"s {n}", "player_action": "a"})) for n in range(25)] + [("i03", json.dumps({"scene": "s 3", "player_action": "a"}))]
    spark.createDataFrame(rows, "id string, input_json string").write.parquet(str(tmp_path / "prepared_rows.parquet"))
    monkeypatch.setattr(runs, "read_queries", None)
    got = queries.QUERIES["queries_file"](spark, str(tmp_path)).collect()
    assert sorted((r.id, r.scene, r.listed) for r in got) == [(f"i{n:02}", f"s {n}", True) for n in range(25)]


def test_commands(spark, config, tmp_path, capsys):
    from rowloom.__main__ import main

    config["data"]["val_fraction"] = 0.0
    at = str(tmp_path / "config.json")
    runs.write_document(at, config)
    assert main(["prepare", "--config", at]) == 0
    (tmp_path / "q.json").write_text('[{"scene": "s", "player_action": "a"}, {"scene": "s"}]')
    capsys.readouterr()
    assert main(["predict", "--config", at, "--input", str(tmp_path / "q.json")]) == 0
    assert [p["valid"] for p in json.loads(capsys.readouterr().out)] == [True, False]
    assert main(["evaluate", "--config", at, "--split", "val", "--out", str(tmp_path / "scored")]) == 0
    metrics = json.loads(capsys.readouterr().out)
    assert metrics == json.loads((tmp_path / "scored" / "metrics.json").read_text()) and metrics["scored"] == 1 and metrics["held_out"]
    assert main(["smoke", "--config", at]) == 0
    assert '"scored": 3' in capsys.readouterr().out
    config["smoke"]["example_ids"] = ["e1", "nobody"]
    runs.write_document(at, config)
    with pytest.raises(SystemExit, match="nobody"):
        main(["smoke", "--config", at])
    with pytest.raises(SystemExit):
        main(["unheard of"])


def test_damaged_split_files(spark, config):
    pr.prepare(spark, config)
    out = config["data"]["prepared_dir"]
    with open(f"{out}/train.jsonl", encoding="utf-8") as f:
        lines = f.read().splitlines()
    row = json.loads(lines[0]) if lines else None
    split = "train"
    if row is None:
        split = "val"
        with open(f"{out}/val.jsonl", encoding="utf-8") as f:
            row = json.loads(f.readline())
    bad = [row, row, row | {"id": " "}, row | {"split": "x"}, {k: v for k, v in row.items() if k != "target"}, row | {"links": "x"}, row | {"group_members": []}, row | {"input": {}}, row | {"reference": {}}, row | {"similarity_text": " "}]
    with open(f"{out}/{split}.jsonl", "w", encoding="utf-8") as f:
        f.write("\n".join([json.dumps(b) for b in bad] + ["", '{"id": 1, "id": 2}', "[]"]))
    rows, problems, _ = prepared.read_split(spark, out, split)
    assert rows.count() == 1 and {r.line for r in problems.collect()} == {2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 13}
    before, unreadable = prepared.previous_splits(spark, out)
    assert unreadable == {split: 1} and before.count() > 0


@pytest.fixture
def run(spark, config, tmp_path):
    """A run that was trained on the prepared splits."""
    from rowloom.__main__ import _prepared_rows
    from rowloom.operators.duplicates import fingerprint

    pr.prepare(spark, config)
    prepared_dir = config["data"]["prepared_dir"]
    rows = _prepared_rows(spark, prepared_dir, catalogs.labels_of(CATALOG)).withColumn("fingerprint", fingerprint(F.col("input_json")))
    folder = tmp_path / "run"
    (folder / "model").mkdir(parents=True)
    (folder / "model" / "weights").write_text("w")
    catalogs.write_catalog(CATALOG, str(folder / "catalog.json"))
    provenance = runs.read_document(f"{prepared_dir}/{prepared.PROVENANCE}", runs.PROVENANCE)
    document = {
        "precision": "fp32", "adapter": None, "catalog_sha256": hashlib.sha256((folder / "catalog.json").read_bytes()).hexdigest(),
        "model_files": runs.tree_digest(str(folder / "model"))[0], "global_steps": 1, "metrics": {}, "config": config,
        "prompt": {"format_version": runs.PROMPT_FORMAT, "system_prompt": "p", "system_prompt_sha256": runs.text_sha256("p"), "language": "en"},
        "base_model": {"name_or_path": "base", "revision": None, "resolved_commit": None, "local_sha256": None, "in_run": None, "trust_remote_code": False},
        "examples": {"split_sha256": provenance["split_sha256"], "source_files": provenance["sources"]},
    }
    runs.write_manifest(str(folder), document, runs.training_lists(rows))
    return folder


def edit_manifest(run, **changes):
    path = run / "run_manifest.json"
    data = json.loads(path.read_text())
    for at, value in changes.items():
        place, *parts = data, *at.split("__")
        for p in parts[:-1]:
            place = place[p]
        place[parts[-1]] = value
    path.write_text(json.dumps(data))


def test_manifest_round_trip(spark, run, config):
    manifest = runs.read_manifest(str(run))
    train = {r.id for r in prepared.read_split(spark, config["data"]["prepared_dir"], "train")[0].collect()}
    assert train and set(manifest["examples"]["train_ids"]) == train == set(manifest["examples"]["train_links"])
    assert manifest["examples"]["train_fingerprints"] == sorted(manifest["examples"]["train_fingerprints"])
    then = runs.history(spark, str(run))
    assert {r.id for r in then["ids"].collect()} == train <= {r.id for r in then["seen"].collect()}
    assert then["fingerprints"].count() == then["texts"].count() == len(train)
    assert runs.integrity_problems(str(run), manifest) == []


@pytest.mark.parametrize(
    "change, place",
    [
        ({"precision": "auto"}, "precision"), ({"adapter": "other"}, "adapter"), ({"global_steps": True}, "global_steps"), ({"base_model__revision": 3}, "base_model.revision"),
        ({"examples__train_links": {"a": "b"}}, "examples.train_links"), ({"examples__source_files": [{"path": "x"}]}, r"examples.source_files\[0\].sha256"),
        ({"model_files": {"a": 1}}, "model_files"), ({"config": {"seed": 1}}, "config lacks"), ({"config__data__val_fraction": 2}, "val_fraction"), ({"prompt": []}, "prompt is no object"),
    ],
)
def test_damaged_manifests(change, place):
    fields = {
        "precision": "fp32", "adapter": "lora", "catalog_sha256": "", "model_files": {}, "global_steps": 1, "metrics": {}, "config": cf.merged({}),
        "prompt": {"format_version": "1", "system_prompt": "p", "system_prompt_sha256": "", "language": "en"},
        "base_model": {"name_or_path": "b", "revision": None, "resolved_commit": None, "local_sha256": None, "in_run": None, "trust_remote_code": False},
        "examples": {"train_ids": [], "val_ids": [], "train_fingerprints": [], "train_texts": [], "train_scenario_ids": [], "split_sha256": {}, "train_links": {}, "source_files": []},
    }
    assert runs.document_problem(fields, runs.MANIFEST) is None
    for at, value in change.items():
        data, *parts = fields, *at.split("__")
        for p in parts[:-1]:
            data = data[p]
        data[parts[-1]] = value
    assert re.search(place, runs.document_problem(fields, runs.MANIFEST))


def test_integrity(run):
    manifest = runs.read_manifest(str(run))
    told = lambda **more: " ".join(runs.integrity_problems(str(run), manifest | more))
    assert "format" in told(prompt=manifest["prompt"] | {"format_version": "0"}) and "system prompt" in told(prompt=manifest["prompt"] | {"system_prompt": "q"})
    assert "no digests" in told(model_files={}) and "hub" in told(adapter="lora", base_model=manifest["base_model"] | {"name_or_path": str(run)})
    assert "is gone" in told(adapter="lora", base_model=manifest["base_model"] | {"local_sha256": "x", "in_run": "nowhere"})
    (run / "model" / "weights").write_text("other")
    (run / "catalog.json").write_text("{}")
    assert "weights" in told() and "catalogue" in told()


def test_evaluation_of_a_run(spark, run, config, tmp_path, capsys, monkeypatch):
    from rowloom.__main__ import main

    evaluate = lambda *more: main(["evaluate", "--run", str(run), *more])
    assert evaluate("--split", "val") == 0
    metrics = json.loads(capsys.readouterr().out)
    assert metrics["data_revision"]["matches_training"] and metrics["inference"]["matches_training"] and (run / "eval" / "val" / "metrics.json").exists()
    for inside in (run / "model", run / "model" / "deep"):
        with pytest.raises(SystemExit, match="would replace"):
            evaluate("--out", str(inside))
    with pytest.raises(SystemExit, match="would replace"):
        other = cf.merged(config) | {"data": config["data"] | {"catalog": str(tmp_path / "x" / "metrics.json")}}
        (tmp_path / "x").mkdir()
        (tmp_path / "x" / "metrics.json").write_text("{}")
        runs.write_document(str(tmp_path / "other.json"), other)
        evaluate("--config", str(tmp_path / "other.json"), "--out", str(tmp_path / "x"))
    # A trained row that has got another id and another text is known by its input.
    data = source()
    trained = runs.read_manifest(str(run))["examples"]["train_ids"][0]
    row = next(r for s in ("examples", "alternative_examples") for r in data[s] if r["id"] == trained)
    row["id"], row["scene"]["zh"] = "renamed", "别的"
    data["examples"] += [record(f"new{k}", f"fresh words {k} {'xyz'[k % 3] * (k + 2)}") for k in range(12)]
    (tmp_path / "a.json").write_text(json.dumps(data), encoding="utf-8")
    assert pr.prepare(spark, config)["errors"] == []
    with pytest.raises(SystemExit, match="not the data that the run was trained on"):
        evaluate("--split", "val")
    splits = {r.id: s for s in prepared.SPLITS for r in prepared.read_split(spark, config["data"]["prepared_dir"], s)[0].collect()}
    capsys.readouterr()
    assert evaluate("--split", splits["renamed"], "--allow-data-change") == 0
    metrics = json.loads(capsys.readouterr().out)
    assert not metrics["data_revision"]["matches_training"] and [c["path"] for c in metrics["data_revision"]["changed_sources"]] == config["data"]["sources"]
    said = spark.read.json(str(run / "eval" / splits["renamed"] / "predictions"))
    assert (splits["renamed"] == "train") == ("renamed" in {r.id for r in said.collect()})
    assert splits["renamed"] == "train" or metrics["excluded_trained_rows"] >= 1
    edit_manifest(run, config__data__split_seed=5)
    with pytest.raises(SystemExit, match="differ in"):
        runs.write_document(str(tmp_path / "c.json"), config)
        evaluate("--config", str(tmp_path / "c.json"))
    edit_manifest(run, examples=3)
    with pytest.raises(SystemExit, match="examples is no object"):
        evaluate()


def test_prediction_of_a_run(run, tmp_path, capsys, monkeypatch):
    from rowloom.__main__ import main

    queries = [{"scene": "s", "player_action": "a"}, {"scene": "s"}]
    monkeypatch.setattr("sys.stdin", io.TextIOWrapper(io.BytesIO(json.dumps(queries).encode())))
    assert main(["predict", "--run", str(run), "--input", "-"]) == 0
    said = json.loads(capsys.readouterr().out)
    assert [p["valid"] for p in said] == [True, False] and said[1]["errors"][0].startswith("bad query: ") and {"game_request", "note"} <= set(said[0])
    (run / "model" / "weights").write_text("other")
    (tmp_path / "bad.json").write_text(json.dumps(queries[1]))
    assert main(["predict", "--run", str(run), "--input", str(tmp_path / "bad.json")]) == 0
    (tmp_path / "q.json").write_text(json.dumps(queries))
    with pytest.raises(SystemExit, match="weights"):
        main(["predict", "--run", str(run), "--input", str(tmp_path / "q.json")])


class Counting:
    """Asks for a roll where the scene says so; queries of over 40 characters do not fit."""

    def reply(self, queries):
        kinds = {"skill": "Climbing", "attribute": "Might", "odd": "Nothing"}
        return [json.dumps({"roll_required": q["scene"] in kinds, "checks": [{"kind": q["scene"], "name": kinds[q["scene"]], "difficulty": "hard"}] if q["scene"] in kinds else []}) for q in queries]

    def length_problem(self, query):
        return "too long" if len(json.dumps(query)) > 60 else None


def test_requests_and_lengths(spark):
    given = [("1", "skill"), ("2", "attribute"), ("3", "none"), ("4", "odd"), ("5", "x" * 80)]
    rows = spark.createDataFrame([(i, json.dumps({"scene": s, "player_action": "a"})) for i, s in given], "id string, input_json string")
    out = {r.id: r for r in predictions(rows, Counting, catalogs.labels_of(CATALOG)).collect()}
    assert out["1"].game_request.asDict() == {"skill": "Climbing", "difficulty": "hard"} and out["1"].note is None
    assert out["2"].game_request is None and out["2"].note and out["3"].game_request is None and out["3"].note is None
    assert not out["4"].valid and out["5"].errors == ["bad query: too long"] and out["5"].raw_output is None


def test_files_of_a_commit(tmp_path):
    git = lambda *a: subprocess.run(["git", "-c", "user.name=n", "-c", "user.email=e", *a], cwd=tmp_path, check=True, capture_output=True)
    assert catalogs.committed_files(str(tmp_path), ["a"]) is None
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a b").write_text("one\n")
    git("init", "-q")
    git("add", "-A")
    git("commit", "-qm", "c")
    commit, files = catalogs.committed_files(str(tmp_path / "sub"), ["a b"])
    assert len(commit) == 40 and files == {"a b": b"one\n"}
    with pytest.raises(ValueError, match="lacks"):
        catalogs.committed_files(str(tmp_path), ["a b"])
    (tmp_path / "sub" / "a b").write_text("two\n")
    with pytest.raises(ValueError, match="uncommitted"):
        catalogs.committed_files(str(tmp_path), ["sub/a b"])


def test_numbered_lines_of_many_blocks(spark, tmp_path):
    lines = [f"line {k} " + "x" * (k % 50) for k in range(3000)]
    lines[7], lines[9] = "", "  "
    (tmp_path / "f").write_bytes("\n".join(lines).encode() + b"\n\xff\xfe\n")
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = {r.line: (r.value, r.utf8) for r in prepared.numbered_lines(spark, str(tmp_path / "f")).collect()}
        assert prepared.numbered_lines(spark, str(tmp_path / "f")).rdd.getNumPartitions() > 8
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert found == {k + 1: (line, True) for k, line in enumerate(lines)} | {3001: (None, False)}
    (tmp_path / "empty").write_text("")
    assert prepared.numbered_lines(spark, str(tmp_path / "empty")).count() == 0
