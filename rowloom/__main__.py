"""Commands: `prepare` splits annotation files, `predict` answers queries, `evaluate` scores a prepared split, `smoke` runs all
stages over a few training rows, `catalog` builds the catalogue. With --run, what the run recorded decides: its settings, its
catalogue, and which rows are left out as trained on or related to these; without, today's train split stands for it."""

from __future__ import annotations

import argparse
import importlib
import json
import sys
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.duplicates import duplicate_inputs
from .operators.predict import FixedReply, predictions, query_errors
from .plans import evaluate as ev
from .plans import prepare as pr
from .plans.config import load_config
from .session import local_session
from .sources import catalogs, prepared, runs

EVALUATION = ("predictions", "metrics.json")


def _predictor(name: str | None):
    """module:factory; without a name the stub that answers no roll."""
    if not name:
        return FixedReply
    module, _, factory = name.partition(":")
    return getattr(importlib.import_module(module), factory)


def _prepared_rows(spark, folder: str, catalog):
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(
        "links array<string>, group_members array<string>, similarity_text string, "
        "reference struct<roll_required: boolean, options: array<array<struct<kind: string, name: string, difficulty: string>>>>"
    )
    parts = []
    for split in prepared.SPLITS:
        rows, problems, _ = prepared.read_split(spark, folder, split, catalog)
        if bad := problems.orderBy("line").first():
            sys.exit(f"{folder}/{split}.jsonl:{bad.line}: {bad.problem}; prepare the splits again")
        parts.append(rows)
    out = reduce(DataFrame.unionByName, parts)
    parsed = out.select(
        "id", "split", "group_key", F.get_json_object("row_json", "$.lang").alias("lang"), F.get_json_object("row_json", "$.input").alias("input_json"), F.from_json("row_json", schema).alias("r")
    )
    rows = parsed.select("id", "split", "group_key", "lang", "input_json", "r.links", "r.group_members", F.col("r.similarity_text").alias("text"), "r.reference")
    if bad := rows.groupBy("id").count().where("count > 1").orderBy("id").first():
        sys.exit(f"{folder}: {bad.id} is in more than one split file; prepare the splits again")
    same = duplicate_inputs(rows).orderBy("ids").first()
    if same:
        sys.exit(f"{folder}: rows with the same input: {same.ids}; prepare the splits again")
    return rows


def _smoke(spark, rows, settings: dict, predictor, catalog, size: int) -> dict:
    """Metrics over the named training rows, or the first ones by id; an id that is no training row is refused."""
    train = rows.where("split = 'train'")
    if wanted := settings["example_ids"]:
        named = spark.createDataFrame([(i,) for i in wanted], "id string")
        if missing := [r.id for r in named.join(train, "id", "left_anti").collect()]:
            sys.exit(f"no training rows: {missing}")
    else:
        named = train.select("id").orderBy("id").limit(settings["num_examples"])
    chosen = train.join(named, "id", "left_semi")
    return ev.evaluate(chosen, "train", predictor, catalog, chosen.select("id"), include_trained=True, batch_size=size)[1]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="rowloom", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("prepare").add_argument("--config", required=True)
    p = commands.add_parser("predict")
    p.add_argument("--run")
    p.add_argument("--config")
    p.add_argument("--input", required=True, help="a file, or - for standard input")
    p.add_argument("--predictor")
    e = commands.add_parser("evaluate")
    e.add_argument("--run")
    e.add_argument("--config")
    e.add_argument("--split", choices=prepared.SPLITS, default="val")
    e.add_argument("--out")
    e.add_argument("--allow-data-change", action="store_true")
    e.add_argument("--predictor")
    k = commands.add_parser("smoke")
    k.add_argument("--config", required=True)
    k.add_argument("--predictor")
    c = commands.add_parser("catalog")
    for name in ("--checkout", "--skills", "--checks", "--repository", "--out"):
        c.add_argument(name, required=True)
    args = parser.parse_args(argv)
    if args.command == "catalog":
        inputs = [str(Path(args.checkout, p)) for p in (args.skills, args.checks)]
        if clashes := prepared.overwritten([args.out], inputs):
            sys.exit(f"--out would overwrite {clashes}")
        catalogs.write_catalog(catalogs.sync_catalog(args.checkout, args.skills, args.checks, args.repository), args.out)
        return 0
    run = getattr(args, "run", None)
    if not run and not args.config:
        parser.error("--run or --config is needed")
    manifest = _or_exit(lambda: runs.read_manifest(run)) if run else None
    config = load_config(args.config) if args.config else manifest["config"]
    spark = local_session()
    if args.command in ("prepare", "smoke"):
        document = pr.prepare(spark, config)
        print(pr.summary(document))
        if document["errors"] or args.command == "prepare":
            return int(bool(document["errors"]))
    if args.command == "predict":
        return _predict(spark, args, config, manifest)
    if args.command == "evaluate":
        return _evaluate(spark, args, config, manifest)
    catalog = _catalog(config)
    rows = _prepared_rows(spark, config["data"]["prepared_dir"], catalog)
    print(json.dumps(_smoke(spark, rows, config["smoke"], _predictor(args.predictor), catalog, config["inference"]["batch_size"]), indent=2))
    return 0


def _or_exit(made):
    try:
        return made()
    except (OSError, ValueError) as e:
        sys.exit(str(e))


def _catalog(config: dict):
    return catalogs.labels_of(catalogs.parse_catalog(Path(config["data"]["catalog"]).read_bytes()))


def _intact(run: str, manifest: dict, checks: tuple = runs.INTEGRITY):
    """The run's own catalogue, where everything that is checked is as it was recorded."""
    if problems := runs.integrity_problems(run, manifest, checks):
        sys.exit(f"--run {run}: " + "; ".join(problems))
    return _or_exit(lambda: catalogs.labels_of(catalogs.parse_catalog(Path(run, "catalog.json").read_bytes())))


def _predict(spark, args, config: dict, manifest: dict | None) -> int:
    queries, listed = _or_exit(lambda: runs.read_queries(args.input))
    # A batch without a valid query needs no model, so the run's model files are looked at only for others.
    runnable = any(not query_errors(q) for q in queries)
    catalog = _intact(args.run, manifest, runs.INTEGRITY if runnable else runs.INTEGRITY[:3]) if manifest else _catalog(config)
    rows = spark.createDataFrame([(f"{i:09}", json.dumps(q, ensure_ascii=False)) for i, q in enumerate(queries)], "id string, input_json string")
    said = predictions(rows, _predictor(args.predictor), catalog, config["inference"]["batch_size"]).orderBy("id").drop("id")
    results = [r.asDict(recursive=True) for r in said.collect()]
    print(json.dumps(results if listed else results[0], ensure_ascii=False, indent=2))
    return 0


def _guarded(out: str, config: dict, run: str | None, manifest: dict | None) -> None:
    """Refuses a folder whose outputs would replace an input, or lie in a folder that the run is checked against."""
    data = config["data"]
    inputs = [*data["sources"], data["catalog"], *(str(Path(data["prepared_dir"], o)) for o in prepared.OUTPUTS)]
    pinned = []
    if run:
        inputs += [str(Path(run, f)) for f in ("run_manifest.json", "catalog.json", "train_log.jsonl")]
        pinned = [str(Path(run, "model"))] + ([str(at)] if manifest["adapter"] and (at := runs.base_folder(run, manifest)).is_dir() else [])
    outputs = [str(Path(out, f)) for f in EVALUATION]
    if clashes := prepared.overwritten(outputs, inputs) + prepared.inside(outputs, pinned):
        sys.exit(f"refusing to evaluate: {out} would replace {clashes}")


def _revision(spark, args, config: dict, manifest: dict) -> tuple[dict, dict]:
    """(what changed since the run was trained, hashes of the split files); other data, or a change that is not allowed, is refused."""
    folder = config["data"]["prepared_dir"]
    provenance = _or_exit(lambda: runs.read_document(str(Path(folder, prepared.PROVENANCE)), runs.PROVENANCE))
    if why := runs.revision_problem(manifest, provenance):
        sys.exit(f"refusing to evaluate: {why}")
    hashes = prepared.split_hashes(spark, folder)
    changes = runs.revision_changes(manifest, provenance, hashes)
    if not changes["matches_training"] and not args.allow_data_change:
        names = [c.get("path") or c["split"] for c in changes["changed_sources"] + changes["changed_splits"]]
        sys.exit(f"refusing to evaluate: not the data that the run was trained on, changed: {names}; --allow-data-change scores it anyway")
    return changes, hashes


def _evaluate(spark, args, config: dict, manifest: dict | None) -> int:
    if not args.out and not args.run:
        sys.exit("--out is needed without --run")
    out = args.out or str(Path(args.run, "eval", args.split))
    _guarded(out, config, args.run, manifest)
    folder = config["data"]["prepared_dir"]
    if manifest:
        changes, hashes = _revision(spark, args, config, manifest)
        catalog = _intact(args.run, manifest, runs.INTEGRITY[:3])
    else:
        catalog = _catalog(config)
    rows = _prepared_rows(spark, folder, catalog)
    if manifest:
        if why := runs.revision_problem(manifest, {"sources": [{"path": p} for p in manifest["config"]["data"]["sources"]], "split_config": {}}, {r.lang for r in rows.select("lang").distinct().collect()}):
            sys.exit(f"refusing to evaluate: {why}")
        if prepared.split_hashes(spark, folder) != hashes:
            sys.exit("refusing to evaluate: a split file changed while it was read")
        _intact(args.run, manifest)
        records, metrics = ev.evaluate_run(spark, args.run, rows, args.split, _predictor(args.predictor), catalog, manifest, config, changes)
    else:
        train = rows.where("split = 'train'").select("id")
        records, metrics = ev.evaluate(rows, args.split, _predictor(args.predictor), catalog, train, batch_size=config["inference"]["batch_size"])
    Path(out).mkdir(parents=True, exist_ok=True)
    records.write.mode("overwrite").json(str(Path(out, EVALUATION[0])))
    runs.write_document(str(Path(out, EVALUATION[1])), metrics)
    print(json.dumps(metrics, ensure_ascii=False, indent=2))
    return 0


if __name__ == "__main__":
    sys.exit(main())
