"""Evaluation: what of a split may be scored, predictions, scores and one metrics document."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import leakage, predict, scoring
from ..operators.duplicates import fingerprint
from ..operators.labels import Catalog
from ..session import Scratch
from ..sources.runs import history

# What a metrics document says about itself.
NOTES = {
    "empty": "the split is empty; nothing was scored",
    "excluded": "nothing was scored: every row was used in training or belongs to a training row's scenario",
    "trained": "not a held-out result: scored rows were used in training",
    "val": "held-out validation, of the same distribution as training",
    "test": "independent test",
}


def evaluate(
    rows: DataFrame,
    split: str,
    predictor: Callable[[], object],
    catalog: Catalog,
    train_ids: DataFrame,
    historical: DataFrame | None = None,
    train_texts: DataFrame | None = None,
    threshold: float | None = None,
    include_trained: bool = False,
    batch_size: int = 8,
    train_keys: DataFrame | None = None,
) -> tuple[DataFrame, dict]:
    """(records, metrics) of one split of rows (id, split, group_key, links, group_members, text, input_json, reference).

    Rows that were trained on, by id or by input, and their relatives are left out unless `include_trained`. Relatives are
    sought among all rows, whatever split is scored. train_keys: fingerprints of trained inputs, by default those that the
    rows of train_ids have now.
    """
    scratch = Scratch(rows.sparkSession)
    keyed = scratch.keep(rows.withColumn("fingerprint", fingerprint(F.col("input_json"))))
    keys = train_keys if train_keys is not None else keyed.join(train_ids.select("id").distinct(), "id", "left_semi")
    seen = scratch.keep(leakage.trained(keyed.select("id", "fingerprint"), train_ids, keys))
    related = scratch.keep(leakage.training_relatives(keyed, seen, historical if historical is not None else train_ids, train_texts, threshold))
    chosen = keyed.where(F.col("split") == split)
    kept = chosen if include_trained else leakage.held_out(chosen, seen, related)
    said = predict.predictions(kept, predictor, catalog, batch_size)
    marked = seen.withColumn("trained_on", F.lit(True))
    both = kept.join(said, "id").join(marked, "id", "left").withColumn("trained_on", F.coalesce("trained_on", F.lit(False)))
    records = scratch.keep(scoring.scored(both, "id", "split", "input_json", "reference", "decision", "errors", "raw_output", "trained_on"))
    totals = records.agg(F.count("*").alias("n"), F.coalesce(F.bool_or("trained_on"), F.lit(False)).alias("seen")).first()
    held = bool(totals.n) and not totals.seen and split != "train"
    which = ("excluded" if chosen.limit(1).count() else "empty") if not totals.n else "trained" if not held else split
    fields = {r.field: {"correct": r.correct, "total": r.total, "rate": r.rate} for r in scoring.summarized(records).collect()}
    excluded = {r.reason: r.n for r in leakage.exclusions(chosen, seen, related).collect()} if not include_trained else {}
    metrics = {
        "split": split, "held_out": held, "independent_test": held and split == "test", "note": NOTES[which], "scored": totals.n,
        "excluded_trained_rows": excluded.get("trained", 0), "excluded_related_rows": excluded.get("related", 0), "fields": fields,
    }
    return records, metrics


def evaluate_run(
    spark: SparkSession, run: str, rows: DataFrame, split: str, predictor: Callable[[], object], catalog: Catalog, manifest: dict, config: dict, revision: dict
) -> tuple[DataFrame, dict]:
    """`evaluate` with the exclusions of a run: what its manifest recorded decides which rows it was trained on and which
    are related to these, whatever has become of the training rows since. The metrics record the revision and the settings."""
    then = history(spark, run)
    records, metrics = evaluate(
        rows, split, predictor, catalog, then["ids"], then["seen"], then["texts"], manifest["config"]["data"]["near_duplicate_threshold"] or None,
        split == "train", config["inference"]["batch_size"], then["fingerprints"],
    )
    longest, trained = config["inference"]["max_new_tokens"], manifest["config"]["inference"]["max_new_tokens"]
    settings = config["inference"] | {"trained_max_new_tokens": trained, "matches_training": longest == trained}
    return records, metrics | {"data_revision": revision, "inference": settings}
