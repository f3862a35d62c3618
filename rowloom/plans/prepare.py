"""Preparation: annotation files to groups, splits, split files and a report."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import components, similarity, splits
from ..operators.duplicates import fingerprint, first_wins
from ..operators.labels import Catalog, bucket_counts
from ..session import Scratch
from ..sources import annotations, catalogs, prepared
from ..sources.runs import write_document
from .config import SPLIT_KEYS


@dataclass
class Prepared:
    scan: annotations.Scan
    outcomes: DataFrame
    rows: DataFrame
    near: DataFrame
    errors: DataFrame
    warnings: DataFrame


def build(spark: SparkSession, config: dict, catalog: Catalog | None = None, blobs: tuple[str, str] | None = None) -> Prepared:
    """Rows with groups and splits, and everything that was found on the way; nothing is written.

    Vertices of the scenario graph are all record ids, rows or not; edges are links, configured groups and similar texts.
    """
    data = config["data"]
    if clashes := prepared.overwritten([str(Path(data["prepared_dir"], o)) for o in prepared.OUTPUTS], [*data["sources"], data["catalog"]]):
        raise ValueError(f"prepared_dir would overwrite the inputs {clashes}")
    if catalog is None:
        document = catalogs.parse_catalog(Path(data["catalog"]).read_bytes())
        catalog = catalogs.labels_of(document)
        blobs = tuple(document["source"][k]["blob_sha"] for k in ("skill_catalog", "attribute_catalog"))
    scratch = Scratch(spark)
    scan = annotations.scan_annotations(spark, data["sources"], data["language"])
    outcomes = scratch.keep(annotations.classified_records(scan.records, catalog))
    rows = scratch.keep(annotations.rows_of(scan.records, outcomes).withColumn("lang", F.lit(data["language"])))
    vertices = scan.records.groupBy("id").agg(F.first("links").alias("links"))
    groups = spark.createDataFrame(list(enumerate(data["extra_groups"])), "group_no int, members array<string>")
    extra, refused = splits.configured_edges(groups, vertices)
    near = spark.createDataFrame([], "a string, b string, similarity double")
    if data["near_duplicate_threshold"]:
        near = scratch.keep(similarity.similar_pairs(rows.select("id", F.col("similarity_text").alias("text")), data["near_duplicate_threshold"]))
    grouped = scratch.keep(splits.scenario_groups(vertices, extra, near, scratch=scratch))
    members = components.group_members(grouped.withColumnRenamed("group_key", "component")).select(F.col("component").alias("group_key"), F.col("members").alias("group_members"))
    keyed = rows.join(grouped, "id").withColumn("has_target", F.col("target").isNotNull())
    split = scratch.keep(splits.assign_splits(keyed, data["val_fraction"], data["split_seed"]).join(members, "group_key"))
    torn = splits.straddling_groups(split)
    order = ["source_no", "section_no", "pos", "id"]
    copies = first_wins(split.withColumn("key", fingerprint(F.col("input_json"))), ["key"], order).where("NOT wins")
    error = lambda df, source, i, message: df.select(source.alias("source"), i.alias("id"), message.alias("message"))
    none = F.lit(None).cast("string")
    errors = (
        scan.problems.select("source", "id", "message")
        .unionByName(error(outcomes.where("bucket = 'errors'"), F.col("at"), F.col("id"), F.col("reason")))
        .unionByName(error(copies, F.col("source"), F.col("id"), F.concat(F.lit("same input as "), "first_id")))
        .unionByName(error(refused, F.lit("config data.extra_groups"), none, F.concat(F.lit("unknown ids "), F.array_join("unknown", ", "))))
        .unionByName(error(torn, none, F.col("group_key"), F.concat(F.lit("group spans the splits "), F.array_join("splits", ", "))))
    )
    dangling = splits.dangling_links(vertices, vertices).select(F.concat("id", F.lit(" links to "), "link", F.lit(", which no source has")).alias("warning"))
    before, unreadable = prepared.previous_splits(spark, data["prepared_dir"])
    moved = splits.moved_rows(before, split).select(F.concat("id", F.lit(" moved from "), "was", F.lit(" to "), "now").alias("warning"))
    warnings = dangling.unionByName(moved)
    if blobs:
        drift = scan.files.where(~(F.col("skill_blob").eqNullSafe(blobs[0]) & F.col("attribute_blob").eqNullSafe(blobs[1])))
        warnings = warnings.unionByName(drift.select(F.concat("source", F.lit(": labelled against another catalogue")).alias("warning")))
    if unreadable:
        told = [(f"{s}.jsonl: {n} lines of the last run cannot be read",) for s, n in unreadable.items()]
        warnings = warnings.unionByName(spark.createDataFrame(told, "warning string"))
    return Prepared(scan, outcomes, split, near, scratch.keep(errors), scratch.keep(warnings))


def _report(made: Prepared) -> dict[str, dict | Iterator[dict]]:
    """The parts of the report, counts and lists in order; lists come a partition at a time."""
    rows = lambda df, *order: (r.asDict(recursive=True) for r in df.orderBy(*order).toLocalIterator())
    counts = bucket_counts(made.outcomes).first().asDict() | {f"split_{r.split}": r.n for r in splits.split_sizes(made.rows).collect()}
    counts["errors"] = made.errors.count()
    listed = made.outcomes.select("id", F.col("at").alias("source"), "bucket", "reason")
    return {
        "counts": counts,
        "sources": rows(made.scan.files, "source"),
        "errors": rows(made.errors, "source", "id", "message"),
        "warnings": (r["warning"] for r in rows(made.warnings, "warning")),
        **{b: rows(listed.where(F.col("bucket") == b).drop("bucket"), "id") for b in ("unsupported", "pending", "skipped", "eval_only")},
        "near_duplicates": rows(made.near, "a", "b"),
    }


def report(made: Prepared) -> dict:
    """One document: counts, and lists in order. It is what a person reads, as large as what has to be read."""
    return {k: v if isinstance(v, dict) else list(v) for k, v in _report(made).items()}


def write_report(made: Prepared, path: str) -> dict:
    """Write the report, entry by entry, and return its counts; no list is held as a whole."""
    text = lambda v, deep: json.dumps(v, ensure_ascii=False, indent=2).replace("\n", "\n" + " " * deep)
    parts = _report(made)
    with open(path, "w", encoding="utf-8") as f:
        for i, (name, part) in enumerate(parts.items()):
            f.write(("{" if not i else ",") + f"\n  {text(name, 0)}: ")
            if isinstance(part, dict):
                f.write(text(part, 2))
                continue
            n = -1
            for n, entry in enumerate(part):
                f.write(("," if n else "[") + "\n    " + text(entry, 4))
            f.write("\n  ]" if n >= 0 else "[]")
        f.write("\n}\n")
    return parts["counts"]


def report_sizes(path: str) -> tuple[dict, dict[str, int]]:
    """The counts of a written report and the length of each of its lists, from one pass over its lines."""
    counts, sizes, name = [], {}, None
    with open(path, encoding="utf-8") as f:
        for line in f:
            if line.startswith('  "'):
                name, _, rest = line.strip().partition(": ")
                name = json.loads(name)
                sizes |= {name: 0} if rest.startswith("[") else {}
            elif line.startswith("    ") and name == "counts":
                counts.append(line)
            elif name in sizes and line[:4] == "    " and line[4] not in " }":
                sizes[name] += 1
    return json.loads("{" + "".join(counts) + "}"), sizes


def summary(document: dict) -> str:
    lines = ["counts: " + ", ".join(f"{k}={v}" for k, v in document["counts"].items())]
    lines += [f"WARNING {w}" for w in document["warnings"]]
    lines += [f"ERROR {e['id'] or '-'} ({e['source']}): {e['message']}" for e in document["errors"]]
    lines += [f"{b.upper()} {r['id']}: {r['reason']}" for b in ("unsupported", "eval_only", "pending", "skipped") for r in document[b]]
    lines += [f"GROUPED {p['a']} + {p['b']} ({p['similarity']})" for p in document["near_duplicates"]]
    return "\n".join(lines)


def prepare_files(spark: SparkSession, config: dict) -> tuple[Path, dict]:
    """Build and write; the path of the report and its counts. The report is always written; with errors the split files of
    the last clean run stay."""
    made = build(spark, config)
    out = Path(config["data"]["prepared_dir"])
    out.mkdir(parents=True, exist_ok=True)
    counts = write_report(made, str(out / "report.json"))
    if not counts["errors"]:
        hashes = prepared.write_splits(made.rows, str(out))
        settings = {k: config["data"][k] for k in SPLIT_KEYS}
        sources = [{"path": s.source, "sha256": s.sha256} for s in made.scan.files.orderBy("source").collect()]
        write_document(str(out / prepared.PROVENANCE), {"sources": sources, "split_config": settings, "split_sha256": hashes})
    return out / "report.json", counts


def prepare(spark: SparkSession, config: dict) -> dict:
    """`prepare_files`, with the report as a whole."""
    return json.loads(prepare_files(spark, config)[0].read_text(encoding="utf-8"))
