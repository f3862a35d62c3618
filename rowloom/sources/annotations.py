"""Scan of annotation files: one JSON object each, with record lists under known section names.

A file is one row of the `binaryFile` scan, so the digest is of exactly the bytes that are decoded. One pass turns a
file into its description, its problems and its records; records are typed columns, with what has no usable type as
`shape_problem`, so that all rules about labels are Columns (`labels.classified_records`).
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strictjson import Refused, decode
from ..operators.labels import SECTIONS, Catalog, classified
from ..operators.predict import query_errors
from ..session import Scratch, ship
from .files import Files

VERSIONS = ("1.0",)
LINK = "related_example_id"
UNRENDERED = ("appearance_state", "character_state")
MODES = {None: "player_action", "observed_event": "observed_event"}
_CHECK = "struct<kind: string, name: string, difficulty: string, roll_system: string>"
RECORD = (
    "source string, source_no int, section_no int, pos int, section string, id string, scenario_scope string, shape_problem string, "
    "unsupported string, raw_response string, roll_required boolean, roll_optional boolean, check_mode string, "
    f"checks array<{_CHECK}>, skip_reason_raw string, links array<string>, bad_links int, input_json string, similarity_text string"
)
_COLUMNS = [c.split()[0] for c in RECORD.replace(_CHECK, "x").split(", ")]
FILE = "source string, sha256 string, schema_version string, scenario_scope string, split string, skill_blob string, attribute_blob string"
PROBLEM = "source string, id string, message string"
_ALL = f"kind string, file struct<{FILE.replace(' string', ': string')}>, problem struct<{PROBLEM.replace(' string', ': string')}>, record string"


@dataclass(frozen=True)
class Scan:
    files: DataFrame
    records: DataFrame
    problems: DataFrame


def links_of(value) -> tuple[list[str], int]:
    """Every link at any depth in document order, and the number of those that are no text."""
    found, bad, todo = [], 0, [value]
    while todo:
        item = todo.pop()
        if isinstance(item, list):
            todo += reversed(item)
        elif isinstance(item, dict):
            inner = []
            for k, v in item.items():
                inner.append(("link", v) if k == LINK else v)
            todo += reversed(inner)
        elif isinstance(item, tuple):
            v = item[1]
            if isinstance(v, str) and v.strip():
                found.append(v)
            else:
                bad += 1
    return found, bad


def _typed(value, kind: type, name: str, problems: list[str]):
    """The value where it has the type or is missing; otherwise null, and a problem."""
    if value is None or type(value) is kind:
        return value
    problems.append(f"{name} must be a {kind.__name__}")
    return None


def _checks(value, problems: list[str]) -> list[dict] | None:
    if value is None:
        return None
    if not isinstance(value, list):
        problems.append("checks must be a list")
        return None
    out = []
    for c in value:
        if not isinstance(c, dict):
            problems.append("a check entry must be an object")
            continue
        out.append({k: v if isinstance(v := c.get(k), str) else None for k in ("kind", "name", "difficulty", "roll_system")})
    return out


def model_input(record: dict, lang: str) -> tuple[dict | None, str | None, str | None]:
    """(input, problem, unsupported): the model input in one language, or why there is none."""
    mode = record.get("input_mode")
    if mode is not None and not isinstance(mode, str):
        return None, "input_mode must be a string", None
    if mode not in MODES:
        return None, None, f"input_mode {mode}"
    action = MODES[mode]
    other = next(a for a in MODES.values() if a != action)
    if other in record:
        return None, f"{other} does not go with input_mode {mode}", None
    for extra in UNRENDERED:
        if record.get(extra) is not None:
            return None, None, f"carries {extra}"
    out = {}
    for key in ("scene", action):
        text = record[key].get(lang) if isinstance(record.get(key), dict) else None
        if not isinstance(text, str) or not text.strip():
            return None, f"missing {key}.{lang}", None
        out[key] = text.strip()
    if record.get("runtime_state") is not None:
        out["runtime_state"] = record["runtime_state"]
    problems = query_errors(out)
    return (None, "; ".join(problems), None) if problems else (out, None, None)


def all_languages(record: dict) -> str:
    """Scene and action in every language, in the order of fields and of language names."""
    spoken = (record.get(k) for k in ("scene", "player_action", "observed_event"))
    return " ".join(v for d in spoken if isinstance(d, dict) for _, v in sorted(d.items()) if isinstance(v, str))


def typed_record(record: dict, section: str, default_scope, lang: str) -> dict:
    """The columns of one record."""
    problems: list[str] = []
    note = record.get("annotation")
    if note is not None and not isinstance(note, dict):
        problems.append("annotation must be an object")
    note = note if isinstance(note, dict) else {}
    unsupported = None
    checks = _checks(note.get("checks"), problems)
    if section == "alternative_examples":
        if note.get("choice") != "one_of":
            problems.append("alternatives need choice one_of")
        if note.get("selected_alternative") is not None:
            unsupported = "selected_alternative is set"
        options = note.get("alternatives")
        parts = [_checks(o.get("checks"), problems) if isinstance(o, dict) else None for o in options] if isinstance(options, list) else []
        if not isinstance(options, list):
            problems.append("alternatives must be a list")
        elif any(p is None or len(p) != 1 for p in parts):
            problems.append("each alternative needs one check")
        checks = [c for p in parts for c in p or []]
    elif any(isinstance(c, dict) and c.get("name") is None and "skill_selector" in c for c in note.get("checks") or [] if isinstance(note.get("checks"), list)):
        unsupported = "skill selector"
    if note.get("optional_roll") is not None and note.get("roll_optional") is not True:
        problems.append("optional_roll without roll_optional")
    out = {
        "raw_response": v if isinstance(v := note.get("raw_response"), str) else None,
        "roll_required": _typed(note.get("roll_required"), bool, "roll_required", problems),
        "roll_optional": _typed(note.get("roll_optional"), bool, "roll_optional", problems),
        "check_mode": _typed(note.get("check_mode"), str, "check_mode", problems),
        "checks": checks,
        "skip_reason_raw": str(record["skip_reason_raw"]) if record.get("skip_reason_raw") else None,
        "scenario_scope": scope if isinstance(scope := record.get("scenario_scope", default_scope), str) else "no scope",
    }
    made, broken, other = model_input(record, lang)
    if section in ("examples", "alternative_examples"):
        problems += [broken] if broken else []
        unsupported = unsupported or other
    links, bad = links_of(record)
    return out | {
        "id": record["id"], "section": section, "links": links, "bad_links": bad, "shape_problem": problems[0] if problems else None, "unsupported": unsupported,
        "input_json": json.dumps(made, ensure_ascii=False) if made else None, "similarity_text": all_languages(record),
    }


def read_file(source: str, number: int, content: bytes, lang: str):
    """(kind, value) of everything in one file: its description, problems and records."""

    def problem(message: str, at: str = source, record_id: str | None = None):
        return "problem", {"source": at, "id": record_id, "message": message}

    try:
        data = decode(content.decode("utf-8"))
    except (Refused, UnicodeDecodeError) as e:
        yield problem(f"not valid JSON: {e}")
        return
    if not isinstance(data, dict):
        yield problem("the file must hold a JSON object")
        return
    text = lambda v: v if isinstance(v, str) else None
    blob = lambda k: text(data[k].get("blob_sha")) if isinstance(data.get(k), dict) else None
    yield "file", {
        "source": source, "sha256": hashlib.sha256(content).hexdigest(), "schema_version": text(data.get("schema_version")), "scenario_scope": text(data.get("scenario_scope")),
        "split": None if data.get("split") is None else str(data["split"]), "skill_blob": blob("skill_catalog"), "attribute_blob": blob("attribute_catalog"),
    }
    odd = [k for k in ("skill_catalog", "attribute_catalog") if data.get(k) is not None and not isinstance(data[k], dict)]
    if odd:
        yield problem(f"{', '.join(odd)} must be an object")
        return
    if data.get("schema_version") not in VERSIONS:
        yield problem("unsupported schema_version")
        return
    for name, value in data.items():
        listed = isinstance(value, list) and any(isinstance(v, dict) and "id" in v for v in value)
        if name not in SECTIONS and (listed or name.endswith("_examples")):
            yield problem(f"unknown section {name}")
    if not any(isinstance(data.get(s), list) and data[s] for s in SECTIONS):
        yield problem("no records")
    for section_no, section in enumerate(SECTIONS):
        records = data.get(section, [])
        if not isinstance(records, list):
            yield problem(f"section {section} must be a list")
            continue
        for pos, record in enumerate(records):
            at = f"{source}:{section}[{pos}]"
            rid = record.get("id") if isinstance(record, dict) else None
            if not isinstance(rid, str) or not rid.strip():
                yield problem("record has no id", at)
                continue
            made = typed_record(record, section, data.get("scenario_scope"), lang)
            if made["bad_links"]:
                yield problem("a link must be an id", at, rid)
            yield "record", made | {"source": source, "source_no": number, "section_no": section_no, "pos": pos}


def scan_annotations(spark: SparkSession, sources: list[str], lang: str = "en") -> Scan:
    """Files in the given order. A missing or unreadable file is a problem, not a failure."""
    ship(spark)
    scratch = Scratch(spark)
    at = {s: files.qualified(s) for s in sources if (files := Files(spark, s)).is_file(s)}
    there = {at[s]: (n, s) for n, s in enumerate(sources) if s in at}
    missing = [(s, None, "source file not found") for s in sources if s not in at]
    absent = spark.createDataFrame(missing, PROBLEM)
    if not there:
        return Scan(spark.createDataFrame([], FILE), spark.createDataFrame([], RECORD), absent)

    def run(batches):
        for b in batches:
            for path, content in zip(b["path"], b["content"]):
                number, source = there[path]
                out = [
                    (kind, v if kind == "file" else None, v if kind == "problem" else None, json.dumps([v.get(c) for c in _COLUMNS]) if kind == "record" else None)
                    for kind, v in read_file(source, number, bytes(content), lang)
                ]
                yield pd.DataFrame(out, columns=["kind", "file", "problem", "record"])

    content = spark.read.format("binaryFile").load(list(there)).select("path", "content")
    every = scratch.keep(content.mapInPandas(run, _ALL))

    def columns(batches):
        for b in batches:
            yield pd.DataFrame([json.loads(r) for r in b["record"]], columns=_COLUMNS)

    records = every.where("kind = 'record'").select("record").mapInPandas(columns, RECORD)
    problems = every.where("kind = 'problem'").select("problem.*").unionByName(absent)
    return Scan(every.where("kind = 'file'").select("file.*"), scratch.keep(records), problems)


def classified_records(records: DataFrame, catalog: Catalog) -> DataFrame:
    """(id, section, bucket, reason, at): every record in one bucket; a repeated id is an error of the later record."""
    order = F.struct("source_no", "section_no", "pos")
    first = records.groupBy("id").agg(F.min(order).alias("first"))
    at = F.concat("source", F.lit(":"), "section", F.lit("["), F.col("pos").cast("string"), F.lit("]"))
    base = records.join(first, "id").select("*", (order != F.col("first")).alias("again"), at.alias("at"))
    keyed = base.withColumn("rid", F.col("id")).withColumn("id", F.col("at"))
    outcome = classified(keyed, catalog).select(F.col("id").alias("at"), "section", "bucket", "reason")
    made = base.select("id", "at", "again", "shape_problem", "unsupported").join(outcome, "at")
    data = F.col("section").isin("examples", "alternative_examples")
    bucket = (
        F.when(F.col("again"), "errors")
        .when(data & F.col("shape_problem").isNotNull(), "errors")
        .when(data & F.col("unsupported").isNotNull() & (F.col("bucket") != "errors"), "unsupported")
        .otherwise(F.col("bucket"))
    )
    reason = (
        F.when(F.col("again"), "duplicate id")
        .when(data & F.col("shape_problem").isNotNull(), F.col("shape_problem"))
        .when(data & F.col("unsupported").isNotNull() & (F.col("bucket") != "errors"), F.col("unsupported"))
        .otherwise(F.col("reason"))
    )
    return made.select("id", "section", bucket.alias("bucket"), reason.alias("reason"), "at")


def rows_of(records: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The trainable and eval-only records as rows, with reference and target."""
    check = "array<struct<kind: string, name: string, difficulty: string>>"
    plain = F.transform("checks", lambda c: F.struct(c["kind"].alias("kind"), c["name"].alias("name"), c["difficulty"].alias("difficulty")))
    options = F.when(F.col("bucket") == "eval_only", F.transform(plain, lambda c: F.array(c))).otherwise(F.array(plain))
    reference = F.struct(F.col("roll_required").alias("roll_required"), options.alias("options"))
    target = F.when(F.col("bucket") == "trainable", F.struct(F.col("roll_required").alias("roll_required"), plain.cast(check).alias("checks")))
    at = F.concat("source", F.lit(":"), "section", F.lit("["), F.col("pos").cast("string"), F.lit("]"))
    kept = records.withColumn("at", at).join(outcomes.where(F.col("bucket").isin("trainable", "eval_only")).select("at", "bucket"), "at")
    return kept.select(
        "id", "source", "source_no", "section_no", "pos", "section", F.col("scenario_scope").alias("scope"), "input_json",
        reference.alias("reference"), target.alias("target"), "links", "similarity_text",
    )
