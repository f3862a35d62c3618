"""Prepared split files (JSON lines): writing in order, strict and lenient reading, digests, and the guards of outputs."""

from __future__ import annotations

import json
import secrets
import time
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strictjson import Refused, decode
from ..operators.labels import Catalog
from ..operators.predict import parse_reply, query_errors
from .files import Files

SPLITS = ("train", "val", "test")
TEXTS = ("id", "source", "section", "scope", "split", "group", "lang", "similarity_text")
FIELDS = dict.fromkeys(TEXTS, str) | {"input": dict, "reference": dict, "links": list, "group_members": list}
PROVENANCE = "splits_provenance.json"
OUTPUTS = (*(f"{s}.jsonl" for s in SPLITS), "report.json", PROVENANCE)


def json_lines(rows: DataFrame) -> DataFrame:
    """(split, source_no, section_no, pos, line): rows as JSON objects with fields in fixed order; nulls are written."""
    head = F.struct("id", "source", "section", "scope", "split", F.col("group_key").alias("group"), "lang")
    tail = F.struct("reference", F.col("target").alias("target"), "similarity_text", "links", "group_members")
    keep = {"ignoreNullFields": "false"}
    a, b = F.to_json(head, keep), F.to_json(tail, keep)
    inner = lambda c: F.substring(c, F.lit(2), F.length(c) - F.lit(2))
    line = F.concat(F.lit("{"), inner(a), F.lit(',"input":'), F.col("input_json"), F.lit(","), inner(b), F.lit("}"))
    return rows.select("split", "source_no", "section_no", "pos", line.alias("line"))


def write_splits(rows: DataFrame, folder: str) -> dict[str, str]:
    """One file per split in source order; returns the SHA-256 of the bytes written. Tasks write the parts in order into the
    folder itself, which all of them share, a stream joins them, and the files are promoted together at the end."""
    files = Files(rows.sparkSession, folder)
    staged = f"{folder}/.staged-{secrets.token_hex(4)}"
    lines = json_lines(rows)
    hashes = {}
    for split in SPLITS:
        one = lines.where(F.col("split") == split).orderBy("source_no", "section_no", "pos").select("line")
        one.write.text(f"{staged}/{split}", lineSep="\n")
        hashes[split] = files.joined(f"{staged}/{split}", f"{staged}/{split}.jsonl")
    for split in SPLITS:
        files.move(f"{staged}/{split}.jsonl", f"{folder}/{split}.jsonl")
    files.delete(staged)
    return hashes


def split_hashes(spark: SparkSession, folder: str) -> dict[str, str | None]:
    """SHA-256 of each split file as it is now; None for a missing one."""
    files = Files(spark, folder)
    return {s: files.sha256(f"{folder}/{s}.jsonl") for s in SPLITS}


def row_problem(row, split: str, catalog: Catalog | None = None) -> str | None:
    """Why a decoded line is no row of this split's file; None if it is one."""
    if not isinstance(row, dict):
        return "no object"
    if missing := [k for k in (*FIELDS, "target") if k not in row]:
        return f"missing {missing}"
    if wrong := [k for k, t in FIELDS.items() if not isinstance(row[k], t)]:
        return f"wrong type of {wrong}"
    if row["target"] is not None and not isinstance(row["target"], dict):
        return "wrong type of ['target']"
    is_id = lambda v: isinstance(v, str) and bool(v.strip())
    checks = [
        (not is_id(row["id"]), "id is blank"),
        (row["split"] != split, "split differs from the file's"),
        ((row["scope"] == "game_specific") != (split == "test"), "scope differs from the file's"),
        (not all(map(is_id, row["links"] + row["group_members"])), "links and group_members must hold ids"),
        (not is_id(row["group"]), "group is blank"),
        (not {row["id"], row["group"]} <= {m for m in row["group_members"] if isinstance(m, str)}, "group_members must hold the row and its group"),
        (not row["similarity_text"].strip(), "similarity_text is blank"),
    ]
    for bad, why in checks:
        if bad:
            return why
    if errors := query_errors(row["input"]):
        return "input: " + "; ".join(errors)
    return reference_problem(row["reference"], catalog)


def reference_problem(reference: dict, catalog: Catalog | None = None) -> str | None:
    rolls, options = reference.get("roll_required"), reference.get("options")
    if not isinstance(rolls, bool):
        return "reference.roll_required must be true or false"
    if not isinstance(options, list) or not all(isinstance(o, list) for o in options):
        return "reference.options must be a list of lists"
    for check in (c for o in options for c in o):
        if not isinstance(check, dict) or set(check) != {"kind", "name", "difficulty"} or not all(isinstance(v, str) for v in check.values()):
            return "a reference check has exactly kind, name and difficulty, as texts"
        if catalog and parse_reply(json.dumps({"roll_required": True, "checks": [check]}), catalog)[0] is None:
            return f"reference label {check} is not in the catalogue"
    if rolls and (not options or any(len(o) != 1 for o in options)):
        return "a reference with a roll needs options of one check"
    if not rolls and any(options):
        return "a reference without a roll holds checks"
    return None


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) of the lines of a text file, from 1. The file is read in as many blocks as Spark cuts it into; a line's
    number is its place in its block after the lines of the blocks before, of which the driver learns the counts alone."""
    text = spark.read.text(path, lineSep="\n").select("value", F.col("_metadata.file_block_start").alias("block"))

    def run(batches):
        block, n = None, 0
        for b in batches:
            at = []
            for own in b["block"]:
                block, n = (block, n + 1) if own == block else (own, 1)
                at.append(n)
            yield pd.DataFrame({"block": b["block"], "n": at, "value": b["value"], "utf8": b["utf8"]})

    # A value that is not UTF-8 cannot leave the JVM.
    utf8 = F.is_valid_utf8("value")
    read = text.select("block", F.when(utf8, F.col("value")).alias("value"), utf8.alias("utf8"))
    each = read.mapInPandas(run, "block long, n long, value string, utf8 boolean")
    before, offsets = 0, {}
    for r in sorted(each.groupBy("block").agg(F.max("n").alias("n")).collect()):
        offsets[r.block], before = before, before + r.n
    if not offsets:
        return each.select(F.col("n").alias("line"), "value", "utf8")
    after = F.create_map(*(x for k, v in offsets.items() for x in (F.lit(k), F.lit(v))))
    return each.select((F.col("n") + after[F.col("block")]).alias("line"), "value", "utf8")


def read_split(spark: SparkSession, folder: str, split: str, catalog: Catalog | None = None) -> tuple[DataFrame, DataFrame, str]:
    """(rows, problems, sha256) of one split file: rows (id, split, group_key, row_json) and problems (line, problem).

    A repeated id is a problem of the later line.
    """
    path, files = f"{folder}/{split}.jsonl", Files(spark, folder)
    if not files.exists(path):
        raise FileNotFoundError(f"{path}: prepare the splits first")

    def run(batches):
        for b in batches:
            out = []
            for n, line, utf8 in zip(b["line"], b["value"], b["utf8"]):
                if utf8 and not line.strip():
                    continue
                try:
                    row = decode(line) if utf8 else None
                    why = row_problem(row, split, catalog) if utf8 else "not UTF-8"
                except Refused as e:
                    row, why = None, str(e)
                out.append((n, row["id"] if not why else None, row["group"] if not why else None, line, why))
            yield pd.DataFrame(out, columns=["line", "id", "group_key", "row_json", "problem"])

    every = numbered_lines(spark, path).mapInPandas(run, "line long, id string, group_key string, row_json string, problem string")
    first = every.where("problem IS NULL").groupBy("id").agg(F.min("line").alias("first"))
    marked = every.join(first, "id", "left").withColumn("problem", F.when(F.col("line") > F.col("first"), "duplicate id").otherwise(F.col("problem")))
    rows = marked.where("problem IS NULL").select("id", F.lit(split).alias("split"), "group_key", "row_json")
    return rows, marked.where("problem IS NOT NULL").select("line", "problem"), files.sha256(path)


def previous_splits(spark: SparkSession, folder: str) -> tuple[DataFrame, dict[str, int]]:
    """(id, split) of the files of an earlier run, and per file the number of lines that cannot be read, which are skipped."""
    parts, unreadable, files = spark.createDataFrame([], "id string, split string"), {}, Files(spark, folder)
    for split in SPLITS:
        path = f"{folder}/{split}.jsonl"
        if files.exists(path):
            lines = spark.read.text(path, lineSep="\n").where("trim(value) <> ''").select(F.get_json_object("value", "$.id").alias("id"))
            unreadable[split] = lines.where("id IS NULL").count()
            parts = parts.unionByName(lines.where("id IS NOT NULL").withColumn("split", F.lit(split)))
    return parts, {s: n for s, n in unreadable.items() if n}


def overwritten(outputs: list[str], inputs: list[str]) -> list[str]:
    """Inputs that are one file with an output, however spelled or linked."""

    def same(a: Path, b: Path) -> bool:
        return a.resolve() == b.resolve() or a.exists() and b.exists() and a.samefile(b)

    return sorted({i for i in inputs for o in outputs if same(Path(i), Path(o))})


def inside(paths: list[str], folders: list[str]) -> list[str]:
    """Paths that lie in one of the folders."""
    return sorted({p for p in paths for f in folders if Path(f).resolve() in (Path(p).resolve(), *Path(p).resolve().parents)})


def run_folder(parent: str, prefix: str) -> Path:
    """A new folder with a time stamp and a random suffix; an existing one is never reused."""
    path = Path(parent, f"{prefix}-{time.strftime('%Y%m%d-%H%M%S')}-{secrets.token_hex(3)}")
    path.mkdir(parents=True, exist_ok=False)
    return path
