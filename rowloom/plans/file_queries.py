"""Queries over files: the tables of a scale directory are written out in the forms that projects keep them in, into the
shared folder, and scanned back; the SQL states over the tables what must come out. Registered with `queries.query`."""

from __future__ import annotations

import copy
import json
import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.duplicates import fingerprint
from ..session import Scratch
from ..sources import annotations, catalogs, prepared, runs
from ..sources.files import Files
from . import config, prepare
from .queries import _CLASSIFIED, _ONCE, _RECORD_COLUMNS, _RECORDS, _ROW_SQL, catalog, once, query, records, table

PER_FILE = 500


def written(spark: SparkSession, lines: DataFrame, scratch: Scratch) -> list[str]:
    """The paths of one text file for each row (text)."""
    at = scratch.folder() + "/files"
    parts = lines.select("text", F.monotonically_increasing_id().alias("file"))
    parts.repartition("file").write.partitionBy("file").option("lineSep", "\n").text(at)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(at)
    return sorted(r.path for r in found.select("path").collect())


def annotation_files(spark: SparkSession, folder: str, scratch: Scratch) -> list[str]:
    """Annotation files of at most about `PER_FILE` records of one source, with all records of the table."""
    spoken = once(spark, folder, "input_json").select("id", *(F.get_json_object("input_json", f"$.{k}").alias(k) for k in ("scene", "player_action", "observed_event")))
    given = records(spark, folder, *_RECORD_COLUMNS, "source", "related_example_id").join(spoken, "id", "left")
    observed = F.col("observed_event").isNotNull()
    said = lambda c, none: F.struct(F.coalesce(c, F.lit(none)).alias("en"))
    check = F.transform("checks", lambda c: F.struct(F.array(c).alias("checks")))
    alternative = F.col("section") == "alternative_examples"
    note = F.struct(
        "raw_response", "roll_required", "roll_optional", "check_mode", F.when(~alternative, F.col("checks")).alias("checks"),
        F.when(alternative, "one_of").alias("choice"), F.when(alternative, check).alias("alternatives"),
    )
    record = F.to_json(
        F.struct(
            "id", "scenario_scope", "related_example_id", "skip_reason_raw", said(F.col("scene"), "no scene").alias("scene"),
            F.when(observed, "observed_event").alias("input_mode"), F.when(~observed, said(F.col("player_action"), "no action")).alias("player_action"),
            F.when(observed, said(F.col("observed_event"), "")).alias("observed_event"), note.alias("annotation"),
        )
    )
    named = given.select(F.coalesce("source", F.lit("")).alias("origin"), F.coalesce("section", F.lit("no_section")).alias("section"), record.alias("record"), F.xxhash64("id").alias("h"))
    sized = named.groupBy("origin").agg(F.ceil(F.count("*") / PER_FILE).alias("files"))
    lists = named.join(sized, "origin").groupBy("origin", F.pmod("h", "files").alias("file"), "section").agg(F.array_join(F.sort_array(F.collect_list("record")), ",").alias("list"))
    sections = F.collect_list(F.concat(F.lit('"'), F.col("section"), F.lit('": ['), F.col("list"), F.lit("]")))
    files = lists.groupBy("origin", "file").agg(F.array_join(sections, ", ").alias("body"))
    head = F.concat(F.lit('{"schema_version": "1.0", "scenario_scope": "general", "split": "'), F.col("origin"), F.lit('", '))
    return written(spark, files.select(F.concat(head, F.col("body"), F.lit("}")).alias("text")), scratch)


def _scanned(spark, folder) -> tuple[annotations.Scan, DataFrame]:
    """A scan of all records, and (path, source): what each file says that it came from."""
    scratch = Scratch(spark)
    scan = annotations.scan_annotations(spark, annotation_files(spark, folder, scratch))
    return scan, scan.files.select(F.col("source").alias("path"), F.nullif("split", F.lit("")).alias("source"))


_KNOWN = "section IN ('examples', 'alternative_examples', 'pending_examples', 'skipped_examples', 'conditional_examples', 'parameterized_examples')"


@query(
    f"""WITH {_RECORDS} SELECT id, source, section, coalesce(scenario_scope, 'general') AS scope, raw_response, roll_required, check_mode,
  CASE WHEN section = 'alternative_examples' THEN coalesce(len(checks), 0) ELSE len(checks) END AS n_checks, related_example_id AS link FROM rec WHERE {_KNOWN}"""
)
def scanned_records(spark, folder):
    scan, origin = _scanned(spark, folder)
    made = scan.records.withColumnRenamed("source", "path").join(origin, "path")
    checks = F.when(F.col("checks").isNotNull(), F.size("checks")).cast("long")
    return made.select("id", "source", "section", F.col("scenario_scope").alias("scope"), "raw_response", "roll_required", "check_mode", checks.alias("n_checks"), F.get("links", F.lit(0)).alias("link"))


@query(
    f"""WITH {_CLASSIFIED} SELECT id, section, CASE WHEN alt AND checks IS NULL THEN 'errors' ELSE split_part(o, ':', 1) END AS bucket,
  CASE WHEN alt AND checks IS NULL THEN 'alternatives must be a list' ELSE substr(o, instr(o, ':') + 1) END AS reason FROM (SELECT n.checks, n.alt, cls.* FROM cls JOIN n USING (id)) WHERE {_KNOWN}"""
)
def scanned_buckets(spark, folder):
    scan, _ = _scanned(spark, folder)
    return annotations.classified_records(scan.records, catalog(spark, folder)).select("id", "section", "bucket", "reason")


_STRIP = "regexp_replace({}, '^[\\s\\p{{Z}}\\x1c-\\x1f\\x{{85}}]+|[\\s\\p{{Z}}\\x1c-\\x1f\\x{{85}}]+$', '', 'g')"
_SAID = "coalesce({}, '{}')"


@query(
    f"""WITH {_RECORDS}, {_ONCE}, j AS (SELECT rec.id, coalesce(input_json->>'$.scene', 'no scene') AS scene, input_json->>'$.observed_event' AS event,
    coalesce(input_json->>'$.player_action', 'no action') AS action FROM rec LEFT JOIN prow USING (id) WHERE rec.{_KNOWN})
  SELECT id, {_STRIP.format("scene")} AS scene, {_STRIP.format("coalesce(event, action)")} AS action, event IS NOT NULL AS observed,
    scene || ' ' || coalesce(event, action) AS similarity_text FROM j"""
)
def scanned_inputs(spark, folder):
    scan, _ = _scanned(spark, folder)
    get = lambda k: F.get_json_object("input_json", f"$.{k}")
    event = get("observed_event")
    return scan.records.select("id", get("scene").alias("scene"), F.coalesce(event, get("player_action")).alias("action"), event.isNotNull().alias("observed"), "similarity_text")


#: Annotation files that are refused, each with what is said of it; and one that says nothing wrong.
DAMAGED = {
    "[1]": "the file must hold a JSON object",
    '{"a": 1, "a": 2}': "not valid JSON: repeated key 'a'",
    '{"a": NaN}': "not valid JSON: NaN is no JSON",
    '{"a": 1e999}': "not valid JSON: number 1e999 is out of range",
    '{"a": ' + "[" * 300 + "]" * 300 + "}": "not valid JSON: more than 200 levels",
    '{"a": "\\ud800"}': "not valid JSON: an unpaired surrogate",
    '{"schema_version": "2.0", "examples": []}': "unsupported schema_version",
    '{"schema_version": "1.0"}': "no records",
    '{"schema_version": "1.0", "odd_examples": [], "skipped_examples": [{"id": "a"}]}': "unknown section odd_examples",
    '{"schema_version": "1.0", "skipped_examples": [{"id": "a"}], "examples": {}}': "section examples must be a list",
    '{"schema_version": "1.0", "skill_catalog": 3, "skipped_examples": [{"id": "a"}]}': "skill_catalog must be an object",
    '{"schema_version": "1.0", "skipped_examples": [{"id": " "}]}': "record has no id",
    '{"schema_version": "1.0", "skipped_examples": [{"id": "a", "x": [{"related_example_id": 4}]}]}': "a link must be an id",
    '{"schema_version": "1.0", "skipped_examples": [{"id": "a"}]}': None,
}


def _values(rows: list[tuple]) -> str:
    quoted = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"
    return "VALUES " + ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


@query(f"SELECT * FROM ({_values([(i, m) for i, m in enumerate([*DAMAGED.values(), 'source file not found']) if m])}) t(nth, message)")
def damaged_sources(spark, folder):
    scratch = Scratch(spark)
    paths = [written(spark, spark.createDataFrame([(text,)], "text string"), scratch)[0] for text in DAMAGED]
    names = paths + [paths[0] + ".missing"]
    found = annotations.scan_annotations(spark, names).problems
    nth = F.create_map(*(x for i, p in enumerate(names) for x in (F.lit(p), F.lit(i).cast("int"))))
    return found.select(nth[F.regexp_replace("source", r":\w+\[\d+\]$", "")].alias("nth"), "message")


def _split_files(spark, folder) -> str:
    """The folder of split files of all prepared rows that have a split, in the order of source, section and id."""
    at = Scratch(spark).folder()
    columns = ("source", "section", "scope", "split", "group_key", "lang", "similarity_text", "input_json", "reference", "target_decision", "links", "group_members")
    rows = once(spark, folder, *columns).withColumnsRenamed({"target_decision": "target"})
    prepared.write_splits(rows.withColumns({"source_no": F.col("source"), "section_no": F.col("section"), "pos": F.col("id")}), at)
    return at


_READ = f"""{_ONCE}, lab AS (SELECT id, unnest(flatten(reference.options)) AS c FROM prow),
  odd AS (SELECT DISTINCT id FROM lab WHERE NOT coalesce(c.difficulty IN ('success', 'hard', 'extreme') AND (c.kind = 'attribute' AND c.name IN (SELECT attribute_name FROM catalog_attributes)
    OR c.kind = 'skill' AND c.name IN (SELECT skill_name FROM catalog_skills WHERE trim(initial) <> '')), false)),
  r AS (SELECT id, split, group_key, NOT ({" OR ".join(f"coalesce({c}, false)" for c in _ROW_SQL.values())}) AND source IS NOT NULL AND section IS NOT NULL AND scope IS NOT NULL
    AND lang IS NOT NULL AND links IS NOT NULL AND id NOT IN (SELECT id FROM odd) AS ok FROM prow WHERE split IN ('train', 'val', 'test'))"""


@query(f"WITH {_READ} SELECT id, split, group_key FROM r WHERE ok")
def read_rows(spark, folder):
    at, known = _split_files(spark, folder), catalog(spark, folder)
    first, *more = (prepared.read_split(spark, at, s, known)[0].select("id", "split", "group_key") for s in prepared.SPLITS)
    return first.unionByName(more[0]).unionByName(more[1])


@query(f"WITH {_READ} SELECT split, count(*) AS n_lines, count(*) FILTER (WHERE NOT ok) AS n_refused, true AS same_bytes FROM r GROUP BY split")
def read_problems(spark, folder):
    at, known = _split_files(spark, folder), catalog(spark, folder)
    hashes, out = prepared.split_hashes(spark, at), []
    for s in prepared.SPLITS:
        rows, problems, digest = prepared.read_split(spark, at, s, known)
        refused = problems.count()
        out.append((s, rows.count() + refused, refused, digest == hashes[s]))
    return spark.createDataFrame([r for r in out if r[1]], "split string, n_lines long, n_refused long, same_bytes boolean")


@query(f"WITH {_ONCE} SELECT id, split FROM prow WHERE split IN ('train', 'val', 'test')")
def previous_rows(spark, folder):
    return prepared.previous_splits(spark, _split_files(spark, folder))[0]


@query(
    f"""WITH {_ONCE}, tr AS (SELECT * FROM prow WHERE split = 'train') SELECT 'trained' AS list, id AS value FROM tr UNION SELECT 'seen', id FROM tr
  UNION SELECT 'seen', unnest(links) FROM tr UNION SELECT 'seen', m FROM (SELECT unnest(group_members) AS m FROM tr) WHERE m IS NOT NULL
  UNION SELECT 'text', similarity_text FROM tr"""
)
def recorded_history(spark, folder):
    """A manifest of the train split, written and read back."""
    at = Scratch(spark).folder().removeprefix("file:")
    rows = once(spark, folder, "split", "links", "group_members", "similarity_text", "input_json")
    named = rows.select("id", "split", F.coalesce("links", F.array()).alias("links"), "group_members", F.col("similarity_text").alias("text"), fingerprint(F.col("input_json")).alias("fingerprint"))
    document = copy.deepcopy(_MANIFEST)
    for name in ("train_ids", "val_ids", "train_fingerprints", "train_texts", "train_scenario_ids", "train_links"):
        del document["examples"][name]
    runs.write_manifest(at, document, runs.training_lists(named))
    then = runs.history(spark, at)
    of = lambda name, df: df.select(F.lit(name).alias("list"), F.col(df.columns[0]).alias("value"))
    return of("trained", then["ids"]).union(of("seen", then["seen"])).union(of("text", then["texts"]))


_MANIFEST = {
    "precision": "fp32", "adapter": "lora", "catalog_sha256": "0" * 64, "model_files": {"weights": "0" * 64}, "global_steps": 1, "metrics": {}, "config": config.merged({}),
    "prompt": {"format_version": "1", "system_prompt": "p", "system_prompt_sha256": runs.text_sha256("p"), "language": "en"},
    "base_model": {"name_or_path": "base", "revision": None, "resolved_commit": None, "local_sha256": None, "in_run": None, "trust_remote_code": False},
    "examples": {"train_ids": [], "val_ids": [], "train_fingerprints": [], "train_texts": [], "train_scenario_ids": [], "split_sha256": {}, "train_links": {}, "source_files": []},
}
#: Places of a manifest, a value put there, and what is said of it.
_SPOILED = [
    ("metrics", {"loss": 1.0}, None), ("precision", "auto", "precision has a value of none of ['bf16', 'fp16', 'fp32']"), ("adapter", "full", "adapter has a value of none of ['None', 'lora']"),
    ("adapter", None, None), ("global_steps", True, "global_steps has the wrong type"), ("model_files", {"a": 1}, "model_files has the wrong type"), ("prompt", [], "prompt is no object"),
    ("prompt.format_version", 1, "prompt.format_version has the wrong type"), ("base_model.revision", 3, "base_model.revision has the wrong type"), ("base_model.in_run", "x", None),
    ("base_model.trust_remote_code", None, "base_model.trust_remote_code has the wrong type"), ("examples.train_ids", [1], "examples.train_ids has the wrong type"),
    ("examples.train_links", {"a": ["b"]}, None), ("examples.train_links", {"a": "b"}, "examples.train_links has the wrong type"),
    ("examples.source_files", [{"path": "x"}], "examples.source_files[0].sha256 is missing"), ("config.data.val_fraction", 2, "config data.val_fraction: must be in [0, 1], got 2.0"),
    ("config.train.max_steps", 0, "config train.max_steps: must be in (0, inf] or -1, got 0"), ("config", {"seed": 1}, "config lacks ['data', 'inference', 'lora', 'model', 'run_name', 'smoke', 'train']"),
]


@query(f"SELECT * FROM ({_values([(i, p, m) for i, (p, _, m) in enumerate(_SPOILED)])}) t(nth, place, problem)")
def manifest_problems(spark, folder):
    out = []
    for i, (place, value, _) in enumerate(_SPOILED):
        document = copy.deepcopy(_MANIFEST)
        at, *parts = document, *place.split(".")
        for p in parts[:-1]:
            at = at[p]
        at[parts[-1]] = value
        out.append((i, place, runs.document_problem(document, runs.MANIFEST)))
    return spark.createDataFrame(out, "nth int, place string, problem string")


#: Settings and what is said of them.
_SETTINGS = [
    ({}, None), ({"data": {"val_fraction": 1, "near_duplicate_threshold": None}}, None), ({"lora": {"target_modules": ["a", "b"]}}, None), ({"train": {"max_steps": -1}}, None),
    ({"x": 1}, "config x: unknown"), ({"data": 3}, "config data: must be a mapping"), ({"seed": -1}, "config seed: must be in [0, 4294967295], got -1"), ({"seed": True}, "config seed: must be a int, got True"),
    ({"data": {"sources": []}}, "config data.sources: must not be empty, got []"), ({"data": {"language": " "}}, "config data.language: must not be blank, got ' '"),
    ({"data": {"extra_groups": [["a"]]}}, "config data.extra_groups: holds an entry of another form, got [['a']]"), ({"train": {"warmup_ratio": 1.0}}, "config train.warmup_ratio: must be in [0, 1), got 1.0"),
    ({"lora": {"r": 0}}, "config lora.r: must be in (0, inf], got 0"), ({"inference": {"batch_size": 0}}, "config inference.batch_size: must be in (0, inf], got 0"), ({"model": {"revision": ""}}, "config model.revision: must not be blank, got ''"),
]


@query(f"SELECT * FROM ({_values([(json.dumps(s), m) for s, m in _SETTINGS])}) t(settings, problem)")
def config_problems(spark, folder):
    def problem(given: dict) -> str | None:
        try:
            config.merged(given)
        except ValueError as e:
            return str(e)
        return None

    return spark.createDataFrame([(json.dumps(s), problem(s)) for s, _ in _SETTINGS], "settings string, problem string")


def _catalog_document(spark, folder) -> dict:
    skills = table(spark, folder, "catalog_skills").orderBy("skill_name").collect()
    attributes = table(spark, folder, "catalog_attributes").orderBy("ord").collect()
    return {
        "source": {k: {"path": k, "blob_sha": "0"} for k in ("skill_catalog", "attribute_catalog")},
        "kinds": ["skill", "attribute"],
        "difficulties": ["success", "hard", "extreme"],
        "attributes": [r.attribute_name for r in attributes],
        "skills": [{"name": r.skill_name, "category": r.category, "subcategory": r.subcategory, "initial": r.initial} for r in skills],
    }


@query("SELECT skill_name, category, subcategory, initial FROM catalog_skills UNION ALL SELECT attribute_name, NULL, NULL, ord::VARCHAR FROM catalog_attributes")
def catalog_file(spark, folder):
    """The catalogue, written as a file, decoded and made tables again."""
    at = written(spark, spark.createDataFrame([(json.dumps(_catalog_document(spark, folder)),)], "text string"), Scratch(spark))[0]
    content = spark.read.format("binaryFile").load(at).first().content
    skills, attributes = catalogs.tables(spark, catalogs.parse_catalog(bytes(content)))
    return skills.unionByName(attributes.select(F.col("attribute_name").alias("skill_name"), F.col("ord").cast("string").alias("initial")), allowMissingColumns=True)


@query("SELECT skill_name AS name, category, subcategory, initial, true AS complete FROM catalog_skills")
def skill_source(spark, folder):
    """The skills as rows of a source text, found there by their form."""
    row = F.format_string('{"name": "%s", "category": "%s", "subcategory": "%s", "initial": "%s"}', "skill_name", F.coalesce("category", F.lit("")), F.coalesce("subcategory", F.lit("")), F.coalesce("initial", F.lit("")))
    text = table(spark, folder, "catalog_skills").select(F.lit("source").alias("path"), row.alias("row")).groupBy("path").agg(F.array_join(F.collect_list("row"), ",\n").alias("text"))
    return catalogs.skills_in(text).drop("path")


@query("SELECT attribute_name FROM catalog_attributes")
def attribute_source(spark, folder):
    """The attributes as a constant of a Python source, read without running it."""
    names = _catalog_document(spark, folder)["attributes"]
    text = f"import nothing_there\nOTHER = open\nATTRIBUTES: tuple[str, ...] = {tuple(names)!r}\n\n\ndef f():\n    ATTRIBUTES = ()\n"
    return spark.createDataFrame([(n,) for n in catalogs.named_constant(text, "ATTRIBUTES")], "attribute_name string")


@query(f"WITH {_ONCE} SELECT id, input_json->>'$.scene' AS scene, true AS listed FROM prow")
def queries_file(spark, folder):
    """All inputs as one list of queries in a file, read as `predict` reads it; the driver streams the file."""
    scratch = Scratch(spark)
    placed = scratch.keep(once(spark, folder, "input_json").orderBy("id").withColumn("place", F.monotonically_increasing_id()))
    part, before, offsets = F.shiftright("place", 33), 0, {}
    for r in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):
        offsets[r.part], before = before, before + r.n
    after = F.create_map(*(x for k, v in offsets.items() for x in (F.lit(k), F.lit(v)))) if offsets else F.create_map().cast("map<bigint,int>")
    numbered = placed.withColumn("nth", F.col("place").bitwiseAND((1 << 33) - 1) + after[part])
    lines = numbered.select("place", F.concat(F.when(F.col("nth") > 0, ", ").otherwise(""), F.coalesce("input_json", F.lit("null"))).alias("line"))
    ends = spark.createDataFrame([(-1, "["), ((1 << 63) - 1, "]")], "place long, line string")
    at = scratch.folder()
    lines.unionByName(ends).orderBy("place").select("line").write.text(f"{at}/parts", lineSep="\n")
    Files(spark, at).joined(f"{at}/parts", f"{at}/queries.json")
    found, listed = runs.stored_queries(spark, f"{at}/queries.json".removeprefix("file:"), scratch)
    if found.count() != before:
        raise ValueError(f"the file holds {found.count()} queries of {before}")
    return numbered.select("id", "nth").join(found, "nth").select("id", F.get_json_object("query", "$.scene").alias("scene"), F.lit(listed).alias("listed"))


@query("SELECT arg_min(value, event_id) AS first_loss, arg_max(value, event_id) AS last_loss, count(*) AS n FROM events WHERE value IS NOT NULL")
def training_losses(spark, folder):
    """The events as a training log in JSON lines, with lines of another kind among them."""
    at = Scratch(spark).folder() + "/log"
    events = table(spark, folder, "events").select(F.col("event_id").alias("step"), F.col("value").alias("loss"))
    events.unionByName(events.select("step", F.lit(None).cast("double").alias("loss"))).write.json(at)
    log = runs.training_log(spark, at)
    return runs.losses(log).crossJoin(log.agg(F.count("*").alias("n")))


_COUNTED = f"""{_CLASSIFIED}, seen AS (SELECT CASE WHEN alt AND checks IS NULL THEN 'errors' ELSE split_part(o, ':', 1) END AS bucket FROM (SELECT n.checks, n.alt, cls.* FROM cls JOIN n USING (id)) WHERE {_KNOWN})"""


@query(f"WITH {_COUNTED} SELECT bucket, count(*) AS n FROM seen WHERE bucket <> 'errors' GROUP BY bucket")
def prepared_report(spark, folder):
    """`prepare` over annotation files: the counts of the report that it writes."""
    at = Scratch(spark)
    out = at.folder().removeprefix("file:")
    catalogs.write_catalog(_catalog_document(spark, folder), f"{out}/catalog.json")
    data = {"sources": annotation_files(spark, folder, at), "catalog": f"{out}/catalog.json", "prepared_dir": f"{out}/prepared", "near_duplicate_threshold": None}
    path, _ = prepare.prepare_files(spark, config.merged({"data": data}))
    known, sizes = prepare.report_sizes(str(path))
    counts = {b: n for b, n in known.items() if b in ("trainable", "eval_only", "pending", "skipped", "unsupported") and n}
    listed = {b: sizes[b] for b in counts if b in sizes}
    return spark.createDataFrame([(b, n if listed.get(b, n) == n else -1) for b, n in counts.items()], "bucket string, n long")


#: Ways to name a file of an output or an input, and whether the guards see that it is one.
_GUARDS = [
    ("same path", True), ("other spelling", True), ("symbolic link", True), ("hard link", True), ("link to the folder", True), ("another file", False), ("a file in the folder", True), ("the folder", True), ("beside the folder", False), ("run folders differ", True),
]


@query(f"SELECT name, seen = 1 AS seen FROM ({_values([(n, int(s)) for n, s in _GUARDS])}) t(name, seen)")
def output_guards(spark, folder):
    at = Path(tempfile.mkdtemp(prefix="rowloom-guards-"))
    try:
        (at / "in").mkdir()
        (at / "in" / "a").write_text("x")
        (at / "soft").symlink_to(at / "in" / "a")
        os.link(at / "in" / "a", at / "hard")
        (at / "way").symlink_to(at / "in")
        (at / "in2").write_text("x")
        given = [str(at / "in" / "a")]
        one = lambda p: bool(prepared.overwritten([str(p)], given))
        within = lambda p: bool(prepared.inside([str(p)], [str(at / "in")]))
        seen = [one(at / "in" / "a"), one(f"{at}/in/../in/./a"), one(at / "soft"), one(at / "hard"), one(at / "way" / "a"), one(at / "in2"), within(at / "way" / "new" / "b"), within(at / "in"), within(at / "in2")]
        seen.append(prepared.run_folder(str(at), "run") != prepared.run_folder(str(at), "run"))
    finally:
        shutil.rmtree(at)
    return spark.createDataFrame([(n, s) for (n, _), s in zip(_GUARDS, seen, strict=True)], "name string, seen boolean")
