"""The general operators over the tables of a scale directory, each beside the SQL that states the same.

The tables deliver some rows twice; `once` keeps one of each id, as the copies differ in their delivery time alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import strictjson, text
from ..operators import components, duplicates, labels, leakage, messages, predict, revision, scoring, similarity, splits
from ..operators.rules import Rules
from ..session import Scratch, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
NEAR, CROSS, VAL_SHARE = 0.9, 0.8, 0.2


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{folder}/{name}.parquet")


def once(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "prepared_rows").select("id", *columns).where("id IS NOT NULL").dropDuplicates(["id"])


def records(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "annotations").select("id", *columns).where("id IS NOT NULL").dropDuplicates(["id"])


def catalog(spark: SparkSession, folder: str) -> labels.Catalog:
    return labels.Catalog.of(table(spark, folder, "catalog_skills"), table(spark, folder, "catalog_attributes"))


def row_text() -> Column:
    """similarity_text, or where it is null or empty the texts of the input."""
    spoken = (F.get_json_object("input_json", f"$.{k}") for k in ("scene", "player_action", "observed_event"))
    return F.coalesce(F.nullif("similarity_text", F.lit("")), F.concat_ws(" ", *spoken))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "prepared_rows").where("id IS NOT NULL").select("id", row_text().alias("text"))
    return given.dropDuplicates(["id"])  # the text alone is shuffled


_ONCE = """prow AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY prepared_at) AS rn
  FROM prepared_rows WHERE id IS NOT NULL) WHERE rn = 1)"""
_RECORDS = """rec AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY loaded_at) AS rn
  FROM annotations WHERE id IS NOT NULL) WHERE rn = 1)"""
_TEXTS = (
    _ONCE
    + """, txt AS (SELECT id, split, coalesce(nullif(similarity_text, ''), concat_ws(' ', input_json->>'$.scene', input_json->>'$.player_action',
  input_json->>'$.observed_event')) AS text FROM prow)"""
)
_COUNTS = ", tc AS (SELECT id, token, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+|[一-鿿]')) AS token FROM txt) GROUP BY ALL)"
_VECTORS = """, dfs AS (SELECT token, count(*) AS df FROM tc GROUP BY token),
  w AS (SELECT id, token, tf * (ln((1 + (SELECT count(*) FROM txt))::DOUBLE / (1 + df)) + 1) AS w FROM tc JOIN dfs USING (token)),
  nrm AS (SELECT id, count(*) AS n_terms, sqrt(sum(w * w)) AS norm FROM w GROUP BY id),
  v AS (SELECT id, token, w / norm AS w FROM w JOIN nrm USING (id))"""


@query(
    f"""WITH {_ONCE} SELECT id, CASE WHEN ('0x' || substr(sha256('0:' || coalesce(group_key, id)), 1, 8))::BIGINT / 4294967295.0 < 0.2
  THEN 'val' ELSE 'train' END AS split FROM prow"""
)
def hash_split(spark, folder):
    key = F.coalesce("group_key", "id")
    return once(spark, folder, "group_key").select("id", F.when(text.in_share(key, 0, VAL_SHARE), "val").otherwise("train").alias("split"))


@query(f"WITH {_TEXTS}{_COUNTS} SELECT id, token, tf FROM tc")
def token_counts(spark, folder):
    return similarity.term_counts(texts(spark, folder))


@query(f"WITH {_TEXTS}{_COUNTS}{_VECTORS} SELECT token, df, round(ln((1 + (SELECT count(*) FROM txt))::DOUBLE / (1 + df)) + 1, 6) AS idf FROM dfs")
def term_stats(spark, folder):
    given = texts(spark, folder)
    df = similarity.document_frequencies(similarity.term_counts(given))
    return df.select("token", "df", F.round(similarity.inverse_frequency(F.col("df"), given.count()), 6).alias("idf"))


@query(f"WITH {_TEXTS}{_COUNTS}{_VECTORS} SELECT id, n_terms, round(norm, 6) AS norm FROM nrm")
def tfidf_norms(spark, folder):
    made = similarity.vectors(texts(spark, folder), Scratch(spark))
    return made.select("id", F.size("terms").cast("long").alias("n_terms"), F.round("norm", 6).alias("norm"))


@query(
    f"""WITH {_TEXTS}{_COUNTS}{_VECTORS}, s AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS s FROM v a JOIN v b ON a.token = b.token AND a.id < b.id
  GROUP BY ALL HAVING s >= {NEAR}) SELECT a, b, round(least(s, 1.0), 3) AS similarity FROM s"""
)
def similar_pairs(spark, folder):
    return similarity.similar_pairs(texts(spark, folder), NEAR)


#: The threshold that grouping uses by default.
GROUPED = 0.38


@query(
    f"""WITH {_TEXTS}{_COUNTS}{_VECTORS}, s AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS s FROM v a JOIN v b ON a.token = b.token AND a.id < b.id
  GROUP BY ALL HAVING s >= {GROUPED}) SELECT a, b, round(least(s, 1.0), 3) AS similarity FROM s"""
)
def similar_pairs_038(spark, folder):
    return similarity.similar_pairs(texts(spark, folder), GROUPED)


@query(
    f"""WITH {_TEXTS}{_COUNTS}{_VECTORS}, s AS (SELECT a.id AS a, b.id AS b FROM v a JOIN v b ON a.token = b.token AND a.id <> b.id GROUP BY ALL HAVING sum(a.w * b.w) >= {NEAR})
  SELECT nrm.id, count(b) AS n_links FROM nrm LEFT JOIN s ON s.a = nrm.id GROUP BY ALL"""
)
def similar_members(spark, folder):
    return similarity.similar_members(*similarity.similar_classes(texts(spark, folder), NEAR)).drop("class_id")


@query(
    f"""WITH {_ONCE}, txt AS (SELECT id, CASE WHEN split = 'train' THEN 1 ELSE 2 END AS side, coalesce(nullif(similarity_text, ''),
  concat_ws(' ', input_json->>'$.scene', input_json->>'$.player_action', input_json->>'$.observed_event')) AS text FROM prow WHERE split IS NOT NULL)
  {_COUNTS}{_VECTORS}, s AS (SELECT a.id AS a, b.id AS b, sum(a.w * b.w) AS s FROM v a JOIN v b ON a.token = b.token AND a.id < b.id
  GROUP BY ALL HAVING s >= {CROSS}) SELECT a, b, round(least(s, 1.0), 3) AS similarity FROM s JOIN txt x ON x.id = a JOIN txt y ON y.id = b WHERE x.side <> y.side"""
)
def cross_similar(spark, folder):
    rows = table(spark, folder, "prepared_rows").where("id IS NOT NULL AND split IS NOT NULL")
    side = F.when(F.col("split") == "train", 1).otherwise(2)
    given = rows.select("id", row_text().alias("text"), side.alias("side")).dropDuplicates(["id"])
    return similarity.similar_pairs(given, CROSS, sides=True)


@query("SELECT id AS value, count(*) AS n FROM annotations WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark, folder):
    return duplicates.repeated(table(spark, folder, "annotations"), "id")


@query("SELECT skill_name AS value, count(*) AS n FROM (SELECT skill_name FROM catalog_skills UNION ALL SELECT attribute_name FROM catalog_attributes) GROUP BY ALL HAVING count(*) > 1")
def repeated_names(spark, folder):
    names = table(spark, folder, "catalog_skills").select("skill_name").union(table(spark, folder, "catalog_attributes").select("attribute_name"))
    return duplicates.repeated(names, "skill_name")


def _dumped(value: str, deep: int, ordered: bool) -> str:
    """SQL for JSON with a blank after commas and colons, of objects in objects down to a depth, keys in order or as they are."""
    if not deep:
        return f"{value}::VARCHAR"
    k = f"k{deep}"
    at, keys = f"json_extract({value}, '$.\"' || {k} || '\"')", f"json_keys({value})"
    inner = f"""'{{' || array_to_string(list_transform({f"list_sort({keys})" if ordered else keys}, lambda {k}: '"' || {k} || '": ' || {_dumped(at, deep - 1, ordered)}), ', ') || '}}'"""
    return f"CASE json_type({value}) WHEN 'OBJECT' THEN {inner} ELSE {value}::VARCHAR END"


_KEY = f"lower(trim(regexp_replace({_dumped('input_json::JSON', 3, True)}, '[\\s\\p{{Z}}\\x1c-\\x1f\\x{{85}}]+', ' ', 'g')))"


@query(
    f"""WITH keyed AS (SELECT DISTINCT id, {_KEY} AS k FROM prepared_rows WHERE id IS NOT NULL)
  SELECT string_agg(id, ',' ORDER BY id) AS ids, count(*) AS n FROM keyed GROUP BY k HAVING count(*) > 1"""
)
def duplicate_inputs(spark, folder):
    found = duplicates.duplicate_inputs(table(spark, folder, "prepared_rows"))
    return found.select(F.array_join("ids", ",").alias("ids"), "n")


@query(f"WITH {_ONCE} SELECT id, sha256({_KEY}) AS fingerprint FROM prow")
def fingerprints(spark, folder):
    return once(spark, folder, "input_json").select("id", duplicates.fingerprint(F.col("input_json")).alias("fingerprint"))


@query(f"WITH {_ONCE} SELECT id, min(id) OVER (PARTITION BY {_KEY}) AS first_id, id = min(id) OVER (PARTITION BY {_KEY}) AS wins FROM prow")
def first_inputs(spark, folder):
    keyed = once(spark, folder, "input_json").withColumn("key", duplicates.fingerprint(F.col("input_json")))
    return duplicates.first_wins(keyed, ["key"], ["id"]).select("id", "first_id", "wins")


@query(
    """SELECT id, epoch_us(loaded_at) AS loaded, epoch_us(min(loaded_at) OVER (PARTITION BY id)) AS first_loaded,
  loaded_at = min(loaded_at) OVER (PARTITION BY id) AS wins FROM annotations WHERE id IS NOT NULL"""
)
def first_wins(spark, folder):
    given = table(spark, folder, "annotations").where("id IS NOT NULL").select("id", F.unix_micros("loaded_at").alias("loaded"))
    return duplicates.first_wins(given, ["id"], ["loaded"]).select("id", "loaded", "first_loaded", "wins")


@query("SELECT skill_name, trim(initial) <> '' AS rollable FROM catalog_skills")
def rollable_skills(spark, folder):
    skills = table(spark, folder, "catalog_skills")
    can, cannot = labels.rollable(skills), labels.special(skills)
    return can.select("skill_name", F.lit(True).alias("rollable")).union(cannot.select("skill_name", F.lit(False)))


_LABEL = """CASE WHEN {c}.roll_system IS NULL THEN 'errors:no roll_system' WHEN {c}.roll_system <> 'unidirectional' THEN 'unsupported:roll_system'
  WHEN {c}.kind IS NULL OR {c}.kind NOT IN ('skill', 'attribute') THEN 'errors:unknown kind'
  WHEN {c}.difficulty IS NULL OR {c}.difficulty NOT IN ('success', 'hard', 'extreme') THEN 'errors:unknown difficulty'
  WHEN coalesce({c}.name, '') = '' THEN 'errors:no name'
  WHEN {c}.kind = 'attribute' AND NOT list_contains((SELECT list(attribute_name) FROM catalog_attributes), {c}.name) THEN 'errors:unknown attribute'
  WHEN {c}.kind = 'skill' AND list_contains((SELECT list(skill_name) FROM catalog_skills WHERE trim(initial) = ''), {c}.name) THEN 'unsupported:special skill'
  WHEN {c}.kind = 'skill' AND NOT list_contains((SELECT list(skill_name) FROM catalog_skills WHERE trim(initial) <> ''), {c}.name) THEN 'errors:unknown skill'
  ELSE 'ok:' END"""
_EACH = "each AS (SELECT id, unnest(checks) AS c, generate_subscripts(checks, 1) - 1 AS pos FROM rec)"


@query(
    f"""WITH {_RECORDS}, {_EACH}, o AS (SELECT *, {_LABEL.format(c="c")} AS o FROM each) SELECT id, pos::BIGINT AS pos, c.kind AS kind, c.name AS name,
  c.difficulty AS difficulty, split_part(o, ':', 1) AS bucket, split_part(o, ':', 2) AS reason FROM o"""
)
def label_validity(spark, folder):
    found = labels.checked_labels(records(spark, folder, "checks"), catalog(spark, folder))
    return found.withColumn("pos", F.col("pos").cast("long"))


_CLASSIFIED = f"""{_RECORDS}, {_EACH}, o AS (SELECT id, list({_LABEL.format(c="c")} ORDER BY pos) AS os FROM each GROUP BY id),
  n AS (SELECT rec.*, coalesce(len(checks), 0) AS n, list_filter(os, lambda x: starts_with(x, 'errors'))[1] AS failed,
    list_filter(os, lambda x: starts_with(x, 'unsupported'))[1] AS unusable, section IN ('examples', 'alternative_examples') AS data,
    section = 'examples' AS lab, section = 'alternative_examples' AS alt FROM rec LEFT JOIN o USING (id)),
  cls AS (SELECT id, section, CASE WHEN trim(id) = '' THEN 'errors:no id'
    WHEN section IS NULL OR section NOT IN ('examples', 'alternative_examples', 'pending_examples', 'skipped_examples', 'conditional_examples', 'parameterized_examples') THEN 'errors:unknown section'
    WHEN scenario_scope IS NOT NULL AND scenario_scope NOT IN ('general', 'game_specific') THEN 'errors:unknown scope'
    WHEN section = 'pending_examples' THEN CASE WHEN checks IS NULL THEN 'pending:annotation pending' ELSE 'pending:in pending_examples' END
    WHEN section = 'skipped_examples' THEN 'skipped:' || coalesce(nullif(skip_reason_raw, ''), 'skipped')
    WHEN section = 'conditional_examples' THEN 'unsupported:conditional'
    WHEN section = 'parameterized_examples' THEN 'unsupported:parameterized'
    WHEN data AND NOT coalesce(regexp_matches(raw_response, '[^\\s\\p{{Z}}\\x1c-\\x1f\\x{{85}}]'), false) THEN 'errors:no raw_response'
    WHEN data AND roll_required IS NULL THEN 'errors:roll_required missing'
    WHEN alt AND NOT roll_required THEN 'errors:alternatives need a roll'
    WHEN data AND coalesce(roll_optional, false) THEN 'unsupported:optional roll'
    WHEN data AND checks IS NULL THEN 'errors:no checks'
    WHEN data AND check_mode IS NOT NULL AND check_mode NOT IN ('single', 'pair') THEN 'errors:unknown check_mode'
    WHEN lab AND NOT roll_required AND n > 0 THEN 'errors:checks without a roll'
    WHEN lab AND NOT roll_required AND check_mode IS NOT NULL THEN 'errors:check_mode without a roll'
    WHEN lab AND roll_required AND (check_mode = 'single' AND n <> 1 OR check_mode = 'pair' AND n <> 2) THEN 'errors:check_mode and number of checks differ'
    WHEN data AND failed IS NOT NULL THEN failed
    WHEN lab AND n = 2 THEN 'unsupported:pair check'
    WHEN lab AND roll_required AND n <> 1 THEN 'errors:number of checks'
    WHEN alt AND n < 2 THEN 'errors:fewer than two alternatives'
    WHEN data AND unusable IS NOT NULL THEN unusable
    WHEN alt AND len(list_distinct(checks)) < n THEN 'errors:alternatives repeat a choice'
    WHEN alt THEN 'eval_only:' || n || ' accepted alternatives' ELSE 'trainable:' END AS o FROM n)"""
_RECORD_COLUMNS = ("section", "scenario_scope", "raw_response", "roll_required", "roll_optional", "check_mode", "checks", "skip_reason_raw")


@query(f"WITH {_CLASSIFIED} SELECT id, section, split_part(o, ':', 1) AS bucket, substr(o, instr(o, ':') + 1) AS reason FROM cls")
def classified(spark, folder):
    return labels.classified(records(spark, folder, *_RECORD_COLUMNS), catalog(spark, folder))


@query(
    f"WITH {_CLASSIFIED} SELECT "
    + ", ".join(f"count(*) FILTER (WHERE starts_with(o, '{b}:')) AS {b}" for b in ("trainable", "eval_only", "pending", "skipped", "unsupported", "errors"))
    + " FROM cls"
)
def bucket_counts(spark, folder):
    return labels.bucket_counts(classified(spark, folder))


_SECTIONS = tuple(labels.SECTIONS)


@query("SELECT source, " + ", ".join(f"count(*) FILTER (WHERE section = '{s}') AS {s}" for s in _SECTIONS) + " FROM annotations WHERE source IS NOT NULL GROUP BY source")
def source_sections(spark, folder):
    given = table(spark, folder, "annotations").where("source IS NOT NULL")
    return given.groupBy("source").agg(*(F.count_if(F.col("section") == s).alias(s) for s in _SECTIONS))


_LINKS = "lnk AS (SELECT DISTINCT id AS a, b FROM (SELECT id, unnest(links) AS b FROM prow) WHERE b IS NOT NULL)"


@query(f"WITH {_ONCE}, {_LINKS} SELECT a, b FROM lnk WHERE b IN (SELECT id FROM prow)")
def link_edges(spark, folder):
    rows = once(spark, folder, "links")
    return splits.link_edges(rows, rows)


@query(f"WITH {_ONCE}, {_LINKS} SELECT a AS id, b AS link FROM lnk WHERE b NOT IN (SELECT id FROM prow)")
def dangling_links(spark, folder):
    rows = once(spark, folder, "links")
    return splits.dangling_links(rows, rows)


@query(
    f"""WITH {_ONCE}, g AS (SELECT id, unnest(group_members) AS m FROM prow), u AS (SELECT g.id, m, prow.id AS hit FROM g LEFT JOIN prow ON prow.id = m)
  SELECT id AS group_no, string_agg(m, ',' ORDER BY m) AS unknown FROM u WHERE hit IS NULL GROUP BY ALL"""
)
def refused_groups(spark, folder):
    rows = once(spark, folder, "group_members")
    _, refused = splits.configured_edges(rows.select(F.col("id").alias("group_no"), F.col("group_members").alias("members")), rows)
    return refused.select("group_no", F.array_join("unknown", ",").alias("unknown"))


_COMPONENTS = f"""{_ONCE}, {_LINKS}, e AS (SELECT a, b FROM lnk WHERE b IN (SELECT id FROM prow) UNION SELECT b, a FROM lnk WHERE b IN (SELECT id FROM prow)),
  reach(id, r) AS (SELECT id, id FROM prow UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.r),
  comp AS (SELECT id, min(r) AS group_key FROM reach GROUP BY id)"""


@query(f"WITH RECURSIVE {_COMPONENTS} SELECT id, group_key FROM comp")
def scenario_groups(spark, folder):
    return splits.scenario_groups(once(spark, folder, "links"))


@query(f"WITH RECURSIVE {_COMPONENTS} SELECT group_key AS component, string_agg(id, ',' ORDER BY id) AS members FROM comp GROUP BY ALL")
def group_members(spark, folder):
    found = components.group_members(splits.scenario_groups(once(spark, folder, "links")).withColumnRenamed("group_key", "component"))
    return found.select("component", F.array_join("members", ",").alias("members"))


_HELD = "held AS (SELECT group_key, bool_or(target_decision IS NULL) AS held FROM keyed GROUP BY group_key)"
_ASSIGNED = f"""{_COMPONENTS}, keyed AS (SELECT prow.* EXCLUDE (group_key), comp.group_key FROM prow JOIN comp USING (id)), {_HELD},
  asg AS (SELECT id, CASE WHEN scope = 'game_specific' THEN 'test' WHEN held OR ('0x' || substr(sha256('0:' || group_key), 1, 8))::BIGINT / 4294967295.0 < 0.2
  THEN 'val' ELSE 'train' END AS split FROM keyed JOIN held USING (group_key))"""


@query(f"WITH RECURSIVE {_ASSIGNED} SELECT id, split FROM asg")
def assigned_splits(spark, folder):
    rows = once(spark, folder, "scope", "links", "target_decision")
    keyed = rows.join(splits.scenario_groups(rows.select("id", "links")), "id")
    return splits.assign_splits(keyed.withColumn("has_target", F.col("target_decision").isNotNull()), VAL_SHARE).select("id", "split")


@query(f"WITH RECURSIVE {_ASSIGNED} SELECT id, prow.split AS was, asg.split AS now FROM prow JOIN asg USING (id) WHERE prow.split <> asg.split")
def moved_rows(spark, folder):
    return splits.moved_rows(once(spark, folder, "split"), assigned_splits(spark, folder))


@query(
    f"""WITH {_ONCE} SELECT group_key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM prow WHERE split IS NOT NULL AND group_key IS NOT NULL
  GROUP BY group_key HAVING count(DISTINCT split) > 1"""
)
def straddling_groups(spark, folder):
    return splits.straddling_groups(once(spark, folder, "group_key", "split")).select("group_key", F.array_join("splits", ",").alias("splits"))


@query(f"WITH {_ONCE} SELECT split, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM prow WHERE split IS NOT NULL GROUP BY split")
def split_sizes(spark, folder):
    return splits.split_sizes(once(spark, folder, "split"))


# The trained rows of these queries are those of the train split; their inputs are known by digest.
_TRAINED = f"""{_ONCE}, old AS (SELECT * FROM prow WHERE split = 'train'),
  tr AS (SELECT id FROM prow WHERE id IN (SELECT id FROM old) OR sha256(input_json) IN (SELECT sha256(input_json) FROM old)),
  hist AS (SELECT id FROM old UNION SELECT unnest(links) FROM old UNION SELECT unnest(group_members) FROM old),
  grp AS (SELECT DISTINCT group_key FROM prow WHERE id IN (SELECT id FROM tr) AND group_key IS NOT NULL),
  nam AS (SELECT id, id AS o FROM prow UNION ALL SELECT id, unnest(links) FROM prow UNION ALL SELECT id, unnest(group_members) FROM prow),
  r1 AS (SELECT id FROM prow WHERE group_key IN (SELECT group_key FROM grp) UNION
         SELECT id FROM nam WHERE o IN (SELECT id FROM hist WHERE id IS NOT NULL) AND id NOT IN (SELECT id FROM tr)),
  g2 AS (SELECT DISTINCT group_key FROM prow WHERE id IN (SELECT id FROM r1) AND group_key IS NOT NULL),
  rel AS (SELECT id FROM (SELECT id FROM r1 UNION SELECT id FROM prow WHERE group_key IN (SELECT group_key FROM g2)) WHERE id NOT IN (SELECT id FROM tr))"""


def _trained(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = once(spark, folder, "split", "source", "group_key", "links", "group_members", "input_json").withColumn("fingerprint", F.sha2("input_json", 256))
    old = rows.where("split = 'train'")
    return rows, old, leakage.trained(rows.select("id", "fingerprint"), old, old)


@query(f"WITH {_TRAINED} SELECT id FROM tr")
def trained_rows(spark, folder):
    return _trained(spark, folder)[2]


@query(f"WITH {_TRAINED} SELECT id FROM hist WHERE id IS NOT NULL")
def scenario_ids(spark, folder):
    return leakage.scenario_ids(_trained(spark, folder)[1])


def _related(spark, folder):
    rows, old, seen = _trained(spark, folder)
    return rows, seen, leakage.training_relatives(rows, seen, leakage.scenario_ids(old))


@query(f"WITH {_TRAINED} SELECT id FROM rel")
def training_relatives(spark, folder):
    return _related(spark, folder)[2]


@query()
def training_relatives_by_text(spark, folder):
    rows, old, seen = _trained(spark, folder)
    known = rows.join(texts(spark, folder), "id")
    return leakage.training_relatives(known, seen, leakage.scenario_ids(old), known.join(old.select("id"), "id", "left_semi").select("text"), NEAR)


@query(f"WITH {_TRAINED} SELECT id, split FROM prow WHERE id NOT IN (SELECT id FROM tr) AND id NOT IN (SELECT id FROM rel)")
def held_out(spark, folder):
    rows, seen, related = _related(spark, folder)
    return leakage.held_out(rows, seen, related).select("id", "split")


@query(
    f"""WITH {_TRAINED}, x AS (SELECT id, 'trained' AS reason FROM tr UNION ALL SELECT id, 'related' FROM rel)
  SELECT reason, count(*) AS n, min(id) AS first_id, max(id) AS last_id FROM x GROUP BY reason"""
)
def exclusions(spark, folder):
    return leakage.exclusions(*_related(spark, folder))


@query(f"WITH {_TRAINED} SELECT id, 'trained' AS reason FROM tr UNION ALL SELECT id, 'related' FROM rel")
def excluded_rows(spark, folder):
    return leakage.excluded(*_related(spark, folder))


# A decision that depends on the id alone stands in for a model: none, no roll, or the first option, made hard.
_DECIDED = f"""{_ONCE}, dec AS (SELECT *, substr(md5(id), 1, 1) AS h FROM prow WHERE reference IS NOT NULL),
  sc AS (SELECT id, split, h, reference.roll_required AS rr, list_transform(list_filter(reference.options, lambda o: len(o) = 1), lambda o: o[1]) AS op,
    CASE WHEN h >= '4' AND h >= '8' AND reference.roll_required THEN reference.options[1][1] END AS said FROM dec),
  sd AS (SELECT *, said IS NOT NULL AS has, said.kind AS k, said.name AS nm, CASE WHEN h < 'c' THEN 'hard' ELSE said.difficulty END AS d FROM sc),
  mt AS (SELECT *, list_filter(op, lambda o: o.kind = k AND o.name = nm) AS same FROM sd),
  scored AS (SELECT id, split, h >= '4' AS format_valid, h >= '4' AND has = rr AS roll_required,
    CASE WHEN rr THEN has AND len(same) > 0 END AS "check",
    CASE WHEN rr THEN has AND list_contains(list_transform(CASE WHEN len(same) > 0 THEN same ELSE op END, lambda o: o.difficulty), d) END AS difficulty,
    CASE WHEN rr THEN has AND list_contains(list_transform(same, lambda o: o.difficulty), d) ELSE h >= '4' END AS exact FROM mt)"""


def _scored(spark, folder):
    rows = once(spark, folder, "split", "reference").where("reference IS NOT NULL")
    h = F.substring(F.md5("id"), 1, 1)
    first = F.get(F.get(F.col("reference.options"), 0), 0)
    rolls = (h >= "8") & F.col("reference.roll_required") & first.isNotNull()
    check = F.struct(first["kind"].alias("kind"), first["name"].alias("name"), F.when(h < "c", "hard").otherwise(first["difficulty"]).alias("difficulty"))
    decision = F.struct(rolls.alias("roll_required"), F.when(rolls, F.array(check)).otherwise(F.array()).alias("checks"))
    return scoring.scored(rows.withColumn("decision", F.when(h >= "4", decision)), "id", "split")


@query(f"WITH {_DECIDED} SELECT * FROM scored")
def scored_rows(spark, folder):
    return _scored(spark, folder)


@query(
    f"WITH {_DECIDED} "
    + " UNION ALL ".join(
        f"""SELECT split, '{f}' AS field, count(*) FILTER (WHERE "{f}") AS correct, count("{f}") AS total,
  CASE WHEN count("{f}") > 0 THEN round_even(count(*) FILTER (WHERE "{f}") / count("{f}"), 4) END AS rate FROM scored GROUP BY split"""
        for f in scoring.FIELDS
    )
)
def field_metrics(spark, folder):
    return scoring.summarized(_scored(spark, folder), "split")


_TARGET = """'{"roll_required": ' || target_decision.roll_required::VARCHAR || ', "checks": [' || coalesce(array_to_string(list_transform(target_decision.checks,
  lambda c: '{"kind": ' || to_json(c.kind)::VARCHAR || ', "name": ' || to_json(c.name)::VARCHAR || ', "difficulty": ' || to_json(c.difficulty)::VARCHAR || '}'), ', '), '') || ']}'"""


@query(f"WITH {_ONCE} SELECT id, {_TARGET} AS target FROM prow WHERE target_decision IS NOT NULL")
def target_texts(spark, folder):
    rows = once(spark, folder, "target_decision").where("target_decision IS NOT NULL")
    return rows.select("id", messages.target_text(F.col("target_decision")).alias("target"))


@query(f"WITH {_ONCE} SELECT id, {_dumped('input_json::JSON', 3, False)} AS content FROM prow")
def user_messages(spark, folder):
    return once(spark, folder, "input_json").select("id", messages.user_message(F.col("input_json")).alias("content"))


@query(
    f"""WITH {_ONCE}, m AS (SELECT id, 0 AS pos, 'system' AS role, 'Choose the check.' AS content FROM prow
  UNION ALL SELECT id, 1, 'user', coalesce(similarity_text, '') FROM prow
  UNION ALL SELECT id, 2, 'assistant', {_TARGET} FROM prow WHERE target_decision IS NOT NULL) SELECT id, pos::BIGINT AS pos, role, content FROM m"""
)
def chats(spark, folder):
    rows = once(spark, folder, "similarity_text", "target_decision")
    made = messages.chat("Choose the check.", F.coalesce("similarity_text", F.lit("")), messages.target_text(F.col("target_decision")))
    return rows.select("id", F.posexplode(made).alias("pos", "m")).select("id", F.col("pos").cast("long").alias("pos"), "m.role", "m.content")


@query(
    f"""WITH {_ONCE}, t AS (SELECT id, target_decision.roll_required AS rr, target_decision.checks[1] AS c FROM prow WHERE target_decision IS NOT NULL)
  SELECT id, CASE WHEN rr AND c.kind = 'skill' THEN c.name END AS skill, CASE WHEN rr AND c.kind = 'skill' THEN c.difficulty END AS difficulty,
  CASE WHEN rr AND c.kind = 'attribute' THEN '{messages.ATTRIBUTE_NOTE}' END AS note FROM t"""
)
def game_requests(spark, folder):
    rows = once(spark, folder, "target_decision").where("target_decision IS NOT NULL")
    made = messages.game_request(F.col("target_decision"))
    return rows.select("id", *(c.alias(k) for k, c in made.items()))


@query(
    """SELECT 'Attributes: ' || (SELECT string_agg(attribute_name, ', ' ORDER BY ord) FROM catalog_attributes) AS attributes,
  'Skills: ' || (SELECT string_agg(skill_name, ', ' ORDER BY skill_name) FROM catalog_skills WHERE trim(initial) <> '') AS skills"""
)
def system_message(spark, folder):
    known = catalog(spark, folder)
    lines = messages.system_message(list(known.rollable), list(known.attributes)).split("\n")
    return spark.createDataFrame([(lines[-2], lines[-1])], "attributes string, skills string")


@query(
    f"""WITH {_TEXTS} SELECT split, count(*) AS rows, coalesce(max(n), 0)::BIGINT AS longest, round_even(avg(n), 1) AS mean
  FROM (SELECT split, len(regexp_extract_all(lower(text), '[a-z0-9]+|[一-鿿]')) AS n FROM txt) GROUP BY split"""
)
def length_stats(spark, folder):
    rows = once(spark, folder, "split", "similarity_text", "input_json").withColumn("text", row_text())
    return messages.length_stats(rows, "split").withColumn("longest", F.col("longest").cast("long"))


@query(f"WITH {_TEXTS}, n AS (SELECT id, len(regexp_extract_all(lower(text), '[a-z0-9]+|[一-鿿]'))::BIGINT AS tokens FROM txt) SELECT id, tokens FROM n WHERE tokens + 16 > 96")
def too_long(spark, folder):
    return messages.too_long(texts(spark, folder), 96, 16).withColumn("tokens", F.col("tokens").cast("long"))


@query(
    f"""WITH {_TEXTS}, n AS (SELECT substr(md5(id), 1, 2) AS batch, len(regexp_extract_all(lower(text), '[a-z0-9]+|[一-鿿]')) AS n FROM txt)
  SELECT batch, count(*) AS n, max(n)::BIGINT AS width, sum(n)::BIGINT AS used FROM n GROUP BY batch"""
)
def padded_batches(spark, folder):
    ids = F.transform(text.tokens(F.col("text")), F.length)
    rows = texts(spark, folder).select("id", F.substring(F.md5("id"), 1, 2).alias("batch"), ids.alias("ids"), ids.alias("labels"))
    used = F.aggregate("mask", F.lit(0), lambda s, x: s + x)
    sums = messages.padded(rows).groupBy("batch").agg(F.count("*").alias("n"), F.max(F.size("ids")).alias("width"), F.sum(used).alias("used"))
    return sums.select("batch", "n", F.col("width").cast("long").alias("width"), "used")


def _bytes(texts_: list[str]) -> list[list[int]]:
    """A stand-in for a tokenizer: one number per byte."""
    return [list(t.encode("utf-8", "replace")) for t in texts_]


@query(
    f"""WITH {_ONCE}, t AS (SELECT id, strlen(coalesce(similarity_text, ''))::BIGINT AS masked, strlen({_TARGET})::BIGINT AS k FROM prow WHERE target_decision IS NOT NULL)
  SELECT id, masked + k AS n, masked, masked + k <= 1024 AS fits FROM t"""
)
def encoded_rows(spark, folder):
    rows = once(spark, folder, "similarity_text", "target_decision").where("target_decision IS NOT NULL")
    made = rows.select("id", F.coalesce("similarity_text", F.lit("")).alias("prompt"), messages.target_text(F.col("target_decision")).alias("target"))
    out = messages.encoded(made, _bytes, 1024)
    masked = F.size(F.filter("labels", lambda x: x == messages.IGNORED))
    return out.select("id", F.size("ids").cast("long").alias("n"), masked.cast("long").alias("masked"), "fits")


@query("SELECT 'events' AS origin, json_valid(props) AS strict, count(*) AS n FROM events GROUP BY ALL UNION ALL SELECT 'inputs', json_valid(input_json), count(*) FROM prepared_rows GROUP BY ALL")
def strict_json(spark, folder):
    both = table(spark, folder, "events").select(F.lit("events").alias("origin"), F.col("props").alias("t"))
    both = both.union(table(spark, folder, "prepared_rows").select(F.lit("inputs"), "input_json"))
    strict = F.when(F.col("t").isNotNull(), strictjson.problem(F.col("t")) == "")
    return both.select("origin", strict.alias("strict")).groupBy("origin", "strict").agg(F.count("*").alias("n"))


@query("SELECT array_to_string(list_sort(json_keys(input_json)), ',') AS keys, count(*) AS n FROM prepared_rows GROUP BY ALL")
def key_sets(spark, folder):
    keys = F.array_join(F.sort_array(F.json_object_keys("input_json")), ",")
    return table(spark, folder, "prepared_rows").groupBy(keys.alias("keys")).agg(F.count("*").alias("n"))


# The first letter of an id's digest decides what a stand-in for a template or a tokenizer does to the conversation.
_RENDERED = f"""{_ONCE}, t AS (SELECT id, substr(md5(id), 1, 1) AS h, coalesce(similarity_text, '') AS p, {_TARGET} AS t FROM prow WHERE target_decision IS NOT NULL),
  w AS (SELECT id, h, p, t, CASE h WHEN '0' THEN 'x' || p || t WHEN '1' THEN p || 'none' ELSE p || t END AS w FROM t)"""


def _letters(numbers: list[list[int]]) -> list[str]:
    return [bytes(n).decode("utf-8", "replace") for n in numbers]


@query(
    f"""WITH {_RENDERED} SELECT id, strlen(w)::BIGINT AS n, strlen(p)::BIGINT AS masked, CASE WHEN h = '0' AND NOT starts_with(w, p) THEN 'the prompt is rendered differently with the answer'
  WHEN h = '1' THEN 'the target cannot be recovered' WHEN strlen(w) > 512 THEN 'too many tokens' WHEN strlen(w) > 480 THEN 'beyond the context' ELSE '' END AS problem FROM w"""
)
def encoding_problems(spark, folder):
    rows = once(spark, folder, "similarity_text", "target_decision").where("target_decision IS NOT NULL")
    h, p, t = F.substring(F.md5("id"), 1, 1), F.coalesce("similarity_text", F.lit("")), messages.target_text(F.col("target_decision"))
    whole = F.when(h == "0", F.concat(F.lit("x"), p, t)).when(h == "1", F.concat(p, F.lit("none"))).otherwise(F.concat(p, t))
    made = rows.select("id", p.alias("prompt"), whole.alias("whole"), t.alias("target"))
    return messages.encoding_problems(made, _bytes, _letters, 512, 480)


# Every input, or by its id one with something wrong.
_WRONG = {
    "0": ("$.scene", None, "scene must be a text that is not blank"),
    "1": ("$.scene", "   ", "scene must be a text that is not blank"),
    "2": ("$.other", "x", "unknown fields ['other']"),
    "3": (None, None, "exactly one of player_action and observed_event is needed"),
}
_WRONG_SQL = f"""{_ONCE}, wrong AS (SELECT id, input_json->>'$.scene' AS scene, substr(md5(id), 1, 1) AS h, CASE substr(md5(id), 1, 1)
  {" ".join(f"WHEN '{h}' THEN '{why.replace("'", "''")}'" for h, (*_, why) in _WRONG.items())} ELSE '' END AS errors FROM prow)"""


def _wronged(spark, folder) -> DataFrame:
    fields = "map<string, string>"
    rows = once(spark, folder, "input_json").withColumn("m", F.from_json("input_json", fields)).withColumn("h", F.substring(F.md5("id"), 1, 1))
    plain = F.map_filter("m", lambda k, _: k != "runtime_state")
    made = (
        F.when(F.col("h") == "0", F.map_filter(plain, lambda k, _: k != "scene"))
        .when(F.col("h") == "1", F.transform_values(plain, lambda k, v: F.when(k == "scene", F.lit("   ")).otherwise(v)))
        .when(F.col("h") == "2", F.map_concat(plain, F.create_map(F.lit("other"), F.lit("x"))))
        .when(F.col("h") == "3", F.map_filter(plain, lambda k, _: k == "scene"))
    )
    return rows.select("id", F.coalesce(F.to_json(made), "input_json").alias("input_json"))


@query(f"WITH {_WRONG_SQL} SELECT id, errors FROM wrong")
def query_problems(spark, folder):
    return predict.checked_queries(_wronged(spark, folder)).select("id", F.array_join("errors", "; ").alias("errors"))


class _Varied:
    """A model whose reply depends on the scene's digest: a decision, or one of the ways to fail it."""

    REPLIES = {
        "0": ('{"roll_required": false, "checks": []}', ""),
        "1": ('{"roll_required": true, "checks": [{"kind": "attribute", "name": "%s", "difficulty": "hard"}]}', ""),
        "2": ('{"roll_required": "no", "checks": []}', "roll_required must be true or false"),
        "3": ('{"roll_required": false, "checks": {}}', "checks must be a list"),
        "4": ('{"roll_required": true, "checks": []}', "0 checks with roll_required true"),
        "5": ('{"roll_required": true, "checks": [{"kind": "attribute", "name": "%s"}]}', "a check has exactly kind, name and difficulty"),
        "6": ('{"roll_required": false, "checks": [], "note": 1}', "an object with exactly roll_required and checks is needed"),
        "7": ('[]', "an object with exactly roll_required and checks is needed"),
        "8": ('{"roll_required": false, "roll_required": false, "checks": []}', "repeated key 'roll_required'"),
        "9": ('{"roll_required": false, "checks": [NaN]}', "NaN is no JSON"),
    }

    def __init__(self, name: str):
        self.name = name

    def reply(self, queries: list[dict]) -> list[str]:
        which = (hashlib.md5(q["scene"].encode()).hexdigest()[0] for q in queries)
        return [self.REPLIES.get(h, self.REPLIES["0"])[0].replace("%s", self.name) for h in which]


@query(
    f"""WITH {_WRONG_SQL}, r AS (SELECT id, errors AS bad, substr(md5(scene), 1, 1) AS d FROM wrong),
  e AS (SELECT id, d, bad, CASE WHEN bad <> '' THEN 'bad query: ' || bad ELSE CASE d
  {" ".join(f"WHEN '{d}' THEN '{why.replace("'", "''")}'" for d, (_, why) in _Varied.REPLIES.items())} ELSE '' END END AS errors FROM r)
  SELECT id, errors = '' AS valid, CASE WHEN errors = '' THEN d = '1' END AS roll_required, errors,
  CASE WHEN errors = '' AND d = '1' THEN '{messages.ATTRIBUTE_NOTE}' END AS note FROM e"""
)
def stub_predictions(spark, folder):
    known = catalog(spark, folder)
    made = predict.predictions(_wronged(spark, folder), partial(_Varied, known.attributes[0]), known)
    return made.select("id", "valid", F.col("decision.roll_required").alias("roll_required"), F.array_join("errors", "; ").alias("errors"), "note")


_ROW_SQL = {
    "no split": "split IS NULL",
    "scope and split differ": "(split = 'test') <> (scope = 'game_specific')",
    "links must hold ids": "list_bool_or(list_transform(links, lambda x: coalesce(trim(x), '') = ''))",
    "group is blank": "coalesce(trim(group_key), '') = ''",
    "group_members must hold the row and its group": "NOT coalesce(list_contains(group_members, id) AND list_contains(group_members, group_key), false)",
    "similarity_text is blank": "NOT coalesce(regexp_matches(similarity_text, '[^\\s\\p{Z}\\x1c-\\x1f\\x{85}]'), false)",
    "no reference": "reference.roll_required IS NULL OR reference.options IS NULL",
    "options and roll_required differ": """CASE WHEN reference.roll_required THEN len(reference.options) = 0 OR len(list_filter(reference.options, lambda o: len(o) <> 1)) > 0
  ELSE len(list_filter(reference.options, lambda o: len(o) > 0)) > 0 END""",
}


def row_rules() -> Rules:
    """Why a prepared row cannot be read back, in order of precedence."""
    options, members = F.col("reference.options"), F.col("group_members")
    rolled = (F.size(options) == 0) | F.exists(options, lambda o: F.size(o) != 1)
    whole = F.array_contains(members, F.col("id")) & F.array_contains(members, F.col("group_key"))
    broken = [
        F.col("split").isNull(),
        (F.col("split") == "test") != (F.col("scope") == "game_specific"),
        F.exists("links", text.blank),
        text.blank(F.col("group_key")),
        ~F.coalesce(whole, F.lit(False)),
        text.blank(F.col("similarity_text")),
        F.col("reference.roll_required").isNull() | options.isNull(),
        F.when(F.col("reference.roll_required"), rolled).otherwise(F.exists(options, lambda o: F.size(o) > 0)),
    ]
    rules = Rules()
    for reason, b in zip(_ROW_SQL, broken, strict=True):
        rules.add("refused", reason, b)
    return rules


@query(f"WITH {_ONCE} SELECT id, CASE " + " ".join(f"WHEN {sql} THEN '{reason}'" for reason, sql in _ROW_SQL.items()) + " ELSE '' END AS reason FROM prow")
def row_problems(spark, folder):
    rows = once(spark, folder, "split", "scope", "links", "group_key", "group_members", "similarity_text", "reference")
    return rows.select("id", row_rules().outcome("ok")["reason"].alias("reason"))


_CUT = "2025-03-01 00:00:00+00:00"


_CONTENT = ("id", "section", "scenario_scope", "annotator", "raw_response", "roll_required", "roll_optional", "check_mode", "related_example_id", "skip_reason_raw")
_CONTENT_SQL = "concat_ws(chr(31), " + ", ".join(f"coalesce({c}::VARCHAR, chr(30))" for c in _CONTENT) + """, coalesce(array_to_string(list_transform(checks,
  lambda c: concat_ws(chr(29), coalesce(c.kind, chr(30)), coalesce(c.name, chr(30)), coalesce(c.difficulty, chr(30)), coalesce(c.roll_system, chr(30)))), chr(28)), chr(30)))"""


def _revisions(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Digests of the whole content of every source, as it was delivered before a day and as it is."""
    text_of = lambda c: F.coalesce(c.cast("string"), F.lit(chr(30)))
    check = lambda c: F.concat_ws(chr(29), *(text_of(c[k]) for k in ("kind", "name", "difficulty", "roll_system")))
    checks = F.coalesce(F.array_join(F.transform("checks", check), chr(28)), F.lit(chr(30)))
    content = F.concat_ws(chr(31), *(text_of(F.col(c)) for c in _CONTENT), checks)
    given = table(spark, folder, "annotations").where("source IS NOT NULL").withColumn("content", content)
    old = given.where(F.col("loaded_at") < F.lit(_CUT).cast("timestamp"))
    return revision.digests(old, "source", "content"), revision.digests(given, "source", "content")


_DIGEST = f"sum(('0x' || substr(sha256({_CONTENT_SQL}), 1, 12))::BIGINT)::VARCHAR AS d FROM annotations WHERE source IS NOT NULL"
_REVISIONS = f"""o AS (SELECT source, {_DIGEST} AND loaded_at < TIMESTAMPTZ '{_CUT}' GROUP BY ALL), n AS (SELECT source, {_DIGEST} GROUP BY ALL)"""


@query(
    f"""WITH {_REVISIONS} SELECT source, o.d AS was, n.d AS now, CASE WHEN o.d IS NULL THEN 'added' WHEN n.d IS NULL THEN 'removed' ELSE 'changed' END AS change
  FROM o FULL OUTER JOIN n USING (source) WHERE o.d IS DISTINCT FROM n.d"""
)
def changed_sources(spark, folder):
    return revision.changed(*_revisions(spark, folder), "source", "digest")


@query(f"WITH {_REVISIONS} SELECT source, o.d AS was, n.d AS now FROM o LEFT JOIN n USING (source) WHERE o.d IS DISTINCT FROM n.d")
def stale_sources(spark, folder):
    return revision.stale(*_revisions(spark, folder), "source", "digest")


@query()
def content_digests(spark, folder):
    found = revision.file_digests(spark, f"{folder}/*.parquet", recursive=True)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), "sha256")


@query(f"WITH {_ONCE} SELECT id FROM prow WHERE target_decision IS NOT NULL AND scope = 'general' ORDER BY id LIMIT 8")
def first_trainable(spark, folder):
    return once(spark, folder, "scope", "target_decision").where("target_decision IS NOT NULL AND scope = 'general'").select("id").orderBy("id").limit(8)


@query("SELECT event_type, arg_min(value, event_id) AS first_value, arg_max(value, event_id) AS last_value FROM events GROUP BY event_type")
def first_and_last(spark, folder):
    given = table(spark, folder, "events")
    return given.groupBy("event_type").agg(F.min_by("value", "event_id").alias("first_value"), F.max_by("value", "event_id").alias("last_value"))


@query("SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL EXCEPT SELECT 'en'")
def other_languages(spark, folder):
    given = table(spark, folder, "documents").where("lang IS NOT NULL").select("lang").distinct()
    return given.exceptAll(spark.createDataFrame([("en",)], "lang string"))


@query(
    f"""WITH {_ONCE}, q AS (SELECT unnest(['ash-00000001', 'ash-00000002', 'no such id']) AS id, generate_subscripts([1, 2, 3], 1) - 1 AS pos)
  SELECT q.pos::BIGINT AS pos, q.id, prow.id IS NOT NULL AS found FROM q LEFT JOIN prow USING (id)"""
)
def ordered_lookup(spark, folder):
    wanted = spark.createDataFrame([(0, "ash-00000001"), (1, "ash-00000002"), (2, "no such id")], "pos long, id string")
    return wanted.join(once(spark, folder).withColumn("hit", F.lit(True)), "id", "left").select("pos", "id", F.coalesce("hit", F.lit(False)).alias("found"))
