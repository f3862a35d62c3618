"""The subpackage's queries over the tables of a scale directory, and the SQL that states the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import catalog_mapping as cm
from . import format_duplicates as fd
from . import groups as gr
from . import leaks as lk
from . import near_duplicates as nd
from . import packing as pk
from . import related_splits as rs
from . import same_looking as sl
from . import split_overlap as so
from . import subjects as sj


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _typed(spark: SparkSession, folder: str) -> tuple[DataFrame, list[tuple[str, str]]]:
    entries = cm.catalog_entries(table(spark, folder, "catalog_skills"), table(spark, folder, "catalog_attributes"))
    return cm.uncoded(table(spark, folder, "annotations")), entries


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return cm.mapped_values(*_typed(spark, folder))


def p1_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return cm.candidate_values(*_typed(spark, folder))


def p1_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return cm.unmatched_values(*_typed(spark, folder))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return nd.near_duplicates(table(spark, folder, "prepared_rows"))[0]


def p2_members(spark: SparkSession, folder: str) -> DataFrame:
    return nd.linked_members(*nd.near_duplicates(table(spark, folder, "prepared_rows"))[1:])


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return sl.same_looking_pairs(table(spark, folder, "prepared_rows"))


def p3_plain_texts(spark: SparkSession, folder: str) -> DataFrame:
    return sl.plain_texts(table(spark, folder, "prepared_rows"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return gr.row_groups(table(spark, folder, "prepared_rows"), table(spark, folder, "match_pairs"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return so.split_overlaps(table(spark, folder, "prepared_rows"))


def p5_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return so.record_overlaps(table(spark, folder, "prepared_rows"))


def p5_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "prepared_rows")
    return so.overlap_report(rows, so.split_overlaps(rows))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return fd.format_duplicates(table(spark, folder, "prepared_rows"))


def p6_collapsed(spark: SparkSession, folder: str) -> DataFrame:
    return fd.collapsed(table(spark, folder, "prepared_rows"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "prepared_rows")
    return rs.torn_sets(rows, rs.related_sets(rows))


def p7_sets(spark: SparkSession, folder: str) -> DataFrame:
    return rs.related_sets(table(spark, folder, "prepared_rows"))


def p7_splits(spark: SparkSession, folder: str) -> DataFrame:
    return rs.assigned_splits(table(spark, folder, "prepared_rows"), table(spark, folder, "split_plan"))


def p8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pk.packed(table(spark, folder, "documents"), table(spark, folder, "container_sizes"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "container_sizes")
    return pk.fill_report(pk.packed(table(spark, folder, "documents"), sizes), sizes)


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return lk.leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return lk.passages(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "eval_items")
    return lk.leak_report(items, lk.leaked_items(table(spark, folder, "documents"), items))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return sj.document_subjects(*(table(spark, folder, t) for t in ("documents", "subjects", "subject_labels")))


def p10_composition(spark: SparkSession, folder: str) -> DataFrame:
    return sj.composition(table(spark, folder, "documents"), p10_found(spark, folder))


def queries() -> dict:
    return {
        "p1_found": p1_found,
        "p1_candidates": p1_candidates,
        "p1_unmatched": p1_unmatched,
        "p2_found": p2_found,
        "p2_members": p2_members,
        "p3_found": p3_found,
        "p3_plain_texts": p3_plain_texts,
        "p4_found": p4_found,
        "p5_found": p5_found,
        "p5_overlaps": p5_overlaps,
        "p5_report": p5_report,
        "p6_found": p6_found,
        "p6_collapsed": p6_collapsed,
        "p7_found": p7_found,
        "p7_sets": p7_sets,
        "p7_splits": p7_splits,
        "p8_packing": p8_packing,
        "p8_fill": p8_fill,
        "p9_found": p9_found,
        "p9_passages": p9_passages,
        "p9_report": p9_report,
        "p10_found": p10_found,
        "p10_composition": p10_composition,
    }


_IDS = "ids AS (SELECT DISTINCT id FROM prepared_rows WHERE id IS NOT NULL)"
_REACH = "e AS (SELECT a, b FROM e1 UNION SELECT b, a FROM e1), reach(id, r) AS (SELECT id, id FROM ids UNION SELECT reach.id, e.b FROM reach JOIN e ON e.a = reach.r)"

_RELATED = f"""{_IDS}, e1 AS (SELECT id AS a, group_key AS b FROM prepared_rows WHERE id IS NOT NULL AND trim(group_key) <> ''
  UNION SELECT id, m FROM (SELECT id, unnest(group_members) AS m FROM prepared_rows) WHERE id IS NOT NULL AND m IN (SELECT id FROM ids)), {_REACH},
  s AS (SELECT id, min(r) AS set_id FROM reach WHERE r IN (SELECT id FROM ids) GROUP BY id)"""


def oracle_sql() -> dict[str, str]:
    """Connected sets are the only results that SQL states over whole tables; the others are tested by brute force."""
    return {
        "p4_found": f"""WITH RECURSIVE {_IDS}, e0 AS (SELECT id AS a, unnest(links) AS b FROM prepared_rows UNION SELECT id_a, id_b FROM match_pairs),
  e1 AS (SELECT a, b FROM e0 WHERE a <> b AND a IN (SELECT id FROM ids) AND b IN (SELECT id FROM ids)), {_REACH}
  SELECT id, min(r) AS group_id FROM reach GROUP BY id HAVING count(*) > 1""",
        "p7_sets": f"""WITH RECURSIVE {_RELATED} SELECT id, set_id FROM s""",
        "p7_found": f"""WITH RECURSIVE {_RELATED},
  torn AS (SELECT set_id FROM s JOIN prepared_rows USING (id) GROUP BY set_id HAVING count(DISTINCT split) > 1)
  SELECT set_id, id FROM s WHERE set_id IN (SELECT set_id FROM torn)""",
    }
