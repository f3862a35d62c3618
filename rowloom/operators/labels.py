"""The label catalogue as dimensions, label validity, and the classification of annotation records.

The catalogue is a list of fixed length (a hundred names), so its tables are broadcast; `Catalog.of` refuses more
than LARGEST entries.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank, strip
from .rules import Rules

LARGEST = 100_000
KINDS = ("skill", "attribute")
DIFFICULTIES = ("success", "hard", "extreme")
SECTIONS = {
    "examples": "labelled",
    "alternative_examples": "alternatives",
    "pending_examples": "pending",
    "skipped_examples": "skipped",
    "conditional_examples": "conditional",
    "parameterized_examples": "parameterized",
}
SCOPES = ("general", "game_specific")
ROLL_SYSTEMS = ("unidirectional",)


def rollable(skills: DataFrame) -> DataFrame:
    """Skills with an initial value; the text of it may be a formula and is never read."""
    return skills.where(strip(F.col("initial")) != "")


def special(skills: DataFrame) -> DataFrame:
    return skills.where(blank(F.col("initial")))


@dataclass(frozen=True)
class Catalog:
    """The names by which labels are checked, as literals of one plan."""

    rollable: tuple[str, ...]
    special: tuple[str, ...]
    attributes: tuple[str, ...]
    kinds: tuple[str, ...] = KINDS
    difficulties: tuple[str, ...] = DIFFICULTIES

    @classmethod
    def of(cls, skills: DataFrame, attributes: DataFrame) -> Catalog:
        marked = skills.select("skill_name", (~blank(F.col("initial"))).alias("r")).distinct().orderBy("skill_name").limit(LARGEST + 1).collect()
        if len(marked) > LARGEST:
            raise ValueError(f"a catalogue of more than {LARGEST} skills")
        names = [r.attribute_name for r in attributes.orderBy("ord").collect()]
        return cls(tuple(r.skill_name for r in marked if r.r), tuple(r.skill_name for r in marked if not r.r), tuple(names))

    def rules(self, kind: Column, name: Column, difficulty: Column) -> Rules:
        """Why {kind, name, difficulty} is no valid label."""

        def within(col: Column, names: tuple[str, ...]) -> Column:
            return F.coalesce(col.isin(*names), F.lit(False)) if names else F.lit(False)

        is_attribute = kind == "attribute"
        return (
            Rules()
            .add("invalid", "unknown kind", ~within(kind, self.kinds))
            .add("invalid", "unknown difficulty", ~within(difficulty, self.difficulties))
            .add("invalid", "no name", name.isNull() | (name == ""))
            .add("invalid", "unknown attribute", is_attribute & ~within(name, self.attributes))
            .add("special", "special skill", ~is_attribute & within(name, self.special))
            .add("invalid", "unknown skill", ~is_attribute & ~within(name, self.rollable))
        )

    def label_outcome(self, entry: Column) -> Column:
        """struct<bucket, reason> of one entry of `checks`: ok, unsupported or errors."""
        system = entry["roll_system"]
        label = self.rules(entry["kind"], entry["name"], entry["difficulty"]).outcome("ok")
        rules = (
            Rules()
            .add("errors", "no roll_system", system.isNull())
            .add("unsupported", "roll_system", ~system.isin(*ROLL_SYSTEMS))
            .add("unsupported", label["reason"], label["bucket"] == "special")
            .add("errors", label["reason"], label["bucket"] == "invalid")
        )
        return rules.outcome("ok")


def checked_labels(annotations: DataFrame, catalog: Catalog) -> DataFrame:
    """(id, pos, kind, name, difficulty, bucket, reason): every coded check with its validity."""
    each = annotations.select("id", F.posexplode("checks").alias("pos", "c")).withColumn("o", catalog.label_outcome(F.col("c")))
    return each.select("id", "pos", "c.kind", "c.name", "c.difficulty", "o.bucket", "o.reason")


def classified(annotations: DataFrame, catalog: Catalog) -> DataFrame:
    """(id, section, bucket, reason): exactly one bucket for every record.

    A record is trainable or eval_only as data, and else pending, skipped, unsupported or an error; the first
    rule decides. In a record of several checks an error of any entry comes before what is merely unsupported.
    """
    checks = F.col("checks")
    n = F.coalesce(F.size(checks), F.lit(0))
    # Columns of their own, so that the rules read what was evaluated once.
    judged = annotations.withColumn("_outcomes", F.transform(checks, catalog.label_outcome))
    of = lambda bucket: F.transform(F.filter("_outcomes", lambda o: o["bucket"] == bucket), lambda o: o["reason"])
    judged = judged.withColumns({"_errors": of("errors"), "_unsupported": of("unsupported")})
    failed, unusable = F.col("_errors"), F.col("_unsupported")
    section, required, mode = F.col("section"), F.col("roll_required"), F.col("check_mode")
    labelled, several = section == "examples", section == "alternative_examples"
    data = labelled | several
    rules = (
        Rules()
        .add("errors", "no id", blank(F.col("id")))
        .add("errors", "unknown section", ~F.coalesce(section.isin(*SECTIONS), F.lit(False)))
        .add("errors", "unknown scope", F.col("scenario_scope").isNotNull() & ~F.col("scenario_scope").isin(*SCOPES))
        .add("pending", F.when(checks.isNull(), "annotation pending").otherwise("in pending_examples"), section == "pending_examples")
        .add("skipped", F.coalesce(F.nullif("skip_reason_raw", F.lit("")), F.lit("skipped")), section == "skipped_examples")
        .add("unsupported", "conditional", section == "conditional_examples")
        .add("unsupported", "parameterized", section == "parameterized_examples")
        .add("errors", "no raw_response", data & blank(F.col("raw_response")))
        .add("errors", "roll_required missing", data & required.isNull())
        .add("errors", "alternatives need a roll", several & ~required)
        .add("unsupported", "optional roll", data & F.coalesce(F.col("roll_optional"), F.lit(False)))
        .add("errors", "no checks", data & checks.isNull())
        .add("errors", "unknown check_mode", data & mode.isNotNull() & ~mode.isin("single", "pair"))
        .add("errors", "checks without a roll", labelled & ~required & (n > 0))
        .add("errors", "check_mode without a roll", labelled & ~required & mode.isNotNull())
        .add("errors", "check_mode and number of checks differ", labelled & required & ((mode == "single") & (n != 1) | (mode == "pair") & (n != 2)))
        .add("errors", F.get(failed, F.lit(0)), data & (F.size(failed) > 0))
        .add("unsupported", "pair check", labelled & (n == 2))
        .add("errors", "number of checks", labelled & required & (n != 1))
        .add("errors", "fewer than two alternatives", several & (n < 2))
        .add("unsupported", F.get(unusable, F.lit(0)), data & (F.size(unusable) > 0))
        .add("errors", "alternatives repeat a choice", several & (F.size(F.array_distinct(checks)) < n))
        .add("eval_only", F.concat(n.cast("string"), F.lit(" accepted alternatives")), several)
    )
    return judged.withColumn("o", rules.outcome("trainable")).select("id", "section", "o.bucket", "o.reason")


def bucket_counts(outcomes: DataFrame) -> DataFrame:
    """One row with the number of records per bucket, 0 where there is none."""
    names = ["trainable", "eval_only", "pending", "skipped", "unsupported", "errors"]
    return outcomes.agg(*(F.count_if(F.col("bucket") == b).alias(b) for b in names))
