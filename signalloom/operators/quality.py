"""Data-quality checks, each a DataFrame of findings or a column of verdicts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalloom.functions import vocabulary as v

FINDING = "finding_id string, category string, severity string, action string, message string, line long, missing array<string>"


def item_faults() -> Column:
    """Names of the rules that an item breaks."""
    fault = lambda name, bad: F.when(F.coalesce(bad, F.lit(True)), F.lit(name))
    rules = [
        fault("item_id", F.length("item_id") == 0),
        fault("confidence", ~F.col("confidence").between(0, 1)),
        fault("evidence_tier", ~F.col("evidence_tier").isin(*v.EVIDENCE_TIERS)),
        fault("labels", F.size("labels") == 0),
    ]
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def required_fields(schema: str | None) -> list[str]:
    """The fields that a JSON schema requires; none if it is no JSON."""
    try:
        found = json.loads(schema or "").get("required", [])
    except (ValueError, AttributeError):
        return []
    return [f for f in found if isinstance(f, str)]


def schema_faults(df: DataFrame, schema: dict) -> Column:
    """Names of the columns that break a flat JSON schema: required ones that are missing or null, and values outside an enum, a range, a length or a pattern."""
    faults = []
    for name in dict.fromkeys([*schema.get("required", []), *schema.get("properties", {})]):
        rule = schema.get("properties", {}).get(name, {})
        if name not in df.columns:
            faults += [F.lit(name)] if name in schema.get("required", []) else []
            continue
        c, tests = F.col(f"`{name}`"), []
        if "enum" in rule:
            tests.append(c.isin(*(x for x in rule["enum"] if x is not None)))
        tests += [test(c, rule[key]) for key, test in LIMITS.items() if key in rule]
        fine = F.lit(True)
        for test in tests:
            fine = fine & test
        absent = F.lit(name not in schema.get("required", []))
        faults.append(F.when(~F.when(c.isNull(), absent).otherwise(F.coalesce(fine, F.lit(False))), F.lit(name)))
    return F.filter(F.array(*faults), lambda x: x.isNotNull()) if faults else F.array().cast("array<string>")


LIMITS: dict[str, Callable] = {
    "minimum": lambda c, x: c >= x, "maximum": lambda c, x: c <= x, "minLength": lambda c, x: F.length(c) >= x, "maxLength": lambda c, x: F.length(c) <= x,
    "pattern": lambda c, x: c.rlike(x), "minItems": lambda c, x: F.size(c) >= x, "maxItems": lambda c, x: F.size(c) <= x, "const": lambda c, x: c == F.lit(x),
}


def coverage_faults(total: Column, automated: Column, queued: Column, queued_total: Column) -> Column:
    """Names of the sums that don't hold: automated and queued together are all, and the queued of each kind (a map) together are the queued."""
    by_kind = F.aggregate(F.map_values(queued), F.lit(0).cast("long"), lambda s, x: s + x)
    return F.filter(F.array(F.when(automated + queued_total != total, "total"), F.when(by_kind != queued_total, "queued")), lambda x: x.isNotNull())


def quarantine(df: DataFrame, faults: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without faults, and the others with theirs."""
    rows = df.withColumn("faults", faults)
    return rows.where(F.size("faults") == 0).drop("faults"), rows.where(F.size("faults") > 0)


def ledger_findings(lines: DataFrame, required: list[str], name: str) -> DataFrame:
    """Findings on a ledger's lines (line from 0, value): not JSON, not an object, fields missing. Blank lines are none."""
    rows = lines.where(F.trim(F.regexp_replace("value", r"\s+", " ")) != "").withColumn("_json", F.try_parse_json("value"))
    kind = F.schema_of_variant("_json")
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    missing = F.array_except(F.array(*map(F.lit, required)), keys)
    bad_json, no_object = F.col("_json").isNull(), ~F.startswith(kind, F.lit("OBJECT"))
    message = F.when(bad_json, "line is not valid JSON").when(no_object, "line is not a JSON object").when(F.size(missing) > 0, "row missing required fields")
    which = F.when(bad_json | no_object, F.concat(F.lit(f"schema:{name}_line_"), "line")).otherwise(F.concat(F.lit(f"schema:{name}_missing_"), F.coalesce(F.get_json_object("value", "$.signal_id"), F.col("line").cast("string"))))
    rows = rows.select(which.alias("finding_id"), F.lit("schema").alias("category"), F.lit("error").alias("severity"), F.lit("quarantined").alias("action"), message.alias("message"), (F.col("line") + 1).alias("line"), F.when(message == "row missing required fields", missing).alias("missing"))
    return rows.where(F.col("message").isNotNull())


def contract_findings(targets: DataFrame, contracts: DataFrame) -> DataFrame:
    """Targets (target) that have no contract (target, schema as JSON text), or one that isn't JSON."""
    rows = targets.distinct().join(contracts, "target", "left")
    message = F.when(F.col("schema").isNull(), "contract missing").when(F.try_parse_json("schema").isNull(), "contract is not valid JSON")
    return rows.select(F.concat(F.lit("contract_"), "target").alias("finding_id"), "target", message.alias("message")).where(F.col("message").isNotNull())


def grid_coverage(cells: DataFrame, rows: int, columns: int, classes: list[str]) -> DataFrame:
    """One row: whether a grid of cells (cell_id, row_index, column_index, classification) is whole, unique, in range and of known classes."""
    inside = F.col("row_index").between(0, rows - 1) & F.col("column_index").between(0, columns - 1)
    return cells.agg(
        F.count(F.lit(1)).alias("cells"), F.countDistinct("cell_id").alias("distinct_ids"), F.countDistinct("row_index").alias("distinct_rows"), F.countDistinct("column_index").alias("distinct_columns"),
        F.count_if(~inside).alias("out_of_range"), F.count_if(~F.col("classification").isin(*classes)).alias("unknown_class"),
    ).withColumn("is_whole", (F.col("cells") == rows * columns) & (F.col("distinct_ids") == F.col("cells")) & (F.col("distinct_rows") == rows) & (F.col("distinct_columns") == columns) & (F.col("out_of_range") == 0) & (F.col("unknown_class") == 0))


def same_sets(a: DataFrame, b: DataFrame) -> bool:
    """Whether two one-column tables have the same distinct values."""
    a, b = a.distinct(), b.distinct()
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def report(findings: DataFrame) -> DataFrame:
    """One row: findings, errors, and whether they hold back a release."""
    return findings.agg(F.count(F.lit(1)).alias("findings"), F.count_if(F.col("severity") == "error").alias("critical"), F.coalesce(F.bool_or(F.col("severity") == "error"), F.lit(False)).alias("promotion_blocked"))


def run_checks(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]], only: list[str] | None = None) -> DataFrame:
    """The findings of checks chosen by name (all by default), each with the check's name."""
    out = None
    for name, check in checks.items():
        if only is None or name in only:
            found = check().withColumn("check", F.lit(name))
            out = found if out is None else out.unionByName(found, allowMissingColumns=True)
    return spark.createDataFrame([], FINDING + ", check string") if out is None else out
