"""Declarative quality rules: predicates over a row, the split they cause, and what is recorded of it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.normalize import ragged

#: Rows that uniqueness looks at together.
CHUNK_ROWS = 1000
STRATEGIES = ("REJECT_RECORD", "QUARANTINE_RECORD", "WARN_AND_CONTINUE", "FAIL_FILE", "QUARANTINE_FILE")


class QualityError(Exception):
    """A rule or breaker that stops the file or the run."""


def completeness(col: Column) -> Column:
    return F.when(col.isNull() | (col == ""), "COMPLETENESS_VIOLATION")


def validity_range(col: Column, low: float | None = None, high: float | None = None) -> Column:
    """Inclusive bounds; null and what is no number are errors, NaN is inside any bounds."""
    number = F.when(~col.contains("_"), col).try_cast("double")
    outside = F.lit(False)
    if low is not None:
        outside = outside | (number < low)
    if high is not None:
        outside = outside | (number > high)
    return F.when(number.isNull(), "VALIDITY_RANGE_UNPARSEABLE").when(~F.isnan(number) & outside, "VALIDITY_RANGE_VIOLATION")


def pattern(col: Column, regex: str) -> Column:
    """The whole value must match; null counts as empty."""
    return F.when(~F.coalesce(col, F.lit("")).rlike(rf"\A(?:{regex})\z"), "PATTERN_VIOLATION")


def structural(fields: Column, width: int) -> Column:
    """Rows, as arrays of fields, that aren't as wide as the header."""
    return ragged(fields, width)


def uniqueness(col: Column, ordinal: Column, chunk_rows: int | None = CHUNK_ROWS, first_ordinal: int = 0) -> Column:
    """All but the first row of a value within its chunk of rows, or within all rows if chunk_rows is None; nulls are equal."""
    keys = [col] if chunk_rows is None else [F.floor((ordinal - first_ordinal) / chunk_rows), col]
    return F.when(F.row_number().over(Window.partitionBy(*keys).orderBy(ordinal)) > 1, "UNIQUENESS_VIOLATION")


@dataclass(frozen=True)
class Rule:
    """kind: a name in REGISTRY; options go to its builder."""

    kind: str
    column: str
    strategy: str = "REJECT_RECORD"
    options: dict = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        if self.kind not in REGISTRY:
            raise ValueError(f"unknown rule {self.kind!r}")
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {self.strategy!r}")

    def error(self, ordinal: str) -> Column:
        if self.kind == "uniqueness":
            return uniqueness(F.col(self.column), F.col(ordinal), **self.options)
        return REGISTRY[self.kind](F.col(self.column), **self.options)


REGISTRY: dict[str, Callable[..., Column]] = {"completeness": completeness, "validity_range": validity_range, "pattern": pattern, "uniqueness": uniqueness, "structural": structural}


@dataclass
class Split:
    """good has the input's columns; rejects has also error_type, error_column and ordinal; findings one row per rule."""

    good: DataFrame
    rejects: DataFrame
    findings: DataFrame


def judge(df: DataFrame, rules: Sequence[Rule], ordinal: str) -> DataFrame:
    """df with `_errors`, the outcome of each rule in order, null where it holds."""
    return df.withColumn("_errors", F.array(*(r.error(ordinal) for r in rules)) if rules else F.array().cast("array<string>"))


def split(df: DataFrame, rules: Sequence[Rule], ordinal: str) -> Split:
    """Rows that a rejecting rule fails leave; a warning only shows in the findings. The first error of a row is its reason."""
    judged = judge(df, rules, ordinal)
    stops = F.array(*(F.when(F.lit(r.strategy != "WARN_AND_CONTINUE"), F.get("_errors", k)) for k, r in enumerate(rules))) if rules else F.array().cast("array<string>")
    judged = judged.withColumn("_at", F.array_position(F.transform(stops, lambda e: e.isNotNull()), True))
    names = F.array(*(F.lit(r.column) for r in rules)) if rules else F.array().cast("array<string>")
    rejects = judged.filter("_at > 0").withColumn("error_type", F.get("_errors", (F.col("_at") - 1).cast("int"))).withColumn("error_column", F.get(names, (F.col("_at") - 1).cast("int")))
    return Split(judged.filter("_at = 0").drop("_errors", "_at"), rejects.drop("_errors", "_at"), findings(judged, rules))


def findings(judged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule_type, column, strategy, status, evaluated and failed of each rule, from one pass over the rows."""
    if not rules:
        return judged.sparkSession.createDataFrame([], "rule_type string, rule_column string, strategy string, status string, evaluated long, failed long")
    sums = judged.agg(F.count("*").alias("evaluated"), *(F.count(F.get("_errors", k)).alias(f"_failed_{k}") for k in range(len(rules))))
    status = lambda r, k: F.when(F.col(f"_failed_{k}") == 0, "PASS").otherwise("PASS_WITH_WARNING" if r.strategy == "WARN_AND_CONTINUE" else "FAIL")
    rows = [F.struct(F.lit(r.kind.upper()).alias("rule_type"), F.lit(r.column).alias("rule_column"), F.lit(r.strategy).alias("strategy"), status(r, k).alias("status"), F.col("evaluated"), F.col(f"_failed_{k}").alias("failed")) for k, r in enumerate(rules)]
    return sums.select(F.inline(F.array(*rows)))


def dispatch(found: DataFrame) -> None:
    """Raises if a rule that stops the file has failed; findings are as many as there are rules."""
    for row in found.filter("failed > 0 AND strategy IN ('FAIL_FILE', 'QUARANTINE_FILE')").collect():
        raise QualityError(f"{row['strategy']}: {row['rule_type']} on {row['rule_column']} failed for {row['failed']} rows")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 of nothing."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def breaker(rejected: int, read: int, threshold: float) -> None:
    """Stops the run if strictly more than this part of the rows was rejected."""
    if read and rejected / read > threshold:
        raise QualityError(f"{rejected} of {read} rows rejected, the limit is {threshold}")


def orphans(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Rows whose key is in no row of parent, null keys included."""
    return df.join(parent.select(F.col(parent_key).alias("_parent_key")), F.col(key) == F.col("_parent_key"), "left_anti")


def keepers(df: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    return df.join(parent.select(F.col(parent_key).alias("_parent_key")), F.col(key) == F.col("_parent_key"), "left_semi")


def volume_anomalies(counts: DataFrame, order: str, count: str, multiplier: float = 10.0, least_history: int = 2) -> DataFrame:
    """counts with the mean of all earlier counts and whether this one is above multiplier times that; counts are one row per run."""
    before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    mean = F.avg(count).over(before)
    return counts.withColumn("baseline", mean).withColumn("history", F.count(count).over(before)).withColumn("anomalous", (F.col("history") >= least_history) & (F.col(count) > multiplier * F.coalesce(F.col("baseline"), F.lit(0.0))))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of more than one row, or null, with the number of rows."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null)


def overlaps(versions: DataFrame, key: str, start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions whose half-open interval reaches into a later one of the same key; empty intervals overlap nothing."""
    order = Window.partitionBy(key).orderBy(start, end)
    return versions.filter(F.col(start) < F.col(end)).withColumn("next_start", F.lead(start).over(order)).filter(F.col("next_start") < F.col(end))


def constraint_violations(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (), current: str | None = None) -> DataFrame:
    """constraint and violations, a row for each that a table breaks: nulls in a column, keys of several rows, or of several current ones."""
    checks = [(f"not_null:{c}", df.filter(F.col(c).isNull())) for c in not_null]
    if unique:
        rows = df.filter(F.col(current)) if current else df
        checks.append((f"unique{'_current' if current else ''}:{','.join(unique)}", rows.groupBy(*unique).agg(F.count("*").alias("n")).filter("n > 1")))
    out = df.sparkSession.createDataFrame([], "constraint string, violations long")
    for name, found in checks:
        out = out.unionByName(found.agg(F.count("*").alias("violations")).select(F.lit(name).alias("constraint"), "violations"))
    return out.filter("violations > 0")
