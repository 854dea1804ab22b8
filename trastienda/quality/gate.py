"""The quality gate: measure a layer's checks in one job, store them, then stop on errors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"
RESULT_SCHEMA = (
    "run_id STRING, layer STRING, check_name STRING, severity STRING, violations BIGINT, passed BOOLEAN, "
    "description STRING, checked_at TIMESTAMP"
)


@dataclass(frozen=True)
class Check:
    name: str
    layer: str
    description: str
    severity: str = ERROR


@dataclass(frozen=True)
class Outcome:
    check: Check
    violations: int

    @property
    def passed(self) -> bool:
        return self.violations == 0


class QualityCheckError(RuntimeError):
    """Raised after all results of a layer are stored, with every failed error check."""

    def __init__(self, layer: str, failures: list[Outcome]):
        self.layer = layer
        self.failures = failures
        lines = [f"  - {o.check.name}: {o.violations} violations. {o.check.description}" for o in failures]
        super().__init__(f"the run stopped at layer '{layer}':\n" + "\n".join(lines))

    @property
    def names(self) -> list[str]:
        return [o.check.name for o in self.failures]


def measure(one_row: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """Turn a one-row table into one row (check_name, violations) per check; NULL stays NULL."""
    rows = [F.struct(F.lit(n).alias("check_name"), v.cast("bigint").alias("violations")) for n, v in violations.items()]
    return one_row.select(F.inline(F.array(*rows)))


def count_rows(frame: DataFrame, violations: dict[str, Column]) -> DataFrame:
    """Several row conditions of one table, counted in a single pass."""
    counted = frame.agg(*[F.count_if(condition).alias(name) for name, condition in violations.items()])
    return measure(counted, {name: F.col(name) for name in violations})


def surplus_rows(frame: DataFrame, name: str, keys: list[str], null_is_key: bool) -> DataFrame:
    """Rows beyond the first of their key. With several keys NULL is a key value, with one it is not."""
    per_key = frame.groupBy(*keys).agg(F.count("*").alias("n"))
    first = F.lit(1) if null_is_key else F.when(F.col(keys[0]).isNotNull(), 1).otherwise(0)
    surplus = per_key.agg(F.coalesce(F.sum(F.col("n") - first), F.lit(0)).alias("v"))
    return measure(surplus, {name: F.col("v")})


def evaluate(measures: DataFrame, checks: list[Check], null_passes: bool = False) -> list[Outcome]:
    """The outcome of every check of a layer, from one collect of one row per check.

    A check that could not be computed (a missing control total) fails, unless
    `null_passes`.
    """
    found = {r["check_name"]: r["violations"] for r in measures.collect()}
    missing = 0 if null_passes else 1
    return [Outcome(c, missing if found.get(c.name) is None else int(found[c.name])) for c in checks]


def results_frame(spark: SparkSession, run_id: str, outcomes: list[Outcome]) -> DataFrame:
    rows = [
        (run_id, o.check.layer, o.check.name, o.check.severity, o.violations, o.passed, o.check.description, None)
        for o in outcomes
    ]
    return spark.createDataFrame(rows, RESULT_SCHEMA).withColumn("checked_at", F.current_timestamp())


def run_gate(
    measures: DataFrame,
    checks: list[Check],
    layer: str,
    run_id: str,
    store: Callable[[DataFrame], object],
    null_passes: bool = False,
) -> list[Outcome]:
    """Measure, store every result, and only then raise if an error check has violations."""
    outcomes = evaluate(measures, checks, null_passes)
    store(results_frame(measures.sparkSession, run_id, outcomes))
    failures = [o for o in outcomes if not o.passed and o.check.severity == ERROR]
    if failures:
        raise QualityCheckError(layer, failures)
    return outcomes
