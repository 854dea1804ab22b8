"""Small fixed tables and one-row results inside a plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def fixed_table(spark: SparkSession, rows, names: str) -> DataFrame:
    """A few constant rows as a relation the optimizer sees through."""

    def text(value) -> str:
        if value is None:
            return "NULL"
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return str(value)

    values = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def known_values(one_row: DataFrame) -> dict[str, Column]:
    """The values of a one-row table as literals.

    One row reaches the driver. As literals its values prune partitions and row
    groups when a scan is planned, and the row is computed once.
    """
    row = one_row.first()
    return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in one_row.schema.fields}
