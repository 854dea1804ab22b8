"""Question 3: month-over-month growth per channel, aware of what each source covers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trastienda.functions.amounts import TOTAL, percent_change
from trastienda.functions.dates import month_of
from trastienda.functions.literals import fixed_table
from trastienda.plans.core import ONLINE, PHYSICAL, POS

PRINCIPAL, TOTAL_CHANNEL = "principal", "total"
ALL_TYPES, INCOME_ONLY, IF_UTC = "fisico_todos_los_tipos", "fisico_solo_ingresos", "ecommerce_timestamp_utc"
# The published series, as variant, channel and covering source.
SERIES = (
    (PRINCIPAL, PHYSICAL, POS),
    (PRINCIPAL, ONLINE, ONLINE),
    (ALL_TYPES, PHYSICAL, POS),
    (INCOME_ONLY, PHYSICAL, POS),
    (IF_UTC, ONLINE, ONLINE),
)
# Notes on a month.
MONTH_UNCOVERED, PREVIOUS_UNCOVERED = "sin_cobertura_mes", "sin_cobertura_mes_anterior"
ZERO_BASE, INCOMPLETE, FINE, CHANNEL_UNCOVERED = "base_cero", "mes_incompleto", "ok", "algun_canal_sin_cobertura"


def monthly_series(sales: DataFrame) -> DataFrame:
    """Sales per series and month, from one pass over the fact.

    The fact shrinks to channel and months first; the series are read off that.
    """
    income = F.when(F.col("sales_sign") == 1, F.col("revenue_mxn_net")).otherwise(0)
    cells = sales.groupBy(
        "channel",
        month_of(F.col("sale_date")).alias("month"),
        month_of(F.col("sale_date_if_utc")).alias("month_if_utc"),
    ).agg(
        F.sum("revenue_mxn_net").cast(TOTAL).alias("net"),
        F.sum("original_amount").cast(TOTAL).alias("all_types"),
        F.sum(income).cast(TOTAL).alias("income"),
    )

    def reading(variant: str, month: str, value: str) -> Column:
        return F.struct(F.lit(variant).alias("variant"), F.col(month).alias("month"), F.col(value).alias("value"))

    physical = F.array(
        reading(PRINCIPAL, "month", "net"),
        reading(ALL_TYPES, "month", "all_types"),
        reading(INCOME_ONLY, "month", "income"),
    )
    online = F.array(reading(PRINCIPAL, "month", "net"), reading(IF_UTC, "month_if_utc", "net"))
    return (
        cells.select("channel", F.inline(F.when(F.col("channel") == PHYSICAL, physical).otherwise(online)))
        .groupBy("variant", "channel", "month")
        .agg(F.sum("value").cast(TOTAL).alias("value"))
    )


def monthly_variants(
    sales: DataFrame, coverage: DataFrame, first_month: Column, last_month: Column, last_month_complete: Column
) -> DataFrame:
    """Every series over every month of the window, with growth and a note.

    A covered month without sales is zero, an uncovered one is NULL. The month
    before the window only serves as the base of the first one.
    """
    months = F.sequence(F.add_months(first_month, -1), last_month, F.make_ym_interval(F.lit(0), F.lit(1)))
    grid = (
        fixed_table(sales.sparkSession, SERIES, "variant, channel, source")
        .select("*", F.explode(months).alias("month"))
        .join(coverage, "source")
    )
    covered = F.col("month").between(month_of(F.col("first_date")), month_of(F.col("last_date")))
    in_order = Window.partitionBy("variant", "channel").orderBy("month")
    followed = (
        grid.join(monthly_series(sales), ["variant", "channel", "month"], "left")
        .withColumn("covered", covered)
        .withColumn("now", F.when(covered, F.coalesce("value", F.lit(0).cast(TOTAL))))
        .withColumn("before", F.lag("now").over(in_order))
        .withColumn("covered_before", F.lag("covered").over(in_order))
    )
    now, before = F.col("now"), F.col("before")
    return followed.where(F.col("month") >= first_month).select(
        "variant",
        "channel",
        "month",
        F.round(now, 2).alias("sales_mxn"),
        F.round(before, 2).alias("prev_sales_mxn"),
        percent_change(now, before).alias("mom_growth_pct"),
        F.when(~F.col("covered"), MONTH_UNCOVERED)
        .when(~F.col("covered_before"), PREVIOUS_UNCOVERED)
        .when(before == 0, ZERO_BASE)
        .when((F.col("month") == last_month) & ~last_month_complete, INCOMPLETE)
        .otherwise(FINE)
        .alias("growth_note"),
    )


def mom_growth(variants: DataFrame) -> DataFrame:
    """The principal series, and their total where both channels are known, from one reading of the series."""
    each = variants.where(F.col("variant") == PRINCIPAL).select(
        F.explode(F.array(F.col("channel"), F.lit(TOTAL_CHANNEL))).alias("channel"),
        "month",
        "sales_mxn",
        "prev_sales_mxn",
        "mom_growth_pct",
        "growth_note",
    )
    is_total = F.col("channel") == TOTAL_CHANNEL
    needed = F.when(is_total, 2).otherwise(1)

    def of_all(name: str) -> Column:
        return F.when(F.count(name) == needed, F.sum(name)).alias(name)

    now, before = F.col("sales_mxn"), F.col("prev_sales_mxn")
    note = F.when(now.isNull() | before.isNull(), CHANNEL_UNCOVERED).when(before == 0, ZERO_BASE).otherwise(FINE)
    return (
        each.groupBy("channel", "month")
        .agg(of_all("sales_mxn"), of_all("prev_sales_mxn"), F.max("mom_growth_pct").alias("own_pct"), F.max("growth_note").alias("own_note"))
        .select(
            "channel",
            "month",
            "sales_mxn",
            "prev_sales_mxn",
            F.when(is_total, percent_change(now, before)).otherwise(F.col("own_pct")).alias("mom_growth_pct"),
            F.when(is_total, note).otherwise(F.col("own_note")).alias("growth_note"),
        )
    )
