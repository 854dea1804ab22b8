"""Control totals taken from the sources on another path than the tables.

Text files are parsed line by line, arrays are measured before they are unnested.
Every total is one row (source, metric, dimension, value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.functions.literals import fixed_table
from trastienda.sources.files import POS_COLUMNS, text_schema

VALUE = "decimal(38,4)"
WIDE = "decimal(38,6)"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The data lines of a text file or folder, without the header of each file."""
    return spark.read.text(path).select(F.regexp_replace("value", r"[\r﻿]", "").alias("line"))


def _row(source: str, metric: str, dimension: Column, value: Column) -> Column:
    return F.struct(
        F.lit(source).alias("source"),
        F.lit(metric).alias("metric"),
        dimension.alias("dimension"),
        value.cast(VALUE).alias("value"),
    )


def _totals(frame: DataFrame, *rows: Column) -> DataFrame:
    return frame.select(F.inline(F.array(*rows)))


def _added_up(spark: SparkSession, rows: DataFrame, source: str, *whole: str) -> DataFrame:
    """Rows of the same metric and dimension as one; totals of a whole source are zero if it is empty."""
    empty = fixed_table(spark, [(source, metric, "", 0) for metric in whole], "source, metric, dimension, value")
    return (
        rows.unionByName(empty.withColumn("value", F.col("value").cast(VALUE)))
        .groupBy("source", "metric", "dimension")
        .agg(F.sum("value").cast(VALUE).alias("value"))
    )


def pos_totals(lines: DataFrame) -> DataFrame:
    """Rows, unreadable rows, and rows, amount and quantity per document type, from one pass."""
    header = ",".join(POS_COLUMNS)
    # As a generator the parser runs once per line, however many fields are used.
    parsed = lines.where((F.col("line") != header) & (F.col("line") != "")).select(
        F.inline(F.array(F.from_csv("line", text_schema(POS_COLUMNS), {"escape": '"'})))
    )
    read = parsed.select(
        F.coalesce("tipo_comprobante", F.lit("")).alias("doc_type"),
        F.col("monto").try_cast("decimal(28,6)").alias("amount"),
        F.col("cantidad").try_cast("int").alias("qty"),
    )
    per_type = read.groupBy("doc_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("amount").isNull() | F.col("qty").isNull()).alias("unreadable"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast(WIDE).alias("amount"),
        F.coalesce(F.sum(F.when(F.col("amount").isNotNull(), F.col("qty"))), F.lit(0)).alias("qty"),
    )
    rows = _totals(
        per_type,
        _row("pos", "rows", F.lit(""), F.col("n")),
        _row("pos", "unparseable_rows", F.lit(""), F.col("unreadable")),
        _row("pos", "rows_by_doc_type", F.col("doc_type"), F.col("n")),
        _row("pos", "amount_by_doc_type", F.col("doc_type"), F.col("amount")),
        _row("pos", "qty_by_doc_type", F.col("doc_type"), F.col("qty")),
    )
    return _added_up(lines.sparkSession, rows, "pos", "rows", "unparseable_rows")


def order_totals(orders: DataFrame) -> DataFrame:
    """Rows, and rows, amount and quantity per currency; reads three columns once."""
    per_currency = orders.groupBy("currency").agg(
        F.count("*").alias("n"),
        F.sum(F.col("amount").cast("string").try_cast("decimal(28,6)")).cast(WIDE).alias("amount"),
        F.sum(F.col("cantidad").cast("bigint")).alias("qty"),
    )
    rows = _totals(
        per_currency,
        _row("ecommerce", "rows", F.lit(""), F.col("n")),
        _row("ecommerce", "rows_by_currency", F.col("currency"), F.col("n")),
        _row("ecommerce", "amount_by_currency", F.col("currency"), F.col("amount")),
        _row("ecommerce", "qty_by_currency", F.col("currency"), F.col("qty")),
    ).where(F.col("dimension").isNotNull())
    return _added_up(orders.sparkSession, rows, "ecommerce", "rows")


def fx_totals(lines: DataFrame, header: str) -> DataFrame:
    data = lines.where((F.col("line") != header) & (F.col("line") != ""))
    return _totals(data.agg(F.count("*").alias("n")), _row("fx", "rows", F.lit(""), F.col("n")))


def erp_totals(documents: DataFrame) -> DataFrame:
    """Sizes of the arrays, and the sums over the stock values, before unnesting."""
    stock = F.transform("snapshots", lambda s: s["cantidad_en_stock"])
    whole_number = F.filter(stock, lambda v: F.coalesce(F.schema_of_variant(v) == "BIGINT", F.lit(False)))
    measured = documents.select(
        F.size("tiendas_info").alias("stores"),
        F.size("sku_mappings").alias("sku_mappings"),
        F.size("catalogo.productos").alias("products"),
        F.aggregate(
            "catalogo.productos", F.lit(0), lambda n, p: n + F.coalesce(F.json_array_length(F.try_element_at(p, F.lit("cost_history"))), F.lit(0))
        ).alias("cost_history"),
        F.size("snapshots").alias("snapshots"),
        F.size(F.filter(stock, lambda v: F.coalesce(v.cast("string") == "N/A", F.lit(False)))).alias(
            "snapshots_na_string"
        ),
        F.aggregate(whole_number, F.lit(0).cast("bigint"), lambda n, v: n + v.cast("bigint")).alias(
            "snapshots_stock_sum"
        ),
    )
    names = measured.columns
    # A document without a block has size -1 or NULL there; it adds nothing.
    sums = measured.agg(
        *[
            F.coalesce(F.sum(F.col(c) if c == "snapshots_stock_sum" else F.greatest(F.col(c), F.lit(0))), F.lit(0)).alias(c)
            for c in names
        ]
    )
    return _totals(sums, *[_row("erp", c, F.lit(""), F.col(c)) for c in names])
