"""CSV export of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BYTE_ORDER_MARK = "﻿"


def export_csv(frame: DataFrame, path: str) -> None:
    """Write a folder of UTF-8 CSV parts with header.

    Lists become JSON text, and a byte order mark leads each header so that
    spreadsheets read accents right.
    """
    flat = frame.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.StructType)) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )
    first, *others = flat.columns
    named = flat.toDF(BYTE_ORDER_MARK + first, *others)
    named.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
