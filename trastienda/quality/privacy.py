"""Personal data outside the raw layer: by column name and by value."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Name fragments that give personal columns away, and the text
# pattern of a tax number or an e-mail address.
NAME_FRAGMENTS = ("customer", "email", "rfc", "address", "shipping", "cliente", "direccion")
TAX_NUMBER = r"[A-ZÑ&]{3,4}[0-9]{6}[A-Z0-9]{3}"
# one character before the @ is enough to tell that there are some, and a long run isn't tried again and again
MAIL = r"[^@\s]@[^@\s]+\.[a-z]{2,}"


def has_personal_name(column: str) -> bool:
    return any(fragment in column.lower() for fragment in NAME_FRAGMENTS)


def personal_value(text: Column) -> Column:
    return text.rlike(TAX_NUMBER) | (F.contains(text, F.lit("@")) & text.rlike(MAIL))


def personal_columns(tables: dict[str, DataFrame]) -> list[tuple[str, str]]:
    """Table and column of every column whose name suggests personal data."""
    return [(name, c) for name, frame in tables.items() for c in frame.columns if has_personal_name(c)]


def personal_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table and text column: whether its name is personal, and its cells with personal data.

    Each table is read once for all of its text columns, and only counts leave the
    tasks.
    """
    scans = []
    for name, frame in tables.items():
        texts = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
        if not texts:
            continue
        counted = frame.agg(*[F.count_if(personal_value(F.col(c))).alias(c) for c in texts])
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.lit(has_personal_name(c)).alias("personal_name"),
                F.col(c).alias("hits"),
            )
            for c in texts
        ]
        scans.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, scans)
