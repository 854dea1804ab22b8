"""Product keys: every system writes the same number in its own format."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeyFormats:
    """How each system spells a product number (group 1 is the number)."""

    # The key formats of the three source systems.
    pos: str = r"^CN-(\d{5})$"
    erp: str = r"^ERP-PROV-MX-(\d{3})-[A-Z]$"
    handle: str = r"-(\d{3})$"
    number_type: str = "int"
    handle_digits: int = 3


def key_number(text: Column, pattern: str, number_type: str = "int") -> Column:
    """The number inside a key, NULL where the key has another format."""
    return F.regexp_extract(text, pattern, 1).try_cast(number_type)


def slug(name: Column) -> Column:
    """Lower case with dashes; accents stay."""
    return F.lower(F.replace(name, F.lit(" "), F.lit("-")))


def expected_handle(name_slug: Column, number: Column, digits: int = 3) -> Column:
    """The web handle a product must have: its slug and its number, with zeros up to `digits`; longer numbers stay whole."""
    text = number.cast("string")
    return F.concat(name_slug, F.lit("-"), F.lpad(text, F.greatest(F.length(text), F.lit(digits)), F.lit("0")))


def differs(left: Column, right: Column) -> Column:
    """Inequality in which NULL is a value."""
    return ~left.eqNullSafe(right)
