"""The nested inventory export: documents with five blocks, unnested into tables.

An export is either one JSON document or JSON Lines in which every line is a
document holding some of the blocks. Lines are split over tasks; one document is
a single task up to the unnesting unless `json_split.as_lines` deals it out as lines first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# An entry of a block with all of its fields as text, whatever they are called; nested values are JSON text.
ENTRIES = "ARRAY<MAP<STRING, STRING>>"
# The blocks of the export, and the fields that later layers read.
BLOCKS = {
    "metadata": "MAP<STRING, STRING>",
    "tiendas_info": ENTRIES,
    "sku_mappings": ENTRIES,
    "catalogo": f"STRUCT<productos: {ENTRIES}>",
    "snapshots": "ARRAY<STRUCT<fecha: STRING, tienda_id: STRING, sku_erp: STRING, cantidad_en_stock: VARIANT>>",
}
FIELDS = {
    "stores": ("tienda_id", "ciudad", "region", "timezone"),
    "sku_mappings": ("sku_pos", "sku_erp", "handle"),
    "products": ("sku_erp", "nombre", "categoria"),
    "cost_history": ("fecha_vigencia", "costo_mxn", "proveedor"),
}
COSTS = "cost_history"


def document_schema(*blocks: str) -> str:
    return ", ".join(f"{b} {BLOCKS[b]}" for b in (blocks or tuple(BLOCKS)))


def read_documents(spark: SparkSession, path: str, *blocks: str) -> DataFrame:
    """The documents of an export with the named blocks; other blocks are not materialised."""
    lines = path.rstrip("/").endswith(("jsonl", "ndjson"))
    return (
        spark.read.schema(document_schema(*blocks))
        .option("multiLine", not lines)
        .option("mode", "FAILFAST")
        .json(path)
    )


# Variant types and the type names the staging rules look for.
JSON_TYPES = {
    "VOID": "NoneType",
    "BIGINT": "int",
    "STRING": "str",
    "BOOLEAN": "bool",
    "DECIMAL": "float",
    "DOUBLE": "float",
    "FLOAT": "float",
    "ARRAY": "list",
    "OBJECT": "dict",
}


def json_type(value: Column) -> Column:
    """The JSON type of a variant value, so that `5` and `"5"` stay apart."""
    names = F.create_map(*[F.lit(x) for pair in JSON_TYPES.items() for x in pair])
    kind = F.regexp_extract(F.coalesce(F.schema_of_variant(value), F.lit("VOID")), "^([A-Z]+)", 1)
    return F.try_element_at(names, kind)


def as_columns(entries: DataFrame, known: tuple[str, ...], without: tuple[str, ...] = (), keys: tuple[str, ...] = ()) -> DataFrame:
    """A text column for every field that any `entry` has: the known ones first, then the others by name.

    One pass merges the field names, of which each task passes on one of a kind; a field that only some
    entries have is NULL in the rest. Names that differ in case alone are one column. `keys` are kept in front.
    """
    names = [r[0] for r in entries.select(F.explode(F.map_keys("entry"))).distinct().collect()]
    columns = {name.lower(): [name] for name in known}
    taken = {name.lower() for name in (*without, *keys)}
    for name in sorted(names):
        same = columns.setdefault(name.lower(), [])
        if name not in same:
            same.append(name)
    read = [F.coalesce(*[F.try_element_at("entry", F.lit(n)) for n in same]).alias(same[0]) for lower, same in columns.items() if lower not in taken]
    return entries.select(*keys, *read)


def stores(documents: DataFrame) -> DataFrame:
    return as_columns(documents.select(F.explode("tiendas_info").alias("entry")), FIELDS["stores"])


def sku_mappings(documents: DataFrame) -> DataFrame:
    return as_columns(documents.select(F.explode("sku_mappings").alias("entry")), FIELDS["sku_mappings"])


def products(documents: DataFrame) -> DataFrame:
    return as_columns(documents.select(F.explode("catalogo.productos").alias("entry")), FIELDS["products"], without=(COSTS,))


def cost_history(documents: DataFrame) -> DataFrame:
    """One row per product and cost entry, with the product key of the outer level.

    The entries are parsed as variants, which keep numbers of any length, and then written as text.
    """
    product = documents.select(F.explode("catalogo.productos").alias("product"))
    parsed = F.from_json(F.try_element_at("product", F.lit(COSTS)), "ARRAY<MAP<STRING, VARIANT>>")
    entries = F.explode(F.transform(parsed, lambda e: F.transform_values(e, lambda _, value: value.cast("string"))))
    costs = product.select(F.try_element_at("product", F.lit("sku_erp")).alias("sku_erp"), entries.alias("entry"))
    return as_columns(costs, FIELDS[COSTS], keys=("sku_erp",))


def snapshots(documents: DataFrame) -> DataFrame:
    """One row per snapshot; the mixed stock value as text plus its JSON type."""
    return documents.select(F.inline("snapshots")).select(
        "fecha",
        "tienda_id",
        "sku_erp",
        F.col("cantidad_en_stock").cast("string").alias("cantidad_en_stock"),
        json_type(F.col("cantidad_en_stock")).alias("cantidad_json_type"),
    )


def metadata(documents: DataFrame) -> DataFrame:
    """One text row per document that has the block, with a column for each key of it."""
    present = documents.where(F.col("metadata").isNotNull())
    keys = sorted(r[0] for r in present.select(F.explode(F.map_keys("metadata"))).distinct().collect())
    return present.select(*[F.try_element_at("metadata", F.lit(k)).alias(k) for k in keys])
