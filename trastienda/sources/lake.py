"""Layer tables: one database per layer, Parquet files under one shared folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trastienda.session import shared_folder

# The layers.
LAYERS = ("raw", "stg", "core", "mart", "audit")


@dataclass
class Lake:
    """Writes and reads layer tables; every write replaces the table.

    `root` is the folder of the Parquet files, by default below the shared folder
    of the session. `prefix` keeps the databases of several lakes apart.

    A run writes into a draft, which has a folder and databases of its own. What readers see are views in
    the layers' databases; they stay on the former run until `publish` turns them to the draft's tables.
    """

    spark: SparkSession
    root: str | None = None
    prefix: str = ""
    #: Of a draft: its run, which is part of the names of its databases.
    run: str = ""

    def __post_init__(self) -> None:
        self.root = (self.root or f"{shared_folder(self.spark)}/trastienda").rstrip("/")
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}")

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}_{self.run}" if self.run else f"{self.prefix}{layer}"

    def draft(self, run: str) -> Lake:
        """A lake for one run, which nobody else reads until it is published."""
        return Lake(self.spark, f"{self.root}/{run}", self.prefix, run.lower())

    def publish(self) -> None:
        """Turn the views of all layers to this draft's tables, then forget the views of tables it doesn't have."""
        for layer in LAYERS:
            seen, drafted = f"{self.prefix}{layer}", set(self._names(self.database(layer)))
            for name in sorted(drafted):
                if self._kind(seen, name) not in (None, "VIEW"):
                    self.spark.sql(f"DROP TABLE {seen}.{name}")
                self.spark.sql(f"CREATE OR REPLACE VIEW {seen}.{name} AS SELECT * FROM {self.database(layer)}.{name}")
            for name in set(self._names(seen)) - drafted:
                self.spark.sql(f"DROP {'VIEW' if self._kind(seen, name) == 'VIEW' else 'TABLE'} {seen}.{name}")

    def _names(self, database: str) -> list[str]:
        return [t.name for t in self.spark.catalog.listTables(database) if not t.isTemporary]

    def _kind(self, database: str, name: str) -> str | None:
        return next((t.tableType for t in self.spark.catalog.listTables(database) if t.name == name and not t.isTemporary), None)

    def write(
        self,
        layer: str,
        table: str,
        frame: DataFrame,
        partition_by: tuple[str, ...] = (),
        append: bool = False,
    ) -> DataFrame:
        """Store a table and return it as read from its files, so lineage ends here."""
        if partition_by:
            # Rows of one partition meet in few tasks; AQE splits a large one.
            frame = frame.hint("rebalance", *[F.col(c) for c in partition_by])
        writer = (
            frame.write.format("parquet")
            .mode("append" if append else "overwrite")
            .option("path", f"{self.root}/{self.database(layer)}/{table}")
        )
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(f"{self.database(layer)}.{table}")
        return self.table(layer, table)

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(f"{self.database(layer)}.{table}")

    def tables(self, *layers: str) -> dict[str, DataFrame]:
        """Every stored table of the layers, by `layer.table`."""
        return {
            f"{layer}.{name}": self.table(layer, name)
            for layer in layers
            for name in self._names(self.database(layer))
        }

    def drop(self) -> None:
        """Forget a draft's tables and their files, unless views still read them."""
        if not self.run:
            raise ValueError("only the draft of a run can be dropped")
        for layer in LAYERS:
            seen = f"{self.prefix}{layer}"
            for name in self._names(seen):
                if self._kind(seen, name) == "VIEW" and f"{self.database(layer)}.{name}" in self.spark.sql(f"SHOW CREATE TABLE {seen}.{name}").first()[0]:
                    raise ValueError(f"{seen}.{name} reads this run")
            self.spark.sql(f"DROP DATABASE {self.database(layer)} CASCADE")
        system, path = fs.FileSystem.from_uri(self.root)
        if system.get_file_info(path).type == fs.FileType.Directory:
            system.delete_dir(path)
