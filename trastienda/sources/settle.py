"""Write an intermediate table, or a text delivery, once where a query reads it several times."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from trastienda.session import shared_folder

#: The folders that the run of this thread has made; None outside of `dropped_at_end`.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def settle(frame: DataFrame, codec: str | None = None) -> DataFrame:
    """The frame as Parquet files in the shared folder: computed once, safe if executors are lost."""
    path = _new_folder(frame, "parquet")
    writer = frame.write if codec is None else frame.write.option("compression", codec)
    writer.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def settle_only(build: Callable[[], DataFrame]) -> DataFrame:
    """What `build` returns, settled; what was settled on the way to it is deleted."""
    outer = _made.get()
    with dropped_at_end():
        frame = build()
        inner = _made.set(outer)
        try:
            return settle(frame)
        finally:
            _made.reset(inner)


def settle_all(builders: dict[str, Callable[[], DataFrame]], side_by_side: int = 4) -> dict[str, DataFrame]:
    """Tables that do not read each other, built and written side by side to fill idle slots.

    They are packed tightly, and what was shuffled for them is deleted once they are stored.
    """
    with ThreadPoolExecutor(side_by_side) as pool:
        written = {name: pool.submit(copy_context().run, lambda build=build: settle(build(), "zstd")) for name, build in builders.items()}
        tables = {name: done.result() for name, done in written.items()}
    if tables:
        _free_shuffles(next(iter(tables.values())).sparkSession)
    return tables


def _free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of ended jobs when the driver collects its garbage, which it may not do for long.

    The listeners' queue holds on to the last query until another one ends, so a tiny one is run first.
    """
    spark.sql("SELECT 1").collect()
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def settle_lines(frame: DataFrame, kind: str, packed: bool = False) -> str:
    """A one-column table as text files in the shared folder; the folder name ends with `kind`.

    Packed files are read whole, by as many tasks as have written them; files that are read in ranges must not be packed.
    """
    path = _new_folder(frame, kind)
    frame.write.text(path, compression="gzip" if packed else None)
    return path


@contextmanager
def dropped_at_end() -> Iterator[None]:
    """Delete at the end what was settled inside, by this thread or for it; for jobs that have stored all that read it."""
    made: list[str] = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        for folder in made:
            try:
                system, path = fs.FileSystem.from_uri(folder)
            except (pa.ArrowInvalid, OSError):  # a file system that pyarrow doesn't know keeps its folders
                continue
            if system.get_file_info(path).type == fs.FileType.Directory:
                system.delete_dir(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder in the shared one for what a job writes by itself; it goes with what is settled."""
    folder, made = f"{shared_folder(spark)}/{name}", _made.get()
    if made is not None:
        made.append(folder)
    return folder


def _new_folder(frame: DataFrame, kind: str) -> str:
    return new_folder(frame.sparkSession, f"settled-{uuid.uuid4().hex}.{kind}")
