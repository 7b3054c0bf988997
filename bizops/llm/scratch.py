"""Shared folders for intermediate tables and files of one run.

Everything lies below the folder that ``spark.checkpoint.dir`` names, which the driver and all
executors share, so a lost executor loses no finished part.  The owner of a ``Scratch`` closes it
when its results are complete, and closing removes the folder.
"""

from __future__ import annotations

import io
import pathlib
import uuid
import zipfile

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

import bizops
from bizops.session import storage, use_checkpoint_dir

__all__ = ["Scratch", "ship_package", "spread", "storage", "write_once"]

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Once per application, send this package's source to the executors' Python.

    Needed where the package is not installed on the executors; harmless where it is.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = pathlib.Path(bizops.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, f"{root.name}/{file.relative_to(root)}")
    folder, name = use_checkpoint_dir(spark).rstrip("/"), f"{root.name}-{uuid.uuid4().hex}.zip"
    fs, path = storage(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/{name}") as out:
        out.write(packed.getvalue())
    sc.addPyFile(f"{folder}/{name}")
    _SHIPPED.add(sc.applicationId)


def spread(df: DataFrame) -> int:
    """Partitions for small rows that stand for much work, such as files to be read: the session's
    number, given explicitly so that adaptive execution does not merge them by their size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def write_once(folder: str, name: str, data) -> str:
    """Write one file so that a retried or speculative task never leaves a half-written one.

    ``data`` is bytes, or a function that gets the open file and writes it.  Every attempt writes
    a name of its own; the caller records the returned name, so only a successful attempt's file
    is ever read.
    """
    fs, path = storage(folder)
    fs.create_dir(path, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(f"{path}/{name}") as out:
        data(out) if callable(data) else out.write(data)
    return name


class Scratch:
    """A folder of one run, removed by ``close``; usable as a context manager."""

    def __init__(self, spark: SparkSession, name: str = "llm"):
        ship_package(spark)
        self.spark = spark
        self.root = f"{use_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._tables = 0

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, df: DataFrame, name: str = "table", by: str | None = None, codec: str = "zstd") -> DataFrame:
        """Write ``df`` as Parquet, in folders by the column ``by`` if given, and read it back:
        later readers start from the files."""
        self._tables += 1
        path = self.path(f"{name}-{self._tables}")
        writer = df.write.option("compression", codec)
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        fs, path = storage(self.root)
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)

    def finish(self, df: DataFrame) -> DataFrame:
        """Complete a result, then remove the folder it was made from.

        The result itself is checkpointed; Spark's cleaner owns those files and removes them with
        the data frame where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
        """
        use_checkpoint_dir(self.spark)
        done = df.checkpoint(eager=True)
        self.close()
        return done

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.close()
