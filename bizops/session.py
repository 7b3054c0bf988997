"""Session settings, lineage cuts and scratch tables shared by all operators."""

from __future__ import annotations

import atexit
import uuid

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

# Run-time re-planning.  forceOptimizeSkewedJoin lets Spark split a hot join key even when the next
# aggregate could have reused the join's partitioning: an extra exchange beats one endless task.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
LOCAL_SCRATCH = "/tmp/bizops-scratch"

_SCRATCH: dict[str, str] = {}  # application id -> its scratch folder


def tune(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Switch on adaptive execution and skew splitting for this session.

    ``shuffle_partitions`` is the number that shuffles start from before adaptive execution merges
    the small ones; without it the session's own setting stays.
    """
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def storage(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path behind a folder name, on the driver or an executor."""
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if "://" in uri:
        return pafs.FileSystem.from_uri(uri)
    return pafs.LocalFileSystem(), uri


def use_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which the driver and all executors share.

    Only a local master, where they share one disk, may do without the setting; on a cluster a
    missing one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = LOCAL_SCRATCH
    sc.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """The application's own scratch folder below the shared one.

    It belongs to the application: ``clear_scratch`` removes it once the results that were made
    from it have been read, and at the latest it goes when the driver's Python ends.
    """
    app = spark.sparkContext.applicationId
    if app not in _SCRATCH:
        _SCRATCH[app] = f"{use_checkpoint_dir(spark).rstrip('/')}/bizops-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, app)
    return _SCRATCH[app]


def clear_scratch(spark: SparkSession) -> None:
    """Remove everything that queries of this application have left in scratch so far."""
    _remove(spark.sparkContext.applicationId)


def _remove(app: str) -> None:
    folder = _SCRATCH.pop(app, None)
    if folder:
        fs, path = storage(folder)
        if fs.get_file_info(path).type == pafs.FileType.Directory:
            fs.delete_dir(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's scratch folder."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in scratch and read it back.

    Several branches can then read it, each only its columns; the files lie in the shared folder,
    so losing executors loses nothing.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise an already reduced table reliably, so several branches can read it."""
    return written_table(df, "cut")
