"""Session defaults and the shared work folder.

Written intermediate tables live in the folder that the session names in
``spark.checkpoint.dir``: every executor sees it, so a lost executor costs a
retry and never a table.  Only where the setting is absent (tests, a laptop)
is a folder of our own created.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("budgetloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process, so that a folder of the machine is shared by all."""
    return master == "local" or master.startswith("local[")


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables, as ``spark.checkpoint.dir`` names it.

    On a cluster the setting is required: a folder of one machine would leave
    each executor with its own part of a table.  Only a session within one
    process (tests, a laptop) gets a folder of its own where it is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not is_local(master):
            raise RuntimeError(f"spark.checkpoint.dir has to name a folder that all executors of {master} share")
        root = tempfile.mkdtemp(prefix="budgetloom-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
        atexit.register(shutil.rmtree, root, True)
    return root.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table.

    It cuts the lineage (an expensive stage is never run twice) and survives
    the loss of executors.  ``discard`` removes it; what is left goes at exit.
    """
    spark = df.sparkSession
    path = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written._stash = path
    _written[path] = spark
    return written


def discard(*stashed: DataFrame) -> None:
    """Remove written tables that no later plan reads, on whatever file system they lie."""
    for df in stashed:
        path = getattr(df, "_stash", None)
        if path and _written.pop(path, None) is not None:
            _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@atexit.register
def _clean() -> None:
    for path, spark in _written.items():
        try:
            _remove(spark, path)
        except Exception:  # the gateway is gone already; a local folder can still be removed
            if path.startswith(("file:", "/")):
                shutil.rmtree(path.removeprefix("file://").removeprefix("file:"), ignore_errors=True)


#: Bytes of a shuffle partition that is sized by its data.
PART_BYTES = 64 << 20


def parts_of(df: DataFrame, size: int) -> int:
    """Shuffle partitions for so many bytes: the session's number, or more where the data ask for it."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(size) // PART_BYTES))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, wherever they run and whatever their path is."""
    context = spark.sparkContext
    if getattr(context, "_budgetloom_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="budgetloom-code-")  # on the driver; Spark's file server hands it out
    atexit.register(shutil.rmtree, folder, True)
    root = Path(__file__).resolve().parent
    with zipfile.ZipFile(f"{folder}/budgetloom_code.zip", "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    context.addPyFile(f"{folder}/budgetloom_code.zip")
    context._budgetloom_shipped = True


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table: a parquet file, or a folder of them."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
