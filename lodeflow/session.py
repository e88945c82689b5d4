"""Session helpers: table access, the shared checkpoint folder, and code shipping."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch at most, as whole texts make wide rows, and bytes of one of whole files.
BATCH_ROWS = 1000
BATCH_BYTES = 64 << 20
_shipped: set[str] = set()
PACKAGE_ROOT = str(Path(__file__).resolve().parents[1])


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package, and give the session a checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` is used where the cluster sets one; only a
    session without the setting (a bare local test) gets a temporary folder.
    """
    sc = spark.sparkContext
    _ship(sc)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(checkpoint_dir(spark))
    return spark


def limit_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on an Arrow batch of this session holds ``most`` bytes at most, or one row: for rows of whole files."""
    if not 0 < _bytes(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= most:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def _bytes(size: str) -> int:
    """Plain numbers of bytes; a size with a unit is someone's choice and counts as small enough."""
    digits = size.lower().removesuffix("b")
    return int(digits) if digits.lstrip("-").isdigit() else 1


def _ship(sc) -> None:
    """Send the package's source to the executors, once a session; on a local master its own folder is enough."""
    if sc.applicationId in _shipped:
        return
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        path = sc.environment.get("PYTHONPATH", "")
        sc.environment["PYTHONPATH"] = f"{PACKAGE_ROOT}:{path}" if path else PACKAGE_ROOT
    else:
        folder = tempfile.mkdtemp(prefix="lodeflow-")  # the driver's own; executors fetch the file from the driver
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = f"{folder}/lodeflow.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(Path(PACKAGE_ROOT, "lodeflow").rglob("*.py")):
                z.write(f, f.relative_to(PACKAGE_ROOT))
        sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one where it is unset and the master is local."""
    found = spark.conf.get("spark.checkpoint.dir", "")
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="lodeflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/lodeflow-{name}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out evenly over all cores: a small file is one task's, however much work its rows make."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism)


def settle(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder, which outlives a lost executor."""
    prepare(df.sparkSession)
    return df.checkpoint()


def tidy(spark: SparkSession) -> None:
    """Let Spark delete files of shuffles, and where it is told to those of checkpoints, that no frame refers to any more: it waits for the driver's garbage to be collected, which a large heap puts off."""
    gc.collect()
    time.sleep(0.5)  # the JVM is told by a thread of its own what Python has let go
    spark.sparkContext._jvm.System.gc()


def few(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A side of a join that is broadcast if it has at most ``rows`` narrow rows, which are counted."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that is never broadcast: an estimate goes by the size of files, which says little of rows that repeat in them, and the driver would hold them all."""
    return df.hint("merge")
