"""Session helpers: local sessions for tests, and the one way the library cuts lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
_SHIPPED: set[str] = set()


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter's own session is used instead."""
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    spark = SparkSession.builder.master(f"local[{cores}]").appName("voxloom").config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it.

    A folder of our own is made only if the session has none and runs in local mode; on a cluster a
    machine-local folder would be lost with its machine, so an unset folder is an error there.
    """
    sc = spark.sparkContext
    if (known := sc.getCheckpointDir()) is not None:
        return known
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="voxloom-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """df computed once into a columnar table in the shared folder, and read back.

    It survives lost executors and ends the lineage: what follows is planned from a plain scan. A table
    rather than checkpoint(), whose plans keep the constraints of all that went before; over many rounds of
    an iteration those grow until the driver's memory is full.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark)
    if root not in _ROOTS:
        _ROOTS[root] = f"{root}/voxloom-{uuid.uuid4().hex}"
        atexit.register(_clean, spark, _ROOTS[root])
    path = f"{_ROOTS[root]}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


cut = stored


def forget(*tables: DataFrame) -> None:
    """Deletes tables of stored() that nothing reads any more: those of past rounds, once the next round's are written."""
    for df in tables:
        path = getattr(df, "_stored_at", None)
        if path is not None:
            _clean(df.sparkSession, path)


def _clean(spark: SparkSession, folder: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # the session may be gone already; the folder's owner cleans it then
        pass


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship(spark: SparkSession) -> None:
    """Makes the package importable in the workers of this application, wherever they run; once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = Path(__file__).parent
    path = Path(tempfile.mkdtemp(prefix="voxloom-code-"), "voxloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
