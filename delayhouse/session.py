"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# What results depend on. Everything else (sizes, adaptive execution, code generation, write modes) stays with the caller.
_RUNTIME = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}

# And what the layout of the lookups depends on: tables dealt out by date and chunk are joined where they lie, also on more columns.
_LAYOUT = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}

# The JVM never compiles a method above 8000 bytes of bytecode. Wide projections that would produce one fall back to
# generated code that is split into small methods, which is much faster. Set for local sessions only.
_LOCAL = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results and layouts depend on to an existing session."""
    for key, value in (_RUNTIME | _LAYOUT).items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "delayhouse", memory: str = "8g", **conf: str) -> SparkSession:
    """A single-machine session for tests and the bench. Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in (_LOCAL | conf).items():
        builder = builder.config(key, value)
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    # The setting cannot be changed in a running session, so the folder is kept with the session it was made for.
    return _own_folder(spark.sparkContext.applicationId)


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="delayhouse-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{scratch_root(spark)}/delayhouse/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


#: Writer options of the flight tables, which are written and read once or twice: bytes count more than the little time this takes.
COMPACT = {"compression": "zstd"}


def staged(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage so that several consumers share one computation, survives executor loss (unlike
    blocks kept on executors) and gives the planner the true size, on which broadcast is decided.
    The folder stays, as the result is lazy; a job that is done with its stages uses :class:`Stages`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compactly_staged(df: DataFrame, name: str) -> DataFrame:
    """As :func:`staged`, in few bytes."""
    return staged(df, name, **COMPACT)


class Stages:
    """Staged tables of one job, written with the given options; they are removed when the job ends, however it ends."""

    def __init__(self, spark: SparkSession, **options) -> None:
        self._spark, self._paths, self._options = spark, [], options

    def __enter__(self) -> Stages:
        return self

    def add(self, df: DataFrame, name: str, **options) -> DataFrame:
        """Write ``df``, with options of the Parquet writer, and read it back."""
        path = scratch_path(self._spark, name)
        self._paths.append(path)
        df.write.options(**(self._options | options)).mode("errorifexists").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *_) -> None:
        for path in self._paths:
            remove(self._spark, path)
