"""Session defaults and the shared scratch area."""

from __future__ import annotations

import atexit
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import wraps
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(app: str = "mdlake", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the defaults the jobs expect; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Fixed value: the JVM does not compile longer methods, it interprets them.
METHOD_BYTES = 8000
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def in_short_methods(job: Callable) -> Callable:
    """A job on a lake whose steps Spark evaluates in methods that the JVM compiles.

    Cleaning a wide table makes one method of all its columns' rules, longer than the JVM compiles. Below the limit that
    is set while the job runs, Spark splits such a step into several methods.
    """

    @wraps(job)
    def run(lake, *args, **kwargs):
        conf = lake.spark.conf
        before = conf.get(METHOD_LIMIT)
        conf.set(METHOD_LIMIT, str(min(int(before), METHOD_BYTES)))
        try:
            return job(lake, *args, **kwargs)
        finally:
            conf.set(METHOD_LIMIT, before)

    return run


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder, deleted when the driver program ends."""
    path = f"{shared_root(spark)}/mdlake-{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(delete_scratch)  # runs before the session's own shutdown, which was registered earlier
    _scratch.append((spark, path))
    return path


def delete_scratch() -> None:
    """Delete all scratch folders of sessions that still run; frames that read from them end with it."""
    while _scratch:
        spark, path = _scratch.pop()
        if spark.sparkContext._jsc is not None:
            delete_folder(spark, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, so lost executors cannot change the rows."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A few driver-side rows as a local relation, which needs no job of its own."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = [pa.array([r[i] for r in rows], type=arrow.field(i).type) for i in range(len(struct))]
    return spark.createDataFrame(pa.table(columns, schema=arrow), struct)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(folder)] if system.exists(folder) else []


def delete_folder(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))


def move_file(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file into place unless there is one already; false if there is. Folders are made as needed."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    old, new = hadoop.Path(source), hadoop.Path(target)
    system = new.getFileSystem(conf)
    system.mkdirs(new.getParent())
    context = hadoop.FileContext.getFileContext(system.getUri(), conf)
    careful = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)  # no option: nothing is overwritten
    try:
        context.rename(old, new, careful)
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


@contextmanager
def staged(df: DataFrame, name: str, reader: SparkSession | None = None) -> Iterator[DataFrame]:
    """Evaluate once into parquet in the shared folder and read from there.

    A batch is used several times (touched partitions, distinct keys, rows). Staging parses the landed
    text once, lets later passes read single columns, and fixes the rows whatever executors get lost.
    ``reader`` is the session to go on with, if another than the one that evaluates ``df``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield (reader or df.sparkSession).read.schema(df.schema).parquet(path)
    finally:
        delete_folder(df.sparkSession, path)
