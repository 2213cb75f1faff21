"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from typing import Any

import pyarrow as pa
from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

#: Fits (of different models) that run at the same time.
OVERLAPPED = 4


def get_spark(app: str = "plumbline", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the library is tested with.

    A master that spark-submit gave is kept, with whatever else it set: nothing in the
    library depends on these settings except adaptive execution (on by default in Spark).
    """
    given, local = SparkConf(), {"spark.master": f"local[{cores}]"}
    if not given.contains("spark.master"):
        local |= {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        }
    local |= {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC"}
    builder = SparkSession.builder.appName(app)
    for key, value in local.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder named in ``spark.checkpoint.dir``.

    A machine-local folder is only used by a local session that names none; a
    cluster session without a shared folder is an error, since tasks on other
    machines could not read what was written.
    """
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def shared_folder(spark: SparkSession) -> str:
    """The library's folder in the shared one, which other processes that name the same folder also see."""
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    base = base or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="plumbline-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/plumbline"


def small_frame(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A DataFrame from a bounded number of driver rows (fitted parameters, summaries)."""
    schema: StructType = _parse_datatype_string(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrow_schema = to_arrow_schema(schema)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow_schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow_schema), schema=schema)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of tables that nobody holds any more: it does so once the driver has collected its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def overlapped(work: Callable[[Any], Any], items: Iterable) -> list:
    """``work`` of each item, in their order, a few at a time: many small jobs of one then run between the tasks of another.

    Items start in their order, each once the one before has had a moment; what is there already is not waited for long.
    """
    with ThreadPoolExecutor(OVERLAPPED) as pool:
        found = []
        for item in items:
            found.append(pool.submit(work, item))
            wait(found[-1:], timeout=0.2)
        return [f.result() for f in found]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table its owner no longer needs, in whatever file system it is."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a folder in one step; False if the target is there already."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path(target).getParent())
    return not files.exists(path(target)) and files.rename(path(source), path(target))
