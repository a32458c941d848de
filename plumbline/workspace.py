"""Where jobs keep tables between stages: a folder every executor can reach.

Intermediate results that are read more than once are written there as Parquet. A written table
survives lost executors, cuts the lineage, and lets each reader prune columns.
"""

from __future__ import annotations

import gc
import logging
import re
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

logger = logging.getLogger(__name__)

_WORKSPACES: dict[str, "Workspace"] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for local, unset sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="plumbline-")
    context.setCheckpointDir(root)
    return root


def _trim_native_heap(gateway) -> None:
    """The diagnostic command System.trim_native_heap, called through the interface of the server
    of management beans: its class itself is not open to callers."""
    jvm = gateway.jvm
    find = jvm.java.lang.Class.forName

    def array(kind, *values):
        made = gateway.new_array(kind, len(values))
        for i, value in enumerate(values):
            made[i] = value
        return made

    names = "javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"
    invoke = find("javax.management.MBeanServer").getMethod("invoke", array(jvm.java.lang.Class, *map(find, names)))
    bean = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    nothing = array(jvm.java.lang.Object), array(jvm.java.lang.String)
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    invoke.invoke(server, array(jvm.java.lang.Object, bean, "systemTrimNativeHeap", *nothing))


def collect_executors(spark: SparkSession) -> None:
    """A garbage collection in the JVM of every task of a small job, one task per core."""
    slots = spark.sparkContext.defaultParallelism
    collected = F.java_method(F.lit("java.lang.System"), F.lit("gc"))
    spark.range(0, slots, 1, slots).select(collected).write.format("noop").mode("overwrite").save()


class Workspace:
    """Staged tables of one Spark application; results to keep are written to the caller's paths."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_root(spark)}/plumbline-{spark.sparkContext.applicationId}"
        self._made: dict[tuple, object] = {}
        self._paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
        # Staged tables are scratch: the folder goes when the application ends.
        location, files = self._located(self.root)
        files.mkdirs(location)
        files.deleteOnExit(location)

    def _located(self, path: str):
        location = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return location, location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    @classmethod
    def of(cls, spark: SparkSession) -> "Workspace":
        app = spark.sparkContext.applicationId
        if app not in _WORKSPACES:
            _WORKSPACES[app] = cls(spark)
        return _WORKSPACES[app]

    def new_path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a reader of what was written."""
        path = self.new_path(name)
        df.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths[staged] = path
        return staged

    def discard(self, *staged: DataFrame) -> None:
        """Delete staged tables, once all that is read from them has been written."""
        for df in staged:
            location, files = self._located(self._paths.pop(df))
            files.delete(location, True)

    def release(self, executors: bool = False) -> None:
        """Let go of the shuffles and broadcasts of finished queries. Spark removes them when the
        driver collects their handles, which it puts off while it has room. Each of the many
        threads that ran them also leaves freed memory with the C library, which is told to give it
        back; a JVM that cannot is left alone. ``executors`` are collected as well if wanted: beside
        their Python workers, a heap of garbage from one stage leaves the next one less room."""
        gc.collect()
        context = self.spark.sparkContext
        context._jvm.System.gc()
        try:
            _trim_native_heap(context._gateway)
        except Py4JError:
            logger.debug("this JVM does not trim its native heap")
        if executors and not re.match(r"local(\[|$)", context.master):
            collect_executors(self.spark)

    def once(self, key: tuple, build: Callable[[], object]) -> object:
        """Build something on first use and remember it for this application."""
        if key not in self._made:
            self._made[key] = build()
        return self._made[key]


def input_version(spark: SparkSession, paths: Iterable[str]) -> str:
    """A short text that changes when files under ``paths`` are added, removed or rewritten.

    Asks the file system for totals (file count, bytes, time of the last change) instead of
    listing every file.
    """
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for path in paths:
        location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = location.getFileSystem(hadoop)
        summary = files.getContentSummary(location)
        changed = files.getFileStatus(location).getModificationTime()
        parts.append(f"{summary.getFileCount()}-{summary.getLength()}-{changed}")
    return "/".join(parts)
