"""Session construction: adaptive execution, shuffle sizing, named catalogs."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

BASE_CONF = {
    # NTZ columns are shifted and compared as wall-clock time; the zone only matters for epoch conversion.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of the rows: split its partition even if that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.shuffle.partitions": "200",
    # Sides are broadcast only when their size, estimated or measured at run time, is below this.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
}


def build_session(
    app_name: str = "lanemart",
    conf: Mapping[str, str] | None = None,
    catalogs: Mapping[str, Mapping[str, str]] | None = None,
    default_catalog: str | None = None,
    master: str | None = None,
    initial_partitions: int | None = None,
) -> SparkSession:
    """Build a session.

    ``initial_partitions`` is the number of partitions a shuffle starts with, before small ones are merged.
    Adaptive execution merges but does not split ordinary partitions, so on large inputs it should be about the
    largest shuffle's bytes over 128 MB (4000 for half a terabyte). Unset, it is the shuffle partitions.

    ``catalogs`` maps a catalog name to its options; the entry ``""`` is the implementing class,
    e.g. ``{"lake": {"": "org.apache.iceberg.spark.SparkCatalog", "warehouse": "..."}}``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if initial_partitions is not None:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(initial_partitions)
    for name, options in (catalogs or {}).items():
        for option, value in options.items():
            key = f"spark.sql.catalog.{name}" + (f".{option}" if option else "")
            settings[key] = value
    if default_catalog:
        settings["spark.sql.defaultCatalog"] = default_catalog
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: The JVM's command (``jcmd`` has it as System.trim_native_heap) that returns freed native memory.
TRIM = "systemTrimNativeHeap"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting ``name`` has another value while it lasts."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Columns up to which operators are generated into one method, by default.
NARROW = 12


@contextmanager
def narrow_methods(spark: SparkSession, fields: int = NARROW) -> Iterator[None]:
    """While it lasts, operators on rows of more than ``fields`` columns are run one by one, not generated into one method.

    The JVM's compiler took up to 0.5 GB of an executor, outside the heap, for one generated method of a wide chain of
    joins. Rows and results are the same. The session's own setting comes back at the end.
    """
    with setting(spark, "spark.sql.codegen.maxFields", str(fields)):
        yield


def give_back(spark: SparkSession) -> None:
    """Have the driver's JVM collect its garbage and return native memory that it has freed to the system.

    Plans that are over are garbage, and shuffle files go with theirs. Planning also keeps the JVM's compiler busy, and
    what its threads free stays with the process: 0.2 GB after a few queries. A JVM without the command keeps it.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway

    def array(kind: str, *items):
        out = gateway.new_array(getattr(jvm.java.lang, kind), len(items))
        for i, item in enumerate(items):
            out[i] = item
        return out

    def named(name: str):
        return jvm.java.lang.Class.forName(name)

    # The server's own class is closed to callers, so the call goes through its interface.
    server = named("javax.management.MBeanServerConnection")
    kinds = array("Class", *map(named, ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")))
    commands = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    call = array("Object", commands, TRIM, None, None)
    jvm.java.lang.System.gc()
    with suppress(Py4JJavaError):
        server.getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), call)
