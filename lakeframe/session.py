"""Session and shared work-folder helpers.

Jobs that need to cut lineage or stage intermediate files write under the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that is unset (local tests) do we
create one and register it with the SparkContext.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.driver.memory": "8g",
}


# Recommended runtime settings for large clusters (applied only where unset, see
# apply_cluster_defaults).  Values are this build's choices, not Spark defaults.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # a folder of many small objects: pack more files into one scan task
    "spark.sql.files.openCostInBytes": str(1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    # keyed state on local disk with incremental (changelog) checkpoints
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def apply_cluster_defaults(spark: SparkSession, overrides: dict | None = None) -> dict:
    """Set :data:`CLUSTER_CONF` entries the session has not set explicitly; returns what
    was set.  Nothing is changed that the job or cluster already configured."""
    applied = {}
    for k, v in {**CLUSTER_CONF, **(overrides or {})}.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
            applied[k] = v
    return applied


def local_session(cores: int | str = "*", app: str = "lakeframe", extra: dict | None = None) -> SparkSession:
    """A local session configured like the tests and bench expect."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def catalog_session(warehouse: str, metastore: str, cores: int | str = "*", app: str = "lakeframe") -> SparkSession:
    """A session whose catalog outlives the process (D6): Hive support with an embedded
    Derby metastore in ``metastore`` and managed tables under ``warehouse``.  On a cluster,
    point ``hive.metastore.uris`` at the shared metastore instead."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app).enableHiveSupport()
               .config("spark.sql.warehouse.dir", warehouse)
               .config("javax.jdo.option.ConnectionURL", f"jdbc:derby:;databaseName={metastore};create=true"))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder for staged data: ``spark.checkpoint.dir`` when the cluster sets it.

    Where it is unset, a local run gets a temporary folder; on a cluster that folder would be
    another one on each machine, so there it is an error."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = spark.conf.get("spark.master", "") if sc is None else sc.master
    if sc is None or not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lakeframe-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the work root for one run of one job."""
    return f"{work_root(spark)}/lakeframe/{name}/{uuid.uuid4().hex}"


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (local disk, not executor heap) unless
    the session names a provider.  A query takes its provider when it starts, so the caller's
    setting is put back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    explicit = spark.conf.get(name, None)
    if explicit and not explicit.endswith("HDFSBackedStateStoreProvider"):
        yield
        return
    spark.conf.set(name, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        if explicit:
            spark.conf.set(name, explicit)
        else:
            spark.conf.unset(name)


_DATABASES: list[str] = []


def note_database(name: str) -> None:
    """Remember a database that a query made for itself."""
    _DATABASES.append(name)


def drop_temporary(spark: SparkSession) -> None:
    """Drop the databases that queries made for themselves, with their tables.  Results are read
    lazily from them, so this is for after the last result has been consumed."""
    while _DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS `{_DATABASES.pop()}` CASCADE")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
