"""Session helpers: UTC time zone, scratch and checkpoint locations.

Every operator in this package treats ``TimestampType`` values as instants and
derives calendar fields in UTC, so the session time zone must be UTC (the
reference sets ``TIME ZONE 'UTC'`` before exporting and relies on a UTC server
for the rest).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"

# Settings that matter at scale; all are plain Spark configuration.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": UTC,
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Wide projections over one JSON payload make alias-substituted constraint
    # sets grow combinatorially during optimisation; the pipeline gains
    # nothing from inferred constraints, so they are off.
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Call-site capture on every Column operation (a debugging aid) roughly
    # doubles the Python-side cost of building wide plans. Static: session start only.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Optimiser settings that the wide payload plans of the registered queries are built for. The library
# never sets them on a caller's session: ``build_session`` and the registered queries do.
PLAN_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
    # A generated method above the JVM's 8000-byte JIT limit runs interpreted;
    # past this size Spark falls back to per-operator code, which is compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "squall", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (clusters bring their own)."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    # Small local inputs: stop AQE from merging CPU-heavy (JSON payload) stages
    # below the core count; cluster-sized partitions are far above this floor.
    conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "256k"
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Make the session zone UTC; every entry point calls this. Nothing else is changed."""
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def plan_settings(spark: SparkSession) -> None:
    """Set ``PLAN_CONF`` on a session that runs the registered queries."""
    for k, v in PLAN_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only a
    local master may go without it (tests); then one temporary folder is made a process. A
    cluster without it is an error: executors do not share a machine's folders.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "ckpt" not in _LOCAL_DIRS:
            _LOCAL_DIRS["ckpt"] = tempfile.mkdtemp(prefix="squall-ckpt-")
        conf_dir = _LOCAL_DIRS["ckpt"]
    if sc is None:
        return conf_dir
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/squall-{name}-{uuid.uuid4().hex[:12]}"


def fs_path(spark: SparkSession, path: str):
    """The file system and the path object of ``path`` (any store that Spark knows)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath
