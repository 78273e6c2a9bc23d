"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC keeps timestamps repeatable; AQE lets the
# planner turn a small join side into a broadcast at run time (after it has
# measured it) and split skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed state of streams on local disk, snapshots in the checkpoint
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Arrow batch size of the extraction UDFs: pages are capped at 2 MiB, so
    # 256 pages bound one batch to 512 MiB of HTML in the Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app_name: str = "newsdesk", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the
    cluster's own session and only make sure BASE_CONF holds."""
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)  # the UDF workers import the package, wherever the driver runs
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on a session built elsewhere."""
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a foreign session: leave it
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names it and is used as is. Only a local session
    without one gets a scratch folder; on a cluster a machine-local folder
    would lose data, so there the setting is asked for.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a session without a JVM context: the setting alone
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="newsdesk-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def checkpoint_dir(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint folder (for stream checkpoints,
    snapshot tables and written intermediate results)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, *parts) if parts else base


_ZIP: list[str] = []


def ship_package(spark: SparkSession) -> str:
    """Zip this package into a local folder of the driver and add it to the
    executors' Python path (the ``--py-files`` route for clusters whose image
    does not carry it); Spark itself carries the file to them. One zip for
    each driver process."""
    import zipfile

    if not _ZIP:
        root = os.path.dirname(os.path.abspath(__file__))
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".py"))
        target = os.path.join(tempfile.mkdtemp(prefix="newsdesk-pkg-"), "newsdesk-package.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
            for f in files:
                z.write(f, os.path.join("newsdesk", os.path.relpath(f, root)))
        _ZIP.append(os.path.realpath(target))
    spark.sparkContext.addPyFile(_ZIP[0])
    return _ZIP[0]
