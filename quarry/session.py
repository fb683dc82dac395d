"""Session construction and the few session settings the library relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings applied only when the caller builds the session through us. On a
# cluster the session normally exists already; we never override its values.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the local defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(LOCAL_DEFAULTS)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "8g"      # in local mode the driver is the only executor
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set is ``fallback`` installed (tests pass a fresh scratch
    folder), or, for a ``local`` master only, a new scratch folder. On a
    cluster the setting must name shared storage; without it this raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    chosen = conf_dir or fallback
    if not chosen and sc.master.startswith("local"):
        # a single-machine session (tests, smoke runs): a scratch folder is shared by definition
        import tempfile
        chosen = tempfile.mkdtemp(prefix="quarry-ckpt-")
    if not chosen:
        raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder for checkpoints")
    sc.setCheckpointDir(chosen)
    return sc.getCheckpointDir() or chosen


def default_sf_dir() -> str:
    return os.environ.get("QUARRY_SF_DIR", "/root/testdata/sf0.01")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Functions used by Arrow UDFs and ``mapInPandas``/``applyInArrow`` are pickled
    by reference, so the workers need the package. It is zipped once per
    application on the driver and added with ``addPyFile``; Spark distributes it
    to every executor (as ``--py-files`` would).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import pathlib
    import tempfile
    import zipfile
    pkg = pathlib.Path(__file__).resolve().parent
    out = pathlib.Path(tempfile.mkdtemp(prefix="quarry-pkg-")) / "quarry.zip"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(pkg.rglob("*.py")):
            z.write(f, f.relative_to(pkg.parent).as_posix())
    sc.addPyFile(str(out))
    _SHIPPED.add(app)


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster, sized from the input volume.

    File splits and post-shuffle partitions aim at ``target_partition_bytes`` so a
    task's data fits executor memory (AQE coalesces smaller ones and splits skewed
    ones). There is no cap: 100 TB at 256 MB are about 400,000 partitions, and a
    larger target is the way to fewer of them.
    Apply with ``SparkSession.builder.config(map=...)`` or ``spark.conf.set``.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
