"""SparkSession construction with the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # keyed pattern state and stream-stream join state live in RocksDB (off-heap, spills to
    # local disk, checkpointed with the query) rather than on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(app: str = "logweave", master: str | None = None,
              shuffle_partitions: int | None = None, conf: dict | None = None,
              time_zone: str = "UTC") -> SparkSession:
    """``time_zone``: the zone of log times that name none, and of the dates and minutes of the day derived from them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", time_zone)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``logweave`` importable on the executors' Python workers (as ``--py-files`` would).

    The pattern operators run Python on executors (``mapInPandas``,
    ``applyInPandasWithState``); their functions live in this package. The
    package is zipped in memory, written once per SparkContext into the shared
    checkpoint folder (``spark.checkpoint.dir``), and added with ``addPyFile``,
    which executors fetch from there.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in sorted(os.walk(pkg)):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:12]
    base = ensure_checkpoint_dir(spark).rstrip("/")
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{base}/pyfiles/{app}/logweave-{digest}.zip")
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    location = target.toString()
    sc.addPyFile(location)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is used as
    is. Only a local master may leave it unset (tests); then a scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="logweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def staged_table(df, name: str, partition_by: list[str] | None = None):
    """Write ``df`` to a new folder below the shared checkpoint folder and read it back.

    Later steps start from the files: a lost executor rereads them, and no reader runs ``df`` again.
    The folder goes when the application ends.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)
