"""Session helpers: a local session for tests/bench and a shared folder for
lineage cuts.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
filesystem); a local temporary folder is only created when that setting is
unset, which is the test/bench case.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"


def local_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tempora") -> SparkSession:
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir``, which Spark applies to
    the context at start-up); only when it is unset -- tests, a bare local
    session -- a local temporary folder is set on the context."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = None
    try:
        configured = spark.conf.get(_CKPT_KEY, None)
    except Exception:  # noqa: BLE001 - a core conf may be hidden from the SQL conf
        configured = None
    configured = configured or sc.getConf().get(_CKPT_KEY, None)
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError(f"{_CKPT_KEY} must name a shared folder on {sc.master}: executors cannot read each other's local files")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tempora-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, name: str = "layer"):
    """Materialise ``df`` as parquet in the shared checkpoint folder and
    return a frame that reads it back: later plans stay small, each source
    is scanned once, and a lost executor recomputes from these files, not
    from the raw inputs (a layer boundary, like a written Bronze / Silver /
    Gold table). One job; never a machine-local folder on a cluster."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    _LAYERS.append(path)
    return spark.read.parquet(path)


#: what ``cut_lineage`` wrote in this process, in order
_LAYERS: list[str] = []


def layer_mark() -> int:
    """A place among the written layers, for ``clear_layers``."""
    return len(_LAYERS)


def clear_layers(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the layers written after a mark but the last ``keep``, once
    nothing reads them any more (a batch job's results are published by then);
    returns how many."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    done = 0
    kept = _LAYERS[len(_LAYERS) - keep:]
    del _LAYERS[len(_LAYERS) - keep:]
    while len(_LAYERS) > since:
        path = spark._jvm.org.apache.hadoop.fs.Path(_LAYERS.pop())
        done += bool(path.getFileSystem(conf).delete(path, True))
    _LAYERS.extend(kept)
    return done


@contextmanager
def files_dropped(spark: SparkSession) -> Iterator[None]:
    """Within it, Spark drops the shuffle files of each finished job, so that
    those of a loop's rounds are not on disk at the same time."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


# Runtime SQL settings for a large cluster (100 TB inputs): many initial
# shuffle partitions that AQE coalesces to ~256 MB each, skew-join splitting,
# scan splits sized to executor memory. Broadcasts stay behind the default
# size threshold (checked by AQE on measured sizes).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def configure_for_scale(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply ``SCALE_CONF`` (plus overrides) to a cluster session."""
    for k, v in {**SCALE_CONF, **(overrides or {})}.items():
        spark.conf.set(k, v)
