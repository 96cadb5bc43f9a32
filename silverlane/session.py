"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


_LOCAL_ROOTS: dict[str, str] = {}


def local_session(
    app: str, cores: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """Session for tests and local benchmarks; a cluster job brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Larger methods are never compiled to machine code; such stages do better operator by operator.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if checkpoint_dir:
        builder = builder.config(CHECKPOINT_KEY, checkpoint_dir)
    return builder.getOrCreate()


def work_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Unset is only accepted in local mode, where a temporary folder takes its
    place: on a cluster a machine-local folder would vanish with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_KEY} must name a shared folder on a cluster")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="silverlane-")
    return _LOCAL_ROOTS[context.applicationId]


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared work folder and read back, so later passes start there.

    The stored columns can be read one by one, and a lost executor costs a
    re-read instead of everything before.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
