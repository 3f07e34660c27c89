"""Session settings and the folder shared by driver and executors."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that are safe on any cluster size: AQE picks partition counts, splits skewed joins and
# re-plans small sides as broadcasts from sizes it has measured.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A union of equally partitioned inputs may claim their partitioning and lose it when adaptive
    # execution coalesces them differently ("Can't zip RDDs"). The plans here avoid such unions;
    # this covers what callers build around them.
    "spark.sql.unionOutputPartitioning": "false",
}

_local_shared_dir: str | None = None


def build_session(
    app: str = "tallyfolio",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the engine's settings; ``settings`` uses ``__`` where Spark uses a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a temporary folder on a local
    master (tests), and an error on a cluster, whose machines would not see one another's."""
    global _local_shared_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if _local_shared_dir is None:
        _local_shared_dir = tempfile.mkdtemp(prefix="tallyfolio-")
    return _local_shared_dir


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, until the application ends: it is computed once, and a lost
    executor does not take it along."""
    path = _kept_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def kept_while(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like ``kept``, for the block only: its files are removed as it ends."""
    path = _kept_path(df.sparkSession, name)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        place, store = _placed(df.sparkSession, path)
        store.delete(place, True)


# Shuffle files of a write are removed as it ends, not when the driver next collects garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept_in_shares(df: DataFrame, name: str, keys: Sequence[str], shares: int) -> DataFrame:
    """Like ``kept``, computed in turn for ``shares`` shares of the rows by a hash of ``keys``, so that the disk holds
    one share's shuffle at a time. The frame's input is read once a share.

    Below a grouping by ``keys`` (or more columns) a share's rows are picked as they are read. NULL is a key like others;
    floating-point keys are refused, whose equal values can hash differently."""
    spark = df.sparkSession
    if floating := [c for c, kind in df.select(*keys).dtypes if kind in ("float", "double")]:
        raise ValueError(f"shares by floating-point {', '.join(floating)}")
    path = _kept_path(spark, name)
    share = F.pmod(F.xxhash64(*keys), F.lit(shares))
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        for i in range(shares):
            df.filter(share == i).write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_DROP_SHUFFLES)
        else:
            spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _kept_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/tallyfolio/{name}-{uuid.uuid4().hex}"
    place, store = _placed(spark, path)
    store.deleteOnExit(place)
    return path


def _placed(spark: SparkSession, path: str):
    """Hadoop's path and the file system it is on."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
