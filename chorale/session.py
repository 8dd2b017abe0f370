"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Named by a caller on a local master, for sessions without ``spark.checkpoint.dir``.
_own_base: str | None = None


#: Parquet tables that hold texts: copies of a text that stand near each other take the room of one.
PACKED = {"compression": "zstd"}
LISTING_TASKS = 64


def pin_session(spark: SparkSession) -> SparkSession:
    """Settings results depend on (UTC) and the adaptive options the plans are written for."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # Folders of many small files are listed by so many tasks; by default there is one for nearly every folder.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS))
    # Shuffle files go when the action that made them ends, not when the driver's garbage is collected: of a chain of written
    # tables, only those of the last step take room.  A frame that is collected again has its stages run again.
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def use_scratch(spark: SparkSession, base: str | None = None) -> SparkSession:
    """Name a scratch folder where the session has none: for tests, benchmarks and queries on one machine.

    Has no effect where ``spark.checkpoint.dir`` is set, and raises on a cluster, whose executors would
    not see a folder of this machine.
    """
    global _own_base
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _own_base = base or _own_base or tempfile.mkdtemp(prefix="chorale-")
    return spark


def _root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or _own_base
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/chorale/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, empty, unique folder below the one the cluster names in ``spark.checkpoint.dir``."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on whatever file system it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none where it is missing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(place)] if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has put into the scratch folder; results read from it must be done with."""
    remove(spark, _root(spark))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the scratch folder and read it back.

    For small results that a large table is joined with: they are computed once, survive lost executors,
    and their size is known from the files when the join is planned.  Spark then broadcasts them only
    below ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges (splitting skew) above it.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
