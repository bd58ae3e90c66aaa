"""Session settings, lineage cuts and literal tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A hot key must be split even when the split costs the shuffle that the next
# aggregation would otherwise have saved. Small shuffles stay spread over the
# cores, as names and string pairs are few bytes but much work.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
}


def tune(spark: SparkSession) -> SparkSession:
    """Set the adaptive options the operators rely on, where the launcher left them open."""
    launched_with = spark.sparkContext.getConf()
    for key, value in ADAPTIVE_SETTINGS.items():
        if not launched_with.contains(key):
            spark.conf.set(key, value)
    return spark


# Folders made for local sessions that name none, by application.
_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's folder for intermediate tables, in the one that ``spark.checkpoint.dir`` names.

    Only a single-process session without that setting gets a folder of its
    own, which goes when the process ends.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if context.applicationId not in _own_folders:
            folder = tempfile.mkdtemp(prefix="squadweave-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
            _own_folders[context.applicationId] = folder
        named = _own_folders[context.applicationId]
    return f"{named.rstrip('/')}/squadweave-{context.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and go on from there.

    Later steps read the columns they need, whatever executors are lost.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all tables that lineage cuts of this application wrote, once no result that rests on them is needed."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def literal_table(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A table of values stated in the code: a local relation of known size."""
    return spark.createDataFrame(pa.table(columns))


def single_value(df: DataFrame, value: Column) -> Column:
    """``value`` aggregated over the whole of ``df``, as a scalar subquery."""
    return df.agg(value.alias("v")).scalar()


def bind(value: Column, use) -> Column:
    """``use`` of ``value``, which is worked out once however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def buckets_of(df: DataFrame, bucket_rows: int) -> Column:
    """How many buckets of about ``bucket_rows`` rows ``df`` needs, at least one."""
    return F.greatest(F.lit(1), single_value(df, F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int")))


def bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key), buckets).cast("int")
