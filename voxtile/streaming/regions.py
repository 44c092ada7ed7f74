"""Region counts of a growing folder of object tables, kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def object_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1_000) -> DataFrame:
    """Rows of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def region_totals(objects: DataFrame, keys: tuple[str, ...] = ("index", "name")) -> DataFrame:
    """Running objects and voxels of each region; the state has one row a region.  Missing regions are left out."""
    known = objects.where(" and ".join(f"{k} is not null" for k in keys))
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.sum("nvoxels").alias("nvoxels"))
