"""Surrogate keys without a sequence object."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_ids(df: DataFrame, key: str, id_col: str, after: Column | int = 0, buckets: int | None = None) -> DataFrame:
    """Add a dense bigint id, ``after + 1`` upward, to rows with a unique ``key``.

    Rows are numbered inside hash buckets of the key and shifted by the sizes of
    the buckets before. Both depend only on the data, so a recomputed partition
    gets the same ids again. The offset table has at most ``buckets`` rows,
    which bounds both its global window and its broadcast.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    start = after if isinstance(after, Column) else F.lit(after)
    tagged = df.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        tagged.withColumn("_place", place)
        .join(F.broadcast(offsets), "_bucket")
        .select((start + F.col("_before") + F.col("_place")).cast("bigint").alias(id_col), *df.columns)
    )
