"""Ordered deduplication, ranks, unions and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in a stated order; row_number() <= 1 lets Catalyst prune before the shuffle."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int, name: str = "rank") -> DataFrame:
    """The first k rows of each key with their rank."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def stacked(*parts: DataFrame) -> DataFrame:
    """UNION ALL in a fixed order, told by source_ord."""
    out = None
    for k, part in enumerate(parts):
        part = part.withColumn("source_ord", F.lit(k))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def upsert(old: DataFrame, new: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """New rows replace old ones of their key; among new rows the first wins."""
    fresh = first_wins(new, [key], order)
    return old.join(fresh.select(key), key, "left_anti").unionByName(fresh)


def sample_by_hash(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """N rows without replacement, the same on each run."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)


def split_by_hash(df: DataFrame, keys: Sequence[str], share: float = 0.9, seed: int = 42) -> DataFrame:
    """A column is_train that holds for about `share` of the rows, by key."""
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), 1, 4), 16, 10).cast("int")
    return df.withColumn("is_train", bucket < int(share * 65536))


#: Rows of an Arrow batch: a batch of texts is held several times over by its worker.
ARROW_ROWS = 256
#: Rows of ids that may be broadcast.
FEW = 1 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """df, in whose session Arrow batches have at most ARROW_ROWS rows from now on, as Spark bounds them by rows only."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= ARROW_ROWS:
        conf.set(name, str(ARROW_ROWS))
    return df


def matching(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in `wanted`. Where its keys are few, by count, they travel to the rows, which stay where they are."""
    keys = wanted.select(key).distinct().persist()
    return rows.join(F.broadcast(keys) if keys.count() <= FEW else keys, key, "left_semi")


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a scan of fewer splits than there are cores, dealt out to all of them; others stay where they are."""
    n = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(n) if rows.rdd.getNumPartitions() < n else rows
