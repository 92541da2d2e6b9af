"""Shared folder, size-checked broadcasts and hot-group-safe group lookups."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows of at most this many bytes in all may be broadcast.
BROADCAST_BYTES = 48 << 20
#: Rows of a key from which on it counts as hot.
HOT = 16_384
#: Salts over which the rows of one group are spread.
SALTS = 64


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as a Hadoop URI or path: spark.checkpoint.dir. Where that is unset, a folder of our
    own if driver and executors are one process, as in tests; a cluster must name one."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or (sc.getCheckpointDir() if sc._jsc.sc().getCheckpointDir().isDefined() else None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tessella-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    return folder


def shared_uri(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for Spark's readers and writers: any Hadoop file system will do."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh POSIX path under the shared folder, for files that are memory-mapped or read by Python: it must be a mount
    that every executor sees."""
    folder = urlparse(shared_dir(spark))
    if folder.scheme not in ("", "file"):
        raise ValueError(f"files that Python workers read need a mounted shared folder, not {folder.scheme}:")
    return f"{unquote(folder.path).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of any Hadoop file system, with all that is in it."""
    jvm, sc = spark._jvm, spark.sparkContext
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def quoted(name: str) -> str:
    """A column's name for col(), whatever signs are in it."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """name, made longer until no column of df has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder, so that lost executors cost nothing that came before."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def bounded_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if its counted rows are proven to fit `limit`, else df as it is (a shuffled join follows).

    df should be cut() already: it is counted here.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def join_groups(rows: DataFrame, groups: DataFrame, key: str, members: str, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """rows joined to groups, one row per key, where `members` says how many rows a key has.

    All groups are broadcast if they are proven to fit `limit`. Else those of the most members are: a group goes that way
    from so many members on that all such groups together fit, and what is left is joined by shuffle with no hot key.
    groups should be cut().
    """
    total, n = groups.agg(F.sum(members), F.count(F.lit(1))).first()
    most = limit // row_bytes
    if n <= most:
        return rows.join(F.broadcast(groups), key)
    # At most total / hot groups have more than `hot` members.
    hot = max(HOT, -(-total // most))
    few = groups.where(F.col(members) > hot)
    return rows.join(F.broadcast(few), key).unionByName(rows.join(groups.where(F.col(members) <= hot).hint("merge"), key))


def with_group_values(df: DataFrame, keys: Sequence[str], salt: Column, first: Sequence[Column], merge: Sequence[Column], salts: int = SALTS) -> DataFrame:
    """df with the values of each row's group, without ever holding a whole group in one task.

    Rows are aggregated by (keys, salt) with `first`, those partial rows by keys with `merge`; the merged values
    come back over (keys, salt), so that a group of any size is spread over `salts` tasks. Keys must not be null.
    """
    salted = df.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    partial = salted.groupBy(*keys, "_salt").agg(*first)
    merged = partial.groupBy(*keys).agg(*merge)
    back = partial.select(*keys, "_salt").join(merged, list(keys))
    return salted.join(back, [*keys, "_salt"]).drop("_salt")


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of at most `rows` rows, so that long texts and both sides' copies of a batch stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


_owner: list[tuple[str, Callable[[], None]]] = []


def trim() -> None:
    """Gives memory that this worker freed back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(owner: str, run: Callable[[Iterator], Iterator], clear: Callable[[], None] = lambda: None) -> Callable[[Iterator], Iterator]:
    """run for mapInArrow in a worker process that lives through several operators: tables that another operator kept
    there are dropped first, and freed memory goes back when the task ends."""

    def wrapped(batches: Iterator) -> Iterator:
        if _owner and _owner[0][0] != owner:
            _owner[0][1]()
            trim()
        _owner[:] = [(owner, clear)]
        yield from run(batches)
        trim()

    return wrapped


def map_rows(rows: DataFrame, run: Callable[[Iterator], Iterator], schema: StructType) -> DataFrame:
    """rows.mapInArrow(run, schema) for columns of any names: run sees and gives columns c0, c1, ... by position."""
    plain = rows.toDF(*[f"c{k}" for k in range(len(rows.columns))])
    made = StructType([StructField(f"c{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])
    return plain.mapInArrow(run, made).toDF(*schema.names)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
