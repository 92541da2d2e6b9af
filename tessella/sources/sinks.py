"""Sinks (K01-K06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.operators.relational import first_wins, upsert


def write_json_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """UTF-8 JSON lines, null members kept."""
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """K03."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def _files(spark: SparkSession, path: str):
    """(file system, Path of a suffix)."""
    of = lambda suffix="": spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + suffix)
    return of().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), of


def recovered(spark: SparkSession, path: str) -> bool:
    """Whether there is a collection; one whose replacement broke off between its two renames is put in place."""
    fs, of = _files(spark, path)
    if not fs.exists(of()) and fs.exists(of(".old")):
        fs.rename(of(".next") if fs.exists(of(".next/_SUCCESS")) else of(".old"), of())
    return fs.exists(of())


def count_or_none(spark: SparkSession, path: str) -> int | None:
    """Rows of a collection, None where there is none."""
    return spark.read.parquet(path).count() if recovered(spark, path) else None


def load_collection(spark: SparkSession, new: DataFrame, path: str, key: str = "chunk_id", order: tuple[str, ...] = ("text",), reset: bool = False, force: bool = False, enough: int = 500) -> bool:
    """Upserts into a Parquet collection; skipped (False) if it already holds more than `enough` rows.

    Rows are written whole beside the collection, which is then renamed away and replaced by them: wherever that
    breaks off, the old or the new collection is there, under its name or for `recovered` to find."""
    have = None if reset else count_or_none(spark, path)
    if have is not None and have > enough and not force:
        return False
    rows = first_wins(new, [key], list(order)) if have is None else upsert(spark.read.parquet(path), new, key, list(order))
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}.next")
    fs, of = _files(spark, path)
    fs.delete(of(".old"), True)
    if fs.exists(of()):
        fs.rename(of(), of(".old"))
    fs.rename(of(".next"), of())
    fs.delete(of(".old"), True)
    return True
