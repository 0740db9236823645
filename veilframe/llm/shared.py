"""Tables and text helpers that the operators share."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: A key with at least one part in so many of the rows is hot, so there are no more hot keys than this.
HOT_PARTS = 1000

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the warehouse where it is unset."""
    conf = spark.sparkContext.getConf()
    if place := conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None):
        return place.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet below shared_dir() and read it back.

    Cuts the lineage: a lost executor re-reads the files instead of repeating the work. The table is
    deleted by the passing() around it, or else when the driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/veilframe-{uuid.uuid4().hex}-{tag}"
    df.write.parquet(path)
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of a query go as soon as it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def give_back(spark: SparkSession) -> None:
    """Executors collect their garbage once. Their JVMs then return the heap and the direct buffers that nothing uses any more, and would hold beside what comes next."""
    cores = spark.sparkContext.defaultParallelism  # a task for each, so that no executor that is idle is left out
    spark.range(0, cores, 1, cores).select(F.expr("java_method('java.lang.System', 'gc')")).collect()


@contextlib.contextmanager
def passing() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Deletes the tables that are materialised within, but for those written with what it gives: its results."""
    first, kept = len(_made), []

    def keep(df: DataFrame, tag: str) -> DataFrame:
        out = materialise(df, tag)
        kept.append(_made[-1])
        return out

    try:
        yield keep
    finally:
        gone, _made[first:] = [x for x in _made[first:] if x not in kept], kept
        for spark, path in gone:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _clean() -> None:
    for spark, path in _made:
        try:
            _delete(spark, path)
        except Exception:  # the session may have ended already; then only files are left behind
            return


def join_hot(rows: DataFrame, per_key: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """rows joined with per_key, which has each key once and, as count, how many of the total rows have it.

    The hot keys of per_key, HOT_PARTS at most, are broadcast, so that their rows stay where they
    are; the others are shuffled. Both tables are read twice. Rows without a key are kept by how "left".
    """
    hot = per_key.filter(F.col(count) * HOT_PARTS >= total)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(per_key.filter(F.col(count) * HOT_PARTS < total), key, how)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def small_batches(spark: SparkSession) -> None:
    """Rows hold whole texts, so Arrow batches of the default 10,000 rows are large; a setting of the user's own stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")


def n_words(text: Column) -> Column:
    """Number of words as a long; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text leaves no remainder; such rows are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
