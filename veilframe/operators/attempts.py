"""Calls of a model as data: which attempt counts, what the next one may use, and what went wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKENS, TOKENS_AFTER_CUT, RETRIES = 2048, 4096, 2
SHRUNK = 0.81


def usable(raw: Column, error: Column) -> Column:
    return raw.isNotNull() & error.isNull()


def first_success(attempts: DataFrame, keys: tuple[str, ...] = ("page", "tile", "sample")) -> DataFrame:
    """One row per call: its first usable attempt (attempt, raw, error, finish_reason), else its last; attempts counts all."""
    good = usable(F.col("raw"), F.col("error"))
    order = F.struct(F.when(good, 0).otherwise(1).alias("a"), F.when(good, F.col("attempt")).otherwise(-F.col("attempt")).alias("b"))
    row = F.struct("attempt", "raw", "error", "finish_reason")
    return attempts.groupBy(*keys).agg(F.min_by(row, order).alias("r"), F.count("*").alias("attempts")).select(*keys, "r.*", "attempts")


def to_repeat(attempts: DataFrame, keys: tuple[str, ...] = ("page", "tile", "sample"), retries: int = RETRIES) -> DataFrame:
    """Calls without a usable attempt that may be tried again, with the next attempt's number and token limit: an answer that was cut gets more."""
    state = attempts.groupBy(*keys).agg(F.bool_or(usable(F.col("raw"), F.col("error"))).alias("done"), F.max("attempt").alias("last"), F.max_by("finish_reason", "attempt").alias("why"))
    limit = F.when(F.col("why") == "length", TOKENS_AFTER_CUT).otherwise(TOKENS)
    return state.filter(~F.col("done") & (F.col("last") < retries)).select(*keys, (F.col("last") + 1).alias("attempt"), limit.alias("max_tokens"))


def shrunk(seen_w: Column, seen_h: Column, w: Column, h: Column) -> Column:
    """The model saw clearly less than was sent, so its coordinates are coarse."""
    return seen_w.cast("double") * seen_h < w.cast("double") * h * SHRUNK


def stage_times(times: DataFrame) -> DataFrame:
    """(page, timings): seconds by stage as a map, with their total."""
    t = times.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("stage", "seconds"))).alias("s"), F.sum("seconds").alias("total"))
    return t.select("page", F.map_concat(F.map_from_entries("s"), F.create_map(F.lit("total"), F.col("total"))).alias("timings"))
