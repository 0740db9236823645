"""Answers of a vision-language model to findings on the page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.geometry import sane_rect, tile_to_page
from veilframe.functions.jsonio import parse_answer, typed_items
from veilframe.functions.textnorm import match_key
from veilframe.operators.folds import dedup_findings

CONVENTIONS = ("auto", "unit", "per-mille", "pixel")


def convention(largest: Column, setting: str = "auto") -> Column:
    """How an answer writes coordinates, from the largest number in it; nothing counts as unit."""
    if setting not in CONVENTIONS:
        raise ValueError(f"unknown coordinate convention {setting!r}, one of {CONVENTIONS}")
    if setting != "auto":
        return F.lit(setting)
    return F.when(F.coalesce(largest, F.lit(0.0)) <= 1.0, "unit").when(largest <= 1000.0, "per-mille").otherwise("pixel")


def divisor(kind: Column, seen: Column) -> Column:
    return F.when(kind == "unit", 1.0).when(kind == "per-mille", 1000.0).otherwise(F.greatest(seen, F.lit(1)).cast("double"))


def largest_number(boxes: Column) -> Column:
    """Largest magnitude in the well-formed boxes of one answer."""
    whole = F.filter(boxes, lambda b: (F.size(b) == 4) & ~F.exists(b, lambda v: v.isNull()))
    return F.array_max(F.transform(F.flatten(whole), lambda v: F.abs(v)))


def parse_responses(responses: DataFrame) -> DataFrame:
    """responses (page, tile, sample, raw, ...) with items, salvaged and error. A null answer has no items."""
    parsed = responses.withColumn("_answer", parse_answer("raw"))
    return parsed.select(*responses.columns, typed_items(F.col("_answer.items")).alias("items"), F.col("_answer.salvaged").alias("salvaged"), F.col("_answer.error").alias("error"))


def decode(parsed: DataFrame, setting: str = "auto") -> DataFrame:
    """Findings (page, ord, tile, type, text, field, conf, rect, key) of parsed answers, whose rect and seen size are given.

    Items with unusable boxes fall away here; bad_boxes() counts them.
    """
    boxes = F.transform("items", lambda i: i["bbox_2d"])
    kind = parsed.withColumn("convention", convention(largest_number(boxes), setting))
    rows = kind.select("page", "tile", "sample", F.col("rect").alias("_tile"), "convention", divisor(F.col("convention"), F.col("seen_w")).alias("_sx"), divisor(F.col("convention"), F.col("seen_h")).alias("_sy"), F.posexplode("items").alias("_n", "_i"))
    local = sane_rect(F.col("_i.bbox_2d"), F.col("_sx"), F.col("_sy"))
    found = rows.withColumn("_local", local).filter("_local IS NOT NULL")
    number = F.struct("tile", "sample", "_n")
    return found.select("page", number.alias("ord"), "tile", F.col("_i.type").alias("type"), F.col("_i.text").alias("text"), F.col("_i.field").alias("field"), F.col("_i.conf").alias("conf"), tile_to_page(F.col("_local"), F.col("_tile")).alias("rect"), "convention", match_key(F.col("_i.text")).alias("key"))


def bad_boxes(parsed: DataFrame) -> DataFrame:
    """Warnings: how many items of an answer had no usable box."""
    usable = F.filter("items", lambda i: F.coalesce((F.size(i["bbox_2d"]) == 4) & ~F.exists(i["bbox_2d"], lambda v: v.isNull()), F.lit(False)))
    return parsed.select("page", "tile", "sample", (F.size("items") - F.size(usable)).alias("dropped")).filter("dropped > 0")


def empty_reason(parsed: DataFrame) -> DataFrame:
    """Pages without findings: whether a call failed or the model found nothing."""
    page = parsed.groupBy("page").agg(F.sum(F.size(F.coalesce("items", F.array().cast(parsed.schema["items"].dataType)))).alias("n"), F.bool_or(F.col("error").isNotNull() & F.col("items").isNull()).alias("failed"))
    return page.filter("n = 0").select("page", F.when(F.col("failed"), "call_failed").otherwise("nothing_found").alias("reason"))


def findings(responses: DataFrame, setting: str = "auto") -> DataFrame:
    """Answers to findings without repeats, in reading order by ord (from 1) within the page."""
    from pyspark.sql import Window

    kept = dedup_findings(decode(parse_responses(responses), setting))
    order = Window.partitionBy("page").orderBy(F.round("rect.y1", 3), "rect.x1", "ord")
    return kept.withColumn("ord", F.row_number().over(order))
