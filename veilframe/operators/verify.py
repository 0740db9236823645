"""Verification of regions, and their final order. Rules verify what was found; they find nothing themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.checks import candidate_texts, checksum, digit_problem, is_field_label, is_resident_number
from veilframe.operators.folds import merge_regions

IOU = 0.6


def region_id(n: Column) -> Column:
    """r001 and on; four digits where three are too few, which lpad would cut."""
    return F.concat(F.lit("r"), F.lpad(n.cast("string"), F.greatest(F.lit(3), F.length(n.cast("string"))), F.lit("0")))


def verify(regions: DataFrame, retype: bool = True) -> DataFrame:
    """Regions with checksum, verified, and the flags that follow; a value that must be a resident number is retyped first.

    With retype off such a region keeps its type and is held for review, even where both engines agree.
    """
    r = regions.withColumn("_texts", candidate_texts(F.col("text"), F.col("vlm_text")))
    r = r.withColumn("_mislabel", is_resident_number(F.col("type"), F.col("_texts"))).withColumn("_was", F.col("type"))
    if retype:
        r = r.withColumn("type", F.when(F.col("_mislabel"), "RRN").otherwise(F.col("type")))
    unresolved = F.lit(False) if retype else F.col("_mislabel")
    r = r.withColumn("_digits", digit_problem(F.col("type"), F.col("_texts"))).withColumn("checksum", checksum(F.col("type"), F.col("_texts")))
    r = r.withColumn("verified", F.coalesce(F.col("checksum") == "ok", F.lit(False)))
    review = F.col("needs_review") | unresolved | F.col("_digits").isNotNull() | F.coalesce(F.col("checksum") == "failed", F.lit(False))
    clear = F.col("verified") & (F.col("agreement") == "EXACT") & ~unresolved
    note = F.when(F.col("_mislabel") & F.lit(retype), F.concat(F.lit("type "), F.col("_was"), F.lit(" -> RRN by checksum"))).when(F.col("_mislabel"), F.concat(F.lit("type "), F.col("_was"), F.lit(" but the value is a resident number")))
    said = F.when(F.col("checksum") == "ok", "checksum ok").when(F.col("checksum") == "failed", "checksum failed")
    reason = F.concat_ws("; ", F.when(F.col("reason") != "", F.col("reason")), note, F.col("_digits"), said)
    r = r.withColumn("reason", F.when(reason != "", reason)).withColumn("needs_review", F.when(clear, F.lit(False)).otherwise(review)).withColumn("confidence", F.when(clear, F.lit(1.0)).otherwise(F.col("confidence")))
    return r.drop("_texts", "_mislabel", "_was", "_digits")


def is_label_only(text: Column, vlm_text: Column) -> Column:
    """Only where both engines read a field's name is nothing lost by dropping the region."""
    return is_field_label(vlm_text) & (text.isNull() | is_field_label(text))


def drop_labels(regions: DataFrame) -> DataFrame:
    """Regions without those that are a field's name; where one engine read a name and the other a value, it stays for review."""
    kept = regions.filter(~is_label_only(F.col("text"), F.col("vlm_text")))
    one = is_field_label(F.col("vlm_text")) | is_field_label(F.col("text"))
    return kept.withColumn("needs_review", F.col("needs_review") | one)


def number(regions: DataFrame, keys: tuple[str, ...] = ("page",)) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("bbox.y1", "bbox.x1", "type", "ord")
    return regions.withColumn("id", region_id(F.row_number().over(order)))


def finalize(regions: DataFrame, threshold: float = IOU) -> DataFrame:
    """Names dropped, repeats merged, ids given in reading order."""
    return number(merge_regions(drop_labels(regions), threshold))
