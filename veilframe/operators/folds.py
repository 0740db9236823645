"""Greedy folds over the ordered rows of a group.

Whether a row is kept depends on rows kept before it, so these are neither a distinct nor a
component: each group's rows are sorted into an array and folded once, inside the JVM. A group is a page, whose
rows are bounded by what a model answers for it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.geometry import iou, overlap_ratio, rects_overlap


def gather(df: DataFrame, keys: Sequence[str], order: Column, columns: Sequence[str]) -> DataFrame:
    """One row per group with `rows`: its rows as structs, sorted by the fields of order."""
    row = F.struct(order.alias("_order"), *columns)
    kind = df.select(row.alias("r")).schema["r"].dataType.simpleString()
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("rows")).withColumn("_none", F.array().cast(f"array<{kind}>"))


def fold_kept(rows: Column, none: Column, duplicate: Callable[[Column, Column], Column]) -> Column:
    """Rows in order, without those that duplicate a row already kept."""
    return F.aggregate(rows, none, lambda kept, row: F.when(F.exists(kept, lambda k: duplicate(k, row)), kept).otherwise(F.array_append(kept, row)))


def dedup_findings(findings: DataFrame, keys: Sequence[str] = ("page",)) -> DataFrame:
    """Findings (type, key, rect, conf, tile, ord) without repeats: the surest of those of one type and key whose rects overlap."""
    columns = [c for c in findings.columns if c not in keys]
    grouped = gather(findings, keys, F.struct((-F.col("conf")).alias("conf"), "tile", "ord"), columns)
    same = lambda k, r: (k["type"] == r["type"]) & (k["key"] == r["key"]) & rects_overlap(k["rect"], r["rect"])
    kept = grouped.select(*keys, F.explode(fold_kept(F.col("rows"), F.col("_none"), same)).alias("f"))
    return kept.select(*keys, *[F.col("f")[c].alias(c) for c in columns])


def rank(r: Column) -> Column:
    """Coordinates from OCR come first, then verified values, then confidence."""
    return F.struct((r["source"] == "OCR_REFINED").cast("int").alias("a"), F.coalesce(r["verified"], F.lit(False)).cast("int").alias("b"), r["confidence"].alias("c"))


def merge_regions(regions: DataFrame, threshold: float = 0.6, keys: Sequence[str] = ("page",)) -> DataFrame:
    """Regions (ord, type, bbox, source, verified, confidence) without repeats.

    In input order, a region meets the first kept one of its type with enough overlap, and takes
    its place, there and then, if it ranks higher; it is not compared with the others again.
    """
    columns = [c for c in regions.columns if c not in keys]
    grouped = gather(regions, keys, F.struct("ord"), columns)
    same = lambda k, r: (k["type"] == r["type"]) & (iou(k["bbox"], r["bbox"]) >= threshold)

    def step(kept: Column, r: Column) -> Column:
        hits = F.transform(kept, lambda k: same(k, r))
        at = F.array_position(hits, F.lit(True))
        swap = F.transform(kept, lambda k, i: F.when((i + 1 == at) & (rank(r) > rank(k)), r).otherwise(k))
        return F.when(at > 0, swap).otherwise(F.array_append(kept, r))

    kept = grouped.select(*keys, F.explode(F.aggregate("rows", F.col("_none"), step)).alias("r"))
    return kept.select(*keys, *[F.col("r")[c].alias(c) for c in columns])


def union_items(regions: DataFrame, least: float = 0.3, keys: Sequence[str] = ("page",)) -> DataFrame:
    """Items (key, type, bbox, found_by) of several variants: regions (variant, variant_ord, ord, type, bbox, key).

    A region joins the first item of its type that overlaps it enough and whose key is the same or
    empty on either side; an empty key is filled in by the first that is not.
    """
    item = F.struct("key", "type", "bbox", F.array("variant").alias("found_by"))
    prepared = regions.withColumn("item", item)
    grouped = gather(prepared, keys, F.struct("variant_ord", "ord"), ["item"])
    grouped = grouped.withColumn("rows", F.transform("rows", lambda r: r["item"])).withColumn("_none", F.transform("_none", lambda r: r["item"]))
    same = lambda k, r: (k["type"] == r["type"]) & (overlap_ratio(k["bbox"], r["bbox"]) >= least) & ((k["key"] == "") | (r["key"] == "") | (k["key"] == r["key"]))

    def step(kept: Column, r: Column) -> Column:
        at = F.array_position(F.transform(kept, lambda k: same(k, r)), F.lit(True))
        joined = lambda k: F.struct(F.when(k["key"] == "", r["key"]).otherwise(k["key"]).alias("key"), k["type"].alias("type"), k["bbox"].alias("bbox"), F.array_union(k["found_by"], r["found_by"]).alias("found_by"))
        return F.when(at > 0, F.transform(kept, lambda k, i: F.when(i + 1 == at, joined(k)).otherwise(k))).otherwise(F.array_append(kept, r))

    return grouped.select(*keys, F.explode(F.aggregate("rows", F.col("_none"), step)).alias("i")).select(*keys, "i.*")


def reading_order(boxes: DataFrame, tolerance: float = 0.6, keys: Sequence[str] = ("page",)) -> DataFrame:
    """Boxes (idx, bbox) with row and position from 0, rows from top to bottom and then by the left edge.

    A box belongs to the row whose first box's centre is near enough; the row's later boxes do not move that centre.
    """
    columns = [c for c in boxes.columns if c not in keys]
    middle = (F.col("bbox.y1") + F.col("bbox.y2")) / 2.0
    tall = F.median(F.when(F.col("bbox.y2") > F.col("bbox.y1"), F.col("bbox.y2") - F.col("bbox.y1")))
    limits = boxes.groupBy(*keys).agg((F.coalesce(tall, F.lit(1.0)) * tolerance).alias("_tol"))
    grouped = gather(boxes, keys, F.struct(middle.alias("cy"), F.col("bbox.x1").alias("x"), "idx"), columns).join(limits, list(keys))
    start = F.struct(F.lit(-1).alias("row"), F.lit(0.0).alias("ref"), F.array().cast("array<int>").alias("rows"))

    def step(a: Column, r: Column) -> Column:
        cy = r["_order"]["cy"]
        new = (a["row"] < 0) | (F.abs(cy - a["ref"]) > F.col("_tol"))
        row = F.when(new, a["row"] + 1).otherwise(a["row"])
        return F.struct(row.alias("row"), F.when(new, cy).otherwise(a["ref"]).alias("ref"), F.array_append(a["rows"], row).alias("rows"))

    placed = F.zip_with("rows", F.aggregate("rows", start, step)["rows"], lambda r, n: F.struct(n.alias("line"), r["_order"]["x"].alias("x"), r["_order"]["cy"].alias("cy"), r["idx"].alias("i"), r.alias("r")))
    out = grouped.select(*keys, F.posexplode(F.array_sort(placed)).alias("position", "p"))
    return out.select(*keys, *[F.col("p.r")[c].alias(c) for c in columns], F.col("p.line").alias("row"), "position")
