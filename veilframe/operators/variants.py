"""Several settings over the same pages: what each found, which pages each has, and all items together."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.operators.folds import union_items
from veilframe.sources.config import Settings


def overlays(base: Settings, changes: dict[str, dict]) -> dict[str, Settings]:
    """The settings of each variant: base with its changes. A name that base does not have raises an error."""
    known = {f.name for f in dataclasses.fields(base)}
    for name, change in changes.items():
        if unknown := set(change) - known:
            raise ValueError(f"variant {name!r} sets unknown {sorted(unknown)}")
    return {name: dataclasses.replace(base, **change) for name, change in changes.items()}


def run_each(settings: dict[str, Settings], run: Callable[[Settings], DataFrame]) -> DataFrame:
    """What run gives for each variant's settings, with variant and variant_ord, in one table."""
    out = None
    for i, (name, own) in enumerate(settings.items()):
        one = run(own).withColumn("variant", F.lit(name)).withColumn("variant_ord", F.lit(i))
        out = one if out is None else out.unionByName(one)
    return out


def variant_stats(regions: DataFrame, findings: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """(variant, findings, regions, localized, disagree, review, warnings): figures that mean something without a truth.

    localized is the share of regions that OCR placed, 0 without regions. A variant that any table names has a row.
    """
    refined = F.count_if(F.col("source") == "OCR_REFINED")
    r = regions.groupBy("variant").agg(F.count("*").alias("regions"), (refined / F.count("*")).alias("localized"), F.count_if(F.col("agreement") != "EXACT").alias("disagree"), F.count_if("needs_review").alias("review"))
    out = findings.groupBy("variant").agg(F.count("*").alias("findings")).join(r, "variant", "full")
    w = warnings.groupBy("variant").agg(F.count("*").alias("warnings")) if warnings is not None else None
    out = out.join(w, "variant", "full") if w is not None else out.withColumn("warnings", F.lit(0).cast("long"))
    return out.fillna(0).select("variant", "findings", "regions", "localized", "disagree", "review", "warnings")


def page_union(pages: DataFrame) -> DataFrame:
    """(page, variants): every page that some variant has, with the variants that have it, by name."""
    return pages.groupBy("page").agg(F.array_sort(F.collect_set("variant")).alias("variants"))


def ordered_items(regions: DataFrame, least: float = 0.3) -> DataFrame:
    """Items of all variants (union_items) with item, their number on the page from 0, from top to bottom and left to right.

    Items at one place stand in the order of their type and key.
    """
    order = Window.partitionBy("page").orderBy("bbox.y1", "bbox.x1", "type", "key", "bbox.y2", "bbox.x2")
    return union_items(regions, least).withColumn("item", F.row_number().over(order) - 1)


def comparison_json(stats: DataFrame, items: DataFrame) -> DataFrame:
    """(page, json): a line with every variant's figures and the number of items, page null, and a line for each page's items."""
    own = F.struct(*[c for c in stats.columns if c != "variant"])
    by_name = F.map_from_entries(F.array_sort(F.collect_list(F.struct("variant", own.alias("stats")))))
    total = items.agg(F.count("*").alias("union_total"))
    head = stats.agg(by_name.alias("variants")).crossJoin(F.broadcast(total))  # one row each
    head = head.select(F.lit(None).cast(items.schema["page"].dataType).alias("page"), F.to_json(F.struct("variants", "union_total")).alias("json"))
    return head.unionByName(items.groupBy("page").agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("item", item_row().alias("i")))), lambda x: x["i"]).alias("items"))).alias("json")))


def item_row() -> Column:
    return F.struct("type", F.col("key").alias("text"), F.array("bbox.x1", "bbox.y1", "bbox.x2", "bbox.y2").alias("bbox"), F.array_sort("found_by").alias("found_by"))
