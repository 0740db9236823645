"""Reports over regions: page statistics, drift of coordinates, comparison of variants. None selects a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.geometry import overlap_ratio
from veilframe.functions.numeric import num

SHIFT, SCALE_TOLERANCE, ALIGNED, MOSTLY = 0.015, 0.03, 0.005, 0.5
GAP_WIDE, GAP_NARROW = 0.10, 0.02


def page_stats(regions: DataFrame, findings: DataFrame | None = None) -> DataFrame:
    """Counts per page. localized_rate is the share of the page's final regions whose place is OCR's; n_findings counts before repeats went."""
    refined = F.count_if(F.col("source") == "OCR_REFINED")
    stats = regions.groupBy("page").agg(
        F.count("*").alias("n_regions"), refined.alias("n_localized"), F.round(refined / F.count("*"), 3).alias("localized_rate"),
        F.count_if(F.col("agreement") != "EXACT").alias("n_disagreement"), F.count_if(F.coalesce(F.col("checksum") == "failed", F.lit(False))).alias("n_checksum_failed"), F.count_if("needs_review").alias("n_needs_review"),
    )
    if findings is None:
        return stats
    counted = findings.groupBy("page").agg(F.count("*").alias("n_findings"))
    zero = {c: 0 for c in stats.columns if c != "page"}
    return counted.join(stats, "page", "full").fillna(zero | {"n_findings": 0})


def counts_by(regions: DataFrame, *columns: str) -> DataFrame:
    """Rows per value of each column, as (kind, value, n), in one pass."""
    sets = ", ".join(f"({c})" for c in columns)
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for c in columns:
        name, value = F.when(F.col(c).isNotNull(), c).otherwise(name), F.coalesce(value, F.col(c).cast("string"))
    known = regions.select(*[F.coalesce(F.col(c).cast("string"), F.lit("?")).alias(c) for c in columns])
    grouped = known.sparkSession.sql(f"SELECT {', '.join(columns)}, count(*) AS n FROM {{known}} GROUP BY GROUPING SETS ({sets})", known=known)
    return grouped.select(name.alias("kind"), value.alias("value"), "n")


def basis(r: str = "") -> Column:
    """Why a region is where it is, from its fields alone."""
    c = lambda n: F.col(f"{r}{n}")
    return F.when(c("source") != "OCR_REFINED", "coarse").when(c("agreement") == "EXACT", "text").when(F.size(c("member_boxes")) > F.size(c("member_index")), "nearby").otherwise("geometry")


def tally(regions: DataFrame) -> DataFrame:
    return regions.groupBy(basis().alias("basis")).count().withColumnRenamed("count", "n")


def conventions(calls: DataFrame) -> DataFrame:
    """Calls per coordinate convention, the most frequent first, then by first use."""
    return calls.groupBy("convention").agg(F.count("*").alias("n"), F.min("call").alias("first")).orderBy(F.desc("n"), "first")


def centre_pairs(regions: DataFrame) -> DataFrame:
    """Centres, as shares of the page, of the model's box and of the boxes OCR found, for regions that OCR placed."""
    found = F.slice("member_boxes", F.lit(1), F.greatest(F.size("member_index"), F.lit(0)))
    ok = regions.filter((F.col("source") == "OCR_REFINED") & F.col("vlm_bbox").isNotNull() & (F.col("page_w") > 0) & (F.col("page_h") > 0) & (F.size("member_index") > 0))
    side = lambda f, n: f(F.transform(found, lambda b: b[n]))
    return ok.select(
        ((F.col("vlm_bbox.x1") + F.col("vlm_bbox.x2")) / 2.0 / F.col("page_w")).alias("vx"), ((F.col("vlm_bbox.y1") + F.col("vlm_bbox.y2")) / 2.0 / F.col("page_h")).alias("vy"),
        ((side(F.array_min, "x1") + side(F.array_max, "x2")) / 2.0 / F.col("page_w")).alias("ox"), ((side(F.array_min, "y1") + side(F.array_max, "y2")) / 2.0 / F.col("page_h")).alias("oy"),
    )


#: Parts of each of two levels: distinct values are ranked in PARTS squared cells.
PARTS = 32


def spread(df: DataFrame, value: Column) -> DataFrame:
    """n, median, low and high of a value. Low is the sorted value before the first tenth, high the one at nine tenths.

    Exact order statistics without one sorted list: distinct values are ranked within cells that hold about
    as many of them each, cut at approximate quantiles, and a cell starts where the counts of those before it end.
    """
    counted = df.select(value.cast("double").alias("v")).filter("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("k"))
    shares = [i / PARTS**2 for i in range(1, PARTS**2)]
    ends = counted.agg(F.percentile_approx("v", F.array(*[F.lit(x) for x in shares]), F.lit(20 * PARTS**2)).alias("cuts"), F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    placed = counted.crossJoin(F.broadcast(ends))  # one row
    below = lambda cuts: F.size(F.filter(cuts, lambda c: c < F.col("v")))
    placed = placed.withColumn("part", below(F.filter("cuts", lambda c, i: i % PARTS == PARTS - 1)))
    placed = placed.withColumn("cell", F.col("part") * PARTS + below(F.slice("cuts", F.col("part") * PARTS + 1, F.lit(PARTS - 1)))).drop("cuts")
    cells = placed.groupBy("cell").agg(F.sum("k").alias("own"))  # PARTS squared rows at most
    before = cells.select("cell", (F.sum("own").over(Window.partitionBy(F.lit(0)).orderBy("cell")) - F.col("own")).alias("before"))
    ranked = placed.join(F.broadcast(before), "cell").withColumn("upto", F.col("before") + F.sum("k").over(Window.partitionBy("cell").orderBy("v")))
    at = lambda i: F.min(F.when(F.col("upto") > i, F.col("v")))
    n = F.col("n")
    middle = (at(F.floor((n - 1) / 2)) + at(F.floor(n / 2))) / 2
    low, high = at(F.greatest(F.lit(0), F.floor(n * 0.10) - 1)), at(F.least(n - 1, F.floor(n * 0.90)))
    return ranked.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), middle.alias("median"), low.alias("low"), high.alias("high"))


def slope(x: Column, y: Column) -> Column:
    """Least-squares slope and its standard error, or null for under four points or too narrow a range of x."""
    n, sxx = F.regr_count(y, x), F.regr_sxx(y, x)
    ssr = F.regr_syy(y, x) - F.pow(F.regr_sxy(y, x), F.lit(2)) / sxx
    fit = F.struct(F.regr_slope(y, x).alias("k"), F.sqrt(F.greatest(ssr, F.lit(0.0)) / (n - 2) / sxx).alias("se"))
    return F.when((n >= 4) & (F.max(x) - F.min(x) >= 0.25) & (sxx > 0), fit)


def off_scale(fit: Column) -> Column:
    return F.coalesce(F.abs(fit["k"] - 1) > F.greatest(F.lit(SCALE_TOLERANCE), 2 * fit["se"]), F.lit(False))


def verdict(bad_calls: Column, coarse: Column, total: Column, fit_x: Column, fit_y: Column, shift_x: Column, shift_y: Column, spread_x: Column, spread_y: Column, pairs: Column) -> Column:
    """What is wrong with the coordinates, the first that applies; array, as the first two can stand beside the rest."""
    notes = F.array_compact(F.array(F.when(bad_calls > 0, "convention"), F.when((total > 0) & (coarse / total > MOSTLY), "ocr_finds_little")))
    placed = (
        F.when(off_scale(fit_x) | off_scale(fit_y), "scale")
        .when((F.abs(shift_x) > SHIFT) | (F.abs(shift_y) > SHIFT), "shift")
        .when((F.abs(spread_x) < ALIGNED) & (F.abs(spread_y) < ALIGNED), "aligned")
        .otherwise("random")
    )
    return F.when(pairs > 0, F.array_append(notes, placed)).when(F.size(notes) == 0, F.array(F.lit("too_few"))).otherwise(notes)


def relative_recall(items: DataFrame, variants: list[str]) -> DataFrame:
    """For each variant, the share of all items it found and how many it alone found."""
    rows = F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.array_contains("found_by", v).alias("found"), (F.col("found_by") == F.array(F.lit(v))).alias("solo")) for v in variants])).alias("r")
    return items.select(rows).groupBy("r.variant").agg(F.count_if("r.found").alias("n_found"), F.round(F.count_if("r.found") / F.count("*"), 6).alias("recall"), F.count_if("r.solo").alias("n_solo"))


def gap_verdict(best: Column, worst: Column) -> Column:
    gap = best - worst
    return F.when(gap >= GAP_WIDE, "wide").when(gap <= GAP_NARROW, "narrow").otherwise("between")


def truth_recall(truth: DataFrame, regions: DataFrame, least: float = 0.3) -> DataFrame:
    """Share of true regions (page, ord, type, bbox, difficulty) that some region of their type covers, by difficulty."""
    r = regions.select("page", "type", F.col("bbox").alias("_b"))
    hit = truth.join(r, ["page", "type"]).filter(overlap_ratio(F.col("bbox"), F.col("_b")) >= least).select("page", "ord").distinct().withColumn("hit", F.lit(True))
    return truth.join(hit, ["page", "ord"], "left").groupBy("difficulty").agg(F.count("*").alias("n"), F.count_if(F.coalesce("hit", F.lit(False))).alias("n_found"), F.round(F.count_if(F.coalesce("hit", F.lit(False))) / F.count("*"), 6).alias("recall"))


def drift(regions: DataFrame, bad_calls: Column | int = 0) -> DataFrame:
    """One row: how the model's boxes lie against OCR's, and the verdict on it.

    n pairs of centres with the slope, its error, and the spread of the shift on each axis; coarse and total count
    the regions. bad_calls says how many answers had an unexpected convention.
    """
    pairs = centre_pairs(regions)
    fits = pairs.agg(F.count("*").alias("pairs"), slope(F.col("vx"), F.col("ox")).alias("fit_x"), slope(F.col("vy"), F.col("oy")).alias("fit_y"))
    x, y = (spread(pairs, F.col(f"o{a}") - F.col(f"v{a}")).select(F.struct("median", (F.col("high") - F.col("low")).alias("range")).alias(f"shift_{a}")) for a in "xy")
    counts = regions.agg(F.count_if(F.col("source") != "OCR_REFINED").alias("coarse"), F.count("*").alias("total"))
    one = fits.crossJoin(F.broadcast(x)).crossJoin(F.broadcast(y)).crossJoin(F.broadcast(counts))  # one row each
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    said = verdict(num(bad_calls), F.col("coarse"), F.col("total"), F.col("fit_x"), F.col("fit_y"), zero(F.col("shift_x.median")), zero(F.col("shift_y.median")), zero(F.col("shift_x.range")), zero(F.col("shift_y.range")), F.col("pairs"))
    return one.withColumn("verdict", said)


def by_document(regions: DataFrame) -> DataFrame:
    """Regions and open reviews by document, page and type, with subtotals (nulls stand for all)."""
    return regions.rollup("doc", "page", "type").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("n_review"))
