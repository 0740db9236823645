"""The whole way from recorded answers to numbered regions, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions.geometry import crop_box, crop_pixels, denorm, fit_side, smart_resize
from veilframe.functions.textnorm import match_form
from veilframe.operators.attempts import TOKENS, first_success, shrunk, to_repeat
from veilframe.operators.decode import findings
from veilframe.operators.localize import MAX_JOIN, match_text, regions
from veilframe.operators.trainset import page_tiles
from veilframe.operators.verify import finalize, verify
from veilframe.sources.config import Settings
from veilframe.sources.pages import Provider


def detect(responses: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Findings of answers (page, tile, sample, raw, rect, seen_w, seen_h, page_w, page_h)."""
    s = settings or Settings()
    sizes = responses.select("page", "page_w", "page_h").distinct()
    return findings(responses, s.convention).join(sizes, "page")


def crops(found: DataFrame, ratio: float, settings: Settings | None = None) -> DataFrame:
    """Findings with the area in which OCR is to look."""
    s = settings or Settings()
    return found.withColumn("crop", crop_box(denorm(F.col("rect"), F.col("page_w"), F.col("page_h")), F.col("page_w"), F.col("page_h"), ratio, s.min_pad))


def with_norm(boxes: DataFrame) -> DataFrame:
    form = boxes.withColumn("_form", match_form(F.col("text")))
    return form.select(*boxes.columns, F.col("_form.text").alias("norm"), F.col("_form.starts").alias("norm_starts"), F.col("_form.ends").alias("norm_ends"))


def requests(pages: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The calls of pages (page, page_w, page_h), one for each tile and sample, in order by tile and sample.

    (page, page_w, page_h, tile, sample, rect, crop, seen_w, seen_h, shrunk, temperature): crop is what is cut out,
    seen the size that the encoder sees, after the longer side was limited. One sample leaves the temperature
    to the server.
    """
    s = settings or Settings()
    t = page_tiles(pages, s.tiles, s.overlap, s.factor)
    cut = t.withColumn("crop", crop_pixels(F.col("rect"), F.col("page_w"), F.col("page_h")))
    h, w = F.col("crop.y2") - F.col("crop.y1"), F.col("crop.x2") - F.col("crop.x1")
    cut = cut.withColumn("_sent", fit_side(h, w, s.image_max_side)).withColumn("_seen", smart_resize(F.col("_sent.h"), F.col("_sent.w"), s.factor, s.max_pixels))
    rows = cut.withColumn("sample", F.explode(F.sequence(F.lit(0), F.lit(max(1, s.samples) - 1))))
    temperature = F.lit(s.sample_temperature if s.samples > 1 else None).cast("double")
    return rows.select(
        "page", "page_w", "page_h", "tile", "sample", "rect", "crop", F.col("_seen.w").alias("seen_w"), F.col("_seen.h").alias("seen_h"),
        shrunk(F.col("_seen.w"), F.col("_seen.h"), w, h).alias("shrunk"), temperature.alias("temperature"),
    )


def ask(provider: Provider, asked: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Requests with the answer that counts: raw, error, finish_reason, attempt and attempts.

    The provider gets the requests with attempt and max_tokens and adds raw, error and finish_reason. Calls without a
    usable answer are made again, up to the setting's retries, with more tokens after a cut. Each round of
    answers is a checkpoint, as a call must not be made twice.
    """
    s = settings or Settings()
    keys = ("page", "tile", "sample")
    context = asked.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(asked.sparkSession.conf.get("spark.sql.warehouse.dir"))
    open_, tried = asked.withColumn("attempt", F.lit(0)).withColumn("max_tokens", F.lit(TOKENS)), None
    for _ in range(s.retries + 1):
        now = provider.answer(open_).select(*keys, "attempt", "raw", "error", "finish_reason").checkpoint()
        tried = now if tried is None else tried.unionByName(now)
        open_ = asked.join(to_repeat(tried, keys, s.retries), list(keys))
        if open_.isEmpty():
            break
    return asked.join(first_success(tried, keys), list(keys), "left")


def warnings(asked: DataFrame) -> DataFrame:
    """(page, warning) of answered requests: tiles that were shrunk much, calls that failed."""
    size = lambda c: F.concat(F.col(f"{c}_w").cast("string"), F.lit("x"), F.col(f"{c}_h").cast("string"))
    tile = F.concat(F.lit("tile "), F.col("tile").cast("string"))
    small = asked.filter("shrunk").select("page", F.concat(tile, F.lit(" reaches the encoder as "), size("seen"), F.lit(" only")).alias("warning"))
    return small.unionByName(asked.filter("error IS NOT NULL").select("page", F.concat(tile, F.lit(": "), F.col("error")).alias("warning"))).distinct()


def to_retry(found: DataFrame, tight: DataFrame, max_join: int = MAX_JOIN) -> DataFrame:
    """Findings with a text that no tight crop's box shows; only for these is OCR asked again, in a wider crop."""
    pairs = found.join(tight.withColumnRenamed("text", "box_text"), ["page", "ord"], "left")
    return found.filter(F.trim("text") != "").join(match_text(pairs, max_join).select("page", "ord"), ["page", "ord"], "left_anti")


def pool(tight: DataFrame, wide: DataFrame, retried: DataFrame) -> DataFrame:
    """Boxes to choose from: the wide crop's where it was asked for, else the tight crop's.

    A wide crop is only asked for where the tight one showed no match. If it shows one, its boxes are
    needed for the place; if not, the model's place is off, and the choice by place needs the wider view. So the
    tight crop's boxes of such findings are not used again.
    """
    keys = retried.select("page", "ord")
    return tight.join(keys, ["page", "ord"], "left_anti").unionByName(wide.join(keys, ["page", "ord"], "left_semi"))


def analyse(responses: DataFrame, tight: DataFrame, wide: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Regions of pages. tight and wide are recorded OCR boxes (page, ord, idx, bbox, text, status) of each finding's two crops."""
    s = settings or Settings()
    found = crops(detect(responses, s), s.pad_ratio, s)
    t, w = with_norm(tight), with_norm(wide)
    again = to_retry(found, t, s.max_join)
    far = crops(found, s.retry_pad_ratio, s).select("page", "ord", F.col("crop").alias("_far"))
    asked = found.join(again.select("page", "ord", F.lit(True).alias("_again")), ["page", "ord"], "left").join(far, ["page", "ord"])
    asked = asked.withColumn("crop", F.when(F.col("_again"), F.col("_far")).otherwise(F.col("crop"))).drop("_again", "_far")
    placed = regions(asked, pool(t, w, again), s.geometry_fallback, s.max_join, s.min_cover)
    return finalize(verify(placed, s.retype_on_checksum), s.dedup_iou)
