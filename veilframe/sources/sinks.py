"""What is written: page documents, overlays' labels, training rows, manifests, and rows that failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.reports import page_stats


def stem(path: Column, page_no: Column) -> Column:
    """File name without folder and suffix; a PDF page adds its number, three digits or more."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    digits = page_no.cast("string")
    return F.when(page_no.isNotNull(), F.concat(name, F.lit("_p"), F.lpad(digits, F.greatest(F.lit(3), F.length(digits)), F.lit("0")))).otherwise(name)


def corners(b: Column) -> Column:
    return F.array(b["x1"], b["y1"], b["x2"], b["y2"])


def _region_rows(regions: DataFrame, debug: bool) -> DataFrame:
    """(page, regions): each page's regions in order of their ids, boxes as arrays; debug adds what led to them."""
    more = [F.transform("member_boxes", corners).alias("member_boxes"), "member_index", corners(F.col("vlm_bbox")).alias("vlm_bbox")] if debug else []
    row = F.struct("id", "type", corners(F.col("bbox")).alias("bbox"), "source", F.round("confidence", 4).alias("confidence"), "text", "vlm_text", "field", "ocr_status", "needs_review", "low_confidence", "verified", "checksum", "agreement", "reason", *more)
    return regions.groupBy("page").agg(F.array_sort(F.collect_list(row)).alias("regions"))


def _counted(regions: DataFrame, column: str) -> DataFrame:
    """(page, by_<column>): how many regions each value has, as a map."""
    counts = regions.groupBy("page", column).agg(F.count("*").alias("n"))
    return counts.groupBy("page").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(f"by_{column}"))


def page_documents(
    pages: DataFrame, regions: DataFrame, findings: DataFrame, boxes: DataFrame, timings: DataFrame | None = None, warnings: DataFrame | None = None, debug: bool = False, answers: DataFrame | None = None,
) -> DataFrame:
    """(page, file, json): one document for each of pages (page, path, page_no, page_w, page_h), also for those without regions.

    A document has image_path, page_no, page (width, height), regions, timings, warnings and stats.
    timings: page and a map; warnings: page, warning; boxes: the OCR boxes by page. debug adds findings,
    ocr_boxes and, from answers (page, tile, sample, raw), raw_llm.
    """
    stats = page_stats(regions, findings).join(boxes.groupBy("page").agg(F.count("*").alias("n_ocr_boxes")), "page", "full")
    stats = stats.join(_counted(regions, "source"), "page", "full").join(_counted(regions, "type"), "page", "full")
    d = pages.join(_region_rows(regions, debug), "page", "left").join(stats, "page", "left")
    d = d.join(timings, "page", "left") if timings is not None else d.withColumn("timings", F.lit(None).cast("map<string,double>"))
    said = warnings.groupBy("page").agg(F.array_sort(F.collect_list("warning")).alias("warnings")) if warnings is not None else None
    d = d.join(said, "page", "left") if said is not None else d.withColumn("warnings", F.lit(None).cast("array<string>"))
    none = lambda c: F.coalesce(F.col(c), F.array().cast(d.schema[c].dataType))
    counts = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("n_findings", "n_regions", "n_ocr_boxes", "localized_rate", "n_disagreement", "n_checksum_failed", "n_needs_review")]
    maps = [F.coalesce(F.col(c), F.create_map().cast("map<string,bigint>")).alias(c) for c in ("by_source", "by_type")]
    rounded = F.transform_values(F.coalesce("timings", F.create_map().cast("map<string,double>")), lambda _, v: F.round(v, 3))
    body = [
        F.col("path").alias("image_path"), "page_no", F.struct(F.col("page_w").alias("width"), F.col("page_h").alias("height")).alias("page"), none("regions").alias("regions"),
        rounded.alias("timings"), none("warnings").alias("warnings"), F.struct(*counts, *maps).alias("stats"),
    ]
    if debug:
        found = findings.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ord", "type", "text", "field", "conf", corners(F.col("rect")).alias("bbox_norm")))).alias("findings"))
        read = boxes.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("ord", "idx", corners(F.col("bbox")).alias("bbox"), "text", "status"))).alias("ocr_boxes"))
        d = d.join(found, "page", "left").join(read, "page", "left")
        body += [none("findings").alias("findings"), none("ocr_boxes").alias("ocr_boxes")]
        if answers is not None:
            raw = answers.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("tile", "sample", "raw"))).alias("raw_llm"))
            d = d.join(raw, "page", "left")
            body += ["raw_llm"]
    return d.select("page", F.concat(stem(F.col("path"), F.col("page_no")), F.lit(".json")).alias("file"), F.to_json(F.struct(*body), {"ignoreNullFields": "false"}).alias("json"))


def page_json(regions: DataFrame, debug: bool = False) -> DataFrame:
    """(page, json) with the page's regions alone."""
    return _region_rows(regions, debug).select("page", F.to_json(F.struct("regions")).alias("json"))


def write_pages(documents: DataFrame, path: str) -> None:
    """The json of page_documents() or page_json() below path, one document a line; Spark names the files."""
    documents.select("json").write.mode("overwrite").text(path)


def overlay_label(id_: Column, label: Column, conf: Column, checksum: Column, review: Column) -> Column:
    mark = F.when(checksum == "ok", " OK").when(checksum == "failed", " X").when(review, " !").otherwise("")
    return F.concat(id_, F.lit(" "), label, F.lit(" "), F.format_string("%.2f", conf), mark)


def summary_line(stats: DataFrame, warnings: DataFrame | None = None) -> DataFrame:
    """(page, line) of page_stats(): what was found, placed and is to be reviewed, and how many warnings there are."""
    text = F.format_string("%s: %d regions, %d localized (%.1f %%), %d to review", F.col("page").cast("string"), "n_regions", "n_localized", F.col("localized_rate") * 100, "n_needs_review")
    if warnings is None:
        return stats.select("page", text.alias("line"))
    counted = stats.join(warnings.groupBy("page").agg(F.count("*").alias("_w")), "page", "left")
    return counted.select("page", F.concat(text, F.when(F.col("_w") > 0, F.format_string(", %d warnings", "_w")).otherwise("")).alias("line"))


def failures(pages: DataFrame) -> DataFrame:
    """Dead letters: pages (page, error) whose processing failed, with the file their error goes to."""
    return pages.filter("error IS NOT NULL").select("page", "error", F.concat(F.col("page").cast("string"), F.lit(".error.txt")).alias("file"))


def write_failures(pages: DataFrame, path: str) -> int:
    """The dead letters below path, as JSON lines; how many there are, so that a run may end with an error."""
    dead = failures(pages)
    dead.write.mode("overwrite").json(path)
    return dead.sparkSession.read.schema(dead.schema).json(path).count()


def manifest(files: DataFrame) -> DataFrame:
    """(path, sha256) of files (path, content)."""
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def safe_path(path: Column) -> Column:
    """The path, or an error where it leaves the folder that a manifest is for."""
    outside = path.startswith("/") | path.rlike(r"(^|/)\.\.(/|$)") | path.contains("\\")
    return F.when(outside, F.raise_error(F.concat(F.lit("path leaves its folder: "), path)).cast("string")).otherwise(path)


def folder_digest(files: DataFrame) -> DataFrame:
    """(folder, digests): the digests of each folder's files as a map, by path (folder, path, content)."""
    rows = files.select("folder", F.struct(safe_path(F.col("path")).alias("path"), F.sha2("content", 256).alias("sha256")).alias("e"))
    return rows.groupBy("folder").agg(F.map_from_entries(F.array_sort(F.collect_list("e"))).alias("digests"))


def compare_manifests(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, state): ok, missing, mismatch, or extra, which is no failure."""
    e, a = expected.withColumnRenamed("sha256", "want"), actual.withColumnRenamed("sha256", "got")
    state = F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "extra").when(F.col("want") == F.col("got"), "ok").otherwise("mismatch")
    return e.join(a, "path", "full").select("path", state.alias("state"))
