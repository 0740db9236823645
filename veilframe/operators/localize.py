"""Values that a model read, matched to boxes that OCR found: by text first, by place second."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.checks import refined_confidence, worst_status
from veilframe.functions.geometry import COARSE_PAD, PAD, box, center_in, cover, denorm, dist2, overlap_area, pad_box, union_box

MAX_JOIN, MIN_COVER, BAND, LOW_CONFIDENCE = 4, 0.5, 0.6, 0.5
KEY = ["page", "ord"]


def candidates(findings: DataFrame, boxes: DataFrame) -> DataFrame:
    """Findings (page, ord, ...) with the boxes of their own crop (page, ord, idx, bbox, text, status, norm); findings without boxes stay.

    A finding that occurs twice raises an error: a box would belong to both.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy(*KEY))
    once = findings.withColumn("_n", n).filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("finding "), F.col("page").cast("string"), F.lit("/"), F.col("ord").cast("string"), F.lit(" occurs twice"))).cast("boolean"))).drop("_n")
    return once.join(boxes.withColumnRenamed("text", "box_text"), KEY, "left")


def number_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes (page, ord, idx) with index, their number on the page from 0, in the order of findings and then of their boxes."""
    return boxes.withColumn("index", F.row_number().over(Window.partitionBy("page").orderBy("ord", "idx")) - 1)


def pooled(findings: DataFrame, boxes: DataFrame) -> DataFrame:
    """Findings with pool, the array of their own boxes by idx, each with its number on the page (index); null without boxes.

    Boxes are gathered before they meet their findings, so findings are shuffled once and boxes twice.
    """
    fields = [c for c in ("idx", "bbox", "text", "status", "index", "norm", "norm_starts", "norm_ends") if c in [*boxes.columns, "index"]]
    own = F.sort_array(F.collect_list(F.struct(*fields))).alias("pool")
    return candidates(findings, number_boxes(boxes).groupBy(*KEY).agg(own))


def _hit(run: Column, key: Column, max_join: int) -> Column:
    """The first and narrowest run of neighbours in an array of boxes by idx whose joined norm holds the key, and at which character."""

    def first_of(width: int) -> Column:
        """The first run of this many boxes that holds the key."""
        begins = F.when(F.size(run) >= width, F.sequence(F.lit(1), F.size(run) - (width - 1))).otherwise(F.array().cast("array<int>"))
        tried = F.transform(begins, lambda i: F.struct(F.slice(run, i, width).alias("boxes")))
        placed = F.transform(tried, lambda t: F.struct(t["boxes"].alias("boxes"), F.instr(F.array_join(F.transform(t["boxes"], lambda b: b["norm"]), ""), key).alias("at")))
        return F.get(F.filter(placed, lambda t: t["at"] > 0), F.lit(0))

    return F.coalesce(*[first_of(w) for w in range(1, max_join + 1)])


def _told(origins: bool) -> list[Column]:
    """members, position and char_span of a hit; null where there is none."""
    single, at = F.size("hit.boxes") == 1, F.col("hit.at") - 1
    span = F.lit(None).cast("struct<start:int,end:int>")
    if origins:
        box = F.get("hit.boxes", F.lit(0))
        span = F.when(single, F.struct(F.get(box["norm_starts"], at).alias("start"), F.get(box["norm_ends"], at + F.length("key") - 1).alias("end")))
    return [F.transform("hit.boxes", lambda b: b["idx"]).alias("members"), F.when(single, at).alias("position"), span.alias("char_span")]


def match_text(pairs: DataFrame, max_join: int = MAX_JOIN) -> DataFrame:
    """(page, ord, members, position, char_span): the narrowest run of neighbouring boxes whose joined text holds the finding's key.

    pairs has key (the finding's compared form) and norm (the box's). Boxes that failed or are blank
    don't take part. One box is tried before two, and earlier ones before later. position is the
    place of the key in a single box, from 0, and null for runs. Where pairs has norm_starts and
    norm_ends, the origins of norm's characters, char_span is the part of the box's own text, else null.
    """
    origins = [c for c in ("norm_starts", "norm_ends") if c in pairs.columns]
    usable = pairs.filter((F.col("key") != "") & (F.col("status") != "FAILED") & (F.trim("box_text") != ""))
    run = usable.groupBy(*KEY).agg(F.first("key").alias("key"), F.array_sort(F.collect_list(F.struct("idx", "norm", *origins))).alias("run"))
    hit = run.select(*KEY, "key", _hit(F.col("run"), F.col("key"), max_join).alias("hit")).filter("hit IS NOT NULL")
    return hit.select(*KEY, *_told(bool(origins)))


def _with_place(pools: DataFrame, max_join: int, min_cover: float) -> DataFrame:
    """Rows (pool, vlm, crop, ...) with place, a struct of how and members: select_by_place() within rows that hold their boxes, null where nothing is chosen."""
    middle = lambda b: (b["y1"] + b["y2"]) / 2.0
    inside = lambda b: center_in(b["bbox"], F.col("vlm"))
    covered = lambda b: cover(b["bbox"], F.col("vlm")) >= min_cover
    shared = lambda b: overlap_area(b["bbox"], F.col("vlm"))
    near = lambda b: overlap_area(b["bbox"], F.col("crop")) > 0
    far = lambda b: dist2(b["bbox"], F.col("_centre.x"), F.col("_centre.y"))
    # a tier is only looked at where those before it hold nothing
    tier = F.when(F.exists("_boxes", inside), 1).when(F.exists("_boxes", covered), 2).when(F.exists("_boxes", lambda b: shared(b) > 0), 3).when(F.exists("_boxes", near), 4)
    anchor = F.array_min(F.transform(F.filter("_boxes", near), lambda b: F.struct(far(b).alias("d"), b["idx"].alias("idx"), middle(b["bbox"]).alias("y"), (b["bbox"]["y2"] - b["bbox"]["y1"]).alias("h"))))
    line = lambda b: F.abs(middle(b["bbox"]) - F.col("_anchor.y")) <= F.greatest(F.lit(1.0), F.col("_anchor.h") * BAND)
    most = F.transform(F.slice(F.sort_array(F.transform("_boxes", lambda b: F.struct((-shared(b)).alias("o"), b["idx"].alias("idx"), b.alias("b")))), 1, 1), lambda s: s["b"])
    picked = (
        F.when(F.col("_tier") == 1, F.filter("_boxes", inside)).when(F.col("_tier") == 2, F.filter("_boxes", covered))
        .when(F.col("_tier") == 3, most).when(F.col("_tier") == 4, F.filter("_boxes", lambda b: near(b) & line(b)))
    )
    nearest = F.sort_array(F.transform(picked, lambda b: F.struct(far(b).alias("d"), b["idx"].alias("idx"), b["bbox"].alias("bbox"))))
    centre = F.struct(((F.col("vlm.x1") + F.col("vlm.x2")) / 2.0).alias("x"), ((F.col("vlm.y1") + F.col("vlm.y2")) / 2.0).alias("y"))
    boxes = F.transform(F.filter("pool", lambda b: b["idx"].isNotNull()), lambda b: F.struct(b["idx"].alias("idx"), b["bbox"].alias("bbox")))
    p = pools.withColumn("_boxes", boxes).withColumn("_centre", centre)
    p = p.withColumn("_tier", tier).withColumn("_anchor", F.when(F.col("_tier") == 4, anchor))
    p = p.withColumn("_picked", F.slice(nearest, 1, max_join))
    order = F.sort_array(F.transform("_picked", lambda b: F.struct(b["bbox"]["y1"].alias("y"), b["bbox"]["x1"].alias("x"), b["idx"].alias("idx"))))
    chosen = F.struct(F.when(F.col("_tier") == 4, "nearby").otherwise("geometry").alias("how"), F.transform(order, lambda s: s["idx"]).alias("members"))
    return p.withColumn("place", F.when(F.size("_picked") > 0, chosen)).drop("_boxes", "_centre", "_tier", "_anchor", "_picked")


def select_by_place(pairs: DataFrame, max_join: int = MAX_JOIN, min_cover: float = MIN_COVER) -> DataFrame:
    """(page, ord, how, members): the boxes that a finding's own box points at, whatever they say.

    pairs has vlm (the finding's box), crop (where was searched), idx and bbox. Tiers: centre inside;
    else enough of the box inside; else the one that overlaps most; else the nearest line within
    the crop. Failed readings take part: where they stand is known. At most max_join boxes, the
    nearest to the finding's centre, in reading order.
    """
    p = pairs.filter("idx IS NOT NULL")
    of = Window.partitionBy(*KEY)
    cx, cy = (F.col("vlm.x1") + F.col("vlm.x2")) / 2.0, (F.col("vlm.y1") + F.col("vlm.y2")) / 2.0
    p = p.withColumn("_d", dist2(F.col("bbox"), cx, cy)).withColumn("_o", overlap_area(F.col("bbox"), F.col("vlm")))
    p = p.withColumn("_in", center_in(F.col("bbox"), F.col("vlm"))).withColumn("_cov", cover(F.col("bbox"), F.col("vlm")) >= min_cover)
    p = p.withColumn("_near", overlap_area(F.col("bbox"), F.col("crop")) > 0)
    tier = F.when(F.bool_or("_in").over(of), 1).when(F.bool_or("_cov").over(of), 2).when(F.max("_o").over(of) > 0, 3).when(F.bool_or("_near").over(of), 4)
    most = F.row_number().over(of.orderBy(F.desc("_o"), "idx"))
    nearest = F.min_by(F.struct(((F.col("bbox.y1") + F.col("bbox.y2")) / 2.0).alias("y"), (F.col("bbox.y2") - F.col("bbox.y1")).alias("h")), F.when(F.col("_near"), F.struct("_d", "idx"))).over(of)
    p = p.withColumn("_tier", tier).withColumn("_most", most).withColumn("_anchor", nearest)
    line = F.abs((F.col("bbox.y1") + F.col("bbox.y2")) / 2.0 - F.col("_anchor.y")) <= F.greatest(F.lit(1.0), F.col("_anchor.h") * BAND)
    picked = F.when(F.col("_tier") == 1, F.col("_in")).when(F.col("_tier") == 2, F.col("_cov")).when(F.col("_tier") == 3, F.col("_most") == 1).when(F.col("_tier") == 4, F.col("_near") & line)
    p = p.filter(picked).withColumn("_r", F.row_number().over(of.orderBy("_d", "idx"))).filter(F.col("_r") <= max_join)
    order = F.array_sort(F.collect_list(F.struct(F.col("bbox.y1").alias("y"), F.col("bbox.x1").alias("x"), "idx")))
    return p.groupBy(*KEY).agg(F.when(F.max("_tier") == 4, "nearby").otherwise("geometry").alias("how"), F.transform(order, lambda s: s["idx"]).alias("members"))


def _short(text: Column, n: int) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, n)


def regions(findings: DataFrame, boxes: DataFrame, by_place: bool = True, max_join: int = MAX_JOIN, min_cover: float = MIN_COVER) -> DataFrame:
    """One region per finding; none is lost.

    findings: page, ord, page_w, page_h, type, text, field, conf, rect, key, crop; boxes: page, ord,
    idx, bbox, text, status, norm. Matched text gives EXACT agreement and the boxes' place; a choice
    by place the boxes' place, to be reviewed; a finding without either keeps the model's place, padded
    widely, and is to be reviewed. member_index holds the boxes' numbers on the page. Boxes may have norm_starts and norm_ends for char_span.
    """
    return located(pooled(findings, boxes), by_place, max_join, min_cover)


def located(pools: DataFrame, by_place: bool = True, max_join: int = MAX_JOIN, min_cover: float = MIN_COVER) -> DataFrame:
    """regions() of findings that have their boxes with them, as pooled() gives them: row by row, nothing is shuffled."""
    kind = pools.schema["pool"].dataType.elementType
    origins = [c for c in ("norm_starts", "norm_ends") if c in kind.names]
    j = pools.withColumn("vlm", denorm(F.col("rect"), F.col("page_w"), F.col("page_h")))
    usable = F.filter("pool", lambda b: (F.col("key") != "") & (b["status"] != "FAILED") & (F.trim(b["text"]) != ""))
    j = j.withColumn("_run", F.sort_array(F.transform(usable, lambda b: F.struct(*[b[c].alias(c) for c in ("idx", "norm", *origins)]))))
    j = j.withColumn("hit", _hit(F.col("_run"), F.col("key"), max_join)).drop("_run")
    members, position, char_span = _told(bool(origins))
    how = F.when(F.col("hit").isNotNull(), "text")
    if by_place:
        open_ = j.withColumn("_all", F.col("pool")).withColumn("pool", F.when(F.col("hit").isNull(), F.col("pool")))
        j = _with_place(open_, max_join, min_cover).withColumn("pool", F.col("_all"))
        how, members = F.coalesce(how, F.col("place.how")), F.coalesce(members, F.col("place.members")).alias("members")
    # a generator: filters on regions are not pushed below it, where each would repeat the whole search
    j = j.select(*pools.columns, *([] if "vlm" in pools.columns else ["vlm"]), F.inline(F.array(F.struct(how.alias("how"), members, position, char_span))))
    picked = F.transform("members", lambda i: F.element_at(F.filter("pool", lambda b: b["idx"] == i), 1))
    j = j.withColumn("picked", F.coalesce(picked, F.array().cast(j.select(picked.alias("p")).schema["p"].dataType))).withColumn("coarse", F.col("how").isNull())
    said = F.array_join(F.filter(F.transform("picked", lambda b: b["text"]), lambda t: F.coalesce(t, F.lit("")) != ""), " ")
    read = F.array_join(F.filter(F.transform("pool", lambda b: b["text"]), lambda t: F.trim(t) != ""), " ")
    agreement = F.when(F.col("how") == "text", "EXACT").otherwise("NONE")
    member = F.transform("picked", lambda b: b["bbox"])
    member = F.when(F.col("coarse"), F.array("vlm")).when(F.col("how") == "nearby", F.array_append(member, F.col("vlm"))).otherwise(member)
    j = j.withColumn("agreement", agreement).withColumn("member_boxes", member).withColumn("_said", said)
    status = F.when(F.col("coarse"), "FAILED").otherwise(worst_status(F.transform("picked", lambda b: b["status"])))
    conf = refined_confidence(F.col("agreement"), F.col("conf"))
    both = F.concat(F.lit("model '"), _short(F.col("text"), 30), F.lit("', OCR '"))
    reason = (
        F.when(F.col("how") == "text", "text found by OCR")
        .when(F.col("how") == "geometry", F.concat(F.lit("chosen by place, texts differ: "), both, _short(F.col("_said"), 40), F.lit("'")))
        .when(F.col("how") == "nearby", F.concat(F.lit("nothing overlaps, nearest line chosen: "), both, _short(F.col("_said"), 40), F.lit("'")))
        .when(F.trim("text") == "", "the model named a place but read nothing")
        .when(F.coalesce(F.size("pool"), F.lit(0)) <= 0, "OCR found no box")
        .otherwise(F.concat(F.lit("no box overlaps: "), both, _short(read, 40), F.lit("'")))
    )
    pad = lambda by: pad_box(union_box(F.col("member_boxes")), by, F.col("page_w"), F.col("page_h"))
    none = lambda c: F.when(c != "", c)
    return j.select(
        *KEY, "page_w", "page_h", "type", F.when(F.col("coarse"), pad(COARSE_PAD)).otherwise(pad(PAD)).alias("bbox"), F.when(F.col("coarse"), "VLM_COARSE").otherwise("OCR_REFINED").alias("source"),
        conf.alias("confidence"), F.when(~F.col("coarse"), none(F.col("_said"))).alias("text"), none(F.col("text")).alias("vlm_text"), F.col("vlm").alias("vlm_bbox"), none(F.col("field")).alias("field"),
        "member_boxes", F.transform("picked", lambda b: b["index"]).alias("member_index"), "position", "char_span", status.alias("ocr_status"), "coarse",
        (F.col("coarse") | (F.col("agreement") != "EXACT") | (status != "OK")).alias("needs_review"), (conf < LOW_CONFIDENCE).alias("low_confidence"), "agreement", F.coalesce("how", F.lit("coarse")).alias("how"), reason.alias("reason"),
    )
