"""Named queries over the test tables, each with SQL that gives the same rows.

The tables hold no pages, so boxes, findings and regions are made from lineitem by integer
arithmetic that Spark and DuckDB share. Patterns that pick values out of documents stand in for
the model that would have read them; finding values by pattern is no operator of this engine.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.functions import checks, geometry, jsonio, textnorm
from veilframe.functions.numeric import half_even
from veilframe.operators import attempts, decode, folds, localize, reports, trainset, verify
from veilframe.sources import pages as page_sources
from veilframe.sources import sinks

W, H = 1760, 2464
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LABELS_SQL = "CASE l_partkey % 10 " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(checks.LABELS)) + " END"
#: One row per line of an order: a box on a page, by arithmetic both engines agree on.
BOXES = f"""
SELECT page, idx, x1, y1, x1 + w AS x2, y1 + h AS y2, w, h, label, txt, conf, status, part, supp FROM (
  SELECT l_orderkey AS page, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS idx,
    CAST((l_partkey * 37) % 1500 AS INT) AS x1, CAST((l_suppkey * 53 + l_linenumber * 160) % 2300 AS INT) AS y1,
    CAST(40 + l_quantity * 4 AS INT) AS w, CAST(24 + l_linenumber * 2 AS INT) AS h, {LABELS_SQL} AS label,
    CAST(l_partkey * 1000 + l_suppkey AS STRING) AS txt, round(l_tax * 10, 4) AS conf,
    CASE WHEN l_returnflag = 'A' THEN 'OK' WHEN l_returnflag = 'N' THEN 'LOW_CONF' ELSE 'FAILED' END AS status, l_partkey AS part, l_suppkey AS supp
  FROM lineitem) AS b"""
#: The same boxes moved a little, as a model would place them.
MOVED = f"SELECT *, x1 + CAST(supp % 64 AS INT) - 32 AS mx1, y1 + CAST(part % 48 AS INT) - 24 AS my1, x2 + CAST(supp % 64 AS INT) - 32 AS mx2, y2 + CAST(part % 48 AS INT) - 24 AS my2 FROM ({BOXES}) AS m"


def run_sql(spark: SparkSession, sf_dir: str, text: str, **frames: DataFrame) -> DataFrame:
    """SQL over the test tables it names."""
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if re.search(rf"\b{t}\b", text)}
    for name in used:
        text = re.sub(rf"\b(FROM|JOIN) {name}\b", rf"\1 {{{name}}}", text)
    return spark.sql(text, **used, **frames)


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_boxes(run_sql(spark, sf_dir, MOVED))


def with_boxes(b: DataFrame) -> DataFrame:
    return b.withColumn("bbox", geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")])).withColumn("moved", geometry.box(*[F.col(c) for c in ("mx1", "my1", "mx2", "my2")]))


def boxes_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """boxes() with _page, all boxes of the page (idx, bbox, text, status, norm) by idx: the table's own columns are shuffled and sorted once, by page."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*order, "l_tax", "l_returnflag").repartition("l_orderkey").sortWithinPartitions(*order)
    b = with_boxes(run_sql(spark, sf_dir, MOVED.replace("FROM lineitem", "FROM {lines}"), lines=lines))
    own = F.struct("idx", "bbox", F.col("txt").alias("text"), "status", F.col("txt").alias("norm"))
    return b.withColumn("_page", F.sort_array(F.collect_list(own).over(Window.partitionBy("page"))))


def flat(c: str, prefix: str = "") -> list:
    return [F.col(f"{c}.{s}").alias(f"{prefix}{s}") for s in ("x1", "y1", "x2", "y2")]


# --- checks ------------------------------------------------------------------------------------

_CARDS = r"regexp_extract_all(text, '(?:^|[^0-9])([0-9]{16})(?:[^0-9]|$)', 1)"
_LUHN = "(list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 1 THEN CASE WHEN CAST(card[i] AS INT) > 4 THEN CAST(card[i] AS INT) * 2 - 9 ELSE CAST(card[i] AS INT) * 2 END ELSE CAST(card[i] AS INT) END)) % 10 = 0)"
_CARDS_SQL = rf"SELECT lang, card, {_LUHN} AS good FROM (SELECT lang, unnest({_CARDS}) AS card FROM documents)"


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = F.regexp_extract_all("text", F.lit(r"(?:^|[^0-9])([0-9]{16})(?:[^0-9]|$)"), F.lit(1))
    return docs.select("lang", F.explode(found).alias("card"))


@query(f"SELECT lang, CASE WHEN good THEN 'ok' ELSE 'failed' END AS checksum, count(*) AS n, count(*) FILTER (WHERE NOT good) AS n_review FROM ({_CARDS_SQL}) GROUP BY 1, 2")
def luhn_verify_documents(spark, sf_dir):
    c = cards(spark, sf_dir).withColumn("texts", F.array("card"))
    c = c.withColumn("checksum", checks.checksum(F.lit("CARD_NO"), F.col("texts")))
    return c.groupBy("lang", "checksum").agg(F.count("*").alias("n"), F.count_if(F.col("checksum") == "failed").alias("n_review"))


_RRN_SUM = "(" + " + ".join(f"CAST(r[{i + 1}] AS INT) * {w}" for i, w in enumerate(checks.RRN_WEIGHTS)) + ")"
_RRN_FIRST = "lpad(CAST(o_orderkey % 100 AS STRING), 2, '0') || lpad(CAST(o_custkey % 14 AS STRING), 2, '0') || lpad(CAST(o_orderkey % 33 AS STRING), 2, '0') || CAST(o_custkey % 4 + 1 AS STRING) || lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0')"


@query(
    f"SELECT k, r, (CAST(r[3:4] AS INT) BETWEEN 1 AND 12 AND CAST(r[5:6] AS INT) BETWEEN 1 AND CASE CAST(r[3:4] AS INT) WHEN 2 THEN 29 WHEN 4 THEN 30 WHEN 6 THEN 30 WHEN 9 THEN 30 WHEN 11 THEN 30 ELSE 31 END AND (11 - {_RRN_SUM} % 11) % 10 = CAST(r[13] AS INT)) AS valid"
    f" FROM (SELECT o_orderkey AS k, {_RRN_FIRST} || CAST(o_orderkey % 10 AS STRING) AS r FROM orders)"
)
def rrn_verify_generated(spark, sf_dir):
    r = run_sql(spark, sf_dir, f"SELECT o_orderkey AS k, {_RRN_FIRST} || CAST(o_orderkey % 10 AS STRING) AS r FROM orders")
    return r.select("k", "r", checks.rrn_valid(F.col("r")).alias("valid"))


@query(
    "SELECT part, label, CASE WHEN label = 'RRN' AND length(txt) <> 13 THEN true WHEN label = 'CARD_NO' AND length(txt) NOT IN (15, 16) THEN true ELSE false END AS problem, count(*) AS n"
    f" FROM ({BOXES}) GROUP BY 1, 2, 3"
)
def digit_length_check(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("problem", checks.digit_problem(F.col("label"), F.array("txt")).isNotNull())
    return b.groupBy("part", "label", "problem").agg(F.count("*").alias("n"))


@query("SELECT status, bucket, count(*) AS n FROM (SELECT status, CASE WHEN conf < 0.35 THEN 'FAILED' WHEN conf < 0.8 THEN 'LOW_CONF' ELSE 'OK' END AS bucket FROM (" + BOXES + ")) GROUP BY 1, 2")
def ocr_status_buckets(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("bucket", checks.ocr_status(F.col("txt"), F.col("conf")))
    return b.groupBy("status", "bucket").agg(F.count("*").alias("n"))


@query(f"SELECT page, CASE max(CASE status WHEN 'FAILED' THEN 2 WHEN 'LOW_CONF' THEN 1 ELSE 0 END) WHEN 2 THEN 'FAILED' WHEN 1 THEN 'LOW_CONF' ELSE 'OK' END AS worst FROM ({BOXES}) GROUP BY page")
def worst_status_by_page(spark, sf_dir):
    return boxes(spark, sf_dir).groupBy("page").agg(F.collect_set("status").alias("s")).select("page", checks.worst_status(F.col("s")).alias("worst"))


@query(f"SELECT page, idx, least(0.95, greatest(conf, 0.9)) AS exact_conf, conf AS other_conf, conf < 0.5 AS low FROM ({BOXES})")
def confidence_rules(spark, sf_dir):
    b = boxes(spark, sf_dir)
    return b.select("page", "idx", checks.refined_confidence(F.lit("EXACT"), F.col("conf")).alias("exact_conf"), checks.refined_confidence(F.lit("NONE"), F.col("conf")).alias("other_conf"), (F.col("conf") < localize.LOW_CONFIDENCE).alias("low"))


# --- geometry ----------------------------------------------------------------------------------


@query(f"SELECT page, min(x1) AS x1, min(y1) AS y1, max(x2) AS x2, max(y2) AS y2 FROM ({BOXES}) GROUP BY page")
def bbox_union_by_page(spark, sf_dir):
    b = boxes(spark, sf_dir).groupBy("page").agg(F.collect_list("bbox").alias("all"))
    return b.select("page", geometry.union_box(F.col("all")).alias("u")).select("page", *flat("u"))


_INTER = "greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1))"


@query(
    f"WITH f AS ({BOXES}) SELECT page, i, j, round(CASE WHEN s > 0 THEN s / (wa + wb - s) ELSE 0 END, 6) AS iou, round(s / least(wa, wb), 6) AS ratio FROM (SELECT a.page, a.idx AS i, b.idx AS j, CAST({_INTER} AS DOUBLE) AS s, CAST(a.w * a.h AS DOUBLE) AS wa, CAST(b.w * b.h AS DOUBLE) AS wb"
    " FROM f AS a JOIN f AS b ON a.page = b.page AND a.idx < b.idx) WHERE s > 0"
)
def bbox_iou_pairs(spark, sf_dir):
    b = boxes(spark, sf_dir).select("page", "idx", "bbox")
    pairs = b.withColumnRenamed("idx", "i").withColumnRenamed("bbox", "p").join(b.withColumnRenamed("idx", "j").withColumnRenamed("bbox", "q"), "page").filter("i < j")
    pairs = pairs.filter(geometry.overlap_area(F.col("p"), F.col("q")) > 0)
    return pairs.select("page", "i", "j", F.round(geometry.iou(F.col("p"), F.col("q")), 6).alias("iou"), F.round(geometry.overlap_ratio(F.col("p"), F.col("q")), 6).alias("ratio"))


@query(
    "WITH s AS (SELECT k, w, h, greatest(w, h) AS span FROM (SELECT o_orderkey AS k, CAST(32 * (20 + o_custkey % 60) AS INT) AS w, CAST(32 * (20 + o_orderkey % 90) AS INT) AS h FROM orders)),"
    " t AS (SELECT *, CAST(greatest(least(span, ceil(ceil(span / 3.0) / 32) * 32), least(span, ceil(ceil(span / 3.0 * 1.16) / 32) * 32)) AS INT) AS thick FROM s),"
    " u AS (SELECT *, unnest([0, 1, 2]) AS tile FROM t)"
    " SELECT k, tile, CAST(CASE tile WHEN 0 THEN 0 WHEN 2 THEN span - thick ELSE floor((span - thick) / 2.0 / 32) * 32 END AS INT) AS lo, thick AS thickness, h >= w AS upright FROM u"
)
def tile_rects_grid(spark, sf_dir):
    s = run_sql(spark, sf_dir, "SELECT o_orderkey AS k, CAST(32 * (20 + o_custkey % 60) AS INT) AS w, CAST(32 * (20 + o_orderkey % 90) AS INT) AS h FROM orders")
    t = s.select("k", "w", "h", F.posexplode(geometry.tiles(F.col("w"), F.col("h"))).alias("tile", "r")).withColumn("upright", F.col("h") >= F.col("w"))
    lo = F.when(F.col("upright"), half_even(F.col("r.y1") * F.col("h"))).otherwise(half_even(F.col("r.x1") * F.col("w")))
    hi = F.when(F.col("upright"), half_even(F.col("r.y2") * F.col("h"))).otherwise(half_even(F.col("r.x2") * F.col("w")))
    return t.select("k", "tile", lo.alias("lo"), (hi - lo).alias("thickness"), "upright")


@query(
    "WITH s AS (SELECT o_orderkey AS k, CAST(o_custkey * 7 % 9000 + 1 AS DOUBLE) AS h, CAST(o_orderkey * 13 % 7000 + 1 AS DOUBLE) AS w FROM orders),"
    " r AS (SELECT *, greatest(32, round_even(h / 32, 0) * 32) AS hb, greatest(32, round_even(w / 32, 0) * 32) AS wb FROM s)"
    " SELECT k, CAST(CASE WHEN hb * wb > 16777216 THEN greatest(32, floor(h / sqrt(h * w / 16777216) / 32) * 32) WHEN hb * wb < 4096 THEN greatest(32, ceil(trunc(h * sqrt(4096 / greatest(1, h * w))) / 32) * 32) ELSE hb END AS INT) AS h,"
    " CAST(CASE WHEN hb * wb > 16777216 THEN greatest(32, floor(w / sqrt(h * w / 16777216) / 32) * 32) WHEN hb * wb < 4096 THEN greatest(32, ceil(trunc(w * sqrt(4096 / greatest(1, h * w))) / 32) * 32) ELSE wb END AS INT) AS w FROM r"
)
def smart_resize_sizes(spark, sf_dir):
    s = run_sql(spark, sf_dir, "SELECT o_orderkey AS k, CAST(o_custkey * 7 % 9000 + 1 AS DOUBLE) AS h, CAST(o_orderkey * 13 % 7000 + 1 AS DOUBLE) AS w FROM orders")
    return s.select("k", geometry.smart_resize(F.col("h"), F.col("w")).alias("s")).select("k", "s.h", "s.w")


_SHARE = "(supp % 997) / 1000.0e0"


@query(
    f"WITH r AS (SELECT page, idx, CAST(part % 1001 AS DOUBLE) / 1000 AS a, CAST(supp % 1001 AS DOUBLE) / 1000 AS b, CAST((part + supp) % 1001 AS DOUBLE) / 1000 AS c, CAST((part * 3) % 1001 AS DOUBLE) / 1000 AS d FROM ({BOXES})),"
    " p AS (SELECT page, idx, CAST(round_even(least(a, c) * 1748, 0) AS INT) AS x1, CAST(round_even(least(b, d) * 2480, 0) AS INT) AS y1, CAST(round_even(greatest(a, c) * 1748, 0) AS INT) AS x2, CAST(round_even(greatest(b, d) * 2480, 0) AS INT) AS y2 FROM r)"
    " SELECT page, idx, x1, y1, greatest(x2, x1 + 1) AS x2, greatest(y2, y1 + 1) AS y2 FROM p"
)
def denorm_round_even(spark, sf_dir):
    b = boxes(spark, sf_dir)
    share = lambda c: (c % 1001).cast("double") / 1000
    r = geometry.rect(share(F.col("part")), share(F.col("supp")), share(F.col("part") + F.col("supp")), share(F.col("part") * 3))
    return b.select("page", "idx", geometry.denorm(r, 1748, 2480).alias("d")).select("page", "idx", *flat("d"))


def _permille(v: str, side: int) -> str:
    return f"CAST(round_even(least(greatest(CAST({v} AS DOUBLE) / {side}, 0), 1) * 1000, 0) AS INT)"


_BACK = "WITH b AS (" + BOXES + f"), p AS (SELECT page, idx, x1, y1, x2, y2, {_permille('x1', W)} AS px1, {_permille('y1', H)} AS py1, {_permille('x2', W)} AS px2, {_permille('y2', H)} AS py2 FROM b)"


@query(
    _BACK
    + f", q AS (SELECT *, CAST(round_even(px1 / 1000.0e0 * {W}, 0) AS INT) AS bx1, CAST(round_even(py1 / 1000.0e0 * {H}, 0) AS INT) AS by1, CAST(round_even(px2 / 1000.0e0 * {W}, 0) AS INT) AS bx2, CAST(round_even(py2 / 1000.0e0 * {H}, 0) AS INT) AS by2 FROM p)"
    + f" SELECT page, idx, px1, py1, px2, py2, greatest(abs(bx1 - x1), abs(by1 - y1), abs(bx2 - x2), abs(by2 - y2)) AS error_px, greatest(abs(bx1 - x1), abs(by1 - y1), abs(bx2 - x2), abs(by2 - y2)) <= {H} / 1000.0e0 + 1 AS good FROM q"
)
def permille_roundtrip(spark, sf_dir):
    full = geometry.rect(0.0, 0.0, 1.0, 1.0)
    b = boxes(spark, sf_dir).withColumn("p", geometry.to_permille(F.col("bbox"), full, W, H)).withColumn("back", geometry.roundtrip(F.col("p"), full, W, H))
    error = F.greatest(*[F.abs(F.col(f"back.{s}") - F.col(f"bbox.{s}")) for s in ("x1", "y1", "x2", "y2")])
    return b.select("page", "idx", *[F.col("p")[i].alias(n) for i, n in enumerate(("px1", "py1", "px2", "py2"))], error.alias("error_px"), (error <= geometry.quantization_limit(full, W, H) + 1).alias("good"))


@query(f"SELECT page, idx, greatest(0, x1 - 12) AS x1, greatest(0, y1 - 12) AS y1, least({W}, x2 + 12) AS x2, least({H}, y2 + 12) AS y2 FROM ({BOXES})")
def pad_boxes(spark, sf_dir):
    return boxes(spark, sf_dir).select("page", "idx", geometry.pad_box(F.col("bbox"), geometry.COARSE_PAD, W, H).alias("p")).select("page", "idx", *flat("p"))


@query(
    f"WITH b AS ({BOXES}), p AS (SELECT page, idx, greatest(0, x1 - px) AS x1, greatest(0, y1 - py) AS y1, least({W}, x2 + px) AS x2, least({H}, y2 + py) AS y2 FROM (SELECT *, greatest(64, CAST(trunc(w * 0.35e0) AS INT)) AS px, greatest(64, CAST(trunc(h * 0.35e0) AS INT)) AS py FROM b))"
    " SELECT *, round(CASE WHEN greatest(x2 - x1, y2 - y1) * 2 > 400 THEN greatest(1, 400.0e0 / greatest(x2 - x1, y2 - y1)) ELSE 2 END, 6) AS scale FROM p"
)
def crop_rects(spark, sf_dir):
    c = boxes(spark, sf_dir).select("page", "idx", geometry.crop_box(F.col("bbox"), W, H).alias("c"))
    return c.select("page", "idx", *flat("c"), F.round(geometry.crop_scale(F.col("c"), 2.0, 400), 6).alias("scale"))


@query(f"SELECT page, idx, CAST(trunc(x1 / 1.5e0) AS INT) + 10 AS x1, CAST(trunc(y1 / 1.5e0) AS INT) + 20 AS y1, CAST(round_even(x2 / 1.5e0, 0) AS INT) + 10 AS x2, CAST(round_even(y2 / 1.5e0, 0) AS INT) + 20 AS y2 FROM ({BOXES})")
def crop_to_page_boxes(spark, sf_dir):
    b = boxes(spark, sf_dir).select("page", "idx", geometry.crop_to_page(F.col("bbox"), geometry.box(10, 20, 500, 500), F.lit(1.5)).alias("p"))
    return b.select("page", "idx", *flat("p"))


@query(
    "WITH s AS (SELECT o_orderkey AS k, CAST(o_custkey % 3000 + 100 AS INT) AS w, CAST(o_orderkey % 4000 + 100 AS INT) AS h FROM orders),"
    " f AS (SELECT *, least(1760.0e0 / w, 2464.0e0 / h) AS scale FROM s),"
    " n AS (SELECT *, CAST(greatest(1, round_even(w * scale, 0)) AS INT) AS nw, CAST(greatest(1, round_even(h * scale, 0)) AS INT) AS nh FROM f)"
    " SELECT k, nw AS w, nh AS h, 1760 - nw AS pad_x, 2464 - nh AS pad_y, 1 - CAST(nw AS DOUBLE) * nh / (1760 * 2464) > 0.15 AS wasteful, CAST((32 - w % 32) % 32 AS INT) AS align_x FROM n"
)
def canvas_fit_sizes(spark, sf_dir):
    s = run_sql(spark, sf_dir, "SELECT o_orderkey AS k, CAST(o_custkey % 3000 + 100 AS INT) AS w, CAST(o_orderkey % 4000 + 100 AS INT) AS h FROM orders")
    return s.select("k", geometry.canvas_fit(F.col("w"), F.col("h")).alias("c"), geometry.align_padding(F.col("w")).alias("align_x")).select("k", "c.w", "c.h", "c.pad_x", "c.pad_y", "c.wasteful", "align_x")


@query(
    "SELECT o_orderkey AS k, CAST(CASE WHEN greatest(h, w) > 1984 THEN greatest(1, trunc(h * (1984.0e0 / greatest(h, w)))) ELSE h END AS INT) AS h, CAST(CASE WHEN greatest(h, w) > 1984 THEN greatest(1, trunc(w * (1984.0e0 / greatest(h, w)))) ELSE w END AS INT) AS w"
    " FROM (SELECT o_orderkey, CAST(o_custkey % 3000 + 1 AS INT) AS h, CAST(o_orderkey % 4000 + 1 AS INT) AS w FROM orders)"
)
def fit_side_sizes(spark, sf_dir):
    s = run_sql(spark, sf_dir, "SELECT o_orderkey AS k, CAST(o_custkey % 3000 + 1 AS INT) AS h, CAST(o_orderkey % 4000 + 1 AS INT) AS w FROM orders")
    return s.select("k", geometry.fit_side(F.col("h"), F.col("w"), 1984).alias("s")).select("k", "s.h", "s.w")


# --- answers of a model --------------------------------------------------------------------------

_NUMS = f"SELECT page, CAST(supp % 3 AS INT) AS tile, idx, CASE supp % 3 WHEN 0 THEN x1 / {W}.0e0 WHEN 1 THEN CAST(x1 AS DOUBLE) / 2 ELSE CAST(x1 AS DOUBLE) END AS v FROM ({BOXES})"


@query(f"SELECT page, tile, CASE WHEN max(abs(v)) <= 1 THEN 'unit' WHEN max(abs(v)) <= 1000 THEN 'per-mille' ELSE 'pixel' END AS convention, count(*) AS n FROM ({_NUMS}) GROUP BY page, tile")
def infer_scale_by_response(spark, sf_dir):
    v = run_sql(spark, sf_dir, _NUMS).groupBy("page", "tile").agg(F.max(F.abs("v")).alias("most"), F.count("*").alias("n"))
    return v.select("page", "tile", decode.convention(F.col("most")).alias("convention"), "n")


def _pair(a: str, b: str) -> tuple[str, str]:
    lo, hi = f"least({a}, {b})", f"greatest({a}, {b})"
    thin = f"{hi} - {lo} < 0.004"
    return f"CASE WHEN {thin} THEN greatest(0, {lo} - 0.004) ELSE {lo} END", f"CASE WHEN {thin} THEN least(1, {hi} + 0.004) ELSE {hi} END"


_UNIT = lambda v: f"least(greatest(CAST({v} AS DOUBLE) / 1000, 0), 1)"
_SX, _SY = _pair(_UNIT("part % 1300 - 100"), _UNIT("supp % 1200")), _pair(_UNIT("(part + 1) % 1300 - 100"), _UNIT("(part * 7) % 1200"))


@query(f"SELECT page, idx, round({_SX[0]}, 6) AS x1, round({_SY[0]}, 6) AS y1, round({_SX[1]}, 6) AS x2, round({_SY[1]}, 6) AS y2 FROM ({BOXES}) WHERE idx % 5 <> 4")
def sane_bbox_filter(spark, sf_dir):
    b = boxes(spark, sf_dir)
    raw = F.array(F.col("part") % 1300 - 100, (F.col("part") + 1) % 1300 - 100, F.col("supp") % 1200, (F.col("part") * 7) % 1200)
    raw = F.when(F.col("idx") % 5 == 4, F.slice(raw, 1, 3)).otherwise(raw)
    r = b.select("page", "idx", geometry.sane_rect(raw, 1000.0, 1000.0).alias("r")).filter("r IS NOT NULL")
    return r.select("page", "idx", *[F.round(c, 6).alias(n) for c, n in zip(flat("r"), ("x1", "y1", "x2", "y2"), strict=True)])


_FIND = f"SELECT page, idx AS ord, CAST(supp % 3 AS INT) AS tile, label AS type, CAST(part % 2 AS STRING) AS key, round(1 - conf / 2, 4) AS conf, CAST(x1 % 300 AS DOUBLE) / 300 AS a, CAST(y1 % 200 AS DOUBLE) / 200 AS b FROM ({BOXES})"


@query(
    f"WITH f AS (SELECT page, ord, conf, tile, CAST(ascii(type) % 2 AS STRING) AS type, key, a, b FROM ({_FIND})),"
    " g AS (SELECT page, list([{'ord': ord, 't': type, 'k': key, 'a': a, 'b': b}] ORDER BY conf DESC, tile, ord) AS l FROM f GROUP BY page),"
    " r AS (SELECT page, list_reduce(l, lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.t = x[1].t AND k.k = x[1].k AND k.a < x[1].a + 0.4 AND x[1].a < k.a + 0.4 AND k.b < x[1].b + 0.4 AND x[1].b < k.b + 0.4)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM g)"
    " SELECT page, u.ord AS ord FROM (SELECT page, unnest(kept) AS u FROM r)"
)
def finding_dedup_greedy(spark, sf_dir):
    f = run_sql(spark, sf_dir, _FIND).withColumn("type", (F.ascii("type") % 2).cast("string"))
    f = f.withColumn("rect", geometry.rect(F.col("a"), F.col("b"), F.col("a") + 0.4, F.col("b") + 0.4))
    return folds.dedup_findings(f.drop("a", "b")).select("page", "ord")


@query("SELECT user_id AS page, CASE WHEN bool_or(event_type = 'error') THEN 'call_failed' ELSE 'nothing_found' END AS reason FROM events GROUP BY user_id HAVING user_id % 4 = 0")
def empty_result_reason(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = e.withColumn("_few", F.col("user_id") % 4 == 0)
    some = F.when(~F.col("_few"), F.array(F.lit(1))).otherwise(F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.array().cast("array<int>")))
    p = e.select(F.col("user_id").alias("page"), some.alias("items"), F.when(F.col("event_type") == "error", F.lit("failed")).alias("error"))
    return decode.empty_reason(p)


# --- localisation --------------------------------------------------------------------------------


def _pairs(spark, sf_dir):
    """Each box of an order as the pool of every finding of it: the finding is the moved box."""
    b = boxes(spark, sf_dir)
    f = b.select("page", F.col("idx").alias("ord"), F.col("moved").alias("vlm"), F.substring("txt", 1, 5).alias("key"), geometry.crop_box(F.col("moved"), W, H).alias("crop"))
    return f.join(b.select("page", "idx", "bbox", F.col("txt").alias("box_text"), F.col("txt").alias("norm"), "status"), "page")


_PAIRS = f"WITH b AS ({MOVED}), p AS (SELECT f.page, f.idx AS ord, substr(f.txt, 1, 5) AS key, f.mx1, f.my1, f.mx2, f.my2, g.idx, g.x1, g.y1, g.x2, g.y2, g.txt, g.status FROM b AS f JOIN b AS g ON f.page = g.page)"


@query(_PAIRS + " SELECT page, ord, min(idx) AS idx, arg_min(instr(txt, key), idx) - 1 AS position FROM p WHERE status <> 'FAILED' AND contains(txt, key) GROUP BY page, ord")
def match_single_box(spark, sf_dir):
    m = localize.match_text(_pairs(spark, sf_dir), 1)
    return m.select("page", "ord", F.col("members")[0].alias("idx"), F.col("position").cast("long").alias("position"))


@query(
    _PAIRS
    + ", u AS (SELECT *, txt || lead(txt) OVER w AS two, lead(idx) OVER w AS nxt, txt || lead(txt) OVER w || lead(txt, 2) OVER w AS three, lead(idx, 2) OVER w AS third FROM p WHERE status <> 'FAILED' WINDOW w AS (PARTITION BY page, ord ORDER BY idx)),"
    " t AS (SELECT page, ord, 1 AS width, idx, contains(txt, key) AS hit FROM u UNION ALL SELECT page, ord, 2, idx, contains(two, key) FROM u WHERE nxt IS NOT NULL UNION ALL SELECT page, ord, 3, idx, contains(three, key) FROM u WHERE third IS NOT NULL)"
    " SELECT page, ord, CAST(min(width * 1000 + idx) // 1000 AS INT) AS width, CAST(min(width * 1000 + idx) % 1000 AS INT) AS first FROM t WHERE hit GROUP BY page, ord"
)
def match_joined_boxes(spark, sf_dir):
    m = localize.match_text(_pairs(spark, sf_dir), 3)
    return m.select("page", "ord", F.size("members").alias("width"), F.col("members")[0].alias("first"))


_PLACED = (
    _PAIRS
    + ", q AS (SELECT *, (x1 + x2) / 2.0e0 BETWEEN mx1 AND mx2 AND (y1 + y2) / 2.0e0 BETWEEN my1 AND my2 AS inside, CAST(greatest(0, least(x2, mx2) - greatest(x1, mx1)) * greatest(0, least(y2, my2) - greatest(y1, my1)) AS DOUBLE) AS o, CAST((x2 - x1) * (y2 - y1) AS DOUBLE) AS area, ((x1 + x2) / 2.0e0 - (mx1 + mx2) / 2.0e0) ** 2 + ((y1 + y2) / 2.0e0 - (my1 + my2) / 2.0e0) ** 2 AS d FROM p WHERE idx <> ord OR ord % 2 = 0),"
    " r AS (SELECT *, CASE WHEN bool_or(inside) OVER w THEN 1 WHEN bool_or(o / area >= 0.5) OVER w THEN 2 WHEN max(o) OVER w > 0 THEN 3 END AS tier, row_number() OVER (PARTITION BY page, ord ORDER BY o DESC, idx) AS best FROM q WINDOW w AS (PARTITION BY page, ord)),"
    " s AS (SELECT *, row_number() OVER (PARTITION BY page, ord ORDER BY d, idx) AS k FROM r WHERE CASE tier WHEN 1 THEN inside WHEN 2 THEN o / area >= 0.5 WHEN 3 THEN best = 1 ELSE false END)"
)


@query(_PLACED + " SELECT page, ord, idx FROM s WHERE k <= 4")
def geometry_tiers(spark, sf_dir):
    p = _pairs(spark, sf_dir).filter("idx <> ord OR ord % 2 = 0").withColumn("crop", F.col("vlm"))
    g = localize.select_by_place(p)
    return g.filter("how = 'geometry'").select("page", "ord", F.explode("members").alias("idx"))


_CROP = f"greatest(0, mx1 - greatest(64, CAST(trunc((mx2 - mx1) * 0.35e0) AS INT))) AS sx1, greatest(0, my1 - greatest(64, CAST(trunc((my2 - my1) * 0.35e0) AS INT))) AS sy1, least({W}, mx2 + greatest(64, CAST(trunc((mx2 - mx1) * 0.35e0) AS INT))) AS sx2, least({H}, my2 + greatest(64, CAST(trunc((my2 - my1) * 0.35e0) AS INT))) AS sy2"


@query(
    _PAIRS
    + f", q AS (SELECT *, {_CROP}, greatest(0, least(x2, mx2) - greatest(x1, mx1)) * greatest(0, least(y2, my2) - greatest(y1, my1)) AS o, ((x1 + x2) / 2.0e0 - (mx1 + mx2) / 2.0e0) ** 2 + ((y1 + y2) / 2.0e0 - (my1 + my2) / 2.0e0) ** 2 AS d FROM p WHERE idx <> ord),"
    " n AS (SELECT * FROM (SELECT *, max(o) OVER (PARTITION BY page, ord) AS most FROM q) WHERE most = 0 AND least(x2, sx2) > greatest(x1, sx1) AND least(y2, sy2) > greatest(y1, sy1)),"
    " a AS (SELECT *, first_value((y1 + y2) / 2.0e0) OVER w AS ay, first_value(y2 - y1) OVER w AS ah FROM n WINDOW w AS (PARTITION BY page, ord ORDER BY d, idx)),"
    " k AS (SELECT *, row_number() OVER (PARTITION BY page, ord ORDER BY d, idx) AS r FROM a WHERE abs((y1 + y2) / 2.0e0 - ay) <= greatest(1, ah * 0.6e0))"
    " SELECT page, ord, idx FROM k WHERE r <= 4"
)
def nearby_line(spark, sf_dir):
    g = localize.select_by_place(_pairs(spark, sf_dir).filter("idx <> ord"))
    return g.filter("how = 'nearby'").select("page", "ord", F.explode("members").alias("idx"))


_ORDERED = (
    f"WITH b AS ({BOXES}), t AS (SELECT page, median(h) * 0.6e0 AS tol FROM b GROUP BY page), g AS (SELECT b.page, tol, list({{'i': idx, 'x': x1, 'cy': (y1 + y2) / 2.0e0, 'ref': (y1 + y2) / 2.0e0, 'line': 0}} ORDER BY (y1 + y2) / 2.0e0, x1, idx) AS l FROM b JOIN t ON b.page = t.page GROUP BY b.page, tol),"
    " s AS (SELECT page, list_reduce(list_transform(l, lambda e: [e]), lambda acc, e: list_append(acc, CASE WHEN abs(e[1].cy - acc[len(acc)].ref) <= tol THEN {'i': e[1].i, 'x': e[1].x, 'cy': e[1].cy, 'ref': acc[len(acc)].ref, 'line': acc[len(acc)].line} ELSE {'i': e[1].i, 'x': e[1].x, 'cy': e[1].cy, 'ref': e[1].cy, 'line': acc[len(acc)].line + 1} END)) AS l FROM g)"
)


@query(_ORDERED + " SELECT page, u.i AS idx, u.line AS row FROM (SELECT page, unnest(l) AS u FROM s)")
def reading_order_rows(spark, sf_dir):
    return folds.reading_order(boxes(spark, sf_dir).select("page", "idx", "bbox")).select("page", "idx", "row")


# --- verification --------------------------------------------------------------------------------


def _regions(spark, sf_dir):
    b = boxes(spark, sf_dir)
    text = F.when(F.col("part") % 7 == 0, F.col("label")).otherwise(F.col("txt"))
    return b.select(
        "page", F.col("idx").alias("ord"), F.col("label").alias("type"), "bbox", F.when(F.col("status") == "FAILED", "VLM_COARSE").otherwise("OCR_REFINED").alias("source"), F.col("conf").alias("confidence"), text.alias("text"), F.col("txt").alias("vlm_text"),
        F.when(F.col("supp") % 2 == 0, "EXACT").otherwise("NONE").alias("agreement"), (F.col("supp") % 3 == 0).alias("needs_review"), F.lit("").alias("reason"), "part", "supp",
    )


@query(
    f"SELECT page, idx AS ord, label AS type, CASE WHEN label IN ('RRN', 'CARD_NO') THEN 'failed' END AS checksum, false AS verified, supp % 3 = 0 OR label IN ('RRN', 'CARD_NO') AS needs_review, conf AS confidence FROM ({BOXES})"
)
def verify_flags(spark, sf_dir):
    r = verify.verify(_regions(spark, sf_dir))
    return r.select("page", "ord", "type", "checksum", "verified", "needs_review", "confidence")


_WORDS = ["성명", "성 명", "주 소 :", "(연락처)", "홍길동", "서울 주소", "비고"]
_WORD = lambda c: "CASE " + c + " " + " ".join(f"WHEN {i} THEN '{w}'" for i, w in enumerate(_WORDS)) + " END"
_IS = lambda c: f"coalesce({c}, -1) IN (0, 1, 2, 3, 6)"


@query(
    f"SELECT page, idx, supp % 3 = 0 OR {_IS('v')} OR {_IS('o')} AS review FROM (SELECT page, idx, supp, CAST(part % 7 AS INT) AS v, CASE WHEN supp % 4 = 0 THEN NULL ELSE CAST(supp % 7 AS INT) END AS o FROM ({BOXES})) WHERE NOT ({_IS('v')} AND (o IS NULL OR {_IS('o')}))"
)
def label_word_filter(spark, sf_dir):
    b = run_sql(spark, sf_dir, f"SELECT page, idx, supp % 3 = 0 AS needs_review, {_WORD('CAST(part % 7 AS INT)')} AS vlm_text, CASE WHEN supp % 4 = 0 THEN NULL ELSE {_WORD('CAST(supp % 7 AS INT)')} END AS text FROM ({BOXES})")
    return verify.drop_labels(b).select("page", "idx", F.col("needs_review").alias("review"))


_NEAR = f"SELECT page, idx AS ord, CAST(part % 2 AS STRING) AS type, CAST(x1 % 60 AS INT) AS x1, CAST(y1 % 40 AS INT) AS y1, CAST(x1 % 60 AS INT) + 100 AS x2, CAST(y1 % 40 AS INT) + 60 AS y2, CASE WHEN status = 'FAILED' THEN 0 ELSE 1 END AS fine, supp % 2 AS good, conf FROM ({BOXES})"
_SIM = "(CASE WHEN least(k.x2, x[1].x2) > greatest(k.x1, x[1].x1) AND least(k.y2, x[1].y2) > greatest(k.y1, x[1].y1) THEN CAST((least(k.x2, x[1].x2) - greatest(k.x1, x[1].x1)) * (least(k.y2, x[1].y2) - greatest(k.y1, x[1].y1)) AS DOUBLE) / (12000 - (least(k.x2, x[1].x2) - greatest(k.x1, x[1].x1)) * (least(k.y2, x[1].y2) - greatest(k.y1, x[1].y1))) ELSE 0 END >= 0.6 AND k.type = x[1].type)"
_BETTER = "(x[1].fine > k.fine OR x[1].fine = k.fine AND (x[1].good > k.good OR x[1].good = k.good AND x[1].conf > k.conf))"
_MERGED = (
    f"WITH n AS ({_NEAR}), g AS (SELECT page, list([{{'ord': ord, 'type': type, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'fine': fine, 'good': good, 'conf': conf}}] ORDER BY ord) AS l FROM n GROUP BY page),"
    f" m AS (SELECT page, list_reduce(l, lambda acc, x: CASE WHEN list_position(list_transform(acc, lambda k: {_SIM}), true) IS NULL OR list_position(list_transform(acc, lambda k: {_SIM}), true) = 0 THEN list_concat(acc, x) ELSE list_transform(acc, lambda k, i: CASE WHEN i = list_position(list_transform(acc, lambda k: {_SIM}), true) AND {_BETTER} THEN x[1] ELSE k END) END) AS kept FROM g)"
)


def _near(spark, sf_dir):
    n = run_sql(spark, sf_dir, _NEAR).withColumn("bbox", geometry.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))
    return n.select("page", "ord", "type", "bbox", F.when(F.col("fine") == 1, "OCR_REFINED").otherwise("VLM_COARSE").alias("source"), (F.col("good") == 1).alias("verified"), F.col("conf").alias("confidence"))


@query(_MERGED + " SELECT page, u.ord AS ord FROM (SELECT page, unnest(kept) AS u FROM m)")
def finalize_iou_dedup(spark, sf_dir):
    return folds.merge_regions(_near(spark, sf_dir)).select("page", "ord")


@query(f"SELECT page, idx, 'r' || lpad(CAST(row_number() OVER (PARTITION BY page ORDER BY y1, x1, label, idx) AS STRING), 3, '0') AS id FROM ({BOXES})")
def region_ids(spark, sf_dir):
    b = boxes(spark, sf_dir).select("page", F.col("idx").alias("ord"), "bbox", F.col("label").alias("type"))
    return verify.number(b).select("page", F.col("ord").alias("idx"), "id")


# --- reports -------------------------------------------------------------------------------------

_REG = f"SELECT page, CASE WHEN status = 'FAILED' THEN 'VLM_COARSE' ELSE 'OCR_REFINED' END AS source, CASE WHEN supp % 2 = 0 THEN 'EXACT' ELSE 'NONE' END AS agreement, CASE WHEN part % 5 = 0 THEN 'failed' WHEN part % 5 = 1 THEN 'ok' END AS checksum, supp % 3 = 0 AS needs_review, label AS type FROM ({BOXES})"


@query(
    f"SELECT page, count(*) AS n_regions, count(*) FILTER (WHERE source = 'OCR_REFINED') AS n_localized, round(count(*) FILTER (WHERE source = 'OCR_REFINED') / count(*), 3) AS localized_rate, count(*) FILTER (WHERE agreement <> 'EXACT') AS n_disagreement, count(*) FILTER (WHERE checksum = 'failed') AS n_checksum_failed, count(*) FILTER (WHERE needs_review) AS n_needs_review FROM ({_REG}) GROUP BY page"
)
def page_stats(spark, sf_dir):
    return reports.page_stats(run_sql(spark, sf_dir, _REG))


@query(f"SELECT 'source' AS kind, source AS value, count(*) AS n FROM ({_REG}) GROUP BY 2 UNION ALL SELECT 'type', type, count(*) FROM ({_REG}) GROUP BY 2")
def stats_by_type_source(spark, sf_dir):
    return reports.counts_by(run_sql(spark, sf_dir, _REG), "source", "type")


@query(f"SELECT CASE WHEN source <> 'OCR_REFINED' THEN 'coarse' WHEN agreement = 'EXACT' THEN 'text' WHEN needs_review THEN 'nearby' ELSE 'geometry' END AS basis, count(*) AS n FROM ({_REG}) GROUP BY 1")
def tally_basis(spark, sf_dir):
    r = run_sql(spark, sf_dir, _REG).withColumn("member_index", F.array(F.lit(0))).withColumn("member_boxes", F.when(F.col("needs_review"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return reports.tally(r)


@query("SELECT event_type AS convention, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type")
def convention_histogram(spark, sf_dir):
    return reports.conventions(spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_type").alias("convention"), F.col("event_id").alias("call")))


_CENTRES = f"SELECT (mx1 + mx2) / 2.0e0 / {W} AS vx, (my1 + my2) / 2.0e0 / {H} AS vy, (x1 + x2) / 2.0e0 / {W} AS ox, (y1 + y2) / 2.0e0 / {H} AS oy, label FROM ({MOVED}) WHERE status <> 'FAILED'"


def _drift(spark, sf_dir):
    b = boxes(spark, sf_dir)
    r = b.select(F.col("label"), F.when(F.col("status") == "FAILED", "VLM_COARSE").otherwise("OCR_REFINED").alias("source"), F.col("moved").alias("vlm_bbox"), F.array("bbox", "moved").alias("member_boxes"), F.array(F.lit(0)).alias("member_index"), F.lit(W).alias("page_w"), F.lit(H).alias("page_h"))
    return r


@query(
    f"WITH c AS (SELECT round(ox - vx, 9) AS d FROM ({_CENTRES})), r AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM c)"
    " SELECT any_value(n) AS n, round(median(d), 6) AS median, round(min(d) FILTER (WHERE i = greatest(0, CAST(floor(n * 0.10e0) AS BIGINT) - 1)), 6) AS low, round(min(d) FILTER (WHERE i = least(n - 1, CAST(floor(n * 0.90e0) AS BIGINT))), 6) AS high FROM r"
)
def drift_spread(spark, sf_dir):
    p = reports.centre_pairs(_drift(spark, sf_dir))
    s = reports.spread(p, F.round(F.col("ox") - F.col("vx"), 9))
    return s.select("n", *[F.round(c, 6).alias(c) for c in ("median", "low", "high")])


_SLOPE = "regr_slope(o, v)"


@query(
    f"SELECT round(regr_slope(ox, vx), 6) AS kx, round(sqrt((regr_syy(ox, vx) - regr_sxy(ox, vx) ** 2 / regr_sxx(ox, vx)) / (regr_count(ox, vx) - 2) / regr_sxx(ox, vx)), 6) AS sx, round(regr_slope(oy, vy), 6) AS ky, round(sqrt((regr_syy(oy, vy) - regr_sxy(oy, vy) ** 2 / regr_sxx(oy, vy)) / (regr_count(oy, vy) - 2) / regr_sxx(oy, vy)), 6) AS sy FROM ({_CENTRES})"
)
def drift_regression(spark, sf_dir):
    p = reports.centre_pairs(_drift(spark, sf_dir)).agg(reports.slope(F.col("vx"), F.col("ox")).alias("x"), reports.slope(F.col("vy"), F.col("oy")).alias("y"))
    return p.select(F.round("x.k", 6).alias("kx"), F.round("x.se", 6).alias("sx"), F.round("y.k", 6).alias("ky"), F.round("y.se", 6).alias("sy"))


_VAR = f"SELECT page, CASE WHEN supp % 2 = 0 THEN 'a' ELSE 'b' END AS variant, CAST(supp % 2 AS INT) AS variant_ord, idx AS ord, CAST(part % 2 AS STRING) AS type, CASE WHEN part % 3 = 0 THEN '' ELSE CAST(part % 3 AS STRING) END AS key, CAST(x1 % 90 AS INT) AS x1, CAST(y1 % 60 AS INT) AS y1 FROM ({BOXES})"
_HIT = "(k.type = x[1].type AND least(k.x1, x[1].x1) + 100 > greatest(k.x1, x[1].x1) AND least(k.y1, x[1].y1) + 80 > greatest(k.y1, x[1].y1) AND CAST((least(k.x1, x[1].x1) + 100 - greatest(k.x1, x[1].x1)) * (least(k.y1, x[1].y1) + 80 - greatest(k.y1, x[1].y1)) AS DOUBLE) / 8000 >= 0.3 AND (k.key = '' OR x[1].key = '' OR k.key = x[1].key))"
_AT = f"list_position(list_transform(acc, lambda k: {_HIT}), true)"
_UNION = (
    f"WITH v AS ({_VAR}), g AS (SELECT page, list([{{'key': key, 'type': type, 'x1': x1, 'y1': y1, 'a': variant_ord = 0, 'b': variant_ord = 1}}] ORDER BY variant_ord, ord) AS l FROM v GROUP BY page),"
    f" m AS (SELECT page, list_reduce(l, lambda acc, x: CASE WHEN coalesce({_AT}, 0) = 0 THEN list_concat(acc, x) ELSE list_transform(acc, lambda k, i: CASE WHEN i = {_AT} THEN {{'key': CASE WHEN k.key = '' THEN x[1].key ELSE k.key END, 'type': k.type, 'x1': k.x1, 'y1': k.y1, 'a': k.a OR x[1].a, 'b': k.b OR x[1].b}} ELSE k END) END) AS items FROM g),"
    " i AS (SELECT page, unnest(items) AS u FROM m)"
)


def _items(spark, sf_dir):
    v = run_sql(spark, sf_dir, _VAR).withColumn("bbox", geometry.box(F.col("x1"), F.col("y1"), F.col("x1") + 100, F.col("y1") + 80))
    return folds.union_items(v.drop("x1", "y1"))


@query(_UNION + " SELECT page, u.type AS type, u.key AS key, u.a AS in_a, u.b AS in_b, count(*) AS n FROM i GROUP BY ALL")
def union_items(spark, sf_dir):
    i = _items(spark, sf_dir).select("page", "type", "key", F.array_contains("found_by", "a").alias("in_a"), F.array_contains("found_by", "b").alias("in_b"))
    return i.groupBy("page", "type", "key", "in_a", "in_b").agg(F.count("*").alias("n"))


@query(_UNION + " SELECT 'a' AS variant, count(*) FILTER (WHERE u.a) AS n_found, round(count(*) FILTER (WHERE u.a) / count(*), 6) AS recall, count(*) FILTER (WHERE u.a AND NOT u.b) AS n_solo FROM i UNION ALL SELECT 'b', count(*) FILTER (WHERE u.b), round(count(*) FILTER (WHERE u.b) / count(*), 6), count(*) FILTER (WHERE u.b AND NOT u.a) FROM i")
def relative_recall(spark, sf_dir):
    return reports.relative_recall(_items(spark, sf_dir), ["a", "b"])


@query(
    f"WITH m AS ({MOVED}), h AS (SELECT DISTINCT t.page, t.idx FROM m AS t JOIN m AS r ON t.page = r.page AND t.label = r.label AND r.status <> 'FAILED'"
    " WHERE CAST(greatest(0, least(t.x2, r.mx2) - greatest(t.x1, r.mx1)) * greatest(0, least(t.y2, r.my2) - greatest(t.y1, r.my1)) AS DOUBLE) / least(t.w * t.h, r.w * r.h) >= 0.3)"
    " SELECT m.status AS difficulty, count(*) AS n, count(h.idx) AS n_found, round(count(h.idx) / count(*), 6) AS recall FROM m LEFT JOIN h ON m.page = h.page AND m.idx = h.idx GROUP BY m.status"
)
def truth_recall(spark, sf_dir):
    b = boxes(spark, sf_dir).select("page", F.col("idx").alias("ord"), F.col("label").alias("type"), "bbox", "moved", "status")
    return reports.truth_recall(b.withColumn("difficulty", F.col("status")), b.filter("status <> 'FAILED'").withColumn("bbox", F.col("moved")))


@query(f"SELECT page % 10 AS doc, CAST(NULL AS BIGINT) AS page, CAST(NULL AS STRING) AS type, count(*) AS n, count(*) FILTER (WHERE needs_review) AS n_review FROM ({_REG}) GROUP BY 1 UNION ALL SELECT NULL, NULL, NULL, count(*), count(*) FILTER (WHERE needs_review) FROM ({_REG}) UNION ALL SELECT page % 10, page, NULL, count(*), count(*) FILTER (WHERE needs_review) FROM ({_REG}) GROUP BY 1, 2 UNION ALL SELECT page % 10, page, type, count(*), count(*) FILTER (WHERE needs_review) FROM ({_REG}) GROUP BY 1, 2, 3")
def rollup_report(spark, sf_dir):
    return reports.by_document(run_sql(spark, sf_dir, _REG).withColumn("doc", F.col("page") % 10))


_TRIES = "SELECT l_orderkey AS page, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS attempt, CASE WHEN l_returnflag = 'R' THEN 'ok' END AS raw, CASE WHEN l_returnflag = 'A' THEN 'length' ELSE 'stop' END AS finish_reason FROM lineitem"


@query(
    f"SELECT page, CAST(coalesce(min(attempt) FILTER (WHERE raw IS NOT NULL), max(attempt)) AS INT) AS attempt, max(raw) AS raw, count(*) AS attempts FROM ({_TRIES}) GROUP BY page"
)
def first_success_attempt(spark, sf_dir):
    t = run_sql(spark, sf_dir, _TRIES).withColumn("error", F.when(F.col("raw").isNull(), "unusable"))
    return attempts.first_success(t, ("page",)).select("page", "attempt", "raw", "attempts")


@query(f"SELECT page, CAST(max(attempt) + 1 AS INT) AS attempt, CASE WHEN arg_max(finish_reason, attempt) = 'length' THEN 4096 ELSE 2048 END AS max_tokens FROM ({_TRIES}) GROUP BY page HAVING max(raw) IS NULL AND max(attempt) < 2")
def calls_to_repeat(spark, sf_dir):
    t = run_sql(spark, sf_dir, _TRIES).withColumn("error", F.when(F.col("raw").isNull(), "unusable"))
    return attempts.to_repeat(t, ("page",))


@query(f"SELECT page, idx, CAST(w - supp % 30 AS DOUBLE) * h < CAST(w AS DOUBLE) * h * 0.81e0 AS shrunk FROM ({BOXES})")
def downscale_alarm(spark, sf_dir):
    b = boxes(spark, sf_dir)
    return b.select("page", "idx", attempts.shrunk(F.col("w") - F.col("supp") % 30, F.col("h"), F.col("w"), F.col("h")).alias("shrunk"))


@query(f"SELECT page, idx, 'r001 ' || label || ' ' || printf('%.2f', conf) || CASE WHEN part % 5 = 0 THEN ' X' WHEN part % 5 = 1 THEN ' OK' WHEN supp % 3 = 0 THEN ' !' ELSE '' END AS label FROM ({BOXES})")
def overlay_labels(spark, sf_dir):
    b = boxes(spark, sf_dir)
    checksum = F.when(F.col("part") % 5 == 0, "failed").when(F.col("part") % 5 == 1, "ok")
    return b.select("page", "idx", sinks.overlay_label(F.lit("r001"), F.col("label"), F.col("conf"), checksum, F.col("supp") % 3 == 0).alias("label"))


# --- training set --------------------------------------------------------------------------------

_TILES = "SELECT CAST(0 AS INT) AS tile, 0 AS lo UNION ALL SELECT 1, 736 UNION ALL SELECT 2, 1504"
_CONTAINED = f"WITH b AS ({BOXES}), t AS ({_TILES}), j AS (SELECT b.*, tile, lo, row_number() OVER (PARTITION BY page, tile ORDER BY y1, x1, idx) AS item FROM b CROSS JOIN t WHERE CAST(greatest(0, least(x2, {W}) - x1) * greatest(0, least(y2, lo + 960) - greatest(y1, lo)) AS DOUBLE) / (w * h) >= 0.95)"


def _tile_items(spark, sf_dir, most=32):
    b = boxes(spark, sf_dir).select("page", "idx", "bbox", F.col("txt").alias("text"), "status", "conf", F.lit(W).alias("page_w"), F.lit(H).alias("page_h"))
    return trainset.tile_items(b, trainset.page_tiles(b.select("page", "page_w", "page_h").distinct()), most)


@query(_CONTAINED + " SELECT page, tile, CAST(item AS INT) AS item, CASE WHEN status = 'FAILED' OR conf < 0.9 THEN '' ELSE txt END AS text FROM j WHERE item <= 3")
def tile_sample_topn(spark, sf_dir):
    return _tile_items(spark, sf_dir, 3).select("page", "tile", "item", "text")


@query(_CONTAINED + " SELECT tile, count(*) AS n, count(DISTINCT page) AS pages FROM j GROUP BY tile")
def tile_containment(spark, sf_dir):
    return _tile_items(spark, sf_dir, 1000).groupBy("tile").agg(F.count("*").alias("n"), F.count_distinct("page").alias("pages"))


@query(f"SELECT status, conf < 0.9 AS doubtful, count(*) FILTER (WHERE status = 'FAILED' OR conf < 0.9) AS blank, count(*) AS n FROM ({BOXES}) GROUP BY 1, 2")
def label_text_policy(spark, sf_dir):
    b = boxes(spark, sf_dir).withColumn("t", trainset.label_text(F.col("status"), F.col("conf"), F.col("txt")))
    return b.groupBy("status", (F.col("conf") < 0.9).alias("doubtful")).agg(F.count_if(F.col("t") == "").alias("blank"), F.count("*").alias("n"))


@query(_CONTAINED + " SELECT 'read' AS task, count(*) AS samples, CAST(sum(n) AS BIGINT) AS items, round(sum(n) / count(*), 1) AS items_per_sample, CAST(sum(blank) AS BIGINT) AS textless FROM (SELECT page, tile, count(*) AS n, count(*) FILTER (WHERE status = 'FAILED' OR conf < 0.9) AS blank FROM j WHERE item <= 32 GROUP BY page, tile)")
def dataset_summary(spark, sf_dir):
    s = trainset.tile_samples(_tile_items(spark, sf_dir)).select(F.lit("read").alias("task"), F.col("items").alias("target"))
    return trainset.summary(s).select("task", "samples", "items", "items_per_sample", "textless")


# --- text, sources and sinks ---------------------------------------------------------------------


@query("SELECT p_partkey AS k, upper(replace(replace(replace(p_name, ' ', ''), '-', ''), '.', '')) AS key FROM part")
def match_key_ascii(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("k"), textnorm.match_key_ascii(F.col("p_name")).alias("key"))


@query("SELECT o_orderkey AS k, CAST(unnest(CASE o_orderkey % 4 WHEN 0 THEN range(1, n + 1) WHEN 1 THEN list_sort(list_distinct(list_concat([1, 2], CASE WHEN n >= 5 THEN [5] ELSE [2] END))) WHEN 2 THEN range(3, n + 1) ELSE range(1, 3) END) AS INT) AS page FROM (SELECT o_orderkey, CAST(o_custkey % 9 + 3 AS INT) AS n FROM orders)")
def page_range_expand(spark, sf_dir):
    o = run_sql(spark, sf_dir, "SELECT o_orderkey AS k, CAST(o_custkey % 9 + 3 AS INT) AS n, CAST(o_orderkey % 4 AS INT) AS kind FROM orders")
    spec = F.when(F.col("kind") == 0, "").when((F.col("kind") == 1) & (F.col("n") >= 5), "5, 1-2,,2").when(F.col("kind") == 1, "1-2,2").when(F.col("kind") == 2, "3-").otherwise("-2")
    return o.select("k", F.explode(page_sources.page_numbers(spec, F.col("n"))).alias("page"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'doc' || CAST(page_id AS STRING) ELSE 'doc' || CAST(page_id AS STRING) || '_p' || CASE WHEN page_id * 37 > 999 THEN CAST(page_id * 37 AS STRING) ELSE lpad(CAST(page_id * 37 AS STRING), 3, '0') END END AS stem, CASE WHEN page_id % 2 = 0 THEN 'image' ELSE 'pdf' END AS kind FROM pages")
def stem_names(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id")
    path = F.concat(F.lit("/a/b.c/doc"), F.col("page_id").cast("string"), F.when(F.col("page_id") % 2 == 0, ".png").otherwise(".PDF"))
    return p.select("page_id", sinks.stem(path, F.when(F.col("page_id") % 2 == 1, F.col("page_id") * 37)).alias("stem"), page_sources.file_kind(path).alias("kind"))


@query("WITH e AS (SELECT c_custkey AS path, CAST(c_nationkey AS STRING) AS s FROM customer WHERE c_custkey % 3 <> 0), a AS (SELECT c_custkey AS path, CAST(CASE WHEN c_custkey % 7 = 0 THEN -1 ELSE c_nationkey END AS STRING) AS s FROM customer WHERE c_custkey % 5 <> 0) SELECT coalesce(e.path, a.path) AS path, CASE WHEN a.path IS NULL THEN 'missing' WHEN e.path IS NULL THEN 'extra' WHEN e.s = a.s THEN 'ok' ELSE 'mismatch' END AS state FROM e FULL JOIN a ON e.path = a.path")
def manifest_diff(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    e = c.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("path"), F.col("c_nationkey").cast("string").alias("sha256"))
    a = c.filter("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("path"), F.when(F.col("c_custkey") % 7 == 0, F.lit(-1)).otherwise(F.col("c_nationkey")).cast("string").alias("sha256"))
    return sinks.compare_manifests(e, a)


@query("SELECT page_id, sha256(html) AS sha256 FROM pages")
def content_digest(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return sinks.manifest(p.select(F.col("page_id").alias("path"), F.encode("html", "UTF-8").alias("content"))).withColumnRenamed("path", "page_id")


@query("SELECT o_orderkey AS k, least(8, greatest(0.5, 2464.0e0 / greatest(w, h))) AS scale FROM (SELECT o_orderkey, CAST(o_custkey % 900 + 100 AS DOUBLE) AS w, CAST(o_orderkey % 7000 + 100 AS DOUBLE) AS h FROM orders)")
def render_scales(spark, sf_dir):
    o = run_sql(spark, sf_dir, "SELECT o_orderkey AS k, CAST(o_custkey % 900 + 100 AS DOUBLE) AS w, CAST(o_orderkey % 7000 + 100 AS DOUBLE) AS h FROM orders")
    return o.select("k", page_sources.render_scale(F.col("w"), F.col("h")).alias("scale"))
