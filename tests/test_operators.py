"""Greedy folds, localisation, verification, reports and the whole plan on small pages."""

import json

import pytest
from pyspark.sql import functions as F

from veilframe.functions import geometry
from veilframe.operators import decode, folds, localize, reports, trainset, verify
from veilframe.plans import pages as plan
from veilframe.sources import config, sinks
from veilframe.sources import pages as sources

BOX = "struct<x1:int,y1:int,x2:int,y2:int>"
RECT = "struct<x1:double,y1:double,x2:double,y2:double>"


def test_dedup_is_no_closure(table):
    rows = [(1, 1, "NAME", "k", (0.0, 0.0, 0.3, 0.3), 0.9, 0), (1, 2, "NAME", "k", (0.2, 0.0, 0.5, 0.3), 0.8, 0), (1, 3, "NAME", "k", (0.4, 0.0, 0.7, 0.3), 0.7, 0), (1, 4, "RRN", "k", (0.0, 0.0, 0.3, 0.3), 0.1, 0), (1, 5, "NAME", "other", (0.0, 0.0, 0.3, 0.3), 0.1, 0)]
    f = table(rows, f"page int, ord int, type string, key string, rect {RECT}, conf double, tile int")
    assert sorted(r.ord for r in folds.dedup_findings(f).collect()) == [1, 3, 4, 5]


def test_merge_takes_the_better_in_place(table):
    rows = [(1, 1, "A", (100, 100, 300, 140), "VLM_COARSE", False, 0.99), (1, 2, "A", (102, 101, 298, 139), "OCR_REFINED", False, 0.5), (1, 3, "A", (400, 100, 500, 140), "OCR_REFINED", True, 0.1), (1, 4, "A", (401, 100, 501, 140), "OCR_REFINED", False, 0.9)]
    r = table(rows, f"page int, ord int, type string, bbox {BOX}, source string, verified boolean, confidence double")
    assert sorted(x.ord for x in folds.merge_regions(r).collect()) == [2, 3]


def test_reading_order_keeps_the_first_centre(table):
    rows = [(1, i, (10 * i, y, 10 * i + 5, y + 8)) for i, y in enumerate((0, 4, 8, 12))]
    got = folds.reading_order(table(rows, f"page int, idx int, bbox {BOX}"), 0.625).orderBy("position").collect()
    assert [r.row for r in got] == [0, 0, 1, 1]


def test_union_fills_keys(table):
    rows = [(1, "a", 0, 0, "N", (0, 0, 100, 100), ""), (1, "b", 1, 0, "N", (10, 10, 110, 110), "K"), (1, "b", 1, 1, "N", (300, 300, 310, 310), "K"), (1, "a", 0, 1, "M", (0, 0, 100, 100), "K")]
    items = folds.union_items(table(rows, f"page int, variant string, variant_ord int, ord int, type string, bbox {BOX}, key string"))
    assert sorted((r.type, r.key, tuple(r.found_by)) for r in items.collect()) == [("M", "K", ("a",)), ("N", "K", ("a", "b")), ("N", "K", ("b",))]
    recall = {r.variant: (r.n_found, r.n_solo) for r in reports.relative_recall(items, ["a", "b"]).collect()}
    assert recall == {"a": (2, 1), "b": (2, 1)}


def test_conventions(spark):
    got = spark.range(1).select(decode.convention(F.lit(0.4)), decode.convention(F.lit(450.0)), decode.convention(F.lit(1500.0)), decode.convention(F.lit(None).cast("double"))).first()
    assert tuple(got) == ("unit", "per-mille", "pixel", "unit")
    with pytest.raises(ValueError):
        decode.convention(F.lit(1.0), "percent")


def _region(**kw):
    base = {"page": 1, "ord": 1, "type": "NAME", "text": "x", "vlm_text": "x", "agreement": "EXACT", "needs_review": False, "confidence": 0.9, "reason": ""}
    return tuple((base | kw).values())


SCHEMA = "page int, ord int, type string, text string, vlm_text string, agreement string, needs_review boolean, confidence double, reason string"


@pytest.mark.parametrize(
    ("kw", "want"),
    [
        ({"type": "RRN", "text": "901231-1234563"}, ("RRN", "ok", False, 1.0)), ({"type": "RRN", "text": "901231-1234561", "vlm_text": None}, ("RRN", "failed", True, 0.9)), ({"type": "PASSPORT", "text": "M12345678"}, ("PASSPORT", None, False, 0.9)),
        ({"type": "RRN", "text": "123456789012", "vlm_text": "901231-1234563"}, ("RRN", "ok", False, 1.0)), ({"type": "RRN", "text": "901231-1234563", "agreement": "NONE", "needs_review": True}, ("RRN", "ok", True, 0.9)),
        ({"type": "ACCOUNT_NO", "text": "9012311234563"}, ("RRN", "ok", False, 1.0)), ({"type": "ACCOUNT_NO", "text": "901231123456"}, ("ACCOUNT_NO", None, False, 0.9)), ({"type": "NAME", "text": None, "vlm_text": None}, ("NAME", None, False, 0.9)),
    ],
)
def test_verify(table, kw, want):
    r = verify.verify(table([_region(**kw)], SCHEMA)).first()
    assert (r.type, r.checksum, r.needs_review, r.confidence) == want


def test_retype_off_keeps_the_signal(table):
    r = verify.verify(table([_region(type="CARD_NO", text="9012311234563", vlm_text=None)], SCHEMA), retype=False).first()
    assert r.type == "CARD_NO" and r.needs_review and "resident" in r.reason


def test_label_words(table):
    rows = [_region(ord=1, text="성명", vlm_text="성 명"), _region(ord=2, text="홍길동", vlm_text="성 명"), _region(ord=3, text=None, vlm_text="주소"), _region(ord=4)]
    got = {r.ord: r.needs_review for r in verify.drop_labels(table(rows, SCHEMA)).collect()}
    assert got == {2: True, 4: False}


def test_ids(spark):
    got = spark.range(1).select(verify.region_id(F.lit(7)), verify.region_id(F.lit(1234))).first()
    assert tuple(got) == ("r007", "r1234")


@pytest.mark.parametrize(("spec", "n", "want"), [("", 3, [1, 2, 3]), ("2", 3, [2]), ("1-3,7,10-", 11, [1, 2, 3, 7, 10, 11]), ("-2", 5, [1, 2]), ("3-9", 4, [3, 4]), (" 2 ,2, 1", 5, [1, 2])])
def test_page_numbers(spark, spec, n, want):
    assert spark.range(1).select(sources.page_numbers(F.lit(spec), F.lit(n))).first()[0] == want


@pytest.mark.parametrize("spec", ["a", "3-1", "0", "9", "1-2-3"])
def test_page_numbers_raise(spark, spec):
    with pytest.raises(Exception, match="bad page range"):
        spark.range(1).select(sources.page_numbers(F.lit(spec), F.lit(5))).collect()


def test_drift_slope(table):
    rows = [(x / 10, x / 10 + 0.05, 1.02 * x / 10) for x in range(10)]
    got = table(rows, "v double, moved double, scaled double").agg(reports.slope(F.col("v"), F.col("moved")).alias("m"), reports.slope(F.col("v"), F.col("scaled")).alias("s")).first()
    assert round(got.m.k, 9) == 1 and round(got.s.k, 9) == 1.02
    assert table(rows[:3], "v double, m double, s double").agg(reports.slope(F.col("v"), F.col("m"))).first()[0] is None


def test_reports_hold_no_text(table):
    r = table([(1, "OCR_REFINED", "EXACT", None, False, "NAME", "secret value")], "page int, source string, agreement string, checksum string, needs_review boolean, type string, text string")
    for report in (reports.page_stats(r), reports.counts_by(r, "source", "type")):
        assert "secret value" not in json.dumps([x.asDict() for x in report.collect()])


def test_mask_and_blocks(spark, table):
    with pytest.raises(Exception, match="leaves no answer"):
        spark.range(1).select(trainset.mask_prompt(F.array(F.lit(1)), F.lit(1))).collect()
    with pytest.raises(ValueError, match="pixel_values"):
        trainset.pad_value("pixel_values", 9)
    assert spark.range(1).select(trainset.mask_prompt(F.array(*[F.lit(i) for i in range(5)]), F.lit(2))).first()[0] == [-100, -100, 2, 3, 4]
    names = table([("visual.blocks.0.a",), ("visual.blocks.10.a",), ("visual.blocks.2.a",), ("text.blocks.11.a",)], "name string")
    assert sorted(r.block for r in trainset.last_blocks(names, "visual", 2).collect()) == [2, 10]


def test_manifests(table):
    e, a = table([("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string"), table([("a", "1"), ("b", "9"), ("d", "4")], "path string, sha256 string")
    assert {r.path: r.state for r in sinks.compare_manifests(e, a).collect()} == {"a": "ok", "b": "mismatch", "c": "missing", "d": "extra"}


def test_paths_of_a_manifest_stay_in_its_folder(table):
    files = table([("f", "a/b.txt", bytearray(b"x"))], "folder string, path string, content binary")
    assert len(sinks.folder_digest(files).first().digests["a/b.txt"]) == 64
    for bad in ("../a", "/etc/a", "a/../../b", "..\\a"):
        with pytest.raises(Exception, match="leaves its folder"):
            sinks.folder_digest(files.withColumn("path", F.lit(bad))).collect()


def test_training_rows_name_the_line(spark, tmp_path):
    good = '{"image": "a.png", "query": ["x"], "target": {"findings": [{"text": "x", "bbox_2d": [1, 2, 3, 4]}]}}'
    (tmp_path / "a.jsonl").write_text(f"{good}\n\n{good.replace('a.png', 'b.png')}\n")
    got = sources.read_training_rows(spark, str(tmp_path / "a.jsonl")).orderBy("line").collect()
    assert [(r.line, r.image, r.task, r.target.findings[0].bbox_2d) for r in got] == [(1, "a.png", "locate", [1, 2, 3, 4]), (3, "b.png", "locate", [1, 2, 3, 4])]
    for bad, why in (("{}", "no image"), ('{"image": "a", "task": "draw"}', "unknown task"), ('{"image": "a", "task": "locate"}', "nothing asked"), ("oops", "no image")):
        (tmp_path / "b.jsonl").write_text(f"{good}\n\n\n{bad}\n")
        with pytest.raises(Exception, match=f"b.jsonl:4: {why}"):
            sources.read_training_rows(spark, str(tmp_path / "b.jsonl")).collect()
        assert [r.problem for r in sources.read_training_rows(spark, str(tmp_path / "b.jsonl"), strict=False).orderBy("line").collect()] == [None, why]


def test_lines_are_numbered_across_parts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"{i} {'x' * (i % 90)}\n" for i in range(1, 3001)))
    (tmp_path / "b.txt").write_text("1\n2\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = sources.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 3002 and all(r.line == int(r.value.split(" ")[0]) for r in got)


def test_a_finding_has_one_row(table):
    f = table([(1, 1), (1, 1)], "page int, ord int")
    with pytest.raises(Exception, match="occurs twice"):
        localize.candidates(f, table([], "page int, ord int, idx int, text string")).collect()


def test_stray_values_do_not_slow_the_spread(table):
    v = [i / 1000 for i in range(5000)] + [1e12]
    r = reports.spread(table([(x,) for x in v], "v double"), F.col("v")).first()
    assert (r.n, r.median, r.low, r.high) == (5001, 2.5, v[499], v[4500])


def test_settings(tmp_path, monkeypatch):
    f = tmp_path / "c.yaml"
    f.write_text("tiles: 2\n")
    monkeypatch.setenv("VEILFRAME_OVERLAP", "0.2")
    s = config.load(str(f), {"factor": None, "max_join": 5})
    assert (s.tiles, s.overlap, s.factor, s.max_join) == (2, 0.2, 32, 5) and config.grid_problems(s) == []
    f.write_text("tilez: 2\n")
    with pytest.raises(ValueError, match="tilez"):
        config.load(str(f))
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.yaml"))
    monkeypatch.chdir(tmp_path)
    (tmp_path / "config").mkdir()
    (tmp_path / "config" / "default.yaml").write_text("tiles: 5\n")
    assert config.load().tiles == 5
    (tmp_path / "config.yml").write_text("tiles: 6\n")
    assert config.load().tiles == 6


def test_whole_plan(table):
    """A value found by text, one by place, one by the nearest line, one without boxes, and a repeat."""
    item = lambda text, kind, *b: {"text": text, "type": kind, "bbox_2d": list(b), "conf": 0.8}
    items = [item("901231-1234563", "RRN", 100, 100, 300, 120), item("010-1234-5678", "PHONE", 100, 300, 300, 320), item("Kim", "NAME", 600, 500, 640, 505), item("Lee", "NAME", 800, 900, 850, 910), item("9012311234563", "RRN", 101, 100, 299, 120)]
    raw = json.dumps({"findings": items})
    answers = table([(1, 0, 0, raw, (0.0, 0.0, 1.0, 1.0), 1000, 1000, 1000, 1000)], f"page int, tile int, sample int, raw string, rect {RECT}, seen_w int, seen_h int, page_w int, page_h int")
    found = {r.type + r.text: r.ord for r in plan.detect(answers).collect()}
    assert len(found) == 4
    ocr = f"page int, ord int, idx int, bbox {BOX}, text string, status string"
    tight = [(1, found[next(k for k in found if k.startswith("RRN"))], 0, (98, 99, 180, 121), "901231-", "OK"), (1, found[next(k for k in found if k.startswith("RRN"))], 1, (182, 99, 302, 121), "1234563", "OK"), (1, found["PHONE010-1234-5678"], 0, (110, 301, 290, 319), "010-1234-5679", "LOW_CONF")]
    wide = [tight[2], (1, found["NAMEKim"], 0, (600, 520, 640, 535), "Park", "OK")]
    got = {r.type: r for r in plan.analyse(answers, table(tight, ocr), table(wide, ocr)).filter("vlm_text <> 'Lee'").collect()}
    assert got["RRN"].agreement == "EXACT" and got["RRN"].checksum == "ok" and got["RRN"].member_index == [0, 1] and not got["RRN"].needs_review
    assert got["PHONE"].how == "geometry" and got["PHONE"].needs_review and got["PHONE"].text == "010-1234-5679"
    assert got["NAME"].how == "nearby" and got["NAME"].needs_review and tuple(got["NAME"].bbox) == (598, 498, 642, 537)
    assert got["RRN"].char_span is None and len({i for r in got.values() for i in r.member_index}) == 4
    lee = plan.analyse(answers, table(tight, ocr), table(wide, ocr)).filter("vlm_text = 'Lee'").first()
    assert lee.coarse and lee.needs_review and lee.text is None and lee.source == "VLM_COARSE"


def test_stream(spark, tmp_path, table):
    from veilframe.streaming.pages import stream_findings

    raw = json.dumps({"findings": [{"text": "a", "type": "NAME", "bbox_2d": [1, 2, 300, 400], "conf": 0.5}]})
    schema = f"page int, tile int, sample int, raw string, rect {RECT}, seen_w int, seen_h int"
    table([(1, 0, 0, raw, (0.0, 0.0, 1.0, 1.0), 1000, 1000)], schema).write.parquet(str(tmp_path / "in"))
    stream_findings(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_plans_have_no_cartesian_product(table):
    b = table([(1, 0, (0, 0, 5, 5), "t", "OK", "t")], f"page int, idx int, bbox {BOX}, box_text string, status string, norm string")
    p = b.withColumn("ord", F.lit(1)).withColumn("key", F.lit("t")).withColumn("vlm", geometry.box(0, 0, 5, 5)).withColumn("crop", geometry.box(0, 0, 9, 9))
    for df in (localize.match_text(p), localize.select_by_place(p)):
        said = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in said and "BroadcastNestedLoopJoin" not in said


@pytest.mark.parametrize("name", ["region_reasons", "regions_assembled"])
def test_regions_shuffle_the_table_once(spark, name):
    """Pairs of findings and boxes are many times the table, so they may not be shuffled."""
    from veilframe import catalog

    said = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert said.count("Exchange ") == 1 and "Join" not in said


def test_regions_of_pools_are_those_of_rows(table):
    """Boxes number on by finding, a finding without boxes has none, and a tied choice is the earlier box."""
    f = table([(1, 0, "ab", (0.1, 0.1, 0.3, 0.2)), (1, 1, "zz", (0.5, 0.5, 0.6, 0.6)), (1, 2, "zz", (0.9, 0.9, 0.95, 0.95))], f"page int, ord int, key string, rect {RECT}")
    f = f.select("page", "ord", F.lit(100).alias("page_w"), F.lit(100).alias("page_h"), F.lit("NAME").alias("type"), F.col("key").alias("text"), F.lit("").alias("field"), F.lit(0.7).alias("conf"), "rect", "key", geometry.box(0, 0, 100, 100).alias("crop"))
    rows = [(1, 0, 3, (1, 1, 9, 9), "b", "OK", "b"), (1, 0, 2, (10, 10, 20, 20), "a", "OK", "a"), (1, 1, 5, (45, 45, 75, 75), "q", "FAILED", "q"), (1, 1, 4, (45, 45, 75, 75), "p", "LOW_CONF", "p"), (1, 7, 0, (0, 0, 5, 5), "no finding", "OK", "no finding")]
    b = table(rows, f"page int, ord int, idx int, bbox {BOX}, text string, status string, norm string")
    pools = localize.pooled(f, b)
    assert {r.ord: [(x["idx"], x["index"]) for x in r.pool or []] for r in pools.collect()} == {0: [(2, 0), (3, 1)], 1: [(4, 2), (5, 3)], 2: []}
    got = {r.ord: (r.how, r.text, r.member_index, r.needs_review) for r in localize.located(pools).collect()}
    assert got == {0: ("text", "a b", [0, 1], False), 1: ("geometry", "p q", [2, 3], True), 2: ("coarse", None, [], True)}
    assert sorted(map(repr, localize.regions(f, b).collect())) == sorted(map(repr, localize.located(pools).collect()))


def test_places_in_rows_are_those_of_pairs(table):
    side = lambda i, k: (i * k) % 97
    boxes = [(page, ord_, i, (side(page + i, 31), side(ord_ + i, 53), side(page + i, 31) + 9, side(ord_ + i, 53) + 7)) for page in range(12) for ord_ in range(5) for i in range(7)]
    p = table(boxes, f"page int, ord int, idx int, bbox {BOX}")
    x, y = F.col("page") * 7, F.col("ord") * 19
    p = p.withColumn("vlm", geometry.box(x, y, x + 12, y + 10)).withColumn("crop", geometry.box(x - 20, y - 20, x + 32, y + 30))
    own = p.groupBy("page", "ord", "vlm", "crop").agg(F.collect_list(F.struct("idx", "bbox")).alias("pool"))
    rows = localize._with_place(own, 4, 0.5).filter("place IS NOT NULL").select("page", "ord", "place.how", "place.members")
    want = sorted(map(tuple, localize.select_by_place(p).collect()))
    assert sorted(map(tuple, rows.collect())) == want and {r[2] for r in want} == {"geometry", "nearby"}


@pytest.mark.parametrize("n", [0, 1, 2, 9, 10, 11, 100])
def test_spread_is_exact(table, n):
    from statistics import median

    v = [((i * 37) % 23) / 7 for i in range(n)]
    r = reports.spread(table([(x,) for x in v] + [(None,)], "v double"), F.col("v")).first()
    s = sorted(v)
    want = (n, median(s), s[max(0, int(n * 0.10) - 1)], s[min(n - 1, int(n * 0.90))]) if n else (0, None, None, None)
    assert (r.n, r.median, r.low, r.high) == want
