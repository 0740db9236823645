"""Vectors for the column functions, as rows of literals."""

import pytest
from pyspark.sql import functions as F

from veilframe.functions import checks, geometry, jsonio, textnorm


def values(table, rows, schema, *columns):
    return [tuple(r) for r in table([(i, *r) for i, r in enumerate(rows)], f"_i int, {schema}").orderBy("_i").select(*columns).collect()]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("text", ["9012311234563", "901231-1234563", "901231 1234563", "9506152345672", "0301012345678", "9506155234561", "8803046123454"])
def test_rrn_valid(spark, text):
    assert one(spark, checks.rrn_valid(F.lit(text)))[0]


@pytest.mark.parametrize("text", ["9012311234564", "901231123456", "90123112345631", "9013311234563", "9012321234563", "9002301234563", "9004311234563", "", "abc"])
def test_rrn_invalid(spark, text):
    assert one(spark, checks.rrn_valid(F.lit(text)))[0] is False


def test_luhn(spark, table):
    good = ["4111111111111111", "4111-1111-1111-1111", "5555555555554444", "1234567812345670"]
    bad = ["4111111111111112", "411111111111", "41111111111111111111", ""]
    got = values(table, [(t,) for t in good + bad], "t string", checks.luhn_valid(F.col("t")))
    assert [g[0] for g in got] == [True] * 4 + [False] * 4


def test_digits_only(table):
    got = values(table, [("901231-1234563",), ("none",), ("１２ 3²",), (None,)], "t string", checks.digits_only(F.col("t")))
    assert [g[0] for g in got] == ["9012311234563", "", "123", None]


def test_field_labels(table):
    assert len(set(checks.FIELD_LABELS)) == 54
    got = values(table, [("성 명",), ("주소 :",), ("성명 홍길동",), ("",), (None,)], "t string", checks.is_field_label(F.col("t")))
    assert [g[0] for g in got] == [True, True, False, False, False]


# Spellings that must fold, and those that must not.
CANONICAL = [
    ("０１０－１２３４－５６７８", "010-1234-5678"), ("①②③④⑤", "12345"), ("⁰¹²³", "0123"), ("𝟎𝟏𝟐𝟑", "0123"), ("901231‑1234567", "901231-1234567"), ("901231–1234567", "901231-1234567"),
    ("010​-1234-5678", "010-1234-5678"), ("010﻿-1234­-5678", "010-1234-5678"), ("구1공8공4", "910804"), ("공일공-일이삼사-오육칠팔", "010-1234-5678"), ("공1공-1234-5678", "010-1234-5678"),
    ("901231-1이3사5육7", "901231-1234567"), ("공일공일이삼사오육칠팔", "01012345678"), ("0lO-1234-5678", "010-1234-5678"), ("O1O-l234-5678", "010-1234-5678"), ("9O1231-1234563", "901231-1234563"),
    ("hong(at)hana(dot)com", "hong@hana.com"), ("hong[at]hana[dot]com", "hong@hana.com"), ("hong (at) hana.com", "hong@hana.com"), ("hong골뱅이hana.co.kr", "hong@hana.co.kr"), ("hong앳hana.co.kr", "hong@hana.co.kr"), ("hong at hana.co.kr", "hong@hana.co.kr"),
]
SAME = ["일이삼사", "오사구", "제3구역 1234", "3구 1234-5678", "서울특별시 강남구 테헤란로", "Bob", "GLOBAL", "OTHER", "we will look at the document", ""]


@pytest.mark.parametrize(("text", "folded"), CANONICAL + [(t, t) for t in SAME])
def test_canonical(text, folded):
    got = textnorm.canonical(text)
    assert got[0] == folded and got[3] == (text != folded) and len(got[1]) == len(got[2]) == len(folded)


def test_original_span(spark):
    text = "연락처 공일공-일이삼사-오육칠팔 입니다"
    c = textnorm.canonicalize(F.lit(text))
    at = textnorm.canonical(text)[0].index("010")
    got = one(spark, textnorm.original_span(c, F.lit(at), F.lit(at + 13)).alias("s"), textnorm.original_span(c, F.lit(3), F.lit(3)).alias("none"), textnorm.canonicalize(F.lit(None).cast("string"))["text"])
    assert text[got.s.start : got.s.end] == "공일공-일이삼사-오육칠팔" and tuple(got.none) == (0, 0) and got[2] is None
    size = len(text)  # places beyond the text count as its last
    beyond = one(spark, textnorm.original_span(c, F.lit(500), F.lit(600)), textnorm.original_span(c, F.lit(-3), F.lit(600)), textnorm.original_span(textnorm.canonicalize(F.lit("")), F.lit(0), F.lit(5)))
    assert [tuple(b) for b in beyond] == [(size - 1, size), (0, size), (0, 0)]


def test_spelt_addresses_point_at_all_they_came_from():
    folded, starts, ends, changed = textnorm.canonical("to max.m [ at ] buero-7 (dot) org, eva{at}a.b-c.example 앳")
    assert folded == "to max.m@buero-7.org, eva@a.b-c.example 앳" and changed
    at = folded.index("@")
    assert (starts[at], ends[at]) == (3, 33) and len(starts) == len(folded)
    for same in ("look at me", "a ( dot b", "x(at)y", "hana (at) com( dot de", "(at) hana.com"):
        assert textnorm.canonical(same)[0] == same


ITEM = '{"text":"a","type":"NAME","bbox_2d":[1,2,3,4]}'


@pytest.mark.parametrize(
    ("raw", "n"),
    [
        (f'{{"findings":[{ITEM}]}}', 1), (f"{ITEM}\n{ITEM}", 2), (f"[{ITEM},3]", 1), (f'```json\n{{"findings":[{ITEM}]}}\n```', 1), (f'{{"findings":[{ITEM}]}} {{"findings":[{ITEM}]}}', 2),
        (f'{{"findings":[{ITEM}]}} that is all', 1), ("nothing", None), ("", None), (None, None), ('{"findings":[', None),
    ],
)
def test_salvage(spark, raw, n):
    got = one(spark, jsonio.parse_answer(F.lit(raw).cast("string")).alias("a")).a
    assert (got["items"] is None) == (n is None)
    items = one(spark, jsonio.typed_items(F.lit(got["items"]).cast("string")))[0]
    assert (None if items is None else len(items)) == n


@pytest.mark.parametrize(
    ("raw", "want"),
    [([0.3, 0.2, 0.1, 0.1], (0.1, 0.1, 0.3, 0.2)), ([-0.5, 0.2, 1.7, 0.4], (0.0, 0.2, 1.0, 0.4)), ([0.5, 0.5, 0.5, 0.5], (0.496, 0.496, 0.504, 0.504)), ([0.1, 0.2], None), (None, None), ([None, 0.1, 0.2, 0.3], None)],
)
def test_sane_rect(spark, raw, want):
    got = one(spark, geometry.sane_rect(F.lit(raw).cast("array<double>") if raw is None or None in raw else F.array(*map(F.lit, raw))) if raw is None or None not in raw else geometry.sane_rect(F.array(F.lit(None).cast("double"), *[F.lit(v) for v in raw[1:]])))[0]
    assert got is None if want is None else tuple(round(v, 9) for v in got) == want


def test_tiles(spark):
    rects = one(spark, geometry.tiles(F.lit(1760), F.lit(2464)).alias("t")).t
    assert [(round(r.y1 * 2464), round(r.y2 * 2464)) for r in rects] == [(0, 960), (736, 1696), (1504, 2464)]
    halves = one(spark, geometry.tiles(F.lit(1000), F.lit(2000), 2, 0.0, 1), geometry.tiles(F.lit(2000), F.lit(1000), 2, 0.0, 1), geometry.tiles(F.lit(5), F.lit(5), 1))
    assert [(r.y1, r.y2) for r in halves[0]] == [(0, 0.5), (0.5, 1)] and [(r.x1, r.x2) for r in halves[1]] == [(0, 0.5), (0.5, 1)] and [tuple(r) for r in halves[2]] == [(0, 0, 1, 1)]


def test_smart_resize(spark):
    got = one(spark, geometry.smart_resize(F.lit(2480), F.lit(1748), 32), geometry.smart_resize(F.lit(2480), F.lit(1748), 28), geometry.smart_resize(F.lit(3), F.lit(3), 32))
    assert tuple(got[0]) == (2496, 1760) and tuple(got[1]) == (2492, 1736) and min(got[2]) >= 32


def test_rounding_mix(spark):
    b = geometry.crop_to_page(geometry.box(3, 3, 5, 5), geometry.box(0, 0, 9, 9), F.lit(2.0))
    assert tuple(one(spark, b)[0]) == (1, 1, 2, 2)  # 1.5 loses its fraction, 2.5 goes to the even number
