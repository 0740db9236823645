"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")
from veilframe import catalog as q  # noqa: E402
from veilframe.queries import TABLES  # noqa: E402

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
QUICK = [
    "luhn_verify_documents", "rrn_verify_generated", "tile_rects_grid", "permille_roundtrip", "finding_dedup_greedy", "match_joined_boxes", "geometry_tiers", "nearby_line", "reading_order_rows", "label_word_filter", "finalize_iou_dedup", "union_items", "drift_spread", "tile_sample_topn", "page_range_expand", "manifest_diff",
    "regions_assembled", "crops_to_retry", "char_spans", "verify_clears", "mislabel_held", "tile_roundtrip", "call_plan", "asked_with_retries", "answers_recovered", "unusable_items", "samples_united", "variant_metrics", "items_in_order",
    "page_documents", "evasive_spellings", "generated_values_verify", "training_rows", "rejected_samples", "document_pages", "variant_settings",
]


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_same_as_sql(spark, tables, name):
    got, want = q.QUERIES[name](spark, DIR), tables.execute(q.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(d[0] for d in want.description)
    place = [[d[0] for d in want.description].index(c) for c in columns]
    ours = sorted(map(repr, (tuple(r) for r in got.select(*columns).collect())))
    assert ours == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert set(q.QUERIES) <= set(entry.queries()) and set(q.ORACLES) <= set(entry.oracle_sql())
