from __future__ import annotations

import datetime as dt

import pytest

from shelfscan import schemas
from shelfscan.operators import arrays_to_json
from shelfscan.plans.mart import build_mart
from shelfscan.plans.staging import build_staging


def one(raw_rows, claims, **values):
    return build_staging(raw_rows(values), claims).first()


def test_schema(raw_rows, claims):
    made = build_staging(raw_rows({}), claims)
    assert made.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.STAGING]


@pytest.mark.parametrize(
    "grade, nova, normal, number, flag",
    [
        ("A", 4, "a", 1, True),
        ("A", 1, "a", 1, False),
        ("unknown", 4, None, None, False),
        (None, 4, None, None, None),
        (None, 1, None, None, False),
        ("e", 4, "e", 5, False),
    ],
)
def test_grades_and_three_valued_flag(raw_rows, claims, grade, nova, normal, number, flag):
    row = one(raw_rows, claims, nutriscore_grade=grade, nova_group=nova)
    assert (row.nutriscore_grade, row.nutriscore_numeric) == (normal, number)
    assert row.is_nutriscore_a_but_nova4 is flag
    assert row.is_ultra_processed is (nova == 4)


@pytest.mark.parametrize(
    "labels, matched",
    [
        (None, []),
        ([], []),
        (["en:vegan", "en:organic", "en:vegan"], ["en:vegan", "en:organic"]),
        ([None, "en:bio"], ["en:bio"]),
        (["en:other"], []),
        (["organic", "EN:ORGANIC"], []),
    ],
)
def test_claims(raw_rows, claims, labels, matched):
    row = one(raw_rows, claims, labels_tags=labels, nova_group=4)
    assert row.matched_health_claims == matched
    assert row.has_health_claim is bool(matched)
    assert row.is_deceptive is bool(matched)
    assert row.labels_tags == (labels or [])


def test_claim_without_ultra_processing_is_not_deceptive(raw_rows, claims):
    row = one(raw_rows, claims, labels_tags=["en:bio"], nova_group=3)
    assert (row.has_health_claim, row.is_deceptive) == (True, False)


def test_rows_without_group_or_name_are_dropped(raw_rows, claims):
    raw = raw_rows({"code": "1"}, {"code": "2", "nova_group": None}, {"code": "3", "product_name": None})
    assert [r.product_id for r in build_staging(raw, claims).collect()] == ["1"]


def test_dates_and_counts(raw_rows, claims):
    row = one(raw_rows, claims, created_t=1577836799, additives_tags=["en:e100", "en:e100", None])
    assert (row.created_date, row.created_year) == (dt.date(2019, 12, 31), 2019)
    assert row.additives_count == 3
    row = one(raw_rows, claims, created_t=None, additives_tags=None, additives_n=None)
    assert (row.created_at, row.created_date, row.created_year) == (None, None, None)
    assert (row.additives_count, row.additives_n, row.additives_tags) == (0, None, [])


def test_json_raw_gives_the_same_rows(raw_rows, claims):
    raw = raw_rows(
        {"code": "1", "labels_tags": ["en:bio", "x"], "categories_tags": None},
        {"code": "2", "additives_tags": ["en:e100"]},
    )
    as_text = arrays_to_json(raw, schemas.TAG_COLUMNS)
    assert build_staging(as_text, claims).collect() == build_staging(raw, claims).collect()


def test_staging_does_not_shuffle_rows(raw_rows, claims, plan_of):
    plan = plan_of(build_staging(raw_rows({}), claims))
    assert "hashpartitioning" not in plan
    assert "Python" not in plan


def test_mart_needs_five_products(raw_rows, claims):
    def product(i, category, nova):
        return {
            "code": f"{category}{i}",
            "labels_tags": ["en:bio"],
            "categories_tags": [category],
            "nova_group": nova,
        }

    rows = [product(i, "en:four", 4) for i in range(4)]
    rows += [product(i, "en:five", 4 if i < 2 else 1) for i in range(5)]
    rows += [{**product(i, "en:none", 4), "labels_tags": []} for i in range(9)]
    mart = build_mart(build_staging(raw_rows(*rows), claims))
    assert mart.schema.names == schemas.MART.names
    assert [f.dataType for f in mart.schema] == [f.dataType for f in schemas.MART]
    assert [tuple(r) for r in mart.collect()] == [("en:five", 5, 2, 0.4)]
