from __future__ import annotations

import pytest

from shelfscan.plans import reports
from shelfscan.plans.staging import build_staging
from shelfscan.sources import additive_families, additive_refs, category_groups


@pytest.fixture
def staged(raw_rows, claims):
    def make(*rows):
        numbered = [{"code": f"789{i}", **r} for i, r in enumerate(rows)]
        return build_staging(raw_rows(*numbered), claims)

    return make


@pytest.fixture
def empty(raw_rows, claims):
    return build_staging(raw_rows({}), claims).limit(0)


def rows(df):
    return [tuple(r) for r in df.collect()]


BIO4 = {"labels_tags": ["en:bio"], "nova_group": 4}


def test_kpis(staged, empty):
    stg = staged(BIO4, BIO4, {**BIO4, "nova_group": 1}, {"nova_group": 4}, {})
    assert rows(reports.kpis(stg)) == [(5, 3, 3, 2, 66.7)]
    assert rows(reports.kpis_by_case(stg)) == [(3, 3, 2)]
    assert rows(reports.kpis(empty)) == [(0, 0, 0, 0, 0.0)]
    assert rows(reports.kpis_by_case(empty)) == [(None, None, None)]


def test_tile1(staged):
    a = {"nutriscore_grade": "A"}
    stg = staged({**a, "nova_group": 4}, a, a, {"nutriscore_grade": "e"}, {"nutriscore_grade": "?"}, {})
    assert rows(reports.tile1_paradox(stg)) == [("a", 3, 1, 33.3), ("e", 1, 0, 0.0)]
    assert rows(reports.tile1_raw_pct(stg)) == [("a", pytest.approx(100 / 3)), ("e", 0.0)]


def test_tile2(staged):
    both = {"labels_tags": ["en:bio", "en:vegan"]}
    stg = staged({**both, "nova_group": 4}, both, {"labels_tags": ["en:vegan"]}, {})
    assert rows(reports.tile2_claims(stg)) == [("bio", 2, 1, 50.0), ("vegan", 3, 1, 33.3)]


def test_tile3_counts_a_product_once_per_group(spark, staged):
    stg = staged(
        {**BIO4, "categories_tags": ["en:milks", "en:dairy-drinks", "en:sodas"]},
        {**BIO4, "categories_tags": ["en:milks", "pt:milks", "en:unheard-of"]},
        {"nova_group": 4, "categories_tags": ["en:milks"]},
    )
    got = rows(reports.tile3_category_groups(stg, category_groups(spark)))
    assert got == [("Milks & Dairy Drinks", 2), ("Beverages", 1)]


def test_tile4_folds_spellings(staged):
    spelled = ["Nestlé", "nestle", "NESTLE ", "nestle", "", None, "Zé", "Ze"]
    stg = staged(*[{**BIO4, "brands": b} for b in spelled], {"brands": "Zé", "nova_group": 4})
    assert rows(reports.tile4_top_brands(stg)) == [("nestle", 4), ("Ze", 2)]
    assert rows(reports.tile4_any_brand(stg)) == [("NESTLE ", 4), ("Ze", 2)]
    assert rows(reports.tile4_top_brands(stg, k=1)) == [("nestle", 4)]


def test_tile5(spark, staged):
    tags = ["en:e450i", "en:E450II", "en:e451", "en:e150d", "en:xyz", "en:e9999"]
    stg = staged({**BIO4, "additives_tags": tags}, {"nova_group": 4, "additives_tags": ["en:e100"]})
    families, refs = additive_families(spark), additive_refs(spark)
    assert rows(reports.tile5_additives(stg, families)) == [
        ("Phosphates", 3, ["E450", "E451"], "E450/E451 (Phosphates)"),
        ("Caramel Colors", 1, ["E150"], "E150 (Caramel Colors)"),
    ]
    assert rows(reports.tile5_codes_string(stg, families, k=1)) == [("Phosphates", 3, "E450/E451")]
    shown = rows(reports.tile5_references(stg, families, refs))
    assert [r[0] for r in shown] == ["Phosphates"]


def test_tile5_references_keep_dictionary_order(spark, staged):
    tags = ["en:e200"] * 3 + ["en:e950"] * 2 + ["en:e450"]
    stg = staged({**BIO4, "additives_tags": tags})
    shown = rows(reports.tile5_references(stg, additive_families(spark), additive_refs(spark)))
    assert [r[0] for r in shown] == ["Phosphates", "Sweeteners", "Sorbates"]


def test_tile6_window_and_empty_side(staged):
    def made(year_start, labels, additives):
        return {
            "nova_group": 4,
            "labels_tags": labels,
            "created_t": year_start,
            "additives_tags": ["en:e100"] * additives,
        }

    y2020, y2024_end, y2025 = 1577836800, 1735689599, 1735689600
    stg = staged(
        made(y2020 - 1, ["en:bio"], 9),
        made(y2020, ["en:bio"], 2),
        made(y2020, ["en:bio"], 3),
        made(y2020, [], 1),
        made(y2024_end, [], 4),
        made(y2025, [], 9),
    )
    assert rows(reports.tile6_additive_gap(stg)) == [(2020, 2.5, 1.0, 2, 1), (2024, None, 4.0, 0, 1)]


def test_nova_reports(staged):
    stg = staged(BIO4, {"nova_group": 4}, {**BIO4, "nova_group": 1})
    assert rows(reports.nova_distribution(stg)) == [(1, 1, 33.3), (4, 2, 66.7)]
    assert rows(reports.claims_by_nova(stg)) == [(1, 1, 0.0), (4, 1, 100.0)]
    assert rows(reports.claims_on_nova4(stg)) == [("en:bio", 1)]
    assert rows(reports.total_products(stg)) == [(3,)]


def test_paradox_products(staged):
    paradox = {"nutriscore_grade": "a", "nova_group": 4}
    stg = staged(
        {**paradox, "code": "2", "additives_tags": ["x"]},
        {**paradox, "code": "1", "additives_tags": ["x"]},
        {**paradox, "code": "3"},
        {"nutriscore_grade": "a", "code": "4"},
        {"nova_group": 4, "code": "5"},
    )
    got = reports.paradox_products(stg, k=2)
    assert [r.product_id for r in got.collect()] == ["1", "2"]
    assert got.columns[-1] == "matched_health_claims"


def test_deceptive_brands(staged):
    def brand(name, deceptive, honest):
        return [{**BIO4, "brands": name}] * deceptive + [{"brands": name}] * honest

    stg = staged(*brand("b", 2, 3), *brand("a", 2, 3), *brand("c", 4, 0), *brand(None, 9, 0), *brand("", 5, 0))
    assert rows(reports.deceptive_brands(stg)) == [("", 5, 5, 100.0), ("a", 5, 2, 40.0), ("b", 5, 2, 40.0)]


def test_searches(staged, source_rows):
    milk = {"product_name": "LEITE Semi integral X", "categories": "laticínios, leites"}
    stg = staged(milk, {**milk, "nova_group": 4}, {**milk, "product_name": "Integral leite"}, {})
    got = reports.product_search(stg, "Leite%Integral%", "%LATICÍNIOS%")
    assert [r.nova_group for r in got.collect()] == [4, 1]
    source = source_rows(
        {"code": "2", "categories": "pão", "brands": "Continente"},
        {"code": "1", "categories": "de pão doce", "brands": "O Continente"},
        {"code": "3", "categories": "Pão", "brands": "Continente"},
    )
    found = reports.source_search(source, "%pão%", "%Continente%")
    assert [r.code for r in found.collect()] == ["1", "2"]
    assert found.columns == source.columns
