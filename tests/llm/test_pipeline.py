"""The pipeline's stages on a small table, and the registered queries' columns."""

from __future__ import annotations

import corpus_pipeline
import duckdb
import pytest

from shelfscan.llm import queries, topk

#: Columns that the queries' contracts name.
COLUMNS = {
    "op1_html_extraction": {"page_id", "url", "text", "n_chars"},
    "op2_substring_dedup": {"doc_id", "n_words", "n_removed", "kept_sha256"},
    "op3_token_counts": {"doc_id", "n_words", "n_tokens"},
    "op4_best_fit_packing": {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"},
    "op5_language_id": {"doc_id", "held_out", "lang_pred", "score"},
    "op6_jaccard_join": {"doc_id", "n_shingles", "component_id"},
    "op7_top_k": {"query_id", "rank", "vec_id", "score"},
    "op8_bpe": {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"},
    "op9_quality_rules": {
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    },
    "op10_quality_gam": {"doc_id", "held_out", "score", "predicted"},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_its_columns(spark, sf_dir, name):
    folder = sf_dir.replace("sf0.01", "sf0.001")
    df = queries.queries()[name](spark, folder)
    assert set(df.columns) >= COLUMNS[name]
    table = {"op1_html_extraction": "pages", "op7_top_k": None}.get(name, "documents")
    if table and name != "op4_best_fit_packing":
        assert df.count() == spark.read.parquet(f"{folder}/{table}.parquet").count()


def test_top_k_equals_its_sql(spark, sf_dir):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    expected = sorted(connection.execute(topk.ORACLE_SQL).fetchall())
    got = queries.queries()["op7_top_k"](spark, sf_dir).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == expected


def test_stages(spark, sf_dir, tmp_path):
    folder = sf_dir.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None, None, None, None), (10**6 + 1, "", "en", "s", 0)], docs.schema)
    docs = docs.union(odd).union(docs.limit(3))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == corpus_pipeline.COLUMNS
        assert 0 < docs.count() <= before.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_unlearnt_scripts_go_and_learnt_languages_stay(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    greek, russian = "ελληνικά γράμματα εδώ και τώρα για όλους " * 9, "это текст на русском языке о погоде " * 9
    short = [(-1, "This.", None, "s", 5), (-2, "Sich auch der und die.", None, "s", 22)]
    odd = [(-3, greek, None, "s", 9), (-4, russian, "en", "s", 9), (-5, "12 34", "en", "s", 5), (-6, None, "en", "s", 0)]
    rows = docs.union(spark.createDataFrame([*short, *odd], docs.schema))
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, rows, sf_dir).collect()}
    assert kept & {-1, -2, -3, -4, -5, -6} == {-1, -2}
    words = {r.doc_id: r.text.split() for r in docs.filter("text is not null").collect()}
    gone = words.keys() - kept
    assert len(gone) < 0.01 * len(words) and all(4 * len(set(words[i])) < len(words[i]) for i in gone)


def test_one_row_of_each_group_is_kept(spark):
    base, other, third = ([f"{c}{i}" for i in range(60)] for c in "abc")
    text = " ".join
    near = text([*base[:-1], "z"])
    rows = [
        (1, text(base), "en", "s", 1), (1, text(base), "en", "s", 1), (1, text(base), None, "s", 1), (2, near, "en", "s", 1),
        (2, text(other), "en", "s", 1), (3, near, "en", "s", 1), (4, text(third), "en", "s", 1), (4, text([*third[1:], "z"]), "en", "s", 1),
        (None, text(base), "en", "s", 1), (None, "only here", "en", "s", 1), (None, "only here", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = [[(r.doc_id, r.text) for r in corpus_pipeline.near_duplicate_groups(spark, d, "").collect()] for d in (docs, docs.repartition(7))]
    assert sorted(got[0], key=repr) == sorted(got[1], key=repr)
    fourth = {t for i, t in got[0] if i == 4}
    assert len(fourth) == 1 and fourth <= {rows[6][1], rows[7][1]}
    expected = [(1, text(base)), (2, text(other)), (None, text(base)), *[(None, "only here")] * 2]
    assert sorted((r for r in got[0] if r[0] != 4), key=repr) == sorted(expected, key=repr)


def test_an_empty_table_goes_through(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0
