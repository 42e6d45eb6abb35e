"""Registered queries on the smallest tables: SQL where there is some, else a model."""

import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from feedloom.llm import queries as Q
from tests.conftest import SF_SMALL
from tests.llm import test_decontam, test_licence
from tests.llm.helpers import docs, near_model, shingles


def rows(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/{name}.parquet").collect()]


def test_one_query_for_each_operator_and_the_pipeline():
    names = E.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in Q.QUERIES) == list(range(1, 14))
    assert set(Q.QUERIES) <= set(names) and names["pipeline"] is C.run and "pipeline" not in E.oracle_sql()
    assert [n for n, _ in C.STAGES] == ["quality", "near_duplicates", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "embeddings", "documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF_SMALL)
    cur = con.execute(Q.ORACLES[name])
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(*cols).collect()))) == sorted(map(repr, cur.fetchall()))


def test_joins_and_scans_equal_models(spark):
    d = [(r[0], r[1]) for r in rows(spark, "documents")]
    got = sorted(tuple(r) for r in Q.QUERIES["op4_jaccard_join"](spark, SF_SMALL).collect())
    assert got == sorted(near_model(d))
    found = {(r["doc_id"], r["item_id"]) for r in Q.QUERIES["op2_decontamination"](spark, SF_SMALL).collect()}
    items = [(r[0], r[1]) for r in rows(spark, "benchmark")]
    suspects = [(i, t) for i, t in d if any(set(shingles(t, 3)) & set(shingles(x, 3)) for _, x in items)]
    assert found == test_decontam.model(suspects, items) and found
    scan = Q.QUERIES["op6_licence_scan"](spark, SF_SMALL).collect()
    cols = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert {r["doc_id"]: tuple(r[c] for c in cols) for r in scan} == {i: test_licence.model(t) for i, t in d}


@pytest.mark.parametrize("name, columns", [
    ("op5_shard", ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]),
    ("op7_token_counts", ["doc_id", "n_bytes", "n_tokens", "over_limit"]),
    ("op8_packing", ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]),
    ("op9_quality", ["doc_id", "held_out", "score", "predicted"]),
    ("op10_html_text", ["page_id", "title", "text", "n_lines"]),
    ("op12_personal_data", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]),
])
def test_columns_and_rows(spark, name, columns):
    df = Q.QUERIES[name](spark, SF_SMALL)
    assert df.columns == columns
    table = "pages" if name.startswith("op10") else "documents"
    ids = sorted(r[0] for r in df.select(columns[0]).distinct().collect())
    assert ids == sorted(r[0] for r in rows(spark, table))


def test_stages_keep_clean_documents_and_drop_planted_ones(spark):
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    bench = rows(spark, "benchmark")
    good = [(r[0], r[1]) for r in base.join(spark.read.parquet(f"{SF_SMALL}/labels.parquet").where("quality = 1"), "doc_id")
            .select("doc_id", "text").orderBy("doc_id").limit(12).collect()]
    clean = good[0][1]
    planted = spark.createDataFrame(
        [(9001, clean, "en", "s", 5), (9002, clean + " tail", "en", "s", 5),
         (9003, good[1][1] + "\n" + bench[0][1] + "\n" + good[2][1], "en", "s", 5), (9004, None, None, None, None),
         (9005, "", None, None, 0), (None, good[3][1], None, None, None)], base.schema)
    now = base.unionByName(planted)
    sizes = [now.count()]
    for name, stage in C.STAGES[:-1]:
        new = stage(spark, now, SF_SMALL)
        assert new.columns == base.columns, name
        now = spark.createDataFrame(new.collect(), base.schema)
        sizes.append(now.count())
        ids = {r["doc_id"] for r in now.collect()}
        if name == "quality":
            assert {i for i, _ in good} <= ids | {None}
        if name == "near_duplicates":
            model = near_model([(r["doc_id"], r["text"]) for r in now.collect()])
            assert all(links == 0 for _, _, links, _ in model)
        if name == "decontamination":
            assert 9003 not in ids
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] > 0
    pieces = C.STAGES[-1][1](spark, now, SF_SMALL)
    assert {r["doc_id"] for r in pieces.collect()} == {r["doc_id"] for r in now.collect()}


def test_stages_take_empty_tables(spark):
    empty = docs(spark, [])
    for name, stage in C.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0, name
