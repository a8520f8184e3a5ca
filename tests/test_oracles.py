"""Every registered query of the legal-corpus part against its SQL twin."""

import glob
import os

import duckdb
import pytest

from lexicord import catalogue


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = catalogue.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    told = duck.sql(catalogue.oracle_sql()[name])
    assert columns == sorted(told.columns)
    order = [told.columns.index(c) for c in columns]
    got = sorted(([plain(r[c]) for c in columns] for r in df.collect()), key=repr)
    expected = sorted(([plain(r[i]) for i in order] for r in told.fetchall()), key=repr)
    assert got == expected


def test_queries_without_sql_give_rows(spark, sf_dir):
    for name in set(catalogue.queries()) - set(catalogue.oracle_sql()):
        assert catalogue.queries()[name](spark, sf_dir).count() > 0


def test_markers_before_lines_that_begin_with_figures(spark, tmp_path):
    from lexicord.plans import text_queries

    texts = [(1, "12 a\n3\n2b\nc"), (2, "0\n1\n\n07\n4x"), (3, None), (4, ""), (5, "\n".join(f"{k} {'z' * 40}" for k in range(30)))]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = text_queries.database_markers(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(text_queries.MARKERS).fetchall())


def test_control_characters_stay_in_paragraphs(spark, tmp_path):
    from lexicord.plans import document_queries, text_queries

    texts = [(1, "a\x01b\n\x01\nc\x02\x02d\n\x03\x03a\n\x03c\x01\x02\x03b"), (2, "\x02"), (3, "\n".join(["1.\x01x", "\x021. y", "z\x03a", "w\x03", "\x01Άρθρο 9", "-\x01"] * 3)), (4, "none")]
    docs = spark.createDataFrame([(i, t, "web") for i, t in texts], "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for query, sql in (text_queries.QUERIES["paragraph_records"], document_queries.QUERIES["paragraph_rows"], document_queries.QUERIES["parsed_laws"]):
        got = query(spark, str(tmp_path)).collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.sql(sql).fetchall()))
