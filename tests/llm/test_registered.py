import __spark_entry__
import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


def test_all_queries_and_the_pipeline_are_registered():
    known = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in known) == 1
    assert "pipeline" in known


@pytest.mark.parametrize("name", ["op1_top_k", "op3_chat_format", "op12_periodic_runs", "op13_hard_negatives"])
def test_sql_counterpart(spark, name):
    got = __spark_entry__.queries()[name](spark, SMALL)
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({__spark_entry__.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want))


def test_every_document_has_a_row(spark):
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for name, query in __spark_entry__.queries().items():
        if name.split("_")[0] in ("op2", "op4", "op5", "op6", "op8", "op9", "op10", "op12"):
            assert query(spark, SMALL).count() == n, name
