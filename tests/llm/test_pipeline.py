"""The pipeline on planted cases, and the registered queries on the smallest tables."""

import duckdb
import pytest

import corpus_pipeline
from tests.llm.cases import documents, prose
from tests.parity import compare, duck
from tillcast.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    passage, item = prose(500, 70), prose(501, 40)
    rows = [(k, prose(600 + k, 120)) for k in range(200)]
    rows += [(300 + k, prose(700 + k, 60) + " " + passage + " " + prose(750 + k, 40)) for k in range(4)]
    rows += [(400, prose(600, 120)), (401, prose(800, 30) + " " + item), (402, None), (403, ""), (None, prose(803, 50))]
    rows += [(1000 + k, prose(900 + k, 60) + (" vilewort nastyness grimly" if k % 3 == 0 else "")) for k in range(240)]
    documents(spark, rows, ["extra", "toxicity"]).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1000 + k, 1, int(k % 3 == 0)) for k in range(240)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d), rows, passage


def test_pipeline_on_planted_cases(spark, tables):
    d, rows, passage = tables
    out = {r["doc_id"]: r for r in corpus_pipeline.run(spark, d).collect()}
    source = dict(rows)
    assert set(range(200)) <= set(out) and all(out[k]["text"] == source[k] for k in range(200))  # clean documents stay as they are
    assert 400 not in out  # exact copy of 0
    assert sum(passage in (r["text"] or "") for r in out.values()) == 1 and 300 in out and passage in out[300]["text"]
    assert 401 not in out  # benchmark item
    assert not any("vilewort" in (r["text"] or "") for r in out.values())
    assert all(1000 + k in out for k in range(240) if k % 3)
    assert out[402]["n_tokens"] == 0 and None in out  # 402 and 403 share fingerprint zero


def test_stages_keep_the_columns(spark, tables):
    d, _, _ = tables
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).columns == docs.columns, name
        assert stage(spark, docs.limit(0), d).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), d).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    ok, msg, _ = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_one_row_per_document(spark, name):
    table = "pages" if name.startswith("op7") else "documents"
    n = duckdb.sql(f"SELECT count(*) FROM read_parquet('{SF}/{table}.parquet')").fetchall()[0][0]
    assert QUERIES[name](spark, SF).count() == n
