import pytest

import corpus_pipeline
from tests.oracle import assert_same, connect
from turnweave.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE_SQL[name])


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.toPandas(), docs.schema)
        assert 0 < after.count() <= before.count()
        before = after
    last = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir)
    assert last.count() == before.count()
    assert before.where("text rlike '[a-z0-9]@mail[0-9]'").count() == 0
