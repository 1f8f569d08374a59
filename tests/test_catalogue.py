import itertools

import pytest
from pyspark.sql import functions as F

from tests.oracle import assert_same, connect
from turnweave.functions import text as T
from turnweave.plans.catalogue import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE_SQL:
        assert_same(df, con, ORACLE_SQL[name])
    else:
        assert df.count() > 0  # held against plain versions elsewhere


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[:2] == ["query_id", "label"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_whole_turns_are_sought(spark, sf_dir, tmp_path):
    made = [(1, 0, "user", "yes"), (1, 1, "user", " ".join(f"w{k}" for k in range(30))), (1, 2, "user", "yes yes no " + " ".join(f"w{k}" for k in range(30))), (1, 3, "user", " ".join(f"w{k}" for k in range(29))), (None, 0, "user", "a b a"), (None, 0, "user", "a b a"), (None, 1, None, None), (1, 4, "user", "")]
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    made = spark.createDataFrame(made, "conv_id long, turn long, role string, text string").withColumn("conv_id", F.col("conv_id") - 1000)
    talk.union(made).write.parquet(str(tmp_path / "conversations.parquet"))
    rows = sorted(talk.union(made).withColumn("words", T.lexical_tokens("text")).collect(), key=lambda r: tuple((v is not None, v or type(v)()) if v is not None else (False,) for v in (r.conv_id, r.turn, r.role, r.text)))
    want = []
    for conv, turns in itertools.groupby(rows, key=lambda r: r.conv_id):
        turns = list(turns)
        said = [w for r in turns for w in r.words or []]
        first = {}
        for r in turns:
            if r.words:
                first.setdefault(tuple(r.words), r.turn)
        want += [(conv, turn, k, k + len(words) - 1) for words, turn in first.items() for k in range(len(said)) if tuple(said[k : k + len(words)]) == words]
    got = [tuple(r) for r in QUERIES["text_match_spans"](spark, str(tmp_path)).select("conv_id", "target_id", "first", "last").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert (-999, 1, 1, 30) in got and (-999, 1, 34, 63) in got and (None, 0, 3, 5) in got
