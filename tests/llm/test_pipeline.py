"""Each stage of the pipeline against a plain version, over awkward rows: null ids and texts, repeated rows, one id with several texts, columns with
clashing names, an empty table."""

import random
import shutil

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import base, components, sets
from turnweave.llm import bpe, cotrain, personal

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def made(spark, sf_dir, tmp_path_factory):
    """Documents of the smallest tables with planted rows; and the folder."""
    folder = str(tmp_path_factory.mktemp("sf"))
    for name in ("labels", "benchmark"):
        shutil.copy(f"{sf_dir}/{name}.parquet", f"{folder}/{name}.parquet")
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**5)}" for _ in range(80)]
    near = " ".join(["other", *words[1:]])
    item = next(r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if len((r.text or "").split()) > 20)
    planted = [(9001, " ".join(words)), (9002, near), (9002, "an unrelated text of that same id " * 3), (None, near), (None, f"no id but {item} inside"), (9003, f"an id and {item} inside"), (9003, "an id without any item in it " * 2)]
    planted += [(9004, None), (9005, ""), (9006, "mail jane@host.org now " * 2), (9006, "mail jane@host.org now " * 2), (9007, " \n ")]
    own = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(120)
    rows = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in planted], own.schema).union(own)
    rows = rows.withColumns({"row": F.lit("r"), "cls": F.lit(1), "spans": F.lit(0.5), "name": F.lit("n"), "score": F.lit(True)})
    rows.write.parquet(f"{folder}/documents.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet"), folder


def keys(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_quality(spark, made):
    docs, folder = made
    out = STAGES["quality classifier"](spark, docs, folder)
    assert out.schema == docs.schema
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    judged = cotrain.quality(docs, labels)
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r.doc_id for r in judged.where("kept").collect()), key=str)


def test_near_duplicates(spark, made):
    docs, folder = made
    out = STAGES["n-gram Jaccard join"](spark, docs, folder)
    assert out.columns == docs.columns
    rows = sorted(set((r.doc_id, r.text) for r in docs.collect()), key=lambda x: (x[0] is None, x[0] or 0, str(x[1])))
    root = components({k: sets(t, 5) for k, (_, t) in enumerate(rows)}, 80)
    # Of a group the rows with its smallest doc_id stay; two texts of that id in one group can't both.
    kept = [(i, t) for k, (i, t) in enumerate(rows) if root[k] == k or not sets(t, 5)]
    got = keys(out.distinct())
    assert [i for i, _ in got] == [i for i, _ in sorted(kept, key=str)]
    assert (9002, "an unrelated text of that same id " * 3) in got
    assert (9002, docs.where("doc_id = 9002 and text like 'other%'").first().text) not in got


def test_benchmark_passages(spark, made):
    docs, folder = made
    out = STAGES["benchmark decontamination"](spark, docs, folder)
    import re

    word = re.compile(r"[a-z0-9\u0080-\U0010ffff]+")
    grams = lambda t: {tuple(w[i : i + 5]) for w in [word.findall((t or "").lower())] for i in range(len(w) - 4)}
    items = [g for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect() if (g := grams(r.text))]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = [(i, t) for i, t in rows if not any(100 * len(q & grams(t)) >= 80 * len(q) for q in items)]
    assert out.columns == docs.columns and keys(out) == sorted(want, key=str) and len(want) <= len(rows) - 2


def test_personal_data(spark, made):
    docs, folder = made
    out = {(r.doc_id, r.lang, r.source): r for r in STAGES["PII"](spark, docs.where("doc_id is not null"), folder).collect()}
    assert STAGES["PII"](spark, docs, folder).schema == docs.schema and STAGES["PII"](spark, docs, folder).count() == docs.count()
    for r in docs.where("doc_id is not null and doc_id not in (9002, 9003)").collect():
        text = out[(r.doc_id, r.lang, r.source)].text
        assert text is None if r.text is None else not base(text) and out[(r.doc_id, r.lang, r.source)].n_chars == len(text)
        if text is not None and not personal.candidates(r.text) and not base(r.text):
            assert text == r.text
    assert out[(9006, "en", "s")].text == "mail <EMAIL> now " * 2


def test_encoding(spark, made):
    docs, folder = made
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(corpus_pipeline.RANKS), special_tokens={})
    got = sorted((str(r.doc_id), list(r.ids), r.n_tokens) for r in STAGES["byte-level BPE"](spark, docs, folder).collect())
    want = [coder.encode_ordinary(r.text or "") for r in docs.collect()]
    assert got == sorted((str(r.doc_id), ids, len(ids)) for r, ids in zip(docs.collect(), want, strict=True))


def test_empty_tables(spark, made, tmp_path):
    docs, folder = made
    docs.limit(0).write.parquet(str(tmp_path / "none.parquet"))
    none = spark.read.schema(docs.schema).parquet(str(tmp_path / "none.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).count() == 0, name
