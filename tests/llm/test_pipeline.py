import os
import shutil
import weakref

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quillgrid.llm.queries import QUERIES, tokenizer_path
from test_decontaminate import brute as passages
from test_exact_dedup import lower
from test_jaccard import brute as classes

tokenizers = pytest.importorskip("tokenizers")
SF = "/root/testdata/sf0.001"


def test_against_brute_force(spark, tmp_path):
    folder = str(tmp_path / "sf")
    os.makedirs(folder)
    shutil.copy(f"{SF}/benchmark.parquet", folder)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(4).select(
        (F.col("doc_id") + 9000).alias("doc_id"), F.when(F.col("doc_id") % 2 == 0, F.upper("text")).alias("text"), "lang", "source", "n_chars"
    )
    docs.union(odd).union(docs.limit(3)).write.parquet(f"{folder}/documents.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}

    rows = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    model = corpus_pipeline.language.learn(spark.read.parquet(f"{folder}/documents.parquet"), corpus_pipeline.learns_language())
    languages = corpus_pipeline.language.Languages(model)
    kept = [r for r in rows if languages.predict(r["text"] or "")[0] != "und" and languages.predict(r["text"] or "")[2] > corpus_pipeline.language.MIN_MARGIN]
    first = {}
    for r in sorted(kept, key=lambda r: r["doc_id"]):
        first.setdefault(lower(r["text"]), r)
    linked = classes([(r["doc_id"], r["text"]) for r in first.values()], 80, 5)
    kept = [r for r in first.values() if linked[r["doc_id"]][1] == r["doc_id"]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hit = passages([r["text"] for r in kept], items)
    kept = {r["doc_id"]: r for i, r in enumerate(kept) if not hit[i][3]}
    assert set(out) == set(kept) and len(kept) < len(rows) - 20
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    for i, r in kept.items():
        assert out[i].text == r["text"] and out[i].ids == library.encode(r["text"], add_special_tokens=False).ids
        assert out[i].n_tokens == len(out[i].ids) and (out[i].lang, out[i].source) == (r["lang"], r["source"])


def test_an_empty_table_passes_all_stages(spark, docs):
    df = docs([])
    for _, stage in corpus_pipeline.STAGES:
        df = stage(spark, df, SF)
    assert df.count() == 0


def test_one_query_for_each_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_workers_keep_what_one_stage_needs():
    from quillgrid.llm.common import once_per_worker

    class Model:
        pass

    one = once_per_worker(("test", 1, "a"), Model)
    assert once_per_worker(("test", 1, "b"), Model) is not one and once_per_worker(("test", 1, "a"), Model) is one
    gone = weakref.ref(one)
    del one
    once_per_worker(("test", 2), Model)
    assert gone() is None


def test_tokens_there_and_back_in_one_go(docs):
    from quillgrid.llm import bpe

    texts = docs(["", None, "Zwei  Wörter\n", "<|endoftext|> a", "x" * 300])
    path = tokenizer_path()
    two = bpe.decode(bpe.encode(texts, path), path)
    one = bpe.round_trip(texts, path)
    assert one.columns == two.columns and sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    tokens = corpus_pipeline.tokens(one.sparkSession, texts, SF)
    plan = tokens._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and tokens.columns == [*texts.columns, "n_tokens", "ids"]
