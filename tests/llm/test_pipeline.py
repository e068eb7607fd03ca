"""The pipeline's stages against brute force, each on its own input."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallybook.llm import minhash, mixing, packing, quality, queries, token_files
from tallybook.llm.stage import stage
from tallybook.llm.workers import BATCH_BYTES


def test_stages_follow_each_other(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, inputs = docs.columns, [docs]
    for name, function in corpus_pipeline.STAGES:
        inputs.append(stage(function(spark, inputs[-1], small), "test"))
    raw, good, single, mixed, packed = inputs
    assert good.columns == single.columns == mixed.columns == columns
    labels = spark.read.parquet(f"{small}/labels.parquet")
    kept = good.join(labels, "doc_id").groupBy("quality").count().collect()
    assert sum(r["count"] for r in kept if r["quality"] == 1) == labels.where("quality = 1").count()
    assert sum(r["count"] for r in kept if r["quality"] == 0) <= 0.1 * labels.where("quality = 0").count() + 1

    sets = {}
    for r in good.collect():
        w = [x.lower() for x in r["text"].split()]
        sets[r["doc_id"]] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in links:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert {r["doc_id"] for r in single.collect()} == {d for d in root if root[d] == d}

    expected = mixing.mix_sources(single).agg(F.sum("taken")).first()[0]
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).first()[0] == expected
    assert mixed.select("doc_id").subtract(single.select("doc_id")).count() == 0
    assert packed.where("piece = 0").count() == mixed.count()
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).toPandas()["n"]
    assert fill.max() <= 1024 and len(fill) <= np.ceil(fill.sum() / 1024) + 3


A = " ".join(f"alpha{k}" for k in range(40))
B = " ".join(f"beta{k}" for k in range(40))
ODD = "doc_id long, text string, lang string, source string, n_chars long, keep string, id string, mark long, kept string"


def odd(spark, *rows):
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "x", 3, "x") for i, t, s in rows], ODD)


def test_copies_are_told_by_id_and_text(spark):
    docs = odd(spark, (3, A, "a"), (5, A, "a"), (5, B, "a"), (7, B + " tail", "b"), (7, "other words stand here", "b"),
               (8, None, "a"), (8, None, "a"), (9, "", None), (None, A, "a"), (None, A, "a"), (3, A, "a"))
    got = corpus_pipeline.distinct_documents(spark, docs, "")
    assert got.columns == docs.columns
    found = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert found == sorted([(3, A), (5, B), (7, "other words stand here"), (8, None), (9, ""), (None, A), (None, A)], key=str)


def test_stages_take_odd_rows_and_empty_tables(spark, small):
    docs = odd(spark, (1, A, "a"), (1, A, "a"), (None, B, None), (2, None, "a"), (3, "", None), (4, "word " * 5000, "b"))
    for rows in (docs, docs.limit(0)):
        for name, function in corpus_pipeline.STAGES:
            got = function(spark, rows, small)
            if name != "packing":
                assert got.columns == docs.columns
            found = got.collect()
            if rows is not docs:
                assert not found
            elif name == "packing":
                assert sum(r.piece == 0 for r in found) == 6
                assert sum(r.length for r in found if r.doc_id == 2) == 1
            elif name == "mixing sources":
                assert {r.doc_id for r in found} <= {1, None, 4} and found


def in_batches(function):
    """``function``, failing on a batch of more than twice the bytes that are meant to go to Python at once."""
    most = 2 * BATCH_BYTES

    def checked(batches, *rest):
        def small():
            for batch in batches:
                assert batch.nbytes <= most, f"{len(batch)} rows, {batch.nbytes} bytes"
                yield batch
        return function(small(), *rest)
    return checked


def in_arrays(function):
    most = 2 * BATCH_BYTES

    def checked(column):
        assert column.nbytes <= most, f"{len(column)} rows, {column.nbytes} bytes"
        return function(column)
    return checked


@pytest.mark.parametrize("step", ["quality classifier", "near duplicates", "packing", "token files"])
def test_long_texts_go_to_python_in_small_batches(spark, small, folder, monkeypatch, step):
    """Far fewer rows than Spark puts into a batch, of 24 MB, in one task; repeated and null rows among them."""
    monkeypatch.setattr(quality, "text_features", in_arrays(quality.text_features))
    for module, name in ((minhash, "_signature_rows"), (minhash, "_set_rows"), (packing, "piece_rows"), (token_files, "_list_rows")):
        monkeypatch.setattr(module, name, in_batches(getattr(module, name)))
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    number = (F.col("id") % 150).cast("string")
    text = F.when(F.col("id") != 7, F.repeat(F.concat(F.lit("word"), number, F.lit(" stands here. ")), 4000))
    docs = spark.range(0, 300, 1, 1).select(
        F.col("id").alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"), F.lit("a").alias("source"))
    docs = stage(docs.coalesce(1), "long")
    if step == "token files":
        token_files.write_tokens(docs, f"{folder}/tokens", queries.tokenizer_file(), files=1)
        assert spark.read.parquet(f"{folder}/tokens").count() == 300
    else:
        got = dict(corpus_pipeline.STAGES)[step](spark, docs, small)
        if step == "packing":
            assert got.where("piece = 0").count() == 300
        elif step == "near duplicates":
            # Text 7 is null and has no words; its copy, 157, is one of a kind.
            assert got.count() == 151
        else:
            assert got.columns == docs.columns and got.count() <= 300
    assert spark.conf.get(key) == before


def test_encoding_keeps_to_the_core_of_its_task():
    code = """
import os
from tallybook.llm import queries, tokens
import pyarrow as pa
texts = pa.array([f"some words{k} and signs {k}!" for k in range(5000)])
before = len(os.listdir("/proc/self/task"))
list(tokens.token_slices(texts, queries.tokenizer_file()))
print(len(os.listdir("/proc/self/task")) - before)
"""
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=env, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[-1]) == 0
