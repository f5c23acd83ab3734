"""The pipeline's stages, each held against a plain version of its rule on its own input."""

import re

import corpus_pipeline as pipeline
import public_tokenizers
import pytest
from test_decontaminate import brute as brute_leaks
from test_duplicates import brute_components, brute_removed
from tokenizers import Tokenizer

from listora.session import write_out


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows in and out of each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, write_out(stage(spark, docs, sf_dir), name)
        out[name] = (before, docs)
    return out


def ids(df):
    return sorted(row.doc_id for row in df.select("doc_id").collect())


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns, name


def test_language(stages):
    before, after = stages["language_id"]
    lettered = [r.doc_id for r in before.collect() if re.search(r"[^\W\d_]", r.text or "")]
    assert set(ids(after)) <= set(lettered) and len(ids(after)) >= 0.99 * len(lettered)


def test_one_near_duplicate_stays(stages):
    before, after = stages["near_dedup"]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    found, sizes = brute_components([r.text for r in rows])
    assert ids(after) == [r.doc_id for i, r in enumerate(rows) if found[i] == i or not sizes[i]]


def test_repeats_go(stages):
    before, after = stages["substring_dedup"]
    removed = brute_removed([(r.doc_id, r.text) for r in before.collect()])
    kept = {doc_id: n - gone for doc_id, n, gone, _ in removed if gone == 0 or gone < n}
    assert {r.doc_id: len(r.text.encode().split()) for r in after.collect()} == kept


def test_leaks_go(stages, spark, sf_dir):
    before, after = stages["decontaminate"]
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    gone = set(ids(before)) - set(ids(after))
    rows = {r.doc_id: r.text for r in before.collect()}
    some = sorted(gone)[:5] + [i for i in sorted(rows) if i not in gone and len(rows[i]) < 3000][:12]
    assert {row[0] for row in brute_leaks([(i, rows[i]) for i in some], bench)} == gone & set(some)


def test_packed_tokens(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    totals = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in before.collect()}
    found = {}
    for row in after.collect():
        found[row.doc_id] = found.get(row.doc_id, 0) + row.length
        assert row.doc_tokens == totals[row.doc_id]
    assert found == totals


def test_run(spark, sf_dir, stages):
    assert pipeline.run(spark, sf_dir).drop("sequence_id").exceptAll(stages["packing"][1].drop("sequence_id")).isEmpty()
