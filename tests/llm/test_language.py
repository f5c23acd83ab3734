"""Language profiles: held-out accuracy, defined results for odd rows."""

import zlib

import corpus_pipeline as pipeline
import numpy as np
import pyarrow as pa

from listora.llm import language_id


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langs = {row.doc_id: row.lang for row in docs.select("doc_id", "lang").collect()}
    rows = language_id.languages(docs).collect()
    assert len(rows) == len(langs)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    held = [row.lang_pred == langs[row.doc_id] for row in rows if row.held_out]
    assert sum(held) / len(held) > 0.95
    assert all(0 <= row.score <= 1 for row in rows)


def test_grams_of_long_texts_add_up(monkeypatch):
    texts = ["Über den Fluß", "", "a1b", "the same " * 300, "ünïcödé " * 90]
    whole, lettered = language_id.bundles(texts, 256)
    monkeypatch.setattr(language_id, "_CHUNK", 97)
    cut, _ = language_id.bundles(texts, 256)
    assert np.array_equal(whole, cut)
    assert lettered.tolist() == [True, False, True, True, True]


def test_binding_and_bundling():
    vectors = language_id._symbol_vectors(64)
    a, b, c = (int(x) for x in language_id.symbols("abc")[1:4])
    wanted = np.roll(vectors[a], 2) * np.roll(vectors[b], 1) * vectors[c]
    assert np.array_equal(language_id.gram_vectors(np.array([a << 16 | b << 8 | c]), 64)[0], wanted)
    owners, grams, counts = language_id.gram_counts(["ab"])
    assert counts.sum() == 2 and set(owners) == {0}  # " ab" and "ab "


def test_hard_rows(hard_docs):
    rows = language_id.languages(hard_docs).collect()
    source = hard_docs.collect()
    assert len(rows) == len(source)
    letters = sum(any(ch.isalpha() for ch in row.text or "") for row in source)
    assert sum(row.lang_pred != "und" for row in rows) == letters
    assert all(row.score == 0 for row in rows if row.lang_pred == "und")
    assert language_id.languages(hard_docs.where("false")).count() == 0
    unlabelled = language_id.languages(hard_docs.withColumn("lang", hard_docs["key"])).collect()
    assert {row.lang_pred for row in unlabelled} == {"und"}


def test_accepted_keeps_columns(hard_docs):
    left = language_id.accepted(hard_docs, 0.0)
    assert left.schema == hard_docs.schema
    assert left.count() == sum(any(ch.isalpha() for ch in row.text or "") for row in hard_docs.collect())


def test_lang_and_ids_are_no_inputs(rows_of):
    rows = [{"doc_id": i, "text": t, "lang": "x" if i % 2 else "y"} for i, t in enumerate(["aaa bbb", "ccc ddd"] * 10)]
    docs = rows_of(rows, "doc_id long, text string, lang string")
    profiles = language_id.fit(docs, docs["doc_id"] >= 0)
    assert profiles.predict(["aaa", "ddd", ""])[0] == ["y", "x", "und"]
    assert isinstance(profiles.vectors, np.ndarray) and pa is not None


def test_unseen_languages_go(spark, sf_dir, rows_of, rng):
    """Random letters and other scripts go, labelled or not, and documents of the languages seen stay."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)) for n in (40, 300, 2000, 20_000)]
    noise += ["Съешь же ещё этих мягких французских булок " * 9, "いろはにほへと ちりぬるを わかよたれそ " * 9, "ποιος ειναι αυτος ο ανθρωπος " * 9]
    odd = [{"doc_id": 10**9 + i, "text": text, "lang": None} for i, text in enumerate(noise)]
    odd += [{"doc_id": 10**9 + 100, "text": noise[0], "lang": "en"}]
    left = {row.doc_id for row in language_id.accepted(docs.union(rows_of(odd, "doc_id long, text string, lang string")), pipeline.LEAST_LIKENESS).collect()}
    assert not [i for i in left if i >= 10**9]
    clean = [row.doc_id for row in docs.collect() if len((row.text or "").split()) >= 50]
    assert len(clean) > 100 and set(clean) <= left
