"""The ledger of quality rules against a plain count, policies and ablations, odd rows."""

import re
from collections import Counter

import pytest

from listora.llm import quality_rules as quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if often[window] > 1 for k in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(ch in "#*$%&|<>" for ch in text),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered),
        "n_letters": sum(ch.isalpha() for ch in text), "n_upper": sum(ch.isupper() and ch.isalpha() for ch in text),
        "n_shouts": text.count("!"),
    }
    rules = [
        out["n_words"] < 10, 100 * len(covered) > 20 * len(words), 10 * out["n_symbols"] > len(words),
        100 * out["n_dup_lines"] > 40 * len(lines), 2 * out["n_upper"] > out["n_letters"], 10 * out["n_shouts"] > len(words),
        100 * out["n_letters"] < 40 * out["word_chars"], out["word_chars"] < 2 * len(words) or out["word_chars"] > 20 * len(words),
    ]
    return out | {"failed": sum(1 << bit for bit, fails in enumerate(rules) if fails)}


def rows_told(df):
    return sorted((repr(row.doc_id), {name: row[name] for name in (*quality.MEASURES, "failed")}.items().__repr__()) for row in df.collect())


def test_ledger_of_hard_rows(hard_docs):
    wanted = sorted((repr(row.doc_id), {name: plain(row.text)[name] for name in (*quality.MEASURES, "failed")}.items().__repr__()) for row in hard_docs.collect())
    assert rows_told(quality.ledger(hard_docs)) == wanted
    assert quality.ledger(hard_docs.where("false")).count() == 0


def test_repeats_of_all_kinds(rows_of):
    texts = ["a a a a a a a", "1 2 3 4 5 6 1 2 3 4 5", "1 2 3 4 5 x 1 2 3 4 5 x 2 3 4 5 1", "1 2 3 4", "1 2 3 4 5", "l\nl\n \n\nl\nm", "\x0b\x0ca\x0b\x0c b\r\nb"]
    docs = rows_of([{"doc_id": i, "text": text} for i, text in enumerate(texts)], "doc_id long, text string")
    got = {row.doc_id: {name: row[name] for name in (*quality.MEASURES, "failed")} for row in quality.ledger(docs).collect()}
    assert got == {i: plain(text) for i, text in enumerate(texts)}


def test_labelled_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality.kept_documents(docs).join(labels, "doc_id").collect()
    base = quality.BASE.mask()
    clean = [row.kept for row in rows if row.quality == 1 and not row.failed & base]
    junk = [row.kept for row in rows if row.quality == 0]
    assert all(clean)
    assert sum(junk) <= 0.1 * len(junk)


def test_policies_and_ablations(spark):
    rows = [(i, bits, "s" if i % 2 else None) for i, bits in enumerate([0, 0, 1, 2, 3, 4, 7, 128, 4, 6])]
    found = spark.createDataFrame(rows, "doc_id long, failed long, source string")
    policy = quality.Policy("strict", 3, ("few_words", "repeated_words", "symbols"))
    kept = {row.doc_id: row.kept for row in quality.verdicts(found, policy).collect()}
    assert kept == {i: bits & 7 == 0 for i, bits, _ in rows}
    lenient = quality.Policy("lenient", 1, policy.rules, allowed=1)
    assert {row.doc_id: row.kept for row in quality.verdicts(found, lenient).collect()} == {i: (bits & 7).bit_count() <= 1 for i, bits, _ in rows}
    for chosen in (policy, lenient):
        for row in quality.ablations(found, chosen).collect():
            bit = 1 << next(rule.bit for rule in quality.RULES if rule.name == row.rule)
            keep = [(bits & 7).bit_count() <= chosen.allowed for _, bits, _ in rows]
            without = [(bits & 7 & ~bit).bit_count() <= chosen.allowed for _, bits, _ in rows]
            assert row.n_failed == sum(bits & bit > 0 for _, bits, _ in rows)
            assert (row.n_kept, row.n_kept_without) == (sum(keep), sum(without))
            assert row.n_alone == sum(new and not old for old, new in zip(keep, without))
    by = {(row.source, row.rule): row.n_failed for row in quality.ablations(found, policy, by=["source"]).collect()}
    assert len(by) == 6 and sum(by.values()) == sum(row.n_failed for row in quality.ablations(found, policy).collect())
    told = {row.source: (row.any_failed, row.all_failed) for row in quality.failures_by(found, ["source"]).collect()}
    assert told == {None: (7, 0), "s": (128 | 6, 0)}
    with pytest.raises(ValueError):
        quality.ledger(found.selectExpr("doc_id", "'' AS text"), [quality.Rule(0, "a", "true"), quality.Rule(0, "b", "true")])


def test_nothing_runs_in_python(hard_docs):
    plan = quality.kept_documents(hard_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
