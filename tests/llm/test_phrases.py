"""Phrases: tries against sets, counts and cuts against a plain count, odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from listora.llm import phrases
from listora.llm.double_array import DoubleArray


def plain(rows, least, longest=5, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for row in rows:
        lang = "und" if row["lang"] is None else row["lang"]
        text = "".join(ch.lower() if ch.isascii() else ch for ch in row["text"] or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, found in counts.items():
        frequent = {phrase: a for phrase, a in found.items() if a >= least}
        inside = Counter()
        for phrase, a in frequent.items():
            for size in range(2, len(phrase)):
                for i in range(len(phrase) - size + 1):
                    inside[phrase[i : i + size]] = max(inside[phrase[i : i + size]], a)
        told = []
        for phrase, a in frequent.items():
            if len(phrase) < 2 or 100 * inside[phrase] >= 100 * a:
                continue
            cuts = [(1000 * a * totals[lang] // (found[phrase[:k]] * found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            told.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(told)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_trie_against_a_set():
    rng = np.random.default_rng(3)
    for depth in (2, 3, 5):
        words = rng.integers(0, 1 << 63, 30).astype(np.uint64)
        rows = np.unique(words[rng.integers(0, 30, (400, depth)) ** 2 // 30], axis=0)
        trie = DoubleArray.of(DoubleArray(rows).arrays())
        text = words[rng.integers(0, 30, 5000) ** 2 // 30]
        text = np.where(rng.random(5000) < 0.1, np.uint64(7), text)  # a word no phrase has
        at, state = trie.walk(trie.symbols(text))
        got = {int(i): tuple(trie.phrases[trie.phrase_of[s]]) for i, s in zip(at, state)}
        known = {tuple(row) for row in rows}
        wanted = {i: tuple(text[i : i + depth]) for i in range(5000 - depth + 1) if tuple(text[i : i + depth]) in known}
        assert got == wanted
    none = DoubleArray(np.empty((0, 3), np.uint64))
    assert not len(none.walk(none.symbols(text))[0])


@pytest.mark.parametrize("shard", [200_000, 3])
def test_against_a_plain_count(rows_of, shard):
    rng = random.Random(5)
    words = ["a", "b", "a", "C", "c", "É", "é", "zz", "x\x0by", "and,", "tail.", "q\tq", "=!="]
    rows = [
        {"doc_id": i, "lang": rng.choice(["en", "en", "de", None, "und"]), "text": " ".join(rng.choice(words) for _ in range(rng.randint(0, 60))), "phrase": "p", "n": 1}
        for i in range(150)
    ]
    rows += [{"doc_id": 1, "lang": "en", "text": None}, {"doc_id": None, "lang": "fr", "text": ""}, {"doc_id": 2, "lang": "fr", "text": "lorem ipsum dolor " * 20000}]
    rows += rows[:20]
    docs = rows_of(rows, "doc_id long, lang string, text string, phrase string, n int")
    got = phrases.collocations(docs, least=12, shard=shard)
    assert sorted(map(tuple, got.collect())) == plain(rows, 12)


def test_report_is_cut_at_its_length(rows_of):
    rows = [{"lang": "en", "text": "a b c d. b c. c d e; a b"}] * 4
    docs = rows_of(rows, "lang string, text string")
    assert sorted(map(tuple, phrases.collocations(docs, least=4, top=3).collect())) == plain(rows, 4, top=3)


def test_products_beyond_64_bits(spark):
    big = 10**12
    found = spark.createDataFrame([([1, 2], "en", big)], "phrase array<long>, lang string, a long")
    parts = spark.createDataFrame([([1], big), ([2], big + 7)], "phrase array<long>, n long")
    totals = spark.createDataFrame([("en", 9 * 10**13)], "lang string, n long")
    assert phrases._scored(found, parts, totals).first().score == 1000 * big * 9 * 10**13 // (big * (big + 7))


def test_no_rows(hard_docs):
    assert phrases.collocations(hard_docs.where("false")).count() == 0
    assert phrases.collocations(hard_docs, least=10**9).count() == 0
