"""Spelling variants: tiles against all pairs, forms and roots against a plain walk, odd rows."""

import random
import zlib
from collections import Counter
import re

from listora.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(longer[:i] + longer[i + 1 :] == shorter for i in range(len(longer)))


def plain(counts, times=5):
    out = {}
    for word, n in counts.items():
        near = sorted((-m, other) for other, m in counts.items() if one_edit(word, other))
        form = near[0] if near and -near[0][0] >= times * n else None
        out[word] = [form and form[1], n, len(near), form and -form[0]]
    for word, row in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        row.append(root)
    return out


def told(df):
    return {r.word: [r.form, r.n, r.n_near, r.form_n, r.root] for r in df.collect()}


def vocabulary(rng, n, letters="abcé", low=1, high=9):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(low, high))) for _ in range(n)}
    return {word: rng.choice([1, 2, 3, 5, 5, 10, 25, 26, 125, 700]) for word in words}


def test_variants_against_all_pairs(spark):
    counts = vocabulary(random.Random(1), 500)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert told(spelling.spelling_variants(df)) == plain(counts)


def test_large_tiles_are_dealt_anew(spark, monkeypatch):
    """Tiles far above the limit: by single positions, then in blocks."""
    monkeypatch.setattr(spelling, "TILE", 8)
    counts = {f"pre{a}{b}fix": rng_n for rng_n, (a, b) in enumerate(((a, b) for a in "abcdefghij" for b in "abcdefghijk"), 1)}
    counts |= vocabulary(random.Random(2), 150, "ab", 4, 8)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [(r.word, r.near) for r in spelling.near_words(df).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in counts for b in counts if one_edit(a, b)}


def test_long_words(spark):
    long = "é" * 300
    counts = {long: 50, long + "x": 5, "y" + long: 5, long[:-1]: 5, "z" * 299: 5, "𝄞" * 7: 6, "𝄞" * 6: 30}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert told(spelling.spelling_variants(df)) == plain(counts)


def test_words_of_texts(spark, rows_of):
    texts = ["Hopeful hopefull HOPEFUL hopeful, Ärgerlich ärgerlich café_cafeteria x1kleinlaut", None, "", "hopeful " * 30000, "a" * 40]
    rows = [{"doc_id": i, "text": texts[i % len(texts)], "word": "w", "n": 1, "_id": "q"} for i in range(600)]
    rows += [{"doc_id": None, "text": "hopeful"}] * 3
    docs = rows_of(rows, "doc_id long, text string, word string, n int, _id string")
    wanted = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row["text"] or ""):
            run = "".join(ch.lower() if ch.isascii() else ch for ch in run)
            check = zlib.crc32(f"{row['doc_id']}:{run}".encode()) if row["doc_id"] is not None else 1
            if check % 199 == 0:
                run = run[: check % len(run)] + run[check % len(run) + 1 :]
            if len(run) >= 6:
                wanted[run] += 1
    assert {r.word: r.n for r in spelling.word_counts(docs).collect()} == wanted
    whole = spelling.word_counts(docs, deleting=None)
    assert {r.word for r in whole.collect()} == {"hopeful", "hopefull", "Ärgerlich", "ärgerlich", "cafeteria", "kleinlaut", "a" * 40}
    frequent = {word: n for word, n in wanted.items() if n >= 5}
    assert told(spelling.variants(docs)) == plain(frequent)


def test_no_words(hard_docs):
    assert spelling.variants(hard_docs.where("false")).count() == 0
    assert spelling.variants(hard_docs, least_count=10**9).count() == 0
    assert {r.word for r in spelling.variants(hard_docs, deleting=None).collect()} >= {"dolor"} - {"dolor"}
