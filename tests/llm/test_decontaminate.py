"""Leaks against alignment of every window with every document."""

import random

import numpy as np
import pytest

from listora.llm import decontaminate as de


def least_edits(pattern, text):
    """Edits from the pattern to the best stretch of the text, by the whole table."""
    row = np.zeros(len(text) + 1, dtype=int)
    for i, symbol in enumerate(pattern, 1):
        best = np.minimum(row[:-1] + (text != symbol), row[1:] + 1)
        row = np.concatenate(([i], best))
        across = np.arange(len(row))
        row = np.minimum.accumulate(row - across) + across
    return int(row.min())


def brute(docs, items):
    out = {}
    for doc_id, text in docs:
        symbols = de.normal(text or "")
        for item_id, item in items:
            whole = de.normal(item or "")
            for at in de.cut_windows(whole):
                window = whole[at : at + de.WINDOW]
                edits = least_edits(window, symbols)
                if edits <= de.budget(len(window)):
                    out.setdefault((doc_id, item_id), {})[at] = edits
    return sorted(((*key, len(found), min(found.values())) for key, found in out.items()), key=str)


def changed(text, edits, rng):
    chars = list(text)
    for _ in range(edits):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("etaoin")
        elif kind == 1:
            chars.insert(at, rng.choice("etaoin"))
        else:
            del chars[at]
    return "".join(chars)


@pytest.fixture(scope="module")
def made(spark, sf_dir):
    rng = random.Random(11)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()][:12]
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(30).collect()]
    docs = []
    for i, text in enumerate(texts):
        item = items[i % len(items)][1]
        low = rng.randrange(max(1, len(item) - 120))
        piece = item[low : low + rng.choice((30, 70, 90, 140, 400))]
        piece = changed(piece, rng.choice((0, 0, 3, 6, 9, 12, 20)), rng)
        piece = rng.choice((piece, piece.upper(), piece.replace(" ", " \n"), piece.replace(" ", "!! ")))
        docs.append((i, text[:700] + " " + piece + " " + text[700:1200]))
    docs += [(50, None), (51, ""), (None, docs[0][1]), (0, docs[0][1]), (52, items[0][1]), (53, items[0][1] * 3)]
    items += [(90, None), (91, ""), (92, "too short"), (93, items[0][1]), (None, items[1][1]), (94, "x" * 200), (95, "just over thirty characters of it")]
    docs += [(54, "y" + "x" * 500), (55, "Just over thirty, characters of it!")]
    return docs, items


@pytest.mark.parametrize("block", [16_384, 20])
def test_leaks_equal_alignment_of_everything(rows_of, made, monkeypatch, block):
    monkeypatch.setattr(de, "BLOCK", block)
    docs, items = made
    found = de.leaks(
        rows_of([{"doc_id": a, "text": b, "item_id": 1} for a, b in docs], "doc_id long, text string, item_id long"),
        rows_of([{"item_id": a, "text": b} for a, b in items], "item_id long, text string"),
    ).collect()
    wanted = brute(docs, items)
    assert len(wanted) > 20
    assert sorted(((r.doc_id, r.item_id, r.n_windows, r.edits) for r in found), key=str) == wanted


def test_clean_rows_stay(rows_of, made):
    docs, items = made
    table = rows_of([{"doc_id": a, "text": b, "key": "k"} for a, b in docs], "doc_id long, text string, key string")
    bench = rows_of([{"item_id": a, "text": b} for a, b in items], "item_id long, text string")
    left = de.decontaminated(table, bench)
    dirty = {(row[0], text) for row in brute(docs, items) for doc_id, text in docs if doc_id == row[0]}
    assert left.schema == table.schema
    assert sorted(left.select("doc_id", "text").collect(), key=str) == sorted([x for x in docs if x not in dirty], key=str)


def test_empty_tables(rows_of, made):
    docs = rows_of([{"doc_id": 1, "text": "a"}], "doc_id long, text string")
    none = rows_of([], "item_id long, text string")
    assert de.leaks(docs, none).count() == 0 and de.decontaminated(docs, none).count() == 1
    bench = rows_of([{"item_id": a, "text": b} for a, b in made[1]], "item_id long, text string")
    assert de.leaks(docs.where("false"), bench).count() == 0


@pytest.mark.parametrize("length", [24, 31, 40, 79, 80])
def test_budget_leaves_a_bound(length):
    edits = de.budget(length)
    assert 0 <= edits <= length * de.EDITS
    assert length + 1 - (edits + 1) * de.GRAM >= 1


def test_passages_at_every_offset(rows_of):
    """Passages of the stated least length, wherever in a longer item they begin, and short items as whole words."""
    rng = random.Random(5)
    item = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(60))[:300].strip()
    around = [" ".join("".join(rng.choice("qrstuvwxyz") for _ in range(5)) for _ in range(20)) for _ in range(2)]
    passages = [item[at : at + 80] for at in range(len(item) - 79)]
    passages += [changed(item[at : at + 80], 8, rng) for at in range(len(item) - 79)]
    docs = [(i, f"{around[0]} {passage} {around[1]}") for i, passage in enumerate(passages)]
    docs += [(1000, around[0]), (1001, "So it was a Gray, cat!"), (1002, "stray cattle"), (1003, "gray"), (1004, "a gray cat")]
    rows = rows_of([{"doc_id": a, "text": b} for a, b in docs], "doc_id long, text string")
    bench = rows_of([{"item_id": 1, "text": item}, {"item_id": 2, "text": "gray cat"}, {"item_id": 3, "text": "ray"}], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in de.leaks(rows, bench).collect()}
    assert found == {(i, 1) for i in range(len(passages))} | {(1001, 2), (1004, 2)}
    assert {r.doc_id for r in de.decontaminated(rows, bench).collect()} == {1000, 1002, 1003}


@pytest.mark.parametrize("length", [0, 1, 79, 80, 81, 142, 143, 144, 145, 207, 208, 500])
def test_segments_hold_every_window_once(length):
    symbols = np.arange(length, dtype=np.uint32)
    parts = list(de.cut_segments(symbols))
    assert [at + i for at, part in parts for i in de.cut_windows(part)] == de.cut_windows(symbols)
    assert all(np.array_equal(part, symbols[at : at + len(part)]) and len(part) <= de.SEGMENT for at, part in parts)
