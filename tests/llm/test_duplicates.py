"""Near-duplicates, links and repeated passages against plain versions."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from listora.llm import near_dedup, substring_dedup
from listora.llm.hashing import words
from listora.llm.links import components
from listora.llm.superminhash import signatures

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def found_words(text, fold=False):
    data = (text or "").encode()
    return WORD.findall(data.translate(FOLD) if fold else data)


def shingles(text):
    found = found_words(text, fold=True)
    if not found:
        return set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)} or {tuple(found)}


def made_texts(n=120, seed=3):
    """Groups of near copies with one to many changed words, chains, and passages in common."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda size: [rng.choice(vocabulary) for _ in range(size)]
    passage, out = text(60), []
    while len(out) < n:
        base = text(rng.randint(20, 200))
        for changes in range(rng.randint(1, 8)):
            copy = list(base)
            for _ in range(changes):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                at = rng.randrange(len(copy))
                copy[at:at] = passage
            if rng.random() < 0.3:
                base = copy  # the next one drifts on from this one
            out.append(" ".join(copy))
    rng.shuffle(out)
    return out


def brute_components(texts):
    sets = [shingles(text) for text in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))], [len(x) for x in sets]


def test_words_and_hashes():
    texts = [None, "", "  ", "a", " A\tb\x0bc ", "é x y", "tail", "A b"]
    found = words(pa.array(texts, pa.string()), lower=True)
    assert found.counts.tolist() == [len(found_words(t)) for t in texts]
    spans = [bytes(found.data[a:b]) for a, b in zip(found.starts, found.ends, strict=True)]
    assert spans == [w for t in texts for w in found_words(t)]
    named = {}
    for span, value in zip(spans, found.hashes, strict=True):
        assert named.setdefault(span.translate(FOLD), value) == value
    assert len(set(named.values())) == len(named)


def test_long_words_cross_pieces(monkeypatch):
    import listora.llm.hashing as hashing

    texts = ["ab " * 50, "x" * 333, "ab " + "x" * 333 + " ab"]
    whole = words(pa.array(texts, pa.string()))
    monkeypatch.setattr(hashing, "_PIECE", 64)
    cut = words(pa.array(texts, pa.string()))
    assert whole.counts.tolist() == cut.counts.tolist() == [50, 1, 3]
    for found in (whole, cut):
        assert found.hashes[50] == found.hashes[52] and found.hashes[51] == found.hashes[53] == found.hashes[0]


@pytest.mark.parametrize("share", [0.5, 0.85, 1.0])
def test_superminhash_estimates_similarity(share):
    rng = np.random.default_rng(5)
    found = []
    for _ in range(30):
        both = rng.integers(1 << 63, size=int(300 * share), dtype=np.uint64)
        rest = rng.integers(1 << 63, size=2 * (300 - len(both)), dtype=np.uint64)
        a = np.concatenate((both, rest[: len(rest) // 2]))
        b = np.concatenate((both, rest[len(rest) // 2 :]))
        rows = signatures(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 128)
        found.append((rows[0] == rows[1]).mean() - len(both) / (len(a) + len(b) - len(both)))
    assert abs(np.mean(found)) < 0.02
    assert np.std(found) < 0.05


def test_signature_does_not_depend_on_blocks(monkeypatch):
    import listora.llm.superminhash as superminhash

    elements = np.random.default_rng(1).integers(1 << 63, size=5000, dtype=np.uint64)
    first = np.array([0, 3, 3, 700, 5000])
    whole = signatures(elements, first, 64)
    monkeypatch.setattr(superminhash, "_CELLS", 6400)
    assert (whole == signatures(elements, first, 64)).all()
    assert np.isinf(whole[1]).all()


def test_components(rows_of):
    links = [(i, i + 1) for i in range(30)] + [(100, 50), (50, 100), (7, 7), (200, 201), (201, 202), (203, 202), (None, 3)]
    found = dict(components(rows_of([{"a": a, "b": b} for a, b in links], "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(31))
    assert found[50] == found[100] == 50 and {found[i] for i in range(200, 204)} == {200}
    assert components(rows_of([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [1024, 3])
def test_near_duplicates_equal_all_pairs(rows_of, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = made_texts()
    wanted, sizes = brute_components(texts)
    docs = rows_of([{"doc_id": i, "text": text} for i, text in enumerate(texts)], "doc_id long, text string")
    found = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id, r.n_shingles, r.kept) for r in found) == [
        (i, wanted[i], sizes[i], wanted[i] == i) for i in range(len(texts))
    ]


def test_near_duplicates_hard_rows(hard_docs):
    rows = near_dedup.near_duplicates(hard_docs).collect()
    source = hard_docs.collect()
    assert len(rows) == len(source)
    assert sorted(r.n_shingles for r in rows) == sorted(len(shingles(r.text)) for r in source)
    for row in rows:
        if row.n_shingles == 0:
            assert row.kept and row.component_id == row.doc_id
    assert near_dedup.near_duplicates(hard_docs.where("false")).count() == 0


def test_one_of_each_group_stays(hard_docs):
    source = hard_docs.collect()
    left = near_dedup.one_of_each(hard_docs)
    assert left.columns == hard_docs.columns
    rows = left.collect()
    without_words = [r for r in source if not shingles(r.text)]
    assert len([r for r in rows if not shingles(r.text)]) == len(without_words)
    texts = sorted({r.text for r in source if shingles(r.text)})
    wanted, _ = brute_components(texts)
    assert len([r for r in rows if shingles(r.text)]) == len(set(wanted))


def brute_removed(rows):
    least = {}
    for doc_id, text in rows:
        found = found_words(text)
        for i in range(len(found) - 12):
            if doc_id is not None:
                window = tuple(found[i : i + 13])
                least[window] = min(least.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        found = found_words(text)
        gone = [False] * len(found)
        for i in range(len(found) - 12):
            if doc_id is not None and least[tuple(found[i : i + 13])] < doc_id:
                gone[i : i + 13] = [True] * 13
        kept = b" ".join(w for w, g in zip(found, gone, strict=True) if not g)
        out.append((doc_id, len(found), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [None, (300, 50)])
def test_repeated_words(rows_of, hard_docs, monkeypatch, sizes):
    if sizes:
        spans = substring_dedup.repeated_spans
        monkeypatch.setattr(substring_dedup, "repeated_spans", lambda docs: spans(docs, *sizes))
    rows = [(i * 3 % 101, text) for i, text in enumerate(made_texts(100, seed=9))]
    rows += [(doc_id, text) for doc_id, text in hard_docs.select("doc_id", "text").collect()]
    docs = rows_of([{"doc_id": a, "text": b} for a, b in rows], "doc_id long, text string")
    found = substring_dedup.repeated_words(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str) == brute_removed(rows)


def test_texts_without_repeats(rows_of, hard_docs):
    rows = [(i, text) for i, text in enumerate(made_texts(60, seed=4))]
    docs = rows_of([{"doc_id": a, "text": b, "n_chars": len(b), "spans": "s"} for a, b in rows], "doc_id long, text string, n_chars long, spans string")
    left = substring_dedup.without_repeats(docs)
    assert left.columns == docs.columns
    got = {r.doc_id: r for r in left.collect()}
    for doc_id, n_words, n_removed, digest in brute_removed(rows):
        if n_removed and n_removed == n_words:
            assert doc_id not in got
        else:
            row = got[doc_id]
            assert hashlib.sha256(b" ".join(found_words(row.text))).hexdigest() == digest
            assert row.n_chars == len(row.text) and (n_removed or row.text == rows[doc_id][1])
    assert substring_dedup.without_repeats(hard_docs).count() > 0
    assert substring_dedup.without_repeats(hard_docs.where("false")).count() == 0
    assert substring_dedup.repeated_words(hard_docs.where("false")).count() == 0


def test_difference_cover():
    for i in range(7):
        for j in range(7):
            assert any((i + d) % 7 in substring_dedup.COVER and (j + d) % 7 in substring_dedup.COVER for d in range(7))
    assert substring_dedup.ANCHOR + substring_dedup.PERIOD - 1 <= substring_dedup.WINDOW


def block_of(same_slots, shorts, sizes):
    """A block of two classes of different groups whose sketches agree in their first slots."""
    left = np.zeros(near_dedup.SLOTS, dtype=np.uint16)
    right = np.where(np.arange(near_dedup.SLOTS) < same_slots, left, left + 1).astype(np.uint16)
    return pd.DataFrame({
        "side": [1, 1], "sketch": [left.tobytes(), right.tobytes()], "short": [x.astype(np.uint32).tobytes() for x in shorts],
        "n": sizes, "group": [b"a", b"b"], "class": [b"a", b"b"], "band": [0, 0],
    })


def test_slots_follow_the_threshold():
    """A pair of similarity 0.80 agrees in 75 to 83 slots more often than links may be lost."""
    assert [near_dedup.agreeing(percent) for percent in (100, 85, 80)] == [128, 84, 75]
    sets = [np.arange(0, 900), np.arange(100, 1000)]
    for slots, wanted in ((74, 0), (75, 1), (83, 1), (84, 1)):
        assert len(near_dedup._alike(80)(block_of(slots, sets, [900, 900]))) == wanted
    assert near_dedup._alike(85)(block_of(83, [sets[0], sets[0]], [900, 900])).empty


def test_pairs_from_80_percent(rows_of):
    rows, wanted = [], []
    for pair in range(40):
        changed = pair % 10 + 18  # of 200 shingles, at the end
        text = [f"p{pair}w{i}" for i in range(204)]
        other = text[: 204 - changed] + [f"{word}x" for word in text[204 - changed :]]
        rows += [{"doc_id": 2 * pair, "text": " ".join(text)}, {"doc_id": 2 * pair + 1, "text": " ".join(other)}]
        alike = 100 * (200 - changed) >= 80 * (200 + changed)
        wanted += [2 * pair] if alike else [2 * pair, 2 * pair + 1]
    left = near_dedup.one_of_each(rows_of(rows, "doc_id long, text string"), percent=80)
    assert sorted(row.doc_id for row in left.collect()) == wanted


def test_short_hashes_lose_no_link_of_large_sets():
    """A pair exactly at the threshold whose short hashes merge dozens of shingles."""
    rng = np.random.default_rng(8)
    elements = np.unique(rng.integers(0, 1 << 63, 510_000, dtype=np.int64).astype(np.uint64) << np.uint64(1))[:500_000]
    rng.shuffle(elements)
    common, extra = elements[:425_000], elements[425_000:]
    sets = [np.sort(np.concatenate([common, extra[:37_500]])), np.sort(np.concatenate([common, extra[37_500:]]))]
    batch = pa.record_batch({"class": pa.array([b"a", b"b"]), "sketch": pa.array([bytes(256)] * 2), "elements": pa.array([x.tobytes() for x in sets])})
    rows = pa.Table.from_batches(near_dedup._shortened(iter([batch]))).to_pandas()
    assert (rows["n"] - [len(x) // 4 for x in rows["short"]]).min() > 2
    block = rows.assign(key=b"k", band=0, i=0, j=0, group=[b"a", b"b"], side=1)
    assert near_dedup._alike(85)(block).values.tolist() == [[b"a", b"b"]]
