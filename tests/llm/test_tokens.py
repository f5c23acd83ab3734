"""Token counts and packing against the tokenizer libraries on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from listora.llm import packing, token_counts
from listora.llm.token_counts import PieceCounter

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
SPACES = ["", " ", "  ", "\n", "\n\n a", " \n", "a \n b", "▁", "▁▁a", "a▁ b", "a  b   c    d", "x ", "\tx\r\n", "a\n b\n\nc", "<0x0A> <unk>"]


def library_ids(text):
    return Tokenizer.from_file(WORD_BPE).encode(text or "", add_special_tokens=False).ids + [2]


def test_counts_equal_the_library(sample_texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = [text or "" for text in sample_texts] + SPACES
    counter = PieceCounter(MODEL)
    assert [counter.count(text) for text in texts] == [len(ids) for ids in model.encode(texts, num_threads=1)]


def test_proven_tokens_are_single(sample_texts):
    counter = PieceCounter(MODEL)
    assert len(counter.proven) > 10_000
    assert all(len(counter.model.encode(piece)) == 1 for piece in list(counter.proven)[::50])


def test_counts_survive_forgetting(sample_texts, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", len(PieceCounter(MODEL).proven) + 50)
    counter = PieceCounter(MODEL)
    texts = [text or "" for text in sample_texts[:60]]
    assert [counter.count(text) for text in texts] == [len(ids) for ids in counter.model.encode(texts, num_threads=1)]


def test_count_rows(hard_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = token_counts.token_counts(hard_docs, MODEL, limit=100).collect()
    wanted = [(row.doc_id, len((row.text or "").encode()), len(model.encode(row.text or ""))) for row in hard_docs.collect()]
    key = lambda row: (row[0] is None, row)
    assert sorted([tuple(row[:3]) for row in rows], key=str) == sorted(wanted, key=str)
    assert all(row.over_limit == (row.n_tokens > 100) for row in rows) and key


def test_empty_table(hard_docs):
    none = hard_docs.where("false")
    assert token_counts.token_counts(none, MODEL).count() == 0
    assert packing.packed(none, WORD_BPE).count() == 0


def test_pieces_hold_each_token_once(hard_docs):
    rows = packing.packed(hard_docs, WORD_BPE, end_id=2, longest=64).collect()
    assert len({row.sequence_id for row in rows}) == len(rows)
    assert all(row.offset == 0 and row.length == 1 << row.bucket <= 64 for row in rows)
    texts = {}
    for row in hard_docs.collect():
        texts.setdefault(row.doc_id, []).append(library_ids(row.text))
    for doc_id, ids in texts.items():
        own = sorted((row for row in rows if row.doc_id == doc_id), key=lambda row: row.sequence_id)
        joined, found = [], []
        for row in own:
            if row.start == 0:
                joined.append([])
            assert row.start == len(joined[-1])
            joined[-1] += row.ids
            found.append(zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32)
        assert sorted(joined) == sorted(ids) and all(found)


@pytest.mark.parametrize("count", [1, 2, 63, 64, 65, 4095, 4096, 4097, 100_000])
def test_powers(count):
    lengths = packing.powers(count)
    assert sum(lengths) == count and lengths == sorted(lengths, reverse=True)
    assert all(n & (n - 1) == 0 and n <= 4096 for n in lengths)
    rest = [n for n in lengths if n < 4096]
    assert len(rest) == len(set(rest))


def test_words_encode_as_in_their_text(sample_texts, monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 500)
    known = packing.WordIds(WORD_BPE)
    texts = [text or "" for text in sample_texts[:80]]
    texts += ["a×, ÷. é. ñ! a…. “x”, x’s. DON'T. O'Neil's! A<|ENDOFTEXT|>", "<|endoftext|> Foo.BAR,baz;;; 3.14 x²! ﬁ İx ß Σας."]
    tokenizer = Tokenizer.from_file(WORD_BPE)
    for low in range(0, len(texts), 10):
        docs = [known.words(text) for text in texts[low : low + 10]]
        known.learn(set().union(*docs))
        for text, doc in zip(texts[low : low + 10], docs, strict=True):
            ids = np.frombuffer(b"".join(known[word] for word in doc), "<u4").tolist()
            assert ids == tokenizer.encode(text, add_special_tokens=False).ids
