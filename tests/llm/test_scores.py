"""Context-tree scores against a direct tree, base scores against counts, and odd rows."""

import collections
import math
import zlib

import numpy as np
import pytest

from listora.llm import context_tree as tree
from listora.llm import lm_score


class DirectTree:
    """The same mixture, node by node."""

    def __init__(self, depth):
        self.depth, self.nodes = depth, collections.defaultdict(lambda: [0, 0])

    def train(self, data):
        for at in range(self.depth, len(data)):
            for bit in range(8):
                value = data[at] >> 7 - bit & 1
                for length in range(self.depth + 1):
                    self.nodes[data[at - length : at], bit, data[at] >> 8 - bit][value] += 1
        self.children = collections.defaultdict(list)
        for context, bit, prefix in self.nodes:
            if context:
                self.children[context[1:], bit, prefix].append((context, bit, prefix))
        self.logs = {}
        for key in sorted(self.nodes, key=lambda key: -len(key[0])):
            zeros, ones = self.nodes[key]
            estimate = math.lgamma(zeros + 0.5) + math.lgamma(ones + 0.5) - math.log(math.pi) - math.lgamma(zeros + ones + 1)
            below = sum(self.logs[child][1] for child in self.children[key]) if len(key[0]) < self.depth else None
            weighted = estimate if below is None else np.logaddexp(estimate, below) - math.log(2)
            self.logs[key] = estimate, weighted, below

    def log10(self, data, at):
        total = 0.0
        for bit in range(8):
            value, chance = data[at] >> 7 - bit & 1, 0.5
            for length in range(self.depth, -1, -1):
                key = (data[at - length : at], bit, data[at] >> 8 - bit)
                if key in self.logs:
                    counts, (estimate, _, below) = self.nodes[key], self.logs[key]
                    direct = (counts[value] + 0.5) / (sum(counts) + 1)
                    odds = math.inf if below is None else math.exp(estimate - below)
                    chance = direct if below is None else (odds * direct + chance) / (odds + 1)
            total += math.log10(chance)
        return total


TRAINING = ["the cat sat on the mat", "The dog sat on the log. The cat", "a cat and a dog", "", None, "é è the", "zzzz " * 40]
SCORED = ["the cat sat", "a dog sat on a cat", "unseen words qqq", "", "É the"]


def test_scores_equal_a_direct_tree(rows_of):
    direct = DirectTree(tree.DEPTH)
    training = [text for i, text in enumerate(TRAINING * 2) if zlib.crc32(str(i).encode()) % 7 != 2]
    rows = [{"doc_id": i, "text": text} for i, text in enumerate(TRAINING * 2)]
    held = [i for i in range(100, 400) if zlib.crc32(str(i).encode()) % 7 == 2][: len(SCORED)]
    rows += [{"doc_id": i, "text": text} for i, text in zip(held, SCORED, strict=True)]
    found = {r.doc_id: r for r in lm_score.scores(rows_of(rows, "doc_id long, text string")).collect()}
    counted = DirectTree(tree.DEPTH)
    # texts are trained one after the other, each after its own context of end signs
    for text in training:
        data = lm_score.byte_sequence((text or "").encode())
        for at in range(tree.DEPTH, len(data)):
            for bit in range(8):
                for length in range(tree.DEPTH + 1):
                    counted.nodes[data[at - length : at], bit, data[at] >> 8 - bit][data[at] >> 7 - bit & 1] += 1
    direct.nodes = counted.nodes
    direct.train(b"")
    words = collections.Counter(w for text in training for w in lm_score.byte_sequence((text or "").encode())[5:-1].split() + [b"\n"])
    n, v = sum(words.values()), len(words)
    for i, text in zip(held, SCORED, strict=True):
        data = lm_score.byte_sequence(text.encode())
        assert found[i].held_out and found[i].train_tokens == n
        assert found[i].score == pytest.approx(sum(direct.log10(data, at) for at in range(tree.DEPTH, len(data))), rel=1e-5)
        tokens = data[5:-1].split() + [b"\n"]
        assert found[i].n_tokens == len(tokens) and found[i].n_known == sum(words[t] > 0 for t in tokens)
        assert found[i].base_score == pytest.approx(sum(math.log10((words[t] + 1) / (n + v + 1)) for t in tokens))


def test_tree_is_a_distribution():
    data = np.frombuffer(lm_score.byte_sequence(b"abracadabra the cat the mat"), dtype=np.uint8)
    keys, counts = np.unique(tree.keys_of(data), return_counts=True)
    levels, above = tree.grow(keys, counts, tree.DEPTH, tree.SPLIT)
    rows = [(bit, int(k), a, b, c) for bit, x in enumerate(above) for k, a, b, c in zip(*x, strict=True)]
    tops = tree.top_levels(rows, tree.SPLIT - 1)
    for context in (keys[3] >> np.uint64(8), np.uint64(0x6161616161), keys[7] >> np.uint64(8)):
        every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert np.power(10, tree.log10_probability(every, levels + tops)).sum() == pytest.approx(1)


def test_batches_buckets_and_shards_change_nothing(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    whole = {r.doc_id: r for r in lm_score.scores(docs).collect()}
    monkeypatch.setattr(lm_score, "BATCH_BYTES", 1 << 14)
    monkeypatch.setattr(lm_score, "SHARD", 2)
    for row in lm_score.scores(docs).collect():
        assert row.score == pytest.approx(whole[row.doc_id].score, rel=1e-6)
        assert row.base_score == pytest.approx(whole[row.doc_id].base_score)


def test_held_out_text_costs_less_than_base(spark, sf_dir):
    rows = [r for r in lm_score.scores(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect() if r.held_out]
    assert sum(r.score for r in rows) / sum(r.n_tokens for r in rows) > -6
    assert 0 < sum(r.bits_per_byte for r in rows) / len(rows) < 4


def test_hard_rows(hard_docs):
    rows = lm_score.scores(hard_docs).collect()
    assert len(rows) == hard_docs.count()
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert lm_score.scores(hard_docs.where("false")).count() == 0
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 == 2][:2]
    untrained = lm_score.scores(hard_docs.limit(2).selectExpr(f"{held[0]}L AS doc_id", "'ab' AS text")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == pytest.approx(24 * math.log10(0.5)) for r in untrained)
