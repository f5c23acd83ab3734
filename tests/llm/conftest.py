import os
import random

import pytest


@pytest.fixture(scope="session")
def rng():
    return random.Random(7)


@pytest.fixture(scope="session")
def rows_of(spark):
    """A table of rows (dictionaries) with a schema, in a few partitions."""

    def make(rows, schema):
        names = [part.strip().split(" ")[0] for part in schema.split(",")]
        return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], schema)

    return make


@pytest.fixture(scope="session")
def sample_texts(sf_dir):
    import pyarrow.parquet as pq

    return pq.read_table(os.path.join(sf_dir, "documents.parquet"))["text"].to_pylist()


HARD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "word",
    "A b\tc d\x0be",
    "Ünï çödé — “quotes” … 中文字符 😀👍🏽 x́y",
    "don't I'VE it's!! <|endoftext|> </s> <s> [INST] ok [/INST] ▁▁ a▁b  c",
    "the same five words again the same five words again the same five words again",
    "x" * 5000,
    "lorem ipsum " * 4000,
]


@pytest.fixture(scope="session")
def hard_docs(rows_of):
    """Nulls, empty, long and repeated texts, ties, and columns whose names clash with the operators' own."""
    texts = [*HARD_TEXTS, *HARD_TEXTS[4:], "the same five words again, but then another end of it altogether here"]
    rows = [{"doc_id": i if i % 7 else None, "text": text, "lang": "en" if i % 3 else None, "kept": "k", "score": 1} for i, text in enumerate(texts)]
    rows += [dict(rows[5]), dict(rows[5]), dict(rows[9])]
    return rows_of(rows, "doc_id long, text string, lang string, kept string, score int, key string, component_id long, spans string, n_chars long")

