"""Token counts by the whole-token shortcut.

A text falls into pre-tokens: a run of spaces with what follows up to the next space. Before any text is read, the
vocabulary is searched for proof that no merge crosses a pre-token's border or a line feed, and every vocabulary string
that starts with one space is encoded alone: those that come out as one token are the proven whole tokens. Pre-tokens
among them count as one without any merging; the rest are merged by the library, each distinct one once per worker while
it is remembered.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listora.llm.arrow_batches import pieces

SPACE = "▁"  # how the vocabulary writes a space
REMEMBERED = 400_000  # pre-tokens a worker remembers
LONGEST_REMEMBERED = 48  # characters

_RUNS = re.compile(f"[ {SPACE}]+[^ {SPACE}]*")
# Strings a normaliser other than the plain one would change.
_PROBES = ("a  b ", "Ａ①ﬁ", "İ Å é", "\t x　y z")


class PieceCounter(dict):
    """Tokens of pre-tokens, each without its first space; proven whole tokens are there from the start."""

    def __init__(self, model_file: str):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.proven = proven_whole_tokens(self.model)
        self.line_feed = self._line_feed()
        self.after_line = {}
        self.update(self.proven)

    def _line_feed(self) -> int:
        """Tokens of a space and a line feed together."""
        return len(self.model.encode("\n", num_threads=1))

    def __missing__(self, rest: str) -> int:
        if "\n" in rest:
            start, *lines = rest.split("\n")
            return (self[start] if start else 1) + sum(map(self._line, lines))
        count = len(self.model.encode(rest, num_threads=1)) if rest else 1
        if len(rest) <= LONGEST_REMEMBERED:
            if len(self) > REMEMBERED:
                self.clear()
                self.update(self.proven)
            self[rest] = count
        return count

    def _line(self, start: str) -> int:
        """Tokens of a line feed and what follows it."""
        count = self.after_line.get(start)
        if count is None:
            count = len(self.model.encode("\n" + start, num_threads=1)) - 1
            if len(start) <= LONGEST_REMEMBERED:
                if len(self.after_line) > REMEMBERED // 4:
                    self.after_line.clear()
                self.after_line[start] = count
        return count

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
            return sum(self[run[1:]] for run in _RUNS.findall(" " + text))
        return sum(map(self.__getitem__, text.split(" ")))


def proven_whole_tokens(model: sentencepiece.SentencePieceProcessor) -> dict[str, int]:
    """Vocabulary strings (without their first space) that encode alone as one token, each with the count 1.

    Raises ValueError if the vocabulary or the normaliser would let a merge cross a pre-token's border or a line feed,
    or a lone space is no token: then counts of pre-tokens would not add up to the text's.
    """
    for probe in _PROBES:
        if model.normalize(probe) != (SPACE + probe).replace(" ", SPACE):
            raise ValueError("the model's normaliser changes more than spaces")
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    for piece in plain:
        if SPACE in piece.lstrip(SPACE) or "\n" in piece:
            raise ValueError(f"the vocabulary string {piece!r} crosses a border")
    if SPACE not in plain:
        raise ValueError("a lone space is no token of this vocabulary")
    starts = [piece[1:] for piece in plain if piece[0] == SPACE and len(piece) > 1 and piece[1] != SPACE]
    ids = model.encode(starts, num_threads=1)
    return {start: 1 for start, found in zip(starts, ids, strict=True) if len(found) == 1}


@functools.lru_cache(maxsize=4)
def _counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def _counted(model_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model_file)
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text")
                counts = [counter.count(text.as_py() or "") for text in texts]
                n_bytes = pa.compute.binary_length(texts).cast(pa.int64()).fill_null(0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), n_bytes, pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
                )

    return run


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit) of every whole text.

    Counts are those of the library's encode() with its defaults: no begin or end token, strings of special tokens in a
    text are plain text. Null and empty texts have 0 bytes and 0 tokens. One row out for each row in, repeated or not, in
    one pass without a shuffle; a null doc_id stays null. Other columns are left out. An empty table gives no rows.
    """
    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _counted(model_file), "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
