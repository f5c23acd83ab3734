"""Packing by power-of-two decomposition.

A document of n tokens is cut into pieces whose lengths are powers of two, no longer than the longest sequence: as many
longest pieces as fit, then one piece for each binary digit of the rest, longest first. Every piece is a sequence of its
own, so no sequence crosses documents and none is padded; sequences of one length form a bucket, which is trained on
together.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listora.llm.arrow_batches import pieces

LONGEST = 4096
REMEMBERED = 200_000  # words a worker remembers, and as many from before

# Where a letter or digit of Basic Latin, or a letter up to U+024F (all of them but the two signs among them), meets an
# ASCII sign, a pre-token ends. The apostrophe is left out, since contractions are split in another way.
_SIGNS = re.escape(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')
_BORDER = re.compile(
    rb"[" + _SIGNS + rb"](?:(?<=[a-zA-Z0-9].)|(?<=[\xc3-\xc9][\x80-\xbf].)(?<!\xc3\x97.)(?<!\xc3\xb7.))", re.DOTALL
)
_SPECIAL = b"<|"  # strings of special tokens begin with it
_LATIN_END = "\u0250"  # below it letters are composed, and no case change adds characters but for the dotted capital I


def _byte_characters() -> dict[int, str]:
    """Characters a byte-level vocabulary writes bytes as: printable ones as they are, the rest from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [byte for byte in range(256) if byte not in printable]
    return {byte: chr(byte) for byte in printable} | {byte: chr(0x100 + i) for i, byte in enumerate(rest)}


_BYTE_CHARACTERS = _byte_characters()


class WordIds(dict):
    """Token ids of words, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and no pre-token, and no composed character, spans any, so a text's ids are those of
    its words one after the other. Texts are folded where the tokenizer folds, and signs after a letter or digit are taken
    as words of their own, as the tokenizer does, so that fewer distinct words have to be merged. Words a batch does not
    know are encoded together, plain Latin letters straight by the library's merge model. What a worker remembers is
    bounded; what it has used since the bound was last reached stays.
    """

    def __init__(self, tokenizer_file: str):
        super().__init__()
        self.before: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.folds = self._whole([b"A"]) == self._whole([b"a"])
        probes = [b"a", "étude".encode(), "großväter".encode(), "ciónñ".encode(), b"antidisestablishmentarianism"]
        self.straight = self.folds and [self._merged(x) for x in probes] == self._whole(probes)

    def _whole(self, words: list[bytes]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)
        return [struct.pack(f"<{len(x)}I", *x.ids) for x in found]

    def _merged(self, letters: bytes) -> bytes:
        found = self.tokenizer.model.tokenize(letters.decode("latin-1").translate(_BYTE_CHARACTERS))
        return struct.pack(f"<{len(found)}I", *[token.id for token in found])

    def _ids(self, words: list[bytes]) -> dict[bytes, bytes]:
        found, others = {}, []
        for word in words:
            if self.straight:
                letters = word.decode()
                low = letters.lower()
                if letters.isalpha() and len(low) == len(letters) and max(low) < _LATIN_END:
                    found[word] = self._merged(low.encode())
                    continue
            others.append(word)
        found.update(zip(others, self._whole(others), strict=True))
        return found

    def words(self, text: str) -> list[bytes]:
        data = text.encode()
        if _SPECIAL in data:
            return data.split()
        return _BORDER.sub(rb" \g<0>", data.lower() if self.folds else data).split()

    def learn(self, words: set[bytes]) -> None:
        """Makes all these words known."""
        if len(self) > REMEMBERED:
            self.before = dict(self)
            self.clear()
        new = words - self.keys()
        if self.before:
            again = new & self.before.keys()
            self.update((word, self.before[word]) for word in again)
            new -= again
        self.update(self._ids(list(new)))


@functools.lru_cache(maxsize=4)
def _word_ids(tokenizer_file: str) -> WordIds:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return WordIds(tokenizer_file)


def powers(count: int, longest: int = LONGEST) -> list[int]:
    """Lengths of the pieces of a document of `count` tokens, longest first."""
    whole, rest = divmod(count, longest)
    return [longest] * whole + [1 << bit for bit in range(longest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def _packed(tokenizer_file: str, end_id: int, longest: int, with_ids: bool):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _word_ids(tokenizer_file)
        for batch in batches:
            for piece in pieces(batch, "text"):
                docs = [known.words(text.as_py() or "") for text in piece.column("text")]
                known.learn(set().union(*docs))
                out: list[tuple] = []
                for doc_id, found in zip(piece.column("doc_id").to_pylist(), docs, strict=True):
                    ids = b"".join(map(known.__getitem__, found)) + end
                    count, start = len(ids) // 4, 0
                    view = memoryview(ids)
                    for length in powers(count, longest):
                        part = view[4 * start : 4 * (start + length)]
                        row = (doc_id, start, length, zlib.crc32(part), count)
                        out.append((*row, np.frombuffer(part, dtype="<u4").tolist()) if with_ids else row)
                        start += length
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row[i] for row in out], kind) for i, (_, kind) in enumerate(_FIELDS[: 5 + with_ids])],
                    names=[name for name, _ in _FIELDS[: 5 + with_ids]],
                )
        known.before = {}  # workers live on after their task

    return run


_FIELDS = (
    ("doc_id", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("ids", pa.list_(pa.int32())),
)


def packed(docs: DataFrame, tokenizer_file: str, end_id: int = 2, longest: int = LONGEST, with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket (and ids).

    A document's ids are the tokenizer's, without special tokens of its own, then end_id; a null or empty text is the
    end token alone. `length` is a power of two up to `longest` (itself a power of two), `offset` is 0 and `bucket` is the
    binary logarithm of the length. sequence_id is unique in the result and grows within a task; it numbers rows, so
    repeated rows and rows that share a doc_id have pieces and sequences of their own. A null doc_id stays null. Other
    columns are left out. One pass, no shuffle, and memory follows the longest text. An empty table gives no rows.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence has to be a power of two")
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _packed(tokenizer_file, end_id, longest, with_ids), fields
    )
    return rows.withColumns(
        {
            "sequence_id": F.monotonically_increasing_id(),
            "offset": F.lit(0).cast("long"),
            "bucket": F.round(F.log2("length")).cast("int"),
        }
    )


def write_buckets(pieces_with_ids: DataFrame, path: str) -> None:
    """Parquet in one folder for each bucket, so that a reader takes batches of equal length."""
    pieces_with_ids.write.partitionBy("bucket").parquet(path)
