"""Language identification with hyperdimensional profiles.

Every letter has a random vector of -1 and 1, and so has the space that stands for any run of other characters. A
trigram's vector binds its letters: the first letter's vector rotated by two, times the second's rotated by one, times
the third's. A document is the sum of its trigrams' vectors, a language the sum of its documents'. A document gets the
language whose prototype, less the mean of all prototypes' directions, has the highest cosine with it. That cosine is never
below 0 with two or more languages, so whether a document is like any language at all is told otherwise: by how frequent
its trigrams are in the language on average, against how frequent the language's own are.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listora.llm.arrow_batches import pieces

DIMENSIONS = 1024
GRAM = 3
UNDETERMINED = "und"
UNLIKE = 0.05  # of a language's labelled documents are less like it than its floor

_CHUNK = 1 << 20  # characters of a text that are looked at together


@functools.cache
def _letters() -> np.ndarray:
    """Symbol of each code point: 0 if it is no letter, else 1 to 255, equal for both cases.

    Basic Latin, Latin-1 and Latin Extended-A letters have symbols of their own as far as they go; letters of other
    scripts share the rest by a hash.
    """
    table = np.zeros(0x110000, dtype=np.uint8)
    own: dict[int, int] = {}
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            low = ord(char.lower()[0])
            if low < 0x180:
                table[code] = own.setdefault(low, len(own) + 1)
            else:
                table[code] = 160 + low * 2654435761 % 96
    return table


def symbols(text: str) -> np.ndarray:
    """Letters of a text in lower case with a 0 for each run of anything else, and a 0 at both ends."""
    table = _letters()
    parts = [np.zeros(1, dtype=np.uint8)]
    for low in range(0, len(text), _CHUNK):
        codes = np.frombuffer(text[low : low + _CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        parts.append(table[codes])
    parts.append(parts[0])
    found = np.concatenate(parts)
    return found[np.concatenate(([True], (found[1:] != 0) | (found[:-1] != 0)))]


def gram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, trigram and how often the text has it; a trigram may come up again for a long text."""
    owners, grams, counts = [], [], []
    found = [symbols(text) for text in texts]
    flat = np.concatenate(found) if found else np.zeros(0, dtype=np.uint8)
    owner = np.repeat(np.arange(len(found), dtype=np.uint64), [len(x) for x in found])
    for low in range(0, len(flat) - GRAM + 1, _CHUNK):
        part = flat[low : low + _CHUNK + GRAM - 1].astype(np.uint64)
        own = owner[low : low + _CHUNK + GRAM - 1]
        codes = part[:-2] << np.uint64(16) | part[1:-1] << np.uint64(8) | part[2:]
        keys = np.sort((own[:-2] << np.uint64(24) | codes)[(own[:-2] == own[2:]) & (codes > 0)])
        edge = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        owners.append((keys[edge] >> np.uint64(24)).astype(np.int64))
        grams.append((keys[edge] & np.uint64(0xFFFFFF)).astype(np.int64))
        counts.append(np.diff(np.append(edge, len(keys))))
    join = lambda xs: np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)
    return join(owners), join(grams), join(counts)


@functools.cache
def _symbol_vectors(dimensions: int) -> np.ndarray:
    return np.random.default_rng(20_240_607).choice(np.array([-1, 1], dtype=np.int8), size=(256, dimensions))


def gram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    vectors = _symbol_vectors(dimensions)
    once, twice = np.roll(vectors, 1, axis=1), np.roll(vectors, 2, axis=1)
    return twice[grams >> 16] * once[grams >> 8 & 255] * vectors[grams & 255]


def bundles(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Vector of each text (a sum of whole numbers), and whether the text has a letter."""
    found, totals = counted_bundles(texts, dimensions)
    return found, totals > 0


def counted_bundles(texts: list[str], dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Vector of each text, and the number of its trigrams."""
    owners, grams, counts = gram_counts(texts)
    distinct, place = np.unique(grams, return_inverse=True)
    out = np.zeros((len(texts), dimensions), dtype=np.float32)
    for low in range(0, len(distinct), 4096):  # so many trigrams at a time
        some = (place >= low) & (place < low + 4096)
        weights = np.zeros((len(texts), min(4096, len(distinct) - low)), dtype=np.float32)
        np.add.at(weights, (owners[some], place[some] - low), counts[some])
        out += weights @ gram_vectors(distinct[low : low + 4096], dimensions).astype(np.float32)
    return out, np.bincount(owners, counts, minlength=len(texts))


def likeness(found: np.ndarray, totals: np.ndarray, sums: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Mean frequency of the texts' trigrams in a language over that of its own: about 1 for its texts, however long.

    Rows go together; the sum has the vectors of `of` trigrams. Without trigrams on either side it is 0.
    """
    own = (sums * sums).sum(axis=-1)
    known = (totals > 0) & (own > 0)
    return np.where(known, (found * sums).sum(axis=-1) * of / np.where(known, totals * own, 1), 0.0)


@dataclass(frozen=True)
class Profiles:
    """Language names in order, a unit vector for each, the sums of their documents' vectors and of how many trigrams."""

    names: list[str]
    vectors: np.ndarray
    sums: np.ndarray
    totals: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Best language and its score from 0 to 1 for each text; equal cosines go to the first name."""
        found, lettered = bundles(texts, self.vectors.shape[1])
        if not self.names:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        norms = np.linalg.norm(found, axis=1, keepdims=True)
        cosines = np.round((found / np.where(norms > 0, norms, 1)).astype(np.float64) @ self.vectors.T, 6)
        best = cosines.argmax(axis=1)
        names = [self.names[i] if has else UNDETERMINED for i, has in zip(best, lettered, strict=True)]
        score = (1 + cosines[np.arange(len(texts)), best]) / 2
        return names, np.where(lettered, np.clip(score, 0, 1), 0.0)


def _partial_sums(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text"):
                langs = piece.column("lang").to_pylist()
                owners, grams, counts = gram_counts([x.as_py() or "" for x in piece.column("text")])
                names = sorted(set(langs))
                number = np.array([names.index(x) for x in langs])[owners]
                distinct, place = np.unique(grams, return_inverse=True)
                weights = np.bincount(number * len(distinct) + place, counts, len(names) * len(distinct))
                weights = weights.reshape(len(names), len(distinct))
                for low in range(0, len(distinct), 4096):
                    part = weights[:, low : low + 4096] @ gram_vectors(distinct[low : low + 4096], dimensions).astype(float)
                    part = np.column_stack((part, weights[:, low : low + 4096].sum(axis=1)))
                    for name, row in zip(names, part, strict=True):
                        sums[name] = sums.get(name, 0) + row
        for name, row in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(row)), pa.array(np.arange(len(row))), pa.array(np.rint(row).astype(np.int64))],
                names=["lang", "at", "part"],
            )

    return run


def fit(docs: DataFrame, training: Column, dimensions: int = DIMENSIONS) -> Profiles:
    """Prototypes of all documents that `training` picks and whose lang is not null; only text and lang are read.

    What reaches the driver is one vector and a count for each language.
    """
    rows = docs.where(training & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    sums = rows.mapInArrow(_partial_sums(dimensions), "lang string, at long, part long")
    found = sums.groupBy("lang", "at").agg(F.sum("part").alias("part")).groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("at", "part"))).alias("parts")
    )
    rows = sorted((row.lang, [x.part for x in row.parts]) for row in found.collect())
    sums = np.array([row for _, row in rows], dtype=np.float64).reshape(len(rows), dimensions + 1)
    sums, totals = sums[:, :dimensions], sums[:, dimensions]
    vectors = sums
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = vectors / np.where(norms > 0, norms, 1)
    if len(rows) > 1:
        vectors = vectors - vectors.mean(axis=0)
        norms = np.linalg.norm(vectors, axis=1, keepdims=True)
        vectors = vectors / np.where(norms > 0, norms, 1)
    return Profiles([name for name, _ in rows], vectors, sums, totals)


def held_out(fold: int = 1, folds: int = 3) -> Column:
    """crc32 of doc_id as text, mod folds, is fold; a null doc_id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def _predicted(profiles: Profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                names, scores = profiles.predict([x.as_py() or "" for x in piece.column("text")])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("held_out"), pa.array(names, pa.string()), pa.array(scores)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def languages(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every whole text, learnt from the documents that are not held out.

    lang_pred is a lang value seen in training, or `und` with score 0 if the text is null, has no letter, or nothing could
    be learnt. The score is (1 + cosine) / 2. One row for each row in, repeated or not; a null doc_id stays null and is not
    held out; rows with a null lang are predicted and teach nothing. Other columns are left out. An empty table gives no
    rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    profiles = fit(docs, ~held_out(), dimensions)
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _predicted(profiles), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def _own_likeness(profiles: Profiles):
    """Likeness of each labelled document to its language's other documents; to 3 digits, so few values differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, totals = counted_bundles([x.as_py() or "" for x in piece.column("text")], profiles.sums.shape[1])
                found = found.astype(np.float64)
                own = [profiles.names.index(x) for x in piece.column("lang").to_pylist()]
                others = profiles.totals[own] - totals
                own = np.round(likeness(found, totals, profiles.sums[own] - found, others), 3)
                known = pa.array((totals > 0) & (others > 0), pa.bool_())
                yield pa.RecordBatch.from_arrays([piece.column("lang"), pa.array(own)], names=["lang", "own"]).filter(known)

    return run


def floors(docs: DataFrame, profiles: Profiles) -> np.ndarray:
    """For each language the likeness that all but UNLIKE of its labelled documents reach; 1 for a single document."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    own = rows.mapInArrow(_own_likeness(profiles), "lang string, own double")
    found = own.groupBy("lang").agg(F.percentile("own", F.lit(UNLIKE)).alias("floor")).collect()
    found = {row.lang: row.floor for row in found}
    return np.array([max(0.001, found.get(name, 1.0)) for name in profiles.names])


def accepted(docs: DataFrame, least_share: float, dimensions: int = DIMENSIONS) -> DataFrame:
    """Rows of `docs`, all columns as they are, that are like a language learnt from the labelled ones.

    A document stays if its likeness to any language is at least this share of the language's floor (see `floors`).
    Documents without letters go, and all do if nothing is labelled. Two or three words say little, whichever way it goes.
    """
    labelled = docs.select("text", F.col("lang").cast("string").alias("lang"))
    profiles = fit(labelled, F.lit(True), dimensions)
    return docs.mapInArrow(_keeping(profiles, least_share * floors(labelled, profiles)), docs.schema)


def _keeping(profiles: Profiles, least: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                found, totals = counted_bundles([x.as_py() or "" for x in piece.column("text")], profiles.sums.shape[1])
                found, keep = found.astype(np.float64), np.zeros(len(piece), dtype=bool)
                for vector, of, floor in zip(profiles.sums, profiles.totals, least, strict=True):
                    keep |= np.maximum(likeness(found, totals, vector, of), 0) >= floor
                yield piece.filter(pa.array(keep & (totals > 0), pa.bool_()))

    return run
