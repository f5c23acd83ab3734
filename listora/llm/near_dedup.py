"""MinHash near-dedup: SuperMinHash sketches, banding, verification on whole shingle sets, union-find grouping.

Documents with one and the same shingle set form a class, told by a 128-bit digest of the sorted set, and only one
member goes on. Classes that agree in a band meet in a bucket:

1. each class is held against the least class of its buckets, and verified links make first groups;
2. buckets that still hold several groups are split into blocks of bounded size. Classes outside the bucket's main
   group are held against all others there, first by the sketch, then by their sets in short hashes, within the block;
   only pairs that pass become rows, and these are verified.

So a bucket of copies costs one link per member, and no list of all pairs is made. A linked pair with similarity 0.85
misses all 32 bands of 4 slots with odds of 6e-11, one with 0.80 with odds of 5e-8. Either falls below the bound on
agreeing slots, 84 of 128 at 0.85 and 75 at 0.80, with odds of 1.4e-8 at most. Short
hashes have 32 bits; how many shingles they merge in a set is known and allowed for, so they rule out no linked pair.
Verification compares whole sets of 64-bit shingle hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listora.llm.arrow_batches import binary_rows, pieces
from listora.llm.distinct_texts import fresh_names, text_key
from listora.llm.hashing import whole_windows, windows, words
from listora.llm.links import components
from listora.llm.superminhash import signatures, sketches
from listora.session import release, remove, write_out

SHINGLE = 5
SLOTS = 128
BAND = 4  # slots
MISSED = 1.4e-8  # odds that a linked pair has too few agreeing slots
BLOCK = 1024  # classes of a bucket that meet in one task


def agreeing(percent: int) -> int:
    """Slots that a pair of this similarity agrees in, but for odds of MISSED (binomial)."""
    share, below = percent / 100, 0.0
    for k in range(SLOTS):
        below += math.comb(SLOTS, k) * share**k * (1 - share) ** (SLOTS - k)
        if below > MISSED:
            return k
    return SLOTS


def shingle_sets(texts: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and where each set begins.

    A text with fewer words than a shingle has its whole sequence as its only shingle; without words it has none.
    """
    found = words(texts, lower=True)
    counts = found.counts
    at = whole_windows(found, width)
    values = windows(found.hashes, width)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    ends = np.cumsum(np.maximum(counts - width + 1, 0))
    sets, low = [], 0
    for i, high in enumerate(ends):
        if counts[i] >= width:
            sets.append(np.unique(values[low:high]))
        elif counts[i]:
            start = found.first[i]
            sets.append(windows(found.hashes[start : start + counts[i]], int(counts[i])))
        else:
            sets.append(values[:0])
        low = high
    first = np.zeros(len(sets) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in sets], out=first[1:])
    return (np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)), first


def _digest(elements: np.ndarray) -> bytes | None:
    return hashlib.blake2b(elements.tobytes(), digest_size=16).digest() if len(elements) else None


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            elements, first = shingle_sets(piece.column("text"))
            sketch = sketches(signatures(elements, first, SLOTS))
            sizes = np.diff(first)
            digests = [_digest(elements[first[i] : first[i + 1]]) for i in range(len(sizes))]
            rows = np.arange(len(sizes) + 1) * SLOTS
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"), piece.column("text_key"), pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()), binary_rows(sketch.reshape(-1), rows),
                ],
                names=["doc_id", "text_key", "n_shingles", "class", "sketch"],
            )


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, "text"):
            elements, first = shingle_sets(piece.column("text"))
            found = [_digest(elements[first[i] : first[i + 1]]) for i in range(len(first) - 1)]
            wanted = piece.column("class").to_pylist()
            keep = pa.array([a == b for a, b in zip(found, wanted, strict=True)], pa.bool_())
            out = [piece.column("class"), binary_rows(elements, first)]
            yield pa.RecordBatch.from_arrays(out, names=["class", "elements"]).filter(keep)


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets in sorted 32-bit hashes, and their true sizes."""
    for batch in batches:
        for piece in pieces(batch, "elements"):
            parts = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in piece.column("elements")]
            short = [np.unique((x >> np.uint64(32)).astype(np.uint32)) for x in parts]
            first = np.zeros(len(parts) + 1, dtype=np.int64)
            np.cumsum([len(x) for x in short], out=first[1:])
            sizes = pa.array([len(x) for x in parts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [piece.column("class"), piece.column("sketch"), sizes, binary_rows(np.concatenate(short), first)],
                names=["class", "sketch", "n", "short"],
            )


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("left_set"), batch.column("right_set")
            keep = []
            for i in range(len(batch)):
                a = np.frombuffer(left[i].as_buffer(), dtype=np.uint64)
                b = np.frombuffer(right[i].as_buffer(), dtype=np.uint64)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    keep.append(False)
                    continue
                both = len(a) + len(b) - len(np.union1d(a, b))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose whole sets reach the threshold."""
    left = sets.select(F.col("class").alias("a"), F.col("elements").alias("left_set"))
    right = sets.select(F.col("class").alias("b"), F.col("elements").alias("right_set"))
    both = pairs.select("a", "b").join(right, "b").join(left, "a")
    return both.mapInArrow(_verified(percent), "a binary, b binary")


def _alike(percent: int):
    """Pairs of one block that may reach the threshold: of different groups, and this is their first band in common."""
    least = agreeing(percent)

    def run(block: pd.DataFrame) -> pd.DataFrame:
        row, col = block["side"].to_numpy() < 2, block["side"].to_numpy() > 0
        sketch = np.frombuffer(b"".join(block["sketch"]), dtype=np.uint16).reshape(-1, SLOTS)
        short = [np.frombuffer(x, dtype=np.uint32) for x in block["short"]]
        size = block["n"].to_numpy()
        lost = size - np.array([len(x) for x in short], dtype=np.int64)
        group, node, band = block["group"].to_numpy(), block["class"].to_numpy(), int(block["band"].iloc[0])
        right, out = np.flatnonzero(col), []
        for i in np.flatnonzero(row):
            others = right[group[right] != group[i]]
            if col[i]:
                others = others[others > i]  # rows and columns are the same classes
            low, high = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
            others = others[100 * low >= percent * high]
            same = sketch[others] == sketch[i]
            close = same.sum(axis=1) >= least
            first = same[close].reshape(int(close.sum()), SLOTS // BAND, BAND).all(axis=2).argmax(axis=1)
            others = others[close][first == band]
            if not len(others):
                continue
            parts = [short[j] for j in others]
            edges = np.cumsum([0] + [len(x) for x in parts[:-1]])
            flat = np.concatenate(parts)
            at = np.minimum(np.searchsorted(short[i], flat), len(short[i]) - 1)
            # shared shingles that short hashes merge are merged in either set, so no more are lost than either has lost
            both = np.add.reduceat((short[i][at] == flat).astype(np.int64), edges) + np.minimum(lost[others], lost[i])
            for j in others[(100 + percent) * both >= percent * (size[others] + size[i])]:
                out.append((min(node[i], node[j]), max(node[i], node[j])))
        return pd.DataFrame(out, columns=["a", "b"])

    return run


def _rest_pairs(
    members: DataFrame, first: DataFrame, classes: DataFrame, sets: DataFrame, groups: DataFrame, percent: int
) -> DataFrame:
    """Pairs across groups that step 1 has not looked at, by sketch, block by block."""
    named = (
        members.join(groups, F.col("class") == F.col("node"), "left").join(first, F.col("class") == F.col("b"), "left")
        .select("key", "band", "class", F.coalesce("component", "class").alias("group"), (F.col("a") == F.col("least")).alias("seen"))
    )
    sizes = named.groupBy("key", "group").agg(F.count(F.lit(1)).alias("n"), F.max("seen").alias("seen"))
    buckets = (
        sizes.groupBy("key")
        .agg(
            F.max(F.struct("n", "group")).alias("main"), F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_groups"),
            F.coalesce(F.max("seen"), F.lit(False)).alias("seen"),
        )
        .where("n_groups > 1 AND (total > 2 OR NOT seen)")  # a bucket of two is done if step 1 has looked at its pair
        .select(
            F.col("key"),
            F.col("main.group").alias("main"),
            F.ceil(F.col("main.n") / BLOCK).alias("main_blocks"),
            F.ceil((F.col("total") - F.col("main.n")) / BLOCK).alias("other_blocks"),
        )
    )
    apart = write_out(named.join(buckets, "key").withColumn("is_main", F.col("group") == F.col("main")), "apart")
    open_classes = apart.select("class").distinct().join(classes.select("class", "sketch"), "class").join(sets, "class")
    looks = open_classes.mapInArrow(_shortened, "class binary, sketch binary, n long, short binary")
    block = lambda n: F.pmod(F.xxhash64("class"), F.greatest(F.col(n), F.lit(1)))
    # a block (i, j) holds rows i against columns j; columns are always outside the main group
    as_main = F.transform(F.sequence(F.lit(0), F.col("other_blocks") - 1), lambda j: F.struct(block("main_blocks").alias("i"), j.alias("j"), F.lit(0).alias("side")))
    own = block("other_blocks")
    as_other = F.concat(
        F.transform(F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(2).alias("side"))),
        F.transform(
            F.sequence(F.lit(0), F.col("other_blocks") - 1),
            lambda k: F.struct(
                (-1 - F.least(own, k)).alias("i"), F.greatest(own, k).alias("j"),
                F.when(own == k, 1).when(own < k, 0).otherwise(2).alias("side"),
            ),
        ),
    )
    placed = apart.withColumn("place", F.explode(F.when(F.col("is_main"), as_main).otherwise(as_other)))
    placed = placed.join(looks, "class").select("key", "band", "place.*", "class", "group", "sketch", "n", "short")
    pairs = placed.groupBy("key", "i", "j").applyInPandas(_alike(percent), "a binary, b binary")
    return pairs.distinct()


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, text_key, n_shingles, class, and of its component: label, component_id and number of documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = write_out(
        docs.withColumn("text_key", text_key()).mapInArrow(
            _sketched, "doc_id long, text_key binary, n_shingles long, class binary, sketch binary"
        ),
        "sketches",
    )
    classes = (
        sketched.where("class IS NOT NULL").groupBy("class")
        .agg(F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("copies"))
    )
    classes = write_out(classes, "classes")
    width = 2 * BAND
    cut = F.transform(
        F.sequence(F.lit(0), F.lit(SLOTS // BAND - 1)),
        lambda b: F.struct(b.alias("band"), F.substring("sketch", b * width + 1, F.lit(width)).alias("slots")),
    )
    banded = classes.select("class", F.explode(cut).alias("cut")).select(
        "class", "cut.band", F.concat(F.col("cut.slots"), F.unhex(F.hex("cut.band"))).alias("key")
    )
    buckets = (
        banded.groupBy("key").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("key", "least")
    )
    members = write_out(banded.join(buckets, "key"), "members")
    near = members.select("class").distinct().join(classes.select("class", "doc_id"), "class")
    sets = write_out(
        docs.join(near, docs["doc_id"].eqNullSafe(near["doc_id"])).select("class", "text")
        .mapInArrow(_whole_sets, "class binary, elements binary").dropDuplicates(["class"]),
        "sets",
    )
    release(docs.sparkSession)
    first = members.groupBy(F.col("class").alias("b")).agg(F.min("least").alias("a")).where("a != b")
    links = write_out(_verify(first, sets, percent), "links")
    groups = components(links)
    release(docs.sparkSession)
    open_pairs = write_out(_rest_pairs(members, first, classes, sets, groups, percent), "open-pairs")
    remove(members)
    rest = write_out(_verify(open_pairs, sets, percent), "rest")
    remove(open_pairs, sets)
    grouped = components(links.union(rest))
    labelled = classes.join(grouped, F.col("class") == F.col("node"), "left").select(
        "class", "doc_id", "copies", F.coalesce("component", "class").alias("component")
    )
    least = labelled.groupBy("component").agg(
        F.min("doc_id").alias("component_id"), F.sum("copies").alias("n_documents")
    )
    of_class = labelled.select("class", "component").join(least, "component")
    return sketched.drop("sketch").join(of_class, "class", "left")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Group of every document: doc_id, n_shingles, component_id, kept, and the class (null without words).

    Words are runs of bytes other than ASCII white space, A-Z folded; a set holds the distinct 5-word shingles, or the
    whole sequence where there are fewer words. Documents are linked where 100 * intersection >= percent * union.
    component_id is the least doc_id reachable and kept tells whether it is the document's own.

    Null or empty texts, and texts without words, have no shingles, are linked with nothing and kept. A null doc_id
    takes part with its text but is never the least id; a component of null ids only has a null component_id and kept
    is then false for all but such a document without any link or equal. Repeated rows share their class; rows that
    share a doc_id get the same component_id only if their texts are linked. Other columns are left out, whatever their
    names. An empty table gives no rows.
    """
    alone = F.col("class").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return _grouped(docs, percent).select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, alone | (F.col("n_documents") == 1)).alias("kept"),
        F.col("class").alias("set_digest"),
    )


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Rows of `docs`, all columns as they are, of which one stays of each group of near-duplicates.

    It is the one with the least doc_id (a null id comes last, equal ids go by the text's md5). Rows without words are in
    no group and all stay. Of rows with the same doc_id and text any one stays.
    """
    key, salt, other_id, other_key = fresh_names(docs, "text_key", "salt", "kept_id", "kept_key")
    place = F.row_number().over(Window.partitionBy("component").orderBy(F.col("doc_id").asc_nulls_last(), "text_key"))
    grouped = write_out(_grouped(docs, percent).select("doc_id", "text_key", "component"), "groups")
    first = grouped.where("component IS NOT NULL").withColumn("place", place).where("place = 1")
    kept = first.select("doc_id", "text_key", F.lit(False).alias("alone")).union(
        grouped.where("component IS NULL").select("doc_id", "text_key", F.lit(True)).distinct()
    )
    kept = kept.select(F.col("doc_id").alias(other_id), F.col("text_key").alias(other_key), F.col("alone").alias(salt))
    rows = docs.withColumn(key, text_key()).join(
        kept, F.col("doc_id").cast("long").eqNullSafe(F.col(other_id)) & (F.col(key) == F.col(other_key))
    )
    rows = rows.withColumn(salt, F.when(F.col(salt), F.monotonically_increasing_id()))
    return rows.dropDuplicates([other_id, other_key, salt]).select(*docs.columns)
