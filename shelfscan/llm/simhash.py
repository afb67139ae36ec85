"""SimHash near-duplicates by pigeonhole blocks.

A text's fingerprint has a bit where more than half of the hashes of its shingles
have one. Equal fingerprints are one class from the start. A fingerprint is cut into
``BLOCKS`` blocks; two that differ in at most ``distance`` bits agree in all blocks
but ``distance``, so each class sends one key for every choice of that many whole
blocks, with the values it has there.

Keys that one class has alone go after a count. Up to ``SMALL`` classes of one key
are joined with one another and verified by their Hamming distance. More of them
(a large group of near copies, whose pairs nobody wants to see) meet by another key:
each class sends every number that differs from it in at most half the distance, in
blocks that the key leaves open. Two classes that share such a number are linked,
and two linked ones share the number half way between them; so the classes of a
number need only be linked with the least of them. No number has more classes than
there are numbers around it (33 for a distance of two), whatever the input.

Components join the linked classes; copies are never paired.

Defined results: null and empty texts, and texts without a word, have the
fingerprint zero and are linked as any other; fewer words than a shingle has are one
shingle. Each row gets its own row; rows with one id are texts of their own. Rows
without an id are linked by their texts as others are; a component's id is the least
that any of its rows has, and null where none has one. Other columns of the input are
not read. An empty table gives an empty result. A very long text takes some 30 bytes
of memory a byte, its shingles are hashed in pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfscan.llm.components import components
from shelfscan.llm.tables import checkpointed, written
from shelfscan.llm.words import blocks, places_of

#: Words of a shingle, seed of its hash, bits that linked fingerprints may differ in.
SHINGLE, SEED, DISTANCE = 3, 42, 2

#: Blocks of a fingerprint; classes of a key that are paired with one another.
BLOCKS, SMALL = 4, 32

#: Shingles whose bits are counted at once.
PIECE = 1 << 15

_BITS = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words in lower case, one space apart, and where each now begins and ends."""
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    inside = np.arange(int(sizes.sum()))
    flat = np.full(len(inside) + len(sizes), 32, np.uint8)
    flat[inside + np.repeat(np.arange(len(sizes)), sizes)] = _LOWER[data[inside + np.repeat(starts - before, sizes)]]
    begins = before + np.arange(len(sizes))
    return flat.tobytes(), begins, begins + sizes


def _hashes(flat: bytes, begins: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    found = (digest(flat[a:b], seed) for a, b in zip(begins.tolist(), ends.tolist(), strict=True))
    return np.fromiter(found, np.uint64, len(begins))


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The fingerprint of each text of a block, as signed numbers."""
    starts, ends, text, first = places_of(data, offsets)
    flat, begins, stops = _joined(data, starts, ends)
    texts = len(first) - 1
    counts = np.zeros((texts, _BITS), np.int64)
    whole = np.flatnonzero(text[: max(len(text) - shingle + 1, 0)] == text[shingle - 1 :])
    for at in range(0, len(whole), PIECE):
        mine = whole[at : at + PIECE]
        hashes = _hashes(flat, begins[mine], stops[mine + shingle - 1], seed)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        edges = np.flatnonzero(np.diff(text[mine], prepend=-1))
        counts[text[mine[edges]]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    many = np.bincount(text[whole], minlength=texts)
    out = np.packbits(2 * counts > many[:, None], axis=1).view(">u8").ravel().astype(np.uint64)
    words = np.diff(first)
    short = np.flatnonzero((words > 0) & (words < shingle))
    out[short] = _hashes(flat, begins[first[short]], stops[first[short + 1] - 1], seed)
    return out.view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint) of each row; the fingerprint's bits as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in blocks(batch.column("text")):
                ids = batch.column("doc_id").slice(at, end - at)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(fingerprints_of(data, offsets, shingle, seed))], ["doc_id", "fingerprint"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint bigint")


def _masks(distance: int) -> list[int]:
    """For every choice of whole blocks, a number with their bits, signed."""
    edges = [_BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) for c in combinations(block, BLOCKS - distance)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _around(mask: F.Column, fingerprint: F.Column, distance: int) -> F.Column:
    """All numbers that differ from a fingerprint in at most half the distance, outside the mask."""
    flips = [0, *(1 << i for i in range(_BITS))]
    flips = sorted({sum(c) for n in range(distance // 2 + 1) for c in combinations(flips[1:], n)})
    signed = F.array(*[F.lit(f - (1 << 64) if f >> 63 else f).cast("long") for f in flips])
    return F.transform(F.filter(signed, lambda f: f.bitwiseAND(mask) == 0), lambda f: f.bitwiseXOR(fingerprint))


def links_of(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between the different numbers ``fingerprint`` that join just those within ``distance``.

    ``distance``: an even number below ``BLOCKS``.
    """
    if distance % 2 or not 0 <= distance < BLOCKS:
        raise ValueError(f"distance must be an even number below {BLOCKS}")
    masks = F.array(*[F.lit(m).cast("long") for m in _masks(distance)])
    keys = classes.select("fingerprint", F.explode(masks).alias("mask")).select(
        "fingerprint", "mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key")
    )
    many = keys.groupBy("mask", "key").agg(F.count("*").alias("classes")).filter("classes > 1")
    shared = written(keys.join(many, ["mask", "key"]).withColumn("large", F.col("classes") > SMALL).drop("classes"), "shared")

    small = shared.filter("NOT large").select("mask", "key", "fingerprint")
    pairs = small.withColumnRenamed("fingerprint", "a").join(small.withColumnRenamed("fingerprint", "b"), ["mask", "key"])
    apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = pairs.filter((F.col("a") < F.col("b")) & (apart <= distance)).select("a", "b")

    meeting = F.explode(_around(F.col("mask"), F.col("fingerprint"), distance)).alias("meeting")
    large = shared.filter("large").select("fingerprint", meeting).distinct()
    least = F.min("fingerprint").over(Window.partitionBy("meeting"))
    stars = large.select(least.alias("a"), F.col("fingerprint").alias("b")).filter("a < b")
    return near.union(stars).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, distance: int = DISTANCE
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row; the fingerprint as 16 hexadecimal digits."""
    rows = written(fingerprints(docs, shingle, seed), "fingerprints")
    classes = checkpointed(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")))
    roots = components(links_of(classes, distance)).withColumnRenamed("node", "fingerprint")
    rooted = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    placed = rooted.join(least, "root").select("fingerprint", "component_id")
    return rows.join(placed, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
