"""Hard negatives by exact scores from residue matrices.

Rows are vectors of whole numbers with a label. Scores are inner products, computed
in a residue number system: the components are taken modulo several small primes, as
the residues nearest to zero, and each pair of residue matrices is multiplied in
float32. The parts multiplied at once are so short that no sum leaves the whole
numbers that float32 holds exactly. Chinese remaindering gives the signed scores
back; as many primes are used as the vectors' lengths ask for (Cauchy-Schwarz).

Rows are cut into blocks by bytes, anchors too. Every block of anchors meets every
block of rows twice: first for the positives, the best rows of the anchor's own
label, then, with the positives' scores known, for the windows that they open. A block
gives the best of each window at most, chosen in its sorted scores; the bests of all
blocks are merged, first by groups of blocks. Work and memory of a task depend on the
blocks' sizes alone, so no label, however common, is a task's burden.

Ties go to the smaller id. Defined results: rows whose id or label is null or whose
vector is null, or holds null, NaN or infinite components, take no part (see
``scaled_floor``). A row is neither positive nor negative of an anchor with its own
id. Rows repeated under one id count once each; equal anchors are asked once, and
anchors of one id with other vectors or labels each for themselves. Shorter vectors
count as zero beyond their end. An anchor without positives, and a positive whose
window is empty, give no rows; so do empty tables. Scores beyond 2**53 raise an
OverflowError: seven primes below 256 reach no farther. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shelfscan.llm.tables import written
from shelfscan.llm.topk import scaled_floor

#: Primes of the residue number system, and how many components float32 sums exactly.
PRIMES = (251, 241, 239, 233, 229, 227, 223)
EXACT = (1 << 24) // (PRIMES[0] // 2) ** 2

#: Most rows of a block of rows and of anchors, and most bytes of a block's vectors.
ROWS, ANCHORS, BYTES = 8192, 256, 4 << 20

#: What a pass looks for: the anchor's label, or the others inside the positives' windows.
POSITIVES, NEGATIVES = "positives", "negatives"


class Residues:
    """A block's vectors modulo each prime, made when first asked for."""

    def __init__(self, dense: np.ndarray):
        self.dense, self.parts = dense, {}
        self.length = float(np.sqrt((dense.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))

    def modulo(self, prime: int) -> np.ndarray:
        if prime not in self.parts:
            half = prime // 2
            self.parts[prime] = ((self.dense + half) % prime - half).astype(np.float32)
        return self.parts[prime]


def _modulo_product(a: Residues, b: Residues, prime: int) -> np.ndarray:
    """Inner products of all rows of two blocks modulo a prime, from 0 on."""
    x, y = a.modulo(prime), b.modulo(prime)
    width = min(x.shape[1], y.shape[1])
    total = np.zeros((len(x), len(y)), np.int32)
    for at in range(0, width, EXACT):
        end = min(at + EXACT, width)
        total += np.rint(x[:, at:end] @ y[:, at:end].T).astype(np.int32) % prime
    return total % prime


def scores(a: Residues, b: Residues) -> np.ndarray:
    """Exact inner products of all rows of two blocks."""
    bound = a.length * b.length * (1 + 1e-9) + 1
    used, product = [], 1
    for prime in PRIMES:
        if product > 2 * bound:
            break
        used.append(prime)
        product *= prime
    if product <= 2 * bound:
        raise OverflowError(f"scores of up to {bound:.3g} are beyond the residue number system")
    # mixed radix: each digit is what is left modulo its prime, divided by the primes before
    value, radix = np.zeros((len(a.dense), len(b.dense)), np.int64), 1
    for prime in used:
        digit = (_modulo_product(a, b, prime) - value % prime) * pow(radix, -1, prime) % prime
        value += digit * radix
        radix *= prime
    return np.where(value > product // 2, value - product, value)


def _best(line: np.ndarray, ids: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """Of ``places``, the k with the best scores; ties by id."""
    if len(places) > k:
        kth = np.partition(line[places], len(places) - k)[len(places) - k]
        places = places[line[places] >= kth]
    return places[np.lexsort((ids[places], -line[places]))][:k]


def _dealt(rows: DataFrame, deal: F.Column, name: str, most: int) -> tuple[DataFrame, int]:
    """``rows`` as blocks in binary columns, and how many there are; ``deal`` differs from row to row."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    each = max(1, min(most, BYTES // (8 * max(size["width"] or 1, 1))))
    many = max(1, -(-size["n"] // each))
    others = [c for c in rows.columns if c != "vector"]

    def packed(block: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros((len(block), max(map(len, block["vector"]))), np.int64)
        for row, values in zip(dense, block["vector"], strict=True):
            row[: len(values)] = values
        out = {c: [b"".join(np.asarray(x, np.int64).tobytes() for x in block[c])] for c in others}
        return pd.DataFrame({name: [block[name].iloc[0]], **out, f"width_{name}": [dense.shape[1]], f"vectors_{name}": [dense.tobytes()]})

    schema = f"{name} bigint, {', '.join(f'{c} binary' for c in others)}, width_{name} int, vectors_{name} binary"
    dealt = rows.withColumn(name, F.pmod(deal, F.lit(many)))
    return dealt.groupBy(name).applyInPandas(packed, schema), many


def _numbers(raw: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(raw, np.int64).reshape(*shape) if shape else np.frombuffer(raw, np.int64)


def _searched(row_blocks: DataFrame, blocks_of_rows: int, anchors: DataFrame, what: str, k: int, window: tuple[int, int]) -> DataFrame:
    """The best k rows of each block for each anchor (or each of its positives)."""
    anchor_blocks, _ = _dealt(anchors, F.xxhash64("anchor"), "a", ANCHORS)
    # the stated anchors go to every block of rows; one pair of blocks is one step of a task's work
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks_of_rows - 1).cast("long")))
    # never broadcast: one copy of the anchors for each block of rows is more than the planner sees
    pairs = row_blocks.join(anchor_blocks.select("*", numbers.alias("r")).hint("merge"), "r")

    def found_in(line, ids, same, own, pair, i):
        """(place, slot): the places chosen for anchor ``i``, each with the positive it belongs to."""
        if what == POSITIVES:
            yield 0, _best(line, ids, np.flatnonzero(same & ~own), k)
            return
        order = np.flatnonzero(~same & ~own)
        order = order[np.lexsort((ids[order], -line[order]))]
        falling = -line[order]
        known = _numbers(pair.positive_scores).reshape(len(pair.known) // 8, -1)[i, : _numbers(pair.known)[i]]
        for slot, score in enumerate(known.tolist()):
            least, most = -(-window[0] * score // 100), window[1] * score // 100
            at = np.searchsorted(falling, -most, "left")
            end = np.searchsorted(falling, -least, "right")
            yield slot, order[at : min(end, at + k)]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = residues = ids = labels = None
        for part in parts:
            for pair in part.itertuples(index=False):
                if pair.r != current:  # the pairs of a block of rows come one after the other
                    current, ids, labels = pair.r, _numbers(pair.ids), _numbers(pair.labels)
                    residues = Residues(_numbers(pair.vectors_r, len(ids), pair.width_r))
                asked, own = _numbers(pair.anchor), _numbers(pair.anchor_id)
                table = scores(Residues(_numbers(pair.vectors_a, len(asked), pair.width_a)), residues)
                out = []
                for i, label in enumerate(_numbers(pair.label)):
                    for slot, places in found_in(table[i], ids, labels == label, ids == own[i], pair, i):
                        out.append((np.full(len(places), i), np.full(len(places), slot), ids[places], table[i][places]))
                i, slot, vec_id, score = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pd.DataFrame({"anchor": asked[i], "anchor_id": own[i], "slot": slot, "vec_id": vec_id, "score": score, "r": pair.r})

    found = pairs.mapInPandas(run, "anchor bigint, anchor_id bigint, slot int, vec_id bigint, score bigint, r bigint")
    for keys in (["anchor", "slot", F.floor(F.col("r") / 64)], ["anchor", "slot"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
        found = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return found.drop("r")


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor its best rows of the same label, and for each of these the best rows
    of other labels whose score lies in the window, in percent of the positive's.
    ``window``: from and to, from 0 on.
    """
    pick = lambda df: df.select(F.col(id).alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector")).dropna()
    row_blocks, many = _dealt(
        pick(rows).withColumnsRenamed({"id": "ids", "label": "labels"}), F.xxhash64(F.monotonically_increasing_id()), "r", ROWS
    )
    row_blocks = written(row_blocks, "rows")
    asked = pick(anchors).dropDuplicates().select(
        F.xxhash64("id", "label", "vector").alias("anchor"), F.col("id").alias("anchor_id"), "label", "vector"
    )
    found = _searched(row_blocks, many, asked, POSITIVES, positives, window)
    found = written(found.select("anchor", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    # the windows of an anchor: a fixed number of places, of which the first are known
    each = F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("list")
    opened = found.groupBy("anchor").agg(each).select(
        "anchor",
        F.size("list").cast("long").alias("known"),
        F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.coalesce(F.get(F.col("list.positive_score"), i), F.lit(0))).alias("positive_scores"),
    )
    chosen = _searched(row_blocks, many, asked.join(opened, "anchor"), NEGATIVES, negatives, window)
    positive = found.withColumn("slot", F.col("rank") - 1).drop("rank")
    return chosen.join(positive, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = scaled_floor(vectors.withColumn("label", moved))
    return mine(whole, whole.filter(F.col("vec_id") % 100 == 0))


ORACLE_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
           CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v AS a JOIN v AS c ON c.vec_id <> a.vec_id
    WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
           row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same
), ranked AS (
    SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
    FROM positives AS p JOIN scored AS s ON s.anchor_id = p.anchor_id AND NOT s.same
    WHERE p.place <= 5 AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""
