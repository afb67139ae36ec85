"""Exact top-k inner products by exhaustive term-at-a-time accumulation.

Rows are vectors of whole numbers. Candidates and queries are cut into blocks, whose
numbers are packed in as few bytes as hold them. Every pair of blocks is a task:
the candidates are turned into postings (for every component, the rows where it is
not zero and their weights), each component of a query scatters its weighted
postings into a dense score array, and the best k of a block are selected by
partition. The bests of all blocks are merged: first per query and group of blocks,
then per query.

Tasks fetch their two blocks where these were shuffled to: no block is broadcast,
nor written once per block of the other side, and a task hands one pair to Python.
Memory of a task depends on the block sizes alone, which are bounded by rows and by
numbers; more rows make more blocks.

Ties go to the smaller id, within a block and in the merge. Defined results: rows
whose vector is null, or holds null, NaN or infinite components, take no part. A
row is no candidate of a query with its own id. Rows repeated under one id are
candidates once each; queries repeated with the same vector are asked once.
Shorter vectors count as zero beyond their end. No queries or no candidates give
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

#: Rows of a block of candidates and of queries, at least, while ``CELLS`` lets them.
CANDIDATES, QUERIES = 16384, 256
#: Blocks of candidates and of queries that larger blocks are made to keep to.
CANDIDATE_BLOCKS, QUERY_BLOCKS = 64, 16
#: Numbers of a block at most, but for one row that is longer and for what chance deals out.
CELLS = 1 << 22
#: Columns of a block besides its number: ids and lengths of rows, bytes of a number, all numbers.
BLOCK = [("ids", pa.binary()), ("lengths", pa.binary()), ("bytes", pa.int32()), ("numbers", pa.binary())]


def scaled_floor(vectors: DataFrame, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """``vectors`` with floor(scale * x) of each component; without rows that have no such vector."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fit = F.col(vector).isNotNull() & ~F.exists(vector, lambda x: F.coalesce(odd(x.cast("double")), F.lit(True)))
    return vectors.filter(fit).withColumn(vector, whole)


class Rows(NamedTuple):
    """Ids, lengths and numbers, one after the other, of a block's vectors."""

    ids: np.ndarray
    lengths: np.ndarray
    values: np.ndarray


def _narrowed(values: np.ndarray) -> np.ndarray:
    """``values`` in the narrowest of three kinds that holds them all."""
    least, most = (values.min(), values.max()) if len(values) else (0, 0)
    for kind in (np.int16, np.int32):
        if np.iinfo(kind).min <= least and most <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def _columns(rows: Rows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(component, rows where it is not zero, their weights)."""
    many, width = len(rows.ids), int(rows.lengths.max(initial=0))
    if many * width <= 2 * len(rows.values):  # a few shorter rows are filled up
        dense = np.zeros((many, width), rows.values.dtype)
        dense[np.arange(width) < rows.lengths[:, None]] = rows.values
        for term, column in enumerate(dense.T):
            at = np.flatnonzero(column)
            yield term, at, column[at]
        return
    places = np.flatnonzero(rows.values)
    at = np.repeat(np.arange(many), rows.lengths)[places]
    term = places - (np.cumsum(rows.lengths, dtype=np.int64) - rows.lengths)[at]
    order = np.argsort(term, kind="stable")
    at, term, weights = at[order], term[order], rows.values[places[order]]
    begins = np.flatnonzero(np.diff(term, prepend=-1))
    for begin, end in zip(begins, [*begins[1:], len(term)], strict=True):
        yield int(term[begin]), at[begin:end], weights[begin:end]


def _postings(rows: Rows) -> dict[int, tuple[np.ndarray | None, np.ndarray]]:
    """(rows, weights) by component; no rows where weights has them all, as it does if a quarter is not zero."""
    kind, lists = np.int64 if rows.values.dtype == np.int64 else np.int32, {}
    for term, at, weights in _columns(rows):
        if 4 * len(at) > len(rows.ids):
            lists[term] = None, np.zeros(len(rows.ids), kind)
            lists[term][1][at] = weights
        elif len(at):
            lists[term] = at, weights.astype(kind)
    return lists


def _most(values: np.ndarray) -> int:
    """The largest of ``values`` without their signs; no array is made for it."""
    return max(-int(values.min()), int(values.max())) if len(values) else 0


def _best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one row of scores; ties by id."""
    places = np.flatnonzero(allowed)
    if len(places) > k:
        mine = scores[places]
        kth = np.partition(mine, len(mine) - k)[len(mine) - k]
        above, equal = places[mine > kth], places[mine == kth]
        need = k - len(above)
        if need < len(equal):
            equal = equal[np.argpartition(ids[equal], need - 1)[:need]]
        places = np.concatenate([above, equal])
    return places[np.lexsort((ids[places], -scores[places]))]


def _search_block(queries: Rows, candidates: Rows, lists: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score) of the k best of a block for each query."""
    ids, ends = candidates.ids, np.cumsum(queries.lengths, dtype=np.int64)
    # no sum on the way to a score is larger than this; numbers of half the bytes take half the time
    most = _most(queries.values) * _most(candidates.values) * int(queries.lengths.max(initial=0))
    fits = most <= np.iinfo(np.int32).max
    scores = np.zeros(len(ids), np.int32 if fits else np.int64)
    product, found = np.zeros_like(scores), []
    for query, length, end in zip(queries.ids, queries.lengths, ends, strict=True):
        values = queries.values[end - length : end]
        scores.fill(0)
        for term in np.flatnonzero(values).tolist():
            rows, weights = lists.get(term, (None, None))
            weight = scores.dtype.type(values[term])
            if rows is not None:
                scores[rows] += weight * weights
            elif weights is not None:
                scores += np.multiply(weights, weight, out=product)
        best = _best(scores, ids, ids != query, k)
        found.append((np.full(len(best), query), ids[best], scores[best].astype(np.int64)))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _blocks(rows: DataFrame, deal: F.Column, least: int, blocks: int, name: str) -> DataFrame:
    """(name, ids, lengths, bytes of a number, numbers): blocks of rows, each alone in a partition.

    ``deal`` differs from row to row, so no id or vector, however common, makes a large block.
    """
    n, cells = rows.agg(F.count("*"), F.sum(F.size("vector").cast("long"))).first()
    size = min(max(least, -(-n // blocks)), max(1, CELLS * n // max(1, cells or 0)))
    many = max(1, -(-n // size))

    kinds = pa.schema([(name, pa.int64()), *BLOCK])

    def packed(block: pa.Table) -> pa.Table:
        vectors = block["vector"].combine_chunks()
        values = _narrowed(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False))
        lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int32, copy=False)
        ids = block["id"].to_numpy().astype(np.int64, copy=False)
        one = [block[name][0].as_py(), ids.tobytes(), lengths.tobytes(), values.itemsize, values.tobytes()]
        return pa.table([[x] for x in one], kinds)

    dealt = rows.withColumn(name, F.pmod(deal, F.lit(many)))
    schema = f"{name} bigint, ids binary, lengths binary, bytes int, numbers binary"
    return dealt.groupBy(name).applyInArrow(packed, schema).repartitionById(many, F.col(name).cast("int"))


def _unpacked(ids: pa.Scalar, lengths: pa.Scalar, size: pa.Scalar, numbers: pa.Scalar) -> Rows:
    read = lambda x, kind: np.frombuffer(x.as_buffer(), kind)
    return Rows(read(ids, np.int64), read(lengths, np.int32), read(numbers, f"i{size.as_py()}"))


def _pairs(candidates: DataFrame, queries: DataFrame, id: str, vector: str) -> DataFrame:
    """Every block of candidates with every block of queries: one pair in a partition."""
    pick = lambda df: df.select(F.col(id).alias("id"), F.col(vector).alias("vector")).dropna()
    any_row = F.xxhash64(F.monotonically_increasing_id())
    c_blocks = _blocks(pick(candidates), any_row, CANDIDATES, CANDIDATE_BLOCKS, "c")
    q_blocks = _blocks(pick(queries).dropDuplicates(), F.xxhash64("id", "vector"), QUERIES, QUERY_BLOCKS, "q")
    asked = q_blocks.select("q", *(F.col(c).alias(f"q_{c}") for c, _ in BLOCK))
    # the stated queries go to every block of candidates; the planner is not to broadcast a side
    return c_blocks.hint("shuffle_replicate_nl").crossJoin(asked)


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query."""
    kinds = pa.schema([(name, pa.int64()) for name in ("query_id", "vec_id", "score", "c")])

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows, lists = None, None, None
        for part in parts:
            for line in zip(*part.columns, strict=True):
                c, own, asked = line[0].as_py(), line[1:5], line[6:]
                if c != current:  # the pairs of a block come one after the other
                    current, rows = c, _unpacked(*own)
                    lists = _postings(rows)
                found = _search_block(_unpacked(*asked), rows, lists, k)
                yield pa.record_batch([*found, np.full(len(found[0]), current)], schema=kinds)

    schema = ", ".join(f"{name} bigint" for name in kinds.names)
    local = _pairs(candidates, queries, id, vector).mapInArrow(search, schema)
    order = [F.desc("score"), F.asc("vec_id")]
    for keys in (["query_id", F.floor(F.col("c") / 64)], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        local = local.withColumn("rank", rank).filter(F.col("rank") <= k)
    return local.select("query_id", "rank", "vec_id", "score")


def op7_top_k(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    whole = scaled_floor(vectors)
    return top_k(whole, whole.filter(F.col("vec_id") % 50 == 0), 5)


ORACLE_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v AS q JOIN v AS c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
