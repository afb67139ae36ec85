"""Ranked lexical search by the Best Position Algorithm.

A document's score for an item is the sum, over the item's terms, of the term's weight
and the document's impact for it (a damped share of the term in the document, in
whole numbers). Documents are indexed in shards: per term the documents that have it.
Only terms that some item may ask for are indexed; a filter of fixed size says which.

A shard answers an item over its impact lists, each in falling order. Positions are
read from the top of all lists, some at a time; a document met for the first time is
looked up in the other lists (direct accesses), which marks its positions there as
seen too. The best position of a list is the last one up to which all are seen. No
document that was never met can score more than the sum of the impacts at the best
positions; once that sum is strictly below the k-th best score so far, the shard's best k are
known. (A last-read position would be less deep, and the threshold less tight.) The
bests of all shards are merged, first by groups of shards.

Counts of documents, terms and documents by term cover the whole table. Every block
of items meets every shard; a task holds one shard and one block of items.

Terms are the longest runs of letters and digits of ASCII, of which A-Z are lower-cased, and
of all characters beyond ASCII. Ties go to the smaller id. Defined results: null and
empty texts, and texts without a term, have no terms, and as items no results.
Documents without an id count in all statistics and are not ranked; rows of one id
are documents of their own, so an id may be listed twice. Items equal in id and text
are asked once; items of one id and different texts, or without an id, each for
themselves. An empty table of documents or items gives an empty result. Texts of any
length are cut into terms whole. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfscan.llm.tables import written

#: Characters of a term, for SQL and as bytes of UTF-8 in lower case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = bytes.maketrans(_UPPER.encode(), _LOWER.encode())

#: Share of a document's length in its damping, in percent; what impacts are scaled by.
SHARE, SCALE = 90, 1_000_000_000

#: Most postings and documents of a shard; terms of a block of items.
POSTINGS, DOCUMENTS, TERMS = 1 << 21, 1 << 19, 1 << 16

#: Bits of the filter of asked terms (1 MB, whatever the input).
FILTER_BITS = 1 << 23

#: Positions of each list read at first; each time as many again.
STEP = 16

INDEX = (
    "shard bigint, n_docs bigint, n_terms bigint, vocabulary array<string>, having array<int>, "
    "ids binary, lengths binary, places binary, counts binary"
)


def item_terms(items: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, term): the different terms of each item."""
    lowered = F.translate(text, _UPPER, _LOWER)
    found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)))
    rows = items.select(F.col(id).alias("item_id"), F.xxhash64(id, F.col(id).isNull(), text).alias("item"), found.alias("terms"))
    return rows.dropDuplicates(["item"]).select("item", "item_id", F.explode("terms").alias("term"))


def _filter(terms: DataFrame) -> bytes:
    """A bit for each term's checksum modulo ``FILTER_BITS``; of fixed size."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(FILTER_BITS))
    bit = F.call_function("shiftleft", F.lit(1), F.pmod(place, F.lit(8)).cast("int"))
    found = terms.select(F.floor(place / 8).alias("byte"), bit.alias("bit")).groupBy("byte").agg(F.bit_or("bit").alias("bits"))
    out = bytearray(FILTER_BITS // 8)
    for row in found.collect():
        out[row["byte"]] = row["bits"]
    return bytes(out)


class _Shard:
    """Postings of the documents read so far."""

    def __init__(self) -> None:
        self.ids, self.lengths = array("q"), array("q")
        self.lists: dict[bytes, tuple[array, array]] = {}
        self.postings = self.n_docs = self.n_terms = 0

    def add(self, id: int | None, counts: Counter, asked: bytes) -> None:
        n = counts.total()
        if not n:
            return
        self.n_docs += 1
        self.n_terms += n
        # a document without an id is counted by term too; it is known by a length of zero
        place = len(self.ids)
        self.ids.append(0 if id is None else id)
        self.lengths.append(0 if id is None else n)
        for term, count in counts.items():
            at = zlib.crc32(term) % FILTER_BITS
            if asked[at >> 3] >> (at & 7) & 1:
                found = self.lists.get(term)
                if found is None:
                    found = self.lists[term] = (array("i"), array("i"))
                found[0].append(place)
                found[1].append(count)
                self.postings += 1

    def row(self, number: int) -> pa.RecordBatch:
        lists = list(self.lists.values())
        values = [
            number, self.n_docs, self.n_terms, [t.decode() for t in self.lists], [len(p) for p, _ in lists],
            self.ids.tobytes(), self.lengths.tobytes(), b"".join(p.tobytes() for p, _ in lists), b"".join(c.tobytes() for _, c in lists),
        ]
        types = [pa.int64()] * 3 + [pa.list_(pa.string()), pa.list_(pa.int32())] + [pa.binary()] * 4
        names = [x.split()[0] for x in INDEX.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)


def index_of(docs: DataFrame, asked: bytes, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The shards of ``docs``: statistics, terms that may be asked for and their postings."""
    known = docs.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, shard = TaskContext.get().partitionId() << 32, 0, _Shard()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for i, raw in zip(ids, texts, strict=True):
                if raw.is_valid:
                    shard.add(i, Counter(_TERM_BYTES.findall(raw.as_py().translate(_TO_LOWER))), known.value)
                if shard.postings >= POSTINGS or shard.n_docs >= DOCUMENTS:
                    yield shard.row(first + made)
                    made, shard = made + 1, _Shard()
        if shard.n_docs:
            yield shard.row(first + made)

    return docs.select(F.col(id), F.col(text)).mapInArrow(run, INDEX)


class Lists:
    """Impact lists of a shard's terms, made when first asked for."""

    def __init__(self, shard, n: int, total: int):
        ends = np.concatenate([[0], np.cumsum(np.asarray(shard.having, np.int64))])
        self.span = {t: (ends[i], ends[i + 1]) for i, t in enumerate(shard.vocabulary)}
        self.ids, lengths = (np.frombuffer(x, np.int64) for x in (shard.ids, shard.lengths))
        self.places, self.counts = (np.frombuffer(x, np.int32) for x in (shard.places, shard.counts))
        self.ranked = lengths > 0
        self.damping = 100 - SHARE + (SHARE * lengths * n) // max(total, 1)
        self.made: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}

    def of(self, term: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(documents by falling impact, impacts, documents in order, their positions in the list)."""
        if term not in self.span:
            return None
        if term not in self.made:
            a, b = self.span[term]
            places, counts = self.places[a:b], self.counts[a:b].astype(np.int64)
            mine = self.ranked[places]
            places, counts = places[mine], counts[mine]
            impacts = (SCALE * counts) // (1000 * counts + 8 * self.damping[places])
            order = np.argsort(-impacts, kind="stable")
            positions = np.empty(len(order), np.int64)
            positions[order] = np.arange(len(order))
            self.made[term] = places[order], impacts[order], places, positions
        return self.made[term]


def best_positions(lists: list[tuple], weights: list[int], ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, positions read): the k best documents over weighted impact lists, all in falling order."""
    kept = [(x, w) for x, w in zip(lists, weights, strict=True) if x is not None and w > 0 and len(x[0])]
    lists, weights = [x for x, _ in kept], [w for _, w in kept]
    seen = [np.zeros(len(x[0]), bool) for x in lists]
    bests = [0] * len(lists)  # positions up to which all are seen
    met, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    done, depth, read = np.zeros(len(ids), bool), 0, 0
    while lists:
        step = max(STEP, depth)
        new = np.unique(np.concatenate([x[0][depth : depth + step] for x in lists]))
        read += sum(len(x[0][depth : depth + step]) for x in lists)
        depth += step
        new = new[~done[new]].astype(np.int64)
        done[new] = True
        totals = np.zeros(len(new), np.int64)
        for (_, impacts, places, positions), weight, mark in zip(lists, weights, seen, strict=True):
            at = np.minimum(np.searchsorted(places, new), len(places) - 1)
            has = places[at] == new
            found = positions[at[has]]
            totals[has] += weight * impacts[found]
            mark[found] = True
        met, scores = np.concatenate([met, new]), np.concatenate([scores, totals])
        if len(met) > k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            stay = scores >= kth
            met, scores = met[stay], scores[stay]
        for i, mark in enumerate(seen):
            ahead = mark[bests[i] :]
            bests[i] += int(np.argmin(ahead)) if not ahead.all() else len(ahead)
        # the most that a document not met can have: it stands behind the best position of every list
        most = sum(w * int(x[1][b]) for x, w, b in zip(lists, weights, bests, strict=True) if b < len(x[0]))
        if most == 0 or len(met) >= k and most < int(scores.min()):
            break
    scores_left = scores > 0
    met, scores = met[scores_left], scores[scores_left]
    order = np.lexsort((ids[met], -scores))[:k]
    return met[order], scores[order], read


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    terms = written(item_terms(items), "terms")
    index = written(index_of(docs, _filter(terms)), "index")
    counted = index.agg(F.count("*").alias("shards"), F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    many, n, total = counted["shards"], counted["n"] or 0, counted["total"] or 0

    pair = F.explode(F.arrays_zip("vocabulary", "having")).alias("x")
    having = index.select(pair).groupBy(F.col("x.vocabulary").alias("term")).agg(F.sum("x.having").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("long")
    weighted = terms.join(having, "term").withColumn("weight", weight)
    asked = weighted.groupBy("item", "item_id").agg(F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights"))
    asked = written(asked, "asked")
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0

    # the stated items go to every shard; bucket: shards dealt into as many buckets as there are shards
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, -(-size // TERMS)))).alias("block")
    lists = [F.collect_list(c).alias(c) for c in ("item", "terms", "weights")]
    item_blocks = asked.groupBy(block).agg(*lists)
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(many - 1, 0)).cast("long")))
    shards = index.withColumn("bucket", F.pmod(F.xxhash64("shard"), F.lit(max(many, 1))))
    shards = shards.select("bucket", "shard", "vocabulary", "having", "ids", "lengths", "places", "counts")
    # never broadcast: one copy of the items for each bucket is more than the planner sees
    pairs = shards.join(item_blocks.drop("block").select("*", numbers.alias("bucket")).hint("merge"), "bucket")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current = lists = None
        for part in parts:
            for row in part.itertuples(index=False):
                if row.shard != current:
                    current, lists = row.shard, Lists(row, n, total)
                out = []
                for item, terms_, weights in zip(row.item, row.terms, row.weights, strict=True):
                    found, scores, _ = best_positions([lists.of(t) for t in terms_], list(map(int, weights)), lists.ids, k)
                    out += [(item, i, s, current) for i, s in zip(lists.ids[found].tolist(), scores.tolist(), strict=True)]
                yield pd.DataFrame(out, columns=["item", "doc_id", "score", "shard"])

    best = pairs.mapInPandas(run, "item bigint, doc_id bigint, score bigint, shard bigint")
    for keys in (["item", F.pmod(F.xxhash64("shard"), F.lit(max(1, many // 64)))], ["item"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "doc_id")
        best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return search(docs, items)


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents WHERE text IS NOT NULL
), i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), t AS (
    SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term
), n AS (
    SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM t GROUP BY doc_id
), g AS (
    SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM n
), w AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(g.N) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM t CROSS JOIN g GROUP BY term
), m AS (
    SELECT doc_id, 100 - 90 + (90 * n.n * g.N) // g.L AS m FROM n CROSS JOIN g
), s AS (
    SELECT i.item_id, t.doc_id, CAST(sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * m.m))) AS BIGINT) AS score
    FROM i JOIN t USING (term) JOIN w USING (term) JOIN m USING (doc_id)
    GROUP BY i.item_id, t.doc_id
), r AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10
"""
