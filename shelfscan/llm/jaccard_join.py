"""Jaccard self-join of word shingles by partitioning the universe of shingles.

Two sets of sizes r and s with a Jaccard similarity of at least t differ in at most
(1 - t) / (1 + t) * (r + s) elements. Sizes are cut into bands so that linked sets
stand in one band or in neighbouring ones, and every two neighbouring bands form a
group. In a group the universe is dealt by hash into more segments than the sets
may differ in; two linked sets then have whole segments in common. Each set sends a
key for the part of it that falls into a segment (its segment subset).

Allocation. Some keys cost too much: an empty segment says nothing, and a subset
that very many unlike sets share gives too many pairs. A group therefore has spare
segments, and a set leaves out as many keys as it has spare ones: its empty
segments, then those with the largest buckets. Two linked sets have more than the
spare number of segments in common, and the cheapest of these neither leaves out. A
set with more empty segments than spare ones also sends, for the first segments
that make up for it, the keys of all subsets with one element deleted, which finds
segments that differ by one.

Pairs. Sets that are equal are one node. In every bucket of a key each node is
first paired with one centre only, the first in one of a few orders of all nodes, so
that a large group meets several centres; the pairs that hold are joined into
components. Then all pairs of a bucket whose components still differ are looked at,
for the keys that are not left out; buckets with the same nodes count once. They are
looked at where the bucket's rows lie, a large bucket in blocks, by size and by bitmaps of the
elements: pairs that differ by too much can't be linked and never become rows. The
rest is verified on the sets themselves. No pair between different components is
left out, so components are exact.

Elements and nodes are compared by 64-bit hashes.

Defined results: null texts and texts without words have no shingle and no link;
fewer words than a shingle has make one element. Rows with the same id and different
texts are nodes of their own; each gets its own row. Rows without an id are linked by
their texts as others are; a component's id is the least one that any of its rows has,
and null where none has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfscan.llm.components import components
from shelfscan.llm.tables import batches_of, checkpointed, written
from shelfscan.llm.words import Words, blocks, mix, runs, words_of

#: Words of a shingle; similarity in percent.
SHINGLE, PERCENT = 5, 80

#: Orders of nodes by which buckets choose their centres.
CENTRES = 4

#: Rows handed to Python at once.
BATCH = 1000

#: Nodes of a block of a bucket, and pairs whose bitmaps are compared at once.
CROWD, PAIRS = 1024, 1 << 15

#: Bits of a node's bitmap.
BITS = 1024

#: Bits, at least and at most, of the filter that keeps most texts without need from being sent (1 to 16 MB).
FILTER_BITS = 1 << 23, 1 << 27

_U = np.uint64


def bands(percent: int, most: int) -> np.ndarray:
    """Least size of each band, up to ``most``: a set's partners are at most one band away."""
    out = [1]
    while out[-1] <= most:
        out.append(out[-1] * 100 // percent + 1)
    out.append(out[-1] * 100 // percent + 1)
    return np.array(out)


def segments(starts: np.ndarray, group: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(segments, spare ones) of groups: band ``group`` with the next."""
    low = starts[group + 1] - 1
    # the sizes of a pair add up to at most low and low / t
    differ = (100 - percent) * (low + low * 100 // percent) // (100 + percent)
    spare = 2 + (differ + 1) // 4
    return differ + 1 + spare, spare


def sets_of(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(elements, first): each text's distinct shingles in order, and where a text's begin."""
    hashes, whole = runs(words, shingle)
    text = words.text
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < shingle))
    elements, owner = hashes[whole], text[whole]
    if len(short):
        extra = np.zeros(len(short), _U)
        for n in range(1, shingle):
            mine = counts[short] == n
            extra[mine] = runs(words, n)[0][words.first[short[mine]]]
        elements, owner = np.concatenate([elements, extra]), np.concatenate([owner, short])
    order = np.lexsort((elements, owner))
    elements, owner = elements[order], owner[order]
    new = np.ones(len(elements), bool)
    new[1:] = (elements[1:] != elements[:-1]) | (owner[1:] != owner[:-1])
    elements, owner = elements[new], owner[new]
    return elements, np.searchsorted(owner, np.arange(len(counts) + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return total[first[1:]] - total[first[:-1]]


def _nodes(elements: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A number for every set, equal for equal sets."""
    size = np.diff(first).astype(_U)
    return mix(_sums(mix(elements ^ _U(0x5851F42D4C957F2D)), first) + mix(size)).view(np.int64)


def _bitmaps(elements: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Parity of the elements at each of ``BITS`` places: sets differ in at least as many elements as bits."""
    texts = len(first) - 1
    owner = np.repeat(np.arange(texts), np.diff(first))
    place = (mix(elements ^ _U(0x2545F4914F6CDD1D)) % _U(BITS)).astype(np.int64)
    odd = np.bincount(owner * BITS + place, minlength=texts * BITS).reshape(texts, BITS) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)


class _Groups:
    """Which segment each element falls into, for the two groups of every set."""

    def __init__(self, elements: np.ndarray, first: np.ndarray, lower: bool, percent: int):
        size = np.diff(first)
        starts = bands(percent, int(size.max(initial=1)))
        band = np.searchsorted(starts, size, "right") - 1
        self.group = band - lower
        self.used = (size > 0) & (self.group >= 0)
        group = np.maximum(self.group, 0)
        self.many, self.spare = segments(starts, group, percent)
        self.many = np.where(self.used, self.many, 0)
        self.base = np.concatenate([[0], np.cumsum(self.many)])
        owner = np.repeat(np.arange(len(size)), size)
        mine = self.used[owner]
        self.elements, self.owner = elements[mine], owner[mine]
        salt = mix(group.astype(_U) + _U(17))[self.owner]
        self.values = mix(self.elements ^ salt)
        segment = (self.values >> _U(11)) % np.maximum(self.many, 1).astype(_U)[self.owner]
        self.at = self.base[self.owner] + segment.astype(np.int64)
        self.count = np.bincount(self.at, minlength=self.base[-1])
        self.sum = np.zeros(self.base[-1], _U)
        np.add.at(self.sum, self.at, self.values)
        self.owner_of = np.repeat(np.arange(len(size)), self.many)
        self.number = np.arange(self.base[-1]) - self.base[self.owner_of]
        empty = np.concatenate([[0], np.cumsum(self.count == 0)])
        self.empty = empty[self.base[1:]] - empty[self.base[:-1]]

    def key(self, at: np.ndarray, sums: np.ndarray) -> np.ndarray:
        group = self.group[self.owner_of[at]].astype(_U)
        return mix(sums + mix(group * _U(1 << 32) + self.number[at].astype(_U))).view(np.int64)

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(owner, key) of all that the sets send."""
        at = np.flatnonzero(self.count)
        owners, keys = [self.owner_of[at]], [self.key(at, self.sum[at])]
        lack = np.maximum(self.empty - self.spare, 0)
        if lack.any():
            filled = np.concatenate([[0], np.cumsum(self.count > 0)])
            # filled segments of the same set up to and with each
            rank = filled[1:] - filled[self.base[self.owner_of]]
            before = rank - (self.count > 0) < lack[self.owner_of]
            gaps = np.flatnonzero(before & (self.count == 0))
            owners.append(self.owner_of[gaps])
            keys.append(self.key(gaps, self.sum[gaps]))
            mine = before[self.at]
            owners.append(self.owner[mine])
            keys.append(self.key(self.at[mine], self.sum[self.at[mine]] - self.values[mine]))
        return np.concatenate(owners), np.concatenate(keys)


def _each(shingle: int, make):
    """mapInArrow function: ``make(ids, elements, first)`` gives the columns of a block of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, data, offsets in blocks(batch.column("text")):
                elements, first = sets_of(words_of(data, offsets, lower=True), shingle)
                columns = make(batch.column("doc_id").slice(at, end - at), elements, first)
                if len(next(iter(columns.values()))):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

    return run


def _fixed(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    flat = pa.py_buffer(np.ascontiguousarray(rows).tobytes())
    offsets = pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int32) * width).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, flat])


def documents_of(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, node, bits, empty_0, empty_1, spare_0, spare_1) of each row."""

    def make(ids, elements, first):
        own, low = (_Groups(elements, first, lower, percent) for lower in (False, True))
        return {
            "doc_id": ids,
            "n_shingles": np.diff(first).astype(np.int64),
            "node": _nodes(elements, first),
            "bits": _fixed(_bitmaps(elements, first)),
            "empty_0": own.empty.astype(np.int32),
            "empty_1": low.empty.astype(np.int32),
            "spare_0": own.spare.astype(np.int32),
            "spare_1": low.spare.astype(np.int32),
        }

    schema = (
        "doc_id bigint, n_shingles bigint, node bigint, bits binary, "
        "empty_0 int, empty_1 int, spare_0 int, spare_1 int"
    )
    return docs.select("doc_id", "text").mapInArrow(_each(shingle, make), schema)


def keys_of(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(key, node, low): the keys of each text; low: in the group with the band below."""

    def make(ids, elements, first):
        nodes, parts = _nodes(elements, first), []
        for lower in (False, True):
            owner, key = _Groups(elements, first, lower, percent).rows()
            parts.append((key, nodes[owner], np.full(len(key), lower)))
        key, node, low = (np.concatenate(x) for x in zip(*parts, strict=True))
        return {"key": key, "node": node, "low": low}

    return docs.select("doc_id", "text").mapInArrow(_each(shingle, make), "key bigint, node bigint, low boolean")


def _needed_filter(needed: DataFrame) -> np.ndarray:
    """A bit for each id modulo the filter's bits: some 16 for each id, within ``FILTER_BITS``."""
    least, most = FILTER_BITS
    bits = least
    wanted = 16 * needed.count()
    while bits < wanted and bits < most:
        bits *= 2
    known = F.coalesce("doc_id", F.lit(0))  # as in may_be_needed
    place, bit = F.pmod(known, F.lit(bits)), F.pmod(known, F.lit(64)).cast("int")
    words = needed.select(F.floor(place / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return out


def _needed_sets(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """(node, elements) of the texts whose ids are needed, and of few others.

    One worker a task leaves texts out and makes the sets: two would double what an executor's workers hold.
    """
    filter_bits = docs.sparkSession.sparkContext.broadcast(_needed_filter(needed))

    def may_be_needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(0))
            place = ids % (64 * len(filter_bits.value))
            yield batch.filter(pa.array((filter_bits.value[place >> 6] >> (ids & 63)) & 1 == 1))

    def make(ids, elements, first):
        raw, bounds = elements.tobytes(), (8 * first).tolist()
        sets = [raw[bounds[i] : bounds[i + 1]] for i in range(len(first) - 1)]
        return {"node": _nodes(elements, first), "elements": pa.array(sets, pa.binary())}

    each = _each(shingle, make)
    return docs.select("doc_id", "text").mapInArrow(lambda x: each(may_be_needed(x)), "node bigint, elements binary")


def _verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are linked."""
    side = lambda x: nodes.select(*[F.col(c).alias(f"{c}_{x}") for c in ("node", "n_shingles", "bits", "doc_id")])
    rows = pairs.withColumnsRenamed({"a": "node_a", "b": "node_b"}).join(side("a"), "node_a").join(side("b"), "node_b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = [np.asarray(batch.column(f"n_shingles_{x}")) for x in "ab"]
            keep = _near(*sizes, *[_words_of_bits(batch.column(f"bits_{x}")) for x in "ab"], percent)
            names = ["node_a", "node_b", "doc_id_a", "doc_id_b"]
            yield batch.select(names).filter(pa.array(keep))

    schema = "node_a bigint, node_b bigint, doc_id_a bigint, doc_id_b bigint"
    likely = written(rows.mapInArrow(near, schema), "pairs")
    needed = likely.select(F.col("doc_id_a").alias("doc_id"), F.col("node_a").alias("node")).union(
        likely.select("doc_id_b", "node_b")
    )
    needed = needed.distinct()
    # sets are dealt out once, by node: equal sets are one, whichever text it is from
    sets = _needed_sets(docs, needed, shingle).join(needed.select("node").distinct(), "node", "left_semi").dropDuplicates(["node"])
    with_a = likely.select("node_a", "node_b").join(
        sets.select(F.col("node").alias("node_a"), F.col("elements").alias("e_a")), "node_a"
    )
    with_b = with_a.join(sets.select(F.col("node").alias("node_b"), F.col("elements").alias("e_b")), "node_b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("e_a"), batch.column("e_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            out = batch.select(["node_a", "node_b"]).filter(pa.array(keep, pa.bool_()))
            yield out.rename_columns(["a", "b"])

    return checkpointed(with_b.mapInArrow(exact, "a bigint, b bigint"))


def _near(a: np.ndarray, b: np.ndarray, bits_a: np.ndarray, bits_b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sets may be linked, by their sizes and bitmaps (as 64-bit words)."""
    differ = np.bitwise_count(bits_a ^ bits_b).sum(axis=1, dtype=np.int64)
    return ((100 + percent) * differ <= (100 - percent) * (a + b)) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))


def _words_of_bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _U).reshape(len(column), -1)


def _pairs_of_runs(firsts: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (p, q), p < q, of all pairs of rows of one run; runs begin at ``firsts`` of n rows."""
    ends = np.append(firsts[1:], n)
    behind = np.repeat(ends, ends - firsts) - np.arange(n) - 1  # rows of the run that follow
    total = np.cumsum(behind)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + PAIRS, "right")))
        p = np.repeat(np.arange(at, end), behind[at:end])
        begins = np.repeat(total[at:end] - behind[at:end], behind[at:end])
        yield p, p + 1 + np.arange(len(p)) + (total[at - 1] if at else 0) - begins
        at = end


def _crossing(percent: int):
    """mapInArrow function over rows sorted by (same, unit): pairs of nodes that may be linked."""

    def found(rows: dict[str, np.ndarray]) -> pa.RecordBatch | None:
        n = len(rows["node"])
        new = np.ones(n, bool)
        new[1:] = (rows["same"][1:] != rows["same"][:-1]) | (rows["unit"][1:] != rows["unit"][:-1])
        parts = []
        for p, q in _pairs_of_runs(np.flatnonzero(new), n):
            # two blocks meet: pairs inside one of them are looked at where it is alone
            mine = (rows["root"][p] != rows["root"][q]) & ((rows["side"][p] != rows["side"][q]) | rows["alone"][p])
            p, q = p[mine], q[mine]
            keep = _near(rows["n"][p], rows["n"][q], rows["bits"][p], rows["bits"][q], percent)
            a, b = rows["node"][p[keep]], rows["node"][q[keep]]
            parts.append((np.minimum(a, b), np.maximum(a, b)))
        if not any(len(a) for a, _ in parts):
            return None
        a, b = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            names = ("same", "unit", "side", "alone", "node", "root", "n")
            rows = {c: np.asarray(batch.column(c)) if c != "alone" else np.array(batch.column(c).to_pylist(), bool) for c in names}
            rows["bits"] = _words_of_bits(batch.column("bits"))
            if rest is not None:
                rows = {c: np.concatenate([rest[c], v]) for c, v in rows.items()}
            # the last run may go on in the next batch
            last = (rows["same"] == rows["same"][-1]) & (rows["unit"] == rows["unit"][-1])
            cut = int(np.argmax(last))
            rest = {c: v[cut:] for c, v in rows.items()}
            if cut and (out := found({c: v[:cut] for c, v in rows.items()})):
                yield out
        if rest is not None and (out := found(rest)):
            yield out

    return run


def _crossing_pairs(looked_at: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of one bucket but different roots that may be linked.

    ``looked_at``: (same, size, node, root). A bucket of more than ``CROWD`` nodes is dealt
    into blocks, and every two blocks meet in a unit of their own.
    """
    many = F.ceil(F.col("size") / CROWD).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(7)), many).cast("int")
    dealt = looked_at.select("same", "node", "root", many.alias("many"), block.alias("side"))
    other = F.explode(F.sequence(F.lit(0), F.col("many") - 1))
    units = dealt.select("*", other.alias("other")).select(
        "same", "node", "root", "side", (F.col("side") == F.col("other")).alias("alone"),
        (F.least("side", "other").cast("long") * F.col("many") + F.greatest("side", "other")).alias("unit"),
    )
    sets = nodes.select("node", F.col("n_shingles").alias("n"), "bits")
    rows = units.join(sets, "node").repartition("same", "unit").sortWithinPartitions("same", "unit")
    return rows.mapInArrow(_crossing(percent), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row."""
    with batches_of(docs.sparkSession, BATCH):
        return _near_duplicates(docs, shingle, percent)


def _near_duplicates(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    texts = docs.select("doc_id", "text")
    rows = written(documents_of(texts, shingle, percent), "sets")
    # a row with an id stands for its node where there is one
    first = F.struct(
        F.col("doc_id").isNull().alias("no_id"), "doc_id", "n_shingles", "bits", "empty_0", "empty_1", "spare_0", "spare_1"
    )
    nodes = rows.filter("n_shingles > 0").groupBy("node").agg(F.min(first).alias("x")).select("node", "x.*").drop("no_id")

    keys = keys_of(texts, shingle, percent).repartition("key").distinct()
    same = Window.partitionBy("key")
    order = F.xxhash64("node", F.pmod(F.col("key"), F.lit(CENTRES)))
    buckets = keys.withColumns({
        "least": F.min("node").over(same), "most": F.max("node").over(same), "centre": F.min_by("node", order).over(same),
    })
    buckets = written(buckets.filter("least < most").drop("least", "most"), "buckets")

    ends = [f("centre", "node") for f in (F.least, F.greatest)]
    stars = buckets.filter("node <> centre").select(ends[0].alias("a"), ends[1].alias("b")).distinct()
    links = _verified(texts, nodes, stars, shingle, percent)
    roots = checkpointed(components(links))

    # what is left: buckets with nodes of more than one component
    members = buckets.select("key", "node", "low").join(roots, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node"))
    # buckets with the same nodes have the same pairs: one number for all of them
    nodes_of = F.xxhash64(F.count("*"), F.bit_xor(F.xxhash64("node")))
    mixed = members.groupBy("key").agg(
        F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size"), nodes_of.alias("same")
    ).filter("x < y")
    members = written(members.join(mixed.select("key", "size", "same"), "key"), "mixed")
    choice = lambda name: F.when(F.col("low"), F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
    costliest = Window.partitionBy("node", "low").orderBy(F.desc("size"), "key")
    ranked = members.withColumn("place", F.row_number().over(costliest)).join(nodes.drop("bits"), "node")
    looked_at = ranked.filter(F.col("place") > F.greatest(choice("spare") - choice("empty"), F.lit(0)))
    crossing = _crossing_pairs(looked_at.select("same", "size", "node", "root").distinct(), nodes, percent)
    more = _verified(texts, nodes, crossing, shingle, percent)

    roots = components(links.union(more))
    placed = rows.filter("n_shingles > 0").select("doc_id", "node").join(
        roots.select("node", "root"), "node", "left"
    ).withColumn("root", F.coalesce("root", "node"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = placed.select("node", "root").distinct().join(least, "root").select("node", "component_id")
    known = rows.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    return known.join(classes, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def op6_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
