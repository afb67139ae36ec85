"""Best-fit packing of token pieces into sequences under several capacities.

A piece takes tokens, one place in the document count, and attention cost (its
length squared); a sequence has a capacity for each. Longest pieces go first;
among the sequences with room under every capacity a piece takes the best one,
by the weighted norm of what would be left, or by the weighted dot product of the
piece with what is left.

A piece's needs follow from its length, so the number of pieces of each length
says all that the choice depends on. That table has at most ``capacity`` rows
whatever the input; sequences that have the same left are handled as one group
with a count. Choosing is done on it, and each piece then finds its sequence by
its rank among the pieces of its length. Ranks come from counts per task, so no
length, however common, meets in one task.

Defined results: a null text is an empty one; it has its end token alone. Rows
with the same id are packed as they come, each as a document.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from shelfscan.llm.tables import checkpointed



class Capacities(NamedTuple):
    """What a sequence holds; the weights of the three in the choice."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6)
    choose: str = "norm"


class Slot(NamedTuple):
    """``count`` pieces of a length, from a rank on, at ``offset`` of as many sequences from one on."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int


def plan_slots(counts: dict[int, int], caps: Capacities) -> list[Slot]:
    """Where the pieces of each length go. ``counts``: number of pieces by length.

    A group is (tokens, documents, attention left) with runs of sequence numbers.
    """
    groups: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
    slots: list[Slot] = []
    sequences = 0
    for length in sorted(counts, reverse=True):
        need = (length, 1, length * length)
        full = (caps.tokens, caps.documents, caps.attention)
        if any(n > f for n, f in zip(need, full, strict=True)):
            raise ValueError(f"a piece of {length} tokens is over a capacity")
        left, rank = counts[length], 0
        scale = [w / (f * f) for w, f in zip(caps.weights, full, strict=True)]

        def merit(r: tuple[int, int, int], need=need, scale=scale) -> tuple[float, tuple[int, int, int]]:
            if caps.choose == "dot":
                return -sum(s * n * x for s, n, x in zip(scale, need, r, strict=True)), r
            return sum(s * (x - n) ** 2 for s, n, x in zip(scale, need, r, strict=True)), r

        fitting = [r for r in groups if all(n <= x for n, x in zip(need, r, strict=True))]
        queue = [(merit(r), r) for r in fitting]
        heapq.heapify(queue)
        while left:
            if queue:
                r = heapq.heappop(queue)[1]
                runs = groups.pop(r)
            else:
                # as many new sequences as these pieces fill, at best
                each = min(f // n for f, n in zip(full, need, strict=True))
                new = -(-left // each)
                r, runs = full, [(sequences, new)]
                sequences += new
            rest = tuple(x - n for x, n in zip(r, need, strict=True))
            placed, kept = [], []
            for first, many in runs:
                take = min(many, left)
                if take:
                    slots.append(Slot(length, rank, take, first, caps.tokens - r[0]))
                    placed.append((first, take))
                    rank, left = rank + take, left - take
                if many > take:
                    kept.append((first + take, many - take))
            if kept:
                groups.setdefault(r, []).extend(kept)
            if placed:
                known = rest in groups
                groups.setdefault(rest, []).extend(placed)
                if not known and all(n <= x for n, x in zip(need, rest, strict=True)):
                    heapq.heappush(queue, (merit(rest), rest))
    return slots


#: The splitting pattern that a byte-level tokenizer file means by ``use_regex``.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level tokenizer files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _ranks(model: dict) -> dict[bytes, int] | None:
    """Bytes to id, if every merge makes the next free id: then merging by rank is what the file says."""
    letters = _byte_letters()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    vocabulary = model["vocab"]
    if any(vocabulary.get(a + b) != 256 + i for i, (a, b) in enumerate(pairs)):
        return None
    known = {t: i for t, i in vocabulary.items() if i < 256 + len(pairs)}
    if len(known) != 256 + len(pairs):
        return None
    return {bytes(letters[c] for c in t): i for t, i in known.items()}


class _Tokens:
    """Ids of texts as a tokenizer file gives them.

    A byte-level BPE file whose ids are its merge ranks is run by the rank encoder,
    several times as fast as the general one and with the same ids (tested); any
    other file, and a text with a special token's string, by the general one.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        before, model = parts.get("pre_tokenizer") or {}, parts["model"]
        plain = model["type"] == "BPE" and not parts.get("normalizer") and before.get("type") == "ByteLevel"
        plain = plain and not before.get("add_prefix_space") and before.get("use_regex", True)
        plain = plain and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix"))
        ranks = _ranks(model) if plain else None
        self.fast = ranks and tiktoken.Encoding("file", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if self.fast and not any(s in text for s in self.special):
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


_TOKENS: dict[str, _Tokens] = {}


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = 0, text: str = "text") -> DataFrame:
    """The pieces of each document: (doc_id, piece, start, length, ids_crc32, task, place).

    ``place`` numbers the pieces of one length within a task. The result is only
    stable once written: callers checkpoint it.
    """
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, place bigint"
    end = np.array([end_id], "<u4").tobytes()

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _TOKENS.setdefault(path, _Tokens(path)) if path not in _TOKENS else _TOKENS[path]
        task, seen = TaskContext.get().partitionId(), {}
        for part in parts:
            rows = []
            for doc_id, body in zip(part["doc_id"], part["text"], strict=True):
                ids = memoryview((encode(body) if isinstance(body, str) else b"") + end)
                total = len(ids) // 4
                start, number, length = 0, 0, (total - 1) % capacity + 1
                while start < total:
                    place = seen[length] = seen.get(length, -1) + 1
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, number, start, length, crc, task, place))
                    start, number, length = start + length, number + 1, capacity
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "task", "place"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInPandas(run, schema)


def pack(pieces: DataFrame, caps: Capacities = Capacities()) -> DataFrame:
    """``pieces`` (written or checkpointed, with length, task and place) with their sequence and offset."""
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    by_task = by_task.withColumn("before", before)
    # at most `capacity` rows
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan_slots(counts, caps)
    spark = pieces.sparkSession
    columns = ["length", "rank", "count", "sequence", "offset"]
    by_length = {
        length: rows.sort_values("rank")
        for length, rows in pd.DataFrame(slots, columns=columns, dtype="int64").groupby("length")
    }
    starts = {k: v.to_numpy() for k, v in by_length.items()}
    shared = spark.sparkContext.broadcast(starts)
    kept = [c for c in pieces.columns if c not in ("task", "place", "sequence_id", "offset")]
    ranked = pieces.join(by_task.drop("n"), ["length", "task"]).withColumn("rank", F.col("before") + F.col("place"))
    schema = pieces.select(*kept).schema.add("sequence_id", "long").add("offset", "long")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            sequence, offset = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            rank = part["rank"].to_numpy()
            for length, rows in part.groupby("length").indices.items():
                table = shared.value[length]
                slot = table[np.searchsorted(table[:, 1], rank[rows], "right") - 1]
                sequence[rows] = slot[:, 3] + rank[rows] - slot[:, 1]
                offset[rows] = slot[:, 4]
            yield part[kept].assign(sequence_id=sequence, offset=offset)

    return ranked.select(*kept, "rank").mapInPandas(run, schema)


def pack_documents(docs: DataFrame, path: str, caps: Capacities = Capacities(), text: str = "text") -> DataFrame:
    """The packed pieces of ``docs``. Only piece records are written, never token ids."""
    pieces = token_pieces(docs, path, caps.tokens, text=text)
    return pack(checkpointed(pieces), caps)


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
