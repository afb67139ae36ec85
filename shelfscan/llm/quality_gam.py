"""A quality classifier: a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins and has a table with a value per bin;
chosen pairs of features have tables over two cuts. Tables are learnt by cyclic
boosting: in turn, each feature gets a shallow tree fitted to what is still
unexplained, and a small step of it is added to its table. Pairs follow, those
first whose interaction explains most. A score is the sum of the looked-up values,
made a probability.

Features come from the text alone and cost one pass over it. The model is a few
tables; it is fitted on the driver from features of at most ``sample`` labelled
rows, chosen by a hash of their ids. Everything is scored.

Defined results: null texts count as empty; rows whose label is null are not
learnt from; without rows of both labels the score is the share of label 1 (a half
without any row).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

FEATURES = [
    "log_words", "word_length", "capitals", "digits", "symbols", "exclamations", "other_marks", "line_ends",
    "non_ascii", "distinct_words", "same_as_before", "top_word", "repeated_lines", "log_line_words",
]

#: Labelled rows fitted on at most, bins of a feature, bins of each side of a pair.
SAMPLE, BINS, PAIR_BINS = 20_000, 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS, RATE, LEAVES = 150, 60, 6, 0.1, 4


def _kinds() -> np.ndarray:
    kinds = np.zeros((256, 7))
    kinds[ord("A") : ord("Z") + 1, 0] = 1
    kinds[ord("0") : ord("9") + 1, 1] = 1
    for c in b"#*$%&|<>":
        kinds[c, 2] = 1
    kinds[ord("!"), 3] = 1
    for c in b"\"'(),-./:;?@[]_{}~=+^`\\":
        kinds[c, 4] = 1
    kinds[ord("\n"), 5] = 1
    kinds[128:, 6] = 1
    return kinds


_KINDS = _kinds()


def features(text: str | None) -> list[float]:
    """The numbers of :data:`FEATURES`."""
    text = text or ""
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256) @ _KINDS
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    often = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    before = sum(map(str.__eq__, words, words[1:]))
    return [
        float(np.log1p(n)),
        chars / n,
        *(counts[:5] / chars),
        counts[5] / n,
        counts[6] / chars,
        len(often) / n**0.9,
        before / n,
        max(often.values()) / n,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


class Model(NamedTuple):
    """Cuts and tables of features, and of pairs of them."""

    base: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            out += table[np.searchsorted(cuts, x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            row = np.searchsorted(self.pair_cuts[a], x[:, a], "right")
            out += table[row, np.searchsorted(self.pair_cuts[b], x[:, b], "right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Value of each bin by a tree of at most ``LEAVES`` leaves over the bins' sums."""
    parts = [(0, len(grad))]
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + 1.0)

    while len(parts) < LEAVES:
        best = (1e-9, None, None)
        for part in parts:
            a, b = part
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            gain = worth(a, at) + worth(at, b) - worth(a, b)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], part, int(at[k]))
        if best[1] is None:
            break
        (a, b), at = best[1], best[2]
        parts[parts.index((a, b)) : parts.index((a, b)) + 1] = [(a, at), (at, b)]
    out = np.zeros(len(grad))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + 1.0)
    return out


def _quarters(grad: np.ndarray, hess: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, table) of the best tree with one cut on each side of a pair."""
    g = np.pad(grad.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(hess.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    rows, columns = np.arange(1, grad.shape[0])[:, None], np.arange(1, grad.shape[1])[None, :]
    if not rows.size or not columns.size:
        return 0.0, np.zeros_like(grad)

    def block(m, r, c):
        low_low, low_all, all_low, all_all = m[r, c], m[r, -1], m[-1, c], m[-1, -1]
        return [low_low, low_all - low_low, all_low - low_low, all_all - low_all - all_low + low_low]

    gain = sum(x**2 / (y + 1.0) for x, y in zip(block(g, rows, columns), block(h, rows, columns), strict=True))
    r, c = (int(i) + 1 for i in np.unravel_index(gain.argmax(), gain.shape))
    values = [x / (y + 1.0) for x, y in zip(block(g, r, c), block(h, r, c), strict=True)]
    table = np.empty_like(grad)
    table[:r, :c], table[:r, c:], table[r:, :c], table[r:, c:] = values
    return float(gain.max()), table


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the features' tables, then of the best pairs'."""
    width = x.shape[1]
    share = y.mean() if len(y) else 0.5
    base = float(np.log(np.clip(share, 1e-9, 1 - 1e-9) / (1 - np.clip(share, 1e-9, 1 - 1e-9))))
    cuts = [_cuts(x[:, j], BINS) if len(y) else np.zeros(0) for j in range(width)]
    pair_cuts = [_cuts(x[:, j], PAIR_BINS) if len(y) else np.zeros(0) for j in range(width)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    if not 0 < share < 1 or not len(y):
        return Model(base if len(y) else 0.0, cuts, tables, [], pair_cuts, [])
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    logits = np.full(len(y), base)

    def rest() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j in range(width):
            grad, hess = rest()
            size = len(tables[j])
            step = RATE * _tree(np.bincount(bins[j], grad, size), np.bincount(bins[j], hess, size))
            tables[j] += step
            logits += step[bins[j]]

    coarse = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(pair_cuts)]
    sizes = [len(c) + 1 for c in pair_cuts]

    def grids(a: int, b: int) -> tuple[float, np.ndarray]:
        cell, shape = coarse[a] * sizes[b] + coarse[b], (sizes[a], sizes[b])
        sums = (np.bincount(cell, w, shape[0] * shape[1]).reshape(shape) for w in rest())
        return _quarters(*sums)

    ranked = sorted(combinations(range(width), 2), key=lambda p: -grids(*p)[0])
    pairs = ranked[:PAIRS]
    pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            step = RATE * grids(a, b)[1]
            pair_tables[k] += step
            logits += step[coarse[a], coarse[b]]
    return Model(base, cuts, tables, pairs, pair_cuts, pair_tables)


def train(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> Model:
    """A model of ``labels``' column ``label`` (0 or 1, by doc_id) from the texts of ``docs``.

    At most ``sample`` labelled rows are used; their ids are few enough to be sent to every executor.
    """
    known = labels.select("doc_id", F.col(label).cast("double").alias("y")).dropna()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(sample)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"x": [features(t) for t in part["text"]], "y": part["y"], "doc_id": part["doc_id"]})

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = rows.mapInPandas(count, "x array<double>, y double, doc_id bigint").orderBy("doc_id", "x", "y")
    found = found.limit(2 * sample).collect()  # ids may stand for several texts
    x = np.array([r["x"] for r in found], dtype=float).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r["y"] for r in found]))


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the model's score of each text."""
    kept = [c for c in docs.columns if c != name]
    schema = docs.select(*kept).schema.add(name, "double")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            x = np.array([features(t if isinstance(t, str) else "") for t in part[text]], dtype=float)
            yield part[kept].assign(**{name: model.scores(x.reshape(len(part), len(FEATURES)))})

    return docs.select(*kept).mapInPandas(run, schema)


def learnable(df: DataFrame) -> DataFrame:
    """Rows that are not kept from training: crc32 of the id as text doesn't leave 1 modulo 3."""
    return df.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)


def op10_quality_gam(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = train(learnable(docs), learnable(labels), "quality")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    scored = score(docs.select("doc_id", held_out, "text"), model).drop("text")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
