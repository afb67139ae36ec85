"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A letter n-gram is bound by
multiplying its letters' vectors, each rotated by its place; a text is the sum
(bundle) of its n-grams, and a language prototype is the sum of its training
texts. A text gets the language whose prototype has the largest cosine with it.

Vectors are computed from code points alone, so executors agree without sharing
state; memory is bounded by a chunk of letters, whatever the alphabet or the
length of a text. Bundles are whole numbers: the result does not depend on how
rows are spread over tasks.

Defined results: a null text, or one without a letter, is ``und`` with score 0.
Ties go to the alphabetically first language. Training rows with a null label or
text are left out; with no training rows at all every text is ``und``. Extra
columns of the input are carried only where the caller asks for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Language of a text that shows none.
UNDETERMINED = "und"

#: Code points handled at once by a task.
CHUNK_CHARS = 400_000

#: Numbers in a table of vectors, or of counts by text, that a task holds at once.
CELLS = 1 << 22

_LETTER: np.ndarray | None = None


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def letter_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """Random +1/-1 vectors (int8), one row per code point; ``dim`` is a multiple of 64."""
    words = np.arange(dim // 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        bits = _mix(_mix(codes.astype(np.uint64)[:, None] + np.uint64(1)) + words[None, :])
    return (np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) << 1) - 1


def _distinct(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """np.unique with inverse; without a sort where the values are below a small bound."""
    if bound > 1 << 22:
        return np.unique(values, return_inverse=True)
    present = np.zeros(bound, bool)
    present[values] = True
    distinct = np.flatnonzero(present)
    place = np.empty(bound, np.int64)
    place[distinct] = np.arange(len(distinct))
    return distinct, place[values]


def _bundle_chunk(texts: list[str], dim: int, n: int) -> np.ndarray:
    """Bundles (float64 whole numbers) of some texts, one row each."""
    joined = "\x00".join(texts).lower()
    cps = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    # lower() never makes or removes a NUL, so these still part the texts
    cuts = cps == 0
    if cuts.sum() >= len(texts):  # some text holds NULs itself
        return np.vstack([_bundle_chunk([t.replace("\x00", " ")], dim, n) for t in texts])
    doc = np.cumsum(cuts)
    letter = _letters()[cps]
    # runs of other characters count as one boundary, as do the ends of a text
    first = np.zeros(len(cps), bool)
    first[1:] = letter[:-1]
    keep = letter | (first & ~cuts)
    symbols = np.where(letter, cps, 0)[keep]
    doc = doc[keep]
    counts = np.bincount(doc, minlength=len(texts))
    # one boundary before and after each text
    ends = np.cumsum(counts)
    symbols = np.insert(symbols, np.concatenate([ends - counts, ends]), 0)
    doc = np.insert(doc, np.concatenate([ends - counts, ends]), np.tile(np.arange(len(texts)), 2))
    out = np.zeros((len(texts), dim))
    if len(symbols) < n:
        return out
    alphabet, ids = _distinct(symbols, 0x110000)
    m = len(alphabet)
    grams = len(ids) - n + 1
    code = np.zeros(grams, np.int64)
    for k in range(n):
        code = code * m + ids[k : k + grams]
    whole = doc[:grams] == doc[n - 1 :]
    some = np.zeros(grams, bool)  # an n-gram of boundaries says nothing
    for k in range(n):
        some |= symbols[k : k + grams] != 0
    code, doc = code[whole & some], doc[:grams][whole & some]
    if not len(code):
        return out
    distinct, gram = _distinct(code, m**n)
    vectors = letter_vectors(alphabet, dim)
    step = max(1, CELLS // max(dim, len(texts)))
    for at in range(0, len(distinct), step):
        part = distinct[at : at + step]
        bound, rest = None, part
        for k in range(n):
            turned = np.roll(vectors, k, axis=1)[rest % m]
            bound = turned if bound is None else bound * turned
            rest = rest // m
        mine = (gram >= at) & (gram < at + step) if len(distinct) > step else slice(None)
        table = np.bincount(
            doc[mine] * len(part) + gram[mine] - at, minlength=len(texts) * len(part)
        ).reshape(len(texts), len(part))
        # counts under 2**24 are exact in float32 sums over one chunk
        out += table.astype(np.float32) @ bound.astype(np.float32)
    return out


def bundles(texts: list[str], dim: int, n: int) -> np.ndarray:
    """The bundle of each text. A text longer than a chunk is bundled in overlapping parts."""
    out = np.zeros((len(texts), dim))
    batch: list[str] = []
    rows: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if batch:
            np.add.at(out, rows, _bundle_chunk(batch, dim, n))
        batch.clear()
        rows.clear()
        size = 0

    for i, text in enumerate(texts):
        at = 0
        while at == 0 or at < len(text):
            end = at + CHUNK_CHARS
            if end < len(text):  # part a long text between words where it has any
                space = text.rfind(" ", at + CHUNK_CHARS // 2, end)
                end = space if space > at else end
            if size + min(end, len(text)) - at > CHUNK_CHARS:
                flush()
            batch.append(text[at:end])
            rows.append(i)
            size += min(end, len(text)) - at
            at = end
    flush()
    return out


def prototypes(docs: DataFrame, text: str = "text", lang: str = "lang", dim: int = 512, n: int = 3) -> DataFrame:
    """(lang, place, weight): the summed bundle of every language in ``docs``.

    Each task adds up its own texts and sends one vector per language.
    """

    def partial(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for part in parts:
            for name, group in part.groupby("lang"):
                total = _sum_bundle(group["text"].tolist(), dim, n)
                sums[name] = sums[name] + total if name in sums else total
        if sums:
            yield pd.DataFrame({"lang": list(sums), "bundle": [v.astype(np.int64) for v in sums.values()]})

    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    sums = known.mapInPandas(partial, "lang string, bundle array<bigint>")
    places = sums.select("lang", F.posexplode("bundle").alias("place", "weight"))
    return places.groupBy("lang", "place").agg(F.sum("weight").alias("weight"))


def _sum_bundle(texts: list[str], dim: int, n: int) -> np.ndarray:
    """Sum of the texts' bundles, by way of their joint n-gram counts."""
    total, batch, size = np.zeros(dim), [], 0
    for text in [*texts, None]:
        if text is not None:
            batch.append(text)
            size += len(text)
        if batch and (text is None or size >= CHUNK_CHARS):
            # boundaries around each text keep n-grams from crossing them
            total += bundles([" ".join(batch)], dim, n)[0]
            batch, size = [], 0
    return total


def identify(
    docs: DataFrame,
    prototypes: DataFrame,
    text: str = "text",
    dim: int = 512,
    n: int = 3,
    lang_pred: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """``docs`` with the predicted language and its cosine (0 where negative).

    The prototypes (languages x ``dim`` numbers, whatever the number of texts)
    travel with the task.
    """
    table = prototypes.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "weight"))).alias("v"))
    learned = sorted(table.select("lang", F.col("v.weight").alias("w")).collect())
    names = np.array([r["lang"] for r in learned], dtype=object)
    matrix = np.array([r["w"] for r in learned], dtype=float).reshape(len(learned), dim)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    matrix = np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)
    kept = [c for c in docs.columns if c not in (lang_pred, score)]
    schema = docs.select(*kept).schema.add(lang_pred, "string").add(score, "double")

    def predict(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = np.full(len(part), UNDETERMINED, dtype=object)
            cosine = np.zeros(len(part))
            if len(names):
                vectors = bundles([t if isinstance(t, str) else "" for t in part[text]], dim, n)
                size = np.linalg.norm(vectors, axis=1)
                seen = size > 0
                near = vectors[seen] @ matrix.T / size[seen, None]
                found[seen] = names[near.argmax(axis=1)]
                cosine[seen] = near.max(axis=1).clip(0, 1)
            out = part[kept].copy()
            out[lang_pred], out[score] = found, cosine
            yield out

    return docs.select(*kept).mapInPandas(predict, schema)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a row is kept from training: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _length_class(text: Column) -> Column:
    """The binary logarithm of a text's length, in whole numbers; 0 for an empty one."""
    return F.floor(F.log2(F.greatest(F.length(text), F.lit(1)))).cast("int")


def least_scores(known: DataFrame, text: str = "text", score: str = "score", dim: int = 512) -> dict[int, float]:
    """The least score, by length class, of texts in a learnt language: half of what 99 in 100 of ``known`` exceed.

    ``known`` are training rows whose language was found. Short texts score less than long
    ones, and where that is within three deviations of random vectors, nothing is asked of
    them; less is asked where a class has few training rows. The classes number some thirty, whatever the number of rows.
    """
    classes = known.groupBy(_length_class(F.col(text)).alias("length"))
    low = classes.agg(F.percentile_approx(score, 0.01, 1000).alias("low"), F.count("*").alias("n"))
    halves = {row["length"]: row["low"] / 2 * row["n"] / (row["n"] + 20) for row in low.collect()}
    return {length: half if half > 3 / dim**0.5 else 0.0 for length, half in halves.items()}


def is_like(least: dict[int, float], text: str = "text", score: str = "score") -> Column:
    """Whether a text scores what its length asks for; classes without training rows ask what the next shorter one does."""
    asked = F.lit(0.0)
    for length, low in sorted(least.items()):
        asked = F.when(_length_class(F.col(text)) >= length, F.lit(low)).otherwise(asked)
    return (F.col(score) > 0) & (F.col(score) >= asked)


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    learned = prototypes(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(rows, learned).drop("text")
