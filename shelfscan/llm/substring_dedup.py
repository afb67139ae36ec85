"""Removal of repeated passages by level-wise doubling.

A window of ``window`` words can only be found in two texts if each part of it is.
So short runs are counted first; a run is doubled only where it is repeated, and
again, until the window's length is reached or no candidate is left. With 13 words
the lengths are 7 and, twice that being enough, 13; with 50 they are 7, 14, 28 and 50.

At the first length one run speaks for all windows around it: of the runs in a
window, the one with the least hash, which is the same one wherever the window
stands. At the next lengths a window is represented by the run of that length
inside it which begins or ends with its first run. So a level sends a row for
some of its runs, not for each, and a window is lost at no level.

A level sends each run of a text once, by its hash, finds the least and largest id
that have it, and makes a list per text of the runs that more than one text has; the
list is as long as the text at most. A run has one row for each text that has it, so
a passage in a third of all texts is a third of a row for each text in one task,
which spills; its runs go to different tasks. Texts are dealt by id once; every level and the
removal read that same exchange.

Runs are compared by 64-bit hashes of their words' bytes.

Defined results: a null text has no words. Texts shorter than the window keep all
words. Rows with the same id are one document's texts: they take nothing from one
another, and a window of one is removed if it starts in a smaller id. Rows without
an id keep all words and take none from others. An empty table gives an empty result;
columns named as a result's are replaced, others stay. A text of any length is cut whole,
with some 60 to 100 bytes of memory a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from shelfscan.llm.tables import checkpointed
from shelfscan.llm.words import Words, blocks, runs, words_of

#: Length of the first runs. Shorter ones repeat by chance too often, longer ones thin the rows less.
SEED = 7


def lengths(window: int) -> list[int]:
    """Lengths of the levels: doubled from the first until the window is reached."""
    out = [min(SEED, window)]
    while out[-1] < window:
        out.append(min(2 * out[-1], window))
    return out


def _representatives(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts of windows, place of the first-level run that speaks for each)."""
    seed = min(SEED, window)
    hashes, _ = runs(words, seed)
    _, whole = runs(words, window)
    starts = np.flatnonzero(whole)
    if not len(starts):
        return starts, starts
    room = window - seed + 1
    views = np.lib.stride_tricks.sliding_window_view(hashes, room)[starts]
    return starts, starts + views.argmin(axis=1)


def _parts(starts: np.ndarray, places: np.ndarray, length: int, window: int) -> np.ndarray:
    """Start of the run of ``length`` that represents each window at a level."""
    seed = min(SEED, window)
    fits_right = places + length <= starts + window
    # from the first run on where the window has room, else up to its end or the window's
    return np.where(fits_right, places, np.maximum(starts, places + seed - length))


def _isin(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    known = np.sort(known)
    at = np.minimum(np.searchsorted(known, values), max(len(known) - 1, 0))
    return known[at] == values if len(known) else np.zeros(len(values), bool)


def _key_lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a list column; null lists are empty."""
    column = batch.column(name)
    sizes = np.asarray(column.value_lengths().fill_null(0))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return offsets, np.asarray(column.flatten()).astype(np.int64)


def _candidates(words: Words, known: list[np.ndarray] | None, level: int, window: int):
    """(text, start, key) of the representing runs of a level, where those of the level before are repeated."""
    steps = lengths(window)
    starts, places = _representatives(words, window)
    if known is not None and len(starts):
        parts = _parts(starts, places, steps[level - 1], window)
        keys = runs(words, steps[level - 1])[0].view(np.int64)[parts]
        alive = np.zeros(len(starts), bool)
        bounds = np.searchsorted(words.text[starts], np.arange(len(known) + 1))
        for i, mine in enumerate(known):
            if len(mine):
                part = slice(bounds[i], bounds[i + 1])
                alive[part] = _isin(keys[part], mine)
        starts, places = starts[alive], places[alive]
    parts = _parts(starts, places, steps[level], window)
    return words.text[starts], starts, runs(words, steps[level])[0].view(np.int64)[parts]


def _emitter(level: int, window: int):
    """Rows (key, doc_id) of a level, each once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(0))
            lists = _key_lists(batch, "__keys") if level else None
            for at, end, data, offsets in blocks(batch.column("text")):
                known = level and [lists[1][lists[0][i] : lists[0][i + 1]] for i in range(at, end)] or None
                text, _, keys = _candidates(words_of(data, offsets), known, level, window)
                if not len(keys):
                    continue
                order = np.lexsort((keys, text))
                text, keys = text[order], keys[order]
                new = np.ones(len(keys), bool)
                new[1:] = (text[1:] != text[:-1]) | (keys[1:] != keys[:-1])
                yield pa.RecordBatch.from_arrays([keys[new], ids[at:end][text[new]]], ["key", "doc_id"])

    return run


def _lists(rows: DataFrame, last: bool) -> DataFrame:
    """(doc_id, keys): the runs of each text that more than one text has; at the last level, a smaller id."""
    same = Window.partitionBy("key")
    ends = rows.withColumns({"least": F.min("doc_id").over(same), "most": F.max("doc_id").over(same)})
    found = ends.filter("doc_id > least" if last else "least < most")
    return found.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def _removed(words: Words, known: list[np.ndarray], window: int) -> np.ndarray:
    """Which words are covered by windows whose hash is known for their text."""
    gone = np.zeros(len(words.hashes) + 1, np.int64)
    keys, whole = runs(words, window)
    keys = keys.view(np.int64)
    for i, mine in enumerate(known):
        if len(mine):
            at = np.arange(words.first[i], words.first[i + 1])
            at = at[whole[at]]
            at = at[_isin(keys[at], mine)]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + window, -1)
    return np.cumsum(gone[:-1]) > 0


def _with_keys(docs: DataFrame, lists: DataFrame) -> DataFrame:
    """Each text with its list. Always this join of whole rows, so that the texts are dealt out once."""
    return docs.join(lists.withColumnRenamed("keys", "__keys"), "doc_id", "left")


def repeated_windows(docs: DataFrame, window: int = 13) -> DataFrame:
    """(doc_id, keys): windows of each text of ``docs`` that start in a smaller id."""
    steps = lengths(window)
    schema = "key bigint, doc_id bigint"
    known = docs.select("doc_id", "text").filter("doc_id IS NOT NULL AND text IS NOT NULL")
    lists = checkpointed(_lists(known.mapInArrow(_emitter(0, window), schema), len(steps) == 1))
    for level in range(1, len(steps)):
        rows = _with_keys(docs, lists).mapInArrow(_emitter(level, window), schema)
        lists = _lists(rows, level == len(steps) - 1)
    return lists


def remove_repeats(docs: DataFrame, window: int = 13, text: str = "kept", as_is: bool = False) -> DataFrame:
    """``docs`` with n_words, n_removed and what is kept of each text: its words, joined by spaces.

    ``as_is``: the text as it stands instead, lines and all, without the removed words and
    the white space that follows them.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed", text)]
    docs = docs.select(*kept)
    lists = repeated_windows(docs, window)
    schema = docs.select(*kept).schema.add("n_words", "long").add("n_removed", "long").add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = _key_lists(batch, "__keys")
            n_words, n_removed, texts = [], [], []
            for at, end, data, offsets in blocks(batch.column("text")):
                words = words_of(data, offsets)
                known = [lists[1][lists[0][i] : lists[0][i + 1]] for i in range(at, end)]
                gone = _removed(words, known, window)
                for i in range(end - at):
                    mine = slice(words.first[i], words.first[i + 1])
                    stay = ~gone[mine]
                    n_words.append(len(stay))
                    n_removed.append(len(stay) - int(stay.sum()))
                    if as_is:
                        texts.append(_cut(data[offsets[i] : offsets[i + 1]], words.starts[mine] - offsets[i], stay))
                    else:
                        texts.append(_joined(data, words.starts[mine][stay], words.ends[mine][stay]))
            columns = [batch.column(c) for c in kept]
            columns += [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "n_words", "n_removed", text])

    return _with_keys(docs, lists).mapInArrow(run, schema)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> str:
    """Words joined by one space."""
    if not len(starts):
        return ""
    low, high = int(starts[0]), int(ends[-1])
    step = np.zeros(high - low + 2, np.int8)
    step[starts - low] = 1
    np.add.at(step, ends - low, -1)
    inside = np.cumsum(step[: high - low + 1]) > 0
    body = data[low : high + 1].copy() if high < len(data) else np.append(data[low:high], np.uint8(32))
    inside[ends - low] = True  # the byte behind a word becomes its space
    body[ends - low] = 32
    return body[inside][:-1].tobytes().decode("utf-8", "replace")


def _cut(data: np.ndarray, starts: np.ndarray, stay: np.ndarray) -> str:
    """A text's bytes from each word that stays up to the next word, and what stands before the first word."""
    if not len(starts):
        return data.tobytes().decode("utf-8", "replace")
    kept = np.repeat(np.concatenate([[True], stay]), np.diff(np.concatenate([[0], starts, [len(data)]])))
    return data[kept].tobytes().decode("utf-8", "replace")


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    )
