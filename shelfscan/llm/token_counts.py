"""Word-piece token counts by a linear longest-match automaton.

Greedy longest match takes, from the start of a word, the longest piece that can
begin a word, then again and again the longest piece that can go on. A trie of
both kinds of pieces gets failure links: where a node's text can't be continued,
the link leads to the node for what is left once the pieces that are then settled
are cut off, and the number of those pieces is known beforehand. One step for each
byte of a word gives its count; pieces are never built.

Words are begun by the tokens that begin with a space, and by every single byte that
is a token: a byte-complete file cuts every word. Single bytes change no word that
another piece can begin. With other files, a word that can't be cut into pieces counts
as one unknown token. Words are what
stands between the six white-space characters of ASCII. Defined results: a null or
empty text has no words and no tokens.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from shelfscan.llm.bpe import load_ranks
from shelfscan.llm.chunks import Memo

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ROOT, _INNER, _NONE = 0, 1, -1


class Automaton:
    """``first``: pieces that begin a word; ``further``: pieces inside one."""

    def __init__(self, first: Iterable[bytes], further: Iterable[bytes]):
        self.goto: dict[int, int] = {}
        self.link, self.popped = [_NONE, _NONE], [0, 0]
        ends, below = set(), [[], []]
        for root, pieces in ((_ROOT, first), (_INNER, further)):
            for piece in filter(None, pieces):
                node = root
                for byte in piece:
                    key = node << 8 | byte
                    if key not in self.goto:
                        self.goto[key] = len(below)
                        below[node].append((byte, len(below)))
                        below.append([])
                    node = self.goto[key]
                ends.add(node)
        self.link += [_NONE] * (len(below) - 2)
        self.popped += [0] * (len(below) - 2)
        queue = deque([_ROOT, _INNER])
        while queue:
            parent = queue.popleft()
            for byte, node in below[parent]:
                queue.append(node)
                if node in ends:
                    self.link[node], self.popped[node] = _INNER, 1
                    continue
                at, popped = self.link[parent], self.popped[parent]
                while at != _NONE and at << 8 | byte not in self.goto:
                    popped += self.popped[at]
                    at = self.link[at]
                if at != _NONE:
                    self.link[node], self.popped[node] = self.goto[at << 8 | byte], popped

    def count(self, word: bytes) -> int:
        goto, link, popped = self.goto, self.link, self.popped
        node, tokens = _ROOT, 0
        for byte in word:
            following = goto.get(node << 8 | byte)
            while following is None:
                if link[node] == _NONE:
                    return 1
                tokens += popped[node]
                node = link[node]
                following = goto.get(node << 8 | byte)
            node = following
        while node != _INNER:
            if link[node] == _NONE:
                return 1
            tokens += popped[node]
            node = link[node]
        return tokens


_COUNTERS: dict[str, Memo] = {}


def pieces_of(path: str) -> tuple[list[bytes], list[bytes]]:
    """Pieces of a rank file: those after a space and single bytes begin words, those without white space go on."""
    tokens = load_ranks(path)
    first = [t[1:] for t in tokens if t[:1] == b" " and not re.search(rb"[\x20\x09-\x0D]", t[1:])]
    further = [t for t in tokens if not re.search(rb"[\x20\x09-\x0D]", t)]
    return first + [t for t in further if len(t) == 1], further


def _counter(path: str) -> Memo:
    """The worker's counter for a rank file; counts of words already met are kept, up to a bound."""
    if path not in _COUNTERS:
        count = Automaton(*pieces_of(path)).count
        _COUNTERS[path] = Memo(lambda words: [count(w.encode("utf-8", "replace")) for w in words])
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_words and n_tokens of each text."""
    kept = [c for c in docs.columns if c not in ("n_words", "n_tokens")]
    schema = docs.select(*kept).schema.add("n_words", "long").add("n_tokens", "long")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = _counter(path)
        for part in parts:
            n_words, n_tokens = [], []
            for body in part[text]:
                words = _WORD.findall(body) if isinstance(body, str) else []
                n_words.append(len(words))
                n_tokens.append(sum(count(words)))
            yield part[kept].assign(n_words=n_words, n_tokens=n_tokens)

    return docs.select(*kept).mapInPandas(run, schema)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).drop("text")
