"""Byte-level BPE encoding by a lazily determinised transducer, and streaming decoding.

Encoding. The last token of a prefix's encoding is the one suffix token that can
follow the encoding before it: two tokens can stand together if their joint bytes
encode to just them. A state holds, for the last few positions, the last token of
the encoding up to there; reading a byte gives the next state. States and steps
are made when first met and kept (up to a bound, then forgotten and made anew).
A token is emitted as soon as every continuation shares it, which takes at most
as many bytes of lookahead as the longest token has.

As in the library whose ranks these are, a piece that is itself a token is that
token. Pieces are the matches of the pre-tokenizer pattern.

Decoding. Tokens give bytes; :class:`Utf8Stream` hands on whole characters and
keeps the beginning of one until the rest arrives. Malformed bytes come out as
U+FFFD, as Python's decoder has it.

Defined results: a null or empty text has no tokens and decodes to no bytes. Each row
is encoded for itself, so repeated rows give repeated results, and an empty table an
empty one; columns named as a result's are replaced, others stay. A text of any length is
encoded whole, in pieces, with memory for its ids. What a worker remembers is bounded.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfscan.llm.chunks import chunks

#: States, steps and pairs a worker keeps before it starts anew (some 200 MB in all).
STATES, MOVES, PAIRS = 300_000, 600_000, 300_000

#: Chunks and pieces whose ids a worker keeps (twice as many at most), and the longest of them.
RECENT, RECENT_CHARS = 200_000, 64


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def tokens_of(ranks: dict[bytes, int]) -> list[bytes]:
    """Tokens by rank; empty where a rank is free."""
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def merge_plainly(piece: bytes, ranks: dict[bytes, int], below: int = 1 << 62) -> list[bytes]:
    """The definition: merge the leftmost pair of lowest rank until none (below a rank) is left."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        pairs = [ranks.get(a + b, below) for a, b in zip(parts, parts[1:], strict=False)]
        rank = min(pairs)
        if rank >= below:
            break
        at = pairs.index(rank)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class _State(dict):
    """The steps from a state so far (byte to state and emitted ids), its key and what it emits at the end."""

    __slots__ = ("key", "ending")

    def __init__(self, key: bytes):
        self.key, self.ending = key, None


class Transducer:
    """Reads the bytes of one piece and emits token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.tokens = ranks, tokens_of(ranks)
        self.longest = max(map(len, ranks), default=1)
        self.sizes = "BHI"[(self.longest > 0xFF) + (self.longest > 0xFFFF)]  # array code of a token's size
        self.beginnings = {token[:n] for token in ranks for n in range(1, len(token))}
        self.together: dict[int, bool] = {}
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._forget()

    def _forget(self) -> None:
        """Only the state before the first byte is left."""
        self.states: dict[bytes, _State] = {}
        self.emissions: dict[tuple[int, ...], tuple[int, ...]] = {}
        self.moves = 0
        self.start = self._known(self._key(b"", (), 0))

    def _known(self, key: bytes) -> _State:
        """The state of a key."""
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = _State(key)
        return state

    def _key(self, tail: bytes, sizes: Iterable[int], before: int) -> bytes:
        """A state: the bytes read since the emitted tokens; for every place in them the size of the
        last token of the encoding up to there (0: never needed again); the token before them
        (its rank and 1; 0: none; the number of ranks and 1: never needed again)."""
        return before.to_bytes(4) + tail + array(self.sizes, sizes).tobytes()

    def _parts(self, key: bytes) -> tuple[bytes, array, int]:
        sizes = array(self.sizes)
        n = (len(key) - 4) // (1 + sizes.itemsize)
        sizes.frombytes(key[4 + n :])
        return key[4 : 4 + n], sizes, int.from_bytes(key[:4])

    def _fits(self, before: bytes, token: bytes) -> bool:
        if not before:
            # a token that its own merges don't reach never stands in a merged piece
            return merge_plainly(token, self.ranks) == [token]
        key = self.ranks[before] << 24 | self.ranks[token]
        found = self.together.get(key)
        if found is None:
            if len(self.together) >= PAIRS:
                self.together.clear()
            found = self.together[key] = self._keep_apart(before, token)
        return found

    def _halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``token``; None for a byte, or if older merges don't lead to two."""
        if token not in self.halves:
            parts = merge_plainly(token, self.ranks, below=self.ranks[token])
            grown = len(token) > 1 and len(parts) == 2 and max(map(self.ranks.get, parts)) < self.ranks[token]
            self.halves[token] = (parts[0], parts[1]) if grown else None
        return self.halves[token]

    def _keep_apart(self, left: bytes, right: bytes) -> bool:
        """Whether no merge across their border comes before the merges that made both.

        Goes back in time: the tokens at the border, then what they were before
        the youngest merge of the two. A merge across happens while both stand
        there; at the same rank the one further left comes first.
        """
        ranks, until_left, until_right, both = self.ranks, 1 << 62, 1 << 62, [left, right]
        while True:
            across = ranks.get(left + right)
            if across is not None and across < until_left and across <= until_right:
                return False
            back_left, back_right = self._halves(left), self._halves(right)
            if len(left) > 1 and not back_left or len(right) > 1 and not back_right:
                return merge_plainly(b"".join(both), ranks) == both
            if back_left and (not back_right or ranks[left] > ranks[right]):
                until_left, left = ranks[left], back_left[1]
            elif back_right:
                until_right, right = ranks[right], back_right[0]
            else:
                return True

    def _determinise(self, state: _State, byte: int) -> tuple[_State, tuple[int, ...]]:
        """Makes the step for a byte, and the state that it leads to if it is new."""
        if len(self.states) >= STATES or self.moves >= MOVES:
            self._forget()
            state = self._known(state.key)
        ranks = self.ranks
        tail, sizes, before = self._parts(state.key)
        tail += bytes((byte,))
        n = len(tail)
        for size in range(min(n, self.longest), 0, -1):
            token = tail[n - size :]
            if token not in ranks:
                continue
            if n > size:
                had = sizes[n - size - 1]
                if had and self._fits(tail[n - size - had : n - size], token):
                    break
            elif before <= len(self.tokens) and self._fits(self.tokens[before - 1] if before else b"", token):
                break
        else:
            size = 0
        sizes.append(size)
        # a later token can start only where the bytes since then begin some token
        beginnings, places = self.beginnings, {n} if size else set()
        for place in range(max(0, n + 1 - self.longest), n):
            if (not place or sizes[place - 1]) and tail[place:] in beginnings:
                places.add(place)
        # the encodings up to these places share those up to where, from the last place on, all have met
        met, left = [0] * n, len(places)
        shared = n if left else 0
        while left > 1:
            if shared in places:
                size = met[shared - 1] = sizes[shared - 1]
                if shared - size in places:
                    left -= 1
                else:
                    places.add(shared - size)
            shared -= 1
        while shared and shared not in places:
            shared -= 1
        out = ()
        if shared:
            at, cuts = shared, []
            while at > 0:
                size = sizes[at - 1]
                cuts.append(ranks[tail[at - size : at]])
                at -= size
            out = tuple(cuts[::-1])
            tail, met, before = tail[shared:], met[shared:], out[-1] + 1
        if tail and tail not in beginnings:
            before = len(self.tokens) + 1  # nothing can start there any more
        target = self._known(self._key(tail, met, before))
        move = state[byte] = target, self.emissions.setdefault(out, out)
        self.moves += 1
        return move

    def _ending(self, state: _State) -> list[int]:
        """Tokens of the bytes read since the emitted ones."""
        tail, sizes, _ = self._parts(state.key)
        ending, at = [], len(tail)
        while at > 0:
            ending.append(self.ranks[tail[at - sizes[at - 1] : at]])
            at -= sizes[at - 1]
        return ending[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        state, out = self.start, []
        for byte in piece:
            try:
                state, emitted = state[byte]
            except KeyError:
                state, emitted = self._determinise(state, byte)
            if emitted:
                out += emitted
        if state.ending is None:
            state.ending = self._ending(state)
        return out + state.ending


#: How many bytes follow a first byte of UTF-8 (-1: it can't come first).
_FOLLOW = [0] * 128 + [-1] * 66 + [1] * 30 + [2] * 16 + [3] * 5 + [-1] * 11
#: Range of the second byte after some first bytes; 80 to BF after others.
_SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


class Utf8Stream:
    """Incremental UTF-8: bytes in, whole characters out."""

    def __init__(self) -> None:
        self.open = b""

    def _unfinished(self, data: bytes) -> int:
        """Length of the beginning of a character at the end of ``data``."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            if _FOLLOW[byte] < back:
                return 0
            low, high = _SECOND.get(byte, (0x80, 0xBF))
            return back if back == 1 or low <= data[-back + 1] <= high else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.open + data
        cut = len(data) - self._unfinished(data)
        self.open = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.open = self.open, b""
        return rest.decode("utf-8", "replace")


def decode_stream(ids: Iterable[int], tokens: list[bytes], step: int = 4096) -> Iterator[str]:
    """Text of ids as it becomes known, ``step`` ids at a time."""
    stream = Utf8Stream()
    for part in batched(ids, step):
        yield stream.feed(b"".join([tokens[i] for i in part]))
    yield stream.end()


class Recent:
    """``make(key)`` of the keys asked for lately; older ones are made again.

    Two generations: a key that is still asked for moves to the younger one; when that
    is full the older one goes.
    """

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.young, self.old = make, {}, {}

    def __call__(self, key: str) -> bytes:
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is None:
                value = self.make(key)
            if len(key) <= RECENT_CHARS:
                if len(self.young) >= RECENT:
                    self.young, self.old = {}, self.young
                self.young[key] = value
        return value


class Encoder:
    """Texts to ids; words met lately are looked up, first with what stands around them, then alone."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find, self.transducer = regex.compile(pattern).findall, Transducer(ranks)
        self.pieces, self.chunks = Recent(self._ids), Recent(self._chunk)

    def _ids(self, piece: str) -> bytes:
        return array("I", self.transducer.encode(piece.encode())).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces, self.find(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        parts = chunks(text)
        values = list(map(self.chunks.young.get, parts))
        if None in values:
            values = [self.chunks(p) if v is None else v for p, v in zip(parts, values, strict=True)]
        return b"".join(values)


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder for a rank file."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def _mapped(docs: DataFrame, kept: list[str], schema, columns: Callable[[pd.DataFrame], dict[str, list]]) -> DataFrame:
    """``docs`` with columns made in Python, a batch at a time."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part[kept].assign(**columns(part))

    return docs.mapInPandas(run, schema)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text, as little-endian unsigned 32-bit numbers in a binary column."""
    kept = [c for c in docs.columns if c != ids]
    docs = docs.select(*kept)

    def columns(part: pd.DataFrame) -> dict[str, list]:
        encode = encoder(path, pattern).encode
        return {ids: [encode(t) if isinstance(t, str) else b"" for t in part[text]]}

    return _mapped(docs, kept, docs.select(*kept).schema.add(ids, "binary"), columns)


def _decoded(ids: bytes | None, tokens: list[bytes]) -> str:
    return "".join(decode_stream(np.frombuffer(ids or b"", "<u4").tolist(), tokens))


_TOKENS: dict[str, list[bytes]] = {}


def _tokens(path: str) -> list[bytes]:
    """The worker's tokens of a rank file."""
    if path not in _TOKENS:
        _TOKENS[path] = tokens_of(load_ranks(path))
    return _TOKENS[path]


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids."""
    kept = [c for c in encoded.columns if c != text]
    encoded = encoded.select(*kept)
    columns = lambda part: {text: [_decoded(x, _tokens(path)) for x in part[ids]]}
    return _mapped(encoded, kept, encoded.select(*kept).schema.add(text, "string"), columns)


def round_trip(
    docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``docs``, but for its text, with the ids of each text and the text of the ids.

    One worker a task does both, with one set of tables; the text isn't sent back.
    """
    kept = [c for c in docs.columns if c not in (text, ids, decoded)]
    docs = docs.select(*kept, F.col(text))

    def columns(part: pd.DataFrame) -> dict[str, list]:
        encoding = encoder(path, pattern)
        made = [encoding.encode(t) if isinstance(t, str) else b"" for t in part[text]]
        return {ids: made, decoded: [_decoded(x, encoding.transducer.tokens) for x in made]}

    schema = docs.select(*kept).schema.add(ids, "binary").add(decoded, "string")
    return _mapped(docs, kept, schema, columns)


def op8_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return round_trip(docs, path, pattern).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
