"""Texts in chunks whose tokens don't depend on what stands around them.

The public pre-tokenizer pattern lets a word take one space before it, so a text
can be cut before every space that follows a character other than white space.
Words repeat, so their tokens are kept per worker; the memory is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Callable

_UNSAFE = re.compile(r"\s ")

#: Chunks kept by a worker, and the longest of them.
MEMO_ENTRIES, MEMO_CHARS = 200_000, 64


def chunks(text: str) -> list[str]:
    """``text`` in order; a text with longer white space is cut at its clear spaces only."""
    if not text:
        return []
    first, *rest = text.split(" ")
    parts = [first, *[" " + x for x in rest]] if first else [" " + x for x in rest]
    if first and not _UNSAFE.search(text):
        return parts
    joined = [parts[0]]
    for part in parts[1:]:
        # a space after white space belongs to the same run
        if joined[-1][-1].isspace() or len(part) == 1 or part[1].isspace():
            joined[-1] += part
        else:
            joined.append(part)
    return joined


class Memo:
    """``make(chunks)`` gives the values of new chunks; known ones are looked up."""

    def __init__(self, make: Callable[[list[str]], list]):
        self.make, self.known = make, {}

    def __call__(self, parts: list[str]) -> list:
        values = list(map(self.known.get, parts))
        if None in values:
            new = list(dict.fromkeys(p for p, v in zip(parts, values, strict=True) if v is None))
            made = dict(zip(new, self.make(new), strict=True))
            values = [made[p] if v is None else v for p, v in zip(parts, values, strict=True)]
            if len(self.known) + len(made) > MEMO_ENTRIES:
                self.known.clear()
            self.known.update((k, v) for k, v in made.items() if len(k) <= MEMO_CHARS)
        return values
