"""Accent stripping with built-in string functions."""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column, functions as F


def _letters_of(letter: str) -> str:
    """The canonical decomposition without marks."""
    return "".join(c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn")


#: Hangul syllables are composed by rule: of a lead, a vowel and maybe a tail.
_SYLLABLES = (0xAC00, 0xD7A3)
_LEADS, _VOWELS, _TAILS = (
    "".join(chr(first + i) for i in range(count)) for first, count in ((0x1100, 19), (0x1161, 21), (0x11A8, 27))
)


@functools.cache
def _tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    accented, plain, marks, several = [], [], [], []
    for point in (*range(0x80, 0x30000), *range(0xE0000, 0xE0200)):
        letter = chr(point)
        if unicodedata.category(letter) == "Mn":
            marks.append(letter)
        elif not _SYLLABLES[0] <= point <= _SYLLABLES[1]:
            kept = _letters_of(letter)
            if len(kept) > 1:
                several.append((letter, kept))
            elif kept and kept != letter:
                accented.append(letter)
                plain.append(kept)
    return "".join(accented + marks), "".join(plain), tuple(several)


def accent_table() -> tuple[str, str]:
    """Characters to replace, followed by marks to delete, and the replacements.

    Replaced is every character that decomposes to one character plus marks.
    Letters without a decomposition (ß, ø, ł, œ) are not in the table and stay.
    Taken from Python's Unicode data, so it does not vary with the Java version.
    """
    return _tables()[:2]


def composed_letters() -> tuple[tuple[str, str], ...]:
    """Characters other than Hangul that decompose to several letters, and those letters."""
    return _tables()[2]


def _spelling(stripped: str) -> str:
    """SQL: ``stripped`` with syllables and composed letters spelt out, character by character."""
    place = f"(ascii(c) - {_SYLLABLES[0]})"
    jamo = (
        f"concat(substring('{_LEADS}', CAST({place} DIV 588 AS INT) + 1, 1), "
        f"substring('{_VOWELS}', CAST({place} % 588 DIV 28 AS INT) + 1, 1), "
        f"if({place} % 28 = 0, '', substring('{_TAILS}', CAST({place} % 28 AS INT), 1)))"
    )
    first, last = map(chr, _SYLLABLES)
    letters = ", ".join(f"'{letter}', '{several}'" for letter, several in composed_letters())
    other = f"coalesce(try_element_at(map({letters}), c), c)"
    return f"array_join(transform(split({stripped}, ''), c -> if(c BETWEEN '{first}' AND '{last}', {jamo}, {other})), '')"


def strip_accents_sql(text: str) -> str:
    """Remove accents, as SQL over an expression: composed characters become their letters, marks go.

    Text whose byte and character lengths agree is ASCII and is returned as it is,
    so the per-character lookup is paid for accented text only; letters that
    decompose to several are spelt out only where the text has one.
    """
    replaced, plain = accent_table()
    stripped = f"translate({text}, '{replaced}', '{plain}')"
    some = "".join(letter for letter, _ in composed_letters())
    spelt = f"CASE WHEN {text} RLIKE '[{some}{chr(_SYLLABLES[0])}-{chr(_SYLLABLES[1])}]' THEN {_spelling(stripped)} ELSE {stripped} END"
    return f"CASE WHEN octet_length({text}) = char_length({text}) THEN {text} ELSE {spelt} END"


def strip_accents(text: Column) -> Column:
    """:func:`strip_accents_sql` of a column."""
    first, last = map(chr, _SYLLABLES)
    letters = F.expr("map(" + ", ".join(f"'{letter}', '{several}'" for letter, several in composed_letters()) + ")")
    stripped = F.translate(text, *accent_table())

    def spell(c: Column) -> Column:
        place = F.ascii(c) - _SYLLABLES[0]
        tail = F.substring(F.lit(_TAILS), place % 28, F.lit(1))
        jamo = F.concat(
            F.substring(F.lit(_LEADS), F.floor(place / 588).cast("int") + 1, F.lit(1)),
            F.substring(F.lit(_VOWELS), F.floor(place % 588 / 28).cast("int") + 1, F.lit(1)),
            F.when(place % 28 == 0, F.lit("")).otherwise(tail),
        )
        return F.when(c.between(first, last), jamo).otherwise(F.coalesce(F.try_element_at(letters, c), c))

    some = "".join(letter for letter, _ in composed_letters())
    spelt = F.array_join(F.transform(F.split(stripped, ""), spell), "")
    found = F.when(text.rlike(f"[{some}{first}-{last}]"), spelt).otherwise(stripped)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(found)


def brand_key(brand: Column) -> Column:
    """The form under which spellings of one brand are counted together."""
    return F.lower(strip_accents(F.trim(brand)))
