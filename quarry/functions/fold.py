"""Unicode folds as JVM expressions (H2, and the fold of stored keys).

A fold is a rule on single characters: compatibility decomposition, then case
and marks.  Decomposed marks are dropped, so their canonical order is of no
account and a text folds character by character.  The rule makes a translation
table for characters that become one or none and a lookup for those that become
several; Hangul syllables are decomposed by arithmetic on their code points.
Python's Unicode data makes the tables when the module is loaded; no Python
runs in tasks.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable

from pyspark.sql import Column, functions as F

#: Hangul syllables: first code point, number of vowels and of endings (an ending may be none), end.
HANGUL, VOWELS, ENDINGS, HANGUL_END = 0xAC00, 21, 28, 0xD7A4
#: Assigned characters with decompositions or case lie in the first three planes.
_POINTS = (*range(0x80, HANGUL), *range(0xF900, 0xFFFE), *range(0x10000, 0x30000))


def folded_form(text: str) -> str:
    """The fold that ``fold`` must equal: NFKD, combining marks dropped, casefold."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


def ascii_form(text: str) -> str:
    """NFKD, ASCII only, lower case."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if ord(c) < 128).lower()


def _ranges(points: Iterable[int]) -> str:
    """Code points as the inside of a regex character class."""
    out: list[list[int]] = []
    for cp in sorted(points):
        if out and out[-1][1] == cp - 1:
            out[-1][1] = cp
        else:
            out.append([cp, cp])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in out)


class _Fold:
    """Tables of one rule."""

    def __init__(self, rule: Callable[[str], str], common: str = "") -> None:
        one, none, several = {}, [], {}
        for cp in (*range(0x41, 0x5B), *_POINTS):
            ch = chr(cp)
            form = rule(ch)
            if len(form) > 1:
                several[ch] = form
            elif not form:
                none.append(ch)
            elif form != ch:
                one[ch] = form
        self.source, self.target = "".join(one) + "".join(none), "".join(one.values())
        # Characters often met that become several are replaced on their own.
        self.common = {ch: several.pop(ch) for ch in common}
        self.several = json.dumps(several)
        special = {ord(ch) for ch in several} | set(range(HANGUL, HANGUL_END))
        self.special = f"[{_ranges(special)}]"
        self.strange = f"[^{_ranges(cp for cp in range(0x250) if cp not in special)}]"

    def __call__(self, text: Column) -> Column:
        for ch, form in self.common.items():
            text = F.replace(text, F.lit(ch), F.lit(form))
        lookup = F.from_json(F.lit(self.several), "map<string,string>")
        spell = F.transform(F.split(text, ""), lambda ch: F.coalesce(F.try_element_at(lookup, ch), _jamo(ch), ch))
        spelled = F.when(text.rlike(self.strange) & text.rlike(self.special), F.array_join(spell, "")).otherwise(text)
        return F.translate(spelled, self.source, self.target)


def _jamo(ch: Column) -> Column:
    """A Hangul syllable as its two or three letters; NULL for any other character."""
    letters = [F.lit("".join(chr(first + i) for i in range(n))) for first, n in ((0x1100, 19), (0x1161, VOWELS), (0x11A8, ENDINGS - 1))]
    place = F.ascii(ch) - HANGUL
    lead = F.substr(letters[0], F.floor(place / (VOWELS * ENDINGS)).cast("int") + 1, F.lit(1))
    vowel = F.substr(letters[1], F.floor(place % (VOWELS * ENDINGS) / ENDINGS).cast("int") + 1, F.lit(1))
    ending = F.when(place % ENDINGS > 0, F.substr(letters[2], (place % ENDINGS).cast("int"), F.lit(1))).otherwise("")
    return F.when((place >= 0) & (place < HANGUL_END - HANGUL), F.concat(lead, vowel, ending))


_FOLD = _Fold(folded_form, "ß")
_ASCII = _Fold(ascii_form)


def fold(text: Column) -> Column:
    """NFKD, combining marks dropped, casefold."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.lower(text)).otherwise(_FOLD(text))


def fold_to_ascii(text: Column) -> Column:
    """NFKD, all but ASCII dropped, lower case."""
    return F.when(text.rlike(r"^[\x00-\x7F]*$"), F.lower(text)).otherwise(F.regexp_replace(_ASCII(text), r"[^\x00-\x7F]+", ""))
