"""How well a text fits the language that it was given: trigram likelihoods against those of learnt passages."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quarry.llm.common import runs, text_slices

#: Hashed trigrams of a language's table.
GRAMS = 1 << 16
_SMOOTH = 0.05


@dataclass
class Familiarity:
    langs: list[str]
    grams: np.ndarray     # (languages, GRAMS): log likelihoods
    centre: np.ndarray    # by language: mean of a passage's mean log likelihood,
    between: np.ndarray   # its variance from passage to passage,
    within: np.ndarray    # and the variance of one trigram's


def _letters(raw: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """Letters of runs that hold no digit (numbers, keys and codes say nothing about a language)."""
    flags, digits = letter[raw], (raw >= 0x30) & (raw <= 0x39)
    starts, ends = runs(flags | digits)
    count = np.concatenate([[0], np.cumsum(digits)])
    for a, b in zip(*(x[count[ends] > count[starts]] for x in (starts, ends)), strict=True):
        flags[a:b] = False
    return flags


def _trigrams(raw: np.ndarray, offsets: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, rows and places of trigrams about a letter; other bytes than letters count as one blank."""
    flags = _letters(raw, letter)
    plain = np.where(flags, raw, 0x20).astype(np.uint32)
    code = (plain[:-2] << np.uint32(16)) | (plain[1:-1] << np.uint32(8)) | plain[2:] if len(raw) > 2 else np.zeros(0, np.uint32)
    at = np.flatnonzero(flags[1:-1]) if len(raw) > 2 else np.zeros(0, np.int64)
    row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 2 < offsets[row + 1]
    at, row = at[inside], row[inside]
    return ((code[at] * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64), row, at + 1


def deviations(raw: np.ndarray, offsets: np.ndarray, letter: np.ndarray, starts: np.ndarray, lang: np.ndarray, model: Familiarity) -> np.ndarray:
    """Standard deviations by which each row's mean log likelihood is above (below: negative) that of the
    languages' passages, given its length; 0 for rows without trigrams.  ``starts`` and ``lang``: where
    words begin and the language of each, so that a text that changes its language is measured by both."""
    n_rows = len(offsets) - 1
    if not len(model.langs):
        return np.zeros(n_rows)
    gram, row, at = _trigrams(raw, offsets, letter)
    of = lang[np.searchsorted(starts, at, side="right") - 1]
    n = np.maximum(np.bincount(row, minlength=n_rows), 1)
    mean = lambda x: np.bincount(row, weights=x, minlength=n_rows) / n
    spread = np.sqrt(mean(model.between[of]) + mean(model.within[of]) / n)
    return np.divide(mean(model.grams[of, gram] - model.centre[of]), spread, out=np.zeros(n_rows), where=spread > 0)


def learn_familiarity(passages: list[tuple[str, str]], lower, letter: np.ndarray) -> Familiarity:
    """From (language, text) passages: every other one of a language is counted, the rest set the scale."""
    langs = sorted({x for x, _ in passages})
    number = {x: i for i, x in enumerate(langs)}
    model = Familiarity(langs, np.zeros((len(langs), GRAMS), np.float32), *[np.zeros(len(langs)) for _ in range(3)])
    if not langs:
        return model
    data = pa.RecordBatch.from_arrays([pa.array([t for _, t in passages], pa.string())], ["t"])
    (_, raw, offsets), = text_slices(data, "t", 1 << 40)
    raw = lower(raw)
    lang = np.array([number[x] for x, _ in passages])
    nth = np.zeros(len(lang), np.int64)
    for j in range(len(langs)):
        mine = np.flatnonzero(lang == j)
        nth[mine] = np.arange(len(mine))
    gram, row, _ = _trigrams(raw, offsets, letter)
    few = np.bincount(lang, minlength=len(langs)) < 4
    counted = (nth % 2 == 0) | few[lang]
    for j in range(len(langs)):
        seen = np.bincount(gram[counted[row] & (lang[row] == j)], minlength=GRAMS) + _SMOOTH
        model.grams[j] = np.log(seen / seen.sum())
    n = np.bincount(row, minlength=len(lang))
    each = model.grams[lang[row], gram]
    mean = np.bincount(row, weights=each, minlength=len(lang)) / np.maximum(n, 1)
    for j in range(len(langs)):
        told = np.flatnonzero((lang == j) & (~counted | few[lang]) & (n > 20))
        if not len(told):
            model.centre[j], model.between[j], model.within[j] = 0.0, np.inf, np.inf
            continue
        # Medians: some labels are wrong, and some passages are in several languages.
        model.centre[j] = np.median(mean[told])
        model.within[j] = each[np.isin(row, told)].var()
        model.between[j] = max(0.02, (1.4826 * np.median(np.abs(mean[told] - model.centre[j]))) ** 2)
    return model
