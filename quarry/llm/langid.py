"""Language of words by a linear-chain conditional random field, and of documents by their words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from quarry.llm.common import SLICE_BYTES, byte_set, checked_broadcast, held_out, prefix_hashes, span_hashes, text_slices, without, word_spans
from quarry.llm.familiar import Familiarity, deviations, learn_familiarity
from quarry.session import materialize

#: Hashed features, words of a training sequence, and words that forward-backward handles in one step.
FEATURES, SEQUENCE, CHUNK = 1 << 16, 48, 64
#: Frequent words of a language that are its lexicon.
LEXICON = 400
_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
OUTPUT = ("lang_pred", "score", "lang_spans", "deviation")


def lower_latin(raw: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and, in UTF-8, of the letters from U+00C0 to U+00DE."""
    up = (raw >= 0x41) & (raw <= 0x5A)
    wide = np.zeros(len(raw), bool)
    wide[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97)
    return raw + ((up | wide).view(np.uint8) << 5)


@dataclass
class Tagger:
    langs: list[str]
    weights: np.ndarray       # (FEATURES + languages, languages)
    transitions: np.ndarray   # (languages, languages): from, to
    lexicon: np.ndarray       # sorted hashes of lexicon words
    lexicon_of: np.ndarray    # (words of the lexicon, languages) flags


def word_features(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, lexicon: np.ndarray, lexicon_of: np.ndarray):
    """Features of words as (word, feature, value): the word, its prefixes and suffixes up to four
    bytes, all its trigrams (each by its share), and the lexicons that have it."""
    n = len(starts)
    each = np.arange(n)
    whole = span_hashes(sums, starts, ends)
    slot = lambda h, salt: ((h ^ np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) % np.uint64(FEATURES)).astype(np.int64)
    word, feature, value = [each], [slot(whole, 1)], [np.ones(n)]
    for k in (1, 2, 3, 4):
        for salt, a, b in ((10 + k, starts, np.minimum(starts + k, ends)), (20 + k, np.maximum(ends - k, starts), ends)):
            word.append(each)
            feature.append(slot(span_hashes(sums, a, b), salt))
            value.append(np.ones(n))
    grams = np.maximum(ends - starts - 2, 0)
    of = np.repeat(each, grams)
    at = starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(grams) - grams, grams)
    word.append(of)
    feature.append(slot(span_hashes(sums, at, at + 3), 30))
    value.append(2.0 / grams[of])
    if len(lexicon):
        place = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
        known = np.flatnonzero(lexicon[place] == whole)
        which, lang = np.nonzero(lexicon_of[place[known]])
        word.append(known[which])
        feature.append(FEATURES + lang)
        value.append(np.ones(len(which)))
    return np.concatenate(word), np.concatenate(feature), np.concatenate(value)


def emissions(features, n: int, weights: np.ndarray) -> np.ndarray:
    word, feature, value = features
    out = np.empty((n, weights.shape[1]))
    for j in range(weights.shape[1]):
        out[:, j] = np.bincount(word, weights=weights[feature, j] * value, minlength=n)
    return out


def posteriors(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Forward-backward: the labels' probabilities of every word.  ``first``: each sequence's first word, n + 1.

    Sequences are cut into chunks that run side by side.  A chunk's product of transfer matrices takes
    the forward and backward messages across it, so the result is that of the whole sequence.
    """
    labels = scores.shape[1]
    out = np.zeros(scores.shape)
    if not out.size:
        return out
    step = np.exp(transitions - transitions.max())
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    counts = np.diff(first)
    per = -(-counts // CHUNK)
    row = np.repeat(np.arange(len(counts)), per)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    begin = first[row] + nth * CHUNK
    size = np.minimum(CHUNK, first[row + 1] - begin)
    order = np.argsort(-size, kind="stable")
    row, nth, begin, size = row[order], nth[order], begin[order], size[order]
    live = np.searchsorted(-size, -np.arange(CHUNK), side="left")  # chunks longer than t

    product = np.broadcast_to(np.eye(labels), (len(row), labels, labels)).copy()
    for t in range(CHUNK):
        k = live[t]
        if not k:
            break
        p = (product[:k].reshape(-1, labels) @ step).reshape(k, labels, labels) * e[begin[:k] + t][:, None, :]
        product[:k] = p / p.sum(axis=(1, 2), keepdims=True)

    # Messages into the chunks of a sequence, chunk by chunk, all sequences side by side.
    place = np.lexsort((nth, row))
    head = np.cumsum(per) - per
    left = np.full((len(row), labels), 1.0 / labels)
    right = np.ones((len(row), labels)) / labels
    for q in range(1, int(per.max())):
        rows = np.flatnonzero(per > q)
        now, before = place[head[rows] + q], place[head[rows] + q - 1]
        a = np.einsum("nl,nlk->nk", left[before], product[before])
        left[now] = a / a.sum(axis=1, keepdims=True)
        back, after = place[head[rows] + per[rows] - 1 - q], place[head[rows] + per[rows] - q]
        b = np.einsum("nkl,nl->nk", product[after], right[after])
        right[back] = b / b.sum(axis=1, keepdims=True)

    forward = np.empty(scores.shape)
    a = left.copy()
    for t in range(CHUNK):
        k = live[t]
        if not k:
            break
        x = (a[:k] @ step) * e[begin[:k] + t]
        a[:k] = x / x.sum(axis=1, keepdims=True)
        forward[begin[:k] + t] = a[:k]
    b = right
    for t in range(CHUNK - 1, -1, -1):
        k = live[t]
        if not k:
            continue
        at = begin[:k] + t
        x = forward[at] * b[:k]
        out[at] = x / x.sum(axis=1, keepdims=True)
        y = (e[at] * b[:k]) @ step.T
        b[:k] = y / y.sum(axis=1, keepdims=True)
    return out


def _pair_marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Expected transitions, summed over sequences of equal length (training only)."""
    n, length = len(first) - 1, int(first[1] - first[0])
    step = np.exp(transitions - transitions.max())
    e = np.exp(scores - scores.max(axis=1, keepdims=True)).reshape(n, length, -1)
    alpha = np.empty_like(e)
    a = np.full((n, e.shape[2]), 1.0 / e.shape[2])
    for t in range(length):
        a = (a @ step) * e[:, t]
        a /= a.sum(axis=1, keepdims=True)
        alpha[:, t] = a
    total = np.zeros_like(step)
    b = np.ones((n, e.shape[2]))
    for t in range(length - 1, 0, -1):
        eb = e[:, t] * b
        pair = alpha[:, t - 1][:, :, None] * step[None] * eb[:, None, :]
        total += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = eb @ step.T
        b /= b.sum(axis=1, keepdims=True)
    return total


def train(passages: list[tuple[str, str]], sequences: int = 4000, epochs: int = 5, batch: int = 100, rate: float = 0.05, seed: int = 11) -> Tagger:
    """A tagger learnt from (language, text) passages.

    Sequences of words are cut from the passages; four in ten continue with a passage of any
    language, which teaches the transitions what a switch of language costs.
    """
    langs = sorted({lang for lang, _ in passages})
    if not langs:
        return Tagger([], np.zeros((FEATURES, 0)), np.zeros((0, 0)), np.zeros(0, np.uint64), np.zeros((0, 0), bool))
    number = {x: i for i, x in enumerate(langs)}
    data = pa.RecordBatch.from_arrays([pa.array([t for _, t in passages], pa.string())], ["t"])
    (_, raw, offsets), = text_slices(data, "t", 1 << 40)
    raw = lower_latin(raw)
    starts, ends, first = word_spans(_LETTER[raw], offsets)
    sums = prefix_hashes(raw)
    hashes = span_hashes(sums, starts, ends)
    label = np.repeat([number[x] for x, _ in passages], np.diff(first))
    unique, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    counts = np.zeros((len(unique), len(langs)))
    np.add.at(counts, (inverse, label), 1)
    lists = np.zeros(counts.shape, bool)
    for j in range(len(langs)):
        top = np.argsort(-counts[:, j], kind="stable")[:LEXICON]
        lists[top[counts[top, j] > 1], j] = True
    known = lists.any(axis=1)
    lexicon, lexicon_of = unique[known], lists[known]
    word, feature, value = word_features(sums, starts[index], ends[index], lexicon, lexicon_of)
    by = np.argsort(word, kind="stable")
    word, feature, value = word[by], feature[by], value[by]
    slots = np.searchsorted(word, np.arange(len(unique) + 1))

    rng = np.random.default_rng(seed)
    full = np.flatnonzero(np.diff(first) > 0)
    n_langs = len(langs)
    weights = np.zeros((FEATURES + n_langs, n_langs))
    transitions = np.eye(n_langs)
    squares, turns = np.full(weights.shape, 1e-8), np.full(transitions.shape, 1e-8)
    if not len(full) or n_langs < 2:
        return Tagger(langs, weights, transitions, lexicon, lexicon_of)

    def piece(size: int) -> np.ndarray:
        out: list[np.ndarray] = []
        while size:
            r = full[rng.integers(len(full))]
            a = int(rng.integers(first[r], first[r + 1]))
            got = np.arange(a, min(a + size, first[r + 1]))
            out.append(got)
            size -= len(got)
        return np.concatenate(out)

    made = []
    for _ in range(sequences):
        cut = SEQUENCE if rng.random() > 0.4 else int(rng.integers(1, SEQUENCE))
        made.append(np.concatenate([piece(cut), piece(SEQUENCE - cut)]) if cut < SEQUENCE else piece(SEQUENCE))
    made = np.array(made)
    for _ in range(epochs):
        for k in range(0, sequences, batch):
            at = made[rng.permutation(sequences)[:batch]]
            n = len(at)
            flat = at.ravel()
            used, local = np.unique(inverse[flat], return_inverse=True)
            span = slots[used + 1] - slots[used]
            pick = np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span) + np.repeat(slots[used], span)
            local_word = np.repeat(np.arange(len(used)), span)
            scores = emissions((local_word, feature[pick], value[pick]), len(used), weights)[local]
            begin = np.arange(n + 1) * SEQUENCE
            p = posteriors(scores, begin, transitions)
            gold = np.zeros_like(p)
            gold[np.arange(len(flat)), label[flat]] = 1
            slope = np.zeros((len(used), n_langs))
            np.add.at(slope, local, (gold - p) / n)
            touched, where = np.unique(feature[pick], return_inverse=True)
            g = np.stack([np.bincount(where, weights=slope[local_word, j] * value[pick]) for j in range(n_langs)], 1) - 1e-4 * weights[touched]
            squares[touched] += g * g
            weights[touched] += rate * g / np.sqrt(squares[touched])
            y = label[flat].reshape(n, SEQUENCE)
            seen = np.zeros_like(transitions)
            np.add.at(seen, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            g = (seen - _pair_marginals(scores, begin, transitions, p)) / n
            turns += g * g
            transitions += rate * g / np.sqrt(turns)
    return Tagger(langs, weights, transitions, lexicon, lexicon_of)


def _tag(raw: np.ndarray, offsets: np.ndarray, model: Tagger):
    low = lower_latin(raw)
    starts, ends, first = word_spans(_LETTER[low], offsets)
    sums = prefix_hashes(low)
    _, index, inverse = np.unique(span_hashes(sums, starts, ends), return_index=True, return_inverse=True)
    features = word_features(sums, starts[index], ends[index], model.lexicon, model.lexicon_of)
    scores = emissions(features, len(index), model.weights)[inverse]
    return starts, ends, first, posteriors(scores, first, model.transitions)


def _identify(batches: Iterator[pa.RecordBatch], model: Tagger, fit: Familiarity | None, text: str, schema: pa.Schema, spans: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        # A word has a row of probabilities, so many languages mean shorter slices.
        for rows, raw, offsets in text_slices(batch, text, max(1 << 16, SLICE_BYTES * 8 // max(8, len(model.langs)))):
            starts, ends, first, p = _tag(raw, offsets, model)
            n = rows.num_rows
            mass = np.zeros((n, len(model.langs)))
            row = np.repeat(np.arange(n), np.diff(first))
            for j in range(len(model.langs)):
                mass[:, j] = np.bincount(row, weights=p[:, j], minlength=n)
            total = mass.sum(axis=1)
            letters = np.bincount(row, weights=(raw[starts] < 0x80), minlength=n) > 0
            for k in np.flatnonzero(~letters & (np.diff(first) > 0)):
                letters[k] = any(ch.isalpha() for ch in raw[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace"))
            sure = letters & (total > 0)
            best = mass.argmax(axis=1) if len(model.langs) else np.zeros(n, int)
            put = {"lang_pred": [model.langs[b] if s else "und" for b, s in zip(best.tolist(), sure.tolist(), strict=True)],
                   "score": [min(1.0, float(mass[k, best[k]] / total[k])) if sure[k] else 0.0 for k in range(n)]}
            if fit is not None:
                put["deviation"] = np.where(sure, deviations(lower_latin(raw), offsets, _LETTER, starts, p.argmax(axis=1) if len(model.langs) else starts, fit), 0.0).tolist()
            if spans:
                put["lang_spans"] = [_spans(p[first[k]:first[k + 1]].argmax(axis=1), starts[first[k]:first[k + 1]] - offsets[k],
                                            ends[first[k]:first[k + 1]] - offsets[k], model.langs) if sure[k] else [] for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(put[f.name], f.type) if f.name in put else rows.column(f.name).cast(f.type) for f in schema], schema=schema)


def _spans(labels: np.ndarray, starts: np.ndarray, ends: np.ndarray, langs: list[str]) -> list[dict]:
    """Runs of words of one language, as [start, end) in bytes of the text."""
    cut = np.flatnonzero(np.diff(labels)) + 1
    a, b = np.concatenate([[0], cut]), np.append(cut, len(labels)) - 1
    return [{"start": int(starts[i]), "end": int(ends[j]), "lang": langs[labels[i]]} for i, j in zip(a, b, strict=True)]


def sample_passages(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = 500, most_rows: int = 100_000,
                    passage_chars: int = 1500) -> list[tuple[str, str]]:
    """The bounded sample that is learnt from: of every language the ``per_lang`` rows that come first by a
    hash of their key (fewer, if all languages together would have more than ``most_rows``, but one at
    least), and of each row a passage of ``passage_chars`` at a place that the hash sets.  Held-out
    rows and null or empty texts or labels are never read for learning.  Languages are counted first,
    so that of each only some times ``per_lang`` rows, chosen by hash as well, are ranked in one task."""
    order = F.xxhash64(F.col(key), F.lit(5))
    rows = docs.filter(~held_out(F.col(key)) & F.col(lang).isNotNull() & (F.length(text) > 0))
    counts = materialize(rows.groupBy(F.col(lang).alias("__lang")).agg(F.count(F.lit(1)).alias("n")), "languages")
    each = max(1, min(per_lang, most_rows // max(1, counts.count())))
    at = F.pmod(F.xxhash64(F.col(key), F.lit(6)), F.greatest(F.lit(1), F.length(text) - passage_chars)).cast("int") + 1
    rows = rows.join(checked_broadcast(counts, 64), F.col(lang) == F.col("__lang"))
    rows = rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.col("n")) < 4 * each)
    rows = rows.select(F.col("__lang").alias("lang"), order.alias("o"), F.substring(F.col(text), at, F.lit(passage_chars)).alias("t"))
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("o", "t"))).filter(F.col("k") <= each)
    return [(r["lang"], r["t"]) for r in first.orderBy("lang", "k").collect()]


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", **sample) -> Tagger:
    """A tagger of all languages of ``docs``, learnt from ``sample_passages``."""
    return train(sample_passages(docs, text, lang, key, **sample))


def familiarity(passages: list[tuple[str, str]]) -> Familiarity:
    return learn_familiarity(passages, lower_latin, _LETTER)


def identify(docs: DataFrame, model: Tagger, text: str = "text", spans: bool = False, fit: Familiarity | None = None) -> DataFrame:
    """``docs`` with lang_pred, score (the share of the words' probability that the language has) and, if
    asked for, lang_spans (runs of words of one language, in bytes of the text).  With ``fit`` also
    deviation: how many standard deviations the text's trigrams are likelier in that language than those
    of the passages it was learnt from (unlikelier: negative), whatever the number of languages; a text
    in a language that was not learnt is far below zero.

    Words are runs of letters; every word of the whole text is labelled.  A null text, one without a
    letter, or a model that has learnt no language gives ``und`` with score 0 and no spans.  Input columns
    named like the output columns are replaced, others pass through; equal texts get equal answers.
    """
    docs = without(docs, *OUTPUT)
    out = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"))
    fields = [T.StructField(f.name, f.dataType) for f in out.schema]
    if fit is not None:
        fields.append(T.StructField("deviation", T.DoubleType()))
    if spans:
        span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
        fields.append(T.StructField("lang_spans", T.ArrayType(span)))
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)
    sent = docs.sparkSession.sparkContext.broadcast((model, fit))
    return docs.mapInArrow(lambda b: _identify(b, *sent.value, text, arrow, spans), schema)
