"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are the runs of two, three and four bytes that start at each letter and stay
in its word, hashed into buckets. Every bucket has an embedding; their average goes through a
linear softmax. Both are trained by stochastic gradient descent in numpy on a bounded sample.
A held-out part of the sample calibrates the probabilities (one temperature).

The softmax only chooses among the learned languages. Whether a text is in any of them is told by
the mean log likelihood of its buckets in the likeliest one. A logistic curve over it, fitted on
the held-out texts against texts that are in no learned language (the same ones without the
counts of their own language, with shuffled letters, and runs of random letters), gives the chance
that the language is known. The score is the product of both chances. It is rejected under even
odds, or under the lowest scores of held-out texts with a right prediction if these are lower. Without
held-out texts (fewer than five of every language) nothing with a letter is rejected.

Defined cases: a null text or one without a letter is ``und`` with score 0 and is rejected. A
repeated row gets the same result every time and is learned from once. Texts of any length are read whole, in blocks of
bounded size. An empty table gives an empty result; without any labelled text every prediction
is ``und``. Other columns are not touched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.blocks import PAD, array_groups, joined
from millrace.llm.storage import stored

UNKNOWN = "und"
BUCKET_BITS = 16
DIMENSIONS = 12
# Upper bound of the distinct rows that the model is fitted on, over all languages together.
SAMPLE_ROWS = 3000
# Share of right predictions of the calibration texts that may be rejected.
REJECTED_SHARE = 0.001
EVEN_ODDS = 0.5
# What is added to every bucket's count, and the letters from which on more of them hardly add
# to what the mean likelihood of a text tells.
SMOOTHING = 0.01
TELLING_LETTERS = 64

# Bytes whose bucket rows are held at a time.
SUM_BYTES = 1 << 18

_ORDERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)
_LETTERS = np.zeros(256, np.uint8)
_LETTERS[0x80:] = np.arange(0x80, 0x100)
for _c in range(26):
    _LETTERS[[ord("A") + _c, ord("a") + _c]] = ord("a") + _c


@dataclass(frozen=True)
class LanguageModel:
    labels: list[str]
    logits: np.ndarray  # one row per bucket: embedding times output weights
    bias: np.ndarray
    temperature: float
    likelihood: np.ndarray  # one row per bucket: its log probability in each language
    known: np.ndarray  # of the logistic curve over ``_evidence``
    threshold: float


def _buckets(part: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Letter positions of a byte run that ends with PAD blanks, and their buckets by order."""
    a = _LETTERS[part].astype(np.uint32)
    b, c, d = a[1:-2], a[2:-1].copy(), a[3:].copy()
    a = a[:-3]
    c[b == 0] = 0
    d[c == 0] = 0
    at = np.flatnonzero(a)
    grams = a[at] | b[at] << np.uint32(8)
    shift = np.uint32(32 - BUCKET_BITS)
    result = [(grams * _ORDERS[0]) >> shift]
    for order, (byte, left) in enumerate(((c, 16), (d, 24)), start=1):
        grams = grams | byte[at] << np.uint32(left)
        result.append(((grams ^ (grams >> np.uint32(15))) * _ORDERS[order]) >> shift)
    return at, result


_ID = np.min_scalar_type((1 << BUCKET_BITS) - 1)


def _features(data: bytes) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct buckets of one text, how often each occurs, in the smallest types, and the letters."""
    at, grams = _buckets(np.frombuffer(data + b" " * PAD, np.uint8))
    ids, counts = np.unique(np.concatenate(grams), return_counts=True)
    return ids.astype(_ID), counts.astype(np.min_scalar_type(counts.max(initial=0))), len(at)


def _weights(counts: np.ndarray) -> np.ndarray:
    """The weight of each bucket in the average."""
    return counts / max(1, int(counts.sum()))


def _excerpts(data: bytes, rng: np.random.Generator) -> list[bytes]:
    """A training text itself and spans of it: the model must also know short texts."""
    spans = [data]
    for length in (24, 80, 300):
        if len(data) > length:
            at = int(rng.integers(0, len(data) - length))
            spans.append(data[at : at + length])
    return spans


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _unlearned(span: bytes, rng: np.random.Generator) -> list[bytes]:
    """A text with its letters shuffled, and one of as many random letters: in no language."""
    signs = list(span.decode(errors="ignore"))
    at = [i for i, sign in enumerate(signs) if sign.isalpha()]
    for i, sign in zip(at, [signs[at[j]] for j in rng.permutation(len(at))]):
        signs[i] = sign
    runs = rng.integers(ord("a"), ord("z") + 1, len(span)).astype(np.uint8)
    runs[rng.random(len(span)) < 1 / 6] = ord(" ")
    return ["".join(signs).encode(), runs.tobytes()]


def _evidence(likelihood: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """What the logistic curve reads of mean log likelihoods: more letters tell more."""
    weight = letters / (1 + letters / TELLING_LETTERS)
    return np.stack([weight * likelihood, weight, np.ones(len(weight))], axis=1)


def _chance_known(curve: np.ndarray, evidence: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(evidence @ curve, -50, 50)))


def _curve(inside: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """The logistic curve between two sets of evidence that count the same, by Newton's method."""
    x = np.concatenate([inside, outside])
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x = x / scale
    y = np.repeat([1.0, 0.0], [len(inside), len(outside)])
    weight = np.repeat([0.5 / len(inside), 0.5 / len(outside)], [len(inside), len(outside)])
    curve = np.zeros(x.shape[1])

    def loss(c: np.ndarray) -> float:
        z = x @ c
        return float(weight @ (np.logaddexp(0, z) - y * z) + 5e-6 * c @ c)

    for _ in range(100):
        p = _chance_known(curve, x)
        slope = x.T @ (weight * (p - y)) + 1e-5 * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-5 * np.eye(len(curve))
        step = np.linalg.solve(bend, slope)
        while loss(curve - step) > loss(curve) and np.abs(step).max() > 1e-6:
            step = step / 2
        curve = curve - step
        if np.abs(step).max() < 1e-6:
            break
    return curve / scale


def train(rows: list[tuple[str, str]], seed: int = 1, epochs: int = 4) -> LanguageModel:
    """Fit on (text, language) rows; of each language every fifth calibrates and is not fitted on."""
    rng = np.random.default_rng(seed)
    labels = sorted({lang for _, lang in rows})
    index = {lang: k for k, lang in enumerate(labels)}
    fit, calibrate, unlearned = [], [], []
    k = max(1, len(labels))
    seen = [0] * k
    counts = np.full((1 << BUCKET_BITS, k), SMOOTHING)
    for text, lang in rows:
        y = index[lang]
        seen[y] += 1
        held_out = seen[y] % 5 == 0
        for j, span in enumerate(_excerpts(text.encode(), rng)):
            ids, times, letters = _features(span)
            if not len(ids):
                continue
            if held_out:
                calibrate.append((ids, times, letters, y, j == 0))
                unlearned += [f for f in map(_features, _unlearned(span, rng)) if f[2]]
            else:
                fit.append((ids, times, y))
                if j == 0:
                    counts[ids, y] += 3 * letters * _weights(times)
    likelihood = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    embedding = rng.normal(0, 0.05, (1 << BUCKET_BITS, DIMENSIONS))
    output = rng.normal(0, 0.05, (DIMENSIONS, k))
    bias = np.zeros(k)
    share = np.bincount([y for *_, y in fit], minlength=k) if fit else np.ones(k)
    balance = len(fit) / (k * np.maximum(share, 1))
    steps, step = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for j in rng.permutation(len(fit)):
            ids, times, y = fit[j]
            weights = _weights(times)
            rate = 1 - step / steps
            step += 1
            hidden = weights @ embedding[ids]
            error = _softmax(hidden @ output + bias)
            error[y] -= 1
            error *= balance[y]
            back = output @ error
            output -= 0.5 * rate * np.outer(hidden, error)
            embedding[ids] -= 20 * rate * np.outer(weights, back)
    logits = embedding @ output
    if not calibrate:
        always = np.array([0.0, 0.0, 50.0])
        return LanguageModel(labels, logits.astype(np.float32), bias, 1.0, likelihood, always, 0.0)
    raw = np.array([_weights(times) @ logits[ids] + bias for ids, times, *_ in calibrate])
    truth = np.array([y for *_, y, _ in calibrate])
    at = np.arange(len(truth))
    loss = {
        t: -np.log(np.maximum(_softmax(raw / t)[at, truth], 1e-12)).mean()
        for t in np.geomspace(0.05, 20, 121)
    }
    temperature = float(min(loss, key=loss.get))
    means = np.array([_weights(times) @ likelihood[ids] for ids, times, *_ in calibrate])
    letters = np.array([n for _, _, n, *_ in calibrate])
    whole = np.array([first for *_, first in calibrate])
    inside = _evidence(means.max(axis=1), letters)
    outside = [_evidence(np.array([(_weights(times) @ likelihood[ids]).max()]), np.array([n])) for ids, times, n in unlearned]
    if k > 1:
        means[at, truth] = -np.inf
        outside.append(_evidence(means.max(axis=1), letters))
    known = _curve(inside, np.concatenate(outside))
    scores = _softmax(raw / temperature)
    # Excerpts can be cut out of a mail address or a secret, so the whole texts set the bound.
    right = (scores.max(axis=1) * _chance_known(known, inside))[whole & (scores.argmax(axis=1) == truth)]
    threshold = min([EVEN_ODDS, *np.quantile(right, [REJECTED_SHARE] * bool(len(right)))])
    return LanguageModel(
        labels, logits.astype(np.float32), bias, temperature, likelihood, known, float(threshold)
    )


def _sums(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Summed bucket rows and number of letters of every text, over blocks of bounded size."""
    n = len(bounds) - 1
    sums, letters = np.zeros((n, table.shape[1])), np.zeros(n, np.int64)
    for lo in range(0, max(0, len(data) - PAD + 1), SUM_BYTES):
        part = data[lo : lo + SUM_BYTES + PAD - 1]
        if len(part) < PAD:
            break
        at, grams = _buckets(part)
        first = int(np.searchsorted(bounds, lo, side="right")) - 1
        last = int(np.searchsorted(bounds, lo + len(part), side="left"))
        last = min(n, last)
        cuts = np.searchsorted(at, bounds[first : last + 1] - lo)
        rows = table[grams[0]]
        for more in grams[1:]:
            rows += table[more]
        running = np.zeros((len(at) + 1, table.shape[1]))
        np.cumsum(rows, axis=0, dtype=np.float64, out=running[1:])
        sums[first:last] += running[cuts[1:]] - running[cuts[:-1]]
        letters[first:last] += cuts[1:] - cuts[:-1]
    return sums, letters


def _has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(model: LanguageModel, texts: pa.Array) -> pa.StructArray:
    """struct<lang, score, accepted> of every text, taken in groups of texts of bounded size."""
    parts = [_predicted(model, texts.slice(first, last - first)) for first, last in array_groups(texts)]
    return pa.concat_arrays(parts) if parts else pa.array([], _RESULT)


_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


def _predicted(model: LanguageModel, texts: pa.Array) -> pa.StructArray:
    data, bounds = joined(texts)
    n = len(texts)
    names = np.full(n, UNKNOWN, object)
    scores, accepted = np.zeros(n), np.zeros(n, bool)
    if n and model.labels:
        k = len(model.labels)
        sums, letters = _sums(data, bounds, np.hstack([model.logits, model.likelihood]))
        means = sums / np.maximum(1, 3 * letters)[:, None]
        chance = _softmax((means[:, :k] + model.bias) / model.temperature)
        best = chance.argmax(axis=1)
        inside = _chance_known(model.known, _evidence(means[:, k:].max(axis=1), letters))
        known = letters > 0
        # Bytes above ASCII may be signs instead of letters; those few texts are looked at. No text
        # is without bytes here, as blanks follow each.
        plain = np.logical_or.reduceat((data < 0x80) & (_LETTERS[data] > 0), bounds[:-1])
        for i in np.flatnonzero(known & ~plain):
            known[i] = _has_letter(texts[int(i)].as_py())
        names[known] = np.array(model.labels, object)[best[known]]
        exact = chance.max(axis=1) * inside
        scores[known] = np.round(exact[known], 6)
        accepted = known & (exact >= model.threshold)
    return pa.StructArray.from_arrays(
        [pa.array(names, pa.string()), pa.array(scores), pa.array(accepted)],
        ["lang", "score", "accepted"],
    )


def labelled_sample(rows: DataFrame, limit: int = SAMPLE_ROWS) -> list[tuple[str, str]]:
    """Distinct (text, lang) rows in hash order, at most an equal part of ``limit`` per language.

    Copies of a text count once, before anything is counted or chosen. Every language has at least
    one row, so only more languages than ``limit`` give more rows. Hashes alone are compared; texts
    are read for the chosen ones, and only these reach the driver.
    """
    labelled = rows.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    hashed = labelled.select(
        "lang", F.xxhash64("text").alias("place"), F.xxhash64("text", F.lit("order")).alias("turn")
    )
    totals = stored(hashed.groupBy("lang").agg(F.approx_count_distinct("place").alias("texts")), "languages")
    languages = totals.count()
    if not languages:
        return []
    each = max(1, limit // languages)
    # Turns are even, so a share of them leaves some four times what is wanted of each language, and
    # no task ranks more than that, however many texts there are.
    place = F.shiftrightunsigned("turn", 11) / float(1 << 53)
    early = hashed.join(totals, "lang").where(place * F.col("texts") <= 4 * each + 64)
    ranked = early.drop("texts").distinct().withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy("turn", "place"))
    )
    chosen = ranked.where(F.col("rank") <= each).select("lang", "place", "turn")
    texts = labelled.withColumn("place", F.xxhash64("text")).join(F.broadcast(chosen), ["lang", "place"])
    found = texts.groupBy("lang", "place", "turn").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["lang"]) for r in sorted(found, key=lambda r: (r["turn"], r["text"], r["lang"]))]


def language_of(model: LanguageModel) -> Callable[[Column], Column]:
    """A function of a text column that gives struct<lang, score, accepted>."""

    @F.arrow_udf("struct<lang: string, score: double, accepted: boolean>")
    def language(texts: pa.Array) -> pa.Array:
        return predict(model, texts)

    return language
