"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to 3 letters inside words (a word's edge is a space). A feature's
value is its share of the text's n-grams times its inverse document frequency; document frequencies are
counted over all labelled training texts. Weights are trained by follow-the-regularised-leader with
L1 and L2 penalties on a bounded sample (`SAMPLE` texts a language, whole texts); a temperature is
then fitted on sample texts kept out of the training. Prediction is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import map_texts, slices

BITS = 18
SIZE = 1 << BITS
ORDERS = 3
#: Training texts a language, at most about this many; the rest only count in document frequencies.
SAMPLE = 400
SCALE = 100.0
UNKNOWN = "und"


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(texts: list[str | None], is_letter: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed n-grams of each order over all texts in one run, and where each text starts in it.

    A place without an n-gram of the order (it would hold a word's edge inside) has value SIZE.
    """
    lowered = [(" " + t.lower()) if t is not None else " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(t) for t in lowered])[:-1]]).astype(np.int64)
    letter = is_letter[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    kept[first] = True
    starts = np.cumsum(kept)[first] - 1
    c = np.where(letter, codes, np.uint32(32))[kept]
    edge = c == 32
    shift = np.uint32(32 - BITS)
    grams = [np.where(edge, SIZE, (c * np.uint32(0x9E3779B1)) >> shift).astype(np.int32)]
    h = c * np.uint32(0x85EBCA6B)
    inner = np.zeros(len(c), bool)
    for n in range(2, ORDERS + 1):
        if n > 2:
            inner[: -(n - 2)] |= edge[n - 2 :]
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0xC2B2AE35)
        h[: -(n - 1)] += c[n - 1 :] * np.uint32(0x27D4EB2F)
        value = np.where(inner, SIZE, ((h ^ (h >> np.uint32(13))) * np.uint32(0x9E3779B1)) >> shift).astype(np.int32)
        value[-(n - 1) :] = SIZE
        if n == 2:
            value[edge & np.append(edge[1:], True)] = SIZE
        # An n-gram must not run from one text into the next.
        for back in range(1, n):
            at = starts[1:] - back
            value[at[at >= 0]] = SIZE
        grams.append(value)
    return grams, starts


@dataclass
class Model:
    """Non-zero weights (already times inverse document frequency), biases, temperature and labels."""

    labels: list[str]
    features: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    #: Half the smallest score of a held-back row of the sample.
    least: float = 0.0

    def dense(self) -> np.ndarray:
        full = np.zeros((len(self.labels), SIZE + 1), np.float32)
        full[:, self.features] = self.weights
        return full


def predict(model: Model, dense: np.ndarray, is_letter: np.ndarray, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Label and probability of each text; a text without a letter, or any text without a trained label, is `und` at 0."""
    if not texts:
        return [], []
    grams, starts = ngrams(texts, is_letter)
    counts = sum(np.add.reduceat((g < SIZE).astype(np.int64), starts) for g in grams)
    logits = np.zeros((len(texts), len(model.labels)))
    for k in range(len(model.labels)):
        logits[:, k] = sum(np.add.reduceat(dense[k][g], starts, dtype=np.float64) for g in grams)
    logits = (SCALE * logits / np.maximum(counts, 1)[:, None] + model.bias) / model.temperature
    if not model.labels:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    shares = _softmax(logits)
    best = shares.argmax(axis=1)
    known = counts > 0
    names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
    return names, np.where(known, shares.max(axis=1), 0.0).tolist()


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(train: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts with any; at most SIZE rows reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter, mark = letters(), np.zeros(SIZE + 1, bool)
        df, texts = np.zeros(SIZE + 1, np.int64), 0
        for batch in batches:
            for rows in slices(batch, "text"):
                grams, starts = ngrams(rows["text"], is_letter)
                for a, b in zip(starts, [*starts[1:], len(grams[0])], strict=True):
                    for g in grams:
                        mark[g[a:b]] = True
                    mark[SIZE] = False
                    seen = np.flatnonzero(mark)
                    df[seen] += 1
                    mark[seen] = False
                    texts += bool(len(seen))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(df[seen], texts), pa.int64())], ["feature", "n"]
        )

    total = train.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(SIZE + 1, np.int64)
    df[total.column("feature").to_numpy()] = total.column("n").to_numpy()
    return df[:SIZE], int(df[-1])


def sample_features(train: DataFrame, size: int = SAMPLE) -> list[tuple[str, bool, np.ndarray, np.ndarray]]:
    """(label, for calibration, features, counts) of a sample, fixed by the hash of doc_id, of `size` texts a label."""
    totals = {r.lang: r.n for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return []
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)).alias("place")
    share = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1 << 30, size * (1 << 30) // n))])
    chosen = (
        train.select("lang", "text", "doc_id", place)
        .where(F.col("place") < share[F.col("lang")])
        .orderBy("place", "doc_id")
        .limit(2 * size * len(totals))
    )

    def work(rows: dict[str, list]) -> dict[str, list]:
        is_letter = letters()
        grams, starts = ngrams(rows["text"], is_letter)
        out: dict[str, list] = {"lang": rows["lang"], "place": rows["place"], "features": [], "counts": []}
        for a, b in zip(starts, [*starts[1:], len(grams[0])], strict=True):
            own = np.concatenate([g[a:b] for g in grams])
            f, n = np.unique(own[own < SIZE], return_counts=True)
            out["features"].append(f.astype(np.int32).tobytes())
            out["counts"].append(n.astype(np.int32).tobytes())
        return out

    schema = "lang string, place long, features binary, counts binary"
    found = map_texts(chosen, ["lang", "text", "place"], "text", schema, work).collect()
    return [
        (r.lang, r.place % 5 == 0, np.frombuffer(r.features, np.int32), np.frombuffer(r.counts, np.int32))
        for r in sorted(found, key=lambda r: (r.place, r.lang, r.features))
        if r.features
    ]


def ftrl(
    rows: list[tuple[int, np.ndarray, np.ndarray]],
    classes: int,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 0.05,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (class, feature) and biases of rows (class, features, values) by FTRL-proximal with elastic-net penalties."""
    z, n = np.zeros((classes, SIZE + 1)), np.zeros((classes, SIZE + 1))

    def weights(f: np.ndarray) -> np.ndarray:
        zf, penal = z[:, f], np.where(f == SIZE, 0.0, l1)
        rate = (beta + np.sqrt(n[:, f])) / alpha + np.where(f == SIZE, 0.0, l2)
        return np.where(np.abs(zf) <= penal, 0.0, -(zf - np.sign(zf) * penal) / rate)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            label, features, values = rows[i]
            f, x = np.append(features, SIZE), np.append(values, 1.0)
            w = weights(f)
            error = _softmax(w @ x)
            error[label] -= 1.0
            g = error[:, None] * x
            step = (np.sqrt(n[:, f] + g * g) - np.sqrt(n[:, f])) / alpha
            z[:, f] += g - step * w
            n[:, f] += g * g
    final = weights(np.arange(SIZE + 1))
    return final[:, :SIZE], final[:, SIZE]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of smallest mean log loss on held-back rows, between 1/20 and 20; 1 without such rows.

    Targets are smoothed as in Platt scaling (one row more of each other label), so that a faultless
    sample does not make every probability 1.
    """
    if not len(logits) or logits.shape[1] < 2:
        return 1.0
    n, k = logits.shape
    target = np.full((n, k), 1.0 / (n + k))
    target[np.arange(n), labels] = (n + 1.0) / (n + k)

    def loss(log_t: float) -> float:
        scaled = logits / np.exp(log_t)
        top = scaled.max(axis=1, keepdims=True)
        log_p = scaled - top - np.log(np.exp(scaled - top).sum(axis=1, keepdims=True))
        return float(-(target * log_p).sum(axis=1).mean())

    low, high, ratio = -3.0, 3.0, (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(labelled: DataFrame, size: int = SAMPLE) -> Model:
    """A model of the non-null `lang` of rows (doc_id, text, lang) with text."""
    labelled = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    sample = sample_features(labelled, size)
    labels = sorted({lang for lang, *_ in sample})
    if not labels:
        return Model([], np.zeros(0, np.int32), np.zeros((0, 0), np.float32), np.zeros(0), 1.0)
    df, texts = document_frequencies(labelled)
    idf = np.log((1 + texts) / (1 + df)) + 1
    at = {lang: k for k, lang in enumerate(labels)}
    rows = [(at[lang], held, f, SCALE * n / n.sum() * idf[f]) for lang, held, f, n in sample]
    weights, bias = ftrl([(k, f, x) for k, held, f, x in rows if not held] or [(k, f, x) for k, _, f, x in rows], len(labels))
    held = [(k, weights[:, f] @ x + bias) for k, out, f, x in rows if out]
    temperature = calibrate(np.array([x for _, x in held]), np.array([k for k, _ in held], dtype=int))
    used = np.flatnonzero(np.abs(weights).sum(axis=0))
    least = 0.5 * min((float(_softmax(x[None, :] / temperature).max()) for _, x in held), default=0.0)
    return Model(labels, used.astype(np.int32), (weights[:, used] * idf[used]).astype(np.float32), bias, temperature, least)


def fold() -> Column:
    """crc32 of doc_id as text, modulo 4; null for a null doc_id, which is then neither learnt from nor held out."""
    return F.crc32(F.col("doc_id").cast("string")) % 4


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """Per document: doc_id, held_out (fold 2), lang_pred, score (0 to 1).

    Without a model one is trained on the documents outside fold 2. Null texts and texts without a
    letter are `und` at score 0; so is all if no label can be learnt. Of labels with equal scores the
    first in order is taken. Whole texts are read, however long; repeated rows each get a row; an empty
    table gives no rows; only doc_id, text and lang are read, so other columns cannot clash.
    """
    model = model or train(docs.where(fold() != 2))

    def setup() -> Callable[[dict[str, list]], dict[str, list]]:
        dense, is_letter = model.dense(), letters()

        def work(rows: dict[str, list]) -> dict[str, list]:
            names, scores = predict(model, dense, is_letter, rows["text"])
            return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "lang_pred": names, "score": scores}

        return work

    marked = docs.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "text")
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return map_texts(marked, ["doc_id", "held_out", "text"], "text", schema, work=dict, setup=setup)


def recognised(docs: DataFrame, model: Model | None = None, wanted: Sequence[str] | None = None, least: float | None = None) -> DataFrame:
    """`docs` without the documents whose language is not recognised; no shuffle.

    A text is rejected if its prediction is `und` (null, or no letter), is not one of the `wanted` languages
    (all learnt ones by default), or has a score below `least`. The default of `least` is half the smallest
    score that the model gives to a held-back row of its sample, so texts in a learnt language stay.
    Where no model can be trained all rows stay. Rows are judged by their own whole text, also where a
    doc_id repeats or is null; other columns are handed on; an empty table stays empty.
    """
    model = model or train(docs.where(fold() != 2))
    bound = model.least if least is None else least
    allowed = frozenset(model.labels if wanted is None else wanted)

    @F.pandas_udf("boolean")
    def accepted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        dense, is_letter = model.dense(), letters()
        for part in parts:
            kept: list[bool] = []
            for rows in slices(pa.RecordBatch.from_pydict({"text": pa.array(part, pa.string())}), "text"):
                names, scores = predict(model, dense, is_letter, rows["text"])
                kept += [name in allowed and score >= bound for name, score in zip(names, scores, strict=True)]
            yield pd.Series(kept, dtype=bool)

    if not model.labels:
        return docs
    return docs.where(accepted("text"))
