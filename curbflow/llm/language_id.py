"""Operator 5: language identification with error-correcting output codes."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import Shared, map_slices, texts

DIMENSIONS = 1 << 15
# A document is flagged as ambiguous if the nearest two codewords are this close in probability.
MARGIN = 0.2

_LETTERS = re.compile(r"[^\W\d_]")
_RUNS = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ngrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte n-grams of one to four, within and around runs of letters; A-Z lower-cased."""
    data = np.frombuffer(b" " + _RUNS.sub(b" ", text).translate(_LOWER) + b" ", dtype=np.uint8).astype(np.uint32)
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    code = np.zeros(len(data), dtype=np.uint32)
    for size in range(1, 5):
        if len(data) < size:
            break
        code = code[: len(data) - size + 1] * np.uint32(257) + data[size - 1 :] + np.uint32(1)
        mixed = (code * np.uint32(2654435761) + np.uint32(size)) >> np.uint32(17)
        total += np.bincount(mixed, minlength=DIMENSIONS)
    return total


def codewords(classes: int) -> np.ndarray:
    """The exhaustive code: every split of the classes into two parts once, as rows of 0/1 by class (bounded to 63 splits)."""
    if classes < 2:
        return np.ones((classes, 1), dtype=np.int8)
    splits = range(1, 1 << (classes - 1)) if classes <= 7 else None
    if splits is None:
        random = np.random.default_rng(7)
        code = random.integers(0, 2, (classes, 63))
        bits = max(1, (classes - 1).bit_length())
        code[:, :bits] = (np.arange(classes)[:, None] >> np.arange(bits)) & 1
        return code.astype(np.int8)
    return np.array([[(s >> k) & 1 for s in splits] for k in range(classes)], dtype=np.int8)


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: float

    def predict(self, counts: np.ndarray) -> tuple[str, float, bool]:
        """The language with the nearest codeword, its probability, and whether another is about as near."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margins = counts @ self.weights / max(1, counts.sum()) * self.scale
        # Logistic loss of each classifier's margin against the bit of each codeword, weighted alike.
        signs = 2 * self.code - 1
        loss = np.logaddexp(0, -signs * margins[None, :]).sum(axis=1)
        power = np.exp(-(loss - loss.min()))
        share = power / power.sum()
        best = int(share.argmax())
        second = float(np.delete(share, best).max())
        return self.languages[best], float(share[best]), bool(share[best] - second < MARGIN)


def train(docs: DataFrame, smoothing: float = 0.5, scale: float = 8.0) -> Model | None:
    """One binary classifier per bit of the code, from n-gram counts by language; None without labelled texts.

    All rows with a text and a lang count. Workers add up counts by language, so what is shuffled and gathered is one
    vector per language and worker, then per language. A classifier weighs an n-gram by the log odds of its rate among the languages
    whose bit is 1 against the others, every language weighing the same.
    """

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch)):
                if text:
                    totals[lang] = totals.get(lang, 0) + ngrams(text)
        for lang, counts in totals.items():
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(counts[used])], names=["lang", "k", "n"])

    kept = docs.select("text", "lang").filter("text is not null and lang is not null")
    rows = kept.mapInArrow(run, "lang string, k long, n long").groupBy("lang", "k").agg(F.sum("n").alias("n")).toPandas()
    if rows.empty:
        return None
    languages = sorted(rows["lang"].unique())
    rates = np.zeros((len(languages), DIMENSIONS))
    for number, lang in enumerate(languages):
        own = rows[rows["lang"] == lang]
        rates[number, own["k"]] = own["n"]
    rates = (rates + smoothing) / (rates + smoothing).sum(axis=1, keepdims=True)
    code = codewords(len(languages))
    weights = np.zeros((DIMENSIONS, code.shape[1]))
    for bit in range(code.shape[1]):
        ones = code[:, bit] == 1
        if ones.any() and not ones.all():
            weights[:, bit] = np.log(rates[ones].mean(axis=0)) - np.log(rates[~ones].mean(axis=0))
    return Model(languages, code, weights, scale)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) and ambiguous of every row; only the text decides.

    A text that is NULL or has no letter (or a model without languages) is `und` with score 0. Repeated rows are judged
    one by one; other columns are not read. Texts are taken whole.
    """
    shared = Shared(docs.sparkSession, model)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        model, out = shared.value, []
        for text in texts(batch):
            known = model is not None and text and _LETTERS.search(text.decode())
            out.append(model.predict(ngrams(text)) if known else ("und", 0.0, False))
        lang, score, ambiguous = zip(*out) if out else ((), (), ())
        return {"doc_id": batch.column("doc_id"), "lang_pred": list(lang), "score": list(score), "ambiguous": list(ambiguous)}

    return map_slices(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")
