"""Toxicity by a factorization machine over hashed terms.

Labels are learned from a bounded, documented sample of labelled documents; hashed words, word beginnings and marks are
screened by their association with the label, and a factorization machine over the remaining terms adds to linear
weights the pairwise interactions of terms (an insult beside a group mention), as inner products of latent factors.
Terms as common in both classes, on which the label depends only beside another term, take part in interactions alone.
Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, give_back_memory, named, restored, text_runs
from .terms import TermCache, associated, features, interacting, labelled_sample, matrix


class FactorizationMachine:
    """Binary factorization machine on 0/1 features: sigmoid(w0 + x.w + sum over pairs of <v_i, v_j> x_i x_j).

    ``linear`` (0 or 1 a feature) tells which have a weight of their own; the others only interact.
    """

    def __init__(self, size: int, factors: int = 8, seed: int = 7, linear: np.ndarray | None = None):
        rng = np.random.default_rng(seed)
        self.linear = np.ones(size) if linear is None else linear
        self.w0, self.w = -2.0, np.zeros(size)
        self.v = rng.normal(0, 0.02, (size, factors))

    def raw(self, x: np.ndarray) -> np.ndarray:
        xv = x @ self.v
        return self.w0 + x @ self.w + 0.5 * ((xv**2).sum(1) - x @ (self.v**2).sum(1))

    def fit(self, rows: list[np.ndarray], y: np.ndarray, *, epochs: int = 12, batch: int = 256, rate: float = 0.05, decay: float = 2e-4, seed: int = 7) -> None:
        rng, t = np.random.default_rng(seed), 0
        state = [np.zeros_like(p) for p in (self.w, self.w, self.v, self.v)]
        bias = [0.0, 0.0]
        for _ in range(epochs if len(self.w) else 0):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                k = order[at : at + batch]
                x, t = matrix([rows[i] for i in k], len(self.w)).astype(float), t + 1
                xv = x @ self.v
                g = (1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30))) - y[k]) / len(k)
                grads = ((x.T @ g) * self.linear + decay * self.w, x.T @ (g[:, None] * xv) - (x.T @ g)[:, None] * self.v + decay * self.v)
                for p, d, m, s in zip((self.w, self.v), grads, state[::2], state[1::2], strict=True):  # Adam
                    m += 0.1 * (d - m)
                    s += 0.01 * (d * d - s)
                    p -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
                bias[0] += 0.1 * (g.sum() - bias[0])
                bias[1] += 0.01 * (g.sum() ** 2 - bias[1])
                self.w0 -= rate * (bias[0] / (1 - 0.9**t)) / (np.sqrt(bias[1] / (1 - 0.99**t)) + 1e-8)


def score_terms(features: np.ndarray, w0: float, w: np.ndarray, v: np.ndarray) -> float:
    """The machine's probability for one document's active terms."""
    u = v[features]
    z = w0 + w[features].sum() + 0.5 * ((u.sum(0) ** 2).sum() - (u**2).sum())
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _score(batches: Iterator[pa.RecordBatch], bits: int, shared) -> Iterator[pa.RecordBatch]:
    w0, w, v, active = shared.value
    cache = TermCache(bits, active)
    for b in text_runs(batches, "_text"):
        scores = [score_terms(f, w0, w, v) for f in cache.batch(b.column("_text"))[1]]
        rest = [c for c in b.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(scores, pa.float64())], [*rest, "score"])
    cache.clear()
    give_back_memory()


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", label: str = "toxic", bits: int = 22, max_rows: int = 12_000, most_terms: int = 1500, most_interacting: int = 300, factors: int = 8) -> tuple[FactorizationMachine, dict[int, int]]:
    """The fitted machine and its active terms, from at most ``max_rows`` labelled documents chosen by a hash of the id.

    An id labelled several times is toxic if any of its labels is; null labels and ids are left out. Without any label
    the machine is a constant below 0.5.
    """
    marked = labels.select(named(label).cast("long").alias("y"), named(doc)).dropna().groupBy(named(doc)).agg(F.max("y").alias("y"))
    sample = labelled_sample(docs, marked, doc=doc, text=text, bits=bits, max_rows=max_rows)
    alone = associated(sample, classes=2, most=most_terms)
    active, y, rows = features(sample, alone + interacting(sample, alone, most=most_interacting))
    model = FactorizationMachine(len(active), factors, linear=np.isin(sorted(active), alone).astype(float))
    model.fit(rows, y.astype(float))
    return model, active


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", label: str = "toxic", bits: int = 22, keep: tuple[str, ...] = (), threshold: float = 0.3, folds: int = 4, held_out_fold: int = 2, **fit) -> DataFrame:
    """Per row: id, ``keep`` columns, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Rows whose crc32 of the id as text falls into the held-out fold never train; a null id is not held out and does not
    train. Whole texts are scored; null and empty texts have no terms and get the model's base score. Repeated rows get
    equal scores; an empty table gives no rows. A kept column named like a result gives way to the result.
    """
    fold = lambda c: F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds == held_out_fold, F.lit(False))
    model, active = fit_toxicity(docs, labels.filter(~fold(named(doc))), doc=doc, text=text, label=label, bits=bits, **fit)
    shared = docs.sparkSession.sparkContext.broadcast((float(model.w0), model.w, model.v, active))  # at most most_terms + most_interacting rows
    whole = (doc, *(c for c in keep if c != doc))
    rows = carried(docs, whole, _text=named(text))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text"), "score double"])
    scored = rows.mapInArrow(lambda it: _score(it, bits, shared), schema)
    scored = scored.withColumn("held_out", fold(F.col("_keep0"))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    return restored(scored, whole, ("held_out", "score", "predicted"))
