"""Mixing sources to target weights by soft domain membership.

A classifier trained on the labelled table gives every document posteriors over domains (``clean``, ``low`` quality,
``toxic``). Nonnegative document rates r then solve a least-squares problem: the expected tokens of each domain,
``sum_i r_i n_i p_id``, shall match the targets T_d. Projected gradient runs distributed over the documents' posteriors
and tokens (about 32 bytes a document, cached): an iteration is one narrow job that returns three sums from each task.
With weights 1 / g_d (g_d: tokens of the domain at rate 1) and the metric n_i, the gradient's Lipschitz constant is at
most 1, so the step is 1: ``r <- max(0, y - sum_d p_d res_d(y) / g_d)``,
with ``y`` the rate moved on by its last step (Nesterov's momentum). A rate is a function of the posterior and the residuals
so far, hence no per-document state is kept between iterations.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, give_back_memory, materialize, named, restored, text_runs
from .terms import TermCache, labelled_sample, matrix, screen

DOMAINS = ("clean", "low", "toxic")


def fit_softmax(rows: list[np.ndarray], y: np.ndarray, size: int, classes: int, *, epochs: int = 10, batch: int = 256, rate: float = 0.05, decay: float = 3e-4, seed: int = 11) -> np.ndarray:
    """Weights (features + 1, classes) of a multinomial logistic regression on 0/1 features; the last row is the bias."""
    rng = np.random.default_rng(seed)
    w = np.zeros((size + 1, classes))
    w[-1] = np.log(np.bincount(y, minlength=classes) + 0.5)
    m, s, t = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            k, t = order[at : at + batch], t + 1
            x = np.hstack([matrix([rows[i] for i in k], size), np.ones((len(k), 1), np.float32)]).astype(float)
            g = _softmax(x @ w)
            g[np.arange(len(k)), y[k]] -= 1
            d = x.T @ g / len(k) + decay * w
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    return w


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _posteriors(batches: Iterator[pa.RecordBatch], bits: int, shared) -> Iterator[pa.RecordBatch]:
    w, active = shared.value
    cache = TermCache(bits, active)
    for b in text_runs(batches, "_text"):
        n, found = cache.batch(b.column("_text"))
        z = np.array([w[-1] + w[f].sum(0) for f in found]).reshape(b.num_rows, w.shape[1])
        p = pa.array(_softmax(z).ravel()) if b.num_rows else pa.array([], pa.float64())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * w.shape[1]), p)
        rest = [c for c in b.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(n.astype(np.int64)), lists], [*rest, "n_tokens", "posteriors"])
    cache.clear()
    give_back_memory()


def fit_domains(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text", bits: int = 22, max_rows: int = 8_000, most_terms: int = 1500) -> tuple[np.ndarray, dict[int, int]]:
    """Softmax weights and active terms from at most ``max_rows`` labelled documents, chosen by a hash of the id."""
    y = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).otherwise(0)
    marked = labels.select(named(doc), "quality", "toxic").dropna().groupBy(named(doc)).agg(F.max(y).alias("y"))
    active, y, rows = screen(labelled_sample(docs, marked, doc=doc, text=text, bits=bits, max_rows=max_rows), classes=len(DOMAINS), most=most_terms)
    return fit_softmax(rows, y, len(active), len(DOMAINS)), active


def domain_posteriors(docs: DataFrame, model: tuple[np.ndarray, dict[int, int]], *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), bits: int = 22) -> DataFrame:
    """``_keep0``, ... (the kept columns), ``n_tokens`` (words of the whole text; 0 if null) and ``posteriors`` over ``DOMAINS``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = carried(docs, keep, _text=named(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    return rows.mapInArrow(lambda it: _posteriors(it, bits, shared), f"{fields}, n_tokens long, posteriors array<double>")


def rate(steps: list[list[float]], most: float | None) -> Column:
    """Document rates after the given steps (scaled residuals, then the momentum), from rate 1: one expression for any number."""
    if not steps:
        return F.lit(1.0)
    down = " + ".join(f"posteriors[{d}] * s[{d}]" for d in range(len(DOMAINS)))
    listed = ", ".join("array(" + ", ".join(f"{float(x)!r}D" for x in s) + ")" for s in steps)
    moved = f"greatest(a[0] + s[{len(DOMAINS)}] * (a[0] - a[1]) - ({down}), 0D)"
    if most is not None:
        moved = f"least({moved}, {float(most)!r}D)"
    return F.expr(f"aggregate(array({listed}), array(1D, 1D), (a, s) -> array({moved}, a[0]), a -> a[0])")


def _totals(batches: Iterator[pa.RecordBatch], steps: list[list[float]], most: float | None) -> Iterator[pa.RecordBatch]:
    """Expected tokens of each domain at the rates after ``steps``: ``rate`` over whole columns."""
    total = np.zeros(len(DOMAINS))
    for b in batches:
        p = b.column("posteriors").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(DOMAINS))
        r = last = np.ones(len(p))
        for *s, momentum in steps:
            r, last = np.clip(r + momentum * (r - last) - p @ s, 0, most), r
        total += (r * b.column("n_tokens").to_numpy()) @ p
    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total], list(DOMAINS))


def fit_rates(table: DataFrame, targets: dict[str, float], *, total: float | None = None, most: float | None = None, tolerance: float = 1e-4) -> tuple[list[list[float]], dict[str, float]]:
    """Accelerated projected-gradient steps that lead from rate 1 to the targets, and the expected tokens that they reach.

    ``total`` expected tokens, all present ones if None. Domains without tokens are left out and the weights of the
    others count in proportion. With ``most`` the rates stay at or below it, as well as nonnegative. Iterates until the
    targets are met to ``tolerance`` or, where no rates meet them, until a step no longer moves the totals: the
    least-squares optimum, which the returned totals show.
    """

    # two narrow columns, cached while the steps run; a lost part is read anew from the table
    rows = table.select("posteriors", "n_tokens").persist()

    def sums(steps: list) -> np.ndarray:
        got = rows.mapInArrow(lambda it: _totals(it, steps, most), ", ".join(f"{d} double" for d in DOMAINS)).collect()  # a row a task
        return np.array([math.fsum(r[d] for r in got) for d in DOMAINS])

    g = sums([])
    weight = np.array([targets.get(d, 0.0) for d in DOMAINS]) * (g > 0)
    now, steps = g, []
    if weight.sum():
        aim = weight / weight.sum() * (g.sum() if total is None else total)
        scaled = lambda x: np.divide(x - aim, g, out=np.zeros_like(g), where=g > 0)
        before, moved, t = now, np.inf, 1.0
        while np.abs(now - aim).max() > tolerance * aim.max() and moved > 0.01 * tolerance * aim.max():
            after = (1 + (1 + 4 * t * t) ** 0.5) / 2
            momentum = (t - 1) / after
            steps.append([*map(float, scaled(now + momentum * (now - before))), momentum])
            before, now = now, sums(steps)
            moved = np.abs(now - before).max()
            worse = (scaled(now) * (now - aim)).sum() > (scaled(before) * (before - aim)).sum()
            t = 1.0 if worse else after  # momentum that overshoots starts anew
    rows.unpersist()
    return steps, dict(zip(DOMAINS, map(float, now), strict=True))


def copies(doc: str = "_keep0", seed: int = 42) -> Column:
    """Whole copies for a rate: its integer part, and one more with the fraction's probability, by a hash of the id."""
    u = F.pmod(F.xxhash64(F.col(doc), F.lit(seed)), F.lit(1 << 30)) / (1 << 30)
    return (F.floor("rate") + F.when(u < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long")


def mix_sources(docs: DataFrame, labels: DataFrame, targets: dict[str, float], *, doc: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), total: float | None = None, most: float | None = None, **fit) -> DataFrame:
    """Per row: id, ``keep`` columns, ``n_tokens``, ``posteriors``, ``rate`` and ``copies`` to sample.

    Null and empty texts have no tokens and the prior's posteriors. Without labelled rows all documents share one
    posterior. Rows that share an id get the same random draw; an empty table gives no rows. A kept column named like a
    result gives way to the result.
    """
    model = fit_domains(docs, labels, doc=doc, text=text, **fit)
    whole = (doc, *(c for c in keep if c != doc))
    table = materialize(domain_posteriors(docs, model, text=text, keep=whole), "mix-posteriors")
    steps, _ = fit_rates(table, targets, total=total, most=most)
    rated = table.withColumn("rate", rate(steps, most)).withColumn("copies", copies())
    return restored(rated, whole, ("n_tokens", "posteriors", "rate", "copies"))


def downsample_to_targets(docs: DataFrame, labels: DataFrame, targets: dict[str, float], *, anchor: str = "clean", doc: str = "doc_id", text: str = "text", **fit) -> DataFrame:
    """The rows of ``docs`` that a mix with rates of at most 1 keeps, all columns unchanged.

    The ``anchor`` domain keeps its tokens and the others shrink to their share relative to it; a domain that is short
    already stays as it is, since nothing is repeated. The rows are written once with their posteriors, so every text is
    classified once and none is shuffled.
    """
    model = fit_domains(docs, labels, doc=doc, text=text, **fit)
    whole = (doc, *(c for c in docs.columns if c != doc))
    table = materialize(domain_posteriors(docs, model, text=text, keep=whole), "mix-posteriors")
    mass = table.agg(*[F.expr(f"sum(n_tokens * posteriors[{k}])") for k in range(len(DOMAINS))])
    g = [x or 0.0 for x in mass.first()]
    a = DOMAINS.index(anchor)
    want = {d: min(g[k], g[a] * targets.get(d, 0.0) / targets[anchor]) for k, d in enumerate(DOMAINS)}
    steps, _ = fit_rates(table, want, total=sum(want.values()), most=1.0)
    kept = table.withColumn("rate", rate(steps, 1.0)).filter(copies() > 0)
    return restored(kept, whole, ()).select(*map(named, docs.columns))
