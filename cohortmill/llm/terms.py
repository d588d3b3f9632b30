"""Hashed terms of texts, and their screening against labels: the features of the two trained text classifiers."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back_memory, materialize, named, text_runs, word_codes

#: Punctuation that is cut off both ends of a word.
EDGE = b".,;:!?\"'()[]{}#*$%&|<>-_=+/\\"
#: Lengths in bytes of the word beginnings that count as terms.
PREFIXES = (4, 5)


def term_buckets(word: bytes, bits: int) -> tuple[int, ...]:
    """Buckets of the bare word, of its first letters, and of the set of marks after it (or that it is)."""
    bare = word.strip(EDGE)
    mask = (1 << bits) - 1
    out = [xxhash.xxh64_intdigest(b"w" + bare) & mask] if bare else []
    out += [xxhash.xxh64_intdigest(b"p" + bare[:k]) & mask for k in PREFIXES if len(bare) > k]
    marks = word[len(word.rstrip(EDGE)) :] if bare else word
    if len(marks) > 1:
        out.append(xxhash.xxh64_intdigest(b"m" + bytes(sorted(set(marks)))) & mask)
    return tuple(out)


class TermCache(dict):
    """word -> tuple of feature numbers; with ``active``, only active buckets count and are numbered by it."""

    def __init__(self, bits: int, active: dict[int, int] | None = None, limit: int = 120_000):
        super().__init__()
        self.bits, self.active, self.limit = bits, active, limit
        self.beginnings: dict[bytes, int] = {}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= self.limit:
            self.clear()
        found = term_buckets(word, self.bits)
        if self.active is not None:
            found = tuple(self.active[b] for b in found if b in self.active)
        self[word] = found
        return found

    def _active_terms(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words and of the active features that they have, in any order: ``term_buckets`` for a whole list.

        Most words have none, so they are hashed in runs and looked up as arrays; beginnings recur and are remembered.
        """
        mask, hashed = (1 << self.bits) - 1, xxhash.xxh64_intdigest
        bare = [w.strip(EDGE) for w in words]
        keys = np.array(sorted(self.active), np.int64)
        numbers = np.array([self.active[int(k)] for k in keys], np.int64)
        buckets = np.fromiter((hashed(b"w" + x) & mask for x in bare), np.int64, len(bare))
        at = np.minimum(np.searchsorted(keys, buckets), max(len(keys) - 1, 0))
        hit = np.flatnonzero((keys[at] == buckets) & np.fromiter(map(len, bare), bool, len(bare))) if len(keys) else np.empty(0, np.int64)
        owners, found = [hit], [numbers[at[hit]]]
        if len(self.beginnings) >= self.limit:
            self.beginnings.clear()
        known = self.beginnings
        for k in PREFIXES:
            cut = [x[:k] if len(x) > k else b"" for x in bare]
            for x in set(cut).difference(known):
                known[x] = self.active.get(hashed(b"p" + x) & mask, -1) if x else -1
            of = np.fromiter(map(known.__getitem__, cut), np.int64, len(cut))
            owners.append(np.flatnonzero(of >= 0))
            found.append(of[owners[-1]])
        for i in [i for i, w in enumerate(words) if len(w) > 1 and not w[-2:].strip(EDGE)]:  # two marks at least at the end
            marks = words[i][len(words[i].rstrip(EDGE)) :]
            f = self.active.get(hashed(b"m" + bytes(sorted(set(marks)))) & mask)
            if f is not None:
                owners.append(np.array([i]))
                found.append(np.array([f]))
        return np.concatenate(owners), np.concatenate(found)

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """Number of words and the distinct features, sorted, of each text."""
        codes, words, n = word_codes(texts)
        if self.active is None:
            found = [self[w.encode()] for w in words]
            sizes = np.array([len(f) for f in found], np.int64)
            flat = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        else:
            word, flat = self._active_terms([w.encode() for w in words])
            sizes = np.bincount(word, minlength=len(words))
            flat = flat[np.argsort(word, kind="stable")]
        starts = np.cumsum(sizes) - sizes
        have = np.flatnonzero(sizes[codes] > 0) if len(codes) else np.empty(0, np.int64)
        c = codes[have]
        ends = np.cumsum(sizes[c])
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts[c] - (ends - sizes[c]), sizes[c])
        owner = np.repeat(np.repeat(np.arange(len(n)), n)[have], sizes[c])
        both = np.unique((owner << 32) | flat[take])
        cuts = np.searchsorted(both, np.arange(1, len(n)) << 32)
        return n, np.split(both & 0xFFFFFFFF, cuts) if len(n) else []


def _features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    cache = TermCache(bits)
    for b in text_runs(batches, "text"):
        found = [f.astype(np.int32) for f in cache.batch(b.column("text"))[1]]
        ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *found])))
        yield pa.RecordBatch.from_arrays([b.column("y"), b.column("place"), lists], ["y", "place", "terms"])
    cache.clear()
    give_back_memory()


def labelled_sample(docs: DataFrame, labels: DataFrame, *, doc: str, text: str, bits: int, max_rows: int) -> DataFrame:
    """Target ``y`` and term buckets ``terms`` of at most ``max_rows`` labelled documents, chosen by a hash of the id.

    ``labels``: one row per id with the target in ``y``. The sample's ids are broadcast, which ``max_rows`` bounds.
    """
    chosen = labels.select(named(doc).alias("_id"), "y").orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.select(named(doc).alias("_id"), named(text).alias("text")).join(F.broadcast(chosen), "_id")
    rows = rows.select(F.col("y").cast("long").alias("y"), F.xxhash64("_id").alias("place"), "text")
    made = rows.mapInArrow(lambda it: _features(it, bits), "y long, place long, terms array<int>")
    return materialize(made.orderBy("place", "terms", "y").limit(max_rows), "labelled-terms")  # an id may have many rows


def _with_terms(sample: DataFrame, classes: int) -> tuple[list[float], DataFrame]:
    """Rows of each class, and for each term the rows of each class that hold it (``n0``, ``n1``, ...)."""
    of = [f"sum(CAST(y = {c} AS BIGINT))" for c in range(classes)]
    total = [float(x or 0) for x in sample.selectExpr(*of).first()]
    return total, sample.selectExpr("y", "explode(terms) AS term").groupBy("term").agg(*[F.expr(f"{x} AS n{c}") for c, x in enumerate(of)])


def _ratio(seen: list[str], total: list[str]) -> str:
    """SQL of the log-likelihood ratio of class against presence: rows seen with the term, and all rows, of each class."""
    present, rows = f"({' + '.join(seen)})", f"({' + '.join(total)})"
    cells = [x for s, t in zip(seen, total, strict=True) for x in ((s, f"{t} * {present} / {rows}"), (f"({t} - {s})", f"{t} * ({rows} - {present}) / {rows}"))]
    return " + ".join(f"CASE WHEN {seen} > 0 AND {expect} > 0 THEN 2D * {seen} * ln({seen} / ({expect})) ELSE 0D END" for seen, expect in cells)


def associated(sample: DataFrame, *, classes: int, most: int) -> list[int]:
    """The terms whose presence depends on the class: at most ``most`` by log-likelihood ratio, each at least ``2 ln(rows + 2)``.

    Counts are a shuffle of the sample; the driver gets the chosen terms.
    """
    total, counts = _with_terms(sample, classes)
    rows = sum(total)
    ratio = _ratio([f"n{c}" for c in range(classes)], [f"{t!r}D" for t in total])
    ranked = counts.selectExpr("term", f"round({ratio}, 6) AS g").filter(F.col("g") >= 2 * float(np.log(rows + 2)))
    return [r["term"] for r in ranked.orderBy(F.desc("g"), "term").limit(most).collect()]


def _pairs(batches: Iterator[pa.RecordBatch], first: dict[int, int], second: dict[int, int]) -> Iterator[pa.RecordBatch]:
    """Rows, and rows of class 1, that hold a term of ``first`` and a term of ``second``, where there are any."""
    count = np.zeros((2, len(first), len(second)), np.float32)  # whole numbers below 2 ** 24
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            terms, y = (b.column(c)[at : at + 1000].to_pylist() for c in ("terms", "y"))
            x, z = (matrix([np.array([of[t] for t in row if t in of], np.int64) for row in terms], len(of)) for of in (first, second))
            count[0] += x.T @ z
            count[1] += (x * np.array(y, np.float32)[:, None]).T @ z
    s, f = np.nonzero(count[0])
    keys = [np.array(list(of), np.int64) for of in (first, second)]
    found = [keys[0][s], keys[1][f], *(c[s, f].astype(np.int64) for c in count)]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["lead", "term", "n", "n1"])


def interacting(sample: DataFrame, leads: list[int], *, most: int, frequent: int = 1000) -> list[int]:
    """Terms on which the class depends only beside another term: among rows that hold one of ``leads``.

    Looks at the ``frequent`` commonest terms outside ``leads``, common or not in both classes alike. A pair's
    log-likelihood ratio within the rows of its lead must reach ``2 ln(pairs + 2)``; at most ``most`` terms by their best
    pair. Two classes. Tasks hold a count per pair, so their memory is bounded by the two lists.
    """
    _, counts = _with_terms(sample, 2)
    leads = sorted(leads)
    others = counts.filter(~F.col("term").isin(leads)) if leads else counts.limit(0)
    common = [r["term"] for r in others.orderBy(F.desc(F.expr("n0 + n1")), "term").limit(frequent).collect()]
    if not common:
        return []
    first, second = ({t: k for k, t in enumerate(sorted(x))} for x in (leads, common))
    pairs = sample.mapInArrow(lambda it: _pairs(it, first, second), "lead long, term long, n long, n1 long").groupBy("lead", "term").agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
    of_lead = counts.filter(F.col("term").isin(leads)).selectExpr("term AS lead", "CAST(n0 AS DOUBLE) AS t0", "CAST(n1 AS DOUBLE) AS t1")
    rated = pairs.join(of_lead, "lead").selectExpr("term", f"round({_ratio(['(n - n1)', 'n1'], ['t0', 't1'])}, 6) AS g")
    best = rated.groupBy("term").agg(F.max("g").alias("g")).filter(F.col("g") >= 2 * float(np.log(len(first) * len(second) + 2)))
    return [r["term"] for r in best.orderBy(F.desc("g"), "term").limit(most).collect()]


def features(sample: DataFrame, terms: list[int]) -> tuple[dict[int, int], np.ndarray, list[np.ndarray]]:
    """The terms numbered 0, 1, ... in ascending order; targets; and each row's features."""
    active = {b: k for k, b in enumerate(sorted(terms))}
    keys = F.lit(sorted(terms)).cast("array<int>") if terms else F.array().cast("array<int>")
    inside = sample.select("y", "place", F.sort_array(F.array_intersect("terms", keys)).alias("terms"))
    got = inside.toPandas()
    got["terms"] = [tuple(t) for t in got["terms"]]
    got = got.sort_values(["place", "y", "terms"])  # an order that does not depend on partitioning
    return active, got["y"].to_numpy(np.int64), [np.array([active[t] for t in row], np.int64) for row in got["terms"]]


def screen(sample: DataFrame, *, classes: int, most: int) -> tuple[dict[int, int], np.ndarray, list[np.ndarray]]:
    """``features`` of the ``associated`` terms."""
    return features(sample, associated(sample, classes=classes, most=most))


def matrix(rows: list[np.ndarray], size: int) -> np.ndarray:
    x = np.zeros((len(rows), size), np.float32)
    for k, r in enumerate(rows):
        x[k, r] = 1
    return x
