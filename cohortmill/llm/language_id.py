"""Language identification by mixtures: expectation-maximisation of each document's language proportions.

Letter trigrams of all training documents are counted by language in Spark. Buckets of trigrams with the same profile
over the languages (posterior log odds on a grid) are pooled into classes; a language is its distribution over classes. A
document is then a row of class counts. Its language set grows by the language with the steepest ascent of the likelihood,
expectation-maximisation fits the proportions, and a language stays only if the gain in log-likelihood exceeds a penalty
that grows with the logarithm of the document's length.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import carried, give_back_memory, named, restored, text_runs

BITS = 16
#: Documents scored at once.
ROWS = 512
#: Characters of a long text handled at once.
LONG = 2_000_000
MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


@functools.cache
def letter_table() -> np.ndarray:
    """Code point -> its lower-case letter, 0 for everything that is not a letter. Letters whose lower case is several code points stand for themselves."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every letter trigram of a column of texts (null: none), a long text in blocks.

    A trigram has a letter in its middle; runs of other characters, and the ends of a text, count as one space.
    """
    rows = [t or "" for t in texts.to_pylist()]
    joined = " ".join(rows)
    size = np.fromiter((len(t) + 1 for t in rows), np.int64, len(rows))
    step = LONG if len(rows) == 1 else max(1, len(joined))  # runs of several texts are short
    for lo in range(0, len(joined), step):
        part = f" {joined[:step]} " if not lo else joined[lo - 1 : lo + step] + " "
        if lo + step < len(joined):
            part = part[:-1] + joined[lo + step]
        points = letter_table()[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)]
        middle = np.flatnonzero(points[1:-1])
        owner = np.zeros(len(middle), np.int64) if len(rows) == 1 else np.repeat(np.arange(len(rows)), size)[middle]
        h = points[middle] * MULTIPLIERS[0] ^ points[middle + 1] * MULTIPLIERS[1] ^ points[middle + 2] * MULTIPLIERS[2]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        yield owner, (h >> np.uint32(32 - BITS)).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_runs(batches, "text"):
        for at in range(0, b.num_rows, ROWS):
            yield b.slice(at, ROWS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, c) of the batches, summed over as many runs as fit a table of eight languages."""
    total: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, c in total.items():
            used = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(c[used])], ["lang", "bucket", "c"])
        total.clear()

    for b in _runs(batches):
        langs = b.column("lang").dictionary_encode()
        names, code = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        for row, bucket in trigrams(b.column("text")):
            for k, lang in enumerate(names):
                if lang not in total and len(total) >= 8:
                    yield from flush()
                add = np.bincount(bucket[code[row] == k], minlength=1 << BITS)
                total[lang] = total[lang] + add if lang in total else add
    yield from flush()
    give_back_memory()


class LanguageModel:
    """Distributions of languages over classes of trigrams; ``lang`` names the rows of ``logs``."""

    def __init__(self, langs: list[str], counts: np.ndarray, *, most_classes: int = 2048, smoothing: float = 0.5):
        """``counts``: languages x buckets."""
        self.langs = langs
        if not langs:
            self.of_bucket, self.classes, self.p = np.zeros(counts.shape[1], np.int32), 1, np.zeros((0, 1))
            return
        p = (counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * counts.shape[1])
        odds = np.log(p) - np.log(p.sum(0))
        step = 0.5
        while True:  # a coarser grid until the classes are few enough
            grid = np.round(np.maximum(odds, -8) / step).astype(np.int16)
            _, self.of_bucket = np.unique(grid, axis=1, return_inverse=True)
            self.of_bucket = self.of_bucket.reshape(-1).astype(np.int32)
            self.classes = int(self.of_bucket.max()) + 1
            if self.classes <= most_classes:
                break
            step *= 1.5
        self.p = np.stack([np.bincount(self.of_bucket, x, self.classes) for x in p])

    def class_counts(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts) * self.classes)
        for row, bucket in trigrams(texts):
            out += np.bincount(row * self.classes + self.of_bucket[bucket], minlength=len(out))
        return out.reshape(len(texts), self.classes)

    def fit(self, counts: np.ndarray, *, penalty: float, steps: int = 60) -> np.ndarray:
        """Language proportions (rows x languages) of documents with class ``counts``; all zero for rows without trigrams."""
        n, size = len(counts), len(self.langs)
        out = np.zeros((n, size))
        total = counts.sum(1)
        live = np.flatnonzero(total > 0)
        if not len(live) or not size:
            return out
        single = counts[live] @ np.log(self.p).T
        best = single.argmax(1)
        out[live, best] = 1
        level = single[np.arange(len(live)), best]
        for _ in range(size - 1):
            c = counts[live]
            ascent = (c / (out[live] @ self.p)) @ self.p.T / total[live, None]
            ascent[out[live] > 0] = 0
            new = ascent.argmax(1)
            open_ = ascent[np.arange(len(live)), new] > 1  # otherwise no mixture with another language is likelier
            live, c, new, level = live[open_], c[open_], new[open_], level[open_]
            if not len(live):
                break
            pi = out[live]
            pi *= 0.9
            pi[np.arange(len(live)), new] = 0.1
            for _ in range(steps):
                after = pi * ((c / (pi @ self.p)) @ self.p.T) / total[live, None]
                moved = np.abs(after - pi).max()
                pi = after
                if moved < 1e-4:
                    break
            reached = (c * np.log(pi @ self.p)).sum(1)
            gain = reached - level > penalty * np.log(total[live] + 1)
            live, level = live[gain], reached[gain]
            out[live] = pi[gain]
            if not len(live):
                break
        return out

    def predict(self, texts: pa.Array, *, penalty: float) -> tuple[list[str], np.ndarray, list[str]]:
        """Most likely language (``und`` without a letter or a model), its share, and all languages of the set with their shares."""
        shares = self.fit(self.class_counts(texts), penalty=penalty) if self.langs else np.zeros((len(texts), 0))
        top = shares.argmax(1) if self.langs else np.zeros(len(texts), np.int64)
        score = shares.max(1, initial=0)
        names = [self.langs[t] if s > 0 else "und" for t, s in zip(top, score, strict=True)]
        sets = []
        for row in shares:
            held = [k for k in np.argsort(-row, kind="stable") if row[k] > 0]
            sets.append(" ".join(f"{self.langs[k]}:{row[k]:.4f}" for k in held))
        return names, np.minimum(score, 1.0), sets


def _score(batches: Iterator[pa.RecordBatch], shared, penalty: float) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for b in _runs(batches):
        names, score, sets = model.predict(b.column("text"), penalty=penalty)
        kept = [c for c in b.schema.names if c != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(names, pa.string()), pa.array(score), pa.array(sets, pa.string())], [*kept, "lang_pred", "score", "languages"])
    give_back_memory()


def fit_languages(training: DataFrame, *, text: str = "text", lang: str = "lang", **options) -> LanguageModel:
    """The model of all rows with a language; the driver gets one count per language and bucket that occurs (65,536 buckets)."""
    rows = training.select(named(text).alias("text"), named(lang).cast("string").alias("lang")).filter("lang is not null and text is not null")
    counted = rows.mapInArrow(_count, "lang string, bucket int, c long").groupBy("lang", "bucket").agg(F.sum("c").alias("c")).toArrow()
    found = counted.column("lang")
    langs = sorted(pc.unique(found).to_pylist())
    counts = np.zeros((len(langs), 1 << BITS))
    code = pc.index_in(found, pa.array(langs, pa.string())).to_numpy()
    counts[code, counted.column("bucket").to_numpy()] = counted.column("c").to_numpy()
    return LanguageModel(langs, counts, **options)


def identify_languages(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held_out_fold: int = 1, penalty: float = 4.0, keep: tuple[str, ...] = (), **options
) -> DataFrame:
    """Per row: id, ``keep`` columns, ``held_out``, ``lang_pred``, ``score`` (the share of that language, 0 to 1) and ``languages``.

    ``languages`` lists the chosen set with its shares. Rows whose crc32 of the id as text falls into the held-out fold
    never train; nor do null ids, null texts, texts without a letter and null languages. The language column is read for
    training alone. Null texts and texts without a letter are ``und`` with score 0, as is everything if nothing trains.
    Ties go to the first language in alphabetical order. Repeated rows train as often as they occur and get equal results;
    an empty table gives no rows. A kept column named like a result gives way to it.
    """
    fold = F.crc32(named(doc).cast("string").cast("binary")) % folds == held_out_fold
    model = fit_languages(docs.filter(~fold), text=text, lang=lang, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x classes, and 65,536 bucket numbers
    whole = (doc, *(c for c in keep if c != doc))
    rows = carried(docs, whole, text=named(text))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"), "lang_pred string, score double, languages string"])
    scored = rows.mapInArrow(lambda it: _score(it, shared, penalty), schema)
    held = F.coalesce(F.crc32(F.col("_keep0").cast("string").cast("binary")) % folds == held_out_fold, F.lit(False))
    return restored(scored.withColumn("held_out", held), whole, ("held_out", "lang_pred", "score", "languages"))
