"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation, beside exact unigram counts.

Counts: every training text is counted in full; counts are summed per word hash in a shuffle that grows with the corpus.
Model: the most frequent words are symbols of their own, all others fall into classes by their ending, which carries
much of a word's kind and language. A context of two symbols predicts a vector, ``q = R[c1] C1 + R[c2] C2``, and a
symbol's logit is ``q . Q[w] + b[w]``. The training texts, as symbols, are dealt into shards of about ``shard_tokens`` by
a hash of id and text, so their number grows with the corpus and their content does not depend on partitioning. In each
round every shard trains from the common parameters with noise-contrastive estimation against the unigram distribution,
and the results are averaged by tokens. Scores use the true normaliser: it depends on the context alone, so batched
matrix products tabulate it once for all contexts. A word of a class gets the class's probability times its smoothed
share of the class, from the counts of all words, so the distribution sums to one over all words and one unknown word of
each class.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back_memory, materialize, named, text_runs, word_codes, word_hashes

#: Hash that stands for the end of a text: that of a space, which no word holds.
END = xxhash.xxh64_intdigest(b" ")
#: Classes of words that are no symbols of their own.
CLASSES = 256
#: Models that one task of the merging tree adds up, and that the driver may get.
FAN_IN = 64


def endings(words: list[str]) -> np.ndarray:
    """Class of each word: a hash of its last two bytes."""
    return np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")[-2:]) % CLASSES for w in words), np.int32, len(words))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in text_runs(batches, "text"):
        codes, words, n = word_codes(b.column("text"))
        h = np.append(word_hashes(words), np.uint64(END)).view(np.int64)
        c = np.append(np.bincount(codes, minlength=len(words)), len(n))
        k = endings([*words, " "])
        yield pa.RecordBatch.from_arrays([pa.array(h[c > 0]), pa.array(k[c > 0]), pa.array(c[c > 0].astype(np.int64))], ["h", "k", "c"])
    give_back_memory()


class Lexicon:
    """Looks words up in the head table (sorted hashes, counts, symbols; -1: none of its own, the class counts)."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, ids: np.ndarray, words: int):
        self.head, self.logs, self.ids, self.words = head, np.log10(counts + 0.5), ids, words

    def look(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all tokens, ends included: symbol, log10(c + 0.5) (NaN if not in the head), hash; and tokens per text."""
        codes, words, n = word_codes(texts)
        h = np.append(word_hashes(words), np.uint64(END))
        vid, log = np.full(len(h), -1, np.int64), np.full(len(h), np.nan)
        if len(self.head):
            at = np.minimum(np.searchsorted(self.head, h), len(self.head) - 1)
            known = self.head[at] == h
            vid, log = np.where(known, self.ids[at], -1), np.where(known, self.logs[at], np.nan)
        rare = np.flatnonzero(vid < 0)
        names = [*words, " "]
        vid[rare] = self.words + endings([names[i] for i in rare.tolist()])
        place = np.insert(codes.astype(np.int64), np.cumsum(n), len(h) - 1)  # an end after each text
        return vid[place], log[place], h[place], n + 1


def contexts(ids: np.ndarray, n: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two words before each token; ``start`` stands for what is before a text."""
    one, two = np.roll(ids, 1), np.roll(ids, 2)
    first = np.cumsum(n) - n
    one[first] = start
    two[first] = start
    two[(first + 1)[n > 1]] = start
    return one, two


class LogBilinear:
    """Symbols 0..size-1, words and then classes; contexts also know ``size``, the start."""

    def __init__(self, unigram: np.ndarray, width: int = 16, seed: int = 5):
        size = len(unigram)
        rng = np.random.default_rng(seed)
        self.r = rng.normal(0, 0.1, (size + 1, width)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.c1 = np.eye(width, dtype=np.float32)
        self.c2 = 0.5 * np.eye(width, dtype=np.float32)
        self.b = np.log(unigram).astype(np.float32)
        self.noise = unigram

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.r, self.q, self.c1, self.c2, self.b]

    def pack(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parameters])

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for p in self.parameters:
            p[...] = flat[at : at + p.size].reshape(p.shape)
            at += p.size

    def start_training(self, rate: float = 0.15, noise: int = 48, seed: int = 5) -> None:
        self.rate, self.k, self.rng = rate, noise, np.random.default_rng(seed)
        self.grad2 = [np.full_like(p, 1e-2) for p in self.parameters]
        self.log_noise = np.log(noise * self.noise).astype(np.float32)
        self.cumulative = np.cumsum(self.noise)

    def step(self, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
        """One Adagrad step of noise-contrastive estimation; the noise words are shared by the batch."""
        noise = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.k) * self.cumulative[-1]), len(self.b) - 1)
        ra, rb, qw, qn = self.r[a], self.r[b], self.q[w], self.q[noise]
        v = ra @ self.c1 + rb @ self.c2
        pos = 1 / (1 + np.exp(-np.clip((v * qw).sum(1) + self.b[w] - self.log_noise[w], -20, 20))) - 1
        neg = 1 / (1 + np.exp(-np.clip(v @ qn.T + self.b[noise] - self.log_noise[noise], -20, 20)))
        scale = np.float32(1 / len(w))
        pos, neg = pos * scale, neg * scale
        dv = pos[:, None] * qw + neg @ qn
        gq, gr, gb = np.zeros_like(self.q), np.zeros_like(self.r), np.bincount(w, pos, len(self.b))
        da, db, dw = dv @ self.c1.T, dv @ self.c2.T, pos[:, None] * v
        for d in range(self.q.shape[1]):
            gq[:, d] = np.bincount(w, dw[:, d], len(self.b))
            gr[:, d] = np.bincount(a, da[:, d], len(self.r)) + np.bincount(b, db[:, d], len(self.r))
        np.add.at(gq, noise, neg.T @ v)
        np.add.at(gb, noise, neg.sum(0))
        for p, g, s in zip(self.parameters, [gr, gq, ra.T @ dv, rb.T @ dv, gb], self.grad2, strict=True):
            g = g.astype(np.float32) * np.float32(len(w) ** 0.5)
            s += g * g
            p -= self.rate * g / np.sqrt(s)

    def normalisers(self, batch: int = 4096) -> np.ndarray:
        """log of the sum of exponentials for every context, (size + 1, size + 1) in (one before, two before)."""
        x, y = self.r @ self.c1, self.r @ self.c2
        n = len(x)
        out = np.empty(n * n, np.float32)
        for at in range(0, n * n, batch):
            i = np.arange(at, min(at + batch, n * n))
            z = (x[i // n] + y[i % n]) @ self.q.T + self.b
            top = z.max(1)
            out[i] = top + np.log(np.exp(z - top[:, None]).sum(1))
        return out.reshape(n, n)


def _symbols(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Texts as symbols, with their place."""
    head, counts, ids, words = shared.value
    lexicon = Lexicon(head, counts, ids, words)
    for b in text_runs(batches, "text"):
        w, _, _, n = lexicon.look(b.column("text"))
        blobs = [x.tobytes() for x in np.split(w.astype("<i2"), np.cumsum(n)[:-1])]
        yield pa.RecordBatch.from_arrays([b.column("place"), pa.array(blobs, pa.binary())], ["place", "w"])
    give_back_memory()


def _train(shard: pd.DataFrame, shared, batch: int = 4096) -> pd.DataFrame:
    """Parameters after a pass over a shard from the common start, times its tokens."""
    unigram, start, turn = shared.value
    model = LogBilinear(unigram)
    if start is not None:
        model.unpack(start)
    number = int(shard["shard"].iloc[0])
    texts = [w for _, w in sorted(zip(shard["place"], shard["w"], strict=True))]
    w = np.frombuffer(b"".join(texts), "<i2").astype(np.int64)
    one, two = contexts(w, np.array([len(t) // 2 for t in texts]), len(unigram))
    model.start_training(rate=0.15 / (1 + turn), seed=2 * number + turn)
    order = np.random.default_rng(number).permutation(len(w))
    for k in range(0, len(w), batch):
        i = order[k : k + batch]
        model.step(w[i], one[i], two[i])
    return pd.DataFrame({"shard": [number], "seen": [len(w)], "blob": [(model.pack().astype("<f8") * len(w)).tobytes()]})


def _trainer(shared) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda shard: _train(shard, shared)


def _merge(models: pd.DataFrame) -> pd.DataFrame:
    """The sum of at most ``FAN_IN`` models, in the order of their shards, as the model of their parent."""
    models = models.sort_values("shard")
    total = sum(np.frombuffer(b, "<f8") for b in models["blob"])
    return pd.DataFrame({"shard": [int(models["shard"].iloc[0]) // FAN_IN], "seen": [int(models["seen"].sum())], "blob": [total.tobytes()]})


def _merged(trained: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Sum of the models of ``n`` shards and of what they have seen: a tree of tasks, until at most ``FAN_IN`` models are left for the driver."""
    while n > FAN_IN:
        parents = trained.groupBy(F.floor(F.col("shard") / FAN_IN).alias("parent")).applyInPandas(_merge, "shard int, seen long, blob binary")
        trained, n = materialize(parents, "lm-merged"), -(-n // FAN_IN)
    rows = sorted(trained.collect(), key=lambda r: r["shard"])
    return sum(np.frombuffer(r["blob"], "<f8") for r in rows), sum(r["seen"] for r in rows)


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    head, counts, ids, words, x, y, q, bias, norm, space = (np.asarray(v) for v in shared.value)
    words, start = int(words), len(q)
    lexicon = Lexicon(head, counts, ids, words)
    row_id = TaskContext.get().partitionId() << 40
    for b in text_runs(batches, "text"):
        w, log, h, n = lexicon.look(b.column("text"))
        one, two = contexts(w, n, start)
        p = np.empty(len(w))
        for k in range(0, len(w), 65536):
            s = slice(k, k + 65536)
            p[s] = ((x[one[s]] + y[two[s]]) * q[w[s]]).sum(1) + bias[w[s]] - norm[one[s], two[s]]
        first = np.cumsum(n) - n
        total = lambda v: np.add.reduceat(v, first)  # noqa: E731  every text has its end token
        tail, other = np.isnan(log), w >= words
        log = np.where(tail, 0, log)
        share = np.where(other, log - space[np.maximum(w - words, 0)], 0)  # of its class; the tail's counts come later
        tails = h[tail].view(np.int64)
        offsets = np.concatenate([[0], np.cumsum(total(tail.astype(np.int64)))])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(row_id, row_id + len(n)), pa.int64()), b.column("id"), b.column("held_out"), pa.array(n.astype(np.int64)),
                pa.array(total((~tail).astype(np.int64))), pa.array(total(log)), pa.array(total(p) / np.log(10) + total(share)),
                pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(tails)),
            ],
            ["row", "id", "held_out", "n_tokens", "known", "log_all", "log_model", "tail"],
        )
        row_id += len(n)
    give_back_memory()


def lm_scores(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", folds: int = 5, held_out_fold: int = 1, vocabulary: int = 600, head_limit: int = 400_000, shard_tokens: int = 1_000_000, rounds: int = 2
) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10).

    The id may be of any type. Null and empty texts are the end token alone. A null id trains. With no training text every
    count is zero, no word is a symbol and both scores are those of unknown words; an empty table gives no rows. Repeated
    rows train as often as they occur and get equal scores; other columns are not read. The counts of at most
    ``head_limit`` most frequent words travel to the tasks; those of all others meet their occurrences in a shuffled join.
    """
    spark = docs.sparkSession
    fold = F.coalesce(F.crc32(named(doc).cast("string").cast("binary")) % folds == held_out_fold, F.lit(False))
    rows = docs.select(named(doc).alias("id"), fold.alias("held_out"), named(text).alias("text"))
    training = rows.filter(~F.col("held_out")).select(F.xxhash64("id", "text").alias("place"), "text")
    counts = training.select("text").mapInArrow(_count, "h long, k int, c long").groupBy("h").agg(F.max("k").alias("k"), F.sum("c").alias("c"))
    counts = materialize(counts, "lm-counts")
    n_total, n_types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    level, held = None, 0
    for r in counts.groupBy(F.floor(F.log2("c") * 4).alias("level")).count().orderBy(F.desc("level")).collect():  # under 300 rows
        held += r["count"]
        if held > head_limit:
            break
        level = r["level"]
    in_head = F.floor(F.log2("c") * 4) >= (level if level is not None else 1 << 30)
    top = counts.filter(in_head).toArrow()  # at most head_limit rows
    h, c, kinds = (top[x].to_numpy() for x in ("h", "c", "k"))
    order = np.lexsort((h, -c))[:vocabulary]
    words = len(order)
    ids = np.full(len(h), -1, np.int32)
    ids[order] = np.arange(words)
    inside, inside_kinds = c[order], kinds[order]
    sort = np.argsort(h.view(np.uint64))
    head, c, ids = h.view(np.uint64)[sort], c[sort], ids[sort]
    mass, types = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in counts.groupBy("k").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():  # a row per class
        mass[r["k"]], types[r["k"]] = r["c"], r["n"]
    mass -= np.bincount(inside_kinds, inside, CLASSES)
    types -= np.bincount(inside_kinds, minlength=CLASSES)
    unigram = np.concatenate([inside, np.maximum(mass, 0)]) + 0.5
    unigram = unigram / unigram.sum()

    model = LogBilinear(unigram)
    if n_total:
        shared = spark.sparkContext.broadcast((head, c, ids, words))
        n_shards = max(1, -(-n_total // shard_tokens))
        symbols = training.mapInArrow(lambda it: _symbols(it, shared), "place long, w binary")
        symbols = materialize(symbols.withColumn("shard", F.pmod("place", F.lit(n_shards)).cast("int")), "lm-symbols")
        shared.destroy()
        start = None
        for turn in range(rounds):
            common = spark.sparkContext.broadcast((unigram, start, turn))
            trained = symbols.groupBy("shard").applyInPandas(_trainer(common), "shard int, seen long, blob binary")
            total, seen = _merged(trained, n_shards)
            start = total / seen
            common.destroy()
        model.unpack(start)
    space = np.log10(mass + 0.5 * (types + 1))
    shared = spark.sparkContext.broadcast((head, c, ids, words, model.r @ model.c1, model.r @ model.c2, model.q, model.b, model.normalisers(), space))
    kind = docs.schema[doc].dataType.simpleString()
    schema = f"row long, id {kind}, held_out boolean, n_tokens long, known long, log_all double, log_model double, tail array<long>"
    scored = materialize(rows.mapInArrow(lambda it: _score(it, shared), schema), "lm-scored")
    shared.destroy()
    rest = counts.filter(~in_head)
    met = scored.select("row", F.explode("tail").alias("h")).join(rest, "h", "left")
    late = met.groupBy("row").agg(F.count("c").alias("late_known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("late_log"))
    both = scored.drop("tail").join(late, "row", "left").fillna(0, ["late_known", "late_log"])
    level = float(np.log10(n_total + 0.5 * (n_types + 1)))
    return both.select(
        F.col("id").alias(doc), "held_out", "n_tokens", (F.col("known") + F.col("late_known")).alias("n_known"), F.lit(int(n_total)).cast("long").alias("train_tokens"),
        (F.col("log_all") + F.col("late_log") - F.col("n_tokens") * level).alias("base_score"), (F.col("log_model") + F.col("late_log")).alias("score"),
    )
