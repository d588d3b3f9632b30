"""Secret scans: fixed patterns, and a character convolutional network over every candidate and its context.

Candidates are the matches of the fixed patterns and all runs of eight or more credential characters, dots between them
included, but plain words (letters of one case, or a capital before small ones): keys with or without digits, dotted
tokens whole, passphrases joined by separators. The network
(numpy: character embedding, one convolution, max pooling over positions, logistic output) reads a candidate with the
characters around it, a long one in overlapping windows, of which the highest score counts. It is trained on labelled
findings from the corpus itself, all of them, in shards whose parameters are averaged: the values of pattern matches are positive; long words and
candidates of shapes that carry no credential (decimal numbers, words and numbers joined by separators) are negative; all
other candidates may be secrets that no pattern knows, and are left out. Every finding is learned with and without the
characters around it, so a keyword is not what makes a secret. Scores are calibrated (Platt) on held-out findings, and
the threshold is the highest that keeps the required recall there.
Pattern matches are always reported; the network adds the candidates that score above its threshold.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .common import carried, named, restored

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: A candidate of the network: a run of credential characters and single dots between them that is no plain word.
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_.=-]{8})(?!(?:[A-Z]?[a-z]++|[A-Z]++)(?!\.?[A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+")
SHORTEST = 8
#: Runs that carry no credential: decimal numbers, rules, and words and numbers joined by separators.
CLEAN = re.compile(r"[0-9/_.=+-]+|[/_=+-]*(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]{1,8})(?:[/_.=+-]+(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]{1,8}))*[/_=+-]*")
WORD = re.compile(r"(?<![^\W_])[^\W\d_]{12,}")
BEFORE, INSIDE, AFTER = 24, 32, 8
WIDTH = BEFORE + INSIDE + AFTER
ALPHABET = 98
_table = bytes.maketrans(bytes(range(256)), bytes(0x30 if chr(c) in "0123456789abcdef" else 0x2E for c in range(256)))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, by start and then kind as listed; code points, end exclusive."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"0" * 24 in text.encode("utf-8", "surrogatepass").translate(_table):  # every hex character maps to 0
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs that no fixed pattern touches."""
    free, k = [], 0
    for m in RUN.finditer(text):
        a, b = m.span()
        if b - a < SHORTEST:
            continue
        while k < len(base) and base[k][1] <= a:
            k += 1
        if not any(s < b and a < e for s, e, _ in base[max(0, k - 3) : k + 8]):
            free.append((a, b))
    return free


def pieces(start: int, end: int) -> list[tuple[int, int]]:
    """Parts of a span that a window shows, each overlapping the next by half or more; together they cover the span."""
    return [(a, a + INSIDE) for a in range(start, end - INSIDE, INSIDE // 2)] + [(max(start, end - INSIDE), end)]


def value_span(text: str, start: int, end: int, kind: str) -> tuple[int, int]:
    """A pattern match without its keyword."""
    return ASSIGN.match(text, start).span(2) if kind == "assign" else (start, end)


def window(text: str, start: int, end: int) -> bytes:
    """Codes of a candidate and its context: 0 pads, 1-95 are printable ASCII, 96 other white space, 97 anything else."""
    piece = text[max(0, start - BEFORE) : start].rjust(BEFORE, "\0") + text[start:end][:INSIDE].ljust(INSIDE, "\0") + text[end : end + AFTER].ljust(AFTER, "\0")
    return bytes(0 if c == "\0" else ord(c) - 31 if " " <= c <= "~" else 96 if c.isspace() else 97 for c in piece)


class CharacterNetwork:
    """Embedding, a convolution over ``span`` characters, ReLU, max pooling in three segments, and a logistic output."""

    def __init__(self, filters: int = 24, width: int = 8, span: int = 5, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.3, (ALPHABET, width))
        self.k = rng.normal(0, 0.2, (span * width, filters))
        self.b = np.zeros(filters)
        self.o = rng.normal(0, 0.1, 3 * filters)
        self.c = np.zeros(1)
        self.span = span

    @property
    def parameters(self) -> list[np.ndarray]:
        return [self.e, self.k, self.b, self.o, self.c]

    def packed(self) -> list[float]:
        return np.concatenate([p.ravel() for p in self.parameters]).tolist()

    def unpack(self, values) -> CharacterNetwork:
        at = 0
        for p in self.parameters:
            p[...] = np.asarray(values[at : at + p.size], float).reshape(p.shape)
            at += p.size
        return self

    def _segments(self) -> list[slice]:
        last = WIDTH - self.span + 1
        return [slice(0, BEFORE - 2), slice(BEFORE - 2, BEFORE + INSIDE - 2), slice(BEFORE + INSIDE - 2, last)]

    def forward(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        emb = self.e[x]
        cols = np.lib.stride_tricks.sliding_window_view(emb, self.span, axis=1)  # rows, places, width, span
        cols = cols.transpose(0, 1, 3, 2).reshape(len(x), WIDTH - self.span + 1, -1)
        act = np.maximum(cols @ self.k + self.b, 0)
        at = [act[:, s].argmax(1) + (s.start or 0) for s in self._segments()]
        pooled = np.concatenate([np.take_along_axis(act, a[:, None], 1)[:, 0] for a in at], axis=1)
        return pooled @ self.o + self.c[0], (cols, at, pooled)

    def fit(self, x: np.ndarray, y: np.ndarray, *, epochs: int = 6, batch: int = 128, rate: float = 0.01, seed: int = 3) -> None:
        rng, t = np.random.default_rng(seed), 0
        m, s = ([np.zeros_like(p) for p in self.parameters] for _ in range(2))
        f = len(self.b)
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for at in range(0, len(y), batch):
                i, t = order[at : at + batch], t + 1
                z, (cols, best, pooled) = self.forward(x[i])
                g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / len(i)
                gp = g[:, None] * self.o * (pooled > 0)
                gk, ge = np.zeros_like(self.k), np.zeros_like(self.e)
                for q, places in enumerate(best):
                    d = gp[:, q * f : (q + 1) * f]
                    picked = np.take_along_axis(cols, places[:, :, None], 1)  # rows, filters, span * width
                    gk += np.einsum("nfc,nf->cf", picked, d)
                    back = (d[:, :, None] * self.k.T).reshape(len(i), f, self.span, -1)
                    codes = x[i][np.arange(len(i))[:, None, None], places[:, :, None] + np.arange(self.span)]
                    np.add.at(ge, codes.ravel(), back.reshape(-1, ge.shape[1]))
                grads = [ge, gk, gp.reshape(len(i), 3, f).sum((0, 1)), pooled.T @ g, np.array([g.sum()])]
                for p, d, a, v in zip(self.parameters, grads, m, s, strict=True):  # Adam
                    a += 0.1 * (d - a)
                    v += 0.001 * (d * d - v)
                    p -= rate * (a / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)


def calibrate(z: np.ndarray, y: np.ndarray, *, recall: float, least: float, count: np.ndarray | None = None) -> tuple[float, float, float]:
    """Platt scale and shift fitted by Newton steps that lower the loss, and the threshold: the highest with the given recall, at least ``least``.

    ``count`` tells how many findings have each score and label; one each without it.
    """
    a, b = 1.0, 0.0
    count = np.ones(len(z)) if count is None else count
    n1, n0 = count[y == 1].sum(), count[y == 0].sum()
    goal = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    loss = lambda a, b: float((count * (np.logaddexp(0, a * z + b) - goal * (a * z + b))).sum())
    now = loss(a, b)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = count * (p * (1 - p) + 1e-9)
        h = np.array([[(w * z * z).sum() + 1e-6, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
        step, size = np.linalg.solve(h, [(count * (p - goal) * z).sum(), (count * (p - goal)).sum()]), 1.0
        while size > 1e-9 and loss(a - size * step[0], b - size * step[1]) >= now:  # a whole step may overshoot
            size /= 2
        if size <= 1e-9:
            break
        a, b = a - size * step[0], b - size * step[1]
        now = loss(a, b)
    p, n = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))[y == 1], count[y == 1]
    up = np.argsort(p, kind="stable")
    reach = p[up][np.searchsorted(np.cumsum(n[up]), int((1 - recall) * n1), side="right")] if len(p) else 1.0
    return float(a), float(b), float(max(least, min(reach, 0.999)))


def _findings(batches: Iterator[pa.RecordBatch], salt: int) -> Iterator[pa.RecordBatch]:
    """Labelled windows: values of base matches (1), clean candidates and one long word a text (0), with a hash for sampling."""
    for b in batches:
        rows = []
        for t in b.column("text"):
            text = t.as_py() or ""
            base = base_spans(text)
            spots = [(*value_span(text, s, e, kind), 1) for s, e, kind in base] + [(s, e, 0) for s, e in candidates(text, base) if CLEAN.fullmatch(text, s, e)]
            word = WORD.search(text)
            if word:
                spots.append((*word.span(), 0))
            for s, e, y in [(*piece, y) for s, e, y in spots for piece in pieces(s, e)]:
                w = window(text, s, e)
                h = int.from_bytes(hashlib.blake2b(w, digest_size=8, salt=salt.to_bytes(8, "little")).digest(), "little") >> 1
                rows.append((y, h, w))
        cols = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["y", "h", "w"])


def _both(windows) -> np.ndarray:
    """Codes of windows, and again without the characters around the candidate."""
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH).astype(np.int64)
    alone = x.copy()
    alone[:, :BEFORE] = alone[:, BEFORE + INSIDE :] = 0
    return np.concatenate([x, alone])


def _train(rows: pd.DataFrame, start: list[float], epochs: int) -> pd.DataFrame:
    """Parameters after ``epochs`` over the findings of a shard."""
    rows = rows.sort_values(["y", "h", "w"])
    net = CharacterNetwork().unpack(start)
    net.fit(_both(rows["w"]), np.tile(rows["y"].to_numpy(float), 2), epochs=epochs)
    return pd.DataFrame({"p": [net.packed()]})


def _scored(frames: Iterator[pd.DataFrame], parameters: list[float]) -> Iterator[pd.DataFrame]:
    """Labels and scores of findings, with and without context; a score counts as the next lower multiple of 1/256, within 64."""
    net = CharacterNetwork().unpack(parameters)
    for rows in frames:
        for at in range(0, len(rows), 1024):
            part = rows.iloc[at : at + 1024]
            z = net.forward(_both(part["w"]))[0]
            yield pd.DataFrame({"y": np.tile(part["y"].to_numpy(), 2), "z": np.floor(np.clip(z, -64, 64) * 256).astype(int)})


def fit_network(docs: DataFrame, *, text: str = "text", shard: int = 12000, rounds: int = 2, recall: float = 0.98) -> tuple[list[np.ndarray], tuple[float, float, float]]:
    """Network parameters and calibration, from all distinct windows of both labels.

    A third of the windows is held out of training, for calibration. The others are dealt by hash to shards of about
    ``shard`` windows; each trains from the shared parameters, which are averaged after every round. Calibration and
    threshold come from the counts of all held-out scores. The driver sees parameters and counts of scores alone. Without
    findings of both labels nothing is added.
    """
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(text).alias("text"))
    found = rows.mapInArrow(lambda it: _findings(it, 1), "y int, h long, w binary").groupBy("w").agg(F.max("y").alias("y"), F.min("h").alias("h"))
    found = stored(found, "secret-windows")
    sizes = {r["y"]: r["count"] for r in found.groupBy("y").count().collect()}
    net = CharacterNetwork()
    if len(sizes) < 2:
        return net.parameters, (1.0, 0.0, 2.0)
    shards = -(-sum(sizes.values()) // shard)
    dealt = found.filter("h % 3 <> 0").withColumn("shard", F.expr(f"(h div 3) % {shards}"))
    for _ in range(rounds):
        start = net.packed()
        made = dealt.repartition(shards, "shard").groupBy("shard").applyInPandas(lambda f: _train(f, start, 6 // rounds), "p array<double>")  # noqa: B023
        means = made.select(F.posexplode("p").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("v")).collect()  # a row per parameter
        net.unpack([r["v"] for r in sorted(means, key=lambda r: r["k"])])
    final = net.packed()
    counts = found.filter("h % 3 = 0").select("y", "w").mapInPandas(lambda it: _scored(it, final), "y int, z int").groupBy("y", "z").count().toPandas()  # at most 65,538 rows
    return net.parameters, calibrate(counts["z"].to_numpy() / 256, counts["y"].to_numpy(), recall=recall, least=0.0, count=counts["count"].to_numpy(float))


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    parameters, (a, b0, threshold) = shared.value
    net = CharacterNetwork()
    net.e, net.k, net.b, net.o, net.c = parameters
    schema = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("score", pa.float64())])
    for batch in batches:
        spans, windows, sizes = [], [], []
        for t in batch.column("_text"):
            text = t.as_py() or ""
            base = base_spans(text)
            own = [[s, e, kind] for s, e, kind in base] + [[s, e, "model"] for s, e in candidates(text, base)]
            spans.append(own)
            for s, e, kind in own:
                parts = pieces(*value_span(text, s, e, kind))
                windows += [window(text, *p) for p in parts]
                sizes.append(len(parts))
        every = np.empty(len(windows))
        for at in range(0, len(windows), 2048):
            x = np.frombuffer(b"".join(windows[at : at + 2048]), np.uint8).reshape(-1, WIDTH).astype(np.int64)
            every[at : at + 2048] = 1 / (1 + np.exp(-np.clip(a * net.forward(x)[0] + b0, -30, 30)))
        score = np.maximum.reduceat(every, np.cumsum(sizes) - sizes) if sizes else every
        at, out = 0, []
        for own in spans:
            rows = [(s, e, kind, float(p)) for (s, e, kind), p in zip(own, score[at : at + len(own)], strict=True)]
            at += len(own)
            rows = [r for r in rows if r[2] != "model" or r[3] >= threshold]
            out.append([dict(zip(("start", "end", "kind", "score"), r, strict=True)) for r in sorted(rows, key=lambda r: (r[0], KINDS.index(r[2])))])
        rest = [c for c in batch.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out, pa.list_(schema))], [*rest, "findings"])


def scan_secrets(docs: DataFrame, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), **fit) -> DataFrame:
    """``keep`` columns and ``findings``: spans (start, end, kind, calibrated score) in order, of every whole text.

    Null and empty texts have no findings; repeated rows give repeated results; an empty table gives no rows. A kept
    column named ``findings`` gives way to the result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit_network(docs, text=text, **fit))
    rows = carried(docs, keep, _text=named(text))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")
    found = rows.mapInArrow(lambda it: _scan(it, shared), f"{fields}, findings array<struct<start:bigint,end:bigint,kind:string,score:double>>")
    return restored(found, keep, ("findings",))


def digest(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of base spans per kind, the SHA-256 of their list, and the list of all spans."""
    base = F.filter("findings", lambda f: f["kind"] != "model")
    listed = lambda c: F.array_join(F.transform(c, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")
    return found.select(
        *keep, of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("findings")).alias("spans"), of("model").alias("n_model"),
    )
