"""Token-ID / binary output: documents as token ids in bit-plane shuffled, compressed shards.

Documents are range-partitioned by id, tokenised, and packed in ascending id order. A shard holds whole documents; its
ids are cut into fixed-size blocks, each block is transposed into byte planes (or bit planes), every plane is compressed
with zstandard, and an index stores where each plane of each block lies. Shards are rows of a table that Spark writes to
the shared folder, one self-describing byte string each, so that commits, retries and any file system are Spark's business.

Layout of a shard, all integers little-endian: ``BPS1``, then six u32: documents, blocks, ids per block, planes, bits per
plane (1 or 8), length of the compressed document table; u64: ids; the document table (zstandard of validity bytes, int64
ids and u64 lengths); the index, ``blocks * planes`` u32 lengths of compressed planes; the planes, block by block.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from .common import give_back_memory, materialize, small_side, text_runs, word_codes

BLOCK = 1 << 16
MAGIC = b"BPS1"


def to_planes(ids: np.ndarray, bits: int) -> list[bytes]:
    """Planes of a block of u32 ids, lowest first: 4 byte planes, or 32 bit planes padded to whole bytes."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits == 8:
        return [raw[:, k].tobytes() for k in range(4)]
    rows = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(rows[:, k]).tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int, bits: int) -> np.ndarray:
    if bits == 8:
        return np.stack([np.frombuffer(p, np.uint8, n) for p in planes], axis=1).copy().view("<u4").ravel()
    rows = np.stack([np.unpackbits(np.frombuffer(p, np.uint8))[:n] for p in planes], axis=1)
    return np.packbits(rows, axis=1, bitorder="little").view("<u4").ravel()


def encode_shard(docs: list[int | None], lengths: list[int], ids: np.ndarray, *, block: int = BLOCK, bits: int = 8, level: int = 3) -> bytes:
    pack = zstandard.ZstdCompressor(level)
    valid = np.array([d is not None for d in docs], np.uint8)
    keys = np.array([d or 0 for d in docs], "<i8")
    head = pack.compress(valid.tobytes() + keys.tobytes() + np.array(lengths, "<u8").tobytes())
    planes = [pack.compress(p) for at in range(0, len(ids), block) for p in to_planes(ids[at : at + block], bits)]
    per = 32 // bits
    fixed = np.array([len(docs), len(planes) // per, block, per, bits, len(head)], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes()
    return b"".join([MAGIC, fixed, head, np.array([len(p) for p in planes], "<u4").tobytes(), *planes])


def decode_shard(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document id, its token ids) in stored order; holds a block and the document at hand."""
    if data[:4] != MAGIC:
        raise ValueError("not a shard")
    n_docs, blocks, block, per, bits, head = (int(x) for x in np.frombuffer(data, "<u4", 6, 4))
    n_ids, unpack = int(np.frombuffer(data, "<u8", 1, 28)[0]), zstandard.ZstdDecompressor()
    table = unpack.decompress(data[36 : 36 + head])
    valid = np.frombuffer(table, np.uint8, n_docs)
    keys = np.frombuffer(table, "<i8", n_docs, n_docs)
    lengths = np.frombuffer(table, "<u8", n_docs, 9 * n_docs)
    sizes = np.frombuffer(data, "<u4", blocks * per, 36 + head).reshape(blocks, per)
    at, k, held = 36 + head + 4 * blocks * per, 0, np.empty(0, "<u4")
    for d in range(n_docs):
        need, parts = int(lengths[d]), [held]
        have = len(held)
        while have < need:
            planes = []
            for s in sizes[k]:
                planes.append(unpack.decompress(data[at : at + int(s)]))
                at += int(s)
            parts.append(from_planes(planes, min(block, n_ids - k * block), bits))
            have += len(parts[-1])
            k += 1
        whole = np.concatenate(parts) if len(parts) > 1 else held
        yield (int(keys[d]) if valid[d] else None), whole[:need]
        held = whole[need:]


class WordEncoder:
    """Token ids of whole texts through a cache of words.

    The tokenizer's normalisation and splitting never look across white space, so a text's ids are those of its words,
    one after the other. A word of plain letters (ASCII, or precomposed Latin-1 ones, which no normalisation joins to
    what follows) and ASCII punctuation after them splits between the two; all other words go to the library whole. New
    words of plain letters are encoded together, as one line: each is one piece, whose last token alone bears the
    end-of-word mark, which tells them apart. ``plain`` holds for tokenizers that lower-case, split letters from
    punctuation and mark word ends, which is tried on samples; for any other one every word goes to the library whole.
    At most about ``limit`` words are held; beyond it the first ``keep`` learned, among them nearly all frequent ones, stay.
    """

    #: ASCII punctuation but quotes, which join letters in contractions.
    MARKS = "!#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    #: Letters that are one code point in every normalisation form C text, whatever stands beside them.
    LETTERS = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")

    def __init__(self, tokenizer: str, limit: int = 600_000, keep: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.limit, self.keep = Tokenizer.from_str(tokenizer), limit, keep
        vocabulary = self.tok.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
        self.index: dict[str, int] = {}
        self.ids, self.starts, self.lengths = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.plain = self._is_plain()

    def _is_plain(self) -> bool:
        of = lambda t: self.tok.encode(t, add_special_tokens=False).ids
        stems = [*map(chr, [*range(65, 91), *range(97, 123)]), "The", "quick", "\xc0\xe9\xdf", "\xfcber", "x\xff"]
        splits = all(of(w + m) == of(w.lower()) + of(m) for w in stems for m in [*self.MARKS, self.MARKS])
        return splits and all(self.ends[of(w)[-1]] and not self.ends[of(w)[:-1]].any() for w in stems) and of(" ".join(stems)) == [i for w in stems for i in of(w)]

    def _forget(self) -> None:
        n = min(self.keep, len(self.starts))
        self.index = dict(islice(self.index.items(), n))  # in the order of their places
        self.starts, self.lengths = self.starts[:n].copy(), self.lengths[:n].copy()
        self.ids = self.ids[: int(self.lengths.sum())].copy()

    def rest(self) -> None:
        """Keeps little memory between tasks."""
        if len(self.index) > self.keep:
            self._forget()

    def _add(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        self.index.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def _encode(self, words: list[str], letters: bool) -> tuple[np.ndarray, np.ndarray]:
        if letters:
            ids = np.array(self.tok.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int64)
            return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        e = self.tok.encode_batch_fast(words, add_special_tokens=False)
        return np.array([i for x in e for i in x.ids], np.int64), np.array([len(x.ids) for x in e], np.int64)

    def _learn(self, words: list[str], letters: bool, run: int = 4000) -> None:
        parts = [self._encode(words[at : at + run], letters) for at in range(0, len(words), run)]
        if parts:
            self._add(words, *(np.concatenate(x) for x in zip(*parts, strict=True)))

    def _gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places of the cache, concatenated, and where each ends."""
        sizes = self.lengths[at]
        ends = np.cumsum(sizes)
        take = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[at] - (ends - sizes), sizes)
        return self.ids[take], ends

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, concatenated, and the number of ids of each."""
        if len(self.index) > self.limit:
            self._forget()
        codes, words, n = word_codes(texts, lower=False)
        letters: set[str] = set()
        other: set[str] = set()
        pairs: list[tuple[str, str, str]] = []
        for w in words:
            if not w or w in self.index:
                continue
            stem = w.rstrip(self.MARKS)
            if not self.plain or not self.LETTERS.fullmatch(stem):
                other.add(w)
                continue
            base = stem.lower()
            letters.add(base)
            tail = w[len(stem) :]
            if tail:
                other.add(tail)
            if tail or base != w:
                pairs.append((w, base, tail))
        self._learn([w for w in letters if w not in self.index], True)
        self._learn([w for w in other if w not in self.index], False)
        if pairs:
            both = np.fromiter((self.index[x] for _, base, tail in pairs for x in (base, tail) if x), np.int64)
            per = np.array([1 + bool(tail) for _, _, tail in pairs])
            ids, ends = self._gather(both)
            self._add([w for w, _, _ in pairs], ids, np.diff(ends[np.cumsum(per) - 1], prepend=0))
        places = np.fromiter((self.index[w] if w else 0 for w in words), np.int64, len(words))
        ids, ends = self._gather(places[codes] if len(codes) else np.empty(0, np.int64))
        return ids, np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])])


def worker_encoder(tokenizer: str) -> WordEncoder:
    """The Python process's encoder: its cache outlives a task, since a worker serves many. Results do not depend on it.

    It lies in a module of its own: this one travels by value with every task, so its globals do not outlive the task.
    """
    store = sys.modules.setdefault("_llm_worker", types.ModuleType("_llm_worker")).__dict__
    key = ("encoder", zlib.crc32(tokenizer.encode()))
    if key not in store:
        store[key] = WordEncoder(tokenizer)
    return store[key]


def _write(batches: Iterator[pa.RecordBatch], tokenizer, end: int, shard_ids: int, block: int, bits: int, chars: int = 6_000_000) -> Iterator[pa.RecordBatch]:
    coder, pid, seq = worker_encoder(tokenizer.value), TaskContext.get().partitionId(), 0
    docs: list = []
    lengths: list = []
    ids: list = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal docs, lengths, ids, size, seq
        row = pa.RecordBatch.from_pydict(
            {"pid": [pid], "seq": [seq], "n_docs": [len(docs)], "n_ids": [size], "shard": pa.array([encode_shard(docs, lengths, np.concatenate(ids), block=block, bits=bits)], pa.binary())},
            schema=pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("shard", pa.binary())]),
        )
        docs, lengths, ids, size, seq = [], [], [], 0, seq + 1
        return row

    for b in text_runs(batches, "text", chars):
        flat, n = coder.encode(b.column("text"))
        at = 0
        for k, m in zip(b.column("id").to_pylist(), n.tolist(), strict=True):
            docs.append(k), lengths.append(m + 1)
            ids += [flat[at : at + m], np.array([end], np.uint32)]
            at += m
            size += m + 1
            if size >= shard_ids:
                yield flush()
    if docs:
        yield flush()
    coder.rest()
    give_back_memory()


def write_tokens(docs: DataFrame, tokenizer: str, *, doc: str = "doc_id", text: str = "text", end: int = 1, shard_ids: int = 2_000_000, block: int = BLOCK, bits: int = 8) -> DataFrame:
    """Encodes ``docs`` into shards and returns their table: ``pid, seq, n_docs, n_ids, shard``, in document order by (pid, seq).

    ``tokenizer`` is the path of a tokenizers-library file, read on the driver. Null and empty texts are the end id alone.
    Documents are in ascending order of their integer id (another type of id raises ``TypeError``), null ids first; rows
    that share an id are dealt and ordered by a hash of their text, so repeated rows stand side by side and no id makes a hot range
    (equal rows do, as one range of ids and texts). Other columns are not read; an empty table
    gives no shards. The shards are cells of a Spark table, one self-describing file image each (see above).
    """
    if not isinstance(docs.schema[doc].dataType, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"the file format holds integer ids, but {doc} is {docs.schema[doc].dataType.simpleString()}")
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(doc).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("spread", F.xxhash64("text"))  # rows that share an id are dealt by text too
    ordered = rows.repartitionByRange("id", "spread").sortWithinPartitions("id", "spread", "text").drop("spread")
    shards = ordered.mapInArrow(lambda it: _write(it, shared, end, shard_ids, block, bits), "pid int, seq int, n_docs long, n_ids long, shard binary")
    written = materialize(shards, "token-shards", compression="none")
    shared.destroy()
    return written


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start, shard in zip(b.column("start"), b.column("shard"), strict=True):
            at = start.as_py()
            rows: list = []
            for key, ids in decode_shard(shard.as_py()):
                rows.append((key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                at += len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc", "start", "n_tokens", "ids_crc32"])


def token_digests(shards: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """Reads shards back: per document its id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids_crc32``."""
    spark = shards.sparkSession
    before, total = [], 0
    for r in shards.groupBy("pid").agg(F.sum("n_ids").alias("n")).orderBy("pid").collect():  # a row per written partition
        before.append((r["pid"], total))
        total += r["n"]
    base = spark.createDataFrame(before, "pid int, base long")
    earlier = F.coalesce(F.sum("n_ids").over(Window.partitionBy("pid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    index = shards.select("pid", "seq", "n_ids").withColumn("earlier", earlier).join(F.broadcast(base), "pid")
    index = index.select("pid", "seq", (F.col("base") + F.col("earlier")).alias("start"))
    placed = shards.select("pid", "seq", "shard").join(small_side(index, index.count()), ["pid", "seq"]).select("start", "shard")
    return placed.mapInArrow(_read, "doc long, start long, n_tokens long, ids_crc32 long").withColumnRenamed("doc", doc)
