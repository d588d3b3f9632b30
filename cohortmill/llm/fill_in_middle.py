"""Fill-in-the-middle transformation by a secondary sort of text pieces.

Every text is cut at unit boundaries into pieces that carry the document and their position in the output. The DataFrame
form of ``repartitionAndSortWithinPartitions`` (a repartition by document, then a sort within the partitions by document
and position) brings the pieces of a document together in output order, where they stream into an incremental digest; the
pieces that are read off the output (by its markers alone) are sorted again, by their place in the original text. They are
in the right partition already, so the second sort moves nothing between tasks. No task holds a whole output: sorting
spills, and reading needs a batch of pieces and two bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import named, text_runs

#: Units of a piece, and bytes of a piece whose units are longer.
PIECE_UNITS, PIECE_BYTES = 4096, 1 << 16
#: Markers of the parts, and each form's order of parts in the output.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
ORIGINAL = {b"<P>": 0, b"<M>": 1, b"<S>": 2}
MARK = re.compile(b"<[PSM]>")
#: The end of a piece that may be the beginning of a marker.
OPEN = re.compile(b"<[PSM]?$")
BLOCK = 1 << 16
#: Pieces and bytes of a batch on its way to Spark.
BATCH, BATCH_BYTES = 4096, 1 << 22
OWNER = ["task", "row"]
FACTS = "n long, form string, prefix_chars long, middle_chars long"


class Units:
    """Units (runs of ASCII letters, or single other code points) of a UTF-8 text: their number and byte offsets."""

    def __init__(self, data: bytes):
        b = np.frombuffer(data, np.uint8)
        letter = ((b | 32) - np.uint8(97)) < 26
        self.lead = (b & 0xC0) != 0x80
        self.start = self.lead.copy()
        self.start[1:] &= ~(letter[1:] & letter[:-1])
        per_block = np.add.reduceat(self.start, np.arange(0, len(b), BLOCK), dtype=np.int64) if len(b) else np.zeros(0, np.int64)
        self.before = np.concatenate([[0], np.cumsum(per_block)])
        self.n, self.size = int(self.before[-1]), len(b)

    def offset(self, k: int) -> int:
        """Byte at which unit ``k`` begins; the text's length for ``k = n``."""
        if k >= self.n:
            return self.size
        block = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(self.start[block * BLOCK : (block + 1) * BLOCK])
        return block * BLOCK + int(inside[k - self.before[block]])

    def chars(self, start: int, stop: int) -> int:
        return int(np.count_nonzero(self.lead[start:stop]))


def draw(doc_id: object, seed: int = 1) -> list[int]:
    """Four unsigned numbers of a document, from its decimal id; a null id counts as empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


def pieces_of(doc_id: object, text: str | None) -> tuple[tuple, Iterator[bytes]]:
    """(n, form, prefix characters, middle characters) of a document, and its pieces in output order (at least one)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    units, (h1, h2, h3, h4) = Units(data), draw(doc_id)
    plain = not data or MARK.search(data) is not None or h3 % 100 >= 90
    form = "plain" if plain else "spm" if h4 % 100 < 20 else "psm"
    low, high = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    spans = {"prefix": (0, low), "middle": (low, high), "suffix": (high, units.n)}

    def cut(start: int, stop: int) -> Iterator[bytes]:
        for u in range(start, stop, PIECE_UNITS):
            a, b = units.offset(u), units.offset(min(u + PIECE_UNITS, stop))
            yield from (data[i : min(i + PIECE_BYTES, b)] for i in range(a, b, PIECE_BYTES))

    if plain:
        found = cut(0, units.n)
        return (units.n, form, None, None), chain([next(found, b"")], found)
    a, b = units.offset(low), units.offset(high)
    parts = (chain([MARKS[x]], cut(*spans[x])) for x in ORDERS[form])
    return (units.n, form, units.chars(0, a), units.chars(a, b)), chain.from_iterable(parts)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows whose fifth cell is a piece, as record batches of bounded size."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[4] or b"")
        if len(held) >= BATCH or size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _schema(kind: pa.DataType, *more: tuple) -> pa.Schema:
    """Owner and place of a piece, the piece, and facts that one row of each document bears."""
    facts = [("id", kind), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
    return pa.schema([("task", pa.int32()), ("row", pa.int64()), ("rank", pa.int32()), ("at", pa.int64()), ("piece", pa.binary()), *facts, *more])


def _pieces(run: pa.RecordBatch, task: int, row: int) -> Iterator[tuple]:
    """Pieces of a run of texts whose first row in its task is ``row``; the first piece of a document bears its facts."""
    for k, (doc_id, text) in enumerate(zip(run.column("id").to_pylist(), run.column("text").to_pylist(), strict=True), row):
        facts, found = pieces_of(doc_id, text)
        for at, piece in enumerate(found):
            yield (task, k, 0, at, piece, *((None,) * 5 if at else (doc_id, *facts)))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, row = TaskContext.get().partitionId(), 0
    for run in text_runs(batches, "text"):
        yield from _batches(_pieces(run, task, row), _schema(run.schema.field("id").type))
        row += run.num_rows


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    return groupby(_rows(batches), key=lambda r: r[:2])


def ordered_pieces(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(task, row, rank, at, piece, id and facts) of all documents, each whole in one partition and in output order.

    As many partitions as the scan has, or ``spark.sql.shuffle.partitions`` if that is more. A row is told from others by
    its place in the scan, so rows of any id spread evenly.
    """
    rows = docs.select(named(doc).alias("id"), named(text).alias("text"))
    n = max(rows.rdd.getNumPartitions(), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = rows.mapInArrow(_cut, f"task int, row long, rank int, at long, piece binary, id {kind}, {FACTS}")
    return pieces.repartition(n, *OWNER).sortWithinPartitions(*OWNER, "at")


def _read_off(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Digests a document's output while it streams by, and yields what it says of the original text.

    Rank -1 is the document's facts and digest, 0 to 2 are pieces of prefix, middle and suffix.
    """
    none = (None,) * 6
    for owner, found in _documents(batches):
        digest, facts, rank, held, at = hashlib.sha256(), None, 0, b"", 0
        for _, _, _, place, piece, *told in found:
            if place == 0:
                facts = told
            digest.update(piece)
            if facts[2] == "plain":
                yield (*owner, 0, at, piece, *none)
                at += 1
                continue
            data, done = held + piece, 0
            for m in MARK.finditer(data):
                if m.start() > done:
                    yield (*owner, rank, at, data[done : m.start()], *none)
                    at += 1
                rank, done = ORIGINAL[m[0]], m.end()
            tail = OPEN.search(data, done)
            stop = tail.start() if tail else len(data)
            if stop > done:
                yield (*owner, rank, at, data[done:stop], *none)
                at += 1
            held = data[stop:]
        if held:
            yield (*owner, rank, at, held, *none)
        yield (*owner, -1, 0, None, *facts, digest.hexdigest())


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is not None:
        schema = _schema(first.schema.field("id").type, ("output_sha256", pa.string()))
        yield from _batches(_read_off(chain([first], batches)), schema)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = next(batches, None)
    if first is None:
        return
    fields = list(first.schema)[5:]
    schema = pa.schema([*fields, ("restored_sha256", pa.string())])
    held = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)

    for _, found in _documents(chain([first], batches)):
        facts = next(found)[5:]
        digest = hashlib.sha256()
        for r in found:
            digest.update(r[4])
        held.append((*facts, digest.hexdigest()))
        if len(held) >= BATCH:
            yield batch()
            held.clear()
    if held:
        yield batch()


def fill_in_middle(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``n`` units, ``form``, ``prefix_chars`` and ``middle_chars`` (null if plain), and the SHA-256 of the
    output and of the text rebuilt from output and form.

    The id may be of any type; a null id draws like empty text. Null texts are empty and plain. Rows are told apart by
    their place in the scan, so repeated ids and repeated rows give a row each, and no id makes a hot partition. ``docs``
    must give the same rows in the same order when a lost task runs again, as a stored table does. No rows give none;
    other columns are not read.
    """
    kind = docs.schema[doc].dataType.simpleString()
    read = ordered_pieces(docs, doc=doc, text=text).mapInArrow(_digest, f"task int, row long, rank int, at long, piece binary, id {kind}, {FACTS}, output_sha256 string")
    made = read.sortWithinPartitions(*OWNER, "rank", "at").mapInArrow(_restore, f"id {kind}, {FACTS}, output_sha256 string, restored_sha256 string")
    return made.withColumnRenamed("id", doc)


def transformed_texts(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, ``form`` and the transformed ``text`` itself, for training files; a task holds one document at a time."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        for _, found in _documents(chain([first], batches)):
            head = next(found)
            whole = b"".join(chain([head[4]], (r[4] for r in found))).decode("utf-8", "surrogatepass")
            yield pa.RecordBatch.from_arrays([pa.array([head[5]], first.schema.field("id").type), pa.array([head[7]]), pa.array([whole], pa.string())], ["id", "form", "text"])

    kind = docs.schema[doc].dataType.simpleString()
    return ordered_pieces(docs, doc=doc, text=text).mapInArrow(joined, f"id {kind}, form string, text string").toDF(doc, "form", text)
