"""N-gram Jaccard join: size-aware heavy-light candidate search, exact verification and components of linked documents.

A document's set holds its distinct five-word shingles. Identical sets collapse to one representative first. Every set
is ordered by one global order, rare shingles first: shingles frequent in the corpus ("hot", by a count over all
documents) come last, by count, the others by hash. If two sets have a Jaccard similarity of t, they share at least
k elements of their prefixes of length ``size - ceil(t * size) + k``.

* Light (small) sets, up to a size boundary, enumerate all fixed-size subsets (k = 2) of that prefix: a pair of
  similar light sets shares one subset, and subsets are far more selective than single shingles.
* Heavy (large) sets post their prefix (k = 1) to inverted lists, which are scanned. Light sets within the similarity's
  size ratio of the boundary post there as well, so light-heavy pairs meet.
* The boundary is the size with the least estimated cost, from the histogram of sizes: subsets against postings.

Lists are not expanded into all pairs at first. Each list compares its members with one pivot (the member with the
fewest rare shingles, then the smallest id); verified pairs merge components, and later rounds look only at lists that
still hold several components. What then remains of a list is compared pair by pair across components where that makes
at most ``LIST`` pairs a member; any other list is split by its members' next shingle (similar sets share one element more in a prefix one
longer), and its parts go through the same rounds. No link is lost; an element more is asked up to three, since sets that
share no more than that and are similar without being equal begin at three.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back_memory, materialize, named, settle, small_side, text_runs, word_codes, word_hashes

#: Pairs across components for each member of a list (its own included) up to which a list is compared pair by pair.
LIST = 1000

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(texts: pa.Array, n: int = 5) -> list[np.ndarray]:
    """Per text the 64-bit hashes of its n-word shingles in order; a shorter text is one shingle, a wordless one has none."""
    codes, words, sizes = word_codes(texts)
    h = word_hashes(words)[codes] if len(codes) else np.empty(0, np.uint64)

    def combine(x: np.ndarray, k: int) -> np.ndarray:
        out = np.full(len(x) - k + 1, k, np.uint64)
        for j in range(k):
            out += x[j : len(x) - k + 1 + j] * _MULT[j % len(_MULT)]
        return _mix(out)

    whole, out, at = combine(h, n) if len(h) >= n else h[:0], [], 0
    for m in sizes.tolist():
        out.append(whole[at : at + m - n + 1] if m >= n else combine(h[at : at + m], m) if m else h[:0])
        at += m
    return out


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    return np.unique(shingle_hashes(pa.array([text], pa.string()), n)[0])


def _rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of rows and their sorted distinct shingles; the texts of a run are hashed together."""
    for b in text_runs(batches, "text"):
        yield b, list(map(np.unique, shingle_hashes(b.column("text"), n)))
    give_back_memory()


def _digests(batches: Iterator[pa.RecordBatch], n: int, bits: int, ranges: int, limit: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Set sizes and digests of all rows; and counts of shingle buckets (the top ``bits`` of the hash), delta-coded and
    compressed per range of buckets."""
    pack, held, size, kind = zstandard.ZstdCompressor(1), [], 0, pa.null()
    shift, per = np.uint64(64 - bits), (1 << bits) // ranges
    names = ["id", "size", "mark", "range", "blob"]

    def flush() -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(held), return_counts=True)
        cuts = np.searchsorted(value, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(per))
        cuts[-1] = len(value)
        some, blobs = np.flatnonzero(np.diff(cuts)), []
        for lo, hi in zip(cuts[some], cuts[some + 1], strict=True):
            v = np.diff(value[lo:hi], prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
            blobs.append(pack.compress(np.array([hi - lo], "<u8").tobytes() + v + count[lo:hi].astype("<u4").tobytes()))
        held.clear()
        m = len(some)
        return pa.RecordBatch.from_arrays([pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), pa.array(some, pa.int32()), pa.array(blobs, pa.binary())], names)

    for b, sets in _rows(batches, n):
        marks, kind, m = [], b.column("id").type, b.num_rows
        for s in sets:
            marks.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
            held.append(s >> shift)
            size += len(s)
            if size >= limit:
                yield flush()
                size = 0
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
    if size:
        yield flush()


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    m = int(np.frombuffer(raw, "<u8", 1)[0])
    v = np.frombuffer(raw, np.uint8, 8 * m, 8).reshape(8, m).T.copy().view("<u8").ravel()
    return np.cumsum(v, dtype=np.uint64), np.frombuffer(raw, "<u4", m, 8 + 8 * m).astype(np.int64)


def _merge_counts(groups: Iterator[pd.DataFrame], least: int) -> Iterator[pd.DataFrame]:
    """Sums the packed counts of each range (sorted input) and returns the buckets counted ``least`` times or more."""

    def total(parts: list) -> pd.DataFrame:
        v = np.concatenate([p[0] for p in parts])
        c = np.concatenate([p[1] for p in parts])
        u, at = np.unique(v, return_inverse=True)
        c = np.bincount(at, weights=c, minlength=len(u)).astype(np.int64)
        hot = c >= least
        return pd.DataFrame({"bucket": u[hot].astype(np.int64), "n": c[hot]})

    now, parts = None, []
    for g in groups:
        for r, blob in zip(g["range"], g["blob"], strict=True):
            if r != now and parts:
                yield total(parts)
                parts = []
            now = r
            parts.append(_unpack(blob))
    if parts:
        yield total(parts)


class _Order:
    """The global order of shingles: those outside the hot buckets first, by hash; then hot ones, by count and hash."""

    def __init__(self, buckets: np.ndarray, counts: np.ndarray, bits: int):
        self.buckets, self.counts, self.shift = buckets, counts, np.uint64(64 - bits)

    def arrange(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The set in order, and how many of its shingles are not hot."""
        if not len(self.buckets) or not len(s):
            return s, len(s)
        b = s >> self.shift
        at = np.minimum(np.searchsorted(self.buckets, b), len(self.buckets) - 1)
        count = np.where(self.buckets[at] == b, self.counts[at], 0)
        return s[np.lexsort((s, count))], int((count == 0).sum())


def _keys(s: np.ndarray, t: float, boundary: int) -> list[np.ndarray]:
    """Of a set in order: keys of both kinds, the places of their first and last shingle, and the number of shingles."""
    m, parts = len(s), [(np.empty(0, np.uint64), *(np.empty(0, np.int64),) * 3)]
    need = math.ceil(t * m - 1e-9)
    if 2 <= m <= boundary:
        x, y = np.triu_indices(m - need + 2, 1)
        parts.append((_mix(np.minimum(s[x], s[y]) * _MULT[0] + _mix(np.maximum(s[x], s[y]))), x, y, np.full(len(x), 2)))
    if m and m >= t * boundary:
        x = np.arange(m - need + 1)
        parts.append((s[x], x, x, np.ones(len(x), np.int64)))
    return [np.concatenate(c) for c in zip(*parts, strict=True)]


def _lists(parts: list[np.ndarray], kind: type) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]).astype(np.int32)), pa.array(np.concatenate([*parts, np.empty(0, kind)]).astype(kind)))


def _postings(batches: Iterator[pa.RecordBatch], n: int, t: float, boundary: int, hot) -> Iterator[pa.RecordBatch]:
    """Per document its keys of both kinds, each with the place of its first shingle in the order; places before
    ``rare`` hold shingles that are not hot, so few documents share those keys."""
    order = _Order(*hot.value)
    for b, sets in _rows(batches, n):
        arranged = [order.arrange(s) for s in sets]
        found = [_keys(s, t, boundary) for s, _ in arranged]
        sizes = [pa.array([len(s) for s in sets], pa.int32()), pa.array([c for _, c in arranged], pa.int32())]
        yield pa.RecordBatch.from_arrays([b.column("id"), *sizes, _lists([f[0].view(np.int64) for f in found], np.int64), _lists([f[1] for f in found], np.int32)], ["id", "size", "rare", "key", "at"])


def _split(batches: Iterator[pa.RecordBatch], n: int, t: float, boundary: int, hot) -> Iterator[pa.RecordBatch]:
    """Per document, for each of its keys in ``held``, longer keys by one more shingle after the last.

    ``held``: (key, place of its first shingle, of its last, number); the last place is null for keys as ``_keys`` makes them.
    """
    order = _Order(*hot.value)
    for b, sets in _rows(batches, n):
        out: list[list[np.ndarray]] = []
        for s, held in zip(sets, b.column("held").to_pylist(), strict=True):
            s, _ = order.arrange(s)
            need, made, own = math.ceil(t * len(s) - 1e-9), [[np.empty(0, np.uint64)], [], [], []], None
            for h in held:
                last, depth = h["last"], h["depth"]
                if last is None:
                    own = own or {k: (y, d) for k, y, d in zip(*(c.tolist() for c in (lambda f: (f[0].view(np.int64), f[2], f[3]))(_keys(s, t, boundary))), strict=True)}
                    last, depth = own[h["key"]]
                j = np.arange(last + 1, min(len(s), len(s) - need + depth + 1))
                made[0].append(_mix(np.array([h["key"]]).view(np.uint64) * _MULT[2] + s[j]))
                for c, v in zip(made[1:], (np.full(len(j), h["at"]), j, np.full(len(j), depth + 1)), strict=True):
                    c.append(v)
            out.append([np.concatenate([*c, np.empty(0, c[0].dtype if c else np.int64)]) for c in made])
        yield pa.RecordBatch.from_arrays([b.column("id"), _lists([o[0].view(np.int64) for o in out], np.int64), *(_lists([o[k] for o in out], np.int32) for k in (1, 2, 3))], ["id", "key", "at", "last", "depth"])


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b, sets in _rows(batches, n):
        yield pa.RecordBatch.from_arrays([b.column("id"), _lists([s.view(np.int64) for s in sets], np.int64)], ["id", "shingles"])


def choose_boundary(sizes: list[tuple[int, int]], t: float, scan: float) -> int:
    """The set size up to which two-element subsets cost less: ``sizes`` are (size, sets).

    A light set of size m writes C(p + 1, 2) subsets with p = m - ceil(t m) + 1, which hardly ever meet anything by
    chance; a heavy one writes p postings, and each costs ``scan``: itself and the members its list brings.
    """
    best, cost, light = 0, math.inf, 0.0
    prefix = lambda m: m - math.ceil(t * m - 1e-9) + 1
    heavy = sum(c * prefix(m) * scan for m, c in sizes)
    for m, c in sorted(sizes):
        p = prefix(m)
        light += c * p * (p + 1) / 2
        heavy -= c * p * scan
        if light + heavy < cost:
            best, cost = m, light + heavy
    return best


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node for every node of the undirected ``edges``: columns ``node``, ``root``.

    Alternates large-star and small-star steps until the edges stop changing; each step is two aggregations, written to
    the shared folder. A hot node's neighbours are only aggregated with min, never gathered.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = materialize(e, "cc")
    seen = None
    while True:  # every step but the last brings edges nearer to stars
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = small.select("v", "m").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        e = materialize(e, "cc")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def jaccard_components(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", n: int = 5, percent: int = 75, rounds: int = 2, hot_limit: int = 1_000_000) -> DataFrame:
    """Per row: ``doc``, ``n_shingles`` and ``component_id``, the smallest id reachable over links.

    The id may be of any type that has an order. Two documents link when ``100 * |A & B| >= percent * |A | B|``. Null,
    empty and wordless texts have no shingles and link with nothing; shorter texts than ``n`` words are one shingle. Rows
    that share an id count as one document with several texts: links of any of them count; repeated rows give repeated
    results. A row with a null id is in no component (``component_id`` is null). Other columns are not read; an empty
    table gives no rows. At most ``hot_limit`` of the most frequent shingle buckets are treated as
    hot (the threshold rises with the corpus), which bounds the one table that every task holds; it only affects the
    order of shingles, so results do not depend on it.
    """
    t = percent / 100
    spark = docs.sparkSession
    body = docs.select(named(doc).alias("id"), named(text).alias("text"))
    kind = docs.schema[doc].dataType.simpleString()
    # buckets and their ranges follow the input's partitions, so that a range stays a task's work at any size
    parts = max(1, body.rdd.getNumPartitions())
    bits, ranges = 40, max(16, 1 << (2 * parts - 1).bit_length())
    first = materialize(body.mapInArrow(lambda it: _digests(it, n, bits, ranges), f"id {kind}, size long, mark binary, range int, blob binary"), "jac-marks")
    marks = first.filter("mark is not null").select("id", "size", "mark")
    some = marks.filter("size > 0 and id is not null")
    reps = materialize(some.groupBy("mark").agg(F.min("id").alias("rep"), F.first("size").alias("size"), F.count("*").alias("copies")), "jac-reps")
    total, n_rep, n_rows = reps.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    others = some.join(reps.select("mark", "rep"), "mark").groupBy("id").agg(F.bool_or(F.col("id") == F.col("rep")).alias("r")).filter("not r").select("id")
    unique = body.filter("id is not null").join(small_side(others, n_rows - n_rep, 100_000), "id", "left_anti")

    # frequent shingles, counted over all rows; the threshold is the least that keeps to hot_limit buckets
    packed = first.filter("blob is not null").select("range", "blob")
    merged = packed.repartition(ranges, "range").sortWithinPartitions("range").mapInPandas(lambda it: _merge_counts(it, 3), "bucket long, n long")
    counts = materialize(merged, "jac-counts")
    histogram = counts.groupBy(F.floor(F.log2("n") * 4).alias("level")).count().orderBy(F.desc("level")).collect()  # under 200 rows
    held, level = 0, None
    for r in histogram:
        held += r["count"]
        if held > hot_limit:
            break
        level = r["level"]
    hot_rows = counts.filter(F.floor(F.log2("n") * 4) >= (level if level is not None else 1 << 30)).toArrow()  # at most hot_limit rows
    buckets, number = hot_rows["bucket"].to_numpy(), hot_rows["n"].to_numpy()
    order = np.argsort(buckets)
    hot = spark.sparkContext.broadcast((buckets[order].astype(np.uint64), number[order].clip(max=2**31 - 1).astype(np.int32), bits))
    del hot_rows, buckets, number, order

    sizes = reps.groupBy("size").agg(F.count("*").alias("c"))
    coarse = sizes.groupBy(F.when(F.col("size") <= 512, F.col("size")).otherwise(513).alias("size")).agg(F.sum("c").alias("c")).collect()
    cold = counts.filter(F.floor(F.log2("n") * 4) < (level if level is not None else 1 << 30)).agg(F.sum(F.col("n").cast("double") ** 2)).first()[0]
    boundary = choose_boundary([(r["size"], r["c"]) for r in coarse], t, 2 + (cold or 0) / max(1, total))

    keyed = unique.mapInArrow(lambda it: _postings(it, n, t, boundary, hot), f"id {kind}, size int, rare int, key array<long>, at array<int>")
    posted = keyed.select("id", "size", "rare", F.explode(F.arrays_zip("key", "at")).alias("k")).select("id", "size", "rare", "k.key", "k.at")
    posted = posted.withColumn("hot", F.col("at") >= F.col("rare"))
    # a key that one document has links nothing. Cold keys are met seldom, which bounds their windows; hot ones need no
    # count, and spread over the tasks by their document
    spread = Window.partitionBy("key", F.when(F.col("hot"), F.col("id")))
    kept = posted.withColumn("members", F.count("*").over(spread)).filter("hot or members > 1")
    lead = F.min(F.struct("rare", "id", "size", "at"))
    lists = kept.select("key", "id", "size", "rare", "at", F.lit(None).cast("int").alias("last"), F.lit(0).alias("depth"))
    level = materialize(lists, "jac-lists")

    # shingles before a pair's first common one are not common: a bound of the overlap, true for one of their keys at least
    fits = (100 + percent) * F.least(F.col("sa") - F.col("ia"), F.col("sb") - F.col("ib")) >= percent * (F.col("sa") + F.col("sb"))
    # the same bound for a member against the smallest partner that its list can offer
    viable = (100 + percent) * (F.col("size") - F.col("at")) >= percent * (F.col("size") + F.greatest(F.col("least"), F.ceil(F.col("size") * percent / 100)))

    def verified(pairs: DataFrame) -> DataFrame:
        near = materialize(pairs.filter(fits).select("a", "b").distinct(), "jac-pairs")
        n_near = near.count()
        ids = near.select(F.col("a").alias("id")).unionByName(near.select(F.col("b").alias("id"))).distinct()
        # the sets of documents in pairs only, made anew from their texts: cheaper than to keep the sets of all
        sets = unique.join(small_side(ids, 2 * n_near), "id", "left_semi").mapInArrow(lambda it: _sets(it, n), f"id {kind}, shingles array<long>")
        sets = materialize(sets, "jac-sets")
        y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")).join(small_side(near, n_near), "b")
        x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")).join(small_side(near.select("a").distinct(), n_near), "a", "left_semi")
        both = y.join(x, "a")
        common = F.size(F.array_intersect("x", "y"))
        return materialize(both.filter(100 * common >= percent * (F.size("x") + F.size("y") - common)).select("a", "b"), "jac-links")

    columns = ("key", "id", "size", "rare", "at", "last", "depth")
    links, root = None, None

    def compare(pairs: DataFrame, last: bool = False) -> None:
        nonlocal links, root
        found = verified(pairs)
        links = found if links is None else links.unionByName(found)
        if not last and found.count():
            root = materialize(components(links), "jac-roots")

    def mixed(level: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members that still may link, with their components, and the lists that hold several of these."""
        here = level.withColumn("root", F.col("id"))
        if root is not None:
            here = level.join(root.select(F.col("node").alias("id"), "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
        here = here.join(here.groupBy("key").agg(F.min("size").alias("least")), "key").filter(viable).drop("least")
        return here, here.groupBy("key").agg(lead.alias("p"), F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 != r1")

    side = lambda df, x, *more: df.select("key", F.col("id").alias(x), F.col("size").alias(f"s{x}"), F.col("at").alias(f"i{x}"), F.col("root").alias(f"r{x}"), *more)
    while True:
        for _ in range(rounds):
            here, open_lists = mixed(level)
            level = materialize(here.join(open_lists.select("key", F.col("p.id").alias("pivot"), F.col("p.size").alias("psize"), F.col("p.at").alias("pat")), "key"), "jac-open")
            lead_root = level.filter("id = pivot").select("key", F.col("root").alias("proot")).distinct()
            met = level.join(lead_root, "key").filter("root != proot")
            compare(met.select(F.col("pivot").alias("a"), F.col("id").alias("b"), F.col("psize").alias("sa"), F.col("size").alias("sb"), F.col("pat").alias("ia"), F.col("at").alias("ib")))
            # the pivot has met all members of its list: it need not stay in it
            level = level.filter("id != pivot").select(*columns)
        here, open_lists = mixed(level)
        rest = here.join(open_lists.select("key"), "key")
        # pairs across components that a list would make, against its members
        roots = rest.groupBy("key", "root").agg(F.count("*").alias("c")).groupBy("key").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("s"))
        rest = materialize(rest.join(roots.select("key", (F.col("n") * F.col("n") - F.col("s") > 2 * LIST * F.col("n")).alias("wide")), "key"), "jac-rest")
        short = rest.filter(~F.col("wide") | (F.col("depth") >= 3))
        long = rest.filter(F.col("wide") & (F.col("depth") < 3))
        n_long = long.count()
        compare(side(short, "a").join(side(short, "b"), "key").filter((F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))), not n_long)
        settle(spark)
        if not n_long:
            break
        ids = long.groupBy("id").agg(F.collect_list(F.struct("key", "at", "last", "depth")).alias("held"), F.first("size").alias("size"), F.first("rare").alias("rare"))
        ids = materialize(ids, "jac-long")  # a document's own lists
        n_long = ids.count()
        longer = unique.join(small_side(ids.select("id"), n_long), "id", "left_semi").join(ids.select("id", "held"), "id")
        longer = longer.mapInArrow(lambda it: _split(it, n, t, boundary, hot), f"id {kind}, key array<long>, at array<int>, last array<int>, depth array<int>")
        longer = longer.select("id", F.explode(F.arrays_zip("key", "at", "last", "depth")).alias("k")).select("id", "k.*").distinct()
        level = materialize(longer.join(ids.select("id", "size", "rare"), "id").select(*columns), "jac-lists")
    own = some.join(reps.select("mark", "rep"), "mark").select("id", "rep")
    edges = links.unionByName(own.filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    final = components(edges).withColumnRenamed("node", "id")
    hot.destroy()
    per_row = marks.select("id", F.col("size").alias("n_shingles"))
    joined = per_row.join(final, "id", "left")
    return joined.select(F.col("id").alias(doc), "n_shingles", F.coalesce("root", "id").alias("component_id"))
