"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item window (10 consecutive item words; a shorter item is one window) is a set of positioned three-word shingles.
For exact containment one necessary prefix shingle is enough, so every window is looked up by its rarest shingle alone:

1. look the benchmark's shingles up in all documents, once, and keep their positions;
2. count them, order each window's shingles by that count and keep the rarest, with its offset; a shingle that never
   occurs drops the window;
3. join the positions with the prefixes; the offset gives the window's start, and length and position bounds apply;
4. verify the words of each candidate window against the document itself (by their SHA-256), and merge the covered spans.

Only positions, starts and ids are shuffled, and of texts only those with candidates. Sides are broadcast only when their
counted rows stay below ``BROADCAST_ROWS``; beyond it Spark shuffles the join, which AQE can split for hot shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, carried, materialize, named, restored, small_side

#: Everything that separates words, in lower-cased text: ASCII other than digits and a-z.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def _shingle(array: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(array, at + k) for k in range(size)])


def _all_shingles(array: Column, sizes: list[int]) -> Column:
    """Structs (size, position, hash) of all shingles of the given sizes."""

    def of(n: int) -> Column:
        each = lambda i: F.struct(F.lit(n).alias("k"), i.alias("pos"), _shingle(array, i, n).alias("sh"))
        none = F.array().cast("array<struct<k:int,pos:int,sh:bigint>>")
        return F.when(F.size(array) >= n, F.transform(F.sequence(F.lit(0), F.size(array) - n), each)).otherwise(none)

    return of(sizes[0]) if len(sizes) == 1 else F.concat(*map(of, sizes))


def windows_of(items: DataFrame, *, item: str, text: str, window: int) -> DataFrame:
    """Distinct pairs of a window (``wid``: SHA-256 of its words, and ``ws``: the words) and an item (``item``, as text)."""
    split = items.select(named(item).cast("string").alias("item"), words(named(text)).alias("_w")).filter(F.size("_w") > 0)
    size = F.least(F.size("_w"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("_w") - size)
    # not slice(), which copies the whole array each time
    each = split.select("item", F.explode(F.transform(starts, lambda i: F.array_compact(F.array(*[F.get(F.col("_w"), i + k) for k in range(window)])))).alias("ws"))
    return each.withColumn("wid", _digest(F.col("ws"))).distinct()


def _digest(array: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(array, " "), 256))


RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def hits_of(docs: DataFrame, items: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = 10, shingle: int = 3) -> DataFrame:
    """For the texts with hits: ``_row`` (a column of ``docs``), ``n_hit``, ``n_items`` and ``items_sha256``."""
    pairs = materialize(windows_of(items, item=item, text=item_text, window=window), "bench-windows")
    size = lambda: F.least(F.size("ws"), F.lit(shingle))
    lengths = sorted(r[0] for r in pairs.select(size()).distinct().collect()) or [shingle]  # at most `shingle` values
    inner = pairs.select("wid", "ws").distinct().withColumn("_s", _all_shingles(F.col("ws"), lengths))
    inner = inner.select("wid", F.size("ws").alias("len"), F.explode(F.filter("_s", lambda s: s["k"] == size())).alias("s"))
    inner = materialize(inner.select("wid", "len", "s.k", F.col("s.pos").alias("offset"), "s.sh"), "bench-shingles")
    known = inner.select("k", "sh").distinct()
    body = docs.filter(named(text).isNotNull()).select("_row", words(named(text)).alias("_w"))
    # the length is taken first: explode would copy the words beside every shingle if they were still needed
    each = body.select("_row", "_w", F.size("_w").alias("_n")).select("_row", "_n", F.explode(_all_shingles(F.col("_w"), lengths)).alias("s"))
    places = each.select("_row", "_n", "s.k", "s.pos", "s.sh").join(small_side(known, inner.count()), ["k", "sh"])
    places = materialize(places, "bench-places")
    rarity = places.groupBy("k", "sh").agg(F.count("*").alias("df"))
    # a window with a shingle that occurs nowhere cannot occur: its rarest shingle then has no count, and nothing joins
    ranked = inner.join(rarity, ["k", "sh"], "left").withColumn("df", F.coalesce("df", F.lit(0)))
    prefix = ranked.groupBy("wid").agg(F.min(F.struct("df", "sh", "offset", "len", "k")).alias("p")).filter("p.df > 0")
    prefix = materialize(prefix.select("wid", "p.sh", "p.offset", "p.len", "p.k"), "bench-prefixes")
    start = F.col("pos") - F.col("offset")
    found = places.join(small_side(prefix, prefix.count()), ["k", "sh"]).filter((start >= 0) & (start + F.col("len") <= F.col("_n")))
    found = materialize(found.select("_row", start.alias("start"), "len", "wid").distinct(), "bench-candidates")
    per_row = materialize(found.groupBy("_row").agg(F.collect_list(F.struct("start", "len", "wid")).alias("_c")), "bench-starts")
    ids = per_row.select("_row")
    met = body.join(small_side(ids, ids.count()), "_row", "left_semi").dropDuplicates(["_row"]).join(per_row, "_row")
    inside = lambda c: F.array(*[F.when(c["len"] > k, F.get(F.col("_w"), c["start"] + k)) for k in range(window)])
    real = F.filter("_c", lambda c: _digest(inside(c)) == c["wid"])  # array_join leaves nulls out
    met = met.select("_row", real.alias("_c")).filter(F.size("_c") > 0)
    spans = F.sort_array(F.transform("_c", lambda c: F.struct(c["start"].alias("a"), (c["start"] + c["len"]).alias("b"))))
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    merge = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["b"]).alias("end"), (acc["n"] + F.greatest(s["b"] - F.greatest(s["a"], acc["end"]), F.lit(0))).alias("n")
    )
    met = met.select("_row", F.aggregate(spans, empty, merge, lambda acc: acc["n"]).alias("n_hit"), F.array_distinct(F.transform("_c", lambda c: c["wid"])).alias("_wids"))
    met = materialize(met, "bench-hits")
    named_items = met.select("_row", F.explode("_wids").alias("wid")).join(pairs.select("wid", "item").filter("item is not null"), "wid")
    listed = named_items.select("_row", "item").distinct().groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("_i"))
    listed = listed.select("_row", F.size("_i").cast("long").alias("n_items"), F.sha2(F.array_join("_i", ","), 256).alias("items_sha256"))
    return met.select("_row", "n_hit").join(listed, "_row", "left")


def row_key(doc: Column, text: Column) -> Column:
    """Id and content of a row: tells apart rows that share an id. Structs compare null fields as equal."""
    return F.struct(doc.alias("id"), F.xxhash64(text).alias("content"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    shingle: int = 3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: id, ``keep`` columns, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    ``n_hit`` counts document words inside any occurrence of an item window. Null or wordless texts have no words and no
    hits; null or wordless items match nothing; empty tables give clean documents or no rows. Rows with the same id are
    judged as separate texts, repeated rows alike. A null item id counts as no item, though its windows still mark words.
    A kept column named like a result gives way to the result.
    """
    whole = (doc, *(c for c in keep if c != doc))
    rows = carried(docs, whole, _row=row_key(named(doc), named(text)), _text=named(text))
    hits = materialize(hits_of(rows.select("_row", F.col("_text").alias("text")), items, item=item, item_text=item_text, window=window, shingle=shingle), "bench-verdicts")
    counted = rows.withColumn("n_words", F.size(words(F.col("_text"))).cast("long")).drop("_text")
    out = counted.join(small_side(hits, hits.count()), "_row", "left")
    out = out.withColumns(
        {"n_hit": F.coalesce("n_hit", F.lit(0).cast("long")), "n_items": F.coalesce("n_items", F.lit(0).cast("long")), "items_sha256": F.coalesce("items_sha256", F.sha2(F.lit(""), 256))}
    )
    return restored(out.withColumn("contaminated", F.col("n_hit") > 0), whole, RESULTS)
