"""Entity-aligned feature matrices: support, naming, long to wide, splits and the dataset's index tables."""

from __future__ import annotations

import hashlib
import random
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import feature_slug, lenient_double, log1p_or_null
from ..sources.scratch import stored

# Feature and value column of each modality, and the transform of its values.
MODALITIES = {
    "snv": ("hugo_symbol", None, "binary"),
    "rna_expression": ("gene_id", "unstranded", "log1p"),
    "methylation_beta": ("probe_id", "beta_value", "none"),
    "gene_copy_number": ("gene_name", "copy_number", "none"),
    "mirna_expression": ("mirna_id", "reads_per_million_mirna_mapped", "log1p"),
    "protein_expression": ("protein_id", "expression_value", "none"),
}
#: A wide table holds at most this many features; more are dealt to blocks of columns, a table each.
WIDE_LIMIT = 2000


@dataclass(frozen=True)
class DatasetOptions:
    label: str = "oncotree_tissue"
    entity: str = "submitter_id"
    modalities: tuple[str, ...] = tuple(MODALITIES)
    fractions: tuple[float, float, float] = (0.70, 0.15, 0.15)
    min_class: int = 2
    min_support: int = 1
    max_features: int | None = None
    seed: int = 13
    block: int = WIDE_LIMIT  # features of a wide table; a modality with more gets a table per block
    exact_split: bool = False  # membership of splits by the seeded shuffle instead of a seeded hash
    allow_empty: bool = False  # no label with ``min_class`` rows gives empty tables instead of an error

    def __post_init__(self):
        unknown = sorted(set(self.modalities) - set(MODALITIES))
        if unknown:
            raise ValueError(f"unknown modalities: {unknown}")
        if self.min_class <= 0 or self.min_support <= 0 or self.block <= 0 or (self.max_features is not None and self.max_features <= 0):
            raise ValueError("min_class, min_support, block and max_features must be positive")
        if min(self.fractions) < 0 or abs(sum(self.fractions) - 1) > 1e-6:
            raise ValueError("fractions must be nonnegative and sum to 1")


def surviving_labels(entities: DataFrame, label: str, least: int) -> DataFrame:
    """Rows with a non-null label that at least ``least`` rows have."""
    labelled = entities.filter(F.col(label).isNotNull())
    keep = labelled.groupBy(label).agg(F.count("*").alias("_n")).filter(F.col("_n") >= least).select(label)
    return labelled.join(keep, label, "left_semi")


def mean_measures(long: DataFrame, entity: str, feature: str, value: str, transform: str = "none") -> DataFrame:
    """(entity, feature, value): mean of the transformed measures of each pair; null measures and keys are left out."""
    x = log1p_or_null(F.col(value)) if transform == "log1p" else lenient_double(F.col(value).cast("string"))
    rows = long.select(F.col(entity).alias("entity"), F.col(feature).cast("string").alias("feature"), x.alias("value")).dropna()
    return rows.groupBy("entity", "feature").agg(F.avg("value").alias("value"))


def presence(facts: DataFrame, entity: str, feature: str, *, strict: tuple[str, ...] = ("primary_aliquot", "is_coding", "is_rare")) -> DataFrame:
    """(entity, feature, value=1) of facts that pass all flags that exist; a null flag counts as false."""
    for flag in strict:
        if flag in facts.columns:
            facts = facts.filter(F.coalesce(F.col(flag), F.lit(False)))
    rows = facts.select(F.col(entity).alias("entity"), F.col(feature).cast("string").alias("feature")).dropna().dropDuplicates()
    return rows.withColumn("value", F.lit(1).cast("byte"))


def feature_support(long: DataFrame, *, least: int = 1, most: int | None = None) -> DataFrame:
    """(feature, n_samples) of features that enough entities have; the ``most`` best supported, ties by name."""
    out = long.groupBy("feature").agg(F.count_distinct("entity").alias("n_samples")).filter(F.col("n_samples") >= least)
    return out if most is None else out.orderBy(F.desc("n_samples"), "feature").limit(most)


def feature_names(support: DataFrame, modality: str) -> DataFrame:
    """Adds ``column_name``: modality and slug, with ``__2``, ``__3``, ... for slugs met again in feature order."""
    out = support.withColumn("_slug", feature_slug(F.col("feature")))
    again = F.row_number().over(Window.partitionBy("_slug").orderBy("feature"))
    name = F.concat(F.lit(f"{modality}__"), F.col("_slug"))
    return out.withColumn("column_name", F.when(again == 1, name).otherwise(F.concat(name, F.lit("__"), again.cast("string")))).drop("_slug")


def to_wide(long: DataFrame, entities: DataFrame, names: DataFrame, entity: str, *, fill: float | None = None, limit: int = WIDE_LIMIT) -> DataFrame:
    """One row per entity of ``entities`` and a column per feature, in feature order; only a bounded list of names is collected."""
    columns = [(r["feature"], r["column_name"]) for r in names.orderBy("feature").select("feature", "column_name").limit(limit + 1).collect()]
    if len(columns) > limit:
        raise ValueError(f"more than {limit} features: use to_blocks, or to_arrays")
    ids = entities.select(F.col(entity).alias("entity"))
    used = long.join(ids.distinct(), "entity", "left_semi").join(names.select("feature", "column_name"), "feature")
    wide = used.groupBy("entity").pivot("column_name", [c for _, c in columns]).agg(F.avg("value"))
    out = ids.join(wide, "entity", "left").withColumnRenamed("entity", entity)
    return out if fill is None else out.fillna(fill)


def feature_blocks(names: DataFrame, size: int) -> DataFrame:
    """``names`` with ``position`` (from 0, in feature order) and ``block``, of ``size`` features each; stored.

    Positions come from a range partitioning by feature and the partitions' counts, so no task sees all features.
    """
    placed = stored(names.repartitionByRange(F.col("feature")).sortWithinPartitions("feature").withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "features")
    parts = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per partition
    starts = parts.select("_part", "_first", before.alias("_before"))
    out = placed.join(F.broadcast(starts), "_part").withColumn("position", F.col("_at") - F.col("_first") + F.col("_before"))
    return stored(out.withColumn("block", F.floor(F.col("position") / size).cast("int")).drop("_part", "_at", "_first", "_before"), "feature-blocks")


def to_blocks(long: DataFrame, entities: DataFrame, names: DataFrame, entity: str, *, fill: float | None = None, size: int = WIDE_LIMIT) -> tuple[list[DataFrame], DataFrame]:
    """Wide tables of at most ``size`` features each, all with one row per entity, and ``names`` with each feature's ``block``.

    The measures are stored once by block, so a block's table reads its own alone; the driver sees the names of one block
    at a time. Few enough features make one table. Every table is a plan of up to ``size`` columns in the driver, so many
    blocks are for ``to_packed_blocks``.
    """
    index = feature_blocks(names, size)
    n = index.agg(F.coalesce(F.max("block"), F.lit(0)) + 1).first()[0]
    ids = entities.select(F.col(entity).alias("entity")).distinct()
    used = long.join(ids, "entity", "left_semi").join(index.select("feature", "block"), "feature")
    dealt = stored(used.select("entity", "feature", "value", "block"), "measures", partition="block")
    return [to_wide(dealt.filter(F.col("block") == b).drop("block"), entities, index.filter(F.col("block") == b), entity, fill=fill, limit=size) for b in range(n)], index


def to_packed_blocks(long: DataFrame, entities: DataFrame, names: DataFrame, entity: str, *, size: int = WIDE_LIMIT) -> tuple[DataFrame, DataFrame]:
    """All blocks of a matrix as one table, for any number of features: (entity, block, cells), and ``names`` with each feature's ``block`` and ``slot``.

    ``cells`` is a row of the block's wide table by its filled columns: (slot, value) pairs in feature order. One plan makes
    all blocks, no name passes through the driver, and the work grows with the filled cells, not with entities times features.
    """
    index = feature_blocks(names, size).withColumn("slot", (F.col("position") % size).cast("int"))
    ids = entities.select(F.col(entity).alias("entity")).distinct()
    used = long.join(ids, "entity", "left_semi").join(index.select("feature", "block", "slot"), "feature")
    cells = used.groupBy("entity", "block", "slot").agg(F.avg("value").alias("value"))
    rows = cells.groupBy("entity", "block").agg(F.array_sort(F.collect_list(F.struct("slot", "value"))).alias("cells"))
    return rows.withColumnRenamed("entity", entity), index


def to_arrays(long: DataFrame, entities: DataFrame, names: DataFrame, entity: str, *, fill: float | None = None) -> DataFrame:
    """One row per entity with its features as (position, value) pairs in feature order: the form for many features."""
    position = names.withColumn("position", F.row_number().over(Window.orderBy("feature")) - 1)  # as many rows as features
    ids = entities.select(F.col(entity).alias("entity"))
    used = long.join(ids.distinct(), "entity", "left_semi").join(position.select("feature", "position"), "feature")
    packed = used.groupBy("entity").agg(F.array_sort(F.collect_list(F.struct("position", F.col("value").cast("double").alias("value")))).alias("features"))
    return ids.join(packed, "entity", "left").withColumnRenamed("entity", entity)


def split_sizes(n: Column, val: float, test: float) -> tuple[Column, Column]:
    """(validation, test) sizes of a label with ``n`` entities; the rest trains, and training is never emptied."""
    v = F.greatest(F.lit(1), F.bround(n * val)).cast("long") if val > 0 else F.lit(0).cast("long")
    t = F.greatest(F.lit(1), F.bround(n * test)).cast("long") if test > 0 else F.lit(0).cast("long")
    # take from the larger share until one entity is left for training
    excess = F.greatest(v + t - n + 1, F.lit(0))
    gap = F.abs(v - t)
    from_larger = F.least(excess, gap)
    both = excess - from_larger
    v_cut = F.when(v >= t, from_larger).otherwise(0) + F.ceil(both / 2)
    t_cut = F.when(v >= t, 0).otherwise(from_larger) + F.floor(both / 2)
    two_v = 1 if val > 0 and not (test > 0 and test >= val) else 0
    two_t = 1 if test > 0 and test >= val else 0
    v = F.when(n == 1, 0).when(n == 2, two_v).otherwise(v - v_cut)
    t = F.when(n == 1, 0).when(n == 2, two_t).otherwise(t - t_cut)
    return v.cast("long"), t.cast("long")


def stratified_split(entities: DataFrame, label: str, entity: str, *, fractions: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 13) -> DataFrame:
    """Adds ``split``: per label, entities in the order of a seeded hash are cut into train, val and test."""
    key = F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(label).cast("string"), F.col(entity).cast("string")), 256)
    rank = F.row_number().over(Window.partitionBy(label).orderBy(key, F.col(entity)))
    sizes = entities.groupBy(label).agg(F.count("*").alias("_n"))
    v, t = split_sizes(F.col("_n"), fractions[1], fractions[2])
    sizes = sizes.select(label, (F.col("_n") - v - t).alias("_train"), v.alias("_val"))
    out = entities.withColumn("_rank", rank).join(sizes, label)
    split = F.when(F.col("_rank") <= F.col("_train"), "train").when(F.col("_rank") <= F.col("_train") + F.col("_val"), "val").otherwise("test")
    return out.withColumn("split", split).drop("_rank", "_train", "_val")


def _shuffled(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """(label, rank, place): where the seeded shuffle of a label's sorted entities puts each of them; 8 bytes an entity."""
    for b in batches:
        for code, label, n in zip(b.column("code").to_pylist(), b.column("label").to_pylist(), b.column("n").to_pylist(), strict=True):
            generator = random.Random(seed + int(hashlib.sha256(label.encode()).hexdigest()[:12], 16))
            order = array("q", range(n))
            generator.shuffle(order)
            for at in range(0, n, 100_000):
                ranks = pa.array(order[at : at + 100_000], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(ranks), pa.int64()), pc.add(ranks, 1), pa.array(range(at + 1, at + len(ranks) + 1), pa.int64())], ["_code", "_rank", "_place"])


def exact_stratified_split(entities: DataFrame, label: str, entity: str, *, fractions: tuple[float, float, float] = (0.7, 0.15, 0.15), seed: int = 13) -> DataFrame:
    """Adds ``split`` as Python's seeded shuffle of each label's sorted entities deals it (unique entities).

    The shuffle depends on a label's name and size alone, so tasks make permutations of numbers, a label at a time, and
    entities meet them by label and rank. Ranks come from a range partitioning by label and entity, so that no label's
    entities meet in one task.
    """
    placed = entities.repartitionByRange(F.col(label), F.col(entity)).sortWithinPartitions(label, entity)
    placed = stored(placed.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "split-order")
    pieces = placed.groupBy("_part", label).agg(F.count("*").alias("n"), F.min("_at").alias("_first"))
    pieces = stored(pieces, "split-pieces")  # at most partitions plus labels rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy(label).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = pieces.select("_part", label, "_first", before.alias("_before"))
    sizes = pieces.groupBy(label).agg(F.sum("n").alias("_n"))
    v, t = split_sizes(F.col("_n"), fractions[1], fractions[2])
    sizes = stored(sizes.select(label, "_n", (F.col("_n") - v - t).alias("_train"), v.alias("_val"), F.monotonically_increasing_id().alias("_code")), "split-sizes")
    one = sizes.select(F.col("_code").alias("code"), F.col(label).cast("string").alias("label"), F.col("_n").alias("n"))
    places = one.repartition("code").mapInArrow(lambda it: _shuffled(it, seed), "_code long, _rank long, _place long")
    ranked = placed.join(starts, ["_part", label]).withColumn("_rank", F.col("_at") - F.col("_first") + F.col("_before") + 1).join(sizes, label)
    split = F.when(F.col("_place") <= F.col("_train"), "train").when(F.col("_place") <= F.col("_train") + F.col("_val"), "val").otherwise("test")
    return ranked.join(places, ["_code", "_rank"]).withColumn("split", split).select(*entities.columns, "split")


def dataset(samples: DataFrame, tables: dict[str, DataFrame], options: DatasetOptions = DatasetOptions(), available: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables of a model dataset: ``samples`` (with split and ``has_*`` flags), ``matrix/<modality>`` and ``features``.

    A modality of more than ``options.block`` features has tables ``matrix/<modality>/block=<k>``, each with a row per
    sample; ``features`` names the block of every feature. Modalities without a table are skipped. Everything is checked before any table is built.
    """
    e = options.entity
    missing = sorted({e, options.label} - set(samples.columns))
    if missing:
        raise ValueError(f"samples lack columns: {missing}")
    alive = surviving_labels(samples, options.label, options.min_class)
    if not options.allow_empty and alive.isEmpty():
        raise ValueError(f"no class of {options.label!r} has {options.min_class} rows")
    deal = exact_stratified_split if options.exact_split else stratified_split
    chosen = stored(deal(alive, options.label, e, fractions=options.fractions, seed=options.seed), "dataset-samples")
    out: dict[str, DataFrame] = {}
    index, flags = [], chosen
    for m in options.modalities:
        if m not in tables:
            continue
        feature, value, transform = MODALITIES[m]
        table = tables[m]
        if m == "mirna_expression" and value not in table.columns:
            value = "read_count"
        long = presence(table, e, feature) if value is None else mean_measures(table, e, feature, value, transform)
        inside = long.join(chosen.select(F.col(e).alias("entity")), "entity", "left_semi")
        names = feature_names(feature_support(inside, least=options.min_support, most=options.max_features), m)
        tables_made, names = to_blocks(inside, chosen, names, e, fill=0 if value is None else None, size=options.block)
        out |= {f"matrix/{m}" if len(tables_made) == 1 else f"matrix/{m}/block={k}": t for k, t in enumerate(tables_made)}
        index.append(names.select(F.lit(m).alias("modality"), "block", F.col("feature").alias("feature_id"), F.col("feature").alias("feature_name"), "column_name", F.lit("value").alias("value_column"), F.lit(transform).alias("transform"), "n_samples"))
        has = (available or {}).get(m, table).select(F.col(e)).filter(F.col(e).isNotNull()).distinct().withColumn(f"has_{m}", F.lit(True))
        flags = flags.join(has, e, "left").fillna(False, [f"has_{m}"])
    out["samples"] = flags
    if index:
        out["features"] = reduce(DataFrame.unionByName, index)
    return out


def dataset_summary(tables: dict[str, DataFrame], options: DatasetOptions = DatasetOptions()) -> DataFrame:
    """(kind, key, n): rows by label and split, features and entities per modality, and skipped modalities with zero."""
    samples = tables["samples"]
    parts = [
        samples.groupBy(F.col(options.label).cast("string").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("label")),
        samples.groupBy(F.col("split").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("split")),
    ]
    if "features" in tables:
        parts.append(tables["features"].groupBy(F.col("modality").alias("key")).agg(F.count("*").alias("n")).withColumn("kind", F.lit("features")))
    for m in options.modalities:
        flag = f"has_{m}"
        n = F.count_if(F.col(flag)) if flag in samples.columns else F.lit(0).cast("long")
        parts.append(samples.agg(n.alias("n")).select(F.lit(m).alias("key"), "n", F.lit("entities" if flag in samples.columns else "skipped").alias("kind")))
    return reduce(DataFrame.unionByName, parts).select("kind", "key", "n")
