"""Scans of tab-separated files whose headers differ from file to file.

Files are read as lines by Spark's splittable text reader, so a file may be of any size, and stored once as a table of
lines. Headers are one small row per file; what each output column is called in a file becomes a cell number there, and the
body's lines meet these numbers in a join by path. Columns are bound by name, per file, so files with other column orders,
extra or missing columns can be scanned together.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import header_name, lenient_double, lenient_long
from .scratch import BROADCAST_ROWS, stored

# Tokens that stand for null in variant files, and in assay tables.
VARIANT_NULLS = ("", ".")
ASSAY_NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Source columns of variant files and their names in the variants table.
VARIANT_SOURCE = {
    "Chromosome": "chrom", "Start_Position": "pos", "End_Position": "end_pos", "Variant_Type": "variant_type", "Reference_Allele": "ref", "Tumor_Seq_Allele2": "alt",
    "Hugo_Symbol": "hugo_symbol", "Transcript_ID": "transcript_id", "EXON": "exon", "HGVSc": "hgvsc", "HGVSp_Short": "hgvsp_short",
    "Variant_Classification": "variant_class", "Consequence": "consequence", "IMPACT": "impact", "t_depth": "t_depth", "t_alt_count": "t_alt_count",
    "callers": "callers", "gnomAD_AF": "gnomad_af", "COSMIC": "cosmic_id", "SIFT": "sift", "PolyPhen": "polyphen", "CONTEXT": "context", "hotspot": "hotspot",
    "case_id": "case_id", "Tumor_Sample_Barcode": "tumor_barcode", "Matched_Norm_Sample_Barcode": "normal_barcode",
}
VARIANT_TYPES = {"pos": "long", "end_pos": "long", "t_depth": "long", "t_alt_count": "long", "gnomad_af": "double"}
CASTS = {"string": lambda x: x, "long": lenient_long, "double": lenient_double}


def exact_paths(paths: list[str]) -> list[str]:
    """Paths that stand for themselves: characters that a reader would take for a pattern are escaped."""
    return [re.sub(r"([\\*?\[\]{}])", r"\\\1", p) for p in paths]


def text_lines(raw: DataFrame) -> DataFrame:
    """(path, source_file, start, at, line) of a text source: lines that are neither empty nor comments.

    ``at`` grows within a block of a file (``start``); it is fixed once the lines are stored.
    """
    rows = raw.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"),
    )
    return rows.filter((F.col("line") != "") & ~F.col("line").startswith("#"))


def read_lines(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """The lines of all files below ``paths``, found recursively; files of any size are split between tasks unless gzip forbids it."""
    reader = spark.read.format("text").option("recursiveFileLookup", "true")
    return text_lines((reader.option("pathGlobFilter", pattern) if pattern else reader).load(paths))


def near(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored side with a broadcast hint if its counted rows are few enough."""
    return F.broadcast(df) if df.count() <= limit else df


def file_headers(lines: DataFrame, *, normalise: bool = False, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """(``by``, source_file, head, names, bare): the first line of each file of stored ``lines``, its position, and its column names.

    A repeated name is numbered (``x``, ``x.1``). Only numbers are aggregated over the lines.
    """
    blocks = lines.groupBy(*by, "start").agg(F.min("at").alias("head"))
    first = blocks.groupBy(*by).agg(F.min(F.struct("start", "head")).alias("f")).select(*by, F.col("f.head").alias("at"))
    heads = lines.join(near(stored(first, "first-lines")), [*by, "at"]).select(*by, "source_file", F.col("at").alias("head"), F.split("line", "\t").alias("_cells"))
    names = heads.withColumn("_names", F.transform("_cells", (lambda c: header_name(c)) if normalise else (lambda c: F.trim(c))))
    again = lambda x, i: F.size(F.filter(F.slice(F.col("_names"), 1, i), lambda y: y == x))
    numbered = F.transform("_names", lambda x, i: F.when(again(x, i) > 0, F.concat(x, F.lit("."), again(x, i).cast("string"))).otherwise(x))
    return names.select(*by, "source_file", "head", numbered.alias("names"), F.lit(False).alias("bare"))


def headerless(headers: DataFrame, prefix: str, names: tuple[str, ...], where: Column | None = None) -> DataFrame:
    """Files of as many columns as ``names`` whose first cell begins with ``prefix`` have no header: their first line is data."""
    bare = (F.size("names") == len(names)) & F.lower(F.get("names", F.lit(0))).startswith(prefix)
    bare = bare if where is None else bare & where
    return headers.withColumns({"names": F.when(bare, F.array(*map(F.lit, names))).otherwise(F.col("names")), "bare": bare})


def body(lines: DataFrame, files: DataFrame, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """Data lines as ``cells`` beside the columns of their file; ``files`` has ``by``, ``head`` and ``bare``, and is stored."""
    rows = lines.select(*by, "at", "line").join(near(files), [*by]).filter(F.col("bare") | (F.col("at") != F.col("head")))
    return rows.withColumn("cells", F.split("line", "\t")).drop("at", "line", "head", "bare")


def cell(position: Column, nulls: tuple[str, ...]) -> Column:
    """Text of a cell by its number (from 1), null for a null token, a short line or a null number."""
    value = F.get(F.col("cells"), position - 1)
    return F.when(~value.isin(*nulls), value)


def scan_stored(lines: DataFrame, *, columns: dict[str, str] = VARIANT_SOURCE, types: dict[str, str] = VARIANT_TYPES, nulls: tuple[str, ...] = VARIANT_NULLS, headers: DataFrame | None = None) -> DataFrame:
    """Typed rows of stored lines: the listed columns by name, renamed, absent ones null, and the source file."""
    headers = file_headers(lines) if headers is None else headers
    places = F.array(*[F.nullif(F.array_position("names", src), F.lit(0)).cast("int") for src in columns])
    files = stored(headers.select("path", "source_file", "head", "bare", places.alias("places")), "headers")
    rows = body(lines, files)
    value = lambda k, name: CASTS[types.get(name, "string")](cell(F.get("places", F.lit(k)), nulls)).alias(name)
    return rows.select(*[value(k, name) for k, name in enumerate(columns.values())], "source_file")


def variant_lines(spark: SparkSession, paths: str | list[str], pattern: str | None = "*.maf.gz") -> DataFrame:
    """The stored lines of variant files; raises if there is no file."""
    lines = read_lines(spark, paths, pattern)
    if not lines.inputFiles():
        raise FileNotFoundError(f"no {pattern} below {paths}")
    return stored(lines, "lines")


def scan_variants(spark: SparkSession, paths: str | list[str], pattern: str | None = "*.maf.gz", **options) -> DataFrame:
    """Rows of variant files: the listed columns by name, renamed and typed, absent ones null, and the source file.

    Short lines are padded, extra cells dropped. The files are read once. Raises if no file is found.
    """
    return scan_stored(variant_lines(spark, paths, pattern), **options)


def filled_columns(rows: DataFrame, n: int, nulls: tuple[str, ...], by: tuple[str, ...] = ("path",)) -> DataFrame:
    """(``by``, filled): which of the ``n`` (at most 62) columns at the cell numbers ``asked`` have a value anywhere in the file, as bits."""
    bits = " | ".join(f"if(coalesce(get(cells, get(asked, {k}) - 1) not in ({', '.join(f"'{x}'" for x in nulls)}), false), {1 << k}L, 0L)" for k in range(n))
    return rows.groupBy(*by).agg(F.expr(f"bit_or({bits})").alias("filled"))


def first_filled(rows: DataFrame, nulls: tuple[str, ...], by: tuple[str, ...] = ("path",)) -> DataFrame:
    """(``by``, first): the number of the first column of any name that has a value anywhere in the file."""
    full = F.transform("cells", lambda c: ~c.isin(*nulls))
    return rows.groupBy(*by).agg(F.min(F.nullif(F.array_position(full, True), F.lit(0))).cast("int").alias("first"))


def scan_uniform(spark: SparkSession, paths: str | list[str], pattern: str | None = None) -> DataFrame:
    """Fast path for files that share one header: Spark's own reader, splittable when not compressed with gzip."""
    reader = spark.read.option("sep", "\t").option("header", "true").option("comment", "#").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).csv(paths).withColumn("source_file", F.col("_metadata.file_name"))
