"""Input validation and table comparison."""

from __future__ import annotations

import codecs
import gzip
import io
import zlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import program_of_barcode
from ..sources.delimited import VARIANT_SOURCE, exact_paths, file_headers, scan_stored, text_lines
from ..sources.scratch import stored

# Columns that every variant file must have.
REQUIRED = ("chrom", "pos", "ref", "alt", "hugo_symbol", "variant_class", "consequence", "impact", "t_depth", "t_alt_count", "tumor_barcode", "normal_barcode", "case_id")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decodes each file to its end, in pieces: the type and text of the first error, if any."""
    for b in batches:
        errors = []
        for name, content in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
            try:
                text = codecs.getincrementaldecoder("utf-8")()
                source = gzip.GzipFile(fileobj=io.BytesIO(content)) if name.endswith(".gz") else io.BytesIO(content)
                while piece := source.read(1 << 20):
                    text.decode(piece)
                text.decode(b"", True)
                errors.append((None, None))
            except (OSError, EOFError, zlib.error, UnicodeDecodeError) as e:
                errors.append((type(e).__name__, str(e)[:200]))
        kinds, texts = zip(*errors, strict=True) if errors else ((), ())
        yield pa.RecordBatch.from_arrays([b.column("path"), b.column("url"), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], ["path", "url", "error_type", "error_message"])


def decoded_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, url, error_type, error_message) of every file below ``path``, each decoded to its end; the errors are null for sound files."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return raw.select("path", F.col("_metadata.file_path").alias("url"), "content").mapInArrow(_decode, "path string, url string, error_type string, error_message string")


def validate_variants(spark: SparkSession, path: str, pattern: str = "*.maf.gz", *, required: tuple[str, ...] = REQUIRED) -> dict[str, DataFrame]:
    """Reports over variant files: ``totals`` (one row), ``columns`` (presence per column), ``programs`` and ``failed``.

    ``failed`` names every file, by its full path, that cannot be decoded to its end or has no header, with the type of
    the error and its text. All other reports are over the sound files alone, which are read once more and stored.
    """
    judged = stored(decoded_files(spark, path, pattern), "decoded")
    sound = [r["path"] for r in judged.filter("error_type is null").select("path").collect()]  # paths alone
    empty = spark.createDataFrame([], "path string, source_file string, start long, at long, line string")
    lines = stored(text_lines(spark.read.format("text").load(exact_paths(sound))) if sound else empty, "lines")
    headers = stored(file_headers(lines), "headers")
    bare = judged.filter("error_type is null").join(headers.select(F.col("path").alias("url")), "url", "left_anti").withColumns({"error_type": F.lit("EmptyFile"), "error_message": F.lit("no header line")})
    failed = judged.filter("error_type is not null").unionByName(bare).select("path", F.substring_index("path", "/", -1).alias("source_file"), "error_type", "error_message")
    n_files = headers.agg(F.count("*").alias("files_ok"))
    renames = F.create_map(*[F.lit(x) for kv in VARIANT_SOURCE.items() for x in kv])
    seen = headers.select("path", F.explode("names").alias("h")).select("path", F.try_element_at(renames, F.col("h")).alias("column")).dropna().distinct()
    presence = seen.groupBy("column").agg(F.count("*").alias("n_files"))
    known = spark.createDataFrame([(c, c in required) for c in VARIANT_SOURCE.values()], "column string, required boolean")
    columns = known.join(presence, "column", "left").fillna(0, ["n_files"]).crossJoin(F.broadcast(n_files))  # one row
    columns = columns.withColumn("missing", F.col("required") & (F.col("n_files") < F.col("files_ok"))).withColumn("partial", ~F.col("required") & (F.col("n_files") > 0) & (F.col("n_files") < F.col("files_ok")))
    rows = scan_stored(lines, columns={s: n for s, n in VARIANT_SOURCE.items() if n in ("case_id", "tumor_barcode", "normal_barcode")}, types={}, headers=headers)
    totals = rows.agg(
        F.count("*").alias("rows_total"), F.count_distinct("case_id").alias("distinct_cases"), F.count_distinct("tumor_barcode").alias("distinct_tumor_barcodes"),
        F.count_distinct("normal_barcode").alias("distinct_normal_barcodes"), F.count_if(program_of_barcode(F.col("tumor_barcode")) == "unknown").alias("rows_unknown_barcode"),
    )
    totals = totals.crossJoin(n_files).crossJoin(failed.agg(F.count("*").alias("files_failed"))).withColumn("files_total", F.col("files_ok") + F.col("files_failed"))
    programs = rows.groupBy(program_of_barcode(F.col("tumor_barcode")).alias("program")).agg(F.count("*").alias("n_rows"))
    return {"totals": totals, "columns": columns, "programs": programs, "failed": failed}


def _equal(a: Column, b: Column, numeric: bool, rtol: float) -> Column:
    if not numeric:
        return a.cast("string").eqNullSafe(b.cast("string"))
    x, y = a.cast("double"), b.cast("double")
    return a.eqNullSafe(b) | F.coalesce(F.abs(x - y) <= rtol * F.greatest(F.abs(x), F.abs(y)), F.lit(False))


def table_diff(a: DataFrame, b: DataFrame, keys: list[str], *, rtol: float = 1e-9) -> DataFrame:
    """(column, n_unequal) over the union of rows by unique ``keys``; nulls are equal, numbers within a relative tolerance.

    A row that only one table has counts as unequal in every column, and once under ``(row)``. Columns of one table only
    count all rows.
    """
    numeric = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    shared = [c for c in a.columns if c in b.columns and c not in keys]
    kinds = dict(a.dtypes), dict(b.dtypes)
    left = a.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in shared], F.lit(True).alias("_in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in shared], F.lit(True).alias("_in_b"))
    both = left.join(right, keys, "full")
    single = F.col("_in_a").isNull() | F.col("_in_b").isNull()
    counts = [F.count_if(single).alias("(row)")]
    for c in shared:
        is_number = (kinds[0][c] in numeric or kinds[0][c].startswith("decimal")) and (kinds[1][c] in numeric or kinds[1][c].startswith("decimal"))
        counts.append(F.count_if(single | ~_equal(F.col(f"_a_{c}"), F.col(f"_b_{c}"), is_number, rtol)).alias(c))
    counts += [F.count("*").alias(c) for c in sorted(set(a.columns) ^ set(b.columns))]
    one = both.agg(*counts)
    return one.unpivot([], one.columns, "column", "n_unequal")


def same_shape(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: row counts and whether column names agree."""
    n = [df.agg(F.count("*").alias(f"n_{k}")) for k, df in (("a", a), ("b", b))]
    return n[0].crossJoin(n[1]).withColumn("same_columns", F.lit(a.columns == b.columns)).withColumn("same_rows", F.col("n_a") == F.col("n_b"))


def union_aligned(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; columns that a frame lacks are null."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), frames)

