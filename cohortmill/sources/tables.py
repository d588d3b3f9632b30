"""Parquet and JSON tables, value lists, digests, listings and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .delimited import near
from .scratch import scratch, stored


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system that Spark knows."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_required(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path) if exists(spark, path) else None


class Cohort:
    """A directory of named parquet tables (files or folders), each opened when asked for."""

    TABLES = (
        "manifest", "clinical", "variants", "variant_summary", "samples", "gene_frequency", "variant_frequency", "rna_expression", "mirna_expression",
        "methylation_beta", "copy_number_segments", "gene_copy_number", "protein_expression",
    )

    def __init__(self, spark: SparkSession, path: str):
        if not exists(spark, path):
            raise FileNotFoundError(path)
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return read_required(self.spark, f"{self.path}/{name}.parquet")

    def optional(self, name: str) -> DataFrame | None:
        return read_optional(self.spark, f"{self.path}/{name}.parquet")

    def matrix(self, modality: str) -> DataFrame:
        return read_required(self.spark, f"{self.path}/dataset/matrix/{modality}.parquet")

    def summary(self) -> DataFrame:
        return row_counts(self.spark, {t: self.optional(t) for t in self.TABLES})


def row_counts(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table, n_rows); zero for tables that are missing."""
    missing = spark.createDataFrame([(t, 0) for t, df in tables.items() if df is None], "table string, n_rows long")
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table"), "n_rows") for t, df in tables.items() if df is not None], missing)


def write_table(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    """Parquet sink with a fixed schema; an empty frame writes an empty table that still carries it."""
    if schema is not None:
        have = set(df.columns)
        df = df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
    df.write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def write_transfer_list(hits: DataFrame, path: str) -> None:
    """Tab-separated list of files: id, filename, md5, size, state."""
    rows = hits.select(F.col("file_id").alias("id"), F.col("file_name").alias("filename"), F.col("md5sum").alias("md5"), F.col("file_size").alias("size"), F.lit("validated").alias("state"))
    rows.write.mode("overwrite").option("sep", "\t").option("header", "true").csv(path)


def value_list(spark: SparkSession, inline: list[str] | None = None, path: str | None = None) -> DataFrame | None:
    """Distinct trimmed values (column ``value``) given inline or a line each in a file, blanks and comments dropped; None if there are none."""
    parts = []
    if inline:
        parts.append(spark.createDataFrame([(str(v),) for v in inline], "value string"))
    if path:
        parts.append(spark.read.text(path).select("value"))
    if not parts:
        return None
    rows = reduce(DataFrame.unionByName, parts).select(F.trim("value").alias("value")).filter("value != '' and value not like '#%'").distinct()
    return None if rows.isEmpty() else rows


def keep_listed(df: DataFrame, column: str, allowed: DataFrame | None) -> DataFrame:
    """Rows whose value is listed. A list is counted: a short one goes to the rows, which are then not shuffled by a value that many share."""
    return df if allowed is None else df.join(near(allowed.withColumnRenamed("value", column)), column, "left_semi")


def keep_identifiers(df: DataFrame, allowed: DataFrame | None, *, identifier: str = "gene_id", name: str = "gene_name") -> DataFrame:
    """Rows whose identifier, unversioned identifier or name is listed."""
    if allowed is None:
        return df
    allowed = near(allowed)
    marks = [allowed.select(F.col("value").alias(f"_k{k}"), F.lit(True).alias(f"_m{k}")) for k in range(3)]
    keys = (F.col(identifier), F.substring_index(identifier, ".", 1), F.col(name))
    out = df.withColumns({f"_k{k}": x for k, x in enumerate(keys)})
    for k, m in enumerate(marks):  # three equality joins rather than one with alternatives, which could not hash
        out = out.join(m, f"_k{k}", "left")
    return out.filter(F.coalesce("_m0", "_m1", "_m2").isNotNull()).select(*df.columns)


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as listings show it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(where).toString()


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, url, length) of the files below a folder; ``url`` is the path as rows read from the file bear it. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("_metadata.file_path").alias("url"), "length")


SNAPSHOT = "path string, sha256 string, n_values long, snapshot string"


def snapshot_inputs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, sha256, n_values, snapshot) of input files, taken now: later edits of a file change nothing.

    Each file is streamed into a copy in the scratch folder; digest and values come from the copy, so they belong together.
    ``n_values`` counts lines that are neither blank nor comments, without repeats. A missing file raises.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for path in paths:  # a few option files; bytes go from stream to stream
        if not exists(spark, path):
            raise FileNotFoundError(path)
        copy = scratch(spark, "input")
        source, target = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(copy)
        jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
        stream = target.getFileSystem(conf).open(target)
        try:
            digest = jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()
        values = value_list(spark, None, copy)
        rows.append((qualified(spark, path), digest, 0 if values is None else values.count(), copy))
    return spark.createDataFrame(rows, SNAPSHOT)


#: Options that name a file of values: (option of the recipe, inline key, file key).
PANEL_OPTIONS = (("variants", "genes", "genes_file"), ("rna_expression", "genes", "genes_file"), ("rna", "genes", "genes_file"), ("methylation_beta", "probes", "probes_file"), ("methylation", "probes", "probes_file"))


def snapshot_options(spark: SparkSession, options: dict[str, dict]) -> tuple[dict[str, dict], DataFrame]:
    """Options whose files of values point at snapshots, and the snapshots' digests: what a recipe runs with is fixed before it starts."""
    fixed = {k: dict(v) if isinstance(v, dict) else v for k, v in options.items()}
    found = [(recipe, key) for recipe, _, key in PANEL_OPTIONS if isinstance(fixed.get(recipe), dict) and fixed[recipe].get(key)]
    taken = snapshot_inputs(spark, [fixed[r][k] for r, k in found])
    for (recipe, key), row in zip(found, taken.collect(), strict=True):  # as many rows as option files
        fixed[recipe][key] = row["snapshot"]
    return fixed, taken


def ontology_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(code, name, main_type, tissue) of a JSON tree whose nodes hold their children in a map by code, of any depth.

    One step a level, until a level has no nodes. A code that several nodes bear keeps the attributes of the highest level,
    the least of them where that level has several; children are followed wherever they are, below nodes without a code too.
    """
    schema = "code string, name string, mainType string, tissue string, children map<string,string>"
    text = spark.read.text(path, wholetext=True)
    level = text.select(F.explode(F.from_json("value", "map<string,string>")).alias("_k", "v"))
    found = spark.createDataFrame([], "depth int, code string, name string, main_type string, tissue string")
    depth = 0
    while True:
        nodes = level.select(F.from_json("v", schema).alias("n")).select(F.lit(depth).alias("depth"), "n.code", "n.name", F.col("n.mainType").alias("main_type"), "n.tissue", "n.children")
        nodes = stored(nodes.filter("children is not null or code is not null"), "ontology-level")
        if nodes.isEmpty():
            break
        found = found.unionByName(nodes.drop("children"))
        level, depth = nodes.select(F.explode("children").alias("_k", "v")), depth + 1
    least = found.filter("code is not null").groupBy("code").agg(F.min(F.struct("depth", "name", "main_type", "tissue")).alias("n"))
    return least.select("code", "n.name", "n.main_type", "n.tissue")
