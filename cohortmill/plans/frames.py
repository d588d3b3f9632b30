"""The star-schema tables in the roles of the cohort operators: entities, facts, units, catalogue hits, selections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import scratch, stored
from ..sources.tables import listing, qualified


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def entities(spark: SparkSession, d: str) -> DataFrame:
    """Customers with their region as group."""
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("submitter_id"), F.col("r_name").alias("lineage"), "n_name", "c_name", "c_mktsegment", "c_acctbal"
    )


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Line items in the role of variants: customer, order as unit, quantity as depth, brand as feature."""
    items = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return items.join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("o_custkey").alias("submitter_id"), F.col("o_orderkey").alias("tumor_barcode"), F.col("o_orderpriority").alias("normal_barcode"),
        F.col("o_orderstatus").alias("normal_source"), F.col("l_quantity").alias("t_depth"), F.col("p_brand").alias("hugo_symbol"), F.col("l_partkey").alias("chrom"),
        F.col("l_suppkey").alias("pos"), F.col("p_type").alias("ref"), F.col("l_returnflag").alias("alt"), F.col("p_name").alias("hgvsp_short"), F.col("l_returnflag").alias("variant_class"),
        F.col("l_linestatus").alias("consequence"), F.col("l_linestatus").alias("impact"), F.nullif(F.col("l_discount"), F.lit(0.0)).alias("gnomad_af"),
        (F.col("l_tax") <= 0.05).alias("primary_aliquot"), (F.col("l_returnflag") != "N").alias("is_coding"), (F.col("l_linestatus") == "F").alias("is_high_impact"),
        (F.nullif(F.col("l_discount"), F.lit(0.0)).isNull() | (F.col("l_discount") < 0.05)).alias("is_rare"),
    )


#: The same as SQL.
FACTS = """f AS (SELECT o_custkey AS submitter_id, o_orderkey AS tumor_barcode, o_orderpriority AS normal_barcode, o_orderstatus AS normal_source, l_quantity AS t_depth,
  p_brand AS hugo_symbol, l_partkey AS chrom, l_suppkey AS pos, p_type AS ref, l_returnflag AS alt, p_name AS hgvsp_short, l_returnflag AS variant_class, l_linestatus AS consequence,
  l_linestatus AS impact, nullif(l_discount, 0.0) AS gnomad_af, l_tax <= 0.05 AS primary_aliquot, l_returnflag <> 'N' AS is_coding, l_linestatus = 'F' AS is_high_impact,
  (nullif(l_discount, 0.0) IS NULL OR l_discount < 0.05) AS is_rare
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
ENTITIES = """e AS (SELECT c_custkey AS submitter_id, r_name AS lineage, n_name, c_name, c_mktsegment, c_acctbal
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def hits(spark: SparkSession, d: str) -> DataFrame:
    """Orders as catalogue files with nested customers; every tenth order belongs to two customers."""
    keys = F.when(F.col("o_orderkey") % 10 == 0, F.array(F.col("o_custkey"), F.col("o_custkey") + 1)).otherwise(F.array(F.col("o_custkey")))
    pairs = table(spark, d, "orders").select("*", F.explode(keys).alias("submitter_id")).join(entities(spark, d), "submitter_id")
    sample = F.struct(F.concat(F.lit("s"), F.col("submitter_id")).alias("sample_id"), F.col("c_name").alias("submitter_id"), F.col("c_mktsegment").alias("sample_type"), F.col("lineage").alias("tissue_type"))
    case = F.struct(
        F.concat(F.lit("c"), F.col("submitter_id")).alias("case_id"), F.col("c_name").alias("submitter_id"), F.struct(F.col("n_name").alias("project_id")).alias("project"), F.array(sample).alias("samples")
    )
    return pairs.groupBy("o_orderkey").agg(
        F.first("o_orderpriority").alias("data_category"), F.first("o_orderstatus").alias("data_type"), F.first("o_totalprice").alias("p"), F.array_sort(F.collect_list(case)).alias("cases")
    ).select(
        F.col("o_orderkey").cast("string").alias("file_id"), F.concat(F.lit("file-"), F.col("o_orderkey"), F.lit(".tsv")).alias("file_name"), "data_category", "data_type",
        F.lit("TSV").alias("data_format"), F.lit(None).cast("string").alias("experimental_strategy"), F.lit("open").alias("access"), F.floor("p").alias("file_size"),
        F.md5(F.col("o_orderkey").cast("string")).alias("md5sum"), F.lit(None).cast("string").alias("platform"), F.struct(F.col("data_type").alias("workflow_type")).alias("analysis"), "cases",
    )


HITS = """h AS (SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS file_id, o_orderpriority AS data_category, o_orderstatus AS data_type, CAST(floor(o_totalprice) AS BIGINT) AS file_size,
  'c' || c_custkey AS case_id, c_name, n_name, c_mktsegment, r_name FROM orders JOIN customer ON c_custkey = o_custkey OR (o_orderkey % 10 = 0 AND c_custkey = o_custkey + 1)
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

#: Price above which an order makes its customer part of the selection of its status.
ABOVE = {"F": 300_000.0, "O": 250_000.0, "P": 350_000.0}


def selection_hits(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    every = hits(spark, d)
    return {s: every.filter((F.col("data_type") == s) & (F.col("file_size") > p)) for s, p in ABOVE.items()}


def selections(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    orders = table(spark, d, "orders").join(entities(spark, d), F.col("o_custkey") == F.col("submitter_id"))
    orders = orders.select(F.col("o_custkey").alias("case_id"), F.col("c_name").alias("submitter_id"), F.col("n_name").alias("project_id"), "o_orderstatus", "o_totalprice")
    return {s: orders.filter((F.col("o_orderstatus") == s) & (F.col("o_totalprice") > p)).drop("o_orderstatus", "o_totalprice").repartition("case_id").distinct() for s, p in ABOVE.items()}


SELECTIONS = "s AS (SELECT DISTINCT o_custkey AS case_id, c_name AS submitter_id, n_name AS project_id, o_orderstatus AS sel FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey WHERE " + " OR ".join(
    f"(o_orderstatus = '{s}' AND o_totalprice > {p})" for s, p in ABOVE.items()
) + ")"


def measures(spark: SparkSession, d: str) -> DataFrame:
    """(submitter_id, brand, quantity): long measurements of customers."""
    return facts(spark, d).select("submitter_id", F.col("hugo_symbol").alias("brand"), F.col("t_depth").alias("quantity"))


def rename_files(spark: SparkSession, folder: str, prefix: str, suffix: str, target: str | None = None) -> None:
    """Gives the part files of a folder plain names, ``<target or folder>/<prefix><k><suffix>``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(conf)
    fs.mkdirs(path(target or folder))
    parts = sorted(f.getPath().getName() for f in fs.listStatus(path(folder)) if f.getPath().getName().startswith("part-"))
    for k, name in enumerate(parts):
        fs.rename(path(f"{folder}/{name}"), path(f"{target or folder}/{prefix}{k}{suffix}"))


def write_tsv(df: DataFrame, folder: str, **options: str) -> None:
    df.write.options(**{"sep": "\t", "header": "true", "maxRecordsPerFile": "20000"} | options).csv(folder)


def damaged_file(spark: SparkSession, folder: str, name: str) -> None:
    """A file that claims to be gzip and is not."""
    spark.range(1).coalesce(1).select(F.lit("NOT GZIP DATA")).write.text(f"{folder}/bad")
    rename_files(spark, f"{folder}/bad", name.split(".")[0][:-1], "." + name.split(".", 1)[1])


def delimited_files(spark: SparkSession, d: str) -> str:
    """Line items as gzipped tab-separated files in two column orders; a dot stands for a zero discount, one line is a comment."""
    root = scratch(spark, "files")
    items = table(spark, d, "lineitem")
    zero = F.when(F.col("l_discount") == 0, F.lit(".")).otherwise(F.col("l_discount").cast("string"))
    columns = {
        "Chromosome": F.col("l_partkey"), "Start_Position": F.col("l_suppkey"), "t_depth": F.col("l_quantity").cast("long"), "gnomAD_AF": zero,
        "Hugo_Symbol": F.col("l_returnflag"), "case_id": F.col("l_orderkey"), "Tumor_Sample_Barcode": F.concat(F.col("l_linestatus"), F.lit("-"), F.col("l_linenumber")),
    }
    for part, names in enumerate((list(columns), list(columns)[::-1])):
        rows = items.filter(F.col("l_orderkey") % 2 == part).select(*[columns[n].cast("string").alias(n) for n in names])
        note = spark.range(1).select(*[F.lit("#a-comment" if k == 0 else "-").alias(n) for k, n in enumerate(names)])
        write_tsv(rows.unionByName(note), f"{root}/order{part}", comment="~", compression="gzip")
        rename_files(spark, f"{root}/order{part}", "ab"[part], ".csv.gz")
    return root


MANIFEST = ("local_path", "case_id", "file_id", "file_name", "data_category", "data_type", "experimental_strategy", "status")


def manifest_of(spark: SparkSession, root: str, kinds: dict[str, tuple]) -> DataFrame:
    """The manifest of all files below ``root``; the first folder of a path tells what its files hold."""
    base = len(qualified(spark, root)) + 2
    files = listing(spark, root).select(F.expr(f"substring(path, {base})").alias("local_path"))
    known = spark.createDataFrame([(k, *v) for k, v in kinds.items()], "folder string, case_id string, data_category string, data_type string, experimental_strategy string, status string")
    rows = files.withColumn("folder", F.substring_index("local_path", "/", 1)).join(F.broadcast(known), "folder")  # a row per kind
    return stored(rows.withColumns({"file_id": F.col("local_path"), "file_name": F.substring_index("local_path", "/", -1)}).select(*MANIFEST), "manifest")


RNA = ("Transcriptome Profiling", "Gene Expression Quantification", "RNA-Seq")


def assay_files(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """Line items as gene expression files of two cases, with unlike headers, and the manifest that lists them.

    Paths of one case end like those of the other; beside them lie a damaged file that no row lists and one that is listed as missing.
    """
    root, item = scratch(spark, "assays"), table(spark, d, "lineitem")
    for k, (gene, reads, tpm) in enumerate((("gene_id", "Unstranded", "TPM (unstranded)"), ("Gene-ID", "unstranded", "tpm.unstranded"))):
        rows = item.filter(F.col("l_orderkey") % 2 == k).select(F.concat(F.lit("ENSG"), F.col("l_partkey")).alias(gene), F.col("l_quantity").cast("string").alias(reads), F.col("l_discount").cast("string").alias(tpm))
        rows = rows.repartition(4).unionByName(spark.range(1).select(F.lit("N_unmapped").alias(gene), F.lit("1").alias(reads), F.lit("NA").alias(tpm))).select(*[f"`{c}`" for c in ((gene, reads, tpm) if k else (tpm, gene, reads))])
        write_tsv(rows, f"{root}/made{k}")
        rename_files(spark, f"{root}/made{k}", "f", " [x].tsv", f"{root}/deep/case" if k else f"{root}/case")
    damaged_file(spark, f"{root}/case", "f0.tsv.gz")
    damaged_file(spark, f"{root}/gone", "f0.tsv.gz")
    listed = manifest_of(spark, root, {"case": ("c0", *RNA, "ok"), "deep": ("c1", *RNA, "ok"), "gone": ("c2", *RNA, "missing")})
    return root, listed.filter("local_path not like '%/bad/%' or status = 'missing'")


#: Folder -> (names of the columns in the file, what they hold) of an assay file; none has names where the file has no header.
OMICS = {
    "rna": ("c0", *RNA), "mirna": ("c1", "Transcriptome Profiling", "miRNA Expression Quantification", "miRNA-Seq"), "methylation": ("c2", "DNA Methylation", "Methylation Beta Value", None),
    "segments": ("c3", "Copy Number Variation", "Masked Copy Number Segment", None), "genes": ("c4", "Copy Number Variation", "Gene Level Copy Number", None),
    "protein": ("c5", "Proteome Profiling", "Protein Expression Quantification", None),
}


def omics_files(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """Line items as files of all six assays, an order in one of them by its key."""
    root, item = scratch(spark, "omics"), table(spark, d, "lineitem")
    key, amount, value, number = F.col("l_partkey").cast("string"), F.col("l_quantity").cast("long"), F.col("l_discount"), F.col("l_linenumber")
    columns = {
        "rna": {"gene_id": F.concat(F.lit("ENSG"), key), "unstranded": amount, "tpm_unstranded": value},
        "mirna": {"miRNA_ID": F.concat(F.lit("hsa-"), key), "read_count": amount, "reads_per_million_miRNA_mapped": value, "cross-mapped": F.lit("N")},
        "methylation": {"probe": F.concat(F.lit("cg"), key), "beta": value},
        "segments": {"GDC_Aliquot": F.lit("x"), "Chromosome": key, "Start": number, "End": number + 10, "Num_Probes": amount, "Segment_Mean": value},
        "genes": {"gene_id": F.concat(F.lit("ENSG"), key), "gene_name": key, "chromosome": F.lit("1"), "start": number, "end": number + 10, "copy_number": amount},
        "protein": {"AGID": F.concat(F.lit("AGID"), key), "gene_symbol": F.lit("."), "peptide_target": key, "protein_expression": value},
    }
    for k, (folder, made) in enumerate(columns.items()):
        rows = item.filter(F.col("l_orderkey") % 6 == k).select(*[v.cast("string").alias(n) for n, v in made.items()])
        write_tsv(rows, f"{root}/{folder}", header=str(folder != "methylation").lower())
        rename_files(spark, f"{root}/{folder}", "f", ".tsv")
    return root, manifest_of(spark, root, {k: (*v, "ok") for k, v in OMICS.items()})
