"""Assay tables: manifest-driven scans of measurement files into six long tables with shared provenance columns."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .delimited import ASSAY_NULLS, CASTS, body, cell, exact_paths, file_headers, filled_columns, first_filled, headerless, near, text_lines
from .scratch import stored
from .tables import keep_identifiers, keep_listed, listing, qualified, value_list

COMMON = (
    "case_id", "submitter_id", "project_id", "sample_id", "sample_submitter_id", "sample_type", "tissue_type", "file_id", "file_name", "data_type",
    "experimental_strategy", "workflow_type", "platform",
)

# For each output, which files feed it, and the type and accepted source names of its columns.
ROUTES = {
    "rna_expression": ("Transcriptome Profiling", ("Gene Expression Quantification",), "RNA-Seq"),
    "mirna_expression": ("Transcriptome Profiling", ("miRNA Expression Quantification",), "miRNA-Seq"),
    "methylation_beta": ("DNA Methylation", ("Methylation Beta Value",), None),
    "copy_number_segments": ("Copy Number Variation", ("Copy Number Segment", "Masked Copy Number Segment"), None),
    "gene_copy_number": ("Copy Number Variation", ("Gene Level Copy Number",), None),
    "protein_expression": ("Proteome Profiling", ("Protein Expression Quantification",), None),
}
COLUMNS = {
    "rna_expression": {
        "gene_id": ("string", "gene_id"), "gene_name": ("string", "gene_name", "gene"), "gene_type": ("string", "gene_type"), "unstranded": ("long", "unstranded"),
        "stranded_first": ("long", "stranded_first"), "stranded_second": ("long", "stranded_second"), "tpm_unstranded": ("double", "tpm_unstranded"),
        "fpkm_unstranded": ("double", "fpkm_unstranded"), "fpkm_uq_unstranded": ("double", "fpkm_uq_unstranded"),
    },
    "mirna_expression": {
        "mirna_id": ("string", "mirna_id", "mirna", "mi_rna_id"), "read_count": ("long", "read_count", "reads"),
        "reads_per_million_mirna_mapped": ("double", "reads_per_million_mirna_mapped", "reads_per_million_mi_rna_mapped", "rpm"),
        "cross_mapped": ("string", "cross_mapped", "cross_mapped_mirna"),
    },
    "methylation_beta": {"probe_id": ("string", "probe_id", "composite_element_ref", "id_ref", "name"), "beta_value": ("double", "beta_value", "beta", "value")},
    "copy_number_segments": {
        "sample": ("string", "sample", "sample_id", "sample_name"), "chrom": ("string", "chrom", "chromosome", "chr"), "start": ("long", "start", "start_position", "loc_start"),
        "end": ("long", "end", "end_position", "loc_end"), "num_probes": ("long", "num_probes", "num_mark", "num_markers", "num_marked"),
        "segment_mean": ("double", "segment_mean", "seg_mean", "segment_mean_value"),
    },
    "gene_copy_number": {
        "gene_id": ("string", "gene_id", "ensembl_gene_id"), "gene_name": ("string", "gene_name", "gene_symbol", "symbol", "gene"), "chrom": ("string", "chrom", "chromosome", "chr"),
        "start": ("long", "start", "start_position", "loc_start"), "end": ("long", "end", "end_position", "loc_end"),
        "copy_number": ("double", "copy_number", "copy_number_value", "copy_number_estimate", "value", "log2_copy_ratio"),
    },
    "protein_expression": {
        "protein_id": ("string", "protein_id", "id_ref", "protein", "agid"), "gene_symbol": ("string", "gene_symbol", "gene_name", "gene", "symbol"),
        "antibody": ("string", "antibody", "antibody_name", "peptide_target"),
        "expression_value": ("double", "expression_value", "protein_expression", "normalized_expression", "value", "rppa_value"),
    },
}
RECIPES = {
    "rna_expression": ("rna_expression",), "mirna_expression": ("mirna_expression",), "methylation": ("methylation_beta",),
    "copy_number": ("copy_number_segments", "gene_copy_number"), "protein_expression": ("protein_expression",), "multiomics": tuple(ROUTES),
}
OPTION_NAMES = {
    "rna_expression": "rna", "mirna_expression": "mirna", "methylation_beta": "methylation", "copy_number_segments": "copy_number", "gene_copy_number": "copy_number", "protein_expression": "protein",
}


def output_of(category: Column, kind: Column, strategy: Column) -> Column:
    """Name of the output that a file feeds; null if none."""
    out = F.lit(None).cast("string")
    for name, (wanted, kinds, how) in ROUTES.items():
        holds = (category == wanted) & kind.isin(*kinds)
        out = F.when(holds & (strategy == how) if how else holds, F.lit(name)).otherwise(out)
    return out


def outputs_of(recipes: list[str], options: dict[str, Any] | None = None) -> list[str]:
    """Outputs of the given recipes in table order; copy-number outputs can be narrowed by option."""
    unknown = sorted(set(recipes) - set(RECIPES))
    if unknown:
        raise ValueError(f"unknown recipes: {unknown}")
    wanted = {o for r in recipes for o in RECIPES[r]}
    narrowed = options_of(options, "copy_number_segments").get("outputs")
    return [o for o in ROUTES if o in wanted and (not narrowed or OPTION_NAMES[o] != "copy_number" or o in narrowed)]


def options_of(options: dict[str, Any] | None, output: str) -> dict[str, Any]:
    for key in (output, OPTION_NAMES[output]):
        if isinstance((options or {}).get(key), dict):
            return options[key]
    return {}


def columns_of(output: str, options: dict[str, Any] | None = None) -> list[str]:
    """Output columns: the common ones, and all others or only the requested."""
    own = [*(["cnv_type"] if output == "copy_number_segments" else []), *COLUMNS[output]]
    requested = options_of(options, output).get("columns")
    if not requested:
        return [*COMMON, *own]
    unknown = sorted(set(requested) - set(own) - set(COMMON))
    if unknown:
        raise ValueError(f"unknown {output} columns: {unknown}")
    return [*COMMON, *[c for c in own if c in requested]]


def manifest_files(manifest: DataFrame, recipes: list[str], options: dict[str, Any] | None = None) -> DataFrame:
    """Usable rows of the manifest with their ``output``; rows without a path or with another status are left out."""
    rows = manifest.filter(F.col("local_path").isNotNull())
    if "status" in manifest.columns:
        rows = rows.filter(F.col("status") == "ok")
    rows = rows.withColumn("output", output_of(F.col("data_category"), F.col("data_type"), F.col("experimental_strategy")))
    return rows.filter(F.col("output").isin(*outputs_of(recipes, options)))


def listed_files(spark: SparkSession, root: str, manifest: DataFrame, outputs: list[str]) -> DataFrame:
    """(path, name, output and common columns) of the files that the manifest lists for ``outputs`` and that exist, stored.

    ``local_path`` is the path relative to ``root``; both sides meet by equality. A file that is listed twice counts twice.
    ``path`` is as rows of the file bear it,
    ``name`` as a reader takes it. Folders are listed, no file is opened.
    """
    base = qualified(spark, root)
    there = listing(spark, root).select(F.col("url").alias("path"), F.col("path").alias("name"), F.expr(f"substring(path, {len(base) + 2})").alias("_local"))
    have = [c for c in COMMON if c in manifest.columns]
    wanted = manifest_files(manifest, list(RECIPES)).filter(F.col("output").isin(*outputs))
    wanted = wanted.select(F.regexp_replace("local_path", r"^(\./)+", "").alias("_local"), "output", *have)
    found = there.join(wanted, "_local").select("path", "name", "output", *have)
    return stored(found, "assay-files")


BY = ("path", "output")


def read_listed(spark: SparkSession, files: DataFrame, by: tuple[str, ...] = BY) -> DataFrame | None:
    """Lines of the listed files and no others, with the other columns ``by`` of ``files``; None if there are none. Paths alone go through the driver."""
    paths = [r["name"] for r in files.select("name").distinct().collect()]
    if not paths:
        return None
    lines = text_lines(spark.read.format("text").load(exact_paths(paths)))
    return lines.join(near(files.select(*by).distinct()), "path")


def stored_lines(spark: SparkSession, files: DataFrame, by: tuple[str, ...] = BY) -> DataFrame:
    """One read of every listed file: its lines, stored by output."""
    lines = read_listed(spark, files, by)
    if lines is None:
        lines = spark.createDataFrame([], "path string, source_file string, start long, at long, line string").join(files.select(*by), "path")
    return stored(lines, "assay-lines", partition="output")


#: All names that a column may have in a file, by output; their order numbers the bits of ``filled_columns``.
ASKED = {o: sorted({n for _, *names in columns.values() for n in names}) for o, columns in COLUMNS.items()}


def _by_output(outputs: list[str], make) -> Column:
    """``make(output)``, as SQL, for the row's output: one text is parsed, where thousands of column calls would take seconds."""
    return F.expr("case output " + " ".join(f"when '{o}' then {make(o)}" for o in outputs) + " end")


def resolve_files(lines: DataFrame, files: DataFrame, outputs: list[str], by: tuple[str, ...] = BY) -> DataFrame:
    """(``by``, head, bare, places and common columns) of the files of stored ``lines``: the cell number of every output column, stored.

    ``by`` is path and output, and whatever else tells the readings of a file apart. A column that has no value in a file
    counts as absent there, so the next of its names stands in. Whether it has values is looked up only where that decides
    something: in files that have several names of one column, and for the gene of an expression file.
    """
    headers = headerless(file_headers(lines, normalise=True, by=by), "cg", ("probe_id", "beta_value"), F.col("output") == "methylation_beta")
    asked = _by_output(outputs, lambda o: "array(" + ", ".join(f"cast(nullif(array_position(names, '{n}'), 0L) as int)" for n in ASKED[o]) + ")")
    headers = stored(headers.select(*by, "head", "bare", asked.alias("asked")), "assay-headers")
    unsure = body(lines, headers.filter(_by_output(outputs, _several_names)), by)
    filled = filled_columns(unsure, max(len(ASKED[o]) for o in outputs), ASSAY_NULLS, by)
    known = headers.join(filled, [*by], "left").withColumn("filled", F.coalesce("filled", F.lit(-1).cast("long")))  # all bits where the names decide

    def places(output: str) -> str:
        place = lambda n: f"if(filled & {1 << ASKED[output].index(n)}L != 0, get(asked, {ASKED[output].index(n)}), null)"
        return "array(" + ", ".join(f"coalesce({', '.join(map(place, names))})" for _, *names in COLUMNS[output].values()) + ")"

    meta = [c for c in COMMON if c in files.columns]
    found = stored(known.select(*by, "head", "bare", _by_output(outputs, places).alias("places")).join(files.select(*BY, *meta), [*BY]), "assay-places")
    lost = found.filter((F.col("output") == "rna_expression") & F.get("places", F.lit(0)).isNull())
    if lost.isEmpty():
        return found
    first = first_filled(body(lines, lost.select(*by, "head", "bare").distinct(), by), ASSAY_NULLS, by)
    others = F.slice("places", 2, len(COLUMNS["rna_expression"]))
    return stored(found.join(first, [*by], "left").withColumn("places", F.when(F.col("first").isNull(), F.col("places")).otherwise(F.concat(F.array("first"), others))).drop("first"), "assay-places")


def _several_names(output: str) -> str:
    """Whether a header has more than one name of a column, as SQL; the gene of an expression file counts as such."""
    there = lambda n: f"cast(get(asked, {ASKED[output].index(n)}) is not null as int)"
    several = [f"{' + '.join(map(there, names))} > 1" for _, *names in COLUMNS[output].values() if len(names) > 1]
    return "true" if output == "rna_expression" else " or ".join(several)


def project_assay(lines: DataFrame, resolved: DataFrame, output: str, columns: list[str], chosen: dict[str, Any], by: tuple[str, ...] = BY) -> DataFrame:
    """One long assay table of the stored ``lines`` of its ``resolved`` files: typed, filtered, with provenance."""
    spark = lines.sparkSession
    rows = body(lines.filter(F.col("output") == output), resolved.filter(F.col("output") == output), by)
    value = lambda k, kind: CASTS[kind](cell(F.get("places", F.lit(k)), ASSAY_NULLS))
    values = {c: value(k, kind) for k, (c, (kind, *_)) in enumerate(COLUMNS[output].items())}
    if output == "copy_number_segments":
        values = {"cnv_type": F.col("data_type") if "data_type" in resolved.columns else F.lit(None).cast("string")} | values
    out = rows.select(*[F.col(c) if c in resolved.columns else F.lit(None).cast("string").alias(c) for c in COMMON], *[v.alias(k) for k, v in values.items()])
    if output == "rna_expression":
        out = keep_identifiers(out.filter(F.col("gene_id").startswith("ENSG")), value_list(spark, chosen.get("genes"), chosen.get("genes_file")))
    if output == "methylation_beta":
        out = keep_listed(out, "probe_id", value_list(spark, chosen.get("probes"), chosen.get("probes_file")))
    return out.select(*columns)


def assay_tables(spark: SparkSession, root: str, manifest: DataFrame, recipes: list[str], options: dict[str, Any] | None = None) -> dict[str, DataFrame]:
    """The long assay tables of the recipes by output. All files are read once, together, and stored as lines by output.

    Only files that the manifest lists with a usable status are opened. ``local_path`` is relative to ``root``.
    """
    outputs = outputs_of(recipes, options)
    wanted = {o: columns_of(o, options) for o in outputs}
    files = listed_files(spark, root, manifest, outputs)
    lines = stored_lines(spark, files)
    resolved = resolve_files(lines, files, outputs)
    return {o: project_assay(lines, resolved, o, wanted[o], options_of(options, o)) for o in outputs}


def assay_rows(spark: SparkSession, root: str, manifest: DataFrame, output: str, options: dict[str, Any] | None = None) -> DataFrame:
    """One long assay table; a gene table without a ``gene_id`` column takes its first column that has values for it."""
    wanted = columns_of(output, options)
    files = listed_files(spark, root, manifest, [output])
    lines = stored_lines(spark, files)
    return project_assay(lines, resolve_files(lines, files, [output]), output, wanted, options_of(options, output))


def write_assays(spark: SparkSession, root: str, manifest: DataFrame, out: str, recipes: list[str], options: dict[str, Any] | None = None) -> DataFrame:
    """Writes ``<out>/<output>.parquet`` of all recipes from one read of the files; (output, n_rows) as observed while writing."""
    counts = []
    for name, rows in assay_tables(spark, root, manifest, recipes, options).items():
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("n_rows")).write.mode("overwrite").parquet(f"{out}/{name}.parquet")
        counts.append((name, seen.get["n_rows"]))
    return spark.createDataFrame(counts, "output string, n_rows long")
