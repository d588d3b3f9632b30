"""Operators on small hand-made tables, and registered queries against DuckDB on the smallest scale."""

import gzip
import hashlib
import json
import math
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortmill import functions as C
from cohortmill import plans
from cohortmill.operators import case_sets, checks, crosswalk, frequency, matrix, nested, predicates, samples, selection, variants
from cohortmill.plans.queries import QUERIES
from cohortmill.sources import assays, delimited, scratch, tables
from cohortmill.streaming import incremental

VARIANT = "submitter_id string, hugo_symbol string, chrom string, pos long, ref string, alt string, hgvsp_short string, variant_class string, consequence string, impact string, primary_aliquot boolean, is_coding boolean, is_high_impact boolean, is_rare boolean, gnomad_af double"


@pytest.fixture(scope="module")
def cohort(spark):
    def row(p, gene, pos, impact, coding=True, rare=True, af=None):
        return (p, gene, "1", pos, "A", "T", "p.X", "Missense_Mutation", "missense", impact, True, coding, impact in ("HIGH", "MODERATE"), rare, af)

    rows = [
        row("P1", "PIK3CA", 100, "MODERATE"), row("P1", "TP53", 200, "HIGH"), row("P2", "PIK3CA", 100, "MODERATE"), row("P2", "TTN", 300, "LOW", coding=False),
        row("P3", "PIK3CA", 400, "MODERATE"), row("P5", "KRAS", 500, "MODERATE"), row("P6", "TP53", 200, "HIGH"), row("P6", "EGFR", 600, "HIGH", rare=False, af=0.05),
    ]
    people = [(f"P{k}", "BRCA" if k < 5 else "LUAD") for k in range(1, 8)]
    return spark.createDataFrame(rows, VARIANT), spark.createDataFrame(people, "submitter_id string, lineage string")


def test_gene_frequency(cohort):
    got = {(r["hugo_symbol"], r["lineage"]): r for r in frequency.gene_frequency(*cohort).collect()}
    r = got["PIK3CA", "BRCA"]
    assert (r["n_mutated_patients"], r["n_total_patients"], r["n_mutated_other"], r["n_total_other"], r["n_high_impact_patients"]) == (3, 4, 0, 3, 3)
    assert r["log2_enrichment_vs_other"] > 10 and r["freq"] == 0.75
    assert got["TP53", "BRCA"]["freq_other_lineages"] == pytest.approx(1 / 3) and got["TP53", "LUAD"]["freq_other_lineages"] == 0.25
    assert not {"TTN", "EGFR"} & {g for g, _ in got}
    assert ("EGFR", "LUAD") in {(r["hugo_symbol"], r["lineage"]) for r in frequency.gene_frequency(*cohort, require_rare=False).collect()}


def test_one_group_has_no_others(spark, cohort):
    facts, people = cohort
    r = frequency.gene_frequency(facts, people.withColumn("lineage", F.lit("all"))).filter("hugo_symbol = 'TP53'").first()
    assert r["n_mutated_patients"] == 2 and r["freq_other_lineages"] is None and r["log2_enrichment_vs_other"] is None


def test_variant_frequency(cohort):
    got = {(r["hugo_symbol"], r["pos"], r["lineage"]): r for r in frequency.variant_frequency(*cohort).collect()}
    assert got["PIK3CA", 100, "BRCA"]["cohort_freq"] == 0.5 and got["EGFR", 600, "LUAD"]["gnomad_af"] == 0.05


def test_columns(spark):
    df = spark.createDataFrame([("a;b;c", "TCGA-1-2-10A-x", None, 4.0, 0.0), ("a", "TCGA-1-2-99A", "NaN", -1.0, 2.0), ("", "garbage", "1e-5", 3.0, 6.0), (None, None, "0.001", None, None)], "callers string, barcode string, af string, x double, depth double")
    got = df.select(
        C.item_count(F.col("callers")).alias("n"), C.normal_source(F.col("barcode")).alias("s"), C.rare(F.col("af")).alias("rare"), C.log1p_or_null(F.col("x")).alias("l"),
        C.allele_fraction(F.col("x"), F.col("depth")).alias("vaf"), C.program_of_barcode(F.col("barcode")).alias("p"), C.program_of_project(F.col("barcode")).alias("q"),
    ).collect()
    assert [r["n"] for r in got] == [3, 1, 0, 0] and [r["s"] for r in got] == ["Blood Derived Normal", None, None, None]
    assert [r["rare"] for r in got] == [True, True, True, False] and got[0]["vaf"] is None and got[1]["l"] is None and got[0]["l"] == pytest.approx(math.log(5))
    assert [r["p"] for r in got] == ["TCGA", "TCGA", "unknown", "unknown"] and [r["q"] for r in got] == ["TCGA", "TCGA", None, None]
    names = spark.createDataFrame([("Composite Element REF",), ("tpm.un-str (x)/y",), ("__a__",)], "h string").select(C.header_name(F.col("h"))).collect()
    assert [r[0] for r in names] == ["composite_element_ref", "tpm_un_str_x_y", "a"]
    slugs = spark.createDataFrame([("TP53|p53",), ("--",), ("Ünï x",), (None,)], "h string").select(C.feature_slug(F.col("h"))).collect()
    assert [r[0] for r in slugs] == ["tp53_p53", "feature", "ünï_x", "feature"]


def test_pick(spark):
    rows = [("A", "a1", 20.0), ("A", "a2", 100.0), ("B", "b2", 5.0), ("B", "b1", 5.0), ("C", "c1", None), ("C", "c2", 1.0)]
    df = spark.createDataFrame(rows, "submitter_id string, tumor_barcode string, t_depth double")
    got = variants.pick_unit(df, entity="submitter_id", unit="tumor_barcode", depth="t_depth").collect()
    assert {tuple(r) for r in got} == {("A", "a2"), ("B", "b1"), ("C", "c2")}
    assert variants.mark_primary(df.drop("submitter_id")).filter("primary_aliquot").isEmpty()
    assert {r["tumor_barcode"] for r in variants.mark_primary(df, depth="none").filter("primary_aliquot").collect()} == {"a1", "b1", "c1"}


def test_samples(spark):
    clinical = spark.createDataFrame([("c1", "S1", "TCGA-BRCA", None, 365.25 * 50), ("c2", "S2", "CPTAC-3", "Kidney, NOS", None), ("c3", "S3", "HCMI-CMDC", " ", 1.0)], "case_id string, submitter_id string, project_id string, primary_site string, diagnosis_age_at_diagnosis double")
    v = spark.createDataFrame([("S1", "t", "n", "Blood", True, True, k < 2) for k in range(3)], "submitter_id string, tumor_barcode string, normal_barcode string, normal_source string, primary_aliquot boolean, is_coding boolean, is_high_impact boolean")
    nodes = spark.createDataFrame([("BRCA", "Invasive Breast Carcinoma", "Breast Cancer", "Breast")], "code string, name string, main_type string, tissue string")
    codes = spark.createDataFrame([("TCGA-BRCA", "BRCA")], "project_id string, oncotree_code string")
    got = {r["case_id"]: r for r in samples.samples_table(clinical, v, ontology=nodes, project_codes=codes).collect()}
    assert (got["c1"]["lineage"], got["c2"]["lineage"], got["c3"]["lineage"]) == ("breast", "kidney", "unknown")
    assert got["c1"]["age_at_diagnosis_years"] == 50.0 and got["c1"]["oncotree_tissue"] == "Breast" and got["c2"]["oncotree_code"] is None
    assert (got["c1"]["n_variants_total"], got["c1"]["n_variants_high_impact"], got["c2"]["n_variants_total"]) == (3, 2, 0) and got["c2"]["primary_tumor_barcode"] is None
    assert len(crosswalk.TISSUES) == 55 and len(crosswalk.SITE_PREFIXES) == 36


CASE = "array<struct<case_id:string,submitter_id:string,project:struct<project_id:string>,samples:array<struct<sample_id:string,submitter_id:string,sample_type:string,tissue_type:string>>>>"
HIT = f"file_id string, file_name string, data_category string, data_type string, data_format string, experimental_strategy string, access string, file_size long, md5sum string, platform string, analysis struct<workflow_type:string>, cases {CASE}"


def hit(fid, *cases, size=10, category="Clinical"):
    made = [(c, f"s{c}", (p,), [(f"x{c}{k}", None, t, None) for k, t in enumerate(kinds)]) for c, p, *kinds in cases]
    return (fid, f"{fid}.tsv", category, "t", "MAF", None, "open", size, "m", None, (None,), made)


def test_nested(spark):
    df = spark.createDataFrame([hit("f1", ("A", "P1", "Tumor")), hit("f2", ("A", "P1", "Tumor", "Normal"), ("B", "P2")), hit("f3", size=None), hit("f4", ("B", "P2", "Tumor", "Normal"), category="Simple Nucleotide Variation")], HIT)
    got = {r["file_id"]: r for r in nested.provenance(df).collect()}
    assert (got["f1"]["case_id"], got["f1"]["sample_type"], got["f2"]["case_id"], got["f4"]["sample_id"]) == ("A", "Tumor", None, None) and got["f2"]["n_cases"] == 2 and got["f4"]["n_samples"] == 2
    cover = {(r["project_id"], r["data_category"]): r for r in nested.coverage(df, program="X").collect()}
    assert cover["P1", "Clinical"]["n_files"] == 2 and cover["P2", "Simple Nucleotide Variation"]["support_status"] == "supported" and cover["P2", "Clinical"]["recipe"] is None
    assert {r["file_id"] for r in selection.apply_limit(df, 1).collect()} == {"f1", "f2", "f3", "f4"}
    tree = predicates.all_of(None, predicates.is_in("cases.project.project_id", "P2"), predicates.all_of(predicates.equals("data_format", "MAF"), {}))
    assert [r["file_id"] for r in predicates.filter_tree(df, tree).orderBy("file_id").collect()] == ["f2", "f4"]
    moved = predicates.at_case_level(predicates.open_access(tree))
    assert [x["content"]["field"] for x in moved["content"]] == ["project.project_id", "files.data_format", "files.access"]
    with pytest.raises(ValueError):
        predicates.named_filters({"nonsense": 1})
    assert nested.preview(df).first()["n_multi_case"] == 1 and nested.unnest(df).count() == 7


def test_selections(spark):
    make = lambda *rows: spark.createDataFrame(rows, "case_id string, submitter_id string, project_id string")
    chosen = {"primary": make(("1", "A1", "A"), ("2", "A2", "A"), ("3", "A3", "A"), ("9", "C1", "C"), ("4", "4", "unknown")), "rna": make(("2", "A2", "A"), ("3", "A3", "A"), ("4", "B2", "B"))}
    got = [tuple(r) for r in selection.shared_selection(chosen, 1).select("case_id", "submitter_id", "project_id").collect()]
    assert got == [("2", "A2", "A"), ("4", "B2", "B")]
    balance = {r["project_id"]: (r["candidates"], r["selected"], r["shortfall"]) for r in selection.selection_balance(chosen, 2).collect()}
    assert balance["A"] == (2, 2, 0) and balance["B"] == (1, 1, 1) and balance["C"] == (0, 0, 2)
    assert {tuple(r) for r in selection.reconcile(chosen["primary"], chosen["rna"], "case_id").collect()} == {("1", "missing"), ("9", "missing")}


def test_splits(spark):
    sizes = spark.createDataFrame([(n,) for n in range(1, 60)], "n long")
    v, t = matrix.split_sizes(F.col("n"), 0.15, 0.15)
    for r in sizes.select("n", v.alias("v"), t.alias("t")).collect():
        n = r["n"]
        exp = (0, 0) if n == 1 else (0, 1) if n == 2 else (max(1, round(n * 0.15)), max(1, round(n * 0.15)))
        while n > 2 and sum(exp) >= n:
            exp = (exp[0] - 1, exp[1]) if exp[0] >= exp[1] and exp[0] > 0 else (exp[0], exp[1] - 1)
        assert (r["v"], r["t"]) == exp
    v, t = matrix.split_sizes(F.col("n"), 0.5, 0.5)
    for r in sizes.select("n", v.alias("v"), t.alias("t")).filter("n > 2").collect():
        assert r["v"] + r["t"] == r["n"] - 1 and abs(r["v"] - r["t"]) <= 1
    with pytest.raises(ValueError):
        matrix.DatasetOptions(fractions=(0.5, 0.2, 0.2))


def test_dataset(spark):
    people = spark.createDataFrame([(f"P{k}", "breast" if k < 4 else "lung") for k in range(1, 7)], "submitter_id string, oncotree_tissue string")
    rna = spark.createDataFrame([("P1", "ENSG1", 9.0), ("P4", "ENSG1", 0.0), ("P2", "ENSG1", None), ("P9", "ENSG9", 1.0), ("P1", "ENSG2", 3.0)], "submitter_id string, gene_id string, unstranded double")
    snv = spark.createDataFrame([("P1", "TP53", True), ("P4", "TP53", False)], "submitter_id string, hugo_symbol string, primary_aliquot boolean")
    made = matrix.dataset(people, {"rna_expression": rna, "snv": snv}, matrix.DatasetOptions(min_support=1))
    wide = {r["submitter_id"]: r for r in made["matrix/rna_expression"].collect()}
    assert wide["P1"]["rna_expression__ensg1"] == pytest.approx(math.log(10)) and wide["P4"]["rna_expression__ensg1"] == 0 and wide["P2"]["rna_expression__ensg1"] is None and "rna_expression__ensg9" not in made["matrix/rna_expression"].columns
    assert {r["submitter_id"]: r["snv__tp53"] for r in made["matrix/snv"].collect()} == {"P1": 1, "P2": 0, "P3": 0, "P4": 0, "P5": 0, "P6": 0}
    capped = matrix.dataset(people, {"rna_expression": rna}, matrix.DatasetOptions(min_support=2, max_features=1))
    assert [r["feature_id"] for r in capped["features"].collect()] == ["ENSG1"]


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write = lambda name, text: gzip.open(tmp_path / "in" / name, "wt").write(text)
    write("a.maf.gz", "#version\nHugo_Symbol\tt_depth\tcase_id\tExtra\nG1\t5\tc1\tx\n\nG2\t.\tc2\n")
    write("b.maf.gz", "case_id\tHugo_Symbol\tt_depth\r\nc3\tG3\t7\textra\r\n")
    got = {r["case_id"]: r for r in delimited.scan_variants(spark, str(tmp_path / "in")).collect()}
    assert {c: (r["hugo_symbol"], r["t_depth"], r["chrom"]) for c, r in got.items()} == {"c1": ("G1", 5, None), "c2": ("G2", None, None), "c3": ("G3", 7, None)} and got["c3"]["source_file"] == "b.maf.gz"
    with pytest.raises(FileNotFoundError):
        delimited.scan_variants(spark, str(tmp_path / "in"), "*.none")


def test_lines_of_any_file_size(spark, tmp_path):
    """A file is split between tasks: its header is found in the first of its blocks that has a data line."""
    comments = "".join(f"# comment {k}\n" for k in range(300))
    rows = "".join(f"c{k}\tG{k % 7}\t{k}\n" for k in range(2000))
    (tmp_path / "a.maf").write_text(comments + "case_id\tHugo_Symbol\tt_depth\n" + rows + "case_id\tHugo_Symbol\t5\n")
    (tmp_path / "b.maf").write_text("Hugo_Symbol\tcase_id\n" + "".join(f"H\td{k}\n" for k in range(500)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        assert delimited.read_lines(spark, str(tmp_path), "*.maf").rdd.getNumPartitions() > 10
        got = delimited.scan_variants(spark, str(tmp_path), "*.maf").select("case_id", "hugo_symbol", "t_depth", "source_file").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    exp = {(f"c{k}", f"G{k % 7}", k, "a.maf") for k in range(2000)} | {(f"d{k}", "H", None, "b.maf") for k in range(500)} | {("case_id", "Hugo_Symbol", 5, "a.maf")}
    assert len(got) == len(exp) and {tuple(r) for r in got} == exp


def assay_cohort(spark, root):
    texts = {
        "rna.tsv": "gene_id\tgene_name\tunstranded\nN_unmapped\t\t1\nENSG1.2\tTP53\t42\nENSG2.1\tKRAS\t7\n", "meth.tsv": "cg00000292\t0.3075\ncg2\tNA\n",
        "meth2.tsv": "Composite Element REF\tBeta_value\ncg1\t0.75\n", "seg.tsv": "Sample\tChromosome\tStart\tEnd\tNum_Probes\tSegment_Mean\ns\t1\t10\t20\t7\t0.34\n",
        "prot.tsv": "AGID\tlab_id\tpeptide_target\tprotein_expression\nAGID00100\t1\t1433BETA\t-0.065588\n",
    }
    kinds = {
        "rna.tsv": ("Transcriptome Profiling", "Gene Expression Quantification", "RNA-Seq"), "meth.tsv": ("DNA Methylation", "Methylation Beta Value", None), "meth2.tsv": ("DNA Methylation", "Methylation Beta Value", None),
        "seg.tsv": ("Copy Number Variation", "Copy Number Segment", None), "prot.tsv": ("Proteome Profiling", "Protein Expression Quantification", None),
    }
    root.mkdir()
    for name, text in texts.items():
        (root / name).write_text(text)
    rows = [(f"id-{n}", n, "case1", *kinds[n], n, "ok") for n in texts] + [("id-x", "x", "case1", *kinds["rna.tsv"], "x.tsv", "missing")]
    return spark.createDataFrame(rows, "file_id string, file_name string, case_id string, data_category string, data_type string, experimental_strategy string, local_path string, status string")


def test_assays(spark, tmp_path):
    manifest = assay_cohort(spark, tmp_path / "data")
    made = assays.assay_tables(spark, str(tmp_path / "data"), manifest, ["multiomics"], {"rna": {"genes": ["ENSG1"], "columns": ["gene_id", "unstranded"]}, "methylation": {"probes": ["cg1", "cg00000292"]}})
    assert [(r["gene_id"], r["unstranded"], r["case_id"]) for r in made["rna_expression"].collect()] == [("ENSG1.2", 42, "case1")] and len(made["rna_expression"].columns) == 15
    assert {(r["probe_id"], r["beta_value"]) for r in made["methylation_beta"].collect()} == {("cg00000292", 0.3075), ("cg1", 0.75)}
    r = made["copy_number_segments"].first()
    assert (r["num_probes"], r["segment_mean"], r["cnv_type"]) == (7, 0.34, "Copy Number Segment")
    r = made["protein_expression"].first()
    assert (r["protein_id"], r["antibody"], r["expression_value"]) == ("AGID00100", "1433BETA", -0.065588) and made["gene_copy_number"].isEmpty()
    with pytest.raises(ValueError):
        assays.columns_of("rna_expression", {"rna": {"columns": ["nonsense"]}})


def test_stream_resumes(spark, tmp_path):
    manifest, root, out = assay_cohort(spark, tmp_path / "data"), str(tmp_path / "data"), str(tmp_path / "out")
    for _ in range(2):
        incremental.normalise_stream(spark, root, manifest, out, str(tmp_path / "check"), recipes=["rna_expression", "methylation"], files_per_batch=2)
    assert incremental.normalised(spark, out, "rna_expression").count() == 2 and incremental.normalised(spark, out, "methylation_beta").count() == 3
    assert {r["status"] for r in incremental.handled_status(spark, manifest, root, out).collect()} == {"ok", "missing"} and (tmp_path / "data" / "rna.tsv").exists()
    taken = {(r["file_id"], r["output"], r["outcome"], r["n_lines"]) for r in incremental.ledger(spark, out).collect()}
    assert taken == {("id-rna.tsv", "rna_expression", "written", 4), ("id-meth.tsv", "methylation_beta", "written", 2), ("id-meth2.tsv", "methylation_beta", "written", 2), (None, None, "unrouted", 2)} and incremental.ledger(spark, out).count() == 5


def test_failed_batch_runs_again(spark, tmp_path, monkeypatch):
    """A batch that fails after its outputs are written deletes nothing and enters nothing; run again, its rows appear once."""
    manifest, root, out, check = assay_cohort(spark, tmp_path / "data"), str(tmp_path / "data"), str(tmp_path / "out"), str(tmp_path / "check")
    run = lambda: incremental.normalise_stream(spark, root, manifest, out, check, recipes=["multiomics"], files_per_batch=2, delete_handled=True)
    real, calls = incremental.project_assay, []

    def failing(lines, resolved, name, *rest):
        calls.append(name)
        if calls.count("protein_expression") == 2:
            raise OSError("disk full")
        return real(lines, resolved, name, *rest)

    monkeypatch.setattr(incremental, "project_assay", failing)
    with pytest.raises(Exception, match="disk full"):
        run()
    monkeypatch.setattr(incremental, "project_assay", real)
    assert incremental.ledger(spark, out).select("batch").distinct().count() == 1
    assert len(list((tmp_path / "data").iterdir())) >= 3 + 0  # the failed batch's files and all later ones are there
    run()
    counts = {o: incremental.normalised(spark, out, o).count() for o in ("rna_expression", "methylation_beta", "copy_number_segments", "protein_expression")}
    assert counts == {"rna_expression": 2, "methylation_beta": 3, "copy_number_segments": 1, "protein_expression": 1}
    assert not [p for p in (tmp_path / "data").iterdir() if not p.name.startswith(".")]
    status = {r["file_id"]: (r["status"], r["local_path"]) for r in incremental.handled_status(spark, manifest, root, out).collect()}
    assert status.pop("id-x") == ("missing", "x.tsv") and set(status.values()) == {("processed_deleted", None)} and len(status) == 5


def test_batches_settle_in_few_groups(spark, tmp_path, monkeypatch):
    """Nine batches of one file are settled in five steps; rows, ledger and deletions are whole."""
    rows = [(f"f{k}.tsv", f"c{k}", "Transcriptome Profiling", "Gene Expression Quantification", "RNA-Seq", "ok") for k in range(9)]
    (tmp_path / "data").mkdir()
    for k, (name, *_) in enumerate(rows):
        (tmp_path / "data" / name).write_text(f"gene_id\tunstranded\nENSG1\t{k}\n")
    manifest = spark.createDataFrame(rows, "local_path string, case_id string, data_category string, data_type string, experimental_strategy string, status string")
    root, out, check = str(tmp_path / "data"), str(tmp_path / "out"), str(tmp_path / "check")
    real, calls = incremental.project_assay, []
    monkeypatch.setattr(incremental, "project_assay", lambda *a: calls.append(a[2]) or real(*a))
    run = lambda **o: incremental.normalise_stream(spark, root, manifest, out, check, recipes=["rna_expression"], files_per_batch=1, **o)
    run()
    assert len(calls) == 5
    run(delete_handled=True)
    assert sorted((r["case_id"], r["unstranded"]) for r in incremental.normalised(spark, out, "rna_expression").collect()) == sorted([(f"c{k}", k) for k in range(9)])
    assert sorted(r["batch"] for r in incremental.ledger(spark, out).collect()) == list(range(9)) and incremental.deletions(spark, out).count() == 9
    assert not [p for p in (tmp_path / "data").iterdir() if not p.name.startswith(".")] and not list((tmp_path / "out" / "_lines").glob("batch=*"))


def test_batches_take_paths_alone(spark, tmp_path):
    """A batch has a row per file, not per line; the rows come from the files when their group is settled."""
    manifest, root, out = assay_cohort(spark, tmp_path / "data"), str(tmp_path / "data"), str(tmp_path / "out")
    query = incremental.normalise_stream(spark, root, manifest, out, str(tmp_path / "check"), recipes=["methylation"], files_per_batch=2)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 5
    assert incremental.normalised(spark, out, "methylation_beta").count() == 3 and not list((tmp_path / "out" / "_taken").glob("batch=*"))


def test_values_are_looked_up_where_they_decide(spark, tmp_path, monkeypatch):
    """Only files with several names of one column, and expression files, are read for which columns have values."""
    texts = {"one.tsv": "mirna_id\tread_count\nx\t1\n", "two.tsv": "mirna_id\tmirna\tread_count\n\ty\t2\n", "g.tsv": "gene_id\tunstranded\nENSG1\t3\n"}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    kind = lambda n: ("Transcriptome Profiling", *(("Gene Expression Quantification", "RNA-Seq") if n == "g.tsv" else ("miRNA Expression Quantification", "miRNA-Seq")))
    manifest = spark.createDataFrame([(n, "c", *kind(n)) for n in texts], "local_path string, case_id string, data_category string, data_type string, experimental_strategy string")
    real, seen = assays.filled_columns, []
    monkeypatch.setattr(assays, "filled_columns", lambda rows, *a: seen.extend(r["path"].rsplit("/", 1)[1] for r in rows.select("path").distinct().collect()) or real(rows, *a))
    made = assays.assay_tables(spark, str(tmp_path), manifest, ["rna_expression", "mirna_expression"])
    assert sorted(seen) == ["g.tsv", "two.tsv"]
    assert {(r["mirna_id"], r["read_count"]) for r in made["mirna_expression"].collect()} == {("x", 1), ("y", 2)}
    assert [(r["gene_id"], r["unstranded"]) for r in made["rna_expression"].collect()] == [("ENSG1", 3)]


def test_packed_blocks_equal_wide_blocks(spark):
    """Any number of blocks is one table; its cells are the filled cells of the blocks' wide tables, and no row is left out."""
    long = spark.createDataFrame([(e, f"f{k:03d}", float(e * k)) for e in range(4) for k in range(37) if (e + k) % 3], "entity long, feature string, value double")
    ids = spark.createDataFrame([(e,) for e in range(3)], "id long")
    names = matrix.feature_names(matrix.feature_support(long), "x")
    wide, _ = matrix.to_blocks(long, ids, names, "id", size=5)
    want = {(r["id"], k, c, r[c]) for k, b in enumerate(wide) for r in b.collect() for c in b.columns if c != "id" and r[c] is not None}
    packed, index = matrix.to_packed_blocks(long, ids, names, "id", size=5)
    got = packed.select("id", "block", F.inline("cells")).join(index, ["block", "slot"]).select("id", "block", "column_name", "value").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_few_shared_units_are_no_tasks_alone(spark):
    """Units that all entities share: the rows are not shuffled by unit, which would give all of one unit to one task."""
    df = spark.range(4000).select((F.col("id") % 200).alias("submitter_id"), F.concat(F.lit("u"), F.col("id") % 3).alias("tumor_barcode"), F.col("id").alias("t_depth"))
    plan = variants.mark_primary(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan
    assert variants.mark_primary(df).filter("primary_aliquot").count() == 4000


def test_tied_enrichments_go_on_by_variant(spark, cohort):
    """The order of equal enrichments is that of the variants, so a sort can split them."""
    for table, names in ((frequency.variant_frequency(*cohort), frequency.LOCUS + frequency.ANNOTATION), (frequency.gene_frequency(*cohort), ["hugo_symbol"])):
        rows = [(r["lineage"], -r["log2_enrichment_vs_other"] if r["log2_enrichment_vs_other"] is not None else math.inf, *[r[c] for c in names]) for r in table.collect()]
        assert rows == sorted(rows) and " ASC" in table._jdf.queryExecution().analyzed().toString().split("\n")[0]


def test_reconcile_computes_each_side_once(spark):
    a, b = (spark.createDataFrame([(k,) for k in ks], "case_id long") for ks in ([1, 2, 2, None], [2, 3, None]))
    found = selection.reconcile(a, b, "case_id")
    assert sorted((r["id"] or 0, r["kind"]) for r in found.collect()) == [(0, "missing"), (0, "unexpected"), (1, "missing"), (3, "unexpected")]
    assert found._jdf.queryExecution().analyzed().toString().count("LogicalRDD") == 2


def test_short_lists_go_to_the_rows(spark):
    """A panel of two values: rows are not shuffled by the panel's column, whose commonest value would be one task's alone."""
    df = spark.range(1000).select(F.when(F.col("id") % 10 == 0, "A").otherwise("N").alias("gene_id"), F.lit("x").alias("gene_name"))
    for kept in (tables.keep_listed(df, "gene_id", tables.value_list(spark, ["A", "R"])), tables.keep_identifiers(df, tables.value_list(spark, ["A", "R"]))):
        assert kept.count() == 100
        assert "SortMergeJoin" not in kept._jdf.queryExecution().sparkPlan().toString()


def test_assays_open_listed_files_once(spark, tmp_path):
    """Paths that end like others, odd names, a file listed twice, damaged files that no row lists; sources may go after the call."""
    kind = ("Transcriptome Profiling", "Gene Expression Quantification", "RNA-Seq")
    texts = {"a/f [1].tsv": ("c1", 1), "deep/a/f [1].tsv": ("c2", 2), "b+%20ü{x}.tsv": ("c3", 3), "a/f 1.tsv": ("c4", 4)}
    for name, (_, n) in texts.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(f"gene_id\tunstranded\nENSG1\t{n}\n")
    (tmp_path / "a" / "bad.tsv.gz").write_text("not gzip")
    rows = [(n, c, *kind, "ok") for n, (c, _) in texts.items() if c != "c4"] + [("./a/f [1].tsv", "again", *kind, "ok"), ("none.tsv", "c9", *kind, "ok"), (None, "c8", *kind, "ok")]
    manifest = spark.createDataFrame(rows, "local_path string, case_id string, data_category string, data_type string, experimental_strategy string, status string")
    made = assays.assay_tables(spark, str(tmp_path), manifest, ["multiomics"])
    plan = made["rna_expression"]._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    for name in texts:
        (tmp_path / name).unlink()
    assert {(r["case_id"], r["unstranded"]) for r in made["rna_expression"].collect()} == {("c1", 1), ("c2", 2), ("c3", 3), ("again", 1)}
    assert all(made[o].isEmpty() for o in made if o != "rna_expression")


def test_columns_without_values_count_as_absent(spark, tmp_path):
    (tmp_path / "g.tsv").write_text("empty\tname\tgene_id\tunstranded\nNA\tENSG5\t\t7\n\tENSG6\tNA\t8\n")
    (tmp_path / "m.tsv").write_text("mirna_id\tmirna\treads\tread_count\n\tx\t3\t\n.\ty\t4\tNA\n")
    rows = [("g.tsv", "c", "Transcriptome Profiling", "Gene Expression Quantification", "RNA-Seq"), ("m.tsv", "c", "Transcriptome Profiling", "miRNA Expression Quantification", "miRNA-Seq")]
    manifest = spark.createDataFrame(rows, "local_path string, case_id string, data_category string, data_type string, experimental_strategy string")
    made = assays.assay_tables(spark, str(tmp_path), manifest, ["rna_expression", "mirna_expression"])
    assert {(r["gene_id"], r["unstranded"]) for r in made["rna_expression"].collect()} == {("ENSG5", 7), ("ENSG6", 8)}
    assert {(r["mirna_id"], r["read_count"]) for r in made["mirna_expression"].collect()} == {(None, 3), (".", 4)}


def test_failures_are_reported_by_full_path(spark, tmp_path):
    sound = "Hugo_Symbol\tt_depth\tTumor_Sample_Barcode\nG1\t5\tTCGA-1\n"
    for folder in ("a", "b", "c", "d", "e"):
        (tmp_path / folder).mkdir()
    with gzip.open(tmp_path / "a" / "f.maf.gz", "wt") as f:
        f.write(sound)
    whole = (tmp_path / "a" / "f.maf.gz").read_bytes()
    (tmp_path / "b" / "f.maf.gz").write_bytes(b"NOT GZIP DATA")
    (tmp_path / "c" / "f.maf.gz").write_bytes(whole[:-12])
    (tmp_path / "d" / "f.maf.gz").write_bytes(gzip.compress(b"# only a comment\n"))
    (tmp_path / "e" / "f.maf.gz").write_bytes(gzip.compress(b"Hugo_Symbol\n\xff\xfe\n"))
    made = checks.validate_variants(spark, str(tmp_path))
    failed = {r["path"].split("/")[-2]: r["error_type"] for r in made["failed"].collect()}
    assert failed == {"b": "BadGzipFile", "c": "EOFError", "d": "EmptyFile", "e": "UnicodeDecodeError"} and all(r["error_message"] for r in made["failed"].collect())
    t = made["totals"].first()
    assert (t["files_total"], t["files_ok"], t["files_failed"], t["rows_total"], t["distinct_tumor_barcodes"]) == (5, 1, 4, 1, 1)
    assert {r["program"]: r["n_rows"] for r in made["programs"].collect()} == {"TCGA": 1}
    nothing = checks.validate_variants(spark, str(tmp_path / "b"))
    assert nothing["totals"].first()["rows_total"] == 0 and nothing["failed"].count() == 1


def test_snapshot_outlives_edits(spark, tmp_path):
    panel = tmp_path / "genes.txt"
    panel.write_text("TP53\n# note\n\nKRAS\nTP53\n")
    options, taken = tables.snapshot_options(spark, {"rna": {"genes_file": str(panel)}, "variants": {"genes": ["X"]}, "copy_number": {"outputs": []}})
    digest = hashlib.sha256(panel.read_bytes()).hexdigest()
    panel.write_text("BRCA1\n")
    r = taken.first()
    assert (r["sha256"], r["n_values"]) == (digest, 2) and r["path"].endswith("genes.txt") and options["variants"] == {"genes": ["X"]}
    assert {v["value"] for v in tables.value_list(spark, None, options["rna"]["genes_file"]).collect()} == {"TP53", "KRAS"}
    with pytest.raises(FileNotFoundError):
        tables.snapshot_inputs(spark, [str(tmp_path / "none")])


def test_ontology_of_any_depth(spark, tmp_path):
    tree = {}
    for k in reversed(range(15)):
        tree = {f"N{k}": {"code": f"N{k}", "name": f"node {k}", "mainType": None, "tissue": "T", "children": tree}}
    tree["N3"] = {"code": "N3", "name": "again", "children": {"N0": {"code": "N0", "name": "below itself", "children": {}}, "x": {"name": "no code", "children": {"N99": {"code": "N99"}}}}}
    (tmp_path / "tree.json").write_text(json.dumps(tree))
    got = {r["code"]: r["name"] for r in tables.ontology_nodes(spark, str(tmp_path / "tree.json")).collect()}
    assert set(got) == {f"N{k}" for k in range(15)} | {"N99"} and got["N0"] == "node 0" and got["N3"] == "again" and got["N14"] == "node 14"


def test_many_selections(spark):
    """70 selections: more than the bits of one number."""
    rng = random.Random(3)
    held = {f"s{k}": {x for x in range(40) if x == 7 or rng.random() < 0.4} for k in range(70)}
    frames = {k: spark.createDataFrame([(str(x), f"S{x}", f"P{x % 3}") for x in v], "case_id string, submitter_id string, project_id string") for k, v in held.items()}
    got = {r["selections"]: r["n_cases"] for r in selection.overlaps(frames).collect()}
    names = list(held)
    assert len(got) == 70 * 69 // 2 + 1 and got[",".join(names)] == len(set.intersection(*held.values()))
    assert all(got[f"{a},{b}"] == len(held[a] & held[b]) for i, a in enumerate(names) for b in names[i + 1 :])
    assert {r["case_id"] for r in selection.shared_candidates(frames).collect()} == {str(x) for x in set.intersection(*held.values())}


def test_exact_split(spark):
    """The same membership as a seeded shuffle of each label's sorted entities."""
    rng = random.Random(5)
    rows = [(f"E{rng.randrange(10**6):06d}é{k}", label, "x") for label, n in (("a", 1), ("b", 2), ("lung", 3), ("bréast", 400), ("d|e", 57)) for k in range(n)]
    got = {r["e"]: r["split"] for r in matrix.exact_stratified_split(spark.createDataFrame(rows, "e string, l string, other string").repartition(5), "l", "e", seed=13).collect()}
    assert len(got) == len(rows)
    for label in {r[1] for r in rows}:
        group = sorted(r[0] for r in rows if r[1] == label)
        random.Random(13 + int(hashlib.sha256(label.encode()).hexdigest()[:12], 16)).shuffle(group)
        n = len(group)
        val = test = 0 if n == 1 else max(1, round(n * 0.15))
        if n == 2:
            val, test = 0, 1
        assert [got[x] for x in group] == ["train"] * (n - val - test) + ["val"] * val + ["test"] * test


def test_matrices_in_blocks(spark):
    """More features than a table may hold: blocks of columns, in feature order, with every sample in each."""
    people = spark.createDataFrame([(f"P{k}", "ab"[k % 2]) for k in range(6)], "submitter_id string, oncotree_tissue string")
    rows = [(f"P{k % 6}", f"G{k % 23:02d}", float(k)) for k in range(90)] + [("P0", "g-00", 1.0), ("P9", "G77", 1.0)]
    rna = spark.createDataFrame(rows, "submitter_id string, gene_id string, unstranded double")
    whole = matrix.dataset(people, {"rna_expression": rna}, matrix.DatasetOptions())
    made = matrix.dataset(people, {"rna_expression": rna}, matrix.DatasetOptions(block=10))
    blocks = [made[f"matrix/rna_expression/block={k}"] for k in range(3)]
    assert "matrix/rna_expression" not in made and [len(b.columns) - 1 for b in blocks] == [10, 10, 4] and all(b.count() == 6 for b in blocks)
    index = {r["column_name"]: r["block"] for r in made["features"].collect()}
    assert all(index[c] == k for k, b in enumerate(blocks) for c in b.columns if c != "submitter_id")
    joined = {r["submitter_id"]: r.asDict() for r in blocks[0].join(blocks[1], "submitter_id").join(blocks[2], "submitter_id").collect()}
    assert joined == {r["submitter_id"]: r.asDict() for r in whole["matrix/rna_expression"].collect()}
    assert list(whole["matrix/rna_expression"].columns) == [c for b in blocks for c in b.columns if c != "submitter_id" or b is blocks[0]]


def test_variants_and_summary_from_one_scan(spark, tmp_path):
    v = [("S1", "t1", "n", "A", "Silent", "LOW", 5.0), ("S1", "t2", "n", "B", "Missense_Mutation", "HIGH", 9.0), ("S2", "t3", "n", "B", "Silent", "LOW", 1.0)]
    scanned = spark.createDataFrame(v, "submitter_id string, tumor_barcode string, normal_barcode string, hugo_symbol string, variant_class string, impact string, t_depth double")
    kept, summary = variants.write_variants(scanned, f"file://{tmp_path}/out", None, tables.value_list(spark, ["A"]))
    assert [(r["hugo_symbol"], r["primary_aliquot"]) for r in kept.collect()] == [("A", False)]
    assert {r["submitter_id"]: r["n_tumor_aliquots"] for r in summary.collect()} == {"S1": 2, "S2": 1}


def test_scratch_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(Session())


def test_cohort_handle(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "samples.parquet"))
    c = tables.Cohort(spark, str(tmp_path))
    assert {r["table"]: r["n_rows"] for r in c.summary().collect()}["samples"] == 3 and c.optional("variants") is None
    with pytest.raises(FileNotFoundError):
        c.table("variants")


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_query_against_sql(spark, small, oracle, name):
    got = plans.queries()[name](spark, small)
    exp = oracle.sql(plans.oracle_sql()[name])
    assert sorted(got.columns) == sorted(exp.columns)
    tidy = lambda v: round(v, 6) + 0.0 if isinstance(v, float) else v
    a = sorted(repr([tidy(r[c]) for c in sorted(got.columns)]) for r in got.collect())
    b = sorted(repr([tidy(r[exp.columns.index(c)]) for c in sorted(exp.columns)]) for r in exp.fetchall())
    assert a == b


def test_whole_matrices(spark, small):
    """The matrices have a column for each of the 25 brands, with the values of the array form."""
    wide, there = QUERIES["wide_matrix_all"](spark, small), QUERIES["presence_matrix_all"](spark, small)
    assert len(wide.columns) == len(there.columns) == 26
    held = QUERIES["array_matrix"](spark, small).count()
    assert sum(v is not None for r in wide.collect() for v in r[1:]) == held


def test_add_on_filters():
    add = {"rna": {"data_type": "x"}, "own": {"project": ["B"], "data_type": "x"}, "none": {}}
    of = lambda name, **kw: predicates.add_on_filters({"project": ["A"]}, add, name, **kw)
    same = lambda **f: predicates.open_access(predicates.named_filters(f))
    assert of("rna") == same(project=["A"], data_type="x") and of("own") == same(project=["B"], data_type="x")
    tree = predicates.equals("data_type", "y")
    assert of("rna", explicit=tree) == predicates.open_access(tree)
    for name in ("none", "other"):
        with pytest.raises(ValueError):
            of(name)


def test_case_set_is_checked(spark, tmp_path):
    schema = "case_id string, submitter_id string, project_id string"
    first = spark.createDataFrame([("1", "A3", "A"), ("2", "A2", "A"), ("3", "A4", "A"), ("4", "B2", "B"), ("5", "C1", "C")], schema)
    second = first.filter("project_id != 'C'")
    path = f"file://{tmp_path}/set"
    case_sets.write_case_set({"primary": first, "rna": second}, 2, path, name="test")
    cases, balance, facts = case_sets.load_case_set(spark, path)
    assert [r["submitter_id"] for r in cases.collect()] == ["A2", "A3", "B2"] and facts.first()["selections"] == ["primary", "rna"]
    assert {r["project_id"]: (r["candidates"], r["shortfall"]) for r in balance.collect()} == {"A": (3, 0), "B": (1, 1), "C": (0, 2)}
    assert case_sets.apply_case_set(first, cases).count() == 3
    for broken in (cases.limit(2), cases.unionByName(cases.limit(1)), cases.withColumn("project_id", F.lit(""))):
        with pytest.raises(ValueError):
            case_sets._require(selection.selection_checks(broken, balance, 2, names=["primary", "rna"], filters=["primary", "rna"], ordering=case_sets.ORDERING))
    other = f"file://{tmp_path}/other"
    for name, df in (("cases", cases), ("balance", balance), ("facts", facts.withColumn("version", F.lit(9)))):
        df.write.parquet(f"{other}/{name}")
    with pytest.raises(ValueError, match="version"):
        case_sets.load_case_set(spark, other)


def test_dataset_needs_a_label(spark):
    people = spark.createDataFrame([("P1", "a"), ("P2", "b")], "submitter_id string, lineage string")
    options = matrix.DatasetOptions(label="lineage", min_class=2, modalities=("snv",))
    with pytest.raises(ValueError, match="no class"):
        matrix.dataset(people, {}, options)
