"""Selections of cases: overlap reports, capped and shared selections, and their balance."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def case_links(hits: DataFrame, selection: str) -> DataFrame:
    """(selection, file_id, case_id, submitter_id, project_id, sample_type, size): a row per file, case and sample."""
    rows = hits.select(F.lit(selection).alias("selection"), "file_id", F.coalesce("file_size", F.lit(0)).alias("size"), F.explode("cases").alias("c"))
    rows = rows.filter(F.coalesce(F.col("c.case_id"), F.lit("")) != "")
    return rows.select(
        "selection", "file_id", "size", F.col("c.case_id").alias("case_id"), F.col("c.submitter_id").alias("submitter_id"),
        F.when(F.col("c.project.project_id") != "", F.col("c.project.project_id")).alias("project_id"), F.explode_outer("c.samples").alias("s"),
    ).withColumn("sample_type", F.when(F.col("s.sample_type") != "", F.col("s.sample_type"))).drop("s")


def selection_summary(hits: dict[str, DataFrame]) -> DataFrame:
    """(selection, n_files, n_cases, total_size); a file's size counts once, files without cases count too."""
    parts = []
    for name, df in hits.items():
        files = df.groupBy("file_id").agg(F.max(F.coalesce("file_size", F.lit(0))).alias("size")).agg(F.count("*").alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"))
        cases = case_links(df, name).agg(F.count_distinct("case_id").alias("n_cases"))
        parts.append(files.crossJoin(cases).select(F.lit(name).alias("selection"), "n_files", "n_cases", "total_size"))  # one row by one row
    return reduce(DataFrame.unionByName, parts)


def project_breakdown(hits: DataFrame, selection: str) -> DataFrame:
    """(selection, project_id, n_files, n_cases, total_size); size is summed per catalogue row, so a repeated file counts again."""
    row = hits.withColumn("_row", F.monotonically_increasing_id())
    each = row.select("_row", "file_id", F.coalesce("file_size", F.lit(0)).alias("size"), F.explode("cases").alias("c"))
    each = each.select("_row", "file_id", "size", F.col("c.case_id").alias("case_id"), F.col("c.project.project_id").alias("project_id")).filter("case_id != '' and project_id != ''")
    sizes = each.groupBy("project_id", "_row").agg(F.max("size").alias("size")).groupBy("project_id").agg(F.sum("size").alias("total_size"))
    counts = each.groupBy("project_id").agg(F.count_distinct("file_id").alias("n_files"), F.count_distinct("case_id").alias("n_cases"))
    return counts.join(sizes, "project_id").select(F.lit(selection).alias("selection"), "project_id", "n_files", "n_cases", "total_size")


def cases_by(links: DataFrame, column: str) -> DataFrame:
    """Distinct cases per attribute value and selection."""
    return links.filter(F.col(column).isNotNull()).groupBy("selection", column).agg(F.count_distinct("case_id").alias("n_cases"))


#: Selections whose membership one number holds.
WORD = 62


def _bits(k: int, n: int) -> list[Column]:
    """The mask of selection ``k`` of ``n``, as many numbers as it takes."""
    return [F.lit(1 << k % WORD if k // WORD == w else 0).cast("long").alias(f"mask{w}") for w in range(-(-n // WORD))]


def _masks(n: int, prefix: str = "mask") -> list[str]:
    return [f"{prefix}{w}" for w in range(-(-n // WORD))]


def _members(n: int, prefix: str = "mask") -> Column:
    """Numbers of the selections in a mask, ascending."""
    words = [f"filter(sequence({w * WORD}, {min(n, (w + 1) * WORD) - 1}), k -> {prefix}{w} & shiftleft(1L, k - {w * WORD}) <> 0)" for w in range(-(-n // WORD))]
    return F.expr(f"concat({', '.join(words)})")


def membership(selections: dict[str, DataFrame], key: str = "case_id") -> DataFrame:
    """One row per id: a bit mask of the selections that hold it, in the order given, in columns ``mask0``, ``mask1``, ... of 62 selections each."""
    n = len(selections)
    each = [df.select(F.col(key).alias("id"), *_bits(k, n)) for k, df in enumerate(selections.values())]
    return reduce(DataFrame.unionByName, each).filter("id is not null").groupBy("id").agg(*[F.bit_or(m).alias(m) for m in _masks(n)])


def _combinations(names: list[str]) -> list[tuple[str, str, int, int, int]]:
    """(row_type, selections, first, second, order) of all pairs, and of all selections together (first -1)."""
    pairs = [("pairwise", f"{names[i]},{names[j]}", i, j) for i, j in combinations(range(len(names)), 2)]
    return [(*c, k) for k, c in enumerate([*pairs, ("all_selected", ",".join(names), -1, -1)])]


def _pairs(members: Column, n: int) -> Column:
    """Pairs of selections that a mask holds, and (-1, -1) if it holds all."""
    pair = lambda i: F.transform(F.filter(members, lambda j: j > i), lambda j: F.struct(i.alias("i"), j.alias("j")))
    every = F.when(F.size(members) == n, F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    return F.concat(F.flatten(F.transform(members, pair)), every)


COMBOS = "row_type string, selections string, i int, j int, ord int"


def overlaps(selections: dict[str, DataFrame], key: str = "case_id") -> DataFrame:
    """(row_type, selections, n_cases) of every pair and of all selections, from one shuffle by id; any number of selections.

    Ids are counted by mask first; each distinct mask then counts for the pairs of selections that it holds.
    """
    names = list(selections)
    n = len(names)
    combos = selections[names[0]].sparkSession.createDataFrame(_combinations(names), COMBOS)
    masks = membership(selections, key).groupBy(*_masks(n)).agg(F.count("*").alias("n"))
    held = masks.select("n", F.explode(_pairs(_members(n), n)).alias("p")).groupBy("p.i", "p.j").agg(F.sum("n").alias("n_cases"))
    out = combos.join(held, ["i", "j"], "left").fillna(0, ["n_cases"])
    return out.orderBy("ord").select("row_type", "selections", "n_cases")


def overlap_report(hits: dict[str, DataFrame], filters: dict[str, str] | None = None, queried_at: str | None = None) -> DataFrame:
    """Selection, pairwise and all-selected rows with JSON breakdowns by project and sample type."""
    spark = next(iter(hits.values())).sparkSession
    as_json = lambda key, value: F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))))
    links = {n: case_links(df, n) for n, df in hits.items()}
    every = reduce(DataFrame.unionByName, links.values())
    projects = reduce(DataFrame.unionByName, [project_breakdown(df, n) for n, df in hits.items()])
    by_project = projects.groupBy("selection").agg(as_json(F.col("project_id"), F.struct("n_cases", "n_files", "total_size")).alias("project_breakdown_json"))
    by_type = cases_by(every, "sample_type").groupBy("selection").agg(as_json(F.col("sample_type"), F.col("n_cases")).alias("cases_by_sample_type_json"))
    texts = spark.createDataFrame([(n, (filters or {}).get(n)) for n in hits], "selection string, resolved_filters_json string")
    head = selection_summary(hits).join(by_project, "selection", "left").join(by_type, "selection", "left").join(texts, "selection", "left")
    head = head.select(F.lit("selection").alias("row_type"), F.col("selection").alias("selections"), "n_files", "n_cases", "total_size", "resolved_filters_json", F.coalesce("project_breakdown_json", F.lit("{}")).alias("project_breakdown_json"), F.coalesce("cases_by_sample_type_json", F.lit("{}")).alias("cases_by_sample_type_json"))
    rest = overlaps({n: d.select("case_id").distinct() for n, d in links.items()})
    inside = _intersection_projects(links)
    rest = rest.join(inside, ["row_type", "selections"], "left").withColumn("project_breakdown_json", F.coalesce("project_breakdown_json", F.lit("{}")))
    stamp = F.lit(queried_at) if queried_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return head.unionByName(rest, allowMissingColumns=True).withColumn("queried_at", stamp)


def _intersection_projects(links: dict[str, DataFrame]) -> DataFrame:
    """Cases of each combination by project; a case counts for every project that any of its selections names."""
    names = list(links)
    n = len(names)
    rows = reduce(DataFrame.unionByName, [d.select("case_id", "project_id", *_bits(k, n)) for k, d in enumerate(links.values())])
    masks = rows.groupBy("case_id").agg(*[F.bit_or(m).alias(m) for m in _masks(n)])
    named = rows.filter("project_id is not null").groupBy("case_id", "project_id").agg(*[F.bit_or(m).alias(m.replace("mask", "named")) for m in _masks(n)])
    counts = named.join(masks, "case_id").groupBy(*_masks(n), *_masks(n, "named"), "project_id").agg(F.count("*").alias("n"))
    names_it = F.col("p.i").isin(-1) | F.array_contains("naming", F.col("p.i")) | F.array_contains("naming", F.col("p.j"))
    hit = counts.select("project_id", "n", _members(n, "named").alias("naming"), F.explode(_pairs(_members(n), n)).alias("p")).filter(names_it)
    totals = hit.groupBy("p.i", "p.j", "project_id").agg(F.sum("n").alias("n"))
    combos = rows.sparkSession.createDataFrame(_combinations(names), COMBOS)
    listed = F.array_sort(F.collect_list(F.struct("project_id", "n")))
    return combos.join(totals, ["i", "j"]).groupBy("row_type", "selections").agg(F.to_json(F.map_from_entries(listed)).alias("project_breakdown_json"))


def overlap_share(base: DataFrame, others: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """For each selection and id column: distinct ids shared with the base and their share of it in percent."""
    parts = []
    for name, df in others.items():
        for key in keys:
            whole = base.select(key).filter(F.col(key).isNotNull()).distinct()
            shared = whole.join(df.select(key).distinct(), key, "left_semi")
            parts.append(whole.agg(F.count("*").alias("n_base")).crossJoin(shared.agg(F.count("*").alias("n_shared"))).withColumns({"selection": F.lit(name), "key": F.lit(key)}))
    out = reduce(DataFrame.unionByName, parts).withColumn("percent", F.round(F.try_divide(100.0 * F.col("n_shared"), F.col("n_base")), 2))
    return out.select("selection", "key", "n_base", "n_shared", "percent").orderBy(F.desc("n_shared"), "selection", "key")


def reconcile(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Ids that are expected but absent, or present but unexpected: (id, kind). No rows if both hold the same ids."""
    a, b = (x.select(F.col(key).alias("id")).distinct().withColumn(mark, F.lit(True)) for x, mark in ((expected, "_expected"), (actual, "_actual")))
    both = a.join(b, "id", "full").filter(F.col("_expected").isNull() | F.col("_actual").isNull())  # each side is computed once
    return both.select("id", F.when(F.col("_actual").isNull(), "missing").otherwise("unexpected").alias("kind"))


def cap_per_group(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group in the given order."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_rank") <= n).drop("_rank")


def apply_limit(hits: DataFrame, n: int | None) -> DataFrame:
    """Files of the first ``n`` cases per project by submitter, among files of one case; files of several cases all stay."""
    if n is None:
        return hits
    case = F.get("cases", F.lit(0))
    single = hits.filter(F.size("cases") == 1).select(
        case["project"]["project_id"].alias("project"), F.coalesce(case["submitter_id"], case["case_id"]).alias("submitter"), case["case_id"].alias("case_id")
    )
    distinct = single.filter("project != '' and case_id != ''").groupBy("project", "submitter").agg(F.max("case_id").alias("case_id"))
    kept = cap_per_group(distinct, "project", ["submitter"], n).select("case_id").distinct().withColumn("_kept", F.lit(True))
    flagged = hits.withColumn("case_id", F.when(F.size("cases") == 1, case["case_id"])).join(kept, "case_id", "left").drop("case_id")
    return flagged.filter((F.coalesce(F.size("cases"), F.lit(0)) != 1) | F.col("_kept")).drop("_kept")


def selection_cases(hits: DataFrame) -> DataFrame:
    """(case_id, submitter_id, project_id) of a selection; the submitter falls back to the case, the project to ``unknown``."""
    c = hits.select(F.explode("cases").alias("c")).filter("c.case_id != ''").select(
        F.col("c.case_id").alias("case_id"), F.coalesce(F.when(F.col("c.submitter_id") != "", F.col("c.submitter_id")), F.col("c.case_id")).alias("submitter_id"),
        F.coalesce(F.when(F.col("c.project.project_id") != "", F.col("c.project.project_id")), F.lit("unknown")).alias("project_id"),
    )
    return c.groupBy("case_id").agg(F.max("submitter_id").alias("submitter_id"), F.max("project_id").alias("project_id"))


def shared_candidates(selections: dict[str, DataFrame]) -> DataFrame:
    """Cases of all selections, with the least real submitter and project; ``selections`` as by ``selection_cases``."""
    n = len(selections)
    rows = reduce(DataFrame.unionByName, [d.select("case_id", "submitter_id", "project_id", *_bits(k, n)) for k, d in enumerate(selections.values())])
    merged = rows.groupBy("case_id").agg(
        *[F.bit_or(m).alias(m) for m in _masks(n)], F.min(F.when(F.col("submitter_id") != F.col("case_id").cast("string"), F.col("submitter_id"))).alias("s"),
        F.min(F.when(F.col("project_id") != "unknown", F.col("project_id"))).alias("p"),
    )
    every = merged.filter(F.size(_members(n)) == n)
    return every.select("case_id", F.coalesce("s", F.col("case_id").cast("string")).alias("submitter_id"), F.coalesce("p", F.lit("unknown")).alias("project_id"))


def shared_selection(selections: dict[str, DataFrame], n: int) -> DataFrame:
    """The first ``n`` shared cases per project, ordered by project, submitter and case."""
    return cap_per_group(shared_candidates(selections), "project_id", ["submitter_id", "case_id"], n).orderBy("project_id", "submitter_id", "case_id")


def selection_balance(selections: dict[str, DataFrame], n: int) -> DataFrame:
    """Per project of the first selection or of any candidate: candidates, selected and shortfall; projects with none count zero."""
    first = next(iter(selections.values()))
    counts = shared_candidates(selections).groupBy("project_id").agg(F.count("*").alias("candidates"))
    projects = first.select("project_id").unionByName(counts.select("project_id")).distinct()
    out = projects.join(counts, "project_id", "left").fillna(0, ["candidates"])
    return out.withColumns({"selected": F.least("candidates", F.lit(n)), "shortfall": F.greatest(F.lit(n) - F.col("candidates"), F.lit(0)).cast("long")})


def selection_checks(cases: DataFrame, balance: DataFrame, requested: int, *, names: list[str], filters: list[str], ordering: str) -> DataFrame:
    """One row of booleans: the ten invariants that a stored case selection has to satisfy.

    ``names`` are the selections in order, ``filters`` those with resolved filters, ``ordering`` the order that cases were
    chosen by. Sums are taken over the cases themselves and held against the balance, project by project.
    """
    empty = [F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in ("case_id", "submitter_id", "project_id")]
    a = cases.agg(F.count("*").alias("n"), F.count_distinct("case_id").alias("ids"), F.count_if(reduce(Column.__or__, empty)).alias("incomplete"))
    held = balance.join(cases.groupBy("project_id").agg(F.count("*").alias("found")), "project_id", "full").fillna(0, ["candidates", "selected", "found"])
    b = held.agg(
        F.coalesce(F.sum("candidates"), F.lit(0)).alias("candidates"), F.coalesce(F.sum("selected"), F.lit(0)).alias("selected"),
        F.count_if(F.col("selected") != F.col("found")).alias("unlike"), F.count_if(F.col("candidates") < F.col("found")).alias("short"), F.coalesce(F.max("found"), F.lit(0)).alias("most"),
    )
    return a.crossJoin(b).select(  # one row by one row
        F.lit(requested > 0).alias("requested_positive"), (F.col("n") == F.col("selected")).alias("selected_matches"), (F.col("candidates") >= F.col("n")).alias("enough_candidates"),
        (F.col("ids") == F.col("n")).alias("distinct_cases"), (F.col("incomplete") == 0).alias("complete_cases"), (F.col("most") <= requested).alias("within_cap"),
        ((F.col("unlike") == 0) & (F.col("short") == 0)).alias("project_sums_match"), F.lit(bool(names) and len(set(names)) == len(names)).alias("distinct_selections"),
        F.lit(set(names) == set(filters)).alias("filters_match"), F.lit(ordering == "project_id, submitter_id, case_id").alias("known_ordering"),
    )


def restrict(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    return rows.join(chosen.select(key).distinct(), key, "left_semi")


def distinct_sorted(rows: DataFrame, column: str | Column) -> DataFrame:
    return rows.select(column).distinct().orderBy(column)
