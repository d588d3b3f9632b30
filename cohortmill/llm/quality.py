"""Quality rules with robust multivariate outliers (minimum covariance determinant), in DataFrame functions only.

Every document gets five text statistics. Their ratios (logs, or scaled shares) form a vector; per language and source the
minimum-covariance-determinant (MCD) location and scatter are estimated by concentration steps, and a document whose
Mahalanobis distance exceeds a chi-square quantile is rejected.

All sums run over integers (the vectors are fixed-point), so the estimates do not depend on partitioning or row order.
A step is one aggregation by group and bin of distance (bins are bounded by construction) and a window over the bins, so
a group holding a third of all rows costs nothing special. Groups of any size get estimates: a group's sums are joined by
those of ``prior`` rows of its language, and a language's by those of ``prior`` rows of the whole table.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .common import carried, materialize, restored, small_side

SPACE = r"[\x20\x09-\x0D]+"
#: Fixed-point units of one natural-log unit.
SCALE = 256
#: The vector's components and the least standard deviation that a group is given in each. Log units for the first two;
#: shares of lines and words are linear, so that each reaches the limit (6.5 deviations) alone, at the floor from 37 % and
#: 17 % on, in groups that hold no such texts (words in repeated windows over 20 % fail the base rule).
FEATURES = (("z_length", 0.12), ("z_symbols", 0.30), ("z_lines", 0.45), ("z_repeats", 0.45))


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines`` (long); null text counts as empty.

    Extra columns are kept. Work and memory are linear in the text but for a sort of the windows of those texts that
    repeat a five-word window.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("_words", F.array_remove(F.split(body, SPACE), ""))
    step = step.withColumn("_lines", F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 5),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(5)]),
    )
    step = step.withColumn("_win", F.when(F.size("_words") >= 6, windows))
    repeated = F.size(F.array_distinct("_win")) < F.size("_win")
    step = step.withColumn(
        "_sorted", F.when(repeated, F.sort_array(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    )
    twice = F.filter(
        "_sorted",
        lambda e, k: (e["h"] == F.get(F.col("_sorted"), k - 1)["h"]) | (e["h"] == F.get(F.col("_sorted"), k + 1)["h"]),
    )
    step = step.withColumn("_at", F.sort_array(F.transform(twice, lambda e: e["i"])))
    covered = F.aggregate(
        F.transform("_at", lambda x, k: F.coalesce(F.least(F.get(F.col("_at"), k + 1) - x, F.lit(5)), F.lit(5))),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    return step.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]", ""))).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    ).drop("_words", "_lines", "_win", "_sorted", "_at")


def _fixed(x: Column) -> Column:
    return F.floor(x * SCALE + 0.5).cast("long")


def _vector() -> dict[str, Column]:
    n = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "z_length": _fixed(F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n)),
        "z_symbols": _fixed(F.log1p(F.lit(100.0) * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1)))),
        "z_lines": _fixed(F.lit(8.0) * F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "z_repeats": _fixed(F.lit(18.0) * F.col("n_repeat_words") / n),
    }


def chi2_cdf(x: float, dof: int) -> float:
    """Regularised lower incomplete gamma function at (dof / 2, x / 2), by its series."""
    a, y = dof / 2, x / 2
    if y <= 0:
        return 0.0
    term = total = 1 / a
    k = a
    while term > total * 1e-15:
        k += 1
        term *= y / k
        total += term
    return min(1.0, total * math.exp(a * math.log(y) - y - math.lgamma(a)))


def chi2_quantile(q: float, dof: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dof) < q else (low, mid)
    return (low + high) / 2


# Expressions below are written as SQL text: one call to the JVM for each, instead of one for each of its operators.


def _moments(names: list[str]) -> dict[str, str]:
    """Sums of the components and of their products, by name."""
    p = range(len(names))
    return {f"s{j}": names[j] for j in p} | {f"s{j}_{k}": f"{names[j]} * {names[k]}" for j in p for k in p if j <= k}


def _shrunk(sums: DataFrame, names: list[str], prior: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """From sums per ``_start`` and ``_grp``: means ``m*``, the Cholesky factor ``l*`` of the covariance, drawn towards the language's and the table's, and ``carry``."""
    p = len(names)
    keys = list(_moments(names))
    langs = sums.groupBy(F.col("_start").alias("_of"), F.expr("_grp._lang AS _lang")).agg(F.expr("sum(n) AS nl"), *[F.expr(f"sum({x}) AS l_{x}") for x in keys])
    # a row a start; the numbers stay columns, since literals would make the code of every step another one, which the driver compiles and keeps
    total = langs.groupBy(F.col("_of").alias("_all")).agg(F.expr("sum(nl) AS nt"), *[F.expr(f"sum(l_{x}) AS t_{x}") for x in keys])
    step = sums.join(F.broadcast(langs), F.expr("_start = _of AND _grp._lang <=> _lang")).join(F.broadcast(total), F.expr("_start = _all"))
    mean = lambda x: f"coalesce(CAST(t_{x} AS DOUBLE), 0D) / CAST(greatest(coalesce(nt, 1L), 1L) AS DOUBLE)"
    step = step.selectExpr("_start", "_grp", *carry, *[f"({x} + {prior}D * (l_{x} + {prior}D * ({mean(x)})) / (nl + {prior}D)) / (n + {prior}D) AS {x}" for x in keys])
    floor = dict(FEATURES)
    for k in range(p):
        less = lambda j: "".join(f" - l{j}_{i} * l{k}_{i}" for i in range(k))  # noqa: B023, E731
        step = step.selectExpr("*", f"sqrt(greatest(greatest(s{k}_{k} - s{k} * s{k}, 0D) + {(floor[names[k]] * SCALE) ** 2!r}D{less(k)}, 1e-3D)) AS l{k}_{k}")
        if k + 1 < p:
            step = step.selectExpr("*", *[f"(s{k}_{j} - s{k} * s{j}{less(j)}) / l{k}_{k} AS l{j}_{k}" for j in range(k + 1, p)])
    return step.selectExpr("_start", "_grp", *carry, *[f"s{j} AS m{j}" for j in range(p)], *[f"l{j}_{k}" for j in range(p) for k in range(j + 1)])


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[str] = []
    for j, x in enumerate(names):
        solved.append(f"(({x} - m{j}{''.join(f' - l{j}_{k} * {y}' for k, y in enumerate(solved))}) / l{j}_{j})")
    return F.expr(" + ".join(f"{y} * {y}" for y in solved))


#: A group's estimate has settled when the logarithm of its determinant falls by less than this in a step; the most steps.
SETTLED, MOST_STEPS = 1e-3, 20


def _log_determinant(p: int) -> str:
    return f"2D * ({' + '.join(f'ln(l{j}_{j})' for j in range(p))})"


def _concentrate(vectors: DataFrame, params: DataFrame, names: list[str], support: float, prior: int) -> DataFrame:
    """Concentration steps from the ``params`` of every ``_start`` until no group's determinant falls any more: ``best`` estimates.

    The ``support`` share of each group with the smallest distances gives the next mean and covariance. Distances are
    binned (1/64 of a doubling) with their counts and sums, so a step reads the vectors once for all starts; the bin in
    which the share is reached counts in full. A group keeps, of each start, the estimate of its smallest determinant
    (``best``: logdet, then ``v``). A start is left out of the steps once none of its groups falls.
    """
    moments, p = _moments(names), len(names)
    values = f"struct({', '.join([*(f'm{j}' for j in range(p)), *(f'l{j}_{k}' for j in range(p) for k in range(j + 1))])})"
    of = f"struct({_log_determinant(p)} AS logdet, {values} AS v)"
    # the starts need not be estimates of the share, so they are no candidates
    params = materialize(params.selectExpr("*", f"if(false, {of}, NULL) AS best"), "mcd-start")
    groups, settled = params.groupBy("_grp").agg(F.count("*").alias("n")).count(), []
    starts = sorted(r[0] for r in params.select("_start").distinct().collect())
    for k in range(MOST_STEPS if starts else 0):
        binned = vectors.join(small_side(params.drop("best"), len(starts) * groups), "_grp").withColumn("_bin", F.floor(64 * F.log2(1 + _distance(names))).cast("int"))
        sums = binned.groupBy("_start", "_grp", "_bin").agg(F.expr("count(*) AS n"), *[F.expr(f"sum({c}) AS {x}") for x, c in moments.items()])
        upto = sums.selectExpr("*", "sum(n) OVER (PARTITION BY _start, _grp ORDER BY _bin) - n AS _before", "sum(n) OVER (PARTITION BY _start, _grp) AS _rows")
        chosen = upto.filter(f"_before < {support}D * _rows").groupBy("_start", "_grp").agg(F.expr("sum(n) AS n"), *[F.expr(f"sum({x}) AS {x}") for x in moments])
        chosen = materialize(chosen.join(small_side(params.select("_start", "_grp", "best"), len(starts) * groups), ["_start", "_grp"]), "mcd-step")
        seen = Observation()
        new = _shrunk(chosen, names, prior, ("best",)).withColumn("new", F.expr(of))
        fallen = [F.max(F.when(F.col("_start") == x, F.expr("best.logdet - new.logdet"))).alias(f"fallen{x}") for x in starts]
        new = new.observe(seen, *fallen).withColumn("best", F.expr("CASE WHEN best IS NULL OR new.logdet < best.logdet THEN new ELSE best END")).drop("new")
        params = materialize(new, "mcd-params")
        if k:
            fell = seen.get
            done = [x for x in starts if fell[f"fallen{x}"] is None or fell[f"fallen{x}"] < SETTLED]
            settled += [params.filter(F.col("_start") == x) for x in done]
            starts = [x for x in starts if x not in done]
            if not starts:
                break
            params = params.filter(F.col("_start").isin(starts)) if done else params
    left = [params] if starts or not settled else []
    return reduce(DataFrame.unionByName, settled + left).select("_start", "_grp", "best")


def mcd(vectors: DataFrame, names: list[str], *, support: float = 0.75, prior: int = 60) -> DataFrame:
    """MCD location and scatter per ``_grp`` (language and source) of integer ``vectors``: columns ``m*``, ``l*`` and ``logdet``.

    Concentration steps run from two starts, medians with floored quartile distances and the moments of all rows, each
    until the determinant stops falling; each group takes the estimate with the smaller determinant. Both starts take
    their steps in the same jobs, since each plan costs the driver memory.
    """
    p = range(len(names))
    moments, floor = _moments(names), dict(FEATURES)
    quarters = [F.expr(f"percentile({x}, array(0.25D, 0.5D, 0.75D)) AS q{j}") for j, x in enumerate(names)]
    whole = materialize(vectors.groupBy("_grp").agg(F.expr("0 AS _start"), *quarters, F.expr("count(*) AS n"), *[F.expr(f"sum({c}) AS {x}") for x, c in moments.items()]), "mcd-moments")
    spread = [f"greatest((q{j}[2] - q{j}[0]) / 1.349D, {floor[x] * SCALE!r}D)" for j, x in enumerate(names)]
    robust = whole.selectExpr("1 AS _start", "_grp", *[f"q{j}[1] AS m{j}" for j in p], *[f"{spread[j] if j == k else '0D'} AS l{j}_{k}" for j in p for k in range(j + 1)])
    plain = _shrunk(whole, names, prior)
    least = _concentrate(vectors, robust.unionByName(plain), names, support, prior).groupBy("_grp").agg(F.min("best").alias("x"))  # ties have equal determinants
    return materialize(least.select("_grp", "x.logdet", "x.v.*"), "mcd-last")


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")


def quality_rules(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    keep: tuple[str, ...] = ("doc_id",),
    prior: int = 60,
    support: float = 0.75,
    quantile: float = 0.99999,
) -> DataFrame:
    """``keep`` columns, the five statistics, ``base_failed``, ``distance`` (null without a verdict) and ``kept``.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in repeated five-word windows. All other
    documents are held against their language and source, whose estimates are drawn towards the language's and the
    table's by ``prior`` rows each. Null languages and sources are groups of their own. Null or empty texts have zero
    words and fail the base rule; an empty table gives no rows; repeated rows are judged alike, each on its own. A kept
    column named like a result gives way to the result.
    """
    names = [x for x, _ in FEATURES]
    rows = carried(docs, keep, _lang=F.col(lang), _source=F.col(source), _text=F.col(text))
    stats = text_statistics(rows, "_text").drop("_text").withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    stats = stats.withColumns(_vector()).withColumn("_grp", F.struct("_lang", "_source")).drop("_lang", "_source")
    stats = materialize(stats, "quality-stats")
    params = mcd(stats.filter(~F.col("base_failed")).select("_grp", *names), names, support=support, prior=prior)
    p = len(names)
    radius = chi2_quantile(support, p)
    consistency = support / chi2_cdf(radius, p + 2)
    limit = chi2_quantile(quantile, p) * consistency
    out = stats.join(small_side(params, params.count()), "_grp", "left")
    out = out.withColumn("distance", F.when(~F.col("base_failed"), _distance(names) / consistency))
    out = out.withColumn("kept", F.coalesce(~F.col("base_failed") & (F.col("distance") * consistency <= limit), F.lit(False)))
    return restored(out, keep, RESULTS)
