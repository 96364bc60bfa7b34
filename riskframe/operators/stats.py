"""Statistics behind the usual risk charts."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.bins import equal_width
from riskframe.operators.joins import group_join
from riskframe.operators.ordered import average_ranks
from riskframe.operators.quantiles import LINEAR, exact_quantiles
from riskframe.session import materialize


# ------------------------------------------------------------------ histograms
def data_range(rows: DataFrame, value: str, bins: int) -> tuple[Column, Column, Column]:
    """Low end, bin width and high end of a column: one min/max aggregate as scalar subqueries."""
    span = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    step = span.select((F.col("hi") - F.col("lo")) / bins).scalar()
    return span.select("lo").scalar(), step, span.select("hi").scalar()


def histogram(df: DataFrame, value: str, bins: int, low: float | None = None, width: float | None = None) -> DataFrame:
    """Equal-width histogram (bin, low, high, cnt), empty bins included.

    Without an explicit range the range is that of the data. The grid has ``bins`` rows.
    """
    spark = df.sparkSession
    rows = df.select(F.col(value).cast("double").alias("__x")).filter(F.col("__x").isNotNull())
    lo, step, hi = data_range(rows, "__x", bins) if low is None else (F.lit(float(low)), F.lit(float(width)), None)
    counts = (
        rows.select(equal_width(F.col("__x"), lo, step, bins, hi).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * step).alias("low"),
        (lo + (F.col("bin") + 1) * step).alias("high"),
        F.coalesce("cnt", F.lit(0)).alias("cnt"),
    )


def histogram_by(df: DataFrame, value: str, by: str, bins: int) -> DataFrame:
    """Counts, percent and density per bin within each group, on one grid over the range of the
    data (non-empty bins only)."""
    rows = df.select(by, F.col(value).cast("double").alias("__x")).na.drop()
    lo, step, hi = data_range(rows, "__x", bins)
    counts = rows.groupBy(by, equal_width("__x", lo, step, bins, hi).alias("bin")).agg(F.count(F.lit(1)).alias("cnt"))
    sizes = counts.groupBy(by).agg(F.sum("cnt").alias("n"))
    share = F.col("cnt") / F.col("n")
    return counts.join(sizes, by).select(
        by, "bin", "cnt", (share * 100).alias("pct"), F.try_divide(share, step).alias("density")
    )


def histogram_2d(df: DataFrame, x: str, y: str, x_bins: int, y_bins: int) -> DataFrame:
    """Counts per cell of a grid over the ranges of both columns (non-empty cells only)."""
    rows = df.select(F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")).na.drop()
    (x_lo, x_step, x_hi), (y_lo, y_step, y_hi) = data_range(rows, "__x", x_bins), data_range(rows, "__y", y_bins)
    cells = rows.select(
        equal_width("__x", x_lo, x_step, x_bins, x_hi).alias("x_bin"),
        equal_width("__y", y_lo, y_step, y_bins, y_hi).alias("y_bin"),
    )
    return cells.groupBy("x_bin", "y_bin").agg(F.count(F.lit(1)).alias("cnt"))


# ------------------------------------------------------------------ box summaries
def box_stats(df: DataFrame, value: str, by: Sequence[str] = (), whis: float = 1.5, **quantile_options) -> DataFrame:
    """Quartiles, whiskers (extreme data within ``whis`` IQRs) and outlier count per group."""
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("__x")).na.drop()
    q = exact_quantiles(rows, "__x", {"q1": 0.25, "med": 0.5, "q3": 0.75}, by, **quantile_options)
    bounds = q.withColumns(
        {
            "__lo": F.col("q1") - whis * (F.col("q3") - F.col("q1")),
            "__hi": F.col("q3") + whis * (F.col("q3") - F.col("q1")),
        }
    )
    if by:
        tagged = group_join(rows, bounds, by)
    else:
        b = bounds.agg(F.first(F.struct(*bounds.columns))).scalar()
        tagged = rows.select("__x", *[b[c].alias(c) for c in bounds.columns])
    inside = F.col("__x").between(F.col("__lo"), F.col("__hi"))
    return tagged.groupBy(*by).agg(
        F.first("n").alias("n"), F.first("q1").alias("q1"), F.first("med").alias("med"),
        F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("__x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("__x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def iqr_outliers(df: DataFrame, value: str, method: str = LINEAR, upper_only: bool = False, whis: float = 1.5, **quantile_options) -> DataFrame:
    """Rows outside the IQR fences."""
    q = exact_quantiles(df, value, {"q1": 0.25, "q3": 0.75}, method=method, **quantile_options)
    iqr = F.col("q3") - F.col("q1")
    high = q.select(F.col("q3") + whis * iqr).scalar()
    cond = F.col(value) > high
    if not upper_only:
        cond = cond | (F.col(value) < q.select(F.col("q1") - whis * iqr).scalar())
    return df.filter(cond)


# ------------------------------------------------------------------ correlation and regression
def correlation_pairs(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Pearson r of every unordered pair of columns, all in one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.groupBy(*by).agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{i}").alias("r"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(*by, F.inline(cells))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Full matrix in long form, diagonal included."""
    half = correlation_pairs(df, columns)
    names = F.array(*[F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns])
    diagonal = df.sparkSession.range(1).select(F.inline(names))
    mirrored = half.select(F.col("b").alias("a"), F.col("a").alias("b"), "r")
    return half.unionByName(mirrored).unionByName(diagonal)


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks for ties.

    The rows are reduced to counts per (x, y) once. Rank tables, one row per distinct value, come from
    these, and the coefficient is the weighted Pearson r of the ranks.
    """
    cells = materialize(df.select(x, y).na.drop().groupBy(x, y).agg(F.count(F.lit(1)).alias("w")), "rank-cells")
    rx = average_ranks(cells, x, weight="w").select(x, F.col("avg_rank").alias("rx"))
    ry = average_ranks(cells, y, weight="w").select(y, F.col("avg_rank").alias("ry"))
    # centre the ranks (their mean is (n + 1) / 2) to keep the sums small
    c = cells.agg((F.sum("w") + 1) / 2.0).scalar()
    # one value may hold many cells: zeros of a column, say
    ranked = group_join(group_join(cells, rx, [x]), ry, [y]).select("w", (F.col("rx") - c).alias("a"), (F.col("ry") - c).alias("b"))
    w, a, b = F.col("w"), F.col("a"), F.col("b")
    return ranked.agg(
        (F.sum(w * a * b) / F.sqrt(F.sum(w * a * a) * F.sum(w * b * b))).alias("rho"),
        F.sum("w").alias("n"),
    )


def linear_fit(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line per table or group."""
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"),
    )


def fitted_line(df: DataFrame, x: str, y: str, points: int) -> DataFrame:
    """The fitted line on an even grid over the range of x."""
    fit = df.agg(
        F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("c"),
        F.min(x).alias("lo"), F.max(x).alias("hi"),
    )
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    grid = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    at = F.col("lo") + F.col("i") * step
    return grid.select("i", at.alias("x"), (F.col("m") * at + F.col("c")).alias("y_hat"))


def residuals(df: DataFrame, x: str, y: str, name: str = "residual") -> DataFrame:
    fit = df.agg(F.struct(F.regr_slope(y, x).alias("m"), F.regr_intercept(y, x).alias("c"))).scalar()
    return df.withColumn(name, F.col(y) - (fit["m"] * F.col(x) + fit["c"]))


def quadratic_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares of y on 1, u, u^2 with u = (x - mean) / std, solved in closed form.

    One aggregate of power sums of the standardised x keeps the 3x3 system well conditioned;
    the coefficients are mapped back to powers of x.
    """
    rows = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    ms = rows.agg(F.struct(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))).scalar()
    u = (F.col("x") - ms["m"]) / ms["s"]
    z = rows.select(u.alias("u"), "y")
    s = lambda p: F.sum(F.pow("u", F.lit(float(p))))
    t = lambda p: F.sum(F.pow("u", F.lit(float(p))) * F.col("y"))
    sums = z.agg(
        F.count(F.lit(1)).cast("double").alias("s0"), *[s(p).alias(f"s{p}") for p in (1, 2, 3, 4)],
        *[t(p).alias(f"t{p}") for p in (0, 1, 2)],
    )
    c = F.col

    def det(m):
        return (
            m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
            - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
        )

    base = [[c(f"s{i + j}") for j in range(3)] for i in range(3)]
    rhs = [c("t0"), c("t1"), c("t2")]

    def with_col(k):
        return [[rhs[i] if j == k else base[i][j] for j in range(3)] for i in range(3)]

    d = det(base)
    centred = sums.select(*[(det(with_col(k)) / d).alias(f"b{k}") for k in range(3)])
    m, sd = ms["m"], ms["s"]
    return centred.select(
        (c("b0") - c("b1") * m / sd + c("b2") * m * m / (sd * sd)).alias("a0"),
        (c("b1") / sd - c("b2") * 2 * m / (sd * sd)).alias("a1"),
        (c("b2") / (sd * sd)).alias("a2"),
    )


def logistic_fit(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 200) -> DataFrame:
    """Unregularised logistic regression by Spark ML: one row per coefficient; an error if it has
    not converged."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = df.select(*features, F.col(label).cast("double").alias("label")).na.drop()
    model = LogisticRegression(regParam=0.0, maxIter=max_iter, tol=1e-12).fit(
        VectorAssembler(inputCols=list(features), outputCol="features").transform(rows)
    )
    if model.summary.totalIterations >= max_iter:
        raise ValueError(f"no convergence in {max_iter} steps: the classes may be separable")
    terms = [("intercept", float(model.intercept))]
    terms += [(f, float(v)) for f, v in zip(features, model.coefficients)]
    return df.sparkSession.createDataFrame(terms, "term string, coefficient double")


# ------------------------------------------------------------------ density
#: Bins per bandwidth, moments kept per bin, and bandwidths beyond which the kernel is nothing.
KDE_BINS, KDE_MOMENTS, KDE_REACH = 10, 6, 9


def kde(df: DataFrame, value: str, by: Sequence[str] = (), points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian density curve per group on an even grid.

    Rows are first reduced to bins of a tenth of the bandwidth, each with the moments of its values
    about the bin's centre. The kernel of a bin is its Hermite expansion in these moments, which
    agrees with the sum over the rows to about 1e-9 of a kernel's height, and reaches only the grid
    points within nine bandwidths, so a long tail adds bins but hardly any cells. Bandwidth is
    ``n ** (-1/5) * stddev_samp``; the grid reaches ``cut`` bandwidths beyond the data.
    Each curve integrates to one; times ``share``, the curves of all groups together do.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("__x")).na.drop()
    stats = (
        rows.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n"), F.min("__x").alias("lo"), F.max("__x").alias("hi"), F.stddev_samp("__x").alias("sd"))
        .withColumn("h", F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("sd"))
        .filter("h > 0")
        .drop("sd")
    )
    known = ["n", "lo", "hi", "h"]
    if by:
        tagged = group_join(rows, stats, by)
    else:
        b = stats.agg(F.first(F.struct(*known))).scalar()
        tagged = rows.select("__x", *[b[c].alias(c) for c in known]).filter("h > 0")
    place = (F.col("__x") - F.col("lo")) / F.col("h") * KDE_BINS
    off = ((F.col("__place") - F.col("bin")) - 0.5) / KDE_BINS
    binned = tagged.withColumn("__place", place).withColumn("bin", F.floor("__place")).withColumn("__d", off)
    powers = [F.lit(1.0)]
    for _ in range(1, KDE_MOMENTS):
        powers.append(powers[-1] * F.col("__d"))
    cells = binned.groupBy(*by, "bin").agg(
        *[F.first(c).alias(c) for c in known], *[F.sum(p).alias(f"__m{k}") for k, p in enumerate(powers)]
    )
    first = F.col("lo") - cut * F.col("h")
    step = (F.col("hi") - F.col("lo") + 2 * cut * F.col("h")) / F.lit(float(points - 1))
    reach = KDE_REACH * F.col("h")
    low = F.greatest(F.lit(0), F.ceil((F.col("centre") - reach - first) / step).cast("int"))
    high = F.least(F.lit(points - 1), F.floor((F.col("centre") + reach - first) / step).cast("int"))
    near = F.when(low <= high, F.sequence(low, high))
    at = cells.withColumn("centre", F.col("lo") + (F.col("bin") + 0.5) / KDE_BINS * F.col("h")).withColumn("i", F.explode(near))
    at = at.withColumn("z", (first + F.col("i") * step - F.col("centre")) / F.col("h"))
    z, polynomial = F.col("z"), F.lit(0.0)
    lower, upper = F.lit(0.0), F.lit(1.0)
    for k in range(KDE_MOMENTS):
        polynomial = polynomial + F.col(f"__m{k}") * upper / math.factorial(k)
        lower, upper = upper, z * upper - k * lower
    heights = at.groupBy(*by, "i").agg(F.sum(F.exp(F.lit(-0.5) * z * z) * polynomial).alias("__sum"))
    grid = stats.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    total = stats.agg(F.sum("n")).scalar()
    return grid.join(heights, [*by, "i"], "left").select(
        *by, "i", (first + F.col("i") * step).alias("x"),
        (F.coalesce("__sum", F.lit(0.0)) / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"),
        (F.col("n") / total).alias("share"),
    )


# ------------------------------------------------------------------ vectors
def per_position(df: DataFrame, vector: str, agg) -> Column:
    """One aggregate per vector position, as a vector-valued scalar subquery.

    The positions combine map-side, and the result is as long as one row's vector.
    """
    cells = df.select(F.posexplode(vector).alias("i", "x"))
    stats = cells.groupBy("i").agg(agg(F.col("x").cast("double")).alias("s"))
    return stats.agg(F.array_sort(F.collect_list(F.struct("i", "s")))["s"]).scalar()


def scale_vectors(df: DataFrame, vector: str, agg) -> DataFrame:
    """Divide every position by its aggregate over the table; no join and no exploded rows."""
    rows = df.withColumn("__s", per_position(df, vector, agg))
    ratio = F.zip_with(vector, "__s", lambda x, s: F.try_divide(x.cast("double"), s))
    return rows.withColumn(vector, ratio).drop("__s")


# ------------------------------------------------------------------ scores
def z_scores(df: DataFrame, columns: Sequence[str], population: bool = False, suffix: str = "_z") -> DataFrame:
    """Standardise columns with global moments from one aggregate (a scalar subquery)."""
    sd = F.stddev_pop if population else F.stddev_samp
    m = df.agg(
        F.struct(*[F.avg(c).alias(f"m_{c}") for c in columns], *[sd(c).alias(f"s_{c}") for c in columns])
    ).scalar()
    return df.withColumns(
        {f"{c}{suffix}": F.try_divide(F.col(c) - m[f"m_{c}"], m[f"s_{c}"]) for c in columns}
    )


def deviation_from_group(df: DataFrame, value: str, by: Sequence[str], name: str = "dev") -> DataFrame:
    """Value minus the mean of its group: an aggregate joined back, so no group sits in one task."""
    means = df.groupBy(*by).agg(F.avg(value).alias("__m"))
    return group_join(df, means, by, "left").withColumn(name, F.col(value) - F.col("__m")).drop("__m")


def stronger_predictor(df: DataFrame, a: str, b: str, target: str) -> DataFrame:
    ra, rb = F.corr(a, target), F.corr(b, target)
    return df.agg(ra.alias("r_a"), rb.alias("r_b")).withColumn(
        "stronger", F.when(F.abs("r_a") > F.abs("r_b"), a).otherwise(b)
    )


def mean_by_bin(df: DataFrame, label: Column, value: str, by: Sequence[str] = ()) -> DataFrame:
    return (
        df.withColumn("bracket", label)
        .filter(F.col("bracket").isNotNull())
        .groupBy(*by, "bracket")
        .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))
    )
