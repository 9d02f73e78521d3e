"""Skew-triggered Yeo-Johnson transform."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.functions import numeric_columns, yeo_johnson
from lendlens.functions.numeric import quoted, sql_double, sql_name, yeo_johnson_of_log

# Columns that are candidates by name, next to every column whose name contains AMT_
CANDIDATE_NAMES = (
    "AMT_CREDIT",
    "AMT_INCOME_TOTAL",
    "AMT_GOODS_PRICE",
    "AMT_ANNUITY",
    "DAYS_EMPLOYED",
    "CREDIT_INCOME_RATIO",
    "ANNUITY_INCOME_RATIO",
    "CREDIT_GOODS_RATIO",
)
CANDIDATE_PART = "AMT_"
SKEW_LIMIT = 0.5

GRID_POINTS = 21
#: Relative step at which the search for a lambda ends.
CLOSED = 1e-9


def candidates(df: DataFrame) -> list[str]:
    return [c for c in numeric_columns(df) if c in CANDIDATE_NAMES or CANDIDATE_PART in c]


def long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, value) rows of numeric columns: one set of expressions serves every column, so the plan
    does not grow with their number."""
    wide = df.selectExpr(*[f"double({sql_name(c)}) AS {sql_name(c)}" for c in cols])
    return wide.unpivot([], [sql_name(c) for c in cols], "column", "value")


def skew_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Bias-adjusted skewness per column: (column, n, skew). NULL below three values, 0 for a constant."""
    stats = (
        long_form(df, cols)
        .groupBy("column")
        .agg(F.count("value").alias("n"), F.skewness("value").alias("g1"), F.var_pop("value").alias("_var"))
    )
    n = F.col("n").cast("double")
    adjusted = F.col("g1") * F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    return stats.select(
        "column",
        "n",
        F.when(n > 2, F.when(F.col("_var") == 0.0, F.lit(0.0)).otherwise(F.coalesce(adjusted, F.lit(0.0)))).alias(
            "skew"
        ),
    )


def skewed_columns(df: DataFrame, cols: list[str], limit: float = SKEW_LIMIT) -> list[str]:
    chosen = {r["column"] for r in skew_table(df, cols).filter(F.abs("skew") > limit).collect()}
    return [c for c in cols if c in chosen]


def signed_logs(df: DataFrame, cols: list[str]) -> DataFrame:
    """(c, g) rows: the place of the column and sign(x) * log(1 + |x|), from which every power follows."""
    at = F.create_map(*[v for i, c in enumerate(cols) for v in (F.lit(c), F.lit(i))])
    rows = long_form(df, cols).filter("value IS NOT NULL")
    return rows.select(at[F.col("column")].alias("c"), (F.signum("value") * F.log1p(F.abs("value"))).alias("g"))


def likelihood_grid(logs: DataFrame, grids: dict[int, list[float]]) -> DataFrame:
    """Log-likelihood of each column's lambda grid in one pass over ``signed_logs``: (c, lambda, loglik).

    Every value meets the grid of its column; the variances are added up per task before the shuffle,
    which moves one row per task, column and lambda.
    """
    # a column that is no longer searched has an empty grid and drops out
    lists = [f"array({', '.join(map(sql_double, grids[c]))})" if c in grids else "array()" for c in range(max(grids) + 1)]
    grid_of = F.expr(f"cast(array({', '.join(lists)}) AS array<array<double>>)")
    met = logs.select("c", "g", F.explode(F.get(grid_of, F.col("c"))).alias("lam"))
    sums = met.groupBy("c", "lam").agg(
        F.count("*").alias("_n"),
        F.sum("g").alias("_jacobian"),
        F.var_pop(yeo_johnson_of_log(F.col("g"), F.col("lam"))).alias("_v"),
    )
    usable = (F.col("_v") > 0) & ~F.isnan("_v") & (F.abs("_v") != float("inf"))
    return sums.select(
        "c",
        F.col("lam").alias("lambda"),
        # a lambda that overflows has no likelihood and is never chosen
        F.when(usable, -F.col("_n") / 2 * F.log("_v") + (F.col("lam") - 1) * F.col("_jacobian")).alias("loglik"),
    )


def even_grid(lo: float, hi: float, points: int = GRID_POINTS) -> list[float]:
    return [lo + (hi - lo) * i / (points - 1) for i in range(points)]


@dataclass
class _Search:
    """The search for one column, in k = lambda * scale: where the likelihood still rises, where it falls."""

    scale: float  # of g, so that k is about 1 whatever the unit of the column
    shift: float  # g is taken from here where all values have one sign
    sign: float  # -1 where all values are negative: the column is searched mirrored
    mixed: bool
    k: float = 0.0
    rises: float = -math.inf
    falls: float = math.inf
    stride: float = 1.0
    done: bool = False

    def value(self) -> float:
        lam = self.k / self.scale
        return lam if self.sign > 0 else 2.0 - lam

    def move(self, slope: float | None, curve: float | None) -> None:
        """One safeguarded Newton step from the slope and the curvature at k; None where k is out of range."""
        before = self.k
        if slope is None:  # beyond the last k whose powers are numbers
            if before > 0:
                self.falls = min(self.falls, before)
            else:
                self.rises = max(self.rises, before)
        elif slope > 0:
            self.rises = before
        elif slope < 0:
            self.falls = before
        else:
            self.done = True
            return
        step = -slope / curve if slope is not None and curve is not None and curve < 0 else None
        if step is not None and self.rises < before + step < self.falls and abs(step) <= 4 * self.stride:
            self.k = before + step
            self.stride = max(1.0, abs(self.k) / 4, 2 * abs(step))
        elif math.isinf(self.rises) or math.isinf(self.falls):
            self.stride *= 2
            self.k = before + (self.stride if math.isinf(self.falls) else -self.stride)
        else:
            self.k = (self.rises + self.falls) / 2
        self.done = abs(self.k - before) <= CLOSED * max(1.0, abs(self.k)) or not self.rises < self.k < self.falls


def _derivatives(rows: DataFrame) -> DataFrame:
    """Adds f = expm1(e * a) / e and its first and second derivative by e, f1 and f2. Each step is a column of
    its own, so that no power is computed twice."""
    e, a, z = F.col("e"), F.col("a"), F.col("z")
    rows = rows.withColumn("z", e * a)
    rows = rows.withColumns({"near": F.abs(z) < 1e-3, "full": F.exp(z), "less": F.expm1(z)})
    near = F.col("near")
    rows = rows.withColumn(
        "f", F.when(near, a * (1 + z / 2 * (1 + z / 3 * (1 + z / 4)))).otherwise(F.try_divide(F.col("less"), e))
    )
    rows = rows.withColumn(
        "f1",
        F.when(near, a * a * (0.5 + z / 3 + z * z / 8 + z * z * z / 30)).otherwise(
            F.try_divide(a * F.col("full") - F.col("f"), e)
        ),
    )
    f2 = F.when(near, a * a * a * (1 / 3 + z / 4 + z * z / 10 + z * z * z / 36))
    return rows.withColumn("f2", f2.otherwise(F.try_divide(a * a * F.col("full") - 2 * F.col("f1"), e)))


def _slopes(logs: DataFrame, open_: dict[int, _Search]) -> dict[int, tuple[float, float]]:
    """By column, slope and curvature of the log-likelihood a row at its k: one aggregate, one row a column."""

    def of(name: str) -> Column:
        values = ", ".join(sql_double(float(getattr(open_[c], name))) if c in open_ else "NULL" for c in range(max(open_) + 1))
        return F.get(F.expr(f"array({values})"), F.col("c"))

    rows = logs.select("c", (F.col("g") * of("sign")).alias("g"), of("scale").alias("s"), of("shift").alias("m"), of("mixed").alias("x"), of("k").alias("k"))
    rows = rows.where("k IS NOT NULL")
    below = (F.col("x") > 0) & (F.col("g") < 0)
    rows = rows.select("c", "x", "s", "k", ((F.col("g") - F.col("m")) / F.col("s")).alias("u"), below.alias("below"))
    # a value below 0 is the mirrored one under the mirrored power
    rows = rows.withColumns(
        {
            "e": F.when(F.col("below"), 2 * F.col("s") - F.col("k")).otherwise(F.col("k")),
            "a": F.when(F.col("below"), -F.col("u")).otherwise(F.col("u")),
        }
    )
    side = F.when(F.col("below"), -1.0).otherwise(1.0)
    rows = _derivatives(rows).select("c", "x", "u", (F.col("f") * side).alias("y0"), F.col("f1").alias("y1"), (F.col("f2") * side).alias("y2"))
    sums = rows.groupBy("c").agg(
        F.var_pop("y0").alias("v"),
        (2 * F.covar_pop("y0", "y1")).alias("v1"),
        (2 * (F.var_pop("y1") + F.covar_pop("y0", "y2"))).alias("v2"),
        # with a shift the Jacobian's term is part of the variance
        F.max("x").alias("x"),
        F.avg("u").alias("u"),
    )
    out = {}
    for r in sums.collect():
        if all(math.isfinite(r[c]) for c in ("v", "v1", "v2")) and r["v"] > 0:
            ratio = r["v1"] / r["v"]
            out[r["c"]] = (r["u"] * r["x"] - ratio / 2, -(r["v2"] / r["v"] - ratio * ratio) / 2)
    return out


def fit_lambdas(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Maximum-likelihood lambda per column, by Newton's method for all columns at once.

    A pass gives each open column the slope and the curvature of its likelihood in one aggregate. The search
    runs in lambda times the scale of log(1 + |x|), so a column's unit does not matter; it keeps the points
    between which the slope turns, halves their distance where a Newton step would leave it, and ends where
    they or the steps meet. A constant column has no lambda.
    """
    if not cols:
        return {}
    # stays in memory or on local disk between the passes; a lost part is recomputed from the mart
    logs = signed_logs(df, cols).persist()
    try:
        ends = logs.groupBy("c").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.avg("g").alias("m")).collect()
        found: dict[int, _Search] = {}
        for r in ends:
            lo, hi = r["lo"], r["hi"]
            if not lo < hi or not math.isfinite(hi - lo):
                continue
            sign, mixed = (-1.0 if hi <= 0 else 1.0), lo < 0 < hi
            shift = 0.0 if mixed else sign * r["m"]
            scale = max(abs(lo), abs(hi)) if mixed else hi - lo
            # from the untransformed column
            found[r["c"]] = _Search(scale, shift, sign, mixed, k=scale)
        while open_ := {c: s for c, s in found.items() if not s.done}:
            slopes = _slopes(logs, open_)
            for c, search in open_.items():
                search.move(*slopes.get(c, (None, None)))
    finally:
        logs.unpersist()
    return {cols[c]: found[c].value() for c in sorted(found)}


def fit_power(df: DataFrame, cols: list[str] | None = None, limit: float = SKEW_LIMIT) -> dict[str, float]:
    """Lambda of every candidate column that is skewed enough."""
    cols = candidates(df) if cols is None else cols
    return fit_lambdas(df, skewed_columns(df, cols, limit)) if cols else {}


def apply_power(df: DataFrame, lambdas: dict[str, float]) -> DataFrame:
    return df.withColumns({c: yeo_johnson(quoted(c).cast("double"), F.lit(float(v))) for c, v in lambdas.items()})
