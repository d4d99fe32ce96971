"""Investment risk: outcome metrics, value projection, scenarios and correlated portfolios.

Values follow a lognormal law with drift mu and volatility sigma, so the result of drawing paths is known in closed form:
log V(t)/V0 ~ Normal(m, s^2), m = sum((mu - sigma^2/2) dt), s^2 = sum(sigma^2 dt).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard import settings
from brickyard.functions.quantiles import aggregate_with_quantiles, exact_quantiles, null_safe_join
from brickyard.functions.scalars import normal_cdf, normal_cdf_step, ratio

C = F.col
# standard normal quantiles
Z = {1: -2.3263478740408408, 5: -1.6448536269514722, 25: -0.6744897501960817, 50: 0.0,
     75: 0.6744897501960817, 95: 1.6448536269514722}
FAN = {"p5": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}


def outcome_risk(outcomes: DataFrame, keys: list[str], value: str, initial: float) -> DataFrame:
    """Risk metrics per key over any table of realised outcomes of the same starting value."""
    v = C(value)
    wanted = {"median_value": (value, 0.5), "__p5": (value, 0.05), "__p1": (value, 0.01)}
    aggs = [F.avg(v).alias("mean_value"), F.stddev_pop(v).alias("std_value"), F.min(v).alias("min_value"),
            F.max(v).alias("max_value"), F.avg((v < initial).cast("double")).alias("prob_loss"),
            F.avg(((v - initial) / initial > 0.20).cast("double")).alias("prob_gain_20pct")]
    base = aggregate_with_quantiles(outcomes, keys, aggs, wanted)
    tail = null_safe_join(outcomes.select(*keys, value), base.select(*keys, "__p5"), keys, "inner").where(v <= C("__p5"))
    out = null_safe_join(base, tail.groupBy(*keys).agg(F.avg(value).alias("__tail")), keys)
    return out.withColumns({
        "mean_return": (C("mean_value") - initial) / initial,
        "median_return": (C("median_value") - initial) / initial,
        "var_95": initial - C("__p5"), "var_99": initial - C("__p1"), "cvar_95": initial - C("__tail"),
        "sharpe_ratio": F.when(C("std_value") > 0, (C("mean_value") - initial) / C("std_value")).otherwise(0.0),
    }).drop("__p5", "__p1", "__tail")


def percentile_fan(outcomes: DataFrame, step: str, value: str) -> DataFrame:
    """5, 25, 50, 75 and 95 percent quantiles per time step."""
    return exact_quantiles(outcomes, [step], {name: (value, p) for name, p in FAN.items()})


def _law(df: DataFrame, m: Column, s: Column) -> DataFrame:
    """Mean, quantiles and risk of value * exp(m + s Z).

    Each step reads what the last one has computed more than once, so Spark keeps the steps apart: in one step their generated method passes the
    8,000 bytes above which the JVM interprets it, a hundred times slower.
    """
    v0, columns = C("value"), df.columns
    levels = {"loss": math.log(1.0), "gain": math.log(1.2)}  # P(V < level * V0)
    df = df.withColumns({"__m": m, "__s": s})
    m, s = C("__m"), C("__s")
    spread = s > 0

    def quantile(z: float) -> Column:
        return v0 * F.exp(m + s * z)

    df = df.withColumns({
        "__mean": v0 * F.exp(m + s * s / 2), "__low": quantile(Z[5]), "__spread": F.sqrt(F.expm1(s * s)), "__x_tail": F.when(spread, F.lit(Z[5]) - s),
        **{f"__x_{name}": F.when(spread, (F.lit(level) - m) / s) for name, level in levels.items()},
    })
    chances = ["tail", *levels]
    df = df.withColumns({f"__t_{name}": normal_cdf_step(C(f"__x_{name}")) for name in chances})
    df = df.withColumns({"__std": C("__mean") * C("__spread"), **{f"__p_{name}": normal_cdf(C(f"__x_{name}"), C(f"__t_{name}")) for name in chances}})
    mean, std = C("__mean"), C("__std")

    out = {
        "expected_value": mean, "std_value": std, "expected_return": mean / v0 - 1,
        **{name: C("__low") if name == "p5" else quantile(Z[int(name[1:])]) for name in FAN},
        "var_95": v0 - C("__low"), "var_99": v0 - quantile(Z[1]), "cvar_95": v0 - F.when(spread, mean * C("__p_tail") / 0.05).otherwise(mean),
        "prob_loss": F.when(spread, C("__p_loss")).otherwise(F.when(m < levels["loss"], 1.0).otherwise(0.0)),
        "prob_gain_20pct": F.when(spread, 1 - C("__p_gain")).otherwise(F.when(m > levels["gain"], 1.0).otherwise(0.0)),
        "sharpe_ratio": F.when(spread, (mean - v0) / std).otherwise(0.0),
    }
    return df.select(*[c for c in columns if c not in out], *[e.alias(n) for n, e in out.items()])


def macro_path(months: int, macro: dict | None = None) -> list[tuple[int, float, float]]:
    """(month, sum of drift shifts, sum of squared volatility factors), both in years, for the whole horizon.

    `macro` may hold `rate_hike` with `rate_impact` and `recession` with `recession_impact` (yearly lists) and
    `vol_multiplier`; an impact list counts only when its key is there.
    """
    macro = macro or {}
    rates = macro.get("rate_impact", []) if "rate_hike" in macro else []
    slump = macro.get("recession_impact", []) if "recession" in macro else []
    out, drift, variance = [(0, 0.0, 0.0)], 0.0, 0.0
    for t in range(months):
        year = t // 12
        drift += (rates[year] if year < len(rates) else 0.0) / 12 + (slump[year] if year < len(slump) else 0.0) / 12
        variance += (macro.get("vol_multiplier", 1.5) if year < len(slump) else 1.0) ** 2 / 12
        out.append((t + 1, drift, variance))
    return out


def spread_out(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores: a small file, whose every row becomes many, is read by a task or two."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def project_values(holdings: DataFrame, months: int = settings.HORIZON_YEARS * 12, macro: dict | None = None, every: int = 1) -> DataFrame:
    """Value law of every holding at every month (0..months), under an optional macro path."""
    steps = F.array(*[F.struct(F.lit(t).alias("month"), F.lit(a).alias("shift"), F.lit(b).alias("time"))
                      for t, a, b in macro_path(months, macro) if t % every == 0])
    rows = spread_out(holdings).withColumn("__step", F.explode(steps)).select("*", "__step.*").drop("__step")
    m = C("drift") * C("month") / 12 + C("shift") - C("vol") * C("vol") / 2 * C("time")
    return _law(rows, m, C("vol") * F.sqrt("time")).drop("shift", "time")


def scenario_grid(holdings: DataFrame, years: int = settings.HORIZON_YEARS) -> DataFrame:
    """Every holding under each scenario at the horizon. The five scenarios are literals, so rows are only multiplied."""
    grid = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(shift).alias("shift"),
                 F.lit(fixed).cast("double").alias("fixed"), F.lit(factor).alias("factor"))
        for name, (shift, fixed, factor) in settings.SCENARIOS.items()])
    rows = holdings.withColumn("__s", F.explode(grid)).select("*", "__s.*").drop("__s")
    rows = rows.withColumns({"drift": F.coalesce(C("fixed"), C("drift") + C("shift")), "vol": C("vol") * C("factor")})
    return _law(rows.drop("shift", "fixed", "factor"), (C("drift") - C("vol") * C("vol") / 2) * years, C("vol") * math.sqrt(years))


def portfolio_risk(
    holdings: DataFrame, years: float = settings.HORIZON_YEARS, rho: float = settings.PORTFOLIO_RHO, terms: int | None = None,
) -> DataFrame:
    """Mean, deviation, VaR and diversification of portfolios of correlated holdings, without pairing holdings.

    With A_i = V_i exp(mu_i T), Cov_ij = A_i A_j (exp(rho T s_i s_j) - 1) = sum_k (rho T)^k / k! (A_i s_i^k)(A_j s_j^k). Summed over
    pairs each term is a square of a sum, so one aggregation gives the variance; the diagonal (correlation one) is set right
    apart. The series runs until its terms for the largest volatility (found by one pass while the plan is built) fall below 1e-15 of their sum, so mean,
    deviation and benefit are exact to rounding; VaR and loss probability take the sum as lognormal with the same two moments (an approximation).
    """
    c = rho * years
    if terms is None:
        x = abs(c) * float(holdings.agg(F.max(C("vol") * C("vol"))).first()[0] or 0.0)
        term, total, terms = x, x, 1
        while term > 1e-15 * total:
            terms += 1
            term *= x / terms
            total += term
    a = C("value") * F.exp(C("drift") * years)
    var = C("vol") * C("vol") * years
    rows = holdings.withColumns({"__a": a, "__own": a * a * (F.expm1(var) - F.expm1(var * rho)), "__sd": a * F.sqrt(F.expm1(var))})
    moments = [F.sum(C("__a") * F.pow(C("vol"), F.lit(k))).alias(f"__m{k}") for k in range(1, terms + 1)]
    out = rows.groupBy("portfolio_id").agg(
        F.count(F.lit(1)).alias("n_holdings"), F.sum("value").alias("value"), F.sum("__a").alias("mean_value"),
        F.sum("__own").alias("__own"), F.sum("__sd").alias("__sum_sd"), *moments)
    shared = sum((C(f"__m{k}") * C(f"__m{k}") * (c ** k / math.factorial(k)) for k in range(1, terms + 1)), F.lit(0.0))
    out = out.withColumn("std_value", F.sqrt(shared + C("__own")))
    s2 = F.log1p(ratio(C("std_value") * C("std_value"), C("mean_value") * C("mean_value")))
    out = out.withColumns({"__s": F.sqrt(s2), "__m": F.log(C("mean_value") / C("value")) - s2 / 2})
    loss = F.when(C("__s") > 0, normal_cdf(-C("__m") / C("__s"))).otherwise((C("__m") < 0).cast("double"))
    return out.select(
        "portfolio_id", "n_holdings", C("value").alias("initial_value"), "mean_value", "std_value",
        (C("mean_value") / C("value") - 1).alias("mean_return"),
        (C("value") * (1 - F.exp(C("__m") + C("__s") * Z[5]))).alias("var_95"), loss.alias("prob_loss"),
        F.when(C("__sum_sd") > 0, (C("__sum_sd") - C("std_value")) / C("__sum_sd")).otherwise(0.0).alias("diversification_benefit"))
