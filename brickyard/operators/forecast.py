"""Unit-root test and forecasting models, one small solve per segment.

Spark builds the monthly series, aligns the macro columns and hands each segment (a few hundred months at most) to one
`applyInPandas` call; many segments run in parallel.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard import settings

# --- fixed values: MacKinnon response surfaces, constant, one series -----------------------------
_TAU_MIN, _TAU_STAR, _TAU_MAX = -18.83, -1.61, 2.74
_SMALL_P = (2.1659, 1.4412, 0.038269)
_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
_CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
# --- end of fixed values -------------------------------------------------------------------------


def _least_squares(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    resid = y - x @ beta
    return beta, resid, float(resid @ resid)


def _phi(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def unit_root_p_value(stat: float) -> float:
    if stat > _TAU_MAX:
        return 1.0
    if stat < _TAU_MIN:
        return 0.0
    coef = _SMALL_P if stat <= _TAU_STAR else _LARGE_P
    return _phi(sum(c * stat ** i for i, c in enumerate(coef)))


def _lag_design(y: np.ndarray, lags: int, skip: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows t = skip+1.. of: dy_t on [y_{t-1}, dy_{t-1}.., dy_{t-lags}, 1]."""
    dy = np.diff(y)
    rows = np.arange(skip, len(dy))
    cols = [y[rows]] + [dy[rows - k] for k in range(1, lags + 1)] + [np.ones(len(rows))]
    return np.column_stack(cols), dy[rows]


def unit_root_test(y: np.ndarray) -> dict:
    """Augmented Dickey-Fuller with a constant; the lag count has the lowest AIC on a common sample."""
    n = len(y)
    top = max(0, min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2))
    best, best_aic = 0, math.inf
    for lags in range(top + 1):
        x, dy = _lag_design(y, lags, top)
        *_, ssr = _least_squares(x, dy)
        m = len(dy)
        aic = m * (math.log(2 * math.pi) + math.log(max(ssr, 1e-300) / m) + 1) + 2 * x.shape[1]
        if aic < best_aic - 1e-9:
            best, best_aic = lags, aic
    x, dy = _lag_design(y, best, best)
    beta, _, ssr = _least_squares(x, dy)
    m = len(dy)
    se = math.sqrt(ssr / (m - x.shape[1]) * np.linalg.pinv(x.T @ x)[0, 0])
    stat = float(beta[0] / se) if se > 0 else 0.0
    out = {"adf_statistic": stat, "p_value": unit_root_p_value(stat), "n_lags": best, "n_observations": m}
    out.update({k: sum(c / m ** i for i, c in enumerate(v)) for k, v in _CRITICAL.items()})
    return out


def stationarity(series: DataFrame, key: str, value: str, least: int = 20) -> DataFrame:
    """Unit-root test per segment; segments with fewer than `least` observations are left out."""

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        y = pdf.sort_values("period")[value].to_numpy(float)
        if len(y) < least:
            return pd.DataFrame(columns=names)
        return pd.DataFrame([{key: pdf[key].iloc[0], **unit_root_test(y)}])[names]

    names = [key, "adf_statistic", "p_value", "n_lags", "n_observations", "crit_1", "crit_5", "crit_10"]
    schema = f"{key} string, adf_statistic double, p_value double, n_lags int, n_observations int, crit_1 double, crit_5 double, crit_10 double"
    known = series.where(F.col(value).isNotNull() & F.col(key).isNotNull()).select(key, "period", value)
    out = known.groupBy(key).applyInPandas(solve, schema)
    return out.withColumn("is_stationary", (F.col("p_value") < 0.05).cast("int"))


# --- seasonal ARMA by exact likelihood -------------------------------------------------------------
def _differences(y: np.ndarray, season: int) -> np.ndarray:
    """(1 - B)(1 - B^season) y, without the first season + 1 places."""
    return y[season + 1:] - y[season:-1] - y[1:-season] + y[:-season - 1]


def _polynomials(phi: float, seasonal_phi: float, theta: float, seasonal_theta: float, season: int) -> tuple[np.ndarray, np.ndarray]:
    """Autoregressive and moving-average polynomials in the lag, constant first."""
    def factor(x: float, lag: int) -> np.ndarray:
        return np.concatenate([[1.0], np.zeros(lag - 1), [x]])

    return np.convolve(factor(-phi, 1), factor(-seasonal_phi, season)), np.convolve(factor(theta, 1), factor(seasonal_theta, season))


class StateSpace:
    """A stationary ARMA process with unit shocks as a state of max(p, q + 1) numbers whose first one is observed."""

    def __init__(self, ar: np.ndarray, ma: np.ndarray):
        r = max(len(ar) - 1, len(ma))
        self.phi, self.gain = np.zeros(r), np.zeros(r)
        self.phi[:len(ar) - 1], self.gain[:len(ma)] = -ar[1:], ma
        self.noise = np.outer(self.gain, self.gain)
        # the stationary covariance, sum of T^k R R' T'^k, by doubling
        step, total = np.zeros((r, r)), self.noise.copy()
        step[:, 0] = self.phi
        step[np.arange(r - 1), np.arange(1, r)] = 1.0
        for _ in range(40):
            more = step @ total @ step.T
            total = total + more
            step = step @ step
            if np.abs(more).max() <= 1e-13 * np.abs(total).max():
                break
        self.start = total

    def move(self, x: np.ndarray) -> np.ndarray:
        """The transition times each column of x."""
        out = np.outer(self.phi, x[0])
        out[:-1] += x[1:]
        return out

    def filter(self, series: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """One-step errors of each column over the root of their variance, these variances, the last state's means and its covariance."""
        state, cov = np.zeros((len(self.phi), series.shape[1])), self.start
        errors, variances = np.empty(series.shape), np.empty(len(series))
        for t, row in enumerate(series):
            f = max(cov[0, 0], 1e-12)
            error, gain = row - state[0], cov[:, 0] / f
            errors[t], variances[t] = error / math.sqrt(f), f
            state = self.move(state + np.outer(gain, error))
            cov = self.move(self.move(cov - np.outer(gain, gain) * f).T).T + self.noise
        return errors, variances, state, cov


def gaussian_fit(space: StateSpace, w: np.ndarray, x: np.ndarray | None) -> tuple[float, np.ndarray, float, np.ndarray, np.ndarray]:
    """Exact log-likelihood at its best regression coefficients and shock variance; these two, and the state after the last observation."""
    columns = w[:, None] if x is None else np.column_stack([w, x])
    errors, variances, state, cov = space.filter(columns)
    beta = np.linalg.lstsq(errors[:, 1:], errors[:, 0], rcond=1e-9)[0] if columns.shape[1] > 1 else np.empty(0)
    left = errors[:, 0] - errors[:, 1:] @ beta
    n, sigma2 = len(w), max(float(left @ left) / len(w), 1e-300)
    likelihood = -0.5 * (n * (math.log(2 * math.pi * sigma2) + 1) + float(np.log(variances).sum()))
    return likelihood, beta, sigma2, state[:, 0] - state[:, 1:] @ beta, cov


def simplex(loss, start: np.ndarray, size: float = 0.4, steps: int = 300, tolerance: float = 1e-5) -> tuple[np.ndarray, float]:
    """Nelder and Mead's search for the least loss."""
    points = [start, *(start + size * e for e in np.eye(len(start)))]
    values = [loss(p) for p in points]
    for _ in range(steps):
        order = np.argsort(values)
        points, values = [points[i] for i in order], [values[i] for i in order]
        if values[-1] - values[0] < tolerance:
            break
        middle = np.mean(points[:-1], axis=0)
        mirrored = middle + (middle - points[-1])
        value = loss(mirrored)
        if value < values[0]:
            far = middle + 2 * (middle - points[-1])
            farther = loss(far)
            points[-1], values[-1] = (far, farther) if farther < value else (mirrored, value)
        elif value < values[-2]:
            points[-1], values[-1] = mirrored, value
        else:
            near = middle + 0.5 * ((mirrored if value < values[-1] else points[-1]) - middle)
            nearer = loss(near)
            if nearer < min(value, values[-1]):
                points[-1], values[-1] = near, nearer
            else:
                points = [points[0], *(points[0] + 0.5 * (p - points[0]) for p in points[1:])]
                values = [values[0], *(loss(p) for p in points[1:])]
    best = int(np.argmin(values))
    return points[best], values[best]


class SeasonalArma:
    """(1,1,1)(1,1,1,s) with regressors by exact Gaussian likelihood of the differenced series, from a Kalman filter in state-space form.

    The four coefficients are searched inside the stationary and invertible region; the regression and the shock variance follow from them by generalised least squares.
    """

    def __init__(self, y: np.ndarray, exog: np.ndarray | None, season: int):
        self.y, self.season = np.asarray(y, float), season
        self.exog = None if exog is None or not exog.shape[1] else np.asarray(exog, float)
        w = _differences(self.y, season)
        self.scale = float(w.std()) or 1.0
        dx = None
        if self.exog is not None:
            dx = np.column_stack([_differences(c, season) for c in self.exog.T])
            self.unit = dx.std(axis=0) + 1e-12
            dx = dx / self.unit
        if len(w) < 8 + (0 if dx is None else dx.shape[1]):
            raise ValueError("too few observations")

        def at(u: np.ndarray) -> StateSpace:
            return StateSpace(*_polynomials(*np.tanh(u), season))

        fits = [simplex(lambda u: -gaussian_fit(at(u), w / self.scale, dx)[0], np.array(start)) for start in ((0.0, 0.0, 0.0, 0.0), (0.3, 0.2, -0.8, -0.8))]
        self.coefficients = np.tanh(min(fits, key=lambda f: f[1])[0])
        self.space = StateSpace(*_polynomials(*self.coefficients, season))
        scaled, beta, sigma2, self.state, self.cov = gaussian_fit(self.space, w / self.scale, dx)
        self.loglik = scaled - len(w) * math.log(self.scale)
        self.beta, self.sigma2 = beta * self.scale / (1.0 if dx is None else self.unit), sigma2 * self.scale**2
        k = 5 + len(beta)
        self.aic, self.bic = 2 * k - 2 * self.loglik, k * math.log(len(w)) - 2 * self.loglik

    def forecast(self, steps: int, future: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Point forecasts and standard errors. Missing future regressors keep their last value."""
        s, n = self.season, len(self.y)
        level = self.y - self.exog @ self.beta if self.exog is not None else self.y
        out, state = list(level), self.state[:, None] * self.scale
        for t in range(n, n + steps):
            out.append(state[0, 0] + out[t - 1] + out[t - s] - out[t - s - 1])
            state = self.space.move(state)
        point = np.array(out[n:])
        if self.exog is not None:
            point = point + (np.repeat(self.exog[-1:], steps, axis=0) if future is None else np.asarray(future, float)) @ self.beta
        # response of the level to a unit shock
        ar, ma = _polynomials(*self.coefficients, s)
        ar = np.convolve(np.convolve(ar, [1.0, -1.0]), np.concatenate([[1.0], np.zeros(s - 1), [-1.0]]))
        response = np.zeros(steps)
        for h in range(steps):
            response[h] = (ma[h] if h < len(ma) else 0.0) - sum(ar[k] * response[h - k] for k in range(1, min(h, len(ar) - 1) + 1))
        return point, np.sqrt(self.sigma2 * np.cumsum(response**2))


def seasonal_arma(
    series: DataFrame, key: str, value: str, exog: list[str] | None = None, season: int = settings.SEASON,
    horizon: int = settings.FORECAST_MONTHS,
) -> DataFrame:
    """Hold-out predictions and future forecasts per segment in one table.

    kind 'holdout': the last fifth, predicted from the first four fifths, with likelihood, aic and bic of that fit.
    kind 'future': `horizon` months past the end from a fit on everything, with a 95 percent band.
    Segments too short for the differences are left out.
    """
    exog = exog or []

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        y, x = pdf[value].to_numpy(float), pdf[exog].to_numpy(float)
        cut = int(len(y) * 0.8)
        if cut < 2 * season + 8 or np.isnan(x).any():
            return pd.DataFrame(columns=names)
        parts = []
        for kind, m in (("holdout", cut), ("future", len(y))):
            steps = len(y) - cut if kind == "holdout" else horizon
            model = SeasonalArma(y[:m], x[:m], season)
            point, se = model.forecast(steps, x[m:] if kind == "holdout" else None)
            last = pd.Timestamp(pdf["period"].iloc[m - 1])
            periods = (list(pdf["period"].iloc[m:]) if kind == "holdout"
                       else [(last + pd.DateOffset(months=h + 1)).date() for h in range(steps)])
            parts.append(pd.DataFrame({
                key: pdf[key].iloc[0], "kind": kind, "period": periods,
                "actual": y[m:] if kind == "holdout" else [None] * steps, "forecast": point,
                "ci_lower": point - 1.959964 * se, "ci_upper": point + 1.959964 * se,
                "loglik": model.loglik, "aic": model.aic, "bic": model.bic, "n_train": m}))
        return pd.concat(parts)[names]

    names = [key, "kind", "period", "actual", "forecast", "ci_lower", "ci_upper", "loglik", "aic", "bic", "n_train"]
    schema = f"{key} string, kind string, period date, actual double, forecast double, ci_lower double, ci_upper double, loglik double, aic double, bic double, n_train int"
    known = series.where(F.col(value).isNotNull() & F.col(key).isNotNull()).select(key, "period", F.col(value).cast("double"), *exog)
    return known.groupBy(key).applyInPandas(solve, schema)


# --- trend, seasonality and regressors ---------------------------------------------------------------
def sparse_trend(a: np.ndarray, y: np.ndarray, noise: float, wide: float, rate: float) -> np.ndarray:
    """Most likely coefficients: a normal prior of deviation `wide` on the first two, Laplace priors of scale `rate` on the others.

    The coefficients that aren't zero are solved for exactly, given their signs. One whose sign turns on the way stops at zero and leaves, the one that pulls hardest
    against its prior enters, until no other pulls harder than the prior allows.
    """
    gram, target, limit = a.T @ a, a.T @ y, noise**2 / rate
    gram[[0, 1], [0, 1]] += noise**2 / wide**2
    gram[np.arange(len(gram)), np.arange(len(gram))] *= 1 + 1e-10
    beta, sign, active = np.zeros(len(gram)), np.zeros(len(gram)), [0, 1]
    for _ in range(50 * len(beta)):
        new = np.linalg.solve(gram[np.ix_(active, active)], target[active] - limit * sign[active])
        turned = [(beta[j] / (beta[j] - v), j) for j, v in zip(active, new) if sign[j] and v * sign[j] <= 0]
        if turned:
            share, gone = min(turned)
            beta[active] += share * (new - beta[active])
            beta[gone] = sign[gone] = 0.0
            active.remove(gone)
            continue
        beta[active] = new
        pull = target - gram @ beta
        pull[active] = 0.0
        j = int(np.abs(pull).argmax())
        if abs(pull[j]) <= limit * (1 + 1e-7) + 1e-12:
            break
        sign[j] = math.copysign(1.0, pull[j])
        active.append(j)
    return beta


class TrendModel:
    """Piecewise-linear trend times (1 + yearly seasonality + regressors).

    Possible changepoints lie in the first 80 percent of the span; their slope changes have Laplace priors, which leave most of them at zero, the Fourier terms and
    standardised regressors normal ones. Trend and factors are fitted by turns, each at its most likely value given the other and the noise.
    """

    def __init__(self, y: np.ndarray, months: np.ndarray, x: np.ndarray, n_changepoints: int = 25, rate: float = 0.05, seasonal: float = 10.0, order: int = 10, turns: int = 30):
        self.first, self.span, self.order = months[0], max(months[-1] - months[0], 1.0), order
        t = (months - self.first) / self.span
        self.knots = np.quantile(t[:max(int(len(t) * 0.8), 2)], np.linspace(0, 1, n_changepoints + 1)[1:]) if n_changepoints else np.empty(0)
        self.mean, self.sd = x.mean(axis=0), x.std(axis=0) + 1e-9
        self.scale = float(np.abs(y).max()) or 1.0
        v, a, f = y / self.scale, self.trend_columns(t), self.factor_columns(months, x)
        self.slopes, self.factors = np.zeros(a.shape[1]), np.zeros(f.shape[1])
        self.slopes[0], noise = float(v.mean()), max(float(v.std()), 1e-3)
        for _ in range(turns):
            before = np.concatenate([self.slopes, self.factors])
            share = 1 + f @ self.factors
            self.slopes = sparse_trend(a * share[:, None], v, noise, 5.0, rate)
            trend = a @ self.slopes
            scaled = f * trend[:, None]
            self.factors = np.linalg.solve(scaled.T @ scaled + np.eye(f.shape[1]) * noise**2 / seasonal**2, scaled.T @ (v - trend))
            left = v - trend * (1 + f @ self.factors)
            noise = max(math.sqrt(float(left @ left) / len(v)), 1e-4)
            if np.abs(np.concatenate([self.slopes, self.factors]) - before).max() < 1e-6:
                break
        self.noise = noise * self.scale

    def trend_columns(self, t: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(t)), t, np.maximum(t[:, None] - self.knots[None, :], 0)])

    def factor_columns(self, months: np.ndarray, x: np.ndarray) -> np.ndarray:
        angle = 2 * math.pi * ((months % 12)[:, None] / 12) * np.arange(1, self.order + 1)[None, :]
        waves = np.column_stack([np.sin(angle), np.cos(angle)])
        return np.column_stack([waves, (x - self.mean) / self.sd])

    def predict(self, months: np.ndarray, x: np.ndarray) -> np.ndarray:
        trend = self.trend_columns((months - self.first) / self.span) @ self.slopes
        return self.scale * trend * (1 + self.factor_columns(months, x) @ self.factors)


def known_regressors(x: np.ndarray) -> np.ndarray:
    """Gaps take the value before, else the one after; columns without a value go."""
    frame = pd.DataFrame(x).ffill().bfill()
    return frame.dropna(axis=1, how="any").to_numpy(float).reshape(len(x), -1)


def trend_model(
    series: DataFrame, key: str, value: str, regressors: list[str] | None = None, horizon: int = settings.FORECAST_MONTHS,
    n_changepoints: int = 25, changepoint_scale: float = 0.05, seasonal_scale: float = 10.0, least: int = 24, most_regressors: int = 5,
) -> DataFrame:
    """Trend times seasonality per segment, as `TrendModel` fits it, with the first `most_regressors` regressors.

    Output as in `seasonal_arma`, with the number of slope changes above one percent of their scale in `n_changepoints`; the bands are 80 percent. Every segment
    answers: one that isn't fitted gives a row of kind 'none' whose `reason` says why. Gaps of regressors are filled, regressors without values left out.
    """
    regressors = (regressors or [])[:most_regressors]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("period")
        name = pdf[key].iloc[0]
        pdf = pdf[pdf[value].notna()]
        y = pdf[value].to_numpy(float)
        reason = f"fewer than {least} observations" if len(y) < least else "no value but zero" if not y.any() else None
        if reason:
            return pd.DataFrame([{**dict.fromkeys(names), key: name, "kind": "none", "n_train": len(y), "reason": reason}])[names]
        x = known_regressors(pdf[regressors].to_numpy(float).reshape(len(pdf), len(regressors)))
        stamp = pd.to_datetime(pdf["period"])
        months = (stamp.dt.year * 12 + stamp.dt.month).to_numpy(float)
        cut = int(len(y) * 0.8)
        rows = []
        for kind, m in (("holdout", cut), ("future", len(y))):
            model = TrendModel(y[:m], months[:m], x[:m], n_changepoints, changepoint_scale, seasonal_scale)
            changes = int((np.abs(model.slopes[2:]) > changepoint_scale * 0.01).sum())
            if kind == "holdout":
                at, x_at, periods, actual = months[m:], x[m:], list(pdf["period"].iloc[m:]), y[m:].tolist()
            else:
                at = months[-1] + np.arange(1, horizon + 1)
                x_at = np.repeat(x[-1:], horizon, axis=0)
                periods = [(stamp.iloc[-1] + pd.DateOffset(months=h + 1)).date() for h in range(horizon)]
                actual = [None] * horizon
            rows += [(name, kind, when, was, p, p - 1.281552 * model.noise, p + 1.281552 * model.noise, changes, m, None)
                     for when, was, p in zip(periods, actual, model.predict(at, x_at).tolist())]
        return pd.DataFrame(rows, columns=names).astype({"actual": "float64"})

    names = [key, "kind", "period", "actual", "forecast", "ci_lower", "ci_upper", "n_changepoints", "n_train", "reason"]
    schema = f"{key} string, kind string, period date, actual double, forecast double, ci_lower double, ci_upper double, n_changepoints int, n_train int, reason string"
    known = series.where(F.col(key).isNotNull()).select(key, "period", F.col(value).cast("double"), *[F.col(c).cast("double") for c in regressors])
    return known.groupBy(key).applyInPandas(solve, schema)
