"""Descriptive and time-series statistics queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden.functions import normal
from tickwarden.operators import correlation, decompose, describe, resample, stationarity
from tickwarden.operators.series import Series
from tickwarden.plans.fixtures import (
    BARS_SQL,
    DAILY_SERIES,
    STOCKS_SQL,
    TRADES_SQL,
    daily_bars,
    daily_totals,
    stocks,
    trades,
)
from tickwarden.plans.preparation import rounded
from tickwarden.plans.registry import query

TOTALS_SQL = """totals AS (
  SELECT 'total' AS name, epoch_us(date_trunc('day', l_shipdate)) // 86400000000 AS day,
         round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 2)"""


def _describe_sql(source: str, column: str) -> str:
    return f"""SELECT '{column}' AS "column", CAST(count({column}) AS BIGINT) AS count, round(avg({column}), 6) AS mean,
  round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min,
  round(quantile_cont({column}, 0.25), 6) AS p25, round(quantile_cont({column}, 0.5), 6) AS p50,
  round(quantile_cont({column}, 0.75), 6) AS p75, CAST(max({column}) AS DOUBLE) AS max FROM {source}"""


@query(f"WITH {TRADES_SQL} {_describe_sql('trades', 'price')} UNION ALL {_describe_sql('trades', 'volume')}")
def describe_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = describe.describe(trades(spark, sf_dir), ["price", "volume"])
    return rounded(table, 6, "mean", "std", "p25", "p50", "p75")


@query(
    f"WITH {BARS_SQL} "
    + " UNION ALL ".join(_describe_sql("bars", c).replace(", 6)", ", 4)") for c in ("open", "high", "low", "close"))
)
def describe_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = describe.describe(daily_bars(spark, sf_dir), ["open", "high", "low", "close"])
    return rounded(table, 4, "mean", "std", "p25", "p50", "p75")


@query(
    f"""WITH {STOCKS_SQL} SELECT round(avg(batch_size), 6) AS mean, round(stddev_samp(batch_size), 6) AS std,
  CAST(median(batch_size) AS DOUBLE) AS median FROM stocks"""
)
def batch_size_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.batch_size_summary(stocks(spark, sf_dir)), 6, "mean", "std")


def _hist_sql(source: str, column: str, bins: int) -> str:
    return f"""ends AS (SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi FROM {source}),
counts AS (
  SELECT CAST(least(floor(({column} - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS INTEGER) AS bin, count(*) AS n
  FROM {source}, ends WHERE {column} IS NOT NULL GROUP BY 1),
spine AS (SELECT CAST(unnest(range(1, {bins + 1})) AS INTEGER) AS bin)
SELECT s.bin, round(lo + (hi - lo) / {bins} * (s.bin - 1), 6) AS low, round(lo + (hi - lo) / {bins} * s.bin, 6) AS high,
       CAST(coalesce(n, 0) AS BIGINT) AS n FROM spine s CROSS JOIN ends LEFT JOIN counts c ON c.bin = s.bin"""


@query(f"WITH {TRADES_SQL}, {_hist_sql('trades', 'volume', 5)}")
def hist5_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.histogram(trades(spark, sf_dir), "volume", 5), 6, "low", "high")


@query(
    f"""WITH {STOCKS_SQL}, lags AS (SELECT *, (ingestion_us - trade_us) / 1e6::DOUBLE AS lag_s FROM stocks),
{_hist_sql('lags', 'lag_s', 30)}"""
)
def hist30_ingest_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = describe.ingestion_lag(stocks(spark, sf_dir))
    return rounded(describe.histogram(lagged, "time_to_ingest", 30), 6, "low", "high")


@query(f"WITH {STOCKS_SQL}, {_hist_sql('stocks', 'batch_size', 120)}")
def hist120_batch_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(describe.histogram(stocks(spark, sf_dir), "batch_size", 120), 6, "low", "high")


@query(
    f"""WITH {STOCKS_SQL}, lags AS (SELECT *, (ingestion_us - trade_us) / 1e6::DOUBLE AS time_to_ingest FROM stocks)
{_describe_sql('lags', 'time_to_ingest')}"""
)
def ingest_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    lagged = describe.ingestion_lag(stocks(spark, sf_dir))
    table = describe.describe(lagged, ["time_to_ingest"])
    return rounded(table, 6, "mean", "std", "p25", "p50", "p75")


MOMENTS_SQL = (
    TRADES_SQL
    + """,
means AS (SELECT symbol, avg(price) AS m FROM trades GROUP BY 1),
central AS (
  SELECT symbol, CAST(count(*) AS BIGINT) AS n, avg((price - m) ** 2) AS m2, avg((price - m) ** 3) AS m3,
         avg((price - m) ** 4) AS m4 FROM trades JOIN means USING (symbol) GROUP BY 1),
shape AS (SELECT symbol, n, n::DOUBLE AS d, m3 / m2 ** 1.5 AS g1, m4 / (m2 * m2) - 3 AS g2 FROM central)"""
)


@query(f"WITH {MOMENTS_SQL} SELECT symbol, n, round(g1, 6) AS skewness, round(g2, 6) AS kurtosis FROM shape")
def moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = describe.moments(trades(spark, sf_dir), "price", ["symbol"])
    return rounded(table, 6, "skewness", "kurtosis")


@query(
    f"""WITH {MOMENTS_SQL},
skew AS (
  SELECT *, g1 * sqrt((d + 1) * (d + 3) / (6 * (d - 2))) AS y,
    sqrt(2 * (3 * (d * d + 27 * d - 70) * (d + 1) * (d + 3) / ((d - 2) * (d + 5) * (d + 7) * (d + 9)) - 1)) - 1 AS w2,
    (g2 + 3 - 3 * (d - 1) / (d + 1)) / sqrt(24 * d * (d - 2) * (d - 3) / ((d + 1) * (d + 1) * (d + 3) * (d + 5))) AS x,
    6 * (d * d - 5 * d + 2) / ((d + 7) * (d + 9)) * sqrt(6 * (d + 3) * (d + 5) / (d * (d - 2) * (d - 3))) AS s
  FROM shape),
terms AS (SELECT *, 6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) AS a FROM skew),
bent AS (SELECT *, 1 + x * sqrt(2 / (a - 4)) AS b FROM terms),
scores AS (
  SELECT symbol, n, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z_skew,
    (1 - 2 / (9 * a) - sign(b) * cbrt((1 - 2 / a) / abs(b))) / sqrt(2 / (9 * a)) AS z_kurtosis FROM bent)
SELECT symbol, n, round(z_skew, 4) AS z_skew, round(z_kurtosis, 4) AS z_kurtosis,
       round(z_skew * z_skew + z_kurtosis * z_kurtosis, 3) AS k2,
       round(exp(-(z_skew * z_skew + z_kurtosis * z_kurtosis) / 2), 6) AS p FROM scores"""
)
def normality_k2(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = describe.normality(trades(spark, sf_dir), "price", ["symbol"])
    return rounded(rounded(rounded(table, 4, "z_skew", "z_kurtosis"), 3, "k2"), 6, "p")


def _poly_sql(x: str, coefficients: list[float]) -> str:
    text = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def _quantile_sql(p: str) -> str:
    q, t = f"({p} - 0.5)", f"sqrt(-ln(least({p}, 1 - {p})))"
    r, s, e = f"(0.180625 - {q} * {q})", f"({t} - 1.6)", f"({t} - 5)"
    return f"""CASE WHEN abs({q}) <= 0.425
      THEN {q} * {_poly_sql(r, normal.CENTRE_TOP)} / {_poly_sql(r, normal.CENTRE_BASE)}
      WHEN {t} <= 5 THEN sign({q}) * {_poly_sql(s, normal.SHOULDER_TOP)} / {_poly_sql(s, normal.SHOULDER_BASE)}
      ELSE sign({q}) * {_poly_sql(e, normal.TAIL_TOP)} / {_poly_sql(e, normal.TAIL_BASE)} END"""


@query(
    f"""WITH {TRADES_SQL},
placed AS (
  SELECT symbol, price AS x, row_number() OVER (PARTITION BY symbol ORDER BY price, uuid) AS i,
         count(*) OVER (PARTITION BY symbol)::DOUBLE AS n FROM trades),
shares AS (SELECT *, (i - 0.375::DOUBLE) / (n + 0.25::DOUBLE) AS p FROM placed),
scored AS (SELECT *, {_quantile_sql('p')} AS m FROM shares),
sums AS (
  SELECT symbol, any_value(n) AS n, sum(m * m) AS mm, var_pop(x) * count(*) AS ss,
    sum(CASE WHEN i > 2 AND i < n - 1 THEN m * x ELSE 0 END) AS mx,
    max(CASE WHEN i = n THEN m END) AS ml, max(CASE WHEN i = n - 1 THEN m END) AS mn,
    max(CASE WHEN i = n THEN x END) - max(CASE WHEN i = 1 THEN x END) AS wide,
    max(CASE WHEN i = n - 1 THEN x END) - max(CASE WHEN i = 2 THEN x END) AS inner_wide
  FROM scored GROUP BY 1),
weights AS (
  SELECT *, ml / sqrt(mm) + {_poly_sql('(1 / sqrt(n))', describe.LAST_WEIGHT)} AS al,
            mn / sqrt(mm) + {_poly_sql('(1 / sqrt(n))', describe.NEXT_WEIGHT)} AS an FROM sums),
tested AS (
  SELECT *, (al * wide + an * inner_wide + mx / sqrt((mm - 2 * ml * ml - 2 * mn * mn) / (1 - 2 * al * al - 2 * an * an))) ** 2 / ss AS w
  FROM weights)
SELECT symbol, CAST(n AS BIGINT) AS n, round(w, 6) AS w,
  round((ln(1 - w) - {_poly_sql('ln(n)', describe.LARGE_MEAN)}) / exp({_poly_sql('ln(n)', describe.LARGE_LOG_STD)}), 4) AS z
FROM tested"""
)
def shapiro(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = describe.shapiro(trades(spark, sf_dir), "price", ["symbol"])
    return rounded(rounded(table.drop("p"), 6, "w"), 4, "z")


LAGS = 34

ACF_SQL = (
    TRADES_SQL
    + f""",
placed AS (
  SELECT symbol, price - avg(price) OVER (PARTITION BY symbol) AS c, count(*) OVER (PARTITION BY symbol) AS n,
         row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) AS i FROM trades),
lags AS (SELECT unnest(range(0, {LAGS + 1})) AS lag),
sums AS (
  SELECT a.symbol, lag, any_value(a.n) AS n, sum(a.c * b.c) AS s FROM placed a CROSS JOIN lags
  JOIN placed b ON b.symbol = a.symbol AND b.i = a.i - lag GROUP BY 1, 2),
acf AS (SELECT symbol, lag, n, s / max(CASE WHEN lag = 0 THEN s END) OVER (PARTITION BY symbol) AS r FROM sums)"""
)


@query(
    f"""WITH {ACF_SQL}
SELECT symbol, CAST(lag AS INTEGER) AS lag, round(r, 6) AS acf,
  round(CASE WHEN lag = 0 THEN 0 ELSE 1.96 * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN r * r END)
    OVER (PARTITION BY symbol ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS band
FROM acf"""
)
def acf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlation.acf(trades(spark, sf_dir), "price", lags=LAGS), 6, "acf", "band")


@query(
    f"""WITH RECURSIVE {ACF_SQL},
lists AS (SELECT symbol, any_value(n) AS n, list(r ORDER BY lag) AS r FROM acf GROUP BY 1),
levels AS (
  SELECT symbol, n, r, 1 AS k, [r[2]] AS phi, 1 - r[2] * r[2] AS rest, r[2] AS p FROM lists
  UNION ALL
  SELECT symbol, n, r, k + 1,
    list_concat(list_transform(range(1, k + 1), lambda j: phi[j] - pn * phi[k + 1 - j]), [pn]), rest * (1 - pn * pn), pn
  FROM (SELECT *, (r[k + 2] - list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j]))) / rest AS pn
        FROM levels WHERE k < {LAGS}) AS steps)
SELECT symbol, CAST(k AS INTEGER) AS lag, round(p, 6) AS pacf, round(1.96 / sqrt(n), 6) AS band FROM levels
UNION ALL SELECT symbol, 0, 1.0, 0.0 FROM lists"""
)
def pacf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlation.pacf(trades(spark, sf_dir), "price", lags=LAGS), 6, "pacf", "band")


def differenced(df: DataFrame, column: str, series: Series) -> DataFrame:
    """The series of first differences, without its undefined first row."""
    steps = resample.changes(df, (column,), series)
    return steps.drop(column).withColumnRenamed(f"{column}_diff", column).filter(
        F.col(column).isNotNull()
    )


@query(
    f"""WITH {TOTALS_SQL},
lagged AS (SELECT *, total - lag(total) OVER (ORDER BY day) AS step FROM totals),
centred AS (SELECT step - avg(step) OVER () AS c, count(*) OVER () AS n,
            row_number() OVER (ORDER BY day) AS i FROM lagged WHERE step IS NOT NULL),
lags AS (SELECT unnest(range(0, 21)) AS lag),
sums AS (SELECT lag, any_value(a.n) AS n, sum(a.c * b.c) AS s FROM centred a CROSS JOIN lags
         JOIN centred b ON b.i = a.i - lag GROUP BY 1)
SELECT 'total' AS name, CAST(lag AS INTEGER) AS lag, round(s / max(CASE WHEN lag = 0 THEN s END) OVER (), 6) AS acf FROM sums"""
)
def acf_of_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = differenced(daily_totals(spark, sf_dir), "total", DAILY_SERIES)
    table = correlation.acf(steps, "total", DAILY_SERIES, 20)
    return rounded(table.select("name", "lag", "acf"), 6, "acf")


@query(
    f"""WITH {TRADES_SQL},
pairs AS (SELECT symbol, lag(price) OVER w AS x, price - lag(price) OVER w AS y FROM trades
          WINDOW w AS (PARTITION BY symbol ORDER BY trade_ts, uuid)),
fits AS (
  SELECT symbol, count(*) AS n, regr_slope(y, x) AS b, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy
  FROM pairs WHERE x IS NOT NULL GROUP BY 1)
SELECT symbol, CAST(n + 1 AS BIGINT) AS n, round(b / sqrt((syy - b * sxy) / (n - 2) / sxx), 5) AS statistic,
       CAST(n AS BIGINT) AS observations, round(-2.86154 - 2.8903 / n - 4.234 / n ** 2 - 40.040 / n ** 3, 6) AS crit_5pct
FROM fits"""
)
def adf_lag0(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stationarity.adf(trades(spark, sf_dir), "price", max_lag=0)
    kept = table.select("symbol", "n", "statistic", "observations", "crit_5pct")
    return rounded(rounded(kept, 5, "statistic"), 6, "crit_5pct")


def _normal_sql(z: str) -> str:
    """The normal distribution function, from the series 1, 1 / 3, 1 / 3 5, ..."""
    terms = f"list_sum(list_transform(range(0, 200), lambda n: exp((2 * n + 1) * ln(abs({z})) - list_sum(list_transform(range(0, n + 1), lambda m: ln(2 * m + 1))))))"
    return f"""CASE WHEN abs({z}) > 12 THEN CASE WHEN {z} > 0 THEN 1.0 ELSE 0.0 END WHEN {z} = 0 THEN 0.5
    ELSE 0.5 + sign({z}) * exp(-{z} * {z} / 2) / sqrt(2 * pi()) * {terms} END"""


def _polynomial(x: str, terms: list[float]) -> str:
    return " + ".join(f"{c}::DOUBLE * power({x}, {i})" for i, c in enumerate(terms))


def _adf_sql(source: str, most: str) -> str:
    """The test on `source` (name, i, v): lags up to `most` (SQL of n), one elimination for all of them, then the best again.

    A matrix is a list of rows; taking out a regressor is a list_transform, and the last entry is what is unexplained.
    """
    take = (
        "list_transform(m, lambda r: CASE WHEN m[k + 1][k + 1] > least THEN "
        "list_transform(range(1, len(r) + 1), lambda j: r[j] - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) ELSE r END)"
    )

    def matrix(name: str, cells: str) -> str:
        return f"""{name}_sums AS (
  SELECT a.name, a.at AS p, b.at AS q, sum(a.v * b.v) AS v FROM {cells} a JOIN {cells} b ON b.name = a.name AND b.i = a.i GROUP BY ALL),
{name}_rows AS (SELECT name, p, list(v ORDER BY q) AS r FROM {name}_sums GROUP BY name, p),
{name} AS (
  SELECT g.name, 0 AS k, list(g.r ORDER BY g.p) AS m, 1e-12 * max(d.v) AS least FROM {name}_rows g
  JOIN {name}_sums d ON d.name = g.name AND d.p = g.p AND d.q = g.p GROUP BY g.name
  UNION ALL SELECT name, k + 1, {take}, least FROM {name} WHERE k < len(m) - 1)"""

    p = f"CASE WHEN t > {stationarity.P_MAX} THEN 1.0 WHEN t < {stationarity.P_MIN} THEN 0.0 ELSE {_normal_sql('z')} END"
    crits = ", ".join(f"round({_polynomial('(1.0::DOUBLE / observations)', c)}, 6) AS {name}" for name, c in stationarity.CRITICAL.items())
    return f"""scaled AS (
  SELECT name, i, n, {most} AS most, (v - avg(v) OVER w) / stddev_pop(v) OVER w AS x
  FROM (SELECT name, v, row_number() OVER (PARTITION BY name ORDER BY i) AS i, count(*) OVER (PARTITION BY name) AS n FROM {source}) AS numbered
  WINDOW w AS (PARTITION BY name)),
moved AS (SELECT name, i, n, most, x, x - lag(x) OVER w AS step, lag(x) OVER w AS level FROM scaled WINDOW w AS (PARTITION BY name ORDER BY i)),
-- 0: constant, 1: level, 2 to most + 1: earlier steps, most + 2: the step
cells AS (
  SELECT name, i, n, most, 0 AS at, 1.0::DOUBLE AS v FROM moved WHERE level IS NOT NULL
  UNION ALL SELECT name, i, n, most, 1, level FROM moved WHERE level IS NOT NULL
  UNION ALL SELECT name, i, n, most, most + 2, step FROM moved WHERE level IS NOT NULL
  UNION ALL SELECT a.name, a.i, a.n, a.most, 1 + a.i - b.i, b.step FROM moved a JOIN moved b
    ON b.name = a.name AND b.i < a.i AND b.i >= a.i - a.most AND b.step IS NOT NULL),
shared AS (SELECT * FROM cells WHERE i > most + 1),
{matrix('common', 'shared')},
facts AS (SELECT name, any_value(n) AS n, any_value(most) AS most FROM moved GROUP BY name),
chosen AS (
  SELECT name, n, k - 2 AS lag FROM (
    SELECT c.name, f.n, c.k, (f.n - 1 - f.most) * (ln(2 * pi() * greatest(c.m[f.most + 3][f.most + 3], 1e-300) / (f.n - 1 - f.most)) + 1) + 2 * c.k AS aic
    FROM common c JOIN facts f ON f.name = c.name WHERE c.k >= 2) AS tried
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY aic, k) = 1),
-- constant, earlier steps, level, step
own AS (
  SELECT c.name, c.i, CASE WHEN c.at = 0 THEN 0 WHEN c.at = 1 THEN h.lag + 1 WHEN c.at = c.most + 2 THEN h.lag + 2 ELSE c.at - 1 END AS at, c.v
  FROM cells c JOIN chosen h ON h.name = c.name WHERE c.i > h.lag + 1 AND (c.at <= h.lag + 1 OR c.at = c.most + 2)),
{matrix('fitted', 'own')},
level AS (
  SELECT h.name, h.n, h.lag, h.n - 1 - h.lag AS observations, m[h.lag + 2][h.lag + 2] AS ll, m[h.lag + 2][h.lag + 3] AS ly, m[h.lag + 3][h.lag + 3] AS yy
  FROM chosen h JOIN fitted f ON f.name = h.name AND f.k = h.lag + 1),
tested AS (SELECT *, ly / ll / sqrt((yy - ly * ly / ll) / (observations - lag - 2) / ll) AS t FROM level),
surfaced AS (
  SELECT *, CASE WHEN t <= {stationarity.P_SWITCH} THEN {_polynomial('t', stationarity.P_SMALL)} ELSE {_polynomial('t', stationarity.P_LARGE)} END AS z FROM tested),
valued AS (SELECT *, greatest(0::DOUBLE, {p}) AS p FROM surfaced)
SELECT name, CAST(n AS BIGINT) AS n, round(t, 5) AS statistic, round(p, 6) AS p, CAST(lag AS INTEGER) AS used_lag,
  CAST(observations AS BIGINT) AS observations, {crits}, p <= 0.05 AS stationary FROM valued"""


def _tested(table: DataFrame) -> DataFrame:
    return rounded(rounded(table, 5, "statistic"), 6, "p", *stationarity.CRITICAL)


@query(
    f"""WITH RECURSIVE {TOTALS_SQL},
both_ways AS (
  SELECT 'levels' AS name, day AS i, total AS v FROM totals
  UNION ALL SELECT 'differences', day, step FROM (SELECT day, total - lag(total) OVER (ORDER BY day) AS step FROM totals) AS s WHERE step IS NOT NULL),
{_adf_sql('both_ways', "greatest(0, least(CAST(ceil(12 * power(n / 100.0, 0.25)) AS BIGINT), n // 2 - 2))")}"""
)
def adf_levels_and_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag chosen by AIC, on the daily totals and on their differences."""
    levels = daily_totals(spark, sf_dir)
    steps = differenced(levels, "total", DAILY_SERIES)
    tests = [
        stationarity.adf(t, "total", DAILY_SERIES).withColumn("name", F.lit(n))
        for n, t in (("levels", levels), ("differences", steps))
    ]
    return _tested(tests[0].unionByName(tests[1]))


@query(
    f"""WITH RECURSIVE {TRADES_SQL},
prices AS (SELECT symbol AS name, row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) AS i, price AS v FROM trades),
{_adf_sql('prices', '2')}"""
)
def adf_few_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to two lags by AIC, for each symbol."""
    table = stationarity.adf(trades(spark, sf_dir), "price", max_lag=2)
    return _tested(table.withColumnRenamed("symbol", "name"))


def _decompose_sql(source: str, value: str, period: int, model: str) -> str:
    half, minus, over = period // 2, *(("-", "-") if model == "additive" else ("/", "/"))
    rest = "x - trend - seasonal" if model == "additive" else "x / (trend * seasonal)"
    return f"""placed AS (SELECT day, {value} AS x, row_number() OVER (ORDER BY day) - 1 AS i FROM {source}),
trended AS (
  SELECT *, CASE WHEN count(x) OVER w = {2 * half + 1} THEN
    (sum(x) OVER w - 0.5 * (lag(x, {half}) OVER (ORDER BY i) + lead(x, {half}) OVER (ORDER BY i))) / {period} END AS trend
  FROM placed WINDOW w AS (ORDER BY i ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING)),
phases AS (SELECT i % {period} AS phase, avg(x {minus} trend) AS raw FROM trended GROUP BY 1),
seasons AS (SELECT phase, raw {over} avg(raw) OVER () AS seasonal FROM phases),
parts AS (SELECT day, x, trend, seasonal, {rest} AS resid FROM trended JOIN seasons ON phase = i % {period})"""


@query(
    f"""WITH {TOTALS_SQL}, {_decompose_sql('totals', 'total', 60, 'additive')}
SELECT CAST(day AS BIGINT) AS day, round(x, 5) AS observed, round(trend, 5) AS trend,
       round(seasonal, 5) AS seasonal, round(resid, 5) AS resid FROM parts"""
)
def decompose_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = decompose.decompose(daily_totals(spark, sf_dir), "total", 60, "additive", DAILY_SERIES)
    return rounded(parts.select("day", *decompose.COMPONENTS), 5, *decompose.COMPONENTS)


@query(
    f"""WITH {BARS_SQL}, {_decompose_sql('bars', 'close', 30, 'multiplicative')}
SELECT CAST(day AS BIGINT) AS day, round(x, 5) AS observed, round(trend, 5) AS trend,
       round(seasonal, 6) AS seasonal, round(resid, 6) AS resid FROM parts"""
)
def decompose_multiplicative(spark: SparkSession, sf_dir: str) -> DataFrame:
    bars = daily_bars(spark, sf_dir).withColumn("name", F.lit("close"))
    parts = decompose.decompose(bars, "close", 30, "multiplicative", DAILY_SERIES)
    kept = parts.select("day", *decompose.COMPONENTS)
    return rounded(rounded(kept, 5, "observed", "trend"), 6, "seasonal", "resid")


@query(
    f"""WITH {TOTALS_SQL}, {_decompose_sql('totals', 'total', 60, 'additive')}
SELECT CAST(day AS BIGINT) AS day, 'observed' AS component, round(x, 5) AS value, 1 AS component_no FROM parts
UNION ALL SELECT day, 'trend', round(trend, 5), 2 FROM parts
UNION ALL SELECT day, 'seasonal', round(seasonal, 5), 3 FROM parts
UNION ALL SELECT day, 'resid', round(resid, 5), 4 FROM parts"""
)
def decompose_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = decompose.decompose(daily_totals(spark, sf_dir), "total", 60, "additive", DAILY_SERIES)
    long = decompose.components_long(parts.select("day", *decompose.COMPONENTS), ["day"])
    return rounded(long, 5, "value")
