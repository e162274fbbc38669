"""Detector queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwarden.operators import detectors as d
from tickwarden.operators.arima import EVALUATIONS, FARTHEST, FIRST_DAMP, LEAST_GAIN, LEAST_MOVE, LEAST_STEPS, MOST_DAMP, STARTS
from tickwarden.operators.scope import by_columns, rows, time_window, whole
from tickwarden.plans.fixtures import STOCKS_SQL, TRADES_SQL, stocks, trades
from tickwarden.plans.registry import query

FLAGS = ["uuid", "symbol", "price_flag", "volume_flag"]


def _hits(df: DataFrame) -> DataFrame:
    return df.filter(F.col("price_flag") | F.col("volume_flag")).select(*FLAGS)


BATCHED_SQL = TRADES_SQL + """,
batched AS (
  SELECT *, (row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1) // 15 AS batch_id
  FROM trades)"""

HIT_SQL = "SELECT uuid, symbol, price_flag, volume_flag FROM flagged WHERE price_flag OR volume_flag"


def _z_sql(source: str, keys: str, limit: float = 3) -> str:
    over = f"OVER (PARTITION BY {keys})"
    return f"""flagged AS (
  SELECT *,
    coalesce(abs((price - avg(price) {over}) / nullif(stddev_samp(price) {over}, 0)) > {limit}, false) AS price_flag,
    coalesce(abs((volume - avg(volume) {over}) / nullif(stddev_samp(volume) {over}, 0)) > {limit}, false) AS volume_flag
  FROM {source})"""


def _iqr_sql(source: str, keys: str) -> str:
    return f"""bounds AS (
  SELECT *, quantile_cont(price, 0.25) OVER w AS p1, quantile_cont(price, 0.75) OVER w AS p3,
         quantile_cont(volume, 0.25) OVER w AS v1, quantile_cont(volume, 0.75) OVER w AS v3
  FROM {source} WINDOW w AS (PARTITION BY {keys})),
flagged AS (
  SELECT *,
    price < p1 - 1.5 * (p3 - p1) OR price > p3 + 1.5 * (p3 - p1) AS price_flag,
    volume < v1 - 1.5 * (v3 - v1) OR volume > v3 + 1.5 * (v3 - v1) AS volume_flag
  FROM bounds)"""


@query(f"WITH {BATCHED_SQL}, {_z_sql('batched', 'symbol, batch_id')} {HIT_SQL}")
def zscore_rows15_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "zscore", rows(15)))


@query(f"WITH {TRADES_SQL}, {_z_sql('trades', 'symbol')} {HIT_SQL}")
def zscore_series_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "zscore", whole()))


@query(f"WITH {STOCKS_SQL}, {_z_sql('stocks', 'ingestion_ts')} {HIT_SQL}")
def zscore_micro_batch_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = d.Series(keys=())  # a micro-batch is judged across symbols
    return _hits(d.enrich(stocks(spark, sf_dir), "zscore", by_columns("ingestion_ts"), mixed))


@query(
    f"""WITH {TRADES_SQL}, windowed AS (
  SELECT *, trade_us // 21600000000 AS window_no FROM trades),
{_z_sql('windowed', 'symbol, window_no')} {HIT_SQL}"""
)
def event_window_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "zscore", time_window("6 hours")))


@query(f"WITH {BATCHED_SQL}, {_iqr_sql('batched', 'symbol, batch_id')} {HIT_SQL}")
def iqr_rows15_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "iqr", rows(15)))


@query(f"WITH {TRADES_SQL}, {_iqr_sql('trades', 'symbol')} {HIT_SQL}")
def iqr_series_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "iqr", whole()))


def _mad_sql(keys: str, source: str, limit: float) -> str:
    return f"""centred AS (
  SELECT *, quantile_disc(price, 0.5) OVER (PARTITION BY {keys}) AS middle FROM {source}),
spread AS (
  SELECT *, quantile_disc(abs(price - middle), 0.5) OVER (PARTITION BY {keys}) AS price_mad,
         quantile_disc(abs(volume - middle), 0.5) OVER (PARTITION BY {keys}) AS volume_mad FROM centred),
flagged AS (
  SELECT *, coalesce(abs(price - middle) / nullif(price_mad, 0) > {limit}, false) AS price_flag,
         coalesce(abs(volume - middle) / nullif(volume_mad, 0) > {limit}, false) AS volume_flag FROM spread)"""


@query(f"WITH {TRADES_SQL}, {_mad_sql('symbol', 'trades', 6)} {HIT_SQL}")
def mad_series_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "mad", threshold=6))


@query(
    f"""WITH {TRADES_SQL}, near AS (
  SELECT *, lag(price) OVER w AS p0, lead(price) OVER w AS p1, lag(volume) OVER w AS v0, lead(volume) OVER w AS v1
  FROM trades WINDOW w AS (PARTITION BY symbol ORDER BY trade_ts, uuid)),
flagged AS (
  SELECT *,
    coalesce((price > p0 AND price > p1 AND price - least(p0, p1) > 20)
      OR (price < p0 AND price < p1 AND greatest(p0, p1) - price > 20), false) AS price_flag,
    coalesce((volume > v0 AND volume > v1 AND volume - least(v0, v1) > 20)
      OR (volume < v0 AND volume < v1 AND greatest(v0, v1) - volume > 20), false) AS volume_flag
  FROM near) {HIT_SQL}"""
)
def neighbour_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "neighbour", threshold=20))


def _sliding_sql(seconds: int, limit: float) -> str:
    w = f"w{seconds}"
    return f"""scored{seconds} AS (
  SELECT *,
    coalesce(abs((price - avg(price) OVER {w}) / nullif(stddev_samp(price) OVER {w}, 0)) > {limit}, false) AS price_flag,
    coalesce(abs((volume - avg(volume) OVER {w}) / nullif(stddev_samp(volume) OVER {w}, 0)) > {limit}, false) AS volume_flag
  FROM trades
  WINDOW {w} AS (PARTITION BY symbol ORDER BY trade_us RANGE BETWEEN {seconds}000000 PRECEDING AND CURRENT ROW))"""


@query(
    f"""WITH {TRADES_SQL}, {_sliding_sql(86400, 3.0)}, flagged AS (SELECT * FROM scored86400)
{HIT_SQL}"""
)
def sliding_z_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "sliding", seconds=86400, threshold=3.0))


@query(
    f"""WITH {TRADES_SQL}, scored AS (
  SELECT a.uuid, a.symbol,
    coalesce(abs((a.price - avg(b.price)) / nullif(stddev_samp(b.price), 0)) > 3.0, false) AS price_flag,
    coalesce(abs((a.volume - avg(b.volume)) / nullif(stddev_samp(b.volume), 0)) > 3.0, false) AS volume_flag
  FROM trades a JOIN trades b ON b.symbol = a.symbol AND b.trade_us BETWEEN a.trade_us - 43200000000 AND a.trade_us
    AND (b.trade_us < a.trade_us OR b.uuid <= a.uuid)
  GROUP BY a.uuid, a.symbol, a.price, a.volume),
flagged AS (SELECT * FROM scored) {HIT_SQL}"""
)
def sliding_z_row_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window ends with the row itself, not with its instant."""
    return _hits(d.enrich(trades(spark, sf_dir), "sliding", seconds=43200, threshold=3.0, peers=False))


# Window seconds and thresholds; the trades here are minutes apart, so windows are hours.
SWEEP = [(10800, 2.0), (21600, 2.5), (43200, 3.0), (86400, 3.0)]


@query(
    f"WITH {TRADES_SQL}, "
    + ", ".join(_sliding_sql(w, t) for w, t in SWEEP)
    + " UNION ALL ".join(
        f""" SELECT CAST({w} AS DOUBLE) AS window_seconds, CAST({t} AS DOUBLE) AS threshold,
  CAST(count(*) FILTER (price_flag) AS BIGINT) AS price_count,
  CAST(count(*) FILTER (volume_flag) AS BIGINT) AS volume_count,
  round(100.0 * avg(CAST(price_flag AS DOUBLE)), 6) AS price_pct,
  round(100.0 * avg(CAST(volume_flag AS DOUBLE)), 6) AS volume_pct FROM scored{w}"""
        for w, t in SWEEP
    )
)
def sliding_z_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept = d.sweep(trades(spark, sf_dir), ["price", "volume"], SWEEP)
    return swept.withColumns({c: F.round(c, 6) for c in ("price_pct", "volume_pct")})


@query(
    f"""WITH {STOCKS_SQL}, wide AS (
  SELECT *, trade_us // (window_size * 1000000) AS frame
  FROM stocks, (VALUES (21600::BIGINT), (86400::BIGINT)) AS sizes(window_size)),
centred AS (SELECT *, quantile_disc(price, 0.5) OVER (PARTITION BY symbol, window_size, frame) AS middle FROM wide),
spread AS (
  SELECT *, quantile_disc(abs(price - middle), 0.5) OVER (PARTITION BY symbol, window_size, frame) AS mad FROM centred)
SELECT uuid, symbol, price, volume, trade_us, ingestion_us, CAST(6 AS DOUBLE) AS threshold,
       CAST(window_size AS INTEGER) AS window_size
FROM spread WHERE abs(price - middle) / nullif(mad, 0) > 6"""
)
def price_configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = d.run_configurations(stocks(spark, sf_dir), [21600, 86400], 6, "price", "mad")
    return _in_micros(found)


@query(
    f"""WITH {STOCKS_SQL}, wide AS (
  SELECT *, trade_us // (window_size * 1000000) AS frame
  FROM stocks, (VALUES (21600::BIGINT), (86400::BIGINT)) AS sizes(window_size)),
near AS (
  SELECT *, lag(volume) OVER w AS v0, lead(volume) OVER w AS v1 FROM wide
  WINDOW w AS (PARTITION BY symbol, window_size, frame ORDER BY trade_ts, uuid))
SELECT uuid, symbol, price, volume, trade_us, ingestion_us, CAST(30 AS DOUBLE) AS threshold,
       CAST(window_size AS INTEGER) AS window_size
FROM near WHERE (volume > v0 AND volume > v1 AND volume - least(v0, v1) > 30)
   OR (volume < v0 AND volume < v1 AND greatest(v0, v1) - volume > 30)"""
)
def volume_configurations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = d.run_configurations(stocks(spark, sf_dir), [21600, 86400], 30, "volume", "neighbour")
    return _in_micros(found)


def _in_micros(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"trade_us": F.unix_micros("trade_ts"), "ingestion_us": F.unix_micros("ingestion_ts")}
    ).drop("trade_ts", "ingestion_ts")


@query(
    f"""WITH {STOCKS_SQL}, sized AS (SELECT CAST(trunc(avg(batch_size)) AS BIGINT) AS n FROM stocks),
batched AS (
  SELECT s.*, n, (row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1) // n AS batch_id
  FROM stocks s, sized)
SELECT symbol, CAST(n AS BIGINT) AS batch_rows, CAST(max(batch_id) + 1 AS BIGINT) AS batches,
       CAST(count(*) AS BIGINT) AS trades FROM batched GROUP BY 1, 2"""
)
def batch_window_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickwarden.operators.scope import chosen_batch_size, scoped

    stored = stocks(spark, sf_dir)
    size = chosen_batch_size(stored)
    batched = scoped(stored, d.Series(), rows(size)).df
    return batched.groupBy("symbol", F.lit(size).cast("long").alias("batch_rows")).agg(
        (F.max("batch_id") + 1).alias("batches"), F.count(F.lit(1)).alias("trades")
    )


def _outward_sql(name: str, value: str, side: str, need: float) -> str:
    """Candidates of the runs that reach `need` below them on one side first."""
    near, beyond = ("max", "<") if side == "left" else ("min", ">")
    inner = "r.i > coalesce(h.stop, -1)" if side == "left" else "r.i < coalesce(h.stop, 1e18)"
    return f"""{name}_stop AS (
  SELECT c.symbol, c.i, {near}(r.i) AS stop FROM {value}_tops c LEFT JOIN {value}_runs r
    ON r.symbol = c.symbol AND r.i {beyond} c.i AND r.x > c.x GROUP BY 1, 2),
{name} AS (
  SELECT c.symbol, c.i FROM {value}_tops c JOIN {name}_stop h ON h.symbol = c.symbol AND h.i = c.i
  JOIN {value}_runs r ON r.symbol = c.symbol AND r.i {beyond} c.i AND {inner}
  GROUP BY 1, 2, c.x HAVING min(r.x) + {need} <= c.x)"""


def _tops_sql(value: str, expression: str, need: float) -> str:
    return f"""{value}_starts AS (
  SELECT symbol, i, {expression} AS x FROM (
    SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY i) AS back FROM placed) AS s
  WHERE back IS NULL OR back <> price),
{value}_runs AS (
  SELECT *, lead(i) OVER w - 1 AS last, lag(x) OVER w AS x0, lead(x) OVER w AS x1 FROM {value}_starts
  WINDOW w AS (PARTITION BY symbol ORDER BY i)),
{value}_tops AS (SELECT * FROM {value}_runs WHERE x > x0 AND x > x1),
{_outward_sql(value + '_left', value, 'left', need)},
{_outward_sql(value + '_right', value, 'right', need)},
{value}_hits AS (
  SELECT t.symbol, (t.i + t.last) // 2 AS i FROM {value}_tops t
  JOIN {value}_left USING (symbol, i) JOIN {value}_right USING (symbol, i))"""


@query(
    f"""WITH {TRADES_SQL},
placed AS (SELECT uuid, symbol, price, row_number() OVER (PARTITION BY symbol ORDER BY trade_ts, uuid) - 1 AS i FROM trades),
{_tops_sql('up', 'price', 50)},
{_tops_sql('down', '-price', 10)}
SELECT uuid, CAST(u.i IS NOT NULL AS INTEGER) AS peak_anomaly, CAST(d.i IS NOT NULL AS INTEGER) AS valley_anomaly
FROM placed p LEFT JOIN up_hits u ON u.symbol = p.symbol AND u.i = p.i
LEFT JOIN down_hits d ON d.symbol = p.symbol AND d.i = p.i"""
)
def prominence_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickwarden.operators.peaks import peaks_and_valleys

    found = peaks_and_valleys(trades(spark, sf_dir), "price", 50, 10)
    return found.select("uuid", "peak_anomaly", "valley_anomaly")


# A residual depends on step t-k by theta^k, which is below the rounding after 60 steps.
FIXED_PHI, FIXED_THETA, FIXED_REACH = 0.3, 0.4, 60


@query(
    f"""WITH {TRADES_SQL},
steps AS (
  SELECT uuid, symbol, row_number() OVER w AS i, price - lag(price) OVER w AS w FROM trades
  WINDOW w AS (PARTITION BY symbol ORDER BY trade_ts, uuid)),
lagged AS (SELECT *, w - {FIXED_PHI}::DOUBLE * coalesce(lag(w) OVER (PARTITION BY symbol ORDER BY i), 0) AS u
           FROM steps WHERE w IS NOT NULL),
reach AS (SELECT unnest(range(0, {FIXED_REACH + 1})) AS k)
SELECT a.uuid, round(sum(power(-{FIXED_THETA}::DOUBLE, k) * b.u), 6) AS residual
FROM lagged a CROSS JOIN reach JOIN lagged b ON b.symbol = a.symbol AND b.i = a.i - k GROUP BY 1"""
)
def arima_residuals_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tickwarden.operators.arima import arima_residuals

    made = arima_residuals(trades(spark, sf_dir), "price", fixed=(FIXED_PHI, FIXED_THETA))
    return made.select("uuid", F.round("residual", 6).alias("residual"))


def _arima_sql(source: str, keys: str, include_first: bool = False) -> str:
    """The descent of the fit as a recursion over looks; a look reads each scope's differences in order."""
    starts = ", ".join(f"({i}, {p}, {t})" for i, (p, t) in enumerate(STARTS))
    now = {"a": "(x.w - phi * x.k - theta * p.a)", "b": "(-x.k - theta * p.b)", "d": "(-p.a - theta * p.d)"}
    sums = {f"{i}{j}": f"p.{i}{j} + {now[i]} * {now[j]}" for i, j in ("aa", "ab", "ad", "bb", "bd", "dd")}
    zero = ", ".join(f"'{name}': 0::DOUBLE" for name in [*now, *sums])
    after = ", ".join(f"'{name}': {value}" for name, value in [*now.items(), *sums.items(), ("w", "x.w"), ("k", "x.k")])
    read = f"list_reduce(list_prepend({{{zero}, 'w': 0::DOUBLE, 'k': 0::DOUBLE}}, l), lambda p, x: {{{after}}})"
    better = "s.aa < o.cost"
    first = "UNION ALL SELECT c.id, c.uuid, c.kind, c.value FROM chain c JOIN fitted f ON f.id = c.id WHERE c.step IS NULL" if include_first else ""

    def taken(new: str, old: str) -> str:
        return f"CASE WHEN {better} THEN {new} ELSE o.{old} END AS {old}"

    def held(step: str) -> str:
        return f"CASE WHEN a * d - b * b > 0 THEN greatest(-{FARTHEST}, least({FARTHEST}, {step} / (a * d - b * b)))"

    return f"""long AS (
  SELECT uuid, {keys}, trade_ts, 'price' AS kind, price AS value FROM {source}
  UNION ALL SELECT uuid, {keys}, trade_ts, 'volume', volume FROM {source}),
chain AS (
  SELECT uuid, kind, value, dense_rank() OVER (ORDER BY kind, {keys}) AS id,
    row_number() OVER w - 1 AS t, value - lag(value) OVER w AS step
  FROM long WHERE value IS NOT NULL WINDOW w AS (PARTITION BY kind, {keys} ORDER BY trade_ts, uuid)),
steps AS (
  SELECT id, uuid, kind, t, step AS w, coalesce(lag(step) OVER (PARTITION BY id ORDER BY t), 0) AS back
  FROM chain WHERE step IS NOT NULL),
scopes AS (
  SELECT id, list({{{zero}, 'w': w, 'k': back}} ORDER BY t) AS l FROM steps GROUP BY id HAVING count(*) >= {LEAST_STEPS}),
starts (no, phi, theta) AS (VALUES {starts}),
tried AS (
  SELECT id, phi, theta, row_number() OVER (PARTITION BY id ORDER BY s.aa, no) AS place
  FROM (SELECT id, no, phi, theta, {read} AS s
        FROM (SELECT id, l, no, phi::DOUBLE AS phi, theta::DOUBLE AS theta FROM scopes CROSS JOIN starts) AS paired) AS r),
look AS (
  SELECT id, 0::DOUBLE AS u, 0::DOUBLE AS v, 'inf'::DOUBLE AS cost, 0::DOUBLE AS pp, 0::DOUBLE AS pt, 0::DOUBLE AS tt, 0::DOUBLE AS ep,
    0::DOUBLE AS et, {FIRST_DAMP}::DOUBLE AS damp, phi / sqrt(1 - phi * phi) AS next_u, theta / sqrt(1 - theta * theta) AS next_v,
    0 AS evaluations, 0 AS ended FROM tried WHERE place = 1
  UNION ALL
  SELECT id, u, v, cost, pp, pt, tt, ep, et, damp, next_u, next_v, evaluations,
    CASE WHEN settled OR damp > {MOST_DAMP} OR greatest(abs(next_u / sqrt(1 + next_u * next_u) - u / sqrt(1 + u * u)),
        abs(next_v / sqrt(1 + next_v * next_v) - v / sqrt(1 + v * v))) < {LEAST_MOVE} THEN 1
      WHEN evaluations >= {EVALUATIONS} THEN 2 ELSE 0 END
  FROM (
    SELECT id, u, v, cost, pp, pt, tt, ep, et, damp, evaluations, settled,
      {held("(u * (a * d - b * b) - (d * g - b * h))")} ELSE u END AS next_u, {held("(v * (a * d - b * b) - (a * h - b * g))")} ELSE v END AS next_v
    FROM (
      SELECT *, pp * du * du * (1 + damp) AS a, pt * du * dv AS b, tt * dv * dv * (1 + damp) AS d, ep * du AS g, et * dv AS h
      FROM (
        SELECT *, power(1 + u * u, -1.5) AS du, power(1 + v * v, -1.5) AS dv
        FROM (
          SELECT o.id, {taken("o.next_u", "u")}, {taken("o.next_v", "v")}, {taken("s.bb", "pp")}, {taken("s.bd", "pt")}, {taken("s.dd", "tt")},
            {taken("s.ab", "ep")}, {taken("s.ad", "et")}, {taken("s.aa", "cost")}, CASE WHEN {better} THEN o.damp / 10 ELSE o.damp * 10 END AS damp,
            o.evaluations + 1 AS evaluations, {better} AND o.cost - s.aa <= {LEAST_GAIN} * s.aa AS settled
          FROM (
            SELECT *, {read} AS s
            FROM (SELECT k.*, c.l, next_u / sqrt(1 + next_u * next_u) AS phi, next_v / sqrt(1 + next_v * next_v) AS theta
                  FROM look k JOIN scopes c ON c.id = k.id WHERE k.ended = 0) AS asked) AS o) AS accepted) AS turned) AS solved) AS moved),
fitted AS (SELECT id, u / sqrt(1 + u * u) AS phi, v / sqrt(1 + v * v) AS theta FROM look WHERE ended > 0),
path AS (
  SELECT x.id, x.t, x.uuid, x.kind, x.w - f.phi * x.back AS e FROM fitted f JOIN steps x ON x.id = f.id AND x.t = 1
  UNION ALL
  SELECT x.id, x.t, x.uuid, x.kind, x.w - f.phi * x.back - f.theta * p.e
  FROM path p JOIN steps x ON x.id = p.id AND x.t = p.t + 1 JOIN fitted f ON f.id = p.id),
errors AS (SELECT id, uuid, kind, e FROM path {first}),
judged AS (SELECT uuid, kind, coalesce(abs(e) > 3 * stddev_samp(e) OVER (PARTITION BY id), false) AS hit FROM errors),
flagged AS (
  SELECT s.uuid, s.symbol, coalesce(p.hit, false) AS price_flag, coalesce(v.hit, false) AS volume_flag FROM {source} s
  LEFT JOIN judged p ON p.uuid = s.uuid AND p.kind = 'price' LEFT JOIN judged v ON v.uuid = s.uuid AND v.kind = 'volume')"""


@query(f"WITH RECURSIVE {TRADES_SQL}, {_arima_sql('trades', 'symbol')} {HIT_SQL}")
def arima_series_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "arima"))


@query(f"WITH RECURSIVE {BATCHED_SQL}, {_arima_sql('batched', 'symbol, batch_id')} {HIT_SQL}")
def arima_rows15_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "arima", rows(15)))


@query(f"WITH RECURSIVE {BATCHED_SQL}, {_arima_sql('batched', 'symbol, batch_id', include_first=True)} {HIT_SQL}")
def arima_rows15_first_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first value of a batch counts as its own residual, as a model of differences fits nothing there."""
    return _hits(d.enrich(trades(spark, sf_dir), "arima", rows(15), include_first=True))


@query()
def iforest_series_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(d.enrich(trades(spark, sf_dir), "iforest"))
