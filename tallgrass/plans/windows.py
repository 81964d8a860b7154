"""Queries of the rolling, lagged and event-based features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import liquidity as q
from tallgrass.operators import windows as w
from tallgrass.sources.tables import TXN, table, txn

from .registry import query

SHIFT = "1.3e-7"
KINDS = ["signup", "purchase", "error", "view", "click"]


def back(days: float) -> str:
    return f"(PARTITION BY entity_id ORDER BY sec RANGE BETWEEN {int(days * 86400)} PRECEDING AND CURRENT ROW)"


def r(expression: str, name: str, digits: int = 4) -> str:
    """A rounded column. The shift keeps exact halves, which two engines may sum to either side, off the rounding edge."""
    return f"round({expression} + {SHIFT}, {digits}) + 0e0 AS {name}"


ROWS = "(PARTITION BY entity_id ORDER BY ts, event_id)"
ORDER = ["ts", "event_id"]
KEY = ["event_id"]


@query("W1_rolling_window", f"WITH {TXN} SELECT event_id, " + ", ".join(f"count(amount) OVER {back(n)} AS amount_{a}_{n}d" if a == "count" else r(f"{f}(amount) OVER {back(n)}", f"amount_{a}_{n}d") for n in (7, 30) for a, f in (("sum", "sum"), ("avg", "avg"), ("count", "count"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))) + " FROM txn")
def w1(spark, sf_dir):
    df = w.rolling(txn(spark, sf_dir), "entity_id", "amount", (7, 30))
    return w.rounded(df, KEY, [c for c in df.columns if c.startswith("amount_")])


@query("W2_tag_counts", f"WITH {TXN} SELECT event_id, " + ", ".join(f"CAST(sum(CASE WHEN category = '{k}' THEN 1 ELSE 0 END) OVER {back(7)} AS BIGINT) AS {k}_count_7d" for k in KINDS) + " FROM txn")
def w2(spark, sf_dir):
    return w.tag_counts(txn(spark, sf_dir), "entity_id", "category", KINDS, 7).select("event_id", *[f"{k}_count_7d" for k in KINDS])


@query("W3_category_sums", f"WITH {TXN} SELECT event_id, " + ", ".join(r(f"sum(CASE WHEN category = '{k}' THEN amount ELSE 0.0e0 END) OVER {back(7)}", f"{k}_sum_7d") for k in KINDS) + " FROM txn")
def w3(spark, sf_dir):
    return w.rounded(w.category_sums(txn(spark, sf_dir), "entity_id", "category", "amount", KINDS, 7), KEY, [f"{k}_sum_7d" for k in KINDS])


INC, EXP = (f"sum(CASE WHEN amount {s} 0 THEN abs(amount) ELSE 0.0e0 END) OVER {back(7)}" for s in "><")


@query("W4_liquidity", f"WITH {TXN} SELECT event_id, {r(INC, 'income')}, {r(EXP, 'expense')}, {r(f'CASE WHEN {EXP} > 0.001 THEN ({INC}) / ({EXP}) END', 'income_expense_ratio')}, {r(f'avg(value) OVER {back(7)}', 'avg_balance')}, {r(f'stddev_samp(value) OVER {back(7)}', 'balance_volatility')}, {r(f'sum(amount) OVER {back(7)}', 'net_flow')} FROM txn")
def w4(spark, sf_dir):
    df = w.liquidity(txn(spark, sf_dir), "entity_id", "amount", "value", 7)
    return w.rounded(df, KEY, ["income", "expense", "income_expense_ratio", "avg_balance", "balance_volatility", "net_flow"])


@query("W5_rolling_multi", f"WITH {TXN} SELECT event_id, {r(f'avg(amount) OVER {back(1)}', 'amount_avg_1d_short')}, {r(f'avg(amount) OVER {back(14)}', 'amount_avg_14d_long')} FROM txn")
def w5(spark, sf_dir):
    df = w.rolling(txn(spark, sf_dir), "entity_id", "amount", (1,), ("avg",), "short")
    return w.rounded(w.rolling(df, "entity_id", "amount", (14,), ("avg",), "long"), KEY, ["amount_avg_1d_short", "amount_avg_14d_long"])


@query("W6_lag", f"WITH {TXN} SELECT event_id, " + ", ".join(f"{f}(amount, {k}) OVER {ROWS} AS amount_{f}_{k}" for k in (1, 7) for f in ("lag", "lead")) + " FROM txn")
def w6(spark, sf_dir):
    return w.lags(txn(spark, sf_dir), "entity_id", ORDER, "amount").select("event_id", *[f"amount_{f}_{k}" for k in (1, 7) for f in ("lag", "lead")])


@query("W7_overlap_windows", f"WITH {TXN} SELECT event_id, " + ", ".join(r(f"avg(amount) OVER {back(n)}", f"amount_mean_{n}d") for n in (3, 7, 14)) + ", " + ", ".join(r(f"avg(amount) OVER {back(a)} - avg(amount) OVER {back(b)}", f"amount_diff_{a}d_{b}d") for a, b in ((3, 7), (7, 14))) + " FROM txn")
def w7(spark, sf_dir):
    df = w.growing_windows(txn(spark, sf_dir), "entity_id", "amount", (3, 7, 14))
    return w.rounded(df, KEY, [c for c in df.columns if c.startswith("amount_")])


W8 = f"""WITH {TXN}, weeks AS (SELECT entity_id, date_trunc('week', day) AS week, sum(amount) AS total, count(*) AS n FROM txn GROUP BY 1, 2)
SELECT t.event_id, {r('w.total', 'week_total')}, w.n AS week_count FROM txn t ASOF LEFT JOIN weeks w ON t.entity_id = w.entity_id AND date_trunc('week', t.day) > w.week"""


@query("W8_multi_resolution", W8)
def w8(spark, sf_dir):
    from tallgrass.operators.joins import asof

    df = txn(spark, sf_dir).withColumn("week", F.to_date(F.date_trunc("week", "day")))
    weeks = df.groupBy("entity_id", "week").agg(F.sum("amount").alias("week_total"), F.count("*").alias("week_count"))
    found = asof(df, weeks, "entity_id", "week", "week", ["week_total", "week_count"], strict=True)
    return w.rounded(found, KEY, ["week_total", "week_count"])


W9 = f"""WITH {TXN}, marked AS (SELECT *, max(CASE WHEN category = 'purchase' THEN sec END) OVER (PARTITION BY entity_id ORDER BY sec RANGE UNBOUNDED PRECEDING) AS last_sec,
CASE WHEN category = 'purchase' THEN (sec - max(CASE WHEN category = 'purchase' THEN sec END) OVER (PARTITION BY entity_id ORDER BY sec RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) / 86400e0 END AS gap FROM txn)
SELECT event_id, {r('(sec - last_sec) / 86400e0', 'days_since')}, CAST(sum(CAST(category = 'purchase' AS INT)) OVER {back(30)} AS BIGINT) AS count_30d, CAST(sum(CAST(category = 'purchase' AS INT)) OVER {back(60)} AS BIGINT) AS count_60d,
{r(f'avg(gap) OVER {back(90)}', 'mean_gap_90d')} FROM marked"""


@query("W9_event_features", W9)
def w9(spark, sf_dir):
    return w.rounded(w.event_features(txn(spark, sf_dir), "entity_id", "category", "purchase"), KEY, ["days_since", "count_30d", "count_60d", "mean_gap_90d"])


W10 = f"""WITH {TXN}, ends AS (SELECT category, min(day) AS a, max(day) AS b FROM txn GROUP BY 1),
days AS (SELECT category, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
sums AS (SELECT category, day, sum(value) AS value FROM txn GROUP BY 1, 2),
filled AS (SELECT d.category, d.day, coalesce(s.value, 0) AS value FROM days d LEFT JOIN sums s ON d.category = s.category AND d.day = s.day),
trends AS (SELECT *, avg(value) OVER (PARTITION BY category ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS trend, datediff('day', DATE '2000-01-01', day) % 7 AS phase FROM filled),
parts AS (SELECT *, avg(value - trend) OVER (PARTITION BY category, phase) - avg(value - trend) OVER (PARTITION BY category) AS seasonal FROM trends)
SELECT category, day, {r('trend', 'trend')}, {r('seasonal', 'seasonal')}, {r('value - trend - seasonal', 'residual')} FROM parts"""


@query("W10_decomposition", W10)
def w10(spark, sf_dir):
    daily = w.filled_days(txn(spark, sf_dir), "category", "day", "value")
    return w.rounded(w.decomposition(daily, "category", "day", "value"), ["category", "day"], ["trend", "seasonal", "residual"])


VEL = f"""SELECT *, CASE WHEN sec > lag(sec) OVER {ROWS} THEN (amount - lag(amount) OVER {ROWS}) / ((sec - lag(sec) OVER {ROWS}) / 86400e0) END AS velocity FROM txn"""


@query("W11_velocity", f"WITH {TXN}, v AS ({VEL}) SELECT event_id, {r('velocity', 'velocity', 2)}, {r(f'avg(velocity) OVER {back(7)}', 'velocity_mean', 2)}, {r(f'max(velocity) OVER {back(7)} - min(velocity) OVER {back(7)}', 'velocity_range', 2)} FROM v")
def w11(spark, sf_dir):
    return w.rounded(w.velocity(txn(spark, sf_dir), "entity_id", ORDER, "amount", 7), KEY, ["velocity", "velocity_mean", "velocity_range"], 2)


W12 = f"""WITH {TXN}, m AS (SELECT *, amount - 2 * lag(amount) OVER {ROWS} + lag(amount, 2) OVER {ROWS} AS momentum FROM txn),
c AS (SELECT event_id, momentum, avg(momentum) OVER {back(7)} AS mean, CAST(sum(CAST(momentum > 0 AS INT)) OVER {back(7)} AS BIGINT) AS up, CAST(sum(CAST(momentum < 0 AS INT)) OVER {back(7)} AS BIGINT) AS down FROM m)
SELECT event_id, {r('momentum', 'momentum')}, {r('mean', 'momentum_mean')}, up AS momentum_up, down AS momentum_down, {r('CASE WHEN up + down > 0 THEN up / (up + down) END', 'momentum_ratio')} FROM c"""


@query("W12_momentum", W12)
def w12(spark, sf_dir):
    return w.rounded(w.momentum(txn(spark, sf_dir), "entity_id", ORDER, "amount", 7), KEY, ["momentum", "momentum_mean", "momentum_up", "momentum_down", "momentum_ratio"])


W13 = f"""WITH {TXN} SELECT event_id, {r(f'stddev_samp(value) OVER {back(7)}', 'vol_std')}, {r(f'stddev_samp(value) OVER {back(7)} / avg(value) OVER {back(7)}', 'vol_cv')},
{r(f'max(value) OVER {back(7)} - min(value) OVER {back(7)}', 'vol_range')}, {r(f'quantile_cont(value, 0.75) OVER {back(7)} - quantile_cont(value, 0.25) OVER {back(7)}', 'vol_iqr')} FROM txn"""


@query("W13_volatility", W13)
def w13(spark, sf_dir):
    return w.rounded(w.volatility(txn(spark, sf_dir), "entity_id", "value", 7), KEY, ["vol_std", "vol_cv", "vol_range", "vol_iqr"])


def log_sql(x: str) -> str:
    """Signed logarithm: elasticities span many orders of magnitude, so that is what is compared."""
    return f"sign({x}) * ln(1 + abs({x}))"


W14 = f"""WITH {TXN}, d AS (SELECT *, value / nullif(lag(value) OVER {ROWS}, 0) - 1 AS dv, abs(sec / nullif(lag(sec) OVER {ROWS}, 0) - 1) AS dr FROM txn),
e AS (SELECT *, CASE WHEN dr > 0 THEN dv / dr END AS elasticity FROM d), m AS (SELECT *, avg(elasticity) OVER {back(7)} AS m, stddev_samp(elasticity) OVER {back(7)} AS s FROM e)
SELECT event_id, {r(log_sql('elasticity'), 'log_elasticity')}, {r(log_sql('m'), 'log_mean', 3)}, {r(log_sql('s'), 'log_std', 3)}, CAST(sum(CAST(abs(elasticity) > 2 AS INT)) OVER {back(7)} AS BIGINT) AS elastic_count FROM m"""


@query("W14_elasticity", W14)
def w14(spark, sf_dir):
    found = w.elasticity(txn(spark, sf_dir), "entity_id", ORDER, "value", "sec", 7)
    log = lambda c: F.signum(c) * F.log1p(F.abs(c))
    found = found.select(*KEY, "elastic_count", log("elasticity").alias("log_elasticity"), log("elasticity_mean").alias("log_mean"), log("elasticity_std").alias("log_std"))
    return w.rounded_by(found, [*KEY, "elastic_count"], {"log_elasticity": 4, "log_mean": 3, "log_std": 3})


W15 = f"""WITH {TXN}, i AS (SELECT *, CAST(row_number() OVER {ROWS} AS DOUBLE) AS i, lag(value) OVER {ROWS} AS p FROM txn)
SELECT event_id, {r(f'CASE WHEN count(*) OVER {back(7)} > 1 THEN power(corr(i, value) OVER {back(7)}, 2) END', 'trend_r2')}, {r(f'1 - stddev_samp(value) OVER {back(7)} / avg(value) OVER {back(7)}', 'consistency')} FROM i"""


@query("W15_stability", W15)
def w15(spark, sf_dir):
    df = w.stability(txn(spark, sf_dir), "entity_id", ORDER, "value", 7)
    df = df.withColumn("trend_r2", F.when(F.count("*").over(w.back("entity_id", 7)) > 1, F.col("trend_r2")))
    return w.rounded(df, KEY, ["trend_r2", "consistency"])


@query("W19_trimmed_mean", f"WITH {TXN}, p AS (SELECT *, percent_rank() OVER (PARTITION BY entity_id ORDER BY value) AS pr FROM txn) SELECT entity_id, {r('avg(value)', 'trimmed_mean')}, count(*) AS n FROM p WHERE pr BETWEEN 0.1e0 AND 0.9e0 GROUP BY 1")
def w19(spark, sf_dir):
    return w.rounded(w.trimmed_mean(txn(spark, sf_dir), "entity_id", "value"), ["entity_id"], ["trimmed_mean", "n"])


@query("W20_latest_per_entity", f"WITH {TXN} SELECT entity_id, event_id, category, amount FROM txn QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, event_id DESC) = 1")
def w20(spark, sf_dir):
    return w.latest(txn(spark, sf_dir), "entity_id", ORDER, ["event_id", "category", "amount"])


@query("W21_global_rank_bins", "SELECT l_orderkey, l_linenumber, l_partkey, ntile(10) OVER (ORDER BY l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS decile FROM lineitem")
def w21(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
    return w.ntile(df, ["l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], 10, "decile").select("l_orderkey", "l_linenumber", "l_partkey", "decile")


HOURS = (1, 6, 12, 24, 168)


STATS = {"sum": "sum", "avg": "avg", "max": "max"}
W22 = f"WITH {TXN} SELECT event_id, " + ", ".join([f"count(*) OVER {back(h / 24)} AS count_{h}h" for h in HOURS] + [r(f"{f}(value) OVER {back(h / 24)}", f"{n}_{h}h") for n, f in STATS.items() for h in HOURS]) + f", {r(f'count(*) OVER {back(1 / 24)} / count(*) OVER {back(7)}', 'acceleration')} FROM txn"


@query("W22_fraud_velocity", W22)
def w22(spark, sf_dir):
    df = w.short_windows(txn(spark, sf_dir), "entity_id", "value", HOURS)
    return w.rounded(df, [*KEY, *(f"count_{h}h" for h in HOURS)], [f"{c}_{h}h" for h in HOURS for c in STATS] + ["acceleration"])


W23 = f"""WITH {TXN} SELECT event_id, {r('(value - avg(value) OVER ()) / stddev_samp(value) OVER ()', 'z_all')}, {r('(value - avg(value) OVER (PARTITION BY category)) / stddev_samp(value) OVER (PARTITION BY category)', 'z_category')},
{r("(value - avg(value) OVER (PARTITION BY hour(ts))) / stddev_samp(value) OVER (PARTITION BY hour(ts))", 'z_hour')}, {r('percent_rank() OVER (ORDER BY value)', 'percent_rank', 6)} FROM txn"""


@query("W23_amount_zscores", W23)
def w23(spark, sf_dir):
    df = w.percent_rank(txn(spark, sf_dir), "value", "percent_rank").withColumn("hour", F.hour("ts"))
    for by, name in (([], "z_all"), (["category"], "z_category"), (["hour"], "z_hour")):
        df = w.group_zscore(df, "value", by, name)
    return w.rounded_by(df, KEY, {"z_all": 4, "z_category": 4, "z_hour": 4, "percent_rank": 6})


W24 = f"""WITH {TXN}, d AS (SELECT * FROM txn WHERE amount > 0), z AS (SELECT *, CASE WHEN stddev_pop(value) OVER (PARTITION BY entity_id) > 0 THEN (value - avg(value) OVER (PARTITION BY entity_id)) / stddev_pop(value) OVER (PARTITION BY entity_id) ELSE 0 END AS z, count(*) OVER (PARTITION BY entity_id) AS n FROM d),
g AS (SELECT *, CASE WHEN z - lag(z) OVER (PARTITION BY entity_id ORDER BY z, event_id) > 0.3e0 THEN 1 ELSE 0 END AS fresh FROM z),
c AS (SELECT *, sum(fresh) OVER (PARTITION BY entity_id ORDER BY z, event_id ROWS UNBOUNDED PRECEDING) AS run FROM g),
s AS (SELECT *, count(*) OVER (PARTITION BY entity_id, run) AS size FROM c)
SELECT event_id, CAST(CASE WHEN n < 3 THEN 0 WHEN size < 2 THEN -1 ELSE run END AS BIGINT) AS cluster FROM s"""


@query("W24_amount_clusters", W24)
def w24(spark, sf_dir):
    return w.amount_clusters(txn(spark, sf_dir).where("amount > 0"), "entity_id", "value").select("event_id", "cluster")


W25 = f"""WITH {TXN}, d AS (SELECT * FROM txn WHERE amount > 0 AND day >= DATE '2024-01-10'), g AS (SELECT *, (sec - lag(sec) OVER {ROWS}) / 86400e0 AS gap FROM d)
SELECT event_id, {r('gap', 'gap_days')}, regexp_matches(lower(category), 'view|click') AS keyword, CASE WHEN regexp_matches(lower(category), 'view|click') THEN 'activity' WHEN gap BETWEEN 6 AND 8 THEN 'weekly' WHEN gap < 1 THEN 'frequent' ELSE 'other' END AS kind FROM g"""


@query("W25_income_deposits", W25)
def w25(spark, sf_dir):
    from tallgrass.operators.aggregates import income_deposits

    return w.rounded(income_deposits(txn(spark, sf_dir), "entity_id", "category", ["view", "click"], "2024-01-10"), KEY, ["gap_days", "keyword", "kind"])


C3 = "(PARTITION BY entity_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)"


@query("W26_income_shocks", f"WITH {TXN}, z AS (SELECT event_id, CASE WHEN stddev_samp(amount) OVER {C3} > 0 THEN (amount - avg(amount) OVER {C3}) / stddev_samp(amount) OVER {C3} END AS z FROM txn) SELECT event_id, {r('z', 'shock_z')}, CASE WHEN round(z, 9) > 1 THEN 'up' WHEN round(z, 9) < -1 THEN 'down' ELSE 'none' END AS shock FROM z")
def w26(spark, sf_dir):
    return w.rounded(w.shocks(txn(spark, sf_dir), "entity_id", ORDER, "amount"), KEY, ["shock_z", "shock"])


@query("W27_merchant_diversity", f"WITH {TXN} SELECT event_id, count(DISTINCT category) OVER {back(7)} AS distinct_kinds, count(*) OVER {back(7)} AS n_rows, {r(f'1 - count(DISTINCT category) OVER {back(7)} / count(*) OVER {back(7)}', 'repeat_ratio')}, row_number() OVER (PARTITION BY entity_id, category ORDER BY ts, event_id) = 1 AS new_kind FROM txn")
def w27(spark, sf_dir):
    return w.rounded(w.diversity(txn(spark, sf_dir), "entity_id", "category", ORDER, 7), KEY, ["distinct_kinds", "n_rows", "repeat_ratio", "new_kind"])


SHARE = [f"(sum(CASE WHEN category = '{k}' THEN abs(value) ELSE 0.0e0 END) OVER {back(7)} / nullif(sum(abs(value)) OVER {back(7)}, 0))" for k in KINDS]
W28 = f"WITH {TXN} SELECT event_id, {r(' + '.join(f'{s} * {s}' for s in SHARE), 'hhi')}, {r(' + '.join(f'CASE WHEN {s} > 0 THEN -{s} * ln({s}) WHEN {s} = 0 THEN 0 END' for s in SHARE), 'entropy')}, {r('greatest(' + ', '.join(SHARE) + ')', 'top_share')} FROM txn"


@query("W28_category_concentration", W28)
def w28(spark, sf_dir):
    return w.rounded(w.concentration(txn(spark, sf_dir), "entity_id", "category", "value", KINDS, 7), KEY, ["hhi", "entropy", "top_share"])


DAILY = f"""{TXN}, ends AS (SELECT entity_id, min(day) AS a, max(day) AS b FROM txn GROUP BY 1), days AS (SELECT entity_id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM ends),
sums AS (SELECT entity_id, day, sum(value) AS paid FROM txn GROUP BY 1, 2), daily AS (SELECT entity_id, day, coalesce(paid, 0) AS paid, CASE WHEN coalesce(paid, 0) > 100 THEN 0 WHEN coalesce(paid, 0) > 0 THEN 1 ELSE 2 END AS bucket FROM days LEFT JOIN sums USING (entity_id, day)),
led AS (SELECT *, lead(paid) OVER (PARTITION BY entity_id ORDER BY day) AS next_amount, lead(bucket, 7) OVER (PARTITION BY entity_id ORDER BY day) AS bucket_7d FROM daily)"""


def led(spark, sf_dir):
    """Days without a payment are delinquent, days with a small one half so."""
    daily = w.filled_days(txn(spark, sf_dir).withColumnRenamed("value", "paid"), "entity_id", "day", "paid")
    daily = daily.withColumn("bucket", F.when(F.col("paid") > 100, 0).when(F.col("paid") > 0, 1).otherwise(2))
    return w.outcome_leads(daily, "entity_id", "day", "paid", "bucket")


@query("W29_outcome_leads", f"WITH {DAILY} SELECT entity_id, day, bucket, {r('paid', 'paid', 2)}, {r('next_amount', 'next_amount', 2)}, next_amount > 0 AS next_paid, bucket_7d, bucket_7d - bucket AS bucket_change, coalesce(bucket_7d > bucket, false) AS worse FROM led")
def w29(spark, sf_dir):
    return w.rounded(led(spark, sf_dir), ["entity_id", "day", "bucket", "next_paid", "bucket_7d", "bucket_change", "worse"], ["paid", "next_amount"], 2)


@query("W29b_outcome_leaks", f"WITH {DAILY} SELECT count(*) AS n, count(next_amount) AS known, count(*) FILTER (next_amount IS NOT NULL AND day >= DATE '2024-01-20') AS leaks FROM led")
def w29b(spark, sf_dir):
    return w.outcome_leaks(led(spark, sf_dir), "day", "next_amount", "2024-01-20")


W31 = f"""WITH {TXN}, m AS (SELECT event_id, entity_id, ts, avg(value) OVER (PARTITION BY entity_id ORDER BY ts, event_id ROWS 4 PRECEDING) AS m, stddev_samp(value) OVER (PARTITION BY entity_id ORDER BY ts, event_id ROWS 4 PRECEDING) AS s FROM txn)
SELECT event_id, coalesce(abs(m - lag(m) OVER {ROWS}) > lag(s) OVER {ROWS} OR abs(s - lag(s) OVER {ROWS}) > 0.5e0 * lag(s) OVER {ROWS}, false) AS regime_change FROM m"""


@query("W31_regime_change", W31)
def w31(spark, sf_dir):
    return w.regime_change(txn(spark, sf_dir), "entity_id", ORDER, "value").select("event_id", "regime_change")


@query("W32_temporal_folds", f"WITH {TXN}, f AS (SELECT * FROM (VALUES (0, DATE '2024-01-10', DATE '2024-01-15'), (1, DATE '2024-01-15', DATE '2024-01-20'), (2, DATE '2024-01-20', DATE '2024-01-25')) v(fold, a, b)) SELECT fold, CASE WHEN day < a THEN 'train' ELSE 'test' END AS role, count(*) AS n, {r('sum(amount)', 'total', 2)} FROM txn JOIN f ON day < b GROUP BY 1, 2")
def w32(spark, sf_dir):
    folds = w.temporal_folds(txn(spark, sf_dir), "day", [("2024-01-10", "2024-01-15"), ("2024-01-15", "2024-01-20"), ("2024-01-20", "2024-01-25")])
    return w.rounded(folds.groupBy("fold", "role").agg(F.count("*").alias("n"), F.sum("amount").alias("total")), ["fold", "role", "n"], ["total"], 2)


@query("W33_last_actor_hash", f"WITH {TXN} SELECT entity_id, CAST(('0x' || substr(md5(category), 1, 8)) AS BIGINT) % 10000 AS actor_hash FROM txn QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, event_id DESC) = 1")
def w33(spark, sf_dir):
    last = w.latest(txn(spark, sf_dir), "entity_id", ORDER, ["category"])
    return last.select("entity_id", (F.conv(F.substring(F.md5("category"), 1, 8), 16, 10).cast("long") % 10000).alias("actor_hash"))


W34 = f"""WITH {TXN}, codes AS (SELECT category, row_number() OVER (ORDER BY count(*) DESC, category) AS code FROM txn WHERE event_id % 5 <> 0 GROUP BY 1 QUALIFY code <= 3),
m AS (SELECT avg(amount) AS mean, stddev_samp(amount) AS sd FROM txn WHERE event_id % 5 <> 0),
l AS (SELECT entity_id, sec, (amount - mean) / sd AS x, coalesce(code, 0) AS code, row_number() OVER (PARTITION BY entity_id ORDER BY ts DESC, event_id DESC) AS k FROM txn LEFT JOIN codes USING (category), m QUALIFY k <= 8),
g AS (SELECT *, coalesce(sec - lag(sec) OVER (PARTITION BY entity_id ORDER BY k DESC), 0) AS gap FROM l),
s AS (SELECT entity_id, count(*) AS used, string_agg(CAST(CAST(round(x * 1000 + {SHIFT}) AS BIGINT) AS VARCHAR), ',' ORDER BY k DESC) AS v, string_agg(CAST(gap AS VARCHAR), ',' ORDER BY k DESC) AS g, string_agg(CAST(code AS VARCHAR), ',' ORDER BY k DESC) AS c FROM g GROUP BY 1)
SELECT entity_id, used, repeat('0,', CAST(8 - used AS INT)) || v AS values, repeat('0,', CAST(8 - used AS INT)) || g AS gaps, repeat('0,', CAST(8 - used AS INT)) || c AS codes FROM s"""


@query("W34_event_sequences", W34)
def w34(spark, sf_dir):
    """The last eight events of an entity; dictionary and scale are learnt from four fifths of the events."""
    rows = txn(spark, sf_dir)
    known = rows.where("event_id % 5 <> 0")
    moments = known.agg(F.avg("amount").alias("mean"), F.stddev("amount").alias("sd"))
    found = w.event_sequences(rows, w.sequence_codes(known, "category", 3), moments, "entity_id", "ts", ORDER, "amount", "category", 8)
    whole = F.transform("values", lambda x: F.round(x * 1000 + 1.3e-7).cast("long"))
    listed = {"values": whole, "gaps": F.col("gaps"), "codes": F.col("codes")}
    return found.select("entity_id", F.col("used").cast("long").alias("used"), *[F.array_join(x.cast("array<string>"), ",").alias(n) for n, x in listed.items()])


DAYS = (7, 30)
LIMITED = f"""{TXN}, base AS (SELECT *, 400e0 + entity_id % 3 * 100 AS lim, 3000e0 + entity_id % 5 * 500 AS income, last_day(day) AS due FROM txn)"""


def limited(spark, sf_dir):
    return txn(spark, sf_dir).withColumns({"lim": F.expr("400e0 + entity_id % 3 * 100"), "income": F.expr("3000e0 + entity_id % 5 * 500"), "due": F.last_day("day")})


def per_window(columns: dict[str, str], digits: int = 4) -> str:
    """{b} in a column's SQL stands for the window, {n} in its name for the days."""
    return ", ".join(r(e.replace("{b}", back(n)), c.replace("{n}", str(n)), digits) for n in DAYS for c, e in columns.items())


W16_COLUMNS = {"velocity_{n}d": "avg(d) OVER {b}", "momentum_{n}d": "avg(dd) OVER {b}", "cv_{n}d": "stddev_samp(otb) OVER {b} / nullif(abs(avg(otb) OVER {b}), 0)", "utilisation_mean_{n}d": "avg(use) OVER {b}", "utilisation_max_{n}d": "max(use) OVER {b}"}
W16 = f"""WITH {LIMITED}, o AS (SELECT *, lim - value AS otb, value / lim AS use FROM base), d AS (SELECT *, otb - lag(otb) OVER {ROWS} AS d FROM o), dd AS (SELECT *, d - lag(d) OVER {ROWS} AS dd FROM d)
SELECT event_id, {r('otb', 'otb')}, {r('otb / lim', 'available')}, {r('use', 'utilisation')}, {per_window(W16_COLUMNS)} FROM dd"""


@query("W16_open_to_buy", W16)
def w16(spark, sf_dir):
    found = q.open_to_buy(limited(spark, sf_dir), "entity_id", ORDER, "value", "lim", DAYS)
    return w.rounded(found, KEY, ["otb", "available", "utilisation", *(c.replace("{n}", str(n)) for n in DAYS for c in W16_COLUMNS)])


W17_COLUMNS = {"due_mean_{n}d": "avg(to_due) OVER {b}", "due_min_{n}d": "CAST(min(to_due) OVER {b} AS DOUBLE)", "ratio_mean_{n}d": "avg(pr) OVER {b}", "ratio_min_{n}d": "min(pr) OVER {b}"}
W17 = f"""WITH {LIMITED}, o AS (SELECT *, datediff('day', day, due) AS to_due, value / nullif(lim - value, 0) AS pr FROM base)
SELECT event_id, to_due AS days_to_due, {r('pr', 'payment_ratio')}, {r('value / income', 'payment_to_income')}, {r('(lim - value) / income', 'debt_to_income')}, {per_window(W17_COLUMNS)} FROM o"""


@query("W17_repayment_buffer", W17)
def w17(spark, sf_dir):
    df = limited(spark, sf_dir).withColumn("owed", F.col("lim") - F.col("value"))
    found = q.repayment_buffer(df, "entity_id", "due", "day", "value", "owed", "income", DAYS)
    found = found.withColumns({f"due_min_{n}d": F.col(f"due_min_{n}d").cast("double") for n in DAYS})
    return w.rounded(found, [*KEY, "days_to_due"], ["payment_ratio", "payment_to_income", "debt_to_income", *(c.replace("{n}", str(n)) for n in DAYS for c in W17_COLUMNS)])


W18_COLUMNS = {
    "instalment_mean_{n}d": "avg(value) OVER {b}", "instalment_cv_{n}d": "stddev_samp(value) OVER {b} / nullif(abs(avg(value) OVER {b}), 0)", "increases_{n}d": "CAST(sum(up) OVER {b} AS DOUBLE)", "burden_mean_{n}d": "avg(burden) OVER {b}", "burden_max_{n}d": "max(burden) OVER {b}",
    "regularity_{n}d": "1 / (1 + stddev_samp(gap) OVER {b})", "use_mean_{n}d": "avg(use) OVER {b}", "use_max_{n}d": "max(use) OVER {b}", "use_min_{n}d": "min(use) OVER {b}", "use_std_{n}d": "stddev_samp(use) OVER {b}", "use_range_{n}d": "max(use) OVER {b} - min(use) OVER {b}",
    "high_use_{n}d": "CAST(sum(CAST(use > 0.8 AS INT)) OVER {b} AS DOUBLE)", "use_velocity_{n}d": "avg(d) OVER {b}",
}
W18 = f"""WITH {LIMITED}, o AS (SELECT *, value / income AS burden, value * 6 / lim AS use, CAST(value > lag(value) OVER {ROWS} AS INT) AS up, datediff('day', lag(day) OVER {ROWS}, day) AS gap FROM base),
d AS (SELECT *, use - lag(use) OVER {ROWS} AS d FROM o) SELECT event_id, {r('burden', 'burden')}, {r('use', 'utilisation')}, {per_window(W18_COLUMNS)} FROM d"""


@query("W18_installment_utilisation", W18)
def w18(spark, sf_dir):
    df = limited(spark, sf_dir).withColumn("owed", F.col("value") * 6)
    found = q.instalment_features(df, "entity_id", ORDER, "value", "income", "owed", "lim", "day", DAYS)
    found = found.withColumns({f"{c}_{n}d": F.col(f"{c}_{n}d").cast("double") for c in ("increases", "high_use") for n in DAYS})
    return w.rounded(found, KEY, ["burden", "utilisation", *(c.replace("{n}", str(n)) for n in DAYS for c in W18_COLUMNS)])


SPANS = {"3m": 7, "6m": 14, "12m": 21}  # the events cover a month
W30_COLUMNS = {"worst": "max(bucket)", "worst_delay": "max(delay)", "forward": "CAST(sum(CAST(bucket > old AS INT)) {b} AS BIGINT)", "back": "CAST(sum(CAST(bucket < old AS INT)) {b} AS BIGINT)", "moves": "CAST(sum(CAST(bucket <> old AS INT)) {b} AS BIGINT)", "cures": "CAST(sum(CAST(bucket < old AND bucket = 0 AS INT)) {b} AS BIGINT)"}
W30 = f"""WITH {TXN}, k AS (SELECT *, CASE WHEN value > 100 THEN 2 WHEN value > 40 THEN 1 ELSE 0 END AS bucket, CAST(floor(value) AS BIGINT) AS delay FROM txn), l AS (SELECT *, lag(bucket) OVER {ROWS} AS old FROM k),
i AS (SELECT *, sum(CASE WHEN old IS NULL OR bucket <> old THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM l)
SELECT event_id, bucket, CASE WHEN bucket > old THEN 'forward' WHEN bucket < old THEN 'back' WHEN old IS NOT NULL THEN 'stay' END AS roll, coalesce(bucket < old AND bucket = 0, false) AS self_cure,
row_number() OVER (PARTITION BY entity_id, island ORDER BY ts, event_id) AS time_in_bucket, CAST(day - first_value(day) OVER (PARTITION BY entity_id, island ORDER BY ts, event_id) AS BIGINT) AS days_in_bucket,
""" + ", ".join((f"{e} OVER {back(n)}" if "{b}" not in e else "coalesce(" + e.replace("{b}", f"OVER {back(n)}") + ", 0)") + f" AS {c}_{s}" for s, n in SPANS.items() for c, e in W30_COLUMNS.items()) + " FROM i"


@query("W30_delinquency_rolls", W30)
def w30(spark, sf_dir):
    df = txn(spark, sf_dir).withColumns({"bucket": F.when(F.col("value") > 100, 2).when(F.col("value") > 40, 1).otherwise(0), "delay": F.floor("value")})
    found = q.delinquency_rolls(df, "entity_id", ORDER, "day", "bucket", "delay", SPANS)
    return found.select("event_id", "bucket", "roll", "self_cure", "time_in_bucket", "days_in_bucket", *(f"{c}_{s}" for s in SPANS for c in W30_COLUMNS))
