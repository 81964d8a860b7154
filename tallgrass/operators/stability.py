"""Stability of populations, incomes and states; leaks; triggers; paired effects."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import long_form
from .quantiles import quantiles
from .statistics import auc_by, chi_square


def psi_parts(base: DataFrame, now: DataFrame, columns: list[str], segment: str, period: str, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """(part, key, feature, psi, light): population stability of now against base, as a whole, within each segment (both sides
    of the segment), and over time (each period of now against all of base), on quantile bins of the whole base. Shares are at
    least floor; light: green under 0.1, amber under 0.25, else red.

    The rows are counted once, by feature, bin, segment and period; the parts are sums of these counts."""
    rows = long_form(base, columns, [segment, period]).withColumn("side", F.lit(0)).unionByName(long_form(now, columns, [segment, period]).withColumn("side", F.lit(1))).where("value IS NOT NULL")
    edges = quantiles(rows.where("side = 0"), ["feature"], "value", [i / bins for i in range(1, bins)]).select("feature", F.array_distinct("q").alias("edges"))
    placed = rows.join(F.broadcast(edges), "feature").withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))))
    counts = placed.groupBy("feature", "bin", segment, period).agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    total = lambda by: counts.groupBy(*by, "feature", "bin").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    whole = total([]).select(F.lit("all").alias("part"), F.lit("").alias("key"), "feature", "bin", "a", "b")
    by_segment = total([segment]).select(F.lit("segment").alias("part"), F.col(segment).cast("string").alias("key"), "feature", "bin", "a", "b")
    seen = total([period]).where("b > 0").select(F.col(period).cast("string").alias("key"), "feature", "bin", "b")
    grid = seen.select("key", "feature").distinct().join(total([]).where("a > 0").select("feature", "bin", "a"), "feature")
    by_period = grid.join(seen, ["key", "feature", "bin"], "full").select(F.lit("period").alias("part"), "key", "feature", "bin", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    w = Window.partitionBy("part", "key", "feature")
    p, q = (F.greatest(F.lit(floor), F.col(c) / F.nullif(F.sum(c).over(w), F.lit(0))) for c in "ab")
    terms = whole.unionByName(by_segment).unionByName(by_period).select("part", "key", "feature", ((q - p) * F.log(q / p)).alias("t"))
    found = terms.groupBy("part", "key", "feature").agg(F.sum("t").alias("psi"))
    return found.withColumn("light", F.when(F.col("psi") < 0.1, "green").when(F.col("psi") < 0.25, "amber").otherwise("red"))


def target_leaks(df: DataFrame, target: str, category: str, numeric: list[str], categorical: list[str], is_test: Column, correlation: float = 0.9, association: float = 0.85, jump: float = 0.1) -> DataFrame:
    """(kind, feature, value, leak): correlation of numeric columns with the target, Cramer's V of categorical ones with its
    category, and by how much the share of nulls differs between test and training rows."""
    missing = lambda c, side: F.avg(F.when(side, F.col(c).isNull().cast("double")))
    one = df.agg(*[F.corr(c, target).alias(f"r{i}") for i, c in enumerate(numeric)], *[(missing(c, is_test) - missing(c, ~is_test)).alias(f"m{i}") for i, c in enumerate(numeric + categorical)])
    row = lambda kind, c, value, leak: F.struct(F.lit(kind).alias("kind"), F.lit(c).alias("feature"), value.alias("value"), F.coalesce(leak, F.lit(False)).alias("leak"))
    rows = [row("correlation", c, F.col(f"r{i}"), F.abs(f"r{i}") > correlation) for i, c in enumerate(numeric)] + [row("missing", c, F.col(f"m{i}"), F.abs(f"m{i}") > jump) for i, c in enumerate(numeric + categorical)]
    found = one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    for c in categorical:
        v = chi_square(df.where(F.col(c).isNotNull()), c, category)
        found = found.unionByName(v.select(F.lit("association").alias("kind"), F.lit(c).alias("feature"), F.col("cramers_v").alias("value"), F.coalesce(F.col("cramers_v") > association, F.lit(False)).alias("leak")))
    return found


def stability_scores(df: DataFrame, entity: str, order: list[str], day: str, amount: str, source: str, least: int = 6, volatile: float = 0.5, steady: float = 0.6, critical: float = 2.0) -> DataFrame:
    """One row an entity with least rows or more: variation, range over median, least-squares trend over the rows' order with t
    against a critical value, direction and forecasts 3, 6 and 12 steps on (not below 0), irregularity of gaps and amounts,
    constancy of the source, and the weighted score with its verdict."""
    w = Window.partitionBy(entity).orderBy(*order)
    rows = df.withColumns({"__i": (F.row_number().over(w) - 1).cast("double"), "__g": F.datediff(day, F.lag(day).over(w)).cast("double"), "__s": F.coalesce((F.col(source) != F.lag(source).over(w)).cast("int"), F.lit(1))})
    y = F.col(amount)
    g = rows.groupBy(entity).agg(
        F.count("*").alias("n"), F.avg(y).alias("mean"), F.stddev_pop(y).alias("std"), F.stddev(y).alias("__std"), ((F.max(y) - F.min(y)) / F.nullif(F.percentile(y, 0.5), F.lit(0.0))).alias("range_share"),
        F.regr_slope(y, F.col("__i")).alias("slope"), F.regr_intercept(y, F.col("__i")).alias("intercept"), F.regr_r2(y, F.col("__i")).alias("r2"), F.stddev("__g").alias("__gs"), F.avg("__g").alias("__gm"), F.sum("__s").alias("__changes"),
    ).where(F.col("n") >= least)
    r2 = F.coalesce("r2", F.lit(0.0))
    t = F.when(r2 < 1, F.signum("slope") * F.sqrt(r2 * (F.col("n") - 2) / (1 - r2)))
    g = g.withColumns({"r2": r2, "t": t, "cv": F.when(F.col("mean") > 0, F.col("std") / F.col("mean"))})
    clear = F.coalesce(F.abs("t") > critical, F.lit(False)) & (F.abs("slope") >= 0.01 * F.col("mean"))
    least_one = lambda a, b: F.when(b > 0, F.least(F.lit(1.0), a / b)).otherwise(1.0)
    irregular = 0.6 * least_one(F.col("__gs"), F.col("__gm")) + 0.4 * least_one(F.col("__std"), F.col("mean"))
    g = g.withColumns({"direction": F.when(clear & (F.col("slope") > 0), "increasing").when(clear, "decreasing").otherwise("stable"), "irregularity": irregular, "employment": 1 - F.least(F.lit(1.0), F.col("__changes") / F.col("n"))})
    score = 0.35 * (1 - F.least(F.lit(1.0), F.coalesce("cv", F.lit(1e9)) / volatile)) + 0.25 * F.col("r2") + 0.25 * (1 - F.col("irregularity")) + 0.15 * F.col("employment")
    ahead = {f"forecast_{k}": F.greatest(F.lit(0.0), F.col("intercept") + F.col("slope") * (F.col("n") - 1 + k)) for k in (3, 6, 12)}
    return g.withColumns({"overall": F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), **ahead}).withColumn("stable", F.col("overall") >= steady).drop("__std", "__gs", "__gm", "__changes", "intercept")


def transition_matrices(df: DataFrame, entity: str, order: list[str], state: str, states: list[str], smoothing: float = 0.0, by: str | None = None) -> DataFrame:
    """(by, from_state, to_state, n, probability): every cell of the states' matrix, of each value of by where it is given. A
    state that nothing leaves is absorbing: it stays with probability 1. Other rows are smoothed."""
    keys = [by] if by else []
    w = Window.partitionBy(entity).orderBy(*order)
    steps = df.select(*keys, F.col(state).alias("from_state"), F.lead(state).over(w).alias("to_state")).where(F.col("to_state").isNotNull())
    counts = steps.groupBy(*keys, "from_state", "to_state").agg(F.count("*").alias("n"))
    names = F.array(*[F.lit(s) for s in states])
    every = (df.select(by).distinct() if by else df.sparkSession.range(1)).withColumn("from_state", F.explode(names)).withColumn("to_state", F.explode(names)).select(*keys, "from_state", "to_state")
    cells = every.join(counts, [*keys, "from_state", "to_state"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    left = F.sum("n").over(Window.partitionBy(*keys, "from_state"))
    stays = (F.col("from_state") == F.col("to_state")).cast("double")
    return cells.withColumn("probability", F.when(left == 0, stays).otherwise((F.col("n") + smoothing) / (left + smoothing * len(states))))


def sector_votes(edges: DataFrame, similar: DataFrame, sectors: DataFrame, employer: float = 0.5, peer: float = 0.3) -> DataFrame:
    """(src, sector, share): votes for a node's sector, employer for each of its employers' and peer times similarity for each of
    its peers' (src, peer, similarity), over all its votes. sectors is (id, sector); nodes without one have no vote."""
    a = edges.select("src", "dst").distinct().join(sectors.withColumnRenamed("id", "dst"), "dst").select("src", "sector", F.lit(employer).alias("v"))
    b = similar.join(sectors.withColumnRenamed("id", "peer"), "peer").select("src", "sector", (peer * F.col("similarity")).alias("v"))
    votes = a.unionByName(b).groupBy("src", "sector").agg(F.sum("v").alias("v"))
    return votes.select("src", "sector", (F.col("v") / F.sum("v").over(Window.partitionBy("src"))).alias("share"))


def report_kpis(df: DataFrame, y: str, p: str, level: str, top: float = 0.8) -> DataFrame:
    """(part, n, rmse, mae, r2, top_value): of all rows and by level; top_value is the y of those rows whose p is at the top
    quantile of all or above."""
    cut = quantiles(df, [], p, [top]).select(F.col("q")[0].alias("__cut"))
    e = F.col(y) - F.col(p)
    rows = df.crossJoin(F.broadcast(cut)).withColumn("part", F.explode(F.array(F.lit("all"), F.col(level).cast("string"))))
    g = rows.groupBy("part").agg(F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), (1 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count("*"), F.lit(0.0))).alias("r2"), F.sum(F.when(F.col(p) >= F.col("__cut"), F.col(y))).alias("top_value"))
    return g


def paired_effect(pairs: DataFrame, difference: str) -> DataFrame:
    """Mean of the pairs' differences with its standard error, t, 95 % interval and verdict."""
    g = pairs.agg(F.count(difference).alias("pairs"), F.avg(difference).alias("effect"), (F.stddev(difference) / F.sqrt(F.count(difference))).alias("se"))
    low, high = F.col("effect") - 1.96 * F.col("se"), F.col("effect") + 1.96 * F.col("se")
    return g.select("pairs", "effect", "se", (F.col("effect") / F.nullif("se", F.lit(0.0))).alias("t"), low.alias("low"), high.alias("high"), ((low > 0) | (high < 0)).alias("significant"))


def retrain_triggers(before: DataFrame, now: DataFrame, label: str, p: str, drift: DataFrame, least_auc: float = 0.7, drop: float = 0.02, most_drift: float = 0.25, most_features: int = 1) -> DataFrame:
    """(trigger, value, bound, fired): AUC now, its drop since before, the number of drifted features and the largest drift, each
    against its bound; drift is (feature, psi)."""
    both = before.select(F.lit("a").alias("s"), label, p).unionByName(now.select(F.lit("b").alias("s"), label, p))
    auc = auc_by(both, "s", label, p).agg(F.max(F.when(F.col("s") == "a", F.col("auc"))).alias("a"), F.max(F.when(F.col("s") == "b", F.col("auc"))).alias("b"))
    one = auc.crossJoin(drift.agg(F.max("psi").alias("d"), F.count_if(F.col("psi") >= most_drift).cast("double").alias("k")))
    row = lambda name, value, bound, fired: F.struct(F.lit(name).alias("trigger"), value.alias("value"), F.lit(float(bound)).alias("bound"), F.coalesce(fired, F.lit(False)).alias("fired"))
    fall = F.col("a") - F.col("b")
    rows = [row("low auc", F.col("b"), least_auc, F.col("b") < least_auc), row("auc drop", fall, drop, fall > drop), row("drifted features", F.col("k"), most_features, F.col("k") >= most_features), row("largest drift", F.col("d"), most_drift, F.col("d") >= most_drift)]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def treatment_values(df: DataFrame, id: str, treatments: dict[str, tuple[str, float]], owed: str, blocked: dict[str, Column], explore: Column | None = None) -> DataFrame:
    """(id, action, value, explored): the treatment with the most of chance times what is owed less cost, by name of equal ones,
    among those that aren't blocked for the row; where explore holds, the second best is taken, if there is one."""
    value = {n: F.col(chance) * F.col(owed) - cost for n, (chance, cost) in treatments.items()}
    open_ = [F.when(~F.coalesce(blocked.get(n, F.lit(False)), F.lit(False)), F.struct((-v).alias("v"), F.lit(n).alias("n"))) for n, v in value.items()]
    ranked = F.array_sort(F.array_compact(F.array(*open_)))
    pick = F.when(explore & (F.size(ranked) > 1), 1).otherwise(0) if explore is not None else F.lit(0)
    rows = df.select(id, ranked.alias("r"), pick.alias("k")).where(F.size("r") > 0)
    return rows.select(id, F.col("r")[F.col("k")]["n"].alias("action"), (-F.col("r")[F.col("k")]["v"]).alias("value"), (F.col("k") == 1).alias("explored"))


def channel_values(df: DataFrame, entity: str, channel: str, ts: str, value: str, room: dict[str, int], off: float = 0.7, full: float = 0.5) -> DataFrame:
    """(entity, channel, value, best_hour, best_day): the channel worth most to an entity: its rows' value, times off outside of 8
    to 19 hours, times full where the channel has more rows than room in all; and the hour and weekday (1 Sunday) of most value
    on that channel, the earliest of equal ones."""
    used = df.groupBy(channel).agg(F.count("*").alias("__used"))
    limit = F.create_map(*[F.lit(x) for kv in room.items() for x in kv])
    load = used.select(channel, F.when(F.col("__used") > limit[F.col(channel)], full).otherwise(1.0).alias("__load"))
    rows = df.join(F.broadcast(load), channel).withColumn("__v", F.col(value) * F.when(F.hour(ts).between(8, 19), 1.0).otherwise(off) * F.col("__load")).withColumns({"__h": F.hour(ts), "__d": F.dayofweek(ts)})
    total = rows.groupBy(entity, channel).agg(F.sum("__v").alias("value"))
    best = total.groupBy(entity).agg(F.min(F.struct((-F.round("value", 9)).alias("r"), F.col(channel).alias("c"), "value")).alias("b")).select(entity, F.col("b.c").alias(channel), F.col("b.value").alias("value"))

    def most(part: str, name: str) -> DataFrame:
        sums = rows.groupBy(entity, channel, part).agg(F.sum("__v").alias("v"))
        return sums.groupBy(entity, channel).agg(F.min(F.struct((-F.round("v", 9)).alias("v"), F.col(part).alias("p"))).alias("b")).select(entity, channel, F.col("b.p").alias(name))

    return reduce(lambda a, b: a.join(b, [entity, channel]), [most("__h", "best_hour"), most("__d", "best_day")], best)


def segment_strategy(df: DataFrame, rule: str, cluster: str, strategies: dict[str, str], default: str) -> DataFrame:
    """df with persona (rule and cluster) and strategy: the persona's, else the rule's, else the default."""
    lookup = F.create_map(*[F.lit(x) for kv in strategies.items() for x in kv])
    persona = F.concat_ws("_", F.col(rule), F.col(cluster).cast("string"))
    return df.withColumn("persona", persona).withColumn("strategy", F.coalesce(lookup[F.col("persona")], lookup[F.col(rule)], F.lit(default)))
