"""Graph features as iterated joins over edge tables. Undirected edges are stored once and read both ways; every round
is written to the shared folder, so lineage stays short and lost executors repeat one round at most."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.sources.scratch import settle


def both_ways(edges: DataFrame, *more: str) -> DataFrame:
    """(src, dst) of undirected edges in both directions, without loops and repeats."""
    e = edges.where("src <> dst")
    return e.select("src", "dst", *more).unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *more)).dropDuplicates(["src", "dst"])


@contextmanager
def held_links(edges: DataFrame) -> Iterator[DataFrame]:
    """both_ways, dealt by src and held by the executors while the block runs, so that rounds join the nodes to it where its rows
    lie. Results have to be settled inside the block."""
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = edges.where("src <> dst").select(F.explode(ways).alias("e")).select("e.*")
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = both.repartition(parts, "src").dropDuplicates(["src", "dst"]).persist()
    try:
        yield links
    finally:
        links.unpersist()


def _told(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """What nodes (id, ...) tell each of their neighbours (to): the links stay where they lie, each part's nodes go to a hash table."""
    return links.join(nodes.hint("shuffle_hash"), F.col("src") == F.col("id")).drop("src", "id").withColumnRenamed("dst", "to")


def degrees(edges: DataFrame, weight: str | None = None) -> DataFrame:
    links = both_ways(edges, *([weight] if weight else []))
    return links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"), *([F.sum(weight).alias("weighted_degree")] if weight else []))


def merged(old: DataFrame, new: DataFrame) -> DataFrame:
    """Edge counts and weights of two graphs added up."""
    return old.unionByName(new).groupBy("src", "dst").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))


def pageranks(links: DataFrame, ways: list[tuple[float, DataFrame | None]], rounds: int = 10, tolerance: float = 0.0) -> DataFrame:
    """(id, rank0, rank1, ...) over held links, a rank for each way (damping, seeds or None): one pass a round serves them all.
    It ends after so many rounds or once none of the ranks moves by more than tolerance in all."""
    out = settle(links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("d")), "degrees")
    base, n = out, out.count()
    for i, (_, seeds) in enumerate(ways):
        if seeds is None:
            base = base.withColumn(f"restart{i}", F.lit(1.0 / max(n, 1)))
            continue
        marked = settle(out.select("id").join(seeds.select("id"), "id"), "rank-seeds")
        total = marked.count()
        marked = marked.select("id", F.lit(1.0 / max(total, 1)).alias("__s"))
        base = base.join(marked, "id", "left").withColumn(f"restart{i}", F.coalesce("__s", F.lit(0.0))).drop("__s")
    base = settle(base, "rank-base")
    names = [f"rank{i}" for i in range(len(ways))]
    ranks = base.select("id", "d", *[F.col(f"restart{i}").alias(r) for i, r in enumerate(names)])
    for _ in range(rounds):
        told = _told(links, ranks.select("id", *[(F.col(r) / F.col("d")).alias(r) for r in names]))
        given = told.groupBy(F.col("to").alias("id")).agg(*[F.sum(r).alias(r) for r in names])
        now = [((1 - damping) * F.col(f"restart{i}") + damping * F.coalesce(names[i], F.lit(0.0))).alias(names[i]) for i, (damping, _) in enumerate(ways)]
        fresh = settle(base.join(given, "id", "left").select("id", "d", *now), "ranks")
        moved = fresh.join(ranks.select("id", *[F.col(r).alias(f"__{r}") for r in names]), "id").agg(*[F.sum(F.abs(F.col(r) - F.col(f"__{r}"))) for r in names]).first() if tolerance else None
        ranks = fresh
        if moved is not None and all(m is None or m <= tolerance for m in moved):
            break
    return ranks.select("id", *names)


def pagerank(edges: DataFrame, rounds: int = 10, damping: float = 0.85, seeds: DataFrame | None = None, tolerance: float = 0.0) -> DataFrame:
    """(id, rank) over undirected edges, after so many rounds or once ranks move by no more than tolerance in all; with
    seeds (id), restarts go to them alone."""
    with held_links(edges) as links:
        return pageranks(links, [(damping, seeds)], rounds, tolerance).withColumnRenamed("rank0", "rank")


def damped_ranks(links: DataFrame, seeds: DataFrame, dampings: tuple[float, ...], rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """(id, rank0, rank1, ...) over held links: for each damping (below 1) the limit of the rank that restarts at the seeds, to within
    tolerance in all, or what so many rounds give.

    Where v[k] says how likely a walk from the seeds is at a node after k steps, the rank is (1 - a) * sum(a^k * v[k]), so one column goes
    over the links for all dampings. The difference of v[k + 1] and v[k - 1] never grows, so once it is small the rest of the sum
    is that of a cycle of two, with an error of at most a^(k + 2) / (1 - a^2) times the difference."""
    d = settle(links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("d")), "degrees")
    start = settle(d.select("id").join(seeds.select("id"), "id", "left_semi"), "rank-seeds")
    share, sums = 1.0 / max(start.count(), 1), [f"sum{i}" for i in range(len(dampings))]
    first = d.join(start.withColumn("v", F.lit(share)), "id", "left").select("id", "d", F.coalesce("v", F.lit(0.0)).alias("v"), F.lit(0.0).alias("old"), *[F.lit(0.0).alias(c) for c in sums])
    walked, k, moved = settle(first, "walked"), 0, 2.0
    while (rounds is None or k < rounds) and any(a ** (k + 1) / (1 - a * a) * moved > tolerance for a in dampings):
        told = _told(links, walked.where("v > 0").select("id", (F.col("v") / F.col("d")).alias("v")))
        given = told.groupBy(F.col("to").alias("id")).agg(F.sum("v").alias("next"))
        v = F.coalesce("next", F.lit(0.0))
        more = [(F.col(c) + a**k * F.col("v")).alias(c) for c, a in zip(sums, dampings, strict=True)]
        walked = settle(walked.join(given, "id", "left").select("id", "d", v.alias("v"), F.col("v").alias("old"), *more, F.abs(v - F.col("old")).alias("moved")), "walked")
        k += 1
        if k > 1:  # before that there is nothing to compare with; no difference is above 2
            moved = walked.agg(F.sum("moved")).first()[0] or 0.0
    rest = [a**k / (1 - a * a) * (F.col("v") + a * F.col("old")) for a in dampings]
    return walked.select("id", *[((1 - a) * (F.col(c) + r)).alias(f"rank{i}") for i, (a, c, r) in enumerate(zip(dampings, sums, rest, strict=True))])


#: Dampings that a search tries.
DAMPINGS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)


def best_damping(edges: DataFrame, seeds: DataFrame, known: DataFrame, dampings: tuple[float, ...] = DAMPINGS, rounds: int | None = None, tolerance: float = 1e-6) -> DataFrame:
    """(damping, auc, best): how well the personalised rank (damped_ranks) of each damping tells the known ids from the others.
    Ranks count as equal to nine digits of the mean rank, as nodes of the same links differ by the order of their sums alone."""
    from .statistics import auc_by

    with held_links(edges) as links:
        ranks = damped_ranks(links, seeds, dampings, rounds, tolerance)
        cases = settle(ranks.join(known.select("id", F.lit(1).alias("y")).distinct(), "id", "left").withColumn("label", F.coalesce("y", F.lit(0))), "rank-cases")
    n = cases.count()
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("way"), F.round(F.col(f"rank{i}") * n, 9).alias("rank")) for i in range(len(dampings))]))
    aucs = {r["way"]: r["auc"] for r in auc_by(cases.select("label", each.alias("e")).select("label", "e.*"), "way", "label", "rank").collect()}
    found = [(d, aucs.get(i)) for i, d in enumerate(dampings)]
    best = max(found, key=lambda f: (f[1] or 0.0, -f[0]))[0] if found else None
    return edges.sparkSession.createDataFrame([(d, a, d == best) for d, a in found], "damping double, auc double, best boolean")


def eigenvector(edges: DataFrame, rounds: int = 10) -> DataFrame:
    """(id, eigenvector): power iteration of the adjacency matrix plus identity, of unit length after each round."""
    with held_links(edges) as links:
        return eigenvectors(links, rounds)


def eigenvectors(links: DataFrame, rounds: int) -> DataFrame:
    """eigenvector over held links."""
    values = settle(links.select(F.col("src").alias("id")).distinct().withColumn("v", F.lit(1.0)), "eigen")
    for _ in range(rounds):
        near = _told(links, values).groupBy(F.col("to").alias("id")).agg(F.sum("v").alias("got"))
        raw = settle(values.join(near, "id").select("id", (F.col("v") + F.col("got")).alias("v")), "eigen")
        length = raw.agg(F.sqrt(F.sum(F.col("v") * F.col("v")))).first()[0]
        values = raw.withColumn("v", F.col("v") / F.lit(length or 1.0))
    return values.select("id", F.col("v").alias("eigenvector"))


def build(lines: DataFrame, source: str, target: str, day: str, weight: str, kinds: tuple[str, str], least: float = 0.0, since: str | None = None, until: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed nodes (id, kind, links, n, weight, first_day, last_day) and edges (src, dst, n, weight) of the lines within a
    time window, edges of at least a weight."""
    rows = lines.where(F.col(day) >= F.lit(since).cast("date")) if since else lines
    rows = rows.where(F.col(day) < F.lit(until).cast("date")) if until else rows
    rows = rows.select(F.concat(F.lit(kinds[0][0]), source).alias("src"), F.concat(F.lit(kinds[1][0]), target).alias("dst"), F.col(day).alias("day"), F.col(weight).alias("w"))
    edges = rows.groupBy("src", "dst").agg(F.count("*").alias("n"), F.sum("w").alias("weight"), F.min("day").alias("first_day"), F.max("day").alias("last_day")).where(F.col("weight") >= least)
    of = lambda end, kind: edges.groupBy(F.col(end).alias("id")).agg(F.lit(kind).alias("kind"), F.count("*").alias("links"), F.sum("n").alias("n"), F.sum("weight").alias("weight"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    return of("src", kinds[0]).unionByName(of("dst", kinds[1])), edges.select("src", "dst", "n", "weight")


def rings(edges: DataFrame, risk: DataFrame, least_risk: float, sizes: tuple[int, int], known: DataFrame) -> DataFrame:
    """(component, size, links, density, mean_risk, known): components of the nodes of risk (id, risk) at least least_risk,
    of a size within bounds, with how many of the known (id) they hold."""
    high = settle(risk.where(F.col("risk") >= least_risk).select("id", "risk"), "high-risk")
    inner = edges.select("src", "dst").join(high.select(F.col("id").alias("src")), "src", "left_semi").join(high.select(F.col("id").alias("dst")), "dst", "left_semi")
    inner = settle(inner.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).distinct(), "inner")
    labels = components(inner)
    links = inner.join(labels.withColumnRenamed("id", "src"), "src").groupBy("component").agg(F.count("*").alias("links"))
    members = labels.join(high, "id").join(known.select("id", F.lit(1).alias("k")), "id", "left")
    g = members.groupBy("component").agg(F.count("*").alias("size"), F.avg("risk").alias("mean_risk"), F.count("k").alias("known"))
    n = F.col("size")
    return g.where(n.between(*sizes)).join(links, "component").select("component", "size", "links", (2 * F.col("links") / (n * (n - 1))).alias("density"), "mean_risk", "known")


def network_stats(edges: DataFrame) -> DataFrame:
    """One row: nodes, edges, density, components, average clustering, transitivity, degree assortativity."""
    with held_links(edges) as links:
        d = settle(links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("a")), "degrees")
        # sums over nodes give the correlation of the degrees at both ends, so that links needn't carry both
        near = _told(links, d).groupBy(F.col("to").alias("id")).agg(F.sum("a").alias("s"))
        a = F.col("a").cast("double")
        sums = settle(d.join(near, "id").agg(F.sum("a").alias("n"), F.sum(a * a).alias("x"), F.sum(a * a * a).alias("xx"), F.sum(a * F.col("s")).alias("xy")), "degree-sums")
        local = settle(clusterings(links).join(d, "id"), "clustering")
    mean = F.col("x") * F.col("x") / F.col("n")
    spread = F.col("xx") - mean
    flat = sums.select(F.coalesce((F.col("n") / 2).cast("long"), F.lit(0)).alias("edges"), F.when(spread > 0, (F.col("xy") - mean) / spread).alias("assortativity"))
    wedges = F.sum(F.col("a") * (F.col("a") - 1))
    shape = local.agg(F.count("*").alias("nodes"), F.avg("clustering").alias("clustering"), (2 * F.sum("triangles") / wedges).alias("transitivity"))
    parts = components(edges).agg(F.count_distinct("component").alias("components"))
    n = F.col("nodes")
    return shape.crossJoin(flat).crossJoin(parts).select("nodes", "edges", F.when(n > 1, 2 * F.col("edges") / (n * (n - 1))).alias("density"), "components", "clustering", "transitivity", "assortativity")


def spread_risk(edges: DataFrame, seeds: DataFrame, rounds: int, damping: float, fixed: bool = True) -> DataFrame:
    """(id, risk): each round a node takes the damped mean of its neighbours' risk; seeds (id, risk) keep theirs if fixed,
    else keep (1 - damping) of what they had."""
    links = settle(both_ways(edges), "links")
    nodes = links.select(F.col("src").alias("id")).distinct().join(seeds, "id", "left")
    risk = settle(nodes.select("id", F.col("risk").alias("seed"), F.coalesce("risk", F.lit(0.0)).alias("risk")), "risk")
    for _ in range(rounds):
        mean = links.join(risk.select(F.col("id").alias("dst"), "risk"), "dst").groupBy(F.col("src").alias("id")).agg(F.avg("risk").alias("m"))
        now = F.coalesce("seed", damping * F.col("m")) if fixed else (1 - damping) * F.col("risk") + damping * F.col("m")
        risk = settle(risk.join(mean, "id").select("id", "seed", now.alias("risk")), "risk")
    return risk.select("id", "risk")


def decayed_vectors(snapshots: list[DataFrame], decay: float) -> DataFrame:
    """(id, embedding) of (id, embedding) frames, oldest first: the mean of an id's vectors, each step back weighing decay times
    as much; an id that a snapshot lacks has the mean of the others."""
    every = None
    for age, frame in enumerate(reversed(snapshots)):
        part = frame.select("id", "embedding", F.lit(float(decay**age)).alias("w"))
        every = part if every is None else every.unionByName(part)
    seen = every.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("w", "embedding"))).alias("seen"))  # one a snapshot at most
    total = lambda of: F.aggregate("seen", F.lit(0.0), lambda t, s: t + of(s))
    mean = F.transform(F.col("seen")[0]["embedding"], lambda _, i: total(lambda s: s["w"] * F.get(s["embedding"], i)) / total(lambda s: s["w"]))
    return seen.select("id", mean.alias("embedding"))


def iterated_risk(edges: DataFrame, seeds: DataFrame, cut: float, top: int = 100, most: int = 10, rounds: int = 2, damping: float = 0.9) -> tuple[DataFrame, int]:
    """(id, risk) from seeds (id), and the number of iterations: each spreads the seeds' risk to neighbours, runs a ranking that
    restarts at the seeds (scaled to 1 at most) and takes the mean of both. Of the top nodes by that mean (equal ones by id)
    those at cut or above that aren't seeds yet become seeds. It ends when none does, or after most iterations; a node's risk
    is its highest of all iterations."""
    links, seeds = settle(edges.select("src", "dst"), "risk-edges"), settle(seeds.select("id", F.lit(1.0).alias("risk")).distinct(), "seeds")
    risks, done = None, 0
    while done < most:
        near = spread_risk(links, seeds, rounds, damping)
        rank = settle(pagerank(links, rounds + 1, seeds=seeds), "seed-ranks")
        first = rank.agg(F.max("rank").alias("__top"))
        one = near.join(rank, "id").crossJoin(F.broadcast(first)).select("id", ((F.col("risk") + F.coalesce(F.col("rank") / F.nullif("__top", F.lit(0.0)), F.lit(0.0))) / 2).alias("now"))
        risks = settle(one.select("id", "now", F.col("now").alias("risk")) if risks is None else risks.select("id", F.col("risk").alias("__r")).join(one, "id").select("id", "now", F.greatest("__r", "now").alias("risk")), "risks")
        done += 1
        fresh = settle(risks.orderBy(F.desc("now"), "id").limit(top).where(F.col("now") >= cut).select("id", F.lit(1.0).alias("risk")).join(seeds, "id", "left_anti"), "promoted")
        if not fresh.take(1):
            break
        seeds = settle(seeds.unionByName(fresh), "seeds")
    return risks.select("id", "risk"), done


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Of edges (u, v), u the greater: each node's neighbours (the larger ones, or the smaller ones) go to its least
    neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if larger else edges
    near = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    sent = both.join(near, "u").where(F.col("v") > F.col("u")).select("v", "m") if larger else both.join(near, "u").select(F.explode(F.array("u", "v")).alias("v"), "m")
    return sent.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached, by alternating large and small stars until nothing changes."""
    now = settle(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "star")
    mark = None
    while True:
        now = settle(_stars(_stars(now, True), False), "star")
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select("id", F.col("id").alias("component")))


def communities(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """(id, community): synchronous label propagation, the most frequent neighbour label, the smallest of equals."""
    with held_links(edges) as links:
        return labellings(links, rounds)


def labellings(links: DataFrame, rounds: int) -> DataFrame:
    """communities over held links. Labels go once to the node that counts them."""
    labels = settle(links.select(F.col("src").alias("id"), F.col("src").alias("community")).distinct(), "labels")
    for _ in range(rounds):
        votes = _told(links, labels).withColumnRenamed("to", "id").repartition("id").groupBy("id", "community").agg(F.count("*").alias("n"))
        labels = settle(votes.groupBy("id").agg(F.min_by("community", F.struct((-F.col("n")).alias("n"), "community")).alias("community")), "labels")
    return labels


def clustering(edges: DataFrame) -> DataFrame:
    """(id, triangles, clustering): each triangle is found once, from its node of least degree, so that hubs don't pair
    their neighbours."""
    with held_links(edges) as links:
        return settle(clusterings(links), "clustering")


def clusterings(links: DataFrame) -> DataFrame:
    """clustering over held links. A node sends the list of its neighbours of higher degree to each of them, which has at most
    the square root of twice the edges; what both lists hold closes a triangle."""
    d = settle(links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("d")), "degrees")
    ranked = _told(links, d.select("id", F.col("id").alias("v"), F.col("d").alias("e"))).withColumnRenamed("to", "u").join(d.select(F.col("id").alias("u"), "d").hint("shuffle_hash"), "u")
    own = F.struct("e", "v")
    up = settle(ranked.where("d < e OR (d = e AND u < v)").groupBy("u").agg(F.transform(F.array_sort(F.collect_list(own)), lambda x: x["v"]).alias("near")), "oriented")
    # of the list only what comes after v can be in v's own
    asks = up.select("u", F.posexplode("near").alias("at", "v"), "near").select("u", "v", F.expr("slice(near, at + 2, size(near))").alias("rest")).where(F.size("rest") > 0)
    both = asks.join(up.select(F.col("u").alias("v"), "near").hint("shuffle_hash"), "v").select("u", "v", F.array_intersect("rest", "near").alias("w")).where(F.size("w") > 0)
    found = both.select(F.explode(F.concat(F.array(F.struct(F.col("u").alias("id"), F.size("w").alias("t")), F.struct(F.col("v").alias("id"), F.size("w").alias("t"))), F.transform("w", lambda x: F.struct(x.alias("id"), F.lit(1).alias("t"))))).alias("f"))
    triangles = found.groupBy("f.id").agg(F.sum("f.t").alias("t"))
    out = d.join(triangles, "id", "left")
    t = F.coalesce("t", F.lit(0))
    return out.select("id", t.cast("long").alias("triangles"), F.when(F.col("d") > 1, 2 * t / (F.col("d") * (F.col("d") - 1))).otherwise(0.0).alias("clustering"))


def neighbour_degree(edges: DataFrame) -> DataFrame:
    """(id, neighbour_degree): the mean degree of a node's neighbours."""
    links = both_ways(edges)
    d = links.groupBy(F.col("src").alias("dst")).agg(F.count("*").alias("d"))
    return links.join(d, "dst").groupBy(F.col("src").alias("id")).agg(F.avg("d").alias("neighbour_degree"))


def core(edges: DataFrame, k: int) -> DataFrame:
    """(id): nodes of the k-core, by peeling."""
    links = settle(both_ways(edges), "links")
    while True:
        d = links.groupBy("src").agg(F.count("*").alias("n"))
        weak = d.where(F.col("n") < k).select(F.col("src").alias("w"))
        if not weak.take(1):
            break
        left = links.join(weak, F.col("src") == F.col("w"), "left_anti").join(weak, F.col("dst") == F.col("w"), "left_anti")
        links = settle(left, "links")
    return links.select(F.col("src").alias("id")).distinct()


def numbers(ids: DataFrame, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """Distinct ids with all their columns and node, numbers from 0 in the order of the ids, or another one."""
    from .windows import global_rank

    return settle(global_rank(ids, list(order)).select(*ids.columns, (F.col("rank") - 1).cast("int").alias("node")), "nodes")


def numbered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, node) with numbers from 0 in the order of their ids, and the edges between the numbers."""
    nodes = numbers(edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct())
    src, dst = (nodes.select(F.col("id").alias(c), F.col("node").alias(f"__{c}")) for c in ("src", "dst"))
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return nodes, settle(edges.join(src, "src").join(dst, "dst").select(F.col("__src").alias("src"), F.col("__dst").alias("dst"), *rest), "numbered")


#: Neighbours in one row of the choices of a walk.
CHOICES = 1000


def walks(edges: DataFrame, length: int, per_node: int, seed: int = 1, snapshots: int = 1) -> DataFrame:
    """(walk, snapshot, path): uniform walks from each node; the next step is drawn by a hash, so repeats give the same walks. Where
    edges come in over several snapshots, since says from which one on (0, 1, ...) an edge is there, and each snapshot has walks
    of its own. Neighbours are listed once for all of them, and stay where they lie while the walks come to them."""
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    since = "since" if "since" in edges.columns else F.lit(0).alias("since")
    e = edges.where("src <> dst").select("src", "dst", since)
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    links = e.select(F.explode(ways).alias("e"), "since").select("e.*", "since").repartition(parts, "src").groupBy("src", "dst").agg(F.min("since").alias("since"))
    ranked = links.withColumn("k", F.row_number().over(Window.partitionBy("src", "since").orderBy("dst")) - 1)
    lists = ranked.groupBy(F.col("src").alias("at"), "since", F.floor(F.col("k") / CHOICES).cast("int").alias("part")).agg(F.count("*").alias("c"), F.array_sort(F.collect_list("dst")).alias("near"))
    lists = settle(lists, "choices")
    upto = F.array(*[F.sum(F.when(F.col("since") <= i, F.col("c")).otherwise(0)) for i in range(snapshots)])
    d = lists.select("at", "since", "c").repartition(parts, "at").groupBy("at").agg(upto.alias("d")).sortWithinPartitions("at").persist()
    choices = lists.drop("c").repartition(parts, "at", "since", "part").sortWithinPartitions("at", "since", "part").persist()
    try:
        starts = d.select("at", F.posexplode("d").alias("snapshot", "n")).where("n > 0")
        paths = settle(starts.select("at", "snapshot", F.explode(F.sequence(F.lit(1), F.lit(per_node))).alias("i"), F.array("at").alias("path")), "walks")
        for step in range(length - 1):
            drawn = paths.join(d, "at").withColumn("k", F.pmod(F.xxhash64(F.col("path")[0], "i", "snapshot", F.lit(step), F.lit(seed)), F.get("d", F.col("snapshot"))))
            # edges of earlier snapshots come first in the count
            came = F.coalesce(*[F.when(F.col("k") < F.get("d", F.lit(i)), F.lit(i)) for i in range(snapshots)])
            drawn = drawn.withColumn("since", came).withColumn("k", (F.col("k") - F.when(F.col("since") > 0, F.get("d", F.col("since") - 1)).otherwise(0)).cast("int"))
            drawn = drawn.select("at", "since", F.floor(F.col("k") / CHOICES).cast("int").alias("part"), "snapshot", "i", "path", (F.col("k") % CHOICES).alias("k"))
            moved = drawn.join(choices.hint("merge"), ["at", "since", "part"]).select(F.get("near", F.col("k")).alias("at"), "snapshot", "i", "path")
            paths = settle(moved.select("at", "snapshot", "i", F.concat("path", F.array("at")).alias("path")), "walks")
        return paths.select(F.concat_ws("#", F.col("path")[0], "i").alias("walk"), "snapshot", "path")
    finally:
        d.unpersist()
        choices.unpersist()


def skip_grams(paths: DataFrame, window: int = 5) -> DataFrame:
    """(node, context, n): how often two places of a path at most window apart hold the two nodes. Pairs are counted once, without
    their direction."""
    places = paths.select(F.posexplode("path").alias("i", "a"), "path")
    pairs = places.select("a", F.explode(F.slice("path", F.col("i") + 2, window)).alias("b"))
    n = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count("*").alias("n"))
    row = lambda x, y, n: F.struct(F.col(x).alias("node"), F.col(y).alias("context"), n.alias("n"))
    both = F.when(F.col("a") == F.col("b"), F.array(row("a", "b", 2 * F.col("n")))).otherwise(F.array(row("a", "b", F.col("n")), row("b", "a", F.col("n"))))
    return n.select(F.explode(both).alias("g")).select("g.*")


def embeddings(grams: DataFrame, size: int, rounds: int = 5, seed: int = 1) -> DataFrame:
    """(node, embedding) from skip-grams (node, context, n) of numbered nodes: the node factors of their implicit factorisation,
    which is what skip-gram training comes to. Factors stay in blocks on the executors, and nothing goes by way of the driver. A block
    holds a range of the numbers, and a factor goes to the blocks that hold its contexts, so numbers in an order that keeps
    linked nodes close save shuffles; otherwise the numbers only decide where the rounds start from."""
    from pyspark.ml.recommendation import ALS

    grams = settle(grams.select("node", "context", F.col("n").cast("float").alias("n")), "skip-grams")
    n, most = grams.agg(F.count("*"), F.max(F.greatest("node", "context"))).first()
    if not n:
        return grams.select("node", F.array().cast("array<double>").alias("embedding"))
    blocks = 10 + n // 20_000_000
    # the factorisation deals numbers to blocks by their remainder
    first = lambda b: f"({b} * {most + 1}L + {blocks - 1}) div {blocks}"
    block = lambda x: f"({x} * {blocks}L div {most + 1}L)"
    place = lambda x: F.expr(f"int(({x} - {first(block(x))}) * {blocks} + {block(x)})")
    als = ALS(rank=size, maxIter=rounds, implicitPrefs=True, seed=seed, userCol="node", itemCol="context", ratingCol="n", numUserBlocks=blocks, numItemBlocks=blocks)
    factors = als.fit(grams.select(place("node").alias("node"), place("context").alias("context"), "n")).userFactors
    node = F.expr(f"int(id div {blocks} + {first(f'(id % {blocks})')})")
    return settle(factors.select(node.alias("node"), F.col("features").cast("array<double>").alias("embedding")), "embeddings")
