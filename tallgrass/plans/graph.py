"""Queries of graph features, on whole edge tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.operators import graph as g
from tallgrass.operators.aggregates import share_of
from tallgrass.operators.windows import rounded
from tallgrass.sources.scratch import settle
from tallgrass.sources.tables import EDGES, TRAILS, edges, table, trails

from .registry import query
from .windows import r

LINKS = f"{EDGES}, l AS (SELECT src, dst, weight FROM edges UNION ALL SELECT dst, src, weight FROM edges)"
PARTS = f"{TRAILS}, l AS (SELECT src AS x, dst AS y FROM trails UNION SELECT dst, src FROM trails), d AS (SELECT x, count(*) AS d FROM l GROUP BY 1)"
TRI = f"{PARTS}, o AS (SELECT l.x, l.y FROM l JOIN d a ON a.x = l.x JOIN d b ON b.x = l.y WHERE a.d < b.d OR a.d = b.d AND l.x < l.y), w AS (SELECT p.x AS a, p.y AS b, q.y AS c FROM o p JOIN o q ON p.x = q.x AND p.y < q.y JOIN l z ON z.x = p.y AND z.y = q.y), t AS (SELECT x, count(*) AS t FROM (SELECT unnest([a, b, c]) AS x FROM w) GROUP BY 1)"


@query("R1_build_graph", f"WITH e AS (SELECT 'c' || o_custkey AS src, 's' || l_suppkey AS dst, count(*) AS n, sum(l_extendedprice) AS weight, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1, 2 HAVING sum(l_extendedprice) >= 20000) SELECT src AS id, 'customer' AS kind, count(*) AS links, CAST(sum(n) AS BIGINT) AS n, {r('sum(weight)', 'weight', 2)}, min(a) AS first_day, max(b) AS last_day FROM e GROUP BY 1 UNION ALL SELECT dst, 'supplier', count(*), CAST(sum(n) AS BIGINT), {r('sum(weight)', 'weight', 2)}, min(a), max(b) FROM e GROUP BY 1")
def r1(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).withColumn("day", F.to_date("o_orderdate"))
    nodes, _ = g.build(lines, "o_custkey", "l_suppkey", "day", "l_extendedprice", ("customer", "supplier"), 20_000, "1996-01-01", "1998-01-01")
    return rounded(nodes, ["id", "kind", "links", "n", "first_day", "last_day"], ["weight"], 2)


@query("R2_update_graph", f"WITH {EDGES} SELECT src, dst, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM edges UNION ALL SELECT * FROM edges WHERE weight > 100000) GROUP BY 1, 2")
def r2(spark, sf_dir):
    e = edges(spark, sf_dir)
    return g.merged(e, e.where("weight > 100000")).select("src", "dst", "n")


@query("R3_node_features", f"WITH {LINKS} SELECT src AS id, count(*) AS degree, {r('sum(weight)', 'weighted_degree', 2)} FROM l GROUP BY 1")
def r3(spark, sf_dir):
    return rounded(g.degrees(edges(spark, sf_dir), "weight"), ["id", "degree"], ["weighted_degree"], 2)


@query("R4_payment_network", f"WITH {EDGES} SELECT dst, count(*) AS payers, {r('count(*) / (SELECT count(DISTINCT src) FROM edges)', 'centrality')}, count(*) >= 300 AS hub FROM edges GROUP BY 1")
def r4(spark, sf_dir):
    e = edges(spark, sf_dir)
    n = e.agg(F.count_distinct("src").alias("all"))
    out = e.groupBy("dst").agg(F.count("*").alias("payers")).crossJoin(F.broadcast(n))
    return rounded(out.select("dst", "payers", (F.col("payers") / F.col("all")).alias("centrality"), (F.col("payers") >= 300).alias("hub")), ["dst", "payers", "hub"], ["centrality"])


SEEDS = [("c1",), ("c2",), ("s3",)]


def rank_sql(rounds: int, p: str, start: str, links: str = "l", src: str = "src", dst: str = "dst") -> str:
    steps = f"{p}b AS (SELECT {src} AS id, count(*) AS d, {start} AS s FROM {links} GROUP BY 1), {p}0 AS (SELECT id, s AS rank FROM {p}b)"
    for i in range(1, rounds + 1):
        steps += f", {p}{i} AS (SELECT b.id, 0.15e0 * b.s + 0.85e0 * coalesce(sum(q.rank / c.d), 0) AS rank FROM {p}b b LEFT JOIN {links} l ON l.{dst} = b.id LEFT JOIN {p}{i - 1} q ON q.id = l.{src} LEFT JOIN {p}b c ON c.id = l.{src} GROUP BY b.id, b.s)"
    return steps


ONE_OF = "CASE WHEN src IN ('c1', 'c2', 's3') THEN 1e0 / 3 ELSE 0 END"


@query("R5_pagerank_risk", f"WITH {LINKS}, {rank_sql(4, 'p', '1e0 / count(*) OVER ()')}, {rank_sql(4, 'q', ONE_OF)} SELECT id, {r('p4.rank * 1000', 'rank')}, {r('q4.rank * 1000', 'risk')} FROM p4 JOIN q4 USING (id)")
def r5(spark, sf_dir):
    """Four rounds each, so that SQL can state them; tests hold the tolerance."""
    with g.held_links(edges(spark, sf_dir)) as links:
        found = g.pageranks(links, [(0.85, None), (0.85, spark.createDataFrame(SEEDS, "id string"))], 4)
    return rounded(found.select("id", (F.col("rank0") * 1000).alias("rank"), (F.col("rank1") * 1000).alias("risk")), ["id"], ["rank", "risk"])


@query("R5b_damping_search")
def r5b(spark, sf_dir):
    known = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.concat(F.lit("c"), "c_custkey").alias("id"))
    seeds = known.where(F.pmod(F.xxhash64("id"), F.lit(2)) == 0)
    return g.best_damping(edges(spark, sf_dir), seeds, known)


R6 = f"""WITH {LINKS}, v AS (SELECT DISTINCT src AS id, CASE WHEN src IN ('c1', 'c2', 's3') THEN 1e0 END AS seed FROM l), q0 AS (SELECT id, seed, coalesce(seed, 0) AS risk FROM v),
q1 AS (SELECT q0.id, q0.seed, coalesce(q0.seed, 0.9e0 * avg(p.risk)) AS risk FROM q0 JOIN l ON l.src = q0.id JOIN q0 p ON p.id = l.dst GROUP BY q0.id, q0.seed),
q2 AS (SELECT q1.id, q1.seed, coalesce(q1.seed, 0.9e0 * avg(p.risk)) AS risk FROM q1 JOIN l ON l.src = q1.id JOIN q1 p ON p.id = l.dst GROUP BY q1.id, q1.seed) SELECT id, {r('risk', 'risk', 5)} FROM q2"""


@query("R6_label_risk", R6)
def r6(spark, sf_dir):
    seeds = spark.createDataFrame([(i, 1.0) for (i,) in SEEDS], "id string, risk double")
    return rounded(g.spread_risk(edges(spark, sf_dir), seeds, 2, 0.9), ["id"], ["risk"], 5)


R7 = f"""WITH {LINKS}, d AS (SELECT src AS id, count(*) / 100e0 AS risk FROM l GROUP BY 1), q1 AS (SELECT d.id, 0.5e0 * d.risk + 0.5e0 * avg(p.risk) AS risk FROM d JOIN l ON l.src = d.id JOIN d p ON p.id = l.dst GROUP BY d.id, d.risk)
SELECT id, {r('q1.risk', 'risk', 5)}, {r('q1.risk - d.risk', 'change', 5)} FROM q1 JOIN d USING (id)"""


@query("R7_risk_features", R7)
def r7(spark, sf_dir):
    e = edges(spark, sf_dir)
    seeds = g.degrees(e).select("id", (F.col("degree") / 100.0).alias("risk"))
    found = g.spread_risk(e, seeds, 1, 0.5, fixed=False).join(seeds.withColumnRenamed("risk", "before"), "id")
    return rounded(found.withColumn("change", F.col("risk") - F.col("before")), ["id"], ["risk", "change"], 5)


@query("R8_iterative_risk")
def r8(spark, sf_dir):
    """Seeds are customers with a very large edge; nodes become seeds while their risk is high."""
    e = edges(spark, sf_dir)
    seeds = e.where("weight > 200000").select(F.col("src").alias("id"), F.lit(1.0).alias("risk")).distinct()
    return g.iterated_risk(e, seeds, 0.6, most=6)[0]


#: Nodes are parts; a part's risk is the share of its lines that came back, known are parts that are large and dear.
R9 = f"""WITH RECURSIVE {TRAILS}, k AS (SELECT l_partkey AS id, avg(CAST(l_returnflag = 'R' AS INT)) AS risk FROM lineitem GROUP BY 1), h AS (SELECT id, risk FROM k WHERE risk >= 0.5e0),
i AS (SELECT src, dst FROM trails WHERE src IN (SELECT id FROM h) AND dst IN (SELECT id FROM h)), l AS (SELECT src, dst FROM i UNION SELECT dst, src FROM i),
p AS (SELECT src AS id, src AS reach FROM l UNION SELECT p.id, l.dst FROM p JOIN l ON p.reach = l.src), c AS (SELECT id, min(reach) AS component FROM p GROUP BY 1), e AS (SELECT component, count(*) AS links FROM i JOIN c ON c.id = i.src GROUP BY 1)
SELECT component, count(*) AS size, max(links) AS links, {r('2 * max(links) / (count(*) * (count(*) - 1))', 'density')}, {r('avg(risk)', 'mean_risk')}, count(*) FILTER (p_size > 25 AND p_retailprice > 1400) AS known
FROM c JOIN h USING (id) JOIN e USING (component) LEFT JOIN part ON p_partkey = id GROUP BY 1 HAVING count(*) BETWEEN 2 AND 5000"""


@query("R9_rings", R9)
def r9(spark, sf_dir):
    risk = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("id")).agg(share_of(F.col("l_returnflag") == "R").alias("risk"))
    known = table(spark, sf_dir, "part").where("p_size > 25 AND p_retailprice > 1400").select(F.col("p_partkey").alias("id"))
    return rounded(g.rings(trails(spark, sf_dir), risk, 0.5, (2, 5000), known), ["component", "size", "links", "known"], ["density", "mean_risk"])


def vote_sql(rounds: int, src: str = "src", dst: str = "dst") -> str:
    steps = f"c0 AS (SELECT DISTINCT {src} AS id, {src} AS community FROM l)"
    for i in range(1, rounds + 1):
        steps += f", v{i} AS (SELECT l.{src} AS id, community, count(*) AS n FROM l JOIN c{i - 1} ON c{i - 1}.id = l.{dst} GROUP BY 1, 2), c{i} AS (SELECT id, community FROM v{i} QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, community) = 1)"
    return steps


@query("R10_communities", f"WITH {LINKS}, {vote_sql(3)} SELECT id, community FROM c3")
def r10(spark, sf_dir):
    return g.communities(edges(spark, sf_dir), 3)


@query("R11_structure", f"WITH {TRI}, n AS (SELECT l.x, avg(b.d) AS a FROM l JOIN d b ON b.x = l.y GROUP BY 1) SELECT d.x AS id, coalesce(t, 0) AS triangles, {r('CASE WHEN d > 1 THEN 2 * coalesce(t, 0) / (d * (d - 1)) ELSE 0 END', 'clustering')}, {r('a', 'neighbour_degree')} FROM d JOIN n USING (x) LEFT JOIN t USING (x)")
def r11(spark, sf_dir):
    whole = trails(spark, sf_dir)
    return rounded(g.clustering(whole).join(g.neighbour_degree(whole), "id"), ["id", "triangles"], ["clustering", "neighbour_degree"])


def peel_sql(k: int, rounds: int) -> str:
    steps = "k0 AS (SELECT x, y FROM l)"
    for i in range(1, rounds + 1):
        steps += f", w{i} AS (SELECT x FROM k{i - 1} GROUP BY 1 HAVING count(*) < {k}), k{i} AS (SELECT x, y FROM k{i - 1} WHERE x NOT IN (SELECT x FROM w{i}) AND y NOT IN (SELECT x FROM w{i}))"
    return steps


@query("R11b_core", f"WITH {PARTS}, {peel_sql(30, 60)} SELECT DISTINCT x AS id FROM k60")
def r11b(spark, sf_dir):
    """Peeling goes on until nothing is weak; the SQL's sixty rounds are more than these tables need."""
    return g.core(trails(spark, sf_dir), 30)


def power_sql(rounds: int) -> str:
    steps = "e0 AS (SELECT x, 1e0 AS v FROM d)"
    for i in range(1, rounds + 1):
        steps += f", f{i} AS (SELECT l.x, max(a.v) + sum(b.v) AS v FROM l JOIN e{i - 1} a ON a.x = l.x JOIN e{i - 1} b ON b.x = l.y GROUP BY 1), e{i} AS (SELECT x, v / sqrt(sum(v * v) OVER ()) AS v FROM f{i})"
    return steps


@query("R12_centrality", f"WITH {PARTS}, {power_sql(4)}, {rank_sql(4, 'p', '1e0 / count(*) OVER ()', 'l', 'x', 'y')} SELECT d.x AS id, d AS degree, {r('d / (count(*) OVER () - 1)', 'centrality', 6)}, {r('rank * 1000', 'rank')}, {r('v * 1000', 'eigenvector')} FROM d JOIN e4 USING (x) JOIN p4 ON p4.id = d.x")
def r12(spark, sf_dir):
    with g.held_links(trails(spark, sf_dir)) as links:
        d = settle(links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree")), "degrees")
        ranks, central = g.pageranks(links, [(0.85, None)], 4).withColumnRenamed("rank0", "rank"), g.eigenvectors(links, 4)
    n = d.agg((F.count("*") - 1).alias("m"))
    found = d.crossJoin(F.broadcast(n)).join(ranks, "id").join(central, "id")
    found = found.select("id", "degree", F.round(F.col("degree") / F.col("m") + 1.3e-7, 6).alias("centrality"), (F.col("rank") * 1000).alias("rank"), (F.col("eigenvector") * 1000).alias("eigenvector"))
    return found.select("id", "degree", "centrality", *[F.round(F.col(c) + 1.3e-7, 4).alias(c) for c in ("rank", "eigenvector")])


def least_sql(rounds: int) -> str:
    steps = "m0 AS (SELECT x, x AS c FROM d)"
    for i in range(1, rounds + 1):
        steps += f", m{i} AS (SELECT l.x, least(min(a.c), min(b.c)) AS c FROM l JOIN m{i - 1} a ON a.x = l.x JOIN m{i - 1} b ON b.x = l.y GROUP BY 1)"
    return steps


R13 = f"""WITH {TRI}, {least_sql(12)}, s AS (SELECT count(*) AS nodes, avg(CASE WHEN d > 1 THEN 2 * coalesce(t, 0) / (d * (d - 1)) ELSE 0 END) AS clustering, 2 * sum(coalesce(t, 0)) / sum(d * (d - 1)) AS transitivity FROM d LEFT JOIN t USING (x)),
a AS (SELECT count(*) // 2 AS edges, corr(a.d, b.d) AS assortativity FROM l JOIN d a ON a.x = l.x JOIN d b ON b.x = l.y)
SELECT nodes, edges, {r('2 * edges / (nodes * (nodes - 1))', 'density', 6)}, (SELECT count(DISTINCT c) FROM m12) AS components, {r('clustering', 'clustering', 6)}, {r('transitivity', 'transitivity', 6)}, {r('assortativity', 'assortativity', 5)} FROM s, a"""


@query("R13_network_stats", R13)
def r13(spark, sf_dir):
    found = rounded(g.network_stats(trails(spark, sf_dir)), ["nodes", "edges", "components", "assortativity"], ["density", "clustering", "transitivity"], 6)
    return found.withColumn("assortativity", F.round(F.col("assortativity") + 1.3e-7, 5))


@query("R14_graph_features", f"WITH {TRI}, {rank_sql(3, 'p', '1e0 / count(*) OVER ()', 'l', 'x', 'y')}, {vote_sql(2, 'x', 'y')} SELECT l_orderkey, l_linenumber, coalesce(d, 0) AS degree, {r('coalesce(rank, 0) * 1000', 'rank')}, {r('CASE WHEN d > 1 THEN 2 * coalesce(t, 0) / (d * (d - 1)) ELSE 0 END', 'clustering')}, community FROM lineitem LEFT JOIN d ON d.x = l_partkey LEFT JOIN t ON t.x = l_partkey LEFT JOIN p3 ON p3.id = l_partkey LEFT JOIN c2 ON c2.id = l_partkey")
def r14(spark, sf_dir):
    with g.held_links(trails(spark, sf_dir)) as links:
        degrees = links.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))
        ranks = g.pageranks(links, [(0.85, None)], 3).withColumnRenamed("rank0", "rank")
        nodes = settle(degrees.join(ranks, "id").join(g.clusterings(links), "id").join(g.labellings(links, 2), "id"), "graph-features")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("id")).join(nodes, "id", "left")
    found = lines.select("l_orderkey", "l_linenumber", F.coalesce("degree", F.lit(0)).alias("degree"), (F.coalesce("rank", F.lit(0.0)) * 1000).alias("rank"), F.coalesce("clustering", F.lit(0.0)).alias("clustering"), "community")
    return rounded(found, ["l_orderkey", "l_linenumber", "degree", "community"], ["rank", "clustering"])


@query("R15_walk_embeddings")
def r15(spark, sf_dir):
    """Walks over the edges of the small payments and over all edges: the later snapshot weighs 1, the earlier one half. Customers
    and suppliers are numbered before their orders and lines meet, both in the order of their keys, so that edges are numbers from the
    start and numbers of the same time lie close."""
    orders, lines = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    ends = [df.select(F.col(key).alias("key")).distinct().select(F.concat(F.lit(kind), "key").alias("id"), F.lit(kind).alias("kind"), "key") for df, key, kind in ((orders, "o_custkey", "c"), (lines, "l_suppkey", "s"))]
    keys = settle(ends[0].unionByName(ends[1]).where("key IS NOT NULL"), "keys")
    last = keys.groupBy("kind").agg(F.max("key").alias("last"))
    nodes = g.numbers(keys.join(F.broadcast(last), "kind").withColumn("at", F.col("key") / F.greatest("last", F.lit(1))), ("at", "id"))
    customers, suppliers = (nodes.where(F.col("kind") == kind).select("key", F.col("node").alias(end)) for kind, end in (("c", "src"), ("s", "dst")))
    payers = orders.join(customers, F.col("o_custkey") == F.col("key")).select("o_orderkey", "src")
    paid = lines.join(suppliers, F.col("l_suppkey") == F.col("key")).select("l_orderkey", "dst")
    whole = paid.join(payers, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("src", "dst").agg(F.count("*").alias("n"))
    paths = g.walks(whole.select("src", "dst", F.when(F.col("n") == 1, 0).otherwise(1).alias("since")), 6, 2, snapshots=2)
    snapshots = [g.embeddings(g.skip_grams(paths.where(F.col("snapshot") == i)), 8).withColumnRenamed("node", "id") for i in (0, 1)]
    return g.decayed_vectors(snapshots, 0.5).withColumnRenamed("id", "node").join(nodes, "node").select("id", "embedding")
