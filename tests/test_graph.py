"""Graph operators against plain loops, and queries without SQL on all edges."""

from collections import defaultdict

import numpy as np

from tallgrass.operators import graph, joins
from tallgrass.plans import registry
from tallgrass.sources.tables import edges, table

SF = "/root/testdata/sf0.001"


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "src long, dst long")


def test_long_path_has_one_component_and_no_core(spark):
    path = frame(spark, [(k, k + 1) for k in range(150)] + [(200, 201), (201, 202), (202, 200), (7, 7)])
    assert {r.id: r.component for r in graph.components(path).collect()} == {**dict.fromkeys(range(151), 0), 200: 200, 201: 200, 202: 200}
    assert {r.id for r in graph.core(path, 2).collect()} == {200, 201, 202}
    assert graph.components(path.limit(0)).collect() == []


def test_ranks_settle(spark):
    rng = np.random.default_rng(1)
    pairs = list({(int(a), int(b)) for a, b in rng.integers(0, 30, (90, 2)) if a < b})
    found = {r.id: r.rank for r in graph.pagerank(frame(spark, pairs), 100, tolerance=1e-6).collect()}
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    rank = dict.fromkeys(near, 1 / len(near))
    for _ in range(200):
        rank = {n: 0.15 / len(near) + 0.85 * sum(rank[m] / len(near[m]) for m in near[n]) for n in near}
    assert all(abs(found[n] - rank[n]) < 1e-5 for n in near)
    matrix = np.array([[float(b in near[a]) for b in sorted(near)] for a in sorted(near)])
    vector = np.abs(np.linalg.eigh(matrix)[1][:, -1])
    central = {r.id: r.eigenvector for r in graph.eigenvector(frame(spark, pairs), 60).collect()}
    assert np.allclose([central[n] for n in sorted(near)], vector, atol=1e-3)


def test_rings(spark):
    pairs = frame(spark, [(1, 2), (2, 3), (3, 1), (3, 4), (10, 11), (20, 21)])
    risk = spark.createDataFrame([(i, 0.9) for i in (1, 2, 3, 10, 11)] + [(4, 0.1), (20, 0.8), (21, 0.2)], "id long, risk double")
    found = graph.rings(pairs, risk, 0.5, (3, 10), spark.createDataFrame([(2,), (4,)], "id long")).collect()
    assert [(r.component, r.size, r.links, r.density, round(r.mean_risk, 6), r.known) for r in found] == [(1, 3, 3, 1.0, 0.9, 1)]


def test_damping_search(spark):
    e = frame(spark, [(1, 2), (2, 3), (3, 4), (4, 5), (1, 3), (5, 6)])
    found = graph.best_damping(e, spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([(1,), (2,), (3,)], "id long"), (0.5, 0.85), 5).collect()
    assert [r.auc for r in found if r.best][0] == max(r.auc for r in found) > 0.9


def limits(pairs, seeds, dampings):
    """Ids and, for each damping, the ranks that restart at the seeds, by solving for them."""
    ids = sorted({x for p in pairs for x in p})
    matrix = np.zeros((len(ids), len(ids)))
    for a, b in pairs:
        if a != b:
            matrix[ids.index(a), ids.index(b)] = matrix[ids.index(b), ids.index(a)] = 1
    start = np.array([i in seeds for i in ids]) / sum(i in seeds for i in ids)
    return ids, [np.linalg.solve(np.eye(len(ids)) - a * matrix / matrix.sum(0), (1 - a) * start) for a in dampings]


def test_damped_ranks_are_limits(spark):
    """Links of two kinds of nodes, in two parts; a ring of odd length; repeats and a loop."""
    rng = np.random.default_rng(4)
    two = [(int(a), 100 + int(b)) for a, b in rng.integers(0, 8, (50, 2))] + [(50, 150), (51, 150), (50, 151)]
    ring = [(k, (k + 1) % 5) for k in range(5)] + [(3, 3), (1, 0)]
    for pairs, seeds in ((two, {0, 1, 50}), (ring, {2})):
        ids, expected = limits(pairs, seeds, (0.3, 0.85))
        with graph.held_links(frame(spark, pairs)) as links:
            found = {r.id: (r.rank0, r.rank1) for r in graph.damped_ranks(links, spark.createDataFrame([(i,) for i in seeds], "id long"), (0.3, 0.85)).collect()}
        assert sorted(found) == ids
        assert all(sum(abs(found[x][i] - e) for x, e in zip(ids, expected[i], strict=True)) < 1e-6 for i in (0, 1))


def test_damping_query_tries_all_dampings_to_the_limit(spark):
    dampings = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]
    pairs = [(r.src, r.dst) for r in edges(spark, SF).select("src", "dst").collect()]
    known = {f"c{r.c_custkey}" for r in table(spark, SF, "customer").where("c_acctbal < 0").collect()}
    seeds = {r.id for r in spark.createDataFrame([(i,) for i in known], "id string").where("pmod(xxhash64(id), 2) = 0").collect()}
    ids, ranks = limits(pairs, seeds, dampings)
    ranks = [np.round(r * len(ids), 9) for r in ranks]  # many are equal here
    found = {r.damping: (r.auc, r.best) for r in registry.queries()["R5b_damping_search"](spark, SF).collect()}
    assert sorted(found) == dampings
    for a, rank in zip(dampings, ranks, strict=True):
        yes, no = (np.array([x for i, x in zip(ids, rank, strict=True) if (i in known) == k]) for k in (True, False))
        auc = np.mean((yes[:, None] > no) + (yes[:, None] == no) / 2)
        assert abs(found[a][0] - auc) < 1e-3
    assert [a for a in found if found[a][1]] == [max(found, key=lambda a: (found[a][0], -a))]


def test_peers_against_brute_force(spark):
    """A neighbour that all share, and nodes with all sorts of overlaps."""
    rng = np.random.default_rng(3)
    near = {f"n{k}": {"hub", *[f"d{x}" for x in rng.integers(0, 14, rng.integers(1, 12))]} for k in range(60)}
    rows = spark.createDataFrame([(n, d) for n, s in near.items() for d in s], "src string, dst string")
    for least in (0.3, 0.6, 1.0):
        expected = {}
        for n in near:
            scored = sorted((-len(near[n] & near[m]) / len(near[n] | near[m]), m) for m in near if m != n)
            expected[n] = [m for s, m in scored if -s >= least][:4]
        found = defaultdict(list)
        for r in joins.peers(rows, least, 4).orderBy("src", "rank").collect():
            found[r.src].append(r.peer)
        assert found == {n: m for n, m in expected.items() if m}


def test_walks_reach_every_node(spark):
    nodes = {x for r in edges(spark, SF).select("src", "dst").collect() for x in r}
    assert {r.id for r in registry.queries()["R15_walk_embeddings"](spark, SF).collect()} == nodes


def test_iterated_risk_promotes(spark):
    """Against plain dictionaries: spread, restart rank, their mean, promotion of the best two, highest of all iterations."""
    pairs = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("a", "c"), ("x", "y")]
    near = {}
    for u, v in pairs:
        near.setdefault(u, set()).add(v)
        near.setdefault(v, set()).add(u)
    seeds, best, done = {"a"}, dict.fromkeys(near, 0.0), 0
    while done < 10:
        risk = {n: float(n in seeds) for n in near}
        for _ in range(2):
            risk = {n: 1.0 if n in seeds else 0.9 * sum(risk[m] for m in near[n]) / len(near[n]) for n in near}
        start = {n: (n in seeds) / len(seeds) for n in near}
        rank = dict(start)
        for _ in range(3):
            rank = {n: 0.15 * start[n] + 0.85 * sum(rank[m] / len(near[m]) for m in near[n]) for n in near}
        now = {n: (risk[n] + rank[n] / max(rank.values())) / 2 for n in near}
        best, done = {n: max(best[n], now[n]) for n in near}, done + 1
        fresh = {n for n in sorted(near, key=lambda n: (-now[n], n))[:2] if now[n] >= 0.55} - seeds
        if not fresh:
            break
        seeds |= fresh
    edges = spark.createDataFrame(pairs, "src string, dst string")
    found, rounds = graph.iterated_risk(edges, spark.createDataFrame([("a",)], "id string"), 0.55, top=2)
    got = {r.id: r.risk for r in found.collect()}
    assert rounds == done > 1 and got.keys() == near.keys() and all(abs(got[n] - best[n]) < 1e-9 for n in near)


def test_decayed_vectors(spark):
    old, new = (spark.createDataFrame(rows, "id string, embedding array<double>") for rows in ([("a", [0.0, 3.0]), ("b", [1.0, 1.0])], [("a", [3.0, 0.0]), ("c", [2.0, 2.0])]))
    found = {r.id: r.embedding for r in graph.decayed_vectors([old, new], 0.5).collect()}
    assert found == {"a": [2.0, 1.0], "b": [1.0, 1.0], "c": [2.0, 2.0]}


def test_rounds_leave_the_links_where_they_are(spark):
    """Only the nodes are shuffled to the links; several ranks of one pass are those of single passes."""
    rng = np.random.default_rng(5)
    e = frame(spark, [(int(a), int(b)) for a, b in rng.integers(0, 40, (150, 2))])
    seeds = spark.createDataFrame([(1,), (2,)], "id long")
    with graph.held_links(e) as links:
        told = graph._told(links, graph.settle(links.groupBy(links.src.alias("id")).count(), "nodes"))
        assert told._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0].count("Exchange") == 0
        both = {r.id: (r.rank0, r.rank1) for r in graph.pageranks(links, [(0.85, None), (0.5, seeds)], 3).collect()}
    one, two = ({r.id: r.rank for r in graph.pagerank(e, 3, d, s).collect()} for d, s in ((0.85, None), (0.5, seeds)))
    assert both.keys() == one.keys() and all(abs(a - one[n]) < 1e-12 and abs(b - two[n]) < 1e-12 for n, (a, b) in both.items())


def test_triangles_and_degree_correlation(spark):
    rng = np.random.default_rng(7)
    pairs = {(min(a, b), max(a, b)) for a, b in rng.integers(0, 30, (200, 2)).tolist() if a != b}
    near = defaultdict(set)
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    expected = {n: sum(len(near[n] & near[m]) for m in near[n]) // 2 for n in near}
    assert {r.id: r.triangles for r in graph.clustering(frame(spark, list(pairs))).collect()} == expected
    ends = np.array([(len(near[a]), len(near[b])) for a in near for b in near[a]], float)
    assert abs(graph.network_stats(frame(spark, list(pairs))).first()["assortativity"] - np.corrcoef(ends.T)[0, 1]) < 1e-9
    assert graph.network_stats(frame(spark, [(1, 2), (2, 3), (3, 1)])).first()["assortativity"] is None


def test_skip_grams_of_a_path(spark):
    paths = spark.createDataFrame([([1, 2, 3, 1],), ([4],)], "path array<int>")
    found = {(r.node, r.context): r.n for r in graph.skip_grams(paths, 2).collect()}
    assert found == {(1, 2): 2, (2, 1): 2, (1, 3): 2, (3, 1): 2, (2, 3): 1, (3, 2): 1}


def test_embeddings_tell_groups_apart_without_the_driver(spark, monkeypatch):
    """Two dense groups with one link between them; no vocabulary is trained in the driver."""
    from pyspark.ml import feature

    monkeypatch.setattr(feature, "Word2Vec", None)
    rng = np.random.default_rng(2)
    pairs = {(f"{g}{a}", f"{g}{b}") for g in "xy" for a, b in rng.integers(0, 12, (60, 2)).tolist() if a != b} | {("x0", "y0")}
    nodes, whole = graph.numbered(spark.createDataFrame(sorted(pairs), "src string, dst string"))
    vectors = graph.embeddings(graph.skip_grams(graph.walks(whole, 6, 8)), 4).join(nodes, "node")
    found = {r.id: np.array(r.embedding) / np.linalg.norm(r.embedding) for r in vectors.collect()}
    assert found.keys() == {x for p in pairs for x in p}
    same = np.mean([found[a] @ found[b] for a in found for b in found if a < b and a[0] == b[0]])
    other = np.mean([found[a] @ found[b] for a in found for b in found if a[0] < b[0]])
    assert same > other + 0.3
    assert {len(r.embedding) for r in registry.queries()["R15_walk_embeddings"](spark, SF).take(3)} == {8}


def test_walks_follow_links_of_a_hub(spark):
    """More neighbours than one row of choices holds."""
    links = {(0, k) for k in range(1, 2501)}
    steps = {(a, b) for r in graph.walks(frame(spark, sorted(links)), 3, 1).collect() for a, b in zip(r.path[:-1], r.path[1:], strict=True)}
    assert all(((a, b) in links) or ((b, a) in links) for a, b in steps)
    assert len({b for a, b in steps if a == 0 and b > 2000}) > 100 and len({b for a, b in steps if a == 0 and b <= 1000}) > 100


def test_walks_of_snapshots_share_the_lists_of_neighbours(spark, monkeypatch):
    """Each snapshot walks its own links, also where a link is listed twice; only the walks are shuffled to the lists."""
    rng = np.random.default_rng(6)
    old = {(int(a), int(b)) for a, b in rng.integers(0, 15, (30, 2)) if a < b}
    new = {(int(a), int(b)) for a, b in rng.integers(0, 25, (60, 2)) if a < b}
    rows = [(a, b, 0) for a, b in old] + [(b, a, 1) for a, b in old | new] + [(0, 0, 0)]
    plans, settle = [], graph.settle
    monkeypatch.setattr(graph, "settle", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or settle(df, name))
    found = graph.walks(spark.createDataFrame(rows, "src long, dst long, since int"), 5, 200, snapshots=2).collect()
    for snapshot, links in ((0, old), (1, old | new)):
        both = links | {(b, a) for a, b in links}
        paths = [r.path for r in found if r.snapshot == snapshot]
        steps = [p for path in paths for p in zip(path[:-1], path[1:], strict=True)]
        assert {p[0] for p in paths} == {a for a, _ in both} and len(paths) == 200 * len({a for a, _ in both}) and set(steps) == both
        first = defaultdict(list)
        for p in paths:
            first[p[0]].append(p[1])
        assert all(abs(b.count(x) - 200 / len(set(b))) < 6 * (200 / len(set(b))) ** 0.5 for b in first.values() for x in set(b))
    steps = [plan for name, plan in plans if name == "walks"][2:]  # after the first step, which fills the lists
    assert len(steps) == 3
    assert all(len([x for x in p.splitlines() if "hashpartitioning(at" in x and "since" in x and "ENSURE_REQUIREMENTS" in x]) == 1 for p in steps)


def test_embeddings_keep_their_numbers(spark):
    """Ranges of the numbers go to blocks and come back, with gaps and with more blocks than numbers."""
    for ids in ([0, 1, 2], [3, 40, 41, 997], list(range(0, 300, 3))):
        grams = spark.createDataFrame([(a, b, 1 + (a + b) % 3) for a in ids for b in ids[:4] if a != b] + [(b, a, 1) for a in ids[4:] for b in ids[:4]], "node int, context int, n long")
        assert {r.node for r in graph.embeddings(grams, 2, 1).collect()} == set(ids)
    assert graph.embeddings(grams.limit(0), 2).collect() == []
