"""Rewrites and approximations against plain definitions on small data."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.functions.text import normalise_name
from presslens.operators import aggregates, attribution, bins, bootstrap, components, fuzzy, joins
from presslens.operators import quantiles, ranking, stats, vectors

WORDS = ["acme", "data", "tech", "corp", "sys", "group", "ab", "a"]


def random_names(seed, n):
    draw = random.Random(seed)
    names = {" ".join(draw.choices(WORDS, k=draw.randint(1, 4))) for _ in range(n)}
    edited = set()
    for name in names:
        letters = list(name)
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(letters) + 1)
            if draw.random() < 0.5:
                letters.insert(at, draw.choice("abcde "))
            elif at < len(letters):
                del letters[at]
        edited.add("".join(letters).strip())
    return sorted(x for x in names | edited if x)


def test_prefix_join_equals_startswith(spark):
    names = random_names(1, 80)
    mentions = sorted({" ".join(n.split(" ")[:k]) for n in names for k in (1, 2)})
    left = spark.createDataFrame([(m,) for m in mentions], "mention string")
    right = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.mention, r.name) for r in joins.join_name_prefix(left, right, "mention", "name").collect()}
    assert got == {(m, n) for m in mentions for n in names if n.startswith(m + " ")}


def test_domain_join_equals_startswith(spark):
    domains = ["acme.com", "acme.co.uk", "data.org", "nodot", "ac.me"]
    mentions = ["acme", "data", "ac", "x"]
    left = spark.createDataFrame([(m,) for m in mentions], "mention string")
    right = spark.createDataFrame([(d,) for d in domains], "domain string")
    got = {(r.mention, r.domain) for r in joins.join_domain_prefix(left, right, "mention", "domain").collect()}
    assert got == {(m, d) for m in mentions for d in domains if d.startswith(m + ".")}


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("threshold", [90, 75])
def test_fuzzy_matches_equal_all_pairs(spark, threshold):
    names = random_names(2, 120)
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.a, r.b) for r in fuzzy.match_names(df, df, threshold).collect()}
    assert got == {
        (a, b)
        for a, b in itertools.product(names, names)
        if 200 * lcs(a, b) / (len(a) + len(b)) >= threshold
    }


def test_fuzzy_matches_of_overlapping_sides_are_dealt_and_merged(spark):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdé 7") for _ in range(draw.randrange(1, 24))).strip() for _ in range(60)]
    words += [w[: len(w) // 2] + draw.choice("ab7") + w[len(w) // 2 :] for w in words]
    known = [words[:80] + [None, ""], words[40:]]
    a, b = (spark.createDataFrame([(w,) for w in side], "name string") for side in known)

    def alike(x, y):
        return 200 * fuzzy.lcs_length(x, y) / (len(x) + len(y)) >= 80

    found = fuzzy.match_names(a, b, 80)
    got = [(r.a, r.b) for r in found.collect()]
    left, right = ({w for w in side if w} for side in known)
    assert sorted(got) == sorted((x, y) for x in left for y in right if alike(x, y))
    alone = [(r.a, r.b) for r in fuzzy.match_names(a, None, 80).collect()]
    assert set(alone) == {(x, y) for x in left for y in left if len(x) <= len(y) and alike(x, y)}
    plan = fuzzy.match_names(a, None, 80)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    grown = fuzzy._distinct_names(a, b)  # as many tasks as there are to grow the names into signatures
    assert grown.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    for x in grown.collect():
        for y in grown.collect():
            differ = sum((p ^ q if (p ^ q) >= 0 else (p ^ q) + (1 << 64)).bit_count() for p, q in zip(x.bag, y.bag))
            assert differ <= len(x.name) + len(y.name) - 2 * fuzzy.lcs_length(x.name, y.name)


def test_fuzzy_join_ignores_token_order_and_empty_names(spark):
    left = spark.createDataFrame([(1, "Systems, Data"), (2, "")], "id long, mention string")
    right = spark.createDataFrame([("data systems",), (None,)], "name string")
    got = fuzzy.join_fuzzy(left, right, "mention", "name").collect()
    assert [(r.id, r.name, r.match_score) for r in got] == [(1, "data systems", 100.0)]


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    data = [("hot", float(x)) for x in np.round(rng.normal(size=30_000), 2)]
    data += [("one", 5.0), ("two", 1.0), ("two", 2.0)] + [("same", 7.0)] * 50
    df = spark.createDataFrame(data, "g string, x double")
    probabilities = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.95, "e": 1.0}
    got = {r.g: r for r in quantiles.exact_percentiles(df, ["g"], "x", probabilities).collect()}
    for group in ("hot", "one", "two", "same"):
        values = [x for g, x in data if g == group]
        for name, p in probabilities.items():
            assert np.isclose(got[group][name], np.quantile(values, p)), (group, name)


def test_row_index_is_dense_in_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), "id").repartition(7)
    got = ranking.with_row_index(df, ["v", "id"]).orderBy("v", "id").collect()
    assert [r.row_index for r in got] == list(range(5000))


def test_shares_sum_to_hundred(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "k string")
    shares = aggregates.compare_shares(df, "k", {"all": F.lit(True), "a": F.col("k") == "a"})
    total = shares.agg(F.sum("percentage_all"), F.sum("percentage_a")).first()
    assert np.allclose(list(total), [100, 100])


def test_every_value_from_the_first_edge_has_one_bin(spark):
    df = spark.range(1, 300_000, 97).select(F.col("id").alias("n"))
    counted = bins.count_bins(df, "n", bins.EMPLOYEE_EDGES, bins.EMPLOYEE_LABELS)
    assert counted.agg(F.sum("count")).first()[0] == df.count()


def test_quantile_bins_keep_ties_together(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(2,)] * 2 + [(9,)], "n long")
    got = bins.bin_quantile(df, "n").groupBy("n").agg(F.count_distinct("bin").alias("b")).collect()
    assert all(r.b == 1 for r in got)


def window_case(spark, seed=4):
    draw = random.Random(seed)
    day = lambda: draw.randrange(0, 400)
    events = [(i, "hot" if i % 3 else f"e{i % 5}", day()) for i in range(60)]
    mentions = [(i, "hot" if i % 3 else f"e{i % 7}", day()) for i in range(300)]
    base = F.lit("2020-01-01").cast("date")
    e = spark.createDataFrame(events, "id long, org string, d int")
    m = spark.createDataFrame(mentions, "mid long, who string, md int")
    e = e.select("id", "org", F.date_add(base, F.col("d")).alias("ed"))
    m = m.select("mid", "who", F.date_add(base, F.col("md")).alias("mdate"))
    return events, mentions, e, m


@pytest.mark.parametrize("max_days", [1, 2, 30, 89])
def test_bucketed_window_equals_all_pairs(spark, max_days):
    events, mentions, e, m = window_case(spark)
    expected = {
        (i, j)
        for i, org, d in events
        for j, who, md in mentions
        if org == who and 0 < md - d < max_days
    }
    pairs = attribution.attribute_in_window(e, m, [("org", "who")], "ed", "mdate", max_days)
    assert {(r.id, r.mid) for r in pairs.collect()} == expected
    counts = attribution.coverage_per_event(e, m, [("org", "who")], "ed", "mdate", max_days)
    got = {r.id: r.n_articles for r in counts.collect()}
    assert got == {i: sum(1 for a, _ in expected if a == i) for i, _, _ in events}


def test_learned_window_is_smallest_gap_less_a_day(spark):
    events, mentions, e, m = window_case(spark)
    by_org = {}
    for _, org, d in events:
        by_org.setdefault(org, set()).add(d)
    gap = min(b - a for ds in by_org.values() for a, b in itertools.pairwise(sorted(ds)))
    assert attribution.min_event_gap(e, "org", "ed").first()[0] == gap


def test_bootstrap_interval_covers_the_point(spark):
    df = spark.range(4000).select("id", (F.col("id") % 10).alias("x"), (F.col("id") % 2).alias("g"))
    ci = bootstrap.bootstrap_mean_ci(df, ["id"], "x", ["g"], n=300, frac=1.0)
    for r in ci.collect():
        mean = 4.0 if r.g == 0 else 5.0
        assert r.low < mean < r.high
        # The standard error of the mean is about 0.063.
        assert 0.18 < r.high - r.low < 0.32
    shares = bootstrap.bootstrap_share_ci(df.withColumn("k", F.col("x").cast("string")), "k", n=300)
    assert all(r.low < 0.1 < r.high and r.high - r.low < 0.025 for r in shares.collect())


def test_bootstrap_does_not_depend_on_partitions(spark):
    df = spark.range(2000).select("id", (F.col("id") % 7).alias("x"))
    a = bootstrap.bootstrap_mean_ci(df.repartition(3), ["id"], "x", n=50).first()
    b = bootstrap.bootstrap_mean_ci(df.repartition(11), ["id"], "x", n=50).first()
    assert np.allclose([a.low, a.high], [b.low, b.high])


def random_vectors(spark, n, seed):
    rng = np.random.default_rng(seed)
    matrix = (rng.normal(size=(n, 5)) * 4).round() / 4  # exact, so ties are ties
    data = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)]
    return matrix, spark.createDataFrame(data, "id long, v array<double>")


def expected_neighbours(a, b, k):
    out = set()
    for i, q in enumerate(a):
        d = ((b - q) ** 2).sum(axis=1)
        out |= {(i, int(j), r + 1) for r, j in enumerate(np.lexsort((np.arange(len(b)), d.round(9)))[:k])}
    return out


def test_three_ways_of_nearest_neighbours_agree(spark, monkeypatch):
    a, queries = random_vectors(spark, 70, 5)
    b, base = random_vectors(spark, 90, 6)
    queries, expected = queries.withColumnRenamed("id", "q"), expected_neighbours(a, b, 4)
    for limit in (1000, 80, 10):  # small base, few queries, grid
        monkeypatch.setattr(vectors, "BROADCAST_BYTES", limit * 8 * a.shape[1])
        monkeypatch.setattr(vectors, "GRID_ROWS", 25)
        found = vectors.knn(queries, base, "q", "id", "v", 4).collect()
        assert {(r.q, r.neighbour_id, r["rank"]) for r in found} == expected, limit


def test_custom_kmeans_separates_far_groups(spark):
    rng = np.random.default_rng(7)
    data = [(i, [float(100 * (i % 2)) + float(rng.normal()), 0.0]) for i in range(100)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    got = {r.id: r.cluster for r in vectors.kmeans_custom(df, "id", "v", 2, seed=3).collect()}
    even, odd = ({got[i] for i in range(start, 100, 2)} for start in (0, 1))
    assert len(got) == 100 and len(even) == len(odd) == 1 and even != odd


def test_distance_matrix_equals_differences():
    rng = np.random.default_rng(9)
    points, centres = rng.normal(size=(50, 6)) + 1e5, rng.normal(size=(7, 6)) + 1e5
    expected = np.sqrt(((points[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2))
    assert np.allclose(vectors.euclidean(points, centres), expected, rtol=1e-8)


def test_neighbours_far_from_the_origin():
    rng = np.random.default_rng(10)
    points, base = rng.normal(size=(200, 4)) + 1e7, rng.normal(size=(500, 4)) + 1e7
    for point, (_, ids) in zip(points, vectors._nearest(points, base, np.arange(500), 3)):
        exact = ((base - point) ** 2).sum(axis=1)
        assert ids.tolist() == np.lexsort((np.arange(500), exact))[:3].tolist()


def test_null_vectors_have_no_neighbours(spark):
    data = [(1, [0.0, 1.0]), (2, None), (3, [0.0, 3.0])]
    df = spark.createDataFrame(data, "id long, v array<double>")
    found = vectors.knn(df.withColumnRenamed("id", "q"), df, "q", "id", "v", 2).collect()
    assert {(r.q, r.neighbour_id) for r in found} == {(1, 1), (1, 3), (3, 3), (3, 1)}


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(nodes, 2):
            if linked(a, b) and label[a] != label[b]:
                low = min(label[a], label[b])
                label[a] = label[b] = low
                changed = True
    return label


def test_chains_of_near_values_are_components(spark):
    draw = random.Random(8)
    data = [(i, "b" if i % 4 else "c", draw.randrange(0, 800) / 10) for i in range(120)]
    df = spark.createDataFrame(data, "id long, block string, x double")
    edges = components.edges_within(df, "id", "x", 0.5, ["block"])
    got = {r.id: r.component for r in components.cluster(df, "id", edges).collect()}
    rows = {i: (b, x) for i, b, x in data}
    assert got == brute_components(
        list(rows), lambda a, b: rows[a][0] == rows[b][0] and abs(rows[a][1] - rows[b][1]) <= 0.5
    )


def test_predicate_clusters_equal_all_pairs(spark):
    data = [(i, i % 3, i * i % 17) for i in range(60)]
    df = spark.createDataFrame(data, "id long, block long, v long")
    edges = components.edges_by_predicate(
        df, "id", lambda a, b: F.abs(a("v") - b("v")) == 1, ["block"]
    )
    got = {r.id: r.component for r in components.cluster(df, "id", edges).collect()}
    rows = {i: (b, v) for i, b, v in data}
    assert got == brute_components(
        list(rows), lambda a, b: rows[a][0] == rows[b][0] and abs(rows[a][1] - rows[b][1]) == 1
    )
    cut = components.edges_by_predicate(
        df, "id", lambda a, b: F.abs(a("v") - b("v")) == 1, ["block"], chunk=3
    )
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, edges.collect()))


def test_long_path_is_one_component(spark):
    nodes = spark.range(200)
    edges = spark.range(199).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    got = components.connected_components(nodes, edges, "id")
    assert got.filter("component != 0").count() == 0


def test_density_integrates_to_one(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("x"))
    grid = [float(g) for g in range(-60, 111, 2)]
    total = stats.kde(df, "x", grid).agg(F.sum("density")).first()[0] * 2
    assert abs(total - 1) < 1e-6


def test_normalised_names_have_no_punctuation(spark):
    df = spark.createDataFrame([("A.B, C-d_e!",), ("日本 Co.",)], "s string")
    assert [r.n for r in df.select(normalise_name(F.col("s")).alias("n")).collect()] == ["ab cd_e", "日本 co"]


def test_another_kmeans_round_changes_no_label(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.1"
    label = {r.vec_id: r.cluster for r in entry.queries()["v06_kmeans_custom"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [r for r in rows if r.vec_id in label]
    points = np.array([r.embedding for r in rows], dtype=np.float64)
    held = np.array([label[r.vec_id] for r in rows])
    used = np.unique(held)
    centres = np.stack([points[held == c].mean(axis=0) for c in used])
    far = np.linalg.norm(points[:, None, :] - centres[None, :, :], axis=2)
    assert len(rows) == len(label) and (used[far.argmin(axis=1)] == held).all()
