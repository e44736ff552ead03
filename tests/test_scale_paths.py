"""Ways that large, skewed or dirty inputs take, against plain computations."""

import collections
import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.operators import aggregates, attribution, bootstrap, classifier, components, heavy, joins, quantiles, ranking, vectors

NAN, INF = float("nan"), float("inf")


def percentile(values, p):
    """Linear interpolation with NaN as the largest value."""
    values = sorted(values, key=lambda x: (x != x, x))
    at = p * (len(values) - 1)
    low, high = values[int(np.floor(at))], values[int(np.ceil(at))]
    return low if low == high else low + (high - low) * (at - np.floor(at))


def same(a, b):
    return a is b or a == b or (a != a and b != b) or abs(a - b) <= 1e-9 * max(1.0, abs(a))


@pytest.mark.parametrize("last", [0, 1 << 20])
def test_percentiles_of_hot_and_odd_groups(spark, monkeypatch, last):
    monkeypatch.setattr(quantiles, "LAST_BUCKET", last)
    draw = random.Random(8)
    groups = {
        "hot": [draw.gauss(0, 10) for _ in range(3000)],
        "equal": [2.5] * 40,
        "tails": [s * 10.0**e for e in range(-300, 301, 30) for s in (1, -1)] + [0.0, -0.0, 5e-324],
        "nan": [NAN, 1.0, 2.0, 4.0],
        "mostly nan": [NAN, NAN, NAN, 1.0],
        "infinite": [INF, -INF, 3.0, INF, -INF],
        "one": [-7.0],
        None: [1.0, 3.0],
    }
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("empty", None), ("one", None)]
    wanted = {"low": 0.0, "q1": 0.25, "mid": 0.5, "q9": 0.9, "high": 1.0}
    for seed in (1, 2):  # any order of rows
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "g string, x double").repartition(7)
        got = {r.g: r for r in quantiles.exact_percentiles(df, ["g"], "x", wanted).collect()}
        assert set(got) == set(groups)
        for g, values in groups.items():
            for name, p in wanted.items():
                assert same(got[g][name], percentile(values, p)), (g, name, got[g][name])


def test_percentiles_without_groups_and_rows(spark):
    df = spark.createDataFrame([(float(i % 11),) for i in range(101)], "x double")
    assert quantiles.exact_percentiles(df, [], "x", {"m": 0.5}).collect()[0].m == 5.0
    none = df.filter("x > 100")
    assert quantiles.exact_percentiles(none, [], "x", {"m": 0.5}).count() == 0
    assert quantiles.exact_percentiles(none.withColumn("g", F.lit(1)), ["g"], "x", {"m": 0.5}).count() == 0


def test_order_keys_keep_the_order(spark):
    values = [-INF, -1e308, -1.5, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 1e308, INF, NAN]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    keyed = df.select("i", quantiles.order_key("x").alias("k"))
    rows = keyed.select("i", "k", quantiles.key_value("k").alias("y")).orderBy("k").collect()
    assert [r.i for r in rows] == list(range(len(values)))
    assert all(same(r.y, values[r.i]) for r in rows)


def brute_neighbours(queries, base, k):
    out = set()
    for q, v in queries:
        d = sorted((sum((x - y) ** 2 for x, y in zip(v, w)), i) for i, w in base)
        out |= {(q, i, round(x, 6), r + 1) for r, (x, i) in enumerate(d[:k])}
    return out


def clustered_vectors(n, seed):
    """Far groups, one of which holds a third of all vectors at one point."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        centre = 0 if i % 3 == 0 else draw.randrange(1, 12)
        spread = 0 if i % 3 == 0 else 1
        out.append((i, [100.0 * centre + spread * draw.gauss(0, 1), 50.0 * (centre % 4), float(centre)]))
    return out


@pytest.mark.parametrize("k", [1, 5, 700])
def test_pruned_neighbours_equal_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(vectors, "BROADCAST_BYTES", 100)
    monkeypatch.setattr(vectors, "CELL_ROWS", 40)
    monkeypatch.setattr(vectors, "GRID_ROWS", 64)
    a, b = clustered_vectors(90, 1), clustered_vectors(600, 2)
    queries = spark.createDataFrame(a, "q long, v array<double>")
    base = spark.createDataFrame(b, "id long, v array<double>").repartition(5)
    found = vectors.knn(queries, base, "q", "id", "v", k).collect()
    assert {(r.q, r.neighbour_id, round(r.distance, 6), r["rank"]) for r in found} == brute_neighbours(a, b, k)


def test_pruned_cells_are_not_copied(spark, monkeypatch):
    """Queries near one group reach none of the others."""
    monkeypatch.setattr(vectors, "CELL_ROWS", 10)
    rows = [(i, [1000.0 * (i % 8) + i / 1000, 0.0]) for i in range(160)]
    base = spark.createDataFrame(rows, "id long, v array<double>")
    cells = vectors._Cells(base, "id", "v", 2, 160)
    near = {r["_cell"] for r in cells.placed.filter(F.col("v")[0] < 500).collect()}
    queries = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(5)], "q long, v array<double>")
    bars = queries.withColumn("_bar", F.lit(100.0))
    schema = "q long, v array<double>, _cell long"
    for df in (queries, bars):
        routed = df.mapInPandas(cells._router("q", 3), schema).collect()
        assert {r["_cell"] for r in routed} <= near


def test_dirty_vectors_take_no_part(spark, monkeypatch):
    bad = [None, [NAN, 1.0], [None, 1.0], [INF, 0.0], [1.0], [1.0, 2.0, 3.0], []]
    good = [(i, [float(i), 0.0]) for i in range(20)]
    rows = good + [(100 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    queries = df.withColumnRenamed("id", "q")
    expected = brute_neighbours(good, good, 3)
    for limit in (1 << 20, 0):
        monkeypatch.setattr(vectors, "BROADCAST_BYTES", limit)
        found = vectors.knn(queries, df, "q", "id", "v", 3).collect()
        assert {(r.q, r.neighbour_id, round(r.distance, 6), r["rank"]) for r in found} == expected
    labels = vectors.kmeans_custom(df, "id", "v", 2).collect()
    assert sorted(r.id for r in labels) == list(range(20))


def test_vector_operators_on_empty_tables(spark):
    none = spark.createDataFrame([], "id long, v array<double>")
    one = spark.createDataFrame([(1, [1.0, 2.0])], "q long, v array<double>")
    assert vectors.knn(one, none, "q", "id", "v", 2).count() == 0
    assert vectors.knn(none.withColumnRenamed("id", "q"), one.withColumnRenamed("q", "id"), "q", "id", "v", 2).count() == 0
    assert vectors.sample_kmeans(none, "id", "v", 3).count() == 0
    assert vectors.kmeans_custom(none, "id", "v", 3).count() == 0
    assert vectors.sample_diagonal(none, "id", "v", 3).count() == 0


@pytest.fixture
def shuffled_joins(spark, monkeypatch):
    """No broadcasts and no splitting by Spark, so that keys go where the join puts them."""
    monkeypatch.setattr(heavy, "SMALL_BYTES", 0)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def skewed(spark, n, seed, share):
    draw = random.Random(seed)
    key = lambda: None if draw.random() < 0.05 else "Acme Ltd" if draw.random() < share else f"name {draw.randrange(40)}"
    return [(i, key()) for i in range(n)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(spark, shuffled_joins, how):
    a = spark.createDataFrame(skewed(spark, 600, 1, 0.9), "i long, a string")
    b = spark.createDataFrame(skewed(spark, 80, 2, 0.3), "j long, b string")
    plain = collections.Counter(a.join(b, a.a == b.b, how).collect())
    split = heavy.split_join(a, b, a.a, b.b, how, salts=4)
    assert "_la" in split._jdf.queryExecution().analyzed().toString()
    assert collections.Counter(split.collect()) == plain and split.columns == a.join(b, a.a == b.b, how).columns


def test_hot_mention_spreads_over_tasks(spark, shuffled_joins):
    rows = skewed(spark, 20_000, 3, 0.9)
    articles = spark.createDataFrame(rows, "article long, mention string")
    companies = spark.createDataFrame([(f"name {i}", i) for i in range(40)] + [("ACME, ltd.", 99)], "name string, size int")
    joined = joins.join_normalised(articles, companies, "mention", "name")
    assert joined.count() == sum(1 for _, m in rows if m)
    per_task = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) > 4 and max(per_task) <= 3 * np.median(per_task)


def test_name_keys_are_computed_before_the_join_sorts(spark, shuffled_joins):
    left = spark.createDataFrame([("A.b",), ("c",), (None,), ("!",)], "x string")
    right = spark.createDataFrame([("a b",), ("AB.",), ("c-",)], "y string")
    for joined in (joins.join_normalised(left, right, "x", "y"), joins.join_ci_exact(left, right, "x", "y")):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        steps = [line for line in plan.splitlines() if "Sort" in line or "Exchange" in line]
        assert steps and not any("lower(" in line or "regexp_replace(" in line for line in steps)
        assert joined.columns == ["x", "y"]
    assert sorted(map(tuple, joins.join_normalised(left, right, "x", "y").collect())) == [("A.b", "AB."), ("c", "c-")]


def test_few_mentions_meet_events_of_two_buckets(spark):
    days = spark.range(-2000, 2000).select(F.col("id").cast("int").alias("day"))
    width = 10 * attribution.BUCKET_WINDOWS
    copies = days.select("day", F.explode(attribution._event_buckets(F.col("day"), 10, width)).alias("b"))
    assert copies.count() < 1.5 * 4000
    held = {(r.day, r.b) for r in copies.collect()}
    assert all((day, (day - gap) // width) in held for day in range(-2000, 2000) for gap in range(1, 10))


def test_shipped_floats_stay_floats_and_blocks_equal_the_whole(spark, monkeypatch):
    draw = np.random.default_rng(5)
    base = draw.integers(-4, 5, (700, 3)).astype(np.float32)  # many ties
    ids, points = draw.permutation(700), draw.normal(size=(40, 3))
    monkeypatch.setattr(vectors, "_BASE_ROWS", 64)
    for k in (1, 5, 100, 900):
        whole = list(vectors._nearest(points, base.astype(np.float64), ids, k))
        blocks = vectors._nearest_by_blocks(points, base, ids, k)
        for (d, i), (e, j) in zip(whole, blocks, strict=True):
            assert np.allclose(d, e, rtol=1e-12) and (i == j).all()
    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<float>")
    assert vectors._shipped(df, "id", "v").value[1].dtype == np.float32
    double = df.select("id", F.col("v").cast("array<double>").alias("v"))
    assert vectors._shipped(double, "id", "v").value[1].dtype == np.float64


def test_heavy_keys_are_found(spark):
    df = spark.createDataFrame(skewed(spark, 5000, 4, 0.5), "i long, a string")
    hot = heavy.heavy_keys(df, F.col("a"), 0.1)
    wanted = [r.h for r in df.filter("a = 'Acme Ltd'").select(F.xxhash64("a").alias("h")).distinct().collect()]
    assert hot == wanted
    assert heavy.heavy_keys(df.limit(0), F.col("a")) == []


def dated(n, seed, hot):
    draw = random.Random(seed)
    day = lambda: None if draw.random() < 0.04 else dt.date(2019, 1, 1) + dt.timedelta(days=draw.randrange(2500))
    name = lambda: None if draw.random() < 0.04 else "hot" if draw.random() < hot else f"e{draw.randrange(6)}"
    return [(i, name(), day()) for i in range(n)]


@pytest.mark.parametrize("window", [1, 2, 90, 900])
def test_coverage_equals_counting(spark, window):
    events, mentions = dated(120, 5, 0.6), dated(900, 6, 0.8)
    e = spark.createDataFrame(events, "event long, who string, at date")
    m = spark.createDataFrame(mentions, "article long, whom string, day date")
    inside = lambda a, b: bool(a and b and 0 < (b - a).days < window)
    for keep in (True, False):
        got = attribution.coverage_per_event(e, m, [("who", "whom")], "at", "day", window, keep_uncovered=keep)
        known = {w for _, w, _ in mentions if w}
        expected = {}
        for i, w, at in events:
            n = sum(1 for _, x, day in mentions if w and x == w and inside(at, day))
            if keep or n or w not in known:
                expected[i] = n
        assert {r.event: r.n_articles for r in got.collect()} == expected


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("keep", [False, True])
def test_window_left_join_equals_counting(spark, null_safe, keep):
    events, mentions = dated(60, 7, 0.5), dated(200, 8, 0.5)
    e = spark.createDataFrame(events, "event long, who string, at date")
    m = spark.createDataFrame(mentions, "article long, whom string, day date")
    got = attribution.attribute_in_window_left(
        e, m, [("who", "whom")], "event", "at", "day", 60, keep_uncovered=keep, null_safe=null_safe
    )
    equal = lambda a, b: a == b if null_safe else bool(a and b and a == b)
    expected = collections.Counter()
    for i, w, at in events:
        hits = [a for a, x, day in mentions if equal(w, x) and at and day and 0 < (day - at).days < 60]
        if not hits and (keep or not any(equal(w, x) for _, x, _ in mentions)):
            hits = [None]
        expected.update((i, a) for a in hits)
    assert collections.Counter((r.event, r.article) for r in got.collect()) == expected


def test_bootstrap_with_null_groups(spark):
    rows = [(i, None if i % 3 == 0 else "a", None if i % 4 == 0 else i % 2, 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, g string, h int, x double")
    for groups in (["g"], ["h"], ["g", "h"]):
        found = bootstrap.bootstrap_mean_ci(df, ["id"], "x", groups, n=20, frac=1.0).collect()
        assert len(found) == len({tuple(r[c] for c in groups) for r in df.collect()})
        assert all(r.low == r.high == 1.0 for r in found)


def test_replicate_statistics_equal_their_definitions(spark):
    draw = random.Random(12)
    rows = [(i, float(i % 9), 3.0 * (i % 9) + draw.gauss(0, 2), i % 3 == 0, i % 4 == 0) for i in range(80)]
    rows += [(100, None, 1.0, None, True), (101, 2.0, None, True, None)]
    df = spark.createDataFrame(rows, "id long, x double, y double, t boolean, p boolean")
    n = 30
    key = df.select(bootstrap.row_key(["id"], 42).alias("k")).toPandas()["k"].to_numpy().astype(np.uint64)
    weights = np.searchsorted(bootstrap._poisson_steps(1.0), bootstrap._uniform(key, n), side="right")
    pairs = [(x, y) for _, x, y, _, _ in rows]
    slopes, f1s = [], []
    for r in range(n):
        drawn = [p for p, w in zip(pairs, weights[:, r]) for _ in range(w) if None not in p]
        slopes.append(np.polyfit(*zip(*drawn), 1)[0])
        cells = collections.Counter((t, p) for (_, _, _, t, p), w in zip(rows, weights[:, r]) for _ in range(w))
        f1s.append(2 * cells[True, True] / (2 * cells[True, True] + cells[True, False] + cells[False, True]))
    moments = bootstrap.regression_moments(F.col("x"), F.col("y")) | bootstrap.confusion_moments(F.col("t"), F.col("p"))
    stats = {"slope": bootstrap.slope(), "f1": bootstrap.f1(), "never": bootstrap.slope() / F.lit(None)}
    got = {r.statistic: r for r in bootstrap.bootstrap_statistics_ci(df, ["id"], moments, stats, n=n).collect()}
    assert set(got) == {"slope", "f1"}
    for name, values in (("slope", slopes), ("f1", f1s)):
        ends = np.percentile(values, [2.5, 97.5])
        assert np.allclose([got[name].low, got[name].high], ends) and got[name].n_replicates == n
    assert bootstrap.bootstrap_statistics_ci(df.limit(0), ["id"], moments, stats, n=n).count() == 0


def test_sketches_merge_to_the_counts_of_the_whole(spark):
    """Groups of nulls only, a null key, values in many days, and merging in two steps."""
    rows = [("a", day, f"u{(day * 37 + i) % 900}", None) for day in range(20) for i in range(100)]
    rows += [(None, 1, "x", "y"), (None, 2, "x", "z"), ("b", 1, None, None)]
    df = spark.createDataFrame(rows, "site string, day int, url string, org string")
    daily = aggregates.distinct_sketches(df, ["site", "day"], ["url", "org"])
    weekly = aggregates.merge_sketches(daily.withColumn("week", F.floor(F.col("day") / 7)), ["site", "week"], ["url", "org"])
    merged = aggregates.merge_sketches(weekly, ["site"], ["url", "org"])
    got = {r.site: (r.n_url, r.n_org) for r in aggregates.sketched_counts(merged, ["url", "org"]).collect()}
    distinct = len({r[2] for r in rows if r[0] == "a"})
    assert abs(got["a"][0] - distinct) <= 0.05 * distinct and got["a"][1] == 0
    assert got[None] == (1, 2) and got["b"] == (0, 0)
    assert aggregates.sketched_counts(aggregates.merge_sketches(daily.limit(0), ["site"], ["url"]), ["url"]).count() == 0


def test_skipping_rows_equals_sorting_them(spark):
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 2, 3]), draw.choice(["a", "b", None]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, i int").repartition(5)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for n in (0, 1, 17, 60, 123, 199, 200, 500):
        got = collections.Counter((r.a, r.b) for r in ranking.skip_data_rows(df, ["a", "b"], n).collect())
        assert got == collections.Counter((a, b) for a, b, _ in order[n:]), n
        total = ranking.skip_data_rows(df, ["b", "i"], n)
        known = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2]))[n:]
        assert sorted(r.i for r in total.collect()) == sorted(r[2] for r in known)
    reverse = ranking.skip_data_rows(df, [F.desc("i")], 150)
    assert sorted(r.i for r in reverse.collect()) == list(range(50))
    odd = spark.createDataFrame([(NAN,), (1.0,), (-0.0,), (0.0,), (INF,)], "x double")
    assert sorted(str(r.x) for r in ranking.skip_data_rows(odd, ["x"], 3).collect()) == ["inf", "nan"]
    assert ranking.skip_data_rows(odd.limit(0), ["x"], 3).count() == 0


def test_components_by_any_rule_equal_plain_ones(spark):
    draw = random.Random(4)
    rows = [(i, draw.choice("pq"), draw.randrange(500)) for i in range(150)] + [(900, None, 7), (901, None, 8)]
    df = spark.createDataFrame(rows, "id int, g string, x int").repartition(4)
    rule = lambda a, b: (F.abs(a("x") - b("x")) <= 3) | (a("x") == 2 * b("x"))
    edges = components.edges_by_predicate(df, "id", rule, ["g"], chunk=16)
    near = collections.defaultdict(set)
    for i, g, x in rows:
        for j, h, y in rows:
            if g == h and i < j and (abs(x - y) <= 3 or x == 2 * y):
                near[i].add(j)
                near[j].add(i)
    assert {(r.src, r.dst) for r in edges.collect()} == {(i, j) for i in near for j in near[i] if i < j}
    wanted = {}
    for i, _, _ in sorted(rows):
        todo = [i] if i not in wanted else []
        while todo:
            at = todo.pop()
            if at not in wanted:
                wanted[at] = i
                todo += near[at]
    assert {r.id: r.component for r in components.cluster(df, "id", edges).collect()} == wanted


def test_neighbours_in_order_decide_components(spark):
    draw = random.Random(6)
    odd = [NAN, NAN, INF, INF, -INF, None, 0.0, -0.0]
    rows = [(i, draw.choice("pqt"), draw.uniform(-9, 9) * 10 ** draw.randrange(4)) for i in range(300)]
    rows += [(300 + i, "p" if i < 4 else None, x) for i, x in enumerate(odd)] + [(310, None, 5.0), (311, "q", INF), (312, "q", INF)]
    rows += [(400 + i, "r", 7.0) for i in range(200)] + [(700, "s", INF), (701, "s", INF), (None, "r", 7.0), (310, "q", 5.0)]
    df = spark.createDataFrame(rows, "id int, g string, x double").repartition(5)

    def rule(a, b):
        return F.abs(a("x") - b("x")) * 50 <= F.greatest(F.abs(a("x")), F.abs(b("x")))

    all_pairs = components.edges_by_predicate(df, "id", rule, ["g"])
    edges = components.edges_by_predicate(df, "id", rule, ["g"], order="x")
    found = [{r.id: r.component for r in components.cluster(df, "id", e).collect()} for e in (all_pairs, edges)]
    assert found[0] == found[1] and len(set(found[0].values())) > 20
    assert edges.count() < 2 * len(rows) < all_pairs.count()
    with pytest.raises(ValueError):
        components.edges_by_predicate(df, "id", rule, ["g"], order="g")


def test_chains_of_values_over_many_tasks_are_two_steps_deep(spark):
    draw = random.Random(8)
    ids = draw.sample(range(10_000), 700)
    rows = [(i, draw.choice(["p", "p", "q", None]), 1.01 ** draw.randrange(1200)) for i in ids]
    rows += [(10_000 + i, "r", 10.0**i) for i in range(40)] + [(20_000 + i, "r", 1e9) for i in range(3)]
    df = spark.createDataFrame(rows, "id int, g string, x double").repartition(5)

    def rule(a, b):
        return F.abs(a("x") - b("x")) * 20 <= F.greatest(F.abs(a("x")), F.abs(b("x")))

    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    was = [(k, spark.conf.get(k)) for k in (coalesce, "spark.sql.shuffle.partitions")]
    try:
        spark.conf.set(coalesce, "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        edges = [(r.src, r.dst) for r in components.edges_by_predicate(df, "id", rule, ["g"], order="x").collect()]
    finally:
        for k, v in was:
            spark.conf.set(k, v)
    all_pairs = components.edges_by_predicate(df, "id", rule, ["g"])
    wanted = {r.id: r.component for r in components.cluster(df, "id", all_pairs).collect()}
    least = {i: i for i in wanted}
    for a, b in edges:
        least[a], least[b] = min(least[a], b), min(least[b], a)
    assert {i: least[least[i]] for i in wanted} == wanted
    assert 40 < len(set(wanted.values())) < len(rows) / 2 and len(edges) < 2 * len(rows)


def test_estimates_of_size_do_not_grow_with_the_steps_of_a_chain(spark):
    ties = spark.range(1, 300).select(F.col("id").alias("src"), (F.col("id") - 1).alias("dst"))
    found = components.connected_components(spark.range(300).toDF("id"), ties, "id")
    assert {r.component for r in found.collect()} == {0}
    estimate = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert estimate < 1 << 64


def test_a_classifier_on_words_takes_null_texts_and_labels(spark):
    rows = [("data leak", True, None if i % 5 == 0 else True) if i % 2 else ("green tea", False, False) for i in range(60)]
    df = spark.createDataFrame([*rows, (None, True, True)], "text string, breach boolean, other boolean")
    model = classifier.train_text_classifier(df, ["breach", "other"], text="text", max_iter=10)
    got = model.predict(df)
    assert got.columns == ["text", "breach", "other", "breach_pred", "other_pred"] and got.count() == 61
    assert all(r.breach_pred == r.breach == r.other_pred for r in got.filter("text is not null").collect())
