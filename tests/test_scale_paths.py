"""The paths for large or skewed data give the same results as the plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.operators import cleaning, correlation, imputation, neighbours, ranking, sampling
from flowloom.plans import batch
from flowloom.plans.bounded import lookup_join, small_table
from flowloom.plans.checkpoints import durable, spread
from flowloom.plans import quantiles
from flowloom.plans.quantiles import exact_quantiles, grouped_quantiles
from flowloom.plans.ranking import flag_quota, number_rows


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows are copies of one row."""
    rows = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"))
    return rows.withColumn("id", F.when(F.col("k") == "hot", 0).otherwise(F.col("id"))).persist()


def test_positions(skewed):
    order = [F.col("id")]
    for part in ([], ["k"]):
        split = number_rows(skewed, part, order, "n", window_rows=5)
        assert split.count() == 2000
        per = split.groupBy(*part).agg(F.count("*").alias("c"), F.count_distinct("n").alias("d"), F.min("n").alias("a"), F.max("n").alias("b"))
        assert per.filter("c <> d or a <> 1 or b <> c").isEmpty()
        plain = number_rows(skewed, part, order, "n")
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))


def test_positions_keep_null_groups(spark):
    df = spark.range(30).select("id", F.when(F.col("id") % 2 == 0, "a").alias("k"))
    got = number_rows(df, ["k"], [F.col("id")], "n", window_rows=3)
    assert got.count() == 30 and got.filter("k is null").agg(F.max("n")).first()[0] == 15


@pytest.mark.parametrize("quota", [0, 1, 10, 400, 10_000])
def test_quota_with_copies(skewed, quota):
    quotas = skewed.select("k").distinct().withColumn("quota", F.lit(quota).cast("long"))
    flagged = flag_quota(skewed, ["k"], quotas, 42, ["id", "k"], ["id"], "in", window_rows=5)
    sizes = {r["k"]: (r["c"], r["t"]) for r in flagged.groupBy("k").agg(F.count("*").alias("c"), F.count_if("in").alias("t")).collect()}
    assert all(t == min(quota, c) for c, t in sizes.values()) and sum(c for c, _ in sizes.values()) == 2000
    plain = flag_quota(skewed, ["k"], quotas, 42, ["id", "k"], ["id"], "in")
    assert sorted(map(tuple, flagged.collect())) == sorted(map(tuple, plain.collect()))


def test_split_sizes_with_copies(skewed):
    parts = sampling.stratified_split(skewed, "k", 0.3, 42, ["id"], ["id"], window_rows=5)
    assert parts.filter("split = 'test'").count() == 600 and parts.count() == 2000


def test_samples(skewed):
    for kw in ({}, {"window_rows": 5}):
        assert sampling.sample_n(skewed, ["k"], 50, 1, ["id"], ["id"], **kw).groupBy("k").count().filter("count <> 50").isEmpty()
        assert sampling.cap_rows(skewed, 77, 1, ["id"], ["id"], **kw).count() == 77


def test_folds_differ_by_at_most_one(skewed):
    folds = sampling.stratified_folds(skewed, "k", 5, 42, ["id"], ["id"], window_rows=5)
    spread = folds.groupBy("k", "fold").count().groupBy("k").agg((F.max("count") - F.min("count")).alias("gap"), F.count("*").alias("folds"))
    assert spread.filter("gap > 1 or folds <> 5").isEmpty()


def test_latest_beyond_group_limit(skewed, monkeypatch):
    whole = ranking.latest_n(skewed, "k", "id", 20, "id").count()
    monkeypatch.setattr(ranking, "GROUP_LIMIT", 5)
    assert ranking.latest_n(skewed, "k", "id", 20, "id").count() == whole == 160


def test_lookup_join_paths(skewed):
    dim = skewed.select("k").distinct().withColumn("v", F.length("k")).filter("k <> 'k1'")
    for how in ("left", "inner", "left_anti"):
        for null_safe in (False, True):
            got = [
                sorted(map(str, lookup_join(skewed, dim, ["k"], how, max_rows=m, null_safe=null_safe).collect()))
                for m in (1000, 1)
            ]
            assert got[0] == got[1]
    assert small_table(dim, 2) is None and small_table(dim, 100).count() == dim.count()


def test_quantiles(spark):
    rng = np.random.default_rng(5)
    n = 20_000
    data = {
        "normal": rng.normal(size=n), "ties": rng.integers(0, 5, n).astype(float), "constant": np.full(n, 3.0),
        "hot": np.where(rng.random(n) < 0.4, 7.0, rng.exponential(1e6, n)), "empty": np.full(n, np.nan),
    }
    rows = [tuple(None if np.isnan(x) else float(x) for x in r) for r in zip(*data.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in data)).persist()
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    cols = {c: F.col(c) for c in data}
    got = exact_quantiles(df, cols, probs, buffer_cells=0)
    assert got["empty"] == [None] * len(probs)
    for c in set(data) - {"empty"}:
        assert got[c] == pytest.approx(list(np.quantile(data[c], probs)), rel=1e-12, abs=1e-12)
    plain = exact_quantiles(df, cols, probs)
    assert plain["empty"] == [None] * len(probs)
    assert plain["normal"] == pytest.approx(got["normal"])
    grouped = df.withColumn("g", F.when(F.col("ties") < 4, "big").otherwise("small"))
    names = ["normal", "hot"]
    a, b = (
        {(r["g"], r["variable"]): r["q"] for r in grouped_quantiles(grouped, "g", {c: F.col(c) for c in names}, [0.5, 0.9], "q", cells).collect()}
        for cells in (12_000, 10**7)
    )
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


@pytest.mark.parametrize("slack", [0.01, 1e-9])
def test_quantiles_of_groups(spark, monkeypatch, slack):
    """Hot, small, null and valueless groups; with hardly any slack most brackets miss and are widened."""
    monkeypatch.setattr(quantiles, "SLACK", slack)
    rng = np.random.default_rng(6)
    groups = [None if g == 9 else f"g{g}" for g in np.where(rng.random(9000) < 0.4, 0, rng.integers(0, 12, 9000))] + ["none"] * 5
    x, y = rng.normal(size=9005), rng.integers(0, 4, 9005).astype(float)
    x[-5:], y[::3] = np.nan, np.nan
    rows = [(g, None if i % 50 == 0 else float(a), float(b)) for i, (g, a, b) in enumerate(zip(groups, x, y))]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    probs = [0.0, 0.25, 0.5, 1.0]
    got = {(r["g"], r["variable"]): r["q"] for r in grouped_quantiles(df, "g", {"x": F.col("x"), "y": F.col("y")}, probs, buffer_cells=0).collect()}
    assert len(got) == 2 * len(set(groups))
    for g in set(groups):
        for at, name in ((1, "x"), (2, "y")):
            mine = [r[at] for r in rows if r[0] == g and r[at] is not None and not np.isnan(r[at])]
            assert got[g, name] == (pytest.approx(list(np.quantile(mine, probs)), rel=1e-12) if mine else None)


def test_quantiles_scan_a_fixed_number_of_times(spark):
    n, width = 3000, 78
    scanned = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            scanned.add(len(batch))
            yield batch

    names = [f"c{i}" for i in range(width)]
    wide = spark.range(n).select("id", *[((F.col("id") * (i + 3)) % 1009).cast("double").alias(c) for i, c in enumerate(names)])
    df = wide.repartition(4).mapInArrow(seen, wide.schema)
    found = exact_quantiles(df, {c: F.col(c) for c in names}, [0.25, 0.5, 0.75], buffer_cells=0)
    assert scanned.value <= 8 * n
    for i in (0, 40, 77):
        assert found[f"c{i}"] == pytest.approx(list(np.quantile(np.arange(n) * (i + 3) % 1009, [0.25, 0.5, 0.75])))
    sizes = []
    for groups in (2, 2000):
        by = df.withColumn("g", F.col("id") % groups)
        plan = grouped_quantiles(by, "g", {"c0": F.col("c0"), "c1": F.col("c1")}, [0.5], buffer_cells=0)
        sizes.append(len(plan._jdf.queryExecution().optimizedPlan().toString().splitlines()))
    assert sizes[0] == sizes[1]


def test_pair_correlations(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 1, (3000, 4))
    x[:, 1] += x[:, 0]
    rows = [tuple(None if (i + j) % 11 == 0 else float(v) for j, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    one, two = (
        {(r["v1"], r["v2"]): r["corr"] for r in correlation.pair_correlations(df, list("abcd"), limit).collect()}
        for limit in (0, 100)
    )
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one)


def test_nearest_in_blocks(spark):
    rng = np.random.default_rng(2)
    pts = rng.normal(size=(120, 3))
    rows = [(str(i), float(i) if i % 3 else None, *map(float, p)) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "key string, t double, x double, y double, z double")
    ask = df.filter("t is null")
    known = [i for i in range(120) if i % 3]
    for block in (1000, 7):
        got = {}
        for r in neighbours.nearest(df, ask, "key", "t", ["x", "y", "z"], 5, block).collect():
            got.setdefault(int(r["key"]), []).append(r["value"])
        assert len(got) == 40
        for i, found in got.items():
            order = sorted(known, key=lambda j: np.linalg.norm(pts[i] - pts[j]))[:5]
            assert sorted(found) == sorted(map(float, order))
    filled = imputation.impute_knn(df, df, "key", "t", ["x", "y", "z"])
    assert filled.count() == 120 and filled.filter("t is null").isEmpty()


def test_nearest_equals_brute_force_on_awkward_points(spark):
    """Equal points, ties, missing coordinates, a constant coordinate and a hot point, in small leaves."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(1500, 4)), 1)
    x[:, 2] = 5.0
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:400] = [1.0, 2.0, 5.0, np.nan]
    t = rng.integers(0, 50, 1500).astype(float)
    asked = np.vstack([x[::50], [[np.nan] * 4, [9.0, np.nan, np.nan, np.nan], [1.0, 2.0, 5.0, 0.0]]])
    names = ["a", "b", "c", "d"]
    plain = lambda r: [None if np.isnan(v) else float(v) for v in r]
    df = spark.createDataFrame([(*plain(r), float(v)) for r, v in zip(x, t)], "a double, b double, c double, d double, t double")
    ask = spark.createDataFrame([(f"q{i}", *plain(r)) for i, r in enumerate(asked)], "key string, a double, b double, c double, d double")
    got = {}
    for r in neighbours.nearest(df, ask, "key", "t", names, 5, leaf=40).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["dist"], r["value"]))
    d = neighbours.distances(asked, x)
    for i in range(len(asked)):
        want = sorted((d[i, j], t[j]) for j in range(len(x)) if np.isfinite(d[i, j]))[:5]
        mine = sorted(got.get(f"q{i}", []))
        assert [v for *_, v in mine] == [v for _, v in want] and [e for _, e, _ in mine] == pytest.approx([e for e, _ in want])


def test_visited_leaves_grow_far_slower_than_donors(spark):
    visits, leaves = [], []
    for n in (2_000, 32_000):
        rng = np.random.default_rng(n)
        pdf = rng.random((n, 3))
        df = spark.createDataFrame([(1.0, *map(float, r)) for r in pdf], "t double, x double, y double, z double")
        tree = neighbours.build_tree(df, ["x", "y", "z"], 5, leaf=50)
        sizes = [r["n"] for r in tree.blocks.select("n").collect()]
        assert sum(sizes) == n and max(sizes) <= 50
        radius = (5 / n) ** (1 / 3)
        ask = df.limit(50).withColumns({"key": F.monotonically_increasing_id().cast("string"), "limit": F.lit(radius)})
        visits.append(neighbours.leaf_visits(tree, ask.select("key", "x", "y", "z", "limit"), ["x", "y", "z"], False).count() / 50)
        leaves.append(sum(level.where("is_leaf").count() for level in tree.levels))
    assert leaves[1] > 8 * leaves[0] and visits[1] < 2.5 * visits[0] and visits[1] < leaves[1] / 20


def test_duplicates_by_hashes_are_those_of_full_rows(spark):
    """Copies, nulls that shift (their hashes are equal), signed zeros, NaN, and a hot row."""
    rows = [("a", 1.0, None, 5), ("a", None, 1.0, 5), ("a", 0.0, 2.0, None), ("a", -0.0, 2.0, None), ("b", float("nan"), 1.0, 1), ("b", float("nan"), 1.0, 1), (None, None, None, None), (None, None, None, None)]
    rows += [("b", 3.0, 3.0, 3)] * 500 + [("c", float(i), None, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x double, y double, z int").repartition(4)
    full = df.groupBy(*df.columns).count()
    want = {r["g"]: r["d"] for r in full.groupBy("g").agg(F.sum(F.col("count") - 1).alias("d")).collect()}
    assert {r["g"]: r["duplicates"] for r in cleaning.duplicate_count(df, "g").collect()} == want
    assert cleaning.duplicate_count(df).first()[0] == len(rows) - full.count()
    summary = cleaning.dedup_summary(df).first()
    assert (summary["before"], summary["after"]) == (len(rows), full.count())
    assert cleaning.dedup_summary(df.limit(0)).first()["before"] == 0 and cleaning.duplicate_count(df.limit(0)).first()[0] == 0


def test_knn_leaf_is_one_block(spark):
    """Every pack of queries meets every block of its leaf, so parts of one leaf would multiply the comparisons."""
    df = spark.range(3000).select(F.col("id").cast("double").alias("t"), F.rand(1).alias("x"), F.rand(2).alias("y")).repartition(8)
    tree = neighbours.build_tree(df, ["x", "y"], 5, leaf=200)
    sizes = [r["c"] for r in tree.blocks.groupBy("node").agg(F.count("*").alias("c")).collect()]
    assert set(sizes) == {1} and tree.blocks.agg(F.sum("n")).first()[0] == 3000


def test_knn_draws_from_large_nodes_are_thinned(spark, monkeypatch):
    """The drawn rows are those of smallest hash, and few others are gathered for them."""
    monkeypatch.setattr(neighbours, "SAMPLE", 200)
    rows = spark.range(20_000).select(F.lit(0).cast("long").alias("node"), F.lit(20_000).alias("n"), F.col("id").cast("double").alias("t"), F.rand(3).alias("x"))
    got = sorted(r["x"] for r in neighbours._drawn(rows, ["x"]).collect())
    smallest = rows.orderBy(F.xxhash64("x", "t")).limit(200).collect()
    assert got == sorted(r["x"] for r in smallest)


def test_knn_selects_like_a_full_sort():
    rng = np.random.default_rng(5)
    for holes in (0.0, 0.3):
        q, x = rng.integers(0, 4, (40, 3)).astype(float), rng.integers(0, 4, (300, 3)).astype(float)
        q[rng.random(q.shape) < holes], x[rng.random(x.shape) < holes] = np.nan, np.nan
        donors = np.column_stack([rng.integers(0, 50, 300).astype(float), x])
        for limit in (np.full(40, np.inf), np.full(40, 1.0)):
            at, dist, value = neighbours._near(q, limit, donors, 5)
            d = neighbours.distances(q, x)
            for i in range(40):
                want = sorted((a, b) for a, b in zip(d[i], donors[:, 0]) if a <= limit[i] and np.isfinite(a))[:5]
                assert list(zip(dist[at == i], value[at == i])) == want


def test_spread_bounds_the_rows_of_a_partition(spark):
    """Tightly packed files give few splits; a partition of a fit is bounded by its values."""
    df = durable(spark.range(60_000).select("id", F.lit(1.0).alias("x")).coalesce(1))
    parts = spread(df, cells=8_000).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert sum(r["count"] for r in parts) == 60_000 and max(r["count"] for r in parts) <= 4_500


def test_spread_counts_rows_of_few_columns(spark):
    """A fit caches rows as objects: what a row costs beside its values bounds a narrow table's partitions."""
    df = durable(spark.range(120_000).select(F.lit(1.0).alias("x")).coalesce(1))
    assert spread(df, cells=20_000).rdd.getNumPartitions() >= 60


def test_prepare_deduplicates_once(spark):
    """All steps after the deduplication read its frozen result, so the flows are read by one job."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    rows = spark.range(300).select(F.col("id").cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"), F.when(F.col("id") % 3 == 0, "Bot").otherwise("DDoS").alias("label"), F.lit("f").alias("source_file"))
    flows = rows.mapInPandas(count, rows.schema)
    prepared = batch.prepare(flows, ["a", "b"], "label", "source_file")
    assert prepared.data.count() == 300 and seen.value == 300


def test_home_leaf_meets_no_boxes(spark, monkeypatch):
    """A query's first leaf comes from the cuts, one row a level: also with missing coordinates and beyond all rows."""
    rng = np.random.default_rng(5)
    points = [(float(i), float(a), None if i % 9 == 0 else float(b)) for i, (a, b) in enumerate(rng.normal(size=(3000, 2)))]
    tree = neighbours.build_tree(spark.createDataFrame(points, "t double, x double, y double"), ["x", "y"], 5, leaf=50)
    asked = [(f"q{i}", None if i % 7 == 0 else float(a), None if i % 5 == 0 else float(b), float("inf")) for i, (a, b) in enumerate(3 * rng.normal(size=(200, 2)))]
    ask = spark.createDataFrame(asked + asked[:20], "key string, x double, y double, limit double")  # some keys come twice
    real = neighbours._below

    def root_only(frontier, level, xs):
        assert level is tree.levels[0], "a query met all boxes below a node"
        return real(frontier, level, xs)

    monkeypatch.setattr(neighbours, "_below", root_only)
    found = neighbours.leaf_visits(tree, ask, ["x", "y"], True).collect()
    leaves = {r["node"] for r in tree.blocks.collect()}
    assert sorted(r["key"] for r in found) == sorted(k for k, *_ in asked) and {r["node"] for r in found} <= leaves


def _points(spark, rng, n, prefix):
    """Points with ties and missing coordinates; some lie beyond the others, one has no coordinate."""
    x = np.round(rng.normal(size=(n, 3)), 1) * 10
    x[rng.random(x.shape) < 0.1] = np.nan
    x[0], x[1] = np.nan, [500.0, -500.0, np.nan]
    rows = [(f"{prefix}{i}", float(i % 40), *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return x, spark.createDataFrame(rows, "key string, t double, a double, b double, c double")


def test_knn_bounds_come_with_the_first_leaf(spark, monkeypatch):
    """Keys that do not repeat never become rows of a join of queries with nodes; only those with more leaves travel on."""
    rng, real, searched = np.random.default_rng(11), neighbours._search, []
    x, df = _points(spark, rng, 1500, "d")
    q, ask = _points(spark, rng, 200, "q")

    def refused(*_):
        raise AssertionError("all queries met nodes in a join")

    def watched(tree, visits, *rest):
        searched.append(visits.select("key").distinct().count())
        return real(tree, visits, *rest)

    monkeypatch.setattr(neighbours, "leaf_visits", refused)
    monkeypatch.setattr(neighbours, "_search", watched)
    got = {}
    for r in neighbours.nearest(df, ask, "key", "t", ["a", "b", "c"], 5, leaf=60).collect():
        got.setdefault(r["key"], []).append((r["rank"], r["dist"], r["value"]))
    d, t = neighbours.distances(q, x), np.arange(1500) % 40
    for i in range(200):
        want = sorted((d[i, j], float(t[j])) for j in range(1500) if np.isfinite(d[i, j]))[:5]
        mine = sorted(got.get(f"q{i}", []))
        assert [v for *_, v in mine] == [v for _, v in want] and [e for _, e, _ in mine] == pytest.approx([e for e, _ in want])
    assert "q0" not in got and searched and max(searched) < 200


def test_knn_tree_in_memory_equals_the_tables(spark):
    rng = np.random.default_rng(12)
    names, xs = ["a", "b", "c"], ["_x0", "_x1", "_x2"]
    _, df = _points(spark, rng, 2000, "d")
    q, ask = _points(spark, rng, 150, "q")
    tree = neighbours.build_tree(df.select("t", *[F.col(c).alias(x) for c, x in zip(names, xs)]), xs, 5, leaf=40)
    router = neighbours._router(tree)
    asked = ask.select("key", *[F.col(c).alias(x) for c, x in zip(names, xs)], F.lit(6.0).alias("limit"))
    home = {r["key"]: r["node"] for r in neighbours.leaf_visits(tree, asked, xs, True).collect()}
    assert [home[f"q{i}"] for i in range(150)] == router.home(q).tolist()
    want = {}
    for r in neighbours.leaf_visits(tree, asked, xs, False).collect():
        want.setdefault(r["key"], {})[r["node"]] = r["box"]
    for own in {int(n) for n in router.home(q)}:
        at, leaf, box = router.reached(q, np.full(150, 6.0), own)
        for i in range(150):
            mine = dict(zip(leaf[at == i].tolist(), box[at == i].tolist()))
            others = {n: b for n, b in want.get(f"q{i}", {}).items() if n != own and not np.isnan(q[i]).all()}
            assert mine.keys() == others.keys() and all(mine[n] == pytest.approx(others[n]) for n in mine)


def test_knn_keys_that_repeat_are_searched_as_rows(spark):
    """Rows that share a key, and null keys, find what they found before."""
    rng = np.random.default_rng(13)
    _, df = _points(spark, rng, 800, "d")
    _, ask = _points(spark, rng, 60, "q")
    xs = ["_x0", "_x1", "_x2"]
    ask = ask.union(ask.limit(20)).union(ask.limit(5).withColumn("key", F.lit(None).cast("string"))).localCheckpoint()
    plain = lambda d: d.select("t", "key", *[F.col(c).alias(x) for c, x in zip("abc", xs)], F.lit(float("inf")).alias("limit"))
    tree = neighbours.build_tree(plain(df).select("t", *xs), xs, 5, leaf=40)
    want = neighbours._by_rows(tree, plain(ask).drop("t"), xs, 5, 40).select("key", "rank", "dist", "value")
    got = neighbours.nearest(df, ask, "key", "t", ["a", "b", "c"], 5, leaf=40).select("key", "rank", "dist", "value")
    rows = lambda d: sorted((str(r["key"]), r["rank"], round(r["dist"], 9), r["value"]) for r in d.collect())
    assert rows(got) == rows(want)


def test_bound_on_the_kth_distance_is_never_too_small():
    rng = np.random.default_rng(14)
    for n in (6, 59, 60, 61, 119, 120, 121, 700):
        total = np.round(rng.random((30, n)), 2)
        assert (neighbours._kth_at_most(total, 5) >= np.sort(total, axis=1)[:, 4]).all()
