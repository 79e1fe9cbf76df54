"""Groups that hold a large share of all rows, against brute force."""

import numpy as np
import pandas as pd
import pytest
from layerspark.operators import cells, near, order, picks, select, shape
from layerspark.operators.skew import exact_percentiles, hot_keys
from layerspark.streaming.throttling import throttle
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of the rows in one cell, a tenth of them with one value."""
    rng = np.random.default_rng(5)
    n = 6_000
    cell = np.where(rng.random(n) < 0.34, 7, rng.integers(0, 40, n))
    value = np.where(rng.random(n) < 0.1, 42.0, rng.normal(0, 1000, n).round(3))
    value[::97] = np.nan
    pdf = pd.DataFrame({"cell": cell, "value": value})
    return pdf, spark.createDataFrame(pdf).repartition(6)


@pytest.mark.parametrize("limit, accuracy", [(1_000_000, 100_000), (500, 200), (50, 50), (5, 100_000)])
def test_percentiles_are_exact_for_hot_groups(crowded, limit, accuracy):
    pdf, df = crowded
    probs = [0.9, 0.1, 0.5, 0.0, 1.0]
    names = ["p90", "p10", "p50", "p0", "p100"]
    got = exact_percentiles(df, ["cell"], "value", probs, names, limit, accuracy).toPandas().set_index("cell")
    want = pdf.dropna().groupby("cell")["value"].quantile(probs).unstack()
    assert len(got) == len(want)
    for p, name in zip(probs, names, strict=True):
        np.testing.assert_allclose(got[name].sort_index(), want[p].sort_index(), rtol=1e-12)


@pytest.mark.parametrize("limit", [1_000_000, 100])
def test_global_percentiles(crowded, limit):
    pdf, df = crowded
    row = exact_percentiles(df, [], "value", [0.02, 0.98], ["lo", "hi"], limit).first()
    want = np.nanpercentile(pdf["value"], [2, 98])
    np.testing.assert_allclose([row["lo"], row["hi"]], want, rtol=1e-12)


def test_rollup_with_a_hot_cell(crowded):
    pdf, df = crowded
    got = cells.cell_rollup(df, "cell", "value", group_rows=300).toPandas().set_index("cell").sort_index()
    groups = pdf.dropna().groupby("cell")["value"]
    np.testing.assert_allclose(got["mean"], groups.mean(), rtol=1e-9)
    np.testing.assert_allclose(got["std"], groups.std(ddof=0), rtol=1e-9)
    np.testing.assert_allclose(got["p10"], groups.quantile(0.1), rtol=1e-12)
    assert got["count"].tolist() == groups.count().tolist()


def test_hot_keys(crowded):
    pdf, df = crowded
    assert [r["cell"] for r in hot_keys(df, ["cell"], 1_000).collect()] == [7]
    assert hot_keys(df, ["cell"], 10_000) is None


@pytest.mark.parametrize("most", [2, 3, 10, 4_000])
def test_long_paths_are_cut_and_stay_whole(spark, most):
    rows = [(1 if i % 3 == 0 else 2 + i % 50, i, float(i % 170), float(i % 80)) for i in range(3_000)]
    df = spark.createDataFrame(rows, "path long, t long, lon double, lat double").repartition(5)
    paths = shape.path_from_vertices(df, "path", ["t"], max_vertices=most).collect()
    want = {}
    for path, _, lon, lat in sorted(rows, key=lambda r: (r[0], r[1])):
        want.setdefault(path, []).append([lon, lat])
    for path, vertices in want.items():
        parts = sorted((r for r in paths if r["path"] == path), key=lambda r: r["part"])
        assert [r["part"] for r in parts] == list(range(len(parts)))
        joined = list(parts[0]["geometry"])
        for before, after in zip(parts, parts[1:], strict=False):
            assert before["geometry"][-1] == after["geometry"][0]
            joined += after["geometry"][1:]
        assert joined == vertices
        assert all(2 <= len(r["geometry"]) <= most for r in parts)


def brute_nearest(points, features, radius):
    out = {}
    f = features.dropna()
    for pid, lon, lat in points.itertuples(index=False):
        dlat, dlon = np.radians(f["lat"] - lat) / 2, np.radians(f["lon"] - lon) / 2
        a = np.sin(dlat) ** 2 + np.cos(np.radians(lat)) * np.cos(np.radians(f["lat"])) * np.sin(dlon) ** 2
        d = 2 * 6371008.8 * np.arcsin(np.sqrt(np.minimum(a, 1)))
        d = pd.Series(d.to_numpy(), index=f["feature_id"]).sort_index()
        if len(d) and d.min() <= radius:
            out[pid] = (d.idxmin(), d.min())
    return out


def nearest_fixture(seed, lon0, lat0, spread):
    """Features: a third in a tight cluster, a third copies of one place, the rest spread."""
    rng = np.random.default_rng(seed)
    n = 900
    lon, lat = lon0 + rng.uniform(-spread, spread, n), lat0 + rng.uniform(-spread, spread, n)
    lon[:300] = lon0 + rng.normal(0, spread / 500, 300)
    lat[:300] = lat0 + rng.normal(0, spread / 500, 300)
    lon[300:600], lat[300:600] = lon0 + spread / 3, lat0
    lon = (lon + 180) % 360 - 180
    features = pd.DataFrame({"feature_id": rng.permutation(n), "lon": lon, "lat": np.clip(lat, -90, 90)})
    m = 300
    plon = lon0 + np.where(np.arange(m) % 3 == 0, rng.normal(0, spread / 300, m), rng.uniform(-spread, spread, m))
    plat = np.clip(lat0 + rng.uniform(-spread, spread, m), -90, 90)
    points = pd.DataFrame({"point_id": np.arange(m), "lon": (plon + 180) % 360 - 180, "lat": plat})
    return points, features


@pytest.mark.parametrize(
    "place, spread, radius, cell_rows",
    [
        ((10.0, 50.0), 0.1, 2_000.0, 10_000),
        ((10.0, 50.0), 0.1, 2_000.0, 8),
        ((180.0, 0.0), 0.05, 3_000.0, 4),
        ((0.0, 89.9), 0.1, 5_000.0, 8),
        ((-70.0, -35.0), 5.0, 900_000.0, 8),
    ],
)
def test_nearest_feature_equals_brute_force(spark, place, spread, radius, cell_rows):
    points, features = nearest_fixture(3, *place, spread)
    got = picks.nearest_feature(
        spark.createDataFrame(points), spark.createDataFrame(features).repartition(4), radius, cell_rows=cell_rows
    ).collect()
    want = brute_nearest(points, features, radius)
    assert len(got) == len(want)
    for row in got:
        feature, distance = want[row["point_id"]]
        assert row["distance_m"] == pytest.approx(distance, abs=1e-4)
        assert row["feature_id"] == feature or row["distance_m"] == pytest.approx(distance, abs=1e-7)


def test_nearest_feature_equals_brute_force_in_small_blocks(spark):
    radius = 3_000.0
    points, features = nearest_fixture(5, 180.0, 0.0, 0.05)
    got = picks.nearest_feature(
        spark.createDataFrame(points),
        spark.createDataFrame(features).repartition(4),
        radius,
        cell_rows=2,
        block_places=60,
        block_points=30,
    ).collect()
    want = brute_nearest(points, features, radius)
    assert len(got) == len(want)
    for row in got:
        feature, distance = want[row["point_id"]]
        assert row["distance_m"] == pytest.approx(distance, abs=1e-4)
        assert row["feature_id"] == feature or row["distance_m"] == pytest.approx(distance, abs=1e-7)


def test_nearest_feature_sends_few_points_beyond_their_block(spark, monkeypatch):
    """Cells far smaller than the gaps between places: points once met about ten cells at each level."""
    sent = []
    others = near.Blocks.others

    def counted(self, points):
        out = others(self, points)
        sent.append((points.count(), out.count(), len(self.crowded)))
        return out

    monkeypatch.setattr(near.Blocks, "others", counted)
    rng = np.random.default_rng(1)
    spots = rng.uniform(0, 0.1, (8_000, 2))
    features = pd.DataFrame({"feature_id": np.arange(4_000), "lon": spots[:4_000, 0], "lat": spots[:4_000, 1]})
    points = pd.DataFrame({"point_id": np.arange(4_000), "lon": spots[4_000:, 0], "lat": spots[4_000:, 1]})
    layer = spark.createDataFrame(features)
    got = picks.nearest_feature(
        spark.createDataFrame(points), layer, 500.0, cell_rows=1, max_levels=4, block_places=1_000
    ).collect()
    want = brute_nearest(points, features, 500.0)
    assert {r["point_id"]: r["feature_id"] for r in got} == {p: f for p, (f, _) in want.items()}
    (asked, more, splits), = sent
    assert asked == 4_000 and splits > 0 and more < asked / 2


def test_nearest_feature_deals_rows_to_tasks_by_number(spark, monkeypatch):
    """The tasks that search follow the rows, not the session's partitions or the bytes of the shuffle."""
    monkeypatch.setattr(near, "TASK_ROWS", 100, raising=False)
    tasks, write = {}, picks.materialize

    def counted(df, name):
        out = write(df, name)
        tasks[name] = df.rdd.getNumPartitions()
        return out

    monkeypatch.setattr(picks, "materialize", counted)
    points, features = nearest_fixture(7, 10.0, 50.0, 0.1)
    layer = spark.createDataFrame(features)
    got = picks.nearest_feature(spark.createDataFrame(points), layer, 2_000.0, block_places=60, block_points=30)
    want = brute_nearest(points, features, 2_000.0)
    assert {r["point_id"]: r["feature_id"] for r in got.collect()} == {p: f for p, (f, _) in want.items()}
    # 300 points and 601 places.
    assert tasks["near"] >= 9


def greedy(rows, interval):
    kept, until = [], {}
    for key, t, event in sorted(rows):
        if t >= until.get(key, -1):
            kept.append(event)
            until[key] = t + interval
    return sorted(kept)


@pytest.mark.parametrize("run_rows", [1, 2, 7, 40, 100_000])
def test_throttle_equals_the_sequential_rule(spark, run_rows):
    rng = np.random.default_rng(11)
    n = 1_500
    key = np.where(rng.random(n) < 0.4, 1, rng.integers(0, 12, n))
    t = np.where(key == 1, rng.integers(0, 40_000, n), rng.integers(0, 900_000, n))
    t[rng.random(n) < 0.1] = 12_000
    rows = [(int(k), int(ms) * 1000, i) for i, (k, ms) in enumerate(zip(key, t, strict=True))]
    df = spark.createDataFrame(rows, "session long, us long, event_id long").repartition(5)
    df = df.withColumn("ts", F.timestamp_micros("us"))
    got = throttle(df, ["session"], 200, run_rows=run_rows)
    assert sorted(r["event_id"] for r in got.collect()) == greedy(rows, 200_000)
    assert got.columns == df.columns


def test_row_index_over_many_partitions(spark):
    df = spark.range(10_000).select((F.col("id") * 7919 % 10007).alias("feature_id"), (F.col("id") % 3).alias("g"))
    ids = sorted(r["feature_id"] for r in df.collect())
    got = {r["feature_id"]: r["row_index"] for r in order.row_index(df, partitions=13).collect()}
    assert [got[i] for i in ids] == list(range(10_000))
    within = order.row_index(df, ["g", "feature_id"], partitions=13, within=["g"]).toPandas()
    for _, part in within.groupby("g"):
        assert part.sort_values("feature_id")["row_index"].tolist() == list(range(len(part)))


def test_declutter_keeps_one_per_crowded_cell(spark):
    df = spark.range(5_000).select(
        F.col("id").alias("feature_id"),
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") % 100).cast("double").alias("lon"),
        F.lit(0.5).alias("lat"),
        (F.col("id") % 10).cast("double").alias("rank"),
    )
    kept = select.declutter(df, 1.0, "rank")
    assert kept.count() == 100
    assert kept.where("lon = 0.5").first()["feature_id"] == 9


def test_overfull_join_partitions_are_split(spark):
    """AQE splits the partition of a hot cell; nothing is broadcast or gathered for it."""
    old = {
        k: spark.conf.get(k)
        for k in (
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.autoBroadcastJoinThreshold",
        )
    }
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "100KB")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100KB")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        features = spark.range(0, 400_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("cell_id"), F.rand(1).alias("v")
        )
        stats = spark.range(400_000).select(F.col("id").alias("cell_id"), F.lit(1.0).alias("mean"))
        joined = cells.attach_stats(features, stats)
        assert len(joined.collect()) == 400_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
