"""Layer rows stored with their index."""

import pytest
from layerspark.operators.picks import hover_rows, lookup_rows, resolve_picks
from layerspark.plans import fixtures as fx
from layerspark.plans.queries import registry
from layerspark.sinks import StoredRows, write_rows
from plan_text import plan_of
from pyspark.sql import functions as F

ORDER = ["layer_id", "batch_id", "feature_id"]
SCHEMA = "layer_id string, batch_id long, feature_id long, name string"


def numbered(rows):
    """Index of each row within its layer, by the definition."""
    out, seen = {}, {}
    for layer, batch, feature, name in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out[layer, seen.setdefault(layer, 0)] = (batch, feature, name)
        seen[layer] += 1
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_lookup_equals_numbering(spark, tmp_path, partitions):
    # One layer holds most rows, so it spans many slices; the others share one.
    rows = [("big", i // 100, i * 7 % 1000, f"n{i}") for i in range(1000)] + [("a", 0, 5, "x"), ("z", 3, 1, "y")]
    stored = write_rows(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "l"), ORDER, partitions=partitions)
    want = numbered(rows)
    got = {(r.layer_id, r.row_index): (r.batch_id, r.feature_id, r.name) for r in stored.indexed().collect()}
    assert got == want
    asked = [("big", i) for i in range(-2, 1003, 3)] + [("a", 0), ("a", 1), ("none", 0), ("z", 0), (None, 1), ("big", None)]
    picks = spark.createDataFrame([(i, *a) for i, a in enumerate(asked)], "event long, layer_id string, row_index long")
    found = {r.event: (r.batch_id, r.feature_id, r.name) for r in lookup_rows(picks, stored).collect()}
    assert found == {i: want[a] for i, a in enumerate(asked) if a in want}
    sub = {(r.layer_id, r.batch_id): (r.sub_layer_id, r.num_rows, r.row_offset) for r in stored.sub_layers().collect()}
    assert sub["big", 3] == ("big-3", 100, 300) and sub["z", 3] == ("z-3", 1, 0) and len(sub) == 12


def test_same_picks_twice_and_repeated_rows(spark, tmp_path):
    rows = [("l", 0, 1, "same")] * 5
    stored = write_rows(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "l"), ORDER)
    picks = spark.createDataFrame([("l", 4), ("l", 4), ("l", 5)], "layer_id string, row_index long")
    assert [r.name for r in lookup_rows(picks, stored).collect()] == ["same", "same"]


def test_empty_layer_and_no_batches(spark, tmp_path):
    empty = write_rows(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"), ORDER)
    picks = spark.createDataFrame([("l", 0)], "layer_id string, row_index long")
    assert lookup_rows(picks, empty).count() == 0 and empty.sub_layers().count() == 0
    plain = spark.createDataFrame([("l", 3), ("l", 1), ("m", 2)], "layer_id string, feature_id long")
    stored = write_rows(plain, str(tmp_path / "p"), ["layer_id", "feature_id"], batch=None)
    assert [r.feature_id for r in lookup_rows(picks, stored).collect()] == [1]
    with pytest.raises(ValueError):
        stored.sub_layers()
    with pytest.raises(ValueError):
        write_rows(plain, str(tmp_path / "q"), ["feature_id"], batch=None)
    with pytest.raises(ValueError):
        lookup_rows(picks, stored, how="left")


def test_only_columns_and_slices_asked_for_are_read(spark, sf, tmp_path):
    stored = write_rows(fx.layer_parts(spark, sf), str(tmp_path / "l"), ORDER, partitions=20)
    picks = spark.createDataFrame([("layer-1", 7)], "layer_id string, row_index long")
    out = hover_rows(picks, stored, ["name"])
    plan = plan_of(out)
    assert "rangepartitioning" not in plan and "dynamicpruning" in plan
    assert "category" not in plan
    assert out.count() == 1


def test_queries_number_nothing(spark, sf):
    """The registered lookups read the stored index."""
    for name in ("lookup_rows", "hover_rows", "picks_to_rows"):
        plan = plan_of(registry()[name](spark, sf))
        assert "rangepartitioning" not in plan and "layer_rows" in plan, name


def test_reopened_by_path(spark, sf, tmp_path):
    write_rows(fx.layer_parts(spark, sf), str(tmp_path / "l"), ORDER)
    stored = StoredRows(spark, str(tmp_path / "l"))
    picked = fx.interactions(spark, sf).where("kind = 'clicked'")
    new = lookup_rows(resolve_picks(picked, stored.sub_layers()), stored)
    old = lookup_rows(resolve_picks(picked, fx.sub_layers(spark, sf)), fx.indexed_layer(spark, sf))
    columns = ["event_id", "layer_id", "row_index", "feature_id", "batch_id"]
    assert sorted(map(tuple, new.select(columns).collect())) == sorted(map(tuple, old.select(columns).collect()))
    assert new.filter(F.col("name").isNull()).count() == 0
