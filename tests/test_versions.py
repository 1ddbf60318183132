"""Layer versions: a failed write changes nothing, a partial rebuild touches its partitions only."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from salesflow.session import scratch_path
from salesflow.sources import versions


def rows(spark, *data):
    return spark.createDataFrame(list(data), "id bigint, year int, month int")


def got(df):
    return sorted(tuple(r) for r in df.collect())


def files(df):
    return sorted(df.inputFiles())


def test_rebuild_keeps_old_versions_readable(spark):
    root = scratch_path(spark, "layer")
    versions.write_version(rows(spark, (1, 2024, 1)), root)
    versions.write_version(rows(spark, (2, 2024, 1), (3, 2024, 1)), root)
    assert got(versions.read_layer(spark, root)) == [(2, 2024, 1), (3, 2024, 1)]
    assert got(versions.read_layer(spark, root, 1)) == [(1, 2024, 1)]
    with pytest.raises(ValueError, match="no version 9"):
        versions.read_layer(spark, root, 9)
    with pytest.raises(ValueError, match="no layer"):
        versions.read_layer(spark, scratch_path(spark, "layer"))


@pytest.mark.parametrize("partition_by", [(), ("year", "month")])
def test_write_killed_half_way_leaves_the_old_layer(spark, partition_by):
    root = scratch_path(spark, "layer")
    old = [(i, 2024, i % 3 + 1) for i in range(9)]
    versions.write_version(rows(spark, *old), root, partition_by)
    broken = spark.range(1000, numPartitions=8).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("bigint").alias("id"),
        F.lit(2024).alias("year"), F.lit(1).alias("month"))
    with pytest.raises(Exception, match="killed"):
        versions.write_version(broken, root, partition_by)
    assert got(versions.read_layer(spark, root)) == old
    # written whole, but not committed
    versions.stage(rows(spark, (77, 2024, 1)), root, partition_by)
    assert got(versions.read_layer(spark, root)) == old
    assert len(versions.vacuum(spark, root, older_than_s=-5)) == (1 if partition_by else 2)  # one died before its first file
    assert got(versions.read_layer(spark, root)) == old


def test_partial_rebuild_writes_its_partitions_only(spark):
    root, by = scratch_path(spark, "layer"), ("year", "month")
    versions.write_version(rows(spark, (1, 2024, 1), (2, 2024, 2), (3, 2025, 1), (4, None, 1)), root, by)
    before = files(versions.read_layer(spark, root))
    versions.write_version(rows(spark, (20, 2024, 2), (21, 2024, 2)), root, by, "partitions")
    layer = versions.read_layer(spark, root)
    assert sorted(got(layer), key=str) == sorted([(1, 2024, 1), (20, 2024, 2), (21, 2024, 2), (3, 2025, 1), (4, None, 1)], key=str)
    kept = [f for f in before if "year=2024/month=2" not in f]
    assert set(kept) < set(files(layer)) and len(kept) == len(before) - 1
    # a partition without rows any more goes
    versions.write_version(rows(spark), root, by, "partitions", ["year=2025/month=1"])
    assert sorted(r.id for r in versions.read_layer(spark, root).collect()) == [1, 4, 20, 21]
    plan = versions.read_layer(spark, root).where("year = 2024 AND month = 2")
    assert plan.count() == 2 and "PartitionFilters: [isnotnull(year" in plan._jdf.queryExecution().executedPlan().toString()


def test_partial_rebuild_must_fit_the_layer(spark):
    root = scratch_path(spark, "layer")
    versions.write_version(rows(spark, (1, 2024, 1)), root, ("year",))
    with pytest.raises(ValueError, match="partitioned by"):
        versions.write_version(rows(spark, (1, 2024, 1)), root, ("month",), "partitions")
    with pytest.raises(ValueError, match="columns"):
        versions.write_version(rows(spark, (1, 2024, 1)).withColumn("x", F.lit(1)), root, ("year",), "partitions")
    with pytest.raises(ValueError, match="partitioned layer"):
        versions.write_version(rows(spark, (1, 2024, 1)), root, (), "partitions")


def test_layers_without_rows(spark):
    for by in ((), ("year",)):
        root = scratch_path(spark, "layer")
        layer = versions.write_version(rows(spark), root, by)
        assert layer.collect() == [] and layer.columns == ["id", "year", "month"]


def test_two_writers_at_once_both_commit(spark):
    root, by = scratch_path(spark, "layer"), ("month",)
    versions.write_version(rows(spark, (0, 2024, 0)), root, by)
    staged = [versions.stage(rows(spark, (m, 2024, m)), root, by) for m in range(1, 7)]
    threads = [threading.Thread(target=s.publish, args=("partitions",)) for s in staged]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(r.id for r in versions.read_layer(spark, root).collect()) == list(range(7))
    assert versions.read_manifest(spark, root)[0] == 7


def test_a_number_is_taken_once(spark):
    root = scratch_path(spark, "log")
    assert versions._take(spark, root, 1, {"a": 1}) and not versions._take(spark, root, 1, {"a": 2})
    assert versions.read_manifest(spark, root) == (1, {"a": 1})
    assert versions.commit(spark, root, lambda last: None) == 1


def test_vacuum_keeps_what_the_last_manifests_name(spark):
    root = scratch_path(spark, "layer")
    for i in range(4):
        versions.write_version(rows(spark, (i, 2024, 1)), root)
    assert versions.vacuum(spark, root, keep=2) == []  # too young
    assert len(versions.vacuum(spark, root, keep=2, older_than_s=-5)) == 2
    assert got(versions.read_layer(spark, root, 3)) == [(2, 2024, 1)]
    assert got(versions.read_layer(spark, root)) == [(3, 2024, 1)]
    local = root.replace("file:", "")
    assert sorted(n for n in os.listdir(f"{local}/_manifests") if n.endswith(".json")) == ["000000000003.json", "000000000004.json"]


@pytest.mark.parametrize("by", [(), ("year", "month")])
def test_compaction_changes_no_row_and_bounds_the_files(spark, by):
    root = scratch_path(spark, "landing")
    for i in range(12):
        df = rows(spark, *[(100 * i + k, 2024 if k % 2 else None, k % 3) for k in range(9)], (1, 2024, 1)).repartition(3)
        versions.append_batch(df, root, "s", i, by)
        versions.append_batch(df, root, "s", i, by)  # replayed
    layer = versions.read_layer(spark, root)
    before, n_files = sorted(map(str, layer.collect())), len(layer.inputFiles())
    assert len(before) == 120
    total = sum(os.path.getsize(f.replace("file://", "")) for f in layer.inputFiles())
    target = total // 4
    assert versions.compact(spark, root, target) > 8
    after = versions.read_layer(spark, root)
    assert sorted(map(str, after.collect())) == before
    n_parts = len({f.rsplit("/", 1)[0].split("layer_version=")[1].partition("/")[2] for f in after.inputFiles()})
    assert len(after.inputFiles()) <= 2 * 4 + n_parts < n_files
    assert sorted(map(str, layer.collect())) == before  # a reader of the manifest before
    # appends go on, and a batch that was packed is still known
    versions.append_batch(rows(spark, (5, 2024, 1)), root, "s", 11, by)
    versions.append_batch(rows(spark, (6, 2024, 1)), root, "s", 12, by)
    assert versions.read_layer(spark, root).count() == 121


def test_compaction_that_dies_or_is_overtaken_is_harmless(spark, monkeypatch):
    root = scratch_path(spark, "landing")
    for i in range(4):
        versions.append_batch(rows(spark, (i, 2024, 1)), root, "s", i)
    publish = versions.Staged.publish

    def dies(self, *a, **k):
        raise RuntimeError("killed")

    monkeypatch.setattr(versions.Staged, "publish", dies)
    with pytest.raises(RuntimeError, match="killed"):
        versions.compact(spark, root)
    assert sorted(r.id for r in versions.read_layer(spark, root).collect()) == [0, 1, 2, 3]

    def overtaken(self, *a, **k):
        monkeypatch.setattr(versions.Staged, "publish", publish)
        versions.append_batch(rows(spark, (9, 2024, 1)), root, "s", 9)
        return publish(self, *a, **k)

    monkeypatch.setattr(versions.Staged, "publish", overtaken)
    assert versions.compact(spark, root) == 4
    assert sorted(r.id for r in versions.read_layer(spark, root).collect()) == [0, 1, 2, 3, 9]
    assert len(versions.read_manifest(spark, root)[1]["parts"][""]) == 2

    def replaced(self, *a, **k):
        monkeypatch.setattr(versions.Staged, "publish", publish)
        versions.write_version(rows(spark, (50, 2024, 1)), root)
        return publish(self, *a, **k)

    monkeypatch.setattr(versions.Staged, "publish", replaced)
    with pytest.raises(RuntimeError, match="replaced meanwhile"):
        versions.compact(spark, root)
    assert [r.id for r in versions.read_layer(spark, root).collect()] == [50]
    assert versions.compact(spark, root) == 0


def test_bins():
    sizes = {f"f{i}": s for i, s in enumerate([5, 9, 1, 1, 3, 2, 8, 10, 4])}
    packed = versions.bins(sizes, 10)
    assert sorted(n for b in packed for n in b) == sorted(sizes)
    assert all(sum(sizes[n] for n in b) <= 10 for b in packed) and len(packed) == 5
    assert versions.bins({"a": 30, "b": 1}, 10) == [["a"], ["b"]]
