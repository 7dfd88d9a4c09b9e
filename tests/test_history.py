import pytest

from lakeloom.operators.changes import read_changes, snapshot_changes
from lakeloom.operators.history import current_rows, read_history, run_label, snapshot, snapshot_table
from lakeloom.session import remove_folder, settle
from tests.conftest import rows

COLS = ["id", "glass", "dbt_valid_from", "dbt_valid_to"]


def run(spark, history, data, at):
    source = spark.createDataFrame(data, "id string, glass string")
    return settle(snapshot(history, source, "id", ["glass"], at))


def shown(df):
    return rows(df.selectExpr("id", "glass", "string(dbt_valid_from)", "string(dbt_valid_to)"))


def day(n):
    return f"2025-05-0{n} 00:00:00"


def test_four_runs(spark):
    h = run(spark, None, [("1", "Mug"), ("2", "Jar"), ("3", None)], day(1))
    assert shown(h) == [("1", "Mug", day(1), None), ("2", "Jar", day(1), None), ("3", None, day(1), None)]

    # 1 changes, 2 leaves, 3 stays null, 4 is new
    h = run(spark, h, [("1", "Cup"), ("3", None), ("4", "Pot")], day(2))
    second = [
        ("1", "Cup", day(2), None),
        ("1", "Mug", day(1), day(2)),
        ("2", "Jar", day(1), day(2)),
        ("3", None, day(1), None),
        ("4", "Pot", day(2), None),
    ]
    assert shown(h) == sorted(second, key=repr)

    # nothing changes, run twice
    for at in (day(2), day(3)):
        h = run(spark, h, [("1", "Cup"), ("3", None), ("4", "Pot")], at)
        assert shown(h) == sorted(second, key=repr)

    # 2 comes back, 3 gets a value, 1 goes back to what it was
    h = run(spark, h, [("1", "Mug"), ("2", "Jar"), ("3", "X"), ("4", "Pot")], day(4))
    assert shown(current_rows(h)) == [
        ("1", "Mug", day(4), None),
        ("2", "Jar", day(4), None),
        ("3", "X", day(4), None),
        ("4", "Pot", day(2), None),
    ]
    assert h.count() == 8
    assert h.select("dbt_scd_id").distinct().count() == 8


@pytest.mark.parametrize("data", [[("1", "Mug"), ("1", "Jar")], [("1", "Mug"), ("1", "Mug")], [(None, "Mug")]])
def test_repeated_or_missing_key_fails(spark, data):
    source = spark.createDataFrame(data, "id string, glass string")
    with pytest.raises(Exception, match="missing or repeated"):
        snapshot(None, source, "id", ["glass"], day(1)).collect()


def test_empty_source_closes_everything(spark):
    h = run(spark, None, [("1", "Mug")], day(1))
    h = run(spark, h, [], day(2))
    assert shown(h) == [("1", "Mug", day(1), day(2))]


RUNS = [
    (day(1), [("1", "Mug"), ("2", "Jar"), ("3", None)]),
    (day(2), [("1", "Cup"), ("3", None), ("4", "Pot")]),
    (day(3), [("1", "Mug"), ("2", "Jar"), ("3", "X"), ("4", "Pot")]),
    (day(4), []),
    (day(5), [("4", "Pot")]),
]


def test_history_on_disk_equals_history_in_memory(spark, tmp_path):
    path, memory = str(tmp_path / "h"), None
    for at, data in RUNS:
        source = spark.createDataFrame(data, "id string, glass string")
        for _ in range(2):  # each run is done twice
            snapshot_table(source, path, "id", ["glass"], at)
        memory = run(spark, memory, data, at)
        assert shown(read_history(spark, path)) == shown(memory)


def test_history_on_disk_leaves_closed_rows_alone(spark, tmp_path):
    path = tmp_path / "h"
    for at, data in RUNS[:3]:
        snapshot_table(spark.createDataFrame(data, "id string, glass string"), str(path), "id", ["glass"], at)
    files = {p: p.stat().st_mtime_ns for p in (path / "closed").rglob("*.parquet")}
    assert files
    at, data = RUNS[3]
    snapshot_table(spark.createDataFrame(data, "id string, glass string"), str(path), "id", ["glass"], at)
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())


def test_unfinished_run_does_not_show(spark, tmp_path):
    path = str(tmp_path / "h")
    for at, data in RUNS[:2]:
        snapshot_table(spark.createDataFrame(data, "id string, glass string"), path, "id", ["glass"], at)
    before = shown(read_history(spark, path))
    # what a run that died before it was done leaves behind
    for part in ("open", "closed"):
        spark.read.parquet(f"{path}/open/run={run_label(day(2))}").write.parquet(f"{path}/{part}/run={run_label(day(3))}")
    assert shown(read_history(spark, path)) == before
    at, data = RUNS[2]
    snapshot_table(spark.createDataFrame(data, "id string, glass string"), path, "id", ["glass"], at)
    assert {r[0] for r in shown(current_rows(read_history(spark, path)))} == {"1", "2", "3", "4"}


@pytest.mark.parametrize("fold_every", [1, 2, 32])
def test_base_and_changes_equal_history_in_memory(spark, tmp_path, fold_every):
    path, memory = str(tmp_path / "h"), None
    for at, data in RUNS:
        source = spark.createDataFrame(data, "id string, glass string")
        for _ in range(2):  # each run is done twice
            snapshot_changes(source, path, "id", ["glass"], at, fold_every)
        memory = run(spark, memory, data, at)
        assert shown(read_changes(spark, path)) == shown(memory)


def test_a_run_writes_what_changed(spark, tmp_path):
    path = str(tmp_path / "h")
    source = spark.range(20_000).selectExpr("cast(id as string) id", "'Mug' glass")
    changed = source.selectExpr("id", "case when cast(id as int) % 1000 = 7 then 'Jar' else glass end glass").where("id <> '5'")
    snapshot_changes(source, path, "id", ["glass"], day(1))
    snapshot_changes(changed, path, "id", ["glass"], day(2))
    label = run_label(day(2))
    written = {part: spark.read.parquet(f"{path}/{part}/run={label}").count() for part in ("opened", "closed")}
    assert written == {"opened": 20, "closed": 21}
    assert [p.name for p in (tmp_path / "h" / "base").iterdir()] == [f"run={run_label(day(1))}"]
    assert current_rows(read_changes(spark, path)).count() == 19_999


def test_unfinished_changes_do_not_show(spark, tmp_path):
    path = str(tmp_path / "h")
    for at, data in RUNS[:2]:
        snapshot_changes(spark.createDataFrame(data, "id string, glass string"), path, "id", ["glass"], at)
    before = shown(read_changes(spark, path))
    at, data = RUNS[2]
    snapshot_changes(spark.createDataFrame(data, "id string, glass string"), path, "id", ["glass"], at)
    remove_folder(spark, f"{path}/done/run={run_label(at)}")
    assert shown(read_changes(spark, path)) == before
