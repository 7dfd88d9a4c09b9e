import pytest
from pyspark.sql import types as T

from lakeloom.operators import quality as Q
from lakeloom.plans import contracts
from lakeloom.sinks import publish as S
from tests.conftest import plan_text, rows


def checked(df, checks, parents=None):
    return {(r["check"], r["column"]): (r.failures, r.status) for r in Q.run_checks(df, checks, parents).collect()}


CHECKS = [
    Q.NotNull("id"),
    Q.Unique("id"),
    Q.Unique("id", "kind"),
    Q.Accepted("kind", ("a", "b")),
    Q.Between("n", -90, 90),
    Q.Related("fk", "parent", "key"),
]


def test_good_rows_pass(spark):
    df = spark.createDataFrame(
        [(1, "a", 90.0, 1), (2, None, -90.0, None), (3, "b", None, 1)], "id int, kind string, n double, fk int"
    )
    parent = spark.createDataFrame([(1,), (1,), (None,)], "key int")
    got = checked(df, CHECKS, {"parent": parent})
    assert set(got.values()) == {(0, "pass")} and len(got) == 6


def test_each_check_fails_on_its_bad_rows(spark):
    df = spark.createDataFrame(
        [(None, "a", 0.0, 1), (1, "c", 90.5, 2), (1, "c", -91.0, 2), (1, "d", 1.0, 3), (2, "a", 1.0, None)],
        "id int, kind string, n double, fk int",
    )
    parent = spark.createDataFrame([(1,)], "key int")
    assert checked(df, CHECKS, {"parent": parent}) == {
        ("not_null", "id"): (1, "fail"),
        ("unique", "id"): (1, "fail"),
        ("unique_combination", "id,kind"): (1, "fail"),
        ("accepted_values", "kind"): (3, "fail"),
        ("between", "n"): (2, "fail"),
        ("relationships", "fk"): (3, "fail"),
    }


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "id int, kind string, n double, fk int")
    assert set(checked(df, CHECKS, {"parent": df.selectExpr("fk as key")}).values()) == {(0, "pass")}


def test_row_checks_share_one_pass(spark):
    df = spark.range(10).selectExpr("id", "id as n")
    text = plan_text(Q.run_checks(df, [Q.NotNull("id"), Q.Between("n", 0, 5), Q.Accepted("n", (1, 2))]))
    assert text.count("Range (") == 1


def test_catalogue_covers_every_kind():
    kinds = {}
    for checks in contracts.CHECKS.values():
        for c in checks:
            name = type(c).__name__ if not isinstance(c, Q.Unique) else f"Unique{min(len(c.columns), 2)}"
            kinds[name] = kinds.get(name, 0) + 1
    assert kinds == {"NotNull": 17, "Unique1": 15, "Unique2": 7, "Related": 4, "Accepted": 4, "Between": 6}
    assert len(contracts.CONTRACTS) == 2 and len(contracts.FRESHNESS) == 3


def test_contract(spark):
    contract = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    good = spark.sql("select 'x' as NAME, 1L as id")
    assert Q.enforce_contract(good, contract).columns == ["id", "name"]
    for bad in ("select 1L id", "select 1L id, 'x' name, 2 more", "select 1 id, 'x' name"):
        with pytest.raises(Q.ContractError):
            Q.enforce_contract(spark.sql(bad), contract)


def test_publish_versions(spark, tmp_path):
    one = S.publish(spark.range(3), str(tmp_path), "base", "t", "1")
    S.publish(spark.range(5), str(tmp_path), "base", "t", "2")
    assert S.published(spark, "base", "t").count() == 5
    assert one.count() == 3  # readers of the version before are not disturbed
    S.publish(spark.range(4), str(tmp_path), "base", "t", "2")
    assert S.published(spark, "base", "t").count() == 4


def test_publish_keeps_to_the_contract(spark, tmp_path):
    contract = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(Q.ContractError):
        S.publish(spark.range(1), str(tmp_path), "base", "t", "1", contract)
    assert not (tmp_path / "base").exists()


def test_view_and_empty_input(spark):
    S.publish_view(spark.range(2), "staging", "v")
    assert rows(S.published(spark, "staging", "v")) == [(0,), (1,)]
    assert S.require_rows(spark.range(1), "t").count() == 1
    with pytest.raises(S.EmptyInput):
        S.require_rows(spark.range(0), "t")


def test_listed_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3), ("b", None)], "k string, n int")
    assert [tuple(r) for r in S.listed(df, "k", "n").collect()] == [("b", 3), ("b", None), ("a", 1), (None, 2)]


def test_publish_sorted(spark, tmp_path):
    df = spark.createDataFrame([(i % 7,) for i in range(50)], "n int").repartition(3)
    S.publish(df, str(tmp_path), "base", "s", "1", sort_by=("n",))
    for part in spark.read.parquet(str(tmp_path / "base" / "s")).rdd.glom().collect():
        values = [r.n for r in part]
        assert values == sorted(values)


def test_only_versions_that_pass_become_current(spark, tmp_path):
    root, checks = str(tmp_path), [Q.Unique("id")]
    S.publish(spark.range(3), root, "base", "t", "1", checks=checks)
    with pytest.raises(S.ChecksFailed, match="unique of id"):
        S.publish(spark.range(2).union(spark.range(2)), root, "base", "t", "2", checks=checks)
    assert S.current_version(spark.newSession(), root, "base", "t") == "1"
    S.publish(spark.range(5), root, "base", "t", "3", checks=checks)
    assert S.read_current(spark.newSession(), root, "base", "t").count() == 5
    with pytest.raises(LookupError):
        S.read_current(spark, root, "base", "other")


def test_publish_counts_while_it_writes(spark, tmp_path):
    root = str(tmp_path)
    checks = [Q.NotNull("id"), Q.Between("id", 0, 2), Q.Unique("id")]
    with pytest.raises(S.ChecksFailed, match=r"between of id \(3\), unique of id \(1\)"):
        S.publish(spark.range(6).union(spark.range(1)), root, "base", "t", "1", checks=checks)
    assert S.current_version(spark, root, "base", "t") is None
    df = spark.range(3)
    watched, seen = Q.observed(df, checks[:2])
    watched.write.format("noop").mode("overwrite").save()
    assert Q.observed_failures(checks, seen)[:2] == [("not_null", "id", 0), ("between", "id", 0)]
    S.publish(df, root, "base", "t", "2", checks=checks)
    S.publish(spark.range(2), root, "base", "t", "3", checks=checks)
    assert rows(S.load_log(spark, root, "base", "t")) == [(1, "2", 3), (2, "3", 2)]
    assert S.remove_old_versions(spark, root, "base", "t", keep=1) == ["2"]
    assert S.read_current(spark, root, "base", "t").count() == 2


def test_the_later_of_two_publishers_fails(spark, tmp_path, monkeypatch):
    root, real = str(tmp_path), S._places
    S.publish(spark.range(1), root, "base", "t", "1")

    def before_the_other(*given):
        found = real(*given)
        monkeypatch.setattr(S, "_places", real)
        S.publish(spark.range(2), root, "base", "t", "first")
        return found

    monkeypatch.setattr(S, "_places", before_the_other)
    with pytest.raises(S.PublishedMeanwhile):
        S.publish(spark.range(3), root, "base", "t", "later")
    assert S.current_version(spark, root, "base", "t") == "first"
