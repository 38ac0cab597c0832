from wattline.operators import quality
from wattline.operators.access import entitled_rows
from wattline.operators.history import apply_changes, open_history

AS_OF = "2024-03-01 12:00:00"


def failing(df):
    return {(r["check"], r["column"]): (r["failing_rows"], r["status"]) for r in df.collect()}


def test_every_check_kind(spark):
    child = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (None, "z", 9), (2, None, None)], "k int, label string, ref int"
    )
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    spec = quality.TableChecks(
        not_null=("k", "label"),
        unique=("k", "label"),
        accepted={"label": ("a", "b")},
        relationships=(quality.Relationship("ref", "parent", "id"),),
    )
    result = quality.run_checks({"child": child, "parent": parent}, {"child": spec})
    assert tuple(result.columns) == quality.RESULT_COLUMNS
    assert failing(result) == {
        ("not_null", "k"): (1, "fail"),
        ("not_null", "label"): (1, "fail"),
        ("unique", "k"): (1, "fail"),
        ("unique", "label"): (0, "pass"),
        ("accepted_values", "label"): (1, "fail"),
        ("relationships", "ref"): (1, "fail"),
    }


def test_checks_of_an_empty_table_pass(spark):
    empty = spark.createDataFrame([], "k int")
    spec = quality.TableChecks(
        not_null=("k",), unique=("k",), accepted={"k": (1,)},
        relationships=(quality.Relationship("k", "t", "k"),),
    )
    assert {s for _, s in failing(quality.run_checks({"t": empty}, {"t": spec})).values()} == {"pass"}


def test_orphans_are_counted_in_rows(spark):
    child = spark.range(100).selectExpr("if(id % 3 = 0, -1, id) as ref")
    parent = spark.range(100).toDF("ref")
    result = quality.check_relationship(child, parent, "t", "ref", "ref")
    assert result.first()["failing_rows"] == 34


def test_freshness(spark):
    def status(newest):
        df = spark.createDataFrame([(newest,)], "x string").selectExpr(
            "cast(x as timestamp) as _ingested_at"
        )
        return quality.check_freshness(df, "t", AS_OF, "2 hours", "6 hours").first()["status"]

    assert status("2024-03-01 10:00:00") == "pass"
    assert status("2024-03-01 09:59:59") == "warn"
    assert status("2024-03-01 06:00:00") == "warn"
    assert status("2024-03-01 05:59:59") == "error"
    assert status(None) == "error"


def test_missing_periods(spark, rows):
    df = spark.sql("select timestamp'2024-03-01 01:00:00' as ts")
    gaps = quality.missing_periods(df, "ts", "2024-03-01 00:00:00", "2024-03-01 02:00:00", "1 hour")
    assert [r[0].hour for r in gaps.orderBy("period").collect()] == [0, 2]


def test_orphan_rate(spark, rows):
    df = spark.createDataFrame([(1,), (None,), (2,), (None,)], "k int")
    assert rows(quality.orphan_rate(df, "k")) == [(4, 2, 0.5)]


def test_entitlements(spark, rows):
    df = spark.createDataFrame([("ERCO", 1), ("GB", 2), ("PJM", 3)], "code string, v int")
    grants = spark.createDataFrame(
        [("ann", "ERCO"), ("ann", "ERCO"), ("ann", "GB"), ("bob", "PJM")], "reader string, member string"
    )
    assert rows(entitled_rows(df, grants, "ann", "code")) == [("ERCO", 1), ("GB", 2)]
    assert entitled_rows(df, grants, "eve", "code").count() == 0


def test_history(spark, rows):
    dim = open_history(spark.createDataFrame([(1, "x"), (2, "y")], "k int, a string"), "2024-01-01")
    changes = spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "k int, a string")
    out = apply_changes(dim, changes, ["k"], ["a"], "2024-02-01")
    shown = rows(
        out.selectExpr("k", "a", "cast(valid_from as date)", "cast(valid_to as date)", "is_current")
    )
    assert [(k, a, str(f), str(t), c) for k, a, f, t, c in shown] == [
        (1, "x", "2024-01-01", "None", True),
        (2, "y", "2024-01-01", "2024-02-01", False),
        (2, "z", "2024-02-01", "None", True),
        (3, None, "2024-02-01", "None", True),
    ]
    again = apply_changes(out, changes, ["k"], ["a"], "2024-03-01")
    assert rows(again) == rows(out)


def test_gate(spark):
    import pytest

    df = spark.createDataFrame([(1,), (1,)], "k int")
    good = quality.run_checks({"t": df}, {"t": quality.TableChecks(not_null=("k",))})
    quality.require_passing(good)
    bad = quality.run_checks({"t": df}, {"t": quality.TableChecks(unique=("k",))})
    with pytest.raises(quality.QualityError, match="t.k unique: 1"):
        quality.require_passing(bad)
