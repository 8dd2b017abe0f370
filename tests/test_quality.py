import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from chorale.operators import quality as q


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, "")], "id int, text string")


ID, TEXT = q.Expectation("has_id", "id IS NOT NULL"), q.Expectation("has_text", "LENGTH(text) > 0")


def test_report_counts_null_as_violation(rows):
    got = {r["expectation"]: (r["passed_rows"], r["failed_rows"]) for r in q.expectation_report(rows, [ID, TEXT]).collect()}
    assert got == {"has_id": (3, 1), "has_text": (2, 2)}


def test_warn_keeps_drop_drops_fail_fails(rows):
    assert q.apply_expectations(rows, [ID, TEXT]).count() == 4
    assert q.apply_expectations(rows, [q.Expectation("t", TEXT.predicate, "drop")]).count() == 2
    with pytest.raises(Exception, match="expectation i violated"):
        q.apply_expectations(rows, [q.Expectation("i", ID.predicate, "fail")]).collect()
    with pytest.raises(ValueError):
        q.Expectation("x", "true", "explode")


def test_observed_in_the_same_pass(rows):
    seen = Observation("checks")
    q.apply_expectations(rows, [ID, TEXT], seen).collect()
    assert seen.get == {"rows": 4, "has_id": 1, "has_text": 2}


def test_quarantine(rows):
    got = {r["id"]: r["violated"] for r in q.quarantine(rows, [ID, TEXT]).collect()}
    assert got == {None: ["has_id"], 3: ["has_text"], 4: ["has_text"]}


def test_null_passes_none_where_but_fails_all_where(spark):
    df = spark.createDataFrame([(None,), (5,)], "views int")
    r = q.check_table("t", df, q.TableChecks(
        columns=("views", "gone"), none_where={"no negative": "views < 0"}, all_where={"positive": "views > 0"}))
    got = {x["check_name"]: (x["passed"], x["failing_rows"]) for x in r.collect()}
    assert got == {
        "t: has rows": (True, 0), "t: has views": (True, 0), "t: has gone": (False, 0),
        "t: no negative": (True, 0), "t: positive": (False, 1)}


def test_empty_and_unreachable_tables_become_failed_rows(spark, tmp_path):
    report = q.check_tables(spark, {
        "empty": (lambda: spark.range(0), q.TableChecks()),
        "gone": (lambda: spark.read.parquet(str(tmp_path / "nothing")), q.TableChecks()),
        "odd": (lambda: spark.range(2), q.TableChecks(none_where={"x": "no_such_column > 1"})),
        "fine": (lambda: spark.range(2), q.TableChecks()),
    })
    assert {r["check_name"]: r["passed"] for r in report.collect()} == {
        "empty: has rows": False, "gone: accessible": False, "odd: accessible": False, "fine: has rows": True}
    assert q.report_totals(report).first().asDict() == {"total": 4, "passed": 1, "failed": 3}


def test_coverage(spark):
    some = spark.range(4).withColumn("x", F.lit(1))
    r = q.coverage(spark.range(10), some, "id").first()
    assert (r["expected"], r["covered"], r["coverage"], r["passed"]) == (10, 4, 0.4, False)
    assert q.coverage(spark.range(0), some, "id").first()["passed"] is False
