"""Validation semantics: TRUE passes, FALSE and NULL fail, every row lands once."""

from pyspark.sql import functions as F

from changelake.functions import rules as R
from changelake.operators.quality import (ERRORS_COL, annotate, failure_counts, replay, split)

RULES = {"a_not_null": "a IS NOT NULL", "b_positive": "b > 0"}


def _df(spark):
    return spark.createDataFrame(
        [(1, 5), (None, 5), (2, -1), (None, None), (3, None)], "a int, b int")


def test_null_rule_result_is_a_failure(spark):
    valid, bad = split(_df(spark), RULES)
    assert sorted(r.a for r in valid.collect()) == [1]
    errors = {(r.a, r.b): r[ERRORS_COL] for r in bad.collect()}
    assert errors == {
        (None, 5): "a_not_null",
        (2, -1): "b_positive",
        (None, None): "a_not_null, b_positive",
        (3, None): "b_positive",
    }


def test_every_row_lands_exactly_once(spark):
    df = _df(spark)
    valid, bad = split(df, RULES)
    assert valid.count() + bad.count() == df.count()
    assert valid.columns == df.columns
    assert bad.columns == df.columns + [ERRORS_COL]


def test_no_rules_returns_input(spark):
    df = _df(spark)
    valid, bad = split(df, {})
    assert valid is df
    assert bad.count() == 0


def test_column_rules_and_odd_names(spark):
    df = spark.createDataFrame([(1,), (None,)], "`a-b` int")
    name, text = R.not_null("a-b")
    valid, bad = split(df, {name: text, "col_rule": F.col("a-b") < 5})
    assert valid.count() == 1
    assert bad.first()[ERRORS_COL] == "a-b_not_null, col_rule"


def test_failure_counts_and_replay(spark):
    _, bad = split(_df(spark), RULES)
    counts = {r.rule_name: r.failed_rows for r in failure_counts(bad).collect()}
    assert counts == {"a_not_null": 2, "b_positive": 3}
    ok, still_bad = replay(bad, {"b_not_negative_or_null": "b IS NULL OR b >= 0"})
    assert ok.count() + still_bad.count() == bad.count()
    assert [r.b for r in still_bad.collect()] == [-1]


def test_accepted_values_rule(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    name, text = R.accepted_values("s", ["x", "it's"])
    assert name == "s_accepted_values"
    valid, bad = split(df, {name: text})
    assert [r.s for r in valid.collect()] == ["x"]
    assert bad.count() == 2
    _, text2 = R.accepted_values("s", ["x"], allow_null=True)
    assert split(df, {"r": text2})[0].count() == 2


def test_annotate_single_projection(spark):
    # All rules are added by one select (one Project in the analyzed plan),
    # not a chain of withColumn calls.
    plan = annotate(_df(spark), RULES)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_null_keys_keep_quarantines_every_null_key_row(spark):
    from changelake.operators.cdc import reconcile
    raw = spark.createDataFrame([
        ("I", "2024-01-01 00:00:00.000000", None, "a"),
        ("I", "2024-01-02 00:00:00.000000", None, "b"),
        ("U", "2024-01-03 00:00:00.000000", None, "c"),
        ("I", "2024-01-01 00:00:00.000000", 1, "d"),
    ], "Op string, _dms_timestamp string, id int, v string")
    rules = {"id_not_null": "id IS NOT NULL"}
    _, bad_group = split(reconcile(raw, "id"), rules)
    _, bad_keep = split(reconcile(raw, "id", null_keys="keep"), rules)
    assert bad_group.count() == 1          # NULL keys collapse into one key
    assert sorted(r.v for r in bad_keep.collect()) == ["a", "b", "c"]
