from millrace.operators.filtering import filter_rows, merge_counts, reason_counts
from millrace.plans.config import FilterConfig, RunConfig, malformed_policy, merged

import pytest


def reasons(spark, rows, schema, **config):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "_ord long, " + schema)
    return [r.asDict() for r in filter_rows(df, FilterConfig(**config)).orderBy("_ord").collect()]


def test_each_reason_in_order(spark):
    rows = [("t", "x" * 30), ("t", "short"), ("", "x" * 30), ("t", "  "), ("t", "y" * 60), ("t", "mail a@b.org " + "x" * 20)]
    got = reasons(spark, rows, "title string, body string", require_non_empty_title=True, max_body_chars=50, enable_pii_redaction=True, pii_block_on_match=True)
    assert [r["drop_reason"] for r in got] == [None, "too_short", "empty_title", "empty_body", "too_long", "pii_blocked"]


def test_detection_is_joint_and_length_counts_after_redaction(spark):
    got = reasons(spark, [("a@b.org", "call 650 555 1000", "http://x/c@d.org", "7 555 1000 999")], "title string, body string, url string, id string", enable_pii_redaction=True, min_body_chars=19)
    assert got[0]["title"] == "<EMAIL_ADDRESS>" and got[0]["url"] == "http://x/<EMAIL_ADDRESS>" and got[0]["id"] == "7 555 1000 999"
    assert got[0]["body"] == "call <PHONE_NUMBER>" and got[0]["drop_reason"] is None
    assert reasons(spark, [("t", "a@b.org")], "title string, body string", enable_pii_redaction=True, min_body_chars=10)[0]["drop_reason"] is None


def test_boilerplate_missing_fields_and_disabled(spark):
    assert reasons(spark, [("t", "Section [ edit ] useful content")], "title string, body string", boilerplate_patterns=(r"\[\s*edit\s*\]",))[0]["body"] == "Section useful content"
    assert reasons(spark, [("x",)], "id string")[0]["drop_reason"] == "empty_body"
    off = reasons(spark, [("t", "x")], "title string, body string", enabled=False)[0]
    assert off["drop_reason"] is None and off["canonical_text"] == "x" and len(off["canonical_hash"]) == 64
    assert reasons(spark, [(None, None)], "title string, body string")[0]["drop_reason"] == "empty_body"


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "drop_reason string")
    c = reason_counts(df)
    assert {r.drop_reason: r.rows for r in merge_counts(c, c).collect()} == {"a": 4, None: 2}


def test_config():
    assert merged(RunConfig(), {"near": {"hamming_threshold": 2}, "filtering": {"canonical_fields": ["title"]}}).near.hamming_threshold == 2
    for bad in ({"near": {"band_bits": 7}}, {"near": {"simhash_bits": 32}}, {"nope": 1}):
        with pytest.raises(ValueError):
            merged(RunConfig(), bad)
    assert malformed_policy(" Raise ") == "raise"
    with pytest.raises(ValueError):
        malformed_policy("ignore")


def test_plan_holds_each_expression_once(spark):
    """A filter on the reason must not be pushed into the expressions behind it."""
    from millrace.plans import catalogue

    plan = catalogue.filter_kept(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter isnull(drop_reason" in plan
    assert plan.lower().count("regexp_replace(") <= 24 and plan.count("RLIKE(") <= 24


def test_earlier_reasons_stay(spark):
    df = spark.createDataFrame([(0, "x" * 30, "malformed"), (1, "y" * 30, None), (2, "", None)], "_ord long, body string, drop_reason string")
    for on, want in ((True, ["malformed", None, "empty_body"]), (False, ["malformed", None, None])):
        assert [r.drop_reason for r in filter_rows(df, FilterConfig(enabled=on)).orderBy("_ord").collect()] == want
