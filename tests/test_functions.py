from pyspark.sql import functions as F

from ledgerlight.functions.num import div0, greatest_strict, trunc_to
from ledgerlight.functions.text import (comment_metadata, last_dot_part, map_as_text, merge_maps,
                                        strip_comments, tag_metadata)


def one(spark, expr, schema="a double, b double", row=(1.0, 2.0)):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


def test_div0_zero_null_and_plain(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (3.0, 2.0), (None, 0.0)], "a double, b double")
    got = [r.x for r in df.select(div0("a", "b").alias("x")).collect()]
    assert got == [0.0, None, 1.5, 0.0]


def test_greatest_strict_is_null_on_any_null(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "a double, b double")
    got = [r.x for r in df.select(greatest_strict("a", "b").alias("x")).collect()]
    assert got == [None, 2.0]
    # Spark's own greatest skips the null
    assert df.select(F.greatest("a", "b").alias("x")).first().x == 1.0


def test_trunc_to_cuts_toward_zero(spark):
    df = spark.createDataFrame([(1.123456789,), (-1.123456789,)], "a double")
    got = [r.x for r in df.select(trunc_to("a", 8).alias("x")).collect()]
    assert got == [1.12345678, -1.12345678]


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_strip_comments_forms(spark):
    cases = {
        "select 1 /* block */ from t;": "select 1  from t",
        "select 1 -- trailing": "select 1 ",
        "select 1 -- line\nfrom t": "select 1 from t",
        "/* a\nmulti\r\nline */select 2": "select 2",
        "select '/*' || x": "select '/*' || x",
    }
    df = texts(spark, list(cases))
    got = {r.t: r.x for r in df.select("t", strip_comments("t").alias("x")).collect()}
    assert got == cases


def test_strip_comments_long_comment_does_not_overflow(spark):
    text = "select 1 /* " + ("x" * 40_000) + " */ from t"
    got = texts(spark, [text]).select(strip_comments("t").alias("x")).first().x
    assert got == "select 1  from t"


def test_comment_metadata_first_dbt_comment_only(spark):
    good = 'select 1 /* {"app": "dbt", "node_id": "model.p.a"} */ /* {"app": "dbt", "node_id": "b"} */'
    bad = 'select 1 /* {"app": "dbt", "node_id": } */'
    array = 'select 1 /* ["app", "dbt"] */'
    plain = "select 1"
    starred = 'select 1 /* {"app": "dbt", "x": "a*b"} */'
    df = texts(spark, [good, bad, array, plain, starred])
    got = [r.m for r in df.select(comment_metadata("t").alias("m")).collect()]
    assert got[0] == {"app": "dbt", "node_id": "model.p.a"}
    assert got[1:] == [None, None, None, None]


def test_tag_metadata_needs_a_marker(spark):
    df = texts(spark, ['{"dbt_snowflake_query_tags_version": "2.0", "a": "1"}',
                       '{"dbt_query_tags_version": "1.0"}', '{"team": "x"}', "", "not json"])
    got = [r.m for r in df.select(tag_metadata("t").alias("m")).collect()]
    assert got[0] == {"dbt_snowflake_query_tags_version": "2.0", "a": "1"}
    assert got[1] == {"dbt_query_tags_version": "1.0"}
    assert got[2:] == [None, None, None]


def test_merge_maps_right_wins_and_nested_values_stay_json(spark):
    df = spark.createDataFrame([('{"a": "1", "b": [1, 2], "c": {"d": true}}', '{"a": "2", "z": "9"}'),
                                (None, '{"q": "1"}'), (None, None)], "l string, r string")
    m = merge_maps(F.from_json("l", "map<string,string>"), F.from_json("r", "map<string,string>"))
    got = [r.x for r in df.select(map_as_text(m).alias("x")).collect()]
    assert got == ['a=2|b=[1,2]|c={"d":true}|z=9', "q=1", None]


def test_last_dot_part(spark):
    df = texts(spark, ['model.proj."My_Model"', "single", None])
    got = [r.x for r in df.select(last_dot_part("t").alias("x")).collect()]
    assert got == ["My_Model", "single", None]
