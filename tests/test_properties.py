"""Property tests on seeded random rows."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from relq.operators import aggregates as A
from relq.operators import filters as P
from relq.operators import joins as J
from relq.operators import ordering as O

keys = st.one_of(st.none(), st.integers(0, 4))
left_rows = st.lists(st.tuples(keys, st.sampled_from(["a", "b", "c"])), max_size=12)
right_rows = st.lists(st.tuples(keys, st.sampled_from(["x", "y"])), max_size=12)


@settings(max_examples=10, deadline=None)
@given(left_rows, right_rows)
def test_full_outer_matches_native_and_union_form(spark, lrows, rrows):
    a = spark.createDataFrame(lrows, "k int, a string")
    b = spark.createDataFrame(rrows, "kb int, b string")
    ours = J.full_outer_join(a, b, "k", "kb")
    native = a.join(b, a["k"] == b["kb"], "full")
    assert sorted(map(tuple, ours.select("k", "a", "kb", "b").collect()), key=str) == \
        sorted(map(tuple, native.select("k", "a", "kb", "b").collect()), key=str)
    dedup = J.full_outer_distinct(a, b, "k", "kb", ["a", "b"])
    union = O.union_distinct(J.equi_join(a, b, "k", "kb", how="left").select("a", "b"),
                             J.equi_join(b, a, "kb", "k", how="left").select("a", "b"))
    assert sorted(map(tuple, dedup.collect()), key=str) == sorted(map(tuple, union.collect()), key=str)


codes = st.lists(st.tuples(st.sampled_from(["07", "08", "09"]), st.integers(0, 1000)), min_size=1, max_size=20)


@settings(max_examples=15, deadline=None)
@given(codes)
def test_conditional_sums_add_up_to_total(spark, data):
    df = spark.createDataFrame(data, "code string, v bigint").withColumn("d", F.lit("x"))
    out = A.pivot_sums(df, ["d"], "code", {"a": "07", "b": "08", "c": "09"}, "v", "total").first()
    assert out["a"] + out["b"] + out["c"] == out["total"] == sum(v for _, v in data)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="Gg-0123", max_size=8), max_size=15), st.text(alphabet="Gg-0123", max_size=3))
def test_like_prefix_equals_startswith(spark, values, prefix):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = sorted(r[0] for r in df.filter(P.like("s", prefix + "%")).collect())
    assert got == sorted(v for v in values if v.startswith(prefix))


@settings(max_examples=10, deadline=None)
@given(left_rows, right_rows)
def test_left_outer_join_matches_native(spark, lrows, rrows):
    a = spark.createDataFrame(lrows, "k int, a string")
    b = spark.createDataFrame(rrows, "kb int, b string")
    ours = J.left_outer_join(a, b, "k", "kb").select("k", "a", "kb", "b")
    native = a.join(b, a["k"] == b["kb"], "left").select("k", "a", "kb", "b")
    assert sorted(map(tuple, ours.collect()), key=str) == sorted(map(tuple, native.collect()), key=str)
    b2 = b.withColumnRenamed("kb", "k")
    using = J.left_outer_join(a, b2, "k").select("k", "a", "b")
    assert sorted(map(tuple, using.collect()), key=str) == \
        sorted(map(tuple, a.join(b2, "k", "left").select("k", "a", "b").collect()), key=str)


mixed_keys = st.one_of(st.none(), st.sampled_from([0, 0, 0, 1, 2, 3]))
pairs = st.lists(st.tuples(mixed_keys, st.sampled_from(["p", "p", "q", None]), st.integers(0, 3)), max_size=25)


@settings(max_examples=12, deadline=None)
@given(pairs, pairs, st.booleans(), st.booleans())
def test_outer_joins_on_two_keys_match_native(spark, lrows, rrows, left_unique, right_unique):
    """Hot keys, NULLs in either key column, repeated rows, keys of other widths;
    a declaration that does not hold must not change rows."""
    a = spark.createDataFrame(lrows, "k int, t string, a int")
    b = spark.createDataFrame(rrows, "kb bigint, tb string, b int")
    on = (a["k"] == b["kb"]) & (a["t"] == b["tb"])
    cols = ["k", "t", "a", "kb", "tb", "b"]
    key = lambda df: sorted(map(tuple, df.select(cols).collect()), key=str)
    declared = {"left_unique": left_unique, "right_unique": right_unique}
    assert key(J.full_outer_join(a, b, ["k", "t"], ["kb", "tb"], **declared)) == key(a.join(b, on, "full"))
    assert key(J.left_outer_join(a, b, ["k", "t"], ["kb", "tb"], right_unique=right_unique)) == key(a.join(b, on, "left"))
    assert key(J.right_outer_join(a, b, ["k", "t"], ["kb", "tb"], left_unique=left_unique)) == key(a.join(b, on, "right"))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.sampled_from([0.0, -0.0, 1.5, float("nan"), None]), max_size=15), st.lists(st.sampled_from([0.0, -0.0, 2.5, float("nan"), None]), max_size=15))
def test_outer_joins_on_floating_keys_match_native(spark, lrows, rrows):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(lrows)], "k double, a int")
    b = spark.createDataFrame([(k, i) for i, k in enumerate(rrows)], "kb double, b int")
    key = lambda df: sorted(map(tuple, df.select("a", "b").collect()), key=str)
    assert key(J.full_outer_join(a, b, "k", "kb")) == key(a.join(b, a["k"] == b["kb"], "full"))


@settings(max_examples=8, deadline=None)
@given(left_rows, right_rows)
def test_full_outer_using_matches_native(spark, lrows, rrows):
    a = spark.createDataFrame(lrows, "k int, a string")
    b = spark.createDataFrame(rrows, "k int, b string")
    key = lambda df: sorted(map(tuple, df.collect()), key=str)
    ours = J.full_outer_join(a, b, "k")
    assert ours.columns == ["k", "a", "b"] and key(ours) == key(a.join(b, "k", "full"))


signs = "aBkKiIßéÉ\u212aİı%_\\x"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=signs, max_size=7)), max_size=20), st.text(alphabet=signs + "%_", max_size=6), st.booleans())
def test_like_with_what_it_implies_matches_plain_like(spark, values, pattern, sensitive):
    """Wildcards in any place, letters with more than two cases, UTF-8, backslashes, NULL."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, pattern, pattern.upper(), pattern.lower(), None])], "i int, s string")
    escaped = pattern.replace("\\", "\\\\")
    plain = F.col("s").like(escaped) if sensitive else F.col("s").ilike(escaped)
    ours = P.like("s", pattern, case_sensitive=sensitive)
    got = df.select("i", F.coalesce(ours, F.lit(False)).alias("m"), F.coalesce(plain, F.lit(False)).alias("p")).collect()
    assert all(r["m"] == r["p"] for r in got), [r for r in got if r["m"] != r["p"]]
    assert df.filter(ours).count() == df.filter(plain).count() and df.filter(P.negate(ours)).count() == df.filter(~plain).count()


def test_what_patterns_imply():
    assert P._literals("G-____-%3") == ("G-", "3", ["", "", "", "-"]) and P._literals("plain") == ("plain", "plain", [])
    for pattern, sensitive in (("abc%", True), ("%abc", True), ("abc", True), ("___", True), ("%", False), ("k%", False), ("é%", False), ("_b%", False)):
        assert P.implied("s", pattern, sensitive) is None, pattern
