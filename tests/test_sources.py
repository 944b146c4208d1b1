"""Sources and sinks."""

import contextlib
import io
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from relq.operators import filters as P
from relq.sources import schemas as S
from relq.sources.tables import SnapshotRefused, load_snapshots, preview, scan_all, scan_ordered, write_result, write_snapshots


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_schema_equals_file_schema(spark, sf):
    base = f"/root/testdata/{sf}"
    for name, schema in S.DRIVER_SCHEMAS.items():
        inferred = spark.read.parquet(os.path.join(base, f"{name}.parquet")).schema
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in schema], name


def test_housing_schema_keeps_meaning_and_not_null(housing):
    fields = {f.name: f for f in housing["status"].schema}
    assert fields["BASIS_DY"].nullable is False and fields["GRNT_SPLY_CNT"].nullable is True
    assert fields["BASIS_DY"].metadata["comment"].startswith("기준일자")


def test_snapshot_write_prunes_partitions(spark, housing):
    out = os.path.join(tempfile.mkdtemp(prefix="relq-snap-"), "status")
    write_snapshots(housing["status"], out, "BASIS_DY")
    back = spark.read.parquet(out)
    assert back.count() == 32
    picked = P.where(back, P.between("BASIS_DY", "20220101", "20250630"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        picked.explain(mode="formatted")
    assert "PartitionFilters" in buf.getvalue()
    assert picked.count() == 16


def test_scans_and_result_sink(spark, housing):
    reg = housing["region"]
    assert scan_all(reg).count() == 8
    ordered = [r[0] for r in scan_ordered(housing["status"], ["-BASIS_DY", "GRNT_NO"]).collect()]
    assert ordered[:1] == ["20230630"]
    assert preview(reg, 3).count() == 3
    path = os.path.join(tempfile.mkdtemp(prefix="relq-out-"), "r")
    write_result(reg.filter(F.col("ZONE_TYPE").isNotNull()), path)
    assert spark.read.parquet(path).count() == 8


def test_reports_over_written_and_reread_course_tables(spark, housing):
    """S2 + S1 + S3 end to end: write the course tables, read them back with
    their declared schemas, and the status report still gives the course's answer."""
    from relq.operators.aggregates import Measure
    from relq.plans import reports as R
    from relq.sources.tables import read_table
    from relq.functions import expressions as X

    base = tempfile.mkdtemp(prefix="relq-course-")
    write_snapshots(housing["status"], os.path.join(base, S.GUARANTEE_STATUS + ".parquet"), "BASIS_DY")
    write_result(housing["region"], os.path.join(base, S.REGION_CODE + ".parquet"))
    status = read_table(spark, base, S.GUARANTEE_STATUS)
    region = read_table(spark, base, S.REGION_CODE)
    assert dict(status.dtypes)["BASIS_DY"] == "string"
    out = R.status_report(
        status, region, fact_region="HS_LOC_ZONE_DVCD", dim_key="CD_ID", dim_cols=["CD_NM", "ZONE_TYPE"],
        date_col="BASIS_DY", product_code="PNSN_GV_METH_DVCD", product_labels={"07": "a", "08": "b", "09": "c"},
        other_label="z", dim_filter=P.eq("CD_GRP_ID", "COA0083"),
        measures={"supply": Measure(F.sum("GRNT_SPLY_CNT")),
                  "appraisal": Measure(F.sum(X.cents("APRS_EVAL_AMT")), lambda c: X.round_to(X.from_cents(c), 1))},
        sort=["-BASIS_DY", "-supply"])
    got = out.collect()
    assert len(got) == 29 and tuple(got[0])[:5] == ("20230630", "서울", "수도권", "a", 38000)


def test_bucketed_facts_join_without_shuffle(spark, housing):
    from relq.operators import joins as J
    from relq.sources.tables import write_bucketed

    keys = ["GRNT_NO", "BASIS_DY"]
    status = write_bucketed(housing["status"], "status_bucketed", keys, 4)
    amount = write_bucketed(housing["amount"], "amount_bucketed", keys, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables of size
    buf = io.StringIO()
    try:
        joined = J.equi_join(status, amount, keys)
        with contextlib.redirect_stdout(buf):
            joined.explain(mode="formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = buf.getvalue()
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == 32


def test_snapshot_write_spreads_a_hot_date(spark):
    from pyspark.sql import functions as F
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("20230630")).otherwise(F.lit("20220630")).alias("BASIS_DY"),
        F.col("id").alias("v"))
    out = os.path.join(tempfile.mkdtemp(prefix="relq-hot-"), "snap")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        write_snapshots(hot, out, "BASIS_DY")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(os.path.join(out, "BASIS_DY=20230630")) if f.endswith(".parquet")]
    assert len(files) > 1                     # the hot date was written by several tasks
    assert spark.read.parquet(out).count() == 30000


def _files(root):
    return {os.path.relpath(os.path.join(d, f), root): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_reloading_one_date_leaves_the_others(spark, housing, tmp_path):
    out, status = str(tmp_path / "status"), housing["status"]
    dates = {r["BASIS_DY"]: r["count"] for r in status.groupBy("BASIS_DY").count().collect()}
    assert load_snapshots(status, out, "BASIS_DY", ["GRNT_NO"], dates) == dates
    before = _files(out)
    day = sorted(dates)[1]
    changed = status.where(F.col("BASIS_DY") == day).withColumn("GRNT_SPLY_CNT", F.col("GRNT_SPLY_CNT") + 1000)
    for _ in range(2):  # twice is once
        assert load_snapshots(changed, out, "BASIS_DY", ["GRNT_NO"]) == {day: dates[day]}
        after = _files(out)
        of_day = lambda files: {f for f in files if f.startswith(f"BASIS_DY={day}")}
        assert {f: t for f, t in after.items() if f not in of_day(after)} == {f: t for f, t in before.items() if f not in of_day(before)}
        assert of_day(after) and not of_day(after) & of_day(before)
        back = spark.read.schema(status.schema).parquet(out)
        assert {r["BASIS_DY"]: r["count"] for r in back.groupBy("BASIS_DY").count().collect()} == dates
        assert sorted(map(tuple, back.where(F.col("BASIS_DY") == day).select(status.columns).collect())) == sorted(map(tuple, changed.collect()))
    assert not [d for d in os.listdir(out) if d.startswith("_incoming")]
    new = status.limit(3).withColumn("BASIS_DY", F.lit("20240630"))
    assert load_snapshots(new, out, "BASIS_DY", ["GRNT_NO"]) == {"20240630": 3}
    assert spark.read.parquet(out).count() == 35


@pytest.mark.parametrize(("fault", "message"), [
    (lambda df: df.union(df.limit(1)), "key"),
    (lambda df: df.withColumn("GRNT_NO", F.when(F.col("GRNT_NO") != df.first()["GRNT_NO"], F.col("GRNT_NO"))), "without GRNT_NO"),
    (lambda df: df.withColumn("BASIS_DY", F.when(F.col("GRNT_NO") != df.first()["GRNT_NO"], F.col("BASIS_DY"))), "without a date"),
    (lambda df: df.where(F.col("GRNT_NO") != df.first()["GRNT_NO"]), "expected"),
])
def test_a_load_that_fails_its_checks_changes_nothing(spark, housing, tmp_path, fault, message):
    out, status = str(tmp_path / "status"), housing["status"]
    dates = load_snapshots(status, out, "BASIS_DY", ["GRNT_NO"])
    before = _files(out)
    day = sorted(dates)[0]
    with pytest.raises(SnapshotRefused, match=message):
        load_snapshots(fault(status.where(F.col("BASIS_DY") == day)), out, "BASIS_DY", ["GRNT_NO"], {day: dates[day]})
    assert _files(out) == before and set(os.listdir(out)) - {"_SUCCESS"} == {d.split("/")[0] for d in before}


def test_result_sink_counts_while_it_writes(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select("id", F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.lit(None).cast("string").alias("none"))
    store = spark.sparkContext._jsc.sc().statusStore()
    jobs = lambda: store.jobsList(None).size()
    before = jobs()
    assert write_result(df, str(tmp_path / "r"), keys=["k", "none"]) == {"rows": 1000, "null_k": 100, "null_none": 1000}
    assert jobs() == before + 1  # the write is the only run
    assert spark.read.parquet(str(tmp_path / "r")).count() == 1000
    assert write_result(df.limit(0), str(tmp_path / "e"), keys=["k"]) == {"rows": 0, "null_k": 0}


def test_dimension_filter_prunes_the_stored_fact(spark, tmp_path):
    """J10 over written snapshots: only the folders of the codes that the filtered dimension keeps are read."""
    from relq.operators import joins as J

    out, dim_path = str(tmp_path / "fact"), str(tmp_path / "dim")
    fact = spark.range(8000).select(F.concat(F.lit("2020"), F.lpad((F.col("id") % 4 + 1).cast("string"), 2, "0"), F.lit("30")).alias("BASIS_DY"),
                                    F.concat(F.lit("Z"), (F.col("id") % 8).cast("string")).alias("ZONE"), F.col("id").alias("v"))
    write_snapshots(fact, out, "BASIS_DY", code_cols=["ZONE"])
    spark.createDataFrame([(f"Z{i}", "north" if i < 2 else "south") for i in range(8)], "CD_ID string, ZONE_TYPE string").write.parquet(dim_path)
    stored, dim = spark.read.parquet(out), spark.read.parquet(dim_path)
    df = J.dim_lookup(P.where(stored, P.eq("BASIS_DY", "20200130")), dim, "ZONE", "CD_ID", dim_filter=P.eq("ZONE_TYPE", "north"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    assert "dynamicpruning" in buf.getvalue()
    got = df.select("v").collect()
    assert sorted(r["v"] for r in got) == [i for i in range(8000) if i % 8 < 2 and i % 4 == 0]
    written = [f for f in _files(out) if "BASIS_DY=20200130" in f]
    df.collect()
    scan = [n for n in _nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName().startswith("Scan parquet") and "BASIS_DY" in n.simpleString(100)]
    read = sum(n.metrics().apply("numFiles").value() for n in scan)
    assert 0 < read < len(written), (read, len(written))


def _nodes(plan):
    """All nodes of an executed plan, through adaptive stages."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        yield from _nodes(plan.executedPlan())
        return
    yield plan
    inner = [plan.plan()] if name.endswith("QueryStage") else []
    children = plan.children()
    for child in inner + [children.apply(i) for i in range(children.size())]:
        yield from _nodes(child)
