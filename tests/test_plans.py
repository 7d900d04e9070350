"""Plan-shape guards for the scale properties the README claims."""

import contextlib
import io

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            se.queries()[name](spark, SF).explain("formatted")
        return buf.getvalue()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_small_dimensions_are_broadcast_by_their_real_size(spark):
    df = se.queries()["q_agency_lookup"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final and "ResolvedHint" not in final


def test_counts_aggregate_before_the_shuffle(spark):
    p = plan(spark, "q_unique_rows")
    tree = p.split("\n\n")[0].splitlines()
    lines = [ln for ln in tree if "Aggregate" in ln or "Exchange" in ln]
    # Read upwards from the scan (the spread of a single-split scan left out): first an aggregate.
    kinds = ["A" if "Aggregate" in ln else "E" for ln in reversed(lines)]
    assert "".join(kinds).lstrip("E").startswith("A") and "partial_count" in p


def test_totals_do_not_expand_the_rows(spark):
    assert "Expand" not in plan(spark, "q_li_coverage").split("\n\n")[0]


def test_repeats_in_one_answer_need_no_shuffle_of_vehicles(spark):
    tree = plan(spark, "q_infopoint_vehicles").split("\n\n")[0].splitlines()
    first_generate = next(i for i, ln in enumerate(tree) if "Generate" in ln)
    assert not any("Exchange" in ln or "Aggregate" in ln for ln in tree[:first_generate])


def test_building_a_lookup_runs_no_aggregate_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    se.queries()["q_agency_lookup"](spark, SF)
    stages = [s for j in tracker.getJobIdsForGroup("build") for s in tracker.getJobInfo(j).stageIds]
    names = {tracker.getStageInfo(s).name.split(" ")[0] for s in stages if tracker.getStageInfo(s)}
    assert names <= {"parquet"}, names  # schema reads only
    spark.sparkContext.setJobGroup("", "")


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "q_dedupe_day")
    read = [ln for ln in p.splitlines() if ln.startswith("ReadSchema")]
    assert read and "value" not in read[0] and "props" in read[0]


def test_no_cartesian_products(spark):
    for name in ("q_coverage_calendar", "q_fan_out", "q_active_routes", "q_work_list", "q_missing_vehicles"):
        p = plan(spark, name)
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name
