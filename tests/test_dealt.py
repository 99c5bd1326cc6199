"""Rows that are dealt once stay where they are, with the same results."""

import pytest
from pyspark.sql import functions as F

from tallyboard.functions import joins
from tallyboard.functions.columns import period_month
from tallyboard.contracts import DASHBOARD_METRICS
from tallyboard.operators import dimensions, elements, ingest, metrics, publish, scorecard
from tallyboard.sources.session import settle
from tallyboard.workload import score

DEFS = "Metric_ID string, Metric_Type string, Numerator_Element string, Denominator_Element string"


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _counts(spark):
    made = [
        (f"00{i % 3 + 1}", "2020-01-01" if i % 7 else None, f"p{i % 4}", f"c{i % 5}" if i % 6 else None, "s", "t", "m" if i % 2 else None, f"g{i % 9}", i)
        for i in range(200)
    ]
    columns = "Element_ID string, Date string, Provider_Code string, Commissioner_Code string, Service_Setting string, Activity_Type string, Gender string, Age string, Value long"
    return spark.createDataFrame(made, columns).withColumn("Date", F.col("Date").cast("date"))


def test_metrics_of_breakdowns_are_summed_without_another_shuffle(spark):
    long = elements.breakdowns_long(_counts(spark), groups=["Gender", "Age"])
    rows = elements.assemble_elements(long, long.filter("Element_ID = '001'"), together=True)
    defs = spark.createDataFrame([("M1", "Proportion", "1", "2")], DEFS)
    made = metrics.ratio_metrics(rows, defs)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
    assert "ENSURE_REQUIREMENTS" not in plan
    total = made.filter("Health_Inequalities_Group = 'Age'").agg(F.sum("Numerator"), F.sum("Denominator")).first()
    # The first element is in both parts.
    assert tuple(total) == (2.0 * sum(range(0, 200, 3)), float(sum(range(1, 200, 3))))


def test_rollup_is_the_same_where_dimensions_are_not_copied(spark, rows, monkeypatch, no_broadcast):
    long = elements.breakdowns_long(_counts(spark), groups=["Age"])
    made = metrics.ratio_metrics(long, spark.createDataFrame([("M1", "Proportion", "1", "2"), ("M2", "Count", "3", None)], DEFS))
    providers = spark.createDataFrame([("p0", "N1", "R1"), ("p0", "N2", "R1"), ("p1", None, "R2"), (None, "N3", "R3")], "ODS_Code string, ICB_Code string, Region_Code string")
    commissioners = spark.createDataFrame([("c1", "N1", "R1"), ("c2", "N2", None)], "Organisation_Code string, ICB_Code string, Region_Code string")
    copied = metrics.hierarchy_rollup(made, providers, commissioners)
    monkeypatch.setattr(metrics, "fits", lambda df, rows=0: False)
    dealt = metrics.hierarchy_rollup(made, providers, commissioners)
    assert rows(copied) == rows(dealt)
    total = lambda level: copied.filter(f"Level = '{level}' AND Aggregation_Source = 'Provider'").agg(F.sum("Numerator")).first()[0]
    assert total("ICB") == total("National") + copied.filter("Level = 'Provider' AND Org_Code = 'p0'").agg(F.sum("Numerator")).first()[0]


ROLL_DEFS = [("M1", "Proportion", "1", "2"), ("M2", "Count", "3", None), ("M3", "Proportion", "2", "2"), ("M1", "Proportion", "3", "1"), (None, "Count", "9", None)]


def _dimensions(spark):
    providers = spark.createDataFrame([("p0", "N1", "R1"), ("p1", None, "R2"), (None, "N3", "R3")], "ODS_Code string, ICB_Code string, Region_Code string")
    commissioners = spark.createDataFrame([("c1", "N1", "R1"), ("c2", "N2", None)], "Organisation_Code string, ICB_Code string, Region_Code string")
    return providers, commissioners


def test_metrics_side_by_side_are_those_that_are_joined(spark, rows, monkeypatch):
    defs = spark.createDataFrame(ROLL_DEFS, DEFS)
    long = elements.breakdowns_long(_counts(spark).withColumn("Value", F.nullif("Value", F.lit(6))), groups=["Age"])
    parts = elements.assemble_elements(long, long.filter("Element_ID = '001'").withColumn("Element_ID", F.lit("1.0")))
    packed = metrics.ratio_metrics(parts, defs)
    rolled = metrics.hierarchy_rollup(packed, *_dimensions(spark))
    assert metrics.packed_form(packed) and metrics.packed_form(rolled)
    monkeypatch.setattr(metrics, "PACKED_METRICS", 0)
    joined = metrics.ratio_metrics(parts, defs)
    assert metrics.packed_form(joined) is None
    assert rows(packed) == rows(joined)
    assert rows(rolled) == rows(metrics.hierarchy_rollup(joined, *_dimensions(spark)))


def test_names_are_joined_to_a_group_once(spark, rows, monkeypatch, no_broadcast):
    defs = spark.createDataFrame(ROLL_DEFS, DEFS)
    made = metrics.ratio_metrics(elements.breakdowns_long(_counts(spark), groups=["Age"]), defs)
    rolled = metrics.hierarchy_rollup(made, *_dimensions(spark))
    dims = spark.createDataFrame([("Provider", "p0", "a"), ("Provider", "p0", "b"), ("ICB", "N1", "c"), ("National", "ENG", "d")], "Level string, Org_Code string, Org_Name string")
    copied = rows(dimensions.decorate_by_level(rolled, dims))
    monkeypatch.setattr(dimensions, "fits", lambda df, rows=0: False)
    named = dimensions.decorate_by_level(rolled, dims)
    assert rows(named) == copied
    plan = named._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("Join LeftOuter")  # metrics become rows after the join


def test_only_cells_that_a_band_ends_in_are_ordered(spark, rows):
    made = [(f"g{i % 3}" if i % 5 else None, f"o{i // 2}" if i % 11 else None, None if i % 4 == 0 else (i % 3) / 2) for i in range(600)]
    df = spark.createDataFrame([*made, ("one", "o", 1.0), ("two", "o", None), ("two", "p", -0.0)], "g string, org string, r double")
    plain = rows(metrics.quantile_bands(df, ["g"], "r", "org"))
    cells = metrics.quantile_bands(df, ["g"], "r", "org", group_rows=10)
    assert rows(cells) == plain
    assert rows(metrics.quantile_bands(df, ["g"], "r", "org", n=7, group_rows=10)) == rows(metrics.quantile_bands(df, ["g"], "r", "org", n=7))
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("Window [row_number") == 1
    assert "Union" in cells._jdf.queryExecution().optimizedPlan().toString()


RECORD = "REPORTING_PERIOD ODS_CODE ODS_Name SETTING_TYPE ACTIVITY_TYPE HOSPITAL_SPELL_ID PREGNANCY_ID SMOKINGSTATUS SEEN_INHOUSE TOBACCODEPENDENCE_CAREPLAN INHOUSE_REFERRAL OUTCOME_AT28DAYS Der_Age_at_CDS_Activity_Date Person".split()
LINK = "_code string, _org string, _key string"
MONTHS = ["P-08-2022", "P-09-2022", None]


def _records(spark):
    def pick(values, i):
        return values[i % len(values)]

    made = [
        (
            pick(MONTHS, i), pick(["a", "b", "a", "c", None], i), pick(["n", None, "m"], i // 2), pick(["1", "2", "3", None], i), pick(["1", "3"], i // 3),
            pick([None, "k1", "K1", f"s{i}"], i // 3), pick(["p1", None, f"p{i}"], i), pick(["1", None, "2"], i), pick(["Y", "N", None], i // 2),
            pick(["20", None, "10"], i), pick(["Y", "N"], i), pick(["4", "1"], i // 2), pick(["9", "30", "200", None], i), pick(["x", "y", None, f"z{i}"], i),
        )
        for i in range(400)
    ]
    links = [(code, org, key) for code in "123" for org in "ac" for key in ("K1", "P1", "S7", "P6")] * 2 + [("1", None, "K1"), ("2", "b", "S9")]
    return spark.createDataFrame(made, ", ".join(f"{c} string" for c in RECORD)), spark.createDataFrame(links[:-2], LINK).unionByName(spark.createDataFrame(links[-2:], LINK).dropna())


def test_profile_shuffles_a_record_once(spark, rows, monkeypatch, no_broadcast):
    records, links = _records(spark)
    providers = spark.createDataFrame([("a", "R1", "I1"), ("a", "R1", "I2"), ("c", "R2", None)], "ODS_Code string, Region_Code string, ICB_Code string")
    profile = lambda: scorecard.record_quality_profile(records, links, providers, "Person")
    dealt = profile()
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    assert plan.split("REPARTITION_BY_COL")[0].count("ENSURE_REQUIREMENTS") == 0  # nothing is dealt again above it
    crowds = []
    for rows_each in (150, 0):  # organisations over their share, then every one, are counted per key
        monkeypatch.setattr(scorecard, "crowded_classes", lambda *parts, n=rows_each: crowds.append(joins.crowded_classes(*parts, rows=n)) or crowds[-1])
        assert rows(profile()) == rows(dealt)
    assert 0 < len(crowds[0]) < len(crowds[1]) and -1 in crowds[1]
    plain = records.groupBy(F.col("ODS_CODE"), F.col("ODS_Name")).agg(F.count("*").alias("n"), F.countDistinct("Person").alias("p"))
    assert dealt.filter("ICB_Code is null or ICB_Code != 'I2'").agg(F.sum("Count_Records")).first()[0] == plain.agg(F.sum("n")).first()[0]


def test_sides_of_the_scorecard_are_dealt_once(spark, rows, no_broadcast):
    records, _ = _records(spark)
    totals = scorecard.setting_totals(
        records.select(F.col("REPORTING_PERIOD").alias("p"), F.col("ODS_CODE").alias("ODS_Code"), F.lit("2").alias("m")),
        {"Physical Acute": ["m"], "Maternity": ["m", "m"], "Adult Mental Health": []}, period_month(F.col("p")),
    )
    got = scorecard.prevalence_rate(records, totals)
    counts = records.groupBy(period_month(F.col("REPORTING_PERIOD")).alias("Reporting_Period"), F.col("ODS_CODE").alias("ODS_Code"), scorecard.score_setting().alias("Setting_Type"))
    plain = counts.agg(F.count_if(F.col("SMOKINGSTATUS") == "1").alias("Count_Smokers")).join(totals, ["Reporting_Period", "ODS_Code", "Setting_Type"], "left")
    shown = ["ODS_Code", "Setting_Type", "Reporting_Period", "Count_Smokers", "Value"]
    assert rows(got, *shown) == rows(plain, *shown)
    twice = totals.unionByName(totals.withColumn("Value", F.col("Value") + 1))
    by_all = ["Reporting_Period", "ODS_Code", "Setting_Type"]
    joined = joins.join_within(totals, twice.withColumnRenamed("Value", "other"), by_all[:2], "Setting_Type")
    assert rows(joined, *by_all, "Value", "other") == rows(totals.join(twice.withColumnRenamed("Value", "other"), by_all, "left"), *by_all, "Value", "other")
    again = joins.join_within(joined, totals.withColumnRenamed("Value", "third"), by_all[:2], "Setting_Type")
    left = again._jdf.queryExecution().executedPlan().toString().split("+- Sort")[0]
    assert "Exchange" not in left  # the first join's rows are not dealt again


def test_grid_is_dealt_once(spark, no_broadcast):
    grid = spark.createDataFrame([("2022-08-01", "a", "n", "R", "I", "Maternity")], "m string, Org_Code string, Organisation_Name string, Region_Code string, ICB_Code string, Setting_Type string")
    grid = grid.select(F.col("m").cast("date").alias("Reporting_Period"), *grid.columns[1:])
    records, links = _records(spark)
    sent = spark.createDataFrame([("P-08-2022", "a", "Complete")], "ReportingPeriod string, OrganisationCode string, StatusofSubmission string")
    sent = scorecard.complete_submissions(sent)
    totals = grid.select("Reporting_Period", F.col("Org_Code").alias("ODS_Code"), "Setting_Type", F.lit(9.0).alias("Value"))
    activity = grid.select(F.col("Setting_Type").alias("Source"), "Org_Code", F.add_months("Reporting_Period", -1).alias("Date"), F.lit(3).cast("bigint").alias("Activity"))
    providers = spark.createDataFrame([("a", "R1", "I1")], "ODS_Code string, Region_Code string, ICB_Code string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        graded = scorecard.grade(
            scorecard.scorecard_wide(
                grid,
                scorecard.record_quality_profile(records, links, providers, "Person"),
                totals,
                scorecard.prior_submission_count(grid, sent),
                sent,
                scorecard.prevalence_rate(records, totals),
                scorecard.lagged_rolling_rate(totals, activity),
            )
        )
        node, dealt = graded._jdf.queryExecution().executedPlan(), 0
        while node.children().size():
            node = node.children().apply(0)
            dealt += node.nodeName() == "Exchange"
        assert dealt == 1
        found = graded.select("Reporting_Period", "Org_Code", "Setting_Type", "Patient_Records", "Aggregate_Records", "Percent_Identification").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    cells = records.filter("REPORTING_PERIOD = 'P-08-2022' AND ODS_CODE = 'a' AND SETTING_TYPE = '3'").groupBy("ODS_Name").count().collect()
    assert sorted(r.Patient_Records for r in found) == sorted(r["count"] for r in cells)
    assert {(r.Aggregate_Records, r.Percent_Identification) for r in found} == {(9.0, 3.0)}


@pytest.fixture
def lines(spark, tmp_path):
    """A folder with the tables that the scorecard reads."""
    made = [
        (i // 4, i % 9, i % 3, i % 7 + 1, float(i % 50), (i % 11) / 100, (i % 8) / 100, "ANR"[i % 3], "OF"[i // 3 % 2], f"199{6 + i % 2}-0{i % 5 + 1}-11")
        for i in range(200)
    ]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate string"
    tables = {
        "lineitem": spark.createDataFrame(made, schema).withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp")),
        "orders": spark.createDataFrame([(i, i % 6, "FPO"[i % 3]) for i in range(50)], "o_orderkey long, o_custkey long, o_orderstatus string").withColumn("o_orderpriority", F.lit("1-URGENT")),
        "supplier": spark.createDataFrame([(i, f"S{i}", i, 900.0) for i in range(3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": spark.createDataFrame([(i, f"N{i}", 0) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string"),
    }
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_totals_are_dealt_once_for_all_their_joins(spark, lines, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        graded = score.grade(spark, lines)
        plan = graded._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum("ReusedExchange" in line and "Value#" in line for line in plan.splitlines()) == 2


def test_totals_shuffle_one_sum_per_setting(spark, rows):
    made = [("m1", "a", "1", "2.5", None), ("m1", "a", None, "x", "4"), ("m1", None, None, None, None), (None, "b", "7", "1", "1")]
    agg = spark.createDataFrame(made, "m string, ODS_Code string, p string, q string, r string")
    totals = scorecard.setting_totals(agg, {"one": ["p", "q"], "two": ["q", "r"], "none": []}, F.col("m"))
    plan = scorecard.setting_totals(agg, {"all": ["p", "q", "r"]}, F.col("m"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") == 1
    found = [("m1", "a", "one", 3.5), ("m1", "a", "two", 6.5), ("m1", None, "one", 0.0), ("m1", None, "two", 0.0), (None, "b", "one", 8.0), (None, "b", "two", 2.0)]
    found += [(m, o, "none", 0.0) for m, o in (("m1", "a"), ("m1", None), (None, "b"))]
    assert rows(totals) == sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_prevalence_shuffles_one_count_per_setting(spark, rows):
    records, _ = _records(spark)
    totals = spark.createDataFrame([], "ODS_Code string, Reporting_Period date, Setting_Type string, Value double")
    made = scorecard.prevalence_rate(records, totals)
    assert made._jdf.queryExecution().executedPlan().toString().count("partial_sum") == 4
    cell = [F.col("ODS_CODE"), scorecard.score_setting().alias("s"), period_month(F.col("REPORTING_PERIOD")).alias("p")]
    plain = records.select(*cell, (F.coalesce("SMOKINGSTATUS", F.lit("")) == "1").cast("long").alias("n")).groupBy("ODS_CODE", "s", "p").agg(F.sum("n"))
    assert rows(made.drop("Value", "Percent_Prevalence")) == rows(plain)


def test_unused_keys_are_not_written(spark, lines):
    written = score._profiled_records(spark, lines)
    spells, bookings = F.col("HOSPITAL_SPELL_ID"), F.col("PREGNANCY_ID")
    kept = {r.SETTING_TYPE: (r.spells, r.bookings, r.n) for r in written.groupBy("SETTING_TYPE").agg(F.count(spells).alias("spells"), F.count(bookings).alias("bookings"), F.count("*").alias("n")).collect()}
    assert set(kept) == {"1", "2", "3", None} and kept[None][:2] == (0, 0)
    assert kept["1"][:2] == (kept["1"][2], 0) and kept["2"][:2] == (kept["2"][2], 0) and kept["3"][:2] == (0, kept["3"][2])


RULES = [{"Element_ID": f"{i}", "Element_Logic": f"kind % {i + 1} = 0"} for i in (1, 2, 3)]


def _elements(spark, together=True):
    """Elements of records with two breakdowns, and some that no commissioner has."""
    made = [
        (f"r{i}" if i % 9 else None, i % 7, "2020-01-01" if i % 5 else None, f"p{i % 4}", f"c{i % 5}" if i % 6 else None, "s", "t", "m" if i % 2 else None, f"g{i % 3}")
        for i in range(150)
    ]
    names = ["Date", "Provider_Code", "Commissioner_Code", "Service_Setting", "Activity_Type", "Gender", "Age"]
    records = spark.createDataFrame(made, "RecordID string, kind int, " + ", ".join(f"_dim_{n} string" for n in names))
    records = records.withColumn("_dim_Date", F.col("_dim_Date").cast("date"))
    counts = elements.rule_counts(records, RULES, dims=names)
    long = elements.breakdowns_long(counts, groups=["Gender", "Age"])
    sums = records.groupBy(F.col("_dim_Date").alias("Date"), F.col("_dim_Provider_Code").alias("Provider_Code")).agg(F.nullif(F.sum("kind"), F.lit(3)).alias("Value"))
    other = elements._as_total(sums, F.lit("2.0"), F.lit("s"), F.lit("t"))
    return long, elements.assemble_elements(long, other, together=together)


def _plain(df):
    """The same rows as a frame that carries nothing."""
    return df.select("*")


def test_counts_side_by_side_give_the_same_breakdowns_and_metrics(spark, rows, no_broadcast, monkeypatch):
    monkeypatch.setattr(elements, "TASK_ROWS", 30)
    defs = spark.createDataFrame(ROLL_DEFS, DEFS)
    long, together = _elements(spark)
    form = elements.counted_form(long)
    counts = form.unpacked(form.rows, ["Date", "Provider_Code", "Commissioner_Code", "Service_Setting", "Activity_Type", "Gender", "Age"])
    assert rows(long) == rows(elements.breakdowns_long(_plain(counts), groups=["Gender", "Age"]))
    made, plain = metrics.ratio_metrics(together, defs), metrics.ratio_metrics(_plain(together), defs)
    assert rows(made) == rows(plain)
    assert rows(metrics.hierarchy_rollup(made, *_dimensions(spark))) == rows(metrics.hierarchy_rollup(plain, *_dimensions(spark)))
    # Rows become a row per breakdown where they are summed, and are not dealt again in between.
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Generate inline(CASE WHEN _broken" in plan
    assert "Exchange" not in plan[: plan.index("Union")]


def test_rollup_deals_rows_that_are_not_broken_down(spark, rows, no_broadcast, monkeypatch):
    made = metrics.ratio_metrics(_elements(spark, together=False)[1], spark.createDataFrame(ROLL_DEFS, DEFS))
    copied = rows(metrics.hierarchy_rollup(made, *_dimensions(spark)))
    assert copied == rows(metrics.hierarchy_rollup(_plain(made), *_dimensions(spark)))
    written = []
    kept = metrics.settle
    monkeypatch.setattr(metrics, "settle", lambda df, *how: written.append(df) or kept(df, *how))
    monkeypatch.setattr(metrics, "fits", lambda df, rows=0: False)
    assert rows(metrics.hierarchy_rollup(made, *_dimensions(spark))) == copied
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline(CASE WHEN _broken") < plan.index("RepartitionByExpression")  # above it, so after it


def test_own_rows_are_named_where_they_lie(spark, rows, no_broadcast, monkeypatch):
    defs = spark.createDataFrame(ROLL_DEFS, DEFS)
    made = metrics.ratio_metrics(elements.breakdowns_long(_counts(spark), groups=["Age"]), defs)
    dims = spark.createDataFrame([("Provider", "p0", "a"), ("Provider", "p0", "b"), ("Commissioner", "c1", "e"), ("ICB", "N1", "c"), ("National", "ENG", "d")], "Level string, Org_Code string, Org_Name string")
    copied = rows(dimensions.decorate_by_level(metrics.hierarchy_rollup(made, *_dimensions(spark)), dims))
    for part in (metrics, dimensions):
        monkeypatch.setattr(part, "fits", lambda df, rows=0: False)
    rolled = metrics.hierarchy_rollup(made, *_dimensions(spark))
    named = dimensions.decorate_by_level(rolled, dims)
    assert rows(named) == copied
    assert rows(dimensions.decorate_by_level(metrics.where(rolled, F.col("Date").isNotNull()), dims)) == [r for r in copied if r[1] is not None]
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    assert not spark.catalog.listTables()


def test_only_the_presence_of_a_record_id_is_looked_up_with_it(spark, no_broadcast):
    columns = "RecordID ETHNICITY LSOA_OF_RESIDENCE ACTIVITY_DATE ODS_CODE SubICB_Code SETTING_TYPE ACTIVITY_TYPE GENDER Der_Age_at_CDS_Activity_Date".split()
    records = spark.createDataFrame([("r1", "A", "L1", None, "P", "C", "1", "1", "1", "30")], ", ".join(f"{c} string" for c in columns))
    records = records.withColumn("ACTIVITY_DATE", F.col("ACTIVITY_DATE").cast("date"))
    areas = spark.range(60_000).select(F.concat(F.lit("L"), "id").alias("LSOA_Code"), F.lit("2").alias("IMD_Decile"))
    labels = spark.createDataFrame([("A", "British")], "Main_Code_Text string, Main_Description string")
    counts = elements.rule_counts(elements.categorise(records, labels, areas), [{"Element_ID": "1", "Element_Logic": "IMD_Decile = '2'"}], dims=["Provider_Code"])
    assert [tuple(r) for r in counts.collect()] == [("001", "P", 1)]
    dealt = next(line for line in counts._jdf.queryExecution().optimizedPlan().toString().split("\n") if "_spread" in line and "Project" in line)
    assert "_has_RecordID" in dealt and " RecordID" not in dealt.replace("isnotnull(RecordID", "")


def test_candidates_are_looked_up_once_per_set(spark, rows, no_broadcast, monkeypatch):
    codes = ["a", "=a", "", None, "none", "b"]
    made = [(i, codes[i % 6], codes[i // 6 % 6], codes[i // 36 % 4]) for i in range(300)]
    df = settle(spark.createDataFrame([*made, *[(-i, "none", None, "x") for i in range(1, 60)]], "n int, x string, y string, z string"))
    ref = spark.createDataFrame([("a",), ("a",), ("b",), ("",), (None,)], "code string")
    plain = rows(ingest.waterfall_lookup(df, ["x", "y", "z"], ref, "code", "found"))
    some = df.filter("n % 2 = 0")
    for part in (ingest, joins):
        monkeypatch.setattr(part, "fits", lambda df, rows=0: False)
    monkeypatch.setattr(ingest, "HOT_ROWS", 50)
    once = ingest.waterfall_lookup(some, ["x", "y", "z"], ref, "code", "found", source=df)
    assert rows(once) == [r for r in plain if r[0] % 2 == 0]
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1
    monkeypatch.setattr(joins, "fits", lambda df, rows=0: "_hot" in df.columns)  # hot sets alone are copied
    assert rows(ingest.waterfall_lookup(some, ["x", "y", "z"], ref, "code", "found", source=df)) == [r for r in plain if r[0] % 2 == 0]


def test_grid_writes_only_the_rows_of_its_level(spark, monkeypatch):
    shown = {"Metric_ID": "M1", "Service_Setting": "s", "Activity_Type": "t", "Aggregation_Source": "Provider"}
    made = [{**shown, "Level": level, "Org_Code": org, "Numerator": n} for level, org, n in [("ICB", "N1", 5), ("Provider", "p1", 10), ("Provider", "p2", 15)]]
    published = spark.createDataFrame([tuple(r.get(f.name) for f in DASHBOARD_METRICS) for r in made], DASHBOARD_METRICS)
    published = published.withColumn("Date", F.lit("2022-08-01").cast("date"))
    places = spark.createDataFrame([("N1", "a", "b", "R", "c", "d"), ("N2", "a", "b", "R", "c", "d")], "ICB_Code string, ICB_Name string, ICB_Map string, Region_Code string, Region_Name string, Region_Map string")
    texts = [f"{s}_Element_{t}" for s in ("Numerator", "Denominator") for t in ("Description", "Source", "Logic")]
    defs = spark.createDataFrame([("M1", *["x"] * 10)], ", ".join(f"{c} string" for c in ["Metric_ID", "Metric_Name", "Metric_Category", "Metric_Type", "Metric_Setting", *texts]))
    written, kept = [], publish.settle
    monkeypatch.setattr(publish, "settle", lambda df: written.append(kept(df)) or written[-1])
    dense = publish.densify_grid(published, places, defs)
    assert sorted((r.Level, r.Org_Code, r.Numerator) for r in dense.collect()) == [("ICB", "N1", 5), ("ICB", "N2", None), ("Provider", "p1", 10), ("Provider", "p2", 15)]
    assert [w.select("Org_Code").collect() for w in written] == [[("N1",)]]
