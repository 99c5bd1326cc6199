"""Edge rows of each operator: nulls, ties, thresholds."""

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from tallyboard import contracts, spec
from tallyboard.functions.columns import band_label, element_id, period_month, suppress_and_round, suppressed_flag
from tallyboard.functions import joins
from tallyboard.operators import dimensions, elements, ingest, metrics, publish, quality, scorecard

D = dt.date


@pytest.fixture
def make(spark):
    return lambda data, schema: spark.createDataFrame(data, schema)


# --- ingest ---------------------------------------------------------------------


def test_ingest_reads_dates_and_nulls_bad_text(make, rows):
    df = make([("1", "2022-8-1", "x"), ("2", "soon", "y"), ("3", None, "z")], "id string, day string, more string")
    assert rows(ingest.ingest_records(df, ["id", "day"], ["day"])) == [("1", D(2022, 8, 1)), ("2", None), ("3", None)]


def test_remap_fans_out_over_several_successors(make, rows):
    df = make([("A",), ("B",), ("C",), (None,)], "code string")
    xref = make([("B", "B2"), ("B", "B2"), ("C", "C1"), ("C", "C2"), ("A", None)], "old string, new string")
    assert rows(ingest.remap_codes(df, "code", xref, "old", "new")) == [(None,), ("A",), ("B2",), ("C1",), ("C2",)]


def test_known_bad_uses_three_valued_logic(make, rows):
    df = make([("x", "bad"), (None, "bad"), (None, "ok"), ("x", "ok"), ("y", "bad"), ("x", None)], "c string, p string")
    kept = rows(ingest.exclude_known_bad(df, {"c": "x", "p": "bad"}))
    assert kept == [(None, "ok"), ("x", "ok"), ("y", "bad")]


def test_waterfall_takes_the_first_known_candidate(make, rows):
    df = make([(1, "a", "b", "c"), (2, "q", "b", "c"), (3, None, "q", "c"), (4, "q", None, "q")], "id int, x string, y string, z string")
    ref = make([("a",), ("b",), ("b",), ("c",), (None,)], "code string")
    out = ingest.waterfall_lookup(df, ["x", "y", "z"], ref, "code", "found")
    assert rows(out, "id", "found") == [(1, "a"), (2, "b"), (3, "c"), (4, None)]


def test_first_event_folds_case_and_bounds_dates(make, rows):
    df = make(
        [("o", "p1", D(2020, 5, 1)), ("o", "P1", D(2020, 4, 1)), ("o", "p1", D(2019, 1, 1)), ("o", "p2", D(2019, 1, 1))],
        "org string, key string, day date",
    )
    assert rows(ingest.first_event_per_key(df, "org", "key", "day", "2020-01-01", "first")) == [("o", "P1", D(2020, 4, 1))]


def test_activity_extract_pushes_filters_to_the_scan(make, tmp_path, spark):
    make([("0", D(2020, 5, 1))], "deleted string, day date").write.parquet(str(tmp_path / "a"))
    out = ingest.activity_extract(spark.read.parquet(str(tmp_path / "a")), "day", "2020-01-01", [F.col("deleted") == "0"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day" in plan and "EqualTo(deleted,0)" in plan


# --- quality --------------------------------------------------------------------


@pytest.fixture(params=["broadcast", "shuffled", "all groups hot"])
def path(request, monkeypatch):
    """Run the group statistics on each of their paths."""
    defaults = {"broadcast": (None, 50_000, 1_000_000), "shuffled": (None, 0, 1_000_000), "all groups hot": (None, 0, 1)}[request.param]
    monkeypatch.setattr(joins.attach_group_stats, "__defaults__", defaults)


def test_superseded(make, rows, path):
    df = make(
        [
            (1, "a", "s", "1"), (2, "a", "s", "2"), (3, "a", "s", "2"), (4, "a", "s", None),
            (5, "b", "s", "9"), (6, "b", "s", "10"),
            (7, None, "s", "1"), (8, None, "s", "2"),
            (9, "c", "s", None), (10, "c", "s", None), (11, "d", "s", "5"),
        ],
        "id int, person string, spell string, version string",
    )
    flags = dict(rows(quality.flag_superseded(df, ["person", "spell"], "version", "f"), "id", "f"))
    assert {i for i, f in flags.items() if f == 1} == {1, 4, 6}
    assert len(flags) == 11


def test_superseded_compares_numbers_as_numbers(make, rows):
    df = make([(1, "b", 9), (2, "b", 10)], "id int, k string, version int")
    assert rows(quality.flag_superseded(df, ["k"], "version", "f"), "id", "f") == [(1, 1), (2, 0)]


def test_singletons(make, rows, path):
    df = make([(1, "a", "p"), (2, "a", "q"), (3, "b", "p"), (4, "b", "p"), (5, None, "p")], "id int, o string, p string")
    assert rows(quality.flag_singletons(df, ["o", "p"], "f"), "id", "f") == [(1, 1), (2, 1), (3, 0), (4, 0), (5, 0)]


def test_summary_lists_the_issues_found(make, rows):
    df = make([(1, 0, 0), (2, 1, 0), (3, 1, 1)], "id int, a int, b int")
    out = quality.quality_summary(df, {"a": "[A]", "b": "[B]"}, "none")
    assert rows(out, "id", "DQ_Flag", "DQ_Description") == [(1, 0, "none"), (2, 1, "[A]"), (3, 1, "[A][B]")]


def test_missing(make, rows):
    df = make([(1, None), (2, "x")], "id int, c string")
    assert rows(quality.flag_missing(df, "c", "f"), "id", "f") == [(1, 1), (2, 0)]


# --- categories and elements -----------------------------------------------------


def test_age_bands_leave_44_out(make, rows):
    ages = ["17", "18", "34", "35", "43", "44", "45", "59", "60", None, "old", "17.5"]
    df = make([(a,) for a in ages], "age string")
    got = [r[0] for r in df.select(band_label(F.col("age"), spec.AGE_BANDS, spec.AGE_ELSE)).collect()]
    assert got == [
        "Under 18", "18-34", "18-34", "35-44", "35-44", "Unknown", "45-59", "45-59", "60 and over", "Unknown", "Unknown", "Under 18",
    ]


def test_period_month_and_element_id(make):
    df = make([("P-08-2022", "1"), ("x", "001"), (None, None), ("P-13-2022", "1234"), ("P-01-2023", "a")], "p string, e string")
    got = df.select(period_month(F.col("p")), element_id(F.col("e"))).collect()
    assert [r[0] for r in got] == [D(2022, 8, 1), None, None, None, D(2023, 1, 1)]
    assert [r[1] for r in got] == ["001", "001", None, "1234", "a"]


def _records(make):
    schema = "RecordID string, ODS_CODE string, SubICB_Code string, SETTING_TYPE string, ACTIVITY_TYPE string, ACTIVITY_DATE date, GENDER string, ETHNICITY string, LSOA_OF_RESIDENCE string, Der_Age_at_CDS_Activity_Date string"
    day = D(2022, 8, 20)
    return make(
        [
            ("1", "P", "C", "1", "1", day, "1", "A", "L1", "44"),
            ("2", "P", "C", "3", "9", day, "9", "Z", "nowhere", "17"),
            (None, "P", "C", "2", "4", day, "3", "D", "L2", None),
        ],
        schema,
    )


def _categorised(make):
    eth = make([("A", "British"), ("A", "British"), ("D", "Mixed")], "Main_Code_Text string, Main_Description string")
    areas = make([("L1", "2"), ("L2", "10")], "LSOA_Code string, IMD_Decile string")
    return elements.categorise(_records(make), eth, areas)


def test_categorise(make, rows):
    got = rows(elements.dimensions(_categorised(make), keep=["SETTING_TYPE"]))
    assert got == [
        ("1", D(2022, 8, 1), "P", "C", "All other services", "Acute Inpatient", "Male", "Unknown", "British", "White", "Quintile 1 - Most deprived"),
        ("2", D(2022, 8, 1), "P", "C", "All other services", "Specialist Community Mental Health", "Is not stated", "Unknown", "Mixed", "Mixed or multiple ethnic groups", "Quintile 5 - Least deprived"),
        ("3", D(2022, 8, 1), "P", "C", "Maternity services", "Maternity", "Unknown", "Under 18", None, "Is not stated", "Unknown"),
    ]


def test_rules_match_any_number_of_times_in_one_scan(make, rows):
    rules = [
        {"Element_ID": "1", "Element_Logic": "a.GENDER in ('1', '3')"},
        {"Element_ID": "002", "Element_Logic": "IMD_Decile = '2' or Main_Code_Text = 'D'"},
        {"Element_ID": "003", "Element_Logic": "nullif(GENDER, GENDER) = '1'"},
    ]
    df = elements.rule_counts(_categorised(make), rules, dims=["Provider_Code", "Service_Setting"])
    assert rows(df, "Element_ID", "Value") == [("001", 1), ("002", 1)]
    by_gender = elements.rule_counts(_categorised(make), rules, dims=["Gender"])
    assert ("001", "Is not stated", 0) in rows(by_gender)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate inline") == 1 and plan.count("partial_sum(_rule_0") == 1
    assert elements.rule_counts(_categorised(make), []).count() == 0


def test_many_rules_and_repeated_ids(make, rows):
    rules = [{"Element_ID": str(i), "Element_Logic": f"length(ETHNICITY) + {i} > 100 or GENDER = '{i % 4}'"} for i in range(300)]
    df = elements.rule_counts(_categorised(make), rules, dims=["Provider_Code"])
    few = elements.rule_counts(_categorised(make), rules, dims=["Provider_Code"], block=7)
    assert rows(df) == rows(few) and df.count() > 200
    twice = [{"Element_ID": "1", "Element_Logic": "true"}, {"Element_ID": "001", "Element_Logic": "true"}]
    one = elements.rule_counts(_categorised(make), twice[:1], dims=["Provider_Code"])
    both = elements.rule_counts(_categorised(make), twice, dims=["Provider_Code"])
    assert [(e, p, 2 * n) for e, p, n in rows(one)] == rows(both)


def test_rules_compare_bad_text_as_null(make, rows, spark):
    rules = [{"Element_ID": "1", "Element_Logic": "ETHNICITY = 7"}, {"Element_ID": "2", "Element_Logic": "ETHNICITY = 7 or GENDER > 0"}]
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    got = rows(elements.rule_counts(_categorised(make), rules, dims=["Provider_Code"]), "Element_ID")
    assert got == [("002",)]
    assert spark.conf.get("spark.sql.ansi.enabled") == ansi


def test_breakdowns_keep_a_null_subgroup_apart(make, rows):
    df = make([("e", "x", None, 3), ("e", "x", "p", 2), ("e", "y", "p", 4)], "Element_ID string, Date string, Ethnicity string, Value bigint")
    out = elements.breakdowns_long(df, ["Date"], ["Ethnicity"])
    assert rows(out) == [
        ("e", "x", "Ethnicity", None, 3), ("e", "x", "Ethnicity", "p", 2), ("e", "x", "Total", "Total", 5),
        ("e", "y", "Ethnicity", "p", 4), ("e", "y", "Total", "Total", 4),
    ]


def test_wide_measures_keep_null_groups_and_known_orgs(make, rows):
    df = make([("P-08-2022", "A", "1", None), ("P-08-2022", "A", "2", None), ("P-08-2022", "B", "5", "x")], "p string, ODS_Code string, m string, n string")
    orgs = make([("A",), ("A",)], "ODS_Code string")
    mapping = {"m": ("001", "s", "a1"), "n": ("001", "s", "a2")}
    out = elements.wide_measures_to_elements(df, mapping, orgs, period_month(F.col("p")))
    assert rows(out, "Provider_Code", "Activity_Type", "Value") == [("A", "a1", 3.0), ("A", "a2", None)]


def test_activity_scopes(make):
    acute = make(
        [("1", 16, "1", "100"), ("1", 15, "1", "100"), ("1", 40, "4", "100"), ("1", 40, None, "100"), ("1", 40, "1", None), ("2", 40, "1", "100"), ("1", 40, "1", "424")],
        "Patient_Classification string, Age_At_Start_of_Spell_SUS int, Discharge_Method string, Der_Admit_Treatment_Function_Code string",
    )
    assert acute.filter(elements.acute_in_scope()).count() == 1
    stays = make([(0, 30), (None, 30), (1, 15), (1, 16)], "LOSDischHosSpell int, Der_Age_at_StartDateHospProvSpell int")
    assert stays.filter(elements.spells_in_scope()).count() == 1


# --- metrics ------------------------------------------------------------------------


def _elements(make, data):
    full = [(e, D(2022, 8, 1), p, c, "s", "a", "Total", "Total", v) for e, p, c, v in data]
    return make(full, contracts.ELEMENTS)


def test_ratio_metrics(make, rows):
    values = _elements(make, [("001", "A", "C", 10.0), ("2", "A", "C", 4.0), ("001", "B", "C", 7.0), ("003", "D", None, None)])
    defs = make(
        [("both", "Proportion", "2", "1"), ("count", "Count", "002", None), ("same", "Proportion", "3", "003")],
        "Metric_ID string, Metric_Type string, Numerator_Element string, Denominator_Element string",
    )
    out = metrics.ratio_metrics(values, defs)
    assert rows(out, "Metric_ID", "Provider_Code", "Numerator", "Denominator") == [
        ("both", "A", 4.0, 10.0), ("both", "B", 0.0, 7.0), ("count", "A", 4.0, None), ("same", "D", None, None),
    ]


def test_rollup_with_missing_and_repeated_orgs(make, rows):
    data = [("m", D(2022, 8, 1), p, c, "s", "a", "Total", "Total", n, 10.0) for p, c, n in [("A", "X", 1.0), ("B", None, 2.0), ("Q", "X", 4.0)]]
    providers = make([("A", "I1", "R1"), ("B", "I1", "R2"), ("B", "I2", "R2")], "ODS_Code string, ICB_Code string, Region_Code string")
    commissioners = make([("X", "I9", "R9")], "Organisation_Code string, ICB_Code string, Region_Code string")
    out = metrics.hierarchy_rollup(make(data, contracts.METRICS), providers, commissioners)
    assert rows(out, "Aggregation_Source", "Level", "Org_Code", "Numerator") == [
        ("Commissioner", "Commissioner", None, 2.0), ("Commissioner", "Commissioner", "X", 5.0),
        ("Commissioner", "ICB", None, 2.0), ("Commissioner", "ICB", "I9", 5.0),
        ("Commissioner", "National", "ENG", 7.0),
        ("Commissioner", "Region", None, 2.0), ("Commissioner", "Region", "R9", 5.0),
        ("Provider", "ICB", None, 4.0), ("Provider", "ICB", "I1", 3.0), ("Provider", "ICB", "I2", 2.0),
        ("Provider", "National", "ENG", 7.0),
        ("Provider", "Provider", "A", 1.0), ("Provider", "Provider", "B", 2.0), ("Provider", "Provider", "Q", 4.0),
        ("Provider", "Region", None, 4.0), ("Provider", "Region", "R1", 1.0), ("Provider", "Region", "R2", 4.0),
    ]


def test_suppression(make):
    df = make([(n,) for n in [None, 0, 1, 4, 5, 7, 8, 12, 13]], "n int")
    got = df.select(suppress_and_round(F.col("n")), suppressed_flag(F.col("n"))).collect()
    assert [r[0] for r in got] == [None, 0, 0, 0, 5, 5, 10, 10, 15]
    assert [r[1] for r in got] == [0, 0, 1, 1, 0, 0, 0, 0, 0]
    big = make([(4_000_000_003,)], "n bigint").select(suppress_and_round(F.col("n"))).first()
    assert big[0] == 4_000_000_005


def test_bands_equal_ntile_with_ties_and_nulls(spark, rows):
    df = spark.range(0, 1200, 1, 4).select(
        F.when(F.col("id") < 400, "big").when(F.col("id") < 403, "tiny").otherwise(F.concat(F.lit("g"), (F.col("id") % 13).cast("string"))).alias("g"),
        F.concat(F.lit("o"), F.col("id").cast("string")).alias("org"),
        F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") % 10) / 10.0).alias("r"),
    )
    order = Window.partitionBy("g").orderBy(F.col("r").asc_nulls_first(), F.md5("org"), "org")
    expected = rows(df.withColumn("q", F.ntile(4).over(order)))
    assert rows(metrics.quantile_bands(df, ["g"], "r", "org", out="q")) == expected
    assert rows(metrics.quantile_bands(df, ["g"], "r", "org", out="q", group_rows=100)) == expected

    banded = metrics.quantile_bands(df, ["g"], "r", "org", out="q")
    by_band = rows(metrics.quantile_cutoffs(banded, ["g"], "r", "q"))
    assert rows(metrics.cutoffs_from_ratios(df, ["g"], "r")) == by_band


def test_cutoffs_of_a_small_group(make, rows):
    df = make([("g", "a", None), ("g", "b", 0.5)], "g string, org string, r double")
    assert rows(metrics.cutoffs_from_ratios(df, ["g"], "r")) == [("g", None, None, None, None, 50.0)]


# --- publishing -----------------------------------------------------------------------


def test_windows(make, rows):
    data = [(1, "m", D(2020, 6, 1)), (2, "m", D(2020, 6, 2)), (3, "o", D(2020, 9, 1)), (4, "o", D(2020, 9, 2)), (5, None, D(2020, 5, 1)), (6, "o", D(2019, 12, 31)), (7, "o", D(2020, 1, 1))]
    df = make(data, "id int, seg string, day date")
    out = publish.reporting_windows(df, "day", "seg", "2020-01-01", "m", "2020-06-01", "2020-09-01")
    assert rows(out, "id") == [(1,), (3,), (7,)]


# --- scorecard ---------------------------------------------------------------------------


def test_grid_is_every_pair_in_every_period(make, rows):
    expected = make([("A", "s", None), ("A", "t", "I9"), ("Z", "s", None)], "Org_Code string, Setting_Type string, Specified_ICB string")
    periods = make([(D(2022, 1, 1),), (D(2022, 2, 1),)], "Reporting_Period date")
    ref = make([("A", "Alpha", "R1", "I1")], "Organisation_Code string, Organisation_Name string, National_Grouping_Code string, High_Level_Health_Authority_Code string")
    grid = scorecard.submission_grid(expected, periods, ref)
    assert grid.count() == 6
    assert ("A", "t", "Alpha", "R1", "I9") in rows(grid, "Org_Code", "Setting_Type", "Organisation_Name", "Region_Code", "ICB_Code")
    assert ("Z", None, None) in rows(grid, "Org_Code", "Organisation_Name", "ICB_Code")


def test_prior_submissions(make, rows):
    months = [D(2022, m, 1) for m in (1, 2, 3)]
    grid = make([(m, o) for m in months for o in ("A", "B", None)] + [(None, "A")], "Reporting_Period date, Org_Code string")
    sent = make(
        [(months[0], "A"), (months[0], "Axx"), (months[1], "A"), (months[2], "B"), (None, "A"), (months[0], None)],
        "Reporting_Period date, OrganisationCode string",
    )
    short = F.left("OrganisationCode", F.lit(1))
    out = scorecard.prior_submission_count(grid, sent, short)
    assert {(r[0], r[1]): r[2] for r in rows(out)} == {
        (months[0], "A"): 0, (months[1], "A"): 1, (months[2], "A"): 2, (None, "A"): 0,
        (months[0], "B"): 0, (months[1], "B"): 0, (months[2], "B"): 0,
        (months[0], None): 0, (months[1], None): 0, (months[2], None): 0,
    }
    longer = make([(months[0], "RAB01")], "Reporting_Period date, OrganisationCode string")
    cell = make([(months[1], "RAB")], "Reporting_Period date, Org_Code string")
    assert rows(scorecard.prior_submission_count(cell, longer), "Count_Previous_Submissions") == [(1,)]


def test_setting_totals_read_null_as_zero(make, rows):
    df = make([("P-08-2022", "A", "1", None), ("P-08-2022", "A", None, None)], "p string, ODS_Code string, m string, n string")
    out = scorecard.setting_totals(df, {"one": ["m", "n"], "two": ["n"]}, period_month(F.col("p")))
    assert rows(out, "Setting_Type", "Value") == [("one", 1.0), ("two", 0.0)]


def test_profile_links_by_case_folded_keys_once(make, rows):
    fields = "REPORTING_PERIOD ODS_CODE ODS_Name SETTING_TYPE ACTIVITY_TYPE HOSPITAL_SPELL_ID PREGNANCY_ID SMOKINGSTATUS SEEN_INHOUSE TOBACCODEPENDENCE_CAREPLAN INHOUSE_REFERRAL OUTCOME_AT28DAYS Der_Age_at_CDS_Activity_Date Person".split()

    def rec(setting, spell, preg, age, person, seen="N", plan=None, outcome=None):
        return ("P-08-2022", "A", "Alpha", setting, "1", spell, preg, "1", seen, plan, "N", outcome, age, person)

    data = [
        rec("1", "s1", None, "9", "p"), rec("1", "S1", None, "10", "p"), rec("1", "none", None, "120", "q"), rec("1", None, None, "121", None),
        rec("3", "s1", "b1", "60", "p", "Y", "20", "4"), rec("3", "s1", "zz", "61", "r", "Y", None, "4"),
    ]
    admissions = make([("A", "s1"), ("A", "S1"), ("B", "none")], "org string, key string")
    bookings = make([("A", "B1")], "org string, key string")
    links = scorecard.link_keys({"1": (admissions, "org", "key"), "3": (bookings, "org", "key")})
    assert links.count() == 3
    dim = make([("A", "R1", "I1")], "ODS_Code string, Region_Code string, ICB_Code string")
    records = make(data, ", ".join(f"{f} string" for f in fields))
    out = scorecard.record_quality_profile(records, links, dim, "Person")
    got = rows(out, "Setting_Type", "Count_Records", "Count_Unique_Patients", "Percent_Records_Linkable", "Percent_CarePlan_Complete", "Percent_LTFU", "Percent_Age_Range", "ODS_Code_Name")
    assert got == [
        ("Maternity", 2, 2, 0.5, 0.5, 1.0, 0.5, "A: Alpha"),
        ("Physical Acute", 4, 2, 0.5, None, None, 0.5, "A: Alpha"),
    ]


def test_rolling_rate_counts_rows_not_months(make, rows):
    months = [D(2020 + (m // 12), m % 12 + 1, 1) for m in range(14)]
    del months[5]  # a month without activity is not filled in
    activity = make([("s", "A", m, 10 * (i + 1)) for i, m in enumerate(months)], "Source string, Org_Code string, Date date, Activity bigint")
    wanted = [D(2020, 1, 1), D(2020, 2, 1), D(2021, 2, 1), D(2021, 3, 1)]
    totals = make([(m, "A", "s", 65.0) for m in wanted], "Reporting_Period date, ODS_Code string, Setting_Type string, Value double")
    out = scorecard.lagged_rolling_rate(totals, activity)
    assert rows(out, "Reporting_Period", "Activity", "Percent_Identification") == [
        (wanted[0], None, None), (wanted[1], 10, 6.5), (wanted[2], 120, 1.0), (wanted[3], 130, 0.87),
    ]


def _wide(make, data):
    columns = [c for _, _, c, _, _ in spec.SCORE_CHECKS]
    schema = (
        "Reporting_Period date, Org_Code string, Organisation_Name string, Setting_Type string, Region_Code string, ICB_Code string, "
        "SDCS_Submission_Complete string, Count_Previous_Submissions bigint, " + ", ".join(f"{c} double" for c in columns)
    )
    df = make([(D(2022, 1, 1), str(i), "n", "s", "R", "I", sent, prior, *values) for i, (sent, prior, values) in enumerate(data)], schema)
    score = sum((F.when(scorecard._passes(c, t, v), 1).otherwise(0) for _, _, c, t, v in spec.SCORE_CHECKS), F.lit(0))
    return df.withColumn("Count_Passes", score)


def test_thresholds_grades_and_long_form(make, rows):
    limits = [float(v) for *_, v in spec.SCORE_CHECKS]
    passing = [v - 0.01 if t == "<" else v for (*_, t, v) in spec.SCORE_CHECKS]
    passing = [float(v) for v in passing]
    failing = [3.0, 3.0, 3.0, 0.0, 0.0, 1.0, 0.0, 0.9, 2.0, 0.0]
    data = [
        ("Complete", 0, passing), ("Complete", 0, limits), ("Complete", 0, failing), ("Complete", 0, [None] * 10),
        (None, 2, passing), (None, 0, failing), (None, None, [None] * 10),
        ("Complete", 0, [10.0] + failing[1:]),
    ]
    wide = _wide(make, data)
    graded = rows(scorecard.grade(wide), "Org_Code", "Count_Passes", "Grade")
    assert graded == [
        ("0", 10, "A"), ("1", 8, "B8"), ("2", 0, "C0"), ("3", 0, "CX"), ("4", 10, "DP"), ("5", 0, "D0"), ("6", 0, "D0"), ("7", 1, "B1"),
    ]
    icb = make([("I", "ICB")], "ICB_Code string, ICB_Name string")
    region = make([("other", "North")], "Region_Code string, Region string")
    long = scorecard.scorecard_long(wide, icb, region)
    assert long.count() == 11 * len(data)
    assert rows(long.filter("Org_Code = '2' and Metric_Type = 'Count' and Metric_Name != 'DQ Score'"), "Value", "DQ_Check") == [(0.0, "Fail")] * 3
    assert {r[0] for r in rows(long, "Region_Code")} == {None} and {r[0] for r in rows(long, "ICB_Name")} == {"ICB"}


# --- dimensions ------------------------------------------------------------------------------


def test_provider_dimension_overrides_single_fields(make, rows):
    ref = make([("A", "Alpha", "I1", "R1"), ("B", "Beta", "I1", "R1")], "Organisation_Code string, Organisation_Name string, High_Level_Health_Authority_Code string, National_Grouping_Code string")
    icb = make([("I1", "One", "m1"), ("I2", "Two", "m2")], "ICB_Code string, ICB_Name string, ICB_Map string")
    region = make([("R1", "North", "r1")], "Region_Code string, Region string, Region_Map string")
    over = make([("B", None, "I2", None), ("C", "Gamma", None, "R1")], "Code string, Name string, ICB string, Region string")
    records = make([("A",), ("A",), ("B",), ("C",), ("D",)], "ODS_CODE string")
    out = dimensions.provider_dimension(records, ref, icb, region, over)
    assert rows(out, "ODS_Code", "ODS_Name", "ICB_Code", "ICB_Name", "Region_Name") == [
        ("A", "Alpha", "I1", "One", "North"), ("B", "Beta", "I2", "Two", "North"), ("C", "Gamma", None, None, "North"), ("D", None, None, None, None),
    ]


def test_decoration_depends_on_the_level(make, rows):
    providers = make([("A", "Alpha", "I1", "One", "m", "R1", "North", "r")], "ODS_Code string, ODS_Name string, ICB_Code string, ICB_Name string, ICB_Map string, Region_Code string, Region_Name string, Region_Map string")
    buyers = make([("A", "Buyer", "I1", "One", "m", "R1", "North", "r")], "Organisation_Code string, Organisation_Name string, ICB_Code string, ICB_Name string, ICB_Map string, Region_Code string, Region_Name string, Region_Map string")
    dims = dimensions.level_dimension(providers, buyers, "ENG", "England")
    df = make([("Provider", "A"), ("Commissioner", "A"), ("ICB", "I1"), ("Region", "R1"), ("National", "ENG"), ("ICB", None)], "Level string, Org_Code string")
    assert rows(dimensions.decorate_by_level(df, dims), "Level", "Org_Name", "ICB_Code", "Region_Code") == [
        ("Commissioner", "Buyer", "I1", "R1"), ("ICB", None, None, None), ("ICB", "One", "I1", "R1"),
        ("National", "England", None, None), ("Provider", "Alpha", "I1", "R1"), ("Region", "North", None, "R1"),
    ]


def test_element_ids_agree_as_numbers(make):
    given = ["1", " 01", "001", "0001", "1.0", "12.0", "0", "000", "1234", "01234", "1.5", "x1", None, ""]
    df = make([(v,) for v in given], "e string").select(element_id(F.col("e")).alias("e"))
    assert [r.e for r in df.collect()] == ["001"] * 5 + ["012", "000", "000", "1234", "1234", "1.5", "x1", None, ""]


def test_doubled_keys_are_named(make):
    from tallyboard.functions.joins import check_unique

    table = make([("a", 1), ("b", 2)], "code string, n int")
    assert check_unique(table, ["code"]) is table
    with pytest.raises(ValueError, match="places repeats keys.*'a'"):
        check_unique(table.union(table.filter("n = 1")), ["code"], "places")


def test_settled_frames_are_deleted(make, spark):
    from tallyboard.sources.session import release_settled, settle

    kept = settle(make([(1,)], "n int"))
    path = kept.inputFiles()[0]
    assert kept.count() == 1 and release_settled(spark) >= 1
    jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm)


def test_tables_are_laid_out_by_month(make, tmp_path):
    from tallyboard.sources.files import write_table

    rows_ = make([(f"2024-{m:02d}", i) for i in range(50) for m in range(1, 13)], "month string, n int").repartition(7)
    written = write_table(rows_, str(tmp_path / "t"), ["month"])
    spans = written.groupBy(F.input_file_name()).agg(F.countDistinct("month").alias("months")).collect()
    assert written.count() == 600 and sum(r.months for r in spans) == 12
