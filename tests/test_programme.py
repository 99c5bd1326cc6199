"""All stages over a small set of files, checked against figures counted by hand."""

import csv
import datetime as dt

import pytest

from tallyboard import contracts, spec
from tallyboard.plans import programme

AUGUST, SEPTEMBER = dt.date(2023, 8, 1), dt.date(2023, 9, 1)


def record(i, org="AAA", month="08", **changes):
    row = dict.fromkeys(spec.RECORD_COLUMNS)
    row.update(
        RecordID=str(i), AuditID="1", REPORTING_PERIOD=f"P-{month}-2023", ODS_CODE=org, ODS_Name=f"Org {org}",
        SETTING_TYPE="1", ACTIVITY_TYPE="1", ACTIVITY_DATE=f"2023-{month}-15", HOSPITAL_SPELL_ID=f"s{i}",
        GENDER="1", ETHNICITY="A", SMOKINGSTATUS="1", INHOUSE_REFERRAL="Y", SEEN_INHOUSE="Y",
        TOBACCODEPENDENCE_CAREPLAN="20", OUTCOME_AT28DAYS="1", CCG_OF_REGISTRATION="C1", LSOA_OF_RESIDENCE="L1",
        Der_Age_at_CDS_Activity_Date="40",
    )
    row[spec.PERSON] = f"n{i}"
    row.update(changes)
    return tuple(row[c] for c in spec.RECORD_COLUMNS)


def write_csv(path, header, lines):
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([header, *lines])
    return str(path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("programme")

    def parquet(name, lines, schema, nested=False):
        path = base / name
        target = path / "y=2023" / "x" if nested else path
        spark.createDataFrame(lines, schema).write.parquet(str(target))
        return str(path)

    records = [record(i) for i in range(12)]
    records += [record(20 + i, month="09", GENDER="2") for i in range(6)]
    records += [record(30 + i, org="OLD") for i in range(5)]  # becomes BBB
    records += [
        record(40, AuditID="0", HOSPITAL_SPELL_ID="s0", **{spec.PERSON: "n0"}),  # superseded by record 0
        record(41, ACTIVITY_DATE="soon"),
        record(42, SETTING_TYPE=None),
        record(43, org="CCC"),  # only one of its organisation and period
        record(44, org=spec.KNOWN_BAD["ODS_CODE"], REPORTING_PERIOD=spec.KNOWN_BAD["REPORTING_PERIOD"]),
    ]
    text = ", ".join(f"{c} string" for c in spec.RECORD_COLUMNS)
    wide = sorted({c for cs in spec.AGGREGATE_TOTALS.values() for c in cs} | set(spec.AGGREGATE_ELEMENTS))
    day = dt.date(2023, 7, 3)
    rule = ["n", "Element_ID", "c2", "Element_Source", "Reporting_Flag", "c5", "Element_Logic"]
    definition = (
        "a,b,Metric_ID,Metric_Name,Metric_Type,Metric_Category,Metric_Setting,Reporting_Flag,num,"
        "Numerator_Element_Description,Numerator_Element_Source,Numerator_Element_Logic,den,"
        "Denominator_Element_Description,Denominator_Element_Source,Denominator_Element_Logic"
    ).split(",")
    paths = {
        "records": parquet("records", records, text, nested=True),
        "aggregates": parquet(
            "aggregates",
            [("P-08-2023", "AAA", *["10" if c.endswith("_IP") else None for c in wide])],
            "Reporting_Period string, ODS_Code string, " + ", ".join(f"{c} string" for c in wide),
        ),
        "admissions": parquet(
            "admissions",
            [("0", day, "AAA", "1", 40, "1", "100", f"S{i}") for i in range(8)] + [("1", day, "AAA", "1", 40, "1", "100", "S9")],
            "Deleted string, Admission_Date date, Provider_Code string, Patient_Classification string, "
            "Age_At_Start_of_Spell_SUS int, Discharge_Method string, Der_Admit_Treatment_Function_Code string, Hospital_Spell_No string",
        ),
        "spells": parquet(
            "spells", [(day, "AAA", 2, 30, "x")],
            "StartDateHospProvSpell date, OrgIDProv string, LOSDischHosSpell int, Der_Age_at_StartDateHospProvSpell int, HospProvSpellID string",
        ),
        "bookings": parquet(
            "bookings", [("AAA", "p1", day), ("AAA", "P1", day + dt.timedelta(40))],
            "OrgCodeProvider string, PregnancyID string, AntenatalAppDate date",
        ),
        "provider_ref": parquet(
            "provider_ref", [("AAA", "Alpha", "Q1", "Y1", 1, None), ("BBB", "Beta", "Q2", "Y1", 1, None)],
            "Organisation_Code string, Organisation_Name string, High_Level_Health_Authority_Code string, "
            "National_Grouping_Code string, Is_Latest int, Effective_To date",
        ),
        "sub_icb_ref": parquet(
            "sub_icb_ref", [("C1", "Com one", "C1: Com one", "Q1", "ICB one", "Q1: ICB one", "Q1", "Y1", "Y1: North", None)],
            "Organisation_Code string, Organisation_Name string, Organisation_Code_Name string, STP_Code string, STP_Name string, "
            "STP_Code_Name string, ICB_Code string, Region_Code string, Region_Code_Name string, Effective_To date",
        ),
        "ethnicity_ref": parquet("ethnicity_ref", [("A", "British", "1")], "Main_Code_Text string, Main_Description string, Is_Latest string"),
        "deprivation_ref": parquet(
            "deprivation_ref", [("L1", "2", dt.date(2019, 12, 31)), ("L1", "9", dt.date(2015, 12, 31))],
            "LSOA_Code string, IMD_Decile string, Effective_Snapshot_Date date",
        ),
        "icb_ref": write_csv(base / "icb.csv", ["ICB_Code", "ICB_Name", "ICB_Map"], [["Q1", "ICB one", "m1"], ["Q2", "ICB two", "m2"]]),
        "region_ref": write_csv(base / "region.csv", ["Region_Code", "Region", "Region_Map"], [["Y1", "North", "r1"]]),
        "expected_providers": write_csv(
            base / "expected.csv", ["Org_Code", "Org_Code_Current", "Setting_Type", "Specified_ICB", "DQ_Flag"],
            [["AAA", "AAA", "Physical Acute", "", "1"], ["OLD", "BBB", "Physical Acute", "Q1", "1"], ["ZZZ", "ZZZ", "Maternity", "", "0"]],
        ),
        "submission_log": write_csv(
            base / "log.csv", ["ReportingPeriod", "OrganisationCode", "StatusofSubmission"],
            [["P-08-2023", "AAA", "Complete"], ["P-08-2023", "BBB", "Draft"]],
        ),
        "element_rules": write_csv(
            base / "rules.csv", rule,
            [
                ["1", "2", "", spec.RECORD_ELEMENT_SOURCE, "1", "", "a.SMOKINGSTATUS is not null"],
                ["2", "3", "", spec.RECORD_ELEMENT_SOURCE, "1", "", "Gender = '2' and Der_Age_at_CDS_Activity_Date >= 18"],
                ["3", "9", "", spec.RECORD_ELEMENT_SOURCE, "0", "", "true"],
            ],
        ),
        "metric_defs": write_csv(
            base / "defs.csv", definition,
            [
                ["", "", "T1", "Women", "Proportion", "Use", "All", "1", "3", "w", "s", "l", "2", "a", "s", "l"],
                ["", "", "T2", "Ward", "Count", "Use", "All", "1", "10", "w", "s", "l", "", "", "", ""],
            ],
        ),
    }
    settings = programme.Settings(
        inputs=paths, work=str(base / "work"), export=str(base / "out"),
        min_date="2023-01-01", max_date_maternity="2023-12-31", max_date_ip="2023-12-31",
    )
    return settings, programme.run(spark, settings)


def test_clean_set_drops_each_kind_of_issue(tables, rows):
    _, t = tables
    kept = {int(r[0]) for r in rows(t["clean_records"], "RecordID")}
    assert kept == set(range(12)) | set(range(20, 26)) | set(range(30, 35))
    assert {r[0] for r in rows(t["clean_records"], "ODS_CODE")} == {"AAA", "BBB"}
    assert {r[0] for r in rows(t["clean_records"], "SubICB_Code")} == {"C1"}


def test_elements_from_all_three_kinds_of_source(tables, rows):
    _, t = tables
    totals = t["elements"].filter("Health_Inequalities_Group = 'Total'")
    got = rows(totals, "Element_ID", "Date", "Provider_Code", "Activity_Type", "Value")
    assert ("002", AUGUST, "AAA", "Acute Inpatient", 12.0) in got
    assert ("002", AUGUST, "BBB", "Acute Inpatient", 5.0) in got
    assert ("003", SEPTEMBER, "AAA", "Acute Inpatient", 6.0) in got
    assert ("001", AUGUST, "AAA", "Acute Inpatient", 10.0) in got
    assert ("001", AUGUST, "AAA", "Maternity", None) in got
    assert ("010", dt.date(2023, 7, 1), "AAA", "Acute Inpatient", 8.0) in got
    assert ("010", dt.date(2023, 7, 1), "AAA", "Maternity", 1.0) in got
    assert not [r for r in got if r[0] == "009"]
    quintile = t["elements"].filter("Health_Inequalities_Group = 'IMD_Quintile' and Provider_Code = 'BBB'")
    assert rows(quintile, "Health_Inequalities_SubGroup", "Value") == [("Quintile 1 - Most deprived", 5.0)]


def test_rolled_metrics_add_up_at_every_level(tables, rows):
    _, t = tables
    total = t["rolled_metrics"].filter("Health_Inequalities_Group = 'Total' and Metric_ID = 'T1'")
    national = rows(total.filter("Level = 'National'"), "Date", "Aggregation_Source", "Numerator", "Denominator")
    assert national == [
        (AUGUST, "Commissioner", 0.0, 17.0),
        (AUGUST, "Provider", 0.0, 17.0),
        (SEPTEMBER, "Commissioner", 6.0, 6.0),
        (SEPTEMBER, "Provider", 6.0, 6.0),
    ]
    icb = rows(total.filter("Level = 'ICB' and Aggregation_Source = 'Provider'"), "Date", "Org_Code", "Denominator")
    assert icb == [(AUGUST, "Q1", 12.0), (AUGUST, "Q2", 5.0), (SEPTEMBER, "Q1", 6.0)]


def test_dashboard_has_the_contract_and_a_full_grid(tables, rows, spark):
    settings, t = tables
    table = t["dashboard_metrics"]
    assert table.schema.simpleString() == contracts.DASHBOARD_METRICS.simpleString()
    icb = table.filter("Level = 'ICB'")
    cells = icb.select("Date", "Aggregation_Source", "Service_Setting", "Activity_Type").distinct().count()
    assert icb.count() == 2 * 2 * cells
    shown = table.filter("Metric_ID = 'T1' and Level = 'Provider' and Org_Code = 'AAA'")
    assert rows(shown, "Date", "Numerator", "Denominator", "Org_Name", "ICB_Name", "Region_Name") == [
        (AUGUST, 0, 10, "Alpha", "ICB one", "North"),
        (SEPTEMBER, 5, 5, "Alpha", "ICB one", "North"),
    ]
    exported = spark.read.option("header", "true").csv(f"{settings.export}/dashboard_metrics")
    assert exported.columns == table.columns and exported.count() == table.count()


def test_scorecard_grades(tables, rows):
    _, t = tables
    assert t["scorecard"].schema.simpleString() == contracts.SCORECARD.simpleString()
    # The raw label of the record that is known bad is not in the grid, as the record is out.
    assert t["scorecard"].count() == 2 * 2 * 11
    score = rows(t["scorecard"].filter("Metric_Name = 'DQ Score'"), "Org_Code", "Reporting_Period", "Value", "DQ_Check", "ICB_Code")
    # AAA in August: records, aggregates, referrals, care plan, follow-up, age and status pass;
    # nine of fourteen records link, prevalence is 14 of 20 and identification 20 of 8.
    assert score == [
        ("AAA", AUGUST, 7.0, "B7", "Q1"),
        ("AAA", SEPTEMBER, 4.0, "DP", "Q1"),
        ("BBB", AUGUST, 4.0, "D0", "Q1"),
        ("BBB", SEPTEMBER, 0.0, "D0", "Q1"),
    ]


def test_a_stage_can_be_run_again_over_written_tables(tables, spark):
    settings, t = tables
    before = t["metrics"].count()
    again = programme.run(spark, settings, ["metrics"])
    assert again["metrics"].count() == before
