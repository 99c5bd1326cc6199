"""The programme's stages over files, each ending in a written table.

Stages hand over Parquet tables under ``Settings.work``; a result that several
later steps read is therefore computed once. The two dashboard tables can also be
exported as CSV.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import spec
from ..contracts import ELEMENTS_BY_DEMOGRAPHIC, conform
from ..functions.columns import period_month
from ..functions.joins import check_unique
from ..operators import dimensions, elements, ingest, metrics, publish, quality, scorecard
from ..sources.files import export_csv, scan_csv, scan_parquet, write_table
from ..sources.session import release_settled, settled_so_far

RECURSIVE = {"records", "aggregates", "admissions", "spells", "bookings"}
PARQUET = RECURSIVE | {"provider_ref", "sub_icb_ref", "ethnicity_ref", "deprivation_ref"}
CSV = {"expected_providers", "icb_ref", "region_ref", "submission_log", "element_rules", "metric_defs"}

_ACTIVITY = {
    "Physical Acute": ("All other services", "Acute Inpatient"),
    "Adult Mental Health": ("All other services", "Mental Health Inpatient"),
    "Maternity": ("Maternity services", "Maternity"),
}


@dataclass(frozen=True)
class Settings:
    """Paths of the inputs by name, the work folder, and the reporting dates.

    A rule or definition column is given by name or by its 0-based position.
    """

    inputs: Mapping[str, str]
    work: str
    min_date: str
    max_date_maternity: str
    max_date_ip: str
    export: str | None = None
    rule_columns: Mapping[str, str | int] = field(
        default_factory=lambda: {"Element_ID": 1, "Element_Logic": 6}
    )
    metric_columns: Mapping[str, str | int] = field(
        default_factory=lambda: {
            "Metric_ID": 2,
            "Metric_Type": 4,
            "Numerator_Element": 8,
            "Denominator_Element": 12,
        }
    )

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        path = self.inputs[name]
        return scan_parquet(spark, path, name in RECURSIVE) if name in PARQUET else scan_csv(spark, path)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(f"{self.work}/{name}")

    def write(self, df: DataFrame, name: str, layout: Sequence[str] = ()) -> DataFrame:
        return write_table(df, f"{self.work}/{name}", layout)


def _with_named(df: DataFrame, columns: Mapping[str, str | int]) -> DataFrame:
    """Add the columns under fixed names, found by name or position."""
    found = {n: df.columns[c] if isinstance(c, int) else c for n, c in columns.items()}
    return df.withColumns({n: F.col(c) for n, c in found.items()})


def read_records(spark: SparkSession, s: Settings) -> DataFrame:
    """Record-level submissions: known-bad ones out, successor codes in, dates typed."""
    rows = ingest.exclude_known_bad(s.read(spark, "records"), spec.KNOWN_BAD)
    rows = ingest.remap_codes(rows, "ODS_CODE", s.read(spark, "expected_providers"), "Org_Code", "Org_Code_Current")
    return s.write(ingest.ingest_records(rows, spec.RECORD_COLUMNS, spec.RECORD_DATES), "raw_records")


def read_aggregates(spark: SparkSession, s: Settings) -> DataFrame:
    """Aggregate submissions as they are."""
    return s.write(s.read(spark, "aggregates"), "raw_aggregates")


def clean(spark: SparkSession, s: Settings) -> DataFrame:
    """Records without a quality issue, each with its commissioner."""
    labels = [spec.DUPLICATE_LABEL, spec.DUMMY_LABEL, spec.DATE_LABEL, spec.SETTING_LABEL]
    checked = quality.check_records(
        s.table(spark, "raw_records"),
        spec.VERSION_KEYS,
        "AuditID",
        spec.SUBMISSION_KEYS,
        "ACTIVITY_DATE",
        "SETTING_TYPE",
        labels,
        spec.NO_ISSUE,
    )
    current = s.read(spark, "sub_icb_ref").filter(F.col("Effective_To").isNull())
    rows = quality.clean_records(
        checked,
        "RecordID",
        spec.RECORD_COLUMNS,
        spec.COMMISSIONER_CANDIDATES,
        current,
        "Organisation_Code",
        "SubICB_Code",
    )
    return s.write(rows, "clean_records")


def providers(spark: SparkSession, s: Settings) -> DataFrame:
    """Provider dimension."""
    overrides = spark.createDataFrame(
        spec.PROVIDER_OVERRIDES, "Code string, Name string, ICB string, Region string"
    )
    dim = dimensions.provider_dimension(
        s.table(spark, "clean_records"),
        s.read(spark, "provider_ref").filter(F.col("Is_Latest") == 1),
        s.read(spark, "icb_ref"),
        s.read(spark, "region_ref"),
        overrides,
    )
    return s.write(dim, "providers")


def commissioners(spark: SparkSession, s: Settings) -> DataFrame:
    """Commissioner dimension."""
    dim = dimensions.commissioner_dimension(
        s.read(spark, "sub_icb_ref"), s.read(spark, "icb_ref"), s.read(spark, "region_ref")
    )
    return s.write(dim, "commissioners")


def bookings(spark: SparkSession, s: Settings) -> DataFrame:
    """First booking of each pregnancy since the first date."""
    rows = ingest.first_event_per_key(
        s.read(spark, "bookings"), "OrgCodeProvider", "PregnancyID", "AntenatalAppDate", s.min_date, "MinBookingDate"
    )
    return s.write(rows, "bookings")


def spells(spark: SparkSession, s: Settings) -> DataFrame:
    """Mental-health spells since the first date, read from the source when used."""
    return ingest.activity_extract(s.read(spark, "spells"), "StartDateHospProvSpell", s.min_date)


def admissions(spark: SparkSession, s: Settings) -> DataFrame:
    """Acute admissions since the first date that were not deleted, read when used."""
    return ingest.activity_extract(
        s.read(spark, "admissions"), "Admission_Date", s.min_date, [F.col("Deleted") == "0"]
    )


def monthly_activity(spark: SparkSession, s: Settings) -> DataFrame:
    """Activity per scorecard setting, organisation and month, for elements and scorecard."""
    acute, mental, maternity = _ACTIVITY
    counts = elements.monthly_activity(
        {
            acute: (admissions(spark, s), "Provider_Code", "Admission_Date", elements.acute_in_scope()),
            mental: (spells(spark, s), "OrgIDProv", "StartDateHospProvSpell", elements.spells_in_scope()),
            maternity: (s.table(spark, "bookings"), "OrgCodeProvider", "MinBookingDate", None),
        }
    )
    return s.write(counts, "monthly_activity")


def build_elements(spark: SparkSession, s: Settings) -> DataFrame:
    """Elements by demographic, then all elements in the long contract."""
    rules = _with_named(s.read(spark, "element_rules"), s.rule_columns).filter(
        (F.col("Reporting_Flag") == "1") & (F.col("Element_Source") == spec.RECORD_ELEMENT_SOURCE)
    )
    records = s.table(spark, "clean_records")
    latest = s.read(spark, "ethnicity_ref").filter(F.col("Is_Latest").cast("string") == "1")
    snapshot = F.lit(spec.DEPRIVATION_SNAPSHOT).cast("date")
    deciles = s.read(spark, "deprivation_ref").filter(
        F.col("Effective_Snapshot_Date").try_cast("date") == snapshot
    )
    categorised = elements.categorise(records, latest, deciles)
    counts = elements.rule_counts(categorised, rules.select("Element_ID", "Element_Logic").collect())
    counts = s.write(conform(counts, ELEMENTS_BY_DEMOGRAPHIC), "elements_by_demographic")
    known = s.table(spark, "providers")
    wide = elements.wide_measures_to_elements(
        s.table(spark, "raw_aggregates"), spec.AGGREGATE_ELEMENTS, known, period_month(F.col("Reporting_Period"))
    )
    activity = elements.activity_counts(s.table(spark, "monthly_activity"), known, _ACTIVITY)
    return s.write(
        elements.assemble_elements(elements.breakdowns_long(counts), wide, activity), "elements"
    )


def build_metrics(spark: SparkSession, s: Settings) -> DataFrame:
    """Numerators and denominators of the reported metrics."""
    defs = _with_named(s.read(spark, "metric_defs"), s.metric_columns)
    reported = defs.filter(F.col("Reporting_Flag") == "1")
    check_unique(reported, ["Metric_ID"], "metric_defs")
    return s.write(metrics.ratio_metrics(s.table(spark, "elements"), reported), "metrics")


def aggregate_metrics(spark: SparkSession, s: Settings) -> DataFrame:
    """Metrics at every level of the hierarchy."""
    rolled = metrics.hierarchy_rollup(
        s.table(spark, "metrics"), s.table(spark, "providers"), s.table(spark, "commissioners")
    )
    return s.write(rolled, "rolled_metrics", ["Date", "Metric_ID", "Org_Code"])


def dashboard_metrics(spark: SparkSession, s: Settings) -> DataFrame:
    """The published metrics table with its full ICB grid."""
    known, buyers = s.table(spark, "providers"), s.table(spark, "commissioners")
    defs = _with_named(s.read(spark, "metric_defs"), s.metric_columns)
    dims = dimensions.level_dimension(known, buyers, spec.NATIONAL_CODE, spec.NATIONAL_NAME)
    # Quartile groups lie within one date and setting, so the windows can come first.
    rolled = publish.reporting_windows(
        s.table(spark, "rolled_metrics"),
        "Date",
        "Service_Setting",
        s.min_date,
        spec.MATERNITY_SETTING,
        s.max_date_maternity,
        s.max_date_ip,
    )
    published = publish.publish_metrics(rolled, defs, dims)
    published = s.write(published, "published_metrics")
    places = publish.icb_places(s.read(spark, "icb_ref"), buyers)
    dense = publish.densify_grid(published, places, defs.filter(F.col("Reporting_Flag") == "1"))
    return _publish(s, dense, "dashboard_metrics")


def dashboard_scorecard(spark: SparkSession, s: Settings) -> DataFrame:
    """The published data-quality scorecard, over raw records."""
    records = s.table(spark, "raw_records")
    in_force = s.read(spark, "provider_ref").filter(F.col("Effective_To").isNull())
    expected = scorecard.expected_submissions(s.read(spark, "expected_providers"))
    grid = scorecard.submission_grid(expected, scorecard.reporting_periods(records), in_force)
    grid = s.write(grid, "scorecard_grid")
    submissions = scorecard.complete_submissions(s.read(spark, "submission_log"))
    totals = scorecard.setting_totals(
        s.table(spark, "raw_aggregates"), spec.AGGREGATE_TOTALS, period_month(F.col("Reporting_Period"))
    )
    totals = s.write(totals, "setting_totals")
    links = scorecard.link_keys(
        {
            "1": (admissions(spark, s), "Provider_Code", "Hospital_Spell_No"),
            "2": (spells(spark, s), "OrgIDProv", "HospProvSpellID"),
            "3": (s.table(spark, "bookings"), "OrgCodeProvider", "PregnancyID"),
        }
    )
    wide = scorecard.scorecard_wide(
        grid,
        scorecard.record_quality_profile(records, links, s.table(spark, "providers")),
        totals,
        scorecard.prior_submission_count(grid, submissions),
        submissions,
        scorecard.prevalence_rate(records, totals),
        scorecard.lagged_rolling_rate(totals, s.table(spark, "monthly_activity")),
    )
    long = scorecard.scorecard_long(wide, s.read(spark, "icb_ref"), s.read(spark, "region_ref"))
    return _publish(s, long, "scorecard")


def _publish(s: Settings, df: DataFrame, name: str) -> DataFrame:
    table = s.write(df, name)
    if s.export:
        export_csv(table, f"{s.export}/{name}")
    return table


STAGES: dict[str, Callable[[SparkSession, Settings], DataFrame]] = {
    "raw_records": read_records,
    "raw_aggregates": read_aggregates,
    "clean_records": clean,
    "providers": providers,
    "commissioners": commissioners,
    "bookings": bookings,
    "monthly_activity": monthly_activity,
    "elements": build_elements,
    "metrics": build_metrics,
    "rolled_metrics": aggregate_metrics,
    "dashboard_metrics": dashboard_metrics,
    "scorecard": dashboard_scorecard,
}
"""Stages in run order; a later one reads the tables of earlier ones."""


def run(spark: SparkSession, settings: Settings, stages: list[str] | None = None) -> dict[str, DataFrame]:
    """Run all stages, or the named ones over tables that earlier runs wrote."""
    before = settled_so_far()
    written = {name: STAGES[name](spark, settings) for name in stages or STAGES}
    release_settled(spark, before)
    return written
