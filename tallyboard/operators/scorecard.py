"""The data-quality scorecard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import spec
from ..contracts import SCORECARD, conform
from ..functions.columns import (
    all_known,
    code_pair_label,
    count_if,
    period_month,
    ratio,
    suppress_and_round,
)
from ..functions.joins import crowded_classes, in_classes, join_within, lookup_join, product, spread_left_join


def expected_submissions(xref: DataFrame) -> DataFrame:
    """Organisation and setting pairs that are expected to submit."""
    return (
        xref.filter(F.col("DQ_Flag") == "1")
        .select(F.col("Org_Code_Current").alias("Org_Code"), "Setting_Type", "Specified_ICB")
        .distinct()
    )


def reporting_periods(records: DataFrame, label: str = "REPORTING_PERIOD") -> DataFrame:
    """Months that records were submitted for."""
    labels = records.select(label).distinct()
    return labels.select(period_month(F.col(label)).alias("Reporting_Period")).distinct()


def complete_submissions(log: DataFrame) -> DataFrame:
    """Month and submitter of every complete submission."""
    return (
        log.filter(F.col("StatusofSubmission") == spec.COMPLETE)
        .select(
            period_month(F.col("ReportingPeriod")).alias("Reporting_Period"),
            "OrganisationCode",
            "StatusofSubmission",
        )
        .distinct()
    )


def submission_grid(expected: DataFrame, periods: DataFrame, ref: DataFrame) -> DataFrame:
    """Every expected organisation and setting in every period, with region and parent.

    The parent is the specified one, else the reference's. The full grid is the result.
    """
    fields = ref.select(
        F.col("Organisation_Code").alias("_org"),
        "Organisation_Name",
        F.col("National_Grouping_Code").alias("Region_Code"),
        F.col("High_Level_Health_Authority_Code").alias("_icb"),
    )
    places = lookup_join(expected, fields, {"Org_Code": "_org"}).select(
        "Org_Code",
        "Organisation_Name",
        "Region_Code",
        F.coalesce("Specified_ICB", "_icb").alias("ICB_Code"),
        "Setting_Type",
    )
    return product(periods.distinct(), places.distinct())


def prior_submission_count(grid: DataFrame, submissions: DataFrame, submitter: Column | None = None) -> DataFrame:
    """Distinct complete months strictly before each period, per organisation.

    Grid months and submission months of an organisation are put on one time line and
    counted by a running sum, so no month is paired with another. The submitter is
    matched on the first three characters of its code unless ``submitter`` says otherwise.
    """
    if submitter is None:
        submitter = F.left(F.col("OrganisationCode"), F.lit(3))
    wanted = grid.select("Reporting_Period", "Org_Code", F.lit(1).alias("_cell"), F.lit(0).alias("_sent"))
    sent = submissions.select(
        "Reporting_Period", submitter.alias("Org_Code"), F.lit(0).alias("_cell"), F.lit(1).alias("_sent")
    ).filter(all_known([F.col("Reporting_Period"), F.col("Org_Code")]))
    months = (
        wanted.unionByName(sent)
        .groupBy("Org_Code", "Reporting_Period")
        .agg(F.max("_cell").alias("_cell"), F.max("_sent").alias("_sent"))
    )
    earlier = Window.partitionBy("Org_Code").orderBy("Reporting_Period").rowsBetween(Window.unboundedPreceding, -1)
    return (
        months.withColumn("_before", F.coalesce(F.sum("_sent").over(earlier), F.lit(0)))
        .filter(F.col("_cell") == 1)
        .select("Reporting_Period", "Org_Code", F.col("_before").cast("bigint").alias("Count_Previous_Submissions"))
    )


def setting_totals(
    agg: DataFrame, mapping: Mapping[str, Sequence[str]], date: Column, org: str = "ODS_Code"
) -> DataFrame:
    """Aggregate counts per month, organisation and setting; null counts as 0."""

    def total(columns: Sequence[str]) -> Column:
        # A row's columns are added first, so that one sum per setting is shuffled.
        return F.sum(sum((F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns), F.lit(0.0)))

    sums = agg.groupBy(date.alias("Reporting_Period"), F.col(org).alias("ODS_Code")).agg(
        *[total(columns).alias(setting) for setting, columns in mapping.items()]
    )
    return sums.unpivot(["Reporting_Period", "ODS_Code"], list(mapping), "Setting_Type", "Value")


def score_setting(setting: str = "SETTING_TYPE", activity: str = "ACTIVITY_TYPE") -> Column:
    """Scorecard setting of a record, null when it has none."""
    return code_pair_label(F.col(setting), F.col(activity), spec.SCORE_SETTINGS)


def link_keys(sources: Mapping[str, tuple[DataFrame, str, str]], distinct: bool = True) -> DataFrame:
    """Distinct (setting code, organisation, upper-cased key) over all activity sources.

    ``sources`` maps a setting code to the source, its organisation and its key column.
    Upper-casing comes first, so spellings of one key cannot repeat a record. Without
    ``distinct`` keys repeat, for :func:`record_quality_profile`, which deals them first.
    """
    parts = [
        df.select(F.lit(code).alias("_code"), F.col(org).alias("_org"), F.upper(key).alias("_key"))
        for code, (df, org, key) in sources.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.dropna().distinct() if distinct else union.dropna()


_CELL = ["Reporting_Period", "ODS_CODE", "ODS_Name", "Setting_Type"]


def _counted_by_org(rows: DataFrame, links: DataFrame, counts: Sequence[str]) -> DataFrame:
    """Counts per cell of organisations that are no task's burden: rows are dealt by organisation, once.

    Its records, its link keys and its persons then lie together, and a record is linked
    where a window over its key holds a link.
    """
    known = links.select(F.col("_org").alias("ODS_CODE"), "_code", "_key")
    # Only links are without marks.
    together = rows.unionByName(known, allowMissingColumns=True).repartition("ODS_CODE")
    # The digest first, which most comparisons of the sort end at.
    same = Window.partitionBy("_digest", "ODS_CODE", "_code", "_key")
    placed = together.withColumn("_digest", F.xxhash64("ODS_CODE", "_code", "_key"))
    link = F.col("_marks").isNull().cast("int")
    marked = placed.withColumn("_linked", F.max(link).over(same)).filter("_marks IS NOT NULL")
    return marked.groupBy(*_CELL).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("_linked").alias("_linked"),
        *[count_if(F.bit_get(F.col("_marks"), F.lit(i)) == 1).alias(c) for i, c in enumerate(counts)],
        F.countDistinct("_person").alias("_persons"),
    )


def _counted_by_key(rows: DataFrame, links: DataFrame, counts: Sequence[str]) -> DataFrame:
    """The same counts where one organisation may hold most rows.

    Records are counted per key before they are joined to the links, which leaves a key
    that a third of all records share with a handful of rows. Persons are counted in a
    shuffle by person.
    """
    per_key = rows.groupBy(*_CELL, "_code", "_key").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[count_if(F.bit_get(F.col("_marks"), F.lit(i)) == 1).alias(c) for i, c in enumerate(counts)],
    )
    known = links.distinct().withColumn("_linked", F.lit(1))
    linked = spread_left_join(per_key.withColumn("_org", F.col("ODS_CODE")), known, ["_code", "_org", "_key"])
    sums = linked.groupBy(*_CELL).agg(
        F.sum("_rows").alias("_rows"),
        F.sum(F.when(F.col("_linked") == 1, F.col("_rows")).otherwise(0)).alias("_linked"),
        *[F.sum(c).alias(c) for c in counts],
        F.lit(0).cast("bigint").alias("_persons"),
    )
    persons = rows.groupBy(*_CELL).agg(F.countDistinct("_person").alias("_persons"))
    # Both sides hold one row per group; adding them needs no null-safe join.
    return sums.unionByName(persons, allowMissingColumns=True).groupBy(*_CELL).agg(
        *[F.sum(c).alias(c) for c in ["_rows", "_linked", *counts, "_persons"]]
    )


def record_quality_profile(
    records: DataFrame, links: DataFrame, providers: DataFrame, person: str = spec.PERSON
) -> DataFrame:
    """Volumes and rates of the records per month, organisation and setting.

    A record links to the one source of its own setting, so a single join on
    (setting, organisation, key) decides it; ``links`` may repeat. Records and links are
    dealt by organisation, which every count is within. Organisations that are measured
    to crowd are counted per key and per person instead. Distinct persons are exact.
    """
    label = score_setting()
    plan, seen = F.col("TOBACCODEPENDENCE_CAREPLAN"), F.col("SEEN_INHOUSE") == "Y"
    followed = plan.isin(spec.FOLLOW_UP_PLANS)
    age = F.col("Der_Age_at_CDS_Activity_Date").try_cast("double")
    in_range = F.lit(False)
    for setting, (low, high) in spec.SCORE_AGES.items():
        in_range = F.when(label == setting, age.between(low, high)).otherwise(in_range)
    key = F.lit(None).cast("string")
    for code, column in spec.LINK_COLUMNS.items():
        key = F.when(F.col("SETTING_TYPE") == code, F.upper(column)).otherwise(key)
    counts = {
        "_status": F.col("SMOKINGSTATUS").isNotNull(),
        "_seen": seen,
        "_planned": seen & plan.isNotNull(),
        "_referred": F.col("INHOUSE_REFERRAL") == "Y",
        "_followed": followed,
        "_lost": followed & (F.col("OUTCOME_AT28DAYS") == spec.LOST_TO_FOLLOW_UP),
        "_aged": in_range,
    }
    # The tests' outcomes travel as the bits of one number.
    marks = sum((F.when(test, 1 << i).otherwise(0) for i, test in enumerate(counts.values())), F.lit(0))
    rows = records.select(
        period_month(F.col("REPORTING_PERIOD")).alias("Reporting_Period"),
        "ODS_CODE",
        "ODS_Name",
        label.alias("Setting_Type"),
        F.col("SETTING_TYPE").alias("_code"),
        key.alias("_key"),
        F.col(person).alias("_person"),
        marks.alias("_marks"),
    )

    crowd = crowded_classes((rows, "ODS_CODE"), (links, "_org"))
    if crowd:
        here, there = in_classes("ODS_CODE", crowd), in_classes("_org", crowd)
        most = _counted_by_org(rows.filter(~here), links.filter(~there), list(counts))
        rest = _counted_by_key(rows.filter(here), links.filter(there), list(counts))
        both = most.unionByName(rest)
    else:
        both = _counted_by_org(rows, links, list(counts))
    parents = providers.select(F.col("ODS_Code").alias("_org"), "Region_Code", "ICB_Code").distinct()
    placed = lookup_join(both, parents, {"ODS_CODE": "_org"}, dealt="ODS_CODE")

    def rate(a: str, b: str) -> Column:
        return ratio(F.col(a), F.col(b), 2)

    return placed.select(
        "Reporting_Period",
        "Region_Code",
        "ICB_Code",
        "ODS_CODE",
        F.concat("ODS_CODE", F.lit(": "), "ODS_Name").alias("ODS_Code_Name"),
        "Setting_Type",
        F.col("_rows").alias("Count_Records"),
        F.col("_persons").alias("Count_Unique_Patients"),
        rate("_linked", "_rows").alias("Percent_Records_Linkable"),
        rate("_status", "_rows").alias("Percent_SmokingStatus_Complete"),
        rate("_planned", "_seen").alias("Percent_CarePlan_Complete"),
        F.col("_referred").cast("double").alias("Referrals_Count"),
        rate("_lost", "_followed").alias("Percent_LTFU"),
        rate("_aged", "_rows").alias("Percent_Age_Range"),
    )


def lagged_rolling_rate(totals: DataFrame, activity: DataFrame, months: int = 12) -> DataFrame:
    """Reported counts against the average activity up to the month before.

    ``activity`` has ``Source`` (a scorecard setting), ``Org_Code, Date, Activity``. The
    average is over the current and preceding rows in month order; absent months are
    not filled in. A window holds the months of one organisation and setting.
    """
    recent = Window.partitionBy("Org_Code", "Source").orderBy("Date").rowsBetween(1 - months, 0)
    rolled = activity.select(
        F.add_months("Date", 1).alias("Reporting_Period"),
        F.col("Org_Code").alias("ODS_Code"),
        F.col("Source").alias("Setting_Type"),
        "Activity",
        F.avg("Activity").over(recent).alias("_average"),
    )
    joined = join_within(totals, rolled, ["ODS_Code", "Reporting_Period"], "Setting_Type")
    return joined.select(
        "ODS_Code",
        "Reporting_Period",
        "Setting_Type",
        "Value",
        "Activity",
        ratio(F.col("Value"), F.col("_average"), 2).alias("Percent_Identification"),
    )


def prevalence_rate(records: DataFrame, totals: DataFrame) -> DataFrame:
    """Records with the current status over the aggregate total of their group.

    The settings of a month and organisation are counted side by side, so that the
    groups are dealt as the totals are.
    """
    label, current = score_setting(), F.col("SMOKINGSTATUS") == spec.CURRENT_STATUS
    settings = {name: label == name for *_, name in spec.SCORE_SETTINGS} | {None: label.isNull()}
    counts = (
        records.groupBy(
            F.col("ODS_CODE").alias("ODS_Code"), period_month(F.col("REPORTING_PERIOD")).alias("Reporting_Period")
        )
        .agg(
            # Null where the group has no record of the setting.
            *[F.sum(F.when(mine, F.when(current, 1).otherwise(0))).alias(f"_count_{i}") for i, mine in enumerate(settings.values())],
        )
        .select(
            "Reporting_Period",
            "ODS_Code",
            F.inline(
                F.array_compact(
                    F.array(
                        *[
                            F.when(
                                F.col(f"_count_{i}").isNotNull(),
                                F.struct(F.lit(name).cast("string").alias("Setting_Type"), F.col(f"_count_{i}").alias("Count_Smokers")),
                            )
                            for i, name in enumerate(settings)
                        ]
                    )
                )
            ),
        )
    )
    joined = join_within(counts, totals, ["ODS_Code", "Reporting_Period"], "Setting_Type")
    return joined.select(
        "ODS_Code",
        "Setting_Type",
        "Reporting_Period",
        "Count_Smokers",
        "Value",
        ratio(F.col("Count_Smokers"), F.col("Value"), 2).alias("Percent_Prevalence"),
    )


def _passes(column: str, test: str, threshold: float) -> Column:
    value = F.col(column)
    return {">=": value >= threshold, "<=": value <= threshold, "<": value < threshold}[test]


def scorecard_wide(
    grid: DataFrame,
    profile: DataFrame,
    totals: DataFrame,
    prior: DataFrame,
    submissions: DataFrame,
    prevalence: DataFrame,
    identification: DataFrame,
    checks=spec.SCORE_CHECKS,
) -> DataFrame:
    """All measures of every grid cell and how many of the checks it passes.

    Every side is already aggregated. A missing measure is a failed check. All sides are
    dealt by month and organisation, so the grid is dealt once.
    """
    by_setting = ["Reporting_Period", "Org_Code", "Setting_Type"]
    by_org = ["Org_Code", "Reporting_Period"]
    sent = submissions.select(
        "Reporting_Period",
        F.col("OrganisationCode").alias("Org_Code"),
        F.col("StatusofSubmission").alias("SDCS_Submission_Complete"),
    )
    measured = profile.drop("Region_Code", "ICB_Code", "ODS_Code_Name").withColumnsRenamed(
        {"ODS_CODE": "Org_Code", "Count_Records": "Patient_Records", "Count_Unique_Patients": "Unique_Patients"}
    )
    summary = totals.withColumnsRenamed({"ODS_Code": "Org_Code", "Value": "Aggregate_Records"})
    rates = [
        df.select("Reporting_Period", F.col("ODS_Code").alias("Org_Code"), "Setting_Type", column)
        for df, column in ((prevalence, "Percent_Prevalence"), (identification, "Percent_Identification"))
    ]
    wide = grid.join(prior, by_org, "left").join(sent, by_org, "left")
    for side in (measured, summary, *rates):
        wide = join_within(wide, side, by_org, "Setting_Type")
    wide = wide.select(*by_setting, *[c for c in wide.columns if c not in by_setting])
    score = sum(
        (F.when(_passes(c, test, limit), 1).otherwise(0) for _, _, c, test, limit in checks), F.lit(0)
    )
    return wide.withColumn("Count_Passes", score)


def grade_of(
    submitted: str = "SDCS_Submission_Complete",
    records: str = "Patient_Records",
    passes: str = "Count_Passes",
    prior: str = "Count_Previous_Submissions",
    best: int = len(spec.SCORE_CHECKS),
) -> Column:
    """Grade of a cell: A, B9 to B1 or C0 by passes; CX without records; DP or D0 if not sent."""
    sent = F.col(submitted).isNotNull()
    by_passes = (
        F.when(F.col(passes) == best, "A")
        .when(F.col(passes) == 0, "C0")
        .otherwise(F.concat(F.lit("B"), F.col(passes).cast("string")))
    )
    return (
        F.when(sent & F.col(records).isNotNull(), by_passes)
        .when(sent, "CX")
        .when(F.col(prior) > 0, "DP")
        .otherwise("D0")
    )


def grade(wide: DataFrame) -> DataFrame:
    """Wide scorecard rows with their grade."""
    return wide.withColumn("Grade", grade_of())


def scorecard_long(
    wide: DataFrame, icb: DataFrame, region: DataFrame, checks=spec.SCORE_CHECKS, score: str = spec.SCORE_LABEL
) -> DataFrame:
    """One row per cell and measure, plus the score and grade, in one scan of the wide rows.

    Counts are suppressed and rounded. Region and ICB codes are shown when the
    reference lists know them.
    """

    def entry(label: str, kind: str, value: Column, check: Column) -> Column:
        return F.struct(
            F.lit(label).alias("Metric_Name"),
            F.lit(kind).alias("Metric_Type"),
            value.cast("double").alias("Value"),
            check.alias("DQ_Check"),
        )

    entries = [
        entry(
            label,
            kind,
            suppress_and_round(F.col(column)) if kind == "Count" else F.col(column),
            F.when(_passes(column, test, limit), "Pass").otherwise("Fail"),
        )
        for label, kind, column, test, limit in checks
    ]
    entries.append(entry(score, "Count", F.col("Count_Passes"), grade_of()))
    regions = region.select(
        F.col("Region_Code").alias("_code"), "Region_Code", F.col("Region").alias("Region_Name")
    )
    icbs = icb.select(F.col("ICB_Code").alias("_code"), "ICB_Code", "ICB_Name")
    # A cell is looked up once, before it becomes a row per measure.
    rows = wide.withColumnsRenamed({"Region_Code": "_region", "ICB_Code": "_icb"})
    rows = lookup_join(rows, regions, {"_region": "_code"})
    rows = lookup_join(rows, icbs, {"_icb": "_code"})
    cell = ["Reporting_Period", "Org_Code", "Organisation_Name", "Setting_Type"]
    names = ["Region_Code", "Region_Name", "ICB_Code", "ICB_Name"]
    return conform(rows.select(*cell, *names, F.inline(F.array(*entries))), SCORECARD)
