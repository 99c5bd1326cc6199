"""Counts of rule-defined elements."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from .. import spec
from ..contracts import ELEMENTS, conform
from ..functions.columns import band_label, code_label, code_pair_label, element_id, month_floor
from ..functions.joins import lookup_join
from ..sources.session import rows_at_most, settle

DIMENSIONS = [
    "Date",
    "Provider_Code",
    "Commissioner_Code",
    "Service_Setting",
    "Activity_Type",
    "Gender",
    "Age",
    "Ethnicity",
    "Ethnic_Group",
    "IMD_Quintile",
]
BASE_DIMENSIONS = DIMENSIONS[:5]
BREAKDOWNS = DIMENSIONS[5:]
TOTAL = "Total"

RECORD_ID = "RecordID"

_AS_DIMENSION = "_dim_"
_HAS = "_has_"


def categorise(
    df: DataFrame,
    ethnicities: DataFrame,
    areas: DataFrame,
    provider: str = "ODS_CODE",
    commissioner: str = "SubICB_Code",
) -> DataFrame:
    """Add the ten reporting dimensions to records, as columns ``_dim_<name>``.

    ``ethnicities`` has ``Main_Code_Text, Main_Description`` and ``areas`` has
    ``LSOA_Code, IMD_Decile``, already cut to the entries in use. The records keep
    all their own columns and gain both lookups' values, so element rules may use
    any of them. An ethnicity without a label stays null.
    """
    if RECORD_ID in df.columns:  # rules need no more of it, and it is long
        df = df.withColumn(_HAS + RECORD_ID, F.col(RECORD_ID).isNotNull())
    labels = ethnicities.select("Main_Code_Text", "Main_Description").distinct()
    labels = labels.withColumn("_code", F.col("Main_Code_Text"))
    deciles = areas.select("LSOA_Code", "IMD_Decile", F.col("LSOA_Code").alias("_code"))
    joined = lookup_join(df, labels, {"ETHNICITY": "_code"})
    joined = lookup_join(joined, deciles, {"LSOA_OF_RESIDENCE": "_code"})
    values = {
        "Date": month_floor(F.col("ACTIVITY_DATE")),
        "Provider_Code": F.col(provider),
        "Commissioner_Code": F.col(commissioner),
        "Service_Setting": code_label(
            F.col("SETTING_TYPE"), spec.SERVICE_SETTINGS, spec.SERVICE_SETTING_ELSE
        ),
        "Activity_Type": code_pair_label(
            F.col("SETTING_TYPE"), F.col("ACTIVITY_TYPE"), spec.ACTIVITY_TYPES, spec.ACTIVITY_TYPE_ELSE
        ),
        "Gender": code_label(F.col("GENDER"), spec.GENDERS, spec.GENDER_ELSE),
        "Age": band_label(F.col("Der_Age_at_CDS_Activity_Date"), spec.AGE_BANDS, spec.AGE_ELSE),
        "Ethnicity": F.col("Main_Description"),
        "Ethnic_Group": code_label(F.col("ETHNICITY"), spec.ETHNIC_GROUPS, spec.ETHNIC_GROUP_ELSE),
        "IMD_Quintile": code_label(
            F.col("IMD_Decile").cast("string"), spec.QUINTILES, spec.QUINTILE_ELSE
        ),
    }
    return joined.withColumns({_AS_DIMENSION + name: value for name, value in values.items()})


def dimensions(categorised: DataFrame, names: Sequence[str] = DIMENSIONS, keep: Sequence[str] = ()) -> DataFrame:
    """The dimensions of categorised records under their own names."""
    return categorised.select(*keep, *[F.col(_AS_DIMENSION + n).alias(n) for n in names])


@dataclass
class Counted:
    """Counts of several elements side by side: the dimensions and ``_rule_i`` for the i-th id,
    null where a group has none. ``groups`` are the breakdowns of which no row has been made
    yet. A frame of counts, or of their breakdowns, carries this form as ``_counted``.
    """

    rows: DataFrame
    ids: list[str]
    groups: Sequence[str] = ()

    @property
    def values(self) -> list[str]:
        return [f"_rule_{i}" for i in range(len(self.ids))]

    def unpacked(self, rows: DataFrame, dims: Sequence[str]) -> DataFrame:
        """A row per element that a group has."""
        counts = F.array(
            *[
                F.struct(element_id(F.lit(e)).alias("Element_ID"), F.col(c).alias("Value"))
                for e, c in zip(self.ids, self.values)
            ]
        )
        return rows.select("*", F.inline(counts)).filter("Value IS NOT NULL").select("Element_ID", *dims, "Value")


def counted_form(df: DataFrame) -> Counted | None:
    """The counts side by side that a frame of elements is made of, where it carries them."""
    return vars(df).get("_counted")


def _number(raw: str) -> str:
    """What ids that :func:`element_id` makes equal have in common."""
    text = raw.strip(" ")
    found = re.fullmatch(r"\+?0*([0-9]+)(\.0*)?", text, re.ASCII)
    return found[1] if found else text


RULE_BLOCK = 50
"""Rules counted by one group-by; more would outgrow what Spark compiles into one method."""


@contextmanager
def _lenient(spark: SparkSession) -> Iterator[None]:
    """Frames built inside compare text with numbers as older releases do: bad text is null, not an error."""
    name = "spark.sql.ansi.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def rule_counts(
    categorised: DataFrame,
    rules: Sequence[Row] | Sequence[Mapping[str, str]],
    record_id: str = RECORD_ID,
    dims: Sequence[str] = DIMENSIONS,
    block: int = RULE_BLOCK,
) -> DataFrame:
    """Records with an id that each rule matches, by dimension.

    A rule has ``Element_ID`` and ``Element_Logic``, a SQL predicate over the record's
    columns. Rules become expressions, so they are the one table read on the driver.
    Predicates may prefix columns with ``a.``; text compared with a number is null where
    it is none. Each block of rules is one scan and one group-by over the dimensions
    with a sum per rule, turned into rows afterwards: 1 for a match with an id, 0 for
    one without, so that such a group stays with a count of 0, and null for no match.
    The counts of a single block carry their sums side by side.
    """
    if not rules:
        nothing = categorised.filter(F.lit(False)).select(*[F.col(_AS_DIMENSION + n).alias(n) for n in dims])
        return nothing.select(F.lit("").alias("Element_ID"), *dims, F.lit(0).cast("bigint").alias("Value"))
    has_id = F.col(f"a.{record_id}").isNotNull()
    if _HAS + record_id in categorised.columns:
        has_id = F.col(f"a.{_HAS}{record_id}")
    parts = []
    for first in range(0, len(rules), block):
        some = rules[first : first + block]
        with _lenient(categorised.sparkSession):
            flags = categorised.alias("a").select(
                *[F.col(_AS_DIMENSION + n).alias(n) for n in dims],
                *[
                    F.when(F.expr(f"({r['Element_Logic']})"), has_id.cast("int")).alias(f"_rule_{i}")
                    for i, r in enumerate(some)
                ],
            )
        sums = flags.groupBy(*dims).agg(*[F.sum(f"_rule_{i}").alias(f"_rule_{i}") for i in range(len(some))])
        counted = Counted(sums, [r["Element_ID"] for r in some])
        parts.append(counted.unpacked(sums, dims))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    numbers = [str(r["Element_ID"]).strip().lstrip("0").split(".")[0] for r in rules]
    if len(set(numbers)) == len(numbers):
        if len(parts) == 1 and len({_number(str(r["Element_ID"])) for r in rules}) == len(rules):
            union._counted = counted
        return union
    return union.groupBy("Element_ID", *dims).agg(F.sum("Value").alias("Value"))


TASK_ROWS = 50_000
"""Groups of counts whose breakdowns one task sums; each becomes a row per breakdown there."""

LIKE = ["Date", "Service_Setting", "Activity_Type"]
"""What rows are sorted by within a task: like rows side by side pack much tighter in files and shuffles."""

BREAKDOWN_KEYS = ["Health_Inequalities_Group", "Health_Inequalities_SubGroup"]


def breakdown_rows(groups: Sequence[str]) -> Column:
    """The total and each breakdown of a row, as an array of its name and the row's subgroup."""
    shown = [(F.lit(TOTAL), F.lit(TOTAL)), *[(F.lit(g), F.col(g)) for g in groups]]
    return F.array(*[F.struct(*[c.alias(n) for c, n in zip(pair, BREAKDOWN_KEYS)]) for pair in shown])


def breakdowns_long(
    counts: DataFrame, base: Sequence[str] = BASE_DIMENSIONS, groups: Sequence[str] = BREAKDOWNS
) -> DataFrame:
    """Sums of ``Value`` in total and by each breakdown, as one long table.

    The counts are written down, side by side if they carry that form, and dealt once by
    the base dimensions, in tasks of known size. Each group of counts then becomes a row
    per breakdown within its task, so the many more rows of the result are summed where
    they are, and so are the metrics made of them. The group's name keeps a null subgroup
    apart from one that was summed over. The result carries the counts side by side too.
    """
    counted = counted_form(counts)
    if not groups:
        keys = ["Element_ID", *base]
        sums = counts.groupBy(*keys).agg(F.sum("Value").alias("Value"))
        long = sums.select(*keys, *[F.lit(TOTAL).alias(n) for n in BREAKDOWN_KEYS], "Value")
        if counted:
            long._counted = counted
        return long
    rows = counted.rows if counted else counts
    like = [c for c in LIKE if c in base]
    rows = settle(rows.sortWithinPartitions(*like) if like else rows)
    tasks = -(-rows_at_most(rows) // TASK_ROWS) or 1
    keys, values = (base, counted.values) if counted else (["Element_ID", *base], ["Value"])
    spread = rows.repartition(tasks, *base).select(*keys, F.inline(breakdown_rows(groups)), *values)
    sums = spread.groupBy(*keys, *BREAKDOWN_KEYS).agg(*[F.sum(v).alias(v) for v in values])
    if not counted:
        sums._tasks = tasks
        return sums
    long = counted.unpacked(sums, [*base, *BREAKDOWN_KEYS])
    long._tasks, long._counted = tasks, replace(counted, rows=rows, groups=list(groups))
    return long


def _known_orgs(counts: DataFrame, orgs: DataFrame) -> DataFrame:
    known = orgs.select(F.col("ODS_Code").alias("_org")).distinct()
    return lookup_join(counts, known, {"Provider_Code": "_org"}, how="left_semi")


def _as_total(counts: DataFrame, element: Column, setting: Column, activity: Column) -> DataFrame:
    return counts.select(
        element.alias("Element_ID"),
        "Date",
        "Provider_Code",
        F.lit(None).cast("string").alias("Commissioner_Code"),
        setting.alias("Service_Setting"),
        activity.alias("Activity_Type"),
        F.lit(TOTAL).alias("Health_Inequalities_Group"),
        F.lit(TOTAL).alias("Health_Inequalities_SubGroup"),
        "Value",
    )


def wide_measures_to_elements(
    agg: DataFrame,
    mapping: Mapping[str, tuple[str, str, str]],
    orgs: DataFrame,
    date: Column,
    org: str = "ODS_Code",
) -> DataFrame:
    """Count columns of the aggregate table as element rows per month and known provider.

    ``mapping`` gives each column's element id, service setting and activity type.
    All columns are summed in one group-by, cut to known providers after the sums,
    then turned into rows. A group whose values are all null keeps its null row.
    """
    sums = (
        agg.groupBy(date.alias("Date"), F.col(org).alias("Provider_Code"))
        .agg(*[F.sum(F.col(c).try_cast("double")).alias(c) for c in mapping])
    )
    rows = _known_orgs(sums, orgs).select(
        "Date",
        "Provider_Code",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(element).alias("_element"),
                        F.lit(setting).alias("_setting"),
                        F.lit(activity).alias("_activity"),
                        F.col(c).alias("Value"),
                    )
                    for c, (element, setting, activity) in mapping.items()
                ]
            )
        ),
    )
    return _as_total(rows, F.col("_element"), F.col("_setting"), F.col("_activity"))


def acute_in_scope(
    classification: str = "Patient_Classification",
    age: str = "Age_At_Start_of_Spell_SUS",
    discharge: str = "Discharge_Method",
    specialty: str = "Der_Admit_Treatment_Function_Code",
) -> Column:
    """Adult ordinary admissions; a null discharge method or specialty is out of scope."""
    return (
        (F.col(classification) == spec.ACUTE_CLASSIFICATION)
        & (F.col(age).try_cast("double") >= spec.ADULT_AGE)
        & ~F.col(discharge).isin(spec.EXCLUDED_DISCHARGE_METHODS)
        & ~F.col(specialty).isin(spec.EXCLUDED_SPECIALTIES)
    )


def spells_in_scope(
    length_of_stay: str = "LOSDischHosSpell", age: str = "Der_Age_at_StartDateHospProvSpell"
) -> Column:
    """Adult spells that have ended after at least a day."""
    return (F.col(length_of_stay).try_cast("double") > 0) & (F.col(age).try_cast("double") >= spec.ADULT_AGE)


def monthly_activity(extracts: Mapping[str, tuple[DataFrame, str, str, Column | None]]) -> DataFrame:
    """Rows per source, organisation and month of ``{source: (rows, org, date, scope)}``.

    Serves both the activity elements and the scorecard's rolling average.
    """
    parts = []
    for source, (rows, org, date, scope) in extracts.items():
        rows = rows if scope is None else rows.filter(scope)
        parts.append(
            rows.groupBy(F.col(org).alias("Org_Code"), month_floor(F.col(date)).alias("Date"))
            .agg(F.count(F.lit(1)).alias("Activity"))
            .select(F.lit(source).alias("Source"), "Org_Code", "Date", "Activity")
        )
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def activity_counts(
    activity: DataFrame,
    orgs: DataFrame,
    labels: Mapping[str, tuple[str, str]],
    element: str = spec.ACTIVITY_ELEMENT,
) -> DataFrame:
    """Monthly activity of known providers as element rows.

    ``activity`` comes from :func:`monthly_activity`; ``labels`` gives each source's
    service setting and activity type. Providers are checked after counting.
    """
    counts = activity.select("Source", F.col("Org_Code").alias("Provider_Code"), "Date", F.col("Activity").alias("Value"))
    setting = code_label(F.col("Source"), [([s], a) for s, (a, _) in labels.items()], None)
    kind = code_label(F.col("Source"), [([s], b) for s, (_, b) in labels.items()], None)
    return _as_total(_known_orgs(counts, orgs), F.lit(element), setting, kind)


def assemble_elements(*parts: DataFrame, together: bool = False) -> DataFrame:
    """All element rows in the element contract.

    ``together`` deals the other parts as :func:`breakdowns_long` dealt the first, so
    that rows of one base key meet in one task and what is grouped by it stays there.
    The result carries its parts, each of which may be summed where it lies; and, if
    ``together``, the number of tasks that they are dealt over.
    """
    tasks = vars(parts[0]).get("_tasks") if together else None
    conformed = []
    for part in parts:
        conformed.append(conform(part, ELEMENTS))
        if counted_form(part):
            conformed[-1]._counted = counted_form(part)
    elements = conformed[0]
    for rows in conformed[1:]:
        elements = elements.unionByName(rows.repartition(tasks, *BASE_DIMENSIONS) if tasks else rows)
    elements._parts, elements._tasks = conformed, tasks
    return elements
