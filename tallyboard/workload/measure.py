"""Queries for elements, metrics and the published table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import spec
from ..contracts import DASHBOARD_METRICS
from ..functions.columns import period_month, suppress_and_round, suppressed_flag
from ..operators import dimensions, elements, ingest, metrics, publish
from ..sources.session import settle
from . import inputs, prepare
from .inputs import RULES, table, with_inputs

QUERIES: dict[str, inputs.Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(fn: inputs.Query) -> inputs.Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


# --- categories and rule counts ------------------------------------------------

def _sql_codes(column: str, labels, default: str) -> str:
    """Label of a code by one lookup in the programme's table of codes."""
    cases = " ".join(f"WHEN {column} IN ({', '.join(repr(c) for c in codes)}) THEN '{label}'" for codes, label in labels)
    return f"CASE {cases} ELSE '{default}' END"


def _sql_code_pairs(first: str, second: str) -> str:
    cases = []
    for a, b, label in spec.ACTIVITY_TYPES:
        test = f"{first} IN ({', '.join(map(repr, a))})" + ("" if b is None else f" AND {second} IN ({', '.join(map(repr, b))})")
        cases.append(f"WHEN {test} THEN '{label}'")
    return f"CASE {' '.join(cases)} ELSE '{spec.ACTIVITY_TYPE_ELSE}' END"


def _sql_bands(column: str) -> str:
    cases = []
    for low, below, label in spec.AGE_BANDS:
        tests = ([f"{column} >= {low}"] if low is not None else []) + ([f"{column} < {below}"] if below is not None else [])
        cases.append(f"WHEN {' AND '.join(tests)} THEN '{label}'")
    return f"CASE {' '.join(cases)} ELSE '{spec.AGE_ELSE}' END"


_DIM_SQL = dict(
    zip(
        elements.DIMENSIONS,
        "d_date d_provider d_commissioner d_setting d_activity d_gender d_age d_ethnicity d_group d_quintile".split(),
    )
)


def sql_categories(source: str = "records", commissioner: str = "SubICB_Code") -> str:
    """Records with their labels: the lookups first, then every label from the looked-up row."""
    values = {
        "d_date": "CAST(date_trunc('month', ACTIVITY_DATE) AS DATE)",
        "d_provider": "ODS_CODE",
        "d_commissioner": commissioner,
        "d_setting": _sql_codes("SETTING_TYPE", spec.SERVICE_SETTINGS, spec.SERVICE_SETTING_ELSE),
        "d_activity": _sql_code_pairs("SETTING_TYPE", "ACTIVITY_TYPE"),
        "d_gender": _sql_codes("GENDER", spec.GENDERS, spec.GENDER_ELSE),
        "d_age": _sql_bands("CAST(Der_Age_at_CDS_Activity_Date AS DOUBLE)"),
        "d_ethnicity": "Main_Description",
        "d_group": _sql_codes("ETHNICITY", spec.ETHNIC_GROUPS, spec.ETHNIC_GROUP_ELSE),
        "d_quintile": _sql_codes("IMD_Decile", spec.QUINTILES, spec.QUINTILE_ELSE),
    }
    looked_up = (
        f"SELECT {source}.*, (SELECT max(Main_Description) FROM ethnicities WHERE Main_Code_Text = ETHNICITY) AS Main_Description, "
        f"areas_ref.IMD_Decile FROM {source} LEFT JOIN areas_ref ON LSOA_Code = LSOA_OF_RESIDENCE"
    )
    return f"SELECT looked_up.*, {', '.join(f'{v} AS {k}' for k, v in values.items())} FROM ({looked_up}) AS looked_up"


SQL_CATEGORIES = sql_categories()


def _sql_counts(dims) -> str:
    shown = ", ".join(f"{_DIM_SQL[d]} AS {d}" for d in dims)
    by = ", ".join(_DIM_SQL[d] for d in dims)
    return " UNION ALL ".join(
        f"SELECT '{r['Element_ID']}' AS Element_ID, {shown}, count(RecordID) AS Value FROM cats "
        f"WHERE ({r['Element_Logic']}) GROUP BY {by}"
        for r in RULES
    )


def _sql_long(groups) -> str:
    base = ", ".join(["Element_ID", *elements.BASE_DIMENSIONS])
    parts = [
        f"SELECT {base}, 'Total' AS Health_Inequalities_Group, 'Total' AS Health_Inequalities_SubGroup, "
        f"CAST(sum(Value) AS BIGINT) AS Value FROM counts GROUP BY {base}"
    ]
    parts += [
        f"SELECT {base}, '{g}' AS Health_Inequalities_Group, {g} AS Health_Inequalities_SubGroup, "
        f"CAST(sum(Value) AS BIGINT) AS Value FROM counts GROUP BY {base}, {g}"
        for g in groups
    ]
    return " UNION ALL ".join(parts)


_RECORD_INPUTS = "records ethnicities areas_ref"


def _categorised(spark: SparkSession, sf: str) -> DataFrame:
    return elements.categorise(inputs.records(spark, sf), inputs.ethnicities(spark, sf), inputs.areas_ref(spark, sf))


@query(
    with_inputs(
        "SELECT RecordID, AuditID, " + ", ".join(f"{c} AS {n}" for n, c in _DIM_SQL.items()) + " FROM cats",
        _RECORD_INPUTS,
        {"cats": SQL_CATEGORIES},
    )
)
def categorise(spark, sf):
    return elements.dimensions(_categorised(spark, sf), keep=["RecordID", "AuditID"])


@query(with_inputs(_sql_counts(elements.DIMENSIONS), _RECORD_INPUTS, {"cats": SQL_CATEGORIES}))
def rule_counts(spark, sf):
    return elements.rule_counts(_categorised(spark, sf), RULES)


@query(
    with_inputs(
        _sql_long(elements.BREAKDOWNS),
        _RECORD_INPUTS,
        {"cats": SQL_CATEGORIES, "counts": _sql_counts(elements.DIMENSIONS)},
    )
)
def breakdowns_long(spark, sf):
    return elements.breakdowns_long(elements.rule_counts(_categorised(spark, sf), RULES))


# --- elements from aggregates and activity ----------------------------------------

_SQL_PERIOD_MONTH = "CAST(right({0}, 4) || '-' || left(right({0}, 7), 2) || '-01' AS DATE)"
_SQL_PLACES = {"providers_now": "SELECT Organisation_Code AS ODS_Code FROM providers_ref WHERE Is_Latest = 1"}


def _places(spark: SparkSession, sf: str) -> DataFrame:
    latest = inputs.providers_ref(spark, sf).filter("Is_Latest = 1")
    return latest.select(F.col("Organisation_Code").alias("ODS_Code"))


def _sql_total_rows(element: str, setting: str, activity: str, value: str, source: str) -> str:
    """Counts of known providers as element rows without a commissioner or a breakdown."""
    return (
        f"SELECT {element} AS Element_ID, Date, Provider_Code, CAST(NULL AS STRING) AS Commissioner_Code, "
        f"{setting} AS Service_Setting, {activity} AS Activity_Type, 'Total' AS Health_Inequalities_Group, "
        f"'Total' AS Health_Inequalities_SubGroup, {value} AS Value FROM {source} "
        "WHERE Provider_Code IN (SELECT ODS_Code FROM providers_now)"
    )


_SQL_SUMS = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {c}" for c in spec.AGGREGATE_ELEMENTS)
_SQL_MEASURES = ", ".join(f"('{c}', '{e}', '{s}', '{a}')" for c, (e, s, a) in spec.AGGREGATE_ELEMENTS.items())
SQL_WIDE = _sql_total_rows(
    "element", "setting", "activity",
    "CASE measure " + " ".join(f"WHEN '{c}' THEN {c}" for c in spec.AGGREGATE_ELEMENTS) + " END",
    f"(SELECT {_SQL_PERIOD_MONTH.format('Reporting_Period')} AS Date, ODS_Code AS Provider_Code, {_SQL_SUMS} FROM aggregates GROUP BY 1, 2) AS months "
    f"CROSS JOIN (VALUES {_SQL_MEASURES}) AS labels(measure, element, setting, activity)",
)


@query(with_inputs(SQL_WIDE, "aggregates providers_ref", _SQL_PLACES))
def wide_measures_to_elements(spark, sf):
    month = period_month(F.col("Reporting_Period"))
    return elements.wide_measures_to_elements(
        inputs.aggregates(spark, sf), spec.AGGREGATE_ELEMENTS, _places(spark, sf), month
    )


_SQL_EXTRACTS = {
    "sus": f"SELECT * FROM admissions WHERE Deleted = '0' AND Admission_Date >= CAST('{inputs.SINCE}' AS DATE)",
    "mhsds": f"SELECT * FROM spells WHERE StartDateHospProvSpell >= CAST('{inputs.SINCE}' AS DATE)",
    "msds": prepare.SQL_FIRST_BOOKINGS,
}
EXTRACT_INPUTS = "admissions spells bookings"
_SQL_ACUTE = (
    "WHERE Patient_Classification = '1' AND Age_At_Start_of_Spell_SUS >= 16 AND Discharge_Method NOT IN ('4', '04') "
    "AND Der_Admit_Treatment_Function_Code NOT IN ('424', '501', '560')"
)
_SQL_SPELLS = "WHERE LOSDischHosSpell > 0 AND Der_Age_at_StartDateHospProvSpell >= 16"
SQL_MONTH = "CAST(date_trunc('month', {0}) AS DATE)"


def sql_monthly_activity(acute: str, mental: str, maternity: str) -> str:
    """(Source, Org_Code, Date, Activity): all events in scope under one name each, counted once."""
    events = [
        (acute, "Provider_Code", "Admission_Date", f"sus {_SQL_ACUTE}"),
        (mental, "OrgIDProv", "StartDateHospProvSpell", f"mhsds {_SQL_SPELLS}"),
        (maternity, "OrgCodeProvider", "MinBookingDate", "msds"),
    ]
    union = " UNION ALL ".join(f"SELECT '{name}' AS Source, {org} AS Org_Code, {day} AS happened FROM {rows}" for name, org, day, rows in events)
    return f"SELECT Source, Org_Code, {SQL_MONTH.format('happened')} AS Date, count(*) AS Activity FROM ({union}) AS events GROUP BY 1, 2, 3"


ACTIVITY_LABELS = {
    "acute": ("All other services", "Acute Inpatient"),
    "mental": ("All other services", "Mental Health Inpatient"),
    "maternity": ("Maternity services", "Maternity"),
}

SQL_ACTIVITY = _sql_total_rows(
    f"'{spec.ACTIVITY_ELEMENT}'",
    "CASE Source WHEN 'maternity' THEN 'Maternity services' ELSE 'All other services' END",
    "CASE Source WHEN 'acute' THEN 'Acute Inpatient' WHEN 'mental' THEN 'Mental Health Inpatient' ELSE 'Maternity' END",
    "Activity",
    f"(SELECT Source, Org_Code AS Provider_Code, Date, Activity FROM ({sql_monthly_activity('acute', 'mental', 'maternity')}) AS monthly) AS counted",
)


def extracts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Acute admissions, mental-health spells and first bookings since the lower bound."""
    acute = ingest.activity_extract(
        inputs.admissions(spark, sf), "Admission_Date", inputs.SINCE, [F.col("Deleted") == "0"]
    )
    mental = ingest.activity_extract(inputs.spells(spark, sf), "StartDateHospProvSpell", inputs.SINCE)
    return acute, mental, prepare.first_event_per_key(spark, sf)


def activity(spark: SparkSession, sf: str, names=tuple(ACTIVITY_LABELS), sources: tuple[DataFrame, ...] | None = None) -> DataFrame:
    acute, mental, maternity = extracts(spark, sf) if sources is None else sources
    return elements.monthly_activity(
        {
            names[0]: (acute, "Provider_Code", "Admission_Date", elements.acute_in_scope()),
            names[1]: (mental, "OrgIDProv", "StartDateHospProvSpell", elements.spells_in_scope()),
            names[2]: (maternity, "OrgCodeProvider", "MinBookingDate", None),
        }
    )


@query(with_inputs(SQL_ACTIVITY, f"{EXTRACT_INPUTS} providers_ref", {**_SQL_PLACES, **_SQL_EXTRACTS}))
def activity_counts(spark, sf):
    return elements.activity_counts(activity(spark, sf), _places(spark, sf), ACTIVITY_LABELS)


_AS_ELEMENT = ", ".join(
    ["Element_ID", *elements.BASE_DIMENSIONS, "Health_Inequalities_Group", "Health_Inequalities_SubGroup", "CAST(Value AS DOUBLE) AS Value"]
)
_RECORD_INPUTS_ALL = f"{_RECORD_INPUTS} aggregates providers_ref {EXTRACT_INPUTS}"


def _sql_assembled(groups) -> str:
    return " UNION ALL ".join(f"SELECT {_AS_ELEMENT} FROM ({q}) AS part" for q in (_sql_long(groups), SQL_WIDE, SQL_ACTIVITY))


def element_steps(groups, categories: str = SQL_CATEGORIES) -> dict[str, str]:
    """SQL steps up to ``elements``, with the given breakdowns and all sources."""
    dims = elements.BASE_DIMENSIONS + list(groups)
    return {"cats": categories, "counts": _sql_counts(dims), **_SQL_PLACES, **_SQL_EXTRACTS, "elements": _sql_assembled(groups)}


def assembled(
    spark: SparkSession, sf: str, groups=elements.BREAKDOWNS, categorised: DataFrame | None = None, together: bool = False
) -> DataFrame:
    """Elements of records with the given breakdowns, of aggregates and of activity."""
    rows = _categorised(spark, sf) if categorised is None else categorised
    counts = elements.rule_counts(rows, RULES, dims=elements.BASE_DIMENSIONS + list(groups))
    return elements.assemble_elements(
        elements.breakdowns_long(counts, groups=list(groups)),
        wide_measures_to_elements(spark, sf),
        activity_counts(spark, sf),
        together=together,
    )


_ELEMENT_STEPS = element_steps(elements.BREAKDOWNS)


@query(with_inputs("SELECT * FROM elements", _RECORD_INPUTS_ALL, _ELEMENT_STEPS))
def assemble_elements(spark, sf):
    return assembled(spark, sf)


# --- metrics -------------------------------------------------------------------------


_KEYS = ", ".join(metrics.ELEMENT_KEYS)
SQL_METRICS = f"""
    SELECT Metric_ID, {_KEYS},
           sum(CASE WHEN element = num THEN Value ELSE 0 END) AS Numerator,
           CASE WHEN max(Metric_Type) = 'Proportion' THEN sum(CASE WHEN element = den THEN Value ELSE 0 END) END AS Denominator
    FROM (SELECT *, CAST(Element_ID AS INTEGER) AS element FROM elements) AS e
    JOIN (SELECT Metric_ID, Metric_Type, CAST(Numerator_Element AS INTEGER) AS num,
                 CASE WHEN Metric_Type = 'Proportion' THEN CAST(Denominator_Element AS INTEGER) END AS den
          FROM metric_defs WHERE Reporting_Flag = '1') AS m
      ON element = num OR element = den
    GROUP BY Metric_ID, {_KEYS}"""


def _reported(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.metric_defs(spark, sf).filter(F.col("Reporting_Flag") == "1")


@query(with_inputs(SQL_METRICS, f"{_RECORD_INPUTS_ALL} metric_defs", _ELEMENT_STEPS))
def ratio_metrics(spark, sf):
    return metrics.ratio_metrics(assembled(spark, sf, together=True), _reported(spark, sf))


_REST = "Service_Setting, Activity_Type, Health_Inequalities_Group, Health_Inequalities_SubGroup"


_SQL_ROLES = " UNION ALL ".join(
    f"SELECT Metric_ID, Date, '{role}' AS Aggregation_Source, {role}_Code AS own, {_REST}, Numerator, Denominator FROM metrics"
    for role in ("Provider", "Commissioner")
)
_SQL_PARENTS = (
    "SELECT 'Provider' AS role, ODS_Code AS code, ICB_Code, Region_Code FROM providers UNION ALL "
    "SELECT 'Commissioner', Organisation_Code, ICB_Code, Region_Code FROM commissioners"
)
_SQL_PLACED = [
    ("Aggregation_Source", "own", "FROM roles"),
    ("'National'", "'ENG'", "FROM roles"),
    ("'ICB'", "ICB_Code", "FROM roles LEFT JOIN parents ON role = Aggregation_Source AND code = own"),
    ("'Region'", "Region_Code", "FROM roles LEFT JOIN parents ON role = Aggregation_Source AND code = own"),
]
SQL_ROLLUP = (
    f"SELECT Metric_ID, Date, Level, Aggregation_Source, Org_Code, {_REST}, sum(Numerator) AS Numerator, sum(Denominator) AS Denominator FROM ("
    + " UNION ALL ".join(
        f"SELECT Metric_ID, Date, {level} AS Level, Aggregation_Source, {code} AS Org_Code, {_REST}, Numerator, Denominator {rows}"
        for level, code, rows in _SQL_PLACED
    )
    + f") AS placed GROUP BY Metric_ID, Date, Level, Aggregation_Source, Org_Code, {_REST}"
)
_DIM_INPUTS = "commissioners_ref icb_ref region_ref overrides metric_defs"
_DIM_STEPS = {"providers": prepare.SQL_PROVIDERS, "commissioners": prepare.SQL_COMMISSIONERS}
_ROLLUP_STEPS = {"metrics": SQL_METRICS, **_DIM_STEPS, "roles": _SQL_ROLES, "parents": _SQL_PARENTS}
_ROLLED_INPUTS = f"{_RECORD_INPUTS_ALL} {_DIM_INPUTS}"


def _orgs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Both dimensions, which several steps look up, computed once."""
    return settle(prepare.provider_dimension(spark, sf)), settle(prepare.commissioner_dimension(spark, sf))


@query(with_inputs(SQL_ROLLUP, _ROLLED_INPUTS, {**_ELEMENT_STEPS, **_ROLLUP_STEPS}))
def hierarchy_rollup(spark, sf):
    return metrics.hierarchy_rollup(ratio_metrics(spark, sf), *_orgs(spark, sf))


# --- disclosure control and quartiles ----------------------------------------------------


@query(
    """SELECT l_suppkey, l_partkey, n, total,
              CASE WHEN n < 5 AND n > 0 THEN 0 ELSE CAST(round(n / 5.0) * 5 AS BIGINT) END AS n_shown,
              CASE WHEN n < 5 AND n > 0 THEN 1 ELSE 0 END AS n_hidden,
              CASE WHEN total < 5 AND total > 0 THEN 0 ELSE CAST(round(total / 5.0) * 5 AS BIGINT) END AS total_shown
       FROM (SELECT l_suppkey, l_partkey, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS total
             FROM lineitem GROUP BY l_suppkey, l_partkey) AS g"""
)
def suppress_and_round_counts(spark, sf):
    groups = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("total"),
        )
    )
    return groups.select(
        "*",
        suppress_and_round(F.col("n")).alias("n_shown"),
        suppressed_flag(F.col("n")).alias("n_hidden"),
        suppress_and_round(F.col("total")).alias("total_shown"),
    )


def _total_rollup(spark: SparkSession, sf: str, orgs: tuple[DataFrame, DataFrame] | None = None, categorised: DataFrame | None = None) -> DataFrame:
    """Rolled-up totals of all sources without breakdowns, which is all the published table uses."""
    rows = assembled(spark, sf, [], categorised)
    return metrics.hierarchy_rollup(metrics.ratio_metrics(rows, _reported(spark, sf)), *(orgs or _orgs(spark, sf)))


def _shown(c: str) -> str:
    return f"CASE WHEN {c} < 5 AND {c} > 0 THEN 0 ELSE CAST(round({c} / 5.0) * 5 AS BIGINT) END"


def total_steps(categories: str = SQL_CATEGORIES) -> dict[str, str]:
    """SQL steps up to the rolled-up totals and what is shown of them."""
    return {
        **element_steps([], categories),
        **_ROLLUP_STEPS,
        "rolled": SQL_ROLLUP,
        "shown": f"SELECT *, {_shown('Numerator')} AS num, {_shown('Denominator')} AS den FROM rolled",
    }


_TOTAL_STEPS = total_steps()
_TOTAL_INPUTS = _ROLLED_INPUTS
_BAND = ", ".join(metrics.BAND_KEYS)
SQL_BANDS = f"""
    SELECT {_BAND}, Org_Code, num AS Numerator, den AS Denominator, ratio AS Ratio,
           CAST(ntile(4) OVER (PARTITION BY {_BAND} ORDER BY ratio ASC NULLS FIRST, md5(coalesce(Org_Code, '')), Org_Code) AS INTEGER) AS Quartile
    FROM (SELECT *, CAST(num AS DOUBLE) / nullif(CAST(den AS DOUBLE), 0) AS ratio FROM shown) AS s"""


@query(with_inputs(SQL_BANDS, _TOTAL_INPUTS, _TOTAL_STEPS))
def quantile_bands(spark, sf):
    safe = publish.disclosure_safe(_total_rollup(spark, sf))
    safe = safe.select(*metrics.BAND_KEYS, "Org_Code", "Numerator", "Denominator", "Ratio")
    return metrics.quantile_bands(safe, metrics.BAND_KEYS, "Ratio", "Org_Code")


_SQL_RATIO_BANDS = f"SELECT {_BAND}, Quartile, CAST(Numerator AS DOUBLE) / nullif(CAST(Denominator AS DOUBLE), 0) AS share FROM bands"
_SQL_CUTOFFS = ", ".join(
    f"{extreme}(share) FILTER (WHERE Quartile = {k}) * 100 AS {name}"
    for extreme, k, name in [("max", 1, "Lower_Quartile"), ("max", 3, "Upper_Quartile"), ("min", 1, "Min_Value"), ("max", 4, "Max_Value"), ("max", 2, "Median")]
)
SQL_CUTS = f"SELECT {_BAND}, {_SQL_CUTOFFS} FROM ({_SQL_RATIO_BANDS}) AS shares GROUP BY {_BAND}"
_BAND_STEPS = {"bands": SQL_BANDS, "cuts": SQL_CUTS}


@query(with_inputs("SELECT * FROM cuts WHERE Date IS NOT NULL", _TOTAL_INPUTS, {**_TOTAL_STEPS, **_BAND_STEPS}))
def quantile_cutoffs(spark, sf):
    """The cut-offs as the published table takes them, from counts per ratio."""
    safe = publish.disclosure_safe(_total_rollup(spark, sf)).filter(F.col("Date").isNotNull())
    return metrics.cutoffs_from_ratios(safe)


@query(with_inputs("SELECT * FROM cuts WHERE Date IS NOT NULL", _TOTAL_INPUTS, {**_TOTAL_STEPS, **_BAND_STEPS}))
def quantile_cutoffs_banded(spark, sf):
    """The same from banded rows."""
    return metrics.quantile_cutoffs(quantile_bands(spark, sf).filter(F.col("Date").isNotNull()))


# --- publishing -----------------------------------------------------------------------------


_NAMES = ["Org_Name", "ICB_Code", "ICB_Name", "ICB_Map", "Region_Code", "Region_Name", "Region_Map"]


def _sql_named(level: str, code: str, name: str, icb: bool, region: bool, source: str) -> str:
    shown = [name] + [c if icb else f"CAST(NULL AS STRING) AS {c}" for c in _NAMES[1:4]] + [c if region else f"CAST(NULL AS STRING) AS {c}" for c in _NAMES[4:]]
    return f"SELECT DISTINCT '{level}' AS of_level, {code} AS of_code, {', '.join(shown)} FROM {source}"


SQL_NAMED = " UNION ALL ".join(
    [
        _sql_named("Provider", "ODS_Code", "ODS_Name AS Org_Name", True, True, "providers"),
        _sql_named("Commissioner", "Organisation_Code", "Organisation_Name AS Org_Name", True, True, "commissioners"),
        _sql_named("ICB", "ICB_Code", "ICB_Name AS Org_Name", True, True, "providers"),
        _sql_named("Region", "Region_Code", "Region_Name AS Org_Name", False, True, "providers"),
        _sql_named("National", "'ENG'", "'England' AS Org_Name", False, False, "(SELECT 1 AS one) AS one"),
    ]
)
_SQL_NAMES = ", ".join(_NAMES)
_SQL_NAMING = "LEFT JOIN named ON of_level = Level AND of_code = Org_Code"


@query(
    with_inputs(
        f"SELECT {', '.join(metrics.ROLLUP_KEYS)}, Numerator, Denominator, {_SQL_NAMES} FROM rolled {_SQL_NAMING}",
        _TOTAL_INPUTS,
        {**_TOTAL_STEPS, "named": SQL_NAMED},
    )
)
def decorate_by_level(spark, sf):
    orgs = _orgs(spark, sf)
    dims = dimensions.level_dimension(*orgs, spec.NATIONAL_CODE, spec.NATIONAL_NAME)
    return dimensions.decorate_by_level(_total_rollup(spark, sf, orgs), dims)


_SQL_WINDOW = (
    "{date} >= CAST('" + inputs.SINCE + "' AS DATE) AND (({segment} = '{special}' AND {date} <= CAST('"
    + inputs.UNTIL_MATERNITY + "' AS DATE)) OR ({segment} <> '{special}' AND {date} <= CAST('" + inputs.UNTIL + "' AS DATE)))"
)


@query(
    with_inputs(
        "SELECT RecordID, AuditID, SETTING_TYPE, ACTIVITY_DATE FROM records WHERE "
        + _SQL_WINDOW.format(date="ACTIVITY_DATE", segment="SETTING_TYPE", special="3"),
        "records",
    )
)
def reporting_windows(spark, sf):
    rows = inputs.records(spark, sf).select("RecordID", "AuditID", "SETTING_TYPE", "ACTIVITY_DATE")
    return publish.reporting_windows(
        rows, "ACTIVITY_DATE", "SETTING_TYPE", inputs.SINCE, "3", inputs.UNTIL_MATERNITY, inputs.UNTIL
    )


_SQL_TEXTS = ", ".join(
    f"{{0}}.{s}_Element_{t} AS {s}_{t}" for s in ("Numerator", "Denominator") for t in ("Description", "Source", "Logic")
)
_CUTS = ["Lower_Quartile", "Upper_Quartile", "Min_Value", "Max_Value", "Median"]
SQL_PUBLISHED = f"""
    SELECT s.Metric_ID, s.Metric_ID || ': ' || m.Metric_Name AS Metric_Name, m.Metric_Category, m.Metric_Type,
           s.Date, s.Service_Setting, s.Activity_Type, s.Aggregation_Source, s.Health_Inequalities_Group,
           s.Health_Inequalities_SubGroup, s.Level, s.Org_Code, {_SQL_NAMES}, s.num AS Numerator,
           CAST(coalesce(s.Numerator BETWEEN 0.0000001 AND 4.9999999, false) AS BIGINT) AS Numerator_Suppressed_Flag,
           s.den AS Denominator,
           CAST(coalesce(s.Denominator BETWEEN 0.0000001 AND 4.9999999, false) AS BIGINT) AS Denominator_Suppressed_Flag,
           {_SQL_TEXTS.format("m")}, {', '.join(_CUTS)}
    FROM (SELECT * FROM shown WHERE Service_Setting IS NOT NULL AND Activity_Type IS NOT NULL AND Date IS NOT NULL AND Org_Code IS NOT NULL) s
    JOIN metric_defs m ON m.Metric_ID = s.Metric_ID AND (coalesce(m.Metric_Setting, '') <> 'Maternity' OR s.Activity_Type = 'Maternity')
    LEFT JOIN cuts c ON {' AND '.join(f'c.{k} = s.{k}' for k in metrics.BAND_KEYS)}
    LEFT JOIN named ON of_level = s.Level AND of_code = s.Org_Code"""
_PUBLISH_INPUTS = _TOTAL_INPUTS
_PUBLISH_STEPS = {**_BAND_STEPS, "named": SQL_NAMED}


def _publish(spark: SparkSession, sf: str, rolled: DataFrame, orgs: tuple[DataFrame, DataFrame]) -> DataFrame:
    dims = dimensions.level_dimension(*orgs, spec.NATIONAL_CODE, spec.NATIONAL_NAME)
    return publish.publish_metrics(rolled, inputs.metric_defs(spark, sf), dims)


@query(with_inputs(SQL_PUBLISHED, _PUBLISH_INPUTS, {**_TOTAL_STEPS, **_PUBLISH_STEPS}))
def publish_metrics(spark, sf):
    orgs = _orgs(spark, sf)
    return _publish(spark, sf, _total_rollup(spark, sf, orgs), orgs)


_COLUMNS = [f.name for f in DASHBOARD_METRICS]
_CELL = "Date, Aggregation_Source, Service_Setting, Activity_Type"
SQL_PLACES = """
    SELECT DISTINCT i.ICB_Code AS Org_Code, i.ICB_Name AS Org_Name, i.ICB_Code, i.ICB_Name, i.ICB_Map, c.Region_Code, c.Region_Name, c.Region_Map
    FROM icb_ref i LEFT JOIN (SELECT DISTINCT ICB_Code, Region_Code, Region_Name, Region_Map FROM commissioners) c USING (ICB_Code)"""
SQL_DESCRIBED = (
    "SELECT DISTINCT Metric_ID, Metric_ID || ': ' || Metric_Name AS Metric_Name, Metric_Category, Metric_Type, "
    f"{_SQL_TEXTS.format('metric_defs')} FROM metric_defs WHERE Reporting_Flag = '1'"
)
_ONLY_GRID = {"Health_Inequalities_Group": "'Total'", "Health_Inequalities_SubGroup": "'Total'", "Level": "'ICB'"}
_SQL_DENSE_ROWS = ", ".join(_ONLY_GRID.get(c, c) + f" AS {c}" for c in _COLUMNS)
SQL_DENSE = f"""
    SELECT {', '.join(_COLUMNS)} FROM windowed WHERE Level <> 'ICB'
    UNION ALL
    SELECT {_SQL_DENSE_ROWS}
    FROM (SELECT DISTINCT {_CELL} FROM windowed WHERE Level = 'ICB') cells CROSS JOIN described CROSS JOIN places
    LEFT JOIN (SELECT Metric_ID, {_CELL}, Org_Code, {', '.join(publish._MEASURES)} FROM windowed WHERE Level = 'ICB') seen
    USING (Metric_ID, {_CELL}, Org_Code)"""


_SQL_WINDOWED = "SELECT * FROM published WHERE " + _SQL_WINDOW.format(date="Date", segment="Service_Setting", special="Maternity services")


@query(
    with_inputs(
        SQL_DENSE,
        _PUBLISH_INPUTS,
        {**_TOTAL_STEPS, **_PUBLISH_STEPS, "published": SQL_PUBLISHED, "windowed": _SQL_WINDOWED, "places": SQL_PLACES, "described": SQL_DESCRIBED},
    )
)
def densify_grid(spark, sf):
    orgs = _orgs(spark, sf)
    # Quartile groups lie within one date and setting, so the windows can come first.
    rolled = publish.reporting_windows(
        _total_rollup(spark, sf, orgs),
        "Date",
        "Service_Setting",
        inputs.SINCE,
        spec.MATERNITY_SETTING,
        inputs.UNTIL_MATERNITY,
        inputs.UNTIL,
    )
    places = publish.icb_places(inputs.icb_ref(spark, sf), orgs[1])
    return publish.densify_grid(_publish(spark, sf, rolled, orgs), places, _reported(spark, sf))


# --- the chained programme ---------------------------------------------------------------


_CLEAN_STEPS = {"checked": prepare.SQL_CHECKED, "clean": prepare.sql_found("(SELECT * FROM checked WHERE issues = 0 AND RecordID IS NOT NULL)")}


@query(
    with_inputs(
        SQL_PUBLISHED,
        _PUBLISH_INPUTS,
        {**_CLEAN_STEPS, **total_steps(sql_categories("clean", "Found")), **_PUBLISH_STEPS},
    )
)
def programme_published(spark, sf):
    """Raw records to the published table: checks, commissioners, elements of all sources, metrics, roll-up."""
    clean = prepare.cleaned(spark, sf, inputs.CATEGORY_COLUMNS)
    rows = elements.categorise(clean, inputs.ethnicities(spark, sf), inputs.areas_ref(spark, sf), commissioner="Found")
    orgs = _orgs(spark, sf)
    return _publish(spark, sf, _total_rollup(spark, sf, orgs, rows), orgs)
