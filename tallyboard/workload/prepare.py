"""Queries for ingest, record checks, dimensions and extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import spec
from ..operators import dimensions, ingest, quality
from ..sources.session import settle
from . import inputs
from .inputs import table, text, with_inputs

QUERIES: dict[str, inputs.Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def register(fn: inputs.Query) -> inputs.Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def _events(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    return table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "not a date").otherwise(day).alias("day"),
        F.nullif(F.col("user_id"), F.lit(7).cast("bigint")).alias("user_id"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("kind"),
        F.when(F.col("value") >= 2, text("event_id")).alias("version"),
        "value",
        "props",
    )


_SQL_EVENTS = """
    SELECT event_id,
           TRY_CAST(CASE WHEN event_type = 'error' THEN 'not a date' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS DATE) AS day,
           nullif(user_id, 7) AS user_id, nullif(event_type, 'view') AS kind,
           CASE WHEN value >= 2 THEN CAST(event_id AS STRING) END AS version, value, props
    FROM events"""


def _dated_events(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest_records(
        _events(spark, sf), ["event_id", "day", "user_id", "kind", "version", "value"], ["day"]
    )


@query(f"SELECT event_id, user_id, kind, day, value FROM ({_SQL_EVENTS}) AS e")
def ingest_records(spark, sf):
    return ingest.ingest_records(_events(spark, sf), ["event_id", "user_id", "kind", "day", "value"], ["day"])


_XREF = [("1", "101"), ("1", "102"), ("2", "202"), ("2", "202"), ("3", None)]


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(x.new_code, CAST(l_suppkey AS STRING)) AS code
        FROM lineitem LEFT JOIN (SELECT DISTINCT * FROM ({inputs._values(_XREF, ["old_code", "new_code"])}) AS v) AS x
          ON CAST(l_suppkey AS STRING) = x.old_code"""
)
def remap_codes(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", text("l_suppkey").alias("code")
    )
    xref = spark.sql(inputs._values(_XREF, ["old_code", "new_code"]))
    return ingest.remap_codes(lines, "code", xref, "old_code", "new_code")


_SQL_SUBMITTED = f"""
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS code,
           {inputs._SQL_PERIOD.format("o_orderdate")} AS period
    FROM orders"""


@query(f"SELECT * FROM ({_SQL_SUBMITTED}) AS s WHERE NOT (code = 'F' AND period = 'Period-03-1997')")
def exclude_known_bad(spark, sf):
    submitted = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")).alias("code"),
        inputs._period("o_orderdate").alias("period"),
    )
    return ingest.exclude_known_bad(submitted, {"code": "F", "period": "Period-03-1997"})


def sql_found(rows: str) -> str:
    """Rows with ``Found``: the first candidate among the codes in force."""
    known = "(SELECT Organisation_Code FROM commissioners_ref WHERE Effective_To IS NULL)"
    tried = ", ".join(f"CASE WHEN {c} IN {known} THEN {c} END" for c in spec.COMMISSIONER_CANDIDATES)
    return f"SELECT candidates.*, coalesce({tried}) AS Found FROM {rows} AS candidates"


@query(
    with_inputs(
        f"SELECT RecordID, AuditID, ODS_CODE, Found FROM ({sql_found('records')}) AS w",
        "records commissioners_ref",
    )
)
def waterfall_lookup(spark, sf):
    current = inputs.commissioners_ref(spark, sf).filter(F.col("Effective_To").isNull())
    rows = inputs.records(spark, sf).select("RecordID", "AuditID", "ODS_CODE", *spec.COMMISSIONER_CANDIDATES)
    found = ingest.waterfall_lookup(rows, spec.COMMISSIONER_CANDIDATES, current, "Organisation_Code", "Found")
    return found.select("RecordID", "AuditID", "ODS_CODE", "Found")


_SQL_DUPLICATES = """
    SELECT event_id, CASE WHEN user_id IS NULL OR kind IS NULL OR day IS NULL OR count(version) OVER same = 0
                            OR coalesce(version = max(version) OVER same, false) THEN 0 ELSE 1 END AS superseded
    FROM e WINDOW same AS (PARTITION BY user_id, kind, day)"""
_SQL_SINGLES = """
    SELECT event_id, CASE WHEN user_id IS NOT NULL AND day IS NOT NULL AND count(*) OVER (PARTITION BY user_id, day) = 1
                          THEN 1 ELSE 0 END AS singleton
    FROM e"""


@query(with_inputs(_SQL_DUPLICATES, "", {"e": _SQL_EVENTS}))
def flag_superseded(spark, sf):
    flagged = quality.flag_superseded(_dated_events(spark, sf), ["user_id", "kind", "day"], "version", "superseded")
    return flagged.select("event_id", "superseded")


@query(with_inputs(_SQL_SINGLES, "", {"e": _SQL_EVENTS}))
def flag_singletons(spark, sf):
    flagged = quality.flag_singletons(_dated_events(spark, sf), ["user_id", "day"], "singleton")
    return flagged.select("event_id", "singleton")


@query(
    f"""SELECT event_id, CASE WHEN day IS NOT NULL THEN 0 ELSE 1 END AS no_day,
               CASE WHEN kind IS NOT NULL THEN 0 ELSE 1 END AS no_kind FROM ({_SQL_EVENTS}) AS e"""
)
def flag_missing(spark, sf):
    rows = quality.flag_missing(_dated_events(spark, sf), "day", "no_day")
    return quality.flag_missing(rows, "kind", "no_kind").select("event_id", "no_day", "no_kind")


def _check(rows: DataFrame, keys, version, submission, date, setting) -> DataFrame:
    labels = [spec.DUPLICATE_LABEL, spec.DUMMY_LABEL, spec.DATE_LABEL, spec.SETTING_LABEL]
    return quality.check_records(rows, keys, version, submission, date, setting, labels, spec.NO_ISSUE)


_SQL_SUMMARY = """
    SELECT s.*, CASE WHEN DQ_Duplicates + DQ_Dummy + DQ_ActivityDate + DQ_Setting > 0 THEN 1 ELSE 0 END AS DQ_Flag,
           CASE WHEN DQ_Duplicates + DQ_Dummy + DQ_ActivityDate + DQ_Setting > 0
                THEN CASE WHEN DQ_Duplicates = 1 THEN '[Duplicate Record]' ELSE '' END
                  || CASE WHEN DQ_Dummy = 1 THEN '[Dummy Record]' ELSE '' END
                  || CASE WHEN DQ_ActivityDate = 1 THEN '[Invalid Activity Date]' ELSE '' END
                  || CASE WHEN DQ_Setting = 1 THEN '[Invalid Setting Type]' ELSE '' END
                ELSE 'No DQ Issue Identified' END AS DQ_Description
    FROM ({0}) AS s"""


@query(
    with_inputs(
        _SQL_SUMMARY.format(
            """SELECT e.event_id, superseded AS DQ_Duplicates, singleton AS DQ_Dummy,
                      CASE WHEN day IS NULL THEN 1 ELSE 0 END AS DQ_ActivityDate,
                      CASE WHEN kind IS NULL THEN 1 ELSE 0 END AS DQ_Setting
               FROM e LEFT JOIN dup ON e.event_id = dup.event_id LEFT JOIN one ON e.event_id = one.event_id"""
        ),
        "",
        {"e": _SQL_EVENTS, "dup": _SQL_DUPLICATES, "one": _SQL_SINGLES},
    )
)
def quality_summary(spark, sf):
    checked = _check(_dated_events(spark, sf), ["user_id", "kind", "day"], "version", ["user_id", "day"], "day", "kind")
    flags = ["DQ_Duplicates", "DQ_Dummy", "DQ_ActivityDate", "DQ_Setting", "DQ_Flag", "DQ_Description"]
    return checked.select("event_id", *flags)


SQL_CHECKED = """
    SELECT *, CASE WHEN coalesce(outdated, false) OR coalesce(alone, false) OR ACTIVITY_DATE IS NULL OR SETTING_TYPE IS NULL THEN 1 ELSE 0 END AS issues
    FROM (SELECT records.*,
                 Person IS NOT NULL AND HOSPITAL_SPELL_ID IS NOT NULL AND ACTIVITY_DATE IS NOT NULL
                   AND coalesce(AuditID <> max(AuditID) OVER version, max(AuditID) OVER version IS NOT NULL) AS outdated,
                 ODS_CODE IS NOT NULL AND REPORTING_PERIOD IS NOT NULL AND count(*) OVER submission = 1 AS alone
          FROM records
          WINDOW version AS (PARTITION BY Person, HOSPITAL_SPELL_ID, ACTIVITY_DATE),
                 submission AS (PARTITION BY ODS_CODE, REPORTING_PERIOD)) AS judged"""
_KEPT = ["RecordID", "AuditID", "ODS_CODE", "REPORTING_PERIOD", "ACTIVITY_DATE"]


def cleaned(spark: SparkSession, sf: str, columns) -> DataFrame:
    """Clean records with the given columns and ``Found``; only what is used is written down."""
    used = {*columns, "RecordID", inputs.PERSON, "HOSPITAL_SPELL_ID", "ACTIVITY_DATE", "AuditID", "ODS_CODE", "REPORTING_PERIOD", "SETTING_TYPE", *spec.COMMISSIONER_CANDIDATES}
    rows = settle(inputs.records(spark, sf).select(*sorted(used)))
    checked = _check(
        rows,
        [inputs.PERSON, "HOSPITAL_SPELL_ID", "ACTIVITY_DATE"],
        "AuditID",
        ["ODS_CODE", "REPORTING_PERIOD"],
        "ACTIVITY_DATE",
        "SETTING_TYPE",
    )
    current = inputs.commissioners_ref(spark, sf).filter(F.col("Effective_To").isNull())
    wanted = list(dict.fromkeys([*columns, *spec.COMMISSIONER_CANDIDATES]))
    return quality.clean_records(
        checked, "RecordID", wanted, spec.COMMISSIONER_CANDIDATES, current, "Organisation_Code", "Found", rows
    )


@query(
    with_inputs(
        f"SELECT {', '.join(_KEPT)}, Found FROM ({sql_found('(SELECT * FROM checked WHERE issues = 0 AND RecordID IS NOT NULL)')}) AS found",
        "records commissioners_ref",
        {"checked": SQL_CHECKED},
    )
)
def clean_records(spark, sf):
    return cleaned(spark, sf, _KEPT).select(*_KEPT, "Found")


SQL_PROVIDERS = """
    SELECT code AS ODS_Code, shown AS ODS_Name, above AS ICB_Code,
           (SELECT max(ICB_Name) FROM icb_ref WHERE ICB_Code = above) AS ICB_Name,
           (SELECT max(ICB_Map) FROM icb_ref WHERE ICB_Code = above) AS ICB_Map,
           top AS Region_Code,
           (SELECT max(Region) FROM region_ref WHERE Region_Code = top) AS Region_Name,
           (SELECT max(Region_Map) FROM region_ref WHERE Region_Code = top) AS Region_Map
    FROM (SELECT seen.code, coalesce(o.Name, Organisation_Name) AS shown, coalesce(o.ICB, High_Level_Health_Authority_Code) AS above,
                 coalesce(o.Region, National_Grouping_Code) AS top
          FROM (SELECT DISTINCT CAST(l_suppkey AS STRING) AS code FROM lineitem) AS seen
          LEFT JOIN overrides o ON o.Code = seen.code
          LEFT JOIN providers_ref ON Organisation_Code = seen.code AND Is_Latest = 1) AS known"""
SQL_COMMISSIONERS = """
    SELECT DISTINCT Organisation_Code, Organisation_Name, Organisation_Code_Name, STP_Code AS ICB_Code, STP_Name AS ICB_Name,
           STP_Code_Name AS ICB_Code_Name, ICB_Map, Region_Code, Region AS Region_Name, Region_Code_Name, Region_Map
    FROM commissioners_ref LEFT JOIN (SELECT ICB_Code, ICB_Map FROM icb_ref) AS maps USING (ICB_Code) LEFT JOIN region_ref USING (Region_Code)
    WHERE Effective_To IS NULL"""


@query(with_inputs(SQL_PROVIDERS, "providers_ref icb_ref region_ref overrides"))
def provider_dimension(spark, sf):
    return dimensions.provider_dimension(
        table(spark, sf, "lineitem").select(text("l_suppkey").alias("ODS_CODE")),
        inputs.providers_ref(spark, sf).filter("Is_Latest = 1"),
        inputs.icb_ref(spark, sf),
        inputs.region_ref(spark, sf),
        inputs.overrides(spark, sf),
    )


@query(with_inputs(SQL_COMMISSIONERS, "commissioners_ref icb_ref region_ref"))
def commissioner_dimension(spark, sf):
    return dimensions.commissioner_dimension(
        inputs.commissioners_ref(spark, sf), inputs.icb_ref(spark, sf), inputs.region_ref(spark, sf)
    )


SQL_FIRST_BOOKINGS = f"""
    SELECT OrgCodeProvider, upper(PregnancyID) AS PregnancyID, min(AntenatalAppDate) AS MinBookingDate
    FROM bookings WHERE AntenatalAppDate >= CAST('{inputs.SINCE}' AS DATE)
    GROUP BY OrgCodeProvider, upper(PregnancyID)"""


@query(with_inputs(SQL_FIRST_BOOKINGS, "bookings"))
def first_event_per_key(spark, sf):
    return ingest.first_event_per_key(
        inputs.bookings(spark, sf),
        "OrgCodeProvider",
        "PregnancyID",
        "AntenatalAppDate",
        inputs.SINCE,
        "MinBookingDate",
    )


@query(
    with_inputs(
        f"SELECT * FROM admissions WHERE Deleted = '0' AND Admission_Date >= CAST('{inputs.SINCE}' AS DATE)",
        "admissions",
    )
)
def activity_extract(spark, sf):
    return ingest.activity_extract(
        inputs.admissions(spark, sf), "Admission_Date", inputs.SINCE, [F.col("Deleted") == "0"]
    )
