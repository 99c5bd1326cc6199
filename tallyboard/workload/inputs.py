"""The test tables in the shape of the programme's inputs.

Order lines are the records, suppliers the providers, customers the
commissioners, nations the ICBs and regions the regions. Each input is given as a
DataFrame function and as SQL text that Spark and DuckDB both run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PERSON = "Person"
SINCE = "1996-01-01"
UNTIL_MATERNITY = "2000-06-30"
UNTIL = "2001-03-31"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(column: str) -> Column:
    return F.col(column).cast("string")


def _period(column: str) -> Column:
    return F.concat(F.lit("Period-"), F.date_format(column, "MM-yyyy"))


_SQL_PERIOD = "'Period-' || lpad(CAST(month({0}) AS STRING), 2, '0') || '-' || CAST(year({0}) AS STRING)"


WRITTEN_RECORDS: dict[str, str] = {}
"""Path of a written ``records`` table by data folder; the benchmark gives both forms the same one."""


def records(spark: SparkSession, sf: str) -> DataFrame:
    if sf in WRITTEN_RECORDS:
        return spark.read.parquet(WRITTEN_RECORDS[sf])
    lines = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    customer = text("o_custkey")
    line = F.col("l_linenumber")
    return lines.select(
        F.when(~((F.col("l_discount") == 0.1) & (line == 7)), F.concat(text("l_orderkey"), F.lit("-"), line.cast("string"))).alias("RecordID"),
        text("l_partkey").alias("AuditID"),
        _period("l_shipdate").alias("REPORTING_PERIOD"),
        text("l_suppkey").alias("ODS_CODE"),
        F.concat(F.lit("Supplier "), text("l_suppkey")).alias("ODS_Name"),
        F.when((F.col("l_tax") == 0.07) & (F.col("l_returnflag") == "R"), None)
        .when(F.col("l_linestatus") == "O", "1")
        .when(F.col("l_returnflag") == "A", "3")
        .otherwise("2")
        .alias("SETTING_TYPE"),
        line.cast("string").alias("ACTIVITY_TYPE"),
        F.when(~((F.col("l_tax") == 0.08) & (F.col("o_orderstatus") == "P")), F.col("l_shipdate").cast("date")).alias("ACTIVITY_DATE"),
        F.concat(F.lit("s"), text("o_orderkey")).alias("HOSPITAL_SPELL_ID"),
        F.concat(F.lit("p"), text("o_orderkey")).alias("PREGNANCY_ID"),
        F.translate("l_returnflag", "ANR", "123").alias("GENDER"),
        F.translate(F.left("o_orderpriority", F.lit(1)), "12345", "ADHMZ").alias("ETHNICITY"),
        F.when(F.col("l_discount") >= 0.05, "1").when(F.col("l_discount") >= 0.02, "2").alias("SMOKINGSTATUS"),
        F.when(F.col("l_tax") >= 0.04, "Y").otherwise("N").alias("INHOUSE_REFERRAL"),
        F.when(F.col("l_quantity") < 25, "Y").otherwise("N").alias("SEEN_INHOUSE"),
        F.when(line == 1, "20").when(line == 2, "30").when(line == 3, "70").when(line != 4, "10").alias("TOBACCODEPENDENCE_CAREPLAN"),
        F.when(F.col("o_orderstatus") == "F", "4").otherwise("1").alias("OUTCOME_AT28DAYS"),
        F.when(F.col("o_orderstatus") == "F", customer).otherwise("none").alias("CCG_OF_REGISTRATION"),
        F.when(F.col("o_orderstatus") == "P", customer).alias("CCG_OF_RESIDENCE"),
        customer.alias("Der_Postcode_CCG_Code"),
        customer.alias("SubICB_Code"),
        text("l_partkey").alias("LSOA_OF_RESIDENCE"),
        F.col("l_quantity").cast("bigint").cast("string").alias("Der_Age_at_CDS_Activity_Date"),
        customer.alias(PERSON),
    )


def providers_ref(spark: SparkSession, sf: str) -> DataFrame:
    suppliers = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    return suppliers.select(
        text("s_suppkey").alias("Organisation_Code"),
        F.col("s_name").alias("Organisation_Name"),
        F.concat(F.lit("N"), text("n_nationkey")).alias("High_Level_Health_Authority_Code"),
        F.concat(F.lit("R"), text("n_regionkey")).alias("National_Grouping_Code"),
        F.when(F.col("s_acctbal") > 500, 1).otherwise(0).alias("Is_Latest"),
    )


def icb_ref(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(
        F.concat(F.lit("N"), text("n_nationkey")).alias("ICB_Code"),
        F.col("n_name").alias("ICB_Name"),
        F.concat(F.lit("Map of "), "n_name").alias("ICB_Map"),
    )


def region_ref(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "region").select(
        F.concat(F.lit("R"), text("r_regionkey")).alias("Region_Code"),
        F.col("r_name").alias("Region"),
        F.concat(F.lit("Map of "), "r_name").alias("Region_Map"),
    )


def commissioners_ref(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return customers.select(
        text("c_custkey").alias("Organisation_Code"),
        F.col("c_name").alias("Organisation_Name"),
        F.concat(text("c_custkey"), F.lit(": "), "c_name").alias("Organisation_Code_Name"),
        F.concat(F.lit("N"), text("n_nationkey")).alias("STP_Code"),
        F.col("n_name").alias("STP_Name"),
        F.concat(F.lit("N"), text("n_nationkey"), F.lit(": "), "n_name").alias("STP_Code_Name"),
        F.concat(F.lit("N"), text("n_nationkey")).alias("ICB_Code"),
        F.concat(F.lit("R"), text("n_regionkey")).alias("Region_Code"),
        F.concat(F.lit("Region "), text("n_regionkey")).alias("Region_Code_Name"),
        F.when(F.col("c_acctbal") < 500, F.lit("2000-01-01").cast("date")).alias("Effective_To"),
    )


def areas_ref(spark: SparkSession, sf: str) -> DataFrame:
    decile = F.floor((F.col("p_size") - 1) / 5).cast("int") + 1
    return table(spark, sf, "part").select(text("p_partkey").alias("LSOA_Code"), decile.cast("string").alias("IMD_Decile"))


def aggregates(spark: SparkSession, sf: str) -> DataFrame:
    ordinary = F.col("l_linestatus") == "O"

    def when(flag: str, inside: bool, value) -> Column:
        return F.when((ordinary if inside else ~ordinary) & (F.col("l_returnflag") == flag), value)

    return table(spark, sf, "lineitem").select(
        _period("l_shipdate").alias("Reporting_Period"),
        text("l_suppkey").alias("ODS_Code"),
        F.when(ordinary, F.col("l_quantity")).alias("COMPLETESMOKINGSTATUS_IP"),
        when("N", True, 1.0).alias("COMPLETESMOKINGSTATUS_OP"),
        when("A", False, 20.0).alias("COMPLETESMOKINGSTATUS_MATERNITY"),
        when("R", False, 1.0).alias("COMPLETESMOKINGSTATUS_MENTALHEALTH_CMHS"),
        when("N", False, 2.0).alias("COMPLETESMOKINGSTATUS_MENTALHEALTH_IP"),
        when("R", False, 1.0).alias("COMPLETESMOKINGSTATUS_MENTALHEALTH_OP"),
        when("R", True, 1.0).alias("COMPLETESMOKINGSTATUS_COMMUNITY_IP"),
    )


def admissions(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").filter(F.col("l_linestatus") == "O")
    return rows.select(
        F.when(F.col("l_tax") == 0, "1").otherwise("0").alias("Deleted"),
        F.col("l_shipdate").cast("date").alias("Admission_Date"),
        text("l_suppkey").alias("Provider_Code"),
        F.when(F.col("l_returnflag") == "R", "2").otherwise("1").alias("Patient_Classification"),
        F.col("l_quantity").cast("int").alias("Age_At_Start_of_Spell_SUS"),
        F.nullif(line.cast("string"), F.lit("7")).alias("Discharge_Method"),
        F.when(line == 2, "424").when(line == 3, "501").when(line != 5, "300").alias("Der_Admit_Treatment_Function_Code"),
        F.concat(F.lit("S"), text("l_orderkey")).alias("Hospital_Spell_No"),
    )


def spells(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "A"))
    return rows.select(
        F.col("l_shipdate").cast("date").alias("StartDateHospProvSpell"),
        text("l_suppkey").alias("OrgIDProv"),
        (F.col("l_linenumber") - 1).alias("LOSDischHosSpell"),
        F.col("l_quantity").cast("int").alias("Der_Age_at_StartDateHospProvSpell"),
        F.concat(F.when(F.col("l_tax") > 0.03, "S").otherwise("s"), text("l_orderkey")).alias("HospProvSpellID"),
    )


def bookings(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A"))
    return rows.select(
        text("l_suppkey").alias("OrgCodeProvider"),
        F.concat(F.when(F.col("l_tax") > 0.03, "P").otherwise("p"), text("l_orderkey")).alias("PregnancyID"),
        F.col("l_shipdate").cast("date").alias("AntenatalAppDate"),
    )


def submission_log(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        _period("l_shipdate").alias("ReportingPeriod"),
        text("l_suppkey").alias("OrganisationCode"),
        F.when(F.col("l_linestatus") == "F", "Complete").otherwise("Draft").alias("StatusofSubmission"),
    )


def expected_providers(spark: SparkSession, sf: str) -> DataFrame:
    settings = F.array(*[F.lit(s) for s in ("Physical Acute", "Maternity", "Adult Mental Health")])
    return table(spark, sf, "supplier").select(
        F.concat(F.lit("old"), text("s_suppkey")).alias("Org_Code"),
        text("s_suppkey").alias("Org_Code_Current"),
        F.explode(settings).alias("Setting_Type"),
        F.when(F.col("s_nationkey") == 3, "N4").alias("Specified_ICB"),
        F.when(F.col("s_acctbal") > 0, "1").otherwise("0").alias("DQ_Flag"),
    )


CATEGORY_COLUMNS = (
    "RecordID ODS_CODE SETTING_TYPE ACTIVITY_TYPE ACTIVITY_DATE GENDER ETHNICITY SMOKINGSTATUS INHOUSE_REFERRAL "
    "LSOA_OF_RESIDENCE Der_Age_at_CDS_Activity_Date"
).split()
"""What the categories and the rules below read of a record."""
ETHNICITIES = [("A", "British"), ("D", "Mixed"), ("H", "Indian"), ("M", "African")]
OVERRIDES = [("3", "Third supplier", "N1", "R2"), ("5", None, "N2", None)]
RULES = [
    {"Element_ID": "001", "Element_Logic": "SMOKINGSTATUS IS NOT NULL"},
    {"Element_ID": "002", "Element_Logic": "GENDER = '3'"},
    {"Element_ID": "003", "Element_Logic": "SMOKINGSTATUS = '1' AND INHOUSE_REFERRAL = 'Y'"},
    {"Element_ID": "004", "Element_Logic": "IMD_Decile IN ('1', '2') OR Main_Description = 'African'"},
]
_DEF_COLUMNS = (
    "Metric_ID Metric_Name Metric_Category Metric_Type Metric_Setting Reporting_Flag "
    "Numerator_Element Denominator_Element Numerator_Element_Description Numerator_Element_Source "
    "Numerator_Element_Logic Denominator_Element_Description Denominator_Element_Source Denominator_Element_Logic"
).split()
DEFS = [
    ("M1", "Returned", "Use", "Proportion", "All", "1", "2", "1", "Returned lines", "Lines", "flag", "All lines", "Lines", "any"),
    ("M2", "Discounted", "Use", "Proportion", "Maternity", "1", "003", "001", "Discounted lines", "Lines", "discount", "All lines", "Lines", "any"),
    ("M3", "Small", "Volume", "Count", None, "1", "004", None, "Small lines", "Lines", "size", None, None, None),
    ("M5", "Recorded", "Use", "Proportion", "All", "1", "1", "010", "Recorded", "Counts", "sum", "Activity", "Events", "count"),
    ("M4", "Same", "Volume", "Proportion", "All", "0", "1", "1", "All lines", "Lines", "any", "All lines", "Lines", "any"),
]


def ethnicities(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SQL["ethnicities"])


def overrides(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SQL["overrides"])


def metric_defs(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(SQL["metric_defs"])


def _values(rows, columns) -> str:
    def literal(v):
        return "CAST(NULL AS STRING)" if v is None else f"'{v}'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


SQL: dict[str, str] = {
    "ethnicities": _values(ETHNICITIES, ["Main_Code_Text", "Main_Description"]),
    "overrides": _values(OVERRIDES, ["Code", "Name", "ICB", "Region"]),
    "metric_defs": _values(DEFS, _DEF_COLUMNS),
    "records": f"""
        SELECT CASE WHEN NOT (l_discount = 0.1 AND l_linenumber = 7)
                    THEN CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) END AS RecordID,
               CAST(l_partkey AS STRING) AS AuditID,
               {_SQL_PERIOD.format("l_shipdate")} AS REPORTING_PERIOD,
               CAST(l_suppkey AS STRING) AS ODS_CODE,
               'Supplier ' || CAST(l_suppkey AS STRING) AS ODS_Name,
               CASE WHEN l_tax = 0.07 AND l_returnflag = 'R' THEN NULL WHEN l_linestatus = 'O' THEN '1'
                    WHEN l_returnflag = 'A' THEN '3' ELSE '2' END AS SETTING_TYPE,
               CAST(l_linenumber AS STRING) AS ACTIVITY_TYPE,
               CASE WHEN NOT (l_tax = 0.08 AND o_orderstatus = 'P') THEN CAST(l_shipdate AS DATE) END AS ACTIVITY_DATE,
               's' || CAST(o_orderkey AS STRING) AS HOSPITAL_SPELL_ID,
               'p' || CAST(o_orderkey AS STRING) AS PREGNANCY_ID,
               translate(l_returnflag, 'ANR', '123') AS GENDER,
               translate(substr(o_orderpriority, 1, 1), '12345', 'ADHMZ') AS ETHNICITY,
               CASE WHEN l_discount >= 0.05 THEN '1' WHEN l_discount >= 0.02 THEN '2' END AS SMOKINGSTATUS,
               CASE WHEN l_tax >= 0.04 THEN 'Y' ELSE 'N' END AS INHOUSE_REFERRAL,
               CASE WHEN l_quantity < 25 THEN 'Y' ELSE 'N' END AS SEEN_INHOUSE,
               CASE l_linenumber WHEN 1 THEN '20' WHEN 2 THEN '30' WHEN 3 THEN '70' WHEN 4 THEN NULL ELSE '10' END
                   AS TOBACCODEPENDENCE_CAREPLAN,
               CASE WHEN o_orderstatus = 'F' THEN '4' ELSE '1' END AS OUTCOME_AT28DAYS,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS STRING) ELSE 'none' END AS CCG_OF_REGISTRATION,
               CASE WHEN o_orderstatus = 'P' THEN CAST(o_custkey AS STRING) END AS CCG_OF_RESIDENCE,
               CAST(o_custkey AS STRING) AS Der_Postcode_CCG_Code,
               CAST(o_custkey AS STRING) AS SubICB_Code,
               CAST(l_partkey AS STRING) AS LSOA_OF_RESIDENCE,
               CAST(CAST(l_quantity AS BIGINT) AS STRING) AS Der_Age_at_CDS_Activity_Date,
               CAST(o_custkey AS STRING) AS Person
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "providers_ref": """
        SELECT CAST(s_suppkey AS STRING) AS Organisation_Code, s_name AS Organisation_Name,
               'N' || CAST(n_nationkey AS STRING) AS High_Level_Health_Authority_Code,
               'R' || CAST(n_regionkey AS STRING) AS National_Grouping_Code,
               CASE WHEN s_acctbal > 500 THEN 1 ELSE 0 END AS Is_Latest
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "icb_ref": """
        SELECT 'N' || CAST(n_nationkey AS STRING) AS ICB_Code, n_name AS ICB_Name, 'Map of ' || n_name AS ICB_Map
        FROM nation""",
    "region_ref": """
        SELECT 'R' || CAST(r_regionkey AS STRING) AS Region_Code, r_name AS Region, 'Map of ' || r_name AS Region_Map
        FROM region""",
    "commissioners_ref": """
        SELECT CAST(c_custkey AS STRING) AS Organisation_Code, c_name AS Organisation_Name,
               CAST(c_custkey AS STRING) || ': ' || c_name AS Organisation_Code_Name,
               'N' || CAST(n_nationkey AS STRING) AS STP_Code, n_name AS STP_Name,
               'N' || CAST(n_nationkey AS STRING) || ': ' || n_name AS STP_Code_Name,
               'N' || CAST(n_nationkey AS STRING) AS ICB_Code,
               'R' || CAST(n_regionkey AS STRING) AS Region_Code,
               'Region ' || CAST(n_regionkey AS STRING) AS Region_Code_Name,
               CASE WHEN c_acctbal < 500 THEN CAST('2000-01-01' AS DATE) END AS Effective_To
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "areas_ref": """
        SELECT CAST(p_partkey AS STRING) AS LSOA_Code,
               CAST(CAST(floor((p_size - 1) / 5) AS INTEGER) + 1 AS STRING) AS IMD_Decile
        FROM part""",
    "aggregates": f"""
        SELECT {_SQL_PERIOD.format("l_shipdate")} AS Reporting_Period,
               CAST(l_suppkey AS STRING) AS ODS_Code,
               CASE WHEN l_linestatus = 'O' THEN l_quantity END AS COMPLETESMOKINGSTATUS_IP,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 1.0 END AS COMPLETESMOKINGSTATUS_OP,
               CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'A' THEN 20.0 END AS COMPLETESMOKINGSTATUS_MATERNITY,
               CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'R' THEN 1.0 END AS COMPLETESMOKINGSTATUS_MENTALHEALTH_CMHS,
               CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'N' THEN 2.0 END AS COMPLETESMOKINGSTATUS_MENTALHEALTH_IP,
               CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'R' THEN 1.0 END AS COMPLETESMOKINGSTATUS_MENTALHEALTH_OP,
               CASE WHEN l_linestatus = 'O' AND l_returnflag = 'R' THEN 1.0 END AS COMPLETESMOKINGSTATUS_COMMUNITY_IP
        FROM lineitem""",
    "admissions": """
        SELECT CASE WHEN l_tax = 0 THEN '1' ELSE '0' END AS Deleted,
               CAST(l_shipdate AS DATE) AS Admission_Date,
               CAST(l_suppkey AS STRING) AS Provider_Code,
               CASE WHEN l_returnflag = 'R' THEN '2' ELSE '1' END AS Patient_Classification,
               CAST(l_quantity AS INTEGER) AS Age_At_Start_of_Spell_SUS,
               nullif(CAST(l_linenumber AS STRING), '7') AS Discharge_Method,
               CASE WHEN l_linenumber = 2 THEN '424' WHEN l_linenumber = 3 THEN '501'
                    WHEN l_linenumber <> 5 THEN '300' END AS Der_Admit_Treatment_Function_Code,
               'S' || CAST(l_orderkey AS STRING) AS Hospital_Spell_No
        FROM lineitem WHERE l_linestatus = 'O'""",
    "spells": """
        SELECT CAST(l_shipdate AS DATE) AS StartDateHospProvSpell,
               CAST(l_suppkey AS STRING) AS OrgIDProv,
               l_linenumber - 1 AS LOSDischHosSpell,
               CAST(l_quantity AS INTEGER) AS Der_Age_at_StartDateHospProvSpell,
               CASE WHEN l_tax > 0.03 THEN 'S' ELSE 's' END || CAST(l_orderkey AS STRING) AS HospProvSpellID
        FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'A'""",
    "bookings": """
        SELECT CAST(l_suppkey AS STRING) AS OrgCodeProvider,
               CASE WHEN l_tax > 0.03 THEN 'P' ELSE 'p' END || CAST(l_orderkey AS STRING) AS PregnancyID,
               CAST(l_shipdate AS DATE) AS AntenatalAppDate
        FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'A'""",
    "submission_log": f"""
        SELECT {_SQL_PERIOD.format("l_shipdate")} AS ReportingPeriod,
               CAST(l_suppkey AS STRING) AS OrganisationCode,
               CASE WHEN l_linestatus = 'F' THEN 'Complete' ELSE 'Draft' END AS StatusofSubmission
        FROM lineitem""",
    "expected_providers": """
        SELECT 'old' || CAST(s_suppkey AS STRING) AS Org_Code, CAST(s_suppkey AS STRING) AS Org_Code_Current,
               Setting_Type, CASE WHEN s_nationkey = 3 THEN 'N4' END AS Specified_ICB,
               CASE WHEN s_acctbal > 0 THEN '1' ELSE '0' END AS DQ_Flag
        FROM supplier CROSS JOIN
             (VALUES ('Physical Acute'), ('Maternity'), ('Adult Mental Health')) AS t(Setting_Type)""",
}


def with_inputs(body: str, names: str, extra: dict[str, str] | None = None) -> str:
    """SQL text that defines the named inputs, then any extra steps, before ``body``."""
    parts = {name: SQL[name] for name in names.split()} | (extra or {})
    steps = ",\n".join(f"{name} AS ({query})" for name, query in parts.items())
    return f"WITH {steps}\n{body}" if parts else body


Query = Callable[[SparkSession, str], DataFrame]
