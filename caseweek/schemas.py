"""Fixed schemas of the weekly extract, the fact table, dimensions and side tables."""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, IntegerType, StringType, StructField,
                               StructType, TimestampNTZType)

# ---- Fixed values: extract layout --------------------------------------------
# (header, type, field) in file order. Columns bind by position, the header line
# is skipped, so only the order and types matter.
EXTRACT_LAYOUT = [
    ("Severity", "string", "severity"),
    ("Customer Record ID", "string", "accountID"),
    ("Account Name", "string", "account"),
    ("Case Number", "int", "caseNum"),
    ("Status", "string", "status"),
    ("Date/Time Opened", "string", "dateOpen"),
    ("Date/Time Closed", "string", "dateClose"),
    ("Resolution Time", "string", "ResolutionTime"),
    ("Ambari Version", "string", "ambariVersion"),
    ("Stack Version", "string", "stackVersion"),
    ("Product Component", "string", "component"),
    ("Apache BugID URL", "string", "aBug"),
    ("Internal BugID URL", "string", "hBug"),
    ("HOTFIX BugID URL", "string", "hotfix"),
    ("EAR URL", "string", "EAR"),
    ("Root Cause", "string", "rootcause"),
    ("Enhancement Request Number", "string", "RMP"),
    ("Environment", "string", "Env"),
]

# Field order of a scanned extract row.
EXTRACT_FIELDS = [
    "severity", "caseNum", "status", "dateOpen", "dateClose", "account", "accountID",
    "ambariVersion", "stackVersion", "component", "hBug", "aBug", "hotfix", "EAR",
    "rootcause", "RMP", "Env", "ResolutionTime",
]

# Fact columns in table order, then the two partition columns.
FACT_COLUMNS = [
    "severity", "caseNum", "status", "dateOpen", "dateClose", "accountID",
    "ambariVersionID", "stackVersionID", "componentID", "hBug", "aBug", "hotfix",
    "EAR", "rootcauseID", "RMP", "Env", "ResolutionTime",
]
PARTITION_COLUMNS = ["year", "week"]
# ------------------------------------------------------------------------------

_TYPES = {"string": StringType(), "int": IntegerType()}

EXTRACT_SCHEMA = StructType(
    [StructField(h, _TYPES[t], True) for h, t, _ in EXTRACT_LAYOUT])

_TS_FACT = {"dateOpen", "dateClose"}
FACT_SCHEMA = StructType(
    [StructField(c, TimestampNTZType() if c in _TS_FACT else IntegerType(), True)
     for c in FACT_COLUMNS]
    + [StructField("year", IntegerType(), True), StructField("week", StringType(), True)])

VERSION_DIM_SCHEMA = StructType([StructField("version", StringType(), True),
                                 StructField("id", IntegerType(), True)])
NAME_DIM_SCHEMA = StructType([StructField("name", StringType(), True),
                              StructField("id", IntegerType(), True)])
ACCOUNT_DIM_SCHEMA = StructType([StructField("id", IntegerType(), True),
                                 StructField("name", StringType(), True)])

# Staging text files: name first, then the numeric id.
STAGING_SCHEMA = StructType([StructField("name", StringType(), True),
                             StructField("ID", StringType(), True)])

AUTOMATION_SCHEMA = StructType([
    StructField("CaseNum", IntegerType(), True),
    StructField("Case_Owner", StringType(), True),
    StructField("Description", StringType(), True),
    StructField("Actionable", BooleanType(), True),
    StructField("JIRA", StringType(), True),
    StructField("status", StringType(), True),
])

SMARTSENSE_SCHEMA = StructType([
    StructField("CaseNum", IntegerType(), True),
    StructField("Existing_Rule", StringType(), True),
    StructField("Suggestion", StringType(), True),
    StructField("Suggestion_Owner", StringType(), True),
    StructField("Reviewed_By", StringType(), True),
    StructField("JIRA", StringType(), True),
    StructField("status", StringType(), True),
    StructField("Priority", IntegerType(), True),
])

FINDINGS_SCHEMA = StructType([
    StructField("case_num", IntegerType(), True),
    StructField("code", StringType(), True),
    StructField("message", StringType(), True),
])
