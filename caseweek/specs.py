"""Domain presets as small spec objects, so the operators work on any table.

Everything case-specific (severity texts, link prefixes, record-quality rules,
the dimension list) lives here; the operators only read these objects.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- Fixed values (must equal the reference's for right results) -------------
SEVERITY_CODES = [
    ("S1 - Production Down", 1),
    ("S2 - Core Feature Inoperative", 2),
    ("S3 - Minor Feature Inoperative", 3),
    ("S4 - Request for Information", 4),
]
SEVERITY_OTHER = -1
CLOSED_STATUS = "closed"          # compared ignoring case -> 0, anything else -> 1
NOT_USED_MEMBER = "Not used"      # the Ambari-version member for a null value
LOOKUP_MISS_ID = -1               # id of a natural key absent from its dimension
ACCOUNT_MISS_ID = -1              # account id when the record id is blank/bad
# Resolution time text "<d> days <h> hours<m> mn" -> minutes.
DURATION_UNITS = [("days", 1440), ("hours", 60), ("mn", 1)]
# Two extract timestamp layouts, tried in this order (Java-style patterns).
TIMESTAMP_LAYOUTS = ["yyyyMMdd HHmmss", "MM/dd/yy HH:mm"]
# Two-digit years fall in [as_of - 80 years, as_of + 20 years).
TWO_DIGIT_YEAR_WINDOW_BACK = 80
# A week runs Sunday..Saturday and is labelled by its Friday as MM-dd.
WEEK_LABEL_FORMAT = "MM-dd"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class DimensionSpec:
    """A surrogate-keyed dimension fed by one extract column."""
    name: str            # dimension table name
    column: str          # extract field holding the natural key
    key: str             # natural-key column in the dimension table
    fact_column: str     # id column in the fact table
    null_member: str | None = None   # member that stands for a null key


# ---- Fixed values: the four surrogate-keyed dimensions ------------------------
SURROGATE_DIMENSIONS = [
    DimensionSpec("ambariVersion", "ambariVersion", "version", "ambariVersionID",
                  null_member=NOT_USED_MEMBER),
    DimensionSpec("stackVersion", "stackVersion", "version", "stackVersionID"),
    DimensionSpec("product", "component", "name", "componentID"),
    DimensionSpec("rootcause", "rootcause", "name", "rootcauseID"),
]
ACCOUNT_DIMENSION = "account"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class LinkSpec:
    """An issue-link column: its id pattern and finding codes/messages.

    ``pattern`` must fully match the upper-cased link tail; its group
    ``id_group`` is the id. ``project_group`` (upstream issues) must equal
    the case's component, ignoring case.
    """
    column: str
    code: str
    pattern: str
    invalid_message: str          # {tail}
    unusable_message: str         # {link}
    id_group: int = 1
    project_group: int | None = None
    mismatch_code: str | None = None
    mismatch_message: str | None = None   # {tail}, {component}


# ---- Fixed values: link rules (codes and neutral message texts) ---------------
NO_DASH_CODE = "L0"
NO_DASH_MESSAGE = "Invalid issue link: {link}"
LINKS = [
    LinkSpec("hBug", "L1", r"(?:BUG-)?(\d+)",
             "Invalid internal bug: {tail}", "Invalid internal bug link: {link}"),
    LinkSpec("aBug", "L2", r"([A-Z]*)-(\d+)",
             "Invalid upstream issue: {tail}", "Invalid upstream issue link: {link}",
             id_group=2, project_group=1, mismatch_code="L2M",
             mismatch_message="The upstream issue {tail} doesn't match the problematic component {component}."),
    LinkSpec("hotfix", "L3", r"(?:HOTFIX)-(\d+)",
             "Invalid hotfix: {tail}", "Invalid hotfix link: {link}"),
    LinkSpec("EAR", "L4", r"(?:EAR-)?(\d+)",
             "Invalid EAR: {tail}", "Invalid EAR link: {link}"),
    LinkSpec("RMP", "L5", r"(?:RMP-)?(\d+)",
             "Invalid enhancement request: {tail}", "Invalid enhancement request link: {link}"),
]
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class RuleSpec:
    """A record-quality rule for closed cases; the first matching rule wins."""
    code: str
    root_causes: tuple[str, ...]      # compared ignoring case
    message: str                      # {rootcause}
    severity: int | None = None       # required severity code
    missing: tuple[str, ...] = field(default=())   # ids that must all be null


# The finding of a line whose fields don't fit the extract layout (such a line is refused).
MISFIT_RULE = RuleSpec("X1", (), "The line doesn't have the fields of the extract layout.")


# ---- Fixed values: record-quality rules, in evaluation order ------------------
RULES = [
    RuleSpec("R1", ("Undetermined at this time",),
             "Case is closed with invalid Root Cause {rootcause}."),
    RuleSpec("R2", ("Working as Designed", "Use Case Advice"),
             "S1(Production Down) should NOT be caused by root cause: {rootcause}.",
             severity=1),
    RuleSpec("R3", ("Documentation Defect",),
             "Case caused by {rootcause} without any Doc BUG filed.",
             missing=("hBug",)),
    RuleSpec("R4", ("System Limitation",),
             "Case caused by {rootcause} without any RMP filed.",
             missing=("RMP",)),
    RuleSpec("R5", ("No Customer Response",),
             "Is this a real S1 (Production Down) with No Customer Response?",
             severity=1),
    RuleSpec("R6", ("Product Defect",),
             "Case is closed with Root Cause {rootcause}, but there is no proper BUG documented.",
             missing=("hBug", "aBug")),
]
# ------------------------------------------------------------------------------
