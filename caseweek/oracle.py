"""DuckDB SQL twins of the catalogue queries (the driver's correctness oracle).

Each function returns SQL text over the pre-registered test tables. The SQL
restates every rule independently with DuckDB's own functions (RE2 regexes,
``strftime``, window ``row_number``), so a Spark/SQL match is a real check.
"""

from __future__ import annotations

import datetime as _dt

from .specs import (ACCOUNT_MISS_ID, LINKS, LOOKUP_MISS_ID, NO_DASH_CODE, NO_DASH_MESSAGE,
                    RULES, SEVERITY_CODES, SEVERITY_OTHER, SURROGATE_DIMENSIONS, LinkSpec)
from .testbed import (AS_OF, LINK_BASE, NEW_FROM, OLD_BEFORE, ROOT_CAUSES, SEVERITY_TEXTS)


# ---- Fixed values: the timestamp layouts in SQL terms, and the two-digit-year window ----
COMPACT_SQL = "^([0-9]{4})([0-9]{2})[ \t]*([0-9]+) ([0-9]{2})([0-9]{2})[ \t]*([0-9]+)"
SLASHED_SQL = "^[ \t]*([0-9]+)/[ \t]*([0-9]+)/[ \t]*([0-9]+) [ \t]*([0-9]+):[ \t]*([0-9]+)"
WINDOW_YEARS_BACK = 80
# ------------------------------------------------------------------------------


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def d(day: _dt.date) -> str:
    return f"DATE '{day.isoformat()}'"


# ---- stand-in extract ----------------------------------------------------------

def _mod_case(k: str, n: int, pairs: list[tuple[int, str]], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {k} % {n} = {i} THEN {v}" for i, v in pairs)
    return f"CASE {whens} ELSE {default} END"


def extract_sql(batch: str = "all") -> str:
    """SELECT of extract fields (already renamed) for the stand-in batch."""
    revised = batch == "new"
    k = "o.o_orderkey"
    ks = f"CAST({k} AS VARCHAR)"
    b = q(LINK_BASE)
    sev = "CASE substr(o.o_orderpriority, 1, 1) " + " ".join(
        f"WHEN '{i + 1}' THEN {q(t)}" for i, t in enumerate(SEVERITY_TEXTS)) + " WHEN '5' THEN 'other' END"
    open_status = "'Closed'" if revised else "'Open'"
    status = (f"CASE o.o_orderstatus WHEN 'F' THEN (CASE WHEN {k} % 2 = 0 THEN 'CLOSED' ELSE 'Closed' END) "
              f"WHEN 'O' THEN {open_status} WHEN 'P' THEN 'Pending' END")
    compact = "strftime(o.o_orderdate, '%Y%m%d %H%M%S')"
    slashed = "strftime(o.o_orderdate, '%-m/%-d/%y %-H:%M')"
    date_open = (f"CASE WHEN {k} % 3 = 0 THEN {compact} || '.000' WHEN {k} % 3 = 1 THEN {slashed} "
                 f"WHEN {k} % 17 = 0 THEN 'n/a' ELSE {compact} END")
    date_close = ("CASE WHEN o.o_orderstatus = 'F' THEN "
                  "strftime(o.o_orderdate + INTERVAL 3 DAY, '%-m/%-d/%y %-H:%M') END")
    account = "c.c_name || ' Ltd'" if revised else "c.c_name"
    account_id = (f"CASE WHEN {k} % 211 = 0 THEN '' WHEN {k} % 223 = 0 THEN 'CUST- ' || CAST(o.o_custkey AS VARCHAR) "
                  "ELSE 'CUST-' || CAST(o.o_custkey AS VARCHAR) END")
    am, sm = (6, 9) if revised else (5, 7)
    ambari = f"CASE WHEN {k} % 4 <> 0 THEN '2.' || CAST({k} % {am} AS VARCHAR) END"
    stack = f"'2.6.' || CAST({k} % {sm} AS VARCHAR)"
    comp = "c.c_mktsegment"
    h_bug = _mod_case(k, 5, [(0, f"{b} || 'bug-' || {ks} || ';'"), (1, "'nolink'"),
                             (2, f"{b} || 'BUG-x' || {ks}")])
    a_bug = _mod_case(k, 6, [(0, f"{b} || {comp} || '-' || {ks}"), (1, f"{b} || 'OTHER-' || {ks}"),
                             (2, f"{b} || {ks}")])
    hotfix = _mod_case(k, 7, [(0, f"{b} || 'HOTFIX-' || {ks} || '/'"), (1, f"{b} || 'HF-' || {ks}")])
    ear = _mod_case(k, 11, [(0, f"{b} || 'EAR-' || {ks}"), (1, "'a-b/c'")])
    rmp = _mod_case(k, 9, [(0, f"{b} || 'RMP-' || {ks}"), (1, "'x-1'")])
    rootcause = _mod_case(k, 8, [(i, q(rc)) for i, rc in enumerate(ROOT_CAUSES)])
    env = f"CASE WHEN {k} % 13 <> 0 THEN 'ENV-' || CAST({k} % 5 AS VARCHAR) END"
    resolution = (f"CASE WHEN o.o_orderstatus = 'F' THEN CAST({k} % 10 AS VARCHAR) || ' days ' || "
                  f"CAST({k} % 24 AS VARCHAR) || ' hours' || CAST({k} % 60 AS VARCHAR) || ' mn' END")
    where = ""
    if batch == "old":
        where = f"WHERE o.o_orderdate < {d(OLD_BEFORE)}"
    elif batch == "new":
        where = f"WHERE o.o_orderdate >= {d(NEW_FROM)}"
    return f"""SELECT {sev} AS severity, CAST({k} AS INTEGER) AS caseNum, {status} AS status,
  {date_open} AS dateOpen, {date_close} AS dateClose, {account} AS account,
  {account_id} AS accountID, {ambari} AS ambariVersion, {stack} AS stackVersion,
  {comp} AS component, {h_bug} AS hBug, {a_bug} AS aBug, {hotfix} AS hotfix, {ear} AS EAR,
  {rootcause} AS rootcause, {rmp} AS RMP, {env} AS Env, {resolution} AS ResolutionTime
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey {where}"""


# ---- column rules -------------------------------------------------------------

def severity_sql(c: str) -> str:
    whens = " ".join(f"WHEN {c} = {q(t)} THEN {n}" for t, n in SEVERITY_CODES)
    return f"CAST(CASE {whens} ELSE {SEVERITY_OTHER} END AS INTEGER)"


def status_sql(c: str) -> str:
    return f"CAST(CASE WHEN lower({c}) = 'closed' THEN 0 ELSE 1 END AS INTEGER)"


def trailing_int_sql(c: str) -> str:
    tail = f"string_split({c}, '-')[-1]"
    return f"CASE WHEN regexp_full_match({tail}, '[+-]?[0-9]+') THEN TRY_CAST({tail} AS INTEGER) END"


def account_id_sql(c: str) -> str:
    return f"CAST(COALESCE({trailing_int_sql(c)}, {ACCOUNT_MISS_ID}) AS INTEGER)"


def _int(expr: str) -> str:
    return f"CAST(TRY_CAST({expr} AS INTEGER) AS BIGINT)"


def _checked_ts(y, mo, dd, h, mi, s) -> str:
    return (f"CASE WHEN {mo} BETWEEN 1 AND 12 AND {h} BETWEEN 0 AND 23 AND {mi} BETWEEN 0 AND 59 "
            f"AND {s} BETWEEN 0 AND 59 AND {y} BETWEEN 1 AND 9999 "
            f"THEN try(make_timestamp({y}, {mo}, {dd}, {h}, {mi}, {s})) END")


def timestamp_sql(c: str, as_of: _dt.date = AS_OF) -> str:
    """Compact layout first, then the slashed one with the two-digit-year window."""
    f1 = [_int(f"regexp_extract({c}, {q(COMPACT_SQL)}, {i})") for i in range(1, 7)]
    compact = _checked_ts(*f1)
    mo, dd, yy, h, mi = (_int(f"regexp_extract({c}, {q(SLASHED_SQL)}, {i})") for i in (1, 2, 3, 4, 5))
    yy_txt = f"regexp_extract({c}, {q(SLASHED_SQL)}, 3)"
    start = as_of.year - WINDOW_YEARS_BACK     # the window starts on the same day of that year
    base, start_key = start // 100 * 100, (start * 10000 + as_of.month * 100 + as_of.day) * 1_000_000
    y_low = f"({base} + {yy})"
    key = (f"({y_low} * 10000000000 + {mo} * 100000000 + {dd} * 1000000 + {h} * 10000 + {mi} * 100)")
    y2 = (f"(CASE WHEN length({yy_txt}) = 2 THEN (CASE WHEN {key} < {start_key} THEN {y_low} + 100 "
          f"ELSE {y_low} END) ELSE {yy} END)")
    slashed = _checked_ts(y2, mo, dd, h, mi, "0")
    return f"COALESCE({compact}, {slashed})"


def resolution_sql(c: str) -> str:
    p1, p2, p3 = f"strpos({c}, 'days')", f"strpos({c}, 'hours')", f"strpos({c}, 'mn')"
    s1, s2 = f"({p1} + 4)", f"({p2} + 5)"
    n1 = f"TRY_CAST(substr({c}, 1, {p1} - 1) AS BIGINT)"
    n2 = f"TRY_CAST(substr({c}, {s1}, {p2} - {s1}) AS BIGINT)"
    n3 = f"TRY_CAST(substr({c}, {s2}, {p3} - {s2}) AS BIGINT)"
    return (f"CASE WHEN {p1} > 0 AND {p2} >= {s1} AND {p3} >= {s2} "
            f"THEN TRY_CAST({n1} * 1440 + {n2} * 60 + {n3} AS INTEGER) END")


def week_cols_sql(ts: str, as_of: _dt.date = AS_OF) -> tuple[str, str]:
    day = f"COALESCE(CAST({ts} AS DATE), {d(as_of)})"
    fri = f"({day} + CAST(5 - dayofweek({day}) AS INTEGER))"
    return (f"CAST(year({fri} + 1) AS INTEGER)", f"strftime({fri}, '%m-%d')")


def tail_sql(c: str) -> str:
    raw = f"regexp_extract({c}, '([^/]*-[^-]*)$', 1)"
    trimmed = f"regexp_replace({raw}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    stripped = f"regexp_replace({trimmed}, '/?;?$', '')"
    return f"CASE WHEN strpos({c}, '-') > 0 THEN upper({stripped}) END"


def tail_backtrack_sql(c: str, n: int) -> str:
    after = f"string_split({c}, '-')[-1]"
    dash0 = f"(length({c}) - length({after}) - 1)"
    raw = f"substr({c}, {dash0} - {n} + 1)"
    trimmed = f"regexp_replace({raw}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
    stripped = f"regexp_replace({trimmed}, '/?;?$', '')"
    return f"CASE WHEN strpos({c}, '-') > 0 AND {dash0} >= {n} THEN upper({stripped}) END"


def _full(spec: LinkSpec) -> str:
    return q("^" + spec.pattern + "$")


def render_sql(template: str, **values: str) -> str:
    import re
    parts, pos = [], 0
    for m in re.finditer(r"\{(\w+)\}", template):
        if m.start() > pos:
            parts.append(q(template[pos:m.start()]))
        parts.append(f"CAST({values[m.group(1)]} AS VARCHAR)")
        pos = m.end()
    if pos < len(template):
        parts.append(q(template[pos:]))
    return " || ".join(parts)


# ---- layered CTEs: extract -> tails -> coded ----------------------------------

def coded_ctes(p: str, source: str, as_of: _dt.date = AS_OF) -> str:
    """CTEs ``{p}_t`` (tails, timestamps) and ``{p}_c`` (coded rows) over ``source``."""
    tails = ", ".join(f"{tail_sql(s.column)} AS _t_{s.column}" for s in LINKS)
    t = (f"{p}_t AS (SELECT s.*, {tails}, {timestamp_sql('dateOpen', as_of)} AS _open, "
         f"{timestamp_sql('dateClose', as_of)} AS _close FROM {source} s)")
    cols = []
    for s in LINKS:
        tail = f"_t_{s.column}"
        m = f"regexp_full_match({tail}, {q(s.pattern)})"
        digits = f"regexp_extract({tail}, {_full(s)}, {s.id_group})"
        ok = f"COALESCE({m}, false)"
        if s.project_group is not None:
            proj = f"regexp_extract({tail}, {_full(s)}, {s.project_group})"
            ok = f"({ok} AND COALESCE(lower({proj}) = lower(component), false))"
        cols.append(f"CASE WHEN {ok} THEN {digits} END AS _txt_{s.column}")
        cols.append(f"COALESCE({m}, false) AS _m_{s.column}")
    year, week = week_cols_sql("_open", as_of)
    nk = []
    for s in SURROGATE_DIMENSIONS:
        key = f"COALESCE({s.column}, {q(s.null_member)})" if s.null_member else s.column
        nk.append(f"{key} AS _nk_{s.name}")
    c = (f"{p}_c AS (SELECT *, {severity_sql('severity')} AS _sev, {status_sql('status')} AS _st, "
         f"{account_id_sql('accountID')} AS _acct, {trailing_int_sql('Env')} AS _env, "
         f"{resolution_sql('ResolutionTime')} AS _res, {', '.join(cols)}, {', '.join(nk)}, "
         f"{year} AS year, {week} AS week FROM {p}_t)")
    return f"{t},\n{c}"


def coded_select(p: str) -> str:
    """Fact measures (ids of links, codes) of coded rows, named as in Spark."""
    links = ", ".join(f"TRY_CAST(_txt_{s.column} AS INTEGER) AS {s.column}" for s in LINKS)
    return (f"SELECT _sev AS severity, caseNum, _st AS status, _open AS dateOpen, _close AS dateClose, "
            f"_acct AS accountID, {links}, _env AS Env, _res AS ResolutionTime FROM {p}_c")


def rule_findings_sql(p: str) -> str:
    whens = []
    for r in RULES:
        cond = [f"_st = 0", f"lower(rootcause) IN ({', '.join(q(x.lower()) for x in r.root_causes)})"]
        if r.severity is not None:
            cond.append(f"_sev = {r.severity}")
        for name in r.missing:
            cond.append(f"_txt_{name} IS NULL")
        whens.append((" AND ".join(cond), r.code, render_sql(r.message, rootcause="rootcause")))
    code = "CASE " + " ".join(f"WHEN {c} THEN {q(k)}" for c, k, _ in whens) + " END"
    msg = "CASE " + " ".join(f"WHEN {c} THEN {m}" for c, _, m in whens) + " END"
    return (f"SELECT caseNum AS case_num, code, message FROM (SELECT caseNum, {code} AS code, "
            f"{msg} AS message FROM {p}_c) WHERE code IS NOT NULL")


def link_findings_sql(p: str) -> str:
    parts = []
    for s in LINKS:
        col, tail = s.column, f"_t_{s.column}"
        unusable = f"{col} IS NOT NULL AND strpos({col}, '-') = 0"
        parts.append(f"SELECT caseNum AS case_num, {q(NO_DASH_CODE)} AS code, "
                     f"{render_sql(NO_DASH_MESSAGE, link=col)} AS message FROM {p}_c WHERE {unusable}")
        parts.append(f"SELECT caseNum, {q(s.code + 'U')}, {render_sql(s.unusable_message, link=col)} "
                     f"FROM {p}_c WHERE {unusable}")
        parts.append(f"SELECT caseNum, {q(s.code)}, {render_sql(s.invalid_message, tail=tail)} "
                     f"FROM {p}_c WHERE strpos({col}, '-') > 0 AND NOT _m_{col}")
        if s.project_group is not None:
            proj = f"regexp_extract({tail}, {_full(s)}, {s.project_group})"
            msg = render_sql(s.mismatch_message, tail=tail, component="COALESCE(component, 'null')")
            parts.append(f"SELECT caseNum, {q(s.mismatch_code)}, {msg} FROM {p}_c "
                         f"WHERE _m_{col} AND NOT COALESCE(lower({proj}) = lower(component), false)")
    return "\nUNION ALL ".join(parts)


def members_sql(p: str) -> str:
    return "\nUNION ".join(f"SELECT {q(s.name)} AS dimension, CAST(_nk_{s.name} AS VARCHAR) AS member "
                           f"FROM {p}_c" for s in SURROGATE_DIMENSIONS)


def dense_sql(members: str) -> str:
    return (f"SELECT dimension, member, CAST(row_number() OVER (PARTITION BY dimension ORDER BY member "
            f"NULLS FIRST) AS INTEGER) AS id FROM ({members})")


def merge_sql(current: str, members: str) -> str:
    """Existing ids kept; new members numbered after the dimension's max id."""
    return f"""SELECT dimension, member, id FROM {current}
UNION ALL
SELECT n.dimension, n.member, CAST(COALESCE(b.base, 0) + row_number() OVER (PARTITION BY n.dimension
  ORDER BY n.member NULLS FIRST) AS INTEGER) AS id
FROM (SELECT * FROM ({members}) m WHERE NOT EXISTS (SELECT 1 FROM {current} c
      WHERE c.dimension = m.dimension AND c.member IS NOT DISTINCT FROM m.member)) n
LEFT JOIN (SELECT dimension, max(id) AS base FROM {current} GROUP BY dimension) b
  ON b.dimension = n.dimension"""


def facts_sql(p: str, dims: str) -> str:
    """Fact rows of coded rows ``{p}_c`` with ids from the long-form ``dims``."""
    joins, ids = [], {}
    for i, s in enumerate(SURROGATE_DIMENSIONS):
        a = f"d{i}"
        joins.append(f"LEFT JOIN {dims} {a} ON {a}.dimension = {q(s.name)} "
                     f"AND {a}.member IS NOT DISTINCT FROM c._nk_{s.name}")
        ids[s.fact_column] = f"CAST(COALESCE({a}.id, {LOOKUP_MISS_ID}) AS INTEGER)"
    links = {s.column: f"TRY_CAST(c._txt_{s.column} AS INTEGER)" for s in LINKS}
    cols = {
        "severity": "c._sev", "caseNum": "c.caseNum", "status": "c._st", "dateOpen": "c._open",
        "dateClose": "c._close", "accountID": "c._acct", **ids, **links, "Env": "c._env",
        "ResolutionTime": "c._res", "year": "c.year", "week": "c.week",
    }
    from .schemas import FACT_COLUMNS, PARTITION_COLUMNS
    sel = ", ".join(f"{cols[n]} AS {n}" for n in [*FACT_COLUMNS, *PARTITION_COLUMNS])
    return f"SELECT {sel} FROM {p}_c c " + " ".join(joins)


def accounts_sql(source: str) -> str:
    """One (id, name) per account id of an extract source; largest name."""
    return (f"SELECT {account_id_sql('accountID')} AS id, max(account) AS name FROM {source} "
            f"GROUP BY 1")


def upsert_accounts_sql(current: str, batch: str) -> str:
    return (f"SELECT id, name FROM {current} WHERE id NOT IN (SELECT id FROM {batch}) "
            f"UNION ALL SELECT id, name FROM {batch}")


# ---- per-query SQL ------------------------------------------------------------------

def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _x(p: str, batch: str) -> str:
    return f"x{p} AS ({extract_sql(batch)}),\n" + coded_ctes(p, f"x{p}")


_XA, _XO, _XN = _x("a", "all"), _x("o", "old"), _x("n", "new")
_DIMS_A = f"dims_a AS ({dense_sql(members_sql('a'))})"
_DIMS_O = f"dims_o AS ({dense_sql(members_sql('o'))})"
_DIMS_M = f"dims_m AS ({merge_sql('dims_o', members_sql('n'))})"
_F_O = f"f_o AS ({facts_sql('o', 'dims_o')})"
_F_N = f"f_n AS ({facts_sql('n', 'dims_m')})"
_FI_A = f"fi AS ({rule_findings_sql('a')}\nUNION ALL {link_findings_sql('a')})"
_ACC = "ao AS (" + accounts_sql("xo") + "),\nan AS (" + accounts_sql("xn") + ")"
_FIELDS = ["severity", "caseNum", "status", "dateOpen", "dateClose", "account", "accountID",
           "ambariVersion", "stackVersion", "component", "hBug", "aBug", "hotfix", "EAR",
           "rootcause", "RMP", "Env", "ResolutionTime"]


def _link_rows() -> str:
    parts = [f"SELECT {q(s.column)} AS source, CAST(caseNum AS BIGINT) AS id, {s.column} AS link FROM xa"
             for s in LINKS]
    parts.append("SELECT 'pages.url', CAST(page_id AS BIGINT), url FROM pages")
    return " UNION ALL ".join(parts)


def _week_rows() -> str:
    yc, wc = week_cols_sql("ts")
    return (f"SELECT 'cases' AS source, CAST(caseNum AS BIGINT) AS key, {yc} AS year, {wc} AS week "
            f"FROM (SELECT caseNum, {timestamp_sql('dateOpen')} AS ts FROM xa) "
            f"UNION ALL SELECT 'events', CAST(event_id AS BIGINT), {yc}, {wc} FROM events "
            f"UNION ALL SELECT 'lineitem', CAST(l_orderkey AS BIGINT), "
            f"{week_cols_sql('l_shipdate')[0]}, {week_cols_sql('l_shipdate')[1]} FROM lineitem")


def _side_sql() -> str:
    return ("SELECT CAST(event_id * 2 AS INTEGER) AS CaseNum, 'user-' || CAST(user_id AS VARCHAR) "
            "AS Case_Owner, event_type AS Description, value > 50.0 AS Actionable, props AS JIRA, "
            "event_type AS status FROM events")


def oracle_queries() -> dict[str, str]:
    same = "n.year = o.year AND n.week = o.week"
    fields = [("NULLIF(accountID, '') AS accountID" if f == "accountID" else f) for f in _FIELDS]
    dims_added = ("SELECT m.dimension FROM dims_m m WHERE NOT EXISTS (SELECT 1 FROM dims_o o "
                  "WHERE o.dimension = m.dimension AND o.member IS NOT DISTINCT FROM m.member)")
    changes = ("ch AS (SELECT b.id, CASE WHEN o.id IS NULL THEN 'new' ELSE 'renamed' END AS change "
               "FROM an b LEFT JOIN ao o ON b.id = o.id WHERE o.id IS NULL OR b.name IS DISTINCT FROM o.name)")
    upsert = _with(_XO, _XN, _DIMS_O, _DIMS_M, _F_O, _F_N) + (
        f"SELECT * FROM f_o o WHERE NOT EXISTS (SELECT 1 FROM f_n n WHERE {same} "
        "AND n.caseNum = o.caseNum) UNION ALL SELECT * FROM f_n")
    acc_up = f"au AS ({upsert_accounts_sql('ao', 'an')})"
    return {
        "case_extract_scan": _with(_XA) + f"SELECT {', '.join(fields)} FROM xa",
        "severity_status_codes": _with(_XA) + (
            f"SELECT caseNum, {severity_sql('severity')} AS severity, {status_sql('status')} AS status FROM xa"),
        "case_timestamps": _with(_XA) + (
            f"SELECT caseNum, {timestamp_sql('dateOpen')} AS dateOpen, "
            f"{timestamp_sql('dateClose')} AS dateClose FROM xa"),
        "account_env_ids": _with(_XA) + (
            f"SELECT caseNum, {account_id_sql('accountID')} AS accountID, {trailing_int_sql('Env')} AS Env FROM xa"),
        "link_tail": _with(_XA, f"r AS ({_link_rows()})") + (
            f"SELECT source, id, link, {tail_sql('link')} AS tail, "
            f"{tail_backtrack_sql('link', 6)} AS tail_back FROM r"),
        "reference_ids": _with(_XA) + (
            "SELECT caseNum, " + ", ".join(f"TRY_CAST(_txt_{c} AS INTEGER) AS {c}"
                                           for c in ("hBug", "hotfix", "EAR", "RMP")) + " FROM a_c"),
        "component_issue": _with(_XA) + "SELECT caseNum, component, TRY_CAST(_txt_aBug AS INTEGER) AS aBug FROM a_c",
        "resolution_minutes": _with(_XA) + (
            f"SELECT caseNum, {resolution_sql('ResolutionTime')} AS ResolutionTime FROM xa"),
        "week_partition": _with(_XA) + _week_rows(),
        "dim_new_members": _with(_XO, _XN, f"mo AS ({members_sql('o')})", f"mn AS ({members_sql('n')})") + (
            "SELECT dimension, member FROM mn m WHERE NOT EXISTS (SELECT 1 FROM mo c WHERE "
            "c.dimension = m.dimension AND c.member IS NOT DISTINCT FROM m.member) "
            f"UNION ALL SELECT 'account', CAST(id AS VARCHAR) FROM (SELECT DISTINCT "
            f"{account_id_sql('accountID')} AS id FROM xn) WHERE id NOT IN "
            f"(SELECT {account_id_sql('accountID')} FROM xo)"),
        "dim_dense_ids": dense_sql("SELECT DISTINCT 'p_brand' AS dimension, p_brand AS member FROM part "
                                   "UNION SELECT DISTINCT 'p_name', p_name FROM part"),
        "dim_merge_ids": _with(_XO, _XN, _DIMS_O) + merge_sql("dims_o", members_sql("n")),
        "dim_account_upsert": _with(_XO, _XN, _ACC) + upsert_accounts_sql("ao", "an"),
        "dim_growth": _with(_XO, _XN, _DIMS_O, _DIMS_M, _ACC, acc_up, changes) + (
            "SELECT dimension, CAST(sum(o) AS BIGINT) AS old_size, CAST(sum(n) AS BIGINT) AS new_size, "
            "CAST(sum(a) AS BIGINT) AS added, CAST(sum(r) AS BIGINT) AS renamed FROM ("
            "SELECT dimension, 1 AS o, 0 AS n, 0 AS a, 0 AS r FROM dims_o "
            "UNION ALL SELECT dimension, 0, 1, 0, 0 FROM dims_m "
            f"UNION ALL SELECT dimension, 0, 0, 1, 0 FROM ({dims_added}) "
            "UNION ALL SELECT 'account', 1, 0, 0, 0 FROM ao "
            "UNION ALL SELECT 'account', 0, 1, 0, 0 FROM au "
            "UNION ALL SELECT 'account', 0, 0, 1, 0 FROM ch WHERE change = 'new' "
            "UNION ALL SELECT 'account', 0, 0, 0, 1 FROM ch WHERE change = 'renamed') GROUP BY dimension"),
        "dim_lookup_default": _with(_XO, _XN, _DIMS_O, f"f AS ({facts_sql('n', 'dims_o')})") + (
            "SELECT caseNum, ambariVersionID, stackVersionID, componentID, rootcauseID FROM f"),
        "dim_rewrite_roundtrip": _with(_XO, _XN, _DIMS_O, _DIMS_M, _ACC, acc_up) + (
            "SELECT dimension, member, id FROM dims_m UNION ALL "
            "SELECT 'account', name, id FROM au"),
        "fact_normalised": _with(_XA, _DIMS_A) + facts_sql("a", "dims_a"),
        "fact_append_roundtrip": _with(_XO, _XN, _DIMS_O, _DIMS_M, _F_O, _F_N) + (
            "SELECT * FROM f_o UNION ALL SELECT * FROM f_n"),
        "fact_overwrite_partitions": _with(_XO, _XN, _DIMS_O, _DIMS_M, _F_O, _F_N) + (
            f"SELECT * FROM f_o o WHERE NOT EXISTS (SELECT 1 FROM f_n n WHERE {same}) "
            "UNION ALL SELECT * FROM f_n"),
        "touched_partitions": _with(_XN) + "SELECT DISTINCT year, week FROM n_c",
        "fact_partition_scan": _with(_XO, _XN, _DIMS_O, _F_O) + (
            f"SELECT * FROM f_o o WHERE EXISTS (SELECT 1 FROM n_c n WHERE {same})"),
        "fact_upsert_partitions": upsert,
        "findings_rules": _with(_XA) + rule_findings_sql("a"),
        "findings_links": _with(_XA) + link_findings_sql("a"),
        "findings_report": _with(_XA, _FI_A) + (
            "SELECT case_num, CAST(count(DISTINCT message) AS INTEGER) AS n_messages, "
            "string_agg(DISTINCT message, ' | ' ORDER BY message) AS messages FROM fi GROUP BY case_num"),
        "findings_case_count": _with(_XA, _FI_A) + (
            "SELECT count(DISTINCT case_num) AS cases, count(*) AS findings FROM fi"),
        "batch_profile": _with(_XO, _XN, _DIMS_O, _ACC) + (
            "SELECT kind, dimension, count(*) AS n FROM ("
            f"SELECT 'batch' AS kind, dimension FROM ({members_sql('n')}) "
            "UNION ALL SELECT 'batch', 'account' FROM an "
            "UNION ALL SELECT 'table', dimension FROM dims_o "
            "UNION ALL SELECT 'table', 'account' FROM ao) GROUP BY kind, dimension"),
        "audit_duplicate_cases": ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                                  "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
        "audit_duplicate_facts": _with(_XO, _XN, _DIMS_O, _DIMS_M, _F_O, _F_N) + (
            "SELECT caseNum, count(*) AS n FROM (SELECT caseNum FROM f_o UNION ALL SELECT caseNum FROM f_n) "
            "GROUP BY caseNum HAVING count(*) > 1"),
        "audit_orphan_cases": _with(_XA, f"side AS ({_side_sql()})") + (
            "SELECT CaseNum, Description FROM side s WHERE NOT EXISTS "
            "(SELECT 1 FROM xa WHERE xa.caseNum = s.CaseNum)"),
        "staging_account": "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name FROM customer",
        "staging_product": "SELECT p_name AS name, CAST(min(p_partkey) AS INTEGER) AS id FROM part GROUP BY p_name",
        "automation_bucketed": _side_sql(),
        "smartsense_bucketed": (
            "SELECT CAST(event_id * 2 AS INTEGER) AS CaseNum, event_type AS Existing_Rule, "
            "props AS Suggestion, 'user-' || CAST(user_id AS VARCHAR) AS Suggestion_Owner, "
            "CAST(NULL AS VARCHAR) AS Reviewed_By, 'EV-' || CAST(event_id AS VARCHAR) AS JIRA, "
            "event_type AS status, CAST(floor(hour(ts) / 6) + 1 AS INTEGER) AS Priority FROM events"),
        # the earlier file loaded, then the later one as an update
        "process_once": upsert,
        "fact_after_bootstrap": (
            "SELECT CAST(o_orderkey AS INTEGER) AS caseNum, CAST(s.id AS INTEGER) AS componentID FROM orders "
            "JOIN customer ON o_custkey = c_custkey JOIN (SELECT c_mktsegment AS name, min(c_custkey) AS id "
            f"FROM customer GROUP BY 1) s ON s.name = c_mktsegment WHERE o_orderdate >= {d(NEW_FROM)}"),
        "malformed_cases": (
            "WITH sent AS (SELECT CAST(o_orderkey AS VARCHAR) AS case_number, o_orderstatus = 'P' AS pending, "
            "substr(o_orderpriority, 1, 1) IN ('4', '5') AS misfit FROM orders JOIN customer ON o_custkey = c_custkey "
            f"WHERE o_orderdate >= {d(NEW_FROM)}) "
            "SELECT CASE WHEN pending THEN 'refused: case number' WHEN misfit THEN 'refused: fields' ELSE 'fact' END AS kind, "
            "case_number, CAST(CASE WHEN pending OR misfit THEN 2 ELSE 1 END AS BIGINT) AS n FROM sent "
            "UNION ALL SELECT 'finding', case_number, CAST(2 AS BIGINT) FROM sent WHERE misfit AND NOT pending"),
        "process_ledger": _with(_XO, _XN) + " UNION ALL ".join(
            f"SELECT CAST(0 AS BIGINT) AS batch_id, (SELECT count(*) FROM x{p}) AS rows, 8 AS run_date_length, "
            f"(SELECT count(DISTINCT case_num) FROM ({rule_findings_sql(p)} UNION ALL {link_findings_sql(p)})) AS cases"
            for p in ("o", "n")),
    }
