"""The same questions as plain SQL over the test tables."""

from __future__ import annotations

E = """
E AS (
  SELECT 'EV-' || event_id AS event_id,
         'F' || (user_id % 3) AS factory_id, 'L' || (user_id % 7) AS line_id,
         event_type AS maintenance_type,
         CASE WHEN event_type = 'error' THEN 'Unplanned Breakdown'
              ELSE 'Planned Maintenance' END AS reason,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(ts + to_minutes(3 * k), '%Y-%m-%d %H:%M:%S') AS end_time,
         CAST(3 * k AS INTEGER) AS downtime_min,
         CAST(user_id AS VARCHAR) AS technician_id,
         CASE event_id % 4 WHEN 1 THEN '' WHEN 2 THEN 'PART-' || k
              WHEN 3 THEN 'PART-' || k || ' , PART-' || (k + 1) END AS parts_used,
         CASE WHEN event_id % 20 <> 0 THEN round(value * 30, 2) END AS cost_eur,
         ['Restored', 'Temporarily Fixed', 'Root Cause Identified', 'Deferred'][event_id % 4 + 1]
           AS outcome,
         CAST(CAST(ts AS DATE) + CAST(k % 14 + 1 AS INTEGER) AS DATE) AS next_due_date
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events))"""

L = """
L AS (
  SELECT l_orderkey || '-' || l_linenumber AS event_id,
         l_returnflag AS factory_id, l_linestatus AS line_id,
         ['Preventive', 'Corrective', 'Calibration', 'Inspection'][l_linenumber % 4 + 1]
           AS maintenance_type,
         CASE WHEN l_returnflag = 'R' THEN 'Unplanned Breakdown'
              ELSE 'Planned Maintenance' END AS reason,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS start_time,
         strftime(l_shipdate + to_minutes(q), '%Y-%m-%d %H:%M:%S') AS end_time,
         q AS downtime_min,
         CAST(l_suppkey AS VARCHAR) AS technician_id,
         CASE l_orderkey % 4 WHEN 1 THEN '' WHEN 2 THEN 'PART-' || q
              WHEN 3 THEN 'PART-' || q || ' , PART-' || (q + 1) END AS parts_used,
         CASE WHEN l_orderkey % 20 <> 0
              THEN CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 20 AS DOUBLE) / 100 END
           AS cost_eur,
         ['Restored', 'Temporarily Fixed', 'Root Cause Identified', 'Deferred'][l_orderkey % 4 + 1]
           AS outcome,
         CAST(CAST(l_shipdate AS DATE) + (q % 14 + 1) AS DATE) AS next_due_date
  FROM (SELECT *, CAST(l_quantity AS INTEGER) AS q FROM lineitem))"""

R = """
R AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS operator_id,
         CASE WHEN s_nationkey % 7 <> 0
              THEN ['Junior', 'Intermediate', 'Senior', 'Expert'][s_nationkey % 4 + 1] END
           AS skill_level,
         CASE WHEN s_suppkey % 11 <> 0 THEN CAST(s_suppkey % 50 + 50 AS DOUBLE) END
           AS reliability_score
  FROM supplier)"""

P = """
P AS (
  SELECT 1 - l_discount AS availability, 1 - l_tax AS performance, 1.01::DOUBLE - l_tax AS quality,
         l_quantity AS produced_qty, 40.0::DOUBLE AS planned_qty
  FROM lineitem)"""

D = (
    E
    + """,
D AS (
  SELECT CASE n WHEN 4 THEN NULL WHEN 5 THEN 'EV-COPY' ELSE event_id END AS event_id,
         factory_id, line_id, maintenance_type,
         CASE n WHEN 6 THEN NULL WHEN 8 THEN '  ' || reason || ' ' ELSE reason END AS reason,
         CASE n WHEN 7 THEN '03/11/2025 10:11' ELSE start_time END AS start_time,
         CASE n WHEN 3 THEN '2000-01-01 00:00:00' ELSE end_time END AS end_time,
         CAST(CASE n WHEN 2 THEN -downtime_min - 1 WHEN 9 THEN NULL ELSE downtime_min END
              AS INTEGER) AS downtime_min,
         technician_id, parts_used,
         CASE n WHEN 1 THEN -cost_eur - 1 ELSE cost_eur END AS cost_eur,
         outcome, next_due_date
  FROM (SELECT *, CAST(substr(event_id, 4) AS BIGINT) % 50 AS n FROM E))"""
)


def utc(c: str) -> str:
    return f"(try_strptime({c}, '%Y-%m-%d %H:%M:%S') AT TIME ZONE 'Europe/Paris' AT TIME ZONE 'UTC')"


PARTS = "nullif([trim(x) FOR x IN string_split(parts_used, ',') IF trim(x) <> ''], [])"
CENTS = "CAST(round(cost_eur * 100) AS BIGINT)"
# Amounts as they are written, summed as decimals and read as the nearest double.
EXACT = "CAST(CAST(cost_eur AS VARCHAR) AS DECIMAL(30,10))"


def exact_total(rows: str = "") -> str:
    return f"CAST(CAST(sum({EXACT}) {rows} AS VARCHAR) AS DOUBLE)"




def clean(source: str) -> str:
    """Cleaned events as C, from the CTE named ``source``."""
    return f"""
C AS (
  SELECT * REPLACE (trim(event_id) AS event_id, trim(reason) AS reason),
         {utc('start_time')} AS start_time_utc, {utc('end_time')} AS end_time_utc,
         {PARTS} AS parts_list, CAST(coalesce(len({PARTS}), 0) AS INTEGER) AS parts_count,
         trim(reason) = 'Unplanned Breakdown' AS is_unplanned,
         CASE WHEN downtime_min = 0 THEN 'monitoring' ELSE 'downtime' END AS downtime_category,
         concat_ws('|', CASE WHEN cost_eur IS NULL THEN 'missing_cost' END,
                   CASE WHEN {PARTS} IS NULL THEN 'missing_parts' END) AS data_quality_flags
  FROM {source})"""


ENRICHED = """
N AS (
  SELECT C.*, operator_id IS NOT NULL AS technician_found,
         coalesce(skill_level, 'Unknown') AS operator_skill_level,
         coalesce(reliability_score, 50.0) AS operator_reliability
  FROM C LEFT JOIN R ON technician_id = operator_id)"""

UNIT_COST = f"""CASE WHEN downtime_min > 0
    THEN CAST((2 * {CENTS} + downtime_min) // (2 * downtime_min) AS DOUBLE) / 100
    ELSE 0.0::DOUBLE END"""

SEVERITY = """CASE WHEN cost_eur > 2500 OR downtime_min > 120 THEN 'High'
    WHEN cost_eur > 1500 OR downtime_min > 60 THEN 'Medium' ELSE 'Low' END"""

DAYS = "CAST(date_diff('day', CAST(start_time_utc AS DATE), next_due_date) AS INTEGER)"

FACT = f"""
F AS (
  SELECT event_id AS maint_event_id, factory_id, line_id,
         start_time_utc AS start_timestamp, end_time_utc AS end_timestamp,
         strftime(start_time_utc, '%Y-%m-%d') AS event_date,
         strftime(start_time_utc, '%Y-%m') AS event_year_month,
         maintenance_type, reason, outcome, is_unplanned AS is_unplanned_breakdown,
         downtime_category, downtime_min, cost_eur,
         {UNIT_COST} AS cost_per_downtime_min, {SEVERITY} AS severity_level,
         technician_id, operator_skill_level, operator_reliability,
         parts_count, parts_list, next_due_date, {DAYS} AS days_to_next_due,
         data_quality_flags, technician_found AS technician_in_roster
  FROM N)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def fact(source_cte: str, name: str) -> str:
    return with_(source_cte, R, clean(name), ENRICHED, FACT)


E_FACT, L_FACT = fact(E, "E"), fact(L, "L")


def half_up(num: str, den: str, scale: int) -> str:
    """Non-negative integer ratio, rounded half-up, as DOUBLE; NULL for a zero denominator."""
    k = 10**scale
    return (
        f"CAST((2 * {k} * ({num}) + ({den})) // (2 * nullif({den}, 0)) AS DOUBLE) / {k}"
    )


def summary(keys: str) -> str:
    pct = half_up("100 * count(*) FILTER (WHERE is_unplanned_breakdown)", "count(*)", 2)
    return f"""
  SELECT {keys}, count(*) AS event_count,
         CAST(sum(downtime_min) AS BIGINT) AS total_downtime_min,
         avg(downtime_min) AS avg_downtime_min,
         {exact_total()} AS total_cost_eur,
         {exact_total()} / CAST(count(cost_eur) AS DOUBLE) AS avg_cost_eur,
         count(*) FILTER (WHERE is_unplanned_breakdown) AS unplanned_count,
         {pct} AS unplanned_pct
  FROM F GROUP BY {keys}"""


DAY_KEYS = "factory_id, line_id, maintenance_type, event_date"
DUE = "CAST(next_due_date AS VARCHAR) AS next_due_date"
FLAT_FACT = f"SELECT * REPLACE (array_to_string(parts_list, ',') AS parts_list, {DUE}) FROM F"


def kpi_cost(t: str) -> str:
    return f"""
  SELECT {exact_total()} AS total_maintenance_cost,
         count(*) AS event_count,
         {half_up(f"sum({CENTS})", "100 * count(*)", 2)} AS avg_cost_per_event,
         min(cost_eur) AS min_cost, max(cost_eur) AS max_cost
  FROM {t} WHERE cost_eur >= 0"""


def kpi_unplanned(t: str) -> str:
    hit = "FILTER (WHERE reason = 'Unplanned Breakdown')"
    return f"""
  SELECT count(*) {hit} AS unplanned_breakdowns,
         {half_up(f"100 * count(*) {hit}", "count(*)", 2)} AS pct_of_total_events,
         CAST(sum(downtime_min) {hit} AS BIGINT) AS total_unplanned_downtime_min,
         {half_up(f"sum(downtime_min) {hit}", f"count(downtime_min) {hit}", 2)}
           AS avg_unplanned_downtime_min,
         {exact_total(hit)} AS total_unplanned_cost_eur,
         {half_up(f"sum({CENTS}) {hit}", f"100 * count(cost_eur) {hit}", 2)}
           AS avg_unplanned_cost_eur
  FROM {t}"""


KPI_DOWNTIME = f"""
  SELECT CAST(sum(downtime_min) AS BIGINT) AS total_downtime_minutes,
         CAST(sum(CASE WHEN downtime_min > 0 THEN downtime_min ELSE 0 END) AS BIGINT)
           AS total_productive_downtime_min,
         count(*) AS total_events,
         count(*) FILTER (WHERE downtime_min > 0) AS events_with_downtime,
         count(*) FILTER (WHERE downtime_min = 0) AS monitoring_only_events,
         {half_up("sum(downtime_min)", "60", 2)} AS total_hours
  FROM D WHERE downtime_min IS NOT NULL"""

KPI_COMPOSITION = """
  SELECT count(*) AS total_events, count(DISTINCT event_id) AS unique_events,
         count(DISTINCT factory_id) AS factory_count, count(DISTINCT line_id) AS line_count,
         count(DISTINCT maintenance_type) AS maintenance_type_count
  FROM D"""

KPI_DISTRIBUTION = f"""
  SELECT count(*) AS total_events,
         count(*) FILTER (WHERE downtime_min > 0) AS events_with_downtime,
         {half_up("sum(downtime_min)", "count(*)", 2)} AS mean_downtime_min,
         {half_up("sum(downtime_min) FILTER (WHERE downtime_min > 0)",
                  "count(*) FILTER (WHERE downtime_min > 0)", 2)}
           AS mean_downtime_excluding_zeros,
         min(downtime_min) AS min_downtime_min, max(downtime_min) AS max_downtime_min,
         round(stddev_pop(downtime_min), 2) AS stddev_downtime_min
  FROM D WHERE downtime_min IS NOT NULL"""


KPI_EFFICIENCY = f"""
  SELECT count(*) AS costed_events,
         {half_up(f"sum({CENTS})", "100 * sum(downtime_min)", 2)} AS cost_per_downtime_min,
         min({UNIT_COST}) AS min_cost_per_downtime_min,
         max({UNIT_COST}) AS max_cost_per_downtime_min
  FROM L WHERE downtime_min > 0 AND cost_eur IS NOT NULL"""


def rule_report(name: str, cte: str, t: str, rules: list[tuple[str, str, str]]) -> str:
    """``rules``: (name, severity, scalar SQL over ``t`` giving the violations)."""
    rows = " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{severity}' AS severity, CAST(({sql}) AS BIGINT) AS violations"
        for rule, severity, sql in rules
    )
    return f"""{with_(cte)}, V AS ({rows})
  SELECT '{name}' AS "table", rule, severity, violations,
         (SELECT count(*) FROM {t}) AS total_rows, violations = 0 AS passed
  FROM V"""


def bad_rows(t: str, predicate: str) -> str:
    return f"SELECT count(*) FROM {t} WHERE {predicate}"


def outside(t: str, value: str, low, high) -> str:
    return f"SELECT CASE WHEN {value} BETWEEN {low} AND {high} THEN 0 ELSE 1 END FROM {t}"


def repeated(t: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT {key} FROM {t} GROUP BY {key} HAVING count(*) > 1)"
    )


def nulls(t: str, *columns: str) -> list[tuple[str, str, str]]:
    return [(f"null_{c}", "error", bad_rows(t, f"{c} IS NULL")) for c in columns]


EVENT_RULES = [
    ("row_count", "fatal", outside("D", "count(*)", 90, 100)),
    ("duplicate_event_id", "error", repeated("D", "event_id")),
    ("end_before_start", "error", bad_rows("D", f"{utc('end_time')} < {utc('start_time')}")),
    ("negative_cost", "warn", bad_rows("D", "cost_eur < 0")),
    ("cost_not_finite", "error", bad_rows("D", "isnan(cost_eur) OR isinf(cost_eur)")),
    ("negative_downtime", "warn", bad_rows("D", "downtime_min < 0")),
    *nulls("D", "event_id", "start_time", "end_time", "downtime_min"),
]
PRODUCTION_RULES = [
    ("row_count", "fatal", outside("P", "count(*)", 1000, 10**12)),
    *[
        (f"{c}_out_of_range", "error", bad_rows("P", f"NOT ({c} BETWEEN 0 AND 1)"))
        for c in ("availability", "performance", "quality")
    ],
    ("produced_over_planned", "warn", bad_rows("P", "produced_qty > planned_qty")),
]
ROSTER_RULES = [
    ("row_count", "fatal", outside("R", "count(*)", 1, 10**9)),
    ("duplicate_operator_id", "error", repeated("R", "operator_id")),
    (
        "reliability_out_of_range",
        "warn",
        bad_rows("R", "reliability_score < 0 OR reliability_score > 100"),
    ),
]
REPORTS = {
    "quality_events": rule_report("events", D, "D", EVENT_RULES),
    "quality_production": rule_report("production", P, "P", PRODUCTION_RULES),
    "quality_roster": rule_report("roster", R, "R", ROSTER_RULES),
}


def report_of_fact(rules: list[tuple[str, str, str]]) -> str:
    sql = rule_report("fact", "", "F", rules)
    return sql.replace(with_(""), E_FACT, 1)


def broken_rules(t: str) -> str:
    return f"""
  SELECT event_id, start_time, technician_id, failed_rules FROM (
    SELECT event_id, start_time, technician_id, concat_ws('|',
             CASE WHEN end_time < start_time THEN 'end_before_start' END,
             CASE WHEN cost_eur < 0 THEN 'negative_cost' END,
             CASE WHEN downtime_min < 0 THEN 'negative_downtime' END,
             CASE WHEN event_id IS NULL THEN 'null_event_id' END,
             CASE WHEN start_time IS NULL THEN 'null_start_time' END,
             CASE WHEN end_time IS NULL THEN 'null_end_time' END,
             CASE WHEN downtime_min IS NULL THEN 'null_downtime_min' END,
             CASE WHEN count(*) OVER (PARTITION BY event_id) > 1 THEN 'duplicate_event_id' END)
             AS failed_rules
    FROM {t}) WHERE failed_rules <> ''"""


ENRICHED_COLUMNS = (
    "event_id, technician_id, technician_found, operator_skill_level, operator_reliability"
)
ENRICH = f"{with_(E, R, clean('E'), ENRICHED)} SELECT {ENRICHED_COLUMNS} FROM N"

MINUTES = "CAST(downtime_min AS DOUBLE) AS downtime_min"

VARIATION = f"""{with_(E)}
  SELECT round(avg(downtime_min), 4) AS mean_downtime_min,
         round(stddev_pop(downtime_min), 4) AS stddev_downtime_min,
         round(stddev_pop(downtime_min) / avg(downtime_min) * 100, 2) AS variation_pct FROM E"""


def late(which: str) -> str:
    """E with times 31 days later where the condition on the id's number holds."""
    times = ", ".join(
        f"CASE WHEN {which} THEN strftime(strptime({c}, '%Y-%m-%d %H:%M:%S') + INTERVAL 31 DAY, '%Y-%m-%d %H:%M:%S')"
        f" ELSE {c} END AS {c}"
        for c in ("start_time", "end_time")
    )
    return f"""{E}, M AS (
  SELECT * EXCLUDE (n) REPLACE ({times}) FROM (SELECT *, CAST(substr(event_id, 4) AS BIGINT) AS n FROM E))"""


GAPS = f"""{E}, M AS (
  SELECT * EXCLUDE (n) REPLACE (reason || ' ' || event_id AS reason,
         CASE WHEN n % 5 = 0 THEN 'unknown' ELSE start_time END AS start_time,
         CASE WHEN n % 4 = 0 THEN NULL ELSE event_id END AS event_id)
  FROM (SELECT *, CAST(substr(event_id, 4) AS BIGINT) AS n FROM E))"""

ORACLE: dict[str, str] = {
    "maintenance_summary": E_FACT + summary(DAY_KEYS),
    "fact_maintenance": f"{E_FACT} {FLAT_FACT}",
    "fact_lineitem": f"{L_FACT} {FLAT_FACT}",
    "summary_lineitem": L_FACT + summary(DAY_KEYS),
    "summary_by_factory": E_FACT + summary("factory_id, event_year_month"),
    "local_to_utc_events": f"""{with_(E, clean('E'))}
  SELECT event_id, start_time_utc, end_time_utc,
         strftime(start_time_utc, '%Y-%m-%d') AS event_date,
         strftime(start_time_utc, '%Y-%m') AS event_year_month FROM C""",
    "local_to_utc_seasons": """
  SELECT l_shipdate AT TIME ZONE 'Europe/Paris' AT TIME ZONE 'UTC' AS ship_utc, count(*) AS count
  FROM lineitem GROUP BY 1""",
    "local_to_utc_defects": f"""{with_(D, clean('D'))}
  SELECT start_time, start_time_utc, end_time, end_time_utc FROM C""",
    "parts_lists": f"""{with_(E, clean('E'))}
  SELECT event_id, array_to_string(parts_list, ';') AS parts, parts_count FROM C""",
    "parts_lists_filled": f"""{with_(E, clean('E'))}
  SELECT event_id, coalesce(array_to_string(parts_list, ';'), '') AS parts, parts_count FROM C""",
    "parts_usage": f"""{with_(E, clean('E'))}
  SELECT part, count(*) AS count FROM (SELECT unnest(parts_list) AS part FROM C) GROUP BY part""",
    "classify_events": f"""{with_(D, clean('D'))}
  SELECT event_id, reason, is_unplanned, {MINUTES}, downtime_category FROM C""",
    "quality_flags": f"""{with_(E, clean('E'))}
  SELECT event_id, cost_eur, data_quality_flags FROM C""",
    "cost_quality_labels": f"""{with_(E)}
  SELECT CASE WHEN c IS NULL THEN 'pending_cost' WHEN c = 0 THEN 'free_or_in_house'
              ELSE 'confirmed' END AS cost_data_quality, count(*) AS count
  FROM (SELECT CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 7 = 3 THEN 0 ELSE cost_eur END AS c
        FROM E) GROUP BY 1""",
    "cost_quality": f"""{with_(E)}
  SELECT CASE WHEN cost_eur IS NULL THEN 'pending_cost' WHEN cost_eur = 0 THEN 'free_or_in_house'
              ELSE 'confirmed' END AS cost_data_quality, count(*) AS count
  FROM E GROUP BY 1""",
    "trim_strings": f"""{with_(D)}
  SELECT * REPLACE (trim(reason) AS reason, trim(parts_used) AS parts_used, {DUE}, {MINUTES}) FROM D""",
    "clamp_downtime": f"""{with_(D)}
  SELECT event_id, start_time, {MINUTES},
         CAST(CASE WHEN downtime_min < 0 THEN 0 ELSE downtime_min END AS DOUBLE) AS clamped FROM D""",
    "enrich_operators": ENRICH,
    "enrich_operators_spread": f"""{with_(E)}, H AS (
  SELECT * REPLACE (CASE WHEN n % 3 = 0 THEN '1' WHEN n % 10 = 1 THEN NULL ELSE technician_id END
                      AS technician_id)
  FROM (SELECT *, CAST(substr(event_id, 4) AS BIGINT) AS n FROM E)),{R},{clean('H')},{ENRICHED}
  SELECT {ENRICHED_COLUMNS} FROM N""",
    "enrich_operators_by_suffix": f"""{with_(E, R, clean('E'), ENRICHED)}
  SELECT {ENRICHED_COLUMNS.replace('technician_id', "'TECH-00' || technician_id AS technician_id", 1)}
  FROM N""",
    "roster_one_per_key": """
  SELECT operator_id, skill_level, reliability_score FROM (
    SELECT *, row_number() OVER (PARTITION BY operator_id
                                 ORDER BY reliability_score, skill_level) AS n
    FROM (SELECT CAST(l_suppkey AS VARCHAR) AS operator_id, l_returnflag AS skill_level,
                 l_quantity + l_tax AS reliability_score FROM lineitem))
  WHERE n = 1""",
    "match_rate": f"""{with_(E, R, clean('E'), ENRICHED)}
  SELECT count(*) AS total_events, count(*) FILTER (WHERE technician_found) AS matched,
         count(*) FILTER (WHERE NOT technician_found) AS unmatched,
         {half_up("100 * count(*) FILTER (WHERE technician_found)", "count(*)", 2)} AS match_pct
  FROM N""",
    "unmatched_technicians": f"""{with_(E, R)}
  SELECT technician_id, count(*) AS event_count FROM E
  WHERE NOT EXISTS (SELECT 1 FROM R WHERE operator_id = technician_id) GROUP BY 1""",
    "cost_per_downtime": f"""{with_(L)}
  SELECT event_id, cost_eur, downtime_min, {UNIT_COST} AS cost_per_downtime_min FROM L""",
    "severity_mix": f"""{with_(L)}
  SELECT {SEVERITY} AS severity_level, maintenance_type, count(*) AS count FROM L GROUP BY 1, 2""",
    "days_to_due": f"""{with_(E, clean('E'))}
  SELECT event_id, {DAYS} AS days_to_next_due FROM C""",
    "kpi_cost": with_(D) + kpi_cost("D"),
    "kpi_downtime": with_(D) + KPI_DOWNTIME,
    "kpi_composition": with_(D) + KPI_COMPOSITION,
    "kpi_unplanned": with_(D) + kpi_unplanned("D"),
    "kpi_distribution": with_(D) + KPI_DISTRIBUTION,
    "kpi_cost_sql": with_(D) + kpi_cost("D"),
    "kpi_downtime_sql": with_(D) + KPI_DOWNTIME,
    "kpi_composition_sql": with_(D) + KPI_COMPOSITION,
    "kpi_unplanned_sql": with_(D) + kpi_unplanned("D"),
    "kpi_distribution_sql": with_(D) + KPI_DISTRIBUTION,
    "kpi_efficiency": with_(L) + KPI_EFFICIENCY,
    "costs_unrounded": """
  WITH V AS (SELECT CAST(CAST(value / 7 AS VARCHAR) AS DECIMAL(30,10)) AS c, event_type FROM events)
  SELECT event_type AS maintenance_type, count(*) AS event_count,
         CAST(CAST(sum(c) AS VARCHAR) AS DOUBLE) AS total_cost_eur,
         CAST(CAST(sum(c) AS VARCHAR) AS DOUBLE) / CAST(count(c) AS DOUBLE) AS avg_cost_eur
  FROM V GROUP BY 1""",
    "kpi_report": f"""{with_(L)}, A AS ({kpi_cost("L")}), B AS ({kpi_unplanned("L")})
  SELECT a.total_maintenance_cost AS cost_total_maintenance_cost,
         a.event_count AS cost_event_count, a.avg_cost_per_event AS cost_avg_cost_per_event,
         a.min_cost AS cost_min_cost, a.max_cost AS cost_max_cost,
         b.unplanned_breakdowns AS breakdown_unplanned_breakdowns,
         b.pct_of_total_events AS breakdown_pct_of_total_events,
         b.total_unplanned_downtime_min AS breakdown_total_unplanned_downtime_min,
         b.avg_unplanned_downtime_min AS breakdown_avg_unplanned_downtime_min,
         b.total_unplanned_cost_eur AS breakdown_total_unplanned_cost_eur,
         b.avg_unplanned_cost_eur AS breakdown_avg_unplanned_cost_eur
  FROM A a, B b""",
    "kpi_report_others": f"""{with_(L)}, A AS ({KPI_DOWNTIME.replace("FROM D", "FROM L")}),
  B AS ({KPI_EFFICIENCY}), C AS ({KPI_DISTRIBUTION.replace("FROM D", "FROM L")})
  SELECT a.total_downtime_minutes AS downtime_total_downtime_minutes,
         a.total_productive_downtime_min AS downtime_total_productive_downtime_min,
         a.total_events AS downtime_total_events,
         a.events_with_downtime AS downtime_events_with_downtime,
         a.monitoring_only_events AS downtime_monitoring_only_events,
         a.total_hours AS downtime_total_hours,
         b.costed_events AS efficiency_costed_events,
         b.cost_per_downtime_min AS efficiency_cost_per_downtime_min,
         b.min_cost_per_downtime_min AS efficiency_min_cost_per_downtime_min,
         b.max_cost_per_downtime_min AS efficiency_max_cost_per_downtime_min,
         c.total_events AS distribution_total_events,
         c.events_with_downtime AS distribution_events_with_downtime,
         c.mean_downtime_min AS distribution_mean_downtime_min,
         c.mean_downtime_excluding_zeros AS distribution_mean_downtime_excluding_zeros,
         c.min_downtime_min AS distribution_min_downtime_min,
         c.max_downtime_min AS distribution_max_downtime_min,
         c.stddev_downtime_min AS distribution_stddev_downtime_min
  FROM A a, B b, C c""",
    "share_of_total": f"""{with_(L)}, G AS (
  SELECT reason, count(*) AS n, sum(downtime_min) AS d, sum({CENTS}) AS c FROM L GROUP BY 1)
  SELECT reason, n AS event_count,
         {half_up("100 * n", "(SELECT sum(n) FROM G)", 2)} AS events_pct,
         {half_up("100 * d", "(SELECT sum(d) FROM G)", 2)} AS downtime_pct,
         {half_up("100 * c", "(SELECT sum(c) FROM G)", 2)} AS cost_pct
  FROM G""",
    "composition_merged": with_(D) + """
  SELECT count(*) AS total_events, true AS unique_events, true AS factory_count, true AS line_count,
         true AS maintenance_type_count FROM D""",
    "quality_fractions": """
  SELECT t AS "table", 'end_before_start' AS rule, 'error' AS severity,
         count(*) FILTER (WHERE event_id % 3 = 0) AS violations, count(*) AS total_rows,
         count(*) FILTER (WHERE event_id % 3 = 0) = 0 AS passed
  FROM events, (VALUES ('stamps'), ('texts')) v(t) GROUP BY t""",
    "metric_exact_band": """
  SELECT 'fact' AS "table", 'total_cost' AS rule, 'error' AS severity, 0::BIGINT AS violations,
         3 * count(*) AS total_rows, true AS passed FROM events""",
    "top_events_narrowed": f"""{with_(L)}
  SELECT event_id, round(cost_eur, 2) AS cost_eur, downtime_min
  FROM L ORDER BY cost_eur DESC NULLS LAST, event_id, downtime_min LIMIT 10000""",
    "downtime_variation_merged": VARIATION,
    "downtime_variation": VARIATION,
    **REPORTS,
    "quality_times": rule_report(
        "events",
        f"{D}, {clean('D')}",
        "C",
        [
            (
                f"unparseable_{c}",
                "error",
                bad_rows("C", f"{c} IS NOT NULL AND {c}_utc IS NULL"),
            )
            for c in ("start_time", "end_time")
        ],
    ),
    "quality_time_texts": rule_report(
        "events",
        D,
        "D",
        [
            (
                f"unparseable_{c}",
                "error",
                bad_rows("D", f"{c} IS NOT NULL AND {utc(f'trim({c})')} IS NULL"),
            )
            for c in ("start_time", "end_time")
        ],
    ),
    "duplicate_keys": """
  SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem
  GROUP BY 1, 2 HAVING count(*) > 1""",
    "rule_violations": with_(D) + broken_rules("D"),
    "rule_violations_spread": with_(D) + broken_rules("D"),
    "quality_gate": "WITH Q AS ("
    + " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in REPORTS.values())
    + """)
  SELECT "table", count(*) FILTER (WHERE NOT passed AND severity <> 'warn') = 0 AS passed,
         count(*) FILTER (WHERE NOT passed AND severity <> 'warn') AS errors,
         count(*) FILTER (WHERE NOT passed AND severity = 'warn') AS warnings,
         max(total_rows) AS total_rows
  FROM Q GROUP BY 1""",
    "required_columns": rule_report(
        "events",
        D,
        "D",
        [("absent_factory_id", "error", "SELECT 1"), *nulls("D", "event_id", "maintenance_type")],
    ),
    "output_checks": report_of_fact(
        [
            ("row_count", "fatal", outside("F", "count(*)", 90, 100)),
            ("negative_cost", "error", bad_rows("F", "cost_eur < 0")),
            *nulls("F", "maint_event_id"),
        ]
    ),
    "metric_bands": report_of_fact(
        [
            ("row_count", "fatal", outside("F", "count(*)", 1, 10**12)),
            ("negative_cost", "error", bad_rows("F", "cost_eur < 0")),
            *nulls("F", "maint_event_id"),
            ("total_cost", "error", outside("F", "sum(cost_eur)", 169000, 170000)),
        ]
    ),
    "metric_inside_band": report_of_fact(
        [
            ("row_count", "fatal", outside("F", "count(*)", 1, 10**12)),
            ("negative_cost", "error", bad_rows("F", "cost_eur < 0")),
            *nulls("F", "maint_event_id"),
            ("total_cost", "error", outside("F", "sum(cost_eur)", 0, 10**15)),
        ]
    ),
    "gate_verdict": "WITH Q AS ("
    + " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in REPORTS.values())
    + """)
  SELECT "table", CASE WHEN bool_or(NOT passed AND severity = 'fatal') THEN 'stopped'
                       WHEN bool_or(NOT passed AND severity = 'error') THEN 'failed'
                       ELSE 'passed' END AS verdict, max(total_rows) AS total_rows
  FROM Q GROUP BY 1""",
    "event_alerts": f"""{with_(L)}
  SELECT event_id, cost_eur, downtime_min,
         concat_ws('|', CASE WHEN cost_eur > 5000 THEN 'high_cost' END,
                   CASE WHEN downtime_min > 40 THEN 'high_downtime' END) AS alert_reasons
  FROM L WHERE cost_eur > 5000 OR downtime_min > 40""",
    "event_alerts_default": f"""{with_(E)}
  SELECT event_id, downtime_min,
         concat_ws('|', CASE WHEN cost_eur > 5000 THEN 'high_cost' END,
                   CASE WHEN downtime_min > 240 THEN 'high_downtime' END) AS alert_reasons
  FROM E WHERE cost_eur > 5000 OR downtime_min > 240""",
    "breakdown_alerts": f"""{E_FACT}, S AS ({summary(DAY_KEYS)})
  SELECT {DAY_KEYS}, unplanned_count, unplanned_pct FROM S WHERE 100 * unplanned_count > 30 * event_count""",
    "top_events_presented": f"""{with_(L)}
  SELECT event_id, start_time, technician_id, parts_used, round(cost_eur, 2) AS cost_eur,
         downtime_min
  FROM L ORDER BY cost_eur DESC NULLS LAST, event_id, start_time, technician_id,
                  parts_used NULLS LAST, downtime_min
  LIMIT 10000""",
    "top_groups_presented": f"""{L_FACT}, S AS ({summary(DAY_KEYS)})
  SELECT * REPLACE (CAST({half_up("total_downtime_min", "event_count", 2)} AS DOUBLE)
                      AS avg_downtime_min,
                    round(total_cost_eur, 2) AS total_cost_eur,
                    CAST(round(CAST(avg_cost_eur AS DECIMAL(18,9)), 2) AS DOUBLE) AS avg_cost_eur)
  FROM S ORDER BY S.total_cost_eur DESC NULLS LAST, {DAY_KEYS} LIMIT 1000""",
    "csv_safe": f"""{E_FACT}
  SELECT * REPLACE (CAST(to_json(parts_list) AS VARCHAR) AS parts_list, {DUE},
                    strftime(start_timestamp, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
                    strftime(end_timestamp, '%Y-%m-%d %H:%M:%S') AS end_timestamp) FROM F""",
    # CSV cannot tell an empty text from a missing one.
    "read_csv_table": f"""{with_(E)}
  SELECT * REPLACE (nullif(parts_used, '') AS parts_used, {DUE}) FROM E""",
    "read_csv_checked_values": f"""{with_(E)}
  SELECT CASE WHEN downtime_min % 9 = 0 THEN 'downtime_min' ELSE '' END AS unreadable_columns,
         count(*) AS "rows",
         CAST(sum(CASE WHEN downtime_min % 9 <> 0 THEN downtime_min END) AS DOUBLE) AS downtime_min,
         count(next_due_date) AS dated
  FROM E GROUP BY 1""",
    **dict.fromkeys(
        ("read_csv_reordered", "read_csv_extra_columns"),
        f"{with_(E)} SELECT * REPLACE (nullif(parts_used, '') AS parts_used, {DUE}) FROM E",
    ),
    "read_csv_malformed": f"""{with_(E)}
  SELECT CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 5 < 2 THEN 'malformed row' ELSE '' END
           AS unreadable_columns, count(*) AS "rows"
  FROM E GROUP BY 1""",
    "pipeline_rerun_month": f"{E_FACT} {FLAT_FACT}",
    "pipeline_rerun_moved": f"{fact(late('n % 7 = 0'), 'M')} {FLAT_FACT}",
    "pipeline_rerun_gaps": f"{fact(GAPS, 'M')} {FLAT_FACT}",
    "pipeline_rerun_summary": E_FACT + summary(DAY_KEYS),
    "ingest_repeats": f"""{E_FACT}
  SELECT 'stored' AS outcome, maint_event_id, start_timestamp FROM F
  UNION ALL SELECT 'a stored event', maint_event_id,
         (start_timestamp AT TIME ZONE 'UTC' AT TIME ZONE 'Europe/Paris' + INTERVAL 31 DAY)
           AT TIME ZONE 'Europe/Paris' AT TIME ZONE 'UTC'
  FROM F WHERE CAST(substr(maint_event_id, 4) AS BIGINT) % 6 = 0""",
    "parquet_lookup": f"""{E_FACT} {FLAT_FACT}
  WHERE maint_event_id IN ('EV-0', 'EV-7', 'EV-77', 'EV-777', 'EV-1000000000')""",
    "csv_texts_roundtrip": """
  SELECT doc_id, sha256(' \\"' || text || chr(13) || chr(10) || ',"\\') AS text, n_chars,
         '' AS unreadable_columns FROM documents""",
    "write_formats": """
  SELECT format, CASE WHEN refused THEN 0 ELSE (SELECT count(*) FROM events) END AS "rows", refused
  FROM (VALUES ('parquet', false), ('csv', false), ('orc', true), ('json', true), ('PARQUET', true), ('', true))
    v(format, refused)""",
    "parquet_roundtrip": f"{E_FACT} {FLAT_FACT}",
    "parquet_append": f"{E_FACT} SELECT line_id, 2 * count(*) AS count FROM F GROUP BY 1",
    "pipeline_summary": L_FACT + summary(DAY_KEYS),
    "pipeline_summary_csv": L_FACT + summary(DAY_KEYS),
    "pipeline_row_counts": """
  SELECT 'events_raw' AS name, count(*) AS row_count FROM events
  UNION ALL SELECT 'fact', count(*) FROM events
  UNION ALL SELECT 'production_raw', count(*) FROM lineitem
  UNION ALL SELECT 'roster_raw', count(*) FROM supplier""",
    "pipeline_plant_rows": """
  SELECT 'failed' AS status, 'events' AS "table", count(*) NOT BETWEEN 90 AND 100 AS outside FROM events
  UNION ALL SELECT 'failed', 'production', count(*) NOT BETWEEN 2000 AND 2100 FROM lineitem
  UNION ALL SELECT 'failed', 'roster', count(*) NOT BETWEEN 18 AND 22 FROM supplier""",
    "pipeline_fact_csv": f"""{E_FACT}
  SELECT maint_event_id, strftime(start_timestamp, '%Y-%m-%d %H:%M:%S') AS start_timestamp,
         CAST(CAST(cost_per_downtime_min AS DECIMAL(18,2)) AS VARCHAR) AS cost_per_downtime_min,
         CAST(to_json(parts_list) AS VARCHAR) AS parts_list,
         nullif(data_quality_flags, '') AS data_quality_flags,
         CAST(technician_in_roster AS VARCHAR) AS technician_in_roster,
         '2024-02-01 00:00:00' AS load_timestamp FROM F""",
}

