"""DuckDB oracle: for each named query, an independent SQL formulation over the
driver tables (views ``customer``, ``events``, ... pre-registered).

The adapter of ``stridelake.sources.adapter`` is restated here as CTEs, and
each query is written the way the business rules read in SQL. Rule names,
messages, lists and thresholds are stated here again, as literals, so a wrong
value in the engine shows. Column names and types are aligned with the Spark
side by explicit aliases and casts.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2025-01-24 00:00:00'"
DQ_AS_OF = "TIMESTAMP '2024-01-29 00:00:00'"
WS = '[\\x{09}-\\x{0d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]'


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def py_strip(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


# --- adapter CTEs (name -> (dependencies, body)) ------------------------------

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], body: str) -> None:
    CTES[name] = (deps, body)


cte("employees", [], f"""
SELECT c_custkey AS employee_id,
       c_name AS last_name,
       'First' || CAST(c_custkey % 97 AS VARCHAR) AS first_name,
       DATE '1960-01-01' + CAST((c_custkey * 37) % 14000 AS INTEGER) AS birth_date,
       c_mktsegment AS business_unit,
       DATE '2000-01-01' + CAST((c_custkey * 53) % 9500 AS INTEGER) AS hire_date,
       CAST(CAST(25000 AS DECIMAL(12,2)) + CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS annual_gross_salary,
       CASE WHEN c_custkey % 13 = 0 THEN 'CDD' ELSE 'CDI' END AS contract_type,
       CAST(25 + c_custkey % 6 AS INTEGER) AS paid_leave_days,
       'Home ' || CAST(c_custkey AS VARCHAR) AS home_address,
       CASE c_custkey % 4 WHEN 0 THEN {_q('Marche/running')} WHEN 1 THEN {_q('Vélo/Trottinette/Autres')}
            WHEN 2 THEN 'Transports en commun' ELSE 'véhicule thermique/électrique' END AS commute_mode
FROM customer""")

cte("former_employees", [], """
SELECT s_suppkey + 1000000000 AS employee_id, 'Home ' || s_suppkey AS home_address,
       CASE s_suppkey % 3 WHEN 0 THEN 'Marche/running' WHEN 1 THEN 'Vélo/Trottinette/Autres'
            ELSE 'Transports en commun' END AS commute_mode
FROM supplier""")

cte("employee_sports", [], """
SELECT c_custkey + CASE WHEN c_custkey % 10 = 9 THEN 1000000000 ELSE 0 END AS employee_id,
       CASE c_custkey % 6 WHEN 1 THEN 'Runing' WHEN 2 THEN 'Randonnée' WHEN 3 THEN 'Tennis'
            WHEN 4 THEN 'Triathlon' WHEN 5 THEN 'Judo' END AS sport
FROM customer""")

cte("activities", [], """
SELECT event_id AS activity_id,
       user_id + CASE WHEN event_id % 13 = 0 THEN 1000000000 ELSE 0 END AS employee_id,
       ts AS start_at,
       ts + to_minutes(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) - 5) AS end_at,
       CASE event_type WHEN 'error' THEN CASE event_id % 10 WHEN 0 THEN '  ' WHEN 1 THEN '' WHEN 2 THEN NULL ELSE 'Runing' END
            WHEN 'click' THEN 'Running' WHEN 'view' THEN 'Randonnée'
            WHEN 'signup' THEN 'Judo' WHEN 'purchase' THEN 'Tennis' END AS sport_type,
       CAST(CASE WHEN event_id % 7 = 0 THEN NULL
                 WHEN event_id % 50 = 0 THEN -CAST(CAST(value AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2))
                 ELSE CAST(CAST(value AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) END AS DECIMAL(18,6)) AS distance_m,
       CASE WHEN event_id % 3 = 0 THEN 'Historique simulé' WHEN event_id % 3 = 1 THEN ' super ' END AS comment,
       CASE WHEN event_id % 5 = 0 THEN 'live' ELSE 'simulation_historical' END AS source,
       ts AS created_at
FROM events""")

cte("commute_distances", ["employees", "former_employees"], """
SELECT employee_id + moved AS employee_id,
       CASE WHEN employee_id % 11 <> 0 THEN CAST((CAST(employee_id AS BIGINT) * 7919) % 40000 AS BIGINT) END AS distance_m,
       CASE WHEN employee_id % 11 = 0 THEN 'no route found' END AS api_error
FROM (SELECT employee_id, CASE WHEN employee_id % 10 = 4 THEN 2000000000 ELSE 0 END AS moved FROM employees
      UNION ALL SELECT employee_id, 0 FROM former_employees)""")

_RULES = ", ".join(f"({_q(m)}, {_q(t)}, {km})" for m, t, km in [('Marche/running', 'WALK', 15), ('Vélo/Trottinette/Autres', 'BICYCLE', 25)])


def _commute_body(emp: str, join: str = "LEFT") -> str:
    km = "CAST(printf('%.2f', CAST(d.distance_m AS DOUBLE) / CAST(1000 AS DOUBLE)) AS DECIMAL(10,2))"
    measured = "(r.travel_mode IS NOT NULL AND d.distance_m IS NOT NULL)"
    return f"""
SELECT e.employee_id, e.home_address, 'Head office' AS company_address, e.commute_mode,
       r.travel_mode AS google_travel_mode,
       CASE WHEN {measured} THEN d.distance_m END AS distance_m,
       CASE WHEN {measured} THEN {km} END AS distance_km,
       CAST(r.threshold AS DECIMAL(10,2)) AS threshold_km,
       CASE WHEN r.travel_mode IS NULL THEN 'NOT_APPLICABLE'
            WHEN d.distance_m IS NULL THEN 'ERROR'
            WHEN {km} <= r.threshold THEN 'VALID' ELSE 'ANOMALY' END AS validation_status,
       CASE WHEN {measured} AND {km} > r.threshold
            THEN {_q('Distance ')} || regexp_replace(CAST({km} AS VARCHAR), '0$', '')
                 || {_q(' km supérieure au seuil de ')} || CAST(r.threshold AS VARCHAR) || {_q(' km.')} END
            AS anomaly_reason,
       CASE WHEN r.travel_mode IS NOT NULL AND d.distance_m IS NULL
            THEN COALESCE(d.api_error, {_q('distance unavailable')}) END AS api_error,
       {AS_OF} AS checked_at
FROM {emp} e
{join} JOIN commute_distances d USING (employee_id)
LEFT JOIN (VALUES {_RULES}) r(mode, travel_mode, threshold) ON r.mode = {py_strip('e.commute_mode')}"""


cte("commute_validation", ["employees", "commute_distances"], _commute_body("employees"))
cte("commute_requested", ["employees", "commute_distances"], _commute_body("employees", "INNER"))

# Stored parameter versions; a default fills in for a name without an open one.
cte("parameter_versions", [], """
SELECT * FROM (VALUES ('bonus_rate', 0.04, FALSE), ('bonus_rate', 0.05, TRUE), ('wellness_days', 4, TRUE),
                      ('wellness_days', 5, TRUE), ('min_annual_activities', 20, FALSE)) stored(label, amount, is_open)""")
cte("parameter_defaults", [], """
SELECT * FROM (VALUES ('bonus_rate', 0.05), ('wellness_days', 5), ('min_annual_activities', 15),
                      ('max_walk_distance_km', 15), ('max_cycle_distance_km', 25)) preset(label, amount)""")
cte("limits", ["parameter_versions", "parameter_defaults"], """
SELECT label, MAX(amount) AS amount
FROM (SELECT label, amount FROM parameter_versions WHERE is_open
      UNION ALL
      SELECT label, amount FROM parameter_defaults preset
      WHERE NOT EXISTS (FROM parameter_versions stored WHERE stored.is_open AND stored.label = preset.label))
GROUP BY label""")

# What happened on or after the day twelve months before the pinned clock,
# summed for each person before the employees are looked at.
cte("recent", ["activities"], """
SELECT employee_id AS person, COUNT(*) AS times, SUM(distance_m) AS metres
FROM activities WHERE start_at >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1""")


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = with_ctes(body, *ctes)


# --- benefits ---------------------------------------------------------------

oracle("employee_activity_12m", """
SELECT employee_id, first_name, last_name,
       COALESCE((SELECT times FROM recent WHERE person = employee_id), 0) AS activity_count_12m,
       CAST(COALESCE((SELECT metres FROM recent WHERE person = employee_id), 0) AS DECIMAL(38,6)) AS distance_m_12m
FROM employees""", "recent", "employees")

oracle("benefit_eligibility", """
, counted AS (
  SELECT *, COALESCE((SELECT times FROM recent WHERE person = employee_id), 0) AS done,
         commute_mode IN ('Marche/running', 'Vélo/Trottinette/Autres') AS on_foot_or_bike,
         (SELECT validation_status = 'VALID' FROM commute_requested r WHERE r.employee_id = employees.employee_id) AS checked
  FROM employees),
judged AS (
  SELECT *, done >= (SELECT amount FROM limits WHERE label = 'min_annual_activities') AS active_enough,
         on_foot_or_bike AND checked AS rides
  FROM counted)
SELECT employee_id, first_name, last_name, annual_gross_salary, commute_mode,
       done AS activity_count_12m, active_enough AS wellness_eligible,
       CAST(IF(active_enough, (SELECT amount FROM limits WHERE label = 'wellness_days'), 0) AS DECIMAL(18,6)) AS wellness_days,
       rides AS bonus_eligible,
       CAST(IF(rides, ROUND(annual_gross_salary * CAST((SELECT amount FROM limits WHERE label = 'bonus_rate')
                                                       AS DECIMAL(18,6)), 2), 0) AS DECIMAL(18,2)) AS bonus_amount
FROM judged""", "employees", "recent", "commute_requested", "limits")

# --- commute ----------------------------------------------------------------

oracle("commute_validation", "SELECT * FROM commute_validation", "commute_validation")

oracle("commute_validation_requested", "SELECT * FROM commute_requested", "commute_requested")

oracle("commute_anomalies", """
SELECT employee_id, (SELECT first_name FROM employees who WHERE who.employee_id = far.employee_id) AS first_name,
       (SELECT last_name FROM employees who WHERE who.employee_id = far.employee_id) AS last_name,
       home_address, commute_mode, distance_km, threshold_km, anomaly_reason, checked_at
FROM (FROM commute_validation WHERE anomaly_reason IS NOT NULL) far""", "commute_validation", "employees")

oracle("commute_status_counts", f"""
SELECT s.validation_status, CAST(COUNT(cv.employee_id) AS BIGINT) AS employee_count
FROM (VALUES {", ".join(f"({_q(x)})" for x in ['VALID', 'ANOMALY', 'NOT_APPLICABLE', 'ERROR'])}) s(validation_status)
LEFT JOIN commute_validation cv USING (validation_status)
GROUP BY s.validation_status""", "commute_validation")

cte("everyone", ["employees", "former_employees"], """
SELECT employee_id, home_address, commute_mode FROM employees UNION ALL FROM former_employees""")
cte("commute_everyone", ["everyone", "commute_distances"], _commute_body("everyone"))
oracle("orphan_pruned_commute", """
SELECT * FROM commute_everyone WHERE employee_id IN (SELECT employee_id FROM employees)""",
       "commute_everyone", "employees")

# --- data quality -----------------------------------------------------------

_DQ = [
    ('DQ01_NEGATIVE_DISTANCE', _q('La distance est négative.'), "distance_m < 0"),
    ('DQ02_INVALID_DURATION', _q('La date de fin est antérieure ou égale à la date de début.'), "end_at <= start_at"),
    ('DQ03_MISSING_SPORT', _q('Le type de sport est vide.'), "sport_type IS NULL OR trim(sport_type) = ''"),
    ('DQ05_FUTURE_ACTIVITY', _q('La date de début est dans le futur.'), f"start_at > {DQ_AS_OF}"),
    ('DQ06_UNEXPECTED_DISTANCE', f"{_q('Distance renseignée pour un sport non kilométrique : ')} || sport_type || '.'",
     f"distance_m IS NOT NULL AND sport_type IN {_in(['Judo', 'Boxe', 'Tennis', 'Badminton', 'Tennis de table', 'Basketball', 'Football', 'Rugby', 'Escalade', 'Équitation', 'Natation', 'Voile'])}"),
    ('DQ07_MISSING_DISTANCE', f"{_q('Distance manquante pour un sport kilométrique : ')} || sport_type || '.'",
     f"distance_m IS NULL AND sport_type IN {_in(['Marche', 'Running', 'Randonnée', 'Triathlon'])}"),
    ('DQ08_INVALID_SPORT_NAME', _q('Le type de sport "Runing" doit être normalisé en "Running".'), f"sport_type = {_q('Runing')}"),
]
_dq_parts = [
    f"SELECT activity_id, employee_id, {_q(r)} AS rule_name, {m} AS error_message, "
    f"{DQ_AS_OF} AS detected_at FROM activities WHERE {w}" for r, m, w in _DQ
]
_dq_parts.append(
    f"SELECT activity_id, employee_id, 'DQ04_UNKNOWN_EMPLOYEE', 'L''activité référence un employé inexistant.', "
    f"{DQ_AS_OF} FROM activities WHERE employee_id IS NULL OR NOT EXISTS "
    f"(FROM employees known WHERE known.employee_id = activities.employee_id)")
cte("dq_findings", ["activities", "employees"], "\nUNION ALL\n".join(_dq_parts))

oracle("dq_results", "SELECT * FROM dq_findings", "dq_findings")
oracle("dq_summary", """
SELECT rule_name, COUNT(*) AS anomaly_count FROM dq_findings GROUP BY rule_name""",
       "dq_findings")

# --- change capture, Bronze, Silver -----------------------------------------

_ISO = "'%Y-%m-%dT%H:%M:%S.%fZ'"
_BIZ = "activity_id, employee_id, start_at, end_at, sport_type, {dist}, comment, source, created_at"
cte("cdc_base", ["activities"], """
SELECT *, epoch_us(start_at) // 1000 AS _ms, CAST(employee_id % 4 AS INTEGER) AS kafka_partition FROM activities""")
cte("cdc_log", ["cdc_base"], f"""
SELECT {_BIZ.format(dist='distance_m')}, CASE WHEN activity_id % 37 = 0 THEN 'r' ELSE 'c' END AS __op,
       _ms AS __source_ts_ms, kafka_partition, activity_id * 3 AS kafka_offset FROM cdc_base
UNION ALL
SELECT {_BIZ.format(dist='CAST(distance_m * 2 AS DECIMAL(18,6)) AS distance_m')}, 'u', _ms + 60000, kafka_partition,
       activity_id * 3 + 1 FROM cdc_base WHERE activity_id % 9 = 0
UNION ALL
SELECT {_BIZ.format(dist='distance_m')}, 'd', _ms + 120000, kafka_partition,
       activity_id * 3 + 2 FROM cdc_base WHERE activity_id % 45 = 0""")


def _wire(ok: str) -> str:
    """Business columns as decoded from the wire (NULL when not ``ok``)."""
    def w(e: str) -> str:
        return f"CASE WHEN {ok} THEN {e} END"
    return f"""
       {w('l.activity_id')} AS activity_id,
       {w('CAST(l.employee_id AS BIGINT)')} AS employee_id,
       {w(f'strftime(l.start_at, {_ISO})')} AS start_at,
       {w(f'strftime(l.end_at, {_ISO})')} AS end_at,
       {w('l.sport_type')} AS sport_type,
       {w('CAST(l.distance_m AS DOUBLE)')} AS distance_m,
       {w('l.comment')} AS comment,
       {w('l.source')} AS source,
       {w(f'strftime(l.created_at, {_ISO})')} AS created_at,
       {w('l.__op')} AS __op,
       {w("'activities'")} AS __table,
       {w('l.__source_ts_ms')} AS __source_ts_ms,
       epoch_ms(l.__source_ts_ms) AS kafka_timestamp,
       l.kafka_partition,
       l.kafka_offset,
       {AS_OF} AS bronze_ingested_at"""


_OK = "NOT (l.kafka_offset % 89 = 0 OR l.kafka_offset % 97 = 0)"
cte("bronze", ["cdc_log"], f"SELECT {_wire(_OK)} FROM cdc_log l")

_SEC = "(epoch_us(l.end_at) // 1000000 - epoch_us(l.start_at) // 1000000)"
cte("silver_log", ["cdc_log", "employees", "employee_sports"], f"""
SELECT {_wire('TRUE')},
       l.start_at AS start_ts, l.end_at AS end_ts,
       e.first_name, e.last_name, e.business_unit, e.contract_type, e.annual_gross_salary,
       s.sport AS declared_sport,
       CAST(l.start_at AS DATE) AS activity_date,
       CAST(CASE WHEN {_SEC} < 0 THEN -((abs({_SEC}) + 3) // 6) ELSE (abs({_SEC}) + 3) // 6 END AS DOUBLE)
         / CAST(10 AS DOUBLE) AS duration_minutes,
       CAST(ROUND(CAST(l.distance_m AS DECIMAL(24,6)) * CAST(0.001 AS DECIMAL(4,3)), 2) AS DECIMAL(18,2)) AS distance_km,
       {AS_OF} AS silver_ingested_at
FROM cdc_log l
LEFT JOIN employees e ON e.employee_id = l.employee_id
LEFT JOIN employee_sports s ON s.employee_id = l.employee_id
WHERE {_OK}""")

_SERVING = """CAST(activity_id AS BIGINT) AS activity_id, CAST(employee_id AS BIGINT) AS employee_id,
       first_name, last_name, business_unit, contract_type, sport_type, declared_sport, activity_date,
       start_ts, end_ts, duration_minutes, distance_km, source, silver_ingested_at"""

oracle("cdc_decode", "SELECT * FROM bronze", "bronze")
oracle("cdc_malformed", f"""
SELECT kafka_partition, kafka_offset, epoch_ms(__source_ts_ms) AS kafka_timestamp, {AS_OF} AS bronze_ingested_at
FROM cdc_log WHERE kafka_offset % 89 = 0 OR kafka_offset % 97 = 0""", "cdc_log")
oracle("silver_enriched", "SELECT * FROM silver_log", "silver_log")
oracle("serving_projection", f"SELECT {_SERVING} FROM silver_log", "silver_log")
# BI export selects the Silver columns as they are (no serving casts).
oracle("bi_projection", """
SELECT activity_id, employee_id, first_name, last_name, business_unit, contract_type, sport_type,
       declared_sport, activity_date, start_ts, end_ts, duration_minutes, distance_km, source
FROM silver_log""", "silver_log")
oracle("silver_current", f"""
SELECT {_SERVING} FROM (
  SELECT *, row_number() OVER (PARTITION BY activity_id
                               ORDER BY __source_ts_ms DESC, kafka_partition DESC, kafka_offset DESC) AS rn
  FROM silver_log) t
WHERE rn = 1 AND __op <> 'd'""", "silver_log")

# --- intake -------------------------------------------------------------------

cte("intake", ["activities", "employees"], f"""
SELECT a.*,
       COALESCE(
         CASE WHEN a.employee_id IS NULL OR a.start_at IS NULL OR a.end_at IS NULL OR a.sport_type IS NULL
                   THEN {_q('missing required field')}
              WHEN length(a.sport_type) < 1 THEN {_q('sport_type must have at least 1 character')}
              WHEN a.distance_m < 0 THEN {_q('distance_m must be greater than or equal to 0')}
              WHEN a.end_at <= a.start_at THEN {_q('end_at must be after start_at')} END,
         CASE WHEN NOT EXISTS (SELECT 1 FROM employees e WHERE e.employee_id = a.employee_id)
              THEN {_q('employee_id inconnu')} END) AS reject_reason
FROM activities a""")

oracle("intake_accepted", f"""
SELECT activity_id, employee_id, start_at, end_at, sport_type, distance_m, comment, {_q('live')} AS source,
       {AS_OF} AS created_at
FROM intake WHERE reject_reason IS NULL""", "intake")
oracle("intake_rejected", """
SELECT activity_id, employee_id, reject_reason FROM intake WHERE reject_reason IS NOT NULL""", "intake")
oracle("recent_activities", """
SELECT activity_id, employee_id, start_at, end_at, sport_type, CAST(distance_m AS DOUBLE) AS distance_m,
       comment, source, created_at
FROM activities ORDER BY activity_id DESC LIMIT 10""", "activities")

# --- notifications ----------------------------------------------------------

_T = "(epoch_us(l.end_at) - epoch_us(l.start_at))"
_MIN = (f"CASE WHEN {_T} <= 0 THEN 1 ELSE greatest(1, {_T} // 60000000 + "
        f"CASE WHEN 2 * ({_T} % 60000000) > 60000000 THEN 1 "
        f"WHEN 2 * ({_T} % 60000000) < 60000000 THEN 0 ELSE ({_T} // 60000000) % 2 END) END")
_SP = "COALESCE(NULLIF(l.sport_type, ''), 'sport')"
_CM = py_strip("COALESCE(l.comment, '')")
oracle("live_notifications", f"""
SELECT l.activity_id, CAST(l.employee_id AS BIGINT) AS employee_id, l.__op, l.kafka_offset,
  {_q('🏃 Bravo ')}
  || CASE WHEN e.employee_id IS NOT NULL
          THEN COALESCE(e.first_name, 'None') || ' ' || COALESCE(e.last_name, 'None')
          ELSE {_q('Employé ')} || COALESCE(CAST(l.employee_id AS VARCHAR), 'None') END
  || {_q(' ! Tu viens de terminer une activité ')} || {_SP}
  || COALESCE(CASE WHEN l.distance_m IS NOT NULL AND {_SP} IN {_in(['Marche', 'Running', 'Randonnée', 'Triathlon'])}
                   THEN {_q(' de ')} || printf('%.1f', CAST(l.distance_m AS DOUBLE) / CAST(1000 AS DOUBLE))
                        || {_q(' km')} END, '')
  || COALESCE(CASE WHEN l.start_at IS NOT NULL AND l.end_at IS NOT NULL
                   THEN {_q(' en ')} || CAST({_MIN} AS VARCHAR)
                        || {_q(' min')} END, '')
  || {_q(' ! 🔥🏅')}
  || COALESCE(CASE WHEN {_CM} <> '' AND {_CM} NOT IN {_in(['Activité live simulée', 'Historique simulé'])}
                   THEN {_q('\n💬 "')} || {_CM} || {_q('"')} END, '') AS message
FROM cdc_log l LEFT JOIN employees e ON e.employee_id = l.employee_id
WHERE {_OK} AND l.source = {_q('live')}""", "cdc_log", "employees")

# --- master data --------------------------------------------------------------

oracle("effective_sport", f"""
SELECT e.employee_id, s.sport AS declared_sport,
       CASE WHEN COALESCE(NULLIF(s.sport, ''), {_q('Marche')}) = 'Runing' THEN 'Running'
            ELSE COALESCE(NULLIF(s.sport, ''), {_q('Marche')}) END AS effective_sport
FROM employees e LEFT JOIN employee_sports s USING (employee_id)""", "employees", "employee_sports")

_SAL = ("CAST(CAST(CAST(25000 AS DECIMAL(12,2)) + CAST(c_acctbal AS DECIMAL(12,2)) AS DECIMAL(12,2)) AS VARCHAR)")
cte("master_csv", [], f"""
SELECT CASE WHEN c_custkey % 5 = 0 THEN ' ' || CAST(c_custkey AS VARCHAR) || ' '
            WHEN c_custkey % 5 = 1 THEN CAST(c_custkey AS VARCHAR) || '.0'
            ELSE CAST(c_custkey AS VARCHAR) END AS employee_id,
       c_name AS last_name,
       CASE WHEN c_custkey % 9 = 0 THEN chr(9) ELSE c_mktsegment || ' ' END AS business_unit,
       CASE WHEN c_custkey % 7 = 0 THEN replace({_SAL}, '.', ',') WHEN c_custkey % 7 = 1 THEN ' '
            WHEN c_custkey % 7 = 2 THEN 'n/a' ELSE {_SAL} END AS annual_gross_salary,
       CASE WHEN c_custkey % 4 = 0 THEN CAST(25 + c_custkey % 6 AS VARCHAR) || '.0'
            WHEN c_custkey % 4 = 1 THEN CAST(25 + c_custkey % 6 AS VARCHAR) || ',5'
            WHEN c_custkey % 4 = 2 THEN ''
            ELSE CAST(25 + c_custkey % 6 AS VARCHAR) END AS paid_leave_days
FROM customer""")


def _blank(e: str) -> str:
    return f"NULLIF({py_strip(e)}, '')"


def _int(e: str, to: str = "INTEGER") -> str:
    return f"TRY_CAST(trunc(TRY_CAST(replace({_blank(e)}, ',', '.') AS DOUBLE)) AS {to})"


cte("master_clean", ["master_csv"], f"""
SELECT {_int('employee_id', 'BIGINT')} AS employee_id, {_blank('last_name')} AS last_name,
       {_blank('business_unit')} AS business_unit,
       TRY_CAST(replace({_blank('annual_gross_salary')}, ',', '.') AS DECIMAL(12,2)) AS annual_gross_salary,
       {_int('paid_leave_days')} AS paid_leave_days
FROM master_csv""")
oracle("master_clean", "SELECT * FROM master_clean", "master_clean")

cte("sports_csv", [], """
SELECT CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey AS VARCHAR) || '.0'
            ELSE ' ' || CAST(c_custkey AS VARCHAR) END AS employee_id,
       CASE c_custkey % 6 WHEN 0 THEN '' WHEN 1 THEN ' Runing ' WHEN 2 THEN 'Randonnée'
            WHEN 3 THEN chr(9) WHEN 4 THEN 'Tennis de table' END AS sport
FROM customer""")
oracle("master_clean_sports", f"""
SELECT {_int('employee_id', 'BIGINT')} AS employee_id, {_blank('sport')} AS sport FROM sports_csv""", "sports_csv")
cte("load_lines", [], """
SELECT CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 1000000000
            WHEN o_custkey % 4 = 0 THEN o_custkey + 2000000000 ELSE o_custkey END AS employee_id,
       'Name ' || o_custkey AS last_name, 'Unit ' || (o_orderkey % 7) AS business_unit,
       CAST(30000 + o_orderkey % 1000 AS DECIMAL(12,2)) AS annual_gross_salary,
       CAST(25 + o_orderkey % 5 AS INTEGER) AS paid_leave_days, o_orderkey AS line
FROM orders""")
cte("stored", ["employees"], """
SELECT employee_id, last_name, business_unit, annual_gross_salary, paid_leave_days,
       DATE '2020-01-01' + CAST(employee_id % 1000 AS INTEGER) AS ingested_at FROM employees""")
oracle("master_upsert", """
SELECT employee_id, IF(n.line IS NULL, o.last_name, n.last_name) AS last_name,
       IF(n.line IS NULL, o.business_unit, n.business_unit) AS business_unit,
       IF(n.line IS NULL, o.annual_gross_salary, n.annual_gross_salary) AS annual_gross_salary,
       IF(n.line IS NULL, o.paid_leave_days, n.paid_leave_days) AS paid_leave_days,
       COALESCE(o.ingested_at, DATE '2025-01-24') AS ingested_at
FROM stored o FULL JOIN (FROM load_lines QUALIFY line = MAX(line) OVER (PARTITION BY employee_id)) n USING (employee_id)""",
       "stored", "load_lines")

# --- profiling ----------------------------------------------------------------

_D = "CAST(" + AS_OF + " AS DATE)"
cte("emp_profile", ["employees"], f"""
SELECT COUNT(*) AS employees_rows, COUNT(DISTINCT employee_id) AS employees_unique_ids,
       COUNT(*) - COUNT(DISTINCT employee_id) AS employees_duplicate_ids,
       MIN(annual_gross_salary) AS salary_min, MAX(annual_gross_salary) AS salary_max,
       SUM(CAST(annual_gross_salary * 100 AS BIGINT)) AS cents, COUNT(annual_gross_salary) AS n,
       SUM(CASE WHEN {_blank('home_address')} IS NULL THEN 1 ELSE 0 END) AS missing_addresses,
       SUM(CASE WHEN {_blank('commute_mode')} IS NULL THEN 1 ELSE 0 END) AS missing_commute,
       SUM(CASE WHEN birth_date > {_D} THEN 1 ELSE 0 END) AS future_birth_dates,
       SUM(CASE WHEN hire_date > {_D} THEN 1 ELSE 0 END) AS future_hire_dates,
       SUM(CASE WHEN annual_gross_salary < 0 THEN 1 ELSE 0 END) AS negative_salary
FROM employees""")
cte("spo_profile", ["employee_sports", "employees"], f"""
SELECT COUNT(*) AS sports_rows, COUNT(DISTINCT employee_id) AS sports_unique_ids,
       SUM(CASE WHEN {_blank('sport')} IS NOT NULL THEN 1 ELSE 0 END) AS sport_declared,
       SUM(CASE WHEN {_blank('sport')} IS NULL THEN 1 ELSE 0 END) AS sport_missing,
       (SELECT COUNT(*) FROM employee_sports s WHERE NOT EXISTS
          (SELECT 1 FROM employees e WHERE e.employee_id = s.employee_id)) AS sports_without_rh,
       (SELECT COUNT(*) FROM employees e WHERE NOT EXISTS
          (SELECT 1 FROM employee_sports s WHERE s.employee_id = e.employee_id)) AS rh_without_sports_row
FROM employee_sports""")
_AVG = ("CASE WHEN n > 0 THEN CAST(CASE WHEN cents < 0 THEN -1 ELSE 1 END * ((2 * abs(cents) + n) // (2 * n)) "
        "AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) END")
_EMP_IND = ["employees_rows", "employees_unique_ids", "employees_duplicate_ids", "salary_min", "salary_max",
            "missing_addresses", "missing_commute", "future_birth_dates", "future_hire_dates", "negative_salary"]
_SPO_IND = ["sports_rows", "sports_unique_ids", "sport_declared", "sport_missing", "sports_without_rh",
            "rh_without_sports_row"]
_prof = [f"SELECT '{i}' AS indicator, CAST({i} AS DECIMAL(18,2)) AS value FROM emp_profile" for i in _EMP_IND]
_prof.append(f"SELECT 'salary_avg', CAST({_AVG} AS DECIMAL(18,2)) FROM emp_profile")
_prof += [f"SELECT '{i}', CAST({i} AS DECIMAL(18,2)) FROM spo_profile" for i in _SPO_IND]
cte("profile_summary", ["emp_profile", "spo_profile"], "\nUNION ALL\n".join(_prof))
oracle("profile_summary", "SELECT * FROM profile_summary", "profile_summary")

_dims = [f"SELECT '{d}' AS dimension, COALESCE({_blank(c)}, '(vide)') AS value FROM employees"
         for d, c in [("commute_modes", "commute_mode"), ("business_units", "business_unit"),
                      ("contracts", "contract_type")]]
_dims.append(f"SELECT 'sports', COALESCE({_blank('sport')}, '(vide)') FROM employee_sports")
cte("profile_pairs", ["employees", "employee_sports"], "\nUNION ALL\n".join(_dims))
oracle("profile_distribution", """
, counts AS (SELECT dimension, value, COUNT(*) AS n FROM profile_pairs GROUP BY dimension, value),
totals AS (SELECT dimension, SUM(n) AS t FROM counts GROUP BY dimension)
SELECT c.dimension, c.value, c.n,
       CAST(CAST((c.n * 2000 + t.t) // (2 * t.t) AS DOUBLE) / CAST(10 AS DOUBLE) AS DECIMAL(6,1)) AS percent
FROM counts c JOIN totals t USING (dimension)""", "profile_pairs")


def _controls() -> str:
    return ", ".join(f"({_q(i)}, {_q(s)}, {_q(c)})" for i, s, c in [('employees_duplicate_ids', 'Critique', 'Identifiants salariés en double'), ('sports_without_rh', 'Majeure', 'Lignes sport sans salarié RH'), ('rh_without_sports_row', 'Mineure', 'Salariés sans ligne sport'), ('sport_missing', 'Information', 'Salariés sans sport déclaré'), ('missing_addresses', 'Majeure', 'Adresses manquantes'), ('missing_commute', 'Majeure', 'Modes de déplacement manquants'), ('future_birth_dates', 'Critique', 'Dates de naissance dans le futur'), ('future_hire_dates', 'Majeure', "Dates d'embauche dans le futur"), ('negative_salary', 'Critique', 'Salaires négatifs')])


oracle("profile_anomalies", f"""
SELECT k.severity, k.control, CAST(p.value AS BIGINT) AS anomaly_count
FROM profile_summary p JOIN (VALUES {_controls()}) k(indicator, severity, control) USING (indicator)
WHERE p.value > 0""", "profile_summary")


# --- step by step ---------------------------------------------------------------

cte("change_batches", ["cdc_log"], """
SELECT CASE WHEN __op IN ('c', 'r') THEN CASE WHEN activity_id % 81 = 0 THEN 2 ELSE 0 END
            WHEN start_at < TIMESTAMP '2024-01-04 00:00:00' THEN 1 ELSE 2 END AS batch,
       activity_id, employee_id + CASE WHEN __op = 'u' AND activity_id % 27 = 0 THEN 1 ELSE 0 END AS employee_id,
       start_at + to_days(CASE WHEN __op = 'u' AND activity_id % 18 = 0 THEN 40 ELSE 0 END) AS start_at,
       end_at + to_days(CASE WHEN __op = 'u' AND activity_id % 18 = 0 THEN 40 ELSE 0 END) AS end_at,
       sport_type, distance_m, __op, __source_ts_ms, kafka_partition, kafka_offset
FROM cdc_log""")
# The newest version of every activity after each batch.
cte("stand", ["change_batches"], """
SELECT step, activity_id, arg_max(l, (__source_ts_ms, kafka_partition, kafka_offset)) AS v
FROM change_batches l, range(3) t(step) WHERE batch <= step GROUP BY ALL""")
cte("final_activities", ["stand"], """
SELECT activity_id, v.employee_id AS employee_id, v.start_at AS start_at, v.end_at AS end_at, v.sport_type AS sport_type,
       v.distance_m AS distance_m, v.kafka_offset AS kafka_offset
FROM stand WHERE step = 2 AND v.__op <> 'd'""")

oracle("lake_upsert", """
, turned AS (
  SELECT now.step, now.v AS new, before.v AS old FROM stand now
  LEFT JOIN stand before ON before.activity_id = now.activity_id AND before.step = now.step - 1
  WHERE before.v IS NULL OR before.v.kafka_offset <> now.v.kafka_offset),
written AS (
  SELECT day, max(step) AS version
  FROM (SELECT step, CAST(new.start_at AS DATE) AS day FROM turned
        UNION ALL SELECT step, CAST(old.start_at AS DATE) FROM turned WHERE old IS NOT NULL) GROUP BY day)
SELECT activity_id, employee_id, CAST(start_at AS DATE) AS activity_date, start_at, sport_type, distance_m, kafka_offset,
       CAST((SELECT version FROM written WHERE day = CAST(start_at AS DATE)) AS INTEGER) AS version
FROM final_activities""", "stand", "final_activities")

oracle("activity_12m_incremental", """
, lately AS (SELECT employee_id AS person, COUNT(*) AS times, SUM(distance_m) AS metres
             FROM final_activities WHERE start_at >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY 1)
SELECT employee_id, first_name, last_name, COALESCE(times, 0) AS activity_count_12m,
       CAST(COALESCE(metres, 0) AS DECIMAL(38,6)) AS distance_m_12m
FROM employees LEFT JOIN lately ON person = employee_id""", "final_activities", "employees")

_dq_final = [f"SELECT activity_id, employee_id, {_q(r)} AS rule_name, {m} AS error_message FROM final_activities WHERE {w}"
             for r, m, w in _DQ]
_dq_final.append("""
SELECT activity_id, employee_id, 'DQ04_UNKNOWN_EMPLOYEE', 'L''activité référence un employé inexistant.' FROM final_activities a
WHERE employee_id IS NULL OR NOT EXISTS (FROM customer WHERE c_custkey = a.employee_id AND c_custkey % 19 <> 0)""")
oracle("dq_incremental", "\nUNION ALL\n".join(_dq_final), "final_activities")


# --- versions, dates, snapshots, drift --------------------------------------------

oracle("silver_as_of", """
, stamps AS (SELECT * FROM (VALUES (1, TIMESTAMP '2024-01-02 00:00:00'), (2, TIMESTAMP '2024-01-10 12:00:00'),
                                   (3, TIMESTAMP '2024-01-20 00:00:00')) t(nr, stamp)),
held AS (
  SELECT nr, employee_id, CASE WHEN nr > 1 AND employee_id % 5 = 0 THEN 'Moved unit' ELSE business_unit END AS business_unit,
         CASE WHEN nr = 3 AND employee_id % 11 = 0 THEN 'Freelance' ELSE contract_type END AS contract_type
  FROM employees, stamps WHERE nr <> 2 OR employee_id % 7 <> 0),
timed AS (SELECT *, epoch_ms(__source_ts_ms) AS changed_at FROM cdc_log),
placed AS (SELECT timed.*, stamps.nr FROM timed ASOF LEFT JOIN stamps ON timed.changed_at >= stamps.stamp)
SELECT activity_id, placed.employee_id, __op, kafka_offset, changed_at, business_unit, contract_type
FROM placed LEFT JOIN held ON held.nr = placed.nr AND held.employee_id = placed.employee_id""", "employees", "cdc_log")

_SERIES_DAYS = ", ".join(f"(DATE '{d}')" for d in """
    2023-02-28 2023-03-31 2023-04-30 2023-05-31 2023-06-30 2023-07-31 2023-08-31 2023-09-30 2023-10-31 2023-11-30 2023-12-31
    2024-01-31 2024-02-29 2024-03-31 2024-04-30 2024-05-31 2024-06-30 2024-07-31 2024-08-31 2024-09-30 2024-10-31 2024-11-30
    2024-12-31 2025-01-20""".split())
oracle("eligibility_series", f"""
, series AS (SELECT * FROM (VALUES {_SERIES_DAYS}) t(as_of)),
valid AS (
  SELECT * FROM (VALUES ('rate', 0.04, DATE '2020-01-01', DATE '2023-12-31'), ('rate', 0.05, DATE '2024-01-01', NULL),
                        ('days', 4, DATE '2022-01-01', NULL), ('days', 5, DATE '2024-01-01', NULL),
                        ('least', 20, DATE '2021-01-01', DATE '2023-12-31'), ('least', 15, DATE '2025-01-24', NULL)) t(label, amount, since, till)),
limits_at AS (
  SELECT as_of, max(amount) FILTER (label = 'rate') AS rate, max(amount) FILTER (label = 'days') AS days,
         max(amount) FILTER (label = 'least') AS least
  FROM series LEFT JOIN valid ON since <= as_of AND (till IS NULL OR as_of < till) GROUP BY as_of),
done AS (
  SELECT as_of, employee_id, count(*) AS n FROM series JOIN activities ON start_at >= as_of - INTERVAL 12 MONTHS GROUP BY ALL),
judged AS (
  SELECT e.employee_id, s.as_of, first_name, last_name, annual_gross_salary, e.commute_mode, coalesce(n, 0) AS n, rate, days,
         coalesce(n, 0) >= least AS enough,
         e.commute_mode IN ('Marche/running', 'Vélo/Trottinette/Autres') AND r.validation_status = 'VALID' AS rides
  FROM employees e CROSS JOIN series s JOIN limits_at USING (as_of)
  LEFT JOIN done ON done.employee_id = e.employee_id AND done.as_of = s.as_of
  LEFT JOIN commute_requested r ON r.employee_id = e.employee_id)
SELECT employee_id, as_of, first_name, last_name, annual_gross_salary, commute_mode, n AS activity_count_12m,
       enough AS wellness_eligible, CAST(IF(enough, days, 0) AS DECIMAL(18,6)) AS wellness_days, rides AS bonus_eligible,
       CAST(IF(rides, ROUND(annual_gross_salary * CAST(rate AS DECIMAL(18,6)), 2), 0) AS DECIMAL(18,2)) AS bonus_amount
FROM judged""", "employees", "activities", "commute_requested")

cte("staff_before", ["employees", "former_employees"], """
SELECT employee_id + CASE WHEN employee_id % 8 = 0 THEN 5000000000 ELSE 0 END AS employee_id, home_address,
       CASE WHEN employee_id % 6 = 0 THEN 'Transports en commun' ELSE commute_mode END AS commute_mode FROM employees
UNION ALL FROM former_employees""")
cte("commute_before", ["staff_before", "commute_distances"], _commute_body("staff_before"))
oracle("snapshot_changes", """
, gone AS (SELECT employee_id FROM staff_before EXCEPT SELECT employee_id FROM employees)
SELECT 'employee' AS entity, CASE WHEN b.employee_id IS NULL THEN 'c' ELSE 'u' END AS __op, e.employee_id AS id,
       e.employee_id, e.commute_mode AS detail
FROM employees e LEFT JOIN staff_before b USING (employee_id)
WHERE b.employee_id IS NULL OR (b.home_address, b.commute_mode) IS DISTINCT FROM (e.home_address, e.commute_mode)
UNION ALL SELECT 'employee', 'd', employee_id, employee_id, commute_mode FROM staff_before JOIN gone USING (employee_id)
UNION ALL SELECT 'commute', 'd', employee_id, employee_id, validation_status FROM commute_before JOIN gone USING (employee_id)
UNION ALL SELECT 'activity', 'd', activity_id, employee_id, sport_type FROM activities JOIN gone USING (employee_id)""",
       "employees", "staff_before", "commute_before", "activities")

_HEART = "CASE WHEN kafka_offset % 35 = 0 THEN '\"n/a\"' WHEN kafka_offset % 7 = 0 THEN CAST(60 + kafka_offset % 90 AS VARCHAR) END"
_WEATHER = "CASE WHEN kafka_offset % 5 = 0 THEN '{\"sky\":\"clear\",\"temp\":' || kafka_offset % 30 || '}' END"
oracle("cdc_unknown_fields", f"""
SELECT kafka_partition, kafka_offset, activity_id, distance_m,
       CASE WHEN activity_id IS NOT NULL AND (kafka_offset % 7 = 0 OR kafka_offset % 5 = 0) THEN
         '{{' || concat_ws(',', '"heart_rate":' || {_HEART}, '"weather":' || {_WEATHER}) || '}}' END AS unknown_fields
FROM bronze""", "bronze")
_drift = [("heart_rate", "BIGINT", "kafka_offset % 7 = 0 AND kafka_offset % 35 <> 0"), ("heart_rate", "STRING", "kafka_offset % 35 = 0"),
          ("weather", "OBJECT", "kafka_offset % 5 = 0"), ("weather.temp", "BIGINT", "kafka_offset % 5 = 0"),
          ("weather.sky", "STRING", "kafka_offset % 5 = 0")]
oracle("cdc_drift", "\nUNION ALL\n".join(
    f"SELECT '{path}' AS path, '{kind}' AS type, count(*) AS messages, min(kafka_offset) AS first_offset, "
    f"max(kafka_offset) AS last_offset FROM bronze WHERE activity_id IS NOT NULL AND {when} HAVING count(*) > 0"
    for path, kind, when in _drift), "bronze")


# --- as streams and files -----------------------------------------------------------

oracle("streamed_silver", "SELECT * EXCLUDE (bronze_ingested_at, silver_ingested_at) FROM silver_log", "silver_log")
oracle("streamed_malformed", """
SELECT kafka_partition, kafka_offset, epoch_ms(__source_ts_ms) AS kafka_timestamp
FROM cdc_log WHERE kafka_offset % 89 = 0 OR kafka_offset % 97 = 0""", "cdc_log")
oracle("streamed_current", f"""
SELECT * EXCLUDE (silver_ingested_at) FROM (
  SELECT {_SERVING} FROM silver_log l
  WHERE __op <> 'd' AND NOT EXISTS (
    FROM silver_log later WHERE later.activity_id = l.activity_id
    AND (later.__source_ts_ms, later.kafka_partition, later.kafka_offset) > (l.__source_ts_ms, l.kafka_partition, l.kafka_offset)))""",
       "silver_log")
ORACLE["streamed_notifications"] = ORACLE["live_notifications"]
oracle("silver_log_counts", """
SELECT CAST(batch AS BIGINT) AS batch_id, count(*) AS stored, count(*) AS reported FROM change_batches GROUP BY batch""", "change_batches")
oracle("bi_export", """
SELECT activity_id AS id, CAST(activity_id AS VARCHAR) AS activity_id, CAST(employee_id AS VARCHAR) AS employee_id, last_name, sport_type,
       declared_sport, CAST(activity_date AS VARCHAR) AS activity_date, CAST(distance_km AS VARCHAR) AS distance_km, source,
       TRUE AS in_order
FROM silver_log""", "silver_log")
oracle("published_reference", """
SELECT CAST(employee_id AS BIGINT) AS employee_id, first_name, last_name, business_unit, contract_type, annual_gross_salary
FROM employees""", "employees")
