"""The registered queries once more, as plain SQL over the given tables (DuckDB dialect)."""

from __future__ import annotations


def r(expr: str, digits: int = 3) -> str:
    """Half-up rounding with the same nudge as ``functions.rounding.steady``."""
    scale = f"{10**digits}e0"
    return f"floor(({expr}) * {scale} + 0.5e0 + 1e-7) / {scale}"


_VIEWS: dict[str, tuple[list[str], str]] = {
    "machines": (
        [],
        """SELECT s_suppkey AS machine_id, s_name AS machine_name, r_name AS line, n_name AS machine_type,
                  1 + s_suppkey % 18 AS age_years,
                  CASE WHEN s_acctbal > 5000 THEN 'premium' ELSE 'standard' END AS maintenance_tier
           FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "products": (
        [],
        """SELECT p_partkey AS product_id, p_name AS product_name, CAST(10 + p_size AS DOUBLE) AS ideal_cycle_time_sec
           FROM part""",
    ),
    "runs": (
        [],
        """SELECT CAST(l_shipdate AS DATE) AS run_date, l_suppkey AS machine_id,
                  CASE WHEN l_orderkey % 25 = 0 THEN NULL ELSE l_partkey END AS product_id,
                  CASE l_linenumber % 3 WHEN 0 THEN 'morning' WHEN 1 THEN 'afternoon' ELSE 'night' END AS shift,
                  CAST(480 AS BIGINT) AS planned_production_min,
                  CAST(l_quantity AS BIGINT) * 5 AS downtime_min,
                  CASE WHEN l_orderkey % 33 = 0 THEN -1 WHEN l_orderkey % 101 = 0 THEN NULL
                       ELSE CAST(floor(l_extendedprice / 100) AS BIGINT) END AS total_units,
                  CAST(floor(l_extendedprice / 100) AS BIGINT)
                    - CAST(floor(floor(l_extendedprice / 100) * l_discount) AS BIGINT) AS good_units
           FROM lineitem""",
    ),
    "gated_runs": (
        ["runs"],
        """SELECT *, coalesce(machine_id IS NOT NULL AND product_id IS NOT NULL AND total_units > 0
                              AND good_units >= 0 AND good_units <= total_units, false) AS is_valid FROM runs""",
    ),
    "silver_runs": (["gated_runs"], "SELECT * EXCLUDE (is_valid) FROM gated_runs WHERE is_valid"),
    "run_parts": (
        ["silver_runs", "products"],
        """SELECT s.*, p.ideal_cycle_time_sec, planned_production_min - downtime_min AS run_time_min,
                  (planned_production_min - downtime_min) * 1e0 / planned_production_min AS availability,
                  least(p.ideal_cycle_time_sec * total_units / nullif((planned_production_min - downtime_min) * 60e0, 0), 1e0)
                    AS performance,
                  good_units * 1e0 / total_units AS quality, total_units - good_units AS scrap_units
           FROM silver_runs s LEFT JOIN products p ON s.product_id = p.product_id""",
    ),
    "run_oee": (["run_parts"], "SELECT *, availability * performance * quality AS oee FROM run_parts"),
    "mart": (
        ["run_oee", "machines"],
        f"""SELECT a.*, {r('total_scrap * 1e0 / total_units')} AS scrap_rate, m.machine_name, m.line, m.machine_type
            FROM (SELECT machine_id, {r('avg(availability)')} AS avg_availability, {r('avg(performance)')} AS avg_performance,
                         {r('avg(quality)')} AS avg_quality, {r('avg(oee)')} AS avg_oee,
                         CAST(sum(downtime_min) AS BIGINT) AS total_downtime_min,
                         CAST(sum(total_units) AS BIGINT) AS total_units, CAST(sum(scrap_units) AS BIGINT) AS total_scrap
                  FROM run_oee GROUP BY machine_id) a
            LEFT JOIN machines m ON a.machine_id = m.machine_id""",
    ),
    "mart_basic": (
        ["run_oee", "machines"],
        f"""SELECT a.*, m.* EXCLUDE (machine_id)
            FROM (SELECT machine_id, {r('avg(availability)')} AS availability, {r('avg(performance)')} AS performance,
                         {r('avg(quality)')} AS quality, {r('avg(oee)')} AS oee,
                         CAST(sum(downtime_min) AS BIGINT) AS total_downtime_min,
                         {r('sum(scrap_units) * 1e0 / sum(total_units)')} AS scrap_rate
                  FROM run_oee GROUP BY machine_id) a
            LEFT JOIN machines m ON a.machine_id = m.machine_id""",
    ),
    "daily": (
        ["run_oee"],
        f"""SELECT machine_id, run_date, {r('avg(oee)')} AS daily_oee, CAST(sum(downtime_min) AS BIGINT) AS downtime_min
            FROM run_oee GROUP BY machine_id, run_date""",
    ),
    "downtime": (
        [],
        """SELECT event_id, CAST(ts AS DATE) AS event_date, user_id AS machine_id,
                  CASE event_type WHEN 'error' THEN 'Breakdown' WHEN 'signup' THEN 'Changeover'
                       WHEN 'purchase' THEN 'Planned Maintenance' WHEN 'click' THEN 'Minor Stop'
                       WHEN 'view' THEN 'Reduced Speed' END AS reason,
                  CASE WHEN event_type IN ('click', 'view') THEN 'Performance' ELSE 'Availability' END AS loss_category,
                  CASE WHEN event_type IN ('signup', 'purchase') THEN 'Planned' ELSE 'Unplanned' END AS planned_type,
                  CAST(floor(value) AS BIGINT) AS duration_min
           FROM events""",
    ),
    "sensors": (
        [],
        """SELECT event_id AS reading_id, user_id AS machine_id, ts AS reading_ts,
                  20e0 + value / 10 AS temperature_c,
                  CASE WHEN event_id % 33 = 0 THEN NULL
                       ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS rotational_speed_rpm,
                  value AS torque_nm, event_id % 250 AS tool_wear_min, event_type = 'error' AS machine_failure,
                  CAST(NULL AS DOUBLE) AS vibration_mm_s
           FROM events""",
    ),
    "gated_sensors": (
        ["sensors"],
        """SELECT *, machine_id IS NOT NULL AND rotational_speed_rpm IS NOT NULL AND torque_nm IS NOT NULL AS is_valid
           FROM sensors""",
    ),
    "silver_sensors": (["gated_sensors"], "SELECT * EXCLUDE (is_valid) FROM gated_sensors WHERE is_valid"),
    "quality_raw": (
        [],
        """SELECT o_orderkey AS inspection_id, o_custkey % (SELECT count(*) FROM supplier) AS machine_id,
                  o_orderdate AS inspected_ts,
                  CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN ' fail '
                       WHEN o_orderstatus = 'O' THEN 'pass' WHEN o_orderstatus = 'P' THEN 'Unknown' END AS raw_result,
                  o_orderpriority
           FROM orders""",
    ),
    "gated_quality": (
        ["quality_raw"],
        """SELECT inspection_id, machine_id, inspected_ts, upper(trim(raw_result)) AS result,
                  CASE WHEN raw_result IS NULL OR raw_result <> 'pass' THEN o_orderpriority END AS defect_code,
                  coalesce(inspection_id IS NOT NULL AND machine_id IS NOT NULL
                           AND upper(trim(raw_result)) IN ('PASS', 'FAIL'), false) AS is_valid
           FROM quality_raw""",
    ),
    "silver_quality": (["gated_quality"], "SELECT * EXCLUDE (is_valid) FROM gated_quality WHERE is_valid"),
    "sensor_agg": (
        ["silver_sensors"],
        f"""SELECT machine_id, {r('avg(temperature_c)', 1)} AS avg_temp_c, {r('max(temperature_c)', 1)} AS max_temp_c,
                   {r('avg(tool_wear_min)', 1)} AS avg_tool_wear,
                   CAST(sum(CAST(machine_failure AS INT)) AS BIGINT) AS sensor_failures
            FROM silver_sensors GROUP BY machine_id""",
    ),
    "quality_agg": (
        ["silver_quality"],
        f"""SELECT machine_id, count(*) AS inspections, CAST(sum(CASE WHEN result = 'FAIL' THEN 1 ELSE 0 END) AS BIGINT) AS fails,
                   {r("sum(CASE WHEN result = 'FAIL' THEN 1 ELSE 0 END) * 1e0 / count(*)")} AS fail_rate
            FROM silver_quality GROUP BY machine_id""",
    ),
    "quality_agg_basic": (
        ["silver_quality"],
        f"""SELECT machine_id, {r("avg(CASE WHEN result = 'FAIL' THEN 1e0 ELSE 0e0 END)")} AS fail_rate
            FROM silver_quality GROUP BY machine_id""",
    ),
    "health_basic": (
        ["mart_basic", "sensor_agg", "quality_agg_basic"],
        """SELECT m.machine_id, machine_name, line, age_years, oee, availability, performance, quality, scrap_rate,
                  total_downtime_min, avg_temp_c, avg_tool_wear, fail_rate
           FROM mart_basic m LEFT JOIN sensor_agg s ON m.machine_id = s.machine_id
           LEFT JOIN quality_agg_basic q ON m.machine_id = q.machine_id""",
    ),
    "risk": (
        ["health_basic"],
        f"""SELECT machine_id, line, age_years, oee, fail_rate, total_downtime_min,
                   {r('0.5e0 * (1 - oee) + 0.3e0 * (age_years / 18e0) + 0.2e0 * fail_rate')} AS failure_risk
            FROM health_basic""",
    ),
    "snap0": (
        ["machines"],
        """SELECT machine_id, machine_name, line, machine_type, maintenance_tier FROM machines WHERE machine_id % 10 <> 9""",
    ),
    "snap1": (
        ["machines"],
        """SELECT machine_id, machine_name, CASE WHEN machine_id % 11 = 0 THEN line || '-X' ELSE line END AS line, machine_type,
                  CASE WHEN machine_id % 13 = 0 THEN NULL
                       WHEN machine_id % 7 = 0 THEN CASE maintenance_tier WHEN 'premium' THEN 'standard' ELSE 'premium' END
                       ELSE maintenance_tier END AS maintenance_tier
           FROM machines""",
    ),
    "known": (
        ["snap0", "snap1"],
        """SELECT u.*, t.maintenance_tier IS DISTINCT FROM u.maintenance_tier AS changed
           FROM snap1 u JOIN snap0 t ON t.machine_id = u.machine_id""",
    ),
    "scd_changes": (
        ["snap0", "snap1"],
        """SELECT i.*, c.line AS cur_line, c.maintenance_tier AS cur_maintenance_tier,
                  CASE WHEN c.machine_id IS NULL THEN 'new'
                       WHEN i.line IS DISTINCT FROM c.line OR i.maintenance_tier IS DISTINCT FROM c.maintenance_tier
                         THEN 'changed'
                       ELSE 'unchanged' END AS change
           FROM snap1 i LEFT JOIN snap0 c ON i.machine_id = c.machine_id""",
    ),
    "scd_final": (
        ["snap0", "snap1", "scd_changes"],
        """SELECT c.machine_id, c.machine_name, c.line, c.machine_type, c.maintenance_tier, DATE '2024-01-01' AS valid_from,
                  CASE WHEN s.change = 'changed' THEN DATE '2024-02-01' END AS valid_to,
                  coalesce(s.change <> 'changed', true) AS is_current
           FROM snap0 c LEFT JOIN scd_changes s ON c.machine_id = s.machine_id
           UNION ALL
           SELECT machine_id, machine_name, line, machine_type, maintenance_tier, DATE '2024-02-01', CAST(NULL AS DATE), true
           FROM scd_changes WHERE change <> 'unchanged'""",
    ),
    "learning": (
        [],
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
                  CAST(p_size AS DOUBLE) AS size, p_retailprice AS retailprice,
                  CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label
           FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "hashed": (
        ["learning"],
        """SELECT *, rank() OVER (PARTITION BY label ORDER BY md5(concat_ws('|', '42', CAST(l_orderkey AS VARCHAR),
                    CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)))) AS pos,
                  count(*) OVER (PARTITION BY label) AS n
           FROM learning""",
    ),
}


def _needed(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _needed(_VIEWS[name][0], seen)
            seen.append(name)
    return seen


def sql(views: str, body: str) -> str:
    """``body`` behind a WITH clause holding the named views and what they build on."""
    names = _needed(views.split(), [])
    if not names:
        return body
    clause = ",\n".join(f"{n} AS ({_VIEWS[n][1]})" for n in names)
    return f"WITH {clause}\n{body}"


_SEED = f"""SELECT event_id AS udi, 'L' || CAST(user_id AS VARCHAR) AS product_id,
                   CASE event_id % 3 WHEN 0 THEN 'L' WHEN 1 THEN 'M' ELSE 'H' END AS type,
                   295e0 + event_id % 10 AS air_temp_k, {r('293.15e0 + value / 10', 1)} AS process_temp_k,
                   1200 + CAST(json_extract_string(props, '$.k') AS BIGINT) AS rot_speed, value AS torque,
                   event_id % 250 AS tool_wear, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS machine_failure,
                   0 AS twf, 0 AS hdf, 0 AS pwf, 0 AS osf, 0 AS rnf
            FROM events"""

ORACLE: dict[str, str] = {
    # gates
    "q_silver_runs": sql("silver_runs", "SELECT * FROM silver_runs"),
    "q_silver_runs_basic": sql(
        "runs", "SELECT * FROM runs WHERE product_id IS NOT NULL AND total_units > 0 AND good_units <= total_units"
    ),
    "q_silver_sensors": sql("silver_sensors", "SELECT * FROM silver_sensors"),
    "q_silver_quality": sql("silver_quality", "SELECT * FROM silver_quality"),
    "q_quarantine_runs": sql("gated_runs", "SELECT * FROM gated_runs WHERE NOT is_valid"),
    "q_quarantine_sensors": sql("gated_sensors", "SELECT * FROM gated_sensors WHERE NOT is_valid"),
    "q_quarantine_quality": sql("gated_quality", "SELECT * FROM gated_quality WHERE NOT is_valid"),
    "q_load_audit": sql(
        "gated_runs gated_sensors gated_quality",
        " UNION ALL ".join(
            f"""SELECT '{name}' AS table_name, '{status}' AS status, count(*) FILTER (WHERE {test}) AS row_count
                FROM gated_{view}"""
            for name, view in (("mes_runs", "runs"), ("sensors", "sensors"), ("quality", "quality"))
            for status, test in (("valid", "is_valid"), ("quarantine", "NOT is_valid"))
        ),
    ),
    # OEE
    "q_run_oee": sql(
        "run_oee",
        f"""SELECT run_date, machine_id, product_id, shift, downtime_min, total_units, good_units, ideal_cycle_time_sec,
                   run_time_min, scrap_units, {r('availability', 6)} AS availability, {r('performance', 6)} AS performance,
                   {r('quality', 6)} AS quality, {r('oee', 6)} AS oee FROM run_oee""",
    ),
    "q_oee_by_machine": sql("mart", "SELECT * FROM mart"),
    "q_oee_by_machine_basic": sql("mart_basic", "SELECT * FROM mart_basic"),
    "q_oee_by_line": sql(
        "run_oee machines",
        f"""SELECT line, {r('avg(oee)')} AS avg_oee, CAST(sum(downtime_min) AS BIGINT) AS total_downtime_min,
                   CAST(sum(total_units) AS BIGINT) AS total_units
            FROM run_oee o LEFT JOIN machines m ON o.machine_id = m.machine_id GROUP BY line""",
    ),
    "q_daily_oee": sql("daily", "SELECT * FROM daily"),
    "q_rolling_oee": sql(
        "daily",
        f"""SELECT machine_id, run_date, daily_oee, downtime_min,
                   {r('''avg(daily_oee) OVER (PARTITION BY machine_id ORDER BY run_date
                      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)''')} AS rolling_7d_oee FROM daily""",
    ),
    "q_weekly_oee": sql(
        "daily",
        f"""SELECT CAST(year(run_date) AS INT) AS year, CAST(weekofyear(run_date) AS INT) AS week,
                   {r('avg(daily_oee)')} AS weekly_oee FROM daily GROUP BY 1, 2""",
    ),
    "q_shift_performance": sql(
        "run_oee",
        f"""SELECT shift, {r('avg(oee)')} AS oee, {r('avg(availability)')} AS availability,
                   {r('avg(performance)')} AS performance FROM run_oee GROUP BY shift""",
    ),
    "q_running_downtime": sql(
        "daily",
        """SELECT machine_id, run_date, downtime_min,
                  CAST(sum(downtime_min) OVER (PARTITION BY machine_id ORDER BY run_date
                       ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_downtime_min FROM daily""",
    ),
    "q_rank_in_line": sql(
        "mart",
        """SELECT machine_id, line, avg_oee, rank() OVER (PARTITION BY line ORDER BY avg_oee DESC) AS line_rank,
                  dense_rank() OVER (PARTITION BY line ORDER BY avg_oee DESC) AS line_dense_rank FROM mart""",
    ),
    # losses
    "q_loss_taxonomy": sql(
        "downtime",
        """SELECT loss_category, planned_type, CAST(sum(duration_min) AS BIGINT) AS total_downtime_min,
                  count(*) AS event_count FROM downtime GROUP BY 1, 2""",
    ),
    "q_downtime_by_category": sql(
        "downtime",
        """SELECT loss_category, CAST(sum(duration_min) AS BIGINT) AS total_downtime_min, count(*) AS event_count
           FROM downtime GROUP BY 1""",
    ),
    "q_downtime_pareto": sql(
        "downtime",
        f"""SELECT reason, total_min, events, {r('total_min * 1e0 / sum(total_min) OVER () * 100', 1)} AS pct_of_total,
                   {r('''sum(total_min) OVER (ORDER BY total_min DESC, reason ROWS UNBOUNDED PRECEDING) * 1e0
                      / sum(total_min) OVER () * 100''', 1)} AS cumulative_pct
            FROM (SELECT reason, CAST(sum(duration_min) AS BIGINT) AS total_min, count(*) AS events
                  FROM downtime GROUP BY reason)""",
    ),
    # health and risk
    "q_sensor_agg": sql("sensor_agg", "SELECT * FROM sensor_agg"),
    "q_quality_agg": sql("quality_agg", "SELECT * FROM quality_agg"),
    "q_quality_agg_basic": sql("quality_agg_basic", "SELECT * FROM quality_agg_basic"),
    "q_wear_by_machine": sql(
        "silver_sensors",
        f"SELECT machine_id, {r('avg(tool_wear_min)', 1)} AS avg_wear FROM silver_sensors GROUP BY machine_id",
    ),
    "q_machine_health": sql(
        "machines mart sensor_agg quality_agg",
        """SELECT m.machine_id, m.machine_name, m.line, m.machine_type, avg_oee, total_downtime_min, avg_temp_c, max_temp_c,
                  avg_tool_wear, sensor_failures, inspections, fail_rate
           FROM machines m LEFT JOIN mart o ON m.machine_id = o.machine_id
           LEFT JOIN sensor_agg s ON m.machine_id = s.machine_id LEFT JOIN quality_agg q ON m.machine_id = q.machine_id""",
    ),
    "q_machine_health_basic": sql("health_basic", "SELECT * FROM health_basic"),
    "q_kpi_correlation": sql(
        "health_basic",
        f"""SELECT {r('corr(oee, scrap_rate)')} AS oee_vs_scrap, {r('corr(oee, fail_rate)')} AS oee_vs_fail
            FROM health_basic""",
    ),
    "q_failure_risk": sql("risk", "SELECT * FROM risk"),
    "q_top_risk": sql("risk", "SELECT * FROM risk ORDER BY failure_risk DESC NULLS LAST, machine_id LIMIT 10"),
    "q_oee_vs_risk": sql("risk", "SELECT machine_id, line, oee, failure_risk FROM risk"),
    "q_overall_oee": sql("mart", f"SELECT {r('avg(avg_oee)')} AS overall_oee, count(*) AS machines FROM mart"),
    "q_dash_oee_by_line": sql(
        "mart", f"SELECT line, {r('avg(avg_oee)')} AS avg_machine_oee, count(*) AS machines FROM mart GROUP BY line"
    ),
    # history
    "q_scd2_init": sql(
        "machines",
        """SELECT machine_id, machine_name, line, machine_type, maintenance_tier, DATE '2024-01-01' AS valid_from,
                  CAST(NULL AS DATE) AS valid_to, true AS is_current FROM machines""",
    ),
    "q_scd2_classify": sql("scd_changes", "SELECT * FROM scd_changes"),
    "q_scd2_expire": sql("scd_final", "SELECT * FROM scd_final WHERE NOT is_current"),
    "q_scd2_keep": sql(
        "scd_final", "SELECT * FROM scd_final WHERE is_current AND valid_from = DATE '2024-01-01'"
    ),
    "q_scd2_apply": sql("scd_final", "SELECT * FROM scd_final"),
    "q_scd2_merge": sql(
        "snap0 known",
        """SELECT t.machine_id, t.machine_name, t.line, t.machine_type, t.maintenance_tier, DATE '2024-01-01' AS valid_from,
                  CASE WHEN k.changed OR k.machine_id % 14 = 0 THEN DATE '2024-02-01' END AS valid_to,
                  NOT coalesce(k.changed OR k.machine_id % 14 = 0, false) AS is_current
           FROM snap0 t LEFT JOIN known k ON t.machine_id = k.machine_id
           UNION ALL
           SELECT machine_id, machine_name, line, machine_type, maintenance_tier, DATE '2024-02-01',
                  CASE WHEN machine_id % 14 = 0 THEN DATE '2024-02-01' END, machine_id % 14 <> 0
           FROM known WHERE changed
           UNION ALL
           SELECT machine_id, machine_name, line, machine_type, 'gold', DATE '2024-02-01', CAST(NULL AS DATE), true
           FROM known WHERE machine_id % 14 = 0""",
    ),
    "q_scd2_as_of": sql(
        "scd_final downtime",
        """SELECT line, maintenance_tier, CAST(sum(duration_min) AS BIGINT) AS downtime_min, count(*) AS events
           FROM (SELECT machine_id, duration_min, event_date + 16 AS day FROM downtime) e
           LEFT JOIN scd_final d ON e.machine_id = d.machine_id AND d.valid_from <= e.day
                AND (d.valid_to IS NULL OR e.day < d.valid_to)
           GROUP BY line, maintenance_tier""",
    ),
    "q_fact_upsert": """SELECT o_orderkey, o_custkey,
                               CASE WHEN changed THEN 'C' WHEN o_orderkey % 2 = 0 THEN 'L' ELSE o_orderstatus END AS o_orderstatus,
                               CAST(CASE WHEN changed THEN 3 WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS INT) AS revision,
                               CAST(CASE WHEN o_orderkey % 17 <> 0
                                         THEN year(o_orderdate) + CASE WHEN changed AND o_orderkey % 5 = 0 THEN 1 ELSE 0 END END AS INT) AS o_year
                        FROM (SELECT *, o_orderkey % 3 = 0 OR o_orderkey % 10 = 9 AS changed FROM orders)""",
    "q_scd2_backdated": sql(
        "snap0 snap1",
        """SELECT machine_id, machine_name, line, machine_type, maintenance_tier, day AS valid_from, valid_to, valid_to IS NULL AS is_current
           FROM (SELECT *, lead(day) OVER (PARTITION BY machine_id ORDER BY day) AS valid_to
                 FROM (SELECT *, row_number() OVER w AS place, lag(line) OVER w AS old_line, lag(maintenance_tier) OVER w AS old_tier
                       FROM (SELECT *, DATE '2024-01-01' AS day FROM snap0 UNION ALL SELECT *, DATE '2024-02-01' FROM snap1
                             UNION ALL SELECT *, DATE '2024-03-01' FROM snap0
                             UNION ALL SELECT machine_id, machine_name, line, machine_type, CASE WHEN machine_id % 6 = 0 THEN 'gold' ELSE maintenance_tier END,
                                              DATE '2024-04-01' FROM snap1 WHERE machine_id % 3 = 0)
                       WINDOW w AS (PARTITION BY machine_id ORDER BY day))
                 WHERE place = 1 OR line IS DISTINCT FROM old_line OR maintenance_tier IS DISTINCT FROM old_tier)""",
    ),
    "q_scd2_as_of_many": """SELECT f.machine_id, s.status, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, count(*) AS items
                            FROM (SELECT l_suppkey % 6 AS machine_id, CAST(l_shipdate AS DATE) AS day, l_quantity FROM lineitem) f
                            ASOF LEFT JOIN (SELECT o_custkey % 5 AS machine_id, CAST(o_orderdate AS DATE) AS day, arg_min(o_orderpriority, o_orderkey) AS status
                                            FROM orders GROUP BY ALL) s ON f.machine_id = s.machine_id AND f.day >= s.day
                            GROUP BY ALL""",
    "q_stream_gate": sql(
        "runs",
        """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(CAST(l_shipdate AS DATE), '%Y%m%d'), CAST(round(l_extendedprice * 100) AS BIGINT)) AS run_id, l_orderkey AS number, g.*
           FROM (SELECT *, CAST(l_shipdate AS DATE) AS run_date FROM lineitem) i, LATERAL (
               SELECT i.run_date, l_suppkey AS machine_id, CASE WHEN l_orderkey % 25 = 0 THEN NULL ELSE l_partkey END AS product_id,
                      CASE l_linenumber % 3 WHEN 0 THEN 'morning' WHEN 1 THEN 'afternoon' ELSE 'night' END AS shift,
                      CAST(480 AS BIGINT) AS planned_production_min, CAST(l_quantity AS BIGINT) * 5 AS downtime_min,
                      CASE WHEN l_orderkey % 33 = 0 THEN -1 WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(floor(l_extendedprice / 100) AS BIGINT) END AS total_units,
                      CAST(floor(l_extendedprice / 100) AS BIGINT) - CAST(floor(floor(l_extendedprice / 100) * l_discount) AS BIGINT) AS good_units,
                      coalesce(l_suppkey IS NOT NULL AND l_orderkey % 25 <> 0 AND l_partkey IS NOT NULL AND total_units > 0 AND good_units >= 0
                               AND good_units <= total_units, false) AS is_valid) g""",
    ),
    "q_stream_gate_audit": """SELECT CAST(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS batch, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS quarantine
        FROM (SELECT l_orderkey, coalesce(l_suppkey IS NOT NULL AND l_orderkey % 25 <> 0 AND l_partkey IS NOT NULL AND total > 0 AND good >= 0 AND good <= total, false) AS ok
              FROM (SELECT *, CASE WHEN l_orderkey % 33 = 0 THEN -1 WHEN l_orderkey % 101 = 0 THEN NULL ELSE floor(l_extendedprice / 100) END AS total,
                           floor(l_extendedprice / 100) - floor(floor(l_extendedprice / 100) * l_discount) AS good FROM lineitem))
        GROUP BY 1""",
    "q_gold_incremental": sql(
        "products machines",
        f"""SELECT * FROM (WITH final AS (
                SELECT CASE WHEN l_orderkey % 14 = 0 THEN CAST(l_shipdate AS DATE) + 40 ELSE CAST(l_shipdate AS DATE) END AS run_date,
                       l_suppkey AS machine_id, CASE WHEN l_orderkey % 25 = 0 THEN NULL ELSE l_partkey END AS product_id,
                       CASE l_linenumber % 3 WHEN 0 THEN 'morning' WHEN 1 THEN 'afternoon' ELSE 'night' END AS shift,
                       CAST(l_quantity AS BIGINT) * 5 + CASE WHEN l_orderkey % 7 = 0 THEN 15 ELSE 0 END AS downtime_min,
                       CASE WHEN l_orderkey % 33 = 0 THEN -1 WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(floor(l_extendedprice / 100) AS BIGINT) END AS total_units,
                       CAST(floor(l_extendedprice / 100) AS BIGINT) - CAST(floor(floor(l_extendedprice / 100) * l_discount) AS BIGINT) AS good_units
                FROM lineitem
            ), parts AS (
                SELECT f.*, (480 - downtime_min) / 480e0 AS availability, good_units * 1e0 / total_units AS quality,
                       least(p.ideal_cycle_time_sec * total_units / nullif((480 - downtime_min) * 60e0, 0), 1e0) AS performance, total_units - good_units AS scrap
                FROM final f LEFT JOIN products p USING (product_id)
                WHERE machine_id IS NOT NULL AND product_id IS NOT NULL AND total_units > 0 AND good_units >= 0 AND good_units <= total_units
            ), oee AS (
                SELECT p.*, m.line, availability * performance * quality AS oee FROM parts p LEFT JOIN machines m USING (machine_id)
            )
            SELECT 'machine' AS mart, machine_id, CAST(NULL AS DATE) AS run_date, any_value(line) AS line, CAST(NULL AS VARCHAR) AS shift, {r('avg(oee)')} AS oee,
                   {r('avg(availability)')} AS avg_availability, CAST(sum(downtime_min) AS BIGINT) AS downtime_min, {r('sum(scrap) * 1e0 / sum(total_units)')} AS scrap_rate
            FROM oee GROUP BY machine_id
            UNION ALL SELECT 'line', NULL, NULL, line, NULL, {r('avg(oee)')}, NULL, CAST(sum(downtime_min) AS BIGINT), NULL FROM oee GROUP BY line
            UNION ALL SELECT 'day', machine_id, run_date, NULL, NULL, {r('avg(oee)')}, NULL, CAST(sum(downtime_min) AS BIGINT), NULL FROM oee GROUP BY machine_id, run_date
            UNION ALL SELECT 'shift', NULL, NULL, NULL, shift, {r('avg(oee)')}, {r('avg(availability)')}, NULL, NULL FROM oee GROUP BY shift)""",
    ),
    # files, catalog, streams
    "q_bronze_json_roundtrip": sql("runs", "SELECT * FROM runs"),
    "q_bronze_drift": """SELECT CASE WHEN event_id % 7 <> 0 THEN event_id END AS event_id,
                                CASE WHEN event_id % 7 = 0 THEN NULL WHEN event_id % 5 = 0 THEN 1.5e0
                                     WHEN event_id % 3 = 0 THEN NULL ELSE 2.5e0 END AS value,
                                CASE WHEN event_id % 7 <> 0 AND event_id % 5 = 0 THEN 'op' || (event_id % 3) END AS operator,
                                CASE WHEN event_id % 7 = 0 THEN 'broken line ' || event_id
                                     WHEN event_id % 5 <> 0 AND event_id % 3 = 0
                                     THEN '{"event_id": ' || event_id || ', "value": "12a"}' END AS kept_line
                         FROM events""",
    "q_bronze_promotion": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'op' || (event_id % 3) ELSE CAST(event_id % 4 AS VARCHAR) END AS operator,
                                    CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 50 AS DOUBLE) WHEN event_id % 5 = 0 THEN 1.5e0 END AS speed,
                                    CASE WHEN event_id % 2 = 0 THEN '00' || (event_id % 5) END AS code, true AS ok,
                                    CAST(event_id % 2 AS BIGINT) AS "left" FROM events""",
    "q_gate_halves": sql(
        "runs",
        """SELECT *, coalesce(machine_id IS NOT NULL AND product_id IS NOT NULL AND total_units > 0 AND good_units >= 0
                              AND good_units <= total_units, false) AS is_valid FROM runs""",
    ),
    "q_bronze_lineage": """SELECT count(*) AS row_count, count(*) AS with_time, count(*) AS with_file,
                                  count(DISTINCT user_id) AS machines FROM events""",
    "q_csv_seed_scan": _SEED,
    "q_seed_to_telemetry": f"""SELECT udi AS machine_id, 'ai4i-seed' AS source,
                                      {r('process_temp_k - 273.15e0', 1)} AS temperature_c, rot_speed AS rotational_speed_rpm,
                                      {r('torque', 1)} AS torque_nm, tool_wear AS tool_wear_min,
                                      machine_failure = 1 AS machine_failure
                               FROM ({_SEED})""",
    "q_catalog_roundtrip": sql("mart", "SELECT machine_id, line, avg_oee, total_downtime_min FROM mart"),
    "q_stream_bronze": """SELECT event_id, user_id AS machine_id, event_type, value FROM events""",
    "q_stream_upsert": """SELECT o_orderkey,
                                 CASE WHEN o_orderkey % 4 = 0 THEN 'C' WHEN o_orderkey % 6 = 0 THEN 'L' ELSE o_orderstatus END AS o_orderstatus,
                                 CAST(CASE WHEN o_orderkey % 4 = 0 THEN 3 WHEN o_orderkey % 6 = 0 THEN 2 ELSE 1 END AS BIGINT) AS revision,
                                 CAST(year(o_orderdate) AS INT) AS o_year FROM orders""",
    # percent ranks
    "q_wear_percent_rank": f"""SELECT event_id AS udi, event_id % 250 AS tool_wear,
                                      {r('percent_rank() OVER (ORDER BY event_id % 250)', 6)} AS wear_pct FROM events""",
    # scalar functions
    "q_fn_string": """SELECT o_orderkey, upper(trim('  ' || lower(o_orderpriority) || ' ')) AS code,
                             'M' || CASE WHEN length(CAST(o_custkey % 50 + 1 AS VARCHAR)) >= 2
                                         THEN CAST(o_custkey % 50 + 1 AS VARCHAR)
                                         ELSE lpad(CAST(o_custkey % 50 + 1 AS VARCHAR), 2, '0') END AS machine_label
                      FROM orders""",
    "q_fn_datetime": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
                               CAST(o_orderdate AS DATE) - CAST(o_orderkey % 90 AS INT) AS earlier,
                               CAST(year(o_orderdate) AS INT) AS year, CAST(weekofyear(o_orderdate) AS INT) AS week,
                               CAST(o_orderdate AS DATE) AS parsed_day,
                               CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS parsed_or_null,
                               CAST(o_orderkey % 9 AS INT) AS days_back
                        FROM orders""",
    "q_fn_math": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {r('l_extendedprice / 7', 1)} AS round1,
                            {r('l_tax * l_discount')} AS round3, CAST(floor(l_extendedprice / 100) AS BIGINT) AS floored,
                            abs(l_quantity - 25) AS distance, least(l_quantity / 10, 1e0) AS capped,
                            least(CASE WHEN l_orderkey % 2 = 0 THEN l_quantity / 10 END, 1e0) AS capped_null,
                            {r('1 - l_discount', 2)} AS complement, {r('l_quantity + 300 - 273.15e0', 2)} AS celsius
                     FROM lineitem""",
    "q_fn_conditional": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                  CASE WHEN l_returnflag = 'R' THEN 'returned' WHEN l_linestatus = 'O' THEN 'open'
                                       ELSE 'closed' END AS state,
                                  CASE WHEN l_quantity > 40 THEN 1 ELSE CASE WHEN l_tax < 0.02e0 THEN 1 ELSE 0 END END AS keep,
                                  l_returnflag IN ('A', 'N') AND NOT (l_linenumber <> 1) AS first_kept,
                                  coalesce(CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_tax <= 0.05e0 END, false) AS gate,
                                  CAST(NULL AS DATE) AS no_date, CAST(l_linenumber AS VARCHAR) AS line_text,
                                  CAST(l_returnflag = 'R' AS INT) AS flag_int
                           FROM lineitem""",
    # learning
    "q_class_balance": sql(
        "learning",
        f"""SELECT count(*) AS row_count, CAST(sum(label) AS BIGINT) AS positives, {r('avg(label)', 6)} AS positive_rate
            FROM learning""",
    ),
    "q_duplicate_audit": sql(
        "learning",
        """SELECT CAST(sum(c) AS BIGINT) AS total_rows, count(*) AS unique_rows
           FROM (SELECT count(*) AS c FROM learning GROUP BY quantity, discount, tax, size, label)""",
    ),
    "q_class_weights": sql(
        "learning",
        f"""SELECT label, count(*) AS row_count, {r('''(SELECT count(*) FROM learning) / (2e0 * count(*))''', 6)} AS weight
            FROM learning GROUP BY label""",
    ),
    "q_stratified_split": sql(
        "hashed",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label,
                  CASE WHEN pos > n * 3 // 4 THEN 1 ELSE 0 END AS part FROM hashed""",
    ),
    "q_cv_folds": sql(
        "hashed",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label,
                  CASE WHEN pos > n // 5 THEN 1 ELSE 0 END + CASE WHEN pos > n * 2 // 5 THEN 1 ELSE 0 END
                  + CASE WHEN pos > n * 3 // 5 THEN 1 ELSE 0 END + CASE WHEN pos > n * 4 // 5 THEN 1 ELSE 0 END AS fold
           FROM hashed""",
    ),
    "q_permutation_importance": sql(
        "learning",
        f"""SELECT feature, {r('auc', 6)} AS auc, {r('whole - auc', 6)} AS auc_drop
            FROM (WITH placed AS (
                      SELECT *, row_number() OVER (ORDER BY md5('42|' || l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey), quantity, size, tax) - 1 AS place,
                             count(*) OVER () AS n FROM learning
                  ), dealt AS (
                      SELECT a.label, a.quantity, a.size, b.quantity AS other_quantity, b.size AS other_size
                      FROM placed a JOIN placed b ON b.place = (a.place + 1) % a.n
                  ), scored AS (
                      SELECT 'whole' AS feature, label, quantity + size AS score FROM dealt UNION ALL SELECT 'tax', label, quantity + size FROM dealt
                      UNION ALL SELECT 'quantity', label, other_quantity + size FROM dealt UNION ALL SELECT 'size', label, quantity + other_size FROM dealt
                  ), ranked AS (
                      SELECT feature, label, rank() OVER (PARTITION BY feature ORDER BY score) + (count(*) OVER (PARTITION BY feature, score) - 1) / 2e0 AS place FROM scored
                  ), aucs AS (
                      SELECT feature, (sum(CASE WHEN label = 1 THEN place END) - sum(label) * (sum(label) + 1e0) / 2) / (sum(label) * 1e0 * sum(1 - label)) AS auc FROM ranked GROUP BY feature
                  )
                  SELECT a.feature, a.auc, w.auc AS whole FROM aucs a JOIN aucs w ON w.feature = 'whole' WHERE a.feature <> 'whole')""",
    ),
    "q_ml_prediction_checks": sql(
        "hashed",
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, true AS is_share, true AS is_likelier
           FROM hashed WHERE pos > n * 3 // 4""",
    ),
    "q_ml_importance_checks": """SELECT 'discount,quantity,retailprice,size,tax' AS features, 1e0 AS total,
                                 CAST(3 AS BIGINT) AS in_top, true AS top_is_largest""",
    "q_ml_metric_checks": """SELECT 'predictive_maintenance_rf' AS run_name, metric, true AS fits
                       FROM (VALUES ('test_auc'), ('precision'), ('recall'), ('f1'), ('cv_auc_mean'), ('cv_auc_std'), ('predictions_vary')) t(metric)""",
    "q_confusion_metrics": sql(
        "learning",
        f"""SELECT tp, fp, fn, tn, {r('tp * 1e0 / nullif(tp + fp, 0)', 6)} AS "precision",
                   {r('tp * 1e0 / nullif(tp + fn, 0)', 6)} AS recall, {r('2e0 * tp / nullif(2 * tp + fp + fn, 0)', 6)} AS f1
            FROM (SELECT count(*) FILTER (WHERE label = 1 AND quantity + size > 50) AS tp,
                         count(*) FILTER (WHERE label = 0 AND quantity + size > 50) AS fp,
                         count(*) FILTER (WHERE label = 1 AND quantity + size <= 50) AS fn,
                         count(*) FILTER (WHERE label = 0 AND quantity + size <= 50) AS tn FROM learning)""",
    ),
    "q_auc": sql(
        "learning",
        f"""SELECT {r('sum(CASE WHEN label = 1 THEN avg_rank END) / (p * nn) - (p + 1e0) / (2 * nn)', 6)} AS auc
            FROM (SELECT label, CAST(sum(label) OVER () AS DOUBLE) AS p, CAST(sum(1 - label) OVER () AS DOUBLE) AS nn,
                         rank() OVER (ORDER BY quantity + size) + (count(*) OVER (PARTITION BY quantity + size) - 1) / 2e0
                           AS avg_rank
                  FROM learning) GROUP BY p, nn""",
    ),
}
