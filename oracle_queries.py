"""Independent ANSI-SQL (DuckDB dialect) twins of the registered queries.

Each string runs against the pre-registered views ``region nation customer
supplier part orders lineitem ...``.  The flight-role mapping is restated in
SQL by :func:`mart` (see ``contrail/plans/mart.py`` for the table).  Rounding
goes through DECIMAL(38,10) so both engines round half-up identically;
integer outputs are BIGINT, measures DOUBLE.
"""

from __future__ import annotations


def R(e: str, n: int = 2) -> str:
    return f"CAST(ROUND(CAST(({e}) AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def ESUM(e: str, scale: int = 10) -> str:
    return f"CAST(SUM(CAST(({e}) AS DECIMAL(28,{scale}))) AS DOUBLE)"


def CNT(cond: str) -> str:
    return f"CAST(SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


_FLIGHTS = """
SELECT l.l_orderkey AS order_id, l.l_partkey AS tail_id, l.l_suppkey AS airline_id,
       o.o_custkey AS cust_id,
       CAST(l.l_suppkey AS VARCHAR) || '_' || strftime(CAST(o.o_orderdate AS DATE), '%Y%m%d') || '_'
         || CAST(l.l_partkey AS VARCHAR) || '_' || CAST(l.l_orderkey AS VARCHAR) || '_'
         || strftime(CAST(l.l_shipdate AS DATE), '%Y%m%d') || '_' || CAST(l.l_linenumber AS VARCHAR) AS flight_id,
       CAST(o.o_orderdate AS DATE) AS flight_date,
       CAST(year(o.o_orderdate) AS BIGINT) AS year, CAST(quarter(o.o_orderdate) AS BIGINT) AS quarter,
       CAST(month(o.o_orderdate) AS BIGINT) AS month, CAST(day(o.o_orderdate) AS BIGINT) AS day_of_month,
       CAST(isodow(o.o_orderdate) AS BIGINT) AS day_of_week,
       CAST(datediff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS BIGINT) AS dep_delay,
       l.l_quantity, l.l_discount, l.l_tax, l.l_extendedprice, l.l_linenumber, l.l_returnflag,
       o.o_orderstatus
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

_FACT = f"""
fb AS ({_FLIGHTS}),
f0 AS (
SELECT order_id, tail_id, airline_id, cust_id, flight_id, flight_date, year, quarter, month,
       day_of_month, day_of_week, dep_delay,
       greatest(dep_delay, 0) AS dep_delay_minutes,
       CAST(dep_delay >= 15 AS BIGINT) AS dep_del15,
       dep_delay - (CAST(l_quantity AS BIGINT) - 25) AS arr_delay,
       greatest(dep_delay - (CAST(l_quantity AS BIGINT) - 25), 0) AS arr_delay_minutes,
       CAST(dep_delay - (CAST(l_quantity AS BIGINT) - 25) >= 15 AS BIGINT) AS arr_del15,
       l_returnflag = 'R' AS cancelled, o_orderstatus = 'P' AS diverted,
       CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE WHEN l_discount = 0 THEN NULL
            ELSE l_quantity END AS fuel_burn,
       CASE WHEN l_returnflag = 'R' THEN 0.0::DOUBLE WHEN l_tax = 0 THEN NULL
            ELSE l_quantity * 3.16::DOUBLE END AS co2,
       l_extendedprice AS distance,
       CAST(floor(l_extendedprice / 10000) AS BIGINT) AS distance_group,
       l_extendedprice / 500 AS crs_elapsed,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) / 500 + (l_linenumber - 3) * 10 AS actual_elapsed,
       CAST(l_quantity AS BIGINT) AS taxi_out, CAST(l_linenumber AS BIGINT) AS taxi_in
FROM fb)"""

_AIRLINES = """
SELECT s.s_suppkey AS airline_id, s.s_name AS airline_name, CAST(s.s_suppkey AS VARCHAR) AS airline_code,
       sn.n_nationkey AS network_id, sn.n_name AS network_name, sr.r_name AS alliance_name,
       sn.n_nationkey AS origin_airport_id, sn.n_name AS origin_airport, sr.r_name AS origin_state,
       sr.r_name AS origin_continent
FROM supplier s JOIN nation sn ON s.s_nationkey = sn.n_nationkey
JOIN region sr ON sn.n_regionkey = sr.r_regionkey"""

_DEST = """
SELECT c.c_custkey AS cust_id, cn.n_nationkey AS dest_airport_id, cn.n_name AS dest_airport,
       cr.r_name AS dest_state, cr.r_name AS dest_continent
FROM customer c JOIN nation cn ON c.c_nationkey = cn.n_nationkey
JOIN region cr ON cn.n_regionkey = cr.r_regionkey"""

_MODELS = """
SELECT p_partkey AS model_id, p_brand AS maker, p_name AS model_name, p_type AS engine_type,
       CAST(p_size AS BIGINT) AS engines, p_retailprice AS mtow FROM part"""

_AIRPORTS = """
SELECT n.n_nationkey AS airport_id, n.n_name AS airport, r.r_name AS state, r.r_name AS continent
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""


def mart(*chains: str) -> str:
    """``WITH ..., f AS (...)`` : the flight fact with the requested chains."""
    parts = [_FACT]
    sel, joins = ["f0.*"], []
    if "airline" in chains:
        parts.append(f"al AS ({_AIRLINES})")
        sel.append("al.* EXCLUDE (airline_id)")
        joins.append("JOIN al ON f0.airline_id = al.airline_id")
    if "dest" in chains:
        parts.append(f"de AS ({_DEST})")
        sel.append("de.* EXCLUDE (cust_id)")
        joins.append("JOIN de ON f0.cust_id = de.cust_id")
    if "model" in chains:
        parts.append(f"mo AS ({_MODELS})")
        sel.append("mo.*")
        joins.append("JOIN mo ON f0.tail_id = mo.model_id")
    parts.append(f"f AS (SELECT {', '.join(sel)} FROM f0 {' '.join(joins)})")
    return "WITH " + ",\n".join(parts)


# ------------------------------------------------------------------ reports
def _per_airline(extra: str = "", where: str = "TRUE") -> str:
    return (f"c AS (SELECT airline_id, airline_name, airline_code, COUNT(*) AS total_flights{extra} "
            f"FROM f WHERE {where} GROUP BY airline_id, airline_name, airline_code)")


def reports() -> dict[str, str]:
    q: dict[str, str] = {}
    q["k01_heavy_models"] = f"""
WITH mo AS ({_MODELS}), a AS (SELECT AVG(mtow) AS av FROM mo)
SELECT model_id, maker, engines, mtow, {R('av', 4)} AS fleet_avg_mtow
FROM mo CROSS JOIN a WHERE engines > 2 AND mtow > av"""
    q["k02_missing_fuel"] = f"""{mart('airline')}
SELECT flight_id, airline_name, fuel_burn, co2 FROM f
WHERE NOT cancelled AND NOT diverted AND (fuel_burn IS NULL OR co2 IS NULL)"""
    q["k02_missing_fuel_counts"] = f"""{mart('airline')}
SELECT COUNT(*) AS incomplete_flights, {CNT('fuel_burn IS NULL')} AS missing_fuel,
       {CNT('co2 IS NULL')} AS missing_co2 FROM f
WHERE NOT cancelled AND NOT diverted AND (fuel_burn IS NULL OR co2 IS NULL)"""
    q["k03_airline_size_class"] = f"""{mart('airline')}, {_per_airline()},
a AS (SELECT *, AVG(total_flights) OVER () AS av FROM c)
SELECT airline_name, total_flights, {R('av', 2)} AS avg_flights,
  CASE WHEN total_flights BETWEEN av * 0.80 AND av * 1.20 THEN 'Medium operator'
       WHEN total_flights > av * 1.20 THEN 'Large operator' ELSE 'Small operator' END AS size_class
FROM a"""
    q["k04_top_airlines"] = f"""{mart('airline')}, {_per_airline(', COUNT(DISTINCT tail_id) AS aircraft_used')},
w AS (SELECT *, CAST(RANK() OVER (ORDER BY total_flights DESC) AS BIGINT) AS ranking,
             CAST(total_flights AS DOUBLE) * 100.0 / SUM(total_flights) OVER () AS sh FROM c)
SELECT ranking, airline_name, total_flights, aircraft_used, {R('sh', 2)} AS share_pct,
  CASE WHEN sh >= 20 THEN 'High share' WHEN sh >= 10 THEN 'Medium share' ELSE 'Low share' END AS share_level
FROM w ORDER BY total_flights DESC, airline_name LIMIT 3"""
    q["k05_models_without_aircraft"] = f"""
SELECT p_brand AS maker, COUNT(*) AS unused_models FROM part p
WHERE NOT EXISTS (SELECT 1 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  WHERE l.l_partkey = p.p_partkey)
GROUP BY p_brand"""
    q["k06_codeshare"] = f"""{mart('airline', 'dest')},
c AS (SELECT airline_name, airline_code, network_name, network_id, COUNT(*) AS total_flights,
             {CNT('origin_airport_id <> dest_airport_id')} AS codeshare_flights
      FROM f GROUP BY airline_name, airline_code, network_name, network_id),
w AS (SELECT *, AVG(codeshare_flights) OVER () AS av, SUM(codeshare_flights) OVER () AS tot FROM c)
SELECT airline_name, airline_code, network_name, network_id, total_flights, codeshare_flights,
  total_flights - codeshare_flights AS own_flights,
  CAST(RANK() OVER (ORDER BY codeshare_flights DESC) AS BIGINT) AS codeshare_rank,
  {R('av', 4)} AS avg_codeshare, {R('codeshare_flights - av', 4)} AS diff_vs_avg,
  {R('CAST(codeshare_flights AS DOUBLE) * 100.0 / tot', 2)} AS network_share_pct,
  CASE WHEN CAST(codeshare_flights AS DOUBLE) * 100.0 / total_flights > 50 THEN 'High code-share dependency'
       WHEN CAST(codeshare_flights AS DOUBLE) * 100.0 / total_flights > 20 THEN 'Moderate dependency'
       ELSE 'Own operation' END AS codeshare_category
FROM w"""
    q["k07_state_connectivity"] = f"""{mart('airline', 'dest')},
c AS (SELECT origin_state, COUNT(DISTINCT flight_id) AS total_flights,
             COUNT(DISTINCT origin_airport_id) AS origin_airports,
             COUNT(DISTINCT dest_airport_id) AS dest_airports,
             COUNT(DISTINCT origin_airport_id) AS connected_cities
      FROM f GROUP BY origin_state),
w AS (SELECT *, AVG(total_flights) OVER () AS av, SUM(total_flights) OVER () AS tot FROM c)
SELECT origin_state, total_flights, origin_airports, dest_airports, connected_cities,
  CAST(RANK() OVER (ORDER BY total_flights DESC) AS BIGINT) AS ranking,
  {R('av', 4)} AS system_avg, {R('total_flights - av', 4)} AS diff_vs_avg,
  {R('CAST(total_flights AS DOUBLE) * 100.0 / tot', 2)} AS share_pct,
  CASE WHEN total_flights > av * 1.5 THEN 'National hub' WHEN total_flights > av THEN 'Relevant node'
       ELSE 'Basic connectivity' END AS connectivity
FROM w"""
    q["k08_airline_quarter_matrix"] = f"""{mart('airline')},
v AS (SELECT airline_id, airline_name, airline_code, quarter, COUNT(*) AS n FROM f
      GROUP BY airline_id, airline_name, airline_code, quarter),
c AS (SELECT airline_id, airline_name, airline_code, CAST(SUM(n) AS BIGINT) AS total_flights,
             CAST(COALESCE(SUM(CASE WHEN quarter = 1 THEN n END), 0) AS BIGINT) AS q1,
             CAST(COALESCE(SUM(CASE WHEN quarter = 2 THEN n END), 0) AS BIGINT) AS q2,
             CAST(COALESCE(SUM(CASE WHEN quarter = 3 THEN n END), 0) AS BIGINT) AS q3,
             CAST(COALESCE(SUM(CASE WHEN quarter = 4 THEN n END), 0) AS BIGINT) AS q4
      FROM v GROUP BY airline_id, airline_name, airline_code),
w AS (SELECT *, AVG(total_flights) OVER () AS av, SUM(total_flights) OVER () AS tot FROM c)
SELECT airline_name, airline_code, q1, q2, q3, q4, total_flights,
  CAST(RANK() OVER (ORDER BY total_flights DESC) AS BIGINT) AS ranking,
  {R('av', 4)} AS market_avg, {R('total_flights - av', 4)} AS diff_vs_avg,
  {R('CAST(total_flights AS DOUBLE) * 100.0 / tot', 2)} AS share_pct,
  CASE WHEN q1 = 0 OR q2 = 0 OR q3 = 0 OR q4 = 0 THEN 'Inactive in some quarter'
       ELSE 'Active all year' END AS operating_status,
  CASE WHEN total_flights > av * 1.5 THEN 'Leader' WHEN total_flights > av THEN 'Strong competitor'
       ELSE 'Minor share' END AS category
FROM w"""
    q["k09_continent_coverage"] = f"""{mart('airline', 'dest')}, ap AS ({_AIRPORTS}),
t AS (SELECT continent, COUNT(DISTINCT airport_id) AS total_airports FROM ap GROUP BY continent),
u AS (SELECT continent, COUNT(DISTINCT airport_id) AS active_airports FROM ap
      WHERE airport_id IN (SELECT origin_airport_id FROM f UNION SELECT dest_airport_id FROM f)
      GROUP BY continent)
SELECT t.continent, total_airports, active_airports,
  total_airports - active_airports AS airports_without_flights,
  {R('CAST(active_airports AS DOUBLE) * 100.0 / total_airports', 2)} AS coverage_pct,
  CASE WHEN total_airports = active_airports THEN 'Full coverage'
       WHEN CAST(active_airports AS DOUBLE) / total_airports >= 0.8 THEN 'High coverage'
       ELSE 'Partial coverage' END AS coverage_state
FROM t JOIN u ON t.continent = u.continent"""
    q["k10_model_environment"] = f"""{mart('model')},
c AS (SELECT model_id, maker, model_name, engine_type, COUNT(*) AS total_flights,
             AVG(distance) AS dist, AVG(fuel_burn) AS fuel, AVG(co2) AS co2a,
             {ESUM('fuel_burn')} AS fuel_tot, {ESUM('co2')} AS co2_tot
      FROM f WHERE fuel_burn IS NOT NULL AND co2 IS NOT NULL
      GROUP BY model_id, maker, model_name, engine_type),
r AS (SELECT *, {R('co2a', 6)} AS co2r FROM c),
w AS (SELECT *, AVG(co2r) OVER () AS sa FROM r)
SELECT model_id, maker, model_name, engine_type, total_flights,
  {R('dist', 0)} AS avg_distance, {R('fuel', 2)} AS avg_fuel_lbs, {R('co2a', 2)} AS avg_co2_lbs,
  {R('sa', 2)} AS system_avg_co2, {R('co2r - sa', 2)} AS diff_vs_system,
  {R('fuel_tot', 0)} AS total_fuel_lbs, {R('co2_tot', 0)} AS total_co2_lbs,
  CAST(RANK() OVER (ORDER BY co2r DESC) AS BIGINT) AS impact_rank,
  CASE WHEN co2r > sa * 1.5 THEN 'High impact' WHEN co2r > sa * 1.0 THEN 'Above average'
       WHEN co2r > sa * 0.5 THEN 'Efficient' ELSE 'Very efficient' END AS env_category
FROM w"""
    dev = "actual_elapsed - crs_elapsed"
    q["k11_schedule_deviation"] = f"""{mart('airline')},
{_per_airline(f", {R('AVG(crs_elapsed)', 2)} AS avg_scheduled_min, {R('AVG(actual_elapsed)', 2)} AS avg_actual_min, {R(f'AVG({dev})', 2)} AS avg_deviation_min, {R(f'AVG(abs({dev}))', 2)} AS avg_abs_deviation_min",
              'NOT cancelled AND actual_elapsed IS NOT NULL AND crs_elapsed IS NOT NULL')}
SELECT CAST(RANK() OVER (ORDER BY avg_deviation_min DESC) AS BIGINT) AS deviation_rank,
  airline_name, airline_code, total_flights, avg_scheduled_min, avg_actual_min, avg_deviation_min,
  avg_abs_deviation_min,
  CASE WHEN avg_deviation_min < 0 THEN 'Early' WHEN avg_deviation_min BETWEEN 0 AND 5 THEN 'On time'
       WHEN avg_deviation_min BETWEEN 5 AND 15 THEN 'Moderate delay' ELSE 'Chronic delay' END AS punctuality
FROM c"""
    q["k12_long_taxi_out"] = f"""{mart('airline', 'dest')},
d AS (SELECT * FROM f WHERE NOT cancelled AND taxi_out > 30 AND actual_elapsed IS NOT NULL
      AND crs_elapsed IS NOT NULL AND actual_elapsed > crs_elapsed),
w AS (SELECT *, AVG(CAST(taxi_out AS DOUBLE)) OVER () AS avt, actual_elapsed - crs_elapsed AS ex FROM d)
SELECT flight_id, flight_date, airline_name, airline_code, origin_airport AS origin,
  dest_airport AS destination, taxi_out, {R('avt', 2)} AS taxi_out_system_avg,
  {R('taxi_out - avt', 2)} AS taxi_out_excess, {R('crs_elapsed', 0)} AS scheduled_min,
  {R('actual_elapsed', 0)} AS actual_min, {R('ex', 2)} AS total_excess_min,
  {R('fuel_burn', 0)} AS fuel_lbs, {R('co2', 2)} AS co2_lbs,
  CASE WHEN taxi_out > 60 AND ex > 60 THEN 'Critical' WHEN taxi_out > 45 OR ex > 45 THEN 'High'
       ELSE 'Moderate' END AS severity
FROM w"""
    q["k13_punctuality_quartiles"] = f"""{mart('airline')},
{_per_airline(f", {R('AVG(arr_delay)', 2)} AS avg_arr_delay, {R('AVG(dep_delay)', 2)} AS avg_dep_delay, {CNT('arr_del15 = 1')} AS delayed_15", 'NOT cancelled')},
p AS (SELECT {R('quantile_cont(avg_arr_delay, 0.25)', 2)} AS q1_threshold,
             {R('quantile_cont(avg_arr_delay, 0.5)', 2)} AS median_threshold,
             {R('quantile_cont(avg_arr_delay, 0.75)', 2)} AS q3_threshold FROM c)
SELECT CAST(RANK() OVER (ORDER BY avg_arr_delay ASC) AS BIGINT) AS punctuality_rank,
  airline_name, airline_code, total_flights, avg_arr_delay, avg_dep_delay, delayed_15,
  {R('CAST(delayed_15 AS DOUBLE) * 100.0 / total_flights', 2)} AS delayed_pct,
  q1_threshold, median_threshold, q3_threshold,
  CASE WHEN avg_arr_delay <= q1_threshold THEN 'High punctuality'
       WHEN avg_arr_delay <= median_threshold THEN 'Medium-high punctuality'
       WHEN avg_arr_delay <= q3_threshold THEN 'Medium-low punctuality' ELSE 'Severe delay' END
       AS punctuality_class
FROM c CROSS JOIN p"""
    q["k14_month_end_close"] = f"""{mart()},
c AS (SELECT year, month, flight_date, COUNT(*) AS flights_on_close, {CNT('NOT cancelled')} AS executed,
             {CNT('cancelled')} AS cancelled, {ESUM('fuel_burn')} AS fuel, {ESUM('co2')} AS co2s
      FROM f WHERE flight_date = last_day(flight_date) AND fuel_burn IS NOT NULL
      GROUP BY year, month, flight_date),
w AS (SELECT *, AVG(flights_on_close) OVER () AS av FROM c)
SELECT year, month, flight_date AS close_date, flights_on_close, executed, cancelled,
  {R('fuel', 0)} AS fuel_lbs, {R('co2s', 0)} AS co2_lbs,
  CAST(SUM(flights_on_close) OVER (PARTITION BY year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ytd_flights,
  {R('SUM(co2s) OVER (PARTITION BY year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 0)} AS ytd_co2_lbs,
  CASE WHEN flights_on_close > av * 1.20 THEN 'High close'
       WHEN flights_on_close BETWEEN av * 0.80 AND av * 1.20 THEN 'Normal close' ELSE 'Low close' END
       AS close_category
FROM w"""
    q["k15_quarter_over_quarter"] = f"""{mart('airline')},
c AS (SELECT year, quarter, airline_name, airline_code, COUNT(*) AS total_flights,
             {ESUM('fuel_burn')} AS fuel, {ESUM('co2')} AS co2s, {R('AVG(distance)', 2)} AS avg_distance,
             {CNT('cancelled')} AS cancelled
      FROM f WHERE fuel_burn IS NOT NULL AND co2 IS NOT NULL
      GROUP BY year, quarter, airline_name, airline_code),
w AS (SELECT *,
  {R('CAST(total_flights AS DOUBLE) * 100.0 / SUM(total_flights) OVER (PARTITION BY year, airline_name)', 2)} AS share_of_year_pct,
  {R('CAST(total_flights AS DOUBLE) * 100.0 / SUM(total_flights) OVER (PARTITION BY year, quarter)', 2)} AS share_of_quarter_pct,
  LAG(total_flights) OVER (PARTITION BY year, airline_name ORDER BY quarter) AS prev_flights,
  LAG(co2s) OVER (PARTITION BY year, airline_name ORDER BY quarter) AS pc,
  CAST(RANK() OVER (PARTITION BY year, quarter ORDER BY total_flights DESC) AS BIGINT) AS rank_in_quarter
  FROM c)
SELECT year, quarter, airline_name, airline_code, rank_in_quarter, total_flights, cancelled,
  {R('fuel', 0)} AS fuel_lbs, {R('co2s', 0)} AS co2_lbs, avg_distance, share_of_year_pct,
  share_of_quarter_pct, prev_flights,
  {R('CAST(total_flights - prev_flights AS DOUBLE) * 100.0 / prev_flights', 2)} AS flights_change_pct,
  CASE WHEN pc IS NULL OR pc = 0 THEN NULL ELSE {R('(co2s - pc) * 100.0 / pc', 2)} END AS co2_change_pct,
  CASE WHEN prev_flights IS NULL THEN 'First quarter on record'
       WHEN total_flights > prev_flights * 1.1 THEN 'Growth'
       WHEN total_flights BETWEEN prev_flights * 0.9 AND prev_flights * 1.1 THEN 'Stable'
       ELSE 'Decline' END AS trend,
  CASE WHEN share_of_quarter_pct >= 20 THEN 'Leader' WHEN share_of_quarter_pct >= 10 THEN 'Strong competitor'
       WHEN share_of_quarter_pct >= 5 THEN 'Active participant' ELSE 'Minor share' END AS market_position
FROM w"""
    q["k16_top_origin_airports"] = f"""{mart('airline')},
c AS (SELECT origin_state, origin_airport_id, origin_airport, COUNT(*) AS total_flights FROM f
      GROUP BY origin_state, origin_airport_id, origin_airport),
w AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY origin_state ORDER BY total_flights DESC,
             origin_airport_id) AS BIGINT) AS position_in_state FROM c)
SELECT * FROM w WHERE position_in_state <= 3"""
    q["k17_rank_in_network"] = f"""{mart('airline')},
c AS (SELECT network_name, airline_name, airline_code, year, quarter, COUNT(*) AS total_flights FROM f
      GROUP BY network_name, airline_name, airline_code, year, quarter)
SELECT *, CAST(RANK() OVER (PARTITION BY network_name, year, quarter ORDER BY total_flights DESC) AS BIGINT)
  AS position_in_network FROM c"""
    q["k18_change_vs_previous_quarter"] = f"""{mart('airline')},
c AS (SELECT airline_name, airline_code, year, quarter, COUNT(*) AS flights_this_quarter FROM f
      GROUP BY airline_name, airline_code, year, quarter),
w AS (SELECT *, LAG(flights_this_quarter) OVER (PARTITION BY airline_name ORDER BY year, quarter)
      AS flights_prev_quarter FROM c)
SELECT *, flights_this_quarter - flights_prev_quarter AS abs_change,
  {R('CAST(flights_this_quarter - flights_prev_quarter AS DOUBLE) * 100.0 / flights_prev_quarter', 2)} AS pct_change,
  CASE WHEN flights_prev_quarter IS NULL THEN 'First quarter on record'
       WHEN flights_this_quarter > flights_prev_quarter THEN 'Grew'
       WHEN flights_this_quarter < flights_prev_quarter THEN 'Fell' ELSE 'Unchanged' END AS trend
FROM w"""
    q["k19_daily_running_total"] = f"""{mart('airline')},
c AS (SELECT airline_name, airline_code, flight_date, COUNT(*) AS flights_of_day FROM f
      WHERE flight_date BETWEEN DATE '1998-09-01' AND DATE '1998-09-30'
      GROUP BY airline_name, airline_code, flight_date)
SELECT *, CAST(SUM(flights_of_day) OVER (PARTITION BY airline_name ORDER BY flight_date
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS month_to_date FROM c"""
    q["k20_share_system_alliance"] = f"""{mart('airline')},
c AS (SELECT alliance_name, airline_name, airline_code, COUNT(*) AS total_flights FROM f
      GROUP BY alliance_name, airline_name, airline_code)
SELECT *, CAST(SUM(total_flights) OVER () AS BIGINT) AS system_total,
  CAST(SUM(total_flights) OVER (PARTITION BY alliance_name) AS BIGINT) AS alliance_total,
  {R('CAST(total_flights AS DOUBLE) * 100.0 / SUM(total_flights) OVER ()', 2)} AS global_share_pct,
  {R('CAST(total_flights AS DOUBLE) * 100.0 / SUM(total_flights) OVER (PARTITION BY alliance_name)', 2)} AS alliance_share_pct,
  CAST(RANK() OVER (ORDER BY total_flights DESC) AS BIGINT) AS global_rank,
  CAST(RANK() OVER (PARTITION BY alliance_name ORDER BY total_flights DESC) AS BIGINT) AS alliance_rank
FROM c"""
    q["k21_quarterly_co2_matrix"] = f"""{mart('airline')}
SELECT airline_name,
  {R(ESUM('CASE WHEN quarter = 1 THEN co2 ELSE 0.0 END'), 0)} AS q1_co2_lbs,
  {R(ESUM('CASE WHEN quarter = 2 THEN co2 ELSE 0.0 END'), 0)} AS q2_co2_lbs,
  {R(ESUM('CASE WHEN quarter = 3 THEN co2 ELSE 0.0 END'), 0)} AS q3_co2_lbs,
  {R(ESUM('CASE WHEN quarter = 4 THEN co2 ELSE 0.0 END'), 0)} AS q4_co2_lbs,
  {R(ESUM('co2'), 0)} AS total_co2_lbs
FROM f WHERE NOT cancelled AND co2 IS NOT NULL GROUP BY airline_name"""
    ytd = f"""{mart('airline')},
c AS (SELECT airline_name, year, month, CAST(SUM(dep_delay_minutes + arr_delay_minutes) AS BIGINT)
      AS delay_minutes FROM f WHERE NOT cancelled AND year = 2000 AND month <= 6
      GROUP BY airline_name, year, month),
d AS (SELECT *, CAST(SUM(delay_minutes) OVER (PARTITION BY airline_name, year ORDER BY month
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ytd_delay_minutes FROM c)"""
    q["k22_ytd_delay"] = f"{ytd}\nSELECT * FROM d"
    q["k22_ytd_delay_top5"] = f"""{ytd},
b AS (SELECT airline_name FROM d GROUP BY airline_name
      ORDER BY MAX(ytd_delay_minutes) DESC, airline_name LIMIT 5)
SELECT * FROM d WHERE airline_name IN (SELECT airline_name FROM b)"""
    q["k23_mtd_fuel"] = f"""{mart()},
c AS (SELECT year, month, day_of_month, {ESUM('fuel_burn')} AS daily FROM f
      WHERE fuel_burn > 0 AND NOT cancelled AND flight_date BETWEEN DATE '2000-06-01' AND DATE '2000-06-15'
      GROUP BY year, month, day_of_month)
SELECT year, month, day_of_month, {R('daily', 0)} AS daily_fuel_lbs,
  {R('SUM(daily) OVER (PARTITION BY year, month ORDER BY day_of_month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)', 0)} AS mtd_fuel_lbs
FROM c"""
    route = f"""{mart('airline', 'dest')},
c AS (SELECT origin_airport, dest_airport, COUNT(*) AS total_flights, {CNT('cancelled')} AS cancelled,
             AVG(CAST(dep_delay_minutes AS DOUBLE)) AS dl FROM f
      GROUP BY origin_airport, dest_airport HAVING COUNT(*) > 50),
r AS (SELECT *, CAST(cancelled AS DOUBLE) * 100.0 / total_flights AS rt FROM c),
k AS (SELECT *, CASE WHEN rt > 5.0 OR dl > 45.0 THEN 'Critical risk'
                     WHEN rt > 2.5 OR dl > 30.0 THEN 'High risk'
                     WHEN rt > 1.0 OR dl > 15.0 THEN 'Moderate risk' ELSE 'Stable operation' END AS risk_level
      FROM r)"""
    q["k24_route_risk"] = f"""{route}
SELECT origin_airport || '-' || dest_airport AS route, total_flights, {R('rt', 2)} AS cancel_rate_pct,
  {R('dl', 1)} AS avg_delay_min, risk_level FROM k"""
    q["k36_route_risk_distribution"] = f"""{route}
SELECT risk_level, COUNT(*) AS routes, CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS evaluated_routes
FROM k GROUP BY risk_level"""
    q["k25_late_flights"] = f"""{mart('airline', 'dest')}
SELECT flight_date, airline_name, tail_id AS model_id, origin_airport || ' -> ' || dest_airport AS route,
  dep_delay_minutes AS delay_minutes, COALESCE({R('fuel_burn', 2)}, 0.0) AS fuel_lbs
FROM f WHERE airline_code = '7' AND month = 6 AND dep_delay_minutes >= 100 AND NOT cancelled"""
    return q


AIRLINES_SEL = ", ".join(f"'Supplier#{i:09d}'" for i in range(1, 11))
FACTOR_SQL = ("CASE upper(trim(engine_type)) WHEN 'JET' THEN 1.0 WHEN 'TURBOFAN' THEN 1.0 "
              "WHEN 'TURBOJET' THEN 1.0 WHEN 'TURBOPROP' THEN 0.45 WHEN 'TURBOSHAFT' THEN 0.55 "
              "WHEN 'PISTON' THEN 0.30 WHEN 'UNKNOWN' THEN 1.0 ELSE 1.0 END")


def dashboard() -> dict[str, str]:
    q: dict[str, str] = {}
    picked = f"month BETWEEN 3 AND 8 AND airline_name IN ({AIRLINES_SEL})"
    for tail, cond in (("", "TRUE"), ("_selected", picked)):
        q["k26_volume_kpi" + tail] = f"""{mart('airline')}
SELECT COUNT(*) AS total_flights, {CNT('cancelled')} AS cancelled FROM f WHERE {cond}"""
        q["k27_delay_kpi" + tail] = f"""{mart('airline')}
SELECT {R('AVG(dep_delay_minutes)', 4)} AS avg_dep_delay_min FROM f WHERE {cond} AND NOT cancelled"""
        q["k28_top_delay_airlines" + tail] = f"""{mart('airline')}
SELECT airline_name, {R('AVG(dep_delay_minutes)', 4)} AS avg_delay_min FROM f
WHERE {cond} AND NOT cancelled GROUP BY airline_name
ORDER BY avg_delay_min DESC, airline_name LIMIT 10"""
    valid = "NOT cancelled AND fuel_burn > 0"
    co2x = ESUM('fuel_burn * 3.16::DOUBLE')
    q["k29_emissions_panel"] = f"""{mart('model')}
SELECT model_id, maker, engines, COUNT(*) AS total_flights, {R(co2x, 2)} AS co2_lbs,
  {R('AVG(fuel_burn)', 4)} AS avg_fuel_lbs, {R('AVG(distance)', 4)} AS avg_distance
FROM f WHERE {valid} GROUP BY model_id, maker, engines"""
    q["k29_fleet_totals"] = f"""{mart('model')}
SELECT {R(co2x, 2)} AS fleet_co2_lbs, COUNT(*) AS flights_analysed,
  COUNT(DISTINCT maker) AS active_makers FROM f WHERE {valid}"""
    q["k34_emission_totals"] = f"""{mart('model')}
SELECT {R(co2x, 2)} AS total_co2_lbs, COUNT(*) AS valid_fuel_flights,
  COUNT(DISTINCT maker) AS active_makers FROM f WHERE {valid}"""
    est = (f"CASE WHEN cancelled THEN 0.0::DOUBLE WHEN mtow > 0 AND crs_elapsed > 0 THEN "
           f"({FACTOR_SQL}) * mtow * (crs_elapsed / 60.0 * 0.030 + 0.012) END")
    q["k30_fuel_before_after"] = f"""{mart('model')},
b AS (SELECT model_id, COUNT(*) AS flights_before, {R('AVG(fuel_burn)', 4)} AS avg_fuel_before
      FROM f WHERE {valid} GROUP BY model_id HAVING COUNT(*) >= 25),
e AS (SELECT model_id, cancelled, {est} AS fuel_est FROM f),
a AS (SELECT model_id, COUNT(*) AS flights_after, {R('AVG(fuel_est)', 4)} AS avg_fuel_after
      FROM e WHERE NOT cancelled AND fuel_est > 0 GROUP BY model_id HAVING COUNT(*) >= 25)
SELECT b.model_id, flights_before, avg_fuel_before, flights_after, avg_fuel_after
FROM b JOIN a ON b.model_id = a.model_id"""
    q["k31_global_counts"] = f"""{mart()}
SELECT COUNT(*) AS total_flights, {CNT('cancelled')} AS cancelled, {CNT('diverted')} AS diverted,
  {CNT('dep_del15 = 1')} AS dep_delayed_15 FROM f"""
    q["k32_mean_delays"] = f"""{mart()}
SELECT {R('AVG(CAST(dep_delay_minutes AS DOUBLE))', 4)} AS avg_dep_delay_min,
  {R('AVG(CAST(arr_delay_minutes AS DOUBLE))', 4)} AS avg_arr_delay_min FROM f WHERE NOT cancelled"""
    q["k33_catalogue_sizes"] = f"""{mart('airline', 'dest')}
SELECT (SELECT COUNT(*) FROM supplier) AS airlines, (SELECT COUNT(*) FROM part) AS models,
  COUNT(DISTINCT origin_airport_id) AS origin_airports, COUNT(DISTINCT dest_airport_id) AS dest_airports
FROM f"""
    q["k35_top_models_co2"] = f"""{mart('model')}
SELECT model_id, {R(co2x, 2)} AS co2_lbs FROM f WHERE {valid} GROUP BY model_id
ORDER BY co2_lbs DESC, model_id LIMIT 5"""
    q["k35_top_airlines_co2"] = f"""{mart('airline')}
SELECT airline_name, {R(ESUM('co2'), 2)} AS co2_column, {R(co2x, 2)} AS co2_fuel_x316 FROM f
WHERE {valid} GROUP BY airline_name ORDER BY co2_fuel_x316 DESC, airline_name LIMIT 3"""
    q["k37_simulator_catalogue"] = f"""WITH mo AS ({_MODELS})
SELECT DISTINCT model_id, maker, engine_type, engines, mtow FROM mo
WHERE mtow > 0 AND engine_type IS NOT NULL AND upper(engine_type) NOT IN ('TURBOSHAFT', 'PISTON', 'UNKNOWN')"""
    return q


def _avg(c: str, n: int = 4) -> str:
    return R(f"AVG(CAST({c} AS DOUBLE))", n)


def families() -> dict[str, str]:
    q: dict[str, str] = {}
    stats = (f"{_avg('dep_delay_minutes')} AS avg_dep_delay, CAST(SUM(dep_delay_minutes) AS BIGINT) AS total_dep_delay, "
             "CAST(MAX(dep_delay_minutes) AS BIGINT) AS max_dep_delay, CAST(MIN(dep_delay_minutes) AS BIGINT) AS min_dep_delay")
    q["l01_delay_stats"] = f"{mart()} SELECT {stats} FROM f WHERE NOT cancelled"
    q["l01_delay_stats_by_year"] = f"{mart()} SELECT year, {stats} FROM f WHERE NOT cancelled GROUP BY year"
    q["l01_delay_stats_by_month"] = f"{mart()} SELECT month, {stats} FROM f WHERE NOT cancelled GROUP BY month"
    q["l01_delayed_counts"] = f"""{mart()}
SELECT COUNT(*) AS flights, {CNT('dep_delay_minutes > 60')} AS over_threshold, {CNT('dep_del15 = 1')} AS del15_flights,
  {R(f"CAST({CNT('dep_del15 = 1')} AS DOUBLE) * 100.0 / COUNT(*)", 2)} AS del15_pct
FROM f WHERE NOT cancelled"""
    dl = f"{_avg('dep_delay_minutes')} AS avg_dep_delay, {_avg('arr_delay_minutes')} AS avg_arr_delay, COUNT(*) AS flights"
    q["l02_delay_by_airline_top10"] = f"""{mart('airline')} SELECT airline_name, {dl} FROM f WHERE NOT cancelled
GROUP BY airline_name ORDER BY avg_dep_delay DESC NULLS LAST, airline_name LIMIT 10"""
    q["l02_delay_by_continent"] = f"{mart('dest')} SELECT dest_continent, {dl} FROM f WHERE NOT cancelled GROUP BY dest_continent"
    q["l02_delay_by_weekday"] = f"{mart()} SELECT day_of_week, {dl} FROM f WHERE NOT cancelled GROUP BY day_of_week"
    q["l02_delay_by_distance_group"] = f"{mart()} SELECT distance_group, {dl} FROM f WHERE NOT cancelled GROUP BY distance_group"
    tx = (f"{_avg('taxi_out')} AS avg_taxi_out, {_avg('taxi_in')} AS avg_taxi_in, CAST(MAX(taxi_out) AS BIGINT) AS max_taxi_out, "
          f"{CNT('taxi_out > 30')} AS long_taxi_flights")
    q["l03_taxi_by_origin"] = f"{mart('airline')} SELECT origin_airport, {tx} FROM f WHERE NOT cancelled GROUP BY origin_airport"
    q["l03_taxi_by_month"] = f"{mart()} SELECT month, {tx} FROM f WHERE NOT cancelled GROUP BY month"
    q["l03_top_taxi_flights"] = f"""{mart()} SELECT flight_id, taxi_out + taxi_in AS total_taxi FROM f WHERE NOT cancelled
ORDER BY total_taxi DESC, flight_id LIMIT 10"""
    q["l04_fleet_by_airline"] = f"""{mart('airline', 'model')} SELECT airline_name, COUNT(*) AS flights,
  COUNT(DISTINCT tail_id) AS aircraft, COUNT(DISTINCT maker) AS makers FROM f GROUP BY airline_name"""
    q["l04_models_per_maker"] = f"{mart('model')} SELECT maker, COUNT(DISTINCT model_id) AS models_flown, COUNT(*) AS flights FROM f GROUP BY maker"
    geo = f"COUNT(*) AS flights, {CNT('cancelled')} AS cancelled, COUNT(DISTINCT airline_id) AS airlines"
    q["l05_flights_by_dest_state"] = f"{mart('dest')} SELECT dest_state, {geo} FROM f GROUP BY dest_state"
    q["l05_flights_by_origin_airport"] = f"{mart('airline')} SELECT origin_airport, {geo} FROM f GROUP BY origin_airport"
    dist = f"{R(ESUM('distance'), 2)} AS total_distance, {_avg('distance', 2)} AS avg_distance, COUNT(*) AS flights"
    q["l06_distance_by_year"] = f"{mart()} SELECT year, {dist} FROM f GROUP BY year"
    q["l06_distance_by_airline"] = f"{mart('airline')} SELECT airline_name, {dist} FROM f GROUP BY airline_name"
    q["l06_longest_routes"] = f"""{mart('airline', 'dest')} SELECT origin_airport, dest_airport, {_avg('distance', 2)} AS avg_distance,
  COUNT(*) AS flights FROM f GROUP BY origin_airport, dest_airport
ORDER BY avg_distance DESC NULLS LAST, origin_airport, dest_airport LIMIT 10"""
    co2 = (f"{R(ESUM('co2'), 2)} AS total_co2, {_avg('co2', 4)} AS avg_co2, {R('MAX(co2)', 4)} AS max_co2, "
           f"{R(ESUM('co2') + ' / NULLIF(' + ESUM('distance') + ', 0) * 1000.0', 4)} AS co2_per_1000_mi")
    q["l07_co2_by_airline"] = f"{mart('airline')} SELECT airline_name, {co2} FROM f WHERE NOT cancelled AND co2 IS NOT NULL GROUP BY airline_name"
    q["l07_co2_by_continent"] = f"{mart('dest')} SELECT dest_continent, {co2} FROM f WHERE NOT cancelled AND co2 IS NOT NULL GROUP BY dest_continent"
    q["l07_cancel_rate_by_month"] = f"""{mart()} SELECT month, COUNT(*) AS flights, {CNT('cancelled')} AS cancelled,
  {R(f"CAST({CNT('cancelled')} AS DOUBLE) * 100.0 / COUNT(*)", 2)} AS cancel_pct FROM f GROUP BY month"""
    monthly = f"{mart('airline')}, c AS (SELECT airline_name, year, month, COUNT(*) AS flights FROM f GROUP BY airline_name, year, month)"
    q["l08_monthly_windows"] = f"""{monthly},
w AS (SELECT *, LAG(flights) OVER (PARTITION BY airline_name, year ORDER BY month) AS prev_month FROM c)
SELECT airline_name, year, month, flights,
  CAST(RANK() OVER (PARTITION BY year, month ORDER BY flights DESC) AS BIGINT) AS rank_in_month,
  CAST(DENSE_RANK() OVER (PARTITION BY year, month ORDER BY flights DESC) AS BIGINT) AS dense_rank_in_month,
  CAST(NTILE(4) OVER (PARTITION BY year, month ORDER BY flights DESC, airline_name) AS BIGINT) AS quartile_in_month,
  CAST(SUM(flights) OVER (PARTITION BY airline_name, year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ytd_flights,
  prev_month, flights - prev_month AS diff_vs_prev,
  {R('AVG(flights) OVER (PARTITION BY airline_name, year ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 4)} AS moving_avg_3,
  {R('CAST(flights AS DOUBLE) * 100.0 / SUM(flights) OVER (PARTITION BY airline_name, year)', 2)} AS share_of_year_pct,
  {R('CAST(flights AS DOUBLE) * 100.0 / MAX(flights) OVER (PARTITION BY year, month)', 2)} AS pct_of_max
FROM w"""
    yr = f"{mart('airline')}, c AS (SELECT year, airline_name, COUNT(*) AS flights FROM f GROUP BY year, airline_name)"
    q["l08_top3_per_year"] = f"""{yr}, w AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY year ORDER BY flights DESC, airline_name) AS BIGINT) AS position FROM c)
SELECT * FROM w WHERE position <= 3"""
    q["l08_dense_top3_per_year"] = f"""{yr}, w AS (SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY year ORDER BY flights DESC, airline_name) AS BIGINT) AS position FROM c)
SELECT * FROM w WHERE position <= 3"""
    q["l08_running_sum_of_sum"] = f"""{mart()}, c AS (SELECT year, month, CAST(SUM(dep_delay_minutes) AS BIGINT) AS delay_minutes FROM f
WHERE NOT cancelled GROUP BY year, month)
SELECT *, CAST(SUM(delay_minutes) OVER (PARTITION BY year ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS running_delay_minutes FROM c"""
    conts = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    cols = ", ".join(f"CAST(COUNT(CASE WHEN dest_continent = '{c}' THEN flight_id END) AS BIGINT) AS {c.lower().replace(' ', '_')}" for c in conts)
    q["l09_pivot_count_by_continent"] = f"{mart('airline', 'dest')} SELECT airline_name, {cols} FROM f GROUP BY airline_name"
    qcols = ", ".join(f"{R(f'AVG(CASE WHEN quarter = {i} THEN CAST(dep_delay_minutes AS DOUBLE) END)', 4)} AS q{i}" for i in (1, 2, 3, 4))
    q["l09_pivot_avg_delay_by_quarter"] = f"{mart('airline')} SELECT airline_name, {qcols} FROM f WHERE NOT cancelled GROUP BY airline_name"
    q["l09_unpivot_quarters"] = f"""{mart('airline')},
c AS (SELECT airline_name, quarter, COUNT(*) AS n FROM f GROUP BY airline_name, quarter),
a AS (SELECT DISTINCT airline_name FROM f),
qs AS (SELECT * FROM (VALUES (1, 'q1'), (2, 'q2'), (3, 'q3'), (4, 'q4')) t(qn, quarter))
SELECT a.airline_name, qs.quarter, CAST(COALESCE(c.n, 0) AS BIGINT) AS flights
FROM a CROSS JOIN qs LEFT JOIN c ON c.airline_name = a.airline_name AND c.quarter = qs.qn"""
    q["l12_above_global_average"] = f"""{mart('airline')},
p AS (SELECT airline_name, AVG(dep_delay_minutes) AS a FROM f WHERE NOT cancelled GROUP BY airline_name),
g AS (SELECT AVG(dep_delay_minutes) AS g FROM f WHERE NOT cancelled)
SELECT airline_name, {R('a', 4)} AS avg_dep_delay, {R('g', 4)} AS global_avg FROM p CROSS JOIN g WHERE a > g"""
    q["l12_worst_month_per_airline"] = f"""{mart('airline')},
c AS (SELECT airline_name, year, month, {R('AVG(dep_delay_minutes)', 4)} AS avg_dep_delay FROM f WHERE NOT cancelled
      GROUP BY airline_name, year, month),
w AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY airline_name ORDER BY avg_dep_delay DESC, year, month) AS BIGINT) AS position FROM c)
SELECT * FROM w WHERE position <= 1"""
    q["l12_airline_vs_network"] = f"""{mart('airline')},
a AS (SELECT network_name, airline_name, AVG(dep_delay_minutes) AS a FROM f WHERE NOT cancelled GROUP BY network_name, airline_name),
n AS (SELECT network_name, AVG(dep_delay_minutes) AS n FROM f WHERE NOT cancelled GROUP BY network_name)
SELECT a.network_name, airline_name, {R('a', 4)} AS airline_avg, {R('n', 4)} AS network_avg, {R('a - n', 4)} AS diff
FROM a JOIN n ON a.network_name = n.network_name"""
    q["l13_by_maker_top5"] = f"""{mart('model')} SELECT maker, COUNT(*) AS flights, COUNT(DISTINCT model_id) AS aircraft,
  {_avg('co2')} AS avg_co2 FROM f GROUP BY maker ORDER BY flights DESC, maker LIMIT 5"""
    q["l14_top_destinations"] = f"""{mart('dest')} SELECT dest_state, dest_airport, COUNT(*) AS flights,
  {_avg('arr_delay_minutes')} AS avg_arr_delay FROM f GROUP BY dest_state, dest_airport
ORDER BY flights DESC, dest_state, dest_airport LIMIT 10"""
    q["l04_fleet_by_month"] = f"""{mart()} SELECT year, month, COUNT(DISTINCT tail_id) AS aircraft,
  COUNT(DISTINCT airline_id) AS airlines FROM f GROUP BY year, month"""
    q["l04_airline_makers"] = f"""{mart('airline', 'model')} SELECT airline_name, maker, COUNT(*) AS flights,
  COUNT(DISTINCT tail_id) AS aircraft FROM f GROUP BY airline_id, airline_name, maker"""
    q["l05_flights_by_city_pair_state"] = f"""{mart('airline', 'dest')} SELECT origin_state, dest_state, COUNT(*) AS flights,
  {R(f"{CNT('cancelled')} * 100.0 / COUNT(*)", 2)} AS cancel_pct FROM f GROUP BY origin_state, dest_state"""
    days = ", ".join(f"{R(f'AVG(CASE WHEN day_of_week = {d} THEN CAST(dep_delay_minutes AS DOUBLE) END)', 4)} AS day{d}" for d in range(1, 8))
    q["l09_pivot_delay_by_weekday"] = f"{mart('airline')} SELECT airline_name, {days} FROM f WHERE NOT cancelled GROUP BY airline_name"
    for by in ("co2", "fuel", "aircraft"):
        q[f"l13_makers_by_{by}"] = f"""{mart('model')}, g AS (SELECT maker, COUNT(*) AS flights, COUNT(DISTINCT tail_id) AS aircraft,
  {R(ESUM('co2'), 2)} AS co2, {R(ESUM('fuel_burn'), 2)} AS fuel FROM f GROUP BY maker)
SELECT *, RANK() OVER (ORDER BY {by} DESC) AS position FROM g"""
    for by in ("avg_arr_delay", "co2"):
        q[f"l14_destinations_by_{by}"] = f"""{mart('dest')}, g AS (SELECT dest_continent, dest_airport, COUNT(*) AS flights,
  {_avg('arr_delay_minutes')} AS avg_arr_delay, {R(ESUM('co2'), 2)} AS co2 FROM f GROUP BY dest_continent, dest_airport)
SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY dest_continent ORDER BY {by} DESC NULLS LAST, dest_airport) AS position FROM g)
WHERE position <= 2"""
    q["e09_mean_row_ratio"] = f"""{mart('airline')} SELECT airline_name, {R('AVG(co2 / NULLIF(distance, 0))', 10)} AS mean_ratio,
  {R(f"{ESUM('co2')} / NULLIF({ESUM('distance')}, 0)", 10)} AS ratio_of_sums FROM f WHERE co2 IS NOT NULL GROUP BY airline_name"""
    q["e11_null_as_zero"] = f"""{mart('airline')} SELECT airline_name, {R('AVG(COALESCE(fuel_burn, 0))', 6)} AS avg_null_as_zero,
  {R('AVG(fuel_burn)', 6)} AS avg_known, {ESUM('COALESCE(fuel_burn, 0)')} AS sum_fuel FROM f GROUP BY airline_name"""
    q["d03_left_outer_ignoring_nulls"] = f"""{mart()}, d AS (SELECT airline_id, COUNT(*) AS n, SUM(arr_delay_minutes) AS delay,
  MAX(distance) AS far FROM f WHERE diverted GROUP BY airline_id)
SELECT n_name AS network_name, COUNT(*) AS airlines, COUNT(d.n) AS airlines_with_diversions,
  CAST(COALESCE(SUM(d.n), 0) AS BIGINT) AS diverted, {R('CAST(SUM(d.delay) AS DOUBLE) / NULLIF(SUM(d.n), 0)', 4)} AS avg_delay,
  {R('MAX(d.far)', 2)} AS longest
FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN d ON d.airline_id = s_suppkey GROUP BY n_name"""
    q["l15_delay_buckets"] = f"""{mart()} SELECT CASE WHEN dep_delay_minutes <= 0 THEN 'on time' WHEN dep_delay_minutes < 15 THEN 'minor'
  WHEN dep_delay_minutes < 60 THEN 'moderate' WHEN dep_delay_minutes < 240 THEN 'major' ELSE 'severe' END AS bucket,
  COUNT(*) AS flights FROM f WHERE NOT cancelled GROUP BY 1"""
    q["l15_months_above_yearly_mean"] = f"""{mart()},
c AS (SELECT year, month, COUNT(*) AS flights FROM f GROUP BY year, month),
w AS (SELECT *, AVG(flights) OVER (PARTITION BY year) AS y FROM c)
SELECT year, month, flights, {R('y', 4)} AS yearly_mean FROM w WHERE flights > y"""
    q["l15_weekend_by_airline"] = f"{mart('airline')} SELECT airline_name, COUNT(*) AS weekend_flights FROM f WHERE day_of_week IN (6, 7) GROUP BY airline_name"
    q["l15_haul_buckets"] = f"""{mart()} SELECT CASE WHEN distance >= 50000.0 THEN 'long haul' ELSE 'short haul' END AS haul,
  COUNT(*) AS flights, {_avg('dep_delay_minutes')} AS avg_dep_delay FROM f GROUP BY 1"""
    q["l15_share_by_scalar"] = f"""{mart('dest')},
p AS (SELECT dest_continent, COUNT(*) AS flights FROM f GROUP BY dest_continent), t AS (SELECT COUNT(*) AS t FROM f)
SELECT dest_continent, flights, {R('CAST(flights AS DOUBLE) * 100.0 / t', 2)} AS share_pct FROM p CROSS JOIN t"""
    return q


def views() -> dict[str, str]:
    q: dict[str, str] = {}
    q["u1_v_flight_delay"] = f"{mart('airline')} SELECT flight_id, flight_date, airline_name, dep_delay, arr_delay, dep_del15, arr_del15, cancelled FROM f"
    summ = f"""{mart('airline')} SELECT airline_name, airline_code, COUNT(*) AS flights, {CNT('cancelled')} AS cancelled,
  {R('AVG(CASE WHEN NOT cancelled THEN dep_delay_minutes END)', 4)} AS avg_dep_delay FROM f GROUP BY airline_name, airline_code"""
    q["u1_v_airline_summary"] = summ
    q["u1_v_destination_geo"] = f"{mart('dest')} SELECT flight_id, dest_airport, dest_state, dest_continent FROM f"
    q["u1_v_route_metrics"] = f"""{mart('airline', 'dest')} SELECT origin_airport, dest_airport, COUNT(*) AS flights,
  {R('AVG(distance)', 2)} AS avg_distance, {R('AVG(dep_delay_minutes)', 4)} AS avg_dep_delay FROM f GROUP BY origin_airport, dest_airport"""
    q["u1_v_taxi_per_flight"] = f"{mart()} SELECT flight_id, taxi_out, taxi_in, taxi_out + taxi_in AS taxi_total FROM f"
    q["u1_v_co2_per_continent"] = f"""{mart('dest')} SELECT dest_continent, {R(ESUM('co2'), 2)} AS total_co2, COUNT(*) AS flights
FROM f WHERE NOT cancelled AND co2 IS NOT NULL GROUP BY dest_continent"""
    q["u2_flights_to_continent"] = f"{mart('dest')} SELECT COUNT(*) AS flights FROM f WHERE dest_continent = 'EUROPE'"
    q["u2_yearly_delay"] = f"{mart()} SELECT month, {R('AVG(dep_delay_minutes)', 4)} AS avg_dep_delay FROM f WHERE year = 1999 AND NOT cancelled GROUP BY month"
    q["u2_airline_summary"] = f"SELECT * FROM ({summ}) WHERE airline_code = '7'"
    q["u2_delayed_over"] = f"{mart('airline')} SELECT airline_name, COUNT(*) AS delayed_flights FROM f WHERE NOT cancelled AND dep_delay_minutes > 500 GROUP BY airline_name"
    q["u2_distance_group_metrics"] = f"""{mart()} SELECT COUNT(*) AS flights, {R('AVG(distance)', 2)} AS avg_distance,
  {R('AVG(dep_delay_minutes)', 4)} AS avg_dep_delay FROM f WHERE distance_group = 3"""
    q["u2_monthly_taxi"] = f"""{mart('airline')} SELECT origin_airport, {R('AVG(taxi_out)', 4)} AS avg_taxi_out, {R('AVG(taxi_in)', 4)} AS avg_taxi_in
FROM f WHERE month = 7 GROUP BY origin_airport"""
    q["u5_sql_late_flights"] = f"""{mart('airline')} SELECT flight_id, airline_name, month, dep_delay_minutes FROM f
WHERE airline_code = '7' AND month = 6 AND dep_delay_minutes >= 100 AND NOT cancelled"""
    return q


def etl() -> dict[str, str]:
    q: dict[str, str] = {}
    q["b10_keep_first"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1"""
    q["b10_dedupe_report"] = """
SELECT CAST(SUM(n) AS BIGINT) AS rows_in, COUNT(*) AS rows_kept, CAST(SUM(n) - COUNT(*) AS BIGINT) AS rows_removed
FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
    q["b15_canonical_keys"] = """
SELECT l_orderkey, l_partkey, l_suppkey, concat_ws('||',
  COALESCE(strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d'), '<NA>'),
  COALESCE(CAST(CAST(ROUND(CAST(l_linenumber AS DOUBLE), 0) AS BIGINT) AS VARCHAR), '<NA>'),
  COALESCE(CAST(CAST(ROUND(CAST(l_extendedprice AS DECIMAL(38,10)), 2) AS DECIMAL(38,2)) AS VARCHAR), '<NA>'),
  COALESCE(NULLIF(upper(trim(l_returnflag)), 'NAN'), '<NA>'),
  COALESCE(CAST(CAST(ROUND(l_quantity, 0) AS BIGINT) AS VARCHAR), '<NA>')) AS canon_key
FROM lineitem"""
    q["b_clean_orders"] = """
SELECT o_orderkey, CAST(TRY_STRPTIME(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS order_date,
  NULLIF(CAST(CAST(floor(CAST(o_custkey AS DOUBLE)) AS BIGINT) AS VARCHAR), '-1') AS cust_code,
  NULLIF(upper(trim(substr(o_orderpriority, 3, 20))), 'NAN') AS priority,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'urgent' WHEN '2' THEN 'high' WHEN '3' THEN 'medium'
       ELSE substr(o_orderpriority, 1, 1) END AS priority_label,
  o_totalprice AS total_price, o_orderstatus = 'F' AS finished
FROM orders"""
    q["b25_quantile_trim"] = f"""
WITH b AS (SELECT quantile_cont(l_extendedprice, 0.001) AS lo, quantile_cont(l_extendedprice, 0.999) AS hi FROM lineitem)
SELECT {R('lo', 4)} AS lower_bound, {R('hi', 4)} AS upper_bound, COUNT(*) AS rows_kept
FROM lineitem CROSS JOIN b WHERE l_extendedprice BETWEEN lo AND hi GROUP BY lo, hi"""
    q["d13_route_lookup_coverage"] = f"""{mart('airline', 'dest')},
d AS (SELECT DISTINCT origin_airport, dest_airport, distance_group FROM f
      WHERE origin_airport IS NOT NULL AND dest_airport IS NOT NULL AND distance_group IS NOT NULL),
l AS (SELECT f.flight_id, d.origin_airport AS hit FROM f LEFT JOIN d
      ON f.origin_airport IS NOT DISTINCT FROM d.origin_airport AND f.dest_airport IS NOT DISTINCT FROM d.dest_airport
      AND f.distance_group IS NOT DISTINCT FROM d.distance_group)
SELECT COUNT(*) AS "rows", COUNT(hit) AS matched,
  {R('AVG(CASE WHEN hit IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100.0', 4)} AS coverage_pct, 'route' AS lookup,
  CAST(0 AS BIGINT) AS colliding_surrogates, COUNT(*) - COUNT(hit) AS null_route_id FROM l"""
    def kset(lt, lk, rt, rk, name):
        return f"""SELECT
  (SELECT COUNT(*) FROM (SELECT DISTINCT {lk} AS k FROM {lt}) a WHERE NOT EXISTS (SELECT 1 FROM {rt} WHERE {rk} = a.k)) AS only_left,
  (SELECT COUNT(*) FROM (SELECT DISTINCT {rk} AS k FROM {rt}) b WHERE NOT EXISTS (SELECT 1 FROM {lt} WHERE {lk} = b.k)) AS only_right,
  (SELECT COUNT(*) FROM (SELECT DISTINCT {lk} AS k FROM {lt}) a WHERE EXISTS (SELECT 1 FROM {rt} WHERE {rk} = a.k)) AS common,
  (SELECT {R(f'AVG(CASE WHEN {lk} IN (SELECT {rk} FROM {rt}) THEN 1.0 ELSE 0.0 END) * 100.0', 4)} FROM {lt}) AS row_coverage_pct,
  '{name}' AS pair"""
    q["d17_key_sets"] = (kset("lineitem", "l_partkey", "part", "p_partkey", "lineitem.l_partkey~part")
                         + "\nUNION ALL\n" + kset("orders", "o_custkey", "customer", "c_custkey", "orders.o_custkey~customer"))
    q["h2_airport_roles"] = f"""{mart('airline', 'dest')},
u AS (SELECT CAST(origin_airport_id AS BIGINT) AS airport_id, origin_airport AS airport, origin_state AS state, 0 AS prio FROM f
      UNION ALL SELECT CAST(dest_airport_id AS BIGINT), dest_airport, dest_state, 1 FROM f)
SELECT airport_id, airport, state FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY airport_id ORDER BY prio, airport, state) AS rn FROM u
  WHERE airport_id IS NOT NULL) WHERE rn = 1"""
    q["m4_first_destination"] = f"""{mart('dest')}
SELECT airline_id, dest_airport FROM (
  SELECT airline_id, dest_airport, ROW_NUMBER() OVER (PARTITION BY airline_id ORDER BY flight_date, flight_id) AS rn
  FROM f WHERE dest_airport IS NOT NULL) WHERE rn = 1"""
    q["m7_coherence"] = f"""{mart()}
SELECT COUNT(*) AS "rows", {CNT('actual_elapsed > crs_elapsed * 1.5')} AS incoherent,
  {R(f"CAST({CNT('actual_elapsed > crs_elapsed * 1.5')} AS DOUBLE) * 100.0 / COUNT(*)", 4)} AS incoherent_pct
FROM f WHERE NOT cancelled AND actual_elapsed IS NOT NULL AND crs_elapsed IS NOT NULL"""
    q["m8_fuel_profile_by_maker"] = f"""{mart('model')}
SELECT maker, COUNT(*) AS n, {R('AVG(fuel_burn)', 4)} AS mean, MIN(fuel_burn) AS min, MAX(fuel_burn) AS max
FROM f WHERE NOT cancelled AND fuel_burn > 0 GROUP BY maker HAVING COUNT(*) >= 50"""
    est = (f"CASE WHEN cancelled THEN 0.0::DOUBLE WHEN mtow > 0 AND crs_elapsed > 0 THEN "
           f"({FACTOR_SQL}) * mtow * (crs_elapsed / 60.0 * 0.030 + 0.012) END")
    q["m8_cv_of_model_means"] = f"""{mart('model')},
a AS (SELECT model_id, AVG(fuel_burn) AS m FROM f WHERE NOT cancelled AND fuel_burn > 0
      GROUP BY model_id HAVING COUNT(*) >= 25),
e AS (SELECT model_id, {est} AS fe FROM f WHERE NOT cancelled),
b AS (SELECT model_id, AVG(fe) AS m FROM e WHERE fe IS NOT NULL GROUP BY model_id HAVING COUNT(*) >= 25)
SELECT (SELECT COUNT(*) FROM a) AS groups_stored, (SELECT {R('stddev_samp(m) / AVG(m)', 6)} FROM a) AS cv_stored,
  (SELECT COUNT(*) FROM b) AS groups_physical, (SELECT {R('stddev_samp(m) / AVG(m)', 6)} FROM b) AS cv_physical"""
    d = f"{mart('model')}, d AS (SELECT * FROM f WHERE NOT cancelled AND distance IS NOT NULL AND fuel_burn IS NOT NULL)"
    q["m9_pearson"] = f"{d} SELECT COUNT(*) AS n, {R('corr(distance, fuel_burn)', 6)} AS pearson_corr FROM d"
    q["m9_pearson_by_engine"] = f"""{d} SELECT engine_type, COUNT(*) AS n, {R('corr(distance, fuel_burn)', 6)} AS pearson_corr
FROM d GROUP BY engine_type"""
    def rk(part):
        p = f"PARTITION BY {part}, " if part else "PARTITION BY "
        o = f"PARTITION BY {part} " if part else ""
        return (f"r AS (SELECT *, RANK() OVER ({o}ORDER BY distance) - 1 + (COUNT(*) OVER ({p}distance) + 1) / 2.0 AS rx, "
                f"RANK() OVER ({o}ORDER BY fuel_burn) - 1 + (COUNT(*) OVER ({p}fuel_burn) + 1) / 2.0 AS ry FROM d)")
    q["m9_spearman"] = f"{d}, {rk('')} SELECT COUNT(*) AS n, {R('corr(rx, ry)', 6)} AS spearman_corr FROM r"
    q["m9_spearman_by_engine"] = f"""{d}, {rk('engine_type')} SELECT engine_type, COUNT(*) AS n,
  {R('corr(rx, ry)', 6)} AS spearman_corr FROM r GROUP BY engine_type"""
    v = f"{mart('model')}, v AS (SELECT * FROM f WHERE NOT cancelled AND fuel_burn > 0)"
    q["m10_signal_gate"] = f"""{v},
c AS (SELECT COUNT(*) AS n, {R('corr(distance, fuel_burn)', 6)} AS pearson_corr FROM v WHERE distance IS NOT NULL),
g AS (SELECT model_id, AVG(fuel_burn) AS m FROM v GROUP BY model_id HAVING COUNT(*) >= 25),
k AS (SELECT COUNT(*) AS groups, {R('stddev_samp(m) / AVG(m)', 6)} AS cv FROM g)
SELECT n, pearson_corr, groups, cv, abs(pearson_corr) > 0.30 OR cv > 0.25 AS has_signal FROM c CROSS JOIN k"""
    q["m12_fd_audit"] = f"""{mart('model')}
SELECT (SELECT COUNT(*) FROM (SELECT model_id FROM f GROUP BY model_id HAVING COUNT(DISTINCT mtow) > 1)) AS model_mtow_violations,
  (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(DISTINCT l_partkey) > 1)) AS line_key_part_violations,
  (SELECT {CNT('distance <= 0')} FROM f) AS non_positive_distance"""
    q["m13_numeric_profile"] = f"""
WITH u AS (UNPIVOT (SELECT l_quantity + 0.0 AS l_quantity, l_extendedprice + 0.0 AS l_extendedprice,
                           l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax FROM lineitem)
           ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME "column" VALUE value)
SELECT "column", COUNT(value) AS count, {R('AVG(value)', 4)} AS mean, {R('stddev_samp(value)', 4)} AS std,
  MIN(value) AS min, {R('quantile_cont(value, 0.5)', 4)} AS median, MAX(value) AS max, COUNT(DISTINCT value) AS distinct
FROM u GROUP BY "column" """
    q["m14_profile_columns"] = f"""
WITH o AS (SELECT o_orderstatus, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS order_day,
                  CAST(o_totalprice AS VARCHAR) AS o_totalprice FROM orders),
u AS (UNPIVOT o ON o_orderstatus, o_orderpriority, order_day, o_totalprice INTO NAME "column" VALUE value),
p AS (SELECT "column", COUNT(value) AS non_null, COUNT(DISTINCT value) AS n_distinct,
             {R("AVG(CASE WHEN TRY_STRPTIME(value, '%Y-%m-%d') IS NOT NULL THEN 1.0 ELSE 0.0 END)", 4)} AS date_parse_rate
      FROM u GROUP BY "column")
SELECT *, CASE WHEN "column" = 'o_totalprice' THEN 'numeric' WHEN date_parse_rate > 0.8 THEN 'date'
  WHEN n_distinct <= 7 THEN 'category_small' WHEN n_distinct <= 15 THEN 'category_medium' ELSE 'text' END AS kind
FROM p"""
    q["a11_staged_correction"] = f"""{mart('model')}, s AS (SELECT flight_id, {est.replace('WHEN cancelled', 'WHEN f.cancelled')} AS fn FROM f)
SELECT f.flight_id, {R('COALESCE(s.fn, f.fuel_burn)', 4)} AS fuel_burn, {R('COALESCE(s.fn * 3.16::DOUBLE, f.co2)', 4)} AS co2
FROM f LEFT JOIN s ON f.flight_id = s.flight_id"""
    q["c5_not_in"] = """
SELECT s_suppkey, s_name FROM supplier
WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900.0)"""
    q["c7_name_patterns"] = """
SELECT p_type, COUNT(*) FILTER (WHERE p_name LIKE 'small%') AS prefix_small,
  COUNT(*) FILTER (WHERE p_name LIKE '%widget') AS suffix_widget,
  COUNT(*) FILTER (WHERE p_name LIKE '%red%') AS contains_red,
  COUNT(*) FILTER (WHERE p_name LIKE 'a%' OR p_name LIKE 'b%') AS a_or_b
FROM part GROUP BY p_type"""
    q["d4_left_join_default"] = f"""{mart()},
ls AS (SELECT p_partkey, p_brand FROM part WHERE p_size > 25)
SELECT COALESCE(ls.p_brand, 'Unlisted') AS maker, COUNT(*) AS flights FROM f LEFT JOIN ls ON f.tail_id = ls.p_partkey
GROUP BY 1"""
    q["b17_patched_catalogue"] = """
SELECT p_partkey AS model_id, CASE WHEN p_partkey BETWEEN 0 AND 15 THEN 'PATCHED' ELSE p_brand END AS maker,
  CASE WHEN p_partkey BETWEEN 0 AND 15 THEN 1000.0 + p_partkey ELSE p_retailprice END AS mtow FROM part"""
    q["d18_numeric_key_join"] = """
SELECT c_mktsegment, COUNT(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""
    return q


def _sq(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


# The schema that generated SQL must respect, a table a line.
SCHEMA_TEXT = """
CONTINENTE Nombre_Continente
MODELO_DE_AVION acft_icao Fabricante Modelo Tipo_Motor Num_Motores Peso_Maximo_Despegue_lbs
RUTA RutaID Distance DistanceGroup
ALIANZA ID_ALIANZA Operated_or_Branded_Code_Share_Partners
RED_DE_AEROLINEAS ID_Red DOT_ID_Marketing_Airline Marketing_Airline_Network IATA_Code_Marketing_Airline
BLOQUE_HORARIO ID_Bloque DepTimeBlk ArrTimeBlk
TAXI ID_TAXI TaxiOut TaxiIn
DETALLE_RETRASOS ID_Detalle_R DepDelay DepDelayMinutes DepDel15 DepartureDelayGroups ArrDelay ArrDelayMinutes ArrDel15 ArrivalDelayGroups
WAC WAC_ID Nombre_Continente
AEROLINEA DOT_ID_Operating_Airline IATA_Code_Operating_Airline Operating_Airline ID_ALIANZA ID_Red
PROGRAMACION ID_Programacion CRSDepTime CRSArrTime CRSElapsedTime FlightDate Year Quarter Month DayofMonth DayOfWeek RutaID ID_Bloque
CRONOMETRIA_REAL ID_CR DepTime ArrTime AirTime WheelsOff WheelsOn ActualElapsedTime ID_Detalle_R ID_TAXI
ESTADO ID_Estado StateFips StateName StateCode WAC_ID
AERONAVE Tail_Number acft_icao DOT_ID_Operating_Airline
CIUDAD CityMarketID CityName ID_Estado
AEROPUERTO AirportID IATA_Code SeqID CityMarketID Nombre_Aeropuerto Latitud Longitud Elevacion_ft
VUELO ID_Vuelo FlightDate Flight_Number_Marketing_Airline Flight_Number_Operating_Airline Tail_Number OriginAirportID DestAirportID
RESULTADO ID_Resultado ID_Vuelo ID_CR ID_Programacion Cancelled Diverted fuel_burn co2 DivAirportLandings
"""


def corpus() -> dict[str, str]:
    from contrail.plans.corpus_jobs import TEMPLATES      # the input of the jobs, not their result
    q: dict[str, str] = {}
    vals = ",\n  ".join("(" + ", ".join(_sq(v) for v in t) + ")" for t in TEMPLATES)
    expand = f"""t(template_id, family, param_kind, question, sqltext) AS (VALUES
  {vals}),
p AS (SELECT DISTINCT * FROM (
  SELECT 'airline' AS param_kind, s_name AS value FROM supplier
  UNION ALL SELECT 'continent', r_name FROM region
  UNION ALL SELECT 'year', CAST(year(o_orderdate) AS VARCHAR) FROM orders
  UNION ALL SELECT 'month', CAST(month(o_orderdate) AS VARCHAR) FROM orders)),
e AS (SELECT family, template_id, replace(question, '{{v}}', value) AS instruction, '' AS input,
             replace(sqltext, '{{v}}', value) AS output FROM p JOIN t ON p.param_kind = t.param_kind),
dd AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY instruction, output ORDER BY family, template_id) AS rn
       FROM e) WHERE rn = 1),
cap AS (SELECT family, template_id, instruction, input, output FROM (
       SELECT *, ROW_NUMBER() OVER (PARTITION BY family ORDER BY md5('42|' || instruction), instruction) AS rc
       FROM dd) WHERE rc <= 200),
sp AS (SELECT family, instruction, output,
       CASE WHEN ROW_NUMBER() OVER (PARTITION BY family ORDER BY md5('43|' || instruction), instruction)
                 <= greatest(1, floor(COUNT(*) OVER (PARTITION BY family) * 0.1)) THEN 'val' ELSE 'train' END AS split
       FROM dd)"""
    q["o1_expand_templates"] = f"WITH {expand} SELECT * FROM e"
    q["o2_dedupe_corpus"] = f"WITH {expand} SELECT family, template_id, instruction, input, output FROM dd"
    q["o3_cap_per_family"] = f"WITH {expand} SELECT * FROM cap"
    q["o4_stratified_split"] = f"WITH {expand} SELECT * FROM sp"
    q["o5_family_distribution"] = f"""WITH {expand} SELECT family, COUNT(*) AS "rows",
  {CNT("split = 'train'")} AS train, {CNT("split = 'val'")} AS val FROM sp GROUP BY family"""
    drafts = expand + """,
dr AS (SELECT family, template_id, instruction, CASE substr(md5(instruction), 1, 1)
         WHEN '0' THEN replace(output, 'RESULTADO', 'DETALLE_VUELO')
         WHEN '1' THEN replace(output, 'R.Cancelled', 'R.Distance')
         WHEN '2' THEN replace(output, 'V.ID_Vuelo', 'Z.ID_Vuelo')
         WHEN '3' THEN replace(output, 'JOIN PROGRAMACION P', 'JOIN TAXI P')
         WHEN '4' THEN replace(output, 'JOIN WAC W', 'JOIN PAIS W')
         WHEN '5' THEN replace(output, 'VUELO V', 'VUELOS V')
         ELSE output END AS output FROM dd)"""

    def has(x: str) -> str:
        return f"contains(output, '{x}')"

    timing = f"NOT {has('CRONOMETRIA_REAL')}"
    gate = {
        "wrong_table_detalle_vuelo": has("DETALLE_VUELO"), "wrong_table_detalles_vuelo": has("DETALLES_VUELO"),
        "wrong_table_taxi_tx": has("TAXI_TX"), "wrong_table_tbl_taxi": has("TBL_TAXI"),
        "route_distance_on_result": f"({has(' R.Distance ')} OR {has('(R.Distance)')})",
        "missing_column_carrierdelay": has("CarrierDelay"), "missing_column_weatherdelay": has("WeatherDelay"),
        "missing_column_nasdelay": has("NASDelay"), "missing_column_securitydelay": has("SecurityDelay"),
        "missing_column_lateaircraftdelay": has("LateAircraftDelay"),
        "avg_of_signed_arrival_delay": f"({has('AVG(ArrDelay)')} OR {has('AVG(DR.ArrDelay)')})",
        "elevation_without_unit": f"({has('Elevacion ')} OR {has('Elevacion)')})",
        "english_continent": "(" + " OR ".join(f"contains(output, '''{c}''')" for c in ("Europe", "South America", "North America")) + ")",
        "delays_without_timing": f"{has('DETALLE_RETRASOS')} AND {timing}",
        "taxi_without_timing": f"{has('JOIN TAXI ')} AND {timing}",
        "continent_without_aeropuerto": f"{has('CONTINENTE')} AND NOT {has('AEROPUERTO')}",
        "continent_without_ciudad": f"{has('CONTINENTE')} AND NOT {has('CIUDAD')}",
        "continent_without_estado": f"{has('CONTINENTE')} AND NOT {has('ESTADO')}",
        "continent_without_wac": f"{has('CONTINENTE')} AND NOT {has('WAC')}",
    }
    counted = ", ".join(f"{CNT(c)} AS {n}" for n, c in gate.items())
    for name, statements in (("o6_integrity_gate", "dd"), ("o6_gate_on_drafts", "dr")):
        q[name] = f"""WITH {drafts}, g AS (SELECT COUNT(*) AS "rows", {counted} FROM {statements})
SELECT *, {' + '.join(gate)} AS violations FROM g"""
    passed = CNT("CASE family WHEN 'geography' THEN contains(output, 'JOIN WAC') AND contains(output, 'CONTINENTE') "
                 "AND NOT contains(output, 'PAIS') WHEN 'emissions' THEN contains(output, 'R.Cancelled = 0') "
                 "AND NOT contains(output, 'DETALLE_VUELO') "
                 "ELSE contains(output, 'DETALLE_RETRASOS') AND NOT contains(output, 'DETALLE_VUELO') END")
    q["o7_scored_drafts"] = f"""WITH {drafts}
SELECT family, COUNT(*) AS cases, {passed} AS passed
FROM dr WHERE family IN ('geography', 'emissions', 'delays') GROUP BY family"""

    sch = ", ".join(f"({_sq(line.split()[0])}, {_sq(c.lower())})" for line in SCHEMA_TEXT.strip().split(chr(10))
                    for c in line.split()[1:])

    def problems(statements: str) -> str:
        return rf"""{drafts},
sch(table_name, column_name) AS (VALUES {sch}),
tk AS (SELECT id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos FROM (
         SELECT template_id || '|' || instruction AS id,
                regexp_extract_all(output, '''[^'']*''|[A-Za-z0-9_]+|[^\sA-Za-z0-9_]') AS t FROM {statements})),
w AS (SELECT id, pos, tok, lead(tok, 1) OVER o AS one, lead(tok, 2) OVER o AS two FROM tk
      WINDOW o AS (PARTITION BY id ORDER BY pos)),
src AS (SELECT id, pos, one AS src, two AS alias FROM w WHERE tok IN ('FROM', 'JOIN')),
good AS (SELECT id, alias, arg_max(src, pos) AS tbl FROM src
         WHERE src IN (SELECT table_name FROM sch) GROUP BY id, alias),
used AS (SELECT id, tok AS alias, two AS col FROM w WHERE one = '.' AND length(tok) <= 5),
pr AS (SELECT id, 'unknown table: ' || src AS problem FROM src WHERE src NOT IN (SELECT table_name FROM sch)
       UNION ALL
       SELECT u.id, CASE WHEN g.tbl IS NULL THEN 'undeclared alias: ' || u.alias || '.' || u.col
                         ELSE 'unknown column: ' || u.alias || '.' || u.col || ' -> ' || g.tbl END
       FROM used u LEFT JOIN good g ON g.id = u.id AND g.alias = u.alias
       LEFT JOIN sch s ON s.table_name = g.tbl AND s.column_name = lower(u.col)
       WHERE s.table_name IS NULL)"""

    q["o8_schema_problems"] = f"WITH {problems('dr')} SELECT id, problem FROM pr"
    q["o8_problem_frequency"] = f"WITH {problems('dr')} SELECT problem, COUNT(*) AS occurrences FROM pr GROUP BY problem"
    q["o8_reference_summary"] = f"""WITH {problems('dd')}
SELECT (SELECT COUNT(*) FROM dd) AS statements, (SELECT COUNT(*) FROM pr) AS problems"""

    # a reply's statement is known from how the reply was made
    digit = "substr(md5(instruction), 1, 1)"
    code = (f"CASE WHEN {digit} < '8' THEN rtrim(output, ';') WHEN {digit} < 'a' THEN NULL "
            "ELSE 'CREATE PROCEDURE p AS' || chr(10) || 'BEGIN' || chr(10) || '  ' || output || chr(10) || 'END' END")
    q["o9_extract_code"] = f"WITH {expand} SELECT template_id, instruction, {code} AS code FROM dd"
    q["o10_statement_kinds"] = f"""WITH {expand}
SELECT CASE WHEN {digit} < '8' THEN 'QUERY' WHEN {digit} >= 'a' THEN 'DDL' END AS kind,
       COUNT(*) AS replies FROM dd GROUP BY 1"""
    q["o11_rewritten_drafts"] = f"""WITH {drafts}
SELECT template_id, instruction,
       replace(replace(replace(replace(replace(output, 'DETALLE_VUELO', 'DETALLE_RETRASOS'), 'VUELOS V', 'VUELO V'),
         '''EUROPE''', '''Europa'''), '''ASIA''', '''Asia'''), '''AFRICA''', '''Africa''') AS output,
       CASE WHEN contains(output, 'JOIN PAIS W') THEN 'PAIS' END AS invented FROM dr"""
    flags = {
        "delays_without_timing": f"{has('DETALLE_RETRASOS')} AND {timing}",
        "taxi_without_timing": f"{has('JOIN TAXI ')} AND {timing}",
        "broken_geo_chain": f"{has('CONTINENTE')} AND NOT ({has('AEROPUERTO')} AND {has('CIUDAD')} AND {has('ESTADO')} AND {has('WAC')})",
        "distance_on_result": has(" R.DISTANCE "),
        "aircraft_without_flight": f"{has('AERONAVE')} AND NOT {has('VUELO')}",
        "route_without_schedule": f"{has('RUTA')} AND NOT {has('PROGRAMACION')}",
        "avg_signed_delay": f"({has('AVG(ARRDELAY)')} OR {has('AVG(DR.ARRDELAY)')})",
    }
    q["o12_flag_counts"] = (f"WITH {drafts} SELECT {', '.join(f'{CNT(c)} AS {n}' for n, c in flags.items())} "
                            "FROM (SELECT upper(output) AS output FROM dr)")
    broken = f"{has('DETALLE_RETRASOS')} AND {timing}"
    fixed = f"({has('JOIN DETALLE_RETRASOS ')} OR {has('JOIN TAXI ')}) AND {timing} AND {has('RESULTADO')}"
    q["o12_repaired_chains"] = f"""WITH {expand},
x AS (SELECT replace(output, 'JOIN CRONOMETRIA_REAL CR ON R.ID_CR = CR.ID_CR ', '') AS output FROM dd)
SELECT {CNT(broken)} AS broken, {CNT(f'{broken} AND NOT ({fixed})')} AS still_broken, {CNT(fixed)} AS changed FROM x"""
    q["o13_strip_comments"] = f"WITH {expand} SELECT template_id, instruction, output AS clean_text FROM dd"
    q["o15_bodies"] = f"""WITH {expand}
SELECT template_id, instruction, rtrim(output, ';') || CASE WHEN family < 'e' THEN '' ELSE ' AND 1 = NULL' END AS body FROM dd"""
    q["o2_dedupe_documents"] = """
SELECT doc_id, source FROM (SELECT doc_id, source, ROW_NUMBER() OVER (PARTITION BY text ORDER BY doc_id) AS rn
FROM documents) WHERE rn = 1"""
    return q


def load() -> dict[str, str]:
    """The load's counts, from the flights themselves: what a table must hold is said by its natural key."""
    q: dict[str, str] = {}
    base = f"""{mart('airline', 'dest')},
x AS (SELECT * FROM f WHERE NOT cancelled),
cat AS (SELECT p_partkey, p_retailprice FROM part WHERE p_size >= 3),
air AS (SELECT DISTINCT tail_id, airline_id FROM x),
ok AS (SELECT tail_id, airline_id FROM air JOIN cat ON tail_id = p_partkey),
geo AS (SELECT DISTINCT origin_airport_id AS id, origin_airport AS city, origin_state AS state, 0 AS role FROM x
        UNION SELECT DISTINCT dest_airport_id, dest_airport, dest_state, 1 FROM x),
good AS (SELECT f.* FROM f JOIN ok USING (tail_id, airline_id))"""
    # natural keys by the columns that determine them
    keys = {"RUTA": "floor(distance / 100), distance_group", "BLOQUE_HORARIO": "day_of_week, quarter",
            "TAXI": "taxi_out, taxi_in", "DETALLE_RETRASOS": "dep_delay, arr_delay",
            "PROGRAMACION": "floor(crs_elapsed), flight_date, floor(distance / 100), distance_group",
            "CRONOMETRIA_REAL": "floor(actual_elapsed), dep_delay, arr_delay, taxi_out, taxi_in"}
    n = {t: f"(SELECT COUNT(*) FROM (SELECT DISTINCT {k} FROM x))" for t, k in keys.items()}
    n |= {"ALIANZA": "(SELECT COUNT(DISTINCT alliance_name) FROM x)", "RED_DE_AEROLINEAS": "(SELECT COUNT(DISTINCT network_id) FROM x)",
          "ESTADO": "(SELECT COUNT(DISTINCT state) FROM geo)", "CONTINENTE": "(SELECT COUNT(DISTINCT state) FROM geo)",
          "WAC": "(SELECT COUNT(DISTINCT state) FROM geo)", "MODELO_DE_AVION": "(SELECT COUNT(*) FROM cat)",
          "AEROLINEA": "(SELECT COUNT(DISTINCT airline_id) FROM x)", "CIUDAD": "(SELECT COUNT(DISTINCT id) FROM geo)",
          "AEROPUERTO": "(SELECT COUNT(DISTINCT id) FROM geo)", "AERONAVE": "(SELECT COUNT(*) FROM ok)"}
    lost = "(SELECT COUNT(*) FROM f) - (SELECT COUNT(*) FROM good)"
    grounded = "(SELECT COUNT(*) FROM air) - (SELECT COUNT(*) FROM ok)"

    def counted(rows: list[tuple[str, str, str]]) -> str:
        return base + " SELECT * FROM (" + " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, '{why}' AS reason, {c} AS rows" for t, why, c in rows) + ") WHERE rows > 0"

    natural = ["CONTINENTE", "MODELO_DE_AVION", "WAC", "AEROLINEA", "AERONAVE", "CIUDAD", "AEROPUERTO"]
    q["m1_natural_dimensions"] = counted([(t, "loaded", n[t]) for t in natural]
                                         + [("AERONAVE", "no MODELO_DE_AVION acft_icao", grounded)])
    q["m3_facts"] = counted([(t, "loaded", "(SELECT COUNT(*) FROM good)") for t in ("VUELO", "RESULTADO")]
                            + [("VUELO", "no AERONAVE Tail_Number", lost), ("RESULTADO", "no VUELO ID_Vuelo", lost)])
    surrogate = [*keys, "ALIANZA", "RED_DE_AEROLINEAS", "ESTADO"]
    q["m2_surrogate_dimensions"] = base + " " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {n[t]} AS rows, {n[t]} AS distinct_keys, 1 AS min_key, {n[t]} AS max_key" for t in surrogate)
    every = f"(SELECT COUNT(*) FROM (SELECT DISTINCT {keys['DETALLE_RETRASOS']} FROM f))"
    known = n["DETALLE_RETRASOS"]
    q["m2_second_load"] = (f"{base} SELECT {every} AS rows, {every} AS max_key, {every} AS distinct_keys, "
                           f"{known} AS known, {known} AS kept")
    rejects = {"AERONAVE": grounded, "VUELO": lost, "RESULTADO": lost}
    q["a8_key_report"] = base + " " + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, 0 AS repeated_keys, 0 AS orphans, {rejects.get(t, '0')} AS rejected"
        for t in [*natural, *surrogate, "VUELO", "RESULTADO"])
    found = {t: f"(SELECT COUNT(*) FROM f WHERE ({k}) IN (SELECT ({k}) FROM x))" for t, k in keys.items()}
    q["d13_six_lookups"] = (base + ", l AS (" + " UNION ALL ".join(
        f"SELECT '{t}' AS lookup, (SELECT COUNT(*) FROM f) AS rows, {c} AS matched" for t, c in found.items())
        + f") SELECT *, {R('matched * 100.0 / rows', 4)} AS coverage_pct FROM l")
    q["d14_tail_model"] = f"""{base}
SELECT COUNT(*) AS flights, COUNT(air.tail_id) AS with_aircraft, COUNT(CASE WHEN air.tail_id IS NOT NULL THEN p_partkey END) AS with_model,
       {R('AVG(CASE WHEN air.tail_id IS NOT NULL THEN p_retailprice END)', 2)} AS mean_mtow
FROM f LEFT JOIN air USING (tail_id, airline_id) LEFT JOIN cat ON f.tail_id = p_partkey"""
    est = (f"CASE WHEN cancelled THEN 0.0::DOUBLE WHEN mtow > 0 AND crs_elapsed > 0 THEN "
           f"({FACTOR_SQL}) * mtow * (crs_elapsed / 60.0 * 0.030 + 0.012) END")
    fixed = f"""{mart('airline', 'dest', 'model')},
x AS (SELECT * FROM f WHERE NOT cancelled),
ok AS (SELECT DISTINCT tail_id, airline_id FROM x WHERE engines >= 3),
good AS (SELECT f.* FROM f JOIN ok USING (tail_id, airline_id)),
s AS (SELECT flight_id, {est} AS fn FROM f WHERE year(flight_date) = 1995 AND day(flight_date) = 1),
n AS (SELECT good.*, COALESCE(s.fn, fuel_burn) AS fuel_1, COALESCE(s.fn * 3.16::DOUBLE, co2) AS co2_1
      FROM good LEFT JOIN s ON s.flight_id = good.flight_id)"""
    buckets = "(SELECT COUNT(DISTINCT left(md5(flight_id), 2)) FROM s)"
    changed = "(fuel_1 IS DISTINCT FROM fuel_burn OR co2_1 IS DISTINCT FROM co2)"
    q["a11_stored_correction"] = f"""{fixed}
SELECT COUNT(*) AS rows, {R('SUM(fuel_1)', 2)} AS fuel, {R('SUM(co2_1)', 2)} AS co2, {buckets} AS buckets FROM n"""
    q["a10_restored"] = f"""{fixed}
SELECT COUNT(*) AS rows, 0 AS differing, {CNT(changed)} AS corrected, {buckets} AS buckets FROM n"""
    q["a13_correction_report"] = f"""{fixed}
SELECT flight_date AS "FlightDate", COUNT(*) AS changed, {R('AVG(fuel_burn)', 4)} AS fuel_before, {R('AVG(fuel_1)', 4)} AS fuel_after,
       {R('AVG(co2)', 4)} AS co2_before, {R('AVG(co2_1)', 4)} AS co2_after
FROM n WHERE {changed} GROUP BY flight_date"""
    q["m5_city_state"] = f"""{base},
o AS (SELECT * FROM geo WHERE role = 0), d AS (SELECT * FROM geo WHERE role = 1),
c AS (SELECT coalesce(o.city, d.city) AS city, d.state AS dest_state,
      CASE WHEN o.id IS NULL THEN d.state WHEN length(o.city) % 2 = 0 THEN o.state END AS state_before
      FROM o FULL JOIN d ON o.id = d.id)
SELECT city, state_before, coalesce(state_before, dest_state) AS state_after FROM c"""
    return q


def ml() -> dict[str, str]:
    q: dict[str, str] = {}
    target = f"({FACTOR_SQL}) * mtow * (minutes / 60.0 * 0.030 + 0.012)"
    ts = f"""{mart('model')},
b AS (SELECT flight_id, CAST(model_id AS VARCHAR) AS model, maker, engine_type, distance AS miles,
             crs_elapsed AS minutes, mtow, CAST(engines AS DOUBLE) AS engines FROM f WHERE NOT cancelled),
t AS (SELECT *, CASE WHEN mtow > 0 AND minutes > 0 THEN {target} END AS target FROM b),
d AS (SELECT *, CASE WHEN substr(md5(flight_id), 1, 2) < 'cd' THEN 'train' ELSE 'test' END AS split
      FROM t WHERE target IS NOT NULL AND target / NULLIF(minutes, 0) BETWEEN 0.3 AND 2000)"""
    q["n1_training_summary"] = f"""{ts}
SELECT split, COUNT(*) AS "rows", {R('AVG(target)', 4)} AS mean_target, COUNT(DISTINCT model) AS models
FROM d GROUP BY split"""
    def metrics(pred: str, name: str) -> str:
        return f"""SELECT COUNT(*) AS n, {R('AVG(abs(target - prediction))', 4)} AS mae,
  {R('sqrt(AVG((target - prediction) * (target - prediction)))', 4)} AS rmse,
  {R('1 - SUM((target - prediction) * (target - prediction)) / (COUNT(*) * var_pop(target))', 6)} AS r2,
  {R('AVG(abs((target - prediction) / NULLIF(target, 0))) * 100.0', 4)} AS mape, '{name}' AS baseline
FROM {pred}"""
    q["n9_baseline_metrics"] = f"""{ts},
tr AS (SELECT * FROM d WHERE split = 'train'), te AS (SELECT * FROM d WHERE split = 'test'),
gm AS (SELECT model, AVG(target) AS gm FROM tr GROUP BY model), gl AS (SELECT AVG(target) AS gl FROM tr),
p1 AS (SELECT te.target, COALESCE(gm.gm, gl.gl) AS prediction FROM te LEFT JOIN gm ON te.model = gm.model CROSS JOIN gl),
co AS (SELECT regr_slope(target, miles) AS a, regr_intercept(target, miles) AS b FROM tr),
p2 AS (SELECT te.target, a * te.miles + b AS prediction FROM te CROSS JOIN co)
{metrics('p1', 'model_mean')}
UNION ALL
{metrics('p2', 'distance_line')}"""
    q["n13_calibration"] = f"""{ts}
SELECT maker, COUNT(*) AS flights, {R('AVG(target)', 4)} AS mean_fuel FROM d GROUP BY maker"""
    return q


def streaming() -> dict[str, str]:
    return {
        "p1_stream_dedupe": """
SELECT DISTINCT user_id, event_type, date_trunc('minute', ts) AS minute FROM events""",
        "p2_stream_daily_totals": """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, COUNT(*) AS events,
  CAST(SUM(CAST(value AS DECIMAL(28,2))) AS DOUBLE) AS value_sum FROM events GROUP BY ALL""",
        "p3_stream_latest_upsert": """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    }


def all_queries() -> dict[str, str]:
    q = {}
    q.update(reports())
    q.update(dashboard())
    q.update(families())
    q.update(views())
    q.update(etl())
    q.update(load())
    q.update(corpus())
    q.update(ml())
    q.update(streaming())
    return q
