"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL is written in a different shape from the Spark plans: occupancy is
an inequality join of probes against intervals (not a prefix sum), splits
recompute the md5 draw, statistics are scalar subqueries.  Only the stand-in
source rows are shared (rendered from the same formulas, see
``pushback.sources.adapter``).  Parameters are the library defaults.
"""

from __future__ import annotations

from pushback.sources import adapter
from pushback.sources.flight_tables import FLIGHT_OUTPUT_COLUMNS

AIRPORT = "KDFW"
S = "TIMESTAMP '2019-06-01 12:00:00'"
E = "TIMESTAMP '2019-06-10 12:00:00'"
SEED = "1234"
RAMP = "actual_departure_ramp_taxi_time"
FULL = "actual_departure_full_taxi_time"
AMA = "actual_departure_ama_taxi_time"
COUNTS = ["arr_runway_AMA_count", "AMA_gate_count", "dep_stand_AMA_count", "dep_AMA_runway_count",
          "total_arrivals_on_surface", "total_departures_on_surface", "total_flights_on_surface"]


def secs(a: str, b: str) -> str:
    return f"(CAST(date_diff('microsecond', {a}, {b}) AS DOUBLE) / 1000000.0)"


def u(key: str, salt: str) -> str:
    return (f"(CAST(CAST('0x' || substr(md5(concat_ws(':', CAST({key} AS VARCHAR), '{SEED}', '{salt}')), 1, 8) "
            f"AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE))")


def missing(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' OR lower(CAST({c} AS VARCHAR)) = 'nan')"


FS_COLS = [
    "gufi", "carrier", "acid", "departure_stand_initial_time", "aircraft_type",
    "arrival_aerodrome_icao_name", "departure_aerodrome_icao_name",
]


def _ctes(airports: tuple[str, ...] = (AIRPORT,)) -> list[tuple[str, str]]:
    c: list[tuple[str, str]] = []
    aps = ", ".join(f"('{a}')" for a in airports)
    arr_q = (f"(f.arrival_stand_actual_time BETWEEN {S} AND {E} OR f.arrival_runway_actual_time BETWEEN {S} AND {E}"
             f" OR f.arrival_movement_area_actual_time BETWEEN {S} AND {E})")
    c.append(("fs", f"""
SELECT
  {secs('arrival_movement_area_actual_time', 'arrival_stand_actual_time')} AS actual_arrival_ramp_taxi_time,
  {secs('arrival_runway_actual_time', 'arrival_movement_area_actual_time')} AS actual_arrival_ama_taxi_time,
  {secs('departure_stand_actual_time', 'departure_movement_area_actual_time')} AS actual_departure_ramp_taxi_time,
  {secs('departure_movement_area_actual_time', 'departure_runway_actual_time')} AS actual_departure_ama_taxi_time,
  {secs('departure_stand_actual_time', 'departure_runway_actual_time')} AS actual_departure_full_taxi_time,
  {', '.join(FS_COLS)},
  COALESCE(arrival_aerodrome_icao_name = a.ap, false) AS isarrival,
  COALESCE(departure_aerodrome_icao_name = a.ap, false) AS isdeparture,
  COALESCE(arrival_stand_actual, arrival_stand_user, arrival_stand_airline) AS arrival_stand_actual,
  arrival_stand_actual_time, arrival_stand_airline_time,
  COALESCE(arrival_spot_actual, arrival_spot_user, arrival_spot_airline) AS arrival_spot_actual,
  arrival_movement_area_actual_time,
  COALESCE(arrival_runway_actual, arrival_runway_user, arrival_runway_assigned, arrival_runway_airline)
    AS arrival_runway_actual,
  arrival_runway_actual_time,
  COALESCE(departure_stand_actual, departure_stand_user, departure_stand_airline) AS departure_stand_actual,
  departure_stand_actual_time, departure_stand_airline_time,
  COALESCE(departure_spot_actual, departure_spot_user, departure_spot_airline) AS departure_spot_actual,
  departure_movement_area_actual_time,
  COALESCE(departure_runway_actual, departure_runway_user, departure_runway_assigned, departure_runway_airline)
    AS departure_runway_actual,
  departure_runway_actual_time,
  a.ap AS airport_icao
FROM flights_src f CROSS JOIN (VALUES {aps}) a(ap)
WHERE (f.departure_aerodrome_icao_name = a.ap AND f.departure_runway_actual_time BETWEEN {S} AND {E})
   OR (f.arrival_aerodrome_icao_name = a.ap AND {arr_q})"""))
    c.append(("rw", f"""
SELECT gufi, departure_runway_actual_time, departure_runway_actual, arrival_runway_actual_time,
       arrival_runway_actual, a.ap AS airport_icao
FROM runways_src r CROSS JOIN (VALUES {aps}) a(ap)
WHERE (r.departure_aerodrome_iata_name = substring(a.ap, 2, 3)
       AND r.departure_runway_actual_time BETWEEN {S} AND {E})
   OR (r.arrival_aerodrome_iata_name = substring(a.ap, 2, 3)
       AND r.arrival_runway_actual_time BETWEEN {S} AND {E} AND r.points_on_runway = true)"""))
    c.append(("est", f"""
SELECT gufi, isarrival, isdeparture, acid, departure_stand_initial_time, departure_aerodrome_icao_name,
       arrival_aerodrome_icao_name, undelayed_departure_ramp_transit_time, undelayed_departure_ama_transit_time,
       undelayed_departure_total_transit_time
FROM estimates_src
WHERE (isdeparture AND departure_runway_actual_time BETWEEN {S} AND {E})
   OR (isarrival AND arrival_stand_actual_time BETWEEN {S} AND {E})"""))
    # departures with the bounds of their taxi-out first; then their positions inside the bounds
    c.append(("sf_flight", f"""
SELECT gufi, departure_movement_area_actual_time AS taxi_from, departure_runway_actual_time AS taxi_to
FROM flights_src
WHERE departure_aerodrome_icao_name IN (SELECT ap FROM (VALUES {aps}) v(ap))
  AND departure_runway_actual_time >= {S} AND departure_runway_actual_time <= {E}"""))
    c.append(("sf_seen", f"""
SELECT gufi, "timestamp" AS seen, CASE WHEN position_speed >= 4.0 THEN 1.0 WHEN position_speed < 4.0 THEN 0.0 END AS fast
FROM positions_src
WHERE system_id = 'ASDEX' AND {S} - "timestamp" < INTERVAL 1 HOUR AND "timestamp" - {E} < INTERVAL 1 HOUR"""))
    c.append(("sf", """
SELECT f.gufi, sum(s.fast) / count(s.fast) AS fraction_speed_gte_threshold
FROM sf_flight f, sf_seen s WHERE s.gufi = f.gufi AND s.seen > f.taxi_from AND s.seen < f.taxi_to
GROUP BY f.gufi"""))
    c.append(("rwf", """
SELECT r.*, departure_runway_actual IS NOT NULL AS r_isdeparture, arrival_runway_actual IS NOT NULL AS r_isarrival
FROM rw r"""))
    c.append(("j2a", """
SELECT fs.* REPLACE (
  COALESCE(r.departure_runway_actual_time, fs.departure_runway_actual_time) AS departure_runway_actual_time,
  COALESCE(r.departure_runway_actual, fs.departure_runway_actual) AS departure_runway_actual,
  COALESCE(r.arrival_runway_actual_time, fs.arrival_runway_actual_time) AS arrival_runway_actual_time,
  COALESCE(r.arrival_runway_actual, fs.arrival_runway_actual) AS arrival_runway_actual)
FROM fs LEFT JOIN rwf r
  ON fs.airport_icao = r.airport_icao AND fs.gufi = r.gufi
 AND fs.isarrival = r.r_isarrival AND fs.isdeparture = r.r_isdeparture"""))
    c.append(("j2", f"""
SELECT * FROM fs WHERE airport_icao NOT IN (SELECT airport_icao FROM rw)
UNION ALL SELECT * REPLACE (
  floor({secs('departure_movement_area_actual_time', 'departure_runway_actual_time')})
    AS actual_departure_ama_taxi_time,
  floor({secs('departure_stand_actual_time', 'departure_runway_actual_time')}) AS actual_departure_full_taxi_time,
  regexp_replace(regexp_replace(arrival_runway_actual, '\\.0$', ''), '^0+', '') AS arrival_runway_actual,
  regexp_replace(regexp_replace(departure_runway_actual, '\\.0$', ''), '^0+', '') AS departure_runway_actual)
FROM j2a WHERE airport_icao IN (SELECT airport_icao FROM rw)"""))
    est_join = " AND ".join(f"x.{k} IS NOT DISTINCT FROM e.{k}" for k in
                            ["acid", "isarrival", "isdeparture", "departure_stand_initial_time",
                             "departure_aerodrome_icao_name", "arrival_aerodrome_icao_name"])
    c.append(("j3", f"""
SELECT x.*, e.gufi AS gufi_ffs, e.undelayed_departure_ramp_transit_time, e.undelayed_departure_ama_transit_time,
       e.undelayed_departure_total_transit_time
FROM j2 x LEFT JOIN est e ON {est_join}"""))
    first = ["departure_stand_initial_time", "departure_stand_actual_time", "departure_runway_actual_time",
             "arrival_runway_actual_time", "acid"]
    rest = [x for x in FLIGHT_OUTPUT_COLUMNS + ["gufi_ffs", "undelayed_departure_ramp_transit_time",
                                                "undelayed_departure_ama_transit_time",
                                                "undelayed_departure_total_transit_time"]
            if x not in first and x not in ("airport_icao", "gufi")]
    order = ", ".join(f"{x} ASC NULLS LAST" for x in first + rest)
    c.append(("w6", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY airport_icao, gufi ORDER BY {order}) AS rn
  FROM j3) WHERE rn = 1"""))
    # occupancy: intervals, probes, inequality join
    c.append(("iv0", """
SELECT airport_icao, gufi, 'arr_runway_AMA_count' AS series, arrival_runway_actual_time AS t_in,
       COALESCE(arrival_movement_area_actual_time, arrival_stand_actual_time,
                arrival_runway_actual_time + INTERVAL 3600 SECOND) AS t_out
FROM w6 WHERE isarrival AND arrival_runway_actual_time IS NOT NULL
UNION ALL
SELECT airport_icao, gufi, 'AMA_gate_count', arrival_movement_area_actual_time,
       COALESCE(arrival_stand_actual_time, arrival_movement_area_actual_time + INTERVAL 3600 SECOND)
FROM w6 WHERE isarrival AND arrival_movement_area_actual_time IS NOT NULL
UNION ALL
SELECT airport_icao, gufi, 'dep_stand_AMA_count', departure_stand_actual_time,
       COALESCE(departure_movement_area_actual_time, departure_runway_actual_time,
                departure_stand_actual_time + INTERVAL 3600 SECOND)
FROM w6 WHERE isdeparture AND departure_stand_actual_time IS NOT NULL
UNION ALL
SELECT airport_icao, gufi, 'dep_AMA_runway_count', departure_movement_area_actual_time,
       COALESCE(departure_runway_actual_time, departure_movement_area_actual_time + INTERVAL 3600 SECOND)
FROM w6 WHERE isdeparture AND departure_movement_area_actual_time IS NOT NULL"""))
    c.append(("iv", "SELECT * FROM iv0 WHERE t_out > t_in"))
    c.append(("firsts", """
SELECT airport_icao,
  min(CASE WHEN series = 'arr_runway_AMA_count' THEN t_in END) AS f_aa,
  min(CASE WHEN series = 'AMA_gate_count' THEN t_in END) AS f_ag,
  min(CASE WHEN series = 'dep_stand_AMA_count' THEN t_in END) AS f_ds,
  min(CASE WHEN series = 'dep_AMA_runway_count' THEN t_in END) AS f_da
FROM iv GROUP BY airport_icao"""))
    c.append(("probes", """
SELECT airport_icao, gufi, departure_stand_actual_time AS t FROM w6
WHERE isdeparture AND departure_stand_actual_time IS NOT NULL"""))
    c.append(("cnt", """
SELECT p.airport_icao, p.gufi, p.t,
  SUM(CASE WHEN iv.series = 'arr_runway_AMA_count' THEN 1 ELSE 0 END) AS n_aa,
  SUM(CASE WHEN iv.series = 'AMA_gate_count' THEN 1 ELSE 0 END) AS n_ag,
  SUM(CASE WHEN iv.series = 'dep_stand_AMA_count' THEN 1 ELSE 0 END) AS n_ds,
  SUM(CASE WHEN iv.series = 'dep_AMA_runway_count' THEN 1 ELSE 0 END) AS n_da
FROM probes p LEFT JOIN iv ON iv.airport_icao = p.airport_icao AND iv.t_in <= p.t AND iv.t_out > p.t
GROUP BY p.airport_icao, p.gufi, p.t"""))
    c.append(("occ0", """
SELECT c.airport_icao, c.gufi,
  CAST(CASE WHEN c.t >= f.f_aa THEN c.n_aa END AS BIGINT) AS arr_runway_AMA_count,
  CAST(CASE WHEN c.t >= f.f_ag THEN c.n_ag END AS BIGINT) AS AMA_gate_count,
  CAST(CASE WHEN c.t >= f.f_ds THEN c.n_ds END AS BIGINT) AS dep_stand_AMA_count,
  CAST(CASE WHEN c.t >= f.f_da THEN c.n_da END AS BIGINT) AS dep_AMA_runway_count,
  CAST(CASE WHEN c.t >= least(f.f_aa, f.f_ag) THEN c.n_aa + c.n_ag END AS BIGINT) AS total_arrivals_on_surface,
  CAST(CASE WHEN c.t >= least(f.f_ds, f.f_da) THEN c.n_ds + c.n_da END AS BIGINT) AS total_departures_on_surface
FROM cnt c LEFT JOIN firsts f ON f.airport_icao = c.airport_icao"""))
    c.append(("occ", "SELECT *, total_arrivals_on_surface + total_departures_on_surface AS total_flights_on_surface "
                     "FROM occ0"))
    tests = ", ".join(f"{u('w.gufi', f'cv{k}')} < 0.2 AS test_{k}" for k in range(9))
    c.append(("core", f"""
SELECT w.*, o.arr_runway_AMA_count, o.AMA_gate_count, o.dep_stand_AMA_count, o.dep_AMA_runway_count,
  o.total_arrivals_on_surface, o.total_departures_on_surface, o.total_flights_on_surface,
  {secs('w.departure_stand_actual_time', 'w.departure_runway_actual_time')} AS actual_departure_total_taxi_time,
  CASE WHEN {u('w.gufi', 'group')} < 0.2 THEN 'test' ELSE 'train' END AS "group",
  {tests}
FROM w6 w LEFT JOIN occ o ON o.airport_icao = w.airport_icao AND o.gufi = w.gufi
WHERE w.departure_runway_actual_time > {S} AND w.departure_runway_actual_time <= {E} AND w.isdeparture"""))
    # unimpeded ramp pipeline
    c.append(("r1", "SELECT * FROM core WHERE departure_stand_actual IS NOT NULL AND departure_runway_actual IS NOT NULL"))
    c += _iqr_band("r2", "r1", RAMP, 3.0)
    c.append(("r3", f"""
SELECT r2.* FROM r2 JOIN (
  SELECT airport_icao, quantile_cont(dep_stand_AMA_count, 0.3) AS a, quantile_cont(dep_AMA_runway_count, 0.4) AS b,
         quantile_cont(arr_runway_AMA_count, 0.6) AS c FROM r2 GROUP BY airport_icao) q USING (airport_icao)
WHERE dep_stand_AMA_count < a AND dep_AMA_runway_count < b AND arr_runway_AMA_count < c"""))
    c.append(("ramp", """
SELECT * FROM r3 WHERE departure_runway_actual_time IS NOT NULL
  AND departure_movement_area_actual_time IS NOT NULL AND departure_stand_actual_time IS NOT NULL"""))
    # baseline on the unimpeded ramp table: mean per (runway, terminal)
    c += _baseline_ctes("b", "ramp", "AVG")
    # unimpeded AMA pipeline
    c.append(("a1", "SELECT * FROM core WHERE departure_stand_actual IS NOT NULL AND departure_runway_actual IS NOT NULL"))
    c += _pct_band("a2", "a1", AMA, 0.0, 1.0)
    c.append(("a3", """
SELECT a.*, s.fraction_speed_gte_threshold FROM a2 a LEFT JOIN sf s ON a.gufi = s.gufi
WHERE a.departure_runway_actual_time IS NOT NULL AND a.departure_movement_area_actual_time IS NOT NULL
  AND a.departure_stand_actual_time IS NOT NULL"""))
    c.append(("ama", "SELECT *, COALESCE(fraction_speed_gte_threshold >= 0.9, false) AS unimpeded_AMA FROM a3"))
    # distributions input: busy terminals, training rows, padded gates
    c.append(("dt0", """
SELECT * REPLACE (CASE WHEN regexp_matches(departure_stand_actual, '^[A-K][0-9][A-Z]*$')
     THEN substring(departure_stand_actual, 1, 1) || '0' || substring(departure_stand_actual, 2)
     ELSE departure_stand_actual END AS departure_stand_actual),
  NULLIF(regexp_extract(departure_stand_actual, '^([A-K])[0-9]+', 1), '') AS terminal
FROM core"""))
    c.append(("dt", """
SELECT * FROM dt0 WHERE terminal IN (SELECT terminal FROM dt0 WHERE terminal IS NOT NULL
                                     GROUP BY terminal HAVING count(*) > 50)
  AND "group" = 'train'"""))
    feats = ["departure_stand_actual", "departure_runway_actual", "carrier"]
    for f in feats:
        c.append((f"ok_{f}", f"""
SELECT terminal, {f} FROM (
  SELECT terminal, {f}, count(*) AS n, max(count(*)) OVER (PARTITION BY terminal) AS top
  FROM dt WHERE {f} IS NOT NULL GROUP BY terminal, {f}) WHERE n >= top / 100.0"""))
    conds = " AND ".join(f"(d.terminal, d.{f}) IN (SELECT (terminal, {f}) FROM ok_{f})" for f in feats)
    c.append(("dsup", f"SELECT * FROM dt d WHERE {conds}"))
    return c


def _baseline_ctes(b: str, src: str, agg: str, y: str = RAMP, flag: str = "true") -> list[tuple[str, str]]:
    """Baseline CTEs ``{b}t, {b}train, {b}chk, {b}groups, {b}pred`` over table ``src``, all per airport.

    ``flag`` restricts the rows that values are fitted on, not the vocabulary.
    """
    agg_expr = f"AVG({y})" if agg == "AVG" else f"quantile_cont({y}, 0.5)"

    def known(col: str) -> str:
        return (f"(x.airport_icao, x.{col}) IN (SELECT (airport_icao, {col}) FROM {b}train WHERE NOT {missing(col)})")

    return [
        (f"{b}t", f"SELECT *, NULLIF(regexp_extract(departure_stand_actual, '^([A-K])[0-9]+', 1), '') AS terminal "
                  f"FROM {src}"),
        (f"{b}train", f"SELECT * FROM {b}t WHERE \"group\" = 'train'"),
        (f"{b}chk", f"""
SELECT x.*, (
  {missing('x.departure_stand_actual')} OR {missing('x.departure_runway_actual')}
  OR NOT {known('departure_stand_actual')} OR NOT {known('departure_runway_actual')}
) AS missing_core_features_baseline
FROM {b}t x"""),
        (f"{b}groups", f"""
SELECT airport_icao, departure_runway_actual, terminal, {agg_expr} AS predicted FROM {b}chk
WHERE "group" = 'train' AND {flag} AND NOT missing_core_features_baseline AND NOT COALESCE({y} < 0, false)
  AND departure_runway_actual IS NOT NULL AND terminal IS NOT NULL
GROUP BY airport_icao, departure_runway_actual, terminal"""),
        (f"{b}gdef", f"SELECT airport_icao, median(predicted) AS group_default FROM {b}groups GROUP BY airport_icao"),
        (f"{b}adef", f"SELECT airport_icao, median({y}) AS default_answer FROM {b}train WHERE {flag} GROUP BY airport_icao"),
        (f"{b}pred0", f"""
SELECT x.*, COALESCE(g.predicted, d.group_default) AS p0, a.default_answer
FROM {b}chk x LEFT JOIN {b}groups g
  ON x.airport_icao = g.airport_icao AND x.departure_runway_actual = g.departure_runway_actual AND x.terminal = g.terminal
LEFT JOIN {b}gdef d ON d.airport_icao = x.airport_icao LEFT JOIN {b}adef a ON a.airport_icao = x.airport_icao"""),
        (f"{b}pred", f"""
SELECT * EXCLUDE (p0, default_answer),
  CASE WHEN missing_core_features_baseline OR p0 < 0 OR p0 IS NULL THEN default_answer ELSE p0 END
    AS predicted_baseline
FROM {b}pred0"""),
    ]


def _iqr_band(name: str, src: str, col: str, n: float) -> list[tuple[str, str]]:
    pos = f"{name}_pos"
    return [(pos, f"SELECT * FROM {src} WHERE {col} > 0.0"),
            (f"{name}_q", f"SELECT airport_icao, quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.5) AS q2, "
                          f"quantile_cont({col}, 0.75) AS q3 FROM {pos} GROUP BY airport_icao"),
            (name, f"SELECT p.* FROM {pos} p JOIN {name}_q q USING (airport_icao) "
                   f"WHERE p.{col} > q.q2 - {n} * (q.q3 - q.q1) AND p.{col} < q.q2 + {n} * (q.q3 - q.q1)")]


def _pct_band(name: str, src: str, col: str, lo: float, hi: float) -> list[tuple[str, str]]:
    pos = f"{name}_pos"
    return [(pos, f"SELECT * FROM {src} WHERE {col} > 0.0"),
            (f"{name}_q", f"SELECT airport_icao, quantile_cont({col}, {lo}) AS lo, quantile_cont({col}, {hi}) AS hi "
                          f"FROM {pos} GROUP BY airport_icao"),
            (name, f"SELECT p.* FROM {pos} p JOIN {name}_q q USING (airport_icao) WHERE p.{col} > q.lo AND p.{col} < q.hi")]


def with_ctes(final: str, extra: list[tuple[str, str]] | None = None,
              airports: tuple[str, ...] = (AIRPORT,)) -> str:
    parts = [adapter.duck_views()] + [f"{n} AS ({body})" for n, body in _ctes(airports) + (extra or [])]
    recursive = any("(" in n for n, _ in extra or [])  # only recursive parts name their columns
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + final


def r6(c: str, alias: str | None = None) -> str:
    return f"round({c}, 6) AS {alias or c}"


FS_DOUBLES = ["actual_arrival_ramp_taxi_time", "actual_arrival_ama_taxi_time", "actual_departure_ramp_taxi_time",
              "actual_departure_ama_taxi_time", "actual_departure_full_taxi_time"]


def _replace_round(cols: list[str]) -> str:
    return "* REPLACE (" + ", ".join(r6(c) for c in cols) + ")"


def _metrics_sql(src: str, y: str, p: str) -> tuple[list[tuple[str, str]], str]:
    ctes = [("m_in", f"SELECT \"group\", CAST({y} AS DOUBLE) AS y, CAST({p} AS DOUBLE) AS p FROM {src} "
                     f"WHERE {y} IS NOT NULL AND {p} IS NOT NULL"),
            ("m_med", "SELECT \"group\", quantile_cont(y - p, 0.5) AS mr FROM m_in GROUP BY \"group\""),
            ("m_wide", """
SELECT m."group",
  AVG(abs(y - p)) AS mean_absolute_error,
  AVG(abs((y - p) / y)) * 100 AS mean_absolute_percentage_error,
  quantile_cont(abs((y - p) / y), 0.5) * 100 AS median_absolute_percentage_error,
  AVG(CASE WHEN abs(y - p) < 1 THEN 1.0 ELSE 0.0 END) * 100 AS percent_within_n,
  sqrt(AVG((y - p) * (y - p))) AS rmse,
  AVG(greatest(0.2 * (y - p), -0.8 * (y - p))) AS tilted_loss,
  AVG(CASE WHEN p < y THEN 1.0 ELSE 0.0 END) AS fraction_less_than_actual,
  quantile_cont(abs((y - p) - d.mr), 0.5) * 1.4826 AS MAD_residual,
  quantile_cont(y - p, 0.5) AS median_residual
FROM m_in m JOIN m_med d ON m."group" = d."group"
GROUP BY m."group\"""")]
    names = ["mean_absolute_error", "mean_absolute_percentage_error", "median_absolute_percentage_error",
             "percent_within_n", "rmse", "tilted_loss", "fraction_less_than_actual", "MAD_residual",
             "median_residual"]
    final = " UNION ALL ".join(
        f"SELECT \"group\", '{n}' AS metric, round(CAST({n} AS DOUBLE), 6) AS value FROM m_wide" for n in names)
    return ctes, final


def _cv_spread_sql() -> tuple[list[tuple[str, str]], str]:
    test_k = "CASE k " + " ".join(f"WHEN {k} THEN COALESCE(test_{k}, false)" for k in range(9)) + " END"
    ctes = [
        ("cv_rows", f"SELECT b.*, r.k, {test_k} AS in_test FROM bchk b CROSS JOIN range(9) r(k)"),
        ("cv_fit", "SELECT * FROM cv_rows WHERE NOT in_test"),
        ("cv_def", f"SELECT k, median({RAMP}) AS default_answer FROM cv_fit GROUP BY k"),
        ("cv_groups", f"""
SELECT k, departure_runway_actual, terminal, AVG({RAMP}) AS gp FROM cv_fit
WHERE NOT missing_core_features_baseline AND NOT COALESCE({RAMP} < 0, false)
  AND departure_runway_actual IS NOT NULL AND terminal IS NOT NULL
GROUP BY k, departure_runway_actual, terminal"""),
        ("cv_gdef", "SELECT k, median(gp) AS group_default FROM cv_groups GROUP BY k"),
        ("cv_pred", f"""
SELECT r.k, r.in_test, CAST(r.{RAMP} AS DOUBLE) AS y,
  CASE WHEN COALESCE(g.gp, gd.group_default) < 0 OR COALESCE(g.gp, gd.group_default) IS NULL
       THEN d.default_answer ELSE COALESCE(g.gp, gd.group_default) END AS p
FROM cv_rows r
LEFT JOIN cv_groups g ON g.k = r.k AND g.departure_runway_actual = r.departure_runway_actual
                      AND g.terminal = r.terminal
LEFT JOIN cv_gdef gd ON gd.k = r.k
LEFT JOIN cv_def d ON d.k = r.k
WHERE NOT r.missing_core_features_baseline"""),
        ("cv_in", "SELECT * FROM cv_pred WHERE y IS NOT NULL AND p IS NOT NULL"),
        ("cv_med", "SELECT k, in_test, quantile_cont(y - p, 0.5) AS mr FROM cv_in GROUP BY k, in_test"),
        ("cv_m", """
SELECT c.k, c.in_test,
  AVG(abs(y - p)) AS mean_absolute_error,
  sqrt(AVG((y - p) * (y - p))) AS rmse,
  quantile_cont(abs((y - p) - m.mr), 0.5) * 1.4826 AS MAD_residual,
  quantile_cont(y - p, 0.5) AS median_residual
FROM cv_in c JOIN cv_med m ON c.k = m.k AND c.in_test = m.in_test
GROUP BY c.k, c.in_test"""),
        ("cv_groups_present", "SELECT DISTINCT \"group\", \"group\" = 'test' AS in_test FROM ramp"),
    ]
    names = ["mean_absolute_error", "rmse", "MAD_residual", "median_residual"]
    final = " UNION ALL ".join(
        f"SELECT g.\"group\", '{n}_STD' AS metric, round(stddev_pop({n}), 6) AS value "
        f"FROM cv_groups_present g JOIN cv_m m ON m.in_test = g.in_test GROUP BY g.\"group\"" for n in names)
    return ctes, final


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["flight_summary"] = with_ctes(f"SELECT {_replace_round(FS_DOUBLES)} FROM fs")
    q["runway_actuals"] = with_ctes("SELECT * FROM rw")
    q["speed_fraction"] = with_ctes(f"SELECT gufi, {r6('fraction_speed_gte_threshold')} FROM sf")
    q["external_estimates"] = with_ctes(
        "SELECT " + _replace_round(["undelayed_departure_ramp_transit_time", "undelayed_departure_ama_transit_time",
                                    "undelayed_departure_total_transit_time"]) + " FROM est")
    q["runway_override"] = with_ctes(f"SELECT {_replace_round(FS_DOUBLES)} FROM j2")
    q["estimate_join"] = with_ctes(
        "SELECT x.airport_icao, x.gufi, x.acid, x.isarrival, x.isdeparture, x.departure_stand_initial_time, "
        "e.gufi AS gufi_ffs, " + ", ".join(r6(f"e.{c}", c) for c in [
            "undelayed_departure_ramp_transit_time", "undelayed_departure_ama_transit_time",
            "undelayed_departure_total_transit_time"]) +
        " FROM fs x LEFT JOIN est e ON " + " AND ".join(
            f"x.{k} IS NOT DISTINCT FROM e.{k}" for k in
            ["acid", "isarrival", "isdeparture", "departure_stand_initial_time", "departure_aerodrome_icao_name",
             "arrival_aerodrome_icao_name"]))
    both = ("KDFW", "KCLT")
    q["csv_roundtrip"] = q["chunked_parquet_read"] = q["resumable_ingest"] = q["flight_summary"]
    q["checked_csv"] = """
SELECT o_orderpriority, count(*) AS n_rows, count(o_totalprice) AS n_prices, sum(o_orderkey)::BIGINT AS sum_keys,
       (SELECT count(*) FROM orders WHERE o_orderkey % 97 = 0) AS n_bad
FROM orders WHERE o_orderkey % 97 <> 0 GROUP BY o_orderpriority"""
    q["two_airport_write"] = with_ctes(f"SELECT {_replace_round(FS_DOUBLES)} FROM fs", airports=both)
    q["runway_override_two_airports"] = with_ctes(f"SELECT {_replace_round(FS_DOUBLES)} FROM j2", airports=both)
    q["niqr_band_two_airports"] = with_ctes(f"SELECT airport_icao, gufi, {r6(RAMP)} FROM nb",
                                            _iqr_band("nb", "core", RAMP, 3.0), both)
    q["percentile_band_two_airports"] = with_ctes(f"SELECT airport_icao, gufi, {r6(FULL)} FROM pb",
                                                  _pct_band("pb", "core", FULL, 0.0, 1.0), both)
    q["count_limits_two_airports"] = with_ctes("""
SELECT airport_icao, gufi, dep_stand_AMA_count, dep_AMA_runway_count, arr_runway_AMA_count FROM core JOIN (
  SELECT airport_icao, quantile_cont(dep_stand_AMA_count, 0.3) AS a, quantile_cont(dep_AMA_runway_count, 0.4) AS b,
         quantile_cont(arr_runway_AMA_count, 0.6) AS c FROM core GROUP BY airport_icao) USING (airport_icao)
WHERE dep_stand_AMA_count < a AND dep_AMA_runway_count < b AND arr_runway_AMA_count < c""", airports=both)
    q["baseline_two_airports"] = with_ctes(
        "SELECT airport_icao, gufi, \"group\", round(predicted_baseline, 6) AS predicted_baseline, "
        "missing_core_features_baseline FROM tbpred", _baseline_ctes("tb", "core", "MEDIAN"), both)
    q["baseline_predict_unimp_ama"] = with_ctes(
        "SELECT airport_icao, gufi, \"group\", round(predicted_baseline, 6) AS predicted_baseline, "
        "missing_core_features_baseline FROM abpred", _baseline_ctes("ab", "ama", "MEDIAN", AMA, "unimpeded_AMA"))
    q["total_taxi_time"] = with_ctes(
        f"SELECT airport_icao, gufi, round({secs('departure_stand_actual_time', 'departure_runway_actual_time')}, 6) "
        "AS actual_departure_total_taxi_time FROM core")
    q["group_sizes"] = with_ctes("""
SELECT "group", count(*) AS n FROM core GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM core""")
    q["dedup_first"] = with_ctes(
        "SELECT " + _replace_round(FS_DOUBLES + ["undelayed_departure_ramp_transit_time",
                                                 "undelayed_departure_ama_transit_time",
                                                 "undelayed_departure_total_transit_time"]) + " FROM w6")
    q["occupancy_dep_ramp"] = with_ctes("SELECT airport_icao, gufi, dep_stand_AMA_count FROM occ")
    q["occupancy_dep_ama"] = with_ctes("SELECT airport_icao, gufi, dep_AMA_runway_count FROM occ")
    q["occupancy_arr_ramp"] = with_ctes("SELECT airport_icao, gufi, AMA_gate_count FROM occ")
    q["occupancy_arr_ama"] = with_ctes("SELECT airport_icao, gufi, arr_runway_AMA_count FROM occ")
    q["occupancy_totals"] = with_ctes("SELECT airport_icao, gufi, total_arrivals_on_surface, "
                                      "total_departures_on_surface, total_flights_on_surface FROM occ")
    q["occupancy_two_airports"] = with_ctes(
        "SELECT airport_icao, gufi, dep_stand_AMA_count, dep_AMA_runway_count, total_arrivals_on_surface, "
        "total_flights_on_surface FROM occ", airports=("KDFW", "KCLT"))
    q["departures_non_null"] = with_ctes(
        "SELECT airport_icao, gufi FROM w6 WHERE isdeparture AND departure_runway_actual_time IS NOT NULL "
        "AND departure_movement_area_actual_time IS NOT NULL AND departure_stand_actual_time IS NOT NULL")
    q["require_stand_runway"] = with_ctes(
        "SELECT airport_icao, gufi, carrier, departure_stand_actual, departure_runway_actual FROM w6 "
        "WHERE isdeparture AND departure_runway_actual IS NOT NULL "
        "AND (departure_stand_actual IS NOT NULL OR COALESCE(carrier IN ('FDX'), false))")
    q["niqr_band"] = with_ctes(f"SELECT airport_icao, gufi, {r6(RAMP)} FROM nb", _iqr_band("nb", "core", RAMP, 3.0))
    q["percentile_band"] = with_ctes(f"SELECT airport_icao, gufi, {r6(FULL)} FROM pb",
                                     _pct_band("pb", "core", FULL, 0.0, 1.0))
    q["count_limits"] = with_ctes("""
SELECT airport_icao, gufi, dep_stand_AMA_count, dep_AMA_runway_count, arr_runway_AMA_count FROM core WHERE
  dep_stand_AMA_count < (SELECT quantile_cont(dep_stand_AMA_count, 0.3) FROM core)
  AND dep_AMA_runway_count < (SELECT quantile_cont(dep_AMA_runway_count, 0.4) FROM core)
  AND arr_runway_AMA_count < (SELECT quantile_cont(arr_runway_AMA_count, 0.6) FROM core)""")
    q["date_range"] = with_ctes(
        f"SELECT airport_icao, gufi, departure_runway_actual_time FROM w6 "
        f"WHERE departure_runway_actual_time > {S} AND departure_runway_actual_time <= {E}")
    q["coverage_report"] = with_ctes(f"""
SELECT airport_icao, data_start, data_end, rows_in_range,
  round(CAST(date_diff('microsecond', {S}, data_start) AS DOUBLE) / 3.6e9, 6) AS hours_short_start,
  round(CAST(date_diff('microsecond', data_end, {E}) AS DOUBLE) / 3.6e9, 6) AS hours_short_end,
  (CAST(date_diff('microsecond', {S}, data_start) AS DOUBLE) / 3.6e9 > 12)
    OR (CAST(date_diff('microsecond', data_end, {E}) AS DOUBLE) / 3.6e9 > 12) AS warn
FROM (SELECT airport_icao, min(departure_runway_actual_time) AS data_start,
             max(departure_runway_actual_time) AS data_end,
             count_if(departure_runway_actual_time > {S} AND departure_runway_actual_time <= {E}) AS rows_in_range
      FROM w6 GROUP BY airport_icao)""")
    dep = "FROM w6 WHERE isdeparture"
    grp = f"CASE WHEN {u('gufi', 'group')} < 0.2 THEN 'test' ELSE 'train' END AS \"group\""
    q["hash_split"] = with_ctes(f"SELECT airport_icao, gufi, {grp} {dep}")
    q["montecarlo_split"] = with_ctes(
        f"SELECT airport_icao, gufi, {grp}, "
        + ", ".join(f"{u('gufi', f'cv{k}')} < 0.2 AS test_{k}" for k in range(9)) + f" {dep}")
    fold = f"CAST(floor({u('gufi', 'fold')} * 5) AS INTEGER)"
    q["kfold_split"] = with_ctes(
        f"SELECT airport_icao, gufi, CASE WHEN {fold} = 0 THEN 'test' ELSE 'train' END AS \"group\", "
        + ", ".join(f"{fold} = {k + 1} AS test_{k}" for k in range(4)) + f" {dep}")
    efold = f"CAST((row_number() OVER (ORDER BY {u('gufi', 'fold')}, gufi) - 1) % 5 AS INTEGER)"
    q["kfold_exact_split"] = with_ctes(
        f"SELECT airport_icao, gufi, CASE WHEN f = 0 THEN 'test' ELSE 'train' END AS \"group\", "
        + ", ".join(f"f = {k + 1} AS test_{k}" for k in range(4))
        + f" FROM (SELECT airport_icao, gufi, {efold} AS f {dep})")
    q["unimpeded_flag"] = with_ctes(
        f"SELECT airport_icao, gufi, {r6(AMA)}, {r6('fraction_speed_gte_threshold')}, unimpeded_AMA FROM ama")
    q["time_bins"] = with_ctes(
        "SELECT airport_icao, gufi, CAST((hour(departure_stand_airline_time) * 60 + "
        "minute(departure_stand_airline_time)) // 10 AS INTEGER) AS stand_time_bin10, "
        f"CAST(hour(departure_stand_airline_time) AS INTEGER) AS stand_time_hour {dep}")
    s = "departure_stand_actual"
    q["stand_features"] = with_ctes(
        f"SELECT airport_icao, gufi, {s}, NULLIF(regexp_extract({s}, '^([A-K])[0-9]+', 1), '') AS terminal, "
        f"CASE WHEN regexp_matches({s}, '^[A-K][0-9][A-Z]*$') THEN substring({s}, 1, 1) || '0' || "
        f"substring({s}, 2) ELSE {s} END AS stand_padded, "
        f"NULLIF(regexp_extract({s}, '^([A-Za-z]+)[0-9]+', 1), '') AS stand_group, "
        f"CAST(NULLIF(regexp_extract({s}, '^[A-Za-z]+([0-9]+)', 1), '') AS INTEGER) AS stand_number {dep}")
    grp_of = "NULLIF(regexp_extract(departure_stand_actual, '^([A-Za-z]+)[0-9]+', 1), '')"
    q["stand_encoding"] = with_ctes(f"""
SELECT c.airport_icao, c.gufi, l.letter AS stand_letter,
  CAST(CASE WHEN {grp_of} = l.letter
            THEN CAST(NULLIF(regexp_extract(departure_stand_actual, '^[A-Za-z]+([0-9]+)', 1), '') AS INTEGER)
            ELSE 0 END AS DOUBLE) AS stand_value
FROM core c CROSS JOIN (SELECT DISTINCT {grp_of} AS letter FROM core
                        WHERE "group" = 'train' AND {grp_of} IS NOT NULL) l""")
    rwy = "departure_runway_actual"
    unknown = (f"(NOT {missing(rwy)} AND {rwy} NOT IN (SELECT {rwy} FROM core WHERE \"group\" = 'train' "
               f"AND NOT {missing(rwy)} AND CAST({rwy} AS VARCHAR) <> '17C'))")
    q["quality_rules"] = with_ctes(f"""
SELECT airport_icao, gufi, msg AS error_msg, msg <> '' AS missing_core_features FROM (
  SELECT airport_icao, gufi, concat_ws('; ',
     CASE WHEN {missing(s)} THEN 'Missing {s}' END,
     CASE WHEN {unknown} THEN 'Unknown {rwy}' END,
     CASE WHEN {missing(rwy)} THEN 'Missing {rwy}' END) AS msg
  FROM core)""")
    q["baseline_predict"] = with_ctes(
        "SELECT airport_icao, gufi, \"group\", round(predicted_baseline, 6) AS predicted_baseline, "
        "missing_core_features_baseline FROM bpred")
    mc, mf = _metrics_sql("(SELECT * FROM bpred WHERE NOT missing_core_features_baseline)",
                          RAMP, "predicted_baseline")
    q["error_metrics"] = with_ctes(mf, mc)
    imp_ramp = _iqr_band("ir", "r1", RAMP, 3.0) + _baseline_ctes("ib", "ir", "MEDIAN")
    mc, mf = _metrics_sql("(SELECT * FROM ibpred WHERE NOT missing_core_features_baseline)",
                          RAMP, "predicted_baseline")
    q["imp_ramp_metrics"] = with_ctes(mf, imp_ramp + mc)
    cc, cf = _cv_spread_sql()
    q["metric_spread"] = with_ctes(cf, cc)
    q["residual_histogram"] = with_ctes(
        f"SELECT \"group\", CAST(floor(({RAMP} - predicted_baseline) / 30.0) * 30.0 AS DOUBLE) AS bin_start, "
        f"count(*) AS n FROM bpred WHERE {RAMP} - predicted_baseline IS NOT NULL GROUP BY ALL")
    q["estimate_vs_truth"] = with_ctes(
        f"SELECT \"group\", CAST(floor({RAMP} / 60.0) * 60.0 AS DOUBLE) AS truth_bin, "
        f"CAST(floor(predicted_baseline / 60.0) * 60.0 AS DOUBLE) AS estimate_bin, count(*) AS n FROM bpred "
        f"WHERE {RAMP} IS NOT NULL AND predicted_baseline IS NOT NULL GROUP BY ALL")
    q["category_support"] = with_ctes("SELECT airport_icao, gufi, terminal FROM dsup")
    feats = ["departure_stand_actual", "departure_runway_actual", "carrier"]
    fc = " UNION ALL ".join(f"SELECT terminal, '{f}' AS feature, CAST({f} AS VARCHAR) AS value FROM dsup "
                            f"WHERE {f} IS NOT NULL" for f in feats)
    q["feature_counts"] = with_ctes(f"SELECT terminal, feature, value, count(*) AS n FROM ({fc}) GROUP BY ALL")
    pairs = [(feats[i], feats[j]) for i in range(3) for j in range(i + 1, 3)]
    pc = " UNION ALL ".join(
        f"SELECT terminal, '{a}' AS feature_x, CAST({a} AS VARCHAR) AS value_x, '{b}' AS feature_y, "
        f"CAST({b} AS VARCHAR) AS value_y FROM dsup WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in pairs)
    pair_counts = f"SELECT terminal, feature_x, value_x, feature_y, value_y, count(*) AS n FROM ({pc}) GROUP BY ALL"
    q["feature_pair_counts"] = with_ctes(pair_counts)
    q["count_scale"] = with_ctes("""
SELECT terminal, feature_x, feature_y,
  CAST(floor(vmin) AS BIGINT) AS b0, CAST(floor((vmax - vmin) / 50 + vmin) AS BIGINT) AS b1,
  CAST(floor((vmax - vmin) / 20 + vmin) AS BIGINT) AS b2, CAST(floor((vmax - vmin) / 5 + vmin) AS BIGINT) AS b3,
  CAST(floor((vmax - vmin) / 2 + vmin) AS BIGINT) AS b4, CAST(floor(vmax) AS BIGINT) AS b5
FROM (SELECT terminal, feature_x, feature_y, CAST(min(n) AS DOUBLE) AS vmin, CAST(max(n) AS DOUBLE) AS vmax
      FROM pc GROUP BY ALL)""", [("pc", pair_counts)])
    q["step_quality"] = with_ctes("""
SELECT step_no, step, rows_in, rows_out, round(CAST(rows_out AS DOUBLE) * 100.0 / NULLIF(rows_in, 0), 6) AS pct_kept FROM (
  SELECT step_no, step, rows_out, lag(rows_out) OVER (ORDER BY step_no) AS rows_in FROM (
    SELECT 0 AS step_no, 'input' AS step, (SELECT count(*) FROM core) AS rows_out
    UNION ALL SELECT 1, 'require_stand_runway', (SELECT count(*) FROM r1)
    UNION ALL SELECT 2, 'taxi_time_band', (SELECT count(*) FROM r2)
    UNION ALL SELECT 3, 'surface_count_limits', (SELECT count(*) FROM r3)
    UNION ALL SELECT 4, 'non_null_times', (SELECT count(*) FROM ramp)))""")
    q["unimp_ramp_table"] = with_ctes(
        f"SELECT airport_icao, gufi, \"group\", {r6(RAMP)}, departure_stand_actual, departure_runway_actual, "
        f"carrier, {', '.join(COUNTS)} FROM ramp")
    imp = (_pct_band("i1", "r1", AMA, 0.0, 1.0) + _pct_band("i2", "i1", FULL, 0.0, 1.0)
           + _iqr_band("i3", "i2", RAMP, 3.0))
    full = _pct_band("u1", "r1", FULL, 0.0, 1.0) + [
        ("u2", "SELECT * FROM u1 WHERE departure_runway_actual_time IS NOT NULL AND departure_movement_area_actual_time IS NOT NULL "
               "AND departure_stand_actual_time IS NOT NULL"),
        ("u3", "SELECT u2.*, sf.gufi AS hit, sf.fraction_speed_gte_threshold FROM u2 LEFT JOIN sf ON u2.gufi = sf.gufi")]
    q["unimp_full_table"] = with_ctes(
        f"SELECT airport_icao, gufi, \"group\", {r6(FULL)}, {r6(AMA)}, {r6(RAMP)}, {r6('fraction_speed_gte_threshold')}, "
        "COALESCE(fraction_speed_gte_threshold >= 0.9, false) AS unimpeded_AMA FROM u3", full)
    override = ("fs LEFT JOIN rwf r ON fs.airport_icao = r.airport_icao AND fs.gufi = r.gufi "
                "AND fs.isarrival = r.r_isarrival AND fs.isdeparture = r.r_isdeparture")
    keys = " AND ".join(f"x.{k} IS NOT DISTINCT FROM e.{k}" for k in ["acid", "isarrival", "isdeparture", "departure_stand_initial_time",
                                                                      "departure_aerodrome_icao_name", "arrival_aerodrome_icao_name"])
    in_range = f"departure_runway_actual_time > {S} AND departure_runway_actual_time <= {E}"
    steps = [("flight_summary", "SELECT count(*), NULL::BIGINT FROM fs"), ("runway_override", f"SELECT count(*), count(r.gufi) FROM {override}"),
             ("estimate_join", f"SELECT count(*), count(e.hit) FROM j2 x LEFT JOIN (SELECT *, true AS hit FROM est) e ON {keys}"),
             ("first_per_flight", "SELECT count(*), NULL FROM w6"), ("date_range", f"SELECT count(*), NULL FROM w6 WHERE {in_range}"),
             ("departures", "SELECT count(*), NULL FROM core"), ("require_stand_runway", "SELECT count(*), NULL FROM r1"),
             ("taxi_time_band_full", "SELECT count(*), NULL FROM u1"), ("non_null_times", "SELECT count(*), NULL FROM u2"),
             ("speed_fraction_join", "SELECT count(*), count(hit) FROM u3"), ("surface_count_limits_full", "SELECT count(*), NULL FROM u3"),
             ("unimpeded_flag", "SELECT count(*), NULL FROM u3")]
    counted = " UNION ALL ".join(f"SELECT {i} AS step_no, '{n}' AS step, * FROM ({sql}) t(n, hit)" for i, (n, sql) in enumerate(steps))
    q["step_watch"] = with_ctes(
        "SELECT step_no::INT AS step_no, step, lag(n) OVER (ORDER BY step_no) AS rows_in, n AS rows_out, "
        "round(100.0::DOUBLE * n / NULLIF(lag(n) OVER (ORDER BY step_no), 0), 6) AS pct_kept, "
        f"round(100.0::DOUBLE * hit / NULLIF(n, 0), 6) AS pct_matched FROM ({counted})", full)
    flagged = _baseline_ctes("f", "ama", "MEDIAN", AMA, "unimpeded_AMA")
    scored = "(SELECT * FROM fpred WHERE NOT missing_core_features_baseline{})"
    all_ctes, all_rows = _metrics_sql(scored.format(""), AMA, "predicted_baseline")
    own_ctes, own_rows = _metrics_sql(scored.format(" AND unimpeded_AMA"), AMA, "predicted_baseline")
    own_ctes = [(f"u{n}", sql.replace("m_in", "um_in").replace("m_med", "um_med")) for n, sql in own_ctes]
    own_rows = own_rows.replace("m_wide", "um_wide")
    q["unimp_ama_metrics"] = with_ctes(
        f"SELECT \"group\", metric, value FROM ({all_rows}) UNION ALL "
        f"SELECT \"group\", 'unimpeded_AMA_' || metric, value FROM ({own_rows})", flagged + all_ctes + own_ctes)
    q["stand_clusters"] = with_ctes(
        "SELECT stand AS departure_stand_actual, (dense_rank() OVER (ORDER BY first) - 1)::INT AS stand_cluster "
        "FROM (SELECT stand, min(stand) OVER (PARTITION BY label) AS first FROM sc_labels)",
        _iqr_band("ir", "r1", RAMP, 3.0) + _single_linkage(3, 6))
    q["imp_full_table"] = with_ctes(
        f"SELECT airport_icao, gufi, \"group\", {r6(FULL)}, {r6(AMA)}, {r6(RAMP)}, total_flights_on_surface "
        f"FROM i3", imp)
    return q


def _single_linkage(nrunways: int, clusters: int) -> list[tuple[str, str]]:
    """Stand profiles of the training rows of ``ir``, joined pair by pair, shortest edge first, until ``clusters`` are left."""
    return [
        ("sc_rows", f"SELECT departure_stand_actual AS stand, departure_runway_actual AS rw, {RAMP} AS y FROM ir WHERE \"group\" = 'train' "
                    f"AND departure_stand_actual IS NOT NULL AND departure_runway_actual IS NOT NULL AND {RAMP} IS NOT NULL"),
        ("sc_top", f"SELECT * FROM (SELECT rw, row_number() OVER (ORDER BY count(*) DESC, rw) AS place FROM sc_rows GROUP BY rw) "
                   f"WHERE place <= {nrunways}"),
        ("sc_busy", "SELECT stand, place, y FROM sc_rows JOIN sc_top USING (rw)"),
        ("sc_fill", "SELECT place, median(y) AS m FROM sc_busy GROUP BY place"),
        ("sc_own", "SELECT stand, place, median(y) AS m FROM sc_busy GROUP BY stand, place"),
        ("sc_raw", "SELECT s.stand, f.place, COALESCE(o.m, f.m) AS v FROM (SELECT DISTINCT stand FROM sc_own) s CROSS JOIN sc_fill f "
                   "LEFT JOIN sc_own o ON o.stand = s.stand AND o.place = f.place"),
        ("sc_x", "SELECT r.stand, r.place, CASE WHEN sd = 0 THEN 0 ELSE (v - mean) / sd END AS x FROM sc_raw r JOIN "
                 "(SELECT place, avg(v) AS mean, stddev_pop(v) AS sd FROM sc_raw GROUP BY place) USING (place)"),
        ("sc_nodes", "SELECT stand, row_number() OVER (ORDER BY stand) AS i FROM (SELECT DISTINCT stand FROM sc_own)"),
        ("sc_dist", "SELECT a.stand AS a, b.stand AS b, round(sqrt(sum((a.x - b.x) * (a.x - b.x))), 9) AS d "
                    "FROM sc_x a JOIN sc_x b ON a.place = b.place AND a.stand < b.stand GROUP BY a.stand, b.stand"),
        ("sc_edges", "SELECT m.i AS a, n.i AS b, row_number() OVER (ORDER BY d, x.a, x.b) AS i FROM sc_dist x "
                     "JOIN sc_nodes m ON m.stand = x.a JOIN sc_nodes n ON n.stand = x.b"),
        ("sc_merge(i, labels, parts)",
         "SELECT 0::BIGINT, list(i ORDER BY i), count(*) FROM sc_nodes UNION ALL "
         "SELECT e.i, CASE WHEN labels[a] = labels[b] THEN labels ELSE list_transform(labels, lambda x: "
         "CASE WHEN x = labels[b] THEN labels[a] ELSE x END) END, parts - (labels[a] <> labels[b])::INT "
         f"FROM sc_merge m JOIN sc_edges e ON e.i = m.i + 1 WHERE parts > {clusters}"),
        ("sc_labels", "SELECT stand, (SELECT arg_max(labels, i) FROM sc_merge)[i] AS label FROM sc_nodes"),
    ]


def _generic_interval_sql(iv: str, probes: str, by: list[str], key: str, series: list[tuple[str, str]]) -> str:
    """Open-interval counts by an inequality join (``iv``: by, series, t_in, t_out; ``probes``: by, key, ts)."""
    on = " AND ".join([f"i.{b} = p.{b}" for b in by] + ["i.t_in <= p.ts", "i.t_out > p.ts"])
    fon = " AND ".join([f"f.{b} = c.{b}" for b in by]) or "true"
    sums = ", ".join(f"SUM(CASE WHEN i.series = '{s}' THEN 1 ELSE 0 END) AS n_{i}" for i, (s, _) in enumerate(series))
    firsts = ", ".join(f"min(CASE WHEN series = '{s}' THEN t_in END) AS f_{i}" for i, (s, _) in enumerate(series))
    cols = ", ".join(f"CAST(CASE WHEN c.ts >= f.f_{i} THEN c.n_{i} END AS BIGINT) AS {alias}"
                     for i, (_, alias) in enumerate(series))
    byc = "".join(f"p.{b}, " for b in by)
    byf = ", ".join(by)
    first_sql = f"SELECT {byf + ', ' if by else ''}{firsts} FROM giv" + (f" GROUP BY {byf}" if by else "")
    return (f"WITH giv AS ({iv}), gpr AS ({probes}), "
            f"gcnt AS (SELECT {byc}p.{key}, p.ts, {sums} FROM gpr p LEFT JOIN giv i ON {on} "
            f"GROUP BY {byc}p.{key}, p.ts), gfirst AS ({first_sql}) "
            f"SELECT {''.join(f'c.{b}, ' for b in by)}c.{key}, c.ts, {cols} FROM gcnt c LEFT JOIN gfirst f ON {fon}")


def generic_oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["events_fraction_ge"] = ("SELECT user_id, round(AVG(CAST(CAST(value >= 50.0 AS INTEGER) AS DOUBLE)), 6) "
                               "AS fraction_value_gte FROM events GROUP BY user_id")
    q["events_quantile_states"] = ("SELECT event_type, count(*) AS n, min(value) AS least, max(value) AS greatest, TRUE AS ranks_ok "
                                   "FROM events WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY event_type")
    types = ["click", "view", "purchase", "signup", "error"]
    q["events_open_intervals"] = _generic_interval_sql(
        "SELECT * FROM (SELECT user_id, event_type AS series, ts AS t_in, "
        "ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) AS t_out FROM events) WHERE t_out > t_in",
        "SELECT user_id, event_id, ts FROM events WHERE event_type = 'purchase'",
        ["user_id"], "event_id", [(t, t) for t in types])
    q["lineitem_in_transit"] = _generic_interval_sql(
        "SELECT * FROM (SELECT l_returnflag AS series, l_shipdate AS t_in, "
        "l_shipdate + to_days(CAST(l_quantity AS INTEGER)) AS t_out FROM lineitem) WHERE t_out > t_in",
        "SELECT o_orderkey, o_orderdate AS ts FROM orders",
        [], "o_orderkey", [("A", "in_transit_A"), ("N", "in_transit_N"), ("R", "in_transit_R")])
    grp = f"CASE WHEN {u('event_id', 'group')} < 0.2 THEN 'test' ELSE 'train' END"
    ctes = [
        ("ev", f"SELECT *, {grp} AS \"group\" FROM events"),
        ("etrain", "SELECT * FROM ev WHERE \"group\" = 'train'"),
        ("echk", f"SELECT e.*, ({missing('e.event_type')} OR e.event_type NOT IN "
                 f"(SELECT event_type FROM etrain WHERE NOT {missing('event_type')})) AS miss FROM ev e"),
        ("egroups", "SELECT event_type, quantile_cont(value, 0.5) AS predicted FROM echk "
                    "WHERE \"group\" = 'train' AND NOT miss AND NOT COALESCE(value < 0, false) "
                    "AND event_type IS NOT NULL GROUP BY event_type"),
        ("epred0", "SELECT e.*, COALESCE(g.predicted, (SELECT median(predicted) FROM egroups)) AS p0, "
                   "(SELECT median(value) FROM etrain) AS dflt FROM echk e "
                   "LEFT JOIN egroups g ON e.event_type = g.event_type"),
        ("epred", "SELECT *, CASE WHEN miss OR p0 < 0 OR p0 IS NULL THEN dflt ELSE p0 END AS predicted_baseline "
                  "FROM epred0"),
    ]
    mc, mf = _metrics_sql("(SELECT * FROM epred WHERE NOT miss)", "value", "predicted_baseline")
    q["lineitem_price_quantiles"] = (
        "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p01, "
        "round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99, "
        "round(quantile_cont(l_discount - 0.05, 0.25), 6) AS discount_p25 FROM lineitem GROUP BY l_returnflag")
    q["events_time_quantiles"] = (
        "SELECT event_type, " + ", ".join(f"round(quantile_cont(floor(epoch_us(ts) / 1e6), {p}), 2) AS {n}"
                                          for p, n in ((0.1, "p10"), (0.5, "p50"), (0.975, "p975"))) + " FROM events GROUP BY event_type")
    q["events_baseline_metrics"] = "WITH " + ",\n".join(f"{n} AS ({b})" for n, b in ctes + mc) + "\n" + mf
    q["lineitem_iqr_band"] = (
        "WITH pos AS (SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_extendedprice > 0.0), "
        "q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2, "
        "quantile_cont(l_extendedprice, 0.75) AS q3 FROM pos) "
        "SELECT p.* FROM pos p, q WHERE p.l_extendedprice > q.q2 - 1.5 * (q.q3 - q.q1) "
        "AND p.l_extendedprice < q.q2 + 1.5 * (q.q3 - q.q1)")
    q["lineitem_percentile_band"] = (
        "WITH pos AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 0.0), "
        "q AS (SELECT quantile_cont(l_quantity, 0.05) AS lo, quantile_cont(l_quantity, 0.95) AS hi FROM pos) "
        "SELECT p.* FROM pos p, q WHERE p.l_quantity > q.lo AND p.l_quantity < q.hi")
    q["lineitem_count_limits"] = (
        "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem "
        "WHERE l_quantity < (SELECT quantile_cont(l_quantity, 0.3) FROM lineitem) AND l_linenumber < 4.0")
    return q
