"""DuckDB SQL twins of the registered queries.

The base tables are views in DuckDB; the derived inputs (readings,
households, weather, silver, gold, alerts) are CTEs that follow the adapter
rules of :mod:`meterlake.sources.tables` and the operator semantics. Each
query string carries the CTEs it needs.

Numeric conventions shared with the Spark plans so results agree bit for
bit: sums of readings are fixed-point decimals cast to double; detector
moments are integers in thousandths; texts of scores are built from
integers rounded half up.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings_raw": ((), """
  SELECT 'MAC' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS LCLid,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || '0' AS tstp,
         CASE event_id % 50 WHEN 0 THEN 'Null' WHEN 1 THEN '' WHEN 2 THEN NULL
              ELSE CAST(value AS VARCHAR) END AS "energy(kWh/hh)",
         event_id, event_type
  FROM events"""),
    "households_raw": ((), """
  SELECT 'MAC' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS LCLid,
         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'ACORN-U' ELSE c_mktsegment END AS Acorn_grouped
  FROM customer WHERE c_custkey % 37 <> 5"""),
    "weather_k": ((), """
  SELECT date_trunc('hour', ts) AS hour,
         arg_min(CAST(json_extract_string(props, '$.k') AS INTEGER), event_id) AS k
  FROM events GROUP BY 1"""),
    "weather": (("weather_k",), """
  SELECT hour AS weather_hour,
         CAST(k AS DOUBLE) * CAST(0.5 AS DOUBLE) - CAST(5.0 AS DOUBLE) AS temperature,
         CAST(k AS DOUBLE) * CAST(0.5 AS DOUBLE) - CAST(5.0 AS DOUBLE) - CAST(2.0 AS DOUBLE) AS apparentTemperature,
         CAST(k AS DOUBLE) / CAST(100.0 AS DOUBLE) AS humidity,
         CASE k % 3 WHEN 0 THEN 'rain' WHEN 1 THEN 'snow' END AS precipType
  FROM weather_k WHERE k % 10 <> 7"""),
    "households": (("households_raw",), """
  SELECT LCLid AS meter_id, min(Acorn_grouped) AS acorn_group
  FROM households_raw GROUP BY LCLid
  HAVING NOT contains(min(Acorn_grouped), 'ACORN-')"""),
    "readings": (("readings_raw",), """
  SELECT LCLid,
         try_strptime(substr(tstp, 1, 26), '%Y-%m-%d %H:%M:%S.%f') AS timestamp,
         TRY_CAST("energy(kWh/hh)" AS DOUBLE) AS consumption,
         event_id, event_type
  FROM readings_raw
  WHERE "energy(kWh/hh)" <> '' AND NOT contains("energy(kWh/hh)", 'Null')"""),
    "silver_x": (("readings", "households", "weather"), """
  SELECT r.LCLid, r.timestamp, r.consumption, h.acorn_group,
         w.temperature, w.apparentTemperature, w.humidity, w.precipType, r.event_id, r.event_type
  FROM readings r
  JOIN households h ON r.LCLid = h.meter_id
  LEFT JOIN weather w ON date_trunc('hour', r.timestamp) = w.weather_hour"""),
    "silver": (("silver_x",), """
  SELECT LCLid, timestamp, consumption, acorn_group, temperature, apparentTemperature, humidity, precipType
  FROM silver_x"""),
    "gold": (("silver",), """
  SELECT ws AS window_start, ws + INTERVAL 1 HOUR AS window_end, acorn_group, precipType,
         CAST(SUM(CAST(consumption AS DECIMAL(18,3))) AS DOUBLE) / COUNT(consumption) AS avg_consumption,
         CAST(SUM(CAST(consumption AS DECIMAL(18,3))) AS DOUBLE) AS total_load,
         COUNT(DISTINCT LCLid) AS active_meters,
         AVG(temperature) AS avg_temp
  FROM (SELECT s.*, time_bucket(INTERVAL 30 MINUTE, timestamp) - o.i * INTERVAL 30 MINUTE AS ws
        FROM silver s CROSS JOIN (VALUES (0), (1)) AS o(i)
        WHERE timestamp IS NOT NULL) g
  GROUP BY ws, acorn_group, precipType"""),
    # readings in sevenths (no finite number of decimals), cut into whole part and 24-bit fraction pieces
    "pieces": (("silver",), """
  SELECT ws, acorn_group, precipType, LCLid, temperature, p0, p1, p2, p3,
         CAST(trunc((r3 - p3) * CAST(16777216.0 AS DOUBLE)) AS BIGINT) AS p4
  FROM (SELECT *, CAST(trunc(r3) AS BIGINT) AS p3 FROM (
        SELECT *, (r2 - p2) * CAST(16777216.0 AS DOUBLE) AS r3 FROM (SELECT *, CAST(trunc(r2) AS BIGINT) AS p2 FROM (
        SELECT *, (r1 - p1) * CAST(16777216.0 AS DOUBLE) AS r2 FROM (SELECT *, CAST(trunc(r1) AS BIGINT) AS p1 FROM (
        SELECT *, (x - p0) * CAST(16777216.0 AS DOUBLE) AS r1 FROM (SELECT *, CAST(trunc(x) AS BIGINT) AS p0 FROM (
        SELECT s.*, consumption / CAST(7.0 AS DOUBLE) AS x,
               time_bucket(INTERVAL 30 MINUTE, timestamp) - o.i * INTERVAL 30 MINUTE AS ws
        FROM silver s CROSS JOIN (VALUES (0), (1)) AS o(i) WHERE timestamp IS NOT NULL) a) b) c) d) e) f) g) h"""),
}


def exact_total(prefix: str, limbs: int = 4) -> str:
    """Summed pieces of doubles (24 fraction bits each, columns ``<prefix>0`` ...) as one double; see functions/exact.py."""
    def carried(parts: list[str]) -> list[str]:
        out, carry = [], "0"
        for c in reversed(parts[1:]):
            c = f"({c} + {carry})"
            out.append(f"({c} & 16777215)")
            carry = f"(({c} - ({c} & 16777215)) // 16777216)"
        return [f"({parts[0]} + {carry})", *reversed(out)]

    parts = [f"{prefix}{i}" for i in range(limbs + 1)]
    sign = f"(CASE WHEN {carried(parts)[0]} < 0 THEN -1 ELSE 1 END)"
    parts = carried([f"({c} * {sign})" for c in parts])
    p0, p1, p2, p3, p4 = parts

    def pair(high: str, low: str, power: int) -> str:
        return f"CAST({high} * 16777216 + {low} AS DOUBLE) * CAST(power(CAST(2.0 AS DOUBLE), {power}) AS DOUBLE)"

    def sticky(low: str, rest: str) -> str:
        return f"({low} | (CASE WHEN {rest} <> 0 THEN 1 ELSE 0 END))"

    large = f"(CAST({p0} AS DOUBLE) + {pair(p1, sticky(p2, f'({p3} | {p4})'), -48)})"
    medium = f"({pair(p0, p1, -24)} + {pair(p2, sticky(p3, p4), -72)})"
    small = f"({pair(p2, p3, -72)} + CAST({p4} AS DOUBLE) * CAST(power(CAST(2.0 AS DOUBLE), -96) AS DOUBLE))"
    return (f"((CASE WHEN {p0} >= 536870912 THEN {large} WHEN {p0} <> 0 OR {p1} <> 0 THEN {medium} ELSE {small} END)"
            f" * CAST({sign} AS DOUBLE))")


def moments_cte(name: str, key: str, source: str) -> str:
    """Exclusive prefix moments per key in thousandths (see the detector docs)."""
    return f"""
  SELECT {key} AS k, timestamp, consumption, temperature,
         COUNT(xi) OVER w AS n,
         COALESCE(SUM(xi) OVER w, 0) AS s,
         COALESCE(SUM(xi * xi) OVER w, 0) AS q
  FROM (SELECT *, CAST(round(consumption * 1000.0) AS BIGINT) AS xi FROM {source}
        WHERE temperature IS NOT NULL AND consumption IS NOT NULL AND timestamp IS NOT NULL) t
  WINDOW w AS (PARTITION BY {key} ORDER BY timestamp, consumption, temperature
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


STATS = """
  SELECT *, CASE WHEN n > 0 THEN CAST(s AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(1000.0 AS DOUBLE)) END AS mean,
         sqrt(CASE WHEN n > 1 THEN CAST(CAST(n AS HUGEINT) * q - CAST(s AS HUGEINT) * s AS DOUBLE)
                        / (CAST(n * (n - 1) AS DOUBLE) * CAST(1000000.0 AS DOUBLE))
                   ELSE CAST(0.0 AS DOUBLE) END) AS sd
  FROM {src}"""


def fixed_text(expr: str, places: int) -> str:
    scale = 10 ** places
    q = f"CAST(floor(({expr}) * CAST({scale}.0 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT)"
    return f"printf('%d.%0{places}d', {q} // {scale}, {q} % {scale})"


def alerts_body(src: str, calibration: int, z_mild: float, z_extreme: float, min_level: float = 6.0,
                cold: float = 6.0, hot: float = 30.0) -> str:
    z = f"(abs(consumption - mean) / (sd + CAST(0.1 AS DOUBLE)))"
    ctx = (f"CASE WHEN temperature < {cold} THEN 'FREDDO' WHEN temperature > {hot} THEN 'CALDO' "
           f"ELSE 'MITE' END")
    thr = (f"CASE WHEN temperature < {cold} OR temperature > {hot} THEN CAST({z_extreme} AS DOUBLE) "
           f"ELSE CAST({z_mild} AS DOUBLE) END")
    return f"""
  SELECT CAST(k AS VARCHAR) AS LCLid, timestamp, consumption AS currentValue, mean AS expectedAvg,
         'Z-Score: ' || {fixed_text(z, 2)} AS deviation, temperature,
         'ALERT CRITICO: Picco anomalo con clima ' || {ctx} || ' (' || {fixed_text(z, 1)} || ' sigma)' AS message
  FROM {src}
  WHERE n > {calibration} AND {z} > {thr} AND consumption > {min_level}"""


# The alerts layer used by the reports: per meter, calibration 30, z 3 / 5.
CTES["moments_meter"] = (("silver",), moments_cte("moments_meter", "LCLid", "silver"))
CTES["stats_meter"] = (("moments_meter",), STATS.format(src="moments_meter"))
CTES["alerts"] = (("stats_meter",), alerts_body("stats_meter", 30, 3.0, 5.0))
CTES["moments_type"] = (("silver_x",), moments_cte("moments_type", "event_type", "silver_x"))
CTES["stats_type"] = (("moments_type",), STATS.format(src="moments_type"))
CTES["alerts_type"] = (("stats_type",), alerts_body("stats_type", 600, 8.0, 15.0))
CTES["alerts_type_low"] = (("stats_type",), alerts_body("stats_type", 600, 2.0, 3.5))


# Each half of the history on its own (a pause beyond the idle timeout lies between them): calibration 12, z 3 / 5.
CTES["silver_half"] = (("silver", "readings"), """
  SELECT *, LCLid || CASE WHEN timestamp < (
           SELECT date_trunc('day', make_timestamp((epoch_us(min(timestamp)) + epoch_us(max(timestamp))) // 2)) FROM readings)
         THEN ' 1' ELSE ' 2' END AS meter_half
  FROM silver""")
CTES["moments_half"] = (("silver_half",), moments_cte("moments_half", "meter_half", "silver_half"))
CTES["stats_half"] = (("moments_half",), STATS.format(src="moments_half"))
CTES["alerts_half_long"] = (("stats_half",), alerts_body("stats_half", 12, 3.0, 5.0))
CTES["alerts_half"] = (("alerts_half_long",), """
  SELECT * REPLACE (left(LCLid, length(LCLid) - 2) AS LCLid) FROM alerts_half_long""")


def _closure(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def sql(body: str, *uses: str) -> str:
    """``WITH`` the CTEs ``uses`` depends on, then ``body``."""
    names = _closure(uses)
    if not names:
        return body.strip()
    ctes = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in names)
    return f"WITH {ctes}\n{body.strip()}"
