"""DuckDB SQL equivalent to each registered query (the correctness oracle).

Written independently of the Spark code path: grids are generated with
``generate_series`` and joined, orders use SQL windows. Only the fixed label
maps are shared (rendered as CASE expressions). Numeric constants are built
with the same IEEE operations as the Spark side, e.g. ``(2.0*g)/32768.0``.
"""

from __future__ import annotations

from sensorweave import catalog
from sensorweave.functions.labels import expand_lists
from sensorweave.plans.queries import EVENT_ACTIVITY, EVENT_SENSORS, HOUR_US, PACKET_SENSORS, TEN_MS_US

G = "9.80665::DOUBLE"
# what counts as a number in text, stated here on its own
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
D = 9  # decimals of rounded averages


def _q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _case(expr: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {_q(k) if isinstance(k, str) else k} THEN {_q(v)}" for k, v in mapping.items())
    body = f"CASE {expr} {whens} END"
    return f"COALESCE({body}, {default})" if default is not None else body


def _half_even(u: str, step: int) -> str:
    r = f"((({u}) % {step} + {step}) % {step})"
    q = f"((({u}) - {r}) // {step})"
    return (f"(({q}) + CASE WHEN 2 * {r} > {step} OR (2 * {r} = {step} AND ({q}) % 2 <> 0) "
            f"THEN 1 ELSE 0 END) * {step}")


def _nn(x: str) -> str:
    return f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"


def _coerce(x: str) -> str:
    return (f"CASE WHEN regexp_matches(CAST({x} AS VARCHAR), '{NUMBER}') "
            f"THEN TRY_CAST(trim(CAST({x} AS VARCHAR)) AS DOUBLE) END")


def _beach(rounded: bool) -> str:
    avgs = ", ".join(f"avg(CASE WHEN sensor = {_q(s)} THEN {_nn('x')} END) AS {s}_acc_x"
                     for s in EVENT_SENSORS)

    def out(s):
        e = f"w.{s}_acc_x * {G}"
        return (f"round({e}, {D})" if rounded else e) + f" AS {s}_acc_x"
    return f"""
WITH s AS (
  SELECT CAST(user_id AS VARCHAR) AS sid, event_type AS sensor, value AS x,
         {_half_even('epoch_us(ts)', HOUR_US)} AS t
  FROM events WHERE ts IS NOT NULL),
w AS (SELECT sid, t, {avgs} FROM s GROUP BY sid, t),
b AS (SELECT sid, min(t) AS lo, max(t) AS hi FROM w GROUP BY sid),
g AS (SELECT sid, lo, unnest(generate_series(lo, hi, {HOUR_US})) AS t FROM b)
SELECT (g.t - g.lo) // 1000 AS time_ms, g.sid AS sid, 'flat' AS surface,
       {', '.join(out(s) for s in EVENT_SENSORS)}
FROM g LEFT JOIN w ON w.sid = g.sid AND w.t = g.t"""


def _hour_slots() -> str:
    return f"SELECT user_id, event_type, value, {_half_even('epoch_us(ts)', HOUR_US)} AS slot_us FROM events"


def _packets() -> str:
    return ("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS packetcounter, l_returnflag, "
            "l_quantity, l_discount FROM lineitem")


def _fill(step: int) -> str:
    return f"""
WITH p AS ({_packets()}),
b AS (SELECT l_orderkey, min(packetcounter) AS lo, max(packetcounter) AS hi FROM p GROUP BY 1),
g AS (SELECT l_orderkey, unnest(generate_series(lo, hi, {step})) AS packetcounter FROM b)
SELECT g.l_orderkey, g.packetcounter, p.l_returnflag, p.l_quantity, p.l_discount
FROM g LEFT JOIN p ON p.l_orderkey = g.l_orderkey AND p.packetcounter = g.packetcounter"""


def _linearity(source: str, keys: str, fs: str) -> str:
    return f"""
WITH p AS ({source}),
d AS (SELECT {keys}, CAST(time_ms - lag(time_ms) OVER (PARTITION BY {keys} ORDER BY time_ms) AS DOUBLE) AS diff
      FROM p WHERE time_ms IS NOT NULL),
a AS (SELECT {keys}, count(*) AS n_points,
        COALESCE(min(diff) < 0, false) AS has_negative,
        COALESCE(max(abs(diff - (1.0::DOUBLE / ({fs}) * 1000.0::DOUBLE))) > 1.0::DOUBLE, false) AS out_of_tolerance
      FROM d GROUP BY {keys})
SELECT *, NOT has_negative AND NOT out_of_tolerance AS linear FROM a"""


def _null_cols(cols: list[str], double_cols: list[str]) -> str:
    parts = []
    for c in cols:
        cond = f"{c} IS NULL" + (f" OR isnan({c})" if c in double_cols else "")
        parts.append(f"CASE WHEN {cond} THEN {_q(c)} END")
    return f"concat_ws(',', {', '.join(parts)})"


def oracle_sql() -> dict[str, str]:
    sensors = [f"{s}_acc_x" for s in EVENT_SENSORS]
    luo_trials = expand_lists(catalog.LUO_TRIAL_SURFACES)
    sql: dict[str, str] = {}

    sql["beach_harmonise"] = _beach(rounded=True)
    sql["round_to_grid"] = (f"SELECT event_id, user_id, event_type, "
                            f"{_half_even('epoch_us(ts)', TEN_MS_US)} AS slot_us FROM events")
    sql["dedupe_mean"] = (f"SELECT user_id, event_type, slot_us, round(avg({_nn('value')}), {D}) AS value_mean, "
                          f"count(*) AS n_samples FROM ({_hour_slots()}) GROUP BY user_id, event_type, slot_us")
    sql["widen_sensors"] = (
        "SELECT user_id, slot_us, "
        + ", ".join(f"round(avg(CASE WHEN event_type = {_q(s)} THEN {_nn('value')} END), {D}) AS {s}_acc_x"
                    for s in EVENT_SENSORS)
        + f" FROM ({_hour_slots()}) GROUP BY user_id, slot_us")
    sql["widen_packets"] = (
        "SELECT l_orderkey, packetcounter, "
        + ", ".join(f"round(avg(CASE WHEN l_returnflag = {_q(s)} THEN {_nn(src)} END), {D}) AS {s.lower()}_{dst}"
                    for s in PACKET_SENSORS for src, dst in (("l_quantity", "acc_x"), ("l_discount", "gyr_x")))
        + f" FROM ({_packets()}) GROUP BY l_orderkey, packetcounter")
    sql["packet_rejects"] = f"""
SELECT l_orderkey, CAST(sum(n - 1) AS BIGINT) AS duplicate_samples FROM (
  SELECT l_orderkey, packetcounter, l_returnflag, count(*) AS n FROM ({_packets()})
  GROUP BY ALL HAVING count(*) > 1) GROUP BY l_orderkey"""
    sql["fill_packet_grid"] = _fill(1)
    sql["fill_grid_step"] = _fill(2)
    sql["grid_gaps"] = f"""
WITH p AS (SELECT DISTINCT l_orderkey, CAST(l_linenumber AS BIGINT) AS packetcounter FROM lineitem),
n AS (SELECT l_orderkey, packetcounter,
        lead(packetcounter) OVER (PARTITION BY l_orderkey ORDER BY packetcounter) AS nxt FROM p)
SELECT l_orderkey, packetcounter AS gap_after, nxt AS gap_before, nxt - packetcounter - 1 AS missing
FROM n WHERE nxt - packetcounter - 1 >= 1"""
    sql["packet_time_ms"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS packetcounter, l_returnflag,
  CAST(l_linenumber - min(l_linenumber) OVER (PARTITION BY l_orderkey) AS BIGINT) * 10 AS time_ms
FROM lineitem"""
    sql["recording_bounds"] = """
SELECT l_orderkey, min(pc) AS first_packet, max(pc) AS last_packet, count(*) AS n_rows,
  count(DISTINCT pc) AS n_packets, max(pc) - min(pc) + 1 AS expected_packets,
  max(pc) - min(pc) + 1 - count(DISTINCT pc) AS missing_packets
FROM (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS pc FROM lineitem) GROUP BY l_orderkey"""
    rn = "(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)"
    sql["sample_number"] = (f"SELECT user_id, event_id, {rn} AS sample_no, "
                            f"{rn} * {catalog.GRID_STEP_MS['mhealth']} AS time_ms FROM events")
    sql["time_from_rate"] = (f"SELECT user_id, event_id, {rn} AS sample_no, "
                             f"CAST(trunc({rn} * (1000.0::DOUBLE / {catalog.SAMPLING_RATE_HZ['bruno']}.0::DOUBLE)) AS BIGINT) "
                             f"AS time_ms FROM events")
    sql["seconds_to_ms"] = "SELECT event_id, CAST(trunc(value * 1000.0::DOUBLE) AS BIGINT) AS time_ms FROM events"
    sql["datetime_to_ms"] = ("SELECT user_id, event_id, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) "
                             "// 1000 AS time_ms FROM events")
    sql["unit_6bit"] = (f"SELECT l_orderkey, l_linenumber, l_returnflag, "
                        f"(-1.5::DOUBLE + (l_quantity / 63.0::DOUBLE) * 3.0::DOUBLE) * {G} AS acc_x FROM lineitem")
    sql["unit_g"] = f"SELECT l_orderkey, l_linenumber, l_returnflag, l_discount * {G} AS acc_x FROM lineitem"
    sql["unit_int16"] = (f"SELECT l_orderkey, l_linenumber, l_returnflag, "
                         f"l_partkey * ((2.0::DOUBLE * {G}) / 32768.0::DOUBLE) AS acc_x, "
                         f"l_suppkey * ((2000.0::DOUBLE * pi() / 180.0::DOUBLE) / 32768.0::DOUBLE) AS gyr_x FROM lineitem")
    sql["unit_deg"] = ("SELECT l_orderkey, l_linenumber, l_returnflag, "
                       "l_quantity * (pi() / 180.0::DOUBLE) AS gyr_x FROM lineitem")
    inner = r"regexp_extract(props, ':\s*([^}]*)', 1)"
    sql["coerce_numeric"] = (f"SELECT event_id, {_coerce(inner)} AS props_value, {_coerce('props')} AS props_whole, "
                             f"{_coerce('event_type')} AS type_value FROM events")
    sql["label_identity"] = (f"SELECT event_id, {_case('event_type', EVENT_ACTIVITY, 'event_type')} AS surface "
                             f"FROM events")
    code = "CAST(floor(value) AS INTEGER)"
    sql["label_null"] = (f"SELECT event_id, {code} AS code, {_case(code, catalog.KARAS_SURFACES)} AS surface "
                         f"FROM events")
    sql["label_ffill"] = f"""
WITH c AS (SELECT user_id, event_id, {code} AS code, {_case(code, catalog.MHEALTH_SURFACES)} AS surface FROM events)
SELECT user_id, event_id, code,
  last_value(surface IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS surface
FROM c"""
    sql["surrogate_subject_id"] = """
WITH f AS (SELECT user_id, min(event_id) AS first_event_id FROM events GROUP BY user_id)
SELECT user_id, first_event_id,
  CAST(row_number() OVER (ORDER BY first_event_id, user_id) AS INTEGER) AS sid FROM f"""
    sql["label_other"] = (f"SELECT p_partkey, p_size, {_case('p_size', catalog.HUGADB_SURFACES, _q('other'))} "
                          f"AS surface FROM part")
    sql["label_list"] = (f"SELECT l_orderkey, l_linenumber, l_suppkey, "
                         f"{_case('l_suppkey', luo_trials, _q('unknown'))} AS surface FROM lineitem")
    trial = "TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER)"
    sql["parse_trial_prefix"] = (f"SELECT o_orderkey, {trial} AS trial_no, "
                                 f"{_case(trial, luo_trials, _q('unknown'))} AS surface FROM orders")
    code2 = "right(split_part(c_name, '.', 1), 2)"
    sql["parse_suffix_code"] = (f"SELECT c_custkey, {code2} AS code, {_case(code2, catalog.LUO_SENSOR_CODES)} "
                                f"AS location FROM customer")
    sql["parse_parent_and_stem"] = r"""
WITH n AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages),
s AS (SELECT *, CASE WHEN regexp_matches(name, '^.+\.[^.]+$')
                     THEN regexp_extract(name, '^(.+)\.[^.]+$', 1) ELSE name END AS stem FROM n)
SELECT page_id,
  CASE WHEN len(string_split(url, '/')) >= 2 THEN string_split(url, '/')[-2] END AS parent,
  name, stem,
  CASE WHEN len(string_split(stem, '_')) >= 2 THEN TRY_CAST(string_split(stem, '_')[-2] AS INTEGER) END AS sid,
  TRY_CAST(string_split(stem, '_')[-1] AS INTEGER) AS trial_no
FROM s"""
    sql["stack_by_name"] = """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS mktsegment, 'customer' AS source FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       'supplier' AS source FROM supplier"""
    sql["schema_align"] = """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS mktsegment FROM supplier"""
    sql["missing_subjects"] = """
SELECT c_custkey, c_name FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)"""
    sql["missing_recordings"] = """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)"""
    sql["linearity_packets"] = _linearity(
        "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) * 10 AS time_ms FROM lineitem",
        "l_orderkey", "100.0::DOUBLE")
    sql["linearity_conversations"] = _linearity(
        "SELECT conv_id, turn * 10 AS time_ms FROM conversations", "conv_id", "100.0::DOUBLE")
    sql["linearity_harmonised"] = _linearity(
        f"SELECT sid, time_ms FROM ({_beach(rounded=False)})", "sid",
        f"1000.0::DOUBLE / {HOUR_US // 1000}.0::DOUBLE")
    cols = ["time_ms", "sid", "surface", *sensors]
    profile = " UNION ALL ".join(
        f"SELECT {_q(c)} AS column_name, count(*) FILTER (WHERE {c} IS NULL"
        + (f" OR isnan({c})" if c in sensors else "") + ") AS null_count, count(*) AS total_rows FROM h"
        for c in cols)
    sql["null_profile"] = f"WITH h AS ({_beach(rounded=False)}) SELECT * FROM ({profile}) WHERE null_count > 0"
    sql["null_context"] = f"""
WITH h AS ({_beach(rounded=False)}),
r AS (SELECT sid, time_ms, {_null_cols(['time_ms', *sensors], sensors)} AS null_columns,
        row_number() OVER (PARTITION BY sid ORDER BY time_ms) - 1 AS pos FROM h),
m AS (SELECT *, CASE WHEN null_columns <> '' THEN count(*) FILTER (WHERE null_columns <> '')
             OVER (PARTITION BY sid ORDER BY pos ROWS UNBOUNDED PRECEDING) END AS example_no,
        count(*) FILTER (WHERE null_columns <> '') OVER (PARTITION BY sid) AS flagged FROM r),
c AS (SELECT *, {", ".join(f"{'lag' if o > 0 else 'lead'}(example_no, {abs(o)}) OVER (PARTITION BY sid ORDER BY pos) AS e{i}"
                           for i, o in enumerate(range(-2, 3)))} FROM m)
{" UNION ALL ".join(f"SELECT sid, e{i} AS example_no, CAST({o} AS INTEGER) AS ctx_offset, time_ms, null_columns, greatest(flagged - 3, 0) AS more_flagged FROM c WHERE e{i} <= 3"
                    for i, o in enumerate(range(-2, 3)))}"""
    cols_types = [("time_ms", "bigint"), ("sid", "string"), ("surface", "string")] + \
        [(c, "double") for c in sensors]
    col_rows = ", ".join(f"({_q(n)}, {_q(t)})" for n, t in cols_types)
    loc_rows = ", ".join(f"({_q(s_)})" for s_ in sorted(EVENT_SENSORS))
    fs = f"1000.0::DOUBLE / {HOUR_US // 1000}.0::DOUBLE"
    lin = _linearity(f"SELECT sid, time_ms FROM h", "sid", fs).replace("WITH p AS", "p AS", 1)
    sql["quality_report"] = f"""
WITH h AS ({_beach(rounded=False)}),
{lin.strip().rsplit("SELECT *, NOT has_negative", 1)[0].rstrip()},
l AS (SELECT *, NOT has_negative AND NOT out_of_tolerance AS linear FROM a),
n AS (SELECT * FROM ({profile}) WHERE null_count > 0)
SELECT 'beach' AS dataset, 'column' AS "check", name AS key, 'info' AS status, type AS detail
  FROM (VALUES {col_rows}) v(name, type)
UNION ALL SELECT 'beach', 'location', loc, 'info', CAST(NULL AS VARCHAR) FROM (VALUES {loc_rows}) v(loc)
UNION ALL SELECT 'beach', 'metric', 'acc', 'info', CAST(NULL AS VARCHAR)
UNION ALL SELECT 'beach', 'linearity', sid, CASE WHEN linear THEN 'pass' ELSE 'fail' END,
  'points=' || CAST(n_points AS VARCHAR) || ' negative=' || CAST(has_negative AS VARCHAR)
  || ' out_of_tolerance=' || CAST(out_of_tolerance AS VARCHAR) FROM l
UNION ALL SELECT 'beach', 'nulls', column_name, 'warn',
  CAST(null_count AS VARCHAR) || '/' || CAST(total_rows AS VARCHAR) FROM n
UNION ALL SELECT 'beach', 'null_example', sid || '/' || CAST(example_no AS VARCHAR) || '/' || CAST(ctx_offset AS VARCHAR),
  CASE WHEN null_columns <> '' THEN 'warn' ELSE 'info' END, CAST(time_ms AS VARCHAR) || ': ' || null_columns
  FROM ({sql["null_context"]})"""
    return sql
