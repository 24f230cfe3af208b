"""SQL counterparts of the queries, for another engine to run on the same tables.

Each gives the same columns and rows as the query of the same name. Sketched counts
and bytes on disk are compared in the query, which returns whether they agree.
"""

from skyledger import schemas
from skyledger.catalog import queries as q
from skyledger.functions.uniform import LAST_SHIFT, ROUNDS, STEPS, WORD, stream_keys
from skyledger.operators.weather import CODES, DRAWN, MEASURES

LINE_ITEM_IDS = "SELECT range AS id, TIMESTAMP '{at}' AS event_time FROM range((SELECT count(*) FROM lineitem))".format(
    at=q.LOAD_TIME
)
EVENT_IDS = "SELECT event_id AS id, ts AS event_time FROM events"


def _draws(ids: str) -> str:
    """Common table expressions ending in ``draws``: one 32-bit draw per column."""

    def each(expression) -> str:
        return ", ".join(f"{expression(name)} AS {name}" for name in DRAWN)

    steps = [
        f"ids AS ({ids})",
        "step0 AS (SELECT id, event_time, "
        + each(lambda name: f"xor(id & {WORD}, {stream_keys(name, q.SEED)[0]})")
        + " FROM ids)",
    ]
    for i, (shift, multiplier) in enumerate(ROUNDS):

        def mixed(name: str) -> str:
            added = f" + {stream_keys(name, q.SEED)[i + 1]}" if i < 2 else ""
            word = f"((xor({name}, {name} >> {shift}) * {multiplier}{added}) & {WORD})"
            return f"xor({word}, id >> 32)" if i == 0 else word

        steps.append(f"step{i + 1} AS (SELECT id, event_time, {each(mixed)} FROM step{i})")
    steps.append(
        "draws AS (SELECT id, event_time, "
        + each(lambda name: f"xor({name}, {name} >> {LAST_SHIFT})")
        + f" FROM step{len(ROUNDS)})"
    )
    return ",\n".join(steps)


def _generated(ids: str, with_id: bool = False) -> str:
    measures = ", ".join(
        f"{name} / {float(STEPS)}::DOUBLE * {span} + {offset} AS {name}" for name, (span, offset) in MEASURES.items()
    )
    codes = ", ".join(f"CAST(floor({name} / {float(STEPS)}::DOUBLE * {levels}) AS INT) AS {name}" for name, levels in CODES.items())
    key = "id, " if with_id else ""
    return (
        f"SELECT {key}{measures}, {codes}, is_day / {float(STEPS)}::DOUBLE > 0.5 AS is_day, event_time, "
        f"id % {schemas.BATCHES} AS batch_id FROM draws"
    )


def _stored(ids: str) -> str:
    """Common table expressions ending in ``stored``: the rows in their stored types."""
    kinds = {field.name: field.dataType.simpleString() for field in schemas.WEATHER_TARGET}
    coerced = ", ".join(f"CAST({name} AS {kinds[name]}) AS {name}" for name in [*MEASURES, *CODES])
    return (
        f"{_draws(ids)},\ngenerated AS ({_generated(ids, with_id=True)}),\n"
        f"stored AS (SELECT id + 1 AS id, {coerced}, is_day, event_time, CAST(batch_id AS INT) AS batch_id FROM generated)"
    )


def _rounded_mean(units: str, count: str, units_per_hundredth: int) -> str:
    """Hundredths from a sum of integer units, half away from zero, one rounding."""
    scale = units_per_hundredth
    return (
        f"CAST(sign({units}) AS BIGINT) * ((2 * {scale} * abs({units}) + {count}) // (2 * nullif({count}, 0)))"
    )


def _summary(source: str, time_col: str, value_units: str, units_per_hundredth: int) -> str:
    mean = _rounded_mean("units", "filled", units_per_hundredth)
    return (
        f"SELECT record_count, earliest_event, latest_event, "
        f"CAST(coalesce({mean}, 0) / 100.0 AS DECIMAL(5,2)) AS avg_temperature FROM ("
        f"SELECT count(*) AS record_count, min({time_col}) AS earliest_event, max({time_col}) AS latest_event, "
        f"CAST(sum({value_units}) AS BIGINT) AS units, count({value_units}) AS filled FROM {source})"
    )


TENTHS = "CAST(temperature * 10 AS BIGINT)"
HUNDREDTHS = "CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT)"

_LINEITEM_TYPES = {
    "l_orderkey": "bigint",
    "l_partkey": "bigint",
    "l_suppkey": "bigint",
    "l_linenumber": "int",
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_linestatus": "string",
    "l_shipdate": "timestamp_ntz",
}
COLUMN_PROFILE = " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, '{kind}' AS data_type, {position} AS ordinal_position, count(*) AS rows, "
    f"count(*) - count({name}) AS nulls, count(DISTINCT {name}) AS distinct_values, "
    f"CAST(min({name}) AS VARCHAR) AS least, CAST(max({name}) AS VARCHAR) AS greatest FROM lineitem"
    for position, (name, kind) in enumerate(_LINEITEM_TYPES.items(), start=1)
)

SCHEMA_LISTING = " UNION ALL ".join(
    f"SELECT '{field.name}' AS column_name, '{field.dataType.simpleString()}' AS data_type, "
    f"{position} AS ordinal_position, {len(schemas.WEATHER_TARGET)}::BIGINT AS n_columns"
    for position, field in enumerate(schemas.WEATHER_TARGET, start=1)
)

# Load planning


def _duration_text(seconds: str) -> str:
    whole = f"CAST(floor({seconds}) AS BIGINT)"
    return (
        f"{whole} // 3600 || ':' || lpad(CAST({whole} // 60 % 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({whole} % 60 AS VARCHAR), 2, '0')"
    )


REQUESTS = f"""requests AS (
  SELECT o_orderkey AS request_id,
         coalesce(CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey * 77777 END, {schemas.REQUEST_DEFAULTS['num_records']}) AS num_records,
         coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN 'weather_' || o_orderkey END, '{schemas.REQUEST_DEFAULTS['table_name']}') AS table_name,
         coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'xlarge' WHEN '2-HIGH' THEN 'large'
                       WHEN '3-MEDIUM' THEN 'medium' WHEN '5-LOW' THEN 'small'
                       ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'huge' END END, '{schemas.REQUEST_DEFAULTS['data_size']}') AS data_size
  FROM orders),
tiers(tier, executor_memory, executor_cores, driver_memory, shuffle_partitions, parallelism, rate) AS (
  VALUES {", ".join(str(row) for row in schemas.TIER_ROWS)}),
tiered AS (
  SELECT * FROM requests JOIN tiers
  ON tier = CASE WHEN data_size IN (SELECT tier FROM tiers) THEN data_size ELSE '{schemas.DEFAULT_TIER}' END)"""

LOAD_PLAN = f"""WITH {REQUESTS},
planned AS (
  SELECT *, CAST(num_records AS DOUBLE) / rate AS seconds,
         CASE WHEN num_records >= 100000000 THEN least(parallelism * 8, 2000)
              WHEN num_records >= 10000000 THEN parallelism * 4
              WHEN num_records >= 1000000 THEN parallelism * 2
              ELSE parallelism END AS partitions
  FROM tiered)
SELECT request_id, num_records, table_name, data_size,
       CASE WHEN num_records < 1000000 THEN 'small' WHEN num_records < 100000000 THEN 'medium'
            WHEN num_records < 1000000000 THEN 'large' ELSE 'xlarge' END AS recommended_size,
       CAST(rate AS BIGINT) AS estimated_rate_per_sec,
       seconds AS estimated_time_seconds, seconds / 3600 AS estimated_time_hours,
       {_duration_text('seconds')} AS estimated_time_formatted,
       executor_memory, executor_cores, driver_memory, shuffle_partitions, parallelism,
       CAST(partitions AS BIGINT) AS planned_partitions, CAST(least(partitions, 20) AS BIGINT) AS jdbc_writers
FROM planned"""

LOAD_PLAN_LEGACY = f"""WITH {REQUESTS},
planned AS (
  SELECT *, greatest(num_records // CASE WHEN num_records < 100000 THEN 10000
                                         WHEN num_records < 10000000 THEN 50000 ELSE 100000 END, parallelism) AS partitions
  FROM tiered)
SELECT request_id, num_records, data_size, CAST(partitions AS BIGINT) AS planned_partitions,
       CAST(least(partitions, 10) AS BIGINT) AS jdbc_writers
FROM planned"""

# People

PEOPLE = f"""fallback(craft, name) AS (VALUES {", ".join(str(row) for row in schemas.FALLBACK_PEOPLE)}),
people AS (
  SELECT c_custkey AS body_id, false AS used_fallback, c_mktsegment AS craft, c_name AS name
  FROM customer WHERE c_custkey % 5 > 1
  UNION ALL
  SELECT c_custkey, false, 'nation ' || c_nationkey, 'deputy of ' || c_name FROM customer WHERE c_custkey % 5 > 1
  UNION ALL
  SELECT c_custkey, true, craft, name FROM customer, fallback WHERE c_custkey % 5 <= 1)"""

PEOPLE_EXPLODED = f"WITH {PEOPLE} SELECT body_id, used_fallback, craft, name FROM people"

PEOPLE_SENTENCES = f"""WITH {PEOPLE}
SELECT body_id, name || ' is currently in space flying on the ' || craft || '! {schemas.GREETING}' AS sentence FROM people"""

_LISTED = """[{'craft': c_mktsegment, 'name': c_name},
              {'craft': 'nation ' || c_nationkey, 'name': 'deputy of ' || c_name}]"""
PEOPLE_COUNTS = f"""SELECT
  CASE c_custkey % 5 WHEN 0 THEN 'unreadable ' || c_name
       WHEN 1 THEN CAST(to_json({{'people': {_LISTED}}}) AS VARCHAR)
       WHEN 2 THEN CAST(to_json({{'number': 3, 'people': {_LISTED}}}) AS VARCHAR)
       WHEN 3 THEN CAST(to_json({{'number': NULL, 'people': {_LISTED}}}) AS VARCHAR)
       ELSE CAST(to_json({{'number': 2, 'people': {_LISTED}}}) AS VARCHAR) END AS body,
  c_custkey % 5 <= 1 AS used_fallback,
  CASE c_custkey % 5 WHEN 0 THEN 12 WHEN 1 THEN 12 WHEN 2 THEN 3 WHEN 3 THEN NULL ELSE 2 END AS number,
  CASE WHEN c_custkey % 5 <= 1 THEN 12 ELSE 2 END AS listed,
  c_custkey % 5 NOT IN (2, 3) AS counts_agree
FROM customer"""

# Reports


def _size_text(size: str) -> str:
    return (
        f"CASE WHEN {size} < 10240 THEN {size} || ' bytes' "
        f"WHEN ({size} >> 9) < 20479 THEN (({size} >> 9) + 1) // 2 || ' kB' "
        f"WHEN ({size} >> 19) < 20479 THEN (({size} >> 19) + 1) // 2 || ' MB' "
        f"WHEN ({size} >> 29) < 20479 THEN (({size} >> 29) + 1) // 2 || ' GB' "
        f"ELSE (({size} >> 39) + 1) // 2 || ' TB' END"
    )


RUN_REPORT = f"""WITH days AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'signup') AS signups,
         count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (event_type = 'view') AS views,
         CAST(sum(event_id * 10) AS BIGINT) AS requested,
         CAST(sum({HUNDREDTHS}) AS BIGINT) AS units, count(value) AS filled
  FROM events GROUP BY ALL),
log AS (
  SELECT user_id || '-' || day AS run_id,
         CASE errors WHEN 0 THEN 'success' WHEN 1 THEN 'failed' END AS logged,
         requested, requested - signups AS written,
         CASE WHEN clicks > 0 THEN CAST(CAST(units / 100.0 AS DECIMAL(12,2)) AS DOUBLE) END AS elapsed,
         CASE WHEN views > 0 THEN {_size_text('(requested * 1000)')} END AS table_size,
         CASE WHEN views <> 1 THEN CAST(({_rounded_mean('units', 'filled', 1)}) / 100.0 AS DECIMAL(5,2)) END AS average,
         CASE WHEN signups >= 2 THEN 'signups ' || signups END AS report_error
  FROM days),
judged AS (
  SELECT *, report_error IS NULL AND coalesce(logged = 'success', false) AS complete,
         CAST(written AS DOUBLE) / nullif(elapsed, 0) AS rate
  FROM log)
SELECT run_id,
       CASE WHEN report_error IS NOT NULL THEN 'cleanup_failed' WHEN complete THEN 'completed'
            ELSE 'completed_with_warnings' END AS status,
       CASE WHEN report_error IS NOT NULL THEN 'Cleanup failed: ' || report_error
            WHEN complete THEN 'Spark ETL pipeline completed successfully'
            ELSE 'Pipeline completed but some tasks may have failed' END AS message,
       written = requested AS all_rows_written,
       rate AS rows_per_second,
       format('{{:,}}', written) AS records_text,
       coalesce(table_size, 'Unknown') AS table_size_text,
       coalesce(CAST(average AS VARCHAR), 'Unknown') AS average_text,
       format('{{:.2f}}', coalesce(elapsed, 0.0::DOUBLE)) || ' seconds' AS time_text,
       format('{{:,}}', CAST(round_even(rate, 0) AS BIGINT)) || ' records/second' AS rate_text,
       CASE WHEN complete THEN coalesce(elapsed, 0.0::DOUBLE) END AS final_finalization_time_seconds,
       CASE WHEN complete THEN requested END AS final_records_processed,
       CASE WHEN complete THEN table_size END AS final_table_size,
       CASE WHEN complete THEN written END AS final_record_count,
       CASE WHEN complete THEN coalesce(CAST(average AS DOUBLE), 0.0::DOUBLE) END AS final_avg_temperature
FROM judged"""

_STORED_LINES = _stored(LINE_ITEM_IDS)
_BOX = q.BOX

ORACLES: dict[str, str] = {
    "synth_weather": f"WITH {_draws(LINE_ITEM_IDS)}\n{_generated(LINE_ITEM_IDS)}",
    "load_coerced": f"WITH {_STORED_LINES}\nSELECT * FROM stored",
    "load_stored": f"WITH {_STORED_LINES}\nSELECT * FROM stored",
    "coerce_split": "SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS stored_price, "
    "CASE WHEN o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL "
    "THEN 'o_totalprice' ELSE '' END AS rejected FROM orders",
    "split_written": "SELECT o_orderkey, o_custkey, CASE WHEN fits AND short THEN price END AS stored_price, o_orderdate, "
    "CASE WHEN NOT (fits AND short) THEN o_totalprice END AS original_price, "
    "concat_ws(',', CASE WHEN NOT short THEN 'o_custkey' END, CASE WHEN NOT fits THEN 'o_totalprice' END) AS rejected "
    "FROM (SELECT *, TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS price, "
    "o_totalprice IS NULL OR TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NOT NULL AS fits, "
    "o_custkey IS NULL OR TRY_CAST(o_custkey AS SMALLINT) IS NOT NULL AS short FROM orders)",
    "load_summary": f"WITH {_stored(EVENT_IDS)}\n{_summary('stored', 'event_time', TENTHS, 10)}",
    "events_summary": _summary("events", "ts", HUNDREDTHS, 1),
    "column_profile": COLUMN_PROFILE,
    "column_profile_sketched": f"SELECT * EXCLUDE (distinct_values), true AS distinct_close FROM ({COLUMN_PROFILE})",
    "table_size": "SELECT count(*) AS record_count, true AS sizes_agree, true AS files_agree FROM events",
    "finalized_layouts": f"WITH {_STORED_LINES},\nfound AS ("
    f"SELECT 'batch' AS lookup, count(*) AS rows, coalesce(sum(id), 0)::BIGINT AS ids FROM stored WHERE batch_id = {q.BATCH} UNION ALL "
    "SELECT 'day', count(*), coalesce(sum(id), 0)::BIGINT FROM stored UNION ALL "
    "SELECT 'cell', count(*), coalesce(sum(id), 0)::BIGINT FROM stored "
    f"WHERE latitude BETWEEN {_BOX['south']} AND {_BOX['north']} AND longitude BETWEEN {_BOX['west']} AND {_BOX['east']}) "
    "SELECT 'chosen' AS counts, * FROM found UNION ALL SELECT 'given', * FROM found WHERE lookup <> 'day'",
    "stored_keys": "SELECT 'load' AS source, count(*) AS rows, count(*) AS keys, 0 AS repeated_keys, "
    "0 AS rows_without_key FROM lineitem UNION ALL "
    "SELECT 'lineitem', CAST(sum(held) AS BIGINT), count(l_orderkey), count(*) FILTER (held > 1 AND l_orderkey IS NOT NULL), "
    "CAST(coalesce(sum(held) FILTER (l_orderkey IS NULL), 0) AS BIGINT) "
    "FROM (SELECT l_orderkey, count(*) AS held FROM lineitem GROUP BY l_orderkey)",
    "table_roundtrip": f"WITH {_STORED_LINES}\nSELECT *, true AS loaded_at_filled FROM stored",
    "finalized_load": f"WITH {_STORED_LINES}\nSELECT record_count AS records_processed, record_count, "
    "CAST(avg_temperature AS DOUBLE) AS avg_temperature, true AS timed, true AS sized "
    f"FROM ({_summary('stored', 'event_time', TENTHS, 10)})",
    "reported_load": f"WITH {_STORED_LINES}\nSELECT 'small' AS data_size, "
    "CASE WHEN record_count < 1000000 THEN 'small' WHEN record_count < 100000000 THEN 'medium' "
    "WHEN record_count < 1000000000 THEN 'large' ELSE 'xlarge' END AS recommended_size, "
    f"{_duration_text('record_count::DOUBLE / 15000')} AS estimated_time_formatted, 'completed' AS status, "
    "'Spark ETL pipeline completed successfully' AS message, true AS all_rows_written, "
    "format('{:,}', record_count) AS records_text, CAST(avg_temperature AS VARCHAR) AS average_text, "
    f"record_count AS stored_count, true AS all_rows_stored, true AS timed, true AS finalized_within FROM ({_summary('stored', 'event_time', TENTHS, 10)})",
    "schema_listing": SCHEMA_LISTING,
    "reload_idempotent": "SELECT orders.*, run_id FROM orders, (VALUES ('first'), ('')) AS runs(run_id)",
    "grown_load": f"WITH {_stored(EVENT_IDS)}, "
    "steps(step, every, fresh) AS (VALUES ('first', false, 'first'), ('second', true, 'second'), ('again', true, '')), "
    "held AS (SELECT s.step, s.fresh, CASE WHEN id % 3 <> 0 THEN 'first' ELSE 'second' END AS run, r.* "
    "FROM steps s JOIN stored r ON s.every OR r.id % 3 <> 0) "
    + " UNION ALL ".join(
        f"SELECT *, (SELECT count(*) FILTER (run = fresh) FROM held WHERE step = '{step}') AS rows_read, '{step}' AS step FROM "
        f"({_summary(f'(SELECT * FROM held WHERE step = {step!r})', 'event_time', TENTHS, 10)})"
        for step in ("first", "second", "again")
    ),
    "merged_profile": "SELECT * EXCLUDE (distinct_values), true AS distinct_close, "
    "CASE WHEN data_type IN ('bigint', 'int', 'double') THEN true END AS median_close FROM (" + COLUMN_PROFILE + ")",
    "rows_written": "SELECT count(*) AS requested, count(*) AS written, count(*) AS stored, "
    "count(*) AS committed_shuffled, count(*) AS stored_shuffled FROM events",
    "csv_source": "SELECT * FROM customer",
    "batch_lookup": f"WITH {_stored(EVENT_IDS)}\nSELECT * FROM stored WHERE batch_id = {q.BATCH}",
    "time_range": f"SELECT * FROM events WHERE ts >= TIMESTAMP '{q.RANGE[0]}' AND ts < TIMESTAMP '{q.RANGE[1]}'",
    "geo_box": f"WITH {_stored(EVENT_IDS)}\nSELECT *, CAST(least(floor((latitude + 90) / 30), 5) * 12 + "
    "least(floor((longitude + 180) / 30), 11) AS INT) AS cell_30 FROM stored "
    f"WHERE latitude BETWEEN {_BOX['south']} AND {_BOX['north']} AND longitude BETWEEN {_BOX['west']} AND {_BOX['east']}",
    "load_plan": LOAD_PLAN,
    "load_plan_legacy": LOAD_PLAN_LEGACY,
    "people_exploded": PEOPLE_EXPLODED,
    "people_sentences": PEOPLE_SENTENCES,
    "people_counts": PEOPLE_COUNTS,
    "publish_table": PEOPLE_EXPLODED,
    "run_report": RUN_REPORT,
}
