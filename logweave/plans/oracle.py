"""DuckDB oracle SQL for every driver query.

Written from the adapter's rules (FIXTURES.md section 3), not from the
engine's parser: each record field is derived directly from the ``events``
columns, so the oracle checks the JSON parse, the regex extractors, the time
parsing and the operators at once. Pattern oracles are brute force (windows
and self-joins). Only the ``events`` view is read.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
READ_AT = "TIMESTAMP '2024-01-31 00:30:00'"


def _fmt(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%g')"


# The adapted record. kind: the corruption rule that applies first, or 'ok'.
BASE = f"""
ev AS (
  SELECT event_id AS seq, CAST(ts AS TIMESTAMP) AS ts, user_id,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' WHEN 'click' THEN 'INFO'
                         WHEN 'signup' THEN 'NOTICE' WHEN 'purchase' THEN 'DEBUG' END AS lvl
  FROM events
),
ad AS (
  SELECT seq, ts, user_id, lvl,
         CASE lvl WHEN 'ERROR' THEN '3' WHEN 'WARNING' THEN '4' WHEN 'NOTICE' THEN '5'
                  WHEN 'INFO' THEN '6' WHEN 'DEBUG' THEN '7' END AS code,
         (['Nova', 'Neutron', 'Keystone', 'Cinder'])[seq % 4 + 1] AS service,
         'host_' || CAST(user_id % 3 AS VARCHAR) AS hostname,
         CAST(seq // 64 AS VARCHAR) AS corr,
         {_fmt('ts')} AS ts_ms,
         CASE WHEN seq % 97 = 0 THEN 'bad_json' WHEN seq % 89 = 0 THEN 'missing_field'
              WHEN seq % 83 = 0 THEN 'no_bracket' WHEN seq % 79 = 0 THEN 'no_body_time'
              WHEN seq % 73 = 0 THEN 'bad_word' ELSE 'ok' END AS kind
  FROM ev
),
rec AS (
  SELECT *,
    CASE kind
      WHEN 'no_bracket' THEN lower(service) || ' - - - ' || ts_ms || ' ' || CAST(seq AS VARCHAR) || ' ' || lvl
           || ' mod.name ( Synthetic log CEP_ID=' || corr || ' ) user=' || CAST(user_id AS VARCHAR)
      WHEN 'no_body_time' THEN lower(service) || ' - - - ' || CAST(seq AS VARCHAR) || ' ' || lvl
           || ' mod.name [ Synthetic log CEP_ID=' || corr || ' ] user=' || CAST(user_id AS VARCHAR)
      ELSE lower(service) || ' - - - ' || ts_ms || ' ' || CAST(seq AS VARCHAR) || ' '
           || CASE WHEN kind = 'bad_word' THEN 'OVERHEATED' ELSE lvl END
           || ' mod.name [ Synthetic log CEP_ID=' || corr || ' ]'
           || CASE WHEN seq % 61 = 0 THEN chr(10) ELSE ' ' END || 'user=' || CAST(user_id AS VARCHAR)
    END AS raw_body,
    CASE WHEN seq % 50 = 0 THEN ''
         WHEN seq % 7 = 0 THEN strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+01:00'
         ELSE ts_ms END AS json_ts,
    CASE WHEN seq % 2 = 1 THEN code ELSE '5' END AS json_sev,
    -- fields re-derived from the message text
    CASE WHEN kind = 'bad_word' THEN '' ELSE code END AS p_sev,
    CASE WHEN kind = 'no_body_time' THEN '1970-01-01 00:00:00.0' ELSE ts_ms END AS p_ts,
    CASE WHEN kind = 'no_bracket' THEN ''
         ELSE '[ Synthetic log CEP_ID=' || corr || ' ]'
              || CASE WHEN kind IN ('ok', 'bad_word') AND seq % 61 = 0 THEN ''
                      ELSE ' user=' || CAST(user_id AS VARCHAR) END END AS p_body,
    CASE WHEN kind = 'no_body_time' THEN TIMESTAMP '1970-01-01 00:00:00'
         ELSE date_trunc('millisecond', ts) END AS p_time
  FROM ad
),
parsed AS (SELECT * FROM rec WHERE kind NOT IN ('bad_json', 'missing_field')),
acc AS (
  SELECT *, lvl AS level, epoch_ms(p_time) AS t FROM parsed
  WHERE kind IN ('ok', 'no_body_time') AND lvl IN ('ERROR', 'WARNING', 'INFO')
),
hz AS (
  SELECT * FROM (VALUES ('1h', 3600), ('6h', 21600), ('12h', 43200), ('24h', 86400),
                        ('1w', 604800), ('1m', 2419200)) AS h(horizon_id, horizon_s)
),
fan AS (
  SELECT acc.*, hz.horizon_id, hz.horizon_s,
         (epoch_ms({AS_OF}) - epoch_ms(p_time)) // 1000 AS age_s
  FROM acc CROSS JOIN hz
),
stack AS (
  SELECT horizon_id AS id, 'boston' AS region, level AS loglevel, service,
         CAST(hour(p_time) * 60 + minute(p_time) AS INTEGER) AS timeframe, p_ts AS tfhours,
         CAST(horizon_s - age_s AS INTEGER) AS ttl_s, seq
  FROM fan WHERE age_s BETWEEN 0 AND horizon_s AND horizon_s - age_s > 0
),
raw AS (
  SELECT strftime(p_time, '%Y-%-m-%-d') AS date, 'boston' AS region, level AS loglevel, service,
         hostname AS node_type, {_fmt('p_time')} AS log_ts, p_body AS payload, seq
  FROM acc
)"""

RECORD_KEYS = ("severity", "body", "spriority", "hostname", "protocol", "port", "sender", "service", "id",
               "facility", "timestamp")


def _sql(body: str) -> str:
    return f"WITH {BASE}\n{body}"


def _fields(sev: str, body: str, ts: str) -> str:
    return (f"seq, {sev} AS severity, {body} AS body, '13' AS spriority, hostname, 'UDP' AS protocol, "
            f"'5514' AS port, '/10.20.30.40' AS sender, service, CAST(seq AS VARCHAR) AS id, "
            f"'1' AS facility, {ts} AS timestamp")


def _alerts(first: str, second: str, key: str, mode: str, within_ms: int, scope: str) -> str:
    """Brute-force pattern oracle over ``acc`` rows (key column ``k``)."""
    pre = f"""
, base AS (SELECT *, {key} AS k, ({first}) AS is_f, ({second}) AS is_s FROM acc WHERE {key} IS NOT NULL)"""
    if mode == "strict":
        body = f"""
, nx AS (
  SELECT k, seq, t, p_time, is_f,
         lead(seq) OVER w AS seq2, lead(t) OVER w AS t2, lead(p_time) OVER w AS time2, lead(is_s) OVER w AS s2
  FROM base WINDOW w AS (PARTITION BY k ORDER BY t, seq))
SELECT k AS {scope}, seq AS first_seq, seq2 AS second_seq,
       {_fmt('p_time')} AS first_time, {_fmt('time2')} AS second_time
FROM nx WHERE is_f AND s2 AND t2 - t < {within_ms}"""
    elif mode == "any":
        body = f"""
SELECT f.k AS {scope}, f.seq AS first_seq, s.seq AS second_seq,
       {_fmt('f.p_time')} AS first_time, {_fmt('s.p_time')} AS second_time
FROM base f JOIN base s ON f.k = s.k AND (s.t > f.t OR (s.t = f.t AND s.seq > f.seq))
WHERE f.is_f AND s.is_s AND s.t - f.t < {within_ms}"""
    else:
        body = f"""
, firstnext AS (
  SELECT f.k, f.seq, f.t, f.p_time, arg_min(s.seq, (s.t, s.seq)) AS seq2
  FROM base f JOIN base s ON f.k = s.k AND (s.t > f.t OR (s.t = f.t AND s.seq > f.seq))
  WHERE f.is_f AND s.is_s
  GROUP BY f.k, f.seq, f.t, f.p_time)
SELECT x.k AS {scope}, x.seq AS first_seq, x.seq2 AS second_seq,
       {_fmt('x.p_time')} AS first_time, {_fmt('s.p_time')} AS second_time
FROM firstnext x JOIN base s ON s.seq = x.seq2
WHERE s.t - x.t < {within_ms}"""
    return _sql(pre + body)


def _chain(steps: list[str], key: str | None, within_ms: int, scope: str | None) -> str:
    """Brute force for chains: step conditions over ``x`` (the row), ``f`` (the first row) and ``p`` (the row before).

    ``p.nxt`` is the number of the key's next row; a condition on it makes the step strict.
    """
    names = ("first", "second", "third")[:len(steps)]
    k = key or "0"
    body = f"""
, base AS (SELECT *, {k} AS k, row_number() OVER (PARTITION BY {k} ORDER BY t, seq) AS num FROM acc WHERE {k} IS NOT NULL)
, m1 AS (SELECT x.k, x.seq AS s1, x.num AS n1, x.t AS t1 FROM base x WHERE {steps[0]})"""
    for i, step in enumerate(steps[1:], 2):
        strict = step.startswith("STRICT ")
        cond = step.removeprefix("STRICT ")
        follows = f"x.num = m.n{i - 1} + 1" if strict else f"x.num > m.n{i - 1}"
        had = ", ".join(f"m.s{j}, m.n{j}" for j in range(1, i))
        body += f"""
, m{i} AS (SELECT m.k, m.t1, {had}, arg_min(x.seq, x.num) AS s{i}, min(x.num) AS n{i}
  FROM m{i - 1} m JOIN base f ON f.seq = m.s1 JOIN base x ON x.k = m.k AND {follows} AND x.t - m.t1 < {within_ms} AND ({cond}) GROUP BY ALL)"""
    n = len(steps)
    out = ([f"m.k AS {scope}"] if scope else []) + [f"m.s{i} AS {name}_seq" for i, name in enumerate(names, 1)]
    out += [f"{_fmt(f'e{i}.p_time')} AS {name}_time" for i, name in enumerate(names, 1)]
    joins = " ".join(f"JOIN base e{i} ON e{i}.seq = m.s{i}" for i in range(1, n + 1))
    return _sql(body + f"""
SELECT {', '.join(out)} FROM m{n} m {joins}""")


ERR_FIRST = "p_sev = '3'"
CORR_FIRST = "p_sev = '3' AND service = 'Nova' AND p_body LIKE '%CEP_ID%'"
CORR_SECOND = "p_sev = '6' AND service = 'Neutron' AND p_body LIKE '%CEP_ID%'"
CORR_KEY = "CASE WHEN p_body LIKE '%CEP_ID=%' THEN corr END"
TEN_MIN, TWO_H = 600000, 7200000


def _json(prefix: str) -> str:
    fields = ["p_sev", "p_body", "'13'", "hostname", "'UDP'", "'5514'", "'/10.20.30.40'", "service",
              "CAST(seq AS VARCHAR)", "'1'", "p_ts"]
    parts = []
    for k, e in zip(RECORD_KEYS, fields):
        if e.startswith("'"):
            parts.append(f"'{k}': {e}")
        elif e.startswith("CAST"):
            parts.append(f"'{k}': CAST({prefix}seq AS VARCHAR)")
        else:
            parts.append(f"'{k}': {prefix}{e}")
    return "CAST(to_json({" + ", ".join(parts) + "}) AS VARCHAR)"


def _summary(prefix: str) -> str:
    return f"{prefix}service || '-' || {prefix}p_sev || '-' || {prefix}p_ts"


def _text_scan() -> str:
    keys_full = RECORD_KEYS
    exprs = ["json_sev", "raw_body", "'13'", "hostname", "'UDP'", "'5514'", "'/10.20.30.40'", "service",
             "CAST(seq AS VARCHAR)", "'1'", "json_ts"]

    def obj(skip_first: bool) -> str:
        pairs = [f"'{k}': {e}" for k, e in zip(keys_full, exprs)]
        if skip_first:
            pairs = pairs[1:]
        return "CAST(to_json({" + ", ".join(pairs) + "}) AS VARCHAR)"

    return _sql(f"""
SELECT seq, CASE kind WHEN 'bad_json' THEN '#corrupt line ' || CAST(seq AS VARCHAR) || ' {{severity'
                      WHEN 'missing_field' THEN {obj(True)}
                      ELSE {obj(False)} END AS value
FROM rec""")


def oracle_sql() -> dict[str, str]:
    q = {}
    q["text_scan"] = _text_scan()
    q["parse_entries"] = _sql(f"SELECT {_fields('p_sev', 'p_body', 'p_ts')} FROM parsed")
    q["parse_entries_noparse"] = _sql(f"SELECT {_fields('json_sev', 'raw_body', 'json_ts')} FROM parsed")
    q["body_timestamp"] = _sql("SELECT seq, p_ts AS body_timestamp FROM parsed")
    q["body_severity"] = _sql("SELECT seq, p_sev AS body_severity FROM parsed")
    q["body_info"] = _sql("SELECT seq, p_body AS body_info FROM parsed")
    q["to_event_time_formats"] = f"""
SELECT event_id AS seq,
       CASE event_id % 10
         WHEN 0 THEN {_fmt('ts')}
         WHEN 1 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S.%g')
         WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN 3 THEN strftime(ts, '%b %d %Y %H:%M:%S')
         WHEN 4 THEN strftime(ts, '%b %-d %Y %-H:%-M:%-S')
         WHEN 5 THEN strftime(ts, '%Y/%-m/%-d %-H:%-M:%-S.%g')
         WHEN 6 THEN strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.%f') || '+01:00'
         WHEN 7 THEN strftime(ts - INTERVAL 150 MINUTE, '%Y-%-m-%-dT%-H:%-M:%-S.%f') || '-0230'
         WHEN 8 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'UTC'
         ELSE 'about noon, day ' || CAST(event_id % 28 AS VARCHAR) END AS timestamp,
       CASE WHEN event_id % 10 = 9 THEN '1970-01-01 00:00:00.000'
            WHEN event_id % 10 IN (2, 3, 4) THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000'
            ELSE {_fmt('ts')} END AS event_time
FROM (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts FROM events)"""
    # the dot of the engine's pattern stops at every line end, not at \\n alone
    q["document_timestamp"] = r"""
SELECT doc_id, CASE WHEN m IS NULL OR m = '' THEN '1970-01-01 00:00:00.0' ELSE m END AS body_timestamp
FROM (SELECT doc_id, regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}[ \t\n\x0B\f\r][0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}') AS m
      FROM documents)"""
    q["document_severity"] = """
SELECT doc_id, w AS severity_word,
       CASE w WHEN 'ALERT' THEN '1' WHEN 'CRIT' THEN '2' WHEN 'EMERG' THEN '0' WHEN 'ERROR' THEN '3'
              WHEN 'WARNING' THEN '4' WHEN 'NOTICE' THEN '5' WHEN 'INFO' THEN '6' WHEN 'DEBUG' THEN '7' ELSE '' END
         AS body_severity
FROM (SELECT doc_id, regexp_extract(text, '[A-Z]{4,7}') AS w FROM documents)"""
    q["document_info"] = r"""
SELECT doc_id, regexp_extract(text, '\[[^\n\r\x{0085}\x{2028}\x{2029}]*') AS body_info FROM documents"""
    q["document_correlation_id"] = r"""
SELECT doc_id, CASE WHEN contains(text, 'CEP_ID=')
                    THEN regexp_extract(split_part(text, 'CEP_ID=', 2), '^[^ \t\n\x0B\f\r]*') END AS correlation_id
FROM documents"""
    q["severity_name"] = _sql("""
SELECT seq, json_sev AS severity,
       CASE json_sev WHEN '0' THEN 'EMERG' WHEN '1' THEN 'ALERT' WHEN '2' THEN 'CRIT' WHEN '3' THEN 'ERROR'
                     WHEN '4' THEN 'WARNING' WHEN '5' THEN 'NOTICE' WHEN '6' THEN 'INFO' WHEN '7' THEN 'DEBUG'
       END AS severity_name
FROM parsed""")
    q["severity_code"] = _sql("""
SELECT seq, CASE WHEN kind = 'bad_word' THEN 'OVERHEA' ELSE lvl END AS severity_word,
       CASE WHEN kind = 'bad_word' THEN NULL ELSE code END AS severity_code
FROM parsed""")
    q["valid_entries"] = _sql("""
SELECT seq, p_sev AS severity, service, p_ts AS timestamp, p_body AS body
FROM parsed WHERE kind IN ('ok', 'no_body_time')""")
    q["accepted_entries"] = _sql(f"""
SELECT seq, level, service, hostname, p_ts AS timestamp, {_fmt('p_time')} AS event_time, p_body AS body
FROM acc""")
    q["quarantine_counts"] = _sql("""
, reasons AS (
  SELECT CASE kind WHEN 'bad_json' THEN 'bad_json' WHEN 'missing_field' THEN 'missing_field'
                   WHEN 'bad_word' THEN 'no_severity' WHEN 'no_bracket' THEN 'no_info'
                   ELSE CASE WHEN lvl IN ('ERROR', 'WARNING', 'INFO') THEN NULL ELSE 'level_not_accepted' END
         END AS reject_reason
  FROM rec)
SELECT reject_reason, count(*) AS n_rows FROM reasons WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
    noparse = f"""
, np AS (
  SELECT *, date_trunc('millisecond', ts) AS np_time,
         CASE json_sev WHEN '3' THEN 'ERROR' WHEN '4' THEN 'WARNING' WHEN '5' THEN 'NOTICE'
                       WHEN '6' THEN 'INFO' WHEN '7' THEN 'DEBUG' END AS np_level,
         CASE WHEN json_ts = '' THEN 'no_timestamp'
              WHEN json_sev NOT IN ('3', '4', '6') THEN 'level_not_accepted' END AS np_reason
  FROM parsed)
, np_acc AS (SELECT * FROM np WHERE np_reason IS NULL)
, np_fan AS (
  SELECT np_acc.*, hz.horizon_id, hz.horizon_s, (epoch_ms({AS_OF}) - epoch_ms(np_time)) // 1000 AS age_s
  FROM np_acc CROSS JOIN hz)"""
    q["accepted_entries_noparse"] = _sql(noparse + f"""
SELECT seq, np_level AS level, service, json_ts AS timestamp, {_fmt('np_time')} AS event_time FROM np_acc""")
    q["quarantine_counts_noparse"] = _sql(noparse + """
, reasons AS (
  SELECT kind AS reject_reason FROM rec WHERE kind IN ('bad_json', 'missing_field')
  UNION ALL SELECT np_reason FROM np WHERE np_reason IS NOT NULL)
SELECT reject_reason, count(*) AS n_rows FROM reasons GROUP BY reject_reason""")
    q["stack_rows_noparse"] = _sql(noparse + """
SELECT horizon_id AS id, 'boston' AS region, np_level AS loglevel, service,
       CAST(hour(np_time) * 60 + minute(np_time) AS INTEGER) AS timeframe, json_ts AS tfhours,
       CAST(horizon_s - age_s AS INTEGER) AS ttl_s, seq
FROM np_fan WHERE age_s BETWEEN 0 AND horizon_s AND horizon_s - age_s > 0""")
    q["quarantine_rows"] = _sql("""
SELECT seq, CASE kind WHEN 'bad_json' THEN 'bad_json' WHEN 'missing_field' THEN 'missing_field'
                      WHEN 'bad_word' THEN 'no_severity' WHEN 'no_bracket' THEN 'no_info'
                      ELSE 'level_not_accepted' END AS reject_reason
FROM rec
WHERE kind <> 'ok' AND kind <> 'no_body_time' OR lvl NOT IN ('ERROR', 'WARNING', 'INFO')""")
    q["time_flags"] = _sql("""
SELECT seq, 'no_body_time' AS time_flag, '1970-01-01 00:00:00.000' AS event_time
FROM parsed WHERE kind = 'no_body_time'""")
    q["to_event_time"] = _sql(f"""
SELECT seq, json_ts AS timestamp,
       CASE WHEN json_ts = '' THEN '1970-01-01 00:00:00.000' ELSE {_fmt("date_trunc('millisecond', ts)")} END
         AS event_time
FROM parsed""")
    q["timeframe_minutes"] = _sql("SELECT seq, CAST(hour(p_time) * 60 + minute(p_time) AS INTEGER) AS timeframe FROM acc")
    q["correlation_id"] = _sql(f"SELECT seq, {CORR_KEY} AS correlation_id FROM parsed")
    q["remaining_ttl"] = _sql("SELECT seq, horizon_id, CAST(horizon_s - age_s AS INTEGER) AS ttl_s FROM fan")
    q["in_period"] = _sql("SELECT seq, horizon_id, age_s, age_s BETWEEN 0 AND horizon_s AS in_period FROM fan")
    q["horizon_fanout"] = _sql("SELECT seq, horizon_id, horizon_s FROM fan")
    q["node_rows"] = _sql(f"""
SELECT horizon_id AS id, level AS loglevel, 'az1' AS az, 'boston' AS region, hostname AS node_type, seq,
       horizon_s AS ttl_s, {_fmt(f"{AS_OF} + to_seconds(horizon_s)")} AS expires_at
FROM fan""")
    q["service_rows"] = _sql(f"""
SELECT horizon_id AS id, level AS loglevel, 'az1' AS az, 'boston' AS region, service, seq,
       horizon_s AS ttl_s, {_fmt(f"{AS_OF} + to_seconds(horizon_s)")} AS expires_at
FROM fan""")
    q["stack_rows"] = _sql("SELECT id, region, loglevel, service, timeframe, tfhours, ttl_s, seq FROM stack")
    q["stack_lookup_24h"] = _sql(
        "SELECT region, loglevel, service, timeframe, tfhours, ttl_s, seq FROM stack WHERE id = '24h'")
    q["stack_ttl_left"] = _sql(f"""
SELECT id, seq, CAST((epoch_ms({AS_OF}) + CAST(ttl_s AS BIGINT) * 1000 - epoch_ms({READ_AT})) // 1000 AS INTEGER)
       AS ttl_left
FROM stack WHERE epoch_ms({AS_OF}) + CAST(ttl_s AS BIGINT) * 1000 > epoch_ms({READ_AT})""")
    q["raw_rows"] = _sql("SELECT date, region, loglevel, service, node_type, log_ts, payload, seq FROM raw")
    q["raw_latest"] = _sql("""
SELECT date, service, loglevel, region, arg_max(node_type, seq) AS node_type, arg_max(log_ts, seq) AS log_ts,
       arg_max(payload, seq) AS payload, max(seq) AS seq
FROM raw GROUP BY date, service, loglevel, region""")
    q["raw_limit"] = _sql(
        "SELECT date, region, loglevel, service, node_type, log_ts, payload, seq FROM raw ORDER BY seq LIMIT 10")
    live_node = f"""
, live AS (
  SELECT horizon_id AS id, level AS loglevel, 'az1' AS az, 'boston' AS region, hostname AS node_type, service,
         seq, p_time + to_seconds(horizon_s) AS expires_at
  FROM fan WHERE p_time + to_seconds(horizon_s) > {AS_OF})"""
    q["node_live"] = _sql(live_node + f"""
SELECT id, loglevel, az, region, node_type, seq, {_fmt('expires_at')} AS expires_at FROM live""")
    q["service_live"] = _sql(live_node + f"""
SELECT id, loglevel, az, region, service, seq, {_fmt('expires_at')} AS expires_at FROM live""")
    q["node_counts"] = _sql(live_node + """
SELECT id, loglevel, az, region, node_type, count(*) AS n_rows FROM live GROUP BY ALL""")
    q["service_counts"] = _sql(live_node + """
SELECT id, loglevel, az, region, service, count(*) AS n_rows FROM live GROUP BY ALL""")
    q["alerts_consecutive"] = _alerts(ERR_FIRST, ERR_FIRST, "service", "strict", TEN_MIN, "service")
    q["alerts_consecutive_2h"] = _alerts(ERR_FIRST, ERR_FIRST, "service", "strict", TWO_H, "service")
    q["alerts_correlated"] = _alerts(CORR_FIRST, CORR_SECOND, CORR_KEY, "next", TEN_MIN, "correlation_id")
    q["alerts_correlated_any"] = _alerts(CORR_FIRST, CORR_SECOND, CORR_KEY, "any", TEN_MIN, "correlation_id")
    q["alerts_correlated_2h"] = _alerts(CORR_FIRST, CORR_SECOND, CORR_KEY, "next", TWO_H, "correlation_id")
    q["alerts_correlated_any_2h"] = _alerts(CORR_FIRST, CORR_SECOND, CORR_KEY, "any", TWO_H, "correlation_id")
    q["alerts_correlated_strict"] = _alerts(CORR_FIRST, CORR_SECOND, CORR_KEY, "strict", TEN_MIN,
                                            "correlation_id")
    level = lambda name: f"x.level = '{name}'"
    q["alerts_chain_strict"] = _chain([level("ERROR"), "STRICT " + level("ERROR"), "STRICT " + level("ERROR")], "service", TWO_H, "service")
    q["alerts_chain_next"] = _chain([level("WARNING"), level("ERROR"), level("INFO")], "hostname", TEN_MIN, "hostname")
    q["alerts_chain_mixed"] = _chain([level("ERROR"), level("WARNING"), "STRICT " + level("INFO")], None, 2 * TEN_MIN, None)
    q["alerts_escalation"] = _chain(["true", "x.p_sev::INT < f.p_sev::INT"], "hostname", TWO_H, "hostname")
    q["alerts_spreading"] = _chain([level("ERROR"), level("ERROR") + " AND x.hostname <> f.hostname"], "service", TWO_H, "service")
    q["alerts_spreading_recovered"] = _chain([level("ERROR"), level("ERROR") + " AND x.hostname <> f.hostname",
                                              level("INFO") + " AND x.hostname = f.hostname"], "service", TWO_H, "service")
    q["alert_text"] = _sql(f"""
, base AS (SELECT *, {CORR_KEY} AS k, ({CORR_FIRST}) AS is_f, ({CORR_SECOND}) AS is_s FROM acc WHERE {CORR_KEY} IS NOT NULL)
, firstnext AS (
  SELECT f.seq, f.t, arg_min(s.seq, (s.t, s.seq)) AS seq2
  FROM base f JOIN base s ON f.k = s.k AND (s.t > f.t OR (s.t = f.t AND s.seq > f.seq))
  WHERE f.is_f AND s.is_s GROUP BY f.seq, f.t)
SELECT a.seq AS first_seq, b.seq AS second_seq,
       'ErrorAlert: ' || chr(10) || {_summary('a.')} || chr(10) || {_summary('b.')} || chr(10)
       || {_json('a.')} || chr(10) || {_json('b.')} || chr(10) AS alert_text
FROM firstnext x JOIN base a ON a.seq = x.seq JOIN base b ON b.seq = x.seq2
WHERE b.t - a.t < {TEN_MIN}""")
    return q
