"""Independent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the parquet tables as views (``events``,
``conversations``, ...); each query below derives its inputs from them with
the FIXTURES.md rules and computes the result in plain SQL, ordered ties
broken by (message_timestamp, event_id) as the Spark side does.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Shared derivations (CTE bodies)
# --------------------------------------------------------------------------
MESSAGE_EVENTS = """
me_src AS (
  SELECT e.*,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_type IN ('click', 'view') THEN 'INCOMING'
              WHEN event_type IN ('signup', 'purchase') THEN 'OUTGOING'
              ELSE 'SYSTEM' END AS dir,
         CASE WHEN user_id % 13 = 0 THEN NULL ELSE '+1' || CAST(user_id % 7 AS VARCHAR) END AS phone
  FROM events e
),
me AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'm' || CAST(event_id % 23 AS VARCHAR) AS message_id,
         'c' || CAST((user_id // 3) * 2 + k % 2 AS VARCHAR) AS chat_id,
         CAST((user_id + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END) % 3 AS VARCHAR) AS org_id,
         CASE WHEN user_id % 10 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         ts AS message_timestamp,
         ts + INTERVAL 5 MINUTE AS ingestion_timestamp,
         dir AS direction,
         CASE WHEN dir = 'OUTGOING' THEN phone
              ELSE '+9' || CAST((user_id // 3) * 2 + k % 2 AS VARCHAR) END AS sender_number,
         'chat' AS type,
         CAST(NULL AS BIGINT) AS ack,
         CAST(NULL AS VARCHAR) AS message_text,
         CAST(NULL AS VARCHAR) AS file_url,
         k % 10 = 0 AS is_broadcast,
         props AS special_data,
         k AS word_count,
         phone AS agent_phone_number
  FROM me_src
)"""

WORKING_HOURS = """
wh_users AS (SELECT DISTINCT user_id FROM events WHERE user_id % 10 <> 1),
wh AS (
  SELECT CAST(u.user_id AS VARCHAR) AS user_id,
         o.org_id,
         CAST(d.day_of_week AS INTEGER) AS day_of_week,
         CAST(CASE u.user_id % 4 WHEN 0 THEN 32400 WHEN 1 THEN 30600 WHEN 2 THEN 0 ELSE 79200 END
              AS BIGINT) * 1000000 AS start_us,
         CAST(CASE u.user_id % 4 WHEN 0 THEN 64800 WHEN 1 THEN 63000 WHEN 2 THEN 86399 ELSE 21600 END
              AS BIGINT) * 1000000 AS end_us
  FROM wh_users u
  CROSS JOIN (VALUES ('0'), ('1')) AS o(org_id)
  CROSS JOIN (SELECT range AS day_of_week FROM range(1, 8)) AS d
  WHERE d.day_of_week BETWEEN 2 AND 6 OR u.user_id % 8 = 2
)"""

# Weekday numbers (1 = Sunday .. 7 = Saturday) and the names of
# the pivot's output columns, as the result declares them.
WEEK_PIVOT = """
week AS (
  SELECT user_id, org_id,
    MAX(CASE WHEN day_of_week = 2 THEN start_us END) AS monday_start,
    MAX(CASE WHEN day_of_week = 2 THEN end_us END) AS monday_end,
    MAX(CASE WHEN day_of_week = 3 THEN start_us END) AS tuesday_start,
    MAX(CASE WHEN day_of_week = 3 THEN end_us END) AS tuesday_end,
    MAX(CASE WHEN day_of_week = 4 THEN start_us END) AS wednesday_start,
    MAX(CASE WHEN day_of_week = 4 THEN end_us END) AS wednesday_end,
    MAX(CASE WHEN day_of_week = 5 THEN start_us END) AS thursday_start,
    MAX(CASE WHEN day_of_week = 5 THEN end_us END) AS thursday_end,
    MAX(CASE WHEN day_of_week = 6 THEN start_us END) AS friday_start,
    MAX(CASE WHEN day_of_week = 6 THEN end_us END) AS friday_end,
    MAX(CASE WHEN day_of_week = 7 THEN start_us END) AS saturday_start,
    MAX(CASE WHEN day_of_week = 7 THEN end_us END) AS saturday_end,
    MAX(CASE WHEN day_of_week = 1 THEN start_us END) AS sunday_start,
    MAX(CASE WHEN day_of_week = 1 THEN end_us END) AS sunday_end
  FROM wh GROUP BY user_id, org_id
)"""


def slot_of(day_expr: str, alias: str = "w") -> tuple[str, str]:
    """SQL for the (start, end) of the weekday slot chosen by ``day_expr``
    (1 = Sunday), from the pivot alias ``alias``; missing -> 0 (closed)."""
    names = {1: "sunday", 2: "monday", 3: "tuesday", 4: "wednesday", 5: "thursday", 6: "friday", 7: "saturday"}
    start = "COALESCE(CASE " + " ".join(f"WHEN {day_expr} = {i} THEN {alias}.{n}_start" for i, n in names.items()) + " END, 0)"
    end = "COALESCE(CASE " + " ".join(f"WHEN {day_expr} = {i} THEN {alias}.{n}_end" for i, n in names.items()) + " END, 0)"
    return start, end


def working_seconds_sql(s: str, e: str, slot_start: str, slot_end: str) -> str:
    """Whole seconds when both ends are on one UTC date inside an open slot,
    else 0."""
    return (
        f"(CASE WHEN {s} < {e} AND CAST({s} AS DATE) = CAST({e} AS DATE) "
        f"AND NOT ({slot_start} = 0 AND {slot_end} = 0) "
        f"AND epoch_us({s}) % 86400000000 >= {slot_start} "
        f"AND epoch_us({e}) % 86400000000 <= {slot_end} "
        f"THEN CAST(date_sub('second', {s}, {e}) AS DOUBLE) ELSE 0.0 END)"
    )


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


# --------------------------------------------------------------------------
# Q1 conversation summary (flattened analytics)
# --------------------------------------------------------------------------
def _q1_ws() -> str:
    s, e = slot_of("(dayofweek(r.prev_ts) + 1)")
    return working_seconds_sql("r.prev_ts", "r.message_timestamp", s, e)


def q1_ctes(src: str, p: str) -> str:
    """CTEs computing the conversation summary of message rows ``src``;
    the result is CTE ``{p}out``."""
    return f"""
{p}ev AS (SELECT * FROM {src} WHERE user_id IS NOT NULL),
{p}lagged AS (
  SELECT ev.*,
         LAG(direction) OVER w AS prev_direction,
         LAG(message_timestamp) OVER w AS prev_ts
  FROM {p}ev ev
  WINDOW w AS (PARTITION BY chat_id ORDER BY message_timestamp, event_id)
),
{p}replies AS (
  SELECT r.chat_id, r.user_id, r.org_id, {_q1_ws()} AS ws
  FROM {p}lagged r LEFT JOIN week w ON r.user_id = w.user_id AND r.org_id = w.org_id
  WHERE r.direction = 'OUTGOING' AND r.prev_direction = 'INCOMING'
),
{p}by_chat AS (
  SELECT chat_id, user_id, org_id, AVG(CASE WHEN ws > 0 THEN ws END) AS avg_rt
  FROM {p}replies GROUP BY chat_id, user_id, org_id
),
{p}agg AS (
  SELECT chat_id, user_id, org_id, agent_phone_number,
         MIN(message_timestamp) AS first_ts,
         MAX(message_timestamp) AS last_ts,
         FIRST(direction ORDER BY message_timestamp, event_id) AS starter,
         FIRST(direction ORDER BY message_timestamp DESC, event_id DESC) AS last_dir,
         COUNT(*) FILTER (WHERE direction = 'INCOMING') AS received,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS sent,
         COUNT(DISTINCT message_id) AS uniq,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING' AND prev_direction = 'OUTGOING') AS follow_ups
  FROM {p}lagged
  GROUP BY chat_id, user_id, org_id, agent_phone_number
),
{p}out AS (
  SELECT a.chat_id,
         a.user_id AS uid,
         a.org_id,
         a.agent_phone_number AS phone_number,
         a.sent AS messages_sent,
         a.received AS messages_received,
         a.sent + a.received AS total_messages,
         a.uniq AS unique_messages,
         a.follow_ups AS number_of_follow_ups,
         COALESCE(b.avg_rt, 0.0) AS average_response_time,
         CASE WHEN a.starter = 'OUTGOING' THEN 'employee' ELSE 'contact' END AS conversation_starter,
         CASE WHEN a.last_dir = 'OUTGOING' THEN 'employee' ELSE 'contact' END AS last_message_from,
         a.first_ts AS created_at,
         a.last_ts AS updated_at
  FROM {p}agg a
  LEFT JOIN {p}by_chat b ON a.chat_id = b.chat_id AND a.user_id = b.user_id AND a.org_id = b.org_id
)"""


Q1 = _with(MESSAGE_EVENTS, WORKING_HOURS, WEEK_PIVOT, q1_ctes("me", "q1_")) + "\nSELECT * FROM q1_out\n"

# --------------------------------------------------------------------------
# Q2 daily performance summary (flattened analytics)
# --------------------------------------------------------------------------
def _q2_reply_ws() -> str:
    s, e = slot_of("(dayofweek(r.prev_ts) + 1)")
    return working_seconds_sql("r.prev_ts", "r.message_timestamp", s, e)


def _q2_first_ws() -> str:
    s, e = slot_of("(dayofweek(a.first_contact) + 1)")
    return working_seconds_sql("a.first_contact", "a.first_agent", s, e)


def q2_ctes(src: str, p: str) -> str:
    """CTEs computing the daily performance rows of message rows ``src``;
    the result is CTE ``{p}out``."""
    return f"""
{p}de AS (SELECT m.*, CAST(message_timestamp AS DATE) AS activity_date FROM {src} m),
{p}lagged AS (
  SELECT de.*,
         LAG(direction) OVER w AS prev_direction,
         LAG(message_timestamp) OVER w AS prev_ts
  FROM {p}de de
  WINDOW w AS (PARTITION BY user_id, chat_id ORDER BY message_timestamp, event_id)
),
{p}replies AS (
  SELECT r.activity_date, r.user_id, r.chat_id, {_q2_reply_ws()} AS ws
  FROM {p}lagged r LEFT JOIN week w ON r.user_id = w.user_id AND r.org_id = w.org_id
  WHERE r.direction = 'OUTGOING' AND r.prev_direction = 'INCOMING' AND r.prev_ts IS NOT NULL
),
{p}agg AS (
  SELECT activity_date, user_id, org_id, agent_phone_number, chat_id AS contact_id,
         FIRST(direction ORDER BY message_timestamp, event_id) AS starter,
         COUNT(*) FILTER (WHERE direction = 'INCOMING') AS received,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS sent,
         MIN(CASE WHEN direction = 'INCOMING' THEN message_timestamp END) AS first_contact,
         MIN(CASE WHEN direction = 'OUTGOING' THEN message_timestamp END) AS first_agent,
         COUNT(DISTINCT message_id) AS uniq,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING' AND prev_direction = 'OUTGOING') AS follow_ups
  FROM {p}lagged
  WHERE user_id IS NOT NULL
  GROUP BY activity_date, user_id, org_id, chat_id, agent_phone_number
),
{p}out AS (
  SELECT a.activity_date, a.user_id, a.contact_id, a.agent_phone_number, a.org_id,
         CASE WHEN a.starter = 'OUTGOING' THEN 'employee' ELSE 'contact' END AS conversation_starter_of_day,
         a.sent AS agent_message_count,
         a.received AS contact_message_count,
         a.sent AS messages_sent,
         a.received AS messages_received,
         a.sent + a.received AS total_messages,
         a.uniq AS unique_messages,
         a.follow_ups AS number_of_follow_ups,
         (SELECT AVG(CASE WHEN re.ws > 0 THEN re.ws END) FROM {p}replies re
           WHERE re.user_id = a.user_id AND re.chat_id = a.contact_id
             AND re.activity_date = a.activity_date) AS avg_agent_response_time_seconds,
         CASE WHEN a.first_agent > a.first_contact THEN
           (SELECT {_q2_first_ws()} FROM week w
             WHERE w.user_id = a.user_id AND w.org_id = a.org_id)
         END AS time_to_first_response_seconds
  FROM {p}agg a
)"""


Q2 = _with(MESSAGE_EVENTS, WORKING_HOURS, WEEK_PIVOT, q2_ctes("me", "q2_")) + "\nSELECT * FROM q2_out\n"

# --------------------------------------------------------------------------
# Relational configuration: mapping, config rows, priority resolution
# --------------------------------------------------------------------------
MAPPING = """
mu AS (SELECT DISTINCT user_id FROM events),
mapping AS (
  SELECT user_id, user_id % 5 AS team_id, user_id % 3 AS org_id, 0 AS row_order FROM mu
  UNION ALL
  SELECT user_id, user_id % 5 AS team_id, user_id % 3 + 1 AS org_id, 1 AS row_order FROM mu
  WHERE user_id % 17 = 0
),
first_map AS (
  SELECT user_id, team_id, org_id FROM mapping
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY row_order, org_id, team_id) = 1
)"""

CONFIG = """
self_users AS (SELECT DISTINCT user_id FROM mapping WHERE user_id % 6 = 0),
cfg AS (
  SELECT 'self' AS type, user_id AS type_id,
         unnest(CASE WHEN user_id % 60 = 6 THEN ['monday,tuesday', 'wednesday', 'thursday', 'friday']
                     WHEN user_id % 60 = 12 THEN ['monday', 'tuesday', 'wednesday', 'thursday', 'Friday']
                     ELSE ['monday', 'tuesday', 'wednesday', 'thursday', 'friday'] END) AS week_day,
         CASE WHEN user_id % 12 = 0 THEN '08:00:00' ELSE '10:00:00' END AS start_time,
         CASE WHEN user_id % 12 = 0 THEN '16:30:00' ELSE '19:00:00' END AS end_time,
         0 AS timezone_offset
  FROM self_users
  UNION ALL
  SELECT 'self', user_id, 'monday', '07:00:00', '12:00:00', 0 FROM self_users WHERE user_id % 60 = 24
  UNION ALL
  SELECT 'team', team_id,
         unnest(CASE WHEN team_id = 0 THEN ['monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday']
                     ELSE ['sunday', 'monday', 'tuesday', 'wednesday', 'thursday'] END),
         CASE WHEN team_id = 0 THEN '09:00:00' ELSE '22:00:00' END,
         CASE WHEN team_id = 0 THEN '17:00:00' ELSE '06:00:00' END,
         60
  FROM (SELECT DISTINCT team_id FROM mapping WHERE team_id IN (0, 1))
  UNION ALL
  SELECT 'org', org_id,
         unnest(['monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday', 'sunday']),
         '06:00:00', '20:00:00', -120
  FROM (SELECT DISTINCT org_id FROM mapping WHERE org_id = 0)
)"""


def resolve_sql(requests: str, user_col: str, team_col: str, org_col: str) -> str:
    """Priority self > team > org > default for each row of ``requests``."""
    return f"""
req_src AS (
  SELECT r.*,
         TRY_CAST(regexp_extract(CAST(r.{user_col} AS VARCHAR), '^\\s*([+-]?[0-9]+)', 1) AS BIGINT) AS self_key,
         TRY_CAST(regexp_extract(CAST(r.{team_col} AS VARCHAR), '^\\s*([+-]?[0-9]+)', 1) AS BIGINT) AS team_key,
         TRY_CAST(regexp_extract(CAST(r.{org_col} AS VARCHAR), '^\\s*([+-]?[0-9]+)', 1) AS BIGINT) AS org_key
  FROM {requests} r
),
req_src2 AS (
  SELECT r.*,
         CASE WHEN EXISTS (SELECT 1 FROM cfg c WHERE c.type = 'self' AND c.type_id = r.self_key) THEN 'self'
              WHEN EXISTS (SELECT 1 FROM cfg c WHERE c.type = 'team' AND c.type_id = r.team_key) THEN 'team'
              WHEN EXISTS (SELECT 1 FROM cfg c WHERE c.type = 'org' AND c.type_id = r.org_key) THEN 'org'
              ELSE 'default' END AS source
  FROM req_src r
),
resolved AS (
  SELECT r.* EXCLUDE (self_key, team_key, org_key), c.week_day, c.start_time, c.end_time, c.timezone_offset
  FROM req_src2 r JOIN cfg c
    ON c.type = r.source
   AND c.type_id = CASE r.source WHEN 'self' THEN r.self_key WHEN 'team' THEN r.team_key ELSE r.org_key END
  UNION ALL
  SELECT r.* EXCLUDE (self_key, team_key, org_key), d.week_day, '09:00:00', '18:00:00', 0
  FROM req_src2 r
  CROSS JOIN (VALUES ('monday'), ('tuesday'), ('wednesday'), ('thursday'), ('friday'), ('saturday'), ('sunday'))
       AS d(week_day)
  WHERE r.source = 'default'
)"""


FLAT = """
flat AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(org_id AS VARCHAR) AS org_id,
         trim(unnest(string_split(lower(week_day), ','))) AS week_day, start_time, end_time
  FROM resolved
)"""

Q5 = _with(MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), """
out AS (SELECT user_id, team_id, org_id, source, week_day, start_time, end_time, timezone_offset FROM resolved)
SELECT * FROM out
""")

Q5_FLAT = _with(MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), FLAT, """
out AS (SELECT * FROM flat)
SELECT * FROM out
""")

Q6 = _with(MESSAGE_EVENTS, MAPPING, CONFIG, """
requests AS (SELECT DISTINCT user_id, org_id FROM me WHERE user_id IS NOT NULL)""",
    resolve_sql("requests", "user_id", "user_id", "org_id"), """
out AS (
  SELECT user_id, org_id, source, week_day, start_time, end_time,
         CASE WHEN source <> 'default' THEN timezone_offset END AS timezone_offset
  FROM resolved
)
SELECT * FROM out
""")

Q13 = _with(WORKING_HOURS, WEEK_PIVOT, """
out AS (SELECT * FROM week)
SELECT * FROM out
""")


# --------------------------------------------------------------------------
# Q3 / Q4 per-user response times
# --------------------------------------------------------------------------
PAIRS = """
rmsg AS (
  SELECT user_id, org_id, chat_id, CAST(message_timestamp AS DATE) AS date, event_id,
         sender_number, direction, message_timestamp
  FROM me WHERE direction IN ('INCOMING', 'OUTGOING')
),
rlag AS (
  SELECT rmsg.*,
         LAG(direction) OVER w AS prev_direction,
         LAG(message_timestamp) OVER w AS prev_ts
  FROM rmsg
  WINDOW w AS (PARTITION BY user_id, org_id, chat_id, date ORDER BY message_timestamp, event_id)
),
pairs AS (
  SELECT user_id, org_id, chat_id, date, event_id, sender_number,
         prev_ts AS in_ts, message_timestamp AS out_ts,
         epoch_ms(prev_ts) AS in_ms, epoch_ms(message_timestamp) AS out_ms,
         epoch_ms(message_timestamp) - epoch_ms(prev_ts) AS raw_ms
  FROM rlag WHERE direction = 'OUTGOING' AND prev_direction = 'INCOMING'
)"""

RESPONSE_TAIL = """
grp AS (
  SELECT user_id, org_id, chat_id, date,
         SUM(v) AS s, COUNT(*) AS n,
         FIRST(sender_number ORDER BY out_ts, event_id) AS phone_number
  FROM valued WHERE v IS NOT NULL
  GROUP BY user_id, org_id, chat_id, date
),
grp_avg AS (SELECT *, CAST((2 * s + 1000 * n) // (2000 * n) AS BIGINT) AS avg_rt FROM grp),
out AS (
  SELECT TRY_CAST(user_id AS BIGINT) AS user_id, TRY_CAST(org_id AS BIGINT) AS org_id, phone_number, date,
         arg_max(avg_rt, chat_id) AS avg_response_time
  FROM grp_avg GROUP BY user_id, org_id, phone_number, date
)
SELECT * FROM out
"""

Q4 = _with(MESSAGE_EVENTS, PAIRS, """
valued AS (SELECT *, raw_ms AS v FROM pairs)""", RESPONSE_TAIL)

# Pairs never cross a UTC date here (the group includes the date), so of the
# message-level rules only the same-day cases can occur:
#   no configuration for (user, org)          -> raw
#   configuration but no slot that weekday    -> dropped
#   incoming >= slot start, outgoing <= end   -> raw
#   incoming before the start, outgoing in it -> 0
#   anything else                             -> dropped
SLOTS = """
cfg_present AS (SELECT DISTINCT user_id, org_id FROM flat),
slot_rows AS (
  SELECT user_id, org_id,
         list_position(['sunday', 'monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday'], week_day) - 1
           AS weekday,
         (CAST(split_part(start_time, ':', 1) AS BIGINT) * 3600
          + CAST(split_part(start_time, ':', 2) AS BIGINT) * 60) * 1000 AS start_ms,
         (CAST(split_part(end_time, ':', 1) AS BIGINT) * 3600
          + CAST(split_part(end_time, ':', 2) AS BIGINT) * 60) * 1000 AS end_ms
  FROM flat
),
slots AS (
  SELECT user_id, org_id, weekday,
         FIRST(start_ms ORDER BY start_ms, end_ms) AS start_ms,
         FIRST(end_ms ORDER BY start_ms, end_ms) AS end_ms
  FROM slot_rows WHERE weekday >= 0
  GROUP BY user_id, org_id, weekday
)"""

Q3 = _with(MESSAGE_EVENTS, MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), FLAT, SLOTS, PAIRS, """
placed AS (
  SELECT p.*, (cp.user_id IS NOT NULL) AS configured,
         epoch_ms(CAST(p.date AS TIMESTAMP)) + s.start_ms AS ws,
         epoch_ms(CAST(p.date AS TIMESTAMP)) + s.end_ms
           + CASE WHEN s.end_ms <= s.start_ms THEN 86400000 ELSE 0 END AS we,
         s.start_ms IS NOT NULL AS has_slot
  FROM pairs p
  LEFT JOIN cfg_present cp ON cp.user_id = p.user_id AND cp.org_id = p.org_id
  LEFT JOIN slots s ON s.user_id = p.user_id AND s.org_id = p.org_id AND s.weekday = dayofweek(p.in_ts)
),
valued AS (
  SELECT *,
         CASE WHEN NOT configured THEN raw_ms
              WHEN NOT has_slot THEN NULL
              WHEN in_ms >= ws AND out_ms <= we THEN raw_ms
              WHEN in_ms < ws AND out_ms >= ws AND out_ms <= we THEN 0
              ELSE NULL END AS v
  FROM placed
)""", RESPONSE_TAIL)

# --------------------------------------------------------------------------
# Upserts (Q11, Q12): previous snapshot = the rows a run before the cutoff
# produced; the merge applies the full run on top of it.
# --------------------------------------------------------------------------
CUTOFF = "TIMESTAMP '2024-01-20 00:00:00'"
RUN_TS_PREV = "TIMESTAMP '2024-01-20 00:00:00'"
RUN_TS = "TIMESTAMP '2024-01-31 00:00:00'"

ME_PREV = f"""
me_prev AS (SELECT * FROM me WHERE message_timestamp < {CUTOFF})"""


def merge_sql(target: str, source: str, keys, columns) -> str:
    """A ``merged`` CTE: MERGE of ``source`` into ``target``.  ``keys`` are
    (target key, source expr, null-safe); ``columns`` are (name, update
    expression or None to keep, insert expression)."""
    on = " AND ".join(
        (f"t.{tk} IS NOT DISTINCT FROM {sk}" if ns else f"t.{tk} = {sk}") for tk, sk, ns in keys
    )
    sel = ",\n    ".join(
        f"CASE WHEN t.t_present AND s.s_present THEN {upd or 't.' + name} "
        f"WHEN t.t_present IS NULL THEN {ins} ELSE t.{name} END AS {name}"
        for name, upd, ins in columns
    )
    return f"""
merged AS (
  SELECT
    {sel}
  FROM (SELECT *, TRUE AS t_present FROM {target}) t
  FULL OUTER JOIN (SELECT *, TRUE AS s_present FROM {source}) s ON {on}
)"""


_ANALYTICS = ["messages_sent", "messages_received", "total_messages", "unique_messages", "number_of_follow_ups"]

Q11 = _with(
    MESSAGE_EVENTS, WORKING_HOURS, WEEK_PIVOT, ME_PREV,
    q1_ctes("me_prev", "p_"), q1_ctes("me", "c_"),
    merge_sql(
        "p_out", "c_out",
        [("uid", "s.uid", True), ("org_id", "s.org_id", True), ("chat_id", "s.chat_id", True),
         ("phone_number", "s.phone_number", True)],
        [("uid", None, "s.uid"), ("org_id", "s.org_id", "s.org_id"), ("chat_id", None, "s.chat_id"),
         ("phone_number", None, "s.phone_number")]
        + [(c, f"s.{c}", f"s.{c}") for c in _ANALYTICS]
        + [(c, f"s.{c}", f"s.{c}") for c in ["average_response_time", "conversation_starter", "last_message_from",
                                             "updated_at"]]
        + [("created_at", None, "s.created_at")],
    ),
) + "\nSELECT * FROM merged\n"

Q12 = _with(
    MESSAGE_EVENTS, WORKING_HOURS, WEEK_PIVOT, ME_PREV,
    q2_ctes("me_prev", "p_"), q2_ctes("me", "c_"),
    f"""
prev_target AS (
  SELECT activity_date, user_id, agent_phone_number AS user_number, contact_id,
         TRY_CAST(org_id AS BIGINT) AS org_id, conversation_starter_of_day,
         agent_message_count, contact_message_count, avg_agent_response_time_seconds,
         time_to_first_response_seconds, {RUN_TS_PREV} AS created_at, {RUN_TS_PREV} AS updated_at,
         messages_sent, messages_received, total_messages, unique_messages, number_of_follow_ups
  FROM p_out
)""",
    merge_sql(
        "prev_target", "c_out",
        [("activity_date", "s.activity_date", True), ("user_id", "s.user_id", True),
         ("org_id", "TRY_CAST(s.org_id AS BIGINT)", True), ("contact_id", "s.contact_id", True),
         ("user_number", "s.agent_phone_number", True)],
        [("activity_date", None, "s.activity_date"), ("user_id", None, "s.user_id"),
         ("user_number", None, "s.agent_phone_number"), ("contact_id", None, "s.contact_id"),
         ("org_id", "TRY_CAST(s.org_id AS BIGINT)", "TRY_CAST(s.org_id AS BIGINT)")]
        + [(c, f"s.{c}", f"s.{c}") for c in ["conversation_starter_of_day", "agent_message_count",
                                             "contact_message_count", "avg_agent_response_time_seconds",
                                             "time_to_first_response_seconds"]]
        + [("created_at", None, RUN_TS), ("updated_at", RUN_TS, RUN_TS)]
        + [(c, f"s.{c}", f"s.{c}") for c in _ANALYTICS],
    ),
) + "\nSELECT * FROM merged\n"


# --------------------------------------------------------------------------
# Legacy per-day summaries (Q7 - Q9)
# --------------------------------------------------------------------------
def legacy_daily(window: str = "") -> str:
    where = f"WHERE {window}" if window else ""
    return f"""
ld AS (SELECT me.*, CAST(message_timestamp AS DATE) AS date FROM me {where})"""


LAST_DAY = "CAST(ingestion_timestamp AS DATE) BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'"

_Q7_SELECT = """
SELECT user_id, org_id, date, sender_number,
       COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS total_sent,
       COUNT(*) FILTER (WHERE direction = 'INCOMING') AS total_received,
       COUNT(DISTINCT message_id) AS unique_messages
FROM ld GROUP BY user_id, org_id, date, sender_number
"""

Q7 = _with(MESSAGE_EVENTS, legacy_daily()) + _Q7_SELECT
Q7_LAST_DAY = _with(MESSAGE_EVENTS, legacy_daily(LAST_DAY)) + _Q7_SELECT

Q8 = _with(MESSAGE_EVENTS, legacy_daily()) + """
SELECT user_id, org_id, date, sender_number,
       COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS messages_sent,
       COUNT(*) FILTER (WHERE direction = 'INCOMING') AS messages_received,
       COUNT(DISTINCT message_id) AS unique_messages,
       COUNT(*) AS total_messages,
       CAST(0 AS BIGINT) AS number_of_follow_ups,
       'INCOMING' AS conversation_starter,
       'OUTGOING' AS last_message_from,
       MIN(message_timestamp) AS earliest_message,
       MAX(message_timestamp) AS latest_message,
       CAST(0 AS DOUBLE) AS average_response_time
FROM ld GROUP BY user_id, org_id, date, sender_number
"""

_CLOCK_US = "((CAST(split_part({x}, ':', 1) AS BIGINT) * 3600 + CAST(split_part({x}, ':', 2) AS BIGINT) * 60" \
            " + COALESCE(TRY_CAST(split_part({x}, ':', 3) AS BIGINT), 0)) * 1000000)"

def q9_ctes(src: str, p: str, keyed: bool = True) -> str:
    """CTEs of the enhanced summary of message rows ``src`` with the slots of
    ``hours``; the result is CTE ``{p}out``."""
    own = "h.user_id = ld.user_id AND h.org_id = ld.org_id AND " if keyed else ""
    return f"""
{p}ld AS (SELECT m.*, CAST(message_timestamp AS DATE) AS date FROM {src} m),
{p}flagged AS (
  SELECT ld.*,
         direction = 'OUTGOING' AND EXISTS (
           SELECT 1 FROM hours h
           WHERE {own}h.wd = lower(dayname(ld.message_timestamp))
             AND epoch_us(ld.message_timestamp) % 86400000000 BETWEEN h.s AND h.e) AS counted
  FROM {p}ld ld
),
{p}out AS (
SELECT user_id, org_id, date, sender_number,
       COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS messages_sent,
       COUNT(*) FILTER (WHERE direction = 'INCOMING') AS messages_received,
       COUNT(DISTINCT message_id) AS unique_messages,
       COUNT(*) AS total_messages,
       COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS number_of_follow_ups,
       FIRST(direction ORDER BY message_timestamp, event_id) AS conversation_starter,
       FIRST(direction ORDER BY message_timestamp DESC, event_id DESC) AS last_message_from,
       MIN(message_timestamp) AS earliest_message,
       MAX(message_timestamp) AS latest_message,
       CASE WHEN user_id IS NOT NULL AND org_id IS NOT NULL AND sender_number IS NOT NULL
            THEN COALESCE(AVG(CASE WHEN counted THEN 300 END), 0.0) ELSE 0.0 END AS average_response_time
FROM {p}flagged GROUP BY user_id, org_id, date, sender_number
)"""


USER_HOURS = """
requests AS (SELECT DISTINCT user_id, org_id FROM me WHERE user_id IS NOT NULL)""" + "," + resolve_sql(
    "requests", "user_id", "user_id", "org_id") + """,
hours AS (
  SELECT user_id, org_id, lower(week_day) AS wd,
         """ + _CLOCK_US.format(x="start_time") + """ AS s,
         """ + _CLOCK_US.format(x="end_time") + """ AS e
  FROM resolved
)"""

# T22: one literal calendar for every message.
ONE_CALENDAR = [("monday", "08:00:00", "12:00:00"), ("monday", "13:00:00", "17:30:00"), ("wednesday", "09:00:00", "18:00:00"),
                ("friday", "22:00:00", "06:00:00")]
LITERAL_HOURS = """
hours AS (SELECT wd, """ + _CLOCK_US.format(x="a") + " AS s, " + _CLOCK_US.format(x="b") + """ AS e
  FROM (VALUES """ + ", ".join(str(r) for r in ONE_CALENDAR) + """) AS v(wd, a, b))"""

Q9 = _with(MESSAGE_EVENTS, MAPPING, CONFIG, USER_HOURS, q9_ctes("me", "e_")) + "\nSELECT * FROM e_out\n"
Q9_ONE = _with(MESSAGE_EVENTS, LITERAL_HOURS, q9_ctes("me", "e_", keyed=False)) + "\nSELECT * FROM e_out\n"

# --------------------------------------------------------------------------
# Q10 per-user report, Q14 ordered read, Q15 next working period / day
# --------------------------------------------------------------------------
Q3_VALUED = """
placed AS (
  SELECT p.*, (cp.user_id IS NOT NULL) AS configured,
         epoch_ms(CAST(p.date AS TIMESTAMP)) + s.start_ms AS ws,
         epoch_ms(CAST(p.date AS TIMESTAMP)) + s.end_ms
           + CASE WHEN s.end_ms <= s.start_ms THEN 86400000 ELSE 0 END AS we,
         s.start_ms IS NOT NULL AS has_slot
  FROM pairs p
  LEFT JOIN cfg_present cp ON cp.user_id = p.user_id AND cp.org_id = p.org_id
  LEFT JOIN slots s ON s.user_id = p.user_id AND s.org_id = p.org_id AND s.weekday = dayofweek(p.in_ts)
),
valued AS (
  SELECT *,
         CASE WHEN NOT configured THEN raw_ms
              WHEN NOT has_slot THEN NULL
              WHEN in_ms >= ws AND out_ms <= we THEN raw_ms
              WHEN in_ms < ws AND out_ms >= ws AND out_ms <= we THEN 0
              ELSE NULL END AS v
  FROM placed
)"""

# The report's records keep the id as text: '12' and '12b' are two users.
RECORDS = """
grp AS (
  SELECT user_id, org_id, chat_id, date,
         SUM(v) AS s, COUNT(*) AS n,
         FIRST(sender_number ORDER BY out_ts, event_id) AS phone_number
  FROM valued WHERE v IS NOT NULL
  GROUP BY user_id, org_id, chat_id, date
),
grp_avg AS (SELECT *, CAST((2 * s + 1000 * n) // (2000 * n) AS BIGINT) AS avg_rt FROM grp),
records AS (
  SELECT user_id, org_id, phone_number, date, arg_max(avg_rt, chat_id) AS avg_response_time
  FROM grp_avg WHERE user_id IS NOT NULL GROUP BY user_id, org_id, phone_number, date
)"""

REPORT = """
um AS (SELECT *, CAST(message_timestamp AS DATE) AS date FROM me WHERE user_id IS NOT NULL),
stats AS (
  SELECT user_id,
         COUNT(*) AS message_count,
         COUNT(*) FILTER (WHERE direction = 'INCOMING') AS incoming_messages,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS outgoing_messages,
         COUNT(DISTINCT chat_id) AS unique_chats,
         COUNT(DISTINCT sender_number) + MAX(CASE WHEN sender_number IS NULL THEN 1 ELSE 0 END)
           AS unique_phone_numbers,
         COUNT(DISTINCT (org_id, chat_id, date)) AS conversation_groups
  FROM um GROUP BY user_id
),
counters AS (
  SELECT user_id, COUNT(*) AS response_pairs,
         COUNT(*) FILTER (WHERE configured AND v IS NOT NULL) AS hours_adjusted_pairs
  FROM valued WHERE user_id IS NOT NULL GROUP BY user_id
),
summary AS (
  SELECT user_id,
         CAST((2 * SUM(avg_response_time) + COUNT(*)) // (2 * COUNT(*)) AS BIGINT) AS avg_response_time,
         MIN(avg_response_time) AS min_response_time,
         MAX(avg_response_time) AS max_response_time,
         COUNT(*) AS total_records,
         string_agg(DISTINCT phone_number, ',' ORDER BY phone_number) AS phone_numbers,
         CAST(MIN(date) AS VARCHAR) || ' to ' || CAST(MAX(date) AS VARCHAR) AS date_range
  FROM records GROUP BY user_id
)
SELECT st.user_id, st.message_count, st.incoming_messages, st.outgoing_messages, st.unique_chats,
       st.unique_phone_numbers, st.conversation_groups,
       COALESCE(c.response_pairs, 0) AS response_pairs,
       COALESCE(c.hours_adjusted_pairs, 0) AS hours_adjusted_pairs,
       COALESCE(sm.total_records, 0) AS total_records,
       COALESCE(sm.avg_response_time, 0) AS avg_response_time,
       COALESCE(sm.min_response_time, 0) AS min_response_time,
       COALESCE(sm.max_response_time, 0) AS max_response_time,
       COALESCE(sm.phone_numbers, '') AS phone_numbers,
       COALESCE(sm.date_range, 'No data') AS date_range
FROM stats st
LEFT JOIN counters c ON c.user_id = st.user_id
LEFT JOIN summary sm ON sm.user_id = st.user_id
"""


def report_ctes(messages: str = "") -> str:
    """Everything up to the report's own CTEs; ``messages`` replaces ``me``."""
    pairs = PAIRS.replace("FROM me WHERE", "FROM me_r WHERE")
    return _with(MESSAGE_EVENTS, MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), FLAT, SLOTS,
                 messages or "\nme_r AS (SELECT * FROM me)", pairs, Q3_VALUED, RECORDS) + ","


Q10 = report_ctes() + REPORT.replace("FROM me WHERE", "FROM me_r WHERE")

# Users with an odd number get a letter behind it: '12b' beside '12'.
TEXT_IDS = """
me_r AS (
  SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 2 = 1 THEN user_id || 'b' ELSE user_id END AS user_id) FROM me
)"""
Q10_TEXT = report_ctes(TEXT_IDS) + REPORT.replace("FROM me WHERE", "FROM me_r WHERE")

# One user's report, and the report of a user without messages.
ONE_USER, NOBODY = "7", "nobody"
Q10_ONE = report_ctes() + "\nall_users AS (WITH " + REPORT.replace("FROM me WHERE", "FROM me_r WHERE").strip() + f"""
),
asked AS (SELECT unnest(['{ONE_USER}', '{NOBODY}']) AS user_id)
SELECT a.user_id, COALESCE(message_count, 0) AS message_count, COALESCE(incoming_messages, 0) AS incoming_messages,
       COALESCE(outgoing_messages, 0) AS outgoing_messages, COALESCE(unique_chats, 0) AS unique_chats,
       COALESCE(unique_phone_numbers, 0) AS unique_phone_numbers,
       COALESCE(conversation_groups, 0) AS conversation_groups, COALESCE(response_pairs, 0) AS response_pairs,
       COALESCE(hours_adjusted_pairs, 0) AS hours_adjusted_pairs, COALESCE(total_records, 0) AS total_records,
       COALESCE(avg_response_time, 0) AS avg_response_time, COALESCE(min_response_time, 0) AS min_response_time,
       COALESCE(max_response_time, 0) AS max_response_time, COALESCE(phone_numbers, '') AS phone_numbers,
       COALESCE(date_range, 'No data') AS date_range
FROM asked a LEFT JOIN all_users u ON u.user_id = a.user_id
"""

# A19: what a whole run counts.
Q_COUNTERS = _with(
    MESSAGE_EVENTS, MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), FLAT, SLOTS, PAIRS,
    Q3_VALUED, """
kept AS (
  SELECT user_id, org_id, chat_id, date, FIRST(sender_number ORDER BY out_ts, event_id) AS phone_number
  FROM valued WHERE v IS NOT NULL GROUP BY user_id, org_id, chat_id, date
)
SELECT (SELECT COUNT(*) FROM valued) AS response_pairs,
       (SELECT COUNT(*) FROM valued WHERE configured AND v IS NOT NULL) AS hours_adjusted_pairs,
       (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, org_id, chat_id, date FROM valued)) AS conversation_groups,
       (SELECT COUNT(*) FROM (SELECT DISTINCT user_id, org_id, phone_number, date FROM kept)) AS total_records
""")

Q10_DIST = _with(MESSAGE_EVENTS, """
um AS (SELECT me.*, CAST(message_timestamp AS DATE) AS date FROM me WHERE user_id IS NOT NULL)""") + """
SELECT user_id, 'date' AS kind, CAST(date AS VARCHAR) AS key, COUNT(*) AS messages FROM um GROUP BY user_id, date
UNION ALL
SELECT user_id, 'direction', direction, COUNT(*) FROM um GROUP BY user_id, direction
"""

Q10_MAPS = _with(MESSAGE_EVENTS, """
um AS (SELECT *, CAST(message_timestamp AS DATE) AS date FROM me WHERE user_id IS NOT NULL),
dates AS (SELECT user_id, CAST(date AS VARCHAR) || '=' || COUNT(*) AS e FROM um GROUP BY user_id, date),
dirs AS (SELECT user_id, direction || '=' || COUNT(*) AS e FROM um GROUP BY user_id, direction)
SELECT user_id, string_agg(e, ',' ORDER BY e) AS date_distribution,
       (SELECT string_agg(x.e, ',' ORDER BY x.e) FROM dirs x WHERE x.user_id = d.user_id) AS direction_distribution
FROM dates d GROUP BY user_id
""")

LAST_TWO_DAYS = "CAST(ingestion_timestamp AS DATE) BETWEEN DATE '2024-01-28' AND DATE '2024-01-30'"
Q14_TWO_DAYS = _with(MESSAGE_EVENTS) + f"\nSELECT * FROM me WHERE {LAST_TWO_DAYS}\n"
Q14_ONE_USER = _with(MESSAGE_EVENTS) + f"\nSELECT * FROM me WHERE {LAST_TWO_DAYS} AND user_id = '{ONE_USER}'\n"

# REQUIRED columns: some rows of the fixture lose a chat or a direction.
Q_REQUIRED = _with(MESSAGE_EVENTS, """
loose AS (
  SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 97 = 0 THEN NULL ELSE chat_id END AS chat_id,
                    CASE WHEN CAST(event_id AS BIGINT) % 89 = 0 THEN NULL ELSE direction END AS direction)
  FROM me
)
SELECT event_id, CASE WHEN chat_id IS NULL THEN 'chat_id' ELSE 'direction' END AS violated,
       concat_ws(',', CASE WHEN chat_id IS NULL THEN 'chat_id' END, CASE WHEN direction IS NULL THEN 'direction' END)
         AS all_violated
FROM loose WHERE chat_id IS NULL OR direction IS NULL
""")

# D1: the SQL function over every reply pair of a chat.
Q_FUNCTION = _with(MESSAGE_EVENTS, WORKING_HOURS, WEEK_PIVOT, f"""
lagged AS (
  SELECT me.*, LAG(direction) OVER w AS prev_direction, LAG(message_timestamp) OVER w AS prev_ts
  FROM me WHERE user_id IS NOT NULL
  WINDOW w AS (PARTITION BY chat_id ORDER BY message_timestamp, event_id)
)
SELECT r.event_id, {_q1_ws()} AS working_seconds
FROM lagged r LEFT JOIN week w ON r.user_id = w.user_id AND r.org_id = w.org_id
WHERE r.direction = 'OUTGOING' AND r.prev_direction = 'INCOMING'
""")


# H5 - H7 over all reply pairs of a (user, org, chat): the full decision tree,
# by weekdays and by dates.
def tree_sql(n: str, between: str) -> str:
    inside = "(out_ms >= os AND out_ms <= oe)"
    within = "(in_ms >= ws AND in_ms <= we)"
    walk = f"GREATEST(0, CASE WHEN {n} = 0 THEN 0 ELSE {between} + (out_ms - os) END)"
    return f"""CASE
    WHEN ws IS NULL AND os IS NULL THEN NULL
    WHEN ws IS NULL AND {inside} THEN {walk}
    WHEN ws IS NULL THEN NULL
    WHEN in_ms >= ws AND out_ms <= we THEN out_ms - in_ms
    WHEN {within} AND {n} <> 0 AND os IS NOT NULL AND {inside}
      THEN GREATEST(0, (we - in_ms) + {between} + (out_ms - os))
    WHEN {within} AND {n} <> 0 THEN NULL
    WHEN os IS NOT NULL AND NOT {inside} THEN NULL
    WHEN NOT {within} AND os IS NOT NULL AND {inside} THEN {walk}
    WHEN NOT {within} THEN NULL
    WHEN out_ms > we THEN we - in_ms
    ELSE NULL END"""


def between_sql(n: str) -> str:
    """Slot lengths of the days strictly between, one by one."""
    return f"COALESCE(list_sum([lens[CAST((d_in + i) % 7 AS INTEGER) + 1] for i in range(1, {n})]), 0)"


Q_LIFETIME = _with(
    MESSAGE_EVENTS, MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), FLAT, SLOTS, """
lens AS (
  SELECT user_id, org_id, [""" + ", ".join(
        f"COALESCE(MAX(CASE WHEN weekday = {k} THEN end_ms - start_ms + CASE WHEN end_ms < start_ms THEN 86400000 ELSE 0 END END), 0)"
        for k in range(7)
    ) + """] AS lens
  FROM slots GROUP BY user_id, org_id
),
lag_all AS (
  SELECT event_id, user_id, org_id, chat_id, direction, message_timestamp AS out_ts,
         LAG(direction) OVER w AS prev_direction, LAG(message_timestamp) OVER w AS in_ts
  FROM me WHERE direction IN ('INCOMING', 'OUTGOING')
  WINDOW w AS (PARTITION BY user_id, org_id, chat_id ORDER BY message_timestamp, event_id)
),
lp AS (
  SELECT *, epoch_us(in_ts) // 1000 AS in_ms, epoch_us(out_ts) // 1000 AS out_ms,
         dayofweek(in_ts) AS d_in, dayofweek(out_ts) AS d_out,
         date_diff('day', CAST(in_ts AS DATE), CAST(out_ts AS DATE)) AS n_exact,
         (dayofweek(out_ts) - dayofweek(in_ts) + 7) % 7 AS n_week
  FROM lag_all WHERE direction = 'OUTGOING' AND prev_direction = 'INCOMING'
),
pl AS (
  SELECT p.*, (c.user_id IS NOT NULL) AS has_hours, l.lens,
         epoch_ms(CAST(CAST(in_ts AS DATE) AS TIMESTAMP)) + a.start_ms AS ws,
         epoch_ms(CAST(CAST(in_ts AS DATE) AS TIMESTAMP)) + a.end_ms
           + CASE WHEN a.end_ms <= a.start_ms THEN 86400000 ELSE 0 END AS we,
         epoch_ms(CAST(CAST(out_ts AS DATE) AS TIMESTAMP)) + b.start_ms AS os,
         epoch_ms(CAST(CAST(out_ts AS DATE) AS TIMESTAMP)) + b.end_ms
           + CASE WHEN b.end_ms <= b.start_ms THEN 86400000 ELSE 0 END AS oe
  FROM lp p
  LEFT JOIN cfg_present c ON c.user_id = p.user_id AND c.org_id = p.org_id
  LEFT JOIN lens l ON l.user_id = p.user_id AND l.org_id = p.org_id
  LEFT JOIN slots a ON a.user_id = p.user_id AND a.org_id = p.org_id AND a.weekday = p.d_in
  LEFT JOIN slots b ON b.user_id = p.user_id AND b.org_id = p.org_id AND b.weekday = p.d_out
)
SELECT event_id, user_id, org_id, chat_id, in_ts AS incoming_ts, out_ts AS outgoing_ts, out_ms - in_ms AS raw_ms,
       has_hours,
       CAST(""" + tree_sql("n_week", between_sql("n_week")) + """ AS BIGINT) AS adjusted_ms,
       CAST(""" + tree_sql("n_exact", between_sql("n_exact")) + """ AS BIGINT) AS exact_ms
FROM pl
""")

Q5_COUNT = _with(MAPPING) + "\nSELECT COUNT(*) AS count FROM first_map\n"

Q14 = _with(MESSAGE_EVENTS) + "\nSELECT * FROM me\n"

Q15 = _with(MESSAGE_EVENTS, MAPPING, CONFIG, resolve_sql("first_map", "user_id", "team_id", "org_id"), FLAT, SLOTS, """
msg AS (
  SELECT event_id, user_id, org_id, message_timestamp,
         epoch_ms(message_timestamp) AS t,
         dayofweek(message_timestamp) AS d,
         epoch_ms(CAST(CAST(message_timestamp AS DATE) AS TIMESTAMP)) AS day0
  FROM me
),
today AS (
  SELECT m.event_id, m.day0 + s.start_ms AS ps,
         m.day0 + s.end_ms + CASE WHEN s.end_ms <= s.start_ms THEN 86400000 ELSE 0 END AS pe,
         m.d AS pd
  FROM msg m JOIN slots s ON s.user_id = m.user_id AND s.org_id = m.org_id AND s.weekday = m.d
),
ahead AS (
  SELECT m.event_id, MIN(i.i) AS i
  FROM msg m
  CROSS JOIN (SELECT range AS i FROM range(1, 8)) i
  JOIN slots s ON s.user_id = m.user_id AND s.org_id = m.org_id AND s.weekday = (m.d + i.i) % 7
  GROUP BY m.event_id
),
nextday AS (
  SELECT m.event_id,
         m.day0 + a.i * 86400000 + s.start_ms AS ns,
         m.day0 + a.i * 86400000 + s.end_ms + CASE WHEN s.end_ms <= s.start_ms THEN 86400000 ELSE 0 END AS ne,
         (m.d + a.i) % 7 AS nd
  FROM msg m JOIN ahead a ON a.event_id = m.event_id
  JOIN slots s ON s.user_id = m.user_id AND s.org_id = m.org_id AND s.weekday = (m.d + a.i) % 7
),
names AS (SELECT ['sunday', 'monday', 'tuesday', 'wednesday', 'thursday', 'friday', 'saturday'] AS n)
SELECT m.event_id, m.user_id, m.org_id, m.message_timestamp,
       epoch_ms(CASE WHEN td.event_id IS NOT NULL AND m.t < td.pe THEN td.ps ELSE nx.ns END) AS period_start,
       epoch_ms(CASE WHEN td.event_id IS NOT NULL AND m.t < td.pe THEN td.pe ELSE nx.ne END) AS period_end,
       (SELECT n FROM names)[(CASE WHEN td.event_id IS NOT NULL AND m.t < td.pe THEN td.pd ELSE nx.nd END) + 1]
         AS period_day,
       epoch_ms(nx.ns) AS next_day_start,
       epoch_ms(nx.ne) AS next_day_end,
       (SELECT n FROM names)[nx.nd + 1] AS next_day
FROM msg m
LEFT JOIN today td ON td.event_id = m.event_id
LEFT JOIN nextday nx ON nx.event_id = m.event_id
""")

# --------------------------------------------------------------------------
# The conversations table as a second message source
# --------------------------------------------------------------------------
CONV_EVENTS = """
ce AS (
  SELECT CAST(conv_id * 100000 + turn AS VARCHAR) AS event_id,
         't' || CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS message_id,
         CAST(conv_id AS VARCHAR) AS chat_id,
         CAST(conv_id % 2 AS VARCHAR) AS org_id,
         CAST(conv_id % 13 AS VARCHAR) AS user_id,
         TIMESTAMP '2024-01-01 09:00:00' + to_microseconds(conv_id * 3600000000 + turn * 180000000)
           AS message_timestamp,
         CASE role WHEN 'user' THEN 'INCOMING' WHEN 'assistant' THEN 'OUTGOING' ELSE 'SYSTEM' END AS direction,
         CASE WHEN role = 'assistant' THEN '+2' || CAST(conv_id % 4 AS VARCHAR)
              ELSE '+8' || CAST(conv_id AS VARCHAR) END AS sender_number,
         '+2' || CAST(conv_id % 4 AS VARCHAR) AS agent_phone_number
  FROM conversations
)"""

Q1_TURNS = _with(WORKING_HOURS, WEEK_PIVOT, CONV_EVENTS, q1_ctes("ce", "t1_")) + "\nSELECT * FROM t1_out\n"
Q2_TURNS = _with(WORKING_HOURS, WEEK_PIVOT, CONV_EVENTS, q2_ctes("ce", "t2_")) + "\nSELECT * FROM t2_out\n"
Q4_TURNS = _with(CONV_EVENTS, PAIRS.replace("FROM me WHERE", "FROM ce WHERE"), """
valued AS (SELECT *, raw_ms AS v FROM pairs)""", RESPONSE_TAIL)

# --------------------------------------------------------------------------
# Legacy upserts (M3, M4): previous snapshot from the run before the cutoff
# --------------------------------------------------------------------------
def legacy_counts_sql(src: str) -> str:
    return f"""
  SELECT user_id, org_id, CAST(message_timestamp AS DATE) AS date, sender_number,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS total_sent,
         COUNT(*) FILTER (WHERE direction = 'INCOMING') AS total_received,
         COUNT(DISTINCT message_id) AS unique_messages
  FROM {src} GROUP BY user_id, org_id, CAST(message_timestamp AS DATE), sender_number"""


def legacy_simple_sql(src: str) -> str:
    return f"""
  SELECT user_id, org_id, CAST(message_timestamp AS DATE) AS date, sender_number,
         COUNT(*) FILTER (WHERE direction = 'OUTGOING') AS messages_sent,
         COUNT(*) FILTER (WHERE direction = 'INCOMING') AS messages_received,
         COUNT(*) AS total_messages,
         COUNT(DISTINCT message_id) AS unique_messages,
         CAST(0 AS BIGINT) AS number_of_follow_ups,
         'INCOMING' AS conversation_starter, 'OUTGOING' AS last_message_from,
         MIN(message_timestamp) AS earliest_message,
         CAST(0 AS DOUBLE) AS average_response_time
  FROM {src} GROUP BY user_id, org_id, CAST(message_timestamp AS DATE), sender_number"""


_LEGACY_KEYS = [("uid", "s.user_id", False), ("org_id", "s.org_id", False), ("date", "s.date", False),
                ("phone_number", "s.sender_number", True)]

Q_M3 = _with(MESSAGE_EVENTS, ME_PREV, f"""
prev_src AS ({legacy_counts_sql("me_prev")}),
cur AS ({legacy_counts_sql("me")}),
prev_target AS (
  SELECT user_id AS uid, org_id, date, sender_number AS phone_number,
         total_sent, total_received, unique_messages,
         {RUN_TS_PREV} AS updated_at, {RUN_TS_PREV} AS created_at
  FROM prev_src
)""", merge_sql(
    "prev_target", "cur", _LEGACY_KEYS,
    [("uid", None, "s.user_id"), ("org_id", None, "s.org_id"), ("date", None, "s.date"),
     ("phone_number", None, "s.sender_number")]
    + [(c, f"s.{c}", f"s.{c}") for c in ["total_sent", "total_received", "unique_messages"]]
    + [("updated_at", RUN_TS, RUN_TS), ("created_at", None, RUN_TS)],
)) + "\nSELECT * FROM merged\n"

Q_M4 = _with(MESSAGE_EVENTS, ME_PREV, f"""
prev_src AS ({legacy_simple_sql("me_prev")}),
cur AS ({legacy_simple_sql("me")}),
prev_target AS (
  SELECT user_id AS uid, org_id, date, sender_number AS phone_number,
         messages_sent, messages_received, total_messages, unique_messages, number_of_follow_ups,
         average_response_time, conversation_starter, last_message_from,
         {RUN_TS_PREV} AS updated_at, earliest_message AS created_at
  FROM prev_src
)""", merge_sql(
    "prev_target", "cur", _LEGACY_KEYS,
    [("uid", None, "s.user_id"), ("org_id", None, "s.org_id"), ("date", None, "s.date"),
     ("phone_number", None, "s.sender_number")]
    + [(c, f"s.{c}", f"s.{c}") for c in _ANALYTICS]
    + [(c, f"s.{c}", f"s.{c}") for c in ["average_response_time", "conversation_starter", "last_message_from"]]
    + [("updated_at", RUN_TS, RUN_TS), ("created_at", None, "s.earliest_message")],
)) + "\nSELECT * FROM merged\n"

_M4_COLUMNS = (
    [("uid", None, "s.user_id"), ("org_id", None, "s.org_id"), ("date", None, "s.date"),
     ("phone_number", None, "s.sender_number")]
    + [(c, f"s.{c}", f"s.{c}") for c in _ANALYTICS]
    + [(c, f"s.{c}", f"s.{c}") for c in ["average_response_time", "conversation_starter", "last_message_from"]]
    + [("updated_at", RUN_TS, RUN_TS), ("created_at", None, "s.earliest_message")]
)
Q_M5 = _with(MESSAGE_EVENTS, MAPPING, CONFIG, USER_HOURS, ME_PREV, q9_ctes("me_prev", "p_"), q9_ctes("me", "c_"), f"""
prev_target AS (
  SELECT user_id AS uid, org_id, date, sender_number AS phone_number,
         messages_sent, messages_received, total_messages, unique_messages, number_of_follow_ups,
         average_response_time, conversation_starter, last_message_from,
         {RUN_TS_PREV} AS updated_at, earliest_message AS created_at
  FROM p_out
)""", merge_sql("prev_target", "c_out", _LEGACY_KEYS, _M4_COLUMNS)) + "\nSELECT * FROM merged\n"

# M6: a source that holds only later messages leaves target rows alone, and
# all keys compare plainly: a row without a phone is inserted again.
Q_M6 = _with(
    MESSAGE_EVENTS, WORKING_HOURS, WEEK_PIVOT, ME_PREV,
    f"""
me_late AS (SELECT * FROM me WHERE message_timestamp >= {CUTOFF})""",
    q1_ctes("me_prev", "p_"), q1_ctes("me_late", "c_"),
    merge_sql(
        "p_out", "c_out",
        [(c, f"s.{c}", False) for c in ["uid", "org_id", "chat_id", "phone_number"]],
        [("uid", None, "s.uid"), ("org_id", "s.org_id", "s.org_id"), ("chat_id", None, "s.chat_id"),
         ("phone_number", None, "s.phone_number")]
        + [(c, f"s.{c}", f"s.{c}") for c in _ANALYTICS]
        + [(c, f"s.{c}", f"s.{c}") for c in ["average_response_time", "conversation_starter", "last_message_from",
                                             "updated_at"]]
        + [("created_at", None, "s.created_at")],
    ),
) + "\nSELECT * FROM merged\n"

ORACLES: dict[str, str] = {
    "conversation_summary": Q1,
    "daily_performance": Q2,
    "adjusted_response_times": Q3,
    "raw_response_times": Q4,
    "user_working_hours": Q5,
    "user_working_hours_flat": Q5_FLAT,
    "working_hours_for_users": Q6,
    "weekday_pivot": Q13,
    "conversation_summary_upsert": Q11,
    "daily_performance_upsert": Q12,
    "legacy_counts": Q7,
    "legacy_counts_last_day": Q7_LAST_DAY,
    "legacy_simple_summary": Q8,
    "legacy_enhanced_summary": Q9,
    "legacy_counts_upsert": Q_M3,
    "legacy_summary_upsert": Q_M4,
    "user_report": Q10,
    "message_distribution": Q10_DIST,
    "ordered_messages": Q14,
    "next_working_periods": Q15,
    "conversation_turns_summary": Q1_TURNS,
    "conversation_turns_daily": Q2_TURNS,
    "conversation_turns_response_times": Q4_TURNS,
    "working_seconds_function": Q_FUNCTION,
    "lifetime_response_pairs": Q_LIFETIME,
    "user_report_one_user": Q10_ONE,
    "user_report_text_ids": Q10_TEXT,
    "message_distribution_maps": Q10_MAPS,
    "response_run_counters": Q_COUNTERS,
    "messages_last_two_days": Q14_TWO_DAYS,
    "one_user_messages": Q14_ONE_USER,
    "configured_user_count": Q5_COUNT,
    "required_column_violations": Q_REQUIRED,
    "legacy_enhanced_one_calendar": Q9_ONE,
    "legacy_enhanced_upsert": Q_M5,
    "conversation_summary_upsert_plain_keys": Q_M6,
}
