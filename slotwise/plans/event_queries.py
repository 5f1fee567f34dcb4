"""Queries over the event stream tables: parsing, windows, joins, patterns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from slotwise.operators import joins, patterns, windows
from slotwise.plans.registry import cents, ms, query, table, us
from slotwise.sources import delimited

H = timedelta(hours=1)
MIN = timedelta(minutes=1)
DAY = timedelta(days=1)


@query(
    "parse_events",
    """
    WITH l AS (SELECT event_id, (epoch_us(ts) // 1000)::VARCHAR
                 || CASE WHEN event_type = 'error' THEN ';' ELSE ',' END
                 || user_id::VARCHAR AS line FROM events),
    p AS (SELECT *, string_split(line, ',') AS f FROM l)
    SELECT event_id, CASE WHEN len(f) >= 2 THEN 'good' ELSE 'bad' END AS side,
           CASE WHEN len(f) >= 2 THEN try_cast(f[1] AS BIGINT) END AS ms,
           CASE WHEN len(f) >= 2 THEN f[2] END AS key
    FROM p
    """,
)
def _parse_events(spark, sf):
    ev = table(spark, sf, "events")
    sep = F.when(F.col("event_type") == "error", ";").otherwise(",")
    lines = ev.select("event_id", F.concat(ms(F.col("ts")).cast("string"), sep, F.col("user_id").cast("string")).alias("value"))
    tagged = delimited.parse_events(lines, "ms_key").tagged
    ok = F.col("_ok")
    return tagged.select(
        "event_id",
        F.when(ok, "good").otherwise("bad").alias("side"),
        F.when(ok, ms(F.col("ts"))).alias("ms"),
        F.when(ok, F.col("key")).alias("key"),
    )


@query(
    "map_rows",
    """
    SELECT event_id, replace(event_type || ',' || user_id::VARCHAR, ',', '|') AS swapped,
           'event:' || event_type AS prefixed, 1 AS cnt
    FROM events
    """,
)
def _map_rows(spark, sf):
    line = F.concat_ws(",", "event_type", F.col("user_id").cast("string"))
    return table(spark, sf, "events").select(
        "event_id",
        delimited.replace_delimiter(line).alias("swapped"),
        delimited.add_prefix(F.col("event_type"), "event:").alias("prefixed"),
        F.lit(1).alias("cnt"),
    )


@query(
    "flat_map",
    """
    SELECT event_id, unnest(string_split(event_type || ',' || user_id::VARCHAR, ',')) AS item, 1 AS cnt
    FROM events
    """,
)
def _flat_map(spark, sf):
    lines = table(spark, sf, "events").select(
        "event_id", F.concat_ws(",", "event_type", F.col("user_id").cast("string")).alias("line")
    )
    return delimited.split_items(lines, "line")


@query(
    "tumbling_count",
    """
    SELECT event_type, epoch_ms(date_trunc('hour', ts)) + 3600000 AS win_end_ms, count(*) AS cnt
    FROM events GROUP BY ALL
    """,
)
def _tumbling_count(spark, sf):
    counts = windows.tumbling_count(table(spark, sf, "events"), "event_type", "ts", H)
    return counts.select("event_type", ms(F.col("win_end")).alias("win_end_ms"), "cnt")


@query(
    "tumbling_count_all",
    "SELECT epoch_ms(date_trunc('minute', ts)) + 60000 AS win_end_ms, count(*) AS cnt FROM events GROUP BY ALL",
)
def _tumbling_count_all(spark, sf):
    counts = windows.tumbling_count_all(table(spark, sf, "events"), "ts", MIN)
    return counts.select(ms(F.col("win_end")).alias("win_end_ms"), "cnt")


CUMULATIVE_SQL = """
    WITH c AS (SELECT event_type, epoch_ms(date_trunc('hour', ts)) + 3600000 AS win_end_ms, count(*) AS cnt
               FROM events GROUP BY ALL)
    SELECT event_type, win_end_ms, cnt,
           (sum(cnt) OVER (PARTITION BY event_type ORDER BY win_end_ms))::BIGINT AS total
    FROM c
"""


@query("cumulative_windows", CUMULATIVE_SQL)
def _cumulative_windows(spark, sf):
    counts = windows.tumbling_count(table(spark, sf, "events"), "event_type", "ts", H)
    out = windows.cumulative_windows(counts, "event_type")
    return out.select("event_type", ms(F.col("win_end")).alias("win_end_ms"), "cnt", "total")


SALTED_SQL = """
    SELECT event_type, epoch_ms(date_trunc('hour', ts)) + 3600000 AS win_end_ms, count(*) AS cnt
    FROM events GROUP BY ALL
"""


@query("salted_two_phase", SALTED_SQL)
def _salted(spark, sf):
    out = windows.salted_two_phase(
        table(spark, sf, "events"), "event_type", "ts", H, windows.salt_of("event_id")
    )
    return out.select("event_type", ms(F.col("win_end")).alias("win_end_ms"), "cnt")


@query("salted_two_phase_masked", SALTED_SQL)
def _salted_masked(spark, sf):
    out = windows.salted_two_phase(
        table(spark, sf, "events"), "event_type", "ts", H, windows.masked_salt("event_id")
    )
    return out.select("event_type", ms(F.col("win_end")).alias("win_end_ms"), "cnt")


@query(
    "running_reduce",
    """
    SELECT event_id, event_type,
           (sum(value::DECIMAL(18,2)) OVER (PARTITION BY event_type ORDER BY ts, event_id
            ROWS UNBOUNDED PRECEDING))::DOUBLE AS running
    FROM events
    """,
)
def _running_reduce(spark, sf):
    ev = table(spark, sf, "events")
    out = windows.running_reduce(ev, "event_type", "ts", "event_id", cents("value"))
    return out.select("event_id", "event_type", F.col("running").cast("double").alias("running"))


@query(
    "local_combine",
    """
    WITH p AS (SELECT user_id % 8 AS subtask, event_type,
                      row_number() OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS pos,
                      count(*) OVER (PARTITION BY user_id % 8) AS total FROM events)
    SELECT subtask, (pos - 1) // 16 AS flush, event_type AS key, count(*) AS combined
    FROM p WHERE ((pos - 1) // 16 + 1) * 16 <= total GROUP BY ALL
    """,
)
def _local_combine(spark, sf):
    ev = table(spark, sf, "events").select((F.col("user_id") % 8).alias("subtask"), "event_id", "event_type")
    emitted, _ = windows.local_combine(
        ev, "subtask", "event_id", F.col("event_type"), F.count(F.lit(1)), batch=16
    )
    return emitted


@query(
    "subtask_count",
    """
    SELECT event_id, user_id % 8 AS subtask,
           count(*) OVER (PARTITION BY user_id % 8 ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS running
    FROM events
    """,
)
def _subtask_count(spark, sf):
    ev = table(spark, sf, "events").select((F.col("user_id") % 8).alias("subtask"), "event_id")
    return windows.subtask_count(ev, "subtask", "event_id")


@query(
    "first_unique",
    """
    WITH c AS (SELECT value, min(event_id) AS first_at FROM events GROUP BY value HAVING count(*) = 1)
    SELECT arg_min(value, first_at) AS value FROM c
    """,
)
def _first_unique(spark, sf):
    return windows.first_unique(table(spark, sf, "events"), "value", ["event_id"])


def _clicks_and_views(spark, sf):
    ev = table(spark, sf, "events")
    return joins.two_sided(
        ev.filter("event_type = 'click'"), ev.filter("event_type = 'view'"), "user_id", "ts", "event_id", "props"
    )


STORED_LEFT_SQL = """
    WITH e AS (SELECT user_id AS k, epoch_us(ts) AS us, event_id AS id, props,
                      CASE event_type WHEN 'click' THEN 0 ELSE 1 END AS side
               FROM events WHERE event_type IN ('click', 'view')),
    g AS (SELECT *, count(*) FILTER (side = 1) OVER (PARTITION BY k ORDER BY us, side, id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS epoch FROM e),
    m AS (SELECT *, last_value(CASE WHEN side = 0 THEN id END IGNORE NULLS) OVER w AS left_id,
                    last_value(CASE WHEN side = 0 THEN us END IGNORE NULLS) OVER w AS left_us,
                    last_value(CASE WHEN side = 0 THEN props END IGNORE NULLS) OVER w AS left_value
          FROM g WINDOW w AS (PARTITION BY k, epoch ORDER BY us, side, id ROWS UNBOUNDED PRECEDING)),
    r AS (SELECT *, lead(us) OVER (PARTITION BY k ORDER BY us, id) AS next_us FROM m WHERE side = 1)
"""


@query(
    "consume_once_join",
    STORED_LEFT_SQL
    + """
    SELECT k AS key, id AS right_id, us AS right_us, left_id, left_value FROM r
    WHERE us - left_us < 21600000000 AND trim(left_value) <> ''
    """,
)
def _consume_once(spark, sf):
    return joins.consume_once_join(_clicks_and_views(spark, sf), ttl=6 * H)


@query(
    "debounced_join",
    STORED_LEFT_SQL
    + """
    SELECT k AS key, id AS right_id, us AS right_us, left_id, left_value, us + 7200000000 AS fire_us FROM r
    WHERE us - left_us < 21600000000 AND trim(left_value) <> ''
      AND (next_us IS NULL OR next_us > us + 7200000000)
    """,
)
def _debounced(spark, sf):
    return joins.debounced_join(_clicks_and_views(spark, sf), ttl=6 * H, delay=2 * H)


def _arrivals(spark, sf):
    ev = table(spark, sf, "events")
    arrival = us(F.col("ts")) + (F.col("event_id") % 7) * 60_000_000
    return ev.select("event_id", "event_type", us(F.col("ts")).alias("us"), arrival.alias("arrival"))


ARRIVALS_SQL = """
    WITH a AS (SELECT event_id, event_type, epoch_us(ts) AS us,
                      epoch_us(ts) + (event_id % 7) * 60000000 AS arrival FROM events)
"""


@query(
    "late_split",
    ARRIVALS_SQL
    + """,
    m AS (SELECT *, max(us) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM a)
    SELECT event_id, us, CASE WHEN us < seen - 120000000 THEN 'late' ELSE 'on_time' END AS side FROM m
    """,
)
def _late_split(spark, sf):
    split = patterns.late_split(_arrivals(spark, sf), "arrival", "us", "event_id", 2 * MIN)
    return split.tagged.select("event_id", "us", F.when(F.col("_late"), "late").otherwise("on_time").alias("side"))


@query(
    "idle_close_window",
    ARRIVALS_SQL
    + """,
    w AS (SELECT event_type AS key, (us // 10800000000 + 1) * 10800000000 AS win_end_us, arrival,
                 lag(arrival) OVER (PARTITION BY event_type, us // 10800000000 ORDER BY arrival, event_id) AS prev FROM a),
    f AS (SELECT *, sum(CASE WHEN prev IS NULL OR arrival - prev > 1800000000 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY key, win_end_us ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS firing FROM w)
    SELECT key, win_end_us, firing::BIGINT AS firing, count(*) AS cnt, max(arrival) + 1800000000 AS close_us
    FROM f GROUP BY key, win_end_us, firing
    """,
)
def _idle_close(spark, sf):
    return patterns.idle_close_window(_arrivals(spark, sf), "event_type", "us", "arrival", 3 * H, 30 * MIN)


def _keyed(spark, sf):
    return patterns.keyed(table(spark, sf, "events"), "user_id", "ts", "event_id", F.col("event_type"))


IS = lambda kind: F.col("event_type") == kind


@query(
    "alert_timer",
    """
    WITH RECURSIVE e AS (
        SELECT user_id AS k, epoch_us(ts) AS us, event_id AS id, event_type AS t,
               count(*) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS UNBOUNDED PRECEDING) AS ep
        FROM events WHERE event_type IN ('error', 'purchase')),
    f AS (SELECT k, ep, us FROM e WHERE t = 'error'),
    s AS (SELECT k, ep, us FROM e WHERE t = 'purchase'),
    chain AS (
        SELECT k, ep, min(us) AS us FROM f GROUP BY k, ep
        UNION ALL
        SELECT f.k, f.ep, min(f.us) AS us FROM chain c JOIN f
          ON f.k = c.k AND f.ep = c.ep AND f.us > c.us + 21600000000 GROUP BY f.k, f.ep)
    SELECT c.k AS key, c.us + 21600000000 AS alert_us
    FROM chain c LEFT JOIN s ON s.k = c.k AND s.ep = c.ep + 1
    WHERE (s.us IS NULL OR s.us > c.us + 21600000000)
      AND c.us + 21600000000 <= (SELECT max(epoch_us(ts)) FROM events)
    """,
)
def _alert_timer(spark, sf):
    return patterns.alert_timer(_keyed(spark, sf), IS("error"), IS("purchase"), 6 * H)


FOLLOWED_SQL = """
    WITH v AS (SELECT user_id, event_id, ts, epoch_us(ts) AS us,
                      CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END AS pay FROM events),
    n AS (SELECT user_id AS key, event_id AS id, us,
                 min(pay) OVER (PARTITION BY user_id ORDER BY ts, event_id
                     ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pay_us FROM v),
    c AS (SELECT n.* FROM n JOIN events e ON e.event_id = n.id WHERE e.event_type = 'view')
"""


@query(
    "pattern_followed_by",
    FOLLOWED_SQL
    + """
    SELECT key, id, us AS start_us, pay_us AS end_us, 'match' AS side FROM c WHERE pay_us - us < 43200000000
    UNION ALL
    SELECT key, id, us, us + 43200000000, 'timeout' FROM c
    WHERE (pay_us IS NULL OR pay_us - us >= 43200000000)
      AND us + 43200000000 <= (SELECT max(epoch_us(ts)) FROM events)
    """,
)
def _followed_by(spark, sf):
    found = patterns.pattern_followed_by(_keyed(spark, sf), IS("view"), IS("purchase"), 12 * H).found
    return found.select("key", F.col("ids")[0].alias("id"), "start_us", "end_us", "side")


@query(
    "pattern_strict_next",
    """
    WITH n AS (SELECT user_id AS key, event_id, event_type AS t0, epoch_us(ts) AS start_us,
                      lead(event_type, 1) OVER w AS t1, lead(event_type, 2) OVER w AS t2,
                      lead(event_id, 1) OVER w AS id1, lead(event_id, 2) OVER w AS id2,
                      lead(epoch_us(ts), 2) OVER w AS end_us
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    SELECT key, start_us, end_us, event_id AS first_id, id1 AS second_id, id2 AS third_id FROM n
    WHERE t0 = 'error' AND t1 = 'error' AND t2 = 'error' AND end_us - start_us < 86400000000
    """,
)
def _strict_next(spark, sf):
    out = patterns.pattern_strict_next(_keyed(spark, sf), IS("error"), DAY)
    ids = F.col("ids")
    return out.select("key", "start_us", "end_us", ids[0].alias("first_id"), ids[1].alias("second_id"), ids[2].alias("third_id"))


@query(
    "pattern_match",
    """
    WITH n AS (SELECT user_id AS key, event_id, event_type, epoch_us(ts) AS us,
                      row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos FROM events),
    a AS (SELECT s.key, s.us AS start_us, s.event_id AS first_id, m.event_id AS second_id, m.pos
          FROM n s JOIN n m ON m.key = s.key AND m.pos = s.pos + 1
          WHERE s.event_type = 'click' AND m.event_type = 'view'),
    b AS (SELECT a.key, a.start_us, a.first_id, a.second_id, min(p.pos) AS pos
          FROM a JOIN n p ON p.key = a.key AND p.pos > a.pos AND p.event_type = 'purchase' GROUP BY ALL)
    SELECT b.key, b.start_us, p.us AS end_us, b.first_id, b.second_id, p.event_id AS third_id
    FROM b JOIN n p ON p.key = b.key AND p.pos = b.pos
    WHERE p.us - b.start_us < 172800000000
    """,
)
def _pattern_match(spark, sf):
    steps = [patterns.Step(IS("click")), patterns.Step(IS("view")), patterns.Step(IS("purchase"), "followed_by")]
    out = patterns.pattern_match(_keyed(spark, sf), steps, 2 * DAY).matched
    ids = F.col("ids")
    return out.select("key", "start_us", "end_us", ids[0].alias("first_id"), ids[1].alias("second_id"), ids[2].alias("third_id"))


@query(
    "side_outputs",
    """
    SELECT event_id, user_id, CASE WHEN event_type = 'error' THEN 'fail' ELSE 'ok' END AS side FROM events
    """,
)
def _side_outputs(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    outputs = patterns.side_outputs(ev, {"fail": IS("error"), "ok": ~IS("error")})
    frames = [df.select("event_id", "user_id", F.lit(name).alias("side")) for name, df in outputs.items()]
    return frames[0].unionByName(frames[1])
