"""SQL of the joins on time, ranks, sessions, cubes, sketches and streams."""
from .chain import over

_MOMENTS = """WITH moments AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -1 WHEN event_id % 13 <> 0 THEN user_id END AS user_key,
  CASE WHEN event_id % 11 <> 0 THEN date_trunc('minute', ts) END AS "at", event_type, value FROM events)
"""
_FEED = """feed_of AS (SELECT 2021 + game_id % 3 AS season, team_id AS team, period, msg_type, desc_value, player1_id AS player FROM feed)"""
_SESSIONS = _MOMENTS + """, marked AS (SELECT *, CASE WHEN "at" <= lag("at") OVER w + INTERVAL 3 HOUR THEN 0 ELSE 1 END AS fresh FROM moments WHERE "at" IS NOT NULL
    WINDOW w AS (PARTITION BY user_key ORDER BY "at", event_id)),
  counted AS (SELECT *, sum(fresh) OVER (PARTITION BY user_key ORDER BY "at", event_id) AS session FROM marked)
SELECT user_key, min("at") AS session_start, max("at") AS session_end, count(*) AS n_events, min(event_id) AS first_event, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total
FROM counted GROUP BY user_key, session"""

STATEMENTS = {
"asof_join": _MOMENTS + """SELECT p.event_id, p.user_key, p."at", v.event_id AS last_view_id, v.value AS last_value, v."at" AS last_at
FROM moments p LEFT JOIN moments v ON v.event_type = 'view' AND v.user_key IS NOT DISTINCT FROM p.user_key AND v."at" <= p."at" AND p."at" - v."at" <= INTERVAL 6 HOUR
WHERE p.event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY p.event_id ORDER BY v."at" DESC NULLS LAST, v.event_id DESC) = 1""",
"asof_score": over("ev", """SELECT f.game_id, f.number_event, s.number_event AS scored_at, s.hs, s.vs FROM ev f
  LEFT JOIN ev s ON s.game_id = f.game_id AND s.shot_pts > 0 AND s.secs_passed_game <= f.secs_passed_game WHERE f.msg_type = 6
  QUALIFY row_number() OVER (PARTITION BY f.game_id, f.number_event ORDER BY s.secs_passed_game DESC NULLS LAST, s.number_event DESC NULLS LAST) = 1"""),
"interval_join": _MOMENTS + """, spans AS (SELECT event_id, user_key, event_type, "at", "at" + INTERVAL 1 MINUTE * CAST(CASE WHEN event_type = 'click' THEN event_id % 20
    WHEN event_id % 29 = 0 THEN 3000 ELSE event_id % 90 END AS INT) AS until FROM moments)
SELECT c.event_id, c.user_key, e.event_id AS other_event_id FROM spans c JOIN spans e ON e.user_key IS NOT DISTINCT FROM c.user_key AND c."at" <= e.until AND e."at" <= c.until
WHERE c.event_type = 'click' AND e.event_type = 'error'""",
"global_rank": """SELECT l_orderkey, l_linenumber, quantity, l_discount, rank() OVER w AS rank, dense_rank() OVER w AS dense_rank, percent_rank() OVER w AS percent_rank
FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 17 <> 0 THEN l_quantity END AS quantity, l_discount FROM lineitem)
WINDOW w AS (ORDER BY quantity NULLS LAST, l_discount NULLS LAST)""",
"top_lineups": over("existing", """SELECT slug_team, game_id, lineup, CAST(sum(pts_team) AS BIGINT) AS pts, CAST(row_number() OVER (PARTITION BY slug_team ORDER BY sum(pts_team) DESC NULLS LAST, lineup NULLS LAST, game_id) AS INT) AS place
  FROM existing GROUP BY slug_team, game_id, lineup QUALIFY place <= 3"""),
"table_differences": """WITH lines AS (SELECT l_orderkey, CASE WHEN l_linenumber <> 2 THEN l_linenumber END AS line, l_quantity FROM lineitem),
other AS (SELECT l_orderkey, line, CASE WHEN l_orderkey % 31 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity FROM lines WHERE l_orderkey % 50 <> 0),
net AS (SELECT l_orderkey, line, l_quantity, sum(n) AS n FROM (SELECT *, 1 AS n FROM lines UNION ALL SELECT *, -1 FROM other UNION ALL SELECT *, -1 FROM other WHERE l_orderkey % 23 = 0) GROUP BY ALL)
SELECT l_orderkey, line, l_quantity, CAST(greatest(n, 0) AS BIGINT) AS only_one, CAST(greatest(-n, 0) AS BIGINT) AS only_two FROM net WHERE n <> 0""",
"stats_cube": over("feed", f"""SELECT season, team, period, grouping(season) = 1 AS is_total_season, grouping(team) = 1 AS is_total_team, grouping(period) = 1 AS is_total_period,
  count(*) AS n_events, CAST(sum(desc_value) AS BIGINT) AS total_value, count(DISTINCT player) AS n_players FROM ({_FEED.split(' AS ', 1)[1][1:-1]}) GROUP BY CUBE (season, team, period)"""),
"stats_rollup": over("feed", f"""SELECT season, team, msg_type, grouping(season) = 1 AS is_total_season, grouping(team) = 1 AS is_total_team, grouping(msg_type) = 1 AS is_total_msg_type,
  count(*) AS n_events FROM ({_FEED.split(' AS ', 1)[1][1:-1]}) GROUP BY ROLLUP (season, team, msg_type)"""),
"event_sessions": _SESSIONS,
"event_sessions_stream": _SESSIONS,
"sketch_players": """SELECT event_type AS kind, count(value) AS n_values, count(DISTINCT event_id) AS exact, true AS members_held, true AS q50_held, true AS q90_held FROM events GROUP BY event_type""",
"stream_score": """WITH landed AS (SELECT user_id AS game_id, event_id AS number_event, ts, CASE WHEN event_id % 2 = 0 THEN p ELSE 0 END AS home, CASE WHEN event_id % 2 = 1 THEN p ELSE 0 END AS away,
    least(t + CASE WHEN event_id % 97 = 0 THEN 1 ELSE 0 END, 2) AS third FROM (
    SELECT *, CASE event_type WHEN 'click' THEN 2 WHEN 'purchase' THEN 1 ELSE 0 END AS p, least(CAST(floor((EXTRACT(DAY FROM ts) - 1) / 10) AS INT), 2) AS t FROM events)),
marks AS (SELECT l.third, (SELECT to_timestamp(CAST(epoch_ms(max(e.ts)) AS DOUBLE) / 1000)::TIMESTAMP - INTERVAL 12 HOUR FROM landed e WHERE e.third < l.third) AS mark FROM (SELECT DISTINCT third FROM landed) l)
SELECT game_id, number_event, ts, CAST(sum(home) OVER w AS BIGINT) AS hs, CAST(sum(away) OVER w AS BIGINT) AS vs FROM landed JOIN marks USING (third) WHERE mark IS NULL OR ts > mark
WINDOW w AS (PARTITION BY game_id ORDER BY ts, number_event)""",
}
