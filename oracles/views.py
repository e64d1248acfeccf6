"""SQL for the input views over the driver tables; the Spark twin is ``stintflow/fixtures.py``."""

FEED = [
("b", """SELECT event_id, CAST(user_id AS INT) AS game_id, event_type,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k,
  CAST((EXTRACT(DAY FROM ts) - 1) * 4 + floor(EXTRACT(HOUR FROM ts) / 6) AS INT) AS tick FROM events"""),
("live", """SELECT game_id, CAST(1 + floor(tick / 30.0) AS INT) AS period, CASE WHEN game_id % 5 = 0 THEN CAST(floor(tick / 10.0) AS INT) * 200 ELSE tick * 20 END AS secs,
  event_id AS number_event, k, game_id % 5 AS mode,
  CASE WHEN event_id % 2 = 0 THEN 'h' ELSE 'a' END AS side,
  CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
    WHEN 'error' THEN CASE WHEN k < 60 THEN 6 WHEN k < 80 THEN 5 ELSE 7 END
    ELSE CASE WHEN k < 40 THEN 8 WHEN k < 70 THEN 4 WHEN k < 82 THEN 9 WHEN k < 86 THEN 18 ELSE 10 END END AS msg_type FROM b"""),
("feed_rows", """SELECT * FROM live
  UNION ALL SELECT DISTINCT game_id, period, (period - 1) * 600, CAST(period - 100 AS BIGINT), CAST(NULL AS INT), CAST(NULL AS INT), NULL, 12 FROM live
  UNION ALL SELECT DISTINCT game_id, period, period * 600, CAST(period - 200 AS BIGINT), CAST(NULL AS INT), CAST(NULL AS INT), NULL, 13 FROM live"""),
("feed_acts", """SELECT *, CASE side WHEN 'h' THEN 'a' WHEN 'a' THEN 'h' END AS other, period * 600 - secs AS rem,
  CASE msg_type WHEN 3 THEN CASE WHEN k < 70 THEN CASE WHEN mode = 0 THEN 10 ELSE 10 + k % 7 END ELSE 18 + k % 12 END WHEN 10 THEN 1 WHEN 4 THEN k % 2
    WHEN 6 THEN CASE k % 6 WHEN 0 THEN 2 WHEN 1 THEN 6 WHEN 2 THEN 11 WHEN 3 THEN CASE WHEN mode = 0 THEN 11 ELSE 14 END WHEN 4 THEN 30 ELSE 2 END
    WHEN 7 THEN 3 ELSE 0 END AS act_type FROM feed_rows"""),
("feed", """SELECT game_id, period,
  concat(lpad(CAST(CAST(floor(rem / 60) AS INT) AS VARCHAR), 2, '0'), ':', lpad(CAST(rem % 60 AS VARCHAR), 2, '0'), '.0') AS clock,
  number_event, msg_type, act_type,
  CASE side WHEN 'h' THEN CAST(game_id % 12 + 1 AS INT) WHEN 'a' THEN CAST((game_id + 5) % 12 + 1 AS INT) END AS team_id,
  CASE CASE WHEN msg_type = 6 THEN other ELSE side END WHEN 'h' THEN CAST(game_id % 12 + 1 AS INT) WHEN 'a' THEN CAST((game_id + 5) % 12 + 1 AS INT) END AS off_team_id,
  CASE side WHEN 'h' THEN (game_id % 12 + 1) * 100 WHEN 'a' THEN ((game_id + 5) % 12 + 1) * 100 END + CASE WHEN mode = 1 THEN k % 4 + CASE WHEN period = 4 THEN 4 ELSE 0 END ELSE k % 8 END AS player1_id,
  CASE side WHEN 'h' THEN (game_id % 12 + 1) * 100 WHEN 'a' THEN ((game_id + 5) % 12 + 1) * 100 END + CASE WHEN mode = 1 THEN (k + 3) % 4 + CASE WHEN period = 4 THEN 4 ELSE 0 END ELSE (k + 3) % 8 END AS player2_id,
  CASE WHEN msg_type = 6 THEN CASE other WHEN 'h' THEN (game_id % 12 + 1) * 100 WHEN 'a' THEN ((game_id + 5) % 12 + 1) * 100 END + CASE WHEN mode = 1 THEN (k + 5) % 4 + CASE WHEN period = 4 THEN 4 ELSE 0 END ELSE (k + 5) % 8 END END AS player3_id,
  CASE msg_type WHEN 1 THEN 'Made shot' WHEN 2 THEN 'Missed shot'
    WHEN 3 THEN concat(CASE WHEN k % 4 = 0 THEN 'Missed ' ELSE '' END, 'Free Throw', CASE act_type WHEN 16 THEN ' Technical' ELSE '' END)
    WHEN 6 THEN CASE act_type WHEN 11 THEN 'Technical foul' WHEN 2 THEN 'Shooting foul (2 FT)' ELSE 'Personal foul' END
    WHEN 8 THEN 'Substitution' WHEN 12 THEN 'Start period' WHEN 13 THEN 'End period' ELSE 'Other' END AS description,
  CASE WHEN msg_type = 3 THEN 1 WHEN mode = 1 THEN CASE side WHEN 'h' THEN 3 ELSE 1 END WHEN side IS NOT NULL THEN CAST(1 + k % 3 AS INT) END AS desc_value FROM feed_acts"""),
]

_SLUG = "CASE WHEN {0} = 4 AND season_id = 2023 THEN 'MOV' ELSE concat('T', lpad(CAST({0} AS VARCHAR), 2, '0')) END"
PLAYER_LOGS = ("player_logs", f"""SELECT game_id, season_id, CAST(make_date(season_id, 1, 1) + CAST(game_id % 200 AS INT) AS DATE) AS game_date,
  {_SLUG.format('team_id')} AS team_abbreviation, team_id, side AS team_location,
  concat({_SLUG.format('team_id')}, CASE side WHEN 'home' THEN ' vs. ' ELSE ' @ ' END, {_SLUG.format('other')}) AS matchup,
  CAST(team_id * 100 + n AS INT) AS player_id, concat('p', CAST(team_id * 100 + n AS VARCHAR), CASE WHEN n = 3 AND season_id = 2024 THEN ' II' ELSE '' END) AS player_name
  FROM (SELECT game_id, CAST(2022 + game_id % 3 AS INT) AS season_id, side, n, CAST(CASE side WHEN 'home' THEN game_id % 12 ELSE (game_id + 5) % 12 END + 1 AS INT) AS team_id,
    CAST(CASE side WHEN 'home' THEN (game_id + 5) % 12 ELSE game_id % 12 END + 1 AS INT) AS other
    FROM (SELECT DISTINCT CAST(user_id AS INT) AS game_id FROM events) g, (VALUES ('home'), ('away')) AS s(side), range(8) AS n(n))""")

PERIOD_BOX = ("period_box", """SELECT r.game_id, CAST(p.period AS INT) AS period, r.player_id, r.player_name, r.team_abbreviation,
  CASE WHEN r.player_id % 8 = (r.game_id + p.period) % 8 THEN '10:00' ELSE '05:00' END AS min,
  CASE WHEN r.player_id % 2 = 0 THEN 0 ELSE 3 END AS fga FROM player_logs r, range(1, 5) AS p(period)""")

TEAM_GAME_LOG = ("team_game_log", """SELECT CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS season_id, o_orderkey AS game_id,
  CAST(o_orderdate AS DATE) AS game_date, h.loc, CASE WHEN o_orderkey % 10 = 0 THEN 'Playoffs' ELSE 'Regular' END AS season_type,
  CASE h.loc WHEN 'A' THEN concat('T', o_custkey % 12, ' @ T', (o_custkey + 5) % 12)
             ELSE concat('T', (o_custkey + 5) % 12, ' vs. T', o_custkey % 12) END AS matchup,
  CASE WHEN (h.loc = 'A') = (o_orderkey % 2 = 0) THEN 'W' ELSE 'L' END AS wl,
  CAST(CASE h.loc WHEN 'A' THEN o_custkey % 12 ELSE (o_custkey + 5) % 12 END AS INT) AS team_id,
  CAST(60 + (CASE h.loc WHEN 'A' THEN 7 ELSE 11 END * o_orderkey) % 40 AS INT) AS pts
  FROM orders, (VALUES ('A'), ('H')) AS h(loc)
  WHERE NOT (h.loc = 'H' AND o_orderkey % 17 = 0) AND NOT (h.loc = 'A' AND o_orderkey % 19 = 0)""")
