"""The play-by-play chain as ordered SQL steps. A statement over step N uses the steps up to N as common table expressions.

Written with plain windows, joins and correlated sets, independently of the Spark plans.
"""
from .views import FEED, PERIOD_BOX, PLAYER_LOGS

_OPP = "CASE WHEN slug_team = team_home THEN team_away WHEN slug_team <> team_home THEN team_home END"
_FREE = "(18, 19, 20, 25, 26, 27, 28, 29)"

STEPS = [*FEED, PLAYER_LOGS, PERIOD_BOX,
("teams", """SELECT game_id, max(CASE team_location WHEN 'home' THEN team_abbreviation END) AS team_home,
  max(CASE team_location WHEN 'away' THEN team_abbreviation END) AS team_away FROM player_logs GROUP BY game_id"""),
("calendar", "SELECT DISTINCT game_id, season_id, game_date FROM player_logs"),
("named", """SELECT f.game_id, f.period, f.clock, f.number_event, f.msg_type, f.act_type, t.slug AS slug_team, o.slug AS off_slug_team,
  p1.nm AS player1, p2.nm AS player2, p3.nm AS player3, f.description, f.desc_value FROM feed f LEFT JOIN calendar c ON c.game_id = f.game_id
  LEFT JOIN (SELECT DISTINCT season_id, player_id, player_name AS nm FROM player_logs) p1 ON p1.player_id = f.player1_id AND p1.season_id = c.season_id
  LEFT JOIN (SELECT DISTINCT season_id, player_id, player_name AS nm FROM player_logs) p2 ON p2.player_id = f.player2_id AND p2.season_id = c.season_id
  LEFT JOIN (SELECT DISTINCT season_id, player_id, player_name AS nm FROM player_logs) p3 ON p3.player_id = f.player3_id AND p3.season_id = c.season_id
  LEFT JOIN (SELECT DISTINCT season_id, team_id, team_abbreviation AS slug FROM player_logs) t ON t.team_id = f.team_id AND t.season_id = c.season_id
  LEFT JOIN (SELECT DISTINCT season_id, team_id, team_abbreviation AS slug FROM player_logs) o ON o.team_id = f.off_team_id AND o.season_id = c.season_id"""),
("clocked", """SELECT n.*, team_home, team_away, number_event AS number_original,
  CASE WHEN period <= 4 THEN (period - 1) * 600 ELSE 2400 + (period - 5) * 300 END + CASE WHEN period <= 4 THEN 600 ELSE 300 END
    - (CAST(split_part(clock, ':', 1) AS INT) * 60 + CAST(split_part(clock, ':', 2) AS DOUBLE)) AS secs_passed_game,
  desc_value * CASE WHEN msg_type IN (1, 2, 3) AND description NOT LIKE '%Missed%' THEN 1 ELSE 0 END AS shot_pts
  FROM named n LEFT JOIN teams USING (game_id) WHERE msg_type <> 18"""),
("ev", """SELECT game_id, period, clock, number_original, msg_type, act_type, slug_team, off_slug_team, player1, player2, player3,
  description, desc_value, team_home, team_away, secs_passed_game, shot_pts, row_number() OVER w AS number_event,
  CAST(sum(CASE WHEN slug_team = team_home THEN coalesce(shot_pts, 0) ELSE 0 END) OVER w AS BIGINT) AS hs,
  CAST(sum(CASE WHEN slug_team = team_away THEN coalesce(shot_pts, 0) ELSE 0 END) OVER w AS BIGINT) AS vs
  FROM clocked WINDOW w AS (PARTITION BY game_id ORDER BY secs_passed_game, number_original)"""),
# line-ups
("mentions", """SELECT game_id, period, slug_team, number_event, player2 AS player, 'in' AS dir, 1 AS ord FROM ev WHERE msg_type = 8
  UNION ALL SELECT game_id, period, slug_team, number_event, player1, 'out', 2 FROM ev WHERE msg_type = 8"""),
("subbed", """SELECT game_id, period, player AS player_name, dir AS in_out, CASE WHEN dir = 'out' THEN 1 ELSE 0 END AS starter
  FROM (SELECT *, row_number() OVER (PARTITION BY game_id, period, player ORDER BY number_event, ord) AS r FROM mentions) WHERE r = 1"""),
("roster", "SELECT DISTINCT game_id, player_name, player_id, team_abbreviation AS slug_team FROM player_logs"),
("named_players", """SELECT DISTINCT game_id, period, p AS player_name FROM (SELECT game_id, period, unnest([player1, player2, player3]) AS p FROM ev
  WHERE NOT (msg_type = 6 AND act_type IN (11, 12, 16, 18, 30)) AND msg_type NOT IN (9, 11)) WHERE p IS NOT NULL AND p <> '0'"""),
("starters_found", """SELECT s.*, r.player_id, r.slug_team FROM (
  SELECT game_id, period, player_name FROM named_players n WHERE NOT EXISTS (SELECT 1 FROM subbed s WHERE s.game_id = n.game_id
    AND s.period = n.period AND s.player_name = n.player_name)
  UNION ALL SELECT game_id, period, player_name FROM subbed WHERE starter = 1) s LEFT JOIN roster r USING (game_id, player_name)"""),
("missing", "SELECT game_id, period, slug_team, count(*) AS n FROM starters_found GROUP BY ALL HAVING count(*) <> 5"),
("repair", """SELECT game_id, period, player_name, player_id, team_abbreviation AS slug_team FROM period_box p
  WHERE min = CASE WHEN period > 4 THEN '5:00' ELSE '10:00' END AND fga = 0 AND EXISTS (SELECT 1 FROM missing m
    WHERE m.game_id = p.game_id AND m.period = p.period AND m.slug_team = p.team_abbreviation)"""),
("starters", """SELECT game_id, period, player_name, player_id, slug_team FROM starters_found
  UNION ALL SELECT game_id, period, player_name, player_id, slug_team FROM repair"""),
("lineup_start", """SELECT game_id, period, slug_team, string_agg(DISTINCT player_name, ', ' ORDER BY player_name) AS lineup_start,
  any_value(CASE slug_team WHEN team_home THEN 'home' WHEN team_away THEN 'away' END) AS team_location FROM starters LEFT JOIN teams USING (game_id) GROUP BY game_id, period, slug_team"""),
("start_names", "SELECT DISTINCT game_id, period, slug_team, player_name AS player FROM starters"),
("candidates", """SELECT game_id, period, slug_team, player, bool_or(st) AS is_start FROM (
  SELECT game_id, period, slug_team, player, TRUE AS st FROM start_names UNION ALL SELECT game_id, period, slug_team, player, FALSE FROM mentions)
  GROUP BY ALL"""),
("court", """SELECT e.game_id, e.period, e.slug_team, e.number_event, c.player, c.is_start,
  arg_max(m.dir, m.number_event * 2 + m.ord) AS after_dir,
  arg_max(m.dir, m.number_event * 2 + m.ord) FILTER (WHERE m.number_event < e.number_event) AS before_dir
  FROM (SELECT game_id, period, slug_team, number_event FROM ev WHERE msg_type = 8) e
  JOIN candidates c ON c.game_id = e.game_id AND c.period = e.period AND c.slug_team = e.slug_team
  LEFT JOIN mentions m ON m.game_id = e.game_id AND m.period = e.period AND m.slug_team = e.slug_team AND m.player = c.player
    AND m.number_event <= e.number_event GROUP BY ALL"""),
("changes", """SELECT c.game_id, c.period, c.slug_team, number_event,
  coalesce(string_agg(player, ', ' ORDER BY player) FILTER (WHERE before_dir = 'in' OR (before_dir IS NULL AND is_start)), '') AS lineup_before,
  coalesce(string_agg(player, ', ' ORDER BY player) FILTER (WHERE after_dir = 'in' OR (after_dir IS NULL AND is_start)), '') AS lineup_after,
  any_value(l.team_location) AS team_location FROM court c
  JOIN lineup_start l ON l.game_id = c.game_id AND l.period = c.period AND l.slug_team = c.slug_team GROUP BY ALL"""),
("marked", """SELECT e.*,
  CASE WHEN e.msg_type = 12 THEN sh.lineup_start WHEN c.team_location = 'home' THEN c.lineup_after END AS a_h,
  CASE WHEN e.msg_type = 12 THEN sa.lineup_start WHEN c.team_location = 'away' THEN c.lineup_after END AS a_a,
  CASE WHEN e.msg_type = 12 THEN sh.lineup_start WHEN c.team_location = 'home' THEN c.lineup_before END AS b_h,
  CASE WHEN e.msg_type = 12 THEN sa.lineup_start WHEN c.team_location = 'away' THEN c.lineup_before END AS b_a FROM ev e
  LEFT JOIN changes c ON c.game_id = e.game_id AND c.period = e.period AND c.number_event = e.number_event AND c.slug_team = e.slug_team
  LEFT JOIN lineup_start sh ON sh.game_id = e.game_id AND sh.period = e.period AND sh.team_location = 'home'
  LEFT JOIN lineup_start sa ON sa.game_id = e.game_id AND sa.period = e.period AND sa.team_location = 'away'"""),
("lg", """SELECT * EXCLUDE (a_h, a_a, b_h, b_a),
  coalesce(last_value(a_h IGNORE NULLS) OVER d, first_value(b_h IGNORE NULLS) OVER u) AS lineup_home,
  coalesce(last_value(a_a IGNORE NULLS) OVER d, first_value(b_a IGNORE NULLS) OVER u) AS lineup_away FROM marked
  WINDOW d AS (PARTITION BY game_id, period ORDER BY number_event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         u AS (PARTITION BY game_id, period ORDER BY number_event ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
# possessions
("p0", """SELECT *, CASE WHEN msg_type IN (1, 2, 5) OR (msg_type = 3 AND act_type IN (12, 15)) THEN 1 ELSE 0 END AS possession FROM lg"""),
("lane_secs", """SELECT game_id, secs_passed_game FROM p0 GROUP BY ALL HAVING count(*) FILTER (WHERE msg_type = 3 AND act_type = 10) > 0
  AND count(*) FILTER (WHERE msg_type = 6 AND act_type = 2) > 0 AND count(*) FILTER (WHERE msg_type = 7 AND act_type = 3) > 0
  AND count(*) FILTER (WHERE msg_type = 1) = 0"""),
("p_lane", """SELECT p.*, l.game_id IS NOT NULL AND msg_type = 3 AND act_type = 10 AS lane_violation FROM p0 p
  LEFT JOIN lane_secs l ON l.game_id = p.game_id AND l.secs_passed_game = p.secs_passed_game"""),
("chall_secs", """SELECT game_id, secs_passed_game FROM p0 GROUP BY ALL
  HAVING bool_or(msg_type = 9) AND bool_or(msg_type = 4 AND player1 IS NULL)"""),
("jump_facts", """SELECT p.*, c.game_id IS NOT NULL AS chall, lag(msg_type) OVER g AS prev_type, lag(slug_team) OVER g AS prev_slug,
  lag(c.game_id IS NOT NULL) OVER g AS prev_chall,
  last_value(CASE WHEN possession = 1 THEN off_slug_team END IGNORE NULLS) OVER d AS prev_poss,
  first_value(CASE WHEN possession = 1 THEN off_slug_team END IGNORE NULLS) OVER u AS next_poss
  FROM p_lane p LEFT JOIN chall_secs c ON c.game_id = p.game_id AND c.secs_passed_game = p.secs_passed_game
  WINDOW g AS (PARTITION BY p.game_id ORDER BY number_event),
    d AS (PARTITION BY p.game_id, period ORDER BY number_event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    u AS (PARTITION BY p.game_id, period ORDER BY number_event ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
("p_jump", """SELECT * EXCLUDE (chall, prev_type, prev_slug, prev_chall, prev_poss, next_poss),
  coalesce(msg_type = 10 AND act_type = 1 AND prev_type = 9 AND slug_team = prev_slug AND prev_poss = next_poss AND NOT prev_chall, FALSE)
    AS jumpball_turnover FROM jump_facts"""),
("p_marked", f"""SELECT * REPLACE (CASE WHEN lane_violation OR jumpball_turnover THEN 1 ELSE possession END AS possession,
  CASE WHEN jumpball_turnover THEN {_OPP} ELSE off_slug_team END AS off_slug_team,
  CASE WHEN jumpball_turnover THEN {_OPP} ELSE slug_team END AS slug_team) FROM p_jump"""),
("consec", """SELECT game_id, number_event FROM (SELECT *, lead(possession) OVER w AS np, lead(off_slug_team) OVER w AS nt FROM p_marked
  WHERE possession = 1 OR (msg_type = 6 AND act_type = 30) WINDOW w AS (PARTITION BY game_id, period ORDER BY number_event))
  WHERE possession = np AND off_slug_team = nt"""),
("p_consec", """SELECT p.*, c.game_id IS NOT NULL AS consecutive FROM p_marked p
  LEFT JOIN consec c ON c.game_id = p.game_id AND c.number_event = p.number_event"""),
("pn", """SELECT * EXCLUDE (consecutive, lane_violation, jumpball_turnover)
  REPLACE (CASE WHEN consecutive THEN 0 ELSE possession END AS possession) FROM p_consec"""),
("start_rows", """SELECT * FROM (SELECT *, lag(msg_type) OVER w AS lt, lag(act_type) OVER w AS la FROM pn
  WHERE (possession = 1 AND (msg_type IN (1, 5, 10) OR (msg_type = 3 AND shot_pts > 0))) OR (msg_type = 4 AND act_type = 0 AND desc_value = 0)
    OR (msg_type = 3 AND act_type = 10) OR (msg_type = 6 AND act_type = 6) WINDOW w AS (PARTITION BY game_id ORDER BY number_event))
  WHERE NOT (msg_type = 3 AND act_type = 10 AND coalesce(lt = 6 AND la = 6, FALSE)) AND NOT (msg_type = 6 AND act_type = 6)"""),
("start_marks", """SELECT game_id, target, arg_min(clock, number_event) AS clk FROM (
  SELECT *, CASE WHEN msg_type = 4 THEN number_event ELSE number_event + 1 END AS target,
    bool_or(msg_type = 1) OVER s AND bool_or(msg_type = 3) OVER s AS and1 FROM start_rows
  WINDOW s AS (PARTITION BY game_id, secs_passed_game, slug_team)) WHERE NOT (and1 AND msg_type IN (1, 3)) GROUP BY ALL"""),
("ps", """SELECT * EXCLUDE (s0), last_value(s0 IGNORE NULLS) OVER (PARTITION BY game_id, period ORDER BY number_event
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS start_poss FROM (
  SELECT p.*, CASE WHEN row_number() OVER (PARTITION BY p.game_id, p.period ORDER BY number_event) = 1 THEN clock ELSE m.clk END AS s0
  FROM pn p LEFT JOIN start_marks m ON m.game_id = p.game_id AND m.target = p.number_event)"""),
("last_rows", f"""SELECT game_id, period, clock AS lp_clock,
  CASE WHEN msg_type = 4 OR (msg_type = 3 AND act_type IN (19, 20, 26, 29)) THEN slug_team ELSE {_OPP} END AS lp_team FROM (
  SELECT *, row_number() OVER (PARTITION BY game_id, period ORDER BY number_event DESC) AS r FROM ps
  WHERE msg_type IN (1, 2, 3, 4, 5) AND NOT (msg_type = 3 AND act_type IN (16, 18, 19, 20, 25, 26, 27, 28, 29))
    AND NOT (msg_type = 4 AND act_type = 1)) WHERE r = 1 AND clock <> '00:00.0' AND NOT (msg_type = 4 AND desc_value = 1)"""),
("pp", """SELECT * REPLACE (CAST(number_event AS DOUBLE) AS number_event) FROM ps UNION ALL BY NAME
  SELECT p.* REPLACE (p.number_event - 0.5::DOUBLE AS number_event, 0 AS number_original, 99 AS msg_type, 0 AS act_type, 1 AS possession,
    l.lp_clock AS start_poss, 'Last possession of quarter' AS description, l.lp_team AS off_slug_team, l.lp_team AS slug_team)
  FROM ps p JOIN last_rows l ON l.game_id = p.game_id AND l.period = p.period WHERE p.msg_type = 13"""),
# free throws and fouls
("dt_facts", """SELECT game_id, number_event, secs_passed_game, msg_type, act_type, slug_team, lag(secs_passed_game) OVER w AS bs,
  lag(msg_type) OVER w AS bm, lag(act_type) OVER w AS ba, lag(slug_team) OVER w AS bt, lead(secs_passed_game) OVER w AS fs,
  lead(msg_type) OVER w AS fm, lead(act_type) OVER w AS fa, lead(slug_team) OVER w AS ft FROM pp
  WHERE msg_type NOT IN (9, 11, 99) WINDOW w AS (PARTITION BY game_id ORDER BY number_event)"""),
("dt", """SELECT game_id, number_event FROM dt_facts WHERE msg_type = 6 AND act_type = 11 AND (
  (bs = secs_passed_game AND bm = 6 AND ba = 11 AND bt <> slug_team) OR (fs = secs_passed_game AND fm = 6 AND fa = 11 AND ft <> slug_team))"""),
("dtx", """SELECT p.*, d.game_id IS NOT NULL AS double_technical, CASE WHEN d.game_id IS NOT NULL
    THEN regexp_replace(description, 'Technical', 'Double Technical') ELSE description END AS fixed_description
  FROM pp p LEFT JOIN dt d ON d.game_id = p.game_id AND d.number_event = p.number_event"""),
("tech_rows", """SELECT *, row_number() OVER (PARTITION BY game_id, secs_passed_game, msg_type ORDER BY number_event) AS seq FROM dtx
  WHERE regexp_matches(fixed_description, 'Technical|Defense 3 Second') AND NOT contains(fixed_description, 'Double Technical')"""),
("techs", """SELECT game_id, secs_passed_game, seq AS tech_number, min(number_event) FILTER (WHERE msg_type = 3) AS number_event_ft,
  min(number_event) FILTER (WHERE msg_type <> 3) AS number_event_foul FROM tech_rows GROUP BY ALL"""),
("flag_fts", f"SELECT * FROM pp WHERE msg_type = 3 AND act_type IN {_FREE}"),
("flag_fouls", f"SELECT game_id, secs_passed_game, number_event AS foul, {_OPP} AS team FROM pp WHERE msg_type = 6 AND act_type IN (9, 14, 15)"),
("flagrant", """SELECT f.game_id, f.secs_passed_game, f.number_event AS number_event_ft, f.slug_team, g.foul FROM flag_fts f
  LEFT JOIN flag_fouls g ON g.game_id = f.game_id AND g.secs_passed_game = f.secs_passed_game AND g.team IS NOT DISTINCT FROM f.slug_team"""),
("other_fouls", f"""SELECT * FROM pp WHERE msg_type IN (3, 6) AND NOT regexp_matches(description, 'Technical|Defense 3 Second')
  AND NOT (msg_type = 3 AND act_type IN {_FREE}) AND NOT (msg_type = 6 AND act_type IN (9, 14, 15))"""),
("ft_fouls", f"""SELECT game_id, secs_passed_game, number_event AS foul, player3 AS fouled, {_OPP} AS team FROM other_fouls
  WHERE msg_type = 6 AND contains(description, 'FT')"""),
("reg_exact", """SELECT f.game_id, f.secs_passed_game, f.number_event AS number_event_ft, f.slug_team, f.player1, g.foul FROM other_fouls f
  LEFT JOIN ft_fouls g ON g.game_id = f.game_id AND g.secs_passed_game = f.secs_passed_game AND g.team IS NOT DISTINCT FROM f.slug_team
    AND g.fouled IS NOT DISTINCT FROM f.player1 WHERE f.msg_type = 3"""),
("regular", """SELECT e.game_id, e.secs_passed_game, e.number_event_ft, e.slug_team, e.player1, coalesce(e.foul, g.foul) AS foul,
  CASE WHEN e.foul IS NOT NULL THEN 'player' WHEN g.foul IS NOT NULL THEN 'team' END AS matched_on FROM reg_exact e
  LEFT JOIN ft_fouls g ON e.foul IS NULL AND g.game_id = e.game_id AND g.secs_passed_game = e.secs_passed_game
    AND g.team IS NOT DISTINCT FROM e.slug_team"""),
("links", """SELECT game_id, number_event_ft, foul FROM regular UNION ALL SELECT game_id, number_event_ft, foul FROM flagrant
  UNION ALL SELECT game_id, number_event_ft, number_event_foul FROM techs WHERE number_event_ft IS NOT NULL"""),
("foul_stats", """SELECT l.game_id, l.foul AS number_event, count(*) AS total_fta,
  CAST(CASE WHEN count(*) = count(shot_pts) THEN sum(CASE WHEN slug_team = team_home THEN shot_pts ELSE 0 END) END AS BIGINT) AS shot_pts_home,
  CAST(CASE WHEN count(*) = count(shot_pts) THEN sum(CASE WHEN slug_team = team_away THEN shot_pts ELSE 0 END) END AS BIGINT) AS shot_pts_away,
  CAST(sum(CASE WHEN slug_team = team_home THEN possession ELSE 0 END) AS BIGINT) AS poss_home,
  CAST(sum(CASE WHEN slug_team = team_away THEN possession ELSE 0 END) AS BIGINT) AS poss_away
  FROM links l JOIN pp p ON p.game_id = l.game_id AND p.number_event = l.number_event_ft WHERE l.foul IS NOT NULL GROUP BY l.game_id, l.foul"""),
("pf", """SELECT p.*, coalesce(s.shot_pts_home, CASE WHEN msg_type = 1 AND slug_team = team_home THEN shot_pts ELSE 0 END) AS shot_pts_home,
  coalesce(s.shot_pts_away, CASE WHEN msg_type = 1 AND slug_team = team_away THEN shot_pts ELSE 0 END) AS shot_pts_away,
  coalesce(s.poss_home, CASE WHEN msg_type <> 3 AND possession = 1 AND slug_team = team_home THEN 1 ELSE 0 END) AS poss_home,
  coalesce(s.poss_away, CASE WHEN msg_type <> 3 AND possession = 1 AND slug_team = team_away THEN 1 ELSE 0 END) AS poss_away,
  coalesce(lead(secs_passed_game) OVER (PARTITION BY p.game_id, period ORDER BY p.number_event) - secs_passed_game, 0) AS secs_played,
  c.game_date, c.season_id AS season FROM pp p LEFT JOIN calendar c ON c.game_id = p.game_id LEFT JOIN foul_stats s ON s.game_id = p.game_id AND s.number_event = p.number_event"""),
# garbage time, roles
("openers", """SELECT game_id, max(CASE team_location WHEN 'home' THEN lineup_start END) AS oh, max(CASE team_location WHEN 'away' THEN lineup_start END) AS oa
  FROM lineup_start WHERE period = 1 GROUP BY game_id"""),
("gt0", """SELECT * EXCLUDE (oh, oa), CASE WHEN secs_passed_game >= 1800 AND period = 4 AND total_starters_home + total_starters_away <= 2
    AND margin_before >= CASE WHEN secs_passed_game < 1950 THEN 25 WHEN secs_passed_game < 2100 THEN 20 ELSE 10 END THEN 1 ELSE 0 END AS g0 FROM (
  SELECT p.*, oh, oa,
    coalesce(len(list_intersect(string_split(lineup_home, ', '), string_split(oh, ', '))), 0) AS total_starters_home,
    coalesce(len(list_intersect(string_split(lineup_away, ', '), string_split(oa, ', '))), 0) AS total_starters_away,
    abs(hs - vs - CASE WHEN shot_pts > 0 AND slug_team = team_home THEN shot_pts WHEN shot_pts > 0 AND slug_team = team_away THEN -shot_pts ELSE 0 END)
      AS margin_before FROM pf p LEFT JOIN openers USING (game_id))"""),
("gt", """SELECT * EXCLUDE (g0, mx), CASE WHEN g0 = 1 AND number_event < mx THEN 0 ELSE g0 END AS garbage_time FROM (
  SELECT *, coalesce(max(CASE WHEN g0 = 0 THEN number_event END) OVER (PARTITION BY game_id), '-inf'::DOUBLE) AS mx FROM gt0)"""),
("od", """SELECT *, CASE off_slug_team WHEN team_away THEN team_home WHEN team_home THEN team_away END AS def_slug_team,
  CASE off_slug_team WHEN team_home THEN lineup_home WHEN team_away THEN lineup_away END AS off_lineup,
  CASE off_slug_team WHEN team_away THEN lineup_home WHEN team_home THEN lineup_away END AS def_lineup FROM gt"""),
# statistics
("st0", """SELECT *, CASE WHEN slug_team = team_home THEN n END AS s_h, CASE WHEN slug_team = team_away THEN n END AS s_a FROM (
  SELECT *, CAST(1 + sum(CASE WHEN msg_type = 8 THEN 1 ELSE 0 END) OVER (PARTITION BY game_id, slug_team ORDER BY number_event
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n FROM od)"""),
("st", """SELECT * EXCLUDE (s_h, s_a, n), coalesce(first_value(s_h IGNORE NULLS) OVER u, last_value(s_h IGNORE NULLS) OVER d) AS stint_home,
  coalesce(first_value(s_a IGNORE NULLS) OVER u, last_value(s_a IGNORE NULLS) OVER d) AS stint_away FROM st0
  WINDOW d AS (PARTITION BY game_id ORDER BY number_event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         u AS (PARTITION BY game_id ORDER BY number_event ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
("persp", """SELECT game_id, game_date, period, stint_home AS stint, number_event, msg_type, 'home' AS lineup_location, lineup_home AS lineup,
    shot_pts_home AS pts_team, shot_pts_away AS pts_opp, poss_home AS poss_team, poss_away AS poss_opp, secs_played,
    team_home AS slug_team, team_away AS slug_opp, garbage_time FROM st WHERE lineup_home IS NOT NULL
  UNION ALL SELECT game_id, game_date, period, stint_away, number_event, msg_type, 'away', lineup_away, shot_pts_away, shot_pts_home, poss_away, poss_home,
    secs_played, team_away, team_home, garbage_time FROM st WHERE lineup_away IS NOT NULL"""),
("existing", """SELECT game_id, game_date, period, stint, slug_team, slug_opp, lineup, garbage_time,
  CAST(CASE WHEN count(*) = count(pts_team) THEN sum(pts_team) END AS BIGINT) AS pts_team,
  CAST(CASE WHEN count(*) = count(pts_opp) THEN sum(pts_opp) END AS BIGINT) AS pts_opp,
  CAST(sum(poss_team) AS BIGINT) AS poss_team, CAST(sum(poss_opp) AS BIGINT) AS poss_opp, sum(secs_played) AS secs_played
  FROM persp GROUP BY game_id, game_date, period, stint, slug_team, slug_opp, lineup, garbage_time"""),
("idx", """SELECT season, lineup, row_number() OVER (PARTITION BY season ORDER BY g, d, p, s, t, o, lineup) AS lineup_id FROM (
  SELECT season, lineup, (f).g AS g, (f).d AS d, (f).p AS p, (f).s AS s, (f).t AS t, (f).o AS o FROM (
    SELECT season_id AS season, lineup, min({'g': game_id, 'd': game_date, 'p': period, 's': stint, 't': slug_team, 'o': slug_opp}) AS f
    FROM existing JOIN (SELECT game_id, season_id FROM calendar) USING (game_id) GROUP BY season_id, lineup))"""),
("stats", """SELECT e.* REPLACE (row_number() OVER (PARTITION BY game_id, slug_team ORDER BY game_date, period, stint, slug_opp, lineup, garbage_time) AS stint)
  FROM existing e WHERE secs_played + poss_opp + poss_team + pts_opp + pts_team > 0"""),
("stats_ids", "SELECT s.*, i.lineup_id, i.season FROM stats s JOIN calendar c USING (game_id) LEFT JOIN idx i ON i.lineup = s.lineup AND i.season = c.season_id"),
("slots", """SELECT game_id, number_event, role, team, slot, name FROM (
  SELECT game_id, number_event, 'off' AS role, off_slug_team AS team, unnest(range(1, 6)) AS slot, unnest(list_slice(list_concat(string_split(off_lineup, ', '),
    [NULL, NULL, NULL, NULL, NULL]), 1, 5)) AS name FROM od WHERE off_lineup IS NOT NULL
  UNION ALL SELECT game_id, number_event, 'def', def_slug_team, unnest(range(1, 6)), unnest(list_slice(list_concat(string_split(def_lineup, ', '),
    [NULL, NULL, NULL, NULL, NULL]), 1, 5)) FROM od WHERE def_lineup IS NOT NULL)"""),
("slot_ids", """SELECT s.game_id, s.number_event, s.role, s.slot, max(r.player_id) AS id FROM slots s
  LEFT JOIN roster r ON r.game_id = s.game_id AND r.slug_team = s.team AND r.player_name = s.name GROUP BY ALL"""),
("wide_ids", "SELECT game_id, number_event, " + ", ".join(
  f"max(CASE WHEN role = '{r}' AND slot = {i} THEN id END) AS {r}_player{i}_id" for r in ("off", "def") for i in range(1, 6))
  + " FROM slot_ids GROUP BY game_id, number_event"),
("with_ids", """SELECT o.*, w.* EXCLUDE (game_id, number_event), io.lineup_id AS off_lineup_id, id_.lineup_id AS def_lineup_id FROM od o
  LEFT JOIN wide_ids w ON w.game_id = o.game_id AND w.number_event = o.number_event
  LEFT JOIN idx io ON io.lineup = o.off_lineup AND io.season = o.season LEFT JOIN idx id_ ON id_.lineup = o.def_lineup AND id_.season = o.season"""),
("all_slots", """SELECT game_id, number_event, role, team, unnest(string_split(names, ', ')) AS name, unnest(range(1, len(string_split(names, ', ')) + 1)) AS slot FROM (
  SELECT game_id, number_event, 'off' AS role, off_slug_team AS team, off_lineup AS names FROM od WHERE off_lineup IS NOT NULL
  UNION ALL SELECT game_id, number_event, 'def', def_slug_team, def_lineup FROM od WHERE def_lineup IS NOT NULL)"""),
("all_ids", """SELECT s.game_id, s.number_event, s.role, string_agg(coalesce(CAST(r.player_id AS VARCHAR), '?'), ',' ORDER BY s.slot) AS ids, count(*) AS n
  FROM all_slots s LEFT JOIN roster r ON r.game_id = s.game_id AND r.slug_team = s.team AND r.player_name = s.name GROUP BY ALL"""),
]


def over(step: str, statement: str) -> str:
    """``statement`` with every step up to ``step`` in scope."""
    names = [name for name, _ in STEPS]
    used = STEPS[:names.index(step) + 1]
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in used) + "\n" + statement
