"""DuckDB statement for every registered query, same column names."""
from .chain import over
from .timeline import STATEMENTS as TIMELINE
from .views import TEAM_GAME_LOG

_GAMES = f"WITH {TEAM_GAME_LOG[0]} AS ({TEAM_GAME_LOG[1]})"
_PAIRS = """SELECT a.season_id AS "SEASON_ID", a.game_id AS "GAME_ID", a.game_date AS "GAME_DATE", a.matchup AS "MATCHUP",
  a.wl AS "AWAY_WL", a.team_id AS "AWAY_TEAM_ID", a.pts AS "AWAY_PTS", h.wl AS "HOME_WL", h.team_id AS "HOME_TEAM_ID", h.pts AS "HOME_PTS"{season}
  FROM team_game_log a LEFT JOIN team_game_log h ON h.loc = 'H' AND h.game_id = a.game_id AND h.season_id = a.season_id AND h.game_date = a.game_date
    AND h.season_type = a.season_type WHERE a.loc = 'A'"""
_SEASON_PAIRS = _PAIRS.format(season=', a.season_id AS "Season"')
_PLAYER_LOG = ("game_id, season_id, game_date, team_abbreviation, team_id, matchup, player_id, player_name, team_location")
_SLOTS = [f"{role}_player{slot}" for role in ("off", "def") for slot in range(1, 6)]

_REPUBLISHED = """SELECT d.name AS dataset, CAST(o_orderkey AS INT) AS id, CAST(o_custkey AS INT) AS game_id, CAST(o_totalprice AS VARCHAR) AS status_display_clock,
  o_orderstatus, d.title AS _source, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS season, '{fmt}' AS format FROM orders JOIN datasets d ON d.n = o_orderkey % 8"""

_REGISTRY = list(zip(
    [(f"{league}_{table}", f"{title} {text} (from {source})")
     for league, title, source in (("college", "College basketball", "broadcaster"), ("pro", "Professional basketball", "broadcaster"),
                                   ("pro_stats", "Professional basketball", "league statistics"))
     for table, text in (("schedules", "schedules"), ("team_box", "team box scores"), ("player_box", "player box scores"), ("pbp", "play-by-play"))],
    ("orders", "lineitem", "customer", "events", "part", "supplier", "documents", "labels", "pages", "conversations", "embeddings", "benchmark")))

_OUTPUTS = (("play_by_play", "with_ids", "play by play", "3 * number_event + msg_type"), ("lineup_index", "idx", "lineup index", "lineup_id"),
            ("lineup_stats", "stats_ids", "lineup stats", "7 * pts_team + stint"))

STATEMENTS = {
# sources and sinks
"scan_csv": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
"scan_season_files": "SELECT o_orderkey, o_custkey, o_totalprice, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS season FROM orders",
"season_from_filename": """SELECT CAST(EXTRACT(YEAR FROM l_shipdate) AS INT) AS season, count(*) AS n_rows, sum(l_quantity) AS sum_qty
  FROM lineitem GROUP BY 1""",
"json_pluck": """SELECT o_orderkey, 'away' AS side, o_custkey % 12 AS team_id FROM orders
  UNION ALL SELECT o_orderkey, 'home', (o_custkey + 5) % 12 FROM orders UNION ALL SELECT NULL, 'broken', 61""",
"sink_json": over("player_logs", "SELECT game_id, game_date, player_id, player_name, team_location, season_id FROM player_logs"),
"sink_csv": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag FROM lineitem",
"sink_parquet": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS season
  FROM orders""",
"republish_dataset": "WITH datasets(n, name, title) AS (VALUES " + ", ".join(f"({n}, '{name}', '{title}')" for n, ((name, title), _) in enumerate(_REGISTRY[:8])) + ") "
    + " UNION ALL ".join(_REPUBLISHED.format(fmt=fmt) for fmt in ("csv", "parquet")),
"json_compact": """SELECT event_id // 500 AS doc_id, '[' || string_agg(CAST(json(props) AS VARCHAR), ',' ORDER BY event_id) || ']' AS doc, CAST(NULL AS VARCHAR) AS _corrupt
  FROM events GROUP BY 1 UNION ALL SELECT -1, NULL, '{"k": 1' || chr(10)""",
"provenance_stamp": "SELECT s_suppkey, s_name, 'Supplier rows' AS _source, '2024-06-01 00:00:00' AS _updated_at FROM supplier",
"dataset_registry": " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{title}' AS title, count(*) AS n_rows FROM {table}" for (name, title), table in _REGISTRY),
# projections, filters, predicates
"filter_events": over("ev", """SELECT game_id, number_event, msg_type, off_slug_team FROM ev
  WHERE msg_type IN (1, 2, 3, 12) AND (off_slug_team IS NULL OR off_slug_team <> 'T04')"""),
"group_filter_null": """SELECT *, count(*) OVER w AS n_lines, min(l_quantity) OVER w AS least FROM (
  SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END AS supplier, l_quantity FROM lineitem
  QUALIFY max(l_quantity) OVER (PARTITION BY CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey END) >= 30) WINDOW w AS (PARTITION BY supplier)""",
"season_rebuild": """SELECT o_orderkey, o_custkey + CASE WHEN season = 1995 THEN 1 ELSE 0 END AS o_custkey, o_orderstatus, season, format
  FROM (SELECT *, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS season FROM orders), (VALUES ('csv'), ('json'), ('parquet')) AS f(format)""",
"group_filter": """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag FROM lineitem WHERE l_orderkey IN (
  SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_returnflag = 'R') > 0 AND max(l_quantity) >= 45)""",
"select_rename": "SELECT c_custkey, c_name AS customer, c_nationkey AS nation_id FROM customer",
"select_helpers": """SELECT l_tax AS tax, l_orderkey AS order_id, l_partkey AS part_id, l_suppkey AS supplier_id, CAST(l_shipdate AS DATE) AS shipped
  FROM lineitem""",
"with_columns": """SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice, l_discount, l_tax, l_extendedprice * (1 - l_discount) AS disc_price,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem""",
"across_cast": """SELECT o_orderkey, o_orderpriority, o_orderstatus, substring(o_orderpriority, 1, 1) AS level,
  TRY_CAST(substring(o_orderpriority, 1, 1) AS INT) AS level_int, TRY_CAST(o_orderstatus AS INT) AS o_orderstatus_int FROM orders""",
"clean_names": """SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS brand_name, p_type, p_size AS loc_x, p_retailprice AS retail_price FROM part""",
"distinct_keys": "SELECT DISTINCT o_custkey AS customer_id, o_orderstatus AS status FROM orders",
# joins
"left_join": "SELECT o_custkey, o_orderkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN customer ON c_custkey = o_custkey",
"left_join_renamed": "SELECT c_nationkey, c_custkey, n_name, n_regionkey FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey",
"dim_lookup": """SELECT l_partkey, l_orderkey, l_suppkey, l_quantity, p_name AS part_name FROM lineitem
  LEFT JOIN (SELECT p_partkey, min(p_name) AS p_name FROM part GROUP BY 1) ON p_partkey = l_partkey""",
"anti_join": over("subbed", """SELECT DISTINCT game_id, period, player1 AS player_name FROM ev e WHERE player1 IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM subbed s WHERE s.game_id = e.game_id AND s.period = e.period AND s.player_name = e.player1)"""),
"fallback_join": over("regular", """SELECT game_id, CAST(number_event_ft AS BIGINT) AS number_event_ft, CAST(min(foul) AS BIGINT) AS number_event_foul
  FROM regular GROUP BY 1, 2"""),
"rows_update": """SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey END AS key, o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'N'
  WHEN o_orderstatus = 'P' THEN CASE WHEN o_totalprice > 200000 THEN 'X' END ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders""",
"semi_join_missing": over("missing", """SELECT game_id, period, team_abbreviation AS slug_team, player_id, min FROM period_box p WHERE EXISTS (
  SELECT 1 FROM missing m WHERE m.game_id = p.game_id AND m.period = p.period AND m.slug_team = p.team_abbreviation)"""),
# aggregation, distinct, reshape
"group_sum": over("ev", """SELECT game_id, period, msg_type, team_home, count(*) AS n,
  CAST(CASE WHEN count(*) = count(desc_value) THEN sum(desc_value) END AS BIGINT) AS total_value, CAST(sum(shot_pts) AS BIGINT) AS total_pts
  FROM ev GROUP BY ALL"""),
"group_size_check": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) <> 10",
"dup_keys": "SELECT l_orderkey, l_linenumber, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) > 1",
"first_per_key": """SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, day AS o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day NULLS LAST, o_orderkey) AS r FROM (
    SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)) WHERE r = 1""",
"cond_window_agg": """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_returnflag, count(*) FILTER (WHERE l_returnflag = 'R') OVER w > 0 AS any_returned,
  max(CASE WHEN l_returnflag <> 'R' THEN l_quantity END) OVER w AS max_kept FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)""",
"set_string_agg": "SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1",
"pivot_first": "SELECT o_custkey, " + ", ".join(
    f"arg_min({c}, (o_orderkey % 3 = 0, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) ELSE DATE '1900-01-01' END, o_orderkey)) FILTER (WHERE o_orderstatus = '{s}') AS {c}_{s}"
    for c in ("o_orderkey", "o_totalprice") for s in "FOP") + " FROM orders GROUP BY 1",
"unpivot_cols": " UNION ALL ".join(f"SELECT l_orderkey, l_partkey, l_suppkey, '{m}' AS measure, {e} AS amount FROM lineitem" for m, e in (
    ("quantity", "l_quantity"), ("discount", "l_discount"), ("tax", "CASE WHEN l_tax > 0.02::DOUBLE THEN l_tax END"))),
"union_by_name": """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance FROM customer
  UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
# ordered rows
"renumber_events": over("ev", "SELECT game_id, number_event, number_original, msg_type FROM ev"),
"running_score": over("ev", "SELECT game_id, number_event, shot_pts, hs, vs FROM ev"),
"lag_lead": over("ev", """SELECT game_id, number_event, lag(msg_type) OVER w AS prev_type, lead(msg_type) OVER w AS next_type,
  lead(secs_passed_game) OVER w AS next_secs FROM ev WINDOW w AS (PARTITION BY game_id ORDER BY number_event)"""),
"fill_forward": over("ev", """SELECT game_id, number_event, last_value(CASE WHEN msg_type IN (1, 3) THEN slug_team END IGNORE NULLS) OVER (
  PARTITION BY game_id, period ORDER BY number_event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_scorer FROM ev"""),
"fill_backward": over("ev", """SELECT game_id, number_event, first_value(CASE WHEN msg_type IN (1, 3) THEN slug_team END IGNORE NULLS) OVER (
  PARTITION BY game_id, period ORDER BY number_event ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_scorer FROM ev"""),
"last_per_group": over("ev", """SELECT game_id, period, number_event, msg_type, clock, known FROM (SELECT *, row_number() OVER (
  PARTITION BY game_id, period ORDER BY known DESC NULLS FIRST, number_event DESC) AS r FROM (
    SELECT *, CASE WHEN number_event % 5 <> 0 THEN number_event END AS known FROM ev WHERE msg_type IN (1, 2, 3, 4, 5))) WHERE r = 1"""),
"first_row_default": over("ev", """SELECT game_id, number_event, CASE WHEN row_number() OVER (PARTITION BY game_id, slug_team ORDER BY number_event) = 1
  THEN clock END AS first_clock FROM ev"""),
"time_to_next": over("ev", """SELECT game_id, number_event, coalesce(lead(secs_passed_game) OVER (PARTITION BY game_id, period ORDER BY number_event)
  - secs_passed_game, 0) AS secs_played FROM ev"""),
"nth_pairing": over("ev", """SELECT game_id, period, n, max(number_event) FILTER (WHERE msg_type = 1) AS number_event_made,
  max(number_event) FILTER (WHERE msg_type = 2) AS number_event_missed FROM (SELECT *, row_number() OVER (
    PARTITION BY game_id, period, msg_type ORDER BY number_event) AS n FROM ev WHERE msg_type IN (1, 2)) GROUP BY game_id, period, n"""),
"lineup_fold": over("changes", "SELECT game_id, period, number_event, slug_team, lineup_before, lineup_after FROM changes"),
# arrays and scalars
"array_set_ops": over("lineup_start", """SELECT game_id, period, slug_team, CAST(len(a) AS INT) AS n_now,
  CAST(coalesce(len(list_intersect(a, b)), 0) AS INT) AS n_stay,
  array_to_string(list_sort(list_filter(b, lambda x: NOT list_contains(a, x))), ', ') AS new_names,
  CAST(len(list_distinct(list_transform(a, lambda x: x[1]))) AS INT) AS n_letters FROM (
    SELECT s.game_id, s.period, s.slug_team, string_split(s.lineup_start, ', ') AS a, string_split(t.lineup_start, ', ') AS b
    FROM lineup_start s LEFT JOIN lineup_start t ON t.game_id = s.game_id AND t.period = s.period + 1 AND t.slug_team = s.slug_team)"""),
"regex_flags": """SELECT page_id, regexp_matches(url, '^https://') AS is_https, regexp_matches(url, '/(fr|de)/') AS is_fr_de,
  nullif(regexp_extract(url, '[0-9]+'), '') AS first_number FROM pages""",
"regex_replace_first": """SELECT p_partkey, regexp_replace(p_name, 'e', 'Double e') AS new_name, regexp_replace(p_brand, '#[0-9]+$', '') AS brand FROM part""",
"split_join": """SELECT p_partkey, array_to_string(list_sort(string_split(p_name, ' ')), ', ') AS sorted_words, concat('AWAY_', p_brand) AS tagged,
  CASE WHEN p_size > 10 THEN array_to_string(list_sort(string_split(p_name, ' ')), ', ') END AS maybe_words FROM part""",
"separate_cols": """SELECT o_orderkey, TRY_CAST(p[1] AS INT) AS level, p[2] AS word1, p[3] AS word2 FROM (
  SELECT o_orderkey, string_split_regex(o_orderpriority, '[- ]') AS p FROM orders)""",
"null_safe_ifelse": over("ev", """SELECT game_id, number_event, CASE WHEN slug_team = team_home THEN team_away WHEN slug_team <> team_home THEN team_home END AS opponent,
  CASE WHEN desc_value > 1 THEN 'big' WHEN desc_value <= 1 THEN 'small' END AS size FROM ev"""),
"case_when": """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'mid' WHEN o_orderstatus = 'F' THEN 'high closed'
  ELSE 'high' END AS band FROM orders""",
"coalesce_fill": over("ev", """SELECT game_id, number_event, coalesce(player3, player1, 'nobody') AS player, coalesce(desc_value, 0) AS desc_value FROM ev"""),
"clock_to_seconds": over("feed", """SELECT game_id, number_event, secs_left, secs_start, secs_start + CASE WHEN period <= 4 THEN 600 ELSE 300 END - secs_left AS secs_passed_game
  FROM (SELECT *, CAST(split_part(clock, ':', 1) AS INT) * 60 + CAST(split_part(clock, ':', 2) AS DOUBLE) AS secs_left,
    CASE WHEN period <= 4 THEN (period - 1) * 600 ELSE 2400 + (period - 5) * 300 END AS secs_start FROM feed)"""),
# schedules
"schedule_pairs": _GAMES.replace("THEN 'Playoffs' ELSE 'Regular'", "THEN 'All' ELSE 'All'") + _PAIRS.format(season=""),
"schedule_season": _GAMES + _SEASON_PAIRS,
"schedule_master": _GAMES + 'SELECT * EXCLUDE ("SEASON_ID", "Season"), "Season" AS season FROM (' + _SEASON_PAIRS + ") , (VALUES ('csv'), ('parquet'), ('master_csv'), ('master_parquet')) AS w(written)",
# event preparation
"player_log_prep": over("player_logs", f"SELECT {_PLAYER_LOG} FROM player_logs"),
"event_names": over("named", "SELECT game_id, number_event, slug_team, off_slug_team, player1, player2, player3 FROM named"),
"game_teams": over("teams", "SELECT game_id, team_home, team_away FROM teams"),
# line-ups
"players_subbed": over("roster", """SELECT game_id, player_name, period, in_out, starter, player_id FROM subbed
  LEFT JOIN (SELECT game_id, player_name, player_id FROM roster) USING (game_id, player_name)"""),
"period_starters": over("starters_found", "SELECT game_id, player_name, period, slug_team, player_id FROM starters_found"),
"starters_missing": over("missing", "SELECT game_id, period, slug_team, n FROM missing"),
"starters_repair": over("repair", "SELECT game_id, period, slug_team, player_name, player_id FROM repair"),
"lineup_start": over("lineup_start", "SELECT game_id, slug_team, period, lineup_start, team_location FROM lineup_start"),
"lineup_on_event": over("lg", "SELECT game_id, number_event, lineup_home, lineup_away FROM lg"),
# possessions
"possession_flag": over("p0", "SELECT game_id, number_event, msg_type, act_type, possession FROM p0"),
"lane_violations": over("p_lane", "SELECT game_id, number_event, lane_violation FROM p_lane WHERE msg_type = 3"),
"jumpball_turnovers": over("p_jump", "SELECT game_id, number_event, slug_team, jumpball_turnover FROM p_jump WHERE msg_type = 10"),
"consecutive_possessions": over("p_consec", "SELECT game_id, number_event, off_slug_team FROM p_consec WHERE consecutive"),
"possessions_corrected": over("pn", "SELECT game_id, number_event, possession, slug_team, off_slug_team FROM pn"),
"possession_start": over("ps", "SELECT game_id, number_event, clock, start_poss FROM ps"),
"last_possession": over("pp", """SELECT game_id, period, number_event, number_original, msg_type, act_type, possession, start_poss, slug_team, off_slug_team,
  description, clock FROM pp"""),
# fouls
"double_technicals": over("dtx", """SELECT game_id, CAST(number_event AS BIGINT) AS number_event, double_technical, fixed_description AS description FROM dtx
  WHERE msg_type = 6 AND act_type = 11"""),
"tech_pairing": over("techs", """SELECT game_id, secs_passed_game, tech_number, CAST(number_event_ft AS BIGINT) AS number_event_ft,
  CAST(number_event_foul AS BIGINT) AS number_event_foul FROM techs"""),
"flagrant_pairing": over("flagrant", """SELECT game_id, secs_passed_game, number_event_ft, slug_team, min(foul) AS number_event_foul, count(foul) AS n_fouls
  FROM flagrant GROUP BY 1, 2, 3, 4"""),
"regular_foul_pairing": over("regular", """SELECT game_id, secs_passed_game, number_event_ft, slug_team, player1 AS player_fouled, min(foul) AS number_event_foul,
  count(foul) AS n_fouls, any_value(matched_on) AS matched_on FROM regular GROUP BY 1, 2, 3, 4, 5"""),
"foul_stats": over("foul_stats", "SELECT game_id, number_event, total_fta, shot_pts_home, shot_pts_away, poss_home, poss_away FROM foul_stats"),
"pbp_points_poss": over("pf", """SELECT game_id, game_date, number_event, CAST(shot_pts_home AS BIGINT) AS shot_pts_home, CAST(shot_pts_away AS BIGINT) AS shot_pts_away,
  CAST(poss_home AS BIGINT) AS poss_home, CAST(poss_away AS BIGINT) AS poss_away, secs_played FROM pf"""),
# garbage time, roles, ids
"garbage_time": over("gt", """SELECT game_id, number_event, CAST(total_starters_home AS INT) AS total_starters_home, CAST(total_starters_away AS INT) AS total_starters_away,
  margin_before, garbage_time FROM gt"""),
"off_def_lineups": over("od", "SELECT game_id, number_event, def_slug_team, off_lineup, def_lineup, " + ", ".join(
    f"string_split({c[:3]}_lineup, ', ')[{c[-1]}] AS {c}" for c in _SLOTS) + " FROM od"),
"lineup_player_ids": over("all_ids", f"""SELECT w.game_id, w.number_event, {', '.join(c + '_id' for c in _SLOTS)},
  o.ids AS off_player_ids, o.n AS off_n_players, d.ids AS def_player_ids, d.n AS def_n_players FROM with_ids w
  LEFT JOIN all_ids o ON o.game_id = w.game_id AND o.number_event = w.number_event AND o.role = 'off'
  LEFT JOIN all_ids d ON d.game_id = w.game_id AND d.number_event = w.number_event AND d.role = 'def'"""),
# statistics and outputs
"stint_number": over("ev", """SELECT game_id, number_event,
    coalesce(first_value(s_h IGNORE NULLS) OVER u, last_value(s_h IGNORE NULLS) OVER d) AS stint_home,
    coalesce(first_value(s_a IGNORE NULLS) OVER u, last_value(s_a IGNORE NULLS) OVER d) AS stint_away FROM (
  SELECT *, CASE WHEN slug_team = team_home THEN n END AS s_h, CASE WHEN slug_team = team_away THEN n END AS s_a FROM (
    SELECT *, 1 + count(CASE WHEN msg_type = 8 THEN 1 END) OVER (PARTITION BY game_id, slug_team ORDER BY number_event
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n FROM ev))
  WINDOW d AS (PARTITION BY game_id ORDER BY number_event ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         u AS (PARTITION BY game_id ORDER BY number_event ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""),
"perspective": over("persp", """SELECT game_id, period, number_event, msg_type, secs_played, garbage_time, lineup_location, lineup,
  CAST(pts_team AS BIGINT) AS pts_team, CAST(pts_opp AS BIGINT) AS pts_opp, CAST(poss_team AS BIGINT) AS poss_team, CAST(poss_opp AS BIGINT) AS poss_opp,
  slug_team, slug_opp, stint FROM persp"""),
"lineup_stats_existing": over("existing", "SELECT e.*, c.season_id AS season FROM existing e JOIN calendar c USING (game_id)"),
"lineup_stats": over("stats_ids", "SELECT * FROM stats_ids"),
"lineup_stats_cut": over("stats_ids", "SELECT * FROM stats_ids"),
"lineup_index": over("idx", "SELECT season, lineup, lineup_id FROM idx"),
"attach_lineup_ids": over("with_ids", "SELECT game_id, number_event, off_lineup, def_lineup, off_lineup_id, def_lineup_id, season FROM with_ids"),
"season_outputs": over("with_ids", " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, '{fmt}' AS format, CAST(season AS INT) AS season, 'Play-by-play {text}' AS _source, count(*) AS n_rows, CAST(sum({value}) AS BIGINT) AS total, CAST(0 AS BIGINT) AS n_differing FROM {step} GROUP BY season"
    for name, step, text, value in _OUTPUTS for fmt in ("csv", "parquet"))),
}
STATEMENTS |= TIMELINE
