"""Domain operators: schedules, events, lineups, possessions, fouls, garbage time, statistics, season build."""
