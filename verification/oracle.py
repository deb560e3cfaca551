"""DuckDB SQL with the same results as the registered queries, written independently of the Spark code."""

from __future__ import annotations

from verification.fixtures import duckdb_raw_views


def _clean(column: str) -> str:
    return f"nullif(trim(replace({column}, chr(160), ' ')), '')"


def _decimal(column: str) -> str:
    return rf"TRY_CAST(regexp_replace(replace(trim({column}), ',', '.'), '[^0-9.\-]', '', 'g') AS DOUBLE)"


def _whole(column: str) -> str:
    return f"CAST(trunc({_decimal(column)}) AS INT)"


def _side(team: str = "e.team") -> str:
    return f"CASE WHEN {team} = s.home_team THEN TRUE WHEN {team} = s.away_team THEN FALSE END"


def _bucket(minute: str) -> str:
    return (
        f"CASE WHEN {minute} IS NULL THEN NULL WHEN {minute} <= 15 THEN '00_15' WHEN {minute} <= 30 THEN '16_30' "
        f"WHEN {minute} <= 45 THEN '31_45' WHEN {minute} <= 60 THEN '46_60' WHEN {minute} <= 75 THEN '61_75' "
        f"WHEN {minute} <= 90 THEN '76_90' ELSE '90_plus' END"
    )


_MINUTES = r"""
  trim(minuto) AS minute_raw,
  TRY_CAST(regexp_extract(trim(minuto), '^(\d+)', 1) AS INT) AS minute_base,
  CASE WHEN minuto IS NULL THEN NULL
       ELSE coalesce(TRY_CAST(regexp_extract(trim(minuto), '^\d+\+(\d+)$', 1) AS INT), 0) END AS stoppage_minute
"""

_LINEAGE = "CAST(_load_date AS DATE) AS ingestion_date, _source_file AS source_file"

_POINTS = "CASE {0} WHEN 'win' THEN 3 WHEN 'draw' THEN 1 WHEN 'loss' THEN 0 END"

LATEST = "_load_date = (SELECT max(_load_date) FROM matches_raw)"

VIEWS = {
    **duckdb_raw_views(),
    "typed_matches": f"""
SELECT TRY_CAST(ID AS BIGINT) AS match_id, TRY_CAST(rodada AS INT) AS round, {_clean('data')} AS d,
  {_clean('hora')} AS match_time, {_clean('mandante')} AS home_team, {_clean('visitante')} AS away_team,
  {_clean('formacao_mandante')} AS home_formation, {_clean('formacao_visitante')} AS away_formation,
  {_clean('tecnico_mandante')} AS home_coach, {_clean('tecnico_visitante')} AS away_coach,
  {_clean('vencedor')} AS winner, {_clean('arena')} AS stadium,
  TRY_CAST(mandante_Placar AS INT) AS home_score, TRY_CAST(visitante_Placar AS INT) AS away_score,
  {_clean('mandante_Estado')} AS home_state, {_clean('visitante_Estado')} AS away_state,
  TRY_CAST(arrecadacao AS DOUBLE) AS gross_revenue, {_LINEAGE}
FROM matches_raw WHERE {LATEST}""",
    "dated_matches": """
SELECT *, CAST(coalesce(try_strptime(d, '%d/%m/%Y'), try_strptime(d, '%Y-%m-%d')) AS DATE) AS match_date,
  CASE WHEN d IS NOT NULL AND match_time IS NOT NULL THEN try_strptime(d || ' ' || match_time,
    ['%d/%m/%Y %H:%M', '%Y-%m-%d %H:%M', '%d/%m/%Y %H:%M:%S', '%Y-%m-%d %H:%M:%S']) END AS match_datetime
FROM typed_matches""",
    "silver_matches": """
SELECT * EXCLUDE (d), CAST(year(match_date) AS INT) AS season, home_score + away_score AS total_goals,
  home_score = away_score AS is_draw,
  CASE WHEN home_score > away_score THEN 'win' WHEN home_score < away_score THEN 'loss' ELSE 'draw' END AS home_result,
  CASE WHEN away_score > home_score THEN 'win' WHEN away_score < home_score THEN 'loss' ELSE 'draw' END AS away_result,
  nullif(winner, '-') AS winner_normalized
FROM dated_matches""",
    "typed_goals": f"""
SELECT TRY_CAST(partida_id AS BIGINT) AS match_id, TRY_CAST(rodada AS INT) AS round, {_clean('clube')} AS team,
  {_clean('atleta')} AS player, {_MINUTES}, {_clean('tipo_de_gol')} AS goal_type, {_LINEAGE}
FROM goals_raw""",
    "numbered_goals": """
SELECT *, row_number() OVER (PARTITION BY match_id, team, player, minute, goal_type
    ORDER BY source_file, md5(concat_ws('|', CAST(ingestion_date AS VARCHAR), coalesce(CAST(minute_base AS VARCHAR), ''),
      coalesce(minute_raw, ''), coalesce(CAST(round AS VARCHAR), ''),
      coalesce(CAST(stoppage_minute AS VARCHAR), '')))) AS n
FROM (SELECT *, minute_base + stoppage_minute AS minute FROM typed_goals)""",
    "silver_goals": f"""
SELECT sha256(concat_ws('||', CAST(e.match_id AS VARCHAR), coalesce(e.team, ''), coalesce(e.player, ''),
    coalesce(CAST(e.minute AS VARCHAR), ''), coalesce(e.goal_type, ''), CAST(e.n AS VARCHAR))) AS goal_id,
  e.match_id, e.round, s.season, s.match_date, e.team, e.player, e.minute_raw, e.minute_base, e.stoppage_minute,
  e.minute, {_bucket('e.minute')} AS minute_bucket, e.goal_type, {_side()} AS is_home_team_goal,
  e.ingestion_date, e.source_file
FROM numbered_goals e LEFT JOIN silver_matches s ON e.match_id = s.match_id""",
    "typed_cards": rf"""
SELECT TRY_CAST(partida_ID AS BIGINT) AS match_id, TRY_CAST(rodada AS INT) AS round, {_clean('clube')} AS team,
  CASE lower(trim(cartao)) WHEN 'amarelo' THEN 'yellow' WHEN 'vermelho' THEN 'red' ELSE lower(trim(cartao)) END
    AS card_type,
  {_clean('atleta')} AS player,
  TRY_CAST(regexp_replace(num_camisa, '[^0-9\-]', '', 'g') AS INT) AS shirt_number,
  {_clean('posicao')} AS position, {_MINUTES}, {_LINEAGE}
FROM cards_raw""",
    "silver_cards": f"""
SELECT sha256(concat_ws('||', CAST(e.match_id AS VARCHAR), coalesce(e.team, ''), coalesce(e.player, ''),
    coalesce(CAST(e.shirt_number AS VARCHAR), ''), coalesce(e.position, ''),
    coalesce(CAST(e.minute_base + e.stoppage_minute AS VARCHAR), ''), coalesce(e.card_type, ''))) AS card_id,
  e.match_id, e.round, s.season, s.match_date, e.team, e.player, e.shirt_number, e.position, e.minute_raw,
  e.minute_base, e.stoppage_minute, e.minute_base + e.stoppage_minute AS minute,
  {_bucket('(e.minute_base + e.stoppage_minute)')} AS minute_bucket, e.card_type,
  CASE e.card_type WHEN 'yellow' THEN 1 WHEN 'red' THEN 2 END AS card_weight, {_side()} AS is_home_team_card,
  e.ingestion_date, e.source_file
FROM typed_cards e LEFT JOIN silver_matches s ON e.match_id = s.match_id""",
    "sided_statistics": f"""
SELECT TRY_CAST(r.partida_id AS BIGINT) AS match_id, TRY_CAST(r.rodada AS INT) AS round, s.season, s.match_date,
  {_clean('r.clube')} AS team, s.home_team, s.away_team, s.home_score, s.away_score,
  {_side(_clean('r.clube'))} AS is_home_team, {_whole('chutes')} AS shots,
  {_whole('chutes_no_alvo')} AS shots_on_target, {_decimal('posse_de_bola')} AS possession,
  {_whole('passes')} AS passes, {_decimal('precisao_passes')} AS pass_accuracy, {_whole('faltas')} AS fouls,
  {_whole('cartao_amarelo')} AS yellow_cards, {_whole('cartao_vermelho')} AS red_cards,
  {_whole('impedimentos')} AS offsides, {_whole('escanteios')} AS corners,
  CAST(r._load_date AS DATE) AS ingestion_date, r._source_file AS source_file
FROM match_statistics_raw r LEFT JOIN silver_matches s ON TRY_CAST(r.partida_id AS BIGINT) = s.match_id""",
    "seen_statistics": """
SELECT *, CASE WHEN is_home_team THEN away_team WHEN NOT is_home_team THEN home_team END AS opponent_team,
  CASE WHEN is_home_team THEN home_score WHEN NOT is_home_team THEN away_score END AS goals_scored,
  CASE WHEN is_home_team THEN away_score WHEN NOT is_home_team THEN home_score END AS goals_conceded
FROM sided_statistics""",
    "silver_match_statistics": """
SELECT match_id, round, season, match_date, team, opponent_team, is_home_team,
  CASE WHEN goals_scored > goals_conceded THEN 'win' WHEN goals_scored < goals_conceded THEN 'loss'
       WHEN goals_scored = goals_conceded THEN 'draw' END AS match_result,
  goals_scored, goals_conceded, shots, shots_on_target,
  CAST(shots_on_target AS DOUBLE) / nullif(shots, 0) AS shot_accuracy,
  CAST(goals_scored AS DOUBLE) / nullif(shots, 0) AS scoring_efficiency,
  possession, passes, pass_accuracy, fouls, yellow_cards, red_cards, offsides, corners, ingestion_date, source_file
FROM seen_statistics""",
    "fact_matches": f"""
SELECT * EXCLUDE (ingestion_date, source_file), {_POINTS.format('home_result')} AS match_points_home,
  {_POINTS.format('away_result')} AS match_points_away, CAST(home_result = 'win' AS INT) AS home_win_flag,
  CAST(away_result = 'win' AS INT) AS away_win_flag, CAST(coalesce(is_draw, FALSE) AS INT) AS draw_flag
FROM silver_matches""",
    "fact_goals": "SELECT * EXCLUDE (ingestion_date, source_file) FROM silver_goals",
    "fact_cards": "SELECT * EXCLUDE (ingestion_date, source_file) FROM silver_cards",
    "fact_team_match_statistics": f"""
SELECT * EXCLUDE (ingestion_date, source_file),
  CASE WHEN is_home_team THEN 'home' WHEN NOT is_home_team THEN 'away' END AS match_side,
  {_POINTS.format('match_result')} AS match_points,
  CAST(coalesce(match_result = 'win', FALSE) AS INT) AS win_flag,
  CAST(coalesce(match_result = 'draw', FALSE) AS INT) AS draw_flag,
  CAST(coalesce(match_result = 'loss', FALSE) AS INT) AS loss_flag,
  CAST(coalesce(goals_conceded = 0, FALSE) AS INT) AS clean_sheet_flag
FROM silver_match_statistics""",
}

_TEAM_SUMS = """
  count(*) AS matches, CAST(sum(win_flag) AS BIGINT) AS wins, CAST(sum(draw_flag) AS BIGINT) AS draws,
  CAST(sum(loss_flag) AS BIGINT) AS losses, CAST(sum(goals_scored) AS BIGINT) AS goals_for,
  CAST(sum(goals_conceded) AS BIGINT) AS goals_against, CAST(sum(match_points) AS BIGINT) AS points
"""


def _averages(*columns: str) -> str:
    return ", ".join(f"round(avg({column}), 9) AS avg_{column}" for column in columns)


_POINTS_PCT = "round(CAST(points AS DOUBLE) / (matches * 3), 9) AS points_pct"

VIEWS |= {
    "team_season_summary": f"""
SELECT *, goals_for - goals_against AS goal_difference,
  round(CAST(points AS DOUBLE) / matches, 9) AS points_per_match,
  round(CAST(wins AS DOUBLE) / matches, 9) AS win_rate, {_POINTS_PCT}
FROM (SELECT season, team, {_TEAM_SUMS}, {_averages('goals_scored', 'goals_conceded', 'shots', 'shots_on_target',
    'shot_accuracy', 'scoring_efficiency', 'possession', 'passes', 'pass_accuracy', 'fouls', 'yellow_cards',
    'red_cards', 'corners')}, CAST(sum(clean_sheet_flag) AS BIGINT) AS clean_sheets
  FROM fact_team_match_statistics GROUP BY season, team)""",
    "team_home_away_summary": f"""
SELECT *, goals_for - goals_against AS goal_difference, {_POINTS_PCT}
FROM (SELECT season, team, match_side, {_TEAM_SUMS}, {_averages('goals_scored', 'goals_conceded', 'shots',
    'possession', 'pass_accuracy')}
  FROM fact_team_match_statistics GROUP BY season, team, match_side)""",
    "top_scorers_by_season": """
SELECT season, team, player, count(*) AS goals, round(avg(minute), 9) AS avg_goal_minute,
  count(*) FILTER (goal_type = 'penalti') AS penalty_goals,
  count(*) FILTER (goal_type = 'gol_contra') AS own_goals_labeled
FROM fact_goals WHERE player IS NOT NULL GROUP BY season, team, player""",
    "card_totals": """
SELECT season, team, count(*) FILTER (card_type = 'yellow') AS yellow_cards_events,
  count(*) FILTER (card_type = 'red') AS red_cards_events, sum(card_weight) AS discipline_points
FROM fact_cards GROUP BY season, team""",
    "foul_totals": """
SELECT season, team, count(*) AS matches, CAST(sum(fouls) AS BIGINT) AS fouls, round(avg(fouls), 9) AS avg_fouls,
  round(avg(yellow_cards), 9) AS avg_yellow_cards_boxscore, round(avg(red_cards), 9) AS avg_red_cards_boxscore
FROM fact_team_match_statistics GROUP BY season, team""",
    "team_discipline_summary": """
SELECT f.*, coalesce(c.yellow_cards_events, 0) AS yellow_cards_events,
  coalesce(c.red_cards_events, 0) AS red_cards_events,
  CAST(coalesce(c.discipline_points, 0) AS BIGINT) AS discipline_points,
  round(CAST(coalesce(c.yellow_cards_events, 0) + coalesce(c.red_cards_events, 0) AS DOUBLE) / f.matches, 9)
    AS cards_per_match
FROM foul_totals f LEFT JOIN card_totals c ON f.season = c.season AND f.team = c.team""",
    "home_away_wide": """
SELECT season, team, CAST(count(*) FILTER (match_side = 'home') AS INT) AS home_matches,
  CAST(count(*) FILTER (match_side = 'home' AND win_flag = 1) AS INT) AS home_wins,
  CAST(count(*) FILTER (match_side = 'away') AS INT) AS away_matches,
  CAST(count(*) FILTER (match_side = 'away' AND win_flag = 1) AS INT) AS away_wins
FROM fact_team_match_statistics GROUP BY season, team""",
}


def _over_views(select: str) -> str:
    views = ",\n".join(f"{name} AS ({text})" for name, text in VIEWS.items())
    return f"WITH {views}\n{select}"


_EVENT_MINUTES = "minute_base AS minute, stoppage_minute AS minute_extra, minute AS minute_exact"

SERVING = {
    "serving_fact_matches": """
SELECT CAST(match_id AS VARCHAR) AS match_id, season, round,
  coalesce(match_datetime, CAST(match_date AS TIMESTAMP)) AS date, home_team, away_team, home_score, away_score
FROM fact_matches""",
    "serving_fact_goals": f"""
SELECT goal_id, CAST(match_id AS VARCHAR) AS match_id, team, player, {_EVENT_MINUTES} FROM fact_goals""",
    "serving_fact_cards": f"""
SELECT card_id, CAST(match_id AS VARCHAR) AS match_id, team, player, card_type, {_EVENT_MINUTES} FROM fact_cards""",
    "serving_team_season": """
SELECT season, team, CAST(matches AS INT) AS matches, CAST(wins AS INT) AS wins, CAST(draws AS INT) AS draws,
  CAST(losses AS INT) AS losses, CAST(goals_for AS INT) AS goals_for, CAST(goals_against AS INT) AS goals_against,
  CAST(goal_difference AS INT) AS goal_diff, CAST(points AS INT) AS points
FROM team_season_summary""",
    "serving_scorers": "SELECT season, player, team, CAST(goals AS INT) AS goals FROM top_scorers_by_season",
    "serving_discipline": """
SELECT season, team, CAST(yellow_cards_events AS INT) AS yellow_cards, CAST(red_cards_events AS INT) AS red_cards,
  CAST(fouls AS INT) AS fouls
FROM team_discipline_summary""",
}


def _rows(table: str, predicate: str) -> str:
    return f"SELECT count(*) FROM {table} WHERE {predicate}"


def _groups(table: str, keys: str, having: str) -> str:
    return f"SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING {having})"


def _suite(table: str, checks: dict[str, tuple[str, ...]], warnings: tuple[str, ...] = ()) -> str:
    """Each check is ('row', predicate), ('group', keys, having) or ('count', subquery)."""
    lines = []
    for name, check in checks.items():
        if check[0] == "row":
            counted = _rows(table, check[1])
        elif check[0] == "group":
            counted = _groups(table, check[1], check[2])
        else:
            counted = check[1]
        severity = "warning" if name in warnings else "critical"
        lines.append(
            f"SELECT '{name}' AS check_name, '{severity}' AS severity, CAST(({counted}) AS BIGINT) AS invalid_count"
        )
    return "\nUNION ALL\n".join(lines)


def _nulls(*columns: str) -> dict[str, tuple[str, ...]]:
    return {f"null_{column}": ("row", f"{column} IS NULL") for column in columns}


def _twice(keys: str) -> tuple[str, ...]:
    return ("group", keys, "count(*) > 1")


_SCORES = {
    "same_home_away_team": ("row", "home_team = away_team"),
    "null_scores": ("row", "home_score IS NULL OR away_score IS NULL"),
    "negative_scores": ("row", "home_score < 0 OR away_score < 0"),
    "total_goals_mismatch": ("row", "total_goals <> home_score + away_score"),
    "is_draw_mismatch": ("row", "is_draw <> (home_score = away_score)"),
}
_EVENT = {
    **_nulls("match_id", "team", "player", "season", "minute"),
    "negative_minute": ("row", "minute < 0"),
    "minute_too_high": ("row", "minute > 130"),
}
_RESULT = "CASE WHEN {0} > {1} THEN 'win' WHEN {0} < {1} THEN 'loss' ELSE 'draw' END"
_WARNINGS = ("null_match_datetime", "null_home_coach", "null_away_coach", "null_gross_revenue")

MATCHES_REPORT = {
    **_nulls("match_id", "match_date", "season", "home_team", "away_team", "match_datetime", "home_coach",
             "away_coach", "gross_revenue"),
    "duplicate_match_id": ("group", "match_id", "count(*) > 1 AND match_id IS NOT NULL"),
    **_SCORES,
    "season_mismatch": ("row", "season <> year(match_date)"),
    "home_result_mismatch": ("row", f"home_result <> {_RESULT.format('home_score', 'away_score')}"),
    "away_result_mismatch": ("row", f"away_result <> {_RESULT.format('away_score', 'home_score')}"),
    "draw_with_winner": ("row", "is_draw AND winner_normalized IS NOT NULL"),
    "non_draw_invalid_winner": ("row", "NOT is_draw AND (winner_normalized IS NULL OR (winner_normalized <> home_team "
                                       "AND winner_normalized <> away_team))"),
}

RECONCILED = """
SELECT s.match_id, s.total_goals, coalesce(g.n, 0) AS goal_events
FROM silver_matches s LEFT JOIN (SELECT match_id, count(*) AS n FROM silver_goals GROUP BY match_id) g
  ON s.match_id = g.match_id
WHERE coalesce(g.n, 0) <> s.total_goals"""

QUALITY = {
    "dq_silver_matches_gate": _suite("silver_matches", {
        "duplicate_match_id": _twice("match_id"),
        **_nulls("match_id", "match_date", "season"),
        "same_home_away_team": _SCORES["same_home_away_team"],
        "negative_scores": _SCORES["negative_scores"],
        "draw_with_winner": ("row", "is_draw AND winner <> '-'"),
        "non_draw_invalid_winner": ("row", "NOT is_draw AND (winner IS NULL OR (winner <> home_team AND "
                                           "winner <> away_team))"),
    }),
    "dq_silver_matches": _suite("silver_matches", MATCHES_REPORT, _WARNINGS),
    "dq_silver_goals": _suite("silver_goals", {
        **_EVENT,
        "invalid_team_for_match": ("row", "is_home_team_goal IS NULL"),
        "duplicate_goal_id": _twice("goal_id"),
        "goal_count_mismatch_vs_matches": ("count", f"SELECT count(*) FROM ({RECONCILED})"),
    }),
    "dq_silver_cards": _suite("silver_cards", {
        **_EVENT,
        "invalid_team_for_match": ("row", "is_home_team_card IS NULL"),
        "invalid_card_type": ("row", "card_type NOT IN ('yellow', 'red')"),
        "invalid_card_weight": ("row", "(card_type = 'yellow' AND card_weight <> 1) OR (card_type = 'red' AND "
                                       "card_weight <> 2)"),
        "invalid_shirt_number": ("row", "shirt_number <= 0"),
        "duplicate_card_id": _twice("card_id"),
    }),
    "dq_silver_match_statistics": _suite("silver_match_statistics", {
        **_nulls("match_id", "team", "season"),
        "invalid_team_for_match": ("row", "is_home_team IS NULL"),
        "duplicate_match_team_rows": _twice("match_id, team"),
        "rows_per_match_not_equal_2": ("group", "match_id", "count(*) <> 2"),
        "shots_on_target_greater_than_shots": ("row", "shots_on_target > shots"),
        "invalid_possession_range": ("row", "possession < 0 OR possession > 100"),
        "invalid_pass_accuracy_range": ("row", "pass_accuracy < 0 OR pass_accuracy > 100"),
        "negative_numeric_stats": ("row", "least(shots, shots_on_target, passes, fouls, yellow_cards, red_cards, "
                                          "offsides, corners) < 0"),
        "goals_scored_mismatch_vs_result": (
            "row", f"match_result <> {_RESULT.format('goals_scored', 'goals_conceded')}"),
    }),
    "dq_fact_matches": _suite("fact_matches", {
        **_nulls("match_id", "match_date", "season", "home_team", "away_team"),
        "duplicate_match_id": _twice("match_id"),
        **_SCORES,
        "home_points_mismatch": ("row", f"match_points_home <> {_POINTS.format('home_result')}"),
        "away_points_mismatch": ("row", f"match_points_away <> {_POINTS.format('away_result')}"),
        "draw_flag_mismatch": ("row", "draw_flag <> CAST(coalesce(is_draw, FALSE) AS INT)"),
    }),
    "dq_fact_goals": _suite("fact_goals", {
        **_nulls("goal_id", "match_id", "team", "season"),
        "duplicate_goal_id": _twice("goal_id"),
        "negative_minute": _EVENT["negative_minute"],
    }),
    "dq_fact_cards": _suite("fact_cards", {
        **_nulls("card_id", "match_id", "team", "season"),
        "duplicate_card_id": _twice("card_id"),
        "invalid_card_type": ("row", "card_type NOT IN ('yellow', 'red')"),
        "negative_minute": _EVENT["negative_minute"],
    }),
    "dq_fact_team_match_statistics": _suite("fact_team_match_statistics", {
        **_nulls("match_id", "team", "season", "match_result"),
        "same_team_opponent": ("row", "team = opponent_team"),
        "duplicate_match_team": _twice("match_id, team"),
        "rows_per_match_not_equal_2": ("group", "match_id", "count(*) <> 2"),
        "invalid_match_side": ("row", "match_side NOT IN ('home', 'away')"),
        "negative_goals": ("row", "goals_scored < 0 OR goals_conceded < 0"),
    }),
}


def _quarantined() -> str:
    parts = []
    for name, check in MATCHES_REPORT.items():
        if check[0] == "row":
            parts.append(f"SELECT '{name}' AS check_name, match_id FROM silver_matches WHERE {check[1]}")
        else:
            parts.append(
                f"SELECT '{name}' AS check_name, match_id FROM silver_matches GROUP BY {check[1]} HAVING {check[2]}"
            )
    return "\nUNION ALL\n".join(parts)


KEYS = {
    "fact_matches": ("match_id",),
    "fact_goals": ("goal_id",),
    "fact_cards": ("card_id",),
    "team_season_summary": ("season", "team"),
    "team_home_away_summary": ("season", "team"),
    "top_scorers_by_season": ("season", "player", "team"),
    "team_discipline_summary": ("season", "team"),
}


def _key_line(name: str, keys: tuple[str, ...]) -> str:
    table = "home_away_wide" if name == "team_home_away_summary" else name
    names = ", ".join(keys)
    nulls = " OR ".join(f"{key} IS NULL" for key in keys)
    return (
        f"SELECT '{name}' AS table_name, '{names}' AS key_columns, "
        f"CAST(({_groups(table, names, 'count(*) > 1')}) AS BIGINT) AS duplicate_groups, "
        f"CAST(({_rows(table, nulls)}) AS BIGINT) AS null_key_rows"
    )


def _orphan_lines(table: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, e.match_id, count(*) AS orphan_rows FROM {table} e "
        f"WHERE e.match_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM fact_matches s WHERE s.match_id = e.match_id) "
        f"GROUP BY e.match_id"
    )


def _distinct(column: str) -> str:
    return f"count(DISTINCT {column}) + CAST(coalesce(max(CAST({column} IS NULL AS INT)), 0) AS BIGINT)"


_METRIC_TABLES = (
    ("silver_matches", "match_id", "home_team"),
    ("silver_goals", "match_id", "team"),
    ("silver_cards", "match_id", "team"),
    ("silver_match_statistics", "match_id", "team"),
)

HEADERS = {
    "matches": ("ID", "rodada", "data", "hora", "mandante", "visitante", "formacao_mandante", "formacao_visitante",
                "tecnico_mandante", "tecnico_visitante", "vencedor", "arena", "mandante_Placar", "visitante_Placar",
                "mandante_Estado", "visitante_Estado", "arrecadacao"),
    "goals": ("partida_id", "rodada", "clube", "atleta", "minuto", "tipo_de_gol"),
    "cards": ("partida_ID", "rodada", "clube", "cartao", "atleta", "num_camisa", "posicao", "minuto"),
    "match_statistics": ("partida_id", "rodada", "clube", "chutes", "chutes_no_alvo", "posse_de_bola", "passes",
                         "precisao_passes", "faltas", "cartao_amarelo", "cartao_vermelho", "impedimentos",
                         "escanteios"),
}

#: Tables that the pipeline's steps make of files that hold all loads.
THROUGH_LAYERS = {
    "pipeline_team_season": "team_season_summary",
    "pipeline_home_away": "team_home_away_summary",
    "pipeline_scorers": "top_scorers_by_season",
    "pipeline_fact_matches": "fact_matches",
}

#: The cards that pass the gate of the card facts: of a known type, one per player and match.
TOLD_APART = (
    "SELECT * FROM cards_raw WHERE cartao <> 'azul' "
    "QUALIFY count(*) OVER (PARTITION BY partida_ID, clube, atleta) = 1"
)

OTHER = {
    "silver_goals_hot": "SELECT * FROM silver_goals",
    "resolved_columns": """
SELECT partida_id AS match_id, rodada AS round, clube AS team, cartao AS card_type, atleta AS player,
  num_camisa AS shirt_number, posicao AS position, minuto AS minute_text, _load_date AS ingestion_date,
  _source_file AS source_file
FROM cards_raw""",
    "latest_load": f"SELECT ID AS match_key, _load_date AS load_date FROM matches_raw WHERE {LATEST}",
    "explicit_load": "SELECT ID AS match_key, _load_date AS load_date FROM matches_raw "
                     "WHERE _load_date = '2024-01-01'",
    "dq_quarantine": _quarantined(),
    "dq_samples": f"""
SELECT check_name, match_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY md5(CAST(match_id AS VARCHAR))) AS rank
  FROM ({_quarantined()})
) WHERE rank <= 5""",
    "dq_unique_keys": "\nUNION ALL\n".join(_key_line(table, keys) for table, keys in KEYS.items()),
    "dq_orphans": "\nUNION ALL\n".join(_orphan_lines(table) for table in ("fact_goals", "fact_cards")),
    "goal_reconciliation": RECONCILED,
    "run_metrics": "\nUNION ALL\n".join(
        f"SELECT '{table}' AS table_name, count(*) AS \"rows\", {_distinct(key)} AS distinct_matches, "
        f"{_distinct('season')} AS distinct_seasons, {_distinct(team)} AS distinct_teams FROM {table}"
        for table, key, team in _METRIC_TABLES
    ),
    "bronze_roundtrip": f"""
SELECT * EXCLUDE (_source_file, hora, formacao_mandante), nullif(hora, '') AS hora,
  nullif(formacao_mandante, '') AS formacao_mandante
FROM matches_raw WHERE {LATEST}""",
    "landed_rows": """
SELECT * EXCLUDE (_source_file, _load_date, hora, formacao_mandante), nullif(hora, '') AS hora,
  nullif(formacao_mandante, '') AS formacao_mandante, '2024-01-02' AS _load_date
FROM matches_raw""",
    "landed_again": f"""
SELECT * EXCLUDE (_source_file, hora, formacao_mandante), nullif(hora, '') AS hora,
  nullif(formacao_mandante, '') AS formacao_mandante
FROM matches_raw WHERE {LATEST}""",
    "landed_lineage": """
SELECT 'matches' AS source, '2024-01-02' AS load_date, 'matches.csv' AS file, 'matches' AS source_name,
  'matches.csv' AS original_filename, CAST(octet_length(encode(bytes)) AS BIGINT) AS file_size_bytes, n AS row_count,
  4 AS column_count, 'ID,rodada,data,mandante_Placar' AS columns, 'ID,rodada,data,mandante_Placar' AS header,
  false AS spans_lines, sha256(bytes) AS file_sha256, 'UTF-8' AS encoding, n AS traced_rows,
  '2024-01-02' AS traced_load_date
FROM (
  SELECT count(*) AS n, 'ID,rodada,data,mandante_Placar' || chr(10)
      || string_agg(ID || ',' || rodada || ',' || data || ',' || mandante_Placar || chr(10), '' ORDER BY CAST(ID AS BIGINT))
      AS bytes
  FROM matches_raw
)""",
    "file_manifest": "\nUNION ALL\n".join(
        f"SELECT '{source}' AS source_name, (SELECT count(*) FROM {source}_raw) AS row_count, "
        f"{len(columns)} AS column_count, '{','.join(columns)}' AS columns, 'UTF-8' AS encoding"
        for source, columns in HEADERS.items()
    ),
}

_TABLES = (
    "silver_matches", "silver_goals", "silver_cards", "silver_match_statistics", "fact_matches", "fact_goals",
    "fact_cards", "fact_team_match_statistics", "team_season_summary", "team_home_away_summary",
    "top_scorers_by_season", "team_discipline_summary", "home_away_wide",
)


def oracle_sql() -> dict[str, str]:
    selects = {name: f"SELECT * FROM {name}" for name in _TABLES}
    found = {name: _over_views(text) for name, text in {**selects, **SERVING, **QUALITY, **OTHER}.items()}
    layered = {name: found[mart].replace(LATEST, "TRUE") for name, mart in THROUGH_LAYERS.items()}
    cards = found["team_discipline_summary"].replace("FROM cards_raw", f"FROM ({TOLD_APART})")
    layered["pipeline_discipline"] = cards.replace(LATEST, "TRUE")
    gate = found["dq_fact_cards"].replace(LATEST, "TRUE")
    layered["pipeline_gate"] = f"""
SELECT *, max(invalid_count) OVER () > 0 AS raised, max(invalid_count) OVER () = 0 AS published FROM ({gate})"""
    layered["pipeline_rebuilt"] = f"SELECT *, season = 1995 AS rewritten FROM ({layered['pipeline_team_season']})"
    layered["dq_by_season"] = found["dq_silver_match_statistics"]
    return found | layered
