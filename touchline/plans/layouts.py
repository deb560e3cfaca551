"""Source layouts. The headers and spellings below are fixed values: they name what the source files contain."""

from __future__ import annotations

from touchline.functions.dates import load_day
from touchline.functions.numbers import (
    as_double,
    as_int,
    as_long,
    decimal_text_to_int,
    digits_to_int,
    percent_text,
)
from touchline.functions.text import clean_text, relabel
from touchline.operators.layout import Field
from touchline.operators.loads import LOAD_DATE
from touchline.sources.bronze import SOURCE_FILE

CARD_SPELLINGS = {"yellow": ("amarelo", "yellow"), "red": ("vermelho", "red")}
CARD_WEIGHTS = {"yellow": 1, "red": 2}
NO_WINNER = "-"
PENALTY_LABEL = "penalti"
OWN_GOAL_LABEL = "gol_contra"


def as_is(value):
    return value


def card_label(value):
    return relabel(value, CARD_SPELLINGS)


LINEAGE = (
    Field("ingestion_date", (LOAD_DATE,), load_day),
    Field("source_file", (SOURCE_FILE,), as_is),
)

MATCHES = (
    Field("match_id", ("ID",), as_long),
    Field("round", ("rodada",), as_int),
    Field("match_date_raw", ("data",), clean_text),
    Field("match_time", ("hora",), clean_text),
    Field("home_team", ("mandante",), clean_text),
    Field("away_team", ("visitante",), clean_text),
    Field("home_formation", ("formacao_mandante",), clean_text),
    Field("away_formation", ("formacao_visitante",), clean_text),
    Field("home_coach", ("tecnico_mandante",), clean_text),
    Field("away_coach", ("tecnico_visitante",), clean_text),
    Field("winner", ("vencedor",), clean_text),
    Field("stadium", ("arena",), clean_text),
    Field("home_score", ("mandante_Placar",), as_int),
    Field("away_score", ("visitante_Placar",), as_int),
    Field("home_state", ("mandante_Estado",), clean_text),
    Field("away_state", ("visitante_Estado",), clean_text),
    Field("gross_revenue", ("arrecadacao",), as_double),
    *LINEAGE,
)

MATCH_KEY = Field("match_id", ("partida_id", "match_id"), as_long)
ROUND = Field("round", ("rodada", "round"), as_int)
TEAM = Field("team", ("clube", "team"), clean_text)
PLAYER = Field("player", ("atleta", "player"), clean_text)
MINUTE = Field("minute_text", ("minuto", "minute"), as_is)

GOALS = (
    MATCH_KEY,
    ROUND,
    TEAM,
    PLAYER,
    MINUTE,
    Field("goal_type", ("tipo_de_gol", "tipo_gol", "goal_type"), clean_text),
    *LINEAGE,
)

CARDS = (
    MATCH_KEY,
    ROUND,
    TEAM,
    Field("card_type", ("cartao", "card_type"), card_label),
    PLAYER,
    Field("shirt_number", ("num_camisa", "shirt_number"), digits_to_int),
    Field("position", ("posicao", "position"), clean_text),
    MINUTE,
    *LINEAGE,
)

MATCH_STATISTICS = (
    MATCH_KEY,
    ROUND,
    TEAM,
    Field("shots", ("chutes", "shots"), decimal_text_to_int),
    Field("shots_on_target", ("chutes_no_alvo", "chutes_a_gol", "shots_on_target"), decimal_text_to_int),
    Field("possession", ("posse_de_bola", "possession"), percent_text),
    Field("passes", ("passes",), decimal_text_to_int),
    Field("pass_accuracy", ("precisao_passes", "precisao_de_passes", "pass_accuracy"), percent_text),
    Field("fouls", ("faltas", "fouls"), decimal_text_to_int),
    Field("yellow_cards", ("cartao_amarelo", "yellow_cards"), decimal_text_to_int),
    Field("red_cards", ("cartao_vermelho", "red_cards"), decimal_text_to_int),
    Field("offsides", ("impedimentos", "offsides"), decimal_text_to_int),
    Field("corners", ("escanteios", "corners"), decimal_text_to_int),
    *LINEAGE,
)
