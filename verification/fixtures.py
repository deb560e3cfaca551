"""Raw match data derived from ``orders``, ``customer`` and ``lineitem``: one SQL text for both engines.

``{orders}``, ``{customer}`` and ``{lineitem}`` stand for the tables, ``{sides}`` for one row per side 0 and 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("orders", "customer", "lineitem")
SPARK_SIDES = "LATERAL VIEW explode(array(0, 1)) s AS side"
DUCKDB_SIDES = ", unnest([0, 1]) AS s(side)"

BASE = """
SELECT o.o_orderkey AS k, o.o_orderdate AS d, o.o_totalprice AS p, c.c_name AS cn, c.c_mktsegment AS seg,
  'NATION_' || CAST(c.c_nationkey AS STRING) AS h,
  'NATION_' || CAST((c.c_nationkey + 1 + o.o_orderkey % 24) % 25 AS STRING) AS a,
  CAST(o.o_orderkey % 5 AS INT) AS hs, CAST(CAST(floor(o.o_orderkey / 5) AS BIGINT) % 4 AS INT) AS aws,
  CASE WHEN o.o_orderkey % 10 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS ld
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

MATCHES_RAW = """
SELECT CAST(k AS STRING) AS ID, CAST(k % 38 + 1 AS STRING) AS rodada,
  CASE WHEN k % 2 = 0 THEN lpad(CAST(day(d) AS STRING), 2, '0') || '/' || lpad(CAST(month(d) AS STRING), 2, '0')
         || '/' || CAST(year(d) AS STRING)
       ELSE CAST(year(d) AS STRING) || '-' || lpad(CAST(month(d) AS STRING), 2, '0') || '-'
         || lpad(CAST(day(d) AS STRING), 2, '0') END AS data,
  CASE WHEN k % 4 = 0 THEN '16:00' WHEN k % 4 = 1 THEN '18:30' WHEN k % 4 = 2 THEN '21:45:00' ELSE '' END AS hora,
  CASE WHEN k % 7 = 0 THEN chr(160) || h || ' ' ELSE h END AS mandante, a AS visitante,
  CASE WHEN k % 3 = 0 THEN '4-4-2' ELSE '' END AS formacao_mandante, '4-3-3' AS formacao_visitante,
  cn AS tecnico_mandante, CASE WHEN k % 6 = 0 THEN ' ' ELSE cn END AS tecnico_visitante,
  CASE WHEN hs > aws THEN h WHEN hs < aws THEN a ELSE '-' END AS vencedor, 'Arena ' || seg AS arena,
  CAST(hs AS STRING) AS mandante_Placar, CAST(aws AS STRING) AS visitante_Placar,
  substr(seg, 1, 2) AS mandante_Estado, substr(seg, 2, 2) AS visitante_Estado,
  CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(p AS STRING) END AS arrecadacao,
  ld AS _load_date, 'source=matches/load_date=' || ld || '/f.csv' AS _source_file
FROM m
"""

GOALS_RAW = """
SELECT CAST(m.k AS STRING) AS partida_id, CAST(m.k % 38 + 1 AS STRING) AS rodada,
  CASE WHEN l.l_linenumber % 2 = 1 THEN m.h WHEN l.l_linenumber = 6 THEN 'NATION_X' ELSE m.a END AS clube,
  CASE WHEN l.l_suppkey % 10 = 9 THEN ' ' ELSE 'P' || CAST(l.l_suppkey % 3 AS STRING) END AS atleta,
  CASE WHEN l.l_partkey % 5 = 0 THEN '45+' || CAST(l.l_partkey % 7 AS STRING) WHEN l.l_partkey % 13 = 0 THEN 'abc'
       WHEN l.l_partkey % 13 = 1 THEN NULL ELSE CAST(CAST(l.l_quantity AS INT) * 2 AS STRING) END AS minuto,
  CASE WHEN l.l_returnflag = 'A' THEN 'penalti' WHEN l.l_returnflag = 'R' THEN 'gol_contra' ELSE '' END AS tipo_de_gol,
  '2024-01-02' AS _load_date, 'source=goals/load_date=2024-01-02/f.csv' AS _source_file
FROM {lineitem} l JOIN m ON l.l_orderkey = m.k
"""

CARDS_RAW = """
SELECT CAST(m.k AS STRING) AS partida_ID, CAST(m.k % 38 + 1 AS STRING) AS rodada,
  CASE WHEN l.l_linenumber % 2 = 1 THEN m.h ELSE m.a END AS clube,
  CASE WHEN l.l_linestatus = 'F' THEN ' Amarelo' WHEN l.l_discount > 0.09 THEN 'azul' ELSE 'VERMELHO' END AS cartao,
  'P' || CAST(l.l_suppkey % 11 AS STRING) AS atleta,
  CASE WHEN l.l_partkey % 9 = 0 THEN 'n/a' ELSE '#' || CAST(l.l_partkey % 40 AS STRING) END AS num_camisa,
  CASE WHEN l.l_returnflag = 'N' THEN '' ELSE 'Zagueiro' END AS posicao,
  CASE WHEN l.l_partkey % 5 = 0 THEN '90+' || CAST(l.l_partkey % 7 AS STRING)
       ELSE CAST(CAST(l.l_quantity AS INT) * 2 AS STRING) END AS minuto,
  '2024-01-02' AS _load_date, 'source=cards/load_date=2024-01-02/f.csv' AS _source_file
FROM {lineitem} l JOIN m ON l.l_orderkey = m.k
"""

# Statistics cover every match, those of the older load too, so some have no match to join.
STATISTICS_RAW = """
SELECT CAST(m.k AS STRING) AS partida_id, CAST(m.k % 38 + 1 AS STRING) AS rodada,
  CASE WHEN s.side = 0 THEN m.h ELSE m.a END AS clube,
  CASE WHEN m.k % 17 = 0 THEN '0' WHEN m.k % 19 = 0 THEN '' ELSE CAST(8 + (m.k + s.side) % 9 AS STRING) END AS chutes,
  CASE WHEN m.k % 17 = 0 THEN '0' ELSE CAST((m.k + s.side) % 8 AS STRING) END AS chutes_no_alvo,
  CASE WHEN s.side = 0 THEN CAST(40 + m.k % 20 AS STRING) || '%'
       ELSE CAST(59 - m.k % 20 AS STRING) || ',5%' END AS posse_de_bola,
  CAST(300 + m.k % 200 AS STRING) AS passes, CAST(70 + m.k % 30 AS STRING) || '%' AS precisao_passes,
  CAST((m.k + s.side) % 25 AS STRING) AS faltas, CAST((m.k + s.side) % 6 AS STRING) AS cartao_amarelo,
  CASE WHEN m.k % 23 = 0 THEN '1' ELSE '0' END AS cartao_vermelho,
  CAST(m.k % 5 AS STRING) AS impedimentos, CAST((m.k + 3 * s.side) % 12 AS STRING) AS escanteios,
  '2024-01-02' AS _load_date, 'source=match_statistics/load_date=2024-01-02/f.csv' AS _source_file
FROM m {sides}
"""

RAW = {
    "matches": MATCHES_RAW,
    "goals": GOALS_RAW,
    "cards": CARDS_RAW,
    "match_statistics": STATISTICS_RAW,
}


def raw_view(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """One raw source over the whole tables of a scale-factor directory."""
    text = f"WITH m AS ({BASE}) {RAW[source]}"
    used = [name for name in TABLES if "{" + name + "}" in text]
    frames = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in used}
    return spark.sql(text.replace("{sides}", SPARK_SIDES), **frames)


def duckdb_raw_views() -> dict[str, str]:
    """Named queries for a DuckDB ``WITH`` list, in order."""
    names = {name: name for name in TABLES}
    views = {"m": BASE, **{f"{source}_raw": text for source, text in RAW.items()}}
    return {name: text.format(sides=DUCKDB_SIDES, **names) for name, text in views.items()}
