"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, secret_scan, source_mix
from touchline.llm.chat import conversation_digests
from touchline.llm.common import SPACES, table
from touchline.llm.conversation_trie import prefix_trie, with_shared_heads
from touchline.llm.exact_dedup import exact_duplicates
from touchline.llm.ordinal_quality import quality_grades
from touchline.llm.periodic_runs import periodic_runs
from touchline.llm.quality_rules import quality_rules
from touchline.llm.simhash import near_duplicates
from touchline.llm.token_counts import token_counts
from touchline.llm.toxicity import toxicity
from touchline.llm.url_rules import judge

PATTERN = public_tokenizers.PATTERN
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), RANKS, PATTERN)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_grades(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: A conversation that says the template's own control strings.
PROBE = [(-7, turn, role, r"\### Assistant: </turn> ok") for turn, role in enumerate(("user", "assistant"))]


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(source_mix.with_domain(table(spark, sf_dir, "documents")), source_mix.LEVELS)


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(turns.unionByName(spark.createDataFrame(PROBE, turns.schema)))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), PIECES)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def _partly_periodic(docs: DataFrame) -> DataFrame:
    """Id and text; the texts of a tenth of the ids, chosen by CRC-32, repeat a stretch of theirs up to the end."""
    chance = F.crc32(F.col("doc_id").cast("string"))
    words = F.array_remove(F.split("text", SPACES), "")
    n, g = F.size("words"), F.floor(F.col("chance") / 10)
    at = (g % n).cast("int")
    period = (1 + F.floor((n - F.col("at")) / (3 + g % 8))).cast("int")
    times = F.ceil((n - F.col("at")) / F.col("period")).cast("int")
    unit = F.slice("words", F.col("at") + 1, F.col("period"))
    repeated = F.concat(F.slice("words", F.lit(1), F.col("at")), F.flatten(F.array_repeat(unit, times)))
    return (
        docs.select("doc_id", "text", chance.alias("chance"))
        .withColumn("words", F.when(F.col("chance") % 10 == 0, words))
        .withColumn("at", F.when(n > 0, at))
        .withColumn("period", F.when(n > 0, period))
        .select("doc_id", F.when(n > 0, F.array_join(F.slice(repeated, F.lit(1), n), " ")).otherwise(F.col("text")).alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_partly_periodic(table(spark, sf_dir, "documents")))
    longest = F.array_max(
        F.transform("runs", lambda run: F.struct(run["length"].alias("n"), (-run["start"]).alias("s"), (-run["period"]).alias("q")))
    )

    def line(run: Column) -> Column:
        return F.concat_ws(",", *[run[name].cast("string") for name in ("start", "length", "period")])

    lines = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.n").alias("length"),
        (-F.col("longest.q")).alias("period"),
        F.floor(1000 * F.col("longest.n") / -F.col("longest.q")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(with_shared_heads(table(spark, sf_dir, "conversations"))).drop("node_id")


#: The rules of the contract.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, "host string, path string, verdict string"))


#: Ids are unique in ``documents``.
EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def _filled(level: int) -> str:
    """SQL that divides each parent's tokens among the nodes of one level of the tree."""
    path = ["domain", "lang", "source"][:level]
    parents = path[:-1]
    columns, part = ", ".join(path), f"PARTITION BY {', '.join(parents)}" if parents else ""
    from_ = (
        f"JOIN given{level - 1} AS g ON " + " AND ".join(f"n.{name} IS NOT DISTINCT FROM g.{name}" for name in parents)
        if parents
        else "CROSS JOIN (SELECT sum(n_tokens)::HUGEINT AS given FROM docs) AS g"
    )
    before = f"({part} ORDER BY coalesce(supply::DOUBLE / nullif(weight, 0), -1), {columns} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""
nodes{level} AS (
    SELECT {columns}, sum(tokens * 2)::HUGEINT AS supply, any_value(w{level})::HUGEINT AS weight
    FROM leaves GROUP BY {columns}
),
ranked{level} AS (
    SELECT {columns}, supply, weight,
           budget - coalesce(sum(supply) OVER {before}, 0) AS remaining,
           sum(weight) OVER ({part}) - coalesce(sum(weight) OVER {before}, 0) AS weights
    FROM (SELECT n.*, g.given AS budget FROM nodes{level} AS n {from_})
),
marked{level} AS (SELECT *, supply * weights <= weight * greatest(remaining, 0) AS filled FROM ranked{level}),
given{level} AS (
    SELECT {columns},
           (CASE WHEN filled THEN supply
                 ELSE weight * greatest(max(CASE WHEN NOT filled THEN remaining END) OVER ({part}), 0)
                      // max(CASE WHEN NOT filled THEN weights END) OVER ({part}) END)::HUGEINT AS given
    FROM marked{level}
)"""


def _case(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{value}' THEN {weight}" for value, weight in weights.items()) + " ELSE 1 END"


def _source_mix_sql() -> str:
    domains = ", ".join(f"'{name}'" for name in source_mix.DOMAIN_WEIGHTS)
    return rf"""
WITH docs AS (
    SELECT doc_id, lang, source,
           coalesce(list_extract([{domains}],
               try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS BIGINT) % 4 + 1), 'other')
               AS domain,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
    FROM documents
),
leaves AS (
    SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens,
           {_case("domain", source_mix.DOMAIN_WEIGHTS)} AS w1, {_case("lang", source_mix.LANGUAGE_WEIGHTS)} AS w2, 1 AS w3
    FROM docs GROUP BY domain, lang, source
),{_filled(1)},{_filled(2)},{_filled(3)},
plan AS (
    SELECT l.domain, l.lang, l.source,
           CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS whole,
           CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS rest
    FROM leaves AS l JOIN given3 AS g ON l.domain IS NOT DISTINCT FROM g.domain
         AND l.lang IS NOT DISTINCT FROM g.lang AND l.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, d.domain, d.lang, d.source, n_tokens,
       (whole + CASE WHEN sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source
                                              ORDER BY md5('{source_mix.SEED}:' || whole || ':' || doc_id)) <= rest
                     THEN 1 ELSE 0 END)::BIGINT AS copies
FROM docs AS d JOIN plan AS p ON d.domain IS NOT DISTINCT FROM p.domain
     AND d.lang IS NOT DISTINCT FROM p.lang AND d.source IS NOT DISTINCT FROM p.source
"""


CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           turn AS by_turn, role AS by_role, text AS by_text
    FROM (
        SELECT conv_id, turn, role, text FROM conversations
        UNION ALL
        SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                              (-7, 1, 'assistant', '\### Assistant: </turn> ok')) AS probe(conv_id, turn, role, text)
    )
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY by_turn, by_role, by_text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY by_turn, by_role, by_text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || regexp_replace(role, '(\\|###|</turn>|:)', '\\\1', 'g') || ': '
                  || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || '</turn>' || chr(10)))::BIGINT
           AS formatted_chars,
       false AS rewrites_history
FROM turns
GROUP BY conv_id
"""


#: CRC-32 of a number's digits, in words of SQL: bytes are folded in one by one, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                            lambda x, bit: xor(x >> 1, (x & 1) * 3988292384))))"""

#: Turns are unique by conversation and number, and ids are not null.
CONVERSATION_TRIE = f"""
WITH lists AS (
    SELECT conv_id, {_CRC32} % 6 AS h,
           list(sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) || ':'
                || length(coalesce(text, '')) ORDER BY turn NULLS FIRST) AS own
    FROM conversations GROUP BY conv_id
),
rebuilt AS (
    SELECT l.conv_id, list_concat(coalesce(d.own[1:l.h], []), l.own[l.h + 1:]) AS turns
    FROM lists AS l LEFT JOIN lists AS d ON d.conv_id = l.conv_id - l.conv_id % 100
),
prefixes AS (
    SELECT conv_id, depth, len(turns) = depth AS ends, array_to_string(turns[1:depth], ',') AS path,
           array_to_string(turns[1:depth - 1], ',') AS parent, turns[1:depth] AS way
    FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt)
),
nodes AS (
    SELECT path, depth, any_value(parent) AS parent, any_value(way) AS way, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM prefixes GROUP BY path, depth
),
children AS (SELECT parent AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY parent, depth),
below AS (
    SELECT array_to_string(way[1:k], ',') AS path, k AS depth, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT n.way, unnest(range(0, n.depth + 1)) AS k, (c.n IS NULL)::BIGINT AS leaf,
                 CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * split_part(n.way[-1], ':', 2)::BIGINT END AS saved
          FROM nodes AS n LEFT JOIN children AS c USING (path, depth))
    GROUP BY 1, 2
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(c.n, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens,
       n.ends_sha256
FROM nodes AS n JOIN below AS b USING (path, depth) LEFT JOIN children AS c USING (path, depth)
     LEFT JOIN nodes AS p ON p.path = n.parent AND p.depth = n.depth - 1
"""


def _url_filter_sql() -> str:
    rules = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    return f"""
WITH rules(host, path, verdict) AS (VALUES {rules}),
rests AS (
    SELECT page_id, row_number() OVER () AS n,
           CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
urls AS (
    SELECT page_id, n, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rests
),
fits AS (
    SELECT u.n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM urls AS u JOIN rules AS r
         ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
    GROUP BY u.n
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM urls LEFT JOIN fits USING (n)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_quality_classifier": op3_quality_classifier,
        "op4_source_mix": op4_source_mix,
        "op5_chat_format": op5_chat_format,
        "op6_simhash": op6_simhash,
        "op7_token_counts": op7_token_counts,
        "op8_toxicity": op8_toxicity,
        "op9_secrets": op9_secrets,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_conversation_trie": op12_conversation_trie,
        "op13_url_filter": op13_url_filter,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_source_mix": _source_mix_sql(),
        "op5_chat_format": CHAT_FORMAT,
        "op10_exact_dedup": EXACT_DEDUP,
        "op12_conversation_trie": CONVERSATION_TRIE,
        "op13_url_filter": _url_filter_sql(),
    }
