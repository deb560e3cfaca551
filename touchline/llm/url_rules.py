"""URL filters: host-suffix and path-prefix expressions of each URL, looked up by short hashes.

1. A rule has a host, a path and a verdict. It fits its host and all subdomains if the URL's path begins with the rule's.
   Its *anchor* is its host and its path up to the last slash, so every URL it fits has the anchor among its own
   expressions: the last labels of the host, joined to the path up to one of its slashes (or to nothing).
2. Each URL is expanded into its expressions, only as deep as some rule goes: deeper ones cannot be an anchor.
3. The first four bytes of an expression's SHA-256 are joined to those of the anchors. A pair that meets is confirmed by
   the full digest of the rule against that of the URL's own suffix and as much of its path as the rule has.
4. Of the rules that fit, the longest wins (characters of host and path); then the longer host; then block before allow.
   A URL that no rule fits gets the default verdict.

Rules are broadcast up to ``BROADCAST_RULES`` of ``BROADCAST_BYTES`` in all, which is counted. Beyond, both sides are
shuffled by short hash. There, hashes that more than one in ``HOT_SHARE`` expressions have (so at most so many) are
dealt over ``SALTS`` tasks, with as many copies of their rules. Rows are numbered in a stored table before they are
expanded, so that they are put together again one by one, whatever their values repeat.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; the path what
follows up to ``?``, ``#`` or the end. A null URL, or one without ``://``, has both empty and may match only a rule with
an empty host. Null ids and repeated rows are rows as any. Very long URLs are read whole. Extra columns are ignored,
whatever their names. An empty table gives an empty result; without rules every row gets the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import staged

#: Hex digits of the hash that expressions are joined on: four bytes.
SHORT = 8
BROADCAST_RULES, BROADCAST_BYTES = 100_000, 16 << 20
HOT_SHARE, SALTS = 4_096, 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), "^[^/?#]*", 0)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _suffix(host: Column, labels: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -labels)


def _prefix(path: Column, slashes: Column) -> Column:
    """The path up to and with its n-th slash; nothing for none."""
    cut = F.call_function("substring_index", path, F.lit("/"), slashes)
    return F.when(slashes > 0, F.concat(cut, F.lit("/"))).otherwise("")


def prepared(rules: DataFrame) -> DataFrame:
    """Rules with their anchors' short hash, full digest and depth; of equal rules one, block before allow."""
    named = rules.select(
        F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.lower("verdict").alias("rule_verdict"),
    )
    one = named.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    slashes = _count(F.col("rule_path"), "/")
    return one.select(
        "*",
        (_count(F.col("rule_host"), ".") + 1).alias("labels"),
        slashes.alias("slashes"),
        _digest(F.col("rule_host"), F.col("rule_path")).alias("digest"),
        F.left(_digest(F.col("rule_host"), _prefix(F.col("rule_path"), slashes)), F.lit(SHORT)).alias("short"),
    )


def expressions(urls: DataFrame, labels: int, slashes: int) -> DataFrame:
    """Rows ``_row``, ``path``, ``suffix``, ``short``: each host suffix with each path prefix, up to some depths."""
    hosts = F.sequence(F.lit(1), F.least(_count(F.col("host"), ".") + 1, F.lit(labels)))
    paths = F.sequence(F.lit(0), F.least(_count(F.col("path"), "/"), F.lit(slashes)))
    spread = urls.withColumn("_labels", F.explode(hosts)).withColumn("_slashes", F.explode(paths))
    suffix = _suffix(F.col("host"), F.col("_labels"))
    short = F.left(_digest(suffix, _prefix(F.col("path"), F.col("_slashes"))), F.lit(SHORT))
    return spread.select("_row", "path", suffix.alias("suffix"), short.alias("short"))


def _met(found: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """Expressions and rules with equal short hashes."""
    if small:
        return found.join(F.broadcast(rules), "short")  # counted by the caller
    total = found.count()
    hot = found.groupBy("short").count().where(F.col("count") > max(1, total // HOT_SHARE)).select("short", F.lit(SALTS).alias("_n"))
    hot = staged(hot, "hot")
    many = lambda side: side.join(F.broadcast(hot), "short", "left")  # noqa: E731  at most HOT_SHARE rows
    salt = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64("_row"), F.lit(SALTS))).cast("int")
    left = many(found).withColumn("_salt", salt).drop("_n")
    right = many(rules).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_n", F.lit(1)) - 1))).drop("_n")
    return left.join(right.hint("merge"), ["short", "_salt"])


def judge(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """For each row: key, ``host``, ``path``, ``rule`` (host and path of the rule that decides, or null), ``verdict``.

    ``rules`` has the columns ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).
    """
    ready = staged(prepared(rules), "rules")
    n, size, labels, slashes = ready.agg(
        F.count("*"),
        F.coalesce(F.sum(F.octet_length("rule_host") + F.octet_length("rule_path")), F.lit(0)),
        F.coalesce(F.max("labels"), F.lit(1)),
        F.coalesce(F.max("slashes"), F.lit(0)),
    ).first()
    numbered = pages.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(F.col(key).alias("key")).alias("_page"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    stored = staged(numbered, "urls")
    found = expressions(stored, labels, slashes)
    met = _met(found, ready.drop("labels", "slashes"), n <= broadcast_rules and size <= BROADCAST_BYTES)
    own = _digest(F.col("suffix"), F.substr(F.col("path"), F.lit(1), F.length("rule_path")))
    fits = met.where((own == F.col("digest")) & F.startswith("path", "rule_path"))
    best = fits.select(
        "_row",
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("length"),
            F.length("rule_host").alias("host_length"),
            "rule_verdict",
            F.concat("rule_host", "rule_path").alias("rule"),
        ).alias("_best"),
    )
    decided = best.groupBy("_row").agg(F.max("_best").alias("_best"))
    return stored.join(decided, "_row", "left").select(
        F.col("_page.key").alias(key),
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.rule_verdict", F.lit(default)).alias("verdict"),
    )
