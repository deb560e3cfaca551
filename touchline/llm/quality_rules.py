"""Quality rules by weak supervision: rules vote or abstain, their accuracies are estimated, documents get a posterior.

Each rule looks at statistics of the whole text and votes good (1), poor (-1) or abstains (0). Rules that see one kind
of poor text abstain on all others, since not to see a fault is no praise. No rule is trusted alone: the model says that
a rule that votes is right with its own accuracy, that rules err independently given the truth, and that abstaining
tells nothing. Good and poor are equally likely beforehand, so that the many good documents of a corpus do not outvote a
rule that sees a rare fault. Accuracies are estimated by expectation maximisation, without labels, from how often each
pattern of votes occurs. Patterns are few (3 ** rules at most), so
their counts are all that comes to the driver, and every document counts. A document is kept if its posterior
probability of being good reaches ``KEEP`` and the base rules do not fail it.

All statistics are column expressions: no Python in any task, and no shuffle of words; only vote patterns are grouped.

Null texts count as empty: no words, so the base fails. Texts of any length are read whole; repeated words are found
by sorting a text's windows. Repeated rows get equal results; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import SPACES, staged

#: Fixed values of the contract.
SYMBOLS = "[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 50, 50, 3

#: Fewer different words than this power of the number of words are few: 25 of 100, 388 of 5,000, 16,000 of a million.
#: Vocabularies of prose grow about with the square root of its length, from some thirty at a hundred words upwards.
VOCABULARY = 0.7
KEEP = 0.5
#: A rule's accuracy before the first step, which counts as ``PRIOR`` texts already seen.
FIRST_ACCURACY, PRIOR = 0.9, 10
#: Bounds of the accuracies: a rule is better than a coin, and never sure.
LEAST_ACCURACY, MOST_ACCURACY = 0.55, 0.999
_STEPS, _CLOSE = 200, 1e-9


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The contract's statistics per row, and three more that rules look at."""
    value = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(value, SPACES), lambda word: word != "")
    lines = F.filter(F.split(value, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    read = docs.select(key, value.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    # Windows in order of their words, then place: equal ones stand together.
    number = F.size("_words")
    window = lambda at: F.concat_ws(" ", F.slice("_words", at + 1, WINDOW))
    windows = F.when(
        number >= WINDOW,
        F.sort_array(
            F.transform(F.sequence(F.lit(0), number - WINDOW), lambda at: F.struct(window(at).alias("w"), at.alias("at")))
        ),
    ).otherwise(F.array().cast("array<struct<w:string,at:int>>"))
    sorted_windows = read.select(
        key,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_different"),
        F.size(F.filter("_words", lambda word: word.rlike(r"\p{L}"))).cast("long").alias("n_lettered"),
        F.size(F.filter("_words", lambda word: word.rlike(r"\p{Lu}\p{Lu}"))).cast("long").alias("n_capital"),
        windows.alias("_windows"),
    )
    last = F.size("_windows") - 1
    # 0-based places of windows that equal the one before or after them, in order of place.
    repeated = F.when(
        last >= 1,
        F.sort_array(
            F.filter(
                F.transform(
                    "_windows",
                    lambda one, at: F.when(
                        ((at > 0) & (F.get("_windows", at - 1)["w"] == one["w"]))
                        | ((at < last) & (F.get("_windows", at + 1)["w"] == one["w"])),
                        one["at"],
                    ),
                ),
                lambda place: place.isNotNull(),
            )
        ),
    ).otherwise(F.array().cast("array<int>"))
    marked = sorted_windows.withColumn("_repeated", repeated).drop("_windows")
    # Each window covers WINDOW words, less what the next one covers too.
    covered = F.aggregate(
        F.transform(
            "_repeated",
            lambda place, at: F.when(
                at < F.size("_repeated") - 1, F.least(F.lit(WINDOW), F.get("_repeated", at + 1) - place)
            ).otherwise(F.lit(WINDOW)),
        ),
        F.lit(0).cast("long"),
        lambda total, words: total + words,
    )
    return marked.withColumn("n_repeat_words", covered).drop("_repeated")


def _share(part: str, of: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(of), F.lit(0)), F.lit(0.0))


def rules() -> dict[str, Column]:
    """The rules' votes over the columns of ``statistics``."""
    mean = _share("word_chars", "n_words")
    symbols, repeated = _share("n_symbols", "n_words"), _share("n_repeat_words", "n_words")
    lines = _share("n_dup_lines", "n_lines")
    lettered, capital = _share("n_lettered", "n_words"), _share("n_capital", "n_words")
    poor = {
        "length": F.col("n_words") < 20,
        "word_length": (mean < 3) | (mean > 10),
        "symbols": symbols > 0.1,
        "repeated_words": repeated > 0.4,
        "repeated_lines": (lines > 0.3) & (F.col("n_dup_lines") >= 3),
        "few_different_words": F.col("n_different") < F.pow(F.col("n_words"), F.lit(VOCABULARY)),
        "lettered_words": lettered < 0.7,
        "capitals": capital > 0.5,
    }
    prose = (symbols <= 0.02) & (repeated <= 0.2) & (lines <= 0.1) & (lettered >= 0.85) & (capital <= 0.2) & (mean > 3)
    return {name: F.when(test, -1).otherwise(0) for name, test in poor.items()} | {
        "prose": F.when(prose, 1).otherwise(0)
    }


@dataclass
class Accuracies:
    """Each rule's chance to be right when it votes."""

    accuracy: list[float]

    def evidence(self, rule: int) -> float:
        """What a vote for good adds to the log odds of good; a vote for poor takes as much away."""
        return math.log(self.accuracy[rule] / (1 - self.accuracy[rule]))

    def log_odds(self, votes: list[int]) -> float:
        return sum(vote * self.evidence(rule) for rule, vote in enumerate(votes))


def estimate(patterns: list[tuple[list[int], int]], number: int) -> Accuracies:
    """Expectation maximisation over patterns of votes and their counts."""
    model = Accuracies([FIRST_ACCURACY] * number)
    for _ in range(_STEPS):
        voted, right = [float(PRIOR)] * number, [PRIOR * FIRST_ACCURACY] * number
        for votes, count in patterns:
            chance = 1 / (1 + math.exp(-model.log_odds(votes)))
            for rule, vote in enumerate(votes):
                if vote:
                    voted[rule] += count
                    right[rule] += count * (chance if vote > 0 else 1 - chance)
        accuracy = [min(MOST_ACCURACY, max(LEAST_ACCURACY, a / b)) for a, b in zip(right, voted, strict=True)]
        before, model = model, Accuracies(accuracy)
        if max(abs(new - old) for new, old in zip(model.accuracy, before.accuracy, strict=True)) < _CLOSE:
            break
    return model


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row the statistics, ``base_failed``, the ``posterior`` of being good, and ``kept``."""
    counted = statistics(docs, key, text)
    votes = rules()
    measured = staged(
        counted.select("*", *[vote.cast("int").alias(f"vote_{name}") for name, vote in votes.items()]), "rules"
    )
    columns = [f"vote_{name}" for name in votes]
    patterns = [([row[name] for name in columns], row["n"]) for row in
                measured.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(*columns).collect()]
    model = estimate(patterns, len(columns))
    weight = F.lit(0.0)
    for rule, name in enumerate(columns):
        weight = weight + F.col(name) * F.lit(model.evidence(rule))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    posterior = 1 / (1 + F.exp(-weight))
    return measured.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (posterior >= KEEP)).alias("kept"),
        posterior.alias("posterior"),
        *columns,
    )
