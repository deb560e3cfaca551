"""Quality rules, source mixing and chat formatting; queries with SQL against their SQL."""

import collections
import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, WORD, awkward, nothing
from pyspark.sql import functions as F

import __spark_entry__ as contract
from touchline.llm import chat, quality_rules, queries, source_mix
from verification.compare import SAME_TYPES, normalised, open_oracle


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    frame = queries.queries()[name](spark, SF)
    wanted = open_oracle(SF).execute(queries.oracle_sql()[name])
    assert {c: SAME_TYPES[kind] for c, kind in frame.dtypes} == {c[0]: str(c[1]) for c in wanted.description}
    assert normalised(frame.toPandas()) == normalised(wanted.df())


def test_all_operators_and_the_pipeline_are_registered():
    names = [name for name in contract.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in contract.queries()


def plain_statistics(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = [tuple(words[at : at + 3]) for at in range(len(words) - 2)]
    times = collections.Counter(windows)
    repeated = {at + step for at, window in enumerate(windows) if times[window] > 1 for step in range(3)}
    symbols = sum(character in "#*$%&|<>" for character in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_rules_statistics(spark):
    for docs in (awkward(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        found = quality_rules.quality_rules(docs).collect()
        expected = sorted((str(row["doc_id"]), *plain_statistics(row["text"])) for row in docs.collect())
        assert sorted((str(row[0]), *row[1:6]) for row in found) == expected
        for row in found:
            assert row["base_failed"] == (row["n_words"] < 50 or 100 * row["n_repeat_words"] > 50 * row["n_words"])
            assert row["kept"] == (not row["base_failed"] and row["posterior"] >= 0.5)
    assert quality_rules.quality_rules(nothing(spark)).count() == 0


def test_rules_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    known = queries.op1_quality_rules(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    clean = known[(known["quality"] == 1) & ~known["base_failed"]]
    assert clean["kept"].mean() > 0.99
    assert known[known["quality"] == 0]["kept"].mean() < 0.05


def plain_verdicts(rows, votes):
    """EM by plain loops over documents, not patterns; which are kept."""
    accuracy = [quality_rules.FIRST_ACCURACY] * len(votes[0])
    logit = lambda own: sum(vote * math.log(a / (1 - a)) for vote, a in zip(own, accuracy, strict=True))
    for _ in range(200):
        chances = [1 / (1 + math.exp(-logit(own))) for own in votes]
        new = []
        for rule in range(len(accuracy)):
            mine = [(own[rule], chance) for own, chance in zip(votes, chances, strict=True) if own[rule]]
            right = quality_rules.PRIOR * quality_rules.FIRST_ACCURACY + sum(c if vote > 0 else 1 - c for vote, c in mine)
            share = right / (quality_rules.PRIOR + len(mine))
            new.append(min(quality_rules.MOST_ACCURACY, max(quality_rules.LEAST_ACCURACY, share)))
        accuracy[:] = new
    return [not row["base_failed"] and logit(own) >= 0 for row, own in zip(rows, votes, strict=True)]


def test_verdicts_equal_a_plain_estimation(spark):
    rows = quality_rules.quality_rules(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    names = [name for name in rows[0].asDict() if name.startswith("vote_")]
    assert len(names) == 9 and 0 < sum(row["kept"] for row in rows) < len(rows)
    assert [row["kept"] for row in rows] == plain_verdicts(rows, [[row[name] for name in names] for row in rows])


def test_few_different_words_count_at_every_length(spark):
    seeded = random.Random(1)
    few = [f"w{n}a" for n in range(100)]
    texts = [" ".join(seeded.choice(few) for _ in range(n)) for n in (1000, 4999, 5000, 20_000)]
    texts += [" ".join(f"w{seeded.randrange(n)}a" for _ in range(n)) for n in (50, 1000, 5000, 20_000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    votes = quality_rules.quality_rules(docs).orderBy("doc_id").select("vote_few_different_words").collect()
    assert [row[0] for row in votes] == [-1] * 4 + [0] * 4


def test_estimation_finds_the_reliable_rule():
    # The first two agree; the third says the opposite of them half of the time.
    patterns = [([1, 1, 1], 40), ([1, 1, -1], 40), ([-1, -1, 1], 20), ([-1, -1, -1], 20), ([0, 0, 0], 5)]
    model = quality_rules.estimate(patterns, 3)
    assert model.accuracy[0] > 0.95 and model.accuracy[1] > 0.95 and model.accuracy[2] < 0.65
    assert quality_rules.estimate([], 2).accuracy == [quality_rules.FIRST_ACCURACY] * 2


LEVELS = {"lang": {"en": 3, "de": 0}, "source": {"src1": 2}}


def test_awkward_mixture(spark):
    docs = awkward(spark).drop("n_tokens")
    mixed = source_mix.mix(docs, LEVELS, share=(1, 2))
    rows = mixed.collect()
    assert len(rows) == docs.count() and mixed.columns == ["doc_id", "lang", "source", "n_tokens", "copies"]
    assert all(row["copies"] == 0 for row in rows if row["lang"] == "de")
    total = sum(row["n_tokens"] for row in rows)
    assert sum(row["n_tokens"] * row["copies"] for row in rows) <= total // 2
    assert source_mix.mix(nothing(spark), LEVELS).count() == 0


def test_mixture_keeps_columns_of_any_name(spark):
    docs = source_mix.with_domain(awkward(spark)).withColumns({name: F.lit(name) for name in ("copies", "_rest", "_order", "tokens", "budget", "_kept")})
    keep = ["n_tokens", "copies", "_row", "score", "_rest", "_order", "tokens", "budget", "_kept", "lang"]
    mixed = source_mix.mix(docs, source_mix.LEVELS, keep=keep)
    plain = source_mix.mix(docs.drop(*keep[:9]), source_mix.LEVELS)
    assert mixed.columns == ["doc_id", "kept_n_tokens", "kept_copies", *keep[2:9], "domain", "lang", "source", "n_tokens", "copies"]
    assert sorted(map(str, mixed.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert {tuple(row) for row in mixed.select("kept_n_tokens", "kept_copies", "budget", "_kept").collect()} == {("4", "copies", "budget", "_kept")}
    assert source_mix.mix(docs.limit(0), source_mix.LEVELS, keep=keep).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    leaves = spark.createDataFrame(
        [("a", "x", 10), ("a", "y", 1000), ("b", "z", 1000), ("c", None, 5)], "domain string, lang string, tokens long"
    )
    given = source_mix.budgets(leaves, {"domain": {}, "lang": {}}, source_mix.F.lit(305), 1)
    # c takes 5; a and b get 150 each; in a, x takes 10 and y the rest of a's part.
    assert {(r["domain"], r["lang"]): r["budget"] for r in given.collect()} == {
        ("a", "x"): 10, ("a", "y"): 140, ("b", "z"): 150, ("c", None): 5}


def test_prefix_does_not_depend_on_ranges(spark, monkeypatch):
    docs = source_mix.with_domain(spark.read.parquet(f"{SF}/documents.parquet"))
    one = sorted(map(tuple, source_mix.mix(docs, source_mix.LEVELS).collect()))
    monkeypatch.setattr(source_mix, "RANGE_ROWS", 2)
    monkeypatch.setattr(source_mix, "BLOCK_RANGES", 3)
    assert sorted(map(tuple, source_mix.mix(docs, source_mix.LEVELS).collect())) == one


def rendered(renderer, turns):
    return [span for one in turns for span in renderer.add(*one)] + renderer.check()


turn = st.tuples(st.text(alphabet="ab:#\\</turn>\n ", max_size=8), st.text(alphabet="a#\\</turn>\n :é", max_size=30))


@settings(max_examples=200, deadline=None)
@given(turns=st.lists(turn, max_size=6))
def test_template_is_reversible(turns):
    formatted = chat.marked_turns(turns)
    assert chat.read_turns(formatted) == turns
    spans = rendered(chat.Renderer(chat.marked_turns, window=2), turns)
    assert "".join(span.added for span in spans) == formatted and not any(span.rewrites for span in spans)
    assert [chat.unescape(span.added[span.start : span.end]) for span in spans] == [text for _, text in turns]


def test_rewriting_templates_are_found():
    def numbered(turns):
        return f"{len(turns)} turns\n" + "".join(f"{role}|{text}|" for role, text in turns)

    def appended(turns):
        return "".join(f"<{role}>{text}" for role, text in turns)

    assert [rendered(chat.Renderer(one), [("u", "a")])[0].rewrites for one in (numbered, appended)] == [True, False]


def counting_templates():
    """Nested, so that workers, which do not import tests, get them by value."""

    def by_number(turns):
        return "".join(f"{number}. {role}: {text}\n" for number, (role, text) in enumerate(turns))

    def by_turns(turns):
        assert all(role == ("user", "assistant")[number % 2] for number, (role, _) in enumerate(turns))
        return "".join(f"<{role}>{text}" for role, text in turns)

    return [by_number, by_turns]


def without_old_thoughts(turns):
    """Thoughts are shown while fewer than 40 turns follow."""
    return "".join(f"{role}|{text}|" for at, (role, text) in enumerate(turns) if role != "thought" or len(turns) - at <= 40)


@pytest.mark.parametrize("template", counting_templates())
def test_whole_prefixes_of_long_conversations(spark, template):
    turns = [(("user", "assistant")[number % 2], f"text {number}") for number in range(90)]
    spans = rendered(chat.Renderer(template), turns)
    assert "".join(span.added for span in spans) == template(turns) and not any(span.rewrites for span in spans)
    assert [span.added[span.start : span.end] for span in spans] == [text for _, text in turns]
    rows = spark.createDataFrame([(1, at, *one) for at, one in enumerate(turns)], "conv_id long, turn long, role string, text string")
    parts = chat.format_turns(rows, template).orderBy("position").collect()
    assert "".join(row["formatted"] for row in parts) == template(turns) and not any(row["rewrites"] for row in parts)


def test_rewriting_far_back_is_found():
    turns = [("thought" if number == 5 else "user", f"t{number}") for number in range(60)]
    spans = rendered(chat.Renderer(without_old_thoughts), turns)
    assert [number for number, span in enumerate(spans) if span.rewrites] == [45]


def declared_wrongly():
    """Declared stateless, but from turn 41 on the end is marked, which rewrites it with each turn; and two that only look
    back: at the number of turns, and further than the window."""

    def marks_end(turns):
        return "".join(f"{role}|{text}|" for role, text in turns) + ("<end>" if len(turns) > 40 else "")

    def numbers(turns):
        return "".join(f"{at}. {role}: {text}\n" for at, (role, text) in enumerate(turns))

    return [chat.stateless(one) for one in (marks_end, numbers, lambda turns: without_old_thoughts(turns))]


@pytest.mark.parametrize("number", range(3))
@pytest.mark.parametrize("length", [3, 34, 41, 42, 64, 65, 150])
def test_a_wrong_declaration_is_found(number, length):
    template = declared_wrongly()[number]
    turns = [("thought" if at == 5 else "user", f"t{at}") for at in range(length)]
    assert rendered(chat.Renderer(template), turns) == rendered(chat.Renderer(lambda turns: template(turns)), turns)


def test_a_wrong_declaration_is_reported(spark):
    rows = spark.createDataFrame([(1, at, "user", f"t{at}") for at in range(100)], "conv_id long, turn long, role string, text string")
    parts = chat.format_turns(rows, declared_wrongly()[0]).orderBy("position").collect()
    assert [row["position"] for row in parts if row["rewrites"]] == list(range(41, 100))
    assert [row["position"] for row in parts] == list(range(100))


def test_a_stateless_template_is_rendered_whole_a_few_times_only():
    calls = []

    @chat.stateless
    def counted(turns):
        calls.append(len(turns))
        return chat.marked_turns(turns)

    turns = [("user", f"t{at}") for at in range(5000)]
    assert "".join(span.added for span in rendered(chat.Renderer(counted), turns)) == chat.marked_turns(turns)
    assert sum(calls) < 5000 * (3 * chat.WINDOW + 10)


def test_only_stateless_templates_allow_a_window():
    with pytest.raises(ValueError, match="stateless"):
        chat.Renderer(counting_templates()[0], window=8)
    assert chat.Renderer(chat.marked_turns, window=2).window == 2
    assert chat.Renderer(chat.marked_turns).window == chat.WINDOW and chat.Renderer(counting_templates()[0]).window is None


def test_awkward_conversations(spark):
    rows = [(1, 2, "assistant", None, "x"), (1, 1, "user", "hi", "x"), (1, 1, None, "hi", "x"), (None, None, "assistant", "y", "z"),
            (3, 1, "assistant", "w" * 50_000, "q")]
    rows += [(4, number, "assistant" if number % 2 else "user", f"t{number}", "q") for number in range(90)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns string")
    found = {row["conv_id"]: row for row in chat.conversation_digests(turns).collect()}
    assert {key: row["n_turns"] for key, row in found.items()} == {1: 3, None: 1, 3: 1, 4: 90}
    assert found[3]["loss_chars"] == 50_000 and found[1]["loss_chars"] == 0 and not found[4]["rewrites_history"]
    parts = chat.format_turns(turns).where("conv_id = 4").orderBy("position").collect()
    assert chat.read_turns("".join(row["formatted"] for row in parts)) == [(r[2], r[3]) for r in rows[5:]]
    assert [row["formatted"][row["loss_start"] : row["loss_end"]] for row in parts if row["role"] == "assistant"] == [
        f"t{number}" for number in range(1, 90, 2)
    ]
    assert chat.conversation_digests(turns.limit(0)).count() == 0
