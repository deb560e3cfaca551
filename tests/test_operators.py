import pytest
from conftest import values
from pyspark.sql import functions as F

from touchline.operators.guards import require_rows
from touchline.operators.integrity import duplicate_groups, key_report, orphans, reconcile_counts
from touchline.operators.layout import Field, fold_name, project, rename_resolved, resolve_column
from touchline.operators.loads import choose_load_date, select_load
from touchline.operators.metrics import run_metrics
from touchline.operators.numbering import measure_hot_buckets, number_occurrences


@pytest.mark.parametrize(
    "header,folded",
    [("Cartão", "cartao"), ("PARTIDA_ID", "partida_id"), ("tipo-de-gol", "tipo_de_gol"), (" a b ", "a_b")],
)
def test_fold_name(header, folded):
    assert fold_name(header) == folded


def test_resolve_column():
    assert resolve_column(["x", "Cartão"], ["card_type", "cartao"]) == "Cartão"
    assert resolve_column(["b", "a"], ["a", "b"]) == "a"
    assert resolve_column(["Cartao", "cartão"], ["cartao"]) == "cartão"
    with pytest.raises(KeyError, match="nope.*x"):
        resolve_column(["x"], ["nope"])


def test_project_reads_odd_headers(spark):
    frame = spark.createDataFrame([("1", "z")], "`posse de bola` string, `a.b` string")
    fields = [
        Field("possession", ("posse_de_bola",), lambda c: c.try_cast("int")),
        Field("other", ("a.b",), F.upper),
    ]
    assert values(project(frame, fields, {"extra": F.lit(5)}), "*") == [(1, "Z", 5)]
    assert rename_resolved(frame, fields).columns == ["possession", "other"]


def test_load_choice(spark):
    frame = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "")], "v string, _load_date string")
    assert values(select_load(frame), "v") == [("b",)]
    assert values(select_load(frame, "2024-01-01"), "v") == [("a",)]
    with pytest.raises(ValueError, match="2023"):
        select_load(frame, "2023-01-01")
    with pytest.raises(ValueError, match="no load date"):
        select_load(frame.filter("v = 'c'"))
    with pytest.raises(ValueError):
        select_load(frame.limit(0))
    assert choose_load_date(["2024-01-01", "2024-02-01"]) == "2024-02-01"


def test_require_rows(spark):
    assert require_rows(spark.range(1), "x").count() == 1
    with pytest.raises(ValueError, match="no rows in x"):
        require_rows(spark.range(0), "x")


KEYS, ORDER = ["k", "t"], ["f"]


def occurrences(spark, rows, hot_above):
    frame = spark.createDataFrame(rows, "k int, t string, f string, p string")
    hot = measure_hot_buckets(frame, ["k"], rows_per_task=hot_above)
    parts = number_occurrences(frame, KEYS, ORDER, "n", hot, rows_per_task=hot_above)
    found = [tuple(row) for part in parts for row in part.collect()]
    return hot, parts, found


def check_numbers(rows, found):
    assert sorted(map(str, (r[:4] for r in found))) == sorted(map(str, rows))
    groups = {}
    for k, t, f, _, n in found:
        groups.setdefault((k, t), []).append((n, f))
    for members in groups.values():
        members.sort()
        assert [n for n, _ in members] == list(range(1, len(members) + 1))
        files = [f or "" for _, f in members]
        assert files == sorted(files)


# One group holds most rows: exact copies, copies over several files, and rows that differ in another column.
SKEWED = (
    [(1, "a", "f1", "same")] * 40
    + [(1, "a", "f2", "same")] * 7
    + [(1, "a", f"f{i % 3}", f"p{i}") for i in range(30)]
    + [(None, None, None, None)] * 25
    + [(None, None, "f1", f"q{i}") for i in range(9)]
    + [(i, "b", "f1", None) for i in range(20)]
    + [(5, "b", "f1", "x"), (5, "b", "f0", "y")]
)


def test_numbers_without_hot_groups(spark):
    hot, parts, found = occurrences(spark, SKEWED, hot_above=1000)
    assert hot.buckets.isEmpty() and parts[1].isEmpty()
    check_numbers(SKEWED, found)


@pytest.mark.parametrize("limit", [3, 10, 30])
def test_numbers_with_hot_groups_are_the_same_set(spark, limit):
    hot, parts, found = occurrences(spark, SKEWED, hot_above=limit)
    assert not hot.buckets.isEmpty() and parts[1].count() > 0
    check_numbers(SKEWED, found)


def test_ties_are_broken_alike_on_every_run(spark):
    _, _, first = occurrences(spark, SKEWED, hot_above=1000)
    _, _, again = occurrences(spark, list(reversed(SKEWED)), hot_above=1000)
    assert sorted(map(str, first)) == sorted(map(str, again))


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        return action(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("limit,crowded", [(1000, False), (10, True)])
def test_numbering_runs_nothing_before_the_action_and_no_pieces_without_need(spark, tmp_path, limit, crowded):
    spark.createDataFrame(SKEWED, "k int, t string, f string, p string").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))

    def plan():
        hot = measure_hot_buckets(rows, ["k"], rows_per_task=limit)
        parts = number_occurrences(rows, KEYS, ORDER, "n", hot, rows_per_task=limit)
        return parts[0].unionByName(parts[1])

    numbered, jobs = jobs_of(spark, f"numbering-{limit}", plan)
    assert jobs == 0
    found = numbered.collect()
    check_numbers(SKEWED, [tuple(row) for row in found])
    final = numbered._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ("Generate explode" in final) == crowded and "Window" in final
    assert ("Union" in final) == crowded


@pytest.mark.parametrize("huge", [0, 40])
def test_only_groups_too_large_for_a_task_are_cut(spark, tmp_path, huge):
    """A hot bucket of small groups is shuffled once; before, every row of it was packed, spread and expanded."""
    rows = [(1, f"t{i % 30}", f"f{i % 2}", f"p{i % 4}") for i in range(90)] + [(None, None, None, f"q{i}") for i in range(9)]
    rows += [(None, f"u{i}", "f1", None) for i in range(20)] + [(1, "t0", "f1", "same")] * huge
    spark.createDataFrame(rows, "k int, t string, f string, p string").write.parquet(str(tmp_path / "rows"))
    frame = spark.read.parquet(str(tmp_path / "rows"))
    hot = measure_hot_buckets(frame, ["k"], rows_per_task=10)
    plain, crowded = number_occurrences(frame, KEYS, ORDER, "n", hot, rows_per_task=10)
    assert plain.isEmpty()
    check_numbers(rows, [tuple(row) for row in crowded.collect()])
    final = crowded._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert ("Generate explode" in final) == bool(huge) and "hashpartitioning(k#" in final
    whole = occurrences(spark, rows, 1000)[2]
    assert sorted(map(str, whole)) == sorted(str(tuple(row)) for row in crowded.collect())


def test_derived_keys_are_not_shuffled(spark):
    frame = spark.createDataFrame([(1, "a ", "f", "p"), (1, "a", "f", "q"), (1, "b", "f", "q")], "k int, t_raw string, f string, p string")
    for limit in (1000, 1, 2):
        hot = measure_hot_buckets(frame, ["k"], rows_per_task=limit)
        parts = number_occurrences(
            frame, KEYS, ORDER, "n", hot, limit, derive=lambda rows: rows.withColumn("t", F.trim("t_raw"))
        )
        found = [row for part in parts for row in part.collect()]
        assert sorted((row["t"], row["n"]) for row in found) == [("a", 1), ("a", 2), ("b", 1)]
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "trim(t_raw" not in plan.split("RepartitionByExpression")[1]


@pytest.mark.parametrize("limit", [4, 25])
def test_both_routes_give_every_row_the_same_number(spark, limit):
    whole, cut = occurrences(spark, SKEWED, 1000)[2], occurrences(spark, SKEWED, limit)[2]
    assert sorted(map(str, whole)) == sorted(map(str, cut))


def test_hot_buckets_must_cover_groups(spark):
    frame = spark.createDataFrame([(1, "a", "f", "p")], "k int, t string, f string, p string")
    hot = measure_hot_buckets(frame, ["p"])
    with pytest.raises(ValueError):
        number_occurrences(frame, KEYS, ORDER, "n", hot)


def test_keys_and_references(spark):
    parent = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "id int, expected int")
    child = spark.createDataFrame([(1,), (1,), (3,), (3,), (9,), (9,), (None,)], "id int")
    assert sorted(values(duplicate_groups(child, ["id"]), "id", "count")) == [(1, 2), (3, 2), (9, 2)]
    assert values(orphans(child, parent, "id"), "*") == [(9, 2)]
    assert values(reconcile_counts(parent, child, "id", "expected", "seen"), "id", "expected", "seen") == [(3, 1, 2)]
    assert values(key_report(child, "child", ["id"]), "*") == [("child", "id", 3, 1)]
    assert values(key_report(child.limit(0), "child", ["id"]), "*") == [("child", "id", 0, 0)]


def test_run_metrics_count_null_as_a_value(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, t string")
    assert values(run_metrics(frame, {"ks": "k", "ts": "t"}), "rows", "ks", "ts") == [(3, 2, 3)]
    assert values(run_metrics(frame.limit(0), {"ks": "k"}), "rows", "ks") == [(0, 0)]
