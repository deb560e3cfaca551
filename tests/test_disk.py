"""What a run leaves on the disks, and what it holds there at once."""

import time
from datetime import datetime, timezone
from pathlib import Path

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

import __spark_entry__ as entry
from touchline.operators.quality import QualityError
from touchline.plans import pipeline, silver
from touchline.session import swept_session
from touchline.sources.bronze import load_dates, read_bronze
from touchline.sources.lake import Lake
from touchline.sources.tables import gathered, read_table, write_table


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    return {files.apply(at).getName() for at in range(files.size()) if files.apply(at).getName().startswith("shuffle_")}


def soon(condition):
    """Shuffle files are deleted in the background."""
    for _ in range(50):
        if condition():
            return True
        time.sleep(0.1)
    return False


def files_below(folder):
    return [path for path in Path(folder).rglob("*") if path.is_file() and not path.name.startswith(("_", "."))]


@pytest.mark.parametrize("source", ["goals", "cards", "match_statistics"])
def test_a_step_leaves_only_its_table_and_writes_it_once(spark, raw, monkeypatch, source):
    """Before, shuffle files stayed, the files that were landed too, and the staged table was written again to publish it."""
    monkeypatch.setattr(entry.Tables, "raw", lambda self, name: raw[name].where("_load_date > '2024-01-01'"))
    lake, _ = entry._landed(spark, SF, "matches", source)
    work = Path(lake.root).parent
    assert not files_below(work / "inbox") and len(files_below(lake.raw_source(source))) > 0
    pipeline.build_silver_matches(spark, lake)
    rows, before, written = raw[source].count(), shuffle_files(spark), []
    monkeypatch.setattr(pipeline, "write_table", lambda frame, path, *more, **named: written.append(path) or write_table(frame, path, *more, **named))
    step = pipeline.SILVER_STEPS[source]
    if source == "match_statistics":
        with pytest.raises(QualityError):
            step(spark, lake)
    else:
        assert step(spark, lake).metrics["rows"] == rows
        assert len(files_below(lake.silver_table(source))) > 0
    assert [Path(path).name for path in written] == [f"silver_{source}_rows", f"silver_{source}"]
    assert not any(Path(path).exists() for path in written)
    assert soon(lambda: shuffle_files(spark) <= before)


def test_identifiers_are_made_after_the_rows_are_gathered(raw):
    matches = silver.silver_matches(raw["matches"].where("_load_date > '2024-01-01'"))
    for table, derived in (
        (silver.silver_matches(raw["matches"], gathered), ("total_goals", "match_datetime")),
        (silver.silver_goals(raw["goals"], matches, arrange=gathered), ("sha2(", "minute_bucket", "minute_base")),
        (silver.silver_cards(raw["cards"], matches, gathered), ("sha2(", "minute_bucket", "minute_base")),
        (silver.silver_match_statistics(raw["match_statistics"], matches, gathered), ("shot_accuracy",)),
    ):
        plan = table._jdf.queryExecution().optimizedPlan().toString()
        above, below = plan.split("RebalancePartitions", 1)
        carried = below.splitlines()[1]
        assert "Project" in above and not any(name in carried for name in derived), carried


def test_swept_sessions_delete_shuffle_files_and_are_set_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, files = spark.conf.get(key, None), shuffle_files(spark)
    with swept_session(spark):
        assert spark.conf.get(key) == "true"
        frame = spark.range(1000).repartition(7, F.col("id") % 13)
        assert frame.groupBy((F.col("id") % 5).alias("k")).count().count() == 5
        assert soon(lambda: shuffle_files(spark) <= files)
        # A frame that is run again makes them again.
        assert len(frame.collect()) == len(frame.collect()) == 1000
    assert spark.conf.get(key, None) == before


def test_a_table_is_moved_to_its_place_or_copied_to_another_store(spark, tmp_path, monkeypatch):
    old, new, place = (str(tmp_path / name) for name in ("old", "new", "deep/place"))
    kinds = "v int, season int"
    write_table(spark.createDataFrame([(1, 2020), (2, 2021)], kinds), place)
    for path, row in ((old, (3, 2021)), (new, (4, None))):
        write_table(spark.createDataFrame([row], kinds), path)
    names = {file.name for file in files_below(old)}
    assert pipeline._publish(spark, read_table(spark, old), place, False, old) is None
    assert {file.name for file in files_below(place)} == names and not Path(old).exists()
    assert values(read_table(spark, place), "v", "season") == [(3, 2021)]
    monkeypatch.setattr(pipeline, "move_path", lambda *_: False)
    pipeline._publish(spark, read_table(spark, new), place, False, new)
    assert values(read_table(spark, place), "v", "season") == [(4, None)] and Path(new).exists()


def test_identifiers_take_half_their_text(spark, tmp_path):
    """A digest of 64 hexadecimal digits holds 32 bytes; before, it was stored in some 64."""
    path = str(tmp_path / "t")
    rows = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("card_id"), F.lit(2020).alias("season"))
    write_table(rows.coalesce(1), path)
    assert sum(file.stat().st_size for file in files_below(path)) < 20_000 * 45


def test_files_of_two_landings_go_and_both_loads_stay(spark, tmp_path):
    """Before, the second landing found the files of the first still there."""
    lake = Lake(str(tmp_path / "lake"))
    rows = spark.createDataFrame([("1", "a", "x", "2020"), (None, " b", "x", "2020")], "ID string, t string, _source_file string, _load_date string")
    for day in (2, 3):
        inbox = str(tmp_path / f"inbox-{day}")
        entry._land_rows(spark, lake, "matches", rows, inbox, datetime(2024, 1, day, tzinfo=timezone.utc))
        assert not Path(inbox).exists()
        assert sorted(values(read_bronze(spark, lake, "matches"), "ID", "t", "_load_date"), key=str) == sorted(
            [("1", "a", f"2024-01-0{day}"), (None, " b", f"2024-01-0{day}")], key=str
        )
    assert load_dates(spark, lake, "matches") == ["2024-01-02", "2024-01-03"]
