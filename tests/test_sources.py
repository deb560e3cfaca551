import hashlib
from contextlib import contextmanager
from datetime import datetime, timezone

import pyarrow as pa
import pytest
from conftest import values
from pyspark.sql import functions as F

from touchline.plans import serving
from touchline.sources import jdbc, landing
from touchline.sources.bronze import load_date_of, load_dates, read_bronze, read_csv_text, with_lineage
from touchline.sources.lake import Lake
from touchline.session import shuffle_plan, sized_shuffles, tuned_session
from touchline.sources.storage import path_bytes, shared_folder, staging_path
from touchline.sources.tables import changed_seasons, read_table, write_quarantine, write_seasons, write_table

NOW = datetime(2024, 3, 5, 23, 30, tzinfo=timezone.utc)


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def test_bronze_reads_one_load_under_its_own_header(spark, tmp_path, lake):
    raw = tmp_path / "lake/bronze/raw/source=s"
    put(raw / "load_date=2024-01-01", "f.csv", "b,a\nB1,A1\n")
    put(raw / "load_date=2024-01-02/deeper", "f.csv", "a,b\n A2,\n")
    (raw / "other").mkdir()
    assert load_dates(spark, lake, "s") == ["2024-01-01", "2024-01-02"]
    latest = read_bronze(spark, lake, "s")
    assert values(latest, "a", "b", "_load_date") == [(" A2", None, "2024-01-02")]
    assert latest.first()["_source_file"].endswith("load_date=2024-01-02/deeper/f.csv")
    assert {kind for _, kind in latest.dtypes} == {"string"}
    assert values(read_bronze(spark, lake, "s", "2024-01-01"), "a", "b") == [("A1", "B1")]
    with pytest.raises(ValueError, match="2023-01-01"):
        read_bronze(spark, lake, "s", "2023-01-01")
    with pytest.raises(ValueError, match="no files for source t"):
        read_bronze(spark, lake, "t")


def test_bronze_refuses_an_empty_load(spark, tmp_path, lake):
    put(tmp_path / "lake/bronze/raw/source=s/load_date=2024-01-01", "f.csv", "a,b\n")
    with pytest.raises(ValueError, match="no rows"):
        read_bronze(spark, lake, "s")


def test_files_of_one_load_must_agree_on_the_header(spark, tmp_path):
    put(tmp_path / "x", "1.csv", "a,b\n1,2\n")
    put(tmp_path / "x", "2.csv", "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_text(spark, str(tmp_path / "x")).collect()


def test_lineage_from_paths(spark, tmp_path):
    put(tmp_path / "load_date=2024-01-01", "f.csv", "a\n1\n")
    frame = with_lineage(read_csv_text(spark, str(tmp_path)))
    assert values(frame, "a", "_load_date") == [("1", "2024-01-01")]
    paths = spark.createDataFrame([("x/load_date=2024-1-1/f",), ("x",)], "p string")
    assert values(paths, load_date_of(F.col("p"))) == [("",), ("",)]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-8-sig"])
def test_landing_reads_every_encoding(spark, tmp_path, lake, encoding):
    text = 'clube,"cartão, tipo"\n São Paulo ,"a,b"\nGrêmio,\n'
    path = put(tmp_path / "in", "cartões.csv", text, encoding)
    manifest = landing.land_files(spark, lake, {"cards": path}, NOW).collect()
    content = (tmp_path / "in/cartões.csv").read_bytes()
    assert len(manifest) == 1
    row = manifest[0]
    assert row["columns"] == ["clube", "cartão, tipo"] and row["column_count"] == 2
    assert (row["row_count"], row["file_size_bytes"]) == (2, len(content))
    assert row["file_sha256"] == hashlib.sha256(content).hexdigest()
    assert row["encoding"] == ("ISO-8859-1" if encoding == "latin-1" else "UTF-8")
    assert (row["source_name"], row["original_filename"], row["load_date"]) == ("cards", "cartões.csv", "2024-03-05")
    assert row["source_path"].endswith(path)
    landed = read_bronze(spark, lake, "cards")
    assert sorted(values(landed, "clube", "`cartão, tipo`")) == [(" São Paulo ", "a,b"), ("Grêmio", None)]
    assert set(values(landed, "_load_date")) == {("2024-03-05",)}


def test_landing_again_replaces_only_that_file(spark, tmp_path, lake):
    first = put(tmp_path / "in", "a.csv", "x\n1\n2\n")
    second = put(tmp_path / "in", "b.csv", "x\n3\n")
    landing.land_files(spark, lake, {"s": first}, NOW)
    landing.land_files(spark, lake, {"s": second}, NOW)
    put(tmp_path / "in", "a.csv", "x\n9\n")
    landing.land_files(spark, lake, {"s": first}, NOW)
    assert sorted(values(read_bronze(spark, lake, "s"), "x")) == [("3",), ("9",)]
    stored = spark.read.json(lake.manifest())
    assert sorted(values(stored, "original_filename", "row_count")) == [("a.csv", 1), ("b.csv", 1)]
    assert "ingested_at_utc" in stored.columns


def test_landing_a_folder_and_several_sources(spark, tmp_path, lake):
    put(tmp_path / "in/s", "a.csv", "x\n1\n2\n")
    put(tmp_path / "in/s", "b.csv", "x\n3\n")
    other = put(tmp_path / "in", "c.csv", "y,z\n1,2\n")
    manifest = landing.land_files(spark, lake, {"s": str(tmp_path / "in/s"), "t": other}, NOW)
    assert sorted(values(manifest, "source", "file", "row_count")) == [("s", "a.csv", 2), ("s", "b.csv", 1), ("t", "c.csv", 1)]
    assert sorted(values(read_bronze(spark, lake, "s"), "x")) == [("1",), ("2",), ("3",)]
    with pytest.raises(FileNotFoundError):
        landing.land_files(spark, lake, {"s": str(tmp_path / "missing.csv")}, NOW)


def test_manifest_counts_records_that_span_lines(spark, tmp_path, lake):
    path = put(tmp_path / "in", "q.csv", 'a,b\n1,"two\nlines"\n3,"say ""hi"""\n')
    plain = put(tmp_path / "in", "p.csv", "a\n1\n2\n3")
    manifest = landing.build_manifest(spark, lake, {"q": path, "p": plain}, NOW, spanning=["q"])
    assert sorted(values(manifest, "source", "row_count")) == [("p", 3), ("q", 2)]
    # A line is a record unless the caller says otherwise.
    manifest = landing.build_manifest(spark, lake, {"q": path}, NOW)
    assert values(manifest, "row_count", "spans_lines") == [(3, False)]


def test_files_tell_valid_encodings(spark, tmp_path):
    put(tmp_path / "in", "valid.csv", "a\n" + "é" * 5000)
    put(tmp_path / "in", "other file.csv", "a\n" + "é" * 5000, "latin-1")
    put(tmp_path / "in", "cut.csv", "a\n" + "x" * 50)
    (tmp_path / "in/broken.csv").write_bytes(b"a\n\xc3")
    found = values(landing.file_lines(spark, str(tmp_path / "in")).orderBy("file_path"), "valid_utf8", "records")
    assert found == [(False, 2), (True, 2), (False, 2), (True, 2)]


@contextmanager
def small_splits(spark, size="64"):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(key) for key in keys]
    for key in keys:
        spark.conf.set(key, size)
    try:
        yield
    finally:
        for key, value in zip(keys, before, strict=True):
            spark.conf.set(key, value)


@pytest.mark.parametrize(
    "content", [b"x\n" * 5000, b"x\n" * 5000 + b"y", b"\xef\xbb\xbfh\nx\nh\nh", b"\xef\xbb\xbfh\n", b"\n\n", b"a\r\nb\r\n", b"one"]
)
def test_digests_of_files_of_many_splits_and_batches(spark, tmp_path, monkeypatch, content):
    """Scans cut files every 64 bytes; the digest's scan must not, and takes few bytes at a time."""
    monkeypatch.setattr(landing, "_DIGEST_BATCH", 1000)
    monkeypatch.setattr(landing, "_MIN_SPLIT", 64)
    put(tmp_path / "in", "small.csv", "a\n")
    (tmp_path / "in/x.csv").write_bytes(content)
    with small_splits(spark):
        assert spark.read.text(str(tmp_path / "in/x.csv")).rdd.getNumPartitions() >= min(4, len(content) // 64)
        found = values(landing.file_digests(spark, str(tmp_path / "in")).orderBy("file_path"), "sha256", "header_again")
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64"
    lines = content.removeprefix(b"\xef\xbb\xbf").removesuffix(b"\n").split(b"\n")
    assert found[1] == (hashlib.sha256(content).hexdigest(), lines.count(lines[0]) - 1)
    assert found[0][0] == hashlib.sha256(b"a\n").hexdigest()


def test_a_file_that_is_cut_has_no_digest():
    batch = pa.RecordBatch.from_pydict({"n": ["f", "f"], "s": [9, 9], "v": [b"a", b"b"]})
    with pytest.raises(ValueError, match="f was not read whole"):
        list(landing._stream_digests(iter([batch])))


STRAY = 'a,b\n1,"x\n2,y\n3,z\n'


def test_a_stray_quote_swallows_no_row(spark, tmp_path, lake):
    path = put(tmp_path / "in", "g.csv", STRAY)
    [row] = landing.land_files(spark, lake, {"s": path}, NOW).collect()
    assert (row["row_count"], row["spans_lines"]) == (3, False)
    assert sorted(values(read_bronze(spark, lake, "s"), "a")) == [("1",), ("2",), ("3",)]


def test_landing_again_with_fewer_rows_leaves_none_behind(spark, tmp_path, lake):
    path = put(tmp_path / "in", "g.csv", "a,b\n1,2\n3,4\n")
    other = put(tmp_path / "in", "h.csv", "a,b\n5,6\n")
    landing.land_files(spark, lake, {"s": path}, NOW)
    landing.land_files(spark, lake, {"s": other}, NOW)
    put(tmp_path / "in", "g.csv", "a,b\n")
    landing.land_files(spark, lake, {"s": path}, NOW)
    assert values(read_bronze(spark, lake, "s"), "a", "b") == [("5", "6")]
    assert sorted(values(spark.read.json(lake.manifest()), "file", "row_count")) == [("g.csv", 0), ("h.csv", 1)]
    left = [found.name for found in (tmp_path / "lake/bronze/raw").rglob("*.txt")]
    assert len(left) == 1


def test_a_header_alone_has_no_rows(spark, tmp_path, lake):
    landing.land_files(spark, lake, {"s": put(tmp_path / "in", "g.csv", "a,b\n")}, NOW)
    assert load_dates(spark, lake, "s") == ["2024-03-05"]
    with pytest.raises(ValueError, match="no rows in source s"):
        read_bronze(spark, lake, "s")


def test_a_landing_that_fails_leaves_the_rows_before(spark, tmp_path, lake, monkeypatch):
    path = put(tmp_path / "in", "g.csv", "a\n1\n")
    landing.land_files(spark, lake, {"s": path}, NOW)
    put(tmp_path / "in", "g.csv", "a\n2\n3\n")
    with monkeypatch.context() as patched:
        patched.setattr(landing, "write_manifest", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            landing.land_files(spark, lake, {"s": path}, NOW)
    assert values(read_bronze(spark, lake, "s"), "a") == [("1",)]
    assert len(landing.drop_unnamed(spark, lake, "s", "2024-03-05")) == 1
    assert landing.drop_unnamed(spark, lake, "s", "2024-03-05") == []
    assert values(read_bronze(spark, lake, "s"), "a") == [("1",)]


def test_a_header_with_an_open_quote_is_refused_or_parsed(spark, tmp_path, lake):
    path = put(tmp_path / "in", "g.csv", '"two\nlines",b\n1,2\n3,"4\n5"\n')
    with pytest.raises(ValueError, match="quote stays open.*g.csv"):
        landing.land_files(spark, lake, {"s": path}, NOW)
    [row] = landing.land_files(spark, lake, {"s": path}, NOW, spanning=["s"]).collect()
    assert (row["columns"], row["row_count"], row["spans_lines"]) == (["two\nlines", "b"], 2, True)
    landed = read_bronze(spark, lake, "s")
    assert sorted(tuple(row)[:2] for row in landed.collect()) == [("1", "2"), ("3", "4\n5")]


def test_records_that_span_lines_are_cut_in_parallel(spark, tmp_path, lake):
    rows = [f'{n},"' + "line\n" * (n % 7) + 'end ""q"""' if n % 3 else f"{n},plain" for n in range(200)]
    rows += ['200,"' + "x\n" * 300 + '"', "201,last"]
    path = put(tmp_path / "in", "g.csv", 'a,"b\nc"\n' + "\n".join(rows) + "\n")
    direct = spark.read.option("header", True).option("multiLine", True).csv(path)
    assert direct.rdd.getNumPartitions() == 1
    with small_splits(spark):
        assert spark.read.text(path).rdd.getNumPartitions() >= 4
        manifest = landing.land_files(spark, lake, {"s": path}, NOW, spanning=["s"]).first()
    assert manifest["row_count"] == direct.count() == 202 and manifest["columns"] == direct.columns
    landed = read_bronze(spark, lake, "s").drop("_source_file", "_load_date")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, direct.collect()))


def test_every_row_can_be_traced_to_its_file(spark, tmp_path, lake):
    for name, text in (("a.csv", "x\n1\n2\n"), ("b [é].csv", "x\n3\n")):
        put(tmp_path / "in", name, text)
    manifest = landing.land_files(spark, lake, {"s": str(tmp_path / "in")}, NOW)
    traced = landing.with_file_digest(read_bronze(spark, lake, "s"), manifest, "_source_file")
    digests = {name: hashlib.sha256((tmp_path / "in" / name).read_bytes()).hexdigest() for name in ("a.csv", "b [é].csv")}
    assert sorted(values(traced, "x", "file_sha256")) == [
        ("1", digests["a.csv"]), ("2", digests["a.csv"]), ("3", digests["b [é].csv"])]


@pytest.mark.parametrize(
    ("name", "content"),
    [
        ("breaks.csv", b'a,b,c\n1,"two\nlines",x\n2,"a,""b""",c\n3,4\n'),
        ("surplus.csv", b'a,b\n1,2,3,4\n\n  \n"q ""x""",5,6\na,b\na,b\n'),
        ("latin.csv", "a,b\r\né,ü\r\nõ,\r\n".encode("latin-1")),
        ("g [1].csv", b"a,b\n1,2\n"),
        ("old mac.csv", b"a,b\r1,2\r3,4\r"),
        ("no end.csv", b"\xef\xbb\xbfa,b\n1,2\n3,\"4\""),
        ("header only plus.csv", b"a,b\n,\n"),
    ],
)
@pytest.mark.parametrize("spanning", [(), ("s",)])
def test_landing_loses_and_alters_nothing(spark, tmp_path, lake, name, content, spanning):
    path = tmp_path / "in" / name
    path.parent.mkdir()
    path.write_bytes(content)
    if spanning and name == "old mac.csv":
        with pytest.raises(ValueError, match="carriage returns"):
            landing.land_files(spark, lake, {"s": str(path)}, NOW, spanning)
        return
    manifest = landing.land_files(spark, lake, {"s": str(path)}, NOW, spanning).first()
    encoding = manifest["encoding"]
    copy = tmp_path / "direct" / "f.csv"
    copy.parent.mkdir()
    copy.write_bytes(content)
    direct = spark.read.option("header", True).option("multiLine", manifest["spans_lines"]).option("encoding", encoding)
    direct = direct.csv(str(copy))
    landed = read_bronze(spark, lake, "s").drop("_source_file", "_load_date")
    assert landed.columns == direct.columns == manifest["columns"]
    assert sorted(values(landed, "*"), key=str) == sorted(values(direct, "*"), key=str)
    assert manifest["row_count"] == direct.count()


def test_same_name_in_two_folders_and_encodings(spark, tmp_path, lake):
    put(tmp_path / "in/x", "g.csv", "a\né\nb\n")
    put(tmp_path / "in/y", "g.csv", "a\nü\nc\n", "latin-1")
    manifest = landing.land_files(spark, lake, {"s": str(tmp_path / "in")}, NOW)
    assert sorted(values(manifest, "file", "row_count", "encoding")) == [
        ("x/g.csv", 2, "UTF-8"), ("y/g.csv", 2, "ISO-8859-1")]
    assert sorted(values(read_bronze(spark, lake, "s"), "a")) == [("b",), ("c",), ("é",), ("ü",)]


def test_an_empty_file_in_a_folder_is_refused(spark, tmp_path, lake):
    put(tmp_path / "in", "a.csv", "x\n1\n")
    put(tmp_path / "in", "b.csv", "")
    with pytest.raises(ValueError, match="no header.*b.csv"):
        landing.land_files(spark, lake, {"s": str(tmp_path / "in")}, NOW)


def test_landed_files_that_disagree_are_refused(spark, tmp_path, lake):
    put(tmp_path / "in", "a.csv", "x,y\n1,2\n")
    put(tmp_path / "in", "b.csv", "y,x\n1,2\n")
    landing.land_files(spark, lake, {"s": str(tmp_path / "in")}, NOW)
    with pytest.raises(ValueError, match="disagree"):
        read_bronze(spark, lake, "s")


def test_empty_file_has_no_header(spark, tmp_path, lake):
    with pytest.raises(ValueError, match="no header"):
        landing.build_manifest(spark, lake, {"s": put(tmp_path / "in", "e.csv", "")}, NOW)


def test_tables_keep_null_seasons_and_prune(spark, tmp_path):
    frame = spark.createDataFrame([(1, 2020), (2, 2021), (3, None)], "v int, season int")
    path = str(tmp_path / "t")
    write_table(frame, path, gather=True)
    table = read_table(spark, path)
    assert sorted(values(table, "v", "season"), key=str) == [(1, 2020), (2, 2021), (3, None)]
    assert values(read_table(spark, path, ["v"], seasons=[2021]), "v") == [(2,)]
    plan = read_table(spark, path, ["v"], seasons=[2021])._jdf.queryExecution().executedPlan().toString()
    assert "(season#" in plan.split("PartitionFilters:")[1] and "ReadSchema: struct<v:int>" in plan
    write_table(spark.createDataFrame([(4, 2021)], "v int, season int"), path)
    assert values(read_table(spark, path), "v", "season") == [(4, 2021)]


def test_only_changed_seasons_are_written(spark, tmp_path):
    path, kinds = str(tmp_path / "t"), "v int, w string, source_file string, season int"
    old = [(1, "a", "f", 2020), (1, "a", "f", 2020), (2, None, "f", 2021), (3, "x", "f", 2022), (4, "y", "f", None), (5, "z", "f", 2024)]
    new = [(1, "a", "g", 2020), (1, "a", "g", 2020), (2, "", "g", 2021), (3, "x", "g", 2022), (4, "n", "g", None), (6, "q", "g", 2023)]
    frames = [spark.createDataFrame(rows, kinds) for rows in (old, new)]
    assert changed_seasons(spark, frames[0], path)[1] == []
    write_table(frames[0], path)
    assert changed_seasons(spark, frames[0], path) == ([], [])
    changed, gone = changed_seasons(spark, frames[1], path, ["source_file"])
    assert (changed, gone) == ([None, 2021, 2023], [2024])
    assert changed_seasons(spark, frames[1].limit(0), path)[1] == [None, 2020, 2021, 2022, 2024]
    before = {file.name for file in (tmp_path / "t").rglob("season=202[02]/*.parquet")}
    write_seasons(spark, frames[1], path, changed, gone)
    assert {file.name for file in (tmp_path / "t").rglob("season=202[02]/*.parquet")} == before
    assert sorted(values(read_table(spark, path), "v", "w", "season"), key=str) == sorted(values(frames[1], "v", "w", "season"), key=str)
    # Twice the same row is not none of it.
    assert changed_seasons(spark, frames[1].where("season = 2020").limit(1), path)[0] == [2020]
    write_seasons(spark, frames[1], path, [], [None])
    assert None not in {row[0] for row in values(read_table(spark, path), "season")}
    assert values(read_table(spark, path, ["v"], seasons=[2021, None]), "v") == [(2,)]


def test_a_table_with_only_null_seasons(spark, tmp_path):
    frame = spark.createDataFrame([(3, None)], "v int, season int")
    path = str(tmp_path / "t")
    write_table(frame, path)
    assert dict(read_table(spark, path).dtypes)["season"] == "int"
    assert values(read_table(spark, path), "v", "season") == [(3, None)]
    assert read_table(spark, path, schema=frame.schema).columns == ["v", "season"]


def test_gathering_is_a_rebalance_that_can_split_a_season(spark, tmp_path):
    frame = spark.range(10).withColumn("season", F.lit(1)).hint("rebalance", "season")
    assert "REBALANCE_PARTITIONS_BY_COL" in frame._jdf.queryExecution().executedPlan().toString()


def test_quarantine_leaves_checks_without_new_rows(spark, tmp_path):
    path = str(tmp_path / "q")
    write_quarantine(spark.createDataFrame([("a", 1), ("b", 2)], "check_name string, v int"), path, "2024-01-01")
    write_quarantine(spark.createDataFrame([("a", 3)], "check_name string, v int"), path, "2024-01-01")
    write_quarantine(spark.createDataFrame([("a", 4)], "check_name string, v int"), path, "2024-01-02")
    rows = spark.read.parquet(path).selectExpr("check_name", "string(run_date)", "v")
    assert sorted(values(rows, "*")) == [("a", "2024-01-01", 3), ("a", "2024-01-02", 4), ("b", "2024-01-01", 2)]
    assert (tmp_path / "q/check_name=a/run_date=2024-01-02").is_dir()


def test_staging_is_in_the_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    first = staging_path(spark, "lake", "t")
    assert first.startswith(folder) and first == staging_path(spark, "lake", "t")
    assert first != staging_path(spark, "elsewhere", "t")


def test_jdbc_options_bound_connections_and_keep_declared_keys():
    target = jdbc.JdbcTarget("jdbc:x", {"user": "u", "driver": "d"}, max_connections=4)
    assert target.options("fact_goals") == {
        "url": "jdbc:x", "user": "u", "driver": "d", "dbtable": "analytics.fact_goals", "numPartitions": "4",
        "batchsize": "10000", "truncate": "true", "cascadeTruncate": "true",
    }
    kept = jdbc.JdbcTarget("jdbc:x", truncate=False).options("t")
    assert "truncate" not in kept and "cascadeTruncate" not in kept


def test_jdbc_write_hands_options_to_the_writer():
    calls = []

    class Writer:
        def __getattr__(self, name):
            def record(*args, **kwargs):
                calls.append((name, args, kwargs))
                return self

            return record

    class Frame:
        write = Writer()

    target = jdbc.JdbcTarget("jdbc:x")
    jdbc.write_jdbc(Frame(), target, "t", mode="append")
    assert calls == [
        ("format", ("jdbc",), {}), ("options", (), target.options("t")), ("mode", ("append",), {}), ("save", (), {}),
    ]


def test_every_served_table_has_a_declared_key():
    assert list(serving.PRIMARY_KEYS) == [*serving.FACT_TABLES, *serving.MART_TABLES]


def test_shuffles_grow_with_the_input_and_are_set_back(spark, tmp_path):
    put(tmp_path / "d/deeper", "f.csv", "x" * 1000)
    size = path_bytes(spark, str(tmp_path / "d"), str(tmp_path / "missing"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size == 1000
    with sized_shuffles(spark, size, bytes_per_partition=100) as partitions:
        assert partitions == 10 and spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with sized_shuffles(spark, size) as partitions:
        assert partitions == int(before)


def test_shuffles_of_100_terabytes_stay_within_bounds(spark):
    reducers, split = shuffle_plan(100 << 40)
    assert 10_000 <= reducers <= 60_000 and split == 1 << 30
    assert (100 << 40) / reducers < 2 << 30
    sizes = [shuffle_plan(size << 30) for size in (1, 100, 500, 501, 5_000, 50_000)]
    assert sizes == sorted(sizes) and sizes[0] == (8, 128 << 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with sized_shuffles(spark, 100 << 40) as partitions:
        assert partitions == reducers and spark.conf.get("spark.sql.files.maxPartitionBytes") == str(split)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_the_session_is_set_back(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "65535")
    with tuned_session(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == "65535"
    spark.conf.set(key, before)
