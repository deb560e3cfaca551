"""Exact and near duplicates against plain versions."""

import re

import numpy as np
import pytest
import xxhash
from llm_data import SF, WORD, awkward, nothing, sha
from pyspark.sql import functions as F

from touchline.llm import exact_dedup, simhash
from touchline.llm.components import connected_components
from touchline.llm.exact_dedup import Directory, build_directory, exact_duplicates
from touchline.llm.queries import op6_simhash
from touchline.llm.simhash import links, near_duplicates


def brute_exact(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["text"] or "", []).append(row["doc_id"])
    best = {text: max(ids, key=lambda value: (value is not None, value or 0)) for text, ids in groups.items()}
    return sorted(
        (str(row["doc_id"]), str(best[row["text"] or ""]), len(groups[row["text"] or ""]), sha(row["text"] or ""))
        for row in rows
    )


@pytest.mark.parametrize("capacity", [exact_dedup.CAPACITY, 2000])
def test_exact_duplicates(spark, capacity):
    for docs in (awkward(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        found = exact_duplicates(docs.repartition(3), capacity=capacity).collect()
        plain = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in found)
        assert plain == brute_exact(docs.collect())
        kept = [r for r in found if r["kept"]]
        assert len(kept) == len({r["text_sha256"] for r in found}) and all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact_duplicates(nothing(spark)).count() == 0


def test_a_text_of_very_many_blocks_is_compared_in_groups(spark, monkeypatch):
    """Every row is a block of its own here; one text is in 600 of them, others in few, one key holds two texts."""
    sizes = []
    compared = exact_dedup._compared

    def watched(entries, id_type):
        per_key = entries.groupBy("_hash").count().agg(F.max("count")).first()[0]
        sizes.append(per_key)
        return compared(entries, id_type)

    monkeypatch.setattr(exact_dedup, "_compared", watched)
    rows = spark.range(800).select(
        F.when(F.col("id") % 9 != 0, F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 600, F.lit("again and again"))
        .when(F.col("id") < 640, F.lit(None).cast("string"))
        .when(F.col("id") < 700, F.lit(""))
        .otherwise(F.concat(F.lit("text "), (F.col("id") % 70).cast("string")))
        .alias("text"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        found = exact_duplicates(rows, most_entries=20).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    plain = sorted((str(r["doc_id"]), str(r["keep_id"]), r["group_size"], r["text_sha256"]) for r in found)
    assert plain == brute_exact(rows.collect())
    assert sum(r["kept"] for r in found) == len({r["text_sha256"] for r in found})
    # Groups of some 20 entries in the first round, one entry of each group of 600 / 20 in the second.
    assert len(sizes) == 2 and sizes[0] <= 45 and sizes[1] <= 30


def test_kept_rows_have_their_text(spark):
    docs = awkward(spark)
    kept = exact_duplicates(docs, carry=["lang"]).where("kept").collect()
    assert sorted(r["_text"] for r in kept) == sorted({r["text"] or "" for r in docs.collect()})


def test_collisions_are_chained(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.xxhash, "xxh64_intdigest", lambda data, seed: 7)
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "c")], "doc_id long, text string").coalesce(1)
    pages = list(exact_dedup._compare(iter(_entries([(7, 1, 0, 1, "a"), (7, 2, 1, 1, "b"), (7, 3, 2, 2, "a")]))))
    assert [tuple(row.values()) for row in pages[0].to_pylist()] == [(0, 3, 2, 3), (2, 3, 2, 3), (1, 2, 1, 1)]
    assert docs.count() == 4


def _entries(rows):
    import pyarrow as pa

    columns = [pa.array(column) for column in zip(*rows, strict=True)]
    return [pa.RecordBatch.from_arrays(columns, ["_hash", "_id", "_row", "_rows", "_text"])]


def test_directory_doubles_and_covers_every_prefix():
    directory = Directory()
    directory.split(0)
    directory.split(1)
    directory.split(0)
    assert directory.depth == 2 and directory.slots == [0, 3, 1, 2]
    assert directory.owners([5, 5, 5, 5], 10) == [0, 0, 1, 1]


def test_directory_splits_full_buckets_only(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("_hash"), F.lit(100).cast("long").alias("_bytes"))
    directory, loads = build_directory(keys, 20_000)
    assert sum(loads) == 300_000 and max(loads) <= 20_000 and len(directory.slots) == 1 << directory.depth
    one = spark.createDataFrame([(5, 1 << 40)], "_hash long, _bytes long")
    assert build_directory(one, 10)[0].depth == 0  # a single key cannot split


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[at : at + 4]) for at in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(shingle.encode(), 42) for shingle in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=4):
    """Smallest reachable index for each print, by all pairs."""
    root = list(range(len(prints)))

    def find(at):
        while root[at] != at:
            at = root[at]
        return at

    for one in range(len(prints)):
        for other in range(one):
            if bin(prints[one] ^ prints[other]).count("1") <= distance:
                a, b = find(one), find(other)
                root[max(a, b)] = min(a, b)
    return [find(at) for at in range(len(prints))]


def test_near_duplicates(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    roots = plain_components([plain_fingerprint(row["text"]) for row in docs])
    expected = {
        row["doc_id"]: (f"{plain_fingerprint(row['text']):016x}", docs[root]["doc_id"])
        for row, root in zip(docs, roots, strict=True)
    }
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in op6_simhash(spark, SF).collect()} == expected


def test_awkward_near_duplicates(spark):
    found = near_duplicates(awkward(spark)).collect()
    # Ids may repeat, so components are told apart by what they hold.
    prints = sorted({plain_fingerprint(row["text"]) for row in awkward(spark).collect()})
    assert sum(r["kept"] for r in found) == len(set(plain_components(prints)))
    empty = {r["component_id"] for r in found if r["doc_id"] in (2, 3, 4)}
    assert empty == {2} and len(found) == awkward(spark).count()
    assert {r["component_id"] for r in found if r["doc_id"] in (9, 10, 11)} == {9}
    assert near_duplicates(nothing(spark)).count() == 0


@pytest.mark.parametrize("bucket_rows", [simhash.BUCKET_ROWS, 4])
def test_no_link_is_lost(spark, bucket_rows):
    random = np.random.default_rng(3)
    prints = random.integers(0, 1 << 63, 40).tolist()
    for base in prints[:10]:  # chains of neighbours, some beyond the distance of each other
        last = base
        for _ in range(25):
            for bit in random.choice(64, random.integers(1, 6), replace=False).tolist():
                last ^= 1 << bit
            prints.append(last)
    for _ in range(60):  # one dense group
        prints.append(prints[0] ^ (1 << int(random.integers(64))) ^ (1 << int(random.integers(64))))
    prints = sorted({number & ((1 << 63) - 1) for number in prints})
    vertices = spark.createDataFrame([(number,) for number in prints], "_fp long")
    roots = {r["vertex"]: r["root"] for r in connected_components(links(vertices, bucket_rows)).collect()}
    assert [roots.get(number, number) for number in prints] == [prints[at] for at in plain_components(prints)]


def test_components_of_no_edges_and_of_a_path(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    path = spark.range(1, 60).select(F.col("id").alias("u"), (F.col("id") - 1).alias("v"))
    assert {r["root"] for r in connected_components(path).collect()} == {0}
