"""Periodic runs, the conversation trie and URL filters against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SF, WORD, awkward, nothing, plain_rows, sha
from pyspark.sql import functions as F

from touchline.llm import conversation_trie, periodic_runs, queries, url_rules
from touchline.llm.conversation_trie import prefix_trie, with_shared_heads

CLASHES = ("_row", "host", "path", "rule", "first", "last", "end", "conv", "own", "turn_", "runs", "collapsed", "n", "_salt")


def plain_runs(words, least=6, repeats=4):
    found = []
    for q in range(1, len(words) // repeats + 1):
        at = 0
        while at + q < len(words):
            stop = at
            while stop + q < len(words) and words[stop] == words[stop + q]:
                stop += 1
            length = stop + q - at
            if stop > at and length >= max(least, repeats * q):
                run = words[at : at + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    found.append((at, length, q))
            at = max(stop, at + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_row(key, text):
    words = WORD.findall(text or "")
    if key is not None and words:
        h = zlib.crc32(str(key).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {at for start, length, q in runs for at in range(start + q, start + length)}
    best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
    figures = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{start},{length},{q}\n" for start, length, q in runs)
    return (key, len(runs), *figures, sha(lines), sha(" ".join(word for at, word in enumerate(words) if at not in gone)))


def test_runs_query_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    wanted = [plain_row(row["doc_id"], row["text"]) for row in docs.collect()]
    assert sum(row[1] for row in wanted) > 5
    got = queries.op11_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert plain_rows(got) == sorted(wanted, key=lambda row: [(v is not None, str(v)) for v in row])


def test_awkward_runs(spark):
    docs = awkward(spark)
    got = sorted(map(str, periodic_runs.periodic_runs(docs.withColumn("runs", F.lit(1))).collect()))
    wanted = []
    for row in docs.collect():
        words = WORD.findall(row["text"] or "")
        # The long text repeats 6 words 4,000 times.
        runs = [(0, 24000, 6)] if len(words) > 20000 else plain_runs(words)
        gone = {at for start, length, q in runs for at in range(start + q, start + length)}
        wanted.append((row["doc_id"], len(words), runs, " ".join(w for at, w in enumerate(words) if at not in gone)))
    rows = periodic_runs.periodic_runs(docs).collect()
    assert len(rows) == len(got)
    assert sorted(map(str, wanted)) == sorted(
        str((row["doc_id"], row["n_words"], [tuple(run) for run in row["runs"]], row["collapsed"])) for row in rows
    )
    assert periodic_runs.periodic_runs(nothing(spark)).count() == 0
    with pytest.raises(ValueError, match="four"):
        periodic_runs.find_runs(np.array([1]), np.array([0, 1]), repeats=3)


def _numbered(texts):
    return np.array([word for text in texts for word in text], np.int64), np.cumsum([0, *map(len, texts)])


words = st.lists(st.integers(0, 3), max_size=14)
#: Texts of repeated pieces, so that runs touch, overlap and lie in one another.
texts = st.lists(st.tuples(words, st.integers(1, 9)), max_size=5).map(lambda parts: [w for part, n in parts for w in part * n])


@settings(max_examples=200, deadline=None)
@given(every=st.lists(texts, min_size=1, max_size=4), rounds=st.sampled_from([0, 1, 12]))
def test_generated_runs(every, rounds):
    before, periodic_runs.ROUNDS = periodic_runs.ROUNDS, rounds
    try:
        assert periodic_runs.find_runs(*_numbered(every)) == [plain_runs(text) for text in every]
    finally:
        periodic_runs.ROUNDS = before


def test_splitting_word_by_word_is_not_quadratic():
    """Each level frees one more rare word: 40,000 words, 10,000 levels."""
    words, levels = [], 10_000
    for level in range(levels):
        words += [level, level + 1, level + 2, level + 3]
    found = periodic_runs.find_runs(np.array(words), np.array([0, len(words)]))
    assert found == [[]]


def test_splitting_leaves_runs_whole():
    words = [9, *[1, 2] * 5, 8, *[3] * 6, 7]
    segments = periodic_runs.split_segments(np.array(words), np.array([0]), np.array([len(words)]), 6, 4)
    assert sorted(segments) == [(1, 11), (12, 18)]


# --- trie


def plain_trie(sequences):
    """Nodes of {id: [(role, text)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for key, turns in sequences:
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(key)
        ends[tuple(turns)].append(key)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, rows = {}, {}, []
    least = {node: min((key for key in keys if key is not None), default=None) for node, keys in members.items()}
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[child] for child in below) if below else 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[child] for child in below)
        listed = ",".join(str(key) for key in sorted(key for key in ends[node] if key is not None))
        parent = least[node[:-1]] if node else None
        rows.append((least[node], len(node), parent, len(members[node]), len(below), leaves[node], saved[node], sha(listed)))
    return sorted(map(str, rows))


def rebuilt(rows):
    own = defaultdict(list)
    for row in rows:
        own[row["conv_id"]].append((row["turn"] is not None, row["turn"] or 0, row["role"] or "", row["text"] or ""))
    lists = {key: [turn[2:] for turn in sorted(turns)] for key, turns in own.items()}
    result = []
    for key, turns in lists.items():
        h = zlib.crc32(str(key).encode()) % 6 if key is not None else 0
        head = lists.get(key - key % 100, []) if key is not None else []
        result.append((key, head[:h] + turns[h:]))
    return result


def trie_rows(frame):
    return sorted(str(tuple(row)) for row in frame.drop("node_id").collect())


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_trie_query_equals_plain_version(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    assert trie_rows(queries.op12_conversation_trie(spark, SF)) == plain_trie(rebuilt(turns.collect()))


@pytest.mark.parametrize("shard", [1, 7, 1000])
def test_trie_of_many_shapes(spark, shard):
    """Chains, prefixes that are ends, copies, turnless and absent donors, nulls, over shards of a few turns."""
    seeded = random.Random(5)
    rows = []
    for key in [*range(230), 1200, 1207, None]:
        for turn in range(seeded.choice([1, 1, 2, 3, 4, 9, 30])):
            text = seeded.choice(["a", "b", "äö", None, "", "x" * 50])
            rows.append((key, seeded.choice([turn, turn, turn, None]), seeded.choice(["user", "assistant", None]), text))
    rows += rows[:3]
    # Ties are in order of role and then of digest; equal texts make them one.
    rows = [(key, turn if turn is not None else -1, role, text) for key, turn, role, text in rows]
    rows = list({(key, turn): (key, None if turn < 0 else turn, role, text) for key, turn, role, text in rows}.values())
    turns = conversations(spark, rows + rows[-2:]).withColumns({name: F.lit(1) for name in CLASHES})
    got = prefix_trie(with_shared_heads(turns), shard_turns=shard)
    assert trie_rows(got) == plain_trie(rebuilt(turns.collect()))


def test_trie_of_conversations_as_they_are(spark):
    copies = [(key, turn, "user", "same") for key in range(300) for turn in range(3)]
    longer = [(1000, turn, "user", "same") for turn in range(80)]
    turns = conversations(spark, copies + longer)
    lists = [(key, [("user", "same")] * 3) for key in range(300)] + [(1000, [("user", "same")] * 80)]
    got = conversation_trie.conversation_trie(turns, shard_turns=2)
    assert trie_rows(got) == plain_trie(lists)
    assert got.select("node_id").distinct().count() == 81
    assert conversation_trie.conversation_trie(turns.limit(0)).count() == 0


def test_long_lists_of_members_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 10)
    rows = [(b"x" * 32, number) for number in range(50)] + [(b"y" * 32, None)]
    members = spark.createDataFrame(rows, "end binary, conv long")
    [row] = conversation_trie._ends(members).collect()
    assert row["ends"] == sha(",".join(map(str, range(50))))


@settings(max_examples=60, deadline=None)
@given(data=st.lists(st.lists(st.integers(0, 2), max_size=6), min_size=1, max_size=25), cut=st.integers(1, 6))
def test_shards_merge_to_the_same_trie(data, cut):
    """Without Spark: nodes and junctions of shards of ``cut`` sequences sum to those of one shard."""
    record = [hashlib.sha256(bytes([n])).digest() + (n + 1).to_bytes(8, "big") for n in range(3)]
    counted = defaultdict(list)
    for number, codes in enumerate(data):
        counted[b"".join(record[code] for code in codes)].append(number)
    rows = [(sequence, len(keys), min(keys)) for sequence, keys in sorted(counted.items())]

    def merged(size):
        shards = [rows[at : at + size] for at in range(0, len(rows), size)]
        every = [node for shard in shards for node in conversation_trie.shard_nodes(shard)]
        for one, other in zip(shards, shards[1:], strict=False):
            every += conversation_trie.junction(one[-1][0], other[0][0])
        sums, least, edge = defaultdict(lambda: [0] * 4), {}, defaultdict(int)
        for node in every:
            sums[node[0], node[3]] = [a + b for a, b in zip(sums[node[0], node[3]], node[5:9], strict=True)]
            if node[4] is not None:
                least[node[0]] = min(node[4], least.get(node[0], node[4]))
            edge[node[0]] += not node[9]
        assert all(n <= 1 for n in edge.values())  # nodes that are not at a boundary are in one shard
        return dict(sums), least

    assert merged(cut) == merged(len(rows))


# --- URLs


URLS = [
    "http://a.example.net/en/1", "https://EXAMPLE.NET/en/", "http://net/x", "http://x.net", "http://net?q", "ftp://example.netz/en/",
    "http://www.example.com/de/7#top", "http://example.com/de", "http://b.org/fr/3?x=/en/", "no scheme", "", None, "://net/",
    "http://u@a.net:80/", "http://a.net./", "http://ÄÖ.Net/y", "http://x.example.net/en/a://b.org/fr/", "http://.net/", "http://a/net/",
    "http://net/" + "x/" * 3000, "http://" + "a." * 3000 + "net/en/", "\nhttp://two\nlines.net/\nx",
]
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("example.com", "/d", "allow"), ("Example.com", "/de/", "allow"), ("b.org", "", "block"), ("x.example.net", "/en/a", "block"),
    ("", "/", "block"), (None, "/never", "block"),
]


def plain_verdict(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    end = min([rest.find(mark) for mark in "/?#" if mark in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(mark) for mark in "?#" if mark in tail], default=len(tail))]
    best = None
    for own, start, verdict in rules:
        own, start = (own or "").lower(), start or ""
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            best = max(best or (-1,), (len(own + start), len(own), verdict, own + start))
    return host, path, best[3] if best else None, best[2] if best else default


@pytest.mark.parametrize("broadcast", [100, 0])
def test_url_rules(spark, broadcast, monkeypatch):
    monkeypatch.setattr(url_rules, "HOT_SHARE", 4)
    rows = [*enumerate(URLS), (None, URLS[0]), (0, URLS[0])] + [(7, URLS[2])] * 40
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({name: F.lit("x") for name in CLASHES})
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_rules.judge(pages, rules, broadcast_rules=broadcast)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    wanted = [(key, *plain_verdict(url, RULES)) for key, url in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))
    assert url_rules.judge(pages.limit(0), rules, broadcast_rules=broadcast).count() == 0
    none = url_rules.judge(pages, rules.limit(0), default="block", broadcast_rules=broadcast)
    assert {row["verdict"] for row in none.collect()} == {"block"}


def test_many_rules_without_broadcast(spark):
    """Rules as of a list of hosts: each host of the table with some of its paths, some of them twice."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    urls = [(row["page_id"], row["url"]) for row in pages.collect()]
    seeded, rules = random.Random(3), []
    for _, url in urls:
        host, path, _, _ = plain_verdict(url, [])
        labels = host.split(".")
        rules.append((".".join(labels[seeded.randrange(len(labels)) :]), path[: seeded.randrange(len(path) + 1)],
                      seeded.choice(["allow", "block"])))
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    wanted = sorted(str((key, *plain_verdict(url, rules))) for key, url in urls)
    for broadcast in (10_000, 0):
        got = url_rules.judge(pages, frame, broadcast_rules=broadcast)
        assert sorted(str(tuple(row)) for row in got.collect()) == wanted
