"""The prefix trie against brute force: bands, long and equal conversations, nulls and ties."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from billscope.llm import tries
from billscope.llm.running import running_within

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            said[conv].append((turn is not None, turn or 0, role, digest, text))
    own = {c: [(role, text) for _, _, role, _, text in sorted(turns)] for c, turns in said.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - c % 100, [])[:h] + own[c][h:]
    nodes, children = defaultdict(list), defaultdict(int)
    for c, turns in built.items():
        for depth in range(len(turns) + 1):
            nodes[tuple(turns[:depth])].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for path in sorted(nodes, key=len, reverse=True):
        leaves[path] += not children[path]
        saved[path] += (len(nodes[path]) - 1) * (len(path[-1][1]) if path else 0)
        if path:
            children[path[:-1]] += 1
            leaves[path[:-1]] += leaves[path]
            saved[path[:-1]] += saved[path]
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(path))
        parent = min(nodes[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(members), len(path), parent, len(members), children[path], leaves[path], saved[path], digest))
    return sorted(out, key=str)


def ours(chats, band=tries.BAND):
    turns, conversations = tries.with_shared_openings(tries.numbered_turns(chats))
    return sorted((tuple(row) for row in tries.prefix_trie(turns, conversations, band).select(NAMES).collect()), key=str)


def made():
    rng, rows = random.Random(4), []
    for conv in [*range(95, 130), 200, 203, 204, 300, 1001, 1002, 1003, -7, -100]:
        for turn in range(150 if conv == 112 else rng.choice([1, 1, 2, 3, 8, 40])):
            text = rng.choice(["a", "a", "bé", None]) if turn < 25 else "same"
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", None]), text))
    rows += [(None, 1, "user", "x"), (112, 3, "user", "a"), (112, 3, "user", "a")]
    rows += [(c, t, "user", f"t{t}") for c in range(5000, 5200) if c % 100 for t in range(20)]  # many equal ones
    return rows


@pytest.mark.parametrize("band", (16, 3))
def test_equals_brute_force(spark, band):
    rows = made()
    chats = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit(1), "key": F.lit("x"), "place": F.lit(2)})
    assert ours(chats.repartition(5), band) == brute(rows)


def test_empty_and_single(spark):
    assert ours(spark.createDataFrame([], SCHEMA)) == []
    assert ours(spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)) == []
    rows = [(100, 0, "user", "x"), (107, 0, "user", "long text " * 50_000)]
    assert ours(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_conversations_without_turns_left(spark):
    """Those whose turns all give way to an opening that isn't there belong to the root alone."""
    rows = [(c, 0, "user", "x") for c in range(1, 60)]
    found = ours(spark.createDataFrame(rows, SCHEMA))
    assert found == brute(rows) and any(row[1] == 0 and row[3] == 59 for row in found)


def test_running_sums_of_a_group_beyond_a_range(spark):
    frame = spark.range(3000, numPartitions=4).selectExpr("if(id % 3 = 0, 1, id % 40) AS g", "id AS o", "id % 7 AS w")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    rows = running_within(frame, "g", ["o"], {"total": F.col("w"), "place": F.lit(1)}).orderBy("g", "o").collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    total, place, group = 0, 0, None
    for row in rows:
        total, place = (0, 0) if row.g != group else (total, place)
        group, total, place = row.g, total + row.w, place + 1
        assert (row.total, row.place) == (total, place)


def test_long_lists_of_ids(spark, monkeypatch):
    """One node with many ids: lists of a few ids in several tasks give the digest of all."""
    monkeypatch.setattr(tries, "LISTED", 7)
    frame = spark.range(1000, numPartitions=6).selectExpr("if(id % 3 = 0, 'hot', concat('n', id % 50)) AS node", "id * 37 % 1000 AS conv_id")
    wanted = defaultdict(list)
    for row in frame.collect():
        wanted[row.node].append(row.conv_id)
    found = {row.node: row.ends_sha256 for row in tries.list_digests(frame).collect()}
    assert found == {n: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest() for n, ids in wanted.items()}
