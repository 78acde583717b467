"""Phrases against brute force, the summaries' guarantee, and edge cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from billscope.llm import collocations

SMALL = {chr(c): chr(c + 32) for c in range(65, 91)}
SCHEMA = "lang string, text string"


def brute(docs, least=10, top=2000, longest=3, share=50):
    found, words = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang, low = lang or "und", "".join(SMALL.get(c, c) for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            own = re.findall("[^ \t]+", piece)
            words[lang] += len(own)
            for size in range(1, longest + 1):
                found[lang].update(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
    out = set()
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            holders = [b for q, b in candidates.items() if len(q) > len(p) and f" {' '.join(p)} " in f" {' '.join(q)} "]
            if any(100 * b >= share * a for b in holders):
                continue
            score, cut = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, l, r, words[lang], -score))
    return out


def rows_of(frame):
    rows = [tuple(row) for row in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed=1):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "C", "dé", "É", "Z", "x.y", "q!", "new\tline", "e f", "g\x0bh", "i,"]
    out = [(("en", "de", None, "und")[k % 4], " ".join(words[w] for w in rng.integers(0, len(words), rng.integers(0, 60)))) for k in range(400)]
    out += [("en", None), (None, ""), ("fr", "?!. \t\n"), ("en", "the same row again and again"), ("en", "the same row again and again")]
    return out + [("en", "one very long text , of few words " * 3000), ("xx", "only once here")] + [("en", "New York City is")] * 12


@pytest.mark.parametrize("options", ({}, {"chunk_bytes": 3000, "part_bytes": 2000}))
def test_equals_brute_force(spark, options):
    rows = texts()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("lang", "text", "1 AS phrase", "2 AS n", "3 AS chunk").repartition(5)
    assert rows_of(collocations.collocations(docs, **options)) == brute(rows)


def test_other_bounds(spark):
    rows, docs = texts(2), None
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(collocations.collocations(docs, threshold=4, longest=4, top=7, share=80, chunk_bytes=5000)) == brute(rows, 4, 7, 4, 80)
    assert rows_of(collocations.collocations(docs, longest=2)) == brute(rows, longest=2)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "a")], SCHEMA)).count() == 0


def test_long_texts_are_cut_at_separators(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CUT_BYTES", 50)
    for text in (b"a b, c d. e f " * 30, b"no separator at all " * 40, b"x" * 500, b"", b"." * 200):
        parts = list(collocations._parts(text, 50))
        assert b"".join(parts) == text
        assert all(part.endswith(tuple(map(bytes, zip(collocations.SEPARATORS)))) for part in parts[:-1])


@settings(deadline=None, max_examples=200)
@given(st.lists(st.lists(st.integers(0, 12), max_size=40), min_size=1, max_size=12), st.integers(1, 9))
def test_every_frequent_key_survives_a_merge(chunks, threshold):
    """Misra-Gries: no count is too high, none loses as much as the threshold, and the capacity holds."""
    exact = Counter(key for chunk in chunks for key in chunk)
    capacity = sum(exact.values()) // threshold + 1
    own = [np.unique(np.array(chunk, np.uint32), return_counts=True) for chunk in chunks]
    keys, counts, missing = collocations.merged(own, capacity)
    kept = dict(zip(keys.tolist(), counts.tolist(), strict=True))
    assert len(kept) <= capacity and missing < threshold
    for key, count in exact.items():
        assert count - missing <= kept.get(key, 0) <= count
        assert count < threshold or key in kept


def test_a_small_capacity_forgets_rare_keys():
    chunk = np.arange(1000, dtype=np.uint32), np.ones(1000, np.int64)
    frequent = np.array([7], np.uint32), np.array([500])
    keys, counts, missing = collocations.merged([chunk, frequent, (chunk[0] + np.uint32(1000), chunk[1])], 100)
    assert keys.tolist() == [7] and 500 - missing <= counts[0] <= 501 and missing <= 2500 / 101


def test_planes_round_trip():
    values = np.array([0, 1, 255, 256, 2**32 - 1], np.uint32)
    assert collocations.unplaned(collocations.planes(values)).tolist() == values.tolist()
    assert collocations.unplaned(collocations.planes(values[:0])).tolist() == []


def test_scores_are_exact(spark):
    """Beyond 64 bits."""
    from pyspark.sql import functions as F

    a, l, r = 10**12 + 7, 10**13 + 9, 3 * 10**12 + 1
    frame = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    assert frame.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 10**6 * a * a // (l * r)


def test_a_chunk_is_sent_in_small_batches():
    texts = [b" ".join(b"w%d" % k for k in range(at, at + 1000)) for at in range(0, 250_000, 1000)]
    table = pa.table({"chunk": [0] * len(texts), "lang": ["en"] * len(texts), "text": pa.array(texts, pa.binary())})
    sent = [*collocations._summaries(iter(table.to_batches()), 64, 3)]
    parts = [part for batch in sent for part in batch["part"].to_pylist()]
    assert parts == [*range(64)] and max(batch.nbytes for batch in sent) < 3_000_000
    assert sum(len(keys) // 4 for batch in sent for keys in batch["keys"].to_pylist()) > 745_000
    assert sum(int(collocations.unplaned(own).sum()) for batch in sent for own in batch["counts"].to_pylist()) == 749_250
