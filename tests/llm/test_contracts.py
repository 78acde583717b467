"""The queries against SQL or brute force on the small tables, and the driver's view of them."""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import oracle
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from billscope.llm import packing, pii, tokens
from billscope.llm.oracles import ORACLES
from billscope.llm.queries import LLM_QUERIES

FOLDER = "/root/testdata/sf0.001"
SMALL = {chr(c): chr(c + 32) for c in range(65, 91)}


@pytest.fixture(scope="module")
def connection():
    with oracle.connect(FOLDER) as opened:
        yield opened


@pytest.fixture(scope="module")
def texts(connection):
    return dict(connection.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def rows_of(spark, name):
    return LLM_QUERIES[name](spark, FOLDER).collect()


def test_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in LLM_QUERIES) == list(range(1, 14))
    assert {*LLM_QUERIES, "pipeline"} <= set(contract.queries())
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "best_fit_packing"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert oracle.difference(LLM_QUERIES[name](spark, FOLDER), connection, ORACLES[name]) is None


def encoded(name, texts, end):
    tokenizer = Tokenizer.from_file(tokens.location(name))
    return {n: [*tokenizer.encode(t, add_special_tokens=False).ids, end] for n, t in texts.items()}


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def test_packing_is_gapless_and_tight(spark, texts):
    rows, ids = rows_of(spark, "op1_best_fit_packing"), encoded(tokens.WORDS, texts, 0)
    expected = {
        (n, k, at, len(own[at : at + 2048]), crc(own[at : at + 2048]))
        for n, own in ids.items()
        for k, at in enumerate(range(0, len(own), 2048))
    }
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == expected
    assert len(rows) == len(expected)
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        ends = [0, *(offset + length for offset, length in sorted(own))]
        assert [offset for offset, _ in sorted(own)] == ends[:-1] and ends[-1] <= 2048
    total = sum(map(len, ids.values()))
    assert len(places) <= -(-total // 2048) + 1


def test_token_files_hold_all_ids_in_order(spark, texts):
    rows, ids, start = rows_of(spark, "op3_token_files"), encoded(tokens.SPACED, texts, 2), 0
    expected = {}
    for n in sorted(ids):
        expected[n] = (start, len(ids[n]), crc(ids[n]))
        start += len(ids[n])
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected


def brute_print(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(SMALL.get(c, c) for c in text))
    own = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def closure(prints, radius=2):
    names, root = sorted(prints), {}
    for n in names:
        root[n] = n
        for other in names[: names.index(n)]:
            if (prints[n] ^ prints[other]).bit_count() <= radius:
                a, b = sorted((find(root, n), find(root, other)))
                root[b] = a
    return {n: find(root, n) for n in names}


def find(root, n):
    while root[n] != n:
        n = root[n]
    return n


def test_simhash_equals_brute_force(spark, texts):
    rows = rows_of(spark, "op4_simhash")
    prints = {n: brute_print(t) for n, t in texts.items()}
    assert {r.doc_id: r.fingerprint for r in rows} == {n: f"{p:016x}" for n, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == closure(prints)


def test_language_of_held_out_documents(spark, connection):
    rows = LLM_QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    langs = dict(connection.execute("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = [r for r in rows if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def brute_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_personal_data_equals_patterns(spark, texts):
    for r in rows_of(spark, "op10_personal_data"):
        spans = [":".join(map(str, span)) for span in brute_spans(texts[r.doc_id])]
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(r.spans.split(","))
        assert r.n_email + r.n_ip + r.n_card + r.n_phone == len(spans)


def test_quality_on_labels_left_out(spark):
    folder = "/root/testdata/sf0.1"
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    from billscope.llm import quality

    held = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    views, models = quality.learn(docs, labels.where(~held), ("quality",))
    scored = quality.score(docs, views, models).select("doc_id", F.col("quality.score").alias("score"))
    rows = scored.join(labels.where(held), "doc_id").collect()
    for wanted in (0, 1):
        own = [r for r in rows if r.quality == wanted]
        assert np.mean([(r.score >= 0.5) == bool(wanted) for r in own]) > (0.8, 0.95)[wanted]


def test_pipeline_equals_its_stages(spark):
    docs, columns = spark.read.parquet(f"{FOLDER}/documents.parquet"), None
    counts = []
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, FOLDER).cache()
        counts.append(docs.count())
    assert columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = corpus_pipeline.run(spark, FOLDER)
    key = "doc_id", "piece", "start", "length", "ids_crc32"
    assert sorted(rows.select(*key).collect()) == sorted(docs.select(*key).collect())
    assert counts[0] >= counts[1] >= counts[2] == counts[3]
    assert rows.where(rows["offset"] + rows["length"] > packing.CAPACITY).isEmpty()


def test_language_equals_plain_vectors(spark, connection):
    """Letters, bound runs, text and language vectors one by one, as the method says."""
    from billscope.llm import language

    rows = connection.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    letters, runs = {}, {}

    def letter(code):
        if code not in letters:
            draw = np.random.default_rng([language.SEED, code]).integers(0, 2, language.DIMENSIONS, np.int8)
            letters[code] = 2 * draw.astype(float) - 1
        return letters[code]

    def unit(text):
        spelled = "".join(c if c.isalpha() else " " for c in (text or "").lower())
        spelled = f" {' '.join(spelled.split())} "
        total = np.zeros(language.DIMENSIONS)
        for run in zip(spelled, spelled[1:], spelled[2:], strict=False):
            if run not in runs:
                a, b, c = (letter(ord(sign)) for sign in run)
                runs[run] = np.roll(a, 2) * np.roll(b, 1) * c
            total += runs[run]
        return total / (np.linalg.norm(total) or 1)

    units = {n: unit(text) for n, text, _ in rows}
    learned = [(n, lang) for n, _, lang in rows if lang and zlib.crc32(str(n).encode()) % 4 != 2]
    profiles = {lang: sum(units[n] for n, own in learned if own == lang) for lang in sorted({lang for _, lang in learned})}
    profiles = {lang: total / np.linalg.norm(total) for lang, total in profiles.items()}
    for row in rows_of(spark, "op5_language_id"):
        cosines = {lang: float(units[row.doc_id] @ own) for lang, own in profiles.items()}
        best = max(cosines, key=cosines.get) if units[row.doc_id].any() else language.UNKNOWN
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert row.lang_pred == best and abs(row.score - max(cosines.get(best, 0.0), 0.0)) < 1e-4


def test_logistic_fit_equals_plain_rounds():
    """The classifier's fit against Adam over a dense table, row by row."""
    from billscope.llm import quality

    rng = np.random.default_rng(4)
    dense = (rng.random((60, 12)) < 0.3) * rng.random((60, 12))
    dense[:, 0] = 1.0
    labels = (dense[:, 3] + 0.2 * rng.random(60) > 0.25).astype(float)
    rows = quality.Rows()
    for row in dense:
        rows.add(np.flatnonzero(row).astype(np.int32), row[np.flatnonzero(row)])
    counts = rng.integers(1, 4, 60).astype(float)
    found = quality.fit(rows, labels, 12, steps=40, counts=counts)
    weights, mean, spread = np.zeros(12), np.zeros(12), np.zeros(12)
    for step in range(1, 41):
        grad = 1e-3 * weights
        for row, label, count in zip(dense, labels, counts, strict=True):
            grad = grad + count / counts.sum() * (1 / (1 + np.exp(-row @ weights)) - label) * row
        mean, spread = 0.9 * mean + 0.1 * grad, 0.99 * spread + 0.01 * grad**2
        weights = weights - 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step) * mean / (np.sqrt(spread) + 1e-9)
    used = dense.any(0)
    assert np.allclose(found[used], weights[used], atol=1e-4) and not found[~used].any()
