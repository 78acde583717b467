"""FTRL-proximal against a plain version, features against brute force, held-out accuracy and edge cases."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from billscope.llm import toxicity
from billscope.llm.queries import LLM_QUERIES


def plain_ftrl(rows, labels, size, alpha, beta, l1, l2, epochs, seed):
    """The published update, one coordinate at a time; the last coordinate is the bias, without penalty."""
    z, n = [0.0] * (size + 1), [0.0] * (size + 1)

    def weight(i):
        if i == size:
            return -z[i] * alpha / (beta + n[i] ** 0.5)
        return 0.0 if abs(z[i]) <= l1 else (np.sign(z[i]) * l1 - z[i]) / ((beta + n[i] ** 0.5) / alpha + l2)

    for epoch in range(epochs):
        for row in np.random.default_rng([seed, epoch]).permutation(len(rows)).tolist():
            own = [*rows[row].tolist(), size]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[row]
            for i in own:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
    return np.array([weight(i) for i in range(size)]), weight(size)


def test_ftrl_equals_a_plain_version():
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 30, rng.integers(0, 12))) for _ in range(120)]
    labels = np.array([float(3 in row or rng.random() < 0.1) for row in rows])
    options = dict(alpha=0.5, beta=1.0, l1=0.7, l2=0.2, epochs=3, seed=5)
    weights, bias = toxicity.ftrl(rows, labels, 30, **options)
    plain, plain_bias = plain_ftrl(rows, labels, 30, **options)
    assert np.allclose(weights, plain) and np.isclose(bias, plain_bias)
    assert weights[3] == weights.max() > 0 and (weights == 0).any()


def mixed(value):
    value = (value ^ (value >> 31)) * 0x9E3779B97F4A7C15 % 2**64
    return (value ^ (value >> 29)) >> 32


def plain_features(text):
    words = [xxh64_intdigest(w.encode(), toxicity.SEED) for w in "".join(c if c.isalnum() or c > "\x7f" else " " for c in text.lower()).split(" ") if w]
    out = {mixed(w) for w in words}
    for distance in (1, 2, 3):
        pairs = zip(words, words[distance:], strict=False)
        out |= {mixed((a * (2 * distance + 1) + b * 0xD6E8FEB86659FD93) % 2**64) for a, b in pairs}
    return out


@pytest.mark.parametrize("size", (1 << 20, 40))
def test_features_of_whole_texts(size, monkeypatch):
    """Words, pairs and skipped pairs, the same in one slice and in many."""
    monkeypatch.setattr(toxicity, "SLICE", size)
    texts = ["", " .,! ", "one", "You IDIOT, you!", "a b c d e f g " * 40, "Été straße x-y_z 42", "w" * 200 + " b " + "c" * 90 + " d e"]
    for text in texts:
        found = [part for part in toxicity.Featurer()(text.encode())]
        found = set(np.concatenate(found).tolist()) if found else set()
        if size > 100 or max(map(len, text.split() or [""])) < 40:
            assert found == plain_features(text)
        assert found >= {mixed(xxh64_intdigest(w.encode(), toxicity.SEED)) for w in text.lower().split() if w.isalnum() and len(w) < 20}


def test_frequent_features():
    rows = [np.array(r, np.uint32) for r in ([1, 2, 3], [2, 3], [3, 9], [], [3, 2**32 - 1])]
    assert toxicity._frequent(rows, 3).tolist() == [3] and toxicity._frequent(rows, 2).tolist() == [2, 3]
    assert toxicity._frequent(rows, 9).tolist() == [] and toxicity._frequent([], 3).tolist() == []


def test_held_out_toxic_documents_are_found(spark):
    folder = "/root/testdata/sf0.1"
    found = LLM_QUERIES["op12_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = found.where("held_out").collect()
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(600):
        words = [f"w{n}" for n in rng.integers(0, 50, 12)]
        toxic = bool(k % 4 == 0)
        rows.append((k, " ".join([*words, *["Nasty"] * toxic])))
        labels.append((k, int(toxic)))
    rows += [(None, "nasty null id"), (7000, None), (7001, ""), (7002, "nasty " * 300_000), (0, "another text of one id"), (0, rows[0][1])]
    labels += [(0, 0), (None, 1), (7002, None), (9999, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"toxicity": F.lit("own"), "score": F.lit(1), "label": F.lit(2), "row": F.lit(3), "features": F.lit(4)})
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_edges(spark, small):
    docs, labels = small
    model = toxicity.fit(docs, labels)
    found = toxicity.with_score(docs, model)
    assert found.columns == [*docs.columns, "_toxicity"] and found.count() == docs.count()
    by_text = {r.text: r._toxicity for r in found.collect()}
    assert all((score > 0.5) == ("asty" in (text or "")) for text, score in by_text.items())
    assert by_text[None] == by_text[""]
    assert toxicity.with_score(docs.where("false"), model).count() == 0


def test_a_bounded_sample(spark, small):
    docs, labels = small
    model = toxicity.fit(docs, labels, sample=60)
    assert {r._toxicity > 0.5 for r in toxicity.with_score(docs, model).where("text like '%Nasty'").collect()} == {True}
    fewer = toxicity.fit(docs, labels, sample_features=3000)  # a few dozen rows
    assert len(fewer.features) < len(model.features) + 100


def test_one_id_on_very_many_rows(spark, small):
    """Rows are drawn, not ids: an id on a third of the rows brings no more rows than the sample takes."""
    docs, labels = small
    hot = docs.unionByName(spark.range(300).select(F.lit(4).cast("long").alias("doc_id"), F.concat(F.lit("nasty "), "id").alias("text")), allowMissingColumns=True)
    model = toxicity.fit(hot, labels, sample=50)
    assert len(model.features) <= 50 * 2 * 60


@pytest.mark.parametrize("value, expected", ((0, 0.0), (1, 1.0), (None, 0.0)))
def test_labels_of_one_class(spark, small, value, expected):
    docs, labels = small
    model = toxicity.fit(docs, labels.withColumn("toxic", F.lit(value).cast("int")))
    scores = {round(r._toxicity, 6) for r in toxicity.with_score(docs.limit(5), model).collect()}
    assert scores == {expected}
