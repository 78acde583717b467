"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the hashes of its words, of neighbouring pairs and of pairs with up to ``GAP`` words between,
each counted once. The model is fitted by FTRL-proximal: every weight has its own rate, which falls with the squares
of its gradients, and weights whose summed gradients stay within ``L1`` are exactly zero. What is left is a short list
of hashes and weights that is broadcast to score all texts; its margin is turned into a probability by a logistic
curve fitted on rows that the weights haven't seen, at the share of toxic rows among all labels.

It is fitted on a bounded sample, chosen by a hash of id and text: at most ``SAMPLE`` rows of each class with at most
``SAMPLE_FEATURES`` features together; a larger text isn't sampled. All texts are scored whole.

Nulls: a null text is empty; texts without words get the score of no feature. A null id is never learned from, null
labels are left out, and an id is toxic if any of its labels is. Rows with the same id and text are learned from once.
Without labels of both classes every score is the share of toxic labels, 0 without any. Words are runs of ASCII
letters and digits in small case and characters beyond ASCII. Very long texts are taken in slices that share their
border words. Ties can't arise; an empty table gives no rows. Further columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm.frames import free_name, texts_of
from billscope.work import materialise

GAP = 2
SAMPLE, SAMPLE_FEATURES = 4_000, 12_000_000
LEAST_DOCS = 3  # sampled rows a feature must be in
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.1  # chosen by cross-validation over labels that may be learned from
EPOCHS, SEED = 4, 12
SLICE = 1 << 20  # bytes of a text that are taken at once
MOST_WORDS = 1_000_000  # remembered by a worker

_PLAIN = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


class Words(dict):
    """Hashes of the words seen by this worker."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[word] = xxh64_intdigest(word, SEED)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (values ^ (values >> np.uint64(29))) >> np.uint64(32)


def hashed(words: np.ndarray, gap: int = GAP) -> list[np.ndarray]:
    """32-bit hashes of the words, and of the pairs with 0, 1, ... ``gap`` words between, by the first word's place."""
    out = [_mixed(words)]
    for distance in range(1, gap + 2):
        first, second = words[:-distance], words[distance:]
        out.append(_mixed(first * np.uint64(2 * distance + 1) + second * np.uint64(0xD6E8FEB86659FD93)))
    return out


def _slices(text: bytes, gap: int) -> Iterator[bytes]:
    """The text in parts of whole words; each part repeats the ``gap`` + 1 words before it."""
    at = 0
    while len(text) - at > SLICE:
        end = text.find(b" ", at + SLICE)
        if end < 0:
            break
        yield text[at:end]
        at = end
        for _ in range(gap + 1):
            while at > 0 and text[at - 1 : at] == b" ":
                at -= 1
            at = max(text.rfind(b" ", 0, at), 0)
        if at + SLICE <= end:  # a few words as long as a slice
            at = max(at, end - SLICE // 2)
    yield text[at:]


class Featurer:
    def __init__(self, gap: int = GAP):
        self.gap, self.words = gap, Words()

    def __call__(self, text: bytes | None) -> Iterator[np.ndarray]:
        """Feature hashes of a text, slice by slice, repeats included."""
        if not text:
            return
        plain = text.decode("utf-8", "replace").lower().encode().translate(_PLAIN)
        for part in _slices(plain, self.gap):
            own = part.split()
            if own:
                words = np.fromiter(map(self.words.__getitem__, own), np.uint64, len(own))
                yield np.concatenate(hashed(words, self.gap))


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # rising 32-bit hashes
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, found: np.ndarray) -> float:
        """Bias and weights of the distinct features among ``found``, places of known features."""
        return self.bias + float(self.weights[np.unique(found)].sum())

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.shift, -50, 50)))


def ftrl(
    rows: list[np.ndarray],
    labels: np.ndarray,
    size: int,
    alpha: float = ALPHA,
    beta: float = BETA,
    l1: float = L1,
    l2: float = L2,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> tuple[np.ndarray, float]:
    """Weights of ``size`` features and a bias from rows of feature numbers, whose values are one.

    z sums gradients less what the weights' own moves explain, n their squares; a weight is read off z and n when it
    is needed. The bias has no penalty.
    """
    z, n = np.zeros(size), np.zeros(size)
    bias_z = bias_n = 0.0

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2))

    for epoch in range(epochs):
        for row in np.random.default_rng([seed, epoch]).permutation(len(rows)).tolist():
            own = rows[row]
            own_z, own_n = z[own], n[own]
            w = weights(own_z, own_n)
            bias = -bias_z * alpha / (beta + bias_n**0.5)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -50, 50))) - labels[row]
            square = gradient * gradient
            z[own] = own_z + gradient - (np.sqrt(own_n + square) - np.sqrt(own_n)) / alpha * w
            n[own] = own_n + square
            bias_z += gradient - ((bias_n + square) ** 0.5 - bias_n**0.5) / alpha * bias
            bias_n += square
    return weights(z, n), -bias_z * alpha / (beta + bias_n**0.5)


def logistic(margins: np.ndarray, labels: np.ndarray, counts: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of the logistic curve of labels over margins, by Newton steps; ``counts`` weigh the rows."""
    x = np.stack([margins, np.ones_like(margins)], 1)
    own = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ own, -50, 50)))
        pull = x.T @ (counts * (p - labels)) + 1e-3 * (own - [1.0, 0.0]) * counts.sum()
        bend = (x * (counts * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2) * counts.sum()
        step = np.linalg.solve(bend, pull)
        own = own - step
        if np.abs(step).max() < 1e-9:
            break
    return float(own[0]), float(own[1])


def learnable(doc_id: Column) -> Column:
    """Rows that may be learned from: four fifths by the id's crc32, never rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
    sample_features: int = SAMPLE_FEATURES,
    **options,
) -> Model:
    """The model of the labelled rows that may be learned from."""
    named = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"))
    named = named.where(learnable(F.col("id")) & F.col("label").isNotNull())
    named = named.groupBy("id").agg(F.max((F.col("label") != 0).cast("int")).alias("label"))
    named = materialise(named, "labels")
    count = dict(named.groupBy("label").count().collect())
    total = sum(count.values())
    share = count.get(1, 0) / total if total else 0.0
    nothing = np.zeros(0)
    if not 0 < share < 1:
        odds = np.log(share / (1 - share)) if 0 < share < 1 else (50.0 if share else -50.0)
        return Model(nothing.astype(np.uint32), nothing, odds)
    # Twice the sample of ids, as some have no text; then as many rows by their own hash, whatever an id brings.
    drawn = [named.where(f"label = {label}").orderBy(F.xxhash64("id"), "id").limit(2 * sample) for label in (0, 1)]
    drawn = drawn[0].unionByName(drawn[1])
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    own = own.where(learnable(F.col("id"))).join(F.broadcast(drawn), "id")
    rows = own.select("id", "label", F.xxhash64("id", "text").alias("row")).distinct()
    rows = materialise(rows, "labelled-rows")
    chosen = [rows.where(f"label = {label}").orderBy("row", "id").limit(sample) for label in (0, 1)]
    chosen = materialise(chosen[0].unionByName(chosen[1]), "sample")
    given = own.withColumn("row", F.xxhash64("id", "text")).join(F.broadcast(chosen.drop("label")), ["id", "row"])
    given = given.select("id", "row", "label", _distinct(F.col("text"), sample_features // 16).alias("features"))
    given = given.groupBy("id", "row", "label").agg(F.max("features").alias("features"))
    given = materialise(given.where("features IS NOT NULL"), "sample-features")
    sizes = given.select("id", "row", (F.length("features") / 4).cast("long").alias("n")).orderBy("row", "id").collect()
    room = np.searchsorted(np.cumsum([row["n"] for row in sizes]), sample_features, side="right")
    if room < len(sizes):
        row, own_id = sizes[room]["row"], sizes[room]["id"]
        given = given.where((F.col("row") < row) | (F.col("row") == row) & (F.col("id") < own_id))
    found = given.orderBy("row", "id").select("label", "features").collect()
    features = [np.frombuffer(row["features"], "<u4") for row in found]
    return learn(features, np.array([row["label"] for row in found], float), share, **options)


def learn(features: list[np.ndarray], labels: np.ndarray, share: float, least_docs: int = LEAST_DOCS, **options) -> Model:
    """The model of rows of distinct feature hashes, a fifth of which only fit the curve of the others' weights."""
    known = _frequent(features, least_docs)
    rows = [_places(own, known) for own in features]
    place = np.arange(len(rows)) % 5 == 0
    fitted = np.flatnonzero(~place).tolist()
    weights, bias = ftrl([rows[k] for k in fitted], labels[~place], len(known), **options)
    margins = np.array([bias + weights[rows[k]].sum() for k in np.flatnonzero(place).tolist()])
    # The sample is even, so rows of a class count as the class does among all labels.
    even = labels[place].mean() if place.any() else 0.5
    even = min(max(even, 1e-3), 1 - 1e-3)
    counts = np.where(labels[place] == 1, share / even, (1 - share) / (1 - even))
    slope, shift = logistic(margins, labels[place], counts)
    weights, bias = ftrl(rows, labels, len(known), **options)
    kept = np.flatnonzero(weights)
    return Model(known[kept], weights[kept], bias, slope, shift)


def _frequent(features: list[np.ndarray], least: int) -> np.ndarray:
    everything = np.sort(np.concatenate([*features, np.zeros(0, np.uint32)]))
    if len(everything) < least:
        return everything[:0]
    return np.unique(everything[least - 1 :][everything[least - 1 :] == everything[: len(everything) - least + 1]])


def _places(found: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the known ones among feature hashes."""
    if not len(known):
        return np.zeros(0, np.int32)
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    return at[known[at] == found].astype(np.int32)


def _distinct(text: Column, most: int) -> Column:
    """Distinct feature hashes of a text, null where there are more than ``most``."""

    @F.arrow_udf(T.BinaryType())
    def own(texts: pa.Array) -> pa.Array:
        featurer, out = Featurer(), []
        for one in texts_of(texts):
            found, held = np.zeros(0, np.uint32), True
            for part in featurer(one):
                found = np.unique(np.concatenate([found, part.astype(np.uint32)]))
                held = len(found) <= most
                if not held:
                    break
            out.append(found.astype("<u4").tobytes() if held else None)
        return pa.array(out, pa.binary())

    return own(text)


def _scores(texts: Iterator[pa.Array], known) -> Iterator[pa.Array]:
    model, featurer = known.value, Featurer()
    low = np.zeros(1 << 20, bool)  # most features end here
    low[model.features & 0xFFFFF] = True
    for batch in texts:
        margins = []
        for text in texts_of(batch):
            places = [np.zeros(0, np.int32)]
            for part in featurer(text):
                places.append(_places(part[low[part & np.uint64(0xFFFFF)]].astype(np.uint32), model.features))
            margins.append(model.margin(np.concatenate(places)))
        yield pa.array(model.probability(np.array(margins, float)))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "toxicity") -> DataFrame:
    """The documents with the probability of being toxic; ``into`` gets underscores where there is such a column."""
    known = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return _scores(texts, known)

    return docs.withColumn(free_name(docs, into), score.asNondeterministic()(F.col(f"`{text_col}`").cast("string")))
