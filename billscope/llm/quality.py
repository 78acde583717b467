"""Quality classification by co-training of two views.

One classifier sees the text (words and its shape), the other the metadata (source, language, length). Over some
rounds each scores all unlabelled documents in Spark and labels every one it is sure of for the other; the rounds
end early when no view has anything new to learn from. Their scores are calibrated on labelled documents kept out
of training and combined by a third, small fit there, so a view that knows nothing gets no weight. All are
logistic regressions in numpy.

The labelled ones are at most ``LABELLED`` documents of ``SAMPLE_BYTES`` together, chosen by a hash of id and content;
documents equal in both are learned from once. All words, beginnings of
words and metadata values are features, at a place given by a hash, and those of texts count by how well they
tell the classes apart, so none is too rare to be learned. Documents that a view was given are dealt to tasks, about ``FIT_ROWS`` each; every task fits them along with the labelled
ones, and the view's weights are the mean of the tasks' by their documents.

Nulls: a null text is empty, null metadata is a value of its own; rows with a null id or label are not learned
from. Of several labels of an id the smallest counts. Where the sample lacks one of the two classes, every
document gets the share of the class that is there. Repeated rows get the same answer each. An empty table gives
no rows. Other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm.decontaminate import words_of
from billscope.llm.frames import SLICE, as_bytes, free_name, texts_of
from billscope.work import materialise

LABELLED, SAMPLE_BYTES = 6_000, 256_000_000
BEGINNING = 5
ROUNDS, SURE = 3, 0.98
TERM_PLACES, VALUE_PLACES = 1 << 22, 1 << 16  # places that terms and metadata values are hashed to
FIT_ROWS = 50_000  # exchanged documents that a task fits
MOST_TERMS, REMEMBERED = 250_000, 100  # distinct terms whose places a worker remembers, and bytes of such a term
SLICE_PLACES = 1 << 16  # weights that are averaged together
CLEAR, POWER = 16.0, 2  # G statistic from which a place counts in full, and how fast it counts less below
PARTS = 1_000_000

SCORES = T.StructType([T.StructField(name, T.DoubleType()) for name in ("score", "text_score", "meta_score")])


@dataclass
class Rows:
    """Sparse rows: places and values of each row, one after the other."""

    bounds: list[int] = field(default_factory=lambda: [0])
    places: list[np.ndarray] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def add(self, places: np.ndarray, values: np.ndarray) -> None:
        self.places.append(places)
        self.values.append(values)
        self.bounds.append(self.bounds[-1] + len(places))

    def __len__(self) -> int:
        return len(self.places)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        if not self.places:
            return np.empty(0)
        products = weights[np.concatenate(self.places)] * np.concatenate(self.values)
        return np.add.reduceat(products, self.bounds[:-1])  # every row has a place

    def some(self, chosen: np.ndarray) -> Rows:
        out = Rows()
        for n in chosen.tolist():
            out.add(self.places[n], self.values[n])
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def strengths(places: np.ndarray, owners: np.ndarray, labels: np.ndarray, share: np.ndarray, size: int) -> np.ndarray:
    """From 0 to 1, how well having a place tells the classes apart: by the G statistic of its rows' labels.

    ``share`` is the number of documents a row stands for. Words of one document tell next to nothing and words of
    a few documents of the rarer class much, however rare they are.
    """
    rows = np.bincount(places, weights=share[owners], minlength=size)
    ones = np.bincount(places, weights=(share * labels)[owners], minlength=size)
    overall = np.clip((share * labels).sum() / share.sum(), 1e-9, 1 - 1e-9)
    own = ones / rows
    told = sum(rows * p * np.log(np.maximum(p, 1e-300) / q) for p, q in ((own, overall), (1 - own, 1 - overall)))
    return np.minimum(1.0, 2 * np.maximum(told, 0.0) / CLEAR) ** POWER


def fit(
    rows: Rows,
    labels: np.ndarray,
    size: int,
    steps: int = 150,
    penalty: float = 1e-3,
    counts: np.ndarray | None = None,
    dense: int | None = None,
) -> np.ndarray:
    """Weights of a logistic regression, by Adam over all rows, of which each stands for ``counts`` equal ones.

    Places from ``dense`` on count by their strength. Places that no row has keep weight zero, so only the others
    are fitted.
    """
    whole, values = np.concatenate(rows.places), np.concatenate(rows.values)
    used, places = np.unique(whole, return_inverse=True)
    owners = np.repeat(np.arange(len(rows)), np.diff(rows.bounds))
    share = np.ones(len(rows)) if counts is None else counts
    scale = np.ones(len(used))
    if dense is not None:
        scale = np.where(used < dense, 1.0, strengths(places, owners, labels, share, len(used)))
    values = values * scale[places]
    share = share / share.sum()
    weights, mean, spread = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used))
    for step in range(1, steps + 1):
        wrong = share * (sigmoid(np.add.reduceat(weights[places] * values, rows.bounds[:-1])) - labels)
        grad = np.bincount(places, weights=values * wrong[owners], minlength=len(used)) + penalty * weights
        mean, spread = 0.9 * mean + 0.1 * grad, 0.99 * spread + 0.01 * grad**2
        rate = 0.1 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        weights = weights - rate * mean / (np.sqrt(spread) + 1e-9)
    out = np.zeros(size, np.float32)
    out[used] = weights * scale
    return out


def fit_small(columns: np.ndarray, labels: np.ndarray, steps: int = 25) -> np.ndarray:
    """Weights and constant of a logistic regression on a few columns, by Newton's method."""
    x = np.column_stack([columns, np.ones(len(columns))])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ weights)
        grad = x.T @ (p - labels) + 1e-2 * weights
        weights = weights - np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-2 * np.eye(len(weights)), grad)
    return weights


def terms(distinct: set[bytes]) -> set[bytes]:
    """Words, and the beginnings of longer ones, which stand for words seen too rarely to be learned."""
    return distinct.union(b"^" + word[:BEGINNING] for word in distinct if len(word) > BEGINNING)


def _shape(text: bytes, words: list[bytes], distinct: set[bytes]) -> list[float]:
    """What a text looks like, as shares between 0 and 1."""
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if text else np.zeros(256, np.int64)
    size, count = max(len(text), 1), max(len(words), 1)
    marks = int(seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum())
    return [
        1.0,
        len(distinct) / count,
        sum(map(eq, words, words[1:])) / count,
        marks / size,
        int(seen[65:91].sum()) / size,
        int(seen[48:58].sum()) / size,
        int(seen[124]) / size,
        int(seen[10]) / size,
        min(1.0, sum(map(len, words)) / count / 20),
        min(1.0, math.log1p(len(words)) / 10),
    ]


SHAPE = 10


class _Places(dict):
    """Places of terms by a hash, remembered unless they are long."""

    def __missing__(self, term: bytes) -> int:
        from xxhash import xxh64_intdigest

        place = SHAPE + xxh64_intdigest(term) % TERM_PLACES
        if len(term) <= REMEMBERED:
            if len(self) >= MOST_TERMS:
                self.clear()
            self[term] = place
        return place


@dataclass
class Views:
    """Places of the features: shape and words of the text; source, language and length of the metadata."""

    known: _Places = field(default_factory=_Places)

    text_size = SHAPE + TERM_PLACES
    meta_size = 64 + VALUE_PLACES

    def __reduce__(self):
        return Views, ()

    def text(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        words = words_of(text)
        distinct = set(words)
        places = np.array([*range(SHAPE), *sorted(set(map(self.known.__getitem__, terms(distinct))))], np.int32)
        values = np.ones(len(places))
        values[:SHAPE] = _shape(text or b"", words, distinct)
        values[1:SHAPE] *= 4
        return places, values

    def meta(self, source: str | None, lang: str | None, length: int) -> np.ndarray:
        from xxhash import xxh64_intdigest

        values = (f"source={source}", f"lang={lang}")
        bin_of_length = 1 + min(62, int(2 * math.log1p(max(length, 0))))
        return np.array([0, bin_of_length, *(64 + xxh64_intdigest(v.encode()) % VALUE_PLACES for v in values)], np.int32)

    def rows(self, texts, sources, langs, lengths) -> tuple[Rows, Rows]:
        text_rows, meta_rows = Rows(), Rows()
        for text, source, lang, length in zip(texts, sources, langs, lengths, strict=True):
            text_rows.add(*self.text(text))
            places = self.meta(source, lang, length or 0)
            meta_rows.add(places, np.ones(len(places)))
        return text_rows, meta_rows


@dataclass
class Model:
    """Weights of both views, their calibration (slope, constant) and the weights of the combination."""

    weights: tuple[np.ndarray, np.ndarray]
    calibration: tuple[np.ndarray, np.ndarray]
    combination: np.ndarray
    constant: float | None = None

    def scores(self, rows: tuple[Rows, Rows]) -> np.ndarray:
        """Combined score and the calibrated scores of both views, a row each."""
        if self.constant is not None:
            return np.full((3, len(rows[0])), self.constant)
        raw = [view.dot(w) for view, w in zip(rows, self.weights, strict=True)]
        own = [c[0] * r + c[1] for c, r in zip(self.calibration, raw, strict=True)]
        both = np.column_stack([*own, np.ones(len(own[0]))]) @ self.combination
        return sigmoid(np.stack([both, *own]))


def _exchanged(batches: Iterator[pa.RecordBatch], shared, asked: tuple[set, set]) -> Iterator[pa.RecordBatch]:
    """What a view is sure of, a row for each document, target and view that is told: its features and the label.

    ``asked`` holds the targets for which the text and the metadata view are asked.
    """
    views, models = shared.value
    kind = [("target", pa.int32()), ("told", pa.int32()), ("label", pa.int32()), ("own_id", pa.int64())]
    schema = pa.schema([*kind, ("places", pa.binary()), ("values", pa.binary())])
    for batch in batches:
        ids, *meta = (batch.column(n).to_pylist() for n in (0, 2, 3, 4))
        for at in range(0, len(ids), SLICE):
            texts = as_bytes(batch.column(1).slice(at, SLICE))
            metas = [views.meta(s, g, n or 0) for s, g, n in zip(*(m[at : at + SLICE] for m in meta), strict=True)]
            features = [[None] * len(texts), [(places, np.ones(len(places))) for places in metas]]
            if asked[0]:
                features[0] = [views.text(text) for text in texts]
            out = []
            for view in (0, 1):
                rows = Rows()
                for own in features[view] if asked[view] else ():
                    rows.add(*own)
                for number, (target, model) in enumerate(models.items()):
                    if target not in asked[view]:
                        continue
                    c = model.calibration[view]
                    sure = sigmoid(c[0] * rows.dot(model.weights[view]) + c[1])
                    for n in np.flatnonzero((sure >= SURE) | (sure <= 1 - SURE)).tolist():
                        places, values = features[1 - view][n] or views.text(texts[n])
                        own = ids[at + n], places.tobytes(), values.tobytes()
                        out.append((number, 1 - view, int(sure[n] >= SURE), *own))
            if out:
                columns = zip(zip(*out, strict=True), schema, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in columns], schema=schema)


def _fit_part(batches: Iterator[pa.RecordBatch], known, size: int, dense: int | None) -> Iterator[pa.RecordBatch]:
    """Weights of one task's exchanged rows and the labelled ones, in slices, times the documents they stand for."""
    labelled, labels = known.value
    rows, more, counts = Rows(), [], []
    for n in range(len(labelled)):
        rows.add(labelled.places[n], labelled.values[n])
    for batch in batches:
        for places, values, label, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.add(np.frombuffer(places, np.int32), np.frombuffer(values))
            more.append(label)
            counts.append(count)
    if not more:
        return
    each = np.concatenate([np.ones(len(labels)), counts])
    weights = fit(rows, np.concatenate([labels, more]).astype(float), size, counts=each, dense=dense) * np.float32(sum(counts))
    for at in range(0, size, SLICE_PLACES):
        own = weights[at : at + SLICE_PLACES]
        if own.any():
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([own.tobytes()])], ["at", "weights"])


def _sum_slices(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(w, np.float32).astype(float) for w in table["weights"].to_pylist())
    return pa.table({"at": table["at"][:1], "weights": [total.tobytes()]})


def _fit_all(rows: Rows, labels: np.ndarray, size: int, dense: int | None, given: DataFrame | None) -> np.ndarray:
    """Weights from the labelled rows and all ``given`` ones: places, values, label, count."""
    total = given.agg(F.count("*"), F.sum("count")).first() if given is not None else (0, 0)
    if not total[0]:
        return fit(rows, labels.astype(float), size, dense=dense)
    known = given.sparkSession.sparkContext.broadcast((rows, labels))
    dealt = given.select("places", "values", "label", "count").repartition(-(-total[0] // FIT_ROWS))
    parts = dealt.mapInArrow(partial(_fit_part, known=known, size=size, dense=dense), "at long, weights binary")
    weights = np.zeros(size, np.float32)
    for row in parts.groupBy("at").applyInArrow(_sum_slices, "at long, weights binary").collect():
        own = np.frombuffer(bytes(row["weights"]))
        weights[row["at"] : row["at"] + len(own)] = own / total[1]
    return weights


def co_train(
    rows: tuple[Rows, Rows],
    labels: dict[str, np.ndarray],
    fold: np.ndarray,
    docs: DataFrame,
    labelled: DataFrame,
    views: Views,
    rounds: int = ROUNDS,
) -> dict[str, Model]:
    """A model for each target from labelled rows, of which those whose ``fold`` is set calibrate.

    ``docs`` has own_id, text, source, lang, length; those whose id is in ``labelled`` are not exchanged.
    """
    models = {}
    train, check = np.flatnonzero(~fold), np.flatnonzero(fold)
    for target, own in labels.items():
        if any(len(np.unique(own[part])) < 2 for part in (train, check)):
            models[target] = Model((), (), np.empty(0), float(own.mean()) if len(own) else 0.5)
    open_targets = [target for target in labels if target not in models]
    if not open_targets:
        return models
    trained, checked = ([view.some(part) for view in rows] for part in (train, check))
    sizes = (views.text_size, SHAPE), (views.meta_size, None)
    given: dict[tuple[str, int], DataFrame | None] = {(t, view): None for t in open_targets for view in (0, 1)}
    weights, calibration = {}, {}
    asked = stale = set(given)
    for last in range(rounds + 1):
        for target, view in sorted(stale):
            own = labels[target]
            w = weights[target, view] = _fit_all(trained[view], own[train], *sizes[view], given[target, view])
            calibration[target, view] = fit_small(checked[view].dot(w)[:, None], own[check])
        if last == rounds:
            break
        told = {
            t: Model(tuple(weights[t, v] for v in (0, 1)), tuple(calibration[t, v] for v in (0, 1)), np.empty(0))
            for t in open_targets
        }
        # Only a view whose weights are new can be sure of other documents than before.
        by_view = tuple({t for t, view in asked if view == v} for v in (0, 1))
        shared = docs.sparkSession.sparkContext.broadcast((views, told))
        schema = "target int, told int, label int, own_id long, places binary, values binary"
        found = docs.mapInArrow(partial(_exchanged, shared=shared, asked=by_view), schema)
        found = found.join(labelled, "own_id", "left_anti")
        found = found.groupBy("target", "told", "label", "places", "values").count()
        found = materialise(found, "exchanged")
        filled = {(row["target"], row["told"]) for row in found.select("target", "told").distinct().collect()}
        stale = set()
        for target, view in {(t, 1 - v) for t, v in asked}:
            number = open_targets.index(target), view
            if number in filled or given[target, view] is not None:
                given[target, view] = found.where((F.col("target") == number[0]) & (F.col("told") == view))
                stale.add((target, view))
        asked = stale
        if not stale:
            break
    for target in open_targets:
        w, c = (tuple(of[target, view] for view in (0, 1)) for of in (weights, calibration))
        own = np.column_stack([c[v][0] * checked[v].dot(w[v]) + c[v][1] for v in (0, 1)])
        models[target] = Model(w, c, fit_small(own, labels[target][check]))
    return {target: models[target] for target in labels}


def _features(batches: Iterator[pa.RecordBatch], views: Views) -> Iterator[pa.RecordBatch]:
    """Text features of the sample as bytes."""
    for batch in batches:
        own = [views.text(text) for text in as_bytes(batch.column(2))]
        found = [pa.array([row[n].tobytes() for row in own], pa.binary()) for n in (0, 1)]
        names = ["own_id", "row", "places", "values", "source", "lang", "length", "labels", "fold"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *found, *batch.columns[3:]], names)


def _columns(docs: DataFrame, text_col: str, source_col: str, lang_col: str, length_col: str) -> list[Column]:
    def own(name: str, kind: str) -> Column:
        return F.col(f"`{name}`").cast(kind)

    return [
        own(text_col, "string").alias("text"),
        own(source_col, "string").alias("source"),
        own(lang_col, "string").alias("lang"),
        own(length_col, "long").alias("length"),
    ]


def learn(
    docs: DataFrame,
    labels: DataFrame,
    targets: tuple[str, ...],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    length_col: str = "n_chars",
    labelled: int = LABELLED,
    sample_bytes: int = SAMPLE_BYTES,
) -> tuple[Views, dict[str, Model]]:
    """Views and one model for each 0/1 column of ``labels``."""

    def share(total: int, wanted: int) -> int:
        return int(PARTS * min(1.0, wanted / max(total, 1)))

    own_id = F.col(f"`{id_col}`").cast("long").alias("own_id")
    usable = labels.select(own_id, *[F.col(f"`{t}`").cast("int").alias(t) for t in targets])
    usable = usable.where(" and ".join(["own_id is not null", *[f"`{t}` in (0, 1)" for t in targets]]))
    draw = F.pmod(F.xxhash64("own_id", F.lit("draw")), F.lit(PARTS))
    chosen = usable.where(draw < share(usable.count(), labelled)).groupBy("own_id")
    chosen = chosen.agg(F.array(*[F.min(t) for t in targets]).alias("labels"))
    all_docs = docs.select(own_id, *_columns(docs, text_col, source_col, lang_col, length_col)).where("own_id is not null")
    # One id may be on very many rows, so rows are drawn from those of the drawn ids, and bounded by their bytes too.
    given = all_docs.join(F.broadcast(chosen), "own_id").withColumn("row", F.xxhash64("own_id", "text", "source", "lang", "length"))
    drawn = given.select("own_id", "row", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")).distinct()
    drawn = materialise(drawn.orderBy("row", "own_id").limit(labelled), "labelled")
    up_to = F.sum("bytes").over(Window.orderBy("row", "own_id"))  # at most ``labelled`` small rows
    drawn = drawn.withColumn("up_to", up_to).where(F.col("up_to") <= sample_bytes).select("own_id", "row")
    fold = (F.pmod(F.xxhash64("own_id", F.lit("fold")), F.lit(4)) == 0).alias("fold")
    columns = "own_id", "row", "text", "source", "lang", "length", "labels", fold
    sample = given.join(F.broadcast(drawn), ["own_id", "row"], "left_semi").select(*columns)
    views = Views()
    schema = "own_id long, row long, places binary, values binary, source string, lang string, length long, labels array<int>, fold boolean"
    found = sample.mapInArrow(partial(_features, views=views), schema).groupBy("own_id", "row")
    found = found.agg(F.max(F.struct("places", "values", "source", "lang", "length", "labels", "fold")).alias("one"))
    found = found.orderBy("row", "own_id").select("one.*").collect()
    text_rows, meta_rows = Rows(), Rows()
    for row in found:
        text_rows.add(np.frombuffer(bytes(row["places"]), np.int32), np.frombuffer(bytes(row["values"])))
        places = views.meta(row["source"], row["lang"], row["length"] or 0)
        meta_rows.add(places, np.ones(len(places)))
    folds = np.array([row["fold"] for row in found], bool)
    known = {target: np.array([row["labels"][n] for row in found], int) for n, target in enumerate(targets)}
    ids = usable.select("own_id").distinct()
    return views, co_train((text_rows, meta_rows), known, folds, all_docs, ids, views)


def score(docs: DataFrame, views: Views, models: dict[str, Model], **columns: str) -> DataFrame:
    """The documents with a struct (score, text_score, meta_score) for each target, named after it.

    Further columns are kept; a struct gets underscores before its name where there is such a column.
    """
    names = {"text_col": "text", "source_col": "source", "lang_col": "lang", "length_col": "n_chars"} | columns
    broadcast = docs.sparkSession.sparkContext.broadcast((views, models))
    kind = T.StructType([T.StructField(target, SCORES) for target in models])

    @F.arrow_udf(kind)
    def own(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        views, models = broadcast.value
        for texts, sources, langs, lengths in batches:
            rows = views.rows(texts_of(texts), sources.to_pylist(), langs.to_pylist(), lengths.to_pylist())
            out = []
            for model in models.values():
                columns = [pa.array(column) for column in model.scores(rows)]
                out.append(pa.StructArray.from_arrays(columns, names=SCORES.names))
            yield pa.StructArray.from_arrays(out, names=[*models])

    scores = free_name(docs, "scores")
    scored = docs.withColumn(scores, own.asNondeterministic()(*_columns(docs, **names)))
    found = [F.col(f"{scores}.`{target}`").alias(free_name(docs, target)) for target in models]
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns], *found)
