"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 that follows from the letter alone. A run of three letters is bound
by multiplying their vectors after rotating the first twice and the second once; a text is the sum of its bound
runs, a language the sum of its training texts at unit length. A text gets the language whose profile has the
largest cosine with it.

Letters are what Unicode calls alphabetic, in small case; everything else separates words and stands once
between them. Profiles are learned from an expected ``TRAIN_DOCS`` texts a language, chosen by a hash of the id.

Nulls: a null text, or one without a letter, is ``und`` with score 0. Rows with a null id or language are never
learned from. Ties go to the language that comes first by name. Repeated rows count as often as they occur.
Without any training row every text is ``und``. An empty table gives no rows. Very long texts are taken in
slices that are added up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope.llm.frames import free_name

DIMENSIONS = 1024
SEED = 7
TRAIN_DOCS = 1_000
MOST_LANGUAGES = 4_096
UNKNOWN = "und"
SLICE = 400_000  # characters taken at once
CHUNK_DOCS, CHUNK_LETTERS = 256, 600_000
SCALE = 1 << 20  # training vectors are added as whole numbers, so that the order of adding doesn't matter
MOST_TABLE = 8_000_000
GAP = 32

PREDICTION = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


class Letters:
    """Letters seen by this worker, numbered as they come, and their vectors."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.number = np.full(0x110000, -1, np.int32)  # 0: not a letter
        self.vectors = np.empty((64, dimensions), np.int8)
        self.count = 0
        self._add(GAP)

    def _add(self, code: int) -> None:
        if self.count == len(self.vectors):
            self.vectors = np.concatenate([self.vectors, np.empty_like(self.vectors)])
        signs = np.random.default_rng([self.seed, code]).integers(0, 2, self.dimensions, np.int8)
        self.vectors[self.count] = 2 * signs - 1
        self.number[code] = self.count
        self.count += 1

    def numbers(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
        found = self.number[codes]
        if (found < 0).any():
            for code in np.unique(codes[found < 0]).tolist():
                if chr(code).isalpha():
                    self._add(code)
                else:
                    self.number[code] = 0
            found = self.number[codes]
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != 0) | (found[:-1] != 0)
        return found[keep]

    def bound(self, runs: np.ndarray) -> np.ndarray:
        """Vectors of runs of three, numbered in base ``count``."""
        first, rest = np.divmod(runs, self.count * self.count)
        second, third = np.divmod(rest, self.count)
        rolled = np.roll(self.vectors[first], 2, 1) * np.roll(self.vectors[second], 1, 1)
        return (rolled * self.vectors[third]).astype(np.float32)


class Profiler:
    """Sums of bound runs for texts, many texts at a time."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.letters = Letters(dimensions, seed)

    def _chunk(self, pieces: list[tuple[int, np.ndarray]], rows: int) -> np.ndarray:
        base = self.letters.count
        runs = np.concatenate([(n[:-2].astype(np.int64) * base + n[1:-1]) * base + n[2:] for _, n in pieces])
        owner = np.repeat([row for row, _ in pieces], [len(n) - 2 for _, n in pieces])
        if base**3 <= MOST_TABLE:
            seen = np.zeros(base**3, bool)
            seen[runs] = True
            distinct = np.flatnonzero(seen)
            place = np.zeros(base**3, np.int32)
            place[distinct] = np.arange(len(distinct))
            column = place[runs]
        else:
            distinct, column = np.unique(runs, return_inverse=True)
        out = np.zeros((rows, self.letters.dimensions), np.float64)
        for at in range(0, len(distinct), 4_096):  # bounds the vectors held at once
            some = distinct[at : at + 4_096]
            own = (column >= at) & (column < at + len(some)) if len(distinct) > 4_096 else slice(None)
            cells = owner[own] * len(some) + (column[own] - at)
            counts = np.bincount(cells, minlength=rows * len(some)).reshape(rows, len(some))
            out += counts.astype(np.float32) @ self.letters.bound(some)
        return out

    def sums(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(first, end, sums) for stretches of the texts; a text without a letter has the zero vector."""
        first = 0
        while first < len(texts):
            end, total, size, pieces = first, None, 0, []

            def flush(rows: int):
                nonlocal total, size, pieces
                if pieces:
                    part = self._chunk(pieces, rows)
                    total = part if total is None else np.pad(total, ((0, rows - len(total)), (0, 0))) + part
                size, pieces = 0, []

            while end < len(texts) and end - first < CHUNK_DOCS and total is None:
                text, last = texts[end] or "", np.zeros(1, np.int32)
                for at in range(0, len(text), SLICE):
                    numbers = self.letters.numbers(text[at : at + SLICE])
                    if last[-1] == 0 and len(numbers) and numbers[0] == 0:
                        numbers = numbers[1:]
                    if at + SLICE >= len(text) and (numbers[-1] if len(numbers) else last[-1]):
                        numbers = np.append(numbers, np.int32(0))
                    numbers = np.concatenate([last, numbers])
                    if len(numbers) > 2:
                        pieces.append((end - first, numbers))
                        size += len(numbers)
                    last = numbers[-2:]
                    if size >= CHUNK_LETTERS:
                        flush(end - first + 1)
                end += 1
            flush(end - first)
            if total is None:
                total = np.zeros((end - first, self.letters.dimensions))
            yield first, end, np.pad(total, ((0, end - first - len(total)), (0, 0)))
            first = end


def _training(batches: Iterator[pa.RecordBatch], dimensions: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Sums of unit text vectors by language, as whole numbers."""
    profiler, totals = Profiler(dimensions, seed), {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, end, sums in profiler.sums(batch.column(1).to_pylist()):
            size = np.linalg.norm(sums, axis=1, keepdims=True)
            units = np.rint(SCALE * sums / np.where(size == 0, 1, size)).astype(np.int64)
            for lang, unit in zip(langs[first:end], units, strict=True):
                totals[lang] = totals.get(lang, 0) + unit
    if totals:
        columns = [pa.array([*totals], pa.string()), pa.array([*totals.values()], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["lang", "total"])


def learn(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    train_docs: int = TRAIN_DOCS,
    dimensions: int = DIMENSIONS,
    seed: int = SEED,
) -> tuple[list[str], np.ndarray]:
    """Language names and their profiles at unit length; at most ``MOST_LANGUAGES`` languages."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("string").alias("id"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).where("id is not null and lang is not null")
    counts = {lang: n for lang, n in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return [], np.zeros((0, dimensions))
    shares = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, train_docs / n))])
    chosen = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.lit(1_000_000) * shares[F.col("lang")])
    sums = chosen.select("lang", "text").mapInArrow(
        partial(_training, dimensions=dimensions, seed=seed), "lang string, total array<long>"
    )
    cells = sums.select("lang", F.posexplode("total")).groupBy("lang", "pos").agg(F.sum("col").alias("total"))
    langs = sorted(counts)
    place, profiles = {lang: n for n, lang in enumerate(langs)}, np.zeros((len(langs), dimensions))
    for lang, pos, total in cells.collect():  # languages x dimensions
        profiles[place[lang], pos] = total / SCALE
    sizes = np.linalg.norm(profiles, axis=1, keepdims=True)
    return langs, profiles / np.where(sizes == 0, 1, sizes)


def predict(text: Column, langs: list[str], profiles: np.ndarray, seed: int = SEED) -> Column:
    """Struct of language and score (cosine, not below 0) of a text column."""

    @F.arrow_udf(PREDICTION)
    def own(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        profiler = Profiler(profiles.shape[1], seed)
        for batch in texts:
            names, scores = [], []
            parts = (batch.slice(at, CHUNK_DOCS).to_pylist() for at in range(0, len(batch), CHUNK_DOCS))
            for _, _, sums in chain.from_iterable(map(profiler.sums, parts)):
                size = np.linalg.norm(sums, axis=1)
                if not langs:
                    size[:] = 0
                cosines = (sums @ profiles.T) / np.where(size == 0, 1, size)[:, None] if langs else sums[:, :1]
                best = cosines.argmax(1)
                names += [langs[b] if s else UNKNOWN for b, s in zip(best.tolist(), size.tolist(), strict=True)]
                scores.append(np.where(size == 0, 0.0, cosines.max(1).clip(0, 1)))
            score = np.concatenate([*scores, np.empty(0)])
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score)], ["lang", "score"])

    return own.asNondeterministic()(text)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: a quarter by the id's crc32, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    into: str = "language",
    **options,
) -> DataFrame:
    """The documents with the struct of ``predict``, learned from their own labelled rows that aren't held out.

    Further columns are kept; ``into`` gets underscores where there is such a column.
    """
    langs, profiles = learn(docs.where(~held_out(F.col(f"`{id_col}`"))), id_col, text_col, lang_col, **options)
    return docs.withColumn(free_name(docs, into), predict(F.col(f"`{text_col}`").cast("string"), langs, profiles))


def known_language(docs: DataFrame, **options) -> DataFrame:
    """The documents with a language, without those that are ``und``."""
    into = free_name(docs, "language")
    found = identify(docs, into=into, **options)
    return found.where(F.col(f"{into}.lang") != UNKNOWN).drop(into)
