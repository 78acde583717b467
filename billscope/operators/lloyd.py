"""KMeans in rounds of Spark aggregates over whole numbers.

Each round assigns every row to its nearest centre and adds up counts and features per centre. The sums are of whole
numbers, so they don't depend on how rows are placed or how many tasks there are: the same rows give the same segments
on any cluster, and the work spreads over as many tasks as the table has. The first centres are fitted on the rows
with the smallest hashes of their keys, a bounded number that is the same however rows are placed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from operator import add, or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema
from billscope.work import job_folder, materialise

AMOUNT = "avg_bill_amount"
FEATURES = (AMOUNT, "hospital_index", "insurance_index", "quarter")
#: Whole units of a feature that isn't whole itself.
UNITS = {AMOUNT: 100}
ROUNDS, TOLERANCE = 20, 1e-4
SAMPLE, RESTARTS, SAMPLE_ROUNDS = 4096, 8, 100
#: Row groups of the rounds' work table, small so that a table in few files is still read by many tasks.
ROW_GROUP = {"parquet.block.size": str(8 * 1024**2)}


@dataclass(frozen=True)
class Centres:
    """Centres by rising first feature, and what each feature's squared difference counts."""

    columns: tuple[str, ...]
    points: tuple[tuple[float, ...], ...]
    weights: tuple[float, ...]
    rounds: int

    def centers(self) -> list[list[float]]:
        return [list(point) for point in self.points]


def _whole(column: str) -> Column:
    """A feature in its units, exact for cents and ranks."""
    return F.round(F.col(column) * UNITS.get(column, 1)).cast("bigint")


def _distances(columns: Sequence[str], points: Sequence[Sequence[float]], weights: Sequence[float]) -> Column:
    def squared(point: Sequence[float]) -> Column:
        differences = [F.col(name).cast("double") - F.lit(float(value)) for name, value in zip(columns, point, strict=True)]
        return reduce(add, [d * d * F.lit(float(w)) for d, w in zip(differences, weights, strict=True)])

    return F.array(*[squared(point) for point in points])


def _nearest(columns: Sequence[str], points: Sequence[Sequence[float]], weights: Sequence[float]) -> Column:
    distances = _distances(columns, points, weights)
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")


def _with_centre(
    numbers: DataFrame, columns: Sequence[str], points: Sequence[Sequence[float]], weights: Sequence[float]
) -> DataFrame:
    """``numbers`` with the number of ``_nearest`` as column ``centre``; a missing feature has none.

    Points come as one broadcast row and not as constants: those would change the generated code with every round, and
    each round would run code that is compiled anew.
    """
    names = [[f"point_{n}_{m}" for m in range(len(columns))] for n in range(len(points))]
    fields = T.StructType([T.StructField(name, T.DoubleType(), False) for own in names for name in own])
    values = tuple(float(value) for point in points for value in point)
    rows = numbers.crossJoin(F.broadcast(numbers.sparkSession.createDataFrame([values], fields)))
    far, distances = [f"distance_{n}" for n in range(len(points))], []
    for own in names:
        differences = [F.col(column) - F.col(name) for column, name in zip(columns, own, strict=True)]
        distances.append(reduce(add, [d * d * F.lit(float(w)) for d, w in zip(differences, weights, strict=True)]))
    rows = rows.select(*numbers.columns, *[d.alias(name) for d, name in zip(distances, far, strict=True)])
    rows = rows.withColumn("least", F.least(*far) if len(far) > 1 else F.col(far[0]))
    centre = F.coalesce(*[F.when(F.col(name) == F.col("least"), n) for n, name in enumerate(far)])
    return rows.select(*numbers.columns, centre.alias("centre"))


def _scales(rows: DataFrame, columns: Sequence[str], scale: bool) -> list[float]:
    """One over each feature's variance, from exact sums; 0 for a feature that is the same everywhere."""
    if not scale:
        return [1.0] * len(columns)
    wide = {name: _whole(name).cast("decimal(19,0)") for name in columns}
    sums = [F.sum(wide[name]).alias(f"{name}_1") for name in columns]
    squares = [F.sum((wide[name] * wide[name]).cast("decimal(28,0)")).alias(f"{name}_2") for name in columns]
    total = rows.agg(F.count(F.lit(1)).alias("n"), *sums, *squares).first()
    found = []
    for name in columns:
        one, two, n = int(total[f"{name}_1"]), int(total[f"{name}_2"]), total["n"]
        variance = Fraction(two * n - one * one, n * max(n - 1, 1)) / UNITS.get(name, 1) ** 2
        found.append(float(1 / variance) if variance else 0.0)
    return found


def _sampled(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], sample: int) -> np.ndarray:
    first = F.xxhash64(*keys).alias("_hash")
    chosen = rows.select(*[F.col(name).cast("double").alias(f"_{n}") for n, name in enumerate(columns)], first, *keys)
    chosen = chosen.orderBy("_hash", *keys).limit(sample).collect()
    return np.array([[row[f"_{n}"] for n in range(len(columns))] for row in chosen], float).reshape(-1, len(columns))


def _first_centres(sample: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres of the cheapest of several fits of the sample, each begun far apart by chance that ``seed`` fixes."""
    distinct = np.unique(sample * np.sqrt(weights), axis=0, return_index=True)[1]
    points = sample[np.sort(distinct)]
    if len(points) <= k:
        return points
    scaled, best, least = sample * np.sqrt(weights), None, np.inf
    for restart in range(RESTARTS):
        rng = np.random.default_rng([seed, restart])
        centres = scaled[rng.integers(len(scaled))][None]
        while len(centres) < k:
            near = ((scaled[:, None] - centres) ** 2).sum(2).min(1)
            place = np.searchsorted(np.cumsum(near), rng.random() * near.sum(), side="right")
            centres = np.concatenate([centres, scaled[min(place, len(scaled) - 1)][None]])
        for _ in range(SAMPLE_ROUNDS):
            distances = ((scaled[:, None] - centres) ** 2).sum(2)
            own = distances.argmin(1)
            now = np.array([scaled[own == c].mean(0) if (own == c).any() else centres[c] for c in range(k)])
            if np.abs(now - centres).max() <= TOLERANCE:
                break
            centres = now
        cost = distances.min(1).sum()
        if cost < least:
            least, best = cost, np.array([sample[own == c].mean(0) for c in range(k) if (own == c).any()])
    return best


def fit(
    rows: DataFrame,
    k: int = schema.SEGMENT_COUNT,
    seed: int = schema.SEGMENT_SEED,
    scale: bool = False,
    keys: Sequence[str] = schema.QUARTER_KEYS,
    columns: Sequence[str] = FEATURES,
    rounds: int = ROUNDS,
    tolerance: float = TOLERANCE,
    sample: int = SAMPLE,
) -> Centres:
    """Fit ``k`` centres on ``rows``, a work table whose ``keys`` tell its rows apart; a missing feature is an error.

    With fewer different rows than ``k`` each is a centre. A centre that no row is nearest to stays where it is.
    """
    weights = _scales(rows, columns, scale)
    sampled = _sampled(rows, columns, keys, sample)
    if np.isnan(sampled).any():
        raise ValueError("a feature is missing")
    first = _first_centres(sampled, np.array(weights), k, seed)
    points = [tuple(map(float, point)) for point in first]
    if not points or rounds < 1:
        return Centres(tuple(columns), tuple(sorted(points)), tuple(weights), 0)
    with job_folder(rows.sparkSession, "fit"):
        # Rounds read only numbers, converted once.
        doubles = [F.col(name).cast("double").alias(f"at_{n}") for n, name in enumerate(columns)]
        whole = [_whole(name).alias(f"whole_{n}") for n, name in enumerate(columns)]
        numbers = materialise(rows.select(*doubles, *whole), "numbers", **ROW_GROUP)
        points, done = _rounds(numbers, columns, points, weights, rounds, tolerance)
    return Centres(tuple(columns), tuple(sorted(points)), tuple(weights), done)


def _rounds(
    numbers: DataFrame,
    columns: Sequence[str],
    points: list[tuple[float, ...]],
    weights: Sequence[float],
    rounds: int,
    tolerance: float,
) -> tuple[list[tuple[float, ...]], int]:
    """Move the points until they stand still or the rounds are over; returns them and the rounds done."""
    places = [f"at_{n}" for n in range(len(columns))]
    missing = F.count_if(reduce(or_, [F.col(place).isNull() for place in places])).alias("missing")
    sums = [F.sum(f"whole_{n}").alias(f"sum_{n}") for n in range(len(columns))]
    done = 0
    while done < rounds:
        done += 1
        near = _with_centre(numbers, places, points, weights)
        found = near.groupBy("centre").agg(F.count(F.lit(1)).alias("n"), missing, *sums).collect()
        if any(row["missing"] for row in found):
            raise ValueError("a feature is missing")
        moved, now = 0.0, list(points)
        for row in found:
            at = row["centre"]
            now[at] = tuple(
                float(Fraction(row[f"sum_{n}"], row["n"] * UNITS.get(name, 1))) for n, name in enumerate(columns)
            )
            moved = max(moved, sum(w * (a - b) ** 2 for w, a, b in zip(weights, now[at], points[at], strict=True)))
        points = now
        if moved <= tolerance**2:
            break
    return points, done


def score(centres: Centres, rows: DataFrame) -> DataFrame:
    """Assign every row to its nearest centre, as column ``prediction``: the centre's number by rising amount."""
    return rows.withColumn("prediction", _nearest(centres.columns, centres.points, centres.weights))


def cost(centres: Centres, rows: DataFrame) -> float:
    """Sum of the rows' squared distances to their centres."""
    return rows.agg(F.sum(F.array_min(_distances(centres.columns, centres.points, centres.weights)))).first()[0]
