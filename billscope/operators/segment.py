"""Spending segments: KMeans over average bills, named by where a segment's mean falls."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import money
from billscope.operators import lookup
from billscope.operators.ordered import running_total
from billscope.work import checkpoint, materialise

AMOUNT = "avg_bill_amount"
FEATURES = (AMOUNT, "hospital_index", "insurance_index", "quarter")
# The fit's start depends on the number of partitions, so it is fixed and never follows the data; set more for
# tables whose averages don't fit into this many tasks.
FIT_PARTITIONS = 16


def string_index(rows: DataFrame, column: str) -> DataFrame:
    """Index of each label by falling frequency, equal frequencies in label order, from 0.

    The labels stay distributed: their number may grow with the data.
    """
    return string_indexes(rows, [column])[column]


def string_indexes(rows: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """``string_index`` of several text columns in one pass over ``rows``."""
    labels = F.array(*[F.struct(F.lit(n).alias("number"), F.col(c).alias("label")) for n, c in enumerate(columns)])
    pairs = rows.select(F.inline(labels)).filter(F.col("label").isNotNull())
    counts = pairs.groupBy("number", "label").agg(F.count(F.lit(1)).alias("frequency"))
    ranked = running_total(counts, [F.asc("number"), F.desc("frequency"), F.asc("label")], F.lit(1), "rank")
    ranked = materialise(ranked.select("number", "label", "frequency", "rank"), "indexes")
    out = {}
    for number, column in enumerate(columns):
        own = ranked.filter(F.col("number") == number)
        first = own.agg(F.min("rank").alias("first")).scalar()
        index = (F.col("rank") - first).cast("double").alias("label_index")
        out[column] = own.select(F.col("label").alias(column), "frequency", index)
    return out


def feature_columns(rows: DataFrame, hospitals: DataFrame, payers: DataFrame) -> DataFrame:
    """Add the indexes of hospital and payer; ``rows`` should be a work table."""
    hospitals = hospitals.withColumnRenamed("label_index", "hospital_index")
    payers = payers.withColumnRenamed("label_index", "insurance_index")
    indexed = lookup.attach(rows, hospitals, "hospital", "frequency")
    return lookup.attach(indexed, payers, "insurance_provider", "frequency")


def features(rows: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Assemble the feature vector; a NULL feature is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows)


@dataclass(frozen=True)
class Segmentation:
    model: KMeansModel
    scaler: StandardScalerModel | None
    rank_of: tuple[int, ...]

    def centers(self) -> list[list[float]]:
        """Centres in the order of the segment numbers."""
        centers = self.model.clusterCenters()
        return [list(map(float, centers[self.rank_of.index(rank)])) for rank in range(len(centers))]


def fit(
    vectors: DataFrame,
    k: int = schema.SEGMENT_COUNT,
    seed: int = schema.SEGMENT_SEED,
    scale: bool = False,
    partitions: int = FIT_PARTITIONS,
    keys: Sequence[str] = schema.QUARTER_KEYS,
) -> Segmentation:
    """Fit KMeans so that the same rows give the same segments.

    KMeans draws its start per partition, so rows are first put into a fixed number of partitions by key
    and sorted there: neither the layout of the input nor the size of the cluster then matters. Another
    number of partitions gives other segments, so the number is a parameter with a fixed default, whatever
    the number of rows. Segments are numbered by rising mean amount.
    """
    placed = vectors.repartition(partitions, *keys).sortWithinPartitions(*keys)
    # The fit evaluates its input several times, and each of its rounds must see the same partitions.
    placed = checkpoint(placed.select("features"))
    scaler, column = None, "features"
    if scale:
        column = "scaled_features"
        scaler = StandardScaler(inputCol="features", outputCol=column).fit(placed)
        placed = scaler.transform(placed)
    # Naming the solver spares a pass that chooses between the two.
    model = KMeans(k=k, seed=seed, featuresCol=column, solver="row").fit(placed.select(column))
    amounts = [center[0] for center in model.clusterCenters()]
    by_amount = sorted(range(len(amounts)), key=lambda cluster: (amounts[cluster], cluster))
    return Segmentation(model, scaler, tuple(by_amount.index(cluster) for cluster in range(len(amounts))))


def score(segmentation: Segmentation, vectors: DataFrame) -> DataFrame:
    """Assign every row to its nearest centre, as column ``prediction``."""
    if segmentation.scaler is not None:
        vectors = segmentation.scaler.transform(vectors)
    numbers = F.array(*[F.lit(rank) for rank in segmentation.rank_of])
    scored = segmentation.model.transform(vectors)
    scored = scored.withColumn("prediction", F.element_at(numbers, F.col("prediction") + 1))
    return scored.drop("features", "scaled_features")


def quantile_edges(
    rows: DataFrame,
    probabilities: Sequence[float] = schema.SEGMENT_QUANTILES,
    exact: bool = False,
    column: str = AMOUNT,
    relative_error: float = 0.01,
) -> DataFrame:
    """Quantiles of a column as one row with an array ``edges``.

    The approximate form merges fixed-size sketches. The exact form counts each distinct value and adds
    the counts up along the value order; no task sees more than its range of values.
    """
    if not exact:
        accuracy = max(1, round(1 / relative_error))
        return rows.agg(F.percentile_approx(column, list(probabilities), accuracy).alias("edges"))
    values = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(values, [F.asc(column)], F.col("n"), "up_to", "total")

    def edge(probability: float) -> Column:
        part = Fraction(str(probability))
        position = F.call_function(
            "div", F.col("total") * part.numerator + (part.denominator - 1), F.lit(part.denominator)
        )
        return F.min(F.when(F.col("up_to") >= position, F.col(column)))

    return ranked.agg(F.array(*[edge(p) for p in probabilities]).alias("edges"))


def profile(rows: DataFrame, segment: str = "prediction", column: str = AMOUNT) -> DataFrame:
    """Mean amount and number of rows per segment."""
    cents = money.cents(F.col(column))
    grouped = rows.groupBy(segment).agg(
        F.sum(cents).alias("_cents"), F.count(column).alias("_n"), F.count(F.lit(1)).alias("segment_rows")
    )
    mean = F.col("_cents").cast("double") / F.nullif(F.col("_n") * 100, F.lit(0)).cast("double")
    return grouped.select(segment, mean.alias("segment_mean"), "segment_rows")


def label_by_edges(value: Column, edges: Column, labels: Sequence[str] = schema.SEGMENT_LABELS) -> Column:
    """Label of the half-open range between edges a value falls in; a NULL value has no label."""
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for position, name in enumerate(labels[:-1]):
        label = label.when(value < edges[position], F.lit(name))
    return label.otherwise(F.lit(labels[-1]))


def label_segments(
    profiles: DataFrame, edges: DataFrame, labels: Sequence[str] = schema.SEGMENT_LABELS
) -> DataFrame:
    """Name every segment by its mean; the edges enter the plan as a scalar subquery."""
    label = label_by_edges(F.col("segment_mean"), edges.select("edges").scalar(), labels)
    return profiles.withColumn("bill_cat", label)


def label_counts(labelled: DataFrame) -> DataFrame:
    """Number of segments per label."""
    return labelled.groupBy("bill_cat").agg(F.count(F.lit(1)).alias("segments"))


def attach_labels(
    rows: DataFrame, labelled: DataFrame, segment: str = "prediction", segments: int | None = None
) -> DataFrame:
    """Give every row the label of its segment and drop the segment number.

    ``segments`` states how many segments there can be, as with KMeans, and allows a broadcast outright.
    Otherwise the number is counted first.
    """
    names = labelled.select(segment, "bill_cat", "segment_rows")
    if segments is not None and segments <= lookup.BROADCAST_ROWS:
        joined = rows.join(F.broadcast(names.drop("segment_rows")), segment, "left")
    else:
        joined = lookup.attach(rows, materialise(names, "labels"), segment, "segment_rows")
    return joined.drop(segment)


def categorise(
    rows: DataFrame,
    segment: str = "prediction",
    segments: int | None = None,
    exact: bool = False,
    labels: Sequence[str] = schema.SEGMENT_LABELS,
    probabilities: Sequence[float] = schema.SEGMENT_QUANTILES,
    column: str = AMOUNT,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Label rows that already have a segment: quantile edges, unless they are given, segment means, labels, join back."""
    if len(labels) != len(probabilities) + 1:
        raise ValueError("there must be one label more than quantiles")
    if edges is None:
        edges = quantile_edges(rows, probabilities, exact, column)
    labelled = label_segments(profile(rows, segment, column), edges, labels)
    return attach_labels(rows, labelled, segment, segments)
