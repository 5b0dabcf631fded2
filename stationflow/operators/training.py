"""Train/validation/test split, the two tree ensembles and their training."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationflow.operators.evaluation import evaluate
from stationflow.operators.features import FEATURES, dense
from stationflow.session import fresh_path, run_together
from stationflow.sources.tables import read_table, write_table

SPLITS = ("train", "val", "test")


@dataclass(frozen=True)
class TreeSettings:
    # The production settings.
    num_trees: int = 100
    max_depth: int = 25
    subsampling_rate: float = 0.01
    min_instances_per_node: int = 100
    max_bins: int = 32
    seed: int = 29
    # Memory for the statistics of the nodes grown in one pass. More memory takes fewer passes, but nodes then
    # draw their features in another order, so trees of another size of it differ.
    max_memory_mb: int = 1024
    # Each row keeps its node per tree and is not walked down from the root on each level; the trees are the same.
    cache_node_ids: bool = True
    checkpoint_interval: int = 10


DEFAULT_SETTINGS = TreeSettings()

# The weights of train, val and test.
SPLIT_WEIGHTS = (0.9, 0.05, 0.05)


#: Rows that a task sorts, or keeps in memory for a fit.
ROWS_PER_TASK = 1_000_000


def in_bounded_partitions(data: DataFrame, most: int | None = None) -> DataFrame:
    """``data`` in partitions of about ``most`` rows (ROWS_PER_TASK) or fewer.

    Scans cut files by their bytes, so a table that compresses well, as silver and gold do, is read by a task for each core, however many
    rows it has. Rows are dealt by turns, which a stored table repeats.
    """
    n = math.ceil(data.count() / (most or ROWS_PER_TASK))
    return data.repartition(n) if n > 1 else data


def _shared_params(label: str, prediction: str, s: TreeSettings) -> dict:
    return dict(
        featuresCol=FEATURES,
        labelCol=label,
        predictionCol=prediction,
        maxDepth=s.max_depth,
        subsamplingRate=s.subsampling_rate,
        minInstancesPerNode=s.min_instances_per_node,
        maxBins=s.max_bins,
        seed=s.seed,
        maxMemoryInMB=s.max_memory_mb,
        cacheNodeIds=s.cache_node_ids,
        checkpointInterval=s.checkpoint_interval,
    )


def random_forest(label: str, prediction: str, settings: TreeSettings = DEFAULT_SETTINGS) -> Estimator:
    return RandomForestRegressor(numTrees=settings.num_trees, **_shared_params(label, prediction, settings))


def gradient_boosted(label: str, prediction: str, settings: TreeSettings = DEFAULT_SETTINGS) -> Estimator:
    return GBTRegressor(maxIter=settings.num_trees, **_shared_params(label, prediction, settings))


@dataclass(frozen=True)
class Family:
    """A model family: how to build its estimator and which class loads its saved models."""

    estimator: Callable[..., Estimator]
    model_class: type[Model]


FAMILIES = {
    "random_forest": Family(random_forest, RandomForestRegressionModel),
    "gbt": Family(gradient_boosted, GBTRegressionModel),
}


def family_of(name: str) -> Family:
    if name not in FAMILIES:
        raise ValueError(f"unknown model family {name!r}; known: {sorted(FAMILIES)}")
    return FAMILIES[name]


def prediction_column(label: str) -> str:
    return f"predicted_{label}"


def _split_by_share(data: DataFrame, share: Column, weights: Sequence[float]) -> DataFrame:
    """``share`` in [0, 1) to a split name; a column of its own first, so that it is drawn only once."""
    # The bounds as randomSplit adds them up.
    train = weights[0] / sum(weights)
    val = train + weights[1] / sum(weights)
    drawn = F.col("_share")
    split = F.when(drawn < train, SPLITS[0]).when(drawn < val, SPLITS[1]).otherwise(SPLITS[2])
    return data.withColumn("_share", share).withColumn("split", split).drop("_share")


def random_split(data: DataFrame, weights: Sequence[float] = SPLIT_WEIGHTS, seed: int = 29) -> DataFrame:
    """The parts of ``data.randomSplit(weights, seed)`` as a ``split`` column: the same rows, from one pass instead of one
    for each part.

    randomSplit sorts each partition by all columns and draws a number for each row, from a generator seeded by the seed and
    the partition; a part takes the rows whose number lies between its bounds. ``rand`` is the same generator. The draw follows each
    row's partition, so it repeats on a stored table only.
    """
    ordered = [f.name for f in data.schema.fields if _has_order(f.dataType)]
    return _split_by_share(data.sortWithinPartitions(*[F.col(f"`{c}`") for c in ordered]) if ordered else data, F.rand(seed), weights)


def _has_order(kind: T.DataType) -> bool:
    """Whether Spark sorts by values of this type."""
    if isinstance(kind, T.UserDefinedType):
        return _has_order(kind.sqlType())
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def keyed_split(data: DataFrame, keys: Sequence[str], weights: Sequence[float] = SPLIT_WEIGHTS) -> DataFrame:
    """Split by a hash of the row's key: the same key lands in the same split on any partitioning.

    A row-wise projection, so nothing is sorted or shuffled for it.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    share = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") / F.lit(float(2**32))
    return _split_by_share(data, share, weights)


def is_bagged(estimator: Estimator) -> bool:
    """Whether the estimator's trees each learn from rows drawn for them."""
    return isinstance(estimator, RandomForestRegressor) and estimator.getBootstrap() and estimator.getNumTrees() > 1


def _at_most(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... of a Poisson variable, up to where it is 1 to double precision."""
    term = total = math.exp(-mean)
    shares, n = [total], 0
    while n < mean or term > 1e-18:
        n += 1
        term *= mean / n
        total += term
        shares.append(total)
    return shares


def draw_rows(rows: DataFrame, trees: int, rate: float, seed: int) -> DataFrame:
    """rows as often as each tree draws them, with the tree's number, stored by tree.

    A forest draws each row Poisson(rate) times for each tree. All trees together draw it Poisson(rate * trees) times, and each of
    these draws falls to any tree alike, which is the same distribution. So one pass finds the rows of all trees, and a tree reads
    its own rows alone instead of all rows on each of its levels.
    """
    # Parts with a mean of at most 500 each, as exp(-mean) has no digits left far beyond that.
    parts = math.ceil(rate * trees / 500) or 1
    shares = F.array(*[F.lit(s) for s in _at_most(rate * trees / parts)])
    draws = [F.col(f"_draw{i}") for i in range(parts)]
    times = lambda draw: F.size(F.filter(shares, lambda share: share <= draw))
    drawn = rows.withColumns({f"_draw{i}": F.rand(seed + i) for i in range(parts)})
    tree = lambda i: F.pmod(F.xxhash64(*draws, i), F.lit(trees)).cast("int")
    total = reduce(Column.__add__, map(times, draws))
    each = drawn.withColumn("_times", total).filter("_times > 0").withColumn("tree", F.explode(F.transform(F.sequence(F.lit(1), "_times"), tree)))
    path = fresh_path(rows.sparkSession, "drawn")
    write_table(each.select(*rows.columns, "tree").hint("rebalance", "tree"), path, partition_by=["tree"])
    return read_table(rows.sparkSession, path)


def draw_for(estimator: Estimator, rows: DataFrame) -> DataFrame:
    """The rows that the trees of a bagged estimator draw; estimators that differ in their label alone draw the same."""
    return draw_rows(rows, estimator.getNumTrees(), estimator.getSubsamplingRate(), estimator.getSeed())


def fit_forest(forest: RandomForestRegressor, drawn: DataFrame) -> RandomForestRegressionModel:
    """A random forest whose trees are fitted one by one, each on the rows drawn for it, several at once.

    MLlib passes over all rows for all trees on each level, though a tree has only its share of them: with a rate of 0.01, 99 of
    100 visits do nothing. Here the rows read on a level are those of the trees. Each tree takes its bins from its own rows.
    """
    spark, n = drawn.sparkSession, forest.getNumTrees()
    label = forest.getLabelCol()
    some = drawn.select(forest.getFeaturesCol()).first()
    if some is None:
        raise ValueError("no tree drew a row")
    strategy = "onethird" if forest.getFeatureSubsetStrategy() == "auto" else forest.getFeatureSubsetStrategy()
    single = {forest.numTrees: 1, forest.bootstrap: False, forest.subsamplingRate: 1.0, forest.featureSubsetStrategy: strategy, forest.cacheNodeIds: False}
    sizes = {r["tree"]: r["count"] for r in drawn.groupBy("tree").count().collect()}
    # As in MLlib, a tree that drew no row predicts 0.
    empty = drawn.limit(1).withColumn(label, F.lit(0.0))

    def grow(tree: int) -> RandomForestRegressionModel:
        own = drawn.filter(F.col("tree") == tree) if tree in sizes else empty
        # MLlib refuses categories where it has fewer rows than bins. So few are all taken as often as it needs, as are those a node needs.
        often = math.ceil(forest.getMaxBins() / sizes.get(tree, 1))
        rows = own.select(forest.getFeaturesCol(), label)
        if often > 1:
            rows = rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), often))).drop("_copy")
        needed = {forest.minInstancesPerNode: forest.getMinInstancesPerNode() * often, forest.seed: forest.getSeed() + tree}
        return forest.copy({**single, **needed}).fit(rows)

    grown = run_together(spark, *[partial(grow, t) for t in range(n)], at_once=max(4, spark.sparkContext.defaultParallelism))
    kind = spark.sparkContext._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    java_trees = JavaWrapper._new_java_array([m._java_obj.trees()[0] for m in grown], kind)
    java = JavaWrapper._new_java_obj("org.apache.spark.ml.regression.RandomForestRegressionModel", forest.uid, java_trees, some[0].size)
    return forest._copyValues(RandomForestRegressionModel(java))


def fit(estimator: Estimator, rows: DataFrame, drawn: DataFrame | None = None) -> Model:
    """The estimator's model of rows; ``drawn`` are what `draw_for` drew of them, if that is stored already."""
    if not is_bagged(estimator):
        return estimator.fit(in_bounded_partitions(rows))
    if drawn is None:
        drawn = draw_for(estimator, rows.select(estimator.getFeaturesCol(), estimator.getLabelCol()))
    return fit_forest(estimator, drawn)


def fit_and_evaluate(estimator: Estimator, data: DataFrame, drawn: DataFrame | None = None) -> tuple[Model, DataFrame]:
    """Fit on the ``train`` rows; metrics of the other splits as (label, split, metric, value) rows.

    Validation and test rows are scored together in one job. ``drawn`` are the train rows that the trees draw, if stored already.
    """
    label, prediction = estimator.getLabelCol(), estimator.getPredictionCol()
    model = fit(estimator, data.filter(F.col("split") == "train").select(FEATURES, label), drawn)
    held_out = data.filter(F.col("split") != "train").select(FEATURES, label, "split")
    scores = evaluate(model.transform(dense(held_out)), label, prediction, "split")
    metrics = scores.unpivot("split", ["rmse", "r2"], "metric", "value")
    return model, metrics.select(F.lit(label).alias("label"), "split", "metric", "value")
