"""Learned offer ranking: the same output shape as the heuristic one."""

from __future__ import annotations

from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import rules
from tidewatch.params import OFFER_TYPES, REASONS, Params
from tidewatch.session import cut_lineage

FLAGS = tuple(f"is_{o}__{r}" for o in OFFER_TYPES for r in REASONS)
AMOUNTS = ("monthly_arpu_usd", "offer_cost_usd")
INPUTS = (*[f"{c}_bin" for c in AMOUNTS], *FLAGS)
#: Bins of an amount, the default of Spark's trees.
BINS = 32
#: Values of an amount that its bins are cut from: all of them, or so many of their quantiles.
POINTS = 10_000


def features(outcomes: DataFrame) -> DataFrame:
    """Offer, reason and their interaction, with the retained value as label."""
    return outcomes.select(
        "retention_id", "offer_type", "churn_reason",
        F.concat_ws("|", "offer_type", "churn_reason").alias("offer_reason"),
        "monthly_arpu_usd", "offer_cost_usd", F.col("retained_clv_usd").alias("label"))


def _inputs(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """The inputs as columns: the amounts by the number of cuts below them, and the flags."""
    # The vocabulary is fixed, so the interaction flags need no pass over the data.
    flags = {f"is_{o}__{r}": ((F.col("offer_type") == o) & (F.col("churn_reason") == r)).cast("double")
             for o in OFFER_TYPES for r in REASONS}
    bins = {f"{c}_bin": F.when(F.col(c).isNotNull(), sum((F.when(F.col(c).cast("double") > F.lit(x), 1.0).otherwise(0.0) for x in cuts[c]), F.lit(0.0))) for c in AMOUNTS}
    return df.withColumns({**bins, **flags})


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(INPUTS), outputCol="features").transform(df)


@dataclass(frozen=True)
class Binned:
    """Boosted trees over binned amounts."""

    trees: object
    cuts: dict[str, list[float]]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.trees.transform(_vectors(_inputs(df, self.cuts)))


@dataclass(frozen=True)
class Fit:
    """A model with its validation error and that of the constant mean."""

    model: Binned
    rmse: float
    rmse_of_mean: float


_fits: dict[tuple, Fit] = {}


def bin_cuts(values: list[float], bins: int = BINS) -> list[float]:
    """Where Spark's trees cut a continuous input: between all values if these are few, else where the running count is nearest to the next of equal shares."""
    counts = sorted(Counter(values).items())
    between = [((a + b) / 2, n) for (a, n), (b, _) in zip(counts, counts[1:])]
    if len(between) < bins:
        return [x for x, _ in between]
    found, before, share = [], 0, len(values) / bins
    target = share
    for (middle, n), (_, following) in zip(between, counts[1:]):
        before += n
        if abs(before - target) < abs(before + following - target):
            found.append(middle)
            target += share
    return found[:bins - 1]


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """The cuts of both amounts; of more rows than POINTS the quantiles stand for the values, over all rows and in one pass."""
    doubles = rows.select(*[F.col(c).cast("double").alias(c) for c in AMOUNTS])
    n = rows.count()
    if n <= POINTS:
        values = {c: [r[c] for r in doubles.select(c).collect() if r[c] is not None] for c in AMOUNTS}
    else:
        ranks = [(i + 0.5) / POINTS for i in range(POINTS)]
        values = dict(zip(AMOUNTS, doubles.approxQuantile(list(AMOUNTS), ranks, 1 / POINTS)))
    return {c: bin_cuts(values[c], min(BINS, n)) for c in AMOUNTS}


def _cells(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """(held_out, features, weight, label, spread): equal inputs as one row with their number, mean label and squared distances from it.

    Trees see an amount by its bin alone, and squared error needs no more of the labels than this.  So boosting over the cells, at most BINS * BINS times
    the combinations of the flags however many the rows, gives the trees of the rows.
    """
    labelled = F.count("label") == F.count(F.lit(1))  # a missing label stays an error of the fit
    cells = _inputs(rows, cuts).groupBy("held_out", *INPUTS).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.when(labelled, F.avg("label")).alias("label"), (F.var_pop("label") * F.count("label")).alias("spread"))
    return cut_lineage(_vectors(cells).select("held_out", "features", "weight", "label", "spread"))


def train(outcomes: DataFrame, *, max_iter: int = 10, seed: int = 42) -> Fit:
    """Boosted trees over ten settings; the best one by validation error, fitted again on all rows.

    A quarter of the outcomes, by a hash of their id, validates, so the split does not follow the partitioning.  A session fits
    equal outcomes once: they are recognised by their number and the sum of their hashes.
    """
    rows = cut_lineage(features(outcomes))
    print_of = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
    key = (rows.sparkSession.sparkContext.applicationId, *print_of, max_iter, seed)
    if key not in _fits:
        data = rows.withColumns({"label": F.col("label").cast("double"), "held_out": F.pmod(F.xxhash64("retention_id"), F.lit(4)) == 0})
        cuts = _cuts(data.filter("NOT held_out"))
        cells = _cells(data, cuts)
        fit, held = cells.filter("NOT held_out"), cells.filter("held_out")
        settings = [{"maxDepth": d, "stepSize": s} for d in (3, 5) for s in (0.05, 0.1, 0.2, 0.3, 0.4)]

        def boosted(cells: DataFrame, setting: dict):
            # Spark samples the rows it looks for bins in if they are more than the square of maxBins; the cells are fewer.
            return GBTRegressor(maxIter=max_iter, seed=seed, weightCol="weight", maxBins=8 * BINS, **setting).fit(cells)

        def distance(prediction) -> Column:
            """The root of the mean squared distance of the held-out labels from a prediction."""
            return F.sqrt((F.sum(F.col("weight") * (F.col("label") - prediction) ** 2) + F.sum("spread")) / F.sum("weight"))

        def error(setting: dict) -> float:
            found = boosted(fit, setting).transform(held).agg(distance(F.col("prediction"))).first()[0]
            return float("nan") if found is None else found
        with ThreadPoolExecutor(4) as pool:
            errors = list(pool.map(error, settings))
        best = min(range(len(settings)), key=lambda i: (errors[i], i))
        mean = fit.agg(F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).first()[0]
        flat = held.agg(distance(F.lit(mean))).first()[0]
        cuts = _cuts(data)
        _fits[key] = Fit(Binned(boosted(_cells(data, cuts), settings[best]), cuts), errors[best], flat)
    return _fits[key]


def candidates(book: DataFrame, p: Params) -> DataFrame:
    """The three plays of every at-risk subscriber with their cost."""
    plays = rules.offer_plays(F.col("clv_at_risk_usd"), F.col("monthly_arpu_usd"), F.col("churn_reason"), p)
    return (book.select("subscriber_id", "churn_reason", "monthly_arpu_usd", F.explode(plays).alias("o"))
            .select("subscriber_id", "churn_reason", "monthly_arpu_usd", F.col("o.offerType").alias("offer_type"),
                    F.col("o.costUsd").alias("offer_cost_usd"), F.col("o.sort_order").alias("sort_order")))


def _rounded(col: Column) -> Column:
    return F.greatest(col, F.lit(0.0)).cast(rules.MONEY)


def recommend(model, book: DataFrame, p: Params) -> DataFrame:
    """Score all candidates and rank them inside each subscriber's row of three."""
    scored = model.transform(candidates(book, p))
    kept = _rounded(F.col("prediction"))
    cost = F.col("offer_cost_usd").cast(rules.MONEY)
    option = F.struct((-(kept - cost)).alias("sort_net"), F.col("sort_order"), F.col("offer_type").alias("offerType"),
                      cost.alias("costUsd"), kept.alias("predictedRetainedClvUsd"), (kept - cost).alias("predictedNetValueUsd"))
    # Three options per subscriber, by construction.
    ranked = scored.groupBy("subscriber_id").agg(F.sort_array(F.collect_list(option)).alias("plays"))
    best = F.col("plays")[0]
    return ranked.select(
        "subscriber_id", best["offerType"].alias("recommended_offer"),
        best["predictedRetainedClvUsd"].alias("predicted_retained_clv_usd"),
        best["predictedNetValueUsd"].alias("predicted_net_value_usd"),
        (best["predictedNetValueUsd"] > 0).alias("is_profitable"),
        rules.ranking_json(F.col("plays")).alias("offer_ranking"), F.lit(p.as_of).alias("scored_on"))


def run_summary(recs: DataFrame, fit: Fit) -> DataFrame:
    return recs.agg(
        F.round(F.lit(fit.rmse), 6).alias("rmse"), F.lit(fit.rmse < fit.rmse_of_mean).alias("beats_mean"), F.count(F.lit(1)).alias("subscribers_scored"),
        *[F.count_if(F.col("recommended_offer") == o).alias(f"{o}_recommended") for o in OFFER_TYPES])
