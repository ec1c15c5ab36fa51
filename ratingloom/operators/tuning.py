"""Parameter search over ALS by successive halving.

All drawn trials are fitted for a few iterations; the best ``1 / ETA`` of them go to the next rung, which fits
``ETA`` times as long, until the last rung fits what is left for all the iterations it drew. The trials of a rung
run at once, each in a scheduler pool of its own (fair ones where the session has ``spark.scheduler.mode=FAIR``),
so that the small blocks of one fit do not leave the cluster idle. Each rung is a stored table.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from ratingloom.operators.evaluation import evaluate_model
from ratingloom.operators.latent import FactorModel, checkpoint_folder, fit_als
from ratingloom.operators.topk import with_rank
from ratingloom.staging import stage

# fixed values: the search space
FACTORS = range(16, 129, 16)
REGULARIZATION = (0.001, 0.1)  # log-uniform
ITERATIONS = range(5, 31, 5)
ALPHA = range(10, 101, 10)

LEAST_ITERATIONS = 2  # of the first rung
ETA = 4
PARALLEL = 4  # trials that run at once

FITTED = (
    "rung int, trial int, factors int, regularization double, iterations int, alpha double, fitted int, metric string, value double"
)
NAMES = ("factors", "regularization", "iterations", "alpha")


def _drawn(seed: int, trial: int, name: str) -> int:
    """32 bits for a parameter of a trial."""
    return int(hashlib.md5(f"{seed}|{trial}|{name}".encode()).hexdigest()[:8], 16)


def draw_parameters(n_trials: int, seed: int = 42) -> Iterator[dict[str, Any]]:
    """Parameters of each trial, which depend on the seed and its number alone."""
    low, high = (math.log(x) for x in REGULARIZATION)
    for trial in range(n_trials):
        pick = lambda name, values, trial=trial: values[_drawn(seed, trial, name) % len(values)]
        yield {
            "factors": pick("factors", FACTORS),
            "regularization": math.exp(low + (high - low) * _drawn(seed, trial, "regularization") / 2**32),
            "iterations": pick("iterations", ITERATIONS),
            "alpha": float(pick("alpha", ALPHA)),
        }


def metric_depth(metric: str) -> int:
    """The k of a metric name such as ``ndcg_at_10``; 10 without one."""
    return int(metric.rsplit("_", 1)[-1]) if "_at_" in metric else 10


def promote(rung: DataFrame, quota: int) -> DataFrame:
    """``rung`` with ``promoted``: whether a trial is among the ``quota`` best; of equal values the earlier trial is
    better, and a trial without a value is the worst."""
    order = [F.desc_nulls_last("value"), F.asc("trial")]
    best = with_rank(rung, ["rung"], order, quota, name="_place").select("rung", "trial", F.lit(True).alias("promoted"))
    return rung.join(F.broadcast(best), ["rung", "trial"], "left").withColumn("promoted", F.coalesce("promoted", F.lit(False)))


def search(
    train: DataFrame,
    validation: DataFrame,
    n_trials: int = 20,
    metric: str = "ndcg_at_10",
    seed: int = 42,
    threshold: float = 3.5,
    parameters: list[dict[str, Any]] | None = None,
    eta: int = ETA,
    least_iterations: int = LEAST_ITERATIONS,
    parallel: int = PARALLEL,
) -> DataFrame:
    """One row per rung and trial that took part in it: the drawn parameters, ``fitted`` iterations, the validation
    ``value`` of ``metric`` and whether the trial was ``promoted``. ``train`` and ``validation`` are stored tables.

    A trial that drew fewer iterations than a rung allows is fitted for those, and its value is kept for the rungs
    after. A trial that fails stops the search.
    """
    spark = train.sparkSession
    seen, k = train.select("user_idx", "item_idx"), metric_depth(metric)
    trials = list(enumerate(parameters or draw_parameters(n_trials, seed)))
    checkpoint_folder(spark)  # set once, before the threads
    known: dict[tuple[int, int], float | None] = {}

    def fit(job: tuple[int, int]) -> tuple[tuple[int, int], float | None]:
        trial, iterations = job
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial}")
        model = FactorModel(fit_als(train, seed=seed, **(dict(trials)[trial] | {"iterations": iterations})))
        scores = evaluate_model(lambda users, n: model.recommend(users, seen, n), validation, [k], threshold)
        return job, scores.first()[metric]

    rungs, budget, longest = [], least_iterations, max(p["iterations"] for _, p in trials)
    while True:
        last = len(trials) == 1 or budget >= longest
        fitted = {trial: p["iterations"] if last else min(p["iterations"], budget) for trial, p in trials}
        with ThreadPoolExecutor(max(1, parallel)) as pool:
            known.update(pool.map(inheritable_thread_target(spark)(fit), [job for job in fitted.items() if job not in known]))
        rows = [(len(rungs), t, *(p[name] for name in NAMES), fitted[t], metric, known[t, fitted[t]]) for t, p in trials]
        quota = 1 if last else -(-len(trials) // eta)
        rungs.append(stage(promote(spark.createDataFrame(rows, FITTED), quota), "rung"))
        if last:
            break
        kept = {r["trial"] for r in rungs[-1].where("promoted").select("trial").collect()}  # at most n_trials rows
        trials = [(t, p) for t, p in trials if t in kept]
        budget *= eta
    return reduce(DataFrame.unionByName, rungs)


def best_parameters(trials: DataFrame) -> dict[str, Any]:
    """Parameters of the trial promoted by the last rung."""
    best = trials.where("promoted").orderBy(F.desc("rung")).first().asDict()
    return {name: best[name] for name in NAMES}


def final_trials(rungs: DataFrame) -> DataFrame:
    """Each trial's row in the last rung it took part in."""
    return with_rank(rungs, ["trial"], [F.desc("rung")], 1, name="_last").drop("_last")


def rung_checks(rungs: DataFrame) -> DataFrame:
    """One row per rung and trial with ``sound``: whether it was promoted exactly if fewer trials than the rung promoted
    are better, and whether the rung was entered by the trials that the one before promoted."""
    better = rungs.alias("a").join(rungs.alias("b"), F.expr("a.rung = b.rung"))
    value = lambda side: F.coalesce(F.col(f"{side}.value"), F.lit(float("-inf")))
    ahead = (value("b") > value("a")) | (value("b") == value("a")) & (F.col("b.trial") < F.col("a.trial"))
    places = better.groupBy("a.rung", "a.trial").agg(F.count_if(ahead).alias("ahead"))
    quotas = rungs.groupBy("rung").agg(F.count_if("promoted").alias("quota"))
    came = rungs.where("promoted").select((F.col("rung") + 1).alias("rung"), "trial", F.lit(True).alias("came"))
    joined = rungs.join(places, ["rung", "trial"]).join(quotas, "rung").join(came, ["rung", "trial"], "left")
    entered = (F.col("rung") == 0) | F.col("came").isNotNull()
    return joined.withColumn("sound", (F.col("promoted") == (F.col("ahead") < F.col("quota"))) & entered).select(*rungs.columns, "sound")
