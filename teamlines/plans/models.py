"""Score models on Spark ML: learners, feature choice, search, stacking, walk-forward, final fit.

Every fit is a distributed Spark job over a vector frame; the driver holds only parameters
and metrics. Fitted models are pipelines of Spark ML stages, so they save and load.
"""

import json
import random
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.operators.catalog import CATEGORICAL
from teamlines.operators.evaluate import best_model, cv_summary, team_errors
from teamlines.operators.splits import contiguous_folds, fold_rows, time_folds
from teamlines.plans.boosting import PATIENCE, fit_poisson, fit_until, fit_with_patience, patience_stop
from teamlines.plans.encode import drop_inputs, encoding_stages
from teamlines.plans.ledger import Ledger

# Default settings, search ranges and blend weights.
BOOSTED = dict(maxIter=1000, maxDepth=6, stepSize=0.03, subsamplingRate=0.9, featureSubsetStrategy="0.9")
FOREST = dict(numTrees=500, maxDepth=8, minInstancesPerNode=2)
SELECTOR = dict(maxIter=200)
SELECTOR_FOREST = dict(numTrees=200)
SEARCH_SPACE = {
    "maxIter": (500, 1500),
    "maxDepth": (4, 12),
    "stepSize": (0.005, 0.1),
    "subsamplingRate": (0.7, 1.0),
    "featureSubsetStrategy": (0.7, 1.0),
    "minInstancesPerNode": (1, 10),
    "minInfoGain": (0.05, 5.0),
}
BLEND = {"boosted": 0.6, "forest": 0.3, "ridge": 0.1}
RIDGE_ALPHA = 1.0
N_FEATURES, N_TRIALS, N_FOLDS, STACK_FOLDS = 40, 50, 4, 3
ROWS_AT_ONCE = 8_000_000  # of all fits of a search that run side by side
# Of matrices that each fit reads a few times to bin their rows. The bins, read once a level of every tree, get the
# memory: kept there too, the two push each other out whenever they don't both fit.
WIDE = StorageLevel.DISK_ONLY
VALIDATION_TOL = 0.01
VALIDATION = "is_validation"
KEYS = ["game_id", "is_home"]
MODEL_NAMES = ["base", "optimized", "forest", "stacking"]


def boosted_trees(params=None, objective="squared", seed=42, validation=None):
    """Boosted regression trees; ``poisson_line`` is a Poisson regression, linear in the features.

    ``validation`` names a boolean column whose rows decide, by Spark's tolerance, when to stop
    adding trees; ``fit_with_patience`` is the rule by rounds without gain. Boosted trees for the
    Poisson objective are fitted by ``fit_poisson``.
    """
    if objective == "poisson_line":
        return GeneralizedLinearRegression(family="poisson", link="log", maxIter=25)
    if objective != "squared":
        raise ValueError(f"unknown objective {objective!r}")
    settings = {**BOOSTED, **(params or {}), "seed": seed}
    if validation:
        settings.update(validationIndicatorCol=validation, validationTol=VALIDATION_TOL)
    return GBTRegressor(**settings)


def random_forest(params=None, seed=42):
    return RandomForestRegressor(**{**FOREST, **(params or {}), "seed": seed})


def ridge(train: DataFrame, features="features", label="label"):
    """Ridge regression with a penalty of 1 on the summed squared error, unscaled inputs.

    The learner divides the penalty by the number of rows and by the label's deviation, so
    both are multiplied in.
    """
    n, deviation = train.agg(F.count(label), F.stddev_pop(label)).first()
    return LinearRegression(
        featuresCol=features, labelCol=label, regParam=RIDGE_ALPHA / max(n, 1) * (deviation or 1.0),
        elasticNetParam=0.0, standardization=False, solver="normal",
    )


def matrix(df: DataFrame, stages, target: str, extra=()) -> DataFrame:
    """Key, label and vector rows in a repeatable layout, so that a seed fixes the fit.

    Tree sampling depends on the row order within partitions; hashing by game and sorting
    inside each partition makes that order independent of how the input was scheduled.
    """
    rows = df.where(F.col(target).isNotNull())
    for stage in stages:
        rows = stage.transform(rows)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = rows.select(*KEYS, *extra, F.col(target).cast("double").alias("label"), "features")
    return picked.repartition(n, *KEYS).sortWithinPartitions(*KEYS)


def with_validation(train: DataFrame, valid: DataFrame) -> DataFrame:
    """The rows to fit on and those that tell when to stop, marked, with the columns they share."""
    shared = [c for c in train.columns if c in valid.columns]
    marked = [rows.select(*shared).withColumn(VALIDATION, F.lit(flag)) for rows, flag in ((train, False), (valid, True))]
    return marked[0].unionByName(marked[1])


def mean_error(scored: DataFrame) -> float:
    return team_errors(scored, "prediction", "label").first().mae


def feature_importance(train: DataFrame, names, seed=42, boosted=None, forest=None) -> DataFrame:
    """Mean of the importances of boosted trees and a forest, each of which sums to 1."""
    first = GBTRegressor(**{**SELECTOR, **(boosted or {}), "seed": seed}).fit(train).featureImportances.toArray()
    second = RandomForestRegressor(**{**SELECTOR_FOREST, **(forest or {}), "seed": seed}).fit(train).featureImportances.toArray()
    rows = [(i, name, float(first[i] + second[i]) / 2) for i, name in enumerate(names)]
    return train.sparkSession.createDataFrame(rows, "idx int, feature string, importance double")


def top_features(importance: DataFrame, n=N_FEATURES) -> list:
    """Indices of the n most important features; the earlier wins a tie."""
    best = importance.orderBy(F.desc("importance"), "idx").limit(n)
    return [row.idx for row in best.select("idx").collect()]


def sample_params(trials: int, seed=42, space=None) -> list:
    """Seeded draws from the search ranges; whole-number ranges give whole numbers."""
    rng = random.Random(seed)
    draws = []
    for _ in range(trials):
        draw = {}
        for name, (low, high) in {**SEARCH_SPACE, **(space or {})}.items():
            whole = isinstance(low, int) and isinstance(high, int)
            value = rng.randint(low, high) if whole else rng.uniform(low, high)
            draw[name] = str(round(value, 4)) if name == "featureSubsetStrategy" else value
        draws.append(draw)
    return draws


def _side_by_side(spark, work, items, parallelism):
    """``work`` of each item, some at a time; only threads made for this session carry its job properties."""
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def _boosted_fit(train, valid, params, objective, seed, patience):
    """``(staged mean absolute errors or None, error, rounds, fired)`` of one draw of parameters on the validation rows."""
    if objective == "poisson":
        model, history = fit_poisson(train, valid, patience=patience, seed=seed, **poisson_settings(params))
        stop = patience_stop([h[2] for h in history], patience)
        return mean_error(model.transform(valid)), stop.rounds, stop.fired
    _, stop = fit_until(boosted_trees(params, objective, seed), train, valid, patience, "absolute")[1:]
    return stop.error, stop.rounds, stop.fired


def random_search(
    train, valid, trials=N_TRIALS, seed=42, space=None, parallelism=4, objective="squared", rungs=1, eta=3, patience=PATIENCE,
):
    """``(best parameters, trial frame)`` by validation error; fits run side by side.

    Each draw is fitted to its budget of rounds, or as far as the patience rule looks, its error after every round
    is read in one pass, and the best round under that rule counts. With more ``rungs`` this is successive halving: the first
    rung gives a draw ``1 / eta ** (rungs - 1)`` of its rounds, the best ``1 / eta`` of the draws go on
    with ``eta`` times as many, and a draw whose patience ran out keeps its errors and isn't fitted again.
    The best parameters carry the rounds kept as ``maxIter``. Each fit keeps its own binned rows, so fits of
    very many rows run fewer at a time.
    """
    parallelism = max(1, min(parallelism, ROWS_AT_ONCE // max(1, train.count())))
    draws = sample_params(trials, seed, space)
    alive, told, last = list(range(len(draws))), [], {}
    for rung in range(rungs):
        share = eta ** (rungs - 1 - rung)
        budget = {i: max(1, -(-draws[i]["maxIter"] // share)) for i in alive}
        open_draws = [i for i in alive if not (i in last and last[i][2])]

        def fit(i):
            return _boosted_fit(train, valid, {**draws[i], "maxIter": budget[i]}, objective, seed, patience)

        for i, found in zip(open_draws, _side_by_side(train.sparkSession, fit, open_draws, parallelism)):
            last[i] = (*found[:2], found[2] or budget[i] == draws[i]["maxIter"])
        ranked = sorted(alive, key=lambda i: (last[i][0], i))
        going = ranked[: max(1, -(-len(alive) // eta))] if rung + 1 < rungs else ranked[:1]
        told += [(i, rung, budget[i], last[i][1], last[i][0], i in open_draws, i in going) for i in alive]
        alive = sorted(going)
    best = alive[0]
    rows = [(*t[:5], t[5], t[6], rung_is_last and t[0] == best, *map(float, (draws[t[0]][k] for k in SEARCH_SPACE))) for t in told for rung_is_last in (t[1] == rungs - 1,)]
    columns = ", ".join(f"{k} double" for k in SEARCH_SPACE)
    schema = f"trial int, rung int, budget int, rounds int, mae double, fitted boolean, kept boolean, chosen boolean, {columns}"
    return {**draws[best], "maxIter": max(1, last[best][1])}, train.sparkSession.createDataFrame(rows, schema)


def poisson_settings(params=None) -> dict:
    """Sizes of boosted regression trees as settings of the Poisson loop; it takes no row or column samples."""
    given = {**BOOSTED, **(params or {})}
    kept = {"rounds": given["maxIter"], "depth": given["maxDepth"], "step": given["stepSize"]}
    return kept | {k: given[k] for k in ("minInstancesPerNode",) if k in given}


def fit_stacking(train: DataFrame, learners: dict, blocks=STACK_FOLDS, block="block") -> PipelineModel:
    """Base learners, and a ridge regression over their out-of-fold predictions.

    ``train`` carries contiguous block numbers in ``block``. The out-of-fold frame is lazy:
    each block is scored by models fitted on the other blocks.
    """
    outputs = [f"base_{name}" for name in learners]
    out_of_fold = None
    for b in range(blocks):
        rest, held = train.where(F.col(block) != b), train.where(F.col(block) == b)
        for (_, learner), output in zip(learners.items(), outputs):
            held = learner.copy({learner.predictionCol: output}).fit(rest).transform(held)
        held = held.select("label", *outputs)
        out_of_fold = held if out_of_fold is None else out_of_fold.unionByName(held)
    packed = VectorAssembler(inputCols=outputs, outputCol="base_predictions")
    rows = packed.transform(out_of_fold)
    final = ridge(rows, "base_predictions").fit(rows)
    fitted = [
        learner.copy({learner.predictionCol: output}).fit(train)
        for (_, learner), output in zip(learners.items(), outputs)
    ]
    return PipelineModel([*fitted, packed, final])


def blend_sql(weights=None, prefix="vote_") -> str:
    return " + ".join(f"{w!r}D * {prefix}{name}" for name, w in (weights or BLEND).items())


def fit_vote(train: DataFrame, boosted=None, forest=None, weights=None, seed=42) -> PipelineModel:
    """Boosted trees, forest and ridge blended with fixed weights."""
    learners = {
        "boosted": boosted_trees({"maxIter": 800, **(boosted or {})}, seed=seed),
        "forest": random_forest(forest, seed),
        "ridge": ridge(train),
    }
    fitted = [x.copy({x.predictionCol: f"vote_{n}"}).fit(train) for n, x in learners.items()]
    blended = SQLTransformer(statement=f"SELECT *, {blend_sql(weights)} AS prediction FROM __THIS__")
    return PipelineModel([*fitted, blended])


def fit_model(kind: str, train: DataFrame, params=None, boosted=None, forest=None, seed=42, valid=None, patience=PATIENCE):
    """Fit a registered model; an unknown name is an error.

    ``boosted`` and ``forest`` override the default sizes, ``params`` is the search result. Boosted
    models stop by patience on the rows ``valid``, if given.
    """
    if kind in ("base", "optimized"):
        learner = boosted_trees({**(boosted or {}), **((params or {}) if kind == "optimized" else {})}, seed=seed)
        return learner.fit(train) if valid is None else fit_with_patience(learner, train, valid, patience)[0]
    if kind == "poisson":
        return fit_poisson(train, valid, patience=patience, seed=seed, **poisson_settings(boosted))[0]
    if kind == "poisson_line":
        return boosted_trees(objective="poisson_line").fit(train)
    if kind == "forest":
        return random_forest(forest, seed).fit(train)
    if kind == "vote":
        return fit_vote(train, boosted, forest, seed=seed)
    if kind == "stacking":
        learners = {
            "boosted": boosted_trees({**(boosted or {}), **(params or {})}, seed=seed),
            "forest": random_forest(forest, seed),
        }
        return fit_stacking(train, learners)
    raise ValueError(f"unknown model {kind!r}")


def walk_forward(
    train: DataFrame, features, target: str, n_folds=N_FOLDS, models=MODEL_NAMES, n_features=N_FEATURES,
    trials=N_TRIALS, space=None, boosted=None, forest=None, selector=None, seed=42, rungs=1, patience=PATIENCE, ledger=None,
):
    """``(fold score frame, best model name, tuned parameters)`` over expanding time folds.

    Boosted trees stop early on the rows of the fold they are scored on, and fold 1 also tunes
    the parameters, so the scores of both are optimistic.

    ``ledger`` names a folder where every finished cell is written: the features picked in a fold,
    the search, and the score of each fold and model. A run that finds cells there takes them over, so
    a run that was broken off goes on where it stopped. It belongs to one set of arguments and input.
    """
    selector = selector or {}
    spark = train.sparkSession
    book = Ledger(spark, ledger, {
        "features": list(features), "target": target, "n_folds": n_folds, "models": list(models), "n_features": n_features, "trials": trials, "space": space,
        "boosted": boosted, "forest": forest, "selector": selector, "seed": seed, "rungs": rungs, "patience": patience,
    })
    tuning = trials and {"optimized", "stacking"} & set(models)
    folded = time_folds(train.where(F.col(target).isNotNull()), n_folds)
    held, scores, params = [], [], None

    def hold(frame, *level):
        held.append(frame.persist(*level))
        return frame

    def release(down_to=0):
        while len(held) > down_to:
            held.pop().unpersist()

    def picked(rows, places):
        slicer = VectorSlicer(inputCol="features", outputCol="picked", indices=places)
        return slicer.transform(rows).drop("features").withColumnRenamed("picked", "features")

    try:
        # One matrix of all rows serves every fold: a fold's rows are a filter of it, in the same layout.
        categories = hold(folded.select("fold", *[c for c in features if c in CATEGORICAL]))
        stages, every_name = encoding_stages(categories, features)
        laid_out = hold(matrix(folded, stages, target, ["fold", "date"]), WIDE)
        shared = len(held)
        for fold in range(1, n_folds + 1):
            if fold == 1 and tuning and book.has(1, "search"):
                params = json.loads(book.value(1, "search"))
            open_models = [kind for kind in models if not book.has(fold, kind)]
            if open_models or (fold == 1 and tuning and params is None):
                fit_rows, check_rows = fold_rows(laid_out, fold)
                _, names = encoding_stages(fold_rows(categories, fold)[0], features)
                places = [every_name.index(n) for n in names]  # categories first seen in a later fold are no inputs
                if not book.has(fold, "features"):
                    full = fit_rows if names == every_name else picked(fit_rows, places)
                    book.add(fold, "features", json.dumps(top_features(feature_importance(full, names, seed, **selector), n_features)))
                chosen = [places[i] for i in json.loads(book.value(fold, "features"))]
                blocked = contiguous_folds(fit_rows, STACK_FOLDS) if "stacking" in open_models else fit_rows.withColumn("block", F.lit(0))
                fit_on = hold(picked(blocked, chosen).select(*KEYS, "block", "label", "features"))
                check = hold(picked(check_rows, chosen).select(*KEYS, "label", "features"))
                if fold == 1 and tuning and params is None:
                    params, _ = random_search(fit_on, check, trials, seed, space, rungs=rungs, patience=patience)
                    book.add(1, "search", json.dumps(params))
                for kind in open_models:
                    valid = check if kind in ("base", "optimized", "poisson") else None
                    fitted = fit_model(kind, fit_on, params, boosted, forest, seed, valid, patience)
                    book.add(fold, kind, json.dumps(params), mean_error(fitted.transform(check)))
                release(shared)
            scores += [(fold, order, kind, book.mae(fold, kind)) for order, kind in enumerate(models)]
    finally:
        release()
    frame = spark.createDataFrame(scores, "fold int, model_order int, model string, mae double")
    return frame, best_model(cv_summary(frame)).first().model, params


def train_final(
    train: DataFrame, test: DataFrame, features, target: str, kind="base", params=None,
    select=True, n_features=N_FEATURES, boosted=None, forest=None, selector=None, early_stop=True, seed=42, patience=PATIENCE,
):
    """``(pipeline, scored test rows, error frame)`` of the chosen model.

    Boosting stops by patience on the last time fold of the training rows, never on the test rows.
    """
    stages, names = encoding_stages(train, features)
    rows = train.where(F.col(target).isNotNull())
    extra = []
    stopping = early_stop and kind in ("base", "optimized", "poisson")
    if stopping:
        rows = time_folds(rows, N_FOLDS).withColumn(VALIDATION, F.col("fold") == N_FOLDS)
        extra.append(VALIDATION)
    if kind == "stacking":
        rows = contiguous_folds(rows, STACK_FOLDS)
        extra.append("block")
    choosing = select and n_features < len(names)
    laid_out = matrix(rows, stages, target, extra)
    held = [laid_out.persist(WIDE) if choosing else laid_out.persist()]
    try:
        parts = [*stages]
        if choosing:
            picked = top_features(feature_importance(held[0], names, seed, **(selector or {})), n_features)
            renamed = SQLTransformer(statement="SELECT *, features AS all_features FROM __THIS__")
            slicer = VectorSlicer(inputCol="all_features", outputCol="features", indices=picked)
            dropped = SQLTransformer(statement="SELECT * EXCEPT (features) FROM __THIS__")
            choose = [renamed, dropped, slicer]
            wide = held[0]
            for stage in choose:
                wide = stage.transform(wide)
            # the passes of the fit read the picked features alone
            held.append(wide.drop("all_features").persist())
            held[1].count()
            held.pop(0).unpersist()
            parts += choose
        fit_on = held[-1]
        valid = fit_on.where(VALIDATION) if stopping else None
        fit_on = fit_on.where(~F.col(VALIDATION)) if stopping else fit_on
        fitted = fit_model(kind, fit_on, params, boosted, forest, seed, valid, patience)
    finally:
        for frame in held:
            frame.unpersist()
    pipeline = PipelineModel([*parts, fitted])
    scored = score(pipeline, test)
    return pipeline, scored, team_errors(scored, "prediction", target)


def score(pipeline: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with a ``prediction`` column, the model's working columns dropped."""
    rows = pipeline.transform(df)
    return drop_inputs(rows).select(*df.columns, "prediction")
