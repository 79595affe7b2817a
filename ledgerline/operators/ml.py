"""Modelling toolkit (M1-M19, M27, T7-T9): splits, folds, oversampling, boosted and
forest classifiers, random search, and classification metrics.

Scale notes
-----------
* No ``row_number`` over a partition as coarse as a class label: positions within a
  group come from ``group_row_index``, which counts rows per (group, hash bucket),
  prefix-sums the small bucket table and numbers rows only inside a bucket.
* Exact AUC is a Mann-Whitney statistic computed from per-score counts with the
  same bucketed prefix sum, so no global ordered window over all scores.
* Metrics come from the k x k confusion table (k = classes), i.e. after one
  aggregate over the predictions.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.util import inheritable_thread_target

from ledgerline.operators import forest
from ledgerline.operators.joins import join_aggregate
from ledgerline.operators.order_stats import cumulated
from ledgerline.session import cut_lineage, ensure_checkpoint_dir

BUCKETS = 1 << 16  # ~15M rows per bucket even for a 10^12-row group


# --------------------------------------------------------------------------- hashing, positions

def uniform_hash(cols: Sequence[str | Column], seed: int) -> Column:
    """Deterministic pseudo-uniform number in [0, 1) from key columns and a seed."""
    h = F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols], F.lit(seed))
    return F.pmod(h, F.lit(2**53)).cast("double") / float(2**53)


def portable_hash(cols: Sequence[str], seed: int) -> Column:
    """A number in [0, 2^52) from integer or text columns and a seed that any engine with md5 finds alike: the first 13
    digits of the md5 of the values and the seed, joined by ``|``."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def group_row_index(df: DataFrame, group_cols: Sequence[str], u_col: str, buckets: int = BUCKETS,
                    name: str = "_idx", size: str | None = None) -> DataFrame:
    """0-based position of each row within its group in ``u_col`` order, exact; ``size`` names a
    column for the group's row count.

    Rows are bucketed by ``floor(u * buckets)``; the (group, bucket) counts are a
    small table whose prefix sums give each bucket's offset; rows are numbered only
    inside their bucket.  A group holding a third of all rows is spread over
    ``buckets`` tasks instead of one.
    """
    d = df.withColumn("_b", F.floor(F.col(u_col) * buckets).cast("int"))
    counts = d.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_c"))
    prev = W.partitionBy(*group_cols).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    whole = [] if size is None else [F.sum("_c").over(W.partitionBy(*group_cols)).alias(size)]
    offs = counts.select(*group_cols, "_b", F.coalesce(F.sum("_c").over(prev), F.lit(0)).alias("_off"), *whole)
    d = join_aggregate(d, offs, [*group_cols, "_b"])
    local = F.row_number().over(W.partitionBy(*group_cols, "_b").orderBy(u_col)) - 1
    return d.withColumn(name, F.col("_off") + local).drop("_b", "_off")


def fixed_size_sample(df: DataFrame, key_cols: Sequence[str], n: int, seed: int) -> DataFrame:
    """Simple random sample of exactly ``n`` rows (M2): the ``n`` smallest hashes.
    Runs as a top-n (``TakeOrderedAndProject``): each task keeps at most ``n`` rows."""
    return df.withColumn("_u", uniform_hash(key_cols, seed)).orderBy("_u").limit(n).drop("_u")


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], test_frac: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``is_test``: exactly ``round(test_frac * n_class)`` rows of every class,
    chosen by hash order (M1, ``train_test_split(stratify=y)``).  Repeatable for a seed."""
    d = df.withColumn("_u", uniform_hash(key_cols, seed))
    d = group_row_index(d, [label], "_u", size="_n")
    return d.withColumn("is_test", F.col("_idx") < F.round(F.col("_n") * test_frac)).drop("_u", "_idx", "_n")


def stratified_folds(df: DataFrame, label: str, key_cols: Sequence[str], k: int = 5, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Fold number 0..k-1 dealt round-robin in hash order within each class, so every
    fold has the class mix of the whole (M3, ``StratifiedKFold(shuffle=True)``)."""
    d = df.withColumn("_u", uniform_hash(key_cols, seed + 7919))
    d = group_row_index(d, [label], "_u")
    return d.withColumn(name, (F.col("_idx") % k).cast("int")).drop("_u", "_idx")


# --------------------------------------------------------------------------- metrics

def confusion(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long confusion table ``(label, prediction, count)``."""
    return pred.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def _per_class_counts(pred: DataFrame, label: str, prediction: str) -> DataFrame:
    """``cls, tp, fp, fn, support`` from the k x k confusion rows (each cell counted
    once as its label's row and once as its prediction's column)."""
    cm = confusion(pred, label, prediction).withColumn("label", F.col("label").cast("string")).withColumn(
        "prediction", F.col("prediction").cast("string"))
    hit = F.col("label") == F.col("prediction")
    zero = F.lit(0).cast("long")
    roles = cm.select(
        F.explode(F.array(
            F.struct(F.col("label").alias("cls"), F.when(hit, F.col("count")).otherwise(zero).alias("tp"),
                     zero.alias("fp"), F.when(~hit, F.col("count")).otherwise(zero).alias("fn"),
                     F.col("count").alias("support")),
            F.struct(F.col("prediction").alias("cls"), zero.alias("tp"),
                     F.when(~hit, F.col("count")).otherwise(zero).alias("fp"), zero.alias("fn"),
                     zero.alias("support")),
        )).alias("_r")
    ).select("_r.*")
    return roles.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "support")])


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class precision / recall / F1 / support plus ``accuracy``, ``macro avg``,
    ``weighted avg`` and ``micro avg`` rows; 0/0 counts as 0 (M11, M12, M14).

    Everything after the first aggregate runs on the k x k confusion rows.
    """
    per = _per_class_counts(pred, label, prediction)

    def safe(n, d):
        return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(0.0))

    per = per.withColumns({
        "precision": safe(F.col("tp"), F.col("tp") + F.col("fp")),
        "recall": safe(F.col("tp"), F.col("tp") + F.col("fn")),
    })
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    tot = per.agg(
        F.sum("support").alias("n"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
    )
    acc = F.col("tp").cast("double") / F.col("n")

    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("cls"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        F.col("n").alias("support"))

    summary = tot.select(F.explode(F.array(
        row("accuracy", acc, acc, acc),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp"), F.col("wr"), F.col("wf")),
        row("micro avg", acc, acc, acc),
    )).alias("_s")).select("_s.*")
    return per.select("cls", "precision", "recall", "f1", "support").unionByName(summary)


def hard_label_auc(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One-vs-rest AUC of hard predictions per class: ``(TPR + 1 - FPR) / 2``."""
    per = _per_class_counts(pred, label, prediction)
    n = per.agg(F.sum("support").alias("_n")).withColumn("_one", F.lit(1))
    g = per.withColumn("_one", F.lit(1)).join(F.broadcast(n), "_one")
    pos = F.col("support")
    neg = F.col("_n") - pos
    tpr = F.when(pos > 0, F.col("tp") / pos).otherwise(0.0)
    fpr = F.when(neg > 0, F.col("fp") / neg).otherwise(0.0)
    return g.select("cls", tpr.alias("tpr"), fpr.alias("fpr"), ((tpr + 1 - fpr) / 2).alias("auc"))


def _score_counts(scored: DataFrame, is_positive: Column, score: Column, by: Sequence[str]) -> DataFrame:
    """Per group and distinct score ``_v``: positives and negatives with it (``_pos``, ``_neg``), with a
    smaller one (``_below``) and in all (``_all``). Rows are first counted per distinct score and the counts checkpointed,
    so that models score each row once; sums over smaller scores are those of ``order_stats.cumulated``."""
    one = F.lit(1).alias("_one")
    d = scored.select(*by, one, score.cast("double").alias("_v"), is_positive.cast("int").alias("_y"))
    per = d.groupBy(*by, "_one", "_v").agg(F.sum("_y").alias("_pos"), F.sum(1 - F.col("_y")).alias("_neg"))
    return cumulated(cut_lineage(per), [*by, "_one"], ["_pos", "_neg"]).drop("_one")


def roc_auc(scored: DataFrame, is_positive: Column, score: Column, by: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC (Mann-Whitney, ties count one half) per group (M16):
    ``sum over positives of (negatives below + negatives equal / 2) / (n_pos * n_neg)``."""
    agg = _score_counts(scored, is_positive, score, by).groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_neg_below") + F.col("_neg") / 2.0)).alias("_u"),
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"),
    )
    return agg.select(*by, "n_pos", "n_neg",
                      (F.col("_u") / (F.col("n_pos").cast("double") * F.col("n_neg").cast("double"))).alias("auc"))


def _roc_segments(scored: DataFrame, is_positive: Column, score: Column, by: Sequence[str]) -> DataFrame:
    """Per group and distinct score, the curve's step from ``(fpr0, tpr0)``, where only higher scores are
    taken, to ``(fpr, tpr)``, where this one is too. A rate without rows to count is NULL."""
    per = _score_counts(scored, is_positive, score, by)
    p, n = F.col("_pos_all") - F.col("_pos_below"), F.col("_neg_all") - F.col("_neg_below")
    return per.select(
        *by, F.col("_v").alias("threshold"),
        F.try_divide(p, F.col("_pos_all")).alias("tpr"), F.try_divide(n, F.col("_neg_all")).alias("fpr"),
        F.try_divide(p - F.col("_pos"), F.col("_pos_all")).alias("tpr0"), F.try_divide(n - F.col("_neg"), F.col("_neg_all")).alias("fpr0"),
    )


def roc_curve(scored: DataFrame, is_positive: Column, score: Column, by: Sequence[str] = ()) -> DataFrame:
    """The exact ROC curve: one point ``threshold, tpr, fpr`` per group and distinct score."""
    return _roc_segments(scored, is_positive, score, by).drop("tpr0", "fpr0")


def macro_roc(scored: DataFrame, is_positive: Column, score: Column, by: Sequence[str], grid: int = 100) -> DataFrame:
    """Macro-average ROC ``fpr, macro_tpr``: every group's curve is interpolated at ``grid`` even rates
    from 0 to 1 and averaged (M16, M27). At a vertical step the curve's upper end counts."""
    seg = _roc_segments(scored, is_positive, score, by)
    first, last = F.ceil(F.col("fpr0") * (grid - 1)), F.floor(F.col("fpr") * (grid - 1))
    at = seg.withColumn("_i", F.explode(F.when(first <= last, F.sequence(first, last))))
    x = F.col("_i") / F.lit(float(grid - 1))
    slope = F.try_divide(F.col("tpr") - F.col("tpr0"), F.col("fpr") - F.col("fpr0"))
    y = F.when(F.col("fpr") > F.col("fpr0"), F.col("tpr0") + (x - F.col("fpr0")) * slope).otherwise(F.col("tpr"))
    per = at.groupBy(*by, "_i").agg(F.max(y).alias("_y"))
    return per.groupBy("_i").agg(F.avg("_y").alias("macro_tpr")).select(x.alias("fpr"), "macro_tpr")


# --------------------------------------------------------------------------- models

def ovr_gbt(max_iter: int = 20, max_depth: int = 5, step_size: float = 0.1, subsampling_rate: float = 0.8,
            min_info_gain: float = 0.0, feature_subset: str = "all", seed: int = 42) -> OneVsRest:
    """Multiclass boosted trees as one-vs-rest binary GBTs (M6, M7): Spark's GBT is
    binary only.  Mapping: n_estimators -> maxIter, learning_rate -> stepSize,
    max_depth -> maxDepth, subsample -> subsamplingRate, gamma ~ minInfoGain,
    colsample ~ featureSubsetStrategy."""
    gbt = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, stepSize=step_size, subsamplingRate=subsampling_rate,
                        minInfoGain=min_info_gain, featureSubsetStrategy=feature_subset, seed=seed)
    return OneVsRest(classifier=gbt, parallelism=3)


def ovr_scores(pred: DataFrame, k: int, raw: str = "rawPrediction") -> DataFrame:
    """Per-class probabilities from one-vs-rest GBT margins: ``sigmoid(2 m_k)``
    normalised to sum to one (the binary GBT's own probability link)."""
    arr = vector_to_array(F.col(raw))
    sig = F.transform(arr, lambda m: 1.0 / (1.0 + F.exp(-2.0 * m)))
    total = F.aggregate(sig, F.lit(0.0), lambda acc, x: acc + x)
    return pred.withColumn("scores", F.transform(sig, lambda x: x / total))


def random_forest(num_trees: int = 100, max_depth: int = 15, min_instances: int = 2, subset: str = "log2",
                  bootstrap: bool = True, seed: int = 42) -> RandomForestClassifier:
    """Multiclass forest (M8); ``min_samples_split`` has no Spark counterpart."""
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, minInstancesPerNode=min_instances,
                                  featureSubsetStrategy=subset, bootstrap=bootstrap, seed=seed)


#: Nodes of a forest that are fitted at a time; a node takes some hundred bytes of the driver's memory.
FOREST_NODES = 1 << 19
#: Parts of a forest that are fitted one after the other; if there would be more, tasks may grow the trees on their own.
FEW_PARTS = 4


def forest_scores(train: DataFrame, rows: DataFrame, num_trees: int, max_depth: int, min_instances: int = 2, subset: str = "log2",
                  seed: int = 42, nodes: int | None = None, keys: Sequence[str] = (), one_task: int = 0) -> DataFrame:
    """``rows`` with the ``prediction`` and ``scores`` (class probabilities) of a forest fitted on ``train`` (M8).

    The driver holds all trees of a fit, so a forest that has more than about ``nodes`` nodes is fitted some trees at
    a time, each part with a seed of its own; the parts' votes are added up and checkpointed, and no part is kept. If
    the rows alone don't tell that it is smaller, the first trees do. With ``keys`` of the training rows and at most ``one_task`` rows
    in each of ``train`` and ``rows``, the trees after the first part of many are grown by tasks of their own (see ``forest``).
    """
    nodes = nodes or FOREST_NODES

    def fitted(trees: int, part: int = 0):
        return random_forest(trees, max_depth, min_instances, subset, seed=seed + 7919 * part).fit(train)

    n_train = train.count()
    per_tree = max(1.0, min(2.0 ** (max_depth + 1) - 1, 2 * n_train / min_instances))
    trees = min(num_trees, max(1, int(nodes / per_tree)))
    model = fitted(trees)
    if trees < num_trees and 1.25 * model.totalNumNodes / trees * num_trees <= nodes:
        trees, model = num_trees, fitted(num_trees)
    if trees == num_trees:
        return model.transform(rows).select(*rows.columns, vector_to_array("probability").alias("scores"), "prediction")
    summed, done, part = rows, 0, 0
    if keys and 1.25 * model.totalNumNodes / trees * num_trees > FEW_PARTS * nodes and max(n_train, rows.count()) <= one_task:
        first = vector_to_array("rawPrediction").alias("_votes")
        summed = cut_lineage(model.transform(rows).select(*rows.columns, first, F.monotonically_increasing_id().alias("_id")))
        features, classes = model.numFeatures, model.numClasses
        model = None
        drawn = max(1, int(np.ceil(np.log2(features)))) if subset == "log2" else features
        more = forest.votes(train, keys, summed, "_id", range(trees, num_trees), classes, max_depth, min_instances, drawn, seed)
        both = F.zip_with("_votes", "votes", lambda a, b: a + b).alias("_votes")
        summed = cut_lineage(summed.join(more, "_id").select(*rows.columns, both))
        done = num_trees
    while done < num_trees:
        votes = vector_to_array("rawPrediction")
        votes = F.zip_with(votes, "_votes", lambda a, b: a + b) if part else votes
        summed = cut_lineage(model.transform(summed).select(*rows.columns, votes.alias("_votes")))
        done, part = done + trees, part + 1
        if done == num_trees:
            break
        per_tree = max(1.0, 1.25 * model.totalNumNodes / trees)  # the next part's size by what this one has
        trees, model = min(num_trees - done, max(1, int(nodes / per_tree))), None
        model = fitted(trees, part)
    scores = F.transform("_votes", lambda v: v / F.lit(float(num_trees)))
    best = F.array_position("_votes", F.array_max("_votes")) - 1
    return summed.select(*rows.columns, scores.alias("scores"), best.cast("double").alias("prediction"))


def sample_params(space: dict, n_iter: int, seed: int) -> list[dict]:
    """Draw ``n_iter`` parameter sets from a space of lists, ``('int', lo, hi)`` and
    ``('uniform', lo, width)`` entries, seeded (M9's sampler, on the driver)."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n_iter):
        p = {}
        for name, spec in space.items():
            if isinstance(spec, list):
                p[name] = rnd.choice(spec)
            elif spec[0] == "int":
                p[name] = rnd.randrange(spec[1], spec[2])
            else:
                p[name] = spec[1] + rnd.random() * spec[2]
        out.append(p)
    return out


def run_concurrently(spark: SparkSession, jobs: Sequence[Callable[[], object]], parallelism: int = 4, name: str = "fits") -> list:
    """Results of ``jobs`` in their order, ``parallelism`` at a time, each from a thread of its own with a Spark job tag.

    If one fails, those not begun are dropped, the Spark jobs of the others are cancelled, also ones that they begin
    meanwhile, and its error is raised.
    """
    context, tag = spark.sparkContext, f"{name}-{uuid.uuid4().hex}"
    failed: list[BaseException] = []

    def run(job):
        if failed:
            return None
        context.addJobTag(tag)
        try:
            return job()
        except BaseException as e:
            failed.append(e)
            raise
        finally:
            context.removeJobTag(tag)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(run), job) for job in jobs]
        wait(running, return_when=FIRST_EXCEPTION)
        while failed and wait(running, timeout=0.2).not_done:
            context.cancelJobsWithTag(tag)
    if failed:
        raise failed[0]
    return [f.result() for f in running]


def kfold(df: DataFrame, key_cols: Sequence[str], k: int = 5, seed: int = 42, name: str = "fold") -> DataFrame:
    """Plain shuffled folds (M4, ``KFold(shuffle=True)``): numbers 0..k-1 dealt round-robin in hash order over all rows,
    so that sizes differ by one at most."""
    d = df.withColumns({"_u": uniform_hash(key_cols, seed + 104729), "_all": F.lit(0)})
    d = group_row_index(d, ["_all"], "_u")
    return d.withColumn(name, (F.col("_idx") % k).cast("int")).drop("_u", "_idx", "_all")


#: The ten scores of the source's cross validation: (name, row of the report, column).
SCORES = [("accuracy", "accuracy", "precision")] + [
    (f"{metric}_{avg}", f"{avg} avg", metric) for metric in ("precision", "recall", "f1") for avg in ("macro", "micro", "weighted")
]


def scores_of(pred: DataFrame, label: str = "label") -> dict[str, float]:
    """All of ``SCORES`` from one confusion table."""
    rows = {r["cls"]: r for r in classification_report(pred, label).filter(F.col("cls").isin([c for _, c, _ in SCORES])).collect()}
    return {name: float(rows[c][column]) if rows[c][column] is not None else float("nan") for name, c, column in SCORES}


def cross_validate(df: DataFrame, fold_col: str, k: int, fit: Callable[[DataFrame], object],
                   score: Callable[[DataFrame], dict[str, float]] = scores_of,
                   resample: Callable[[DataFrame], DataFrame] | None = None, parallelism: int = 4,
                   after: Callable[[DataFrame], None] | None = None) -> list[dict[str, float]]:
    """Per fold the scores of the model fitted on the other folds (M4, M10); ``resample`` (e.g. SMOTE) is applied to each
    training part only, never to the held-out fold.  Folds are fitted concurrently.  ``after`` gets the rows that a model was
    fitted on when the fold is done, to clear what was stored for it."""

    def one(f):
        train = df.filter(F.col(fold_col) != f)
        train = train if resample is None else resample(train)
        model = fit(train)
        scores = score(model.transform(df.filter(F.col(fold_col) == f)))
        if after is not None:
            after(train)
        return scores

    return run_concurrently(df.sparkSession, [lambda f=f: one(f) for f in range(k)], parallelism, "folds")


def score_frame(spark: SparkSession, per_fold: Sequence[dict[str, float]]) -> DataFrame:
    """``metric, fold_scores, mean, std`` (population, as numpy's) over the folds, one row per metric."""
    rows = []
    for metric in per_fold[0] if per_fold else []:
        values = [f[metric] for f in per_fold]
        rows.append((metric, values, float(np.mean(values)), float(np.std(values))))
    return spark.createDataFrame(rows, "metric string, fold_scores array<double>, mean double, std double")


def accuracy(pred: DataFrame) -> float:
    return float(pred.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0])


def random_search(df: DataFrame, fold_col: str, k: int, space: dict, n_iter: int,
                  fit: Callable[[dict, DataFrame], object], metric: str = "recall_macro", seed: int = 42,
                  resample: Callable[[DataFrame], DataFrame] | None = None, parallelism: int = 4,
                  prepare: Callable[[DataFrame], object] | None = None) -> list[tuple[dict, float, float]]:
    """Random hyper-parameter search with k-fold CV (M9): ``[(params, mean, std)]`` of ``metric``, best first, ties in the
    order drawn.  All ``n_iter * k`` fits go through one pool; the result does not depend on ``parallelism``.
    ``prepare`` makes what ``fit`` gets of a fold's training rows, once for all draws."""
    draws = sample_params(space, n_iter, seed)

    def training(f):
        train = df.filter(F.col(fold_col) != f)
        train = train if resample is None else resample(train)
        return train if prepare is None else prepare(train)

    ready = None if prepare is None else run_concurrently(df.sparkSession, [lambda f=f: training(f) for f in range(k)], parallelism, "folds")

    def one(params, f):
        model = fit(params, training(f) if ready is None else ready[f])
        return scores_of(model.transform(df.filter(F.col(fold_col) == f)))[metric]

    found = run_concurrently(df.sparkSession, [lambda p=p, f=f: one(p, f) for p in draws for f in range(k)], parallelism, "search")
    per_draw = [found[i * k : (i + 1) * k] for i in range(n_iter)]
    results = [(p, float(np.mean(s)), float(np.std(s))) for p, s in zip(draws, per_draw)]
    return sorted(results, key=lambda r: -r[1])


def forest_nodes(model, features: Sequence[str]) -> DataFrame:
    """``tree, node, feature, threshold, gain, cover`` of a fitted Spark forest, read from what it saves: ``gain`` is the
    impurity decrease times the node's rows, ``cover`` the node's rows (M18)."""
    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    node = F.col("nodeData")
    inner = node["leftChild"] >= 0
    names = F.array(*[F.lit(f) for f in features])
    return data.select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(inner, F.element_at(names, node["split"]["featureIndex"] + 1)).alias("feature"),
        F.when(inner, node["split"]["leftCategoriesOrThreshold"][0]).alias("threshold"),
        F.when(inner, node["gain"] * node["rawCount"]).otherwise(0.0).alias("gain"), node["rawCount"].cast("double").alias("cover"),
    )


def logistic(reg: float = 0.0, max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(regParam=reg, maxIter=max_iter)
