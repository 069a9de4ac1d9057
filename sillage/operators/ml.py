"""Purchase-intent models on MLlib.

* Encoders (M1/M2): one multi-column ``StringIndexer`` (alphabetical order, like a
  label encoder) fitted on the training rows only; an unseen or null label maps to
  code 0 like the reference, and an ``nb_inconnus`` column says how many codes of
  the row were unseen (0 is also a real class, so the flag is the only way to tell).
* Features (M10): 27 named columns, null → 0, one ``VectorAssembler``; the target-
  derived ``risque_abandon`` is appended only with ``legacy_features=True``.
* Split (M3): each row's hash is compared with its label's exact 80 % hash quantile (a
  two-row table), so the split is stratified, reproducible and needs no global sort.
* Balance (M4): synthetic minority rows (``operators/smote.py``) or class weights
  ``n / (2 n_class)`` in ``weightCol``.
* Models (M5-M7): logistic regression, random forest, gradient-boosted trees.  A deep forest
  of MLlib keeps a histogram per node in every partition, so its trees are grown in few
  partitions and several groups of trees side by side (``fit_forest``); the votes of the groups
  are added up.  On over ``FOREST_TABLE`` rows ``forest.py`` grows it.
* Metrics (M8): confusion counts from one aggregate; zero divisions give 0.
* Persistence (M9/K7): the fitted stages are one ``PipelineModel``, saved and loaded.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from . import forest as table_forest
from .joins import TRAIN_ROWS, broadcast_if_small, known_rows, materialize, right_size
from .smote import balanced, ranked
from .stats import exact_quantiles

ENCODED = {  # source column -> code column
    "category": "category_enc",
    "source": "source_enc",
    "page_visitee": "page_enc",
    "sentiment": "sentiment_enc",
    "profil_comportemental": "profil_enc",
}
FILL_LABEL = {"page_visitee": "unknown"}  # others: "nan", like str(NaN)
BASE_ENCODED = ["category", "source", "page_visitee"]


def feature_columns(legacy_features: bool = False) -> list[str]:
    cols = S.FEATURES_BASE + S.FEATURES_NLP + S.FEATURES_PROFILE + S.FEATURES_ENRICHED
    return cols + [S.LEAKY_FEATURE] if legacy_features else cols


def label_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null labels become text, as the reference's ``astype(str)`` / ``fillna`` do."""
    for c in columns:
        df = df.withColumn(f"{c}__lbl", F.coalesce(F.col(c).cast("string"),
                                                 F.lit(FILL_LABEL.get(c, "nan"))))
    return df


#: Labels of one column that an encoder may bring to the driver and keep in the model.
MAX_LABELS = 100_000


def encode_by_table(train: DataFrame, df: DataFrame, columns: list[str]) -> DataFrame:
    """M1-M2 for columns with any number of labels: the codes of ``fit_encoders`` as a table
    per column, numbered over range partitions and joined; no label reaches the driver."""
    unseen = F.lit(0)
    df = label_text(df, columns)
    for c in columns:
        labels = label_text(train, [c]).select(F.col(f"{c}__lbl").alias("_lbl")).distinct()
        codes = ranked(labels, ["_lbl"], "_code")
        known = broadcast_if_small(materialize(codes, "codes"))
        df = df.join(known, F.col(f"{c}__lbl") == F.col("_lbl"), "left").withColumn(ENCODED[c], F.coalesce("_code", F.lit(0)).cast("int"))
        unseen = unseen + F.col("_code").isNull().cast("int")
        df = df.withColumn("nb_inconnus", unseen).drop("_lbl", "_code", f"{c}__lbl")
        unseen = F.col("nb_inconnus")
    return df


def fit_encoders(train: DataFrame, columns: list[str]) -> PipelineModel:
    """M1: alphabetical codes per column, fitted on ``train``; M2: unseen → 0 + count.

    The model keeps all labels, so a column with more than ``MAX_LABELS`` (estimated first)
    is an error; ``encode_by_table`` takes such columns."""
    sizes = train.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    large = [c for c in columns if sizes[c] > MAX_LABELS]
    if large:
        raise ValueError(f"too many labels for an encoder model: {large}; use encode_by_table")
    idx = StringIndexer(inputCols=[f"{c}__lbl" for c in columns],
                        outputCols=[f"{c}__idx" for c in columns],
                        stringOrderType="alphabetAsc", handleInvalid="keep")
    model = idx.fit(label_text(train, columns))
    sizes = [len(lbls) for lbls in model.labelsArray]
    codes = ", ".join(
        f"CAST(CASE WHEN `{c}__idx` >= {n} THEN 0 ELSE `{c}__idx` END AS INT) AS `{ENCODED[c]}`"
        for c, n in zip(columns, sizes))
    unseen = " + ".join(f"CAST(`{c}__idx` >= {n} AS INT)" for c, n in zip(columns, sizes))
    sql = SQLTransformer(statement=f"SELECT *, {codes}, {unseen} AS nb_inconnus FROM __THIS__")
    labeller = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"coalesce(CAST(`{c}` AS STRING), '{FILL_LABEL.get(c, 'nan')}') AS `{c}__lbl`"
        for c in columns) + " FROM __THIS__")
    return PipelineModel(stages=[labeller, model, sql])


def assemble(df: DataFrame, legacy_features: bool = False) -> DataFrame:
    """The feature columns as doubles with null → 0."""
    cols = feature_columns(legacy_features)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*[c for c in df.columns if c not in cols],
                     *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])


def filler(legacy_features: bool = False) -> SQLTransformer:
    """M10 as a pipeline stage: feature columns as doubles, null → 0."""
    cols = feature_columns(legacy_features)
    return SQLTransformer(statement="SELECT *, " + ", ".join(
        f"coalesce(CAST(`{c}` AS DOUBLE), 0.0) AS `{c}__x`" for c in cols) + " FROM __THIS__")


def assembler(legacy_features: bool = False) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"{c}__x" for c in feature_columns(legacy_features)],
                           outputCol="features", handleInvalid="keep")


def stratified_split(df: DataFrame, label: str, key: str, train_share: float = 0.8,
                     seed: int = 42) -> DataFrame:
    """M3: adds ``split`` = 'train'/'test', stratified by ``label``, reproducible.

    Every row gets a 52-bit number from the md5 of its key and the seed; the cut is each
    label's exact ``train_share`` quantile of them (one row per label), so the split is
    the same however the rows are partitioned.  No window, no sort of the whole table.
    """
    text = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f"|{seed}"))
    h = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")  # exact below 2**53
    hashed = materialize(df.withColumn("_h", h), "split-hash")
    stratum = F.coalesce(F.col(label).cast("string"), F.lit(""))
    cuts = exact_quantiles(hashed.select(stratum.alias("colonne"), F.col("_h").alias("valeur")), [train_share])
    cuts = cuts.select(F.col("colonne").alias("_stratum"), F.col("quantile").alias("_cut"))
    return (hashed.withColumn("_stratum", stratum).join(F.broadcast(cuts), "_stratum", "left")
            .withColumn("split", F.when(F.col("_h") <= F.col("_cut"), "train").otherwise("test"))
            .drop("_h", "_cut", "_stratum"))


def class_weights(train: DataFrame, label: str, weight_col: str = "poids") -> DataFrame:
    """M4 (balancing): weight n / (k n_c) per class through a scalar subquery per class."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    k = counts.agg(F.count(F.lit(1))).scalar()
    n = train.agg(F.count(F.lit(1))).scalar()
    return (train.join(F.broadcast(counts), label)
            .withColumn(weight_col, n / (k * F.col("_nc")))
            .drop("_nc"))


def classifiers(n_train: int, label: str = "intention_achat", weight_col: str = "poids",
                rf_trees: int = 100, rf_depth: int = 20, gbt_rounds: int = 100,
                seed: int = 42) -> dict:
    """M5-M7 with the reference's settings (forest depth is bounded in MLlib)."""
    common = {"featuresCol": "features", "labelCol": label, "weightCol": weight_col}
    return {
        "Logistic Regression": LogisticRegression(
            maxIter=1000, regParam=1.0 / max(n_train, 1), standardization=False, **common),
        "Random Forest": RandomForestClassifier(
            numTrees=rf_trees, featureSubsetStrategy="sqrt", maxDepth=rf_depth, seed=seed,
            cacheNodeIds=True,
            **common),
        # trees of depth 3 are walked faster than their node ids are kept (the same trees)
        "Gradient Boosting": GBTClassifier(maxIter=gbt_rounds, stepSize=0.1, maxDepth=3,
                                           seed=seed, **common),
    }


#: Groups that the trees of a large forest are grown in; rows of a partition that grows trees.
FOREST_GROUPS, FOREST_ROWS = 20, 500_000
#: Rows beyond which a forest is grown as a table of trees (``forest.py``).
FOREST_TABLE = 50_000


class VoteSum(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A forest's raw votes, probability and prediction from those of its groups of trees."""

    groups = Param(Params._dummy(), "groups", "number of votes columns", typeConverter=TypeConverters.toInt)

    def __init__(self, groups: int | None = None):
        super().__init__()
        if groups is not None:
            self._set(groups=groups)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = [f"votes_{k}" for k in range(self.getOrDefault(self.groups))]
        votes = [vector_to_array(c) for c in names]
        added = votes[0]
        for v in votes[1:]:
            added = F.zip_with(added, v, lambda a, b: a + b)
        return table_forest.voted(df.withColumn("_votes", added).drop(*names))


def fit_forest(forest: RandomForestClassifier, train: DataFrame, stages: list, groups: int = FOREST_GROUPS,
               rows_per_partition: int = FOREST_ROWS) -> list:
    """The fitted stages of ``forest`` after ``stages`` on the materialised ``train``.

    Each pass of MLlib's growing keeps and shuffles a histogram per open node and partition,
    whatever rows the node has: the same trees in p partitions cost p times that.  So trees are
    grown in partitions of ``rows_per_partition`` rows, and as many groups of trees at a time
    as fill the cores.  A forest on few rows (``right_size``) is fitted at once; one on more than
    ``FOREST_TABLE``, whose nodes and hence histograms grow with the rows, is left to ``forest.py``.
    """
    trees = forest.getNumTrees()
    if known_rows(train) > FOREST_TABLE:
        rows = PipelineModel(stages=stages).transform(right_size(train))
        return [*stages, table_forest.fit(rows, forest.getLabelCol(), forest.getWeightCol(), forest.getFeaturesCol(), trees,
                                          forest.getMaxDepth(), forest.getMaxBins(), forest.getSeed())]
    groups = min(groups, trees)
    few = right_size(train, rows_per_partition)
    if known_rows(train) <= TRAIN_ROWS or groups < 2:
        return Pipeline(stages=[*stages, forest]).fit(few).stages
    rows = PipelineModel(stages=stages).transform(few).select(forest.getLabelCol(), forest.getWeightCol(), forest.getFeaturesCol())

    def grow(k: int):
        own = {forest.numTrees: trees // groups + (k < trees % groups), forest.seed: forest.getSeed() + k,
               forest.rawPredictionCol: f"votes_{k}", forest.probabilityCol: "", forest.predictionCol: ""}
        return forest.fit(rows, own)

    spark = train.sparkSession
    at_once = max(1, min(groups, spark.sparkContext.defaultParallelism // max(1, few.rdd.getNumPartitions())))
    pool = ThreadPool(at_once)
    try:
        grown = pool.map(inheritable_thread_target(spark)(grow), range(groups), chunksize=1)
    finally:
        pool.close()
    return [*stages, *grown, VoteSum(groups)]


def per_core(train: DataFrame) -> DataFrame:
    """A large training set in one even partition a core (of up to ``FOREST_ROWS`` rows), for
    boosting: its hundreds of short passes pay for every task; a small one as by ``right_size``."""
    n, cores = known_rows(train), train.sparkSession.sparkContext.defaultParallelism
    if n <= TRAIN_ROWS * cores:
        return right_size(train)
    return train.repartition(max(cores, math.ceil(n / FOREST_ROWS)))


def binary_metrics(pred: DataFrame, label: str = "intention_achat",
                   prediction: str = "prediction") -> DataFrame:
    """M8: per-class precision / recall / F1 / support and overall accuracy.

    One aggregate gives the four confusion counts; every ratio with a zero
    denominator is 0 (like zero_division=0).
    """
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    c = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
                 F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"),
                 F.count_if((y == 0) & (p == 0)).alias("tn"))

    def ratio(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    rows = F.array(
        F.struct(F.lit(0).alias("classe"), F.lit("Abandon").alias("nom"),
                 ratio(tn, tn + fn).alias("precision"), ratio(tn, tn + fp).alias("rappel"),
                 (tn + fp).alias("support")),
        F.struct(F.lit(1).alias("classe"), F.lit("Achat").alias("nom"),
                 ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("rappel"),
                 (tp + fn).alias("support")))
    out = c.select(F.explode(rows).alias("r"), ratio(tp + tn, total).alias("accuracy"))
    pr, rc = F.col("r.precision"), F.col("r.rappel")
    return out.select(
        "r.classe", "r.nom", F.round(pr, 3).alias("precision"), F.round(rc, 3).alias("rappel"),
        F.round(ratio(2 * pr * rc, pr + rc), 3).alias("f1"), "r.support",
        F.round("accuracy", 3).alias("accuracy"))


@dataclass
class Comparison:
    results: DataFrame
    best_name: str | None
    best_model: PipelineModel | None
    models: dict = field(default_factory=dict)


def oversampled(train: DataFrame, label: str, id_col: str, legacy_features: bool = False,
                weight_col: str = "poids") -> DataFrame:
    """M4: encoded training rows plus the synthetic ones that balance the classes."""
    return balanced(train, label, id_col, feature_columns(legacy_features)).withColumn(weight_col, F.lit(1.0))


def compare_models(prepared: DataFrame, label: str = "intention_achat",
                   legacy_features: bool = False, balance: str = "weights", id_col: str = "event_id", **clf_kw) -> Comparison:
    """M5-M8 + L6: fit each model on the training part, score the test part, pick the
    best F1 (strictly above 0, first one wins ties).  ``balance`` is ``weights`` or
    ``smote`` (synthetic minority rows; ``id_col`` must be a unique integer).

    ``prepared`` has the feature columns (not yet encoded), ``label`` and ``split``.
    """
    spark = prepared.sparkSession
    # Training is iterative: read the prepared rows from a written table, not from
    # the upstream plan, and keep the partition count proportional to the rows.
    prepared = right_size(materialize(prepared, "ml-prepared"))
    train = prepared.filter(F.col("split") == "train")
    test = prepared.filter(F.col("split") == "test")
    enc = fit_encoders(train, list(ENCODED))
    prep = [filler(legacy_features), assembler(legacy_features)]
    if balance not in ("weights", "smote"):
        raise ValueError(f"unknown balance {balance!r}")
    coded = enc.transform(train)
    weighted = oversampled(coded, label, id_col, legacy_features) if balance == "smote" else class_weights(coded, label)
    written = materialize(weighted, "ml-train")
    train_w = right_size(written)
    n_train = known_rows(train_w)
    rows, fitted = [], {}
    best_f1, best_name, best_model = 0.0, None, None
    test_x = enc.transform(test)
    for name, clf in classifiers(n_train, label, **clf_kw).items():
        t0 = time.time()
        if isinstance(clf, RandomForestClassifier):
            m = PipelineModel(stages=fit_forest(clf, written, prep))
        else:
            m = Pipeline(stages=[*prep, clf]).fit(per_core(written) if isinstance(clf, GBTClassifier) else train_w)
        t_train = time.time() - t0
        t0 = time.time()
        met = binary_metrics(m.transform(test_x), label).filter("classe = 1").first()
        t_inf = time.time() - t0
        full = PipelineModel(stages=[*enc.stages, *m.stages])
        fitted[name] = full
        rows.append((name, float(met["precision"]), float(met["rappel"]), float(met["f1"]),
                     float(met["accuracy"]), round(t_train, 3), round(t_inf, 4)))
        if met["f1"] > best_f1:
            best_f1, best_name, best_model = met["f1"], name, full
    res = spark.createDataFrame(rows, "modele string, precision double, rappel double, "
                                      "f1 double, accuracy double, temps_train double, "
                                      "temps_inference double")
    res = res.withColumn("meilleur", F.col("modele") == F.lit(best_name))
    return Comparison(res, best_name, best_model, fitted)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M9: prediction and purchase probability in % (one decimal) on executors."""
    out = model.transform(df)
    return (out.withColumn("proba_achat",
                           F.round(vector_to_array("probability")[1] * 100.0, 1))
            .withColumn("prediction", F.col("prediction").cast("int")))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
