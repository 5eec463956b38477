"""Spark ML feature stages and estimators (inventory section K).  Estimators are the distributed ones
of ``pyspark.ml``; vectors are turned back into arrays with ``vector_to_array`` at the edges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    PCA,
    Binarizer,
    FeatureHasher,
    IndexToString,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def string_index(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Labels to ids by falling frequency (ties alphabetical)."""
    idx = StringIndexer(inputCols=list(cols), outputCols=[f"{c}_idx" for c in cols], stringOrderType="frequencyDesc")
    return idx.fit(df).transform(df)


def index_to_string(df: DataFrame, col: str, labels: Sequence[str], out: str) -> DataFrame:
    return IndexToString(inputCol=col, outputCol=out, labels=list(labels)).transform(df)


def one_hot_encode(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Index columns to indicator vectors with the last category left out."""
    enc = OneHotEncoder(inputCols=list(cols), outputCols=[f"{c}_vec" for c in cols], dropLast=True)
    return enc.fit(df).transform(df)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def standard_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    """Divide by the sample standard deviation, no centring."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=False, withStd=True).fit(df).transform(df)


def binarize(df: DataFrame, col: str, out: str, threshold: float) -> DataFrame:
    return Binarizer(inputCol=col, outputCol=out, threshold=threshold).transform(df)


def pca(df: DataFrame, col: str, k: int, out: str = "pca") -> DataFrame:
    return PCA(k=k, inputCol=col, outputCol=out).fit(df).transform(df)


def census_features(df: DataFrame, vocab: Mapping[str, Sequence[str]], hashed: Sequence[str], numeric: Sequence[str],
                    buckets: int = 64) -> DataFrame:
    """Indicator columns for known vocabularies (unknown values get their own slot), hashed
    categories and numeric columns in one feature vector."""
    out = df
    enc_in = []
    for c, labels in vocab.items():
        out = StringIndexerModel.from_labels(list(labels), inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep").transform(out)
        enc_in.append(f"{c}_idx")
    out = OneHotEncoder(inputCols=enc_in, outputCols=[f"{c}_vec" for c in enc_in], dropLast=False).fit(out).transform(out)
    out = FeatureHasher(inputCols=list(hashed), outputCol="hashed", numFeatures=buckets, categoricalCols=list(hashed)).transform(out)
    return VectorAssembler(inputCols=[f"{c}_vec" for c in enc_in] + ["hashed", *numeric], outputCol="features").transform(out)


def feature_stages(cat_cols: Sequence[str], num_cols: Sequence[str]) -> Pipeline:
    """Index, one-hot, assemble and scale: fitted once, reused for scoring."""
    idx = StringIndexer(inputCols=list(cat_cols), outputCols=[f"{c}_idx" for c in cat_cols], handleInvalid="keep")
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols], outputCols=[f"{c}_vec" for c in cat_cols])
    num = VectorAssembler(inputCols=list(num_cols), outputCol="num_raw", handleInvalid="keep")
    scale = StandardScaler(inputCol="num_raw", outputCol="num_scaled", withMean=False, withStd=True)
    allf = VectorAssembler(inputCols=[f"{c}_vec" for c in cat_cols] + ["num_scaled"], outputCol="features")
    return Pipeline(stages=[idx, enc, num, scale, allf])


def linreg(df: DataFrame, features: str, label: str, reg: float = 0.0, l1: float = 0.0):
    return LinearRegression(featuresCol=features, labelCol=label, regParam=reg, elasticNetParam=l1).fit(df)


def held_out(df: DataFrame, key: str, parts: int = 4, name: str = "held_out") -> DataFrame:
    """Mark one row in ``parts``, told by the hash of its key, as not to be learnt from."""
    return df.withColumn(name, F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(parts)) == 0)


def elastic_net(train: DataFrame, test: DataFrame, features: str, label: str, alphas: Sequence[float], ratios: Sequence[float]) -> DataFrame:
    """One fit on ``train`` per (alpha, l1 ratio); RMSE, MAE and R2 on ``test`` kept per run."""
    train = train.persist()
    rows = []
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    for a in alphas:
        for r in ratios:
            p = linreg(train, features, label, a, r).transform(test)
            rows.append((float(a), float(r), ev.evaluate(p, {ev.metricName: "rmse"}), ev.evaluate(p, {ev.metricName: "mae"}),
                         ev.evaluate(p, {ev.metricName: "r2"})))
    train.unpersist()
    return test.sparkSession.createDataFrame(rows, "alpha double, l1_ratio double, rmse double, mae double, r2 double")


def rf_regress(df: DataFrame, features: str, label: str, seed: int = 42, trees: int = 20):
    return RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=trees, seed=seed).fit(df)


def rf_classify(df: DataFrame, features: str, label: str, seed: int = 42, trees: int = 20):
    return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, seed=seed).fit(df)


def boosted(df: DataFrame, features: str, label: str, valid_col: str, iters: int = 10):
    """Multi-class boosted trees (one-vs-rest) with early stopping on the validation rows."""
    gbt = GBTClassifier(featuresCol=features, labelCol=label, maxIter=iters, validationIndicatorCol=valid_col, seed=42)
    return OneVsRest(classifier=gbt, featuresCol=features, labelCol=label).fit(df)


def _selected(estimator, grid, label: str, folds: int, seed: int, df: DataFrame):
    ev = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    return CrossValidator(estimator=Pipeline(stages=[estimator]), estimatorParamMaps=grid, evaluator=ev, numFolds=folds, seed=seed).fit(df)


def cross_validate(df: DataFrame, features: str, label: str, depths: Sequence[int], folds: int = 2, seed: int = 42, trees: int = 10):
    """Forests of each depth by cross-validation: ``avgMetrics`` are the accuracies, ``bestModel`` is the
    pipeline of the best one, fitted on all of ``df``."""
    rf = RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=trees, seed=seed)
    return _selected(rf, ParamGridBuilder().addGrid(rf.maxDepth, list(depths)).build(), label, folds, seed, df)


def mlp_grid(df: DataFrame, features: str, label: str, n_in: int, n_out: int, hidden: Sequence[int], folds: int = 2):
    """Perceptrons of each hidden width by cross-validation, as ``cross_validate``."""
    mlp = MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, maxIter=50, seed=42, layers=[n_in, hidden[0], n_out])
    return _selected(mlp, ParamGridBuilder().addGrid(mlp.layers, [[n_in, h, n_out] for h in hidden]).build(), label, folds, 42, df)


def kept_best(selection, path: str) -> PipelineModel:
    """The best pipeline of a selection, saved at ``path`` and loaded from there."""
    save_model(selection.bestModel, path)
    return load_model(path)


def score(df: DataFrame, model: PipelineModel, keep: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*keep)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

