"""Queries for section K (ML stages and estimators).  Learned outputs have no SQL twin; their queries
return the scored rows (or run metrics) and the tests check stated properties."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tessera.plans import ml as K
from tessera.plans.catalog import register
from tessera.plans.derived import LANGUAGES, LETTERS, letter_shares
from tessera.session import cut_lineage, scratch_path, table


def _emb(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
                    F.col("label").cast("double").alias("label"))


@register(
    "ml_string_index",
    """SELECT p_partkey, CAST(idx AS DOUBLE) AS p_type_idx FROM part JOIN (
         SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx FROM part GROUP BY p_type) USING (p_type)""",
)
def q_string_index(spark, sf_dir):
    return K.string_index(table(spark, sf_dir, "part"), ["p_type"]).select("p_partkey", "p_type_idx")


@register("ml_index_to_string", "SELECT p_partkey, p_type AS p_type_back FROM part")
def q_index_to_string(spark, sf_dir):
    from pyspark.ml.feature import StringIndexer

    p = table(spark, sf_dir, "part")
    m = StringIndexer(inputCol="p_type", outputCol="p_type_idx").fit(p)
    return K.index_to_string(m.transform(p), "p_type_idx", m.labels, "p_type_back").select("p_partkey", "p_type_back")


@register(
    "ml_one_hot",
    """WITH i AS (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS idx, count(*) OVER () AS n FROM part GROUP BY p_type)
       SELECT p_partkey, list_transform(range(n - 1), lambda j: CASE WHEN j = idx THEN 1.0 ELSE 0.0 END) AS onehot FROM part JOIN i USING (p_type)""",
)
def q_one_hot(spark, sf_dir):
    p = K.string_index(table(spark, sf_dir, "part"), ["p_type"])
    return K.one_hot_encode(p, ["p_type_idx"]).select("p_partkey", vector_to_array("p_type_idx_vec").alias("onehot"))


@register(
    "ml_assemble",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, [l_quantity, l_discount, l_tax] AS features FROM lineitem",
)
def q_assemble(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    a = K.assemble(li, ["l_quantity", "l_discount", "l_tax"])
    return a.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", vector_to_array("features").alias("features"))


@register(
    "ml_standard_scale",
    """SELECT o_orderkey, round(o_totalprice / (SELECT stddev_samp(o_totalprice) FROM orders), 6) AS scaled FROM orders""",
)
def q_standard_scale(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = K.assemble(o, ["o_totalprice"], "x")
    s = K.standard_scale(a, "x", "xs")
    return s.select("o_orderkey", F.round(vector_to_array("xs")[0], 6).alias("scaled"))


@register(
    "ml_binarize",
    "SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0.05 THEN 1.0 ELSE 0.0 END) AS bits FROM embeddings",
)
def q_binarize(spark, sf_dir):
    e = _emb(spark, sf_dir)
    return K.binarize(e, "features", "bits", 0.05).select("vec_id", vector_to_array("bits").alias("bits"))


@register("ml_pca")
def q_pca(spark, sf_dir):
    """Projection of the embeddings on 3 principal components (signs are free)."""
    return K.pca(_emb(spark, sf_dir), "features", 3).select("vec_id", vector_to_array("pca").alias("pca"))


# The known market segments of the census-style feature example.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]


@register("ml_census_features")
def q_census(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    f = K.census_features(c, {"c_mktsegment": SEGMENTS}, ["c_nationkey"], ["c_acctbal"])
    return f.select("c_custkey", vector_to_array("features").alias("features"))


@register(
    "ml_feature_stages",
    """SELECT o_orderkey, CAST((SELECT count(DISTINCT o_orderpriority) FROM orders) + (SELECT count(DISTINCT o_orderstatus) FROM orders) + 1
              AS INTEGER) AS n_features FROM orders""",
)
def q_feature_stages(spark, sf_dir):
    """Fitted chain of feature stages applied to the orders (one vector per order)."""
    o = table(spark, sf_dir, "orders")
    m = K.feature_stages(["o_orderpriority", "o_orderstatus"], ["o_totalprice"]).fit(o)
    return m.transform(o).select("o_orderkey", F.size(vector_to_array("features")).alias("n_features"))


@register(
    "ml_linear_regression",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem",
)
def q_linreg(spark, sf_dir):
    """One-feature least squares in closed form (``regr_slope`` / ``regr_intercept``)."""
    li = table(spark, sf_dir, "lineitem")
    return li.agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 6).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
    )


def _li_features(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return K.assemble(li, ["l_quantity", "l_discount", "l_tax"]).select("features", F.col("l_extendedprice").alias("label"))


@register("ml_linear_regression_fit")
def q_linreg_fit(spark, sf_dir):
    m = K.linreg(_li_features(spark, sf_dir), "features", "label")
    return spark.createDataFrame([(float(m.intercept), [float(x) for x in m.coefficients])], "intercept double, coefficients array<double>")


def _split(df, key):
    marked = K.held_out(df, key)
    return marked, marked.where(~F.col("held_out"))


@register("ml_elastic_net")
def q_elastic(spark, sf_dir):
    """Fitted on three quarters of the order keys, measured on the last one."""
    li = K.assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    d = K.held_out(li.select("l_orderkey", "features", F.col("l_extendedprice").alias("label")), "l_orderkey").select("features", "label", "held_out")
    return K.elastic_net(d.where(~F.col("held_out")), d.where("held_out"), "features", "label", [0.1, 1.0], [0.0, 0.5])


@register("ml_forest_regression")
def q_rf_reg(spark, sf_dir):
    """Predictions of all rows; those held out have not been learnt from."""
    li = K.assemble(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])
    d, train = _split(li.select("l_orderkey", "features", F.col("l_extendedprice").alias("label")), "l_orderkey")
    return K.rf_regress(train, "features", "label", trees=10).transform(d).select("label", "prediction", "held_out")


@register("ml_forest_classifier")
def q_rf_cls(spark, sf_dir):
    e, train = _split(_emb(spark, sf_dir), "vec_id")
    m = K.rf_classify(train, "features", "label", trees=10)
    return m.transform(e).select("vec_id", "label", "prediction", vector_to_array("probability").alias("probability"),
                                 vector_to_array("rawPrediction").alias("raw"), "held_out")


@register("ml_boosted_trees")
def q_boosted(spark, sf_dir):
    e = _emb(spark, sf_dir).withColumn("is_valid", (F.col("vec_id") % 5) == 0)
    m = K.boosted(e, "features", "label", "is_valid", iters=5)
    return m.transform(e).select("vec_id", "prediction")


@register("ml_cross_validate")
def q_cv(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cv = K.cross_validate(e, "features", "label", [2, 4], folds=2)
    return spark.createDataFrame([(float(d), float(s)) for d, s in zip([2, 4], cv.avgMetrics)], "max_depth double, accuracy double")


@register("ml_mlp_grid")
def q_mlp(spark, sf_dir):
    e = _emb(spark, sf_dir)
    cv = K.mlp_grid(e, "features", "label", 64, 10, [16, 32], folds=2)
    return spark.createDataFrame([(float(h), float(s)) for h, s in zip([16, 32], cv.avgMetrics)], "hidden double, accuracy double")


def _chosen(spark, sf_dir, select, name):
    """Tell the language of a document by its letters: select on three quarters, keep the best pipeline,
    score the last quarter with what was saved."""
    # the narrow table is written once: every fold, round and tree reads it, not the texts
    shares = cut_lineage(letter_shares(spark, sf_dir)).select("doc_id", array_to_vector("shares").alias("features"), "label")
    d, train = _split(shares, "doc_id")
    best = K.kept_best(select(train), scratch_path(spark, name))
    return best.transform(d.where("held_out")).select("doc_id", "label", "prediction", vector_to_array("probability").alias("probability"))


@register("ml_cross_validate_best")
def q_cv_best(spark, sf_dir):
    return _chosen(spark, sf_dir, lambda d: K.cross_validate(d, "features", "label", [2, 6], folds=2, trees=10), "forest")


@register("ml_mlp_grid_best")
def q_mlp_best(spark, sf_dir):
    return _chosen(spark, sf_dir, lambda d: K.mlp_grid(d, "features", "label", len(LETTERS), len(LANGUAGES), [8, 16], folds=2), "perceptron")


@register(
    "ml_feature_values",
    """WITH p AS (SELECT o_orderpriority AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) AS i FROM orders GROUP BY 1),
            s AS (SELECT o_orderstatus AS v, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS i FROM orders GROUP BY 1),
            n AS (SELECT (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM s) AS ns, stddev_samp(o_totalprice) AS sd FROM orders)
       SELECT o_orderkey, list_concat(list_concat(list_transform(range(1, np + 1), lambda k: CASE WHEN k = p.i THEN 1.0 ELSE 0.0 END),
                                                  list_transform(range(1, ns + 1), lambda k: CASE WHEN k = s.i THEN 1.0 ELSE 0.0 END)),
                                      [round(o_totalprice / sd, 6)])::DOUBLE[] AS features
       FROM orders JOIN p ON p.v = o_orderpriority JOIN s ON s.v = o_orderstatus, n""",
)
def q_feature_values(spark, sf_dir):
    """The vectors of the fitted chain of feature stages."""
    o = table(spark, sf_dir, "orders")
    m = K.feature_stages(["o_orderpriority", "o_orderstatus"], ["o_totalprice"]).fit(o)
    return m.transform(o).select("o_orderkey", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


def _fit_pipeline(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    from pyspark.ml.regression import LinearRegression

    stages = K.feature_stages(["o_orderpriority"], ["o_custkey"]).getStages()
    lr = LinearRegression(featuresCol="features", labelCol="o_totalprice")
    return o, Pipeline(stages=[*stages, lr]).fit(o)


@register("ml_batch_score")
def q_batch_score(spark, sf_dir):
    o, m = _fit_pipeline(spark, sf_dir)
    return K.score(o, m, ["o_orderkey", "prediction"])


@register("ml_save_load")
def q_save_load(spark, sf_dir):
    """Persist the fitted chain in the shared scratch folder, load it and score again."""
    o, m = _fit_pipeline(spark, sf_dir)
    path = scratch_path(spark, "model")
    K.save_model(m, path)
    return K.score(o, K.load_model(path), ["o_orderkey", "prediction"])
