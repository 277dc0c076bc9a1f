"""Model, stacking and selection queries (T1-T11, K1-K9, E18, E19, L2-L4,
B6, B7, F19, S6). Learned outputs on all features depend on Spark ML internals
and seeds, so these have no SQL twin (rows-only check); the tests check
properties (OOF rows never scored by a model that saw them, ranges, seed
determinism, loss below the constant prior). The ``*_group_shares`` queries
run the same operators on the dummies of one categorical, where the fitted
model is the mean of each category, and have exact twins."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stackyard.operators import encode as E
from stackyard.operators import folds as FO
from stackyard.operators import models as MO
from stackyard.operators import stack as ST
from stackyard.operators.estimators import LinearGroupsFeature, LogitFeature
from stackyard.operators.metrics import log_loss
from stackyard.plans.common import r6
from stackyard.plans.fixture_sql import FX1, with_
from stackyard.session import shared_folder
from stackyard.sources import fixtures as fx
from stackyard.sources.sinks import append_log

QUERIES, SQL = {}, {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


NUM = ["o_totalprice", "c_acctbal", "c_nationkey"]
#: Values of a categorical that may become columns.
MAX_VALUES = 200


def with_dummies(d, cols, dtype="double"):
    """Dummies of the values that the data has (fitted, not listed), behind the other columns."""
    lists = E.value_lists(d, cols, MAX_VALUES)
    return d.select(*[c for c in d.columns if c not in cols],
                    *[x for c in cols for x in E.dummies(c, lists[c] or [], dtype=dtype)])


def claims_features(spark, sf):
    d = fx.claims(spark, sf)
    return with_dummies(d.select(
        "id", F.col("target").cast("double").alias("label"), "is_train",
        F.coalesce("o_totalprice", F.lit(-999.0)).alias("o_totalprice"),
        F.coalesce("c_acctbal", F.lit(-999.0)).alias("c_acctbal"),
        F.col("c_nationkey").cast("double").alias("c_nationkey"), "o_orderpriority", "c_mktsegment"),
        ["o_orderpriority", "c_mktsegment"])


def cats(d):
    """The dummies of the priority alone: models on them are class shares."""
    return [c for c in d.columns if c.startswith("o_orderpriority_")]


def dums(d):
    return cats(d) + [c for c in d.columns if c.startswith("c_mktsegment_")]


def feats(d):
    return NUM + dums(d)


def split_claims(spark, sf, folds=4):
    d = claims_features(spark, sf)
    train = FO.stratified_kfold(d.where("is_train"), "label", folds)
    test = d.where("NOT is_train")
    return train, test


def ordinal_features(spark, sf):
    d = fx.ordinal(spark, sf)
    return with_dummies(d.select("id", "response", "is_train", "p_retailprice",
                                 (F.col("p_size") % 7).cast("double").alias("size_mod"), "p_type"), ["p_type"])


def ord_feats(d):
    return ["p_retailprice", "size_mod"] + [c for c in d.columns if c.startswith("p_type_")]


def _holdout(spark, sf):
    d = claims_features(spark, sf).where("is_train")
    return ST.kept(FO.positional_holdout(d, 0.75))


def _fit_score(spark, sf, kind, regression=False, **params):
    h = _holdout(spark, sf)
    fit_part = MO.assemble(h.where("is_fit"), feats(h))
    valid = MO.assemble(h.where("NOT is_fit"), feats(h))
    m = MO.estimator(kind, "label", **params).fit(fit_part)
    return MO.predict(m, valid, "pred", regression).select("id", "label", "pred")


@q("t1_decision_tree")
def t1_decision_tree(spark, sf):
    return _fit_score(spark, sf, "tree", max_depth=6)


@q("t2_random_forest")
def t2_random_forest(spark, sf):
    return _fit_score(spark, sf, "forest", trees=10, max_depth=6)


@q("t3_extra_trees")
def t3_extra_trees(spark, sf):
    return _fit_score(spark, sf, "extra_trees", trees=10, max_depth=8)


@q("t4_boosted_trees")
def t4_boosted_trees(spark, sf):
    return _fit_score(spark, sf, "boost", rounds=10, max_depth=4, rate=0.1)


@q("t5_gradient_boosting")
def t5_gradient_boosting(spark, sf):
    return _fit_score(spark, sf, "gbt", rounds=5, max_depth=3, rate=0.3, subsample=0.8)


@q("t2_forest_regression")
def t2_forest_regression(spark, sf):
    return _fit_score(spark, sf, "forest_reg", regression=True, trees=20, max_depth=6).withColumnRenamed("pred", "value")


@q("t3_extra_trees_regression")
def t3_extra_trees_regression(spark, sf):
    return _fit_score(spark, sf, "extra_trees_reg", regression=True, trees=10, max_depth=8).withColumnRenamed("pred", "value")


@q("t6_linear_models")
def t6_linear_models(spark, sf):
    h = _holdout(spark, sf)
    fit_part, valid = MO.assemble(h.where("is_fit"), feats(h)), MO.assemble(h.where("NOT is_fit"), feats(h))
    n = h.where("is_fit").count()
    lr = MO.estimator("logistic", "label", C=1.0, n_rows=n, max_iter=50).fit(fit_part)
    lin = MO.estimator("linear", "label").fit(fit_part)
    nb = MO.estimator("bernoulli_nb", "label", features="flags").fit(MO.assemble(h.where("is_fit"), dums(h), "flags"))
    out = MO.predict(lr, MO.assemble(valid, dums(h), "flags"), "logistic")
    out = MO.predict(lin, out, "linear", regression=True)
    return MO.predict(nb, out, "bernoulli_nb").select("id", "logistic", "linear", "bernoulli_nb")


@q("t9_cv_score")
def t9_cv_score(spark, sf):
    train, _ = split_claims(spark, sf)
    return MO.cv_score(MO.assemble(train, feats(train)), "tree", 4, "label", max_depth=5).drop("seconds")


#: The sweep: depth x leaf x three models, each over five folds.
SWEEP = {"max_depth": [4, 7], "min_leaf": [1, 20]}
SWEEP_OWN = {"forest": {"trees": 5, "max_features": "onethird"}, "extra_trees": {"trees": 3, "max_features": "onethird"},
             "boost": {"rounds": 5, "rate": 0.3, "subsample": 0.85, "patience": 2}}


@q("t10_grid_sweep")
def t10_grid_sweep(spark, sf):
    train, _ = split_claims(spark, sf, folds=5)
    points = MO.grid_points(["forest", "extra_trees", "boost"], SWEEP, SWEEP_OWN)
    log = MO.grid_sweep(MO.assemble(train, feats(train)), points, 5, "label", features=None)
    return log.select("model", "rounds", "depth", "weight", "best_round_mean", "best_round_max", "cv_loss", "cv_std", "train_loss", "train_std")


@q("t11_random_search")
def t11_random_search(spark, sf):
    d = claims_features(spark, sf).where("is_train")
    d = MO.assemble(FO.random_split(d, 0.9, seed=2017), feats(d))
    return MO.random_search(d, "forest", {"max_depth": (3, 8), "trees": (3, 12), "min_leaf": (1, 30)}, 10, seed=2017)


@q("k1_oof_bumps")
def k1_oof_bumps(spark, sf):
    d = ordinal_features(spark, sf)
    return ST.oof_bumps(d.where("is_train"), d.where("NOT is_train"), ord_feats(d), "response", 8, "tree", 4, max_depth=4)


@q("k2_oof_multiclass")
def k2_oof_multiclass(spark, sf):
    d = ordinal_features(spark, sf)
    train = FO.stratified_kfold(d.where("is_train"), "response", 4)
    models = {"p_forest": ("forest", {"trees": 5, "max_depth": 5}), "p_logistic": ("logistic", {"max_iter": 50})}
    return ST.oof_multiclass(train, d.where("NOT is_train"), ord_feats(d), "response", 8, models, 4, scale=True)


@q("k3_oof_regression")
def k3_oof_regression(spark, sf):
    d = ordinal_features(spark, sf).withColumn("label", F.col("response").cast("double"))
    train = FO.stratified_kfold(d.where("is_train"), "response", 4)
    return ST.oof_predict(train, d.where("NOT is_train"), ord_feats(d), "label", "linear", 4,
                          regression=True, name="regr")


@q("k4_oof_blend_mean")
def k4_oof_blend_mean(spark, sf):
    train, test = split_claims(spark, sf)
    return ST.oof_predict(train, test, feats(train), "label", "tree", 4, test_mode="mean", max_depth=5)


LEVEL1 = {"rfc": ("forest", {"trees": 10, "max_depth": 8, "min_leaf": 2, "criterion": "entropy"}),
          "etc": ("extra_trees", {"trees": 10, "max_depth": 8, "min_leaf": 2}),
          "etc_wide": ("extra_trees", {"trees": 10, "max_depth": 8, "min_leaf": 2, "cuts": 31, "seed": 9527}),
          "boost": ("boost", {"rounds": 8, "max_depth": 4, "rate": 0.3, "patience": 3})}


@q("k5_holdout_stack")
def k5_holdout_stack(spark, sf):
    d = claims_features(spark, sf)
    train = FO.random_split(d.where("is_train"), 0.3, seed=2017)
    rest, test = ST.holdout_stack(train, d.where("NOT is_train"), feats(d), "label", LEVEL1)
    cols = ["id", "label", *LEVEL1]
    return rest.select(*cols).unionByName(test.select(*cols))


def _level1(spark, sf):
    train, test = split_claims(spark, sf)
    a = ST.oof_predict(train, test, feats(train), "label", "tree", 4, name="tree_oof", max_depth=5)
    b = ST.oof_predict(train, test, feats(train), "label", "logistic", 4, name="logit_oof", max_iter=30)
    lv = a.join(b, "id")
    return (train.select("id", "label").join(lv, "id"), test.select("id").join(lv, "id"))


@q("k6_meta_logistic")
def k6_meta_logistic(spark, sf):
    tr, te = _level1(spark, sf)
    return ST.meta_learner(tr, te, ["tree_oof", "logit_oof"], "label", "logistic")


@q("k7_meta_seeds")
def k7_meta_seeds(spark, sf):
    """Boosted and extra-tree second levels, each the mean over its seeds."""
    tr, te = _level1(spark, sf)
    cols = ["tree_oof", "logit_oof"]
    boosted = ST.meta_learner(tr, te, cols, "label", "boost", seeds=[1, 2, 3], name="p_boost", rounds=8, max_depth=3, rate=0.3,
                              subsample=0.8, patience=3)
    trees = ST.meta_learner(tr, te, cols, "label", "extra_trees", seeds=[1, 2, 3], name="p_trees", trees=5, max_depth=4)
    both = boosted.join(trees, "id")
    return both.withColumn("pred", (F.col("p_boost") + F.col("p_trees")) / 2)


@q("k8_seed_bagging")
def k8_seed_bagging(spark, sf):
    train, test = split_claims(spark, sf)
    return ST.meta_learner(train, test, feats(train), "label", "forest", seeds=[11, 22, 33], trees=5, max_depth=6)


@q("k9_soft_vote")
def k9_soft_vote(spark, sf):
    train, test = split_claims(spark, sf)
    return ST.soft_vote(train, test, feats(train), "label",
                        {"a": ("tree", {"max_depth": 5}), "b": ("forest", {"trees": 5, "max_depth": 5}),
                         "c": ("extra_trees", {"trees": 5, "max_depth": 6})})


@q("e18_logit_feature")
def e18_logit_feature(spark, sf):
    d = fx.claims(spark, sf).select("id", F.col("target").cast("double").alias("label"), "is_train",
                                    "o_orderpriority", "c_mktsegment", "c_nationkey")
    return ST.logit_feature_from_categoricals(d.where("is_train"), d.drop("label"),
                                              ["o_orderpriority", "c_mktsegment", "c_nationkey"], "label",
                                              k=200, C=10.0)


@q("e19_logit_feature_folds")
def e19_logit_feature_folds(spark, sf):
    train, _ = split_claims(spark, sf)
    return ST.logit_feature_in_folds(train, dums(train), "label", 4)


@q("l2_chi2_select")
def l2_chi2_select(spark, sf):
    d = claims_features(spark, sf).where("is_train")
    names = ST.chi2_select(d, dums(d), "label", 4)
    return spark.createDataFrame([(n,) for n in names], "name string")


@q("l3_importance_select")
def l3_importance_select(spark, sf):
    d = claims_features(spark, sf).where("is_train")
    imp = ST.importance_select(d, feats(d), "label", 0.0, trees=10, max_depth=5)
    return spark.createDataFrame(imp, "name string, importance double")


@q("l4_linear_groups")
def l4_linear_groups(spark, sf):
    d = claims_features(spark, sf)
    scaled = d.select("id", "label", "is_train", (F.col("o_totalprice") / 5e5).alias("price"),
                      (F.col("c_acctbal") / 1e4).alias("acct"), (F.col("c_nationkey") / 25).alias("nation"),
                      *dums(d))
    cols = ["price", "acct", "nation", *dums(d)]
    g = LinearGroupsFeature(inputCols=cols, groups=2, maxElements=8, seed=7).fit(scaled.where("is_train"))
    out = g.transform(scaled)
    new = [c for c in out.columns if c not in scaled.columns]
    return out.select("id", *new)


@q("b7_platt_calibration")
def b7_platt_calibration(spark, sf):
    h = _holdout(spark, sf)
    fit_part = MO.assemble(h.where("is_fit"), feats(h))
    m = MO.estimator("tree", "label", max_depth=6).fit(fit_part)
    scored = MO.predict(m, MO.assemble(h.where("NOT is_fit"), feats(h))).select("id", "label", "pred")
    cal_fit = scored.where(F.col("id") % 2 == 0)  # fitted on one half, applied to all of the holdout
    return MO.platt_calibrate(cal_fit, scored, "label", "pred").select("id", "pred", "calibrated")


@q("f19_polynomial")
def f19_polynomial(spark, sf):
    d = claims_features(spark, sf)
    p = MO.polynomial(d.select("id", (F.col("o_totalprice") / 1e5).alias("a"),
                               (F.col("c_acctbal") / 1e3).alias("b")), ["a", "b"], 2)
    return p.select("id", vector_to_array("poly").alias("poly"))


@q("s6_cv_log_row")
def s6_cv_log_row(spark, sf):
    """The 19-field log row of one cross-validated model, appended to a log in
    the shared folder and read back."""
    train, _ = split_claims(spark, sf)
    row = MO.grid_sweep(MO.assemble(train, feats(train)), [("tree", {"max_depth": 4, "min_leaf": 5})], 4, "label")
    path = shared_folder(spark, "cv-log")
    append_log(row, path)
    kept = spark.read.schema(MO.LOG_SCHEMA).parquet(path)
    return kept.select("model", "criterion", "depth", "weight", "best_round_mean", "cv_loss", "cv_std", "train_loss", "train_std", "folds", "shape", "options")


@q("x4_estimator_protocol")
def x4_estimator_protocol(spark, sf):
    """Estimator / Model protocol: staged Spark ML estimators fit, then transform."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    train, test = split_claims(spark, sf)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=feats(train), outputCol="features"),
                            MO.estimator("tree", "label", max_depth=4)])
    model = pipe.fit(train)
    return MO.positive_probability(model.transform(test)).select("id", "pred")


@q("x6_evaluator_cross_validator")
def x6_evaluator_cross_validator(spark, sf):
    """Scorer callback: a log-loss Evaluator inside CrossValidator with the
    stratified fold column (foldCol) and parallel fits."""
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    train, _ = split_claims(spark, sf, folds=3)
    est = MO.estimator("tree", "label")
    grid = ParamGridBuilder().addGrid(est.maxDepth, [2, 4]).build()
    cv = CrossValidator(estimator=est, estimatorParamMaps=grid, evaluator=MO.LogLossEvaluator("label"),
                        foldCol="fold", parallelism=2)
    rows = MO.assemble(train, feats(train)).select("label", "fold", "features").persist()  # read by every fit and score
    m = cv.fit(rows)
    rows.unpersist()
    return spark.createDataFrame([(2, float(m.avgMetrics[0])), (4, float(m.avgMetrics[1]))],
                                 "max_depth int, cv_logloss double")


@q("x7_fold_feature_hook")
def x7_fold_feature_hook(spark, sf):
    """Per-fold feature hook: a pipeline fits the logit feature on the other
    folds' rows before the model is fit and scored."""
    train, _ = split_claims(spark, sf, folds=3)
    stages = [LogitFeature(inputCols=dums(train))]
    return MO.cv_score(train, "tree", 3, "label", stages=stages, features=feats(train) + ["logit_feat"], max_depth=4).drop("seconds")


# ------------------------------------------------------------ models that are group means

ALL_FEATURES = {"trees": 3, "max_depth": 6, "max_features": "all"}
ROWS = """d AS (SELECT id, target, is_train, coalesce(o_orderpriority, 'nan') AS pr FROM fx1)"""
HOLDOUT = """h AS (SELECT *, row_number() OVER (ORDER BY id) - 1 < floor(count(*) OVER () * 0.75) AS is_fit FROM d WHERE is_train),
g AS (SELECT pr, avg(target) AS p FROM h WHERE is_fit GROUP BY pr)"""
HOLDOUT_SQL = with_(FX1, ROWS, HOLDOUT) + "SELECT h.id, round(g.p, 6) AS pred FROM h JOIN g ON h.pr = g.pr WHERE NOT is_fit"
FOLDS = """f AS (SELECT id, target, pr, ntile({k}) OVER (PARTITION BY target ORDER BY id) - 1 AS fold FROM d WHERE is_train),
m AS (SELECT k.fold, f.pr, avg(f.target) AS p FROM f, (SELECT DISTINCT fold FROM f) k WHERE f.fold <> k.fold GROUP BY 1, 2)"""
ALL_TRAIN = """g AS (SELECT pr, avg(target) AS p FROM d WHERE is_train GROUP BY pr)"""
TEST_SQL = with_(FX1, ROWS, ALL_TRAIN) + "SELECT d.id, round(g.p, 6) AS pred FROM d JOIN g ON d.pr = g.pr WHERE NOT is_train"


def _holdout_shares(spark, sf, kind, regression=False, **params):
    h = _holdout(spark, sf)
    h = MO.assemble(h, cats(h))
    m = MO.estimator(kind, "label", **params).fit(h.where("is_fit"))
    return MO.predict(m, h.where("NOT is_fit"), "pred", regression).select("id", r6("pred"))


@q("t1_tree_group_shares", HOLDOUT_SQL)
def t1_tree_group_shares(spark, sf):
    return _holdout_shares(spark, sf, "tree", max_depth=6)


@q("b6_score_gate", with_(FX1, ROWS, HOLDOUT, """s AS (SELECT h.id, h.target AS y, g.p FROM h JOIN g ON h.pr = g.pr WHERE NOT is_fit),
l AS (SELECT avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS loss FROM s)""") + """
SELECT lim AS "limit", s.id, round(s.p, 6) AS pred FROM s, l, (VALUES (0.70::DOUBLE), (0.50::DOUBLE)) t(lim) WHERE l.loss < lim""")
def b6_score_gate(spark, sf):
    """Both branches of the gate: the looser limit lets the scores out."""
    h = _holdout(spark, sf)
    h = MO.assemble(h, cats(h))
    m = MO.estimator("tree", "label", max_depth=6).fit(h.where("is_fit"))
    p = MO.predict(m, h.where("NOT is_fit")).select("id", "label", "pred").persist()
    loss = log_loss(p, "label", "pred").first()[0]
    out = [MO.gated(p.select(F.lit(x).alias("limit"), "id", r6("pred")), loss, x) for x in (0.70, 0.50)]
    return out[0].unionByName(out[1])


@q("t3_extra_trees_group_shares", HOLDOUT_SQL)
def t3_extra_trees_group_shares(spark, sf):
    return _holdout_shares(spark, sf, "extra_trees", **ALL_FEATURES)


@q("t6_linear_group_means", HOLDOUT_SQL)
def t6_linear_group_means(spark, sf):
    return _holdout_shares(spark, sf, "linear", regression=True)


@q("t9_cv_group_shares", with_(FX1, ROWS, FOLDS.format(k=4), """s AS (
  SELECT m.fold, f.fold <> m.fold AS is_fit, f.target AS y, m.p FROM f JOIN m ON f.pr = m.pr)""") + """
SELECT CAST(fold AS INTEGER) AS fold, round(avg(CASE WHEN is_fit THEN -(y * ln(p) + (1 - y) * ln(1 - p)) END), 6) AS train_loss,
       round(avg(CASE WHEN NOT is_fit THEN -(y * ln(p) + (1 - y) * ln(1 - p)) END), 6) AS cv_loss FROM s GROUP BY fold""")
def t9_cv_group_shares(spark, sf):
    train, _ = split_claims(spark, sf)
    cv = MO.cv_score(MO.assemble(train, cats(train)), "tree", 4, "label", max_depth=6)
    return cv.select("fold", r6("train_loss"), r6("cv_loss"))


@q("k4_oof_group_shares", with_(FX1, ROWS, FOLDS.format(k=4)) + """
SELECT f.id, round(m.p, 6) AS pred FROM f JOIN m ON f.fold = m.fold AND f.pr = m.pr
UNION ALL SELECT d.id, round(avg(m.p), 6) FROM d JOIN m ON d.pr = m.pr WHERE NOT is_train GROUP BY d.id""")
def k4_oof_group_shares(spark, sf):
    train, test = split_claims(spark, sf)
    out = ST.oof_predict(train, test, cats(train), "label", "tree", 4, test_mode="mean", max_depth=6)
    return out.select("id", r6("pred"))


@q("k3_oof_group_means", with_(FX1, ROWS, FOLDS.format(k=4), ALL_TRAIN) + """
SELECT f.id, round(m.p, 6) AS regr FROM f JOIN m ON f.fold = m.fold AND f.pr = m.pr
UNION ALL SELECT d.id, round(g.p, 6) FROM d JOIN g ON d.pr = g.pr WHERE NOT is_train""")
def k3_oof_group_means(spark, sf):
    train, test = split_claims(spark, sf)
    out = ST.oof_predict(train, test, cats(train), "label", "linear", 4, regression=True, name="regr")
    return out.select("id", r6("regr"))


@q("k5_holdout_group_shares", with_(FX1, ROWS, f"""h AS (
  SELECT *, CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT) < {int(round(0.3 * 16 ** 15))} AS is_fit FROM d),
g AS (SELECT pr, avg(target) AS p FROM h WHERE is_train AND is_fit GROUP BY pr)""") + """
SELECT h.id, round(g.p, 6) AS tree_l1, round(g.p, 6) AS forest_l1 FROM h JOIN g ON h.pr = g.pr WHERE NOT (is_train AND is_fit)""")
def k5_holdout_group_shares(spark, sf):
    d = claims_features(spark, sf)
    train = FO.random_split(d.where("is_train"), 0.3, seed=2017)
    rest, test = ST.holdout_stack(train, d.where("NOT is_train"), cats(d), "label",
                                  {"tree_l1": ("tree", {"max_depth": 6}), "forest_l1": ("extra_trees", ALL_FEATURES)})
    cols = ["id", r6("tree_l1"), r6("forest_l1")]
    return rest.select(*cols).unionByName(test.select(*cols))


@q("k8_seeds_group_shares", TEST_SQL)
def k8_seeds_group_shares(spark, sf):
    train, test = split_claims(spark, sf)
    out = ST.meta_learner(train, test, cats(train), "label", "extra_trees", seeds=[11, 22, 33], **ALL_FEATURES)
    return out.select("id", r6("pred"))


@q("k9_vote_group_shares", TEST_SQL)
def k9_vote_group_shares(spark, sf):
    train, test = split_claims(spark, sf)
    out = ST.soft_vote(train, test, cats(train), "label", {"a": ("tree", {"max_depth": 6}), "b": ("extra_trees", ALL_FEATURES)})
    return out.select("id", r6("pred"))


@q("x4_protocol_group_shares", TEST_SQL)
def x4_protocol_group_shares(spark, sf):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    train, test = split_claims(spark, sf)
    pipe = Pipeline(stages=[VectorAssembler(inputCols=cats(train), outputCol="features"), MO.estimator("tree", "label", max_depth=6)])
    return MO.positive_probability(pipe.fit(train).transform(test)).select("id", r6("pred"))
