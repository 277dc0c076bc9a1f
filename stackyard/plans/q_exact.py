"""Model queries with exact SQL twins. On the dummies of one categorical a
saturated model is a table of each category's mean, share or Newton step, so
boosting curves, folds, sweeps, bumps, selections and leave-fold-out encodings
can all be written in SQL."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stackyard.operators import assoc as AS
from stackyard.operators import boosting as BO
from stackyard.operators import encode as E
from stackyard.operators import folds as FO
from stackyard.operators import models as MO
from stackyard.operators import stack as ST
from stackyard.operators.estimators import AnovaSelector, LinearGroupsFeature, LogitFeature
from stackyard.plans.common import r6
from stackyard.plans.fixture_sql import FX1, FX2, FX4, with_
from stackyard.plans.q_models import (ALL_FEATURES, ALL_TRAIN, FOLDS, HOLDOUT, HOLDOUT_SQL, ROWS, TEST_SQL, _holdout,
                                      _holdout_shares, cats, claims_features, dums, feats, ord_feats, ordinal_features,
                                      split_claims, with_dummies)
from stackyard.plans.q_stats import OFFS_SQL
from stackyard.sources import fixtures as fx

QUERIES, SQL = {}, {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ T2-T4: trees

@q("t2_forest_group_shares", HOLDOUT_SQL)
def t2_forest_group_shares(spark, sf):
    """A forest whose trees see every row and every feature."""
    return _holdout_shares(spark, sf, "forest", bootstrap=False, **ALL_FEATURES)


@q("t2_forest_reg_group_means", HOLDOUT_SQL)
def t2_forest_reg_group_means(spark, sf):
    return _holdout_shares(spark, sf, "forest_reg", regression=True, bootstrap=False, **ALL_FEATURES)


@q("t3_extra_trees_reg_group_means", HOLDOUT_SQL)
def t3_extra_trees_reg_group_means(spark, sf):
    return _holdout_shares(spark, sf, "extra_trees_reg", regression=True, **ALL_FEATURES)


@q("t4_boost_group_shares", HOLDOUT_SQL.replace("g.p, 6", "g.p, 5"))
def t4_boost_group_shares(spark, sf):
    """Newton steps end within some 1e-8 of the shares (five digits)."""
    out = _holdout_shares(spark, sf, "boost", rounds=6, max_depth=6, rate=1.0)
    return out.withColumn("pred", F.round("pred", 5))


@q("t4_regression_group_means", HOLDOUT_SQL)
def t4_regression_group_means(spark, sf):
    return _holdout_shares(spark, sf, "boost_reg", regression=True, rounds=2, max_depth=6, rate=1.0)


@q("t4_softprob")
def t4_softprob(spark, sf):
    """Boosted probabilities of the eight ordered classes."""
    d = ordinal_features(spark, sf)
    train = MO.assemble(d.where("is_train").withColumn("label", (F.col("response") - 1).cast("double")), ord_feats(d))
    m = MO.estimator("softmax_boost", "label", classes=8, rounds=5, max_depth=4, rate=0.3).fit(train)
    out = m.transform(MO.assemble(d.where("NOT is_train"), ord_feats(d)))
    return MO.class_probabilities(out, 8, "p_", offset=1).select("id", *[f"p_{i}" for i in range(1, 9)])


@q("t4_softprob_group_shares", """WITH s AS (SELECT CAST(o_orderkey AS BIGINT) AS id, o_orderkey % 10 < 7 AS is_train, o_orderstatus AS st,
  CASE WHEN o_orderkey % 13 = 0 THEN 'nan' ELSE o_orderpriority END AS pr FROM orders),
g AS (SELECT pr, avg(CAST(st = 'F' AS INTEGER)) AS p_0, avg(CAST(st = 'O' AS INTEGER)) AS p_1, avg(CAST(st = 'P' AS INTEGER)) AS p_2
  FROM s WHERE is_train GROUP BY pr)
SELECT s.id, round(p_0, 5) AS p_0, round(p_1, 5) AS p_1, round(p_2, 5) AS p_2 FROM s JOIN g ON s.pr = g.pr WHERE NOT is_train""")
def t4_softprob_group_shares(spark, sf):
    """Three classes boosted together reach each category's class shares."""
    d = with_dummies(fx.statuses(spark, sf), ["o_orderpriority"])
    m = MO.estimator("softmax_boost", "label", classes=3, rounds=7, max_depth=6, rate=1.0).fit(MO.assemble(d.where("is_train"), cats(d)))
    out = m.transform(MO.assemble(d.where("NOT is_train"), cats(d)))
    return MO.class_probabilities(out, 3).select("id", *[F.round(c, 5).alias(c) for c in ("p_0", "p_1", "p_2")])


# ------------------------------------------------------------ T8, T9: best round

@q("t8_early_stopping")
def t8_early_stopping(spark, sf):
    """Losses of every round until the validation loss has not fallen for three."""
    h = _holdout(spark, sf).withColumn("is_valid", ~F.col("is_fit"))
    m = MO.estimator("boost", "label", rounds=30, max_depth=3, rate=0.3, valid_col="is_valid", patience=3).fit(MO.assemble(h, feats(h)))
    return BO.curve_table(spark, m)


def _curve_sql(rate: float, rounds: int, patience: int) -> str:
    """Squared-loss boosting on a saturated category: after r rounds a prediction
    is the mean plus 1 - (1 - rate)^r of its category's distance from it."""
    return f"""m AS (SELECT avg(target) AS mean FROM h WHERE is_fit),
c AS (SELECT r, is_fit, avg(pow(h.target - (m.mean + (1 - pow({1 - rate}, r)) * (g.p - m.mean)), 2)) AS loss
  FROM h JOIN g ON h.pr = g.pr, m, range(0, {rounds + 1}) t(r) GROUP BY r, is_fit),
w AS (SELECT r, max(CASE WHEN is_fit THEN loss END) AS train_loss, max(CASE WHEN NOT is_fit THEN loss END) AS valid_loss FROM c GROUP BY r),
b AS (SELECT w.*, (SELECT min(x.r) FROM w x WHERE x.r <= w.r AND x.valid_loss = (SELECT min(y.valid_loss) FROM w y WHERE y.r <= w.r)) AS best FROM w),
stop AS (SELECT coalesce(min(CASE WHEN r - best >= {patience} THEN r END), {rounds}) AS r FROM b)"""


@q("t8_curve_group_means", with_(FX1, ROWS, HOLDOUT, _curve_sql(0.5, 12, 3)) + """
SELECT CAST(b.r AS INTEGER) AS round, round(train_loss, 6) AS train_loss, round(valid_loss, 6) AS valid_loss,
       b.r = (SELECT best FROM b x, stop WHERE x.r = stop.r) AS is_best FROM b, stop WHERE b.r <= stop.r""")
def t8_curve_group_means(spark, sf):
    """The boosting curve, its stop and its best round."""
    h = _holdout(spark, sf).withColumn("is_valid", ~F.col("is_fit"))
    m = MO.estimator("boost_reg", "label", rounds=12, max_depth=6, rate=0.5, valid_col="is_valid", patience=3).fit(MO.assemble(h, cats(h)))
    return BO.curve_table(spark, m).select("round", r6("train_loss"), r6("valid_loss"), "is_best")


@q("t8_staged_group_means", with_(FX1, ROWS, HOLDOUT, """m AS (SELECT avg(target) AS mean FROM h WHERE is_fit)""") + """
SELECT CAST(r AS INTEGER) AS round, round(avg(pow(h.target - (m.mean + (1 - pow(0.5, r)) * (g.p - m.mean)), 2)), 6) AS loss
FROM h JOIN g ON h.pr = g.pr, m, range(0, 6) t(r) WHERE NOT is_fit GROUP BY r""")
def t8_staged_group_means(spark, sf):
    """The loss of every prefix on rows that the fit did not measure, in one pass."""
    h = _holdout(spark, sf)
    h = MO.assemble(h, cats(h))
    m = MO.estimator("boost_reg", "label", rounds=5, max_depth=6, rate=0.5).fit(h.where("is_fit"))
    return BO.staged_losses(m, h.where("NOT is_fit")).select(F.col("round").cast("int"), r6("loss"))


@q("t9_best_round_group_means", with_(FX1, ROWS, """f AS (SELECT id, target, pr, ntile(3) OVER (PARTITION BY target ORDER BY id) - 1 AS fold FROM d WHERE is_train),
k AS (SELECT DISTINCT fold FROM f),
m AS (SELECT k.fold, avg(f.target) AS mean FROM f, k WHERE f.fold <> k.fold GROUP BY 1),
g AS (SELECT k.fold, f.pr, avg(f.target) AS p FROM f, k WHERE f.fold <> k.fold GROUP BY 1, 2),
c AS (SELECT m.fold, r, f.fold = m.fold AS out, avg(pow(f.target - (m.mean + (1 - pow(0.5, r)) * (g.p - m.mean)), 2)) AS loss
  FROM f JOIN g ON f.pr = g.pr JOIN m ON m.fold = g.fold, range(0, 5) t(r) GROUP BY 1, 2, 3),
w AS (SELECT fold, r, max(CASE WHEN NOT out THEN loss END) AS train_loss, max(CASE WHEN out THEN loss END) AS cv_loss FROM c GROUP BY 1, 2),
b AS (SELECT fold, min_by(r, cv_loss) AS r FROM (SELECT * FROM w ORDER BY fold, r) GROUP BY fold),
s AS (SELECT r, avg(cv_loss) AS mean FROM w GROUP BY r), o AS (SELECT min_by(r, mean) AS r FROM (SELECT * FROM s ORDER BY r))""") + """
SELECT CAST(b.fold AS INTEGER) AS fold, CAST(b.r AS INTEGER) AS best_round, round(x.train_loss, 6) AS train_loss, round(x.cv_loss, 6) AS cv_loss,
       CAST(o.r AS INTEGER) AS common_round, round(y.train_loss, 6) AS common_train_loss, round(y.cv_loss, 6) AS common_cv_loss
FROM b JOIN w x ON x.fold = b.fold AND x.r = b.r, o JOIN w y ON y.r = o.r WHERE y.fold = b.fold""")
def t9_best_round_group_means(spark, sf):
    """Boosted rounds cross-validated: each fold's best round and the common one."""
    train, _ = split_claims(spark, sf, folds=3)
    out = BO.cross_validated_rounds(MO.assemble(train, cats(train)), "boost_reg", 3, label="label", rounds=4, max_depth=6, rate=0.5, patience=9)
    return out.select("fold", "best_round", r6("train_loss"), r6("cv_loss"), "common_round", r6("common_train_loss"), r6("common_cv_loss"))


# ------------------------------------------------------------ T10, T11, S6, X6, X7: sweeps and folds

CV_LOSSES = """s AS (SELECT m.fold, f.fold <> m.fold AS is_fit, -(f.target * ln(m.p) + (1 - f.target) * ln(1 - m.p)) AS l FROM f JOIN m ON f.pr = m.pr),
cv AS (SELECT fold, avg(CASE WHEN is_fit THEN l END) AS train_loss, avg(CASE WHEN NOT is_fit THEN l END) AS cv_loss FROM s GROUP BY fold),
cvs AS (SELECT avg(cv_loss) AS cv_loss, stddev_pop(cv_loss) AS cv_std, avg(train_loss) AS train_loss, stddev_pop(train_loss) AS train_std FROM cv)"""
LOG_SQL = "round(cv_loss, 6) AS cv_loss, round(cv_std, 6) AS cv_std, round(train_loss, 6) AS train_loss, round(train_std, 6) AS train_std"


def _losses(df):
    return [r6(c) for c in ("cv_loss", "cv_std", "train_loss", "train_std")]


@q("s6_log_group_shares", with_(FX1, ROWS, FOLDS.format(k=4), CV_LOSSES) + f"""
SELECT 'DTC' AS model, CAST(NULL AS INTEGER) AS rounds, 'gini' AS criterion, CAST(6 AS INTEGER) AS depth, CAST(1 AS INTEGER) AS weight,
  CAST(NULL AS VARCHAR) AS features, CAST(NULL AS DOUBLE) AS subsample, CAST(NULL AS BOOLEAN) AS bootstrap, CAST(NULL AS DOUBLE) AS rate,
  CAST(0 AS DOUBLE) AS best_round_mean, CAST(0 AS INTEGER) AS best_round_max, {LOG_SQL}, CAST(4 AS INTEGER) AS folds,
  (SELECT count(*) FROM f) AS n_rows FROM cvs""")
def s6_log_group_shares(spark, sf):
    """The log row of a saturated tree; its time is left out, its shape is the rows."""
    train, _ = split_claims(spark, sf)
    row = MO.grid_sweep(MO.assemble(train, cats(train)), [("tree", {"max_depth": 6, "min_leaf": 1})], 4, "label")
    names = [c for c in row.columns if c not in ("seconds", "shape", "options", "cv_loss", "cv_std", "train_loss", "train_std")]
    return row.select(*names, *_losses(row), F.col("shape")[0].alias("n_rows"))


@q("t10_sweep_group_shares", with_(FX1, ROWS, FOLDS.format(k=3), CV_LOSSES) + f"""
SELECT CAST(depth AS INTEGER) AS depth, CAST(leaf AS INTEGER) AS weight, model, {LOG_SQL}
FROM cvs, (VALUES (6), (8)) a(depth), (VALUES (1), (2)) b(leaf), (VALUES ('DTC'), ('ETC')) c(model)""")
def t10_sweep_group_shares(spark, sf):
    """Every point of a grid over two models whose trees are saturated at both depths."""
    train, _ = split_claims(spark, sf, folds=3)
    points = MO.grid_points(["tree", "extra_trees"], {"max_depth": [6, 8], "min_leaf": [1, 2]}, {"extra_trees": {"trees": 1, "max_features": "all"}})
    log = MO.grid_sweep(MO.assemble(train, cats(train)), points, 3, "label")
    return log.select("depth", "weight", "model", *_losses(log))


@q("t11_search_group_shares", with_(FX1, ROWS, f"""h AS (
  SELECT *, CAST('0x' || substr(md5('2017:' || id), 1, 15) AS BIGINT) < {int(round(0.9 * 16 ** 15))} AS is_fit FROM d WHERE is_train),
g AS (SELECT pr, avg(target) AS p FROM h WHERE is_fit GROUP BY pr)""") + """
SELECT round(avg(h.target * ln(g.p) + (1 - h.target) * ln(1 - g.p)), 6) AS score FROM h JOIN g ON h.pr = g.pr, range(0, 4) t(i) WHERE NOT is_fit GROUP BY i""")
def t11_search_group_shares(spark, sf):
    """Four trials whose trees are all deep enough: equal scores."""
    d = claims_features(spark, sf).where("is_train")
    d = MO.assemble(FO.random_split(d, 0.9, seed=2017), cats(d))
    return MO.random_search(d, "tree", {"max_depth": (6, 9)}, 4, seed=7).select(r6("score"))


@q("x6_cross_validator_group_shares", with_(FX1, ROWS, FOLDS.format(k=3), CV_LOSSES) + """
SELECT CAST(depth AS INTEGER) AS max_depth, round(cv_loss, 6) AS cv_logloss FROM cvs, (VALUES (6), (7)) a(depth)""")
def x6_cross_validator_group_shares(spark, sf):
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    train, _ = split_claims(spark, sf, folds=3)
    est = MO.estimator("tree", "label")
    cv = CrossValidator(estimator=est, estimatorParamMaps=ParamGridBuilder().addGrid(est.maxDepth, [6, 7]).build(),
                        evaluator=MO.LogLossEvaluator("label"), foldCol="fold", parallelism=2)
    folds = MO.assemble(train, cats(train)).select("label", "fold", "features").persist()  # read by every fit and score
    m = cv.fit(folds)
    folds.unpersist()
    rows = [(d, float(x)) for d, x in zip((6, 7), m.avgMetrics)]
    return spark.createDataFrame(rows, "max_depth int, loss double").select("max_depth", r6("loss", "cv_logloss"))


@q("x7_pipeline_group_shares", with_(FX1, ROWS, FOLDS.format(k=3), CV_LOSSES) + """
SELECT CAST(fold AS INTEGER) AS fold, round(train_loss, 6) AS train_loss, round(cv_loss, 6) AS cv_loss FROM cv""")
def x7_pipeline_group_shares(spark, sf):
    """A logit feature of the category tells no more than the category: the
    pipeline's losses are those of the shares."""
    train, _ = split_claims(spark, sf, folds=3)
    out = MO.cv_score(train, "tree", 3, "label", stages=[LogitFeature(inputCols=cats(train))], features=cats(train) + ["logit_feat"], max_depth=7)
    return out.select("fold", r6("train_loss"), r6("cv_loss"))


@q("l1_selected_cv", with_(FX1, ROWS, FOLDS.format(k=3), CV_LOSSES) + """
SELECT CAST(fold AS INTEGER) AS fold, round(train_loss, 6) AS train_loss, round(cv_loss, 6) AS cv_loss FROM cv""")
def l1_selected_cv(spark, sf):
    """A selection of all columns inside the folds' pipelines changes nothing."""
    train, _ = split_claims(spark, sf, folds=3)
    out = MO.cv_score(train, "tree", 3, "label", stages=[AnovaSelector(inputCols=cats(train), k="all")], max_depth=6)
    return out.select("fold", r6("train_loss"), r6("cv_loss"))


# ------------------------------------------------------------ K1, K2, K7: stacking

CUTS = range(7)
FX4D = """d AS (SELECT id, response AS y, is_train, p_type AS g FROM fx4)"""
BUMP_FOLDS = "f AS (SELECT id, y, g, " + ", ".join(
    f"ntile(4) OVER (PARTITION BY y <= {k + 1} ORDER BY id) - 1 AS f{k}" for k in CUTS) + " FROM d WHERE is_train)"
BUMPS = ",\n".join(f"""m{k} AS (SELECT x.fold, f.g, avg(CAST(f.y <= {k + 1} AS INTEGER)) AS p FROM f, range(0, 4) x(fold) WHERE f.f{k} <> x.fold GROUP BY 1, 2)""" for k in CUTS)
BUMP_ALL = "a AS (SELECT g, " + ", ".join(f"avg(CAST(y <= {k + 1} AS INTEGER)) AS p{k}" for k in CUTS) + " FROM d WHERE is_train GROUP BY g)"


@q("k1_bumps_group_shares", with_(FX4, FX4D, BUMP_FOLDS, BUMPS, BUMP_ALL) + "SELECT f.id, "
   + ", ".join(f"round(m{k}.p, 6) AS bump_{k}" for k in CUTS) + " FROM f "
   + " ".join(f"JOIN m{k} ON m{k}.g = f.g AND m{k}.fold = f.f{k}" for k in CUTS)
   + " UNION ALL SELECT d.id, " + ", ".join(f"round(a.p{k}, 6)" for k in CUTS) + " FROM d JOIN a ON d.g = a.g WHERE NOT is_train")
def k1_bumps_group_shares(spark, sf):
    """Each cut has folds stratified by its own two sides."""
    d = ordinal_features(spark, sf)
    own = [c for c in d.columns if c.startswith("p_type_")]
    out = ST.oof_bumps(d.where("is_train"), d.where("NOT is_train"), own, "response", 8, "tree", 4, max_depth=6)
    return out.select("id", *[r6(f"bump_{k}") for k in CUTS])


CLASSES = range(1, 5)
FX4C = """d AS (SELECT id, (response + 1) // 2 AS y, is_train, p_type AS g FROM fx4),
f AS (SELECT id, y, g, ntile(3) OVER (PARTITION BY y ORDER BY id) - 1 AS fold FROM d WHERE is_train),
m AS (SELECT x.fold, f.g, """ + ", ".join(f"avg(CAST(f.y = {c} AS INTEGER)) AS p{c}" for c in CLASSES) + """
  FROM f, range(0, 3) x(fold) WHERE f.fold <> x.fold GROUP BY 1, 2),
a AS (SELECT g, """ + ", ".join(f"avg(CAST(y = {c} AS INTEGER)) AS p{c}" for c in CLASSES) + " FROM d WHERE is_train GROUP BY g)"


@q("k2_multiclass_group_shares", with_(FX4, FX4C) + "SELECT f.id, " + ", ".join(f"round(m.p{c}, 6) AS p_{c}, round(m.p{c}, 6) AS s_{c}" for c in CLASSES)
   + " FROM f JOIN m ON m.g = f.g AND m.fold = f.fold UNION ALL SELECT d.id, "
   + ", ".join(f"round(a.p{c}, 6), round(a.p{c}, 6)" for c in CLASSES) + " FROM d JOIN a ON d.g = a.g WHERE NOT is_train")
def k2_multiclass_group_shares(spark, sf):
    """Two classifiers on standardised dummies: both give each type's class shares."""
    d = ordinal_features(spark, sf).withColumn("y", F.floor((F.col("response") + 1) / 2).cast("int"))
    own = [c for c in d.columns if c.startswith("p_type_")]
    train = FO.stratified_kfold(d.where("is_train"), "y", 3)
    models = {"p": ("tree", {"max_depth": 6}), "s": ("extra_trees", ALL_FEATURES | {"trees": 1})}
    out = ST.oof_multiclass(train, d.where("NOT is_train"), own, "y", 4, models, 3, scale=True)
    return out.select("id", *[r6(f"{m}_{c}") for c in CLASSES for m in ("p", "s")])


@q("k7_boost_group_shares", TEST_SQL.replace("g.p, 6", "g.p, 5"))
def k7_boost_group_shares(spark, sf):
    train, test = split_claims(spark, sf)
    out = ST.meta_learner(train, test, cats(train), "label", "boost", seeds=[1, 2], rounds=6, max_depth=6, rate=1.0)
    return out.select("id", F.round("pred", 5).alias("pred"))


# ------------------------------------------------------------ B5, B7, F19, E18, L1, L2, L4

SPAN = 1.0


def _kappa_of(n, o, a1, a2, b1, b2) -> str:
    e = f"(({n} * ({a2} + {b2}) - 2 * {a1} * {b1}) / {n})"
    return f"CASE WHEN {e} = 0 THEN 1.0::DOUBLE ELSE 1 - {o} / {e} END"


def _tuned_sql() -> str:
    sums = lambda a: (f"sum(n) AS n, sum(n * ({a} - y) * ({a} - y)) AS o, sum(n * {a}) AS a1, sum(n * {a} * {a}) AS a2, "  # noqa: E731
                      "sum(n * y) AS b1, sum(n * y * y) AS b2")
    ctes = [f"""o0 AS (SELECT cls, CAST(-(v[i] - c) AS DOUBLE) AS off FROM off, qq UNION ALL SELECT 4, CAST(0.0 AS DOUBLE))""",
            """h0 AS (SELECT CAST(y AS DOUBLE) AS y, pred AS p, CAST(count(*) AS DOUBLE) AS n,
  CASE WHEN CAST(trunc(pred) AS INTEGER) BETWEEN 0 AND 7 THEN CAST(trunc(pred) AS INTEGER) ELSE -1 END AS cls FROM k WHERE is_train GROUP BY ALL)""",
            "rng AS (SELECT min(y) AS lo, max(y) AS hi FROM h0)",
            """h AS (SELECT h0.*, coalesce(o0.off, 0.0::DOUBLE) AS off, least(greatest(round_even(p + coalesce(o0.off, 0.0::DOUBLE), 0), lo), hi) AS a, lo, hi
  FROM h0 LEFT JOIN o0 ON h0.cls = o0.cls, rng)""",
            """br AS (SELECT h.cls, h.y, h.p, h.n, h.off, CAST(m AS DOUBLE) AS m, CAST(m AS DOUBLE) + 0.5 - h.p AS pos FROM h, range(CAST(h.lo AS BIGINT), CAST(h.hi AS BIGINT)) t(m))""",
            f"""fs AS (SELECT h.*, lo + (SELECT count(*) FROM br WHERE br.cls = h.cls AND br.y = h.y AND br.p = h.p AND br.pos <= h.off - {SPAN}) AS r0 FROM h)""",
            f"now0 AS (SELECT cls, {sums('a')} FROM h GROUP BY cls)",
            f"begins AS (SELECT cls, {sums('r0')} FROM fs GROUP BY cls)",
            f"""pts AS (SELECT cls, pos, sum(n * (2 * (m - y) + 1)) AS d_o, sum(n) AS d_a1, sum(n * (2 * m + 1)) AS d_a2 FROM br
  WHERE cls >= 0 AND pos > off - {SPAN} AND pos < off + {SPAN} GROUP BY 1, 2 UNION ALL SELECT cls, off + {SPAN}, 0, 0, 0 FROM o0)""",
            """tab AS (SELECT cls, pos, lag(pos) OVER w AS prev, coalesce(sum(d_o) OVER b, 0) AS o, coalesce(sum(d_a1) OVER b, 0) AS a1,
  coalesce(sum(d_a2) OVER b, 0) AS a2 FROM pts WINDOW w AS (PARTITION BY cls ORDER BY pos), b AS (PARTITION BY cls ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""]
    for j in range(8):
        ctes += [f"rest{j} AS (SELECT coalesce(sum(n), 0) AS n, coalesce(sum(o), 0) AS o, coalesce(sum(a1), 0) AS a1, coalesce(sum(a2), 0) AS a2, coalesce(sum(b1), 0) AS b1, coalesce(sum(b2), 0) AS b2 FROM now{j} WHERE cls <> {j})",
                 f"""cand{j} AS (SELECT {_kappa_of('(s.n + r.n)', '(t.o + s.o + r.o)', '(t.a1 + s.a1 + r.a1)', '(t.a2 + s.a2 + r.a2)', '(s.b1 + r.b1)', '(s.b2 + r.b2)')} AS k,
  (coalesce(t.prev, o0.off - {SPAN}) + t.pos) / 2 AS middle, t.o + s.o AS o, t.a1 + s.a1 AS a1, t.a2 + s.a2 AS a2, o0.off
  FROM tab t JOIN begins s ON s.cls = t.cls JOIN o0 ON o0.cls = t.cls, rest{j} r WHERE t.cls = {j})""",
                 f"best{j} AS (SELECT * FROM cand{j} ORDER BY k DESC, abs(middle - off), middle LIMIT 1)",
                 f"""was{j} AS (SELECT {_kappa_of('(s.n + r.n)', '(s.o + r.o)', '(s.a1 + r.a1)', '(s.a2 + r.a2)', '(s.b1 + r.b1)', '(s.b2 + r.b2)')} AS k FROM now{j} s, rest{j} r WHERE s.cls = {j})""",
                 f"new{j} AS (SELECT b.* FROM best{j} b, was{j} w WHERE b.k > w.k)",
                 f"""now{j + 1} AS (SELECT n.cls, n.n, CASE WHEN n.cls = {j} AND x.k IS NOT NULL THEN x.o ELSE n.o END AS o,
  CASE WHEN n.cls = {j} AND x.k IS NOT NULL THEN x.a1 ELSE n.a1 END AS a1, CASE WHEN n.cls = {j} AND x.k IS NOT NULL THEN x.a2 ELSE n.a2 END AS a2, n.b1, n.b2
  FROM now{j} n LEFT JOIN new{j} x ON true)"""]
    picks = " UNION ALL ".join(f"SELECT {j} AS cls, (SELECT middle FROM new{j}) AS middle" for j in range(8))
    return OFFS_SQL + ",\n" + ",\n".join(ctes) + f"""
SELECT CAST(o0.cls AS INTEGER) AS cls, round(coalesce(p.middle, o0.off), 6) AS offset FROM o0 JOIN ({picks}) p ON p.cls = o0.cls"""


SQL["b5_tune_offsets"] = _tuned_sql()


@q("b7_platt_group_shares", with_(FX1, ROWS, HOLDOUT, """s AS (SELECT h.id, h.target, CAST(g.p > 0.5 OR h.id % 3 = 0 AS INTEGER) AS score FROM h JOIN g ON h.pr = g.pr WHERE NOT is_fit),
c AS (SELECT score, avg(target) AS p FROM s WHERE id % 2 = 0 GROUP BY score)""") + """
SELECT s.id, round(c.p, 5) AS calibrated FROM s JOIN c ON s.score = c.score""")
def b7_platt_group_shares(spark, sf):
    """A score of two values: calibration gives each the label's share (five digits)."""
    h = _holdout(spark, sf)
    h = MO.assemble(h, cats(h))
    p = MO.predict(MO.estimator("tree", "label", max_depth=6).fit(h.where("is_fit")), h.where("NOT is_fit"))
    s = p.select("id", "label", ((F.col("pred") > 0.5) | (F.col("id") % 3 == 0)).cast("double").alias("score"))
    out = MO.platt_calibrate(s.where("id % 2 = 0"), s, "label", "score")
    return out.select("id", F.round("calibrated", 5).alias("calibrated"))


@q("f19_polynomial_terms", with_(FX1, """p AS (SELECT id, coalesce(o_totalprice, -999) / 99991.0 AS a, coalesce(c_acctbal, -999) / 997.0 AS b FROM fx1)""") + """
SELECT id, round(a, 6) AS a, round(a * a, 6) AS aa, round(b, 6) AS b, round(a * b, 6) AS ab, round(b * b, 6) AS bb FROM p""")
def f19_polynomial_terms(spark, sf):
    d = claims_features(spark, sf)
    p = MO.polynomial(d.select("id", (F.col("o_totalprice") / 99991.0).alias("a"), (F.col("c_acctbal") / 997.0).alias("b")), ["a", "b"], 2)
    v = p.select("id", vector_to_array("poly").alias("v"))
    return v.select("id", *[r6(F.col("v")[i], n) for i, n in enumerate(("a", "aa", "b", "ab", "bb"))])


@q("e18_logit_group_shares", with_(FX1, ROWS, ALL_TRAIN) + "SELECT d.id, round(ln(g.p), 5) AS logit_feat FROM d JOIN g ON d.pr = g.pr")
def e18_logit_group_shares(spark, sf):
    """Without a penalty the logit feature is the log of each category's share (five digits)."""
    d = claims_features(spark, sf)
    m = LogitFeature(inputCols=cats(d), C=1e9).fit(d.where("is_train"))
    return m.transform(d).select("id", F.round("logit_feat", 5).alias("logit_feat"))


@q("e19_logit_group_shares", with_(FX1, ROWS, FOLDS.format(k=3)) + """
SELECT f.id, round(ln(m.p), 5) AS logit_feat FROM f JOIN m ON f.fold = m.fold AND f.pr = m.pr""")
def e19_logit_group_shares(spark, sf):
    train, _ = split_claims(spark, sf, folds=3)
    out = ST.logit_feature_in_folds(train, cats(train), "label", 3, C=1e9)
    return out.select("id", F.round("logit_feat", 5).alias("logit_feat"))


DUMMY_SQL = """u AS (SELECT target, 'o_orderpriority_' || o_orderpriority AS name FROM fx1 WHERE is_train AND o_orderpriority IS NOT NULL
  UNION ALL SELECT target, 'c_mktsegment_' || c_mktsegment FROM fx1 WHERE is_train AND c_mktsegment IS NOT NULL),
t AS (SELECT count(*) AS n, sum(target) AS y FROM fx1 WHERE is_train),
c AS (SELECT name, CAST(count(*) AS DOUBLE) AS v, CAST(sum(target) AS DOUBLE) AS a FROM u GROUP BY name),
x AS (SELECT name, n * pow(a * (n - y - (v - a)) - (v - a) * (y - a), 2) / (v * (n - v) * y * (n - y)) AS chi2 FROM c, t)"""
SQL["l2_chi2_select"] = with_(FX1, DUMMY_SQL) + "SELECT name FROM x ORDER BY chi2 DESC, name LIMIT 4"


@q("l4_two_columns", with_(FX1, """s AS (SELECT id, is_train, CAST(target AS DOUBLE) AS y, coalesce(o_totalprice, -999) / 5e5 AS a, CAST(c_nationkey AS DOUBLE) / 25 AS b FROM fx1),
m AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * y) AS ay, sum(b * y) AS by_ FROM s WHERE is_train),
w AS (SELECT (bb * ay - ab * by_) / (aa * bb - ab * ab) AS wa, (aa * by_ - ab * ay) / (aa * bb - ab * ab) AS wb FROM m)""") + """
SELECT s.id, round(wa * a + wb * b, 6) AS nation_price FROM s, w""")
def l4_two_columns(spark, sf):
    """One group of two columns: their no-intercept least squares."""
    d = claims_features(spark, sf).select("id", "label", "is_train", (F.col("o_totalprice") / 5e5).alias("price"), (F.col("c_nationkey") / 25).alias("nation"))
    m = LinearGroupsFeature(inputCols=["price", "nation"], groups=1, maxElements=2, seed=3).fit(d.where("is_train"))
    return m.transform(d).select("id", r6("nation_price"))


NUMERIC = ["o_totalprice", "c_acctbal", "c_nationkey"]
SELECT_SQL = with_(FX1, "l AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS name, target, CAST({c} AS DOUBLE) AS x FROM fx1 WHERE is_train AND {c} IS NOT NULL" for c in NUMERIC) + """
  UNION ALL SELECT 'acct_by_target', target, c_acctbal + 500.0 * target FROM fx1 WHERE is_train AND c_acctbal IS NOT NULL),
c AS (SELECT name, target, CAST(count(*) AS DOUBLE) AS n, avg(x) AS m, var_pop(x) AS v FROM l GROUP BY 1, 2),
g AS (SELECT name, sum(n) AS n, sum(n * m) / sum(n) AS m, sum(n * v) AS within FROM c GROUP BY name),
f AS (SELECT g.name, g.n, sum(c.n * pow(c.m - g.m, 2)) / (g.within / (g.n - 2)) AS f_score FROM c JOIN g ON c.name = g.name GROUP BY g.name, g.n, g.within),
-- two-sided Student t by Simpson's rule: with two classes F is the square of t
k AS (SELECT name, n - 2 AS nu, f_score, sqrt(f_score) / 2000 AS h, exp(lgamma((n - 1) / 2) - lgamma((n - 2) / 2)) / sqrt((n - 2) * pi()) AS c FROM f),
p AS (SELECT name, any_value(f_score) AS f_score, 1 - 2 * any_value(h) / 3 * sum(CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
  * c * pow(1 + pow(i * h, 2) / nu, -(nu + 1) / 2)) AS p_value FROM k, range(0, 2001) t(i) GROUP BY name),
r AS (SELECT *, row_number() OVER (ORDER BY f_score DESC, name) AS rank FROM p)""")


def _selection(spark, sf, **how):
    d = fx.claims(spark, sf).where("is_train").withColumn("acct_by_target", F.col("c_acctbal") + 500.0 * F.col("target"))
    out = AS.select_features(d, [*NUMERIC, "acct_by_target"], "target", **how)
    return out.select("name", r6("f_score"), F.round("p_value", 5).alias("p_value"), "rank", "selected")


@q("l1_select_k_best", SELECT_SQL + "SELECT name, round(f_score, 6) AS f_score, round(p_value, 5) AS p_value, CAST(rank AS INTEGER) AS rank, rank <= 2 AS selected FROM r")
def l1_select_k_best(spark, sf):
    return _selection(spark, sf, k=2)


@q("l1_select_percentile", SELECT_SQL + "SELECT name, round(f_score, 6) AS f_score, round(p_value, 5) AS p_value, CAST(rank AS INTEGER) AS rank, rank <= 3 AS selected FROM r")
def l1_select_percentile(spark, sf):
    return _selection(spark, sf, percentile=75)


# ------------------------------------------------------------ E9 text branch, E15-E17 by fold

@q("e9_route_text", with_(FX2, """c AS (SELECT cust, count(*) AS n FROM fx2 WHERE cust IS NOT NULL GROUP BY cust),
k AS (SELECT cust FROM c ORDER BY n DESC, cust ASC LIMIT 20),
s AS (SELECT f.id, f.target, f.is_train, k.cust AS v FROM fx2 f LEFT JOIN k ON f.cust = k.cust),
w AS (SELECT v, sum(target) AS s, count(*) AS c FROM s WHERE is_train AND v IS NOT NULL GROUP BY v)""") + """
SELECT s.id, coalesce(s.v, 'nan') AS value, CAST(1 AS INTEGER) AS ones, round(coalesce(CASE WHEN w.s > w.c - w.s THEN 0.5 + 0.5 * w.s / w.c
  ELSE 0.5 + 0.5 * (w.s - w.c) / w.c END, 0.5), 6) AS custweight FROM s LEFT JOIN w ON s.v = w.v""")
def e9_route_text(spark, sf):
    """The router's text branch: dummies of the 20 most frequent values (read
    back as the one that is set), the rest as missing, and the target weight."""
    out = E.route_encode(fx.high_card(spark, sf), ["cust"])
    flags = [c for c in out.columns if c.startswith("cust_")]
    value = F.coalesce(*[F.when(F.col(f"`{c}`") == 1, F.lit(c.removeprefix("cust_"))) for c in flags])
    return out.select("id", value.alias("value"), sum(F.col(f"`{c}`") for c in flags).cast("int").alias("ones"), r6("custweight"))


def _folded(d):
    """Train rows in folds by their key; test rows without one."""
    return d.withColumn("fold", F.when(F.col("is_train"), (F.col("id") % 3).cast("int")))


FOLD = "CASE WHEN is_train THEN CAST(id % 3 AS INTEGER) END AS fold"


@q("e15_target_stats_by_fold", with_(FX2, f"""x AS (SELECT *, {FOLD} FROM fx2),
sides AS (SELECT cust, max(CAST(is_train AS INT)) AS tr, min(CAST(is_train AS INT)) AS te FROM x GROUP BY cust),
prep AS (SELECT x.id, x.target, x.is_train, x.fold, CASE WHEN x.cust IS NULL THEN 'Missing' WHEN s.tr = 1 AND s.te = 0 THEN x.cust ELSE 'Orphans' END AS cust
  FROM x LEFT JOIN sides s ON x.cust = s.cust),
st AS (SELECT k.fold, p.cust, avg(target) AS a, stddev_samp(target) AS s FROM prep p, (VALUES (0), (1), (2), (-1)) k(fold)
  WHERE is_train AND p.fold <> k.fold GROUP BY 1, 2 HAVING count(*) >= 6)""") + """
SELECT p.id, round(st.a, 6) AS cust_avg, round(st.s, 6) AS cust_std FROM prep p LEFT JOIN st ON p.cust = st.cust AND coalesce(p.fold, -1) = st.fold""")
def e15_target_stats_by_fold(spark, sf):
    out = E.target_stats_by_fold(_folded(fx.high_card(spark, sf)), "cust", "fold", min_support=6)
    return out.select("id", r6("cust_avg"), r6("cust_std"))


@q("e16_target_weight_by_fold", with_(FX2, f"""x AS (SELECT *, {FOLD} FROM fx2),
g AS (SELECT k.fold, cust, sum(target) AS s, count(*) AS c FROM x, (VALUES (0), (1), (2), (-1)) k(fold)
  WHERE is_train AND cust IS NOT NULL AND x.fold <> k.fold GROUP BY 1, 2)""") + """
SELECT x.id, round(coalesce(CASE WHEN g.s > g.c - g.s THEN 0.5 + 0.5 * g.s / g.c ELSE 0.5 + 0.5 * (g.s - g.c) / g.c END, 0.5), 6) AS custweight
FROM x LEFT JOIN g ON x.cust = g.cust AND coalesce(x.fold, -1) = g.fold""")
def e16_target_weight_by_fold(spark, sf):
    return E.target_weight_by_fold(_folded(fx.high_card(spark, sf)), "cust", "fold").select("id", r6("custweight"))


@q("e17_bernoulli_nb_by_fold", with_(FX1, f"""x AS (SELECT id, target, is_train, coalesce(o_orderpriority, 'nan') AS v, {FOLD} FROM fx1),
kf AS (SELECT * FROM (VALUES (0), (1), (2), (-1)) k(fold)),
tr AS (SELECT kf.fold, x.v, x.target FROM x, kf WHERE is_train AND x.fold <> kf.fold),
ny AS (SELECT fold, count(*) AS n, sum(target) AS n1 FROM tr GROUP BY fold),
th AS (SELECT tr.fold, v, (sum(1 - target) + 1.0) / (any_value(n) - any_value(n1) + 2.0) AS t0, (sum(target) + 1.0) / (any_value(n1) + 2.0) AS t1
  FROM tr JOIN ny ON tr.fold = ny.fold GROUP BY 1, 2),
k AS (SELECT th.fold, ln(any_value((n - n1) * 1.0 / n)) + sum(ln(1 - t0)) AS k0, ln(any_value(n1 * 1.0 / n)) + sum(ln(1 - t1)) AS k1
  FROM th JOIN ny ON th.fold = ny.fold GROUP BY 1)""") + """
SELECT x.id, round(1.0 / (1.0 + exp(coalesce(k.k0 + ln(th.t0) - ln(1 - th.t0), k.k0) - coalesce(k.k1 + ln(th.t1) - ln(1 - th.t1), k.k1))), 6) AS o_orderpriority
FROM x JOIN k ON k.fold = coalesce(x.fold, -1) LEFT JOIN th ON th.fold = k.fold AND th.v = x.v""")
def e17_bernoulli_nb_by_fold(spark, sf):
    d = _folded(fx.claims(spark, sf).select("id", "target", "is_train", "o_orderpriority"))
    return E.bernoulli_nb_by_fold(d, "o_orderpriority", "fold").select("id", r6("o_orderpriority"))


# ------------------------------------------------------------ more pairs than one aggregate holds

WIDE = 24


def _wide_sql(value: str, field: str) -> str:
    cols = [f"CASE WHEN o_orderkey % {i + 3} <> 0 THEN (CAST(o_orderkey AS BIGINT) * {2 * i + 3}) % {101 + 2 * i} END AS x{i}" for i in range(WIDE)]
    pairs = [(a, b) for a in range(WIDE) for b in range(a + 1, WIDE)]
    return f"WITH w AS (SELECT {', '.join(cols)} FROM orders) " + " UNION ALL ".join(
        f"SELECT 'x{a}' AS col_a, 'x{b}' AS col_b, {value.format(a=f'x{a}', b=f'x{b}')} AS {field} FROM w" for a, b in pairs)


def _wide(spark, sf):
    from stackyard.sources.tables import load
    k = F.col("o_orderkey").cast("long")
    return load(spark, sf, "orders", ["o_orderkey"]).select(*[F.when(k % (i + 3) != 0, (k * (2 * i + 3)) % (101 + 2 * i)).alias(f"x{i}") for i in range(WIDE)])


@q("a15_pearson_wide", _wide_sql("round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)", "r"))
def a15_pearson_wide(spark, sf):
    """276 pairs of columns with different nulls, from one Gramian."""
    d = _wide(spark, sf)
    return AS.pearson(d, d.columns).select("col_a", "col_b", r6("r"))


@q("a28_null_pairs_wide", _wide_sql("CAST(count_if(({a} IS NULL) <> ({b} IS NULL)) AS BIGINT)", "n_diff"))
def a28_null_pairs_wide(spark, sf):
    d = _wide(spark, sf)
    return AS.null_pattern_pairs(d, d.columns)
