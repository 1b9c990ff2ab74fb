"""Registered model, tuning and scoring queries (rows-only checks: no SQL form).

Each query fits on the whole fixture table and returns either per-row
scores or one row of metrics per model.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tablewright.functions.hashing import sql_unit_hash
from tablewright.jobs import fixtures as fx
from tablewright.jobs import loan
from tablewright.jobs.registry import VOCAB_SQL, _docs_tokens, _r, register
from tablewright.operators import evaluate, features, splits, text, tuning
from tablewright.operators.models import anomaly, classify, columns, regress
from tablewright.plans.parallel import spread
from tablewright.session import ensure_checkpoint_dir


def _scalars(*one_row_frames):
    """Values of one-row metric aggregates (each is a finished aggregation, a single row)."""
    values = [f.first()[0] for f in one_row_frames]
    return [None if v is None else float(v) for v in values]


def _n_classes(df, label: str = "label") -> int:
    """Classes of an indexed label, from the indexer's metadata."""
    return len(df.schema[label].metadata["ml_attr"]["vals"])


@register("gbt")
def q_gbt(spark, sf):
    return loan.run(spark, sf, n_estimators=10, max_depth=3).drop("seconds")


TREE_MODELS = ["decision_tree", "gbt", "gbt_regressor", "random_forest"]


@register("score_columns", "WITH " + fx.LOAN_SQL + """ SELECT unnest([""" + ", ".join(f"'{m}'" for m in TREE_MODELS) + f"""]) AS model,
  count(*) AS n_rows, 0::BIGINT AS mismatches FROM loan WHERE {sql_unit_hash(1234, fx.LOAN_KEY)} >= 0.8
  AND """ + " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in fx.LOAN_NUMERIC) + " AND " + " AND ".join(
    f"{c} IS NOT NULL" for c in fx.LOAN_CATEGORICAL))
def q_score_columns(spark, sf):
    """Fitted trees and ensembles as column expressions give every test row what the model gives."""
    tr, te = _loan_vectors(spark, sf)
    tr = tr.select("features", "label").persist()
    models = {
        "decision_tree": classify.decision_tree(max_depth=5),
        "gbt": classify.gbt(n_estimators=4, max_depth=3),
        "gbt_regressor": GBTRegressor(labelCol="label", maxIter=3, maxDepth=3, seed=1),
        "random_forest": classify.random_forest(n_estimators=6, max_depth=4),
    }
    out = None
    for name, est in models.items():
        model = est.fit(tr)
        held = model.transform(te).withColumnRenamed("prediction", "p")
        held = columns.score_columns(model, held)
        own = vector_to_array("probability")[1] if name != "gbt_regressor" else F.col("p")
        off = (F.abs(own - F.col("score")) > 1e-9) | (F.abs(F.col("p") - F.col("prediction")) > 1e-9)
        one = held.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(off).alias("mismatches")).select(F.lit(name).alias("model"), "*")
        out = one if out is None else out.unionAll(one)
    return out


@register("score")
def q_score(spark, sf):
    return loan.scores(spark, sf)


@register("grid_search")
def q_grid_search(spark, sf):
    return loan.run(spark, sf, grid={"maxDepth": [2, 3], "maxIter": [2, 3]}).drop("seconds")


def _loan_vectors(spark, sf):
    """Encoded train / test rows of the loan fixture.

    The prepared table is written once with its split (it feeds the indexer
    fit and both splits), and so are the encoded training rows: every later
    pass reads keys, features and label, without the split's hash and the encoders.
    """
    ensure_checkpoint_dir(spark)
    df = splits.assign_split(spread(loan.prepared(spark, sf)), [0.8, 0.2], 1234, fx.LOAN_KEY).checkpoint(eager=True)
    train, test = (df.filter(F.col("split") == i).drop("split") for i in range(2))
    feat = features.feature_pipeline(loan.spec()).fit(train)
    encoded = feat.transform(train).select(*fx.LOAN_KEY, "features", "label").checkpoint(eager=True)
    return encoded, feat.transform(test)


def _search_rows(tagged):
    """What the fits of a search read, written once: the fold is a hash of the keys, which no fit needs."""
    return tagged.select("features", "label", "fold").checkpoint(eager=True)


@register("classifiers")
def q_classifiers(spark, sf):
    """M1, M3, M4, M5, M12 on the loan fixture: (model, auc, auc_hard, accuracy)."""
    tr, te = _loan_vectors(spark, sf)
    # gradient-based fits (logistic, MLP) get standardised inputs, fitted on the training rows
    scaler = features.standardize("features", "scaled").fit(tr)
    tr = scaler.transform(tr).select(F.col("scaled").alias("features"), "label").persist()
    te = scaler.transform(te).drop("features").withColumnRenamed("scaled", "features")
    width = classify.input_width(tr)
    models = {
        "logistic": classify.logistic(max_iter=10, reg_param=0.01),
        "decision_tree": classify.decision_tree(max_depth=4),
        "random_forest": classify.random_forest(n_estimators=10, max_depth=4),
        "gbt": classify.gbt(n_estimators=5, max_depth=3),
        "mlp": classify.mlp_classifier([width, 8, 2], max_iter=50),
    }
    rows = []
    for name, est in models.items():
        # scored once, then read by the three metrics
        s = evaluate.score(est.fit(tr), te).select("score", "label", "prediction").persist()
        rows.append((name, *_scalars(evaluate.auc(s, "score", "label"), evaluate.auc_hard(s, "prediction", "label"),
                                     evaluate.accuracy(s, "prediction", "label"))))
        s.unpersist()
    tr.unpersist()
    out = spark.createDataFrame(rows, "model string, auc double, auc_hard double, accuracy double")
    return out.select("model", _r("auc"), _r("auc_hard"), _r("accuracy"))


def _text_split(spark, sf):
    # cleaning (with stemming) feeds several jobs below: write the tokens once, drop the raw text
    ensure_checkpoint_dir(spark)
    docs = text.clean_text(fx.text_like(spark, sf), "text", "tokens", keep_text=False).checkpoint(eager=True)
    docs = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(docs).transform(docs)
    tagged = splits.assign_split(docs, [0.8, 0.2], 42, ["doc_id"])
    train, val = tagged.filter("split = 0"), tagged.filter("split = 1")
    model, _ = text.encode_text_model(train, "doc_id", "tokens", max_features=50_000)
    return model.transform(train).persist(), model.transform(val)


@register("text_classifiers")
def q_text_classifiers(spark, sf):
    """M2, M8, M9, M10, M11 on TF-IDF of the cleaned documents: (model, accuracy)."""
    tr, va = _text_split(spark, sf)
    n, k = tr.count(), _n_classes(tr)
    models = {
        "naive_bayes": classify.naive_bayes(alpha=0.1),
        "logistic_multinomial": classify.logistic(family="multinomial", max_iter=20, C=1.0, n_rows=n),
        "linear_svm": classify.linear_svm(C=1.0, n_rows=n, max_iter=20),
        "sgd_elasticnet": classify.sgd_linear(alpha=1e-4, penalty="elasticnet", max_iter=15, n_classes=k),
        "perceptron": classify.perceptron(max_iter=15, n_classes=k),
        "random_forest": classify.random_forest(n_estimators=200, max_depth=3),
    }
    out = None
    for name, est in models.items():
        acc = evaluate.accuracy(est.fit(tr).transform(va), "prediction", "label").withColumn("model", F.lit(name))
        out = acc if out is None else out.unionByName(acc)
    return out.select("model", _r("accuracy"))


@register("sequence_classifier")
def q_sequence(spark, sf):
    """Averaged word vectors of the token sequence -> softmax MLP: (accuracy)."""
    ensure_checkpoint_dir(spark)
    docs = text.clean_text(fx.text_like(spark, sf), "text", "tokens", keep_text=False).checkpoint(eager=True)
    docs = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(docs).transform(docs)
    tagged = splits.assign_split(docs, [0.8, 0.2], 42, ["doc_id"])
    train, val = tagged.filter("split = 0"), tagged.filter("split = 1")
    m = regress.sequence_classifier(vector_size=32, hidden=16, n_classes=_n_classes(docs),
                                    partitions=regress.word2vec_partitions(train)).fit(train)
    return evaluate.accuracy(m.transform(val), "prediction", "label").select(_r("accuracy"))


def _fraud(spark, sf):
    return fx.fraud_like(spark, sf)


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    """M17 + M18 on the fraud fixture: per-row score and label."""
    df = _fraud(spark, sf)
    feats = [f"v{i + 1}" for i in range(fx.FRAUD_DIMS)]
    model = anomaly.isolation_forest(df, feats, ["vec_id"], n_estimators=50, max_samples=256, seed=50)
    scored = model.transform(df)
    rate = df.agg(F.avg("Class")).first()[0]
    labelled = anomaly.anomaly_label(scored, "anomaly_score", float(rate))
    return labelled.select("vec_id", "Class", _r("anomaly_score"), "anomaly_label")


@register("isolation_forest_auc")
def q_isolation_forest_auc(spark, sf):
    df = _fraud(spark, sf)
    feats = [f"v{i + 1}" for i in range(fx.FRAUD_DIMS)]
    model = anomaly.isolation_forest(df, feats, ["vec_id"], n_estimators=50, max_samples=256, seed=50)
    return evaluate.auc(model.transform(df), "anomaly_score", "Class").select(_r("auc"))


NORM_SQL = " + ".join(f"v{i + 1} * v{i + 1}" for i in range(fx.FRAUD_DIMS))


@register("anomaly_label", "WITH " + fx.fraud_sql() + f""", s AS (SELECT vec_id, sqrt({NORM_SQL}) AS score FROM fraud)
  SELECT vec_id, CASE WHEN score > (SELECT quantile_cont(score, 0.9) FROM s) THEN -1 ELSE 1 END AS anomaly_label FROM s""")
def q_anomaly_label(spark, sf):
    df = _fraud(spark, sf)
    norm = F.sqrt(sum((F.col(f"v{i + 1}") * F.col(f"v{i + 1}") for i in range(fx.FRAUD_DIMS)), F.lit(0.0)))
    s = df.select("vec_id", norm.alias("score"))
    return anomaly.anomaly_label(s, "score", 0.1).select("vec_id", "anomaly_label")


HOUSE_FEATS = ["n_lines", "qty_per_line", "disc_per_line", "tax_per_line"]


def _housing_scaled(spark, sf):
    df = fx.housing_like(spark, sf)
    tagged = splits.assign_split(df, [0.8, 0.2], 5, ["o_orderkey"])
    train, test = tagged.filter("split = 0"), tagged.filter("split = 1")
    stats = features.fit_standardize_columns(train, HOUSE_FEATS, ddof=0)
    asm = VectorAssembler(inputCols=HOUSE_FEATS, outputCol="features")
    prep = lambda d: asm.transform(features.apply_standardize_columns(d, stats))
    return spread(prep(train)), prep(test)


@register("mlp_regressor")
def q_mlp_regressor(spark, sf):
    """(split, mae, r2) on train and test."""
    tr, te = _housing_scaled(spark, sf)
    m = regress.mlp_regressor(hidden=(15, 15), alpha=0.01, max_iter=30, label="value_k").fit(tr)
    rows = []
    for name, d in (("train", tr), ("test", te)):
        p = m.transform(d)
        rows.append((name, *_scalars(evaluate.mae(p, "prediction", "value_k"), evaluate.r2(p, "prediction", "value_k"))))
    return spark.createDataFrame(rows, "split string, mae double, r2 double").select("split", _r("mae"), _r("r2"))


@register("svr_rbf")
def q_svr(spark, sf):
    """M14 + M15: (split, mae, n_support, n_bound)."""
    tr, te = _housing_scaled(spark, sf)
    est = regress.svr_rbf(HOUSE_FEATS, C=100.0, gamma=0.1, epsilon=6.0, n_components=64, max_iter=30, label="value_k")
    m = est.fit(tr)
    rows = []
    for name, d in (("train", tr), ("test", te)):
        p = m.transform(d)
        st = regress.support_stats(p, "prediction", "value_k", 6.0).first()
        rows.append((name, *_scalars(evaluate.mae(p, "prediction", "value_k")), int(st["n_support"]), int(st["n_bound"])))
    return spark.createDataFrame(rows, "split string, mae double, n_support long, n_bound long").select("split", _r("mae"), "n_support", "n_bound")


@register("support_stats", "WITH " + fx.HOUSING_SQL + """ SELECT count_if(abs(price_k - n_lines * 40.0) >= 6.0) AS n_support,
  count_if(abs(price_k - n_lines * 40.0) > 6.0) AS n_bound FROM housing""")
def q_support_stats(spark, sf):
    df = fx.housing_like(spark, sf).withColumn("pred", F.col("n_lines") * 40.0)
    return regress.support_stats(df, "pred", "price_k", 6.0)


@register("cross_val_score")
def q_cross_val_score(spark, sf):
    tr, _ = _loan_vectors(spark, sf)
    tr = splits.folds(tr, 3, 7, fx.LOAN_KEY)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    return tuning.cross_val_score(classify.decision_tree(max_depth=4), ev, tr, "fold", 3).select("fold", _r("metric"))


@register("out_of_fold_predict")
def q_oof(spark, sf):
    tr, _ = _loan_vectors(spark, sf)
    tr = splits.folds(tr, 3, 7, fx.LOAN_KEY)
    p = tuning.out_of_fold_predict(classify.decision_tree(max_depth=4), tr, "fold", 3)
    return p.select(*fx.LOAN_KEY, "fold", "label", "prediction")


@register("search_results")
def q_search_results(spark, sf):
    tr, _ = _loan_vectors(spark, sf)
    tr = splits.stratified_folds(tr.select(*fx.LOAN_KEY, "features", "label"), "label", 3, 50, fx.LOAN_KEY)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    est = classify.decision_tree()
    model, secs = tuning.timed(tuning.grid_search(est, {"maxDepth": [2, 4], "impurity": ["gini", "entropy"]}, ev, fold_col="fold").fit, tr)
    return tuning.search_results(spark, model, secs).drop("seconds").select("param_set", "params", _r("mean_metric"), _r("std_metric"))


SEARCH_SETS = [(d, i) for d in (2, 4) for i in ("entropy", "gini")]


@register("resumable_search", "SELECT * FROM (VALUES " + ", ".join(
    f"({n}, 'impurity={i}, maxDepth={d}', 3::BIGINT, 6::BIGINT, true)" for n, (d, i) in enumerate(SEARCH_SETS)) + """)
  v(param_set, params, folds, reused, same) WHERE (SELECT count(*) FROM lineitem) > 0""")
def q_resumable_search(spark, sf):
    """A search that ended after half of its sets goes on; the table equals an uninterrupted search's."""
    import uuid

    tr, _ = _loan_vectors(spark, sf)
    tr = splits.folds(tr.select(*fx.LOAN_KEY, "features", "label"), 3, 7, fx.LOAN_KEY).checkpoint(eager=True)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    est, path = classify.decision_tree(), f"{ensure_checkpoint_dir(spark)}/tw-resume-{uuid.uuid4().hex}"
    half, whole = {"maxDepth": [2], "impurity": ["entropy", "gini"]}, {"maxDepth": [2, 4], "impurity": ["entropy", "gini"]}
    tuning.resumable_search(est, half, ev, tr, "fold", 3, f"{path}/a").collect()
    reused = tuning.search_table(spark, f"{path}/a").count()
    resumed = tuning.resumable_search(est, whole, ev, tr, "fold", 3, f"{path}/a")
    plain = tuning.resumable_search(est, whole, ev, tr, "fold", 3, f"{path}/b")
    both = resumed.join(plain.select("params", F.col("mean_metric").alias("m"), F.col("mean_train_metric").alias("t")), "params")
    near = (F.abs(F.col("m") - F.col("mean_metric")) < 1e-9) & (F.abs(F.col("t") - F.col("mean_train_metric")) < 1e-9)
    return both.select("param_set", "params", "folds", F.lit(reused).cast("long").alias("reused"), near.alias("same"))


@register("random_search")
def q_random_search(spark, sf):
    tr, _ = _loan_vectors(spark, sf)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    est = classify.random_forest(n_estimators=5)
    cv = tuning.random_search(est, {"maxDepth": [2, 3, 4], "numTrees": [3, 5]}, 3, ev, seed=50, fold_col="fold")
    model = cv.fit(_search_rows(splits.folds(tr, 3, 50, fx.LOAN_KEY)))
    bp = tuning.best_params(model)
    return spark.createDataFrame([(str(bp["maxDepth"]), str(bp["numTrees"]), float(bp["_metric"]))], "max_depth string, num_trees string, metric double").select("max_depth", "num_trees", _r("metric"))


@register("adaboost")
def q_adaboost(spark, sf):
    """M6 on the loan fixture: (auc, accuracy)."""
    tr, te = _loan_vectors(spark, sf)
    m = classify.adaboost(n_estimators=50, learning_rate=0.5).fit(tr.select("features", "label"))
    s = m.transform(te).select("score", "label", "prediction").persist()  # scored once, read by both metrics
    row = _scalars(evaluate.auc(s, "score", "label"), evaluate.accuracy(s, "prediction", "label"))
    s.unpersist()
    return spark.createDataFrame([tuple(row)], "auc double, accuracy double").select(_r("auc"), _r("accuracy"))


@register("repeated_holdout_search")
def q_repeated_holdout(spark, sf):
    tr, _ = _loan_vectors(spark, sf)
    tr = splits.shuffle_split_flags(tr, 3, 0.25, 0, fx.LOAN_KEY)
    ev = MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")
    res = tuning.repeated_holdout_search(classify.decision_tree(), {"maxDepth": [2, 4]}, ev, tr, ["is_test_0", "is_test_1", "is_test_2"])
    return res.select("param_set", "params", _r("mean_metric"), _r("std_metric"), _r("mean_train_metric"))


@register("regularised_gbt")
def q_regularised_gbt(spark, sf):
    """M7: boosted trees with minimum gain, row subsampling and per-node feature sampling."""
    tr, te = _loan_vectors(spark, sf)
    est = classify.regularised_gbt(n_estimators=10, max_depth=3, gamma=0.001, subsample=0.8, colsample_bytree=0.8, seed=3)
    s = evaluate.score(est.fit(tr.select("features", "label")), te)
    row = _scalars(evaluate.auc(s, "score", "label"), evaluate.accuracy(s, "prediction", "label"))
    return spark.createDataFrame([tuple(row)], "auc double, accuracy double").select(_r("auc"), _r("accuracy"))


@register("refit_best")
def q_refit_best(spark, sf):
    """G6 + G7: search, report, refit the winner on all training rows and score the test rows."""
    tr, te = _loan_vectors(spark, sf)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    est = classify.decision_tree()
    search = tuning.grid_search(est, {"maxDepth": [2, 4]}, ev, folds=3, fold_col="fold")
    model, report = tuning.fit_and_report(search, splits.folds(tr, 3, 7, fx.LOAN_KEY))
    best = tuning.refit_best(est, model, tr)
    s = evaluate.score(best, te)
    return s.select(*fx.LOAN_KEY, "label", "prediction", F.lit(int(report["maxDepth"])).alias("max_depth"))


@register("save_search")
def q_save_search(spark, sf):
    """Fit a search, persist model and results in the checkpoint folder, read both back."""
    import uuid

    from tablewright.session import ensure_checkpoint_dir
    from tablewright.sources import io

    tr, te = _loan_vectors(spark, sf)
    ev = BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")
    # a Python estimator: its models are saved and loaded with the search
    ev = ev.setRawPredictionCol("score")
    search = tuning.grid_search(classify.adaboost(n_estimators=3), {"learning_rate": [0.5, 1.0]}, ev, folds=2, fold_col="fold")
    model = search.fit(_search_rows(splits.folds(tr, 2, 1, fx.LOAN_KEY)))
    path = f"{ensure_checkpoint_dir(spark)}/tw-search-{uuid.uuid4().hex}"
    io.save_search(model, path, tuning.search_results(spark, model))
    back, results = io.load_search(spark, path)
    # the reloaded model scores the test rows exactly like the fitted one
    same = back.transform(te).select(*fx.LOAN_KEY, F.col("prediction").alias("p_loaded")).join(
        model.transform(te).select(*fx.LOAN_KEY, "prediction"), fx.LOAN_KEY
    )
    mismatches = same.filter(F.col("p_loaded") != F.col("prediction")).count()
    return results.select("param_set", "params", _r("mean_metric"), _r("std_metric")).withColumn(
        "reload_mismatches", F.lit(mismatches).cast("long")
    )


NB_SQL = f"""WITH toks AS (SELECT doc_id, lang, {{tokens}} AS tokens,
    {{val}} >= 0.8 AS is_val FROM documents),
  lab AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS label FROM (SELECT DISTINCT lang FROM toks)),
  tr AS (SELECT doc_id, label, tokens FROM toks JOIN lab USING (lang) WHERE NOT is_val),
  va AS (SELECT doc_id, tokens FROM toks WHERE is_val),
  nd AS (SELECT count(*) AS n FROM tr),
  dt AS (SELECT doc_id, unnest(tokens) AS term FROM tr),
  st AS (SELECT term, count(*) AS term_count, count(DISTINCT doc_id) AS doc_freq FROM dt WHERE length(term) >= 2 GROUP BY term),
  vocab AS (SELECT term, doc_freq FROM st, nd WHERE doc_freq >= 2 AND doc_freq <= 0.95 * n
            ORDER BY term_count DESC, term LIMIT 50000),
  idf AS (SELECT term, ln((1 + n) / (1 + doc_freq::DOUBLE)) + 1 AS idf FROM vocab, nd),
  dim AS (SELECT count(*) AS d FROM vocab),
  trw AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term),
  trx AS (SELECT doc_id, term, tf * idf AS w FROM trw JOIN idf USING (term)),
  trn AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM trx),
  cls AS (SELECT label, count(*) AS n_c FROM tr GROUP BY label),
  fs AS (SELECT label, term, sum(x) AS s FROM trn JOIN tr USING (doc_id) GROUP BY label, term),
  tot AS (SELECT cls.label, coalesce(sum(s), 0) AS total FROM cls LEFT JOIN fs USING (label) GROUP BY cls.label),
  prior AS (SELECT label, ln(n_c + 0.1) - ln((SELECT n FROM nd) + (SELECT count(*) FROM cls) * 0.1) AS pi FROM cls),
  vdt AS (SELECT doc_id, unnest(tokens) AS term FROM va),
  vw AS (SELECT doc_id, term, count(*) AS tf FROM vdt GROUP BY doc_id, term),
  vx AS (SELECT doc_id, term, tf * idf AS w FROM vw JOIN idf USING (term)),
  vn AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS x FROM vx),
  part AS (SELECT vn.doc_id, c.label, sum(vn.x * ln(coalesce(fs.s, 0) + 0.1)) AS a, sum(vn.x) AS xs
           FROM vn CROSS JOIN cls c LEFT JOIN fs ON fs.label = c.label AND fs.term = vn.term
           GROUP BY vn.doc_id, c.label),
  score AS (SELECT va.doc_id, c.label,
                   p.pi + coalesce(part.a, 0) - coalesce(part.xs, 0) * ln(t.total + (SELECT d FROM dim) * 0.1) AS sc
            FROM va CROSS JOIN cls c JOIN prior p ON p.label = c.label JOIN tot t ON t.label = c.label
            LEFT JOIN part ON part.doc_id = va.doc_id AND part.label = c.label),
  best AS (SELECT doc_id, label, sc, row_number() OVER (PARTITION BY doc_id ORDER BY sc DESC, label) AS r FROM score)
  SELECT doc_id, label::INTEGER AS prediction, round(sc, 6) AS log_likelihood FROM best WHERE r = 1"""


def _nb_sql() -> str:
    from tablewright.functions.hashing import sql_unit_hash
    from tablewright.jobs.registry import SQL_TOKENS

    return NB_SQL.replace("{tokens}", SQL_TOKENS).replace("{val}", sql_unit_hash(42, ["doc_id"]))


def _naive_bayes_scored(spark, sf):
    """(fitted model, validation vectors) of the cleaned, unstemmed documents."""
    ensure_checkpoint_dir(spark)
    docs = text.clean_text(fx.text_like(spark, sf), "text", "tokens", stemming=False, keep_text=False).checkpoint(eager=True)
    docs = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc").fit(docs).transform(docs)
    tagged = splits.assign_split(docs, [0.8, 0.2], 42, ["doc_id"])
    train, val = tagged.filter("split = 0"), tagged.filter("split = 1")
    vec, _ = text.encode_text_model(train, "doc_id", "tokens", max_features=50_000)
    return classify.naive_bayes(alpha=0.1).fit(vec.transform(train)), vec.transform(val)


@register("naive_bayes", _nb_sql())
def q_naive_bayes(spark, sf):
    """M8 on TF-IDF of the cleaned (unstemmed) documents: predicted class per validation document."""
    nb, val = _naive_bayes_scored(spark, sf)
    scored = nb.transform(val)
    raw = vector_to_array(F.col("rawPrediction"))
    return scored.select(
        "doc_id",
        F.col("prediction").cast("int").alias("prediction"),
        F.round(F.element_at(raw, F.col("prediction").cast("int") + 1), 6).alias("log_likelihood"),
    )


@register("encode_text_model", "WITH " + VOCAB_SQL + """, tfq AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term),
  w AS (SELECT doc_id, term_index, tf * (ln((1 + nd.n) / (1 + doc_freq::DOUBLE)) + 1) AS w FROM tfq JOIN vocab ON tfq.term = vocab.term, nd)
  SELECT doc_id, term_index::INTEGER AS slot, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def q_encode_text_model(spark, sf):
    """The stored slots of every document's vector."""
    toks = _docs_tokens(spark, sf)
    model, _ = text.encode_text_model(toks, "doc_id", "tokens", max_features=50_000)
    held = model.transform(toks).select("doc_id", F.unwrap_udt("features").alias("v"))
    slots = held.select("doc_id", F.explode(F.arrays_zip(F.col("v.indices").alias("slot"), F.col("v.values").alias("weight"))).alias("x"))
    return slots.select("doc_id", "x.slot", F.round("x.weight", 6).alias("weight"))


def _score_sql() -> str:
    return _nb_sql().replace(
        "SELECT doc_id, label::INTEGER AS prediction, round(sc, 6) AS log_likelihood FROM best WHERE r = 1",
        """SELECT doc_id, round(max(CASE WHEN label = 1 THEN exp(sc - top) END) / sum(exp(sc - top)), 6) AS score
  FROM (SELECT doc_id, label, sc, max(sc) OVER (PARTITION BY doc_id) AS top FROM score) GROUP BY doc_id""")


@register("score_probability", _score_sql())
def q_score_probability(spark, sf):
    """The probability of class 1 from a multinomial naive Bayes model."""
    nb, scored = _naive_bayes_scored(spark, sf)
    return evaluate.score(nb, scored, index=1).select("doc_id", _r("score"))


# ---------------------------------------------------------------- end-to-end jobs
# All rows; text_job searches its whole grid.  The searches of fraud_job and housing_job draw fewer parameter sets than
# the jobs' defaults (the full spaces: 24 forests, 300 ensembles, 12 alphas, 315 SVR sets), which are hours of fits on one machine (figures in the README).

@register("fraud_job")
def q_fraud_job(spark, sf):
    from tablewright.jobs import fraud

    grid = {"n_estimators": [100], "max_features": [10, 28]}
    spaces = {name: (1, space) for name, (_, space) in fraud.SUPERVISED.items()}
    return fraud.run(spark, sf, grid=grid, n_estimators=5, spaces=spaces).select("model", _r("auc"), _r("cv_auc"), _r("train_auc"))


@register("housing_job")
def q_housing_job(spark, sf):
    from tablewright.jobs import housing

    svr = {"gamma": [0.01, 0.1], "C": [100.0], "epsilon": [0.125]}
    res = housing.run(spark, sf, mlp_grid={"alpha": [0.01, 100.0]}, svr_grid=svr, max_iter=20, n_splits=2)
    return res.select("model", "split", _r("mae"), _r("r2"))


@register("text_job")
def q_text_job(spark, sf):
    from tablewright.jobs import text as text_job

    res = text_job.run(spark, sf)  # the whole grid
    return res.select("stage", "model", _r("accuracy"))


@register("sequence_matrix")
def q_sequence_matrix(spark, sf):
    from tablewright.jobs import text as text_job

    return text_job.sequences(spark, sf).select("doc_id", "split", F.array_join("padded", " ").alias("padded"))
