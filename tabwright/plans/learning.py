"""Split, feature preparation, classification and regression queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import features, hypothesis, models, summary
from tabwright.operators.rows import derive_threshold_flag
from tabwright.plans.registry import query, table
from tabwright.session import materialise, scratch_path
from tabwright.sources import report

# Labels with one in eleven missing: rows without a label are a class like any other.
_LABELS_SQL = "(SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN quality END AS quality FROM labels)"


def _labels(spark, d):
    return table(spark, d, "labels").select("doc_id", F.when(F.col("doc_id") % 11 != 0, F.col("quality")).alias("quality"))


@query(
    "M1_stratified_split",
    f"""WITH l AS {_LABELS_SQL},
            r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5('42:split:' || doc_id), doc_id) AS rn FROM l),
            c AS (SELECT quality, count(*) AS n FROM l GROUP BY 1),
            t AS (SELECT ceil(count(*) * 0.2::DECIMAL(2,1))::BIGINT AS seats, count(*) AS total FROM l),
            f AS (SELECT quality, n * seats // total AS fl, (n * seats) % total AS rest, seats FROM c, t),
            q AS (SELECT quality, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, quality NULLS FIRST)
                           <= seats - sum(fl) OVER () THEN 1 ELSE 0 END AS quota FROM f)
       SELECT doc_id, r.quality, rn <= quota AS is_test FROM r JOIN q ON r.quality IS NOT DISTINCT FROM q.quality""",
)
def m1(spark, d):
    return features.stratified_split(_labels(spark, d), "quality", "doc_id").select("doc_id", "quality", "is_test")


_GAPS_SQL = """(SELECT l_orderkey, l_linenumber, l_extendedprice, l_linestatus,
                       CASE WHEN l_linenumber <> 7 THEN l_quantity END AS l_quantity,
                       CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS l_returnflag FROM lineitem)"""


def _gaps(spark, d):
    line = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        "l_linestatus",
        F.when(line != 7, F.col("l_quantity")).alias("l_quantity"),
        F.when(line != 5, F.col("l_returnflag")).alias("l_returnflag"),
    )


_SCALED_SQL = f"""(SELECT l_orderkey, l_linenumber,
       round((coalesce(l_quantity, mq) - aq) / sq, 6) AS quantity_z, round((l_extendedprice - ap) / sp, 6) AS price_z,
       coalesce(l_returnflag, flag) AS flag, l_linestatus
  FROM {_GAPS_SQL}, (SELECT mq, avg(coalesce(l_quantity, mq)) AS aq, stddev_pop(coalesce(l_quantity, mq)) AS sq,
                            avg(l_extendedprice) AS ap, stddev_pop(l_extendedprice) AS sp
                     FROM {_GAPS_SQL}, (SELECT median(l_quantity) AS mq FROM {_GAPS_SQL}) GROUP BY mq),
       (SELECT l_returnflag AS flag FROM {_GAPS_SQL} WHERE l_returnflag IS NOT NULL
        GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1))"""


@query("M2_numeric_features", f"SELECT l_orderkey, l_linenumber, quantity_z, price_z FROM {_SCALED_SQL}")
def m2(spark, d):
    df = _gaps(spark, d)
    stage = features.numeric_stage(features.fit_numeric(df, ["l_quantity", "l_extendedprice"]))
    return stage.transform(df).select(
        "l_orderkey",
        "l_linenumber",
        F.round("l_quantity_scaled", 6).alias("quantity_z"),
        F.round("l_extendedprice_scaled", 6).alias("price_z"),
    )


def _slots(names, vector="features"):
    cells = vector_to_array(vector)
    return [cells[i].alias(n) for i, n in enumerate(names)]


_HOT_SQL = ", ".join(
    [f"CASE WHEN flag = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS flag_{v}" for v in "ANR"]
    + [f"CASE WHEN l_linestatus = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS status_{v}" for v in "FO"]
)
_HOT = [f"flag_{v}" for v in "ANR"] + [f"status_{v}" for v in "FO"]


@query("M3_categorical_features", f"SELECT l_orderkey, l_linenumber, {_HOT_SQL} FROM {_SCALED_SQL}")
def m3(spark, d):
    df = _gaps(spark, d)
    out = features.fit_features(df, [], ["l_returnflag", "l_linestatus"]).transform(df)
    return out.select("l_orderkey", "l_linenumber", *_slots(_HOT))


@query(
    "M4_column_transform",
    f"SELECT l_orderkey, l_linenumber, quantity_z, price_z, {_HOT_SQL} FROM {_SCALED_SQL}",
)
def m4(spark, d):
    df = _gaps(spark, d)
    out = features.fit_features(df, ["l_quantity", "l_extendedprice"], ["l_returnflag", "l_linestatus"]).transform(df)
    out = out.select("l_orderkey", "l_linenumber", *_slots(["quantity_z", "price_z", *_HOT]))
    return out.withColumns({c: F.round(c, 6) for c in ("quantity_z", "price_z")})


@query(
    "M5_balanced_weights",
    f"""WITH l AS {_LABELS_SQL}, c AS (SELECT quality, count(*) AS n FROM l GROUP BY 1)
        SELECT doc_id, l.quality, (SELECT count(*) FROM l)::DOUBLE / ((SELECT count(*) FROM c) * n) AS weight
        FROM l JOIN c ON l.quality IS NOT DISTINCT FROM c.quality""",
)
def m5(spark, d):
    return features.balanced_weights(_labels(spark, d), "quality").select("doc_id", "quality", "weight")


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_CATEGORICAL = ["l_returnflag", "l_linestatus"]
# Line items labelled by revenue in its top quarter, one fifth of either label set aside.
_SIDES_SQL = """(WITH lines AS (SELECT l_orderkey * 10 + l_linenumber AS line_key, l_extendedprice * (1 - l_discount) AS revenue FROM lineitem),
            flagged AS (SELECT line_key, CASE WHEN revenue >= (SELECT quantile_cont(revenue, 0.75) FROM lines) THEN 1 ELSE 0 END AS high FROM lines),
            r AS (SELECT *, row_number() OVER (PARTITION BY high ORDER BY md5('42:split:' || line_key), line_key::VARCHAR) AS rn FROM flagged),
            c AS (SELECT high, count(*) AS n FROM flagged GROUP BY 1),
            t AS (SELECT ceil(count(*) * 0.2::DECIMAL(2,1))::BIGINT AS seats, count(*) AS total FROM flagged),
            f AS (SELECT high, n * seats // total AS fl, (n * seats) % total AS rest, seats FROM c, t),
            q AS (SELECT high, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, high) <= seats - sum(fl) OVER () THEN 1 ELSE 0 END AS quota FROM f)
       SELECT line_key, high, rn <= quota AS is_test FROM r JOIN q USING (high))"""


def _sides(spark, d):
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    key = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_key")
    lines = table(spark, d, "lineitem").select(key, *_NUMERIC, *_CATEGORICAL, (price * (1 - discount)).alias("revenue"))
    flagged = derive_threshold_flag(lines, "revenue", 0.75, "high").drop("revenue")
    split = materialise(features.stratified_split(materialise(flagged, "flagged"), "high", "line_key"), "split")
    return split.where(~F.col("is_test")), split.where("is_test")


def _prepared(spark, d):
    train, test = _sides(spark, d)
    prepare = features.fit_features(train, _NUMERIC, _CATEGORICAL)
    ready = materialise(prepare.transform(features.balanced_weights(train, "high")).select("high", "weight", "features"), "train")
    return ready, prepare.transform(test)


def _accurate(scored, least):
    """Test rows, and whether the share of right ones reaches ``least``; three quarters would come from one label alone."""
    hit, positive = F.col("prediction") == F.col("high"), F.col("high") == 1
    counts = scored.agg(F.count(F.lit(1)).alias("n_test"), F.count_if(positive).alias("n_high"), F.count_if(hit).alias("hits"))
    return counts.select("n_test", "n_high", (F.col("hits") >= F.col("n_test") * F.lit(least)).alias("accurate"))


_ACCURATE_SQL = f"""SELECT count(*) AS n_test, count(*) FILTER (WHERE high = 1) AS n_high, true AS accurate FROM {_SIDES_SQL} WHERE is_test"""


@query("M6_random_forest", _ACCURATE_SQL)
def m6(spark, d):
    ready, test = _prepared(spark, d)
    model = models.random_forest("high").fit(ready)
    return _accurate(model.transform(test), 0.93)


@query("M7_gradient_boosting", _ACCURATE_SQL)
def m7(spark, d):
    ready, test = _prepared(spark, d)
    model = models.gradient_boosting("high").fit(ready)
    return _accurate(model.transform(test), 0.96)


def _logistic(ready):
    total = ready.agg(F.sum("weight")).first()[0]
    return models.logistic_regression("high", total).fit(ready), total


@query(
    "M8_logistic_regression",
    f"SELECT count(*) AS n_train, true AS at_the_minimum FROM {_SIDES_SQL} WHERE NOT is_test",
)
def m8(spark, d):
    """At the fitted weights every derivative of the penalised loss is next to zero."""
    ready, _ = _prepared(spark, d)
    model, total = _logistic(ready)
    x = vector_to_array("features")
    chance = F.lit(1.0) / (1 + F.exp(-(sum((x[i] * float(w) for i, w in enumerate(model.coefficients)), F.lit(float(model.intercept))))))
    miss = ready.select(x.alias("x"), (F.col("weight") * (chance - F.col("high"))).alias("e"))
    slopes = [F.sum(F.col("e") * F.col("x")[i]) / total + float(w) / total for i, w in enumerate(model.coefficients)]
    steepest = F.greatest(F.abs(F.sum("e") / total), *map(F.abs, slopes))
    return miss.agg(F.count(F.lit(1)).alias("n_train"), (steepest < 1e-6).alias("at_the_minimum"))


@query("M9_batch_predict", f"SELECT line_key, high, true AS follows FROM {_SIDES_SQL} WHERE is_test")
def m9(spark, d):
    """Every prediction is the side of the plane that the fitted weights describe."""
    ready, test = _prepared(spark, d)
    model = _logistic(ready)[0]
    scored = models.batch_predict(model, test)
    x = vector_to_array("features")
    score = sum((x[i] * float(w) for i, w in enumerate(model.coefficients)), F.lit(float(model.intercept)))
    return scored.select("line_key", "high", (F.col("prediction") == (score > 0).cast("double")).alias("follows"))


# A fixed rule scored against the labels, so that the metrics have a SQL twin.
_RULE_SQL = """(SELECT quality::DOUBLE AS y, CASE WHEN n_chars >= 400 THEN 1.0 ELSE 0.0 END::DOUBLE AS p
                FROM labels JOIN documents USING (doc_id))"""


def _ruled(spark, d):
    rule = F.when(F.col("n_chars") >= 400, 1.0).otherwise(0.0)
    docs = table(spark, d, "documents").select("doc_id", rule.alias("prediction"))
    return table(spark, d, "labels").join(docs, "doc_id")


@query("M10_accuracy", f"SELECT round(avg((y = p)::INT), 9) AS accuracy FROM {_RULE_SQL}")
def m10(spark, d):
    return models.accuracy(_ruled(spark, d), "quality").select(F.round("accuracy", 9).alias("accuracy"))


_CONFUSION_SQL = f"""(SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) AS n, count(*) FILTER (WHERE y = p) AS hits FROM {_RULE_SQL})"""


@query(
    "M11_binary_scores",
    f"""SELECT round(hits / n, 9) AS accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 9) AS precision,
               round(coalesce(tp / nullif(tp + fn, 0), 0), 9) AS recall,
               round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 9) AS f1 FROM {_CONFUSION_SQL}""",
)
def m11(spark, d):
    return _rounded(models.binary_scores(_ruled(spark, d), "quality"))


def _rounded(df, digits=9):
    return df.withColumns({f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double"})


_RULES = {"long": 400, "longer": 4000}
_RULE_ROWS_SQL = "(" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, {k} AS place, quality = 1 AS y, n_chars >= {least} AS p FROM labels JOIN documents USING (doc_id)"
    for k, (name, least) in enumerate(_RULES.items())
) + ")"


@query(
    "S13_report_models",
    f"""WITH c AS (SELECT model, place, count(*) FILTER (WHERE y = p) / count(*) AS accuracy,
                  coalesce(2 * count(*) FILTER (WHERE y AND p) / nullif(count(*) FILTER (WHERE y) + count(*) FILTER (WHERE p), 0), 0) AS f1
                  FROM {_RULE_ROWS_SQL} GROUP BY 1, 2)
        SELECT 'models' AS section, 'accuracy' AS metric, model AS "group", round(accuracy, 6) AS value_double, true AS printed FROM c
        UNION ALL SELECT 'models', 'f1', model, round(f1, 6), true FROM c
        UNION ALL (SELECT 'chosen', 'accuracy', model, round(accuracy, 6), true FROM c ORDER BY accuracy DESC, place LIMIT 1)""",
)
def s13_models(spark, d):
    """The report's model table and chosen model, for two fixed rules in the place of models."""
    rows = []
    for place, (name, least) in enumerate(_RULES.items()):
        rule = F.when(F.col("n_chars") >= least, 1.0).otherwise(0.0)
        scored = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", rule.alias("prediction")), "doc_id")
        rows.append(models.binary_scores(scored, "quality").select(F.lit(name).alias("model"), F.lit(place).alias("place"), "accuracy", "f1"))
    scores = materialise(rows[0].unionByName(rows[1]), "scores")
    chosen = scores.orderBy(F.desc("accuracy"), "place").first()["model"]
    labels = table(spark, d, "labels")
    stats = summary.describe(labels, ["quality"])
    tests = hypothesis.interpret_test(hypothesis.welch_t_test(labels, "toxic", ["quality"], 1, 0))
    out = report.report_metrics({"read": labels}, stats, tests, models=scores, chosen=chosen)
    shown = out.where(F.col("section").isin("models", "chosen"))
    return shown.select("section", "metric", "group", F.round("value_double", 6).alias("value_double"), F.col("value_string").rlike("^[0-9.]+%?$").alias("printed"))


_PER_CLASS_SQL = f"""(SELECT c, count(*) FILTER (WHERE y = c) AS support,
       coalesce(count(*) FILTER (WHERE y = c AND p = c) / nullif(count(*) FILTER (WHERE p = c), 0), 0) AS precision,
       coalesce(count(*) FILTER (WHERE y = c AND p = c) / nullif(count(*) FILTER (WHERE y = c), 0), 0) AS recall,
       coalesce(2 * count(*) FILTER (WHERE y = c AND p = c)
                / nullif(count(*) FILTER (WHERE y = c) + count(*) FILTER (WHERE p = c), 0), 0) AS f1
  FROM {_RULE_SQL}, (SELECT unnest([0, 1]) AS c) GROUP BY c)"""


@query("M12_weighted_f1", f"SELECT round(sum(f1 * support) / sum(support), 9) AS weighted_f1 FROM {_PER_CLASS_SQL}")
def m12(spark, d):
    return _rounded(models.weighted_f1(_ruled(spark, d), "quality"))


@query(
    "M13_classification_report",
    f"""SELECT CAST(c AS VARCHAR) AS row, round(precision, 9) AS precision, round(recall, 9) AS recall,
               round(f1, 9) AS f1, support FROM {_PER_CLASS_SQL}
        UNION ALL SELECT 'accuracy', round(hits / n, 9), round(hits / n, 9), round(hits / n, 9), n FROM {_CONFUSION_SQL}
        UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
                         CAST(sum(support) AS BIGINT) FROM {_PER_CLASS_SQL}
        UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
                         round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
                         CAST(sum(support) AS BIGINT) FROM {_PER_CLASS_SQL}""",
)
def m13(spark, d):
    return _rounded(models.classification_report(_ruled(spark, d), "quality"))


@query("M14_compare_and_select", "SELECT unnest(['RandomForest', 'GradientBoosting', 'LogisticRegression']) AS model, true AS rightly_chosen_or_left")
def m14(spark, d):
    """The candidate that is kept is the first of the highest accuracy, and its scored rows give that accuracy again."""
    train, test = _sides(spark, d)
    picked = models.compare_and_select(train, test, "high", _NUMERIC, _CATEGORICAL)
    ranked = picked.results.collect()
    best = max(r["accuracy"] for r in ranked)
    first = min((r["place"], r["model"]) for r in ranked if r["accuracy"] == best)[1]
    again = models.accuracy(picked.best_scored, "high").first()[0]
    right = (F.col("model") == picked.best_name) == (F.col("model") == first)
    return picked.results.select("model", (right & F.lit(abs(again - best) < 1e-12)).alias("rightly_chosen_or_left"))


@query(
    "M15_save_model",
    f"SELECT count(*) AS scored, 0::BIGINT AS changed, 3::BIGINT AS candidates FROM {_SIDES_SQL} WHERE is_test",
)
def m15(spark, d):
    """The best of three, saved with its preparation: reloaded, it scores every row as before."""
    train, test = _sides(spark, d)
    picked = models.compare_and_select(train, test, "high", _NUMERIC, _CATEGORICAL)
    path = scratch_path(spark, "model")
    models.save_model(picked.best_model, path)
    before = picked.best_scored.select("line_key", *_NUMERIC, *_CATEGORICAL, F.col("prediction").alias("before"))
    after = models.batch_predict(models.load_model(path), before)
    candidates = F.lit(picked.results.count()).cast("bigint")
    return after.agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("before") != F.col("prediction")).alias("changed"), candidates.alias("candidates")
    )


_X, _Z, _Y = "l_quantity", "l_discount", "l_extendedprice"
_OLS_SQL = f"""
WITH m AS (SELECT count(*) AS n, avg({_X}) AS mx, avg({_Z}) AS mz, avg({_Y}) AS my,
                  var_pop({_X}) * count(*) AS sxx, var_pop({_Z}) * count(*) AS szz, var_pop({_Y}) * count(*) AS syy,
                  covar_pop({_X}, {_Z}) * count(*) AS sxz, covar_pop({_X}, {_Y}) * count(*) AS sxy,
                  covar_pop({_Z}, {_Y}) * count(*) AS szy FROM lineitem),
     b AS (SELECT *, sxx * szz - sxz * sxz AS det, (sxy * szz - szy * sxz) / (sxx * szz - sxz * sxz) AS b1,
                  (szy * sxx - sxy * sxz) / (sxx * szz - sxz * sxz) AS b2 FROM m),
     e AS (SELECT *, my - b1 * mx - b2 * mz AS b0, (syy - b1 * sxy - b2 * szy) / (n - 3) AS s2,
                  (b1 * sxy + b2 * szy) / syy AS r2 FROM b),
     t AS (SELECT '{_X}' AS term, b1 AS coefficient, sqrt(s2 * szz / det) AS std_error, r2, n FROM e
           UNION ALL SELECT '{_Z}', b2, sqrt(s2 * sxx / det), r2, n FROM e
           UNION ALL SELECT 'intercept', b0,
                  sqrt(s2 * (1.0 / n + (mx * mx * szz - 2 * mx * mz * sxz + mz * mz * sxx) / det)), r2, n FROM e),
     s AS (SELECT *, coefficient / std_error AS t, (n - 3)::DOUBLE AS dof FROM t)"""


@query(
    "D7_ols",
    f"""{_OLS_SQL}
    SELECT term, round(coefficient, 4) AS coefficient, round(std_error, 4) AS std_error, round(t, 4) AS t,
           round(r2, 6) AS r2, CASE WHEN abs(t) > 1.96 THEN CASE WHEN coefficient > 0 THEN 'raises' ELSE 'lowers' END
                                    ELSE 'no_effect' END AS effect FROM s""",
)
def d7(spark, d):
    terms = models.interpret_ols(models.ols(table(spark, d, "lineitem"), _Y, [_X, _Z]))
    return terms.select(
        "term",
        *[F.round(c, 4).alias(c) for c in ("coefficient", "std_error", "t")],
        F.round("r2", 6).alias("r2"),
        "effect",
    )


# Two standardised predictors: the penalised normal equations in closed form.
_RIDGE_SQL = f"""
m AS (SELECT count(*) AS n, avg({_X}) AS mx, stddev_pop({_X}) AS sx, avg({_Z}) AS mz, stddev_pop({_Z}) AS sz,
             avg({_Y}) AS my, corr({_X}, {_Z}) * count(*) AS c,
             covar_pop({_X}, {_Y}) / stddev_pop({_X}) * count(*) AS xy,
             covar_pop({_Z}, {_Y}) / stddev_pop({_Z}) * count(*) AS zy FROM lineitem),
w AS (SELECT *, (xy * (n + a) - zy * c) / ((n + a) * (n + a) - c * c) AS w1,
             (zy * (n + a) - xy * c) / ((n + a) * (n + a) - c * c) AS w2 FROM m, (SELECT 500.0::DOUBLE AS a))"""


def _ridge(spark, d):
    return models.ridge(table(spark, d, "lineitem"), _Y, [_X, _Z], alpha=500.0)


@query(
    "D8_ridge",
    f"""WITH {_RIDGE_SQL}
        SELECT l_orderkey, l_linenumber, l_partkey, round(my + w1 * ({_X} - mx) / sx + w2 * ({_Z} - mz) / sz, 3) AS predicted
        FROM lineitem, w""",
)
def d8(spark, d):
    scored = models.batch_predict(_ridge(spark, d), table(spark, d, "lineitem"))
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", F.round("prediction", 3).alias("predicted"))


@query(
    "D9_score_and_convert",
    f"""WITH {_RIDGE_SQL}
        SELECT l_orderkey, l_linenumber, l_partkey,
               CAST(round_even((my + w1 * ({_X} - mx) / sx + w2 * ({_Z} - mz) / sz) * 1350 / 10000, 0) AS BIGINT) AS converted
        FROM lineitem, w""",
)
def d9(spark, d):
    scored = models.score_and_convert(_ridge(spark, d), table(spark, d, "lineitem"))
    return scored.select("l_orderkey", "l_linenumber", "l_partkey", "converted")
