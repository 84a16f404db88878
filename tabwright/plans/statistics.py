"""Summary statistics, correlation and hypothesis tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import clean, groups, hypothesis, rows, summaries, summary
from tabwright.operators.quantiles import median_point, quantiles
from tabwright.plans.registry import query, table
from tabwright.session import materialise, scratch_path


def rounded(df, digits=6, skip=()):
    """Fractional columns to a fixed number of digits: engines add in different orders."""
    return df.withColumns(
        {f.name: F.round(f.name, digits) for f in df.schema.fields if f.dataType.typeName() == "double" and f.name not in skip}
    )


_MEASURES = ("l_quantity", "l_extendedprice", "l_discount")

_DESCRIBE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean,
               round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25,
               round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max
        FROM lineitem"""
    for c in _MEASURES
)


@query("A9_describe", _DESCRIBE_SQL)
def a9(spark, d):
    return rounded(summary.describe(table(spark, d, "lineitem"), _MEASURES))


_QS = (0.01, 0.25, 0.5, 0.75, 0.99)


@query(
    "A10_quantile",
    " UNION ALL ".join(
        f"""SELECT o_orderstatus, {q}::DOUBLE AS q, round(quantile_cont(o_totalprice, {q}), 6) AS value
            FROM orders GROUP BY o_orderstatus"""
        for q in _QS
    ),
)
def a10(spark, d):
    q = quantiles(table(spark, d, "orders"), ["o_totalprice"], _QS, by=["o_orderstatus"])
    return rounded(q.select("o_orderstatus", "q", "value"))


# The days of the events: the parts of a table that grows.
_EVENT_STATS = """count(value) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, min(value) AS min,
        round(quantile_cont(value, 0.25), 6) AS q25, round(quantile_cont(value, 0.5), 6) AS q50, round(quantile_cont(value, 0.75), 6) AS q75, max(value) AS max"""


def _events_by_day(spark, d):
    """The events as a table that gets a folder a day, and its days in order."""
    path = scratch_path(spark, "events-by-day")
    dated = table(spark, d, "events").select("event_type", "value", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    dated.repartition("day").write.partitionBy("day").parquet(path)
    kept = spark.read.parquet(path).withColumn("day", F.col("day").cast("string"))
    return kept, [r["day"] for r in kept.select("day").distinct().orderBy("day").collect()]


@query("A9_describe_grown_table", f"SELECT 'value' AS variable, {_EVENT_STATS} FROM events")
def a9_grown(spark, d):
    """All days but the last are summarised; then the last one is added from its own rows and everything described."""
    events, days = _events_by_day(spark, d)
    store = summaries.SummaryStore(spark, scratch_path(spark, "day-summaries"), ["value"])
    store.add_all(events.where(F.col("day") < days[-1]), "day")
    store.add(days[-1], events.where(F.col("day") == days[-1]))
    return rounded(summaries.describe_summaries(events, store.merged(), ["value"]))


@query(
    "A17_describe_days_by_type",
    f"""WITH m AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events), r AS (SELECT max(day) AS last FROM m)
        SELECT event_type, 'value' AS variable, {_EVENT_STATS} FROM m, r WHERE day < last GROUP BY event_type""",
)
def a17_days(spark, d):
    """The kept summaries of a range of days, by event type, without another pass for their sketches."""
    events, days = _events_by_day(spark, d)
    store = summaries.SummaryStore(spark, scratch_path(spark, "day-summaries"), ["value"], by=["event_type"])
    store.add_all(events, "day")
    part = events.where(F.col("day") < days[-1])
    last = days[-2] if len(days) > 1 else ""
    return rounded(summaries.describe_summaries(part, materialise(store.merged(last=last), "merged"), ["value"], by=["event_type"]))


@query("A11_median", "SELECT round(median(value), 6) AS median FROM events")
def a11(spark, d):
    return rounded(spark.range(1).select(median_point(table(spark, d, "events"), "value").alias("median")))


@query(
    "A13_variance",
    "SELECT round(var_samp(o_totalprice), 2) AS variance, round(stddev_samp(o_totalprice), 6) AS std FROM orders",
)
def a13(spark, d):
    df = summary.spread_samples(table(spark, d, "orders"), "o_totalprice")
    return df.select(F.round("variance", 2).alias("variance"), F.round("std", 6).alias("std"))


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "flat")


def _corr_input(spark, d):
    line = F.col("l_linenumber")
    return table(spark, d, "lineitem").select(
        F.when(line != 7, F.col("l_quantity")).alias("l_quantity"),
        F.when(line != 5, F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount",
        F.lit(3.0).alias("flat"),
    )


@query(
    "A14_corr_matrix",
    "WITH t AS (SELECT CASE WHEN l_linenumber <> 7 THEN l_quantity END AS l_quantity,"
    " CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS l_extendedprice, l_discount,"
    " 3.0::DOUBLE AS flat FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS var1, '{b}' AS var2, "
        + ("CAST(NULL AS DOUBLE) AS r" if "flat" in (a, b) else f"round(corr({a}, {b}), 6) AS r FROM t")
        for a in _CORR
        for b in _CORR
    ),
)
def a14(spark, d):
    return rounded(summary.corr_matrix(_corr_input(spark, d), _CORR))


#: Two-sided p of t with dof by Simpson's rule on the density of Student's t over [0, |t|].
P_VALUE_SQL = """(SELECT round(greatest(0.0, 1 - 2 * sum(w * f) * (abs(s.t) / 2000) / 3), 6) FROM (
    SELECT CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w,
           exp(lgamma((s.dof + 1) / 2) - lgamma(s.dof / 2)) / sqrt(pi() * s.dof)
             * pow(1 + pow(i * abs(s.t) / 2000, 2) / s.dof, -(s.dof + 1) / 2) AS f
    FROM range(2001) r(i)))"""


def welch_sql(source: str, group: str, a: str, b: str, measure: str, digits: int = 6) -> str:
    return f"""
    SELECT '{measure}' AS measure, n_a, n_b, round(mean_a, {digits}) AS mean_a, round(mean_b, {digits}) AS mean_b,
           round(t, {digits}) AS t, round(dof, 4) AS dof, {P_VALUE_SQL} AS p
    FROM (SELECT *, (mean_a - mean_b) / sqrt(va + vb) AS t,
                 pow(va + vb, 2) / (va * va / (n_a - 1) + vb * vb / (n_b - 1)) AS dof
          FROM (SELECT count({measure}) FILTER (WHERE {group} = '{a}') AS n_a,
                       count({measure}) FILTER (WHERE {group} = '{b}') AS n_b,
                       avg({measure}) FILTER (WHERE {group} = '{a}') AS mean_a,
                       avg({measure}) FILTER (WHERE {group} = '{b}') AS mean_b,
                       var_samp({measure}) FILTER (WHERE {group} = '{a}') / n_a AS va,
                       var_samp({measure}) FILTER (WHERE {group} = '{b}') / n_b AS vb
                FROM {source})) s"""


def welch_columns(tests, digits=6):
    return tests.select(
        "measure",
        "n_a",
        "n_b",
        F.round("mean_a", digits).alias("mean_a"),
        F.round("mean_b", digits).alias("mean_b"),
        F.round("t", digits).alias("t"),
        F.round("dof", 4).alias("dof"),
        F.round("p", 6).alias("p"),
    )


@query("A15_welch_t_test", welch_sql("orders", "o_orderstatus", "F", "O", "o_totalprice"))
def a15(spark, d):
    return welch_columns(hypothesis.welch_t_test(table(spark, d, "orders"), "o_orderstatus", "o_totalprice", "F", "O"))


_TESTED = "(SELECT *, CAST(quality AS VARCHAR) AS grade FROM documents JOIN labels USING (doc_id))"


@query(
    "A16_interpret_test",
    f"""SELECT measure, t, p, CASE WHEN p < 0.05 THEN CASE WHEN t > 0 THEN 'higher' ELSE 'lower' END
               ELSE 'not_significant' END AS verdict
        FROM ({welch_sql(_TESTED, "grade", "1", "0", "n_chars")}
              UNION ALL {welch_sql(_TESTED, "grade", "1", "0", "toxic")})""",
)
def a16(spark, d):
    df = table(spark, d, "documents").select("doc_id", "n_chars").join(table(spark, d, "labels"), "doc_id")
    tests = hypothesis.welch_t_test(df, "quality", ["n_chars", "toxic"], 1, 0)
    return welch_columns(tests).withColumn("verdict", hypothesis.verdict()).select("measure", "t", "p", "verdict")


_QUARTILES_SQL = """SELECT event_type, count(value) AS n, quantile_cont(value, 0.25) AS q25,
    quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75 FROM events GROUP BY event_type"""


@query(
    "A17_box_summary",
    f"""WITH q AS (SELECT *, q25 - 1.5 * (q75 - q25) AS lo, q75 + 1.5 * (q75 - q25) AS hi FROM ({_QUARTILES_SQL}))
        SELECT q.event_type, n, min(value) FILTER (WHERE value BETWEEN lo AND hi) AS whisker_low,
               round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
               max(value) FILTER (WHERE value BETWEEN lo AND hi) AS whisker_high,
               count(*) FILTER (WHERE value NOT BETWEEN lo AND hi) AS outliers
        FROM events JOIN q USING (event_type) GROUP BY ALL""",
)
def a17(spark, d):
    return rounded(summary.box_summary(table(spark, d, "events"), "event_type", "value"))


@query(
    "A17_box_points",
    f"""WITH q AS (SELECT *, q25 - 1.5 * (q75 - q25) AS lo, q75 + 1.5 * (q75 - q25) AS hi FROM ({_QUARTILES_SQL}))
        SELECT event_type, value FROM events JOIN q USING (event_type) WHERE value NOT BETWEEN lo AND hi""",
)
def a17_points(spark, d):
    return summary.box_points(table(spark, d, "events"), "event_type", "value")


def anova_sql(rows_sql: str) -> str:
    """Over rows (g, x) with three groups; with two numerator degrees the F tail is closed-form."""
    return f"""
    WITH r AS ({rows_sql}),
         g AS (SELECT g, count(*) AS n, avg(x) AS m, var_samp(x) AS v FROM r GROUP BY g),
         s AS (SELECT count(*) AS k, CAST(sum(n) AS BIGINT) AS n,
                      sum(n * pow(m - (SELECT sum(n * m) / sum(n) FROM g), 2)) AS ssb,
                      sum((n - 1) * v) AS ssw FROM g),
         f AS (SELECT *, (ssb / (k - 1)) / (ssw / (n - k)) AS f FROM s)
    SELECT k, n, round(f, 6) AS f, round(pow(1 + 2 * f / (n - k), -(n - k) / 2.0), 6) AS p FROM f"""


def _anova_columns(df):
    return df.select("k", "n", F.round("f", 6).alias("f"), F.round("p", 6).alias("p"))


@query(
    "D4_levene_median",
    anova_sql(
        """SELECT o_orderstatus AS g, abs(o_totalprice - median(o_totalprice) OVER (PARTITION BY o_orderstatus)) AS x
           FROM orders"""
    ),
)
def d4(spark, d):
    return _anova_columns(hypothesis.levene_test(table(spark, d, "orders"), "o_orderstatus", "o_totalprice"))


@query(
    "D4_levene_mean",
    anova_sql(
        """SELECT o_orderstatus AS g, abs(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderstatus)) AS x
           FROM orders"""
    ),
)
def d4_mean(spark, d):
    return _anova_columns(hypothesis.levene_test(table(spark, d, "orders"), "o_orderstatus", "o_totalprice", "mean"))


@query("D5_anova_oneway", anova_sql("SELECT o_orderstatus AS g, o_totalprice AS x FROM orders"))
def d5(spark, d):
    return _anova_columns(hypothesis.anova_oneway(table(spark, d, "orders"), "o_orderstatus", "o_totalprice"))


@query(
    "D6_pearson_test",
    f"""SELECT n, round(r, 6) AS r, round(t, 6) AS t, {P_VALUE_SQL} AS p FROM (
          SELECT *, (n - 2)::DOUBLE AS dof, r * sqrt((n - 2) / (1 - r * r)) AS t FROM (
            SELECT count(*) AS n, corr(l_discount, l_extendedprice) AS r FROM lineitem)) s""",
)
def d6(spark, d):
    out = hypothesis.pearson_test(table(spark, d, "lineitem"), "l_discount", "l_extendedprice")
    return rounded(out)


# The flagship: clean, then test the effect of one group on two measures.
EFFECT_INPUT_SQL = """
    WITH raw AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 23 <> 0 THEN o_orderstatus END AS status,
                        CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS price,
                        CAST(strftime(o_orderdate, '%Y') AS DOUBLE) AS year
                 FROM orders),
         flagged AS (SELECT *, CASE WHEN status = 'F' THEN 'Yes' ELSE 'No' END AS done FROM raw),
         cleaned AS (SELECT * FROM flagged WHERE price >= (SELECT quantile_cont(price, 0.01) FROM flagged)
                       AND price <= (SELECT quantile_cont(price, 0.99) FROM flagged))"""


def effect_input(spark, d):
    """orders with planted gaps, every row twice."""
    key = F.col("o_orderkey")
    raw = table(spark, d, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(key % 23 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(key % 13 != 0, F.col("o_totalprice")).alias("price"),
        F.date_format("o_orderdate", "yyyy").cast("double").alias("year"),
    )
    return rows.append(raw, raw)


def effect_analysis(df):
    """Deduplicate, derive the group, trim the measure, then one pass for both tests.

    The deduplicated table is written once: the quantile passes and the tests read
    only the columns they need of it.
    """
    df = materialise(rows.drop_duplicates(df), "deduplicated")
    df = rows.derive_binary(df, "status", "F", "done")
    df = rows.filter_range(df, "price", *(F.lit(e) for e in clean.trim_edges(df, "price")))
    tests = hypothesis.welch_t_test(df, "done", ["price", "year"], "Yes", "No")
    return hypothesis.interpret_test(tests)


@query(
    "effect_analysis",
    f"""{EFFECT_INPUT_SQL}, tests AS ({welch_sql("cleaned", "done", "Yes", "No", "price")}
          UNION ALL {welch_sql("cleaned", "done", "Yes", "No", "year")})
        SELECT *, CASE WHEN p < 0.05 THEN CASE WHEN t > 0 THEN 'higher' ELSE 'lower' END
                  ELSE 'not_significant' END AS verdict FROM tests""",
)
def effect(spark, d):
    return welch_columns(effect_analysis(effect_input(spark, d))).withColumn("verdict", hypothesis.verdict())


@query(
    "monthly_segment_revenue",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, c_mktsegment, count(*) AS orders,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice >= 1000 GROUP BY 1, 2 ORDER BY 1, 2""",
)
def monthly(spark, d):
    orders = rows.filter_ge(table(spark, d, "orders"), "o_totalprice", 1000)
    # Summed per customer and month first: a customer with very many orders meets the join as few rows.
    per_customer = orders.groupBy("o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(groups.exact_money("o_totalprice")).alias("revenue")
    )
    joined = per_customer.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (
        joined.groupBy("month", "c_mktsegment")
        .agg(F.sum("n").alias("orders"), F.sum("revenue").cast("double").alias("revenue"))
        .orderBy("month", "c_mktsegment")
    )
