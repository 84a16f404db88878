"""Trim, imputation, coercion, the composite survey cleaning, label repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions import numbers as num
from tabwright.operators import clean
from tabwright.plans.registry import query, table
from tabwright.plans.relational import gappy_lineitem
from tabwright.plans.statistics import EFFECT_INPUT_SQL, effect_input


@query(
    "C1_percentile_trim",
    """SELECT o_orderkey, o_totalprice FROM orders
       WHERE o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.01) FROM orders)
         AND o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.99) FROM orders)""",
)
def c1(spark, d):
    return clean.percentile_trim(table(spark, d, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice")


_GAPPY_SQL = """(SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_quantity END AS l_quantity,
                        CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS l_returnflag, l_linestatus FROM lineitem)"""


@query(
    "C2_impute_median",
    f"""SELECT l_orderkey, l_linenumber,
               coalesce(l_quantity, (SELECT median(l_quantity) FROM {_GAPPY_SQL})) AS l_quantity FROM {_GAPPY_SQL}""",
)
def c2(spark, d):
    df = clean.impute_median(gappy_lineitem(spark, d), "l_quantity")
    return df.select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "C3_impute_mode",
    f"""SELECT l_orderkey, l_linenumber, coalesce(l_returnflag, (SELECT l_returnflag FROM {_GAPPY_SQL}
                 WHERE l_returnflag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_returnflag,
               l_linestatus, coalesce(l_quantity, (SELECT l_quantity FROM {_GAPPY_SQL}
                 WHERE l_quantity IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_quantity FROM {_GAPPY_SQL}""",
)
def c3(spark, d):
    df = clean.impute_mode(gappy_lineitem(spark, d), ["l_returnflag", "l_linestatus", "l_quantity"])
    return df.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")


_NUMBER_TEXT_SQL = """(SELECT p_partkey, CASE p_partkey % 8
      WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN ' ' || p_size || '.5 ' WHEN 2 THEN p_size || 'd'
      WHEN 3 THEN '-' || p_size || 'e2' WHEN 4 THEN 'NaN' WHEN 5 THEN 'Less than 1 year'
      WHEN 6 THEN '' ELSE '.' || p_size END AS years FROM part)"""


def _number_text(spark, d):
    size = F.col("p_size").cast("string")
    forms = [
        size, F.concat(F.lit(" "), size, F.lit(".5 ")), F.concat(size, F.lit("d")),
        F.concat(F.lit("-"), size, F.lit("e2")), F.lit("NaN"), F.lit("Less than 1 year"), F.lit(""),
    ]
    pick = None
    for i, form in enumerate(forms):
        hit = F.col("p_partkey") % 8 == i
        pick = F.when(hit, form) if pick is None else pick.when(hit, form)
    return table(spark, d, "part").select("p_partkey", pick.otherwise(F.concat(F.lit("."), size)).alias("years"))


@query(
    "C4_coerce_numeric",
    rf"""SELECT p_partkey, years,
                CASE WHEN regexp_matches(trim(years), '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')
                     THEN TRY_CAST(trim(years) AS DOUBLE) END AS "years_Num" FROM {_NUMBER_TEXT_SQL}""",
)
def c4(spark, d):
    return clean.coerce_numeric(_number_text(spark, d), "years")


@query(
    "C5_clip",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN least(greatest(c_acctbal, 0.0), 5000.0) END AS c_acctbal
       FROM customer""",
)
def c5(spark, d):
    gap = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    df = table(spark, d, "customer").select("c_custkey", gap.alias("c_acctbal"))
    return clean.clip_column(df, "c_acctbal", 0.0, 5000.0)


@query(
    "C6_clean_survey",
    f"""{EFFECT_INPUT_SQL}
        SELECT o_orderkey, o_custkey, price, year, done,
               coalesce(status, (SELECT status FROM cleaned WHERE status IS NOT NULL
                                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS status FROM cleaned""",
)
def c6(spark, d):
    return clean.clean_survey(
        effect_input(spark, d), "status", "price", ["status", "RemoteWork"], "year", yes="F", status="done"
    )


@query(
    "C6_clean_survey_gaps",
    """WITH raw AS (SELECT p_partkey, p_brand, CASE WHEN p_size > 10 THEN p_type END AS p_type,
                           p_retailprice, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_size AS DOUBLE) END AS score FROM part),
            kept AS (SELECT * FROM raw WHERE p_retailprice >= (SELECT quantile_cont(p_retailprice, 0.01) FROM raw)
                                         AND p_retailprice <= (SELECT quantile_cont(p_retailprice, 0.99) FROM raw))
       SELECT p_partkey, p_brand, p_retailprice,
              coalesce(p_type, (SELECT p_type FROM kept WHERE p_type IS NOT NULL
                                GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS p_type,
              round(coalesce(score, (SELECT median(score) FROM kept)), 6) AS score,
              CASE WHEN p_type = 'ECONOMY' THEN 'Yes' ELSE 'No' END AS economy FROM kept""",
)
def c6_gaps(spark, d):
    df = table(spark, d, "part").select(
        "p_partkey",
        "p_brand",
        F.when(F.col("p_size") > 10, F.col("p_type")).alias("p_type"),
        "p_retailprice",
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_size").cast("double")).alias("score"),
    )
    out = clean.clean_survey(
        df, "p_type", "p_retailprice", ["p_type", "p_brand"], "score", yes="ECONOMY", status="economy"
    )
    return out.withColumn("score", F.round("score", 6))


@query(
    "C7_scatter_dataset",
    rf"""SELECT p_partkey, years_num AS "years_Num", p_retailprice, p_brand FROM (
           SELECT t.p_partkey, p_retailprice, p_brand,
                  CASE WHEN regexp_matches(trim(years), '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$')
                       THEN TRY_CAST(trim(years) AS DOUBLE) END AS years_num
           FROM {_NUMBER_TEXT_SQL} t JOIN part USING (p_partkey)) WHERE years_num IS NOT NULL
         ORDER BY years_num, p_partkey""",
)
def c7(spark, d):
    df = _number_text(spark, d).join(table(spark, d, "part").drop("p_name"), "p_partkey")
    return clean.scatter_dataset(df, "years", "p_retailprice", "p_brand", key=["p_partkey"])


@query(
    "C7_scatter_bins",
    """SELECT l_returnflag, floor(l_quantity / 5) * 5 AS x_from, floor(l_extendedprice / 1000) * 1000 AS y_from,
              count(*) AS n FROM lineitem GROUP BY ALL""",
)
def c7_bins(spark, d):
    return clean.scatter_bins(table(spark, d, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag", 5, 1000)


@query("D1_range_clean", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 10000 AND o_totalprice < 400000")
def d1(spark, d):
    return clean.range_clean(table(spark, d, "orders"), "o_totalprice", 10_000, 400_000).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "D2_normalise_label",
    """SELECT c_custkey, CASE n_name WHEN 'NATION_3' THEN 'South Korea' WHEN 'NATION_8' THEN 'South Korea'
              ELSE n_name END AS country FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def d2(spark, d):
    return _countries(spark, d).select("c_custkey", "country")


def _countries(spark, d):
    named = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    named = named.withColumnRenamed("n_name", "country")
    return clean.normalise_label(named, "country", {"NATION_3": "South Korea", "NATION_8": "South Korea"})


@query(
    "D3_group_flag",
    """SELECT c_custkey, CASE WHEN n_name IN ('NATION_3', 'NATION_8') THEN 1 ELSE 0 END AS is_korea
       FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def d3(spark, d):
    return clean.group_flag(_countries(spark, d), "country", "South Korea", "is_korea").select("c_custkey", "is_korea")


@query(
    "F4_parse_number",
    r"""SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) AS k FROM events""",
)
def f4(spark, d):
    return table(spark, d, "events").select(
        "event_id", num.parse_number(F.regexp_extract("props", r"([0-9]+)", 1)).alias("k")
    )


@query(
    "C7_scatter_sample",
    """SELECT l_key, l_quantity AS "l_quantity_Num", l_extendedprice, l_returnflag FROM (
         SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY md5('42:scatter:' || l_key), l_key) AS place
         FROM (SELECT l_orderkey * 10 + l_linenumber AS l_key, l_quantity, l_extendedprice, l_returnflag FROM lineitem)) WHERE place <= 200""",
)
def c7_sample(spark, d):
    """Points to draw of each flag, the same on every cluster."""
    keyed = table(spark, d, "lineitem").withColumn("l_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return clean.scatter_sample(keyed, "l_quantity", "l_extendedprice", "l_returnflag", "l_key", 200)
