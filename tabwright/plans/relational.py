"""Projection, filter, scalar attach, grouping, order and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions import numbers as num
from tabwright.functions.text import is_blank
from tabwright.operators import audit, frequent, groups, numbering, rows
from tabwright.plans.registry import query, table

_ORDERS = "o_orderkey, o_orderstatus, o_totalprice"


@query("P1_project", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def p1(spark, d):
    return rows.project(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])


def _with_gaps(spark, d):
    """orders whose price is NaN for one key in nine and NULL for one in ten."""
    price = F.when(F.col("o_orderkey") % 9 == 0, float("nan")).when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice"))
    return table(spark, d, "orders").withColumn("o_totalprice", price)


_KNOWN = "o_orderkey % 9 <> 0 AND o_orderkey % 10 <> 0"


@query("P2_filter_ge", f"SELECT {_ORDERS} FROM orders WHERE o_totalprice >= 250000 AND {_KNOWN}")
def p2(spark, d):
    return rows.filter_ge(_with_gaps(spark, d), "o_totalprice", 250000).select(*_ORDERS.split(", "))


@query("P2_filter_gt", "SELECT p_partkey, p_size FROM part WHERE p_size > 25")
def p2_gt(spark, d):
    return rows.filter_gt(table(spark, d, "part"), "p_size", 25).select("p_partkey", "p_size")


@query("P3_filter_range", f"SELECT {_ORDERS} FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000")
def p3(spark, d):
    return rows.filter_range(table(spark, d, "orders"), "o_totalprice", 100000, 200000).select(*_ORDERS.split(", "))


@query("P4_filter_group", "SELECT o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def p4(spark, d):
    return rows.filter_group(table(spark, d, "orders"), "o_orderstatus", "F", "o_totalprice")


def gappy_lineitem(spark, d):
    """lineitem with holes: quantity missing (as NaN) on lines 7, return flag missing on lines 5."""
    line = F.col("l_linenumber")
    return table(spark, d, "lineitem").withColumns(
        {
            "l_quantity": F.when(line == 7, F.lit(float("nan"))).otherwise(F.col("l_quantity")),
            "l_returnflag": F.when(line != 5, F.col("l_returnflag")),
        }
    )


@query(
    "P5_drop_missing",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem
       WHERE l_linenumber NOT IN (5, 7)""",
)
def p5(spark, d):
    df = gappy_lineitem(spark, d).withColumn("l_quantity", num.nan_to_null("l_quantity"))
    return rows.drop_missing(df, ["l_quantity", "l_returnflag"]).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query(
    "P6_derive_binary",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 5 AND l_returnflag = 'R'
              THEN 'Yes' ELSE 'No' END AS returned FROM lineitem""",
)
def p6(spark, d):
    return rows.derive_binary(gappy_lineitem(spark, d), "l_returnflag", "R", "returned").select(
        "l_orderkey", "l_linenumber", "returned"
    )


@query(
    "P7_derive_threshold_flag",
    """SELECT o_orderkey, CASE WHEN o_totalprice >=
              (SELECT quantile_cont(o_totalprice, 0.75) FROM orders) THEN 1 ELSE 0 END AS high FROM orders""",
)
def p7(spark, d):
    return rows.derive_threshold_flag(table(spark, d, "orders"), "o_totalprice", 0.75, "high").select(
        "o_orderkey", "high"
    )


@query("P8_drop_columns", "SELECT p_partkey, p_name, p_type, p_size FROM part")
def p8(spark, d):
    return rows.drop_columns(table(spark, d, "part"), ["p_brand", "p_retailprice", "p_comment", "Currency"])


@query("P9_select_numeric", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def p9(spark, d):
    return rows.select_by_type(table(spark, d, "lineitem"), "numeric", 3)


@query("P9_select_categorical", "SELECT c_name, c_mktsegment FROM customer")
def p9_cat(spark, d):
    return rows.select_by_type(table(spark, d, "customer"), "categorical")


@query("P11_rename", "SELECT o_orderkey AS id, o_orderpriority AS priority, o_totalprice AS price FROM orders")
def p11(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rows.rename(df, {"o_orderkey": "id", "o_orderpriority": "priority", "o_totalprice": "price"})


# The symbols of the policy, as in functions/text.py.
_POLICY_SQL = r"""
SELECT *, lowercase AND uppercase AND digit AND symbol AND single_line AS all_rules FROM (
  SELECT doc_id,
         regexp_matches(text, '[a-z]') AS lowercase,
         regexp_matches(text, '[A-Z]') AS uppercase,
         regexp_matches(text, '\p{Nd}') AS digit,
         regexp_matches(text, '[!@#$%^&*()_+\-=\[\]{};:''",.<>/?\\|`~]') AS symbol,
         NOT contains(regexp_replace(text, '\n\z', ''), chr(10)) AS single_line
  FROM documents)
"""


@query(
    "P12_text_policy_audit",
    f"""WITH t AS ({_POLICY_SQL}),
        u AS (UNPIVOT t ON lowercase, uppercase, digit, symbol, single_line, all_rules
              INTO NAME rule VALUE ok)
        SELECT rule, count(*) FILTER (WHERE ok) AS passed, count(*) FILTER (WHERE NOT ok) AS failed
        FROM u GROUP BY rule""",
)
def p12(spark, d):
    return audit.text_policy_audit(table(spark, d, "documents"), "text")


@query("P12_text_policy_verdicts", f"SELECT doc_id, all_rules AS conforms FROM ({_POLICY_SQL})")
def p12_rows(spark, d):
    return audit.text_policy_verdicts(table(spark, d, "documents"), "text").select("doc_id", "conforms")


@query(
    "F6_blank_text",
    """SELECT conv_id, turn, length(trim(text)) AS text_length,
              regexp_full_match(text, '\\s*') AS blank FROM conversations""",
)
def f6(spark, d):
    text = F.col("text")
    return table(spark, d, "conversations").select(
        "conv_id", "turn", F.length(F.trim(text)).cast("bigint").alias("text_length"), is_blank(text).alias("blank")
    )


@query(
    "F7_format",
    """SELECT c_custkey, format('{:,.2f}', c_acctbal) AS money, printf('%.5f', c_acctbal / 1000) AS fixed,
              printf('%.5e', c_acctbal) AS scientific, printf('%.4f%%', c_acctbal / 100) AS percent
       FROM customer""",
)
def f7(spark, d):
    c = F.col("c_acctbal")
    return table(spark, d, "customer").select(
        "c_custkey",
        num.money(c).alias("money"),
        num.fixed(c / 1000, 5).alias("fixed"),
        num.scientific(c, 5).alias("scientific"),
        num.percent(c / 10000, 4).alias("percent"),
    )


@query(
    "F8_one_line",
    """SELECT doc_id, length(replace(text, chr(10), ' ')) AS kept_length,
              md5(replace(text, chr(10), ' ')) AS digest FROM documents""",
)
def f8(spark, d):
    flat = num.one_line("text")
    return table(spark, d, "documents").select(
        "doc_id", F.length(flat).cast("bigint").alias("kept_length"), F.md5(flat).alias("digest")
    )


@query(
    "F2_F3_F10_arithmetic",
    """SELECT l_orderkey, l_linenumber,
              round_even(l_extendedprice / 100, 0) AS hundreds,
              100.0::DOUBLE + l_quantity * 3.5::DOUBLE + l_tax * 1000.0::DOUBLE AS score,
              CASE WHEN l_linenumber = 3 THEN NULL WHEN l_discount = 0 THEN 1.0::DOUBLE ELSE l_tax / l_discount END AS tax_to_discount
       FROM lineitem""",
)
def f2(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        num.round_half_even(F.col("l_extendedprice") / 100).alias("hundreds"),
        num.linear_score(100.0, {"l_quantity": 3.5, "l_tax": 1000.0}).alias("score"),
        num.safe_ratio("l_tax", F.when(F.col("l_linenumber") != 3, F.col("l_discount"))).alias("tax_to_discount"),
    )


@query("F11_stamp", "SELECT r_name, true AS well_formed, true AS recent FROM region")
def f11(spark, d):
    """The stamp itself changes with every run; its form and its age do not."""
    stamped = table(spark, d, "region").select("r_name", num.stamp().alias("generated_at"))
    text = F.col("generated_at").cast("string")
    age = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(text.cast("timestamp")))
    return stamped.select("r_name", text.rlike("^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}").alias("well_formed"), (age < 3600).alias("recent"))


@query(
    "J1_attach_scalar",
    """SELECT n.n_nationkey, n.n_name, r.top_region, r.regions FROM nation n,
              (SELECT max(r_name) AS top_region, count(*) AS regions FROM region) r""",
)
def j1(spark, d):
    one = table(spark, d, "region").agg(F.max("r_name").alias("top_region"), F.count(F.lit(1)).alias("regions"))
    return rows.attach_scalar(table(spark, d, "nation").select("n_nationkey", "n_name"), one)


_SUM = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)"


def _cents(c):
    return groups.exact_money(c)


def _as_double(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query(
    "J2_key_lookup_sum",
    f"""SELECT o.o_custkey, (SELECT {_SUM.format("i.o_totalprice")} FROM orders i WHERE i.o_custkey = o.o_custkey)
               AS total FROM (SELECT DISTINCT o_custkey FROM orders) o""",
)
def j2(spark, d):
    return _as_double(groups.key_lookup_sum(table(spark, d, "orders"), "o_custkey", _cents("o_totalprice")), "total")


@query(
    "A1_sum_by",
    f"SELECT c_mktsegment, {_SUM.format('c_acctbal')} AS total FROM customer GROUP BY c_mktsegment",
)
def a1(spark, d):
    return _as_double(groups.sum_by(table(spark, d, "customer"), "c_mktsegment", _cents("c_acctbal")), "total")


@query("A2_count_by", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def a2(spark, d):
    return groups.count_by(table(spark, d, "events"), "event_type")


@query(
    "A3_frequency_rank",
    "SELECT o_orderpriority, count(*) AS n, min(o_orderkey) AS first_seen FROM orders GROUP BY o_orderpriority ORDER BY n DESC, first_seen",
)
def a3(spark, d):
    return groups.frequency_rank(table(spark, d, "orders"), "o_orderpriority", "o_orderkey")


@query(
    "A3_top_values",
    """SELECT l_partkey, n, row_number() OVER (ORDER BY n DESC, l_partkey)::INTEGER AS place
       FROM (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) QUALIFY place <= 20""",
)
def a3_top(spark, d):
    """The most frequent parts, by a sketch and an exact recount of its candidates."""
    return frequent.top_values(table(spark, d, "lineitem"), "l_partkey", 20)


@query(
    "A4_collect_by",
    """SELECT o_orderpriority, CAST(o_orderkey // 5000 AS BIGINT) AS piece,
              string_agg(CAST(o_custkey AS VARCHAR), ',' ORDER BY o_orderkey) AS custkeys
       FROM orders GROUP BY ALL""",
)
def a4(spark, d):
    listed = groups.collect_by(table(spark, d, "orders"), "o_orderpriority", "o_custkey", "o_orderkey", width=5000)
    keys = F.array_join(F.transform("values", lambda v: v.cast("string")), ",")
    return listed.select("o_orderpriority", "piece", keys.alias("custkeys"))


@query(
    "A5_sum_by_keys_sorted",
    f"""SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus, {_SUM.format("o_totalprice")} AS total
        FROM orders GROUP BY 1, 2 ORDER BY 1, 2""",
)
def a5(spark, d):
    df = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return _as_double(groups.sum_by_keys_sorted(df, ["month", "o_orderstatus"], _cents("o_totalprice")), "total")


@query("A6_distinct_values", "SELECT DISTINCT o_custkey FROM orders")
def a6(spark, d):
    return groups.distinct_values(table(spark, d, "orders"), "o_custkey")


@query(
    "A7_shapes",
    """WITH a AS (SELECT count(*) AS n FROM lineitem),
            b AS (SELECT count(*) AS n FROM lineitem WHERE l_linenumber <> 7),
            c AS (SELECT count(*) AS n FROM lineitem WHERE l_linenumber <> 7 AND l_quantity >= 10)
       SELECT 0 AS step_no, 'read' AS step, a.n AS row_count, 11 AS column_count, 0::BIGINT AS removed FROM a
       UNION ALL SELECT 1, 'present', b.n, 11, a.n - b.n FROM a, b
       UNION ALL SELECT 2, 'large', c.n, 11, b.n - c.n FROM b, c""",
)
def a7(spark, d):
    read = gappy_lineitem(spark, d).withColumn("l_quantity", num.nan_to_null("l_quantity"))
    present = rows.drop_missing(read, ["l_quantity"])
    return groups.shapes({"read": read, "present": present, "large": rows.filter_ge(present, "l_quantity", 10)})


@query(
    "A8_mean_by_group",
    """SELECT l_returnflag, round(avg(CASE WHEN l_linenumber <> 7 THEN l_quantity END), 6) AS mean
       FROM lineitem WHERE l_linenumber <> 5 GROUP BY l_returnflag""",
)
def a8(spark, d):
    df = gappy_lineitem(spark, d).where(F.col("l_returnflag").isNotNull())
    return groups.mean_by_group(df, "l_returnflag", "l_quantity").withColumn("mean", F.round("mean", 6))


@query(
    "A12_mode",
    """SELECT (SELECT l_returnflag FROM lineitem WHERE l_linenumber <> 5
                GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS l_returnflag,
              (SELECT l_linestatus FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS l_linestatus,
              (SELECT l_quantity FROM lineitem WHERE l_linenumber <> 7
                GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS l_quantity""",
)
def a12(spark, d):
    return groups.modes(gappy_lineitem(spark, d), ["l_returnflag", "l_linestatus", "l_quantity"])


@query(
    "O1_sort_asc",
    "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey",
)
def o1(spark, d):
    df = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    return rows.sort_rows(df, ["s_acctbal"], tiebreak=["s_suppkey"])


@query(
    "O2_sort_desc",
    f"""SELECT o_orderkey, CASE WHEN {_KNOWN} THEN o_totalprice END AS o_totalprice FROM orders
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey""",
)
def o2(spark, d):
    df = _with_gaps(spark, d).select("o_orderkey", "o_totalprice")
    ordered = rows.sort_rows(df, ["o_totalprice"], descending=True, tiebreak=["o_orderkey"])
    return ordered.withColumn("o_totalprice", num.nan_to_null("o_totalprice"))


@query(
    "O3_sort_by_key_tuple",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey""",
)
def o3(spark, d):
    keys = ["l_orderkey", "l_linenumber"]
    df = table(spark, d, "lineitem").select(*keys, "l_partkey", "l_suppkey", "l_extendedprice")
    return rows.sort_rows(df, keys, tiebreak=["l_partkey", "l_suppkey"])


@query("O4_head", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 25")
def o4(spark, d):
    return rows.head(table(spark, d, "orders"), 25, ["o_orderkey"])


@query(
    "O5_argmax",
    f"SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0 AND {_KNOWN} ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
)
def o5(spark, d):
    return rows.argmax(_with_gaps(spark, d), "o_totalprice", "o_orderkey").select("o_orderkey", "o_totalprice")


@query(
    "U1_append",
    """SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
       UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""",
)
def u1(spark, d):
    s = table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    c = table(spark, d, "customer").selectExpr("c_acctbal AS balance", "c_name AS name", "c_custkey AS id")
    return rows.append(s, c)


@query(
    "U2_drop_duplicates",
    """SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber,
              CASE WHEN l_linenumber <> 7 THEN l_quantity END AS l_quantity,
              CASE WHEN l_linenumber <> 5 THEN l_returnflag END AS l_returnflag FROM lineitem""",
)
def u2(spark, d):
    df = gappy_lineitem(spark, d).withColumn("l_quantity", num.nan_to_null("l_quantity"))
    df = df.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    return rows.drop_duplicates(rows.append(df, df))


@query(
    "W1_row_position",
    "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS position FROM events",
)
def w1(spark, d):
    return numbering.row_position(table(spark, d, "events").select("event_id"), "event_id")


@query(
    "W1_hashed_key",
    "SELECT event_id, md5(event_id::VARCHAR) AS k, row_number() OVER (ORDER BY md5(event_id::VARCHAR)) - 1 AS position FROM events",
)
def w1_hashed(spark, d):
    events = table(spark, d, "events").select("event_id", F.md5(F.col("event_id").cast("string").cast("binary")).alias("k"))
    return numbering.row_position(events, "k")
