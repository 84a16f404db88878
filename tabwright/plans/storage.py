"""Sources and sinks: every query writes a table to the shared folder and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tabwright.functions.hashing import digest
from tabwright.operators import differences, hypothesis, seen, summary, validate
from tabwright.operators.clean import clean_survey
from tabwright.operators.validate import Contract, Field
from tabwright.plans.registry import query, table
from tabwright.plans.statistics import EFFECT_INPUT_SQL, effect_input, welch_sql
from tabwright.plans.validation import CUSTOMER, customer_input
from tabwright.session import materialise, scratch_path
from tabwright.sources import feeds, files, report
from tabwright.sources.synthetic import AI_SELECT, ED_LEVEL, REMOTE_WORK, synthetic_survey
from tabwright.streaming import landing, totals

_SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"


@query("S1_json_array_scan", "SELECT * FROM supplier")
def s1(spark, d):
    path = scratch_path(spark, "array-json")
    # Each output file holds one JSON array; the key is unique, so no array passes 500 records.
    records = table(spark, d, "supplier").groupBy(F.floor(F.col("s_suppkey") / 500).alias("part")).agg(
        F.to_json(F.collect_list(F.struct("s_suppkey", "s_name", "s_nationkey", "s_acctbal"))).alias("value")
    )
    records.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return files.json_array_scan(spark, path, _SUPPLIER)


@query("S1_json_lines_scan", "SELECT * FROM customer")
def s1_lines(spark, d):
    df = table(spark, d, "customer")
    path = scratch_path(spark, "json-lines")
    df.write.json(path)
    return files.json_array_scan(spark, path, df.schema, lines=True)


_CUSTOMER_TEXT = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
)


@query(
    "S2_safe_load",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer
       WHERE c_mktsegment <> 'BUILDING'""",
)
def s2(spark, d):
    # One folder per segment; a truncated record spoils every file of one of them.
    path = scratch_path(spark, "broken-json")
    record = F.to_json(F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"))
    df = table(spark, d, "customer").select("c_mktsegment", record.alias("value"))
    df.write.partitionBy("c_mktsegment").text(path)
    spoiled = df.where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.col("value"), F.lit("\n"), F.substring("value", 1, 20)).alias("value")
    )
    spoiled.write.mode("overwrite").text(f"{path}/c_mktsegment=BUILDING")
    folders = f"{path}/*"
    return files.safe_load(spark, folders, _CUSTOMER_TEXT, lines=True).select("c_custkey", "c_name", "c_mktsegment")


@query("S2_missing_file", "SELECT r_name, 0::BIGINT AS loaded FROM region")
def s2_missing(spark, d):
    loaded = files.safe_load(spark, scratch_path(spark, "never-written"), _CUSTOMER_TEXT)
    return table(spark, d, "region").select("r_name", loaded.agg(F.count(F.lit(1))).scalar().alias("loaded"))


@query("S3_csv_scan", "SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer")
def s3(spark, d):
    df = table(spark, d, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    )
    path = scratch_path(spark, "csv")
    files.csv_sink(df, path)
    return files.csv_scan(spark, path, df.schema)


@query(
    "S4_csv_sink",
    """SELECT o_orderkey, o_totalprice, o_orderpriority, CASE o_orderkey % 5 WHEN 0 THEN '  ' || o_orderstatus || ' ' WHEN 1 THEN ''
              WHEN 2 THEN 'a "b", c' WHEN 3 THEN NULL ELSE E'one\\ntwo' END AS note FROM orders""",
)
def s4(spark, d):
    """Text with outer blanks, empty and missing text, quotes and line breaks comes back as it was."""
    kind = F.col("o_orderkey") % 5
    note = F.when(kind == 0, F.concat(F.lit("  "), "o_orderstatus", F.lit(" "))).when(kind == 1, "").when(kind == 2, 'a "b", c').when(kind == 4, "one\ntwo")
    df = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", note.alias("note"))
    path = scratch_path(spark, "csv")
    files.csv_sink(df, path)
    return files.csv_scan(spark, path, df.schema, line_breaks=True)


@query("S5_parquet_sink", "SELECT * FROM lineitem")
def s5(spark, d):
    df = table(spark, d, "lineitem")
    path = scratch_path(spark, "parquet")
    files.parquet_sink(df, path)
    return files.parquet_scan(spark, path, df.schema)


@query("S6_parquet_scan", "SELECT l_orderkey, l_shipdate FROM lineitem WHERE l_quantity >= 40")
def s6(spark, d):
    df = files.parquet_scan(spark, f"{d}/lineitem.parquet")
    return df.where(F.col("l_quantity") >= 40).select("l_orderkey", "l_shipdate")


@query(
    "S7_reject_sink",
    """SELECT c_custkey AS row_key, CASE WHEN c_acctbal <= 0 THEN 1 ELSE 0 END +
              CASE WHEN c_custkey % 50 IN (0, 1, 2) THEN 1 ELSE 0 END AS n_errors
       FROM customer WHERE c_acctbal <= 0 OR c_custkey % 50 IN (0, 1, 2)""",
)
def s7(spark, d):
    errors = validate.validate_split(customer_input(spark, d), CUSTOMER, "c_custkey")[1]
    path = scratch_path(spark, "rejects")
    files.reject_sink(errors, path)
    return spark.read.schema(errors.schema).json(path).select("row_key", F.size("errors").alias("n_errors"))


@query(
    "S8_write_and_verify",
    """WITH t AS (SELECT count(*) FILTER (WHERE c_acctbal <= 0 OR c_custkey % 50 IN (0, 1, 2)) AS bad, count(*) AS n FROM customer)
       SELECT 'valid' AS side, n - bad AS expected, n - bad AS reloaded, true AS ok FROM t
       UNION ALL SELECT 'error', bad, bad, true FROM t""",
)
def s8(spark, d):
    valid, errors = validate.validate_split(customer_input(spark, d), CUSTOMER, "c_custkey")
    base = scratch_path(spark, "verify")
    return files.write_and_verify(valid, errors, f"{base}/valid", f"{base}/errors")


@query(
    "S9_multi_format_materialise",
    """SELECT t AS "table", f AS format, n AS row_count, true AS same_content
       FROM (SELECT 'nation' AS t, count(*) AS n FROM nation UNION ALL SELECT 'documents', count(*) FROM documents
             UNION ALL SELECT 'orders', count(*) FROM orders), (SELECT unnest(['csv', 'parquet']) AS f)""",
)
def s9(spark, d):
    return files.multi_format_materialise({t: table(spark, d, t) for t in ("nation", "documents", "orders")})


def _land_feeds(spark, d):
    """events as an hourly feed of many stations, each document with parallel lists."""
    base = scratch_path(spark, "feeds")
    reading = F.col("event_id")
    hour = F.struct(reading.alias("at"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), "value")
    station = (
        table(spark, d, "events")
        # At most 24 readings per document, however many a user has.
        .groupBy(F.floor(reading / 24).alias("station"))
        .agg(F.sort_array(F.collect_list(hour)).alias("h"))
    )
    doc = F.struct(
        F.lit(37.5).alias("latitude"),
        F.lit(126.9).alias("longitude"),
        F.struct(
            F.col("h.time").alias("time"),
            F.col("h.value").alias("temperature_2m"),
            F.transform("h", lambda x: (x["at"] % 101).cast("int")).alias("precipitation_probability"),
        ).alias("hourly"),
    )
    station.select(F.to_json(doc).alias("value")).write.text(f"{base}/weather")
    top = table(spark, d, "nation").agg(F.max("n_name").alias("n"))
    country = F.to_json(F.array(F.struct(F.struct(F.col("n").alias("common")).alias("name"), F.lit(1).alias("area"))))
    top.select(country.alias("value")).write.text(f"{base}/country")
    area = table(spark, d, "region").agg(F.max("r_name").alias("r"))
    ip = F.struct(
        F.lit("8.8.8.8").alias("query"), F.lit("success").alias("status"), F.lit("X").alias("country"),
        F.col("r").alias("regionName"),
    )
    area.select(F.to_json(ip).alias("value")).write.text(f"{base}/ip")
    return {name: f"{base}/{name}" for name in ("weather", "country", "ip")}


@query(
    "S10_feed_landing",
    """SELECT event_id % 24 AS position, strftime(ts, '%Y-%m-%dT%H:%M') AS time, value AS temperature_2m,
              event_id % 101 AS precipitation_probability, (SELECT max(n_name) FROM nation) AS country_name,
              (SELECT max(r_name) FROM region) AS ip_region
       FROM events""",
)
def s10(spark, d):
    landed = feeds.feed_landing_scan(spark, _land_feeds(spark, d))
    return feeds.weather_report(landed)[0].withColumn("position", F.col("position").cast("bigint"))


@query(
    "S10_feed_missing",
    """SELECT 'ip' AS feed, 'missing' AS type, 4::BIGINT AS n, (SELECT count(*) FROM events WHERE false) AS rows_passed""",
)
def s10_missing(spark, d):
    paths = _land_feeds(spark, d)
    paths["ip"] = paths["ip"] + "-not-landed"
    passed, rejected = feeds.weather_report(feeds.feed_landing_scan(spark, paths))
    codes = rejected.select("feed", F.explode("errors").alias("e")).groupBy("feed", F.col("e.type").alias("type"))
    n = passed.agg(F.count(F.lit(1))).scalar()
    return codes.agg(F.count(F.lit(1)).alias("n")).withColumn("rows_passed", n)


@query(
    "S9_feed_tables",
    """SELECT t AS "table", f AS format, n AS row_count, true AS same_content
       FROM (SELECT 'weather' AS t, count(*) AS n FROM events UNION ALL SELECT 'country', least(count(*), 1) FROM nation
             UNION ALL SELECT 'ip', least(count(*), 1) FROM region), (SELECT unnest(['csv', 'parquet']) AS f)""",
)
def s9_feeds(spark, d):
    """The feed job's own tables, stored in both formats and read back."""
    return files.multi_format_materialise(feeds.feed_tables(feeds.feed_landing_scan(spark, _land_feeds(spark, d))))


_STREAM_SQL = """SELECT event_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
              CASE WHEN event_id % 7 = 0 THEN 'missing' END AS error FROM events"""


@query("S10_landing_stream", _STREAM_SQL)
def s10_stream(spark, d):
    return _streamed(spark, table(spark, d, "events"), landings=1)


@query("S10_stream_restart", _STREAM_SQL)
def s10_restart(spark, d):
    """Three landings, each followed by a new start with the same checkpoint: every record once."""
    return _streamed(spark, table(spark, d, "events"), landings=3)


def _streamed(spark, events, landings):
    base = scratch_path(spark, "stream")
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    record = F.to_json(F.struct(F.col("event_id").alias("id"), "event_type", value.alias("value")))
    contract = Contract((Field("id", "integer"), Field("event_type", min_length=1), Field("value", "number")))
    for k in range(landings):
        landed = events.where(F.pmod("event_id", F.lit(landings)) == k)
        landed.select(record.alias("value")).write.mode("append").text(f"{base}/landing")
        stream = landing.landing_stream(spark, f"{base}/landing")
        for q in landing.start_validation(stream, contract, f"{base}/valid", f"{base}/errors", f"{base}/checkpoint"):
            q.awaitTermination()
    valid = spark.read.schema("id bigint, event_type string, value double").parquet(f"{base}/valid")
    errors = spark.read.schema(
        f"row_key string, row_data string, errors array<{validate.ERROR_TYPE}>"
    ).json(f"{base}/errors")
    good = valid.select(
        F.col("id").alias("event_id"), "event_type", "value", F.lit(None).cast("string").alias("error")
    )
    bad = errors.select(
        F.col("row_key").cast("bigint").alias("event_id"),
        F.get_json_object("row_data", "$.event_type").alias("event_type"),
        F.lit(None).cast("double").alias("value"),
        F.col("errors")[0]["type"].alias("error"),
    )
    return good.unionByName(bad)


@query(
    "A1_stream_totals",
    """SELECT date_trunc('day', ts)::TIMESTAMP AS period, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""",
)
def a1_stream(spark, d):
    """Totals a day and type over three landings with a restart between: a part of each landing's last day comes with the next."""
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    base = scratch_path(spark, "totals")
    day = F.dayofmonth("ts")
    late = (day % 10 == 0) & (F.col("event_id") % 5 == 0)
    landing_of = F.least(F.floor((day - 1) / 10) + F.when(late, 1).otherwise(0), F.lit(2))
    for k in range(3):
        events.where(landing_of == k).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
        totals.start_totals(totals.period_totals(stream, "ts", ["event_type"], "value", "1 day", "1 day"), f"{base}/totals", f"{base}/checkpoint").awaitTermination()
    found = totals.read_totals(spark, f"{base}/totals", ["event_type"])
    return found.select(F.col("period").cast("timestamp_ntz").alias("period"), "event_type", "n", F.round("total", 4).alias("total"))


@query(
    "S8_differing_rows",
    """WITH t AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42:change:' || o_orderkey)) AS k FROM orders)
       SELECT o_orderkey, CASE WHEN k <= 5 THEN 'removed' ELSE 'changed' END AS status,
              CASE WHEN k <= 5 THEN NULL WHEN k <= 12 THEN 'o_totalprice' ELSE 'o_orderstatus' END AS columns
       FROM t WHERE k <= 15 UNION ALL SELECT -o_orderkey, 'added', NULL FROM t WHERE k BETWEEN 16 AND 20""",
)
def s8_differing(spark, d):
    """Twenty planted changes in a table that is written and read back: five keys gone, five new, ten with another value."""
    orders = table(spark, d, "orders")
    chosen = orders.select("o_orderkey", digest("o_orderkey", 42, "change").alias("m")).orderBy("m").limit(20)
    planted = chosen.withColumn("k", F.row_number().over(Window.orderBy("m"))).drop("m")  # twenty rows
    marked = orders.join(F.broadcast(planted), "o_orderkey", "left")
    k = F.col("k")
    changed = marked.where(k.isNull() | (k > 5)).withColumns(
        {
            "o_totalprice": F.when(k.between(6, 12), F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(k.between(13, 15), "?").otherwise(F.col("o_orderstatus")),
        }
    ).select(*orders.columns)
    new = orders.join(F.broadcast(planted.where("k > 15").select("o_orderkey")), "o_orderkey").withColumn("o_orderkey", -F.col("o_orderkey"))
    path = scratch_path(spark, "changed")
    files.parquet_sink(changed.unionByName(new), path)
    found = differences.differing_rows(orders, files.parquet_scan(spark, path, orders.schema), ["o_orderkey"])
    return found.select("o_orderkey", "status", F.array_join("columns", ",").alias("columns"))


@query("U2_repeats_across_landings", "SELECT DISTINCT l_partkey, l_returnflag, CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS line FROM lineitem")
def u2_landings(spark, d):
    """Three landings whose rows repeat within and across them; a fourth repeats the first."""
    items = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("line"))
    kept = seen.SeenRows(spark, scratch_path(spark, "seen"))
    for k in (0, 1, 2, 0):
        kept.add(f"landing-{k}", items.where(F.pmod("l_orderkey", F.lit(3)) == k).drop("l_orderkey"))
    return kept.rows()


def _u(name: str) -> str:
    head = f"'0x' || substr(md5('42:{name}:' || o_orderkey), 1, 12)"
    return f"(CAST(CAST({head} AS BIGINT) AS DOUBLE) / 281474976710656.0::DOUBLE)"


def _z(name: str) -> str:
    return f"(sqrt(-2 * ln(1 - {_u(name + '/r')})) * cos(2 * pi() * {_u(name + '/a')}))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SURVEY_SQL = f"""
WITH drawn AS (
  SELECT o_orderkey,
         CASE WHEN {_u("ai")} < 0.55 THEN {_quoted(AI_SELECT[0])} WHEN {_u("ai")} < 0.55::DOUBLE + 0.35::DOUBLE
              THEN {_quoted(AI_SELECT[1])} ELSE {_quoted(AI_SELECT[2])} END AS ai,
         CASE WHEN {_u("remote")} < 0.5 THEN {_quoted(REMOTE_WORK[0])} WHEN {_u("remote")} < 0.7
              THEN {_quoted(REMOTE_WORK[1])} ELSE {_quoted(REMOTE_WORK[2])} END AS remote,
         CASE WHEN {_u("ed")} < 1.0::DOUBLE / 3 THEN {_quoted(ED_LEVEL[0])} WHEN {_u("ed")} < 2.0::DOUBLE / 3
              THEN {_quoted(ED_LEVEL[1])} ELSE {_quoted(ED_LEVEL[2])} END AS ed,
         least(greatest(7 + {_z("years")} * 4, 1), 35) AS years,
         {_z("pay")} * 15000 AS pay, {_z("score")} * 1.8 AS score, {_u("blank")} < 0.08 AS blank
  FROM orders),
rows_ AS (
  SELECT o_orderkey, ai AS "AISelect", remote AS "RemoteWork", ed AS "EdLevel", round(years, 6) AS "YearsCodePro",
         CASE WHEN NOT blank THEN round(least(greatest(55000 + years * 3500 + CASE WHEN ai = 'Yes' THEN 16000 ELSE 0 END
              + pay, 25000), 300000), 4) END AS "ConvertedCompYearly",
         least(greatest(round_even(6.2 + score + CASE WHEN ai = 'Yes' THEN 1.3 ELSE 0 END, 0), 1), 10) AS "JobSat"
  FROM drawn)
SELECT * FROM rows_ UNION ALL (SELECT * FROM rows_ ORDER BY o_orderkey LIMIT 25)"""


@query("S12_synthetic_survey", SURVEY_SQL)
def s12(spark, d):
    survey = synthetic_survey(table(spark, d, "orders"), "o_orderkey")
    return survey.withColumns(
        {"YearsCodePro": F.round("YearsCodePro", 6), "ConvertedCompYearly": F.round("ConvertedCompYearly", 4)}
    )


def _report_part(section: str, metric: str, group: str, value: str, text: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"""SELECT '{section}' AS section, '{metric}' AS metric, {group} AS "group",
                      CAST({value} AS DOUBLE) AS value_double, {text} AS value_string"""


_LOAD_SQL = """(SELECT 'read' AS step, 2 * (SELECT count(*) FROM orders) AS n, 5 AS w
                UNION ALL SELECT 'cleaned', (SELECT count(*) FROM cleaned), 6)"""
_REPORT_PARTS = [
    _report_part("load", "row_count", "step", "n") + f" FROM {_LOAD_SQL}",
    _report_part("load", "column_count", "step", "w") + f" FROM {_LOAD_SQL}",
    _report_part("load", "removed", "step", "max(n) OVER () - n") + f" FROM {_LOAD_SQL}",
]
for _m in ("price", "year"):
    _REPORT_PARTS += [
        _report_part("statistics", metric, f"'{_m}'", f"round({value.format(_m)}, 6)") + " FROM cleaned"
        for metric, value in {
            "mean": "avg({})", "std": "stddev_samp({})", "q25": "quantile_cont({}, 0.25)",
            "q50": "quantile_cont({}, 0.5)", "q75": "quantile_cont({}, 0.75)",
        }.items()
    ]
    _REPORT_PARTS += [
        _report_part("correlation", "r", f"'{_m} ~ {_other}'", f"round(corr({_m}, {_other}), 6)") + " FROM cleaned"
        for _other in ("price", "year")
    ]
    _REPORT_PARTS += [
        _report_part("tests", metric, "measure", value, text) + f" FROM tests WHERE measure = '{_m}'"
        for metric, value, text in (
            ("mean_a", "mean_a", "format('{:,.2f}', mean_a)"),
            ("mean_b", "mean_b", "format('{:,.2f}', mean_b)"),
            ("t", "t", "printf('%.4f', t)"),
            ("p", "p", "CAST(NULL AS VARCHAR)"),
            ("verdict", "NULL", "CASE WHEN p < 0.05 THEN CASE WHEN t > 0 THEN 'higher' ELSE 'lower' END ELSE 'not_significant' END"),
        )
    ]


@query(
    "S13_report_metrics",
    f"""{EFFECT_INPUT_SQL}, tests AS ({welch_sql("cleaned", "done", "Yes", "No", "price")}
          UNION ALL {welch_sql("cleaned", "done", "Yes", "No", "year")})
        {" UNION ALL ".join(_REPORT_PARTS)}""",
)
def s13(spark, d):
    raw = effect_input(spark, d)
    cleaned = materialise(clean_survey(raw, "status", "price", ["status"], "year", yes="F", status="done"), "cleaned")
    out = report.report_metrics(
        {"read": raw, "cleaned": cleaned},
        summary.describe(cleaned, ["price", "year"]),
        hypothesis.interpret_test(hypothesis.welch_t_test(cleaned, "done", ["price", "year"], "Yes", "No")),
        corr=summary.corr_matrix(cleaned, ["price", "year"]),
    )
    # The twin integrates p to six digits, too few for its printed form.
    text = F.when(F.col("metric") != "p", F.col("value_string"))
    return out.withColumn("value_double", F.round("value_double", 6)).withColumn("value_string", text)
