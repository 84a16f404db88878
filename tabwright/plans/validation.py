"""Nested values, record contracts and the gate over several feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions import variants
from tabwright.operators import numbering, validate
from tabwright.operators.validate import Contract, Field
from tabwright.plans.registry import query, table
from tabwright.session import scratch_path
from tabwright.sources.publish import Publication


def _payload(spark, d):
    """events.props as a variant: one in four wrapped in a list, key names and nulls varied."""
    key = F.col("event_id")
    region = F.when(key % 4 == 1, ', "region": null').when(key % 4 == 2, ', "region": "Europe"').otherwise("")
    name = (
        F.when(key % 3 == 0, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .when(key % 3 == 1, F.concat(F.lit('{"common": "'), "event_type", F.lit('"}')))
        .otherwise(F.lit('{"official": "x"}'))
    )
    doc = F.concat(F.regexp_replace("props", r"\}\s*$", ""), F.lit(', "name": '), name, region, F.lit("}"))
    wrapped = F.when(key % 5 == 0, F.concat(F.lit("["), doc, F.lit(', {"k": -1}]'))).otherwise(doc)
    return table(spark, d, "events").select("event_id", "event_type", F.try_parse_json(wrapped).alias("v"))


@query("N1_project_struct", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def n1(spark, d):
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"))


@query(
    "N2_zip_arrays_to_rows",
    """SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, i AS step, CAST(embedding[i] AS DOUBLE) AS x
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
)
def n2(spark, d):
    df = table(spark, d, "embeddings").select(
        "vec_id",
        F.transform("embedding", lambda x: x.cast("double")).alias("xs"),
        F.sequence(F.lit(1).cast("bigint"), F.size("embedding").cast("bigint")).alias("steps"),
    )
    return validate.zip_arrays_to_rows(df, {"step": "steps", "x": "xs"}, keep=["vec_id"])


@query(
    "N2_unequal_lengths",
    """SELECT vec_id, 'unequal_length' AS type, concat(len(embedding) - 1, ', ', len(embedding)) AS input
       FROM embeddings WHERE vec_id % 9 = 0""",
)
def n2_lengths(spark, d):
    short = F.when(F.col("vec_id") % 9 == 0, F.slice("embedding", 1, F.size("embedding") - 1)).otherwise(F.col("embedding"))
    df = table(spark, d, "embeddings").select("vec_id", short.alias("a"), F.col("embedding").alias("b"))
    contract = Contract((Field("a", "list<number>"), Field("b", "list<number>")), same_length=("a", "b"))
    errors = validate.error_rows(validate.check(df, contract), "vec_id")
    return errors.select(F.col("row_key").alias("vec_id"), F.explode("errors").alias("e")).select(
        "vec_id", "e.type", "e.input"
    )


@query(
    "N3_array_all",
    """SELECT vec_id, coalesce((SELECT bool_and(coalesce(x BETWEEN -0.25 AND 0.25, false)) FROM unnest(e) t(x)), true) AS ok
       FROM (SELECT vec_id, CASE WHEN vec_id % 20 = 0 THEN list_append(embedding, NULL)
                                 WHEN vec_id % 20 = 1 THEN [] ELSE embedding END AS e FROM embeddings)""",
)
def n3(spark, d):
    key = F.col("vec_id") % 20
    e = (
        F.when(key == 0, F.array_append("embedding", F.lit(None)))
        .when(key == 1, F.array().cast("array<float>"))
        .otherwise(F.col("embedding"))
    )
    df = table(spark, d, "embeddings").select("vec_id", e.alias("e"))
    return df.select("vec_id", validate.array_all("e", lambda x: x.between(-0.25, 0.25)).alias("ok"))


@query(
    "N4_scalar_bounds",
    """SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN coalesce(value BETWEEN 0 AND 90, false) ELSE false END AS ok
       FROM events""",
)
def n4(spark, d):
    gap = F.when(F.col("event_id") % 11 != 0, F.col("value"))
    return table(spark, d, "events").select("event_id", validate.within(gap, 0, 90).alias("ok"))


@query(
    "N5_string_or_object",
    """SELECT event_id, CASE event_id % 3 WHEN 2 THEN 'Korea' ELSE event_type END AS name FROM events""",
)
def n5(spark, d):
    v = variants.unwrap_first(F.col("v"))
    return _payload(spark, d).select(
        "event_id", variants.string_or_object(v, "$.name", "common", "Korea").alias("name")
    )


@query("N6_unwrap_first", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def n6(spark, d):
    v = variants.unwrap_first(F.col("v"))
    return _payload(spark, d).select("event_id", F.try_variant_get(v, "$.k", "bigint").alias("k"))


@query(
    "N7_default_when_absent",
    """SELECT event_id, CASE event_id % 4 WHEN 1 THEN NULL WHEN 2 THEN 'Europe' ELSE 'Asia' END AS region,
              event_id % 4 = 1 AS explicit_null FROM events""",
)
def n7(spark, d):
    v = variants.unwrap_first(F.col("v"))
    return _payload(spark, d).select(
        "event_id",
        variants.default_when_absent(v, "$.region", "Asia").alias("region"),
        variants.is_explicit_null(v, "$.region").alias("explicit_null"),
    )


@query(
    "N8_ignore_extra_fields",
    "SELECT c_custkey, c_mktsegment FROM customer",
)
def n8(spark, d):
    contract = Contract((Field("c_custkey", "integer"), Field("c_mktsegment")))
    return validate.valid_rows(validate.check(table(spark, d, "customer"), contract))


@query(
    "N9_required_field",
    """SELECT event_id, CASE event_id % 4 WHEN 1 THEN 'string_type' ELSE 'missing' END AS type
       FROM events WHERE event_id % 4 <> 2""",
)
def n9(spark, d):
    df = _payload(spark, d).withColumn("v", variants.unwrap_first(F.col("v")))
    checked = validate.check(df, Contract((Field("region"),)), variant="v")
    return checked.select("event_id", F.explode("errors").alias("e")).select("event_id", "e.type")


@query("F9_member_or", "SELECT event_id, CASE event_id % 4 WHEN 2 THEN 'Europe' ELSE 'none' END AS region FROM events")
def f9(spark, d):
    v = variants.unwrap_first(F.col("v"))
    return _payload(spark, d).select("event_id", variants.member_or(v, "$.region", "none").alias("region"))


CUSTOMER = Contract(
    (
        Field("c_custkey", "integer", ge=0),
        Field("c_mktsegment", min_length=1),
        Field("c_acctbal", "number", gt=0),
        Field("c_name", required=False),
    )
)

_CUSTOMER_SQL = """(SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE c_custkey % 50 WHEN 0 THEN '   ' WHEN 1 THEN ''
                           WHEN 2 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer)"""
_CUSTOMER_ERRORS_SQL = f"""(
    SELECT c_custkey, 'c_mktsegment' AS loc, CASE WHEN c_mktsegment IS NULL THEN 'missing' ELSE 'string_too_short' END AS type,
           1 AS place FROM {_CUSTOMER_SQL} WHERE c_mktsegment IS NULL OR trim(c_mktsegment) = ''
    UNION ALL SELECT c_custkey, 'c_acctbal', 'greater_than', 2 FROM {_CUSTOMER_SQL} WHERE c_acctbal <= 0)"""


def customer_input(spark, d):
    key = F.col("c_custkey") % 50
    segment = F.when(key == 0, "   ").when(key == 1, "").when(key != 2, F.col("c_mktsegment"))
    return table(spark, d, "customer").withColumn("c_mktsegment", segment)


def _customer_checked(spark, d):
    return validate.check(customer_input(spark, d), CUSTOMER)


@query(
    "V1_valid",
    f"""SELECT c_custkey, c_mktsegment, c_acctbal, c_name FROM {_CUSTOMER_SQL}
        WHERE c_custkey NOT IN (SELECT c_custkey FROM {_CUSTOMER_ERRORS_SQL})""",
)
def v1(spark, d):
    return validate.validate_split(customer_input(spark, d), CUSTOMER, "c_custkey")[0]


@query(
    "V1_errors",
    f"""SELECT c_custkey AS row_key, count(*) AS n_errors, string_agg(loc || ':' || type, ';' ORDER BY place) AS codes
        FROM {_CUSTOMER_ERRORS_SQL} GROUP BY c_custkey""",
)
def v1_errors(spark, d):
    errors = validate.validate_split(customer_input(spark, d), CUSTOMER, "c_custkey")[1]
    codes = F.transform("errors", lambda e: F.concat(e["loc"], F.lit(":"), e["type"]))
    return errors.select(
        "row_key", F.size("errors").cast("bigint").alias("n_errors"), F.array_join(codes, ";").alias("codes")
    )


@query(
    "V2_contract_rules",
    f"""SELECT loc, type, CASE type WHEN 'missing' THEN 'Field required' WHEN 'greater_than'
               THEN 'Input should be greater than 0' ELSE 'String should have at least 1 character' END AS msg,
               count(*) AS n FROM {_CUSTOMER_ERRORS_SQL} GROUP BY ALL""",
)
def v2(spark, d):
    errors = _customer_checked(spark, d).select(F.explode("errors").alias("e")).select("e.*")
    return errors.groupBy("loc", "type", "msg").agg(F.count(F.lit(1)).alias("n"))


@query(
    "V2_without_strip",
    f"""SELECT count(*) FILTER (WHERE c_mktsegment <> '') AS accepted,
               count(*) FILTER (WHERE c_mktsegment IS NULL OR c_mktsegment = '') AS refused FROM {_CUSTOMER_SQL}""",
)
def v2_plain(spark, d):
    contract = Contract((Field("c_mktsegment", min_length=1, strip=False),))
    checked = validate.check(customer_input(spark, d), contract)
    return checked.agg(
        F.count_if(validate.is_valid()).alias("accepted"), F.count_if(~validate.is_valid()).alias("refused")
    )


@query(
    "V3_lax_int_coercion",
    """SELECT p_partkey, given,
              CASE WHEN form IN (0, 1, 2, 4) THEN CAST(p_size AS BIGINT) WHEN form = 6 THEN CAST(p_size AS BIGINT) * 1000 END AS value,
              CASE WHEN form IN (3, 5, 7) THEN 'int_parsing' END AS code
       FROM (SELECT p_partkey, p_size, p_partkey % 8 AS form, CASE p_partkey % 8
               WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN ' ' || p_size || ' ' WHEN 2 THEN p_size || '.0'
               WHEN 3 THEN p_size || '.5' WHEN 4 THEN '+' || p_size WHEN 5 THEN 'size ' || p_size
               WHEN 6 THEN p_size || '_000' ELSE '' END AS given FROM part)""",
)
def v3(spark, d):
    size, form = F.col("p_size").cast("string"), F.col("p_partkey") % 8
    given = (
        F.when(form == 0, size)
        .when(form == 1, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(form == 2, F.concat(size, F.lit(".0")))
        .when(form == 3, F.concat(size, F.lit(".5")))
        .when(form == 4, F.concat(F.lit("+"), size))
        .when(form == 5, F.concat(F.lit("size "), size))
        .when(form == 6, F.concat(size, F.lit("_000")))
        .otherwise("")
    )
    df = table(spark, d, "part").select("p_partkey", given.alias("given"))
    return df.withColumn("r", validate.lax_integer(F.lit("STRING"), F.col("given"))).select(
        "p_partkey", "given", "r.value", "r.code"
    )


@query(
    "V4_error_record",
    f"""SELECT c_custkey AS row_key, c_name AS given_name, c_acctbal AS given_balance, type AS first_type
        FROM {_CUSTOMER_SQL} JOIN (SELECT c_custkey, min_by(type, place) AS type FROM {_CUSTOMER_ERRORS_SQL} GROUP BY 1)
             USING (c_custkey)""",
)
def v4(spark, d):
    errors = validate.error_rows(_customer_checked(spark, d), "c_custkey")
    given = F.from_json("row_data", "c_name string, c_acctbal double")
    return errors.select(
        "row_key",
        given["c_name"].alias("given_name"),
        given["c_acctbal"].alias("given_balance"),
        F.col("errors")[0]["type"].alias("first_type"),
    )


@query(
    "V4_row_index",
    f"""WITH placed AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS position FROM customer)
        SELECT position AS row_key, type AS first_type
        FROM placed JOIN (SELECT c_custkey, min_by(type, place) AS type FROM {_CUSTOMER_ERRORS_SQL} GROUP BY 1) USING (c_custkey)""",
)
def v4_row_index(spark, d):
    """Rejects keyed by their place in the file, which the scan itself knows."""
    placed = numbering.file_position(customer_input(spark, d), "position")
    errors = validate.error_rows(validate.check(placed, CUSTOMER), "position")
    return errors.select("row_key", F.col("errors")[0]["type"].alias("first_type"))


def _two_feeds(spark, d, planted):
    labels = table(spark, d, "labels")
    if planted:
        # One bad record at the smallest key is enough to hold back both feeds.
        first = labels.agg(F.min("doc_id")).scalar()
        labels = labels.withColumn("quality", F.when(F.col("doc_id") != first, F.col("quality")))
    return {
        "labels": validate.check(labels, Contract((Field("doc_id", "integer"), Field("quality", "integer", ge=0, le=1)))),
        "events": validate.check(
            table(spark, d, "events"), Contract((Field("event_id", "integer"), Field("event_type", min_length=1)))
        ),
    }


def _gate_counts(feeds):
    passed, rejected = validate.all_or_nothing(feeds)
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("feed"), "n") for name, df in passed.items()
    ]
    rejects = rejected.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rejected").alias("feed"), "n")
    return counts[0].unionByName(counts[1]).unionByName(rejects)


@query("V5_gate_closed", "SELECT unnest(['labels', 'events', 'rejected']) AS feed, unnest([0, 0, 1]::BIGINT[]) AS n FROM range(1)")
def v5(spark, d):
    return _gate_counts(_two_feeds(spark, d, planted=True))


@query(
    "V5_gate_open",
    """SELECT 'labels' AS feed, count(*) AS n FROM labels UNION ALL SELECT 'events', count(*) FROM events
       UNION ALL SELECT 'rejected', 0""",
)
def v5_open(spark, d):
    return _gate_counts(_two_feeds(spark, d, planted=False))


@query(
    "V5_published_together",
    """WITH r AS (SELECT min(doc_id) % 4 AS r FROM labels)
       SELECT 'labels' AS "table", count(*) AS n, 2::BIGINT AS batches FROM labels, r WHERE doc_id % 4 <> r
       UNION ALL SELECT 'events', count(*), 2 FROM events, r WHERE event_id % 4 <> r UNION ALL SELECT 'rejected', 1, 1""",
)
def v5_published(spark, d):
    """Four batches of two tables: one fails its check, one is killed between its tables and run again, one comes twice."""
    shelf = Publication(spark, scratch_path(spark, "published"))

    def batch(name, where, planted=False):
        feeds = _two_feeds(spark, d, planted)
        return name, {"labels": feeds["labels"].where(where("doc_id")), "events": feeds["events"].where(where("event_id"))}

    def killed(table_name):
        raise InterruptedError(table_name)

    start = table(spark, d, "labels").agg(F.min("doc_id")).first()[0]  # the key of the planted record
    first = batch("first", lambda key: F.pmod(F.col(key) - start, F.lit(4)) == 2)
    shelf.publish_checked(*first)
    shelf.publish_checked(*batch("bad", lambda key: F.pmod(F.col(key) - start, F.lit(4)) == 0, planted=True))
    third = batch("third", lambda key: F.pmod(F.col(key) - start, F.lit(2)) == 1)
    try:
        shelf.publish_checked(*third, written=killed)
    except InterruptedError:
        pass
    shelf.publish_checked(*third)
    shelf.publish_checked(*first)
    counts = [shelf.read(t).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("batch").alias("batches")).select(F.lit(t).alias("table"), "n", "batches") for t in ("labels", "events", "rejected")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "V6_validation_summary",
    f"""WITH bad AS (SELECT DISTINCT c_custkey FROM {_CUSTOMER_ERRORS_SQL})
        SELECT 'valid' AS status, (SELECT count(*) FROM customer) - count(*) AS n FROM bad
        UNION ALL SELECT 'error', count(*) FROM bad""",
)
def v6(spark, d):
    return validate.validation_summary(_customer_checked(spark, d))


@query("V6_error_summary", f"SELECT loc, type, count(*) AS n FROM {_CUSTOMER_ERRORS_SQL} GROUP BY ALL")
def v6_errors(spark, d):
    return validate.error_summary(_customer_checked(spark, d))
