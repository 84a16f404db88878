import json

import pytest
from pyspark.sql import functions as F

from tabwright.operators import validate as v
from tabwright.operators.validate import COUNTRY, Contract, Field
from tabwright.sources import feeds, files
from tabwright.streaming import landing

SALES = [
    {"region": "제주", "category": "가구", "amount": 2100, "month": "2025-03"},
    {"region": "제주", "category": "도서", "amount": 640, "month": "2025-04"},
    {"region": "", "category": "도서", "amount": 720, "month": "2025-03"},
    {"region": "광주", "category": "도서", "amount": -90, "month": "2025-04"},
    {"region": "강릉", "category": "가구", "amount": 1310, "month": "2025-03"},
    {"region": "  ", "category": "문구", "amount": 55, "month": "2025-06"},
    {"region": "광주", "category": "가구", "amount": 480, "month": "2025-06"},
]


def docs(spark, records):
    rows = [(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, "n long, doc string").select("n", F.parse_json("doc").alias("v"))


def codes(checked, key="n"):
    rows = checked.select(key, F.transform("errors", lambda e: F.concat_ws(":", e["loc"], e["type"])).alias("c"))
    return {r[key]: list(r["c"]) for r in rows.collect()}


@pytest.mark.parametrize(("strip", "valid", "errors"), [(True, 4, 3), (False, 5, 2)])
def test_sales_split(spark, strip, valid, errors):
    good, bad = v.validate_split(docs(spark, SALES), v.sales_contract(strip), "n", variant="v")
    assert (good.count(), bad.count()) == (valid, errors)
    assert good.columns == ["month", "region", "amount", "category"]


def test_error_record_keeps_the_original_row(spark):
    bad = v.validate_split(docs(spark, SALES).select("n", "v"), v.sales_contract(), "n", variant="v")[1]
    row = bad.where("row_key = 3").first()
    assert json.loads(row["row_data"])["v"]["amount"] == -90
    assert [tuple(e) for e in row["errors"]] == [("amount", "greater_than", "Input should be greater than 0", "-90")]


# Values and the code a lenient integer field gives them; None means accepted.
INTEGERS = [
    ("15", None, 15), (" 15 ", None, 15), ("15.0", None, 15), ("15.", "int_parsing", None), ("15.00", None, 15),
    ("1_000", None, 1000), ("1__0", "int_parsing", None), ("_1", "int_parsing", None), ("+15", None, 15),
    ("+ 5", "int_parsing", None), ("1e3", "int_parsing", None), ("", "int_parsing", None), (" ", "int_parsing", None),
    ("15.5", "int_parsing", None), (".0", "int_parsing", None), ("00015", None, 15), ("\t15\n", None, 15),
    ("1_0.0", None, 10), (True, None, 1), (15.0, None, 15), (15.5, "int_from_float", None), (None, "int_type", None),
    ([1], "int_type", None), ({"x": 1}, "int_type", None), (1e3, None, 1000), (1e30, "int_parsing_size", None),
    ("true", "int_parsing", None), ("0x1F", "int_parsing", None), (0, "greater_than", None),
    (False, "greater_than", None), ("-15", "greater_than", None), ("-0", "greater_than", None),
    (10**25, "int_parsing_size", None), ("9" * 25, "int_parsing_size", None),
]


def test_lenient_integers(spark):
    checked = v.check(docs(spark, [{"a": x} for x, _, _ in INTEGERS]), Contract((Field("a", "integer", gt=0),)), "v")
    rows = {r["n"]: r for r in checked.select("n", "record.a", "errors").collect()}
    for i, (given, code, value) in enumerate(INTEGERS):
        got = [e["type"] for e in rows[i]["errors"]]
        assert got == ([code] if code else []), given
        if code is None:
            assert rows[i]["a"] == value, given


NUMBERS = [
    ("1.5", None), (" 1.5 ", None), ("1e1", None), ("nan", "less_than_equal"), ("inf", "less_than_equal"),
    ("1_0", None), (True, None), (None, "float_type"), ("abc", "float_parsing"), (91, "less_than_equal"),
    (-91, "greater_than_equal"), ("", "float_parsing"), ([], "float_type"), ("1.", None), (".5", None), ("0x1", "float_parsing"),
]


def test_lenient_numbers(spark):
    checked = v.check(docs(spark, [{"f": x} for x, _ in NUMBERS]), Contract((Field("f", "number", ge=-90, le=90),)), "v")
    got = codes(checked)
    for i, (given, code) in enumerate(NUMBERS):
        assert got[i] == ([f"f:{code}"] if code else []), given


def test_strings_are_not_coerced(spark):
    contract = Contract((Field("s"), Field("o", required=False, nullable=True)))
    records = [{"s": 1}, {"s": True}, {"s": None}, {"s": []}, {}, {"s": "x"}, {"s": "x", "o": None}, {"s": "x", "o": 1}]
    got = codes(v.check(docs(spark, records), contract, "v"))
    assert [got[i] for i in range(8)] == [["s:string_type"]] * 4 + [["s:missing"], [], [], ["o:string_type"]]


def test_lists_name_the_broken_element(spark):
    contract = Contract((Field("h.t", "list<string>"), Field("h.p", "list<integer>", ge=0, le=100)))
    records = [
        {},
        {"h": {"t": "x", "p": [1, None, 101, "5", -1, 2.5]}},
        {"h": {"t": [1], "p": {}}},
        {"h": {"t": [], "p": []}},
    ]
    got = codes(v.check(docs(spark, records), contract, "v"))
    assert got == {
        0: ["h.t:missing", "h.p:missing"],
        1: ["h.t:list_type", "h.p.1:int_type", "h.p.2:less_than_equal", "h.p.4:greater_than_equal", "h.p.5:int_from_float"],
        2: ["h.t.0:string_type", "h.p:list_type"],
        3: [],
    }


def test_absent_null_and_default(spark):
    records = [{"name": "x"}, {"name": None, "region": None}, {"region": "Europe"}, {"name": {"common": "K"}, "zzz": 1}]
    checked = v.check(docs(spark, records), COUNTRY, "v")
    assert codes(checked) == {0: [], 1: [], 2: ["name:missing"], 3: []}
    assert [r[0] for r in checked.orderBy("n").select("record.region").collect()] == ["Asia", None, "Europe", "Asia"]


def test_column_contract_and_missing_column(spark):
    df = spark.createDataFrame([(1, "a", 3.0), (2, None, 2.5)], "n int, s string, x double")
    contract = Contract((Field("s"), Field("x", "integer"), Field("gone")))
    assert codes(v.check(df, contract)) == {1: ["gone:missing"], 2: ["s:missing", "x:int_from_float", "gone:missing"]}


def test_valid_and_errors_cover_the_input(spark):
    checked = v.check(docs(spark, SALES), v.sales_contract(), "v")
    assert {r["status"]: r["n"] for r in v.validation_summary(checked).collect()} == {"valid": 4, "error": 3}
    assert {tuple(r) for r in v.error_summary(checked).collect()} == {
        ("region", "string_too_short", 2),
        ("amount", "greater_than", 1),
    }


def test_array_all(spark):
    df = spark.createDataFrame([(1, [0, 100]), (2, [0, None]), (3, []), (4, None), (5, [101])], "n int, p array<int>")
    got = df.select("n", v.array_all("p", lambda e: e.between(0, 100)).alias("ok"))
    assert dict(map(tuple, got.collect())) == {1: True, 2: False, 3: True, 4: False, 5: False}


def weather(times, temps, chances, lat=37.5):
    hourly = {"time": times, "temperature_2m": temps, "precipitation_probability": chances}
    return {"latitude": lat, "longitude": 126.9, "hourly": hourly, "extra": 1}


COUNTRY_DOC = [{"name": {"common": "Korea (Republic of)"}, "region": "Asia", "cca2": "KR"}]
IP_DOC = {"query": "8.8.8.8", "status": "success", "country": "United States", "regionName": "Virginia"}


def land(tmp_path, **docs_by_feed):
    paths = {}
    for name, doc in docs_by_feed.items():
        (tmp_path / name).mkdir(parents=True)
        (tmp_path / name / "part.json").write_text(doc if isinstance(doc, str) else json.dumps(doc))
        paths[name] = str(tmp_path / name)
    return paths


def test_feeds_become_one_table(spark, tmp_path):
    paths = land(tmp_path, weather=weather(["a", "b"], [25.1, 25], [100, "7"]), country=COUNTRY_DOC, ip=IP_DOC)
    rows, rejected = feeds.weather_report(feeds.feed_landing_scan(spark, paths))
    assert rejected.count() == 0
    assert sorted(map(tuple, rows.collect())) == [
        (0, "a", 25.1, 100, "Korea (Republic of)", "Virginia"),
        (1, "b", 25.0, 7, "Korea (Republic of)", "Virginia"),
    ]


@pytest.mark.parametrize(
    "change",
    [
        {"ip": {"query": "8.8.8.8"}},
        {"ip": "{broken"},
        {"ip": None},
        {"country": []},
        {"weather": weather(["a"], [1.0, 2.0], [1])},
        {"weather": weather(["a"], [1.0], [101])},
        {"weather": weather(["a"], [1.0], [1], lat=90.5)},
    ],
)
def test_one_bad_feed_holds_back_all(spark, tmp_path, change):
    docs_by_feed = {"weather": weather(["a"], [1.0], [1]), "country": COUNTRY_DOC, "ip": IP_DOC, **change}
    missing = [k for k, d in docs_by_feed.items() if d is None]
    paths = land(tmp_path, **{k: d for k, d in docs_by_feed.items() if d is not None})
    paths.update({k: str(tmp_path / "not-there" / k) for k in missing})
    rows, rejected = feeds.weather_report(feeds.feed_landing_scan(spark, paths))
    assert rows.count() == 0
    assert {r["feed"] for r in rejected.collect()} == set(change)


def test_indented_documents(spark, tmp_path):
    docs_by_feed = {"weather": weather(["a"], [1.0], [1]), "country": COUNTRY_DOC, "ip": IP_DOC}
    paths = land(tmp_path, **{k: json.dumps(d, indent=2) for k, d in docs_by_feed.items()})
    rows, rejected = feeds.weather_report(feeds.feed_landing_scan(spark, paths, whole=True))
    assert (rows.count(), rejected.count()) == (1, 0)


def test_name_as_plain_text(spark, tmp_path):
    paths = land(tmp_path, weather=weather(["a"], [1.0], [1]), country={"name": "Korea"}, ip=IP_DOC)
    rows, _ = feeds.weather_report(feeds.feed_landing_scan(spark, paths))
    assert rows.first()["country_name"] == "Korea"


SCHEMA = "month string, region string, category string, amount string"


def test_safe_load(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    assert files.safe_load(spark, str(tmp_path / "non_existent.json"), schema).count() == 0
    (tmp_path / "good.json").write_text(json.dumps(SALES, ensure_ascii=False, indent=4), encoding="utf-8")
    (tmp_path / "bad.json").write_text(json.dumps(SALES)[:-30])
    assert files.safe_load(spark, str(tmp_path / "good.json"), schema).count() == 7
    assert files.safe_load(spark, str(tmp_path / "bad.json"), schema).count() == 0
    assert files.safe_load(spark, str(tmp_path), schema).count() == 7


def test_safe_load_lines_drops_the_whole_broken_file(spark, tmp_path):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(SCHEMA)
    lines = [json.dumps(r, ensure_ascii=False) for r in SALES]
    (tmp_path / "a.json").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "b.json").write_text("\n".join([*lines, lines[0][:15]]), encoding="utf-8")
    assert files.safe_load(spark, str(tmp_path), schema, lines=True).count() == 7


def test_write_and_verify(spark, tmp_path):
    valid, errors = v.validate_split(docs(spark, SALES), v.sales_contract(), "n", variant="v")
    got = files.write_and_verify(valid, errors, str(tmp_path / "valid"), str(tmp_path / "errors"))
    assert sorted(map(tuple, got.collect())) == [("error", 3, 3, True), ("valid", 4, 4, True)]
    assert any("광주" in p.read_text(encoding="utf-8") for p in (tmp_path / "errors").glob("*.json"))


def test_round_trips_keep_content(spark):
    df = spark.createDataFrame([("a,\"b\"\nc", 1.5, None), ("한글", None, 2)], "s string, x double, n long")
    got = files.multi_format_materialise({"t": df, "u": df.limit(1)})
    assert all(r["same_content"] for r in got.collect()) and got.count() == 4


def test_text_survives_csv(spark, tmp_path):
    texts = [" pad ", "", None, "a\nb", 'q"q', "\ttab", "x,y"]
    df = spark.createDataFrame(list(enumerate(texts)), "n long, s string")
    files.csv_sink(df, str(tmp_path / "c"))
    back = files.csv_scan(spark, str(tmp_path / "c"), df.schema, line_breaks=True)
    assert {r["n"]: r["s"] for r in back.collect()} == dict(enumerate(texts))


def test_columns_named_like_the_steps(spark):
    df = spark.createDataFrame([("x", 1, 2)], "region string, _value0 long, __code0 long")
    checked = v.check(df, Contract((Field("region", min_length=1),)))
    assert checked.columns == ["region", "_value0", "__code0", "record", "errors", "valid"] and checked.first()["valid"]


def test_csv_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "w.csv").write_text("time,t\n2026-07-15T00:00,25.1\n2026-07-15T01:00,\n", encoding="utf-8-sig")
    df = files.csv_scan(spark, str(tmp_path / "w.csv"), "time string, t double")
    assert [tuple(r) for r in df.collect()] == [("2026-07-15T00:00", 25.1), ("2026-07-15T01:00", None)]
    assert files.csv_scan(spark, str(tmp_path / "w.csv")).columns == ["time", "t"]


def test_stream_resumes_without_repeats(spark, tmp_path):
    (tmp_path / "in").mkdir()
    contract = v.sales_contract()

    def run():
        stream = landing.landing_stream(spark, str(tmp_path / "in"))
        sinks = (str(tmp_path / n) for n in ("ok", "bad", "checkpoint"))
        for q in landing.start_validation(stream, contract, *sinks, key="$.month"):
            q.awaitTermination()
        return spark.read.parquet(str(tmp_path / "ok")).count(), spark.read.json(str(tmp_path / "bad")).count()

    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(r) for r in SALES))
    assert run() == (4, 3)
    (tmp_path / "in" / "2.json").write_text("\n".join([json.dumps(SALES[0]), "{broken"]))
    assert run() == (5, 4)


def test_running_totals_of_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(r) for r in SALES))
    stream = landing.landing_stream(spark, str(tmp_path / "in")).select(
        F.try_variant_get("v", "$.region", "string").alias("region"), F.try_variant_get("v", "$.amount", "bigint").alias("amount")
    )
    q = (
        landing.running_totals(stream, "region", "amount")
        .writeStream.format("memory").queryName("totals").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    got = {r["region"]: (r["n"], r["total"]) for r in spark.table("totals").collect()}
    assert got == {"제주": (2, 2740), "광주": (2, 390), "강릉": (1, 1310), "": (1, 720), "  ": (1, 55)}
