"""Record contracts: every row is kept as a valid record or as an explained reject.

A contract turns a row into an array of errors with plain column expressions, so a
check is one narrow pass without shuffle, and works on batches and streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numbers import NUMBER_PATTERN, INFINITY_PATTERN
from tabwright.functions.variants import kind_of, part

def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated a single time per row, however often they are used.

    The optimizer copies projected expressions into a filter above them and into every
    place that uses them. ``inline`` of one struct is a boundary it does not cross.
    """
    cells = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(cells)))


ERROR_TYPE = "struct<loc:string,type:string,msg:string,input:string>"

# Error codes and messages a rejected record carries.
MESSAGES = {
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "int_type": "Input should be a valid integer",
    "int_parsing": "Input should be a valid integer, unable to parse string as an integer",
    "int_from_float": "Input should be a valid integer, got a number with a fractional part",
    "int_parsing_size": "Unable to parse input string as an integer, exceeded maximum size",
    "finite_number": "Input should be a finite number",
    "float_type": "Input should be a valid number",
    "float_parsing": "Input should be a valid number, unable to parse string as a number",
    "list_type": "Input should be a valid list",
    "string_too_short": "String should have at least {} character",
    "greater_than": "Input should be greater than {}",
    "greater_than_equal": "Input should be greater than or equal to {}",
    "less_than": "Input should be less than {}",
    "less_than_equal": "Input should be less than or equal to {}",
    "unequal_length": "Lists should have equal lengths: {}",
}

# Text a lenient integer accepts, single underscores and zero decimals included.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*(\.0+)?\s*$"

_TYPES = {"string": "string", "integer": "bigint", "number": "double", "any": "variant"}


@dataclass(frozen=True)
class Field:
    """One field of a contract.

    ``kind`` is ``string``, ``integer``, ``number``, ``any`` or ``list<...>`` of the
    first three. ``default`` stands in only when the key is absent. ``nullable``
    accepts an explicit null. ``strip`` makes ``min_length`` count trimmed text.
    """

    name: str
    kind: str = "string"
    required: bool = True
    nullable: bool = False
    default: str | None = None
    min_length: int | None = None
    strip: bool = True
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None

    @property
    def is_list(self) -> bool:
        return self.kind.startswith("list<")

    @property
    def element(self) -> str:
        return self.kind[5:-1] if self.is_list else self.kind

    @property
    def sql_type(self) -> str:
        return f"array<{_TYPES[self.element]}>" if self.is_list else _TYPES[self.kind]


@dataclass(frozen=True)
class Contract:
    """Fields to keep; keys not listed are dropped. ``same_length`` lists must line up."""

    fields: tuple[Field, ...]
    same_length: tuple[str, ...] = ()


_COLUMN_KINDS = (
    (T.StringType, "STRING"),
    (T.BooleanType, "BOOLEAN"),
    (T.IntegralType, "BIGINT"),
    (T.NumericType, "DOUBLE"),
    (T.ArrayType, "ARRAY"),
    (T.StructType, "OBJECT"),
    (T.MapType, "OBJECT"),
)


def _json_kind(data_type: T.DataType) -> str:
    return next((k for t, k in _COLUMN_KINDS if isinstance(data_type, t)), "STRING")


def _dotted_type(schema: T.StructType, name: str) -> T.DataType | None:
    at: T.DataType = schema
    for step in name.split("."):
        if not isinstance(at, T.StructType) or step not in at.names:
            return None
        at = at[step].dataType
    return at


def _cell(df: DataFrame, field: Field, variant: str | None) -> dict[str, Column]:
    """A raw value: is its key absent, is it an explicit null, its JSON kind, its text, its elements."""
    if variant:
        v = part(F.col(variant), f"$.{field.name}")
        return {
            "absent": v.isNull(),
            "null": F.coalesce(F.is_variant_null(v), F.lit(False)),
            "kind": kind_of(v),
            "text": F.try_variant_get(F.col(variant), f"$.{field.name}", "string"),
            "raw": v,
        }
    data_type = _dotted_type(df.schema, field.name)
    if data_type is None:  # the column does not exist: every record lacks the key
        void = F.lit(None).cast("string")
        return {"absent": F.lit(True), "null": F.lit(False), "kind": F.lit("VOID"), "text": void, "raw": void}
    c = F.col(field.name)
    nested = isinstance(data_type, (T.ArrayType, T.StructType, T.MapType))
    return {
        # A column cannot tell an absent key from a null: a null counts as absent.
        "absent": c.isNull(),
        "null": F.lit(False),
        "kind": F.lit(_json_kind(data_type)),
        "text": F.to_json(c) if nested else c.cast("string"),
        "raw": c,
    }


def lax_integer(kind: Column, text: Column) -> Column:
    """``struct<value bigint, code string>`` of a value given as JSON kind and text.

    Accepts integers, whole floats, booleans and integer text; a fraction is refused,
    never cut off.
    """
    digits = F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(text, r"[\t\r\n]", " ")), r"\.0+$", ""), "_", "")
    is_text = kind == "STRING"
    numeric = kind.rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    approx = text.try_cast("double")
    finite = ~(F.isnan(approx) | (F.abs(approx) == float("inf")))
    exact = text.try_cast("decimal(38,9)")
    whole = F.coalesce(exact == F.floor(exact), F.lit(True))
    value = (
        F.when(kind == "BOOLEAN", F.when(text == "true", F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
        .when(is_text & text.rlike(INTEGER_TEXT), digits.try_cast("bigint"))
        .when(numeric & whole, exact.try_cast("bigint"))
    )
    code = (
        F.when(kind == "BOOLEAN", F.lit(None).cast("string"))
        .when(is_text & ~text.rlike(INTEGER_TEXT), F.lit("int_parsing"))
        .when(is_text, F.when(digits.try_cast("bigint").isNull(), F.lit("int_parsing_size")))
        .when(
            numeric,
            F.when(~finite, F.lit("finite_number"))
            .when(~whole, F.lit("int_from_float"))
            .when(exact.try_cast("bigint").isNull(), F.lit("int_parsing_size")),
        )
        .otherwise(F.lit("int_type"))
    )
    return F.struct(value.alias("value"), code.alias("code"))


def lax_number(kind: Column, text: Column) -> Column:
    """``struct<value double, code string>``: numbers, booleans and numeric text."""
    plain = F.regexp_replace(F.trim(text), r"(?<=[0-9])_(?=[0-9])", "")
    is_text = kind == "STRING"
    readable = plain.rlike(NUMBER_PATTERN) | plain.rlike(INFINITY_PATTERN) | plain.rlike(r"(?i)^[+-]?nan$")
    numeric = kind.rlike(r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    value = (
        F.when(kind == "BOOLEAN", F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0)))
        .when(is_text & readable, F.regexp_replace(plain, r"(?i)^[+-]nan$", "NaN").try_cast("double"))
        .when(numeric, text.try_cast("double"))
    )
    code = (
        F.when(is_text & ~readable, F.lit("float_parsing"))
        .when(is_text | numeric | (kind == "BOOLEAN"), F.lit(None).cast("string"))
        .otherwise(F.lit("float_type"))
    )
    return F.struct(value.alias("value"), code.alias("code"))


def _plain_string(kind: Column, text: Column) -> Column:
    code = F.when(F.coalesce(kind != "STRING", F.lit(True)), F.lit("string_type"))
    return F.struct(F.when(kind == "STRING", text).alias("value"), code.alias("code"))


_PARSERS = {"integer": lax_integer, "number": lax_number, "string": _plain_string}


def _bound_code(field: Field, value: Column) -> Column:
    """The first broken bound, or NULL. NaN breaks any upper bound, as it sorts last."""
    code = F.lit(None).cast("string")
    if field.min_length is not None:
        counted = F.regexp_replace(F.regexp_replace(value, r"^\s+", ""), r"\s+$", "") if field.strip else value
        code = F.when(F.length(counted) < field.min_length, F.lit("string_too_short"))
    checks = (
        ("le", "less_than_equal", lambda b: value > b),
        ("lt", "less_than", lambda b: value >= b),
        ("ge", "greater_than_equal", lambda b: value < b),
        ("gt", "greater_than", lambda b: value <= b),
    )
    for attr, name, broken in checks:
        bound = getattr(field, attr)
        if bound is not None:
            code = F.coalesce(code, F.when(broken(F.lit(bound)), F.lit(name)))
    return code


def _message(field: Field, code: Column) -> Column:
    limits = {
        "string_too_short": field.min_length,
        "greater_than": field.gt,
        "greater_than_equal": field.ge,
        "less_than": field.lt,
        "less_than_equal": field.le,
    }
    texts = {k: m.format(limits.get(k)) for k, m in MESSAGES.items() if limits.get(k, "") is not None}
    if field.min_length not in (None, 1):
        texts["string_too_short"] += "s"
    table = F.create_map(*[F.lit(v) for pair in texts.items() for v in pair])
    return F.try_element_at(table, code)


def _error(field: Field, loc: Column, code: Column, given: Column) -> Column:
    body = F.struct(loc.alias("loc"), code.alias("type"), _message(field, code).alias("msg"), given.alias("input"))
    return body.cast(ERROR_TYPE)


def _no_errors() -> Column:
    return F.array().cast(f"array<{ERROR_TYPE}>")


def _one_error(field: Field, loc: Column, code: Column, given: Column) -> Column:
    """A list of the one error, or an empty list where there is no code."""
    return F.when(code.isNotNull(), F.array(_error(field, loc, code, given))).otherwise(_no_errors())


def _typed(field: Field, c: Column, data_type: T.DataType | None) -> Column | None:
    """The parse of a column whose type already says it is a number; None for any other."""
    no_code = F.lit(None).cast("string").alias("code")
    if not isinstance(data_type, T.NumericType) or field.kind not in ("integer", "number"):
        return None
    if field.kind == "number":
        return F.struct(c.cast("double").alias("value"), no_code)
    if isinstance(data_type, T.IntegralType):
        return F.struct(c.cast("bigint").alias("value"), no_code)
    whole = F.when(c == F.floor(c), c.try_cast("bigint"))
    fraction = F.when(c != F.floor(c), F.lit("int_from_float"))
    if not isinstance(data_type, T.DecimalType):
        fraction = F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit("finite_number")).otherwise(fraction)
    code = F.coalesce(fraction, F.when(c.isNotNull() & whole.isNull(), F.lit("int_parsing_size")))
    return F.struct(whole.alias("value"), code.alias("code"))


def _parse(field: Field, cell: dict[str, Column], data_type: T.DataType | None) -> Column:
    """The parsed value with the code of a failed parse; for a list, of every element."""
    parser = _PARSERS.get(field.element)
    if field.kind == "any":
        return F.struct(cell["raw"].alias("value"), F.lit(None).cast("string").alias("code"))
    if not field.is_list:
        typed = _typed(field, cell["raw"], data_type)
        return parser(cell["kind"], cell["text"]) if typed is None else typed
    return _parse_list(field, cell, data_type)


_NULL_CODES = {"string": "string_type", "integer": "int_type", "number": "float_type"}
# Kinds of a list whose elements need no look at each one's own kind.
_EVEN_LISTS = {
    "string": r"^ARRAY<STRING>$",
    "integer": r"^ARRAY<BIGINT>$",
    "number": r"^ARRAY<(BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\))>$",
}
_EVEN_TYPES = {"string": T.StringType, "integer": T.IntegralType, "number": T.NumericType}


def _parse_list(field: Field, cell: dict[str, Column], data_type: T.DataType | None) -> Column:
    """``array<struct<pos, value, code, text>>`` of a list; ``text`` is kept only where the value may be lost."""

    def even(array: Column) -> Column:
        def element(x: Column, i: Column) -> Column:
            code = F.coalesce(F.when(x.isNull(), F.lit(_NULL_CODES[field.element])), _bound_code(field, x))
            return F.struct(
                i.alias("pos"), x.alias("value"), code.alias("code"), F.lit(None).cast("string").alias("text")
            )

        return F.transform(array, element)

    def mixed(pairs: Column) -> Column:
        # Each step binds what the next one uses more than once.
        parser = _PARSERS[field.element]
        parsed = F.transform(
            pairs, lambda p: F.struct(parser(p["kind"], p["text"]).alias("r"), p["text"].alias("text"))
        )
        return F.transform(
            parsed,
            lambda q, i: F.struct(
                i.alias("pos"),
                q["r"]["value"].alias("value"),
                F.coalesce(q["r"]["code"], _bound_code(field, q["r"]["value"])).alias("code"),
                q["text"].alias("text"),
            ),
        )

    raw = cell["raw"]
    if isinstance(data_type, T.ArrayType):
        if isinstance(data_type.elementType, _EVEN_TYPES[field.element]):
            return even(raw.cast(field.sql_type))
        kind = _json_kind(data_type.elementType)
        return mixed(
            F.transform(
                raw,
                lambda e: F.struct(
                    F.when(e.isNull(), F.lit("VOID")).otherwise(F.lit(kind)).alias("kind"),
                    e.cast("string").alias("text"),
                ),
            )
        )
    if data_type is not None:  # a column that is no list: judged by its kind alone
        return F.lit(None).cast(f"array<struct<pos:int,value:{_TYPES[field.element]},code:string,text:string>>")
    pairs = F.transform(
        raw.try_cast("array<variant>"),
        lambda e: F.struct(
            F.coalesce(kind_of(e), F.lit("VOID")).alias("kind"), F.try_variant_get(e, "$", "string").alias("text")
        ),
    )
    return F.when(cell["kind"].rlike(_EVEN_LISTS[field.element]), even(raw.try_cast(field.sql_type))).otherwise(
        mixed(pairs)
    )


def _judge(field: Field, cell: dict[str, Column], parsed: Column) -> tuple[Column, Column]:
    """``(value, code)``; for a list the value keeps its elements and the code is that of the list itself."""
    missing = F.when(cell["absent"], F.lit("missing") if field.required else F.lit(None).cast("string"))
    if field.kind == "any":
        return parsed["value"], missing
    if field.is_list:
        is_list = cell["kind"].startswith("ARRAY")
        return F.when(is_list, parsed), missing.when(~is_list, F.lit("list_type"))
    value = F.when(~cell["absent"] & ~cell["null"], parsed["value"])
    if field.default is not None:
        value = F.when(cell["absent"], F.lit(field.default)).otherwise(value)
    code = missing.when(
        cell["null"], F.lit(None).cast("string") if field.nullable else F.lit(_NULL_CODES[field.element])
    ).otherwise(F.coalesce(parsed["code"], _bound_code(field, parsed["value"])))
    return value.cast(field.sql_type), code


def _element_errors(field: Field, elements: str) -> Column:
    def error(e: Column) -> Column:
        given = F.coalesce(e["text"], e["value"].cast("string"))
        return _error(field, F.concat(F.lit(f"{field.name}."), e["pos"].cast("string")), e["code"], given)

    broken = F.filter(elements, lambda e: e["code"].isNotNull())
    return F.coalesce(F.transform(broken, error), _no_errors())


def check(df: DataFrame, contract: Contract, variant: str | None = None) -> DataFrame:
    """Add ``record`` (the contract's fields, typed), ``errors`` and ``valid`` to every row.

    Fields are columns of ``df`` (dots reach into structs), or paths into the
    ``variant`` column. Field order is error order. Values and codes are computed as
    columns first, so nothing is evaluated once per use; ``valid`` needs the codes only.
    """
    raw, parsed, judged = {}, {}, {}
    own = "_"  # no input column begins like the columns added on the way
    while any(c.startswith(own) for c in df.columns):
        own += "_"
    values, errors, clean = [], [], []
    for i, field in enumerate(contract.fields):
        cell = _cell(df, field, variant)
        if variant or field.is_list:  # taken out of the document once; a plain column needs no step of its own
            raw.update({f"{own}{k}{i}": c for k, c in cell.items()})
            cell = {k: F.col(f"{own}{k}{i}") for k in cell}
        data_type = None if variant else _dotted_type(df.schema, field.name) or T.NullType()
        parsed[f"{own}parsed{i}"] = _parse(field, cell, data_type)
        value, code = f"{own}value{i}", f"{own}code{i}"
        judged[value], judged[code] = _judge(field, cell, F.col(f"{own}parsed{i}"))
        name = field.name.replace(".", "_")
        errors.append(_one_error(field, F.lit(field.name), F.col(code), cell["text"]))
        clean.append(F.col(code).isNull())
        if field.is_list:
            values.append(F.col(f"{value}.value").cast(field.sql_type).alias(name))
            errors.append(_element_errors(field, value))
            clean.append(F.coalesce(~F.exists(value, lambda e: e["code"].isNotNull()), F.lit(True)))
        else:
            values.append(F.col(value).alias(name))
    if contract.same_length:
        lists = [f"{own}value{[f.name for f in contract.fields].index(n)}" for n in contract.same_length]
        differ = reduce(lambda a, b: a | b, [F.size(c) != F.size(lists[0]) for c in lists[1:]], F.lit(False))
        known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in lists])
        listed = ", ".join(contract.same_length)
        body = F.struct(
            F.lit(listed).alias("loc"),
            F.lit("unequal_length").alias("type"),
            F.lit(MESSAGES["unequal_length"].format(listed)).alias("msg"),
            F.concat_ws(", ", *[F.size(c).cast("string") for c in lists]).alias("input"),
        ).cast(ERROR_TYPE)
        errors.append(F.when(known & differ, F.array(body)).otherwise(_no_errors()))
        clean.append(~(known & differ))
    steps = compute_once(compute_once(compute_once(df, raw) if raw else df, parsed), judged)
    return steps.select(
        *df.columns,
        F.struct(*values).alias("record"),
        F.concat(*errors).alias("errors"),
        reduce(lambda a, b: a & b, clean).alias("valid"),
    )


def is_valid() -> Column:
    return F.col("valid")


def valid_rows(checked: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The accepted records with the contract's fields only (and any ``keep`` columns)."""
    return checked.where(is_valid()).select(*keep, "record.*")


def error_rows(checked: DataFrame, key: str | Column) -> DataFrame:
    """``(row_key, row_data, errors)``: the original record as JSON with all that is wrong with it."""
    given = [c for c in checked.columns if c not in ("record", "errors", "valid")]
    if len(given) == 1 and isinstance(checked.schema[given[0]].dataType, T.VariantType):
        row_data = F.to_json(F.col(given[0]))
    else:
        row_data = F.to_json(F.struct(*given), {"ignoreNullFields": "false"})
    key = F.col(key) if isinstance(key, str) else key
    return checked.where(~is_valid()).select(key.alias("row_key"), row_data.alias("row_data"), "errors")


def validate_split(
    df: DataFrame, contract: Contract, key: str | Column, variant: str | None = None, keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """``(valid, errors)``. Both sides are narrow and lazy over the same check."""
    checked = check(df, contract, variant)
    return valid_rows(checked, keep), error_rows(checked, key)


def validation_summary(checked: DataFrame) -> DataFrame:
    """``(status, n)`` with both statuses always listed."""
    n = F.count_if(is_valid())
    row = checked.agg(n.alias("valid"), F.count_if(~is_valid()).alias("error"))
    cells = [F.struct(F.lit(s).alias("status"), F.col(s).alias("n")) for s in ("valid", "error")]
    return row.select(F.explode(F.array(*cells)).alias("_r")).select("_r.*")


def error_summary(checked: DataFrame) -> DataFrame:
    """``(loc, type, n)``."""
    return (
        checked.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.loc").alias("loc"), F.col("e.type").alias("type"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def all_or_nothing(feeds: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Checked feeds pass together or not at all.

    Returns the valid rows of each feed, emptied if any feed holds an error, and the
    errors of all feeds as ``(feed, errors)``.
    """
    rejected = None
    for name, checked in feeds.items():
        bad = checked.where(~is_valid()).select(F.lit(name).alias("feed"), "errors")
        rejected = bad if rejected is None else rejected.unionByName(bad)
    # One reject decides: each task stops at its first.
    failed = rejected.limit(1).agg((F.count(F.lit(1)) > 0).alias("failed")).scalar()
    return {name: valid_rows(checked.where(~failed)) for name, checked in feeds.items()}, rejected


def zip_arrays_to_rows(df: DataFrame, arrays: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Parallel arrays (``{output: column}``) to rows with their 0-based ``position``.

    Spark pads a shorter list with NULL where the lists should have failed: check
    them with ``Contract(same_length=...)`` first.
    """
    zipped = F.arrays_zip(*[F.col(c).alias(n) for n, c in arrays.items()])
    rows = df.select(*keep, F.posexplode(zipped).alias("position", "_cell"))
    return rows.select(*keep, "position", *[F.col("_cell")[n].alias(n) for n in arrays])


def array_all(col: str | Column, test) -> Column:
    """Whether every element passes; a missing element fails, an empty list passes."""
    return F.coalesce(F.forall(F.col(col) if isinstance(col, str) else col, test), F.lit(False))


def within(col: str | Column, lo: float, hi: float) -> Column:
    """Inclusive bounds test; missing and NaN fail."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.between(lo, hi), F.lit(False))


# The three feeds and the sales record the engine knows by name.
def sales_contract(strip: bool = True) -> Contract:
    """``strip=False`` accepts a region of blanks, as a bare minimum length would."""
    return Contract(
        (
            Field("month", min_length=1, strip=strip),
            Field("region", min_length=1, strip=strip),
            Field("amount", "integer", gt=0),
            Field("category", required=False, nullable=True),
        )
    )


WEATHER = Contract(
    (
        Field("latitude", "number", ge=-90, le=90),
        Field("longitude", "number", ge=-180, le=180),
        Field("hourly.time", "list<string>"),
        Field("hourly.temperature_2m", "list<number>"),
        Field("hourly.precipitation_probability", "list<integer>", ge=0, le=100),
    ),
    same_length=("hourly.time", "hourly.temperature_2m", "hourly.precipitation_probability"),
)
COUNTRY = Contract(
    (
        Field("name", "any"),
        Field("region", required=False, nullable=True, default="Asia"),
        Field("cca2", required=False, nullable=True),
    )
)
IP = Contract((Field("query"), Field("status"), Field("country"), Field("regionName")))
