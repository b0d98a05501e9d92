"""Check registry: a check name plus parameters gives a rule made of Column expressions.

Rule kinds, by what they need from Spark:
  RowRule     two booleans per row; any number of them share one aggregate
  TotalRule   aggregates of the whole table; share the same aggregate
  KeyRule     value counts of some columns (one grouped scan per column set)
  OrderRule   the row before along an order
  QuantileRule exact quantiles
  SetRule     a set of values that comes from a table; one count per value
  SchemaRule  column names and types only
Value checks skip nulls. Percent = unexpected / non-null rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import nan_to_null
from millrace.functions.exact import name, row_sum_equals, sum_number

CHECKS: dict[str, Callable] = {}


def no() -> Column:
    return F.lit(False)


def yes() -> Column:
    return F.lit(True)


def check(name: str):
    """Register a builder `f(df, **parameters) -> rule` under a check name."""

    def add(builder):
        CHECKS[name] = builder
        return builder

    return add


def build_rule(df: DataFrame, name: str, params: dict):
    builder = CHECKS.get(name)
    if builder is None:
        raise ValueError(f"unknown check {name!r}")
    try:
        return builder(df, **params)
    except TypeError as err:
        raise ValueError(f"check {name!r}: {err}") from err


@dataclass
class RowRule:
    column: str
    unexpected: Column
    missing: Column | None = None
    mostly: float | None = None


@dataclass
class TotalRule:
    column: str
    totals: dict[str, Column]
    success: Callable[[dict[str, Column]], Column]
    details: Callable[[dict[str, Column]], Column] | None = None
    missing: Column | None = None


@dataclass
class KeyRule:
    """Works on a table (key columns, cnt). `summary` holds aggregates over it."""

    columns: list[str]
    skip: Column
    summary: dict[str, Column] = field(default_factory=dict)
    success: Callable[[dict[str, Column]], Column] | None = None
    details: Callable[[dict[str, Column]], Column] | None = None
    repeated_is_bad: bool = False
    mostly: float | None = None
    by_count: Column | None = None

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass
class OrderRule:
    column: str
    order_by: list[str]
    partition_by: list[str]
    decreasing: bool
    strictly: bool
    rows_per_bucket: int | None


@dataclass
class QuantileRule:
    column: str
    probs: list[float]
    ranges: list[tuple]
    approximate: bool = False


@dataclass
class SetRule:
    """Values against a set with one column. `test` is in or not_in (by row), within, contain or equal (by value)."""

    column: str
    members: DataFrame
    test: str
    mostly: float | None = None

    @property
    def by_row(self) -> bool:
        return self.test in {"in", "not_in"}


@dataclass
class SchemaRule:
    column: str
    ok: bool
    details: str | None = None


# ---------------------------------------------------------------- helpers


def _known(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")


def _truth(condition: Column) -> Column:
    return F.coalesce(condition, no())


def _value_rule(df: DataFrame, column: str, bad: Column, mostly=None) -> RowRule:
    """Unexpected where the value is there and `bad` holds."""
    _known(df, column)
    here = F.col(column).isNotNull()
    return RowRule(column, here & _truth(bad), ~here, mostly)


def _outside(value: Column, low, high, strict_min=False, strict_max=False) -> Column:
    bad = no()
    if low is not None:
        bad = bad | (value <= F.lit(low) if strict_min else value < F.lit(low))
    if high is not None:
        bad = bad | (value >= F.lit(high) if strict_max else value > F.lit(high))
    return bad


def as_text(value: Column, digits: int = 4) -> Column:
    """A number as plain decimal text, the same on every platform; one too large for it as Spark prints it."""
    return F.coalesce(F.round(value, digits).try_cast(f"decimal(38,{digits})").cast("string"), value.cast("string"))


def _skip_when(names: list[str], ignore: str) -> Column:
    nulls = [F.col(n).isNull() for n in names]
    whole, some = nulls[0], nulls[0]
    for n in nulls[1:]:
        whole, some = whole & n, some | n
    modes = {
        "both_values_are_missing": whole,
        "all_values_are_missing": whole,
        "either_value_is_missing": some,
        "any_value_is_missing": some,
        "neither": no(),
        "never": no(),
    }
    if ignore not in modes:
        raise ValueError(f"ignore_row_if must be one of {', '.join(modes)}")
    return modes[ignore]


# ---------------------------------------------------------------- row rules


@check("column_values_to_not_be_null")
def _not_null(df, column, mostly=None):
    _known(df, column)
    return RowRule(column, F.col(column).isNull(), mostly=mostly)


@check("column_values_to_be_null")
def _null(df, column, mostly=None):
    _known(df, column)
    return RowRule(column, F.col(column).isNotNull(), mostly=mostly)


@check("column_values_to_be_in_set")
def _in_set(df, column, value_set, mostly=None):
    if not _listed(value_set):
        return _set_of(df, column, value_set, "in", mostly)
    return _value_rule(df, column, ~_in(df, column, value_set), mostly)


@check("column_values_to_not_be_in_set")
def _not_in_set(df, column, value_set, mostly=None):
    if not _listed(value_set):
        return _set_of(df, column, value_set, "not_in", mostly)
    return _value_rule(df, column, _in(df, column, value_set), mostly)


def _listed(value_set) -> bool:
    """A list written in the task; else the set is a frame or says where to find one."""
    return not isinstance(value_set, (DataFrame, dict))


def _set_of(df: DataFrame, column: str, value_set: DataFrame | dict, test: str, mostly=None) -> SetRule:
    """`value_set` is a frame of one column, or {"table": ..., "column": ...}, or {"path": ..., "format": ..., "column": ...}
    (Parquet if no format is given).

    The distinct values of the set, in the type of the checked column as `_member`; one that does not
    fit that type is kept with a null and its text, as no row can hold it. Nulls and NaN are left out.
    """
    _known(df, column)
    if isinstance(value_set, dict):
        extra = set(value_set) - {"table", "path", "format", "column"}
        if extra or ("table" in value_set) == ("path" in value_set) or "column" not in value_set:
            raise ValueError("a value set names a column and either a table or a path with a format")
        spark = df.sparkSession
        if "table" in value_set:
            value_set = spark.table(value_set["table"]).select(value_set["column"])
        else:
            value_set = spark.read.format(value_set.get("format") or "parquet").load(value_set["path"]).select(value_set["column"])
    if len(value_set.columns) != 1:
        raise ValueError("a value set has one column")
    raw = nan_to_null(value_set.toDF("_raw")).where("_raw is not null")
    member = F.col("_raw").try_cast(df.schema[column].dataType)
    misfit = F.when(member.isNull(), F.col("_raw").cast("string"))
    return SetRule(column, raw.select(member.alias("_member"), misfit.alias("_misfit")).distinct(), test, mostly)


def _in(df: DataFrame, column: str, value_set: list) -> Column:
    """`isin` turns into a hash lookup; the set is part of a task file, so it stays small."""
    _known(df, column)
    return F.col(column).isin([v for v in value_set if v is not None])


@check("column_values_to_be_between")
def _between(df, column, min_value=None, max_value=None, strict_min=False, strict_max=False, mostly=None):
    return _value_rule(df, column, _outside(F.col(column), min_value, max_value, strict_min, strict_max), mostly)


@check("column_value_lengths_to_be_between")
def _len_between(df, column, min_value=None, max_value=None, mostly=None):
    return _value_rule(df, column, _outside(F.length(F.col(column).cast("string")), min_value, max_value), mostly)


@check("column_value_lengths_to_equal")
def _len_equal(df, column, value, mostly=None):
    return _value_rule(df, column, F.length(F.col(column).cast("string")) != value, mostly)


@check("column_values_to_match_regex")
def _regex(df, column, regex, mostly=None):
    return _value_rule(df, column, ~F.col(column).rlike(regex), mostly)


@check("column_values_to_not_match_regex")
def _not_regex(df, column, regex, mostly=None):
    return _value_rule(df, column, F.col(column).rlike(regex), mostly)


def _hits(column: str, patterns: list[str], every: bool) -> Column:
    tests = [F.col(column).rlike(p) for p in patterns]
    out = tests[0]
    for t in tests[1:]:
        out = out & t if every else out | t
    return out


@check("column_values_to_match_regex_list")
def _regex_list(df, column, regex_list, match_on="any", mostly=None):
    return _value_rule(df, column, ~_hits(column, regex_list, match_on == "all"), mostly)


@check("column_values_to_not_match_regex_list")
def _not_regex_list(df, column, regex_list, mostly=None):
    return _value_rule(df, column, _hits(column, regex_list, False), mostly)


# Strftime directive -> Spark datetime pattern (separated form, adjacent form).
STRFTIME = {
    "Y": ("yyyy", "yyyy"),
    "y": ("yy", "yy"),
    "m": ("M", "MM"),
    "d": ("d", "dd"),
    "H": ("H", "HH"),
    "I": ("h", "hh"),
    "M": ("m", "mm"),
    "S": ("s", "ss"),
    "f": ("SSSSSS", "SSSSSS"),
    "b": ("MMM", "MMM"),
    "B": ("MMMM", "MMMM"),
    "j": ("D", "DDD"),
    "p": ("a", "a"),
    "z": ("xx", "xx"),
    "Z": ("z", "z"),
}


def spark_datetime_pattern(strftime: str) -> str:
    """`%Y-%m-%d` -> `yyyy-M-d`. Directives that touch get fixed widths."""
    out, tokens = [], re.findall(r"%.|[^%]+", strftime)
    for i, token in enumerate(tokens):
        if token == "%%":
            out.append("'%'")
        elif token.startswith("%"):
            if token[1] not in STRFTIME:
                raise ValueError(f"directive {token} is not supported")
            touches = any(0 <= j < len(tokens) and tokens[j].startswith("%") for j in (i - 1, i + 1))
            out.append(STRFTIME[token[1]][touches])
        else:
            out.append(re.sub(r"[A-Za-z']+", lambda m: "'" + m.group().replace("'", "''") + "'", token))
    return "".join(out)


@check("column_values_to_match_strftime_format")
def _strftime(df, column, strftime_format, mostly=None):
    pattern = spark_datetime_pattern(strftime_format)
    return _value_rule(df, column, F.try_to_timestamp(F.col(column), F.lit(pattern)).isNull(), mostly)


@check("column_values_to_be_dateutil_parseable")
def _date_parseable(df, column, mostly=None):
    """Narrower than dateutil: what Spark itself casts to a timestamp."""
    return _value_rule(df, column, F.col(column).cast("string").try_cast("timestamp").isNull(), mostly)


@check("column_values_to_be_json_parseable")
def _json(df, column, mostly=None):
    return _value_rule(df, column, F.try_parse_json(F.col(column)).isNull(), mostly)


# Type names accepted in a task -> Spark types.
TYPE_NAMES = {
    "int": {"tinyint", "smallint", "int", "bigint"},
    "integer": {"tinyint", "smallint", "int", "bigint"},
    "int64": {"bigint"},
    "int32": {"int"},
    "bigint": {"bigint"},
    "long": {"bigint"},
    "float": {"float", "double"},
    "float64": {"double"},
    "double": {"double"},
    "decimal": {"decimal"},
    "number": {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"},
    "bool": {"boolean"},
    "boolean": {"boolean"},
    "str": {"string"},
    "string": {"string"},
    "char": {"string"},
    "varchar": {"string"},
    "text": {"string"},
    "object": {"string"},
    "date": {"date"},
    "datetime": {"timestamp", "timestamp_ntz"},
    "datetime64": {"timestamp", "timestamp_ntz"},
    "timestamp": {"timestamp", "timestamp_ntz"},
}

# What a text column must cast to when another type is asked for.
TEXT_CASTS = {
    "int": "bigint", "integer": "bigint", "int64": "bigint", "int32": "int", "bigint": "bigint",
    "long": "bigint", "float": "double", "float64": "double", "double": "double",
    "decimal": "decimal(38,6)", "number": "double", "bool": "boolean", "boolean": "boolean",
    "date": "date", "datetime": "timestamp", "datetime64": "timestamp", "timestamp": "timestamp",
}


def _type_rule(df, column, names, mostly):
    _known(df, column)
    names = [n.strip().lower() for n in names]
    unknown = [n for n in names if n not in TYPE_NAMES]
    if unknown:
        raise ValueError(f"unknown type names: {', '.join(unknown)}")
    have = df.schema[column].dataType.typeName()
    have = {"integer": "int", "long": "bigint", "short": "smallint", "byte": "tinyint"}.get(have, have)
    if any(have in TYPE_NAMES[n] for n in names):
        return _value_rule(df, column, no(), mostly)
    casts = [TEXT_CASTS[n] for n in names if n in TEXT_CASTS]
    if have != "string" or not casts:
        return _value_rule(df, column, yes(), mostly)
    bad = yes()
    for c in casts:
        bad = bad & F.col(column).try_cast(c).isNull()
    return _value_rule(df, column, bad, mostly)


@check("column_values_to_be_of_type")
def _of_type(df, column, type_, mostly=None):
    return _type_rule(df, column, [type_], mostly)


@check("column_values_to_be_in_type_list")
def _in_type_list(df, column, type_list=None, datatype=None, mostly=None):
    names = type_list if type_list is not None else datatype
    return _type_rule(df, column, names.split(",") if isinstance(names, str) else names, mostly)


@check("column_pair_values_A_to_be_greater_than_B")
def _pair_gt(df, column_A, column_B, or_equal=False, ignore_row_if="both_values_are_missing", mostly=None):
    _known(df, column_A, column_B)
    a, b = F.col(column_A), F.col(column_B)
    skip = _skip_when([column_A, column_B], ignore_row_if)
    good = a >= b if or_equal else a > b
    return RowRule(f"{column_A},{column_B}", ~skip & ~_truth(good), skip, mostly)


@check("column_pair_values_to_be_equal")
def _pair_equal(df, column_A, column_B, ignore_row_if="both_values_are_missing", mostly=None):
    _known(df, column_A, column_B)
    skip = _skip_when([column_A, column_B], ignore_row_if)
    return RowRule(f"{column_A},{column_B}", ~skip & ~F.col(column_A).eqNullSafe(F.col(column_B)), skip, mostly)


@check("column_pair_values_to_be_in_set")
def _pair_in_set(df, column_A, column_B, value_pairs_set, ignore_row_if="both_values_are_missing", mostly=None):
    _known(df, column_A, column_B)
    skip = _skip_when([column_A, column_B], ignore_row_if)
    good = no()
    for x, y in value_pairs_set:
        good = good | (F.col(column_A).eqNullSafe(F.lit(x)) & F.col(column_B).eqNullSafe(F.lit(y)))
    return RowRule(f"{column_A},{column_B}", ~skip & ~good, skip, mostly)


@check("select_column_values_to_be_unique_within_record")
def _unique_in_record(df, column_list, ignore_row_if="all_values_are_missing", mostly=None):
    _known(df, *column_list)
    skip = _skip_when(column_list, ignore_row_if)
    distinct = F.size(F.array_distinct(F.array(*[F.col(c).cast("string") for c in column_list])))
    return RowRule(",".join(column_list), ~skip & (distinct < len(column_list)), skip, mostly)


@check("multicolumn_sum_to_equal")
def _multicol_sum(df, column_list, sum_total, ignore_row_if="all_values_are_missing", mostly=None):
    _known(df, *column_list)
    skip = _skip_when(column_list, ignore_row_if)
    good = row_sum_equals(column_list, [df.schema[c].dataType for c in column_list], sum_total)
    return RowRule(",".join(column_list), ~skip & ~_truth(good), skip, mostly)


# ---------------------------------------------------------------- key rules


@check("column_values_to_be_unique")
def _unique(df, column, mostly=None):
    return _unique_key(df, [column], mostly=mostly)


@check("compound_columns_to_be_unique")
def _compound_unique(df, column_list, ignore_row_if="all_values_are_missing", mostly=None):
    return _unique_key(df, column_list, ignore_row_if, mostly)


def _unique_key(df, columns, ignore="all_values_are_missing", mostly=None):
    _known(df, *columns)
    return KeyRule(columns, _skip_when(columns, ignore), repeated_is_bad=True, mostly=mostly)


def _count_rule(df, column, totals, low, high, strict_min=False, strict_max=False, details="n"):
    _known(df, column)
    return KeyRule(
        [column],
        F.col(column).isNull(),
        totals,
        lambda t: ~_outside(t[details], low, high, strict_min, strict_max),
        lambda t: as_text(t[details]),
    )


@check("column_unique_value_count_to_be_between")
def _unique_count(df, column, min_value=None, max_value=None, strict_min=False, strict_max=False, approximate=False):
    if approximate:
        return _total(df, column, F.approx_count_distinct(column), min_value, max_value, strict_min, strict_max)
    return _count_rule(df, column, {"n": F.count_if(~F.col("_skip"))}, min_value, max_value, strict_min, strict_max)


@check("column_proportion_of_unique_values_to_be_between")
def _unique_prop(df, column, min_value=None, max_value=None, strict_min=False, strict_max=False):
    share = F.count_if(~F.col("_skip")) / F.sum(F.when(~F.col("_skip"), F.col("cnt")))
    return _count_rule(df, column, {"n": share}, min_value, max_value, strict_min, strict_max)


@check("column_most_common_value_to_be_in_set")
def _most_common(df, column, value_set, ties_okay=False):
    """The values with the highest count. Ties are counted, not listed: there may be very many."""
    _known(df, column)
    inside = F.coalesce(F.col(column).isin([v for v in value_set if v is not None]), no())
    return KeyRule(
        [column],
        F.col(column).isNull(),
        {},
        lambda t: (t["good"] > 0) & (F.lit(ties_okay) | (t["values"] == 1)),
        lambda t: F.concat_ws(" ", F.lit("count"), t["cnt"].cast("string"), F.lit("values"), t["values"].cast("string")),
        by_count=inside,
    )


# ---------------------------------------------------------------- order and quantile rules


def _as_names(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value or [])


def _order_rule(df, column, order_by, partition_by, strictly, decreasing, rows_per_bucket):
    order, parts = _as_names(order_by), _as_names(partition_by)
    _known(df, column, *order, *parts)
    if not order:
        raise ValueError("an order column is required: a DataFrame has no row order of its own")
    return OrderRule(column, order, parts, decreasing, strictly, rows_per_bucket)


@check("column_values_to_be_increasing")
def _increasing(df, column, order_by, partition_by=None, strictly=False, rows_per_bucket=None):
    return _order_rule(df, column, order_by, partition_by, strictly, False, rows_per_bucket)


@check("column_values_to_be_decreasing")
def _decreasing(df, column, order_by, partition_by=None, strictly=False, rows_per_bucket=None):
    return _order_rule(df, column, order_by, partition_by, strictly, True, rows_per_bucket)


@check("column_quantile_values_to_be_between")
def _quantiles(df, column, quantile_ranges, approximate=False):
    _known(df, column)
    return QuantileRule(column, list(quantile_ranges["quantiles"]), [tuple(r) for r in quantile_ranges["value_ranges"]], approximate)


@check("column_median_to_be_between")
def _median(df, column, min_value=None, max_value=None, approximate=False):
    _known(df, column)
    return QuantileRule(column, [0.5], [(min_value, max_value)], approximate)


# ---------------------------------------------------------------- total rules


def _total(df, column, value, low, high, strict_min=False, strict_max=False, text=as_text):
    _known(df, column)

    def success(t):
        # No value (empty or all-null column): nothing to object to.
        return F.coalesce(~_outside(t["x"], low, high, strict_min, strict_max), yes())

    return TotalRule(column, {"x": value}, success, lambda t: text(t["x"]), F.col(column).isNull())


def _plain(value: Column) -> Column:
    return value.cast("string")


def _end_rule(function):
    def build(df, column, min_value=None, max_value=None, strict_min=False, strict_max=False):
        _known(df, column)
        numeric = df.schema[column].dataType.typeName() in {"double", "float", "integer", "long", "short", "byte"} or \
            df.schema[column].dataType.typeName().startswith("decimal")
        return _total(df, column, function(df, column), min_value, max_value, strict_min, strict_max, as_text if numeric else _plain)

    return build


def _sum(df: DataFrame, column: str) -> Column:
    return F.expr(sum_number(name(column), df.schema[column].dataType))


def _mean(df: DataFrame, column: str) -> Column:
    return _sum(df, column) / F.nullif(F.count(column), F.lit(0))


check("column_min_to_be_between")(_end_rule(lambda df, c: F.min(c)))
check("column_max_to_be_between")(_end_rule(lambda df, c: F.max(c)))
check("column_sum_to_be_between")(_end_rule(_sum))
check("column_mean_to_be_between")(_end_rule(_mean))
check("column_stdev_to_be_between")(_end_rule(lambda df, c: F.stddev_samp(c)))


def _found(df: DataFrame, column: str, values: list) -> Column:
    """How many members of the list occur: at most the list itself is gathered."""
    of, kinds = df.schema[column].dataType.typeName(), {type(v) for v in values}
    same = (of == "string" and kinds == {str}) or (of in {"byte", "short", "integer", "long"} and kinds == {int}) \
        or (of == "double" and kinds <= {int, float})
    if same:
        return F.size(F.collect_set(F.when(F.col(column).isin(values), F.col(column)))).cast("long")
    found = F.lit(0)  # types differ, so that several values may equal one member
    for v in values:
        found = found + F.coalesce(F.max(F.when(F.col(column) == F.lit(v), 1).otherwise(0)), F.lit(0))
    return found


def _set_totals(df, column, value_set):
    """Which members of the list occur and how many rows lie outside."""
    _known(df, column)
    values = [v for v in value_set if v is not None]
    inside = F.col(column).isin(values)
    found = _found(df, column, values) if values else F.coalesce(F.count_if(no()), F.lit(0))
    return {"outside": F.count_if(F.col(column).isNotNull() & ~inside), "found": found}, len(set(values))


def set_details(found: Column, size: Column, outside: Column) -> Column:
    return F.concat_ws(" ", F.lit("found"), found.cast("string"), F.lit("of"), size.cast("string"),
                       F.lit("rows outside"), outside.cast("string"))


def _set_rule(kind, test):
    def build(df, column, value_set):
        if not _listed(value_set):
            return _set_of(df, column, value_set, kind)
        totals, size = _set_totals(df, column, value_set)
        return TotalRule(
            column,
            totals,
            lambda t: test(t, size),
            lambda t: set_details(t["found"], F.lit(size), t["outside"]),
            F.col(column).isNull(),
        )

    return build


check("column_distinct_values_to_be_in_set")(_set_rule("within", lambda t, n: t["outside"] == 0))
check("column_distinct_values_to_contain_set")(_set_rule("contain", lambda t, n: t["found"] == n))
check("column_distinct_values_to_equal_set")(_set_rule("equal", lambda t, n: (t["outside"] == 0) & (t["found"] == n)))


@check("table_row_count_to_equal")
def _rows_equal(df, value):
    return TotalRule("", {"n": F.count(F.lit(1))}, lambda t: t["n"] == value, lambda t: t["n"].cast("string"))


@check("table_row_count_to_be_between")
def _rows_between(df, min_value=None, max_value=None):
    return TotalRule("", {"n": F.count(F.lit(1))}, lambda t: ~_outside(t["n"], min_value, max_value), lambda t: t["n"].cast("string"))


# ---------------------------------------------------------------- schema rules


@check("table_column_count_to_equal")
def _cols_equal(df, value):
    return SchemaRule("", len(df.columns) == value, str(len(df.columns)))


@check("table_column_count_to_be_between")
def _cols_between(df, min_value=None, max_value=None):
    n = len(df.columns)
    ok = (min_value is None or n >= min_value) and (max_value is None or n <= max_value)
    return SchemaRule("", ok, str(n))


@check("column_to_exist")
def _exists(df, column, column_index=None):
    ok = column in df.columns and (column_index is None or df.columns.index(column) == column_index)
    return SchemaRule(column, ok)


@check("table_columns_to_match_ordered_list")
def _columns_ordered(df, column_list):
    return SchemaRule(",".join(column_list), df.columns == list(column_list), ",".join(df.columns))


@check("table_columns_to_match_set")
def _columns_set(df, column_set, exact_match=True):
    have, want = set(df.columns), set(column_set)
    off = sorted(have ^ want if exact_match else want - have)
    return SchemaRule(",".join(sorted(want)), not off, ",".join(off))
