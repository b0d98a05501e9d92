"""Sums and number texts that do not depend on how rows fall into partitions, at any magnitude.

The way is chosen by the column's type. Whole numbers, and doubles that are whole millionths of up to 15 digits,
are cut into three groups of bits, which are added as longs without any error and carried once, in the end. Decimals that have room for the total are added in their own type.
All other numbers are taken apart, row by row, into their whole part and the first 18 and next 20 digits after the
point, in decimal(38,0); each is added exactly. A double counts as its shortest decimal text. Numbers that do not
fit (from 1E38 on, or with digits beyond the 38th after the point) are summed as doubles, and such totals are
compared with a relative tolerance of 1E-9.

Expressions are put together as SQL text and parsed once: built column by column, one total took seconds before any row
was read. `value` is SQL text (see `name`), `kind` its type.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType

FINE = "decimal(38,20)"
WHOLE = "decimal(38,0)"
REST = "decimal(38,38)"
HEAD, TAIL = 18, 20  # digits after the point
TOLERANCE = 1e-9
GROUP_BITS = 22  # bits of a whole number that are added together: 2 ** 41 rows fit a long
MILLION = 1_000_000
EXACT_DIGITS = "1e15D"  # a decimal of up to 15 digits is the only one of its length nearest to its double
ROOM = 12  # digits that a decimal needs beyond its own for the total of 1E12 rows
ZERO, ONE = f"cast(0 as {WHOLE})", "cast(1 as decimal(1,0))"
FINE_TYPE, DOUBLE = DecimalType(38, 20), DoubleType()

Parts = tuple[str, str, str]


def name(column: str) -> str:
    """A column as SQL text."""
    return "`" + column.replace("`", "``") + "`"


def _let(value: str, variable: str, body: str) -> str:
    """`body` of a variable that stands for a value, so that the value is written into the expression once."""
    return f"transform(array({value}), {variable} -> {body})[0]"


def _named(parts: Parts) -> str:
    return "named_struct(" + ", ".join(f"'{k}', cast({p} as {WHOLE})" for k, p in zip("wht", parts)) + ")"


def _is_whole(kind: DataType) -> bool:
    return kind.typeName() in {"byte", "short", "integer", "long"}


def _parts(value: str, kind: DataType) -> Parts:
    """(whole part, first digits, next digits), each with the number's sign; no whole part if the number does not fit."""
    if _is_whole(kind) or isinstance(kind, DecimalType) and kind.scale == 0:
        return f"cast({value} as {WHOLE})", ZERO, ZERO
    if isinstance(kind, DecimalType):
        whole, rest = f"try_cast({value} - {value} % {ONE} as {WHOLE})", f"try_cast({value} % {ONE} as {REST})"
    else:
        small, fine = f"try_cast({value} as {REST})", f"try_cast({value} as {FINE})"  # below 1, below 1E18
        whole = f"coalesce(if({small} is not null, {ZERO}, null), cast({fine} - {fine} % {ONE} as {WHOLE}), try_cast({value} as {WHOLE}))"
        whole = f"if({small} is null or cast({small} as double) = try_cast({value} as double), {whole}, null)"
        rest = f"coalesce({small}, cast({fine} % {ONE} as {REST}))"

    def digits(start: int, n: int) -> str:
        found = f"substring(cast(abs({rest}) as string), {start}, {n})"
        number = f"cast({found} as {WHOLE})"
        return f"coalesce(if({found} <> '{'0' * n}', if({rest} < 0, -{number}, {number}), {ZERO}), {ZERO})"

    return whole, digits(3, HEAD), digits(3 + HEAD, TAIL)


def _quick(value: str, kind: DataType) -> tuple[str, str] | None:
    """(whether the number is so many millionths, these as a long of up to 15 digits); None if the type has no such way.

    A double x is y / 1E6 for a whole y of up to 15 digits if dividing gives x again: division rounds to the
    nearest double, and no other decimal of so few digits has the same one.
    """
    if _is_whole(kind):
        fits = f"({value} between -{10**9} and {10**9})"
        return fits, f"if({fits}, cast({value} as bigint) * {MILLION}L, null)"
    if kind.typeName() != "double":
        return None
    units = f"rint({value} * 1e6D)"
    holds = f"(abs({units}) < {EXACT_DIGITS} and {units} / 1e6D = {value})"
    return holds, f"cast(if({holds}, {units}, null) as bigint)"  # nothing is cast that does not fit


def _carried(whole: str, head: str, tail: str) -> Parts:
    """The same number with the digits not below 0 and within their places."""

    def carry(number: str, places: int) -> tuple[str, str]:
        base = f"cast('{10**places}' as decimal({places + 1},0))"
        left = f"cast(pmod({number}, {base}) as {WHOLE})"
        return f"cast(({number} - {left}) / {base} as {WHOLE})", left

    over, tail = carry(tail, TAIL)
    over, head = carry(f"({head} + {over})", HEAD)
    return f"try_add({whole}, {over})", head, tail


def _shown(parts: str) -> str:
    text = f"concat(cast({parts}.w as string), '.', lpad(cast({parts}.h as string), {HEAD}, '0'), lpad(cast({parts}.t as string), {TAIL}, '0'))"
    return _trimmed(text)


def _trimmed(text: str) -> str:
    """Without zeros beyond the sixth digit after the point."""
    return f"regexp_replace({text}, '([.][0-9]{{6}}[0-9]*?)0+$', '$1')"


def _text(parts: Parts) -> str:
    """Plain decimal text with six to 38 digits after the point."""
    minus = _let(_named(_carried("-p.w", "-p.h", "-p.t")), "m", _shown("m"))
    signed = _let(_named(_carried("x.w", "x.h", "x.t")), "p", f"if(p.w < 0, concat('-', {minus}), {_shown('p')})")
    return _let(_named(parts), "x", signed)


def number_text(value: str, kind: DataType) -> str:
    """Plain decimal text with six to 38 digits after the point; numbers that do not fit as Spark prints them."""
    return _let(value, "v", f"coalesce({_text(_parts('v', kind))}, cast(v as string))")


def _long_total(value: str) -> str:
    """The exact sum of longs: three groups of bits, put together in the end."""
    groups = [f"{value} & {(1 << GROUP_BITS) - 1}L", f"shiftright({value}, {GROUP_BITS}) & {(1 << GROUP_BITS) - 1}L", f"shiftright({value}, {2 * GROUP_BITS})"]
    sums = [f"cast(coalesce(sum({g}), 0) as {WHOLE}) * cast({1 << (i * GROUP_BITS)} as decimal(14,0))" for i, g in enumerate(groups)]
    return f"cast({' + '.join(sums)} as {WHOLE})"


def _sums(value: str, kind: DataType) -> tuple[Parts, str]:
    """(sums of the parts, whether they hold all values)."""
    if isinstance(kind, DecimalType) and kind.precision + ROOM <= 38:
        return _parts(f"sum(cast({value} as decimal(38,{kind.scale})))", DecimalType(38, kind.scale)), "true"
    if _is_whole(kind):
        return (_long_total(f"cast({value} as bigint)"), ZERO, ZERO), "true"
    quick, parts = _quick(value, kind), _parts(value, kind)
    slow = f"({value} is not null)" if quick is None else f"(not {quick[0]})"
    parts = [f"if({slow}, {p}, null)" for p in parts]  # other rows are not taken apart
    sums = [f"coalesce(try_sum({p}), {ZERO})" for p in parts]
    known = f"(count_if({slow} and {parts[0]} is null) = 0 and (try_sum({parts[0]}) is not null or count_if({slow}) = 0))"
    if quick is not None:
        total, million = _long_total(quick[1]), f"cast({MILLION} as decimal(7,0))"
        left = f"cast(pmod({total}, {million}) as {WHOLE})"
        sums[0] = f"try_add({sums[0]}, cast(({total} - {left}) / {million} as {WHOLE}))"
        sums[1] = f"({sums[1]} + {left} * cast({10 ** (HEAD - 6)} as decimal(13,0)))"
    return tuple(sums), known


def _exact_text(value: str, kind: DataType) -> str:
    """The exact sum as text; null of no value or if one does not fit."""
    parts, exact = _sums(value, kind)
    return f"if({exact} and count({value}) > 0, {_text(parts)}, null)"


def sum_text(value: str, kind: DataType) -> str:
    """The exact sum as text; of no value, null."""
    return f"coalesce({_exact_text(value, kind)}, cast(sum(cast({value} as double)) as string))"


def sum_number(value: str, kind: DataType) -> str:
    """The exact sum as the nearest double; of no value, null."""
    return f"coalesce(cast({_exact_text(value, kind)} as double), sum(cast({value} as double)))"


def mean_text(value: str, kind: DataType) -> str:
    """The exact mean, to twenty digits after the point where it is below 1E18; to 37 if the sum has more and is below 1."""
    longer = "if(length(substring_index(g.text, '.', -1)) > 20, try_cast(g.text as decimal(38,37)), null)"
    fine = f"""coalesce(cast(nullif(try_cast(try_divide({longer}, g.n) as decimal(38,37)), cast(0 as decimal(1,0))) as string),
        cast(try_cast(try_divide(try_cast(g.text as {FINE}), g.n) as {FINE}) as string))"""
    rough = "coalesce(try_cast(g.text as double), g.rough)"
    lost = f"(try_cast(f as double) = 0 and {rough} <> 0)"
    shown = f"coalesce(if({lost}, null, {_trimmed('f')}), {number_text(f'{rough} / cast(g.n as double)', DOUBLE)})"
    given = f"""named_struct('text', {_exact_text(value, kind)}, 'n', cast(nullif(count({value}), 0) as decimal(20,0)),
        'rough', sum(cast({value} as double)))"""
    return f"if(count({value}) > 0, {_let(given, 'g', _let(fine, 'f', shown))}, null)"


def same_number(one: Column, other: Column, tolerance: float | None = None) -> Column:
    """Equal texts; or within the tolerance, or the relative one where a text is a double's."""
    a, b = one.try_cast("double"), other.try_cast("double")
    rough = one.rlike("[EIN]") | other.rlike("[EIN]")
    near = rough & (F.abs(a - b) <= TOLERANCE * F.greatest(F.abs(a), F.abs(b)))
    if tolerance is not None:
        fine = F.abs(F.try_subtract(one.try_cast("decimal(38,18)"), other.try_cast("decimal(38,18)"))) <= F.lit(str(tolerance)).try_cast("decimal(38,18)")
        near = near | F.coalesce(fine, F.abs(a - b) <= tolerance)
    return one.eqNullSafe(other) | F.coalesce(near, F.lit(False))


def row_sum_equals(columns: list[str], kinds: list[DataType], total: float | int | str) -> Column:
    """Whether the numbers of a row add up to `total`; null if one is missing."""
    values = [name(c) for c in columns]
    slow = _row_sum_equals(values, kinds, total)
    quick, wanted = [_quick(v, k) for v, k in zip(values, kinds)], Decimal(str(total))
    if any(q is None for q in quick) or not wanted.is_finite() or abs(wanted) >= 10**9:
        return F.expr(slow)
    is_million = wanted == wanted.quantize(Decimal("0.000001"))
    same = f"{' + '.join(units for _, units in quick)} = {int(wanted * MILLION)}L" if is_million else "false"
    return F.expr(f"case when {' and '.join(holds for holds, _ in quick)} then {same} else {slow} end")


def _row_sum_equals(values: list[str], kinds: list[DataType], total: float | int | str) -> str:
    wanted = Decimal(str(total))
    scaled = wanted.as_tuple()
    exact = "cast(null as boolean)"
    if wanted.is_finite() and wanted.adjusted() < 38 and scaled.exponent >= -(HEAD + TAIL):
        digits = int("".join(map(str, scaled.digits))) * 10 ** (scaled.exponent + HEAD + TAIL)
        rest, last = divmod(digits, 10**TAIL)
        sums = [f"cast('{-n if scaled.sign == 0 else n}' as {WHOLE})" for n in (*divmod(rest, 10**HEAD), last)]
        for v, kind in zip(values, kinds):
            sums = [f"try_add({a}, {b})" for a, b in zip(sums, _parts(v, kind))]
        zero = _let(_named(_carried("s.w", "s.h", "s.t")), "c", "(c.w = 0 and c.h = 0 and c.t = 0)")
        exact = _let(_named(tuple(sums)), "s", f"if(s.w is not null, {zero}, null)")
    rough, target = " + ".join(f"cast({v} as double)" for v in values), f"cast('{float(total)}' as double)"
    return f"coalesce({exact}, abs({rough} - {target}) <= {TOLERANCE}D * greatest(abs({rough}), abs({target})))"
