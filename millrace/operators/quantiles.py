"""Exact quantiles by narrowing brackets: no sort, no value map, no list of values on the driver.

One scan sketches all columns (mergeable KLL sketches). After that, every scan serves all ranks of all
columns at once: it counts the pieces that a sketch proposes around each rank, then sketches the piece
that holds the rank. A sketch of at most as many values as it has room for holds them all, so it gives
the value itself. Three scans do for some 20 million rows, each further pair for 300 times as many.
"""

from __future__ import annotations

import math
from collections.abc import Generator
from decimal import Decimal, localcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.exact import name

FIRST = 65_535  # room of the one sketch per column
HOLD = 8_192  # room of a sketch per rank

Search = Generator[list[str], list, object]  # yields SQL of aggregates, is sent their values


def _marks(place: float, hold: int) -> list[float]:
    """The place and both ends of twice the error that a sketch of this room keeps to in 99 of 100 cases."""
    slack = 2 * 2.296 / hold**0.9021
    return [max(0.0, place - slack), place, min(1.0, place + slack)]


class _Kind:
    """A column as a number that sketches know: long for whole numbers and short decimals, else double.

    Doubles keep the order of wide decimals but not their digits, so these are searched again among
    the values that share a double.
    """

    def __init__(self, df: DataFrame, column: str):
        field = df.schema[column].dataType
        self.value, self.scale, self.wide = name(column), 0, False
        self.real = False
        if field.typeName() in {"byte", "short", "integer", "long"}:
            self.key = f"cast({self.value} as bigint)"
        elif field.typeName().startswith("decimal") and field.precision <= 18:
            self.scale = field.scale
            self.key = f"cast({self.value} * cast('1{'0' * field.scale}' as decimal({field.scale + 1},0)) as bigint)"
        else:
            self.real = True
            double = f"cast({self.value} as double)"
            self.key = f"nullif({double}, cast('NaN' as double))"
            self.wide = field.typeName().startswith("decimal")
            self.type, self.scale = field.simpleString(), getattr(field, "scale", 0)
        self.exact = not self.real or self.wide

    def lit(self, x) -> str:
        return f"cast('{x!r}' as double)" if self.real else f"cast('{x}' as bigint)"

    def decimal(self, x: Decimal) -> str:
        return f"cast('{x:f}' as {self.type})"

    def before(self, x):
        return math.nextafter(x, -math.inf) if self.real else x - 1

    def after(self, x):
        return math.nextafter(x, math.inf) if self.real else x + 1

    def sketch(self, key: str, hold: int, marks: list[float]) -> str:
        """The values at these places; null if there is no row."""
        t = "double" if self.real else "bigint"
        at = ", ".join(f"{m!r}D" for m in marks)
        return f"case when count({key}) > 0 then kll_sketch_get_quantile_{t}(kll_sketch_agg_{t}({key}, {hold}), array({at})) end"

    def back(self, x):
        if self.real:
            return x + 0.0  # no negative zero
        return Decimal(x).scaleb(-self.scale) if self.scale else x

    def between(self, lo, hi, share: float):
        if lo == hi:
            return lo
        if not self.exact:
            return lo + (hi - lo) * share
        with localcontext() as wide:
            wide.prec = 60
            return Decimal(lo) + Decimal(hi - lo) * Decimal(share)


def exact_quantiles(df: DataFrame, column: str, probs: list[float], hold: int = HOLD) -> tuple[int, list]:
    """(non-null rows, linearly interpolated quantiles); those of whole numbers and decimals are exact decimals."""
    return exact_quantiles_of(df, [(column, probs)], hold)[0]


def exact_quantiles_of(df: DataFrame, wanted: list[tuple[str, list[float]]], hold: int = HOLD) -> list[tuple[int, list]]:
    """`exact_quantiles` of several columns, which share their scans. NaN counts as missing."""
    hold = min(FIRST, max(8, hold))
    kinds = [_Kind(df, column) for column, _ in wanted]
    first = max(hold, FIRST if hold == HOLD else 8)
    starts = _together(df, [_start(kind, probs, first) for kind, (_, probs) in zip(kinds, wanted)])
    searches: dict[tuple, Search] = {}
    spots = []
    for i, (kind, (_, probs), (n, low, high, guesses)) in enumerate(zip(kinds, wanted, starts)):
        spots.append([p * (n - 1) for p in probs] if n else [])
        for spot, guess in zip(spots[i], guesses or []):
            for rank in {math.floor(spot), math.ceil(spot)}:
                searches.setdefault((i, rank), _value(kind, rank, n, low, high, guess, hold))
    found = dict(zip(searches, _together(df, list(searches.values()))))
    return [
        (n, [kind.between(found[i, math.floor(s)], found[i, math.ceil(s)], s - math.floor(s)) for s in spots[i]] if n else [None] * len(probs))
        for i, (kind, (_, probs), (n, *_)) in enumerate(zip(kinds, wanted, starts))
    ]


def _scan(df: DataFrame, sqls: list[str]) -> list:
    return list(df.agg(*[F.expr(s).alias(f"a{i}") for i, s in enumerate(sqls)]).first())


def _together(df: DataFrame, searches: list[Search]) -> list:
    """Runs searches side by side: one scan answers what all of them ask next."""
    results: list = [None] * len(searches)
    asked: dict[int, list[str]] = {}

    def step(i: int, answer: list | None) -> None:
        try:
            asked[i] = searches[i].send(answer)
        except StopIteration as end:
            results[i] = end.value

    for i in range(len(searches)):
        step(i, None)
    while asked:
        sqls = list(dict.fromkeys(s for questions in asked.values() for s in questions))
        answers = dict(zip(sqls, _scan(df, sqls)))
        turn, asked = asked, {}
        for i, questions in turn.items():
            step(i, [answers[s] for s in questions])
    return results


def _start(kind: _Kind, probs: list[float], hold: int) -> Search:
    """Rows, lowest and highest key, and per probability what the sketch proposes."""
    marks = [m for p in probs for m in _marks(p, hold)]
    n, low, high, at = yield [
        f"count({kind.key})", f"min({kind.key})", f"max({kind.key})", kind.sketch(kind.key, hold, marks),
    ]
    return n, low, high, at and [at[i : i + 3] for i in range(0, len(at), 3)]


def _rank(kind: _Kind, key: str, rank: int, rows: int, lo, hi, guess: list | None, hold: int) -> Search:
    """The key at a rank (from 0) among `rows` keys, all within lo..hi.

    Each turn takes one of five pieces, all smaller than lo..hi, so the search ends whatever the
    sketch proposes; and a value that fills a piece alone, however often it occurs, ends it at once.
    """
    while lo < hi:
        if guess is None:
            inside = f"case when {key} between {kind.lit(lo)} and {kind.lit(hi)} then {key} end"
            (guess,) = yield [kind.sketch(inside, hold, _marks((rank + 0.5) / rows, hold))]
            if rows <= hold:
                return guess[1]
        a, m, b = guess
        pieces = [(lo, kind.before(a)), (a, kind.before(m)), (m, m), (kind.after(m), b), (kind.after(b), hi)]
        counts = yield [f"count_if({key} between {kind.lit(x)} and {kind.lit(y)})" for x, y in pieces]
        for (lo, hi), rows in zip(pieces, counts):
            if rank < rows:
                break
            rank -= rows
        guess = None
    return lo


def _value(kind: _Kind, rank: int, rows: int, lo, hi, guess: list, hold: int) -> Search:
    """The column's value at a rank; wide decimals by the distance from the least value that shares a double."""
    found = yield from _rank(kind, kind.key, rank, rows, lo, hi, guess, hold)
    if not kind.wide:
        return kind.back(found)
    key, within, ends = kind.key, "true", None
    while True:
        same = f"{within} and {key} = {kind.lit(found)}"
        low, high, under, rows = yield [
            f"min(case when {same} then {kind.value} end)", f"max(case when {same} then {kind.value} end)",
            f"count_if({within} and {key} < {kind.lit(found)})", f"count_if({same})",
        ]
        if low == high:
            return low
        rank -= under
        within = f"{kind.value} between {kind.decimal(low)} and {kind.decimal(high)}"
        if (low, high) == ends:  # a distance of 38 digits loses the last of them
            with localcontext() as wide:
                wide.prec = 60
                middle = low + ((high - low) / 2).quantize(Decimal(1).scaleb(-kind.scale), "ROUND_DOWN")
            distance = f"if({kind.value} > {kind.decimal(middle)}, 1D, 0D)"
        else:
            distance = f"cast({kind.value} - {kind.decimal(low)} as double)"
        ends, key = (low, high), f"case when {within} then {distance} end"
        lo, hi = yield [f"min({key})", f"max({key})"]
        found = yield from _rank(kind, key, rank, rows, lo, hi, None, hold)
