"""Quality rules learned as an ordered decision list, and the text statistics they read.

Only DataFrame functions; no Python on the executors.

Learning is sequential covering. Labelled statistics are cut at quantiles into bins. A rule grows by
one threshold at a time, the one with the largest FOIL gain over the rows not covered yet; every step
is one grouped count of (feature, bin, label), a few hundred rows whatever the size of the table. It
is then pruned to the prefix that does best on held-out rows, and taken if it is precise there. Rows
it covers leave; the next rule starts. The list becomes one conditional expression.

The labelled rows are a sample of about `max_labelled`, dealt by a hash of the document id; all counts
the rules read are of whole texts. The verdict itself is a narrow expression over all rows: nothing
is shuffled.

Defined results: a null or empty text has no words; repeated labels count once each; labels without a
document, and null labels, are left out; with no labels, or no rule that is precise enough, there are no
rules and nothing is rejected. Extra columns are kept, but for those with the names of the statistics,
which are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import store

SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What the rules may test, from the statistics alone.
FEATURES = {
    "words": "cast(n_words as double)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_char": "n_symbols / greatest(word_chars, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
}
MAX_LABELLED = 20_000


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often it is used inside."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur twice or more, each word once."""

    def of_hashes(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))), of_sorted)
        )

    def of_sorted(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]))
        return _let(F.array_sort(F.transform(same, lambda x: x["at"])), covered)

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(_let(hashes, of_hashes))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with STATISTICS, all long."""
    said = F.coalesce(F.col(text), F.lit(""))
    plain = F.translate(said, SPACE[1:], " " * (len(SPACE) - 1))
    words = F.filter(F.split(plain, " "), lambda w: w != "")
    solid = F.translate(said, SPACE, "")
    lines = F.filter(F.split(said, "\n"), lambda x: F.translate(x, SPACE, "") != "")
    counts = _let(words, lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    twice = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    found = docs.withColumn("_counts", counts)
    return found.withColumns({
        "n_words": F.col("_counts")["n_words"].cast("long"),
        "word_chars": F.char_length(solid).cast("long"),
        "n_symbols": (F.char_length(solid) - F.char_length(F.translate(solid, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": twice.cast("long"),
        "n_repeat_words": F.col("_counts")["n_repeat_words"].cast("long"),
    }).drop("_counts")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    limit: float

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.limit:.6g}"

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.limit if self.above else value <= self.limit


@dataclass(frozen=True)
class Rule:
    tests: tuple[Test, ...]
    bad: int = 0  # held-out rows that it covers
    good: int = 0

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests))

    def column(self) -> Column:
        both = F.lit(True)
        for test in self.tests:
            both = both & test.column()
        return both


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def column(self) -> Column:
        """The first rule that fits, as text; null if the row is kept."""
        chain = None
        for rule in self.rules:
            chain = (F if chain is None else chain).when(rule.column(), F.lit(str(rule)))
        return F.lit(None).cast("string") if chain is None else chain.otherwise(F.lit(None))


def labelled_statistics(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """FEATURES, `bad` and `held` (kept out of growing) of a sample of the labelled rows."""
    given = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    given = given.select(F.col(key).alias("_key"), (F.col(label) == 0).alias("bad"))
    share = max_labelled / max(given.count(), 1)
    place = F.shiftrightunsigned(F.xxhash64("_key"), 11) / float(1 << 53)  # in [0, 1)
    given = given.where(place < share)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(given), "_key")
    rows = with_statistics(rows, "_text").withColumn("held", F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(3)) == 0)
    return store(rows.select("bad", "held", *[F.expr(e).alias(n) for n, e in FEATURES.items()]), "labelled-statistics")


def _gain(bad: int, good: int, bad0: int, good0: int) -> float:
    """FOIL gain of covering (bad, good) out of (bad0, good0)."""
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0))) if bad else -math.inf


def learn(
    stats: DataFrame, bins: int = 64, max_rules: int = 8, max_tests: int = 3, min_precision: float = 0.9, min_held: int = 5
) -> DecisionList:
    """A decision list from rows of `labelled_statistics`."""
    names = list(FEATURES)
    points = [i / bins for i in range(1, bins)]
    cuts = stats.agg(*[F.percentile_approx(n, points, 10_000).alias(n) for n in names]).first()
    cuts = {n: sorted({*(cuts[n] or [])}) for n in names}

    def bin_of(name: str) -> Column:
        below = F.filter(F.array(*map(F.lit, cuts[name])), lambda cut: cut < F.col(name))
        return (F.size(below) if cuts[name] else F.lit(0)).alias(name)

    binned = store(stats.select("bad", "held", *map(bin_of, names)), "binned-statistics")  # value > cut[k] as bin > k

    def covers(tests: list[Test]) -> Column:
        both = F.lit(True)
        for t in tests:
            k = cuts[t.feature].index(t.limit)
            both = both & (F.col(t.feature) > k if t.above else F.col(t.feature) <= k)
        return both

    def tally(rows: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        cells = rows.select("bad", F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(n).alias("b")) for n in names])).alias("x"))
        found = cells.groupBy("x.f", "x.b").agg(F.count_if("bad").alias("bad"), F.count("*").alias("n")).collect()
        return {(r["f"], r["b"]): (r["bad"], r["n"] - r["bad"]) for r in found}  # at most len(names) * bins rows

    def grow(rows: DataFrame) -> list[Test]:
        tests: list[Test] = []
        while len(tests) < max_tests:
            cell = tally(rows.where(covers(tests)))
            bad0 = sum(v[0] for (f, _), v in cell.items() if f == names[0])
            good0 = sum(v[1] for (f, _), v in cell.items() if f == names[0])
            if not bad0 or not good0:
                break
            best, most = None, 0.0
            for f in names:
                bad = good = 0
                for k, cut in enumerate(cuts[f]):
                    one, other = cell.get((f, k), (0, 0))
                    bad, good = bad + one, good + other
                    for above, b, g in ((False, bad, good), (True, bad0 - bad, good0 - good)):
                        gain = _gain(b, g, bad0, good0)
                        if gain > most + 1e-9:
                            best, most = Test(f, above, cut), gain
            if best is None:
                break
            tests.append(best)
        return tests

    def prune(tests: list[Test], rows: DataFrame) -> Rule | None:
        sums = []
        for n in range(1, len(tests) + 1):
            sums += [F.count_if(covers(tests[:n]) & F.col("bad")), F.count_if(covers(tests[:n]) & ~F.col("bad"))]
        found = rows.agg(*sums).first()
        scored = [(found[2 * n], found[2 * n + 1]) for n in range(len(tests))]
        n = max(range(len(tests)), key=lambda i: ((scored[i][0] - scored[i][1]) / max(sum(scored[i]), 1), -i))
        bad, good = scored[n]
        if bad < min_held or bad < min_precision * (bad + good):
            return None
        return Rule(tuple(tests[: n + 1]), bad, good)

    def with_margin(rule: Rule) -> Rule:
        """Limits half way to the nearest covered value, so that a rule does not cut right at the rows it spares."""
        covered = F.lit(True)
        for t in rule.tests:
            covered = covered & (F.col(t.feature) > t.limit if t.above else F.col(t.feature) <= t.limit)
        near = stats.where(covered).agg(*[(F.min if t.above else F.max)(t.feature) for t in rule.tests]).first()
        return replace(rule, tests=tuple(replace(t, limit=(t.limit + x) / 2) for t, x in zip(rule.tests, near)))

    rules = DecisionList()
    grown, held = binned.where("not held"), binned.where("held")
    while len(rules.rules) < max_rules:
        tests = grow(grown)
        rule = prune(tests, held) if tests else None
        if rule is None:
            break
        rules.rules.append(with_margin(rule))
        grown, held = grown.where(~covers(list(rule.tests))), held.where(~covers(list(rule.tests)))
    return rules


def apply_rules(docs: DataFrame, rules: DecisionList, text: str = "text") -> DataFrame:
    """The rows with STATISTICS, `base_failed`, `rule` (that rejects the row, or null) and `kept`."""
    rows = with_statistics(docs, text).withColumn("base_failed", base_failed()).withColumn("rule", rules.column())
    return rows.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
