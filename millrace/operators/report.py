"""All checks of a task as one report, and the rows they reject.

Row, total, schema and quantile checks share one aggregate over the table, whatever their number.
Key checks add one grouped scan per column set, sets from a table one join, order checks one window per order. The report is
a union of one-row frames, so it is a single Spark job; nothing but its rows reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.config import CheckRow
from millrace.functions.columns import nan_to_null
from millrace.operators import rules as R
from millrace.operators.mapping import many_to_one_summary, one_to_one_summary
from millrace.operators.order import flag_out_of_order
from millrace.operators.quantiles import exact_quantiles_of
from millrace.operators.reconcile import Recon, compare_column_count, compare_schema, reconcile_totals
from millrace.operators.skew import HOT_KEYS, fits_broadcast, join_unique
from millrace.session import store

REPORT_COLUMNS = [
    "seq_no", "check", "type", "column", "element_count", "missing_count", "unexpected_count",
    "unexpected_percent", "threshold", "result", "threshold_violated", "good_records_count",
    "bad_records_count", "details",
]
CUSTOM = {"reconciliation", "column_count_comparison", "schema_comparison", "one_to_one_mapping", "multi_to_one_mapping"}
BROADCAST_KEYS = 500_000


def _fact(row: CheckRow, column: str, n, missing, unexpected, success, details, by_row=False) -> Column:
    """What a check found, as a struct of fixed type."""
    def long(x):
        return (F.lit(None) if x is None else x).cast("long")

    return F.struct(
        F.lit(row.seq_no).alias("seq_no"),
        F.lit(row.check).alias("check"),
        F.lit(row.type).alias("type"),
        F.lit(column or None).cast("string").alias("column"),
        long(n).alias("element_count"),
        long(missing).alias("missing_count"),
        long(unexpected).alias("unexpected_count"),
        (F.lit(success) if isinstance(success, bool) or success is None else success).cast("boolean").alias("_success"),
        (F.lit(details) if details is None or isinstance(details, str) else details).cast("string").alias("details"),
        F.lit(row.threshold).cast("double").alias("threshold"),
        F.lit(row.ignore_bad_records).alias("_ignore"),
        F.lit(by_row).alias("_by_row"),
        F.lit(row.check in CUSTOM).alias("_custom"),
    )


def _percent(unexpected: Column, n: Column, missing: Column) -> Column:
    return F.when(n - missing > 0, unexpected * F.lit(100.0) / (n - missing)).otherwise(F.lit(0.0))


@dataclass
class CheckRun:
    """Checks bound to a frame. `source` is the other side of cross-frame checks."""

    df: DataFrame
    checks: list[CheckRow]
    source: DataFrame | None = None
    audit_columns: bool = True
    rules: dict[int, object] = field(default_factory=dict)
    _repeated: dict[tuple, DataFrame] = field(default_factory=dict)
    _members: dict[int, DataFrame] = field(default_factory=dict)

    def __post_init__(self):
        seen = [c.seq_no for c in self.checks]
        if len(seen) != len(set(seen)):
            raise ValueError("seq_no must be unique")
        for row in self.active:
            if row.check not in CUSTOM:
                self.rules[row.seq_no] = R.build_rule(self.df, row.check, row.params)

    @property
    def active(self) -> list[CheckRow]:
        return [c for c in self.checks if c.active]

    # ------------------------------------------------------------ metrics

    @cached_property
    def facts(self) -> DataFrame:
        frames = [self._fused(), *self._keys(), *self._sets(), *self._orders(), *self._custom()]
        return reduce(DataFrame.unionByName, [f for f in frames if f is not None])

    def _of(self, kind):
        return [(c, self.rules[c.seq_no]) for c in self.active if isinstance(self.rules.get(c.seq_no), kind)]

    def _fused(self) -> DataFrame:
        """One aggregate for all checks that need no grouping."""
        n = F.col("_n")
        totals, facts = [F.count(F.lit(1)).alias("_n")], []
        for row, rule in self._of(R.RowRule):
            i = row.seq_no
            missing = rule.missing if rule.missing is not None else R.no()
            totals += [F.count_if(missing).alias(f"m{i}"), F.count_if(rule.unexpected).alias(f"u{i}")]
            m, u = F.col(f"m{i}"), F.col(f"u{i}")
            success = u == 0
            if rule.mostly is not None:
                success = success | F.coalesce((n - m - u) / F.nullif(n - m, F.lit(0)) >= rule.mostly, F.lit(True))
            facts.append(_fact(row, rule.column, n, m, u, success, None, by_row=True))
        for row, rule in self._of(R.TotalRule):
            i = row.seq_no
            totals += [v.alias(f"t{i}_{k}") for k, v in rule.totals.items()]
            m = None
            if rule.missing is not None:
                totals.append(F.count_if(rule.missing).alias(f"m{i}"))
                m = F.col(f"m{i}")
            got = {k: F.col(f"t{i}_{k}") for k in rule.totals}
            facts.append(_fact(row, rule.column, n, m, None, rule.success(got), rule.details(got) if rule.details else None))
        for row, rule in self._of(R.SchemaRule):
            facts.append(_fact(row, rule.column, n, None, None, rule.ok, rule.details))
        for row, rule in self._of(R.QuantileRule):
            m, success, details = self._quantile(row, rule, n)
            facts.append(_fact(row, rule.column, n, m, None, success, details))
        for row in self.active:
            ok = None
            if row.check == "column_count_comparison":
                ok = compare_column_count(self._other(row), self.df, self.audit_columns)
            elif row.check == "schema_comparison":
                ok = compare_schema(self._other(row), self.df, self.audit_columns)
            if ok is not None:
                facts.append(_fact(row, "", n, None, None, *ok))
        for row in self.checks:
            if not row.active:
                facts.append(_fact(row, "", None, None, None, None, None))
        if not facts:
            empty = _fact(CheckRow(0, "none"), "", n, None, None, None, None)
            return self.df.limit(0).agg(*totals).select(F.inline(F.array(empty))).where(F.lit(False))
        return self.df.agg(*totals).select(F.inline(F.array(*facts)))

    @cached_property
    def _quantile_values(self) -> dict[int, tuple]:
        """(known rows, values) by check; the checks share their scans, whatever their columns."""
        members = self._of(R.QuantileRule)
        exact = [(row.seq_no, rule) for row, rule in members if not rule.approximate]
        rough = [(row.seq_no, rule) for row, rule in members if rule.approximate]
        out = dict(zip((i for i, _ in exact), exact_quantiles_of(self.df, [(r.column, r.probs) for _, r in exact])))
        if rough:
            totals = []
            for _, rule in rough:
                column = F.col(rule.column).cast("double")
                totals += [F.count(column), F.percentile_approx(column, rule.probs, 10_000)]
            got = list(self.df.agg(*[t.alias(f"a{k}") for k, t in enumerate(totals)]).first())
            for k, (i, rule) in enumerate(rough):
                out[i] = (got[2 * k], got[2 * k + 1] or [None] * len(rule.probs))
        return out

    def _quantile(self, row: CheckRow, rule: R.QuantileRule, n: Column):
        known, values = self._quantile_values[row.seq_no]
        ok = all(
            v is None or ((lo is None or v >= lo) and (hi is None or v <= hi)) for v, (lo, hi) in zip(values, rule.ranges)
        )
        return n - F.lit(known), ok, ",".join("" if v is None else f"{v:.4f}" for v in values)

    def _keys(self) -> list[DataFrame]:
        """One grouped scan per set of columns, shared by all checks on it."""
        groups: dict[tuple, list] = {}
        for row, rule in self._of(R.KeyRule):
            groups.setdefault((tuple(rule.columns), str(rule.skip)), []).append((row, rule))
        frames = []
        for (columns, _), members in groups.items():
            counts = self._counts(members[0][1])
            plain = [(row, rule) for row, rule in members if rule.by_count is None]
            if plain:
                totals = [
                    F.coalesce(F.sum("cnt"), F.lit(0)).alias("_n"),
                    F.coalesce(F.sum(F.when(F.col("_skip"), F.col("cnt"))), F.lit(0)).alias("_m"),
                    F.coalesce(F.sum(F.when(~F.col("_skip") & (F.col("cnt") > 1), F.col("cnt"))), F.lit(0)).alias("_u"),
                ]
                facts = []
                for row, rule in plain:
                    totals += [v.alias(f"t{row.seq_no}_{k}") for k, v in rule.summary.items()]
                    got = {k: F.col(f"t{row.seq_no}_{k}") for k in rule.summary}
                    if rule.repeated_is_bad:
                        fine = F.col("_u") == 0
                        if rule.mostly is not None:
                            known = F.nullif(F.col("_n") - F.col("_m"), F.lit(0))
                            fine = fine | ((known - F.col("_u")) / known >= rule.mostly)
                        facts.append(_fact(row, rule.column, F.col("_n"), F.col("_m"), F.col("_u"), fine, None, by_row=True))
                    else:
                        ok = F.coalesce(rule.success(got), F.lit(True))
                        facts.append(_fact(row, rule.column, F.col("_n"), F.col("_m"), None, ok, rule.details(got)))
                frames.append(counts.agg(*totals).select(F.inline(F.array(*facts))))
            for row, rule in members:
                if rule.by_count is not None:
                    frames.append(self._by_count(row, rule, counts))
        return frames

    def _counts(self, rule: R.KeyRule) -> DataFrame:
        return self.df.groupBy(*rule.columns).agg(F.count(F.lit(1)).alias("cnt")).withColumn("_skip", rule.skip)

    def _by_count(self, row: CheckRow, rule: R.KeyRule, counts: DataFrame) -> DataFrame:
        levels = counts.groupBy("cnt", "_skip").agg(
            F.count(F.lit(1)).alias("values"), F.count_if(rule.by_count).alias("good")
        )
        weight = F.col("cnt") * F.col("values")
        top = F.max(F.when(~F.col("_skip"), F.struct("cnt", "values", "good"))).alias("top")
        one = levels.agg(
            F.coalesce(F.sum(weight), F.lit(0)).alias("_n"),
            F.coalesce(F.sum(F.when(F.col("_skip"), weight)), F.lit(0)).alias("_m"),
            top,
        )
        got = {k: F.col(f"top.{k}") for k in ("cnt", "values", "good")}
        ok = F.coalesce(rule.success(got), F.lit(True))
        return one.select(F.inline(F.array(_fact(row, rule.column, F.col("_n"), F.col("_m"), None, ok, rule.details(got)))))

    def _set(self, row: CheckRow, rule: R.SetRule) -> DataFrame:
        """The members of a set, stored, so that the report and the split see the same ones."""
        if row.seq_no not in self._members:
            self._members[row.seq_no] = store(rule.members, "members")
        return self._members[row.seq_no]

    def _sets(self) -> list[DataFrame]:
        """Sets that come from a table. A small set that only rows are held against is broadcast and the rows
        do not move; else both sides meet with one row per value, so no value is hot."""
        frames = []
        for row, rule in self._of(R.SetRule):
            members = self._set(row, rule).withColumn("_listed", F.lit(True))
            value = F.col(rule.column)
            rows, how = self.df.select(rule.column), "full"
            if rule.test in {"in", "not_in", "within"}:
                members, how = members.where("_member is not null"), "left"
            if how == "left" and fits_broadcast(members):
                rows, members = rows.withColumn("cnt", F.lit(1)), F.broadcast(members)
            else:
                rows, members = rows.groupBy(rule.column).agg(F.count(F.lit(1)).alias("cnt")), members.hint("merge")
            met = rows.join(members, value == F.col("_member"), how)
            inside, known = F.col("_listed").isNotNull(), value.isNotNull()

            def total(when: Column, name: str) -> Column:
                return F.coalesce(F.sum(F.when(when, F.col("cnt"))), F.lit(0)).alias(name)

            one = met.agg(
                F.coalesce(F.sum("cnt"), F.lit(0)).alias("_n"), total(~known & F.col("cnt").isNotNull(), "_m"),
                total(known & inside, "_in"), total(known & ~inside, "_out"),
                F.count_if(known & inside).alias("_found"), F.count_if(inside).alias("_size"),
            )
            n, m, out = F.col("_n"), F.col("_m"), F.col("_out")
            if rule.by_row:
                u = out if rule.test == "in" else F.col("_in")
                fine = u == 0
                if rule.mostly is not None:
                    fine = fine | F.coalesce((n - m - u) / F.nullif(n - m, F.lit(0)) >= rule.mostly, F.lit(True))
                fact = _fact(row, rule.column, n, m, u, fine, None, by_row=True)
            else:
                whole = F.col("_found") == F.col("_size")
                ok = {"within": out == 0, "contain": whole, "equal": whole & (out == 0)}[rule.test]
                text = F.concat(F.lit("rows outside "), out.cast("string")) if how == "left" else \
                    R.set_details(F.col("_found"), F.col("_size"), out)
                fact = _fact(row, rule.column, n, m, None, ok, text)
            frames.append(one.select(F.inline(F.array(fact))))
        return frames

    def _flag_set(self, df: DataFrame, row: CheckRow, rule: R.SetRule, mark: str) -> DataFrame:
        members = self._set(row, rule).where("_member is not null").select(F.col("_member").alias(f"_k{mark}"))
        listed = members.withColumn(f"_listed{mark}", F.lit(True))
        out = join_unique(df, listed, {rule.column: f"_k{mark}"})
        inside = F.col(f"_listed{mark}").isNotNull()
        broken = F.col(rule.column).isNotNull() & (inside if rule.test == "not_in" else ~inside)
        return out.withColumn(mark, broken).drop(f"_k{mark}", f"_listed{mark}")

    def _orders(self) -> list[DataFrame]:
        frames = []
        for row, rule in self._of(R.OrderRule):
            needed = list(dict.fromkeys([rule.column, *rule.order_by, *rule.partition_by]))
            flagged = self._order_flag(self.df.select(*needed), rule, "_bad")
            one = flagged.agg(
                F.count(F.lit(1)).alias("_n"),
                F.count_if(F.col(rule.column).isNull()).alias("_m"),
                F.count_if("_bad").alias("_u"),
            )
            fact = _fact(row, rule.column, F.col("_n"), F.col("_m"), F.col("_u"), F.col("_u") == 0, None, by_row=True)
            frames.append(one.select(F.inline(F.array(fact))))
        return frames

    @cached_property
    def _rows(self) -> int:
        return self.df.count()

    def _order_flag(self, df: DataFrame, rule: R.OrderRule, flag: str) -> DataFrame:
        return flag_out_of_order(
            df, rule.column, rule.order_by, rule.partition_by, flag, rule.decreasing, rule.strictly, rule.rows_per_bucket, self._rows
        )

    def _other(self, row: CheckRow) -> DataFrame:
        if self.source is None:
            raise ValueError(f"check {row.check!r} compares with a source frame, none was given")
        return self.source

    def _custom(self) -> list[DataFrame]:
        frames, recons = [], []
        for row in self.active:
            p = row.params
            if row.check == "reconciliation":
                recons.append((row, Recon(row.seq_no, p["aggregation"], p["source_column"], p["target_column"], p.get("tolerance"))))
            elif row.check == "one_to_one_mapping":
                a, b = p["column_A"], p["column_B"]
                ok = (F.col("max_b_per_a") <= 1) & (F.col("max_a_per_b") <= 1)
                text = F.when(~ok, F.concat_ws(" ", F.lit("most partners"), F.col("max_b_per_a").cast("string"), F.col("max_a_per_b").cast("string")))
                frames.append(one_to_one_summary(self.df, a, b).select(F.inline(F.array(_fact(row, f"{a},{b}", None, None, None, ok, text)))))
            elif row.check == "multi_to_one_mapping":
                a, b = p["column_A"], p["column_B"]
                where = self.source if self.source is not None else self.df
                n = F.col("row_count")
                ok = (n == F.col("distinct_pairs")) & (n == F.col("distinct_keys"))
                text = F.when(~ok, F.concat_ws(" ", F.lit("pairs"), F.col("distinct_pairs").cast("string"), F.lit("keys"), F.col("distinct_keys").cast("string")))
                frames.append(many_to_one_summary(where, a, b).select(F.inline(F.array(_fact(row, f"{a},{b}", n, None, None, ok, text)))))
        if recons:
            facts = []
            for row, r in recons:
                s, t, ok = (F.col(f"{x}{r.seq_no}") for x in ("s", "t", "ok"))
                text = F.when(~ok, F.concat(
                    F.lit(f"{r.kind} of source {r.source_column}: "), F.coalesce(s, F.lit("none")),
                    F.lit(f", of target {r.target_column}: "), F.coalesce(t, F.lit("none")),
                ))
                facts.append(_fact(row, f"{r.source_column},{r.target_column}", None, None, None, ok, text))
            totals = reconcile_totals(self._other(recons[0][0]), self.df, [r for _, r in recons])
            frames.append(totals.select(F.inline(F.array(*facts))))
        return frames

    # ------------------------------------------------------------ report

    def _judged(self, facts: DataFrame) -> DataFrame:
        n, u = F.col("element_count"), F.col("unexpected_count")
        percent = F.when(u.isNotNull(), _percent(u, n, F.coalesce("missing_count", F.lit(0))))
        judged = facts.withColumn("unexpected_percent", percent)
        p, limit, ok = F.col("unexpected_percent"), F.col("threshold"), F.col("_success")
        within = F.coalesce(F.floor(p) <= limit, F.lit(False))
        spoiled = ~ok & F.col("_ignore") & F.col("_by_row")
        bad = F.when(spoiled, u).otherwise(F.lit(0))
        return judged.withColumns({
            "result": F.when(ok | within, "PASS").when(ok.isNotNull(), "FAIL"),
            "threshold_violated": F.when(spoiled & F.coalesce(limit < p, F.lit(False)), "Y").otherwise("N"),
            "bad_records_count": F.when(ok.isNotNull() & ~F.col("_custom"), bad).cast("long"),
            "good_records_count": F.when(ok.isNotNull() & ~F.col("_custom"), n - bad).cast("long"),
        })

    @cached_property
    def judged(self) -> DataFrame:
        return self._judged(self.facts)

    @property
    def report(self) -> DataFrame:
        return self.judged.select(*REPORT_COLUMNS)

    @cached_property
    def results(self) -> list:
        """The report rows on the driver: as many as there are checks."""
        return self.judged.collect()

    def passed(self) -> bool:
        """Every active check passes; no checks pass."""
        return all(r["result"] == "PASS" for r in self.results if r["result"] is not None)

    def result_frame(self) -> DataFrame:
        """The collected report as a frame again, so a second use does not scan again."""
        spark = self.df.sparkSession
        rows = [tuple(r[c] for c in REPORT_COLUMNS) for r in self.results]
        return spark.createDataFrame(rows, self.report.schema)

    # ------------------------------------------------------------ rows

    def flagged(self, seq_nos: list[int] | None = None, name: str = "_dq_failed") -> DataFrame:
        """The frame with an array of the row checks that each row breaks."""
        out, marks = self.df, []
        for row in self.active:
            rule = self.rules.get(row.seq_no)
            if seq_nos is not None and row.seq_no not in seq_nos:
                continue
            mark = f"_bad{row.seq_no}"
            if isinstance(rule, R.RowRule):
                marks.append(F.when(rule.unexpected, F.lit(row.seq_no)))
            elif isinstance(rule, R.KeyRule) and rule.repeated_is_bad:
                out = self._flag_repeated(out, rule, mark)
                marks.append(F.when(F.col(mark), F.lit(row.seq_no)))
            elif isinstance(rule, R.SetRule) and rule.by_row:
                out = self._flag_set(out, row, rule, mark)
                marks.append(F.when(F.col(mark), F.lit(row.seq_no)))
            elif isinstance(rule, R.OrderRule):
                out = self._order_flag(out, rule, mark)
                marks.append(F.when(F.col(mark), F.lit(row.seq_no)))
        failed = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<int>")
        return out.withColumn(name, failed).select(*self.df.columns, name)

    def _flag_repeated(self, df: DataFrame, rule: R.KeyRule, mark: str) -> DataFrame:
        """Mark rows whose key occurs more than once.

        The repeated keys are counted once and kept in the shared folder. Few: they are broadcast and
        the rows do not move. Many: hot ones are broadcast and only the others are shuffled.
        """
        names = {c: f"_k{i}" for i, c in enumerate(rule.columns)}
        at = (tuple(rule.columns), str(rule.skip))
        if at not in self._repeated:
            counts = self._counts(rule).where("cnt > 1 and not _skip")
            self._repeated[at] = store(counts.select(*[F.col(c).alias(k) for c, k in names.items()], "cnt"), "repeated")
        repeated = self._repeated[at]
        n_keys, n_rows = repeated.agg(F.count(F.lit(1)), F.coalesce(F.sum("cnt"), F.lit(0))).first()
        small, hot = n_keys <= BROADCAST_KEYS and fits_broadcast(repeated), None  # keys may be long texts
        if not small:
            # At most HOT_KEYS keys can hold that share of the rows each.
            hot = repeated.where(F.col("cnt") >= max(2, n_rows // HOT_KEYS)).select(*[F.col(k).alias(c) for c, k in names.items()])
        marked = repeated.drop("cnt").withColumn(mark, F.lit(True))
        return join_unique(df, marked, names, null_safe=True, small=small, hot=hot).drop(*names.values())

    @cached_property
    def rejecting(self) -> list[int]:
        """Checks that reject rows: only if some check fails, then every unsuccessful row check that
        allows bad records, also one that its threshold lets pass."""
        if all(r["result"] != "FAIL" for r in self.results):
            return []
        return [r["seq_no"] for r in self.results if r["_by_row"] and r["_ignore"] and r["_success"] is False]

    def good(self) -> DataFrame:
        if not self.rejecting:
            return self.df
        return self.flagged(self.rejecting).where(F.size("_dq_failed") == 0).drop("_dq_failed")

    def bad(self) -> DataFrame:
        flagged = self.flagged(self.rejecting)
        return flagged.where(F.size("_dq_failed") > 0)


def run_checks(df: DataFrame, checks: list, source: DataFrame | None = None, type: str | None = None, audit_columns: bool = True) -> CheckRun:
    """Bind a check list to a frame. Lazy, but for exact quantiles, sets from a table and range cut points.

    NaN counts as missing, as it does in pandas, so it is null from here on.
    """
    rows = [CheckRow.of(c) for c in checks]
    if type is not None:
        rows = [r for r in rows if r.type == type]
    return CheckRun(nan_to_null(df), rows, source, audit_columns)
