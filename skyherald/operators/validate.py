"""Rules over a table, all checked in one aggregation pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """`kind`: not_null, unique, min, max, above, isin or matches. Nulls only break not_null."""

    column: str
    kind: str
    value: object = None

    @property
    def name(self) -> str:
        return self.kind if self.value is None else f"{self.kind} {self.value}"

    def broken(self, allow: tuple = ()) -> Column:
        c = F.col(self.column)
        bad = {
            "not_null": lambda: c.isNull(),
            "min": lambda: c < self.value,
            "max": lambda: c > self.value,
            "above": lambda: c <= self.value,
            "isin": lambda: ~c.isin(*self.value),
            "matches": lambda: ~c.rlike(self.value),
        }[self.kind]()
        return bad & ~c.isin(*allow) if allow and self.kind in ("min", "max", "above") else bad


def between(column: str, low: float, high: float) -> list[Rule]:
    return [Rule(column, "not_null"), Rule(column, "min", low), Rule(column, "max", high)]


# fixed values: the declared ranges of notices and alerts
NOTICE_RULES = [
    *[Rule(c, "not_null") for c in ("observatory", "instrument", "event", "ivorn", "triggerId", "raw_event")],
    Rule("triggerId", "unique"),
    *between("ra", 0.0, 360.0), *between("dec", -90.0, 90.0),
    Rule("err_arcmin", "not_null"), Rule("err_arcmin", "min", 0.0),
    Rule("triggerTimejd", "not_null"), Rule("triggerTimejd", "min", 0.0),
    Rule("triggerTimeUTC", "not_null"),
]
ALERT_RULES = [
    *between("candidate.ssdistnr", 0.0, 30.0), *between("candidate.distpsnr1", 0.0, 30.0),
    *between("candidate.neargaia", 0.0, 90.0), *between("candidate.ra", 0.0, 360.0),
    *between("candidate.dec", -90.0, 90.0), Rule("candidate.jdstarthist", "min", 0.0),
    Rule("candidate.ndethist", "min", 0), *between("candidate.drb", 0.0, 1.0),
    *between("candidate.classtar", 0.0, 1.0), *between("candidate.magpsf", 8.0, 23.0),
    *between("candidate.diffmaglim", 8.0, 23.0), Rule("candidate.jd", "above", 0.0),
    Rule("candidate.fid", "isin", (1, 2, 3)), Rule("objectId", "matches", "^ZTF[0-9]{2}[a-z]{7}"),
    Rule("candid", "above", 0), Rule("candid", "unique"), Rule("cdsxmatch", "not_null"), *between("roid", 0, 3),
    *between("rf_snia_vs_nonia", 0.0, 1.0), *between("snn_snia_vs_nonia", 0.0, 1.0),
    *between("snn_sn_vs_all", 0.0, 1.0), *between("mulens", 0.0, 1.0), *between("rf_kn_vs_nonkn", 0.0, 1.0),
]


def validate(df: DataFrame, rules: list[Rule], allow: tuple = ()) -> DataFrame:
    """(column, rule, checked, violations), one row per rule.

    `allow` lists sentinels such as -999 that range rules accept. Row rules are one partial aggregate; only a
    uniqueness rule shuffles its column, and repeated values are reduced before that.
    """
    uniques = [r for r in rules if r.kind == "unique"]
    checks = [r for r in rules if r.kind != "unique"]
    row = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(r.broken(allow)).alias(f"v{i}") for i, r in enumerate(checks)]
    )
    report = row.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(r.column).alias("column"), F.lit(r.name).alias("rule"), F.col("n").alias("checked"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, r in enumerate(checks)
        ]))
    ) if checks else None
    for r in uniques:
        one = (
            df.groupBy(F.col(r.column).alias("k")).agg(F.count(F.lit(1)).alias("c"))
            .agg(F.coalesce(F.sum("c"), F.lit(0)).alias("checked"), F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("violations"))
            .select(F.lit(r.column).alias("column"), F.lit(r.name).alias("rule"), "checked", "violations")
        )
        report = one if report is None else report.unionByName(one)
    return report
