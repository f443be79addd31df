"""Alerts: quality filter, pruning, histories, magnitude rates, classification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.functions import sky

NO_NEIGHBOUR = -999.0
# fixed values: never read, image stamps and bookkeeping
PRUNED = (
    "schemavsn", "publisher", "cutoutScience", "cutoutTemplate", "cutoutDifference", "year", "month", "day",
)


def alert_quality_filter(
    alerts: DataFrame, ast_dist: float = 5, ps_dist: float = 2, ps_score: float = 0.5, gaia_dist: float = 5
) -> DataFrame:
    """Alerts away from known asteroids, stars and Gaia sources; -999 means "no neighbour"."""

    def far(column: str, distance: float) -> Column:
        return (F.col(column) > distance) | (F.col(column) == NO_NEIGHBOUR)

    return alerts.filter(
        far("candidate.ssdistnr", ast_dist)
        & (far("candidate.distpsnr1", ps_dist) | (F.col("candidate.sgscore1") < ps_score))
        & far("candidate.neargaia", gaia_dist)
    )


def alert_prune(alerts: DataFrame) -> DataFrame:
    """Drop image stamps, bookkeeping and partition columns (the alert id stays in `candidate`)."""
    return alerts.drop("candid", *PRUNED)


def alert_position(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns({"ztf_ra": F.col("candidate.ra"), "ztf_dec": F.col("candidate.dec")})


HISTORY = ("magpsf", "diffmaglim", "jd", "fid")


def history_concat(alerts: DataFrame, fields=HISTORY) -> DataFrame:
    """c<field> = history values, then the current one."""

    def joined(f: str) -> Column:
        now = F.array(F.col(f"candidate.{f}"))
        return F.concat(F.coalesce(F.col(f"prv_candidates.{f}"), F.slice(now, 1, 0)), now)

    return alerts.withColumns({f"c{f}": joined(f) for f in fields})


def mag_rate(
    mag: Column, jdstarthist: Column, jd: Column, fid: Column,
    hist_mag: Column, hist_lim: Column, hist_jd: Column, hist_fid: Column,
) -> Column:
    """struct(abs_rate, norm_rate, first_variation_time, diff_start_hist, from_upper).

    Compares the alert with the previous measurement in its own filter (an upper limit where there was no
    detection). The history arrays end with the alert itself; a missing magnitude is NaN.
    """
    history = F.arrays_zip(
        hist_mag.alias("mag"), hist_lim.alias("lim"), hist_jd.alias("jd"), hist_fid.alias("fid")
    )

    def compare(s: Column) -> Column:
        same = F.filter(
            F.transform(s["h"], lambda x, i: F.struct(x["fid"].alias("fid"), i.alias("i"))), lambda x: x["fid"] == fid
        )
        return sky.let(
            result, h=s["h"], n=F.size(same),
            last=F.try_element_at(same, F.lit(-1))["i"], before=F.try_element_at(same, F.lit(-2))["i"],
        )

    def result(s: Column) -> Column:
        idx = F.when(s["last"] == F.size(s["h"]) - 1, s["before"]).otherwise(s["last"])
        return sky.let(
            rates, n=s["n"], prev=F.try_element_at(s["h"], idx + 1),
            first=F.try_element_at(F.filter(s["h"], lambda x: ~F.isnan(x["mag"])), F.lit(1))["jd"],
        )

    def rates(s: Column) -> Column:
        upper = F.isnan(s["prev"]["mag"])
        delta = mag - F.when(upper, s["prev"]["lim"]).otherwise(s["prev"]["mag"])
        found = s["n"] >= 2
        return F.struct(
            F.when(found, delta).otherwise(mag).alias("abs_rate"),
            F.when(found, F.try_divide(delta, jd - s["prev"]["jd"])).otherwise(F.lit(float("nan"))).alias("norm_rate"),
            F.when(found, s["first"]).otherwise(jd).alias("first_variation_time"),
            F.when(found, s["first"] - jdstarthist).otherwise(F.lit(0.0)).alias("diff_start_hist"),
            F.when(found, upper).otherwise(F.lit(False)).alias("from_upper"),
        )

    return sky.let(compare, h=history)


RATE_COLUMNS = {
    "delta_mag": "abs_rate", "rate": "norm_rate", "from_upper": "from_upper",
    "start_vartime": "first_variation_time", "diff_vartime": "diff_start_hist",
}


def with_mag_rate(alerts: DataFrame, name: str = "c_rate") -> DataFrame:
    """Add the rate struct of alerts that went through `history_concat`."""
    c = F.col
    return alerts.withColumn(
        name,
        mag_rate(
            c("candidate.magpsf"), c("candidate.jdstarthist"), c("candidate.jd"), c("candidate.fid"),
            c("cmagpsf"), c("cdiffmaglim"), c("cjd"), c("cfid"),
        ),
    )


def rate_columns(alerts: DataFrame, name: str = "c_rate") -> DataFrame:
    """Flatten the rate struct into its five output columns."""
    return alerts.withColumns({new: F.col(f"{name}.{old}") for new, old in RATE_COLUMNS.items()}).drop(name)


def classify(alerts: DataFrame, rules: list[tuple[str, str]], default: str = "Unknown", name: str = "alert_class"):
    """Label each alert by the first rule (label, SQL condition) that holds.

    The rule table is configuration: a survey brings its own classes. `tracklet` is an empty string when the
    alerts do not carry one.
    """
    if "tracklet" not in alerts.columns:
        alerts = alerts.withColumn("tracklet", F.lit(""))
    (label, cond), *tail = rules
    chain = reduce(lambda c, r: c.when(F.expr(r[1]), r[0]), tail, F.when(F.expr(cond), label))
    return alerts.withColumn(name, chain.otherwise(default))
