"""Shape of the output: projection, grades, topics, distribution records."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyherald.observatories import OBSERVATORIES, of_assoc

FIVE_SIGMA = math.erf(5 / math.sqrt(2))

# fixed values: working columns that a match does not keep
WORKING = (
    "candidate", "prv_candidates", "timestamp", "hpix", "hpix_circle", "index", "cmagpsf", "cdiffmaglim", "cjd",
    "cfid", "tracklet", "ivorn", "triggerTimejd", "separation", "region_arcmin", "event_type", "density",
)
FROM_CANDIDATE = ("candid", "fid", "jdstarthist", "rb", "jd", "magpsf", "sigmapsf")


def match_projection(matches: DataFrame) -> DataFrame:
    """Drop the working columns, lift seven fields of `candidate`, name the radius `gcn_loc_error`."""
    kept = [c for c in matches.columns if c not in WORKING and c not in FROM_CANDIDATE]
    return matches.select(*kept, *[F.col(f"candidate.{c}") for c in FROM_CANDIDATE]).withColumnRenamed(
        "err_arcmin", "gcn_loc_error"
    )


@dataclass(frozen=True)
class GradeRules:
    """Thresholds of the grades. The class list is configuration: a survey brings its own classes."""

    extragalactic: tuple[str, ...]
    bronze_rb: float = 0.7
    gold_rb: float = 0.9
    silver_p: float = FIVE_SIGMA
    gold_rate: float = 0.3
    gold_loc_error: float = math.inf
    class_column: str = "alert_class"


def grades(rules: GradeRules, observatories=OBSERVATORIES) -> dict[str, Column]:
    """The four grade conditions, null-safe: a missing input gives no grade."""

    def of_kind(kind: str) -> Column:
        return of_assoc(F.col("observatory"), kind, observatories)

    bronze = (F.col("rb") >= rules.bronze_rb) & F.col(rules.class_column).isin(*rules.extragalactic)
    silver = bronze & of_kind("grb") & (F.col("p_assoc") >= rules.silver_p)
    gold = (
        silver & (F.col("mag_rate") > rules.gold_rate) & (F.col("rb") >= rules.gold_rb)
        & (F.col("gcn_loc_error") <= rules.gold_loc_error)
    )
    conditions = {
        "is_grb_bronze": bronze & of_kind("grb"), "is_grb_silver": silver, "is_grb_gold": gold,
        "is_gw_bronze": bronze & of_kind("gw"),
    }
    return {name: F.coalesce(c, F.lit(False)) for name, c in conditions.items()}


def grade_flags(matches: DataFrame, rules: GradeRules, observatories=OBSERVATORIES) -> DataFrame:
    return matches.withColumns(grades(rules, observatories))


def grade_split(matches: DataFrame, rules: GradeRules, observatories=OBSERVATORIES) -> DataFrame:
    """One row per (match, topic it belongs to): the source is read once, not once per topic."""
    names = [F.when(c, F.lit(name.removeprefix("is_"))) for name, c in grades(rules, observatories).items()]
    return matches.withColumn("topic", F.explode(F.array_compact(F.array(*names))))


def map_to_struct(df: DataFrame, name: str = "mangrove") -> DataFrame:
    """The galaxy-catalogue map as a struct of its four entries."""
    keys = ("HyperLEDA_name", "TwoMASS_name", "lum_dist", "ang_dist")
    return df.withColumn(name, F.struct(*[F.try_element_at(F.col(name), F.lit(k)).alias(k) for k in keys]))


def distribution_projection(matches: DataFrame) -> DataFrame:
    """The record a topic receives: fixed types, no partition and bookkeeping columns.

    `candid` stays a bigint: it does not fit an int.
    """
    df = matches.drop("year", "month", "day", "timestamp", "t2", "ackTime")
    casts = {"fid": "int", "rb": "double", "candid": "bigint", "Plx": "double", "e_Plx": "double"}
    columns = {c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns}
    if isinstance(df.schema["triggerTimeUTC"].dataType, T.TimestampType):
        columns["triggerTimeUTC"] = F.date_format("triggerTimeUTC", "yyyy-MM-dd HH:mm:ss.SSS")
    for name in ("lc_features_g", "lc_features_r"):
        if name in df.columns:
            fields = df.schema[name].dataType.names
            columns[name] = F.struct(*[F.col(f"{name}.{f}") for f in fields])
    return df.withColumns(columns)


def schema_differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """Where a table departs from a contract, ignoring column order and nullability."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in contract}
    out = [f"missing {n} {t}" for n, t in want.items() if n not in have]
    out += [f"unexpected {n} {t}" for n, t in have.items() if n not in want]
    return out + [f"{n} is {have[n]}, not {t}" for n, t in want.items() if n in have and have[n] != t]


def payload(records: DataFrame, key: str = "objectId", avro_schema: str | None = None) -> DataFrame:
    """(topic, key, value) rows for a message broker: JSON, or Avro where the Avro module is on the class path."""
    fields = [c for c in records.columns if c != "topic"]
    body = F.struct(*fields)
    if avro_schema is None:
        value = F.to_json(body)
    else:
        from pyspark.sql.avro.functions import to_avro

        value = to_avro(body, avro_schema)
    return records.select("topic", F.col(key).alias("key"), value.alias("value"))


def drop_json_key(df: DataFrame, column: str = "raw_event") -> DataFrame:
    """Remove `event.skymap` from the JSON text of map notices; other texts stay as they are.

    Only that member is cut out of the text, so every other field survives, known or not. A base64 value has
    no quotes or escapes, which makes the pattern exact.
    """
    text = F.col(column)
    cut = F.regexp_replace(text, r'"skymap"\s*:\s*(?:"[^"]*"|null)\s*,\s*', "")
    cut = F.regexp_replace(cut, r',?\s*"skymap"\s*:\s*(?:"[^"]*"|null)', "")
    return df.withColumn(column, F.when(F.col("observatory") == "LVK", cut).otherwise(text))
