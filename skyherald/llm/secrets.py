"""Secret scans: patterns, and a battery of randomness tests under false-discovery control.

Base patterns give spans that always stay. Besides, every token of `MIN_TOKEN` or more characters of an encoding's
alphabet is tested: its encoding is inferred (the smallest alphabet that holds it), and its characters are tested for
being uniform over the alphabet (chi-squared), for runs above and below the alphabet's middle, and for serial
correlation. The three p-values are joined (Bonferroni). Text and identifiers fail the tests, keys pass them.

Dismissals are controlled: tokens are filed by encoding and length band, p-values are counted in bins (a table of fixed
size), and the step-up rule of Benjamini and Hochberg sets each file's threshold so that of the tokens dismissed as not
random at most `rate` are expected to be random. Passing only counts where the tests can tell: a token must be long
enough that text of its length is expected to lie `POWER` standard deviations off.

Everything is a column expression; there is no join and no shuffle but the count of bins.

Defined results: a null text is empty; equal rows are scanned each; an empty table gives an empty result; other columns
are kept, a result column replaces one of its name; a random span that overlaps a base span is left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import carried, let, regex_spans, released, stored

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# (kind, pattern, group whose length counts, least length)
BASE = (("assign", ASSIGN, 2, 8), ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]{32,}", 0, 32))
MIN_TOKEN = 20
TOKEN = rf"[A-Za-z0-9+/_-]{{{MIN_TOKEN},}}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# (name, alphabet); the first that holds a token is its encoding. Digits alone and letters of one case alone are no keys.
ENCODINGS = (
    ("hex", "0123456789abcdef"), ("HEX", "0123456789ABCDEF"), ("base32", UPPER + "234567"), ("lower36", LOWER + DIGITS),
    ("upper36", UPPER + DIGITS), ("base62", UPPER + LOWER + DIGITS), ("base64", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", UPPER + LOWER + DIGITS + "-_"),
)
BANDS = (20, 28, 40, 64)
RATE, POWER = 0.05, 3.0
# text uses an alphabet as unevenly as if its letters had this sum of squared shares
TEXT_CONCENTRATION = 0.065
# what text there is in hexadecimal digits only (words of the letters a to f between dates, repeated digits) uses them
# unevenly, too: made tokens of 20 to 24 characters have 0.10 (words and dates) to 0.18 (words and repeated digits), 0.136 all
HEX_CONCENTRATION = 0.136
STEPS = 20  # bins per decade of p
DECADES = 16


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution (Abramowitz and Stegun 26.2.17, error below 1e-7)."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    # fixed values: the published coefficients
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _tested(token: Column, alphabet: str) -> Column:
    """p-value for a token's characters being random over an alphabet: the least of three, times three."""
    k = len(alphabet)
    values = F.transform(
        F.split(token, ""), lambda c: (F.call_function("locate", c, F.lit(alphabet)) - 1).cast("double")
    )
    n = F.length(token).cast("double")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)

    def battery(v: Column) -> Column:
        squares = total(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda s: F.pow(
            F.size(F.filter(v, lambda x: x == s)).cast("double"), F.lit(2.0)
        )))
        chi = (squares * k / n - n - (k - 1)) / F.sqrt(2.0 * (k - 1) * (n - 1) / n)
        high = lambda x: x >= k / 2
        n1 = F.size(F.filter(v, high)).cast("double")
        n2 = n - n1
        turns = F.size(F.filter(v, lambda x, i: (i > 0) & (high(x) != high(F.get(v, i - 1))))) + 1.0
        product = 2.0 * n1 * n2
        spread = F.sqrt(F.greatest(product * (product - n) / (n * n * (n - 1)), F.lit(1e-9)))
        runs = F.when((n1 == 0) | (n2 == 0), F.lit(9.0)).otherwise((turns - (product / n + 1)) / spread)
        mean = total(v) / n
        var = total(F.transform(v, lambda x: (x - mean) * (x - mean)))
        lag = total(F.transform(v, lambda x, i: F.when(i > 0, (x - mean) * (F.get(v, i - 1) - mean)).otherwise(0.0)))
        serial = F.when(var <= 0, F.lit(9.0)).otherwise((lag / F.greatest(var, F.lit(1e-9)) + 1 / n) * F.sqrt(n))
        least = F.least(_normal_tail(chi), 2 * _normal_tail(F.abs(runs)), 2 * _normal_tail(F.abs(serial)))
        return F.greatest(F.least(3 * least, F.lit(1.0)), F.lit(10.0**-DECADES))

    return let(values, battery)


def least_length(alphabet: str, power: float = POWER) -> int:
    """Length from which text is expected to lie `power` standard deviations off the uniform distribution."""
    k = len(alphabet)
    excess = k * (HEX_CONCENTRATION if k == 16 else TEXT_CONCENTRATION) - 1
    return MIN_TOKEN if excess <= 0 else max(MIN_TOKEN, math.ceil(1 + power * math.sqrt(2 * (k - 1)) / excess))


def _candidate(span: Column) -> Column:
    """A token's span with encoding, length band and p-value; encoding is null for what no test can tell."""
    token = span.getField("found")
    encoding, p = F.lit(None).cast("string"), F.lit(None).cast("double")
    mixed = token.rlike("[0-9]") & token.rlike("[A-Za-z]")
    for name, alphabet in reversed(ENCODINGS):
        inside = F.translate(token, alphabet, "") == ""
        counts = mixed & (F.length(token) >= least_length(alphabet))
        encoding = F.when(inside, F.when(counts, F.lit(name))).otherwise(encoding)
        p = F.when(inside, F.when(counts, _tested(token, alphabet))).otherwise(p)
    band = F.lit(BANDS[0])
    for b in BANDS[1:]:
        band = F.when(F.length(token) >= b, F.lit(b)).otherwise(band)
    return F.struct(
        span.getField("start").alias("start"), span.getField("end").alias("end"), encoding.alias("encoding"),
        band.alias("band"), F.floor(-F.log10(p) * STEPS).cast("int").alias("bin"),
    )


def thresholds(counts: dict[tuple[str, int], dict[int, int]], rate: float) -> dict[tuple[str, int], int]:
    """Per file the least bin that is dismissed (step-up rule on binned p-values, each taken at its bin's upper end)."""
    out = {}
    for file, bins in counts.items():
        total, above, cut = sum(bins.values()), 0, STEPS * DECADES + 1
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if 10 ** (-b / STEPS) <= rate * above / total:
                cut = b
        out[file] = cut
    return out


def secret_scan(
    docs: DataFrame, text: str = "text", rate: float = RATE, carry: Sequence[str] | None = None
) -> DataFrame:
    """Documents with `secrets`: array<struct<start, end, kind, base>> by start, kinds of equal start as listed."""
    carry = list(docs.columns if carry is None else carry)
    rows = carried(docs, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    t = F.col("t")
    kinds = []
    for order, (kind, pattern, group, least) in enumerate(BASE):
        kinds.append(F.transform(_kept(regex_spans(t, pattern, group), least), _named(order, kind)))
    shown = rows.select(held, F.coalesce(F.col(f"in_{text}"), F.lit("")).alias("t"))
    tested = F.filter(F.transform(regex_spans(t, TOKEN), _candidate), lambda c: c.getField("encoding").isNotNull())
    spans = stored(shown.select("row", F.concat(*kinds).alias("base"), tested.alias("tested")), "secrets")
    # encodings x bands x bins rows
    c = F.explode("tested").alias("c")
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for r in spans.select(c).groupBy("c.encoding", "c.band", "c.bin").count().collect():
        counts.setdefault((r["encoding"], r["band"]), {})[r["bin"]] = r["count"]
    cuts = thresholds(counts, rate)

    def random(s: Column) -> Column:
        passed = F.lit(False)
        for (encoding, band), cut in sorted(cuts.items()):
            passed = passed | ((s.getField("encoding") == encoding) & (s.getField("band") == band) & (s.getField("bin") < cut))
        apart = ~F.exists("base", lambda b: (b.getField("start") < s.getField("end")) & (s.getField("start") < b.getField("end")))
        return passed & apart

    added = F.transform(F.filter("tested", random), _named(len(BASE), "random"))
    ordered = F.sort_array(F.concat("base", added))
    plain = F.transform(ordered, lambda s: F.struct(
        *[s.getField(f).alias(f) for f in ("start", "end", "kind")], (s.getField("order") < len(BASE)).alias("base")
    ))
    return released(spans, carry, {"secrets": plain})


def _kept(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.length(s.getField("found")) >= least)


def _named(order: int, kind: str):
    return lambda s: F.struct(
        s.getField("start").alias("start"), F.lit(order).alias("order"), s.getField("end").alias("end"), F.lit(kind).alias("kind")
    )


def digest_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s.getField("kind"), s.getField("start").cast("string"), s.getField("end").cast("string")
    )), ",")
