"""Personal data: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Base spans (e-mail, IP, card, phone by pattern and check) always stay. Candidates are these matches, also the ones that
fail their check, and looser patterns: national phone numbers, social security numbers, IBANs, obfuscated addresses,
titled names and birth dates. Pattern, checksum, gazetteer, context and border labelers each vote on a candidate.
Candidates of all documents are counted by signature (kind, votes, length band: a table of fixed size);
expectation-maximisation on the counted votes estimates each labeler's reliability and a probability per signature, and
a logistic regression on votes, kind and length, trained on these probabilities, decides over the added spans.

Texts are read once, in Arrow batches; found spans are written to the shared folder, so that the model sees all of them.

Defined results: a null text is empty; equal rows are judged each; an empty table gives an empty result; other columns
are kept, a result column replaces one of its name; an added span that overlaps a base or an earlier added one is left out.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import carried, released, stored
from skyherald.llm.votes import fit_votes

BASE = ("email", "ip", "card", "phone")
ADDED = ("phone_local", "ssn", "iban", "email_words", "person", "birth_date")
KINDS = BASE + ADDED
LABELERS = ("pattern", "checksum", "gazetteer", "context", "denial", "border")
LENGTHS = (8, 12, 20)

_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a number starts at the first digit of its run: from inside the run nothing else can match
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = {
    "phone_local": re.compile(r"(?<![\w+(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])"),
    "iban": re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "birth_date": re.compile(r"(?<![\w-])[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{2,4}(?![\w-])"),
}
_WORDED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}(?:(?: ?[\[(]dot[\])] ?|\.)[A-Za-z0-9-]{1,63})+", re.I)
_PERSON = re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra)\.? [A-Z][\w'-]{1,30}(?: [A-Z][\w'-]{1,30})?")

# words that speak for a kind, before a span
CONTEXT = {
    "email": ("mail", "contact", "write", "correo", "courriel"), "ip": ("ip", "host", "address", "server", "client", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "cell"), "phone_local": ("phone", "tel", "call", "mobile", "fax", "cell"),
    "ssn": ("ssn", "social", "security"), "iban": ("iban", "account", "bank", "konto"), "email_words": ("mail", "contact", "write"),
    "person": ("name", "contact", "dear", "signed", "by"), "birth_date": ("born", "birth", "dob", "geboren", "naissance"),
}
DENIAL = ("version", "isbn", "issn", "invoice", "order", "figure", "table", "section", "chapter", "part", "serial", "id")
TOP_DOMAINS = frozenset("com org net edu gov int info io de fr es uk it nl eu us ca au ch at be se pl ru jp cn in br mx".split())
IBAN_LENGTHS = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "BE": 16, "CH": 21, "AT": 20, "PL": 28, "PT": 25, "SE": 24}
CALLING = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "4", "5", "6", "8", "9")
FIRST_NAMES = frozenset(
    "james john robert michael william david mary patricia jennifer linda elizabeth anna maria peter hans jean pierre "
    "marie jose carlos juan laura sofia thomas paul".split()
)
_WORD = re.compile(r"[^\W\d_]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping addresses: at each @ the longest local part not yet used, then the domain."""
    used = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > used and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            used = m.end()
            at = text.find("@", used)
        else:
            at = text.find("@", at + 1)


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _raw(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, passes its check) of every candidate; base kinds as their patterns match."""
    for start, end in emails(text):
        yield "email", start, end, True
    if _DIGIT.search(text):
        if "." in text:
            for m in _IP.finditer(text):
                parts = [p.lstrip("0") or "0" for p in m[0].split(".")]
                yield "ip", m.start(), m.end(), all(len(p) <= 3 and int(p) <= 255 for p in parts)
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = digits_of(m[0])
                if 16 <= len(d) <= 19:
                    yield "card", m.start(), m.end(), luhn(d)
        if "+" in text:
            for m in _PHONE.finditer(text):
                yield "phone", m.start(), m.end(), 8 <= len(digits_of(m[0])) <= 15
        for kind, pattern in _LOOSE.items():
            for m in pattern.finditer(text):
                yield kind, m.start(), m.end(), _valid(kind, m[0])
    if "at]" in text or "at)" in text or "AT]" in text or "AT)" in text:
        for m in _WORDED.finditer(text):
            yield "email_words", m.start(), m.end(), True
    for m in _PERSON.finditer(text):
        yield "person", m.start(), m.end(), True


def _valid(kind: str, found: str) -> bool:
    if kind == "ssn":
        area, group, serial = found.split("-")
        return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    if kind == "iban":
        s = found.replace(" ", "")
        return len(s) == IBAN_LENGTHS.get(s[:2], len(s)) and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1
    if kind == "phone_local":
        d = digits_of(found)
        return d[0] > "1" and d[3] > "1"
    if kind == "birth_date":
        parts = [int(p) for p in re.split(r"[-/.]", found)]
        year = max(parts[0], parts[2])
        rest = sorted([parts[1], min(parts[0], parts[2])])
        return 1900 <= year <= 2030 and 1 <= rest[0] <= 12 and 1 <= rest[1] <= 31
    return True


def _votes(text: str, kind: str, start: int, end: int, valid: bool) -> list[int]:
    """One vote per labeler: 1 personal data, -1 not, 0 no opinion."""
    found = text[start:end]
    words = [w.lower() for w in _WORD.findall(text[max(0, start - 40) : start])][-5:]
    separated = not found.isalnum()
    pattern = 1 if kind in BASE or separated else 0
    checksum = (1 if valid else -1) if kind in ("ip", "card", "phone", "ssn", "iban", "phone_local", "birth_date") else 0
    known = 0
    if kind in ("email", "email_words"):
        known = 1 if re.split(r"[\W_]+", found.lower().rstrip(")]"))[-1] in TOP_DOMAINS else -1
    elif kind == "iban":
        known = 1 if found[:2] in IBAN_LENGTHS else -1
    elif kind == "phone":
        known = 1 if found[1:].lstrip("( ").startswith(CALLING) else -1
    elif kind == "card":
        known = 1 if found[0] in "3456" else -1
    elif kind == "person":
        known = 1 if any(w.lower() in FIRST_NAMES for w in found.split()) else 0
    elif kind == "ip":
        known = -1 if found.split(".")[0] in ("0", "127") else 0
    context = 1 if any(w.startswith(c) for w in words for c in CONTEXT[kind]) else 0
    if kind == "birth_date" and not context:
        context = -1
    denial = -1 if any(w in DENIAL for w in words) else 0
    before, after = text[start - 1 : start], text[end : end + 1]
    border = -1 if before.isalnum() or after.isalnum() else 1
    return [pattern, checksum, known, context, denial, border]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())])
_CANDIDATE = pa.struct([
    ("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("votes", pa.list_(pa.int8())), ("band", pa.int32())
])
_DDL = (
    "base array<struct<start: long, end: long, kind: int>>, "
    "candidates array<struct<start: long, end: long, kind: int, votes: array<tinyint>, band: int>>"
)


def spans_of(text: str) -> tuple[list[dict], list[dict]]:
    """Base spans and all candidates of a text."""
    base, candidates = [], []
    for kind, start, end, valid in _raw(text):
        k = KINDS.index(kind)
        if valid and kind in BASE:
            base.append({"start": start, "end": end, "kind": k})
        band = sum(end - start >= b for b in LENGTHS)
        candidates.append({"start": start, "end": end, "kind": k, "votes": _votes(text, kind, start, end, valid), "band": band})
    base.sort(key=lambda s: (s["kind"], s["start"]))
    return base, candidates


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, candidates = [], []
        for text in batch.column("text"):
            b, c = spans_of(text.as_py() or "")
            base.append(b)
            candidates.append(c)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(base, pa.list_(_SPAN)), pa.array(candidates, pa.list_(_CANDIDATE))],
            names=["row", "base", "candidates"],
        )


def _features(kind: int, votes: Sequence[int], band: int) -> list[int]:
    """Places of the ones in a signature's feature vector: constant, kind, band, then three per labeler."""
    first = 1 + len(KINDS) + len(LENGTHS) + 1
    return [0, 1 + kind, 1 + len(KINDS) + band, *(first + 3 * j + v + 1 for j, v in enumerate(votes))]


def fit_classifier(signatures: list[tuple[int, tuple[int, ...], int, int]], rounds: int = 30, ridge: float = 1.0) -> list[float]:
    """Weights of a logistic regression on (kind, votes, band, count), by Newton steps.

    Its labels are the posterior probabilities of the vote model, which is fitted on the same counts.
    """
    size = 1 + len(KINDS) + len(LENGTHS) + 1 + 3 * len(LABELERS)
    if not signatures:
        return [0.0] * size
    patterns: dict[tuple[int, ...], int] = {}
    for _, votes, _, count in signatures:
        patterns[votes] = patterns.get(votes, 0) + count
    model = fit_votes(list(patterns.items()), len(LABELERS), prior=0.5)
    weights = model.weights()
    prior = math.log(model.prior / (1 - model.prior))
    x = np.zeros((len(signatures), size))
    label, count = np.zeros(len(signatures)), np.zeros(len(signatures))
    for i, (kind, votes, band, n) in enumerate(sorted(signatures)):
        x[i, _features(kind, votes, band)] = 1
        odds = prior + sum(w[v + 1] for v, w in zip(votes, weights, strict=True))
        label[i], count[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))), n
    w = np.zeros(size)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (count * (label - p)) - ridge * w
        bend = (x * (count * p * (1 - p))[:, None]).T @ x + ridge * np.eye(size)
        step = np.linalg.solve(bend, slope)
        w += step / max(1.0, float(np.abs(step).max()) / 5)
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def _score(c: Column, weights: list[float]) -> Column:
    first = 1 + len(KINDS) + len(LENGTHS) + 1
    at = lambda place, offset: F.get(F.array(*map(F.lit, weights)), place.cast("int") + offset)
    score = F.lit(weights[0]) + at(c.getField("kind"), 1) + at(c.getField("band"), 1 + len(KINDS))
    for j in range(len(LABELERS)):
        score = score + at(F.get(c.getField("votes"), F.lit(j)), first + 3 * j + 1)
    return score


def find_pii(docs: DataFrame, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """Documents with `base` and `spans`: array<struct<start, end, kind>>, by kind as in KINDS, then start."""
    carry = list(docs.columns if carry is None else carry)
    rows = carried(docs, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    rows = rows.select(held, F.col(f"in_{text}").alias("text"))
    found = stored(rows.mapInArrow(_find, f"row {rows.schema['row'].dataType.simpleString()}, {_DDL}"), "pii")
    c = F.explode("candidates").alias("c")
    # kinds x 3^labelers x bands rows at most
    counted = found.select(c).groupBy("c.kind", "c.votes", "c.band").count().collect()
    weights = fit_classifier([(r["kind"], tuple(r["votes"]), r["band"], r["count"]) for r in counted])

    def apart(s: Column, others: Column) -> Column:
        return ~F.exists(others, lambda b: (b.getField("start") < s.getField("end")) & (s.getField("start") < b.getField("end")))

    plain = lambda s: F.struct(*[s.getField(f).alias(f) for f in ("start", "end", "kind")])
    chosen = F.transform(F.filter("candidates", lambda s: (s.getField("kind") >= len(BASE)) & (_score(s, weights) > 0)), plain)
    chosen = F.filter(chosen, lambda s: apart(s, F.col("base")))
    picked = found.select("row", "base", F.array_sort(chosen).alias("chosen"))
    # of overlapping added spans the one that starts first stays
    first = F.aggregate("chosen", F.array().cast("array<struct<start: bigint, end: bigint, kind: int>>"), lambda kept, s: F.when(
        apart(s, kept), F.concat(kept, F.array(s))).otherwise(kept))
    names = F.array(*map(F.lit, KINDS))
    by_kind = lambda spans: F.transform(
        F.sort_array(F.transform(spans, lambda s: F.struct(s.getField("kind").alias("k"), s.getField("start").alias("start"), s.getField("end").alias("end")))),
        lambda s: F.struct(s.getField("start").alias("start"), s.getField("end").alias("end"), F.get(names, s.getField("k")).alias("kind")),
    )
    ready = picked.select("row", "base", F.concat("base", first).alias("spans"))
    return released(ready, carry, {"base": by_kind(F.col("base")), "spans": by_kind(F.col("spans"))})


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents with every span of personal data replaced by its kind in brackets; a column `n_chars` follows suit."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"))
    found = find_pii(inner, "text", carry=["doc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
                value, parts, at = t.as_py(), [], 0
                for s in sorted(spans or (), key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [value[at : s["start"]], f"[{s['kind'].upper()}]"]
                    at = max(at, s["end"])
                out.append(value if value is None or not parts else "".join([*parts, value[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(out, pa.string())], names=["doc", "text"])

    kind = f"doc {found.schema['doc'].dataType.simpleString()}, text string"
    done = found.select("doc", F.col("doc").getField(text).alias("text"), "spans").mapInArrow(run, kind)
    size = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    fresh = {text: F.col("text")} | size
    return done.select(*[fresh.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
