"""Language identification by word scores and Viterbi.

Learning counts hashed letter trigrams, bigrams and whole words per language over all labelled texts: a table of fixed
size per language, summed by Spark with map-side aggregation. Scripts seen in a language's texts are counted as well.

For a text, each run of letters and marks with a letter is a word. The script of its letters, by code point ranges, narrows the languages; each
remaining language scores the word by its log-probabilities; and a Viterbi pass over the words, with a penalty for each
change of language, labels spans of mixed text. The text's language is the one with most letters.

Words are scored as numpy arrays over slices of a batch; the Viterbi pass steps through all texts of a batch at once.

Defined results: a text that is null or has no letter is `und` with score 0, so is every text if nothing was learned;
equal rows are labelled each; an empty table gives an empty result; other columns are kept, a result column replaces one
of its name. Ties go to the language that sorts first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import carried, released

BUCKETS = 1 << 14
KINDS = 3
MAX_LANGUAGES = 500
PENALTY = 12.0
SLICE_CHARS = 1 << 20
VITERBI_WORDS = 2_000_000
# script ranges; what lies in none of them is script 0
SCRIPTS = (
    ("Latin", ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))), ("Cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF))),
    ("Armenian", ((0x530, 0x58F),)), ("Hebrew", ((0x590, 0x5FF),)),
    ("Arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("Devanagari", ((0x900, 0x97F),)), ("Bengali", ((0x980, 0x9FF),)), ("Tamil", ((0xB80, 0xBFF),)),
    ("Thai", ((0xE00, 0xE7F),)), ("Georgian", ((0x10A0, 0x10FF),)), ("Ethiopic", ((0x1200, 0x137F),)),
    ("Hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("Kana", ((0x3040, 0x30FF), (0x31F0, 0x31FF))), ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x2FA1F))),
)
# a language is a candidate for a script that holds at least this share of its words
SCRIPT_SHARE = 0.001


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: the lower-cased letter (0 for what is no letter or mark), the script, and whether it is a letter."""
    letter, own = np.zeros(0x110000, dtype=np.uint32), np.zeros(0x110000, dtype=bool)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        own[c] = kind == "L"
        if kind in "LM":
            low = chr(c).lower()
            letter[c] = ord(low) if len(low) == 1 else c
    script = np.zeros(0x110000, dtype=np.uint8)
    for i, (_, ranges) in enumerate(SCRIPTS, 1):
        for a, b in ranges:
            script[a : b + 1] = i
    return letter, script, own


@dataclass
class Letters:
    """Words of a slice of texts: hashed features per letter and word."""

    row: np.ndarray  # text of each word
    start: np.ndarray  # place of the word in its text, in code points
    end: np.ndarray
    first: np.ndarray  # first letter of each word, as an index of the letter arrays
    bigram: np.ndarray
    trigram: np.ndarray
    word: np.ndarray
    script: np.ndarray


def _hash(*parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return h


def letters_of(texts: Sequence[str]) -> Letters:
    letter, script, own = _tables()
    # a line break parts the texts; lone surrogates cannot occur in Arrow strings
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    offset = np.cumsum(sizes) - sizes
    low = np.concatenate([[0], letter[codes], [0]]).astype(np.uint32)
    at = np.flatnonzero(low)
    begins = np.flatnonzero(low[at - 1] == 0)
    if len(begins):
        # marks alone are no word
        real = np.logical_or.reduceat(own[codes[at - 1]], begins)
        at = at[np.repeat(real, np.diff(np.append(begins, len(at))))]
    before, here, after = low[at - 1], low[at], low[at + 1]
    bigram = (_hash(before, here) % np.uint64(BUCKETS)).astype(np.int32)
    trigram = (_hash(before, here, after) % np.uint64(BUCKETS)).astype(np.int32)
    first = np.flatnonzero(before == 0)
    last = np.flatnonzero(after == 0)
    # a whole word's hash: its trigrams' hashes, each turned by its place
    place = at - np.repeat(at[first], last - first + 1)
    turned = _hash(here, place)
    word = np.add.reduceat(turned, first) if len(first) else np.zeros(0, np.uint64)
    start, end = at[first] - 1, at[last]
    row = np.searchsorted(offset, start, side="right") - 1
    return Letters(
        row, start - offset[row], end - offset[row], first, bigram, trigram,
        (_hash(word) % np.uint64(BUCKETS)).astype(np.int32), script[codes[start]] if len(start) else np.zeros(0, np.uint8),
    )


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    lo = 0
    while lo < len(texts):
        hi, size = lo, 0
        while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= SLICE_CHARS):
            size += len(texts[hi])
            hi += 1
        yield lo, hi
        lo = hi


def _counter(languages: Sequence[str]):
    """Task-side counts per (language, table, bucket), given out once per partition; table KINDS counts scripts."""
    index = {lang: i for i, lang in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(languages), KINDS + 1, BUCKETS), dtype=np.int64)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            lang = np.array([index[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            for lo, hi in _slices(texts):
                w = letters_of(texts[lo:hi])
                of_word = lang[lo:hi][w.row]
                of_letter = np.repeat(of_word, np.diff(np.append(w.first, len(w.bigram))))
                for k, (of, bucket) in enumerate(((of_letter, w.bigram), (of_letter, w.trigram), (of_word, w.word), (of_word, w.script))):
                    sums[:, k] += np.bincount(of * BUCKETS + bucket, minlength=len(languages) * BUCKETS).reshape(-1, BUCKETS)
        found = np.nonzero(sums)
        for lo in range(0, len(found[0]), 50_000):
            cut = [x[lo : lo + 50_000] for x in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int32)) for x in cut] + [pa.array(sums[tuple(cut)])], names=["lang", "kind", "bucket", "n"]
            )

    return run


@dataclass
class LanguageModel:
    languages: list[str]
    logs: np.ndarray  # language, kind, bucket
    allowed: np.ndarray  # script, language

    def scores(self, w: Letters) -> np.ndarray:
        """Log-probability of each word in each language, 0 for the best of its candidates."""
        out = np.zeros((len(w.first), len(self.languages)), dtype=np.float32)
        if not len(w.first):
            return out
        for i in range(len(self.languages)):
            bi, tri, word = self.logs[i]
            out[:, i] = np.add.reduceat(0.5 * (bi[w.bigram] + tri[w.trigram]), w.first) + word[w.word]
        out[~self.allowed[w.script]] = -np.inf
        best = out.max(axis=1, keepdims=True)
        # a script that no language has says nothing
        return np.where(np.isinf(best), 0, out - np.where(np.isinf(best), 0, best)).clip(-50.0).astype(np.float32)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Counts over all rows with a language. The model holds BUCKETS * 3 numbers per language, whatever the rows."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).filter("lang is not null")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    sums = np.zeros((len(languages), KINDS + 1, BUCKETS))
    if languages:
        counted = rows.mapInArrow(_counter(languages), "lang int, kind int, bucket int, n long")
        table = counted.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n")).toArrow()
        sums[tuple(table.column(c).to_numpy() for c in ("lang", "kind", "bucket"))] = table.column("n").to_numpy()
    grams = sums[:, :KINDS] + 0.5
    logs = np.log(grams / grams.sum(axis=2, keepdims=True)).astype(np.float32)
    scripts = sums[:, KINDS, : len(SCRIPTS) + 1]
    allowed = (scripts > 0) & (scripts >= SCRIPT_SHARE * scripts.sum(axis=1, keepdims=True))
    return LanguageModel(languages, logs, allowed.T.copy())


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """Label of each word of the texts whose words are scores[first[i]:first[i + 1]].

    All texts take a step at once, the longest ones first in line so that those still running stay together.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin, size = first[:-1][order], size[order]
    labels = np.zeros(len(scores), dtype=np.int16)
    came_from = np.zeros(scores.shape, dtype=np.int16)
    if not len(scores):
        return labels
    steps = int(size[0])
    running = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    state = np.zeros((len(size), scores.shape[1]), dtype=np.float64)
    own = np.arange(scores.shape[1], dtype=np.int16)
    for t in range(steps):
        a = running[t]
        now, at = state[:a], begin[:a] + t
        if t:
            top = now.argmax(axis=1)
            switched = now[np.arange(a), top][:, None] - penalty
            moves = switched > now
            came_from[at] = np.where(moves, top[:, None], own)
            now = np.where(moves, switched, now)
        now = now + scores[at]
        # only differences matter: keeps a long text's sums small
        state[:a] = now - now.max(axis=1, keepdims=True)
    label = state.argmax(axis=1).astype(np.int16)
    for t in range(steps - 1, -1, -1):
        a = running[t]
        at = begin[:a] + t
        labels[at] = label[:a]
        label[:a] = came_from[at, label[:a]] if t else label[:a]
    return labels


def _labelled(texts: list[str], model: LanguageModel, penalty: float) -> Iterator[tuple[int, str, float, list[dict]]]:
    """(text, language, score, spans) of the texts that have a letter."""

    def flush(parts):
        row, start, end, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(row):
            return
        heads = np.flatnonzero(np.diff(row, prepend=-1))
        label = viterbi(scores, np.append(heads, len(row)), penalty)
        # runs of equal label in one text
        cut = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))
        ends = end[np.append(cut[1:], len(row)) - 1]
        letters = np.add.reduceat(end - start, cut)
        found: dict[int, list[tuple[int, int, int, int]]] = {}
        for r, s, e, x, n in zip(row[cut].tolist(), start[cut].tolist(), ends.tolist(), label[cut].tolist(), letters.tolist(), strict=True):
            found.setdefault(r, []).append((s, e, x, n))
        for r, spans in found.items():
            by: dict[int, int] = {}
            for _, _, x, n in spans:
                by[x] = by.get(x, 0) + n
            best = min(by, key=lambda x: (-by[x], x))
            yield r, model.languages[best], by[best] / sum(by.values()), [
                {"start": s, "end": e, "lang": model.languages[x]} for s, e, x, _ in spans
            ]

    parts, held = [], 0
    for lo, hi in _slices(texts):
        w = letters_of(texts[lo:hi])
        parts.append((w.row + lo, w.start, w.end, model.scores(w)))
        held += len(w.row)
        if held >= VITERBI_WORDS:
            yield from flush(parts)
            parts, held = [], 0
    if parts:
        yield from flush(parts)


def identify(
    docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = PENALTY, carry: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with `lang_pred`, `score` (share of the letters) and `lang_spans`: array<struct<start, end, lang>>."""
    carry = list(docs.columns if carry is None else carry)
    rows = carried(docs, text)
    held = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    rows = rows.select(held, F.col(f"in_{text}").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            pred, score, spans = ["und"] * len(texts), [0.0] * len(texts), [[] for _ in texts]
            if shared.value.languages:
                for r, lang, s, found in _labelled(texts, shared.value, penalty):
                    pred[r], score[r], spans[r] = lang, s, found
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(pred), pa.array(score), pa.array(spans, span)],
                names=["row", "lang_pred", "score", "lang_spans"],
            )

    kind = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, " \
        "lang_spans array<struct<start: long, end: long, lang: string>>"
    out = rows.mapInArrow(run, kind)
    return released(out, carry, {c: F.col(c) for c in out.columns[1:]})


def held_out(row_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: its id as text has a CRC-32 divisible by `folds` (null as empty text)."""
    return F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % folds == 0
