"""Quality rules as weak supervision.

Each rule votes good (1), bad (-1) or abstains (0). Votes of all documents are counted per vote pattern (at most
3^rules patterns, whatever the number of documents); expectation-maximisation on that histogram estimates how often
each rule gives each vote on good and on bad documents, and a document's posterior probability of being good, a
sum of literals per vote, decides. Everything per document is a column expression.

Defined results: a null or blank text has no words and fails the base test; equal rows are judged alike, each on its
own; an empty table gives an empty result; other columns are kept, a result column replaces one of its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import BLANKS, carried, let, released, stored, words
from skyherald.llm.votes import fit_votes

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


@dataclass(frozen=True)
class Rule:
    """Votes bad where `bad` holds, else good where `good` holds, else abstains: SQL over the measured columns."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 80", "n_words < 50"),
    Rule("word_length", "word_chars between 3.5 * n_words and 9 * n_words",
         "word_chars < 2.5 * n_words or word_chars > 12 * n_words"),
    Rule("symbols", "n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    Rule("lines", "n_dup_lines <= 0.05 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("phrases", "n_repeat_words <= 0.1 * n_words", "n_repeat_words > 0.3 * n_words"),
    Rule("capitals", "n_upper <= 0.2 * word_chars", "n_upper > 0.4 * word_chars"),
    Rule("exclamations", "n_shouts <= 0.02 * n_words", "n_shouts > 0.1 * n_words"),
    Rule("plain_words", "n_plain >= 0.85 * n_words", "n_plain < 0.6 * n_words"),
    Rule("letters", "n_letters >= 0.9 * word_chars", "n_letters < 0.75 * word_chars"),
    Rule("short_words", "n_short between 0.1 * n_words and 0.7 * n_words", "n_short < 0.02 * n_words"),
)


def _repeat_words(w: Column) -> Column:
    """Number of words inside three-word windows that occur twice or more.

    Hashes of the windows are sorted with their places; neighbours of equal hash are repeats. The sort is only
    evaluated where a hash-set count has shown a repeat.
    """
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )

    def covered(ordered: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(ordered, k).getField("h") == x.getField("h"), F.lit(False))
        repeated = F.filter(ordered, lambda x, k: same(x, k - 1) | same(x, k + 1))
        places = F.flatten(F.transform(repeated, lambda x: F.sequence(x.getField("i"), x.getField("i") + 2)))
        return F.size(F.array_distinct(places))

    def counted(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(F.sort_array(pairs), covered)
        )

    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes, counted))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Carried rows with the measures the rules vote on; one pass over the texts, no shuffle."""
    t = F.coalesce(F.col(f"in_{text}"), F.lit(""))
    split = carried(docs, text).select("row", t.alias("t"), words(t).alias("w"))
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    split = split.select("row", "t", "w", lines.alias("lines"), F.array_join("w", "").alias("solid"))
    count = lambda pattern: F.regexp_count("t", F.lit(pattern))
    columns = {
        "n_words": F.size("w"),
        "word_chars": F.length("solid"),
        "n_symbols": count(r"[#*$%&|<>]"),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": _repeat_words(F.col("w")),
        "n_upper": count(r"\p{Lu}"),
        "n_letters": count(r"\p{L}"),
        "n_plain": F.size(F.filter("w", lambda x: x.rlike(r"^[\"'(\[]?\p{L}[\p{L}'-]*[.,;:!?\"')\]]?$"))),
        "n_shouts": count(r"!+"),
        "n_short": F.size(F.filter("w", lambda x: F.length(x) <= 3)),
    }
    return split.select("row", *[c.cast("long").alias(name) for name, c in columns.items()])


def vote(rule: Rule) -> Column:
    return (
        F.when(F.expr(rule.bad), F.lit(-1)).when(F.expr(rule.good), F.lit(1)).otherwise(F.lit(0)).cast("byte")
    )


def vote_patterns(voted: DataFrame, votes: Sequence[str]) -> list[tuple[tuple[int, ...], int]]:
    """Counted vote patterns of what passes the base test: at most 3^rules rows come to the driver."""
    counted = voted.filter(f"not ({FAILED})").groupBy(*votes).count().collect()
    return [(tuple(int(r[v]) for v in votes), r["count"]) for r in counted]


def quality(
    docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, threshold: float = 0.5,
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """Documents with their measures, `base_failed`, `p_good` and `kept`.

    The measures are written once to the shared folder, since the model needs the votes of all documents before the
    first verdict; `carry` limits the input columns that travel with them.
    """
    carry = list(docs.columns if carry is None else carry)
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*carry, text])])
    rows = measured(source, text)
    kept_row = F.struct(*[F.col("row").getField(c).alias(c) for c in carry]).alias("row")
    names = [f"vote_{r.name}" for r in rules]
    rows = rows.select(kept_row, *rows.columns[1:])
    voted = stored(rows.select("*", *[vote(r).alias(n) for r, n in zip(rules, names, strict=True)]), "quality")
    model = fit_votes(vote_patterns(voted, names), len(names))
    failed = F.expr(FAILED)
    p_good = 1 / (1 + F.exp(-model.log_odds([F.col(n) for n in names]))) if names else F.lit(1.0)
    results = {m: F.col(m) for m in METRICS} | {
        "base_failed": failed, "p_good": p_good, "kept": ~failed & (p_good >= threshold),
    }
    return released(voted, carry, results)


def keep_good(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, threshold: float = 0.5) -> DataFrame:
    """The documents that are kept, with their own columns only."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{text}`").alias("text"))
    judged = quality(inner, "text", rules, threshold, carry=["doc"])
    return judged.filter("kept").select("doc.*")
