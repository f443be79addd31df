"""Near copies against all pairs compared by their whole shingle sets."""

import random
import re

import corpus_pipeline as cp

SCHEMA = "doc_id long, text string, row string, node int, bands int, at int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept(rows):
    """Ids that stay: the smallest of each component of links at 0.8 or more, by brute force."""
    sets, up = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = top(i), top(j)
                up[x] = up[y] = min(x, y)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(doc)
    return sorted(min(g) for g in groups.values())


def test_near_copies_around_the_threshold(spark):
    rng = random.Random(5)
    texts = [None, "", "one", "One", "one two three", "one two three four"]
    # a pair whose sets have n shingles each, m of them shared: m / (2 n - m) is 0.70 to 0.90, exactly 0.8 among them
    for k, m in enumerate([*range(741, 853, 4), *[800] * 20] * 2):
        base = [f"w{k}x{rng.randrange(10**6)}" for _ in range(904)]
        texts += [" ".join(base), " ".join([*base[: m + 4], *[f"v{k}x{i}" for i in range(900 - m)]]).upper()]
    # a chain of texts, each 0.8 or more to the next
    base = [f"c{i}" for i in range(400)]
    texts += [" ".join(base[20 * i : 20 * i + 204]) for i in range(9)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "r", 1, 2, 3) for i, t in rows], SCHEMA)
    out = cp.simhash_dedup(spark, docs, "")
    assert out.dtypes == docs.dtypes
    assert sorted(r.doc_id for r in out.collect()) == kept(sorted(rows))


def test_dedup_stage_is_that_of_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert sorted(r.doc_id for r in cp.simhash_dedup(spark, docs, sf).collect()) == kept(rows)


def test_a_crowd_of_variants_of_one_text(spark):
    """Several hundred variants with one to many edits of one text: some are tied, some near the bound, some apart."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(1 + i % 9):
            words[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "r", 1, 2, 3) for i, t in rows], SCHEMA)
    got = sorted(r.doc_id for r in cp.simhash_dedup(spark, docs, "").collect())
    assert got == kept(sorted(rows)) and 2 < len(got) < 399


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    out = cp.simhash_dedup(spark, docs, "")
    assert out.dtypes == docs.dtypes and out.isEmpty()
