"""Which sets the near-copy search compares: by fingerprints first, and not all pairs of a crowd."""

import random

import corpus_pipeline as cp
import numpy as np
import pyarrow as pa
from skyherald.llm import jaccard
from skyherald.llm.tokens import text_slices

from test_jaccard import SCHEMA, kept


def variants(count, edits, size=150, seed=4):
    rng = random.Random(seed)
    base, out = [f"b{i}" for i in range(size)], []
    for _ in range(count):
        words = list(base)
        for at in rng.sample(range(size), edits):
            words[at] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def test_fingerprints_are_majorities_of_the_shingles():
    texts = [*variants(20, 3), "one", "", "a b c d e f"]
    for _, _, w in text_slices(pa.array(texts)):
        owner, h = jaccard.shingles_of(w, 5)
        fp = jaccard.sketches_of(w, 5)[-1]
        for row in range(len(texts)):
            own = h[owner == row].tolist()
            plain = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in own) > len(own))
            assert int(fp[row]) == plain


def test_near_fingerprints_propose_pairs(spark):
    # one word of 4,000: the fingerprints differ in few bits
    texts = variants(12, 1, 4000)
    seen = []
    for _, _, w in text_slices(pa.array(texts)):
        n, _, _, _, fp = jaccard.sketches_of(w, 5)
        seen += zip(n.tolist(), fp.view(np.int64).tolist(), strict=True)
    classes = spark.createDataFrame([(i, n, 1, fp) for i, (n, fp) in enumerate(seen)], "node long, n long, copies long, fp0 long")
    pairs = {(r.u, r.v) for r in jaccard._fingerprint_pairs(classes, 0.8).collect()}
    assert len(pairs) >= 10 and len(pairs) < 12 * 2


def test_a_crowd_below_the_bound_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Each two of 300 variants have a similarity of about 0.67: all meet in bands, hardly any may link."""
    compared, linked = [], jaccard._linked
    monkeypatch.setattr(jaccard, "_linked", lambda pairs, sets, least: (compared.append(pairs.count()), linked(pairs, sets, least))[1])
    rows = list(enumerate(variants(300, 3)))
    docs = spark.createDataFrame([(i, t, "r", 1, 2, 3) for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in cp.simhash_dedup(spark, docs, "").collect()) == kept(rows)
    assert sum(compared) <= 10 * len(rows)
