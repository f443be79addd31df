"""Source divergence, conversation tries and token counts against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from skyherald.llm import divergence, prefix_trie, token_counts

public_tokenizers = pytest.importorskip("public_tokenizers")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- source divergence ---------------------------------------------------------------------------------------


def plain_divergence(rows, least_docs, top=10):
    rows = [(lang or "", source or "", TERM.findall((text or "").translate(SMALL))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == lang]
        docs = Counter(t for _, _, terms in mine for t in set(terms))
        kept = sorted(t for t, n in docs.items() if n >= least_docs)
        counts = {s: Counter(t for _, s2, terms in mine if s2 == s for t in terms if t in set(kept)) for s in {r[1] for r in mine}}
        whole = sum(counts.values(), Counter())

        def weight(c, kept=kept):
            n = sum(c.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 2) // n for t in kept}

        w, q = {s: weight(c) for s, c in counts.items()}, weight(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            parts = {
                "pair": [(o, sum(f(w[s][t], w[o][t]) for t in kept)) for o in counts if o != s],
                "term": [(t, f(w[s][t], q[t])) for t in kept if counts[s][t] and w[s][t] > q[t]],
            }
            for part, found in parts.items():
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(found, 1) if part == "pair" or r <= top]
    return sorted(out)


def text_rows(n, sources, seed):
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "abcdefghij" for b in "xyzé"] + ["The", "THE", "don't", "naïve", "中文", "a1b", "_"]
    skew = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = [
        (rng.choice(["en", "de", None]), rng.choice(sources), " ".join(rng.choices(vocabulary, skew, k=rng.randint(0, 60))))
        for _ in range(n)
    ]
    return rows + [("en", "bare", None), ("xx", "one", "lonely words"), ("xx", None, ""), ("xx", "two", "b b"), rows[0], rows[0]]


@pytest.mark.parametrize("sources", [["s1", "s2", "S3", None], [f"s{i}" for i in range(90)]])
def test_divergence_equals_the_plain_sums(spark, sources, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_WORDS", 1)
    rows = text_rows(220, sources, len(sources))
    given = spark.createDataFrame([(*r, "t", 1) for r in rows], "lang string, source string, text string, term string, n int")
    got = sorted(tuple(r) for r in divergence.source_divergence(given, least_docs=5).collect())
    assert got == plain_divergence(rows, 5)
    assert {r[0] for r in got if r[2] == "pair" and r[4] == 0} >= {"xx"}


def test_divergence_of_nothing(spark):
    empty = spark.createDataFrame([], "lang string, source string, text string")
    assert divergence.source_divergence(empty).count() == 0
    long = spark.createDataFrame([("en", s, " ".join(f"w{i % 977}" for i in range(n))) for s, n in (("a", 300_000), ("b", 40))] * 10, empty.schema)
    got = [tuple(r) for r in divergence.source_divergence(long).collect()]
    assert sorted(got) == plain_divergence([tuple(r) for r in long.collect()], 10)


def test_weights_are_exact_beyond_64_bits(spark):
    rows = [(0, 0, 7), (10**13, 3 * 10**13, 10**6), (5, 10**18, 1), (2**40 - 3, 2**41, 12345)]
    frame = spark.createDataFrame(rows, "n long, total long, kinds long")
    got = [r.w for r in frame.select(divergence.weight("n").alias("w")).collect()]
    assert got == [1 + 10**9 * (n + 2) // (t + 2 * v) for n, t, v in rows]


# --- conversation trie ---------------------------------------------------------------------------------------


def plain_trie(rows, rebuild=True):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[c].append((turn is not None, turn or 0, digest, role, text))
    convs = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    if rebuild:
        given = convs
        convs = {}
        for c, own in given.items():
            h = zlib.crc32(str(c).encode()) % 9
            base = c - int(np.fmod(c, 5))
            convs[c] = given.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    kids, out = defaultdict(list), []
    for path in members:
        if path:
            kids[path[:-1]].append(path)

    below = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        inner = [below[k] for k in kids[path]]
        below[path] = (sum(x[0] for x in inner) or 1, own + sum(x[1] for x in inner))
    for path, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(path))
        out.append((m[0], len(path), members[path[:-1]][0] if path else None, len(m), len(kids[path]), *below[path],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n=150):
    rng = random.Random(seed)
    say = lambda: rng.choice(["hello", "hello", "hi", "", None, "ça va", "x" * 50])
    rows = []
    for c in [*range(n), -7, -5, 10**15]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 9, 12])):
            rows.append((c, rng.choice([t, t, t, t, None]), rng.choice(["user", "assistant", None]), say()))
    common = [(t, "user", f"turn {t % 3}") for t in range(100)]
    rows += [(c, *turn) for c in range(1000, 1040) for turn in common]
    rows += [(c, *turn) for c in range(1040, 1050) for turn in [*common[: 30 + 7 * (c % 10)], (200, "user", "end"), (200, "user", "end")]]
    rows += [(None, 1, "user", "lost"), (2000, None, None, None), (2001, None, None, None)]
    rng.shuffle(rows)
    return rows


TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize(("partitions", "rebuild"), [("1", True), ("9", True), ("40", False)])
def test_trie_equals_the_plain_one(spark, partitions, rebuild):
    rows = conversations(int(partitions))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS + ", depth int, node string")
        got = [tuple(r) for r in prefix_trie.prefix_trie(frame, rebuild=rebuild).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(got, key=str) == plain_trie(rows, rebuild)


def test_trie_of_little(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    # of family 5 (h = 8 for 6) only 6 has turns: its first eight go
    rows = [(6, t, "user", str(t)) for t in range(3)]
    got = [tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()]
    assert sorted(got, key=str) == plain_trie(rows)


def test_shared_turns_over_blocks():
    rng = np.random.default_rng(3)
    rows = [list(rng.integers(0, 2, rng.integers(0, 5))) for _ in range(40)] + [[1] * n for n in (31, 32, 33, 64, 65, 65, 90)]
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.array([x for r in rows for x in r], np.int64)
    paths = prefix_trie.Paths(flat, flat * 3, first)
    order = paths.order(np.arange(len(rows)))
    assert [rows[i] for i in order] == sorted(rows)
    want = [next((k for k, (x, y) in enumerate(zip(rows[i], rows[j])) if x != y), min(len(rows[i]), len(rows[j]))) for i, j in zip(order, order[1:])]
    assert paths.shared(order).tolist() == want


# --- token counts --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, name):
    path = public_tokenizers.path(name)
    texts = [None, "", " ", "one two", "a<|endoftext|>b", "don't  stop\n\n now", "中文。中文，한국", "x" * 70_000, "tok en " * 40_000, "é " * 90_000]
    docs = spark.createDataFrame([(i, t, "n", True) for i, t in enumerate([*texts, texts[3]])], "doc_id long, text string, n_tokens string, row boolean")
    if name.endswith("json"):
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        want = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        want = lambda t: len(library.encode(t))
    got = token_counts.count_tokens(docs, path).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = r.text or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), want(text)) and r.over_limit == (r.n_tokens > 512)
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def test_safe_cuts_leave_the_count_alone():
    count, safe = token_counts.loaded(public_tokenizers.path("byte_bpe_50k.json"))
    assert safe and not token_counts.loaded(public_tokenizers.path("word_bpe_49k.json"))[1]
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", " \n", "a", "b", "'s", "'", "é", "。", "中", "、", "1", "<|endoftext|>", "!", "　", "\x1c", "\xa0", "\r\n", "한"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
        assert token_counts.lengths([text], count, True, size=rng.randint(1, 8)) == count([text])
        assert "".join(token_counts.pieces(text, 3)) == text
    with pytest.raises(ValueError, match="no library"):
        token_counts.loaded("vocabulary.txt")
