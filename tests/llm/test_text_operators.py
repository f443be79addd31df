"""Each text operator against a plain version, on made rows and on the smallest given tables."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyherald.llm import decontaminate, language, licenses, packing, pii, quality, repeats, secrets, simhash, warc
from skyherald.llm.common import regex_spans
from skyherald.llm.tokens import text_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"
# columns whose names the operators use themselves
CLASHING = "doc_id long, text string, row string, n_words int, kept string, fp0 string, spans string, matches int, piece int, k1 int, t int"


def words(text):
    return WORD.findall(text or "")


def odd_rows():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(40)] + ["the", "éa", "#x", "IDIOT!!", "😀"]
    texts = [None, "", "  \n\t ", "one", "one two", "one two three", "\nA line\nA line\n\nA line \nlast"]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(3, 120))) for _ in range(40)]
    long = " ".join(rng.choice(vocabulary) for _ in range(400))
    texts += [long, long, long.upper(), long[:900], "x " + long + "\n\ny", " ".join(f"v{i}" for i in range(60_000))]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, rows[10], rows[10], (None, texts[12]), (None, None)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, "r", 1, "k", "f", "s", 2, 3, 4, 5) for i, t in odd_rows()[:30]]
    return spark.createDataFrame(rows, CLASHING)


OPERATORS = {
    "repeats": lambda d: repeats.remove_repeats(d, min_words=5),
    "packing": packing.packed,
    "simhash": simhash.near_duplicates,
    "licenses": licenses.license_scan,
    "quality": quality.quality,
    "pii": pii.find_pii,
    "secrets": secrets.secret_scan,
    "language": lambda d: language.identify(d, language.learn(d.withColumn("lang", F.lit("en")))),
    "decontaminate": lambda d: decontaminate.find_contamination(
        d, d.sparkSession.createDataFrame([(1, "w1 w2 w3"), (2, None), (3, " ")], "item_id long, text string")
    ),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_and_clashing_names(spark, clashing, name):
    assert OPERATORS[name](spark.createDataFrame([], DOCS)).count() == 0
    out = OPERATORS[name](clashing)
    rows = out.collect()
    expected = Counter(r.doc_id for r in clashing.collect())
    assert set(Counter(r["doc_id"] for r in rows)) == set(expected)
    assert {"doc_id", "text", "row", "t"} <= set(out.columns)
    assert all(r["row"] == "r" and r["t"] == 5 for r in rows)


# --- substring repeats ---------------------------------------------------------------------------------------


def plain_repeats(rows, size):
    docs = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in docs for i in range(len(w) - size + 1))
    out = []
    for (row_id, _), w in zip(rows, docs, strict=True):
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((row_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize(("size", "bin_words"), [(3, 100), (5, 1_000_000), (35, 200), (12, 50)])
def test_repeats_equal_brute_force(odd, size, bin_words):
    got = repeats.remove_repeats(odd, min_words=size, bin_words=bin_words)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got.collect()]
    assert sorted(got, key=str) == plain_repeats(odd_rows(), size)


def test_repeats_inside_one_text_and_overlap(spark):
    rows = [(1, "a a a a a a a"), (2, "p q r s p q r t q r s p"), (3, "q r s")]
    got = repeats.remove_repeats(spark.createDataFrame(rows, DOCS), min_words=3)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got.collect()) == plain_repeats(rows, 3)


def test_subtree_finds_weighted_leaves():
    codes = np.array([1, 2, 3, 4, 9, 2, 3, 4, 7, 7, 7], dtype=np.uint64)
    first = np.array([0, 5, 8, 11])
    run_of = np.repeat([0, 1, 2], np.diff(first))
    mask = repeats.deep_leaves(codes, run_of, first, np.array([1, 1, 1]), 3)
    assert np.flatnonzero(mask).tolist() == [1, 5]
    mask = repeats.deep_leaves(codes, run_of, first, np.array([1, 1, 2]), 3)
    assert np.flatnonzero(mask).tolist() == [1, 5, 8]


# --- SimHash -------------------------------------------------------------------------------------------------


def plain_fingerprint(text, shingle=3):
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(set(fps)), 2):
        if (a ^ b).bit_count() <= distance:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    least = {}
    for f, i in zip(fps, ids, strict=True):
        if i is not None:
            least[find(f)] = min(least.get(find(f), i), i)
    return [least.get(find(f)) for f in fps]


def test_simhash_equals_brute_force(odd):
    rows = [r for r in odd_rows() if len(r[1] or "") < 20_000]
    got = simhash.near_duplicates(odd.filter("coalesce(length(text), 0) < 20000"))
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps, [i for i, _ in rows], 3)
    expected = sorted(((i, f"{f:016x}", c) for (i, _), f, c in zip(rows, fps, roots, strict=True)), key=str)
    found = got.collect()
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == expected
    assert sum(r.stays for r in found) == len({(r.component_id, r.fingerprint if r.component_id is None else "") for r in found})


@pytest.mark.parametrize("distance", [1, 2, 3, 5, 8])
def test_fingerprint_links_in_dense_groups(spark, distance):
    rng = random.Random(distance)
    fps = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(40):
            f = centre
            for b in rng.sample(range(64), rng.randint(0, distance)):
                f ^= 1 << b
            fps.append(f)
    fps += [0, 1, 3, (1 << 64) - 1, 1 << 63]
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f, 1) for f in signed], "fp0 long, copies long")
    root = {r.node: r.root for r in simhash.fingerprint_classes(df.select("copies", "fp0"), distance, ["fp0"]).collect()}
    groups = Counter(frozenset(s for s in signed if root.get(s, s) == r) for r in {root.get(s, s) for s in signed})
    plain = plain_components(fps, signed, distance)
    assert groups == Counter(frozenset(s for s, c in zip(signed, plain, strict=True) if c == r) for r in set(plain))


# --- quality, packing ----------------------------------------------------------------------------------------


def plain_measures(text):
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdict(odd):
    got = quality.quality(odd).collect()
    by_text = {t: plain_measures(t) for _, t in odd_rows()}
    for r in got:
        measures = by_text[r.text]
        assert tuple(r[m] for m in quality.METRICS) == measures
        assert r.base_failed == (measures[0] < 50 or 100 * measures[4] > 50 * measures[0])
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)


def test_votes_of_good_rules_outweigh_noise():
    rng = random.Random(1)
    counts, truth = Counter(), {}
    for _ in range(20_000):
        good = rng.random() < 0.85
        vote = lambda p: (1 if good else -1) * (1 if rng.random() < p else -1)  # noqa: B023, E731
        pattern = (vote(0.95), vote(0.9), vote(0.9), rng.choice((-1, 1)), 0)
        counts[pattern] += 1
        truth.setdefault(pattern, Counter())[good] += 1
    model = quality.fit_votes(list(counts.items()), 5)
    accuracy = model.accuracies()
    assert abs(model.prior - 0.85) < 0.03 and accuracy[0] > 0.9 and accuracy[3] < 0.6
    right = 0
    for pattern, seen in truth.items():
        odds = math.log(model.prior / (1 - model.prior)) + sum(w[v + 1] for v, w in zip(pattern, model.weights(), strict=True))
        right += seen[odds > 0]
    assert right / 20_000 > 0.96


def test_quality_verdicts_follow_the_labels(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.quality(docs, carry=["doc_id"]).filter("not base_failed").join(labels, "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in judged) >= 0.95 * len(judged)


def test_bucket_bounds_are_optimal():
    rng = random.Random(2)
    for _ in range(200):
        histogram = {rng.randint(1, 30): rng.randint(1, 9) for _ in range(rng.randint(1, 8))}
        k, lengths = rng.randint(1, 5), sorted(histogram)
        padding = lambda bounds: sum(c * (min(b for b in bounds if b >= n) - n) for n, c in histogram.items())  # noqa: B023, E731
        least = min(
            padding(bounds) for r in range(1, k + 1) for bounds in itertools.combinations(lengths, min(r, len(lengths)))
            if bounds[-1] == lengths[-1]
        )
        bounds, padded = packing.optimal_bounds(histogram, k)
        assert padded == padding(bounds) == least and len(bounds) <= k
    assert packing.optimal_bounds({}, 3) == ([], 0)


@pytest.mark.parametrize("rows_per_slice", [7, 1000])
def test_packing_keeps_every_token_in_full_batches(odd, rows_per_slice):
    got = packing.packed(odd, max_len=100, buckets=4, token_budget=600, rows_per_slice=rows_per_slice).collect()
    expected = Counter()
    for i, text in odd_rows():
        n = len(words(text))
        expected.update((i, p, min(100, n - 100 * p)) for p in range(max(1, -(-n // 100))))
    assert Counter((r.doc_id, r.piece, r.n_tokens) for r in got) == expected
    batches = {}
    for r in got:
        assert (r.bucket_len is None) == (r.n_tokens == 0)
        if r.bucket_len:
            assert r.n_tokens <= r.bucket_len
            batches.setdefault(r.bucket_len, {}).setdefault(r.batch_no, []).append(r.slot)
    assert len(batches) <= 4
    for bucket, members in batches.items():
        room = max(1, 600 // bucket)
        assert sorted(members) == list(range(len(members)))
        assert all(sorted(slots) == list(range(len(slots))) for slots in members.values())
        assert [len(members[b]) for b in sorted(members)][:-1] == [room] * (len(members) - 1)


# --- scans ---------------------------------------------------------------------------------------------------


def plain_secrets(text):
    text, out = text or "", []
    for m in re.finditer(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.A):
        out += [(m.start(), 0, m.end(), "assign")] * (len(m[2]) >= 8)
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_secret_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    bits = ["token", "secret", "API_KEY", "apikey", "=", " ", ":", "'", '"', "AKIA", "ABCDEFGH", "abc123", "é", "😀", "deadbeef", "01234567", "\n"]
    rows = [(0, None), (1, ""), (2, "token=secret : abcdefghijkl"), (3, 'token="deadbeef" ' * 700)]
    rows += [(i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 60)))) for i in range(4, 120)]
    got = secrets.secret_scan(spark.createDataFrame(rows, DOCS)).collect()
    assert {r.doc_id: [(s.start, s["end"], s.kind) for s in r.secrets if s.base] for r in got} == {i: plain_secrets(t) for i, t in rows}


def test_random_tokens_pass_and_text_does_not(spark):
    rng = random.Random(9)
    keys = [(i, "key " + "".join(rng.choice(a) for _ in range(n))) for i, (a, n) in enumerate(
        (a, n) for _, a in secrets.ENCODINGS for n in (40, 64) for _ in range(20)
    )]
    # none of these holds a base span: those stay whatever the tests say
    text = [(1000 + i, t) for i, t in enumerate(["x1" * 30, "z" * 38 + "1", "xyzxyzxyz123" * 4] * 30)]
    found = secrets.secret_scan(spark.createDataFrame(keys + text, DOCS)).collect()
    hit = {r.doc_id for r in found if r.secrets}
    assert len([i for i in hit if i < 1000]) >= 0.85 * len(keys)
    assert not [i for i in hit if i >= 1000]


def test_regex_spans_over_many_matches(spark):
    text = "é" + " ab" * 1500
    row = spark.createDataFrame([(text,)], "t string").select(regex_spans(F.col("t"), "ab").alias("s")).first()
    assert [(s.start, s["end"]) for s in row.s] == [m.span() for m in re.finditer("ab", text)]


def plain_pii(text):
    text, out = text or "", []
    out += [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        out += [(1, *m.span())] * all(int(p) <= 255 for p in m[0].split("."))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10
        out += [(2, *m.span())] * (16 <= len(d) <= 19 and luhn == 0)
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_pii_base_spans_equal_brute_force():
    rng = random.Random(3)
    bits = ["a", "b.c", "@", "@@", ".", "-", "+", "1", "12", "255", "256", "0004", " ", "(", "555", ")", "4539", "578763621486",
            "4994226020900891", "x@y.z", "com", "\n", "é", "%_", "+1 (555) 123-4567", "٣"]
    for _ in range(4000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 25)))
        assert [(s["kind"], s["start"], s["end"]) for s in pii.spans_of(text)[0]] == plain_pii(text), text


def test_pii_adds_spans_and_redacts(spark):
    rng = random.Random(4)
    digit = lambda n: "".join(rng.choice("23456789") for _ in range(n))
    rows = [(i, f"please call the phone {digit(3)}-{digit(3)}-{digit(4)} or mail x{i}@mail.com, ssn 212-34-{digit(4)} ok") for i in range(60)]
    rows += [(100 + i, f"order 7{digit(9)} version 1.2.3.{i} é") for i in range(60)] + [(200, None)]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    kinds = {r.doc_id: [s.kind for s in r.spans] for r in pii.find_pii(docs).collect()}
    assert all("email" in kinds[i] and "phone_local" in kinds[i] for i in range(60))
    clean = {r.doc_id: r for r in pii.redact(docs).collect()}
    assert clean[0].text.startswith("please call the phone [PHONE_LOCAL] or mail [EMAIL], ssn ")
    assert clean[0].n_chars == len(clean[0].text) and clean[200].text is None
    assert clean[100].text == "order " + rows[60][1].split()[1] + " version [IP] é"


def test_licences_by_dice(spark):
    mit = licenses.TEMPLATES[2][1]
    rows = [
        (1, "intro\nReleased under the MIT license\nmore"), (2, "Released under the MIT"), (3, None),
        (4, "x\n\n" + "\n".join(mit[i : i + 60] for i in range(0, len(mit), 60)).replace("\n", "\n") + "\n\nend"),
        (5, "nothing of the kind, all rights of course reserved"), (6, "All rights reserved."),
    ]
    got = {r.doc_id: {m.name for m in r.licenses} for r in licenses.license_scan(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[1] == {"MIT"} and got[3] == set() and got[5] == set() and got[6] == {"Proprietary"}

    def dice(a, b):
        return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0

    for i, text in rows:
        t, expected = re.sub(r"[^a-z0-9\n]+", " ", (text or "").lower()), set()
        units = t.split("\n") + [p for p in re.split(r"\n *\n", t) if "\n" in p.strip(" ")]
        for paragraph in re.split(r"\n[^a-z0-9\n]*\n", (text or "").lower()):
            ends = re.split(r"""[.!?]+["')\]]*(?:[ \t\n\r]|\Z)""", paragraph.replace("|", " "))
            units += [" ".join(ends[x : x + k]) for x in range(len(ends)) for k in range(1, licenses.RUN + 1)]
        for u in units:
            found = [(dice(set(licenses.template_bigrams(u)), set(licenses.template_bigrams(x))), n) for n, x in licenses.TEMPLATES]
            expected |= {n for d, n in found if d >= licenses.LEAST and d == max(found)[0]}
        assert got[i] == expected, i


# --- language ------------------------------------------------------------------------------------------------


def test_language_held_out_accuracy_and_mixed_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = language.held_out(F.col("doc_id"))
    model = language.learn(docs.filter(~out))
    got = language.identify(docs, model).select("*", out.alias("held")).collect()
    held = [r for r in got if r.held]
    assert held and all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    texts = {r.lang: r.text for r in got if 300 <= r.n_chars <= 3000}
    mixed = spark.createDataFrame([(1, texts["en"][:300] + " " + texts["de"][:300]), (2, "123 !"), (3, None)], DOCS)
    rows = {r.doc_id: r for r in language.identify(mixed, model).collect()}
    assert [s.lang for s in rows[1].lang_spans] == ["en", "de"] and abs(rows[1].lang_spans[0]["end"] - 300) < 15
    assert (rows[2].lang_pred, rows[2].score, rows[3].lang_pred) == ("und", 0.0, "und")


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(60):
        sizes = rng.integers(1, 7, size=4)
        scores = (rng.normal(size=(sizes.sum(), 3)) * 3).astype(np.float32)
        first = np.concatenate([[0], np.cumsum(sizes)])
        labels = language.viterbi(scores, first, 1.5)
        for d in range(4):
            s = scores[first[d] : first[d + 1]].astype(float)
            value = lambda path: sum(s[i, x] for i, x in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))  # noqa: B023, E731
            assert abs(value(labels[first[d] : first[d + 1]]) - max(map(value, itertools.product(range(3), repeat=len(s))))) < 1e-4


# --- decontamination -----------------------------------------------------------------------------------------


def edit_distance(pattern, text, anchored):
    row = list(range(len(text) + 1)) if anchored else [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        now = [i]
        for j, c in enumerate(text, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (p != c)))
        row = now
    return min(row), row.index(min(row))


def test_myers_equals_the_matrix():
    rng = random.Random(1)
    for _ in range(1500):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 12)))
        t = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 20)))
        for anchored in (False, True):
            got, expected = decontaminate.myers(decontaminate.peq(p), len(p), t, anchored), edit_distance(p, t, anchored)
            assert got[0] == expected[0] and (got[0] == len(p) or got == expected)


@pytest.mark.parametrize("block_chars", [60, 1_000_000])
def test_contamination_equals_brute_force(spark, block_chars):
    rng = random.Random(8)
    letters = "abcdefghij "
    items = [(i, "".join(rng.choice(letters) for _ in range(rng.randint(20, 50)))) for i in range(12)] + [(90, None), (91, "?"), (3, "Repeated id item, the long one")]
    rows = [(0, None), (1, "")]
    for i in range(2, 60):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 200)))
        if i % 2:
            item = list(rng.choice(items[:12])[1].upper())
            for _ in range(rng.randint(0, 4)):
                item[rng.randrange(len(item))] = rng.choice(letters)
            at = rng.randint(0, len(text))
            text = text[:at] + " -- " + "".join(item) + "!" + text[at:]
        rows.append((i, text))
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_contamination(docs, bench, error_rate=0.1, block_chars=block_chars).collect()
    for r in got:
        text, expected = decontaminate.normal(r.text), []
        for key, item in items:
            item = decontaminate.normal(item)
            if item:
                distance, end = edit_distance(item, text, False)
                expected += [(key, distance, end)] * (distance <= int(0.1 * len(item)))
        assert sorted((m.item_id, m.distance, m["end"]) for m in r.matches) == sorted(expected)
        assert r.contaminated == bool(expected)
        for m in r.matches:
            distances = [edit_distance(decontaminate.normal(t), text[m.start : m["end"]], True)[0] for k, t in items if k == m.item_id]
            assert m.distance in distances
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench, error_rate=0.1).collect()}
    assert kept == {r.doc_id for r in got if not r.contaminated}


# --- WARC ----------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    big = "<p>é" + "x" * 1500
    rows = [(1, "u1", big), (5, "u5", big), (3, "u\r\n3", big), (7, None, "small"), (8, "u8", "small"), (9, "u9", None), (None, "n", big),
            (10, "v", "z" * 999), (11, "v", "z" * 999), (12, "w", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.archived(pages, file_bytes=4000).collect()
    assert len(got) == len(rows)
    for r in got:
        page = next(x for x in rows if (None if r.record_id is None else int(r.record_id)) == x[0])
        full = (page[2] or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(full), hashlib.sha1(full).hexdigest())
        revisit = page[2] == big and page[0] != 5
        assert r.record_type == ("revisit" if revisit else "response") and r.refers_to == ("5" if revisit else None)
        assert bytes(r.payload) == (b"" if revisit else full)
    assert warc.archived(spark.createDataFrame([], pages.schema)).count() == 0


def test_warc_streams_any_gzip_layout(tmp_path):
    raw = b"".join(warc.record(str(i), "response", "u", hashlib.sha1(b"p" * i).hexdigest(), b"p" * i, i, None) for i in range(200))
    pack = lambda data: (lambda c: c.compress(data) + c.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
    for packed in (pack(raw), pack(raw[:5000]) + pack(raw[5000:])):
        (tmp_path / "a.gz").write_bytes(packed)
        with open(tmp_path / "a.gz", "rb") as f:
            got = [(fields["warc-record-id"], len(payload)) for fields, _, payload in warc.records_of(warc.inflated(f, 97))]
        assert got == [(f"<urn:page:{i}>", i) for i in range(200)]
    with pytest.raises(ValueError, match="truncated"):
        list(warc.records_of(iter([raw[:-10]])))


# --- shared --------------------------------------------------------------------------------------------------


def test_tokens_equal_the_pattern():
    import pyarrow as pa

    rows = [t for _, t in odd_rows()]
    for limit in (1, 64, 1 << 20):
        got = [[w.decode() for w in part.row_bytes(r)] for lo, hi, part in text_slices(pa.array(rows), limit) for r in range(hi - lo)]
        assert got == [words(t) for t in rows]
