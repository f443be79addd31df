"""Random keys of each encoding, hexadecimal ones included, against text in the same letters."""

import random
from collections import Counter

import pytest
from skyherald.llm import secrets

DOCS = "doc_id long, text string"


def key(rng, name, alphabet, n):
    """A random key that no smaller alphabet holds, with a digit and a letter."""
    before = [a for other, a in secrets.ENCODINGS[: [e for e, _ in secrets.ENCODINGS].index(name)]]
    while True:
        t = "".join(rng.choice(alphabet) for _ in range(n))
        if any(c.isdigit() for c in t) and any(c.isalpha() for c in t) and not any(set(t) <= set(a) for a in before):
            return t


@pytest.mark.parametrize("lengths, least", [((20, 24, 31), 0.6), ((40, 64), 0.8)])
def test_keys_of_every_encoding_are_found(spark, lengths, least):
    rng = random.Random(4)
    # lower-case hex keys of 32 or more are base spans
    keys = [(name, key(rng, name, a, n)) for name, a in secrets.ENCODINGS for n in lengths
            if n >= secrets.least_length(a) for _ in range(30)]
    rows = [(i, "key " + t) for i, (_, t) in enumerate(keys)]
    got = {r.doc_id for r in secrets.secret_scan(spark.createDataFrame(rows, DOCS)).collect() if r.secrets}
    drawn, found = Counter(name for name, _ in keys), Counter(name for i, (name, _) in enumerate(keys) if i in got)
    assert drawn.keys() == {name for name, _ in secrets.ENCODINGS}
    share = {name: round(found[name] / drawn[name], 2) for name in drawn}
    print(lengths, share)
    assert min(share.values()) >= least, share


def test_text_in_hexadecimal_letters_is_no_key(spark):
    text = ["FACADE" * 4 + "2024", "deadbeef" * 3 + "1", "20240131" * 3 + "A", "0000000000000000000000ff", "DEADBEEF00000000DEADBEEF"]
    rows = list(enumerate(text * 30))
    found = secrets.secret_scan(spark.createDataFrame(rows, DOCS)).collect()
    assert not [r.text for r in found if r.secrets]
