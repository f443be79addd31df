"""Token counts by words: each different word goes to the library once, and the sums are the library's own counts."""

import random

from tokenizers import Tokenizer

from skyherald.llm import token_counts as tk
from skyherald.llm.queries import vocabulary_path

ODD = (
    "", " ", "\n", "  a", "a  ", "a  b", "a   b c", "　 a", "a   b", "it's  we'll 'd", "x\t\t y\r\n\r\n  z",
    "a\x1c b", "<|endoftext|>", "a  <|endoftext|> b", "a<|endoftext|>  b", "3.14  15,9 ...  !!", "今日は、良い天気。 明日も。", "é ́ a",
    "\x0b \x0c a", "\u0085 a", "word" * 50 + " " * 70 + "end", "🙂 🙂🙂  🙂",
)


def test_sums_over_words_are_the_counts_of_whole_texts():
    plain = Tokenizer.from_file(vocabulary_path())
    plain.no_truncation()
    plain.no_padding()
    count, safe = tk.loaded(vocabulary_path())
    assert safe
    rng = random.Random(5)
    parts = ["a", "the", "don't", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\x0b", "\x1d", "12", "...", "<|endoftext|>", "、", "良い", "é"]
    texts = [*ODD, *("".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(3000))]
    want = [len(plain.encode(t, add_special_tokens=False)) for t in texts]
    assert tk.lengths(texts, count, safe) == want
    # remembered words give the same counts, and so does a worker that forgets
    assert tk.lengths(texts, count, safe) == want
    forgets = tk.by_words(lambda ts: [len(plain.encode(t, add_special_tokens=False)) for t in ts], most=3)
    assert [n for t in texts for n in forgets([t])] == want


def test_a_word_is_encoded_once(monkeypatch):
    given = []
    encode = Tokenizer.encode_batch_fast

    class Counting:
        def __init__(self, inner):
            self.inner = inner

        def no_truncation(self):
            self.inner.no_truncation()

        def no_padding(self):
            self.inner.no_padding()

        def encode_batch_fast(self, texts, **kw):
            given.extend(texts)
            return encode(self.inner, texts, **kw)

    class Library:
        @staticmethod
        def from_file(path):
            return Counting(Tokenizer.from_file(path))

    monkeypatch.setattr("tokenizers.Tokenizer", Library)
    count, safe = tk.loaded(vocabulary_path())
    texts = ["some words again and again " * 2000] * 5
    tk.lengths(texts, count, safe)
    assert sum(map(len, given)) < 1000
