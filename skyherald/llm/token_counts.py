"""Token counts of whole texts, by the library a vocabulary file is made for.

Texts go to the tokenizer in batches of about BATCH_BYTES and only lengths come back, so that neither tokens nor texts
return to the JVM. Where the file's own rules make it safe, a text of more than PIECE_CHARS is cut into pieces that are
encoded one by one: no token of a byte-level vocabulary with the usual word pattern goes from a character that is not white
space into white space, and what follows such a place does not depend on what stands before it. For the same reason the
number of tokens of a word with the blanks before it is the same wherever it stands: under such vocabularies a worker gives
each different one to the library once and adds up. Other vocabularies, and runs without such a place, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyherald.llm.common import released

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 16
# a word with the blanks before it; white space that is no such blank may belong to a run of both
_WORD = re.compile("[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
_OTHER_SPACE = re.compile("[^\\S \t\r\n]")
# a worker remembers so many words, none longer than this
KNOWN_WORDS = 1 << 18
WORD_CHARS = 64
# before a blank after other text; in scripts without blanks, between a full stop or comma and a letter
_SAFE = re.compile("(?<=\\S)(?=[ \t\r\n])|(?<=[、。，！？；：])(?=[ぁ-ゖァ-ヺ一-龥가-힣])")


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text cut at safe places: each piece goes on to the first one after `size` characters."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if cut is None:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


def cuts_are_safe(vocabulary: dict) -> bool:
    """Whether a vocabulary file's rules keep a text's tokens the same when it is cut into `pieces`."""
    split, model = vocabulary.get("pre_tokenizer") or {}, vocabulary.get("model") or {}
    return (
        vocabulary.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space", True) and model.get("type") == "BPE" and not model.get("dropout")
        and not any(
            t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
            for t in vocabulary.get("added_tokens") or ()
        )
    )


def by_words(count: Callable[[list[str]], list[int]], most: int = KNOWN_WORDS) -> Callable[[list[str]], list[int]]:
    """`count` for texts that may be cut: each different word is counted once, as long as it is remembered."""
    known: dict[str, int] = {}

    def counted(texts: list[str]) -> list[int]:
        if len(known) > most:
            known.clear()
        words = [_WORD.findall(t) if _OTHER_SPACE.search(t) is None else [t] for t in texts]
        fresh = list(set(chain.from_iterable(words)).difference(known))
        known.update(zip(fresh, count(fresh), strict=True))
        out = [sum(map(known.__getitem__, w)) for w in words]
        for w in fresh:
            if len(w) > WORD_CHARS:
                del known[w]
        return out

    return counted


def loaded(path: str) -> tuple[Callable[[list[str]], list[int]], bool]:
    """(texts -> numbers of tokens, whether texts may be cut) for a .json or .model file."""
    if path.endswith(".json"):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            safe = cuts_are_safe(json.load(file))

        def count(texts: list[str]) -> list[int]:
            return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

        return by_words(count) if safe else count, safe
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        processor = SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in processor.encode(texts, num_threads=1)], False
    raise ValueError(f"no library for the vocabulary file {path}: .json or .model")


def lengths(texts: Sequence[str], count: Callable[[list[str]], list[int]], safe: bool, size: int = PIECE_CHARS) -> list[int]:
    """Number of tokens of each text; the tokenizer gets batches of about BATCH_BYTES characters."""
    out = [0] * len(texts)
    batch: list[str] = []
    owners: list[int] = []
    held = 0

    def flush() -> None:
        for owner, n in zip(owners, count(batch), strict=True):
            out[owner] += n
        batch.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for piece in pieces(text, size) if safe else (text,):
            if batch and held + len(piece) > BATCH_BYTES:
                flush()
                held = 0
            batch.append(piece)
            owners.append(i)
            held += len(piece)
    if batch:
        flush()
    return out


def _counter(path: str):
    @F.arrow_udf("long")
    def n_tokens(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        count, safe = loaded(path)
        for column in columns:
            out, lo = [], 0
            # texts become Python strings a slice at a time
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            while lo < len(column):
                hi, held = lo, 0
                while hi < len(column) and (hi == lo or held + sizes[hi] <= BATCH_BYTES):
                    held += sizes[hi]
                    hi += 1
                out += lengths([t or "" for t in column[lo:hi].to_pylist()], count, safe)
                lo = hi
            yield pa.array(out, pa.int64())

    return n_tokens


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 512, carry: Sequence[str] | None = None
) -> DataFrame:
    """Documents with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more than `limit` tokens).

    `vocabulary` is the path of a .json file (library tokenizers) or .model file (sentencepiece) that every executor
    sees. No begin, end or other special tokens are added; strings of special tokens inside a text are what the library
    takes them for. A null or empty text has no bytes and no tokens; rows of equal ids are each counted; columns of the
    results' names are replaced; an empty table gives an empty table.
    """
    carry = list(docs.columns if carry is None else carry)
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(row, F.octet_length(whole).cast("long").alias("size"), _counter(vocabulary)(whole).alias("tokens"))
    return released(rows, carry, {
        "n_bytes": F.col("size"), "n_tokens": F.col("tokens"), "over_limit": F.col("tokens") > F.lit(limit),
    })
