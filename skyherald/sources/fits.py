"""Bytes of a FITS binary table -> numpy columns (what `skymap` jobs need inside a task; no file access)."""

from __future__ import annotations

import math

import numpy as np

BLOCK = 2880
CARD = 80
# fixed values: big-endian numpy types of the FITS column formats
FORMATS = {"L": "i1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8", "A": "S"}


# header blocks that are remembered
SEEN = 1000


def _cards(block: bytes) -> tuple[dict[str, str], bool]:
    """The cards of a header block, and whether it is the last."""
    cards: dict[str, str] = {}
    for i in range(0, BLOCK, CARD):
        card = block[i : i + CARD].decode("ascii", "replace")
        key = card[:8].strip()
        if key == "END":
            return cards, True
        if card[8:10] == "= ":
            text = card[10:].strip()
            cards[key] = text[1:].split("'")[0].strip() if text.startswith("'") else text.split("/")[0].strip()
    return cards, False


def _header(data: bytes, pos: int, seen: dict) -> tuple[dict[str, str], int]:
    cards: dict[str, str] = {}
    while True:
        block = data[pos : pos + BLOCK]
        if len(block) < BLOCK:
            raise ValueError("FITS header without END")
        pos += BLOCK
        found, last = seen.get(block) or _cards(block)
        if len(seen) < SEEN:
            seen[block] = found, last
        cards |= found
        if last:
            return cards, pos


def _data_size(h: dict[str, str]) -> int:
    axes = [int(h[f"NAXIS{i + 1}"]) for i in range(int(h.get("NAXIS", "0")))]
    if not axes:
        return 0
    return abs(int(h["BITPIX"])) // 8 * (math.prod(axes) + int(h.get("PCOUNT", "0")))


def read_table(data: bytes, columns: list[str], seen: dict | None = None) -> dict[str, np.ndarray]:
    """The named columns of the first binary table in a FITS file.

    `seen` remembers header blocks from file to file, as maps of a kind have equal ones.
    """
    pos, seen = 0, {} if seen is None else seen
    while pos < len(data):
        h, pos = _header(data, pos, seen)
        if h.get("XTENSION") == "BINTABLE":
            kinds = []
            for i in range(1, int(h["TFIELDS"]) + 1):
                form = h[f"TFORM{i}"]
                count, code = form[:-1] or "1", form[-1]
                if code == "A":
                    kinds.append((h[f"TTYPE{i}"], f"S{count}"))
                elif count == "1":
                    kinds.append((h[f"TTYPE{i}"], FORMATS[code]))
                else:
                    kinds.append((h[f"TTYPE{i}"], FORMATS[code], (int(count),)))
            rows = np.frombuffer(data, np.dtype(kinds), count=int(h["NAXIS2"]), offset=pos)
            return {c: rows[c].astype(rows.dtype[c].newbyteorder("=")) for c in columns}
        pos += -(-_data_size(h) // BLOCK) * BLOCK
    raise ValueError("no binary table in the FITS data")
