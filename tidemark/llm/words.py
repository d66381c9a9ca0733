"""Splitting texts into the pieces a byte-level BPE works on, many texts at once.

The rule is that of the ``tokenizers`` library's byte-level splitter: contractions
('s 't 're 've 'm 'll 'd), runs of letters, of numbers or of other marks, each with
one blank before it, and runs of white space. It is applied to arrays of character
classes; no regular expression walks the texts. A piece never depends on what
another piece holds, so equal pieces are encoded once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import regex
from tokenizers import pre_tokenizers

LETTER, NUMBER, SPACE, MARK = range(4)
# Pieces up to so many bytes are compared as two 64-bit words, longer ones as objects.
PACKED = 16


# Code points are classed in blocks of so many bits, each when it first occurs.
_BLOCK_BITS = 12


@cache
def _table() -> tuple[np.ndarray, np.ndarray]:
    """(class of each code point, whether its block is classed)."""
    return np.full(0x110000, MARK, np.uint8), np.zeros(0x110000 >> _BLOCK_BITS, bool)


def _class_block(found: np.ndarray, block: int) -> None:
    """Class a block of code points as the ``tokenizers`` library sees them.

    The library splits them in order; each run is then told by its first character.
    So the classes follow the library's version of Unicode.
    """
    splitter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    points = np.arange(block << _BLOCK_BITS, (block + 1) << _BLOCK_BITS)
    for point in points[points < 0x80].tolist():
        character = chr(point)
        found[point] = LETTER if character.isalpha() else NUMBER if character.isdigit() else MARK
    if block == 0:
        found[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = SPACE
    points = points[(points >= 0x80) & ((points < 0xD800) | (points >= 0xE000))]
    text = "".join(map(chr, points.tolist()))
    for _, (first, end) in splitter.pre_tokenize_str(text):
        which = SPACE
        for lead, kind in (("a", LETTER), ("1", NUMBER), ("!", MARK)):
            if len(splitter.pre_tokenize_str(lead + text[first])) == 1:
                which = kind
        found[points[first:end]] = which


def classes(points: np.ndarray) -> np.ndarray:
    """The class of every code point in ``points``."""
    found, known = _table()
    blocks = np.bincount(points >> _BLOCK_BITS, minlength=len(known)) > 0
    for block in np.flatnonzero(blocks & ~known).tolist():
        _class_block(found, block)
        known[block] = True
    return found[points]


def piece_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """True at each character that starts a piece; ``ends`` are the ends of non-empty texts."""
    n = len(points)
    kind = classes(points)
    first = np.zeros(n + 1, bool)
    first[0] = True
    first[ends] = True
    edge = first[:n]
    before = np.empty(n, np.uint8)
    before[0], before[1:] = MARK, kind[:-1]
    starts = edge | (kind != before)
    space = kind == SPACE
    # The last white space before other text stands alone, or leads it if it is a blank.
    last = np.empty(n, bool)
    last[-1], last[:-1] = False, space[:-1] & ~space[1:] & ~first[1:n]
    last &= space
    starts |= last
    leads = np.zeros(n, bool)
    leads[1:] = last[:-1] & (points[:-1] == 32)
    starts &= ~(leads & ~edge)
    # Contractions: an apostrophe that starts a piece, with the letters after it.
    marks = np.flatnonzero((points == 39) & starts)
    if len(marks):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[marks + 1], padded[marks + 2]
        one = np.where(first[np.minimum(marks + 1, n)], 0, one)
        two = np.where((one == 0) | first[np.minimum(marks + 2, n)], 0, two)
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("l")) & (two == ord("l"))) | (((one == ord("r")) | (one == ord("v"))) & (two == ord("e")))
        size = np.where(single, 2, np.where(double, 3, 0))
        marks, size = marks[size > 0], size[size > 0]
        starts[marks + 1] = False
        after = marks + size
        starts[after[after < n]] = True
    return starts


@dataclass
class Pieces:
    """The pieces of some texts: ``codes`` into ``words``, text i has ``codes[at[i]:at[i + 1]]``."""

    words: list[bytes]
    codes: np.ndarray
    at: np.ndarray


def _pack(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    windows = np.lib.stride_tricks.sliding_window_view(data, 8)
    mask = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    low = np.ascontiguousarray(windows[starts]).view("<u8")[:, 0] & mask[np.minimum(sizes, 8)]
    high = np.zeros(len(starts), np.uint64)
    more = np.flatnonzero(sizes > 8)
    high[more] = np.ascontiguousarray(windows[starts[more] + 8]).view("<u8")[:, 0] & mask[sizes[more] - 8]
    return low, high


def split(texts: list[str], specials: tuple[str, ...] = ()) -> Pieces:
    """The pieces of all texts. A special string is one piece wherever it stands."""
    owners, parts, special = range(len(texts)), texts, None
    if any(name in text for name in specials for text in texts):
        pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(specials, key=len, reverse=True))) + ")")
        owners, parts, special = [], [], []
        for number, text in enumerate(texts):
            for k, part in enumerate(pattern.split(text)):
                owners.append(number)
                parts.append(part)
                special.append(k % 2 == 1)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    owners = np.asarray(owners, np.int64)
    joined = "".join(parts)
    if not joined:
        return Pieces([], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64))
    points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
    upto = np.cumsum(lengths)
    starts = piece_starts(points, upto[lengths > 0])
    if special is not None:
        for part in np.flatnonzero(special):
            starts[upto[part] - lengths[part] + 1 : upto[part]] = False
    at = np.flatnonzero(starts)
    # Characters to bytes.
    widths = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
    offsets = np.concatenate(([0], np.cumsum(widths)))
    encoded = joined.encode()
    data = np.frombuffer(encoded + bytes(PACKED), np.uint8)
    begin = offsets[at]
    size = np.diff(np.append(begin, len(encoded)))
    low, high = _pack(data, begin, np.minimum(size, PACKED))
    low, high = pd.factorize(low)[0], pd.factorize(high)[0]
    # Beyond 16 bytes the length keeps apart only what objects tell apart below.
    key = (low.astype(np.int64) * (int(high.max()) + 1) + high) * (PACKED + 2) + np.minimum(size, PACKED + 1)
    long = np.flatnonzero(size > PACKED)
    if len(long):
        whole = np.empty(len(long), object)
        whole[:] = [encoded[a : a + s] for a, s in zip(begin[long].tolist(), size[long].tolist(), strict=True)]
        key[long] = -1 - pd.factorize(whole)[0]
    codes, distinct = pd.factorize(key)
    where = np.zeros(len(distinct), np.int64)
    where[codes[::-1]] = np.arange(len(codes))[::-1]
    words = [encoded[a : a + s] for a, s in zip(begin[where].tolist(), size[where].tolist(), strict=True)]
    # Text of each piece: the part its first character lies in, then that part's text.
    part = np.searchsorted(upto, at, side="right")
    counts = np.bincount(owners[part], minlength=len(texts))
    return Pieces(words, codes, np.concatenate(([0], np.cumsum(counts))))
