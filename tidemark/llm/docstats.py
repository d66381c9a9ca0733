"""Statistics of whole documents, computed on arrays of code points."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

UPPER, LOWER, OTHER_LETTER, DIGIT, SPACE, LINE, PUNCTUATION, SYMBOL, CONTROL, OTHER = range(10)
KINDS = 10

NAMES = [
    "log_chars",
    "log_words",
    "word_length",
    "word_length_spread",
    "long_words",
    "short_words",
    "line_length",
    "line_length_spread",
    "short_lines",
    "upper",
    "other_letters",
    "digits",
    "spaces",
    "punctuation",
    "symbols",
    "controls",
    "non_ascii",
    "capital_words",
    "doubled_marks",
    "bare_mark_words",
    "words_ending_in_mark",
    "lines_ending_in_mark",
    "repeated_characters",
    "distinct_words",
    "top_word",
    "repeated_lines",
]

_CATEGORIES = {"Lu": UPPER, "Lt": UPPER, "Ll": LOWER, "Lm": OTHER_LETTER, "Lo": OTHER_LETTER, "Nd": DIGIT,
               "Nl": DIGIT, "No": DIGIT, "Zs": SPACE, "Zl": LINE, "Zp": LINE, "Cc": CONTROL}


@cache
def kinds() -> np.ndarray:
    """The kind of every code point."""
    found = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        if category in _CATEGORIES:
            found[point] = _CATEGORIES[category]
        elif category[0] in "PS":
            found[point] = PUNCTUATION if category[0] == "P" else SYMBOL
    found[[9, 11, 12, 13]] = SPACE
    found[10] = LINE
    # Marks that prose has little of count as symbols.
    found[[ord(c) for c in "#%&*@\\/_"]] = SYMBOL
    return found


def _share(part, whole) -> float:
    return float(part) / max(float(whole), 1.0)


def statistics(text: str) -> np.ndarray:
    """The values of ``NAMES`` for one whole text; zeros for an empty one."""
    out = np.zeros(len(NAMES), np.float32)
    if not text:
        return out
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kind = kinds()[points]
    n = len(points)
    counts = np.bincount(kind, minlength=KINDS)
    blank = (kind == SPACE) | (kind == LINE)
    word = ~blank
    starts = np.flatnonzero(word & np.concatenate(([True], blank[:-1])))
    ends = np.flatnonzero(word & np.concatenate((blank[1:], [True]))) + 1
    words = len(starts)
    mark = (kind == PUNCTUATION) | (kind == SYMBOL)
    breaks = np.flatnonzero(kind == LINE)
    line_starts, line_ends = np.concatenate(([0], breaks + 1)), np.concatenate((breaks, [n]))
    line_lengths = line_ends - line_starts
    lines = line_lengths > 0
    same = points[1:] == points[:-1]
    out[0], out[1] = np.log1p(n), np.log1p(words)
    if words:
        lengths = ends - starts
        upto = np.concatenate(([0], np.cumsum(mark)))
        marks = upto[ends] - upto[starts]
        capitals = np.concatenate(([0], np.cumsum(kind == UPPER)))
        out[2], out[3] = lengths.mean(), lengths.std()
        out[4], out[5] = (lengths > 15).mean(), (lengths < 3).mean()
        out[17] = ((capitals[ends] - capitals[starts]) * 2 > lengths).mean()
        out[19] = (marks == lengths).mean()
        out[20] = mark[ends - 1].mean()
        tally: dict[str, int] = {}
        for token in text.split():
            tally[token] = tally.get(token, 0) + 1
        out[23], out[24] = _share(len(tally), words), _share(max(tally.values(), default=0), words)
    if lines.any():
        full = line_lengths[lines]
        out[6], out[7], out[8] = full.mean(), full.std(), (full < 30).mean()
        out[21] = mark[line_ends[lines] - 1].mean()
        rows = [row for row in text.split("\n") if row]
        out[25] = 1 - _share(len(set(rows)), len(rows))
    for at, which in ((9, UPPER), (10, OTHER_LETTER), (11, DIGIT), (12, SPACE), (13, PUNCTUATION), (14, SYMBOL), (15, CONTROL)):
        out[at] = _share(counts[which], n)
    out[16] = (points > 127).mean()
    out[18] = _share((same & mark[1:]).sum(), n)
    out[22] = _share((same & word[1:]).sum(), n)
    return out
