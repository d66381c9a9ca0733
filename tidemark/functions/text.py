"""Text cleaning and word splitting as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnLike, as_column

# The placeholder and the patterns of the message tokeniser.
URL_PATTERN = "http[^ ]+"
URL_PLACEHOLDER = "urlplaceholder"
GAP_PATTERN = r"[\p{P}\s\p{Z}\x{85}\x{1C}-\x{1F}]+"
BLANK_PATTERN = r"[\s\p{Z}\x{85}\x{1C}-\x{1F}]+"

# The English stop words of the NLTK corpus.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself "
    "yourselves he him his himself she she's her hers herself it it's its itself they them their "
    "theirs themselves what which who whom this that that'll these those am is are was were be "
    "been being have has had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before after above below "
    "to from up down in out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own same so than too "
    "very s t can will just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma "
    "mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()

# Symbols the word splitter sets apart, and the contractions it
# divides, as (first half, second half). The last one needs a blank or the end after it.
SPLIT_SYMBOLS = "`+|[$<>]"
CONTRACTIONS = [("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me")]
CONTRACTION_BEFORE_BLANK = ("wan", "na")

_WORD_CHARACTER = r"[\p{L}\p{N}_]"


def _dividing_pattern() -> str:
    """A symbol, or the first half of a contraction that stands as a whole word.

    The literal comes before its look-behind, which then runs on few positions.
    """
    ends = [(first, f"{second}(?!{_WORD_CHARACTER})") for first, second in CONTRACTIONS]
    first, second = CONTRACTION_BEFORE_BLANK
    ends.append((first, f"{second}(?: |$)"))
    halves = [f"{first}(?<!{_WORD_CHARACTER}{first})(?={end})" for first, end in ends]
    return "|".join([SPLIT_SYMBOLS, *halves])


def clean_text(text: ColumnLike) -> Column:
    """Lower case, URLs to a placeholder, no punctuation, single blanks.

    Lower case comes first, so upper-case URLs are found as well. Punctuation
    and blanks go in one pass, since a run of either ends as one blank.
    """
    cleaned = F.regexp_replace(F.lower(as_column(text)), URL_PATTERN, URL_PLACEHOLDER)
    return F.trim(F.regexp_replace(cleaned, GAP_PATTERN, " "))


def split_words(cleaned: ColumnLike) -> Column:
    """Words of clean text: symbols set apart, contractions divided, split on blanks."""
    return F.filter(_pieces(cleaned), lambda word: word != "")


def _pieces(cleaned: ColumnLike) -> Column:
    divided = F.regexp_replace(as_column(cleaned), _dividing_pattern(), " $0 ")
    return F.split(divided, " ")


def drop_stop_words(words: ColumnLike) -> Column:
    """Remove the stop words; order and repeats of the others stay."""
    return F.filter(as_column(words), lambda word: ~word.isin(STOP_WORDS))


def training_words(text: ColumnLike) -> Column:
    """The whole training tokeniser but for the lemma join."""
    dropped = ["", *STOP_WORDS]
    return F.filter(_pieces(clean_text(text)), lambda word: ~word.isin(dropped))


def serving_words(text: ColumnLike) -> Column:
    """The simpler serving form: split only, case and punctuation are kept.

    Marks that end or enclose a word are set apart as words of their own.
    """
    words = F.regexp_replace(as_column(text), r"(`+|[$<>;@#%&?!()\[\]{}\"])", " $1 ")
    words = F.regexp_replace(words, r"([:,])(?=[^0-9]|$)", " $1 ")
    words = F.regexp_replace(words, r"\.[\s\p{Z}\x{85}\x{1C}-\x{1F}]*$", " . ")
    return F.filter(F.split(words, BLANK_PATTERN), lambda word: word != "")
