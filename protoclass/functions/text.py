"""Column expressions for the text side of the pipeline.

Everything here returns a ``pyspark.sql.Column`` built from Spark's own
functions, so tokenisation and per-document counting run inside the JVM,
row by row, with no shuffle and no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's analyser for equal results).
#
# English stop words removed by the reference's standard analyser, in the
# analyser's own order:
STOP_WORDS: tuple[str, ...] = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if",
    "in", "into", "is", "it", "no", "not", "of", "on", "or", "such", "that",
    "the", "their", "then", "there", "these", "they", "this", "to", "was",
    "will", "with",
)
# Classes of the Unicode word-break standard, as ranges and properties of the
# JVM's regular expressions:
LETTER_JOINERS = r".':\u00B7\u0387\u05F4\u2018\u2019\u2024\u2027\uFE13\uFE52\uFE55\uFF07\uFF0E\uFF1A"   # MidLetter, MidNumLet, Single_Quote
DIGIT_JOINERS = r".,;'\u037E\u0589\u060C\u060D\u066C\u07F8\u2018\u2019\u2024\u2044\uFE10\uFE14\uFE50\uFE52\uFE54\uFF07\uFF0C\uFF0E\uFF1B"   # MidNum, MidNumLet, Single_Quote
CONNECTORS = r"\p{Pc}"                                                                # ExtendNumLet
DIGITS = r"\p{Nd}\u066B"                                                              # Numeric
KATAKANA = r"\p{IsKatakana}\u3031-\u3035\u309B\u309C\u30A0\u30FC\uFF70"
HEBREW = r"\u05D0-\u05EA\u05EF-\u05F2\uFB1D\uFB1F-\uFB28\uFB2A-\uFB4F"
SYLLABLES = r"\p{IsHan}\p{IsHiragana}"                                                # tokens one by one
UNSPACED = r"\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"                             # a run is a token
EXTENDERS = r"[\p{M}\p{Cf}&&[^\u200B]]"                                               # Extend, Format
# ---------------------------------------------------------------------------


def word_pattern() -> str:
    """Word tokens by the rules of the Unicode word-break standard (UAX #29).

    The rules are transitions between character classes; here each run of one
    class is a possessive loop, so a text is read once. Extenders and format
    characters belong to the character before them, wherever it stands (a soft
    hyphen or a joiner splits no word). Letters stick to letters and digits;
    a letter joiner stays between two letters, a digit joiner between two digits
    (``can't``, ``u.s``, ``3.14``, ``1,234``); a double quote between Hebrew letters
    and a single one behind a Hebrew letter stay. Katakana stick to Katakana.
    Connectors (``_``) tie all of these. Ideographs and Hiragana are tokens one by
    one, runs of scripts without spaces are one token each. A token has at least
    one letter, digit or Katakana.
    """
    # What comes first in a class is looked at first: the letters of most texts are
    # found by their range, and a class ends a run without asking for scripts.
    x = EXTENDERS
    letter = rf"a-zA-ZÀ-ÖØ-öø-ɏ[\p{{IsAlphabetic}}׳&&[^\p{{M}}\p{{IsIdeographic}}{SYLLABLES}{KATAKANA}{UNSPACED}]]"
    digit, hebrew = rf"0-9{DIGITS}", f"[{HEBREW}]"
    unspaced = rf"[{UNSPACED}&&[\p{{IsAlphabetic}}\p{{M}}]]"

    def run(c: str) -> str:
        return f"[{c}][{c}{x}]*+"

    letters = (f"{run(letter)}(?:[{LETTER_JOINERS}]{x}*+{run(letter)}|\"(?<={hebrew}{x}{{0,8}}\"){x}*+(?={hebrew}){run(letter)})*+"
               f"(?:'(?<={hebrew}{x}{{0,8}}'){x}*+)?+")
    digits = f"{run(digit)}(?:[{DIGIT_JOINERS}]{x}*+{run(digit)})*+"
    core = f"(?:(?:{letters}|{digits})++|{run(KATAKANA)})"
    tie = run(CONNECTORS)
    # a run of connectors alone is tried from its front only
    word = f"(?:(?<![{CONNECTORS}]){tie})?+{core}(?:{tie}{core})*+(?:{tie})?+"
    return rf"{plain_word()}|(?=[0-9A-Z_a-z\u0080-\x{{10FFFF}}])(?:{word}|[{SYLLABLES}]{x}*+|{run(unspaced)})"


def plain_word() -> str:
    """Most words of a lower-cased text: a run of Latin letters before an ASCII
    character (or the end) that no rule lets into a word, or before one joiner and
    such a character. The other rules would end the token at the same place."""
    end = r"[\x00-\x7F&&[^0-9A-Z_a-z.':]]"
    return rf"[a-zß-öø-ɏ]++(?=[ \n,]|[.':]?(?:{end}|\z))"


ASCII_PATTERN = "[a-z0-9]+"

PROFILES = ("word", "ascii")


def token_pattern(profile: str = "word") -> str:
    if profile == "word":
        return word_pattern()
    if profile == "ascii":
        return ASCII_PATTERN
    raise ValueError(f"unknown tokeniser profile {profile!r}; expected one of {PROFILES}")


def tokenize(body: Column | str, profile: str = "word",
             stop_words: tuple[str, ...] | None = STOP_WORDS, max_token_length: int | None = None) -> Column:
    """E1 + E2: lower-case, split into word tokens, drop stop words and, if
    ``max_token_length`` is given (255 for parity with the analyser), longer
    tokens. Returns ``ARRAY<STRING>`` in text order."""
    col = F.col(body) if isinstance(body, str) else body
    raw = F.regexp_extract_all(F.lower(col), F.lit(token_pattern(profile)), 0)
    stops = list(stop_words or ())

    if stops:
        raw = F.filter(raw, lambda t: ~t.isin(stops))
    if max_token_length is not None:
        raw = F.filter(raw, lambda t: F.length(t) <= max_token_length)
    return raw


def run_end_positions(sorted_terms: Column) -> Column:
    """0-based positions of the last element of each run of equal terms in
    a sorted ``ARRAY<STRING>``: an element ends a run when its successor
    differs or is missing."""
    s = sorted_terms
    successor = F.slice(s, 2, F.greatest(F.size(s), F.lit(1)))   # zip_with pads the end with NULL
    ends = F.zip_with(s, successor, lambda a, b: b.isNull() | (a != b))
    return F.filter(F.transform(ends, lambda e, i: F.when(e, i).otherwise(F.lit(-1))), lambda p: p >= 0)


def run_lengths(sorted_terms: Column, end_positions: Column) -> Column:
    """``ARRAY<STRUCT<term, tf BIGINT>>`` from a sorted array and its run
    ends; the distinct terms of a sorted array are the runs in order, and the
    run lengths are the differences of consecutive end positions."""
    e = end_positions
    prev = F.slice(F.concat(F.array(F.lit(-1)), e), 1, F.size(e))
    counts = F.zip_with(e, prev, lambda a, b: a - b)
    return F.zip_with(F.array_distinct(sorted_terms), counts,
                      lambda t, c: F.struct(t.alias("term"), c.cast("bigint").alias("tf")))


def with_term_counts(df: DataFrame, terms: str, out: str) -> DataFrame:
    """E3 inside each row: ``terms`` (``ARRAY<STRING>``) becomes ``out``
    (``ARRAY<STRUCT<term STRING, tf BIGINT>>``), one entry per distinct term,
    ordered by term. No shuffle: a document's tokens never leave its row.

    After the sort: two passes over the tokens (mark run ends, keep their
    positions), then one over the distinct terms. Every lambda reads only
    its own elements, so whatever the optimiser inlines, the work stays
    linear. Each intermediate array is its own column, so it is computed
    once.
    """
    sorted_col, ends_col = f"__{out}_sorted", f"__{out}_ends"
    df = df.withColumn(sorted_col, F.sort_array(F.col(terms)))
    df = df.withColumn(ends_col, run_end_positions(F.col(sorted_col)))
    return df.withColumn(out, run_lengths(F.col(sorted_col), F.col(ends_col))).drop(sorted_col, ends_col)
