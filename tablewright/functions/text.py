"""Scalar text functions (T1-T5, T8, T14, T15): ``Column -> Column`` Catalyst expressions; T6 is in ``stemming``.

Regexes are spelled with explicit character classes (no ``\\d``, ``\\s``
or bare ``.``) so Java, Python and RE2 agree on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for equal results).
# Contraction rewrites, applied in this order, before lower-casing:
CONTRACTIONS = [
    ("what's", "what is "),
    ("'s", " "),
    ("'ve", " have "),
    ("n't", " not "),
    ("i'm", "i am "),
    ("'re", " are "),
    ("'d", " would "),
    ("'ll", " will "),
]
# Digits: the first digit run and the rest of its line become this word.
DIGITS_PATTERN = r"[0-9]+[^\n]*"
DIGITS_WORD = "digits"
# ASCII punctuation (Python's string.punctuation, 32 characters).
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# English stop words (NLTK's list, 179 words).
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've", "you'll", "you'd",
    "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she", "she's", "her", "hers",
    "herself", "it", "it's", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are", "was", "were", "be", "been",
    "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if",
    "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against", "between",
    "into", "through", "during", "before", "after", "above", "below", "to", "from", "up", "down", "in", "out",
    "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when", "where", "why",
    "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "don't",
    "should", "should've", "now", "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn",
    "couldn't", "didn", "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't",
    "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
]
# Whitespace that separates tokens.
WHITESPACE_CLASS = r"[ \t\n\r\x0B\f]+"
# ---------------------------------------------------------------------------


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# T1
def expand_contractions(c: str | Column) -> Column:
    out = _col(c)
    for pattern, repl in CONTRACTIONS:
        out = F.regexp_replace(out, F.lit(pattern), F.lit(repl))
    return out


# T2
def mask_digits(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), F.lit(DIGITS_PATTERN), F.lit(DIGITS_WORD))


# T3
def strip_punctuation(c: str | Column) -> Column:
    return F.translate(_col(c), PUNCTUATION, "")


# T4
def normalize_ws_lower(c: str | Column) -> Column:
    """Lower-case and split on whitespace; empty pieces are dropped."""
    parts = F.split(F.lower(_col(c)), WHITESPACE_CLASS)
    return F.filter(parts, lambda x: x != F.lit(""))


# T5
def remove_stopwords(tokens: str | Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    # a long list of literals is a hash set in Catalyst: one lookup a token
    return F.filter(_col(tokens), lambda x: ~x.isin(*stopwords))


# T8
def tokenize(c: str | Column, min_len: int = 1) -> Column:
    """Whitespace tokens of at least ``min_len`` characters."""
    parts = F.split(_col(c), WHITESPACE_CLASS)
    return F.filter(parts, lambda x: F.length(x) >= F.lit(int(min_len)))


# T14
def truncate_vocab(seq: str | Column, max_features: int) -> Column:
    return F.transform(_col(seq), lambda x: F.when(x >= F.lit(max_features), F.lit(0)).otherwise(x))


# T15
def pad_sequences(seq: str | Column, maxlen: int, value: int = 0) -> Column:
    """Keep the last ``maxlen`` ids and left-pad with ``value`` (pre-padding, pre-truncation)."""
    s = _col(seq)
    n = F.size(s)
    tail = F.slice(s, F.greatest(n - F.lit(maxlen) + 1, F.lit(1)), F.lit(maxlen))
    return F.concat(F.array_repeat(F.lit(value), F.greatest(F.lit(maxlen) - n, F.lit(0))), tail)
