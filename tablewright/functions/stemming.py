"""English (Porter2) stems as SQL column expressions over a column of distinct lower-case terms.

``STEPS`` is a chain of (column, expression): every step reads ``term`` and earlier steps only, in the SQL that Spark
and DuckDB share, so the table of stems is a projection that Catalyst compiles and that another engine can check.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
AFTER_1A = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
DOUBLES = ["bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt"]
LI_ENDING = list("cdeghkmnrt")
STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"), ("iveness", "ive"),
    ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"), ("entli", "ent"), ("ation", "ate"),
    ("alism", "al"), ("aliti", "al"), ("ousli", "ous"), ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"),
    ("anci", "ance"), ("abli", "able"), ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"),
    ("ogi", "og"), ("li", ""),
]
STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"), ("ative", ""),
    ("ical", "ic"), ("ness", ""), ("ful", ""),
]
STEP4 = [
    "ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize",
    "ion", "al", "er", "ic",
]
VOWEL, OTHER = "[aeiouy]", "[^aeiouy]"
REGION = f"^{OTHER}*{VOWEL}+{OTHER}"


def _listed(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _less(w: str, n: int) -> str:
    return f"left({w}, length({w}) - {n})"


def _holds(w: str, pattern: str) -> str:
    return f"regexp_extract({w}, '{pattern}', 0) <> ''"


def _short(w: str) -> str:
    """Whether a word ends in a short syllable."""
    three = _holds(f"right({w}, 3)", f"^{OTHER}{VOWEL}[^aeiouywxY]$")
    return f"(length({w}) >= 3 AND {three} OR length({w}) = 2 AND {_holds(w, f'^{VOWEL}{OTHER}$')})"


def _longest(w: str, endings: list[tuple[str, str, str]]) -> str:
    """The first ending that fits decides; it is replaced where its condition holds."""
    cases = [
        f"WHEN right({w}, {len(end)}) = '{end}' THEN CASE WHEN {when} THEN {_less(w, len(end))} || '{by}' ELSE {w} END"
        for end, by, when in endings
    ]
    return f"CASE {' '.join(cases)} ELSE {w} END"


def _in(region: str, w: str, n: int) -> str:
    return f"length({w}) - {n} >= {region}"


def _step2() -> str:
    out = []
    for end, by in STEP2:
        when = _in("r1", "c1", len(end))
        if end == "ogi":
            when += " AND length(c1) >= 4 AND substr(c1, length(c1) - 3, 1) = 'l'"
        if end == "li":
            when += f" AND length(c1) >= 3 AND substr(c1, length(c1) - 2, 1) IN {_listed(LI_ENDING)}"
        out.append((end, by, when))
    return _longest("c1", out)


def _step4() -> str:
    out = []
    for end in STEP4:
        when = _in("r2", "c3", len(end))
        if end == "ion":
            when += " AND length(c3) >= 4 AND substr(c3, length(c3) - 3, 1) IN ('s', 't')"
        out.append((end, "", when))
    return _longest("c3", out)


def _consonant_y(w: str) -> str:
    """A y behind a vowel counts as a consonant, from left to right."""
    for v in "aeiouy":
        w = f"replace({w}, '{v}y', '{v}Y')"
    return w


STEPS: list[tuple[str, str]] = [
    ("a0", "CASE WHEN left(term, 1) = '''' THEN substr(term, 2) ELSE term END"),
    ("a1", "CASE WHEN left(a0, 1) = 'y' THEN 'Y' || substr(a0, 2) ELSE a0 END"),
    ("w", _consonant_y("a1")),
    ("m1", f"regexp_extract(w, '{REGION}', 0)"),
    ("r1", "CASE WHEN left(w, 5) IN ('gener', 'arsen') THEN 5 WHEN left(w, 6) = 'commun' THEN 6 "
           "WHEN m1 = '' THEN length(w) ELSE length(m1) END"),
    ("m2", f"regexp_extract(substr(w, r1 + 1), '{REGION}', 0)"),
    ("r2", "CASE WHEN m2 = '' THEN length(w) ELSE r1 + length(m2) END"),
    ("b0", f"CASE WHEN right(w, 3) = '''s''' THEN {_less('w', 3)} WHEN right(w, 2) = '''s' THEN {_less('w', 2)} "
           f"WHEN right(w, 1) = '''' THEN {_less('w', 1)} ELSE w END"),
    ("b1", f"CASE WHEN right(b0, 4) = 'sses' THEN {_less('b0', 2)} "
           f"WHEN right(b0, 3) IN ('ied', 'ies') THEN CASE WHEN length(b0) > 4 THEN {_less('b0', 2)} ELSE {_less('b0', 1)} END "
           "WHEN right(b0, 2) IN ('us', 'ss') THEN b0 "
           f"WHEN right(b0, 1) = 's' AND {_holds('left(b0, greatest(length(b0) - 2, 0))', VOWEL)} THEN {_less('b0', 1)} "
           "ELSE b0 END"),
    ("e1", "CASE WHEN right(b1, 5) IN ('eedly', 'ingly') THEN right(b1, 5) WHEN right(b1, 4) = 'edly' THEN 'edly' "
           "WHEN right(b1, 3) IN ('eed', 'ing') THEN right(b1, 3) WHEN right(b1, 2) = 'ed' THEN 'ed' ELSE '' END"),
    ("s1", "left(b1, length(b1) - length(e1))"),
    ("b2", "CASE WHEN e1 = '' THEN b1 "
           "WHEN e1 IN ('eed', 'eedly') THEN CASE WHEN length(s1) >= r1 THEN s1 || 'ee' ELSE b1 END "
           f"WHEN NOT ({_holds('s1', VOWEL)}) THEN b1 WHEN right(s1, 2) IN ('at', 'bl', 'iz') THEN s1 || 'e' "
           f"WHEN right(s1, 2) IN {_listed(DOUBLES)} THEN {_less('s1', 1)} "
           f"WHEN length(s1) <= r1 AND {_short('s1')} THEN s1 || 'e' ELSE s1 END"),
    ("c1", f"CASE WHEN length(b2) > 2 AND {_holds('right(b2, 2)', f'^{OTHER}[yY]$')} THEN {_less('b2', 1)} || 'i' ELSE b2 END"),
    ("c2", _step2()),
    ("c3", _longest("c2", [(end, by, _in("r2" if end == "ative" else "r1", "c2", len(end))) for end, by in STEP3])),
    ("c4", _step4()),
    ("c5", f"CASE WHEN right(c4, 2) = 'll' AND {_in('r2', 'c4', 1)} THEN {_less('c4', 1)} "
           f"WHEN right(c4, 1) = 'e' AND ({_in('r2', 'c4', 1)} OR {_in('r1', 'c4', 1)} AND NOT {_short(_less('c4', 1))}) "
           f"THEN {_less('c4', 1)} ELSE c4 END"),
    ("stem", "CASE WHEN length(term) <= 2 THEN term "
             + " ".join(f"WHEN term = '{k}' THEN '{v}'" for k, v in EXCEPTIONS.items())
             + f" WHEN b1 IN {_listed(AFTER_1A)} THEN b1 ELSE replace(c5, 'Y', 'y') END"),
]


def with_stem(terms: DataFrame) -> DataFrame:
    """Add ``stem`` to a table with a column ``term``.

    Every step is a lambda over the steps before it, so none of them is written out twice in the plan.
    """
    chain, held = "transform(array(term), x -> named_struct('term', x))", ["term"]
    for name, expression in STEPS:
        fields = ", ".join(f"'{c}', x.{c}" for c in held)
        chain = f"transform({chain}, x -> named_struct({fields}, '{name}', {_of_lambda(expression)}))"
        held.append(name)
    return terms.withColumn("stem", F.expr(f"{chain}[0].stem"))


def _of_lambda(expression: str) -> str:
    """The expression over the fields of ``x``; string literals stay as they are."""
    names = "|".join(["term", *(name for name, _ in STEPS)])
    parts = expression.split("'")
    parts[::2] = [re.sub(rf"\b({names})\b", r"x.\1", p) for p in parts[::2]]
    return "'".join(parts)


def stem_sql(source: str) -> str:
    """The same chain as SQL over ``source``, a relation with a column ``term``."""
    for name, expression in STEPS:
        source = f"(SELECT *, {expression} AS {name} FROM {source})"
    return source
