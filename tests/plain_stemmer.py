"""A plain Porter2 stemmer, word by word: what the column expressions are tested against.

Written from the published algorithm description; R1/R2 are fixed positions computed once per word.
"""

from __future__ import annotations

VOWELS = frozenset("aeiouy")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDING = frozenset("cdeghkmnrt")

# Fixed values of the published algorithm.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli", "singly": "singl",
    "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos", "bias": "bias",
    "andes": "andes",
}
AFTER_1A = frozenset(["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"])
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


def _is_vowel(ch: str) -> bool:
    return ch in VOWELS


def _region_after(word: str, start: int) -> int:
    for i in range(start + 1, len(word)):
        if not _is_vowel(word[i]) and _is_vowel(word[i - 1]):
            return i + 1
    return len(word)


def _regions(word: str) -> tuple[int, int]:
    for prefix in ("gener", "commun", "arsen"):
        if word.startswith(prefix):
            r1 = len(prefix)
            break
    else:
        r1 = _region_after(word, 0)
    r2 = _region_after(word, r1) if r1 < len(word) else len(word)
    return r1, r2


def _short_syllable_end(w: str) -> bool:
    if len(w) >= 3:
        return (not _is_vowel(w[-3])) and _is_vowel(w[-2]) and (not _is_vowel(w[-1])) and w[-1] not in "wxY"
    if len(w) == 2:
        return _is_vowel(w[0]) and not _is_vowel(w[1])
    return False


def stem_word(word: str) -> str:
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    if word.startswith("'"):
        word = word[1:]
    # mark consonant y
    chars = list(word)
    if chars and chars[0] == "y":
        chars[0] = "Y"
    for i in range(1, len(chars)):
        if chars[i] == "y" and chars[i - 1] in VOWELS:
            chars[i] = "Y"
    w = "".join(chars)
    r1, r2 = _regions(w)

    # step 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith(("ied", "ies")):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith(("us", "ss")):
        pass
    elif w.endswith("s"):
        if any(_is_vowel(c) for c in w[:-2]):
            w = w[:-1]
    if w in AFTER_1A:
        return w
    # step 1b
    for suf in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(suf):
            if suf in ("eed", "eedly"):
                if len(w) - len(suf) >= r1:
                    w = w[: -len(suf)] + "ee"
            else:
                stem = w[: -len(suf)]
                if any(_is_vowel(c) for c in stem):
                    w = stem
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif len(w) <= r1 and _short_syllable_end(w):
                        w += "e"
            break
    # step 1c
    if len(w) > 2 and w[-1] in "yY" and not _is_vowel(w[-2]):
        w = w[:-1] + "i"
    # step 2
    for suf, rep in STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if len(w) >= 4 and w[-4] == "l":
                        w = w[:-3] + rep
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in LI_ENDING:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 3
    for suf, rep in STEP3:
        if w.endswith(suf):
            if suf == "ative":
                if len(w) - len(suf) >= r2:
                    w = w[: -len(suf)]
            elif len(w) - len(suf) >= r1:
                w = w[: -len(suf)] + rep
            break
    # step 4
    for suf in STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break
    # step 5
    if w.endswith("l") and len(w) - 1 >= r2 and len(w) >= 2 and w[-2] == "l":
        w = w[:-1]
    elif w.endswith("e"):
        if len(w) - 1 >= r2:
            w = w[:-1]
        elif len(w) - 1 >= r1 and not _short_syllable_end(w[:-1]):
            w = w[:-1]
    return w.replace("Y", "y")
