"""Porter stemming of one word in plain Python, to compare with the expressions of the library."""

import re

from rankloom.functions.stemming import IRREGULAR, STEP_2, STEP_3, STEP_4

_VOWEL_RUN_THEN_CONSONANT = re.compile("v+c+")


def _shape(word: str) -> str:
    """The word as a string of ``c`` and ``v``; y counts as a vowel after a consonant."""
    shape = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and shape.endswith("c"))
        shape += "v" if vowel else "c"
    return shape


def _measure(stem: str) -> int:
    return len(_VOWEL_RUN_THEN_CONSONANT.findall(_shape(stem)))


def _short_end(word: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is exactly vowel-consonant."""
    shape = _shape(word)
    return shape == "vc" or (shape.endswith("cvc") and word[-1] not in "wxy")


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("c")


def _plural(w: str) -> str:
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("s") and not w.endswith("ss"):
        return w[:-2] if w.endswith("sses") else w[:-1]
    return w


def _past_and_gerund(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    cut = next((len(s) for s in ("ed", "ing") if w.endswith(s) and "v" in _shape(w[: -len(s)])), 0)
    if not cut:
        return w
    w = w[:-cut]
    if w.endswith(("at", "bl", "iz")):
        return w + "e"
    if _double_consonant(w):
        return w if w[-1] in "lsz" else w[:-1]
    return w + "e" if _measure(w) == 1 and _short_end(w) else w


def _replace_suffix(w: str, rules: list[tuple[str, str]]) -> str:
    """Apply the longest matching suffix if a measure is left before it."""
    matching = [rule for rule in rules if w.endswith(rule[0])]
    if not matching:
        return w
    suffix, new = max(matching, key=lambda rule: len(rule[0]))
    stem = w[: -len(suffix)]
    return stem + new if _measure(stem) > 0 else w


def _derivational(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _derivational(w[:-2])
    if w.endswith("logi"):
        return w[:-1] if _measure(w[:-3]) > 0 else w
    return _replace_suffix(w, STEP_2)


def _long_suffix(w: str) -> str:
    matching = [s for s in STEP_4 if w.endswith(s)]
    if not matching:
        return w
    stem = w[: -len(max(matching, key=len))]
    if w.endswith("ion") and not stem.endswith(("s", "t")):
        return w
    return stem if _measure(stem) > 1 else w


def _final_letters(w: str) -> str:
    if w.endswith("e"):
        m = _measure(w[:-1])
        if m > 1 or (m == 1 and not _short_end(w[:-1])):
            w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w[:-1]) > 1 else w


def stem_word(word: str) -> str:
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    w = _past_and_gerund(_plural(word))
    if w.endswith("y") and len(w) > 2 and _shape(w[:-1]).endswith("c"):
        w = w[:-1] + "i"
    return _final_letters(_long_suffix(_replace_suffix(_derivational(w), STEP_3)))
