"""Porter stemming of a vocabulary as column expressions.

The rules are written as layers of SQL expressions, each over the columns of the layers before, in the part
of SQL that Spark shares with other engines: ``CASE``, ``LIKE``, ``left`` and ``length``. Only the fold over
the letters of a word differs by dialect. A word's shape is a string of ``v`` and ``c``, one for each letter;
a measure over 0 is then ``LIKE '%vc%'``, over 1 ``LIKE '%vc%vc%'``, and the shape of a word without its
suffix is the shape without as many letters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import Workspace

# Irregular forms and the rules of Porter (1980) with the usual later amendments.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
    "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
    "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
    ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]
# End of fixed values.

#: Kind of the letter ``ch`` after the letters of shape ``acc``: y is a vowel after a consonant.
LETTER = (
    "CASE WHEN ch IN ('a', 'e', 'i', 'o', 'u') OR (ch = 'y' AND acc LIKE '%c') THEN 'v' "
    "WHEN ch = '' THEN '' ELSE 'c' END"
)


def spark_shape(word: str) -> str:
    return f"aggregate(split({word}, ''), '', (acc, ch) -> concat(acc, {LETTER}))"


def cut(column: str, letters: int | str) -> str:
    """The column without its last letters."""
    return f"left({column}, CAST(length({column}) - {letters} AS INT))"


def positive(shape: str, letters: int) -> str:
    """The measure before a suffix is over 0."""
    return f"{cut(shape, letters)} LIKE '%vc%'"


def short_end(word: str, shape: str) -> str:
    """Ends consonant-vowel-consonant, the last not w, x or y, or is exactly vowel-consonant."""
    last = " AND ".join(f"{word} NOT LIKE '%{x}'" for x in "wxy")
    return f"({shape} = 'vc' OR ({shape} LIKE '%cvc' AND {last}))"


def replaced(word: str, shape: str, rules: list[tuple[str, str]], more: str = "") -> str:
    """The longest matching suffix replaced if a measure is left before it."""
    cases = [
        f"WHEN {word} LIKE '%{old}' THEN CASE WHEN {positive(shape, len(old))} "
        f"THEN concat({cut(word, len(old))}, '{new}') ELSE {word} END"
        for old, new in sorted(rules, key=lambda rule: -len(rule[0]))
    ]
    return f"CASE {more} {' '.join(cases)} ELSE {word} END"


def _without_long_suffix() -> str:
    cases = []
    for old in sorted(STEP_4, key=lambda suffix: -len(suffix)):
        stem, left = cut("w5", len(old)), cut("s5", len(old))
        allowed = f"{left} LIKE '%vc%vc%'"
        if old == "ion":
            allowed += f" AND ({stem} LIKE '%s' OR {stem} LIKE '%t')"
        cases.append(f"WHEN w5 LIKE '%{old}' THEN CASE WHEN {allowed} THEN {stem} ELSE w5 END")
    return f"CASE {' '.join(cases)} ELSE w5 END"


def layers(shape) -> list[tuple[str, str]]:
    """Columns after ``term``, in order; the last one is ``stem``. ``shape`` is the fold of the dialect."""
    irregular = " ".join(f"WHEN term = '{word}' THEN '{stem}'" for word, stem in IRREGULAR.items())
    alone = " OR ".join(f"w1c LIKE '%{x}'" for x in "lsz")
    doubled = "length(w1c) > 1 AND right(w1c, 1) = left(right(w1c, 2), 1) AND s1c LIKE '%c'"
    return [
        # plural
        ("w0", f"""CASE WHEN term LIKE '%ies' THEN CASE WHEN length(term) = 4 THEN {cut("term", 1)}
            ELSE {cut("term", 2)} END WHEN term LIKE '%sses' THEN {cut("term", 2)}
            WHEN term LIKE '%s' AND term NOT LIKE '%ss' THEN {cut("term", 1)} ELSE term END"""),
        ("s0", shape("w0")),
        # past and gerund: what is cut, and what ends otherwise
        ("gone", f"""CASE WHEN w0 LIKE '%ied' OR w0 LIKE '%eed' THEN 0
            WHEN w0 LIKE '%ed' AND {cut("s0", 2)} LIKE '%v%' THEN 2
            WHEN w0 LIKE '%ing' AND {cut("s0", 3)} LIKE '%v%' THEN 3 ELSE 0 END"""),
        ("w1c", cut("w0", "gone")),
        ("s1c", cut("s0", "gone")),
        ("w1", f"""CASE WHEN gone > 0 THEN CASE
                WHEN w1c LIKE '%at' OR w1c LIKE '%bl' OR w1c LIKE '%iz' THEN concat(w1c, 'e')
                WHEN {doubled} THEN CASE WHEN {alone} THEN w1c ELSE {cut("w1c", 1)} END
                WHEN s1c LIKE '%vc%' AND s1c NOT LIKE '%vc%vc%' AND {short_end("w1c", "s1c")}
                THEN concat(w1c, 'e') ELSE w1c END
            WHEN w0 LIKE '%ied' THEN CASE WHEN length(w0) = 4 THEN {cut("w0", 1)} ELSE {cut("w0", 2)} END
            WHEN w0 LIKE '%eed' AND {positive("s0", 3)} THEN {cut("w0", 1)} ELSE w0 END"""),
        ("s1", shape("w1")),
        ("w2", f"""CASE WHEN w1 LIKE '%y' AND length(w1) > 2 AND {cut("s1", 1)} LIKE '%c'
            THEN concat({cut("w1", 1)}, 'i') ELSE w1 END"""),
        ("s2", shape("w2")),
        # derivational suffixes; one in -alli loses its adverb first
        ("w3", f"CASE WHEN w2 LIKE '%alli' AND {positive('s2', 4)} THEN {cut('w2', 2)} ELSE w2 END"),
        ("s3", shape("w3")),
        ("w4", replaced("w3", "s3", STEP_2, f"""WHEN w3 LIKE '%logi' THEN CASE WHEN {positive("s3", 3)}
            THEN {cut("w3", 1)} ELSE w3 END""")),
        ("s4", shape("w4")),
        ("w5", replaced("w4", "s4", STEP_3)),
        ("s5", shape("w5")),
        ("w6", _without_long_suffix()),
        ("s6", shape("w6")),
        ("w7", f"""CASE WHEN w6 LIKE '%e' AND ({cut("s6", 1)} LIKE '%vc%vc%' OR ({cut("s6", 1)} LIKE '%vc%'
            AND NOT {short_end(cut("w6", 1), cut("s6", 1))})) THEN {cut("w6", 1)} ELSE w6 END"""),
        ("s7", shape("w7")),
        ("stem", f"""CASE {irregular} WHEN length(term) <= 2 THEN term
            WHEN w7 LIKE '%ll' AND {cut("s7", 1)} LIKE '%vc%vc%' THEN {cut("w7", 1)} ELSE w7 END"""),
    ]


def stem_vocabulary(terms: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """``(term, ...)`` with distinct terms to ``(term, ..., stem)``, without leaving the JVM.

    The result is written: a filter on the stem, pushed down through the layers, would repeat each in the
    next and grow beyond any plan.
    """
    stems = terms.select(*[F.col(c).alias(f"_{c}" if c != "term" else c) for c in terms.columns])
    for name, expression in layers(spark_shape):
        stems = stems.withColumn(name, F.expr(expression))
    stems = stems.select(*[F.col(f"_{c}" if c != "term" else c).alias(c) for c in terms.columns], "stem")
    return (workspace or Workspace(terms.sparkSession)).save("vocabulary", stems)
