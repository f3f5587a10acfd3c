import random

import pytest
from brute import tokens as expected_tokens
from brute_stemmer import stem_word
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankloom.functions import stemming, text


def tokenized(spark, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    rows = df.select("i", text.tokenize("s").alias("t")).orderBy("i").collect()
    return [r.t for r in rows]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("Rivers carry gravel", ["rivers", "carry", "gravel"]),
        ("category references also external links", []),
        ("Gravel GRAVEL gravel", ["gravel"] * 3),
        ("", []),
        ("   ", []),
        ("the a an", []),
        ("a ab abc abcd", ["abc", "abcd"]),
        ("a-b-c-d rock'n'roll", ["a-b-c-d", "rock'n'roll"]),
        ("ab²c ½ab", ["ab²c", "½ab"]),
        ("z" * 60, ["z" * 25, "z" * 25, "z" * 10]),
        ("harbour #Tide @buoy7 keel2", ["harbour", "#tide", "@buoy7", "keel2"]),
    ],
)
def test_tokenize(spark, value, expected):
    assert tokenized(spark, value) == [expected]


def test_stop_words_and_joined_words(spark):
    found = tokenized(
        spark,
        "There was a lighthouse on the island",
        "Its slow-moving glacier is over 300 metres deep. Melting began in 1984.",
    )
    assert found[0] == ["lighthouse", "island"]
    assert found[1] == ["slow-moving", "glacier", "300", "metres", "deep", "melting", "began", "1984"]


def test_stop_word_lists():
    assert len(text.ENGLISH_STOP_WORDS) == len(set(text.ENGLISH_STOP_WORDS)) == 179
    assert len(text.CORPUS_STOP_WORDS) == len(set(text.CORPUS_STOP_WORDS)) == 21


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text("abyzé#@-'_ .\n0Ñß字", max_size=60), min_size=1, max_size=8))
def test_tokens_equal_python_regex(spark, values):
    assert tokenized(spark, *values) == [expected_tokens(v) for v in values]


def test_term_counts_sum_to_tokens(spark):
    values = ["", "one apple apple", None, "pear apple pear the pear", "the of"]
    df = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string")
    rows = text.term_counts(df, ["doc_id"]).collect()
    assert {(r.doc_id, r.term): r.tf for r in rows} == {
        (1, "apple"): 2, (3, "pear"): 3, (3, "apple"): 1,
    }
    plan = text.term_counts(df, ["doc_id"])._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_idf_is_zero_without_documents(spark):
    df = spark.createDataFrame([(10, 0), (10, 10), (100, 1)], "n long, df long")
    rows = df.select(text.idf(F.col("n"), "df").alias("v")).collect()
    assert [r.v for r in rows] == [0.0, 0.0, 2.0]


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop",
    "falling": "fall", "hissing": "hiss", "failing": "fail", "filing": "file", "happy": "happi",
    "relational": "relat", "conditional": "condit", "rational": "ration", "digitizer": "digit",
    "vietnamization": "vietnam", "operator": "oper", "decisiveness": "decis",
    "hopefulness": "hope", "callousness": "callous", "formality": "formal",
    "sensitivity": "sensit", "sensibility": "sensibl", "triplicate": "triplic",
    "formative": "form", "formalize": "formal", "electrical": "electr", "hopeful": "hope",
    "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer",
    "airliner": "airlin", "adjustable": "adjust", "defensible": "defens", "irritant": "irrit",
    "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt",
    "communism": "commun", "activate": "activ", "homologous": "homolog", "effective": "effect",
    "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas",
    "controlling": "control", "rolling": "roll", "skies": "sky", "dying": "die", "news": "news",
    "spied": "spi", "died": "die", "flies": "fli", "enjoy": "enjoy", "generalizations": "gener",
    "oscillators": "oscil", "sky": "sky", "innings": "inning", "say": "say", "geology": "geolog",
}


def test_stemmer(spark):
    df = spark.createDataFrame([(w,) for w in STEMS], "term string")
    rows = stemming.stem_vocabulary(df).collect()
    assert {r.term: r.stem for r in rows} == STEMS


def test_stemmer_equals_plain_python(spark):
    """Random words of letters and suffixes that the rules look at, and odd ones."""
    rng = random.Random(5)
    ends = [a for a, _ in stemming.STEP_2 + stemming.STEP_3] + stemming.STEP_4
    ends += ["s", "sses", "ies", "ied", "eed", "ed", "ing", "y", "e", "ll", "logi", "alli", "ss"]
    words = set(stemming.IRREGULAR) | {"", "a", "yy", "yyyy", "syzygy", "don't", "é", "naïveness", "x-rays", "123s"}
    while len(words) < 3000:
        start = "".join(rng.choice("aeiouybcdlstzwxrnm") for _ in range(rng.randint(0, 6)))
        words.add(start + "".join(rng.choice(ends) for _ in range(rng.randint(0, 3))))
    df = spark.createDataFrame([(w, len(w)) for w in words], "term string, w0 int")
    rows = stemming.stem_vocabulary(df).collect()
    assert {r.term: r.stem for r in rows} == {w: stem_word(w) for w in words}
    assert all(r.w0 == len(r.term) for r in rows)
