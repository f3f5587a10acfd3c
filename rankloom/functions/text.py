"""Analyzers as Column and DataFrame expressions; everything here stays in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They decide which tokens exist, so they must not change.
TOKEN_PATTERN = r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}"

ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
yourselves he him his himself she she's her hers herself it it's its itself they them their
theirs themselves what which who whom this that that'll these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at
by for with about against between into through during before after above below to from up down
in out on off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will just don
don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn
doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn
needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

CORPUS_STOP_WORDS = """
category references also external links may first see history people one two part thumb
including second following many however would became
""".split()
# End of fixed values.

STOP_WORDS = sorted(set(ENGLISH_STOP_WORDS) | set(CORPUS_STOP_WORDS))


def raw_tokens(text: Column | str) -> Column:
    """All tokens of a text in order, stop words included."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def is_stop_word(term: Column | str) -> Column:
    return (F.col(term) if isinstance(term, str) else term).isin(STOP_WORDS)


def tokenize(text: Column | str) -> Column:
    """Tokens of a text in order, with duplicates, without stop words."""
    return F.filter(raw_tokens(text), lambda t: ~is_stop_word(t))


def term_counts(rows: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """One row ``(*keys, term, tf)`` per distinct term of each input row.

    Counting happens inside the row (sort the tokens, measure the runs), so a text never leaves
    its task: no shuffle, and memory is bounded by the longest single text.
    """
    ordered = rows.select(*keys, F.sort_array(raw_tokens(text)).alias("_toks"))
    starts = ordered.select(
        *keys,
        "_toks",
        F.filter(
            F.transform("_toks", lambda _, i: i),
            lambda i: (i == 0) | (F.get("_toks", i) != F.get("_toks", i - 1)),
        ).alias("_starts"),
    )
    runs = F.transform(
        "_starts",
        lambda i, n: F.struct(
            F.get("_toks", i).alias("term"),
            (F.coalesce(F.get("_starts", n + 1), F.size("_toks")) - i).alias("tf"),
        ),
    )
    # Filtered inside the array: as a row filter, Catalyst would repeat it on the other side of
    # every join on the term.
    kept = F.filter(runs, lambda r: ~is_stop_word(r["term"]))
    return starts.select(*keys, F.explode(kept).alias("_run")).select(
        *keys, "_run.term", "_run.tf"
    )


def term_bucket(term: Column | str, buckets: int) -> Column:
    """Directory a term's postings live in."""
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def idf(n: Column, df: Column | str) -> Column:
    """``log10(n / df)``, 0 for a term without documents."""
    df = F.col(df) if isinstance(df, str) else df
    return F.when(df > 0, F.log10(n / df)).otherwise(F.lit(0.0))
