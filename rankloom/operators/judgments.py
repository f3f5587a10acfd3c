"""Relevance judgments derived from texts: a document that contains a passage is relevant to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import Workspace
from .index import Index
from .joins import BROADCAST_ROWS, lookup_join
from .scoring import match, query_batch, weigh

# Bytes of passages that are broadcast to be joined with candidates.
PASSAGE_BYTES = 32 << 20
# Bytes of different passages that one automaton holds; more take several passes over the texts.
AUTOMATON_BYTES = 4 << 20


def _search(passages: list[str]):
    """Arrow function from ``(doc_id, text)`` to the places in ``passages`` that a text contains."""

    def run(batches):
        import ahocorasick
        import pyarrow as pa

        automaton, always = ahocorasick.Automaton(), set()
        for place, passage in enumerate(passages):
            if passage:
                automaton.add_word(passage, place)
            else:
                always.add(place)
        automaton.make_automaton()
        for batch in batches:
            rows, places = [], []
            for row, text in enumerate(batch.column(1)):
                if not text.is_valid:
                    continue
                found = always.copy()
                if len(automaton):
                    found.update(place for _, place in automaton.iter(text.as_py()))
                rows += [row] * len(found)
                places += found
            doc_ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(places, pa.int64())], ["doc_id", "place"])

    return run


def _containing_anywhere(passages: DataFrame, docs: DataFrame):
    """``(qid, doc_id)`` of passages, found in one pass over all texts for each block of passages."""
    different = passages.select("query").distinct()
    size = different.agg(F.coalesce(F.sum(F.octet_length("query") + 16), F.lit(0))).first()[0]
    blocks = -(-size // AUTOMATON_BYTES)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    for block in range(blocks):
        mine = F.pmod(F.xxhash64("query"), F.lit(blocks)) == block
        texts = [r["query"] for r in different.filter(mine).collect()]
        places = docs.sparkSession.createDataFrame(list(enumerate(texts)), "place bigint, query string")
        asked = passages.filter(mine).join(F.broadcast(places), "query").select("place", "qid")
        held = docs.select("doc_id", "text").mapInArrow(_search(texts), f"doc_id {id_type}, place bigint")
        if asked.count() <= BROADCAST_ROWS:
            pairs = held.join(F.broadcast(asked), "place")
        else:
            pairs = lookup_join(held, asked, ["place"], False, "inner")
        yield pairs.select("qid", "doc_id")


def containing_documents(
    passages: DataFrame, docs: DataFrame, index: Index, workspace: Workspace, field: str = "body"
) -> DataFrame:
    """``(qid, doc_id)`` of all documents whose text contains the passage ``query`` verbatim.

    The inner words of a contained passage, all but the first and the last, are words of the
    document too, so only documents holding the rarest inner word are compared. A passage without
    an inner word that is a token and no stop word is looked for in every document, all such passages
    at once by an automaton. Null passages are contained nowhere, empty ones in every text that isn't null.
    """
    inner = passages.select("qid", F.regexp_replace("query", r"^\S*|\S*$", "").alias("query"))
    batch = query_batch(inner, index)
    rarest = (
        weigh(index, batch, field)
        .groupBy("qid")
        .agg(F.min(F.struct("df", "term", "term_bucket", "qtf")).alias("_r"))
        .select("qid", "_r.term_bucket", "_r.term", "_r.qtf")
    )
    candidates = workspace.save(
        "judgment_candidates", match(index, batch, field, rarest).select("qid", "doc_id")
    )
    if candidates.count() <= BROADCAST_ROWS:
        texts = docs.select("doc_id", "text").join(F.broadcast(candidates), "doc_id")
    else:
        texts = lookup_join(
            candidates, docs.select("doc_id", "text"), ["doc_id"], False, "inner"
        )
    asked = passages.select("qid", "query").filter("query is not null")
    usable = batch.terms.select("qid").distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("query") + 16), F.lit(0))).first()[0]
    if batch.bounded and size <= PASSAGE_BYTES:
        pairs = texts.join(F.broadcast(asked), "qid")
    else:
        pairs = lookup_join(texts, asked, ["qid"], False, "inner")
    found = pairs.filter(F.contains("text", "query")).select("qid", "doc_id")
    plain = workspace.save("judgment_plain", asked.join(usable, "qid", "left_anti"))
    for held in _containing_anywhere(plain, docs):
        found = found.unionByName(held)
    return found
