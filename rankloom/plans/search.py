"""The search services as batch jobs: a table of queries in, a table of results out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import fusion, scoring
from ..operators.index import Index
from ..operators.joins import SHUFFLE_ROWS
from ..operators.ranking import all_ordered, attach_titles, top_k


@dataclass(frozen=True)
class Searcher:
    """An index with its titles and signals. Results are ``(qid, rank, doc_id, title, score)``."""

    index: Index
    titles: DataFrame  # doc_id, title
    signals: fusion.Signals | None = None

    def _batch(self, queries: DataFrame) -> scoring.QueryBatch:
        return scoring.query_batch(queries, self.index)

    def _present(self, ranked: DataFrame, batch: scoring.QueryBatch, k: int) -> DataFrame:
        bounded = batch.results_within(k, SHUFFLE_ROWS)
        titled = attach_titles(ranked, self.titles, bounded)
        return titled.select("qid", "rank", "doc_id", "title", "score")

    def search(self, queries: DataFrame, k: int = 100, field: str = "body") -> DataFrame:
        """Main search: TF-IDF over all query terms."""
        batch = self._batch(queries)
        return self._present(top_k(scoring.tfidf(self.index, batch, field), k), batch, k)

    def search_body(self, queries: DataFrame, mode: str = "full", k: int = 100) -> DataFrame:
        """TF-IDF cosine; ``mode='per_term'`` ignores document vectors."""
        return self._cosine(queries, "body", mode, k)

    def search_title(self, queries: DataFrame, mode: str = "distinct") -> DataFrame:
        """All pages whose title holds a query word, by distinct words; or per-term cosine."""
        return self._by_words(queries, "title", mode)

    def search_anchor(self, queries: DataFrame, mode: str = "distinct") -> DataFrame:
        """As :meth:`search_title`, on the texts of links to the page."""
        return self._by_words(queries, "anchor", mode)

    def search_two_field(self, queries: DataFrame, k: int = 100) -> DataFrame:
        batch = self._batch(queries)
        ranked = fusion.two_field_search(self.index, batch, self.signals, k=k)
        return self._present(ranked, batch, k)

    def search_three_field(self, queries: DataFrame, k: int = 100, **settings) -> DataFrame:
        batch = self._batch(queries)
        ranked = fusion.three_field_search(self.index, batch, self.signals, k=k, **settings)
        return self._present(ranked, batch, k)

    def _cosine(self, queries: DataFrame, field: str, mode: str, k: int) -> DataFrame:
        batch = self._batch(queries)
        return self._present(top_k(scoring.cosine(self.index, batch, field, mode), k), batch, k)

    def _by_words(self, queries: DataFrame, field: str, mode: str) -> DataFrame:
        if mode == "per_term":
            return self._cosine(queries, field, mode, 100)
        if mode != "distinct":
            raise ValueError(f"unknown match mode {mode!r}")
        batch = self._batch(queries)
        scores = scoring.distinct_match(self.index, batch, field)
        # Scores and titles are both bucketed by document, so this join moves nothing.
        titled = scores.join(self.titles.select("doc_id", "title"), "doc_id", "left")
        return all_ordered(titled.select("qid", "doc_id", "title", "score"))
