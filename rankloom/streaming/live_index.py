"""Index that grows document batch by document batch, also from a stream, in segments."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import term_bucket
from ..operators.index import (
    Index,
    corpus_sizes,
    corpus_statistics,
    count_terms,
    document_lengths,
    term_statistics,
    write_index,
)
from ..sources.workspace import POSTING_TEXT, Workspace, delete, exists, text_buckets

POSTINGS = "doc_id bigint, term string, tf int, field string, term_bucket int"
TERMS = "term string, df bigint, term_total bigint, field string, term_bucket int"
SIZES = "field string, n_docs bigint, merged boolean, replaced boolean"
IDS = "doc_id bigint, docs bigint, replaces boolean, field string"
TABLES = {"postings": POSTINGS, "terms": TERMS, "sizes": SIZES, "ids": IDS}


@dataclass(frozen=True)
class Segment:
    """A folder with the tables of one batch, or of several that were folded."""

    name: str
    order: int  # of the latest batch; a later segment's replacements hold for earlier ones
    batches: tuple[int, ...]
    postings: int


class LiveIndex:
    """Segments under a manifest, of which every change writes a new generation.

    A reader sees the segments of the latest generation. A batch counts from the moment the manifest
    names it: one that failed before is written anew, one that is delivered again is not taken again,
    also after it was folded. :meth:`fold` gathers segments of like size, so that there are few; folders
    that the last generations don't name are removed by :meth:`retire`. There is one writer at a time.

    Adding a document again in another batch counts it twice, as a second document, unless the batch is
    appended with ``replace``: its ids then take the place of all earlier documents with these ids. In a
    field that was ever appended with ``merge`` all rows of an id are one document. Statistics are sums
    over the segments; those of fields with merged or replaced ids come from postings and ids.
    """

    def __init__(self, workspace: Workspace, term_buckets: int = 4, fan: int = 4):
        self.workspace = workspace
        self.term_buckets = term_buckets
        self.fan = fan

    # ---- generations

    def _generation(self, number: int) -> str:
        return self.workspace.path(f"live_manifest/generation={number}")

    def _manifest(self) -> tuple[int, list[Segment]]:
        """The latest generation and its segments in order; a few rows for each segment."""
        spark, folder = self.workspace.spark, self.workspace.path("live_manifest")
        if not exists(spark, folder):
            return 0, []
        latest = (
            spark.read.schema("value string, generation int").text(folder)
            .orderBy(F.desc("generation")).limit(1).collect()
        )
        if not latest:
            return 0, []
        found = [Segment(**{**s, "batches": tuple(s["batches"])}) for s in json.loads(latest[0]["value"])]
        return latest[0]["generation"], sorted(found, key=lambda s: s.order)

    def _commit(self, generation: int, segments: list[Segment]) -> None:
        spark, text = self.workspace.spark, json.dumps([vars(s) for s in segments])
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(self._generation(generation))

    def segments(self) -> list[Segment]:
        return self._manifest()[1]

    def retire(self, keep: int = 1) -> list[str]:
        """Remove the folders of segments that none of the last ``keep`` generations names."""
        spark, folder = self.workspace.spark, self.workspace.path("live_manifest")
        last, _ = self._manifest()
        rows = spark.read.schema("value string, generation int").text(folder).collect()
        names = [({s["name"] for s in json.loads(r["value"])}, r["generation"]) for r in rows]
        kept = set().union(*(n for n, g in names if g > last - keep))
        old = sorted(set().union(*(n for n, g in names)) - kept)
        for name in old:
            delete(spark, self.workspace.path(f"live/{name}"))
        for _, generation in names:
            if generation <= last - keep:
                delete(spark, self._generation(generation))
        return old

    # ---- tables of segments

    def _read(self, table: str, segments: list[Segment]) -> DataFrame:
        """A table of some segments, with their ``order``."""
        spark, none = self.workspace.spark, TABLES[table]
        parts = [
            spark.read.schema(none).parquet(self.workspace.path(f"live/{s.name}/{table}"))
            .withColumn("order", F.lit(s.order))
            for s in segments
        ]
        return reduce(DataFrame.unionByName, parts, spark.createDataFrame([], none + ", order int"))

    def _write(self, name: str, table: str, rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        folder = self.workspace.path(f"live/{name}/{table}")
        rows.write.mode("overwrite").partitionBy(*by).parquet(folder)
        return self.workspace.spark.read.schema(TABLES[table]).parquet(folder)

    def append(
        self, fields: dict[str, DataFrame], batch_id: int, merge: tuple[str, ...] = (),
        replace: bool = False,
    ) -> bool:
        """Add a batch of ``(doc_id, text)`` tables; False if it was taken before."""
        spark = self.workspace.spark
        generation, segments = self._manifest()
        if any(batch_id in s.batches for s in segments):
            return False
        name = f"batch{batch_id}"
        # by a hash of their own: files that were dealt by doc_id would fill a few buckets of it only
        rows = {
            field: docs.repartition(text_buckets(docs), F.xxhash64("doc_id", "text"))
            for field, docs in fields.items()
        }
        postings = count_terms(rows, merge).withColumn(
            "term_bucket", term_bucket("term", self.term_buckets)
        )
        written = self._write(name, "postings", postings, ("field", "term_bucket"))
        self._write(name, "terms", term_statistics(written), ("field", "term_bucket"))
        ids = [
            docs.groupBy("doc_id").agg(F.count("*").alias("docs")).select(
                "doc_id", "docs", F.lit(replace).alias("replaces"), F.lit(field).alias("field")
            )
            for field, docs in fields.items()
        ]
        kept = self._write(name, "ids", reduce(DataFrame.unionByName, ids), ("field",))
        counted = F.when(F.col("field").isin(list(merge)), 1).otherwise(F.col("docs"))
        sizes = kept.groupBy("field").agg(F.sum(counted).alias("n_docs")).collect()
        counts = {field: 0 for field in fields} | {r["field"]: r["n_docs"] for r in sizes}
        self._write(
            name, "sizes",
            corpus_sizes(spark, counts).withColumns(
                {"merged": F.col("field").isin(list(merge)), "replaced": F.lit(replace)}
            ),
        )
        order = 1 + max((s.order for s in segments), default=0)
        self._commit(
            generation + 1, [*segments, Segment(name, order, (batch_id,), written.count())]
        )
        return True

    def fold(self) -> int:
        """Gather runs of ``fan`` successive segments of like size until there are none; their number."""
        folded = 0
        while True:
            generation, segments = self._manifest()
            tiers = [int(math.log(max(s.postings, 1), self.fan)) for s in segments]
            at = next(
                (
                    k for k in range(len(segments) - self.fan + 1)
                    if max(tiers[k : k + self.fan]) - min(tiers[k : k + self.fan]) <= 1
                ),
                None,
            )
            if at is None:
                return folded
            run = segments[at : at + self.fan]
            name = f"fold{generation + 1}"
            merged, replaced = self._special(run)
            postings = self._postings(run, merged, replaced)
            # a task sorts its rows by directory, so it gets a bucket and not a split of the small files
            buckets = text_buckets(postings, F.lit(POSTING_TEXT))
            written = self._write(
                name, "postings", postings.repartition(buckets, F.xxhash64("doc_id", "term")),
                ("field", "term_bucket"),
            )
            self._write(name, "terms", term_statistics(written), ("field", "term_bucket"))
            ids = self._ids(run, replaced).groupBy("field", "doc_id").agg(
                F.sum("docs").alias("docs"), F.max("replaces").alias("replaces")
            )
            self._write(name, "ids", ids, ("field",))
            sizes = self._sizes(run, merged, replaced).withColumns(
                {"merged": F.col("field").isin(merged), "replaced": F.col("field").isin(replaced)}
            )
            self._write(name, "sizes", sizes.coalesce(1))
            batches = tuple(b for s in run for b in s.batches)
            whole = Segment(name, run[-1].order, batches, written.count())
            self._commit(generation + 1, [*segments[:at], whole, *segments[at + self.fan :]])
            folded += 1

    def take(self, field: str = "body", replace: bool = False) -> Callable[[DataFrame, int], None]:
        """What a stream does with each batch."""

        def run(batch: DataFrame, batch_id: int) -> None:
            if self.append({field: batch.select("doc_id", "text")}, batch_id, replace=replace):
                self.fold()

        return run

    def stream(
        self, docs: DataFrame, checkpoint: str, field: str = "body",
        take: Callable[[DataFrame, int], None] | None = None,
    ) -> StreamingQuery:
        """Index all documents of a stream that are available now."""
        return (
            docs.select("doc_id", "text")
            .writeStream.foreachBatch(take or self.take(field))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    # ---- reading

    def _special(self, segments: list[Segment]) -> tuple[list[str], list[str]]:
        """Fields whose rows are gathered by id, and fields with replaced ids; names only."""
        sizes = self._read("sizes", segments)
        flags = sizes.groupBy("field").agg(F.max("merged").alias("m"), F.max("replaced").alias("r")).collect()
        return sorted(r.field for r in flags if r.m), sorted(r.field for r in flags if r.r)

    def _current(self, rows: DataFrame, segments: list[Segment], replaced: list[str]) -> DataFrame:
        """Rows of ``(field, doc_id, order)`` that no later segment of ``segments`` replaces."""
        if not replaced:
            return rows
        latest = (
            self._read("ids", segments).filter(F.col("field").isin(replaced) & F.col("replaces"))
            .groupBy("field", "doc_id").agg(F.max("order").alias("_latest"))
        )
        return rows.join(latest, ["field", "doc_id"], "left").filter(
            F.col("_latest").isNull() | (F.col("order") >= F.col("_latest"))
        ).drop("_latest")

    def _ids(self, segments: list[Segment], replaced: list[str]) -> DataFrame:
        return self._current(self._read("ids", segments), segments, replaced)

    def _postings(self, segments: list[Segment], merged: list[str], replaced: list[str]) -> DataFrame:
        postings = self._current(self._read("postings", segments), segments, replaced).drop("order")
        if not merged:
            return postings
        gathered = (
            postings.filter(F.col("field").isin(merged))
            .groupBy("field", "term_bucket", "term", "doc_id")
            .agg(F.sum("tf").cast("int").alias("tf"))
        )
        return postings.filter(~F.col("field").isin(merged)).unionByName(
            gathered.select(*postings.columns)
        )

    def _sizes(self, segments: list[Segment], merged: list[str], replaced: list[str]) -> DataFrame:
        special = sorted({*merged, *replaced})
        sizes = self._read("sizes", segments).filter(~F.col("field").isin(special))
        sums = sizes.groupBy("field").agg(F.sum("n_docs").alias("n_docs"))
        if not special:
            return sums
        ids = self._ids(segments, replaced).filter(F.col("field").isin(special))
        ids = ids.groupBy("field", "doc_id").agg(F.sum("docs").alias("docs"))
        counted = F.when(F.col("field").isin(merged), 1).otherwise(F.col("docs"))
        return sums.unionByName(ids.groupBy("field").agg(F.sum(counted).alias("n_docs")))

    def index(self) -> Index:
        """The index over all batches so far, computed when used; see also :meth:`compact`."""
        segments = self.segments()
        merged, replaced = self._special(segments)
        special = sorted({*merged, *replaced})
        postings = self._postings(segments, merged, replaced)
        parts = self._read("terms", segments).filter(~F.col("field").isin(special))
        terms = parts.groupBy("field", "term_bucket", "term").agg(
            F.sum("df").cast("bigint").alias("df"),
            F.sum("term_total").cast("bigint").alias("term_total"),
        )
        if special:
            gathered = term_statistics(postings.filter(F.col("field").isin(special)))
            terms = terms.unionByName(gathered.select(*terms.columns))
        return Index(
            postings,
            terms,
            document_lengths(postings),
            corpus_statistics(terms, self._sizes(segments, merged, replaced)),
            term_buckets=self.term_buckets,
        )

    def compact(self, workspace: Workspace, buckets: int | None = None) -> Index:
        """Write all batches so far as one index in the layout for fast scoring."""
        segments = self.segments()
        merged, replaced = self._special(segments)
        postings = self._postings(segments, merged, replaced)
        buckets = buckets or text_buckets(postings, F.lit(POSTING_TEXT))
        counts = postings.select("field", "doc_id", "term", "tf").repartition(buckets, "doc_id")
        sizes = self._sizes(segments, merged, replaced)
        return write_index(counts, sizes, workspace, buckets, term_buckets=self.term_buckets)
