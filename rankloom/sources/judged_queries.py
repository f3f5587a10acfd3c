"""Judged queries: a JSON object that maps a query to a list of document ids, read and written.

The file is cut at its closing brackets, so that many tasks read it. A bracket within a string is told
from the end of a list by the quotes before it in the whole file; those are counted in every block of the
file first, and the blocks' counts, one row each, are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .workspace import Workspace

ENTRIES = "map<string,array<string>>"


def _with_earlier(rows: DataFrame, amount: Column, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over all earlier rows, and over all rows as ``<name>_in_all``."""
    up_to_here = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        rows.groupBy("block")
        .agg(F.sum(amount).alias("_n"))
        .select(
            "block",
            F.coalesce(F.sum("_n").over(up_to_here), F.lit(0)).alias("_before"),
            F.sum("_n").over(Window.partitionBy()).alias(f"{name}_in_all"),
        )
    )
    in_block = Window.partitionBy("block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.col("_before") + F.coalesce(F.sum(amount).over(in_block), F.lit(0))
    return rows.join(F.broadcast(blocks), "block").withColumn(name, earlier).drop("_before")


def _checked(value: Column, valid: Column, path: str) -> Column:
    error = F.raise_error(F.lit(f"{path}: not a JSON object of id lists"))
    return F.when(F.coalesce(valid, F.lit(False)), value).otherwise(error)


def read_judged_queries(
    spark: SparkSession, path: str, workspace: Workspace | None = None
) -> tuple[DataFrame, DataFrame]:
    """``queries(qid, query)`` in file order and ``judgments(qid, doc_id)``.

    ``path`` is a file, or a folder of part files that make one object in the order of their names, as
    :func:`write_judged_queries` leaves it. It is read when this is called. A missing file or invalid JSON fails; so does an empty file. Ids
    that are no numbers become null; a null list holds no ids. An entry is in one task as a whole.
    """
    workspace = workspace or Workspace(spark)
    pieces = workspace.save(
        "judged_pieces",
        spark.read.text(path, lineSep="]").select(
            F.concat("_metadata.file_path", F.format_string(":%020d", "_metadata.file_block_start")).alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
            F.length(F.regexp_replace("value", r'(?s)\\.|[^"\\]', "")).cast("bigint").alias("quotes"),
        ),
    )
    if pieces.isEmpty():
        raise ValueError(f"{path}: not a JSON object of id lists")
    opens = (F.col("quotes_before") % 2 == 0).cast("bigint")
    placed = _with_earlier(pieces, F.col("quotes"), "quotes_before").withColumn("opens", opens)
    # a part file ends with a line break behind its last list
    placed = placed.filter((F.col("opens") == 0) | F.col("value").rlike(r"[^ \t\r\n]"))
    numbered = _with_earlier(placed, F.col("opens"), "opened")
    # an entry is a piece and those behind it that begin within a string
    texts = numbered.groupBy((F.col("opened") + F.col("opens")).alias("number")).agg(
        F.array_sort(F.collect_list(F.struct("block", "seq", "value"))).alias("parts"),
        F.first("opened_in_all").alias("last"),
    )
    text = F.regexp_replace(F.array_join(F.col("parts.value"), "]"), r"^[ \t\r\n]+|[ \t\r\n]+$", "")
    first, last = F.col("number") == 1, F.col("number") == F.col("last")
    begun = F.when(first, text.startswith("{")).otherwise(text.startswith(",") | (last & (text == "}")))
    body = F.when(first | text.startswith(","), F.substr(text, F.lit(2))).otherwise(text)
    inner = F.when(last, F.regexp_replace(body, r"\}$", "")).otherwise(F.concat(body, F.lit("]")))
    ended = ~last | text.endswith("}")
    parsed = F.from_json(F.concat(F.lit("{"), F.col("inner"), F.lit("}")), ENTRIES)
    entries = workspace.save(
        "judged_entries",
        texts.select(
            F.col("parts")[0]["block"].alias("block"),
            F.col("parts")[0]["seq"].alias("seq"),
            _checked(inner, begun & ended, path).alias("inner"),
        )
        .select("block", "seq", F.map_entries(_checked(parsed, parsed.isNotNull(), path)).alias("found")),
    )
    listed = (
        _with_earlier(entries, F.size("found").cast("bigint"), "earlier")
        .select("earlier", F.posexplode("found").alias("pos", "_e"))
        .select(
            (F.col("earlier") + F.col("pos")).alias("qid"),
            F.col("_e.key").alias("query"),
            F.col("_e.value").alias("ids"),
        )
    )
    judgments = listed.select("qid", F.explode("ids").alias("_id")).select(
        "qid", F.expr("try_cast(_id AS bigint)").alias("doc_id")
    )
    return listed.select("qid", "query"), judgments


def write_judged_queries(queries: DataFrame, judgments: DataFrame, path: str) -> None:
    """Write ``queries(qid, query)`` with the ids of ``judgments(qid, doc_id)`` as one JSON object.

    Each qid has one row. The object is cut into part files in ascending order of qid, an entry a line; put one behind the other
    they are a JSON file. A query without judgments has an empty list, a null query the empty text; repeated
    queries stay apart. Ids are ascending strings.
    """
    ids = judgments.groupBy("qid").agg(F.array_sort(F.collect_list("doc_id")).alias("ids"))
    entries = queries.join(ids, "qid", "left").select(
        "qid",
        F.coalesce("query", F.lit("")).alias("query"),
        F.coalesce(F.col("ids").cast("array<string>"), F.array().cast("array<string>")).alias("ids"),
    )
    entry = F.to_json(F.create_map("query", "ids"))
    ends = queries.agg(F.min("qid").alias("first"), F.max("qid").alias("last")).first()
    if ends["first"] is None:
        queries.sparkSession.createDataFrame([("{}",)], "line string").write.text(path)
        return
    line = F.concat(
        F.when(F.col("qid") == ends["first"], "{").otherwise(","),
        F.substr(entry, F.lit(2), F.length(entry) - 2),
        F.when(F.col("qid") == ends["last"], "}").otherwise(""),
    )
    in_order = entries.repartitionByRange("qid").sortWithinPartitions("qid")
    in_order.select(line.alias("line")).write.text(path)
