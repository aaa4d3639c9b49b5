"""Filter interaction audit by incremental retraction (operator 13).

Five filters judge every text (words: stretches between ASCII white space):
A, under 50 words; B, under 65 % distinct words; C, over 5 % capitals A-Z;
D, one of ``#$%&*|``; E, the text of a smaller doc_id.  A document's
failures are a mask of five bits; how any order of the filters shares out
the documents follows from the number of documents per mask.  A *part* (a
source) therefore needs only counters: per mask, documents, those labelled
good and those labelled toxic.

A to D depend on the text alone; E changes as files arrive.  The files are
read as a stream of available-now micro-batches.  A batch adds its documents
to the counters as if all had failed E.  The state holds, for each text (by
a 128-bit hash), the smallest doc_id met so far and its rows.  When a batch
brings a smaller id, the earlier rows' entry is retracted from the counters
(their masks now hold E) and the new ones entered without E.  Batches may
come in any order; the sum of all changes is the same.

A batch reads the state that the batch before it wrote and writes its own
and its changes to folders named by its number, in the shared folder, so a
batch that is run again replaces itself.  Documents with a hot text are
reduced to the text's smallest id before they meet the state (a partial
minimum, then a join that also names the id).  Texts leave no task: a row
is an id, a part, two hashes and a mask.

Null texts are empty.  A null doc_id is neither smaller nor larger than any
other: it neither fails E nor makes others fail; it has no label.  Rows
equal in doc_id and text are no smaller than each other.  A document is
good (toxic) if one of its label rows says so.  Empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sylvan.llm.common import quoted
from sylvan.session import scratch_path

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
_E = 1 << FILTERS.index("E")
_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"

#: Rows of a file of the state, and files of a batch's changes (a row per part, mask and label).
STATE_ROWS = 2_000_000
CHANGE_FILES = 8

_SEEN = "h1 long, h2 long, doc_id long, part string, mask int, good int, toxic int, n long"
_CHANGES = "part string, mask int, good int, toxic int, n long"
_COUNTED = ["part", "mask", "good", "toxic"]


def text_mask(text: bytes, points: int) -> int:
    """Failures of the filters A to D."""
    words = text.split()
    n = len(words)
    few = n < 50
    same = 100 * len(set(words)) < 65 * n
    loud = 100 * (len(text) - len(text.translate(None, _CAPITALS))) > 5 * points
    marked = len(text.translate(None, _MARKS)) < len(text)
    return few | same << 1 | loud << 2 | marked << 3


def _judged(text: pa.Array) -> pa.Array:
    points = pc.utf8_length(text).to_pylist()
    h1, h2, mask = [], [], []
    for body, n in zip(text.cast(pa.binary()).to_pylist(), points):
        d = xxhash.xxh3_128_digest(body)
        h1.append(int.from_bytes(d[:8], "big", signed=True))
        h2.append(int.from_bytes(d[8:], "big", signed=True))
        mask.append(text_mask(body, n))
    return pa.StructArray.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(mask, pa.int32())],
                                      ["h1", "h2", "mask"])


def judged(docs: DataFrame, part: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(doc_id, part, h1, h2, mask)`` of every document: its text's hash and failures but E."""
    seen = F.arrow_udf(_judged, "struct<h1: long, h2: long, mask: int>")(F.coalesce(quoted(text).cast("string"), F.lit("")))
    return (docs.select(quoted(doc_id).cast("long").alias("doc_id"),
                        F.coalesce(quoted(part).cast("string"), F.lit("")).alias("part"), seen.alias("seen"))
            .select("doc_id", "part", "seen.h1", "seen.h2", "seen.mask"))


def _with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of equal id, part and text as one with their number ``n``, and the labels of the id."""
    same = rows.groupBy("doc_id", "part", "h1", "h2", "mask").agg(F.count("*").alias("n"))
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    named = same.filter("doc_id is not null").join(marks, "doc_id", "left")
    nameless = same.filter("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return named.unionByName(nameless).select(
        "h1", "h2", "doc_id", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"), "n")


def _smallest(rows: DataFrame) -> DataFrame:
    """For each text the rows of its smallest doc_id."""
    least = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("doc_id"))
    return rows.join(least, ["h1", "h2", "doc_id"]).select(*rows.columns)


def _entry(rows: DataFrame, times: int) -> DataFrame:
    """The counters' correction for rows that hold a text's smallest id: out of the mask with E, into that without."""
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), (F.col("n") * times).alias("n")),
                             F.struct(F.col("mask").bitwiseOR(F.lit(_E)).alias("mask"), (F.col("n") * -times).alias("n"))))
    return rows.select("part", "good", "toxic", both.alias("x")).select("part", "x.mask", "good", "toxic", "x.n")


def retract(spark: SparkSession, batch: DataFrame, labels: DataFrame, number: int, home: str) -> None:
    """One micro-batch: reads state ``number - 1``, writes state and changes ``number``."""
    rows = _with_labels(batch, labels).persist(StorageLevel.DISK_ONLY)
    named = rows.filter("doc_id is not null")
    before = (spark.read.schema(_SEEN).parquet(f"{home}/state/{number - 1}") if number
              else spark.createDataFrame([], _SEEN))
    least = F.min("doc_id").over(Window.partitionBy("h1", "h2"))          # a text has few rows here: its smallest ids'
    meeting = (before.withColumn("old", F.lit(True)).unionByName(_smallest(named).withColumn("old", F.lit(False)))
               .withColumn("holds", F.col("doc_id") == least).persist(StorageLevel.DISK_ONLY))
    held = meeting.filter("holds").select(*before.columns)
    held.coalesce(held.count() // STATE_ROWS + 1).write.mode("overwrite").parquet(f"{home}/state/{number}")
    arrived = (named.withColumn("mask", F.col("mask").bitwiseOR(F.lit(_E)))
               .unionByName(rows.filter("doc_id is null")).select(*_COUNTED, "n"))
    changes = (arrived.unionByName(_entry(meeting.filter("holds and not old"), 1))
               .unionByName(_entry(meeting.filter("old and not holds"), -1)))
    (changes.groupBy(*_COUNTED).agg(F.sum("n").alias("n")).filter("n <> 0").coalesce(CHANGE_FILES)
     .write.mode("overwrite").parquet(f"{home}/changes/{number}"))
    for table in (rows, meeting):
        table.unpersist()


def part_counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = 4, part: str = "source",
                  text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(part, mask, good, toxic, n)`` of all files of a Parquet table, streamed in about ``batches`` micro-batches."""
    table = spark.read.parquet(path)
    files = len(table.inputFiles())
    home = scratch_path(spark, "audit")
    # a pattern of one match: the file source takes a plain path for a folder, but a table may be one file
    bare = path.rstrip("/")
    stream = (spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, -(-files // max(1, batches))))
              .parquet(f"{bare[:-1]}[{bare[-1]}]"))
    marks = labels.select("doc_id", "quality", "toxic")
    query = (judged(stream, part, text, doc_id).writeStream
             .foreachBatch(lambda rows, number: retract(rows.sparkSession, rows, marks, number, home))
             .option("checkpointLocation", f"{home}/progress").trigger(availableNow=True).start())
    query.awaitTermination()
    if not files:
        return spark.createDataFrame([], _CHANGES)
    return (spark.read.schema(_CHANGES).parquet(f"{home}/changes/*")
            .groupBy(*_COUNTED).agg(F.sum("n").alias("n")).filter("n <> 0"))


# --- all orders of the filters -----------------------------------------------------------------

def _tables() -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each (order, step): the order, its step and filter, and which masks it keeps and removes."""
    masks = np.arange(MASKS)
    names, steps, filters, kept, removed = [], [], [], [], []
    for order in permutations(FILTERS):
        gone = np.zeros(MASKS, bool)
        for step, letter in enumerate(order, 1):
            i = FILTERS.index(letter)
            fails = (masks >> i & 1).astype(bool)
            names.append("".join(order))
            steps.append(step)
            filters.append(i)
            removed.append(fails & ~gone)
            gone = gone | fails
            kept.append(~gone)
    return names, np.array(steps), np.array(filters), np.array(kept, np.int64), np.array(removed, np.int64)


_OUT = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
                  *((c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
                                              "shapley"))])
_OUT_DDL = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
            "good_lost long, toxic_lost long, shapley long")


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, steps, filters, kept, removed = _tables()
    fails = (np.arange(MASKS)[None, :] >> np.arange(len(FILTERS))[:, None]) & 1
    for batch in batches:
        count = {c: np.array([x.as_py() for x in batch.column(c)], np.int64).reshape(-1, MASKS)
                 for c in ("n", "good", "toxic")}
        for i, part in enumerate(batch.column("part").to_pylist()):
            n = count["n"][i]
            out = removed @ n
            shapley = np.bincount(filters, out, len(FILTERS)).astype(np.int64)
            alone = n[1 << np.arange(len(FILTERS))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(names)), pa.array(names), pa.array(steps, pa.int32()), pa.array(kept @ n),
                 pa.array(out), pa.array((fails @ n)[filters] - out), pa.array(alone[filters]),
                 pa.array(removed @ count["good"][i]), pa.array(removed @ count["toxic"][i]), pa.array(shapley[filters])],
                schema=_OUT)


def interactions(counters: DataFrame) -> DataFrame:
    """A row per part, order of the five filters and step, from the part counters."""
    def by_mask(value):
        return F.array(*(F.sum(F.when(F.col("mask") == m, value).otherwise(F.lit(0))).cast("long") for m in range(MASKS)))
    n = F.col("n")
    wide = counters.groupBy("part").agg(by_mask(n).alias("n"), by_mask(n * F.col("good")).alias("good"),
                                        by_mask(n * F.col("toxic")).alias("toxic"))
    return wide.mapInArrow(_orders, _OUT_DDL)


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = 4) -> DataFrame:
    """The whole audit of a Parquet table of documents."""
    return interactions(part_counters(spark, path, labels, batches))
