"""Audit of how filters interact, by incremental retraction over a stream of files.

The table is read as a stream: available-now micro-batches of whole files.  What a filter
order does to a part follows from one small relation, the part counters: how many documents
of a part fail exactly which set of filters (a mask).  Four filters look at one text; the
fifth, "identical to the text of a smaller id", looks at the whole table, so it is not final
when a batch is counted:

* a task first collapses its rows per text: rows above the smallest id it has seen of a text
  are duplicates for certain and leave as counts, the rest leaves as one candidate;
* state keyed by text (a 128-bit prefix of SHA-256 of the whole text) remembers the smallest
  id so far and which rows carry it.  A candidate above it is a duplicate; a smaller one
  becomes the minimum, and the mask counted for the earlier one is retracted: minus one
  without the duplicate bit, plus one with it.  Some ``TEXTS`` texts share a state row, as a
  call into Python per text would cost more than all else;
* each micro-batch adds its signed counts to the part counters, one folder per batch, written
  in overwrite mode, so a batch replayed after a failure replaces its own counts.

The report is computed from the summed counters: every filter order, every step.
"""

from __future__ import annotations

import pickle
import zlib
from collections import defaultdict
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from .common import let, scratch, stored

WORD_SPACE = r"[\x20\x09-\x0D]+"
LETTERS = "ABCDE"
#: The bit of the filter that needs the state.
DUPLICATE = 1 << 4
#: Parquet bytes of a micro-batch for each core of the cluster.
BYTES_PER_CORE = 32 << 20
#: Texts that share a state row, on average.
TEXTS = 256

ROW = "slot long, text_key binary, part string, mask int, good boolean, toxic boolean, doc_id long, is_dup boolean, n long"
DELTA = "part string, mask int, good boolean, toxic boolean, n long"
STATE = "texts binary"


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at one text: A short, B repetitive, C capitals, D symbols."""
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))

    def bits(*fails: Column) -> Column:
        return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0)).cast("int")

    words = F.filter(F.split(text, WORD_SPACE), lambda w: w != "")
    return let(words, lambda w: let(F.size(w), lambda n: bits(
        n < 50, 100 * F.size(F.array_distinct(w)) < 65 * n, 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]"))))


def _collapse(slots: int):
    names = [x.split()[0] for x in ROW.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]

    def run(batches):
        """One Arrow batch at a time: candidates (smallest id of a text, null ids), and counts of
        certain duplicates, which need no text any more and are dealt by what they count."""
        for b in batches:
            if not b.num_rows:
                continue
            least: dict = {}
            rows = list(zip(*[b.column(i).to_pylist() for i in range(6)]))
            for key, _, _, _, _, doc in rows:
                if doc is not None and (key not in least or doc < least[key]):
                    least[key] = doc
            counts: dict = defaultdict(int)
            for key, part, mask, good, toxic, doc in rows:
                if doc is None or doc > least[key]:
                    what = (part, mask, good, toxic)
                    counts[zlib.crc32(repr(what).encode()) % slots, None, *what, 0, doc is not None] += 1  # never a null id: pandas would make floats of all
                else:
                    counts[int.from_bytes(key[8:16], "big") % slots, key, part, mask, good, toxic, doc, False] += 1
            cols = list(zip(*counts))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(cols, kinds)], pa.array(counts.values(), pa.int64())], names=names)
    return run


def _track(key, frames, state):
    """State of the texts of one slot: text -> (smallest id, rows that carry it).  Returns signed
    counts by (part, mask, good, toxic)."""
    texts: dict = pickle.loads(state.get[0]) if state.exists else {}
    delta: dict = defaultdict(int)
    changed = False
    for frame in frames:
        for text, part, mask, good, toxic, doc, dup, n in zip(*[frame[c].tolist() for c in frame.columns[1:]]):
            k = (part, mask, good, toxic)
            late = (part, mask | DUPLICATE, good, toxic)
            if text is None:  # certain duplicates, and rows without an id
                delta[late if dup else k] += n
                continue
            least, carry = texts.get(text, (None, {}))
            if least is not None and doc > least:
                delta[late] += n
                continue
            if least is not None and doc < least:
                for (p, m, g, t), c in carry.items():  # retract what was counted for the earlier minimum
                    delta[p, m, g, t] -= c
                    delta[p, m | DUPLICATE, g, t] += c
                carry = {}
            texts[text] = (doc, {**carry, k: carry.get(k, 0) + n})
            delta[k] += n
            changed = True
    if changed:
        state.update((pickle.dumps(texts, protocol=5),))
    yield pd.DataFrame([(*k, n) for k, n in delta.items() if n], columns=["part", "mask", "good", "toxic", "n"])


def part_counters(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  part_col: str = "source", batch_bytes: int | None = None) -> DataFrame:
    """Run the stream over every file below ``path`` to its end: part, mask, good, toxic, n.

    ``labels``: doc_id, quality, toxic; of repeated ids any 1 counts.  The stream has a session
    of its own (state in RocksDB, which spills to disk; a commit ships the changes only), and
    its ledger and counters lie in the shared folder.
    """
    own = spark.newSession()
    for k in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.files.maxPartitionBytes"):
        if (v := spark.conf.get(k, None)) is not None:
            own.conf.set(k, v)
    own.conf.set("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else some MB a store up front
    marks = stored(labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")), "marks")
    marks = own.read.schema(marks.schema).parquet(*marks.inputFiles()) if marks.inputFiles() else own.createDataFrame([], marks.schema)
    schema = spark.read.parquet(path).schema
    size = batch_bytes or BYTES_PER_CORE * spark.sparkContext.defaultParallelism
    path = path.rstrip("/")
    # as a pattern that names only itself: the file source takes a plain path for a folder
    files = own.readStream.schema(schema).option("maxBytesPerTrigger", size).parquet(f"{path[:-1]}[{path[-1]}]")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = files.select(F.unhex(F.left(F.sha2(text.cast("binary"), 256), F.lit(32))).alias("text_key"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        text_mask(text).alias("mask"), F.col(id_col).cast("long").alias("doc_id"))
    rows = rows.join(marks, rows["doc_id"] == marks["_id"], "left").select(
        "text_key", "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), "doc_id")
    slots = spark.read.parquet(path).count() // TEXTS + 1  # from the file footers
    signed = rows.mapInArrow(_collapse(slots), ROW).groupBy("slot").applyInPandasWithState(
        _track, DELTA, STATE, "append", GroupStateTimeout.NoTimeout)
    out = scratch(spark, "part-counters")

    def add(batch: DataFrame, epoch: int) -> None:
        batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

    run = signed.writeStream.foreachBatch(add).option("checkpointLocation", f"{out}-ledger").trigger(availableNow=True).start()
    run.awaitTermination()
    spark.createDataFrame([], DELTA).write.mode("append").parquet(f"{out}/batch=-1")  # an empty table has no batch
    return spark.read.schema(DELTA).parquet(out).groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).filter("n != 0")


def report(counters: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order of the filters and every step of it for every part, from part counters."""
    orders = ["".join(p) for p in permutations(letters)]
    bit = {x: 1 << i for i, x in enumerate(letters)}
    # what the steps need of a part: documents per mask, and how many of them are good or toxic
    masks = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(F.lit(0))).alias("g"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(F.lit(0))).alias("t"))
    per = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "g", "t")).alias("ms"))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s + 1).alias("step"), F.lit(bit[o[s]]).alias("own"),
                               F.lit(sum(bit[x] for x in o[:s])).alias("earlier")) for o in orders for s in range(len(letters))])
    rows = per.select("part", "ms", F.explode(steps).alias("x")).select("part", "ms", "x.*")

    def total(cond, what: str = "n") -> Column:
        one = lambda m: F.when(cond(m), m[what]).otherwise(F.lit(0).cast("long"))
        return F.aggregate(F.transform("ms", one), F.lit(0).cast("long"), lambda a, x: a + x)

    own, earlier = F.col("own"), F.col("earlier")
    hit = lambda m, b: m["mask"].bitwiseAND(b) != 0
    removed = lambda m: hit(m, own) & ~hit(m, earlier)
    # a document that fails k filters is removed by each of them in orders / k of the orders
    per_filter = F.array(*[F.lit(len(orders) // k).cast("long") for k in range(1, len(letters) + 1)])
    share = lambda m: F.when(hit(m, own), m["n"] * F.element_at(per_filter, F.bit_count(m["mask"]).cast("int"))).otherwise(F.lit(0).cast("long"))
    return rows.select(
        "part", "filter_order", "step",
        total(lambda m: ~hit(m, own.bitwiseOR(earlier))).alias("kept"), total(removed).alias("removed"),
        total(lambda m: hit(m, own) & hit(m, earlier)).alias("redundant"),
        total(lambda m: m["mask"] == own).alias("unique_fails"),
        total(removed, "g").alias("good_lost"), total(removed, "t").alias("toxic_lost"),
        F.aggregate(F.transform("ms", share), F.lit(0).cast("long"), lambda a, x: a + x).alias("shapley"))


def interaction_audit(spark: SparkSession, path: str, labels: DataFrame, batch_bytes: int | None = None, **columns) -> DataFrame:
    """One row per part, filter order and step: part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley.

    Filters: A under 50 words; B fewer distinct than 65 % of the words; C more than 5 %
    capitals; D holds one of ``#$%&*|``; E identical to the text of a smaller id, removed or
    not.  A null text counts as empty, a null part as ''.  A null id is not smaller than any
    other and has none below it, so E passes it; rows that share the smallest id of a text all
    pass E.  Repeated rows count each; documents without labels are neither good nor toxic;
    other columns are ignored; an empty table gives an empty result.  Very long texts are one
    row like any other: state and shuffles hold their digest.
    """
    return report(part_counters(spark, path, labels, batch_bytes=batch_bytes, **columns))
