"""Exact duplicates by a stateful stream over digests.

A small table of (digest, length, identifier, locator) is written to the shared
folder and read as a stream. The streaming aggregate keeps one entry for each
digest in a disk-backed (RocksDB) state store, without watermark or expiry: how
many rows had it, and the identifier and locator of the row that stays. The
state is then read back as a table. On hits (digests of several rows) the full
normalised texts are compared with that of the row that stays; should a digest
cover different texts, those rows are grouped anew by their whole text.

Only DataFrame, SQL and streaming operations: no Python runs on the executors.
The aggregate combines on the map side, so a text that fills a third of all rows
sends one row per task. The joins that bring texts or results together have one
row per digest on the other side, so a hot digest can be split by the skew join.

Defined cases: null text counts as empty, and all empty texts are equal. Texts
are equal after deleting white space (space, characters 9 to 13). Of equal texts
the longest original stays, then the smallest identifier (null last), then the
first by locator, so repeated rows leave exactly one. An empty table gives an
empty result. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import FILE, ROW, located, quoted, squeezed, text_of, without_rows
from quarry.operators.staging import Staged, broadcast_if_small, remove, stage
from quarry.session import staging_path

_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # All stores of an executor share this much memory; the rest is on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "48",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "1",
    # Stores of a stream that has ended are closed at the next maintenance.
    "spark.sql.streaming.stateStore.maintenanceInterval": "5s",
    # Else every store, however small, sets aside some MB of disk in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


# A store has a fixed cost in memory; fewer are made for few rows, never more than the
# session's shuffle partitions.
ROWS_PER_STORE = 40_000


def run_state(spark: SparkSession, folder: str, schema, checkpoint: str, rows: int | None = None) -> Staged:
    """Feed the files of ``folder`` that ``checkpoint`` has not seen to the keyed state;
    return the state as a staged table: digest, rows, keep (struct). Call it again after
    files arrived and only those are read. ``rows``: how many are expected in all, for the
    number of stores (fixed for a checkpoint; default: the session's shuffle partitions)."""
    conf = dict(_STATE_CONF)
    if rows is not None:
        most = int(spark.conf.get("spark.sql.shuffle.partitions"))
        conf["spark.sql.shuffle.partitions"] = str(max(1, min(most, -(-rows // ROWS_PER_STORE))))
    stream = (spark.readStream.schema(schema).parquet(folder).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("rows"), F.min("rank").alias("keep")))
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        query = (stream.writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        count, keep = [F.col("value")[f.name] for f in state.schema["value"].dataType.fields]
        return stage(state.select(F.col("key.digest").alias("digest"), count.alias("rows"), keep.alias("keep")),
                     "dedup-groups")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exact_groups(df: DataFrame, text: str = "text", key: str = "doc_id",
                 digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per input row: locator, ``key``, digest, rows (group size), keep (struct with
    the key and locator of the row that stays), kept."""
    spark = df.sparkSession
    src = df if FILE in df.columns else located(df, "dedup-input")
    body = text_of(src, text)
    ranked = src.select(
        F.col(FILE), F.col(ROW), digest(squeezed(body)).alias("digest"),
        F.struct((-F.length(body)).alias("neg_chars"), src[quoted(key)].isNull().alias("no_key"),
                 src[quoted(key)].alias("key"), F.col(FILE).alias("file"), F.col(ROW).alias("row")).alias("rank"))
    keyed = stage(ranked, "dedup-keyed")
    if not keyed.rows():
        return _decide(keyed.df, keyed.df.select(
            "digest", F.lit(0).cast("long").alias("rows"), F.col("rank").alias("keep")), key)
    checkpoint = staging_path(spark, "dedup-state")
    state = run_state(spark, keyed.path, keyed.df.schema, checkpoint, keyed.rows()).df
    remove(spark, checkpoint)  # of this one run; its state is in the staged table

    hits = broadcast_if_small(stage(
        state.where("rows > 1").select("digest", F.col("keep.file").alias("keep_file"),
                                       F.col("keep.row").alias("keep_row")), "dedup-hits"))
    bodies = (src.select(F.col(FILE), F.col(ROW), squeezed(body).alias("norm"))
              .withColumn("digest", digest(F.col("norm"))).join(hits, "digest"))
    stays = (F.col(FILE) == F.col("keep_file")) & (F.col(ROW) == F.col("keep_row"))
    first = bodies.where(stays).select("digest", F.col("norm").alias("kept_norm"))
    # Written as found, without a grouping by digest above the join, which may thus split a hot digest.
    found = stage(bodies.where(~stays).join(first, "digest").where("norm != kept_norm").select("digest"), "dedup-clash")
    if not found.rows():
        found.drop()
        return _decide(keyed.df, state, key)
    clash = found.df.distinct()

    # A digest that covers different texts: its rows are grouped by the texts themselves.
    split = bodies.join(clash, "digest", "left_semi").select(FILE, ROW, "norm")
    mixed = keyed.df.join(split, [FILE, ROW])
    groups = mixed.groupBy("digest", "norm").agg(F.count(F.lit(1)).alias("rows"), F.min("rank").alias("keep"))
    rest = keyed.df.join(clash, "digest", "left_anti")
    apart = mixed.join(groups, ["digest", "norm"]).select(*keyed.df.columns, "rows", "keep")
    return _decide(rest, state, key).unionByName(_outcome(apart, key))


def _decide(keyed: DataFrame, state: DataFrame, key: str) -> DataFrame:
    return _outcome(keyed.join(state, "digest"), key)


def _outcome(joined: DataFrame, key: str) -> DataFrame:
    return joined.select(
        F.col(FILE), F.col(ROW), F.col("rank.key").alias(key), "digest", "rows",
        F.col("keep.key").alias("keep_key"),
        ((F.col(FILE) == F.col("keep.file")) & (F.col(ROW) == F.col("keep.row"))).alias("kept"))


def exact_dedup(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    src = located(df, "dedup-input")
    groups = exact_groups(src, text, key)
    return without_rows(src, groups.where(~F.col("kept")), df.columns)
