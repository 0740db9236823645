"""Sharding as a two-pass external shuffle.

Pass one scatters records uniformly into buckets that fit in memory, by seeded hashes of the key.
Pass two brings each bucket together, permutes it by Fisher-Yates and numbers its records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veilframe.llm.shared import documents, materialise

SHARDS = 24
SEED = 29
BUCKET_BYTES = 16 << 20
BUCKET_ROWS = 20_000
#: Often repeated rows up to which the list of them is broadcast; beyond, rows are shuffled to it.
BROADCAST_KEYS = 100_000


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard that draws the highest seeded hash of the key.

    A further shard wins exactly the keys whose hash for it tops all others, so growing moves
    rows only into the new shard. A null key hashes as the seed alone.
    """
    draws = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("draw"), F.lit(i).alias("shard")) for i in range(shards)]
    return F.greatest(*draws).getField("shard") if shards > 1 else F.lit(0)


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text and 8 for the record itself; null text has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def shuffle_into_shards(docs: DataFrame, *, key: str = "doc_id", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Every row of docs with size, shard and slot, its place in the shard's random order from 0.

    docs has the key column and text. The key and the number of shards alone decide the shard (law
    key), so repeated rows meet in one shard and still get slots of their own. Null or empty text
    has size 8. Other columns stay as they are; those named size, shard or slot are replaced. An
    empty table gives an empty result.

    A shard is cut into as many buckets as its own bytes and rows ask for, so that a bucket has at most
    bucket_bytes and bucket_rows in the mean, and if there are more
    than bucket_rows of one key and text, they are dealt over buckets by their order in the input. A bucket is one partition
    of pass two. Its records are put in a fixed order before the seeded Fisher-Yates, so that a repeated
    task gives the same permutation: by key and text, and of rows that tie there by their other columns
    (but maps).
    """
    names = [c for c in docs.columns if c.lower() not in ("size", "shard", "slot")]
    size, text = record_size(F.col("text")).alias("size"), F.col("text")
    same = F.xxhash64(F.lit(seed + 1), F.col(key), text, size).alias("same")
    placed = docs.select(*[F.col(f"`{c}`") for c in names], size, shard_of(F.col(key), shards, seed).alias("shard"), same)
    # one row for each shard
    totals = {r.shard: r for r in placed.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    buckets = [max(1, -(-totals[i].bytes // bucket_bytes), -(-totals[i].rows // bucket_rows)) if i in totals else 1 for i in range(shards)]
    first = [sum(buckets[:i]) for i in range(shards)]
    often = placed.groupBy("same").agg(F.count("*").alias("n")).filter(F.col("n") > bucket_rows)
    often = materialise(often.select("same", F.ceil(F.col("n") * 4 / bucket_rows).alias("pieces")), "often")
    if repeated := often.count():
        placed = placed.withColumn("row", F.monotonically_increasing_id()).join(F.broadcast(often) if repeated <= BROADCAST_KEYS else often, "same", "left")
        placed = placed.withColumn("piece", F.coalesce(F.pmod("row", "pieces"), F.lit(0)))
    else:
        placed = placed.withColumn("piece", F.lit(0).cast("long"))
    of_shard = lambda numbers: F.get(F.array(*[F.lit(x) for x in numbers]), F.col("shard"))
    inner = F.when(F.col("piece") == 0, F.col("same")).otherwise(F.xxhash64("same", "piece"))
    scattered = placed.withColumn("bucket", (of_shard(first) + F.pmod(inner, of_shard(buckets).cast("long"))).cast("int"))
    counts = scattered.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    starts = counts.select("bucket", (F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")).alias("first"))
    # one partition holds one bucket, and shuffle() draws from seed and partition
    record = F.struct(*[F.col(f"`{c}`") for c in names], "size", "shard")
    ties = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name in names and "map<" not in f.dataType.simpleString()]
    order = F.struct(F.xxhash64(F.lit(seed + 2), F.col(key), F.col("text")).alias("draw"), F.xxhash64(*ties).alias("tie"), record.alias("record"))
    # a bucket's first slot travels as one more row of it, so that no join moves the records again
    rows = scattered.select("bucket", order.alias("entry"), F.lit(None).cast("long").alias("first"))
    heads = starts.select("bucket", F.lit(None).cast(rows.schema["entry"].dataType).alias("entry"), "first")
    gathered = rows.unionByName(heads).repartitionById(sum(buckets), F.col("bucket")).groupBy("bucket").agg(F.collect_list("entry").alias("entries"), F.max("first").alias("first"))
    rank = lambda a, b: F.when(a.draw < b.draw, -1).when(a.draw > b.draw, 1).when(a.tie < b.tie, -1).when(a.tie > b.tie, 1).otherwise(0)
    permuted = gathered.select("first", F.posexplode(F.shuffle(F.array_sort("entries", rank), F.lit(seed))).alias("pos", "drawn"))
    out = permuted.withColumn("slot", F.col("first") + F.col("pos"))
    return out.select(*[F.col("drawn.record").getField(c).alias(c) for c in [*names, "size", "shard"]], "slot")


def op7_shuffle_shards(spark, sf_dir):
    """shuffle_into_shards() of documents by doc_id, law key; grown_shard is the shard with one more of them. A null text has the checksum of the empty one."""
    cut = shuffle_into_shards(documents(spark, sf_dir).select("doc_id", "text"))
    checksum = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return cut.select(
        "doc_id", "size", checksum.alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", shard_of(F.col("doc_id"), SHARDS + 1).alias("grown_shard")
    )
