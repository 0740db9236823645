"""A corpus pipeline: documents come in, training windows go out.

Every stage but the last returns the columns of its input. Whole rows travel in one struct where
an operator passes them on, so extra columns can't clash with an operator's own.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import mixing, packing, secrets, shingle_join, toxicity
from veilframe.llm.shared import documents, give_back, materialise

ROW = "__row"
#: Ids up to which a list of documents to drop is broadcast; beyond, both sides are shuffled.
BROADCAST_IDS = 200_000
TOKENIZER = "word_bpe_49k.json"
ORACLE_SQL = None


def _with_row(docs: DataFrame, carried: list[str] | None = None) -> DataFrame:
    """What operators look at, and the whole row, or the columns named, as one struct; a table without sources has only the null one."""
    of = F.col("source") if "source" in docs.columns else F.lit(None).cast("string").alias("source")
    rest = [c for c in docs.columns if carried and c not in carried]
    return docs.select("doc_id", "text", of, F.struct(*[F.col(f"`{c}`") for c in carried or docs.columns]).alias(ROW), *rest)


def _rows(carried: DataFrame, docs: DataFrame) -> DataFrame:
    return carried.select(*[F.col(ROW).getField(c).alias(c) for c in docs.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5. Null and empty texts score without evidence and stay; rows are judged each."""
    scored = toxicity.score_texts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    gone = materialise(scored.filter("score >= 0.5").select(F.col("text_hash").alias("__text")), "toxic")
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    return docs.withColumn("__text", toxicity.text_hash()).join(gone, "__text", "left_anti").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the least doc_id, and all that link with nothing.

    Rows that repeat an id are judged each by its own text; of those of one id and component one
    stays, the one whose text, then whose columns but maps hash least. Rows without an id stay.
    """
    linked = shingle_join.link_rows(docs)
    gone = materialise(linked.filter("component_id <> doc_id").select("doc_id").distinct(), "gone")
    kept = docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, "doc_id", "left_anti").select(*docs.columns)
    again = linked.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    again = materialise(again, "again")
    if not (repeated := again.count()):
        return kept
    again = F.broadcast(again) if repeated <= BROADCAST_IDS else again
    ties = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    place = F.xxhash64("text").alias("place")
    rows = _with_row(docs.join(again, "doc_id", "left_semi").select(*docs.columns, F.xxhash64(*ties).alias("__tie")), docs.columns).select("doc_id", "text", ROW, place, "__tie")
    own = shingle_join.fingerprints(rows.select("doc_id", "place", "text").dropDuplicates(["doc_id", "place"]))
    components = linked.join(again, "doc_id", "left_semi").select("doc_id", "fp2", "component", "component_id").distinct()
    own = own.alias("o").join(components.alias("c"), F.expr("o.doc_id = c.doc_id AND o.fp2 <=> c.fp2")).filter("c.component_id = c.doc_id")
    own = materialise(own.select("o.doc_id", "o.place", "c.component"), "own")
    rows = rows.join(F.broadcast(own) if own.count() <= BROADCAST_IDS else own, ["doc_id", "place"])
    first = rows.groupBy("doc_id", "component").agg(F.min_by(ROW, F.struct("place", "__tie")).alias(ROW))
    return kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(_rows(first, docs))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [SECRET] in place of every span found; n_chars follows the text. Null texts stay null; repeated rows are masked each."""
    found = secrets.scan(_with_row(docs), keep=(ROW,))
    text = F.col(ROW).getField("text")
    masked = _rows(found.withColumn(ROW, F.col(ROW).withField("text", secrets.redact(text, F.col("spans")))), docs)
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))).select(*docs.columns)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice. Documents without words are never taken; repeated rows are taken each by itself; without a column source all have the null one."""
    mixed = mixing.mix_sources(_with_row(docs), keep=ROW)
    return _rows(mixed.withColumn("__copy", F.explode("allocation")), docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training window; row tells the copies of a document, and repeated rows, apart."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


def _afresh(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """stage, before which executors give back the memory that the stages before it took: together they would take more than one does."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        give_back(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES = [
    ("toxicity", _afresh(drop_toxic)),
    ("n-gram Jaccard join", _afresh(drop_near_copies)),
    ("secret scans", _afresh(mask_secrets)),
    ("mixing", _afresh(mix_to_weights)),
    ("packing", _afresh(pack_windows)),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each returns is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
