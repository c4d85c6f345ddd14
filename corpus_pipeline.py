"""A corpus pipeline: toxic documents go, near copies and benchmark leaks go, personal data is masked, and
what is left is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows to the shared
folder and gives them to the next.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semlayer.llm.components import written
from semlayer.llm.decontamination import contamination
from semlayer.llm.exchange import given_back, text_slices
from semlayer.llm.kneser_ney import score_toxicity, train
from semlayer.llm.ngram_jaccard import near_duplicates
from semlayer.llm.packing import packed
from semlayer.llm.pii import masked, row_spans
from semlayer.llm.queries import labelled, tokenizer_path


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a code of doc_id and text in place of doc_id, so that operators decide about rows."""
    return docs.withColumn("doc_id", _key())


def _key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("string"), F.lit("/"), F.col("text").cast("string"))


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the documents do not have."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key is among the doc_id of keys."""
    kept = _fresh(docs, "kept")
    keep = keys.select(F.col("doc_id").alias(kept)).distinct()
    return docs.join(keep, _key() == F.col(kept), "left_semi")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models of operator 9 do not reject."""
    model = train(labelled(spark, docs, sf_dir))
    return _only(docs, score_toxicity(_keyed(docs), model).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row of the smallest doc_id of each group of operator 3 (rows without one last); repeated rows go too.

    A group has one row left, whatever ids its rows have or share.  Rows without words are in no
    group: of those only repeated ones with a doc_id go.
    """
    ids = docs.select(F.col("doc_id").alias("id"), _key().alias("key")).distinct()
    near = near_duplicates(_keyed(docs)).select("doc_id", "component_id").distinct()
    order = F.struct(F.col("id").isNull().alias("last"), "id", "key")
    first = near.join(ids, F.col("doc_id") == F.col("key")).groupBy("component_id").agg(F.min(order).alias("first"))
    kept = _only(docs, first.select(F.col("first.key").alias("doc_id")))
    worded = F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    grouped = F.col("doc_id").isNotNull() | worded
    return kept.where(grouped).dropDuplicates(["doc_id", "text"]).union(kept.where(~grouped))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item (operator 8)."""
    found = contamination(_keyed(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _only(docs, found.where("not contaminated"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the spans of operator 1 replaced by <kind>; n_chars follows the new text.

    Spans belong to a doc_id and its text, so rows without an id, or of one id, keep to their own.
    """
    found, code, spans = (_fresh(docs, name) for name in ("found", "code", "spans"))
    rows = row_spans(docs).where("spans <> ''").select(F.col("doc_id").alias(found), F.col("row").alias(code), F.col("spans").alias(spans))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(found)) & (F.xxhash64(F.col("text").cast("string")) == F.col(code))
    both = docs.join(rows.distinct(), same, "left").select(*docs.columns, spans)

    def run(batches):
        for batch in (part for whole in batches for part in text_slices(whole)):
            pairs = zip(batch["text"].to_pylist(), batch[spans].to_pylist())
            texts = [t if t is None or not s else masked(t, s) for t, s in pairs]
            columns = {c: batch[c] for c in batch.schema.names if c != spans} | {"text": pa.array(texts, pa.string())}
            yield pa.record_batch(columns)

    return both.mapInArrow(given_back(run), docs.schema).withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4,096 tokens (operator 5)."""
    return packed(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("packing", pack),
]

#: Trained models, discovered patterns and tokenizer ids are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
