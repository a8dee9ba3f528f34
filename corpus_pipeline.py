"""From raw documents to packed training sequences, in five stages."""

from pyspark.sql import functions as F

from tillmart.llm.catalogue import BYTE_BPE, table
from tillmart.llm.decontamination import drop_contaminated
from tillmart.llm.language_id import keep_identified
from tillmart.llm.near_duplicates import keep_one
from tillmart.llm.packing import pack_documents
from tillmart.llm.quality_classifier import keep_good
from tillmart.workspace import new_folder


def quality(spark, docs, sf_dir):
    """Documents of good quality stay."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language(spark, docs, sf_dir):
    """Documents in a language that can be told stay."""
    return keep_identified(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near copies stays."""
    return keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold no more of the benchmark than the contract allows stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark, docs, sf_dir):
    """The pieces of all documents that are left, in sequences."""
    packed = pack_documents(docs, BYTE_BPE, end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]
#: No SQL says what a fitted classifier, an automaton's parse or a tokenizer give.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages on ``documents``; each result is a written table that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
