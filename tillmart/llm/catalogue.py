"""The operators as queries over the given tables, and their SQL where it can say the same."""

import public_tokenizers
from pyspark.sql import functions as F

from tillmart.llm import (
    alignment,
    binary_output,
    collocations,
    decontamination,
    host_trust,
    language_id,
    licenses,
    near_duplicates,
    packing,
    preferences,
    quality_classifier,
    quality_rules,
    vector_search,
)
from tillmart.llm.oracle import ORACLE
from tillmart.workspace import new_folder

__all__ = ["BYTE_BPE", "ORACLE", "PIECES", "QUERIES", "table"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark, sf_dir):
    """The quality of all documents, from their text and their site."""
    return quality_classifier.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark, sf_dir):
    """All documents against all passages of the benchmark."""
    found = decontamination.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontamination.judge_passages(found).drop("n_near")


def op3_token_shards(spark, sf_dir):
    """All documents encoded, written as indexed shards and read back."""
    folder = new_folder(spark, "token-shards")
    binary_output.write_token_shards(table(spark, sf_dir, "documents"), folder, BYTE_BPE, end_id=2)
    return binary_output.read_digests(spark, folder)


def op4_url_trust(spark, sf_dir):
    """All pages judged by rules and by what reaches their hosts."""
    return host_trust.judge_urls(table(spark, sf_dir, "pages")).drop("trust", "distrust")


def op5_licenses(spark, sf_dir):
    """Licences of all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("expressions")


def op6_quality_rules(spark, sf_dir):
    """All documents by rules whose cutoffs the labels certify."""
    return quality_rules.judge_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_preferences(spark, sf_dir):
    """All conversations, each preferred to itself with the last reply cut short."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    pairs = turns.select("conv_id").distinct().select(
        F.col("conv_id").alias("pair_id"), F.col("conv_id").alias("chosen_id"), (-1 - F.col("conv_id")).alias("rejected_id"))
    formatted = preferences.format_preferences(turns.unionByName(preferences.cut_short(turns)), pairs)
    listed = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    return formatted.select("pair_id", "piece", "n_prompt", "prompt", "chosen", listed("chosen_mask"), "rejected", listed("rejected_mask"))


def op8_language(spark, sf_dir):
    """The language of all documents."""
    return language_id.predict_languages(table(spark, sf_dir, "documents"))


def op9_simhash(spark, sf_dir):
    """Near-duplicate components of all documents."""
    return near_duplicates.simhash_components(table(spark, sf_dir, "documents"))


def op10_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_top_k(spark, sf_dir):
    """The ten best other vectors of every hundredth one, of all embeddings."""
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op12_alignment(spark, sf_dir):
    """Tokens of two vocabularies over all documents."""
    return alignment.align_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)


def op13_collocations(spark, sf_dir):
    """The 2000 best phrases of each language of all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_token_shards": op3_token_shards,
    "op4_url_trust": op4_url_trust,
    "op5_licenses": op5_licenses,
    "op6_quality_rules": op6_quality_rules,
    "op7_preferences": op7_preferences,
    "op8_language": op8_language,
    "op9_simhash": op9_simhash,
    "op10_packing": op10_packing,
    "op11_top_k": op11_top_k,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}
