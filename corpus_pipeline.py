"""Corpus pipeline: quality rules, SimHash near-dedup, secret masking, mixing, SentencePiece ids.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from retentio.llm import poisson_mix, quality_crf, secret_links, simhash_ring, spm_wfst
from retentio.llm.common import read_table
from retentio.llm.queries import tokenizer_path
from retentio.session import written_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the line labels reject."""
    return quality_crf.keep_good(docs, quality_crf.fit(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each SimHash class."""
    return simhash_ring.deduplicate(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every reported secret span."""
    return secret_links.redact_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents towards the target weights of their sources, globally shuffled."""
    own = [poisson_mix.free_name(docs, c) for c in ("copy_no", "mix_key")]
    return poisson_mix.mix(docs, copy_no=own[0], mix_key=own[1]).select(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every copy."""
    return spm_wfst.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("mixing", mixing),
    ("sentencepiece", pieces),
]

#: SQL can't express the line labelling, the components or the tokenizer; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each result is written and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written_table(docs)
    return docs
