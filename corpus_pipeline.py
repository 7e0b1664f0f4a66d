"""From raw documents to token files: each stage works on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read back as the
next stage's ``docs``; all but the last return the columns of ``documents``. The functions and their
defined cases are those of the operators in ``orderpulse.llm``.
"""

from __future__ import annotations

from orderpulse.llm import decontam, mixing, quality, simhash, tokens
from orderpulse.llm.common import read_table, stored
from orderpulse.llm.queries import END_ID, QUALITY_THRESHOLD, tokenizer_path


def keep_good(spark, docs, sf_dir):
    """Quality classifier: documents that it rejects go."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), QUALITY_THRESHOLD)


def drop_copies(spark, docs, sf_dir):
    """SimHash near-duplicates: one document of each group stays."""
    return simhash.keep_one(docs)


def drop_benchmark(spark, docs, sf_dir):
    """Benchmark decontamination: documents that hold a window of an item go."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Mixing sources to target weights: each document as often as it is taken."""
    return mixing.emit(mixing.mix(docs))


def write_tokens(spark, docs, sf_dir):
    """Token files with a keyed index; every document is read back from them."""
    _, _, found = tokens.token_output(docs, tokenizer_path(), END_ID)
    return found.select("doc_id", "occurrence", "start", "n_tokens", "ids_crc32")


STAGES = [("quality classifier", keep_good), ("SimHash near-dedup", drop_copies),
          ("benchmark decontamination", drop_benchmark), ("mixing sources to target weights", mix_sources),
          ("token-ID / binary output", write_tokens)]
#: A classifier, fingerprints and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
