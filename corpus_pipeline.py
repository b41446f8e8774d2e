"""Corpus pipeline: language ID, near-dedup, decontamination, secret scans, token ids.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``documents``.

Cases: empty tables pass through every stage; rows with a null text have no language
and go in the first stage; extra columns are kept up to the last stage, which
returns the columns named in ``token_ids``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from fundflow.llm import bpe, decontaminate, language_id, secret_scan, simhash_dedup
from fundflow.llm.common import table, written
from fundflow.llm.registry import tokenizer_path
from fundflow.session import small_batches


def _stage(fn):
    @wraps(fn)
    def run_stage(spark, docs, sf_dir):
        return fn(small_batches(spark), docs, sf_dir)
    return run_stage


@_stage
def identify_language(spark, docs, sf_dir):
    """Rejects documents without a letter or in no learned language, by limits of the model; sets lang."""
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.train(docs.filter(~held_out))
    kept = language_id.learned(docs, model)
    return kept.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


@_stage
def drop_near_copies(spark, docs, sf_dir):
    """One document of each group within two fingerprint bits (3-word shingles) stays."""
    return simhash_dedup.keep_one(docs, shingle=3, max_bits=2)


@_stage
def drop_benchmark_copies(spark, docs, sf_dir):
    """Documents with a window of a benchmark item, re-parameterised ones too, go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_stage
def redact_secrets(spark, docs, sf_dir):
    """Secrets in the texts are replaced by their kind; every document stays."""
    return secret_scan.redact(docs)


@_stage
def token_ids(spark, docs, sf_dir):
    """(doc_id, lang, source, n_chars, n_tokens, token_ids): the encoded corpus."""
    encoded = bpe.encode(docs, tokenizer_path())
    return encoded.select("doc_id", "lang", "source", "n_chars",
                          F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("secret_scan", redact_secrets),
    ("bpe", token_ids),
]

# XXH64 fingerprints, a trained classifier and BPE merges have no SQL form; tests/llm
# checks the rows against a brute-force version instead.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over ``documents``, each written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
