"""Corpus pipeline: quality rules, near-duplicate join, repeated strings, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents that its predecessor
kept; all but the last return the columns of ``documents``. Between stages the documents are
written as Parquet in the shared folder and read again, which cuts lineage, so a lost
executor costs at most one stage. Then the scratch tables of the stage and the documents it
read, which nothing reads any more, are deleted.
"""

from __future__ import annotations

from lapstats.llm import ngramjoin, packing, pii, quality, suffixdedup
from lapstats.llm.common import discard, staged

STAGES = [
    ("quality_rules", quality.clean),
    ("ngram_jaccard_join", ngramjoin.stage),
    ("suffix_array_dedup", suffixdedup.stage),
    ("pii", pii.stage),
    ("best_fit_packing", packing.stage),
]

#: SQL has no tokenizer and no keyed permutation; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = staged(spark, name, lambda: stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
