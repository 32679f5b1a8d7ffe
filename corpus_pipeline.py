"""From raw documents to training shards, stage by stage.

Each stage reads what the one before wrote (Parquet in the shared folder),
so a lost executor or a restart costs one stage at most.
"""

from __future__ import annotations

from labelqa.llm import decontaminate, mixing, quality_rules, simhash_dedup, token_output
from labelqa.llm.common import documents, ready, store


def quality_stage(spark, docs, sf_dir):
    ready(spark)
    return quality_rules.kept_documents(docs)


def near_duplicate_stage(spark, docs, sf_dir):
    ready(spark)
    return simhash_dedup.one_of_each(docs, shingle=3, radius=2)


def decontamination_stage(spark, docs, sf_dir):
    return decontaminate.clean_documents(docs, documents(ready(spark), sf_dir, "benchmark"))


def mixing_stage(spark, docs, sf_dir):
    ready(spark)
    return mixing.sampled_documents(docs)


def token_stage(spark, docs, sf_dir):
    ready(spark)
    return token_output.training_order(docs)


STAGES = [("quality_rules", quality_stage), ("simhash_dedup", near_duplicate_stage), ("decontaminate", decontamination_stage),
          ("mixing", mixing_stage), ("token_output", token_stage)]

#: Hashes of word shingles and a tokenizer have no DuckDB counterpart.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(ready(spark), sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
