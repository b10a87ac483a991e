"""A training corpus from raw documents: filter, deduplicate, scrub, mix, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brightledger.llm import mixing, packing, pii, quality, simhash
from brightledger.llm.common import read
from brightledger.session import materialise

STAGES = [
    ("quality", quality.stage),
    ("near_duplicates", simhash.stage),
    ("personal_data", pii.stage),
    ("mix", mixing.stage),
    ("pack", packing.stage),
]

#: Fingerprints, surrogates and tokens can't be expressed in SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written under the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
