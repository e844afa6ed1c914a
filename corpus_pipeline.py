"""Corpus pipeline over the documents table: its stages are in siltlake.llm.pipeline.

STAGES lists (name, function); run(spark, sf_dir) applies them to documents; ORACLE_SQL is None, as SQL
cannot express trained models, fingerprints and packing.
"""

from siltlake.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
