"""Queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import embeddings, exact, licenses, lines, mixing, negatives, quality, runs, sentencepiece_fst, sharding, simhash, substrings, topk

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {"op1_simhash": simhash.op1_simhash, "op2_topk": topk.op2_topk, "op3_mixing": mixing.op3_mixing, "op4_lines": lines.op4_lines, "op5_quality": quality.op5_quality, "op6_sharding": sharding.op6_sharding, "op7_substrings": substrings.op7_substrings, "op8_licenses": licenses.op8_licenses, "op9_embeddings": embeddings.op9_embeddings, "op10_sentencepiece": sentencepiece_fst.op10_sentencepiece, "op11_runs": runs.op11_runs, "op12_exact": exact.op12_exact, "op13_negatives": negatives.op13_negatives}


def oracle_sql() -> dict[str, str]:
    return {"op2_topk": topk.OP2_SQL, "op3_mixing": mixing.OP3_SQL, "op12_exact": exact.OP12_SQL, "op13_negatives": negatives.OP13_SQL}
