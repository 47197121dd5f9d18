"""Queries of this subpackage and the SQL that gives the same rows, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, importance, lines, mixing, pii, search, secrets, sigtree, tokens, toxicity, vectors, warc, winnow


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": lines.op1_line_dedup,
        "op2_mix": mixing.op2_mix,
        "op3_embed_dedup": vectors.op3_embed_dedup,
        "op4_pii": pii.op4_pii,
        "op5_tokens": tokens.op5_tokens,
        "op6_decontam": decontam.op6_decontam,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_secrets": secrets.op8_secrets,
        "op9_ngram_join": sigtree.op9_ngram_join,
        "op10_warc": warc.op10_warc,
        "op11_importance": importance.op11_importance,
        "op12_search": search.op12_search,
        "op13_fingerprints": winnow.op13_fingerprints,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": lines.OP1_SQL, "op2_mix": mixing.OP2_SQL, "op3_embed_dedup": vectors.OP3_SQL, "op6_decontam": decontam.OP6_SQL, "op9_ngram_join": sigtree.OP9_SQL, "op10_warc": warc.OP10_SQL, "op11_importance": importance.OP11_SQL, "op12_search": search.OP12_SQL}
