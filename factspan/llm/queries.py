"""The training-data queries: name -> (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from factspan.llm import chat, decontaminate, embeddings, extract, licences, mixing, pii, quality, runs, sharding, simhash, toxicity, trie
from factspan.llm.common import table


def _over(name, operator):
    return lambda spark, sf_dir: operator(table(spark, sf_dir, name))


def queries():
    return {
        "op1_chat_format": _over("conversations", chat.op1),
        "op2_pii": _over("documents", pii.op2),
        "op3_simhash_near_dups": _over("documents", simhash.op3),
        "op4_mix_sources": _over("documents", mixing.op4),
        "op5_embedding_near_dups": _over("embeddings", embeddings.op5),
        "op6_ring_shards": _over("documents", sharding.op6),
        "op7_html_text": _over("pages", extract.op7),
        "op8_quality": lambda spark, sf_dir: quality.op8(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op9_decontaminate": lambda spark, sf_dir: decontaminate.op9(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
        "op10_toxicity": lambda spark, sf_dir: toxicity.op10(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
        "op11_periodic_runs": _over("documents", runs.op11),
        "op12_licence_scan": _over("documents", licences.op12),
        "op13_prefix_trie": _over("conversations", trie.op13),
    }


def oracle_sql():
    return {"op1_chat_format": chat.ORACLE, "op5_embedding_near_dups": embeddings.ORACLE, "op9_decontaminate": decontaminate.ORACLE, "op11_periodic_runs": runs.ORACLE, "op12_licence_scan": licences.ORACLE, "op13_prefix_trie": trie.ORACLE}
