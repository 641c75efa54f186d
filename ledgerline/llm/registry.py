"""Queries of the training-data operators and the SQL of those that SQL can express."""

from ledgerline.llm import (decontaminate, dual_tree, kdtree, line_dedup, mixing, periodic_runs, pseudonyms, quality, sharding,
                            simhash_dedup, superminhash, toxicity, warc)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_warc": warc.op2_warc,
    "op3_kdtree_topk": kdtree.op3_kdtree_topk,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_simhash_dedup": simhash_dedup.op6_simhash_dedup,
    "op7_quality": quality.op7_quality,
    "op8_pseudonyms": pseudonyms.op8_pseudonyms,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_shard": sharding.op10_shard,
    "op11_superminhash": superminhash.op11_superminhash,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_dual_tree": dual_tree.op13_dual_tree,
}

SQL = {
    "op3_kdtree_topk": kdtree.OP3_SQL,
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op5_mix_sources": mixing.OP5_SQL,
    "op11_superminhash": superminhash.OP11_SQL,
    "op12_periodic_runs": periodic_runs.OP12_SQL,
    "op13_dual_tree": dual_tree.OP13_SQL,
}
