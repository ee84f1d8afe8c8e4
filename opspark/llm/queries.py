"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from opspark.llm import decontaminate, embeddings, html_labeller, kmeans_tree, lines, mixing, ngram_join, runs, sharding, spelling, tokens, toxicity, warc

QUERIES = {
    "op1_whole_token_counts": tokens.op1_whole_token_counts,
    "op2_fuzzy_lines": lines.op2_fuzzy_lines,
    "op3_consistent_ring": sharding.op3_consistent_ring,
    "op4_cross_polytope": embeddings.op4_cross_polytope,
    "op5_block_labeller": html_labeller.op5_block_labeller,
    "op6_curriculum": mixing.op6_curriculum,
    "op7_revisits": warc.op7_revisits,
    "op8_simhash_windows": decontaminate.op8_simhash_windows,
    "op9_rare_first_join": ngram_join.op9_rare_first_join,
    "op10_pu_toxicity": toxicity.op10_pu_toxicity,
    "op11_periodic_runs": runs.op11_periodic_runs,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_kmeans_tree": kmeans_tree.op13_kmeans_tree,
}

ORACLES = {
    "op4_cross_polytope": embeddings.OP4_SQL,
    "op6_curriculum": mixing.OP6_SQL,
    "op7_revisits": warc.OP7_SQL,
    "op9_rare_first_join": ngram_join.OP9_SQL,
}
