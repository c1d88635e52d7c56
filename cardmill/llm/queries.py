"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from cardmill.llm import chat, decontaminate, divergence, lines, minhash, negatives, packing, pieces, quality, sharding, substrings, toxicity, vectors

QUERIES = {
    "op1_lines": lines.op1_lines,
    "op2_vectors": vectors.op2_vectors,
    "op3_pieces": pieces.op3_pieces,
    "op4_substrings": substrings.op4_substrings,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_sharding": sharding.op6_sharding,
    "op7_minhash": minhash.op7_minhash,
    "op8_chat": chat.op8_chat,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_quality": quality.op10_quality,
    "op11_negatives": negatives.op11_negatives,
    "op12_divergence": divergence.op12_divergence,
    "op13_packing": packing.op13_packing,
}

ORACLES = {
    "op1_lines": lines.SQL,
    "op2_vectors": vectors.SQL,
    "op4_substrings": substrings.SQL,
    "op7_minhash": minhash.SQL,
    "op11_negatives": negatives.SQL,
    "op12_divergence": divergence.SQL,
}
