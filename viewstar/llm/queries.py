"""The registered queries of the operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from viewstar.llm import circulant_minhash, containment, drift_clusters, fertility, fill_in_middle, licences, mixing, pitman_yor, rank_order, repair, stable_projections, toxicity, warc

QUERIES = {
    "op1_repair_tokens": repair.op1,
    "op2_rank_order_language": rank_order.op2,
    "op3_stable_projections": stable_projections.op3,
    "op4_containment_decontamination": containment.op4,
    "op5_hierarchical_mixing": mixing.op5,
    "op6_pitman_yor": pitman_yor.op6,
    "op7_licence_scan": licences.op7,
    "op8_circulant_minhash": circulant_minhash.op8,
    "op9_warc_capture_index": warc.op9,
    "op10_toxicity": toxicity.op10,
    "op11_wavelet_fim": fill_in_middle.op11,
    "op12_tokenizer_fertility": fertility.op12,
    "op13_drift_clusters": drift_clusters.op13,
}

ORACLE = {
    "op4_containment_decontamination": containment.ORACLE,
    "op5_hierarchical_mixing": mixing.ORACLE,
    "op8_circulant_minhash": circulant_minhash.ORACLE,
    "op9_warc_capture_index": warc.ORACLE,
    "op11_wavelet_fim": fill_in_middle.ORACLE,
    "op13_drift_clusters": drift_clusters.ORACLE,
}
