"""The queries of this subpackage and their SQL, for __spark_entry__.py."""

from . import chat, dedup, divergence, iblt, jaccard, katz, mixing, packing, pii, quality, repair, secrets, warc

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op2_warc_convert": warc.op2_warc_convert,
    "op3_exact_dedup": dedup.op3_exact_dedup,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_pii_pseudonyms": pii.op7_pii_pseudonyms,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_iblt_fingerprints": iblt.op10_iblt_fingerprints,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_katz_scores": katz.op12_katz_scores,
    "op13_periodic_runs": repair.op13_periodic_runs,
}

SQL = {
    "op1_chat_format": chat.OP1_SQL,
    "op2_warc_convert": warc.OP2_SQL,
    "op3_exact_dedup": dedup.OP3_SQL,
    "op8_mix_sources": mixing.OP8_SQL,
    "op11_source_divergence": divergence.OP11_SQL,
}
