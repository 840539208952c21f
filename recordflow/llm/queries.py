"""Queries over the operators of this package, and the SQL of those that SQL can express."""

from recordflow.llm import bpe, langid, mixing, periodic, quality, recompress, simhash, sketch, spelling, suffixes, tokencounts, toxicity, warc

QUERIES = {
    "op1_mix_curriculum": mixing.op1_mix_curriculum,
    "op2_toxicity_mil": toxicity.op2_toxicity_mil,
    "op3_byte_bpe": bpe.op3_byte_bpe,
    "op4_language_fusion": langid.op4_language_fusion,
    "op5_quality_cascade": quality.op5_quality_cascade,
    "op6_warc_segments": warc.op6_warc_segments,
    "op7_bottomk_fingerprint": sketch.op7_bottomk_fingerprint,
    "op8_recompression": recompress.op8_recompression,
    "op9_simhash_bktree": simhash.op9_simhash_bktree,
    "op10_suffix_intervals": suffixes.op10_suffix_intervals,
    "op11_token_counts": tokencounts.op11_token_counts,
    "op12_spelling_variants": spelling.op12_spelling_variants,
    "op13_periodic_runs": periodic.op13_periodic_runs,
}

ORACLE = {
    "op1_mix_curriculum": mixing.OP1_SQL,
    "op5_quality_cascade": quality.OP5_SQL,
}
