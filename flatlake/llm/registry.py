"""Queries over the driver's tables and their DuckDB SQL, one per operator."""

from __future__ import annotations

from . import alignment, automaton_dedup, bpe_stream, chat_windows, decontaminate, importance, licenses, line_dedup, minhash_bayes, mixing, pu_classifier, quality_rules, suffix_dedup

QUERIES = {
    "op1_suffix_array_dedup": suffix_dedup.op1_suffix_array_dedup,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_temperature_mix": mixing.op3_temperature_mix,
    "op4_licence_sentences": licenses.op4_licence_sentences,
    "op5_suffix_automaton_dedup": automaton_dedup.op5_suffix_automaton_dedup,
    "op6_chat_windows": chat_windows.op6_chat_windows,
    "op7_line_minhash": line_dedup.op7_line_minhash,
    "op8_minhash_bayes": minhash_bayes.op8_minhash_bayes,
    "op9_certified_rules": quality_rules.op9_certified_rules,
    "op10_pu_quality": pu_classifier.op10_pu_quality,
    "op11_importance_resampling": importance.op11_importance_resampling,
    "op12_tokenizer_alignment": alignment.op12_tokenizer_alignment,
    "op13_bpe_stream": bpe_stream.op13_bpe_stream,
}

SQL: dict[str, str] = {**licenses.SQL, **importance.SQL}
