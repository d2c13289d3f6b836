"""The queries of this package, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from .embedding_dup import op9_collision_counting
from .hmm_lm import op7_hmm_lm
from .host_rules import OP8_SQL, op8_host_rules
from .language_id import op1_language_id
from .license_scan import OP6_SQL, op6_license_scan
from .near_dup import op5_dart_minhash
from .packing import op10_best_fit_packing
from .piece_codec import op4_piece_codec
from .prefix_trie import OP11_SQL, op11_prefix_trie
from .pseudonyms import op2_feistel_pseudonyms
from .quality_rules_model import op3_rule_ensemble
from .token_alignment import op13_token_alignment
from .toxicity import op12_toxicity

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_feistel_pseudonyms": op2_feistel_pseudonyms,
    "op3_rule_ensemble": op3_rule_ensemble,
    "op4_piece_codec": op4_piece_codec,
    "op5_dart_minhash": op5_dart_minhash,
    "op6_license_scan": op6_license_scan,
    "op7_hmm_lm": op7_hmm_lm,
    "op8_host_rules": op8_host_rules,
    "op9_collision_counting": op9_collision_counting,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op6_license_scan": OP6_SQL,
    "op8_host_rules": OP8_SQL,
    "op11_prefix_trie": OP11_SQL,
}
