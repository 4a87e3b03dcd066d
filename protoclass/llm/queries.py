"""Queries of this subpackage, by name."""

from __future__ import annotations

from protoclass.llm.bpe_codec import op12_bpe_codec
from protoclass.llm.chosen_path import op9_chosen_path
from protoclass.llm.embedding_whitening import op13_embedding_whitening
from protoclass.llm.factorization import op5_quality_classifier
from protoclass.llm.html_text import op8_html_text
from protoclass.llm.license_rules import op10_license_scan
from protoclass.llm.merkle_manifest import OP11_SQL, op11_merkle_manifest
from protoclass.llm.quality_rules import op2_quality_rules
from protoclass.llm.secret_scan import op7_secret_scan
from protoclass.llm.source_mix import op3_source_mix
from protoclass.llm.spaced_seeds import OP6_SQL, op6_spaced_seeds
from protoclass.llm.token_files import op1_token_ids
from protoclass.llm.unit_dedup import op4_unit_dedup

QUERIES = {
    "op1_token_ids": op1_token_ids,
    "op2_quality_rules": op2_quality_rules,
    "op3_source_mix": op3_source_mix,
    "op4_unit_dedup": op4_unit_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_spaced_seeds": op6_spaced_seeds,
    "op7_secret_scan": op7_secret_scan,
    "op8_html_text": op8_html_text,
    "op9_chosen_path": op9_chosen_path,
    "op10_license_scan": op10_license_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_bpe_codec": op12_bpe_codec,
    "op13_embedding_whitening": op13_embedding_whitening,
}

#: The others have no plain SQL form; they are tested against brute force.
ORACLE_SQL: dict[str, str] = {
    "op6_spaced_seeds": OP6_SQL,
    "op11_merkle_manifest": OP11_SQL,
}
