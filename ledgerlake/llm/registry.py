"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from .byte_bpe import op6_byte_bpe
from .exact_dedup import OP5_SQL, op5_exact_dedup
from .harmonic import op13_harmonic_packing
from .line_dedup import op1_fuzzy_lines
from .packing import op4_packing
from .periodic_runs import op11_periodic_runs
from .quality_oracle import quality_sql
from .quality_rules import op8_quality_rules
from .secret_scan import op3_secret_scan
from .sharding import op7_sharding
from .simhash import op10_simhash
from .spelling import op12_spelling_variants
from .suffix_dedup import op9_suffix_dedup
from .token_store import op2_token_store

QUERIES = {
    "op1_fuzzy_lines": op1_fuzzy_lines,
    "op2_token_store": op2_token_store,
    "op3_secret_scan": op3_secret_scan,
    "op4_packing": op4_packing,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_sharding": op7_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_harmonic_packing": op13_harmonic_packing,
}

ORACLE_SQL: dict[str, str] = {"op5_exact_dedup": OP5_SQL, "op8_quality_rules": quality_sql()}
