"""Queries of the training-data operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from .ann import op4_inverted_multi_index
from .collocations import OP11_SQL, op11_stripe_collocations
from .exact_dedup import OP1_SQL, op1_exact_dedup
from .html_text import op8_tag_path_ratios
from .line_dedup import OP13_SQL, op13_perfect_hash_line_dedup
from .mixing import OP5_SQL, op5_fair_queue_mixing
from .packing import op3_karmarkar_karp_packing
from .pii import op10_crf_personal_data
from .quality import op2_weak_label_quality
from .sharding import op6_hilbert_sharding
from .simhash import op7_simhash_pigeonring
from .token_file import op9_bit_packed_tokens
from .whitening import op12_jacobi_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup, op2_weak_label_quality, op3_karmarkar_karp_packing, op4_inverted_multi_index,
        op5_fair_queue_mixing, op6_hilbert_sharding, op7_simhash_pigeonring, op8_tag_path_ratios, op9_bit_packed_tokens,
        op10_crf_personal_data, op11_stripe_collocations, op12_jacobi_whitening, op13_perfect_hash_line_dedup,
    )
}

ORACLES = {"op1_exact_dedup": OP1_SQL, "op5_fair_queue_mixing": OP5_SQL, "op11_stripe_collocations": OP11_SQL, "op13_perfect_hash_line_dedup": OP13_SQL}
