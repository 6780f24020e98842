"""One registered query per operator, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from .ann import q_ann
from .byte_bpe import q_byte_bpe
from .decontaminate import DECONTAMINATE_SQL, q_decontaminate
from .huffman import q_huffman
from .line_dedup import LINE_DEDUP_SQL, q_line_dedup
from .phrase_dedup import PHRASE_DEDUP_SQL, q_phrase_dedup
from .ppm import q_ppm
from .simhash import q_simhash
from .suffix_dedup import SUFFIX_DEDUP_SQL, q_suffix_dedup
from .token_alignment import q_token_alignment
from .token_counts import q_token_counts
from .toxicity import q_toxicity
from .vector_codes import VECTOR_CODES_SQL, q_vector_codes

QUERIES = {
    "op1_ann": q_ann,
    "op2_token_counts": q_token_counts,
    "op3_line_dedup": q_line_dedup,
    "op4_phrase_dedup": q_phrase_dedup,
    "op5_decontaminate": q_decontaminate,
    "op6_ppm": q_ppm,
    "op7_huffman": q_huffman,
    "op8_toxicity": q_toxicity,
    "op9_simhash": q_simhash,
    "op10_byte_bpe": q_byte_bpe,
    "op11_suffix_dedup": q_suffix_dedup,
    "op12_token_alignment": q_token_alignment,
    "op13_vector_codes": q_vector_codes,
}
ORACLES = {
    "op3_line_dedup": LINE_DEDUP_SQL,
    "op4_phrase_dedup": PHRASE_DEDUP_SQL,
    "op5_decontaminate": DECONTAMINATE_SQL,
    "op11_suffix_dedup": SUFFIX_DEDUP_SQL,
    "op13_vector_codes": VECTOR_CODES_SQL,
}
