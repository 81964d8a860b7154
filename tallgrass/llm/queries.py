"""The text operators' registered queries and, where SQL can state their result, the SQL."""

from .byte_bpe import op7_byte_bpe
from .conversation_repair import OP13_SQL, op13_conversation_repair
from .decontaminate import op1_decontaminate
from .exact_dedup import OP4_SQL, op4_exact_dedup
from .line_dedup import op10_line_dedup
from .lm_scoring import op11_lm_scoring
from .near_dedup import op5_near_dedup
from .periodic_runs import op12_periodic_runs
from .quality import op6_quality
from .secrets import op8_secrets
from .suffix_dedup import op3_suffix_dedup
from .token_counts import op9_token_counts
from .toxicity import op2_toxicity

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_toxicity": op2_toxicity,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_near_dedup": op5_near_dedup,
    "op6_quality": op6_quality,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_secrets": op8_secrets,
    "op9_token_counts": op9_token_counts,
    "op10_line_dedup": op10_line_dedup,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES = {"op4_exact_dedup": OP4_SQL, "op13_conversation_repair": OP13_SQL}
