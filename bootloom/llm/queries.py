"""The corpus queries by name, and their SQL twins."""

from __future__ import annotations

from . import decontaminate, filter_audit, hard_negatives, ngram_join, substring_dedup, warc
from .decontaminate import op9_decontaminate
from .filter_audit import op11_filter_audit
from .hard_negatives import op12_hard_negatives
from .mixing import op3_mixing
from .ngram_join import op6_ngram_join
from .pii import op5_pii
from .quality import op4_quality_outliers
from .substring_dedup import op8_substring_dedup
from .token_counts import op10_token_counts
from .token_store import op2_token_store
from .toxicity import op7_toxicity
from .warc import op1_warc
from .word_table import op13_bpe_words

QUERIES = {f.__name__: f for f in (
    op1_warc, op2_token_store, op3_mixing, op4_quality_outliers, op5_pii, op6_ngram_join, op7_toxicity,
    op8_substring_dedup, op9_decontaminate, op10_token_counts, op11_filter_audit,
    op12_hard_negatives, op13_bpe_words)}
ORACLES: dict[str, str] = {"op1_warc": warc.ORACLE, "op6_ngram_join": ngram_join.ORACLE,
                           "op8_substring_dedup": substring_dedup.ORACLE,
                           "op9_decontaminate": decontaminate.ORACLE, "op11_filter_audit": filter_audit.ORACLE,
                           "op12_hard_negatives": hard_negatives.ORACLE}
