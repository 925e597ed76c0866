"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from quillon.llm.decontamination import OP10_SQL, op10_decontamination
from quillon.llm.exact_dedup import OP11_SQL, op11_exact_dedup
from quillon.llm.language import op1_language_id
from quillon.llm.near_dedup import op3_near_dedup
from quillon.llm.secrets import op6_secret_scan
from quillon.llm.spelling import OP12_SQL, op12_spelling_variants
from quillon.llm.token_counts import op9_token_counts
from quillon.llm.token_files import op8_token_files
from quillon.llm.topk_search import OP4_SQL, op4_topk_search
from quillon.llm.toxicity import op2_toxicity
from quillon.llm.warc import op5_warc
from quillon.llm.whitening import op13_embedding_whitening
from quillon.llm.word_bpe import op7_bpe

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_topk_search": op4_topk_search,
    "op5_warc": op5_warc,
    "op6_secret_scan": op6_secret_scan,
    "op7_bpe": op7_bpe,
    "op8_token_files": op8_token_files,
    "op9_token_counts": op9_token_counts,
    "op10_decontamination": op10_decontamination,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op4_topk_search": OP4_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_exact_dedup": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
}
