"""The registered queries of this package: name -> (query(spark, sf_dir), SQL or None)."""

from __future__ import annotations

from panelkit.llm.chunk_dedup import op8_chunk_dedup
from panelkit.llm.decontaminate import OP6_SQL, op6_decontaminate
from panelkit.llm.kd_shards import op13_kd_shards
from panelkit.llm.near_duplicates import op5_near_duplicates
from panelkit.llm.phrases import OP12_SQL, op12_phrases
from panelkit.llm.pii import op1_pii_crf
from panelkit.llm.quality import op7_quality_em
from panelkit.llm.sentencepiece import op3_sentencepiece
from panelkit.llm.suffix_dedup import op2_suffix_dedup
from panelkit.llm.token_alignment import op11_token_alignment
from panelkit.llm.token_counts import op10_token_counts
from panelkit.llm.topk_search import OP9_SQL, op9_cover_tree
from panelkit.llm.url_rules import OP4_SQL, op4_url_rules

CASES = {
    "op1_pii_crf": (op1_pii_crf, None),
    "op2_suffix_dedup": (op2_suffix_dedup, None),
    "op3_sentencepiece": (op3_sentencepiece, None),
    "op4_url_rules": (op4_url_rules, OP4_SQL),
    "op5_near_duplicates": (op5_near_duplicates, None),
    "op6_decontaminate": (op6_decontaminate, OP6_SQL),
    "op7_quality_em": (op7_quality_em, None),
    "op8_chunk_dedup": (op8_chunk_dedup, None),
    "op9_cover_tree": (op9_cover_tree, OP9_SQL),
    "op10_token_counts": (op10_token_counts, None),
    "op11_token_alignment": (op11_token_alignment, None),
    "op12_phrases": (op12_phrases, OP12_SQL),
    "op13_kd_shards": (op13_kd_shards, None),
}
