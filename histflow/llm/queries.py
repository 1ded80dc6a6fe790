"""The registered queries of the operators, and the check SQL where there is one."""

from __future__ import annotations

from histflow.llm.op01_jaccard_join import op1_jaccard_join
from histflow.llm.op02_sentencepiece import op2_sentencepiece
from histflow.llm.op03_decontamination import OP3_SQL, op3_decontamination
from histflow.llm.op04_token_files import op4_token_files
from histflow.llm.op05_suffix_dedup import op5_suffix_dedup
from histflow.llm.op06_license_scan import op6_license_scan
from histflow.llm.op07_html_text import op7_html_text
from histflow.llm.op08_pii import op8_pii
from histflow.llm.op09_sharding import op9_sharding
from histflow.llm.op10_quality_rules import op10_quality_rules
from histflow.llm.op11_nearest_neighbours import op11_nearest_neighbours
from histflow.llm.op12_conversation_repair import op12_conversation_repair
from histflow.llm.op13_spelling_variants import op13_spelling_variants

QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_decontamination": op3_decontamination,
    "op4_token_files": op4_token_files,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_html_text": op7_html_text,
    "op8_pii": op8_pii,
    "op9_sharding": op9_sharding,
    "op10_quality_rules": op10_quality_rules,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {"op3_decontamination": OP3_SQL}
