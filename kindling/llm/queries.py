"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""
from kindling.llm.decontam import op5_decontamination
from kindling.llm.html_main import op9_html_extraction
from kindling.llm.langid import op4_language_id
from kindling.llm.lines import op6_line_dedup
from kindling.llm.merkle import op13_merkle
from kindling.llm.mixing import op2_mixing
from kindling.llm.packing import op11_packing
from kindling.llm.quality import op3_quality_rules
from kindling.llm.ranking import op12_ranked_search
from kindling.llm.simhash import op8_simhash
from kindling.llm.substring import op1_substring_dedup
from kindling.llm.tokens import op7_token_counts
from kindling.llm.url_filter import op10_url_filter

Q = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mixing": op2_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_simhash": op8_simhash,
    "op9_html_extraction": op9_html_extraction,
    "op10_url_filter": op10_url_filter,
    "op11_packing": op11_packing,
    "op12_ranked_search": op12_ranked_search,
    "op13_merkle": op13_merkle,
}
