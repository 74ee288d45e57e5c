"""DuckDB SQL of the queries that SQL can express over whole tables."""
from kindling.llm.decontam import OP5_SQL
from kindling.llm.lines import OP6_SQL
from kindling.llm.merkle import OP13_SQL
from kindling.llm.quality import OP3_SQL
from kindling.llm.ranking import OP12_SQL
from kindling.llm.substring import OP1_SQL
from kindling.llm.url_filter import OP10_SQL

SQL: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op3_quality_rules": OP3_SQL,
    "op5_decontamination": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op10_url_filter": OP10_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_merkle": OP13_SQL,
}
