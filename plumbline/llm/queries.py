"""The queries of the text operators, by name, and their SQL."""

from plumbline.llm.cotraining import op10_quality_classifier
from plumbline.llm.decision_rules import op9_quality_rules
from plumbline.llm.filter_audit import ORACLE as AUDIT_SQL
from plumbline.llm.filter_audit import op13_filter_audit
from plumbline.llm.html_text import op1_html_extraction
from plumbline.llm.licenses import op4_license_scan
from plumbline.llm.neardup import op6_minhash_dedup
from plumbline.llm.packing import op5_packing
from plumbline.llm.prefix_trie import op12_prefix_trie
from plumbline.llm.repeats import op7_suffix_dedup
from plumbline.llm.shards import op8_sharding
from plumbline.llm.tiling import op2_decontamination
from plumbline.llm.token_counts import op3_token_counts
from plumbline.llm.warc import op11_warc

QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_license_scan": op4_license_scan,
    "op5_packing": op5_packing,
    "op6_minhash_dedup": op6_minhash_dedup,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_sharding": op8_sharding,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_warc": op11_warc,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES: dict[str, str] = {"op13_filter_audit": AUDIT_SQL}
