"""The queries of this subpackage, and the SQL of those that SQL can express."""

from ratestrata.llm.conversation_repair import OP13_SQL, op13_conversation_repair
from ratestrata.llm.interpolated_lm import op3_language_model
from ratestrata.llm.license_scan import op1_license_scan
from ratestrata.llm.long_repeats import OP4_SQL, op4_long_repeats
from ratestrata.llm.near_duplicates import OP9_SQL, op9_near_duplicates
from ratestrata.llm.neighbours import op5_neighbours
from ratestrata.llm.packing import op6_packing
from ratestrata.llm.pieces import op7_pieces
from ratestrata.llm.prefix_trie import OP11_SQL, op11_prefix_trie
from ratestrata.llm.quality_classifier import op10_quality_classifier
from ratestrata.llm.quality_rules import OP2_SQL, op2_quality_rules
from ratestrata.llm.suffix_repeats import OP12_SQL, op12_suffix_repeats
from ratestrata.llm.token_counts import op8_token_counts

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_model": op3_language_model,
    "op4_long_repeats": op4_long_repeats,
    "op5_neighbours": op5_neighbours,
    "op6_packing": op6_packing,
    "op7_pieces": op7_pieces,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_suffix_repeats": op12_suffix_repeats,
    "op13_conversation_repair": op13_conversation_repair,
}
ORACLES = {
    "op2_quality_rules": OP2_SQL,
    "op4_long_repeats": OP4_SQL,
    "op9_near_duplicates": OP9_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_suffix_repeats": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
