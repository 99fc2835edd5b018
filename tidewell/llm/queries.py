"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidewell.llm.embeddings import op10_multi_index
from tidewell.llm.lines import OP3_SQL, op3_line_dedup
from tidewell.llm.media import op8_matroska
from tidewell.llm.multiset import op13_fingerprints
from tidewell.llm.packing import op5_packing
from tidewell.llm.ranking import OP12_SQL, op12_ranked_search
from tidewell.llm.secrets import op1_secret_scan
from tidewell.llm.sharding import op7_sharding
from tidewell.llm.segmentation import op9_segmentation
from tidewell.llm.simhash import op2_simhash
from tidewell.llm.tokens import op6_token_counts
from tidewell.llm.toxicity import op4_toxicity
from tidewell.llm.trie import OP11_SQL, op11_prefix_trie


def queries() -> dict:
    return {f.__name__: f for f in (op1_secret_scan, op2_simhash, op3_line_dedup, op4_toxicity, op5_packing, op6_token_counts,
                                    op7_sharding, op8_matroska, op9_segmentation, op10_multi_index,
                                    op11_prefix_trie, op12_ranked_search, op13_fingerprints)}


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": OP3_SQL, "op11_prefix_trie": OP11_SQL, "op12_ranked_search": OP12_SQL}
