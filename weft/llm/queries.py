"""The registered queries of this subpackage and, where SQL can express one, its oracle."""

from __future__ import annotations

from weft.llm.block_names import OP12_SQL, op12_exact_dedup
from weft.llm.bpe import op4_byte_bpe
from weft.llm.decontam import op7_decontamination
from weft.llm.langid import op6_language_id
from weft.llm.merkle import OP11_SQL, op11_merkle_manifest
from weft.llm.mtree import OP8_SQL, op8_mtree_topk
from weft.llm.periodic import op13_periodic_runs
from weft.llm.ppm import op2_ppm_scores
from weft.llm.rollups import OP10_SQL, op10_token_rollups
from weft.llm.rules import op9_rule_quality
from weft.llm.simhash_golay import op5_simhash_golay
from weft.llm.token_files import op1_token_files
from weft.llm.warc import OP3_SQL, op3_warc_roundtrip

QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_ppm_scores, op3_warc_roundtrip, op4_byte_bpe, op5_simhash_golay, op6_language_id,
    op7_decontamination, op8_mtree_topk, op9_rule_quality, op10_token_rollups,
    op11_merkle_manifest, op12_exact_dedup, op13_periodic_runs)}
ORACLES = {"op3_warc_roundtrip": OP3_SQL, "op8_mtree_topk": OP8_SQL, "op10_token_rollups": OP10_SQL,
           "op11_merkle_manifest": OP11_SQL, "op12_exact_dedup": OP12_SQL}
