"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from waybill.llm import audit, decontaminate, resample
from waybill.llm.audit import op12_filter_audit
from waybill.llm.bpe import op1_bpe
from waybill.llm.decontaminate import op5_decontaminate
from waybill.llm.jaccard import op9_jaccard_join
from waybill.llm.language import op4_language_id
from waybill.llm.lm import op3_lm_score
from waybill.llm.pii import op2_pii
from waybill.llm.piecewise import op11_fingerprints
from waybill.llm.quality import op6_quality
from waybill.llm.resample import op13_resample
from waybill.llm.suffixes import op10_suffix_dedup
from waybill.llm.token_files import op8_token_files
from waybill.llm.toxicity import op7_toxicity

QUERIES = {f.__name__: f for f in (
    op1_bpe, op2_pii, op3_lm_score, op4_language_id, op5_decontaminate, op6_quality, op7_toxicity,
    op8_token_files, op9_jaccard_join, op10_suffix_dedup, op11_fingerprints, op12_filter_audit, op13_resample)}
ORACLE: dict[str, str] = {"op5_decontaminate": decontaminate.SQL, "op12_filter_audit": audit.SQL,
                          "op13_resample": resample.SQL}
