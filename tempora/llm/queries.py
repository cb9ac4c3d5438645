"""The registered corpus queries and their SQL."""

from __future__ import annotations

from tempora.llm.alignment import op13_alignment
from tempora.llm.decontaminate import op7_decontamination
from tempora.llm.divergence import op11_divergence
from tempora.llm.jaccard import op1_ngram_jaccard
from tempora.llm.langid import op9_langid
from tempora.llm.licenses import op12_licenses
from tempora.llm.line_dedup import op10_line_dedup
from tempora.llm.mixing import op3_mixing
from tempora.llm.oracle import oracle_sql  # noqa: F401
from tempora.llm.pii import op2_pii
from tempora.llm.quality import op8_quality
from tempora.llm.sharding import op5_sharding
from tempora.llm.suffix_dedup import op4_suffix_dedup
from tempora.llm.topk import op6_topk


def queries() -> dict:
    return {
        "op1_ngram_jaccard": op1_ngram_jaccard,
        "op2_pii": op2_pii,
        "op3_mixing": op3_mixing,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_sharding": op5_sharding,
        "op6_topk": op6_topk,
        "op7_decontamination": op7_decontamination,
        "op8_quality": op8_quality,
        "op9_langid": op9_langid,
        "op10_line_dedup": op10_line_dedup,
        "op11_divergence": op11_divergence,
        "op12_licenses": op12_licenses,
        "op13_alignment": op13_alignment,
    }
