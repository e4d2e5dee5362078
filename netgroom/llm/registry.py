"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from netgroom.llm.bpe import op5_bpe
from netgroom.llm.counts import op10_counts
from netgroom.llm.decontaminate import op4_decontamination
from netgroom.llm.divergence import OP13_SQL, op13_divergence
from netgroom.llm.jaccard import op9_jaccard
from netgroom.llm.langid import op2_language
from netgroom.llm.licenses import op7_licenses
from netgroom.llm.merkle import OP11_SQL, op11_merkle
from netgroom.llm.packing import op12_packing
from netgroom.llm.secrets import op8_secrets
from netgroom.llm.sentences import op3_sentences
from netgroom.llm.topk import OP1_SQL, op1_topk
from netgroom.llm.toxicity import op6_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_topk,
        op2_language,
        op3_sentences,
        op4_decontamination,
        op5_bpe,
        op6_toxicity,
        op7_licenses,
        op8_secrets,
        op9_jaccard,
        op10_counts,
        op11_merkle,
        op12_packing,
        op13_divergence,
    )
}
ORACLE_SQL = {"op1_topk": OP1_SQL, "op11_merkle": OP11_SQL, "op13_divergence": OP13_SQL}
