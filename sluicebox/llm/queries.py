"""The registered queries of this subpackage and their SQL."""
from __future__ import annotations

from sluicebox.llm.blocks import op7_block_labeller
from sluicebox.llm.collocations import op11_rollup_collocations
from sluicebox.llm.ctw import op1_context_tree_weighting
from sluicebox.llm.minhash import op2_minhash_fingerprints
from sluicebox.llm.mixing import op8_sainte_lague_mixing
from sluicebox.llm.passages import op13_attention_quality
from sluicebox.llm.prefix_join import op10_ngram_jaccard_join
from sluicebox.llm.repeats import op9_bounded_repeats
from sluicebox.llm.spelling import op12_qchunk_spelling
from sluicebox.llm.sql import SQL
from sluicebox.llm.templates import op6_license_templates
from sluicebox.llm.toxicity import op5_ngram_toxicity
from sluicebox.llm.warc import op3_warc_bundles
from sluicebox.llm.winnowing import op4_winnowing_decontamination

QUERIES = {
    f.__name__: f for f in (
        op1_context_tree_weighting,
        op2_minhash_fingerprints,
        op3_warc_bundles,
        op4_winnowing_decontamination,
        op5_ngram_toxicity,
        op6_license_templates,
        op7_block_labeller,
        op8_sainte_lague_mixing,
        op9_bounded_repeats,
        op10_ngram_jaccard_join,
        op11_rollup_collocations,
        op12_qchunk_spelling,
        op13_attention_quality,
    )
}
__all__ = ["QUERIES", "SQL"]
