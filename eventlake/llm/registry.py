"""The queries of this package, by name, and their DuckDB statements."""

from __future__ import annotations

from eventlake.llm.op1_substring_dedup import op1_substring_dedup
from eventlake.llm.op2_quality import op2_quality
from eventlake.llm.op3_html_text import op3_html_text
from eventlake.llm.op4_jaccard_join import op4_jaccard_join
from eventlake.llm.op5_language import op5_language
from eventlake.llm.op6_class_lm import op6_class_lm
from eventlake.llm.op7_embedding_join import op7_embedding_join
from eventlake.llm.op8_bpe import op8_bpe
from eventlake.llm.op9_suffix_dedup import op9_suffix_dedup
from eventlake.llm.op10_decontaminate import op10_decontaminate
from eventlake.llm.op11_structure_repair import op11_structure_repair
from eventlake.llm.op12_whitening import op12_whitening
from eventlake.llm.op13_packing import op13_packing

QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_quality,
        op3_html_text,
        op4_jaccard_join,
        op5_language,
        op6_class_lm,
        op7_embedding_join,
        op8_bpe,
        op9_suffix_dedup,
        op10_decontaminate,
        op11_structure_repair,
        op12_whitening,
        op13_packing,
    )
}

#: no trained model, automaton, hash or range join of these is plain SQL that DuckDB finishes on whole tables
ORACLES: dict[str, str] = {}
