"""The subpackage's queries and their SQL, by name."""

from __future__ import annotations

import corpus_pipeline
from vigil.llm import exact, html, imatch, kdsearch, lexical, linededup, packing, pieces, pii, quality, simhash, tokenfile, variants

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op2_exact": exact.op2_exact,
    "op3_packing": packing.op3_packing,
    "op4_pii": pii.op4_pii,
    "op5_html": html.op5_html,
    "op6_tokenfile": tokenfile.op6_tokenfile,
    "op7_linededup": linededup.op7_linededup,
    "op8_imatch": imatch.op8_imatch,
    "op9_quality": quality.op9_quality,
    "op10_simhash": simhash.op10_simhash,
    "op11_kdsearch": kdsearch.op11_kdsearch,
    "op12_variants": variants.op12_variants,
    "op13_lexical": lexical.op13_lexical,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {"op2_exact": exact.OP2_SQL, "op11_kdsearch": kdsearch.OP11_SQL, "op13_lexical": lexical.OP13_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
