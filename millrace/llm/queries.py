"""The registered queries of this subpackage and their DuckDB text."""

from __future__ import annotations

from millrace.llm.centroid_simplex import op12_centroid_simplex
from millrace.llm.license_rules import op13_license_rules
from millrace.llm.masked_likelihood import op7_masked_likelihood
from millrace.llm.minhash_components import op8_minhash_components
from millrace.llm.oracle import SQL  # noqa: F401
from millrace.llm.quality_divergence import op10_quality_divergence
from millrace.llm.relative_lz import op3_relative_lz
from millrace.llm.secret_ownership import op1_secret_ownership
from millrace.llm.sentencepiece_chunks import op4_sentencepiece_chunks
from millrace.llm.simhash_windows import op9_simhash_windows
from millrace.llm.suffix_dedup import op2_suffix_dedup
from millrace.llm.surrogates import op5_surrogates
from millrace.llm.toxicity_trees import op6_toxicity_trees
from millrace.llm.whitening_feast import op11_whitening_feast

QUERIES = {f.__name__: f for f in (op1_secret_ownership, op2_suffix_dedup, op3_relative_lz, op4_sentencepiece_chunks, op5_surrogates,
                                   op6_toxicity_trees, op7_masked_likelihood, op8_minhash_components, op9_simhash_windows, op10_quality_divergence,
                                   op11_whitening_feast, op12_centroid_simplex, op13_license_rules)}
