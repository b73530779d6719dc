"""The queries of this package, by name."""

from __future__ import annotations

from stratalake.llm.bpe import op9_bpe
from stratalake.llm.decontaminate import op13_decontaminate
from stratalake.llm.exact_dedup import op1_exact_dedup
from stratalake.llm.hard_negatives import op11_hard_negatives
from stratalake.llm.hilbert_shards import op4_hilbert_shards
from stratalake.llm.html_extract import op10_html_text
from stratalake.llm.language_id import op2_language_id
from stratalake.llm.mixing import op3_mix_sources
from stratalake.llm.near_dup import op6_minhash
from stratalake.llm.oracle import ORACLE_SQL
from stratalake.llm.phrases import op12_collocations
from stratalake.llm.quality import op7_quality_rules
from stratalake.llm.secret_scan import op8_secret_scan
from stratalake.llm.warc import op5_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_language_id,
        op3_mix_sources,
        op4_hilbert_shards,
        op5_warc,
        op6_minhash,
        op7_quality_rules,
        op8_secret_scan,
        op9_bpe,
        op10_html_text,
        op11_hard_negatives,
        op12_collocations,
        op13_decontaminate,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
