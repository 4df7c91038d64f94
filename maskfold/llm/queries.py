"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from maskfold.llm import fill_middle, filter_audit, ngram_join, sharding, warc
from maskfold.llm.decontaminate import op4_decontaminate
from maskfold.llm.fill_middle import op12_fill_middle
from maskfold.llm.filter_audit import op11_filter_audit
from maskfold.llm.fingerprints import op1_fingerprints
from maskfold.llm.html_main import op6_html
from maskfold.llm.language import op10_language
from maskfold.llm.ngram_join import op9_ngram_join
from maskfold.llm.quality import op3_quality
from maskfold.llm.secrets import op2_secrets
from maskfold.llm.mixing import op5_mixing
from maskfold.llm.sharding import op7_sharding
from maskfold.llm.toxicity import op8_toxicity
from maskfold.llm.warc import op13_warc

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_secrets": op2_secrets,
    "op3_quality": op3_quality,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op6_html": op6_html,
    "op7_sharding": op7_sharding,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_join": op9_ngram_join,
    "op10_language": op10_language,
    "op11_filter_audit": op11_filter_audit,
    "op12_fill_middle": op12_fill_middle,
    "op13_warc": op13_warc,
}

SQL: dict[str, str] = {
    "op7_sharding": sharding.SQL,
    "op9_ngram_join": ngram_join.SQL,
    "op11_filter_audit": filter_audit.SQL,
    "op12_fill_middle": fill_middle.SQL,
    "op13_warc": warc.SQL,
}
