"""The queries of the training-data operators, by name, and their SQL twins."""

from __future__ import annotations

from siltlake.llm import chat, clusters, codes, jaccard, warc
from siltlake.llm.chat import op2_chat_perspectives
from siltlake.llm.clusters import op12_sort_means
from siltlake.llm.codes import op11_vector_codes
from siltlake.llm.decontaminate import op5_decontamination
from siltlake.llm.jaccard import op3_jaccard_join
from siltlake.llm.langid import op10_language_id
from siltlake.llm.licenses import op1_license_scan
from siltlake.llm.packing import op8_best_fit_packing
from siltlake.llm.quality import op9_quality_rules
from siltlake.llm.secrets import op4_secret_scan
from siltlake.llm.slack import op13_minimum_slack
from siltlake.llm.toxicity import op6_toxicity
from siltlake.llm.warc import op7_warc_transactions

QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_chat_perspectives": op2_chat_perspectives,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_secret_scan": op4_secret_scan,
    "op5_decontamination": op5_decontamination,
    "op6_toxicity": op6_toxicity,
    "op7_warc_transactions": op7_warc_transactions,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_vector_codes,
    "op12_sort_means": op12_sort_means,
    "op13_minimum_slack": op13_minimum_slack,
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat_perspectives": chat.ORACLE_SQL,
    "op3_jaccard_join": jaccard.ORACLE_SQL,
    "op7_warc_transactions": warc.ORACLE_SQL,
    "op11_vector_codes": codes.oracle_sql(),
    "op12_sort_means": clusters.oracle_sql(),
}
