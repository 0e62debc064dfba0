"""The registered queries of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm.bytebpe import op10_byte_bpe
from meterflow.llm.decontaminate import op4_decontaminate
from meterflow.llm.hilbert import op9_hilbert
from meterflow.llm.importance import op1_importance
from meterflow.llm.licenses import OP11_SQL, op11_licenses
from meterflow.llm.minhash import op3_minhash
from meterflow.llm.permindex import op8_permutation_index
from meterflow.llm.phrases import OP12_SQL, op12_phrases
from meterflow.llm.spelling import OP13_SQL, op13_spelling
from meterflow.llm.toxicity import op7_toxicity
from meterflow.llm.url_lists import OP5_SQL, op5_url_lists
from meterflow.llm.warc import OP6_SQL, op6_warc
from meterflow.llm.winnow import op2_line_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance": op1_importance,
    "op2_line_dedup": op2_line_dedup,
    "op3_minhash": op3_minhash,
    "op4_decontaminate": op4_decontaminate,
    "op5_url_lists": op5_url_lists,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_permutation_index": op8_permutation_index,
    "op9_hilbert": op9_hilbert,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_licenses": op11_licenses,
    "op12_phrases": op12_phrases,
    "op13_spelling": op13_spelling,
}

ORACLE: dict[str, str] = {
    "op5_url_lists": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op11_licenses": OP11_SQL,
    "op12_phrases": OP12_SQL,
    "op13_spelling": OP13_SQL,
}
