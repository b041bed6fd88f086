"""The text queries by name, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumenrec.llm.decontaminate import OP5_SQL, op5_suffix_decontaminate
from lumenrec.llm.language import op3_attention_lm
from lumenrec.llm.lempel_ziv import op2_lempel_ziv
from lumenrec.llm.negatives import OP11_SQL, op11_rotated_codes
from lumenrec.llm.packing import op8_conflict_best_fit
from lumenrec.llm.pii import op1_crf_pii
from lumenrec.llm.quality import op4_subword_quality
from lumenrec.llm.rules import op12_decision_list
from lumenrec.llm.simhash import op10_simhash_bktree
from lumenrec.llm.substrings import OP6_SQL, op6_relative_lz
from lumenrec.llm.tokenids import op7_elias_fano_ids
from lumenrec.llm.toxicity import op9_grammar_toxicity
from lumenrec.llm.variants import OP13_SQL, op13_permuterm

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_crf_pii": op1_crf_pii,
    "op2_lempel_ziv": op2_lempel_ziv,
    "op3_attention_lm": op3_attention_lm,
    "op4_subword_quality": op4_subword_quality,
    "op5_suffix_decontaminate": op5_suffix_decontaminate,
    "op6_relative_lz": op6_relative_lz,
    "op7_elias_fano_ids": op7_elias_fano_ids,
    "op8_conflict_best_fit": op8_conflict_best_fit,
    "op9_grammar_toxicity": op9_grammar_toxicity,
    "op10_simhash_bktree": op10_simhash_bktree,
    "op11_rotated_codes": op11_rotated_codes,
    "op12_decision_list": op12_decision_list,
    "op13_permuterm": op13_permuterm,
}
ORACLES: dict[str, str] = {
    "op5_suffix_decontaminate": OP5_SQL,
    "op6_relative_lz": OP6_SQL,
    "op11_rotated_codes": OP11_SQL,
    "op13_permuterm": OP13_SQL,
}
