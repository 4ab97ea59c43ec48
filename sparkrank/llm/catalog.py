"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from .alignment import q_op11_alignment
from .decontam import ORACLE_OP9, q_op9_decontamination
from .itq import q_op2_itq
from .langid import q_op10_langid
from .licenses import ORACLE_OP8, q_op8_licenses
from .mixing import ORACLE_OP13, q_op13_mixing
from .pieces import q_op5_pieces
from .pii import q_op1_pii
from .records import q_op3_token_records
from .secrets import q_op6_secrets
from .simhash import q_op7_simhash
from .toxicity import q_op4_toxicity
from .trie import q_op12_trie

QUERIES = {
    "op1_pii": q_op1_pii,
    "op2_itq": q_op2_itq,
    "op3_token_records": q_op3_token_records,
    "op4_toxicity": q_op4_toxicity,
    "op5_pieces": q_op5_pieces,
    "op6_secrets": q_op6_secrets,
    "op7_simhash": q_op7_simhash,
    "op8_licenses": q_op8_licenses,
    "op9_decontamination": q_op9_decontamination,
    "op10_langid": q_op10_langid,
    "op11_alignment": q_op11_alignment,
    "op12_trie": q_op12_trie,
    "op13_mixing": q_op13_mixing,
}

ORACLE: dict[str, str] = {
    "op8_licenses": ORACLE_OP8,
    "op9_decontamination": ORACLE_OP9,
    "op13_mixing": ORACLE_OP13,
}
