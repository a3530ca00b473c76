"""The queries of this subpackage for __spark_entry__.py, and their SQL where SQL can express them."""

from __future__ import annotations

from tallyloom.llm import fixity, leaderboard, mixing, urls
from tallyloom.llm.alignment import op12_alignment
from tallyloom.llm.decontaminate import op10_decontaminate
from tallyloom.llm.fingerprints import op1_fingerprints
from tallyloom.llm.licences import op7_licences
from tallyloom.llm.lines import op3_lines
from tallyloom.llm.pii import op11_pii
from tallyloom.llm.simhash import op2_simhash
from tallyloom.llm.tokens import op4_token_ids
from tallyloom.llm.toxicity import op8_toxicity

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_simhash": op2_simhash,
    "op3_lines": op3_lines,
    "op4_token_ids": op4_token_ids,
    "op5_fixity": fixity.op5_fixity,
    "op6_mixing": mixing.op6_mixing,
    "op7_licences": op7_licences,
    "op8_toxicity": op8_toxicity,
    "op9_urls": urls.op9_urls,
    "op10_decontaminate": op10_decontaminate,
    "op11_pii": op11_pii,
    "op12_alignment": op12_alignment,
    "op13_leaderboard": leaderboard.op13_leaderboard,
}

ORACLE = {"op5_fixity": fixity.OP5_SQL, "op6_mixing": mixing.OP6_SQL, "op9_urls": urls.OP9_SQL, "op13_leaderboard": leaderboard.OP13_SQL}
