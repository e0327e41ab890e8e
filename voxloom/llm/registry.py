"""Queries of this subpackage by name, and their SQL where SQL can say them."""

from __future__ import annotations

from voxloom.llm import chat, flac, html_text, language, mixing, packing, partenum, secrets, sharding, sketches

QUERIES = {
    "op1_language": language.query,
    "op2_chat": chat.query,
    "op3_partenum": partenum.query,
    "op4_packing": packing.query,
    "op5_flac": flac.query,
    "op6_secrets": secrets.query,
    "op7_sharding": sharding.query,
    "op8_sketches": sketches.query,
    "op9_mixing": mixing.query,
    "op10_html": html_text.query,
}

ORACLE_SQL = {
    "op2_chat": chat.ORACLE_SQL,
    "op3_partenum": partenum.ORACLE_SQL,
    "op9_mixing": mixing.ORACLE_SQL,
}
