"""The operators' queries by name, and their SQL where it can express them."""

from . import decontaminate, html_extract, infill, licenses, line_dedup, merkle, minhash, mixing, neighbours, quality_rules, substring_dedup, surrogates, token_files

QUERIES = {
    "op1_quality_rules": quality_rules.query,
    "op2_decontaminate": decontaminate.query,
    "op3_token_files": token_files.query,
    "op4_substring_dedup": substring_dedup.query,
    "op5_minhash": minhash.query,
    "op6_mixing": mixing.query,
    "op7_html_extract": html_extract.query,
    "op8_line_dedup": line_dedup.query,
    "op9_licenses": licenses.query,
    "op10_surrogates": surrogates.query,
    "op11_merkle": merkle.query,
    "op12_infill": infill.query,
    "op13_neighbours": neighbours.query,
}
ORACLES = {
    "op1_quality_rules": quality_rules.SQL,
    "op2_decontaminate": decontaminate.SQL,
    "op4_substring_dedup": substring_dedup.SQL,
    "op6_mixing": mixing.SQL,
    "op9_licenses": licenses.SQL,
    "op11_merkle": merkle.SQL,
    "op12_infill": infill.SQL,
}
