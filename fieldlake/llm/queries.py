"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from fieldlake.llm import alignment, fingerprints, infill, lattice, licences, mixing, neardup, packing, substrings, suffixes, topk, toxicity, urls

QUERIES = {
    "op1_near_dedup": neardup.op1_near_dedup,
    "op2_mix_sources": mixing.op2_mix,
    "op3_license_scan": licences.op3_license_scan,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_url_filter": urls.op5_url_filter,
    "op6_substring_dedup": substrings.op6_substring_dedup,
    "op7_suffix_dedup": suffixes.op7_suffix_dedup,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_pack": packing.op9_pack,
    "op10_topk": topk.op10_topk,
    "op11_lattice_likelihood": lattice.op11_lattice_likelihood,
    "op12_align_tokens": alignment.op12_align_tokens,
    "op13_fill_in_middle": infill.op13_fill_in_middle,
}

SQL = {
    "op2_mix_sources": mixing.OP2_SQL,
    "op3_license_scan": licences.OP3_SQL,
    "op5_url_filter": urls.OP5_SQL,
    "op13_fill_in_middle": infill.OP13_SQL,
}
