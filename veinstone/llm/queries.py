"""The queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from . import fill_in_middle, fingerprints, html_extraction, license_scan, mixing, near_dedup, packing, periodic_runs, quality_rules, resampling, substring_dedup, toxicity, warc

QUERIES = {
    "op1_nnls_packing": packing.op1_nnls_packing,
    "op2_divergence_rules": quality_rules.op2_divergence_rules,
    "op3_weighted_sampling_fingerprints": fingerprints.op3_weighted_sampling_fingerprints,
    "op4_importance_resampling": resampling.op4_importance_resampling,
    "op5_low_discrepancy_mix": mixing.op5_low_discrepancy_mix,
    "op6_minhash_near_dedup": near_dedup.op6_minhash_near_dedup,
    "op7_zstd_warc": warc.op7_zstd_warc,
    "op8_site_template_removal": html_extraction.op8_site_template_removal,
    "op9_paragraph_substring_dedup": substring_dedup.op9_paragraph_substring_dedup,
    "op10_crf_toxicity": toxicity.op10_crf_toxicity,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_fill_in_middle": fill_in_middle.op12_fill_in_middle,
    "op13_license_scan": license_scan.op13_license_scan,
}

ORACLES = {
    "op2_divergence_rules": quality_rules.SQL, "op5_low_discrepancy_mix": mixing.SQL, "op6_minhash_near_dedup": near_dedup.SQL, "op7_zstd_warc": warc.SQL, "op12_fill_in_middle": fill_in_middle.SQL, "op13_license_scan": license_scan.SQL,
}
