"""Queries of this subpackage and the SQL they are held against."""

from . import decontaminate, jaccard_join, license_scan, line_dedup, lm_score, pieces, quality_rules, substring_dedup, toxicity, training_order

QUERIES = {"op5_lm_score": lm_score.query, "op6_training_order": training_order.query, "op8_license_scan": license_scan.query, "op1_toxicity": toxicity.query, "op3_decontaminate": decontaminate.query, "op7_jaccard_join": jaccard_join.query, "op4_substring_dedup": substring_dedup.query, "op2_quality_rules": quality_rules.query, "op9_line_dedup": line_dedup.query, "op10_pieces": pieces.query}
ORACLES = {"op8_license_scan": license_scan.ORACLE, "op4_substring_dedup": substring_dedup.ORACLE, "op9_line_dedup": line_dedup.ORACLE}
