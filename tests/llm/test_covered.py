"""Every text query has SQL or a test against brute force, held-out accuracy or an exact round trip."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from shoplens.plans import load

HELD_BY = {
    "op1_quality": "test_quality",
    "op2_substring_dedup": "test_substrings",
    "op3_language_id": "test_language",
    "op4_sentencepiece": "test_pieces",
    "op5_lm_score": "test_hmm_sums_to_brute_force",
    "op6_preference_format": "test_preferences",
    "op7_url_filter": "test_urls",
    "op9_ngram_jaccard": "test_near_duplicates",
    "op10_decontamination": "test_decontamination",
    "op11_toxicity": "test_toxicity_of_held_out_texts",
    "op12_structure_repair": "test_repairs",
    "pipeline": "test_pipeline_rows",
}
TESTS = "\n".join(f.read_text() for f in Path(__file__).parent.glob("test_*.py"))


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(load().QUERIES)))
def test_held_by_sql_or_brute_force(name):
    assert name in entry_points.oracle_sql() or f"def {HELD_BY[name]}(" in TESTS
