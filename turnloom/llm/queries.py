"""Queries of the training-data operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import broken_pairs, consensus, encoding, leaks, one_form, shared_spans, speaker_turns, splitting
from turnloom.session import current_rows, read_table


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(read_table(spark, d, "turns"), ["turn_id"], ["meeting_id", "turn_index", "start_s", "end_s", "speaker_id", "text"])


def _units(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(read_table(spark, d, "units"), ["unit_key"], ["meeting_id", "turn_indices", "skip_reason"])


def _infer(spark: SparkSession, d: str) -> DataFrame:
    return current_rows(read_table(spark, d, "llm_infer"), ["infer_id"], ["pass", "user_text", "response"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries by name; pN belongs to problem N."""
    t = read_table
    return {
        "p1_found": lambda s, d: consensus.found_wrong(t(s, d, "hyps")),
        "p1_consensus": lambda s, d: consensus.consensus_wordings(t(s, d, "hyps")),
        "p1_reliability": lambda s, d: consensus.reliability(t(s, d, "hyps")),
        "p2_found": lambda s, d: broken_pairs.found_defects(_infer(s, d)),
        "p3_found": lambda s, d: speaker_turns.dirty_turns(_turns(s, d)),
        "p3_turns": lambda s, d: speaker_turns.speaker_turns(_turns(s, d)),
        "p4_found": lambda s, d: splitting.found_long_units(_units(s, d), _turns(s, d)),
        "p4_pieces": lambda s, d: splitting.split_units(_units(s, d), _turns(s, d)),
        "p4_text_pieces": lambda s, d: splitting.split_texts(t(s, d, "documents")),
        "p5_found": lambda s, d: one_form.found_look_alikes(t(s, d, "turns"), t(s, d, "hyps")),
        "p5_texts": lambda s, d: one_form.one_form(one_form.looks_alike_texts(t(s, d, "turns"), t(s, d, "hyps"))),
        "p7_ids": lambda s, d: encoding.encode_texts(t(s, d, "documents")),
        "p8_found": lambda s, d: leaks.found_leaks(t(s, d, "documents"), t(s, d, "eval_items")),
        "p8_templates": lambda s, d: leaks.reparameterised(t(s, d, "documents"), t(s, d, "eval_items")),
        "p9_found": lambda s, d: shared_spans.found_shared(t(s, d, "documents")),
        "p9_links": lambda s, d: shared_spans.found_shared(t(s, d, "documents"), expand=False),
        "p9_spans": lambda s, d: shared_spans.shared_stretches(t(s, d, "documents")),
        "p9_classes": lambda s, d: shared_spans.copy_classes(t(s, d, "documents")).select("doc_id", "class_id"),
        "p9_shared": lambda s, d: shared_spans.shared_share(t(s, d, "documents")),
    }
