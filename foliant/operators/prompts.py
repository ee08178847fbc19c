"""Prompts as columns; the words are this package's own, and no model is called here."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.functions.text import truncate
from foliant.operators.extraction import TYPES

# How many groups of each kind a summary asks for.
TARGETS = {
    "coverage_per_module": 6,
    "common_exclusions": 14,
    "module_specific_exclusions_per_module": 10,
    "notification_duties": 5,
    "claim_obligations": 4,
    "limits": 10,
    "deadlines": 5,
    "conditions": 8,
    "total_min": 35,
    "total_max": 80,
}

EXTRACT = "List every rule of this part of a policy as JSON: {\"items\": [...]}. Each item has item_type (" + ", ".join(TYPES) + "), module, headline, exact_quote (word for word), supporting_clause_ids (the marked ids it rests on), importance from 1 to 5, money_amounts, deadlines, conditions, theme and exclusion_scope. Leave out what the text does not say."
SELECT = "Choose the items that a customer must know, and merge those that say the same. Use the given ids only. Answer in JSON: {\"selected_groups\": [{\"display_headline\": ..., \"source_item_ids\": [...], \"visual_priority\": 1 to 4, \"reason\": ...}], \"rejected_item_ids\": [...]}."


def extraction_prompt(path: Column, text: Column, continued: Column) -> Column:
    note = F.when(continued, "\n(The section goes on from an earlier part.)").otherwise("")
    return F.concat(F.lit(EXTRACT + "\n\nSection: "), F.coalesce(path, F.lit("")), note, F.lit("\n\n"), text)


def compact_item(item_id: Column, bucket: Column, module: Column, item_type: Column, theme: Column, headline: Column, quote: Column, importance: Column) -> Column:
    """An item under short names, its headline of 90 and its quote of 120 characters at most."""
    return F.struct(item_id.alias("id"), bucket.alias("b"), module.alias("m"), item_type.alias("t"), theme.alias("th"), truncate(headline, 90).alias("h"), truncate(quote, 120).alias("q"), importance.alias("imp"))


def selection_prompt(doc_id: Column, items: Column, targets: Mapping[str, int] = TARGETS) -> Column:
    """``items``: array of compact items of a document."""
    asked = F.struct(*(F.lit(v).alias(k) for k, v in targets.items()))
    return F.concat(F.lit(SELECT + "\n\n"), F.to_json(F.struct(doc_id.alias("doc_id"), asked.alias("targets"), items.alias("items"))))
