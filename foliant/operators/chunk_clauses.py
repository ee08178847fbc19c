"""Chunks of any kind as atomic clauses with role, hint and identity.

All of it is column functions: a chunk's fragments are one array, exploded once, so there is
no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.functions import lexicon as L
from foliant.functions.text import bound, clean_clause, merge_dependent, normalise_space, sentences, tidy_clause, without_end

_FRAGMENT = "array<struct<text:string,role:string,hint:string,row:int>>"


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _clean(c: Column) -> Column:
    return clean_clause(c, L.CLAUSE_HEADERS, L.CLAUSE_MARKS)


def _tidy(c: Column) -> Column:
    """``_clean`` of what was cut out of a cleaned text."""
    return tidy_clause(c, L.CLAUSE_HEADERS, L.CLAUSE_MARKS)


def _filled(c: Column) -> Column:
    return F.filter(c, lambda x: x != "")


def column_role(kind: Column, given: Column, title: Column, path: Column, text: Column, bbox: Column) -> Column:
    """insured, not_insured or unknown: a paired row's own role, then a phrase that only one
    side has (title before path), then the side of the page where the box's centre lies."""
    t, p = (F.lower(normalise_space(c)) for c in (title, path))
    yes, no = (lambda c: c.contains(L.INSURED)), (lambda c: c.contains(L.NOT_INSURED))
    centre = F.when(F.size(bbox) == 4, (F.get(bbox, F.lit(0)) + F.get(bbox, F.lit(2))) / 2)
    condition = bound(F.lower(normalise_space(text)), lambda x: _any([x.startswith(s) for s in ("als ", "- als ", "• als ")]))
    return (
        F.when(kind == "table_paired_row", F.coalesce(F.nullif(given, F.lit("")), F.lit("unknown")))
        .when(yes(t) & ~no(t), "insured")
        .when(no(t) & ~yes(t), "not_insured")
        .when(yes(p) & ~no(p), "insured")
        .when(no(p) & ~yes(p), "not_insured")
        .when((yes(t) | no(t) | yes(p) | no(p)) & centre.isNotNull(), F.when(centre < L.COLUMN_SPLIT, "insured").otherwise("not_insured"))
        .when((centre >= L.COLUMN_SPLIT) & condition, "not_insured")
        .otherwise("unknown")
    )


def section_id(path: Column, page: Column, title: Column, chunk_id: Column) -> Column:
    """The path; without one the page with the title, without that the page with the chunk."""
    p, t = normalise_space(path), normalise_space(title)
    return F.when(p != "", p).otherwise(F.concat(F.lit("p"), page, F.lit(":"), F.when(t != "", t).otherwise(chunk_id)))


def inline_bullets(c: Column, clean: Callable[[Column], Column] = _clean) -> Column:
    """Items of a text with bullets inside; what stands before the first opens every item."""

    def items(parts: Column, head: Column) -> Column:
        rest = _filled(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), _tidy))
        led = F.transform(rest, lambda x: F.when(head == "", x).otherwise(_tidy(F.concat_ws(" ", head, x))))
        return F.when(F.size(parts) > 1, led).otherwise(_filled(F.array(head)))

    cut = lambda x: F.when(_any([x.contains(b) for b in L.BULLETS]), F.split(x, rf"\s*[{L.BULLETS}]\s*")).otherwise(F.array(x))
    return bound(bound(clean(c), cut), lambda parts: bound(F.trim(F.get(parts, F.lit(0))), lambda head: items(parts, head)))


def atomic(c: Column, clean: Callable[[Column], Column] = _clean) -> Column:
    """Atomic clauses of a text: bullets, then sentences, dependent ones with their leader."""
    cut = lambda x: merge_dependent(_filled(F.transform(sentences(x, L.ABBREVIATIONS, L.FOLLOW), _tidy)), L.DEPENDENT)
    return F.flatten(F.transform(inline_bullets(c, clean), cut))


def _fragments(texts: Column, role: Column, hint, row: Column | None = None, own: bool = False) -> Column:
    """Clauses of each cleaned text, under the hint of the text, found once, or each its ``own`` hint."""
    clause = lambda x, h: F.struct(x.alias("text"), role.alias("role"), h.alias("hint"), (F.lit(None) if row is None else row).cast("int").alias("row"))
    one = lambda t: F.transform(atomic(t, _tidy), lambda x: clause(x, hint(x).cast("string"))) if own else bound(hint(t).cast("string"), lambda h: F.transform(atomic(t, _tidy), lambda x: clause(x, h)))
    return F.flatten(F.transform(texts, one)).cast(_FRAGMENT)


def _text(text: Column, title: Column, role: Column) -> Column:
    segments = _filled(F.transform(F.split(_clean(text), r"\s+(?=(?:" + "|".join(map(re.escape, L.MARKERS)) + "))"), F.trim))

    def hint(low: Column) -> Column:
        return F.when(_any([low.startswith(s) for s in L.LIMIT_STARTS]), "limit").when(_any([low.startswith(s) for s in L.CONDITION_STARTS]), "condition").when(title.contains(L.NEVER_TEXT_TITLE), "not_covered")

    return _fragments(segments, role, lambda t: bound(F.lower(t), hint))


def _list(text: Column, title: Column, role: Column) -> Column:
    lines = _filled(F.transform(F.split(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), "\n"), _clean))
    hint = F.when(title.startswith(L.COVERED_LIST_TITLE), "covered").when((role == "not_insured") | title.contains(L.NEVER_LIST_TITLE), "not_covered")
    return _fragments(lines, role, lambda _: hint)


def _paired(pairs: Column) -> Column:
    def row(p: Column) -> Column:
        side = lambda c, hint: _fragments(F.array(_clean(p[c])), F.lit(c), lambda _: F.lit(hint), F.coalesce(p["row_idx"], F.lit(0)))
        return F.concat(side("insured", None), side("not_insured", "not_covered"))

    return F.flatten(F.transform(F.filter(pairs, lambda p: p.isNotNull()), row)).cast(_FRAGMENT)


def _cells(row: Column) -> Column:
    return _filled(F.coalesce(F.transform(row["cells"], lambda c: _clean(c["text"])), F.array().cast("array<string>")))


def _repair(cells: Column) -> Column:
    """Rows of repair rules; those that only grant full payment go."""
    texts = _filled(F.transform(cells, lambda c: _clean(F.array_join(c, " "))))
    kept = F.filter(texts, lambda x: bound(F.lower(x), lambda low: ~(low.contains(L.FULL_PAYMENT) & ~low.contains(L.OWN_PAYMENT) & ~low.contains(L.NO_PAYMENT))))
    hint = lambda low: F.when(low.contains(L.NO_PAYMENT), "not_covered").when(low.contains(L.OWN_PAYMENT), "condition")
    return _fragments(kept, F.lit("unknown"), lambda x: bound(F.lower(x), hint), own=True)


def _value(cells: Column) -> Column:
    return bound(cells, _rules).cast(_FRAGMENT)


def _rules(cells: Column) -> Column:
    """Each row of an age and two rules, below a header, as a condition and a limit."""
    body = F.filter(F.slice(cells, 2, F.greatest(F.size(cells) - 1, F.lit(0))), lambda c: F.size(c) >= 3)
    say = lambda c, words, i, hint: F.struct(F.concat(F.get(c, F.lit(0)), F.lit(f". {words} "), F.get(c, F.lit(i)), F.lit(".")).alias("text"), F.lit("unknown").alias("role"), F.lit(hint).alias("hint"), F.lit(None).cast("int").alias("row"))
    both = F.flatten(F.transform(body, lambda c: F.array(say(c, L.FIRST_YEAR, 1, "condition"), say(c, L.LATER_YEARS, 2, "limit"))))
    return F.when(F.size(cells) >= 3, both).otherwise(F.array())


def skipped(c: Column) -> Column:
    """Clauses that say nothing of a policy: empty, bare numbers, listed phrases."""
    return _says_nothing(F.lower(_clean(c)))


def _says_nothing(c: Column) -> Column:
    said = lambda low: (low == "") | low.rlike(r"^\d+[.:]?$") | low.isin(*L.SKIP_HEADINGS) | _any([low.contains(p) for p in L.SKIP_PHRASES]) | _any([low.startswith(p) for p in L.SKIP_STARTS])
    return bound(c, said)


def chunk_clauses(chunks: DataFrame) -> DataFrame:
    """One row per clause of (doc_id, chunk_id, chunk_kind, title_text, section_path, text_raw,
    bbox, page_start, pairs, rows); other columns are passed on but pairs and rows.

    ``pairs``: array of (row_idx, insured, not_insured), ``rows``: array of (row_idx, cells);
    where the one that a table's kind needs is null, its text is split. Clauses are numbered
    before the skipped ones go, so ids have gaps.
    """
    c = F.col
    role = column_role(c("chunk_kind"), F.lit(""), c("title_text"), c("section_path"), c("text_raw"), c("bbox"))
    df = chunks.withColumns({"__title": F.lower(normalise_space(c("title_text"))), "__role": role, "__low": F.when(c("chunk_kind") == "table_matrix_chunk", F.lower(normalise_space(c("text_raw"))))})
    plain, cells = _text(c("text_raw"), c("__title"), c("__role")), F.transform("rows", _cells)
    found = (
        F.when((c("chunk_kind") == "table_paired_chunk") & c("pairs").isNotNull(), _paired(c("pairs")))
        .when((c("chunk_kind") == "table_matrix_chunk") & c("rows").isNotNull() & c("__low").contains(L.VALUE_MATRIX), _value(cells))
        .when((c("chunk_kind") == "table_matrix_chunk") & c("rows").isNotNull() & _any([c("__low").contains(p) for p in L.REPAIR_MATRIX]), _repair(cells))
        .when(c("chunk_kind") == "list_chunk", _list(c("text_raw"), c("__title"), c("__role")))
        .otherwise(plain)
    )
    passed = [x for x in chunks.columns if x not in ("pairs", "rows")]
    # a chunk without clauses gives a row without text, which is skipped
    out = df.select(*passed, F.posexplode_outer(found).alias("clause_position", "f")).where(~_says_nothing(F.lower(_tidy(c("f.text")))))
    number = F.concat(c("doc_id"), F.lit(":"), c("chunk_id"), F.lit(":r"), F.coalesce(c("f.row").cast("string"), F.lit("na")), F.lit(":c"), c("clause_position"))
    return out.select(
        *passed, number.alias("clause_id"), section_id(c("section_path"), c("page_start"), c("title_text"), c("chunk_id")).alias("section_id"), "clause_position",
        c("f.row").alias("paired_row_idx"), c("f.role").alias("column_role"), F.coalesce(c("f.hint"), F.lit("")).alias("category_hint"),
        c("f.text").alias("clause_text"), without_end(F.lower(_tidy(c("f.text")))).alias("clause_text_norm"),
    )


def marked(clause_id: Column, role: Column, hint: Column, text: Column) -> Column:
    """A clause under the marks that a model sees: its id, and its role and hint if known."""
    tag = lambda name, c, known: F.when(c.isin(*known), F.concat(F.lit(f" [{name}="), c, F.lit("]"))).otherwise("")
    return F.concat(F.lit("[clause_id="), clause_id, F.lit("]"), tag("column", role, ("insured", "not_insured")), tag("hint", hint, ("not_covered", "covered", "condition", "limit")), F.lit("\n"), F.trim(text))
