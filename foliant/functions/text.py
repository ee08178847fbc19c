"""Column functions on text."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGES = r"(?U)^\s+|\s+$"
_SPACED = r"[^ -~\xA1-\xFF]|  "  # what may be white space other than single spaces


def bound(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is computed once, however often f names it."""
    return F.transform(F.array(c), f)[0]


def normalise_space(c: Column) -> Column:
    """Null to empty, soft hyphens out, every run of white space to one space, trimmed."""
    # a text of Latin letters and single spaces is left as it is, which a look at its bytes tells
    spaced = lambda x: F.when(x.rlike(_SPACED), F.regexp_replace(x, r"(?U)\s+", " ")).otherwise(x)
    return F.trim(bound(F.replace(F.coalesce(c, F.lit("")), F.lit("­"), F.lit("")), spaced))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, _EDGES, "")


def clean_clause(c: Column, headers: str = "", marks: str = r"•\-–—") -> Column:
    """Normalised text without leading ``marks`` and, if given, a leading header phrase."""
    return tidy_clause(F.replace(normalise_space(c), F.lit("�"), F.lit("€")), headers, marks)


def tidy_clause(c: Column, headers: str = "", marks: str = r"•\-–—") -> Column:
    """``clean_clause`` of a text whose white space is normalised."""
    x = F.regexp_replace(c, rf"^[{marks}\s]+", "")
    return F.trim(F.regexp_replace(x, f"(?i)^(?:{headers})", "") if headers else x)


def normalised_clause(c: Column, headers: str = "", marks: str = r"•\-–—") -> Column:
    return without_end(F.lower(clean_clause(c, headers, marks)))


def without_end(c: Column) -> Column:
    return F.regexp_replace(c, r"[.:;,]+$", "")


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"(?U)\s+"), lambda x: x != ""))


def sentences(c: Column, abbreviations: tuple[str, ...] = (), follow: str = "") -> Column:
    """Cut at white space between a sentence end and an upper-case letter or digit, but not
    after an abbreviation, nor between a question and the word that follows it up."""
    held = "".join(f"(?<!{re.escape(a)})" for a in abbreviations)
    held += rf"(?!(?<=\?) {re.escape(follow)} )" if follow else ""
    return F.split(c, rf"(?U)(?<=[.!?]){held}\s+(?=[A-ZÀ-Ý0-9])")


def merge_dependent(parts: Column, prefixes: tuple[str, ...]) -> Column:
    """Append a sentence to the one before if that ends in a question mark or it starts with
    one of the prefixes, regardless of case. The parts are computed once."""

    def starts(x: Column) -> Column:
        out = F.lit(False)
        for p in prefixes:
            out = out | F.lower(x).startswith(p.lower())
        return out

    def merged(parts: Column) -> Column:
        before = F.concat(F.array(F.lit(None).cast("string")), F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))))
        places = F.sequence(F.lit(1), F.size(parts))
        alone = F.zip_with(places, F.zip_with(parts, before, lambda x, y: y.isNull() | ~(y.endswith("?") | starts(x))), lambda i, own: F.when(own, i))
        # from each sentence that stands alone up to the next one
        until = lambda at: F.concat(F.slice(at, 2, F.size(at)), F.array(F.size(parts) + 1))
        return bound(F.array_compact(alone), lambda at: F.zip_with(at, until(at), lambda i, j: F.array_join(F.slice(parts, i, j - i), " ")))

    return bound(F.coalesce(parts, F.array().cast("array<string>")), lambda p: F.when(F.size(p) > 0, merged(p)).otherwise(p))


def truncate(c: Column, most: int) -> Column:
    """At most ``most`` characters, an ellipsis of three dots included."""
    x = normalise_space(c)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.rtrim(F.substring(x, 1, most - 3)), F.lit("...")))


def truncate_after(c: Column, most: int) -> Column:
    """``most`` characters and an ellipsis after them, if there are more."""
    x = normalise_space(c)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.rtrim(F.substring(x, 1, most)), F.lit("...")))


def escape_html(c: Column, quotes: bool = False) -> Column:
    """The four entities of text and attributes; with ``quotes`` single quotes too."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), *((("'", "&#x27;"),) if quotes else ())):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def short_clause_id(c: Column) -> Column:
    """Of document:chunk:row:clause the last part of the chunk's name and the clause."""
    parts = F.split(F.coalesce(c, F.lit("")), ":")
    return F.when(F.size(parts) >= 2, F.concat(F.element_at(F.split(F.get(parts, F.lit(1)), "_"), -1), F.lit(":"), F.element_at(parts, -1))).otherwise(F.coalesce(c, F.lit("")))


def page_reference(pages: Column) -> Column:
    """" (p. 1, 2)" under its mark; empty without pages."""
    return F.when(F.size(F.coalesce(pages, F.array().cast("array<int>"))) > 0, F.concat(F.lit(" <span class='page-ref'>(p. "), F.array_join(pages.cast("array<string>"), ", "), F.lit(")</span>"))).otherwise("")


def integer_or(c: Column, default: int | None = None) -> Column:
    """Text as an integer, the default if it is none."""
    return F.coalesce(F.trim(c).try_cast("int"), F.lit(default).cast("int"))


def box_of(c: Column) -> Column:
    """Four numbers of JSON text; null for "null", other lengths and what can't be read."""
    box = F.from_json(c, "array<double>")
    return F.when((F.size(box) == 4) & ~F.exists(box, lambda x: x.isNull()), box)


def ids_of(c: Column) -> Column:
    """A JSON list of ids; text that is no list is one id, blank text none."""
    x = F.trim(F.coalesce(c, F.lit("")))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.coalesce(F.when(x.startswith("["), F.from_json(x, "array<string>")), F.array(x)))


def section_path(hierarchy: Column, headers: Column) -> Column:
    """Header texts of {level: block id} in numeric order of the levels, joined by " > ";
    empty if a level is no integer; missing headers are left out."""
    entries = F.transform(F.map_entries(hierarchy), lambda e: F.struct(e["key"].try_cast("int").alias("level"), e["value"].alias("id")))
    names = F.transform(F.array_sort(entries), lambda e: F.try_element_at(headers, e["id"]))
    named = F.array_join(F.filter(names, lambda x: x.isNotNull() & (x != "")), " > ")
    return F.when(F.exists(entries, lambda e: e["level"].isNull()), "").otherwise(F.coalesce(named, F.lit("")))
