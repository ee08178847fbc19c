"""How alike a quote and a text are, and quotes on pages."""

from __future__ import annotations

from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalised(c: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))


def _bounds(quote: str, text: str) -> np.ndarray:
    """For each stretch of the text of the quote's length a number of characters that no more
    than can match: those that both have, at whatever places, and by the pairs of neighbours that
    both have. Where blocks of matching characters part, a character of either doesn't match, so
    p common pairs leave at most (p + 1 + 2 n) / 3 of n."""
    n, chars = len(quote), np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    own = np.frombuffer(quote.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)

    def common(mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        # a place of the text counts in the stretches that hold it and not too many of its kind before it
        size, stretches = len(mine), len(theirs) - len(mine) + 1
        kinds, many = np.unique(mine, return_counts=True)
        kind = np.minimum(np.searchsorted(kinds, theirs), len(kinds) - 1)
        at = np.flatnonzero(kinds[kind] == theirs)
        at = at[np.argsort(kind[at], kind="stable")]
        kind = kind[at]
        before = np.arange(len(at)) - many[kind]
        since = np.where(before >= np.searchsorted(kind, kind), at[np.maximum(before, 0)] + 1, 0)
        first, after = np.minimum(np.maximum(since, at - size + 1), stretches), np.minimum(at + 1, stretches)
        return np.cumsum(np.bincount(first, minlength=stretches + 1) - np.bincount(after, minlength=stretches + 1))[:stretches]

    pairs = common(own[:-1] << 21 | own[1:], chars[:-1] << 21 | chars[1:])
    return np.minimum(common(own, chars), (pairs + 1 + 2 * n) / 3)


def may_reach(quote: str, text: str, floor: float) -> bool:
    """False only if the similarity is below the floor. Blocks of matching characters part where
    a character of either text doesn't match. At a score of the floor at most e of them don't, so
    of e + 1 pieces of the quote at least one lies whole in a block, and in the text."""
    n, m = len(quote), len(text)
    if quote in text or text in quote:
        return True
    most = [2 * int((1 - floor) * n + 1e-6)] if 10 <= n <= m else []
    if 2 * min(n, m) >= (floor - 1e-9) * (n + m):
        most.append(int((1 - floor) * (n + m) + 1e-6))
    if not most:
        return False
    pieces = max(most) + 1
    return pieces > n or any(quote[i * n // pieces : (i + 1) * n // pieces] in text for i in range(pieces))


def similarity(quote: str, text: str, floor: float = 0.0) -> float:
    """1 if either holds the other; else the best ratio of the quote against the text and,
    from 10 characters on, against every stretch of the text of the quote's length.

    Stretches are tried from the best bound down, until none is above what was found or can
    reach the floor; a result below the floor says only that."""
    if quote in text or text in quote:
        return 1.0
    n, best = len(quote) + len(text), 0.0
    if 10 <= len(quote) <= len(text):
        shared = _bounds(quote, text)
        for i in np.argsort(-shared, kind="stable"):
            if shared[i] / len(quote) <= best or shared[i] / len(quote) < floor:
                break
            best = max(best, SequenceMatcher(None, quote, text[i : i + len(quote)]).ratio())
    # last, as a long text rarely has room for a better ratio as a whole
    most = 2 * min(len(quote), len(text)) / n if n else 0.0
    if most >= floor and most > best:
        best = max(best, SequenceMatcher(None, quote, text).ratio())
    return best


def quote_position(text: Column, quote: Column) -> Column:
    """Place (from 1) of a quote in a text, regardless of case: the whole quote, else what the
    first 150, 80 or 50 characters hold up to their last space; 0 if there is none."""
    t, q = normalised(text), normalised(quote)
    cut = lambda n: F.regexp_replace(F.substring(q, 1, n), " [^ ]*$", "")
    at = lambda x: F.nullif(F.when(x != "", F.instr(t, x)), F.lit(0))
    return F.coalesce(at(q), F.when(F.length(q) > 150, at(cut(150))), F.when(F.length(q) > 80, at(cut(80))), at(cut(50)), F.lit(0))


def quoted_pages(items: DataFrame, pages: DataFrame, keys: list[str], *, quote: str = "exact_quote", on: str = "source_pages") -> DataFrame:
    """Items (keys and item_id) with the first of their pages, in the order given, that holds
    the quote, and the place there; pages: doc_id, page_no, text. Items without one drop out."""
    each = items.select(*keys, "item_id", quote, F.posexplode(on).alias("__at", "page_no"))
    hit = each.join(pages.select(*keys, "page_no", "text"), [*keys, "page_no"]).withColumn("position", quote_position(F.col("text"), F.col(quote))).where("position > 0")
    return hit.groupBy(*keys, "item_id").agg(F.min_by(F.struct("page_no", "position"), "__at").alias("x")).select(*keys, "item_id", "x.*")
