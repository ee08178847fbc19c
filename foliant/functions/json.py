"""Nested values as JSON text of one form, whatever the order of their keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions.text import bound

#: Characters that JSON texts escape by a letter.
_ESCAPED = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f"))


def quoted(c: Column) -> Column:
    """A string in quotes; control characters are escaped, others stay as they are."""
    for a, b in _ESCAPED:
        c = F.replace(c, F.lit(a), F.lit(b))
    short = "\b\t\n\f\r"
    for i in (i for i in range(32) if chr(i) not in short):
        c = F.replace(c, F.lit(chr(i)), F.lit(f"\\u{i:04x}"))
    return F.concat(F.lit('"'), c, F.lit('"'))


def number(c: Column) -> Column:
    """A double with the fewest digits that tell it from others: plain from 0.0001 up to below
    1e16, with an exponent of two digits at least elsewhere."""
    return bound(c, lambda x: F.when(F.isnan(x), "NaN").when(F.abs(x) == float("inf"), F.when(x > 0, "Infinity").otherwise("-Infinity")).when(x == 0, F.when(x.cast("string").startswith("-"), "-0.0").otherwise("0.0")).otherwise(F.concat(F.when(x < 0, "-").otherwise(""), bound(_digits(F.abs(x)), _written))))


def _digits(x: Column) -> Column:
    """The fewest digits of a positive double, as a whole number m without a last zero and the
    place p of the point: 0.m times ten to the power of p."""
    part = lambda s, i: F.regexp_extract(s, r"^(\d+)(?:\.(\d+))?(?:E(-?\d+))?$", i)
    known = bound(x.cast("string"), lambda s: F.struct(F.concat(part(s, 1), part(s, 2)).alias("d"), (F.length(part(s, 1)) + F.coalesce(part(s, 3).try_cast("int"), F.lit(0))).alias("p")))
    bare = bound(known, lambda k: F.struct(F.regexp_replace(k["d"], "^0+|0+$", "").cast("bigint").alias("m"), (k["p"] - F.length(k["d"]) + F.length(F.regexp_replace(k["d"], "^0+", ""))).alias("p")))

    def fewest(k: Column) -> Column:
        # the string may have more digits than it takes: the first rounding that is the same double
        n = F.length(k["m"].cast("string"))
        tens = lambda i: F.pow(F.lit(10.0), n - i).cast("bigint")
        tries = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.floor((k["m"] + F.floor(tens(i) / 2).cast("bigint")).cast("decimal(20,0)") / tens(i).cast("decimal(20,0)")).cast("bigint").alias("m"), (k["p"] - i).alias("e")))
        same = F.filter(tries, lambda t: F.concat(t["m"].cast("string"), F.lit("E"), t["e"].cast("string")).cast("double") == x)
        return bound(F.get(same, F.lit(0)), lambda t: F.struct(F.regexp_replace(t["m"].cast("string"), "0+$", "").alias("m"), (F.length(t["m"].cast("string")) + t["e"]).alias("p")))

    return bound(bare, fewest)


def _written(d: Column) -> Column:
    m, p, n = d["m"], d["p"], F.length(d["m"])
    zeros = lambda k: F.repeat(F.lit("0"), k)
    plain = F.when(p <= 0, F.concat(F.lit("0."), zeros(-p), m)).when(n <= p, F.concat(m, zeros(p - n), F.lit(".0"))).otherwise(F.concat(F.substring(m, F.lit(1), p), F.lit("."), F.substring(m, p + 1, n)))
    e = F.abs(p - 1).cast("string")
    far = F.concat(F.substring(m, 1, 1), F.when(n > 1, F.concat(F.lit("."), F.substring(m, F.lit(2), n))).otherwise(""), F.when(p < 1, "e-").otherwise("e+"), F.when(F.length(e) < 2, F.concat(F.lit("0"), e)).otherwise(e))
    return F.when(p.between(-3, 16), plain).otherwise(far)


def canonical_json(c: Column, kind: T.DataType) -> Column:
    """A value of a type as JSON text: keys of structs and maps sorted by their code points, ", "
    and ": " between, nulls kept. Types without a JSON form are written as strings."""
    if isinstance(kind, T.StructType):
        parts = [F.concat(quoted(F.lit(f.name)), F.lit(": "), canonical_json(c.getField(f.name), f.dataType)) for f in sorted(kind.fields, key=lambda f: f.name)]
        out = F.when(c.isNotNull(), F.concat(F.lit("{"), F.concat_ws(", ", *parts) if parts else F.lit(""), F.lit("}")))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical_json(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(e["key"].cast("string").alias("k"), canonical_json(e["value"], kind.valueType).alias("v"))))
        out = F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: F.concat(quoted(e["k"]), F.lit(": "), e["v"])), ", "), F.lit("}"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        out = number(c.cast("double"))
    elif isinstance(kind, (T.IntegralType, T.BooleanType)):
        out = c.cast("string")
    elif isinstance(kind, T.DecimalType):
        out = c.cast("string") if kind.scale == 0 else number(c.cast("double"))
    else:
        out = quoted(c.cast("string"))
    return F.coalesce(out, F.lit("null"))


def json_key(c: Column, kind: T.DataType, digits: int = 24) -> Column:
    """The first hex digits of the SHA-256 digest of the value's canonical JSON."""
    return F.substring(F.sha2(canonical_json(c, kind), 256), 1, digits)
