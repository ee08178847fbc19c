"""Canonical JSON against Python's sorted form."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from foliant.functions.json import canonical_json, json_key

SCHEMA = "z long, a string, m map<string, array<double>>, B struct<y: boolean, x: array<struct<k: string, d: double>>>, e struct<n: int>"


def test_canonical_json(spark):
    r = random.Random(5)
    letters = ['"', "\\", "\n", "\t", "\b", "\f", "\r", "\x00", "\x1f", "\x7f", "é", "中", "🙂", "/", "a", " ", " "]
    text = lambda: "".join(r.choices(letters, k=r.randint(0, 9)))
    numbers = [0.0, -0.0, 1.0, -1.5, 0.1, 1e-4, 1e-5, 9.5e-5, 0.00123, 123456.789, 1e15, 9999999999999998.0, 1e16, 1.5e16, 1.5e300, 1e100, 1e-300, 5e-324, 1e7, 12345678.0, 1.7976931348623157e308, 100.0, 2.5e22, 1e22, 1e23]
    num = lambda: r.choice([*numbers, round(r.uniform(-1e9, 1e9), 3), r.random(), r.random() * 1e-6])
    rows = []
    for _ in range(300):
        maybe = lambda x: None if r.random() < 0.15 else x
        rows.append((maybe(r.randint(-(2**60), 2**60)), maybe(text()), maybe({text(): maybe([maybe(num()) for _ in range(r.randint(0, 3))]) for _ in range(r.randint(0, 4))}), maybe((maybe(r.random() < 0.5), maybe([maybe((maybe(text()), maybe(num()))) for _ in range(r.randint(0, 3))]))), maybe((maybe(3),))))
    df = spark.createDataFrame(rows, SCHEMA)
    whole, kind = F.struct(*df.columns), df.schema
    got = df.select(canonical_json(whole, kind).alias("j"), json_key(whole, kind).alias("k")).collect()
    for (z, a, m, b, e), g in zip(rows, got, strict=True):
        value = {"z": z, "a": a, "m": m, "B": b and {"y": b[0], "x": b[1] and [x and {"k": x[0], "d": x[1]} for x in b[1]] if b[1] is not None else None}, "e": e and {"n": e[0]}}
        if b and b[1] == []:
            value["B"]["x"] = []
        want = json.dumps(value, sort_keys=True, ensure_ascii=False)
        at = next((i for i, (x, y) in enumerate(zip(g.j, want)) if x != y), None)
        assert g.j == want, (at, g.j[at - 30 : at + 30], want[at - 30 : at + 30])
        assert g.k == hashlib.sha256(want.encode()).hexdigest()[:24]
