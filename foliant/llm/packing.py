"""Operator 2: packing documents into fixed-size sequences by minimum bin slack.

A document's ids (and one end id) are cut into full windows and one remainder of
1 .. capacity-1 ids. Only the histogram of remainder lengths (at most capacity-1 numbers,
whatever the size of the corpus) reaches the driver. There a bitset subset-sum dynamic
programme picks, for the longest remaining length, the multiset of other lengths that
fills the window closest to its capacity; the backtracked counts are applied as often as
the histogram allows, so the number of patterns is bounded by the number of lengths. If no
multiset fills the window, the remainders of that length are cut into their binary parts,
which return to the histogram (powers of two always fill windows in the end).

Documents meet their slots by rank: a rank inside (length, salt) plus the offset of that
group, so that one length may hold any share of the rows.

Defined results: null or empty text is the end id alone (one id). Null or repeated ids and
repeated rows are packed as rows of their own. An empty table gives no rows. Other columns
of the input are not read.
"""

from __future__ import annotations

import array
import base64
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import durable

#: Where cutting at single spaces would not respect the pre-tokeniser: runs of spaces, a
#: space beside other white space, or a space at either end.
_ODD = re.compile(r"  |[^\S ] | [^\S ]|^ | $|^\s|\s$")
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a text as little-endian unsigned 32-bit bytes.

    Texts are cut before single spaces, where the byte-level pre-tokeniser always cuts too,
    and the pieces' ids are kept in a bounded cache. Texts with odd white space are encoded
    whole, and texts that hold the special token's string go through ``tokenizers`` itself.
    """

    def __init__(self, tokenizer_path: str, ranks_path: str, cache_size: int = 300_000):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encode = tiktoken.Encoding(
            "packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._tokenizer_path, self._tokenizer = tokenizer_path, None
        encode = self._encode

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                found = array.array("I", encode(" " + piece)).tobytes()
                if len(self) < cache_size and len(piece) < 40:
                    self[piece] = found
                return found

        self._of_piece = Pieces().__getitem__

    def __call__(self, text: str) -> bytes:
        if _SPECIAL in text:
            if self._tokenizer is None:
                from tokenizers import Tokenizer

                self._tokenizer = Tokenizer.from_file(self._tokenizer_path)
            return array.array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if not text or _ODD.search(text):
            return array.array("I", self._encode(text)).tobytes()
        head, *rest = text.split(" ")
        return array.array("I", self._encode(head)).tobytes() + b"".join(map(self._of_piece, rest))


@dataclass
class PackPlan:
    """What the executors need: for each length, which slots the items of each rank get."""

    capacity: int
    n_sequences: int = 0
    whole: dict[int, int] = field(default_factory=dict)  # length -> ranks below this stay whole
    part_base: dict[tuple[int, int], int] = field(default_factory=dict)  # (cut length, part) -> first rank
    starts: dict[int, list[int]] = field(default_factory=dict)  # length -> first rank of each interval
    slots: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)  # (first sequence, per sequence, offset)

    def place(self, length: int, rank: int) -> tuple[int, int]:
        """(sequence, offset) of the item of this length and rank."""
        i = bisect_right(self.starts[length], rank) - 1
        first, per, offset = self.slots[length][i]
        q, r = divmod(rank - self.starts[length][i], per)
        return first + q, offset + r * length


def _fill(room: int, avail: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """Counts of lengths whose sum is closest to room from below."""
    bits, mask, steps = 1, (1 << (room + 1)) - 1, []
    for x in lengths:
        if x > room:
            continue
        left, chunk = min(avail[x], room // x), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((x, take, bits))
            bits |= (bits << (x * take)) & mask
            left, chunk = left - take, chunk * 2
        if bits >> room & 1:
            break
    total, counts = bits.bit_length() - 1, {}
    for x, take, before in reversed(steps):
        if not before >> total & 1:
            total -= x * take
            counts[x] = counts.get(x, 0) + take
    return counts


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> PackPlan:
    """Pack lengths 1 .. capacity-1, each so many times, into windows of the capacity."""
    plan = PackPlan(capacity)
    avail = {x: n for x, n in histogram.items() if n > 0}
    known = dict(avail)  # ranks handed out so far for each length
    used = dict.fromkeys(avail, 0)
    plan.whole = dict(avail)
    while avail:
        lengths = sorted(avail, reverse=True)
        top = lengths[0]
        avail[top] -= 1
        counts = _fill(capacity - top, avail, [x for x in lengths if avail[x]])
        avail[top] += 1
        counts[top] = counts.get(top, 0) + 1
        total = sum(x * m for x, m in counts.items())
        if total != capacity and top & (top - 1):
            # no multiset fills the window: the rest of this length is cut into binary parts
            n = avail.pop(top)
            plan.whole[top] = used[top]
            for k in range(top.bit_length() - 1, -1, -1):
                if top >> k & 1:
                    part = 1 << k
                    plan.part_base[top, part] = known.get(part, 0)
                    known[part] = known.get(part, 0) + n
                    plan.whole.setdefault(part, 0)
                    used.setdefault(part, 0)
                    avail[part] = avail.get(part, 0) + n
            continue
        if total != capacity:
            # a power of two needs no padding: as many of its like as make up the next one
            counts = {top: min(1 << (avail[top].bit_length() - 1), 1 << ((capacity // top).bit_length() - 1))}
        times = min(avail[x] // m for x, m in counts.items())
        offset = 0
        for x, m in sorted(counts.items(), reverse=True):
            plan.starts.setdefault(x, []).append(used[x])
            plan.slots.setdefault(x, []).append((plan.n_sequences, m, offset))
            used[x] += m * times
            avail[x] -= m * times
            if not avail[x]:
                del avail[x]
            offset += x * m
        plan.n_sequences += times
    return plan


def _tokens(capacity: int, tokenizer_path: str, ranks_path: str, end_id: int, with_ids: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, row = Encoder(tokenizer_path, ranks_path), end_id.to_bytes(4, "little"), 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, len(batch), 256):
                out: list[list] = [[] for _ in schema]
                for text in texts.slice(at, 256).to_pylist():
                    raw = encode(text or "") + end
                    n = len(raw) // 4
                    full, rest = divmod(n, capacity)
                    tail = raw[full * capacity * 4 :]
                    parts, p = [], 0
                    for k in range(rest.bit_length() - 1, -1, -1):
                        if rest >> k & 1:
                            parts.append(zlib.crc32(tail[p : p + 4 * (1 << k)]))
                            p += 4 * (1 << k)
                    step = 4 * capacity
                    values = (n, full, rest, [zlib.crc32(raw[j * step : (j + 1) * step]) for j in range(full)], zlib.crc32(tail), parts, row)
                    row += 1
                    for column, v in zip(out[1:], (*values, *([raw] if with_ids else [])), strict=True):
                        column.append(v)
                out[0] = ids.slice(at, 256)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) if isinstance(c, list) else c.cast(t.type) for c, t in zip(out, schema, strict=True)], schema=schema)

    return run


def _place(plan: PackPlan, full_base: dict[int, int], with_ids: bool, schema: pa.Schema):
    cap = plan.capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                out: list[list] = [[] for _ in schema]

                def put(*values: object, out: list[list] = out) -> None:
                    for column, v in zip(out, values, strict=True):
                        column.append(v)

                for r in batch.slice(at, 2048).to_pylist():
                    raw, doc, n, rest = r.get("ids"), r["doc_id"], r["n_tokens"], r["rest"]
                    cut = (lambda a, m, raw=raw: (raw[4 * a : 4 * (a + m)],)) if with_ids else (lambda a, m: ())
                    for j, crc in enumerate(r["full_crc"]):
                        seq = plan.n_sequences + full_base[rest] + r["full_rank"] + j
                        put(doc, j * cap, cap, crc, n, seq, 0, *cut(j * cap, cap))
                    start, rank = r["n_full"] * cap, r["rank"]
                    if rest and rank < plan.whole[rest]:
                        put(doc, start, rest, r["rest_crc"], n, *plan.place(rest, rank), *cut(start, rest))
                    elif rest:
                        crcs = iter(r["part_crc"])
                        for k in range(rest.bit_length() - 1, -1, -1):
                            if rest >> k & 1:
                                m = 1 << k
                                put(doc, start, m, next(crcs), n, *plan.place(m, plan.part_base[rest, m] + rank - plan.whole[rest]), *cut(start, m))
                                start += m
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, schema, strict=True)], schema=schema)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 1024,
    end_id: int = 0,
    group_rows: int = 4096,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``with_ids``, the piece's ids as little-endian 32-bit binary.

    ``group_rows``: about so many rows are ranked together, however often a length occurs.
    """
    fields = [("doc_id", pa.int64(), "long"), ("n_tokens", pa.int64(), "long"), ("n_full", pa.int64(), "long"), ("rest", pa.int32(), "int"), ("full_crc", pa.list_(pa.int64()), "array<long>"), ("rest_crc", pa.int64(), "long"), ("part_crc", pa.list_(pa.int64()), "array<long>"), ("row", pa.int64(), "long")]
    fields += [("ids", pa.binary(), "binary")] * with_ids
    tokens = durable(
        docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
            _tokens(capacity, tokenizer_path, ranks_path, end_id, with_ids, pa.schema([f[:2] for f in fields])),
            ", ".join(f"{n} {t}" for n, _, t in fields),
        )
    )
    stats = {r.rest: (r.n, r.f) for r in tokens.groupBy("rest").agg(F.count(F.lit(1)).alias("n"), F.sum("n_full").alias("f")).collect()}
    plan = minimum_bin_slack({x: n for x, (n, _) in stats.items() if x}, capacity)
    full_base, total = {}, 0
    for x in sorted(stats):
        full_base[x], total = total, total + stats[x][1]
    salts = max(1, -(-sum(n for n, _ in stats.values()) // group_rows))
    salted = tokens.withColumn("salt", F.pmod(F.xxhash64("row", "doc_id", "rest_crc"), F.lit(salts)))
    groups = salted.groupBy("rest", "salt").agg(F.count(F.lit(1)).alias("n"), F.sum("n_full").alias("f"))
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("rest", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("f").over(before), F.lit(0)).alias("f0"))
    inside = Window.partitionBy("rest", "salt").orderBy("doc_id", "row", "n_tokens", "rest_crc")
    ranked = (
        salted.withColumn("r0", F.row_number().over(inside) - 1)
        .withColumn("s0", F.coalesce(F.sum("n_full").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .join(groups, ["rest", "salt"])
    )
    ranked = ranked.select("doc_id", "n_tokens", "n_full", "rest", "full_crc", "rest_crc", "part_crc", (F.col("n0") + F.col("r0")).alias("rank"), (F.col("f0") + F.col("s0")).alias("full_rank"), *(["ids"] if with_ids else []))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("ids", pa.binary())] * with_ids)
    return ranked.mapInArrow(_place(plan, full_base, with_ids, schema), ", ".join(f"{n} long" for n in names) + ", ids binary" * with_ids)
