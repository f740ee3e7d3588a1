"""Context-triggered piecewise hashing: fingerprints of documents and their likeness.

A rolling hash over seven bytes of UTF-8 ends a chunk where it is -1 modulo the block size; a chunk's hash gives one
of 64 letters. The block size is 3 * 2^k, the least that expects at most 64 chunks, halved while the signature has
under 32 letters. A fingerprint is `size:signature:signature at twice the size`. Signatures at one block size compare
by edit distance, if they have a common run of seven letters (or of the shorter's length); others are unlike.

Defined cases: null is empty; an empty text has the fingerprint `3::`, which is like itself alone; equal texts have
equal fingerprints; repeated rows (equal id and text) count as one document and each get its row; texts of one id come by
hash; null ids come last; an empty table gives no rows; a long text takes some 50 bytes a byte; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.common import columns, materialize

WINDOW, LENGTH, LEAST = 7, 64, 3
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
#: Documents of a range that one task goes through in order.
RANGE_ROWS = 4_000
_ROOT = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_ROOT), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        with np.errstate(over="ignore"):
            for k, root in enumerate((_ROOT, _BACK)):
                steps = np.full(size, root, np.uint64)
                steps[0] = 1
                _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def fingerprint(text: str | None) -> str:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = len(data)
    if not n:
        return f"{LEAST}::"
    power, back = _grown(n + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(data.astype(np.uint64) * power[:n] + power[:n], out=prefix[1:])
        begin = np.maximum(np.arange(1, n + 1) - WINDOW, 0)
        rolling = _mixed((prefix[1:] - prefix[begin]) * back[begin])
        # uniform over the block size's multiples of LEAST: a trigger at 2s is one at s
        hashed = (rolling >> np.uint64(33)).astype(np.int64)
        size = LEAST
        while size * LENGTH < n:
            size *= 2

        def signature(size: int) -> str:
            ends = np.flatnonzero(hashed % size == size - 1) + 1
            if len(ends) >= LENGTH:
                ends = ends[: LENGTH - 1]
            if not len(ends) or ends[-1] < n:
                ends = np.append(ends, n)
            starts = np.append(0, ends[:-1])
            letters = _mixed((prefix[ends] - prefix[starts]) * back[starts]) >> np.uint64(58)
            return "".join([LETTERS[k] for k in letters.tolist()])

        found = signature(size)
        while len(found) < LENGTH // 2 and size > LEAST:
            size //= 2
            found = signature(size)
        return f"{size}:{found}:{signature(2 * size)}"


def distance(a: str, b: str) -> int:
    """Edit distance by bit vectors (Myers 1999, Hyyrö 2001)."""
    if not a or not b:
        return len(a) + len(b)
    masks: dict[str, int] = {}
    for k, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for y in b:
        eq = masks.get(y, 0)
        zero = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | ~(zero | up) & full, up & zero
        if plus & top:
            score += 1
        if minus & top:
            score -= 1
        plus = (plus << 1 | 1) & full
        up, down = (minus << 1) & full | ~(zero | plus) & full, plus & zero
    return score


def _alike(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    run = min(WINDOW, len(a), len(b))
    runs = {a[k : k + run] for k in range(len(a) - run + 1)}
    if not any(b[k : k + run] in runs for k in range(len(b) - run + 1)):
        return 0.0
    return 1.0 - distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 for block sizes that don't meet."""
    if a == b:
        return 1.0
    (s, a1, a2), (t, b1, b2) = a.split(":"), b.split(":")
    s, t = int(s), int(t)
    if s == t:
        return max(_alike(a1, b1), _alike(a2, b2))
    if s == 2 * t:
        return _alike(a1, b2)
    return _alike(a2, b1) if t == 2 * s else 0.0


def edited(text: str, after: str) -> str:
    """text with its last half (rounded down) replaced by as many first characters of after."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint against its edited text's and the next document's, by ascending doc_id.

    Texts move once, to ranges of RANGE_ROWS ids or so; a range's first document also goes to the range before it.
    """
    spark = docs.sparkSession
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    ids = materialize(rows.groupBy("doc_id", "key").agg(F.count("*").alias("copies")), "ids")
    n = ids.count()
    parts = max(1, min(n // RANGE_ROWS, 4096))
    cuts = ids.agg(F.percentile_approx("doc_id", [k / parts for k in range(1, parts)], 100_000).alias("cuts")).first().cuts if parts > 1 else []
    cuts = sorted({*(cuts or [])})
    # a hash of the content comes before the id's own order in nothing: null ids are the last range's last
    bucket = lambda c: F.when(c.isNull(), F.lit(len(cuts))).otherwise(F.expr(_search(cuts)) if cuts else F.lit(0)).cast("int")
    firsts = ids.withColumn("bucket", bucket(F.col("doc_id"))).groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")).orderBy("bucket").collect()
    places = [r.bucket for r in firsts]
    ahead = [(r.first.doc_id, r.first.key, places[k - 1]) for k, r in enumerate(firsts)]  # the first range's goes to the last: the circle closes
    heads = F.broadcast(spark.createDataFrame(ahead, "h_id long, h_key long, h_bucket int"))  # one short row a range, 4096 at most
    d = rows.withColumn("bucket", bucket(F.col("doc_id")))
    d = d.join(heads, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("key") == F.col("h_key")), "left")
    spread = F.when(F.col("h_bucket").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("tail")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("tail")), F.struct(F.col("h_bucket").alias("b"), F.lit(True).alias("tail")))
    )
    d = d.select("doc_id", "key", "text", F.explode(spread).alias("at")).select("at.b", "at.tail", "doc_id", "key", "text")
    order = ["b", "tail", F.col("doc_id").asc_nulls_last(), "key"]
    d = d.repartitionByRange("b").sortWithinPartitions(*order)
    return d.mapInArrow(_pairs, SCHEMA)


def _search(cuts: list[int]) -> str:
    """SQL for the number of cuts at or below doc_id, as a balanced tree of comparisons."""

    def tree(low: int, high: int) -> str:
        if low == high:
            return str(low)
        mid = (low + high) // 2
        return f"if(doc_id < {cuts[mid]}, {tree(low, mid)}, {tree(mid + 1, high)})"

    return tree(0, len(cuts))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    def rows():
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                yield from zip(*(part.column(k).to_pylist() for k in range(5)), strict=True)

    out: list[list] = [[] for _ in range(7)]

    def ended() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), *(pa.array(out[k], pa.string()) for k in (2, 3, 4)), *(pa.array(out[k], pa.float64()) for k in (5, 6))],
            names=[x.split()[0] for x in SCHEMA.split(", ")],
        )
        for x in out:
            x.clear()
        return batch

    held, copies = None, 0
    for b, tail, doc_id, key, text in rows():
        if held and (held[0], held[1], held[2], held[3]) == (b, tail, doc_id, key):
            copies += 1
            continue
        mark = fingerprint(text)
        if held and held[0] == b and not held[1]:
            other = edited(held[4], text)
            other_mark = fingerprint(other)
            row = (held[2], len(held[4]), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), held[5], other_mark, likeness(held[5], other_mark), likeness(held[5], mark))
            for _ in range(copies):
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            if len(out[0]) >= 2000:
                yield ended()
        held, copies = (b, tail, doc_id, key, text, mark), 1
    if out[0]:
        yield ended()
