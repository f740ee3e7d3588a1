"""N-gram Jaccard join: components of documents whose shingle sets link, by a size-aware heavy-light join.

Documents with equal sets are one class; its first document stands for it. Two classes link when 100 * intersection
>= threshold * union. Every linking pair of classes meets in a list:
 - small sets (at most the boundary) enumerate their subsets of the fixed sizes at which a partner may overlap; equal
   subsets meet;
 - large sets, and small ones that a large one may link to, stand in inverted lists of shingles. Of a set only the
   rarest shingles are listed, as many as a partner cannot all lack; rarity is counted over all documents, and a
   shingle of one set alone is in no list.
The boundary is chosen by cost: rows that small sets enumerate, against rows and scans of the lists that they would
stand in, from the numbers of sets of each size and the mean length of lists, both counted on the data.

Classes that share a list form the group of its first class. A group is first compared by sketches (a bit a shingle:
the bits in which two sketches differ are no more than the shingles in which the sets do), which leaves hardly more
than what links; of these the sets are made again from their texts and compared by a sparse product, in one task, or,
beyond BLOCK, by pairs of blocks, so that no task holds more than two blocks and no pair becomes a row: what comes out
is the links of a spanning forest of each product. Components come from the links by label propagation over tables
in the shared folder. Tables go when their last reader is done.

Shingles are 64-bit hashes from one pass of numpy over a batch's bytes; texts are shingled anew in each of four passes,
which takes less room than keeping their sets. Recurring shingles are marked in a bitmap of some 16 bits each, MOST_BITS
at most; beyond that more lists are made than are needed, and none is lost.

Defined cases: null and empty texts, and texts without words, have no shingles and link with nothing; a text of fewer
than `shingle` words is one shingle; repeated rows are of one class; a null doc_id is its own component (null) in
judge(), while first_of_each() lets its text link; an empty table gives no rows; extra columns are kept by
first_of_each(), whatever their names; ids are of any type that has an order; texts may be as long as an Arrow value.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import BROADCAST_ROWS, columns, discard, materialize, small, trimmed

BLOCK, BATCH_BYTES = 512, 1 << 20
#: Bits of the map of recurring shingles at most, shingles a bucket of the count, hashes that a task holds at once, and
#: shingles at most whose frequency is told (the others only recur).
MOST_BITS, BUCKET, HELD, HOT = 1 << 28, 1 << 20, 1 << 21, 1 << 17


@dataclass(frozen=True)
class Settings:
    shingle: int = 4
    percent: int = 85


_ROOT = 0x9E3779B97F4A7C15
_BACK = pow(_ROOT, -1, 1 << 64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int, root: int) -> np.ndarray:
    steps = np.full(n, root, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted uint64 hashes; A-Z are lower-cased, words end at ASCII white space."""
    out: list[np.ndarray] = []
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size < BATCH_BYTES):
            size += len(texts[high] or "")
            high += 1
        out += _sets([(t or "").encode("utf-8", "surrogatepass") for t in texts[low:high]], k)
        low = high
    return out


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of data (bytes that end with a space), and their places."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[0::2], edge[1::2]
    if len(ends) < len(starts):
        ends = np.append(ends, len(data))
    prefix = np.zeros(len(data) + 1, np.uint64)
    # words are short: powers of their own places, from each word's start
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data), _ROOT), out=prefix[1:])
    return _mixed((prefix[ends] - prefix[starts]) * _powers(len(data), _BACK)[starts]), starts


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where to cut data, after a space, so that hashing takes some fifty bytes a byte of a piece, not of a long text."""
    low = 0
    while low < len(data):
        high = min(low + 2 * BATCH_BYTES, len(data))
        while high < len(data) and not (space := _SPACE[data[low:high]]).any():
            high = min(2 * high - low, len(data))
        if high < len(data):
            high = low + int(np.flatnonzero(space)[-1]) + 1
        yield low, high
        low = high


def _sets(parts: list[bytes], k: int) -> list[np.ndarray]:
    data = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)]
    ends_of = np.cumsum([len(p) + 1 for p in parts])
    with np.errstate(over="ignore"):
        found = [(low, *_words(data[low:high])) for low, high in _pieces(data)]
        word, starts = np.concatenate([w for _, w, _ in found]), np.concatenate([low + at for low, _, at in found])
        of = np.searchsorted(ends_of, starts, side="right")
        count = np.bincount(of, minlength=len(parts))
        first = np.cumsum(count) - count
        n = len(word)
        rolled = np.zeros(n, np.uint64)
        weights = [np.uint64(pow(_ROOT, 3 * j + 1, 1 << 64)) for j in range(k)]
        for j in range(k):
            rolled[: max(n - j, 0)] += word[j:] * weights[j]
        rolled = _mixed(rolled)
        sets = []
        for d in range(len(parts)):
            c, f = int(count[d]), int(first[d])
            if c >= k:
                sets.append(np.unique(rolled[f : f + c - k + 1]))
            elif c:
                h = np.uint64(0)
                for j in range(c):
                    h = h + word[f + j] * weights[j]
                sets.append(_mixed(np.array([h + np.uint64(c)], np.uint64)))
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def signature(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums over the set; equal sets have equal ones."""
    with np.errstate(over="ignore"):
        return int(s.sum(dtype=np.uint64).astype(np.int64)), int(_mixed(s + np.uint64(0x632BE59BD9B4E019)).sum(dtype=np.uint64).astype(np.int64))


def needed(n: int, percent: int) -> int:
    """The least intersection of a set of n with any partner it links to."""
    return -(-percent * n // 100)


def links(common: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def fixed_sizes(n: int, percent: int) -> range:
    """The subset sizes that a small set of n enumerates: the overlap that each possible larger partner needs."""
    return range(needed(n, percent), min(n, needed(100 * n // percent, percent)) + 1)


def subset_cost(n: int, percent: int) -> int:
    return sum(math.comb(n, c) for c in fixed_sizes(n, percent))


def listed_size(n: int, percent: int) -> int:
    """How many of its rarest shingles a set of n is listed by: a partner lacks fewer."""
    return n - needed(n, percent) + 1


def boundary(percent: int, sizes: dict[int, int], scan: float, most: int = 24) -> int:
    """The size up to which sets enumerate subsets: where rows written and rows scanned are fewest. sizes: sets by
    size; scan: the mean length of a list."""

    def cost(x: int) -> float:
        light = sum(m * subset_cost(n, percent) for n, m in sizes.items() if n <= x)
        return light + sum(m * listed_size(n, percent) * (1 + scan) for n, m in sizes.items() if in_lists(n, x, percent))

    return min(range(most + 1), key=lambda x: (cost(x), x)) if sizes else 0


def in_lists(n: int, bound: int, percent: int) -> bool:
    """Whether a set of n is large, or may link to a large one."""
    return n > bound or 100 * n >= percent * (bound + 1)


@dataclass(frozen=True)
class Rarity:
    """A map of recurring shingles, by the first bits of their hashes, and the logarithm of the frequency of the hottest."""

    bits: np.ndarray
    hot: np.ndarray
    power: np.ndarray
    shift: int

    def of(self, s: np.ndarray) -> np.ndarray:
        width = int(len(self.bits) * 8).bit_length() - 1
        at = s >> np.uint64(64 - width)
        out = (self.bits[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1
        if len(self.hot):
            short = s >> np.uint64(self.shift)
            place = np.minimum(np.searchsorted(self.hot, short), len(self.hot) - 1)
            out = np.where(self.hot[place] == short, 1 + self.power[place], out)
        return out


def keys(s: np.ndarray, percent: int, bound: int, rarity: Rarity) -> np.ndarray:
    """The lists that a set (sorted) stands in, as 64-bit keys."""
    n, out = len(s), [np.zeros(0, np.uint64)]
    with np.errstate(over="ignore"):
        if n <= bound:
            total = int(s.sum(dtype=np.uint64))
            for c in fixed_sizes(n, percent):
                found = [(total - sum(int(x) for x in gone)) & (1 << 64) - 1 for gone in combinations(s, n - c)]
                out.append(_mixed(np.array(found, np.uint64) ^ np.uint64(c * _ROOT & (1 << 64) - 1)))
        if n and in_lists(n, bound, percent):
            rank = rarity.of(s)
            rarest = np.argsort(rank, kind="stable")[: listed_size(n, percent)]
            out.append(s[rarest[rank[rarest] > 0]])
    return np.concatenate(out)


def sketch(s: np.ndarray) -> bytes:
    """The parity of the shingles of each of as many hash ranges as a power of two below the set's size (64 at least)."""
    width = max(6, len(s).bit_length() - 1)
    count = np.bincount((s >> np.uint64(64 - width)).astype(np.int64), minlength=1 << width)
    return np.packbits((count & 1).astype(np.uint8)).tobytes()


def close(sizes: list[int], sketches: list[bytes], percent: int) -> np.ndarray:
    """Which sets may link to another of these, by their sketches; what links is never missed."""
    n = np.array(sizes)
    order = np.argsort(n, kind="stable")
    rows = [np.unpackbits(np.frombuffer(sketches[k], np.uint8)) for k in order]
    n, out = n[order], np.zeros(len(sizes), bool)
    width = np.array([len(r) for r in rows])
    # a wider sketch folds: neighbouring ranges become one, their parities add up; narrower ones are of smaller sets
    folded = {int(w): np.packbits(np.array([r.reshape(w, -1).sum(1) & 1 if len(r) >= w else np.zeros(w, int) for r in rows], np.uint8), axis=1) for w in np.unique(width)}
    for i in range(len(rows) - 1):
        stop = int(np.searchsorted(n, 100 * n[i] // percent, side="right"))
        if stop <= i + 1:
            continue
        table = folded[int(width[i])]
        differ = np.bitwise_count(table[i + 1 : stop] ^ table[i]).sum(1, dtype=np.int64)
        near = differ * (100 + percent) <= (100 - percent) * (n[i] + n[i + 1 : stop])
        if near.any():
            out[order[i]] = True
            out[order[i + 1 : stop][near]] = True
    return out


def components(edges: DataFrame) -> DataFrame:
    """id, component (least id that edges a, b reach) of every id in edges, by label propagation with pointer jumps;
    each round's table is written, and the rounds end when no label changes."""
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("c")).select(F.col("a").alias("id"), "c"), "labels")
    moved = True
    while moved:
        known = labels.select("id", "c")
        near = both.join(known.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("c").alias("n"))
        jump = known.select(F.col("id").alias("c"), F.col("c").alias("j"))
        new = known.join(near, "id").join(jump, "c", "left").select("id", F.col("c").alias("old"), F.least("c", "n", F.coalesce("j", "c")).alias("c"))
        new = materialize(new, "labels")
        moved = bool(new.filter("c < old").head(1))
        discard(labels)
        labels = new
    discard(both)
    return labels.select("id", F.col("c").alias("component"))


def _in_parts(batches: Iterator[pa.RecordBatch], column: int, k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            part = batch.slice(low, 1024)
            yield part, shingle_sets(part.column(column).to_pylist(), k)


def _runs(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow one another with equal first `width` columns, as (these, the other columns of each row)."""
    held, rows = None, []
    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            for row in zip(*(c.to_pylist() for c in batch.slice(low, 1024).columns), strict=True):
                if row[:width] != held:
                    if rows:
                        yield held, rows
                    held, rows = row[:width], []
                rows.append(row[width:])
    if rows:
        yield held, rows


def rarities(texts: DataFrame, k: int, shingles: int) -> tuple[Rarity, float]:
    """The rarity of the shingles of texts (column `text`, `shingles` in all), and the mean number of sets that a
    recurring one is in. Counts are of sets that a task met, copies that it met once."""
    spark = texts.sparkSession
    wide = max(4, min(16, (shingles // BUCKET).bit_length()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        met: set[tuple[int, int]] = set()

        def flushed() -> pa.RecordBatch:
            every = np.sort(np.concatenate(held))
            edge = np.searchsorted(every, np.arange((1 << wide) + 1, dtype=np.uint64) << np.uint64(64 - wide)) 
            edge[-1] = len(every)
            short = (every >> np.uint64(32 - wide)).astype(np.uint32)
            full = np.flatnonzero(np.diff(edge))
            return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array([short[edge[b] : edge[b + 1]].tobytes() for b in full], pa.binary())], names=["bucket", "hashes"])

        for _, sets in _in_parts(batches, 0, k):
            for s in sets:
                if len(s) and (mark := signature(s)) not in met:
                    met.add(mark)
                    held.append(s)
            if sum(map(len, held)) >= HELD:
                yield flushed()
                held, met = [], set()
        if held:
            yield flushed()

    def recurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (bucket,), rows in _runs(batches, 1):
            value, count = np.unique(np.frombuffer(b"".join(r[0] for r in rows), np.uint32), return_counts=True)
            value, count = value[count > 1], count[count > 1]
            power = np.minimum(np.log2(count).astype(np.uint8), 60)
            by_power = np.bincount(power, minlength=64)
            out = [[bucket], [value.tobytes()], [power.tobytes()], [by_power], [int(count.sum())]]
            types = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=["bucket", "value", "power", "by_power", "met"])

    dealt = texts.mapInArrow(trimmed(counted), "bucket int, hashes binary").repartition("bucket").sortWithinPartitions("bucket")
    again = materialize(dealt.mapInArrow(trimmed(recurring), "bucket int, value binary, power binary, by_power array<long>, met long"), "recurring")
    told = again.select(F.posexplode("by_power").alias("power", "n")).groupBy("power").agg(F.sum("n").alias("n")).collect()  # 64 rows
    by_power = np.zeros(64, np.int64)
    for r in told:
        by_power[r.power] = r.n
    total, met = int(by_power.sum()), int(again.agg(F.sum("met").alias("n")).first().n or 0)
    least = int(np.flatnonzero(np.append(by_power[::-1].cumsum()[::-1], 0) <= HOT)[0])
    width = max(wide + 3, min(MOST_BITS, 16 * total).bit_length())
    width = min(width, MOST_BITS.bit_length() - 1)

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(batch.num_rows):
                bucket, value, power = (batch.column(c)[low].as_py() for c in range(3))
                value, power = np.frombuffer(value, np.uint32), np.frombuffer(power, np.uint8)
                bits = np.zeros(1 << width - wide, np.uint8)
                bits[value >> np.uint32(32 - (width - wide))] = 1
                whole, hot = np.uint64(bucket << 32) | value.astype(np.uint64), power >= least
                out = [[bucket], [np.packbits(bits).tobytes()], [whole[hot].tobytes()], [power[hot].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], names=["bucket", "bits", "hot", "power"])

    # MOST_BITS bits and HOT hashes at most, whatever the data
    chunks = again.select("bucket", "value", "power").mapInArrow(trimmed(mapped), "bucket int, bits binary, hot binary, power binary").collect()
    bits = np.zeros((1 << wide, 1 << width - wide - 3), np.uint8)
    for c in chunks:
        bits[c.bucket] = np.frombuffer(c.bits, np.uint8)
    hot = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(c.hot, np.uint64) for c in chunks)])
    power = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(c.power, np.uint8) for c in chunks)])
    order = np.argsort(hot)
    discard(again)
    return Rarity(bits.reshape(-1), hot[order], power[order], 32 - wide), met / max(total, 1)


def _blocks(members: DataFrame) -> DataFrame:
    """head, x, y, node: members (head, node) in blocks of about BLOCK; a pair of blocks is a group of its own."""
    sizes = members.groupBy("head").agg(F.count("*").alias("n")).select("head", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    spread = members.join(sizes, "head").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return spread.select("head", "node", "block", other.alias("o")).select("head", F.least("block", "o").alias("x"), F.greatest("block", "o").alias("y"), "node")


def judge(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id of every row of docs."""
    spark, k, percent = docs.sparkSession, settings.shingle, settings.percent
    rows = columns(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    if kind == "void":
        rows, kind = rows.withColumn("doc_id", F.col("doc_id").cast("long")), "bigint"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _in_parts(batches, 1, k):
            marks = [(*signature(s), len(s)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), *(pa.array([m[j] for m in marks], pa.int64()) for j in range(3)), pa.array([sketch(s) for s in sets], pa.binary())],
                names=["doc_id", "text_key", "s1", "s2", "n", "sketch"],
            )

    node = F.xxhash64("s1", "s2", "n").alias("node")  # a class, of whatever ids
    listing = materialize(rows.mapInArrow(trimmed(listed), f"doc_id {kind}, text_key long, s1 long, s2 long, n long, sketch binary").select("doc_id", "text_key", "n", node, "sketch"), "listing")
    of = listing.filter("n > 0 and doc_id is not null").groupBy("node").agg(F.min(F.struct("doc_id", "text_key")).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialize(of.select("node", "first.*", "n", "sketch"), "classes")
    texts = rows.filter("doc_id is not null").select("text")
    every = classes.groupBy((F.when(F.col("n") <= 64, F.col("n")).otherwise(65)).alias("size")).agg(F.count("*").alias("m"), F.sum("n").alias("shingles")).collect()  # 65 rows
    rarity, scan = rarities(texts, k, sum(r.shingles for r in every))
    bound, told = boundary(percent, {r["size"]: r.m for r in every}, scan), spark.sparkContext.broadcast(rarity)

    def standing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for _, sets in _in_parts(batches, 0, k):
            marks, found = [], []
            for s in sets:
                if len(s) and (mark := signature(s)) not in met:
                    met.add(mark)
                    own = keys(s, percent, bound, told.value)
                    if len(own):
                        marks.append((*mark, len(s), len(own)))
                        found.append(own)
            if found:
                s1, s2, n, times = (np.array(x, np.int64) for x in zip(*marks, strict=True))
                out = [np.concatenate(found).view(np.int64), *(np.repeat(x, times) for x in (s1, s2, n))]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["key", "s1", "s2", "n"])

    lists = materialize(texts.mapInArrow(trimmed(standing), "key long, s1 long, s2 long, n long").select("key", node), "lists")
    heads = lists.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last")).filter("head < last").select("key", "head")
    members = materialize(lists.join(heads, "key").select("head", "node").distinct(), "members")
    discard(lists)
    about = classes.select("node", "n", "sketch")
    spread = _blocks(members).join(about, "node").select("head", "x", "y", "node", "n", "sketch")
    spread = spread.repartition("head", "x", "y").sortWithinPartitions("head", "x", "y", "node")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for held, found in _runs(batches, 3):
            names, sizes, marks = zip(*found, strict=True)
            out += [(*held, names[i]) for i in np.flatnonzero(close(sizes, marks, percent))]
            if len(out) > 5000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names=["head", "x", "y", "node"])

    groups = materialize(spread.mapInArrow(trimmed(near), "head long, x int, y int, node long"), "groups")
    discard(members)
    # a class's groups go to its first document, so that its set is made once and moves once a group
    wanted = groups.select("node", F.xxhash64("head", "x", "y").alias("g"), "head", "x", "y").groupBy("node").agg(F.collect_list(F.struct("g", "head", "x", "y")).alias("groups"))
    wanted = materialize(wanted.join(classes.select("node", "doc_id", "text_key"), "node"), "wanted")
    few = F.broadcast(wanted) if groups.count() <= BROADCAST_ROWS else wanted

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                sets = shingle_sets(part.column(1).to_pylist(), k)
                yield pa.RecordBatch.from_arrays([part.column(2), part.column(3), pa.array([s.tobytes() for s in sets], pa.binary())], names=["wanted", "groups", "set"])

    each = "array<struct<g:long,head:long,x:int,y:int>>"
    named = few.select(F.col("doc_id").alias("first"), F.col("text_key").alias("own"), F.col("node").alias("wanted"), "groups")
    met = rows.join(named, (F.col("doc_id") == F.col("first")) & (F.col("text_key") == F.col("own"))).select("doc_id", "text", "wanted", "groups")
    sets = met.mapInArrow(trimmed(shingled), f"wanted long, groups {each}, set binary")
    placed = sets.select(F.col("wanted").alias("node"), "set", F.explode("groups").alias("q"))
    placed = placed.select("q.g", "q.head", "q.x", "q.y", "node", "set")
    placed = placed.repartition("g").sortWithinPartitions("g", "head", "x", "y", "node")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, sets = None, [], []
        a: list[int] = []
        b: list[int] = []
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                for head, x, y, name, s in zip(*(part.column(c).to_pylist() for c in range(1, 6)), strict=True):
                    if (head, x, y) != held:
                        if len(ids) > 1:
                            _compare(ids, sets, percent, a, b)
                        held, ids, sets = (head, x, y), [], []
                    if not ids or ids[-1] != name:
                        ids.append(name)
                        sets.append(np.frombuffer(s, np.uint64))
                if len(a) > 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                    a, b = [], []
        if len(ids) > 1:
            _compare(ids, sets, percent, a, b)
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    edges = materialize(placed.mapInArrow(trimmed(compared), "a long, b long"), "links")
    discard(wanted, groups)
    found = components(edges)
    discard(edges)
    labelled = classes.select("node", "doc_id").join(found, classes["node"] == found["id"], "left").select("node", "doc_id", F.coalesce("component", "node").alias("component"))
    least = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labelled = labelled.join(least, "component").select("node", "component_id")
    met = listing.select("doc_id", "text_key", "n", "node").join(labelled, "node", "left")
    alone = (F.col("n") == 0) | F.col("doc_id").isNull()
    return met.select("doc_id", "text_key", F.col("n").alias("n_shingles"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def _compare(ids: list[int], sets: list[np.ndarray], percent: int, a: list[int], b: list[int]) -> None:
    """Adds a spanning forest of the links among sets."""
    n = len(ids)
    size = np.array([len(s) for s in sets])
    if n == 2:
        common = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if 100 * common >= percent * (size.sum() - common):
            a.append(ids[0])
            b.append(ids[1])
        return
    every = np.concatenate(sets)
    _, place, count = np.unique(every, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), size)
    shared = count[place] > 1
    _, column = np.unique(place[shared], return_inverse=True)
    common = np.zeros((n, n), np.float32)
    width = column.max() + 1 if len(column) else 0
    row = row[shared]
    for low in range(0, width, 8192):  # the product in strips, so that long sets stay small
        some = (column >= low) & (column < low + 8192)
        strip = np.zeros((n, min(8192, width - low)), np.float32)
        strip[row[some], column[some] - low] = 1
        common += strip @ strip.T
    linked = links(common.astype(np.int64), size[:, None], size[None, :], percent)
    root = list(range(n))
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        i, j = int(i), int(j)
        p, q = i, j
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        while root[q] != q:
            root[q] = root[root[q]]
            q = root[q]
        if p != q:
            root[q] = p
            a.append(ids[i])
            b.append(ids[j])


def first_of_each(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs less all but the document of least id of each component; rows equal in id and text stay together.

    Texts without an id take part: they go where a document with an id is in their component, else one row stays."""
    own, key = docs["`doc_id`"], F.xxhash64(docs["`text`"])
    # ids come before hashes, which only tell texts without an id apart
    keyed = docs.select(F.struct(own.isNull().alias("none"), own.alias("id"), F.when(own.isNull(), key).alias("made")).alias("doc_id"), docs["`text`"].alias("text"))
    gone = judge(keyed, settings).filter("n_shingles > 0 and doc_id != component_id").select(F.col("doc_id.id").alias("id"), "text_key").distinct()
    gone = small(materialize(gone, "copies"))
    kept = docs.join(gone, own.eqNullSafe(gone["id"]) & (key == gone["text_key"]), "left_anti")
    if not docs.filter(own.isNull()).head(1):
        return kept
    # of rows without an id, equal texts are one row, the least; texts without words link with nothing
    every = kept.columns
    without = F.col("`doc_id`").isNull() & F.coalesce(F.col("`text`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    row = F.struct(*[F.col(f"`{c}`") for c in every])
    one = kept.filter(without).groupBy(F.xxhash64("`text`")).agg(F.min_by(row, F.to_json(row, {"ignoreNullFields": "false"}))).toDF("key", "row")
    return kept.filter(~without).unionByName(one.select("row.*"))
