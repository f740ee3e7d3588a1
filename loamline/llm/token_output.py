"""Token ids of documents as Simple-8b blocks, in a file format that Spark's committers write.

A token file is a folder of Parquet parts, one row a segment: `shard` (part of the order), `segment` (in the shard),
`first` (ids of the shard before it), `doc_ids` and `counts` of its documents, `offsets` (uint32, a block's first
word) and `words` (uint64), little-endian. Documents follow one another by ascending doc_id (null first), then text.

Defined cases: null text is empty (only the end id); repeated rows are each written; an empty table gives an empty
file; other columns are ignored. A lost task is run again from its range of ids, and Spark's commit keeps one copy.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm import simple8b
from loamline.llm.common import columns, trimmed

FILE = "shard int, segment long, first long, doc_ids array<long>, counts array<long>, offsets binary, words binary"
DIGEST = "doc_id long, shard int, at long, n_tokens long, ids_crc32 long"
#: Ids after which a segment ends, bytes of text that are split at once, and bytes of chunks that a worker remembers.
SEGMENT_IDS, SPLIT_BYTES, MEMO_BYTES = 1 << 18, 16 << 20, 192 << 20
#: What an entry of a memo takes beside its characters and ids; chunks that are tokenized in one call.
_ENTRY, _LEARN = 120, 4096

_held: dict = {}


class Memo:
    """Ids of chunks by key; keys of a `spaced` memo are chunks without their space, first chunks have one. Chunks that begin with a space and end without white space are
    learned many at a time, as one text: a token of byte-level BPE stands for as many bytes as its name has characters,
    so sums of bytes tell where in the ids a chunk ends. Past `most` bytes all are forgotten."""

    def __init__(self, tokenizer, spaced: bool, most: int | None = None):
        self.tokenizer, self.spaced, self.most = tokenizer, spaced, most or MEMO_BYTES
        vocabulary = tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int32)
        self.bytes[list(vocabulary.values())] = [len(name) for name in vocabulary]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.begin, self.count, self.ids = (np.zeros(1 << 12, k) for k in (np.int64, np.int32, np.uint32))
        self.used, self.size = 0, 0

    def slots(self, names: list[str]) -> tuple[np.ndarray, list[str]]:
        """Each name's place among what is known (-1: unknown), and the unknown names."""
        found = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        return found, [names[k] for k in np.flatnonzero(found < 0)]

    def learn(self, names: list[str]) -> None:
        lead = not self.spaced
        inner = [(n[:1] == " ") is lead and n[-1:].strip() != "" for n in names]
        for joined in (True, False):
            own = list(compress(names, inner)) if joined else [n for n, j in zip(names, inner, strict=True) if not j]
            for k in range(0, len(own), _LEARN):
                some = own[k : k + _LEARN]
                found = self._together(some) if joined else None
                self._add(some, *(found or self._apart(some)))

    def _together(self, names: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of the names' chunks, one after another, and each chunk's number of ids, if bytes tell them."""
        text = " " + " ".join(names) if self.spaced else "".join(names)
        size = np.fromiter(map(len, names) if text.isascii() else (len(n.encode()) for n in names), np.int64, len(names)) + self.spaced
        found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        ends, stops = np.cumsum(self.bytes[found], dtype=np.int64), np.cumsum(size)
        last = np.searchsorted(ends, stops)
        if last[-1] == len(ends) - 1 and (ends[last] == stops).all():
            return found, np.diff(last, prepend=-1)
        return None

    def _apart(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = [n[1:] if n[:1] == " " else " " + n for n in names] if self.spaced else names
        each = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for x in each for i in x], np.uint32), np.array([len(x) for x in each], np.int64)

    def _add(self, names: list[str], found: np.ndarray, count: np.ndarray) -> None:
        n, stop = len(self.known), len(self.known) + len(names)
        while len(self.count) < stop:
            self.begin, self.count = (np.append(x, np.zeros_like(x)) for x in (self.begin, self.count))
        while len(self.ids) < self.used + len(found):
            self.ids = np.append(self.ids, np.zeros_like(self.ids))
        self.begin[n:stop], self.count[n:stop] = self.used + np.cumsum(count) - count, count
        self.ids[self.used : self.used + len(found)] = found
        self.known.update(zip(names, range(n, stop), strict=True))
        self.used += len(found)
        self.size += sum(map(len, names)) + 4 * len(found) + _ENTRY * len(names)

    def gathered(self, at: np.ndarray, names: list[str], told: tuple[np.ndarray, list[str]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the chunks names[at], one after another, and each chunk's number of ids."""
        found, new = told or self.slots(names)
        if new and self.size > self.most:
            self.forget()
            found, new = np.full(len(names), -1), names
        if new:
            self.learn(new)
            found[found < 0] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        slot = found[at]
        n = self.count[slot]
        ends = np.cumsum(n, dtype=np.int64)
        kind = np.int32 if self.used < 1 << 30 and (not len(ends) or ends[-1] < 1 << 30) else np.int64
        place = np.arange(ends[-1] if len(ends) else 0, dtype=kind)
        place += np.repeat((self.begin[slot] - ends + n).astype(kind), n)
        return self.ids[place], n


def _per_document(n: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(n, dtype=np.int64))
    return total[offsets[1:]] - total[offsets[:-1]]


def chunk_encoder(tokenizer_json: str, memo: int | None = None) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """Encodes texts chunk by chunk: all their ids, and each text's number of ids. A space after a character that is
    not white space always begins a pre-token of byte-level BPE, so the ids of a text are those of its chunks, cut
    there; a batch's distinct chunks are looked up once, and each worker remembers chunks up to `memo` bytes. Texts
    without white space before a space are split plainly: a chunk's key is what follows its space, the first chunk's
    has a space before it. In other texts chunks are their own keys, in a memo apart."""
    key = hash((tokenizer_json, memo))
    if key not in _held:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(tokenizer_json)
        _held[key] = Memo(tokenizer, True, memo), Memo(tokenizer, False, memo)
    plain, other = _held[key]
    cut = re.compile(r"(?<=\S)(?= )")

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        offsets, coded = lists.offsets.to_numpy(), lists.flatten().dictionary_encode()
        at, names = coded.indices.to_numpy().copy(), coded.dictionary.to_pylist()
        first = offsets[:-1]
        begins, place = np.unique(at[first], return_inverse=True)
        at[first] = len(names) + place
        names += [" " + names[k] for k in begins]
        told = plain.slots(names)
        odd = {n for n in told[1] if n != " " and (not n or n[-1].isspace())}
        if not odd:
            ids, n = plain.gathered(at, names, told)
            return ids, _per_document(n, offsets)
        is_odd = np.fromiter((n in odd for n in names), bool, len(names))
        # a chunk that only its being the first makes odd is of no other text
        bad = _per_document(is_odd[at].astype(np.int64), offsets) > 0
        if not bad.any():
            used = np.unique(at)
            ids, n = plain.gathered(np.searchsorted(used, at), [names[k] for k in used])
            return ids, _per_document(n, offsets)
        if not bad.all():
            (a, x), (b, y) = encode(texts.filter(pa.array(~bad))), encode(texts.filter(pa.array(bad)))
            counts = np.zeros(len(bad), np.int64)
            counts[~bad], counts[bad] = x, y
            ids, of = np.zeros(len(a) + len(b), np.uint32), np.repeat(bad, counts)
            ids[~of], ids[of] = a, b
            return ids, counts
        parts = [cut.split(t) for t in texts.to_pylist()]
        offsets = np.append(0, np.cumsum([len(p) for p in parts]))
        coded = pa.array([x for p in parts for x in p], pa.string()).dictionary_encode()
        ids, n = other.gathered(coded.indices.to_numpy(), coded.dictionary.to_pylist())
        return ids, _per_document(n, offsets)

    return encode


def _slices(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts of about SPLIT_BYTES."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    low = 0
    while low < len(ends):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + SPLIT_BYTES, side="right")))
        yield slice(low, high)
        low = high


def write_tokens(docs: DataFrame, path: str, tokenizer_json: str, end_id: int = 2, memo: int | None = None) -> None:
    """Writes the token file of docs' `text` at path. memo: bytes of chunks that a worker remembers (MEMO_BYTES)."""
    told = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = chunk_encoder(told.value, memo), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        names: list[pa.Array] = []
        counts: list[np.ndarray] = []
        held, first, segment = 0, 0, 0

        def flushed() -> pa.RecordBatch:
            words, offsets = simple8b.encode(np.concatenate(ids))
            row = [[shard], [segment], [first], [pa.concat_arrays(names).to_pylist()], [np.concatenate(counts)], [offsets.astype("<u4").tobytes()], [words.astype("<u8").tobytes()]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types, strict=True)], names=[x.split()[0] for x in FILE.split(", ")])

        for batch in batches:
            for part in _slices(batch.column(1)):
                n = part.stop - part.start
                found, size = encode(batch.column(1).slice(part.start, n))
                found, size = np.insert(found, np.cumsum(size), end_id), size + 1
                ends, low = np.cumsum(size), 0
                while low < n:
                    before = ends[low - 1] if low else 0
                    high = min(n, int(np.searchsorted(ends, before + SEGMENT_IDS - held)) + 1)
                    ids.append(found[before : ends[high - 1]])
                    names.append(batch.column(0).slice(part.start + low, high - low))
                    counts.append(size[low:high])
                    held, low = held + int(ends[high - 1] - before), high
                    if held >= SEGMENT_IDS:
                        yield flushed()
                        first, segment, held = first + held, segment + 1, 0
                        ids, names, counts = [], [], []
        if names:
            yield flushed()

    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(trimmed(segments), FILE).write.parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, shard, at (ids of the shard before it) and ids (array<long>) of each document of a token file."""
    return _decoded(spark, path, "doc_id long, shard int, at long, ids array<long>", lambda ids: ids.astype(np.int64))


def read_digests(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the decoded ids of a token file."""
    found = _decoded(spark, path, DIGEST, None)
    # one row a shard, that is a write task: no more than the partitions of the write
    totals = spark.read.parquet(path).select("shard", F.expr("aggregate(counts, 0L, (a, x) -> a + x)").alias("n")).groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()
    bases, total = [], 0
    for row in totals:
        bases.append((row.shard, total))
        total += row.n
    base = spark.createDataFrame(bases, "shard int, base long")
    return found.join(F.broadcast(base), "shard").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def _decoded(spark, path: str, schema: str, of) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["counts"], np.int64)
                ids = simple8b.decode(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["offsets"], "<u4"), int(counts.sum()))
                ends = np.cumsum(counts)
                each = [ids[e - c : e] for c, e in zip(counts, ends, strict=True)]
                out = [pa.array(row["doc_ids"], pa.int64()), pa.array([row["shard"]] * len(each), pa.int32()), pa.array(row["first"] + ends - counts)]
                if of:
                    out.append(pa.array([of(x) for x in each], pa.list_(pa.int64())))
                else:
                    out += [pa.array(counts), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64())]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return spark.read.parquet(path).mapInArrow(trimmed(rows), schema)
