"""Token ids in patched frame-of-reference blocks.

Documents are put in order over many tasks; each task encodes its run of documents and cuts the ids into
segments of whole documents.  A segment is one row of a Parquet table, so writing and recovery are
Spark's.  Its columns hold the documents (ids and lengths), the block index and the packed bytes.

A block is ``BLOCK`` ids.  Its header is the smallest id (4 bytes), the width in bits (1 byte) and the
number of exceptions (1 byte, at most ``BLOCK``).  Then come the low ``width`` bits of every id less the
smallest, packed; the width is the one that the ``PERCENTILE``-th part of the block's values fits, or a
larger one if that takes fewer bytes.  Values that do not fit are exceptions: their places (1 byte each)
and their high parts (4 bytes each) follow.  The index holds where each block starts, so one document is
read without unpacking what is before it.

A NULL text is the empty text: only its end id is written.  Rows that share a ``doc_id`` are ordered by a
hash of the text and written each; a NULL id comes first.  An empty table gives no segments.  A document of any
length is one run of ids; a segment is closed behind the document that fills it.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidegate.llm.common import if_small, tasks, text_of
from tidegate.storage import stage

BLOCK = 128
HEADER = 6
PERCENTILE = 90
SEGMENT_IDS = 1 << 18
SEGMENT_SCHEMA = (
    "part int, segment int, doc_ids array<bigint>, lengths array<bigint>, "
    "n_ids bigint, block_starts binary, payload binary"
)
CACHE_PARTS = 400_000
CHUNK_BYTES = 2_000_000
#: A run of letters in every version of Unicode, and the single bytes that ``cuts`` knows.
LETTER_RUN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
SPACE, APOSTROPHE = 0x20, 0x27
IS_LETTER = np.array([i < 0x80 and chr(i).isalpha() for i in range(256)])
IS_SIGN = np.array([0x20 < i < 0x7F and i != APOSTROPHE and not chr(i).isalpha() for i in range(256)])
IS_BREAK = np.array([chr(i) in "\t\n\r" for i in range(256)])


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts (bytes) and packed bytes of a run of ids below 2**32."""
    n = len(ids)
    count = -(-n // BLOCK)
    if not n:
        return np.zeros(0, np.uint32), b""
    rows = np.empty(count * BLOCK, dtype=np.int64)
    rows[:n] = ids
    rows[n:] = rows[n - 1]
    rows = rows.reshape(count, BLOCK)
    low = rows.min(axis=1)
    rows = (rows - low[:, None]).astype(np.uint32)
    ranks = [BLOCK * PERCENTILE // 100 - 1, BLOCK - 1]
    edges = np.partition(rows, ranks, axis=1)[:, ranks].astype(np.int64)
    chosen = np.ceil(np.log2(edges + 1)).astype(np.int64)
    too_wide = (rows > _mask(chosen[:, :1])).sum(axis=1)
    costs = np.stack([BLOCK // 8 * chosen[:, 0] + 5 * too_wide, BLOCK // 8 * chosen[:, 1]], axis=1)
    patched = costs[:, 0] <= costs[:, 1]
    widths = np.where(patched, chosen[:, 0], chosen[:, 1])
    wrong = np.where(patched, too_wide, 0)
    sizes = HEADER + BLOCK // 8 * widths + 5 * wrong
    starts = np.cumsum(sizes) - sizes
    data = np.empty(sizes.sum(), np.uint8)
    data[starts[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(count, 4)
    data[starts + 4] = widths
    data[starts + 5] = wrong
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        size = 2 if width <= 16 else 4
        raw = rows[at].astype(f"<u{size}").view(np.uint8).reshape(len(at), BLOCK, size)
        bits = np.unpackbits(raw, axis=2, count=width, bitorder="little")
        body = np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")
        data[starts[at][:, None] + np.arange(HEADER, HEADER + BLOCK // 8 * width)] = body
    out = np.flatnonzero(wrong)
    b, place = np.nonzero(rows[out] > _mask(widths[out])[:, None])
    b = out[b]
    nth, first = _patches(wrong[out], (starts + HEADER + BLOCK // 8 * widths)[out])
    data[first + nth] = place
    high = (rows[b, place] >> widths[b].astype(np.uint32)).astype("<u4")
    data[(first + wrong[b] + 4 * nth)[:, None] + np.arange(4)] = high.view(np.uint8).reshape(-1, 4)
    return starts.astype(np.uint32), data.tobytes()


def unpack(starts: np.ndarray, payload: bytes, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a run of ``n``, or those of its blocks from ``first`` to before ``last`` only."""
    data = np.frombuffer(payload, np.uint8)
    starts = starts.astype(np.int64)
    last = len(starts) if last is None else last
    picked = starts[first:last]
    out = np.zeros((len(picked), BLOCK), dtype=np.int64)
    if not len(picked):
        return out.reshape(-1)
    lows = data[picked[:, None] + np.arange(4)].view("<u4")[:, 0].astype(np.int64)
    widths, wrong = data[picked + 4].astype(np.int64), data[picked + 5].astype(np.int64)
    for width in np.unique(widths[widths > 0]).tolist():
        at = np.flatnonzero(widths == width)
        body = data[picked[at][:, None] + np.arange(HEADER, HEADER + BLOCK // 8 * width)]
        size = 2 if width <= 16 else 4
        bits = np.zeros((len(at), BLOCK, 8 * size), np.uint8)
        bits[:, :, :width] = np.unpackbits(body, axis=1, bitorder="little").reshape(len(at), BLOCK, width)
        out[at] = np.packbits(bits, axis=2, bitorder="little").view(f"<u{size}")[:, :, 0]
    at = np.flatnonzero(wrong)
    nth, patches = _patches(wrong[at], (picked + HEADER + BLOCK // 8 * widths)[at])
    b = np.repeat(at, wrong[at])
    high = data[(patches + wrong[b] + 4 * nth)[:, None] + np.arange(4)].view("<u4")[:, 0].astype(np.int64)
    out[b, data[patches + nth]] |= high << widths[b]
    out += lows[:, None]
    flat = out.reshape(-1)
    return flat[: n - first * BLOCK]


def _mask(widths: np.ndarray) -> np.ndarray:
    """The largest value of so many bits."""
    return ((1 << widths) - 1).astype(np.uint32)


def _patches(counts: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each exception, its number in its block and where the exceptions of that block start."""
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return nth, np.repeat(starts, counts)


def cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 texts, given one behind the other, where the usual pattern of byte-level BPE surely cuts.

    It cuts before a space that has something visible behind it, before what is no letter behind a letter, and
    before a letter behind a visible sign that is no apostrophe.  It cuts a single white space between something visible
    and a letter off too; longer white space is cut by what follows, so no place is given there.  Only ASCII and Latin
    letters are looked at.  What lies between two places is cut further in the same way as in the whole text.
    """
    letter = IS_LETTER[data]
    after = np.append(data[1:], np.uint8(0))
    lead = (data >= 0xC3) & ((data <= 0xC8) | ((data == 0xC9) & (after <= 0x8F)))
    lead &= ~((data == 0xC3) & ((after == 0x97) | (after == 0xB7)))
    letter |= lead
    letter[1:] |= lead[:-1]
    visible = letter | IS_SIGN[data] | (data == APOSTROPHE)
    cut = np.zeros(len(data), dtype=bool)
    cut[:-1] = (data[:-1] == SPACE) & visible[1:]
    cut[1:] |= letter[:-1] & (data[1:] < 0x80) & ~letter[1:] & (data[1:] != SPACE)
    cut[1:] |= letter[1:] & IS_SIGN[data[:-1]]
    cut[2:] |= letter[2:] & IS_BREAK[data[1:-1]] & visible[:-2]
    return cut


class Encoder:
    """A public tokenizer with a bounded memory of parts of texts.

    The pattern of byte-level BPE cuts a text before its merges begin, so the ids of a text are those of its
    parts put together, wherever it is cut (see ``cuts``), and frequent parts are encoded once.  A run of letters,
    with the space before it, is one word of the pattern, so the tokenizer's model alone encodes it; other
    parts pass through the whole tokenizer, and so do texts with special tokens.

    The ids of all known parts lie in one array, and those of a batch are gathered from it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [c for c in map(chr, range(0x250)) if LETTER_RUN.fullmatch(c)]
        self.as_bytes = {ord(c): byte_level.pre_tokenize_str(c)[0][0] for c in [" ", *letters]}
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and not any(x in t for x in self.special)]
        if plain:
            for i, ids in zip(plain, self._parted([texts[i] for i in plain])):
                out[i] = ids
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.whole([texts[i] for i in rest])):
            out[i] = np.array(ids, dtype=np.int64)
        return out

    def _parted(self, texts: list[str]) -> list[np.ndarray]:
        array = pa.array(texts, pa.large_string())
        _, offsets, buffer = array.buffers()
        edges = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
        data = np.frombuffer(buffer, np.uint8)[: edges[-1]]
        cut = cuts(data)
        cut[edges[1:] - 1] &= data[edges[1:] - 1] != SPACE
        cut[edges[:-1]] = True
        starts = np.flatnonzero(cut)
        bounds = pa.py_buffer(np.append(starts, len(data)))
        parts = pa.Array.from_buffers(pa.large_string(), len(starts), [None, bounds, buffer])
        coded = parts.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > CACHE_PARTS:
            self._forget()
        places = np.array([self.known.get(p, -1) for p in distinct])
        new = np.flatnonzero(places < 0)
        places[new] = len(self.sizes) + np.arange(len(new))
        self._learn([distinct[i] for i in new.tolist()])
        places = places[coded.indices.to_numpy()]
        sizes = self.sizes[places]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[places] - (ends - sizes), sizes) + np.arange(ends[-1])
        ids = self.ids[at].astype(np.int64)
        return np.split(ids, ends[np.searchsorted(starts, edges[1:-1]) - 1])

    def _learn(self, new: list[str]) -> None:
        """Keep the ids of parts, in this order."""
        tokenize, as_bytes = self.model.tokenize, self.as_bytes
        others = [p for p in new if not LETTER_RUN.fullmatch(p)]
        found = dict(zip(others, self.whole(others)))
        runs = [found[p] if p in found else [t.id for t in tokenize(p.translate(as_bytes))] for p in new]
        self.known.update(zip(new, range(len(self.sizes), len(self.sizes) + len(new))))
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(runs), np.uint32, sizes.sum())])


@functools.lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(path)


def write_segments(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Encode ``docs`` (doc_id, text), end each with ``end_id``, and write segments in ascending order."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text_of()).alias("tie"),
        text_of().alias("text"),
    )
    ordered = (
        rows.repartitionByRange(tasks(spark, 2), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = encoder_of(tokenizer_path)
        end = np.array([end_id], dtype=np.int64)
        part, segment, held, doc_ids, size = TaskContext.get().partitionId(), 0, [], [], 0

        def closed():
            starts, payload = pack(np.concatenate(held))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([[len(x) for x in held]], pa.list_(pa.int64())),
                    pa.array([size], pa.int64()),
                    pa.array([starts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([payload], pa.binary()),
                ],
                names=["part", "segment", "doc_ids", "lengths", "n_ids", "block_starts", "payload"],
            )

        for batch in batches:
            # Few documents at a time, by their bytes, so that what is made of them stays small.
            chunks = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype(np.int64)) // CHUNK_BYTES
            edges = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), batch.num_rows]
            for at, to in zip(edges, edges[1:]):
                keys, texts = batch["doc_id"][at:to].to_pylist(), batch["text"][at:to].to_pylist()
                for key, ids in zip(keys, encoder.encode(texts)):
                    doc_ids.append(key)
                    held.append(np.concatenate([ids, end]))
                    size += len(ids) + 1
                    if size >= SEGMENT_IDS:
                        yield closed()
                        segment, held, doc_ids, size = segment + 1, [], [], 0
        if held:
            yield closed()

    ordered.mapInArrow(encoded, SEGMENT_SCHEMA).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of the files: where it starts among all ids, its length and checksum."""
    segments = spark.read.parquet(path)
    sizes = segments.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    inside = W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part",
        "segment",
        (F.col("part_start") + F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).alias("segment_start"),
    )
    starts = stage(starts, "segment-starts").frame

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = unpack(np.frombuffer(row["block_starts"], "<u4"), row["payload"], row["n_ids"])
                lengths = np.array(row["lengths"], dtype=np.int64)
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4")
                crcs = [zlib.crc32(raw[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(crcs), pa.int32()),
                        pa.array([row["segment"]] * len(crcs), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(ends - lengths, pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "segment", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    documents = segments.mapInArrow(
        decoded, "part int, segment int, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return documents.join(if_small(starts), ["part", "segment"]).select(
        "doc_id", (F.col("segment_start") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )
