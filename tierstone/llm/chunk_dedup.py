"""Repeated passages by content-defined chunks: a gear rolling hash cuts, digests compare."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import python_values, row_key, small_batches, stored

#: The gear hash of 16 bits remembers 16 bytes; a cut needs five zero bits.
MEMORY, ZERO_BITS = 16, 5
SMALLEST, LARGEST = 16, 128
#: Shortest sequence of neighbouring chunks that counts as a repeat, in bytes.
LEAST_BYTES = 80

# One random 16-bit number per byte value, from a rule.
GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 1) & 0xFFFF for b in range(256)], np.uint16)


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks. A place is a cut by its last 16 bytes alone, so an insertion
    moves the cuts around it and no others; chunks keep to the two sizes. Where no place
    qualifies within the largest size, the place of the smallest hash is cut, so that
    monotonous stretches are cut alike wherever they stand."""
    if not data:
        return np.empty(0, np.int64)
    rolled = GEAR[np.frombuffer(data, np.uint8)]
    shift = 1
    while shift < min(MEMORY, len(rolled)):  # 2 * shift bytes' numbers from two halves
        rolled[shift:] += rolled[:-shift] << np.uint16(shift)
        shift *= 2

    def least(last: int) -> int:
        return last + SMALLEST + int(np.argmin(rolled[last + SMALLEST - 1 : last + LARGEST]))

    places = np.nonzero(rolled >> np.uint16(16 - ZERO_BITS) == 0)[0] + 1
    ends, last = [], 0
    for place in places.tolist():
        while place - last > LARGEST:
            last = least(last)
            ends.append(last)
        if place - last >= SMALLEST:
            last = place
            ends.append(last)
    while len(data) - last > LARGEST:
        last = least(last)
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return np.array(ends, np.int64)


#: A span is a byte offset times this, plus a length.
_SPAN = 1 << 16
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("row_a", pa.int64()), ("span", pa.int64()), ("digest_a", pa.int64()), ("digest_b", pa.int64())]
)
_PASSAGES = pa.schema(
    [("doc_id", pa.int64()), ("row_a", pa.int64()), ("start", pa.int64()), ("end", pa.int64()),
     ("first_doc_id", pa.int64()), ("occurrences", pa.int64())]
)


def sequences(data: bytes, least_bytes: int = LEAST_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the shortest sequences of neighbouring chunks that reach `least_bytes`:
    one from every chunk on that has one, and one that ends with the text."""
    ends = cuts(data)
    starts = np.append(0, ends[:-1]) if len(ends) else ends
    reach = np.searchsorted(ends, starts + least_bytes)
    whole = reach < len(ends)
    starts_of, ends_of = starts[whole], ends[reach[whole]]
    last = int(np.searchsorted(starts, len(data) - least_bytes, "right")) - 1
    if last >= 0 and ends[reach[last]] < len(data):
        starts_of, ends_of = np.append(starts_of, starts[last]), np.append(ends_of, len(data))
    return starts_of, ends_of


def chunk_sequences(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """The `sequences` of every text: span and a 128-bit digest of the bytes. `row_a` is a
    hash of the row's id and text."""
    if not 0 < least_bytes < _SPAN - LARGEST:
        raise ValueError(f"least_bytes must lie between 1 and {_SPAN - LARGEST - 1}")
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *keys, data in python_values(batches):
            starts, ends = sequences(data or b"", least_bytes)
            count = len(starts)
            if not count:
                continue
            view = memoryview(data)
            digests = b"".join(
                xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
            )
            halves = np.frombuffer(digests, "<i8").reshape(-1, 2)
            columns = [pa.array([k] * count, pa.int64()) for k in keys]
            columns.append(pa.array(starts * _SPAN + ends - starts))
            columns += [pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=_ROWS)

    row_a = row_key(doc_id, text)[0]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_a, F.col(text).cast("binary"))
    return rows.mapInArrow(work, "doc_id long, row_a long, span long, digest_a long, digest_b long")


def passages(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows (doc_id, row_a, met: list of span, first, n) to the passages that `met` covers.

    Sequences overlap: between two neighbouring ends or starts of theirs, the smallest
    first id and the greatest count of those that cover it hold. Neighbours with the same
    first id are one passage, with the least of their counts.
    """
    met = batch.column("met")
    flat, none = met.flatten(), np.iinfo(np.int64).max
    field = lambda name: flat.field(flat.type.get_field_index(name)).fill_null(none).to_numpy(zero_copy_only=False)
    span, first, n = field("span"), field("first"), field("n")
    of = np.repeat(np.arange(len(met)), met.value_lengths().to_numpy(zero_copy_only=False))
    begin = (of << 40) + span // _SPAN
    end = begin + span % _SPAN
    bounds = np.unique(np.concatenate((begin, end)))
    low = np.searchsorted(bounds, begin)
    many = np.searchsorted(bounds, end) - low
    places = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many - low, many)
    firsts, counts = np.full(len(bounds), none), np.zeros(len(bounds), np.int64)
    np.minimum.at(firsts, places, np.repeat(first, many))
    np.maximum.at(counts, places, np.repeat(n, many))
    covered = counts > 0  # never the last bound, nor the gap between two rows
    new = covered & ~(np.append(False, covered[:-1]) & (firsts == np.append(none, firsts[:-1])))
    opens, inside = np.nonzero(new)[0], np.nonzero(covered)[0]
    if not len(opens):
        return pa.RecordBatch.from_pylist([], schema=_PASSAGES)
    at = np.searchsorted(inside, opens)
    closes = inside[np.append(at[1:], len(inside)) - 1] + 1
    row = pa.array(bounds[opens] >> 40)
    place = lambda which: pa.array(bounds[which] & ((1 << 40) - 1))
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id").take(row), batch.column("row_a").take(row), place(opens), place(closes),
         pa.array(firsts[opens], mask=firsts[opens] == none), pa.array(np.minimum.reduceat(counts[inside], at))],
        schema=_PASSAGES,
    )


def repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_bytes: int = LEAST_BYTES
) -> DataFrame:
    """Passages that other documents have too: doc_id, row_a, start, end (bytes of the UTF-8
    text), first_doc_id, occurrences and keep.

    What is compared are sequences of neighbouring chunks, the shortest that reach
    `least_bytes` (see `sequences`): every place of a passage lies in one that stands whole
    in another document. So a text glued from single chunks of many others has none.
    first_doc_id is the smallest id with such a sequence over the place, occurrences how often
    the commonest of them stands in the table (the least of that over the passage). Where
    first_doc_id changes, a new passage begins, however short, so that what an older
    document has is told from what begins here. A passage reaches from a cut to a cut:
    up to a chunk before what is really common is not in it, and up to a chunk and
    `least_bytes` after it, unless both texts end there. `keep` is true where no
    smaller id has it. Rows equal in id and text are one document. NULL texts and texts below
    `least_bytes` have no passage. NULL ids come after all others. Other columns are left out.

    A sequence that a third of all documents share is one partial sum per task where
    sequences are counted. Counts are written before they are joined back: the join then has a
    shuffle of its own on the side of the rows, which adaptive execution can split. A row
    repeated as often is one set per task where a document's sequences meet.
    """
    every = stored(chunk_sequences(docs, doc_id, text, least_bytes), "chunks")
    digest = ["digest_a", "digest_b"]
    shared = (
        every.groupBy(*digest)
        .agg(
            F.min("row_a").alias("low"), F.max("row_a").alias("high"), F.min("doc_id").alias("first"),
            F.count("*").alias("n"),
        )
        .where("low <> high")
        .drop("low", "high")
    )
    met = every.join(stored(shared, "chunk-counts"), digest).groupBy("doc_id", "row_a")
    met = met.agg(F.collect_set(F.struct("span", "first", "n")).alias("met"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(passages, batches)

    kinds = "doc_id long, row_a long, start long, end long, first_doc_id long, occurrences long"
    kept = F.coalesce(F.col("first_doc_id") >= F.col("doc_id"), F.col("first_doc_id").isNull())
    return met.mapInArrow(work, kinds).withColumn("keep", kept)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with repeated passages cut out of all texts but the one of smallest id."""
    cuts_of = F.collect_set(F.struct("start", "end")).alias("__spans")
    spans = repeats(docs, doc_id, text).where("NOT keep").groupBy("doc_id", "row_a").agg(cuts_of)
    spans = spans.withColumnsRenamed({"doc_id": "__id", "row_a": "__row_a"})

    @F.pandas_udf("string")
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_without(t, s) for t, s in zip(texts, found, strict=True)], dtype=object)

    keyed = docs.withColumn("__row_a", row_key(doc_id, text)[0])
    same = (keyed["__row_a"] == spans["__row_a"]) & F.col(doc_id).cast("long").eqNullSafe(F.col("__id"))
    keyed = keyed.join(spans, same, "left")
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    made = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(cut(F.col(text), F.col("__spans")))
    return keyed.select(*kept, made.alias(text)).select(*(F.col(f"`{c}`") for c in docs.columns))


def _without(text: str | None, spans) -> str | None:
    if text is None or spans is None or not len(spans):
        return text
    data, out, last = text.encode(), b"", 0
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        out, last = out + data[last:start], end
    # A cut may fall inside a character.
    return (out + data[last:]).decode("utf-8", "ignore")
