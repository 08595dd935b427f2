"""Benchmark passages in training documents, found through a positional inverted index.

The index is kept in rows: some documents, their words' positions by term, and where
each document lies. A row is self-contained, so a search reads each one once, in
parallel, and shuffles nothing. Rows are short, as whatever reads or writes them holds
several at a time; a search joins those that follow each other to a segment.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import in_batches, python_values, row_key, short_batches, small_batches, stored

WINDOW_WORDS = 13
#: One part in twenty of the words hit makes a document contaminated.
HIT_SHARE = 20
#: Text bytes after which a segment, what is searched at once, is closed.
SEGMENT_BYTES = 4 << 20
#: Text bytes after which a row of the index is closed: as JVM objects rows stay under the
#: size that takes memory regions of its own, and most positions fit two bytes.
ROW_BYTES = 256 << 10
#: What a document counts for besides its text: its keys and place.
DOCUMENT_BYTES = 32
#: Parquet keeps this much of the index in memory, writing and reading.
STORED = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "8"}
#: Benchmark words searched for in one pass over the index; more take more passes.
PASS_WORDS = 1_000_000

_words = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall

INDEX_ROW = (
    "doc_ids array<long>, row_as array<long>, row_bs array<long>, starts binary, lengths binary, "
    "terms binary, counts binary, positions binary, size long"
)
_INDEX_ROW = pa.schema(
    [("doc_ids", pa.list_(pa.int64())), ("row_as", pa.list_(pa.int64())), ("row_bs", pa.list_(pa.int64())),
     ("starts", pa.binary()), ("lengths", pa.binary()), ("terms", pa.binary()),
     ("counts", pa.binary()), ("positions", pa.binary()), ("size", pa.int64())]
)


def words(text: bytes | None) -> list[bytes]:
    """Runs of digits, small letters and non-ASCII, after lowering A-Z."""
    return _words(text.lower()) if text else []


def _kind(stretch: int) -> str:
    """The smallest type for positions, and counts of them, below `stretch`."""
    return "<u2" if stretch <= 1 << 16 else "<i4" if stretch <= 1 << 31 else "<i8"


def _index_row(rows: list[tuple], texts: list[list[bytes]], size: int) -> tuple:
    """Post the words of some documents. Positions count through the row, with a gap
    after each document, so that no run of positions crosses from one to another.
    Terms are joined by spaces, which no word has."""
    number: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    terms = np.fromiter(
        (number.setdefault(w, len(number)) for t in texts for w in t), np.int64, count=int(lengths.sum())
    )
    places = np.arange(len(terms)) + np.repeat(np.arange(len(texts)), lengths)
    order = np.argsort(terms, kind="stable")
    counts = np.bincount(terms, minlength=len(number))
    ids, row_as, row_bs = zip(*rows, strict=True)
    kind = _kind(int(lengths.sum()) + len(lengths))
    return (
        ids, row_as, row_bs, starts.astype("<i8").tobytes(), lengths.astype("<i8").tobytes(),
        b" ".join(number), counts.astype(kind).tobytes(), places[order].astype(kind).tobytes(), size,
    )


def build_index(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segment_bytes: int = SEGMENT_BYTES
) -> DataFrame:
    """The positional index of every word of every document, written to the shared folder.

    One pass over the texts, without a shuffle. A row closes once its texts reach
    ROW_BYTES, or `segment_bytes` where that is less, so its size is bounded by that
    and the longest document.
    """
    small_batches(docs.sparkSession)
    row_bytes = min(segment_bytes, ROW_BYTES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, texts, size = [], [], 0
        for ident, row_a, row_b, content in python_values(batches):
            rows.append((ident, row_a, row_b))
            texts.append(words(content))
            size += len(content or b"") + DOCUMENT_BYTES
            if size >= row_bytes:
                yield from in_batches(iter([_index_row(rows, texts, size)]), _INDEX_ROW)
                rows, texts, size = [], [], 0
        if rows:
            yield from in_batches(iter([_index_row(rows, texts, size)]), _INDEX_ROW)

    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), *row_key(doc_id, text), F.col(text).cast("binary")
    )
    return stored(keyed.mapInArrow(work, INDEX_ROW), "index", **STORED)


def _item_windows(items: Sequence[tuple], window: int) -> dict[tuple[bytes, ...], set]:
    """Windows of the items and the ids they belong to."""
    found: dict[tuple[bytes, ...], set] = {}
    for item_id, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            found.setdefault(tuple(w[at : at + window]), set()).add(item_id)
    return found


def _occurrences(phrase: Sequence[bytes], lists: dict[bytes, np.ndarray]) -> np.ndarray:
    """First positions of a phrase: the rarest term's list, moved by its offset, and
    from it what the next rarest terms' lists confirm, until none is left."""
    offsets = sorted(range(len(phrase)), key=lambda i: len(lists[phrase[i]]))
    found = lists[phrase[offsets[0]]] - offsets[0]
    for i in offsets[1:]:
        if not len(found):
            break
        there = lists[phrase[i]]
        at = np.searchsorted(there, found + i)
        found = found[there[np.minimum(at, len(there) - 1)] == found + i]
    return found


class _Reader:
    """A segment's documents, and its lists of those terms that a search asks for. The
    positions of a row of the index go on where those of the row before it end."""

    def __init__(self, rows: Sequence[tuple], asked: set[bytes]) -> None:
        self.rows, starts, lengths, lists, before = [], [], [], {}, 0
        for ids, row_as, row_bs, first, words_of, terms, counts, positions, _ in rows:
            self.rows += zip(ids, row_as, row_bs, strict=True)
            starts.append(np.frombuffer(first, "<i8") + before)
            lengths.append(np.frombuffer(words_of, "<i8"))
            stretch = int(lengths[-1].sum()) + len(lengths[-1])
            counted = np.frombuffer(counts, _kind(stretch)).astype(np.int64)
            flat, ends = np.frombuffer(positions, _kind(stretch)), np.cumsum(counted)
            for n, t in enumerate(terms.split(b" ") if terms else ()):
                if t in asked:
                    lists.setdefault(t, []).append(flat[ends[n] - counted[n] : ends[n]].astype(np.int64) + before)
            before += stretch
        self.starts, self.lengths = np.concatenate(starts), np.concatenate(lengths)
        self.lists = {t: np.concatenate(found) for t, found in lists.items()}

    def phrase(self, phrase: Sequence[bytes]) -> np.ndarray:
        return _occurrences(phrase, self.lists) if all(w in self.lists for w in phrase) else np.empty(0, np.int64)

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1


def _segments(batches: Iterator[pa.RecordBatch], asked: set[bytes]) -> Iterator[_Reader]:
    """Rows of the index as they come, as many at a time as make a segment."""
    held, size = [], 0
    for row in python_values(batches):
        held.append(row)
        size += row[-1]
        if size >= SEGMENT_BYTES:
            yield _Reader(held, asked)
            held, size = [], 0
    if held:
        yield _Reader(held, asked)


def _covered(reader: _Reader, windows: dict[tuple[bytes, ...], set]) -> Iterator[tuple]:
    """Per document of the segment that has a window: its number, the stretches of
    words hit (start, end, start, end, ...) from its first word, and the items."""
    edges: list[tuple[np.ndarray, int]] = []
    items: dict[int, set] = {}
    for window, ids in windows.items():
        found = reader.phrase(window)
        if len(found):
            edges.append((found, len(window)))
            for doc in np.unique(reader.documents(found)).tolist():
                items.setdefault(doc, set()).update(ids)
    if not edges:
        return
    depth = np.zeros(int(reader.starts[-1] + reader.lengths[-1]) + 2, np.int32)
    for found, length in edges:
        np.add.at(depth, found, 1)
        np.add.at(depth, found + length, -1)
    change = np.diff((np.cumsum(depth) > 0).astype(np.int8), prepend=0)
    begin, end = np.nonzero(change == 1)[0], np.nonzero(change == -1)[0]
    owner = reader.documents(begin)
    for doc, ids in items.items():
        mine = owner == doc
        spans = np.stack((begin[mine], end[mine]), axis=1) - reader.starts[doc]
        yield doc, spans.ravel().tolist(), ids


def _one_pass(index: DataFrame, items: list[tuple], window: int) -> DataFrame:
    short_batches(index.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("n_words", pa.int64()),
         ("spans", pa.list_(pa.int64())), ("item_ids", pa.list_(pa.string()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _item_windows(items, window)
        asked = {w for phrase in windows for w in phrase}

        def rows() -> Iterator[tuple]:
            for reader in _segments(batches, asked):
                found = {doc: (spans, ids) for doc, spans, ids in _covered(reader, windows)}
                for doc, (keys, length) in enumerate(zip(reader.rows, reader.lengths.tolist(), strict=True)):
                    spans, ids = found.get(doc, ([], ()))
                    yield *keys, length, spans, sorted(i for i in ids if i is not None)

        return in_batches(rows(), schema)

    kinds = "doc_id long, row_a long, row_b long, n_words long, spans array<long>, item_ids array<string>"
    return index.mapInArrow(work, kinds)


def search(
    index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text",
    window: int = WINDOW_WORDS, pass_words: int = PASS_WORDS,
) -> DataFrame:
    """Per document row: doc_id, row_a, row_b, n_words, spans, item_ids (sorted strings).

    `spans` are the stretches of words inside any occurrence of any `window`
    consecutive item words, as start, end, start, end and so on. An item of fewer
    words is one window, one without words none. Items are handed to the tasks in
    passes of about `pass_words` words, which bounds what the driver holds and sends
    out at a time; further passes read the index again and their spans are merged.
    Rows repeating an item id add their windows to it; an item without id marks
    words but is not listed.
    """
    asked = items.where(F.col(text).isNotNull()).select(
        F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("binary").alias("text")
    )
    total = asked.agg(F.sum(F.octet_length("text") / 2)).first()[0] or 0
    passes = 1 + int(total // pass_words)
    if passes == 1:
        return _one_pass(index, [tuple(r) for r in asked.collect()], window)
    done = []
    for number in range(passes):
        own = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == number
        share = [tuple(r) for r in asked.where(own).collect()]
        done.append(stored(_one_pass(index, share, window), "pass"))
    every = done[0]
    for other in done[1:]:
        every = every.unionByName(other)
    merge = F.udf(_merged, "array<long>")
    # Identical rows come once per pass each; they go out as often as they came in.
    grouped = every.groupBy("doc_id", "row_a", "row_b", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
        (F.count("*") / passes).cast("int").alias("times"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("times")))
    return grouped.select("doc_id", "row_a", "row_b", "n_words", merge("spans").alias("spans"), "item_ids", copies.alias("copy")).drop("copy")


def _merged(spans: list[int]) -> list[int]:
    """Stretches as one ascending list without overlaps."""
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The findings per document row, with n_hit and the verdict `contaminated`:
    one word in twenty or more is hit.

    NULL and empty texts have no words and are clean; so is every row where the
    benchmark is empty. Repeated rows are judged each. Other columns are left out.
    """
    found = search(build_index(docs, doc_id, text), items)
    ends = F.filter("spans", lambda _, i: i % 2 == 1)
    starts = F.filter("spans", lambda _, i: i % 2 == 0)
    zero = F.lit(0).cast("long")
    add = lambda total, x: total + x
    n_hit = F.aggregate(ends, zero, add) - F.aggregate(starts, zero, add)
    found = found.withColumn("n_hit", n_hit)
    judged = (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))
    return found.withColumn("contaminated", judged)


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    found = contamination(docs, items, doc_id, text).where("contaminated")
    bad = stored(found.select(F.col("row_a").alias("__row_a"), F.col("row_b").alias("__row_b")).distinct(), "bad")
    a, b = row_key(doc_id, text)
    keyed = docs.withColumns({"__row_a": a, "__row_b": b})
    stay = keyed.join(bad, ["__row_a", "__row_b"], "left_anti")
    return stay.select(*(F.col(f"`{c}`") for c in docs.columns))


def proximity(
    index: DataFrame, phrases: Sequence[str], slack: int = 3
) -> DataFrame:
    """Near matches: (doc_id, phrase, start, stretch) where the words of a phrase
    follow each other in order with at most `slack` other words in between in all.

    From each occurrence of the phrase's rarest word, the earlier and later words are
    taken as near to it as they come. Exact occurrences have stretch = the number of
    words. Phrases without words match nothing.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("phrase", pa.string()), ("start", pa.int64()), ("stretch", pa.int64())]
    )
    asked_for = [(p, words(p.encode())) for p in phrases]
    short_batches(index.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {w for _, found in asked_for for w in found}

        def rows() -> Iterator[tuple]:
            for reader in _segments(batches, asked):
                for name, wanted in asked_for:
                    for start, end in _near_occurrences(wanted, reader.lists, slack):
                        doc = int(reader.documents(np.array([start]))[0])
                        if end < reader.starts[doc] + reader.lengths[doc]:
                            yield reader.rows[doc][0], name, start - int(reader.starts[doc]), end - start + 1

        return in_batches(rows(), schema)

    return index.mapInArrow(work, "doc_id long, phrase string, start long, stretch long")


def _near_occurrences(wanted: Sequence[bytes], lists: dict[bytes, np.ndarray], slack: int) -> list[tuple[int, int]]:
    if not wanted or any(w not in lists for w in wanted):
        return []
    rarest = min(range(len(wanted)), key=lambda i: len(lists[wanted[i]]))
    first = last = lists[wanted[rarest]]
    for i in range(rarest - 1, -1, -1):
        there = lists[wanted[i]]
        at = np.searchsorted(there, first, side="left") - 1
        first, last = there[np.maximum(at, 0)][at >= 0], last[at >= 0]
    for i in range(rarest + 1, len(wanted)):
        there = lists[wanted[i]]
        at = np.searchsorted(there, last, side="right")
        fits = at < len(there)
        first, last = first[fits], there[at[fits]]
    fits = last - first + 1 <= len(wanted) + slack
    return sorted(set(zip(first[fits].tolist(), last[fits].tolist(), strict=True)))
