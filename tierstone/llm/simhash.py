"""Near-duplicates by SimHash fingerprints, found through an index of byte positions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import in_batches, python_values, row_key, small_batches, stored
from tierstone.llm.components import connected_components

SEED, SHINGLE_WORDS, MAX_BITS = 42, 3, 3
BYTES = 8
#: Fingerprints of one posting list compared in one task; longer lists are split first.
LIST_ROWS = 4096
#: Position sets of three bytes, by the smallest known covering: any five of the
#: eight positions contain one of these sets.
_ROWS_OF_POSITIONS = ((0, 1, 2, 3), (4, 5, 6, 7))
POSTING_SETS = tuple(s for half in _ROWS_OF_POSITIONS for s in combinations(half, 3))


def fingerprint(text: bytes | None) -> int:
    """64-bit SimHash of the three-word shingles, repeats included; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    total = max(1, len(words) - SHINGLE_WORDS + 1)
    counts = np.zeros(64, np.int64)
    hashed = np.fromiter(
        (xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, count=total
    )
    for at in range(0, total, 1 << 16):
        octets = hashed[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, content key (row_a, row_b) and fingerprint `fp` (a signed long).

    NULL and empty texts have fingerprint 0. The bytes of the text are hashed as
    they are; only A-Z are lowered.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row_a", pa.int64()), ("row_b", pa.int64()), ("fp", pa.int64())]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_signed(fingerprint(t)) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(found, pa.int64())], schema=schema
            )

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), *row_key(doc_id, text), F.col(text).cast("binary")
    )
    return rows.mapInArrow(work, "doc_id long, row_a long, row_b long, fp long")


def _octets(fp: np.ndarray) -> np.ndarray:
    return fp.astype(">i8").view(np.uint8).reshape(-1, BYTES)


def _verified(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two lists that share at least 8 - MAX_BITS positional bytes
    (each differing byte costs at least one bit) and differ in at most MAX_BITS bits."""
    tally = np.zeros((len(left), len(right)), np.uint8)
    a, b = _octets(left), _octets(right)
    for position in range(BYTES):
        tally += a[:, position, None] == b[None, :, position]
    i, j = np.nonzero(tally >= BYTES - MAX_BITS)
    apart = np.bitwise_count(left[i].view(np.uint64) ^ right[j].view(np.uint64))
    near = apart <= MAX_BITS
    return i[near], j[near]


def _near(left: np.ndarray, right: np.ndarray, same: bool, step: int = 512) -> Iterator[tuple]:
    for at in range(0, len(left), step):
        some, rest = left[at : at + step], right[at:] if same else right
        for i, j in zip(*_verified(some, rest), strict=True):
            yield int(some[i]), int(rest[j])


def _forest(left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple]:
    """Those of the two lists' near pairs that connect what all of them connect: fewer
    than there are members, so a list of near-identical members stays short."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for one, other in _near(left, right, same):
        a, b = root(one), root(other)
        if a != b:
            parent[max(a, b)] = min(a, b)
            yield min(one, other), max(one, other)


def near_links(prints: DataFrame, list_rows: int = LIST_ROWS) -> DataFrame:
    """Links (src, dst) between distinct fingerprints at most three bits apart. Every such
    pair is linked, directly or through others of the same posting list.

    Fingerprints three bits apart share at least five of eight positional bytes.
    The index posts each one under eight sets of three positions with their bytes;
    two that share five share a whole set. Within a list the shared positional bytes
    of each pair are tallied, pairs below five go, the rest are verified bit by bit.
    A list longer than `list_rows` is posted again under every set of five positions;
    what is still longer is cut into blocks, and every two blocks make a group. So no
    group holds more than two blocks, and no pair is left out at any size.
    """
    fives = list(combinations(range(BYTES), BYTES - MAX_BITS))
    lists = _posted(prints, POSTING_SETS, 0)
    crowded = lists.where(F.col("n") > list_rows).select("fp").distinct()
    again = _posted(crowded, fives, len(POSTING_SETS))

    blocks = F.ceil(F.col("n") / list_rows).cast("int")
    long = again.where(F.col("n") > list_rows).withColumn("blocks", blocks)
    long = long.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    long = long.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = long.select(
        "set", "bytes", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        F.col("own").alias("side"), "fp",
    )
    whole = lists.where(F.col("n") <= list_rows).unionByName(again.where(F.col("n") <= list_rows))
    zeros = [F.lit(0).alias(c) for c in ("low", "high", "side")]
    groups = whole.select("set", "bytes", *zeros, "fp").unionByName(paired)
    group = ["set", "bytes", "low", "high"]
    dealt = groups.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(_compare_runs, "src long, dst long")


def _posted(prints: DataFrame, sets, first: int) -> DataFrame:
    """Each fingerprint under every set of positions, with the list's length n where
    it has company; a list is named by the set's number and the bytes there."""

    def masked(number: int, positions) -> Column:
        mask = sum(0xFF << (8 * (BYTES - 1 - p)) for p in positions)
        kept = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        return F.struct(F.lit(first + number).alias("set"), kept.alias("bytes"))

    lists = F.array(*(masked(n, positions) for n, positions in enumerate(sets)))
    rows = prints.select("fp", F.explode(lists).alias("list")).select("fp", "list.*")
    lengths = rows.groupBy("set", "bytes").agg(F.count("*").alias("n")).where("n > 1")
    return rows.join(lengths, ["set", "bytes"])


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare each group of a partition sorted by group; holds one group at a time."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def links() -> Iterator[tuple]:
        for (_, _, low, high), rows in groupby(python_values(batches), key=lambda r: r[:4]):
            held = list(rows)
            fp, side = (np.array([r[c] for r in held], np.int64) for c in (5, 4))
            if low == high:
                yield from _forest(fp, fp, same=True)
            else:
                yield from _forest(fp[side == low], fp[side == high], same=False)

    return in_batches(links(), schema)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, content key, fingerprint and component: the smallest id that
    links of at most three bits lead to.

    Rows with equal fingerprints are one node, so copies cost one count, not pairs.
    NULL, empty and blank texts have fingerprint 0 and link like any other. Rows
    that repeat an id are rows of their own. NULL ids never name a component unless
    all its ids are NULL. Other input columns are left out. An empty table gives none.
    """
    prints = stored(fingerprints(docs, doc_id, text), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    links = stored(near_links(nodes), "near")
    linked = connected_components(links).withColumnRenamed("node", "fp")
    linked = stored(nodes.join(linked, "fp", "left"), "linked")
    least = linked.where("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("least"))
    labels = linked.join(least, "component", "left").select(
        "fp", F.coalesce("least", "first").alias("component_id")
    )
    return prints.join(labels, "fp")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one of each group of near-duplicates: that of smallest id.

    Of rows with that id in the group (also repeated ones) one stays; where all ids
    are NULL, one row stays. All columns are kept, whatever their names.
    """
    found = near_duplicates(docs, doc_id, text)
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_a", "row_b")
    # One component may hold a third of all rows: min() reduces it in every task.
    first = found.groupBy("component_id").agg(F.min(best).alias("best"))
    keepers = stored(first.select(F.col("best.row_a").alias("__row_a"), F.col("best.row_b").alias("__row_b")), "keepers")
    a, b = row_key(doc_id, text)
    keyed = docs.withColumns({"__row_a": a, "__row_b": b})
    stay = keyed.join(keepers, ["__row_a", "__row_b"], "left_semi")
    return stay.dropDuplicates(["__row_a", "__row_b"]).select(*(F.col(f"`{c}`") for c in docs.columns))
