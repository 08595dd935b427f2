"""Hard negatives by exact integer inner products, scored with the Four-Russians method.

Components are small integers. A candidate is indexed as bit planes: for each group of
eight dimensions and each binary place one byte, the place's bits of the eight components.
For an anchor and each group the sums of all 256 subsets of its eight components are
computed once; the product with a candidate is then one table lookup per byte, doubled and
added from the highest place (which counts negative, as in two's complement) to the lowest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import stored

#: Components are multiplied by this and rounded down.
SCALE = 256
#: Dimensions whose bits share a byte.
GROUP = 8
#: Candidates that one task holds, anchors whose tables it holds, candidates scored at a time.
HELD_ROWS, ANCHOR_ROWS, STRIP_ROWS = 65_536, 64, 4_096
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 50, 95

_CODE = "row long, vec_id long, label int, planes binary"
_FOUND = "anchor_row long, anchor_id long, place int, positive_id long, positive_score long, vec_id long, score long"
_FOUND_ARROW = pa.schema([
    ("anchor_row", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
    ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
])


@dataclass(frozen=True)
class Layout:
    """Groups of dimensions, binary places and whether sums fit 32 bits; the same for all rows."""

    groups: int
    places: int
    narrow: bool

    @property
    def kind(self) -> type:
        return np.int32 if self.narrow else np.int64

    @staticmethod
    def of(dimensions: int, largest: int) -> Layout:
        """For components of at most `largest` in size; refuses scores beyond a 64-bit number."""
        groups = max(1, -(-dimensions // GROUP))
        places = max(1, largest.bit_length()) + 1
        # What a sum passes through while places are added is less than twice the largest score.
        bound = 2 * groups * GROUP * (1 << (places - 1)) ** 2
        if bound >= 1 << 63:
            raise OverflowError(f"components up to {largest} in {dimensions} dimensions: scores exceed 64 bits")
        return Layout(groups, places, bound < 1 << 31)

    def pack(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, places, groups) bytes of (rows, dimensions) integers."""
        padded = np.zeros((len(vectors), self.groups, GROUP), np.int64)
        padded.reshape(len(vectors), -1)[:, : vectors.shape[1]] = vectors
        planes = [np.packbits((padded >> p & 1).astype(np.uint8), axis=2, bitorder="little") for p in range(self.places)]
        return np.stack([p[:, :, 0] for p in planes], axis=1)

    def unpack(self, planes: np.ndarray) -> np.ndarray:
        """The integers that `pack` was given, with zeros up to a whole group."""
        bits = np.unpackbits(planes[..., None], axis=3, bitorder="little").astype(np.int64)
        weight = 1 << np.arange(self.places, dtype=np.int64)
        weight[-1] = -weight[-1]
        return np.einsum("rpgi,p->rgi", bits, weight).reshape(len(planes), -1)

    def tables(self, anchors: np.ndarray) -> np.ndarray:
        """(groups, 256, anchors): sums of every subset of each group's components."""
        parts = anchors.reshape(len(anchors), self.groups, GROUP).transpose(1, 2, 0).astype(self.kind)
        sums = np.zeros((self.groups, 1, len(anchors)), self.kind)
        for i in range(GROUP):
            sums = np.concatenate((sums, sums + parts[:, i : i + 1]), axis=1)
        return sums

    def scores(self, tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
        """(candidates, anchors) exact inner products."""
        total = np.zeros((len(planes), tables.shape[2]), self.kind)
        looked_up = np.empty_like(total)
        for place in range(self.places - 1, -1, -1):
            total += total
            for group in range(self.groups):
                np.take(tables[group], planes[:, place, group], axis=0, out=looked_up, mode="clip")
                total += looked_up
            if place == self.places - 1:
                np.negative(total, out=total)
        return total


def whole_components(embedding: Column) -> Column:
    """Components times `SCALE`, rounded down, as whole numbers held in doubles."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("double"))


def usable(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    """(vec_id, label, v) of the rows that take part."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    narrow = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("int").alias("label"),
        F.col(embedding).alias("embedding"),
    )
    return narrow.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(
        finite
    ).select("vec_id", "label", whole_components(F.col("embedding")).alias("v"))


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest scores, ties to the smaller id."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= bar)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near].astype(np.int64)))[:k]]


class Held:
    """The candidates of one task, ordered by label, and the scores of anchors with them."""

    def __init__(self, layout: Layout, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        row, ids, label, planes = (np.concatenate(x) for x in zip(*rows, strict=True))
        order = np.argsort(label, kind="stable")
        self.layout, self.row, self.ids = layout, row[order], ids[order]
        self.label, self.planes = label[order], planes[order]

    def of_label(self, label: int) -> slice:
        return slice(*np.searchsorted(self.label, (label, label + 1)).tolist())

    def score(self, anchors: np.ndarray, part: slice) -> np.ndarray:
        """(anchors, candidates of the part), strip by strip."""
        tables = self.layout.tables(self.layout.unpack(anchors))
        planes = self.planes[part]
        found = np.empty((len(anchors), len(planes)), self.layout.kind)
        for start in range(0, len(planes), STRIP_ROWS):
            strip = planes[start : start + STRIP_ROWS]
            found[:, start : start + STRIP_ROWS] = self.layout.scores(tables, strip).T
        return found


def _columns(batch: pa.RecordBatch, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(b"".join(batch.column("planes").to_pylist()), np.uint8)
    return (
        *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "label")),
        planes.reshape(batch.num_rows, layout.places, layout.groups),
    )


def _meet(layout: Layout, answer):
    """A task's function: it holds a group's candidates, which come first, and answers its
    anchors as they stream past, `ANCHOR_ROWS` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, rows = None, None, []
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("group", "asks")], axis=1)
            cuts = np.flatnonzero(np.any(marks[1:] != marks[:-1], axis=1)) + 1
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(marks)], strict=True):
                piece = batch.slice(start, end - start)
                if marks[start, 0] != group:
                    group, held, rows = marks[start, 0], None, []
                if not marks[start, 1]:
                    rows.append(_columns(piece, layout))
                    continue
                if rows:
                    held, rows = Held(layout, rows), []
                if held is None:
                    continue
                for at in range(0, piece.num_rows, ANCHOR_ROWS):
                    found = answer(held, piece.slice(at, ANCHOR_ROWS))
                    if found:
                        columns = zip(*found, strict=True)
                        arrays = [pa.array(c, f.type) for c, f in zip(columns, _FOUND_ARROW, strict=True)]
                        yield pa.RecordBatch.from_arrays(arrays, schema=_FOUND_ARROW)

    return run


def _positives(held: Held, asking: pa.RecordBatch) -> list[tuple]:
    """Each anchor's best rows of its own label, itself left out."""
    row, ids, label, planes = _columns(asking, held.layout)
    found = []
    for value in np.unique(label).tolist():
        part, ours = held.of_label(value), np.flatnonzero(label == value)
        scores = held.score(planes[ours], part)
        for anchor, score in zip(ours.tolist(), scores, strict=True):
            others = np.flatnonzero(held.row[part] != row[anchor])
            for at in others[_first(held.ids[part][others], score[others], POSITIVES)].tolist():
                found.append((int(row[anchor]), int(ids[anchor]), None, None, None, int(held.ids[part][at]), int(score[at])))
    return found


def _negatives(held: Held, asking: pa.RecordBatch) -> list[tuple]:
    """Each anchor's and positive's best rows of another label within the bounds."""
    row, ids, label, planes = _columns(asking, held.layout)
    scores = held.score(planes, slice(0, len(held.ids)))
    wanted = asking.column("positives").to_pylist()
    found = []
    for anchor, positives in enumerate(wanted):
        same = held.of_label(int(label[anchor]))
        other = np.ones(len(held.ids), bool)
        other[same] = False
        score = scores[anchor]
        for positive in positives:
            p = positive["score"]
            # 50 p <= 100 n <= 95 p, in whole numbers; a negative p leaves nothing between.
            low, high = -(-LEAST * p // 100), MOST * p // 100
            near = np.flatnonzero(other & (score >= low) & (score <= high))
            for at in near[_first(held.ids[near], score[near], NEGATIVES)].tolist():
                found.append((
                    int(row[anchor]), int(ids[anchor]), positive["place"], positive["vec_id"], p,
                    int(held.ids[at]), int(score[at]),
                ))
    return found


def _asked(codes: DataFrame, anchors: DataFrame, groups: int, answer) -> DataFrame:
    """Every group's candidates met by all anchors: candidates move once, anchors to each group."""
    held = codes.withColumn("asks", F.lit(0))
    if "positives" in anchors.columns:
        held = held.withColumn("positives", F.lit(None).cast(anchors.schema["positives"].dataType))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    asking = anchors.withColumn("group", every).withColumn("asks", F.lit(1))
    both = held.unionByName(asking.select(*held.columns))
    # By range, not by hash: as many groups as partitions would collide under a hash.
    dealt = both.repartitionByRange(groups, "group").sortWithinPartitions("group", "asks", "label", "row")
    return dealt.mapInArrow(answer, _FOUND)


def mine(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` is a condition on the column `vec_id`. Rows without an id, label or vector,
    or with a component that is NULL or not finite, take no part. Vectors of different length
    are compared as if the shorter one ended in zeros; an empty vector scores 0. Ties go to the
    smaller id. Repeated rows are rows of their own: a copy of an anchor is its positive, and a
    repeated anchor has its negatives once per row. A positive with fewer than three rows in
    bounds has as many as there are; with a negative score it has none. No anchors, or an
    empty table, give no row. Scores that a 64-bit number cannot hold raise OverflowError.

    Candidates are dealt into groups of at most about `HELD_ROWS`, as many as there are
    shuffle partitions at least, by a hash of id, vector and place in
    the table, so equal rows spread. A task holds one group and streams the anchors, a stated
    query set, past it: candidates are shuffled once per pass, anchors once per group. First
    anchors meet rows of their own label (positives), then, with bounds, all others.
    """
    whole = stored(usable(vectors, vec_id, embedding, label).withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = F.transform("v", lambda x: F.abs(x))
    facts = whole.agg(
        F.count("*").alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dimensions"),
        F.coalesce(F.max(F.array_max(size)), F.lit(0.0)).alias("largest"),
    ).first()
    layout = Layout.of(facts["dimensions"], int(facts["largest"]))
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, partitions, -(-facts["n"] // HELD_ROWS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            wide = np.zeros((batch.num_rows, layout.groups * GROUP), np.int64)
            wide[np.arange(wide.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
            packed = layout.pack(wide)
            columns = [batch.column(c) for c in ("row", "vec_id", "label")]
            planes = pa.array([x.tobytes() for x in packed], pa.binary())
            yield pa.RecordBatch.from_arrays([*columns, planes], ["row", "vec_id", "label", "planes"])

    group = F.pmod(F.xxhash64("vec_id", "planes", "row"), F.lit(groups)).cast("int")
    codes = stored(
        whole.select("row", "vec_id", "label", "v").mapInArrow(pack, _CODE).withColumn("group", group), "codes"
    )
    anchors = codes.where(is_anchor)
    best = Window.partitionBy("anchor_row").orderBy(F.desc("score"), "vec_id")
    near = _asked(codes, anchors, groups, _meet(layout, _positives)).withColumn("place", F.row_number().over(best))
    near = near.where(F.col("place") <= POSITIVES).groupBy("anchor_row").agg(
        F.collect_list(F.struct("place", "vec_id", "score")).alias("positives")
    )
    bounded = stored(
        anchors.join(near, F.col("row") == F.col("anchor_row")).drop("anchor_row"), "anchors"
    )
    found = _asked(codes, bounded, groups, _meet(layout, _negatives))
    best = Window.partitionBy("anchor_row", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= NEGATIVES)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def relabelled(vectors: DataFrame) -> DataFrame:
    """Every seventh id with the next of ten labels, so that some neighbours disagree."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.cast("int").alias("label"))


def oracle(embeddings: str = "embeddings") -> str:
    """The same rows in DuckDB's SQL: every product, two ranked windows."""
    return f"""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM {embeddings}
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    list_inner_product(a.v, c.v)::BIGINT AS score
  FROM usable a JOIN usable c ON a.r <> c.r WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor, vec_id AS positive_id, score AS positive_score, place FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS place
    FROM scored WHERE same) WHERE place <= 5),
ranked AS (
  SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY anchor, place ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 3"""
