"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import stored

LAW = "key"
#: Each shard is numbered in so many blocks side by side.
BLOCKS = 256
RACKS_IN_REGION, SHARDS_IN_RACK = 3, 2


@dataclass(frozen=True)
class Leaf:
    """A shard and where it stands. Rack and shard numbers are unique in the tree."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


def regular_tree(shards: int) -> list[Leaf]:
    """Shards of equal weight, two in a rack and three racks in a region."""
    return [
        Leaf(s // (RACKS_IN_REGION * SHARDS_IN_RACK), s // SHARDS_IN_RACK, s) for s in range(shards)
    ]


def grow(tree: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, alone in a rack and region of its own.

    Only the new region's draw is new, so rows move into the new shard and nowhere
    else. Raising a weight inside an old region would move rows within that
    region's subtree as well.
    """
    new = Leaf(*(1 + max(getattr(x, f) for x in tree) for f in ("region", "rack", "shard")), weight)
    return [*tree, new]


def _children(tree: Sequence[Leaf], parent: str | None, child: str) -> list[list[tuple[int, float]]]:
    """Per parent number, its children with the weights of the shards below them."""
    size = 1 + (max(getattr(leaf, parent) for leaf in tree) if parent else 0)
    found: list[dict[int, float]] = [{} for _ in range(size)]
    for leaf in tree:
        below = found[getattr(leaf, parent) if parent else 0]
        node = getattr(leaf, child)
        below[node] = below.get(node, 0.0) + leaf.weight
    return [sorted(below.items()) for below in found]


def _draw(key: Column, level: str, children: list[list[tuple[int, float]]], parent: Column) -> Column:
    """The child with the greatest ln(u) / weight, u from a hash of key, level and child.

    A child's draw depends on nothing but itself: where one weight changes, rows
    move to or from that child only. Equal draws go to the smaller number.
    """
    def node(number: int, weight: float) -> Column:
        return F.struct(F.lit(number).alias("node"), F.lit(float(weight)).alias("weight"))

    nodes = F.array(*(F.array(*(node(*c) for c in below)) for below in children if below))
    places = [i for i, below in enumerate(children) if below]
    at = F.lit(1) if len(places) == 1 else F.array_position(F.array(*map(F.lit, places)), parent)

    def straw(child: Column) -> Column:
        seed = F.concat(F.lit(f"{level}/"), child["node"].cast("string"), F.lit("/"), key)
        bits = F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("double")
        u = (bits + 0.5) / float(1 << 52)
        return F.struct((F.log(u) / child["weight"]).alias("draw"), (-child["node"]).alias("node"))

    live = F.filter(F.element_at(nodes, at.cast("int")), lambda c: c["weight"] > 0)
    return -F.array_max(F.transform(live, straw))["node"]


def place(df: DataFrame, key: Column, tree: Sequence[Leaf], name: str) -> DataFrame:
    """Add the shard of every row: one draw on each level, a child's weight being
    that of all shards below it. A NULL key is drawn like the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    region, rack = f"__{name}_region", f"__{name}_rack"
    steps = (
        (region, "region", _children(tree, None, "region"), F.lit(0)),
        (rack, "rack", _children(tree, "region", "rack"), F.col(region)),
        (name, "shard", _children(tree, "rack", "shard"), F.col(rack)),
    )
    for column, level, children, parent in steps:
        df = df.withColumn(column, _draw(text, level, children, parent))
    return df.drop(region, rack)


def shard_documents(
    docs: DataFrame, tree: Sequence[Leaf], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row with its shard, its place in the shard and its shard once the tree has grown.

    Law `key`: the id and the tree decide, and one more shard takes rows only into
    itself. Size is the UTF-8 bytes of the text (NULL: none) plus 8. Slots count a
    shard's rows from 0 without gaps, by block, id, size and checksum; a block is a
    hash of these three, so a hot id with different texts fills many blocks, and no
    window holds a whole shard. NULL ids are placed like an empty id. NULL text has
    the checksum of the empty text. Repeated rows each get a slot. Other columns of
    the input, whatever their names, are left out. An empty table gives an empty one.
    """
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = place(narrow, F.col("doc_id"), tree, "shard")
    placed = place(placed, F.col("doc_id"), grow(tree), "grown_shard")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "size", "text_crc32")]
    digest = F.substring(F.md5(F.concat_ws("/", F.lit("slot"), *parts)), 1, 2)
    placed = stored(placed.withColumn("block", F.conv(digest, 16, 10).cast("int")), "placed")
    return _with_slots(placed).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard"
    )


def _with_slots(placed: DataFrame) -> DataFrame:
    """Number the rows of each shard: rows of earlier blocks, then the rank in the block."""
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    starts = counts.select(
        "shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    within = Window.partitionBy("shard", "block").orderBy("doc_id", "size", "text_crc32")
    ranked = placed.withColumn("rank", F.row_number().over(within))
    slot = (F.col("start") + F.col("rank") - 1).cast("long").alias("slot")
    return ranked.join(starts, ["shard", "block"]).select("*", slot)


def oracle(shards: int, documents: str = "documents") -> str:
    """The same rows in DuckDB's SQL, for a regular tree."""
    def values(tree: Sequence[Leaf]) -> str:
        return ", ".join(f"({x.region}, {x.rack}, {x.shard}, {x.weight})" for x in tree)

    def levels(name: str, tree: Sequence[Leaf]) -> str:
        """One statement per level: join the children, rank their draws, keep the first."""
        text, parent = "", ""
        for level in ("region", "rack", "shard"):
            on = f"JOIN (SELECT {parent + ', ' if parent else ''}{level}, sum(weight) AS w FROM {name}_leaf GROUP BY ALL) c"
            on += f" ON c.{parent} = r.{parent}" if parent else " ON true"
            source = f"{name}_{parent}" if parent else "keyed"
            text += f""", {name}_{level} AS (
  SELECT k, n, {level} FROM (
    SELECT k, n, c.{level}, row_number() OVER (PARTITION BY n ORDER BY
      ln((('0x' || substr(md5('{level}/' || c.{level} || '/' || k), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) / w DESC,
      c.{level}) AS best
    FROM {source} r {on}) WHERE best = 1)"""
            parent = level
        return text

    tree = regular_tree(shards)
    # crc32 byte by byte, with the usual reflected polynomial.
    return f"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
keyed AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, row_number() OVER () AS n,
    coalesce(strlen(text), 0) + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
          regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM {documents}, crc_table),
old_leaf(region, rack, shard, weight) AS (VALUES {values(tree)}),
new_leaf(region, rack, shard, weight) AS (VALUES {values(grow(tree))})
{levels('old', tree)}{levels('new', grow(tree))},
placed AS (
  SELECT doc_id, size, text_crc32, o.shard, g.shard AS grown_shard,
    ('0x' || substr(md5('slot/' || keyed.k || '/' || size || '/' || text_crc32), 1, 2))::BIGINT AS block
  FROM keyed JOIN old_shard o USING (n) JOIN new_shard g USING (n))
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'key' AS law,
  shard::INTEGER AS shard,
  (row_number() OVER (PARTITION BY shard ORDER BY block, doc_id NULLS FIRST, size, text_crc32) - 1)::BIGINT AS slot,
  grown_shard::INTEGER AS grown_shard
FROM placed"""
