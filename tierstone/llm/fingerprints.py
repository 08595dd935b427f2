"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Every shingle is hashed once. The first bits of a hash name its bin, the least hash of each
bin stands for the bin, and a bin that no shingle fell into takes the value of another bin:
of the filled bins the one that comes first in the empty bin's own order, a 2-universal
hash of the bins (optimal densification). A fingerprint keeps a few low-order bits of each
bin's value, rehashed with the bin's number, packed into one string of hexadecimal digits.
The share of equal places, corrected for places that agree by chance, is the likeness.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import stored
from tierstone.operators.once import with_once

SHINGLE = 5
#: 2^7 bins; hashes have 31 bits, of which the first 7 name the bin.
BIN_BITS, HASH_BITS = 7, 31
BINS = 1 << BIN_BITS
#: Low-order bits kept of each bin, two hexadecimal digits.
KEPT_BITS = 8
CHANCE = 1 / (1 << KEPT_BITS)
PRIME = 2147483647
#: Bins that an empty bin asks before it puts all filled ones in order; speed only.
FIRST_ASKED = 16

WORD = r"[^\x20\x09-\x0D]+"
#: Blocks of documents in order, per shuffle partition, and at most: their first keys are sent to every task.
BLOCKS_PER_PARTITION, MOST_BLOCKS = 4, 65_536
#: Equal rows that make up this share of the table are counted instead of moved; at most 1 / share such groups.
HOT_SHARE = 0.001
#: Equal rows that one task writes.
COPIES_AT_ONCE = 10_000


def _constant(role: str, number: int) -> int:
    """A number from 1 to 2^28 that follows from its role and number."""
    return 1 + int(hashlib.md5(f"{role}/{number}".encode()).hexdigest()[:7], 16)


def _numbers(values: Iterable[int]) -> Column:
    """A constant array, given as one text."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _constants(role: str) -> Column:
    return _numbers(_constant(role, b) for b in range(BINS))


def _order(empty: int, other: int) -> int:
    """Where a bin stands in the order in which an empty bin asks the others; all differ."""
    return ((other + 1) * _constant("turn", empty) + _constant("shift", empty)) % PRIME * BINS + other


def _bin(value: Column) -> Column:
    return F.shiftright(value, HASH_BITS - BIN_BITS)


def _shingle_hashes(words: Column) -> Column:
    """Of an array of word checksums: for each run of five words (all, if fewer) a sum with a
    factor per place, modulo a prime; a missing word adds nothing."""
    total = F.transform(words, lambda w: w * F.lit(_constant("word", 0)))
    for k in range(1, SHINGLE):
        factor = F.lit(_constant("word", k))
        later = F.slice(words, k + 1, F.size(words))
        total = F.zip_with(total, later, lambda t, w: t + F.coalesce(w, F.lit(0)) * factor)  # noqa: B023
    whole = F.least(F.size(words), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1)))
    return F.transform(F.slice(total, F.lit(1), whole), lambda t: t % PRIME)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add the fingerprint of a text column, which must not be NULL, as an array with one code
    per bin: the bin's number, then the low-order bits kept of it. `packed` makes a text of it.

    Words are what stands between blanks. Shingles are five words, or all words of a text with
    fewer. A text without words has the bits zero in every bin, like any other such text.
    """
    own = lambda part: f"__{name}_{part}"
    hashes, least, bins = (F.col(own(x)) for x in ("hashes", "least", "bins"))
    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    df = with_once(df, own("words"), F.transform(words, lambda w: F.crc32(w.cast("binary"))))
    df = with_once(df, own("hashes"), F.sort_array(_shingle_hashes(F.col(own("words")))))
    first_of_bin = F.filter(hashes, lambda h, i: (i == 0) | (_bin(h) != _bin(F.get(hashes, i - 1))))
    df = with_once(df, own("least"), first_of_bin)
    df = with_once(df, own("bins"), F.transform(least, _bin))

    turn, shift, factor, offset = map(_constants, ("turn", "shift", "factor", "offset"))
    first = _numbers(o for b in range(BINS) for o in sorted(range(BINS), key=lambda o: _order(b, o))[:FIRST_ASKED])
    at = lambda table, place: F.get(table, place.cast("int"))

    def code(value: Column, place: Column) -> Column:
        mixed = (value * at(factor, place) + at(offset, place)) % PRIME % (1 << KEPT_BITS)
        return (place * (1 << KEPT_BITS) + mixed).cast("int")

    def lender(place: Column) -> Column:
        """The filled bin that is first in this bin's order: mostly among the first asked."""
        asked = F.array_intersect(F.slice(first, (place * FIRST_ASKED + 1).cast("int"), FIRST_ASKED), bins)
        order = F.transform(bins, lambda o: ((o + 1) * at(turn, place) + at(shift, place)) % PRIME * BINS + o)
        return F.coalesce(F.get(asked, F.lit(0)), F.array_min(order) % BINS)

    places = _numbers(range(BINS))
    lent = F.transform(
        F.array_except(places, bins), lambda b: code(at(least, F.array_position(bins, lender(b)) - 1), b)
    )
    codes = F.concat(F.transform(least, lambda v: code(v, _bin(v))), lent)
    zeros = F.transform(places, lambda b: (b * (1 << KEPT_BITS)).cast("int"))
    df = with_once(df, name, F.when(F.size(least) == 0, zeros).otherwise(F.sort_array(codes)))
    return df.drop(*(own(x) for x in ("words", "hashes", "least", "bins")))


def packed(codes: Column) -> Column:
    """The bits kept of each bin as two hexadecimal digits, in the order of the bins."""
    digits = F.split(F.lit(" ".join(f"{v:02x}" for v in range(1 << KEPT_BITS))), " ")
    return F.array_join(F.transform(codes, lambda c: F.get(digits, c % (1 << KEPT_BITS))), "")


def unpacked(fingerprint: Column) -> Column:
    """The codes of a packed fingerprint."""
    byte = lambda digits, place: F.conv(digits, 16, 10).cast("int") + place * (1 << KEPT_BITS)
    return F.transform(F.regexp_extract_all(fingerprint, F.lit(".."), F.lit(0)), byte)


def likeness(one: Column, other: Column) -> Column:
    """Estimated share of shingles in common, 0 to 1, of two fingerprints as codes: their equal
    bins, without those equal by chance."""
    share = F.size(F.array_intersect(one, other)) / F.lit(float(BINS))
    return F.greatest(F.lit(0.0), (share - F.lit(CHANCE)) / F.lit(1 - CHANCE))


def _ordered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and a key that sorts like the id (NULL first), then like the text's md5."""
    narrow = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    order = F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    return with_once(narrow, "key", F.concat(F.coalesce(order, F.lit("-")), F.md5("text")))


def _block_of(key: Column, starts: Column, blocks: int) -> Column:
    """How many block starts come before or at a key, less one, by two short scans."""
    step = max(1, int(blocks**0.5))
    coarse = F.filter(starts, lambda s, i: (i % step == 0) & (s <= key))
    skipped = (F.size(coarse) - 1) * step
    fine = F.filter(F.slice(starts, skipped + 1, step), lambda s: s <= key)
    return (skipped + F.size(fine) - 1).cast("int")


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The documents (doc_id, text, fingerprint) with the text and fingerprint of the next one
    in ascending id, the first after the last; and the equal rows (doc_id, text, fingerprint,
    copies) that were left out because their next document is a copy of themselves.

    Blocks of consecutive documents are cut where a range partitioning of the ids cuts them.
    Each block also gets the first document of the block after it, so a task needs no other
    block, and every text is shuffled once.
    """
    spark = docs.sparkSession
    ordered = _ordered(docs, doc_id, text)
    keys = stored(ordered.groupBy("key").agg(F.count("*").alias("n")), "keys")
    total = F.coalesce(keys.agg(F.sum("n")).scalar(), F.lit(0))
    # At most 1 / HOT_SHARE keys.
    hot = stored(keys.where((F.col("n") > 1) & (F.col("n") >= total * HOT_SHARE)), "hot")
    common = F.broadcast(hot.select("key"))
    repeated = ordered.join(common, "key", "left_semi").groupBy("doc_id", "text", "key").agg(F.count("*").alias("copies"))
    repeated = stored(repeated, "repeated")

    blocks = min(MOST_BLOCKS, BLOCKS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = keys.select("key").repartitionByRange(blocks, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("start"))
    # One key per block, so at most MOST_BLOCKS of them.
    found = sorted(row["start"] for row in cut.collect())
    starts = F.split(F.lit(",".join(found)), ",")

    rows = ordered.join(common, "key", "left_anti").unionByName(repeated.drop("copies"))
    rows = with_once(with_fingerprint(rows, "text", "fingerprint"), "own", _block_of(F.col("key"), starts, len(found)))
    first = F.col("key") == F.get(starts, F.col("own"))
    before = F.when(F.col("own") == 0, len(found) - 1).otherwise(F.col("own") - 1)
    here = F.struct(F.col("own").alias("block"), F.lit(False).alias("guest"))
    there = F.struct(before.alias("block"), F.lit(True).alias("guest"))
    dealt = rows.select("*", F.explode(F.when(first, F.array(here, there)).otherwise(F.array(here))).alias("at"))
    order = Window.partitionBy("at.block").orderBy("at.guest", "key")
    following = dealt.select(
        "doc_id", "text", "fingerprint", "at", F.lead("text").over(order).alias("next_text"),
        F.lead("fingerprint").over(order).alias("next_fingerprint"),
    ).where("NOT at.guest")
    copies = with_fingerprint(repeated.withColumn("copies", F.col("copies") - 1), "text", "fingerprint")
    return following.drop("at"), copies.select("doc_id", "text", "fingerprint", "copies")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last quarter of code points replaced by as many (or
    all) of the first ones of the next document, in ascending id, after the last the first.

    NULL and empty texts are alike: zero code points, an empty edited text, the fingerprint of
    zeros. NULL ids come first and are kept. Rows with one id are ordered by the md5 of their
    texts; of equal rows all but the last have a copy of themselves as next document. A single
    document is its own next one. Other columns of the input, whatever their names, are left
    out. An empty table gives an empty one.
    """
    rows, copies = with_next(docs, doc_id, text)
    again = copies.withColumns({"next_text": F.col("text"), "next_fingerprint": F.col("fingerprint")})
    many = _edited(again, "copies")
    # Equal rows are written by several tasks: numbered portions first, then the rows of each.
    portion = F.explode(
        F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.lit(COPIES_AT_ONCE)))
    )
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = many.withColumn("portion", portion).repartition(width, "fingerprint", "portion")
    left = F.least(F.col("copies") - F.col("portion") * COPIES_AT_ONCE, F.lit(COPIES_AT_ONCE))
    each = dealt.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    one = _edited(rows)
    return one.unionByName(each.select(*one.columns))


def _edited(rows: DataFrame, *more: str) -> DataFrame:
    chars = F.length("text").cast("long")
    rows = rows.select("*", chars.alias("n_chars"), F.floor(chars / 4).cast("int").alias("moved"))
    kept = F.substring("text", F.lit(1), (F.col("n_chars") - F.col("moved")).cast("int"))
    edited = F.concat(kept, F.substring("next_text", F.lit(1), F.col("moved")))
    rows = with_fingerprint(with_once(rows, "edited", edited), "edited", "edited_fingerprint")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("fingerprint")).alias("fingerprint"), packed(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"), *more,
    )


def oracle(documents: str = "documents") -> str:
    """The same rows in DuckDB's SQL: bins by grouping, empty ones filled by a join."""
    def constant(role: str, number: str) -> str:
        return f"(1 + ('0x' || substr(md5('{role}/' || {number}), 1, 7))::BIGINT)"

    def near(one: str, other: str) -> str:
        equal = f"len(list_filter(range(1, {2 * BINS + 1}, 2), lambda i: substr({one}, i, 2) = substr({other}, i, 2)))"
        return f"greatest(0.0::DOUBLE, ({equal}::DOUBLE / {BINS}::DOUBLE - {CHANCE}::DOUBLE) / {1 - CHANCE}::DOUBLE)"

    sums = " + ".join(
        f"coalesce(lead(w, {k}) OVER o, 0) * {_constant('word', k)}" for k in range(SHINGLE)
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(text, ''))) AS r, doc_id, coalesce(text, '') AS text
  FROM {documents}),
paired AS (
  SELECT r, doc_id, text, length(text) AS n,
    coalesce(lead(r) OVER (ORDER BY r), 1) AS next_r,
    coalesce(lead(text) OVER (ORDER BY r), first_value(text) OVER (ORDER BY r)) AS next_text
  FROM docs),
edited AS (
  SELECT *, substr(text, 1, (n - n // 4)::BIGINT) || substr(next_text, 1, (n // 4)::BIGINT) AS edited FROM paired),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS t, text FROM (SELECT text FROM edited UNION SELECT edited FROM edited)),
crc_table AS (
  SELECT list(v ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
split AS (SELECT t, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM (
  SELECT t, regexp_extract_all(text, '{WORD}') AS words FROM texts)),
words AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
      regexp_extract_all(hex(encode(word)), '..'), lambda h: ('0x' || h)::BIGINT)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS w
  FROM (SELECT DISTINCT word FROM split), crc_table),
hashed AS (
  SELECT t, ({sums}) % {PRIME} AS h, place, count(*) OVER (PARTITION BY t) AS n
  FROM split JOIN words USING (word) WINDOW o AS (PARTITION BY t ORDER BY place)),
filled AS MATERIALIZED (SELECT t, h >> {HASH_BITS - BIN_BITS} AS bin, min(h) AS v
  FROM hashed WHERE place <= greatest(n - {SHINGLE - 1}, 1) GROUP BY ALL),
bins AS MATERIALIZED (SELECT b, {constant('turn', 'b')} AS turn, {constant('shift', 'b')} AS shift,
  {constant('factor', 'b')} AS factor, {constant('offset', 'b')} AS off FROM range({BINS}) x(b)),
dense AS (
  SELECT t, b, any_value(factor) AS factor, any_value(off) AS off,
    arg_min(v, CASE WHEN bin = b THEN -1 ELSE ((bin + 1) * turn + shift) % {PRIME} * {BINS} + bin END) AS v
  FROM filled, bins GROUP BY t, b),
packed AS (
  SELECT t, string_agg(format('{{:02x}}', (v * factor + off) % {PRIME} % {1 << KEPT_BITS}), '' ORDER BY b) AS fp
  FROM dense GROUP BY t),
prints AS (SELECT text AS t, coalesce(fp, repeat('00', {BINS})) AS fp FROM texts LEFT JOIN packed USING (t)),
all_prints AS (
  SELECT e.r, e.next_r, e.doc_id, e.n, e.edited, p.fp, q.fp AS edited_fp
  FROM edited e JOIN prints p ON p.t = e.text JOIN prints q ON q.t = e.edited)
SELECT a.doc_id, a.n::BIGINT AS n_chars, sha256(a.edited) AS edited_sha256, a.fp AS fingerprint,
  a.edited_fp AS edited_fingerprint, {near('a.fp', 'a.edited_fp')} AS near_edited, {near('a.fp', 'b.fp')} AS near_next
FROM all_prints a JOIN all_prints b ON b.r = a.next_r"""
