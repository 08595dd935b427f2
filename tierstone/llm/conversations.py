"""Repair of conversations: the cheapest edits that give a legal order of roles.

A conversation of n rows is a lattice of n + 1 layers with one node per state of the rule
"nothing, or one system turn at most and then user and assistant in turn, ending with the
assistant". Keeping, rewriting or deleting a row leads to the next layer, inserting a turn
stays in the layer. Prices of the nodes are found by the auction algorithm for shortest
paths: a path grows from a node along the cheapest arc, as long as the node's price equals
what that arc leads to; where the price is lower, it is raised and the path drops its last
node. Converged prices are distances to the end, so the arcs of all cheapest paths are tight,
and following the tight arc with the least letter gives the least of the cheapest edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import stored

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
#: What follows each state, if a turn is inserted or rewritten.
TURN_AFTER = (USER, USER, ASSISTANT, USER)
#: What follows each state, if a turn with this initial is kept.
KEPT_AFTER = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
LEGAL_PAIRS = {"su", "ua", "au"}
INSERT, REWRITE, DELETE, TRUNCATED = 2, 2, 3, 1
FINE, BLANK, DUPLICATE, CUT = range(4)
#: Rows of a conversation whose prices are held at once.
SEGMENT = 4096

_BLANKS = r"\x20\x09-\x0D"

_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
_RESULT_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def _arcs(state: int, initial: str, fault: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state in the next layer) of a row's edits, by letter."""
    arcs = [("D", DELETE, state)]
    if fault in (FINE, CUT):
        extra = TRUNCATED if fault == CUT else 0
        if initial in KEPT_AFTER[state]:
            arcs.append(("K", extra, KEPT_AFTER[state][initial]))
        arcs.append(("R", REWRITE + extra, TURN_AFTER[state]))
    return arcs


def _auction(leads: list[list[tuple[int, int | None, int]]]) -> tuple[int, ...]:
    """Prices of a layer's nodes. `leads[q]` lists arcs (cost, node of the same layer or None,
    price behind it if it leaves the layer). One path per origin; a settled node ends it."""
    price, settled = [0] * len(leads), [False] * len(leads)
    for origin in range(len(leads)):
        path = [origin]
        while path[-1] is not None and not settled[path[-1]]:
            node = path[-1]
            best, _, after = min(
                (cost + (ahead if after is None else price[after]), -1 if after is None else after, after)
                for cost, after, ahead in leads[node]
            )
            if price[node] < best:  # contraction
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:  # extension
                path.append(after)
        for node in path:
            if node is not None:
                settled[node] = True
    return tuple(price)


@lru_cache(maxsize=65536)
def _relative_layer(initial: str, fault: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Prices of a layer, given those of the next one."""
    return _auction([
        [(INSERT, TURN_AFTER[q], 0), *((cost, None, behind[after]) for _, cost, after in _arcs(q, initial, fault))]
        for q in range(4)
    ])


def layer_prices(initial: str, fault: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    least = min(behind)
    return tuple(p + least for p in _relative_layer(initial, fault, tuple(p - least for p in behind)))


#: Prices of the layer after the last row: nothing and "assistant" are legal ends.
END_PRICES = _auction([
    [(INSERT, TURN_AFTER[q], 0), *([(0, None, 0)] if q in (START, ASSISTANT) else [])] for q in range(4)
])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and letters of the least of the cheapest edits; a byte per row, see `row_code`.

    Prices are held for one segment of rows and for the ends of the others, so memory beside
    the letters is that of a segment.
    """
    ends = [END_PRICES]
    for start in range((len(codes) - 1) // SEGMENT * SEGMENT if codes else -1, -1, -SEGMENT):
        prices = ends[-1]
        for code in reversed(codes[start : start + SEGMENT]):
            prices = layer_prices(*_decoded(code), prices)
        ends.append(prices)
    cost, state, letters = ends[-1][START], START, []
    for start in range(0, len(codes), SEGMENT):
        ends.pop()
        part = codes[start : start + SEGMENT]
        layers = [ends[-1]]
        for code in reversed(part):
            layers.append(layer_prices(*_decoded(code), layers[-1]))
        for code in part:
            here, behind = layers.pop(), layers[-1]
            while True:
                arcs = [(letter, c + behind[after], after, True) for letter, c, after in _arcs(state, *_decoded(code))]
                arcs.append(("I", INSERT + here[TURN_AFTER[state]], TURN_AFTER[state], False))
                letter, _, after, moved = min(a for a in arcs if a[1] == here[state])
                letters.append(letter)
                state = after
                if moved:
                    break
    while END_PRICES[state]:
        letters.append("I")
        state = TURN_AFTER[state]
    return cost, "".join(letters)


_INITIALS = "sua?"


def row_code(role: str, fault: int) -> int:
    initial = _INITIALS.find(role[:1]) if role else 3
    return 4 * (initial if initial >= 0 else 3) + fault


def _decoded(code: int) -> tuple[str, int]:
    return _INITIALS[code // 4], code % 4


class _Conversation:
    """One conversation as its rows stream past: first all without texts, then all with."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.codes = bytearray()
        self.turns, self.first_turn, self.last_turn = 0, None, None
        self.faults, self.illegal = [0, 0, 0, 0], 0
        self.before: tuple | None = None
        self.digest = None

    def judge(self, turn: int | None, role: str, digest: str, blank: bool, truncated: bool, again: bool) -> None:
        """A row without its text. `again`: an earlier turn has the same role and text."""
        same = (turn, role, digest)
        if blank:
            fault = BLANK
        elif again or same == self.before:
            fault = DUPLICATE
        else:
            fault = CUT if truncated else FINE
        if self.before is not None and self.before[1][:1] + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.before = same
        self.faults[fault] += 1
        self.codes.append(row_code(role, fault))

    def _edit(self) -> None:
        self.cost, self.audit = cheapest_edits(bytes(self.codes))
        self.at, self.state, self.lines, self.digest = 0, START, 0, hashlib.sha256()

    def _emit(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = TURN_AFTER[self.state]
            self._emit(ROLES[self.state], "")
            self.at += 1

    def repair(self, role: str, text: str) -> None:
        """A row with its text."""
        if self.digest is None:
            self._edit()
        self._inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = KEPT_AFTER[self.state][role[:1]]
            self._emit(role, text)
        elif letter == "R":
            self.state = TURN_AFTER[self.state]
            self._emit(ROLES[self.state], text)

    def result(self) -> tuple:
        if self.digest is None:
            self._edit()
        self._inserted()
        gaps = 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        faults = (self.faults[f] for f in (BLANK, DUPLICATE, CUT))
        return (self.conv_id, gaps, *faults, self.illegal, self.cost, self.audit, self.digest.hexdigest())


def _repair_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's conversations, one after the other; memory holds a byte or two per row of one."""
    def packed(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _RESULT_ARROW, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_RESULT_ARROW)

    now, done = None, []
    for batch in batches:
        for conv_id, part, turn, role, digest, blank, truncated, again, text in zip(
            *(batch.column(c).to_pylist() for c in _STREAM), strict=True
        ):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv_id)
            if part == 0:
                now.judge(turn, role, digest, blank, truncated, again)
            elif part == 1:
                now.repair(role, text)
        if done:
            yield packed(done)
            done = []
    if now is not None:
        yield packed([now.result()])


_STREAM = ("conv_id", "part", "turn", "role", "digest", "blank", "truncated", "again", "text")


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    dropped: Column | None = None,
) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Rows for which `dropped` holds only make their conversation appear.

    NULL roles and texts are one space. Rows of a conversation stand in the order of their turns,
    NULL first; rows of one turn by role, then by the md5 of their text, so equal rows are
    neighbours and all but the first are duplicates. Rows with a NULL id are one conversation.
    Roles count by their first letter; any that is not s, u or a is rewritten or deleted. A
    conversation without rows has zeros, no edits and the hash of the empty text. Other columns
    of the input, whatever their names, are left out. An empty table gives an empty one.

    Whether an earlier turn has the same role and text is an aggregate joined back. Then a task
    streams each of its conversations twice, in order: narrow rows, from which the edits are
    found, and rows with texts, which are hashed as they pass. A conversation is hashed by one
    task, as the hash runs through all its texts; memory grows by two bytes per row of it.
    """
    space = F.lit(" ")
    whole = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"),
        (F.lit(False) if dropped is None else F.coalesce(dropped, F.lit(False))).alias("dropped"),
    )
    present = whole.where("NOT dropped").withColumn("digest", F.md5("text"))
    narrow = present.select(
        "conv_id", "turn", "role", "digest",
        (~F.col("text").rlike(f"[^{_BLANKS}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{_BLANKS}]*\z")).alias("truncated"),
    )
    # NULL turns come first, and Spark's minimum of a struct puts them first as well.
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    first = stored(first, "first-turns").withColumnsRenamed({"conv_id": "c", "role": "r", "digest": "d"})
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    judged = narrow.join(first, same).select(
        *narrow.columns, (~F.col("first.turn").eqNullSafe(F.col("turn"))).alias("again")
    )
    nothing = F.lit(None)
    parts = (
        judged.select("*", F.lit(0).alias("part"), nothing.cast("string").alias("text")),
        present.select("conv_id", "turn", "role", "digest", "text", F.lit(1).alias("part"),
                       *(nothing.cast("boolean").alias(c) for c in ("blank", "truncated", "again"))),
        whole.where("dropped").select("conv_id").distinct().select(
            "conv_id", F.lit(2).alias("part"), nothing.cast("long").alias("turn"),
            *(nothing.cast("string").alias(c) for c in ("role", "digest", "text")),
            *(nothing.cast("boolean").alias(c) for c in ("blank", "truncated", "again")),
        ),
    )
    stream = parts[0].unionByName(parts[1]).unionByName(parts[2]).select(*_STREAM)
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = stream.repartition(width, "conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "digest")
    return ordered.mapInArrow(_repair_all, _RESULT)


def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """The rows after damage by a checksum of conversation and turn, and a mark of dropped ones:
    0 drops a row, 1 empties its text, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    spoilt = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("said", "[.!?]", ""))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    damaged = (
        rows.select("conv_id", "turn", text("role").alias("by"), text("text").alias("said"), kind.alias("kind"))
        .withColumn("copy", F.explode(copies))
        .select(
            "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("by")).alias("role"),
            spoilt.otherwise(F.col("said")).alias("text"), (F.col("kind") == 0).alias("dropped"),
        )
    )
    return damaged, F.col("dropped")


def oracle(conversations: str = "conversations") -> str:
    """The same rows in DuckDB's SQL: the cheapest edits forward, row by row, in a recursive query."""
    def edit(state: str, cost: object, letter: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"

    def least(*options: str) -> str:
        return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"

    def where(condition: str, value: str) -> str:
        return f"CASE WHEN {condition} THEN {value} END"

    def step() -> str:
        fits = lambda letter: f"NOT must AND initial = '{letter}'"
        keep = lambda s, letter: where(fits(letter), edit(s, "cut", "K"))
        rewrite = lambda s: where("NOT must", edit(s, f"({REWRITE} + cut)", "R"))
        drop = lambda s: edit(s, DELETE, "D")
        return ",\n    ".join([
            f"{drop('s0')} AS s0",
            f"{least(drop('s1'), keep('s0', 's'))} AS s1",
            f"{least(drop('s2'), *(keep(s, 'u') for s in ('s0', 's1', 's3')), *(rewrite(s) for s in ('s0', 's1', 's3')))} AS s2",
            f"{least(drop('s3'), keep('s2', 'a'), rewrite('s2'))} AS s3",
        ])

    def inserted(source: str) -> str:
        """States after any inserts in the layer."""
        user = least("s2", *(edit(s, INSERT, "I") for s in ("s0", "s1", "s3")))
        return f"""SELECT k, i, s0, s1, s2, {least('s3', edit('s2', INSERT, 'I'))} AS s3
  FROM (SELECT k, i, s0, s1, s3, {user} AS s2 FROM {source})"""

    return rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
        regexp_extract_all(hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))), '..'),
        lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM {conversations}, crc_table),
convs AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM source)),
damaged AS (
  SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM source JOIN convs ON source.conv_id IS NOT DISTINCT FROM convs.conv_id, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)
  WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
judged AS MATERIALIZED (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open_end,
    lag(left(role, 1)) OVER (PARTITION BY k ORDER BY i) || left(role, 1) AS pair
  FROM numbered),
rated AS MATERIALIZED (
  SELECT k, i, turn, role, text, initial, blank, NOT blank AND again AS duplicate, blank OR again AS must,
    NOT blank AND NOT again AND open_end AS truncated, (NOT blank AND NOT again AND open_end)::BIGINT AS cut,
    coalesce(pair NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM judged),
steps AS (
  SELECT k, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
    NULL::STRUCT(c BIGINT, a VARCHAR) AS s2, NULL::STRUCT(c BIGINT, a VARCHAR) AS s3
  FROM convs
  UNION ALL
  SELECT k, i,
    {step()}
  FROM (SELECT b.k, r.i, b.s0, b.s1, b.s2, b.s3, r.must, r.initial, r.cut
    FROM ({inserted('steps')}) b JOIN rated r ON r.k = b.k AND r.i = b.i + 1)),
ended AS (
  SELECT k, {least('s0', 's3')} AS best FROM ({inserted('steps')})
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY i DESC) = 1),
letters AS (
  SELECT k, unnest(string_split(best.a, '')) AS letter, generate_subscripts(string_split(best.a, ''), 1) AS nth
  FROM ended WHERE best.a <> ''),
placed AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY k ORDER BY nth) AS i FROM letters),
left_over AS (
  SELECT p.k, p.nth, p.letter, r.role, r.text, row_number() OVER (PARTITION BY p.k ORDER BY p.nth) AS n,
    max(CASE WHEN p.letter = 'K' AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.k) AS led
  FROM placed p LEFT JOIN rated r ON r.k = p.k AND r.i = p.i AND p.letter <> 'I' WHERE p.letter <> 'D'),
repaired AS (
  SELECT k, string_agg(CASE WHEN letter = 'K' THEN role WHEN (n - led) % 2 = 1 THEN 'user' ELSE 'assistant' END
    || ':' || coalesce(text, ''), chr(10) ORDER BY nth) AS whole
  FROM left_over GROUP BY k),
counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM rated GROUP BY k)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM convs JOIN ended USING (k) LEFT JOIN counts USING (k) LEFT JOIN repaired USING (k)"""
