"""Toxicity of texts: lexicon terms, also misspelled, scored in their context.

The lexicon is learned from labelled documents and held in a trie. A word is looked up
by walking the trie with the word's Levenshtein automaton, so one walk finds every term
within its allowed distance. What surrounds a match (quotation marks, words of its
window) decides how much it counts.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.common import fold, in_batches, python_values, share, small_batches, stored

#: About so many labelled documents of each label are learned from.
SAMPLE_DOCUMENTS = 3000
#: A term is met in so many different surroundings in toxic documents at least, and is so
#: many times (log) likelier there.
LEAST_CONTEXTS, LEAST_LOG_ODDS = 3, 2.5
#: Of the terms let in by their evidence, chance would have made so large a share at most.
CHANCE_SHARE = 0.1
#: A context word is met in so many sampled documents at least.
LEAST_CONTEXT_DOCUMENTS = 5
#: One edit is allowed in terms of five letters, two in terms of ten.
EDITS_BY_LENGTH = ((10, 2), (5, 1), (0, 0))
WINDOW = 5
QUOTES = frozenset("\"'“”„«»‘’‹›")
_EDGES = "".join(QUOTES) + ".,;:!?()[]{}<>*#%&$|/\\-_~`=+"
FEATURES = ("exact", "misspelled", "quoted", "context", "strongest", "density")
WORD_CACHE = 400_000


@dataclass
class _Length:
    """The terms of one length: their trie, and the pieces that few edits leave intact.

    A term is cut into one piece more than it may have edits. If the first piece is
    spared the word begins with it, if the last is spared the word ends with it; if both
    are hit, each by one edit, the middle one stands within one place of where it was.
    """

    edits: int
    piece: int
    trie: dict = field(default_factory=dict)
    first: set[str] = field(default_factory=set)
    middle: set[str] = field(default_factory=set)
    last: set[str] = field(default_factory=set)

    def add(self, term: str) -> None:
        node = self.trie
        for letter in term:
            node = node.setdefault(letter, {})
        node[""] = term
        self.first.add(term[: self.piece])
        self.last.add(term[-self.piece :])
        if self.edits > 1:
            self.middle.add(term[self.piece : 2 * self.piece])

    def possible(self, word: str) -> bool:
        n = self.piece
        return (
            word[:n] in self.first
            or word[-n:] in self.last
            or self.edits > 1
            and any(word[at : at + n] in self.middle for at in range(n - 1, n + 2))
        )


class Lexicon:
    """Terms with weights in tries by length; finds the best term for a word, and its distance."""

    def __init__(self, terms: dict[str, float]) -> None:
        self.terms = terms
        self.lengths: dict[int, _Length] = {}
        for term in terms:
            if edits := self.edits(term):
                own = _Length(edits, len(term) // (edits + 1))
                self.lengths.setdefault(len(term), own).add(term)

    def edits(self, term: str) -> int:
        return next(k for least, k in EDITS_BY_LENGTH if len(term) >= least)

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term within its allowed distance; of equals the weightiest,
        then the first in the alphabet."""
        if word in self.terms:
            return word, 0
        best = None
        for length in range(len(word) - 2, len(word) + 3):
            group = self.lengths.get(length)
            if group and abs(length - len(word)) <= group.edits and group.possible(word):
                for term, spent in self._walk(word, group.trie, group.edits):
                    best = min(best or (spent, math.inf, ""), (spent, -self.terms[term], term))
        return (best[2], best[0]) if best else None

    def _walk(self, word: str, trie: dict, most: int) -> Iterator[tuple[str, int]]:
        """Intersect a trie with the automaton of all strings within `most` edits of the
        word: (term, distance) of every term it accepts.

        The automaton's states are sets of places in the word, one set of bits per
        number of edits spent: bit i is on if the trie's path so far can stand for the
        first i letters. A branch whose sets are all empty is left at once.
        """
        letters: dict[str, int] = {}
        for i, letter in enumerate(word):
            letters[letter] = letters.get(letter, 0) | 1 << i
        end, whole = 1 << len(word), (2 << len(word)) - 1
        # Before any letter of the term: i letters of the word are skipped for i edits.
        stack = [(trie, tuple((2 << d) - 1 & whole for d in range(most + 1)))]
        while stack:
            node, state = stack.pop()
            for letter, below in node.items():
                if not letter:
                    spent = next((d for d, places in enumerate(state) if places & end), None)
                    if spent is not None:
                        yield below, spent
                    continue
                here, moved, live = letters.get(letter, 0), [], 0
                for d, places in enumerate(state):
                    to = (places & here) << 1
                    if d:
                        # One letter for another, one that the word lacks, one that the term lacks.
                        to |= state[d - 1] << 1 | state[d - 1] | moved[d - 1] << 1
                    moved.append(to & whole)
                    live |= to
                if live & whole:
                    stack.append((below, tuple(moved)))


class _WordMatches(dict):
    """Matches of words as they stand in texts, each looked up once; bounded."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, raw: str):
        if len(self) >= WORD_CACHE:
            self.clear()
        word = raw.strip(_EDGES)
        found = self[raw] = self.lexicon.match(word) if word else None
        return found


@dataclass
class Model:
    """Lexicon, weights of context words, and the weights of the features."""

    lexicon: Lexicon
    context: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    bias: float = 0.0

    def __post_init__(self) -> None:
        self.matches = _WordMatches(self.lexicon)

    def features(self, text: str | None) -> np.ndarray:
        """Sums over the text's matches; all zero where nothing matches."""
        x = np.zeros(len(FEATURES))
        words = text.lower().split() if text else []
        found = list(map(self.matches.__getitem__, words))
        if not any(found):
            return x
        inside = _quoted(words)
        for i, match in enumerate(found):
            if match is None:
                continue
            term, distance = match
            weight = self.lexicon.terms[term]
            if inside[i]:
                x[2] += 1
            else:
                x[1 if distance else 0] += 1
                x[4] = max(x[4], weight / (1 + distance))
            near = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
            x[3] += sum(self.context.get(w.strip(_EDGES), 0.0) for w in near) / (2 * WINDOW)
        x[5] = (x[0] + x[1]) / len(words)
        x[:3] = np.log1p(x[:3])
        x[3] = np.clip(x[3], -5, 5)
        return x

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ self.weights + self.bias)
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, z))))


def _quoted(words: list[str]) -> list[bool]:
    """Whether each word stands between a word that opens and one that closes a quotation.
    An opening mark without a closing one quotes nothing."""
    inside, opened = [False] * len(words), None
    for i, word in enumerate(words):
        if opened is None and word[0] in QUOTES:
            opened = i
        if opened is not None and word.rstrip(".,;:!?")[-1:] in QUOTES and (i > opened or len(word) > 1):
            for j in range(opened, i + 1):
                inside[j] = True
            opened = None
    return inside


_WORDS = pa.schema([("word", pa.string()), ("toxic", pa.int32()), ("around", pa.int64())])


def learn_lexicon(drawn: DataFrame, toxic: int, clean: int) -> Lexicon:
    """Terms far commoner in toxic documents, from rows (text, toxic).

    Support counts different surroundings (the words before and after), not documents:
    copies of one document are one piece of evidence. A term needs three of them, however
    large the sample is. It enters if its odds reach the least ones even as if clean
    documents had it once more, or if they reach them as counted and the word's
    likelihood ratio is one that chance seldom gives (see `_least_evidence`).
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for text, label in python_values(batches):
                words = [w.strip(_EDGES) for w in text.lower().split()]
                seen: dict[str, int] = {}
                for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                    if len(word) > 2:
                        seen.setdefault(word, hash_of(before, after))
                for word, around in seen.items():
                    yield word, label, around

        return in_batches(rows(), _WORDS)

    words = drawn.mapInArrow(work, "word string, toxic int, around long")
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 1.5) / (clean + 1.0))
    around = lambda label: F.approx_count_distinct(F.when(F.col("toxic") == label, F.col("around")))
    counted = stored(
        words.groupBy("word")
        .agg(
            F.count_if(F.col("toxic") == 1).alias("t"),
            F.count_if(F.col("toxic") == 0).alias("c"),
            around(1).alias("around"),
            around(0).alias("around_clean"),
        )
        .withColumn("odds", odds),
        "words",
    )
    pairs = counted.groupBy("around", "around_clean").count().toPandas()
    t, c = F.col("around").cast("double"), F.col("around_clean").cast("double")
    enough = _likelier(t, c, toxic, clean) & (_evidence(t, c, toxic, clean, F) >= _least_evidence(pairs, toxic, clean))
    # All of them: the sample bounds how many words there are.
    found = counted.where((F.col("around") >= LEAST_CONTEXTS) & ((F.col("odds") >= LEAST_LOG_ODDS) | enough))
    return Lexicon({r["word"]: float(r["odds"]) for r in found.collect()})


def _likelier(t, c, toxic: int, clean: int):
    return t * (clean + 1.0) >= c * ((toxic + 1.0) * math.exp(LEAST_LOG_ODDS))


def _evidence(t, c, toxic: int, clean: int, lib=np):
    """Log likelihood ratio of t toxic and c clean surroundings against an even spread."""
    part = (toxic + 1.0) / (toxic + clean + 2.0)
    log = lambda x: lib.log(lib.greatest(x, F.lit(1e-9)) if lib is F else np.maximum(x, 1e-9))
    return t * (log(t) - log((t + c) * part)) + c * (log(c) - log((t + c) * (1 - part)))


def _least_evidence(pairs: pd.DataFrame, toxic: int, clean: int) -> float:
    """The least evidence from which on chance would make a CHANCE_SHARE of the words at most.

    Were no word toxic, those met n times would fall to toxic documents by a binomial
    draw; its tail, summed over all words, says how many pass a given evidence. Rare
    words weigh in as many as there are, so the bar follows the vocabulary and not the
    size of the sample. `pairs` holds the number of words by their surroundings.
    """
    part = (toxic + 1.0) / (toxic + clean + 2.0)
    by_n = pairs.groupby(pairs["around"] + pairs["around_clean"])["count"].sum()
    by_n = by_n[by_n.index >= LEAST_CONTEXTS]
    chance, share_of = [], []
    factorials = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, max(by_n.index, default=0) + 1)))))
    for n, many in by_n.items():
        t = np.arange(LEAST_CONTEXTS, n + 1)
        t = t[_likelier(t, n - t, toxic, clean)]
        drawn = factorials[n] - factorials[t] - factorials[n - t] + t * math.log(part) + (n - t) * math.log(1 - part)
        chance.append(_evidence(t, n - t, toxic, clean))
        share_of.append(many * np.exp(drawn))
    met = pairs[(pairs["around"] >= LEAST_CONTEXTS) & _likelier(pairs["around"], pairs["around_clean"], toxic, clean)]
    if not len(met):
        return math.inf
    chance, share_of = np.concatenate(chance), np.concatenate(share_of)
    # A little less, so that sums in another order do not decide.
    bars = _evidence(met["around"].to_numpy(float), met["around_clean"].to_numpy(float), toxic, clean) - 1e-6
    above = lambda values, weights: (np.sort(values), np.append(np.cumsum(weights[np.argsort(values)][::-1])[::-1], 0.0))
    (at, by_chance), (own, words) = above(chance, share_of), above(bars, met["count"].to_numpy(float))
    expected, number = by_chance[np.searchsorted(at, bars)], words[np.searchsorted(own, bars)]
    passing = bars[expected <= CHANCE_SHARE * number]
    return float(passing.min(initial=math.inf))


def hash_of(before: str, after: str) -> int:
    return zlib.crc32(f"{before}\0{after}".encode("utf-8", "replace"))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, sample: int
) -> tuple[DataFrame | None, int, int]:
    """Rows (text, toxic, first) of about `sample` labelled ids of each label, `first` marking
    one half of the ids, and how many ids of each label a half has; no rows without labels
    of both kinds.

    Ids are drawn by a hash and sent to the tasks, which filter the documents by them. An id
    gives one row however often it is repeated: of different texts the one with the least
    hash. So the sample is bounded whatever the tables hold; it is written once and read by
    each step of the training.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(F.col(label)).alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return None, 0, 0
    rate = F.when(F.col("toxic") == 1, sample / counts[1]).otherwise(sample / counts[0])
    # Bounded by twice the sample size.
    ids = known.where(share(F.col("id")) < rate).select("id", F.col("toxic").cast("int"))
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    first = share(F.col("id"), F.lit("half")) < 0.5
    one = rows.join(F.broadcast(ids), "id").groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    drawn = stored(one.select("text", "toxic", first.alias("first")), "sample")
    toxic, clean = (min(sample, counts[k]) // 2 for k in (1, 0))
    return drawn, toxic, clean


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE_DOCUMENTS) -> Model:
    """Learn from documents that have a label of 0 or 1; ids only join the two tables.

    See `labelled_sample` for what is learned from. One half of the sample makes the lexicon,
    the other half the context and feature weights, so that these see terms as new texts
    have them. Without labels of both kinds, or without terms, nothing is learned and every
    score is one half or less.
    """
    small_batches(docs.sparkSession)
    drawn, toxic, clean = labelled_sample(docs, labels, doc_id, text, label, sample)
    model = Model(Lexicon({}), bias=-1.0)
    if drawn is None:
        return model
    model = Model(learn_lexicon(drawn.where("first").select("text", "toxic"), toxic, clean), bias=-1.0)
    if model.lexicon.terms:
        other = drawn.where("NOT first").select("text", "toxic")
        model.context = _context_weights(other, model)
        _fit(model, other)
    return model


def _context_weights(drawn: DataFrame, model: Model) -> dict[str, float]:
    """Log odds of words around matches in toxic against clean documents, of every word that
    the sample has there in LEAST_CONTEXT_DOCUMENTS or more."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for text, label in python_values(batches):
                words = text.lower().split()
                around = set()
                for i, match in enumerate(map(model.matches.__getitem__, words)):
                    if match:
                        around.update(w.strip(_EDGES) for w in words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW])
                for word in around:
                    if word and not model.matches[word]:
                        yield word, label, 0

        return in_batches(rows(), _WORDS)

    counted = (
        drawn.mapInArrow(work, "word string, toxic int, around long")
        .groupBy("word")
        .agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c"))
    )
    totals = counted.agg(F.sum("t"), F.sum("c")).first()
    t, c = (float(x or 0) + 1.0 for x in totals)
    rows = counted.where(F.col("t") + F.col("c") >= LEAST_CONTEXT_DOCUMENTS)
    # Five pseudo-counts pull rare words to zero.
    return {r["word"]: math.log((r["t"] + 5 * t / (t + c)) / (r["c"] + 5 * c / (t + c)) * c / t) for r in rows.collect()}


def _fit(model: Model, drawn: DataFrame) -> None:
    """Ridge logistic regression of the labels on the features, by Newton steps."""
    names = [f"f{i}" for i in range(len(FEATURES))]
    schema = pa.schema([*((n, pa.float64()) for n in names), ("toxic", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_batches(((*model.features(t).tolist(), y) for t, y in python_values(batches)), schema)

    kinds = ", ".join(f"{n} double" for n in names) + ", toxic int"
    data = np.array([tuple(r) for r in drawn.mapInArrow(work, kinds).collect()], float)
    if not len(data):
        return
    x, y = np.hstack([data[:, :-1], np.ones((len(data), 1))]), data[:, -1]
    penalty = np.diag([0.1] * len(FEATURES) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, x.T @ (p - y) + penalty @ w)
        w -= np.clip(step, -2, 2)
    model.weights, model.bias = w[:-1], float(w[-1])


def scored(model: Model, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(text)


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 5) == 0


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from labels that are not
    held out.

    NULL and empty texts have no match and score what such texts do. Repeated rows are
    scored each; NULL ids fold like the empty text and have no label. A document with
    several labels is toxic if one says so. Other columns are left out.
    """
    model = train(docs, labels.where(~held_out(F.col("doc_id"))), doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    found = rows.withColumn("score", scored(model, F.col("text"))).drop("text")
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
