"""Toxicity scores from a learned lexicon, met through Levenshtein automata, and the words around a hit.

The lexicon holds word beginnings ("stems") that mark toxic documents among labelled ones. Its terms form a trie; the
Levenshtein automata of all terms are walked over that trie together, as one automaton whose states are made when
a text first needs them. A word is a hit if it begins with a term, or with one that a few edits turn
into a term: none for terms under five characters, one under nine, else two; swapped neighbours are one edit.
Each hit is worth its term's and edits' log-odds, times a score of its window: words in quotation marks or near
a word of reporting are quoted and count apart. A logistic regression over these sums gives the score.

Lexicon and regression are fitted on at most ``sample`` labelled documents, those of the smallest id hashes; near copies in
it count once, by the least hash of their runs of three words; texts that only share their vocabulary are no copies. All texts are scored whole.

Defined cases: a null or empty text has no hits, which is a score too; a label that is null is none, of several labels of one
id the greatest holds, of several texts the least is learned from; rows without an id are held out; with one
class or no labels the lexicon is empty and every score the smoothed share of toxic labels; repeated rows get equal scores;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import add_struct, release, slices

TOKEN = re.compile(r"[^\W_]+(?:[@$*!'’]+[^\W_]+)*")
MARKS = "\"“”„«»‹›‘’"
REPORTING = frozenset("said says wrote writes quote quoted quotes called term word insult sagte schrieb zitat dit écrit cite dijo escribió cita".split())
WINDOW = 8  # words each way
QUOTED, REPORTED = 0.25, 0.5  # what a hit is worth as abuse in quotation marks, and near a word of reporting
STEM = range(3, 13)
#: The belief, worth two documents, that a word so many edits away is as toxic as its term.
TRUST = (0.95, 0.9, 0.75)
KIND = T.StructType([T.StructField("hits", T.LongType()), T.StructField("quoted", T.LongType()), T.StructField("score", T.DoubleType())])


def edits(term: str) -> int:
    """Edits a term allows, by its length."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Automaton:
    """The terms' trie met by the Levenshtein automata of all terms; its states are made on demand.

    A state is a set of (trie node, edits so far, swapped character or ""); nothing is lost when the states are given up to
    free memory, they are made anew.
    """

    MOST = 200_000  # states held

    def __init__(self, terms: Iterable[str]):
        self.next: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.limit: list[int] = [0]
        for t in sorted(terms):
            at = 0
            for ch in t:
                self.limit[at] = max(self.limit[at], edits(t))
                if ch not in self.next[at]:
                    self.next[at][ch] = len(self.next)
                    self.next.append({})
                    self.term.append(None)
                    self.limit.append(0)
                at = self.next[at][ch]
            self.term[at], self.limit[at] = t, max(self.limit[at], edits(t))
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[frozenset, int] = {}
        self.items: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple | None] = []
        self.start = self._state({(0, 0, "")})

    def _state(self, items: set) -> int:
        """The number of a state, closed under characters of a term that the word leaves out; -1 for none."""
        open_, best = list(items), {}
        while open_:
            node, e, swap = open_.pop()
            if e > self.limit[node] or best.get((node, swap), 99) <= e:
                continue
            best[node, swap] = e
            if not swap:
                open_ += [(n, e + 1, "") for n in self.next[node].values()]
        closed = frozenset((n, e, s) for (n, s), e in best.items())
        if not closed:
            return -1
        if closed not in self.ids:
            self.ids[closed] = len(self.items)
            self.items.append(closed)
            self.steps.append({})
            ends = [(e, -len(self.term[n]), self.term[n]) for n, e, s in closed if not s and self.term[n] and e <= edits(self.term[n])]
            self.found.append(min(ends, default=None))
        return self.ids[closed]

    def _step(self, state: int, ch: str) -> int:
        to = set()
        for node, e, swap in self.items[state]:
            if swap:  # the first of two swapped characters was read; now comes the other
                if ch == swap[0]:
                    to.add((self.next[self.next[node][swap[0]]][swap[1]], e, ""))
                continue
            to.add((node, e + 1, ""))
            for c, n in self.next[node].items():
                to.add((n, e + (c != ch), ""))
                if c != ch and ch in self.next[n]:
                    to.add((node, e + 1, c + ch))
        self.steps[state][ch] = made = self._state(to)
        return made

    def match(self, word: str) -> tuple[str, int] | None:
        """The term that a beginning of ``word`` comes nearest to, and the edits; the longer of two as near."""
        if len(self.items) > self.MOST:
            self._reset()
        state, best = self.start, None
        steps, found = self.steps, self.found
        for ch in word:
            state = steps[state].get(ch, -2) if state >= 0 else -1
            if state == -2:
                break
            if state == -1:
                return best and (best[2], best[0])
            if found[state] and (best is None or found[state] < best):
                best = found[state]
        else:
            return best and (best[2], best[0])
        return self._walk(word)

    def _walk(self, word: str) -> tuple[str, int] | None:
        """As ``match``, making the states that are not there yet."""
        state, best = self.start, None
        for ch in word:
            state = self.steps[state][ch] if ch in self.steps[state] else self._step(state, ch)
            if state == -1:
                break
            if self.found[state] and (best is None or self.found[state] < best):
                best = self.found[state]
        return best and (best[2], best[0])


def window_score(text: str, words: list[tuple[str, int, int]], at: int) -> float:
    """How far the ``at``-th word is said as abuse: 1, or less where its window quotes it.

    Straight marks quote if one of them is open before the word, others if they stand on both sides.
    """
    first, last = max(0, at - WINDOW), min(len(words) - 1, at + WINDOW)
    # A window from the text's first word has the marks before that word.
    before, after = text[words[first][1] if first else 0 : words[at][1]], text[words[at][2] : words[last][2]]
    if any(m in before for m in MARKS) and any(m in after for m in MARKS):
        opened = sum(before.count(m) for m in MARKS)
        if opened % 2 or not before.count('"'):
            return QUOTED
    return REPORTED if any(w in REPORTING for w, _, _ in words[first : last + 1]) else 1.0


def found_in(text: str | None, automaton: Automaton) -> tuple[int, dict[tuple[str, int], list[float]]]:
    """Words of a text, and its hits: for each term and edits, the window scores."""
    low = (text or "").lower()
    tokens = TOKEN.findall(low)
    named = {w: m for w in set(tokens) if (m := automaton.match(w))}
    hits: dict[tuple[str, int], list[float]] = defaultdict(list)
    if named:
        words = [(m[0], m.start(), m.end()) for m in TOKEN.finditer(low)]
        for k, (w, _, _) in enumerate(words):
            if w in named:
                hits[named[w]].append(window_score(low, words, k))
    return len(tokens), hits


@dataclass
class Model:
    """Log-odds of each term and edits, and the regression's bias and weights."""

    terms: list[str] = field(default_factory=list)
    odds: dict[tuple[str, int], float] = field(default_factory=dict)
    bias: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)

    def sums(self, n_words: int, hits: dict[tuple[str, int], list[float]]) -> tuple[float, float, float]:
        """Worth of the hits said as abuse, the same for each thousand words, and worth of the quoted ones."""
        said = sum(self.odds.get(k, 0.0) * s for k, found in hits.items() for s in found if s >= 1.0)
        quoted = sum(self.odds.get(k, 0.0) * s for k, found in hits.items() for s in found if s < 1.0)
        return math.log1p(said), math.log1p(1000.0 * said / max(n_words, 1)), math.log1p(quoted)

    def score(self, n_words: int, hits: dict[tuple[str, int], list[float]]) -> float:
        z = self.bias + sum(w * x for w, x in zip(self.weights, self.sums(n_words, hits)))
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, z))))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row's label is never learned from: crc32 of the id's text, modulo ``folds``, is 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(True))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """``doc_id, toxic, text`` of at most ``sample`` labelled documents that are not held out, stored."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    path = scratch_path(docs.sparkSession, "labelled")
    # An id that occurs twice is one document. The broadcast side has ``sample`` rows of two numbers at most.
    chosen = known.join(docs.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen.write.parquet(path)
    rows = docs.select("doc_id", "text").join(F.broadcast(docs.sparkSession.read.parquet(path)), "doc_id")
    path = scratch_path(docs.sparkSession, "sample")
    rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def beginnings(rows: DataFrame, only: frozenset[str] | None = None) -> DataFrame:
    """``toxic, mark, stem``: the word beginnings of every text, or those in ``only``; ``mark`` is equal for most near copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in (part for whole in batches for part in slices(whole, 256)):
            toxic, marks, stems = [], [], []
            for text, y in zip(batch.column(0), batch.column(1)):
                words = TOKEN.findall((text.as_py() or "").lower())
                own = {w[:k] for w in set(words) for k in STEM if k <= len(w)}
                own = own if only is None else own & only
                toxic.append(y.as_py())
                runs = {" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))}
                marks.append(min(xxhash.xxh64_intdigest(r, 1) >> 1 for r in runs))
                stems.append(sorted(own))
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(marks, pa.int64()), pa.array(stems, pa.list_(pa.string()))], names=["toxic", "mark", "stems"])
        release()

    made = rows.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, "toxic int, mark bigint, stems array<string>")
    return made.select("toxic", "mark", F.explode("stems").alias("stem")).distinct()


def worth(toxic: int, clean: int, all_toxic: int, all_clean: int, belief: float = 0.5) -> float:
    """Log-odds that a document is toxic, by documents with and without; two documents' worth of ``belief``."""
    return math.log((toxic + 2 * belief) / (all_toxic + 2)) - math.log((clean + 2 * (1 - belief)) / (all_clean + 2))


def choose_terms(counts: dict[str, tuple[int, int]], all_toxic: int, all_clean: int, least_odds: float, most: int) -> list[str]:
    """Beginnings that tell toxic documents from others better than every shorter and every longer one does."""

    def gain(stem: str) -> float:
        a, b = counts[stem]
        p, q = a / max(all_toxic, 1), b / max(all_clean, 1)
        return a * math.log(p / ((a + b) / (all_toxic + all_clean))) - (b + 1) * (1 + math.log1p(b)) if a and p > q else -1.0

    good = {s: gain(s) for s, (a, b) in counts.items() if worth(a, b, all_toxic, all_clean) >= least_odds}
    longest: dict[str, float] = {}
    for s, g in good.items():  # the best of all longer beginnings
        for k in range(STEM[0], len(s)):
            longest[s[:k]] = max(longest.get(s[:k], -1.0), g)
    chosen = [s for s, g in good.items() if g > 0 and g > longest.get(s, -1.0) and all(good.get(s[:k], -1.0) <= g for k in range(STEM[0], len(s)))]
    return sorted(sorted(chosen, key=lambda s: (-good[s], s))[:most])


def fit(rows: DataFrame, min_share: float = 0.01, min_docs: int = 3, least_odds: float = 2.0, most_terms: int = 500) -> Model:
    """A model from ``text, toxic`` rows, whose number is bounded; the driver holds its sums, not the texts."""
    sizes = {r["y"]: r["n"] for r in rows.groupBy((F.col("toxic") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    ones, zeros = sizes.get(True, 0), sizes.get(False, 0)
    model = Model(bias=math.log((ones + 0.5) / (zeros + 0.5)))
    if not ones or not zeros:
        return model
    toxic = rows.where("toxic > 0")
    # A beginning of this share of the toxic documents: no more of them than a document has, over the share.
    common = beginnings(toxic).groupBy("stem").agg(F.count("*").alias("n")).where(F.col("n") >= max(min_docs, min_share * ones))
    stems = frozenset(r["stem"] for r in common.collect())
    pairs = beginnings(rows, stems).groupBy("stem").agg(*[F.sum((F.col("toxic") > 0).cast("int") if y else (F.col("toxic") <= 0).cast("int")).alias(c) for c, y in (("a", 1), ("b", 0))])
    counts = {r["stem"]: (r["a"], r["b"]) for r in pairs.collect()}
    model.terms = choose_terms(counts, ones, zeros, least_odds, most_terms)
    found = matched(rows, model.terms).orderBy("doc_id").collect()  # of each sampled row its words and its terms
    seen: Counter = Counter()
    for r in found:
        seen.update((h["term"], h["edits"], r["toxic"] > 0) for h in r["hits"])
    for t in model.terms:
        for e in range(edits(t) + 1):
            model.odds[t, e] = max(0.0, worth(seen[t, e, True], seen[t, e, False], ones, zeros, TRUST[e]))
    x = np.array([[1.0, *model.sums(r["n_words"], {(h["term"], h["edits"]): h["scores"] for h in r["hits"]})] for r in found])
    y = np.array([float(r["toxic"] > 0) for r in found])
    w = logistic(x, y)
    model.bias, model.weights = float(w[0]), tuple(map(float, w[1:]))
    return model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Newton's method; ``ridge`` holds all weights but the bias."""
    w = np.zeros(x.shape[1])
    hold = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + hold, x.T @ (y - p) - hold @ w)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-9:
            break
    return w


def matched(rows: DataFrame, terms: list[str]) -> DataFrame:
    """``doc_id, toxic, n_words, hits`` of the sampled rows."""
    hit = T.StructType([T.StructField("term", T.StringType()), T.StructField("edits", T.IntegerType()), T.StructField("scores", T.ArrayType(T.DoubleType()))])
    kind = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("hits", T.ArrayType(hit))])

    def of(text: str | None, automaton: Automaton) -> tuple:
        n, hits = found_in(text, automaton)
        return n, [{"term": t, "edits": e, "scores": s} for (t, e), s in sorted(hits.items())]

    return add_struct(rows.select("doc_id", "text", "toxic"), "text", "found", kind, of, lambda: Automaton(terms)).select("doc_id", "toxic", "found.*")


def scored(docs: DataFrame, model: Model, into: str) -> DataFrame:
    """``docs`` with a struct column: hits, those of them that are quoted, score."""

    def of(text: str | None, automaton: Automaton) -> tuple:
        n, hits = found_in(text, automaton)
        scores = [s for found in hits.values() for s in found]
        return len(scores), sum(s < 1.0 for s in scores), model.score(n, hits)

    return add_struct(docs, "text", into, KIND, of, lambda: Automaton(model.terms))


def learned(docs: DataFrame, labels: DataFrame, sample: int = 20_000, **options) -> Model:
    """The model of the labelled documents that are not held out."""
    return fit(training_rows(docs, labels, sample), **options)
