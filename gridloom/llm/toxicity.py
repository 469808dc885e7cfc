"""Toxicity: a learned lexicon in a trie, intersected with Levenshtein automata, weighed by context windows.

The lexicon comes from labelled documents: words that toxic documents hold far more often than others.
The trie and the automata that accept what lies within a few edits of its words are intersected into one
automaton, made deterministic state by state as words run through it, so a word costs a few steps.  A
misspelling weighs what training documents say of it, and as much as its lexicon word where they are
silent.  The words around a hit tell abuse from quotation, as learned from hits in documents of either
label; hits close together make a window score.  A logistic regression turns these into a probability.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from gridloom.llm.common import held_out, labelled_sample

SAMPLE = 4000
"""At most so many labelled documents train lexicon and weights (those with the smallest id hash)."""
WORD = re.compile(r"[^\W_]+")
WINDOW, NEAR = 20, 6
"""Words of a score window, and words on either side of a hit that tell its use."""
LEAST_CHARS, MOST_CHARS, MOST_STATES = 3, 64, 50_000
"""Words of other lengths are no hits; the automaton starts afresh beyond so many states."""
# Pairs of quotation marks.
OPEN, CLOSE = "\"“«„‘‹", "\"”»“’›"
QUOTED = "\x02quoted"
DECAY, PRIOR, FEATURES, RIDGE = 0.5, 4.0, 5, 1.0
"""What an edit leaves of a weight (by cross-validation on training rows), documents that a prior stands for, features, and what their weights are drawn to zero by."""


def allowed(length: int) -> int:
    """Edits that a lexicon word of this length may be away; a swap of neighbours is one."""
    return 0 if length < 4 else 1 if length < 8 else 2


class Automaton:
    """Accepts the words within :func:`allowed` edits of a lexicon.

    A state is a set of (trie node, edits, awaited): what of a lexicon word has been matched, at what
    cost, and the character that would complete a swap.  Transitions are computed when first taken.
    """

    def __init__(self, words: list[str], most_states: int = MOST_STATES):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[str | None] = [None]
        self.limit = [0]
        self.most_states = most_states
        for word in words:
            at = 0
            for c in word:
                if c not in self.children[at]:
                    self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.limit.append(0)
                at = self.children[at][c]
                self.limit[at] = max(self.limit[at], allowed(len(word)))
            self.ends[at] = word
            self.limit[0] = max(self.limit[0], allowed(len(word)))
        self._reset()

    def _reset(self) -> None:
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[str, int] | None] = []
        self.numbers: dict[tuple, int] = {}
        self._number({})
        self.start = self._number({(0, ""): 0})

    def _number(self, reached: dict[tuple[int, str], int]) -> int:
        """The state of these (node, awaited) -> edits, after lexicon characters that the word lacks."""
        todo = list(reached)
        while todo:
            node, awaited = todo.pop()
            if awaited:
                continue
            edits = reached[node, ""] + 1
            for child in self.children[node].values():
                if edits <= self.limit[child] and edits < reached.get((child, ""), 99):
                    reached[child, ""] = edits
                    todo.append((child, ""))
        state = tuple(sorted(reached.items()))
        if (number := self.numbers.get(state)) is None:
            number = self.numbers[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
            ends = [(e, self.ends[n]) for (n, awaited), e in state if not awaited and self.ends[n] is not None and e <= allowed(len(self.ends[n]))]
            self.found.append((min(ends)[1], min(ends)[0]) if ends else None)
        return number

    def _step(self, state: int, c: str) -> int:
        reached: dict[tuple[int, str], int] = {}

        def reach(node: int, edits: int, awaited: str = "") -> None:
            if edits <= self.limit[node] and edits < reached.get((node, awaited), 99):
                reached[node, awaited] = edits

        for (node, awaited), edits in self.states[state]:
            if awaited:
                if awaited == c:
                    reach(node, edits)
                continue
            reach(node, edits + 1)
            for a, child in self.children[node].items():
                reach(child, edits + (a != c))
                if a != c and c in self.children[child]:
                    reach(self.children[child][c], edits + 1, a)
        self.steps[state][c] = to = self._number(reached)
        return to

    def match(self, word: str) -> tuple[str, int] | None:
        """The lexicon word with the fewest edits (ties: the least), and these, or None."""
        if len(self.states) > self.most_states:
            self._reset()
        state = self.start
        for c in word:
            to = self.steps[state].get(c)
            if to is None:
                to = self._step(state, c)
            if not to:
                return None
            state = to
        return self.found[state]


@dataclass
class Model:
    """Lexicon word -> weight; words that training documents hold -> their own; evidence of quotation by context word."""

    lexicon: dict[str, float] = field(default_factory=dict)
    spellings: dict[str, float] = field(default_factory=dict)
    quotation: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = 0.0


class Matcher:
    """word -> weight (0: no hit), through the automaton."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = Automaton(sorted(model.lexicon))

    def weight(self, word: str) -> float:
        if not LEAST_CHARS <= len(word) <= MOST_CHARS or (hit := self.automaton.match(word)) is None:
            return 0.0
        entry, edits = hit
        return self.model.spellings.get(word, self.model.lexicon[entry] * DECAY**edits)


def quoted(low: str, start: int, end: int) -> bool:
    """An opening mark before and a closing mark after, on the same line and within 60 characters."""
    left = low[max(0, start - 60) : start].rpartition("\n")[2]
    right = low[end : end + 60].partition("\n")[0]
    return any(a in left and b in right and (a != b or left.count(a) % 2) for a, b in zip(OPEN, CLOSE, strict=True))


def hits(text: str | None, matcher: Matcher) -> tuple[list[tuple[int, str, float, set[str]]], int]:
    """(place, word, weight, context) of each hit, and the number of words.  The context holds the words nearby."""
    low = (text or "").lower()
    words = WORD.findall(low)
    weight = {w: x for w in set(words) if (x := matcher.weight(w))}
    if not weight:
        return [], len(words)
    at, spans, out = [k for k, w in enumerate(words) if w in weight], iter(enumerate(WORD.finditer(low))), []
    for k in at:
        m = next(m for n, m in spans if n == k)
        near = {*words[max(0, k - NEAR) : k], *words[k + 1 : k + 1 + NEAR]} - weight.keys()
        out.append((k, words[k], weight[words[k]], near | {QUOTED} if quoted(low, m.start(), m.end()) else near))
    return out, len(words)


def features(text: str | None, matcher: Matcher) -> np.ndarray:
    """Logarithms of the hits' weight: all abuse, its densest window, its share of the text, its distinct words; and quotation."""
    out = np.zeros(FEATURES)
    found, n = hits(text, matcher)
    if not found:
        return out
    evidence = matcher.model.quotation
    abuse = np.array([w * np.exp(-sum(evidence.get(x, 0.0) for x in near)) for _, _, w, near in found])
    at = [k for k, _, _, _ in found]
    upto = np.concatenate([[0.0], np.cumsum(abuse)])
    windows = [upto[bisect_left(at, k + WINDOW)] - upto[j] for j, k in enumerate(at)]
    best: dict[str, float] = {}
    for (_, word, _, _), x in zip(found, abuse, strict=True):
        best[word] = max(best.get(word, 0.0), x)
    total = abuse.sum()
    return np.log1p([total, max(windows), 100 * total / n, sum(best.values()), sum(w for _, _, w, _ in found) - total])


def learn_lexicon(rows: list[tuple[str, int]], least: int = 4, odds: float = 8.0) -> tuple[dict[str, float], dict[str, float]]:
    """Words that toxic documents hold ``odds`` times as often, and all words within reach of them, with weights.

    A weight is the logarithm of how many times as often, shrunk towards that of the nearest lexicon word
    (less DECAY an edit) as if PRIOR documents had said so.
    """
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    n = [0, 0]
    for text, y in rows:
        n[y] += 1
        seen[y].update({w for w in WORD.findall(text.lower()) if LEAST_CHARS <= len(w) <= MOST_CHARS and not w.isdigit()})
    if not n[0] or not n[1]:
        return {}, {}
    ratio = lambda w: (seen[1][w] / n[1]) / ((seen[0][w] + 0.5) / n[0])
    floor = max(least, 0.01 * n[1])
    lexicon = {w: float(np.log(ratio(w))) for w, c in sorted(seen[1].items()) if c >= floor and ratio(w) >= odds}
    automaton, spellings = Automaton(sorted(lexicon)), {}
    for w in sorted(seen[0].keys() | seen[1].keys()):
        if w not in lexicon and (hit := automaton.match(w)):
            prior = lexicon[hit[0]] * DECAY ** hit[1]
            # documents of either label that hold the word, in equal shares
            p, q = seen[1][w] / n[1] * n[0], float(seen[0][w])
            toxic = 1 / (1 + np.exp(-prior))
            spellings[w] = max(0.0, float(np.log((p + PRIOR * toxic) / (q + PRIOR * (1 - toxic)))))
    return lexicon, spellings


def learn_quotation(rows: list[tuple[str, int]], matcher: Matcher, least: int = 5) -> dict[str, float]:
    """Words around hits, and quotation marks, that hits of clean documents have e times as often, with the logarithm.

    The ratio must exceed that by two standard errors, since very many words are tried.
    """
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    n = [0, 0]
    for text, y in rows:
        found, _ = hits(text, matcher)
        if found:
            n[y] += 1
            seen[y].update(set().union(*(near for *_, near in found)))
    if not n[0] or not n[1]:
        return {}
    out = {}
    for w, c in sorted(seen[0].items()):
        p, q = c + 0.5, seen[1][w] + 0.5
        x = float(np.log((p / (n[0] + 1)) / (q / (n[1] + 1))))
        if c >= least and x - 2 * (1 / p + 1 / q) ** 0.5 > 1:
            out[w] = x
    return out


def train(rows: list[tuple[str, int]], rounds: int = 60) -> Model:
    """Lexicon, context evidence and logistic weights.  Without both labels the score is the prior everywhere."""
    ys = np.array([y for _, y in rows], dtype=float)
    if not len(ys) or ys.min() == ys.max():
        return Model(bias=0.0 if not len(ys) else (4.0 if ys[0] else -4.0))
    model = Model(*learn_lexicon(rows))
    matcher = Matcher(model)
    model.quotation = learn_quotation(rows, matcher)
    x = np.stack([features(t, matcher) for t, _ in rows])
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(FEATURES + 1), np.diag([RIDGE] * FEATURES + [0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p) + 1e-6)) @ x + ridge, x.T @ (ys - p) - ridge @ w)
        w = w + step / max(1.0, float(np.abs(step).max()))
    model.weights, model.bias = w[:-1], float(w[-1])
    return model


def score_text(text: str | None, matcher: Matcher) -> float:
    z = float(features(text, matcher) @ matcher.model.weights) + matcher.model.bias
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def scorer(spark: SparkSession, model: Model):
    """Column function text -> probability of label 1."""
    held = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(held.value)
        for batch in texts:
            yield pd.Series([score_text(t, matcher) for t in batch], dtype="float64")

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Null and empty texts have no hits and get the learned bias; very long texts are read whole.  Repeated
    rows are scored each; null ids stay and are not held out; a score at the threshold counts as 1; an
    empty table gives no rows.  Only doc_id and text are read, so further columns cannot clash.
    """
    score = scorer(docs.sparkSession, train(labelled_sample(docs, labels, "toxic", sample)))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
