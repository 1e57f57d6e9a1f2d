"""Toxicity: Levenshtein automata over a lexicon trie, and the words around each hit.

The lexicon is learned from labelled texts: whole words, and stems that several words share, which occur in toxic texts and
hardly elsewhere. It is held as a trie. A word is run through the product of the trie with the Levenshtein automaton
of every entry; its states are made as words need them and kept, so a known state costs one look-up per character. Misspelled
entries are found that way, with the distance allowed by the entry's length.

A hit alone is not abuse. Around each, a window of words is scored: quotation marks that are open, and words that go
with hits in texts that are not toxic. A logistic regression weighs how sure the terms are, how many there are, how many are
quoted, and the windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.base import batches, hash_sample, hold, mix, stage
from tallyhouse.llm.jaccard import shingle_set
from tallyhouse.llm.tokens import trim

#: Labelled texts that the model is fitted on, at most; a hash sample of all labelled rows that may be learned from.
FIT_DOCS = 20_000
#: Texts in which a term must occur, and its share of toxic texts among those that hold it (in rates per class).
LEAST_TEXTS, LEAST_SHARE = 3, 0.8
STEM_SIZES = (4, 5, 6)
WINDOW = 6
QUOTES = "\"“”„«»"
_EDGES = ".,;:!?|()[]{}<>*%&$#@-_/\\'’‘`…" + QUOTES


def bare(token: str) -> str:
    """A token without punctuation at its ends."""
    return token.strip(_EDGES)


def allowed(entry: str, stem: bool) -> int:
    """Edits within which a word still counts as the entry."""
    if stem:
        return 0 if len(entry) < 6 else 1
    return 0 if len(entry) < 4 else 1 if len(entry) < 8 else 2


class Automaton:
    """Trie of a lexicon (entry to is-stem) intersected with the Levenshtein automata of its entries, made deterministic on demand."""

    def __init__(self, lexicon: dict[str, bool], limit: int = 50_000):
        self.limit = limit
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[tuple[str, bool] | None] = [None]
        self.room = [0]  # edits that some entry below a node allows
        for entry, stem in sorted(lexicon.items()):
            node, room = 0, allowed(entry, stem)
            self.room[0] = max(self.room[0], room)
            for c in entry:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(None)
                    self.room.append(0)
                node = self.children[node][c]
                self.room[node] = max(self.room[node], room)
            self.ends[node] = (entry, stem)
        self._reset()

    def _reset(self):
        self.steps: dict[tuple, dict[str, tuple]] = {}
        self.start = self._close({0: 0}, None)

    def _close(self, nodes: dict[int, int], best: tuple[str, int] | None) -> tuple:
        """State of trie nodes with least edits, after free moves down (a missing letter costs one), and the best stem passed."""
        todo = list(nodes.items())
        while todo:
            node, edits = todo.pop()
            if edits > nodes.get(node, edits):
                continue
            for below in self.children[node].values():
                if edits + 1 <= self.room[below] and edits + 1 < nodes.get(below, 99):
                    nodes[below] = edits + 1
                    todo.append((below, edits + 1))
        for node, edits in nodes.items():
            end = self.ends[node]
            if end and end[1] and edits <= allowed(*end) and (best is None or edits < best[1] or edits == best[1] and end[0] < best[0]):
                best = (end[0], edits)
        return frozenset(nodes.items()), best

    def _step(self, state: tuple, c: str) -> tuple:
        after: dict[int, int] = {}

        def reach(node: int, edits: int):
            if edits <= self.room[node] and edits < after.get(node, 99):
                after[node] = edits

        for node, edits in state[0]:
            reach(node, edits + 1)  # a letter too many
            for letter, below in self.children[node].items():
                reach(below, edits + (letter != c))
        return self._close(after, state[1])

    def match(self, word: str) -> tuple[str, int] | None:
        """The entry closest to the word and its distance, ties by name; None if there is none within reach."""
        if len(self.steps) > self.limit:
            self._reset()
        state = self.start
        for c in word:
            known = self.steps.setdefault(state, {})
            if c not in known:
                known[c] = self._step(state, c)
            state = known[c]
            if not state[0]:
                break
        best = state[1]
        for node, edits in state[0]:
            end = self.ends[node]
            if end and edits <= allowed(*end) and (best is None or (edits, end[0]) < (best[1], best[0])):
                best = (end[0], edits)
        return best


@dataclass
class Model:
    """What scoring needs; bounded by the lexicon, so it travels with the tasks."""

    lexicon: dict[str, bool]
    trust: dict[tuple[str, bool], float] = field(default_factory=dict)
    around: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.array([-4.0, 4.0, 2.0, -1.0, 0.0]))


class Scorer:
    """Finds hits in texts; remembers the words it has seen, up to a limit."""

    def __init__(self, model: Model, limit: int = 400_000):
        self.model, self.limit = model, limit
        self.automaton = Automaton(model.lexicon)
        self.seen: dict[str, tuple[str, int] | None | bool] = {}

    def hits(self, text: str | None) -> tuple[list[str], list[tuple[int, str, int, bool]]]:
        """Lower-case tokens and hits: position, entry, distance, quoted."""
        tokens = (text or "").lower().split()
        seen = self.seen
        trim(seen, self.limit)
        found = list(map(seen.get, tokens))
        if None in found:
            for i, (token, known) in enumerate(zip(tokens, found)):
                if known is None:
                    known = seen.get(token)
                    if known is None:
                        word = bare(token)
                        known = seen[token] = (self.automaton.match(word) if word else None) or False
                    found[i] = known
        places = [i for i, f in enumerate(found) if f]
        if not places:
            return tokens, []
        marks = np.cumsum([sum(map(t.count, QUOTES)) for t in tokens])
        return tokens, [(i, *found[i], self._quoted(tokens, marks, i)) for i in places]

    @staticmethod
    def _quoted(tokens: list[str], marks: np.ndarray, i: int) -> bool:
        before = int(marks[i - 1]) if i else 0
        opens = any(tokens[i].startswith(q) for q in QUOTES)
        return (before % 2 == 1 or opens) and int(marks[-1]) > before

    def features(self, text: str | None) -> np.ndarray:
        """Constant, surest term, terms in sum, share quoted, mean window score."""
        tokens, hits = self.hits(text)
        if not hits:
            return np.array([1.0, 0, 0, 0, 0])
        trust = [self.model.trust.get((entry, distance > 0), 0.5 if distance else 1.0) for _, entry, distance, _ in hits]
        around = []
        for i, *_ in hits:
            near = tokens[max(0, i - WINDOW) : i] + tokens[i + 1 : i + 1 + WINDOW]
            around.append(sum(self.model.around.get(bare(t), 0.0) for t in near))
        return np.array([1.0, max(trust), np.log1p(sum(trust)), np.mean([q for *_, q in hits]), np.clip(np.mean(around), -3, 3)])

    def score(self, text: str | None) -> float:
        z = float(self.features(text) @ self.model.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tally(sample: DataFrame, count) -> Counter:
    """Sum over tasks of the counters that ``count`` gives for (text, toxic) rows; keys are pairs of text and number."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in rows:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total.update(count(text, bool(toxic)))
        keys = list(total)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([total[k] for k in keys], pa.int64())], ["s", "kind", "n"])

    summed = sample.select("text", "toxic").mapInArrow(run, "s string, kind long, n long").groupBy("s", "kind").agg(F.sum("n").alias("n"))
    return Counter({(r["s"], r["kind"]): r["n"] for r in summed.where(F.col("n") >= LEAST_TEXTS).collect()})


def _sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Adds the smallest hash of the text's shingles by two hash functions; near copies share one with high probability."""
    least = [[], []]
    for text in batch.column(0).to_pylist():
        shingles = shingle_set((text or "").encode())
        for side, column in enumerate(least):
            column.append(int((mix(shingles ^ np.uint64(side + 1))).min().view(np.int64)) if len(shingles) else 0)
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.int32()), *[pa.array(c, pa.int64()) for c in least]], ["text", "toxic", "a", "b"])


def _terms(text: str | None) -> set[tuple[str, int]]:
    """Words (kind 0) and stems (kind: their length) of a text."""
    words = {w for w in map(bare, set((text or "").lower().split())) if len(w) > 2}
    return {(w, 0) for w in words} | {(w[:n], n) for w in words for n in STEM_SIZES if len(w) > n}


def learn_lexicon(sample: DataFrame, toxic: int, clean: int) -> dict[str, bool]:
    """Entries and whether they are stems, from texts of both classes."""
    inside = _tally(sample.where("toxic = 1"), lambda text, _: Counter(_terms(text)))
    names = set(inside)
    outside = _tally(sample.where("toxic = 0"), lambda text, _: Counter(_terms(text) & names))

    share = toxic / max(1, toxic + clean)

    def telling(term: tuple[str, int]) -> bool:
        yes, no = inside[term], outside[term]
        rate, other = yes / max(1, toxic), (no + 0.5) / max(1, clean)
        # so lopsided that chance would not make one of so many terms so (log likelihood ratio)
        ratio = yes * np.log(yes / ((yes + no) * share)) + (no * np.log(no / ((yes + no) * (1 - share))) if no and clean else 0)
        return rate / (rate + other) >= LEAST_SHARE and (not clean or ratio >= np.log(10 * len(names)))

    good = {t for t in names if telling(t)}
    widest: dict[tuple[str, int], int] = {}
    for (word, kind), n in inside.items():
        if not kind:
            for size in STEM_SIZES:
                widest[word[:size], size] = max(widest.get((word[:size], size), 0), n)
    lexicon: dict[str, bool] = {}
    for stem, size in sorted((t for t in good if t[1]), key=lambda t: t[1]):
        if not any(stem.startswith(e) or e.startswith(stem) for e in lexicon) and inside[stem, size] > 1.3 * widest.get((stem, size), 0):
            # as long as nearly all of its words go on alike
            longer = [t for t in good if t[1] > size and t[0].startswith(stem) and inside[t] >= 0.98 * inside[stem, size]]
            lexicon[max(longer, key=lambda t: t[1], default=(stem, size))[0]] = True
    for word, kind in good:
        if not kind and not any(stem and word.startswith(e) for e, stem in lexicon.items()):
            lexicon[word] = False
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression (Newton steps); the constant is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) + penalty * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 5 / max(5.0, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic", limit: int = FIT_DOCS) -> Model:
    """Learn a model from labelled documents for which ``may_learn`` (a column of ``labels``' key) holds.

    Labels of one key count as toxic if any is; NULL labels are left out. Of the labelled rows at most ``limit`` are used,
    the documented bound of the fit; they are chosen by hash over all of them. Without toxic labels the lexicon is empty and
    every score is low.
    """
    known = labels.where(may_learn & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max(F.col(label).cast("int")).alias("toxic"))
    picked = F.broadcast(hash_sample(known, ["_k"], limit, seed=5))  # at most ``limit`` pairs of numbers
    sample = docs.select(F.col(key).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(picked, "_k")
    # copies of one text would make its rare words look like toxic terms: of texts with an equal sketch one is kept
    sketched = sample.select("text", "toxic").mapInArrow(batches(_sketch), "text string, toxic int, a long, b long")
    sample = stage(sketched.dropDuplicates(["a", "toxic"]).dropDuplicates(["b", "toxic"]).select("text", "toxic"), "labelled")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    model = Model(learn_lexicon(sample, toxic, clean) if toxic else {})
    if not model.lexicon:
        return model

    def hits(text: str, toxic: bool) -> Counter:
        scorer = _scorer(model)
        tokens, found = scorer.hits(text)
        near = {bare(t) for i, *_ in found for t in tokens[max(0, i - WINDOW) : i] + tokens[i + 1 : i + 1 + WINDOW]}
        made = Counter({(e, 2 * (d > 0) + toxic): 1 for _, e, d, _ in found})
        made.update({(w, 4 + toxic): 1 for w in near})
        return made

    seen = _tally(sample, hits)
    for entry, stem in model.lexicon.items():
        for fuzzy in (False, True):
            yes, no = seen[entry, 2 * fuzzy + 1] / toxic, seen[entry, 2 * fuzzy] / max(1, clean)
            # as if met before in three toxic texts of four (misspelled) or in five of five
            more, less = (3 / toxic, 1 / toxic) if fuzzy else (5 / toxic, 0.0)
            model.trust[entry, fuzzy] = max(0.0, 2 * (yes + more) / (yes + more + no + less) - 1)
    windows = {(t, s): seen[t, 4 + s] for t, kind in seen for s in (0, 1) if kind >= 4}
    total = [max(1, sum(n for (_, s), n in windows.items() if s == side)) for side in (0, 1)]
    if total[0] > 50:  # else hits outside toxic texts are too few to learn windows from
        common = {t for (t, _), n in windows.items() if n >= LEAST_TEXTS}
        model.around = {t: float(np.log((windows.get((t, 1), 0) + 5) / (total[1] + 5) * (total[0] + 5) / (windows.get((t, 0), 0) + 5))) for t in common}

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [_scorer(model).features(t).tolist() for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1).cast(pa.int64())], ["x", "y"])

    # equal rows are summed: what comes to the driver is bounded by ``limit`` either way
    measured = sample.mapInArrow(batches(measure), "x array<double>, y long").collect()
    model.weights = _logistic(np.array([r["x"] for r in measured]), np.array([r["y"] for r in measured], dtype=float))
    return model


_SCORERS: list[tuple[Model, Scorer]] = []


def _scorer(model: Model) -> Scorer:
    """The scorer of a model in this worker process."""
    hold("toxicity", _SCORERS.clear)
    if not _SCORERS or _SCORERS[0][0] is not model and (_SCORERS[0][0].lexicon != model.lexicon or _SCORERS[0][0].trust != model.trust or _SCORERS[0][0].around != model.around or not np.array_equal(_SCORERS[0][0].weights, model.weights)):
        _SCORERS[:] = [(model, Scorer(model))]
    elif _SCORERS[0][0] is not model:
        _SCORERS[:] = [(model, _SCORERS[0][1])]
    return _SCORERS[0][1]


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``score`` and ``predicted`` of each row; the score depends on the text alone.

    NULL and empty texts score as texts without hits. Rows repeat as given and keep their key, NULL too; extra columns are not
    read; an empty table gives no rows. No shuffle.
    """

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _scorer(model)
        scores = np.array([scorer.score(t) for t in batch.column(1).to_pylist()], dtype=float)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["k", "score", "predicted"])

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(batches(convert), f"k {kind}, score double, predicted int").withColumnRenamed("k", key)


def keep(docs: DataFrame, model: Model, text: str = "text", most: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``most``, unchanged."""
    at = docs.columns.index(text)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = _scorer(model)
        return batch.filter(pa.array([scorer.score(t) < most for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(batches(convert), docs.schema)
