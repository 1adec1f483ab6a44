"""Operator 4: toxicity by a Levenshtein automaton over a lexicon trie, with context windows.

Fitting, on a bounded sample of labelled rows, each weighted by how many rows of its label it stands for: (1) document counts of words and of word beginnings per label give a
lexicon of terms with log-odds weights, whole words and stems; (2) the terms go into a trie, with which a Levenshtein
automaton is intersected; its states are sets of (trie node, edits), made when first met and kept, so a word costs one
dictionary step a character; (3) documents are described by what the automaton finds in them and by how the finds lie
in windows of words, and a logistic model maps that to a score.

Scoring reads every whole text.  Stems must match exactly at a word's start; whole words may differ by one edit from
five letters on and by two from nine on, for less weight.  Within quotation marks a find weighs a fraction, unless the
window around it is dense with finds.

Defined results: null and empty texts have no finds and get the score of a document without any; equal texts get equal
scores; without labelled rows of both kinds the lexicon is empty and every score is 0; labelled rows with a null label
are left out; a doc_id labelled twice counts once for each label; labels, lang, source and doc_id are no inputs; extra
columns are ignored.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, least_hashed, materialize, release, table, unused

#: The bound on the labelled documents of either label that fitting reads.
SAMPLE_EACH = 6_000
#: The chi-square value, one degree of freedom, that a term's association with toxic documents must reach: a chance of 0.001.
SIGNIFICANT = 10.83
STEMS = (3, 4, 5, 6, 7)
WINDOW = 40
QUOTED = 0.4
CACHE_WORDS = 250_000

_WORD = re.compile(r"\w+")
_QUOTE = re.compile(r"[\"“”„«»]")
#: how likely a find with so many edits is meant
_EDITS = (1.0, 0.7, 0.45)


def allowed_edits(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Trie:
    """Terms with weights; nodes are numbers.  stem[n] and word[n] hold the term's number where one ends, else -1."""

    def __init__(self, terms: Iterable[tuple[str, bool, float]]):
        self.next: list[dict[str, int]] = [{}]
        self.stem, self.word, self.deep = [-1], [-1], [0]
        self.terms = list(terms)
        for i, (term, is_stem, _) in enumerate(self.terms):
            node, path = 0, [0]
            for c in term:
                if c not in self.next[node]:
                    self.next[node][c] = len(self.next)
                    self.next.append({})
                    self.stem.append(-1)
                    self.word.append(-1)
                    self.deep.append(0)
                node = self.next[node][c]
                path.append(node)
            (self.stem if is_stem else self.word)[node] = i
            if not is_stem:  # edits any word below the node may have
                for n in path:
                    self.deep[n] = max(self.deep[n], allowed_edits(term))


class Automaton:
    """The Levenshtein automaton of any word intersected with a trie: a deterministic automaton over states that are
    sets of (node, edits so far), built as words are read.  A state is kept as the bytes of its pairs, node * 4 + edits
    in order; past the most states that may be kept it starts anew."""

    def __init__(self, trie: Trie, most_states: int = 150_000):
        self.trie, self.most = trie, most_states
        self._reset()

    def _reset(self) -> None:
        self.number: dict[bytes, int] = {}
        self.states: list[bytes] = []
        self.steps: list[dict[str, int] | None] = []
        self.stems = array("i")
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set) -> int:
        t, least = self.trie, {}
        stack = list(pairs)
        while stack:  # skipping a term's character is an edit that reads nothing
            node, e = stack.pop()
            if least.get(node, 9) <= e:
                continue
            least[node] = e
            stack += [(child, e + 1) for child in t.next[node].values() if e < t.deep[child]]
        key = array("I", sorted(node << 2 | e for node, e in least.items())).tobytes()
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            self.steps.append(None)
            ends = [t.stem[n] for n, e in least.items() if e == 0 and t.stem[n] >= 0]
            self.stems.append(ends[0] if ends else -1)
        return self.number[key]

    def _pairs(self, state: int) -> list[tuple[int, int]]:
        return [(p >> 2, p & 3) for p in array("I", self.states[state])]

    def _step(self, state: int, c: str) -> int:
        t, out = self.trie, set()
        for node, e in self._pairs(state):
            child = t.next[node].get(c)
            if child is not None:
                out.add((child, e))
            if e < t.deep[node]:
                out.add((node, e + 1))  # a character too many
                out.update((child, e + 1) for child in t.next[node].values() if e < t.deep[child])  # another character
        got = self._state(out) if out else -1
        if self.steps[state] is None:
            self.steps[state] = {}
        self.steps[state][c] = got
        return got

    def find(self, word: str) -> tuple[int, int] | None:
        """(term, edits) of the best match, or None."""
        if len(self.states) > self.most:
            self._reset()
        state, best = self.start, None
        for c in word:
            after = self.steps[state]
            after = None if after is None else after.get(c)
            state = self._step(state, c) if after is None else after
            if state < 0:
                return best
            if self.stems[state] >= 0:
                best = (self.stems[state], 0)
        ends = [(e, self.trie.word[n]) for n, e in self._pairs(state) if self.trie.word[n] >= 0]
        ends = [(e, i) for e, i in ends if e <= allowed_edits(self.trie.terms[i][0])]
        if ends:
            e, i = min(ends)
            if best is None or e == 0:
                best = (i, e)
        return best


class Finder:
    """What the lexicon finds in texts, with a bounded cache of words."""

    def __init__(self, terms: list[tuple[str, bool, float]]):
        self.terms = terms
        self.automaton = Automaton(Trie(terms))
        self.known: set[str] = set()
        self.hot: dict[str, tuple[int, int]] = {}

    def finds(self, words: list[str]) -> list[tuple[int, int, int]]:
        """(place, term, edits) in order."""
        fresh = set(words) - self.known
        if len(self.known) + len(fresh) > CACHE_WORDS:
            self.known, self.hot = set(), {}
            fresh = set(words)
        for w in fresh:
            got = self.automaton.find(w)
            if got:
                self.hot[w] = got
        self.known |= fresh
        hot = self.hot
        if hot.keys().isdisjoint(words):
            return []
        return [(i, *hot[w]) for i, w in enumerate(words) if w in hot]

    def features(self, text: str | None) -> list[float]:
        """Finds by weight: sum over different terms and over all, the densest window, and both by the text's length."""
        text = (text or "").lower()
        words = _WORD.findall(text)
        found = self.finds(words) if words else []
        if not found:
            return [0.0] * FEATURES
        quoted = _quoted(text, [p for p, _, _ in found])
        place = np.array([p for p, _, _ in found])
        weight = np.array([self.terms[t][2] * _EDITS[e] for _, t, e in found])
        lo = np.searchsorted(place, place - WINDOW // 2, side="left")
        hi = np.searchsorted(place, place + WINDOW // 2, side="right")
        upto = np.concatenate([[0.0], np.cumsum(weight)])
        near = upto[hi] - upto[lo]
        # a lone find in quotation marks is likely a quotation; many close together aren't
        own = np.where(quoted & (near < 3 * weight), weight * QUOTED, weight)
        upto = np.concatenate([[0.0], np.cumsum(own)])
        near = upto[hi] - upto[lo]
        best: dict[int, float] = {}
        for (_, t, _), w in zip(found, own, strict=True):
            best[t] = max(best.get(t, 0.0), w)
        distinct, total, n = sum(best.values()), own.sum(), max(len(words), 1)
        strong = sum(w for w in own if w >= 3.0)
        return [np.log1p(distinct), np.log1p(total), np.log1p(near.max()), np.log1p(100 * total / n), np.log1p(strong), np.log1p(100 * strong / n), float(own.max()), float(np.log1p(n)) * float(distinct > 0)]


FEATURES = 8


def _quoted(text: str, places: list[int]) -> np.ndarray:
    """Whether each of the words at places (ascending) stands after an odd number of quotation marks on its line."""
    if not _QUOTE.search(text):
        return np.zeros(len(places), dtype=bool)
    starts = np.fromiter((m.start() for m in _WORD.finditer(text)), np.int64)[places]
    marks = np.fromiter((m.start() for m in _QUOTE.finditer(text)), np.int64)
    lines = np.concatenate([[-1], np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") == 10)])
    line = lines[np.searchsorted(lines, starts) - 1]
    return (np.searchsorted(marks, starts) - np.searchsorted(marks, line)) % 2 == 1


def held_out(doc_id) -> object:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> DataFrame:
    """(text, toxic, weight): of either label, at most each labelled rows that aren't held out, chosen by hash of the id;
    weight is how many of the label's rows, all counted, a chosen one stands for."""
    y = labels.filter(~held_out("doc_id") & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    y = y.select(F.col("doc_id").alias("_id"), (F.col("toxic") != 0).cast("int").alias("toxic")).distinct()
    h = F.xxhash64(F.lit(5), "_id")
    n = {r["toxic"]: r["count"] for r in y.groupBy("toxic").count().collect()}
    parts = [least_hashed(y.filter(F.col("toxic") == c), h, each, n.get(c, 0)).withColumn("weight", F.lit(max(n.get(c, 0) / each, 1.0))) for c in (1, 0)]
    picked = parts[0].unionByName(parts[1])
    picked = F.broadcast(materialize(picked, "sample"))  # 2 * each rows at most
    out = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id"))
    # one text an id, however often it occurs: 2 * each rows at most
    return materialize(out.groupBy("_id", "toxic").agg(F.min("text").alias("text"), F.first("weight").alias("weight")).drop("_id"), "training")


def _terms_of(text: str) -> tuple[set, set]:
    found = set(_WORD.findall((text or "").lower()))
    return found, {w[:k] for w in found for k in STEMS if len(w) > k}


def _x_log(x):
    return F.when(x > 0, x * F.log(x)).otherwise(0.0)


def likelihood_ratio(bad, clean, n_bad: float, n_clean: float):
    """G squared of the table of documents with and without a term, toxic and not: chi-square with one degree of freedom
    where the two have nothing to do with each other."""
    n = n_bad + n_clean
    cells = _x_log(bad) + _x_log(clean) + _x_log(n_bad - bad) + _x_log(n_clean - clean)
    return 2 * (cells - _x_log(bad + clean) - _x_log(n - bad - clean) - _x_log(F.lit(n_bad)) - _x_log(F.lit(n_clean)) + _x_log(F.lit(n)))


def learn_lexicon(sample: DataFrame, significant: float = SIGNIFICANT) -> list[tuple[str, bool, float]]:
    """(term, is a stem, log-odds weight) of all that is found in toxic documents far more often than in others, of any
    length, if chance doesn't explain it."""

    def count(frames):
        n: dict[tuple, list] = {}
        for frame in frames:
            for text, y in zip(frame["text"], frame["toxic"], strict=True):
                words, stems = _terms_of(text)
                for is_stem, terms in ((False, words), (True, stems)):
                    for t in terms:
                        n.setdefault((t, is_stem), [0, 0])[y] += 1
        keys = list(n)
        yield pd.DataFrame({"term": pd.Series([k[0] for k in keys], dtype=object), "stem": [k[1] for k in keys], "clean": [n[k][0] for k in keys], "bad": [n[k][1] for k in keys]})

    got = sample.groupBy("toxic").agg(F.count("*").alias("n"), F.max("weight").alias("weight")).collect()
    sizes, stands = {r["toxic"]: r["n"] for r in got}, {r["toxic"]: r["weight"] for r in got}
    if len(sizes) < 2:
        return []
    bad, clean = F.col("bad").cast("double"), F.col("clean").cast("double")
    odds = F.log((bad + 0.25) / (sizes[1] + 0.5)) - F.log((clean + 0.25) / (sizes[0] + 0.5))
    got = (
        sample.mapInPandas(count, "term string, stem boolean, clean long, bad long")
        .groupBy("term", "stem")
        .agg(F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
        .withColumn("w", odds)
        .filter((F.col("w") > 1.2) & (likelihood_ratio(bad, clean, float(sizes[1]), float(sizes[0])) >= significant))
        .collect()  # words of the bounded sample that tell its labels apart
    )
    chosen: dict[str, float] = {}
    out = []
    for r in sorted((r for r in got if r["stem"]), key=lambda r: (len(r["term"]), r["term"])):
        shorter = [chosen[r["term"][:k]] for k in STEMS if k < len(r["term"]) and r["term"][:k] in chosen]
        if not shorter or r["w"] > max(shorter) + 1.0:  # a longer stem only where it tells clearly more
            chosen[r["term"]] = r["w"]
            out.append((r["term"], True, float(r["w"])))
    out += [(r["term"], False, float(r["w"])) for r in got if not r["stem"] and r["w"] > 3.0 and stands[0] * r["clean"] <= 0.02 * stands[1] * r["bad"] + 1]
    return sorted(out, key=lambda t: (-t[2], t[0], t[1]))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (bias last), means and scales, by Newton's method with a ridge; a row counts as weight rows."""
    n = np.ones(len(x)) if weight is None else weight
    mean = np.average(x, axis=0, weights=n)
    scale = np.maximum(np.sqrt(np.average((x - mean) ** 2, axis=0, weights=n)), 1e-9)
    a = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.diag([1.0] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (n * p * (1 - p))[:, None]).T @ a + penalty, a.T @ (n * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


class Model:
    def __init__(self, terms, weights):
        self.terms, self.weights = terms, weights
        self._finder = None

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "_finder": None}

    def forget(self) -> None:
        """Ends a partition: idle workers hold no words."""
        if self._finder is not None:
            self._finder.known, self._finder.hot = set(), {}

    def scores(self, texts: Iterable[str | None]) -> np.ndarray:
        if self._finder is None:
            self._finder = Finder(self.terms)
        x = np.array([self._finder.features(t) for t in texts], dtype=float).reshape(-1, FEATURES)
        if self.weights is None:
            return np.zeros(len(x))
        w, mean, scale = self.weights
        return 1 / (1 + np.exp(-np.clip(((x - mean) / scale) @ w[:-1] + w[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH) -> Model:
    sample = training_sample(docs, labels, each)
    terms = learn_lexicon(sample)
    if not terms:
        return Model([], None)

    def describe(frames):
        finder = Finder(terms)
        for frame in frames:
            yield pd.DataFrame({"x": [finder.features(t) for t in frame["text"]], "toxic": frame["toxic"], "weight": frame["weight"]})

    got = sample.mapInPandas(describe, "x array<double>, toxic int, weight double").toPandas()  # at most 2 * each short rows
    return Model(terms, fit_logistic(np.stack(got["x"].to_numpy()), got["toxic"].to_numpy(float), weight=got["weight"].to_numpy(float)))


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """docs with one more column, in 0..1, named so (with underscores before it where docs has that name)."""
    (column,) = unused(docs.columns, column)
    bound_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # terms of the bounded sample

    @F.pandas_udf("double")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        mine = held.value
        for batch in texts:
            yield pd.Series(mine.scores(batch))
        mine.forget()
        release()

    return docs.withColumn(column, run("text"))


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs.select("doc_id", "text"), fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"),
    )
