"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

The kernel of two words sums, over the three- and four-letter subsequences that both contain,
the decay for every letter skipped in between; so `stu-pid` or `st*upid` stay close to `stupid`. Words of
one letter in a row are read as one word as well. A word's feature vector is its kernel with
the landmarks times the inverse root of theirs. As that is linear in the subsequences, the trained
machine folds into one table with a weight for each subsequence, and scoring is a look-up.

Training (multiple-instance, in one task): the first machine learns words, those that toxic
documents hold far more often against others. The second learns labelled sentences, each by its
worst word under the first: all sentences of clean documents as negative, of every toxic document
the worst one as positive. The document's score is a logistic curve, fitted on other documents of the
sample, of the margins of its three worst sentences and its length.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from itertools import combinations
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_np import LOWER, NOT_SPACE, slices, word_bounds, word_hashes
from .labelled import fitted, held_out
from .work import pick

#: Documents of each class that training sees at most.
EACH = 1500
#: Words that the machine trains on at most: the most frequent witnesses, the most frequent other words, and others at random. Rarer witnesses are not learned.
WITNESSES, OFTEN, RARE = 2000, 4000, 8000
#: Rounds of training on sentences, and different worst words of clean sentences that a round learns at most (the most frequent).
SENTENCE_ROUNDS, SENTENCES = 1, 6000
DECAY, REACH, SYMBOLS, LANDMARKS = 0.6, 6, 40, 400
#: Share of toxic documents that the score's curve supposes.
PRIOR = 0.15
#: Stems of these lengths are counted like words; the words of a strong stem are witnesses.
STEMS = (4, 5, 6, 7, 8)
#: A witness is this many times as frequent among toxic documents.
RATIO = 15
#: Symbols: a-z 1-26, start of the word 27, digits 28, continuation bytes 29-39; others only widen a gap; lead bytes take no room.
CODE = np.zeros(256, np.int64)
CODE[97:123] = np.arange(1, 27)
CODE[48:58] = 28
CODE[128:192] = 29 + np.arange(64) % 11
LEAD = np.zeros(256, bool)
LEAD[192:] = True
ENDS = np.zeros(256, bool)
ENDS[[*b".!?"]] = True
#: Places of the letters after the first, for three and for four letters, by the span they take.
STEPS = [(tuple(x), DECAY ** (x[-1] - len(x))) for n in (2, 3) for x in combinations(range(1, REACH + 1), n)]
GRAMS = SYMBOLS**3 + SYMBOLS**4


def subsequences(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """For words in lower-cased bytes: word, subsequence and decay of every occurrence, pattern by pattern."""
    lengths = ends - starts + 1
    word = np.repeat(np.arange(len(starts)), lengths)
    begin = np.cumsum(lengths) - lengths
    raw = np.zeros(len(word), np.int64)
    rel = np.arange(len(word)) - np.repeat(begin, lengths)
    raw[rel > 0] = data[(rel - 1 + np.repeat(starts, lengths))[rel > 0]]
    code = CODE[raw]
    code[begin] = 27
    keep = ~LEAD[raw]
    word, code = word[keep], code[keep]
    for steps, decay in STEPS:
        n = len(code) - steps[-1]
        if n <= 0:
            continue
        ok = (word[:n] == word[steps[-1] :]) & (code[:n] > 0)
        for x in steps:
            ok &= code[x : x + n] > 0
        ok = np.flatnonzero(ok)
        gram = code[ok]
        for x in steps:
            gram = gram * SYMBOLS + code[ok + x]
        yield word[ok], gram + SYMBOLS**3 * (len(steps) == 3), decay


def margins(data, starts, ends, table: np.ndarray, bias: float) -> np.ndarray:
    total, norm = np.zeros(len(starts)), np.zeros(len(starts))
    for word, gram, decay in subsequences(data, starts, ends):
        total += np.bincount(word, table[gram], len(starts)) * decay
        norm += np.bincount(word, minlength=len(starts)) * decay**2
    return np.where(norm > 0, total / np.sqrt(np.maximum(norm, 1e-12)), 0) + bias


def spelled(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> list[tuple[int, bytes]]:
    """Runs of three or more one-letter words of a row: index of the first word, and the letters as one word."""
    letters = np.concatenate(([0], np.cumsum(CODE[data] > 0)))
    one = (letters[ends] - letters[starts] == 1) & (ends - starts <= 3)
    edge = np.zeros(len(starts) + 1, bool)
    edge[first] = True
    begin = np.flatnonzero(one & (~np.concatenate(([False], one[:-1])) | edge[:-1])) if len(one) else []
    stop = np.flatnonzero(one & (~np.concatenate((one[1:], [False])) | edge[1:])) + 1 if len(one) else []
    return [(int(a), b"".join(data[starts[i] : ends[i]].tobytes() for i in range(a, b))) for a, b in zip(begin, stop, strict=True) if b - a >= 3]


def packed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words]).astype(np.int64) if words else np.zeros(0, np.int64)
    return data, np.concatenate(([0], ends[:-1])).astype(np.int64) if words else ends, ends


@dataclass(frozen=True)
class Model:
    """Weights ``values`` of the subsequences ``columns`` (others weigh 0), the bias, and the score's curve."""

    columns: np.ndarray
    values: np.ndarray
    bias: float
    curve: np.ndarray

    @cached_property
    def table(self) -> np.ndarray:
        table = np.zeros(GRAMS, np.float32)
        table[self.columns] = self.values
        return table

    def sentences(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """For each row the margin of each sentence (its worst word), and its number of words."""
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets, NOT_SPACE)
        if not len(starts):
            return [(np.zeros(0), 0) for _ in offsets[1:]]
        _, one, back = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
        margin = margins(data, starts[one], ends[one], self.table, self.bias)[back]
        for at, word in spelled(data, starts, ends, first):
            margin[at] = max(margin[at], margins(*packed([word]), self.table, self.bias)[0])
        # a sentence ends with a word in .!? or before a line break
        last = ENDS[data[ends - 1]]
        breaks = np.concatenate(([0], np.cumsum(data == 10)))
        last[:-1] |= breaks[starts[1:]] > breaks[ends[:-1]]
        edge = np.zeros(len(starts) + 1, bool)
        edge[first] = True
        new = np.flatnonzero(np.concatenate(([True], last[:-1])) | edge[:-1])
        worst, of = np.maximum.reduceat(margin, new), np.searchsorted(new, first)
        return [(worst[a:b], int(n)) for a, b, n in zip(of[:-1], of[1:], np.diff(first), strict=True)]

    def features(self, found: list[tuple[np.ndarray, int]]) -> np.ndarray:
        out = np.full((len(found), 5), -3.0)
        for i, (m, n) in enumerate(found):
            top = np.sort(m)[::-1][:3]
            out[i, : len(top)] = np.clip(top, -3, 3)
            out[i, 3], out[i, 4] = np.log1p(n), np.log1p(np.count_nonzero(m > 0))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.curve[:-1] + self.curve[-1], -30, 30)))


def machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01, rounds: int = 30) -> np.ndarray:
    """Linear machine with squared hinge by Newton steps on the violating rows; the last column of x is the bias."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        slack = 1 - y * (x @ w)
        own = slack > 0
        xa = x[own] * weight[own, None]
        new = np.linalg.solve(xa.T @ x[own] + ridge * np.eye(len(w)), xa.T @ y[own])
        if np.allclose(new, w, atol=1e-6):
            break
        w = 0.5 * w + 0.5 * new
    return w


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Landmarks:
    """Feature vectors of words: kernels with the landmarks, times the inverse root of the landmarks' own."""

    def __init__(self, marks: list[bytes]):
        found = list(subsequences(*packed(marks)))
        self.columns = np.unique(np.concatenate([g for _, g, _ in found]))
        self.place = np.full(GRAMS, -1, np.int64)
        self.place[self.columns] = np.arange(len(self.columns))
        basis, norm = np.zeros((len(self.columns), len(marks)), np.float32), np.zeros(len(marks))
        for word, gram, decay in found:
            np.add.at(basis, (self.place[gram], word), decay)
            norm += np.bincount(word, minlength=len(marks)) * decay**2
        basis /= np.sqrt(np.maximum(norm, 1e-12))
        values, vectors = np.linalg.eigh((basis.T @ basis).astype(float))
        keep = values > 1e-4
        self.into = (basis @ (vectors[:, keep] / np.sqrt(values[keep]))).astype(np.float32)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """A row a word, with 1 for the bias."""
        x = np.zeros((len(words), self.into.shape[1] + 1))
        x[:, -1] = 1
        for a in range(0, len(words), 2000):
            own = words[a : a + 2000]
            norm = np.zeros(len(own))
            for word, gram, decay in subsequences(*packed(own)):
                norm += np.bincount(word, minlength=len(own)) * decay**2
                at = self.place[gram]
                ok = at >= 0
                row, rows_of = word[ok], self.into[at[ok]] * decay
                if len(row):
                    new = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
                    x[a + row[new], :-1] += np.add.reduceat(rows_of, new, axis=0)
            x[a : a + 2000, :-1] /= np.sqrt(np.maximum(norm, 1e-12))[:, None]
        return x

    def model(self, w: np.ndarray, curve: np.ndarray) -> Model:
        return Model(self.columns, (self.into @ w[:-1]).astype(np.float32), float(w[-1]), curve)


def _sentences(text: str) -> list[list[bytes]]:
    """Distinct words of each sentence."""
    raw = LOWER[np.frombuffer(text.encode(), np.uint8)]
    out = []
    for line in raw.tobytes().split(b"\n"):
        for part in re.split(rb"(?<=[.!?])\s+", line):
            if words := part.split():
                out.append(list(dict.fromkeys(words)))
    return out


def _apart(texts: list[str]) -> list[list[list[bytes]]]:
    """Sentences of the texts, one of each group of copies and near copies: most of its words stand between known
    neighbours (a quarter of these is kept, by hash)."""
    seen: set[int] = set()
    out = []
    for text in texts:
        sentences = _sentences(text)
        words = [w for s in sentences for w in s]
        found = {h for x in zip([b"", *words], words, [*words[1:], b""], strict=False) if (h := crc32(b" ".join(x))) % 4 == 0}
        if not found or len(found - seen) > 0.5 * len(found):
            seen |= found
            out.append(sentences)
    return out


def _words(sentences: list[list[bytes]]) -> set[bytes]:
    return {w.strip(b".,!?;:#$%&*") for s in sentences for w in s} - {b""}


def _first(toxic: list, clean: list, rng) -> tuple[list[bytes], list[bytes]]:
    """Words to begin with: those, or words with those stems, that toxic documents have so often that only chance over
    all words does not explain it, and others. Neither need be there."""
    count = (Counter(), Counter())
    for y, docs in ((1, toxic), (0, clean)):
        for sentences in docs:
            words = _words(sentences)
            stems = {w[:n] + b"*" for w in words for n in STEMS if len(w) > n}
            # of clean documents only the stems that toxic ones have matter
            count[y].update(words | (stems if y else stems & count[1].keys()))
    share = len(toxic) / max(len(clean), 1)
    least = max(3, (np.log(len(count[1]) + 1) + 1) / max(np.log((len(toxic) + len(clean) + 1) / (len(toxic) + 1)), 1e-9))
    strong = {w for w, n in count[1].items() if n >= least and n >= RATIO * share * (count[0][w] + 0.5)}
    known = lambda w: w in strong or any(w[:n] + b"*" in strong for n in STEMS)
    witness = sorted((w for w in count[1] if w[-1:] != b"*" and known(w) and not count[0][w] > count[1][w]), key=lambda w: (-count[1][w], w))[:WITNESSES]
    other = sorted(w for w in count[0] if w[-1:] != b"*" and not known(w))
    often = sorted(other, key=lambda w: (-count[0][w], w))[:OFTEN]
    return witness, list(dict.fromkeys(often + [other[i] for i in rng.permutation(len(other))[:RARE]]))


def _balanced(sign: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights with which both classes count alike."""
    return weight * np.where(sign > 0, 0.5 / max(weight[sign > 0].sum(), 1e-9), 0.5 / max(weight[sign < 0].sum(), 1e-9)) * len(sign)


def train(rows: list[tuple[str, int]], seed: int = 7) -> Model:
    """Fit on (text, toxic) rows. Where no word tells the classes apart, or one class is missing, every score is the
    share of toxic rows (0 without rows)."""
    mean = float(np.mean([y for _, y in rows])) if rows else 0.0
    even = Model(np.zeros(0, np.int64), np.zeros(0, np.float32), -1.0, np.array([0.0] * 5 + [np.log(max(mean, 1e-13) / max(1 - mean, 1e-13))]))
    rng = np.random.default_rng(seed)
    part = rng.random(len(rows)) < 0.6
    toxic, clean = (_apart([t for (t, label), own in zip(rows, part, strict=True) if own and label == y]) for y in (1, 0))
    witness, negative = _first(toxic, clean, rng)
    if not witness or not negative or {y for (_, y), own in zip(rows, part, strict=True) if not own} != {0, 1}:
        return even
    marks = witness[: LANDMARKS // 2] + [negative[i] for i in rng.permutation(len(negative))[: LANDMARKS // 2]]
    features = Landmarks(marks)
    words = witness + negative
    sign = np.array([1.0] * len(witness) + [-1.0] * len(negative))
    first = features(words)
    w = machine(first, sign, _balanced(sign, np.ones(len(words))))
    # then sentences are the rows, each as its worst word under the machine so far: all of clean documents, and of a toxic one its worst
    for _ in range(SENTENCE_ROUNDS):
        model = features.model(w, even.curve)
        every = sorted({x for docs in (toxic, clean) for sentences in docs for s in sentences for x in s})
        margin = dict(zip(every, margins(*packed(every), model.table, model.bias).tolist(), strict=True))
        worst = lambda s, m=margin: max(s, key=lambda x: (m[x], x))
        bad = Counter(max((worst(s) for s in sentences), key=lambda x: (margin[x], x)) for sentences in toxic if sentences)
        bad = Counter({x: n for x, n in bad.items() if margin[x] > -1})
        good = Counter(worst(s) for sentences in clean for s in sentences)
        good = Counter(dict(good.most_common(SENTENCES)))
        more = [*bad, *good]
        signs = np.concatenate((sign, [1.0] * len(bad), [-1.0] * len(good)))
        weight = np.concatenate((np.ones(len(sign)), [float(n) for n in (*bad.values(), *good.values())]))
        w = machine(np.concatenate((first, features(more))), signs, _balanced(signs, np.sqrt(weight)))
    model = features.model(w, even.curve)
    other = [r for r, own in zip(rows, part, strict=True) if not own]
    texts = pa.array([t for t, _ in other], pa.large_string())
    found = [s for _, _, data, offsets in slices(texts) for s in model.sentences(data, offsets)]
    y = np.array([v for _, v in other], float)
    balance = Counter(y.tolist())
    curve = logistic(model.features(found), y, np.array([len(y) * (PRIOR if v else 1 - PRIOR) / balance[v] for v in y.tolist()]))
    return Model(model.columns, model.values, model.bias, curve)


def toxicity(docs: DataFrame, labels: DataFrame, each: int = EACH, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted, n_sentences, worst.

    Learns from at most ``each`` documents a class of ``labels`` (doc_id, toxic) that are not
    held out; only the text enters a score. Null and empty texts are scored as texts without a
    sentence. ``worst`` is the margin of the worst sentence (null without one). Where the labels have
    one class only, or no word tells the classes apart, every score is the share of toxic labels (0
    without labels). Repeated rows score equally; an empty table gives no rows; further columns are
    ignored.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(fitted(docs, labels, "toxic", each, train))

    def run(batches):
        for batch in batches:
            for a, b, data, offsets in slices(batch.column("text"), 1 << 17):
                found = model.value.sentences(data, offsets)
                score = model.value.score(model.value.features(found))
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array([len(m) for m, _ in found], pa.int64()), pa.array([float(m.max()) if len(m) else None for m, _ in found], pa.float64())],
                    ["doc_id", "held_out", "score", "predicted", "n_sentences", "worst"],
                )

    texts = docs.select(*pick(docs, "doc_id", "text")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int, n_sentences long, worst double")


def without_toxic(docs: DataFrame, labels: DataFrame, each: int = EACH, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold (null and empty texts too, as texts
    without a sentence). Repeated rows go or stay alike; an empty table stays empty."""
    model = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels, "toxic", each, train))

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for a, b, data, offsets in slices(batch.column(at), 1 << 17):
                score = model.value.score(model.value.features(model.value.sentences(data, offsets)))
                yield batch.slice(a, b - a).filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)
