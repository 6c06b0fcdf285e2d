"""Toxicity scores by a string-kernel SVM on Nystroem landmarks.

Two words are compared by the subsequence kernel (Lodhi et al., 2002): the subsequences of three characters they share,
each weighted down by the length it spans in either, so that gaps and inserted characters cost something but do not hide
a word.  Landmarks are words of labelled toxic documents that
hardly occur elsewhere, spread out, and the clean words closest to them.  The kernel to the landmarks is whitened by
the landmarks' own kernel matrix (Nystroem), and a linear SVM is trained on sentences of labelled documents, each
standing for its most toxic word.  A text scores as its most toxic sentence; texts without any word near a landmark are
all alike.

The kernel of a word with letters in several gaps is too small to tell it from others, so words that spell a toxic
landmark with single letters in between are read as the landmark.  Runs of single characters are read as one word too.  Words are compared once per process and remembered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import give_back, ship
from .learning import calibrate, dual_coordinate_descent, labelled_sample, probability

#: Weight of one more character spanned; characters of a word compared at a time; labelled documents of label 1 and 0 that the
#: model is fitted on.  Words of those that may become landmarks: signs of label 1, and words of label 0.
DECAY, LONGEST, SAMPLE, SIGNS, OTHERS = 0.75, 24, (2000, 3000), 4000, 60_000
#: Most toxic words that stand for a sentence; the model's clean sentences, most toxic first, of each round.
WORDS, HARD = 2, 3000
#: Kernel value to some landmark from which on a word of the sample takes part in the fit.
CLOSE = 0.3
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SINGLES = re.compile(r"(?:(?<=\s)|^)\S(?:\s\S){2,}(?=\s|$)")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points between a mark of the start and one of the end, padded by zeros, and lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    out = np.zeros((len(words), LONGEST + 2), np.uint32)
    text = "".join(f"\x02{w}\x03" for w in words)
    out[np.arange(LONGEST + 2) < size[:, None]] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return out, size


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The kernel of order three of each pair of rows of two code matrices."""
    x, y = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    same = ((x[:, None] == y[None]) & (x[:, None] > 0)).astype(np.float32) * np.float32(DECAY**2)
    decay, ends = np.float32(DECAY), same  # weights of subsequences that end at both characters
    for _ in range(2):
        before = np.zeros_like(same)  # what ended earlier in both words, with the gaps' weights
        for i in range(1, len(before)):
            before[i] = before[i - 1] * decay + ends[i - 1]
        for j in range(before.shape[1] - 1, 0, -1):
            before[:, j] = before[:, j - 1]
        before[:, 0] = 0
        for j in range(2, before.shape[1]):
            before[:, j] += before[:, j - 1] * decay
        ends = same * before
    return ends.sum(axis=(0, 1))


def _pairs(codes: np.ndarray) -> np.ndarray:
    """256-bit signs of the ordered pairs of characters up to four apart."""
    out = np.zeros((len(codes), 4), np.uint64)
    wide = codes.astype(np.uint64)
    for gap in range(1, min(5, codes.shape[1])):
        x, y = wide[:, :-gap], wide[:, gap:]
        h = (((x * np.uint64(0x9E3779B97F4A7C15)) ^ (y * np.uint64(0xC2B2AE3D27D4EB4F))) * np.uint64(0x165667B19E3779F9)) >> np.uint64(56)
        bit = np.where(y > 0, np.uint64(1) << (h & np.uint64(63)), np.uint64(0))
        for k in range(4):
            out[:, k] |= np.bitwise_or.reduce(np.where(h >> np.uint64(6) == k, bit, np.uint64(0)), axis=1)
    return out


def forms(word: str) -> list[str]:
    """What a word is compared as: itself without punctuation at the ends, and without any inside it; in overlapping parts
    if it is very long."""
    if not word.isalpha():
        word = _EDGE.sub("", word)
        if (bare := _INNER.sub("", word)) != word:
            return forms(bare) + ([word] if 2 < len(word) <= LONGEST else [])
    if len(word) <= LONGEST:
        return [word] if len(word) > 2 else []
    return [word[i : i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


class Landmarks:
    """Kernel values between words and landmarks, 1 for equal words; 0 if a word has under half of a landmark's pairs of
    characters near each other."""

    def __init__(self, words: list[str]):
        self.words = words
        self.codes, _ = _codes(words)
        self.width = max([5, *(len(w) + 2 for w in words)])
        self.codes = self.codes[:, : self.width]
        self.own = np.maximum(subsequence_kernel(self.codes, self.codes), 1e-12)
        self.signs = _pairs(self.codes)
        self.need = np.maximum(2, np.ceil(0.5 * np.bitwise_count(self.signs).sum(axis=1)))
        self.gapped: re.Pattern | None = None

    def gram(self) -> np.ndarray:
        """The landmarks' own kernel matrix, in full."""
        n = len(self.words)
        i, j = np.triu_indices(n)
        out = np.zeros((n, n))
        for k in range(0, len(i), 1024):
            a, b = i[k : k + 1024], j[k : k + 1024]
            out[a, b] = subsequence_kernel(self.codes[a], self.codes[b]) / np.sqrt(self.own[a] * self.own[b])
        return np.maximum(out, out.T)

    def __len__(self) -> int:
        return len(self.words)

    def read_gapped(self, signs: int, clean: Iterable[str]) -> None:
        """From here on a word that is one of the first ``signs`` landmarks with single letters in two or more of its gaps
        is read as that landmark, unless it is one of ``clean``.  The kernel alone is too small there."""
        self.whole = [w for w in self.words[:signs] if len(w) > 3]
        self.known: set[str] = set()
        if self.whole:
            self.rows = self.kernel(self.whole)
            self.gapped = re.compile("|".join("(" + ".?".join(map(re.escape, w)) + ")" for w in self.whole))
            self.known = {w for w in clean if self.without_gaps(w) is not None}

    def without_gaps(self, word: str) -> int | None:
        """The number in ``whole`` of the landmark that the word spells with gaps."""
        found = self.gapped.fullmatch(word) if self.gapped else None
        if found and len(word) - len(self.whole[found.lastindex - 1]) > 1 and word not in self.known:
            return found.lastindex - 1
        return None

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.words)), np.float32)
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for s in range(0, len(order), 4096):
            index = np.array(order[s : s + 4096])
            codes, size = _codes([words[i] for i in index])
            codes = codes[:, : max(3, int(size.max()))]
            signs = _pairs(codes)
            common = sum(np.bitwise_count(signs[:, None, k] & self.signs[None, :, k]).astype(np.int16) for k in range(4))
            x, y = np.nonzero(common >= self.need)
            if not len(x):
                continue
            some = np.unique(x)
            own = np.zeros(len(index), np.float32)
            own[some] = subsequence_kernel(codes[some], codes[some])
            for k in range(0, len(x), 1024):
                i, j = x[k : k + 1024], y[k : k + 1024]
                value = subsequence_kernel(codes[i], self.codes[j]) / np.sqrt(np.maximum(own[i] * self.own[j], 1e-20))
                out[index[i], j] = value
        return out


class Reader:
    """What words add to a margin; the most recent ``limit`` to twice as many are remembered."""

    def __init__(self, landmarks: Landmarks, weight: np.ndarray, bias: float, limit: int = 100_000):
        self.landmarks, self.weight, self.bias, self.limit = landmarks, weight, bias, limit
        self.memo: dict[str, float] = {}
        self.older: dict[str, float] = {}

    def learn(self, words: set[str]) -> None:
        """Make sure that the words' margins are in the memo; the memo before the last turn is looked up first."""
        if len(self.memo) > self.limit:
            self.memo, self.older = {}, self.memo
        new = words.difference(self.memo)
        for w in new & self.older.keys():
            self.memo[w] = self.older[w]
        new = sorted(new.difference(self.memo))
        rows = word_rows(self.landmarks, new)
        self.memo.update(zip(new, np.maximum(rows @ self.weight, 0.0).tolist()))

    def margins(self, texts: list[str]) -> list[float]:
        """The margin of each text: that of its most toxic sentence."""
        held = [words_of(t) for t in texts]
        self.learn(set().union(*held))
        memo, out = self.memo, []
        for text, words in zip(texts, held):
            gains = {w: g for w in set(words) if (g := memo[w])}
            best = 0.0
            if gains:
                spaced = _SINGLES.search(text.lower()) is not None
                for part in _SENTENCE.split(text):
                    found = set(words_of(part) if spaced else part.lower().split())
                    here = sorted((gains[w] for w in found if w in gains), reverse=True)
                    best = max(best, sum(here[:WORDS]))
            out.append(self.bias + best)
        return out


def words_of(text: str) -> list[str]:
    """Lower-cased words between white space, and runs of three or more single characters joined."""
    text = text.lower()
    words = text.split()
    if _SINGLES.search(text):
        words += ["".join(m.group().split()) for m in _SINGLES.finditer(text)]
    return words


def word_rows(landmarks: Landmarks, words: list[str]) -> np.ndarray:
    """Kernel rows of words, each the best of its forms."""
    parts = [forms(w) for w in words]
    flat = [p for f in parts for p in f]
    out = np.zeros((len(words), len(landmarks)), np.float32)
    if flat:
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, parts), np.int64, len(parts)))
        values = landmarks.kernel(flat)
        some = np.flatnonzero(values.any(axis=1))
        np.maximum.at(out, owner[some], values[some])
    for i, w in enumerate(words if landmarks.gapped else ()):
        if (k := landmarks.without_gaps(w if w.isalpha() else _INNER.sub("", w))) is not None:
            out[i] = np.maximum(out[i], landmarks.rows[k])
    return out


class Model:
    def __init__(self, sample: list[tuple[str, int]], landmarks: int = 40, c: float = 50.0):
        self.landmarks, self.weight, self.bias, self.a, self.b = None, None, 0.0, 1.0, -2.0
        self.reader: Reader | None = None
        texts = self._unlike(sample)
        y = np.array([1 if t[1] else -1 for t in texts])
        up, down = int((y > 0).sum()), int((y < 0).sum())
        if up and down:
            held: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in texts:
                held[int(label > 0)].update({f for w in set(text.lower().split()) for f in forms(w)})
            odds = {w: np.log((n + 0.5) / (up + 1)) - np.log((held[0][w] + 0.5) / (down + 1)) for w, n in held[1].items() if n >= max(3, up * 0.004)}
            sure = {w: o - 2 * np.sqrt(1 / (held[1][w] + 0.5) + 1 / (held[0][w] + 0.5)) for w, o in odds.items()}
            cues = sorted((w for w, o in sure.items() if o > 1), key=lambda w: (-held[1][w] * odds[w], w))[:SIGNS]
            known = set(cues)
            chosen = self._covering(cues, [known.intersection(f for w in set(t.lower().split()) for f in forms(w)) for t, label in texts if label], landmarks)
            if chosen:
                self._fit(texts, y, chosen, held, c)

    @staticmethod
    def _unlike(sample: list[tuple[str, int]]) -> list[tuple[str, int]]:
        """The sample without near copies, whose rare words would pass for signs of their label."""
        seen: set[int] = set()
        out = []
        for text, label in sample:
            words = text.lower().split()
            sketch = sorted({xxhash.xxh64_intdigest(" ".join(t)) for t in zip(words, words[1:], words[2:])})[:8]
            if len(sketch) < 8 or sum(h in seen for h in sketch) < 4:
                out.append((text, label))
            if len(sketch) == 8:
                seen.update(sketch)
        return out

    @staticmethod
    def _covering(cues: list[str], docs: list[set[str]], most: int) -> list[str]:
        """Cues in order of the documents that they add.  A document counts a quarter for each landmark so far that one of its
        words is like, so that every family of words gets landmarks, rare ones too."""
        number = {w: i for i, w in enumerate(cues)}
        pairs = [(d, number[w]) for d, words in enumerate(docs) for w in words if w in number]
        at, cue = np.array(pairs, np.int64).reshape(-1, 2).T
        if not cues:
            return []
        codes, _ = _codes(cues)
        signs, own = _pairs(codes), np.concatenate([subsequence_kernel(codes[k : k + 1024], codes[k : k + 1024]) for k in range(0, len(cues), 1024)])
        need = 0.5 * np.bitwise_count(signs).sum(axis=1)
        weight, free, chosen = np.ones(len(docs)), np.ones(len(cues), bool), []
        while len(chosen) < most:
            gain = np.bincount(cue, weight[at], len(cues)) * free
            if gain.max() <= 0.05:
                break
            best = int(np.argmax(gain))
            chosen.append(cues[best])
            like = np.zeros(len(cues), np.float32)
            near = np.flatnonzero(sum(np.bitwise_count(signs[:, k] & signs[best, k]).astype(int) for k in range(4)) >= need[best])
            like[near] = subsequence_kernel(codes[near], codes[[best]].repeat(len(near), 0)) / np.sqrt(own[near] * own[best])
            free &= like < 0.95
            weight[np.unique(at[like[cue] >= 0.5])] *= 0.25
        return chosen

    def _fit(self, texts: list, y: np.ndarray, chosen: list[str], held: tuple[Counter, Counter], c: float) -> None:
        signs = len(chosen)
        clean = sorted((w for w, n in held[0].items() if n >= 2), key=lambda w: (-held[0][w], w))[:OTHERS]
        if clean:  # for each sign the most similar clean word
            near = Landmarks(chosen).kernel(clean)
            best = near.argmax(axis=0)
            chosen = chosen + sorted({clean[i] for k, i in enumerate(best.tolist()) if near[i, k] > 0 and clean[i] not in chosen})
        landmarks = Landmarks(chosen)
        gram = landmarks.gram()
        landmarks.read_gapped(signs, held[0])
        values, vectors = np.linalg.eigh(gram)
        white = vectors * (np.maximum(values, 1e-3) ** -0.5) @ vectors.T
        number, kept = {}, [np.zeros((0, len(landmarks)), np.float32)]  # of words close to a landmark; only these teach
        names = sorted(set().union(*(words_of(text) for text, _ in texts)))
        for k in range(0, len(names), 20_000):
            part = word_rows(landmarks, names[k : k + 20_000])
            near, base = np.flatnonzero(part.max(axis=1) >= CLOSE), len(number)
            number.update((names[k + i], base + j) for j, i in enumerate(near.tolist()))
            kept.append(part[near])
        rows = np.concatenate(kept)
        del names, kept
        if not len(rows):
            return
        cue = rows[:, :signs].max(axis=1)
        sentences = [[sorted(number[w] for w in set(words_of(part)) if w in number) for part in _SENTENCE.split(text)] for text, _ in texts]
        half = np.arange(len(texts)) % 4 != 3
        toxic, clean_parts = [], []
        for ss, label, learn in zip(sentences, y > 0, half):
            if learn and not label:
                clean_parts += [s for s in ss if s]
            elif learn:  # of a toxic document only its clearest sentences are known to be toxic
                best = max((cue[i] for s in ss for i in s), default=0.0)
                toxic += [s for s in ss if s and best and max(cue[s]) >= min(0.8, best)]
        if not toxic:
            return
        z = rows @ white.astype(np.float32)
        score = cue

        def standing(s: list[int]) -> tuple[int, ...]:
            """The words that stand for a sentence: those that add most to its margin, one at least."""
            top = sorted(s, key=lambda i: (-score[i], i))[:WORDS]
            return tuple(sorted(i for k, i in enumerate(top) if not k or score[i] > 0))

        columns = np.arange(z.shape[1] + 1)
        hard: Counter = Counter()
        for _ in range(4):  # words that stand for sentences, and the model, are found in turn
            up = Counter(map(standing, toxic))
            now = Counter(map(standing, clean_parts))
            for t in sorted(now, key=lambda t: (-sum(score[i] for i in t), t))[:HARD]:
                hard[t] = now[t]
            down = Counter({(): 1}) + hard
            weight, times = np.sqrt(np.array([*up.values()], float)), np.sqrt(np.array([*down.values()], float))
            label = np.append(np.ones(len(up)), -np.ones(len(down)))
            cost = c * np.append(weight * 0.3 * times.sum() / weight.sum(), times) * len(label) / (2 * times.sum())
            x = [(columns, np.append(z[list(t)].sum(axis=0), 1.0)) for t in [*up, *down]]
            w = dual_coordinate_descent(x, label, len(columns), cost, epochs=20)
            score = z @ w[:-1]
        self.landmarks, self.weight, self.bias = landmarks, white @ w[:-1], float(w[-1])
        gain = np.maximum(score, 0.0)
        margin = np.array([self.bias + max((sum(sorted(gain[s], reverse=True)[:WORDS]) for s in ss if s), default=0.0) for ss in sentences])
        self.a, self.b = calibrate(margin[~half], y[~half]) if (~half).any() else calibrate(margin, y)
        self.a = max(self.a, 0.0)

    def scores(self, texts: list[str]) -> list[float]:
        if self.landmarks is None:
            return [probability(self.bias, self.a, self.b)] * len(texts)
        if self.reader is None:
            self.reader = Reader(self.landmarks, self.weight, self.bias)  # stays with the process
        return [probability(m, self.a, self.b) for m in self.reader.margins(texts)]


def toxicity_score(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", sample: tuple[int, int] = SAMPLE):
    """A column function: the probability, from 0 to 1, that a text has label 1.

    The model is fitted on at most ``sample`` labelled documents of label 1 and of label 0, chosen by a hash of their
    ids among the rows of ``labels`` for which ``learn`` holds; only texts are read.  Null and empty texts score like a
    text without any word near a landmark.  With no labelled rows, or one label only, all texts score alike.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(Model(labelled_sample(docs, labels, label, learn, {1: sample[0], 0: sample[1]}, id_col, text_col)))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        for texts in parts:
            yield pd.Series([s for i in range(0, len(texts), 200) for s in model.scores([t or "" for t in texts[i : i + 200]])], dtype="float64")
        give_back()

    return lambda text: score(text)


def drop_toxic(docs: DataFrame, labels: DataFrame, learn: Column, threshold: float = 0.3, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all their columns; null and empty texts are judged too.

    Each row is judged by its own text, so repeated rows go or stay together; an empty table gives an empty one."""
    score = toxicity_score(docs, labels, learn, text_col=text_col, **how)
    return docs.withColumn("_rl_score", score(F.col(text_col))).where(F.col("_rl_score") < threshold).drop("_rl_score")
