"""String ratios by the longest common subsequence, as Arrow functions; callers see to it that equal pairs come once.

ratio is 200 * LCS / (len a + len b), 100 for two empty strings.  token_sort sorts the words first; token_set compares
the words in common with either side's rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from .scores import cosine, jaccard
from .text import strip_accents, text


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel (Hyyrö, 2004)."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & at.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - s.bit_count()


def ratio(a: str, b: str) -> float:
    n = len(a) + len(b)
    return 100.0 if not n else 200.0 * lcs(a, b) / n


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    common, left, right = sorted(x & y), sorted(x - y), sorted(y - x)
    if common and (not left or not right):
        return 100.0
    head = " ".join(common)
    one, two = (" ".join(filter(None, [head, " ".join(r)])) for r in (left, right))
    scores = [ratio(" ".join(left), " ".join(right)) if not common else ratio(one, two)]
    if common:
        scores += [ratio(head, one), ratio(head, two)]
    return max(scores)


def _partial(a: str, b: str) -> float:
    a, b = sorted((a, b), key=len)
    if not a:
        return 100.0 if not b else 0.0
    return max(ratio(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))


def weighted(a: str, b: str) -> float:
    """The best of ratio and, scaled, of token and partial ratios, by how unlike the lengths are."""
    if not a or not b:
        return 0.0
    much = max(len(a), len(b)) / min(len(a), len(b))
    if much < 1.5:
        return max(ratio(a, b), 0.95 * token_sort(a, b), 0.95 * token_set(a, b))
    scale = 0.9 if much < 8 else 0.6
    parts = _partial(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    return max(ratio(a, b), scale * _partial(a, b), 0.95 * scale * parts)


def _udf(f):
    @F.pandas_udf(DoubleType())
    def scored(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x or "", y or "") for x, y in zip(a, b)], dtype="float64")

    return scored


def scorer(name: str):
    """A column function of two strings: ratio, token_sort, token_set or weighted."""
    return _udf({"ratio": ratio, "token_sort": token_sort, "token_set": token_set, "weighted": weighted}[name])


def agreement(a: Column, b: Column, alone: float = 0.0, neither: float = 0.0) -> Column:
    """Token sort ratio of two name parts, from 0 to 1, accents and letter case aside; ``alone`` if one of them is empty,
    ``neither`` if both are.  A second surname that one name lacks counts 0.5, one that neither has 1."""
    x, y = F.lower(strip_accents(a)), F.lower(strip_accents(b))
    return F.when((x == "") & (y == ""), neither).when((x == "") | (y == ""), alone).otherwise(scorer("token_sort")(x, y) / 100)


def name_score(first_surname: Column, second_surname: Column, given: Column) -> Column:
    """One score of three agreements: a weighted mean, or half of the lesser surname's where a surname is under 0.6."""
    lesser = F.least(first_surname, second_surname)
    return F.when(lesser < 0.6, lesser / 2).otherwise(0.35 * first_surname + 0.35 * second_surname + 0.3 * given)


def strict_name_score(name: Column, other: Column) -> Column:
    """The score of two parsed names, of their surnames and first given names."""
    given = [F.substring_index(n["given_name"], " ", 1) for n in (name, other)]
    second = agreement(name["family_name_2"], other["family_name_2"], 0.5, 1.0)
    return name_score(agreement(name["family_name_1"], other["family_name_1"]), second, agreement(*given))


def pair_features(a: Column, b: Column) -> dict[str, Column]:
    """The features of two records, by the names that scores.pair_probability knows: structs with full_name, category, the sets cities,
    schools, places, phones and emails, and a vector, null where there is none."""
    names = [F.lower(strip_accents(x["full_name"])) for x in (a, b)]
    one = lambda c: F.when(c, 1.0).otherwise(0.0)
    alike = {k: jaccard(a[c], b[c]) for k, c in (("city_match", "cities"), ("edu_overlap", "schools"), ("affil_overlap", "places"))}
    same = one((text(a["category"]) != "") & (a["category"] == b["category"]))
    met = {k: one(F.arrays_overlap(a[c], b[c])) for k, c in (("phone_overlap", "phones"), ("email_overlap", "emails"))}
    near = F.when(a["vector"].isNotNull() & b["vector"].isNotNull(), cosine(a["vector"], b["vector"]))
    return {"name_token_sort": scorer("token_sort")(*names) / 100, "name_token_set": scorer("token_set")(*names) / 100, "specialty_match": same, **alike, **met, "name_embed_cos": near}


class Names:
    """A list of names to look up the most alike in, by the weighted ratio.  Most are ruled out by their lengths and by how many
    characters they have in common with a value, which bound the ratio from above; the result is as if all were compared."""

    def __init__(self, names: list[str]):
        self.names = sorted(set(names))
        self.column = {c: k for k, c in enumerate(sorted(set("".join(self.names))))}
        self.size = np.array([len(n) for n in self.names], np.int64)
        self.count = np.zeros((len(self.names), len(self.column)), np.uint16)
        self.having: dict[str, list[int]] = {}
        for k, n in enumerate(self.names):
            for c in n:
                self.count[k, self.column[c]] += 1
            for w in set(n.split()):
                self.having.setdefault(w, []).append(k)
        self.tidy = np.array([self._tidy(n) for n in self.names], bool)

    @staticmethod
    def _tidy(name: str) -> bool:
        """Whether sorting a name's words only moves its characters."""
        words = name.split()
        return name == " ".join(words) and len(words) == len(set(words))

    def bounds(self, value: str) -> np.ndarray:
        """For each name a number that the weighted ratio is not above."""
        own = np.zeros(len(self.column), np.uint16)
        for c in value:
            if c in self.column:
                own[self.column[c]] += 1
        common = np.minimum(self.count, own).sum(axis=1, dtype=np.int64)
        short, long = np.minimum(self.size, len(value)), np.maximum(self.size, len(value))
        plain = 200.0 * common / (short + long)
        part = np.where(common > 0, 200.0 * common / np.maximum(short + common, 1), 0.0)  # of windows no longer than the shorter one
        shared = np.zeros(len(self.names), bool)
        shared[[k for w in set(value.split()) for k in self.having.get(w, ())]] = True
        close = long < 1.5 * short
        out = np.where(close, np.where(shared, np.maximum(plain, 95.0), plain), np.maximum(plain, np.where(long < 8 * short, 0.9, 0.6) * part))
        return np.where(self.tidy, out, 100.0) if self._tidy(value) else np.full(len(self.names), 100.0)

    def best(self, value: str, least: float) -> str | None:
        """The most alike name, if its ratio is ``least`` or more; of equals the first in order of letters."""
        if not value or not self.names:
            return None
        bound = self.bounds(value)
        best, found = least, None
        for k in np.lexsort((np.arange(len(bound)), -bound)).tolist():
            if bound[k] < best - 1e-9:
                break
            score = weighted(value, self.names[k])
            if score > best or score == best and (found is None or k < found):
                best, found = score, k
        return None if found is None else self.names[found]


def nearest(names: list[str], least: float):
    """A column function: the name of a list that is most alike by the weighted ratio, if that is ``least`` or more; of
    equals the first in order of letters.  Null for a null or empty string.  Equal values of a batch are looked up once."""

    @F.pandas_udf("string")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = Names(names)
        for values in parts:
            best = {v: known.best(v, least) for v in values.dropna().unique()}
            yield values.map(best).astype(object).where(values.notna(), None)

    return found


def nearest_values(df: DataFrame, column: str, names: list[str], least: float, out: str) -> DataFrame:
    """``df`` with the name most alike to a column's value; each distinct value is looked up once, however many rows have it."""
    values = df.select(F.col(column).alias("_rl_v")).where("_rl_v is not null").distinct().withColumn(out, nearest(names, least)("_rl_v"))
    return df.join(values, F.col(column) == F.col("_rl_v"), "left").drop("_rl_v")
