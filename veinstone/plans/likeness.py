"""Likeness of names by common words and common subsequences, with a bound that spares most pairs the comparison.

The bound is made of Column expressions on profiles of the names, which are made once a name: their distinct words,
lengths and characters. Two texts have no common subsequence longer than either of them, or than the characters they share.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..staging import broadcast_if_small, staged


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence; the rows of the usual table are the bits of one number."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for ch in b:
        hit = row & where.get(ch, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def token_set_ratio(a: str | None, b: str | None) -> float:
    """Likeness (0 to 100) of two texts as sets of words: the best of common words and of each text's words with the rest, by longest common subsequence."""
    x, y = set((a or "").split()), set((b or "").split())
    if not x or not y:
        return 0.0
    both = " ".join(sorted(x & y))
    if both and (x <= y or y <= x):
        return 100.0
    s, t = (" ".join(filter(None, [both, *sorted(z)])) for z in (x - y, y - x))
    best = 200.0 * common_subsequence(s, t) / (len(s) + len(t))
    return max(best, *((200.0 * len(both) / (len(both) + len(z)) for z in (s, t)) if both else (0.0,)))


@F.pandas_udf(DoubleType())
def name_likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([round(token_set_ratio(x, y), 1) for x, y in zip(a, b, strict=True)], dtype=float)


def profile(key: Column) -> Column:
    """What the bound needs of a name key: its words once each, their length, and its characters, each with how many of its kind come before it."""
    words = F.array_distinct(F.filter(F.split(F.coalesce(key, F.lit("")), " "), lambda w: w != ""))
    once = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731  a name for a value, so that it is made once
    numbered = lambda chars: F.transform(chars, lambda ch, i: F.concat(ch, (i - F.array_position(chars, ch)).cast("string")))
    made = lambda w: F.struct(w.alias("words"), F.length(F.array_join(w, " ")).alias("n"), once(F.array_sort(F.split(F.array_join(w, " "), "")), numbered).alias("chars"))
    return once(words, made)


def most_likeness(a: Column, b: Column) -> Column:
    """The most that two names can be alike, by their profiles."""
    both = F.array_intersect(a["words"], b["words"])
    shared = F.length(F.array_join(both, " "))
    common = F.size(F.array_intersect(a["chars"], b["chars"]))
    ratio = F.greatest(200.0 * common / (a["n"] + b["n"]), *[F.when(shared > 0, 200.0 * shared / (shared + z["n"])).otherwise(0.0) for z in (a, b)])
    empty = (F.size(a["words"]) == 0) | (F.size(b["words"]) == 0)
    whole = (F.size(both) == F.size(a["words"])) | (F.size(both) == F.size(b["words"]))
    return F.when(empty, 0.0).when(whole, 100.0).otherwise(ratio)


#: A likeness is rounded to tenths, so the bound may fall short of a threshold by half of that.
HALF_TENTH = 0.05


def likely(pairs: DataFrame, a: str, b: str, least: Column | float, likeness=None) -> DataFrame:
    """``pairs`` of profiles ``a`` and ``b`` of name keys (``a_key`` and ``b_key``) with their ``likeness``, of ``least`` or more; only pairs that can reach it are compared."""
    least = least if isinstance(least, Column) else F.lit(least)
    out = pairs.where(most_likeness(F.col(a), F.col(b)) >= least - HALF_TENTH)
    return out.withColumn("likeness", (likeness or name_likeness)(F.col(f"{a}_key"), F.col(f"{b}_key"))).where(F.col("likeness") >= least)


#: Names of one side of a comparison of two parts of a block, and pairs that are compared at once.
PART, AT_ONCE = 1000, 1 << 17
#: Tasks that groups are dealt to at most.
MOST_TASKS = 2000
#: Characters of a name that fit the bits of one machine word; longer names are compared one by one.
BITS = 64


def _table(rows: list[list[str]], columns: dict[str, int]) -> np.ndarray:
    """Which of ``columns`` each row has, as ones and zeros."""
    out = np.zeros((len(rows), len(columns)), np.float32)
    for i, row in enumerate(rows):
        out[i, [columns[x] for x in row if x in columns]] = 1
    return out


class _Side:
    """The names of one part as arrays: distinct words in order, lengths, characters, and where each word stands."""

    def __init__(self, names: list[str]):
        self.names = names
        self.words = [sorted(set(name.split())) for name in names]
        self.texts = [" ".join(w) for w in self.words]
        self.n = np.array([len(t) for t in self.texts], np.int64)
        self.n_words = np.array([len(w) for w in self.words], np.int64)
        self.chars = [[f"{ch}{i}" for ch in set(t) for i in range(t.count(ch))] for t in self.texts]

    def coded(self, letters: dict[str, int], shared: dict[str, int]) -> None:
        """Per name: the bits of each character, its characters in turn, and of each word its number in ``shared`` and its bits with and without the space before it."""
        most, width = int(self.n_words.max(initial=0)), int(min(self.n.max(initial=0), BITS))
        self.bits = np.zeros((len(self.names), len(letters)), np.uint64)
        self.codes = np.zeros((len(self.names), width), np.int64)
        self.ids = np.full((len(self.names), most), len(shared), np.int64)
        self.spans, self.heads = np.zeros((len(self.names), most), np.uint64), np.zeros((len(self.names), most), np.uint64)
        for i, (text, words) in enumerate(zip(self.texts, self.words, strict=True)):
            if len(text) > BITS:
                continue
            for at, ch in enumerate(text):
                self.bits[i, letters[ch]] |= np.uint64(1 << at)
                self.codes[i, at] = letters[ch]
            at = 0
            for k, w in enumerate(words):
                whole = ((1 << len(w)) - 1) << at
                self.ids[i, k], self.heads[i, k], self.spans[i, k] = shared.get(w, len(shared)), whole, whole | (1 << at - 1 if at else 0)
                at += len(w) + 1

    def rest(self, at: np.ndarray, has: np.ndarray) -> np.ndarray:
        """The bits of the words of names ``at`` that are not shared, with the spaces between them."""
        out, begun = np.zeros(len(at), np.uint64), np.zeros(len(at), bool)
        for k in range(self.ids.shape[1]):
            own = (k < self.n_words[at]) & ~has[np.arange(len(at)), self.ids[at, k]]
            out |= np.where(own, np.where(begun, self.spans[at, k], self.heads[at, k]), np.uint64(0))
            begun |= own
        return out


def _common_subsequences(a: _Side, b: _Side, i: np.ndarray, j: np.ndarray, both: np.ndarray) -> np.ndarray:
    """``common_subsequence`` of the words that names ``i`` and ``j`` do not share, for many pairs at once; ``both``: the shared words."""
    mine, theirs = a.rest(i, both), b.rest(j, both)
    one, row = np.uint64(1), np.full(len(i), ~np.uint64(0))
    for at in range(b.codes.shape[1]):
        hit = row & mine & np.where(theirs >> np.uint64(at) & one, a.bits[i, b.codes[j, at]], np.uint64(0))
        row = (row + hit) | (row - hit)
    return np.bitwise_count(~row & _full(a.n[i])).astype(np.int64)


def _full(n: np.ndarray) -> np.ndarray:
    return np.where(n >= BITS, ~np.uint64(0), (np.uint64(1) << np.minimum(n, BITS - 1).astype(np.uint64)) - np.uint64(1))


def alike(left: list[str], right: list[str], least: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (numbers in ``left`` and ``right``) whose ``token_set_ratio``, rounded to tenths, is ``least`` or more; of one part (``same``) each pair once.

    The bound is a product of matrices for all pairs. Words that both names have begin both texts that are compared, so
    only what they do not share is searched for a common subsequence.
    """
    a = _Side(left)
    b = a if same else _Side(right)
    words = {w: k for k, w in enumerate(sorted({w for x in a.words for w in x} & {w for x in b.words for w in x}))}
    kinds = {c: k for k, c in enumerate(sorted({c for x in a.chars for c in x} & {c for x in b.chars for c in x}))}
    letters = {c: k for k, c in enumerate(sorted({c for side in (a, b) for t in side.texts for c in t}))}
    for side in {id(a): a, id(b): b}.values():
        side.coded(letters, words)
    aw, bw = _table(a.words, words), _table(b.words, words)
    lengths = np.array([len(w) + 1 for w in words], np.float32)
    common, n_both, n_shared = _table(a.chars, kinds) @ _table(b.chars, kinds).T, aw @ bw.T, (aw * lengths) @ bw.T - 1
    total, shorter = a.n[:, None] + b.n[None, :], np.minimum(a.n[:, None], b.n[None, :])
    there = (a.n_words > 0)[:, None] & (b.n_words > 0)[None, :]
    by_words = np.where(n_both > 0, 200.0 * n_shared / np.maximum(n_shared + shorter, 1), 0.0)
    by_words[n_both == np.minimum(a.n_words[:, None], b.n_words[None, :])] = 100.0
    by_words[~there] = 0.0
    bound = np.where(there, np.maximum(by_words, 200.0 * common / np.maximum(total, 1)), 0.0)
    chosen = bound >= least - HALF_TENTH - 1e-6
    if same:
        chosen &= np.triu(np.ones(chosen.shape, bool), 1)
    i, j = np.nonzero(chosen)
    has_a, has_b = np.pad(aw > 0, ((0, 0), (0, 1))), np.pad(bw > 0, ((0, 0), (0, 1)))
    found = []
    for at in range(0, len(i), AT_ONCE):
        x, y = i[at : at + AT_ONCE], j[at : at + AT_ONCE]
        short = (a.n[x] <= BITS) & (b.n[y] <= BITS)
        value = np.zeros(len(x))
        p, q = x[short], y[short]
        begin = np.where(n_both[p, q] > 0, n_shared[p, q] + 1, 0)
        value[short] = np.maximum(by_words[p, q], 200.0 * (begin + _common_subsequences(a, b, p, q, has_a[p] & has_b[q])) / np.maximum(total[p, q], 1))
        value[by_words[x, y] == 100.0] = 100.0
        value[~there[x, y]] = 0.0
        for k in np.nonzero(~short)[0]:
            value[k] = token_set_ratio(left[x[k]], right[y[k]])
        kinds_of, which = np.unique(value, return_inverse=True)
        value = np.array([round(float(v), 1) for v in kinds_of])[which]
        kept = value >= least
        found.append((x[kept], y[kept], value[kept]))
    return tuple(np.concatenate(c) if found else np.zeros(0, t) for c, t in zip(zip(*found) if found else ((), (), ()), (np.int64, np.int64, float), strict=True))


def similar_names(names: DataFrame, name: str, within: list[str], least: float) -> DataFrame:
    """(within..., name, other, likeness): pairs of different names of one block that are alike by ``least`` or more, each pair once; equal names are one.

    A block is dealt into parts of about ``PART`` names, and every two parts meet in a group of their own: no task holds
    a block, and a group holds its names and a bound of each pair.
    """
    n = names.select(*within, F.col(name).alias("name")).where("name IS NOT NULL").dropna(subset=within).distinct()
    n = staged(n, "names")
    parts = staged(n.groupBy(*within).agg(F.ceil(F.count("*") / PART).cast("int").alias("_parts")), "parts")
    groups = parts.agg(F.sum(F.expr("_parts * (_parts + 1L) DIV 2"))).first()[0] or 1
    n = n.join(broadcast_if_small(parts), within).withColumn("_own", F.pmod(F.xxhash64("name"), F.col("_parts")).cast("int")).withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    n = n.select(*within, "name", "_own", F.least("_own", "_with").alias("_i"), F.greatest("_own", "_with").alias("_j"))
    key = [*within, "_i", "_j"]

    def pairs(keys: tuple, rows: pa.Table) -> pa.Table:
        own, names = rows["_own"].to_pylist(), rows["name"].to_pylist()
        left, right = ([x for x, o in zip(names, own, strict=True) if o == k.as_py()] for k in keys[-2:])
        i, j, value = alike(left, right, least, keys[-2] == keys[-1])
        x, y = np.array(left, object)[i], np.array(right, object)[j]
        swap = x > y
        columns = {"name": pa.array(np.where(swap, y, x), pa.string()), "other": pa.array(np.where(swap, x, y), pa.string()), "likeness": pa.array(value, pa.float64())}
        return pa.table({c: pa.repeat(k, len(x)) for c, k in zip(within, keys, strict=False)} | columns)

    # The groups' number says how many tasks they are worth; their rows are too few for adaptive execution to see it.
    fields = [n.schema[c] for c in within] + [StructField("name", StringType()), StructField("other", StringType()), StructField("likeness", DoubleType())]
    return n.repartition(min(groups, MOST_TASKS), *key).groupBy(*key).applyInArrow(pairs, StructType(fields))
