"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give scores and offsets.

Labelled documents say that a text is toxic, not where. A token of a toxic training document is labelled toxic when
its word, or how it begins, is far more frequent in toxic documents than in others; all other tokens are clean. On
these labelled tokens the field is trained by gradient ascent with exact expectations from forward-backward passes.
Word, beginning and ending of a token, and of its neighbours, are its features. A document's score is a logistic
function of the sum and the maximum of its tokens' marginals and of its length, fitted to document labels.

Results for odd input: a text without tokens gets the score that the fit gives to no toxic token at all; a null id
belongs to the training part but has no label; equal rows get equal scores; labels of unknown documents and null
labels are not used, of several labels for a document the highest counts; with no usable labels every score is the
constant of an untrained fit; extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, staged
from .shingles import sliced

#: The field is fitted to at most so many labelled documents of each label, those with the lowest hash of their id.
TRAIN_DOCS = 2_000
BUCKETS = 1 << 18
TOKEN = re.compile(r"[^\W\d_]+")
NONE = np.zeros(0)


def tokens_of(text: str) -> list[str]:
    """Tokens in small letters, as many as in the text itself: a token whose small letters are longer, or hold other characters, is still one."""
    low = text.lower()
    return TOKEN.findall(low) if len(low) == len(text) else [t.lower() for t in TOKEN.findall(text)]


def features_of(token: str) -> tuple[int, ...]:
    """Hashed features of a token in small letters: itself, its beginnings and its ending (in UTF-8 bytes)."""
    b = token.encode("utf-8", "surrogatepass")
    keys = [zlib.crc32(b), zlib.crc32(b[-3:], 1)]
    keys += [zlib.crc32(b[:n], n) for n in range(3, min(8, len(b)))]
    return tuple(k % BUCKETS for k in keys)


class Features(dict):
    LIMIT = 200_000

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[token] = features_of(token)
        return value


class Field:
    """Two states, clean and toxic. ``weights``: of each feature for toxic; ``near``: the same for the neighbours' features; ``turn``: of a change of state, ``base``: of toxic."""

    def __init__(self) -> None:
        self.weights, self.near = np.zeros(BUCKETS), np.zeros(BUCKETS)
        self.base, self.turn = -4.0, np.zeros((2, 2))
        self.fit = np.array([-3.0, 1.0, 2.0, 0.0])


class Emissions:
    """Log potentials of toxic against clean, with the tokens' sums remembered."""

    LIMIT = 400_000

    def __init__(self, field: Field) -> None:
        self.base, self.weights, self.near = field.base, field.weights.tolist(), field.near.tolist()
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.sums = np.empty((self.LIMIT, 2))

    def of(self, tokens: list[str]) -> np.ndarray:
        known = self.known
        new = [t for t in set(tokens) if t not in known]
        if len(known) + len(new) > self.LIMIT:
            self._forget()
            known, new = self.known, list(set(tokens))
            if len(new) > self.LIMIT:  # more different tokens in a text than are remembered
                self.sums = np.empty((len(new), 2))
        for t in new:
            f = features_of(t)
            k = len(known)
            self.sums[k] = sum([self.weights[i] for i in f]), sum([self.near[i] for i in f])
            known[t] = k
        pair = self.sums[np.fromiter(map(known.__getitem__, tokens), np.int64, len(tokens))]
        out = pair[:, 0] + self.base
        out[1:] += pair[:-1, 1]
        out[:-1] += pair[1:, 1]
        return out


def marginals(emissions: list[np.ndarray], turn: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Probability of toxic for every token of every sequence, and the expected counts of transitions, by forward-backward passes over all sequences at once."""
    order = np.argsort([-len(e) for e in emissions], kind="stable")
    sizes = np.array([len(emissions[k]) for k in order])
    out: list[np.ndarray] = [NONE] * len(emissions)
    counts = np.zeros((2, 2))
    t00, t01, t10, t11 = np.exp(np.clip(turn, -8, 8)).ravel()
    at = 0
    while at < len(order) and sizes[at]:
        # Sequences of similar lengths are laid side by side; the longest comes first in each group.
        stop = at + 1
        while stop < len(order) and stop - at < 512 and sizes[stop] * 2 > sizes[at] and sizes[stop]:
            stop += 1
        n, width = sizes[at], stop - at
        e = np.full((n, width), -30.0)
        for j in range(width):
            e[: sizes[at + j], j] = emissions[order[at + j]]
        odds = np.exp(np.clip(e, -30, 30))
        # Ratios of toxic to clean in the forward and the backward messages.
        forward, backward = np.empty_like(odds), np.empty_like(odds)
        forward[0] = r = odds[0]
        for t in range(1, n):
            r = odds[t] * (t01 + r * t11) / (t00 + r * t10)
            forward[t] = r
        live = np.arange(n)[:, None] < sizes[at:stop]
        backward[n - 1] = b = np.ones(width)
        for t in range(n - 2, -1, -1):
            w = odds[t + 1] * b
            b = np.where(live[t + 1], (t10 + t11 * w) / (t00 + t01 * w), 1.0)
            backward[t] = b
        ratio = forward * backward
        p = ratio / (1 + ratio)
        if n > 1:
            # P(y_t, y_t+1) is proportional to message, transition and potential; clean's are 1 in ratio form.
            f, w = forward[:-1], odds[1:] * backward[1:]
            joint = np.stack([np.full_like(f, t00), t01 * w, f * t10, f * t11 * w])
            counts += ((joint / joint.sum(0)) * live[1:]).sum((1, 2)).reshape(2, 2)
        for j in range(width):
            out[order[at + j]] = p[: sizes[at + j], j]
        at = stop
    return out, counts


def token_labels(docs: list[tuple[list[str], int]], features: Features) -> list[np.ndarray]:
    """Toxic tokens of toxic documents: a feature of theirs is in at least 3 of them and many times as frequent there as in clean documents."""
    seen = {0: Counter(), 1: Counter()}
    total = Counter(y for _, y in docs)
    for tokens, y in docs:
        seen[y].update({f for t in set(tokens) for f in features[t]})
    strong = {f for f, n in seen[1].items() if n >= 3 and (n / total[1]) / ((seen[0][f] + 0.5) / (total[0] + 1)) >= 12}
    return [np.array([float(y and not strong.isdisjoint(features[t])) for t in tokens]) for tokens, y in docs]


def train(docs: list[tuple[str, int]], rounds: int = 30, rate: float = 0.3) -> Field:
    """Fit the field to labelled documents, on windows of tokens around toxic ones and as many others."""
    field, features = Field(), Features()
    if len({y for _, y in docs}) < 2:
        return field
    texts = [(tokens_of(text), y) for text, y in docs]
    labels = token_labels(texts, features)
    rng = np.random.default_rng(10)
    windows = []
    for (tokens, _), y in zip(texts, labels, strict=True):
        if not tokens:
            continue
        starts = {max(0, int(k) - 6) // 12 * 12 for k in np.flatnonzero(y)} | {int(rng.integers(0, len(tokens))) // 12 * 12 for _ in range(3)}
        windows += [(tokens[s : s + 20], y[s : s + 20]) for s in sorted(starts)]
    # Feature lists as flat arrays: token k of all windows has the features at[k]..at[k + 1].
    flat = [f for tokens, _ in windows for t in tokens for f in features[t]]
    size = np.array([len(features[t]) for tokens, _ in windows for t in tokens])
    owner = np.repeat(np.arange(len(size)), size)
    flat, truth = np.array(flat), np.concatenate([y for _, y in windows])
    lens = np.array([len(t) for t, _ in windows])
    ends = np.cumsum(lens)
    inner = np.ones(len(size), bool)
    inner[ends - 1] = False  # tokens with a right neighbour in their window
    left = np.flatnonzero(inner)
    given = np.zeros((2, 2))
    np.add.at(given, (truth[left].astype(int), truth[left + 1].astype(int)), 1)
    scale = [np.full(BUCKETS, 1e-8), np.full(BUCKETS, 1e-8), np.full((2, 2), 1e-8), 1e-8]
    for _ in range(rounds):
        own = np.bincount(owner, field.weights[flat], len(size))
        near = np.bincount(owner, field.near[flat], len(size))
        e = own + field.base
        e[left + 1] += near[left]
        e[left] += near[left + 1]
        p, expected = marginals(np.split(e, ends[:-1]), field.turn)
        gap = truth - np.concatenate(p)
        beside = np.zeros(len(size))
        beside[left] += gap[left + 1]
        beside[left + 1] += gap[left]
        grads = [np.bincount(flat, gap[owner], BUCKETS) - 0.01 * field.weights, np.bincount(flat, beside[owner], BUCKETS) - 0.2 * field.near, given - expected - 0.1 * field.turn, gap.sum()]
        for k, g in enumerate(grads):  # steps shrink with the gradients seen so far
            scale[k] = scale[k] + g * g
        field.weights += rate * grads[0] / np.sqrt(scale[0])
        field.near += rate * grads[1] / np.sqrt(scale[1])
        field.turn += rate * grads[2] / np.sqrt(scale[2])
        field.base += rate * grads[3] / np.sqrt(scale[3])
    emissions = Emissions(field)
    p, _ = marginals([emissions.of(t) for t, _ in texts], field.turn)
    x = np.array([summary(q) for q in p])
    y = np.array([float(y) for _, y in texts])
    for _ in range(50):  # Newton steps of a logistic fit with a small ridge
        z = 1 / (1 + np.exp(-np.clip(x @ field.fit, -30, 30)))
        hessian = x.T @ (x * (z * (1 - z))[:, None]) + 1e-2 * np.eye(4)
        field.fit = field.fit + np.linalg.solve(hessian, x.T @ (y - z) - 1e-2 * field.fit)
    return field


def summary(p: np.ndarray) -> tuple[float, float, float, float]:
    total = float(p.sum())
    return 1.0, float(np.log1p(total)), float(p.max(initial=0.0)), float(np.log1p(total / np.sqrt(len(p) + 1.0)))


def _scorer(field: Field, with_spans: bool, least: float = 0.5):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = Emissions(field)
        for batch in sliced(batches, 2048):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            scores, spans = [], []
            for at in range(0, len(texts), 1024):
                some = texts[at : at + 1024]
                found = [tokens_of(t) for t in some]
                p, _ = marginals([emissions.of(t) for t in found], field.turn)
                x = np.array([summary(q) for q in p]).reshape(-1, 4)
                scores.append(1 / (1 + np.exp(-np.clip(x @ field.fit, -30, 30))))
                if with_spans:
                    for text, q in zip(some, p, strict=True):
                        hit = set(np.flatnonzero(q >= least).tolist())
                        spans.append([{"start": m.start(), "end": m.end(), "p": float(q[k])} for k, m in enumerate(TOKEN.finditer(text)) if k in hit] if hit else [])
            cols = [batch.column("id"), pa.array(np.concatenate(scores) if scores else NONE)]
            if with_spans:
                cols.append(pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "score", "spans"][: len(cols)])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_docs: int = TRAIN_DOCS, with_spans: bool = True) -> DataFrame:
    """(id, score, spans) for every row of ``docs``; ``labels`` must hold training rows only.

    spans: offsets in the text, with marginals, of tokens that are toxic with probability 0.5 or more.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    order = F.xxhash64("id", F.lit(10))
    pick = known.where("y = 1").orderBy(order, "id").limit(train_docs).union(known.where("y = 0").orderBy(order, "id").limit(train_docs))
    pick = staged(pick, "training-ids")
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = text.join(broadcast_if_small(pick), "id").select("id", "text", "y").orderBy("id", "text").toLocalIterator()
    field = train([(r["text"] or "", int(r["y"])) for r in rows])
    kind = dict(text.dtypes)["id"]
    return text.mapInArrow(_scorer(field, with_spans), f"id {kind}, score double" + (", spans array<struct<start:bigint,end:bigint,p:double>>" if with_spans else ""))


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def op10_crf_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    out = toxicity(docs, labels).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
