"""Packing documents into token windows: repeat counts of shallow length combinations by non-negative least squares.

Every task packs blocks of its own partition, without a shuffle. A document's whole windows stand alone; what is left
of each document goes into a histogram of lengths. Pairs and triples of lengths that fill a window exactly are
enumerated, their repeat counts x >= 0 solved to fit the histogram, rounded, and laid out while pieces last. The
residual pieces are packed greedily, the largest that fits first; where none fits, one is cut. The open window at the
end of a block is carried into the next, so that only the last window of a partition is padded.

Results for odd input: a null or empty text is the end token alone; equal rows are packed separately; texts of any
length are cut into windows; a literal <|endoftext|> is its one id; no documents give no pieces; a null id is kept; extra columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import re
import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import sliced

WINDOW, END = 2048, 1
#: Literal tokens that the tokenizers file adds to the vocabulary: a text is cut at them before anything else.
ADDED = {"<|endoftext|>": 50256}
#: Tokens that a task holds before it packs them.
BLOCK_TOKENS = 6_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tokens:
    """Ids of texts by a byte-level BPE vocabulary; words between single spaces are looked up, anything else is encoded whole.

    The pattern that splits text before the merges never spans from a word into the white space after it, so a text
    whose only white space is single spaces and single line feeds is the sum of its words, each with the one
    character before it.
    """

    #: Words that are remembered between texts.
    LIMIT = 800_000
    ODD = re.compile(r"[^\S\n ]|[ \n][ \n]|\A[ \n]|[ \n]\Z|\0")
    #: Letters and then marks: two pieces for the pattern, whatever they are. A zero stands for no space before the word.
    PARTS = re.compile(r"(\0?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!#$%&()*+,\-./:;=?|]*)")

    def __init__(self, path: str, pattern: str) -> None:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        # Ids of all known words, one after another; where each begins, and how many it has.
        self.flat, self.first, self.size = array("I"), array("q"), array("q")
        self.marks: dict[str, list[int]] = {}

    def with_added(self, text: str | None) -> np.ndarray:
        """Ids of a text as the tokenizers file has them by default: literals of ``ADDED`` are one id each."""
        if not text or not any(a in text for a in ADDED):
            return self.of(text)
        parts = re.split("(" + "|".join(map(re.escape, ADDED)) + ")", text)
        return np.concatenate([np.array([ADDED[x]], np.uint32) if x in ADDED else self.of(x) for x in parts])

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), np.uint32)

    def _add(self, word: str, ids: list[int]) -> None:
        self.known[word] = len(self.size)
        self.first.append(len(self.flat))
        self.size.append(len(ids))
        self.flat.extend(ids)

    def _learn(self, words: list[str]) -> None:
        known, parts, single = self.known, self.PARTS.fullmatch, self.encoding._encode_single_piece
        for word in words:
            if word in known:  # learnt as a part of an earlier one
                continue
            m = parts(word)
            if not m:
                self._add(word, self.encoding.encode_ordinary(word if word == "\n" else word[1:] if word[:1] == "\0" else " " + word))
                continue
            letters, marks = m.groups()
            if letters not in known:
                self._add(letters, single(letters[1:] if letters[0] == "\0" else " " + letters))
            if marks:
                k = known[letters]
                first = self.first[k]
                tail = self.marks.get(marks)
                if tail is None:
                    tail = self.marks[marks] = single(marks)
                self._add(word, [*self.flat[first : first + self.size[k]], *tail])

    def of(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self.ODD.search(text):
            return self.whole(text)
        words = text.replace("\n", " \n \0").split(" ")
        words[0] = "\0" + words[0]
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > self.LIMIT:
                self._forget()
                known, new = self.known, list(set(words))
                if len(new) > self.LIMIT:
                    return self.whole(text)
            self._learn(new)
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        size = np.frombuffer(self.size, np.int64)[at]
        end = np.cumsum(size)
        return np.frombuffer(self.flat, np.uint32)[np.repeat(np.frombuffer(self.first, np.int64)[at] - (end - size), size) + np.arange(end[-1])]


def tokens_of_worker(path: str | None) -> Tokens:
    """The tokens of ``path`` that this Python worker keeps from task to task."""
    import public_tokenizers

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kept = sys.modules.setdefault("_veinstone_worker", types.ModuleType("_veinstone_worker"))
    if getattr(kept, "path", None) != path:
        kept.path, kept.tokens = path, Tokens(path, public_tokenizers.PATTERN)
    return kept.tokens


def combinations(counts: np.ndarray, window: int = WINDOW, triples: int = 8) -> np.ndarray:
    """Rows of 3 lengths (0: none) that fill the window: every pair that occurs, and for every length some triples spread over the splits of the rest."""
    have = np.flatnonzero(counts)
    there = counts > 0
    rows = [(window - a, a, 0) for a in have if 2 * a <= window and window - a < len(counts) and there[window - a]]
    for a in have[::-1]:
        rest = window - a
        low = have[(have <= rest // 2) & (have >= max(1, rest - a))]
        low = low[there[rest - low]]
        rows += [(a, rest - b, b) for b in low[np.linspace(0, len(low) - 1, min(triples, len(low))).astype(int)]]
    return np.array(sorted(set(rows), reverse=True), np.int64).reshape(-1, 3)


def repeat_counts(combos: np.ndarray, counts: np.ndarray, steps: int = 200) -> np.ndarray:
    """x >= 0 that minimises |A x - counts|^2, A having each combination's lengths as a column: accelerated projected gradient."""
    used = combos > 0
    degree = np.bincount(combos[used], minlength=len(counts))
    step = 1.0 / max(1.0, 3.0 * degree.max(initial=1))
    target = counts.astype(float)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(steps):
        made = np.bincount(combos.ravel(), np.repeat(y, 3), minlength=len(counts))
        gap = made - target
        gap[0] = 0.0
        new = np.maximum(0.0, y - step * gap[combos].sum(1))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y, x, t = new + (t - 1) / after * (new - x), new, after
    return x


def packed(lengths: np.ndarray, window: int = WINDOW) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """Windows as lists of (piece, from, length), all full, and what is left for the next block."""
    counts = np.bincount(lengths, minlength=window + 1)[: window + 1]
    stock: list[list[tuple[int, int, int]]] = [[] for _ in range(window + 1)]
    for k in np.argsort(-lengths, kind="stable").tolist():
        stock[lengths[k]].append((k, 0, int(lengths[k])))
    full = [[p] for p in stock[window]]
    stock[window] = []
    counts[window] = 0
    combos = combinations(counts, window)
    if len(combos):
        x = repeat_counts(combos, counts)
        order = np.argsort(-x, kind="stable")
        for times in (np.rint(x).astype(int), np.full(len(x), len(lengths))):  # the rounded counts, then whatever fills a window still
            for k in order.tolist():
                parts = [p for p in combos[k].tolist() if p]
                n = times[k]
                while n > 0 and all(len(stock[p]) >= parts.count(p) for p in parts):
                    full.append([stock[p].pop() for p in parts])
                    n -= 1
    have = [n for n in range(1, window) if stock[n]]

    def take(n: int) -> tuple[int, int, int]:
        piece = stock[n].pop()
        if not stock[n]:
            have.pop(bisect.bisect_left(have, n))
        return piece

    while have:
        row, space = [], window
        while space and have:
            k = bisect.bisect_right(have, space)
            if k:
                row.append(take(have[k - 1]))
                space -= row[-1][2]
                continue
            piece, at, n = take(have[0])
            row.append((piece, at, space))
            if not stock[n - space]:
                bisect.insort(have, n - space)
            stock[n - space].append((piece, at + space, n - space))
            space = 0
        if space:
            return full, row
        full.append(row)
    return full, []


def _packer(path: str | None, window: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, public = tokens_of_worker(path), path is None
        seq = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        pool: list[tuple] = []  # (doc_id, first token, ids, doc_tokens) of documents' remainders
        held = 0

        def laid(rows: list[list[tuple[int, int, int]]]) -> None:
            nonlocal seq
            for row in rows:
                at = 0
                for k, first, n in row:
                    doc, start, ids, total = pool[k]
                    part = ids[first : first + n]
                    out.append((doc, start + first, n, zlib.crc32(part.tobytes()), total, seq, at, *([part] if with_ids else [])))
                    at += n
                seq += 1

        def emitted() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) or [()] * (7 + with_ids)
            arrays = [pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(c, pa.list_(pa.int32())) for c in cols[7:]]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids])

        for batch in sliced(batches):
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = np.append(tokens.with_added(text) if public else tokens.of(text), np.uint32(end)).astype("<u4")
                total = len(ids)
                for start in range(0, total - total % window, window):
                    part = ids[start : start + window]
                    out.append((doc, start, window, zlib.crc32(part.tobytes()), total, seq, 0, *([part] if with_ids else [])))
                    seq += 1
                if total % window:
                    pool.append((doc, total - total % window, ids[total - total % window :].copy(), total))
                    held += total % window
                if held >= BLOCK_TOKENS:
                    rows, rest = packed(np.array([len(p[2]) for p in pool]), window)
                    laid(rows)
                    pool = [(pool[k][0], pool[k][1] + first, pool[k][2][first : first + n], pool[k][3]) for k, first, n in rest]
                    held = sum(len(p[2]) for p in pool)
                    yield emitted()
            if len(out) > 20_000:
                yield emitted()
        rows, rest = packed(np.array([len(p[2]) for p in pool], np.int64), window)
        laid([*rows, *([rest] if rest else [])])
        yield emitted()

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, window: int = WINDOW, end: int = END, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: their place in the document, and their sequence and offset there.

    ``tokenizer``: path of a rank file on the executors (default: the public byte_bpe_50k, whose ids are those of its
    tokenizers file); ``with_ids`` adds the token ids of each piece.
    """
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return text.mapInArrow(_packer(tokenizer, window, end, with_ids), SCHEMA + (", ids array<int>" if with_ids else ""))


def op1_nnls_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
