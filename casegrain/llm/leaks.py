"""Evaluation texts that leaked into training text (problem 6).

Method: winnowing. Words are compared in their consistent, caseless form without punctuation and reference marks. Of every
window of ``window`` successive word ``gram``-grams the least hash is kept, in documents and test items alike, so every
shared run of ``gram + window - 1`` words leaves a shared fingerprint. The fingerprints of both sides are joined; each hit
names a document and an item. Hits are then extended: the runs of words the two share are chained in the order of both
texts across isolated changed, dropped or added words and across remarks put into the document. A chain that spans at
least ``least_words`` words of the item (or all of a shorter item) is a case.

Test sets are small beside the corpus, but only a count proves it: up to ``broadcast_fingerprints`` the test side goes to all
workers and the corpus is never shuffled. Beyond that the corpus' fingerprints meet the test side's in a shuffled join,
in which fingerprints that many documents share are spread by salt. Both ways give the same cases: a document with a hit is
compared with every item it shares words with, and items too short for a sure fingerprint are looked up as a whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.llm.lookalikes import representatives, rewriter
from casegrain.operators.joins import salted_join
from casegrain.session import spread

GRAM, WINDOW = 4, 3
LEAST_WORDS = 25
SHARED = 0.75  # of the words a chain spans in the item
REMARK = 48  # words of a remark put into a passage
BROADCAST_FINGERPRINTS = 2_000_000
SALTS = 16

MARKS = re.compile(r"\[\d+(?:\s*[-–,]\s*\d+)*\]")
WORDS = re.compile(r"[^\W_]+")
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _plain():
    return rewriter(representatives({chr(c): 1 for c in range(32, 127)}))


def words(text: str) -> list[str]:
    """The words of a text as they are compared; digits in square brackets are reference marks."""
    return WORDS.findall(MARKS.sub(" ", _plain()(text)).casefold())


class WordHashes(dict):
    """word -> 64-bit hash, the same on every worker."""

    def __missing__(self, word: str) -> int:
        if len(self) > 2_000_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = WordHashes()


def hash_words(ws: list[str]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, ws), np.uint64, len(ws))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams; order matters."""
    if len(h) < k:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(len(h) - k + 1, np.uint64)
        for i in range(k):
            out = (out ^ (out >> np.uint64(29))) * MIX + h[i : len(h) - k + 1 + i]
        return out ^ (out >> np.uint64(32))


def winnow(g: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: the rightmost least hash of every window (of the whole, if it is shorter)."""
    if not len(g):
        return np.empty(0, np.int64)
    w = min(window, len(g))
    view = np.lib.stride_tricks.sliding_window_view(g[::-1], w)
    return np.unique(len(g) - 1 - (np.arange(len(view)) + view.argmin(axis=1)))


class Items:
    """The test side as arrays: fingerprints per item and postings of all trigrams."""

    def __init__(self, rows: list[tuple[int, str]], gram: int = GRAM, window: int = WINDOW):
        self.ids, self.words, fp, post = [], [], [], []
        for item, text in rows:
            h = hash_words(words(text))
            if not len(h):
                continue
            n = len(self.ids)
            self.ids.append(item)
            self.words.append(h)
            g = grams(h, min(gram, len(h)))
            fp.append(g[winnow(g, window)])
            t = grams(h, 3)
            post.append(np.stack([t, np.full(len(t), n, np.uint64), np.arange(len(t), dtype=np.uint64)]) if len(t) else np.empty((3, 0), np.uint64))
        self.fingerprints = np.unique(np.concatenate(fp)) if fp else np.empty(0, np.uint64)
        p = np.concatenate(post, axis=1) if post else np.empty((3, 0), np.uint64)
        order = np.argsort(p[0], kind="stable")
        self.gram3, self.of, self.at = p[0][order], p[1][order].astype(np.int64), p[2][order].astype(np.int64)
        self.whole = {n: np.array([grams(h, n)[0] for h in self.words if len(h) == n], np.uint64) for n in {len(h) for h in self.words} if n < gram + window - 1}
        self.short: dict[int, set[int]] = {}
        for h in self.words:
            if len(h) < 3:
                self.short.setdefault(len(h), set()).add(int(grams(h, len(h))[0]))

    def has(self, g: np.ndarray) -> np.ndarray:
        f = self.fingerprints
        if not len(f) or not len(g):
            return np.zeros(len(g), bool)
        i = np.minimum(np.searchsorted(f, g), len(f) - 1)
        return f[i] == g


def runs(h: np.ndarray, items: Items, least_words: int = LEAST_WORDS) -> dict[int, list[tuple[int, int, int]]]:
    """item -> maximal shared runs of three words or more: (start in document, start in item, words)."""
    g = grams(h, 3)
    if not len(g) or not len(items.gram3):
        return {}
    lo = np.searchsorted(items.gram3, g, "left")
    n = np.searchsorted(items.gram3, g, "right") - lo
    j = np.repeat(np.arange(len(g)), n)
    if not len(j):
        return {}
    pick = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(j))
    item, p = items.of[pick], items.at[pick]
    order = np.lexsort((j, j - p, item))
    item, p, j = item[order], p[order], j[order]
    new = np.ones(len(j), bool)
    new[1:] = (item[1:] != item[:-1]) | (j[1:] != j[:-1] + 1) | (p[1:] != p[:-1] + 1)
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(j))) + 2
    of, a, b = item[start], j[start], p[start]
    total = np.bincount(of, weights=length, minlength=len(items.ids))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for k in np.flatnonzero(total >= SHARED * np.minimum(least_words, [len(w) for w in items.words])):
        m = of == k
        out[int(k)] = list(zip(a[m].tolist(), b[m].tolist(), length[m].tolist(), strict=True))
    return out


def best_chain(found: list[tuple[int, int, int]]) -> tuple[int, int, int, int]:
    """(words shared, words spanned in the item, start and end in the document) of the best chain of runs.

    Two runs join if at most one word was changed, dropped or added between them, or if the document goes on after a remark
    exactly where the item had stopped.
    """
    found.sort()
    best, state = (0, 0, 0, 0), []
    for x, (j, p, n) in enumerate(found):
        shared, start, begin = n, p, j
        for y in range(x - 1, -1, -1):
            j2, p2, n2 = found[y]
            if j - j2 - n2 > REMARK:
                continue
            over = max(0, j2 + n2 - j, p2 + n2 - p)
            if over >= min(n, n2):
                continue
            gj, gi = j - j2 - n2, p - p2 - n2
            if gj < -2 or gi < -2:
                continue
            gj, gi = max(gj, 0), max(gi, 0)
            if not ((gj <= 1 and gi <= 1) or (gi == 0 and gj <= REMARK)):
                continue
            if state[y][0] + n - over > shared:
                shared, start, begin = state[y][0] + n - over, state[y][1], state[y][2]
        state.append((shared, start, begin))
        best = max(best, (shared, p + n - start, begin, j + n))
    return best


def chains(h: np.ndarray, items: Items, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int, int, int]]:
    """(item, words shared, words spanned, start and end in the document) of every item with enough words in ``h``."""
    cases = []
    for k, found in runs(h, items, least_words).items():
        shared, span, begin, end = best_chain(found)
        need = min(least_words, len(items.words[k]))
        if span >= need and shared >= SHARED * span:
            cases.append((items.ids[k], shared, span, begin, end))
    return cases


def short_items(h: np.ndarray, items: Items) -> list[tuple[int, int, int]]:
    """(item, words, words) of the items of one or two words in ``h``."""
    out = []
    for n, hashes in items.short.items():
        there = set(grams(h, n).tolist()) & hashes
        out += [(i, n, n) for i, w in zip(items.ids, items.words, strict=True) if len(w) == n and int(grams(w, n)[0]) in there]
    return out


def leaked(h: np.ndarray, items: Items, least_words: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(item, words shared, words spanned) of every item that leaked into the words ``h``.

    Items made of like sentences resemble each other: an inexact chain within the passage of a better item is that item's.
    """
    cases = chains(h, items, least_words)
    out = []
    for i, shared, span, begin, end in cases:
        if shared == span or not any(s > shared and b <= begin and end <= e for _, s, _, b, e in cases):
            out.append((i, shared, span))
    return out + short_items(h, items)


def _find_in(h: np.ndarray, items: Items, gram: int, window: int, least_words: int) -> list[tuple[int, int, int]]:
    g = grams(h, gram)
    if not items.short and not items.has(g[winnow(g, window)]).any() and not any(np.isin(grams(h, n), w).any() for n, w in items.whole.items()):
        return []
    return leaked(h, items, least_words)


_built: dict[int, Items] = {}


def _items(rows: list[tuple[int, str]], gram: int, window: int) -> Items:
    key = hash((tuple(rows), gram, window))
    if key not in _built:
        _built.clear()
        _built[key] = Items(rows, gram, window)
    return _built[key]


OUT = "doc_id long, item_id long, shared_words int, spanned_words int"


def find_leaks(
    documents: DataFrame,
    items: DataFrame,
    gram: int = GRAM,
    window: int = WINDOW,
    least_words: int = LEAST_WORDS,
    broadcast_fingerprints: int = BROADCAST_FINGERPRINTS,
) -> DataFrame:
    """One row per document (``doc_id``, ``text``) and leaked item (``item_id``, ``text``), with the words shared.

    Null and empty texts on either side match nothing. Equal items both leak; repeated document rows give one row. An item
    shorter than ``least_words`` leaks only as a whole.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") > 0)
    tests = items.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.length("text") > 0)
    letters = tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    if letters <= 4 * broadcast_fingerprints:  # a fingerprint needs a word of its own, thus two characters at least
        rows = sorted((r["item_id"], r["text"]) for r in tests.collect())

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            side = _items(rows, gram, window)
            for b in batches:
                out = [(d, *x) for d, t in zip(b["doc_id"], b["text"], strict=True) for x in _find_in(hash_words(words(t)), side, gram, window, least_words)]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "shared_words", "spanned_words"])

        found = spread(docs, "doc_id").mapInPandas(scan, OUT)
    else:
        found = _joined(docs, tests, gram, window, least_words)
    return found.groupBy("doc_id", "item_id").agg(F.max("shared_words").alias("shared_words"), F.max("spanned_words").alias("spanned_words"))


def fingerprints(texts: DataFrame, key: str, gram: int = GRAM, window: int = WINDOW, sizes: tuple[int, ...] = (), whole: bool = False) -> DataFrame:
    """Distinct (key, fp) of all texts; of ``sizes``, all grams are kept, or with ``whole`` only those that are a whole text."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, fps = [], []
            for k, t in zip(b[key], b["text"], strict=True):
                h = hash_words(words(t))
                g = grams(h, min(gram, max(1, len(h))))
                f = np.unique(np.concatenate([g[winnow(g, window)], *(grams(h, n) for n in sizes if not whole or n == len(h))])).view(np.int64)
                keys.append(np.full(len(f), k, np.int64))
                fps.append(f)
            yield pd.DataFrame({key: np.concatenate(keys) if keys else [], "fp": np.concatenate(fps) if fps else []}).astype("int64")

    return texts.select(key, "text").mapInPandas(scan, f"{key} long, fp long")


def _counted(texts: DataFrame, key: str, sizes: tuple[int, ...] = ()) -> DataFrame:
    """(key, fp, times, size) of all trigrams and all grams of ``sizes``; without ``sizes``, a text of fewer words is one gram."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parts = []
            for k, t in zip(b[key], b["text"], strict=True):
                h = hash_words(words(t))
                g = np.concatenate([grams(h, n) for n in ({3, *sizes} if sizes else {min(3, max(1, len(h)))})])
                f, n = np.unique(g, return_counts=True)
                parts.append(np.stack([np.full(len(f), k, np.int64), f.view(np.int64), n.astype(np.int64), np.full(len(f), len(h), np.int64)]))
            yield pd.DataFrame(np.concatenate(parts, axis=1).T if parts else np.empty((0, 4), np.int64), columns=[key, "fp", "times", "size"])

    return texts.select(key, "text").mapInPandas(scan, f"{key} long, fp long, times long, size long")


def _few_words(tests: DataFrame, below: int) -> tuple[int, ...]:
    """The word counts under ``below`` that occur."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"n": sorted({len(words(t)) for t in b["text"]} & set(range(1, below)))}, dtype="int64")

    return tuple(sorted(r["n"] for r in tests.select("text").mapInPandas(scan, "n long").distinct().collect()))


def _meet(left: DataFrame, right: DataFrame) -> DataFrame:
    salt = F.pmod(F.xxhash64("doc_key"), F.lit(SALTS)).cast("int")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.withColumn("salt", salt).join(right.hint("shuffle_hash"), ["fp", "salt"])


def _joined(docs: DataFrame, tests: DataFrame, gram: int, window: int, least_words: int) -> DataFrame:
    """The same for a test side of any size, in salted, shuffled joins.

    Fingerprints tell which documents have a hit (all count as hit if an item has one or two words, as above). These meet
    all items by trigram; as in ``runs``, a pair needs enough of them. Chains are found pair by pair and compared per document.
    """
    docs = docs.withColumn("doc_key", F.xxhash64("doc_id", "text"))
    tests = tests.withColumn("item_key", F.xxhash64("item_id", "text"))
    few = _few_words(tests, gram + window - 1)
    short = tuple(n for n in few if n < 3)
    hit = docs
    if not short:
        right = fingerprints(tests, "item_key", gram, window, few, whole=True).select("fp").distinct()
        hit = docs.join(_meet(fingerprints(docs, "doc_key", gram, window, few), right).select("doc_key").distinct(), "doc_key", "left_semi")
    left = _counted(hit, "doc_key", (3, *short)).drop("size")
    met = _meet(left, _counted(tests, "item_key").withColumnRenamed("times", "often")).groupBy("doc_key", "item_key").agg(F.sum(F.col("times") * F.col("often")).alias("n"), F.first("size").alias("size"))
    pairs = met.where(3 * F.col("n") >= SHARED * F.least(F.lit(least_words), "size")).select("doc_key", "item_key")
    texts = salted_join(pairs, tests.withColumnRenamed("text", "item_text"), ["item_key"], ["doc_key"]).join(docs, "doc_key")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, d, i, it, t in zip(b["doc_key"], b["doc_id"], b["item_id"], b["item_text"], b["text"], strict=True):
                h, item = hash_words(words(t)), Items([(i, it)], gram, window)
                out += [(k, d, *x) for x in chains(h, item, least_words)] + [(k, d, *x, 0, 0) for x in short_items(h, item)]
            yield pd.DataFrame(out, columns=["doc_key", "doc_id", "item_id", "shared_words", "spanned_words", "start", "stop"])

    cases = texts.select("doc_key", "doc_id", "item_id", "item_text", "text").mapInPandas(verify, f"doc_key long, {OUT}, start int, stop int")
    per = cases.groupBy("doc_key", "doc_id").agg(F.collect_list(F.struct("item_id", "shared_words", "spanned_words", "start", "stop")).alias("cs"))
    better = "exists(cs, o -> o.shared_words > c.shared_words and o.start <= c.start and c.stop <= o.stop)"
    kept = per.select("doc_id", F.explode(F.expr(f"filter(cs, c -> c.shared_words = c.spanned_words or not {better})")).alias("c"))
    return kept.select("doc_id", "c.item_id", "c.shared_words", "c.spanned_words")
