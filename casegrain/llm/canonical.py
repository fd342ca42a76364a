"""Free-entered values mapped to the entries of a reference list (problem 2).

Method: the names (terms and aliases) of each field form BK-trees under the unrestricted Damerau-Levenshtein distance, a true
metric in which a transposition is one slip, so the triangle inequality prunes without losing an entry and a search goes
exactly as far as the threshold. A name lies in the tree of its length and letter-group counts; both move by at most one per
slip, so a search visits only the trees whose key is within its radius. A value is brought to a plain form and searched as a
whole, with the parts around a comma or "of" swapped, and as runs of its words, so added qualifiers do not matter. Equal names
are looked up first; a run is searched only if a hit in it could still beat the best one so far.

The names go to all workers if the reference list is small (``broadcast_entries``); a larger list is cut into shards whose trees
are built once and streamed to the values; every distinct value visits every shard, and the shards' winners are merged by a
minimum.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.llm.lookalikes import Rewriter, representatives, rewriter
from casegrain.session import Tables

BROADCAST_ENTRIES = 50_000
SHARD_ENTRIES = 50_000
BUCKET_VALUES = 20_000
NOTHING = -1
WORST = (9, 9.0, 0, NOTHING)
JUDGED = "tier int, cost double, cover int, entry long"

SEPARATORS = re.compile(r"[^\w&+']|_")
ACRONYM = re.compile(r"[A-Z0-9&/]{2,5}$")
OF = re.compile(r"\bof(?: the)? ")
# Ordinary words that are also written as acronyms; inside a longer value they count in capitals only.
ORDINARY = frozenset(
    "a aids all am an and are as at be but by ca can cat did do for from get go had has he her his i if in is it its led let map may me mi ms my no nor not of "
    "off on or our out per ran red rest sad set she so star step stop than the to too up us vs was we who you "
    "am an da das de den der des die du ein el en es et ich il im la las le les lo los mit ob os sa se si son su te tu un una une und von war wo zu".split()
)
GROUPS = ("aeio", "nrt", "lscu")  # every other character is of the last group


def levenshtein(a: str, b: str, masks: dict[str, int] | None = None) -> int:
    """Bit-parallel Levenshtein distance; ``masks`` are the positions of each character of ``a``."""
    if not a or not b:
        return len(a) or len(b)
    if masks is None:
        masks = char_masks(a)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        x = eq | down
        diag = ((((eq & up) + up) ^ up) | x)
        ph = down | ~(diag | up)
        mh = up & diag
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) | 1
        up = ((mh << 1) | ~(diag | ph)) & full
        down = ph & diag & full
    return score


def char_masks(a: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def damerau(a: str, b: str) -> int:
    """Unrestricted Damerau-Levenshtein distance: a metric in which swapping neighbours costs one."""
    n, head = min(len(a), len(b)), 0
    while head < n and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < n - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]  # equal ends never change the distance
    if not a or not b:
        return len(a) or len(b)
    if len(a) == 1 == len(b):
        return 1
    last: dict[str, int] = {}
    inf = len(a) + len(b)
    h = [[inf] * (len(b) + 2) for _ in range(len(a) + 2)]
    for i in range(len(a) + 1):
        h[i + 1][1] = i
    for j in range(len(b) + 1):
        h[1][j + 1] = j
    for i, x in enumerate(a, 1):
        seen = 0
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), seen
            same = x == y
            if same:
                seen = j
            h[i + 1][j + 1] = min(h[i][j] + (not same), h[i + 1][j] + 1, h[i][j + 1] + 1, h[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return h[-1][-1]


class BKTree:
    """Names by Damerau-Levenshtein distance; ``search`` returns every name within a radius."""

    def __init__(self, names: list[str]):
        self.names: list[str] = []
        self.masks: list[dict[str, int]] = []
        self.below: list[dict[int, int]] = []
        for n in names:
            self.add(n)

    def add(self, name: str) -> None:
        at = 0
        while at < len(self.names):
            d = damerau(self.names[at], name)
            if d == 0:
                return
            if d not in self.below[at]:
                self.below[at][d] = len(self.names)
                break
            at = self.below[at][d]
        self.names.append(name)
        self.masks.append(char_masks(name))
        self.below.append({})

    def search(self, query: str, radius: int, visits: list[str] | None = None) -> list[tuple[str, int]]:
        out, todo = [], [0] if self.names else []
        while todo:
            at = todo.pop()
            name, below = self.names[at], self.below[at]
            if visits is not None:
                visits.append(name)
            if not below and levenshtein(name, query, self.masks[at]) > 2 * radius:  # a leaf needs no exact distance beyond the radius
                continue
            d = damerau(name, query)
            if d <= radius:
                out.append((name, d))
            todo += [n for e, n in below.items() if d - radius <= e <= d + radius]
        return out


def letter_groups(s: str) -> tuple[int, ...]:
    """How many characters of each group; one edit takes at most one from a group and gives at most one to another."""
    n = [sum(map(s.count, g)) for g in GROUPS]
    return (*n, len(s) - sum(n))


class Forest:
    """BK-trees by length and letter groups; a tree is built when a search first comes to it."""

    def __init__(self, names: list[str]):
        self.by: dict[int, dict[tuple[int, ...], list[str] | BKTree]] = {}
        for n in names:
            self.by.setdefault(len(n), {}).setdefault(letter_groups(n), []).append(n)
        self.near_keys: dict[tuple, list[tuple[int, tuple[int, ...]]]] = {}

    def build(self) -> Forest:
        for length, keys in self.by.items():
            for k in keys:
                self._tree(length, k)
        return self

    def _tree(self, length: int, key: tuple[int, ...]) -> BKTree:
        t = self.by[length][key]
        if isinstance(t, list):
            t = self.by[length][key] = BKTree(t)
        return t

    def _keys(self, groups: tuple[int, ...], radius: int) -> list[tuple[int, tuple[int, ...]]]:
        size = sum(groups)
        found = []
        for length in range(size - radius, size + radius + 1):
            for k in self.by.get(length, ()):
                more = sum(max(0, x - y) for x, y in zip(k, groups, strict=True))
                if more <= radius and more - length + size <= radius:
                    found.append((length, k))
        if len(self.near_keys) > 100_000:
            self.near_keys.clear()
        self.near_keys[(groups, radius)] = found
        return found

    def search(self, query: str, radius: int, visits: list[str] | None = None) -> list[tuple[str, int]]:
        groups = letter_groups(query)
        keys = self.near_keys.get((groups, radius))
        if keys is None:
            keys = self._keys(groups, radius)
        return [hit for length, k in keys for hit in self._tree(length, k).search(query, radius, visits)]


def slips(length: int) -> int:
    """Slips allowed in a name of this many characters."""
    return 0 if length < 5 else 1 if length < 9 else 2 if length < 18 else 3


@lru_cache(1)
def _plain_rewriter() -> Rewriter:
    return rewriter(representatives({chr(c): 1 for c in range(32, 127)}))


def plain(value: str) -> str:
    """Consistent characters, no case, every separator a single blank."""
    return " ".join(SEPARATORS.sub(" ", _plain_rewriter()(value).casefold()).split())


class Names:
    """The names of one field (or of one shard of it)."""

    def __init__(self, rows: list[tuple[str, int]]):
        """``rows``: name as written, entry; a name shared by entries means the lowest of them."""
        self.entries: dict[str, int] = {}
        self.acronyms: set[str] = set()
        for name, entry in sorted(rows, key=lambda r: (r[1], r[0])):
            p = plain(name)
            if p:
                self.entries.setdefault(p, entry)
                if ACRONYM.match(name.strip()):
                    self.acronyms.add(p)
        self.forest = Forest(sorted(self.entries, key=lambda n: (-len(n), n)))
        self.longest = max([len(n.split()) for n in self.entries] or [0])
        self.known: dict[str, tuple[tuple[int, str], ...]] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "known": {}}

    def near(self, query: str) -> tuple[tuple[int, str], ...]:
        """Every name within the threshold, with its slips."""
        hits = self.known.get(query)
        if hits is None:
            if len(self.known) > 200_000:
                self.known.clear()
            n = len(query) + 1
            found = self.forest.search(query, slips(n))
            hits = self.known[query] = tuple(sorted((k, name) for name, k in found if k <= slips(min(len(name), n))))
        return hits

    def judge(self, value: str) -> tuple[int, float, int, int]:
        """(tier, cost, -covered characters, entry); lower is better. Tiers: whole value, swapped parts, a run of its words."""
        shown = _plain_rewriter()(value)
        words = SEPARATORS.sub(" ", shown).split()
        low = [w.casefold() for w in words]
        if not low:
            return WORST
        whole = " ".join(low)
        if whole in self.entries:
            return (0, -1.0, -len(whole), self.entries[whole])
        parts = [plain(p) for p in shown.split(",")]
        tries = [whole, *(whole[: -len(e)] for e in ("s", "es") if whole.endswith(e) and len(whole) > len(e) + 4)]
        if len(parts) > 1:
            tries += [" ".join(parts[i:] + parts[:i]) for i in range(1, len(parts))]
        heads = OF.split(whole)
        if len(heads) > 1:
            tries.append(" ".join(h.strip() for h in heads[::-1]))
        hits = [(0 if k == 0 else 1, k / len(name) - 1.0, -len(name), self.entries[name]) for q in tries for k, name in self.near(q)]
        if hits:  # no run of words can beat a hit of the whole value
            return min(hits)
        return self._best_run(words, low, parts, heads)

    def _best_run(self, words: list[str], low: list[str], parts: list[str], heads: list[str]) -> tuple[int, float, int, int]:
        runs: dict[str, bool] = {}  # run -> whether it may be an acronym
        for n in range(min(len(low) - 1, self.longest + 1), 0, -1):
            for i in range(len(low) - n + 1):
                run = " ".join(low[i : i + n])
                runs[run] = runs.get(run, False) or words[i].isupper() or run not in ORDINARY
                if run.endswith("es") and len(run) > 6:
                    runs.setdefault(run[:-2], False)
        for one, other in zip(parts, parts[1:], strict=False):
            a, b = one.split(), other.split()
            for x in range(1, min(len(a), self.longest) + 1):
                for y in range(1, min(len(b), self.longest) + 1):
                    if x < len(a) or y < len(b) or len(parts) > 2:
                        runs.setdefault(" ".join(b[:y] + a[-x:]), False)
        for one, other in zip(heads, heads[1:], strict=False):
            a, b = one.split(), other.split()
            for x in range(1, min(len(a), self.longest) + 1):
                for y in range(1, min(len(b), self.longest - x) + 1):
                    for i in range(len(b) - y + 1):
                        runs.setdefault(" ".join(b[i : i + y] + a[-x:]), False)
        best = WORST
        for run, short in runs.items():
            if run in self.entries and (short or run not in self.acronyms):
                best = min(best, (1, -len(run) / 1000.0, -len(run), self.entries[run]))
        for run in sorted(runs, key=len, reverse=True):
            most = len(run) + slips(len(run) + 1)
            if most < 6 or (1, 1 / most - most / 1000.0) > best:
                continue
            for k, name in self.near(run):
                if k and len(name) >= 6 and name not in self.acronyms:
                    best = min(best, (1, k / len(name) - len(name) / 1000.0, -len(name), self.entries[name]))
        return best


def _build(rows: list[tuple[str, str, int]]) -> dict[str, Names]:
    by: dict[str, list[tuple[str, int]]] = {}
    for field, name, entry in rows:
        by.setdefault(field, []).append((name, entry))
    return {f: Names(r) for f, r in by.items()}


_cache: dict[int, dict[str, Names]] = {}


def _names(rows: list[tuple[str, str, int]]) -> dict[str, Names]:
    key = hash(tuple(rows))
    if key not in _cache:
        _cache[key] = _build(rows)
    return _cache[key]


def map_values(values: DataFrame, reference: DataFrame, broadcast_entries: int = BROADCAST_ENTRIES, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """Distinct (field, value) of ``values`` with ``entry``: the reference entry meant, or -1.

    ``reference`` has field, name, entry. Null and blank values give no row; a field without names gives -1; ties go to the
    closer, then longer name, then the lower entry. The reference is collected only if a count shows it to be small.
    """
    distinct = values.select("field", "value").where(F.col("value").isNotNull() & (F.trim(F.regexp_replace("value", r"(?U)[\s\p{Cf}]+", "")) != "")).distinct()
    reference = reference.select("field", "name", F.col("entry").cast("long").alias("entry")).where(F.col("name").isNotNull()).distinct()
    n = reference.count()
    spark = values.sparkSession
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if n <= broadcast_entries:
        rows = sorted((r["field"], r["name"], r["entry"]) for r in reference.collect())

        def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            names = _names(rows)
            for b in batches:
                got = [names[f].judge(v) if f in names else WORST for f, v in zip(b["field"], b["value"], strict=True)]
                yield b.assign(entry=[g[3] for g in got])

        # Few bytes but much work: adaptive execution would put all values into one task, a fixed number of partitions stays.
        return distinct.repartition(tasks, "field", "value").mapInPandas(judge, "field string, value string, entry long")

    shards = -(-n // shard_entries)
    buckets = max(1, -(-distinct.count() // BUCKET_VALUES))

    def plant(g: pd.DataFrame) -> pd.DataFrame:
        names = _build(list(zip(g["field"], g["name"], g["entry"], strict=True)))
        for x in names.values():
            x.forest.build()
        return pd.DataFrame({"shard": [g["shard"].iat[0]], "trees": [pickle.dumps(names)]})

    shard = F.pmod(F.xxhash64("field", "name"), F.lit(shards)).cast("int")
    trees = Tables(spark, "canonical").keep(reference.withColumn("shard", shard).groupBy("shard").applyInPandas(plant, "shard int, trees binary"), "trees")
    bucket = F.pmod(F.xxhash64("field", "value"), F.lit(buckets)).cast("int")
    asked = distinct.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), bucket.alias("bucket"), F.lit(1).alias("turn"), "field", "value", F.lit(None).cast("binary").alias("trees"))
    brought = trees.select("shard", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"), F.lit(0).alias("turn"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), "trees")

    def judge_shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names: dict[str, Names] = {}
        at = None
        for b in batches:
            out = []
            for s, f, v, t in zip(b["shard"], b["field"], b["value"], b["trees"], strict=True):
                if t is None:
                    out.append((f, v, *(names[f].judge(v) if s == at and f in names else WORST)))
                elif s != at:
                    names, at = pickle.loads(t), s
            yield pd.DataFrame(out, columns=["field", "value", "tier", "cost", "cover", "entry"])

    # The trees of a shard come first in each bucket, so the values behind them stream past without a group in memory.
    stream = asked.unionByName(brought).repartition(tasks, "shard", "bucket").sortWithinPartitions("shard", "bucket", "turn")
    won = stream.mapInPandas(judge_shard, f"field string, value string, {JUDGED}")
    return won.groupBy("field", "value").agg(F.min(F.struct("tier", "cost", "cover", "entry")).alias("w")).select("field", "value", "w.entry")
