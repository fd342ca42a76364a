"""Items of varying length in containers of fixed capacity (problem 5).

Method: Karmarkar-Karp multiway differencing. Items are spread over blocks by hash, each of about ``windows`` containers, so
no task grows with the input. In a block every item starts as a partial partition of its own; the two with the largest
imbalance are merged, largest sums against smallest, until one partition into near-equal windows is left. The count of
windows starts at the lower bound (total over capacity, or the items of more than half the capacity) and rises whenever a
window exceeds the capacity. Only a text longer than the capacity is split: into full containers and a rest that is packed.

Lengths are tokens of a public tokenizer whose file is a parameter.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrain.session import Tables, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
WINDOWS = 192
MOST_ITEMS = 20_000
MOST_CAPACITIES = 1_000


@lru_cache(2)
def encoding(path: str):
    """A byte-pair encoder from a file of ranks; no special tokens, so every text is ordinary text."""
    import tiktoken

    # Fixed value: the published word pattern of this vocabulary.
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, tokens) of every non-null text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(tokenizer)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "tokens": [len(enc.encode_ordinary(t)) for t in b["text"]]})

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    return spread(docs, "doc_id").mapInPandas(count, "doc_id long, tokens long")


def _merge(a: list, b: list, k: int) -> list:
    """Two partial partitions, each a descending list of (sum, items) with zeros left out; largest meets smallest."""
    over = len(a) + len(b) - k
    if over <= 0:
        return sorted(a + b, key=lambda w: -w[0])
    # a's window i meets b's window k-1-i; only the last `over` of both have a partner that is not zero
    both = [(a[-1 - i][0] + b[len(b) - over + i][0], a[-1 - i][1] + b[len(b) - over + i][1]) for i in range(over)]
    return sorted(a[: len(a) - over] + b[: len(b) - over] + both, key=lambda w: -w[0])


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Indices of ``sizes`` in at most ``k`` near-equal windows (Karmarkar-Karp)."""
    heap = [(-s, i, [(s, (i,))]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    n = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        m = _merge(a, b, k)
        heapq.heappush(heap, (-(m[0][0] - (m[-1][0] if len(m) == k else 0)), n, m))
        n += 1
    return [list(w[1]) for w in heap[0][2]] if heap else []


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Indices of ``sizes`` (none above ``capacity``) in windows that hold at most ``capacity``; empty items join the first."""
    real = [i for i, s in enumerate(sizes) if s > 0]
    empty = [i for i, s in enumerate(sizes) if s <= 0]
    own = [sizes[i] for i in real]

    def attempt(k: int) -> list[list[int]] | None:
        found = differencing(own, k)
        return None if any(sum(own[i] for i in w) > capacity for w in found) else found

    windows: list[list[int]] = []
    if real:
        low = max(-(-sum(own) // capacity), sum(2 * s > capacity for s in own), 1)
        k, step, found = low, 1, None
        while found is None:
            found = attempt(k)
            if found is None:
                low, k, step = k + 1, min(len(real), k + step), 2 * step
        high = k
        while low < high:  # between the last count that failed and the first that did not
            mid = (low + high) // 2
            better = attempt(mid)
            if better is None:
                low = mid + 1
            else:
                high, found = mid, better
        windows = [[real[i] for i in w] for w in found]
    if empty:
        windows = windows or [[]]
        windows[0] = windows[0] + empty
    return windows


OUT = "capacity_id long, container string, doc_id long, piece int, token_start long, token_end long"


def pack_documents(documents: DataFrame, capacities: DataFrame, tokenizer: str = TOKENIZER, windows: int = WINDOWS) -> DataFrame:
    """Every piece of every document in a container, for each capacity (``capacity_id``, ``capacity_tokens``).

    Null texts take no part; empty texts share a container without filling it. A text of at most the capacity is one piece.
    Capacities that are null or below one are ignored. Containers of different capacities have nothing in common; names of
    containers are unique within a capacity.
    """
    spark = documents.sparkSession
    sizes = Tables(spark, "packing").keep(token_counts(documents, tokenizer), "sizes")
    caps = capacities.select(F.col("capacity_id").cast("long").alias("capacity_id"), F.col("capacity_tokens").cast("long").alias("c")).where("c >= 1").distinct()
    few = caps.limit(MOST_CAPACITIES + 1).collect()
    if len(few) > MOST_CAPACITIES:
        raise ValueError(f"more than {MOST_CAPACITIES} capacities")
    each = F.array(*[F.struct(F.lit(r["capacity_id"]).alias("capacity_id"), F.lit(r["c"]).alias("c")) for r in sorted(few)])
    pieces = (
        sizes.withColumn("k", F.explode(each) if few else F.explode(F.array().cast("array<struct<capacity_id: bigint, c: bigint>>")))
        .select("doc_id", "tokens", "k.*")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.expr("cast((tokens - 1) div c as int)")))))
        .select("capacity_id", "c", "doc_id", "piece", (F.col("piece") * F.col("c")).alias("token_start"), F.least(F.col("tokens"), (F.col("piece") + 1) * F.col("c")).alias("token_end"))
        .withColumn("n", F.col("token_end") - F.col("token_start"))
    )
    full = pieces.where("n = c")
    rest = pieces.where("n < c")
    blocks = rest.groupBy("capacity_id", "c").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("items"))
    want = F.greatest(F.ceil(F.col("total") / (F.col("c") * windows)), F.ceil(F.col("items") / MOST_ITEMS), F.lit(1))
    blocks = blocks.select("capacity_id", want.cast("long").alias("blocks"))
    placed = rest.join(F.broadcast(blocks), "capacity_id").withColumn("block", F.pmod(F.xxhash64("doc_id", "piece"), F.col("blocks")))

    def fill(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["n", "doc_id", "piece"], ascending=[False, True, True], ignore_index=True)
        names = [""] * len(g)
        for w, members in enumerate(pack(g["n"].tolist(), int(g["c"].iat[0]))):
            for i in members:
                names[i] = f"b{g['block'].iat[0]}-{w}"
        return g.assign(container=names)[["capacity_id", "container", "doc_id", "piece", "token_start", "token_end"]]

    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Few bytes but much work: a fixed number of partitions is not put together by adaptive execution.
    packed = placed.repartition(tasks, "capacity_id", "block").groupBy("capacity_id", "block").applyInPandas(fill, OUT)
    whole = full.select("capacity_id", F.concat(F.lit("d"), F.col("doc_id"), F.lit("-"), F.col("piece")).alias("container"), "doc_id", "piece", "token_start", "token_end")
    return packed.unionByName(whole)
