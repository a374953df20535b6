"""Best-fit packing into sequences of several permitted lengths.

Documents are cut into pieces of at most the largest capacity. Pieces are dealt by hash into shards of about
``shard`` pieces, each packed on its own, longest first: a piece goes into the open bin that it fills
best. Where none has room, a bin is opened at the capacity of least cost: for each permitted one a trial
fills the rest with the longest pieces still to come, and the cost is (capacity + ``overhead``) per
token that the trial got in, so all capacities compete for the same pieces. In the end each bin is
downsized to the least permitted capacity that holds its contents.

Only ids and lengths move. A shard has a bounded number of pieces whatever the corpus, and its packing
depends on nothing else, so a lost executor repeats only its shards.

Defined cases: a document has one token per word and one that ends it, so null and blank texts have one. Every
row is packed, repeated rows too. Null ids are spread by their text. Extra columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestead.llm.common import words, written


@dataclass(frozen=True)
class Packing:
    capacities: tuple[int, ...] = (512, 1024, 2048, 4096)
    #: Cost of a sequence besides its tokens.
    overhead: int = 16
    shard: int = 2048


def _trial(sizes: list[int], first: int, capacity: int) -> int:
    """Tokens in a bin that holds first and then always the longest of sizes (ascending) that fits."""
    room, upto, used = capacity - first, len(sizes), first
    while room > 0:
        upto = bisect_right(sizes, room, 0, upto) - 1
        if upto < 0:
            break
        room -= sizes[upto]
        used += sizes[upto]
    return used


def pack(lengths: list[int], rules: Packing) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, and the capacity of each bin. No length is above the largest capacity."""
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    waiting = sorted(lengths)
    bin_of, offset = [0] * len(lengths), [0] * len(lengths)
    used: list[int] = []
    rooms: list[tuple[int, int]] = []  # (room, bin), ascending
    for i in order:
        n = lengths[i]
        waiting.pop()  # the longest: this piece
        at = bisect_left(rooms, (n, -1))
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room = min(
                (c for c in rules.capacities if c >= n),
                key=lambda c: ((c + rules.overhead) / _trial(waiting, n, c), -c),
            )
            b = len(used)
            used.append(0)
        bin_of[i], offset[i] = b, used[b]
        used[b] += n
        if room > n:
            insort(rooms, (room - n, b))
    permitted = sorted(rules.capacities)
    return bin_of, offset, [permitted[bisect_left(permitted, u)] for u in used]


def pieces_of(docs: DataFrame, row_id: Column, n_tokens: Column, spread: Column, rules: Packing) -> DataFrame:
    """(id, piece, start, n_tokens, h): every document cut at the largest capacity."""
    top = max(rules.capacities)
    cut = docs.select(
        row_id.alias("id"),
        n_tokens.cast("long").alias("n"),
        spread.alias("h"),
    )
    cut = cut.withColumn("piece", F.explode(F.expr(f"sequence(0, cast(greatest(n - 1, 0) div {top} as int))")))
    start = F.col("piece").cast("long") * top
    return cut.select("id", "piece", start.alias("start"), F.least(F.lit(top), F.col("n") - start).alias("n_tokens"), "h")


def best_fit_packing(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    rules: Packing = Packing(),  # noqa: B008
) -> DataFrame:
    """One row per piece: id, piece, start, n_tokens (a span of the document), bin_id, capacity, offset."""
    n_tokens = F.size(words(F.col(text))) + 1
    cut = written(pieces_of(docs, F.col(id_col), n_tokens, F.xxhash64(id_col, text), rules), "pieces")
    shards = max(1, -(-cut.count() // rules.shard))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("h", "piece"), F.lit(shards)))
    kind = dict(cut.dtypes)["id"]

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "id", "piece", "h"], ascending=[False, True, True, True], kind="stable")
        bins, offsets, capacities = pack(group["n_tokens"].tolist(), rules)
        base = int(group["shard"].iloc[0]) << 24
        return pd.DataFrame(
            {
                "id": group["id"].to_numpy(),
                "piece": group["piece"].to_numpy(),
                "start": group["start"].to_numpy(),
                "n_tokens": group["n_tokens"].to_numpy(),
                "bin_id": base + np.array(bins, np.int64),
                "bin_capacity": np.array(capacities, np.int32)[bins],
                "bin_offset": np.array(offsets, np.int32),
            }
        )

    packed = dealt.groupBy("shard").applyInPandas(
        work,
        f"id {kind}, piece int, start long, n_tokens long, bin_id long, bin_capacity int, bin_offset int",
    )
    return packed.withColumnRenamed("id", id_col)
