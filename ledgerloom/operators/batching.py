"""Batches under a budget: next-fit packing, whole-file packing, fixed chunks and numbering.

Packing depends on the order of all items, so it runs inside lanes: a lane is an ordered range of the items
(a year, an issue), packed in one pass by a stateful scan over rows that arrive sorted. Lanes are independent and
spread over the cluster; a lane is never built as a list.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def text_tokens(text: Column) -> Column:
    """A stand-in for a tokenizer: a quarter of the characters, rounded up; null counts none."""
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4).cast("int")


def condense_budget(window: int = 32_000, ratio: float = 0.2, overhead: int = 650) -> tuple[int, int]:
    """(tokens in, tokens out) of one call that condenses text to a share of its length."""
    if not 0.05 <= ratio <= 0.95 or window < 2048:
        raise ValueError("the ratio must lie in 0.05..0.95, the window be 2048 or more")
    tokens_in = int((window - overhead) / (1 + ratio) * 0.95)
    return tokens_in, max(2048, int(tokens_in * ratio * 1.1))


def record_budget(window: int = 128_000, overhead: int = 2500, each: int = 150) -> tuple[int, int]:
    """(records, tokens out) of one call over records."""
    n = int((window - overhead) * 0.9 // each)
    return n, 100 * n + 512


def _packed(batches: Iterator[pd.DataFrame], budget: int, whole: bool) -> Iterator[pd.DataFrame]:
    lane, batch, used = None, 0, 0
    for pdf in batches:
        out = np.empty(len(pdf), np.int64)
        for i, (key, size) in enumerate(zip(pdf["lane"].to_numpy(), pdf["size"].to_numpy(), strict=True)):
            if key != lane:
                lane, batch, used = key, 0, 0
            elif whole and used >= budget or not whole and used and used + size > budget:
                batch, used = batch + 1, 0
            used += size
            out[i] = batch
        yield pdf.assign(batch=out)


def pack(items: DataFrame, lane: Column, order: Sequence[str], size: str, budget: int, whole: bool = False) -> DataFrame:
    """items with lane (a hash) and batch.

    whole=False: next fit; an item that would exceed the budget opens a batch, an item above it stands alone.
    whole=True: items are appended until a batch reaches the budget, so it may overshoot. Null sizes count as nought.
    """
    ready = items.withColumns({"lane": F.xxhash64(lane), "__size": F.coalesce(F.col(size), F.lit(0)).cast("bigint")})
    slim = ready.select("lane", *order, F.col("__size").alias("size")).repartition("lane").sortWithinPartitions("lane", *order)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in slim.schema.fields)
    return slim.mapInPandas(lambda it: _packed(it, budget, whole), kinds + ", batch bigint")


def chunks(items: DataFrame, lane: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """items with chunk and idx: each n successive rows of a lane, numbered from nought."""
    row = F.row_number().over(Window.partitionBy(*lane).orderBy(*order)) - 1
    return items.withColumn("__row", row).withColumns({"chunk": F.floor(F.col("__row") / n), "idx": (F.col("__row") % n).cast("int")}).drop("__row")


def packed_text(pages: DataFrame, batch: Sequence[str], issue: str, order: str, ref: str, text: str) -> DataFrame:
    """One prompt for each batch: a header where the issue changes, then the page. A batch is bounded by its budget."""
    w = Window.partitionBy(*batch).orderBy(order)
    changed = F.coalesce(F.lag(issue).over(w) != F.col(issue), F.lit(True))
    block = F.concat(F.when(changed, F.concat(F.lit("### "), F.col(issue), F.lit("\n"))).otherwise(""), F.lit("=== ref:"), F.col(ref), F.lit(" ===\n"), F.col(text))
    parts = pages.withColumn("__b", F.struct(F.col(order).alias("o"), block.alias("b")))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("__b")), lambda x: x["b"]), "\n")
    return parts.groupBy(*batch).agg(joined.alias("prompt"), F.count(F.lit(1)).alias("n_pages"))


def refused(answers: DataFrame, batch: str, reason: str, refusals: Sequence[str], share: float = 0.75) -> DataFrame:
    """batch, refused: whether a batch was refused as a whole rather than judged row by row.

    So it is if generic reasons make up the share, or one reason alone stands over max(2, n div 2) or more rows.
    """
    generic = F.count_if(F.lower(F.trim(reason)).isin(*refusals))
    stated = answers.groupBy(batch).agg(
        F.count(F.lit(1)).alias("n"), generic.alias("g"), F.count(reason).alias("r"), F.count_distinct(reason).alias("d")
    )
    one = (F.col("d") == 1) & (F.col("r") >= F.greatest(F.lit(2), F.floor(F.col("n") / 2)))
    return stated.select(batch, ((F.col("g") / F.col("n") >= share) | one).alias("refused"))
