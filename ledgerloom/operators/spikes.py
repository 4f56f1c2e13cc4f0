"""Problem 4: implausible readings in measurements, judged against the source's own behaviour.

For each source (a newspaper's series of one commodity) in order of time:
1. physical limits: readings of nought or less, or a thousand times off the series' median, leave first;
2. stuck runs: eight or more successive dates with exactly one reading, in a series that otherwise moves;
3. a robust autoregression on logarithms: deviations from a running median, clipped for the fit of the
   AR coefficient, residuals scaled by their median absolute deviation;
4. additive-outlier and level-shift tests on the residuals (Chen and Liu's statistics: an outlier touches its own and the
   next residual, a shift all that follow), in rounds: what is found is replaced by the level, the level breaks at
   shifts, and everything is estimated again. Of the two the one counts that explains more of the residuals;
   a deviation that stays for three or more readings is no case either way.

Sources are never gathered into one task when large: those above CHUNK readings are cut by time into as many pieces
as their own size needs, and each piece is judged with the piece before and after it as context.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Readings of one source that a task judges at once; larger sources are cut.
CHUNK = 20_000
#: Fewer readings than this say too little about a source's behaviour.
LEAST = 20
HALF_WINDOW = 7
ROUNDS = 6
#: An outlier stands this many scales off, and at least by this factor.
SCALES, FACTOR = 5.0, 2.0
LIMIT_FACTOR = 1000.0
STUCK_DATES, MOVING_SHARE, LEAST_REST, LEAST_REST_SHARE = 8, 0.7, 5, 0.2

KINDS = ("plausible", "limit", "stuck", "spike")


def _runs(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, after) of maximal runs; same[i] tells whether point i continues the run of i - 1."""
    first = np.flatnonzero(~same)
    return first, np.append(first[1:], len(same))


def stuck(day: np.ndarray, price: np.ndarray) -> np.ndarray:
    """Which points lie in a run of STUCK_DATES or more dates at one price, in a series that otherwise moves."""
    n = len(price)
    out = np.zeros(n, bool)
    if n < STUCK_DATES:
        return out
    same = np.append(False, price[1:] == price[:-1])
    first, after = _runs(same)
    new_day = np.append(True, day[1:] != day[:-1])
    days = np.add.reduceat(new_day, first)
    days = np.where(new_day[first], days, days + 1)
    long = days >= STUCK_DATES
    if long.any():
        # how the rest of the series behaves: nearly every reading there must differ from the one before
        rest = int((after - first)[~long].sum())
        if rest >= max(LEAST_REST, LEAST_REST_SHARE * n) and (~long).sum() >= MOVING_SHARE * rest:
            for a, b in zip(first[long], after[long], strict=True):
                out[a:b] = True
    return out


def running_median(x: np.ndarray, half: int = HALF_WINDOW) -> np.ndarray:
    n = len(x)
    half = min(half, (n - 1) // 2)
    if half < 1:
        return np.full(n, np.median(x))
    wide = np.lib.stride_tricks.sliding_window_view(x, 2 * half + 1)
    mid = np.median(wide, axis=1)
    return np.concatenate([np.full(half, mid[0]), mid, np.full(half, mid[-1])])


def _explained(e: np.ndarray, patterns: np.ndarray) -> float:
    """How much of the residuals' squares the best mixture of the patterns (columns) takes away; the log likelihood's gain, but for a factor."""
    best, *_ = np.linalg.lstsq(patterns, e, rcond=None)
    left = e - patterns @ best
    return float(e @ e - left @ left)


def shift_statistics(x: np.ndarray, off: np.ndarray, a: int, b: int, phi: float) -> tuple[float, float]:
    """(level shift, additive outlier): the squares of residuals that a lasting shift from a on explains, and that outliers at a..b-1 do.

    Residuals are those of the readings up to HALF_WINDOW after b against the level before a; other readings that stand off are left out.
    A series that begins with the run has no level before it and hence no shift, one that ends with it cannot tell and is taken for an outlier.
    """
    own = np.zeros(len(x), bool)
    own[a:b] = True
    before = np.flatnonzero(~off[:a])[-HALF_WINDOW:]
    end = min(len(x), b + HALF_WINDOW)
    if len(before) == 0 or end == b:
        return 0.0, np.inf
    level = np.median(x[before])
    if 2 * np.median(x[b : b + 3] - level) * np.sign(x[a] - level) < abs(np.median(x[a:b]) - level):
        return 0.0, np.inf  # the readings right after the run have returned
    d = np.where(off & ~own, 0.0, x - level)
    at = np.arange(a, end)
    e = d[at] - phi * (d[at - 1])
    use = (own | ~off)[at] & (own | ~off)[at - 1]
    use[0] = True
    lasting = np.where(at == a, 1.0, 1.0 - phi)[:, None]
    passing = np.stack([np.where(at == k, 1.0, np.where(at == k + 1, -phi, 0.0)) for k in range(a, b)], axis=1)
    return _explained(e[use], lasting[use]), _explained(e[use], passing[use])


def outliers(x: np.ndarray) -> np.ndarray:
    """Which points of a series of logarithms are additive outliers, alone or in pairs."""
    n = len(x)
    found = np.zeros(n, bool)
    clean = x.copy()
    shifts: list[int] = []
    for _ in range(ROUNDS):
        level = np.concatenate([running_median(part) for part in np.split(clean, shifts)])
        u = clean - level
        spread = 1.4826 * np.median(np.abs(u)) + 1e-6
        c = np.clip(u, -2.5 * spread, 2.5 * spread)
        phi = float(np.clip(np.dot(c[1:], c[:-1]) / max(np.dot(c[:-1], c[:-1]), 1e-12), 0.0, 0.9))
        scale = 1.4826 * np.median(np.abs(c[1:] - phi * c[:-1])) + 0.005
        raw = x - level
        e = raw - phi * np.append(0.0, u[:-1])
        ahead = np.append(u[1:], 0.0) - phi * raw
        stat = np.abs(e - phi * ahead) / (1 + phi * phi) * np.sqrt(1 + phi * phi) / scale
        off = (stat > SCALES) & (np.abs(raw) > np.log(FACTOR))
        side = np.where(off, np.sign(raw), 0)
        first, after = _runs(np.append(False, side[1:] == side[:-1]))
        short = (side[first] != 0) & (after - first <= 2)
        now, lasting = np.zeros(n, bool), set(shifts)
        for a, b in zip(first[short], after[short], strict=True):
            shift, outlier = shift_statistics(x, off, a, b, phi)
            if shift <= outlier:
                now[a:b] = True
            elif shift > (SCALES * scale) ** 2 and all(abs(a - s) > HALF_WINDOW for s in (0, n, *lasting)):
                lasting.add(int(a))
        if (now == found).all() and len(lasting) == len(shifts):
            break
        found, shifts = now, sorted(lasting)
        clean = np.where(found, level, x)
    return found


def judge(day: np.ndarray, price: np.ndarray) -> np.ndarray:
    """A code into KINDS for each reading of one source, given in order of time."""
    kind = np.zeros(len(price), np.int8)
    good = price > 0
    kind[~good] = 1
    if not good.any():
        return kind
    logs = np.log(np.where(good, price, 1.0))
    wild = good & (np.abs(logs - np.median(logs[good])) > np.log(LIMIT_FACTOR))
    kind[wild] = 1
    keep = np.flatnonzero(good & ~wild)
    if len(keep) == 0:
        return kind
    # copies of a reading on one date count once
    d, p = day[keep], price[keep]
    same = np.append(False, (d[1:] == d[:-1]) & (p[1:] == p[:-1]))
    point = np.cumsum(~same) - 1
    heads = keep[~same]
    marks = np.zeros(len(heads), np.int8)
    marks[stuck(day[heads], price[heads])] = 2
    if len(heads) >= 5:
        marks[outliers(logs[heads])] = 3
    kind[keep] = marks[point]
    return kind


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The sorted rows cut where a source (or piece of one) ends; several whole ones at a time."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        key = batch.column("source").to_numpy(), batch.column("piece").to_numpy()
        if waiting:
            last = waiting[-1]
            before = (last.column("source")[-1].as_py(), last.column("piece")[-1].as_py())
            starts = np.flatnonzero((key[0] != before[0]) | (key[1] != before[1]))
            if len(starts) == 0:
                waiting.append(batch)
                continue
        cut = np.flatnonzero((key[0][1:] != key[0][:-1]) | (key[1][1:] != key[1][:-1]))
        end = int(cut[-1]) + 1 if len(cut) else 0
        done = [*waiting, batch.slice(0, end)] if end else waiting
        if done:
            yield pa.Table.from_batches(done)
        waiting = [batch.slice(end)]
    if waiting:
        yield pa.Table.from_batches(waiting)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in _sources(batches):
        source, piece = table.column("source").to_numpy(), table.column("piece").to_numpy()
        day, price = table.column("day").to_numpy(), table.column("price").to_numpy()
        core, large = table.column("core").to_numpy(), table.column("large").to_numpy()
        cuts = np.flatnonzero((source[1:] != source[:-1]) | (piece[1:] != piece[:-1])) + 1
        kind = np.zeros(len(price), np.int8)
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(price)), strict=True):
            if large[a] or b - a >= LEAST:  # a piece counts as its whole source does
                kind[a:b] = judge(day[a:b], price[a:b])
        hit = np.flatnonzero((kind > 0) & core)
        if len(hit):
            ids = table.column("record_id").take(pa.array(hit)).combine_chunks()
            yield pa.RecordBatch.from_arrays([ids, pa.array([KINDS[k] for k in kind[hit]])], ["record_id", "kind"])


def implausible(rows: DataFrame, source: list[str], order: str, value: str, id_col: str = "record_id", chunk: int = CHUNK) -> DataFrame:
    """(record_id, kind) of the readings that are implausible; kind is limit, stuck or spike.

    rows needs the source columns, the order column (dates as text or dates), the value and the id. Null and NaN values
    are no readings, null orders come first, a null in a source column is a source of its own.
    Sources of fewer than LEAST readings are not judged. Ties in order are kept apart by id; equal
    readings of one date count once. An empty table gives an empty result.
    """
    v = F.col(value).cast("double")
    base = rows.where(v.isNotNull() & ~F.isnan(v)).select(
        F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0001")) for c in source], F.lit(len(source))).alias("source"),
        F.col(order).cast("string").alias("time"),
        v.alias("price"),
        F.col(id_col).alias("record_id"),
    )
    sizes = base.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST)
    hot = sizes.where(F.col("n") > chunk)
    pieces = base.select("*", F.lit(0).alias("piece"), F.lit(True).alias("core"), F.lit(False).alias("large"))
    if hot.take(1):
        pieces = _pieces(base, hot, chunk)
    sorted_rows = (
        pieces.select("source", "piece", F.xxhash64(F.coalesce("time", F.lit(""))).alias("day"), "time", "price", "record_id", "core", "large")
        .repartition("source", "piece").sortWithinPartitions("source", "piece", "time", "record_id")
        .select("source", "piece", "day", "price", "record_id", "core", "large")
    )
    kind = rows.schema[id_col].dataType.simpleString()
    return sorted_rows.mapInArrow(_judged, f"record_id {kind}, kind string")


def _pieces(base: DataFrame, hot: DataFrame, chunk: int) -> DataFrame:
    """Rows of large sources in pieces of about chunk readings, each row also as context of the two next pieces; other rows as they are.

    Every source is cut at its own number of pieces. A reading's place in its source is the count of readings on earlier
    dates and a share, by its id, of those on its own date, so one date may hold any number of them.
    """
    hot = F.broadcast(hot.select("source", "n", F.ceil(F.col("n") / chunk).cast("int").alias("k")))  # at most one in chunk rows is a hot source
    spread = base.join(hot, "source").withColumn("date", F.substring(F.coalesce("time", F.lit("")), 1, 10))
    before = Window.partitionBy("source").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as the calendar has dates
    dates = spread.groupBy("source", "date").agg(F.count(F.lit(1)).alias("on_date"))
    dates = dates.withColumn("earlier", F.coalesce(F.sum("on_date").over(before), F.lit(0)))
    share = F.pmod(F.xxhash64("record_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    own = F.floor((F.col("earlier") + share * F.col("on_date")) * F.col("k") / F.col("n")).cast("int")
    placed = spread.join(dates, ["source", "date"]).withColumn("own", own)
    wanted = F.filter(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1), lambda i: (i >= 0) & (i < F.col("k")))
    cut = placed.select("source", "time", "price", "record_id", "own", F.explode(wanted).alias("piece"))
    cut = cut.select("source", "time", "price", "record_id", "piece", (F.col("piece") == F.col("own")).alias("core"), F.lit(True).alias("large"))
    return base.join(hot, "source", "left_anti").select("*", F.lit(0).alias("piece"), F.lit(True).alias("core"), F.lit(False).alias("large")).unionByName(cut)
