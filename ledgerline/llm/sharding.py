"""Shards of near equal size: sampled splitters cut the key order into ranges, ranges fill the shards.

The order is that of a hash of the text, then of the key, so copies of one text stay together as far as
equal sizes allow. Only splitters and the totals of at most ``MAX_RANGES`` ranges reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import stored

SHARDS = 8
RANGE_ROWS = 50_000
LEAST_RANGES = 64
MAX_RANGES = 4_096
SAMPLES_PER_RANGE = 32
ROUNDS = 6
WHOLE_SHARE = 0.005
CELL_SHIFT = 52
LOW, HIGH = -(2**63), 2**63 - 1
SEED = 11

Splitter = tuple[int, int]


def _sample(rows: DataFrame, expected: float, total: int) -> list[tuple[int, int, float]]:
    """About ``expected`` keys (h, d), drawn with probability in proportion to size, and the bytes each stands for."""
    chance = F.least(F.lit(1.0), F.col("size") * (expected / max(total, 1)))
    uniform = F.pmod(F.xxhash64(F.lit(SEED), "h", "d", "size"), F.lit(2**52)) / float(2**52)
    drawn = rows.withColumn("_chance", chance).where(uniform < F.col("_chance"))
    found = drawn.select("h", "d", (F.col("size") / F.col("_chance")).alias("stands")).limit(int(4 * expected) + 100).collect()
    return sorted((r.h, r.d, r.stands) for r in found)


def _quantiles(sample: list[tuple[int, int, float]], pieces: int) -> list[Splitter]:
    """Keys that cut the sampled bytes into ``pieces`` about equal parts."""
    total, reached, out = sum(s for _, _, s in sample), 0.0, []
    for h, d, stands in sample:
        if len(out) + 1 < pieces and reached + stands > (len(out) + 1) * total / pieces:
            out.append((h, d))
        reached += stands
    return out


def _rounded(splitters: list[Splitter]) -> list[Splitter]:
    """Splitters at the first row of their text, unless several fall into one text: that one is cut inside."""
    hashes = [h for h, _ in splitters]
    out = set()
    for h, d in splitters:
        out.add((h, LOW))
        if hashes.count(h) > 1:
            out |= {(h, d), (h + 1, LOW) if h < HIGH else (h, d)}
    return sorted(out)


def _ranges(rows: DataFrame, splitters: list[Splitter], before: dict[int, tuple[int, int]] | None = None) -> DataFrame:
    """``rows`` with their range, by a broadcast of at most a row per range and cell of the hash."""
    bounds = [(LOW, LOW), *splitters, None]
    table = []
    for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
        last = high[0] if high else HIGH
        inside = bool(i) and high is not None and low[0] == high[0]
        inside |= low[1] != LOW or (high is not None and high[1] != LOW)
        for cell in range(low[0] >> CELL_SHIFT, (last >> CELL_SHIFT) + 1):
            offsets = before[i] if before else (0, 0)
            table.append((cell, i, low[0], low[1], last, high[1] if high else HIGH, high is None, inside, *offsets))
    ranges = rows.sparkSession.createDataFrame(
        table,
        "cell long, range int, low_h long, low_d long, high_h long, high_d long, open boolean, cut boolean, rows_before long, bytes_before long",
    )
    fits = F.expr(
        "(h > low_h or (h = low_h and d >= low_d)) and (open or h < high_h or (h = high_h and d < high_d))"
    )
    keyed = rows.withColumn("cell", F.shiftright("h", CELL_SHIFT))
    return keyed.join(F.broadcast(ranges), (keyed.cell == ranges.cell) & fits).drop(
        "cell", "low_h", "low_d", "high_h", "high_d", "open"
    )


def shard(docs: DataFrame, shards: int = SHARDS, text: str = "text", key: str = "doc_id", range_rows: int = RANGE_ROWS) -> DataFrame:
    """Per row: key, size (UTF-8 bytes plus 1), text_crc32, shard (0 to shards-1), slot (gapless from 0 in its shard).

    Shard sizes in bytes differ by less than the largest document plus ``WHOLE_SHARE`` of a shard. Copies of a text share a
    shard unless together they exceed that share or a shard ends among them. Null texts have size 1 and
    the checksum of no bytes and count as copies of each other; repeated rows are placed one by one;
    a null key sorts first; other columns are ignored; an empty input gives no rows.
    """
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    base = stored(
        docs.select(
            F.col(key).alias("key"), (F.octet_length(raw) + F.lit(1)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
            F.xxhash64(raw).alias("h"), F.xxhash64(key).alias("d"), F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    n, total = base.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    wanted = max(LEAST_RANGES, min(MAX_RANGES // 4, n // range_rows))
    splitters = _rounded(_quantiles(_sample(base, wanted * SAMPLES_PER_RANGE, total), wanted))
    for _ in range(ROUNDS):
        totals = {r.range: r for r in _ranges(base, splitters).groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()}
        full = sorted(r for r, t in totals.items() if t.n > 1 and t.bytes > 2 * total / wanted)
        if not full or len(splitters) > MAX_RANGES // 2:
            break
        # Overfull ranges get splitters of their own from a denser sample.
        held = sum(totals[r].bytes for r in full)
        pieces = {r: int(2 * totals[r].bytes * wanted / total) + 1 for r in full}
        bounds = [(LOW, LOW), *splitters, (HIGH, HIGH)]
        drawn = _sample(_ranges(base, splitters).where(F.col("range").isin(full)), 4 * SAMPLES_PER_RANGE * sum(pieces.values()), held)
        more = []
        for r in full:
            more += _quantiles([s for s in drawn if bounds[r] <= s[:2] < bounds[r + 1]], pieces[r])
        after = sorted({*splitters, *_rounded(more)})
        if after == splitters:
            break
        splitters = after
    else:
        totals = {r.range: r for r in _ranges(base, splitters).groupBy("range").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()}
    before, rows, held = {}, 0, 0
    for i in range(len(splitters) + 1):
        before[i] = (rows, held)
        rows, held = rows + (totals[i].n if i in totals else 0), held + (totals[i].bytes if i in totals else 0)
    place = Window.partitionBy("range").orderBy("h", "d", "key", "row")
    earlier = place.rowsBetween(Window.unboundedPreceding, -1)
    copies = Window.partitionBy("range", "h")
    placed = (
        _ranges(base, splitters, before)
        .withColumn("rank", F.col("rows_before") + F.row_number().over(place) - 1)
        .withColumn("start", F.col("bytes_before") + F.coalesce(F.sum("size").over(earlier), F.lit(0)))
        .withColumn("together", ~F.col("cut") & (F.sum("size").over(copies) <= WHOLE_SHARE * total / shards))
        .withColumn("start", F.when(F.col("together"), F.min("start").over(copies)).otherwise(F.col("start")))
        .withColumn("shard", F.expr(f"cast(start * {shards} div {max(total, 1)} as int)"))
    )
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )
