"""Document fingerprints by winnowing.

A text becomes tokens, every ``K`` consecutive tokens a hash; of each window of ``W`` hashes the least is chosen,
the rightmost of equals, with its position. Two texts that share ``K + W - 1`` tokens in a row therefore share a
chosen hash. Hashes and minima of spans are built from those of half the length, so a text costs a few passes over
its tokens whatever ``K`` and ``W`` are. Spark's own functions only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import join_small, stored

K = 5
W = 8
ROWS_PER_RANGE = 512
MOST_RANGES = 65_536
SAMPLES_PER_RANGE = 32
STEP = 256  # splitters compared at a time
SALTS = 65_536

# The white space of the word rule, and letters of scripts written without spaces, each a token of its own.
SPACE = r"[ \t-\r]+"
UNSPACED = r"[\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{A4CF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"

LAST = 2**31 - 1  # no array is longer
HIGH_BITS = -(2**32)


def tokens(text: Column) -> Column:
    """Words between white space; letters of scripts without spaces one by one. A null text has none."""
    whole = F.coalesce(text, F.lit(""))
    cut = F.rlike(whole, F.lit(UNSPACED))
    parts = F.when(cut, F.split(whole, f"{SPACE}|(?={UNSPACED})|(?<={UNSPACED})")).otherwise(F.split(whole, SPACE))
    return F.filter(parts, lambda t: t != "")


def _spans(df: DataFrame, column: str, length: int, join) -> DataFrame:
    """``df`` with ``column``, an array, replaced by ``join`` over every ``length`` neighbours, those at the end cut short.

    ``join`` takes two neighbouring spans; null stands for an empty one.
    """

    def beside(left: str, right: str, shift: int) -> Column:
        moved = F.slice(right, F.lit(shift + 1), F.greatest(F.size(right), F.lit(1)))
        return F.when(F.size(left) == 0, F.col(left)).otherwise(F.zip_with(left, moved, join))

    reached, width, out = 0, 1, df.withColumn("_pow", F.col(column))
    while True:
        if length & width:
            if not reached:
                out = out.withColumn("_acc", F.col("_pow"))
            else:
                out = out.withColumn("_acc", beside("_acc", "_pow", reached))
            reached |= width
        if reached == length:
            return out.withColumn(column, F.col("_acc")).drop("_acc", "_pow")
        out = out.withColumn("_pow", beside("_pow", "_pow", width))
        width *= 2


def with_fingerprint(df: DataFrame, text: str, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with ``name``: array<struct<hash long, at int>>, the chosen hashes by position (first token of the gram, from 0).

    Texts of fewer than ``k`` tokens have one gram, those of fewer than ``w`` grams one window; without tokens there is none.
    Equal texts have equal fingerprints.
    """
    df = df.withColumn("_g", F.transform(tokens(F.col(text)), lambda t: F.xxhash64(t)))
    df = _spans(df.withColumn("_n", F.size("_g")), "_g", k, lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_g", F.slice("_g", F.lit(1), F.greatest(F.col("_n") - (k - 1), F.lit(1))))
    # The upper half of a hash orders the grams, the position behind it makes the rightmost of equals the least.
    ranked = F.transform("_g", lambda g, i: g.bitwiseAND(F.lit(HIGH_BITS)) + (F.lit(LAST) - i))
    df = _spans(df.withColumn("_m", ranked), "_m", w, lambda a, b: F.least(a, b))
    windows = F.slice("_m", F.lit(1), F.greatest(F.size("_g") - (w - 1), F.lit(1)))
    places = F.transform(F.array_distinct(windows), lambda m: (F.lit(LAST) - m.bitwiseAND(F.lit(2**32 - 1))).cast("int"))
    df = df.withColumn("_m", places)
    chosen = F.transform("_m", lambda at: F.struct(F.get("_g", at).alias("hash"), at.alias("at")))
    return df.withColumn(name, chosen).drop("_g", "_m", "_n")


def listed(fingerprint: Column) -> Column:
    """hash:position of each choice, the hash as 16 lowercase hex digits, comma-joined."""
    return F.array_join(
        F.transform(fingerprint, lambda c: F.concat(F.lower(F.lpad(F.hex(c["hash"]), 16, "0")), F.lit(":"), c["at"].cast("string"))), ","
    )


def likeness(a: Column, b: Column) -> Column:
    """Distinct hashes in both over those in either; 1 for two empty fingerprints."""
    x, y = F.transform(a, lambda c: c["hash"]), F.transform(b, lambda c: c["hash"])
    either = F.size(F.array_union(x, y))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / either)


def _ranges_before(order: Column, splitters: list) -> Column:
    """How many of the sorted ``splitters`` are at most ``order``; compared in two steps."""
    if not splitters:
        return F.lit(0)
    steps = [[(s.key, s.h, s.salt) for s in splitters[i : i + STEP]] for i in range(0, len(splitters), STEP)]
    order_type = "struct<key:long,h:long,salt:long>"
    table = F.from_json(F.lit(json.dumps([[dict(zip(("key", "h", "salt"), s)) for s in step] for step in steps])), f"array<array<{order_type}>>")
    firsts = F.transform(table, lambda s: s[0])
    step = F.size(F.filter(firsts, lambda s: s <= order))
    inside = F.size(F.filter(F.get(table, step - 1), lambda s: s <= order))
    return F.when(step == 0, F.lit(0)).otherwise((step - 1) * STEP + inside)


def with_next(docs: DataFrame, key: str, text: str, prepare, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """key, text, and, of the row that follows by ascending ``key`` (after the last: the first), its columns as ``next``.

    ``prepare`` adds columns to (key, text) first. Rows of equal keys follow each other by a hash of the text; null keys
    come first. The rows are dealt over ranges of the order by sampled splitters, in one shuffle; equal rows are spread by a salt.
    Each range also gets the first row of the next one, so a range is all that a task needs. Keys are integers.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).select(
        "key", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).alias("salt"), "text",
    )
    small = stored(rows.select("key", "h", "salt"), "order")
    n = small.count()
    ranges = max(1, min(MOST_RANGES, n // rows_per_range))
    share = min(1.0, SAMPLES_PER_RANGE * ranges / max(n, 1))
    drawn = small.where(F.pmod(F.xxhash64(F.lit(7), "key", "h", "salt"), F.lit(2**40)) < int(share * 2**40))
    # About 32 rows for each of at most 65,536 ranges.
    sample = sorted(drawn.collect(), key=lambda r: (r.key is not None, r.key or 0, r.h, r.salt)) if ranges > 1 else []
    splitters = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    splitters = [s for i, s in enumerate(splitters) if i == 0 or s != splitters[i - 1]]
    order = F.struct("key", "h", "salt")
    number = _ranges_before(order, splitters)

    # A row per range: the first of each also ends the range before it, and the very first the last.
    heads = small.withColumn("range", number).groupBy("range").agg(F.min(F.struct("key", "h")).alias("head")).orderBy("range").collect()
    guests = [(heads[i - 1].range, h.head.key, h.head.h) for i, h in enumerate(heads)]
    wanted = docs.sparkSession.createDataFrame(guests, "range int, key long, h long")
    ends = join_small(rows.drop("salt"), wanted.select("key", "h").distinct().withColumn("_head", F.lit(True)), ["key", "h"])
    ends = ends.dropDuplicates(["key", "h"]).drop("_head")
    ends = join_small(wanted, ends, ["key", "h"]).select("range", F.lit(1).alias("guest"), "key", "h", F.lit(0).cast("long").alias("salt"), "text")
    dealt = rows.select(number.alias("range"), F.lit(0).alias("guest"), "key", "h", "salt", "text").unionByName(ends)
    ready = prepare(dealt.repartition("range"))
    along = Window.partitionBy("range").orderBy("guest", "key", "h", "salt")
    others = [c for c in ready.columns if c not in ("range", "guest", "h", "salt")]
    following = ready.withColumn("next", F.lead(F.struct(*others)).over(along))
    return following.where("guest = 0").select(*others, "next")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, w: int = W, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Per row: ``key``, ``text``, n_chars (code points), fingerprint, edited, edited_fingerprint, near_edited, near_next.

    ``edited`` is the text whose last floor(n_chars / 2) code points are replaced by the first as many (or all) of the next
    row's text. A null text is empty. Likeness is that of the chosen hashes (1 if neither text has any). Repeated rows are
    rows of their own, next to each other; ``key`` is an integer, nulls come first; other columns are ignored; an empty
    input gives no rows, a single row follows itself.
    """
    followed = with_next(docs, key, text, lambda rows: with_fingerprint(rows, "text", "fingerprint", k, w), rows_per_range)
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = followed.withColumn("n_chars", F.length(whole)).withColumn("half", F.expr("n_chars div 2").cast("int"))
    kept = F.substring(whole, F.lit(1), F.col("n_chars") - F.col("half"))
    taken = F.substring(F.coalesce(F.col("next.text"), F.lit("")), F.lit(1), F.col("half"))
    rows = with_fingerprint(rows.withColumn("edited", F.concat(kept, taken)), "edited", "edited_fingerprint", k, w)
    return rows.select(
        F.col("key").alias(key), F.col("text").alias(text), F.col("n_chars").cast("long").alias("n_chars"), "fingerprint", "edited", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next.fingerprint")).alias("near_next"),
    )
