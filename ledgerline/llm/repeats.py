"""Substring dedup: every fixed-length word window is hashed (Rabin-Karp) and counted in Spark.

Documents are dealt into blocks. A block sends its distinct window hashes, cut by hash range, to the
range's owner, which answers with one bit per hash: seen in another block or more than once here.
The block then recomputes its windows, reads the bits, merges repeated windows into maximal intervals
and removes them. Text moves once, hashes once, and the answers are an eighth of a byte per hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import text_bytes, window_hashes, word_bounds, word_hashes

WINDOW = 35
BLOCK_BYTES = 8 << 20
RANGE_HASHES = 1 << 20
SEED = 7


def _windows(column, size: int):
    data, offsets = text_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    hashes, at = window_hashes(word_hashes(data, starts, ends, SEED), first, size, SEED)
    return data, starts, ends, first, hashes, at


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range numbers 0..ranges-1, rising with the hash (``ranges`` below 2**31)."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _transposed(hashes: np.ndarray) -> bytes:
    """Sorted hashes byte plane by byte plane, so that the shuffle's compression sees the order."""
    return np.ascontiguousarray(hashes.view(np.uint8).reshape(-1, 8).T).tobytes()


def _restored(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def covered_words(n_words: int, at: np.ndarray, size: int) -> np.ndarray:
    """True for words inside a window that starts at one of ``at``: the union of the intervals."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + size, -1)
    return np.cumsum(step[:-1]) > 0


def remove_repeats(
    docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
    range_hashes: int = RANGE_HASHES,
) -> DataFrame:
    """Per row: its key, n_words, n_removed, kept_text and kept_sha256.

    A word goes if it lies in a window of ``window`` consecutive words of one row whose word sequence
    also starts anywhere else in the input, the same row included. Windows are judged on the input.
    Words are ``[^\\x20\\x09-\\x0D]+``; kept words are joined by one space. Null and empty texts have no
    words. Repeated rows are judged like different rows, so all their windows repeat. Columns other
    than ``key`` and ``text`` are ignored, whatever their names; an empty input gives no rows.

    Sequences are compared by a 64-bit hash. ``block_bytes`` and ``range_hashes`` bound what a task
    holds and change no result; raise both together on very large inputs to keep messages few.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-n_bytes // block_bytes) or 1
    ranges = min(2**31 - 1, n_bytes // 6 // range_hashes + 1)
    docs = docs.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))

    def ask(table):
        import pyarrow as pa

        hashes = _windows(table.column("text"), window)[4]
        hashes, counts = np.unique(hashes, return_counts=True)
        owner = _range_of(hashes, ranges)
        cuts = np.flatnonzero(np.diff(owner, prepend=np.uint64(2**63))) if len(owner) else np.zeros(0, int)
        ends = np.append(cuts[1:], len(hashes)).astype(int)
        return pa.table(
            {
                "owner": pa.array(owner[cuts].astype(np.int64), pa.int64()),
                "asker": pa.array([table.column("block")[0].as_py()] * len(cuts), pa.int64()),
                "hashes": pa.array([_transposed(hashes[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
                "twice": pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in zip(cuts, ends)], pa.binary()),
            }
        )

    def answer(table):
        import pyarrow as pa

        parts = [_restored(x.as_py()) for x in table.column("hashes")]
        everything = np.concatenate(parts)
        order = np.argsort(everything, kind="stable")
        equal = everything[order[1:]] == everything[order[:-1]]
        shared = np.zeros(len(everything), bool)
        shared[order[1:][equal]] = True
        shared[order[:-1][equal]] = True
        ends = np.cumsum([len(p) for p in parts])
        twice = [
            np.packbits(np.unpackbits(np.frombuffer(t.as_py(), np.uint8), count=len(p)).astype(bool) | shared[end - len(p) : end]).tobytes()
            for t, p, end in zip(table.column("twice"), parts, ends)
        ]
        return pa.table(
            {"block": table.column("asker"), "owner": table.column("owner"), "n": pa.array(map(len, parts), pa.int64()), "twice": pa.array(twice, pa.binary())}
        )

    def remove(table, answers):
        import pyarrow as pa

        data, starts, ends, first, hashes, at = _windows(table.column("text"), window)
        distinct, place = np.unique(hashes, return_inverse=True)
        order = np.argsort(answers.column("owner").to_numpy()) if len(answers) else []
        bits = [
            np.unpackbits(np.frombuffer(answers.column("twice")[int(i)].as_py(), np.uint8), count=answers.column("n")[int(i)].as_py())
            for i in order
        ]
        repeated = np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)
        if len(repeated) != len(distinct):
            raise RuntimeError("a block was answered for other windows than it has")
        gone = covered_words(len(starts), at[repeated[place]], window)
        whole = data.tobytes()
        kept = []
        for i in range(len(first) - 1):
            words = np.arange(first[i], first[i + 1])[~gone[first[i] : first[i + 1]]]
            kept.append(b" ".join([whole[a:b] for a, b in zip(starts[words].tolist(), ends[words].tolist())]))
        return pa.table(
            {
                "key": table.column("key"),
                "n_words": pa.array(np.diff(first), pa.int64()),
                "n_removed": pa.array([int(gone[a:b].sum()) for a, b in zip(first[:-1], first[1:])], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                "kept_text": pa.array([k.decode() for k in kept], pa.string()),
            }
        )

    kind = docs.schema["key"].dataType.simpleString()
    asked = docs.groupBy("block").applyInArrow(ask, "owner long, asker long, hashes binary, twice binary")
    answers = asked.groupBy("owner").applyInArrow(answer, "block long, owner long, n long, twice binary")
    done = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        remove, f"key {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )
    return done.withColumnRenamed("key", key)
