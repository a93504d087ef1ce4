"""Vector codes, Merkle manifest and fingerprints against brute force, on the given tables and on awkward rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerline.llm import codebooks, manifest, queries, winnowing

NAN = float("nan")


def _count(rows):
    return collections.Counter(map(tuple, rows))


# Vector codes.

def _integer(x):
    return max(-(2**53), min(2**53, math.floor(x * 1024))) if abs(x) < 2.0**60 else int(math.copysign(2**53, x))


def _compressed(rows, entries=256, rounds=4):
    """(id, code, error, label_error, sha256) of (id, vector, label) rows."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for dims in {len(r[1]) for r in kept}:
        own = [r for r in kept if len(r[1]) == dims]
        places = -(-dims // 4)
        x = np.array([[_integer(v) for v in r[1]] + [0] * (4 * places - dims) for r in own], object).reshape(len(own), 4, places)
        first = sorted(range(len(own)), key=lambda i: (own[i][0] is None, own[i][0] or 0, own[i][1]))[:entries]
        books = [[x[i, p] for i in first] for p in range(4)]

        def nearest(p):
            distances = [[int(((e - v) ** 2).sum()) for e in books[p]] for v in x[:, p]]
            return [min((d, j) for j, d in enumerate(ds)) for ds in distances]

        for _ in range(rounds):
            for p in range(4):
                codes = [j for _, j in nearest(p)]
                for j in set(codes):
                    mine = [x[i, p] for i, c in enumerate(codes) if c == j]
                    books[p][j] = np.array([sum(c) // len(mine) for c in zip(*mine)], object)
        sha = hashlib.sha256(",".join(str(int(v)) for part in books for e in part for v in e).encode()).hexdigest()
        final = [nearest(p) for p in range(4)]
        for i, r in enumerate(own):
            code = "".join(f"{f[i][1]:02x}" for f in final)
            out.append((r[0], r[2], code, min(sum(f[i][0] for f in final), 2**63 - 1), sha))
    labels = collections.Counter()
    for o in out:
        labels[o[1]] += o[3]
    return collections.Counter((o[0], o[2], o[3], min(labels[o[1]], 2**63 - 1), o[4]) for o in out)


VECTORS = "vec_id long, embedding array<double>, label int, key string, vector double, bounds0 int, dims int"


def _odd_vectors():
    rng = random.Random(3)
    rows = [
        (1, [0.1] * 8, 1), (1, [0.1] * 8, 1), (2, None, 1), (3, [None] * 8, 1), (4, [NAN] * 8, None), (5, [0.5] * 8, None),
        (None, [0.25] * 8, None), (6, [], 2), (7, [1.0, 2.0, 3.0], 2), (11, [math.inf] * 8, 2), (None, None, None),
    ]
    return rows + [(20 + i, [rng.choice([0.0, 0.5, 1.0, -1.0]) for _ in range(8)], 5) for i in range(60)]


@pytest.mark.parametrize("huge", [[], [(8, [1e300] * 8, 3), (9, [-1e300] * 8, 3), (10, [1e9] * 8, 4)]])
@pytest.mark.parametrize("options", [{}, {"entries": 5, "bounds": 2}, {"entries": 7, "bounds": 1}])
def test_codes(spark, huge, options):
    rows = _odd_vectors() + huge
    frame = spark.createDataFrame([(*r, "clash", 0.5, 1, 1) for r in rows], VECTORS).repartition(3)
    got = _count(codebooks.coded(*codebooks.compress(frame, **options)).collect())
    assert got == _compressed(rows, options.get("entries", 256))


def test_codes_of_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    want = _compressed([(r.vec_id, list(r.embedding), r.label) for r in rows])
    assert _count(queries.QUERIES["op11_vector_code_compression"](spark, sf_dir).collect()) == want


def test_codes_of_nothing(spark):
    state, books = codebooks.compress(spark.createDataFrame([], VECTORS))
    assert codebooks.coded(state, books).count() == 0 and books.entries == {}


def test_bounds_spare_distances():
    """On clustered parts most rows are certain, few need a whole search, and every answer stays exact."""
    rng = np.random.default_rng(1)
    x = (rng.integers(-900, 900, (64, 16))[rng.integers(0, 64, 4_000)] + rng.integers(-9, 9, (4_000, 16))).astype(np.int64)
    entries = x[rng.permutation(4_000)[:256]]
    bounds = codebooks.Bounds.of_all(x, entries, 8)
    moved = entries + rng.integers(-2, 3, entries.shape)
    bounds = codebooks.Bounds.unpacked(bounds.packed(8), 256)
    bounds.moved(np.sqrt(((moved - entries) ** 2).sum(1).astype(float)) * (1 + codebooks.SLACK))
    squared, needed = bounds.verified(x, moved)
    distances = ((x[:, None] - moved[None]) ** 2).sum(2)
    assert (bounds.own == distances.argmin(1)).all() and (squared == distances.min(1)).all()
    assert (np.diff(bounds.low, axis=1) >= 0).all() and (bounds.low <= bounds.outer[:, None]).all()
    rest = np.sort(np.where(np.eye(256, dtype=bool)[bounds.own], np.inf, np.sqrt(distances)), axis=1)
    assert (bounds.low <= rest[:, :8] + 1e-9).all() and (needed == 256).mean() < 0.5 and (needed < 256).any()


# Merkle manifest.

def _hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _levels(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([_hashed(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def _path(levels, i):
    out = []
    for level in levels[:-1]:
        low = i // 16 * 16
        out.append((level[low:i], level[i + 1 : low + 16]))
        i //= 16
    return out


def _proven(rows):
    """The contract's columns for (doc_id, text, lang, source, n_chars) rows."""
    lower = {c: c + 32 for c in range(65, 91)}

    def leaf(r, text):
        return _hashed(*map(_written, (r[0], r[3], r[2], r[4], text)))

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[3]].append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in order:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, _levels([leaf(r, r[1]) for r in own])))
    top = _levels([levels[-1][0] for _, levels in trees]) if trees else []
    out = []
    for g, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            path = _path(levels, i) + _path(top, g)
            claimed = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, r[1].translate(lower) if claimed else r[1])
            for before, after in path:
                folded = _hashed(*before, folded, *after)
            siblings = [h for before, after in path for h in before + after]
            root = top[-1][0]
            out.append((r[0], levels[0][i], levels[-1][0], root, _hashed(*siblings), folded, folded == root))
    return collections.Counter(out)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, tree int, node int, weight int"
ODD = [
    (1, "A", None, "b", 1), (1, "A", None, "b", 1), (None, None, None, None, None), (2, "Ab É 漢", "x", None, 3), (5, "", "en", "", 0),
    (6, "LONG " * 20_000, "en", "ä", None), (None, "No id", "en", "b", 4),
]
MANY_GROUPS = [(i, f"T{i}", "l", f"s{i % 40}", 5) for i in range(700)]
LONE_LEAVES = [(i, f"T{i}", "l", f"s{i}", 5) for i in range(40)]
HOT_GROUP = [(i % 7, "same", "l", "s", 5) for i in range(300)] + [(i, "T", "l", "t", 5) for i in range(17)]


@pytest.mark.parametrize("rows", [[], ODD[2:3], ODD, LONE_LEAVES, HOT_GROUP])
def test_manifest(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", 1, 1, 1) for r in rows], DOCS).repartition(3)
    assert _count(manifest.manifest(frame).collect()) == _proven(rows)


def test_manifest_of_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()
    assert _count(queries.QUERIES["op12_merkle_manifest"](spark, sf_dir).collect()) == _proven([tuple(r) for r in rows])


def test_manifest_with_few_climbers_per_copy(spark, monkeypatch):
    """Node rows in several copies, as for very many leaves; and the session's row limit is left as it was."""
    monkeypatch.setattr(manifest, "CLIMBERS", 2)
    monkeypatch.setattr(manifest, "CLIMB", manifest.CLIMB.replace("4096", "2"))
    limit = spark.conf.get("spark.sql.cteRecursionRowLimit")
    frame = spark.createDataFrame([(*r, "clash", 1, 1, 1) for r in MANY_GROUPS], DOCS)
    assert _count(manifest.manifest(frame).collect()) == _proven(MANY_GROUPS)
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == limit


# Fingerprints.

ALONE = "฀-໿က-႟ក-៿⺀-꓏豈-﫿\U00020000-\U0003ffff"
TOKEN = re.compile(f"[{ALONE}]|[^ \t-\r{ALONE}]+")


def _signed(h):
    return h - 2**64 if h >= 2**63 else h


def _xxhash(text):
    return _signed(xxhash.xxh64_intdigest(text.encode(), 42))


def _joined(a, b):
    h = 42
    for v in (a, b):
        if v is not None:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
    return _signed(h)


def _gram(values, at, length):
    """The hash of ``length`` values, from those of its parts of 1, 2, 4, ... values."""

    def part(i, width):
        if i >= len(values):
            return None
        return values[i] if width == 1 else _joined(part(i, width // 2), part(i + width // 2, width // 2))

    out, width = None, 1
    while width <= length:
        if length & width:
            out, at = (part(at, width) if out is None else _joined(out, part(at, width))), at + width
        width *= 2
    return out


def _winnowed(text, k, w):
    hashes = [_xxhash(t) for t in TOKEN.findall(text)]
    grams = [_gram(hashes, i, k) for i in range(max(len(hashes) - k + 1, min(len(hashes), 1)))]
    chosen = []
    for i in range(max(len(grams) - w + 1, min(len(grams), 1))):
        least = min(range(i, min(i + w, len(grams))), key=lambda j: (grams[j] >> 32, -j))
        if least not in chosen:
            chosen.append(least)
    return [(grams[j], j) for j in chosen]


def _like(a, b):
    x, y = {h for h, _ in a}, {h for h, _ in b}
    return round(len(x & y) / len(x | y), 9) if x | y else 1.0


def _fingerprinted(rows, k=5, w=8):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, _xxhash(r[1] or "")))
    out = []
    for i, (doc_id, text) in enumerate(order):
        own, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + following[:half]
        prints = [_winnowed(t, k, w) for t in (own, edited, following)]
        listed = [",".join(f"{h & 2**64 - 1:016x}:{at}" for h, at in p) for p in prints]
        out.append((doc_id, len(own), listed[0], edited, listed[1], _like(prints[0], prints[1]), _like(prints[0], prints[2])))
    return _count(out)


def _rows_of(found):
    return _count(
        found.select(
            "doc_id", "n_chars", winnowing.listed(F.col("fingerprint")), "edited", winnowing.listed(F.col("edited_fingerprint")),
            F.round("near_edited", 9), F.round("near_next", 9),
        ).collect()
    )


ODD_TEXTS = [
    (1, "alpha beta"), (2, None), (2, None), (None, "x " * 50), (3, "漢字かな交じり文を書く test 漢字かな交じり文"), (4, ""), (5, " \t\n"),
    (6, "a b c d e f g h i j k l m n"), (6, "a b c d e f g h i j k l m n"), (6, "o p q"), (7, "\U0001f600 z" * 9), (8, "word " * 5_000), (None, None),
]
TEXTS = "doc_id long, text string, key string, h long, range int, next int, guest int, fingerprint int"


@pytest.mark.parametrize(
    "rows, options",
    [([], {}), (ODD_TEXTS[1:2], {}), (ODD_TEXTS, {}), (ODD_TEXTS, {"rows_per_range": 3}), (ODD_TEXTS[:9] * 20, {"rows_per_range": 5, "k": 3, "w": 5})],
)
def test_fingerprints(spark, rows, options):
    frame = spark.createDataFrame([(*r, "clash", 1, 1, 1, 1, 1) for r in rows], TEXTS).repartition(3)
    got = _rows_of(winnowing.fingerprints(frame, **options))
    assert got == _fingerprinted(rows, options.get("k", 5), options.get("w", 8))


@pytest.mark.parametrize("options", [{}, {"rows_per_range": 30}])
def test_fingerprints_of_table(spark, sf_dir, options):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = _fingerprinted([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert _rows_of(winnowing.fingerprints(docs, **options)) == want


def test_many_splitters(spark, monkeypatch):
    """Splitters compared in two steps."""
    monkeypatch.setattr(winnowing, "STEP", 4)
    rows = [(i % 90, f"text {i % 45} a b c") for i in range(300)]
    got = _rows_of(winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), rows_per_range=6))
    assert got == _fingerprinted(rows)


def test_shared_run_shares_a_choice(spark):
    """Twelve tokens in a row that two texts share give a common chosen hash, wherever they stand."""
    rng = random.Random(5)
    rows = []
    for i in range(100):
        run = " ".join(f"r{rng.randrange(10**6)}" for _ in range(12))
        sides = [" ".join(f"s{rng.randrange(10**6)}" for _ in range(rng.randrange(40))) for _ in range(4)]
        rows.append((i, f"{sides[0]} {run} {sides[1]}", f"{sides[2]} {run} {sides[3]}"))
    frame = spark.createDataFrame(rows, "id long, a string, b string")
    for c in ("a", "b"):
        frame = winnowing.with_fingerprint(frame, c, f"print_{c}")
    assert frame.where(winnowing.likeness(F.col("print_a"), F.col("print_b")) > 0).count() == len(rows)


def test_fingerprint_plan_is_native(spark, sf_dir):
    plan = queries.QUERIES["op13_winnowing"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
