"""Secret scans through a trigram inverted index.

From each rule's regular expression comes a Boolean query: sets of trigrams one of which any match must
contain whole. Postings of just those trigrams are collected per distinct text and intersected; the
candidates are verified with the expression. A rule without mandatory trigrams scans every text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import join_small, stored

MOST_STRINGS = 32
GRAMS_PER_MASK = 62
MARK = "[SECRET]"
CHUNK = 256  # matches that are folded before they join those before them


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` count if ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The base patterns and the published shapes of common credentials.
RULES = (
    Rule(
        "assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6, True
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

Alternatives = frozenset[frozenset[str]]


def grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _needs(strings: set[str]) -> Alternatives | None:
    """Any match contains one of ``strings``: their trigrams, without alternatives that ask for more than another."""
    sets = {grams(s) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _parts(tree) -> list[set[str] | None]:
    """The expression as a sequence of small sets of strings and, where anything may stand, None."""
    out: list[set[str] | None] = []
    for op, value in tree:
        name = str(op)
        if name == "LITERAL":
            out.append({chr(value).lower()})
        elif name == "IN":
            chars: set[str] = set()
            for kind, v in value:
                if str(kind) == "LITERAL":
                    chars.add(chr(v).lower())
                elif str(kind) == "RANGE" and v[1] - v[0] < MOST_STRINGS:
                    chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
                else:
                    chars |= {chr(c) for c in range(2 * MOST_STRINGS)}
            out.append(chars if len(chars) <= 4 else None)
        elif name == "SUBPATTERN":
            out += _parts(value[-1])
        elif name == "BRANCH":
            joined = [_joined(_parts(b)) for b in value[1]]
            whole = [j[0] for j in joined if len(j) == 1 and j[0] is not None]
            out.append(set().union(*whole) if len(whole) == len(joined) else None)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, body = value
            own = _joined(_parts(body))
            if (low, high) == (0, 1) and len(own) == 1 and own[0] is not None:
                out.append(own[0] | {""})
            else:
                out += _parts(body) * min(low, 3) + [None]
        elif name != "AT":
            out.append(None)
    return out


def _joined(parts: list[set[str] | None]) -> list[set[str] | None]:
    """Neighbouring sets multiplied out, as long as they stay small."""
    out: list[set[str] | None] = []
    for p in parts:
        if p is not None and out and out[-1] is not None and len(out[-1]) * len(p) <= MOST_STRINGS:
            out[-1] = {a + b for a in out[-1] for b in p}
        else:
            out.append(p)
    return out


def trigram_query(pattern: str) -> list[Alternatives]:
    """A conjunction of alternatives of trigram sets, in lower case; empty if nothing is mandatory."""
    parsed = re._parser.parse(pattern)
    found = [_needs(p) for p in _joined(_parts(parsed)) if p is not None]
    return [f for f in found if f]


def postings(docs: DataFrame, wanted: list[str], text: str = "text") -> DataFrame:
    """The inverted index: (gram, text_key) for the ``wanted`` trigrams; copies of a text have one key."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    held = F.filter(F.array(*[F.lit(g) for g in wanted]), lambda g: F.contains(F.col("low"), g))
    return (
        docs.select(F.xxhash64(text).alias("text_key"), low.alias("low"))
        .select("text_key", F.explode(held).alias("gram"))
    )


def candidates(index: DataFrame, queries: dict[str, list[Alternatives]], wanted: list[str]) -> DataFrame:
    """(text_key, kinds): the rules whose Boolean query the postings of a text satisfy."""
    number = {g: i for i, g in enumerate(wanted)}

    def bits(some, word: int) -> int:
        return sum(1 << (number[g] % GRAMS_PER_MASK) for g in some if number[g] // GRAMS_PER_MASK == word)

    words = range(-(-len(wanted) // GRAMS_PER_MASK))
    bit = F.create_map(*[F.lit(x) for g, i in number.items() for x in (g, 1 << (i % GRAMS_PER_MASK))])
    word = F.create_map(*[F.lit(x) for g, i in number.items() for x in (g, i // GRAMS_PER_MASK)])
    masks = index.groupBy("text_key").agg(
        *[F.bit_or(F.when(word[F.col("gram")] == w, bit[F.col("gram")].cast("long")).otherwise(F.lit(0))).alias(f"m{w}") for w in words]
    )

    def holds(query: list[Alternatives]) -> Column:
        out = F.lit(True)
        for alternatives in query:
            some = F.lit(False)
            for needed in sorted(map(sorted, alternatives)):
                own = F.lit(True)
                for w in words:
                    mask = F.lit(bits(needed, w)).cast("long")
                    own = own & (F.col(f"m{w}").bitwiseAND(mask) == mask)
                some = some | own
            out = out & some
        return out

    kinds = F.array_compact(F.array(*[F.when(holds(q), F.lit(k)) for k, q in queries.items()]))
    return masks.select("text_key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _in_chunks(items: Column, start: Column, step, joined) -> Column:
    """``aggregate`` that copies what it has built once per ``CHUNK`` items instead of once per item.

    State is a struct of ``at`` and ``out``; ``joined`` puts an ``out`` behind another.
    """

    def whole(state: Column, chunk: Column) -> Column:
        part = F.aggregate(chunk, F.struct(state["at"].alias("at"), start["out"].alias("out")), step)
        return F.struct(part["at"].alias("at"), joined(state["out"], part["out"]).alias("out"))

    def folded(held: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(held) - 1) / CHUNK).cast("int"))
        chunks = F.when(F.size(held) > 0, F.transform(starts, lambda c: F.slice(held, c * CHUNK + 1, F.lit(CHUNK))))
        return F.coalesce(F.aggregate(chunks, start, whole), start)

    # As an argument, so that the items are worked out once.
    return F.transform(F.array(items), folded)[0]


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """array<struct<start,order,end>> of the rule's matches in code points, from the pieces between them."""
    pieces = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    zipped = F.arrays_zip(pieces.alias("p"), matches.alias("m"), measured.alias("v"))
    empty = F.from_json(F.lit('{"at":0,"out":[]}'), "at int, out array<struct<start:int,order:int,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["p"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end")))
        keep = x["m"].isNotNull() & (F.length(x["v"]) >= rule.least)
        return F.struct(end.alias("at"), F.when(keep, F.concat(state["out"], found)).otherwise(state["out"]).alias("out"))

    return _in_chunks(zipped, empty, step, F.concat)["out"]


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with ``secrets``, array<struct<start,order,end>>: spans by start, then rule order, end exclusive.

    Positions are code points of the whole text; a null text has none. Repeated rows are scanned alike;
    a column of ``docs`` named ``secrets`` is replaced. Runs in Spark's own functions only.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q}
    wanted = sorted({g for q in indexed.values() for alternatives in q for s in alternatives for g in s})
    rows = docs.drop("secrets").withColumn("_text_key", F.xxhash64(text))
    if indexed:
        found = stored(candidates(postings(docs, wanted, text), indexed, wanted), "candidates")
        rows = join_small(rows, found.withColumnsRenamed({"text_key": "_text_key", "kinds": "_kinds"}), ["_text_key"], "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    none = F.from_json(F.lit("[]"), "array<struct<start:int,order:int,end:int>>")
    found = []
    for i, rule in enumerate(rules):
        if rule.kind in indexed:
            ask = F.coalesce(F.array_contains("_kinds", rule.kind), F.lit(False)) & F.rlike(whole, F.lit(rule.pattern))
        else:
            ask = F.rlike(whole, F.lit(rule.pattern))
        found.append(F.when(ask, _spans(rule, i, whole)).otherwise(none))
    return rows.withColumn("secrets", F.array_sort(F.concat(*found))).select(*[c for c in docs.columns if c != "secrets"], "secrets")


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every stretch covered by spans replaced by ``mark``; null stays null."""
    start = F.from_json(F.lit('{"at":0,"out":""}'), "at int, out string")

    def step(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        between = F.concat(state["out"], F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(apart, between).otherwise(state["out"]).alias("out")
        )

    built = _in_chunks(spans, start, step, F.concat)
    joined = F.concat(built["out"], F.substr(text, built["at"] + 1))
    return F.when(F.size(spans) == 0, text).otherwise(joined)
