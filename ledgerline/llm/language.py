"""Language ID: script ranges narrow the candidates, then Viterbi over per-word scores labels spans.

A word's score for a language is the log probability of its byte trigrams, counted in Spark over every
labelled training row. Scripts that a language practically never uses rule it out for a word, unless no
language uses any script of the text. Viterbi
with a penalty for each switch turns word scores into spans; the language of most letters wins.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import joined_words, slices, text_bytes, word_bounds

UNDETERMINED = "und"
BUCKETS = 1 << 16
SWITCH = 12.0
PIECE_BYTES = 2 << 20
SCRIPT_SHARE = 0.01
SMOOTHING = 0.5
RULED_OUT = np.float32(-60.0)
HELD_SCORES = 8_000_000
# Letters are those of Unicode's category L. Scripts by the first word of a letter's Unicode name (fixed values); letters of
# other names share the remaining bits, a name to a bit as long as there are enough.
SCRIPTS = (
    "LATIN", "GREEK", "CYRILLIC", "ARMENIAN", "HEBREW", "ARABIC", "DEVANAGARI", "BENGALI", "TAMIL", "THAI", "GEORGIAN", "KANA",
    "CJK", "HANGUL",
)
SAME_SCRIPT = {"HIRAGANA": "KANA", "KATAKANA": "KANA", "KATAKANA-HIRAGANA": "KANA", "IDEOGRAPHIC": "CJK"}
SCRIPT_BITS = 64
CODES = 0x32400  # no letters beyond


@dataclass
class LanguageModel:
    """Log probabilities (buckets x languages) and the bit mask of scripts of each language."""

    languages: list[str]
    scores: np.ndarray
    scripts: np.ndarray


def _script_table() -> np.ndarray:
    """One more than the script bit of every code point that is a letter, else 0."""
    import unicodedata

    table = np.zeros(CODES, np.uint8)
    bits = {name: bit for bit, name in enumerate(SCRIPTS)}
    for code in range(CODES):
        char = chr(code)
        if not unicodedata.category(char).startswith("L"):
            continue
        first, *rest = unicodedata.name(char, "CJK").split(" ")
        if first in ("FULLWIDTH", "HALFWIDTH"):
            first = rest[0]
        first = SAME_SCRIPT.get(first, first)
        others = SCRIPT_BITS - len(SCRIPTS)
        bit = bits.setdefault(first, len(SCRIPTS) + (len(bits) - len(SCRIPTS)) % others)
        table[code] = bit + 1
    return table


def _script_bits(script: np.ndarray) -> np.ndarray:
    """The mask of each script of ``_script_table``."""
    masks = np.concatenate([[0], np.uint64(1) << np.arange(SCRIPT_BITS, dtype=np.uint64)]).astype(np.uint64)
    return masks[script]


def _letter_scripts(c: np.ndarray, table: np.ndarray) -> np.ndarray:
    """By the first byte of every UTF-8 letter its value in ``table``; 0 at all other bytes."""
    out = np.where(c < 0x80, table[np.minimum(c, 0x7F)], 0).astype(np.uint8)
    for low, high, size in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0xF8, 4)):
        at = np.flatnonzero((c >= low) & (c < high))
        at = at[at + size <= len(c)]
        code = c[at] - np.uint32(low)
        for i in range(1, size):
            code = (code << np.uint32(6)) | (c[at + i] & np.uint32(0x3F))
        known = code < len(table)
        out[at[known]] = table[code[known]]
    return out


def _grams(column, table: np.ndarray):
    """Of a piece of texts: the words' bytes, where each word begins, each row's first word, the trigram
    bucket of every byte (a word's last is its closing space) and the script of every letter, 0 elsewhere."""
    import pyarrow as pa
    import pyarrow.compute as pc

    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.large_string())))
    starts, ends, first = word_bounds(data, offsets)
    joined, room = joined_words(data, starts, ends)
    c = joined.astype(np.uint32)
    b = np.concatenate([[32], c[:-1]]).astype(np.uint32)[: len(c)]
    a = np.concatenate([[32, 32], c[:-2]]).astype(np.uint32)[: len(c)]
    a[b == 32] = 32  # nothing of the word before
    code = (a << np.uint32(16)) | (b << np.uint32(8)) | c
    buckets = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return room, first, buckets, _letter_scripts(c, table)


def fit(docs: DataFrame, text: str = "text", label: str = "lang") -> LanguageModel:
    """Counts over every row of ``docs`` with a label; no other column is read.

    Of each language at most ``BUCKETS`` counts and its letters per script reach the driver.
    """
    table = _script_table()

    def count(batches):
        import pandas as pd

        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            row = 0
            for piece in slices(batch.column(0), PIECE_BYTES):
                room, first, buckets, script = _grams(piece, table)
                cuts = room[first]
                for i in np.flatnonzero(np.diff(cuts)):
                    own = totals.setdefault(labels[row + i], np.zeros(BUCKETS + SCRIPT_BITS, np.int64))
                    own[:BUCKETS] += np.bincount(buckets[cuts[i] : cuts[i + 1]], minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(script[cuts[i] : cuts[i + 1]], minlength=SCRIPT_BITS + 1)[1:]
                row += len(piece)
        for name, own in totals.items():
            place = np.flatnonzero(own)
            yield pd.DataFrame({"lang": name, "place": place, "n": own[place]})

    def counted(batches):
        import pyarrow as pa

        for frame in count(batches):
            yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    rows = (
        docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
        .select(F.col(text).alias("text"), F.col(label).alias("lang"))
        .mapInArrow(counted, "lang string, place long, n long")
        .groupBy("lang", "place")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS + SCRIPT_BITS, len(languages)))
    at = {name: i for i, name in enumerate(languages)}
    counts[rows["place"].to_numpy(int), rows["lang"].map(at).to_numpy(int)] = rows["n"]
    grams, letters = counts[:BUCKETS] + SMOOTHING, counts[BUCKETS:]
    usual = letters >= SCRIPT_SHARE * np.maximum(letters.sum(0), 1)
    masks = np.bitwise_or.reduce(np.where(usual, _script_bits(np.arange(1, SCRIPT_BITS + 1))[:, None], np.uint64(0)), axis=0)
    return LanguageModel(languages, np.log(grams / grams.sum(0)).astype(np.float32), masks)


def _word_scores(piece, model: LanguageModel, table: np.ndarray):
    """Each row's number of words; each word's scores, letters, and whether a language can be told from it.

    Where no word of a row is in a script of any language, all its words are scored against all languages.
    """
    room, first, buckets, script = _grams(piece, table)
    n = len(room) - 1
    scores = np.zeros((n, len(model.languages)), np.float32)
    if not n:
        return np.diff(first), scores, np.zeros(0, int), np.zeros(0, bool)
    begin = room[:-1]
    letters = np.add.reduceat((script > 0).astype(np.int64), begin)
    masks = np.bitwise_or.reduceat(_script_bits(script), begin)
    admitted = (masks[:, None] & model.scripts[None, :]) > 0
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    known = np.bincount(row[admitted.any(1)], minlength=len(first) - 1) > 0
    admitted[~known[row] & (letters > 0)] = True
    told = admitted.any(1)
    for i in range(len(model.languages)):
        scores[:, i] = np.add.reduceat(model.scores[buckets, i], begin)
    scores -= scores.max(1, keepdims=True)
    scores[~admitted] = RULED_OUT
    scores[~told] = 0.0
    return np.diff(first), scores, letters, told


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Best language of every word when each change of language costs ``switch``.

    ``counts`` are the words of each row; all rows advance together, one word at a time.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), "left")  # rows with more than t words
    value = np.zeros((len(sizes), scores.shape[1]), np.float32)
    moved = np.zeros(scores.shape, bool)
    source = np.zeros(len(scores), np.uint8 if scores.shape[1] < 256 else np.uint16)
    for t in range(steps):
        m = active[t]
        at = starts[:m] + t
        now = value[:m]
        if t:
            best = now.argmax(1)
            other = now[np.arange(m), best][:, None] - np.float32(switch)
            moved[at] = now < other
            source[at] = best
            now = np.maximum(now, other)
        value[:m] = now + scores[at]
    out = np.zeros(len(scores), source.dtype)
    state = value.argmax(1).astype(source.dtype)
    for t in range(steps - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        out[at] = state[:m]
        state[:m] = np.where(moved[at, state[:m]], source[at], state[:m])
    return out


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", switch: float = SWITCH, spans: bool = False) -> DataFrame:
    """``docs`` with lang_pred and score, and with ``spans`` an array of (first word, end word, language).

    The predicted language is that of most letters of the whole text (ties: the first by name); score is
    its share of all letters. A null text or one without letters is ``und`` with score 0; one
    only in scripts that no language uses is scored against all languages. Repeated rows are predicted alike. Predictions use the text only. Columns of ``docs``
    named like the new ones are replaced.
    """
    from pyspark.sql import types as T

    docs = docs.drop("lang_pred", "score", *(["spans"] if spans else []))
    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    added += [T.StructField("spans", T.ArrayType(span))] if spans else []
    schema = T.StructType([*docs.schema.fields, *added])
    if not model.languages:
        nothing = {"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)} | ({"spans": F.array().cast(T.ArrayType(span))} if spans else {})
        return docs.withColumns(nothing)
    table = _script_table()
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.scores, model.scripts))  # BUCKETS x languages

    def decode(parts, model):
        counts, scores, letters, told = (np.concatenate(x) for x in zip(*parts))
        first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        found = viterbi(scores, counts, switch)
        n = len(model.languages)
        row = np.repeat(np.arange(len(counts)), counts)
        votes = np.bincount(row[told] * n + found[told], letters[told], len(counts) * n).reshape(-1, n)
        total = np.maximum(np.bincount(row, letters, len(counts)), 1)
        best = votes.argmax(1)
        top = votes[np.arange(len(votes)), best]
        names = [model.languages[b] if v > 0 else UNDETERMINED for b, v in zip(best, top)]
        listed = []
        for i in range(len(counts) if spans else 0):
            own = found[first[i] : first[i + 1]]
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)] if len(own) else [0]
            listed.append([{"first": a, "end": b, "lang": model.languages[own[a]]} for a, b in zip(cuts, cuts[1:])])
        return names, (top / total).tolist(), listed

    def label(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        model = LanguageModel(*shared.value)
        for batch in batches:
            names, scores, listed, parts, held = [], [], [], [], 0
            for piece in slices(batch.column(batch.schema.get_field_index(text)), PIECE_BYTES):
                parts.append(_word_scores(piece, model, table))
                held += parts[-1][1].size
                if held > HELD_SCORES:
                    for all_, new in zip((names, scores, listed), decode(parts, model)):
                        all_ += new
                    parts, held = [], 0
            if parts:
                for all_, new in zip((names, scores, listed), decode(parts, model)):
                    all_ += new
            arrays = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            if spans:
                arrays.append(pa.array(listed, to_arrow_type(T.ArrayType(span))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], schema.names)

    return docs.mapInArrow(label, schema)
