"""Language identification by cross-parsing.

For each language a suffix automaton of labelled text is built, which knows every
string of that text.  A text is parsed from left to right into phrases, each the longest
match that the language's text holds (or one letter that it lacks).  Text like the
training text needs few long phrases: phrases * log2(training length) / length estimates
the cross-entropy in bits a letter, and the language of the least wins.

Training is a fit on a bounded sample: the ``MOST_LANGS`` languages of the most labelled
rows, ``SAMPLE_DOCS`` documents of each, drawn by a hash of the id, and ``SAMPLE_CHARS``
characters, shared so that short texts are whole and longer ones give a stretch of one
length each, from a place that the id decides.  The model is a hash table of the automata's
transitions, at most three for each character, so its size has that bound whatever the
corpus or the alphabet; it is broadcast.  Every text is parsed whole, in segments of
``SEGMENT`` symbols that advance side by side (a phrase ends where its segment ends).

A text is lower-cased; letters are symbols, everything else between them is one space.

Defined cases: a null text or one without a letter is ``und`` with score 0 and no
``has_letter``; if nothing is labelled every text is ``und``; of rows of one id and language
the least text counts at training; ties go to the language that sorts first; equal rows get
equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import map_batches, materialize

SAMPLE_DOCS = 200
SAMPLE_CHARS = 32_768
MOST_LANGS = 128
SEGMENT = 1024
BATCH_CHARS = 1 << 20
UNDETERMINED = "und"
SPACE = 1  # symbol of all that is no letter; 0 is a letter that no language's sample has


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def symbols(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Symbols of code points, with runs of spaces as one."""
    found = table[codes]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != SPACE) | (found[:-1] != SPACE)
    return found[keep]


def automaton(text: np.ndarray) -> tuple[int, np.ndarray]:
    """The suffix automaton of a row of symbols: how many states it has, and its
    transitions as rows (state, symbol, state); state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text.tolist():
        now = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = now
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[now] = clone
        last = now
    return len(nxt), np.array([(state, c, to) for state, row in enumerate(nxt) for c, to in row.items()], np.int64).reshape(-1, 3)


class Transitions:
    """(state, symbol) -> state by open addressing, for many pairs at once."""

    SPREAD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray, targets: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.targets = np.full(1 << self.bits, -1, np.int32)
        at, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            # One key of each free slot gets it; the others go on to the next slot.
            slots, first = np.unique(at[left], return_index=True)
            free = self.keys[slots] < 0
            placed = left[first[free]]
            self.keys[slots[free]], self.targets[slots[free]] = keys[placed], targets[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            at[left] = (at[left] + 1) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self.SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The target of each key, or -1."""
        at = self._slots(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.targets[at], -1)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            slot = (at.ravel()[open_] + 1) & (len(self.keys) - 1)
            at.ravel()[open_] = slot
            found, wanted = self.keys[slot], keys.ravel()[open_]
            hit = found == wanted
            out.ravel()[open_[hit]] = self.targets[slot[hit]]
            open_ = open_[~hit & (found >= 0)]
        return out


class Model:
    """Automata of all languages, one behind the other."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        """``samples``: the sampled texts of each language, in a fixed order."""
        joined = {}
        for lang in sorted(samples):
            codes = codes_of(" ".join(samples[lang]))
            if letters()[codes].any():
                joined[lang] = codes
        self.langs = list(joined)
        known = np.unique(np.concatenate([c[letters()[c]] for c in joined.values()])) if joined else np.zeros(0, np.uint32)
        self.known = known
        table = self.symbol_table()
        self.width = len(known) + 2
        edges, self.sizes, self.roots, base = [], [], [], 0
        for codes in joined.values():
            text = symbols(codes, table)
            states, found = automaton(text)
            edges.append(np.column_stack([(found[:, 0] + base) * self.width + found[:, 1], found[:, 2] + base]))
            self.roots.append(base)
            self.sizes.append(len(text))
            base += states
        edges_ = np.concatenate(edges) if edges else np.zeros((0, 2), np.int64)
        self.next = Transitions(np.ascontiguousarray(edges_[:, 0]), edges_[:, 1])

    def symbol_table(self) -> np.ndarray:
        table = np.where(letters(), 0, SPACE).astype(np.uint16)
        table[self.known] = np.arange(2, 2 + len(self.known), dtype=np.uint16)
        return table

    def phrases(self, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Phrases of each segment in each language.  ``rows`` has a segment's symbols in
        a column, the longest segments first."""
        count = np.zeros((len(self.langs), len(lengths)), np.int64)
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(lengths), axis=1)
        alive = np.searchsorted(-lengths, -np.arange(len(rows)), "left")
        for at, n in enumerate(alive.tolist()):
            now, c = state[:, :n], rows[at, :n].astype(np.int64)
            to = self.next.get(now * self.width + c)
            stuck = to < 0
            if stuck.any():
                lang, lane = np.nonzero(stuck)
                again = self.next.get(roots[lang, 0] * self.width + c[lane])
                # The phrase before ends; a symbol that the language lacks is one too.
                count[lang, lane] += (now[lang, lane] != roots[lang, 0]).astype(np.int64) + (again < 0)
                to[lang, lane] = np.where(again < 0, roots[lang, 0], again)
            state[:, :n] = to
        return count + (state != roots)

    def entropy(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol of each text in each language, and whether it has a letter.
        ``codes``: the texts' code points, each text with a space behind it."""
        table = _symbols_of(self)
        found = table[codes]
        keep = np.ones(len(found), bool)
        keep[1:] = (found[1:] != SPACE) | (found[:-1] != SPACE)
        keep[offsets[:-1]] = True
        total = np.concatenate([[0], np.cumsum(keep)])
        begin, end = total[offsets[:-1]], total[offsets[1:]]
        found = found[keep]
        # Segments of every text.
        size = end - begin
        pieces = -(-size // SEGMENT)
        owner = np.repeat(np.arange(len(size)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = begin[owner] + nth * SEGMENT
        length = np.minimum(SEGMENT, end[owner] - start)
        order = np.argsort(-length, kind="stable")
        owner, start, length = owner[order], start[order], length[order]
        bits = np.zeros((len(self.langs), len(size)))
        if len(length):
            at = np.arange(int(length[0]))[:, None] + start[None, :]
            rows = found[np.minimum(at, len(found) - 1)]
            count = self.phrases(rows, length)
            for lang in range(len(self.langs)):
                bits[lang] = np.bincount(owner, count[lang], len(size)) * np.log2(max(2, self.sizes[lang]))
        has = np.add.reduceat(np.concatenate([letters()[codes], [False]]).astype(np.int64), offsets[:-1]) if len(size) else np.zeros(0, np.int64)
        has = np.where(np.diff(offsets) > 0, has, 0) > 0
        return bits / np.maximum(1, size), has

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language, score and whether there is a letter, of each text."""
        lowered = [codes_of((t or "") + " ") for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(c) for c in lowered])]).astype(np.int64)
        if not self.langs or not texts:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts), [bool(letters()[c].any()) for c in lowered]
        bits, has = self.entropy(np.concatenate(lowered), offsets)
        best = bits.argmin(axis=0)
        least = bits[best, np.arange(len(texts))]
        if len(self.langs) > 1:
            second = np.partition(bits, 1, axis=0)[1]
            score = np.clip(np.where(second > 0, 1 - least / np.maximum(second, 1e-300), 0.0), 0.0, 1.0)
        else:
            score = np.ones(len(texts))
        return [self.langs[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)], np.where(has, score, 0.0).tolist(), has.tolist()


_TABLES: dict[int, np.ndarray] = {}


def _symbols_of(model: Model) -> np.ndarray:
    if id(model) not in _TABLES:
        _TABLES.clear()
        _TABLES[id(model)] = model.symbol_table()
    return _TABLES[id(model)]


def held_out(id_col: str, folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves the remainder that is kept for testing."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


def train(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the labelled rows for which ``learn`` holds.

    Ids are drawn without reading a text; then the drawn texts are stored, one for each id
    and language, and at most ``SAMPLE_CHARS`` characters a language reach the driver.
    """
    usable = learn & F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()
    known = docs.where(usable).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"))
    most = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(MOST_LANGS).select("lang")
    draw = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    drawn = known.distinct().join(F.broadcast(most), "lang", "left_semi").withColumn("nth", F.row_number().over(draw)).where(f"nth <= {SAMPLE_DOCS}")
    drawn = materialize(drawn, "drawn")  # at most MOST_LANGS * SAMPLE_DOCS rows
    texts = docs.where(usable & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    read = texts.join(F.broadcast(drawn), ["lang", "id"]).groupBy("lang", "nth", "id").agg(F.min("text").alias("text"))
    read = materialize(read.withColumn("size", F.length("text")), "drawn-texts")
    sizes: dict[str, list[int]] = {}
    for row in read.select("lang", "size").collect():
        sizes.setdefault(row.lang, []).append(row.size)
    if not sizes:
        return Model({})
    # The places within the longer texts are spread evenly, by a hash of the id.
    share = F.create_map(*(x for lang, s in sizes.items() for x in (F.lit(lang), F.lit(fair_share(s)))))[F.col("lang")]
    begin = F.pmod(F.xxhash64("id"), F.greatest(F.col("size") - F.col("share"), F.lit(0)) + 1).cast("int")
    parts = read.withColumn("share", share).select("lang", "nth", F.substring(F.col("text"), begin + 1, F.col("share")).alias("text")).collect()
    samples: dict[str, list[str]] = {}
    for row in sorted(parts, key=lambda r: (r.lang, r.nth)):
        samples.setdefault(row.lang, []).append(row.text)
    return Model(samples)


def fair_share(sizes: list[int]) -> int:
    """The length to which texts are shortened so that all together, each with a space
    behind it, have at most ``SAMPLE_CHARS`` characters."""
    left = SAMPLE_CHARS
    for i, size in enumerate(sorted(sizes)):
        each = left // (len(sizes) - i) - 1
        if size > each:
            return max(0, each)
        left -= size + 1
    return max(sizes)


def _predict(sent, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            column = batch.column("text")
            first = 0
            while first < len(column):
                texts, size = [], 0
                while first + len(texts) < len(column) and (not texts or size < BATCH_CHARS):
                    texts.append(column[first + len(texts)].as_py())
                    size += len(texts[-1] or "")
                langs, scores, has = model.predict(texts)
                names = [n for n in batch.schema.names if n != "text" or keep_text]
                out = [batch.column(n).slice(first, len(texts)) for n in names]
                yield pa.RecordBatch.from_arrays([*out, pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(has, pa.bool_())], names=[*names, "lang_pred", "score", "has_letter"])
                first += len(texts)

    return run


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None, keep_text: bool = False) -> DataFrame:
    """doc_id, the columns ``extra``, lang_pred, score and has_letter of each row, and text
    with ``keep_text``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), *(c.alias(n) for n, c in (extra or {}).items()), F.col(text_col).cast("string").alias("text"))
    fields = [f for f in rows.schema if f.name != "text" or keep_text]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("has_letter", T.BooleanType())])
    return map_batches(rows, _predict(sent, keep_text), schema)
