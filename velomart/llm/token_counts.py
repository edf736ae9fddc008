"""Token counts of every prefix of a text, by dynamic programming over prefixes.

The tokenizer is a word-level byte-pair encoding: a text is normalized, cut into pieces,
and each piece is merged on its own.  Within a piece the encoding of a prefix ends in
one token, and what stands before that token is the encoding of the shorter prefix.  So
one pass over a piece finds, for each prefix, its last token (the longest-known rest is
the one whose seam with the shorter prefix's last token the merges leave alone) and its
count, the shorter prefix's count plus one.  The count of a prefix of the text is the
sum over its whole pieces plus the count of the prefix of its last piece; no prefix is
encoded again to answer how many tokens it has, or where a budget of tokens ends.

Pieces repeat, so a worker keeps the counts of those it met, a bounded number.

Defined cases: a null or empty text has no tokens; special strings inside a text are
one token each, as the library does by default; equal rows are counted each; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches

KEPT_WORDS = 1_000_000  # counts a worker keeps; more are found anew
KEPT_PIECES = 200_000
KEPT_SEAMS = 1_000_000
NO_SPACE = re.compile("[\x1c-\x1f]")  # white space to str.split alone


class _Bounded(dict):
    """A dictionary that starts anew when it holds ``most`` entries."""

    def __init__(self, most: int, make) -> None:
        self.most, self.make = most, make

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.make(key)
        return value


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes
    stand for themselves, the others for the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [], 256
    for b in range(256):
        if b in plain:
            letters.append(chr(b))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


class PrefixCounter:
    """Counts of all prefixes for the tokenizer in a file of the ``tokenizers`` library
    that has a BPE model with an end-of-word suffix."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab = frozenset(model["vocab"])
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.longest = max(map(len, self.vocab))
        self.letters = byte_letters()
        steps = spec["normalizer"]["normalizers"]
        if [s["type"] for s in steps] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("another normalizer")
        self.space = regex.compile(steps[1]["pattern"]["Regex"])
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        special = sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True)
        self.special = frozenset(special)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.seams = _Bounded(KEPT_SEAMS, self._seam)
        self.counts = _Bounded(KEPT_PIECES, self._total)
        self.words = _Bounded(KEPT_WORDS, self._word)

    @staticmethod
    def lower(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        # One letter after another: no rule of the library looks at its neighbours.
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def normalize(self, text: str) -> str:
        return self.lower(self.space.sub(" ", unicodedata.normalize("NFC", text)))

    def merge(self, symbols: list[str]) -> list[str]:
        """The merges on a row of symbols, least rank first, the first place first."""
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(pair, none) for pair in pairwise(symbols)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((symbols[i], symbols[i + 1]), none)
            if i:
                ranks[i - 1] = rank((symbols[i - 1], symbols[i]), none)
        return symbols

    def _symbols(self, token: str) -> list[str]:
        """The letters a token consists of; the end of a word belongs to its last letter."""
        if token.endswith(self.end) and len(token) > len(self.end):
            body = token[: -len(self.end)]
            return [*body[:-1], body[-1] + self.end]
        return list(token)

    def _seam(self, pair: tuple[str, str]) -> bool:
        """Whether the merges, run on both tokens' letters together, give the two back;
        with an empty first token, whether they give the second."""
        first, second = pair
        return self.merge(self._symbols(first) + self._symbols(second)) == ([first, second] if first else [second])

    def _last(self, word: str, at: int, last: list[str], ended: bool) -> str:
        """The last token of the prefix of ``at`` letters, with or without the end of
        the word; ``last`` has the last tokens of the shorter prefixes without it."""
        for size in range(min(at, self.longest), 0, -1):
            token = word[at - size : at] + (self.end if ended else "")
            if token in self.vocab and self.seams[last[at - size], token]:
                return token
        return word[at - 1 : at] + (self.end if ended else "")

    def prefixes(self, piece: str) -> list[int]:
        """The token count of each prefix of a piece, by its bytes; entry 0 is 0."""
        word = "".join(self.letters[b] for b in piece.encode())
        last, count, out = [""], [0], [0]
        for at in range(1, len(word) + 1):
            token = self._last(word, at, last, ended=True)
            out.append(count[at - (len(token) - len(self.end))] + 1)
            token = self._last(word, at, last, ended=False)
            last.append(token)
            count.append(count[at - len(token)] + 1)
        return out

    def _total(self, piece: str) -> int:
        """The count of the whole piece: the last entry of its prefixes."""
        word = "".join(self.letters[b] for b in piece.encode())
        last, count = [""], [0]
        for at in range(1, len(word)):
            token = self._last(word, at, last, ended=False)
            last.append(token)
            count.append(count[at - len(token)] + 1)
        token = self._last(word, len(word), last, ended=True)
        return count[len(word) - (len(token) - len(self.end))] + 1

    def _word(self, word: str) -> int:
        """The count of what stands between white space: its pieces, one or more."""
        if word.isalpha():
            return self._total(word)
        return sum(map(self.counts.__getitem__, self.pieces.findall(word)))

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special strings, and the special strings."""
        if self.cut is None or not any(s in text for s in self.special):
            yield text, False
            return
        for part in self.cut.split(text):
            if part:
                yield part, part in self.special

    def sections(self, text: str) -> Iterator[tuple[str, bool]]:
        for part, special in self.parts(text):
            yield (part if special else self.normalize(part)), special

    def count(self, text: str) -> int:
        total = 0
        for part, special in self.parts(text):
            if special:
                total += 1
            elif NO_SPACE.search(part):
                total += sum(map(self.counts.__getitem__, self.pieces.findall(self.normalize(part))))
            else:
                total += sum(map(self.words.__getitem__, self.lower(part).split()))
        return total

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """Ends of the pieces in the normalized text and the count of tokens up to each:
        with :meth:`prefixes` of the piece after it, the count of every prefix."""
        ends, counts, at, total = [0], [0], 0, 0
        for part, special in self.sections(text):
            if special:
                ends.append(at + len(part))
                total += 1
                counts.append(total)
            else:
                for m in self.pieces.finditer(part):
                    total += self.counts[m.group()]
                    ends.append(at + m.end())
                    counts.append(total)
            at += len(part)
        return ends, counts

    def every_prefix(self, text: str) -> list[int]:
        """The token count of each prefix of the normalized text, by characters."""
        out = [0]
        total = 0
        for part, special in self.sections(text):
            if special:
                out += [total] * (len(part) - 1) + [total + 1]
                total += 1
                continue
            at = 0
            for m in self.pieces.finditer(part):
                out += [total] * (m.start() - at)
                counts = self.prefixes(m.group())
                size = 0
                for letter in m.group():
                    size += len(letter.encode())
                    out.append(total + counts[size])
                total, at = out[-1], m.end()
            out += [total] * (len(part) - at)
        return out


@lru_cache(maxsize=4)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def _counts(path: str, budget: int, tables: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(path)
        for batch in batches:
            n, fit, ends, counts = [], [], [], []
            for value in batch.column("text"):
                text = value.as_py() or ""
                if tables:
                    e, c = tokens.table(text)
                    n.append(c[-1])
                    ends.append(e)
                    counts.append(c)
                else:
                    n.append(tokens.count(text))
            out = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64()), pa.array([x > budget for x in n], pa.bool_())]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            if tables:
                out += [pa.array(ends, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
                names += ["piece_ends", "token_counts"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def token_counts(docs: DataFrame, tokenizer: str, budget: int = 2048, id_col: str = "doc_id", text_col: str = "text", tables: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more tokens than ``budget``) of each row.

    With ``tables`` also piece_ends and token_counts, the stored prefix counts:
    ``token_counts[i]`` tokens end at ``piece_ends[i]`` characters of the normalized
    text (:func:`tokens_within`, :func:`longest_within`).  ``tokenizer`` is the path
    of the vocabulary file, the same on every executor.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    fields = [rows.schema["doc_id"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    if tables:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("piece_ends", "token_counts")]
    return map_batches(rows, _counts(tokenizer, budget, tables), T.StructType(fields))


def tokens_within(counted: DataFrame, characters: int) -> DataFrame:
    """Adds ``tokens_within``: tokens of the pieces that end within so many characters,
    read from the stored counts."""
    return counted.withColumn("tokens_within", F.expr(f"token_counts[size(filter(piece_ends, e -> e <= {characters})) - 1]"))


def longest_within(counted: DataFrame, tokens: int) -> DataFrame:
    """Adds ``characters_within``: where the last piece ends that a budget of so many
    tokens holds, read from the stored counts."""
    return counted.withColumn("characters_within", F.expr(f"piece_ends[size(filter(token_counts, c -> c <= {tokens})) - 1]"))
