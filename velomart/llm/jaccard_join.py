"""N-gram Jaccard join with rare-first prefix filtering.

Documents are sets of word n-grams.  Sets are put in one order, rarest gram first; two
sets that reach the threshold share a gram of their prefixes, so prefixes alone are
joined.  The smaller set of a pair is looked up by its shorter index prefix, the larger
by its probe prefix; length, positional and suffix filters drop pairs that cannot reach
the threshold, and each remaining pair is verified once on the whole sets.

* Equal sets are one node (a 64-bit digest of the set), joined once.
* Rarity: blocks of 4M grams report grams that many of their documents hold; sums over
  all blocks order the frequent grams last.  Any common order is correct, so the bound on
  the reported grams (``FREQUENT``, broadcast) has no effect on the result.
* Candidates come in rounds.  First each prefix gram's documents meet only the smallest of
  similar size; verified links give components, and grams whose documents are all in one
  component are closed.  Of a gram that more than ``COLD`` documents still hold, every
  document outside the gram's largest component looks at the others of other components.  A
  tile gives all its pairs that pass the filters if they are no more than the documents that
  look, and is done; else each document proposes the likeliest one (``BEST_ROUNDS`` times: a
  number of pairs linear in the rows each time, with which a large group of near copies
  becomes one component).  Last, all pairs of different components that pass the filters and
  share an open prefix gram, of few documents or of a tile not done, are verified, so no link
  between components is lost.
* Looking at others happens in tiles of a bounded number of documents, by array operations
  on bitmaps; only pairs that pass every filter leave a tile as rows.  The largest component
  of a gram is not copied, the others go to each tile of it, once where they also reside.
* Bitmaps are shuffled of the sets alone that a Bloom filter of the wanted ones lets through.
* The suffix filter compares two bitmaps of the sets' ranges of gram hashes, four to eight
  a gram: each range that only one set reaches is a gram that only one set has.

Texts are read a few times and never shuffled; what moves are prefix grams (about
1 - threshold of all), and the sets of documents in candidate pairs.

Defined cases: null, empty or wordless texts have an empty set, link with nothing and are
their own component; fewer words than n are one gram; a null id takes part, but the id of
a component is the least that is not null; equal rows are one node; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bloom, words
from .common import map_batches, materialize, ship_package
from .graph import connected_components

FREQUENT = 1 << 17
BLOCK_GRAMS = 4_000_000
BLOCK_TIMES = 3
BEST_ROUNDS = 2
COLD = 16  # documents of a gram whose pairs are joined as rows
TILE = 2048  # documents of a tile
NODE_BITS_LOG2 = 26  # of the filter of the nodes whose bitmaps are wanted
LEAST_PARTS_LOG2, MOST_PARTS_LOG2 = 6, 15
_ROWS = 1 << 16


def needed(n: int, percent: int) -> int:
    """The overlap with an equally large or smaller set that a set of ``n`` needs."""
    return -(-percent * n // 100)


def probe_prefix(n, percent: int):
    return n - (percent * n + 99) // 100 + 1


def index_prefix(n, percent: int):
    return n - (2 * percent * n + 99 + percent) // (100 + percent) + 1


def sets(column: pa.Array, n: int, lower: bool = True) -> Iterator[tuple[int, np.ndarray]]:
    """Row and sorted distinct gram hashes of each text."""
    for row, end, data, offsets in words.chunks(column):
        text = words.LOWER[data] if lower else data
        starts, ends, first = words.spans(text, offsets, words.NOT_SPACE)
        hashes = words.span_hashes(text, starts, ends)
        grams = words.gram_hashes(hashes, n)
        first = first.tolist()
        for i in range(end - row):
            a, b = first[i], first[i + 1]
            if b - a >= n:
                found = np.sort(grams[a : b - n + 1])
                keep = np.empty(len(found), bool)
                keep[0] = True
                np.not_equal(found[1:], found[:-1], out=keep[1:])
                yield row + i, found[keep]
            elif b > a:
                yield row + i, words.mix(words.gram_hashes(hashes[a:b], b - a)[:1] + np.uint64(b - a))
            else:
                yield row + i, grams[:0]


def node_of(found: np.ndarray) -> int:
    """The digest of a set as a signed 64-bit number."""
    value = (int(words.mix(found).sum(dtype=np.uint64)) * 0x9E3779B97F4A7C15 + len(found)) & 0xFFFFFFFFFFFFFFFF
    return value - (1 << 64) if value >> 63 else value


def parts_of(found: np.ndarray) -> bytes:
    """Which of 2**k equal ranges of hashes hold a gram, as bits."""
    k = min(max(len(found).bit_length() + 2, LEAST_PARTS_LOG2), MOST_PARTS_LOG2)
    held = np.zeros(1 << k, bool)
    held[(found >> np.uint64(64 - k)).astype(np.int64)] = True
    return np.packbits(held, bitorder="little").tobytes()


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Bitmaps (rows of bytes) of as many ranges as ``size`` bytes hold."""
    if bits.shape[1] == size:
        return bits
    held = np.unpackbits(bits, axis=1, bitorder="little").reshape(len(bits), size * 8, -1).any(axis=2)
    return np.packbits(held, axis=1, bitorder="little")


def least_difference(x: bytes, y: bytes) -> int:
    """A bound from below on how many grams only one of two sets has."""
    size = min(len(x), len(y))
    a, b = (folded(np.frombuffer(p, np.uint8)[None, :], size) for p in (x, y))
    return int(np.bitwise_count(a ^ b).sum())


def _describe(n: int, keep: list[str]):
    """Documents: node, size and parts; and the frequent grams of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        block, size = [], 0

        def frequent():
            grams = np.concatenate(block)
            grams.sort()
            n = max(0, len(grams) - BLOCK_TIMES + 1)
            often = np.unique(grams[:n][grams[:n] == grams[len(grams) - n :]])
            return often, np.searchsorted(grams, often, "right") - np.searchsorted(grams, often, "left")

        names = [*keep, "n", "node", "parts", "gram", "times"]
        types: list[pa.DataType] = []

        def row(grams, times):
            empty = [pa.nulls(len(grams), t) for t in types]
            more = [pa.nulls(len(grams), t) for t in (pa.int64(), pa.int64(), pa.binary())]
            return pa.RecordBatch.from_arrays([*empty, *more, words.signed(grams), pa.array(times, pa.int64())], names=names)

        for batch in batches:
            types = [batch.column(c).type for c in keep]
            sizes, nodes, parts = [], [], []
            for _, found in sets(batch.column("text"), n):
                sizes.append(len(found))
                nodes.append(node_of(found) if len(found) else None)
                parts.append(parts_of(found) if len(found) else None)
                if len(found) and nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    block.append(found)
                    size += len(found)
                    if size >= BLOCK_GRAMS:
                        yield row(*frequent())
                        block, size = [], 0
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(parts, pa.binary()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], names=names
            )
        if block:
            yield row(*frequent())

    return run


def _prefixes(n: int, percent: int, sent):
    """gram, node, n, pos of each distinct set's probe prefix, rarest grams first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, times = sent.value
        seen: set[int] = set()
        out, held = [], 0

        def flush():
            sizes = np.array([len(found) for _, _, found in out], np.int64)
            nodes = np.array([node for node, _, _ in out], np.int64)
            totals = np.array([total for _, total, _ in out], np.int32)
            pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            return pa.RecordBatch.from_arrays(
                [words.signed(np.concatenate([found for _, _, found in out])), pa.array(np.repeat(nodes, sizes)), pa.array(np.repeat(totals, sizes)), pa.array(pos.astype(np.int32))], names=["gram", "node", "n", "pos"]
            )

        for batch in batches:
            for _, found in sets(batch.column("text"), n):
                if not len(found):
                    continue
                node = node_of(found)
                if node in seen:
                    continue
                seen.add(node)
                length = probe_prefix(len(found), percent)
                if len(grams):
                    at = np.minimum(np.searchsorted(grams, found), len(grams) - 1)
                    often = np.where(grams[at] == found, times[at], 0)
                    prefix = found[np.argsort(often, kind="stable")[:length]] if often.any() else found[:length]
                else:
                    prefix = found[:length]
                out.append((node, len(found), prefix))
                held += length
                if held >= _ROWS:
                    yield flush()
                    out, held = [], 0
        if out:
            yield flush()

    return run


def stratum(n: np.ndarray, percent: int) -> np.ndarray:
    return np.floor(np.log(n) / -np.log(percent / 100) + 1e-9).astype(np.int64)


def _meet(percent: int):
    """From prefix rows sorted by gram, size and node: the rows of grams that several
    nodes have, each with the hub it meets first: the smallest set of its gram and size
    class, and for that one the hub of the class before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None  # the last row so far, not yet given out
        hub = head = (0, 0)  # its hub, and the first of its class: node and size
        shared = False  # whether it follows a row of its gram

        def give(rows, hubs, sizes, keep):
            arrays = [pa.array(rows[c][keep]) for c in ("gram", "node", "n", "pos")]
            h, m, n = hubs[keep], sizes[keep], rows["n"][keep].astype(np.int64)
            none = (h == rows["node"][keep]) | (100 * np.minimum(m, n) < percent * np.maximum(m, n))
            return pa.RecordBatch.from_arrays([*arrays, pa.array(h, mask=none)], names=["gram", "node", "n", "pos", "hub"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_numpy() for c in ("gram", "node", "n", "pos")}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            distinct = np.ones(len(rows["gram"]), bool)
            distinct[1:] = (rows["gram"][1:] != rows["gram"][:-1]) | (rows["node"][1:] != rows["node"][:-1])
            rows = {c: v[distinct] for c, v in rows.items()}
            count = len(rows["gram"])
            same = np.zeros(count + 1, bool)  # whether a row has the gram of the row before
            same[1:-1] = rows["gram"][1:] == rows["gram"][:-1]
            same[0] = shared
            part = stratum(rows["n"], percent)
            opens = np.ones(count, bool)
            opens[1:] = ~same[1:-1] | (part[1:] != part[:-1])
            # Each row's class opens at the last opening row; the first row's may lie behind.
            at = np.maximum.accumulate(np.where(opens, np.arange(count), 0))
            own, own_n = rows["node"][at], rows["n"][at].astype(np.int64)
            if held is not None:
                first = at == 0
                own[first], own_n[first] = head
            hubs, sizes = own.copy(), own_n.copy()
            if held is not None:
                hubs[0], sizes[0] = hub
            chained = np.flatnonzero(opens[1:] & same[1:-1]) + 1
            hubs[chained], sizes[chained] = own[chained - 1], own_n[chained - 1]
            keep = same[:-1] | same[1:]
            keep[-1] = False
            yield give(rows, hubs, sizes, np.flatnonzero(keep))
            held = {c: v[-1:] for c, v in rows.items()}
            hub, head, shared = (hubs[-1], sizes[-1]), (own[-1], own_n[-1]), bool(same[-2]) if count > 1 else shared
        if held is not None and shared:
            yield give(held, np.array([hub[0]]), np.array([hub[1]]), np.array([0]))

    return run


def _chosen_sets(n: int, sent):
    """node and its sorted grams, of the documents that stand for nodes in the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            keys = batch.column("dk").to_numpy()
            nodes, blobs = [], []
            for row, found in sets(batch.column("text"), n):
                if not len(found):
                    continue
                node = node_of(found)
                if bloom.passes(bits, np.array([node ^ int(keys[row])], np.int64).view(np.uint64))[0]:
                    nodes.append(node)
                    blobs.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(blobs, pa.binary())], names=["node", "grams"])

    return run


def _wanted(sent):
    """Rows whose node passes the filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            yield batch.filter(pa.array(bloom.passes(bits, batch.column("node").to_numpy().view(np.uint64))))

    return run


def _near(percent: int):
    """Pairs that the suffix filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = most_difference(batch.column("na").to_numpy() + batch.column("nb").to_numpy(), percent)
            keep = [i for i, (x, y) in enumerate(zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), strict=True)) if least_difference(x, y) <= most[i]]
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    return run


def most_difference(total, percent: int):
    """How many grams only one of two sets may have, whose sizes add up to ``total``."""
    return total - 2 * -(-percent * total // (100 + percent))


def unordered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs with their smaller node first."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    keep = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
    return a[keep], b[keep]


def _tile(percent: int, best: bool):
    """Pairs of a gram's visiting documents with resident ones that pass all filters.  With
    ``best``, if they are more than the visitors, only that of the least difference of each
    visitor, and a row with the gram, which is not done."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        roles = {True: rows.column("visits").to_numpy(), False: rows.column("home").to_numpy()}
        facts = {c: rows.column(c).to_numpy() for c in ("node", "n", "pos", "root")}
        facts = {c: v.astype(np.int64) for c, v in facts.items()}
        parts = rows.column("parts").to_pylist()
        sizes = np.array([len(x) for x in parts])
        sides = {}
        for visiting in (False, True):
            for size in np.unique(sizes[roles[visiting]]).tolist():
                at = np.flatnonzero(roles[visiting] & (sizes == size))
                sides[visiting, size] = {c: v[at] for c, v in facts.items()}, np.frombuffer(b"".join(parts[i] for i in at), np.uint8).reshape(len(at), size)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for (visiting, x), (guest, mine) in sides.items():
            for (other, y), (home, theirs) in sides.items():
                # Sets within the threshold are of one size of bitmap or of neighbouring ones.
                if not visiting or other or max(x, y) > 4 * min(x, y):
                    continue
                a, b = (np.ascontiguousarray(folded(v, min(x, y))).view(np.uint64) for v in (mine, theirs))
                step = max(1, (1 << 22) // b.size)
                for i in range(0, len(a), step):
                    u = {c: v[i : i + step, None] for c, v in guest.items()}
                    v = {c: w[None, :] for c, w in home.items()}
                    first = (u["n"] < v["n"]) | ((u["n"] == v["n"]) & (u["node"] < v["node"]))
                    low, high = np.minimum(u["n"], v["n"]), np.maximum(u["n"], v["n"])
                    total = u["n"] + v["n"]
                    pos = np.where(first, u["pos"], v["pos"])
                    left = np.minimum(u["n"] - u["pos"], v["n"] - v["pos"])
                    may = (u["root"] != v["root"]) & (100 * low >= percent * high) & (pos < index_prefix(low, percent)) & (left >= (percent * total + 99 + percent) // (100 + percent))
                    p, q = np.nonzero(may)
                    most = most_difference(total[p, q], percent)
                    for j in range(0, len(p), 1 << 14):
                        k, m = p[j : j + (1 << 14)], q[j : j + (1 << 14)]
                        gap = np.bitwise_count(a[i + k] ^ b[m]).sum(axis=1, dtype=np.int64)
                        keep = gap <= most[j : j + (1 << 14)]
                        found.append((guest["node"][i + k[keep]], home["node"][m[keep]], gap[keep]))
        a, b, gap = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        pairs = unordered(a, b)
        left = best and len(pairs[0]) > roles[True].sum()
        if left:
            order = np.lexsort((b, gap, a))
            a, b = a[order], b[order]
            keep = np.append(True, a[1:] != a[:-1])[: len(a)]
            pairs = unordered(a[keep], b[keep])
        columns = [pa.concat_arrays([pa.array(x), pa.nulls(int(left), pa.int64())]) for x in pairs]
        gram = pa.concat_arrays([pa.nulls(len(pairs[0]), pa.int64()), pa.array([key[0].as_py()] * int(left), pa.int64())])
        return pa.table([*columns, gram], names=["a", "b", "gram"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[row].as_buffer(), np.uint64) for c in ("x", "y"))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                both = int((y[at] == x).sum())
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(row)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")], names=["a", "b"])

    return run


class JaccardJoin:
    """The join over one table; ``percent`` is the threshold of intersection to union."""

    def __init__(self, docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None) -> None:
        if not 0 < percent <= 100:
            raise ValueError("percent is from 1 to 100")
        self.spark = docs.sparkSession
        self.n, self.percent = n, percent
        self.extra = list(extra or {})
        self.rows = docs.select(
            F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col)).alias("dk"), *(c.alias(name) for name, c in (extra or {}).items()), F.col(text_col).cast("string").alias("text")
        )
        self.texts = self.rows.select("dk", "text")
        self._described()

    def _described(self) -> None:
        keep = ["doc_id", "dk", *self.extra]
        fields = [T.StructField(f.name, f.dataType, True) for f in self.rows.schema if f.name != "text"]
        schema = T.StructType([
            *fields, T.StructField("n", T.LongType()), T.StructField("node", T.LongType()), T.StructField("parts", T.BinaryType()),
            T.StructField("gram", T.LongType()), T.StructField("times", T.LongType()),
        ])
        found = materialize(map_batches(self.rows, _describe(self.n, keep), schema), "sets")
        self.documents = found.where("gram is null").drop("gram", "times")
        self.nodes = materialize(
            self.documents.where("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("parts").alias("parts"), F.min("dk").alias("dk"), F.min("doc_id").alias("least")), "nodes"
        )
        often = found.where("gram is not null").groupBy("gram").agg(F.sum("times").alias("times")).orderBy(F.col("times").desc(), "gram").limit(FREQUENT).toArrow()
        grams, times = often["gram"].to_numpy().view(np.uint64), often["times"].to_numpy()
        order = np.argsort(grams)
        self.frequent = self.spark.sparkContext.broadcast((grams[order], times[order]))

    def _shared(self) -> DataFrame:
        rows = map_batches(self.texts, _prefixes(self.n, self.percent, self.frequent), "gram long, node long, n int, pos int")
        met = rows.repartition("gram").sortWithinPartitions("gram", "n", "node")
        return materialize(map_batches(met, _meet(self.percent), "gram long, node long, n int, pos int, hub long"), "shared-grams")

    def _bitmaps(self, of: DataFrame) -> DataFrame:
        """node, n and parts of at least the nodes in ``of``."""
        bits = self.spark.sparkContext.broadcast(bloom.build(of, "node", NODE_BITS_LOG2))
        return map_batches(self.nodes.select("node", "n", "parts"), _wanted(bits), "node long, n long, parts binary")

    def _possible(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs (a, b) that pass the length and suffix filters."""
        pairs = materialize(pairs, f"{name}-met")
        nodes = self._bitmaps(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        both = pairs.join(nodes.toDF("a", "na", "pa"), "a").join(nodes.toDF("b", "nb", "pb"), "b")
        near = both.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
        return map_batches(near, _near(self.percent), "a long, b long")

    def _linked(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that reach the threshold, verified on the whole sets."""
        pairs = materialize(pairs, f"{name}-pairs")
        if pairs.isEmpty():
            return pairs
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        chosen = self.nodes.join(ends, "node", "left_semi").select(F.col("node").bitwiseXOR(F.col("dk")).alias("key"))
        bits = self.spark.sparkContext.broadcast(bloom.build(chosen, "key"))
        grams = materialize(map_batches(self.texts, _chosen_sets(self.n, bits), "node long, grams binary"), f"{name}-sets")
        held = pairs.join(grams.toDF("a", "x"), "a").join(grams.toDF("b", "y"), "b")
        return materialize(map_batches(held, _verify(self.percent), "a long, b long").distinct(), f"{name}-links")

    def _open(self, rows: DataFrame, groups: DataFrame) -> DataFrame:
        """Rows of the grams whose documents are in several components, with their root,
        how many rows the gram has, its largest component and how many rows are not in it."""
        rooted = rows.select("gram", "node", "n", "pos").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        by_root = rooted.groupBy("gram", "root").agg(F.count("*").alias("of_root"))
        of_gram = by_root.groupBy("gram").agg(F.sum("of_root").alias("held"), F.max_by("root", "of_root").alias("major"), F.max("of_root").alias("most"), F.count("*").alias("roots"))
        several = of_gram.where("roots > 1").select("gram", "held", "major", (F.col("held") - F.col("most")).alias("minor"))
        return materialize(rooted.join(several, "gram"), "open-grams")

    def _moved(self, rows: DataFrame, before: DataFrame, after: DataFrame, found: DataFrame) -> DataFrame:
        """The rows with the roots they have after the links in ``found``.  The table of
        changed roots is no larger than that of the links: Spark broadcasts a small one."""
        ends = found.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        was = ends.join(before, "node", "left").withColumn("root", F.coalesce("root", "node"))
        moved = was.join(after.toDF("node", "now"), "node").where("root != now").select("root", "now").distinct()
        return rows.join(materialize(moved, "moved-roots"), "root", "left").withColumn("root", F.coalesce("now", "root")).drop("now")

    def _hot_pairs(self, rows: DataFrame, best: bool) -> DataFrame:
        """Pairs of grams that many documents hold, from tiles, and the grams with tiles that
        are not done: each document is a resident of one tile, and those outside the gram's
        largest component visit all."""
        nodes = self._bitmaps(rows.select("node").distinct()).select("node", "parts")
        tiles, blocks = (F.ceil(F.col(c) / TILE).cast("int") for c in ("held", "minor"))
        part = lambda count, seed: F.pmod(F.xxhash64("node", F.lit(seed)), count).cast("int")
        places = F.expr("""inline(concat(
            transform(sequence(0, blocks - 1), x -> struct(true as home, outside and x = block0 as visits, tile0 as tile, x as block)),
            transform(filter(sequence(0, tiles - 1), x -> outside and x != tile0), x -> struct(false as home, true as visits, x as tile, block0 as block))))""")
        facts = ["gram", "node", "n", "pos", "root", "parts"]
        placed = rows.join(nodes, "node").select(*facts, F.expr("root != major").alias("outside"), tiles.alias("tiles"), blocks.alias("blocks"), part(tiles, 1).alias("tile0"), part(blocks, 2).alias("block0"))
        return placed.select(*facts, places).groupBy("gram", "tile", "block").applyInArrow(_tile(self.percent, best), "a long, b long, gram long").distinct()

    def _cold_pairs(self, rows: DataFrame) -> DataFrame:
        p = self.percent
        x, y = (rows.select("gram", *(F.col(c).alias(f"{c}{i}") for c in ("node", "n", "pos", "root"))) for i in (1, 2))
        overlap = f"({p} * (n1 + n2) + {99 + p}) div {100 + p}"
        pairs = (
            x.join(y, "gram")
            .where("root1 != root2 and (n1 < n2 or n1 = n2 and node1 < node2)")
            .where(f"100 * n1 >= {p} * n2")
            .where(f"pos1 < n1 - ({2 * p} * n1 + {99 + p}) div {100 + p} + 1")
            .where(f"1 + least(n1 - pos1 - 1, n2 - pos2 - 1) >= {overlap}")
            .select(F.least("node1", "node2").alias("a"), F.greatest("node1", "node2").alias("b"))
            .distinct()
        )
        return self._possible(pairs, "cold")

    def links(self) -> DataFrame:
        """(a, b): links between nodes, enough of them to connect all that are linked."""
        ship_package(self.spark)
        rows = self._shared()
        hubs = rows.where("hub is not null").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
        links = self._linked(self._possible(hubs, "hub"), "hub")
        groups = connected_components(links)
        rows = self._open(rows, groups)
        cold, hot = rows.where(F.col("held") <= COLD), rows.where(F.col("held") > COLD)
        rest, rounds = None, BEST_ROUNDS  # the pairs of the hot grams that the rounds leave
        while not hot.isEmpty():
            if not rounds:
                rest = self._hot_pairs(hot, best=False).select("a", "b")
                break
            tiles = materialize(self._hot_pairs(hot, best=True), "tiles")
            left = tiles.where("gram is not null").select("gram").distinct()
            found = self._linked(tiles.where("gram is null").select("a", "b").distinct(), f"best{BEST_ROUNDS - rounds}")
            hot = hot.join(left, "gram", "left_semi")
            if found.isEmpty():
                rounds = 0
                continue
            rounds -= 1
            links, before = links.union(found), groups
            groups = connected_components(links)
            cold = self._moved(cold, before, groups, found)
            hot = self._open(hot, groups)
        pairs = self._cold_pairs(cold)
        return links.union(self._linked(pairs if rest is None else pairs.union(rest).distinct(), "cross"))

    def components(self) -> DataFrame:
        """doc_id, the extra columns, n_shingles, component_id and root (the component's
        key, null for an empty set) of each row."""
        groups = connected_components(self.links())
        rooted = self.nodes.select("node", "least").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
        least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        named = rooted.join(least, "root").select(F.col("node").alias("v"), "root", "component_id")
        return (
            self.documents.join(named, F.col("node") == F.col("v"), "left")
            .select("doc_id", *self.extra, F.col("n").alias("n_shingles"), F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "root")
        )
