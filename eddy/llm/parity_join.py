"""Near-duplicate join by parity sketches.

A document is the set of its distinct five-word shingles; two documents link when the
Jaccard similarity of their sets is at least ``percent`` (75) per cent.

Sketch. A sketch is a row of k words, all 0 at first; every shingle's hash is XORed into
one of them, picked by the hash. An element that only one of two sets has changes one
word, so the number of differing words is at most the symmetric difference. Linked sets of
n and m elements differ by at most (n + m) / 7 elements, hence share the other words of
their sketches. k is fixed per size band (sizes 2^c to 2^(c+1)-1); a pair is found in the
band of its larger set, and a set near the upper edge also takes part in the next band.

Candidates. With all words of a sketch in one global order (empty ones last) linked sets
share at least 1 + x of their first d + 1 + x, where d bounds their difference
(pigeonhole). These words are exchanged, packed, and only words that two documents have
are kept. On those the same principle runs again with their true frequencies: a document
that shares fewer than its bound can't link, one that shares g keeps its g - bound + 1
rarest. Common passages, whose words many documents share, fall away here without any
pairs being made.

Verification. Texts of equal sets are one class and take part once. In a few rounds every
document is compared exactly with the one document of another component that shares most
of its words with it among one leader per word; links found join components. Then the
pairs that share a word and still lie in different components are tested by a finer sketch
of single bits, whose Hamming distance is at most the symmetric difference as well, and
those that pass are compared exactly. Pairs inside a component are never made, and only
pairs that pass leave a task, so a large group of near copies is never listed as pairs. No
pair that may link is dropped: the result is exact but for 64-bit hash collisions.

Defined cases: a null or empty text, or one without words, has no shingles and links with
nothing; one to four words are one shingle; rows of one id with the same set of shingles
count as one document, rows of one id with different sets as documents of their own (a
component is then named by the least id in it, and rows of an id may lie in different
ones); rows with a null id take no part and have a null component; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.llm import textkernel as K
from eddy.llm.components import components
from eddy.llm.scratch import Scratch

ROUNDS = 2
BUCKET_WORDS = 1_000_000  # sketch words that one task of the exchange gets, about
FILTER_BITS = 1 << 23
SKETCH_BITS = 1 << 13
OPEN_ROWS = 1 << 18       # (word, document) rows that one task of the last pairs gets, about, and
OPEN_MEETS = 1 << 23      # pairs of documents of a word that it walks through, about
OPEN_BLOCK = 2048         # documents of a word in a block
FOLDED = 16               # 64-bit words that a bit sketch is folded to for a first test
LINK_BLOCK = 1024         # classes of a component in a block, and
LINK_ELEMENTS = 1 << 18   # elements of their sets, about
U = np.uint64


def _distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct numbers (``np.unique`` hashes them, which takes far longer than to sort)."""
    x = np.sort(x)
    keep = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def sets(column: pa.Array, width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for a, b in K.parts(column):
        w = K.words(column.slice(a, b - a))
        for d in range(b - a):
            yield _distinct(K.shingles(w.hash[w.first[d]:w.first[d + 1]], width))


def set_key(s: np.ndarray) -> int:
    """A 64-bit digest of a set; with the set's size it names the class of equal sets."""
    return int(K.mix(s + U(0x51A3)).sum(dtype=U).view(np.int64)) if len(s) else 0


class Layout:
    """Sizes and bounds for one similarity threshold, ``percent`` of the union."""

    def __init__(self, percent: int = 75):
        self.p = percent

    def partner(self, n: int) -> int:
        """The size of the largest set that can link with one of size n."""
        return 100 * n // self.p

    def apart(self, n: int, m: int) -> int:
        """The largest symmetric difference of linked sets of sizes n and m."""
        return (100 - self.p) * (n + m) // (100 + self.p)

    def words(self, c: int) -> int:
        """Words in the sketches of size band c: fewer than elements, so that most words
        hold two or three of them and rarely agree by chance; in any case as many as a set
        of the band exchanges."""
        high = (2 << c) - 1
        d = self.apart(high, high)
        return max(2 * high if high <= 15 else -(-2 * high // 5), d + 1 + self.spare(d))

    @staticmethod
    def spare(d: int) -> int:
        return -(-3 * (d + 1) // 20) + 2

    def bands(self, n: int) -> list[tuple[int, int]]:
        """(band, words to exchange) for a set of size n."""
        c = n.bit_length() - 1
        high, most = (2 << c) - 1, self.partner(n)
        out = [(c, self.apart(n, min(most, high)))]
        if most > high:
            out += [(b, self.apart(n, min(most, (2 << b) - 1))) for b in range(c + 1, most.bit_length())]
        return [(b, d + 1 + self.spare(d)) for b, d in out]

    def bound(self, n: int) -> int:
        """Exchanged words that a set of size n shares at least with any it links with."""
        return 1 + self.spare(self.apart(n, -(-self.p * n // 100)))


def sketch_words(s: np.ndarray, layout: Layout) -> list[tuple[int, np.ndarray]]:
    """(band, the words to exchange as hashes of place and value) for one set."""
    out = []
    mixed = K.mix(s)
    for c, want in layout.bands(len(s)):
        k = layout.words(c)
        place = ((s >> U(32)) * U(k)) >> U(32)  # rises with the hash: equal places are neighbours
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        value = np.bitwise_xor.reduceat(mixed, first)
        salt = K.mix(np.array([c + 1], dtype=U))
        word = np.sort(K.mix(K.mix(value) ^ (place[first] * U(0x9E3779B97F4A7C15)) ^ salt))
        if len(word) < want:  # empty words come last in the order, among themselves by hash
            empty = np.setdiff1d(np.arange(k, dtype=U), place[first])
            word = np.r_[word, np.sort(K.mix((empty * U(0x9E3779B97F4A7C15)) ^ salt))]
        out.append((c, word[:want]))
    return out


def _planes(x: np.ndarray) -> bytes:
    """Little-endian bytes of an array, first bytes first: leading zeros lie together and
    the exchange's compression removes them."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplanes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(b, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


class Join:
    """One run of the join over a table of documents."""

    def __init__(self, docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
                 percent: int = 75):
        self.layout = Layout(percent)
        self.scratch = Scratch(spark, "parity")
        self.rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
        self._classes()
        self.docs = self.told(self.rows).select("doc", "text")

    def _classes(self) -> None:
        def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = [(len(s), set_key(s)) for s in sets(b.column(2))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), *(pa.array([x[i] for x in got], pa.int64()) for i in (0, 1))],
                    names=["id", "h", "n", "key"])

        sized = self.scratch.table(
            self.rows.select("id", F.xxhash64("text").alias("h"), "text")
            .mapInArrow(K.trimmed(sizes), "id long, h long, n long, key long"), "sized")
        self.several = self.scratch.table(
            sized.where("id is not null").groupBy("id")
            .agg(F.min("n").alias("n"), F.max("n").alias("n2"), F.min("key").alias("key"), F.max("key").alias("key2"))
            .where("n <> n2 or key <> key2").select("id"), "several")
        self.alone = self.several.isEmpty()
        self.sizes = self.told(sized)
        if not self.alone:
            self.sizes = self.scratch.table(self.sizes, "sizes")
        real = self.sizes.where("n > 0 and id is not null")
        self.reps = self.scratch.table(
            real.groupBy("n", "key").agg(F.min("doc").alias("rep"), F.min("id").alias("low")), "reps")
        self.member = self.scratch.table(
            real.join(self.reps, ["n", "key"]).select("doc", "rep", "low", "n").distinct(), "member")

    def told(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, text or its hash h, more) with ``doc``, the number of the document: the
        id, or a hash of id and text where rows of one id have different sets."""
        if self.alone:
            return rows.withColumn("doc", F.col("id"))
        h = F.col("h") if "h" in rows.columns else F.xxhash64("text")
        mark = self.several.withColumn("many", F.lit(True))
        return rows.join(mark, "id", "left").withColumn(
            "doc", F.when(F.col("many"), F.xxhash64("id", h)).otherwise(F.col("id"))).drop("many")

    def _shared_words(self) -> DataFrame:
        """(word, rep, c, n): exchanged words that at least two documents have."""
        total = self.sizes.agg(F.sum("n")).first()[0] or 0
        count = max(1, -(-total // (2 * BUCKET_WORDS)))
        layout = self.layout

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0).to_numpy(zero_copy_only=False)
                seen, words, owner, band = set(), [], [], []
                for i, s in enumerate(sets(b.column(1))):
                    key = (len(s), set_key(s))
                    if not len(s) or key in seen:  # copies within a batch go once
                        continue
                    seen.add(key)
                    for c, w in sketch_words(s, layout):
                        words.append(w)
                        owner.append(np.full(len(w), ids[i], dtype=np.int64))
                        band.append(np.full(len(w), c, dtype=np.uint8))
                    if len(words) >= 4_000:
                        yield _packed(words, owner, band, count)
                        words, owner, band = [], [], []
                if words:
                    yield _packed(words, owner, band, count)

        def unpack(key, table):
            low, ids, c = [], [], []
            for r in table.to_pylist():
                low.append(np.cumsum(_unplanes(r["words"], np.uint32), dtype=np.uint32))
                ids.append(_unplanes(r["ids"], np.uint32 if r["narrow"] else np.int64).astype(np.int64) + r["base"])
                c.append(np.frombuffer(r["bands"], np.uint8))
            low, ids, c = np.concatenate(low), np.concatenate(ids), np.concatenate(c)
            order = np.argsort(low, kind="stable")
            low, ids, c = low[order], ids[order], c[order]
            first = np.flatnonzero(np.r_[True, low[1:] != low[:-1]])
            many = np.repeat(np.diff(np.r_[first, len(low)]) > 1, np.diff(np.r_[first, len(low)]))
            word = low[many].astype(np.int64) | (np.int64(key[0].as_py()) << 32)
            return pa.table({"word": word, "doc": ids[many], "c": c[many].astype(np.int32)})

        packed = self.docs.where("doc is not null").mapInArrow(
            K.trimmed(pack), "bucket int, base long, narrow boolean, words binary, ids binary, bands binary")
        words = self.scratch.table(packed.groupBy("bucket").applyInArrow(unpack, "word long, doc long, c int"), "words")
        return words.join(self.member, "doc").select("word", "rep", "c", "n").distinct()

    def _bound(self, n: Column) -> Column:
        """``Layout.bound`` as an expression."""
        p = self.layout.p
        least = F.floor((n * p + 99) / 100)
        d = F.floor((least + n) * (100 - p) / (100 + p) + F.lit(1e-9))
        return (F.floor((3 * (d + 1) + 19) / F.lit(20)) + 3).cast("long")

    def candidates(self) -> DataFrame:
        """(word, doc, c, bound) after the second filter."""
        shared = self.scratch.table(self._shared_words().withColumn("bound", self._bound(F.col("n"))), "shared")
        often = self.scratch.table(shared.groupBy("word").agg(F.count("*").alias("df")).where("df > 1"), "often")
        known = self.scratch.table(shared.join(often, "word"), "known")
        enough = self.scratch.table(
            known.groupBy("rep", "c").agg(F.count("*").alias("g"), F.first("bound").alias("b")).where("g >= b")
            .select("rep", "c", "g"), "enough")
        known = known.join(enough, ["rep", "c"])
        rank = F.row_number().over(Window.partitionBy("rep", "c").orderBy("df", "word"))
        kept = known.withColumn("rank", rank).where(F.col("rank") <= F.col("g") - F.col("bound") + 1)
        return self.scratch.table(kept.select("word", F.col("rep").alias("doc"), "c", "bound"), "kept")

    # Verification ------------------------------------------------------------------

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """(doc, text) of the documents wanted. A bit filter of fixed size goes to the
        tasks first, so that few other texts are exchanged; the join decides."""
        slot = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS))
        bits = (wanted.withColumn("slot", slot).select(F.floor(F.col("slot") / 32).alias("i"), F.expr("shiftleft(1L, cast(slot % 32 as int))").alias("b"))
                .groupBy("i").agg(F.bit_or("b").alias("b")).toArrow())  # at most FILTER_BITS / 32 rows
        table = np.zeros(FILTER_BITS // 32, dtype=np.int64)
        table[bits.column("i").to_numpy()] = bits.column("b").to_numpy()
        shared = self.scratch.spark.sparkContext.broadcast(table)

        def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                at = b.column(2).to_numpy()
                on = (shared.value[at // 32] >> (at % 32)) & 1
                yield b.filter(pa.array(on.astype(bool)))

        rows = self.docs.where("doc is not null").select("doc", "text", slot.alias("slot"))
        near = rows.mapInArrow(K.trimmed(maybe), "doc long, text string, slot long").drop("slot")
        return self.scratch.table(near.join(wanted, "doc", "left_semi").dropDuplicates(["doc"]), "texts")

    def _links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link, by an exact comparison of their sets."""
        p = self.layout.p

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, held = None, None
            for b in batches:
                for x, y in K.parts(b.column(2)):
                    part = b.slice(x, y - x)
                    a, keep = part.column(0).to_pylist(), []
                    other = sets(part.column(3))
                    text = part.column(2)
                    for i, t in enumerate(other):
                        if a[i] != last:
                            last, held = a[i], next(sets(text.slice(i, 1)))
                        both = len(np.intersect1d(held, t, assume_unique=True))
                        keep.append(bool(both) and 100 * both >= p * (len(held) + len(t) - both))
                    yield part.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

        texts = self.texts
        rows = (pairs.join(texts.select(F.col("doc").alias("b"), F.col("text").alias("tb")), "b")
                .join(texts.select(F.col("doc").alias("a"), F.col("text").alias("ta")), "a")
                .select("a", "b", "ta", "tb"))
        return self.scratch.table(rows.mapInArrow(K.trimmed(compare), "a long, b long"), "links")

    def _labelled(self, words: DataFrame, links: DataFrame | None) -> DataFrame:
        """``words`` with the component of every document so far."""
        if links is None:
            return words.withColumn("comp", F.col("doc"))
        labels = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), self.scratch)
        labels = self.scratch.table(labels, "labels")
        return self.scratch.table(
            words.join(labels.select(F.col("node").alias("doc"), "root"), "doc", "left")
            .withColumn("comp", F.coalesce("root", "doc")).drop("root"), "labelled")

    def _leader_pairs(self, words: DataFrame, turn: int) -> DataFrame:
        """For every document the leader, of another component, that it shares most with."""
        lead = words.groupBy("word").agg(
            F.min_by(F.struct("doc", "comp"), F.xxhash64("doc", F.lit(turn))).alias("l"), F.count("*").alias("df")).where("df > 1")
        lead = self.scratch.table(lead.select("word", F.col("l.doc").alias("a"), F.col("l.comp").alias("comp_a")), "lead")
        met = words.join(lead, "word").where("comp <> comp_a").groupBy("a", "doc").agg(F.count("*").alias("shared"))
        return (met.groupBy("doc").agg(F.max_by("a", F.struct("shared", F.xxhash64("a"))).alias("a"))
                .select("a", F.col("doc").alias("b")))

    def _paired(self, rows: DataFrame, key: str, most_docs: int, most_elements: int) -> DataFrame:
        """``rows`` (``key``, doc, n and more) with ``pair``, ``side`` and ``alone``: the rows
        of a pair are those of one key, or of two blocks of a key that holds more than the
        bounds. Blocks are cut by size level and hash, and only blocks of the same or of
        neighbouring levels meet, since linked sizes differ by one level at most; any two
        documents that may link meet in exactly one pair, on different sides or ``alone``."""
        level = F.floor(F.log("n") / float(np.log(100.5 / self.layout.p))).cast("int")
        rows = rows.withColumn("level", level)
        whole = Window.partitionBy(key)
        order = whole.orderBy("level")
        k = F.ceil(F.greatest(F.col("docs") / most_docs, F.col("elements") / most_elements)).cast("int")
        cut = (rows.groupBy(key, "level").agg(F.count("*").alias("docs"), F.sum("n").alias("elements"))
               .withColumn("over", (F.sum("docs").over(whole) > most_docs) | (F.sum("elements").over(whole) > most_elements))
               .where("over").select(key, "level", k.alias("k")))
        for name, at, step in (("below", F.lag, -1), ("above", F.lead, 1)):
            cut = cut.withColumn(name, F.when(at("level").over(order) == F.col("level") + step, at("k").over(order)).otherwise(0))
        # A row per level of the keys beyond the bounds, written so that Spark knows its size:
        # it is broadcast when that is small, else joined by (key, level).
        cut = self.scratch.table(cut, "cut")
        s = F.pmod(F.xxhash64("doc", F.lit(9)), F.col("k")).cast("int")

        def meets(count: str, la, sa, lb, sb, side) -> Column:
            some = F.filter(F.sequence(F.lit(0), F.greatest(F.col(count), F.lit(1)) - 1), lambda t: t < F.col(count))
            return F.transform(some, lambda t: F.struct(*(
                (f(t) if callable(f) else f).cast("int").alias(x) for f, x in zip((la, sa, lb, sb, side), ("la", "sa", "lb", "sb", "side")))))

        at, own, zero = F.col("level"), F.col("s"), F.lit(0)
        pairs = F.when(F.col("k").isNull(), F.array(F.struct(*(zero.alias(x) for x in ("la", "sa", "lb", "sb", "side"))))).otherwise(F.concat(
            meets("k", at, lambda t: F.least(own, t), at, lambda t: F.greatest(own, t), lambda t: own > t),
            meets("below", at - 1, lambda t: t, at, own, F.lit(1)),
            meets("above", at, own, at + 1, lambda t: t, zero)))
        rows = rows.join(cut, [key, "level"], "left").withColumn("s", s).withColumn("p", F.explode(pairs))
        return (rows.withColumn("pair", F.xxhash64(key, "p.la", "p.sa", "p.lb", "p.sb")).withColumn("side", F.col("p.side"))
                .withColumn("alone", F.expr("p.la = p.lb and p.sa = p.sb")).drop("level", "k", "below", "above", "s", "p"))

    def _open_pairs(self, words: DataFrame) -> DataFrame:
        """Pairs of different components that share a word and may link.

        The documents of a word come together, those of a frequent word as pairs of blocks;
        a task gets a bounded number of them, by rows and by the pairs they make, with the bit
        sketches of their documents, walks through the pairs and returns only those whose sketches differ in no more bits than
        linked sets can. A word whose documents all lie in one component is left out before."""
        mixed = self.scratch.table(words.groupBy("word").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
                                   .where("x <> y").select("word"), "mixed")
        sketches = self.scratch.table(self._bit_sketches(), "sketches")
        rows = words.join(mixed, "word").select("word", "doc", "comp").join(sketches.select("doc", "n"), "doc")
        rows = self._paired(self.scratch.table(rows, "mixedrows"), "word", OPEN_BLOCK, 1 << 62)
        rows = self.scratch.table(rows.select("pair", "side", "alone", "doc", "comp"), "open")
        per_pair = rows.groupBy("pair").agg(F.count("*").alias("r"))
        held = per_pair.agg(F.sum("r").alias("rows"), F.sum(F.col("r") * F.col("r") / 2).alias("meets")).first()
        count = max(1, -(-(held["rows"] or 0) // OPEN_ROWS), math.ceil((held["meets"] or 0) / OPEN_MEETS))
        bucket = F.pmod(F.xxhash64("pair"), F.lit(count)).cast("int").alias("bucket")
        rows = rows.select(bucket, "pair", "side", "alone", "doc", "comp")
        bits = self.scratch.table(rows.select("bucket", "doc").distinct().join(sketches, "doc"), "bits")
        layout = self.layout

        def meet(key, left, right):
            kinds = {"a": pa.int64(), "b": pa.int64()}
            if left.num_rows == 0 or right.num_rows == 0:
                return pa.table({k: pa.array([], t) for k, t in kinds.items()})
            ids, at = np.unique(right.column("doc").to_numpy(), return_index=True)
            n = right.column("n").to_numpy()[at]
            sketch = np.frombuffer(b"".join(right.column("bits").to_pylist()), np.uint64).reshape(-1, SKETCH_BITS // 64)[at]
            pair, comp, side = (left.column(x).to_numpy() for x in ("pair", "comp", "side"))
            alone = left.column("alone").to_numpy()
            doc = np.searchsorted(ids, left.column("doc").to_numpy())
            own = n[doc]
            order = np.lexsort([doc, own, pair])
            pair, comp, doc, side, alone, own = pair[order], comp[order], doc[order], side[order], alone[order], own[order]
            edge = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1], True])
            folded = np.bitwise_xor.reduce(sketch.reshape(len(ids), -1, FOLDED), axis=1)
            found, held, size = [], [], 0
            for x, y in zip(edge[:-1], edge[1:]):
                for r in range(x, y, 512):  # by size: a row meets those after it, up to the largest set that can link
                    to = min(y, r + 512)
                    end = x + int(np.searchsorted(own[x:y], layout.partner(int(own[to - 1])), side="right"))
                    meets = comp[r:to, None] != comp[None, r:end]
                    meets &= 100 * own[r:to, None] >= layout.p * own[None, r:end]
                    if not alone[x]:
                        meets &= side[r:to, None] != side[None, r:end]
                    i, j = np.nonzero(np.triu(meets, 1))
                    a, b = doc[r:to][i], doc[r:end][j]
                    held.append(np.minimum(a, b) * np.int64(len(ids)) + np.maximum(a, b))
                    size += len(i)
                    if size > 1 << 20:
                        found.append(_near(np.concatenate(held), n, sketch, folded, layout))
                        held, size = [], 0
            if held:
                found.append(_near(np.concatenate(held), n, sketch, folded, layout))
            pairs = _distinct(np.concatenate(found))
            return pa.table({"a": ids[pairs // len(ids)], "b": ids[pairs % len(ids)]})

        return (rows.groupBy("bucket").cogroup(bits.groupBy("bucket")).applyInArrow(meet, "a long, b long").distinct())

    def _bit_sketches(self) -> DataFrame:
        """(doc, n, bits): every element of a document's set flips one bit."""
        def flip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                out, n = [], []
                for s in sets(b.column(1)):
                    n.append(len(s))
                    odd = np.bincount((K.mix(s) % U(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
                    out.append(np.packbits(odd.astype(np.uint8)).tobytes())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(out, pa.binary())],
                                                 names=["doc", "n", "bits"])

        return self.texts.select("doc", "text").mapInArrow(K.trimmed(flip), "doc long, n long, bits binary")

    def pairs(self) -> DataFrame:
        """All links (a, b), a < b, between class representatives; with ``member`` they
        say everything. Lists the pairs of large groups too: ``labels`` doesn't."""
        words = self.candidates()
        self.texts = self._texts(words.select("doc").distinct())
        return self._links(self._open_pairs(words.withColumn("comp", F.col("doc"))))

    def labels(self) -> DataFrame:
        """One row per row of the table: id, doc, n (set size), root (the same for the documents
        of a component), component_id."""
        words = self.candidates()
        self.texts = self._texts(words.select("doc").distinct())
        links = None
        for turn in range(ROUNDS + 1):
            now = self._labelled(words, links)
            found = self._links(self._leader_pairs(now, turn) if turn < ROUNDS
                                else self._open_pairs(now))
            links = found if links is None else self.scratch.table(links.unionAll(found), "alllinks")
        roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), self.scratch)
        self.roots = roots = self.scratch.table(roots, "roots")
        low = self.reps.select(F.col("rep").alias("node"), "low")
        least = self.scratch.table(roots.join(low, "node").groupBy("root").agg(F.min("low").alias("least")), "least")
        moved = self.scratch.table(roots.join(least, "root").select(F.col("node").alias("rep"), "root", "least"), "moved")
        named = self.scratch.table(
            self.member.join(moved, "rep", "left")
            .select("doc", F.coalesce("root", "rep").alias("root"), F.coalesce("least", "low").alias("comp")), "named")
        own = F.col("n") > 0
        return (self.sizes.join(named, "doc", "left")
                .select("id", "doc", "n", F.when(own, F.col("root")).otherwise(F.col("doc")).alias("root"),
                        F.when(own, F.col("comp")).otherwise(F.col("id")).alias("component_id")))

    def degrees(self) -> DataFrame:
        """(doc, n_links) after ``labels``: the other documents that one links with.

        Links lie inside components, so the classes of a component meet there, those of a
        large one as pairs of blocks, and their sets are compared exactly. A task returns
        a row per class of a block, not its pairs; a class counts as many documents as it has."""
        sizes = self.scratch.table(self.member.groupBy("rep").agg(F.count("doc").alias("w"), F.max("n").alias("n")), "classes")
        rows = (self.roots.select(F.col("node").alias("rep"), F.col("root").alias("comp")).join(sizes, "rep")
                .withColumnRenamed("rep", "doc"))
        rows = self._paired(self.scratch.table(rows, "grouped"), "comp", LINK_BLOCK, LINK_ELEMENTS)
        rows = rows.select("pair", "side", "alone", "doc", "w")

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in sets(b.column(1))], pa.binary())],
                                                 names=["doc", "elements"])

        own = self.texts.join(self.roots.select(F.col("node").alias("doc")), "doc", "left_semi").select("doc", "text")
        own = self.scratch.table(own.mapInArrow(K.trimmed(pack), "doc long, elements binary"), "elements")
        p = self.layout.p

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last, held = None, []  # the pair that the rows belong to
            done = []
            for b in batches:
                for pair, side, alone, doc, w, e in zip(*(b.column(i).to_pylist() for i in range(6))):
                    if pair != last and held:
                        done += _counted(held, p)
                        held = []
                    last = pair
                    held.append((side, alone, doc, w, np.frombuffer(e, np.uint64)))
                if done:
                    yield _rows(done)
                    done = []
            if held:
                yield _rows(_counted(held, p))

        met = rows.join(own, "doc").select("pair", "side", "alone", "doc", "w", "elements")
        met = met.repartition("pair").sortWithinPartitions("pair").mapInArrow(K.trimmed(count), "doc long, links long")
        linked = self.scratch.table(met.groupBy(F.col("doc").alias("rep")).agg(F.sum("links").alias("links")), "linked")
        every = self.scratch.table(
            sizes.join(linked, "rep", "left").select("rep", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "degree")
        return self.scratch.table(self.member.join(every, "rep").select("doc", "n_links"), "degrees")


def _counted(rows: list, percent: int) -> list[tuple[int, int]]:
    """(doc, documents it links with) of the rows (side, alone, doc, weight, set) of one pair."""
    side = np.array([r[0] for r in rows])
    w = np.array([r[3] for r in rows], dtype=np.int64)
    n = np.array([len(r[4]) for r in rows], dtype=np.int64)
    owner = np.repeat(np.arange(len(rows)), n)
    _, column, often = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True, return_counts=True)
    shared = often[column] > 1  # elements of one set only never meet
    owner, column = owner[shared], (np.cumsum(often > 1) - 1)[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(rows), len(rows)), dtype=np.int64)
    columns = int(column[-1]) + 1 if len(column) else 0
    width = min(max(64, (1 << 22) // len(rows)), columns)
    for at in range(0, columns, max(1, width)):
        x, y = np.searchsorted(column, (at, at + width))
        on = np.zeros((len(rows), width), dtype=np.float32)
        on[owner[x:y], column[x:y] - at] = 1
        both += (on @ on.T).astype(np.int64)  # sums below 2^24: exact
    link = (both > 0) & (100 * both >= percent * (n[:, None] + n[None, :] - both))
    np.fill_diagonal(link, False)
    if not rows[0][1]:
        link &= side[:, None] != side[None, :]
    return [(r[2], c) for r, c in zip(rows, (link @ w).tolist()) if c]


def _rows(counts: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)], names=["doc", "links"])


def _near(pairs: np.ndarray, n, sketch, folded, layout: Layout) -> np.ndarray:
    """The pairs (place of a times number of documents, plus place of b) whose bit sketches
    differ in no more bits than linked sets of their sizes can. Sketches folded onto each
    other differ in no more bits than they do, so most pairs need no more than those."""
    pairs = _distinct(pairs)
    keep = []
    for at in range(0, len(pairs), 1 << 14):
        part = pairs[at:at + (1 << 14)]
        for bits in (folded, sketch):
            a, b = part // len(n), part % len(n)
            apart = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1, dtype=np.int64)
            part = part[apart <= (100 - layout.p) * (n[a] + n[b]) // (100 + layout.p)]
        keep.append(part)
    return np.concatenate([np.zeros(0, np.int64), *keep])


def _packed(words: list, owner: list, band: list, count: int) -> pa.RecordBatch:
    """Rows (bucket, base, narrow, words, ids, bands): a batch's words by bucket, sorted
    and stored as differences; ids as differences from the least."""
    words, owner, band = np.concatenate(words), np.concatenate(owner), np.concatenate(band)
    bucket = ((words >> U(32)) * U(count)) >> U(32)
    low = (words & U(0xFFFFFFFF)).astype(np.uint32)
    order = np.lexsort([low, bucket])
    bucket, low, owner, band = bucket[order].astype(np.int64), low[order], owner[order], band[order]
    base = int(owner.min())
    narrow = int(owner.max()) - base < 1 << 32
    owner = (owner - base).astype(np.uint32 if narrow else np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    rows = [(int(bucket[a]), base, narrow, _planes(np.diff(low[a:b], prepend=np.uint32(0)).astype(np.uint32)),
             _planes(owner[a:b]), band[a:b].tobytes()) for a, b in zip(first, np.r_[first[1:], len(bucket)])]
    kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=["bucket", "base", "narrow", "words", "ids", "bands"])


def classes(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
            percent: int = 75) -> DataFrame:
    """id, n_shingles, component_id (least id reachable by links), n_links (other documents
    it links with; 0 without shingles, null for a null id) of every document."""
    join = Join(docs, spark, id_col, text_col, percent)
    found = join.labels()
    return found.join(join.degrees(), "doc", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("n_links")).otherwise(0)).alias("n_links"))


def keep_one(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
             percent: int = 75) -> DataFrame:
    """``docs`` with one document of each component, the one of the least id (of several
    documents of that id, and of several rows of it, one that depends on the texts alone).
    Verdicts are per text: a row goes only if its own text is a near copy of one that
    stays, or the same document again. Rows with a null id stay."""
    join, scratch = Join(docs, spark, id_col, text_col, percent), Scratch(spark, "copies")
    found = scratch.table(join.labels().where("id is not null"), "found")
    stays = found.groupBy("root").agg(F.min(F.struct("id", "doc")).alias("s")).select(F.col("s.doc").alias("doc"))
    per_doc = found.groupBy("doc").agg(F.count("*").alias("rows"))
    marks = scratch.table(per_doc.join(stays.distinct().withColumn("stays", F.lit(True)), "doc", "left"), "marks")
    gone = scratch.table(marks.where("stays is null").select("doc"), "gone")
    again = scratch.table(marks.where("stays and rows > 1").select("doc"), "again")
    # the row travels as one struct: no name of a helper column can clash with its own
    rows = join.told(docs.select(F.struct("*").alias("row"), F.col(id_col).cast("bigint").alias("id"),
                                 F.col(text_col).alias("text")))
    left = rows.join(gone, "doc", "left_anti")
    first = F.row_number().over(Window.partitionBy("doc").orderBy("text"))
    one = left.join(again, "doc", "left_semi").withColumn("first", first).where("first = 1")
    return left.join(again, "doc", "left_anti").select("row.*").unionAll(one.select("row.*"))
