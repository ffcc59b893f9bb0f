"""Gated recurrent language model for scoring whole documents.

Tokens are lower-cased (A-Z) words and one end. The output is factored by classes: the
softmax over classes depends on the recurrent state; inside a class of frequent words a
second softmax does too; the words of every other class (told apart by their shape: last
character, length, first accented character) share the class's probability by their
counts in training, one count being kept for words never seen. So every token has a
probability above 0 and they sum to 1, whatever the vocabulary.

Training: truncated backpropagation in numpy. Documents run in parallel lanes, windows of
``WINDOW`` tokens are learnt one after another with the state carried over, reset at the
start of a document (and of every 512th token of a long one, in training). Training
documents are written once as symbols and dealt, by a hash of their id and text, to groups
of about ``GROUP`` tokens; a copy is trained on each group, in the order of that hash, and
copies are averaged by tokens. That is repeated over three disjoint slices of the training
documents, so every training document is learnt from once, and neither the partitions nor
the batches of the input move the model beyond rounding (but for rows that repeat one id
and text over 64 times in a task: those are dealt on, so that no group outgrows a task).
The copy's size is fixed; word counts cover all training documents and are never gathered
in one place.

Scoring: documents are dealt to ranges of ids; each range asks for the counts of its own
words, which are joined to it, and carries the state from window to window, so that the
sum is the log-likelihood of the complete document.

Defined cases: a null or empty text is the end alone; a document with a null id is learnt
from and scored; repeated rows count and are scored each; an empty table gives no rows;
other columns are ignored. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eddy.llm import textkernel as K
from eddy.llm.scratch import Scratch
from eddy.llm.sketch import bucket_of, id_bounds

H = 32                 # width of the state
MEMBERS = 16           # frequent words in a class
HEADS = 15             # classes of frequent words; the first holds the end
SHAPES = 48            # classes of all other words
CLASSES = HEADS + SHAPES
SYMBOLS = HEADS * MEMBERS + SHAPES + 1   # inputs: frequent words, shapes, start
START = SYMBOLS - 1
LANES = 64             # with WINDOW: an update for about 1,024 tokens
WINDOW = 16            # how far back gradients go
BESIDE = 128           # lanes scored side by side
PIECE = 512            # tokens of a document that are learnt in one lane
GROUP = 1 << 18        # tokens a copy of the net is trained on, about
TASKS = 16_384         # tasks that train, at most; each adds up its copies
STEP = 768             # tokens that a step of the optimiser gathers, at least
SLICES = ((0, 1), (1, 4), (4, 12))  # of 12: what the rounds learn from
END = np.uint64(0)     # the end's place among the word hashes

_LAST = np.zeros(256, dtype=np.int64)
_LAST[[ord(c) for c in ".!?;:"]] = 1
_LAST[ord(",")] = 2
_LAST[48:58] = 3
_LAST[[ord(c) for c in "#*$%&|<>()[]{}\"'/\\+=-_@^~`"]] = 4


def shapes(w: K.Words, of: np.ndarray | slice = slice(None)) -> np.ndarray:
    """The shape class, 0 to ``SHAPES`` - 1, of every word (of the words at ``of``)."""
    start, end = w.start[of], w.end[of]
    if not len(start):
        return np.zeros(0, dtype=np.int64)
    last = _LAST[w.data[end - 1]]
    length = np.digitize(end - start, (4, 7))
    out = last * 3 + length
    lead = np.flatnonzero(w.data >= 0xC0)
    if len(lead):
        i = np.searchsorted(lead, start)
        at = lead[np.minimum(i, len(lead) - 1)]
        wide = (i < len(lead)) & (at < end)
        accent = w.data[np.minimum(at + 1, len(w.data) - 1)] % 16
        out = np.where(wide, 15 + accent * 2 + (last > 0), out)
    return out


def _sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * x))


class Net:
    """Parameters in one vector, with views of its parts."""

    PARTS = {"wx": (SYMBOLS, 3 * H), "u": (H, 3 * H), "un": (3 * H,), "wc": (H, CLASSES), "bc": (CLASSES,),
             "wm": (HEADS, H, MEMBERS), "bm": (HEADS, MEMBERS)}
    SIZE = sum(math.prod(s) for s in PARTS.values())

    def __init__(self, flat: np.ndarray):
        self.flat, at = flat, 0
        for name, shape in self.PARTS.items():
            n = math.prod(shape)
            setattr(self, name, flat[at:at + n].reshape(shape))
            at += n

    @classmethod
    def start(cls, class_prior: np.ndarray, member_prior: np.ndarray) -> Net:
        """Small random weights; biases that give the words' counted frequencies."""
        rng = np.random.default_rng(11)
        net = cls(np.zeros(cls.SIZE, dtype=np.float32))
        net.wx[:] = rng.normal(0, 0.3, net.wx.shape)
        net.u[:] = rng.normal(0, 1 / np.sqrt(H), net.u.shape)
        net.un[:H] = 1.0  # remember at first
        net.bc[:], net.bm[:] = np.log(class_prior), np.log(member_prior)
        return net

    def log_token(self, h: np.ndarray, cls: np.ndarray, member: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """Natural log probability of tokens given as class, member (frequent words) or
        log share within the class (``tail``, others)."""
        x = self.wc.T @ h.T  # classes x tokens
        x += self.bc[:, None]
        x -= x.max(axis=0)
        out = x[cls, np.arange(len(cls))].astype(np.float64)
        out -= np.log(np.exp(x, out=x).sum(axis=0))
        i, edge = _by_class(cls)
        out += np.where(cls < HEADS, 0.0, tail)
        if len(i):
            own, y = h[i], np.repeat(self.bm.T, np.diff(edge), axis=1)  # members x tokens
            for k in np.flatnonzero(np.diff(edge)).tolist():
                at = slice(edge[k], edge[k + 1])
                y[:, at] += self.wm[k].T @ own[at].T
            y -= y.max(axis=0)
            picked = y[member[i], np.arange(len(i))]
            out[i] += picked - np.log(np.exp(y, out=y).sum(axis=0))
        return out


class Cell:
    """The gated unit of a net, gate by gate (forget, reset, new), so that every array is
    contiguous. The weights of the first two are negated, for a logistic is 1 / (1 + exp(-x));
    a sum so large that the exponential would overflow means a gate of 0 all the same."""

    def __init__(self, net: Net):
        self.u = net.u.reshape(H, 3, H).transpose(1, 0, 2).copy()
        self.given = (net.wx + net.un).reshape(SYMBOLS, 3, H).transpose(1, 0, 2).copy()
        np.negative(self.u[:2], out=self.u[:2])
        np.negative(self.given[:2], out=self.given[:2])

    def step(self, x: np.ndarray, h: np.ndarray, b: np.ndarray, zr: np.ndarray, n: np.ndarray, out: np.ndarray) -> None:
        """The state after symbols ``x`` into ``out``; the state's shares of the sums into
        ``b``, the gates into ``zr`` and ``n``."""
        np.matmul(h, self.u, out=b)
        given = self.given.take(x, axis=1)
        np.add(b[:2], given[:2], out=zr)
        np.minimum(zr, 80.0, out=zr)
        np.exp(zr, out=zr)
        zr += 1.0
        np.reciprocal(zr, out=zr)
        np.multiply(zr[1], b[2], out=n)
        n += given[2]
        np.tanh(n, out=n)
        np.subtract(h, n, out=out)
        out *= zr[0]
        out += n


def _by_class(cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of tokens of frequent words' classes, class by class, and where each begins."""
    i = np.flatnonzero(cls < HEADS)
    i = i[np.argsort(cls[i].astype(np.int8), kind="stable")]
    return i, np.searchsorted(cls[i], np.arange(HEADS + 1))


def gradient(net: Net, x, first, cls, member, on, h0):
    """Gradient of the summed negative log probability of one window, that sum without
    the fixed shares inside shape classes, and the state after it. Arrays are step x lane;
    ``first`` marks document starts (state 0), ``on`` the tokens that count."""
    steps, lanes = x.shape
    kind = net.flat.dtype
    g, cell = Net(np.zeros(Net.SIZE, dtype=kind)), Cell(net)
    states = np.empty((steps + 1, lanes, H), dtype=kind)
    n, b = np.empty((steps, lanes, H), dtype=kind), np.empty((steps, 3, lanes, H), dtype=kind)
    zr = np.empty((steps, 2, lanes, H), dtype=kind)
    starts = first.any(axis=1).tolist()
    states[0] = h0
    for t in range(steps):
        h = states[t]
        if starts[t]:
            h = h.copy()
            h[first[t]] = 0
        cell.step(x[t], h, b[t], zr[t], n[t], states[t + 1])
    before, states = states[:-1], states[1:]
    if any(starts):
        before = before.copy()
        before[first] = 0
    flat = states.reshape(-1, H)
    c, m = cls.ravel(), member.ravel()
    w = on.ravel().astype(kind)
    rows = np.arange(len(c))
    d = net.wc.T @ flat.T  # classes x tokens
    d += net.bc[:, None]
    d -= d.max(axis=0)
    picked = d[c, rows]
    np.exp(d, out=d)
    total = d.sum(axis=0)
    loss = -((picked - np.log(total)) * w).sum()
    d *= w / total
    d[c, rows] -= w
    g.wc[:], g.bc[:] = (d @ flat).T, d.sum(axis=1)
    dh_out = d.T @ net.wc.T
    i, edge = _by_class(np.where(on.ravel(), c, CLASSES))
    if len(i):
        own, k, m = flat[i], np.arange(len(i)), m[i]
        used = [(j, slice(edge[j], edge[j + 1])) for j in np.flatnonzero(np.diff(edge)).tolist()]
        y = np.repeat(net.bm.T, np.diff(edge), axis=1)  # members x tokens
        for j, at in used:
            y[:, at] += net.wm[j].T @ own[at].T
        y -= y.max(axis=0)
        picked = y[m, k]
        np.exp(y, out=y)
        total = y.sum(axis=0)
        loss -= (picked - np.log(total)).sum()
        y /= total
        y[m, k] -= 1
        back = np.empty_like(own)
        for j, at in used:
            np.matmul(own[at].T, y[:, at].T, out=g.wm[j])
            np.matmul(y[:, at].T, net.wm[j].T, out=back[at])
        some = [j for j, _ in used]
        g.bm[some] = np.add.reduceat(y, edge[some], axis=1).T
        dh_out[i] += back
    dh_out = dh_out.reshape(steps, lanes, H)
    # What a change of the state does to the gates' sums, for all steps at once.
    z, r = zr[:, 0], zr[:, 1]
    to_n = (1 - z) * (1 - n * n)
    to = np.empty((steps, lanes, 3, H), dtype=kind)
    to[:, :, 0] = (before - n) * z * (1 - z)
    to_r = to_n * r
    to[:, :, 2] = to_r
    to_r *= b[:, 2]
    to_r *= 1 - r
    to[:, :, 1] = to_r
    back = net.u.T.copy()
    dhs, part = np.empty((steps, lanes, H), dtype=kind), np.empty((lanes, H), dtype=kind)
    dh = np.zeros((lanes, H), dtype=kind)
    for t in reversed(range(steps)):
        np.add(dh, dh_out[t], out=dhs[t])
        to[t] *= dhs[t][:, None]
        np.multiply(dhs[t], z[t], out=dh)
        np.matmul(to[t].reshape(lanes, 3 * H), back, out=part)
        dh += part
        if starts[t]:
            dh[first[t]] = 0
    da = to.reshape(-1, 3 * H)
    np.matmul(before.reshape(-1, H).T, da, out=g.u)
    to[:, :, 2] = dhs * to_n
    # Sorted by symbol, runs of equal symbols are added up; two floats at a time.
    order = np.argsort(x.ravel().astype(np.int16), kind="stable")
    symbols, at = np.unique(x.ravel()[order], return_index=True)
    pair = np.complex64 if kind == np.float32 else np.complex128
    g.wx[symbols] = np.add.reduceat(da[order].view(pair), at, axis=0).view(kind)
    g.un[:] = g.wx.sum(axis=0)
    return g.flat, float(loss), states[-1]


class Trainer:
    """Adam over windows, one after another."""

    def __init__(self, flat: np.ndarray, rate: float):
        self.net, self.rate = Net(flat.copy()), rate
        self.m, self.v, self.n, self.tokens = np.zeros_like(flat), np.zeros_like(flat), 0, 0
        self.held_g, self.held = None, 0  # gradients gathered for the next step

    def learn(self, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """``docs``: (inputs, classes, members) of documents. Pieces of ``PIECE`` tokens at
        most are dealt to the lanes in a fixed random order, so that neither a long
        document nor the order of the input rules a step."""
        pieces = [(d, a) for d in range(len(docs)) for a in range(0, len(docs[d][0]), PIECE)]
        order = np.random.default_rng(len(pieces)).permutation(len(pieces))
        load, lanes = np.zeros(LANES, dtype=np.int64), [[] for _ in range(LANES)]
        for i in order:
            k = int(load.argmin())
            d, a = pieces[i]
            lanes[k].append((d, a))
            load[k] += min(PIECE, len(docs[d][0]) - a)
        steps = -(-int(load.max()) // WINDOW) * WINDOW
        x = np.full((steps, LANES), START, np.int16)
        cls, member = np.zeros((steps, LANES), np.int16), np.zeros((steps, LANES), np.int16)
        first, on = np.zeros((steps, LANES), bool), np.zeros((steps, LANES), bool)
        for k, own in enumerate(lanes):
            at = 0
            for d, a in own:
                n = min(PIECE, len(docs[d][0]) - a)
                x[at:at + n, k], cls[at:at + n, k], member[at:at + n, k] = (v[a:a + n] for v in docs[d])
                first[at, k], on[at:at + n, k] = True, True
                at += n
        h = np.zeros((LANES, H), dtype=np.float32)
        for at in range(0, steps, WINDOW):
            w = slice(at, at + WINDOW)
            live = np.flatnonzero(on[w].any(axis=0))
            live = slice(None) if len(live) == LANES else live
            g, _, state = gradient(self.net, x[w][:, live], first[w][:, live], cls[w][:, live], member[w][:, live],
                                   on[w][:, live], h[live])
            h[live] = state
            if self.held_g is None:
                self.held_g = g
            else:
                self.held_g += g
            self.held += int(np.count_nonzero(on[w]))
            if self.held >= STEP or at + WINDOW >= steps and self.held >= STEP // 2:
                self._apply(1.0)

    def finish(self) -> None:
        """Learns from what is still held at the end of a task, by a step in proportion to
        its tokens."""
        if self.held:
            self._apply(min(1.0, self.held / STEP))

    def _apply(self, share: float) -> None:
        self._update(self.held_g, share)
        self.tokens += self.held
        self.held_g, self.held = None, 0

    def _update(self, g: np.ndarray, share: float) -> None:
        """A step along the mean of the gathered gradients (``g``, overwritten), of length 1 at
        most. ``m`` and ``v`` hold Adam's means times 10 and 100."""
        mean = 1.0 / self.held
        g *= mean * min(1.0, 1.0 / (float(np.sqrt(g @ g)) * mean + 1e-9))
        self.n += 1
        self.m *= 0.9
        self.m += g
        self.v *= 0.99
        g *= g
        self.v += g
        np.sqrt(self.v, out=g)
        scale = 0.1 / np.sqrt(1 - 0.99 ** self.n)
        g += 1e-6 / scale
        np.divide(self.m, g, out=g)
        g *= 0.1 / scale * self.rate * share * min(1.0, self.n / 20) / (1 - 0.9 ** self.n)
        self.net.flat -= g


def _trained(batches: Iterator[pa.RecordBatch], start: np.ndarray, rate: float) -> Iterator[Trainer]:
    """A trainer for each group of rows (group, key, symbols), which come sorted. Documents
    are learnt about ``GROUP`` tokens at a time, wherever batches end."""
    group, trainer, docs, held = None, None, [], 0
    for batch in batches:
        for g, codes in zip(batch.column(0).to_pylist(), batch.column(2)):
            if trainer is None or g != group or held >= GROUP:
                if docs:
                    trainer.learn(docs)
                docs, held = [], 0
                if g != group or trainer is None:
                    if trainer is not None:
                        trainer.finish()
                        yield trainer
                    group, trainer = g, Trainer(start, rate)
            symbol = np.frombuffer(codes.as_buffer() or b"", "<u2").astype(np.int16)
            head = symbol < HEADS * MEMBERS
            docs.append((np.append(np.int16(START), symbol),
                         np.append(np.where(head, symbol // MEMBERS, symbol - HEADS * MEMBERS + HEADS), np.int16(0)),
                         np.append(np.where(head, symbol % MEMBERS, 0), np.int16(0))))
            held += len(symbol) + 1
    if trainer is not None:
        if docs:
            trainer.learn(docs)
        trainer.finish()
        yield trainer


class Heads:
    """The frequent words: sorted hashes and their numbers (class * MEMBERS + member).
    Number 0 is the end's."""

    def __init__(self, ranked: list[int]):
        h = np.array(ranked, dtype=np.int64).view(np.uint64)
        order = np.argsort(h)
        self.hash, self.number = h[order], (order + 1).astype(np.int64)

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for other words."""
        if not len(self.hash):
            return np.full(len(h), -1, dtype=np.int64)
        i = np.minimum(np.searchsorted(self.hash, h), len(self.hash) - 1)
        return np.where(self.hash[i] == h, self.number[i], -1)


def _targets(head: np.ndarray, shape: np.ndarray):
    """(class, member, symbol) of words."""
    on = head >= 0
    return (np.where(on, head // MEMBERS, HEADS + shape), np.where(on, head % MEMBERS, 0),
            np.where(on, head, HEADS * MEMBERS + shape))


def _with_end(x: np.ndarray, end) -> np.ndarray:
    return np.append(x, end)


class Model:
    """Counts of the training tokens, frequent words and the trained net. What is held
    here has a fixed size; the counts of all words stay a table (``counts``)."""

    def __init__(self, docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text",
                 held_out: int = 2, folds: int = 7, bucket_bytes: int = 8 << 20):
        self.scratch = Scratch(spark, "lm")
        fold = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
        docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                           F.coalesce(fold == held_out, F.lit(False)).alias("held"))
        bounds = id_bounds(docs, "id", F.octet_length("text"), bucket_bytes)
        self.docs = docs.withColumn("b", bucket_of(F.col("id"), bounds))
        self._count()

    def _count(self) -> None:
        def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """The distinct words of each range of ids, with their training counts."""
            for batch in batches:
                text, held = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
                bucket = batch.column(2).to_numpy()
                for x, y in K.parts(text, 16 << 20):
                    w = K.words(text.slice(x, y - x))
                    n = np.diff(w.first)
                    where, train = np.repeat(bucket[x:y], n), np.repeat(~held[x:y], n)
                    for b in np.unique(bucket[x:y]):
                        i = np.flatnonzero(where == b)
                        i = i[np.argsort(w.hash[i])]  # any one of a word's places tells its shape
                        h = w.hash[i]
                        at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][:len(h)])
                        c = np.add.reduceat(train[i], at, dtype=np.int64) if len(h) else np.zeros(0, np.int64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), b, np.int32)), pa.array(h[at].view(np.int64)),
                             pa.array(shapes(w, i[at]).astype(np.int8)), pa.array(c)], names=["b", "word", "shape", "n"])

        words = self.docs.select("text", "held", "b").mapInArrow(asked, "b int, word long, shape byte, n long")
        # A word's group here has a row for each range and batch, however often it occurs.
        c = F.sum("n").over(Window.partitionBy("word"))
        one = F.row_number().over(Window.partitionBy("word").orderBy("b"))
        # The finer order first, so that one sort serves both.
        self.counts = self.scratch.table(
            words.withColumn("one", one == 1).withColumn("c", c).select("b", "word", "shape", "c", "one"), "counts")
        seen = self.counts.where("one and c > 0")
        self.ends = self.docs.where("not held").count()
        top = seen.orderBy(F.desc("c"), "word").limit(HEADS * MEMBERS - 1).select("word", "c").collect()
        r = seen.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
        self.tokens = (r["n"] or 0) + self.ends
        self.types = r["v"] + (self.ends > 0)
        self.heads = Heads([x["word"] for x in top])
        mass = np.zeros(SHAPES)  # of c + 1 over the words of a shape that are not frequent ones
        plain = np.zeros(SHAPES)
        rest = seen.join(F.broadcast(spark_words(self.scratch.spark, top)), "word", "left_anti") if top else seen
        for x in rest.groupBy("shape").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
            mass[x["shape"]], plain[x["shape"]] = x["c"] + x["v"], x["c"]
        self.log_mass = np.log(mass + 1.0)
        member = np.full((HEADS * MEMBERS), 0.5)
        member[0] += self.ends
        member[1:len(top) + 1] += [x["c"] for x in top]
        member = member.reshape(HEADS, MEMBERS)
        prior = np.concatenate([member.sum(axis=1), plain + 0.5])
        self.net = Net.start(prior / prior.sum(), member / member.sum(axis=1, keepdims=True)).flat

    def _codes(self) -> DataFrame:
        """The training documents, split once: slice, key (of id and text) and symbols."""
        heads = self.heads

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = Counter()  # how often each key came up in this task
            for batch in batches:
                text, part, key = batch.column(0), batch.column(1), batch.column(2).to_pylist()
                again = []
                for k in key:
                    again.append(seen[k] // 64)
                    seen[k] += 1
                for x, y in K.parts(text):
                    w = K.words(text.slice(x, y - x))
                    symbol = heads.numbers(w.hash)
                    rest = np.flatnonzero(symbol < 0)
                    symbol[rest] = HEADS * MEMBERS + shapes(w, rest)
                    symbol = symbol.astype("<u2")
                    codes = pa.Array.from_buffers(pa.binary(), y - x, [
                        None, pa.py_buffer((w.first * 2).astype(np.int32)), pa.py_buffer(symbol)])
                    yield pa.RecordBatch.from_arrays([part.slice(x, y - x), batch.column(2).slice(x, y - x),
                                                      pa.array(again[x:y], pa.int32()), codes],
                                                     names=["part", "key", "again", "codes"])

        part = F.coalesce(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(12)), F.lit(0)).cast("int")
        return self.scratch.table(
            self.docs.where("not held").select("text", part.alias("part"), F.xxhash64("id", "text").alias("key"))
            .mapInArrow(code, "part int, key long, again int, codes binary"), "codes")

    def train(self, rates: tuple[float, ...] = (0.01, 0.006, 0.003)) -> None:
        """Three rounds, each over its slice of the training documents."""
        codes = self._codes()
        tokens = {r["part"]: r["n"] for r in
                  codes.groupBy("part").agg(F.sum(F.octet_length("codes") / 2 + 1).alias("n")).collect()}
        for (low, high), rate in zip(SLICES, rates):
            start = self.net
            groups = max(1, round(sum(tokens.get(k, 0) for k in range(low, high)) / GROUP))

            def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums, done = np.zeros(len(start), np.float64), 0
                with K.pages_kept():
                    for trainer in _trained(batches, start, rate):
                        sums += trainer.net.flat.astype(np.float64) * trainer.tokens
                        done += trainer.tokens
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array([done]), pa.array([sums.tobytes()], pa.binary())],
                                                     names=["tokens", "flat"])

            def add(table):
                total = sum(np.frombuffer(f, np.float64) for f in table.column("flat").to_pylist())
                return pa.table({"tokens": [sum(table.column("tokens").to_pylist())],
                                 "flat": pa.array([total.tobytes()], pa.binary())})

            kind = "tokens long, flat binary"
            own = (codes.where((F.col("part") >= low) & (F.col("part") < high))
                   .select(F.pmod(F.xxhash64("key", "again"), F.lit(groups)).alias("g"), "key", "codes")
                   .repartition(min(groups, TASKS), "g").sortWithinPartitions("g", "key").mapInArrow(learn, kind))
            # A sum for each task; 256 tasks at most add those up, the driver adds their sums of fixed size.
            sums = own.withColumn("g", F.spark_partition_id() % 256).groupBy("g").applyInArrow(add, kind).collect()
            if sums:
                sums.sort(key=lambda r: (r["tokens"], bytes(r["flat"])))
                total = sum(np.frombuffer(bytes(r["flat"]), np.float64) for r in sums)
                self.net = (total / sum(r["tokens"] for r in sums)).astype(np.float32)

    def score(self) -> DataFrame:
        """id, held, n_tokens, n_known, base_score, score per document."""
        heads, log_mass, flat = self.heads, self.log_mass, self.net
        base = np.log10(self.tokens + self.types + 1.0)
        ends, kind = self.ends, "id long, held boolean, n_tokens long, n_known long, base_score double, score double"

        def run(key, docs, counts):
            net = Net(flat)
            word = counts.column("word").to_numpy().view(np.uint64)
            order = np.argsort(word)
            word = word[order]
            keep = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else order
            word, c, shape = word[keep], counts.column("c").to_numpy()[order][keep], counts.column("shape").to_numpy()[order][keep]
            cls, member, symbol = (x.astype(np.int16) for x in _targets(heads.numbers(word), shape.astype(np.int64)))
            tail = np.log(c + 1.0) - log_mass[shape.astype(np.int64)]
            size, known, low, high = [], [], [], []
            text = docs.column("text").combine_chunks()
            for x, y in K.parts(text, 16 << 20):  # the more texts run side by side, the fewer steps are narrow
                w = K.words(text.slice(x, y - x))
                at = np.searchsorted(word, w.hash)
                n = np.diff(w.first)
                of = np.repeat(np.arange(y - x), n)
                known.append(np.bincount(of, weights=c[at] > 0, minlength=y - x).astype(np.int64) + (ends > 0))
                low.append(np.bincount(of, weights=np.log10(c[at] + 1.0), minlength=y - x) + np.log10(ends + 1.0) - (n + 1) * base)
                size.append(n + 1)
                high.append(_log_likelihood(net, w.first, cls[at], member[at], symbol[at], tail[at]) / np.log(10.0))
            return pa.table({"id": docs.column("id"), "held": docs.column("held"),
                             "n_tokens": np.concatenate(size).astype(np.int64), "n_known": np.concatenate(known),
                             "base_score": np.concatenate(low), "score": np.concatenate(high)})

        def guarded(key, docs, counts):
            if docs.num_rows == 0:
                return pa.table({"id": pa.array([], pa.int64()), "held": pa.array([], pa.bool_()),
                                 "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()),
                                 "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
            with K.pages_kept():
                return run(key, docs, counts)

        return (self.docs.select("b", "id", "held", "text").groupBy("b")
                .cogroup(self.counts.select("b", "word", "shape", "c").groupBy("b")).applyInArrow(guarded, kind))


def spark_words(spark: SparkSession, top: list) -> DataFrame:
    """The frequent words as a table (a fixed number of rows)."""
    return spark.createDataFrame([(x["word"],) for x in top], "word long")


def _lanes(size: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts dealt to lanes, the longest first and each to the lane with the least tokens:
    (order, load), the texts lane by lane and the lanes' tokens, the longest lane first."""
    heap, own = [(0, k) for k in range(lanes)], [[] for _ in range(lanes)]
    for d in np.argsort(-size, kind="stable").tolist():
        load, k = heap[0]
        own[k].append(d)
        heapq.heapreplace(heap, (load + int(size[d]), k))
    heap.sort(reverse=True)
    return np.array([d for _, k in heap for d in own[k]], dtype=np.int64), np.array([n for n, _ in heap], dtype=np.int64)


def _log_likelihood(net: Net, first, cls, member, symbol, tail) -> np.ndarray:
    """Natural log probability of every text, the end included. Lanes run side by side, each
    through its texts one after another; the state is carried from window to window and
    begins anew with a text."""
    n = np.diff(first)
    if not len(n):
        return np.zeros(0)
    order, load = _lanes(n + 1, min(BESIDE, len(n)))
    size = n[order] + 1
    begin = np.cumsum(size) - size  # of a text among all tokens, lane by lane
    owner = np.repeat(order.astype(np.int32), size)
    goal = np.arange(len(owner), dtype=np.int32) + np.repeat((first[:-1][order] - begin).astype(np.int32), size)
    goal[begin + size - 1] = len(cls)  # the end
    given = _with_end(symbol, symbol.dtype.type(START))[np.roll(goal, 1)]
    given[begin] = START
    fresh = np.zeros(len(owner), dtype=bool)
    fresh[begin] = True
    cls, member, tail = (_with_end(x, x.dtype.type(0))[goal] for x in (cls, member, tail))
    del goal
    got = np.empty(len(owner))
    start = np.cumsum(load) - load
    states = np.zeros((WINDOW + 1, len(load), H), dtype=np.float32)
    gates = np.empty((6, len(load), H), dtype=np.float32)
    cell = Cell(net)
    for t in range(0, int(load[0]), WINDOW):
        steps = min(WINDOW, int(load[0]) - t)
        live = int(np.searchsorted(-load, -t, side="left"))  # lanes with more than t tokens
        if live < states.shape[1]:
            states, gates = states[:, :live].copy(), gates[:, :live].copy()
        k = np.arange(t, t + steps)[:, None]
        on = k < load[:live]
        at = np.minimum(start[:live] + k, len(owner) - 1)  # a lane that has ended goes on idly to the window's end
        x, anew = given[at], fresh[at]
        starts = anew.any(axis=1).tolist()
        for j in range(steps):
            h = states[j]
            if starts[j]:
                h = h.copy()
                h[anew[j]] = 0
            cell.step(x[j], h, gates[:3], gates[3:5], gates[5], states[j + 1])
        at = at[on]
        got[at] = net.log_token(states[1:steps + 1][on], cls[at], member[at], tail[at])
        states[0] = states[steps]
    return np.bincount(owner, weights=got, minlength=len(n))


def scores(docs: DataFrame, spark: SparkSession, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    model = Model(docs, spark, id_col, text_col)
    model.train()
    return model.score().select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
