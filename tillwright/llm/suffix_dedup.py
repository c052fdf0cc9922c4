"""Removing repeated byte strings with a sparse suffix array.

Suffixes are sorted at anchors only. Of the grams in every window of ``LENGTH``
bytes the one of least hash is an anchor, so two equal windows hold the same gram at
the same place, and whatever repeats is found at anchors with equal grams. The bytes
that windows over an anchor can reach are its context.

* Anchors with equal contexts: all their windows repeat; counting hashes shows it.
* Other anchors that share a gram: their contexts to the right and, reversed, to the
  left are sorted by a mergesort. Two suffixes are compared by a binary search for
  their longest common extension over prefix polynomial hashes; the extensions of
  neighbours are verified on the bytes. A window repeats if two anchors share its
  part to the left and its part to the right, which the sorted neighbours show for
  each way to split it.
* A gram with more contexts than one task sorts is halved instead: the windows of
  an interval repeat together if the bytes they span do, none of them does if the
  bytes they share don't, and otherwise its parts are looked at.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.shared import drop, id_and_text, staged

#: Bytes of a string that must not repeat, and of the grams that anchor it.
LENGTH, GRAM = 400, 128
#: Contexts of one gram that a task sorts at most, and about how many it sorts at once.
SORTED = 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ANCHOR = "row long, pos int, gram long, left int, size int, c1 long, c2 long"
_SPAN = "row long, start int, stop int"


class GramHashes:
    """Hashes of the grams of a text (bytes), from prefix polynomial hashes."""

    def __init__(self, gram: int):
        self._gram, self._rising, self._falling = gram, None, None

    def __call__(self, data: np.ndarray) -> np.ndarray:
        n = len(data)
        if self._rising is None or len(self._rising) < n:
            size = 2 * n
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self._rising, self._falling = (
                np.cumprod(np.r_[np.uint64(1), np.full(size, base)]) for base in (_BASE, inverse)
            )
        # The coefficient of a byte falls with its place in the text; scaling the sum over
        # a gram by its own place makes it depend on the gram alone.
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._falling[:n], out=prefix[1:])
        h = (prefix[self._gram :] - prefix[: -self._gram]) * self._rising[: n - self._gram + 1]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """The places of the first least hash of every ``width`` consecutive ones."""
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    # Hash and place in one number, so that the minimum is the first of equal ones.
    bits = max(1, int(len(hashes)).bit_length())
    keyed = ((hashes >> np.uint64(bits)) << np.uint64(bits)) | np.arange(len(hashes), dtype=np.uint64)
    least, span = keyed, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(hashes) - width + 1], least[width - span :][: len(hashes) - width + 1])
    return np.unique(least & np.uint64((1 << bits) - 1)).astype(np.int64)


def _anchors(length: int, gram: int):
    reach = length - gram

    def run(batches):
        gram_hashes = GramHashes(gram)
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()):
                if len(text) < length:
                    continue
                hashes = gram_hashes(np.frombuffer(text, np.uint8))
                places = anchors(hashes, reach + 1)
                starts, stops = np.maximum(places - reach, 0), np.minimum(places + length, len(text))
                left = places - starts
                digests = b"".join(
                    hashlib.blake2b(text[a:b], digest_size=16, salt=int(x).to_bytes(8, "little")).digest()
                    for a, b, x in zip(starts.tolist(), stops.tolist(), left.tolist())
                )
                both = np.frombuffer(digests, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(places), row)),
                        pa.array(places.astype(np.int32)),
                        pa.array(hashes[places].view(np.int64)),
                        pa.array(left.astype(np.int32)),
                        pa.array((stops - starts).astype(np.int32)),
                        pa.array(np.ascontiguousarray(both[:, 0])),
                        pa.array(np.ascontiguousarray(both[:, 1])),
                    ],
                    names=["row", "pos", "gram", "left", "size", "c1", "c2"],
                )

    return run


class Suffixes:
    """Byte strings of a group each, sorted by group and content."""

    def __init__(self, groups: np.ndarray, strings: list[bytes]):
        m, width = len(strings), max(map(len, strings), default=0)
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.data = np.zeros((m, width + 1), np.uint8)
        for i, s in enumerate(strings):
            self.data[i, : len(s)] = np.frombuffer(s, np.uint8)
        self.hashes = np.zeros((m, width + 1), np.uint64)
        for t in range(width):
            self.hashes[:, t + 1] = self.hashes[:, t] * _BASE + self.data[:, t] + np.uint64(1)
        self.groups = groups

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The lengths of the longest common extensions of pairs."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.sizes[i], self.sizes[j])
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes[i, middle] == self.hashes[j, middle]
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether string i comes before j; equal ones in the order of their numbers."""
        length = self.common(i, j)
        ends_i, ends_j = length == self.sizes[i], length == self.sizes[j]
        by_byte = np.where(ends_i | ends_j, ends_i & ~ends_j, self.data[i, length] < self.data[j, length])
        content = np.where(ends_i & ends_j, i < j, by_byte)
        return np.where(self.groups[i] != self.groups[j], self.groups[i] < self.groups[j], content)

    def sorted(self) -> np.ndarray:
        """Mergesort, all runs of a level at once: an element's place in the merged run is
        its place in its own plus its rank in the other, by binary search."""
        order, m, run = np.arange(len(self.sizes)), len(self.sizes), 1
        while run < m:
            at = np.arange(m)
            other = (at // run) ^ 1
            low = np.minimum(other * run, m)
            first, high = low, np.minimum(low + run, m)
            while (open_ := low < high).any():
                middle = np.minimum((low + high) // 2, m - 1)
                less = self.before(order[middle], order)
                low = np.where(open_ & less, middle + 1, low)
                high = np.where(open_ & ~less, middle, high)
            place = (at // (2 * run)) * 2 * run + at % run + low - first
            merged = np.empty_like(order)
            merged[place] = order
            order, run = merged, run * 2
        return order

    def shared(self, order: np.ndarray) -> np.ndarray:
        """How much each string has in common with the one before it in ``order``; -1
        where a group begins. Hashes are verified on the bytes."""
        i, j = order[:-1], order[1:]
        length = self.common(i, j)
        inside = np.arange(self.data.shape[1])[None, :] < length[:, None]
        differ = (self.data[i] != self.data[j]) & inside
        length = np.where(differ.any(1), differ.argmax(1), length)
        return np.r_[-1, np.where(self.groups[i] == self.groups[j], length, -1)] if len(order) else length


def repeated_windows(groups: np.ndarray, contexts: list[bytes], left: np.ndarray, length: int, reach: int) -> np.ndarray:
    """Which windows repeat within their group: a row per context, a column for each
    number of a window's bytes that stand left of the anchor."""
    m = len(contexts)
    rights = Suffixes(groups, [c[x:] for c, x in zip(contexts, left)])
    lefts = Suffixes(groups, [c[:x][::-1] for c, x in zip(contexts, left)])
    orders = [s.sorted() for s in (rights, lefts)]
    shared = [s.shared(o) for s, o in zip((rights, lefts), orders)]
    out = np.zeros((m, reach + 1), bool)

    def classes(side: int, depth: int) -> np.ndarray:
        found = np.empty(m, np.int64)
        found[orders[side]] = np.cumsum(shared[side] < depth)
        return found

    for l in range(reach + 1):  # noqa: E741
        whole = np.flatnonzero((lefts.sizes >= l) & (rights.sizes >= length - l))
        keys = classes(0, length - l)[whole] * (m + 1) + classes(1, l)[whole]
        _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
        out[whole, l] = counts[place] > 1
    return out


def _sort_groups(length: int, gram: int):
    reach = length - gram

    def solve(rows: list[dict]) -> pa.RecordBatch:
        groups = np.unique(np.array([r["gram"] for r in rows]), return_inverse=True)[1]
        left = [r["left"] for r in rows]
        windows = repeated_windows(groups, [r["context"] for r in rows], left, length, reach)
        found = []
        for i in np.flatnonzero(windows.any(1)):
            if rows[i]["open"]:
                edges = np.flatnonzero(np.diff(np.r_[0, windows[i].astype(np.int8), 0]))
                pos = rows[i]["pos"]
                found += [(rows[i]["row"], pos - b + 1, pos - a + length) for a, b in zip(edges[::2], edges[1::2])]
        columns = list(zip(*found)) or [(), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())],
            names=["row", "start", "stop"],
        )

    def run(batches):
        waiting: list[dict] = []
        for batch in batches:
            waiting += batch.to_pylist()
            if len(waiting) >= SORTED:  # rows come by gram: the last one may go on
                last = waiting[-1]["gram"]
                ready = [r for r in waiting if r["gram"] != last]
                if ready:
                    yield solve(ready)
                    waiting = waiting[len(ready) :]
        if waiting:
            yield solve(waiting)

    return run


def _twice(value: Column) -> tuple[Column, Column]:
    return F.xxhash64(value).alias("h1"), F.xxhash64(F.lit(1), value).alias("h2")


def halved(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """(row, start, stop) of repeated windows for grams of any number of contexts.

    An interval is a range [lo, hi] of the bytes that windows have left of the anchor.
    Each round is a count of hashes, summed before it is shuffled. Contexts are written
    once: what a round stages and counts are hashes and intervals, which meet their
    context again in the next one. An interval is cut into up to four, so that there are
    few rounds.
    """
    spark = contexts.sparkSession
    reach = length - gram
    low = F.greatest(F.lit(0), F.col("left") + length - F.octet_length("context"))
    found = spark.createDataFrame([], _SPAN)
    work, whole = None, F.array(F.struct(F.lit(0).alias("lo"), F.lit(reach).alias("hi"), F.col("open").alias("open")))
    while True:
        asked = contexts.withColumn("todo", whole) if work is None else contexts.drop("open").join(work, ["row", "pos"])
        each = asked.select("row", "pos", "gram", "left", "context", "times", F.explode("todo").alias("t"))
        each = each.select("row", "pos", "gram", "left", "context", "times", "t.lo", "t.hi", "t.open")
        # The grid stays the same for all contexts; windows beyond a text's ends are none.
        inner = F.col("hi") - F.col("lo")
        inside = (F.col("lo") >= low) & (F.col("hi") <= F.col("left"))
        outer_ = F.expr("substring(context, left - hi + 1, hi - lo + %d)" % length)
        core_ = F.expr("substring(context, greatest(left - lo, 0) + 1, %d - (hi - lo))" % length)
        o1, o2 = _twice(F.when(inside, outer_).otherwise(F.concat(F.lit("!"), F.col("row").cast("string")).cast("binary")))
        k1, k2 = _twice(core_)
        some = (F.col("hi") >= low) & (F.col("lo") <= F.col("left"))
        rows = each.filter(some).withColumns({"o1": o1, "o2": o2, "k1": k1, "k2": k2, "inside": inside, "one": inner == 0})
        rows = staged(rows.drop("context", "left"), "halves")
        keys, outer, core = ["gram", "lo", "hi"], ["o1", "o2"], ["k1", "k2"]
        many = rows.filter("inside").groupBy(*keys, *outer).agg(F.sum("times").alias("n")).filter("n > 1").drop("n")
        told = rows.join(many.withColumn("done", F.lit(True)), [*keys, *outer], "left").drop(*outer)
        told = staged(told.withColumn("done", F.col("inside") & F.col("done").isNotNull()), "halves")
        hits = told.filter("open AND done")
        start, stop = F.col("pos") - F.col("hi"), F.col("pos") - F.col("lo") + length
        found = found.union(staged(hits.select("row", start.alias("start"), stop.alias("stop")), "spans"))
        # Who repeats as a whole stays as a partner for the others, but is not open any more;
        # where none is, nothing is left to find.
        rest = told.filter("NOT one").withColumn("open", F.col("open") & ~F.col("done"))
        alike = rest.groupBy(*keys, *core).agg(F.sum("times").alias("n"), F.max("open").alias("some")).filter("n > 1 AND some")
        step = F.expr("int(ceil((hi - lo + 1) / 4))")
        parts = F.transform(
            F.sequence("lo", "hi", step),
            lambda a: F.struct(a.alias("lo"), F.least(a + step - 1, F.col("hi")).alias("hi"), F.col("open").alias("open")),
        )
        left = rest.join(alike.select(*keys, *core), [*keys, *core], "left_semi").withColumn("parts", parts)
        before = work
        work = staged(left.groupBy("row", "pos").agg(F.flatten(F.collect_list("parts")).alias("todo")), "intervals")
        for table in (rows, told, before):  # a round's tables aren't kept beyond it
            if table is not None:
                drop(table)
        if work.limit(1).count() == 0:
            drop(work)
            return found


def repeated_spans(texts: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = SORTED) -> DataFrame:
    """(row, start, stop): spans of bytes that repeated strings cover, in any order and
    overlapping, for texts (row, text). Rows of equal ``row`` and text are separate."""
    spread = staged(texts.select("row", "text").mapInArrow(_anchors(length, gram), _ANCHOR), "anchors")
    contexts = spread.groupBy("gram", "c1", "c2").agg(
        F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "pos")).alias("one")
    )
    contexts = staged(contexts, "contexts")
    grams = contexts.groupBy("gram").agg(F.sum("times").alias("total"), F.count(F.lit(1)).alias("kinds")).filter("total > 1")
    known = contexts.join(grams, "gram")
    marked = staged(
        spread.join(known.select("gram", "c1", "c2", "times", "kinds", "one"), ["gram", "c1", "c2"]).select(
            "row", "pos", "gram", "left", "size", "times", "kinds",
            (F.struct("row", "pos") == F.col("one")).alias("stands"),
        ),
        "marked",
    )
    start = F.col("pos") - F.col("left")
    whole = marked.filter("times > 1").select("row", start.alias("start"), (start + F.col("size")).alias("stop"))
    # One anchor of each context, where a gram has several: those that occur once are open.
    asked = marked.filter("kinds > 1 AND stands").dropDuplicates(["row", "pos"])
    wanted = asked.groupBy("row").agg(
        F.collect_list(F.struct("pos", "gram", "left", "size", "times", "kinds")).alias("at")
    )
    cut = wanted.join(texts.select("row", "text").dropDuplicates(["row"]), "row").select(
        "row", "at", F.col("text").cast("binary").alias("bytes")
    )
    each = cut.select("row", "bytes", F.explode("at").alias("a")).select(
        "row", "a.pos", "a.gram", "a.left",
        F.expr("substring(bytes, a.pos - a.left + 1, a.size)").alias("context"),
        (F.col("a.times") == 1).alias("open"), "a.times", "a.kinds",
    )
    each = staged(each, "cut")
    small = each.filter(F.col("kinds") <= most).drop("kinds", "times").repartition("gram").sortWithinPartitions("gram")
    sorted_ = small.mapInArrow(_sort_groups(length, gram), _SPAN)
    found = whole.union(sorted_)
    large = each.filter(F.col("kinds") > most).drop("kinds")
    if large.limit(1).count():
        found = found.union(halved(large, length, gram))
    return found


def _removed(batches):
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "bytes", "spans"))):
            kept, at, removed, count = [], 0, 0, 0
            reached = -1
            for span in sorted((s["start"], s["stop"]) for s in spans or ()):
                if span[0] > reached:
                    kept.append(text[max(at, 0) : span[0]])
                    count += 1
                    removed += span[1] - span[0]
                elif span[1] > reached:
                    removed += span[1] - reached
                reached = max(reached, span[1])
                at = reached
            kept.append(text[max(at, 0) :])
            out.append((doc_id, len(text), removed, count, b"".join(kept)))
        columns = list(zip(*out)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, most: int = SORTED) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes): one row per row of ``docs``
    (doc_id, text).

    Texts are taken as UTF-8 bytes. Every byte that a string of ``length`` bytes covers
    which also starts anywhere else, in the same text or another, is removed; strings
    are judged on the input, and each occurrence goes. Texts shorter than that, empty
    and null texts lose nothing. Repeated rows repeat each other. An empty table gives
    no rows; other columns aren't read.
    """
    texts = id_and_text(docs).withColumn("row", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(texts, length, gram, most)
    by_row = spans.distinct().groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return (
        texts.join(by_row, "row", "left")
        .select("doc_id", F.col("text").cast("binary").alias("bytes"), "spans")
        .mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    )
