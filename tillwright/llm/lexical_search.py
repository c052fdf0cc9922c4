"""Exact ranked lexical search over posting lists cut into geometric blocks.

Scores are inner products: a document has an impact for each of its terms, an item
(query) a weight for each of its own. Documents are dealt into shards that a task
holds at once. In a shard, the posting list of a term is clustered by the
similarity of its documents, and every block of similar documents is stored with a
summary, the coordinatewise maximum of their impacts. A block's inner product with
the summary bounds the scores in it from above, so an item skips a block only when
that bound is below the score its current last place has; all other blocks are
scored in full. The result is exact, ties included.

An item visits its terms' lists from the rarest term to the most frequent. A
document that also holds a rarer term of the item was judged in that term's list
already, so a list's summaries need the coordinates of its own and more frequent
terms only, and once the shard's maxima of the remaining terms add up to less than
the last place's score, the remaining lists, the longest, are skipped as a whole.
The best documents so far carry over from shard to shard of a task.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.decontamination import pieces
from tillwright.llm.shared import id_and_text, release_memory, small_batches, staged

#: Documents returned for an item.
TOP = 20
#: Documents of a block on average; numbers (documents times terms of the items) in a
#: shard, and its documents at most; dimensions in which documents are compared.
BLOCK_DOCS, SHARD_CELLS, SHARD_DOCS, SKETCH = 32, 6_000_000, 4096, 48
#: Bytes of the items that are searched in one pass over the documents, on average.
ITEM_BYTES = 1 << 20
#: Groups that an item's candidates are first reduced in.
SALTS = 64

_VECTORS = "doc_id long, n long, terms array<int>, counts array<int>"


def term_counts(text: bytes) -> Counter:
    """The terms of a text: maximal runs of letters, digits and bytes above 127, A-Z in lower case."""
    counts: Counter = Counter()
    for words in pieces(text):
        counts.update(words)
    return counts


def _count(number: dict[bytes, int]):
    """Rows of documents: n terms, and those of the items with their counts."""

    def run(batches):
        for batch in batches:
            lengths, terms, counts, bounds = [], [], [], [0]
            for text in batch.column("text").cast(pa.large_binary()).to_pylist():
                found = term_counts(text)
                lengths.append(found.total())
                for term in found.keys() & number.keys():
                    terms.append(number[term])
                    counts.append(found[term])
                bounds.append(len(terms))
            offsets = pa.array(bounds, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32())),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return run


class Statistics:
    """Corpus counts, and weights of terms in order: rarest first."""

    def __init__(self, n_docs: int, n_terms: int, holders: dict[int, int]):
        self.n_docs, self.n_terms = n_docs, n_terms
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, df in holders.items()}
        order = sorted((t for t in weights if weights[t] > 0), key=lambda t: (-weights[t], t))
        #: Column of each term that can add to a score.
        self.column = {t: c for c, t in enumerate(order)}
        self.weights = np.array([weights[t] for t in order], np.int64)

    def impacts(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Of term counts in documents of ``n`` terms each, all numbers integers."""
        sizes, place = np.unique(n, return_inverse=True)
        norms = [75 + 25 * size * self.n_docs // self.n_terms for size in sizes.tolist()]  # of any size
        m, tf = np.array(norms, np.int64)[place], counts.astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Item:
    """An item's columns, rarest term first, their weights, and its best documents."""

    def __init__(self, counts: dict[int, int], statistics: Statistics):
        found = sorted((statistics.column[t], n) for t, n in counts.items() if t in statistics.column)
        self.columns = np.array([c for c, _ in found], np.int64)
        self.weights = statistics.weights[self.columns] * np.array([n for _, n in found], np.int64)
        self.best: list[tuple[int, bool, int]] = []  # (minus score, id is null, id), ascending

    def offer(self, scores: np.ndarray, ids: list, last: int, top: int) -> int:
        """Take the scores that reach ``last``; returns the score needed from now on."""
        for i in np.flatnonzero(scores >= last).tolist():
            self.best.append((-int(scores[i]), ids[i] is None, ids[i] or 0))
        self.best.sort()
        del self.best[top:]
        return max(1, -self.best[-1][0]) if len(self.best) == top else 1


class Shard:
    """The index of some documents: their impacts, and blocks of each list once asked for."""

    def __init__(self, ids: list, impacts: np.ndarray, weights: np.ndarray, partners: list[np.ndarray], block_docs: int):
        self.ids, self.impacts, self.partners, self.block_docs = ids, impacts, partners, block_docs
        self.most = impacts.max(axis=0, initial=0).astype(np.int64)
        signs = np.random.default_rng(11).choice(np.array([-1, 1], np.float32), (impacts.shape[1], SKETCH))
        sketch = impacts.astype(np.float32) @ (signs * np.sqrt(weights, dtype=np.float32)[:, None])
        self._sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        self._lists: dict[int, tuple] = {}

    def blocks(self, column: int):
        """The documents of a term block by block, the blocks' bounds and summaries."""
        if column not in self._lists:
            members = np.flatnonzero(self.impacts[:, column])
            if len(members) > self.block_docs:
                seeds = members[:: self.block_docs]
                nearest = np.argmax(self._sketch[members] @ self._sketch[seeds].T, axis=1)
                members = members[np.argsort(nearest, kind="stable")]
                starts = np.flatnonzero(np.r_[True, np.diff(np.sort(nearest)) != 0])
            else:
                starts = np.zeros(min(1, len(members)), np.int64)
            rows = self.impacts[np.ix_(members, self.partners[column])]
            summaries = np.maximum.reduceat(rows, starts, axis=0) if len(starts) else rows
            self._lists[column] = members, np.r_[starts, len(members)], summaries.astype(np.int64)
        return self._lists[column]

    def search(self, item: Item, top: int) -> None:
        last = item.offer(np.zeros(0, np.int64), [], 1, top)
        remaining = np.cumsum((item.weights * self.most[item.columns])[::-1])[::-1]
        judged = np.zeros(len(self.ids), bool)
        for i, column in enumerate(item.columns.tolist()):
            if remaining[i] < last:
                break
            members, bounds, summaries = self.blocks(column)
            at = np.searchsorted(self.partners[column], item.columns[i:])
            possible = summaries[:, at] @ item.weights[i:]
            for block in np.argsort(-possible, kind="stable").tolist():
                if possible[block] < last:
                    break
                some = members[bounds[block] : bounds[block + 1]]
                some = some[~judged[some]]
                if len(some):
                    judged[some] = True
                    scores = self.impacts[np.ix_(some, item.columns)].astype(np.int64) @ item.weights
                    last = item.offer(scores, [self.ids[j] for j in some.tolist()], last, top)


def partners(items: list[Item], n_columns: int) -> list[np.ndarray]:
    """For each column, itself and the later ones that an item has beside it."""
    found: list[set] = [set() for _ in range(n_columns)]
    for item in items:
        columns = item.columns.tolist()
        for i, column in enumerate(columns):
            found[column].update(columns[i:])
    return [np.array(sorted(f), np.int64) for f in found]


def _shards(batches, statistics: Statistics, docs_each: int):
    """(ids, impacts by column) of up to ``docs_each`` documents."""
    column = np.full(max(statistics.column, default=-1) + 1, -1, np.int64)
    for term, c in statistics.column.items():
        column[term] = c
    held, rows = [], 0
    for batch in batches:
        while len(batch):
            some = batch.slice(0, docs_each - rows)
            batch = batch.slice(len(some))
            held.append(some)
            rows += len(some)
            if rows == docs_each:
                yield _shard(held, statistics, column)
                held, rows = [], 0
    if held:
        yield _shard(held, statistics, column)


def _shard(held: list[pa.RecordBatch], statistics: Statistics, column: np.ndarray):
    table = pa.Table.from_batches(held).combine_chunks()
    lists = table.column("terms").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.int32()))
    terms, counts = lists.flatten().to_numpy(), table.column("counts").chunk(0).flatten().to_numpy()
    row = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy())
    known = terms < len(column)
    row, terms, counts = row[known], terms[known], counts[known]
    useful = column[terms] >= 0
    row, at, counts = row[useful], column[terms[useful]], counts[useful]
    impacts = np.zeros((table.num_rows, len(statistics.weights)), np.int32)
    impacts[row, at] = statistics.impacts(table.column("n").to_numpy()[row], counts)
    return table.column("doc_id").to_pylist(), impacts


def _search(queries: list[tuple[int | None, dict[int, int]]], statistics: Statistics, top: int, block_docs: int):
    def run(batches):
        items = [Item(counts, statistics) for _, counts in queries]
        beside = partners(items, len(statistics.weights))
        docs_each = max(1, min(SHARD_DOCS, SHARD_CELLS // max(1, len(statistics.weights))))
        for ids, impacts in _shards(batches, statistics, docs_each):
            shard = Shard(ids, impacts, statistics.weights, beside, block_docs)
            for item in items:
                shard.search(item, top)
            del shard, impacts
        release_memory()
        for number, (item, (item_id, _)) in enumerate(zip(items, queries)):
            if item.best:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([number] * len(item.best), pa.int32()),
                        pa.array([item_id] * len(item.best), pa.int64()),
                        pa.array([None if null else doc_id for _, null, doc_id in item.best], pa.int64()),
                        pa.array([-score for score, _, _ in item.best], pa.int64()),
                    ],
                    names=["item", "item_id", "doc_id", "score"],
                )

    return run


def _vectors(texts: DataFrame, number: dict[bytes, int]) -> tuple[DataFrame, Statistics]:
    """The documents' counts of the given terms as a table, and the corpus' statistics."""
    vectors = staged(texts.mapInArrow(_count(number), _VECTORS), "vectors")
    whole = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    # At most as many rows as the items of one pass have terms.
    holders = vectors.select(F.explode("terms").alias("term")).groupBy("term").count()
    return vectors, Statistics(whole.docs, whole.terms or 0, {r.term: r["count"] for r in holders.collect()})


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_docs: int = BLOCK_DOCS, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` documents of the highest score above
    0, equal scores by ascending doc_id, null ids last.

    A null or empty text (of ``docs``: doc_id, text; of ``items``: item_id, text)
    has no terms; it is found by no item, or finds nothing. Every row of ``items``
    is ranked, so equal rows give equal results; rows of documents that repeat an id
    are documents of their own. Empty tables give no rows; other columns aren't
    read. Items are searched in passes of bounded size, over all documents each.
    """
    small_batches(docs.sparkSession)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    passes = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // item_bytes))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)))
    texts, out = id_and_text(docs), None
    for part in range(passes):
        # One pass' items: about ITEM_BYTES, sorted so that their numbers stay the same.
        found = [(r.item_id, term_counts(r.text.encode())) for r in dealt.filter(F.col("part") == part).collect()]
        found.sort(key=lambda f: (f[0] is None, f[0] or 0, sorted(f[1].items())))
        number = {term: i for i, term in enumerate(sorted(set().union(*(c for _, c in found))))}
        vectors, statistics = _vectors(texts, number)
        queries = [(item_id, {number[t]: n for t, n in counts.items()}) for item_id, counts in found]
        best = vectors.mapInArrow(
            _search(queries, statistics, top, block_docs), "item int, item_id long, doc_id long, score long"
        ).withColumn("pass", F.lit(part))
        out = best if out is None else out.unionByName(best)
    # Of many tasks' candidates, first the best in parts of each item, then of these.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
    first = out.withColumn("place", F.row_number().over(Window.partitionBy("pass", "item", salt).orderBy(*order))).filter(
        F.col("place") <= top
    )
    place = F.row_number().over(Window.partitionBy("pass", "item").orderBy(*order))
    return first.withColumn("rank", place).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
