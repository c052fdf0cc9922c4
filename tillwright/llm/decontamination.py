"""Passages of test items in documents, by Wu-Manber multi-pattern search.

The symbols are words. A window is a run of ``WINDOW`` words of an item; an item
with fewer words is one shorter window. Windows of one length are searched
together:

* the shift table holds, for every block of words inside a window, how many
  words stand between the block and the end of the window that has it last. A
  block that no window holds moves the search on by all but its own length, so
  most words of a document are never looked up;
* a block that ends a window leads to the bucket of the windows with that suffix,
  told apart by their first words;
* the candidates are compared with the document word by word.

Items travel to the tasks in blocks of bounded size; every block of items meets
every document. Documents aren't shuffled.
"""

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.shared import id_and_text, small_batches, staged

#: Words of a window, and of a block of the shift table.
WINDOW, BLOCK = 10, 3
#: Bytes of item text in the tables that a task holds at once, on average, and words of
#: an item in one row; longer items take several rows.
ITEM_BYTES, ITEM_WORDS = 2 << 20, 4096
#: Bytes of a document whose words are held at once.
PIECE_BYTES = 1 << 20

# Fixed value: the bytes of words, after A-Z are lower-cased; all others become a space.
_WORD_BYTES = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
_SPACE = re.compile(b" ")

_FOUND = "spans array<struct<first: long, after: long>>, items array<long>"


def pieces(text: bytes, size: int = PIECE_BYTES):
    """The words of a text, in lists that each cover about ``size`` bytes."""
    spaced = text.lower().translate(_WORD_BYTES)
    start = 0
    while start < len(spaced):
        space = _SPACE.search(spaced, start + size)
        end = space.start() if space else len(spaced)
        yield spaced[start:end].split()
        start = end


class Windows:
    """The tables for windows of ``size`` words. ``items`` are (name, words)."""

    def __init__(self, size: int, items: list[tuple[int | None, list[bytes]]]):
        self.size, self.block = size, min(BLOCK, size)
        self.furthest = size - self.block + 1
        self.shifts: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple]]] = {}
        self.items_of: dict[tuple, set] = {}
        for name, words in items:
            for start in range(len(words) - size + 1):
                window = tuple(words[start : start + size])
                if window in self.items_of:
                    self.items_of[window].add(name)
                    continue
                self.items_of[window] = {name}
                for end in range(self.block, size + 1):
                    block = window[end - self.block : end]
                    self.shifts[block] = min(size - end, self.shifts.get(block, self.furthest))
                same_suffix = self.buckets.setdefault(window[size - self.block :], {})
                same_suffix.setdefault(window[: self.block], []).append(window)

    def search(self, words: list[bytes]):
        """The first word's place and the window of every occurrence."""
        size, block, furthest = self.size, self.block, self.furthest
        shift_of, buckets = self.shifts.get, self.buckets
        at, n = size, len(words)
        while at <= n:
            suffix = tuple(words[at - block : at])
            shift = shift_of(suffix, furthest)
            if shift:
                at += shift
                continue
            start = at - size
            candidates = buckets[suffix].get(tuple(words[start : start + block]))
            if candidates:
                here = tuple(words[start:at])
                for window in candidates:
                    if window == here:
                        yield start, window
            at += 1


def tables(items: list[tuple[int | None, bytes]]) -> list[Windows]:
    """One for each length of windows. Rows of (name, spaced words)."""
    by_size: dict[int, list] = {}
    for name, text in items:
        words = text.split()
        if words:
            by_size.setdefault(min(WINDOW, len(words)), []).append((name, words))
    return [Windows(size, some) for size, some in sorted(by_size.items())]


def merged(spans) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for first, after in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = out[-1][0], max(after, out[-1][1])
        else:
            out.append((first, after))
    return out


def scan(text: bytes, searches: list[Windows]) -> tuple[int, list, list]:
    """Number of words, spans of words that are hit, and names of the items found."""
    n_words, carried, spans, found = 0, [], [], set()
    for words in pieces(text):
        before = n_words - len(carried)
        n_words += len(words)
        words = carried + words
        for search in searches:
            for start, window in search.search(words):
                first = before + start
                if spans and spans[-1][0] <= first <= spans[-1][1]:
                    spans[-1] = spans[-1][0], max(spans[-1][1], first + search.size)
                else:
                    spans.append((first, first + search.size))
                found |= search.items_of[window]
        carried = words[-(WINDOW - 1) :]
    return n_words, merged(spans), sorted(found - {None})


def _scan_batches(items: list[tuple[int | None, bytes]], only_hits: bool):
    def run(batches):
        searches = tables(items)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            results = [scan(text, searches) for text in texts]
            kept = [i for i, r in enumerate(results) if r[1] or not only_hits]
            rows = batch.take(pa.array(kept, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(name) for name in ("doc_id", "row", "row2")),
                    pa.array([results[i][0] for i in kept], pa.int64()),
                    pa.array(
                        [[{"first": a, "after": b} for a, b in results[i][1]] for i in kept],
                        pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())])),
                    ),
                    pa.array([results[i][2] for i in kept], pa.list_(pa.int64())),
                ],
                names=["doc_id", "row", "row2", "n_words", "spans", "items"],
            )

    return run


def _join_found(batches):
    """The findings of several blocks of items as one."""
    for batch in batches:
        spans, items = [], []
        for found in batch.column("found").to_pylist():
            spans.append([{"first": a, "after": b} for a, b in merged((s["first"], s["after"]) for f in found for s in f["spans"])])
            items.append(sorted({i for f in found for i in f["items"]}))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_words"), pa.array(spans, kind), pa.array(items, pa.list_(pa.int64()))],
            names=["doc_id", "n_words", "spans", "items"],
        )


def _item_pieces(batches):
    """Items as rows of at most ``ITEM_WORDS`` words; neighbouring rows share all but
    one word of a window, so that each window is in one of them."""
    for batch in batches:
        names, texts = [], []
        for name, text in zip(batch.column("item_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()):
            held: list[bytes] = []
            for words in pieces(text):
                held += words
                while len(held) > ITEM_WORDS:
                    names.append(name)
                    texts.append(b" ".join(held[:ITEM_WORDS]))
                    held = held[ITEM_WORDS - WINDOW + 1 :]
            if held:
                names.append(name)
                texts.append(b" ".join(held))
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts, pa.binary())], names=["item_id", "words"])


def item_blocks(items: DataFrame, block_bytes: int = ITEM_BYTES) -> tuple[DataFrame, int]:
    """Items in rows of bounded length (item_id, words, block), and the number of blocks."""
    small_batches(items.sparkSession)
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    cut = staged(rows.mapInArrow(_item_pieces, "item_id long, words binary").distinct(), "items")
    size = cut.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    return cut.withColumn("block", F.pmod(F.xxhash64("item_id", "words"), F.lit(n))), n


def overlaps(docs: DataFrame, items: DataFrame, block_bytes: int = ITEM_BYTES) -> DataFrame:
    """doc_id, n_words, spans (first, after: places of words, maximal runs), items
    (item_ids in ascending order): one row per row of ``docs`` (doc_id, text).

    A word is hit if it is inside any occurrence of a window of an item (item_id,
    text). A null or empty text has no words; an item without words has no windows;
    a window of an item whose id is null hits words, but the item isn't listed.
    Repeated items count once, repeated documents and null ids are rows like any
    others. Without items, or in an empty table of documents, nothing is hit.
    Columns other than the named ones aren't read. Texts of any length are scanned
    in pieces that share the words in which a window can cross their bounds.
    """
    spark = docs.sparkSession
    texts = id_and_text(docs).withColumns(
        # Two hashes tell rows apart; rows alike in id and text have the same findings.
        {"row": F.xxhash64("doc_id", "text"), "row2": F.xxhash64("text", "doc_id", F.lit(1))}
    )
    cut, n = item_blocks(items, block_bytes)
    schema = f"doc_id long, row long, row2 long, n_words long, {_FOUND}"

    def block(number: int, only_hits: bool) -> DataFrame:
        some = [(r.item_id, bytes(r.words)) for r in cut.filter(F.col("block") == number).collect()]
        return texts.mapInArrow(_scan_batches(some, only_hits), schema)

    if n == 1:
        return block(0, False).select("doc_id", "n_words", "spans", "items")
    first = block(0, False)
    others = staged(block(1, True), "overlaps")
    for number in range(2, n):  # each block's tables are held by one pass only
        others = others.unionByName(staged(block(number, True), "overlaps"))
    found = others.groupBy("row", "row2").agg(F.collect_set(F.struct("spans", "items")).alias("more"))
    own = F.array(F.struct("spans", "items"))
    both = first.join(found, ["row", "row2"], "left").select(
        "doc_id", "n_words", F.concat(own, F.coalesce("more", own)).alias("found")
    )
    small_batches(spark)
    return both.mapInArrow(_join_found, f"doc_id long, n_words long, {_FOUND}")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: the findings of
    ``overlaps`` in figures. The digest is of the item_ids, sorted as strings and
    joined by commas; of the empty string where there are none."""
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["after"] - s["first"])
    return overlaps(docs, items).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
