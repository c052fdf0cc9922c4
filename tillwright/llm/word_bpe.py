"""BPE encoding and decoding through a table of distinct words.

The words of a corpus are far fewer than their occurrences. Spark splits the
texts, deals the distinct words to buckets by hash, where each is encoded once for
``SPAN`` blocks, and joins the ids back. The join is by block: documents are hashed into blocks of a
bounded size, each distinct word knows the blocks it occurs in, and the ids are laid
out by position where a block's texts meet its words. No occurrence of a word is
shuffled, and texts, words and ids travel compressed. Decoding joins each document's
ids with the vocabulary's pieces, a table of fixed size that every task holds.
"""

import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.shared import blocks_for, id_and_text, release_memory
from tillwright.llm.words import Words, by_bytes, is_word, laid_out, strings

#: Bytes of text in a block on average: a word goes once to each block it occurs in.
BLOCK_BYTES = 32 << 20
#: Chunks whose ids a task keeps ready beside those of the block's words.
KEPT_CHUNKS = 100_000
#: What a task gathers before it sends: distinct chunks of texts, bytes of texts, and
#: words with their blocks (beside a bucket's distinct ones).
HELD_CHUNKS, HELD_BYTES, HELD_WORDS = 300_000, 8 << 20, 200_000
#: Pairs of a chunk and a block that a task gathers.
HELD_PAIRS = 3_000_000
#: Blocks in which a word is encoded once; there are as many buckets of words for them.
SPAN = 1024
#: Characters of texts laid out at once.
SLICE_CHARS = 3 << 20
#: Between the pieces of a decoded text; the vocabulary file names no decoder.
JOINED_BY = " "

_LOW = 0xFFFFFFFF


def _bucket_words(path: str, buckets: int):
    """Distinct words and their blocks, packed by bucket. Chunks are gathered over batches
    up to a bounded number; a word that is in both halves of a split goes out twice."""

    def run(batches):
        words = Words(path)
        number, pairs, held = {}, [], 0
        for batch in batches:
            chunks, places, counts = words.cut(strings(batch.column("text")))
            numbers = np.fromiter((number.setdefault(c, len(number)) for c in chunks), np.int64, len(chunks))
            blocks = np.repeat(batch.column("block").to_numpy().astype(np.int64), counts)
            pairs.append(_unique(blocks << 32 | numbers[places]))
            held += len(pairs[-1])
            if len(number) > HELD_CHUNKS or held > HELD_PAIRS:
                yield from words_of(words, list(number), pairs)
                number, pairs, held = {}, [], 0
        yield from words_of(words, list(number), pairs)
        release_memory()

    def words_of(words: Words, chunks: list[str], pairs: list[np.ndarray]):
        """``pairs`` has the block and the place in ``chunks``, in one number."""
        if not chunks:
            return
        of = [[c] if is_word(c) else words.words(c) for c in chunks]
        distinct = sorted(set(chain.from_iterable(of)))  # neighbours alike compress well
        number = dict(zip(distinct, range(len(distinct))))
        sizes = np.fromiter(map(len, of), np.int64, len(of))
        numbers = np.fromiter(map(number.__getitem__, chain.from_iterable(of)), np.int64, sizes.sum())
        lists = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)]), pa.array(numbers))
        found = _unique(np.concatenate(pairs))
        places = found & _LOW
        blocks = np.repeat(found >> 32, sizes[places])
        found = _unique(lists.take(pa.array(places)).flatten().to_numpy() << 32 | blocks)
        bucket = np.array([zlib.crc32(w.encode()) % buckets for w in distinct], np.int32)
        word = pa.array(distinct, pa.large_string()).take(pa.array(found >> 32))
        block = (found & _LOW).astype(np.int32)
        # A frequent word lists almost every block: by spans, what a bucket holds is bounded.
        dealt = block // SPAN * buckets + bucket[found >> 32]
        yield from _packed(pa.table({"bucket": pa.array(dealt), "word": word, "block": pa.array(block)}), "bucket")

    return run


def _unique(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def _runs(values: np.ndarray):
    """(begin, end) of the runs of equal neighbours."""
    edges = np.flatnonzero(np.r_[True, np.diff(values) != 0, True]) if len(values) else []
    return zip(edges[:-1], edges[1:])


def _distinct(held: list[pa.Table]) -> pa.Table:
    """Rows (word, block) without repetitions, in the order of words: neighbours alike compress well."""
    rows = pa.concat_tables(held)
    words = rows.column("word").combine_chunks().dictionary_encode()
    order = pc.array_sort_indices(words.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    pairs = _unique(rank[words.indices.to_numpy()] << 32 | rows.column("block").to_numpy())
    word = words.dictionary.take(pa.array(order[pairs >> 32]))
    return pa.table({"word": word, "block": pa.array((pairs & _LOW).astype(np.int32))})


def _encode(path: str):
    """The words of each bucket once, from rows in its order; then words and ids packed by
    the blocks that they occur in."""

    def run(batches):
        words = Words(path)
        at, held, rows, settled = None, [], 0, 0
        for batch in batches:
            for bucket, packed in zip(batch.column("bucket").to_pylist(), batch.column("packed")):
                if bucket != at:
                    yield from encoded(words, held)
                    at, held, rows, settled = bucket, [], 0, 0
                held.append(_rows(packed.as_py()))
                rows += len(held[-1])
                if rows > 2 * settled + HELD_WORDS:
                    held = [_distinct(held)]
                    rows = settled = len(held[0])
        yield from encoded(words, held)
        release_memory()

    def encoded(words: Words, held: list[pa.Table]):
        if held:
            found = _distinct(held)
            word = found.column("word").combine_chunks().dictionary_encode()
            ids = pa.array(words.encode_bytes(strings(word.dictionary)), pa.binary())
            yield from _packed(found.append_column("ids", ids.take(word.indices)), "block")
            release_memory()

    return run


def _pack(batches):
    """The rows of some batches, by block, as one compressed Arrow stream each."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > HELD_BYTES:
            yield from _packed(pa.Table.from_batches(held), "block")
            held, size = [], 0
    if held:
        yield from _packed(pa.Table.from_batches(held), "block")
    release_memory()


def _packed(rows: pa.Table, key: str):
    """Rows by the column ``key``, as one compressed Arrow stream each."""
    keys = rows.column(key).to_numpy()
    order = np.argsort(keys, kind="stable")
    rows = rows.drop_columns(key).take(pa.array(order))
    packer = zstandard.ZstdCompressor(level=3)
    for a, b in _runs(keys[order]):
        some = rows.slice(a, b - a).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, some.schema) as stream:
            stream.write_table(some)
        packed = packer.compress(sink.getvalue())
        yield pa.RecordBatch.from_arrays(
            [pa.array([keys[order[a]]], pa.int32()), pa.array([packed], pa.binary())], names=[key, "packed"]
        )


def _rows(packed: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.decompress(packed)).read_all()


def _lay_out(path: str):
    """Ids by position, from rows in order of block: first a block's words, then its texts,
    pack by pack."""

    def run(batches):
        words = Words(path)
        known = dict(words.pieces())
        pieces = pa.array(map(known.get, range(max(known) + 1)), pa.string())
        at, ids, by_chunk, done = None, {}, {}, 0
        for batch in batches:
            for row in range(len(batch)):
                block, has_texts = batch.column("block")[row].as_py(), batch.column("has_texts")[row].as_py()
                if block != at:
                    at, ids, by_chunk = block, {}, {}
                rows = _rows(batch.column("packed")[row].as_py())
                if not has_texts:
                    ids.update(zip(strings(rows.column("word")), strings(rows.column("ids"))))
                    continue
                first = 0
                for texts in by_bytes(strings(rows.column("text")), SLICE_CHARS):
                    chunks, places, counts = words.cut(texts)
                    if len(by_chunk) > KEPT_CHUNKS:
                        by_chunk = {}
                    for c in [c for c in chunks if c not in by_chunk]:
                        by_chunk[c] = ids[c] if is_word(c) else b"".join(map(ids.__getitem__, words.words(c)))
                    encoded, ends = laid_out(list(map(by_chunk.__getitem__, chunks)), places, counts)
                    ends = np.r_[0, ends].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            rows.column("doc_id").slice(first, len(texts)).combine_chunks(),
                            pa.array(np.diff(ends), pa.int64()),
                            pa.BinaryArray.from_buffers(
                                pa.binary(), len(texts), [None, pa.py_buffer(4 * ends), pa.py_buffer(encoded.tobytes())]
                            ),
                            pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pieces.take(pa.array(encoded))), JOINED_BY),
                        ],
                        names=["doc_id", "n_tokens", "ids", "decoded"],
                    )
                    first += len(texts)
                    done += sum(map(len, texts))
                del rows
                if done > HELD_BYTES:
                    release_memory()
                    done = 0
        release_memory()

    return run


def encode_decode(docs: DataFrame, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded, one
    row per row of ``docs`` (doc_id, text).

    Whole texts are encoded as the tokenizers library does without added special
    tokens, and decoded as it does without skipping any. A null or empty text has
    no ids and decodes to the empty text. Repeated rows are encoded each; null
    ids are kept; an empty table gives no rows; other columns aren't read.
    """
    texts = id_and_text(docs)
    n = blocks_for(texts, block_bytes)
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int"))
    pairs = dealt.mapInArrow(_bucket_words(path, min(n, SPAN)), "bucket int, packed binary")
    # A word's rows meet in one task, which holds the distinct ones of a bucket.
    tables = (
        pairs.repartition(F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(_encode(path), "block int, packed binary")
    )
    packs = dealt.mapInArrow(_pack, "block int, packed binary")
    both = tables.withColumn("has_texts", F.lit(False)).unionByName(packs.withColumn("has_texts", F.lit(True)))
    # A block's rows meet in one task, sorted but not held: what it holds are the block's words and one pack.
    met = both.repartition(F.col("block")).sortWithinPartitions("block", "has_texts")
    return met.mapInArrow(_lay_out(path), "doc_id long, n_tokens long, ids binary, decoded string")
