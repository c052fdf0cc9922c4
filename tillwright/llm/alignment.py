"""Which tokens of two vocabularies cover the same bytes, by lockstep merging.

Both token streams of a text spell the same bytes, so their ends are two ascending
sequences that end together. One vector holds the A and B position of every text
of a chunk: a step links the two tokens at each text's position, moves on the one
that ends first (both, where they end together: a cut), and drops the texts that
are through. So a chunk takes as many steps as its longest text, whatever the
number of texts.

Id pairs are counted corpus-wide in two stages: each chunk lists its distinct
pairs with the number of its documents, Spark adds these up, and every chunk gets
back the counts of its own pairs. No link is shuffled, and a pair that all
documents hold is one row of a chunk.
"""

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm.shared import id_and_text, release_memory, staged
from tillwright.llm.token_counts import _PLAIN, byte_of

#: Bytes of text that a chunk holds, but for its last text.
CHUNK_BYTES = 4 << 20

# Fixed value: how byte-level vocabularies split texts into pieces.
_PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as long as this is left to the tokenizers library: the faster one
#: looks ahead by recursion.
_LONG_SPACE = re.compile(r"\s{1000}")

_IDS = "a_ids array<int>, b_ids array<int>"
_LINKS = "link_a array<int>, link_b array<int>, cut_a array<int>, cut_b array<int>"


class ByteTokens:
    """Token ids of ' ' + text by a byte-level vocabulary file, special tokens' texts
    as plain text, and each id's bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        of = byte_of()
        self._path, self._library = path, None
        ranks = {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if all(c in of for c in token)}
        self.bytes_of = [b""] * (max(model["vocab"].values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        made = [ranks.get(bytes(of[c] for pair in merge for c in pair), -1) for merge in model["merges"]]
        # Ids in the order of the merges are ranks, which the faster library takes.
        self._fast = None
        if made == sorted(made) and len(ranks) == len(made) + 256:
            self._fast = tiktoken.Encoding("bytes", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        # On plain characters all Unicode versions split alike.
        plain = text.isascii() and text.isprintable() or _PLAIN.fullmatch(text) is not None
        if self._fast and plain and not (len(text) > 1000 and _LONG_SPACE.search(text)):
            return self._fast.encode_ordinary(" " + text)
        if self._library is None:
            self._library = Tokenizer.from_file(self._path)
            self._library.encode_special_tokens = True
        return self._library.encode(" " + text, add_special_tokens=False).ids


class PieceTokens:
    """Token ids of a text by a sentencepiece model, which adds a space, and each id's bytes."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for i in range(self._model.get_piece_size()):
            piece = self._model.id_to_piece(i)
            self.bytes_of.append(
                bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()
            )

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text)


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray):
    """Links and cuts of many texts at once.

    ``ends_*`` are the byte ends of all texts' tokens one text after the other,
    ``first_*`` the places of the texts' first tokens and, at last, the number of
    all. Every text has a token and ends at one byte in both. Returns the linked
    places in A and in B, one pair after the other, and for each token whether a
    group ends with it.
    """
    out_a = np.empty(len(ends_a) + len(ends_b), np.int32)
    out_b = np.empty_like(out_a)
    last_a, last_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    a, b, after = first_a[:-1].copy(), first_b[:-1].copy(), first_a[1:].copy()
    n = 0
    while len(a):
        out_a[n : n + len(a)] = a
        out_b[n : n + len(a)] = b
        n += len(a)
        end_a, end_b = ends_a[a], ends_b[b]
        cut = end_a == end_b
        last_a[a[cut]] = True
        last_b[b[cut]] = True
        a += end_a <= end_b
        b += end_b <= end_a
        going = a < after
        if not going.all():
            a, b, after = a[going], b[going], after[going]
    return out_a[:n], out_b[:n], last_a, last_b


class Aligned:
    """The tokens, links and cuts of a chunk of texts. Texts without tokens take no place."""

    def __init__(self, texts: list[str], a: ByteTokens, b: PieceTokens):
        ids_a, ids_b, self.counts = [], [], np.zeros((len(texts), 2), np.int64)
        for i, text in enumerate(texts):
            found = self._tokens(text, a, b) if text else None
            if found:
                self.counts[i] = len(found[0]), len(found[1])
                ids_a.append(np.array(found[0], np.int32))
                ids_b.append(np.array(found[1], np.int32))
        none = [np.zeros(0, np.int32)]
        self.ids_a, self.ids_b = np.concatenate(ids_a or none), np.concatenate(ids_b or none)
        #: Where each text's tokens begin, and the end of the last.
        self.first_a, self.first_b = (np.r_[0, np.cumsum(c)] for c in self.counts.T)
        has = self.counts[:, 0] > 0
        ends = [self._ends(self.ids_a, self.first_a, a), self._ends(self.ids_b, self.first_b, b)]
        starts = (np.r_[f[:-1][has], f[-1]] for f in (self.first_a, self.first_b))
        self.link_a, self.link_b, self.last_a, self.last_b = lockstep(*ends, *starts)
        self.n_links = np.bincount(self.text_of(self.link_a), minlength=len(texts))
        self.n_groups = np.bincount(self.text_of(np.flatnonzero(self.last_a)), minlength=len(texts))

    @staticmethod
    def _tokens(text: str, a: ByteTokens, b: PieceTokens):
        ids_a, ids_b = a.encode(text), b.encode(text)
        spelt = b" " + text.encode()
        if b"".join(map(a.bytes_of.__getitem__, ids_a)) == spelt == b"".join(map(b.bytes_of.__getitem__, ids_b)):
            return ids_a, ids_b
        return None

    @staticmethod
    def _ends(ids: np.ndarray, first: np.ndarray, tokens) -> np.ndarray:
        ends = np.cumsum(np.array([len(t) for t in tokens.bytes_of], np.int64)[ids])
        before = np.r_[0, ends][first[:-1]]
        return ends - np.repeat(before, np.diff(first))

    def text_of(self, places_a: np.ndarray) -> np.ndarray:
        """The texts that A tokens stand in."""
        return np.searchsorted(self.first_a, places_a, side="right") - 1

    def group_digests(self) -> list[str]:
        """sha256 of each text's groups as decimal ids, 'a1,a2|b1;a3|b2'; '' without tokens."""
        group_a = np.cumsum(self.last_a) - self.last_a
        group_b = np.cumsum(self.last_b) - self.last_b
        n = int(self.last_a.sum())
        up_to_a = np.cumsum(np.bincount(group_a, minlength=n))
        before_b = np.r_[0, np.cumsum(np.bincount(group_b, minlength=n))]
        words = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        # Even numbers are followed by a comma, odd ones end a side of a group.
        words[np.arange(len(self.ids_a)) + before_b[group_a]] = self.ids_a * 4 + self.last_a
        words[np.arange(len(self.ids_b)) + up_to_a[group_b]] = self.ids_b * 4 + 2 + self.last_b
        written, out, bounds = _Written(), [], (self.first_a + self.first_b).tolist()
        for start, after in zip(bounds[:-1], bounds[1:]):
            joined = b"".join(map(written.__getitem__, words[start:after].tolist()))
            out.append(hashlib.sha256(joined[:-1]).hexdigest() if joined else "")
        return out

    def pairs(self):
        """Distinct id pairs (a * 2^32 + b) of the chunk, the number of its texts with each,
        and, by text, places in that list and numbers of links, with the texts' bounds."""
        both = (self.ids_a[self.link_a].astype(np.int64) << 32) | self.ids_b[self.link_b]
        pairs, place = np.unique(both, return_inverse=True)
        key, times = np.unique(self.text_of(self.link_a) * max(1, len(pairs)) + place, return_counts=True)
        text, place = np.divmod(key, max(1, len(pairs)))
        bounds = np.searchsorted(text, np.arange(len(self.counts) + 1))
        return pairs, np.bincount(place, minlength=len(pairs)), place, times, bounds


class _Written(dict):
    """Numbers of ``group_digests`` as text, kept while a chunk is written."""

    def __missing__(self, word: int) -> bytes:
        end = b"," if word % 2 == 0 else b"|" if word % 4 == 1 else b";"
        self[word] = text = b"%d%b" % (word // 4, end)
        return text


def _chunks(batches, chunk_bytes: int):
    """(ids of documents, texts) of about ``chunk_bytes``."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= chunk_bytes:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def _align(path_a: str, path_b: str, chunk_bytes: int):
    def run(batches):
        a, b = ByteTokens(path_a), PieceTokens(path_b)
        for doc_ids, texts in _chunks(batches, chunk_bytes):
            found = Aligned(texts, a, b)
            of_links = np.argsort(found.text_of(found.link_a), kind="stable")
            link_a, link_b = found.link_a[of_links], found.link_b[of_links]
            text = found.text_of(link_a)
            links = np.searchsorted(text, np.arange(len(texts) + 1))
            cut_a, cut_b = np.flatnonzero(found.last_a), np.flatnonzero(found.last_b)
            of_cut = found.text_of(cut_a)
            cuts = np.searchsorted(of_cut, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc_ids, pa.int64()),
                    _lists(found.ids_a, found.first_a),
                    _lists(found.ids_b, found.first_b),
                    _lists(link_a - found.first_a[text], links),
                    _lists(link_b - found.first_b[text], links),
                    _lists(cut_a + 1 - found.first_a[of_cut], cuts),
                    _lists(cut_b + 1 - found.first_b[of_cut], cuts),
                ],
                names=["doc_id", "a_ids", "b_ids", "link_a", "link_b", "cut_a", "cut_b"],
            )
        release_memory()

    return run


def alignments(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, a_ids, b_ids (tokens), link_a, link_b (places of linked tokens, from 0),
    cut_a, cut_b (tokens before each place where both end): one row per row of ``docs``
    (doc_id, text), without a shuffle.

    Texts that are null or empty, or whose tokens don't spell ' ' + text, have empty
    lists. Repeated rows and null ids are kept; an empty table gives no rows; other
    columns aren't read.
    """
    return id_and_text(docs).mapInArrow(_align(path_a, path_b, chunk_bytes), f"doc_id long, {_IDS}, {_LINKS}")


_CHUNK_ROWS = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "places array<int>, times array<int>, pairs array<long>, holders array<int>"
)


def _digest(path_a: str, path_b: str, chunk_bytes: int):
    """Rows of documents, and for each chunk a row with its pairs (``pairs`` not null)."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64())]
        + [("n_links", pa.int64()), ("groups_sha256", pa.string()), ("places", pa.list_(pa.int32()))]
        + [("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int32()))]
    )

    def run(batches):
        a, b = ByteTokens(path_a), PieceTokens(path_b)
        for number, (doc_ids, texts) in enumerate(_chunks(batches, chunk_bytes)):
            chunk, found = TaskContext.get().partitionId() << 32 | number, Aligned(texts, a, b)
            pairs, holders, places, times, bounds = found.pairs()
            columns = {
                "chunk": pa.array(np.full(len(texts), chunk)),
                "doc_id": pa.array(doc_ids, pa.int64()),
                "n_a": pa.array(found.counts[:, 0]),
                "n_b": pa.array(found.counts[:, 1]),
                "n_groups": pa.array(found.n_groups.astype(np.int64)),
                "n_links": pa.array(found.n_links.astype(np.int64)),
                "groups_sha256": pa.array(found.group_digests(), pa.string()),
                "places": _lists(places, bounds),
                "times": _lists(times, bounds),
            }
            rows = pa.RecordBatch.from_arrays(
                [columns.get(f.name, pa.nulls(len(texts), f.type)) for f in schema], schema=schema
            )
            for start in range(0, len(texts), 256):
                yield rows.slice(start, 256)
            own = {"chunk": pa.array([chunk]), "pairs": pa.array([pairs], pa.list_(pa.int64())), "holders": pa.array([holders], pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(1, f.type)) for f in schema], schema=schema)
            del found, rows
        release_memory()

    return run


def _add_counts(docs: pa.Table, counts: pa.Table) -> pa.Table:
    """Sums over the links of a chunk's documents."""
    place = counts.column("place").to_numpy()
    of_pair, best = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
    of_pair[place] = counts.column("n_docs").to_numpy()
    best[place] = counts.column("best").to_numpy(zero_copy_only=False)
    n_best, count_sum = [], []
    for batch in docs.to_batches():
        places, times = batch.column("places"), batch.column("times").flatten().to_numpy().astype(np.int64)
        at, text = places.flatten().to_numpy(), np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
        for out, values in ((n_best, times * best[at]), (count_sum, times * of_pair[at])):
            sums = np.zeros(len(places), np.int64)
            np.add.at(sums, text, values)
            out.append(sums)
    kept = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    none = [np.zeros(0, np.int64)]
    return kept.append_column("n_best", pa.array(np.concatenate(n_best or none))).append_column(
        "count_sum", pa.array(np.concatenate(count_sum or none))
    )


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, n_docs (documents that hold it linked), best (no pair of the same A id is held
    by more) from rows (pair, holders)."""
    counts = chunks.groupBy("pair").agg(F.sum(F.col("holders").cast("long")).alias("n_docs"))
    counts = staged(counts.withColumn("a_id", F.shiftright("pair", 32)), "pair-counts")
    most = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "a_id").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def alignment_counts(docs: DataFrame, path_a: str, path_b: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose id pair is held by
    as many documents as any pair of its A id), count_sum (over the links, the documents that
    hold the pair): one row per row of ``docs`` (doc_id, text).

    Each row counts as a document, repeated ones and those with null ids too. Texts
    without tokens (see ``alignments``) have zeros and an empty digest. An empty
    table gives no rows; other columns aren't read.
    """
    rows = staged(id_and_text(docs).mapInArrow(_digest(path_a, path_b, chunk_bytes), _CHUNK_ROWS), "aligned")
    own = rows.filter("pairs IS NOT NULL").select(
        "chunk", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "of")
    )
    own = own.select("chunk", "place", F.col("of.pairs").alias("pair"), F.col("of.holders").alias("holders"))
    counts = own.join(pair_counts(own.select("pair", "holders")), "pair").select(
        F.col("chunk").alias("of_chunk"), "place", "n_docs", "best"
    )
    texts = rows.filter("pairs IS NULL").drop("pairs", "holders")
    # A chunk without any pair has no counts: its group has no rows on that side.
    return (
        texts.groupBy("chunk")
        .cogroup(counts.groupBy("of_chunk"))
        .applyInArrow(
            _add_counts,
            "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long",
        )
    )
