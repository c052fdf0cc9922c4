"""Exact token counts at every prefix of a text, by dynamic programming.

For a byte-level BPE vocabulary the encoding of a piece of text is determined by
its last token: among the tokens that end a prefix, exactly one is compatible
with the last token of what stands before it (the two, put together, encode to
themselves). So one pass over a piece finds the last token, and with it the
count, of each of its prefixes: count[i] = count[i - len(last[i])] + 1. Texts are
split into pieces as the vocabulary file says; the counts of the pieces add up,
and where cutting a text changes the split (white-space runs, contractions), the
cut piece is counted as it then stands. With the counts of all prefixes at hand,
a budget or a truncation is a lookup: nothing is encoded again.
"""

import json
import re
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tillwright.llm.shared import id_and_text
from tillwright.llm.words import LETTERS, NUMBERS

#: n_tokens above which a document is over the limit.
LIMIT = 1024
#: Distinct pieces whose counts a task remembers.
CACHED_PIECES = 300_000
#: Bytes of the beginnings whose counts are shared by all pieces that begin so.
KNOWN_STARTS = (12, 9, 6, 4)

# Fixed value: the bytes that stand for themselves in byte-level vocabulary files.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Fixed value: how byte-level vocabularies split texts of these characters alone.
# Other texts are split by the library.
_PLAIN = re.compile("[\\t-\\r\x20-\x7e\xa0-\u024f\u2010-\u2027\u2030-\u203a\u20ac]*")
_L, _N = LETTERS, NUMBERS
_PLAIN_PIECES = re.compile(
    rf" ?[{_L}]+| ?[{_N}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+"
)
_RUNS = regex.compile(r"\s\s+")
_LAST = itemgetter(-1)


def byte_of() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(_PRINTABLE)]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class _Counts(dict):
    """The counts of pieces met before; bounded, and without long ones."""

    def __init__(self, programme):
        super().__init__()
        self._programme = programme

    def __missing__(self, piece: str) -> tuple[int, ...]:
        counts = self._programme(piece)
        if len(piece) < 64:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = counts
        return counts


class PrefixCounter:
    """Counts by the rules of the vocabulary file at ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        of_character = byte_of()
        as_bytes = lambda mapped: bytes(map(of_character.__getitem__, mapped))
        merges = [tuple(map(as_bytes, pair)) for pair in rules["model"]["merges"]]
        self._ranks = {pair: i for i, pair in enumerate(merges)}
        self._made_of = {left + right: (left, right) for left, right in reversed(merges)}
        # The vocabulary's tokens by their bytes from last to first.
        self._endings: dict = {}
        for token in rules["model"]["vocab"]:
            if all(c in of_character for c in token):
                node = self._endings
                for byte in reversed(as_bytes(token)):
                    node = node.setdefault(byte, {})
                node[-1] = as_bytes(token)
        self._pre = Tokenizer.from_file(path).pre_tokenizer
        self.specials = [t["content"] for t in rules["added_tokens"]]
        self._special = regex.compile("|".join(map(regex.escape, self.specials)))
        self._pairs: dict[tuple[bytes, bytes], bool] = {}
        self._edges: tuple[dict, dict] = ({}, {})
        self._starts: dict[bytes, tuple[list, list]] = {}
        self._counts = _Counts(self.programme)

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, float]]:
        """The parts that stand at one side of a token while it is merged together,
        from the single byte to the whole, with the rank of the merge that takes
        each into the next."""
        known = self._edges[side].get(token)
        if known is None:
            known, rank = [], float("inf")
            while True:
                known.append((token, rank))
                if token not in self._made_of:
                    break
                rank = self._ranks[self._made_of[token]]
                token = self._made_of[token][side]
            known.reverse()
            self._edges[side][known[-1][0]] = known
        return known

    def _compatible(self, before: bytes, token: bytes) -> bool:
        """Whether the two stay apart when they are encoded together: while both are
        merged, no merge of the parts that touch is due before those parts are taken
        into longer ones. Of equal merges the left one comes first."""
        if not before:
            return True
        known = self._pairs.get((before, token))
        if known is None:
            if len(self._pairs) > 500_000:
                self._pairs.clear()
            left, right = self._edge(before, 1), self._edge(token, 0)
            i = j = 0
            while True:
                (a, taken_a), (b, taken_b) = left[i], right[j]
                rank = self._ranks.get((a, b))
                if rank is not None and rank < taken_a and rank <= taken_b:
                    known = False
                    break
                if i + 1 == len(left) and j + 1 == len(right):
                    known = True
                    break
                if taken_a <= taken_b:
                    i += 1
                else:
                    j += 1
            self._pairs[before, token] = known
        return known

    def _start(self, text: bytes) -> tuple[list[bytes], list[int]]:
        """Last tokens and counts of the prefixes of ``text`` that are known from others."""
        for size in KNOWN_STARTS:
            if len(text) >= size and (known := self._starts.get(text[:size])):
                return list(known[0]), list(known[1])
        return [b""], [0]

    def programme(self, piece: str) -> tuple[int, ...]:
        """The token counts of the prefixes of one piece, by characters."""
        text = piece.encode()
        endings, pairs = self._endings, self._pairs
        last, counts = self._start(text)
        known = len(last) - 1
        for end in range(known + 1, len(text) + 1):
            node, tokens = endings, []
            for start in range(end - 1, -1, -1):
                node = node.get(text[start])
                if node is None:
                    break
                if -1 in node:
                    tokens.append((start, node[-1]))
            for start, token in reversed(tokens):
                fits_on = pairs.get((last[start], token))
                if fits_on or fits_on is None and self._compatible(last[start], token):
                    last.append(token)
                    counts.append(counts[start] + 1)
                    break
            else:
                raise ValueError(f"the vocabulary lacks byte {text[end - 1]}")
        for size in KNOWN_STARTS:
            if known < size <= len(text):
                if len(self._starts) > CACHED_PIECES:
                    self._starts.clear()
                self._starts[text[:size]] = last[: size + 1], counts[: size + 1]
        found = counts[1:]
        if len(text) != len(piece):
            found = [c for i, c in enumerate(found, 1) if i == len(text) or text[i] & 0xC0 != 0x80]
        if piece in ("'re", "'ve", "'ll"):  # cut short, it is an apostrophe and a letter
            found[1] = 2
        return tuple(found)

    def _split(self, text: str) -> list[str]:
        if text.isascii() and text.isprintable() or _PLAIN.fullmatch(text):
            return _PLAIN_PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self._pre.pre_tokenize_str(text)]

    def _ordinary(self, text: str) -> np.ndarray:
        found = [self._counts[p] for p in self._split(text)]
        if not found:
            return np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ends = np.fromiter((f[-1] for f in found), np.int64, len(found))
        inside = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
        counts = inside + np.repeat(np.cumsum(ends) - ends, sizes)
        for run in _RUNS.finditer(text):  # cut inside a run, what is left of it is one piece
            a, b = run.span()
            cut = np.array(self._counts[text[a:b]])
            at = b if b == len(text) else b - 1
            before = counts[a - 1] if a else 0
            counts[a:b] = before + cut
            if at < b:  # the whole run before a character that takes its last space along
                counts[b - 1] = before + cut[-1]
        return counts

    def prefixes(self, text: str) -> np.ndarray:
        """The token count of text[:i] for every i from 0 to len(text).

        A special token's text is one token where it is complete; a cut before its
        end leaves ordinary text.
        """
        out, base, start = [np.zeros(1, np.int64)], 0, 0
        for special in self._special.finditer(text):
            a, b = special.span()
            counts = self._ordinary(text[start : b - 1])
            whole = (counts[a - start - 1] if a > start else 0) + 1
            out += [base + counts, np.array([base + whole])]
            base, start = base + whole, b
        out.append(base + self._ordinary(text[start:]))
        return np.concatenate(out)


    def totals(self, text: str, budget: int) -> tuple[int, int]:
        """The token count of ``text``, and the characters of its longest prefix of
        at most ``budget`` tokens."""
        if _RUNS.search(text) or self._special.search(text):
            counts = self.prefixes(text)
            return int(counts[-1]), int(np.flatnonzero(counts <= budget)[-1])
        pieces = self._split(text)
        whole = list(map(_LAST, map(self._counts.__getitem__, pieces)))
        total = sum(whole)
        if total <= budget:
            return total, len(text)
        # Every prefix of a piece has a token at least, so the last prefix within the
        # budget ends in the first piece that brings the sum above it, or before it.
        ends = np.cumsum(whole)
        at = int(np.searchsorted(ends, budget, side="right"))
        before = int(ends[at - 1]) if at else 0
        inside = np.flatnonzero(before + np.array(self._counts[pieces[at]]) <= budget)
        return total, sum(map(len, pieces[:at])) + (int(inside[-1]) + 1 if len(inside) else 0)


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and prefix_tokens array<int>: the exact token count of each of the
    text's prefixes, from the empty one to the whole text. Rows as ``count_tokens``."""

    def run(batches):
        counter = PrefixCounter(path)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                counts = pa.array([counter.prefixes(text).astype(np.int32)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), counts], names=["doc_id", "prefix_tokens"]
                )

    return id_and_text(docs).mapInArrow(run, "doc_id long, prefix_tokens array<int>")


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, keep_chars: one row per row of ``docs``
    (doc_id, text), without a shuffle.

    ``keep_chars`` is the length in code points of the longest prefix of at most
    ``limit`` tokens. A null or empty text has no tokens. Very long pieces without
    a space take time in proportion to their length. Repeated rows and null ids
    are kept; an empty table gives no rows; other columns aren't read.
    """

    def run(batches):
        counter = PrefixCounter(path)
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                total, keep = counter.totals(text, limit)
                rows.append((len(text.encode()), total, total > limit, keep))
            sizes, totals, over, keep = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(over, pa.bool_()),
                    pa.array(keep, pa.int64()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "keep_chars"],
            )

    return id_and_text(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, keep_chars long"
    )
