"""Splitting texts into the words of a word-level BPE vocabulary file."""

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Regex, Tokenizer, pre_tokenizers

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for each core

#: Characters whose normal form, lower case and class every Unicode version
#: agrees on. Texts of these alone are cut at white space first.
_PLAIN = re.compile("[\\t-\\r\x20-\x7e\xa0-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u203a\u20ac]*")

# The letters and numbers among them.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
# What the vocabulary file's pattern finds in a plain chunk.
_PLAIN_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")


#: Words that the library gets as one string.
JOINED_WORDS = 20_000


def is_plain(text: str) -> bool:
    return text.isascii() and text.isprintable() or _PLAIN.fullmatch(text) is not None


class Words:
    """Splits and encodes by the rules of the file at ``path``.

    A text is cut into chunks, whose words follow each other: the chunks of a
    plain text stand between white space, other texts and special tokens are
    chunks as a whole. Many texts repeat the same chunks.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        # Splitting needs no vocabulary, which takes most of the memory and time.
        bare = rules | {"model": rules["model"] | {"vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}
        self._path, self._model = path, None
        self._normalizer = Tokenizer.from_str(json.dumps(bare)).normalizer
        pattern = rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._rest = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        # A word's bytes as the vocabulary writes them, and its merges alone.
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._mapped = {b: "".join(m for m, _ in mapped(chr(b)))[-1] for b in range(128)}
        for lead in range(0xC2, 0xE0):  # two-byte characters show what the other bytes become
            for low in (0x80, 0x81) if lead > 0xC2 else range(0x80, 0xC0):
                text = "".join(m for m, _ in mapped(bytes([lead, low]).decode()))
                self._mapped[lead], self._mapped[low] = text[0], text[1]
        for lead in range(0xE0, 0xF5):
            first = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
            tail = [first] + [0x80] * (1 if lead < 0xF0 else 2)
            self._mapped[lead] = "".join(m for m, _ in mapped(bytes([lead, *tail]).decode()))[0]
        self.specials = {t["content"]: t["id"] for t in rules["added_tokens"]}
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")

    def chunks(self, text: str) -> list[str]:
        if "<|" in text:
            return [c for part in self._special.split(text) for c in self._part(part)]
        return self._part(text)

    def _part(self, part: str) -> list[str]:
        if part in self.specials or not is_plain(part):
            return [part]
        return part.lower().split()

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk. Special tokens are words of their own."""
        if is_word(chunk) or chunk in self.specials:
            return [chunk]
        if is_plain(chunk):
            return _PLAIN_WORDS.findall(chunk)
        return [word for word, _ in self._rest.pre_tokenize_str(self._normalizer.normalize_str(chunk))]

    def split(self, text: str) -> list[str]:
        return [word for chunk in self.chunks(text) for word in self.words(chunk)]

    def cut(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct chunks of texts, the places of all chunks in that list, text by text,
        and how many chunks each text has."""
        simple = np.array(["<|" not in t and is_plain(t) for t in texts], bool)
        kind = pa.large_list(pa.large_string())
        lists = pc.utf8_split_whitespace(pa.array([t.lower() for t, s in zip(texts, simple) if s], pa.large_string())).cast(kind)
        if not simple.all():
            others = pa.array([self.chunks(t) for t, s in zip(texts, simple) if not s], kind)
            order = np.where(simple, np.cumsum(simple) - 1, len(lists) + np.cumsum(~simple) - 1)
            lists = pa.concat_arrays([lists, others]).take(pa.array(order))
        chunks, text_of = lists.flatten(), pc.list_parent_indices(lists)
        some = pc.not_equal(chunks, "")  # beside white space at the ends
        found = chunks.filter(some).dictionary_encode()
        counts = np.bincount(text_of.filter(some).to_numpy(), minlength=len(texts))
        return strings(found.dictionary), found.indices.to_numpy(), counts

    def encode_flat(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and where each word's end. The library
        gets many words in one call; the last piece of a word is marked as such."""
        mapped = [w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(self._mapped) for w in words]
        if self._model is None:
            self._model = Tokenizer(Tokenizer.from_file(self._path).model)
            self._model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()  # no mapped byte is white space
            last = [i for piece, i in self._model.get_vocab().items() if piece.endswith(self._model.model.end_of_word_suffix)]
            self._last = np.zeros(self._model.get_vocab_size(), bool)
            self._last[last] = True
        parts = [" ".join(mapped[i : i + JOINED_WORDS]) for i in range(0, len(mapped), JOINED_WORDS)]
        found = [np.array(e.ids, "<u4") for e in self._model.encode_batch_fast(parts, add_special_tokens=False)]
        ids = np.concatenate(found) if found else np.zeros(0, "<u4")
        ends = np.flatnonzero(self._last[ids]) + 1
        if not self.specials.keys().isdisjoint(words):
            each = np.split(ids, ends[:-1])
            each = [np.array([self.specials[w]], "<u4") if w in self.specials else of for w, of in zip(words, each)]
            ids, ends = np.concatenate(each), np.cumsum([len(of) for of in each])
        return ids, ends

    def encode_bytes(self, words: list[str]) -> list[bytes]:
        """The ids of each word as little-endian 32-bit integers, one after the other."""
        return in_bytes(*self.encode_flat(words))

    def pieces(self) -> list[tuple[int, str]]:
        """The vocabulary: every id and the piece it stands for."""
        return sorted((i, piece) for piece, i in Tokenizer.from_file(self._path).get_vocab(with_added_tokens=True).items())


class ChunkIds(dict):
    """Chunks to their ids as little-endian 32-bit integers.

    ``learn`` encodes what new chunks bring in one go. The memory of a task is
    bounded: beyond ``limit`` bytes of chunks and ids it starts anew.
    """

    def __init__(self, words: Words, limit: int = 16 << 20):
        super().__init__()
        self._words, self._limit, self._held = words, limit, 0

    def forget(self) -> None:
        self.clear()
        self._held = 0

    def learn(self, chunks: list[str]) -> None:
        if self._held > self._limit:
            self.forget()
        new = [c for c in chunks if c not in self]
        made = {c: self._words.words(c) for c in new if not is_word(c)}
        words = list({c for c in new if c not in made}.union(*made.values()))
        ids = dict(zip(words, self._words.encode_bytes(words)))
        for chunk, of in made.items():
            ids[chunk] = b"".join(map(ids.__getitem__, of)) if len(of) != 1 else ids[of[0]]
        found = {c: ids[c] for c in new}
        self._held += sum(map(len, found)) + sum(map(len, found.values()))
        self.update(found)

    def flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's end."""
        chunks, places, counts = self._words.cut(texts)
        self.learn(chunks)
        return laid_out(list(map(self.__getitem__, chunks)), places, counts)

    def ids(self, texts: list[str]) -> list[bytes]:
        out = []
        for some in by_bytes(texts):
            out += in_bytes(*self.flat(some))
        return out


def is_word(chunk: str) -> bool:
    """Whether a chunk is seen at once to be a word as a whole: letters alone."""
    return chunk.isalpha() and (chunk.isascii() or _PLAIN.fullmatch(chunk) is not None)


def laid_out(found: list[bytes], places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids (bytes, by distinct chunk) of texts, given by the places of their chunks and
    how many each text has: all ids, one after the other, and where each text's end."""
    sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
    values = pa.array(np.frombuffer(b"".join(found), "<u4"))
    lists = pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)]), values)
    ids = lists.take(pa.array(places)).flatten().to_numpy()
    return ids, np.r_[0, np.cumsum(sizes[places])][np.cumsum(counts)]


def in_bytes(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    joined, ends = ids.tobytes(), (4 * ends).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()  # faster than to_pylist()


def by_bytes(texts: list[str], most: int = 1 << 20):
    """The texts in runs of about ``most`` characters, a longer one by itself."""
    some, size = [], 0
    for text in texts:
        if some and size + len(text) > most:
            yield some
            some, size = [], 0
        some.append(text)
        size += len(text)
    if some:
        yield some
