"""Operators 11 to 13 against brute force, and on odd inputs."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillwright.llm import alignment, decontamination, lexical_search

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", "  ", "a", "a b c", "A  b\tc", "the  \n\n cat's they're", "x<|endoftext|>y", "été déjà 中文 😀é", "▁a ▁", "<s> <0x0A>\x00",
    "same words here again and again", "same words here again and again", "long " * 3000, "q" * 5000, "\x1cİΣ", " " * 3000,
    "\\", "a\\b", "".join(map(chr, range(9, 127))),
]
ALPHABET = ["re", "ve", "  ", "the", "é", "中", "<|endoftext|>", "ing", "😀", "́", "\x1c", "İ", "▁", "<s>", "\x00"] + [chr(c) for c in range(9, 127)]


def noise(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Null and repeated ids and texts, and columns named like those the operators make."""
    rows = [(i, t, "s", 1, 2, "w", 3) for i, t in enumerate(ODD + noise(150))]
    rows += [(None, "a", None, 1, 2, "w", 3), (None, "a", None, 1, 2, "w", 3), (None, None, None, None, None, None, None), (3, "a b", "s", 1, 2, "w", 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, row int, chunk int, items string, n_words int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.filter("false")


def spelt(ids, pieces):
    return [pieces[i] for i in ids]


def brute_alignments(texts):
    """Per text: A ids, B ids, links as places, ends of groups as numbers of tokens."""
    library, model = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    library.encode_special_tokens = True
    of = {c: b for b, c in ((b, t) for b in range(256) for t in [_shown(b)])}
    for text in texts:
        text = text or ""
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        bytes_a = [bytes(of[c] for c in library.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, model.id_to_piece(i)) for i in b)]
        if not b" " + text.encode() == b"".join(bytes_a) == b"".join(bytes_b):
            yield [], [], [], []
            continue
        ends_a, ends_b = (np.cumsum([len(t) for t in side]).tolist() for side in (bytes_a, bytes_b))
        starts_b, links = [0] + ends_b[:-1], []
        for i, (start, end) in enumerate(zip([0] + ends_a[:-1], ends_a)):
            j = int(np.searchsorted(ends_b, start, side="right"))
            while j < len(b) and starts_b[j] < end:
                links.append((i, j))
                j += 1
        ends = sorted(set(ends_a) & set(ends_b))
        yield a, b, links, [(ends_a.index(e) + 1, ends_b.index(e) + 1) for e in ends]


def _shown(byte):
    """The character that byte-level vocabularies write for a byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return chr(byte) if byte in printable else chr(256 + [b for b in range(256) if b not in printable].index(byte))


def test_alignments_equal_brute_force(odd, none):
    want = collections.Counter()
    rows = odd.collect()
    for row, (a, b, links, cuts) in zip(rows, brute_alignments([r.text for r in rows])):
        want[row.doc_id, tuple(a), tuple(b), tuple(links), tuple(cuts)] += 1
    for size in (200, 1 << 20):
        got = collections.Counter(
            (r.doc_id, tuple(r.a_ids), tuple(r.b_ids), tuple(zip(r.link_a, r.link_b)), tuple(zip(r.cut_a, r.cut_b)))
            for r in alignment.alignments(odd, BYTE, PIECE, size).collect()
        )
        assert got == want
    assert alignment.alignments(none, BYTE, PIECE).count() == 0


def brute_alignment_counts(rows):
    found = list(brute_alignments([t for _, t in rows]))
    pairs = [[(a[i], b[j]) for i, j in links] for a, b, links, _ in found]
    held = collections.Counter(p for some in pairs for p in set(some))
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    for (doc_id, _), (a, b, links, cuts), some in zip(rows, found, pairs):
        groups, before = [], (0, 0)
        for cut in cuts:
            groups.append("|".join(",".join(map(str, ids[s:e])) for ids, s, e in zip((a, b), before, cut)))
            before = cut
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best, total = sum(held[p] == most[p[0]] for p in some), sum(held[p] for p in some)
        yield doc_id, len(a), len(b), len(cuts), len(links), best, total, digest


@pytest.mark.parametrize("size", [100, 1 << 20])
def test_alignment_counts_equal_brute_force(odd, none, size):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = alignment.alignment_counts(odd, BYTE, PIECE, size).select(names)
    want = brute_alignment_counts([(r.doc_id, r.text) for r in odd.collect()])
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(want)
    assert alignment.alignment_counts(none, BYTE, PIECE).count() == 0


def test_alignment_counts_of_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    got = alignment.alignment_counts(docs, BYTE, PIECE, 50_000).select("doc_id", "n_links", "n_best", "count_sum", "groups_sha256")
    want = brute_alignment_counts([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(map(tuple, got.collect())) == sorted((w[0], *w[4:]) for w in want)


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_contamination(texts, items):
    windows = collections.defaultdict(set)
    for name, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - 9) if words else 0):
            windows[tuple(words[i : i + 10])].add(name)
    sizes = sorted({len(w) for w in windows})
    for text in texts:
        words, hit, names = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    names |= found
        edges = sorted(hit)
        spans = [i for i in edges if i - 1 not in hit], [i + 1 for i in edges if i + 1 not in hit]
        yield len(words), tuple(zip(*spans)), tuple(sorted(names - {None}))


@pytest.fixture(scope="module")
def passages(spark, odd):
    """Documents and items over few words, so that windows repeat, overlap and share ends."""
    rnd = random.Random(4)
    vocabulary = ["a", "b", "c", "d", "É", "7", "中", "it's", "w"]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", "\n", "-", ", ", "\\"]) for _ in range(n))
    items = [(i, text(rnd.choice([12, 14, 30, 200]))) for i in range(25)]
    items += [(100, "c d w"), (101, "É"), (102, ""), (103, None), (None, text(15)), (7, items[7][1]), (104, items[7][1]), (5, text(20))]
    docs = []
    for i in range(80):
        some = [text(rnd.randint(0, 40)) for _ in range(3)]
        some.insert(1, rnd.choice(items)[1] or "")
        docs.append((1000 + i, "".join(some).swapcase() if i % 2 else " ".join(some)))
    docs += [(1000, docs[0][1]), (2000, docs[1][1]), (None, docs[2][1]), (None, docs[2][1])]
    items = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, block int, words string")
    return odd.select("doc_id", "text", "row", "items").union(spark.createDataFrame([(*d, 1, "") for d in docs], "doc_id long, text string, row int, items string")), items


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_overlaps_equal_brute_force(passages, block_bytes, monkeypatch):
    docs, items = passages
    monkeypatch.setattr(decontamination, "ITEM_WORDS", 40)  # long items take several rows
    rows = docs.collect()
    want = brute_contamination([r.text for r in rows], [(r.item_id, r.text) for r in items.collect()])
    got = decontamination.overlaps(docs, items, block_bytes).collect()
    found = collections.Counter((r.doc_id, r.n_words, tuple((s.first, s.after) for s in r.spans), tuple(r["items"])) for r in got)
    assert found == collections.Counter((r.doc_id, *w) for r, w in zip(rows, want))


def test_contamination(passages, none):
    docs, items = passages
    got = {}
    for r in decontamination.contamination(docs.filter("doc_id >= 1001"), items).collect():
        got[r.doc_id] = r
    rows = docs.filter("doc_id >= 1001").collect()
    for row, (n, spans, names) in zip(rows, brute_contamination([r.text for r in rows], [(r.item_id, r.text) for r in items.collect()])):
        r, n_hit = got[row.doc_id], sum(b - a for a, b in spans)
        digest = hashlib.sha256(",".join(sorted(map(str, names))).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, n_hit, len(names), digest, n_hit > 0)
    assert decontamination.contamination(none, items).count() == 0
    nothing = decontamination.contamination(docs, items.filter("false"))
    assert nothing.filter("contaminated").count() == 0 and nothing.count() == docs.count()


def test_long_texts_are_scanned_in_pieces():
    rnd = random.Random(6)
    words = [rnd.choice("abcdefgh").encode() for _ in range(3000)]
    searches = decontamination.tables([(1, b" ".join(words[500:530])), (2, b" ".join(words[700:703])), (3, b" ".join(words[1000:1010]))])
    whole = decontamination.scan(b" ".join(words), searches)
    for size in (1, 7, 100):
        original, decontamination.pieces.__defaults__ = decontamination.pieces.__defaults__, (size,)
        try:
            assert decontamination.scan(b" ".join(words), searches) == whole
        finally:
            decontamination.pieces.__defaults__ = original


def brute_ranking(docs, items, top):
    """Rows (item_id, rank, doc_id, score) by scoring every document."""
    terms = lambda t: collections.Counter(re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
    found = [(d, terms(t)) for d, t in docs]
    df = collections.Counter(t for _, c in found for t in c)
    n_docs, n_terms = sum(bool(c) for _, c in found), sum(c.total() for _, c in found)
    for item_id, text in items:
        scores = []
        for doc_id, c in found:
            m = 100 - 25 + 25 * c.total() * n_docs // n_terms if n_terms else 0
            score = 0
            for t, n in terms(text).items():
                if c[t]:
                    score += n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1):
            yield item_id, rank, doc_id, -score


@pytest.mark.parametrize(("shard_docs", "block_docs", "item_bytes", "top"), [(4096, 32, 1 << 20, 20), (7, 2, 300, 3), (50, 4, 2000, 5)])
def test_ranking_equals_brute_force(spark, passages, monkeypatch, shard_docs, block_docs, item_bytes, top):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard_docs)
    odd, _ = passages
    rnd = random.Random(8)
    words = [f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(400)] + ["É", "中", "It's"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", "\n", "-", "\\"]) for _ in range(n))
    docs = [(i, text(rnd.choice([3, 20, 60]))) for i in range(300)]
    docs += [(1000 + i, docs[i % 9][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[6][1]), (None, docs[7][1])]  # ties
    items = [(i, text(rnd.choice([1, 5, 40]))) for i in range(30)] + [(30, docs[3][1]), (31, ""), (32, None), (None, "w1 w1 w2"), (3, "w5 w9"), (3, "w5 w9"), (33, "nowhere")]
    docs = odd.select("doc_id", "text", "row", "items").union(spark.createDataFrame([(*d, 1, "") for d in docs], "doc_id long, text string, row int, items string"))
    items = spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, item int, rank string")
    got = collections.Counter(tuple(r) for r in lexical_search.ranked(docs, items, top, block_docs, item_bytes).collect())
    want = brute_ranking([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], top)
    assert got == collections.Counter(want)
    if top == 20:
        assert lexical_search.ranked(docs.filter("false"), items).count() == 0
        assert lexical_search.ranked(docs, items.filter("false")).count() == 0


def test_blocks_are_skipped_only_by_their_bounds():
    """Blocks hold each document of a term once, and summaries are maxima of theirs."""
    rnd = np.random.default_rng(2)
    impacts = (rnd.integers(0, 900, (200, 40)) * (rnd.random((200, 40)) < 0.3)).astype(np.int32)
    beside = [np.arange(c, 40) for c in range(40)]
    shard = lexical_search.Shard(list(range(200)), impacts, np.arange(40, 0, -1), beside, 8)
    for column in range(40):
        members, bounds, summaries = shard.blocks(column)
        assert sorted(members) == np.flatnonzero(impacts[:, column]).tolist() and bounds[-1] == len(members)
        for a, b, summary in zip(bounds[:-1], bounds[1:], summaries):
            assert (summary == impacts[members[a:b], column:].max(axis=0)).all()
