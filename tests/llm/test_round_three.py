"""What the third round's findings asked for."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from tillwright.llm import suffix_dedup, word_bpe, words

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_words_are_sent_packed_by_bucket():
    """A few rows for each bucket of words, not one for each word."""
    texts = [" ".join(f"w{i}x{k}" for i in range(400)) for k in range(10)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(10)), pa.array(texts), pa.array([k % 5 for k in range(10)], pa.int32())], names=["doc_id", "text", "block"]
    )
    sent = list(word_bpe._bucket_words(WORD, 3)([batch]))
    assert sum(map(len, sent)) == 3
    rows = pa.concat_tables([word_bpe._rows(p.as_py()) for b in sent for p in b.column("packed")])
    got = sorted(zip(rows.column("word").to_pylist(), rows.column("block").to_pylist()))
    split = words.Words(WORD)
    assert got == sorted({(w, k % 5) for k, t in enumerate(texts) for w in split.split(t)})


def test_words_encoded_together():
    """Many words in one call of the library get the ids that each has by itself."""
    library, split = Tokenizer.from_file(WORD), words.Words(WORD)
    some = ["the", "zzqxj", "...", "7", "é", "ß", "東京", next(iter(split.specials)), "'s", "aaaaaaaaaaaaaaaaaaaaaaaa"]
    some *= words.JOINED_WORDS // len(some) + 2
    ids, ends = split.encode_flat(some)
    for word, of in list(zip(some, np.split(ids, ends[:-1])))[-30:]:
        assert of.tolist() == library.encode(word, add_special_tokens=False).ids, word
    assert split.encode_bytes([]) == []


def test_rounds_stage_no_contexts(spark, monkeypatch):
    """The bytes of a gram's contexts aren't written again by each round of halving."""
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abcdefgh ") for _ in range(90))
    texts = ["".join(rnd.choice("xyz") for _ in range(30)) + passage[rnd.randint(0, 20) : rnd.randint(60, 90)] for _ in range(12)]
    docs = spark.createDataFrame([(i, t + "".join(rnd.choice("uvw") for _ in range(30))) for i, t in enumerate(texts)], "row long, text string")
    written, staged = [], suffix_dedup.staged
    monkeypatch.setattr(suffix_dedup, "staged", lambda df, label: written.append((label, df.columns)) or staged(df, label))
    assert suffix_dedup.repeated_spans(docs, 40, 16, 0).count() > 0
    assert "halves" in [label for label, _ in written]
    assert [label for label, columns in written if "context" in columns] == ["cut"]


def test_ids_of_a_slice_come_as_one_array():
    """Texts of all kinds, cut together: plain ones, others, special tokens, blanks."""
    library, ids_of = Tokenizer.from_file(WORD), words.ChunkIds(words.Words(WORD))
    texts = ["A b c", "", "İstanbul 東京", " \n ", "x <|endoftext|> y", "É'S don't 12", "한글 á"]
    ids, ends = ids_of.flat(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [part.tolist() for part in np.split(ids, ends[:-1])] == want
    assert ends.tolist() == np.cumsum(list(map(len, want))).tolist()
