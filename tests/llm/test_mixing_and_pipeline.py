"""The mixture and the pipeline's stages against plain Python."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tillwright.llm import mixing, toxicity
from tillwright.llm.shared import documents

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def sources(spark):
    """Sources of unlike size, one without a token, a null one, repeated rows and null ids."""
    rnd = random.Random(2)
    rows = []
    for name, n in (("a", 500), ("b", 120), ("c", 40), (None, 25), ("d", 3), ("empty", 4)):
        for _ in range(n):
            rows.append((len(rows), "" if name == "empty" else "x" * rnd.randint(1, 200), name, "kept"))
    rows += [rows[0], rows[0], (None, "null id", "b", "kept"), (None, None, "a", "kept"), (None, None, "a", "kept")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, turn string")


def brute_mixture(docs, repetitions=None, entropy=None, budget=None):
    """Copies of each row, as the module says: exponent by a fine search, budgets, whole
    passes, and a part of one in the order of turns, blocks and places."""
    keyed = docs.withColumn("_source", mixing._source()).withColumn("_place", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    keyed = keyed.withColumn("_block", F.pmod(F.xxhash64("_place"), F.lit(mixing.BLOCKS)).cast("int"))
    turns = [mixing._turn(F.lit(p)).alias(f"turn{p}") for p in range(8)]
    rows = keyed.select("doc_id", "text", "_source", "_place", "_block", *turns).collect()
    cost = lambda r: math.ceil(len((r.text or "").encode()) / 4)
    totals = collections.Counter()
    for r in rows:
        totals[r._source] += cost(r)
    positive = {s: n for s, n in totals.items() if n}

    def weights(e):
        power = {s: n**e for s, n in positive.items()}
        return {s: p / sum(power.values()) for s, p in power.items()}

    def fits(e):
        w = weights(e)
        if repetitions is not None:
            passes = [w[s] / positive[s] for s in positive]
            return max(passes) / min(passes) <= repetitions * (1 + 1e-12)
        return -sum(p * math.log(p) for p in w.values()) >= entropy - 1e-12

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        if fits(middle) == (repetitions is not None):
            high = middle
        else:
            low = middle
    e = round(high if repetitions is not None else low, 6)
    w = weights(e)
    size = budget if budget is not None else max(positive[s] / w[s] for s in positive)
    copies = collections.Counter()
    for source, total in totals.items():
        mine = [r for r in rows if r._source == source]
        if not total:
            copies.update({(r.doc_id, r.text): 1 for r in mine})
            continue
        wanted = round(w[source] * size)
        passes = wanted // total
        left = wanted - passes * total
        for key, n in collections.Counter((r.doc_id, r.text) for r in mine).items():
            copies[key] = passes
        # Equal rows go together: a group is in the partial pass as a whole or not at all.
        groups = collections.defaultdict(list)
        for r in mine:
            groups[r[f"turn{passes}"], r._block, r._place].append(r)
        used = 0
        for _, group in sorted(groups.items()):
            used += sum(map(cost, group))
            if used > left:
                break
            copies[group[0].doc_id, group[0].text] = passes + 1
    return e, copies


@pytest.mark.parametrize("options", [{"repetitions": 2.0}, {"repetitions": 3.5}, {"repetitions": None, "entropy": 1.2}, {"repetitions": 1.5, "budget": 30_000}])
def test_copies_equal_brute_force(sources, options):
    e, want = brute_mixture(sources, **{"repetitions": None, **options})
    found = mixing.mixing_plan(sources, **options).collect()
    texts = {r.doc_id: r.text for r in sources.filter("doc_id IS NOT NULL").collect()}
    assert len(found) == sources.count()
    assert mixing.plan(sources, **options).first().exponent == pytest.approx(e, abs=2e-6)
    for r in found:
        if r.doc_id is not None:
            assert r.copies == want[r.doc_id, texts[r.doc_id]], r
    mixture = collections.Counter((r.doc_id, r.text) for r in mixing.mixed(sources, **options).collect())
    times = collections.Counter((r.doc_id, r.text) for r in sources.collect())
    assert mixture == collections.Counter({k: want[k] * n for k, n in times.items() if want[k]})


def test_budgets_are_met_but_for_one_row(sources):
    plan = mixing.mixing_plan(sources, repetitions=1.5, budget=30_000).collect()
    used, weight, longest = collections.Counter(), {}, collections.Counter()
    for r in plan:
        used[r.source] += r.copies * r.n_tokens
        weight[r.source] = r.weight
        longest[r.source] = max(longest[r.source], 3 * r.n_tokens)  # repeated rows go together
    for source, n in used.items():
        assert weight[source] * 30_000 - longest[source] - 1 <= n <= weight[source] * 30_000 + 1


def grams(text):
    words = re.findall(r"\w+", text.lower()) or [text]
    size = min(5, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_groups(rows):
    """Rows joined by links, each group as a list."""
    sets = [grams(t or "") for _, t in rows]
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                label[root(i)] = root(j)
    found = collections.defaultdict(list)
    for i, row in enumerate(rows):
        found[root(i)].append(row)
    return list(found.values())


@pytest.fixture(scope="module")
def mixed_docs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    base = docs.collect()
    long = base[0].text
    odd = [
        (None, None), (None, None), (None, ""), (9001, None), (9002, "  \n"), (9003, "a\\b \\begin{x}"), (9003, "a\\b \\begin{x}"), (9003, "other text"),
        (9004, long), (9005, long + " \n"), (9006, long.replace(" ", "  ")), (9007, long + " and more"), (None, long), (9008, "w " * 30_000),
    ]
    rows = [(i, t, "en", "odd", len(t or "")) for i, t in odd]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


def test_each_stage_equals_plain_python(spark, sf_dir, mixed_docs):
    stages, docs = dict(corpus_pipeline.STAGES), mixed_docs
    pairs = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    clean = toxicity.toxicity(docs, labels).filter("predicted = 0").select("doc_id").collect()
    out = stages["toxicity"](spark, docs, sf_dir)
    assert out.columns == docs.columns
    assert collections.Counter(i for i, _ in pairs(out)) == collections.Counter(r.doc_id for r in clean)

    before, out = pairs(out), stages["exact_dedup"](spark, out, sf_dir)
    groups = collections.defaultdict(list)
    for i, t in before:
        groups[re.sub("[\x20\x09-\x0d]", "", t or "")].append((-len(t or ""), i is None, i or 0, t or ""))
    kept = collections.Counter((None if null else i, t) for _, null, i, t in (min(g) for g in groups.values()))
    assert collections.Counter((i, t or "") for i, t in pairs(out)) == kept

    before, out = pairs(out), stages["ngram_join"](spark, out, sf_dir)
    found = pairs(out)
    assert out.columns == docs.columns and len(found) == len(set(found))
    groups = near_groups(before)
    assert len(found) == len(groups)
    for group in groups:  # the row of the smallest id stays
        ids = [i for i, _ in group if i is not None]
        assert sum(row in group for row in found) == 1
        assert not ids or (min(ids) in {i for i, t in found if (i, t) in group})

    before, out = out, stages["mixing"](spark, out, sf_dir)
    copies = collections.Counter()
    for (i, t), n in brute_mixture(before, repetitions=mixing.REPETITIONS)[1].items():
        copies[i, t] += n
    assert out.columns == docs.columns and collections.Counter(pairs(out)) == copies and min(copies.values()) >= 1

    library, before = Tokenizer.from_file(WORD), pairs(out)
    last = collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in stages["word_bpe"](spark, out, sf_dir).collect())
    ids = {t: library.encode(t or "", add_special_tokens=False).ids for _, t in before}
    want = collections.Counter((i, len(ids[t]), np.array(ids[t], "<u4").tobytes(), library.decode(ids[t], skip_special_tokens=False)) for i, t in before)
    assert last == want


def test_stages_of_an_empty_table(spark, sf_dir, mixed_docs):
    docs = mixed_docs.filter("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0 and (name == "word_bpe" or out.columns == docs.columns)
