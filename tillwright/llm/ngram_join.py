"""Similarity join of texts on word n-grams: MinHash bands, then exact Jaccard.

Texts with the same n-gram set are one class, represented by one text. Classes
that agree on all rows of a band share a bucket. Buckets with the same members
are one set of candidates, whatever the bands that gave it. A set is cut into
tiles of bounded size; for each pair of tiles one task counts common n-grams of
all its pairs at once and emits a row for each member, never a row for each pair.
A pair that meets in several sets is counted in the one of its first common band.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.exact_dedup import keep_rows, row_key
from tillwright.llm.shared import id_and_text, release_memory, staged

WORDS = 5
SIMILARITY = 0.8
#: Pairs at the similarity that bands find at least, and hashes for it at most.
RECALL, HASHES = 0.9999, 128
#: Classes, and n-grams of all its classes, in a tile on average.
TILE_CLASSES, TILE_GRAMS = 768, 1 << 18

_WORD = re.compile(r"\w+")
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def bands_for(similarity: float, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band with which that many pairs are found."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - similarity**rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Grams:
    """The n-gram sets of texts, as sorted distinct 64-bit hashes."""

    def __init__(self, size: int):
        self._size = size
        self._words: dict[str, int] = {}
        self._steps = np.resize(_STEPS, size) + np.arange(size, dtype=np.uint64) * np.uint64(2)

    def __call__(self, text: str) -> np.ndarray:
        """Fewer words than a gram has are one gram; without a word the text is."""
        words = _WORD.findall(text.lower()) or [text]
        known = self._words
        if len(known) > 150_000:
            known.clear()
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self._size, len(words))
        total = np.full(len(words) - size + 1, size, np.uint64)
        for i in range(size):
            total = total + _mixed(hashes[i : len(words) - size + 1 + i]) * self._steps[i]
        return np.unique(_mixed(total))


def _signatures(size: int, bands: int, rows: int):
    rnd = np.random.default_rng(2024)
    factors = rnd.integers(0, 1 << 63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rnd.integers(0, 1 << 63, bands * rows, np.uint64)

    def lowest(grams: np.ndarray) -> np.ndarray:
        low = np.full(len(factors), ~np.uint64(0))
        for start in range(0, len(grams), 2048):
            some = grams[start : start + 2048]
            low = np.minimum(low, (factors[:, None] * some[None, :] + shifts[:, None]).min(1))
        return low

    def run(batches):
        grams_of = Grams(size)
        powers = _mixed(np.arange(1, rows + 1, dtype=np.uint64))
        for batch in batches:
            classes, counts, values = [], [], []
            for text in batch.column("text").to_pylist():
                grams = grams_of(text)
                classes.append(hashlib.blake2b(grams.tobytes(), digest_size=16).hexdigest())
                counts.append(len(grams))
                low = _mixed(lowest(grams)).reshape(bands, rows)
                values.append(_mixed((low * powers).sum(1, dtype=np.uint64)).view(np.int64))
            flat = np.concatenate(values) if values else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(name) for name in ("doc_id", "row", "row2")),
                    pa.array(classes, pa.string()),
                    pa.array(counts, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, bands, dtype=np.int32)), pa.array(flat)),
                ],
                names=["doc_id", "row", "row2", "class", "n_grams", "bands"],
            )
        release_memory()

    return run


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all pairwise intersections.

    Only grams of two members or more matter. Of a gram that most members hold, the
    few that lack it are counted instead: near copies of one text share almost all.
    """
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, gram = np.unique(np.concatenate(sets), return_inverse=True)
    held = np.bincount(gram)
    out = np.zeros((m, m), np.float32)
    for mostly in (False, True):
        chosen = np.flatnonzero((held >= 2) & ((held > m / 2) == mostly))
        place = np.full(len(held), -1)
        place[chosen] = np.arange(len(chosen))
        for start in range(0, len(chosen), 4096):
            columns = place[gram]
            inside = (columns >= start) & (columns < start + 4096)
            width = min(4096, len(chosen) - start)
            block = np.zeros((m, width), np.float32)
            block[owner[inside], columns[inside] - start] = 1
            if mostly:
                full = float(width)
                lacking = 1 - block
                few = np.flatnonzero(lacking.any(0))
                lacks = lacking.sum(1)
                out += full - lacks[:, None] - lacks[None, :] + lacking[:, few] @ lacking[:, few].T
            else:
                out += block @ block.T
    return out


def _roots(linked: np.ndarray) -> np.ndarray:
    """The smallest index that each member reaches over links."""
    label = np.arange(len(linked))
    reach = linked | np.eye(len(linked), dtype=bool)
    while True:
        lower = np.where(reach, label[None, :], len(linked)).min(1)
        lower = lower[lower]
        if (lower == label).all():
            return label
        label = lower


def _verify(size: int, similarity: float):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("class")
        classes = table.column("class").to_pylist()
        i, j, first = (table.column(c)[0].as_py() for c in ("tile_i", "tile_j", "first_band"))
        tile = table.column("tile").to_numpy()
        weight = table.column("size").to_numpy()
        bands = np.stack(table.column("bands").to_numpy())
        grams_of = Grams(size)
        sets = [grams_of(t) for t in table.column("text").to_pylist()]
        n = np.array([len(s) for s in sets], np.float32)
        common = common_counts(sets)
        linked = common * (1 + similarity) >= similarity * (n[:, None] + n[None, :]) - 1e-3
        np.fill_diagonal(linked, False)
        if i != j:  # pairs within a tile have a task of their own
            linked &= tile[:, None] != tile[None, :]
        roots = _roots(linked)
        for band in range(first):
            linked &= bands[:, band][:, None] != bands[:, band][None, :]
        links = linked @ weight
        del common
        release_memory()
        return pa.table(
            {
                "class": pa.array(classes, pa.string()),
                "root": pa.array([classes[r] for r in roots], pa.string()),
                "links": pa.array(links.astype(np.int64)),
            }
        )

    return run


def components(edges: DataFrame) -> DataFrame:
    """(class, component) of the classes in edges (class, root).

    Each round every class takes the smallest component among its neighbours', and
    then that component's own. Rounds are written tables; one that changes nothing
    is the last.
    """
    both = edges.select(F.col("class").alias("a"), F.col("root").alias("b")).filter("a <> b")
    both = staged(both.union(both.select("b", "a")).distinct(), "edges")
    label = both.groupBy("a").agg(F.min("b").alias("l")).select("a", F.least("a", "l").alias("l"))
    label = staged(label, "labels")
    while True:
        near = both.join(label.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("l").alias("n"))
        best = label.join(near, "a").select("a", "l", F.least("l", "n").alias("n"))
        jump = label.select(F.col("a").alias("n"), F.col("l").alias("j"))
        step = staged(best.join(jump, "n", "left").select("a", "l", F.least("n", F.coalesce("j", "n")).alias("n")), "labels")
        if step.filter("l <> n").limit(1).count() == 0:
            return label.select(F.col("a").alias("class"), F.col("l").alias("component"))
        label = step.select("a", F.col("n").alias("l"))


def similar(docs: DataFrame, size: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, n_links, n_grams: one row per row of ``docs`` (doc_id, text).

    Two texts are linked if their sets of ``size`` consecutive words (runs of word
    characters, in lower case) have a Jaccard similarity of ``similarity`` or more.
    ``n_links`` is the number of other rows linked to the row, ``class_id`` the
    smallest doc_id that links lead to, null ids aside. A text of fewer words is one
    gram; texts without a word are linked if they are equal, so null and empty texts
    are linked to each other. Repeated rows are linked like other copies. An empty
    table gives no rows; other columns aren't read.
    """
    return _joined(docs, size, similarity).drop("row", "row2", "stays")


def _joined(docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """``similar`` with each row's key, and whether it is the first row of its class."""
    bands, rows = bands_for(similarity)
    texts = id_and_text(docs)
    texts = texts.withColumns({"row": row_key(texts), "row2": row_key(texts, F.lit(1))})
    signed = staged(
        texts.mapInArrow(
            _signatures(size, bands, rows), "doc_id long, row long, row2 long, class string, n_grams int, bands array<long>"
        ),
        "signatures",
    )
    classes = staged(
        signed.groupBy("class").agg(
            F.count(F.lit(1)).alias("size"),
            F.min("row").alias("row"),
            F.min("n_grams").alias("n_grams"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    placed = classes.select("class", "n_grams", F.posexplode("bands").alias("band", "value"))
    buckets = (
        placed.groupBy("band", "value")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("n_grams").cast("long")).alias("grams"),
            F.bit_xor(F.xxhash64("class")).alias("x"),
            F.bit_xor(F.xxhash64("class", F.lit(1))).alias("y"),
        )
        .filter("n > 1")
    )
    sets = buckets.groupBy("n", "grams", "x", "y").agg(F.min(F.struct("band", "value")).alias("at"))
    tiles = F.greatest(F.ceil(F.col("n") / TILE_CLASSES), F.ceil(F.col("grams") / TILE_GRAMS)).cast("int")
    sets = sets.select("at.band", "at.value", F.xxhash64("x", "y", "n").alias("set"), tiles.alias("tiles"))
    members = staged(
        placed.join(sets, ["band", "value"]).select("set", F.col("band").alias("first_band"), "tiles", "class"), "members"
    )
    wanted = members.select("class").distinct().join(classes.select("class", "row", "size", "bands"), "class")
    # Rows that repeat an id and text share a hash; one of them gives the text.
    told = texts.select("row", "text").join(wanted, "row").dropDuplicates(["class"])
    tile = F.pmod(F.xxhash64("class", F.lit(2)), F.col("tiles")).cast("int")
    dealt = (
        members.withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select(
            "set", "first_band", "tile", "class",
            F.least("tile", "other").alias("tile_i"), F.greatest("tile", "other").alias("tile_j"),
        )
    )
    checked = staged(
        dealt.join(told.select("class", "size", "bands", "text"), "class")
        .groupBy("set", "first_band", "tile_i", "tile_j")
        .applyInArrow(_verify(size, similarity), "class string, root string, links long"),
        "checked",
    )
    linked = checked.groupBy("class").agg(F.sum("links").alias("links"))
    parts = components(checked.select("class", "root"))
    named = (
        classes.select("class", "size")
        .join(linked, "class", "left")
        .join(parts, "class", "left")
        .select(
            "class",
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "class").alias("component"),
        )
    )
    named = staged(named, "named")
    rows_of = signed.select("doc_id", "row", "row2", "class", "n_grams").join(named, "class")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("row"), F.col("row2"))).alias("first")
    firsts = rows_of.groupBy("component").agg(F.min("doc_id").alias("class_id"), first)
    return rows_of.join(firsts, "component").select(
        "doc_id", "class_id", "n_links", "n_grams", "row", "row2",
        ((F.col("row") == F.col("first.row")) & (F.col("row2") == F.col("first.row2"))).alias("stays"),
    )


def one_of_each(docs: DataFrame, size: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, with their columns, that no row of a smaller doc_id is
    joined to by links; one for each class. Null ids come last; of rows alike
    in id the one with the smallest key stays."""
    return keep_rows(docs, _joined(docs, size, similarity).select("row", "row2", "stays"))
