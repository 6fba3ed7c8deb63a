"""Near-duplicate join: Jaccard similarity of word n-gram sets, candidates by MinHash banding.

Words are runs of letters and digits, folded to lower case (A to Z and
Latin-1). A text of fewer than ``n`` words has one gram of all its words; a
null text, or one without words, has none and is similar to no other.
Documents with the same words in the same order form one representative.

Representatives meet in the buckets of their bands. A bucket whose members
all meet in one earlier band is left out, as all its pairs are checked there.
Where a bucket is large, its members are dealt into blocks, and each pair of
blocks is one unit of work. A pair is verified on the full n-gram sets, in the
first band that both share, so that it counts once. Pairs are never written
out: a unit returns the number of links of each member and a spanning forest
of its links, from which connected components follow.

A class is named by its least id, null ids last; rows of null id have classes
and links like others, and repeated rows one result each. An empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from callmeter.llm.text import Hasher, find_words, mix, n_grams, release_memory, seeds, slices
from callmeter.operators.durable import cut_lineage

# Members of a bucket in one block.
BLOCK = 512
# Distinct grams multiplied at a time.
_COLUMNS = 4096


@dataclass(frozen=True)
class Banding:
    rows: int
    bands: int

    def recall(self, similarity: float) -> float:
        """The chance that a pair of this similarity meets in at least one band."""
        return 1 - (1 - similarity**self.rows) ** self.bands


def choose_banding(similarity: float, recall: float, hashes: int = 64) -> Banding:
    """The most selective banding that reaches ``recall`` at ``similarity`` with at most ``hashes`` hashes."""
    best = Banding(1, max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(similarity, 1 - 1e-9)))))
    for rows in range(2, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - min(similarity, 1 - 1e-9) ** rows))
        if rows * bands > hashes:
            break
        best = Banding(rows, max(1, bands))
    return best


def _sign(docs: DataFrame, n: int, banding: Banding) -> DataFrame:
    """Per row: doc_id, the hash of its text, a fingerprint of its words, and its band hashes (null without words)."""
    hashes = banding.rows * banding.bands
    a, b = (seeds(hashes, salt=s).astype(np.uint32) | np.uint32(1) for s in (11, 13))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for s in slices(batches, "__text"):
            find_words(s, hasher)
            grams, first = n_grams(s, n)
            filled = np.flatnonzero(np.diff(first))
            rows = s.rows.num_rows
            bands = np.zeros((rows, banding.bands), dtype=np.uint64)
            fingerprint = s.rows.column("__empty").to_numpy().copy()
            if len(filled):
                at = first[filled]
                short = (grams >> np.uint64(32)).astype(np.uint32)
                factor = seeds(banding.rows, salt=17)
                for k in range(banding.bands):
                    mixed = np.full(len(filled), k + 1, dtype=np.uint64)
                    for r in range(banding.rows):
                        h = k * banding.rows + r
                        least = np.minimum.reduceat(short * a[h] + b[h], at)
                        mixed = mix(mixed + least.astype(np.uint64) * factor[r])
                    bands[filled, k] = mixed
                place = np.arange(len(s.hashes)) - np.repeat(s.first[:-1], np.diff(s.first))
                words = mix(s.hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                has = np.flatnonzero(np.diff(s.first))
                fingerprint[has] = mix(np.add.reduceat(words, s.first[has])).view(np.int64)
            flat = pa.array(bands.view(np.int64).reshape(-1))
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, rows + 1, dtype=np.int32) * banding.bands), flat, mask=pa.array(np.diff(first) == 0)
            )
            yield pa.RecordBatch.from_arrays(
                [s.rows.column(0), s.rows.column("__hash"), pa.array(fingerprint), lists],
                names=["doc_id", "text_hash", "fp", "bands"],
            )

    own = F.xxhash64("text").alias("__hash")
    empty = F.xxhash64("doc_id", "text", F.lit("no words")).alias("__empty")
    rows = docs.select("doc_id", F.col("text").alias("__text"), own, empty)
    schema = StructType(
        [
            rows.schema.fields[0],
            StructField("text_hash", LongType()),
            StructField("fp", LongType()),
            StructField("bands", ArrayType(LongType())),
        ]
    )
    return rows.mapInArrow(run, schema)


def _representatives(signed: DataFrame) -> DataFrame:
    """One row per distinct sequence of words: its fingerprint, least document, copies and bands."""
    return signed.groupBy("fp").agg(
        # A null id comes last, so that a class has the least id of its rows.
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least"),
        F.count(F.lit(1)).alias("copies"),
        F.max("bands").alias("bands"),
    )


def _units(reps: DataFrame, bands: int, block: int) -> DataFrame:
    """The members of each unit of work: unit (bucket, low and high block), fp, copies, bands and own block."""
    entries = reps.filter(F.col("bands").isNotNull()).select("fp", F.posexplode("bands").alias("band", "bucket"))
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = entries.join(shared, "bucket").join(reps.select("fp", "copies", "bands"), "fp")
    ends = [f(F.col("bands")[k]).alias(f"{f.__name__}{k}") for k in range(bands) for f in (F.min, F.max)]
    buckets = members.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("size"), *ends)
    settled = F.lit(False)
    for k in range(bands):
        settled |= (F.col("band") > k) & (F.col(f"min{k}") == F.col(f"max{k}"))
    buckets = buckets.filter(~settled).select("bucket", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    members = members.drop("n").join(buckets, "bucket")
    own = F.pmod(F.xxhash64("fp", F.lit("block")), F.col("blocks")).cast("int")
    members = members.withColumn("own", own)
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return members.select(
        "fp", "copies", "bands", "band", "own", "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
    )


def _gram_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """The sorted distinct grams, as bytes, of the document of each representative in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for s in slices(batches, "__text"):
            find_words(s, hasher)
            grams, first = n_grams(s, n)
            sets = [np.unique(grams[first[i] : first[i + 1]]).tobytes() for i in range(s.rows.num_rows)]
            yield pa.RecordBatch.from_arrays([s.rows.column("fp"), pa.array(sets, pa.binary())], names=["fp", "grams"])

    keys = wanted.select("fp", F.col("least.doc_id").alias("__id"), F.col("least.text_hash").alias("__hash"))
    rows = docs.select(F.col("doc_id").alias("__own"), F.col("text").alias("__text"))
    same = rows["__own"].eqNullSafe(keys["__id"]) & (F.xxhash64(rows["__text"]) == keys["__hash"])
    found = rows.join(keys.hint("shuffle_hash"), same)
    return found.select("fp", "__text").mapInArrow(run, "fp long, grams binary").dropDuplicates(["fp"])


def links_within(sets: list[np.ndarray], bands: np.ndarray, band: int, own: np.ndarray, low: int, high: int, least: float) -> np.ndarray:
    """Which members are linked: pairs of the blocks ``low`` and ``high`` that first meet in ``band``."""
    m = len(sets)
    sizes = np.array([len(x) for x in sets])
    grams, codes, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(m), sizes)
    # A gram of one member only is in no intersection.
    shared = counts[codes] > 1
    number = np.cumsum(counts > 1) - 1
    codes, member = number[codes[shared]], member[shared]
    order = np.argsort(codes, kind="stable")
    codes, member = codes[order], member[order]
    common = np.zeros((m, m), dtype=np.float32)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, _COLUMNS):
        a, b = np.searchsorted(codes, [start, start + _COLUMNS])
        if b > a:
            matrix = np.zeros((m, _COLUMNS), dtype=np.float32)
            matrix[member[a:b], codes[a:b] - start] = 1
            common += matrix @ matrix.T
    linked = common >= least * (sizes[:, None] + sizes[None, :] - common) - 1e-4
    np.fill_diagonal(linked, False)
    if low != high:
        linked &= own[:, None] != own[None, :]
    for k in range(band):
        linked &= bands[:, None, k] != bands[None, :, k]
    return linked


def forest(linked: np.ndarray) -> np.ndarray:
    """For each member the least member of its component."""
    root = np.arange(len(linked))
    while True:
        reach = np.where(linked, root[None, :], len(linked)).min(axis=1, initial=len(linked))
        new = np.minimum(root, reach)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _verify(units: DataFrame, least: float) -> DataFrame:
    """Rows (fp, other, links): links of a member with others of its unit, and an edge of the unit's forest, null at roots."""

    def unit(rows: dict[str, list]) -> tuple[list, list, list]:
        sets = [np.frombuffer(x, dtype=np.uint64) for x in rows["grams"]]
        bands = np.array(rows["bands"], dtype=np.int64)
        linked = links_within(sets, bands, rows["band"][0], np.array(rows["own"]), rows["low"][0], rows["high"][0], least)
        links = linked @ np.array(rows["copies"], dtype=np.int64)
        root = forest(linked)
        some = np.flatnonzero(links)
        fps = rows["fp"]
        return (
            [fps[i] for i in some],
            [None if root[i] == i else fps[root[i]] for i in some],
            [int(links[i]) for i in some],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            release_memory()
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("bucket", "low", "high")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            # The last unit may go on in the next batch.
            last = int(cuts[-1]) if len(cuts) else 0
            yield from _units_of(table.slice(0, last), cuts)
            held = table.slice(last)
        if held is not None and held.num_rows:
            yield from _units_of(held, np.array([held.num_rows]))

    def _units_of(table: pa.Table, cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        start = 0
        for end in cuts:
            if end - start > 1:
                for into, found in zip(out, unit(table.slice(start, end - start).to_pydict()), strict=True):
                    into.extend(found)
            start = end
        if out[0]:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in out], names=["fp", "other", "links"]
            )

    dealt = units.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "fp")
    return dealt.mapInArrow(run, "fp long, other long, links long")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components by alternating large and small stars: (node, root), where root is the least node.

    Nodes without an edge are not among the rows. Each round writes the edges
    to the checkpoint folder. Kiveris et al., "Connected Components in
    MapReduce and Beyond" (SoCC 2014).
    """

    def star(pairs: DataFrame, larger: bool) -> DataFrame:
        low = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = pairs.join(low, "u")
        if larger:
            return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v")

    def both(pairs: DataFrame) -> DataFrame:
        return pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(pairs: DataFrame):
        return pairs.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(u, v))")).first()

    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v").distinct()
    edges = cut_lineage(edges)
    before = state(edges)
    while True:
        large = star(both(edges), larger=True).distinct()
        edges = cut_lineage(star(large.filter("u > v"), larger=False).distinct())
        after = state(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = after


def similar_documents(
    docs: DataFrame, n: int = 5, least: float = 0.8, recall: float = 0.998, block: int = BLOCK
) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, class_key, class_id and n_links.

    Rows share a ``class_key`` if a chain of links joins them; ``class_id`` is
    the least id of the class (null if it has none). ``n_links`` counts the
    other rows whose n-gram sets have a Jaccard similarity of at least
    ``least``, copies included, among pairs that meet in a band; ``recall`` is
    the chance of that at a similarity of just ``least``. Rows without words
    are classes of their own; wholly repeated ones share theirs.
    """
    banding = choose_banding(least, recall)
    signed = cut_lineage(_sign(docs, n, banding))
    reps = cut_lineage(_representatives(signed))
    units = cut_lineage(_units(reps, banding.bands, block))
    wanted = reps.join(units.select("fp").distinct(), "fp", "left_semi")
    verified = cut_lineage(_verify(units.join(_gram_sets(docs, wanted, n), "fp"), least))
    links = verified.groupBy("fp").agg(F.sum("links").alias("links"))
    roots = components(verified.filter("other IS NOT NULL"), "fp", "other")
    placed = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").join(links, "fp", "left")
    alone = F.col("bands").isNull()
    placed = placed.select(
        "fp",
        F.coalesce("root", "fp").alias("class_key"),
        F.col("least.doc_id").alias("least_id"),
        F.when(alone, 0).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    )
    names = placed.groupBy("class_key").agg(F.min("least_id").alias("class_id"))
    placed = placed.join(names, "class_key").select("fp", "class_key", "class_id", "n_links")
    return signed.select("doc_id", "text_hash", "fp").join(placed, "fp").drop("fp")


def keep_one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """Of each class of similar documents the row of least id (null last), all columns; repeated rows once."""
    classes = similar_documents(docs, **settings)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = classes.groupBy("class_key").agg(F.min(order).alias("kept"))
    # A struct of a null id equals another. Both steps deal rows by the same keys, so that the text is shuffled once.
    kept = kept.select(F.struct("kept.doc_id").alias("__id"), F.col("kept.text_hash").alias("__own")).distinct()
    rows = docs.withColumns({"__own": F.xxhash64("text"), "__id": F.struct("doc_id")})
    found = rows.dropDuplicates(["__own", "__id"]).join(kept, ["__own", "__id"], "left_semi")
    return found.select(*docs.columns)
