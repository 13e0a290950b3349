"""Near-duplicate documents: circulant MinHash, banding and exact Jaccard verification.

Signatures.  One permutation (the shingle hash itself, cut to a position on a circle) and a second one (a fixed random permutation of the
circle) generate all coordinates: coordinate k is the least value of the second permutation, shifted by k.  Shifts of one position lie side
by side, so a shingle contributes one slice of the permutation.

Candidates.  50 bands of 5 rows: two documents with a Jaccard similarity of 0.75 share no band with probability (1 - 0.75**5)**50 = 1.3e-6.
Equal sets are one class from the start, and only classes are compared.  Comparison goes in waves, with new components between them.  In the
first wave each class meets the leader of each of its buckets.  After that only buckets whose members lie in several components are open, and
there only the members outside the bucket's largest component look for links: with about 16 drawn members of other components, then 32 times as
many, and so on, until no open bucket has more members.  Most members of a dense group are linked after a few looks, so what the last wave meets in full are the few
members that are linked with hardly anyone.  No pair is made inside a component and none twice.  The join itself leaves out pairs whose
sketches (four bits of each coordinate) differ too much for a similarity of 0.75, which adds about the error of the bands, and pairs whose
parity maps differ too much, which adds no error: sets differ in at least as many shingles as their maps in bits.  So hardly more pairs than
links are made.  Nothing is capped.

Components.  Labels are the least ids of neighbours, halved by pointer jumping, in tables that are written each round.

Defined results: a null or empty text has no shingles and is linked with nothing; fewer than five words are one shingle; rows that repeat a
doc_id are one document, which has the links of all its texts; a null doc_id is linked with nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom.llm import kernel
from turnloom.llm.storage import discard, materialize, release

WORDS = 5
ROWS = 5
BANDS = 50
CIRCLE = 1 << 20
#: members of a bucket that are met in the second wave, and how many times as many in each further one
LOOKS = 16
TIMES = 32
#: bits of a parity map: each shingle flips one
MAP = 4096
#: parts of a class that meet its row apart, so that thousands of exact copies do not meet in one task
SALTS = 16
SKETCH = 16
#: more ids than these are not marked in a bitmap that is broadcast
MOST_MARKED = 1 << 24
#: sketches of sets with a similarity of 0.75 differ in 58.6 of 250 coordinates on average (deviation 6.7); in more than 90 with probability 2e-6
MOST_UNLIKE = 90

_SECOND: list[np.ndarray] = []


def _slices(width: int) -> np.ndarray:
    """Return the view whose row p holds the second permutation at p, p+1, .. p+width-1 on the circle."""
    if not _SECOND:
        table = np.random.Generator(np.random.PCG64(11)).permutation(CIRCLE).astype(np.uint32)
        _SECOND.append(np.concatenate([table, table[:4096]]))
    return np.lib.stride_tricks.sliding_window_view(_SECOND[0], width)


def signatures(grams: np.ndarray, at: np.ndarray, width: int = ROWS * BANDS) -> np.ndarray:
    """Return the signature (rows x width) of each row's shingle hashes."""
    place = (grams >> np.uint64(44)).astype(np.int64)
    view = _slices(width)
    out = np.full((len(at) - 1, width), 2**32 - 1, dtype=np.uint32)
    for r, (i, j) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        for k in range(i, j, 1024):
            np.minimum(out[r], view[place[k : min(k + 1024, j)]].min(axis=0), out=out[r])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Return a 64-bit key for each band of each row; keys of different bands differ."""
    parts = signature.reshape(len(signature), BANDS, ROWS).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    key = np.repeat(key, len(signature), axis=0)
    for i in range(ROWS):
        key = kernel.mix(key * np.uint64(0xD1342543DE82EF95) + parts[:, :, i] + np.uint64(i + 1))
    return key.view(np.int64)


def sketches(signature: np.ndarray) -> np.ndarray:
    """Return four low bits of each coordinate, 16 coordinates a 64-bit number (rows x SKETCH)."""
    low = np.zeros((len(signature), SKETCH * 16), dtype=np.uint64)
    low[:, : signature.shape[1]] = signature & np.uint32(15)
    shift = np.arange(16, dtype=np.uint64) * np.uint64(4)
    return np.bitwise_or.reduce(low.reshape(len(low), SKETCH, 16) << shift, axis=2).view(np.int64)


def unlike(a: Column, b: Column) -> Column:
    """In how many coordinates two sketches differ."""

    def each(i: int) -> Column:
        x = a[i].bitwiseXOR(b[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(F.lit(0x1111111111111111)))

    return reduce(lambda x, y: x + y, [each(i) for i in range(SKETCH)])


def parity_maps(grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Return, for each row's set, which of MAP places an odd number of its shingles fall on (rows x MAP / 64)."""
    n = len(at) - 1
    place = np.repeat(np.arange(n), np.diff(at)) * MAP + (grams & np.uint64(MAP - 1)).astype(np.int64)
    odd = np.bincount(place, minlength=n * MAP).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, MAP), axis=1).view(np.int64)


def differing(a: Column, b: Column) -> Column:
    """In how many places two parity maps differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _lists(rows: np.ndarray) -> pa.Array:
    n, k = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * k + 1, k), pa.int32()), pa.array(rows.reshape(-1)))


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = kernel.text_buffers(column)
    for i, j in kernel.blocks(offsets, 4 << 20):
        words, first = kernel.word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower=True)
        yield i, j, *kernel.distinct(*kernel.shingles(words, first, WORDS))


def _set_sums(grams: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Return two 64-bit hashes of each row's set."""
    empty = np.diff(at) == 0
    sums = [np.add.reduceat(np.append(kernel.mix(grams ^ np.uint64(s)), np.uint64(0)), at[:-1]) for s in (1, 2)]
    return [np.where(empty, 0, s).astype(np.uint64).view(np.int64) for s in sums]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, grams, at in _sets(batch.column(1)):
            signed = signatures(grams, at)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), pa.array(np.diff(at), pa.int64()), *map(pa.array, _set_sums(grams, at)), _lists(band_keys(signed)), _lists(sketches(signed))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
            )


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns in: id, text, and the set's hashes; a text with another set than its class (of a repeated doc_id) is passed over."""
    for batch in batches:
        for i, j, grams, at in _sets(batch.column(1)):
            same = np.logical_and.reduce([s == batch.column(k).slice(i, j - i).to_numpy() for k, s in zip((2, 3), _set_sums(grams, at), strict=True)])
            sets = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(grams.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), sets], names=["id", "grams"]).filter(pa.array(same))


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            sets = batch.column(1).slice(i, 256)
            maps = parity_maps(sets.flatten().to_numpy().view(np.uint64), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())]))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 256), _lists(maps)], names=["id", "map"])


def among(rows: DataFrame, key: str, ids: DataFrame, n: int) -> DataFrame:
    """Leave out most rows whose ``key`` is none of the ``n`` numbers of ``ids``, without moving rows; a join drops the rest.

    The numbers are marked in a bitmap of eight bits a number, which is broadcast as one row for each 64 bits that hold any.
    """
    if n > MOST_MARKED:
        return rows
    place = lambda x: F.pmod(F.xxhash64(x), F.lit(8 * max(n, 8)))
    marks = ids.select(place(F.col(ids.columns[0])).alias("_place")).groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(F.expr("shiftleft(1L, int(_place & 63))")).alias("_marks"))
    placed = rows.withColumn("_place", place(F.col(key))).withColumn("_word", F.shiftright("_place", 6))
    return placed.join(F.broadcast(marks), "_word").where("shiftrightunsigned(_marks, int(_place & 63)) & 1 = 1").select(rows.columns)


def gram_sets(docs: DataFrame, classes: DataFrame, repeats: bool = True) -> DataFrame:
    """Write and return (id, grams): the full shingle sets of ``classes`` (id, least, set_a, set_b); ``repeats``: whether a doc_id may occur in several rows."""
    own = materialize(classes, "near-chosen")
    chosen = among(docs, "doc_id", own.select("least"), own.count()).join(own, F.col("doc_id") == F.col("least")).select("id", "text", "set_a", "set_b")
    sets = chosen.mapInArrow(kernel.tidy(_grams), "id bigint, grams array<bigint>")
    made = materialize(sets.dropDuplicates(["id"]) if repeats else sets, "near-sets")
    discard(own)
    return made


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Keep the pairs (a, b) whose full sets have ``100 * intersection >= percent * union``."""
    # where the pairs are few, their sets alone are moved
    sets = sets.join(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id", "left_semi")
    left, right = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga")), sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = F.size(F.array_intersect("ga", "gb"))
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= (F.size("ga") + F.size("gb") - both) * percent).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """Return (id, component) of every vertex of ``edges`` (a, b); the component is its least id.

    Each round a vertex takes the least label of its neighbours and itself, and then the label of that label.
    """
    ends = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")), F.struct("a", F.col("a").alias("b")), F.struct(F.col("b").alias("a"), "b"))).alias("e"))
    links = materialize(ends.select("e.a", "e.b").distinct(), "near-links")  # both ways, and each vertex with itself
    labels = materialize(links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id"), "near-labels")
    while True:
        seen = links.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.max(F.when(F.col("a") == F.col("b"), F.col("component"))).alias("old"), F.min("component").alias("low"))
        over = labels.select(F.col("id").alias("low"), F.col("component").alias("over"))
        step = materialize(seen.join(over, "low").select(F.col("a").alias("id"), "old", F.least("low", "over").alias("component")), "near-labels")
        discard(labels)
        labels = step
        if step.where("old <> component").isEmpty():
            discard(links)
            return labels


def joined_up(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Return the labels (id, component) after the classes of ``edges`` (a, b) are linked; only components are walked again."""
    a, b = labels.select(F.col("id").alias("a"), F.col("component").alias("ca")), labels.select(F.col("id").alias("b"), F.col("component").alias("cb"))
    between = materialize(edges.join(a, "a").join(b, "b").where("ca <> cb").select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "near-between")
    if between.isEmpty():
        discard(between)
        return labels
    walked = components(between)
    moved = walked.select(F.col("id").alias("component"), F.col("component").alias("now"))
    out = materialize(labels.join(moved, "component", "left").select("id", F.coalesce("now", "component").alias("component")), "near-labels")
    discard(between, walked, labels)
    return out


def _pairs(id_: str, other: str) -> list[Column]:
    return [F.least(id_, other).alias("a"), F.greatest(id_, other).alias("b")]


def linked_classes(firsts: DataFrame, docs: DataFrame, classes: DataFrame, percent: int, repeats: bool = True) -> DataFrame:
    """Return the labels (id, component) of the classes that share a bucket.

    firsts: (id, n, bands, sketch) of every class; ``repeats``: whether a doc_id may occur in several rows.
    """
    leads = firsts.select("id", "n", F.posexplode("bands").alias("band_no", "band"))
    counts = leads.groupBy("band").agg(F.count("*").alias("size"), F.min("id").alias("leader")).where("size > 1")
    members = materialize(leads.join(counts, "band").select("band", "band_no", "id", "n", "leader"), "near-members")
    labels = materialize(members.select("id").distinct().withColumn("component", F.col("id")), "near-labels")
    sets = gram_sets(docs, classes.join(labels, "id", "left_semi").select("id", "least", "set_a", "set_b"), repeats)
    fits = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    marks = F.transform("bands", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("marks")
    leaders = members.where("id = leader").select("band", F.col("n").alias("m"))
    tested = materialize(members.where("id <> leader").join(leaders, "band").where(fits).select(*_pairs("id", "leader")).distinct(), "near-pairs")
    labels = joined_up(labels, verified(tested, sets, percent))
    now, most, wave, made, looks = members, LOOKS, 0, [tested], None
    while True:
        release(docs.sparkSession)
        placed = now.join(labels, "id")
        shares = placed.groupBy("band", "component").agg(F.count("*").alias("k"))
        split = shares.groupBy("band").agg(F.count("*").alias("parts"), F.sum("k").alias("size"), F.max_by("component", F.struct("k", -F.col("component"))).alias("major")).where("parts > 1").drop("parts")
        opened = materialize(placed.join(split, "band"), "near-open")
        largest = opened.agg(F.max("size")).first()[0]
        if wave:
            discard(now)
        if largest is None:
            discard(opened)
            break
        if looks is None:
            ids = materialize(opened.select("id").distinct(), "near-ids")
            maps = sets.join(ids, "id", "left_semi").mapInArrow(kernel.tidy(_maps), "id bigint, map array<bigint>")
            looks = materialize(among(firsts, "id", ids, ids.count()).select("id", "sketch", marks).join(maps, "id"), "near-looks")
            discard(ids)
        # what is long is fetched for the members that look or are looked at, and not carried from wave to wave
        seen = materialize(opened.join(looks, "id"), "near-seen")
        minor = seen.where("component <> major")
        # a member is drawn alike in all its buckets of one size, so a pair meets there or nowhere in this wave
        draw = F.lit(True) if most >= largest else F.pmod(F.xxhash64("id", F.lit(wave)), F.lit(1 << 20)) * F.col("size") < F.lit(most << 20)
        met = seen.where(draw).select("band", F.col("id").alias("other"), F.col("n").alias("m"), F.col("component").alias("other_component"), F.col("sketch").alias("other_sketch"), F.col("marks").alias("other_marks"), F.col("map").alias("other_map"))
        alike = unlike(F.col("sketch"), F.col("other_sketch")) <= MOST_UNLIKE
        may = differing(F.col("map"), F.col("other_map")) * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent)
        # a pair is made in the first band that it shares, and so once
        first = F.array_position(F.zip_with("marks", "other_marks", lambda x, y: x == y), True) == F.col("band_no") + 1
        found = minor.join(met, "band").where("component <> other_component").where(fits & alike & first & may).select(*_pairs("id", "other")).distinct()
        pairs = materialize(found.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        discard(seen)
        labels = joined_up(labels, verified(pairs, sets, percent))
        if most >= largest:
            discard(pairs, opened)
            break
        made.append(pairs)
        tested, now = tested.unionByName(pairs), opened.select("band", "band_no", "id", "n")
        now._stored_at = opened._stored_at
        most, wave = most * TIMES, wave + 1
    discard(*[looks] if looks else [])
    discard(members, sets, *made)
    return labels


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return doc_id, n_shingles, class_id, component_id and kept of every document.

    class_id is the least doc_id with the same set.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialize(docs.mapInArrow(kernel.tidy(_sign), "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, sketch array<bigint>"), "near-signatures")
    salted = signed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    key = ["set_a", "set_b", "n_shingles"]
    parts = salted.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*key, "salt").agg(F.min("doc_id").alias("least"))
    classes = materialize(parts.groupBy(*key).agg(F.min("least").alias("least"), F.collect_list("salt").alias("salts")).withColumn("id", F.monotonically_increasing_id()), "near-classes")
    spread = classes.select(*key, F.explode("salts").alias("salt"), "id", F.col("least").alias("class_id"))
    owned = materialize(salted.select("doc_id", *key, "salt").join(spread, [*key, "salt"], "left").select("doc_id", "n_shingles", "id", "class_id"), "near-documents")
    own = classes.select(*key, F.col("least").alias("doc_id"), "id")
    firsts = materialize(signed.join(own, [*key, "doc_id"]).dropDuplicates([*key, "doc_id"]).select("id", F.col("n_shingles").alias("n"), "bands", "sketch"), "near-firsts")
    discard(signed)
    repeats = not owned.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty()
    labels = linked_classes(firsts, docs, classes, percent, repeats)
    # a doc_id with several texts links their classes
    several = owned.where("id IS NOT NULL").groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("top")).where("a < top").drop("top")
    shared = materialize(owned.join(several, "doc_id").where("id <> a").select("a", F.col("id").alias("b")).distinct(), "near-shared")
    if not shared.isEmpty():
        everyone = materialize(classes.join(labels, "id", "left").select("id", F.coalesce("component", "id").alias("component")), "near-labels")
        discard(labels)
        labels = joined_up(everyone, shared)
    named = classes.select("id", "least").join(labels, "id").groupBy("component").agg(F.min("least").alias("component_id"))
    of_class = materialize(labels.join(named, "component").select("id", "component_id"), "near-components")
    discard(classes, firsts, labels, shared)
    release(docs.sparkSession)
    final = owned.join(of_class, "id", "left").select("doc_id", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("component_id", "class_id", "doc_id").alias("component_id"))
    return final.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link near-duplicate documents at a Jaccard similarity of 0.75 over five-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 75 * (nx.n + ny.n - c)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
k AS (SELECT x AS doc_id, min(y) AS low FROM r GROUP BY x),
c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY m) AS class_id FROM (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS m FROM s GROUP BY doc_id))
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.class_id, d.doc_id) AS class_id, least(d.doc_id, coalesce(k.low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(k.low, d.doc_id)) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""
