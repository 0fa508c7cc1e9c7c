"""Near-duplicate documents by min-max hashing.

One hash evaluation per permutation gives two signature values, the smallest and the largest.
Bands of them name candidates; links are confirmed on full shingle sets, and documents joined
by links form a group that its smallest id stands for.

* Texts with equal shingle sets become one class first, by a grouped minimum, so thousands
  of exact copies cost no pairs.
* Buckets of a band only make candidate clusters: each member is tied to the smallest one.
* A cluster is confirmed in blocks of about ``BLOCK`` shingles.  The member that shares most buckets
  is compared with all others; only what it does not link to is compared with the rest, block by
  block.  Links inside a block are reduced to those that join something new, so no pairs of a
  group are ever written out, and no block grows with the group.
* With 32 bands of 4 values a pair at similarity 0.8 meets in a bucket with probability 1 - 5e-8.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riffle.llm.common import materialize, mix64, pieces, shingle_hashes, table, text_bytes, word_table
from riffle.llm.graph import components
from riffle.llm.registry import query

PERMUTATIONS = 64
BAND_ROWS = 4
#: Shingles in a block of a cluster (8 bytes each); a longer set has a block with others of its hash.
BLOCK = 1 << 18


def signatures(hashes: np.ndarray, ends: np.ndarray, permutations: int) -> np.ndarray:
    """Min-max signature of every set: for each permutation the smallest and the largest value of its members.

    A permutation is h -> h * a + b modulo 2^64 cut to its upper 32 bits, evaluated once for
    both values.  Rows of empty sets are zero.
    """
    seeds = mix64(np.arange(1, 2 * permutations + 1, dtype=np.uint64))
    full = np.flatnonzero(ends[1:] > ends[:-1])
    out = np.zeros((len(ends) - 1, 2 * permutations), dtype=np.uint32)
    if len(full):
        at = ends[full]
        for p in range(permutations):
            moved = ((hashes * (seeds[2 * p] | np.uint64(1)) + seeds[2 * p + 1]) >> np.uint64(32)).astype(np.uint32)
            out[full, 2 * p] = np.minimum.reduceat(moved, at)
            out[full, 2 * p + 1] = np.maximum.reduceat(moved, at)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for every band of ``rows`` signature values; the band's number is part of the key."""
    bands = signature.shape[1] // rows
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) << np.uint64(40), (len(signature), bands))
    for r in range(rows):
        keys = mix64(keys + signature[:, r::rows][:, :bands].astype(np.uint64))
    return keys


def _sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column(batch.schema.get_field_index("text")))
    row, _, _, words = word_table(data, offsets)
    return shingle_hashes(row, words, batch.num_rows, k)


def sketch(docs: DataFrame, k: int, permutations: int = PERMUTATIONS, band_rows: int = BAND_ROWS) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands) of each text: set size, 128-bit digest of the set, band keys; columns after the text follow."""
    more = docs.schema.fields[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, ends = _sets(batch, k)
            keys = band_keys(signatures(hashes, ends, permutations), band_rows)
            digests = [_digests(hashes, ends, salt) for salt in (1, 2)]
            n = np.diff(ends)
            flat = pa.array(keys[n > 0].ravel().view(np.int64))
            starts = np.concatenate([[0], np.cumsum((n > 0) * keys.shape[1])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n), *map(pa.array, digests), pa.ListArray.from_arrays(pa.array(starts), flat), *batch.columns[2:]],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", *(f.name for f in more)],
            )

    kinds = ["doc_id long, n_shingles long, d1 long, d2 long, bands array<long>", *(f"{f.name} {f.dataType.simpleString()}" for f in more)]
    return docs.mapInArrow(run, ", ".join(kinds))


def _digests(hashes: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix64(hashes ^ np.uint64(salt)), dtype=np.uint64)])
    return mix64(sums[ends[1:]] - sums[ends[:-1]]).view(np.int64)


def _with_sets(docs: DataFrame, k: int) -> DataFrame:
    """The shingle hashes of each text in place of the text, for rows whose set is that of class ``d1``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            hashes, ends = _sets(batch, k)
            blob = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(np.ascontiguousarray(ends * 8)), pa.py_buffer(hashes)])
            columns = [blob.cast(pa.binary()) if i == at else batch.column(i) for i in range(batch.num_columns)]
            out = pa.RecordBatch.from_arrays(columns, names=[n if i != at else "members" for i, n in enumerate(batch.schema.names)])
            asked = batch.column(batch.schema.get_field_index("d1")).to_numpy()
            yield out.filter(pa.array(_digests(hashes, ends, 1) == asked))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" if f.name != "text" else "members binary" for f in docs.schema)
    return docs.mapInArrow(run, kinds)


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], group: list, queries: list[int], percent: int) -> list[tuple[int, int]]:
    """Links (by place) between the queries and all sets with 100 * intersection >= percent * union, less those that join nothing new.

    ``group`` names what is known to be joined already.  Cost: the shingles of all sets, once per query.
    """
    root = list(range(len(sets)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    first: dict = {}
    for i, g in enumerate(group):
        if g is not None:
            root[top(i)] = top(first.setdefault(g, i))
    sizes = np.array([len(s) for s in sets])
    values, codes = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(len(values), dtype=np.int32)
    links = []
    for q in queries:
        own = codes[at[q] : at[q + 1]]
        mark[own] = 1
        common = np.add.reduceat(mark[codes], at[:-1])
        mark[own] = 0
        for i in np.flatnonzero(100 * common >= percent * (sizes + sizes[q] - common)).tolist():
            if top(i) != top(q):
                root[top(i)] = top(q)
                links.append((q, i))
    return links


def _unpack(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in column]


def _edges(ids: np.ndarray, links: list[tuple[int, int]]) -> pa.Table:
    pairs = np.array(links, dtype=np.int64).reshape(-1, 2)
    return pa.table({"a": pa.array(ids[pairs[:, 0]]), "b": pa.array(ids[pairs[:, 1]])})


def _within(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, leads = rows.column("d1").to_numpy(), rows.column("leads").to_pylist()
        sets = _unpack(rows.column("members").combine_chunks())
        lead = leads.index(True)
        links = spanning_links(ids, sets, [None] * len(sets), [lead], percent)
        near = {lead, *(i for _, i in links)}
        rest = [i for i in range(len(sets)) if i not in near]
        joined = [0 if i in near else None for i in range(len(sets))]
        return _edges(ids, links + spanning_links(ids, sets, joined, rest, percent))

    return run


def _across(percent: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        ids, asks = rows.column("d1").to_numpy(), rows.column("asks").to_pylist()
        sets = _unpack(rows.column("members").combine_chunks())
        queries = [i for i, x in enumerate(asks) if x]
        return _edges(ids, spanning_links(ids, sets, rows.column("component").to_pylist(), queries, percent))

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, block: int = BLOCK, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id long, text string; other columns are not read).

    Words are cut at ASCII white space, A-Z lower-cased; shingles are ``k`` words.  Two texts are
    linked with 100 * intersection >= percent * union of their distinct shingles.  Null, empty and
    blank texts have no shingles, are linked with nothing and kept.  A row without an id is kept,
    its component is null, and it stands for no group.  Rows that repeat an id are looked at one by one
    and kept if the id is its group's smallest.  An empty table gives an empty result.  Columns of ``carry``
    come back with their rows.
    """
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    docs = whole.select("doc_id", "text")
    seen = materialize(sketch(whole, k))
    # a class is known by d1; its rows are told from other sets by d2 too
    named = seen.where("doc_id is not null and n_shingles > 0")
    classes = materialize(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")))
    rows = classes.select("d1", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("d1").alias("low")).where("size > 1")
    ties = materialize(rows.join(buckets, "key").groupBy("d1", "low").agg(F.sum("size").alias("weight")))
    sets = _clusters(docs, classes, ties, k, block)
    dealt = sets.withColumn("block", F.explode(F.when(F.col("leads"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
    links = materialize(dealt.groupBy("cluster", "block").applyInArrow(_within(percent), "a long, b long"))
    wide = sets.where("blocks > 1")
    if not wide.isEmpty():
        links = links.unionByName(_links_across(wide, links, percent))
    groups = components(links).withColumnRenamed("id", "d1")
    placed = classes.select("d1", "d2", "rep").join(groups, "d1", "left").withColumn("component", F.coalesce("component", "d1"))
    first = placed.groupBy("component").agg(F.min("rep").alias("component_id"))
    by_class = placed.join(first, "component").select("d1", "d2", "component_id", F.lit(True).alias("full"))
    linked = seen.drop("bands").withColumn("full", F.col("n_shingles") > 0).join(by_class, ["d1", "d2", "full"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return linked.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), *carry)


def _clusters(docs: DataFrame, classes: DataFrame, ties: DataFrame, k: int, block: int) -> DataFrame:
    """The set of every class that shares a bucket, with its cluster, block, and whether it leads the cluster."""
    cluster = components(ties, "d1", "low").withColumnRenamed("id", "d1")
    weight = ties.groupBy("d1").agg(F.sum("weight").alias("weight"))
    members = materialize(cluster.join(weight, "d1").join(classes.select("d1", "rep", "n"), "d1"))
    shape = members.groupBy(F.col("component").alias("cluster")).agg(
        F.max_by("d1", F.struct("weight", "d1")).alias("leader"), F.ceil(F.sum("n") / block).cast("int").alias("blocks")
    )
    placed = members.withColumnRenamed("component", "cluster").join(shape, "cluster").select(
        F.col("rep").alias("doc_id"), "d1", "cluster", "blocks", (F.col("d1") == F.col("leader")).alias("leads"),
        F.pmod(F.xxhash64("d1"), F.col("blocks")).cast("int").alias("block"),
    )
    # by a merge join at every size: a broadcast side would grow with the near-duplicates
    return materialize(_with_sets(docs.join(placed.hint("merge"), "doc_id"), k).dropDuplicates(["d1"]))


def _links_across(wide: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """Links between blocks of a cluster, of the classes that its leader's group does not hold yet."""
    wide = wide.join(components(links).withColumnRenamed("id", "d1"), "d1", "left").withColumn("component", F.coalesce("component", "d1"))
    heads = wide.where("leads").select("cluster", F.col("component").alias("head"))
    wide = materialize(wide.join(heads, "cluster").select("cluster", "d1", "component", "members", "block", "blocks", (F.col("component") != F.col("head")).alias("asks")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asks = wide.where("asks").select("cluster", "d1", "component", "members", F.col("block").alias("x"), every.alias("y"), "asks")
    told = wide.select("cluster", "d1", "component", "members", every.alias("x"), F.col("block").alias("y"), F.lit(False).alias("asks"))
    told = told.join(wide.where("asks").select("cluster", F.col("block").alias("x")).distinct(), ["cluster", "x"], "left_semi")
    pairs = asks.unionByName(told).where("x <> y")
    return materialize(pairs.groupBy("cluster", "x", "y").applyInArrow(_across(percent), "a long, b long"))


@query("op4_near_duplicates")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group under three-word shingles at 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
