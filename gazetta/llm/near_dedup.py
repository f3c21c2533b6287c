"""Near-duplicate detection with fast similarity sketches, banding and exact verification.

A document's set holds the hashes of its five-word shingles. Its sketch has T coordinates. In each
round every element falls into one hashed bin with a hashed value, smaller in earlier rounds, and
a bin keeps its least value; after T rounds, round T + j puts all elements into bin j, so every
coordinate is filled. Two sketches agree in a coordinate with a probability equal to the Jaccard
similarity, concentrated as if coordinates were independent. Bands of ROWS coordinates are the
bucket keys: at similarity 0.75 a pair shares none of the 64 bands with probability 4e-6.

1. Equal sets are one node, named by their smallest doc_id; copies collapse before any shuffle.
2. Nodes that share a bucket are linked to the bucket's smallest node, its leader. Buckets are
   first formed within a batch, which sends on one row for each key, so a hot key costs a row for
   each batch.
3. Nodes that share a leader have one home, split by the size of its sets. A node meets its leaders
   in blocks of two homes (or one); its set travels once to each of these, where all sets are
   compared exactly through an inverted index. No pair leaves a task, only links of components.
4. Components of links. Buckets that still hold several components are looked at again, in parts
   of bounded size: whole sketches are compared, and where a node outside a bucket's largest
   component agrees with one of another component in CLOSE of the coordinates (five standard
   deviations below the threshold), their homes meet in a block as well.

Defined results: null, empty and wordless texts have an empty set and are linked with nothing;
texts of fewer than five words have one shingle; rows of one doc_id are one node, also where their
texts differ; a null doc_id is linked with nothing; extra columns are ignored; an empty table gives
an empty result. Equality of shingles is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .blobs import gather, tidied
from .common import cut, documents, remove, stored
from .components import components
from .hashing import combine, mix, shingles

WIDTH, PERCENT = 5, 75
ROWS, BANDS = 6, 64
T = ROWS * BANDS
CLOSE = 0.655
#: Nodes in one part of a bucket; elements of the sets of one home; bytes of sets sent at once; blocks served in one row.
BUCKET, ELEMENTS, SEND_BYTES, TARGETS = 4096, 1 << 18, 16 << 20, 500


def sketch(elements: np.ndarray) -> np.ndarray:
    """The T coordinates of a non-empty set."""
    out = np.full(T, np.iinfo("u8").max, "u8")
    done, step = 0, max(1, 2500 // len(elements))
    while done < T:
        rounds = np.arange(done, min(T, done + step), dtype="u8")
        h = mix(elements[None, :] + mix(rounds * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))[:, None])
        bins = ((h >> np.uint64(32)) * np.uint64(T)) >> np.uint64(32)
        np.minimum.at(out, bins.ravel().astype("i8"), ((rounds[:, None] << np.uint64(52)) | (mix(h) >> np.uint64(12))).ravel())
        done += len(rounds)
        if (out != np.iinfo("u8").max).all():
            return out
    for j in np.flatnonzero(out == np.iinfo("u8").max).tolist():
        out[j] = (np.uint64(T + j) << np.uint64(52)) | (mix(mix(elements + np.uint64(T + j))).min() >> np.uint64(12))
    return out


def band_keys(s: np.ndarray) -> np.ndarray:
    cells = s.reshape(BANDS, ROWS)
    return combine([np.arange(BANDS, dtype="u8"), *(cells[:, i] for i in range(ROWS))], 5)


def _halves(s: np.ndarray) -> bytes:
    """A sketch cut to four bits for each coordinate."""
    c = mix(s).astype("u1") & 15
    return (c[::2] | (c[1::2] << 4)).tobytes()


def _whole(short: bytes, n: int) -> np.ndarray:
    """The coordinates of n sketches cut by _halves."""
    pairs = np.frombuffer(short, "u1").reshape(n, T // 2)
    return np.stack([pairs & 15, pairs >> 4], 2).reshape(n, T)


def set_key(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    return int(mix(elements).sum(dtype="u8").astype("i8")), int(np.bitwise_xor.reduce(mix(elements ^ np.uint64(0x5851F42D4C957F2D))).astype("i8"))


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype("i4")), pa.array(values, kind))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, n, k1, k2, the band keys and the sketches cut to four bits for each coordinate."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            n, k1, k2, bands, short = [], [], [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py() or b"", WIDTH)
                a, b = set_key(own)
                s = sketch(own) if len(own) else None
                for to, x in zip((n, k1, k2, bands, short), (len(own), a, b, np.empty(0, "i8") if s is None else band_keys(s).view("i8"), b"" if s is None else _halves(s)), strict=True):
                    to.append(x)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                _lists(np.concatenate(bands), np.array([len(x) for x in bands]), pa.int64()), pa.array(short, pa.binary()),
            ], names=["doc_id", "n", "k1", "k2", "bands", "short"])


def _in_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, null) once for each key of a batch, for its smallest node; (any key, node, leader) for its other nodes."""
    for whole in batches:
        for at in range(0, whole.num_rows, 5000):
            batch = whole.slice(at, 5000)
            node = np.repeat(batch.column("node").to_numpy(), BANDS)
            key = batch.column("bands").flatten().to_numpy()
            order = np.lexsort((node, key))
            key, node = key[order], node[order]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            leader = node[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            pairs = np.unique(np.stack([node[~first], leader[~first]], 1), axis=0)
            spread = combine([pairs[:, 0].astype("u8"), pairs[:, 1].astype("u8")], 3).view("i8")
            k, v = np.concatenate([key[first], spread]), np.concatenate([node[first], pairs[:, 0]])
            to = np.concatenate([np.zeros(first.sum(), "i8"), pairs[:, 1]])
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(v), pa.array(to, mask=np.arange(len(to)) < first.sum())], names=["key", "node", "to"])


def _pairs(buckets: DataFrame) -> DataFrame:
    """Distinct pairs a < b of (key, node, to): the given ones, and each node of a key with the key's smallest."""
    given = buckets.where("to is not null").select(F.col("to").alias("a"), F.col("node").alias("b"))
    rows = buckets.where("to is null").withColumn("a", F.min("node").over(Window.partitionBy("key")))
    return given.unionByName(rows.select("a", F.col("node").alias("b"))).where("a < b").distinct()


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text its set, once for each block that needs it; at most SEND_BYTES and one set at a time."""
    block, node, comp, sets, size = [], [], [], [], 0

    def out() -> pa.RecordBatch:
        numbers = [pa.array(x, pa.int64()) for x in (block, node, comp)]
        return pa.RecordBatch.from_arrays([*numbers, pa.array(sets, pa.binary())], names=["block", "node", "comp", "own"])

    for whole in batches:
        for i in range(whole.num_rows):
            own = shingles(whole.column("text")[i].as_py() or b"", WIDTH).tobytes()
            doc_id, c = (whole.column(k)[i].as_py() for k in ("doc_id", "comp"))
            for b in whole.column("blocks")[i].as_py():
                block.append(b)
                node.append(doc_id)
                comp.append(c)
                sets.append(own)
                size += len(own)
                if size >= SEND_BYTES:
                    yield out()
                    block, node, comp, sets, size = [], [], [], [], 0
    if node:
        yield out()


def links_among(node: list[int], comp: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all similar sets that are not in one component yet; fewer than there are nodes.

    An inverted index of the elements gives, for one set after the other, the exact sizes of its
    intersections with all sets before it. Rows of one node are linked without a look.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    sizes = np.array([len(x) for x in sets])
    _, element = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(element, kind="stable")
    posting, begin = owner[order], np.searchsorted(element[order], np.arange(element.max() + 1))
    # where each element of each set stands in its posting list: the sets before it come first
    place = np.empty(len(order), "i8")
    place[order] = np.arange(len(order))
    at, out, left = np.cumsum(sizes) - sizes, [], len(set(comp))
    for i in range(len(sets)):
        if left == 1:
            break
        own = slice(at[i], at[i] + sizes[i])
        first = begin[element[own]]
        before = posting[gather(first, place[own] - first)]
        both = np.bincount(before, minlength=i) if len(before) else np.zeros(i, "i8")
        for j in np.flatnonzero((both > 0) & (100 * both >= percent * (sizes[i] + sizes[:i] - both))).tolist():
            x, y = root(comp[i]), root(comp[j])
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((node[j], node[i]))
                left -= 1
    return out


def _compare(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The links among the sets of each block; rows come by block."""

    def links(rows: list[tuple]) -> pa.RecordBatch:
        found = links_among(*(list(x) for x in zip(*rows, strict=True)), percent) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], names=["a", "b"])

    now, rows = None, []
    for batch in batches:
        own = batch.column("own")
        for i, (block, node, comp) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "node", "comp")), strict=True)):
            if block != now:
                if rows:
                    yield links(rows)
                now, rows = block, []
            rows.append((node, comp, np.array(np.frombuffer(own[i].as_buffer(), "u8"))))
    if rows:
        yield links(rows)


def homes(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """node, home: nodes that share a leader live together, as long as their sets have ELEMENTS elements in all."""
    lead = pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("lead"))
    far = lead.select(F.col("node").alias("lead"), F.col("lead").alias("far"))
    placed = members.select("node", "n").join(lead, "node", "left").join(far, "lead", "left").select("node", "n", F.coalesce("far", "lead", "node").alias("label"))
    sizes = placed.groupBy("label").agg(F.ceil(F.sum("n") / ELEMENTS).alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.greatest("parts", F.lit(1)))
    return placed.join(sizes, "label").select("node", F.xxhash64("label", part).alias("home"))


def block_of(home_a: Column, home_b: Column) -> Column:
    return F.xxhash64(F.least(home_a, home_b), F.greatest(home_a, home_b))


def verified(docs: DataFrame, needed: DataFrame, comps: DataFrame | None, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) of nodes that meet in a block, whose full sets are similar enough and whose components differ.

    needed: distinct (node, block); comps: node, component of those that are linked already. All sets of
    a block are compared with each other, and each travels to it once.
    """
    salts = needed.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / TARGETS).alias("salts"))
    salted = needed.join(salts, "node").groupBy("node", F.pmod(F.xxhash64("block"), F.col("salts")).alias("salt")).agg(F.collect_list("block").alias("blocks"))
    known = salted.withColumn("component", F.col("node")) if comps is None else salted.join(comps, "node", "left")
    wanted = known.select(F.col("node").alias("id"), F.coalesce("component", "node").alias("comp"), "blocks")
    texts = docs.join(wanted, F.col("doc_id") == F.col("id")).select("doc_id", "text", "comp", "blocks")
    sets = texts.mapInArrow(lambda b: tidied(_send(b)), "block long, node long, comp long, own binary")
    dealt = sets.repartition(F.col("block")).sortWithinPartitions("block", "node")
    return dealt.mapInArrow(lambda batches: tidied(_compare(batches, percent)), "a long, b long").where("a <> b").distinct()


def _close(rows: list[tuple]) -> np.ndarray:
    """(node, home, home) of each asking node of a bucket's block and the targets of other components that are close to it."""
    node, home, n, comp, ask, aim = (np.array([r[i] for r in rows]) for i in range(6))
    s = _whole(b"".join(r[6] for r in rows), len(rows))
    out = [np.empty((0, 3), "i8")]
    for i in np.flatnonzero(ask).tolist():
        rest = np.flatnonzero(aim & (comp != comp[i]) & (100 * np.minimum(n, n[i]) >= PERCENT * np.maximum(n, n[i])))
        agree = np.concatenate([np.empty(0, "i8"), *((s[rest[k : k + 4096]] == s[i]).sum(1) for k in range(0, len(rest), 4096))])
        near = rest[agree >= CLOSE * T]
        if len(near):
            there, here = home[near], np.unique(home[near])
            out.append(np.stack([node[near], there, np.full(len(near), home[i])], 1))
            out.append(np.stack([np.full(len(here), node[i]), here, np.full(len(here), home[i])], 1))
    return np.unique(np.concatenate(out), axis=0)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_close() of each block of a bucket; rows come by block."""

    def meetings(rows: list[tuple]) -> pa.RecordBatch:
        found = _close(rows)
        return pa.RecordBatch.from_arrays([pa.array(found[:, k], pa.int64()) for k in range(3)], names=["node", "home_a", "home_b"])

    key, rows = None, []
    for batch in batches:
        for *k, node, home, n, comp, ask, aim, short in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "home", "n", "comp", "ask", "aim", "short")), strict=True):
            if k != key:
                if rows:
                    yield meetings(rows)
                key, rows = k, []
            rows.append((node, home, n, comp, ask, aim, short))
    if rows:
        yield meetings(rows)


def unlinked(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Distinct (node, block): where nodes of different components that share a bucket and have close sketches meet.

    members: node, n, bands, short, home. A bucket's nodes outside its largest component ask. Buckets are
    split into blocks of about BUCKET asking nodes and as many others. Not the pairs, whose number grows
    with the square of a group, but only the homes that they join go on.
    """
    placed = members.join(comps, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    keys = placed.select("node", "comp", F.explode("bands").alias("key"))
    of_comp = keys.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    several = of_comp.groupBy("key").agg(F.max(F.struct("c", "comp"))["comp"].alias("main"), F.sum("c").alias("size"), F.count(F.lit(1)).alias("comps")).where("comps > 1")
    shared = keys.join(several, "key").groupBy("node").agg(F.collect_list(F.struct("key", "main", F.ceil(F.col("size") / BUCKET).alias("parts"))).alias("own"))
    rows = shared.join(placed.select("node", "home", "n", "comp", "short"), "node").select("node", "home", "n", "comp", "short", F.explode("own").alias("x"))
    g, asks = F.pmod(F.xxhash64("node"), F.col("x.parts")), F.col("comp") != F.col("x.main")
    role = lambda i, j, ask, aim: F.struct(i.alias("i"), j.alias("j"), ask.alias("ask"), aim.alias("aim"))
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0).cast("long")
    others = F.sequence(zero, F.col("x.parts") - 1)
    asked, asking = F.transform(others, lambda t: role(t, g, no, yes)), F.transform(others, lambda t: role(g, t, yes, no))
    roles = F.when(F.col("x.parts") == 1, F.array(role(zero, zero, asks, yes))).when(asks, F.concat(asked, asking)).otherwise(asked)
    own = ["node", "home", "n", "comp", "short"]
    dealt = rows.select(F.col("x.key").alias("key"), *own, F.explode(roles).alias("r")).select("key", "r.*", *own)
    blocks = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
    met = blocks.mapInArrow(lambda b: tidied(_across(b)), "node long, home_a long, home_b long")
    return met.select("node", block_of(F.col("home_a"), F.col("home_b")).alias("block")).distinct()


def near_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    as_bytes = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    sets, sets_at = stored(as_bytes.mapInArrow(lambda b: tidied(_sets(b)), "doc_id long, n long, k1 long, k2 long, bands array<long>, short binary"))
    same = ["n", "k1", "k2"]
    ids = cut(sets.select("doc_id", *same))
    least = F.min(F.struct(F.col("doc_id").alias("node"), "bands", "short")).alias("m")
    classes, classes_at = stored(sets.where("n > 0 and doc_id is not null").groupBy(*same).agg(least).select(*same, "m.*"))
    remove(docs.sparkSession, sets_at)
    names = cut(classes.select(*same, "node"))
    buckets = classes.select("node", "bands").mapInArrow(lambda b: tidied(_in_batch(b)), "key long, node long, to long")
    pairs = cut(_pairs(buckets))
    members = cut(classes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node").select("node", "n", "bands", "short"))
    remove(docs.sparkSession, classes_at)
    members = cut(members.join(homes(members, pairs), "node"))
    texts, texts_at = stored(as_bytes.join(members.select(F.col("node").alias("doc_id")), "doc_id", "left_semi"))
    home = lambda k: members.select(F.col("node").alias(k), F.col("home").alias(f"home_{k}"))
    led = pairs.join(home("a"), "a").join(home("b"), "b")
    meeting = led.select(F.explode(F.array("a", "b")).alias("node"), block_of(F.col("home_a"), F.col("home_b")).alias("block")).distinct()
    links = cut(verified(texts, meeting, None, percent))
    comps = components(links)
    more = cut(verified(texts, cut(unlinked(members, comps)), comps, percent))
    if not more.isEmpty():
        comps = components(links.unionByName(more))
    remove(docs.sparkSession, texts_at)
    nodes = names.join(comps, "node", "left").select(*same, F.coalesce("component", "node").alias("component"))
    out = ids.join(nodes, same, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir)).withColumn("kept", F.col("doc_id") == F.col("component_id"))
