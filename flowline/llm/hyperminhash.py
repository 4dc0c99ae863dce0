"""Near-duplicate documents by HyperMinHash signatures.

1. Each document becomes its set of word shingles (64-bit hashes) and a
   signature of 128 registers.  The top bits of a shingle's hash choose the
   register; of the smallest remainder there, the register keeps the count of
   leading zeros (6 bits) and the 10 bits after the leading one.  An empty
   register copies the first full one in its own fixed random order.
2. Documents with equal sets form one node.  Nodes are banded: 32 bands of 4
   registers, each band one 64-bit key.
3. *Star round*: every node is paired with the smallest node of each of its
   bands.  The Jaccard estimate, corrected for chance register collisions,
   discards hopeless pairs; the others are confirmed on their full sets.
   Confirmed links give components.
4. *Rest round*: bands that still hold nodes of different components have
   those pairs tested too, in pairs of blocks of ``BLOCK`` nodes, so that a
   large band spreads over many tasks.  A first pass finds, by estimate and
   size, the nodes with a pair to test (each pair in the first band it shares);
   a second gets their full sets and tests until the components are joined or
   every pair has failed.  Pairs never become rows: a block returns at most one
   link per node.  Pairs within a component need no test, as they can't
   change it.  So each pair of different texts that shares a band is tested or
   settled.

At a similarity of exactly 0.85 a pair shares no band with a chance of
(1 - 0.85**4)**32 < 1e-10.

Nulls and ties: a null or empty text, or one of white space, has no shingles
and is linked with nothing.
Rows with a null ``doc_id`` are returned with a null component, kept, and
linked with nothing.  Only ``doc_id`` and ``text`` are read.  Repeated rows
give a row each; rows of one ``doc_id`` with different texts are judged each
on its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.llm.common import mix64, staged, table, word_hashes

REGISTERS = 128          # 7 bits of the hash
REST_BITS = 57
MANTISSA = 10
BAND = 4
BANDS = REGISTERS // BAND
DEVIATION = 0.036        # of an estimate near the threshold, at most
BLOCK = 512              # nodes of a band compared in one go
# Chance that two different shingles give one register, for sets of like
# size (the constant of the HyperMinHash analysis).
COLLISION = 0.1699194871597391 / 2 ** MANTISSA

# For each register, the order in which an empty one looks for a full one.
_ORDER = np.stack([np.random.default_rng(1000 + i).permutation(REGISTERS) for i in range(REGISTERS)])


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words; a text of
    fewer words is one shingle, one without words has none."""
    h = word_hashes(text, lower=True)
    if not len(h):
        return h
    out = h[:1] if len(h) < size else h[:len(h) - size + 1]
    for k in range(1, min(size, len(h))):
        out = mix64(out, h[k:k + len(out)])
    if len(h) < size:
        out = mix64(out, np.full(1, len(h), np.uint64))
    return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 registers (uint16) of a sorted, non-empty set of hashes."""
    place = (shingles >> np.uint64(REST_BITS)).astype(np.int64)
    full, first = np.unique(place, return_index=True)       # sorted: the first is the smallest
    rest = shingles[first] & np.uint64((1 << REST_BITS) - 1)
    bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    shift = bits - 1 - MANTISSA
    after = np.where(shift >= 0, rest >> np.maximum(shift, 0).astype(np.uint64),
                     rest << np.maximum(-shift, 0).astype(np.uint64))
    value = (np.minimum(REST_BITS - bits, 63) << MANTISSA) | (after.astype(np.int64) & ((1 << MANTISSA) - 1))
    regs = np.zeros(REGISTERS, np.uint16)
    regs[full] = value.astype(np.uint16)
    if len(full) < REGISTERS:
        has = np.zeros(REGISTERS, bool)
        has[full] = True
        empty = np.flatnonzero(~has)
        order = _ORDER[empty]
        regs[empty] = regs[order[np.arange(len(empty)), has[order].argmax(axis=1)]]
    return regs


def band_keys(sigs: np.ndarray) -> np.ndarray:
    """(rows, 128) registers to (rows, 32) keys, one per band."""
    raw = np.ascontiguousarray(sigs).view(np.uint64).reshape(len(sigs), BANDS)
    return mix64(raw, np.broadcast_to(np.arange(BANDS, dtype=np.uint64) + np.uint64(1), raw.shape))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard estimate of signature rows, less the expected collisions."""
    same = (a == b).sum(axis=-1) / REGISTERS
    return (same - COLLISION) / (1 - COLLISION)


def _least(percent: int) -> float:
    """An estimate below this rules a pair out: six deviations."""
    return percent / 100 - 6 * DEVIATION


def _sigs(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, REGISTERS)


_SIGNED = "doc_id long, text_hash long, n long, set_a long, set_b long, sig binary"


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, text_hash, n, (set_a, set_b) naming the set, sig (null if empty)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, sig = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                if len(s):
                    # order-free digests of the set
                    a.append(int(np.bitwise_xor.reduce(mix64(s, s)).view(np.int64)))
                    b.append(int(mix64(s, ~s).sum(dtype=np.uint64).view(np.int64)))
                    sig.append(signature(s).tobytes())
                else:
                    a.append(0), b.append(0), sig.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("text_hash"), pa.array(n, pa.int64()),
                 pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sig, pa.binary())],
                names=["doc_id", "text_hash", "n", "set_a", "set_b", "sig"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(run, _SIGNED)


def _bands(nodes: DataFrame) -> DataFrame:
    """(band, node, number of the band): 32 rows per node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_sigs(batch.column("sig").to_pylist()))
                node = batch.column("node").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64).ravel()), pa.array(np.repeat(node, BANDS)),
                     pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(node)))],
                    names=["band", "node", "number"])

    return nodes.select("node", "sig").mapInArrow(run, "band long, node long, number int")


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that neither sizes nor estimate rule out."""
    least = _least(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ok = estimate(_sigs(batch.column("sig_a").to_pylist()),
                              _sigs(batch.column("sig_b").to_pylist())) >= least
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    sig = nodes.select("node", "n", "sig")
    return (pairs.join(sig.toDF("a", "n_a", "sig_a"), "a").join(sig.toDF("b", "n_b", "sig_b"), "b")
            .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .mapInArrow(run, "a long, b long"))


def _confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            ok = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b"))):
                if last[0] != a:
                    last = (a, shingle_set(ta, size))
                x, y = last[1], shingle_set(tb, size)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    texts = staged(_texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, nodes),
                   "near_texts")
    return (pairs.join(texts.toDF("b", "text_b"), "b").join(texts.toDF("a", "text_a"), "a")
            .mapInArrow(run, "a long, b long"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable, for the nodes of
    ``edges`` (a, b).  Large-star and small-star rounds until the edges stay
    as they are; a hub is only ever reduced by ``min``."""
    def state(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), name)
    now = state(edges)
    while now[0]:
        # large star: each neighbour above a node moves to the smallest around it
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.filter("a <> b").distinct()
        # small star: a node and its smaller neighbours move to the smallest of these
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = staged(small, name)
        after = state(edges)
        if after == now:
            break
        now = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _with_end(batches):
    yield from batches
    yield None


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups by (band, lo, hi) of sorted rows, each whole; a group holds
    two blocks at most."""
    held: pa.Table | None = None            # rows of the group that may go on
    for batch in _with_end(batches):
        if batch is not None:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
        if held is None or not held.num_rows:
            continue
        new = np.zeros(held.num_rows - 1, bool)
        for c in ("band", "lo", "hi"):
            new |= np.diff(held.column(c).to_numpy()) != 0
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), *([held.num_rows] if batch is None else [])]
        for s, e in zip(cuts, cuts[1:]):
            yield held.slice(s, e - s)
        held = held.slice(cuts[-1]).combine_chunks()


def _block_pairs(t: pa.Table, least: float, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): for a row of the lower block the rows of the higher one that
    may be near copies, of another component, and share no earlier band."""
    node, comp, own, n = (t.column(c).to_numpy() for c in ("node", "component", "own", "n"))
    sig = _sigs(t.column("sig").to_pylist())
    lo, hi = t.column("lo")[0].as_py(), t.column("hi")[0].as_py()
    number = t.column("number")[0].as_py()
    left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
    for i in left.tolist():
        j = right[comp[right] != comp[i]]
        if lo == hi:
            j = j[node[j] > node[i]]
        j = j[100 * np.minimum(n[j], n[i]) >= percent * np.maximum(n[j], n[i])]
        if len(j):
            j = j[estimate(sig[j], sig[i]) >= least]
        if len(j) and number:
            same = (sig[j, :number * BAND] == sig[i, :number * BAND]).reshape(len(j), number, BAND).all(axis=2)
            j = j[~same.any(axis=1)]
        if len(j):
            yield i, j


def _rest(bands: DataFrame, docs: DataFrame, nodes: DataFrame, comps: DataFrame, size: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) between nodes of different components that share
    a band: as many as join them, not all."""
    least = _least(percent)
    labelled = (bands.join(comps, "node", "left")
                .select("band", "number", "node", F.coalesce("component", "node").alias("component")))
    mixed = (labelled.groupBy("band").agg(F.count(F.lit(1)).alias("m"), F.min("component").alias("_lo"),
                                          F.max("component").alias("_hi"))
             .filter("_lo <> _hi").select("band", (F.floor((F.col("m") - 1) / BLOCK) + 1).cast("int").alias("blocks")))
    rows = labelled.join(mixed, "band").join(nodes.select("node", "n", "sig"), "node")
    # a node of one block meets every block, each pair of blocks in one place
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = (rows.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
    kind = "band long, lo int, hi int, own int, number int, node long, component long, n long, sig binary"
    names = [c.split()[0] for c in kind.split(", ")]

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            hit = np.zeros(t.num_rows, bool)
            for i, j in _block_pairs(t, least, percent):
                hit[i] = True
                hit[j] = True
            if hit.any():
                yield from t.filter(pa.array(hit)).to_batches()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            node, comp = t.column("node").to_numpy(), t.column("component").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()]
            root = {c: c for c in comp}

            def find(c):
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            links = []
            for i, js in _block_pairs(t, least, percent):
                for j in js.tolist():
                    a, b = find(comp[i]), find(comp[j])
                    if a == b:                          # joined through others
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        root[max(a, b)] = min(a, b)
                        links.append((int(node[i]), int(node[j])))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)],
                                                 names=["a", "b"])

    def dealt(df):
        return df.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")

    near = staged(dealt(rows.select(*names)).mapInArrow(involved, kind), "near_blocks")
    sets = _sets(near.select("node").distinct(), docs, nodes, size)
    return dealt(near.join(sets, "node").select(*names, "set")).mapInArrow(settle, "a long, b long").distinct()


def _sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, set): the shingle sets of the wanted nodes, from their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([shingle_set(t, size).tobytes() for t in b.column("text").to_pylist()],
                                            pa.binary())], names=["node", "set"])

    return _texts(wanted, docs, nodes).mapInArrow(run, "node long, set binary")


def _texts(wanted: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes."""
    needed = wanted.join(nodes.select("node", "doc_id", "text_hash"), "node")
    return (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .join(needed, ["doc_id", "text_hash"]).dropDuplicates(["node"]).select("node", "text"))


def _judged(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for each document."""
    rows = staged(signed(docs, size), "near_signed")
    nodes = staged(rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("set_a", "set_b")
                   .agg(F.min(F.struct("doc_id", "text_hash", "n", "sig")).alias("r"))
                   .select(F.monotonically_increasing_id().alias("node"), "set_a", "set_b",
                           "r.doc_id", "r.text_hash", "r.n", "r.sig"), "near_nodes")
    bands = _bands(nodes)
    shared = (bands.groupBy("band").agg(F.min("node").alias("rep"), F.max("node").alias("_hi"))
              .filter("rep <> _hi").select("band", "rep"))
    bands = staged(bands.join(shared, "band"), "near_bands")
    star = bands.filter("node <> rep").select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct()
    likely = staged(_likely(star, nodes, percent), "near_star")
    comps = components(_confirmed(likely, docs, nodes, size, percent))
    more = staged(_rest(bands, docs, nodes, comps, size, percent), "near_links")
    if not more.isEmpty():
        comps = components(comps.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more))
    # a component is named by its smallest document
    names = nodes.join(comps, "node", "left").select(
        "set_a", "set_b", "doc_id", F.coalesce("component", "node").alias("component"))
    least = names.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = names.join(least, "component").select("set_a", "set_b", "component_id")
    return (rows.join(names, ["set_a", "set_b"], "left")
            .select("doc_id", "text_hash", F.col("n").alias("n_shingles"),
                    F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each document; links at a
    Jaccard similarity of ``percent`` or more over ``size``-word shingles."""
    return _judged(docs, size, percent).drop("text_hash")


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The documents without those that near-copy one with a smaller doc_id,
    and without repeated rows of one doc_id and text; documents without a
    doc_id stay."""
    gone = (_judged(docs, size, percent).filter(~F.col("kept"))
            .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    rows = docs.select(docs["doc_id"].alias("_doc"), F.xxhash64(docs["text"]).alias("_text"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    rest = rows.join(gone, (F.col("_doc") == F.col("_id")) & (F.col("_text") == F.col("_hash")), "left_anti")
    once = rest.filter("_doc IS NOT NULL").dropDuplicates(["_doc", "_text"])
    return once.unionByName(rest.filter("_doc IS NULL")).select("_row.*")


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all ``documents``: 3-word shingles, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
