"""SimHash near-duplicates: fingerprints of 4-word shingles, linked at 4 or fewer differing bits.

Candidates come from the pigeonring principle. The 64 bits are a ring of five segments; if two
fingerprints differ in at most 4 bits, then from some segment on every chain of l consecutive
segments differs in at most floor(4 l / 5) bits. Chains of one and two segments make the join key:
the first segment must be equal and the second may differ in one bit. It is emitted with each of its
bits left out in turn, so two fingerprints meet whenever the chain allows it. Pairs that meet must
keep the budget of every longer chain before their full distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import connected_components, materialize

BITS, DISTANCE, SHINGLE, SEED = 64, 4, 4, 42
#: Lowest bit and width of each segment of the ring.
SEGMENTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
#: Fingerprints of a block: larger buckets are cut into blocks, which are compared two by two.
BLOCK = 2048
#: Fingerprints of a search's front that are compared at once.
FRONT = 64


def fingerprint(text: bytes) -> int:
    """Of one text: a bit is set if it is set in over half of the shingles' hashes. No words: 0."""
    import numpy as np
    from xxhash import xxh64_intdigest as xxh64

    words = text.lower().split()  # bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    if len(words) <= SHINGLE:
        return xxh64(joined, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    counts = np.zeros(BITS, np.int64)
    first, last = starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist()
    for at in range(0, len(first), 65536):
        pairs = zip(first[at : at + 65536], last[at : at + 65536], strict=True)
        hashes = np.array([xxh64(joined[a:b], SEED) for a, b in pairs], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * counts > len(first)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row; whole texts, null as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            found = np.array([fingerprint(t.as_py() or b"") for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def chain_keys(fps):
    """Bucket keys of an array of fingerprints, shape (n, 65 or fewer): segment number, the segment, the next one without one bit, and which."""
    import numpy as np

    x = fps.view(np.uint64)
    out = []
    for i, (low, width) in enumerate(SEGMENTS):
        low2, width2 = SEGMENTS[(i + 1) % len(SEGMENTS)]
        own = (x >> np.uint64(low)) & np.uint64((1 << width) - 1)
        following = (x >> np.uint64(low2)) & np.uint64((1 << width2) - 1)
        for b in range(width2):
            rest = following & ~np.uint64(1 << b)
            out.append((np.uint64(i) << np.uint64(40)) | (np.uint64(b) << np.uint64(32)) | (own << np.uint64(width2)) | rest)
    return np.stack(out, 1).view(np.int64)


def linked(one, two, segment: int):
    """Which of ``one`` link to which of ``two``, as index arrays: pairs that pass the chain from ``segment`` on, then the whole distance."""
    import numpy as np

    differ = one[:, None] ^ two[None, :]
    # the first two segments of the chain on the whole square, the others on what is left of it
    low, width = SEGMENTS[(segment + 1) % len(SEGMENTS)]
    first, first_width = SEGMENTS[segment]
    mask = np.uint64(((1 << width) - 1) << low | ((1 << first_width) - 1) << first)
    i, j = np.nonzero(np.bitwise_count(differ & mask) <= DISTANCE * 2 // len(SEGMENTS))
    left = differ[i, j]
    for length in range(3, len(SEGMENTS) + 1):
        low, width = SEGMENTS[(segment + length - 1) % len(SEGMENTS)]
        mask |= np.uint64(((1 << width) - 1) << low)
        passed = np.bitwise_count(left & mask) <= DISTANCE * length // len(SEGMENTS)
        i, j, left = i[passed], j[passed], left[passed]
    near = np.bitwise_count(left) <= DISTANCE
    return i[near], j[near]


def forest(fps, blocks, segment: int):
    """Edges, as two index arrays, that span the components of a tile: breadth first, so that what was reached is not compared again.

    ``blocks`` tells which of the two blocks of the tile each fingerprint is from. Two fingerprints of one
    block are compared only if the tile has no other, since that block has a tile of its own.
    """
    import numpy as np

    n, two = len(fps), bool(len(blocks)) and bool((blocks != blocks[0]).any())
    waiting = np.ones(n, bool)
    us, vs = [], []
    for seed in range(n):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        frontier = np.array([seed])
        while len(frontier):
            reached = []
            for at in range(0, len(frontier), FRONT):
                part = frontier[at : at + FRONT]
                for own in {*blocks[part].tolist()} if two else (None,):
                    mine = part if own is None else part[blocks[part] == own]
                    rest = np.flatnonzero(waiting if own is None else waiting & (blocks != own))
                    if not len(rest):
                        continue
                    i, j = linked(fps[mine], fps[rest], segment)
                    j, at_first = np.unique(j, return_index=True)
                    us.append(rest[j]), vs.append(mine[i[at_first]])
                    waiting[rest[j]] = False
                    reached.append(rest[j])
            frontier = np.concatenate(reached) if reached else np.array([], int)
    none = np.array([], int)
    return np.concatenate(us or [none]), np.concatenate(vs or [none])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of the tiles of rows ``key, x, y, block, fp``, sorted by the first three; one tile is held at a time."""
    import numpy as np

    held: list[tuple] = []
    held_key = None
    us, vs, size = [], [], 0

    def close() -> int:
        fps, blocks = (np.concatenate(x) for x in zip(*held, strict=True))
        if len(fps) < 2:
            return 0
        i, j = forest(fps.view(np.uint64), blocks, int(held_key[0]) >> 40)
        us.append(fps[i]), vs.append(fps[j])
        return len(i)

    def flush() -> pa.RecordBatch:
        none = np.array([], np.int64)
        out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c or [none]), pa.int64()) for c in (us, vs)], ["u", "v"])
        us.clear(), vs.clear()
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        key, x, y, blocks, fps = (batch.column(i).to_numpy() for i in range(5))
        new = (key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        starts = np.flatnonzero(np.r_[True, new])
        ends = np.r_[starts[1:], len(key)]
        # tiles of one row that neither begin nor end the batch have no partner
        alone = (ends - starts == 1) & (starts > 0) & (ends < len(key))
        for a, b in zip(starts[~alone].tolist(), ends[~alone].tolist(), strict=True):
            own = (key[a], x[a], y[a])
            if own != held_key:
                size += close() if held else 0
                held_key, held = own, []
            held.append((fps[a:b], blocks[a:b]))
        if size > 20_000:
            yield flush()
            size = 0
    if held:
        close()
    yield flush()


def _expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import numpy as np

    for batch in batches:
        fps = batch.column(0).to_numpy()
        for at in range(0, len(fps), 500):
            part = fps[at : at + 500]
            keys = chain_keys(part)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(part, keys.shape[1]))], ["key", "fp"])


def link_fingerprints(fps: DataFrame) -> DataFrame:
    """Edges ``u``, ``v`` between distinct fingerprints ``fp`` that span the same components as all links do.

    A bucket of more than BLOCK fingerprints is cut into blocks by a hash, and every two of its blocks,
    and each with itself, make a tile; a smaller one is a single tile. Each tile gives a spanning forest,
    not pairs, so no task holds more than about two blocks and a dense group's tiles are dealt to many.
    """
    keyed = fps.select("fp").mapInArrow(_expand, "key long, fp long")
    large = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
    large, _ = materialize(large.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("cuts")), "simhash-large")
    cut = keyed.join(large, "key", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    cut = cut.select("key", "fp", "cuts", F.pmod(F.xxhash64("fp"), F.col("cuts")).cast("int").alias("block"))
    tiles = cut.select("key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other"))
    tiles = tiles.select("key", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "fp")
    return tiles.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(_scan, "u long, v long").distinct()


def components(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` (the smallest reachable id) of every row of ``docs``.

    A null or blank text has fingerprint zero and is linked like any other. Rows that repeat an id
    keep their own fingerprints and their rows. Null ids take part, but are no component's id unless
    it has no other. An empty table gives an empty result. Equal fingerprints are one node, so exact
    copies cost one row each.
    """
    found, _ = materialize(fingerprints(docs), "simhash-fp")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes, _ = materialize(nodes, "simhash-nodes")
    roots = connected_components(link_fingerprints(nodes), "simhash-cc")
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(smallest, "root").select("fp", "component_id")
    return found.join(labels, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id; columns as given.

    Rows that repeat a kept id are kept, as they are one document; a component with null ids only
    keeps those.
    """
    own = components(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(own, docs.doc_id.cast("long").eqNullSafe(own["__id"]), "left_semi")
