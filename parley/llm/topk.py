"""Exact top-k search by inner product over sorted lists (NRA aggregation).

Candidates are packed into shards of bounded size, one row each, and queries into blocks. Every block
is sent to every shard by an equi-join. In a shard each dimension is a list of the candidates' components
in order. For a query the lists are read from the end that its sign favours, front to back and in
step; all queries of a block are read for at once, as matrix products over what has been read. What a
list has not shown yet of a candidate is no more than the list's next value, which bounds each
candidate's score from above; from below it lies between what the lists' last values and the product of
the remaining lengths of candidate and query allow. Reading ends for a query when no outsider can reach
the k-th best score that is known. That is carried from shard to shard; a query that has none yet
resolves the candidates with the best lower bounds first. Only candidates whose upper bounds still can
have their final scores resolved. The shards' own top k are merged by query.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType
from pyspark.sql.window import Window

from parley.llm.common import materialize

#: Candidates of a shard and queries of a block.
SHARD_ROWS, BLOCK_ROWS = 4096, 256
#: Shares of the lists after which bounds are taken.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 3 / 8, 1 / 2, 5 / 8, 3 / 4)
#: Share of the lists after which a query without a known score takes lower bounds, and the candidates that it resolves then, in multiples of k.
START, FIRST = 1 / 4, 4
#: Reading ends where no more than one candidate in so many can still qualify.
FEW = 32
#: Inner products stay below this sum of magnitudes in doubles; beyond it they are computed with Python integers.
EXACT = float(2**53)
#: Components below this are whole numbers in single precision, and so are their differences; bounds are taken in it then.
NARROW = float(2**20)
#: Pairs of query and candidate that are resolved at once.
PAIRS = 65_536
#: Blocks of which a task holds the k-th best scores found so far.
HELD_BLOCKS = 4096


def matrices(batch: pa.RecordBatch, scale: int) -> Iterator[tuple]:
    """``ids, vecs`` of the batch's vectors of one length each, floor(scale * x) of each component x taken as a double; vectors that are null or hold a null, NaN or infinity are left out."""
    import numpy as np

    ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    flat = lists.values.to_numpy(zero_copy_only=False).astype(float)  # nulls as NaN
    ends = lists.offsets.to_numpy()
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    fine = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends[1:]] == bad[ends[:-1]])
    lengths = np.diff(ends)
    for dim in np.unique(lengths[fine]).tolist():
        which = np.flatnonzero(fine & (lengths == dim))
        with np.errstate(over="ignore", invalid="ignore"):
            made = np.floor(scale * flat[ends[which][:, None] + np.arange(dim)])
            vecs = made.astype(np.int64)
        # what 64 bits don't hold is their end
        vecs[made >= 2.0**63], vecs[made < -(2.0**63)] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
        yield ids[which], vecs


def packs(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """The usable ones of rows ``id, v`` in rows of at most ``size`` of them: a ``name``, ``dim``, flat ``ids`` and ``vecs``, and the latter's number type ``code``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: dict[int, tuple[list, list]] = {}

        def close(dim: int, least: int) -> Iterator[pa.RecordBatch]:
            """Packs of what is held of a length, as long as there are ``least`` rows of it."""
            ids, vecs = (np.concatenate(x) for x in held.pop(dim))
            at = 0
            while len(ids) - at >= least:
                some, part = ids[at : at + size], vecs[at : at + size]
                low, high = int(part.min(initial=0)), int(part.max(initial=0))
                code = next((c for c in ("<i2", "<i4") if np.iinfo(c).min <= low and high <= np.iinfo(c).max), "<i8")
                one = ([uuid.uuid4().hex], [dim], [code], [some.astype("<i8").tobytes()], [part.astype(code).tobytes()])
                kinds = (pa.string(), pa.int32(), pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(one, kinds, strict=True)], ["name", "dim", "code", "ids", "vecs"])
                at += len(some)
            if at < len(ids):
                held[dim] = ([ids[at:]], [vecs[at:]])

        for batch in batches:
            for some, part in matrices(batch, scale):
                ids, vecs = held.setdefault(part.shape[1], ([], []))
                ids.append(some), vecs.append(part)
                if sum(map(len, ids)) >= size:
                    yield from close(part.shape[1], size)
        for dim in list(held):
            yield from close(dim, 1)

    return rows.mapInArrow(run, "name string, dim int, code string, ids binary, vecs binary")


class Lists:
    """A shard's candidates as sorted lists, one for each dimension and either end.

    A list tells of a candidate once its values have come down to the candidate's own.
    """

    def __init__(self, ids, vecs) -> None:
        import numpy as np

        self.ids, self.vecs, self.rows = ids, vecs, vecs.astype(float)
        self.magnitude = np.abs(self.rows).max(0)
        self.squares = (self.rows**2).sum(1)
        self.narrow = self.magnitude.max(initial=0.0) < NARROW
        self.columns = np.ascontiguousarray(self.rows.T.astype(np.float32 if self.narrow else float))
        self.rising = np.sort(self.columns, axis=1)
        self.entries = 0
        self._read: dict[int, object] = {}

    def next(self, depth: int):
        """The value after ``depth`` entries of each list: those that favour a positive weight, then those that favour a negative one."""
        import numpy as np

        return np.concatenate([self.rising[:, -1 - depth], self.rising[:, depth]]).astype(float)

    def read(self, depth: int):
        """By how much the first ``depth`` entries of all lists are ahead of the next one, by candidate; 0 of those not among them."""
        import numpy as np

        if depth not in self._read:
            dims = len(self.columns)
            out = np.empty((2 * dims, len(self.ids)), self.columns.dtype)
            np.maximum(self.columns - self.rising[:, -1 - depth][:, None], 0, out=out[:dims])
            np.minimum(self.columns - self.rising[:, depth][:, None], 0, out=out[dims:])
            self._read[depth] = out
        return self._read[depth]

    def search(self, own, queries, k: int, known, since=None) -> list[list[tuple[int, int]]]:
        """Of each query the k best (score, id) or fewer, ties to the smaller id: all that may be among the k best of all shards.

        Candidates with the query's ``own`` id are left out. ``known`` holds the k-th best score of each
        query so far, and is raised to what is found here. ``since`` holds the place in DEPTHS at which each
        query's reading ended in the shard before, where it looks first in this one.
        """
        import numpy as np

        n, m, dims = len(self.ids), len(queries), len(self.columns)
        weights = queries.astype(float)
        narrow = self.narrow and np.abs(weights).max(initial=0.0) < NARROW
        # weights of the lists: a query reads a dimension's one list or the other, or none where it weighs nothing
        w = np.concatenate([np.maximum(weights, 0), np.minimum(weights, 0)], 1)
        single = w.astype(np.float32) if narrow else w
        asks, lengths = (w != 0).sum(1), (weights**2).sum(1)
        error = 4 * (dims + 4) * 2.0**-24 if narrow else 1e-9
        slack = (abs(weights) @ self.magnitude + np.sqrt(lengths * self.squares.max(initial=0.0))) * error + 1e-6
        read, start = np.zeros(m, np.int64), int(START * n)
        fresh = np.flatnonzero(np.isneginf(known))
        if start and len(fresh):
            best = self._foremost(single[fresh], lengths[fresh], start, min(n, FIRST * k))
            pairs, scores = self._resolved(np.repeat(fresh, best.shape[1]), best.ravel(), own, queries)
            for q, few in _groups(pairs[0], scores):
                if len(few) >= k:
                    known[q] = sorted(few.tolist())[-k]
            read[fresh] = start
        open_, parts = np.arange(m), []
        since = np.zeros(m, np.int64) if since is None else since
        for at, share in enumerate(DEPTHS):
            depth = int(share * n)
            due = open_[since[open_] <= at] if depth else open_[:0]
            if not len(due):
                continue
            ahead = w[due] @ self.next(depth)
            over = ahead + slack[due] < known[due]  # no candidate that no list has shown can qualify
            due, ahead = due[over], ahead[over]
            if not len(due):
                continue
            need = known[due] - slack[due] - ahead
            need = np.nextafter(need.astype(single.dtype), single.dtype.type(-np.inf))
            may = single[due] @ self.read(depth) >= need[:, None]
            # as long as many can qualify, reading goes on
            few = np.count_nonzero(may, axis=1) <= (max(n // FEW, k) if share < DEPTHS[-1] else n)
            stopped = due[few]
            rows, cols = np.divmod(np.flatnonzero(may[few]), n)
            parts.append(self._qualified(stopped[rows], cols, own, queries, lengths, slack, known))
            read[stopped], since[stopped] = np.maximum(read[stopped], depth), at
            open_ = np.setdiff1d(open_, stopped, assume_unique=True)
        # lists read to their ends hold every score
        read[open_] = n
        parts += [self._qualified(np.full(n, q), np.arange(n), own, queries, lengths, slack, known) for q in open_.tolist()]
        self.entries += int(asks @ read)
        found: list[list[tuple[int, int]]] = [[] for _ in range(m)]
        for rows, cols, scores in parts:
            order = np.lexsort((self.ids[cols], rows))
            order = order[np.lexsort((-scores[order], rows[order]))] if scores.dtype != object else np.array(sorted(order.tolist(), key=lambda i: (rows[i], -scores[i])), np.int64)
            for q, some in _groups(rows[order], order):
                best = some[:k]
                found[q] = list(zip(scores[best].tolist(), self.ids[cols[best]].tolist(), strict=True))
                if len(best) >= k:
                    known[q] = max(known[q], found[q][k - 1][0])
        return found

    def _foremost(self, w, lengths, depth: int, count: int):
        """Of each query the ``count`` candidates with the best lower bounds after ``depth`` entries."""
        import numpy as np

        following, last = self.next(depth).astype(w.dtype), np.concatenate([self.rising[:, 0], self.rising[:, -1]]).astype(w.dtype)
        dims = len(self.columns)
        seen = np.concatenate([self.columns > following[:dims, None], self.columns < following[dims:, None]]).astype(w.dtype)
        both = seen * np.concatenate([self.columns, self.columns])
        # what the lists have yet to show: at least their last values, and no less than the remaining lengths allow
        low = (w @ last)[:, None] - (w * last) @ seen
        left = np.sqrt(np.maximum(self.squares - (w != 0).astype(w.dtype) @ (both * both), 0) * np.maximum(lengths[:, None] - (w * w) @ seen, 0))
        lower = w @ both + np.maximum(low, -left)
        return np.argpartition(-lower, count - 1, axis=1)[:, :count]

    def _qualified(self, rows, cols, own, queries, lengths, slack, known) -> tuple:
        """``rows, cols, scores`` of the pairs that reach what is known."""
        import numpy as np

        near = np.sqrt(lengths[rows] * self.squares[cols]) + slack[rows] >= known[rows]
        (rows, cols), scores = self._resolved(rows[near], cols[near], own, queries)
        # what is known is rounded where scores are no doubles
        reached = scores >= known[rows] if scores.dtype != object else np.ones(len(rows), bool)
        return rows[reached], cols[reached], scores[reached]

    def _resolved(self, rows, cols, own, queries) -> tuple:
        """Pairs of query and candidate without the query's own id, and their scores."""
        import numpy as np

        other = self.ids[cols] != own[rows]
        rows, cols = rows[other], cols[other]
        weights = queries.astype(float)
        if (np.abs(weights) @ self.magnitude < EXACT).all():
            scores = np.empty(len(rows), np.int64)
            for at in range(0, len(rows), PAIRS):
                some = slice(at, at + PAIRS)
                scores[some] = np.einsum("ij,ij->i", weights[rows[some]], self.rows[cols[some]])
            return (rows, cols), scores
        exact = np.empty(len(rows), object)
        for i, (q, c) in enumerate(zip(rows.tolist(), cols.tolist(), strict=True)):
            exact[i] = sum(a * b for a, b in zip(self.vecs[c].tolist(), queries[q].tolist(), strict=True))
        return (rows, cols), exact


def _groups(keys, values) -> Iterator[tuple]:
    """Each of the keys, of which equal ones stand together, with its values."""
    import numpy as np

    if len(keys):
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield from zip(keys[starts].tolist(), np.split(values, starts[1:]), strict=True)


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of ``vectors`` for each row of ``queries``.

    Components count as floor(scale * x); the score is the integer inner product, ties go to the
    smaller id. Ids that are null and vectors that are null or hold a null or non-finite component
    take no part, on either side; an empty vector has score 0 with the other empty ones. Rows that
    repeat an id are queries each, with ranks of their own, and candidates each, but not for one
    another. Queries meet vectors of their own length only. Fewer than k candidates give fewer rows;
    empty tables give none. Scores beyond 64 bits fail. Other columns play no part.
    """

    def clean(df: DataFrame, size: int) -> DataFrame:
        vector, kind = F.col(vector_column), df.schema[vector_column].dataType.elementType
        if not isinstance(kind, (FloatType, DoubleType)):
            vector = vector.cast("array<double>")
        own = df.select(F.col(id_column).cast("long").alias("id"), vector.alias("v")).where("id is not null")
        # no more partitions than full packs: small files would make small packs
        return own.coalesce(max(1, -(-own.select("id").count() // size)))

    shards, _ = materialize(packs(clean(vectors, SHARD_ROWS), SHARD_ROWS, scale), "topk-shards")
    blocks, _ = materialize(packs(clean(queries, BLOCK_ROWS), BLOCK_ROWS, scale), "topk-blocks")
    slots = max(1, shards.count())
    dealt = shards.withColumn("slot", F.pmod(F.xxhash64("name"), F.lit(slots)))
    own = [F.col(c).alias(f"q{c}") for c in ("name", "code", "ids", "vecs")]
    met = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"), "dim", *own)
    met = met.join(dealt, ["slot", "dim"]).select("dim", "qname", "qcode", "qids", "qvecs", "name", "code", "ids", "vecs")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        name, lists, known = None, None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                dim, qname, qcode, qids, qvecs, own, code = (batch.column(c)[i].as_py() for c in range(7))
                qids = np.frombuffer(qids, "<i8")
                if own != name:
                    ids, vecs = (batch.column(c)[i].as_py() for c in (7, 8))
                    ids = np.frombuffer(ids, "<i8")
                    name, lists = own, Lists(ids, np.frombuffer(vecs, code).reshape(len(ids), dim).astype(np.int64))
                if len(known) >= HELD_BLOCKS and qname not in known:
                    known.clear()  # bounds only: what is forgotten is found again
                # the k best scores so far, of all the task's shards
                best, since = known.setdefault(qname, (np.full((len(qids), k), -np.inf), np.zeros(len(qids), np.int64)))
                found = lists.search(qids, np.frombuffer(qvecs, qcode).reshape(len(qids), dim).astype(np.int64), k, best[:, 0].copy(), since)
                for at, one in enumerate(found):
                    if one:
                        best[at] = np.sort(np.concatenate([best[at], [score for score, _ in one]]))[-k:]
                rows = [(qname, at, int(qids[at]), vec_id, score) for at, one in enumerate(found) for score, vec_id in one]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["block", "at", "query_id", "vec_id", "score"])

    partial = met.mapInArrow(each, "block string, at int, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "at").orderBy(F.desc("score"), "vec_id"))
    return partial.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


TOPK_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) q from {vectors}
  where vec_id is not null and embedding is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (select a.vec_id query_id, b.vec_id vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::bigint score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::integer as rank, vec_id, score from r where rank <= 5
"""
