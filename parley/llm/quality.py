"""Quality classifier: regularised quadratic discriminant analysis of transformed document statistics.

Each class has a mean and a covariance that is shrunk towards the pooled one and towards its own
diagonal. A text's score comes from the difference of the two log densities, each a Mahalanobis
distance by the class's Cholesky factor, which is computed once and sent with the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from parley.llm.common import held, unpacked

#: Statistics of a text, in the order of a feature vector.
STATISTICS = (
    "bytes", "words", "lines", "mean_word", "word_spread", "distinct_words", "top_word", "repeated_words", "upper", "digits",
    "punctuation", "symbols", "blanks", "beyond_ascii", "capital_words", "marked_words", "entropy", "short_lines",
)
#: Shares of the pooled covariance and of the own diagonal in a class's covariance, and the least variance.
POOLED, DIAGONAL, RIDGE = 0.10, 0.05, 1e-3
#: Log density difference that moves the score's odds by one e-fold.
SOFTEN = 6.0
SMALL = 1e-3


def statistics(text: bytes):
    """The transformed statistics of one whole text; an empty one has well-defined values too."""
    import math
    from collections import Counter

    import numpy as np

    n = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    words, lines = text.split(), text.split(b"\n")
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    w, m = len(words), max(len(words), 1)
    tally = Counter(words)
    top = max(tally.values(), default=0)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    capital = sum(1 for x in words if len(x) > 1 and x.isupper())
    marked = sum(1 for x in words if x[-1:] in b"*#$%&!|~^=<>@")
    share = lambda these: float(counts[list(these)].sum()) / max(n, 1)
    some = counts[counts > 0] / max(n, 1)
    log = lambda x: math.log(x + SMALL)
    return [
        math.log1p(n),
        math.log1p(w),
        math.log1p(len(lines)),
        math.log1p(float(lengths.mean()) if w else 0.0),
        math.log1p(float(lengths.std()) if w else 0.0),
        log(len(tally) / m),
        log(top / m),
        log(again / m),
        log(share(range(65, 91))),
        log(share(range(48, 58))),
        log(share(b".,;:'\"()-?")),
        log(share(b"*#$%&!|~^=<>@_+/\\[]{}`")),
        log(share(b" \t\n\r\x0b\x0c")),
        log(share(range(128, 256))),
        log(capital / m),
        log(marked / m),
        float(-(some * np.log2(some)).sum()),
        log(sum(1 for x in lines if len(x) < 40) / len(lines)),
    ]


def features(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``features``; null texts count as empty.

    Every row has its own vector, also one that repeats another; equal texts have equal ones. A column
    ``features`` is replaced, others may have any names. An empty table gives an empty result.
    """
    kept = [c for c in docs.columns if c.lower() not in ("text", "features")]
    rows = docs.select(F.col("text").cast("binary").alias("text"), held(docs, kept).alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py() or b"") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, pa.list_(pa.float64()))], ["doc", "features"])

    out = rows.mapInArrow(run, rows.select("doc").schema.add("features", ArrayType(DoubleType())))
    return out.select(*unpacked("doc", kept), "features")


@dataclass
class Discriminant:
    """Means, inverses of the Cholesky factors, and constants (prior and determinant) of the classes 0 and 1."""

    means: list
    factors: list
    constants: list

    def scores(self, x):
        """Of an array of feature vectors: numbers in (0, 1), higher for class 1."""
        import numpy as np

        if not self.means:
            return np.full(len(x), 0.5)
        logs = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1.0 / (1.0 + np.exp(-np.clip((logs[1] - logs[0]) / SOFTEN, -36.0, 36.0)))


def fit(labelled: DataFrame) -> Discriminant:
    """From rows ``features, label``; labels other than 0 and 1 are left out. All rows count: each task sends the moments of its rows only.

    Without rows of both classes the model scores everything 0.5.
    """
    import numpy as np

    size = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + size, 1 + size))
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(-1, size)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                one = np.hstack([np.ones(((y == c).sum(), 1)), x[y == c]])
                total[c] += one.T @ one
        at = np.flatnonzero(total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total.ravel()[at])], ["at", "value"])

    rows = labelled.where("label in (0, 1) and features is not null").select("features", F.col("label").cast("int").alias("label"))
    moments = np.zeros(2 * (1 + size) ** 2)
    for r in rows.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        moments[r["at"]] = r["value"]
    moments = moments.reshape(2, 1 + size, 1 + size)
    counts = moments[:, 0, 0]
    if (counts < 1).any():
        return Discriminant([], [], [])
    means = [m[0, 1:] / m[0, 0] for m in moments]
    spreads = [m[1:, 1:] / m[0, 0] - np.outer(u, u) for m, u in zip(moments, means, strict=True)]
    pooled = sum(n * s for n, s in zip(counts, spreads, strict=True)) / counts.sum()
    factors, constants = [], []
    for n, s in zip(counts, spreads, strict=True):
        mixed = (1 - POOLED - DIAGONAL) * s + POOLED * pooled + DIAGONAL * np.diag(np.diag(s))
        lower = np.linalg.cholesky(mixed + RIDGE * np.eye(size))
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(n / counts.sum()) - np.log(np.diag(lower)).sum()))
    return Discriminant(means, factors, constants)


def score(found: DataFrame, model: Discriminant) -> DataFrame:
    """Rows of ``features`` with ``score`` and ``predicted`` (1 from a score of 0.5) in place of the vector.

    Columns of these names are replaced, others may have any names. Equal vectors have equal scores; a
    model without both classes gives 0.5. Repeated rows stay, and an empty table gives an empty result.
    """
    kept = [c for c in found.columns if c.lower() not in ("features", "score", "predicted")]
    rows = found.select("features", held(found, kept).alias("doc"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            s = model.scores(np.array(batch.column(0).to_pylist(), float).reshape(-1, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc", "score", "predicted"])

    out = rows.mapInArrow(run, rows.select("doc").schema.add("score", "double").add("predicted", "integer"))
    return out.select(*unpacked("doc", kept), "score", "predicted")
