"""Token sequences as arrays: labels, truncation, packing and padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.functions.bind import bound

#: Fixed value: the label of a token that is not trained on.
IGNORE = -100


def labels(ids: Column, weights: Column) -> Column:
    """The ids where their weight is above 0, else IGNORE; the first token is never trained on."""
    out = F.zip_with(ids, weights, lambda i, w: F.when(w > 0, i).otherwise(F.lit(IGNORE)))
    return masked_first(out)


def masked_first(values: Column, mask: int = IGNORE) -> Column:
    """The array with its first element masked."""
    return F.transform(values, lambda v, i: F.when(i == 0, F.lit(mask)).otherwise(v))


def length(*arrays: Column) -> Column:
    """The longest array's size; null counts as 0."""
    sizes = [F.coalesce(F.size(a), F.lit(0)) for a in arrays]
    return F.greatest(*sizes) if len(sizes) > 1 else sizes[0]


def truncated(ids: Column, size: int, protected: Column | None = None, side: str = "right") -> Column:
    """At most ``size`` ids: protected ones stay, of the others those farthest from the cut-off ``side``."""
    if protected is None:
        return F.slice(ids, F.lit(1), F.lit(size)) if side == "right" else F.slice(ids, F.greatest(F.size(ids) - size + 1, F.lit(1)), F.lit(size))

    def of(held: Column) -> Column:
        kept = F.size(F.filter(held, lambda i: F.array_contains(protected, i)))
        room = F.greatest(F.lit(size) - kept, F.lit(0))
        spots = F.filter(F.transform(held, lambda i, k: F.when(F.array_contains(protected, i), F.lit(-1)).otherwise(k)), lambda k: k >= 0)
        stay = bound(spots, lambda s: F.slice(s, F.lit(1), room) if side == "right" else F.slice(s, F.greatest(F.size(s) - room + 1, F.lit(1)), room))
        return bound(stay, lambda s: F.filter(held, lambda i, k: F.array_contains(protected, i) | F.array_contains(s, k)))

    return bound(ids, of)


def positions(lengths: Column) -> Column:
    """Position ids of packed sequences: each counts from 0."""
    return F.flatten(F.transform(lengths, lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))))


def padded(values: Column, size: Column, pad: Column, side: str = "right") -> Column:
    """The array filled up to ``size`` with ``pad``."""
    fill = F.array_repeat(pad, F.greatest(size - F.size(values), F.lit(0)))
    return F.concat(values, fill) if side == "right" else F.concat(fill, values)


def multi_hot(classes: Column, n: int) -> Column:
    """1.0 at each class, 0.0 elsewhere."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array_contains(classes, i).cast("double"))


def one_hot_classes(values: Column) -> Column:
    """Indices of the elements equal to 1."""
    return F.filter(F.transform(values, lambda v, i: F.when(v == 1, i).otherwise(F.lit(-1))), lambda i: i >= 0)


def media_tags(text: Column, tag: str, wanted: Column) -> Column:
    """The text led by as many tags as it lacks of those wanted."""
    missing = F.greatest(wanted - F.regexp_count(text, F.lit(tag)), F.lit(0))
    return F.concat(F.repeat(F.lit(tag), missing), text)


def scaled_box(box: Column, width: Column, height: Column, kind: str = "real") -> Column:
    """Corners in thousandths of the image's sides, rounded half to even; ``kind`` is ``real`` (pixels) or ``norm1``."""
    side = lambda i: F.when(i % 2 == 0, width).otherwise(height) if kind == "real" else F.lit(1.0)
    return F.transform(box, lambda v, i: F.bround(v / side(i) * 1000).cast("int"))
