"""Dataset specifications, '[hub::]path[:subset/subset][#sample]', and the registry that resolves them."""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

HUBS = ("hf", "ms")


@dataclass(frozen=True)
class Spec:
    """A parsed specification. ``hub`` is None for the default hub, or for a path on disk."""

    path: str
    subsets: tuple[str, ...] = ()
    sample: int | None = None
    hub: str | None = None

    @classmethod
    def parse(cls, text: str, exists: Callable[[str], bool] = os.path.exists) -> Spec:
        """An existing path wins over every mark in it; then '#' is looked for from the right, ':' from the left."""
        hub, rest = None, text
        for name in HUBS:
            if rest.startswith(f"{name}::"):
                hub, rest = name, rest[len(name) + 2 :]
        if exists(rest):
            return cls(rest, hub=hub)
        sample = None
        head, mark, tail = rest.rpartition("#")
        if mark:
            rest, sample = head, int(tail)
        subsets: tuple[str, ...] = ()
        if not exists(rest):
            scheme, there, inner = rest.rpartition("://")  # a scheme's colon is none of ours
            rest, mark, tail = inner.partition(":")
            rest = scheme + there + rest
            subsets = tuple(s.strip() for s in tail.split("/")) if mark else ()
        return cls(rest.strip(), subsets, sample, hub)


@dataclass
class Subset:
    """A part of a dataset; a weak one is not among all."""

    name: str = "default"
    subset: str | None = None
    split: tuple[str, ...] = ("train",)
    preprocess: Callable[[DataFrame], DataFrame] | None = None
    is_weak: bool = False


@dataclass
class Dataset:
    """What is known of a dataset: where it is, its parts, and how its rows become conversations."""

    path: str | None = None
    hub_ids: dict[str, str] = field(default_factory=dict)
    subsets: list[Subset] = field(default_factory=lambda: [Subset()])
    split: tuple[str, ...] = ("train",)
    columns: dict[str, str] = field(default_factory=dict)
    preprocess: Callable[[DataFrame], DataFrame] | None = None

    def select(self, names: tuple[str, ...]) -> list[Subset]:
        """No name: the only part, or that called default. 'all': every part that is not weak. A name unknown here is a part of its own."""
        known = {s.name: s for s in self.subsets}
        if not names:
            if len(known) == 1:
                return list(known.values())
            if "default" not in known:
                raise ValueError(f"name a subset: {sorted(known)}")
            return [known["default"]]
        if names == ("all",) and "all" not in known:
            return [s for s in self.subsets if not s.is_weak]
        return [known.get(n) or Subset(n, n, self.split, self.preprocess) for n in names]


class Registry:
    """Datasets by name, path or hub id."""

    def __init__(self) -> None:
        self.datasets: dict[str, Dataset] = {}

    def register(self, name: str, dataset: Dataset, exist_ok: bool = False) -> None:
        if name in self.datasets and not exist_ok:
            raise ValueError(f"{name!r} is registered already")
        self.datasets[name] = dataset

    def register_json(self, source: str) -> list[str]:
        """Entries of a JSON file, or of a JSON text: a list of objects with dataset_path or hub ids, columns, subsets, split."""
        base = None
        if os.path.exists(source):
            base = os.path.dirname(os.path.abspath(source))
            with open(source, encoding="utf-8") as f:
                entries = json.load(f)
        else:
            entries = json.loads(source)
        names = []
        for e in entries if isinstance(entries, list) else [entries]:
            path = e.get("dataset_path")
            if path and base and not os.path.isabs(path):
                path = os.path.join(base, path)
            hub_ids = {h: e[k] for h, k in (("hf", "hf_dataset_id"), ("ms", "ms_dataset_id")) if e.get(k)}
            subsets = [Subset(s, s) if isinstance(s, str) else Subset(s.get("name", "default"), s.get("subset"), tuple(s.get("split", ("train",)))) for s in e.get("subsets", [])]
            name = e.get("dataset_name") or path or next(iter(hub_ids.values()))
            self.register(name, Dataset(path, hub_ids, subsets or [Subset()], tuple(e.get("split", ("train",))), e.get("columns", {})), exist_ok=True)
            names.append(name)
        return names

    def resolve(self, spec: Spec) -> Dataset:
        """By name, path or hub id, then by the last part of a path or id; else a dataset of defaults."""
        if spec.path in self.datasets:
            return self.datasets[spec.path]
        for d in self.datasets.values():
            if spec.path == d.path or spec.path in d.hub_ids.values():
                return d
        last = os.path.basename(spec.path.rstrip("/"))
        for name, d in self.datasets.items():
            if last in {os.path.basename(x.rstrip("/")) for x in (name, d.path or "", *d.hub_ids.values()) if x}:
                return d
        return Dataset(path=spec.path)
