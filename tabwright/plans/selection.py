"""Driver-side algebra on component names: which sources run, and in which order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from graphlib import TopologicalSorter


def select_components(known: Iterable[str], include: Iterable[str] = (), exclude: Iterable[str] = ()) -> set[str]:
    """All but the excluded ones, or the included ones; both, or unknown names, raise."""
    known, include, exclude = set(known), set(include), set(exclude)
    if include and exclude:
        raise ValueError("either include or exclude")
    if unknown := (include | exclude) - known:
        raise ValueError(f"unknown components: {sorted(unknown)}")
    return include or known - exclude


def with_dependencies(wanted: Iterable[str], dependencies: Mapping[str, Iterable[str]]) -> set[str]:
    """The names and all that they need, however deep; cycles end."""
    found, todo = set(), list(wanted)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += dependencies.get(name, ())
    return found


def excluded_but_needed(wanted: Iterable[str], exclude: Iterable[str], dependencies: Mapping[str, Iterable[str]]) -> set[str]:
    return with_dependencies(wanted, dependencies) & set(exclude)


def run_order(names: Iterable[str], dependencies: Mapping[str, Iterable[str]]) -> list[list[str]]:
    """Waves of names that can run side by side; a cycle raises."""
    names = set(names)
    graph = TopologicalSorter({n: [d for d in dependencies.get(n, ()) if d in names] for n in sorted(names)})
    graph.prepare()
    waves = []
    while graph.is_active():
        ready = sorted(graph.get_ready())
        waves.append(ready)
        graph.done(*ready)
    return waves
