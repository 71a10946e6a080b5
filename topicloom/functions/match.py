"""Dictionary search over characters: longest match, from left to right, without overlap."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType


def automaton(terms: list[str]):
    """One automaton of all terms; None if there is none."""
    import ahocorasick

    a = ahocorasick.Automaton()
    for t in filter(None, terms):
        a.add_word(t, t)
    a.make_automaton()
    return a if len(a) else None


def leftmost_longest(a, text: str) -> list[str]:
    """The matches that a scan from the left takes, the longest at each place; one pass, whatever the dictionary's size."""
    longest: dict[int, str] = {}
    for end, term in a.iter(text):
        at = end - len(term) + 1
        if len(term) > len(longest.get(at, "")):
            longest[at] = term
    found, free = [], 0
    for at in sorted(longest):
        if at >= free:
            found.append(longest[at])
            free = at + len(longest[at])
    return found


def find_terms(text: Column, terms: list[str], engine: str = "leftmost") -> Column:
    """The matched terms of a text, in order, as an array; case-sensitive and blind to word edges.

    "leftmost" is leftmost-longest. "library" is the automaton library's own long iteration, which can drop matches.
    `terms` is a dictionary of bounded size that every task holds.
    """
    if engine not in ("leftmost", "library"):
        raise ValueError(engine)
    if not any(terms):
        return F.array().cast("array<string>")

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = automaton(terms)
        scan = leftmost_longest if engine == "leftmost" else lambda a, t: [m for _, m in a.iter_long(t)]
        for s in batches:
            yield s.map(lambda t: scan(a, t) if t else [])

    return F.pandas_udf(search, ArrayType(StringType()))(text)


def flatten_trie(trie: dict, leaf: str = "") -> Iterator[tuple[list[str], list[float]]]:
    """(tokens, vector) of every path of a nested dictionary that ends in a vector under the key `leaf`, in key order."""
    todo: list[tuple[list[str], dict]] = [([], trie)]
    while todo:
        path, node = todo.pop()
        if isinstance(node.get(leaf), list):
            yield path, node[leaf]
        todo.extend(([*path, k], node[k]) for k in sorted(node, reverse=True) if k != leaf)
