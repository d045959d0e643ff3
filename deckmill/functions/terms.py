"""Term lists of thousands of entries: one automaton, one pass over each text.

``text.keyword_hits`` writes one ``contains`` per term into the query, which suits dozens of terms. Here the list becomes an
Aho-Corasick automaton, built once per task, and texts travel to it in Arrow batches; the cost of a text hardly depends on
the number of terms. Hits are the same: every term that is contained anywhere, in code-point order, each once. A null text
has null hits; empty terms are left out; without terms nothing hits.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many terms, expressions in generated code are the cheaper form.
FEW_TERMS = 256


def _scan(terms: Sequence[str]):
    """Function from a batch of texts to the sorted hits of each."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term in terms:
        automaton.add_word(term, term)
    automaton.make_automaton()

    def run(texts: pa.Array) -> pa.Array:
        hits = [None if t is None else sorted({term for _, term in automaton.iter(t)}) for t in texts.to_pylist()]
        return pa.array(hits, pa.list_(pa.string()))
    return run


def term_hits(lowered: Column, terms: Sequence[str]) -> Column:
    """Terms contained in an already lower-cased text, sorted."""
    wanted = sorted({t for t in terms if t})
    if not wanted:
        return F.when(lowered.isNotNull(), F.array().cast("array<string>"))
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    made: list = []

    def run(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_scan(wanted))
        return made[0](texts)
    return F.arrow_udf(run, "array<string>")(lowered)


def contains_any_term(lowered: Column, terms: Sequence[str]) -> Column:
    return F.size(term_hits(lowered, terms)) > 0
