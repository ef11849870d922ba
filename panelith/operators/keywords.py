"""Many keywords in one pass over each text: an automaton (a trie with failure links) in Arrow batches.

``instr`` looks through the text once for every keyword, which suits a handful.  The automaton looks through it once for
all of them, so its time does not grow with their number.  Only the text goes to Python; all other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FEW = 32  # keywords up to which ``instr`` is used


def by_instr(text: Column, words: Sequence[str]) -> Column:
    """Places (from 0, ascending) of the words found in ``text``."""
    return F.array_compact(F.array(*[F.when(F.instr(text, w) > 0, F.lit(i)) for i, w in enumerate(words)], F.lit(None).cast("int")))


def by_automaton(text: Column, words: Sequence[str]) -> Column:
    """As ``by_instr``: one pass over the text, whatever the number of words.  An empty word is in every text."""
    listed = [w for w in words]

    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import ahocorasick

        machine, same, always = ahocorasick.Automaton(), {}, []
        for i, w in enumerate(listed):
            (same.setdefault(w, []) if w else always).append(i)
        for w, places in same.items():
            machine.add_word(w, places[0])
        more = {places[0]: places[1:] for places in same.values() if len(places) > 1}  # words that stand in the list again
        if same:
            machine.make_automaton()
        for texts in batches:
            flat, ends = [], [0]
            for t in texts.to_pylist():
                hit = {place for _, place in machine.iter(t)} if t and same else set()
                for place in more.keys() & hit:
                    hit.update(more[place])
                if t is not None:
                    hit.update(always)
                flat += sorted(hit)
                ends.append(len(flat))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))

    # Called nondeterministic, so that a filter on what it finds stays behind it; else the planner searches all texts once more for the filter.
    return F.arrow_udf(search, "array<int>").asNondeterministic()(text)


def found(text: Column, words: Sequence[str], few: int = FEW) -> Column:
    if not words:
        return F.array().cast("array<int>")
    return by_instr(text, words) if len(words) <= few else by_automaton(text, words)
