"""Quality rules as a short-circuit cascade.

Each rule rejects documents by a fact of their text. On a sample the cascade measures what a
rule costs and how much it rejects, then asks the rules in the order of rejection per cost;
a document's first rejection ends its evaluation. The order changes the cost and which rule is
named, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.text import gram_hashes, let, spare, total, words

REPEAT_WIDTH = 8
SYMBOLS = r"[^#*$%&|<>]+"
SAMPLE_ROWS = 2_000
FACTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _repeat_words(w: Column, n: Column) -> Column:
    """Words inside a window of eight that the text holds twice or more."""
    def covered(at: Column) -> Column:
        return total(F.transform(at, lambda p, j: F.least(
            F.lit(REPEAT_WIDTH), F.coalesce(F.get(at, j + 1) - p, F.lit(REPEAT_WIDTH)))))

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.coalesce(x.h == F.get(s, j).h, F.lit(False))
        found = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return let(F.sort_array(F.transform(found, lambda x: x.i)), covered)

    def count(hs: Column) -> Column:
        pairs = F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hs)) < F.size(hs),
                      let(F.sort_array(pairs), repeated)).otherwise(F.lit(0).cast("long"))

    return let(gram_hashes(w, n, REPEAT_WIDTH), count)


class Facts:
    """Facts of one text as columns, each worked out only where it is asked for."""

    def __init__(self, text: Column, w: Column, n: Column):
        self.n_words = n.cast("long")
        self.word_chars = F.length(F.array_join(w, "")).cast("long")
        self.n_symbols = F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")
        self.n_lines = F.size(_lines(text)).cast("long")
        self.n_dup_lines = let(_lines(text), lambda x: F.size(x) - F.size(
            F.array_distinct(x))).cast("long")
        self.n_repeat_words = _repeat_words(w, n)


class Known:
    """The same facts, read from a struct that holds all of them."""

    def __init__(self, s: Column):
        for name in FACTS:
            setattr(self, name, s[name])


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts | Known], Column]


BASE = (
    Rule("too_short", lambda f: f.n_words < 20),
    Rule("repeats_itself", lambda f: 100 * f.n_repeat_words > 30 * f.n_words),
)
RULES = BASE + (
    Rule("symbols", lambda f: f.n_symbols > f.n_words),
    Rule("short_words", lambda f: f.word_chars < 2 * f.n_words),
    Rule("long_words", lambda f: f.word_chars > 30 * f.n_words),
    Rule("repeated_lines", lambda f: 100 * f.n_dup_lines > 60 * f.n_lines),
)


def _of(text: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    t = F.coalesce(text, F.lit(""))
    return let(words(t), lambda w: let(F.size(w), lambda n: body(t, w, n)))


def facts(text: Column) -> Column:
    """All facts of a text as one struct; a null text counts as empty."""
    return _of(text, lambda t, w, n: F.struct(
        *(getattr(Facts(t, w, n), c).alias(c) for c in FACTS)))


def _first_rejection(f: Facts | Known, rules) -> Column:
    out = F.when(F.lit(False), F.lit("").cast("string"))
    for r in rules:
        out = out.when(r.rejects(f), F.lit(r.name))
    return out


def rank(docs: DataFrame, text: str = "text", rules=RULES, sample_rows: int = SAMPLE_ROWS,
         seed: int = 7) -> list[Rule]:
    """Rules by rejection per cost, both measured on about ``sample_rows`` documents.

    The sample sets only the order of the rules. Rules without a rejection in the sample
    come last, the cheapest first; an empty table keeps the given order.
    """
    rows = docs.select(F.lit(1)).count()
    if rows == 0:
        return list(rules)
    sample = docs.select(F.col(text).alias("t")).sample(min(1.0, sample_rows / rows), seed)
    sample = sample.persist()

    def measure(reject: Callable[[Facts], Column]) -> tuple[int, float]:
        one = _of(F.col("t"), lambda t, w, n: reject(Facts(t, w, n)).cast("int"))
        began = time.perf_counter()
        hits = sample.select(F.sum(one)).first()[0] or 0
        return hits, time.perf_counter() - began

    try:
        measure(lambda f: f.n_words < 0)
        floor = measure(lambda f: f.n_words < 0)[1]
        found = []
        for r in rules:
            hits, took = measure(r.rejects)
            cost = max(took - floor, 1e-4)
            found.append((-hits / cost, cost, r))
    finally:
        sample.unpersist()
    return [r for _, _, r in sorted(found, key=lambda x: x[:2])]


def judge(docs: DataFrame, text: str = "text", rules=RULES, with_facts: bool = False,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with ``kept`` and ``rejected_by``, and with all facts if asked for.

    Every row gets a verdict from its whole text; null and empty texts have no words and fall
    to ``too_short``. Repeated rows are judged alike. Columns of ``docs`` that bear a name of
    the result are replaced. An empty table gives an empty result.
    """
    order = rank(docs, text, rules, sample_rows)
    if with_facts:
        at = spare(docs, "facts")
        docs = docs.withColumn(at, facts(F.col(text)))
        known = Known(F.col(at))
        first = _first_rejection(known, order)
        more = {c: F.col(at)[c] for c in FACTS}
    else:
        at = None
        first = _of(F.col(text), lambda t, w, n: _first_rejection(Facts(t, w, n), order))
        more = {}
    out = docs.withColumns({"rejected_by": first, **more})
    out = out.withColumn("kept", F.col("rejected_by").isNull())
    return out.drop(at) if at else out


def keep(docs: DataFrame, text: str = "text", rules=RULES,
         sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents no rule rejects, with their columns as they were."""
    order = rank(docs, text, rules, sample_rows)
    first = _of(F.col(text), lambda t, w, n: _first_rejection(Facts(t, w, n), order))
    return docs.filter(first.isNull())
