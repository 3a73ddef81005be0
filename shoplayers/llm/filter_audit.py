"""Audit of how filters interact: what each removes in every order they could be applied in.

The states of a cascade are the sets of filters already applied, a lattice of 2^n subsets; applying one more
filter is an edge. What an edge removes depends on its state alone and not on the order inside it, so all
n! orders together have only n * 2^(n-1) different steps. Documents become bit sets of the filters they
fail, counted per part and bit set; the edges are sums over these counts.

Counting paths forward (orders that reach a state) and backward (orders that lead on from it) gives the number of
orders that use an edge. An edge's removals times that number, summed over the edges of a filter, is what the
filter removes over all orders: its Shapley value times n!. Every step of every order reads its numbers from its
edge.

Texts are read once, for the row-wise filters and a digest; only ids, parts, bit sets and digests move after that.
The filter on earlier copies is table-wide: the smallest id of every digest is found with combining before the
shuffle, and brought back to the digests that several rows share in pieces where one digest holds many rows. Counts
combine before their shuffle too, so a part of any size sends 2^n rows a task. What is computed per part has a
fixed size.

Defined results: a NULL text is empty, a NULL part the empty string. An empty text has no words: it is short, and
neither repetitive nor loud. Copies with the same id, and rows without id, are not earlier copies of each other; a
row without id has no earlier copy. Several labels of an id count if any of them says so, labels without id never. Very long
texts take a pass of JVM functions each. Repeated rows count as often as they come. An empty table gives an empty
result. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, functions as F

from shoplayers.functions.skew import join_counted_lookup
from shoplayers.llm.common import WORD
from shoplayers.session import durable

# --- Fixed values: the filters of the registered query ----------------------------------------------
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
SIGNS = "[#$%&*|]"
LETTERS = "ABCDE"
COPIES = "E"  # the filter that looks at the whole table


def text_failures(text: Column) -> dict[str, Column]:
    """The row-wise filters' failure conditions: few words, few distinct words, many capitals, signs."""
    content = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(content, F.lit(WORD), F.lit(0))
    # Both word counts from one list: 0 few words, 1 few distinct ones.
    few = F.get(
        F.transform(
            F.array(words),
            lambda w: F.struct(
                (F.size(w) < MIN_WORDS).alias("a"),
                (100 * F.size(F.array_distinct(w)) < MIN_DISTINCT_PERCENT * F.size(w)).alias("b"),
            ),
        ),
        F.lit(0),
    )
    capitals = F.regexp_count(content, F.lit("[A-Z]"))
    return {
        "A": few["a"],
        "B": few["b"],
        "C": 100 * capitals > MAX_CAPITAL_PERCENT * F.length(content),
        "D": content.rlike(SIGNS),
    }


def failure_sets(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(id, part, failed, docs): `failed` has bit i set where filter LETTERS[i] fails, `docs` counts equal rows."""
    conditions = text_failures(F.col(text_col))
    bits = F.lit(0)
    for letter, fails in conditions.items():
        bits = bits + F.when(fails, F.lit(1 << LETTERS.index(letter))).otherwise(F.lit(0))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        bits.cast("int").alias("failed"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"),
    )
    # Equal rows become one with their number, so rows without id cannot crowd a task either.
    rows = durable(rows.groupBy("id", "part", "failed", "digest").agg(F.count(F.lit(1)).alias("docs")))
    first = rows.groupBy("digest").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("rows"))
    shared = first.filter("rows > 1 AND first_id IS NOT NULL")
    joined = join_counted_lookup(rows, shared, "digest", "rows", "id")
    copy = F.when(F.col("id") > F.col("first_id"), F.lit(1 << LETTERS.index(COPIES))).otherwise(F.lit(0))
    return joined.select("id", "part", (F.col("failed") + copy).cast("int").alias("failed"), "docs")


def counts_per_set(failures: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, failed, docs, good, toxic): documents per part and set of failed filters, with labelled ones."""
    flags = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("is_good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("is_toxic"),
    )
    flags = flags.filter("is_good = 1 OR is_toxic = 1")
    known = failures.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).join(flags, "id")
    marked = join_counted_lookup(failures.withColumn("spread", F.xxhash64("part", "failed")), known, "id", "rows", "spread")
    return marked.groupBy("part", "failed").agg(
        F.sum("docs").alias("docs"),
        F.coalesce(F.sum(F.col("is_good") * F.col("docs")), F.lit(0)).alias("good"),
        F.coalesce(F.sum(F.col("is_toxic") * F.col("docs")), F.lit(0)).alias("toxic"),
    )


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """Orders that reach every subset from the empty one, and orders that lead from it to the full one."""
    states = 1 << filters
    forward, backward = [0] * states, [0] * states
    forward[0] = backward[-1] = 1
    for state in range(states):  # every subset comes after those it contains
        for f in range(filters):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def _numbers(values: Sequence[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def orders_of(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order and step, from counts per part and set of failed filters."""
    n = len(letters)
    forward, backward = path_counts(n)
    edges = [(state, f) for state in range(1 << n) for f in range(n) if not state >> f & 1]
    place = {edge: i for i, edge in enumerate(edges)}
    lattice = F.array(
        *[
            F.struct(
                F.lit(state).alias("state"),
                F.lit(1 << f).alias("bit"),
                F.lit(f).alias("f"),
                F.lit(forward[state] * backward[state | 1 << f]).cast("long").alias("paths"),
            )
            for state, f in edges
        ]
    )
    # At most 2^n sets a part, whatever its size.
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "docs", "good", "toxic")).alias("sets"))

    def total(condition, field: str) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda sum_, s: sum_ + F.when(condition(s), s[field]).otherwise(0))

    def measured(edge: Column) -> Column:
        def hit(s: Column) -> Column:
            return s["failed"].bitwiseAND(edge["bit"]) != 0

        def alive(s: Column) -> Column:
            return s["failed"].bitwiseAND(edge["state"]) == 0

        return F.struct(
            edge["f"].alias("f"),
            edge["paths"].alias("paths"),
            total(lambda s: alive(s) & ~hit(s), "docs").alias("kept"),
            total(lambda s: alive(s) & hit(s), "docs").alias("removed"),
            total(lambda s: ~alive(s) & hit(s), "docs").alias("redundant"),
            total(lambda s: s["failed"] == edge["bit"], "docs").alias("unique_fails"),
            total(lambda s: alive(s) & hit(s), "good").alias("good_lost"),
            total(lambda s: alive(s) & hit(s), "toxic").alias("toxic_lost"),
        )

    walked = parts.select("part", F.transform(lattice, measured).alias("edges"))

    def over_all_orders(f: int) -> Column:
        return F.aggregate(
            "edges",
            F.lit(0).cast("long"),
            lambda sum_, e: sum_ + F.when(e["f"] == f, e["paths"] * e["removed"]).otherwise(0),
        )

    walked = walked.withColumn("shapley", F.array(*[over_all_orders(f) for f in range(n)]))
    steps = []
    for order in permutations(range(n)):
        state = 0
        for step, f in enumerate(order):
            steps.append(("".join(letters[x] for x in order), step + 1, f, place[state, f]))
            state |= 1 << f
    names, numbers, filters, places = zip(*steps)
    table = F.arrays_zip(
        F.lit(list(names)).alias("filter_order"),
        F.lit(list(numbers)).alias("step"),
        F.lit(list(filters)).alias("f"),
        F.lit(list(places)).alias("edge"),
    )
    rows = walked.select("part", "edges", "shapley", F.explode(table).alias("s"))
    edge = F.get("edges", F.col("s.edge"))
    return rows.select(
        "part",
        F.col("s.filter_order").alias("filter_order"),
        F.col("s.step").alias("step"),
        *[edge[name].alias(name) for name in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")],
        F.get("shapley", F.col("s.f")).alias("shapley"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """One row per part, order of the five filters and step: kept, removed, redundant, unique_fails,
    good_lost, toxic_lost and shapley. `labels` has the id, quality and toxic."""
    failures = durable(failure_sets(docs, id_col, text_col, part_col))
    return orders_of(durable(counts_per_set(failures, labels, id_col)))
