"""What a chain of filters removes in every order: one table of failing ids per filter, joined with each other.

A filter is a column that says whether a row fails. The rows that fail are written once, a folder of ids per filter; rows
that fail nothing are only counted. Which failing rows still stand after a set of earlier filters does not depend on
their order, so a lattice of sets is walked, a level per number of earlier filters: a left-anti join with the id table of
the next earlier filter leaves what that prefix lets through, a left-semi join what it has removed already. Every
order is put together from these counts. Both sides of these joins grow with the documents, so they are merged: files of ids are a few
bytes a row, and Spark would still broadcast them, through the driver, at many times that size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.common import prepare
from shoptrail.session import fresh_path, materialize

_GAP = r"[\x20\x09-\x0D]+"
# A digest with more than this share of the rows is matched by a broadcast; there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000
LABEL_SALTS = 8
MOST_FILTERS = 6


def _words() -> Column:
    return F.array_remove(F.split("text", _GAP), "")


def text_filters() -> dict[str, Column]:
    """Filters of single texts (column ``text``, not null): the condition under which a row fails."""
    words = F.size("words")
    return {
        "A": words < 50,
        "B": F.size(F.array_distinct("words")) * 100 < words * 65,
        "C": F.char_length(F.regexp_replace("text", "[^A-Z]+", "")) * 100 > F.char_length("text") * 5,
        "D": F.col("text").rlike(r"[#$%&*|]"),
    }


def later_copies(rows: DataFrame, digest: str = "digest") -> DataFrame:
    """The rows whose digest also occurs with a smaller doc_id; a null id is neither smaller nor larger.

    Digests are counted by partial aggregation. Those of a large share of the rows, at most ``HOT_SHARE``, meet their rows in a
    broadcast join; only the others are shuffled to their rows.
    """
    firsts = rows.groupBy(digest).agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    firsts = materialize(firsts.filter("copies > 1"), "copied-digests")
    many = rows.count() / HOT_SHARE
    hot = firsts.filter(F.col("copies") > many)
    hot_rows = rows.join(F.broadcast(hot), digest)
    other = rows.join(F.broadcast(hot.select(digest)), digest, "left_anti")
    both = hot_rows.unionByName(other.join(firsts.filter(F.col("copies") <= many).hint("merge"), digest))
    return both.filter(F.col("doc_id") > F.col("first")).drop("first", "copies")


def failing_ids(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column], copies: str | None) -> tuple[DataFrame, DataFrame]:
    """(part, docs) with the number of rows per part, and the failing rows: filter, rid, part, good, toxic.

    The second table is stored with one folder of ids per filter. ``rid`` numbers rows, so ids may repeat or be null.
    """
    spark = prepare(docs.sparkSession)
    base = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    verdicts = F.array_compact(F.array(*[F.when(failed, F.lit(name)) for name, failed in filters.items()]))
    signals = base.withColumn("words", _words()).select(
        "rid", "doc_id", "part", verdicts.alias("failed"), F.unhex(F.sha2("text", 256)).alias("digest"))
    signals = materialize(signals, "filter-signals")
    rows = signals.select(F.explode("failed").alias("filter"), "rid", "doc_id", "part")
    if copies:
        again = later_copies(signals.select("rid", "doc_id", "part", "digest"))
        rows = rows.unionByName(again.select(F.lit(copies).alias("filter"), "rid", "doc_id", "part"))
    flags = [F.max((F.col(c) == 1).cast("int")).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy("doc_id").agg(*flags)
    known = known.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(LABEL_SALTS - 1).cast("bigint"))))
    # a null id finds no label, and must not bring all of its rows to one task; nor must an id that many rows repeat
    salt = F.when(F.col("doc_id").isNull(), -1 - F.col("rid")).otherwise(F.col("rid") % LABEL_SALTS)
    told = rows.withColumn("salt", salt).join(known.hint("merge"), ["doc_id", "salt"], "left")
    told = told.select("filter", "rid", "part", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("good", "toxic")])
    path = fresh_path(spark, "failing")
    told.write.partitionBy("filter").parquet(path)
    # with its schema given, a folder without any failing row reads as an empty table
    stored = spark.read.schema("rid bigint, part string, good int, toxic int, filter string").parquet(path)
    return signals.groupBy("part").agg(F.count("*").alias("docs")), stored


def _after(names: list[str]) -> Column:
    """The filters that may be added to a set: later than its last, and not the row's own."""
    last, own = F.col("last"), F.col("own")
    return F.array_compact(F.array(*[F.when((F.lit(i) > last) & (own != i), F.lit(i)) for i in range(len(names))]))


def lattice(failing: DataFrame, names: list[str]) -> DataFrame:
    """(part, own, mask, kind, n, good, toxic): the rows that fail filter ``own`` and, for kind 0, none of the filters
    in ``mask``; for kind 1, none of ``mask`` but its last.
    """
    number = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    ids = failing.select(number[F.col("filter")].alias("added"), "rid").hint("merge")
    level = failing.select(
        number[F.col("filter")].alias("own"), F.lit(0).alias("mask"), F.lit(-1).alias("last"), "rid", "part", "good", "toxic")
    counted = []

    def count(rows: DataFrame, kind: int) -> None:
        counted.append(rows.groupBy("part", "own", "mask").agg(
            F.lit(kind).alias("kind"), F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")))

    count(level, 0)
    for size in range(1, len(names)):
        asked = level.withColumn("added", F.explode(_after(names)))
        wider = F.expr("mask | shiftleft(1, added)")
        columns = ["own", wider.alias("mask"), F.col("added").alias("last"), "rid", "part", "good", "toxic"]
        removed = asked.join(ids, ["added", "rid"], "left_semi").select(*columns)
        count(removed, 1)
        level = materialize(asked.join(ids, ["added", "rid"], "left_anti").select(*columns), f"standing-{size}")
        count(level, 0)
    whole = counted[0]
    for more in counted[1:]:
        whole = whole.union(more)
    return whole


def _steps(names: list[str]) -> Column:
    """All orders and their steps, with the lattice cells each needs: an array built on the driver, its size set by the filters."""
    cells = []
    for chosen in permutations(range(len(names))):
        mask, path = 0, []
        for step, own in enumerate(chosen, 1):
            path.append((own, mask))
            members = [i for i in range(len(names)) if mask >> i & 1]
            chain = [sum(1 << i for i in members[: k + 1]) for k in range(len(members))]
            cells.append(("".join(names[i] for i in chosen), step, own, path[:], [(own, m) for m in chain]))
            mask |= 1 << own
    key = lambda own, mask: own << 8 | mask
    listed = ", ".join(
        f"named_struct('filter_order', '{order}', 'step', {step}, 'own', {own}, 'path', array({', '.join(str(key(*c)) for c in path)}), "
        f"'chain', {'array(' + ', '.join(str(key(*c)) for c in chain) + ')' if chain else 'cast(array() as array<int>)'})"
        for order, step, own, path, chain in cells)
    return F.expr(f"array({listed})")


def audit(docs: DataFrame, labels: DataFrame, filters: Mapping[str, Column] | None = None, copies: str | None = "E") -> DataFrame:
    """One row per part, order of the filters and step; part is the source (null: empty string).

    kept: documents after the step; removed: by it; redundant: failing its filter, removed before; unique_fails: failing its
    filter only; good_lost, toxic_lost: removed with a label quality = 1 or toxic = 1; shapley: what its filter removes, over all
    orders. ``copies`` names the filter of rows whose text a smaller doc_id has too. Null texts are empty; a null id has no label and
    is neither smaller nor larger than others; repeated rows count each, an id with several labels has each of them;
    other columns are ignored; an empty table gives no rows. Filter names are single characters, ``MOST_FILTERS`` at most.
    """
    filters = text_filters() if filters is None else filters
    names = sorted([*filters, *([copies] if copies else [])])
    if len(names) > MOST_FILTERS or any(len(n) != 1 for n in names):
        raise ValueError(f"at most {MOST_FILTERS} filters, named by one character")
    parts, failing = failing_ids(docs, labels, filters, copies)
    cells = lattice(failing, names).withColumn("cell", F.col("own") * 256 + F.col("mask"))

    def table(kind: int) -> Column:
        entry = F.when(F.col("kind") == kind, F.struct("cell", F.struct("n", "good", "toxic")))
        return F.map_from_entries(F.collect_list(entry))

    counts = cells.groupBy("part").agg(table(0).alias("left"), table(1).alias("gone"))
    rows = parts.join(counts, "part", "left").withColumn("s", F.explode(_steps(names))).select("part", "docs", "left", "gone", "s.*")

    def of(cell: Column, name: str = "n", kind: str = "left") -> Column:
        return F.coalesce(F.try_element_at(F.col(kind), cell)[name], F.lit(0)).cast("bigint")

    def total(cells: Column, kind: str = "left") -> Column:
        return F.aggregate(cells, F.lit(0).cast("bigint"), lambda s, c: s + of(c, "n", kind))

    here = F.element_at("path", -1)
    everything = (1 << len(names)) - 1
    alone = F.col("own") * 256 + F.expr(f"{everything} - shiftleft(1, own)")
    # a set of k filters comes before another one in k! (n - 1 - k)! orders
    weights = {m: math.factorial(m.bit_count()) * math.factorial(len(names) - 1 - m.bit_count()) for m in range(everything)}
    shares = [
        F.when(F.expr(f"shiftright({m}, own) % 2 = 0"), of(F.col("own") * 256 + m) * weight).otherwise(F.lit(0).cast("bigint"))
        for m, weight in weights.items()]
    return rows.select(
        "part", "filter_order", "step",
        (F.col("docs") - total(F.col("path"))).alias("kept"),
        of(here).alias("removed"),
        total(F.col("chain"), "gone").alias("redundant"),
        of(alone).alias("unique_fails"),
        of(here, "good").alias("good_lost"),
        of(here, "toxic").alias("toxic_lost"),
        F.aggregate(F.array(*shares), F.lit(0).cast("bigint"), lambda s, x: s + x).alias("shapley"))
