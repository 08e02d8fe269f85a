"""Candidate keys of several columns: all minimal unique column combinations up to a width, decided exactly.

A combination is a key if none of its columns holds a null and no two rows agree on all of it. The search goes up level by
level. A combination that contains a key is not minimal and never looked at; one that lies within an agree set, the columns on
which some pair of rows agrees, is no key. Agree sets come first from neighbours within a bounded number of rows, the first ones and
some from all over the table (they can only rule out), then from a violating pair of every combination refuted. A level is looked at
in slices by the values of a combination's column of most values: rows that agree on the combination agree on that column, so a
slice holds all of them or none, and an eighth of the rows finds an eighth of the violating pairs.

What a small slice leaves open is settled exactly. Rows that agree on a combination agree on each part of it, so where few rows agree
on a part, those rows alone decide every combination that contains it: one pass finds them, their values decide. The rest the whole table
decides, in a shuffle of 64-bit hashes that are counted behind it only: nearly every hash is met once, so counting before it
would hold all of them and save nothing (values met often are ruled out by then). No hash met twice proves a key; a hash met twice is
settled by the values of its rows. The driver holds column sets, a hash and two rows' agreement per refuted combination, never data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from intakeyard.operators.inventory import ATOMIC, SCREEN_THREADS
from intakeyard.session import scratch_root

#: Rows in which pairs that agree are looked for before whole-table checks: proof against a key only.
EVIDENCE_ROWS = 20_000
#: Parts of the values of a column of which one is looked at before the whole table.
SLICES = (64, 8)
#: Combinations that one job looks at: more make a method that the JVM does not compile (16 at most, they are numbered in four bits).
SETS_AT_ONCE = 10
#: Hashes that one task counts, and three times as many rather than more tasks than a shuffle writes to without sorting.
HASHES_A_TASK, UNSORTED_TASKS = 1 << 20, 200
#: A table of so many rows is asked for parts of combinations that few rows share; so few rows that they can be looked at by themselves.
LARGE_ROWS, FEW_ROWS = 1_000_000, 1 << 20
KEYS_SCHEMA = "table_name string, n_columns int, key_columns string"


def plain_value(field_: T.StructField) -> Column:
    """A value as it is, the two zeros as one."""
    c = F.col(f"`{field_.name}`")
    return F.when(c == 0, F.lit(0.0).cast(field_.dataType)).otherwise(c) if isinstance(field_.dataType, (T.DoubleType, T.FloatType)) else c


def exact_value(field_: T.StructField) -> Column:
    """A value as bytes that are equal if and only if the values are: short types by their text, strings by SHA-256."""
    c = plain_value(field_)
    if isinstance(field_.dataType, T.StringType):
        return F.unhex(F.sha2(c, 256))
    return c.cast("string").cast("binary")


@dataclass
class Rows:
    """A frame of values ``c<i>`` and their hashes ``hc<i>``, and how many rows it has."""

    df: DataFrame
    n: int


def hashed(values: DataFrame, names: list[str], n: int) -> Rows:
    """Long values are hashed once a row."""
    return Rows(values.select(*names, *[F.xxhash64(n).alias(f"h{n}") for n in names]), n)


@dataclass
class Search:
    """Column sets as bit masks: what is known to be a key, and what is known to agree."""

    n: int
    keys: list[int] = field(default_factory=list)
    agree: list[int] = field(default_factory=list)

    def add_agree(self, masks: list[int]) -> None:
        """Only the largest agree sets are kept: the others rule out nothing more."""
        kept: list[int] = []
        for m in sorted({*self.agree, *masks}, key=lambda m: -m.bit_count()):
            if not any(m & k == m for k in kept):
                kept.append(m)
        self.agree = kept

    def settled(self, m: int) -> bool:
        return any(m & k == k for k in self.keys) or any(m & a == m for a in self.agree)

    def open(self, width: int) -> list[int]:
        """Combinations of ``width`` columns that nothing settles yet."""
        found = (sum(1 << i for i in c) for c in combinations(range(self.n), width))
        return [m for m in found if not self.settled(m)]


def _agreement(left: list[Column], right: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [F.when(x == y, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint") for i, (x, y) in enumerate(zip(left, right, strict=True))])


def neighbour_agreements(few: DataFrame, names: list[str]) -> tuple[list[int], list[int]]:
    """``(agree sets, distinct values a column)`` of a few rows: what neighbours among those with an equal value of some column agree on."""
    each = few.select(*names, F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(n).alias("v")) for i, n in enumerate(names)])).alias("by"))
    order = Window.partitionBy("by").orderBy(*names)
    both = each.select("by.i", *names, *[F.lag(n).over(order).alias(f"p{n}") for n in names], F.row_number().over(order).alias("k"))
    mask = F.when(F.col("k") > 1, _agreement([F.col(n) for n in names], [F.col(f"p{n}") for n in names]))
    found = both.groupBy("i", mask.alias("mask")).count().collect()  # sets of columns, not rows
    distinct = {r["i"]: r["count"] for r in found if r["mask"] is None}
    return list({r["mask"] for r in found if r["mask"] is not None}), [distinct.get(i, 0) for i in range(len(names))]


def _hash(members: list[str]) -> Column:
    """Equal values give equal hashes; ``h<name>`` is a column's own hash."""
    return F.xxhash64(*[F.col(f"h{n}") for n in members])


def _members(names: list[str], m: int) -> list[str]:
    return [n for i, n in enumerate(names) if m >> i & 1]


def _pivots(names: list[str], sets: list[int], distinct: list[int]) -> dict[int, str]:
    """The column of most values of each set."""
    return {m: names[max((i for i in range(len(names)) if m >> i & 1), key=distinct.__getitem__)] for m in sets}


def _numbered(names: list[str], sets: list[int]) -> list[Column]:
    """A set's hash, 60 bits, and its place among ``sets``, four: the sets of a job meet in one column and stay apart."""
    return [_hash(_members(names, m)).bitwiseAND(F.lit(-16)).bitwiseOR(F.lit(i).cast("bigint")) for i, m in enumerate(sets)]


def _place() -> Column:
    return F.col("h").bitwiseAND(F.lit(15))


def _in_slice(pivot: str, parts: int) -> Column:
    return F.pmod(F.col(f"h{pivot}"), F.lit(parts)) == 0


def _sliced(rows: Rows, pivots: Iterable[str], parts: int) -> DataFrame:
    """Rows that are in the slice of some pivot."""
    return rows.df if parts == 1 else rows.df.where(reduce(lambda a, b: a | b, [_in_slice(p, parts) for p in sorted(set(pivots))]))


def _met(rows: Rows, names: list[str], sets: list[int], pivots: dict[int, str], parts: int) -> DataFrame:
    """``(h, c)``: the sets' numbered hashes, each of the rows in the slice of the set's pivot, and how often they are met."""
    hashes = _numbered(names, sets)
    if parts > 1:
        hashes = [F.when(_in_slice(pivots[m], parts), h) for m, h in zip(sets, hashes, strict=True)]
    pairs = _sliced(rows, pivots.values(), parts).select(F.explode(F.array(*hashes)).alias("h")).where("h IS NOT NULL")
    tasks = max(1, -(-rows.n * len(sets) // (parts * HASHES_A_TASK)))
    return pairs.repartition(min(tasks, max(UNSORTED_TASKS, tasks // 3)), "h").groupBy("h").agg(F.count(F.lit(1)).alias("c"))


def _refuted(rows: Rows, names: list[str], sets: list[int], pivots: dict[int, str], parts: int) -> tuple[list[int], list[int]]:
    """``(refuted sets, agree sets)`` among the rows that fall into one of ``parts`` slices by the hash of a set's pivot column.

    Rows that agree on a set agree on its pivot, so a slice holds all of them or none; one part is the whole table."""
    twice = _met(rows, names, sets, pivots, parts).where("c > 1")
    shown = {sets[r["i"]]: r["h"] for r in twice.groupBy(_place().alias("i")).agg(F.min("h").alias("h")).collect()}  # a hash per set
    if not shown:
        return [], []
    at = [F.when(h == F.lit(shown[m]), F.lit(m).cast("bigint")) for m, h in zip(sets, _numbered(names, sets), strict=True) if m in shown]
    held = (_sliced(rows, [pivots[m] for m in shown], parts).select(F.explode(F.array(*at)).alias("set"), *names)
            .where("set IS NOT NULL").select("set", F.struct(*names).alias("row")))
    two = held.groupBy("set").agg(F.min("row").alias("a"), F.max("row").alias("b"))
    masks = {r["set"]: r["mask"] for r in two.select("set", _agreement([F.col(f"a.{n}") for n in names], [F.col(f"b.{n}") for n in names]).alias("mask")).collect()}
    refuted, agree = [], []
    for m in shown:
        if masks[m] & m == m:
            refuted.append(m)
            agree.append(masks[m])
        elif not rows.df.groupBy(*_members(names, m)).count().where("count > 1").isEmpty():  # unlike values of one hash: the values decide
            refuted.append(m)
            agree.append(m)
    return refuted, agree


def _whole(rows: Rows, names: list[str], search: Search, sets: list[int], distinct: list[int]) -> None:
    """Settles sets by rows among which are all that agree on them."""
    refuted, agree = _refuted(rows, names, sets, _pivots(names, sets, distinct), 1)
    search.add_agree(agree)
    search.keys += [m for m in sets if m not in refuted]


def _few_share(rows: Rows, names: list[str], parts: list[int], distinct: list[int]) -> dict[int, int]:
    """About how many rows share their values of a column set with other rows, as a slice tells, for sets that few rows share."""
    known = [min(rows.n, d if d < EVIDENCE_ROWS // 4 else rows.n) for d in distinct]
    asked = [p for p in parts if prod(known[i] for i in range(len(names)) if p >> i & 1) > rows.n // 2]  # else most rows do
    size: dict[int, int] = {}
    for at in range(0, len(asked), SETS_AT_ONCE):
        sets = asked[at:at + SETS_AT_ONCE]
        met = _met(rows, names, sets, _pivots(names, sets, distinct), SLICES[0])
        for r in met.groupBy(_place().alias("i")).agg(F.sum("c").alias("all"), F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)).alias("shared")).collect():
            size[sets[r["i"]]] = rows.n * r["shared"] // r["all"]
    return {p: n for p, n in size.items() if n <= FEW_ROWS}


def _folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/keys/{uuid.uuid4().hex}"


def _by_few_rows(spark: SparkSession, rows: Rows, names: list[str], search: Search, todo: list[int], distinct: list[int]) -> None:
    """Settles sets that have a part, one column less, that few rows share: all rows that agree on such a set are among those."""
    within: dict[int, set[int]] = {}
    for m in todo:
        for i in range(len(names)):
            if m >> i & 1:
                within.setdefault(m ^ 1 << i, set()).add(m)
    size = _few_share(rows, names, [p for p, sets in within.items() if len(sets) > 1], distinct)
    parts, left = [], set(todo)
    while len(parts) < SETS_AT_ONCE and (fit := [p for p in size if len(within[p] & left) > 1 and sum(size[q] for q in [*parts, p]) <= FEW_ROWS]):
        parts.append(max(fit, key=lambda p: (len(within[p] & left), -size[p])))
        left -= within[parts[-1]]
    if not parts:
        return
    folder = _folder(spark)
    _met(rows, names, parts, _pivots(names, parts, distinct), 1).where("c > 1").write.parquet(f"{folder}/hashes")
    hashes = spark.read.schema("h bigint, c bigint").parquet(f"{folder}/hashes")
    held = {r["i"]: r["c"] for r in hashes.groupBy(_place().alias("i")).agg(F.sum("c").alias("c")).collect()}
    if sum(held.values()) > 4 * FEW_ROWS:  # the slice has told too little: the whole table decides
        return
    (rows.df.select(F.explode(F.array(*_numbered(names, parts))).alias("h"), *names).join(F.broadcast(hashes.select("h")), "h", "left_semi")
     .select(_place().alias("i"), *names).write.parquet(f"{folder}/rows"))
    few = spark.read.parquet(f"{folder}/rows")
    for i, part in enumerate(parts):
        mine = hashed(few.where(F.col("i") == i), names, held.get(i, 0))
        sets = [m for m in todo if m & part == part]
        for at in range(0, len(sets), SETS_AT_ONCE):
            if asked := [m for m in sets[at:at + SETS_AT_ONCE] if not search.settled(m)]:
                _whole(mine, names, search, asked, distinct)


def check_level(spark: SparkSession, rows: Rows, names: list[str], search: Search, width: int, distinct: list[int]) -> None:
    """Settles all combinations of ``width`` columns: a small slice refutes most; few rows, or a larger slice and the whole table, decide the rest."""
    slices = [p for p in SLICES if rows.n >= p * EVIDENCE_ROWS // 4]
    for k, parts in enumerate([*slices, 1]):
        if k == min(1, len(slices)) and width > 1 and rows.n >= LARGE_ROWS:
            _by_few_rows(spark, rows, names, search, search.open(width), distinct)
        todo, held = search.open(width), rows
        if parts > 1 and rows.n >= LARGE_ROWS and len(todo) > SETS_AT_ONCE:  # several jobs: the slices are written down once
            path = f"{_folder(spark)}/slices"
            _sliced(rows, _pivots(names, todo, distinct).values(), parts).select(*names).write.parquet(path)
            held = hashed(spark.read.parquet(path), names, rows.n)
        for at in range(0, len(todo), SETS_AT_ONCE):
            sets = [m for m in todo[at:at + SETS_AT_ONCE] if not search.settled(m)]
            if not sets:
                continue
            if parts == 1:
                _whole(rows, names, search, sets, distinct)
            else:
                search.add_agree(_refuted(held, names, sets, _pivots(names, sets, distinct), parts)[1])


def minimal_keys(df: DataFrame, width: int = 3) -> list[tuple[str, ...]]:
    """Minimal keys of at most ``width`` columns, as names in table order; none for a table without rows."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, ATOMIC)]
    if not fields:
        return []
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(f"`{f.name}`")).alias(f"n{i}") for i, f in enumerate(fields)]).first()
    n_rows = counts["_n"]
    whole = [f for i, f in enumerate(fields) if n_rows > 0 and counts[f"n{i}"] == n_rows]
    if not whole:
        return []
    if len(whole) > 62:
        raise ValueError(f"{len(whole)} columns without nulls; column sets are 62 bits")
    names = [f"c{i}" for i in range(len(whole))]
    search, distinct = Search(len(whole)), [0] * len(whole)
    spread = df.where(F.rand(7) < EVIDENCE_ROWS / n_rows)  # a hot value is among them wherever it lies; each row once
    for few in [df.limit(EVIDENCE_ROWS), *([spread] if n_rows > 4 * EVIDENCE_ROWS else [])]:
        agree, distinct = neighbour_agreements(few.select(*[exact_value(f).alias(n) for f, n in zip(whole, names, strict=True)]), names)
        search.add_agree(agree)
    rows = hashed(df.select(*[plain_value(f).alias(n) for f, n in zip(whole, names, strict=True)]), names, n_rows)
    for level in range(1, width + 1):
        check_level(df.sparkSession, rows, names, search, level, distinct)
    return [tuple(f.name for i, f in enumerate(whole) if m >> i & 1) for m in search.keys]


def composite_keys(spark: SparkSession, frames: dict[str, DataFrame], width: int = 3) -> DataFrame:
    """``(table_name, n_columns, key_columns)``: every minimal key of at most ``width`` columns, names joined by commas."""
    with ThreadPoolExecutor(max_workers=SCREEN_THREADS) as pool:  # the tables' jobs are independent
        found = list(pool.map(lambda item: [(item[0], len(k), ",".join(k)) for k in minimal_keys(item[1], width)], frames.items()))
    return spark.createDataFrame([r for rows in found for r in rows], KEYS_SCHEMA)
