"""Data-quality checks and the gate that stops a load.

A check is a named number with a verdict. Checks are derived from declared rules
(``schemas.Constraints``). Over whole tables, those on rows are columns of one
aggregation per table, and all those on keys and references are counted together:
one union of tagged keys, shuffled once, however many tables and checks there are.

Over a partitioned table the same checks are measured partition by partition, and
the figures merge (``measure``, ``merged``): a load that touches a few partitions
reads those only, and the gate still judges the whole table.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import CONSTRAINTS, STAGING_RULES, WAREHOUSE_RULES, Constraints
from .dedup import duplicate_summary
from .joins import missing_in_any
from .windows import sequence_gaps


#: Types whose values are equal as numbers where their texts are.
WHOLE = {"tinyint", "smallint", "int", "bigint"}


@dataclass(frozen=True)
class Copies:
    """Surplus rows of a key."""
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Flagged:
    """Most rows of a key that have a flag."""
    key: str
    flag: str


@dataclass(frozen=True)
class Reference:
    """Rows whose reference, not NULL, has no parent. The parent's column is unique."""
    column: str
    parent: str
    parent_column: str | None = None
    frame: DataFrame | None = None

    @property
    def target(self) -> str:
        return self.parent_column or self.column


@dataclass(frozen=True)
class MoreRowsThan:
    """Rows of another table less those of this one."""
    other: str


@dataclass(frozen=True)
class Highest:
    """Largest value of a column."""
    column: str


@dataclass(frozen=True)
class Check:
    """``value`` is an aggregate over ``table``, one of the kinds above, or a frame
    with one value, which can't be merged. ``passes`` is an SQL condition on it."""
    name: str
    table: str
    value: Column | Copies | Flagged | Reference | MoreRowsThan | Highest | DataFrame
    passes: str = "value = 0"


class GateFailed(Exception):
    """At least one check of a phase failed; nothing may be published. ``failures``
    has (check, value, condition) of each."""

    def __init__(self, phase: str, failures: Sequence[tuple[str, Decimal, str]]):
        self.phase, self.failures = phase, list(failures)
        super().__init__(f"{phase} is not published; " + "; ".join(
            f"{name}: {condition.replace('value', exact(value), 1)} does not hold"
            for name, value, condition in self.failures))


def exact(value) -> str:
    """A check's value with all its digits."""
    return str(int(value)) if value == int(value) else str(value)


# ---- single values -------------------------------------------------------

def violations(condition: Column) -> Column:
    return F.count_if(condition)


def surplus_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicate_summary(df, keys).select(F.col("duplicate_rows").alias("value"))


def orphans(child: DataFrame, parent: DataFrame, column: str,
            parent_column: str | None = None) -> DataFrame:
    """Child rows whose (non-NULL) reference has no parent."""
    keys = parent.select(F.col(parent_column or column).alias(column))
    return (child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")
            .agg(F.count("*").alias("value")))


def count_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    n = a.agg(F.count("*").alias("n"))
    return n.select((F.col("n") - b.agg(F.count("*").alias("n")).scalar()).alias("value"))


def most_current_rows(dim_customer: DataFrame) -> DataFrame:
    per_person = (dim_customer.filter("is_current").groupBy("customer_unique_id")
                  .agg(F.count("*").alias("n")))
    return per_person.agg(F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("value"))


def unresolved_facts(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    return missing_in_any(fact, dims).agg(F.count("*").alias("value"))


def calendar_gaps(dim_date: DataFrame) -> DataFrame:
    return sequence_gaps(dim_date.select("full_date"), "full_date").agg(
        F.count("*").alias("value"))


def money_difference(a: DataFrame, b: DataFrame, column_a: str,
                     column_b: str) -> DataFrame:
    total = b.agg(F.sum(F.col(column_b).cast("decimal(20,2)")).alias("t")).scalar()
    return a.agg(F.sum(F.col(column_a).cast("decimal(20,2)")).alias("t")).select(
        F.abs(F.coalesce(F.col("t"), F.lit(0)) - F.coalesce(total, F.lit(0)))
        .cast("double").alias("value"))


# ---- checks from declared rules --------------------------------------------

def constraint_checks(table: str, frames: Iterable[str],
                      rules: Constraints | None = None) -> list[Check]:
    """One check per declared rule; references only to tables among ``frames``."""
    rules = rules or CONSTRAINTS[table]

    def none(name: str, condition: Column) -> Check:
        return Check(f"{table}.{name}", table, violations(condition))

    checks = []
    if rules.required:
        checks.append(Check(f"{table} has rows", table, F.count(F.lit(1)), "value > 0"))
    if rules.primary_key:
        checks.append(Check(f"{table} primary key", table, Copies(rules.primary_key)))
    checks += [none(f"{c} not null", F.col(c).isNull())
               for c in (*rules.primary_key, *rules.not_null)]
    checks += [none(f"{c} in domain", ~F.col(c).isin(allowed))
               for c, allowed in rules.domains.items()]
    for c, (lo, hi) in rules.ranges.items():
        bounds = [x for x in (None if lo is None else F.col(c) < lo,
                              None if hi is None else F.col(c) > hi) if x is not None]
        checks.append(none(f"{c} in range", reduce(Column.__or__, bounds)))
    checks += [none(f"{c} has {n} characters", F.length(F.trim(c)) != n)
               for c, n in rules.widths.items()]
    checks += [none(f"{c} like {p}", ~F.col(c).rlike(p)) for c, p in rules.patterns.items()]
    checks += [Check(f"{table}.{c} sometimes starts with {p}", table,
                     violations(F.col(c).startswith(p)), "value > 0")
               for c, p in rules.starts.items()]
    checks += [none(f"{lo} before {hi}", F.col(lo) >= F.col(hi)) for lo, hi in rules.intervals]
    checks += [none(f"{c} never {v}", F.col(c) == v) for c, v in rules.never.items()]
    checks += [Check(f"{table}.{flag} once per {key}", table, Flagged(key, flag), "value <= 1")
               for key, flag in rules.flags]
    checks += [Check(f"{table}.{c} in total", table,
                     F.coalesce(F.sum(c), F.lit(0)), "value > 0") for c in rules.totals]
    checks += [Check(f"{table}.{c} references {parent}", table, Reference(c, parent))
               for c, parent in rules.foreign_keys if parent in frames]
    if rules.as_many_as:
        checks.append(Check(f"{table} rows as {rules.as_many_as}", table,
                            MoreRowsThan(rules.as_many_as)))
    return checks


def staging_checks(leading_zero: bool = True) -> list[Check]:
    """``leading_zero``: some zip starts with 0, else they were made numbers on the way."""
    rules = dict(STAGING_RULES)
    if not leading_zero:
        rules["customers"] = replace(rules["customers"], starts={})
    return [c for t, r in rules.items() for c in constraint_checks(t, rules, r)]


def warehouse_checks(no_unknown: bool = False) -> list[Check]:
    rules = dict(WAREHOUSE_RULES)
    if not no_unknown:
        rules["fact"] = replace(rules["fact"], never={})
    return [c for t, r in rules.items() for c in constraint_checks(t, rules, r)]


def bound(checks: Sequence[Check], frames: Mapping[str, DataFrame]) -> list[Check]:
    """The checks with the parents that their references are looked up in, where they
    have none yet."""
    return [replace(c, value=replace(c.value, frame=frames[c.value.parent]))
            if isinstance(c.value, Reference) and c.value.frame is None else c
            for c in checks]


# ---- partition by partition --------------------------------------------------

def merges_by_max(check: Check) -> bool:
    return isinstance(check.value, (Flagged, Highest))


def mergeable(check: Check) -> bool:
    """Whether partitions keep a figure for the check."""
    return not isinstance(check.value, (MoreRowsThan, DataFrame))


def measure(df: DataFrame, part: Column, checks: Sequence[Check]) -> dict[str, dict]:
    """Per partition the number of rows and the value of each check on rows, keys or
    references. Keys lie within a partition; the result is bounded by partitions
    times checks.

    Checks on rows are taken in the pass that groups the first key.
    """
    df = df.withColumn("_part", part)
    keyed: dict[tuple, list[Check]] = {}
    for c in checks:
        if isinstance(c.value, (Copies, Flagged)):
            key = c.value.columns if isinstance(c.value, Copies) else (c.value.key,)
            keyed.setdefault(key, []).append(c)
    values = [(f"v{i}", c, F.max(c.value.column) if isinstance(c.value, Highest) else c.value)
              for i, c in enumerate(c for c in checks if isinstance(c.value, (Column, Highest)))]
    names: list[str] = []
    parts = []
    for n, (key, of_key) in enumerate(keyed.items() or [((), [])]):
        first, second = [F.count(F.lit(1)).alias("n")], []
        if n == 0:
            first += [value.alias(v) for v, _, value in values]
            second += [("rows", F.sum("n"))] + [
                (c.name, F.max(v) if merges_by_max(c) else F.sum(v)) for v, c, _ in values]
        for c in of_key:
            if isinstance(c.value, Flagged):
                first.append(F.count_if(c.value.flag).alias(f"f_{c.value.flag}"))
                second.append((c.name, F.max(f"f_{c.value.flag}")))
            else:
                second.append((c.name, F.sum(F.col("n") - 1)))
        found = df.groupBy("_part", *key).agg(*first).groupBy("_part").agg(
            *[v.cast("string").alias(f"s{i}") for i, (_, v) in enumerate(second)])
        parts.append(found.select("_part", F.inline(F.array(*[
            F.struct(F.lit(len(names) + i).alias("check"), F.col(f"s{i}").alias("value"))
            for i in range(len(second))]))))
        names += [name for name, _ in second]
    for c in (c for c in checks if isinstance(c.value, Reference)):
        keys = c.value.frame.select(F.col(c.value.target).alias("_key")).distinct()
        missing = df.join(keys, F.col(c.value.column) == F.col("_key"), "left").groupBy(
            "_part").agg(F.count_if(F.col(c.value.column).isNotNull() & F.col("_key").isNull())
                         .cast("string").alias("value"))
        parts.append(missing.select("_part", F.lit(len(names)).alias("check"), "value"))
        names.append(c.name)
    out: dict[str, dict] = {}
    for r in reduce(DataFrame.unionByName, parts).collect():
        value = Decimal(r["value"] or 0)
        out.setdefault(r["_part"], {})[names[r["check"]]] = (
            int(value) if value == int(value) else str(value))
    return out


def merged(check: Check, states: Mapping[str, Mapping[str, Mapping]]) -> Decimal:
    """The value of a check over a whole table, from its partitions' states by table."""
    own = states[check.table].values()
    if isinstance(check.value, MoreRowsThan):
        return Decimal(sum(s["rows"] for s in states[check.value.other].values())
                       - sum(s["rows"] for s in own))
    values = [Decimal(s[check.name]) for s in own]
    if merges_by_max(check):
        return max(values, default=Decimal(0))
    return sum(values, Decimal(0))


def gate(checks: Sequence[Check], states: Mapping[str, Mapping[str, Mapping]],
         phase: str) -> int:
    """Judge all checks of a phase by the states. Returns their number."""
    return judge(phase, [(c.name, merged(c, states), c.passes) for c in checks])


def judge(phase: str, figures: Sequence[tuple[str, Decimal, str]]) -> int:
    """Raise if any figure (name, value, condition) fails, with all of them."""
    failed = [f for f in figures if not holds(f[2], f[1])]
    if failed:
        raise GateFailed(phase, failed)
    return len(figures)


def holds(condition: str, value: Decimal) -> bool:
    """An SQL comparison of ``value`` with a number."""
    _, operator, bound_ = condition.split()
    limit = Decimal(bound_)
    return {"=": value == limit, ">": value > limit, "<": value < limit,
            "<=": value <= limit, ">=": value >= limit}[operator]


# ---- whole tables ------------------------------------------------------------

def evaluate(checks: Sequence[Check], frames: Mapping[str, DataFrame]) -> DataFrame:
    """(check, value, passed), one row per check."""
    def verdicts(one_row: DataFrame, of: Sequence[Check]) -> DataFrame:
        return one_row.select(F.inline(F.array(*[
            F.struct(F.lit(c.name).alias("check"), F.col(f"v{i}").alias("value"),
                     F.expr(c.passes.replace("value", f"v{i}")).alias("passed"))
            for i, c in enumerate(of)])))

    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        simple = [c for c in checks if c.table == table and isinstance(c.value, Column)]
        if simple:
            parts.append(verdicts(frames[table].agg(*[
                c.value.cast("double").alias(f"v{i}") for i, c in enumerate(simple)]), simple))
    keyed = [c for c in checks if isinstance(c.value, (Copies, Reference))]
    if keyed:
        parts.append(verdicts(key_counts(keyed, frames), keyed))
    for c in checks:
        if isinstance(c.value, Flagged):
            most = (frames[c.table].filter(c.value.flag).groupBy(c.value.key)
                    .agg(F.count(F.lit(1)).alias("n")))
            value = most.agg(F.coalesce(F.max("n"), F.lit(0)).alias("value"))
        elif isinstance(c.value, MoreRowsThan):
            value = count_difference(frames[c.value.other], frames[c.table])
        elif isinstance(c.value, DataFrame):
            value = c.value
        else:
            continue
        parts.append(verdicts(value.select(F.col("value").cast("double").alias("v0")), [c]))
    return reduce(DataFrame.unionByName, parts)


def key_counts(checks: Sequence[Check], frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row with the values ``v0``, ``v1``, ... of checks on keys and references.

    Every table gives each of its keys and references as a row tagged with what
    it stands for; rows are counted by key before they are shuffled, all tables'
    together. Tables are read once, and a hot reference is a row per task. Whole
    numbers stay numbers, and a row has as many counts as one key has references:
    rows of most keys come once, so their width is what tasks hold and shuffle.
    """
    domains: list[tuple[str, tuple[str, ...]]] = []   # a key: table and columns
    gives: dict[str, list[tuple[int, int, tuple[str, ...]]]] = {}  # domain, tag, columns
    tags: dict[int, int] = {}                         # rows of a domain: 0, then references

    def domain(table: str, columns: tuple[str, ...]) -> int:
        if (table, columns) not in domains:
            domains.append((table, columns))
            tags[len(domains) - 1] = 1
            gives.setdefault(table, []).append((len(domains) - 1, 0, columns))
        return domains.index((table, columns))

    at: list[tuple[int, int]] = []                    # of each check: domain, tag
    for c in checks:
        if isinstance(c.value, Copies):
            at.append((domain(c.table, c.value.columns), 0))
        else:
            of = domain(c.value.parent, (c.value.target,))
            at.append((of, tags[of]))
            gives.setdefault(c.table, []).append((of, tags[of], (c.value.column,)))
            tags[of] += 1
    # Keys and their references meet as numbers only where all of them are whole ones.
    types = {table: dict(frames[table].dtypes) for table in gives}
    texts = {(of, i) for table, given in gives.items() for of, _, columns in given
             for i, c in enumerate(columns) if types[table].get(c) not in WHOLE}
    width = max(len(columns) for _, columns in domains)
    slots = [(i, kind) for i in range(width) for kind in ("long", "string") if any(
        i < len(columns) and ((of, i) in texts) == (kind == "string")
        for of, (_, columns) in enumerate(domains))]
    names = [f"key_{kind}_{i}" for i, kind in slots]
    rows = []
    for table, given in gives.items():
        keys = []
        for of, tag, columns in given:
            key = F.struct(F.lit(of).alias("domain"), F.lit(tag).alias("tag"), *[
                (F.col(columns[i]) if i < len(columns)
                 and ((of, i) in texts) == (kind == "string") else F.lit(None))
                .cast(kind).alias(name) for (i, kind), name in zip(slots, names)])
            keys.append(key if tag == 0 else F.when(F.col(columns[0]).isNotNull(), key))
        rows.append(frames[table].select(F.inline(F.filter(
            F.array(*keys), lambda k: k.isNotNull()))))
    per_key = reduce(DataFrame.unionByName, rows).groupBy("domain", *names).agg(*[
        F.count_if(F.col("tag") == t).alias(f"n{t}") for t in range(max(tags.values()))])
    values = []
    for i, (of, tag) in enumerate(at):
        if tag == 0:
            n = F.when(F.col("n0") > 0, F.col("n0") - 1)
        else:
            n = F.when(F.col("n0") == 0, F.col(f"n{tag}"))
        total = F.sum(F.when(F.col("domain") == of, n))
        values.append(F.coalesce(total, F.lit(0)).cast("double").alias(f"v{i}"))
    return per_key.agg(*values)
