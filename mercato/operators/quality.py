"""Data-quality checks as DataFrames: one row per check.

``check_all`` takes every check of a set of tables from one pass over each. The single checks
below it are for one-off questions. Keys are aggregated before anything is compared, so copies of
one key do not gather in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from mercato.specs import MONEY_COLUMNS, Table

RESULT = "table_name string, check_name string, passed boolean, violations bigint"


class QualityError(Exception):
    """Raised by the gate; carries the failed checks."""


def _result(df: DataFrame, table: str, check: str) -> DataFrame:
    """One-row frame with a ``violations`` column as a check result."""
    violations = F.coalesce(F.col("violations"), F.lit(0)).cast("bigint")
    return df.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        (violations == 0).alias("passed"),
        violations.alias("violations"),
    )


def check_columns(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Count the rows that break each rule (a rule is true for a bad row), in one pass."""
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(rules.values())])
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    unpivoted = counted.select(F.explode(F.array(*pairs)).alias("e")).select("e.*")
    return unpivoted.select(
        F.lit(table).alias("table_name"),
        "check_name",
        (F.col("violations") == 0).alias("passed"),
        "violations",
    )


def not_null_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"not_null[{c}]": F.col(c).isNull() for c in columns}


def non_negative_rules(columns: Sequence[str]) -> dict[str, Column]:
    return {f"non_negative[{c}]": F.col(c) < 0 for c in columns}


def between_rules(ranges: Mapping[str, tuple[int, int | None]]) -> dict[str, Column]:
    rules = {}
    for column, (low, high) in ranges.items():
        bad = F.col(column) < low
        rules[f"between[{column}]"] = bad if high is None else bad | (F.col(column) > high)
    return rules


def accepted_rules(accepted: Mapping[str, Sequence[object]]) -> dict[str, Column]:
    return {f"accepted_values[{c}]": ~F.col(c).isin(*values) for c, values in accepted.items()}


def check_pk_unique(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of their key. NULL keys equal each other; a missing column fails."""
    name = f"pk_unique[{','.join(keys)}]"
    if not set(keys) <= set(df.columns):
        missing = df.sparkSession.range(1).select(F.lit(1).alias("violations"))
        return _result(missing, table, f"pk_present[{','.join(keys)}]")
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return _result(copies.agg(F.sum(F.col("n") - 1).alias("violations")), table, name)


def check_fk(
    df: DataFrame, table: str, column: str, parent: DataFrame | None, target: str
) -> DataFrame:
    """Rows whose value is not in the parent. NULL is no violation; a missing parent fails."""
    name = f"fk[{column}->{target}]"
    if parent is None:
        missing = df.sparkSession.range(1).select(F.lit(1).alias("violations"))
        return _result(missing, table, name)
    parent_column = target.split(".")[1]
    values = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_column).alias(column))
    orphans = values.join(known, column, "left_anti")
    return _result(orphans.agg(F.sum("n").alias("violations")), table, name)


def timestamp_types(df: DataFrame, table: str, columns: Sequence[str]) -> list[tuple]:
    """Schema check, no data is read."""
    rows = []
    for column in columns:
        if column in df.columns:
            ok = isinstance(df.schema[column].dataType, (T.TimestampNTZType, T.TimestampType))
            rows.append((table, f"timestamp_type[{column}]", ok, 0 if ok else 1))
    return rows


def check_singular(df: DataFrame, table: str, name: str, bad: Column) -> DataFrame:
    """A user predicate: every row that satisfies it is an offence."""
    return _result(df.agg(F.count_if(bad).alias("violations")), table, name)


def suite(spec: Table, contract: bool = False) -> dict[str, object]:
    """The checks of a table as plain data.

    With ``contract``, value ranges and accepted values of the spec are checked too.
    """
    return {
        "table": spec.name,
        "not_null": spec.named(required=True),
        "unique": spec.named(in_key=True),
        "references": {f.name: f.refers_to for f in spec if f.refers_to},
        "timestamps": spec.named(type="timestamp"),
        "non_negative": [c for c in spec.named(type="double") if c in MONEY_COLUMNS],
        "between": {f.name: (f.low, f.high) for f in spec if f.high is not None} if contract else {},
        "accepted": {f.name: f.values for f in spec if f.values} if contract else {},
    }


@dataclass(frozen=True)
class Subject:
    """A table to be checked: row rules, the columns of its key, and column to ``table.column`` references."""

    name: str
    frame: DataFrame
    rules: Mapping[str, Column] = field(default_factory=dict)
    key: Sequence[str] = ()
    references: Mapping[str, str] = field(default_factory=dict)


def _text_key(columns: Sequence[str]) -> Column:
    """A key as one text: equal for equal keys only, NULL for a single NULL column."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*[F.when(p.isNull(), F.lit("-")).otherwise(F.concat(F.length(p).cast("string"), F.lit(":"), p)) for p in parts])


def _whole(frame: DataFrame, columns: Sequence[str]) -> bool:
    """Whether these columns are at most two whole numbers: such a key is compared as numbers, not as text."""
    kinds = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return len(columns) <= 2 and all(isinstance(frame.schema[c].dataType, kinds) for c in columns)


def _domain(table: str, columns: Sequence[str]) -> str:
    return f"{table}.{','.join(columns)}"


def check_all(
    spark: SparkSession, subjects: Sequence[Subject], parents: Mapping[str, Callable[[], DataFrame]] | None = None
) -> DataFrame:
    """Every check of every subject from one pass over each table.

    A row is exploded into what it contributes: one entry per rule it breaks, one for its key and one
    per reference. An entry names a domain (a rule, or a key such as ``orders.order_id``) by number, a
    value (as numbers where all columns of the domain are whole, else as text) and a slot: slot 0 holds the domain's own rows, further slots the tables that refer to
    it. All tables' entries go through one aggregation by (domain, value), combined before the
    shuffle, so that copies of a key are one row: uniqueness, and references without a
    partner, are then read off the counts of the slots. A parent that is not itself a subject is
    read for its key alone.
    """
    parents = parents or {}
    by_name = {s.name: s for s in subjects}
    labels: list[tuple[int, int, str, str]] = []  # domain, slot, table, check
    fixed: list[tuple] = []  # checks that need no row
    entries: dict[str, list[Column]] = {s.name: [] for s in subjects}
    extra: dict[str, list[str]] = {}  # key columns to be read of parents that are no subjects
    known: set[str] = set()
    slots: dict[str, int] = {}

    numbers: dict[str, int] = {}  # of domains: below 0 for a rule
    frames = {s.name: s.frame for s in subjects}
    whole: dict[str, bool] = {_domain(s.name, s.key): _whole(s.frame, s.key) for s in subjects if s.key and set(s.key) <= set(s.frame.columns)}
    for s in subjects:
        for column, target in s.references.items():
            parent, parent_column = target.split(".")
            if parent not in frames and parent in parents:
                frames[parent] = parents[parent]()
            if parent in frames and parent_column in frames[parent].columns:
                whole[target] = whole.get(target, _whole(frames[parent], [parent_column])) and _whole(s.frame, [column])

    def number(domain: str) -> int:
        made = numbers.setdefault(domain, len(numbers) + 1)
        return -made if "!" in domain else made

    def entry(domain: str, slot: int, columns: Sequence[str], when: Column | None = None) -> Column:
        as_numbers = whole.get(domain, False)
        value = [F.col(c).cast("bigint") for c in columns] if as_numbers else []
        value += [F.lit(None).cast("bigint")] * (2 - len(value))
        text = _text_key(columns) if columns and not as_numbers else F.lit(None).cast("string")
        made = F.struct(
            F.lit(number(domain)).alias("domain"), value[0].alias("a"), value[1].alias("b"), text.alias("text"), F.lit(slot).alias("slot")
        )
        return made if when is None else F.when(when, made)

    for s in subjects:
        for check, bad in s.rules.items():
            domain = f"{s.name}!{check}"
            labels.append((number(domain), 0, s.name, check))
            entries[s.name].append(entry(domain, 0, [], F.coalesce(bad, F.lit(False))))
        if s.key and set(s.key) <= set(s.frame.columns):
            domain = _domain(s.name, s.key)
            known.add(domain)
            labels.append((number(domain), 0, s.name, f"pk_unique[{','.join(s.key)}]"))
            entries[s.name].append(entry(domain, 0, s.key))
        elif s.key:
            fixed.append((s.name, f"pk_present[{','.join(s.key)}]", False, 1))
    for s in subjects:
        for column, target in s.references.items():
            check = f"fk[{column}->{target}]"
            parent, parent_column = target.split(".")
            if target not in known:
                if parent in by_name and parent_column in by_name[parent].frame.columns:
                    entries[parent].append(entry(target, 0, [parent_column]))
                elif parent not in by_name and parent in parents:
                    extra.setdefault(parent, []).append(parent_column)
                else:
                    fixed.append((s.name, check, False, 1))
                    continue
                known.add(target)
            slots[target] = slots.get(target, 0) + 1
            labels.append((number(target), slots[target], s.name, check))
            entries[s.name].append(entry(target, slots[target], [column], F.col(column).isNotNull()))
    for parent, columns in extra.items():
        by_name[parent] = Subject(parent, frames[parent])
        entries[parent] = [entry(f"{parent}.{c}", 0, [c]) for c in columns]

    told = [
        by_name[name].frame.select(F.explode(F.array(*made)).alias("e")).where("e is not null").select("e.*")
        for name, made in entries.items()
        if made
    ]
    results = spark.createDataFrame(fixed, RESULT)
    if not told:
        return results
    most = max(slots.values(), default=0)
    counts = reduce(DataFrame.unionAll, told).groupBy("domain", "a", "b", "text").agg(
        *[F.count_if(F.col("slot") == k).alias(f"n{k}") for k in range(most + 1)]
    )
    rule = F.col("domain") < 0
    broken = [F.sum(F.when(rule, F.col("n0")).otherwise(F.greatest(F.col("n0") - 1, F.lit(0))))]
    broken += [F.sum(F.when(F.col("n0") == 0, F.col(f"n{k}")).otherwise(0)) for k in range(1, most + 1)]
    found = counts.groupBy("domain").agg(F.array(*broken).alias("_broken")).select("domain", F.posexplode("_broken").alias("slot", "_n"))
    named = spark.createDataFrame(labels, "domain int, slot int, table_name string, check_name string")
    report = named.join(found, ["domain", "slot"], "left").withColumn("violations", F.coalesce("_n", F.lit(0)).cast("bigint"))
    return results.unionByName(report.select("table_name", "check_name", (F.col("violations") == 0).alias("passed"), "violations"))


def subject(spec: Table, frame: DataFrame, contract: bool = False) -> Subject:
    """What a table's records promise, for the columns that the frame has."""
    checks, have = suite(spec, contract), set(frame.columns)
    rules = not_null_rules([c for c in checks["not_null"] if c in have])
    rules |= non_negative_rules([c for c in checks["non_negative"] if c in have])
    rules |= between_rules({c: r for c, r in checks["between"].items() if c in have})
    rules |= accepted_rules({c: v for c, v in checks["accepted"].items() if c in have})
    return Subject(spec.name, frame, rules, checks["unique"], checks["references"])


def validate(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    specs: Sequence[Table],
    contract: bool = False,
) -> DataFrame:
    """All checks of all given specs as one DataFrame; each table is read once."""
    subjects = [subject(spec, tables[spec.name](), contract) for spec in specs]
    schema_rows: list[tuple] = []
    for spec, s in zip(specs, subjects, strict=True):
        schema_rows += timestamp_types(s.frame, spec.name, suite(spec)["timestamps"])
    return check_all(spark, subjects, tables).unionByName(spark.createDataFrame(schema_rows, RESULT))


def summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def failures(report: DataFrame) -> DataFrame:
    return report.filter(~F.col("passed"))


def quality_gate(report: DataFrame) -> None:
    """Raise if any check failed. The report has one row per check, so it is small."""
    failed = failures(report).collect()
    if failed:
        lines = [f"{r.table_name}.{r.check_name}: {r.violations}" for r in failed]
        raise QualityError("failed checks:\n" + "\n".join(lines))
