"""Writing tables, extracts and snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from mercato.sources.publish import publish
from mercato.specs import Table


class LoadError(Exception):
    """A load stopped before the targets were touched."""


def write_parquet(df: DataFrame, path: str) -> str:
    """A table at a path of its own. Where readers may be at work, use ``publish`` instead."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_partitioned(
    df: DataFrame, path: str, columns: Sequence[str], replace: str = "all"
) -> str:
    """Parquet partitioned by ``columns``, in place of the whole table.

    With ``replace="present"`` only the partitions that ``df`` has are replaced. Rows are
    gathered by partition value, so a value gets few files; adaptive execution spreads a
    large value over several tasks and files by its size.
    """
    modes = {"all": "static", "present": "dynamic"}
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", modes[replace])
        .partitionBy(*columns)
        .parquet(path)
    )
    return path


def export_csv(df: DataFrame, path: str, single_file: bool = False, compression: str | None = None) -> str:
    """CSV with a header. ``single_file`` is for small extracts only: one task writes it.

    A compressed file is read back by one task, so its rows are as many as one task has written.
    """
    frame = df.coalesce(1) if single_file else df
    writer = frame.write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("zlib.compress.level", "BEST_SPEED").csv(path, compression=compression)
    return path


def refresh_snapshot(df: DataFrame, path: str) -> str:
    """Publish a result as the new version at ``path``, stamped with the time of the refresh.

    Readers (``read_published``) have the old version until the new one is complete. Returns the
    folder of the new version.
    """
    name = publish(df.withColumn("refreshed_at", F.current_timestamp()), path)
    return f"{path.rstrip('/')}/versions/{name}"


@dataclass(frozen=True)
class LoadStep:
    """One table of a load: where its rows are staged and the statements that put them in place."""

    table: str
    staging: str
    columns: tuple[str, ...]
    empty: str
    fill: str


def load_plan(specs: Sequence[Table], columns: Mapping[str, Sequence[str]], schema: str | None = None) -> list[LoadStep]:
    """The load of some tables as plain data, parents before the tables that refer to them.

    Rows go to staging tables first. When all are there and counted, ``swap_statements`` empties and
    fills the targets in one transaction, so a load that is repeated, or broken off
    anywhere, leaves either the old rows or the new ones.
    """
    named = {s.name: s for s in specs}
    done: list[str] = []

    def visit(name: str, above: tuple[str, ...] = ()) -> None:
        if name in above:
            raise ValueError(f"tables refer to each other in a circle: {' -> '.join((*above, name))}")
        if name in done:
            return
        for f in named[name]:
            parent = f.refers_to.split(".")[0] if f.refers_to else None
            if parent in named and parent != name:
                visit(parent, (*above, name))
        done.append(name)

    for spec in specs:
        visit(spec.name)
    place = f"{schema}." if schema else ""
    steps = []
    for name in done:
        listed = ", ".join(columns[name])
        target, staging = f"{place}{name}", f"{place}load_{name}"
        fill = f"INSERT INTO {target} ({listed}) SELECT {listed} FROM {staging}"
        steps.append(LoadStep(target, staging, tuple(columns[name]), f"DELETE FROM {target}", fill))
    return steps


def swap_statements(steps: Sequence[LoadStep]) -> list[str]:
    """Empty the targets, children first, and fill them, parents first: one transaction."""
    return [s.empty for s in reversed(steps)] + [s.fill for s in steps]


def unmatched(written: Mapping[str, int], staged: Mapping[str, int]) -> dict[str, tuple[int, int | None]]:
    """Tables whose staged rows are not those that were written."""
    return {t: (n, staged.get(t)) for t, n in written.items() if staged.get(t) != n}


def jdbc_load(
    frames: Mapping[str, DataFrame],
    specs: Sequence[Table],
    url: str,
    properties: Mapping[str, str],
    batch_size: int = 10_000,
    connections: int = 8,
    schema: str | None = None,
) -> None:
    """Replace the rows of tables over JDBC by way of staging tables.

    Every staging table is written anew by at most ``connections`` tasks, its rows are counted on
    both sides, and only then one transaction empties and fills the targets. Targets that are not
    part of the load are not touched. Not exercised here, because no database may run.
    """
    spark = next(iter(frames.values())).sparkSession
    steps = load_plan(specs, {n: f.columns for n, f in frames.items()}, schema)
    written, staged = {}, {}
    for step, name in zip(steps, [s.table.split(".")[-1] for s in steps], strict=True):
        counted = Observation()
        (
            frames[name].select(*step.columns).repartition(connections)
            .observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.format("jdbc").mode("overwrite")
            .options(url=url, dbtable=step.staging, batchsize=batch_size, **properties)
            .save()
        )
        written[step.table] = counted.get["rows"]
        count = f"(SELECT COUNT(*) AS n FROM {step.staging}) t"
        staged[step.table] = int(spark.read.format("jdbc").options(url=url, dbtable=count, **properties).load().first()[0])
    if wrong := unmatched(written, staged):
        raise LoadError(f"staged rows differ from written ones: {wrong}")
    java = spark._jvm.java.util.Properties()
    for key, value in properties.items():
        java.setProperty(key, value)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, java)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in swap_statements(steps):
            statement.executeUpdate(text)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
