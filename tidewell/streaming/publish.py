"""Writing results so that a batch is applied whole, and once.

Append-only tables get one folder per batch. Maintained tables get new data folders
and then one small state file, named by a running number, that says which folders
make up the table. Readers take the highest state file, so they see the old table
or the new one. State files also hold the last batch of each writer, so a batch that
is delivered again after a failure changes nothing. A maintained table may be cut
by a partition column; then only the touched partitions are written.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def batch_folders(spark: SparkSession, root: str, but: str = "\0") -> list[str]:
    """Finished batches of an append-only table, without those whose name begins with `but`."""
    fs, folder = _fs(spark, root)
    if not fs.exists(folder):
        return []
    names = sorted(s.getPath().getName().removeprefix("batch=") for s in fs.listStatus(folder) if s.getPath().getName().startswith("batch="))
    return [n for n in names if not n.startswith(but) and path_exists(spark, f"{root}/batch={n}/_SUCCESS")]


def write_once(df: DataFrame, root: str, batch: int | str, partition_by: tuple[str, ...] = ()) -> bool:
    """Write a batch into its folder of an append-only table; False if it is there."""
    name = f"{batch:012d}" if isinstance(batch, int) else batch
    target = f"{root}/batch={name}"
    if path_exists(df.sparkSession, f"{target}/_SUCCESS"):
        return False
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(target)
    return True


@dataclass
class State:
    """What a maintained table consists of, and what it has absorbed."""

    number: int = 0
    schema: str = ""
    whole: str | None = None
    parts: dict[str, str] = field(default_factory=dict)
    part_column: str | None = None
    writers: dict[str, int] = field(default_factory=dict)
    built_from: dict[str, int] = field(default_factory=dict)

    def absorbed(self, writer: str | None, batch: int | None) -> bool:
        return writer is not None and self.writers.get(writer, -1) >= batch


def _state_numbers(spark: SparkSession, root: str) -> list[int]:
    fs, folder = _fs(spark, f"{root}/_states")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def read_state(spark: SparkSession, root: str, number: int | None = None) -> State | None:
    """State of that number, or the newest one; None when there is no table yet."""
    if number is None:
        numbers = _state_numbers(spark, root)
        if not numbers:
            return None
        number = numbers[-1]
    text = spark.read.text(f"{root}/_states/{number:012d}.json", wholetext=True).first()
    return State(**json.loads(text.value))


def _write_state(spark: SparkSession, root: str, state: State) -> None:
    """Create the state file whole; a second writer of the same number fails."""
    fs, target = _fs(spark, f"{root}/_states/{state.number:012d}.json")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_drafts/{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(state.__dict__).encode()))
    out.close()
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(draft, target):
        raise RuntimeError(f"another writer has published state {state.number} of {root}")


def current(spark: SparkSession, root: str, number: int | None = None) -> DataFrame | None:
    """The table as of a state (the newest by default)."""
    state = read_state(spark, root, number)
    if state is None:
        return None
    if state.part_column is None:
        return spark.read.schema(state.schema).parquet(f"{root}/data/{state.whole}")
    return read_parts(spark, root, state, list(state.parts))


def read_parts(spark: SparkSession, root: str, state: State, values: list[str]) -> DataFrame:
    """Only some partitions of a table; absent ones are left out."""
    paths = [f"{root}/data/{state.parts[v]}/{state.part_column}={v}" for v in values if v in state.parts]
    if not paths:
        return spark.createDataFrame([], state.schema)
    columns = spark.createDataFrame([], state.schema).columns
    return spark.read.schema(state.schema).option("basePath", f"{root}/data").parquet(*paths).select(*columns)


def publish(
    df: DataFrame, root: str, writer: str | None = None, batch: int | None = None,
    built_from: dict[str, int] | None = None, base: int | None = None,
) -> bool:
    """Replace a whole table; False when this writer's batch is already in it.

    `base` is the number of the state that `df` was made from (0: no table yet); if
    another writer has published since, nothing is written and an error tells so.
    """
    spark = df.sparkSession
    old = read_state(spark, root) or State()
    if old.absorbed(writer, batch):
        return False
    _unchanged(old, base, root)
    folder = f"_version={old.number + 1}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{root}/data/{folder}")
    _write_state(spark, root, State(
        old.number + 1, _ddl(df), whole=folder, writers=_with(old.writers, writer, batch),
        built_from=built_from or old.built_from))
    return True


def publish_parts(
    df: DataFrame, root: str, part_column: str, touched: list | None = None,
    writer: str | None = None, batch: int | None = None, built_from: dict[str, int] | None = None,
    base: int | None = None,
) -> bool:
    """Replace the touched partitions by `df`'s rows; without `touched`, all of them.

    A touched partition that `df` has no rows for goes empty. Rows are brought
    together by partition before the write, so a partition is a few files.
    """
    spark = df.sparkSession
    old = read_state(spark, root) or State()
    if old.absorbed(writer, batch):
        return False
    _unchanged(old, base, root)
    folder = f"_version={old.number + 1}-{uuid.uuid4().hex[:8]}"
    # The rebalance splits a large partition over several tasks where a plain
    # repartition would send it to one.
    df.hint("rebalance", part_column).write.partitionBy(part_column).parquet(f"{root}/data/{folder}")
    fs, jpath = _fs(spark, f"{root}/data/{folder}")
    prefix = f"{part_column}="
    written = [s.getPath().getName()[len(prefix):] for s in fs.listStatus(jpath)
               if s.getPath().getName().startswith(prefix)]
    gone = {str(t) for t in touched} if touched is not None else set(old.parts)
    stray = set(written) - gone if touched is not None else set()
    if stray:
        raise ValueError(f"rows outside the touched partitions: {sorted(stray)[:5]}")
    parts = {v: f for v, f in old.parts.items() if v not in gone}
    parts.update({v: folder for v in written})
    _write_state(spark, root, State(
        old.number + 1, _ddl(df), parts=parts, part_column=part_column,
        writers=_with(old.writers, writer, batch), built_from=built_from or old.built_from))
    return True


def _unchanged(old: State, base: int | None, root: str) -> None:
    if base is not None and old.number != base:
        raise RuntimeError(f"{root} is at state {old.number}, not at {base}, which was read; read it again")


def state_kept(spark: SparkSession, root: str, number: int) -> bool:
    """Whether a state can still be read, or has been forgotten."""
    return path_exists(spark, f"{root}/_states/{number:012d}.json")


def changed_parts(old: State | None, new: State) -> list[str]:
    """Partitions that differ between two states, told by their folders alone."""
    before = old.parts if old else {}
    return sorted(v for v in {*before, *new.parts} if before.get(v) != new.parts.get(v))


def forget_old_states(spark: SparkSession, root: str, keep: int = 100) -> int:
    """Drop all but the newest states and the data folders only the dropped ones name.

    A table built from a state that is gone is rebuilt whole at its next refresh.
    Returns how many data folders went.
    """
    numbers = _state_numbers(spark, root)
    kept, dropped = numbers[-keep:], numbers[:-keep]
    if not dropped:
        return 0

    def folders(state: State) -> set[str]:
        return {state.whole} if state.whole else set(state.parts.values())

    in_use = set().union(*[folders(read_state(spark, root, n)) for n in kept])
    unused = set().union(*[folders(read_state(spark, root, n)) for n in dropped]) - in_use
    for path in [*[f"{root}/_states/{n:012d}.json" for n in dropped], *[f"{root}/data/{f}" for f in sorted(unused)]]:
        fs, jpath = _fs(spark, path)
        fs.delete(jpath, True)
    return len(unused)


def _with(writers: dict[str, int], writer: str | None, batch: int | None) -> dict[str, int]:
    return {**writers, writer: batch} if writer is not None else dict(writers)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def int_values(df: DataFrame, column: str) -> list[int]:
    """Distinct values of a date key; bounded by the days of the calendar."""
    return sorted(r[0] for r in df.select(column).distinct().filter(F.col(column).isNotNull()).collect())
