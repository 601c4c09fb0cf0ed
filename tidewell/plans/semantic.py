"""Governed metrics over a declared star model.

A model names entities, the joins between them, dimensions and metrics. A query
asks for metrics by dimensions; each metric is aggregated on its own fact at the
asked grain, and only then are the results of several facts put together, so no
join can multiply what a metric counts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.quality import stack


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Relationship:
    """`many.foreign_key` refers to the key of `one`.

    `optional_one` says that the foreign key is unique, so the many side has at
    most one row per key and may also be reached from the one side.
    """

    name: str
    many: str
    foreign_key: str
    one: str
    optional_one: bool = False


@dataclass(frozen=True)
class Dimension:
    name: str
    entity: str
    column: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Metric:
    """`formula` is an aggregate over the entity's columns; `kind` guides rounding."""

    name: str
    entity: str
    formula: str
    kind: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Model:
    entities: tuple[Entity, ...]
    relationships: tuple[Relationship, ...]
    dimensions: tuple[Dimension, ...]
    metrics: tuple[Metric, ...]
    facts: dict[str, dict[str, str]] = field(default_factory=dict)

    def entity(self, name: str) -> Entity:
        return _named(self.entities, name, "entity")

    def dimension(self, name: str) -> Dimension:
        return _named(self.dimensions, name, "dimension")

    def metric(self, name: str) -> Metric:
        return _named(self.metrics, name, "metric")


def _named(items, name: str, kind: str):
    """Item of that name or synonym; `entity.name` narrows the search."""
    owner, _, bare = name.rpartition(".")
    wanted = bare.strip().lower().replace(" ", "_")
    pool = [i for i in items if not owner or getattr(i, "entity", None) == owner]
    exact = [i for i in pool if i.name == wanted]
    hits = exact or [i for i in pool if wanted in [s.lower().replace(" ", "_") for s in i.synonyms]]
    if not hits:
        raise KeyError(f"unknown {kind}: {name}")
    if len(hits) > 1:
        raise KeyError(f"ambiguous {kind} {name}: {sorted(h.name for h in hits)}")
    return hits[0]


def _steps(model: Model, base: str) -> dict[str, list[tuple[str, str, str, str]]]:
    """For each reachable entity, the joins (from, from column, to, to column)."""
    keys = {e.name: e.key for e in model.entities}
    paths: dict[str, list] = {base: []}
    frontier = [base]
    while frontier:
        here = frontier.pop(0)
        for r in model.relationships:
            hops = []
            if r.many == here:
                hops.append((r.one, (here, r.foreign_key, r.one, keys[r.one])))
            if r.one == here and r.optional_one:
                hops.append((r.many, (here, keys[here], r.many, r.foreign_key)))
            for target, hop in hops:
                if target not in paths:
                    paths[target] = [*paths[here], hop]
                    frontier.append(target)
    return paths


_COMPARE = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(list(v)), "between": lambda c, v: c.between(v[0], v[1]),
}

Filter = tuple[str, str, object]


def _fact_rows(
    tables: dict[str, DataFrame], model: Model, base: str, wanted: list[Dimension]
) -> DataFrame:
    """The fact's own columns and, as `dim_<name>`, the dimensions asked for."""
    paths = _steps(model, base)
    for d in wanted:
        if d.entity not in paths:
            raise ValueError(f"no allowed join from {base} to {d.entity} for dimension {d.name}")
    needed: dict[tuple, None] = {}
    for d in wanted:
        for hop in paths[d.entity]:
            needed[hop] = None

    def dims_of(entity: str) -> list[Column]:
        return [F.col(d.column).alias(f"dim_{d.name}") for d in wanted if d.entity == entity]

    def links_of(entity: str) -> list[Column]:
        return [F.col(column).alias(f"link_{source}_{column}") for source, column, _, _ in needed if source == entity]

    def unique(columns: list[Column]) -> list[Column]:
        return list({str(c): c for c in columns}.values())

    aliases = [F.col(column).alias(name) for name, column in model.facts.get(base, {}).items()]
    own = [F.col(c) for c in tables[base].columns]
    taken = set(tables[base].columns)
    aliases = [a for a, name in zip(aliases, model.facts.get(base, {})) if name not in taken]
    rows = tables[base].select(*own, *aliases, *unique(dims_of(base) + links_of(base)))
    for source, column, target, target_column in needed:
        side = tables[target].select(F.col(target_column).alias("_side_key"),
                                     *unique(dims_of(target) + links_of(target)))
        rows = rows.join(side, F.col(f"link_{source}_{column}") == F.col("_side_key"), "left").drop("_side_key")
    return rows


def semantic_query(
    tables: dict[str, DataFrame],
    model: Model,
    metrics: list[str],
    dimensions: list[str] = (),
    filters: list[Filter] = (),
    order_by: list[str] = (),
    present: bool = False,
) -> DataFrame:
    """Metrics by dimensions; names may be synonyms.

    `filters` are (dimension, operator, value). `order_by` takes result columns, a
    leading `-` for descending. `present` rounds rates to four and money to two
    decimals. Counts of a fact without rows in a group are zero.
    """
    picked = [model.metric(m) for m in metrics]
    dims = [model.dimension(d) for d in dimensions]
    checks = [(model.dimension(n), op, value) for n, op, value in filters]
    wanted = list({d.name: d for d in [*dims, *[d for d, _, _ in checks]]}.values())

    parts = []
    for base in dict.fromkeys(m.entity for m in picked):
        own = [m for m in picked if m.entity == base]
        rows = _fact_rows(tables, model, base, wanted)
        for d, op, value in checks:
            rows = rows.filter(_COMPARE[op](F.col(f"dim_{d.name}"), value))
        grouped = rows.groupBy(*[F.col(f"dim_{d.name}").alias(d.name) for d in dims])
        parts.append(grouped.agg(*[F.expr(m.formula).alias(m.name) for m in own]))

    result = parts[0] if len(parts) == 1 else _put_together(parts, [d.name for d in dims], picked)
    result = result.select(*[d.name for d in dims], *[_shown(m, present).alias(m.name) for m in picked])
    if order_by:
        result = result.orderBy(*[F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in order_by])
    return result


def _put_together(parts: list[DataFrame], keys: list[str], metrics: list[Metric]) -> DataFrame:
    """Align results of several facts; grouping treats null keys as equal."""
    names = [m.name for m in metrics]
    types = {f.name: f.dataType for p in parts for f in p.schema.fields}
    wide = [p.select(*keys, *[F.col(n) if n in p.columns else F.lit(None).cast(types[n]).alias(n) for n in names])
            for p in parts]
    merged = [F.first(n, ignorenulls=True).alias(n) for n in names]
    return stack(wide).groupBy(*keys).agg(*merged)


def _shown(metric: Metric, present: bool) -> Column:
    value = F.col(metric.name)
    if metric.kind == "count":
        return F.coalesce(value, F.lit(0))
    if not present:
        return value
    return F.round(value, 4 if metric.kind == "rate" else 2)
