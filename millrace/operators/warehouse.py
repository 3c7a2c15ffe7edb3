"""Hub / satellite / link warehouse: tables derived from a nested model, and their load deltas.

Every delta is what a load appends. It holds no row the stored table already has, so
running a load again appends nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.plans.scratch import checkpointed

# Objects with their attributes (type text) and child objects (mapping).
EVENT_MODEL = {
    "event": {
        "type": "string",
        "actor": {"name": "string"},
        "repo": {"name": "string"},
    }
}


@dataclass(frozen=True)
class TableSpec:
    kind: str  # hub, satellite or link
    name: str
    keys: tuple[str, ...]  # columns that identify a row; also the bucketing columns
    ddl: str

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(", ")]


def hub(name: str) -> TableSpec:
    return TableSpec("hub", f"hub_{name}", (f"{name}_id",), f"{name}_id bigint NOT NULL")


def satellite(name: str, attribute: str) -> TableSpec:
    key, value = f"{name}_id", f"{name}_{attribute}"
    ddl = f"{key} bigint NOT NULL, {value} string NOT NULL, from_time timestamp"
    return TableSpec("satellite", f"sat_{value}", (key, value), ddl)


def link(left: str, right: str) -> TableSpec:
    keys = (f"{left}_id", f"{right}_id")
    ddl = ", ".join(f"{key} bigint NOT NULL" for key in keys)
    return TableSpec("link", f"link_{left}_{right}", keys, ddl)


def expand_model(model: Mapping, owner: str | None = None) -> Iterator[TableSpec]:
    """Tables of a model: a hub per object, a satellite per attribute, a link per nesting."""
    for name, content in model.items():
        if not isinstance(content, Mapping):
            yield satellite(owner, name)
            continue
        yield hub(name)
        if owner is not None:
            yield link(owner, name)
        yield from expand_model(content, name)


def model_tables(spark: SparkSession, model: Mapping) -> DataFrame:
    """The expanded model as a DataFrame of (kind, name, ddl)."""
    rows = [(spec.kind, spec.name, spec.ddl) for spec in expand_model(model)]
    return spark.createDataFrame(rows, "kind string, name string, ddl string")


def _present(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in which no given column is null; written as a filter that reaches the file scan."""
    return rows.where(reduce(Column.__and__, [F.col(name).isNotNull() for name in columns]))


def _not_stored(found: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """Found rows (already one per key, so no key can be hot) missing from the stored table."""
    return found.join(stored.select(*keys), keys, "left_anti")


def hub_new_keys(source: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Keys of the source not in the hub; a null key identifies nothing and is left out."""
    return _not_stored(_present(source, key).select(key).distinct(), stored, [key])


def link_new_pairs(source: DataFrame, stored: DataFrame, left: str, right: str) -> DataFrame:
    """Source pairs not in the link, each once; pairs need both keys."""
    return _not_stored(_present(source, left, right).select(left, right).distinct(), stored, [left, right])


def sat_new_values(
    source: DataFrame, stored: DataFrame, key: str, value: str, time: str = "created_at"
) -> DataFrame:
    """(key, value) pairs not in the satellite, with the latest time the source shows them."""
    latest = (
        _present(source, key, value)
        .groupBy(key, value)
        .agg(F.max(time).alias("from_time"))
    )
    return _not_stored(latest, stored, [key, value])


def sat_new_versions(
    source: DataFrame, stored: DataFrame, key: str, value: str, time: str = "created_at"
) -> DataFrame:
    """Source sightings of a (key, value) pair that is not stored with an earlier time.

    The stored side is joined as it is, so both sides are exchanged directly and AQE may
    split a pair that most sightings share.
    """
    sightings = _present(source, key, value).select(key, value, F.col(time).alias("from_time"))
    old = stored.select(
        F.col(key).alias("_key"), F.col(value).alias("_value"), F.col("from_time").alias("_since")
    )
    known_before = (
        (F.col(key) == F.col("_key"))
        & (F.col(value) == F.col("_value"))
        & (F.col("_since") < F.col("from_time"))
    )
    return sightings.join(old, known_before, "left_anti")


def new_rows(source: DataFrame, stored: DataFrame, spec: TableSpec, time: str = "created_at") -> DataFrame:
    """The load delta of any table of the model."""
    if spec.kind == "hub":
        return hub_new_keys(source, stored, *spec.keys)
    if spec.kind == "link":
        return link_new_pairs(source, stored, *spec.keys)
    return sat_new_values(source, stored, *spec.keys, time=time)


def dim_new_values(source: DataFrame, dim: DataFrame, value: str, id: str, highest: int | None = None) -> DataFrame:
    """Values not in the dimension, numbered on from its highest id (``highest``, if known) in value order.

    Numbering is distributed: values are range-sorted, each partition counts its rows, and a
    row's number is its place in the partition plus the rows of all earlier partitions. Places
    depend on where the sort cuts its partitions, so the sorted values are checkpointed first.
    """
    fresh = _not_stored(_present(source, value).select(value).distinct(), dim, [value])
    placed = checkpointed(
        fresh.orderBy(value).withColumn("_place", F.monotonically_increasing_id())
    ).select(
        value,
        F.shiftright("_place", 33).alias("_part"),
        F.col("_place").bitwiseAND((1 << 33) - 1).alias("_row"),
    )
    # One row per partition of the sort: small whatever the data size.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    if highest is None:
        last = dim.agg(F.coalesce(F.max(id), F.lit(0))).scalar()
    else:
        last = F.lit(highest).cast("bigint")
    number = last + F.col("_before") + F.col("_row") + 1
    return placed.join(F.broadcast(offsets), "_part").select(
        number.cast("bigint").alias(id), value
    )


def dim_new_rows(source: DataFrame, dim: DataFrame, value: str, id: str) -> DataFrame:
    """(id, value) pairs whose value is not in the dimension.

    Pairs are de-duplicated with the id, so a value with very many ids keeps its rows
    apart, and the join by value exchanges both sides directly for AQE to split.
    """
    pairs = _present(source, id, value).select(id, value).distinct()
    return pairs.join(dim.select(value), value, "left_anti").select(id, value)
