"""Declarative mapping from source fields to output variables.

A ``FieldRule`` describes one source field; a ``VariableSpec`` combines one or
more of them.  Specs compile to Spark columns: variables made of one field are
a projection, and only the rows of combined variables are shuffled.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "+": operator.add,
    "-": operator.sub,
    "*": operator.mul,
    "/": F.try_divide,  # NULL where the divisor is 0
}


@dataclass(frozen=True)
class FieldRule:
    """Conditions on one source field; unset parts do not restrict."""

    name: str | None = None
    stash: str | None = None
    averaged: bool | None = None  # cell methods: True non-empty, False empty
    where: Callable[[], Column] | None = None

    def predicate(self) -> Column:
        parts = []
        if self.name is not None:
            parts.append(F.col("field_name") == self.name)
        if self.stash is not None:
            parts.append(F.col("stash") == self.stash)
        if self.averaged is not None:
            empty = F.size("cell_methods") == 0
            parts.append(~empty if self.averaged else empty)
        if self.where is not None:
            parts.append(self.where())
        return reduce(lambda a, b: a & b, parts, F.lit(True))


@dataclass(frozen=True)
class VariableSpec:
    """One output variable."""

    short: str
    long: str
    fields: tuple[FieldRule, ...]
    ops: tuple[str, ...] = ()
    post: Callable[[Column], Column] | None = None
    levels_to_pressure: bool = False
    units: str | None = None
    attrs: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if len(self.ops) != len(self.fields) - 1:
            raise ValueError(f"{self.short}: {len(self.fields)} fields need {len(self.fields) - 1} operators")

    @property
    def post_name(self) -> str | None:
        if self.levels_to_pressure:
            return "interpolate_model_levels_to_pressure"
        return self.post.__name__ if self.post else None

    def fold(self, operands: Sequence[Column]) -> Column:
        """Left fold over the operators; one missing operand makes it missing."""
        out = operands[0]
        for op, nxt in zip(self.ops, operands[1:]):
            out = OPERATORS[op](out, nxt)
        return out


def has_dims(*dims: str) -> Column:
    """Fields whose dimensions are exactly these, in order."""
    return F.col("dims") == F.array(*[F.lit(d) for d in dims])


def map_values(df: DataFrame, values: Sequence[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply a column function to every variable of a wide table."""
    return df.withColumns({v: fn(F.col(v)) for v in values})


def drop_unused(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the listed columns, as far as they are there."""
    return df.drop(*names)


def override(specs: Sequence[VariableSpec], changes: dict[str, dict | None]) -> tuple[VariableSpec, ...]:
    """A copy of ``specs`` with some variables changed, or dropped by ``None``."""
    out = []
    for spec in specs:
        if spec.short not in changes:
            out.append(spec)
        elif changes[spec.short] is not None:
            out.append(replace(spec, **changes[spec.short]))
    return tuple(out)


def _operand_tags(specs: Sequence[VariableSpec]) -> Column:
    """Array of the operands a source row may serve; NULL where it does not.

    Rules are looked up by field name first, so that a row is held against
    the few rules of its own field only.
    """
    by_name: dict[str | None, list[Column]] = {}
    for spec in specs:
        for n, rule in enumerate(spec.fields):
            tag = F.struct(F.lit(spec.short).alias("variable"), F.lit(n).alias("operand"))
            by_name.setdefault(rule.name, []).append(F.when(rule.predicate(), tag))
    unnamed = by_name.pop(None, [])
    rest = F.array(*unnamed) if unnamed else F.lit(None)
    if not by_name:
        return rest
    names = iter(by_name.items())
    first, tags = next(names)
    cases = F.when(F.col("field_name") == first, F.array(*tags, *unnamed))
    for name, tags in names:
        cases = cases.when(F.col("field_name") == name, F.array(*tags, *unnamed))
    return cases.otherwise(rest)


def map_variables(df: DataFrame, specs: Sequence[VariableSpec], keys: list[str], value: str = "value") -> DataFrame:
    """Rows ``keys..., variable, value`` of all ``specs`` in a single scan.

    ``df`` is a long source-field table.  A source row goes to every variable
    it is an operand of.  Single-field variables stay where they are; operands
    of combined variables meet by ``keys``.
    """
    tagged = (
        df.withColumn("_tag", F.explode(_operand_tags(specs)))
        .filter(F.col("_tag").isNotNull())
        .select(*keys, F.col("_tag.variable").alias("variable"), F.col("_tag.operand").alias("_n"), F.col(value).alias("_v"))
    )

    simple = [s for s in specs if len(s.fields) == 1]
    joint = [s for s in specs if len(s.fields) > 1]
    parts = []
    if simple:
        body = tagged.filter(F.col("variable").isin([s.short for s in simple])) if joint else tagged
        v = F.col("_v")
        chain = v
        for s in simple:
            if s.post is not None:
                chain = F.when(F.col("variable") == s.short, s.post(v)).otherwise(chain)
        parts.append(body.select(*keys, "variable", chain.alias("value")))
    if joint:
        width = max(len(s.fields) for s in joint)
        body = tagged.filter(F.col("variable").isin([s.short for s in joint]))
        wide = body.groupBy(*keys, "variable").agg(
            *[F.max(F.when(F.col("_n") == n, F.col("_v"))).alias(f"_v{n}") for n in range(width)]
        )
        chain = F.lit(None).cast("double")
        for s in joint:
            folded = s.fold([F.col(f"_v{n}") for n in range(len(s.fields))])
            chain = F.when(F.col("variable") == s.short, s.post(folded) if s.post else folded).otherwise(chain)
        parts.append(wide.select(*keys, "variable", chain.alias("value")))
    return reduce(DataFrame.unionByName, parts)


def pivot_variables(df: DataFrame, keys: list[str], names: Sequence[str]) -> DataFrame:
    """One column per variable, with the column list given up front."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col("variable") == n, F.col("value"))).alias(n) for n in names]
    )


def split_layers(df: DataFrame, keys: list[str], variable: str, layer: str, n_layers: int) -> DataFrame:
    """A multi-layer variable as one column per layer: ``name0``, ``name1``, ..."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(layer) == k, F.col(variable))).alias(f"{variable}{k}") for k in range(n_layers)]
    )


# --- which fields are there -------------------------------------------------

_IDENTITY = ["field_name", "stash", "cell_methods", "dims"]


def inventory(df: DataFrame, by: list[str]) -> DataFrame:
    """Distinct source fields of each ``by`` group with their units."""
    return df.groupBy(*by, *_IDENTITY).agg(F.min("units").alias("units"))


def count_matches(inv: DataFrame, specs: Sequence[VariableSpec], by: list[str]) -> DataFrame:
    """How many fields each operand of each variable matches: ``n_matches``."""
    rows = [(s.short, n, r) for s in specs for n, r in enumerate(s.fields)]
    counted = inv.groupBy(*by).agg(*[F.count_if(r.predicate()).alias(f"_m{k}") for k, (_, _, r) in enumerate(rows)])
    out = F.array(
        *[
            F.struct(F.lit(s).alias("variable"), F.lit(n).alias("operand"), F.col(f"_m{k}").alias("n_matches"))
            for k, (s, n, _) in enumerate(rows)
        ]
    )
    return counted.select(*by, F.inline(out))


class FieldMismatch(ValueError):
    """Some operand matches no field, or more than one."""


def require_exactly_one(inv: DataFrame, specs: Sequence[VariableSpec], by: list[str]) -> None:
    """Raise with the list of operands that do not match exactly one field.

    At most groups x operands rows of metadata are looked at.
    """
    bad = count_matches(inv, specs, by).filter(F.col("n_matches") != 1).collect()
    if bad:
        raise FieldMismatch("; ".join(sorted(mismatch_text(r) for r in bad)))


def mismatch_text(r) -> str:
    return f"operand {r.operand} of {r.variable} has {r.n_matches} matches where it needs one"


def variable_catalog(inv: DataFrame, specs: Sequence[VariableSpec], by: list[str]) -> DataFrame:
    """Name, units and attributes of every variable that is present.

    Units and source names come from the first operand unless the spec says
    otherwise; ``attrs`` is a map of the remaining attributes.
    """
    aggs, rows = [], []
    for k, s in enumerate(specs):
        for n, r in enumerate(s.fields):
            aggs.append(F.min(F.when(r.predicate(), F.struct("field_name", "units"))).alias(f"_f{k}_{n}"))
        sources = F.array(*[F.col(f"_f{k}_{n}.field_name") for n in range(len(s.fields))])
        extra = [F.lit(x) for kv in s.attrs.items() for x in kv]
        present = reduce(lambda a, b: a & b, [F.col(f"_f{k}_{n}").isNotNull() for n in range(len(s.fields))])
        rows.append(
            F.when(
                present,
                F.struct(
                    F.lit(s.short).alias("variable_id"),
                    F.lit(s.long).alias("standard_name"),
                    F.lit(s.long).alias("long_name"),
                    F.coalesce(F.lit(s.units).cast("string"), F.col(f"_f{k}_0.units")).alias("units"),
                    sources.alias("source_names"),
                    (F.create_map(*extra) if extra else F.create_map().cast("map<string,string>")).alias("attrs"),
                ),
            )
        )
    return inv.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array_compact(F.array(*rows))))
