"""Mapping and completeness reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.operators.mapping import VariableSpec

# The columns of the delivered report.
REPORT_COLUMNS = [
    "expt", "store", "variable_id", "standard_name", "units", "is_present",
    "cube_name", "stash_code", "extra_attrs", "extra_processing",
]


def mapping_report(
    spark: SparkSession, inv: DataFrame, experiments: dict[str, Sequence[tuple[str, VariableSpec]]]
) -> DataFrame:
    """What every variable of every experiment is made of, and if it is there.

    ``inv`` is the field inventory with an ``expt`` column.  ``experiments``
    maps each experiment to its ``(store, spec)`` list.  Experiments share
    most rules, so each distinct rule is counted once per experiment.
    """
    rules = list(dict.fromkeys(r for specs in experiments.values() for _, s in specs for r in s.fields))
    slot = {r: k for k, r in enumerate(rules)}
    aggs = []
    for k, rule in enumerate(rules):
        hit = rule.predicate()
        aggs.append(F.count_if(hit).alias(f"n{k}"))
        aggs.append(F.min(F.when(hit, F.struct("field_name", "stash", "units"))).alias(f"f{k}"))
    found = inv.groupBy("expt").agg(*aggs)

    def row(store: str, s: VariableSpec):
        ks = [slot[r] for r in s.fields]
        present = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"n{k}") == 1, F.lit(False)) for k in ks])

        def expression(part: str):
            terms = [F.col(f"f{ks[0]}.{part}")]
            for op, k in zip(s.ops, ks[1:]):
                terms += [F.lit(op), F.col(f"f{k}.{part}")]
            return F.when(present, F.concat_ws(" ", *terms))

        units = F.coalesce(F.lit(s.units).cast("string"), F.col(f"f{ks[0]}.units"))
        return F.struct(
            F.lit(store).alias("store"),
            F.lit(s.short).alias("variable_id"),
            F.lit(s.long).alias("standard_name"),
            F.when(present, units).alias("units"),
            present.alias("is_present"),
            expression("field_name").alias("cube_name"),
            expression("stash").alias("stash_code"),
            F.lit(str(dict(s.attrs))).alias("extra_attrs"),
            F.lit(s.post_name).cast("string").alias("extra_processing"),
        )

    # Experiments with the same spec list share one branch.
    groups: dict[tuple, list[str]] = {}
    for expt, specs in experiments.items():
        ident = tuple((st, s.short, s.long, s.fields, s.ops, s.units, str(s.attrs), s.post_name) for st, s in specs)
        groups.setdefault(ident, []).append(expt)
    names = spark.createDataFrame([(e,) for e in experiments], "expt string")
    whole = names.join(found, "expt", "left")
    parts = []
    for members in groups.values():
        specs = experiments[members[0]]
        table = F.array(*[row(store, s) for store, s in specs])
        parts.append(whole.filter(F.col("expt").isin(members)).select("expt", F.inline(table)))
    return reduce(DataFrame.union, parts)


def same_everywhere(report: DataFrame) -> DataFrame:
    """Report rows that are equal in all experiments, once each."""
    cols = [c for c in report.columns if c != "expt"]
    total = F.broadcast(report.agg(F.count_distinct("expt").alias("n_same")))  # one row
    same = report.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_same"))
    return same.join(total, "n_same", "left_semi").select(*cols)


def differs_somewhere(report: DataFrame) -> DataFrame:
    """All rows of the variables that differ, or are absent, in any experiment."""
    cols = [c for c in report.columns if c != "expt"]
    total = F.broadcast(report.agg(F.count_distinct("expt").alias("n_same")))  # one row
    counted = report.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_same"))
    partly = counted.join(total, "n_same", "left_anti").select("variable_id")
    absent = report.filter(~F.col("is_present")).select("variable_id")
    return report.join(partly.union(absent).distinct(), "variable_id", "left_semi").select(*report.columns)


def completeness_report(
    manifest: DataFrame,
    created: DataFrame,
    regridded: DataFrame,
    coarsened: DataFrame,
    expected_inputs: int,
    coarsen_jobs: int,
    experiments: DataFrame | None = None,
) -> DataFrame:
    """Share of inputs, regridding and coarsening done, per experiment.

    ``experiments`` holds the ``sim`` of every configured experiment; those
    without any input show 0.  By default all that occur in some input.

    All inputs hold a ``sim`` column: one row per complete cycle, per created
    dataset, per regridded cycle and per coarsened time chunk.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("sim").agg(F.count(F.lit(1)).alias(name))

    inputs = (manifest, created, regridded, coarsened)
    out = experiments if experiments is not None else reduce(DataFrame.union, [df.select("sim") for df in inputs])
    out = out.select("sim").distinct()
    for df, name in zip(inputs, ("_inputs", "_made", "num_regrids_done", "_coarsened")):
        out = out.join(counted(df, name), "sim", "left")

    def percent(part, whole):
        return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))

    zero = F.lit(0).cast("bigint")
    done, seen = F.coalesce("num_regrids_done", zero), F.coalesce("_inputs", zero)
    return out.select(
        "sim",
        F.lit(expected_inputs).cast("bigint").alias("expected_num_inputs"),
        seen.alias("num_inputs"),
        F.col("_made").isNotNull().alias("created"),
        done.alias("num_regrids_done"),
        percent(F.coalesce("_coarsened", zero), F.lit(coarsen_jobs)).alias("coarsen"),
        percent(seen, F.lit(expected_inputs)).alias("inputs"),
        percent(done, seen).alias("regrid"),
    ).orderBy(F.desc("regrid"), F.desc("coarsen"), F.desc("inputs"), "sim")
