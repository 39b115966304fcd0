"""Declarative data-quality tests.

Each test returns a *failing-rows* DataFrame (lazy); ``verdict`` reduces one to
``(failures, should_warn, should_error)``.  Multi-column tests run as one scan
(an ``explode`` of per-row NULL flags, or one ``GROUPING SETS`` aggregate)
instead of a union of per-column scans.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import scoped
from .joins import orphans


def not_null(df: DataFrame, column: str, where: str | Column | None = None, store_failures: bool = True) -> DataFrame:
    """Rows where ``column`` is NULL (all columns when storing failures, else just the column)."""
    d = scoped(df, where).filter(F.col(column).isNull())
    return d if store_failures else d.select(column)


def unique(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Non-NULL values occurring more than once: ``(unique_field, n_records)``."""
    d = scoped(df, where).filter(F.col(column).isNotNull())
    return (d.groupBy(F.col(column).alias("unique_field")).agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence, where: str | Column | None = None) -> DataFrame:
    """Values outside ``values``: ``(value_field, n_records)``.  NULL passes (``NOT IN`` is unknown)."""
    d = scoped(df, where)
    counts = d.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.filter(~F.col("value_field").isin(*values))


def relationships(df: DataFrame, column: str, to: DataFrame, field: str,
                  where: str | Column | None = None) -> DataFrame:
    """Non-NULL child keys with no parent row, duplicates kept: ``(from_field)``."""
    child = scoped(df, where).select(F.col(column).alias("from_field"))
    return orphans(child, to.select(F.col(field).alias("to_field")), "from_field", "to_field")


def _filtered(columns: Iterable[str], skip: Iterable[str]) -> list[str]:
    skip = set(skip)
    return [c for c in columns if c not in skip]


def aggregated_not_null(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = (),
                        where: str | Column | None = None) -> DataFrame:
    """One row per NULL cell, labelled by ``column_name``; one scan for all columns."""
    cols = _filtered(columns, skip)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string")
    d = scoped(df, where)
    flags = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (d.select(F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("column_name")))


def aggregated_unique(df: DataFrame, columns: Sequence[str], skip: Sequence[str] = (),
                      where: str | Column | None = None) -> DataFrame:
    """Duplicated non-NULL values per column: ``(column_name, unique_field, n_records)``.

    One ``GROUPING SETS`` aggregate (Expand + partial hash aggregate): every
    column is cast to text first so values of different types share one column.
    """
    cols = _filtered(columns, skip)
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, unique_field string, n_records bigint")
    d = scoped(df, where).select(*[F.col(c).cast("string").alias(f"__u{i}") for i, c in enumerate(cols)])
    names = [f"__u{i}" for i in range(len(cols))]
    label = None
    for i, c in enumerate(cols):
        cond = F.grouping(names[i]) == 0
        label = F.when(cond, F.lit(c)) if label is None else label.when(cond, F.lit(c))
    g = d.groupingSets([[n] for n in names], *names).agg(
        label.alias("column_name"), F.coalesce(*[F.col(n) for n in names]).alias("unique_field"),
        F.count(F.lit(1)).alias("n_records"))
    return g.filter((F.col("n_records") > 1) & F.col("unique_field").isNotNull()).select(
        "column_name", "unique_field", "n_records")


def verdict(fails: DataFrame, fail_calc: str = "count(*)", warn_if: str = "!= 0", error_if: str = "!= 0",
            limit: int | None = None) -> DataFrame:
    """``(failures, should_warn, should_error)`` from a failing-rows frame (one aggregate)."""
    src = fails.limit(limit) if limit is not None else fails
    fc = F.expr(fail_calc)
    one = src.agg(fc.alias("failures"))
    return one.select("failures", F.expr(f"failures {warn_if}").alias("should_warn"),
                      F.expr(f"failures {error_if}").alias("should_error"))


def verdict_by_column(fails: DataFrame) -> DataFrame:
    """Per-column verdict for the aggregated tests: ``(column_name, failures, should_warn, should_error)``."""
    g = fails.groupBy("column_name").agg(F.count(F.lit(1)).alias("failures"))
    return g.select("column_name", "failures", (F.col("failures") > 0).alias("should_warn"),
                    (F.col("failures") > 0).alias("should_error")).orderBy("column_name")


def unit_diff(actual: DataFrame, expected: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Order-insensitive multiset diff over the expected columns.

    Returns the rows present on one side more often than on the other, labelled
    ``actual_or_expected``; an empty result means the test passes.
    """
    cols = list(columns) if columns is not None else expected.columns
    a = actual.select(*cols)
    e = expected.select(*cols)
    only_a = a.exceptAll(e).withColumn("actual_or_expected", F.lit("actual"))
    only_e = e.exceptAll(a).withColumn("actual_or_expected", F.lit("expected"))
    return only_a.unionByName(only_e)


def store_failures(fails: DataFrame, name: str, kind: str = "table", root: str | None = None) -> DataFrame:
    """Store a test's failing rows as a table or a view; the verdict is then read from it."""
    from .sinks import as_table, as_view

    if kind == "table":
        return as_table(fails, name, root=root)
    if kind == "view":
        return as_view(fails, name, full_refresh=True)
    raise ValueError(f"failures can be stored as 'table' or 'view', not {kind!r}")


def fixture(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """Typed fixture rows from dicts: missing columns are NULL, unknown columns are an error."""
    names = set(schema.names)
    for r in rows:
        extra = set(r) - names
        if extra:
            raise ValueError(f"fixture row has columns not in the model: {sorted(extra)}")
    data = [tuple(r.get(n) for n in schema.names) for r in rows]
    return spark.createDataFrame(data, schema)


def _type_family(t: T.DataType) -> str:
    return t.simpleString()


def assert_contract(df: DataFrame, declared: T.StructType | Sequence[tuple[str, str | None]],
                    warn=print) -> DataFrame:
    """Enforce a declared contract: same column count, names and types; result in declared order.

    ``declared`` is a StructType or ``[(name, type_string_or_None)]``; a missing type
    is an error, and a bare ``decimal`` (no precision) only warns.
    """
    if isinstance(declared, T.StructType):
        spec = [(f.name, f.dataType.simpleString()) for f in declared.fields]
    else:
        spec = list(declared)
    for name, typ in spec:
        if typ is None:
            raise ValueError(f"contract column {name!r} has no data_type")
        if typ.strip().lower() in ("decimal", "numeric"):
            warn(f"contract column {name!r}: bare {typ} has no precision/scale")
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    problems = []
    if len(actual) != len(spec):
        problems.append(f"column count {len(actual)} != declared {len(spec)}")
    for name, typ in spec:
        t = actual.get(name.lower())
        if t is None:
            problems.append(f"missing column {name}")
        elif typ.strip().lower() not in ("decimal", "numeric") and \
                T._parse_datatype_string(typ).simpleString() != t.simpleString():
            problems.append(f"{name}: {t.simpleString()} != declared {typ}")
    declared_names = {n.lower() for n, _ in spec}
    problems += [f"undeclared column {n}" for n in actual if n not in declared_names]
    if problems:
        raise ValueError("contract violated: " + "; ".join(problems))
    return df.select(*[F.col(n) for n, _ in spec])


def freshness(df: DataFrame, loaded_at: str, where: str | Column | None = None,
              now: Column | str | None = None) -> DataFrame:
    """``(max_loaded_at, snapshotted_at, age_seconds)`` of a source (optional filter)."""
    snap = F.current_timestamp() if now is None else (F.lit(now).cast("timestamp") if isinstance(now, str) else now)
    one = scoped(df, where).agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at"))
    return one.select("max_loaded_at", snap.alias("snapshotted_at"),
                      (F.unix_timestamp(snap) - F.unix_timestamp("max_loaded_at")).alias("age_seconds"))


def freshness_from(loaded_at_query: DataFrame, now: Column | str | None = None) -> DataFrame:
    """Custom-query freshness: ``loaded_at_query`` yields one value (the max load time)."""
    snap = F.current_timestamp() if now is None else (F.lit(now).cast("timestamp") if isinstance(now, str) else now)
    first = loaded_at_query.columns[0]
    return loaded_at_query.select(F.col(first).cast("timestamp").alias("max_loaded_at"), snap.alias("snapshotted_at"))


def assert_rows(df: DataFrame, at_least: int = 1) -> DataFrame:
    """``(row_count, at_least, passed)`` -- a load that brings fewer rows is not a success."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(at_least).cast("bigint").alias("at_least"),
        (F.col("row_count") >= at_least).alias("passed"))


def run_declared_tests(df: DataFrame, not_null_columns: Sequence[str]) -> DataFrame:
    """All not-null tests of one model in a single scan: ``(column_name, failures)``."""
    one = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in not_null_columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in not_null_columns)
    return one.selectExpr(f"stack({len(not_null_columns)}, {stack}) as (column_name, failures)")


def run_tests(tests: Sequence[tuple[str, DataFrame]], **verdict_opts) -> DataFrame:
    """Run named tests together: one verdict row per test ``(test_name, failures, should_warn,
    should_error)``.  The verdicts are a union of aggregates, so one action evaluates every
    test (their scans run as parallel stages of a single job)."""
    out = None
    for name, fails in tests:
        v = verdict(fails, **verdict_opts).select(F.lit(name).alias("test_name"), "*")
        out = v if out is None else out.unionByName(v)
    return out
