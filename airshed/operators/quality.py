"""Declarative data-quality suites, run in one pass, gating the load.

A suite is a list of expectations. ``run_suite`` evaluates every row-level
check inside ONE ``agg`` over the frame (a partial + final aggregate) and each
compound-uniqueness check with one map-side-combined ``groupBy``; column-set
checks read only the schema. The report is a small DataFrame with one row per
expectation: (expectation, column, severity, evaluated, unexpected, success).

Semantics per check (the NULL rules differ, so each keeps two counters):
* between / lower bound: NULLs are not evaluated; unexpected = outside bounds or NaN.
* pair A >= B: rows with both NULL are skipped; one NULL is unexpected.
* compound unique: rows with all keys NULL are skipped; every row of a
  repeated key is unexpected.
* not null: every row evaluated; max length: NULLs skipped.
success = evaluated == 0 or (evaluated - unexpected) / evaluated >= mostly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CRITICAL = "critical"
WARNING = "warning"
INFO = "info"
_RANK = {INFO: 0, WARNING: 1, CRITICAL: 2}


@dataclass(frozen=True)
class Expectation:
    kind: str  # columns_match_set | compound_unique | pair_ge | between | not_null | max_length | fits
    columns: tuple[str, ...]
    lo: float | None = None
    hi: float | None = None
    or_equal: bool = True
    mostly: float = 1.0
    severity: str = CRITICAL  # checks without an explicit severity are critical
    dtype: str | None = None  # declared type of ``fits``

    @property
    def name(self) -> str:
        return {
            "columns_match_set": "expect_table_columns_to_match_set",
            "compound_unique": "expect_compound_columns_to_be_unique",
            "pair_ge": "expect_column_pair_values_a_to_be_greater_than_b",
            "between": "expect_column_values_to_be_between",
            "not_null": "expect_column_values_to_not_be_null",
            "max_length": "expect_column_value_lengths_to_be_between",
            "fits": "expect_column_values_to_fit_declared_type",
        }[self.kind]

    @property
    def label(self) -> str:
        if self.kind == "columns_match_set":
            return "*"
        return ",".join(self.columns)


def columns_match_set(cols) -> Expectation:
    return Expectation("columns_match_set", tuple(cols))


def compound_unique(cols) -> Expectation:
    return Expectation("compound_unique", tuple(cols))


def pair_ge(a: str, b: str, or_equal: bool = True, mostly: float = 1.0, severity: str = CRITICAL) -> Expectation:
    return Expectation("pair_ge", (a, b), or_equal=or_equal, mostly=mostly, severity=severity)


def between(col: str, lo=None, hi=None, mostly: float = 1.0, severity: str = CRITICAL) -> Expectation:
    return Expectation("between", (col,), lo=lo, hi=hi, mostly=mostly, severity=severity)


def not_null(col: str, severity: str = CRITICAL) -> Expectation:
    return Expectation("not_null", (col,), severity=severity)


def max_length(col: str, n: int, severity: str = CRITICAL) -> Expectation:
    return Expectation("max_length", (col,), hi=n, severity=severity)


def fits(col: str, dtype: str, severity: str = CRITICAL) -> Expectation:
    """Values that the declared type can hold, rounded to its scale."""
    return Expectation("fits", (col,), severity=severity, dtype=dtype)


def declared_fit(spec, columns: list[str], scale: int | None = None) -> list[Expectation]:
    """A ``fits`` check for every measure of the spec among ``columns``."""
    return [fits(m, spec.decimal_of(m, scale).simpleString()) for m in spec.measure_names if m in columns]


# ---------------------------------------------------------------------------
# The pre-load suites (bounds, pairs, severities, column sets).
# ---------------------------------------------------------------------------

CLIMATE_COLUMNS = [
    "city_id", "date", "temperature_2m_max", "temperature_2m_mean", "temperature_2m_min",
    "relative_humidity_2m_max", "relative_humidity_2m_mean", "relative_humidity_2m_min",
    "cloud_cover_mean", "soil_moisture_0_to_10cm_mean", "wind_speed_10m_mean", "wind_speed_10m_max",
    "shortwave_radiation_sum", "soil_moisture_0_to_10cm_mean", "precipitation_sum", "rain_sum",
    "snowfall_sum", "river_discharge", "pressure_msl_mean",
]
CLIMATE_SUITE = [
    columns_match_set(CLIMATE_COLUMNS),
    compound_unique(["city_id", "date"]),
    pair_ge("temperature_2m_max", "temperature_2m_mean", severity=WARNING),
    pair_ge("temperature_2m_mean", "temperature_2m_min", severity=WARNING),
    pair_ge("relative_humidity_2m_max", "relative_humidity_2m_mean", severity=WARNING),
    pair_ge("relative_humidity_2m_mean", "relative_humidity_2m_min", severity=WARNING),
    between("relative_humidity_2m_max", 0, 100),
    between("relative_humidity_2m_min", 0, 100),
    between("relative_humidity_2m_mean", 0, 100),
    between("cloud_cover_mean", 0, 100),
    between("soil_moisture_0_to_10cm_mean", 0, 1),
    between("wind_speed_10m_mean", 0, None),
    between("wind_speed_10m_max", 0, None),
    between("shortwave_radiation_sum", 0, None),
    between("soil_moisture_0_to_10cm_mean", 0, None),
    between("precipitation_sum", 0, None),
    between("rain_sum", 0, None),
    between("snowfall_sum", 0, None),
]

AIR_QUALITY_COLUMNS = [
    "city_id", "date", "pm2_5_mean", "pm10_mean", "nitrogen_dioxide_1h_max", "sulphur_dioxide_1h_max",
    "ozone_8h_max", "carbon_dioxide_mean", "carbon_monoxide_8h_max",
]
AIR_QUALITY_SUITE = [
    columns_match_set(AIR_QUALITY_COLUMNS),
    compound_unique(["city_id", "date"]),
    *[between(c, 0, None) for c in AIR_QUALITY_COLUMNS[2:]],
]

LAND_SURFACE_COLUMNS = [
    "city_id", "date", "surface_pressure", "total_precipitable_water", "sea_level_pressure",
    "land_surface_temp", "root_zone_soil_wetness", "surface_longwave_downward_irradiance",
    "surface_shortwave_upward_irradiance", "surface_longwave_upward_irradiance",
    "total_solar_irradiance", "all_sky_surface_albedo",
]
LAND_SURFACE_SUITE = [
    columns_match_set(LAND_SURFACE_COLUMNS),
    compound_unique(["city_id", "date"]),
    between("land_surface_temp", -125, 80),
    between("total_precipitable_water", 0, 100),
    between("root_zone_soil_wetness", 0, 1),
    between("all_sky_surface_albedo", 0, 1),
    between("surface_pressure", 500, 1100),
    between("sea_level_pressure", 500, 1100),
    between("surface_longwave_downward_irradiance", 0, 1500),
    between("surface_shortwave_upward_irradiance", 0, 1500),
    between("surface_longwave_upward_irradiance", 0, 1500),
    between("total_solar_irradiance", 0, 1500),
]

SUITES = {"climate": CLIMATE_SUITE, "air_quality": AIR_QUALITY_SUITE, "land_surface": LAND_SURFACE_SUITE}

# ---------------------------------------------------------------------------

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("expectation", T.StringType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("evaluated", T.LongType(), True),
        T.StructField("unexpected", T.LongType(), True),
    ]
)


def _row_counters(e: Expectation) -> tuple[Column, Column]:
    """(evaluated, unexpected) as aggregate expressions for a row-level check."""
    if e.kind == "between":
        x = F.col(e.columns[0])
        bad = F.lit(False)
        if e.lo is not None:
            bad = bad | (x < F.lit(e.lo))
        if e.hi is not None:
            bad = bad | (x > F.lit(e.hi))
        bad = bad | F.isnan(x.cast("double"))  # NaN is within no bounds
        return F.count(x), F.count_if(x.isNotNull() & bad)
    if e.kind == "pair_ge":
        a, b = F.col(e.columns[0]), F.col(e.columns[1])
        seen = a.isNotNull() | b.isNotNull()
        good = (a >= b) if e.or_equal else (a > b)
        return F.count_if(seen), F.count_if(seen & ~F.coalesce(good, F.lit(False)))
    if e.kind == "not_null":
        x = F.col(e.columns[0])
        return F.count(F.lit(1)), F.count_if(x.isNull())
    if e.kind == "max_length":
        x = F.col(e.columns[0])
        return F.count(x), F.count_if(F.length(x) > F.lit(int(e.hi)))
    if e.kind == "fits":
        x = F.nanvl(F.col(e.columns[0]).cast("double"), F.lit(None).cast("double"))  # NaN is loaded as NULL
        return F.count(x), F.count_if(x.isNotNull() & x.try_cast(e.dtype).isNull())
    raise ValueError(e.kind)


def _unique_counters(df: DataFrame, cols: tuple[str, ...]) -> DataFrame:
    some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
    per_key = df.filter(some).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("evaluated"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("unexpected"),
    )


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """Evaluate ``suite`` on ``df``; one report row per expectation, in suite order."""
    spark: SparkSession = df.sparkSession
    parts: list[DataFrame] = []
    meta_rows = []
    row_checks = []
    for i, e in enumerate(suite):
        if e.kind == "columns_match_set":
            want, have = set(e.columns), set(df.columns)
            meta_rows.append((i, e.name, e.label, e.severity, len(want), len(want ^ have)))
        elif e.kind == "compound_unique":
            u = _unique_counters(df, e.columns)
            parts.append(
                u.select(
                    F.lit(i).alias("idx"), F.lit(e.name).alias("expectation"), F.lit(e.label).alias("column"),
                    F.lit(e.severity).alias("severity"), "evaluated", "unexpected",
                )
            )
        else:
            row_checks.append((i, e))
    if row_checks:
        aggs = []
        for i, e in row_checks:
            ev, un = _row_counters(e)
            aggs += [ev.cast("long").alias(f"e{i}"), un.cast("long").alias(f"u{i}")]
        wide = df.agg(*aggs)
        stack = ", ".join(
            f"{i}, '{e.name}', '{e.label}', '{e.severity}', e{i}, u{i}" for i, e in row_checks
        )
        parts.append(
            wide.selectExpr(
                f"stack({len(row_checks)}, {stack}) as (idx, expectation, `column`, severity, evaluated, unexpected)"
            )
        )
    if meta_rows:
        parts.append(spark.createDataFrame(meta_rows, REPORT_SCHEMA))
    report = reduce(lambda a, b: a.unionByName(b), [p.select(*REPORT_SCHEMA.fieldNames()) for p in parts])
    mostly = F.create_map(*[x for i, e in enumerate(suite) for x in (F.lit(i), F.lit(float(e.mostly)))])
    ok = (F.col("evaluated") == 0) | (
        (F.col("evaluated") - F.col("unexpected")) / F.col("evaluated") >= mostly[F.col("idx")]
    )
    return report.withColumn("success", ok)


def checked_write(
    df: DataFrame,
    suite: list[Expectation],
    write: Callable[[DataFrame], None],
    layout: list[str],
    keep: Column | None = None,
    counts: dict[str, Column] | None = None,
) -> tuple[list[dict], dict[str, int]]:
    """Write ``df`` laid out by ``layout`` and evaluate ``suite`` on the rows
    written, in one scan and the one shuffle that the layout needs.

    The counters are observed metrics of the writing stage, behind the shuffle:
    what runs before it (the sampling of range bounds, a stage run again after
    an executor was lost) would be counted twice there. Range partitioning puts
    equal layout keys side by side in one task, so uniqueness of just these
    columns is counted over the rows as they pass. ``keep`` restricts what is
    written and checked; ``counts`` are further aggregates, over all rows.
    Returns the report's rows and ``counts``.
    """
    flags: dict[str, Column] = {}
    observed: list[Column] = []
    report: dict[int, tuple[int, int] | None] = {}
    keep = F.lit(True) if keep is None else keep
    for i, e in enumerate(suite):
        if e.kind == "columns_match_set":
            report[i] = len(set(e.columns)), len(set(e.columns) ^ set(df.columns))
        elif e.kind == "compound_unique":
            if set(e.columns) != set(layout):
                raise ValueError(f"uniqueness of {e.columns} can't be counted in the layout {layout}")
            flags["_same"] = F.count(F.when(keep, 1)).over(Window.partitionBy(*layout))
            some = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in e.columns])
            observed += [F.count_if(keep & some).alias(f"e{i}"), F.count_if(keep & some & (F.col("_same") > 1)).alias(f"u{i}")]
    row_checks = [(i, e) for i, e in enumerate(suite) if e.kind not in ("columns_match_set", "compound_unique")]
    laid = df.repartitionByRange(*layout).sortWithinPartitions(*layout).withColumns(flags)
    first, then = Observation(), Observation()
    if observed or counts:
        laid = laid.observe(first, *observed, *[c.alias(n) for n, c in (counts or {}).items()])
    laid = laid.filter(keep).drop(*flags)
    if row_checks:
        metrics = [c.alias(f"{side}{i}") for i, e in row_checks for side, c in zip("eu", _row_counters(e))]
        laid = laid.observe(then, *metrics)
    write(laid)
    got = {**(first.get if observed or counts else {}), **(then.get if row_checks else {})}
    rows = []
    for i, e in enumerate(suite):
        evaluated, unexpected = report.get(i) or (got[f"e{i}"], got[f"u{i}"])
        success = evaluated == 0 or (evaluated - unexpected) / evaluated >= e.mostly
        rows.append({"idx": i, "expectation": e.name, "column": e.label, "severity": e.severity, "evaluated": evaluated, "unexpected": unexpected, "success": success})
    return rows, {n: got[n] for n in counts or {}}


def gate(report: DataFrame | list, block_on: str = CRITICAL) -> list[dict]:
    """Raise when any failed expectation is at least ``block_on`` severe.

    Returns the failed rows (warnings included) when the load may proceed.
    """
    rows = report.collect() if isinstance(report, DataFrame) else report
    failed = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in rows if not r["success"]]
    worst = max((_RANK.get(f["severity"], _RANK[CRITICAL]) for f in failed), default=-1)
    if worst >= _RANK[block_on]:
        blocking = [f for f in failed if _RANK.get(f["severity"], 2) >= _RANK[block_on]]
        names = [f"{f['expectation']}({f['column']}): {f['unexpected']} of {f['evaluated']}" for f in blocking]
        raise DataQualityError(f"validation failed: {names}")
    return failed


class DataQualityError(RuntimeError):
    pass


def orphans(fact: DataFrame, dim: DataFrame, key: str = "city_id", dim_key: str | None = None) -> DataFrame:
    """Fact rows whose key has no row in ``dim`` (foreign-key violations).

    NULL keys are not violations (a NULL foreign key is allowed by SQL). The
    fact keys are deduplicated first (a hot key collapses on the map side) and
    anti-joined with the dimension; the orphan keys, none or few in sound data,
    select their fact rows. The planner picks each join by its sides' bytes.
    """
    keys = dim.select(F.col(dim_key or key).alias(key)).distinct()
    facts = fact.filter(F.col(key).isNotNull())
    missing = facts.select(key).distinct().join(keys, key, "left_anti")
    return facts.join(missing, key, "left_semi")


def cities_store_suite() -> list[Expectation]:
    """Store constraints of the city dimension: NOT NULL, PK, unique (lat, lng), lengths."""
    from airshed.schemas import CITY_NOT_NULL, CITY_STRING_LENGTHS

    return (
        [not_null(c) for c in CITY_NOT_NULL]
        + [compound_unique(["city_id"]), compound_unique(["lat", "lng"])]
        + [max_length(c, n) for c, n in CITY_STRING_LENGTHS.items()]
    )
