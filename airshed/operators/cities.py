"""City dimension operators: clean-up, dedup, top-k, chunking, request batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airshed.functions.clean import cast_integral
from airshed.operators.ordinal import with_ordinal
from airshed.schemas import CHUNK_SIZE, CITIES_PER_RUN


def scan_position(df: DataFrame, out: str = "_pos") -> DataFrame:
    """Attach the file order of each row; call directly on a file scan.

    (file path, split start, id within the split) sorts exactly as the rows
    appear in the files, for any file format and any split layout.
    """
    return df.withColumn(
        out,
        F.struct(
            F.col("_metadata.file_path").alias("f"),
            F.col("_metadata.file_block_start").alias("b"),
            F.monotonically_increasing_id().alias("i"),
        ),
    )


def dedup_first(df: DataFrame, subset: list[str], order: str | Column = "_pos") -> DataFrame:
    """Keep the first row (smallest ``order``) of each ``subset`` group.

    ``min_by`` is a plain aggregate: each map task reduces its share of a group
    to one row before the shuffle, so a group holding a third of all rows costs
    no more than any other. NULLs in ``subset`` form one group; a NULL ``order`` comes last.
    """
    order_col = F.col(order) if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in subset]
    picked = df.groupBy(*subset).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), F.struct(order_col.isNull(), order_col)).alias("_row"))
    return picked.select(*[F.col(c) for c in subset], *[F.col(f"_row.{c}").alias(c) for c in rest]).select(
        *df.columns
    )


def clean_cities(raw: DataFrame, order: str | Column = "_pos") -> DataFrame:
    """Raw city list -> cities: dedup on (lat, lng) keeping the first row,
    population as a nullable integer (a fractional value is an error),
    ``id`` renamed to ``city_id``."""
    if "_pos" not in raw.columns and isinstance(order, str) and order == "_pos":
        raw = scan_position(raw)
    out = dedup_first(raw, ["lat", "lng"], order)
    out = out.withColumn("population", cast_integral("population", "long"))
    out = out.withColumnRenamed("id", "city_id")
    return out.drop("_pos")


def top_cities(
    cities: DataFrame,
    country: str | None = None,
    n: int = CITIES_PER_RUN,
    by: str = "population",
    key: str = "city_id",
    cols: tuple[str, ...] = ("city_id", "lat", "lng"),
    country_col: str = "country",
) -> DataFrame:
    """Top ``n`` by ``by`` descending (NULLs last, ties by ``key``), optionally
    for one country. Without ``by`` it is the first ``n`` by key.

    Planned as TakeOrderedAndProject: each partition keeps its own top ``n``
    and only those reach the final merge.
    """
    df = cities if country is None else cities.filter(F.col(country_col) == F.lit(country))
    ordering = [F.col(key).asc()] if by is None else [F.col(by).desc_nulls_last(), F.col(key).asc()]
    return df.orderBy(*ordering).limit(n).select(*cols)


TOP_CITIES_SQL = """
SELECT city_id, lat, lng FROM {cities}
WHERE country = :country
ORDER BY population DESC NULLS LAST, city_id
LIMIT :n
"""


def top_cities_sql(spark, cities: DataFrame, country: str, n: int = CITIES_PER_RUN, query: str = TOP_CITIES_SQL) -> DataFrame:
    """The same top-k as a SQL text with bound parameters (``:country``, ``:n``).

    Values are bound, never spliced into the text; the predicate still reaches
    the Parquet scan as a pushed filter.
    """
    return spark.sql(query, args={"country": country, "n": n}, cities=cities)


def assign_chunks(
    df: DataFrame,
    order: list[str | Column],
    size: int = CHUNK_SIZE,
    chunk_col: str = "chunk_id",
    pos_col: str = "pos",
) -> DataFrame:
    """Fixed-size chunks in ``order``: chunk = position div size, pos = position mod size."""
    o = with_ordinal(df, order, out="_ord")
    return (
        o.withColumn(chunk_col, F.expr(f"_ord div {int(size)}").cast("int"))
        .withColumn(pos_col, (F.col("_ord") % int(size)).cast("int"))
        .drop("_ord")
    )


def request_batches(
    chunked: DataFrame,
    cols: tuple[str, ...] = ("city_id", "lat", "lng"),
    chunk_col: str = "chunk_id",
    pos_col: str = "pos",
    sep: str = ",",
) -> DataFrame:
    """Per chunk, one comma-joined list per column, all in ``pos`` order.

    A chunk has at most ``size`` rows by construction, so the lists are bounded.
    Fractional values (coordinates) are written plainly, with up to 6 places.
    """
    kinds = {f.name: f.dataType for f in chunked.schema.fields}

    def text(c: str) -> str:
        if not isinstance(kinds[c], (T.FractionalType, T.DecimalType)):
            return f"cast(`{c}` as string)"
        return rf"regexp_replace(cast(cast(`{c}` as decimal(9,6)) as string), r'\.?0+$', '')"

    aggs = [F.expr(f"listagg({text(c)}, '{sep}') within group (order by `{pos_col}`)").alias(f"{c}_list") for c in cols]
    return chunked.groupBy(chunk_col).agg(F.count(F.lit(1)).alias("n"), *aggs)
