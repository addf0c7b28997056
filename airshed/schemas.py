"""Table specs, variable lists and declared column types.

Everything that must equal the source pipeline's contract lives here, stated
once as plain data. Schemas are always explicit: nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

KEYS = ("date", "city_id")
SENTINEL = -999

# ---------------------------------------------------------------------------
# Fixed values (must match the source pipeline exactly; natural order kept).
# ---------------------------------------------------------------------------

# Daily climate variables, in feed order.
CLIMATE_VARS = [
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "cloud_cover_mean",
    "relative_humidity_2m_max",
    "relative_humidity_2m_min",
    "relative_humidity_2m_mean",
    "soil_moisture_0_to_10cm_mean",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "wind_speed_10m_mean",
    "wind_speed_10m_max",
    "pressure_msl_mean",
    "shortwave_radiation_sum",
]

# River discharge feed (daily, one variable).
DISCHARGE_VARS = ["river_discharge"]

# Hourly air-quality variables, in feed order.
AIR_QUALITY_VARS = [
    "pm10",
    "pm2_5",
    "carbon_monoxide",
    "nitrogen_dioxide",
    "sulphur_dioxide",
    "ozone",
    "carbon_dioxide",
]

# Land-surface variables, in request order.
LAND_SURFACE_VARS = [
    "PS",
    "TS",
    "TQV",
    "SLP",
    "GWETROOT",
    "ALLSKY_SFC_LW_DWN",
    "ALLSKY_SFC_SW_UP",
    "ALLSKY_SFC_LW_UP",
    "TOA_SW_DWN",
    "ALLSKY_SRF_ALB",
]

# Coded land-surface name -> descriptive target column.
LAND_SURFACE_RENAME = {
    "PS": "surface_pressure",
    "TQV": "total_precipitable_water",
    "SLP": "sea_level_pressure",
    "TS": "land_surface_temp",
    "GWETROOT": "root_zone_soil_wetness",
    "ALLSKY_SFC_LW_DWN": "surface_longwave_downward_irradiance",
    "ALLSKY_SFC_SW_UP": "surface_shortwave_upward_irradiance",
    "ALLSKY_SFC_LW_UP": "surface_longwave_upward_irradiance",
    "TOA_SW_DWN": "total_solar_irradiance",
    "ALLSKY_SRF_ALB": "all_sky_surface_albedo",
}

# Target measures with declared (precision, scale), in table order.
DAILY_CLIMATE_MEASURES = [
    ("temperature_2m_max", 6, 2),
    ("temperature_2m_min", 6, 2),
    ("temperature_2m_mean", 6, 2),
    ("cloud_cover_mean", 5, 2),
    ("relative_humidity_2m_max", 5, 2),
    ("relative_humidity_2m_min", 5, 2),
    ("relative_humidity_2m_mean", 5, 2),
    ("soil_moisture_0_to_10cm_mean", 8, 5),
    ("precipitation_sum", 8, 2),
    ("rain_sum", 8, 2),
    ("snowfall_sum", 8, 2),
    ("wind_speed_10m_mean", 7, 2),
    ("wind_speed_10m_max", 7, 2),
    ("pressure_msl_mean", 8, 2),
    ("shortwave_radiation_sum", 10, 2),
    ("river_discharge", 12, 2),
]

DAILY_AIR_QUALITY_MEASURES = [
    ("pm2_5_mean", 8, 2),
    ("pm10_mean", 8, 2),
    ("carbon_dioxide_mean", 10, 2),
    ("ozone_8h_max", 10, 2),
    ("carbon_monoxide_8h_max", 10, 2),
    ("nitrogen_dioxide_1h_max", 10, 2),
    ("sulphur_dioxide_1h_max", 10, 2),
]

DAILY_LAND_SURFACE_MEASURES = [
    ("surface_pressure", 10, 2),
    ("total_precipitable_water", 10, 2),
    ("sea_level_pressure", 10, 2),
    ("land_surface_temp", 8, 2),
    ("root_zone_soil_wetness", 8, 4),
    ("surface_longwave_downward_irradiance", 10, 2),
    ("surface_shortwave_upward_irradiance", 10, 2),
    ("surface_longwave_upward_irradiance", 10, 2),
    ("total_solar_irradiance", 10, 2),
    ("all_sky_surface_albedo", 6, 4),
]

# Chunk size used when batching cities into requests; number of cities per run.
CHUNK_SIZE = 50
CITIES_PER_RUN = 100

# City dimension columns (declared lengths for VARCHAR/CHAR checks) and NOT NULL columns.
CITY_STRING_LENGTHS = {
    "city": 100,
    "city_ascii": 100,
    "country": 100,
    "iso2": 2,
    "iso3": 3,
    "admin_name": 100,
    "capital": 20,
}
CITY_NOT_NULL = ["city_id", "city", "lat", "lng", "country"]

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """A keyed target table: keys, measures with declared decimals."""

    name: str
    keys: tuple[str, ...]
    measures: tuple[tuple[str, int, int], ...]
    created_col: str | None = "created_at"
    extra: tuple[T.StructField, ...] = field(default_factory=tuple)

    @property
    def measure_names(self) -> list[str]:
        return [m for m, _, _ in self.measures]

    @property
    def columns(self) -> list[str]:
        return list(self.keys) + self.measure_names

    def decimal_of(self, name: str, scale: int | None = None) -> T.DecimalType:
        for m, p, s in self.measures:
            if m == name:
                if scale is None:
                    return T.DecimalType(p, s)
                return T.DecimalType(38, scale)
        raise KeyError(name)

    def schema(self, scale: int | None = None, with_created: bool = True) -> T.StructType:
        fields = [
            T.StructField("date", T.DateType(), False)
            if k == "date"
            else T.StructField(k, T.LongType(), False)
            for k in self.keys
        ]
        fields += [T.StructField(m, self.decimal_of(m, scale), True) for m in self.measure_names]
        fields += list(self.extra)
        if with_created and self.created_col:
            fields.append(T.StructField(self.created_col, T.TimestampType(), True))
        return T.StructType(fields)


DAILY_CLIMATE = TableSpec("daily_climate", KEYS, tuple(DAILY_CLIMATE_MEASURES))
DAILY_AIR_QUALITY = TableSpec("daily_air_quality", KEYS, tuple(DAILY_AIR_QUALITY_MEASURES))
DAILY_LAND_SURFACE = TableSpec("daily_land_surface", KEYS, tuple(DAILY_LAND_SURFACE_MEASURES))
TABLES = {t.name: t for t in (DAILY_CLIMATE, DAILY_AIR_QUALITY, DAILY_LAND_SURFACE)}

CITIES_SCHEMA = T.StructType(
    [
        T.StructField("city_id", T.LongType(), False),
        T.StructField("city", T.StringType(), False),
        T.StructField("city_ascii", T.StringType(), True),
        T.StructField("lat", T.DecimalType(9, 6), False),
        T.StructField("lng", T.DecimalType(9, 6), False),
        T.StructField("country", T.StringType(), False),
        T.StructField("iso2", T.StringType(), True),
        T.StructField("iso3", T.StringType(), True),
        T.StructField("admin_name", T.StringType(), True),
        T.StructField("capital", T.StringType(), True),
        T.StructField("population", T.LongType(), True),
    ]
)

# Raw city list as it comes in the CSV (population may be fractional text).
WORLD_CITIES_CSV_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType(), True),
        T.StructField("city_ascii", T.StringType(), True),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lng", T.DoubleType(), True),
        T.StructField("country", T.StringType(), True),
        T.StructField("iso2", T.StringType(), True),
        T.StructField("iso3", T.StringType(), True),
        T.StructField("admin_name", T.StringType(), True),
        T.StructField("capital", T.StringType(), True),
        T.StructField("population", T.DoubleType(), True),
        T.StructField("id", T.LongType(), True),
    ]
)

CITY_CHUNK_SCHEMA = T.StructType(
    [
        T.StructField("city_id", T.LongType(), False),
        T.StructField("lat", T.DoubleType(), True),
        T.StructField("lng", T.DoubleType(), True),
        T.StructField("chunk_id", T.IntegerType(), False),
        T.StructField("pos", T.IntegerType(), False),
    ]
)


def raw_series_schema(variables: list[str]) -> T.StructType:
    """A raw series response: header + one float vector per variable."""
    return T.StructType(
        [
            T.StructField("chunk_id", T.IntegerType(), False),
            T.StructField("pos", T.IntegerType(), False),
            T.StructField("start_s", T.LongType(), False),
            T.StructField("end_s", T.LongType(), False),
            T.StructField("interval_s", T.IntegerType(), False),
        ]
        + [T.StructField(v, T.ArrayType(T.FloatType(), True), True) for v in variables]
    )


RAW_LAND_SURFACE_SCHEMA = T.StructType(
    [T.StructField("city_id", T.LongType(), False), T.StructField("body", T.StringType(), True)]
)

# properties.parameter: VAR -> (yyyymmdd -> value)
LAND_SURFACE_BODY_SCHEMA = T.StructType(
    [
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField(
                        "parameter",
                        T.MapType(T.StringType(), T.MapType(T.StringType(), T.DoubleType())),
                        True,
                    )
                ]
            ),
            True,
        )
    ]
)
