"""Column groups, table schemas and derived feature names."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import types as T

# These column names are the data contract of the source files,
# the stage tables and the scoring requests.
TARGET = "target"
PERIOD = "Periodo"
PRICE = "Precio_leche"
TIME_COLS = ["anio", "mes"]
GDP_COLS = [
    "PIB_Agropecuario_silvicola",
    "PIB_Pesca",
    "PIB_Mineria",
    "PIB_Mineria_del_cobre",
    "PIB_Otras_actividades_mineras",
    "PIB_Industria_Manufacturera",
    "PIB_Alimentos",
    "PIB_Bebidas_y_tabaco",
    "PIB_Textil",
    "PIB_Maderas_y_muebles",
    "PIB_Celulosa",
    "PIB_Refinacion_de_petroleo",
    "PIB_Quimica",
    "PIB_Minerales_no_metalicos_y_metalica_basica",
    "PIB_Productos_metalicos",
    "PIB_Electricidad",
    "PIB_Construccion",
    "PIB_Comercio",
    "PIB_Restaurantes_y_hoteles",
    "PIB_Transporte",
    "PIB_Comunicaciones",
    "PIB_Servicios_financieros",
    "PIB_Servicios_empresariales",
    "PIB_Servicios_de_vivienda",
    "PIB_Servicios_personales",
    "PIB_Administracion_publica",
    "PIB_a_costo_de_factores",
    "PIB",
]
INDEX_COLS = [
    "Imacec_empalmado",
    "Imacec_produccion_de_bienes",
    "Imacec_minero",
    "Imacec_industria",
    "Imacec_resto_de_bienes",
    "Imacec_comercio",
    "Imacec_servicios",
    "Imacec_a_costo_de_factores",
    "Imacec_no_minero",
    "Indice_de_ventas_comercio_real_no_durables_IVCM",
]
RAIN_COLS = [
    "Coquimbo",
    "Valparaiso",
    "Metropolitana_de_Santiago",
    "Libertador_Gral__Bernardo_O_Higgins",
    "Maule",
    "Biobio",
    "La_Araucania",
    "Los_Rios",
]

ROLLING_WINDOW = 3
REQUEST_MONTHS = 3


def rolling_name(column: str, method: str, window: int = ROLLING_WINDOW) -> str:
    return f"{column}_rolling{window}_{method}"


@dataclass(frozen=True)
class Layout:
    """Which value columns the tables hold, by the kind of repair they need."""

    rain: tuple[str, ...] = tuple(RAIN_COLS)
    gdp: tuple[str, ...] = tuple(GDP_COLS)
    index: tuple[str, ...] = tuple(INDEX_COLS)
    price: str = PRICE
    #: Columns of the merged table's header beyond the known ones: a request must carry them too.
    extra: tuple[str, ...] = ()

    @classmethod
    def of_header(cls, columns: list[str]) -> Layout:
        """The layout of a merged table's columns; what no group knows is required all the same."""
        absent = [c for c in [*TIME_COLS, PRICE] if c not in columns]
        if absent:
            raise ValueError(f"columns missing in the header: {absent}")
        known = {*TIME_COLS, PRICE, *RAIN_COLS, *GDP_COLS, *INDEX_COLS}
        return cls(
            rain=tuple(c for c in RAIN_COLS if c in columns),
            gdp=tuple(c for c in GDP_COLS if c in columns),
            index=tuple(c for c in INDEX_COLS if c in columns),
            extra=tuple(c for c in columns if c not in known),
        )

    @property
    def required(self) -> list[str]:
        """Columns that a request must carry."""
        return [*self.merged, *self.extra]

    @property
    def price_table(self) -> list[str]:
        return [*TIME_COLS, self.price]

    @property
    def rain_table(self) -> list[str]:
        return [*TIME_COLS, *self.rain]

    @property
    def bank_table(self) -> list[str]:
        return [*TIME_COLS, *self.gdp, *self.index]

    @property
    def texts(self) -> list[str]:
        """Columns that arrive as dotted text."""
        return [*self.gdp, *self.index]

    @property
    def values(self) -> list[str]:
        return [self.price, *self.rain, *self.gdp, *self.index]

    @property
    def merged(self) -> list[str]:
        return [*TIME_COLS, *self.values]

    @property
    def features(self) -> list[str]:
        """Model features in selector order: rolling means, rolling deviations, raw values."""
        means = [rolling_name(c, "mean") for c in self.values]
        deviations = [rolling_name(c, "std") for c in self.values]
        return [*means, *deviations, *self.values]

    def raw_price(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField("Anio", T.IntegerType()),
                T.StructField("Mes", T.StringType()),
                T.StructField(self.price, T.DoubleType()),
            ]
        )

    def raw_rain(self) -> T.StructType:
        date = T.StructField("date", T.StringType())
        return T.StructType([date, *_fields(self.rain, T.DoubleType())])

    def raw_bank(self) -> T.StructType:
        return T.StructType(_fields([PERIOD, *self.texts], T.StringType()))

    def request(self) -> T.StructType:
        """One scoring request as sent: an id and an array of months per column.

        Text columns keep the JSON type of each cell.
        """
        numbers = [*TIME_COLS, self.price, *self.rain]
        data = T.StructType(
            _fields(numbers, T.ArrayType(T.DoubleType()))
            + _fields([*self.texts, *self.extra], T.ArrayType(T.VariantType()))
        )
        return T.StructType(
            [T.StructField("request_id", T.StringType()), T.StructField("data", data)]
        )

    def request_log(self) -> T.StructType:
        """One logged request month: every request column and the shared prediction."""
        return T.StructType(
            [T.StructField("request_id", T.StringType()), T.StructField("pos", T.IntegerType())]
            + _fields(TIME_COLS, T.IntegerType())
            + _fields([self.price, *self.rain], T.DoubleType())
            + _fields(self.texts, T.StringType())
            + [T.StructField("pred", T.DoubleType())]
        )


def _fields(names: Iterable[str], dtype: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, dtype) for n in names]


FULL = Layout()

PREDICTIONS = T.StructType(
    [T.StructField(PERIOD, T.StringType()), T.StructField("preds", T.DoubleType())]
)


def with_series(schema: T.StructType, series: dict[str, T.DataType]) -> T.StructType:
    """``schema`` with leading series-key fields."""
    return T.StructType([T.StructField(n, t) for n, t in series.items()] + schema.fields)
