"""Names, key columns and schema audits of panels: tables keyed by a month and a place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Key columns by level of analysis: grid cell or country, by month or year.
LEVELS = {"pgm": ("month_id", "priogrid_id"), "cm": ("month_id", "country_id"), "pgy": ("year_id", "priogrid_id"), "cy": ("year_id", "country_id")}
LEGACY_GRID, GRID = "priogrid_gid", "priogrid_id"
PREFIX = "pred_"


class PanelError(ValueError):
    """A panel breaks a rule that later steps rely on."""


def month_id(date: Column) -> Column:
    """Months since 1980-01, which is 1; null for a null date."""
    return ((F.year(date) - 1980) * 12 + F.month(date)).cast("int")


def month_start(month: Column) -> Column:
    return F.make_date(F.floor((month - 1) / 12).cast("int") + 1980, (F.pmod(month - 1, F.lit(12)) + 1).cast("int"), F.lit(1))


def keys_of(df: DataFrame) -> tuple[str, str]:
    """The key columns that df has, by the level whose names it carries."""
    for keys in LEVELS.values():
        if set(keys) <= set(df.columns):
            return keys
    raise PanelError(f"no level has its keys among {df.columns}")


def normalise_grid_key(df: DataFrame) -> DataFrame:
    """The legacy grid key renamed; both names together are an error."""
    if LEGACY_GRID in df.columns and GRID in df.columns:
        raise PanelError(f"both {LEGACY_GRID} and {GRID} are there")
    return df.withColumnRenamed(LEGACY_GRID, GRID)


def prediction_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(PREFIX)]


def feature_columns(df: DataFrame, keys: tuple[str, ...]) -> list[str]:
    return [c for c in df.columns if not c.startswith(PREFIX) and c not in keys]


def classify_columns(df: DataFrame, keys: tuple[str, ...]) -> tuple[str, list[str]]:
    """("predictions" or "features", columns); a panel with both is an error."""
    predictions, features = prediction_columns(df), feature_columns(df, keys)
    if predictions and features:
        raise PanelError(f"predictions {predictions} and features {features} in one panel")
    return ("predictions", predictions) if predictions else ("features", features)


def audit_schema(df: DataFrame, level: str, targets: list[str] | None = None) -> DataFrame:
    """df, if its keys are there and integers and its targets are arrays; reads the schema only."""
    if level not in LEVELS:
        raise PanelError(f"unknown level {level}")
    for key in LEVELS[level]:
        if key not in df.columns:
            raise PanelError(f"key {key} is missing")
        if not isinstance(df.schema[key].dataType, T.IntegralType):
            raise PanelError(f"key {key} is {df.schema[key].dataType.simpleString()}, not an integer")
    for target in targets or []:
        if target not in df.columns:
            raise PanelError(f"target {target} is missing")
        if not isinstance(df.schema[target].dataType, T.ArrayType):
            raise PanelError(f"target {target} isn't an array")
    return df


def as_panel(df: DataFrame, level: str) -> DataFrame:
    """df with its keys named for the level and its scalar predictions as arrays of one."""
    df = audit_schema(normalise_grid_key(df), level)
    scalar = [c for c in prediction_columns(df) if not isinstance(df.schema[c].dataType, T.ArrayType)]
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.array(F.col(c).cast("double"))) for c in scalar})


def rename_features(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Mapped columns renamed, others unchanged; two onto one name are an error."""
    after = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in after if after.count(c) > 1})
    if twice:
        raise PanelError(f"more than one column would be named {twice}")
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def ensure_double(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """All numeric columns but the keys as double."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in keys]
    return df.withColumns({c: F.col(c).cast("double") for c in numeric})


def null_for_nan(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null: the one marker for missing values from here on."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floating})


def grid_row(grid: Column, columns: int = 720) -> Column:
    return (F.floor((grid - 1) / columns) + 1).cast("int")


def grid_column(grid: Column, columns: int = 720) -> Column:
    return (F.pmod(grid - 1, F.lit(columns)) + 1).cast("int")


def combined_targets(config: dict) -> list[str]:
    """Regression targets, then classification targets; retired keys are an error."""
    retired = {"targets", "depvar", "algorithm_targets"} & set(config)
    if retired:
        raise PanelError(f"retired configuration keys: {sorted(retired)}")
    listed = [config.get(k) or [] for k in ("regression_targets", "classification_targets")]
    return [t for part in listed for t in ([part] if isinstance(part, str) else part)]


def wire_target(names: dict[str, str]) -> callable:
    """A function from internal target names to those that are published; unmapped names are an error."""

    def of(name: str) -> str:
        if name not in names:
            raise PanelError(f"no published name for target {name}")
        return names[name]

    return of


def wire_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """df with its prediction columns under the published names of their targets; a target without one is an error."""
    of = wire_target(names)
    return df.withColumnsRenamed({c: PREFIX + of(c.removeprefix(PREFIX)) for c in prediction_columns(df)})
