"""Features sorted into two data families by their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Name parts that mark a family
ALTERNATIVE_PARTS = ("FLAG_", "EXT_SOURCE", "REGION_", "OBS_", "DEF_", "EMAIL", "PHONE", "MOBIL", "SOCIAL")
TRADITIONAL_PARTS = ("AMT_", "DAYS_", "CNT_", "CREDIT", "INCOME", "BUREAU_", "PREV_", "ANNUITY")
NOT_FEATURES = ("TARGET", "SK_ID_CURR")

FEATURE_SETS = ("all", "traditional", "alternative")


def family_of(
    name: str,
    alternative: tuple[str, ...] = ALTERNATIVE_PARTS,
    traditional: tuple[str, ...] = TRADITIONAL_PARTS,
) -> str:
    """'alternative' only if an alternative part occurs and no traditional one does."""
    upper = name.upper()
    if any(part in upper for part in traditional):
        return "traditional"
    return "alternative" if any(part in upper for part in alternative) else "traditional"


def features_of(columns: list[str], not_features: tuple[str, ...] = NOT_FEATURES, **parts) -> dict[str, list[str]]:
    """Column names of each feature set, in table order. A set without columns is left out."""
    names = [c for c in columns if c not in not_features]
    sets = {"all": names}
    for family in FEATURE_SETS[1:]:
        sets[family] = [c for c in names if family_of(c, **parts) == family]
    return {name: cols for name, cols in sets.items() if cols}


def catalog(spark: SparkSession, columns: list[str], not_features: tuple[str, ...] = NOT_FEATURES, **parts) -> DataFrame:
    """The features as a table: (name, family, pos)."""
    names = [c for c in columns if c not in not_features]
    rows = [(c, family_of(c, **parts), i) for i, c in enumerate(names)]
    return spark.createDataFrame(rows, "name string, family string, pos int")
