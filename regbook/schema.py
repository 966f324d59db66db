"""Fixed values of the vehicle registry: columns, lookups and terms."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The raw file's columns, in file order.
RAW_COLUMNS = (
    "PERSON",
    "REG_ADDR_KOATUU",
    "OPER_CODE",
    "OPER_NAME",
    "D_REG",
    "DEP_CODE",
    "DEP",
    "BRAND",
    "MODEL",
    "VIN",
    "MAKE_YEAR",
    "COLOR",
    "KIND",
    "BODY",
    "PURPOSE",
    "FUEL",
    "CAPACITY",
    "OWN_WEIGHT",
    "TOTAL_WEIGHT",
    "N_REG_NEW",
)
DATE_COLUMN = "D_REG"
DECIMAL_COLUMNS = ("CAPACITY", "OWN_WEIGHT", "TOTAL_WEIGHT")

# The 18 columns of the cleaned table.
CLEAN_COLUMNS = (
    "REG_ADDR_KOATUU",
    "OPER_CODE",
    "D_REG",
    "DEP_CODE",
    "BRAND",
    "MODEL",
    "MAKE_YEAR",
    "COLOR",
    "KIND",
    "BODY",
    "PURPOSE",
    "FUEL",
    "CAPACITY",
    "OWN_WEIGHT",
    "TOTAL_WEIGHT",
    "AGE",
    "REG_YEAR",
    "REG_MONTH",
)

# Everything is read as text except the year; dates and decimals are parsed afterwards.
REGISTRY_SCHEMA = StructType(
    [StructField(c, IntegerType() if c == "MAKE_YEAR" else StringType()) for c in RAW_COLUMNS]
)

# Region codes and names.
REGIONS = (
    ("8000000000", "м. Київ"),
    ("4610100000", "Львівська обл."),
    ("6325111000", "Харківська обл."),
    ("0520880903", "Вінницька обл."),
)

# Operation codes and descriptions.
OPERATIONS = (
    ("315", "Перереєстрація на нового власника"),
    ("70", "Первинна реєстрація"),
    ("254", "Належний користувач"),
)

# Entries that mean "missing", compared after trimming and upper-casing.
SENTINELS = (
    "",
    ".",
    "-",
    "ВІДСУТНЄ",
    "НЕ ВИЗНАЧЕНО",
    "НЕВИЗНАЧЕНИЙ",
    "НЕВІДОМО",
    "NULL",
    "NONE",
)

# Fill-ins and columns that carry no analytical information.
UNKNOWN = "НЕВІДОМЕ"
OTHER = "ІНШЕ"
UNINFORMATIVE = ("VIN", "N_REG_NEW", "OPER_NAME", "DEP", "PERSON")


@dataclass(frozen=True)
class RegistryTerms:
    """Literals the 24 questions ask about. Fixed values of the registry preset."""

    capital: str = "м. Київ"
    electric: str = "ЕЛЕКТРО"
    passenger: str = "ЛЕГКОВИЙ"
    truck: str = "ВАНТАЖНИЙ"
    brand: str = "TOYOTA"
    diesel: str = "ДИЗЕЛЬНЕ ПАЛИВО"
    new_age: int = 2
    tracked_colours: tuple[str, ...] = ("БІЛИЙ", "ЧОРНИЙ")
    motorcycle: str = "МОТОЦИКЛ"
    month: int = 1
    special: str = "СПЕЦІАЛІЗОВАНИЙ"
    red: str = "ЧЕРВОНИЙ"
    after_year: int = 2020
    hybrid_words: tuple[str, ...] = ("ЕЛЕКТРО", "БЕНЗИН")
    unknown: str = UNKNOWN
    compared_brands: tuple[str, ...] = ("TOYOTA", "NISSAN", "HONDA")
    light_weight: float = 500
