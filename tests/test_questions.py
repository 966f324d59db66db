"""The registry preset on hand-made vehicles."""

import datetime
from collections import Counter

import pytest

from regbook.plans.questions import QUESTIONS, Registry
from regbook.sources import operation_dim, region_dim

KYIV, LVIV, ELSEWHERE = "8000000000", "4610100000", "0000000000"
NEW_OWNER, FIRST = "315", "70"

COLUMNS = (
    "REG_ADDR_KOATUU string, OPER_CODE string, D_REG date, DEP_CODE string, BRAND string, MODEL string, "
    "MAKE_YEAR int, COLOR string, KIND string, BODY string, PURPOSE string, FUEL string, CAPACITY double, "
    "OWN_WEIGHT double, TOTAL_WEIGHT double, AGE int, REG_YEAR int, REG_MONTH int"
)


def car(region, oper, day, brand, model, year, colour, kind, body, purpose, fuel, capacity, own, total):
    day = datetime.date.fromisoformat(day) if day else None
    age = None if year is None else 2026 - year
    parts = (day.year, day.month) if day else (None, None)
    return (region, oper, day, "1", brand, model, year, colour, kind, body, purpose, fuel, capacity,
            own, total, age, *parts)


@pytest.fixture(scope="module")
def registry(spark):
    plain = "ЗАГАЛЬНИЙ"
    petrol, diesel, hybrid = "БЕНЗИН", "ДИЗЕЛЬНЕ ПАЛИВО", "ЕЛЕКТРО АБО БЕНЗИН"
    vehicles = [
        car(KYIV, NEW_OWNER, "2025-01-05", "TOYOTA", "CAMRY", 2021, "ЧЕРВОНИЙ", "ЛЕГКОВИЙ", "СЕДАН", plain, petrol, 2500.0, 1500.0, 2000.0),
        car(KYIV, FIRST, "2025-02-05", "TOYOTA", "PRIUS", 2025, "БІЛИЙ", "ЛЕГКОВИЙ", "ХЕТЧБЕК", plain, hybrid, 1800.0, 1400.0, 1800.0),
        car(KYIV, FIRST, None, "TESLA", "3", 2024, "НЕВІДОМЕ", "ЛЕГКОВИЙ", "СЕДАН", plain, "ЕЛЕКТРО", 0.0, 1700.0, 2100.0),
        car(LVIV, NEW_OWNER, "2025-01-09", "MAN", "TGX", 2010, "БІЛИЙ", "ВАНТАЖНИЙ", "ТЯГАЧ", "СПЕЦІАЛІЗОВАНИЙ", diesel, 12000.0, 8000.0, 18000.0),
        car(LVIV, NEW_OWNER, "2024-01-09", "MAN", "TGX", 2012, "БІЛИЙ", "ВАНТАЖНИЙ", "ТЯГАЧ", plain, diesel, 11000.0, 7000.0, 20000.0),
        car(ELSEWHERE, "999", "2020-05-05", "HONDA", "CB", None, "ЧОРНИЙ", "МОТОЦИКЛ", "МОТО", plain, petrol, 500.0, 200.0, 400.0),
    ]
    return Registry(spark.createDataFrame(vehicles, COLUMNS), region_dim(spark), operation_dim(spark))


OWNER_TEXT, FIRST_TEXT = "Перереєстрація на нового власника", "Первинна реєстрація"
CAPITAL, LVIV_TEXT = "м. Київ", "Львівська обл."

EXPECTED = {
    1: [(CAPITAL, 3), (LVIV_TEXT, 2)],
    2: [("TESLA", 1), ("TOYOTA", 2)],
    3: [("TESLA", "3", FIRST_TEXT, 2024)],
    4: [(FIRST_TEXT, 1.5), (OWNER_TEXT, 5.0)],
    5: [(LVIV_TEXT, 38000.0)],
    6: [(FIRST_TEXT, 1), (OWNER_TEXT, 1)],
    7: [(LVIV_TEXT, 11500.0)],
    8: [(FIRST_TEXT, 2)],
    9: [("МОТО", "HONDA", 1, 1), ("СЕДАН", "TESLA", 1, 1), ("СЕДАН", "TOYOTA", 1, 1),
        ("ТЯГАЧ", "MAN", 2, 1), ("ХЕТЧБЕК", "TOYOTA", 1, 1)],
    10: [("HONDA", "CB", 400.0), ("MAN", "TGX", 20000.0), ("TESLA", "3", 2100.0), ("TOYOTA", "CAMRY", 2000.0)],
    12: [("БІЛИЙ", 2010, 1, 1), ("БІЛИЙ", 2012, 1, 2), ("БІЛИЙ", 2025, 1, 3), ("ЧОРНИЙ", None, 1, 1)],
    13: [("ЧОРНИЙ", 1)],
    14: [("HONDA", "CB", None, None), ("MAN", "TGX", 14, 0), ("MAN", "TGX", 16, 2), ("TESLA", "3", 2, 0),
         ("TOYOTA", "CAMRY", 5, 0), ("TOYOTA", "PRIUS", 1, 0)],
    15: [("HONDA", "БЕНЗИН", 1, 1, 100.0), ("MAN", "ДИЗЕЛЬНЕ ПАЛИВО", 2, 2, 100.0),
         ("TESLA", "ЕЛЕКТРО", 1, 1, 100.0), ("TOYOTA", "БЕНЗИН", 1, 2, 50.0),
         ("TOYOTA", "ЕЛЕКТРО АБО БЕНЗИН", 1, 2, 50.0)],
    16: [("HONDA", "CB", datetime.date(2020, 5, 5)), ("MAN", "TGX", datetime.date(2024, 1, 9)),
         ("TESLA", "3", None), ("TOYOTA", "CAMRY", datetime.date(2025, 1, 5))],
    17: [("MAN", 2), ("TOYOTA", 1)],
    18: [("ТЯГАЧ", 10000.0)],
    20: [("TOYOTA", 1)],
    21: [("HONDA", "CB", None, None), ("MAN", "TGX", 2010, 16), ("MAN", "TGX", 2012, 14),
         ("TESLA", "3", 2024, 2), ("TOYOTA", "CAMRY", 2021, 5), ("TOYOTA", "PRIUS", 2025, 1)],
    22: [("TESLA", 1)],
    23: [("HONDA", 500.0), ("TOYOTA", 2150.0)],
    24: [("МОТОЦИКЛ", "HONDA", "CB", 400.0)],
}


@pytest.mark.parametrize("number", sorted(EXPECTED))
def test_answers(registry, number):
    answer = Counter(tuple(r) for r in QUESTIONS[number](registry).collect())
    assert answer == Counter(EXPECTED[number])


def test_whole_row_answers(registry):
    above = QUESTIONS[11](registry)
    assert above.columns == registry.clean.columns + ["avg_brand"]
    assert sorted((r.MODEL, r.avg_brand) for r in above.collect()) == [("CAMRY", 2150.0), ("TGX", 11500.0)]
    red = QUESTIONS[19](registry)
    assert red.columns == registry.clean.columns
    assert [r.MODEL for r in red.collect()] == ["CAMRY"]


def test_oldest_come_first(registry):
    assert [r.AGE for r in QUESTIONS[21](registry).collect()] == [16, 14, 5, 2, 1, None]


def test_catalogue(registry):
    assert sorted(QUESTIONS) == list(range(1, 25))
    assert all(question(registry).columns for question in QUESTIONS.values())
