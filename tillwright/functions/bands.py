"""Bucketing of numbers and ids into labelled bands."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(column: Column, edges, labels, right_closed: bool = False) -> Column:
    """Label ``column`` by ascending ``edges``; ``labels`` has one more entry.

    Half-open by default: a value equal to an edge falls in the upper band.
    With ``right_closed`` it falls in the lower one. NULL gets the last label,
    as in a searched CASE with ELSE.
    """
    edges, labels = list(edges), list(labels)
    if len(labels) != len(edges) + 1:
        raise ValueError("a band needs one label more than edges")
    if edges != sorted(edges):
        raise ValueError("band edges must ascend")
    below = (lambda e: column <= e) if right_closed else (lambda e: column < e)
    chain = F
    for edge, label in zip(edges, labels):
        chain = chain.when(below(edge), label)
    return chain.otherwise(labels[-1])


# These bands define the results.
TEMPERATURE_BANDS = ([32, 50, 70, 85], ["Cold", "Cool", "Mild", "Warm", "Hot"])
FUEL_BANDS = ([2.5, 3.5, 4.0], ["Low", "Medium", "High", "Very High"])
CPI_BANDS = ([200, 220], ["Low Inflation", "Moderate Inflation", "High Inflation"])
UNEMPLOYMENT_BANDS = ([5, 8], ["Low", "Medium", "High"])
CONDITION_BANDS = ([4, 6, 8], ["Peak", "Growth", "Recovery", "Recession"])
SIZE_BANDS = ([50000, 100000, 150000], ["Small", "Medium", "Large", "Extra Large"])
STORE_TYPES = {"A": "Superstore", "B": "Discount Store", "C": "Neighborhood Market"}
TYPE_CODES = {"A": 0, "B": 1, "C": 2}
DEPARTMENT_CATEGORIES = (
    [10, 20, 30, 40, 50, 60, 70, 80, 90],
    [
        "Electronics & Home",
        "Apparel & Accessories",
        "General Merchandise",
        "Health & Wellness",
        "Food & Beverage",
        "Fresh Produce",
        "Entertainment",
        "Home Improvement",
        "Seasonal",
        "Other",
    ],
)
DEPARTMENT_GROUPS = ([30, 50], ["Hardlines", "Softlines", "Consumables"])
DEPARTMENT_DIVISIONS = ([20, 60], ["General Merchandise", "Grocery", "Seasonal & Other"])
SEASONAL_CATEGORIES = ["Seasonal", "Entertainment"]
DEFAULT_CATEGORIES = ([30, 60, 90], ["General Merchandise", "Food", "Apparel", "Other"])
DEFAULT_GROUPS = ([45], ["Discretionary", "Staples"])
CPI_IMPACT_BANDS = ("Low(<200)", "Moderate(200-220)", "High(>220)")
UNEMPLOYMENT_IMPACT_BANDS = ("Low(<5%)", "Medium(5-8%)", "High(>8%)")


def promotion_type(total: Column) -> Column:
    return (
        F.when(total == 0, "None")
        .when(total < 1000, "Light")
        .when(total < 5000, "Moderate")
        .otherwise("Heavy")
    )


def promotion_intensity(active: Column) -> Column:
    return band(active, [0, 2, 4], ["None", "Low", "Medium", "High"], right_closed=True)


def mixed_band(column: Column, closed_below, closed_above, labels) -> Column:
    """Three bands ``< closed_below``, ``<= closed_above``, rest."""
    return (
        F.when(column < closed_below, labels[0])
        .when(column <= closed_above, labels[1])
        .otherwise(labels[2])
    )


def store_type_code(column: Column) -> Column:
    """A, B, C to 0, 1, 2; anything else to 0."""
    codes = F
    for letter, code in TYPE_CODES.items():
        codes = codes.when(column == letter, code)
    return codes.otherwise(0)


def store_type_name(column: Column) -> Column:
    names = F
    for letter, name in STORE_TYPES.items():
        names = names.when(column == letter, name)
    return names
