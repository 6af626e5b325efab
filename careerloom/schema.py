"""Data model: profile schema, sector vocabulary and default parameters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Default parameters of the operators.
START_YEAR = 1980
END_YEAR = 2012
TEST_YEAR = 2012
TOP_K = 5

# Class labels.
YES = "YES"
NO = "NO"

# The sector vocabulary.
SECTORS = [
    "AGRICULTURE",
    "ACCOUNTING",
    "ADVERTISING",
    "AEROSPACE",
    "APPAREL_ACCESSORIES",
    "ARCHITECTURE_DESIGN",
    "ARTS_CRAFTS",
    "AUTOMOTIVE",
    "AVIATION",
    "BANKING",
    "BROADCASTING",
    "BIOTECHNOLOGY",
    "CARGO_HANDLING",
    "CHEMICAL",
    "COMPUTER",
    "CONSTRUCTION",
    "CONSULTING",
    "CONSUMER_PRODUCTS",
    "COSMETICS",
    "DEFENSE",
    "DEPARTMENT_STORES",
    "EDUCATION",
    "ELECTRONICS",
    "ENERGY",
    "ENTERTAINMENT_LEISURE",
    "ENTREPRENEUR",
    "FINANCIAL_SERVICES",
    "FOOD_BEVERAGE_TOBACCO",
    "FOREIGN_AFFAIRS",
    "HEALTH_CARE",
    "HOTEL",
    "HUMAN_RESOURCES",
    "INTERNET_PUBLISHING",
    "INVESTMENT_BANKING",
    "LEGAL",
    "MANUFACTURING",
    "MOTION_PICTURE_VIDEO",
    "MUSIC",
    "NEWSPAPER_PUBLISHERS",
    "ONLINE_AUCTIONS",
    "PENSION_FUNDS",
    "PHARMACEUTICALS",
    "REAL_ESTATE",
    "RETAIL_WHOLESALE",
    "SECURITIES_COMMODITY_EXCHANGES",
    "SERVICE",
    "SOFTWARE",
    "SPORTS",
    "STORAGE",
    "TECHNOLOGY",
    "TELECOMMUNICATIONS",
    "TELEVISION",
    "TRANSPORTATION",
    "VENTURE_CAPITAL",
]

# Column name -> JSON name, for a profile and for one of its positions.
POSITION_JSON_NAMES = {
    "summary": "summary",
    "title": "title",
    "start_date": "start-date",
    "end_date": "end-date",
    "is_current": "is-current",
    "company_name": "company-name",
}
PROFILE_JSON_NAMES = {
    "skills": "skills",
    "positions": "positions",
    "location": "location",
    "num_connections": "num-connections",
    "first_name": "first-name",
    "last_name": "last-name",
    "industry": "industry",
    "relevant_experience": "relevantExperience",
}
PROFILE_COLUMNS = tuple(PROFILE_JSON_NAMES)
POSITION_COLUMNS = tuple(POSITION_JSON_NAMES)


def _position_type(names: dict[str, str] | None = None) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                names[column] if names else column,
                T.BooleanType() if column == "is_current" else T.StringType(),
            )
            for column in POSITION_JSON_NAMES
        ]
    )


POSITIONS_TYPE = T.ArrayType(_position_type())
_POSITIONS_JSON_TYPE = T.ArrayType(_position_type(POSITION_JSON_NAMES))


def profile_json_schema(columns: Iterable[str] | None = None) -> T.StructType:
    """JSON schema of one profile, narrowed to ``columns`` when given.

    A JSON scan parses only the fields in its schema, so a job that needs two
    fields should ask for two.
    """
    wanted = set(columns) if columns is not None else set(PROFILE_COLUMNS)
    unknown = wanted - set(PROFILE_COLUMNS)
    if unknown:
        raise ValueError(f"unknown profile columns: {sorted(unknown)}")
    types: dict[str, T.DataType] = {
        "skills": T.ArrayType(T.StringType()),
        "positions": _POSITIONS_JSON_TYPE,
        "relevant_experience": T.IntegerType(),
    }
    return T.StructType(
        [
            T.StructField(json_name, types.get(column, T.StringType()))
            for column, json_name in PROFILE_JSON_NAMES.items()
            if column in wanted
        ]
    )
