"""Career-profile analytics as Spark DataFrame operators.

Every public function takes DataFrames (or Columns) and returns a DataFrame
(or a Column); nothing runs until the caller asks for an action.
"""

from careerloom import functions, operators, plans, sources
from careerloom.schema import (
    END_YEAR,
    PROFILE_COLUMNS,
    SECTORS,
    START_YEAR,
    TEST_YEAR,
    TOP_K,
    profile_json_schema,
)

__all__ = [
    "END_YEAR",
    "PROFILE_COLUMNS",
    "SECTORS",
    "START_YEAR",
    "TEST_YEAR",
    "TOP_K",
    "functions",
    "operators",
    "plans",
    "profile_json_schema",
    "sources",
]
