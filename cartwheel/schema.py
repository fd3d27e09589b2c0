"""Column groups and category domains of the session table.

Fixed values (must equal the reference's contract for identical results):
  count columns:      Administrative, Informational, ProductRelated
  duration columns:   Administrative_Duration, Informational_Duration, ProductRelated_Duration
  rate columns:       BounceRates, ExitRates, SpecialDay
  category codes:     OperatingSystems, Browser, Region, TrafficType
  months:             Feb, Mar, May, June, Jul, Aug, Sep, Oct, Nov, Dec
  visitor types:      New_Visitor, Returning_Visitor, Other
  label:              Revenue
"""

from __future__ import annotations

from pyspark.sql import types as T

COUNT_COLUMNS = ("Administrative", "Informational", "ProductRelated")
DURATION_COLUMNS = ("Administrative_Duration", "Informational_Duration", "ProductRelated_Duration")
RATE_COLUMNS = ("BounceRates", "ExitRates", "SpecialDay")
CONTINUOUS_COLUMNS = (*DURATION_COLUMNS, *RATE_COLUMNS, "PageValues")
CODE_COLUMNS = ("OperatingSystems", "Browser", "Region", "TrafficType")
CATEGORICAL_COLUMNS = (*CODE_COLUMNS, "Month", "VisitorType", "Weekend")
FEATURE_COLUMNS = (
    "Administrative",
    "Administrative_Duration",
    "Informational",
    "Informational_Duration",
    "ProductRelated",
    "ProductRelated_Duration",
    "BounceRates",
    "ExitRates",
    "PageValues",
    "SpecialDay",
    "Month",
    "OperatingSystems",
    "Browser",
    "Region",
    "TrafficType",
    "VisitorType",
    "Weekend",
)
LABEL = "Revenue"
EXPECTED_COLUMNS = (*FEATURE_COLUMNS, LABEL)
KEY_COLUMNS = ("user_id", "session_date")

# Fixed category domains; MONTH_ORDER is the calendar order used for reindexing.
MONTH_ORDER = ("Feb", "Mar", "May", "June", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")
VISITOR_TYPES = ("New_Visitor", "Returning_Visitor", "Other")

# Numeric columns described by the EDA summary (booleans excluded).
NUMERIC_DESCRIBE_COLUMNS = (*COUNT_COLUMNS, *CONTINUOUS_COLUMNS, *CODE_COLUMNS)
NON_NEGATIVE_COLUMNS = (*COUNT_COLUMNS, *DURATION_COLUMNS, "PageValues")
INTEGER_COLUMNS = (*COUNT_COLUMNS, *CODE_COLUMNS)
NUMERIC_INPUT_COLUMNS = (*COUNT_COLUMNS, *CONTINUOUS_COLUMNS, *CODE_COLUMNS)


def _type_of(column: str) -> T.DataType:
    if column in COUNT_COLUMNS or column in CODE_COLUMNS:
        return T.LongType()
    if column in CONTINUOUS_COLUMNS:
        return T.DoubleType()
    if column in ("Weekend", LABEL):
        return T.BooleanType()
    return T.StringType()


SESSION_SCHEMA = T.StructType([T.StructField(c, _type_of(c), False) for c in EXPECTED_COLUMNS])
RAW_SESSION_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in EXPECTED_COLUMNS])
