"""State code -> state name lookup (a literal map inside the plan: no join, no shuffle)."""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from maskfold.functions.names import col

# These must equal the reference's table exactly (50 states, DC, five territories,
# and NA -> National). Codes are case-sensitive; any other code maps to null.
STATE_NAMES: dict[str, str] = {
    "AK": "Alaska",
    "AL": "Alabama",
    "AR": "Arkansas",
    "AS": "American Samoa",
    "AZ": "Arizona",
    "CA": "California",
    "CO": "Colorado",
    "CT": "Connecticut",
    "DC": "District of Columbia",
    "DE": "Delaware",
    "FL": "Florida",
    "GA": "Georgia",
    "GU": "Guam",
    "HI": "Hawaii",
    "IA": "Iowa",
    "ID": "Idaho",
    "IL": "Illinois",
    "IN": "Indiana",
    "KS": "Kansas",
    "KY": "Kentucky",
    "LA": "Louisiana",
    "MA": "Massachusetts",
    "MD": "Maryland",
    "ME": "Maine",
    "MI": "Michigan",
    "MN": "Minnesota",
    "MO": "Missouri",
    "MP": "Northern Mariana Islands",
    "MS": "Mississippi",
    "MT": "Montana",
    "NA": "National",
    "NC": "North Carolina",
    "ND": "North Dakota",
    "NE": "Nebraska",
    "NH": "New Hampshire",
    "NJ": "New Jersey",
    "NM": "New Mexico",
    "NV": "Nevada",
    "NY": "New York",
    "OH": "Ohio",
    "OK": "Oklahoma",
    "OR": "Oregon",
    "PA": "Pennsylvania",
    "PR": "Puerto Rico",
    "RI": "Rhode Island",
    "SC": "South Carolina",
    "SD": "South Dakota",
    "TN": "Tennessee",
    "TX": "Texas",
    "UT": "Utah",
    "VA": "Virginia",
    "VI": "Virgin Islands",
    "VT": "Vermont",
    "WA": "Washington",
    "WI": "Wisconsin",
    "WV": "West Virginia",
    "WY": "Wyoming",
}


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


_STATE_MAP_SQL = "map(" + ", ".join(
    _sql_text(x) for x in itertools.chain.from_iterable(STATE_NAMES.items())
) + ")"


def state_map() -> Column:
    """The lookup as one literal map (built from SQL text in a single call to the JVM)."""
    return F.expr(_STATE_MAP_SQL)


def state_name(code: Column | str) -> Column:
    """Full state name for a code column; unknown codes, other letter case and null give null.

    Non-string codes are compared by their text (an inferred integer column never matches).
    """
    c = col(code) if isinstance(code, str) else code
    return F.try_element_at(state_map(), c.cast("string"))
