"""Column expressions: one per rule mode, plus the state name lookup."""

from maskfold.functions.masks import (
    ACCOUNT_PATTERN,
    ACCOUNT_SHIFT,
    CHOICE_SUFFIX,
    Masked,
    amount,
    choose_constant,
    cross_shift,
    fix,
    map_values,
    numeric_digits,
    numeric_sequence,
    parse_list,
    piece,
    regex_index,
    regex_reverse,
)
from maskfold.functions.pytext import falsy, python_digits
from maskfold.functions.states import STATE_NAMES, state_name

__all__ = [
    "ACCOUNT_PATTERN",
    "ACCOUNT_SHIFT",
    "CHOICE_SUFFIX",
    "Masked",
    "STATE_NAMES",
    "amount",
    "choose_constant",
    "cross_shift",
    "falsy",
    "fix",
    "map_values",
    "numeric_digits",
    "numeric_sequence",
    "parse_list",
    "piece",
    "python_digits",
    "regex_index",
    "regex_reverse",
    "state_name",
]
