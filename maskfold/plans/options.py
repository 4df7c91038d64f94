"""Scrub options. Defaults are the latest reference behaviour; earlier behaviours are modes."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from maskfold.functions.masks import ACCOUNT_PATTERN, ACCOUNT_SHIFT, CHOICE_SUFFIX

AUDIT_COLUMNS = ("BTCH_CR_RUN_ID", "BTCH_CR_TS", "BTCH_LST_UPD_RUN_ID", "BTCH_LST_UPD_TS")


@dataclass(frozen=True)
class AddressColumns:
    """Where the address pieces come from (source file) and go to (data table)."""

    number: str = "NUMBER"
    street: str = "STREET"
    unit: str = "UNIT"
    city: str = "CITY"
    region: str = "REGION"
    postcode: str = "POSTCODE"
    target_city: str = "CITY"
    target_state: str = "STAT"
    target_zip: str = "ZIP"
    target_line1: str = "PRPTY_ADDR_LN1"
    target_line2: str = "PRPTY_ADDR_LN2"
    target_state_name: str = "STAT_CD_DESC"


CHOICES = {
    "numeric": ("digits", "sequence"),
    "multiple": ("map", "choice"),
    "fix": ("literal", "comma_to_space"),
    "regex": ("reverse", "index"),
    "address": ("keyed", "sample"),
    "address_how": ("inner", "left"),
    "on_error": ("null", "fail"),
}


@dataclass(frozen=True)
class ScrubOptions:
    numeric: str = "digits"
    sequence_start: int | None = None  # fixed start for sequence mode (earliest form: 5)
    multiple: str = "map"
    choice_suffix: str = CHOICE_SUFFIX
    fix: str = "literal"
    regex: str = "reverse"
    regex_pattern: str = ACCOUNT_PATTERN
    regex_shift: int = ACCOUNT_SHIFT
    address: str = "keyed"
    address_how: str = "inner"
    include_unit: bool = False  # line 2 = 'UNIT <unit>' instead of one blank
    distinct_addresses: bool = False  # whole-row DISTINCT of the address pool
    on_error: str = "null"
    seed: int = 42
    id_col: str = "ASST_ID"
    order_col: str = "ASST_DIM_ID"
    audit_cols: tuple[str, ...] = AUDIT_COLUMNS
    columns: AddressColumns = field(default_factory=AddressColumns)

    def __post_init__(self):
        for name, allowed in CHOICES.items():
            if getattr(self, name) not in allowed:
                raise ValueError(f"unknown {name} {getattr(self, name)!r}; use one of {allowed}")

    def with_(self, **changes) -> ScrubOptions:
        return replace(self, **changes)


PRESETS = {
    "latest": ScrubOptions(),
    "v1": ScrubOptions(
        numeric="sequence",
        sequence_start=5,
        multiple="choice",
        fix="comma_to_space",
        address="sample",
        include_unit=True,
        distinct_addresses=True,
    ),
    "v2": ScrubOptions(
        numeric="sequence", address="sample", include_unit=True, distinct_addresses=True
    ),
    "v3": ScrubOptions(
        numeric="sequence",
        regex="index",
        address="sample",
        include_unit=True,
        distinct_addresses=True,
    ),
}


def preset(name: str, **changes) -> ScrubOptions:
    return replace(PRESETS[name], **changes)
