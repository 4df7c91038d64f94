"""DataFrame operators: audit drop, dense index, exact sample, address replacement."""

from maskfold.operators.address import (
    ADDRESS_FIELDS,
    address_report,
    prepare_addresses,
    replace_keyed,
    replace_sampled,
)
from maskfold.operators.audit import drop_audit
from maskfold.operators.index import (
    dense_index,
    dense_index_counted,
    materialised,
    sample_exact,
    sample_key,
    total_order,
)
from maskfold.operators.mapping import map_values_join

__all__ = [
    "ADDRESS_FIELDS",
    "address_report",
    "dense_index",
    "dense_index_counted",
    "drop_audit",
    "map_values_join",
    "materialised",
    "prepare_addresses",
    "replace_keyed",
    "replace_sampled",
    "sample_exact",
    "sample_key",
    "total_order",
]
