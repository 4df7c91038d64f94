"""Sources and sinks."""

from maskfold.sources.infer import infer_schemas
from maskfold.sources.readers import read_addresses, read_inferred, read_rule_table, read_table, shared_dir
from maskfold.sources.sinks import FORMATS, read_manifest, write_outputs

__all__ = [
    "FORMATS",
    "infer_schemas",
    "read_addresses",
    "read_inferred",
    "read_manifest",
    "read_rule_table",
    "read_table",
    "shared_dir",
    "write_outputs",
]
