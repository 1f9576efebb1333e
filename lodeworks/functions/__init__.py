from lodeworks.functions.keys import guard_keys, hard_delete_mask, split_hard_delete
from lodeworks.functions.names import check_names, normalize_column, normalize_identifier
from lodeworks.functions.nested import child_tables, flatten_struct
from lodeworks.functions.schema import conform, logical_type, merge_schemas, merge_types

__all__ = [
    "check_names",
    "child_tables",
    "conform",
    "flatten_struct",
    "guard_keys",
    "hard_delete_mask",
    "logical_type",
    "merge_schemas",
    "merge_types",
    "normalize_column",
    "normalize_identifier",
    "split_hard_delete",
]
