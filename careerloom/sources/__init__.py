"""Readers and writers: JSON profiles, delimited lookups, named outputs, stores."""

from careerloom.sources.lookups import (
    lookup_lists,
    lookup_pairs,
    parse_tag_line,
    place_lookup,
    read_lines,
    read_named_lines,
)
from careerloom.sources.outputs import (
    key_list_lines,
    matching_paths,
    observed,
    observed_row,
    profile_json_lines,
    read_matching_files,
    scratch_folder,
    write_key_list,
    write_named_outputs,
    write_profile_json,
    written_table,
)
from careerloom.sources.profiles import (
    parse_lines,
    profiles_of,
    read_profile_arrays,
    read_profile_objects,
    rejected_lines,
    rejects_of,
    with_profile_id,
)
from careerloom.sources.stores import (
    model_load,
    model_replace,
    model_store,
    year_store_keys,
    year_store_read,
    year_store_scan,
    year_store_write,
)

__all__ = [
    "key_list_lines",
    "lookup_lists",
    "lookup_pairs",
    "matching_paths",
    "model_load",
    "model_replace",
    "model_store",
    "observed",
    "observed_row",
    "parse_lines",
    "parse_tag_line",
    "place_lookup",
    "profile_json_lines",
    "profiles_of",
    "read_lines",
    "read_named_lines",
    "read_matching_files",
    "read_profile_arrays",
    "read_profile_objects",
    "rejected_lines",
    "rejects_of",
    "scratch_folder",
    "with_profile_id",
    "write_key_list",
    "write_named_outputs",
    "write_profile_json",
    "written_table",
    "year_store_keys",
    "year_store_read",
    "year_store_scan",
    "year_store_write",
]
