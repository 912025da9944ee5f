from quillgrid.functions.clean import (
    clean_cell, drop_empty_value, drop_falsy, element_name, escape_xml, fit_fields,
    normalise_entities, normalise_header, repair_quote, replace_first, strip_control,
    strip_eol, tokenise_breaks, trim_ws, unescape_xml,
)
from quillgrid.functions.dates import as_date, date_triples, leading_int, partial_date, zpad
from quillgrid.functions.provenance import (
    NAME_RULES, NameRule, column_letter, document_key, file_name, is_stub, output_name,
    parse_file_name, type_from_name,
)

__all__ = [
    "NAME_RULES", "NameRule", "as_date", "clean_cell", "column_letter", "date_triples",
    "document_key", "drop_empty_value", "drop_falsy", "element_name", "escape_xml", "file_name",
    "fit_fields", "is_stub", "leading_int", "normalise_entities", "normalise_header",
    "output_name", "parse_file_name", "partial_date", "repair_quote", "replace_first",
    "strip_control", "strip_eol", "tokenise_breaks", "trim_ws", "type_from_name",
    "unescape_xml", "zpad",
]
