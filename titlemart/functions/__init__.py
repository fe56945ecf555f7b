from titlemart.functions.query import attach_functions, for_each_parameter_set, run_sql
from titlemart.functions.scalars import cast_cell, first_element, image_url, iso_year

__all__ = [
    "attach_functions",
    "cast_cell",
    "first_element",
    "for_each_parameter_set",
    "image_url",
    "iso_year",
    "run_sql",
]
